"""URL filter by a path-template tree per host.

Rules (host, path beginning) decide the urls they fit. For the others, each host gets a tree of
path templates: a segment that is rare at its depth is variable and becomes ``*``. The urls that
rules decide are the labelled ones. Branches of a node (templates that differ in their last fixed
segment) whose share of blocked urls is within chance of that of all branches together are merged
and judged together; a branch that differs stands alone. The share is smoothed with the host's,
that one with the share of all hosts, and a template is rejected from one half on.

Everything is counted per distinct (host, path), so a url or host that fills a third of the table
is pre-aggregated, and only DataFrame functions are used. A null url and one without ``://`` have
an empty host and path. Repeated rows get repeated results, each row one; a segment that is literally
``*`` is text and no wildcard. Urls of any length are split whole. An empty table gives no rows, and
other columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabweave.session import cut_lineage

#: (verdict, rule), the rule as host and path beginning
RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]
MIN_SUPPORT = 8
SMOOTHING = 4.0
NORMAL = 1.96
#: A fixed segment has at least one part in so many of the average support at its depth.
LEAST_SHARE = 4

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def fitting(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def templates(urls: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    """``urls`` (distinct host and path, with n) and the template and branch node of each."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    parts = urls.select("host", "path", "n", F.posexplode(segments).alias("depth", "segment"))
    counted = parts.groupBy("host", "depth", "segment").agg(F.sum("n").alias("support"))
    totals = counted.groupBy("host", "depth").agg(F.sum("support").alias("total"), F.count(F.lit(1)).alias("kinds"))
    fixed = (
        counted.where(F.col("support") >= min_support).join(totals, ["host", "depth"])
        .where(F.col("support") * F.col("kinds") * LEAST_SHARE >= F.col("total")).select("host", "depth", "segment", F.lit(True).alias("fixed"))
    )
    part = F.struct("depth", F.when(F.col("fixed"), F.col("segment")).alias("name"))
    spelled = parts.join(fixed, ["host", "depth", "segment"], "left").groupBy("host", "path").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    last = F.array_max(F.transform(F.filter("parts", lambda p: p["name"].isNotNull()), lambda p: p["depth"]))
    # no segment is empty, so an empty name is a wildcard and nothing else
    name = lambda p: F.coalesce(p["name"], F.lit(""))
    joined = lambda each: F.concat(F.lit("/"), F.array_join(F.transform("parts", each), "/"))
    spelled = spelled.withColumn("last", last).select(
        "host", "path", joined(name).alias("template"),
        joined(lambda p: F.when(p["depth"] == F.col("last"), F.lit("")).otherwise(name(p))).alias("node"),
    )
    return urls.join(spelled, ["host", "path"], "left").fillna("", ["template", "node"])


def written(template: Column) -> Column:
    """A template as text, with ``*`` for its wildcards."""
    names = F.transform(F.split(F.substring(template, 2, F.length(template)), "/"), lambda s: F.when(s == "", "*").otherwise(s))
    return F.when(template == "", "/").otherwise(F.concat(F.lit("/"), F.array_join(names, "/")))


def judge(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", rules: list[tuple[str, str]] = RULES,
    min_support: int = MIN_SUPPORT, smoothing: float = SMOOTHING,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and the url's ``template``."""
    host, path = parsed(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    urls = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).withColumn("fit", fitting(F.col("host"), F.col("path"), rules))
    known = cut_lineage(templates(cut_lineage(urls), min_support))  # read by every count below

    blocked = F.sum(F.when(F.col("fit.verdict") == "block", F.col("n")).otherwise(0)).alias("blocked")
    labelled = F.sum(F.when(F.col("fit").isNotNull(), F.col("n")).otherwise(0)).alias("labelled")
    branches = known.groupBy("host", "node", "template").agg(blocked, labelled)
    nodes = branches.groupBy("host", "node").agg(F.sum("blocked").alias("node_blocked"), F.sum("labelled").alias("node_labelled"))
    hosts = nodes.groupBy("host").agg(F.sum("node_blocked").alias("host_blocked"), F.sum("node_labelled").alias("host_labelled"))
    whole = hosts.agg(F.sum("host_blocked"), F.sum("host_labelled")).first()
    share = (whole[0] or 0) / whole[1] if whole[1] else 0.0

    weight = F.lit(float(smoothing))
    own_share = F.col("node_blocked") / F.greatest(F.col("node_labelled"), F.lit(1))
    expected = F.col("labelled") * own_share
    chance = NORMAL * F.sqrt(expected * (1 - own_share)) + 0.5
    similar = F.abs(F.col("blocked") - expected) <= chance
    host_share = (F.col("host_blocked") + weight * F.lit(share)) / (F.col("host_labelled") + weight)
    taken = lambda merged, alone: F.when(similar, F.col(merged)).otherwise(F.col(alone))
    purity = (taken("node_blocked", "blocked") + weight * host_share) / (taken("node_labelled", "labelled") + weight)
    judged = branches.join(nodes, ["host", "node"]).join(hosts, "host").select(
        "host", "template", F.when(purity >= 0.5, "block").otherwise("allow").alias("judged")
    )
    decided = known.join(judged, ["host", "template"], "left").select("host", "path", "template", "judged")
    fit = fitting(F.col("host"), F.col("path"), rules)
    return rows.join(decided, ["host", "path"], "left").select(
        "page_id", "host", "path", fit["rule"].alias("rule"), F.coalesce(fit["verdict"], F.col("judged")).alias("verdict"), written(F.col("template")).alias("template"),
    )


def oracle() -> str:
    def case(value: int) -> str:
        whens = []
        for rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
            own, _, rest = rule[1].partition("/")
            whens.append(f"WHEN (host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '/{rest}') THEN '{rule[value]}'")
        return f"CASE {' '.join(whens)} END"

    return f"""
    WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split_ AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
    rows_ AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split_),
    urls AS (SELECT host, path, count(*) AS n FROM rows_ GROUP BY ALL),
    lists AS (SELECT host, path, n, list_filter(string_split(path, '/'), lambda s: s <> '') AS names FROM urls),
    parts AS (SELECT host, path, n, unnest(names) AS segment, generate_subscripts(names, 1) AS depth FROM lists),
    counted AS (SELECT host, depth, segment, sum(n) AS support FROM parts GROUP BY ALL),
    totals AS (SELECT host, depth, sum(support) AS total, count(*) AS kinds FROM counted GROUP BY ALL),
    fixed AS (SELECT host, depth, segment FROM counted JOIN totals USING (host, depth) WHERE support >= {MIN_SUPPORT} AND support * kinds * {LEAST_SHARE} >= total),
    marked AS (
        SELECT p.host, p.path, p.depth, f.segment AS name, max(CASE WHEN f.segment IS NOT NULL THEN p.depth END) OVER (PARTITION BY p.host, p.path) AS last
        FROM parts p LEFT JOIN fixed f ON f.host = p.host AND f.depth = p.depth AND f.segment = p.segment
    ),
    spelled AS (
        SELECT host, path, '/' || string_agg(coalesce(name, ''), '/' ORDER BY depth) AS template,
            '/' || string_agg(CASE WHEN depth = last THEN '' ELSE coalesce(name, '') END, '/' ORDER BY depth) AS node
        FROM marked GROUP BY host, path
    ),
    known AS (
        SELECT u.host, u.path, u.n, coalesce(template, '') AS template, coalesce(node, '') AS node, {case(0).replace("host", "u.host").replace("path", "u.path")} AS fit
        FROM urls u LEFT JOIN spelled s ON s.host = u.host AND s.path = u.path
    ),
    branches AS (
        SELECT host, node, template, sum(CASE WHEN fit = 'block' THEN n ELSE 0 END) AS blocked, sum(CASE WHEN fit IS NOT NULL THEN n ELSE 0 END) AS labelled
        FROM known GROUP BY host, node, template
    ),
    nodes AS (SELECT host, node, sum(blocked) AS node_blocked, sum(labelled) AS node_labelled FROM branches GROUP BY host, node),
    hosts AS (SELECT host, sum(blocked) AS host_blocked, sum(labelled) AS host_labelled FROM branches GROUP BY host),
    whole AS (SELECT CASE WHEN sum(labelled) > 0 THEN CAST(sum(blocked) AS DOUBLE) / sum(labelled) ELSE 0.0 END AS share FROM branches),
    shares AS (
        SELECT *, CAST(node_blocked AS DOUBLE) / greatest(node_labelled, 1) AS own_share,
            (host_blocked + CAST({SMOOTHING} AS DOUBLE) * (SELECT share FROM whole)) / (host_labelled + CAST({SMOOTHING} AS DOUBLE)) AS host_share
        FROM branches JOIN nodes USING (host, node) JOIN hosts USING (host)
    ),
    compared AS (
        SELECT *, abs(blocked - labelled * own_share) <= CAST({NORMAL} AS DOUBLE) * sqrt(labelled * own_share * (1 - own_share)) + CAST(0.5 AS DOUBLE) AS alike FROM shares
    ),
    judged AS (
        SELECT host, template, CASE WHEN ((CASE WHEN alike THEN node_blocked ELSE blocked END) + CAST({SMOOTHING} AS DOUBLE) * host_share)
            / ((CASE WHEN alike THEN node_labelled ELSE labelled END) + CAST({SMOOTHING} AS DOUBLE)) >= 0.5 THEN 'block' ELSE 'allow' END AS judged
        FROM compared
    )
    SELECT r.page_id, r.host, r.path, {case(1).replace("host", "r.host").replace("path", "r.path")} AS rule,
        coalesce(k.fit, j.judged) AS verdict,
        CASE WHEN k.template = '' THEN '/' ELSE '/' || array_to_string([CASE WHEN s = '' THEN '*' ELSE s END FOR s IN string_split(substr(k.template, 2), '/')], '/') END AS template
    FROM rows_ r JOIN known k ON k.host = r.host AND k.path = r.path JOIN judged j ON j.host = k.host AND j.template = k.template
    """
