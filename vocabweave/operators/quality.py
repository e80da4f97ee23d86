"""Data-quality rules of a graph: one row per rule with the number of rows that break it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabweave.sources.tables import CODEREL_KEYS, NODE_KINDS

CORE_LABELS = list(NODE_KINDS)

# Formats that labels and codes must have.
NODE_LABEL_FORMAT = "^[A-Z]+.*"
REL_LABEL_FORMAT = "^[a-z][a-z0-9_]*$"
CODE_FORMAT = "^[A-Za-z0-9._-]+:[A-Za-z0-9._-]+( CUI)?$"

REQUIRED = {
    "sources": ["id", "name", "sab"],
    "node_labels": ["id", "node_label", "sab", "def"],
    "rel_labels": ["id", "rel_label", "sab", "def"],
    "concepts": ["id", "pref_term", "sab"],
}


def broken(rules: dict[str, Column], table: DataFrame) -> DataFrame:
    """Counts of rows for which a rule's condition (true = broken) holds, in one pass."""
    counts = table.agg(*[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n_broken")


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def label_rules(nodes: DataFrame) -> DataFrame:
    """``labels`` holds exactly one core label, others only on concepts, none twice."""
    core = F.filter("labels", lambda label: label.isin(CORE_LABELS))
    return broken(
        {
            "one_core_label": F.size(core) != 1,
            "extra_only_on_concept": (F.size("labels") > F.size(core)) & ~F.array_contains("labels", "Concept"),
            "labels_unique": F.size(F.array_distinct("labels")) < F.size("labels"),
        },
        nodes,
    )


def id_rules(tables: dict[str, DataFrame]) -> DataFrame:
    """Ids of all kinds but terms hold a colon; terms have an id."""
    parts = [
        broken({f"{name}_id_colon": ~F.coalesce(F.col("id"), F.lit("")).contains(":")}, tables[name])
        for name in REQUIRED
    ]
    return _all([*parts, broken({"terms_id": blank("id")}, tables["terms"])])


def required_rules(tables: dict[str, DataFrame]) -> DataFrame:
    return _all([
        broken({f"{name}_{column}_required": blank(column) for column in columns}, tables[name])
        for name, columns in REQUIRED.items()
    ])


def pattern_rules(tables: dict[str, DataFrame]) -> DataFrame:
    """Formats of labels; a source abbreviation holds no colon."""
    parts = [
        broken({"node_label_format": ~F.col("node_label").rlike(NODE_LABEL_FORMAT)}, tables["node_labels"]),
        broken({"rel_label_format": ~F.col("rel_label").rlike(REL_LABEL_FORMAT)}, tables["rel_labels"]),
    ]
    parts += [broken({f"{name}_sab_colon": F.col("sab").contains(":")}, tables[name]) for name in REQUIRED]
    return _all(parts)


def link_rules(coderels: DataFrame, rels: DataFrame) -> DataFrame:
    colon = lambda name: F.coalesce(F.col(name), F.lit("")).contains(":")
    return _all([
        broken(
            {
                "coderel_sab": blank("sab"), "coderel_codeid": ~colon("codeid"), "coderel_tty": blank("tty"),
                "coderel_start": ~colon("start_id"),
            },
            coderels,
        ),
        broken({"rel_sab": blank("sab"), "rel_start": ~colon("start_id"), "rel_end": ~colon("end_id")}, rels),
    ])


def dependent_rules(links: DataFrame) -> DataFrame:
    """A value, bound or unit needs an attribute."""
    has = lambda key: F.coalesce(F.col("props")[key], F.lit("")) != ""
    return broken(
        {f"{key}_needs_attribute": has(key) & ~has("attribute") for key in ("value", "lowerbound", "upperbound", "unit")},
        links,
    )


def unique_rules(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows beyond the first of each id or link; at least two nodes and one link."""
    def repeats(name: str, table: DataFrame, keys: list[str]) -> DataFrame:
        groups = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_broken")).select(
            F.lit(f"{name}_unique").alias("rule"), "n_broken"
        )

    parts = [repeats(name, tables[name], ["id"]) for name in NODE_KINDS.values()]
    parts.append(repeats("rels", tables["rels"], ["label", "start_id", "end_id", "sab"]))
    parts.append(repeats("coderels", tables["coderels"], ["start_id", "end_id", *CODEREL_KEYS]))

    def at_least(rule: str, names: list[str], least: int) -> DataFrame:
        counts = _all([tables[n].agg(F.count(F.lit(1)).alias("n")) for n in names]).agg(F.sum("n").alias("n"))
        return counts.select(F.lit(rule).alias("rule"), F.when(F.col("n") < least, 1).otherwise(0).cast("bigint").alias("n_broken"))

    parts.append(at_least("two_nodes", list(NODE_KINDS.values()), 2))
    parts.append(at_least("one_link", ["rels", "coderels"], 1))
    return _all(parts)


def code_format_rule(coderels: DataFrame) -> DataFrame:
    return broken({"codeid_format": ~F.col("codeid").rlike(CODE_FORMAT)}, coderels)


def check_graph(tables: dict[str, DataFrame]) -> DataFrame:
    """All rules over the tables of a graph."""
    links = tables["coderels"].select("props").unionByName(tables["rels"].select("props"))
    return _all([
        id_rules(tables), required_rules(tables), pattern_rules(tables),
        link_rules(tables["coderels"], tables["rels"]), dependent_rules(links),
        unique_rules(tables), code_format_rule(tables["coderels"]),
        label_rules(tables["concepts"].select("labels")),
    ])
