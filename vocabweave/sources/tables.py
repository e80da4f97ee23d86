"""Readers and writers of source tables and graph tables.

A source is an edge table (subject, predicate, object, any edge properties) and a node table
(node_id, node_label, node_definition, node_synonyms, node_dbxrefs, any node properties).
A graph is seven tables, one per kind of object. Order matters everywhere ("first wins"),
so every row carries its place: ``ord`` within a table, ``step`` for the ingest that added it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocabweave.functions.fixed_values import GTF_COLUMNS
from vocabweave.functions.text import blank_to_int, pipe_split
from vocabweave.operators.keyed import dense_number, first_per_key
from vocabweave.session import cut_lineage, shared_folder
from vocabweave.sources import versions
from vocabweave.sources.records import quoted_records

EDGE_COLUMNS = ["subject", "predicate", "object"]
NODE_COLUMNS = ["node_id", "node_label", "node_definition", "node_synonyms", "node_dbxrefs"]


@dataclass(frozen=True)
class Graph:
    """The seven tables of a concept graph."""

    sources: DataFrame
    node_labels: DataFrame
    rel_labels: DataFrame
    concepts: DataFrame
    terms: DataFrame
    coderels: DataFrame
    rels: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {field.name: getattr(self, field.name) for field in fields(self)}


GRAPH_SCHEMAS = {
    "sources": "id string, name string, description string, sab string, source_version string, "
    "source string, srl int, ttyl array<string>, step int, ord bigint",
    "node_labels": "id string, node_label string, def string, sab string, step int, ord bigint",
    "rel_labels": "id string, rel_label string, def string, sab string, step int, ord bigint",
    "concepts": "labels array<string>, id string, pref_term string, sab string, step int, ord bigint",
    "terms": "id string, step int, ord bigint",
    "coderels": "start_id string, end_id string, sab string, def string, codeid string, tty string, "
    "props map<string,string>, step int, ord bigint, pos bigint",
    "rels": "label string, start_id string, end_id string, sab string, props map<string,string>, "
    "step int, ord bigint",
}


def empty_graph(spark: SparkSession) -> Graph:
    return Graph(**{name: spark.createDataFrame([], schema) for name, schema in GRAPH_SCHEMAS.items()})


# ---- text tables -------------------------------------------------------------------------


PLACE = ["_file", "_block", "_row"]


def _placed(df: DataFrame) -> DataFrame:
    """``df``, straight from a file reader, with the file and place each row came from."""
    return df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")
    )


def in_file_order(placed: DataFrame, name: str = "ord", within: str | None = None) -> DataFrame:
    """Rows of ``_placed`` numbered from 0 by (file, place in it), and ``within`` each file too.

    Spark reads the splits of a folder in any order, but each from front to back. The rows are
    written once; one row per split gives the shift, so no row passes through a shuffle.
    """
    rows = cut_lineage(placed, spread=True)
    splits = rows.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = lambda *keys: F.coalesce(
        F.sum("_n").over(Window.partitionBy(*keys).orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    shifts = splits.select("_file", "_block", (before() - F.col("_first")).alias("_all"), (before("_file") - F.col("_first")).alias("_own"))
    numbered = rows.join(F.broadcast(shifts), ["_file", "_block"])
    columns = [c for c in placed.columns if c not in PLACE]
    extra = [(F.col("_row") + F.col("_own")).alias(within), "_file"] if within else []
    return numbered.select(*[f"`{c}`" for c in columns], *extra, (F.col("_row") + F.col("_all")).alias(name))


def read_text_table(
    spark: SparkSession, path: str | list[str], sep: str = "\t", header: bool = True,
    columns: Sequence[str] | None = None, comment: str | None = None, skip_malformed: bool = True,
    quote: str = '"', skip_rows: int = 0, source_file: str | None = None, line_breaks: bool = False,
) -> DataFrame:
    """Delimited text with every column a string, blanks for missing cells and a row order.

    ``path`` is a file, a folder or a list of them; rows are in order of file name and place.
    ``columns`` names the columns of a file without (or instead of) a header. ``skip_rows``
    lines are left out at the front of every file. Quoted cells may hold line breaks (read as line
    feeds) when rows are skipped or ``line_breaks`` is set, in files of any number of splits.
    ``source_file`` names a column for the file a row came from. ``.gz`` files are read as they
    are; one task unpacks such a file, and many read what it has written.
    """
    options = {
        "sep": sep, "quote": quote, "escape": quote or "\\", "encoding": "UTF-8", "mode": "DROPMALFORMED" if skip_malformed else "PERMISSIVE",
        **({"comment": comment} if comment else {}),
    }
    if skip_rows or line_breaks:
        placed = _placed(spark.read.text(path)).withColumn("_split", F.col("_block"))
        lines = in_file_order(placed, within="_line")
        if quote:
            lines = quoted_records(lines, sep, quote, skip_rows, comment)
        lines = lines.where((F.col("_line") >= skip_rows) & (F.trim("value") != ""))
        if comment:
            lines = lines.where(~F.startswith("value", F.lit(comment)))
        heads = lines.groupBy("_file").agg(F.min("ord").alias("_head"))
        names = columns or lines.join(F.broadcast(heads), "_file").where("ord = _head").orderBy("ord").first()["value"].split(sep)
        body = lines.join(F.broadcast(heads), "_file").where("ord > _head") if header else lines
        schema = ", ".join(f"`{name.strip().strip(quote)}` string" for name in names)
        parsed = {k: v for k, v in options.items() if k != "mode"} | {"columnNameOfCorruptRecord": "_broken"}
        rows = body.select(F.from_csv("value", schema + ", _broken string", parsed).alias("row"), "_file", "ord")
        if skip_malformed:
            rows = rows.where("row._broken IS NULL")
        table = rows.select("row.*", "_file", "ord").drop("_broken")
    else:
        reader = spark.read.options(**options).option("header", header)
        if columns:
            reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
        table = in_file_order(_placed(reader.csv(path)), within="_line").drop("_line")
    table = table.withColumnRenamed("_file", source_file) if source_file else table.drop("_file")
    table = table.select([F.col(f"`{name}`").alias(name.lstrip("\ufeff")) for name in table.columns])
    return table.na.fill("")


def read_source(spark: SparkSession, edge_path: str, node_path: str) -> tuple[DataFrame, DataFrame]:
    """Edge and node tables of a source; pipe lists become arrays."""
    edges = read_text_table(spark, edge_path)
    return edges, list_columns(read_text_table(spark, node_path))


def first_existing(spark: SparkSession, folder: str, names: Sequence[str]) -> str:
    """First of ``names`` that the folder holds."""
    present = {row.name for row in spark.read.format("binaryFile").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("name")).where(F.col("name").isin(list(names))).collect()}
    for name in names:
        if name in present:
            return f"{folder}/{name}"
    raise FileNotFoundError(f"none of {list(names)} in {folder}")


def list_columns(nodes: DataFrame) -> DataFrame:
    """Node table with its pipe-list cells as arrays; absent columns count as blank."""
    for name in ("node_definition", "node_synonyms", "node_dbxrefs"):
        if name not in nodes.columns:
            nodes = nodes.withColumn(name, F.lit(""))
    return nodes.withColumn("node_synonyms", pipe_split(F.col("node_synonyms"))).withColumn(
        "node_dbxrefs", pipe_split(F.col("node_dbxrefs"))
    )


def write_text_table(df: DataFrame, path: str, sep: str = "\t", header: bool = True, mode: str = "error") -> None:
    """Delimited text; array columns are written as pipe lists."""
    flat = [F.array_join(name, "|").alias(name) if kind.startswith("array") else F.col(name) for name, kind in df.dtypes]
    df.select(*flat).write.option("sep", sep).option("header", header).option("emptyValue", "").mode(mode).csv(path)


def scan_text_distinct(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Distinct rows of an unquoted text table, over-long rows cut to the header."""
    table = read_text_table(spark, path, sep, skip_malformed=False, quote="")
    return table.drop("ord").distinct()


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path, header=False, columns=GTF_COLUMNS, comment="#", quote="")


def union_sources(tables: Sequence[DataFrame]) -> DataFrame:
    """Tables of several organisms, species or files as one, columns matched by name."""
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table, allowMissingColumns=True)
    return whole


def widen_columns(df: DataFrame, names: Sequence[str], fill: str = "") -> DataFrame:
    """Add the missing ones of ``names`` as text columns holding ``fill``."""
    return df.select("*", *[F.lit(fill).alias(name) for name in names if name not in df.columns])


def field_count_check(lines: DataFrame, text: str, expected: int, sep: str = "\t") -> DataFrame:
    """Lines whose number of fields differs from ``expected``."""
    n_fields = F.length(text) - F.length(F.replace(F.col(text), F.lit(sep))) + 1
    return lines.withColumn("n_fields", n_fields.cast("bigint")).where(F.col("n_fields") != expected)


def read_lookup(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Small ordered map file; a byte-order mark before its header is dropped."""
    return read_text_table(spark, path, sep)


# ---- source registry ---------------------------------------------------------------------

REGISTRY_ENTRY = (
    "struct<source_type:string,name:string,description:string,version:string,owl_url:string,"
    "execute:string,execute_url:string,history:struct<download_size_mb:double,"
    "download_time_minutes:int,parse_time_seconds:int>>"
)


def source_registry(documents: DataFrame, text: str = "value") -> DataFrame:
    """Rows of a registry document that maps each source to its description."""
    entries = documents.select(F.explode(F.from_json(F.col(text), f"map<string,{REGISTRY_ENTRY}>")).alias("sab", "entry"))
    return entries.select("sab", "entry.*")


def registry_entry(registry: DataFrame, sab: str):
    """The row of one source; an unknown source is an error."""
    row = registry.where(F.col("sab") == sab).first()
    if row is None:
        raise KeyError(f"source {sab} is not in the registry")
    return row


def source_row(registry: DataFrame, sab: str) -> DataFrame:
    """Source node of a registered source."""
    entry = registry_entry(registry, sab)
    return registry.where(F.col("sab") == sab).select(
        F.lit(f"{sab.upper()}:{sab.upper()}").alias("id"),
        "name",
        "description",
        F.lit(sab.upper()).alias("sab"),
        F.col("version").alias("source_version"),
        (F.col("owl_url") if entry.source_type == "owl" else F.lit(None).cast("string")).alias("source"),
        F.lit(None).cast("int").alias("srl"),
        F.array(F.lit("PT"), F.lit("SY")).alias("ttyl"),
    )


# ---- graph as JSON lines -----------------------------------------------------------------

GRAPH_OBJECT = (
    "labels array<string>, label string, "
    "start struct<properties:struct<id:string>>, `end` struct<properties:struct<id:string>>, "
    "properties map<string,string>, step int, pos bigint"
)
NODE_KINDS = {"Source": "sources", "Node_Label": "node_labels", "Rel_Label": "rel_labels", "Concept": "concepts", "Term": "terms"}
CODEREL_KEYS = ["sab", "def", "codeid", "tty"]


def split_kinds(objects: DataFrame) -> DataFrame:
    """Adds ``kind``: the table that an object of the graph belongs to; unknown kinds fail."""
    kind = F.when(F.col("label") == "CODE", "coderels").when(F.col("label").isNotNull(), "rels")
    for name, table in NODE_KINDS.items():
        kind = kind.when(F.array_contains("labels", name), table)
    unknown = F.raise_error(F.concat(F.lit("object of unknown kind: "), F.to_json("labels")))
    return objects.withColumn("kind", kind.otherwise(unknown))


def graph_from_objects(objects: DataFrame) -> Graph:
    """Flat tables from graph objects (columns of GRAPH_OBJECT and ``ord``).

    The objects are parsed once and stored with one partition per kind; each table then
    reads only its own.
    """
    folder = shared_folder(objects.sparkSession, "graph-objects")
    split_kinds(objects).write.partitionBy("kind").parquet(folder)
    schema = objects.schema.add("kind", "string")
    split = objects.sparkSession.read.schema(schema).parquet(folder)

    def prop(name: str):
        return F.coalesce(F.col("properties")[name], F.lit("")).alias(name)

    def table(kind: str, *columns) -> DataFrame:
        return split.where(F.col("kind") == kind).select(*columns, "step", "ord")

    start, end = F.col("start.properties.id").alias("start_id"), F.col("`end`.properties.id").alias("end_id")

    def rest(*known: str):
        return F.map_filter("properties", lambda key, _: ~key.isin(list(known))).alias("props")

    return Graph(
        sources=table(
            "sources", prop("id"), prop("name"), prop("description"), prop("sab"), prop("source_version"),
            prop("source"), blank_to_int(F.col("properties")["srl"]).alias("srl"),
            F.from_json(F.col("properties")["ttyl"], "array<string>").alias("ttyl"),
        ),
        node_labels=table("node_labels", prop("id"), prop("node_label"), prop("def"), prop("sab")),
        rel_labels=table("rel_labels", prop("id"), prop("rel_label"), prop("def"), prop("sab")),
        concepts=table("concepts", "labels", prop("id"), prop("pref_term"), prop("sab")),
        terms=first_per_key(table("terms", prop("id")), ["id"], ["step", "ord"]),
        coderels=table(
            "coderels", start, end, *[prop(key) for key in CODEREL_KEYS], rest(*CODEREL_KEYS), "pos",
        ).select(*T.StructType.fromDDL(GRAPH_SCHEMAS["coderels"]).names),
        rels=table("rels", "label", start, end, prop("sab"), rest("sab")),
    )


def read_graph(spark: SparkSession, path: str) -> Graph:
    """Graph from JSON lines, one object per line, in order of file and line; the version in force, if ``path`` was overwritten."""
    objects = in_file_order(_placed(spark.read.schema(GRAPH_OBJECT).json(versions.current(spark, path)))).drop("section")
    return graph_from_objects(objects.na.fill(0, ["step", "pos"]))


def first_rows(table: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows by (step, ord); equal places are told apart by the whole row.

    Counts per step find the step in which the limit falls; earlier steps stay whole, and the
    rows of that step are numbered over range slices, so no task sees more than a slice.
    """
    step = F.coalesce("step", F.lit(-1))
    left, cut = limit, None
    for row in table.groupBy(step.alias("step")).count().orderBy("step").collect():  # one row per source
        if row["count"] > left:
            cut = row["step"]
            break
        left -= row["count"]
    if cut is None:
        return table
    # maps have no order; their entries do
    cells = [F.array_sort(F.map_entries(c)) if kind.startswith("map<") else F.col(c) for c, kind in table.dtypes if c not in ("step", "ord")]
    within = dense_number(table.where(step == cut).withColumn("_row", F.struct(*cells)), ["ord", "_row"], "_n") if left else table.where("false")
    kept = within.where(F.col("_n") <= left).drop("_n", "_row") if left else within
    return table.where(step < cut).unionByName(kept)


def sample_graph(graph: Graph, max_nodes: int = 0, max_rels: int = 0) -> Graph:
    """First ``max_nodes`` objects of all node tables and ``max_rels`` of both link tables; 0 is all."""

    def capped(names: list[str], limit: int) -> dict[str, DataFrame]:
        rows, left = {}, limit
        for name in names:
            table = getattr(graph, name)
            rows[name] = first_rows(table, left) if limit else table
            left = max(0, left - table.count()) if limit else 0
        return rows

    return replace(graph, **capped(list(NODE_KINDS.values()), max_nodes), **capped(["rels", "coderels"], max_rels))


def graph_objects(graph: Graph) -> DataFrame:
    """JSON text of every object, with the section and place it has in an ordered file."""
    def node(section: int, df: DataFrame, label, props: list) -> DataFrame:
        body = F.struct(label.alias("labels"), F.struct(*props).alias("properties"), "step")
        return df.select(F.lit(section).alias("section"), "step", "ord", F.to_json(body).alias("value"))

    def link(section: int, df: DataFrame, label, props: list[str], *places: str) -> DataFrame:
        end = lambda name: F.struct(F.struct(F.col(name).alias("id")).alias("properties"))
        known = F.create_map(*[item for p in props for item in (F.lit(p), F.coalesce(F.col(p), F.lit("")))])
        body = F.struct(
            label.alias("label"), end("start_id").alias("start"), end("end_id").alias("end"),
            F.map_concat(known, F.coalesce("props", F.from_json(F.lit("{}"), "map<string,string>"))).alias("properties"),
            "step", *places,
        )
        return df.select(F.lit(section).alias("section"), "step", "ord", F.to_json(body).alias("value"))

    def one(name: str):
        return F.array(F.lit(name))

    cols = lambda *names: [F.col(name) for name in names]
    return union_sources([
        node(1, graph.sources, one("Source"), cols("id", "name", "description", "sab", "source_version", "source", "srl", "ttyl")),
        node(2, graph.node_labels, one("Node_Label"), cols("id", "node_label", "def", "sab")),
        node(3, graph.rel_labels, one("Rel_Label"), cols("id", "rel_label", "def", "sab")),
        node(4, graph.concepts, F.col("labels"), cols("id", "pref_term", "sab")),
        node(5, graph.terms, one("Term"), cols("id")),
        link(6, graph.rels, F.col("label"), ["sab"]),
        link(7, graph.coderels, F.lit("CODE"), CODEREL_KEYS, "pos"),
    ])


def write_graph(graph: Graph, path: str, ordered: bool = False, overwrite: bool = False) -> None:
    """Graph as JSON lines: a folder per section, or one globally sorted set of files.

    ``overwrite`` writes a new version beside ``path`` and then names it in the manifest, so that
    ``read_graph`` of ``path`` gives the whole old graph until the whole new one is there, and
    ``graph`` may be what was read from ``path``. ``versions.remove_old`` clears what is left behind.
    """
    folder = versions.new_folder(path) if overwrite else path
    objects = graph_objects(graph)
    if ordered:
        objects.orderBy("section", "step", "ord").select("value").write.text(folder)
    else:
        objects.select("section", "value").write.partitionBy("section").text(folder)
    if overwrite:
        versions.publish(graph.rels.sparkSession, path, folder)


def save_graph(graph: Graph, path: str, mode: str = "error") -> None:
    """Graph tables as Parquet below a folder."""
    for name, table in graph.tables().items():
        table.write.mode(mode).parquet(f"{path}/{name}")


def load_graph(spark: SparkSession, path: str) -> Graph:
    return Graph(**{name: spark.read.parquet(f"{path}/{name}") for name in GRAPH_SCHEMAS})


def load_steps(spark: SparkSession, folder: str, steps: Sequence[int]) -> Graph:
    """Graph of the rows that the given steps have added below ``folder``."""
    paths = [step_folder(folder, step) for step in steps]
    return Graph(**{name: spark.read.schema(schema).parquet(*[f"{p}/{name}" for p in paths]) for name, schema in GRAPH_SCHEMAS.items()})


def load_moves(spark: SparkSession, folder: str, steps: Sequence[int]) -> DataFrame | None:
    """Moved concepts (step, old_cui, new_cui) of the steps that wrote any; None if no step did."""
    moves = []
    for step in steps:
        try:
            own = spark.read.schema("old_cui string, new_cui string").parquet(f"{step_folder(folder, step)}/moved")
        except AnalysisException:
            continue
        moves.append(own.withColumn("step", F.lit(step)))
    return union_sources(moves) if moves else None


def step_folder(folder: str, step: int) -> str:
    return f"{folder}/step={step:04d}"
