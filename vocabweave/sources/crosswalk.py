"""Cell annotation crosswalks and three-level part tables to edges and nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabweave.functions.codes import iri_to_curie, numbered_id, rooms
from vocabweave.operators.keyed import dense_number, first_per_key
from vocabweave.sources.tables import union_sources


def _constant_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in names))


def _parent_nodes(spark: SparkSession, parents: list[tuple[str, str]]) -> DataFrame:
    rows = [(code, term, "", "", "") for code, term in parents]
    return _constant_rows(spark, rows, ["node_id", "node_label", "node_definition", "node_synonyms", "node_dbxrefs"])


# ---- crosswalk: annotation -> organ level ------------------------------------------------

# Ids of the parent nodes.
CROSSWALK_PARENTS = [("0000000", ""), ("1000000", "_organ_level"), ("2000000", "_cell_annotation")]


def organ_levels(crosswalk: DataFrame, sab: str) -> DataFrame:
    """(Organ_Level, Organ_ID, level_id): levels numbered by first occurrence; too many are an error."""
    firsts = first_per_key(crosswalk.select("Organ_Level", "Organ_ID", "ord"), ["Organ_Level"], ["ord", "Organ_ID"])
    numbered = dense_number(firsts, ["ord", "Organ_Level"], "n")
    first = int(CROSSWALK_PARENTS[1][0])
    room = int(CROSSWALK_PARENTS[2][0]) - first
    return numbered.select(
        "Organ_Level", "Organ_ID", F.concat(F.lit(f"{sab}:"), numbered_id(first, F.col("n"), room).cast("string")).alias("level_id")
    )


def crosswalk_edges(crosswalk: DataFrame, sab: str, levels: DataFrame | None = None) -> DataFrame:
    levels = organ_levels(crosswalk, sab) if levels is None else levels
    root, level_parent, cell_parent = (f"{sab}:{code}" for code, _ in CROSSWALK_PARENTS)
    fixed = _constant_rows(
        crosswalk.sparkSession, [(level_parent, "isa", root), (cell_parent, "isa", root)], ["subject", "predicate", "object"]
    )
    of_levels = levels.select(
        F.col("level_id").alias("subject"),
        F.explode(F.array(
            F.struct(F.lit("isa").alias("predicate"), F.lit(level_parent).alias("object")),
            F.struct(F.lit("part_of").alias("predicate"), F.col("Organ_ID").alias("object")),
        )).alias("e"),
    ).select("subject", "e.*")
    cells = crosswalk.where("coalesce(Annotation_Label_ID, '') <> '' AND coalesce(Organ_ID, '') <> ''").select("Annotation_Label_ID", "Organ_Level")
    placed = cells.join(levels.select("Organ_Level", "level_id"), ["Organ_Level"])
    of_cells = placed.select(
        F.col("Annotation_Label_ID").alias("subject"),
        F.explode(F.array(
            F.struct(F.lit("isa").alias("predicate"), F.lit(cell_parent).alias("object")),
            F.struct(F.lit("located_in").alias("predicate"), F.col("level_id").alias("object")),
        )).alias("e"),
    ).select("subject", "e.*")
    return union_sources([fixed, of_levels, of_cells])


def crosswalk_nodes(crosswalk: DataFrame, sab: str, levels: DataFrame | None = None) -> DataFrame:
    levels = organ_levels(crosswalk, sab) if levels is None else levels
    parents = _parent_nodes(crosswalk.sparkSession, [(f"{sab}:{code}", f"{sab}{suffix}") for code, suffix in CROSSWALK_PARENTS])
    blank = F.lit("")
    of_levels = levels.select(
        F.col("level_id").alias("node_id"), F.concat(F.lit(f"{sab}_"), F.col("Organ_Level")).alias("node_label"),
        blank.alias("node_definition"), blank.alias("node_synonyms"), blank.alias("node_dbxrefs"),
    )
    label = F.trim("Annotation_Label")
    cells = crosswalk.where("coalesce(Annotation_Label_ID, '') <> ''").select(
        F.trim("Annotation_Label_ID").alias("node_id"),
        F.concat_ws("_", F.lit(sab), F.trim("Organ_Level"), label).alias("node_label"),
        blank.alias("node_definition"), label.alias("node_synonyms"), F.trim("CL_ID").alias("node_dbxrefs"),
    )
    return union_sources([parents, of_levels, cells])


# ---- hierarchy: organ -> unit -> part ----------------------------------------------------

# Label column, IRI column, id offset, label suffix of each level's parent.
HIERARCHY_LEVELS = [
    ("organ_label", "organ_iri", 100000, "organ"),
    ("ftu_label", "ftu_iri", 200000, "ftu"),
    ("ftu_part_label", "ftu_part_iri", 300000, "ftu_part"),
]
HIERARCHY_ORDER = ["organ_label", "ftu_label", "ftu_part_label"]


def hierarchy_entities(table: DataFrame, sab: str, levels: list[tuple] = HIERARCHY_LEVELS) -> list[DataFrame]:
    """Per level (label, iri, id): the id counts from the level's offset by the file row of
    the label's first row in sorted order. More rows than numbers up to the next offset are an error."""
    rows = dense_number(table, ["ord"], "row_number")
    entities = []
    room = rooms([offset for _, _, offset, _ in levels])
    for label, iri, offset, _ in levels:
        first = first_per_key(rows, [label], [*HIERARCHY_ORDER, "row_number"])
        entities.append(first.select(
            label, F.col(iri).alias("iri"), F.concat(F.lit(f"{sab}:"), numbered_id(offset, F.col("row_number"), room[offset]).cast("string")).alias("id")
        ))
    return entities


def hierarchy_edges(
    table: DataFrame, sab: str, entities: list[DataFrame] | None = None, levels: list[tuple] = HIERARCHY_LEVELS
) -> DataFrame:
    """``isa`` of parents and entities; distinct organ-unit and unit-part links."""
    entities = hierarchy_entities(table, sab, levels) if entities is None else entities
    parents = [f"{sab}:{offset}" for _, _, offset, _ in levels]
    root = f"{sab}:000000"
    parts = [_constant_rows(table.sparkSession, [(p, "isa", root) for p in parents], ["subject", "predicate", "object"])]
    for entity, parent in zip(entities, parents):
        parts.append(entity.select(F.col("id").alias("subject"), F.lit("isa").alias("predicate"), F.lit(parent).alias("object")))
    for (upper, lower), predicate in zip(((0, 1), (1, 2)), ("has_ftu", "has_ftu_part")):
        up, low = levels[upper][0], levels[lower][0]
        pairs = table.select(up, low).distinct()
        named = pairs.join(entities[upper].select(up, F.col("id").alias("subject")), [up])
        named = named.join(entities[lower].select(low, F.col("id").alias("object")), [low])
        parts.append(named.select("subject", F.lit(predicate).alias("predicate"), "object").distinct())
    return union_sources(parts)


def hierarchy_nodes(
    table: DataFrame, sab: str, entities: list[DataFrame] | None = None, levels: list[tuple] = HIERARCHY_LEVELS
) -> DataFrame:
    entities = hierarchy_entities(table, sab, levels) if entities is None else entities
    parents = [(f"{sab}:000000", sab)] + [(f"{sab}:{offset}", f"{sab} {name}") for _, _, offset, name in levels]
    blank = F.lit("")
    parts = [_parent_nodes(table.sparkSession, parents)]
    for entity, (label, *_) in zip(entities, levels):
        parts.append(entity.select(
            F.col("id").alias("node_id"), F.col(label).alias("node_label"), blank.alias("node_definition"),
            blank.alias("node_synonyms"), iri_to_curie(F.col("iri")).alias("node_dbxrefs"),
        ))
    return union_sources(parts)
