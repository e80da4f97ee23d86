"""Text cells: lists, key-value columns, brackets, parentheses, defaults."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings of a missing value.
NULL_LIKE = ["None", "nan"]


def pipe_split(cell: Column) -> Column:
    """Pipe list to array; a blank or missing cell gives one blank item."""
    return F.split(F.coalesce(cell, F.lit("")), r"\|")


def standardize_synonym(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9._ ]", "_")


def standardize_synonyms(synonyms: Column) -> Column:
    return F.transform(synonyms, standardize_synonym)


def blank_if_null_like(text: Column) -> Column:
    return F.when(text.isNull() | text.isin(NULL_LIKE), F.lit("")).otherwise(text)


def default_label(label: Column, node_id: Column) -> Column:
    return F.coalesce(label, node_id)


def blank_to_int(text: Column) -> Column:
    """Whole number of a text such as ``3.0``; blank stays missing."""
    return F.nullif(text, F.lit("")).try_cast("double").cast("int")


def number_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def parse_list_cell(cell: Column) -> Column:
    """Array from a list literal such as ``['a', 'b']``; anything else gives an empty one."""
    return F.coalesce(
        F.from_json(cell, "array<string>", {"allowSingleQuotes": "true"}),
        F.array().cast("array<string>"),
    )


def list_or_scalar(value: Column) -> Column:
    """JSON list to array; anything else, also text that only begins like a list, becomes a one-item array."""
    text = F.trim(value)
    return F.when(text.startswith("["), F.coalesce(F.from_json(text, "array<string>"), F.array(value))).otherwise(F.array(value))


def first_word(text: Column) -> Column:
    return F.split_part(text, F.lit(" "), F.lit(1))


def strip_marker(label: Column, marker: str = "_vitessce_hint") -> Column:
    return F.substring_index(label, marker, 1)


def bracket_ids(cell: Column) -> Column:
    """Ids in the last square brackets of each item of a ``;`` list."""
    items = F.filter(F.split(cell, ";"), lambda item: item.contains("["))
    return F.transform(items, lambda item: F.substring_index(F.substring_index(item, "[", -1), "]", 1))


def tidy_key_values(cell: Column) -> Column:
    """Key-value cell with ``; `` before every key."""
    spaced = F.replace(F.replace(F.ltrim(cell), F.lit(";"), F.lit("; ")), F.lit(";  "), F.lit("; "))
    even = F.when(spaced.contains(";  "), F.regexp_replace(spaced, r";\s+", "; ")).otherwise(spaced)
    return F.concat(F.lit("; "), even)


def key_value_pieces(tidy: Column) -> Column:
    """Pieces of a tidy cell, one per key; cut once, they serve all keys."""
    return F.split(tidy, ";")


def values_in_pieces(pieces: Column, key: str) -> Column:
    """Values of ``key`` in the pieces of a tidy cell, unquoted and comma-joined in order; blank when absent."""
    mark = f" {key} "

    def value(piece: Column) -> Column:
        return F.trim(F.replace(F.substring(piece, len(mark) + 1, 2**31 - 1), F.lit('"'), F.lit("")))

    found = F.filter(pieces, lambda piece: piece.startswith(mark))
    return F.array_join(F.transform(found, value), ",")


def values_of_key(tidy: Column, key: str) -> Column:
    """Values of one ``key`` in a tidy cell."""
    return values_in_pieces(key_value_pieces(tidy), key)


def parenthesis_groups(text: Column) -> Column:
    """``(level, content)`` of every closed parenthesis group, in the order they close.

    The scan keeps the start of each open group; level 0 is outermost.
    """
    empty = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<int>").alias("open"),
        F.array().cast("array<struct<level:int,content:string>>").alias("groups"),
    )

    def step(state: Column, char: Column) -> Column:
        at = state["at"] + 1
        opened = state["open"]
        depth = F.size(opened)
        closes = (char == ")") & (depth > 0)
        start = F.try_element_at(opened, F.lit(-1))
        group = F.struct(
            (depth - 1).alias("level"), text.substr(start + 1, at - start - 1).alias("content")
        )
        return F.struct(
            at.alias("at"),
            F.when(char == "(", F.array_append(opened, at))
            .when(closes, F.slice(opened, F.lit(1), F.greatest(depth - 1, F.lit(0))))
            .otherwise(opened)
            .alias("open"),
            F.when(closes, F.array_append(state["groups"], group)).otherwise(state["groups"]).alias("groups"),
        )

    return F.aggregate(F.split(text, ""), empty, step, lambda state: state["groups"])


def recommended_name(text: Column) -> Column:
    """First non-blank piece of a name before any parenthesis, trimmed."""
    pieces = F.filter(F.split(text, "[()]"), lambda piece: F.trim(piece) != "")
    return F.trim(F.get(pieces, F.lit(0)))


def outer_groups(text: Column) -> Column:
    outer = F.filter(parenthesis_groups(text), lambda group: group["level"] == 0)
    return F.transform(outer, lambda group: group["content"])


def first_column(df: DataFrame, names: Sequence[str], default: str = "None") -> Column:
    """First of ``names`` that ``df`` has, with ``default`` for missing values."""
    for name in names:
        if name in df.columns:
            value = F.col(f"`{name}`")
            return F.when(value.isNull() | (value == "nan"), F.lit(default)).otherwise(value)
    return F.lit(default)


def custom_values(df: DataFrame, base: Sequence[str]) -> dict[str, Column]:
    """All columns outside ``base``, as text; they may pass joins as they are and become a map behind them."""
    return {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns if name not in base}


def props_map(values: dict[str, Column]) -> Column:
    if not values:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.create_map(*[item for name, value in values.items() for item in (F.lit(name), value)])


def custom_props(df: DataFrame, base: Sequence[str]) -> Column:
    """Map of all columns outside ``base``, as text."""
    return props_map(custom_values(df, base))
