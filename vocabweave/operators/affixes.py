"""Lookups by the beginning, end or inside of a text, in maps of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.codes import standardize_code


def map_rows(table: DataFrame, key: str, value: str, ord: str = "ord") -> DataFrame:
    """(key, value, ord) of a map table, whose order decides between several hits."""
    return table.select(F.col(key).alias("key"), F.col(value).alias("value"), F.col(ord).alias("ord"))


def _pieces(text: Column, lengths: list[int], kind: str) -> Column:
    """Beginnings, ends or all parts of ``text`` that have one of the lengths."""
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(text))
    if kind == "prefix":
        return F.transform(fitting, lambda n: F.substring(text, F.lit(1), n))
    if kind == "suffix":
        return F.transform(fitting, lambda n: F.substring(text, F.length(text) - n + 1, n))
    parts = lambda n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n))
    return F.array_distinct(F.flatten(F.transform(fitting, parts)))


def affix_join(texts: DataFrame, column: str, keys: DataFrame, name: str, kind: str = "suffix", last: bool = False) -> DataFrame:
    """``texts`` with ``name``: the value of the first (or last) key that ``column`` ends with, starts with or holds.

    ``kind`` is suffix, prefix or inside. Each distinct text is spelled out as its pieces of the
    lengths that keys have, and the pieces meet the keys in an equi-join; so neither the map nor
    the texts are broadcast or compared pair by pair. The lengths are as many as the longest key has
    characters at most. Empty and null keys are never found; a text without a key gets null.
    """
    best = F.max if last else F.min
    usable = keys.where("key <> ''").groupBy("key").agg(best(F.struct("ord", "value")).alias("hit"))
    lengths = sorted(r[0] for r in usable.select(F.length("key")).distinct().collect())
    if not lengths:
        return texts.withColumn(name, F.lit(None).cast(keys.schema["value"].dataType))
    spelled = texts.select(F.col(column).alias("_text")).dropna().distinct()
    pieces = spelled.select("_text", F.explode(_pieces(F.col("_text"), lengths, kind)).alias("key"))
    found = pieces.join(usable, "key").groupBy("_text").agg(best("hit").alias("_hit"))
    joined = texts.join(found, texts[column] == found["_text"], "left")
    return joined.select(*[texts[c] for c in texts.columns if c != name], F.col("_hit.value").alias(name))


def standardize_codes(codes: DataFrame, column: str, sab: str, prefixes: DataFrame, name: str = "code", as_coded: bool = False) -> DataFrame:
    """``codes`` with the standard form of ``column`` as ``name``, by a prefix map of any size (key, value, ord)."""
    held = affix_join(codes, column, prefixes, "_source", "inside", last=True)
    spelled = held.withColumn(name, standardize_code(F.col(column), sab, as_coded, prefix=F.col("_source")))
    return spelled.drop("_source")
