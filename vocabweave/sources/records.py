"""Records of delimited text whose quoted cells hold line breaks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocabweave.session import cut_lineage

#: A quote that stays open for more lines than this is a fault of the text: its lines then stand by themselves.
MAX_LINES = 10_000


def _open_at_end(line: Column, sep: str, quote: str) -> tuple[Column, Column]:
    """Whether a quote is open after ``line``, if none was before it and if one was.

    A quote opens a cell only at its front; a run of quotes counts as one or none, as pairs of them are text.
    """
    q, start = re.escape(quote), f"(^|{re.escape(sep)}){re.escape(quote)}"
    single = F.regexp_replace(line, f"{q}{q}", "")
    opens = lambda text: F.regexp_replace(text, f"{start}[^{q}]*{q}", "$1.").rlike(start)
    closed = F.instr(single, quote)
    after = F.concat(F.lit("."), F.substring(single, closed + 1, F.length(single)))
    return opens(single), F.when(closed == 0, True).otherwise(opens(after))


def quoted_records(lines: DataFrame, sep: str, quote: str, skip_rows: int = 0, comment: str | None = None, max_lines: int = MAX_LINES) -> DataFrame:
    """``lines`` (value, _file, _split, _line, ord) as records (value, _file, _line, ord), those of one cell joined by line feeds.

    A line maps "a quote is open before it" to "one is open after it": it sets it, clears it, keeps
    it or turns it. Such maps are composed within each split, then over the splits of a file (one
    row each), which gives the state before every line without reading a file in one task. Only
    lines of records that span several are shuffled. Of a record of more than ``max_lines``
    lines each line is a record. The first ``skip_rows`` lines of a file hold no quotes.
    """
    plain = F.col("_line") < skip_rows
    opened, kept = _open_at_end(F.col("value"), sep, quote)
    if comment:
        opened = opened & ~F.startswith("value", F.lit(comment))
    maps = lines.withColumn("_opened", ~plain & opened).withColumn("_kept", ~plain & kept)
    maps = maps.withColumn("_turn", (F.col("_opened") & ~F.col("_kept")).cast("int"))

    split = Window.partitionBy("_file", "_split").orderBy("ord")
    fixed = F.when(F.col("_opened") == F.col("_kept"), F.struct(F.col("_opened").cast("int").alias("to"), F.col("_turns").alias("at")))
    mapped = maps.withColumn("_turns", F.sum("_turn").over(split)).withColumn("_fixed", F.last(fixed, ignorenulls=True).over(split))
    # all lines up to this one as one map: what they set, if they set anything, and whether they turn it
    mapped = cut_lineage(mapped.select(
        "value", "_file", "_split", "_line", "ord", F.col("_opened").cast("int").alias("_opened"), F.col("_kept").cast("int").alias("_kept"),
        F.col("_fixed.to").alias("_to"), ((F.col("_turns") - F.coalesce("_fixed.at", F.lit(0))) % 2).alias("_odd"),
    ))

    last = mapped.groupBy("_file", "_split").agg(F.max_by(F.struct("_to", "_odd"), "ord").alias("m"))
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("_file", "_split", F.col("m._to").alias("_to"), F.col("m._odd").alias("_odd"))
    turn = F.when(F.col("_to").isNull(), F.col("_odd")).otherwise(0)
    last = last.withColumn("_sum", F.sum(turn).over(Window.partitionBy("_file").orderBy("_split")))
    set_by = F.last(F.when(F.col("_to").isNotNull(), F.struct(((F.col("_to") + F.col("_odd")) % 2).alias("to"), F.col("_sum").alias("at"))), ignorenulls=True).over(earlier)
    last = last.withColumn("_set", set_by).withColumn("_before", F.coalesce(F.sum(turn).over(earlier), F.lit(0)))
    state = (F.coalesce("_set.to", F.lit(0)) + F.col("_before") - F.coalesce("_set.at", F.lit(0))) % 2
    entry = last.select("_file", "_split", state.alias("_entry"))

    after = (F.coalesce("_to", "_entry") + F.col("_odd")) % 2
    known = mapped.join(F.broadcast(entry), ["_file", "_split"]).withColumn("_after", after)
    known = known.withColumn("_open", F.coalesce(F.lag("_after").over(split), F.col("_entry")))
    columns = ["value", "_file", "_line", "ord"]
    whole = known.where("_open = 0 AND _after = 0").select(columns)

    pieces = known.where("_open = 1 OR _after = 1").withColumn("_start", F.when(F.col("_open") == 0, F.col("ord")))
    pieces = pieces.withColumn("_start", F.last("_start", ignorenulls=True).over(split))
    ends = pieces.groupBy("_file", "_split").agg(F.max("_start").alias("_start"))
    carried = ends.select("_file", "_split", F.last("_start", ignorenulls=True).over(earlier).alias("_carried"))
    pieces = pieces.join(F.broadcast(carried), ["_file", "_split"]).withColumn("_start", F.coalesce("_start", "_carried"))
    pieces = cut_lineage(pieces.select(*columns, "_start"))
    sizes = pieces.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_lines).select("_file", "_start")
    if not sizes.isEmpty():
        whole = whole.unionByName(pieces.join(sizes, ["_file", "_start"], "left_semi").select(columns))
        pieces = pieces.join(sizes, ["_file", "_start"], "left_anti")
    joined = pieces.groupBy("_file", "_start").agg(F.sort_array(F.collect_list(F.struct("ord", "_line", "value"))).alias("_parts"))
    spanning = joined.select(F.array_join("_parts.value", "\n").alias("value"), "_file", F.col("_parts")[0]["_line"].alias("_line"), F.col("_start").alias("ord"))
    return whole.unionByName(spanning.select(columns))
