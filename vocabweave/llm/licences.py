"""Licence scan by sentence rules.

Texts are cut into sentences and lines, which are normalised (ASCII lower case, runs of anything but
letters a-z and digits as one blank, so that comment leaders vanish) and looked up among the known
licence sentences. A known sentence may also be wrapped: lines that follow one another with one
line end between them, and that hold its words one after the other, are one sentence; a blank line
ends it. The identifiers of a text's known sentences, in order, are matched against the licence
rules: a rule matches where its identifiers follow one another with at most ``GAP`` other sentences
or lines, known or not, between two of them, and ends as early as it can. A match that lies within
another one is left out; of equal matches the earlier rule counts.

The known sentences are a fixed table (under 200 rows, some ten thousand runs of their words), so
the lookup is a broadcast. Sentences are rows: a very long text is never one task's list. Null and
empty texts have no sentences; repeated rows are separate texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vocabweave.session import cut_lineage

GAP = 2

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = "[\\n\\r]+|[.!?;:]+([ \\t\\n\\r]+|$)"
OTHER = "[^a-z0-9]+"
#: A line end that alone parts two lines, and what marks the lines before and after it.
LINE_END = "([^.!?;:\\s][ \\t]*)(\\r\\n|\\n|\\r)(?![\\n\\r])"
GOES_ON, GONE_ON = "\x02", "\x01"

# Normalised sentences of public licences and of notices that refer to them.
SENTENCES = {
    "mit-ref": ["released under the mit license", "licensed under the mit license", "this software is released under the mit license", "spdx license identifier mit"],
    "mit-title": ["mit license", "the mit license", "the mit license mit"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "no-liability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "apache2-ref": ["licensed under the apache license version 2 0", "released under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "spdx license identifier apache 2 0"],
    "apache2-use": ["you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at"],
    "apache2-asis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "apache2-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "gpl3-ref": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3", "spdx license identifier gpl 3 0"],
    "gpl2-ref": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "released under the gnu general public license version 2", "spdx license identifier gpl 2 0"],
    "lgpl-ref": ["licensed under the gnu lesser general public license", "this work is licensed under the gnu lesser general public license version 3"],
    "agpl3-ref": ["licensed under the gnu affero general public license version 3", "this work is licensed under the gnu affero general public license version 3"],
    "gnu-free": ["this program is free software"],
    "gnu-any": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gnu-any2": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gnu-hope": ["this program is distributed in the hope that it will be useful but without any warranty", "without even the implied warranty of merchantability or fitness for a particular purpose"],
    "cc-by-ref": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa-ref": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc-ref": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-nd-ref": ["licensed under cc by nd 4 0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"],
    "cc0-ref": ["released under cc0 1 0", "licensed under cc0 1 0", "this work is dedicated to the public domain under cc0 1 0"],
    "bsd-redistribution": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-ref": ["licensed under the bsd license", "released under the bsd license", "use of this source code is governed by a bsd style license that can be found in the license file"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "mpl2-ref": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "reserved": ["all rights reserved"],
}
# Ordered rules, each the identifiers of its sentences.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "as-is", "no-liability"]),
    ("MIT", ["mit-title", "mit-grant", "mit-notice"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-ref"]),
    ("Apache-2.0", ["apache2-ref", "apache2-use", "apache2-copy", "apache2-asis", "apache2-see"]),
    ("Apache-2.0", ["apache2-ref", "apache2-use"]),
    ("Apache-2.0", ["apache2-ref"]),
    ("GPL-3.0-or-later", ["gnu-free", "gnu-any", "gnu-hope"]),
    ("GPL-3.0-or-later", ["gnu-any"]),
    ("GPL-2.0-or-later", ["gnu-free", "gnu-any2", "gnu-hope"]),
    ("GPL-2.0-or-later", ["gnu-any2"]),
    ("GPL-3.0", ["gpl3-ref"]),
    ("GPL-2.0", ["gpl2-ref"]),
    ("LGPL", ["lgpl-ref"]),
    ("AGPL-3.0", ["agpl3-ref"]),
    ("CC-BY-4.0", ["cc-by-ref"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-ref"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-ref"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-ref"]),
    ("CC0-1.0", ["cc0-ref"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("BSD", ["bsd-ref"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense"]),
    ("MPL-2.0", ["mpl2-ref"]),
    ("all rights reserved", ["reserved"]),
]
LONGEST = max(len(sequence) for _, sequence in RULES)


def _runs(sentences: dict[str, list[str]]) -> list[tuple]:
    """Every run of words (from a to b) of every known sentence."""
    out = []
    for number, (name, sentence) in enumerate((name, s) for name, own in sentences.items() for s in own):
        words = sentence.split()
        out += [(" ".join(words[a:b]), number, name, a, b, len(words)) for a in range(len(words)) for b in range(a + 1, len(words) + 1)]
    return out


def _wrapped(lines: DataFrame) -> DataFrame:
    """Known sentences whose words fill lines that follow one another."""
    along = Window.partitionBy("_row").orderBy("_at")
    apart = ~F.col("_soft") | F.coalesce(F.col("_at") != F.lag("_at").over(along) + 1, F.lit(True))
    # words before a line, counted over these lines only: right within a run of lines
    counted = lines.select("_row", "_at", "_soft", (F.col("_b") - F.col("_a")).alias("_n")).distinct().withColumn("_apart", apart)
    counted = counted.select("_row", "_at", F.sum(F.col("_apart").cast("int")).over(along).alias("_run"), (F.sum("_n").over(along) - F.col("_n")).alias("_before"))
    begun = lines.join(counted, ["_row", "_at"]).withColumn("_begin", F.col("_before") - F.col("_a"))
    whole = begun.groupBy("_row", "_key", "_run", "_number", "_begin", "name", "_size").agg(F.min("_at").alias("first"), F.max("_at").alias("last"), F.sum(F.col("_b") - F.col("_a")).alias("_filled"))
    return whole.where("_filled = _size").select("_row", "_key", "name", "first", "last")


def matches(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", sentences: dict[str, list[str]] = SENTENCES,
    rules: list[tuple[str, list[str]]] = RULES, gap: int = GAP,
) -> DataFrame:
    """One row per match: ``key``, ``first`` and ``last`` sentence (from 1), ``rule`` (from 1), ``licence``."""
    spark = documents.sparkSession
    known = spark.createDataFrame(_runs(sentences), "sentence string, _number int, name string, _a int, _b int, _size int")
    marked = F.regexp_replace(F.col(text).cast("string"), LINE_END, f"$1{GOES_ON}$2{GONE_ON}")
    cut = F.split(F.translate(marked, UPPER, LOWER), BREAK)
    numbered = documents.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), cut.alias("_cut"))
    rows = numbered.select("_row", "_key", F.posexplode("_cut").alias("_at", "_raw"))
    spelled = rows.select(
        "_row", "_key", (F.col("_at") + 1).alias("_at"), F.col("_raw").startswith(GONE_ON).alias("_soft"), F.col("_raw").endswith(GOES_ON).alias("_open"),
        F.trim(F.regexp_replace("_raw", OTHER, " ")).alias("sentence"),
    )
    seen = spelled.join(F.broadcast(known), "sentence").where("(_a = 0 OR _soft) AND (_b = _size OR _open)").drop("sentence", "_open")
    seen = cut_lineage(seen)
    lone = seen.where("_b - _a = _size").select("_row", "_key", "name", F.col("_at").alias("first"), F.col("_at").alias("last"))
    hits = cut_lineage(lone.unionByName(_wrapped(seen.where("_b - _a < _size"))).distinct())

    # matches so far of each rule, step by step
    reached = hits.select("_row", "_key", "first", "last", F.explode(F.array(*[
        F.when(F.col("name") == sequence[0], F.struct(F.lit(number).alias("rule"), F.lit(licence).alias("licence"), F.array(*map(F.lit, sequence)).alias("names")))
        for number, (licence, sequence) in enumerate(rules, 1)
    ])).alias("m")).where("m IS NOT NULL").select("_row", "_key", "first", "last", "m.*")
    found = reached.where("size(names) = 1")
    following = hits.select("_row", "name", F.col("first").alias("_from"), F.col("last").alias("_to"))
    for step in range(1, max(len(sequence) for _, sequence in rules)):
        tried = reached.where(F.size("names") > step).withColumn("name", F.col("names")[step])
        tried = tried.withColumn("_from", F.explode(F.sequence(F.col("last") + 1, F.col("last") + gap + 1)))
        reached = tried.join(following, ["_row", "name", "_from"]).select("_row", "_key", "first", F.col("_to").alias("last"), "rule", "licence", "names").distinct()
        found = found.unionByName(reached.where(F.size("names") == step + 1))
    found = found.groupBy("_row", "_key", "first", "rule", "licence").agg(F.min("last").alias("last"))
    before = Window.partitionBy("_row").orderBy("first", F.desc("last"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    kept = found.withColumn("_reach", F.max("last").over(before)).where("_reach IS NULL OR _reach < last")
    return kept.select(F.col("_key").alias(key), "first", "last", "rule", "licence")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def oracle() -> str:
    steps = [(number, licence, step, name, len(sequence)) for number, (licence, sequence) in enumerate(RULES, 1) for step, name in enumerate(sequence)]
    known = [(s, name) for name, own in SENTENCES.items() for s in own]
    pattern = BREAK.replace("(", "(?:")
    return f"""
    WITH known(sentence, name) AS (VALUES {_values(known)}),
    steps(rule, licence, step, name, size) AS (VALUES {_values(steps)}),
    cut AS (SELECT doc_id, string_split_regex(translate("text", '{UPPER}', '{LOWER}'), '{pattern}') AS parts FROM documents),
    rows_ AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS place FROM cut),
    hits AS (
        SELECT doc_id, place, name, row_number() OVER (PARTITION BY doc_id ORDER BY place, name) AS n
        FROM rows_ JOIN known ON sentence = trim(regexp_replace(raw, '{OTHER}', ' ', 'g'))
    ),
    tried AS (
        SELECT h.doc_id, h.n AS start, s.rule, s.licence, s.step, s.size, g.place,
            g.place - lag(g.place) OVER (PARTITION BY h.doc_id, h.n, s.rule ORDER BY s.step) AS apart
        FROM hits h JOIN steps f ON f.step = 0 AND f.name = h.name JOIN steps s ON s.rule = f.rule
        JOIN hits g ON g.doc_id = h.doc_id AND g.n = h.n + s.step AND g.name = s.name
    ),
    found AS (
        SELECT doc_id, min(place) AS "first", max(place) AS "last", rule, licence FROM tried
        GROUP BY doc_id, start, rule, licence HAVING count(*) = max(size) AND coalesce(max(apart), 0) <= {GAP} + 1
    )
    SELECT doc_id, CAST("first" AS INT) AS "first", CAST("last" AS INT) AS "last", CAST(rule AS INT) AS rule, licence FROM (
        SELECT *, max("last") OVER (PARTITION BY doc_id ORDER BY "first", "last" DESC, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM found
    ) WHERE reach IS NULL OR reach < "last"
    """
