"""License scan by diagonal voting.

All rolling word grams of all documents meet the grams of the templates in a join
on their hash: pairs for phrases of a few words, threes for whole notices; equal
text is asked for as well, so that a hit is exact. A hit votes for the diagonal
``word place - template place``. The votes of one diagonal are bit masks of
template places, so that they combine before the shuffle and repeated rows do not
count twice. A phrase counts where one diagonal has all its pairs. Diagonals of a
notice that neighbour each other, as inserted or missing words make them, are
merged, and the span around the strongest is verified: the words that its votes
cover, with a mark for every other word between the first and the last, are
compared with the notice by edit distance in words. Words out of order, scattered
over a longer text or said twice all count as edits.

The templates are a fixed table of some seven hundred grams, so their join is a
broadcast whose size does not depend on the data.

Cases: a null or empty text has no words, no hits and score 0; repeated rows
and equal ids each keep their row; other columns are not read.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases and labels that the scan must know.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Phrases and notices of well-known licences, in the words of the licences themselves.
# GNU notices differ in the name alone, which the phrases tell apart.
MORE = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "licensed under the apache license version 2 0": "apache-2.0",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "cc0 1 0 universal": "cc0",
    "all rights reserved": "all-rights-reserved",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions": "mit",
    "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the "
    "warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or "
    "copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or "
    "otherwise, arising from, out of or in connection with the Software or the use or other dealings in the Software": "mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution": "bsd",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission": "bsd-3-clause",
    "This software is provided by the copyright holders and contributors as is and any express or implied warranties, "
    "including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies": "isc",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0": "apache-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
    "language governing permissions and limitations under the License": "apache-2.0",
    "is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version": "gnu",
    "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details": "gnu",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/": "mpl-2.0",
    "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, "
    "visit http://creativecommons.org/licenses/by/4.0/": "cc-by",
    "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
    "work": "cc0",
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means": "unlicense",
    "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable "
    "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
    "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
    "restrictions": "zlib",
}
#: Share of a notice's words that a span must keep; phrases of up to SHORT pairs need all.
LEAST_PERCENT = 80
SHORT = 6
#: Places of a mask.
BITS = 62
#: The distinct words of a template are written as these, any other word as OTHER.
SIGNS = string.ascii_letters + string.digits + "#&()*+,-.:;<=>@[]^_|~"
OTHER = "!"

DOC = ["doc_id", "text_hash", "n_words"]


class Template:
    """One phrase or notice: its words, its grams by place, and its words as signs."""

    def __init__(self, number: int, text: str, label: str):
        words = re.findall(WORD, text.translate(str.maketrans(UPPER, UPPER.lower())))
        distinct = list(dict.fromkeys(words))
        if len(distinct) > len(SIGNS):
            raise ValueError(f"more than {len(SIGNS)} distinct words: {text[:40]}")
        self.number, self.label, self.base = number, label, text in BASE
        self.notice = len(words) - 1 > SHORT
        self.n_words, self.n_grams = len(words), len(words) - (2 if self.notice else 1)
        #: Diagonals that differ by so much at most belong to one span.
        self.drift = max(2, len(words) * (100 - LEAST_PERCENT) // 100)
        self.code = "".join(SIGNS[distinct.index(word)] for word in words)
        self.grams = [(i, f"{words[i]} {words[i + 1]}", words[i + 2] if self.notice else None) for i in range(self.n_grams)]

    def facts(self) -> str:
        flags = f"{str(self.base).lower()}, {str(self.notice).lower()}"
        return f"({self.number}, '{self.label}', {flags}, {self.n_words}, {self.n_grams}, {self.drift}, '{self.code}')"

    def rows(self) -> list[str]:
        return [f"({self.number}, {i}, '{pair}', {f"'{third}'" if third else 'NULL'})" for i, pair, third in self.grams]


FACTS = "template, label, base, notice, n_template, n_grams, drift, code"
GRAMS = "template, place, pair, third"
TEMPLATES = [Template(number, *row) for number, row in enumerate([*BASE.items(), *MORE.items()])]
N_MASKS = -(-max(t.n_grams for t in TEMPLATES) // BITS)


def template_grams(spark: SparkSession) -> DataFrame:
    rows = ", ".join(row for t in TEMPLATES for row in t.rows())
    return spark.sql(f"SELECT *, xxhash64(pair) AS pair_hash FROM VALUES {rows} AS t({GRAMS})")


def template_facts(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {', '.join(t.facts() for t in TEMPLATES)} AS t({FACTS})")


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def diagonals(docs: DataFrame) -> DataFrame:
    """One row per document, template and diagonal with hits; a row without a template counts the document's rows.

    The last word begins no gram, so its row, or that of a document without words, is the one that counts.
    """
    words = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words_of(F.col("text")).alias("words"))
    # grams are read from the words row by row: an array of grams would be several times as large as the text
    placed = words.select("doc_id", "text_hash", F.size("words").alias("n_words"), "words", F.posexplode_outer("words").alias("at", "word"))
    behind = lambda n: F.get("words", F.col("at") + n)
    rolled = placed.select(*DOC, "at", F.concat("word", F.lit(" "), behind(1)).alias("word_pair"), behind(2).alias("third_word"))
    known = F.broadcast(template_grams(docs.sparkSession))
    same = (F.xxhash64("word_pair") == F.col("pair_hash")) & (F.col("word_pair") == F.col("pair"))
    hits = rolled.join(known, same & (F.col("third").isNull() | (F.col("third") == F.col("third_word"))), "left")
    masks = [
        F.bit_or(F.expr(f"CASE WHEN place DIV {BITS} = {n} THEN shiftleft(1L, place % {BITS}) ELSE 0L END")).alias(f"mask_{n}")
        for n in range(N_MASKS)
    ]
    return (
        hits.filter(F.col("template").isNotNull() | F.col("at").isNull() | (F.col("at") == F.col("n_words") - 1))
        .groupBy(*DOC, "template", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(*masks, F.count(F.lit(1)).alias("n_rows"))
        .select(
            *DOC, "template", "diagonal", "n_rows", F.array(*[f"mask_{n}" for n in range(N_MASKS)]).alias("masks"),
            sum((F.bit_count(f"mask_{n}") for n in range(N_MASKS)), F.lit(0)).alias("n_votes"),
        )
    )


#: The words that the votes near the strongest diagonal cover: place in the text and sign.
_COVERED = f"""array_sort(array_distinct(flatten(transform(
    filter(diagonals, near -> abs(near.diagonal - best) <= drift),
    one -> flatten(transform(
        filter(sequence(0, n_grams - 1), g -> (shiftright(one.masks[CAST(g DIV {BITS} AS INT)], g % {BITS}) & 1) = 1),
        p -> transform(sequence(0, 2), j -> named_struct('at', p + j + one.diagonal, 'sign', substr(code, p + j + 1, 1)))
    ))))))"""
#: The same as one text, with a sign for each word between that no vote covers.
_READ = f"""aggregate(covered, named_struct('upto', covered[0].at, 'text', ''),
    (read, word) -> named_struct('upto', word.at, 'text',
        concat(read.text, repeat('{OTHER}', CAST(word.at - read.upto - 1 AS INT)), word.sign)),
    read -> read.text)"""


def spans(votes: DataFrame) -> DataFrame:
    """Verified spans: document, template, label, the first and last word, and the share of the template kept.

    Also, per span, the places of whole base phrases; and the rows that count documents, without a template.
    """
    along = Window.partitionBy(*DOC, "template").orderBy("diagonal")
    facts = F.broadcast(template_facts(votes.sparkSession))
    first = ~F.col("notice") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("drift"), F.lit(True))
    grouped = (
        votes.join(facts, "template", "left")
        .withColumn("first", first.cast("int"))
        .withColumn("span", F.sum("first").over(along))
    )
    whole = F.col("n_votes") == F.col("n_grams")
    whole_base = F.col("base") & whole
    vote = F.struct((-F.col("n_votes")).alias("fewest"), "diagonal", "masks")
    merged = (
        grouped.groupBy(*DOC, *FACTS.split(", "), "span")
        .agg(
            F.sum(F.when(F.col("template").isNull(), F.col("n_rows")).otherwise(0)).alias("copies"),
            F.sum(F.when(whole_base, 1).otherwise(0)).alias("n_base"),
            F.min(F.when(whole_base, F.col("diagonal"))).alias("first_base"),
            F.max(F.when(whole_base, F.col("diagonal"))).alias("last_base"),
            F.min(F.when(~F.col("notice") & whole, F.col("diagonal"))).alias("phrase_at"),
            F.collect_list(F.when(F.col("notice"), vote)).alias("diagonals"),
        )
        .withColumn("best", F.array_min("diagonals")["diagonal"])
        .withColumn("covered", F.when(F.col("notice"), F.expr(_COVERED)))
    )
    kept = (F.col("n_template") - F.levenshtein("code", F.expr(_READ))) / F.col("n_template")
    return merged.select(
        *DOC, "template", "label", "copies", "n_base", "first_base", "last_base",
        F.when(F.col("notice"), F.expr("covered[0].at")).otherwise(F.col("phrase_at")).alias("first_word"),
        F.when(F.col("notice"), F.element_at("covered", -1)["at"])
        .otherwise(F.col("phrase_at") + F.col("n_template") - 1).alias("last_word"),
        F.when(F.col("notice"), kept).when(F.col("phrase_at").isNotNull(), 1.0).otherwise(0.0).alias("share"),
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: places of the base phrases, labels, and the best span's share."""
    good = F.coalesce(F.col("share") * 100 >= LEAST_PERCENT, F.lit(False))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = (
        spans(diagonals(docs))
        .groupBy(*DOC)
        .agg(
            F.sum("copies").alias("copies"),
            F.sum("n_base").alias("n_base"),
            F.min("first_base").cast("long").alias("first_word"),
            F.max("last_base").cast("long").alias("last_word"),
            joined(F.when(F.col("n_base") > 0, F.col("label"))).alias("base_labels"),
            joined(F.when(good, F.col("label"))).alias("labels"),
            F.max(F.when(good, F.col("share")).otherwise(0.0)).alias("score"),
        )
    )
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
        "base_labels", "labels", "score", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).drop("copy")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    grams = ", ".join(row for t in TEMPLATES for row in t.rows())
    whole = "NOT notice AND n_votes = n_grams"
    good = f"share * 100 >= {LEAST_PERCENT}"
    return f"""WITH t({GRAMS}) AS (VALUES {grams}),
    f({FACTS}) AS (VALUES {", ".join(t.facts() for t in TEMPLATES)}),
    d AS (SELECT row_number() OVER () AS r, doc_id,
      regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS words FROM documents),
    p AS (SELECT r, unnest(range(1, len(words))) AS i, words FROM d WHERE len(words) > 1),
    hits AS (SELECT DISTINCT r, template, i - 1 AS word, place, i - 1 - place AS diagonal
      FROM (SELECT r, i, words[i] || ' ' || words[i + 1] AS pair, words[i + 2] AS third_word FROM p) q JOIN t USING (pair)
      WHERE third IS NULL OR third = third_word),
    votes AS (SELECT r, template, diagonal, count(*) AS n_votes FROM hits GROUP BY ALL),
    marked AS (SELECT *, NOT notice OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > drift, true) AS first
      FROM votes JOIN f USING (template)),
    grouped AS (SELECT *, sum(CAST(first AS INT)) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM marked),
    ranked AS (SELECT *, first_value(diagonal) OVER (PARTITION BY r, template, span ORDER BY n_votes DESC, diagonal) AS best
      FROM grouped WHERE notice),
    covered AS (SELECT DISTINCT r, template, span, label, n_template, code, word + j AS x, substr(code, place + j + 1, 1) AS sign
      FROM ranked JOIN hits USING (r, template, diagonal), (SELECT unnest([0, 1, 2]) AS j) js WHERE abs(diagonal - best) <= drift),
    spaced AS (SELECT *, coalesce(x - lag(x) OVER (PARTITION BY r, template, span ORDER BY x) - 1, 0) AS gap FROM covered),
    read AS (SELECT r, label, n_template, code, string_agg(repeat('{OTHER}', gap) || sign, '' ORDER BY x) AS said
      FROM spaced GROUP BY r, template, span, label, n_template, code),
    merged AS (SELECT r, label, CAST(1 AS DOUBLE) AS share, base, diagonal FROM grouped WHERE {whole}
      UNION ALL SELECT r, label, (n_template - levenshtein(code, said)) / n_template, false, NULL FROM read),
    per AS (SELECT r, count(*) FILTER (base) AS n_base, min(diagonal) FILTER (base) AS first_word, max(diagonal) FILTER (base) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER ({good}) AS labels,
      max(share) FILTER ({good}) AS score FROM merged GROUP BY r)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
      CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
      coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0.0) AS DOUBLE) AS score
    FROM d LEFT JOIN per USING (r)"""


ORACLE = _oracle()
