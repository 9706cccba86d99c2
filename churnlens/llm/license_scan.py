"""License scans by diagonal voting.

A template is a sequence of words. Every rolling word k-gram of a document is
hashed and joined to the template positions that hold the same gram; a hit at
word ``i`` of the document and ``pos`` of the template votes for the diagonal
``i - pos``. An unchanged copy puts all its votes on one diagonal; an inserted
or deleted word moves the rest to a neighbouring one, so neighbouring
diagonals of a template are merged to a band. A band is verified by the share
of the template's words that its hits cover.

A hit's words are compared with the template's before it votes, so a hash that
collides never does. Templates that ask for a share of 1 (phrases) must stand
unbroken on one diagonal; they are not merged.

Nothing but the hits leaves the task that reads a text: the templates are a
fixed, broadcast table (a few thousand grams), each document sends one row of
its own and one a hit, and hits are grouped by (row, template, diagonal). A
passage that a third of all documents hold is spread over the documents' rows.

Defined cases: null and empty texts have no words and no labels (empty string,
score 0); a document of any length is one row's work, as its words are; equal
places of several templates count for each; rows with equal or null ids are
told apart by a row number; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.llm.common import table, whole_text
from churnlens.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a maximal run of ASCII digits and small letters (A-Z are lowered first) and of all other than ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a gram: phrases are joined by pairs, texts by four words.
PHRASE, TEXT = 2, 4
#: Diagonals this near to the one before belong to its band.
SHIFT = 5
#: The hash that stands for the document itself, in place 0.
ITSELF = 0


@dataclass(frozen=True)
class Template:
    """``share``: part of the words a band must cover; ``base``: its places are counted."""
    label: str
    text: str
    share: float = 1.0
    base: bool = False

    @property
    def k(self) -> int:
        return PHRASE if self.share >= 1 else TEXT


BASE = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
)
PHRASES = (
    Template("bsd", "bsd license"),
    Template("isc", "isc license"),
    Template("lgpl", "lesser general public license"),
    Template("agpl", "affero general public license"),
    Template("mpl", "mozilla public license"),
    Template("cc-by", "creative commons attribution"),
    Template("cc-by", "licensed under cc by"),
    Template("cc-by-nc", "licensed under cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa"),
    Template("cc0", "cc0 1 0 universal"),
)
TEXTS = (
    Template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""", 0.6),
    Template("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY
        KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""", 0.6),
    Template("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details.""", 0.6),
    Template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution.""", 0.6),
    Template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies.""", 0.6),
    Template("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
        of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""", 0.6),
)
TEMPLATES = BASE + PHRASES + TEXTS


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def _template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(template, k, pos, gram, hash) of every gram of the templates, and the row that stands for a document."""
    rows = spark.createDataFrame([(n, t.text, t.k) for n, t in enumerate(templates)], "template int, text string, k int")
    rows = rows.withColumn("words", words_of(F.col("text"))).where(F.size("words") >= F.col("k"))
    rows = rows.select("template", "k", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("k"))).alias("pos"))
    rows = rows.withColumn("gram", F.slice("words", F.col("pos") + 1, F.col("k")))
    h = F.transform("gram", lambda w: F.xxhash64(w))
    pairs = F.xxhash64(h[0], h[1])
    rows = rows.withColumn("hash", F.when(F.col("k") == PHRASE, pairs).otherwise(F.xxhash64(pairs, F.xxhash64(h[2], h[3]))))
    itself = spark.range(1).select(F.lit(-1).alias("template"), F.lit(0).alias("k"), F.lit(0).alias("pos"),
                                   F.array().cast("array<string>").alias("gram"), F.lit(ITSELF).cast("long").alias("hash"))
    return rows.select("template", "k", "pos", "gram", "hash").unionByName(itself)


def template_hits(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``row, doc_id, n_words, template, at, pos``: word ``at`` of the document begins the gram at ``pos`` of the
    template. Each document also has one row with template -1. Written once."""
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                        words_of(whole_text(text_col)).alias("words"))
    n = F.size("words")
    hashed = words.select("*", n.alias("n_words"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))

    def rolling(col: str, gap: int) -> Column:
        """Each entry hashed with the one ``gap`` after it."""
        left = F.greatest(F.size(col) - gap, F.lit(0))
        return F.zip_with(F.slice(col, F.lit(1), left), F.slice(col, F.lit(1 + gap), left), lambda a, b: F.xxhash64(a, b))

    pairs = hashed.select("row", "doc_id", "words", "n_words", rolling("h", 1).alias("h2"))
    fours = pairs.select("row", "doc_id", "words", "n_words", "h2", rolling("h2", 2).alias("h4"))
    itself = F.array(F.lit(ITSELF).cast("long"))
    grams = fours.select("row", "doc_id", "words", "n_words", F.posexplode(F.concat(itself, "h2", "h4")).alias("place", "hash"))
    at = F.when(F.col("place") < F.col("n_words"), F.col("place") - 1).otherwise(F.col("place") - F.col("n_words"))
    found = grams.join(F.broadcast(_template_grams(docs.sparkSession, templates)), "hash")
    true = F.when(F.col("template") < 0, F.col("place") == 0).otherwise(
        (F.col("place") > 0) & (F.slice("words", at + 1, F.col("k")) == F.col("gram")))
    return materialize(found.where(true).select("row", "doc_id", F.col("n_words").cast("long"), "template", at.alias("at"), "pos"),
                       "license_hits")


def license_spans(hits: DataFrame, templates: tuple[Template, ...] = TEMPLATES, shift: int = SHIFT) -> DataFrame:
    """``row, label, base, first_word, last_word, share``: the verified spans of ``template_hits``.

    A place of a phrase is one span; a text's span is a band of diagonals no
    further than ``shift`` words apart.
    """
    spark = hits.sparkSession
    sizes = spark.createDataFrame([(n, t.label, t.base, t.k, float(t.share), t.text) for n, t in enumerate(templates)],
                                  "template int, label string, base boolean, k int, needed double, text string")
    sizes = sizes.withColumn("length", F.size(words_of(F.col("text")))).drop("text")
    votes = hits.where("template >= 0").groupBy("row", "template", (F.col("at") - F.col("pos")).alias("diagonal")).agg(
        F.collect_set("pos").alias("places"), F.min("at").alias("first"), F.max("at").alias("last"))
    votes = votes.join(F.broadcast(sizes), "template")
    # a band begins where the diagonal before is further away; phrases are never merged
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    begins = F.coalesce((F.col("needed") >= 1) | (F.col("diagonal") - F.lag("diagonal").over(order) > shift), F.lit(True))
    bands = votes.withColumn("begins", begins.cast("int")).withColumn("band", F.sum("begins").over(order))
    bands = bands.groupBy("row", "template", "band", "label", "base", "k", "needed", "length").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"), F.min("first").alias("first"), F.max("last").alias("last"))
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("k") - 1))))
    bands = bands.withColumn("share", F.size(covered) / F.col("length"))
    # an unbroken phrase has a vote from each of its grams
    whole = (F.col("needed") < 1) | (F.size("places") == F.col("length") - F.col("k") + 1)
    return bands.where((F.col("share") >= F.col("needed")) & whole).select(
        "row", "label", "base", F.col("first").cast("long").alias("first_word"),
        (F.col("last") + F.col("k") - 1).cast("long").alias("last_word"), "share")


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text", shift: int = SHIFT) -> DataFrame:
    """One row a document: words, places of the base templates, labels and the largest covered share."""
    hits = template_hits(docs, templates, id_col, text_col)
    spans = license_spans(hits, templates, shift)
    start = F.when(F.col("base"), F.col("first_word"))

    def joined(label: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    found = spans.groupBy("row").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.max("share").alias("score"))
    return hits.where("template < 0").select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _literal(text: str) -> str:
    return "'" + " ".join(text.split()).replace("'", "''") + "'"


_WORDS_SQL = f"regexp_extract_all(translate(%s, '{UPPER}', '{LOWER}'), '{WORD}')"
OP11_SQL = f"""
WITH t AS (SELECT *, {_WORDS_SQL % 'body'} AS tw FROM (VALUES
{", ".join(f"({n}, '{t.label}', {t.base}, {t.k}, {t.share}, {_literal(t.text)})" for n, t in enumerate(TEMPLATES))}
) v(template, label, base, k, needed, body)),
tg AS (SELECT template, k, i - 1 AS pos, tw[i:i + k - 1] AS gram
       FROM (SELECT *, unnest(range(1, len(tw) - k + 2)) AS i FROM t)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL % "coalesce(text, '')"} AS w FROM documents),
dg AS (SELECT r, k, i - 1 AS loc, w[i:i + k - 1] AS gram
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (VALUES ({PHRASE}), ({TEXT})) ks(k))),
votes AS (SELECT r, template, loc - pos AS diagonal, list(DISTINCT pos) AS places, min(loc) AS first, max(loc) AS last
          FROM dg JOIN tg USING (k, gram) GROUP BY ALL),
marked AS (SELECT v.*, label, base, k, needed, len(tw) AS length,
                  CASE WHEN needed >= 1 OR diagonal - lag(diagonal) OVER o > {SHIFT} THEN 1
                       WHEN lag(diagonal) OVER o IS NULL THEN 1 ELSE 0 END AS begins
           FROM votes v JOIN t USING (template) WINDOW o AS (PARTITION BY r, template ORDER BY diagonal)),
banded AS (SELECT *, sum(begins) OVER (PARTITION BY r, template ORDER BY diagonal) AS band FROM marked),
bands AS (SELECT r, label, base, k, needed, length, band, list_distinct(flatten(list(places))) AS places, min(first) AS first
          FROM banded GROUP BY r, template, label, base, k, needed, length, band),
spans AS (SELECT *, len(list_distinct(flatten(list_transform(places, lambda p: range(p, p + k))))) / length AS share FROM bands),
ok AS (SELECT * FROM spans WHERE share >= needed AND (needed < 1 OR len(places) = length - k + 1)),
f AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(first) FILTER (WHERE base) AS first_word,
             max(first) FILTER (WHERE base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM ok GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN f USING (r)"""
