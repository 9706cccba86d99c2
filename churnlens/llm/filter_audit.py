"""How filters of a corpus interact, in every order, by truth-table survival words.

With five filters there are 32 subsets. Each document becomes a 32-bit word:
bit ``s`` is set if the document survives the subset ``s``, that is fails none
of its filters. The number of documents that survive each subset is then the
positional popcount of the words of a part and label class. All figures of all
orders (kept, removed, redundant, lost labels, Shapley sums) are differences
of these 32 numbers, so the texts are read once whatever the number of orders.

The popcount is carry-save: words are added bit by bit in parallel, three
words of one weight giving one word of the same weight (their parity) and one
of twice the weight (their majority). A word that stands for ``n`` documents
enters at the weights of the bits of ``n``. Tasks send 32 sums a part and
class; Spark adds them.

The filter "identical to the text of a smaller id" needs the table: texts are
compared by SHA-256. Rows are first counted by (digest, part, class, id), which
is combined before it is shuffled, so that a group of copies that holds a
third of all rows is a few rows a part when its least id is looked up.

Defined cases: a null or blank text has no words and fails the first filter;
a null text equals an empty one; a null part is the empty string's part; a row
without an id counts as after all rows that have one, and has no labels; rows
of the same id and text are no copies of each other; an id with several label
rows has a label if one of them says so; an empty table gives no rows; other
columns are not read. Long texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.llm.common import table, whole_text

#: White space of the word rule, as a regular expression and as characters.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: Rows without an id are dealt over so many places of the label join.
NO_ID = 1024


def text_failures(text: Column) -> list[Column]:
    """The conditions A to D: too short, too few distinct words, too many capitals, odd characters."""
    bare = F.btrim(text, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))
    return [
        F.size(words) < 50,
        100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def failing_rows(docs: DataFrame, labels: DataFrame | None, failures: Sequence[Column], id_col: str = "doc_id",
                 text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, good, toxic, fails, n``: rows of a part and class that fail the filters of the bits of ``fails``.

    ``failures`` are the conditions of the first filters, over the column
    ``text_col``; the last bit is the copy filter.
    """
    bits = [F.when(f, F.lit(1 << k)).otherwise(0) for k, f in enumerate(failures)]
    fails = bits[0]
    for b in bits[1:]:
        fails = fails.bitwiseOR(b)
    whole = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        whole_text(text_col).alias(text_col))
    # the text decides all filters but the last, so these bits go with the digest
    rows = whole.select("id", "part", F.unhex(F.sha2(text_col, 256)).alias("digest"), fails.alias("fails"))
    rows = rows.groupBy("digest", "fails", "part", "id").agg(F.count(F.lit(1)).alias("n"))
    if labels is None:
        rows = rows.withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    else:
        # rows without an id match nothing; a second key spreads them
        rows = rows.withColumn("deal", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest", "part"), F.lit(NO_ID))).otherwise(F.lit(0).cast("long")))
        marks = labels.groupBy(F.col(id_col).alias("id")).agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).where("id IS NOT NULL AND (good OR toxic)")
        rows = rows.join(marks.withColumn("deal", F.lit(0).cast("long")), ["id", "deal"], "left").fillna(False, ["good", "toxic"])
    # (no id, id): the least comes first, rows without an id last
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    groups = rows.groupBy("digest", "fails", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.struct(place.alias("place"), F.col("n").alias("n"))).alias("least"))
    # a digest now has at most one row a part and class, however many copies
    groups = groups.withColumn("place", F.min("least.place").over(Window.partitionBy("digest")))
    stay = (F.when(F.col("least.place") != F.col("place"), F.lit(0)).when(F.col("place.none"), F.col("n")).otherwise(F.col("least.n")))
    split = F.array(F.struct(F.col("fails"), stay.cast("long").alias("n")),
                    F.struct(F.col("fails").bitwiseOR(F.lit(1 << len(failures))).alias("fails"), (F.col("n") - stay).cast("long").alias("n")))
    return groups.select("part", "good", "toxic", F.explode(split).alias("x")).select("part", "good", "toxic", "x.*").where("n > 0")


def survival_word(fails: int, filters: int) -> int:
    """Bit ``s`` is set if a document with these failures survives the subset ``s``."""
    return sum(1 << s for s in range(1 << filters) if not s & fails)


def positional_counts(words: np.ndarray, n: np.ndarray, width: int) -> np.ndarray:
    """How often each bit is set in ``words``, word ``i`` counted ``n[i]`` times, by carry-save addition."""
    total = np.zeros(width, np.int64)
    weight, left, carried = 0, n.astype(np.int64), np.zeros(0, np.uint64)
    while left.any() or len(carried):
        x = np.concatenate([words[left & 1 == 1], carried])
        left = left >> 1
        carries = []
        while len(x) > 2:
            third = len(x) // 3
            a, b, c = x[:third], x[third:2 * third], x[2 * third:3 * third]
            carries.append((a & b) | (c & (a ^ b)))
            x = np.concatenate([a ^ b ^ c, x[3 * third:]])
        if len(x) == 2:
            carries.append(x[:1] & x[1:])
            x = x[:1] ^ x[1:]
        for s in range(width):
            total[s] += int(np.count_nonzero(x >> np.uint64(s) & np.uint64(1))) << weight
        carried = np.concatenate(carries) if carries else np.zeros(0, np.uint64)
        weight += 1
    return total


def _popcounts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0).dictionary_encode()
            kind = np.asarray(part.indices).astype(np.int64) * 4 + np.asarray(batch.column(1))
            words, n = np.asarray(batch.column(2)).astype(np.uint64), np.asarray(batch.column(3))
            kinds, group = np.unique(kind, return_inverse=True)
            order = np.argsort(group, kind="stable")
            ends = np.searchsorted(group[order], np.arange(1, len(kinds) + 1))
            begins = np.concatenate([[0], ends[:-1]])
            counts = np.concatenate([positional_counts(words[order[a:b]], n[order[a:b]], width) for a, b in zip(begins, ends)])
            yield pa.record_batch([
                part.dictionary.take(pa.array(np.repeat(kinds // 4, width))), pa.array(np.repeat(kinds % 4, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(kinds))), pa.array(counts)],
                names=["part", "kind", "subset", "n"])
    return run


def survivors(failing: DataFrame, filters: int = 5) -> DataFrame:
    """``part, subset, n, good, toxic``: rows, labelled rows of the part that survive each subset of the filters."""
    width = 1 << filters
    truth = F.array(*[F.lit(survival_word(f, filters)).cast("long") for f in range(width)])
    kind = F.col("good").cast("int") + 2 * F.col("toxic").cast("int")
    words = failing.select("part", kind.alias("kind"), F.element_at(truth, F.col("fails") + 1).alias("word"), "n")
    counts = words.mapInArrow(_popcounts(width), "part string, kind int, subset int, n long")
    return counts.groupBy("part", "subset").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("kind") % 2 == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("kind") >= 2, F.col("n")).otherwise(0)).alias("toxic"))


def audit_orders(counts: DataFrame, names: str = "ABCDE") -> DataFrame:
    """Every order of the filters and every step of it for each part of ``survivors``."""
    k, last = len(names), (1 << len(names)) - 1
    alive = counts.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("s"))
    orders = F.lit(["".join(p) for p in permutations(names)])
    steps = alive.select("part", "s", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))

    def mask(letters: Column) -> Column:
        out = F.lit(0)
        for i, c in enumerate(names):
            out = out + F.when(F.contains(letters, F.lit(c)), 1 << i).otherwise(0)
        return out

    steps = steps.withColumn("bit", mask(F.substring("filter_order", F.col("step"), F.lit(1))))
    steps = steps.withColumn("before", mask(F.substring("filter_order", F.lit(1), F.col("step") - 1)))

    def at(subset: Column | int, field: str = "n") -> Column:
        subset = F.lit(subset) if isinstance(subset, int) else subset
        return F.element_at("s", subset + 1)[field]

    def gone(field: str) -> Column:
        return at(F.col("before"), field) - at(F.col("before") + F.col("bit"), field)

    # orders in which exactly the filters of a subset come before a given other one
    ways = F.lit([math.factorial(s.bit_count()) * math.factorial(max(0, k - 1 - s.bit_count())) for s in range(last + 1)])
    shapley = F.aggregate(
        F.filter(F.sequence(F.lit(0), F.lit(last)), lambda s: s.bitwiseAND(F.col("bit")) == 0), F.lit(0).cast("long"),
        lambda total, s: total + F.element_at(ways, s + 1) * (at(s) - at(s + F.col("bit"))))
    removed = gone("n")
    return steps.select(
        "part", "filter_order", "step", at(F.col("before") + F.col("bit")).alias("kept"), removed.alias("removed"),
        (at(0) - at(F.col("bit")) - removed).alias("redundant"), (at(F.lit(last) - F.col("bit")) - at(last)).alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), shapley.alias("shapley"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = failing_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), text_failures(F.col("text")))
    return audit_orders(survivors(failing))


_LETTERS = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate("ABCDE"))
OP12_SQL = f"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
             + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 16 ELSE 0 END AS fails
      FROM w LEFT JOIN lab USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS t
      FROM f GROUP BY part, fails),
l(letter, bit) AS (VALUES {_LETTERS}),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
             [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
        AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM o)),
r AS (SELECT part, filter_order, step, bit,
             coalesce(sum(n) FILTER (WHERE fails & (before + bit) = 0), 0) AS kept,
             coalesce(sum(n) FILTER (WHERE fails & before = 0 AND fails & bit > 0), 0) AS removed,
             coalesce(sum(n) FILTER (WHERE fails & before > 0 AND fails & bit > 0), 0) AS redundant,
             coalesce(sum(n) FILTER (WHERE fails = bit), 0) AS unique_fails,
             coalesce(sum(g) FILTER (WHERE fails & before = 0 AND fails & bit > 0), 0) AS good_lost,
             coalesce(sum(t) FILTER (WHERE fails & before = 0 AND fails & bit > 0), 0) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r"""
