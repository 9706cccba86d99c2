"""Operator 5: document fingerprints from improbable features.

A feature is a window of 16 bytes. Its entropy class is ranked by how seldom
the class is among all windows of the corpus (the seldomest first; windows of
almost no entropy are never features). Among any 16 neighbouring windows the
one of the lowest rank gets a vote; windows with at least 4 votes are chosen
and put into a Bloom filter (2,048 bits, five positions a feature). A filter
takes 160 features, then the next one of the chain begins. Two fingerprints
are compared filter by filter: the common bits beyond chance, as a share of
the greatest number possible; every filter of the shorter chain counts with
its best match, weighted by its features.

The rank table needs one narrow pass over all texts (about a thousand counts
a task, summed). Fingerprints are a narrow map. ``follow`` brings every
document to its successor in descending id order with one shuffle of the
text: ranges of the id, and the first document of each range sent to the
range before it as well, so no task needs more than its range.

Defined cases: null text counts as empty; an empty text has the fingerprint
of no features, alike (1) only to another empty one; a text shorter than a
window is one feature; equal texts have equal fingerprints; repeated ids
follow each other in the order of a hash of their texts, and ranges cut between them; a
null id comes after all others; a single document is its own successor; ties
of rank are settled by content; a very long text is worked through in chunks;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import pieces, shuffle_partitions, table, whole_text
from churnlens.session import materialize

WINDOW = 16
NEIGHBOURS = 16  # not more than WINDOW: votes then never cross from one text to the next
VOTES = 4
FILTER_BITS = 2048
FILTER_FEATURES = 160
PROBES = 5
CLASSES = 1001
LEAST_CLASS = 100
SLICE = 256 << 10
#: Places whose wide numbers are held at once.
CHUNK = 1 << 18

_SCALE = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_C_LOG_C = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WINDOW + 2)], np.int64)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, for the bytes of a chunk."""
    n = CHUNK + 2 * NEIGHBOURS + WINDOW
    up, down = np.full(n, _BASE), np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def entropy_classes(x: np.ndarray) -> np.ndarray:
    """Entropy class 0..1000 of each window of the bytes ``x`` (of which there are at least WINDOW).

    The sum of c log c over a window's byte counts changes by two counts when
    the window moves on; it is kept as an integer, so equal windows have equal
    classes wherever they stand.
    """
    n = len(x)
    ahead, behind = np.ones(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = x[d:] == x[:-d]
        ahead[:-d] += same
        behind[d:] += same
    moves = n - WINDOW
    out, new = x[:moves], x[WINDOW:]
    leaving, coming = ahead[:moves], behind[WINDOW:]
    change = _C_LOG_C[leaving - 1] - _C_LOG_C[leaving] + _C_LOG_C[coming + 1] - _C_LOG_C[coming]
    change[out == new] = 0
    first = _C_LOG_C[np.bincount(x[:WINDOW], minlength=256)].sum()
    total = np.concatenate([[first], first + np.cumsum(change)])
    bits = np.log2(WINDOW) - total / (WINDOW * _SCALE)
    return np.rint(bits * ((CLASSES - 1) / np.log2(WINDOW))).astype(np.int64).clip(0, CLASSES - 1)


class _Texts:
    """Texts one after another; a window may begin at a place if it ends in the same text."""

    def __init__(self, texts: list[bytes]):
        self.ends = np.cumsum([len(t) for t in texts])
        self.starts = self.ends - np.array([len(t) for t in texts], dtype=np.int64)
        self.places = int(self.ends[-1]) if len(texts) else 0
        # one text is not copied; places near its end have no window and need no bytes beyond it
        self.bytes = np.frombuffer(texts[0] if len(texts) == 1 else b"".join(texts), np.uint8) if self.places else np.zeros(0, np.uint8)

    def cut(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(the bytes of the windows that begin at a … b - 1, zeros beyond the end; which of them are valid)."""
        x = self.bytes[a:b + WINDOW - 1]
        if len(x) < b - a + WINDOW - 1:
            x = np.concatenate([x, np.zeros(b - a + WINDOW - 1 - len(x), np.uint8)])
        # no window begins in the last WINDOW - 1 bytes of a text
        e = self.ends[np.searchsorted(self.ends, a, side="right"):np.searchsorted(self.ends, b + WINDOW - 1)]
        edge = np.zeros(b - a + 1, np.int32)
        np.add.at(edge, np.clip(e - WINDOW + 1 - a, 0, b - a), 1)
        np.add.at(edge, np.minimum(e - a, b - a), -1)
        return x, np.cumsum(edge[:-1]) == 0


def class_counts(texts: list[bytes]) -> np.ndarray:
    joined, counts = _Texts([t for t in texts if t]), np.zeros(CLASSES, np.int64)
    for a in range(0, joined.places, CHUNK):
        x, valid = joined.cut(a, min(a + CHUNK, joined.places))
        counts += np.bincount(entropy_classes(x)[valid], minlength=CLASSES)
    return counts


def rank_classes(counts: np.ndarray) -> np.ndarray:
    """Rank of each class, the seldomest first; classes of almost no entropy have rank CLASSES (never chosen)."""
    order = np.lexsort((np.arange(CLASSES), counts))
    rank = np.empty(CLASSES, np.int64)
    rank[order] = np.arange(CLASSES)
    rank[:LEAST_CLASS] = CLASSES
    return rank


class Digest:
    """A chain of Bloom filters (rows of 256 bytes) and the features in each."""

    __slots__ = ("filters", "sizes")

    def __init__(self, filters: np.ndarray, sizes: list[int]):
        self.filters, self.sizes = filters, sizes

    def __str__(self) -> str:
        return ".".join(map(str, self.sizes)) + ":" + base64.b64encode(self.filters.tobytes()).decode("ascii")

    @staticmethod
    def parse(text: str) -> Digest:
        sizes, _, bits = text.partition(":")
        raw = np.frombuffer(base64.b64decode(bits), np.uint8)
        return Digest(raw.reshape(-1, FILTER_BITS // 8), [int(s) for s in sizes.split(".") if s])


def _digest(features: np.ndarray) -> Digest:
    features = features[np.sort(np.unique(features, return_index=True)[1])]
    count = -(-len(features) // FILTER_FEATURES)
    bits = np.zeros((count, FILTER_BITS), np.uint8)
    rows = np.arange(len(features)) // FILTER_FEATURES
    for p in range(PROBES):
        bits[rows, (features >> np.uint64(11 * p) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    return Digest(np.packbits(bits, axis=1), np.bincount(rows, minlength=count).tolist() if count else [])


def _chosen(joined: _Texts, rank: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(places from a to b that hold a feature, the features)."""
    low, high = max(0, a - NEIGHBOURS + 1), min(joined.places, b + NEIGHBOURS - 1)
    x, valid = joined.cut(low, high)
    up, down = _powers()
    n = high - low
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[:len(x)], dtype=np.uint64)])
    features = _mix((sums[WINDOW:] - sums[:-WINDOW])[:n] * down[:n])
    ranks = rank[entropy_classes(x)]
    ranks[~valid] = CLASSES + 1
    # rank, then bits of the content, then the place: the least of the neighbours follows from the content alone
    key = ranks << 52 | (features >> np.uint64(44)).astype(np.int64) << 32 | np.arange(n)
    least = np.concatenate([key, np.full(NEIGHBOURS, np.iinfo(np.int64).max)])
    step = 1
    while step < NEIGHBOURS:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    voters = min(b, joined.places) - low  # the neighbours of a later place are not all here
    least = least[:voters][valid[:voters]]
    least = least[least >> 52 < CLASSES] & 0xFFFFFFFF
    found = np.flatnonzero(np.bincount(least, minlength=n)[:n] >= VOTES)
    found = found[(found >= a - low) & (found < b - low)]
    return found + low, features[found]


def digests(texts: list[bytes], rank: np.ndarray) -> list[Digest]:
    """The fingerprint of each text; the work needs memory for a chunk, whatever the length of a text."""
    joined = _Texts(texts)
    parts = [_chosen(joined, rank, a, min(a + CHUNK, joined.places)) for a in range(0, joined.places, CHUNK)]
    places = np.concatenate([p for p, _ in parts]) if parts else np.zeros(0, np.int64)
    features = np.concatenate([f for _, f in parts]) if parts else np.zeros(0, np.uint64)
    out = []
    for text, a, b in zip(texts, np.searchsorted(places, joined.starts), np.searchsorted(places, joined.ends)):
        own = features[a:b]
        if not len(own) and text:  # short, or without any improbable window: the text is the one feature
            own = np.array([int.from_bytes(hashlib.sha256(text).digest()[:8], "big")], np.uint64)
        out.append(_digest(own))
    return out


def likeness(a: Digest, b: Digest) -> float:
    """Common bits beyond chance, 0 to 1."""
    if not a.sizes or not b.sizes:
        return float(not a.sizes and not b.sizes)
    if len(b.sizes) < len(a.sizes):
        a, b = b, a
    ones = np.bitwise_count(b.filters).sum(axis=1, dtype=np.int64)
    total = 0.0
    for row, size in zip(a.filters, a.sizes):
        own = int(np.bitwise_count(row).sum())
        common = np.bitwise_count(b.filters & row).sum(axis=1, dtype=np.int64)
        most, chance = np.minimum(own, ones), own * ones / FILTER_BITS
        total += size * max(0.0, float(((common - chance) / (most - chance)).max()))
    return min(1.0, total / sum(a.sizes))


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The rank table of a corpus, from all windows of all its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, np.int64)
        for batch in pieces(batches, 0, SLICE):
            counts += class_counts([t for t in batch.column(0).cast(pa.binary()).to_pylist() if t])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(counts)], names=["class", "n"])

    got = docs.select(whole_text(text_col).alias("text")).mapInArrow(run, "class long, n long") \
        .groupBy("class").agg(F.sum("n").alias("n")).collect()  # CLASSES rows
    counts = np.zeros(CLASSES, np.int64)
    for r in got:
        counts[r["class"]] = r["n"]
    return rank_classes(counts)


def fingerprints(docs: DataFrame, rank: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` for every row: a narrow map."""
    shared = docs.sparkSession.sparkContext.broadcast(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, SLICE):
            found = digests(batch.column(1).cast(pa.binary()).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(str, found), pa.string())],
                                             names=["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


_LAST = -(1 << 63)  # the place of a null id


def follow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sampled: int = 32) -> DataFrame:
    """``part, place, extra, doc_id, text``, sorted within ``part`` so that each row's successor is the next row.

    Rows with ``extra`` only close their part: they are the first rows of the
    next one. Range bounds come from a hash sample of about ``sampled`` ids a
    range; they decide where rows go, never which row follows which.
    """
    spark = docs.sparkSession
    ranges = shuffle_partitions(spark)
    # descending id, then descending hash of the text: an id that many rows share is spread over ranges too
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.struct(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64(whole_text(text_col)).alias("tie")).alias("place"),
                       whole_text(text_col).alias("text"))
    ids = materialize(rows.select("place"), "follow_places")
    every = max(1, ids.count() // (ranges * sampled))
    sample = sorted((tuple(r[0]) for r in ids.filter(F.pmod(F.xxhash64("place"), F.lit(every)) == 0).distinct().collect()),
                    reverse=True)
    bounds = sample[sampled::sampled]

    def with_part(df: DataFrame) -> DataFrame:
        """part = number of bounds above the place, by binary lifting."""
        df = df.withColumn("part", F.lit(0))
        if not bounds:
            return df
        array, step = F.array(*(F.struct(F.lit(i).cast("long").alias("id"), F.lit(t).cast("long").alias("tie")) for i, t in bounds)), 1
        while step * 2 <= len(bounds):
            step *= 2
        while step:
            ahead = F.col("part") + step
            df = df.withColumn("part", F.when((ahead <= len(bounds)) & (F.try_element_at(array, ahead) > F.col("place")),
                                              ahead).otherwise(F.col("part")))
            step //= 2
        return df

    heads = sorted(with_part(ids).groupBy("part").agg(F.max("place").alias("place")).collect())  # one row a range
    edges = spark.createDataFrame([(h["place"], heads[k - 1]["part"]) for k, h in enumerate(heads)],
                                  "place struct<id:long,tie:long>, to_part int")
    parted = with_part(rows).join(F.broadcast(edges), "place", "left")
    target = F.struct(F.col("part"), F.lit(False).alias("extra"))
    copies = F.when(F.col("to_part").isNull(), F.array(target)).otherwise(
        F.array(target, F.struct(F.col("to_part").alias("part"), F.lit(True).alias("extra"))))
    return (parted.withColumn("copy", F.explode(copies))
            .select(F.col("copy.part").alias("part"), F.col("copy.extra").alias("extra"), "place", "doc_id", "text")
            .repartition(ranges, "part").sortWithinPartitions("part", "extra", F.desc("place"), "text"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness.

    The edited text ends with the first third of the next document's text
    (descending id, the first after the last) in place of its own last third.
    """
    rank = docs.sparkSession.sparkContext.broadcast(entropy_ranks(docs, text_col))

    def judge(rows: list[tuple]) -> pa.RecordBatch:
        """rows: (part, extra, doc_id, text); a result for each but the last that is no extra row."""
        texts = [r[3] for r in rows]
        own = digests([t.encode("utf-8") for t in texts], rank.value)
        raw = [(t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]).encode("utf-8") for t, nxt in zip(texts, texts[1:])]
        other = digests(raw, rank.value)
        keep = [k for k in range(len(rows) - 1) if not rows[k][1]]
        return pa.RecordBatch.from_arrays([
            pa.array([rows[k][2] for k in keep], pa.int64()), pa.array([len(texts[k]) for k in keep], pa.int64()),
            pa.array([hashlib.sha256(raw[k]).hexdigest() for k in keep], pa.string()),
            pa.array([str(own[k]) for k in keep], pa.string()), pa.array([str(other[k]) for k in keep], pa.string()),
            pa.array([likeness(own[k], other[k]) for k in keep], pa.float64()),
            pa.array([likeness(own[k], own[k + 1]) for k in keep], pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in pieces(batches, 3, SLICE):
            waiting += zip(*(c.to_pylist() for c in batch.columns))
            yield judge(waiting)
            waiting = waiting[-1:]

    return follow(docs, id_col, text_col).select("part", "extra", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def op5_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
