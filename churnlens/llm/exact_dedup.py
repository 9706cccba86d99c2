"""Operator 6: exact deduplication over a cuckoo-filter index.

Texts are equal when they are identical after deleting every ASCII white-space
character; the JVM normalises and digests (SHA-256) them, and only digests
travel. Each task feeds its digests to a ``CuckooIndex``: a hit in the filter
is verified against the digest stored in the same bucket, a miss inserts, and
an insertion that cannot be placed doubles the table from the stored keys.

The index works twice, like a combiner and a reducer: first over the rows of
an input partition (a group of copies that holds a third of the table shrinks
to one entry per task; when the index reaches ``live`` digests it emits and
deletes them), then over the entries of a digest shard. Rows finally look up
their group, and only groups of two or more are joined back.

Defined cases: null text counts as empty, all empty texts are one group; rows
that repeat (doc_id and text alike) are separate rows of the group and exactly
one of them stays, of rows alike in length and id the one with the least hash
of all its columns; null doc_id ranks after every doc_id; a very long text is
digested whole, where it is read; an empty table gives an empty result; other
columns of the input are ignored (but for that hash).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import SPACES, whole_text
from churnlens.session import materialize

SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """Cuckoo filter whose slots also hold the digest and its group state.

    A slot is ``[fingerprint, digest, state]``. Either of two buckets may hold
    a digest; the second follows from the first and the fingerprint, so an
    entry can be moved without its digest being hashed again.
    """

    def __init__(self, buckets: int = 256):
        self.mask = buckets - 1
        self.table: list[list[list]] = [[] for _ in range(buckets)]
        self.size = 0
        self.resizes = 0

    @staticmethod
    def _fingerprint(digest: bytes) -> int:
        return int.from_bytes(digest[:2], "big") | 1

    def _home(self, digest: bytes) -> int:
        return int.from_bytes(digest[2:10], "big") & self.mask

    def _other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995)) & self.mask

    def find(self, digest: bytes) -> list | None:
        """The live entry of this digest: fingerprint match, then digest match."""
        fp = self._fingerprint(digest)
        home = self._home(digest)
        for bucket in (home, self._other(home, fp)):
            for slot in self.table[bucket]:
                if slot[0] == fp and slot[1] == digest:
                    return slot
        return None

    def insert(self, digest: bytes, state) -> None:
        """Add a digest that is not in the index."""
        slot = [self._fingerprint(digest), digest, state]
        while (slot := self._place(slot)) is not None:
            self._resize()
        self.size += 1

    def _place(self, slot: list) -> list | None:
        """Put the slot somewhere; the slot left over if no place was found."""
        home = self._home(slot[1])
        for bucket in (home, self._other(home, slot[0])):
            if len(self.table[bucket]) < SLOTS:
                self.table[bucket].append(slot)
                return None
        bucket = home
        for kick in range(MAX_KICKS):
            victim = kick % SLOTS
            slot, self.table[bucket][victim] = self.table[bucket][victim], slot
            bucket = self._other(bucket, slot[0])
            if len(self.table[bucket]) < SLOTS:
                self.table[bucket].append(slot)
                return None
        return slot

    def _resize(self) -> None:
        """Twice the buckets, filled again from the stored digests."""
        stored = [slot for bucket in self.table for slot in bucket]
        buckets = 2 * (self.mask + 1)
        while True:
            self.mask = buckets - 1
            self.table = [[] for _ in range(buckets)]
            self.resizes += 1
            if all(self._place(slot) is None for slot in stored):
                return
            buckets *= 2

    def delete(self, digest: bytes) -> bool:
        fp = self._fingerprint(digest)
        home = self._home(digest)
        for bucket in (home, self._other(home, fp)):
            for at, slot in enumerate(self.table[bucket]):
                if slot[0] == fp and slot[1] == digest:
                    del self.table[bucket][at]
                    self.size -= 1
                    return True
        return False

    def entries(self) -> Iterator[list]:
        for bucket in self.table:
            yield from bucket


_ENTRY = "digest binary, best_chars long, best_id long, best_tie long, best_row long, members long"


def _better(a: tuple, b: tuple) -> bool:
    """Whether candidate a = (chars, doc_id, tie, row) stays rather than b."""
    def order(x):
        return (-x[0], x[1] is None, x[1] or 0, x[2], x[3])
    return order(a) < order(b)


def _index_pass(live: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["digest", "best_chars", "best_id", "best_tie", "best_row", "members"]
        types = [pa.binary(), *[pa.int64()] * 5]

        def out(entries) -> pa.RecordBatch:
            rows = [(e[1], *e[2][0], e[2][1]) for e in entries]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

        index = CuckooIndex()
        for batch in batches:
            for digest, *own, members in zip(*(c.to_pylist() for c in batch.columns)):
                entry = index.find(digest)
                if entry is None:
                    index.insert(digest, [tuple(own), members])
                else:
                    state = entry[2]
                    state[1] += members
                    if _better(tuple(own), state[0]):
                        state[0] = tuple(own)
            if live and index.size >= live:
                done = list(index.entries())
                for at in range(0, len(done), 10_000):
                    yield out(done[at:at + 10_000])
                for entry in done:
                    index.delete(entry[1])
        done = list(index.entries())
        for at in range(0, len(done), 10_000):
            yield out(done[at:at + 10_000])
    return run


def text_digest(text: Column) -> Column:
    """SHA-256 of a text without its ASCII white space."""
    return F.unhex(F.sha2(F.regexp_replace(text, f"[{SPACES}]+", ""), 256))


def _tie(docs: DataFrame) -> Column:
    """A hash of a row's content: rows alike in length and id are told apart by it, however the input is dealt."""
    return F.xxhash64(*[F.col(c) for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()])


def _judged(docs: DataFrame, id_col: str, text_col: str, live: int) -> DataFrame:
    """``doc_id, chars, digest, tie, keep_id, group_size, kept`` for every row."""
    text = whole_text(text_col)
    rows = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.char_length(text).cast("long").alias("chars"),
        text_digest(text).alias("digest"),
        _tie(docs).alias("tie"),
        F.monotonically_increasing_id().alias("row")), "exact_rows")
    entries = rows.select("digest", "chars", "doc_id", "tie", "row", F.lit(1).cast("long").alias("members")) \
        .mapInArrow(_index_pass(live), _ENTRY)
    groups = entries.repartition("digest").mapInArrow(_index_pass(None), _ENTRY)
    shared = groups.filter("members > 1").withColumnRenamed("digest", "group_digest")
    return (rows.join(shared, rows.digest == shared.group_digest, "left")
            .select("doc_id", "chars", "digest", "tie",
                    F.when(F.col("members").isNull(), F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
                    F.coalesce("members", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("best_row") == F.col("row"), F.lit(True)).alias("kept")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", live: int = 200_000) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, chars``.

    ``live`` bounds the digests a map-side index holds before it emits them.
    """
    return _judged(docs, id_col, text_col, live).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"), "chars")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", live: int = 200_000) -> DataFrame:
    """The rows that stay, with all their columns.

    A row that stays is known by its digest and the hash of its content; the
    texts meet these keys in one join. Only where rows alike in all columns
    stay together is one of them picked.
    """
    judged = materialize(_judged(docs, id_col, text_col, live).select("digest", "tie", "kept"), "exact_judged")
    stay = judged.filter("kept").select(F.col("digest").alias("__stay_digest"), F.col("tie").alias("__stay_tie"))
    repeated = judged.groupBy("digest", "tie").agg(F.count("*").alias("n"), F.max("kept").alias("kept")).filter("n > 1 AND kept")
    repeated = materialize(repeated.select(F.col("digest").alias("__again_digest"), F.col("tie").alias("__again_tie")), "exact_repeated")
    keys = {"__own_digest": text_digest(whole_text(text_col)), "__own_tie": _tie(docs)}
    kept = docs.withColumns(keys).join(
        stay, (F.col("__own_digest") == F.col("__stay_digest")) & (F.col("__own_tie") == F.col("__stay_tie")), "left_semi")
    if repeated.head(1):
        again = (F.col("__own_digest") == F.col("__again_digest")) & (F.col("__own_tie") == F.col("__again_tie"))
        kept = kept.join(repeated, again, "left_anti").unionByName(
            kept.join(repeated, again, "left_semi").dropDuplicates(list(keys)))
    return kept.drop(*keys)


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from churnlens.llm.common import table
    return exact_dedup(table(spark, sf_dir, "documents")).drop("chars")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS rn,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM g
"""
