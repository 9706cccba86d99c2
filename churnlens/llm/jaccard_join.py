"""Operator 8: n-gram Jaccard join with several global token orders.

Documents are sets of 5-word shingles (64-bit hashes); two link when
100 * |A & B| >= 80 * |A | B|. Then neither has more than n/5 shingles that the
other lacks, so under *any* global order of the tokens the first n/5 + 1
tokens of both (their prefixes) must share one. Candidates must pass that test
under three orders: seldomest first (which generates them), and ascending and
descending hash (checked on a pair's sets before they are compared whole).

Stages, each lossless, none of which drops or caps a case:

1. Classes: documents with the same set are one class (128-bit digest); one
   representative of each class goes on.
2. Singles: of the shingles in a fixed 3/8 of the hash space, those that only
   one document has are counted per document. With more than n/5 of them a
   document can't link to anything and its class goes no further. Tokens
   travel as packed arrays, one per slice of texts and hash bucket, combined
   within the slice, so a shingle that every document has costs one entry a
   slice. Surviving classes are marked in a Bloom filter of bounded size
   (more survivors only mean more false alarms, which cost work and nothing
   else), by which a second scan picks their texts without shuffling any.
3. Document frequencies of the survivors' shingles, the same way, and the
   prefixes: seldomest first, tokens of one class alone left out.
4. Stars: within each prefix token's documents all are compared with the most
   central one (linear, whatever the size of the group), exactly.
5. Crossing pairs: only token groups that still hold several components are
   looked at again, in blocks, over pairs from different components; a parity
   bitmap of the set gives a lower bound of the symmetric difference, and
   pairs within it are compared exactly. Groups over ``BLOCK`` documents are
   cut into pairs of blocks, each a task's work. No list of all pairs exists.

Components follow from the links; copies get the answer of their class.

Defined cases: null or empty text, or no word: empty set, linked with nothing;
under 5 words: the whole sequence is the one shingle; repeated rows are
copies; a null id never is a component's id unless all its documents' ids are
null; of equally central documents of a token the one of the greatest digest
is its star; a very long text is one set, held by one task at a time; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import pieces, shuffle_partitions, table, whole_text
from churnlens.llm.components import components
from churnlens.llm.word_hashes import gram_hashes, word_hashes
from churnlens.session import materialize

WORDS = 5
SINGLES_SPACE = np.uint64(3 << 61)  # hashes below this: 3/8 of all
SLICE = 4 << 20
BLOCK = 256
BLOOM_BITS = 1 << 27  # greatest size of the survivors' filter: 16 MB


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w, at = word_hashes(texts, lower=True)
    grams = gram_hashes(w, words)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a:b - words + 1]))
        else:
            out.append(gram_hashes(w[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def set_digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def link(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets link: prefix filters under both hash orders, then the sets."""
    n, m = len(a), len(b)
    if 5 * min(n, m) < 4 * max(n, m):
        return False
    p, q = n // 5 + 1, m // 5 + 1
    if not len(np.intersect1d(a[:p], b[:q], assume_unique=True)) or \
            not len(np.intersect1d(a[-p:], b[-q:], assume_unique=True)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 9 * (n + m - 2 * common) <= n + m


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=names)


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, row) -> (doc_id, row, cid, n)."""
    for batch in pieces(batches, 1):
        sets = shingle_sets(batch.column(1))
        yield _batch([batch.column(0), batch.column(2), pa.array([set_digest(s) for s in sets], pa.binary()),
                      pa.array([len(s) for s in sets], pa.int64())], ["doc_id", "row", "cid", "n"])


def _slice_key(number: int) -> int:
    return TaskContext.get().partitionId() << 32 | number


# --- stage 2: classes that may link at all --------------------------------------------------------------------------

_PACKED = "bucket int, slice long, tokens binary, owners binary, cids binary, sizes binary"


def _pack_singles(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """text -> per slice and bucket its tokens in the space of singles (owner -1: several), and once its classes."""
        for number, batch in enumerate(pieces(batches, 0, SLICE)):
            sets = {}
            for s in shingle_sets(batch.column(0)):
                if len(s):
                    sets.setdefault(set_digest(s), s)
            kept = [s[:np.searchsorted(s, SINGLES_SPACE)] for s in sets.values()]
            tokens = np.concatenate(kept) if kept else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(len(kept), dtype=np.int32), [len(s) for s in kept])
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else order
            counts = np.diff(np.append(first, len(tokens)))
            tokens, owner = tokens[first], np.where(counts > 1, -1, owner[first])
            bucket = (tokens % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            tokens, owner = tokens[order], owner[order]
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            key, filled = _slice_key(number), [b for b in range(buckets) if cut[b + 1] > cut[b]]
            sizes = np.array([len(s) for s in sets.values()], np.int64)
            blank = len(filled) + 1
            yield _batch(
                [pa.array([*filled, key % buckets], pa.int32()), pa.array([key] * blank, pa.int64()),
                 pa.array([*(_six(tokens[cut[b]:cut[b + 1]]) for b in filled), None], pa.binary()),
                 pa.array([*(owner[cut[b]:cut[b + 1]].tobytes() for b in filled), None], pa.binary()),
                 pa.array([None] * len(filled) + [b"".join(sets)], pa.binary()),
                 pa.array([None] * len(filled) + [sizes.tobytes()], pa.binary())],
                ["bucket", "slice", "tokens", "owners", "cids", "sizes"])
    return run


def _six(tokens: np.ndarray) -> bytes:
    """Six bytes of each hash: within a bucket enough to tell tokens apart (a clash only keeps a document)."""
    return np.ascontiguousarray((tokens >> np.uint64(8)).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[tuple]]:
    """Rows of equal ``key`` (which stand together), as lists of tuples."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and rows[0][key] != row[key]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _count_singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: tokens of one document alone, counted per slice and owner; classes pass through."""
    for rows in _groups(batches, 0):
        out = [(r[1], None, r[4], r[5]) for r in rows if r[2] is None]
        packed = [r for r in rows if r[2] is not None]
        if packed:
            tokens = np.concatenate([_from_six(r[2]) for r in packed])
            owner = np.concatenate([np.frombuffer(r[3], np.int32) for r in packed])
            source = np.repeat(np.arange(len(packed)), [len(r[3]) // 4 for r in packed])
            order = np.argsort(tokens, kind="stable")
            tokens, owner, source = tokens[order], owner[order], source[order]
            new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
            alone = new & np.append(new[1:], True) & (owner >= 0)
            owner, source = owner[alone], source[alone]
            order = np.argsort(source, kind="stable")
            owner, cut = owner[order], np.searchsorted(source[order], np.arange(len(packed) + 1))
            out += [(r[1], owner[cut[k]:cut[k + 1]].tobytes(), None, None) for k, r in enumerate(packed)
                    if cut[k + 1] > cut[k]]
        yield _batch([pa.array([r[0] for r in out], pa.int64()), *(pa.array([r[k] for r in out], pa.binary())
                                                                  for k in (1, 2, 3))],
                     ["slice", "singles", "cids", "sizes"])


def _surviving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice: the classes with at most n/5 single tokens."""
    for rows in _groups(batches, 0):
        cids = next(r[2] for r in rows if r[2] is not None)
        sizes = np.frombuffer(next(r[3] for r in rows if r[3] is not None), np.int64)
        singles = np.zeros(len(sizes), np.int64)
        for r in rows:
            if r[1] is not None:
                singles += np.bincount(np.frombuffer(r[1], np.int32), minlength=len(sizes))
        keep = np.flatnonzero(singles <= sizes // 5)
        yield _batch([pa.array([cids[16 * k:16 * k + 16] for k in keep], pa.binary())], ["cid"])


def surviving_classes(docs: DataFrame) -> DataFrame:
    """``cid`` of the classes that may link, from (text)."""
    buckets = 8 * shuffle_partitions(docs.sparkSession)
    packed = docs.select("text").mapInArrow(_pack_singles(buckets), _PACKED)
    counted = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _count_singles, "slice long, singles binary, cids binary, sizes binary")
    return counted.repartition("slice").sortWithinPartitions("slice").mapInArrow(_surviving, "cid binary").distinct()


# --- stage 3: sets, document frequencies, prefixes ------------------------------------------------------------------

def bloom_words(ids: DataFrame, bits: int) -> np.ndarray:
    """Bit array over two hashes of the ids: at most bits/64 numbers reach the driver."""
    h = F.xxhash64("id")
    places = ids.select(F.explode(F.array(F.pmod(h, F.lit(bits)),
                                          F.pmod(F.xxhash64("id", F.lit(1)), F.lit(bits)))).alias("p"))
    words = places.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(p % 64 AS INT))")).alias("v")).collect()
    out = np.zeros(bits // 64, np.int64)
    for r in words:
        out[r["w"]] = r["v"]
    return out.view(np.uint64)


def _pick_sets(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(h1, h2, text) -> sets of the rows whose hashes are in the filter."""
        bits = words.value
        for batch in batches:
            hit = np.ones(batch.num_rows, bool)
            for k in (0, 1):
                place = np.asarray(batch.column(k)).astype(np.int64)
                hit &= (bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            chosen = batch.filter(pa.array(hit))
            for piece in pieces(iter([chosen]), 2):
                sets = [s for s in shingle_sets(piece.column(2)) if len(s)]
                yield _batch([pa.array([set_digest(s) for s in sets], pa.binary()),
                              pa.array([len(s) for s in sets], pa.int64()),
                              pa.array([s.tobytes() for s in sets], pa.binary())], ["cid", "n", "tokens"])
    return run


def _pack_counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(slice, tokens) -> per slice and bucket its distinct tokens and in how many sets each is."""
        for rows in _groups(batches, 0):
            tokens = np.concatenate([np.frombuffer(r[1], np.uint64) for r in rows])
            tokens, counts = np.unique(tokens, return_counts=True)
            bucket = (tokens % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            tokens, counts = tokens[order], counts[order].astype(np.int32)
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            filled = [b for b in range(buckets) if cut[b + 1] > cut[b]]
            yield _batch([pa.array(filled, pa.int32()), pa.array([rows[0][0]] * len(filled), pa.int64()),
                          pa.array([tokens[cut[b]:cut[b + 1]].tobytes() for b in filled], pa.binary()),
                          pa.array([counts[cut[b]:cut[b + 1]].tobytes() for b in filled], pa.binary())],
                         ["bucket", "slice", "tokens", "counts"])
    return run


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: each slice gets back its tokens that are in two sets or more, with their frequencies."""
    for rows in _groups(batches, 0):
        parts = [np.frombuffer(r[2], np.uint64) for r in rows]
        every, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([np.frombuffer(r[3], np.int32) for r in rows])).astype(np.int64)
        out, at = [], 0
        for r, part in zip(rows, parts):
            df = total[inverse[at:at + len(part)]]
            at += len(part)
            if (df > 1).any():
                out.append((r[1], part[df > 1].tobytes(), df[df > 1].tobytes()))
        yield _batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()),
                      pa.array([o[2] for o in out], pa.binary())], ["slice", "tokens", "df"])


def parity_bitmap(tokens: np.ndarray) -> bytes:
    """One bit per hash value class, flipped by every token: two sets differ in at least as many tokens as bits."""
    size = max(256, 1 << min(16, (2 * len(tokens) - 1).bit_length()))
    bits = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice, frequencies before sets: every set's prefix tokens, seldomest first, that other sets have too."""
    for rows in _groups(batches, 0):
        known = [r for r in rows if r[4] is not None]
        tokens = np.concatenate([np.frombuffer(r[3], np.uint64) for r in known] or [np.zeros(0, np.uint64)])
        df = np.concatenate([np.frombuffer(r[4], np.int64) for r in known] or [np.zeros(0, np.int64)])
        order = np.argsort(tokens)
        tokens, df = tokens[order], df[order]
        out = []
        for _, cid, n, raw, freq in rows:
            if freq is not None:
                continue
            own = np.frombuffer(raw, np.uint64)
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                own_df = np.where(tokens[at] == own, df[at], 1)
            else:
                own_df = np.ones(len(own), np.int64)
            first = np.lexsort((own, own_df))[:n // 5 + 1]
            prefix = own[first[own_df[first] > 1]]
            if len(prefix):
                out.append((cid, n, float(np.log(own_df).mean()), parity_bitmap(own), prefix.view(np.int64).tolist()))
        yield _batch([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64()),
                      pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.binary()),
                      pa.array([o[4] for o in out], pa.list_(pa.int64()))],
                     ["cid", "n", "centre", "bits", "prefix"])


def prefix_table(sets: DataFrame) -> DataFrame:
    """``cid, n, centre, bits, prefix`` of the sets (``slice, cid, n, tokens``) that share prefix tokens."""
    buckets = 8 * shuffle_partitions(sets.sparkSession)
    counted = (sets.select("slice", "tokens").mapInArrow(
        _pack_counts(buckets), "bucket int, slice long, tokens binary, counts binary")
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_sum_counts, "slice long, tokens binary, df binary"))
    together = counted.select("slice", F.lit(None).cast("binary").alias("cid"), F.lit(None).cast("long").alias("n"),
                              "tokens", "df").unionByName(
        sets.select("slice", "cid", "n", "tokens", F.lit(None).cast("binary").alias("df")))
    return together.repartition("slice").sortWithinPartitions("slice").mapInArrow(
        _prefixes, "cid binary, n long, centre double, bits binary, prefix array<long>")


# --- stages 4 and 5: links ------------------------------------------------------------------------------------------

def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, x, y = (c.to_pylist() for c in batch.columns)
        keep = [k for k in range(batch.num_rows)
                if link(np.frombuffer(x[k], np.uint64), np.frombuffer(y[k], np.uint64))]
        yield _batch([pa.array([a[k] for k in keep], pa.binary()), pa.array([b[k] for k in keep], pa.binary())], ["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) of classes that link."""
    left = sets.select(F.col("cid").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_verify, "a binary, b binary")


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Parity bitmaps cut down to ``width`` 64-bit words."""
    while bits.shape[1] > width:
        # a token's bit is its hash modulo the size: the upper half folds onto the lower
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def crossing_pairs(rows: list[tuple], across: bool) -> list[tuple[bytes, bytes]]:
    """Pairs from different components that may link, of rows (block, cid, n, root, bits).

    ``across``: only pairs from different blocks.
    """
    width = np.array([len(r[4]) // 8 for r in rows])
    n = np.array([r[2] for r in rows])
    root = np.unique(np.array([r[3] for r in rows], object), return_inverse=True)[1]
    block = np.array([r[0] for r in rows])
    found = []
    for w in np.unique(width):
        small = np.flatnonzero(width == w)
        bits = np.frombuffer(b"".join(rows[k][4] for k in small), np.uint64).reshape(len(small), w)
        for v in np.unique(width[(width >= w) & (width <= 4 * w)]):
            other = small if v == w else np.flatnonzero(width == v)
            wide = bits if v == w else _fold(
                np.frombuffer(b"".join(rows[k][4] for k in other), np.uint64).reshape(len(other), v), w)
            step = max(1, (1 << 20) // (len(other) * w))
            for at in range(0, len(small), step):
                i = small[at:at + step]
                s = n[i][:, None] + n[other][None, :]
                ok = (root[i][:, None] != root[other][None, :])
                if across:
                    ok &= block[i][:, None] != block[other][None, :]
                if v == w:
                    ok &= i[:, None] < other[None, :]
                if not ok.any():
                    continue
                differ = np.bitwise_count(bits[at:at + step, None, :] ^ wide[None, :, :]).sum(axis=2, dtype=np.int64)
                x, y = np.nonzero(ok & (9 * differ <= s) &
                                  (5 * np.minimum(n[i][:, None], n[other][None, :]) >= 4 * np.maximum(n[i][:, None], n[other][None, :])))
                found += [tuple(sorted((rows[i[p]][1], rows[other[q]][1]))) for p, q in zip(x.tolist(), y.tolist())]
    return found


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, across, block, cid, n, root, bits) of a key together -> candidate pairs."""
    for rows in _groups(batches, 0):
        if all(r[5] == rows[0][5] for r in rows):
            continue  # one component
        pairs = sorted(set(crossing_pairs([r[2:] for r in rows], any(r[1] for r in rows))))
        if pairs:
            yield _batch([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
                         ["a", "b"])


def class_links(sets: DataFrame, prefixes: DataFrame, most: int = BLOCK) -> DataFrame:
    """``node, root``: the components of the classes that have links."""
    entries = prefixes.select(F.explode("prefix").alias("token"), "cid", "n", "centre")
    centres = entries.groupBy("token").agg(F.max(F.struct("centre", "cid", "n")).alias("c"))
    stars = entries.join(centres, "token").filter(
        "cid <> c.cid AND 5 * least(n, c.n) >= 4 * greatest(n, c.n)").select(
        F.least("cid", "c.cid").alias("a"), F.greatest("cid", "c.cid").alias("b")).distinct()
    links = materialize(verified(stars, sets), "jaccard_links")
    found = components(links)
    rooted = prefixes.join(found, F.col("cid") == F.col("node"), "left").select(
        "prefix", "cid", "n", F.coalesce("root", "cid").alias("root"), "bits")
    tokens = rooted.select(F.explode("prefix").alias("token"), "cid", "root")
    mixed = tokens.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("size"))
    mixed = mixed.filter("least <> most").select("token", F.ceil(F.col("size") / most).cast("int").alias("blocks"))
    near = rooted.select(F.explode("prefix").alias("token"), "cid", "n", "root", "bits").join(mixed, "token")
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    near = near.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "key", F.concat_ws(":", "token", F.least("block", "other"), F.greatest("block", "other")))
    # rows of one key are one pair of blocks of one token; ranges of keys are even in rows, which hashes of keys are not
    grouped = near.select("key", (F.col("block") != F.col("other")).alias("across"), "block", "cid", "n", "root", "bits")
    candidates = grouped.repartitionByRange(shuffle_partitions(near.sparkSession), "key").sortWithinPartitions("key").mapInArrow(
        _cross, "a binary, b binary").distinct()
    more = verified(candidates, sets)
    return components(links.unionByName(more))


def _components_by_row(docs: DataFrame, id_col: str, text_col: str, block: int = BLOCK, row_col: str | None = None) -> DataFrame:
    """``doc_id, row, n_shingles, component_id, root`` for every row; ``root`` is null where nothing is linked."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"),
                        (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("row"))
    rows = materialize(keyed.mapInArrow(_classify, "doc_id long, row long, cid binary, n long"), "jaccard_rows")
    classes = rows.filter("n > 0").groupBy("cid").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    survivors = materialize(classes.join(surviving_classes(texts), "cid").select(
        "cid", "rep", F.coalesce("rep", F.lit(0)).alias("id")), "jaccard_survivors")
    count = survivors.count()
    bits = min(BLOOM_BITS, max(1 << 16, 1 << (16 * count).bit_length()))
    words = spark.sparkContext.broadcast(bloom_words(survivors, bits))
    ident = F.coalesce("doc_id", F.lit(0).cast("long"))
    picked = texts.select(F.pmod(F.xxhash64(ident), F.lit(bits)).alias("h1"),
                          F.pmod(F.xxhash64(ident, F.lit(1)), F.lit(bits)).alias("h2"), "text")
    sets = materialize(picked.mapInArrow(_pick_sets(words), "cid binary, n long, tokens binary")
                       .withColumn("slice", F.shiftrightunsigned(F.monotonically_increasing_id(), 9)), "jaccard_sets")
    prefixes = materialize(prefix_table(sets), "jaccard_prefixes")
    found = class_links(sets, prefixes, block)
    linked = classes.join(found, F.col("cid") == F.col("node"), "left").select(
        "cid", F.coalesce("root", "cid").alias("root"), "rep", "copies",
        F.col("root").isNotNull().alias("links"))
    linked = linked.filter("links OR copies > 1")
    named = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    answer = linked.select("cid", "root").join(named, "root").select(F.col("cid").alias("class"), "component_id", "root")
    return rows.join(answer, F.col("cid") == F.col("class"), "left").select(
        "doc_id", "row", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "root")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row. ``block``: most documents of a block (see stage 5)."""
    return _components_by_row(docs, id_col, text_col, block).select("doc_id", "n_shingles", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, the one of smallest id (of equal ids, or if no row has one, the first row).

    The rows are written once with a key, and stay or go by that key.
    """
    docs = materialize(docs.withColumn("__stay_row", F.monotonically_increasing_id()), "near_rows")
    found = _components_by_row(docs, id_col, text_col, row_col="__stay_row")
    alone = F.when(F.col("root").isNull(), F.col("row"))
    stay = found.filter(F.col("root").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(
        "root", alone.alias("alone")).agg(F.min("row").alias("__stay_row"))
    return docs.join(stay.select("__stay_row"), "__stay_row", "left_semi").drop("__stay_row")


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, string_split_regex(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13),
           'abcdefghijklmnopqrstuvwxyz     ')), ' +') AS ws
  FROM documents),
v AS (SELECT doc_id, list_filter(ws, lambda x: x <> '') AS ws FROM w),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM v),
n AS (SELECT doc_id, len(sh) AS n FROM s),
t AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * i >= 80 * (na.n + nb.n - i)),
u AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, u.y FROM r JOIN u ON u.x = r.seen)
SELECT n.doc_id, n.n AS n_shingles, min(r.seen) AS component_id FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY 1, 2
"""
