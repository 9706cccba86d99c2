"""Operator 7: removal of repeated passages with a compressed FM-index per shard.

A window is 20 consecutive words of one document; every word covered by a
window that also starts earlier (smaller doc_id, or same document, earlier
start) is removed.

Equal windows must meet in one shard without every document being streamed
past every index, which would cost the square of the corpus. A window's
anchor is the 8-gram of least hash in it: equal windows have equal anchors,
and neighbouring windows mostly share one, so a document falls into regions
(the windows of one anchor, at most 13) and a region goes to the shard of its
anchor.

1. Anchors that occur more than once are found by packed counts: one entry a
   slice of texts and anchor. A region whose anchor is unique has no repeat.
2. Texts meet their repeated anchors (join by document) and give their regions
   as 32-bit word hashes, packed per shard. Equal regions of a slice are
   settled there: the first goes to the shard of its anchor, the others, known
   to be repeats, past any shard, so a passage costs its shard one entry a
   slice however often it stands there. An anchor with over ``HOT`` occurrences is split: its windows
   go to the shard of their own hash, one by one, so a passage that a third of
   all documents hold, in ever different surroundings, fills no single shard.
3. A shard concatenates its distinct regions in document order, builds an
   FM-index (bit-packed wavelet matrix) and streams every region through
   backward search. Windows whose matching statistic reaches 20 in a second
   place are repeats; the least text place of their suffix interval is the
   earliest, and all others are reported.
4. Reported windows go back to their documents.

Defined cases: null text has no words; texts under 20 words keep all; very
long texts are one document like any other; rows alike in id and text are one
document and get the same answer; rows with one id and different texts are
ordered by a hash of the text; null ids come last; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import pieces, shuffle_partitions, table, whole_text
from churnlens.llm.fm_index import FmIndex
from churnlens.llm.jaccard_join import _batch, _groups, _slice_key
from churnlens.llm.word_hashes import gram_hashes, mix, word_hashes
from churnlens.session import materialize

WINDOW = 20
ANCHOR = 8
SPAN = WINDOW - ANCHOR + 1  # anchors in a window
HOT = 4096
SLICE = 8 << 20
_LAST_ID = (1 << 63) - 1  # the place of a null id
_PLACE = np.uint64((1 << 32) - 1)


def window_anchors(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, their documents, places of their anchors, hashes of all 8-grams)."""
    grams = gram_hashes(words, ANCHOR)
    sizes = np.diff(offsets)
    count = np.maximum(0, sizes - WINDOW + 1)
    doc = np.repeat(np.arange(len(sizes)), count)
    starts = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(offsets[:-1], count)
    if not len(starts):
        return starts, doc, starts, grams
    # high bits of the hash, then the place: the leftmost of the least
    key = grams & ~_PLACE | np.arange(len(grams), dtype=np.uint64)
    least = key
    for step in (1, 2, 4):
        least = np.minimum(least[:-step], least[step:])
    least = np.minimum(least[:-(SPAN - 8)], least[SPAN - 8:])
    return starts, doc, (least[starts] & _PLACE).astype(np.int64), grams


# --- stage 1: anchors that occur more than once ---------------------------------------------------------------------

def _pack_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, dkey, text) -> per slice and bucket its anchors; those that the slice itself repeats pass with its documents."""
        for number, batch in enumerate(pieces(batches, 2, SLICE)):
            words, offsets = word_hashes(batch.column(2))
            _, doc, place, grams = window_anchors(words, offsets)
            new = np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]) if len(place) else place > 0
            anchors, owner = grams[place[new]], doc[new].astype(np.int32)
            order = np.argsort(anchors, kind="stable")
            anchors, owner = anchors[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])) if len(anchors) else order
            counts = np.diff(np.append(first, len(anchors)))
            several = np.repeat(counts > 1, counts)
            local = anchors[several].tobytes(), owner[several].tobytes()
            anchors, owner, counts = anchors[first], np.where(counts > 1, -1, owner[first]).astype(np.int32), counts.astype(np.int32)
            bucket = (anchors % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            anchors, owner, counts = anchors[order], owner[order], counts[order]
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            filled = [b for b in range(buckets) if cut[b + 1] > cut[b]]
            key = _slice_key(number)
            none = [None] * len(filled)
            ids = np.asarray(batch.column(0).fill_null(_LAST_ID)).astype(np.int64).tobytes()
            keys = np.asarray(batch.column(1)).astype(np.int64).tobytes()
            yield _batch(
                [pa.array([*filled, key % buckets], pa.int32()), pa.array([key] * (len(filled) + 1), pa.int64()),
                 pa.array([*(anchors[cut[b]:cut[b + 1]].tobytes() for b in filled), local[0]], pa.binary()),
                 pa.array([*(owner[cut[b]:cut[b + 1]].tobytes() for b in filled), local[1]], pa.binary()),
                 pa.array([*(counts[cut[b]:cut[b + 1]].tobytes() for b in filled), None], pa.binary()),
                 pa.array([*none, ids], pa.binary()), pa.array([*none, keys], pa.binary())],
                ["bucket", "slice", "anchors", "owners", "counts", "ids", "dkeys"])
    return run


_PACKED = "bucket int, slice long, anchors binary, owners binary, counts binary, ids binary, dkeys binary"
_KNOWN = "slice long, anchors binary, owners binary, hot binary, ids binary, dkeys binary"


def _repeated_anchors(hot_from: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per bucket: each slice gets back its anchors that occur more than once, and which of its anchors are hot."""
        for rows in _groups(batches, 0):
            out = [(r[1], r[2], r[3], None, r[5], r[6]) for r in rows if r[5] is not None]
            packed = [r for r in rows if r[5] is None]
            if packed:
                parts = [np.frombuffer(r[2], np.uint64) for r in packed]
                every, inverse = np.unique(np.concatenate(parts), return_inverse=True)
                total = np.bincount(inverse, weights=np.concatenate([np.frombuffer(r[4], np.int32) for r in packed]))
                at = 0
                for r, part in zip(packed, parts):
                    n = total[inverse[at:at + len(part)]]
                    at += len(part)
                    owner = np.frombuffer(r[3], np.int32)
                    again, hot = (n > 1) & (owner >= 0), n > hot_from
                    if again.any() or hot.any():
                        out.append((r[1], part[again].tobytes(), owner[again].tobytes(), part[hot].tobytes(), None, None))
            yield _batch([pa.array([o[0] for o in out], pa.int64()),
                          *(pa.array([o[k] for o in out], pa.binary()) for k in range(1, 6))],
                         ["slice", "anchors", "owners", "hot", "ids", "dkeys"])
    return run


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice: (place, dkey, anchors, hot) of its documents with repeated anchors."""
    for rows in _groups(batches, 0):
        ids = np.frombuffer(next(r[4] for r in rows if r[4] is not None), np.int64)
        keys = np.frombuffer(next(r[5] for r in rows if r[5] is not None), np.int64)
        anchors = np.concatenate([np.frombuffer(r[1], np.uint64) for r in rows])
        owner = np.concatenate([np.frombuffer(r[2], np.int32) for r in rows])
        hot = np.unique(np.concatenate([np.frombuffer(r[3] or b"", np.uint64) for r in rows]))
        order = np.lexsort((anchors, owner))
        anchors, owner = anchors[order], owner[order]
        is_hot = np.isin(anchors, hot)
        docs = np.unique(owner)
        cut = np.append(np.searchsorted(owner, docs), len(owner))
        yield _batch([pa.array(ids[docs]), pa.array(keys[docs]),
                      pa.array([np.unique(anchors[a:b]).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                      pa.array([np.unique(anchors[a:b][is_hot[a:b]]).tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                     ["place", "dkey", "anchors", "hot"])


def repeated_anchors(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``place, dkey, anchors, hot`` for the documents (``place, dkey, text``) with anchors that occur again."""
    buckets = 8 * shuffle_partitions(docs.sparkSession)
    packed = docs.select("place", "dkey", "text").mapInArrow(_pack_anchors(buckets), _PACKED)
    known = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_repeated_anchors(hot), _KNOWN)
    return known.repartition("slice").sortWithinPartitions("slice").mapInArrow(
        _per_document, "place long, dkey long, anchors binary, hot binary")


# --- stage 2: regions -----------------------------------------------------------------------------------------------

def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def _pack_regions(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(place, dkey, text, anchors, hot) -> regions of repeated anchors, packed per shard."""
        for number, batch in enumerate(pieces(batches, 2, SLICE)):
            words, offsets = word_hashes(batch.column(2))
            starts, doc, place, grams = window_anchors(words, offsets)
            keep, hot = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            for k, (own, warm) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                a, b = cut[k], cut[k + 1]
                at = grams[place[a:b]]
                keep[a:b] = _member(np.frombuffer(own, np.uint64), at)
                if warm:
                    hot[a:b] = _member(np.frombuffer(warm, np.uint64), at)
            starts, doc, place, hot = starts[keep], doc[keep], place[keep], hot[keep]
            if not len(starts):
                continue
            windows = gram_hashes(words, WINDOW)
            new = np.concatenate([[True], hot[1:] | (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
                                  | (starts[1:] != starts[:-1] + 1)])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(starts)))
            begin, doc, place, hot = starts[first], doc[first], place[first], hot[first]
            # the first and the last window hold all words of a region
            same = mix(windows[begin] * np.uint64(0xD6E8FEB86659FD93) + windows[begin + count - 1] + count.astype(np.uint64))
            shard = (np.where(hot, windows[begin], grams[place]) % np.uint64(shards)).astype(np.int64)
            ids = np.asarray(batch.column(0)).astype(np.int64)[doc]
            keys = np.asarray(batch.column(1)).astype(np.int64)[doc]
            at = begin - offsets[doc]
            order = np.lexsort((at, keys, ids, same, shard))
            shard, same, ids, keys, at, begin, count = (x[order] for x in (shard, same, ids, keys, at, begin, count))
            again = np.concatenate([[False], (same[1:] == same[:-1]) & (shard[1:] == shard[:-1])])
            twin = np.concatenate([[False], (ids[1:] == ids[:-1]) & (keys[1:] == keys[:-1]) & (at[1:] == at[:-1])])
            yield from _region_rows(shard, ids, keys, at, count, begin, words, ~again, True)
            # what is settled needs no index: it goes along with any shard, a slice's all to one
            anywhere = np.full(len(shard), _slice_key(number) % shards)
            yield from _region_rows(anywhere, ids, keys, at, count, begin, words, again & ~twin, False)
    return run


def _region_rows(shard, ids, keys, at, count, begin, words, chosen, with_words: bool) -> Iterator[pa.RecordBatch]:
    shard, ids, keys, at, count, begin = (x[chosen] for x in (shard, ids, keys, at, count, begin))
    if not len(shard):
        return
    size = count + WINDOW - 1
    flat = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    text = words[flat].astype(np.uint32) if with_words else None
    edge = np.concatenate([[0], np.cumsum(size)])
    values, cut = np.unique(shard, return_index=True)
    cut = np.append(cut, len(shard))
    spans = list(zip(cut, cut[1:]))
    yield _batch([pa.array(values.astype(np.int32)),
                  *(pa.array([x[a:b].astype(t).tobytes() for a, b in spans], pa.binary())
                    for x, t in ((ids, np.int64), (keys, np.int64), (at, np.int32), (count, np.uint8))),
                  pa.array([text[edge[a]:edge[b]].tobytes() if with_words else None for a, b in spans], pa.binary())],
                 ["shard", "ids", "dkeys", "starts", "counts", "words"])


_REGIONS = "shard int, ids binary, dkeys binary, starts binary, counts binary, words binary"
_REMOVED = "place long, dkey long, start int, mask int"


# --- stage 3: shards ------------------------------------------------------------------------------------------------

def shard_repeats(ids: np.ndarray, keys: np.ndarray, at: np.ndarray, count: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each region, in document order, the windows (bits) whose words start earlier in the shard."""
    size = count + WINDOW - 1
    alphabet, symbols = np.unique(words, return_inverse=True)
    # text: every region followed by symbol 0
    region = np.repeat(np.arange(len(count)), size)
    text = np.zeros(len(words) + len(count), np.int64)
    text[np.arange(len(words)) + region] = symbols + 1
    begin = np.cumsum(size + 1) - (size + 1)
    owner = np.repeat(np.arange(len(count)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    place = begin[owner] + offset
    index = FmIndex(text, len(alphabet) + 1, WINDOW)
    piece, low, high = index.repeats(text, place, WINDOW)
    later = index.first_places(low, high) < place[piece]
    mask = np.zeros(len(count), np.int64)
    np.bitwise_or.at(mask, owner[piece[later]], 1 << offset[piece[later]])
    return mask


def _search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard: the windows that start earlier elsewhere, as bits from a start."""
    for rows in _groups(batches, 0):
        parts = []
        for settled in (True, False):
            own = [r for r in rows if (r[5] is None) == settled]
            if not own:
                continue
            ids, keys, at, count = (np.concatenate([np.frombuffer(r[k], t) for r in own]).astype(np.int64)
                                    for k, t in ((1, np.int64), (2, np.int64), (3, np.int32), (4, np.uint8)))
            if settled:
                parts.append((ids, keys, at, (1 << count) - 1))
                continue
            words = np.concatenate([np.frombuffer(r[5], np.uint32) for r in own])
            size = count + WINDOW - 1
            edge = np.cumsum(size) - size
            order = np.lexsort((at, keys, ids))
            # one entry for a place that several rows alike have
            alike = np.concatenate([[False], (ids[order][1:] == ids[order][:-1]) & (keys[order][1:] == keys[order][:-1])
                                    & (at[order][1:] == at[order][:-1])])
            order = order[~alike]
            ids, keys, at, count, size, edge = (x[order] for x in (ids, keys, at, count, size, edge))
            flat = np.repeat(edge - (np.cumsum(size) - size), size) + np.arange(size.sum())
            words = words[flat]
            # equal regions: only the first is indexed, the others repeat it whole
            edge = np.cumsum(size) - size
            seen: dict[bytes, int] = {}
            raw = words.tobytes()
            first = np.array([seen.setdefault(raw[4 * a:4 * (a + s)], k) == k
                              for k, (a, s) in enumerate(zip(edge.tolist(), size.tolist()))])
            parts.append((ids[~first], keys[~first], at[~first], (1 << count[~first]) - 1))
            chosen = np.repeat(first, size)
            mask = shard_repeats(ids[first], keys[first], at[first], count[first], words[chosen])
            hit = np.flatnonzero(mask)
            parts.append((ids[first][hit], keys[first][hit], at[first][hit], mask[hit]))
        ids, keys, at, mask = (np.concatenate([p[k] for p in parts]) for k in range(4))
        yield _batch([pa.array(ids), pa.array(keys), pa.array(at.astype(np.int32)), pa.array(mask.astype(np.int32))],
                     ["place", "dkey", "start", "mask"])


# --- stage 4: documents ---------------------------------------------------------------------------------------------

def covered(n: int, starts: list[int], masks: list[int]) -> np.ndarray:
    """Which of n words the reported windows cover."""
    edge = np.zeros(n + WINDOW + 1, np.int64)
    for start, mask in zip(starts, masks):
        while mask:
            k = (mask & -mask).bit_length() - 1
            edge[start + k] += 1
            edge[start + k + WINDOW] -= 1
            mask &= mask - 1
    return np.cumsum(edge)[:n] > 0


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _remove(texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for text, reported in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                words = text.as_py().split()
                n = len(words)
                if reported:
                    out = covered(n, [r["start"] for r in reported], [r["mask"] for r in reported])
                    words = [w for w, x in zip(words, out.tolist()) if not x]
                total.append(n)
                gone.append(n - len(words))
                left = b" ".join(words)
                kept.append(left.decode("utf-8") if texts else hashlib.sha256(left).hexdigest())
            yield _batch([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                         ["doc_id", "n_words", "n_removed", "kept" if texts else "kept_sha256"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = True,
                   hot: int = HOT) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row: the words that stay, joined by single blanks.

    ``texts=False`` gives the SHA-256 of that text as ``kept_sha256`` instead.
    ``hot``: occurrences from which an anchor's windows are dealt out one by one.
    """
    shards = 8 * shuffle_partitions(docs.sparkSession)
    text = whole_text(text_col)
    ident = F.col(id_col).cast("long")
    rows = docs.select(ident.alias("doc_id"), F.coalesce(ident, F.lit(_LAST_ID)).alias("place"),
                       F.xxhash64(text).alias("dkey"), text.alias("text"))
    known = materialize(repeated_anchors(rows, hot).groupBy("place", "dkey").agg(
        F.first("anchors").alias("anchors"), F.first("hot").alias("hot")), "repeated_anchors")
    with_anchors = rows.select("place", "dkey", "text").join(known, ["place", "dkey"]).select(
        "place", "dkey", "text", "anchors", "hot").sortWithinPartitions("place", "dkey")
    removed = (with_anchors.mapInArrow(_pack_regions(shards), _REGIONS)
               .repartition("shard").sortWithinPartitions("shard").mapInArrow(_search_shards, _REMOVED))
    reported = materialize(removed.groupBy("place", "dkey").agg(
        F.collect_list(F.struct("start", "mask")).alias("reported")), "repeated_windows")
    joined = rows.join(reported, ["place", "dkey"], "left").select("doc_id", "text", "reported")
    return joined.mapInArrow(_remove(texts), _RESULT.replace("kept_sha256", "kept") if texts else _RESULT)


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), texts=False)


OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS gram FROM p),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS rn FROM g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r WHERE rn > 1),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
k AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) FILTER (WHERE gone.i IS NULL) AS kept,
         count(gone.i) AS n_removed
  FROM x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY x.doc_id)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
"""
