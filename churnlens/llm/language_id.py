"""Operator 9: language identification by rank-order n-gram profiles.

A profile is a text's ``K`` most frequent character n-grams (1 to 3, lower
case, words set off by single blanks), by count and then by code. A document's
distance to a language is the sum over its profile of how far each n-gram is
out of place in the language's profile, ``K`` for one that is absent; the
nearest language wins, the first in code point order on a tie. The score is
1 - distance / greatest possible distance.

Fitting counts the n-grams of about ``fit_rows`` labelled documents of each
language (chosen by a hash of the id; the bound is this parameter) in a
map-side combined aggregate; the profiles, K rows a language, are broadcast.
Predicting is a narrow map over whole texts.

Defined cases: null text, or text without a letter, or no language learned:
``und`` with score 0; null ids are judged like others and never learned from;
characters beyond the basic plane count as one common letter; rows that repeat
are judged alike; a very long text is profiled whole; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import pieces, table, whole_text

K = 300
SLICE = 512 << 10
FIT_ROWS = 2000
MAX_LANGUAGES = 5000
UNKNOWN = "und"
_SPAN = 48  # bits of a gram code; the document's number in its slice lies above


@cache
def _letters() -> np.ndarray:
    """Code point -> lower-case letter as 16 bits, 32 for everything that is no letter."""
    out = np.full(0x110000, 32, np.uint64)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            code = ord(low) if len(low) == 1 else c
            out[c] = code if code < 0xFFFF else 0xFFFF
    return out


def gram_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (document number << 48 | gram code) of all n-grams, and whether each document has a letter."""
    whole = " ".join(texts) + " "
    codes = _letters()[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)]
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), [len(t) + 1 for t in texts])
    letter = codes != 32
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after a word
    has = np.zeros(len(texts), bool)
    has[owner[letter].astype(np.int64)] = True
    codes, owner = codes[keep], owner[keep] << np.uint64(_SPAN)
    parts = [(owner | codes)[codes != 32]]
    # grams never join two documents: a blank ends each document, and a gram that starts with it may not go on
    if len(codes) > 1:
        two = codes[:-1] << np.uint64(16) | codes[1:]
        ok = owner[:-1] == owner[1:]
        parts.append((owner[:-1] | two)[ok])
    if len(codes) > 2:
        three = two[:-1] << np.uint64(16) | codes[2:]
        parts.append((owner[:-2] | three)[ok[:-1] & ok[1:]])
    keys = np.concatenate(parts)
    keys.sort()
    return keys, has


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def top_grams(keys: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, gram, rank) of each document's k most frequent grams."""
    distinct, counts = _runs(keys)
    owner = (distinct >> np.uint64(_SPAN)).astype(np.int64)
    order = np.argsort(owner << 32 | (0xFFFFFFFF - counts), kind="stable")
    owner, distinct = owner[order], distinct[order]
    starts = np.searchsorted(owner, owner, side="left")
    rank = np.arange(len(owner)) - starts
    keep = rank < k
    return owner[keep], distinct[keep] & np.uint64((1 << _SPAN) - 1), rank[keep]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, gram, n), added up within each slice."""
    for batch in pieces(batches, 1, SLICE):
        langs = batch.column(0).to_pylist()
        names = sorted(set(langs))
        number = {x: i for i, x in enumerate(names)}
        keys, _ = gram_keys(batch.column(1).to_pylist())
        of_doc = np.array([number[x] for x in langs], np.uint64)
        lang = of_doc[(keys >> np.uint64(_SPAN)).astype(np.int64)]
        keys = lang << np.uint64(_SPAN) | keys & np.uint64((1 << _SPAN) - 1)
        keys.sort()
        distinct, counts = _runs(keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(names, object)[(distinct >> np.uint64(_SPAN)).astype(np.int64)], pa.string()),
             pa.array((distinct & np.uint64((1 << _SPAN) - 1)).astype(np.int64)), pa.array(counts)],
            names=["lang", "gram", "n"])


def fit_profiles(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 k: int = K, fit_rows: int = FIT_ROWS, seed: int = 5) -> DataFrame:
    """``lang, gram, rank``: the k most frequent grams of each language."""
    rows = train.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), whole_text(text_col).alias("text"),
        F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"))
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()  # one row a language
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    if not sizes:
        return rows.sparkSession.createDataFrame([], "lang string, gram long, rank int")
    share = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], min(1.0, fit_rows / r["count"]))))
    chosen = rows.filter(F.pmod("h", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).select("lang", "text")
    grams = chosen.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return grams.withColumn("rank", F.row_number().over(w) - 1).filter(F.col("rank") < k).select("lang", "gram", "rank")


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             k: int = K, carry: tuple[str, ...] = (), unlearned: str = UNKNOWN) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row (and the columns named in ``carry``, before them).

    The text travels once, also where it is carried.  ``unlearned``: what texts
    with a letter are called if there is no profile at all.
    """
    rows = profiles.orderBy("lang", "rank").collect()  # at most MAX_LANGUAGES * k rows
    langs = sorted({r["lang"] for r in rows})
    grams = np.array(sorted({r["gram"] for r in rows}), np.int64)
    ranks = np.full((len(langs), len(grams)), k, np.int64)
    for r in rows:
        ranks[langs.index(r["lang"]), np.searchsorted(grams, r["gram"])] = r["rank"]
    shared = docs.sparkSession.sparkContext.broadcast((langs, grams, ranks))

    def judge(texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs, grams, ranks = shared.value
        keys, has = gram_keys(texts)
        if not langs:
            return [unlearned if h else UNKNOWN for h in has], np.zeros(len(texts))
        owner, gram, rank = top_grams(keys, k)
        at = np.minimum(np.searchsorted(grams, gram.astype(np.int64)), len(grams) - 1)
        known = grams[at] == gram.astype(np.int64)
        size = np.bincount(owner, minlength=len(texts))
        far = np.empty((len(langs), len(texts)))
        for i in range(len(langs)):
            place = ranks[i][at]
            out = np.where(known & (place < k), np.abs(rank - place), k)
            far[i] = np.bincount(owner, weights=out, minlength=len(texts))
        best = far.argmin(axis=0)
        score = 1 - far.min(axis=0) / np.maximum(1, size * k)
        return [langs[b] if h else UNKNOWN for b, h in zip(best, has)], np.where(has, score, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at, SLICE):
            pred, score = judge([t or "" for t in batch.column(at).to_pylist()])
            kept = [k for k in range(batch.num_columns) if k != at or text_col in carry]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), pa.array(pred, pa.string()), pa.array(score)],
                names=[*(batch.schema.names[k] for k in kept), "lang_pred", "score"])

    own = [] if text_col in carry else [F.col(text_col).cast("string").alias("__text")]
    rows = docs.select(*own, *(F.col(c) for c in carry), F.col(id_col).alias("doc_id"))
    at = carry.index(text_col) if text_col in carry else 0
    out = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, out)


def drop_unknown(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose text has a letter, so that a language can be told; the others go.

    That also holds where no row names a language, so that none can be learned.
    """
    profiles = fit_profiles(docs, id_col, text_col, lang_col)
    # numbered names: no column of the input can clash with those of the result
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("doc_id", F.lit(None).cast("long"))
    judged = identify(rows, profiles, text_col=names[docs.columns.index(text_col)], carry=tuple(names),
                      unlearned="any")
    return judged.filter(F.col("lang_pred") != UNKNOWN).select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    docs = table(spark, sf_dir, "documents")
    profiles = fit_profiles(docs.filter(remainder != 1))
    return identify(docs, profiles).select(
        "doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
