"""Operator 10: BPE encoding and decoding with a contiguous rank array.

A word's symbols lie in one list and the ranks of adjacent pairs in a second
one beside it. The smallest rank is sought by a scan, the boundary between its
two parts is deleted, and the ranks of the two neighbouring pairs are looked
up anew, until no pair has a rank. That is the fastest way for the short words
of ordinary text; a word of over ``SCAN_SYMBOLS`` bytes would cost the square
of its length and goes through the heap of operator 3 instead (same result).

A narrow map over the rows, no shuffle. Identifiers and token strings of
distinct words are kept in a cache per Python worker, bounded by
``cache_words``, which changes nothing but speed.

Defined cases: null text is empty (no tokens, the digests of the empty
string); special strings inside a text are single tokens; texts are
normalised as the file says (composed form, lower case), so decoding gives
the token strings joined by single spaces; of equal ranks in a word the
leftmost pair merges first; repeated rows are encoded alike; a very long text
is encoded whole, a stretch between white space at a time; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.bpe_model import _BITS, BpeModel, heap_merge, per_worker, read_model
from churnlens.llm.common import pieces, table, whole_text

#: Fixed value: the pre-token pattern of word-end BPE files; white space is dropped.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
SCAN_SYMBOLS = 256
_NO_RANK = 1 << 40


def scan_merge(model: BpeModel, ids: list[int]) -> list[int]:
    """The symbols of one short word, merged."""
    rank = model.rank.get
    ranks = [rank(a << _BITS | b, _NO_RANK) for a, b in zip(ids, ids[1:])]
    while ranks:
        least = min(ranks)
        if least == _NO_RANK:
            break
        at = ranks.index(least)
        merged = ids[at] = model.made[least]
        del ids[at + 1], ranks[at]
        if at < len(ranks):
            ranks[at] = rank(merged << _BITS | ids[at + 1], _NO_RANK)
        if at:
            ranks[at - 1] = rank(ids[at - 1] << _BITS | merged, _NO_RANK)
    return ids


def normalise(text: str) -> str:
    """Composed form, then lower case character by character (a final sigma has no form of its own)."""
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


#: What str.split() drops though it is no white space.
_SEPARATORS = re.compile("[\x1c-\x1f]")


class WordCodec(dict):
    """Stretch between white space, as it stands in the text -> (ids joined by a space, tokens joined by a space).

    No pre-token crosses white space, so a stretch is normalised, cut and
    merged by itself.
    """

    def __init__(self, model: BpeModel, cache_words: int):
        self.model = model
        self.cache_words = cache_words
        self.find = regex.compile(PRE_TOKEN).findall

    def __missing__(self, stretch: str) -> tuple[str, str]:
        pair = self.joined(self.symbols(stretch))
        if len(self) < self.cache_words and len(stretch) < 64:
            self[stretch] = pair
        return pair

    def symbols(self, text: str) -> list[int]:
        """The merged symbols of a text without special strings."""
        out: list[int] = []
        for word in self.find(normalise(text)):
            ids = self.model.symbols(word)
            if len(ids) > SCAN_SYMBOLS:
                heap_merge(self.model, ids)
                out += [i for i in ids if i >= 0]
            else:
                out += scan_merge(self.model, ids)
        return out

    def joined(self, ids: list[int]) -> tuple[str, str]:
        return " ".join(map(self.model.id_text.__getitem__, ids)), " ".join(map(self.model.token.__getitem__, ids))

    def encode(self, text: str) -> tuple[str, str]:
        """The ids and the tokens of a text, each joined by single spaces."""
        if "<|" in text or _SEPARATORS.search(text):
            ids: list[int] = []
            for at, part in enumerate(self.model.split_specials(text)):
                ids += [self.model.number[part]] if at % 2 else self.symbols(part)
            return self.joined(ids)
        found = list(map(self.__getitem__, text.split()))
        return " ".join([x[0] for x in found]), " ".join([x[1] for x in found])


_ENCODED = "doc_id long, n_tokens long, ids array<int>, decoded string"
_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 digests: bool = False, cache_words: int = 100_000) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for every row; ``digests=True``: SHA-256 of the
    ids (decimal, joined by a space) and of the decoded text in their place, made in
    the same pass so that the long columns need not leave the task."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = per_worker(WordCodec, shared.value, cache_words)
        for batch in pieces(batches, 1, 2 << 20):
            counts, left, right = [], [], []
            for text in batch.column(1):
                ids, tokens = codec.encode(text.as_py())
                counts.append(ids.count(" ") + 1 if ids else 0)
                left.append(sha(ids) if digests else [int(x) for x in ids.split()])
                right.append(sha(tokens) if digests else tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()),
                 pa.array(left, pa.string() if digests else pa.list_(pa.int32())), pa.array(right, pa.string())],
                names=["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, _DIGESTS if digests else _ENCODED)


def op10_bpe_codec(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    # alone in its workers the query has room for more remembered words than a stage of the pipeline
    return encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True, cache_words=500_000)
