"""Operator 3: token counts by heap-and-linked-list byte-pair merging.

A text's count is the sum over its pre-tokens of initial symbols minus merges;
no identifiers are produced. Counting is a narrow map over the rows, without a
shuffle. Counts of distinct words are kept in a cache per Python worker;
``cache_words`` bounds its memory and changes nothing but speed.

Defined cases: null text is empty (0 bytes, 0 tokens, not over the limit); a
special string inside a text counts as one token, as the library does by
default; very long texts and very long words are counted whole (the heap makes
a word of n bytes cost n log n); of equal ranks in a word the leftmost pair
merges first; repeated rows are counted alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.bpe_model import BpeModel, heap_merge, per_worker, read_model
from churnlens.llm.common import table, whole_text

#: Fixed value: the pre-token pattern of byte-level BPE files. White space is the Unicode property.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
LIMIT = 512


#: White space other than blank and line feed, and the places where runs of white space form.
_OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class TokenCounter(dict):
    """Stretch of text between blanks -> number of tokens of the blank and the stretch.

    A pre-token holds a blank only as its first character, so where no white
    space stands next to a blank or a line feed a text can be counted stretch
    by stretch. A stretch that begins with a line feed follows that feed (one
    token) and no blank. Other texts are counted pre-token by pre-token.
    """

    def __init__(self, model: BpeModel, cache_words: int):
        self.model = model
        self.cache_words = cache_words
        self.find = regex.compile(PRE_TOKEN).findall

    def __missing__(self, stretch: str) -> int:
        if stretch[:1] == "\n":
            count = 1 + self.plain(stretch[1:])
        else:
            first, *rest = self.find(" " + stretch)
            if not rest:
                count = self.merged(first)
            else:  # the first pre-token may be known as a stretch of its own
                count = self[first[1:]] + sum(map(self.merged, rest))
        if len(self) < self.cache_words and len(stretch) < 64:
            self[stretch] = count
        return count

    def merged(self, word: str) -> int:
        """Initial symbols less merges of one pre-token."""
        ids = self.model.symbols(word)
        return len(ids) - heap_merge(self.model, ids) if len(ids) > 1 else len(ids)

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings, pre-token by pre-token."""
        total = 0
        for word in self.find(text):
            if word[0] == " " and len(word) > 1 and not word[1:].isspace():
                total += self[word[1:]]
            else:
                total += self.merged(word)
        return total

    def count(self, text: str) -> int:
        if "<|" in text:
            parts = self.model.split_specials(text)
            return len(parts) // 2 + sum(map(self.plain, parts[::2]))
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or _OTHER_SPACE.search(text):
            return self.plain(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.plain(first) + sum(map(self.__getitem__, rest))


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, cache_words: int = 1_500_000) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker(TokenCounter, shared.value, cache_words)
        for batch in batches:
            counts = [counter.count(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
