"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. language_id: documents without a letter in a learned language go.
2. exact_dedup: of texts equal up to white space one stays.
3. jaccard_join: of documents linked by shingle similarity 0.8 or more one stays.
4. mix_sources: sources are brought to weights 5, 2, 1 (repeating); a document
   is repeated or left out as the mix says, at most three times.
5. bpe_codec: the remaining texts as token ids.

Language identification and the seeded mix have no SQL; the tests hold every
stage against a brute-force version instead.

Defined cases, as the stages state them: null, empty and blank texts hold no
letter and go first; rows are kept, dropped and repeated one by one, by a key
written with them, so null and repeated ids, repeated rows and ties do not mix
rows up (which of rows alike in all columns stays is no matter); very long
texts pass whole; an empty table gives an empty result; other columns, whatever
their names, travel along up to the last stage, which returns ``doc_id,
n_tokens, ids``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm.bpe_codec import encode_texts
from churnlens.llm.common import bounded_batches
from churnlens.llm.exact_dedup import drop_copies
from churnlens.llm.jaccard_join import drop_near_copies
from churnlens.llm.language_id import drop_unknown
from churnlens.llm.mixing import cycling_weights, mix
from churnlens.session import materialize

TOKENIZER = "word_bpe_49k.json"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return drop_unknown(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return drop_near_copies(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return mix(docs, cycling_weights())


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    import public_tokenizers
    return encode_texts(docs, public_tokenizers.path(TOKENIZER)).select("doc_id", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("mix_sources", mix_stage),
    ("bpe_codec", token_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
