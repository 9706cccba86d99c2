"""Helpers shared by the corpus operators.

Text reaches Python as Arrow record batches. ``pieces`` cuts a batch into
slices of bounded text size, so the numpy work of a task needs memory in
proportion to one slice (or to one very long document), not to the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but these six ASCII white-space characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[32, 9, 10, 11, 12, 13]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch between Spark and Python; a task holds a few of them at a time.
BATCH = "16m"


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default for this session, unless it already asks for something else."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "64m") in ("64m", "64MB", "67108864", "67108864b"):
        spark.conf.set(key, BATCH)


def whole_text(col: str):
    """The text as a string, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def pieces(batches: Iterator[pa.RecordBatch], text: int, max_bytes: int = 4 << 20,
           max_rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``max_bytes`` of text column number ``text`` each."""
    for batch in batches:
        ends = np.cumsum(lengths(batch.column(text)))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, min(at + max_rows, int(np.searchsorted(ends, base + max_bytes, side="right"))))
            yield batch.slice(at, to - at)
            at = to


def lengths(col: pa.Array) -> np.ndarray:
    """Bytes of each value, 0 for null."""
    import pyarrow.compute as pc
    return np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values one after another, offsets); null counts as empty."""
    sizes = lengths(col)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    joined = b"".join(x for x in col.cast(pa.binary()).to_pylist() if x)
    return np.frombuffer(joined, np.uint8), offsets
