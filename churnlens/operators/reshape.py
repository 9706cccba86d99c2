"""Small reshaping helpers shared by the operator families."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (),
         name: str = "column", value: str = "value", as_type: str = "string") -> DataFrame:
    """Long form (ids..., column, value) of ``cols`` cast to one type.

    One pass over the table; replaces a loop of one job per column.
    """
    cast = df.select(*ids, *[F.col(c).cast(as_type).alias(c) for c in cols])
    return cast.unpivot(list(ids), list(cols), name, value)
