"""Scalar column expressions.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens.constants import DECISION_THRESHOLD, RISK_CUTS, RISK_LABELS


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_numeric(c: str | Column) -> Column:
    """Text to double; blank or unparsable text becomes null.

    Only decimal notation counts: the cast alone would take Java's type
    suffixes ('1d', '2F') for numbers.
    """
    text = F.trim(_c(c).cast("string"))
    return F.when(~text.rlike(r"[dDfF]$") | text.rlike(r"(?i)inf$"), text.try_cast("double"))


def blank_or_null(c: str | Column) -> Column:
    """True when the value is null or only whitespace."""
    x = _c(c)
    return x.isNull() | (F.trim(x.cast("string")) == F.lit(""))


def encode_binary(c: str | Column, positive: str = "Yes", negative: str = "No") -> Column:
    """Yes/No to 1/0; any other value to null."""
    x = _c(c)
    return (F.when(x == F.lit(positive), F.lit(1))
            .when(x == F.lit(negative), F.lit(0))
            .otherwise(F.lit(None).cast("int")))


def decode_binary(c: str | Column, positive: str = "Yes", negative: str = "No") -> Column:
    """1 to Yes, anything else to No."""
    return F.when(_c(c).cast("int") == 1, F.lit(positive)).otherwise(F.lit(negative))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den with a zero denominator replaced by one."""
    d = _c(den).cast("double")
    return _c(num).cast("double") / F.when(d == 0, F.lit(1.0)).otherwise(d)


def bin_expr(c: str | Column, edges: Sequence[float], labels: Sequence[str] | None = None,
             right: bool = False) -> Column:
    """Interval label of a value; outside all intervals gives null.

    ``right=False`` gives right-open intervals [e_i, e_{i+1}).
    """
    if labels is None:
        labels = [f"[{edges[i]},{edges[i + 1]})" if not right else f"({edges[i]},{edges[i + 1]}]"
                  for i in range(len(edges) - 1)]
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    x = _c(c)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x >= lo) & (x < hi) if not right else (x > lo) & (x <= hi)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(None).cast("string"))


def risk_band(p: str | Column, cuts: Sequence[float] = RISK_CUTS,
              labels: Sequence[str] = RISK_LABELS) -> Column:
    """Probability to Low / Medium / High; null stays null (C14)."""
    x = _c(p)
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for cut, lab in zip(cuts, labels[:-1]):
        out = out.when(x < cut, F.lit(lab))
    return out.otherwise(F.lit(labels[-1]))


def threshold_label(p: str | Column, t: float = DECISION_THRESHOLD, inclusive: bool = True) -> Column:
    """Probability to 0/1 class; ``inclusive`` picks >= over >."""
    x = _c(p)
    return (x >= t if inclusive else x > t).cast("int")


def pseudonymise(c: str | Column, salt: str) -> Column:
    """Salted SHA-256 of an identifier (C17)."""
    return F.sha2(F.concat(F.lit(salt), _c(c).cast("string")), 256)
