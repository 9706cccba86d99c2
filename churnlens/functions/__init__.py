"""Column-level building blocks (JVM expressions) and the p-value helpers."""

from churnlens.functions.columns import (  # noqa: F401
    bin_expr, blank_or_null, decode_binary, encode_binary,
    pseudonymise, risk_band, safe_ratio, threshold_label, to_numeric,
)
