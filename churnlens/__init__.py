"""churnlens — customer-churn analytics as Spark DataFrame operators.

Every operator is a plain function ``DataFrame -> DataFrame`` that takes
column names as arguments, so it composes with ``df.transform`` and runs
unchanged on batch or streaming inputs where the semantics allow.
"""

from churnlens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
