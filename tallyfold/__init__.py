"""tallyfold — field-report reconciliation on Spark.

Operators turn messy form submissions into clean, dense indicator tables:
ordered classification with a quarantine, dense count matrices, a staged
string-distance join against an official place list, reviewer decisions,
and a multi-source merge with a placeholder precedence rule.
"""

from tallyfold.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
