"""auric — dependable Bronze → Silver → Gold pipelines on PySpark.

Every operator takes and returns DataFrames (or writes them with one of the
repeatable write strategies in :mod:`auric.operators.write`).  Nothing here
collects data rows to the driver; the only driver-side values are bounded
summaries (partition values of one batch, bucket counts, verdicts).
"""

from auric.session import build_session, ensure_conf, workspace

__all__ = ["build_session", "ensure_conf", "workspace"]
