"""sparkledger: keeping financial and time-series tables up to date on Spark.

Payloads land as JSON; stored tables are versioned parquet snapshots.  Every
step -- cleaning, key translation, diffing, upserting, aligning dated events
-- is a DataFrame plan, so it runs distributed and is checked against SQL.
"""

from sparkledger.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
