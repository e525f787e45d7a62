"""Incremental execution of the table updates over newly landed files."""

from sparkledger.streaming.landing_stream import ENDPOINT_UPDATES, run_new_files

__all__ = ["ENDPOINT_UPDATES", "run_new_files"]
