"""Data-quality checks: payload status, rejects, counts without extra passes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class PayloadStatusError(RuntimeError):
    pass


def require_status(payload: DataFrame, ok: str, col: str = "status") -> None:
    """Raise unless every payload document reports ``ok`` (checked before writing)."""
    bad = payload.filter(~F.coalesce(F.col(col) == F.lit(ok), F.lit(False))).limit(1).collect()
    if bad:
        raise PayloadStatusError(f"payload status {bad[0][col]!r}, expected {ok!r}")


def split_null_keys(df: DataFrame, keys: Iterable[str] | str) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: rows with a null in any key column go to rejects."""
    k = [keys] if isinstance(keys, str) else list(keys)
    any_null = F.lit(False)
    for c in k:
        any_null = any_null | F.col(c).isNull()
    return df.filter(~any_null), df.filter(any_null)


def key_metrics(df: DataFrame, key: str, name: str = "metrics") -> tuple[DataFrame, Observation]:
    """Attach row and null-key counts, collected by the next action on ``df``
    (no separate pass over the data)."""
    obs = Observation(name)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
    )
    return observed, obs


def observed(obs: Observation, names: Iterable[str]) -> dict[str, int]:
    """Metrics of an observation whose plan has run.

    When the optimizer removed the observed subplan (an empty input folds to
    an empty relation), no metrics are produced: nothing was seen, so every
    count is zero.
    """
    try:
        got = obs.get
    except Exception:  # noqa: BLE001 -- Spark reports the missing metrics row as an internal error
        got = {}
    return {n: int(got.get(n) or 0) for n in names}
