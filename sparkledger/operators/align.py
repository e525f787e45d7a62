"""Ordinal alignment of dated events (earnings) with reporting periods.

Per asset, with ``cut = (second-newest period date, or as_of) + grace``:

* events and periods dated on or before ``cut`` are *eligible*;
* the k-th newest eligible event takes the id of the k-th newest eligible
  period; surplus eligible events are dropped, surplus periods ignored;
* every other event is a *future* estimate: its date becomes the sentinel and
  it takes the asset's placeholder period id;
* one row per period id survives -- the last in newest-first order, i.e. the
  oldest (so the nearest future estimate), null dates counting as newest;
* rows left without an id (unmapped asset, no placeholder) are rejects.

Spark form: no loops and no global sort.  Events are ranked once per (asset,
eligible) and left-joined with the ranked periods on (asset, eligible, seq), so
future events, which no period matches, need no branch of their own.  The ranks
come from ``sequence_within``, which spreads a hot asset over many tasks, or from a
plain window where the caller vouches for bounded groups.  Events without an asset can
never match: they go to the rejects before any join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sparkledger.functions.dates import plus_interval
from sparkledger.operators.ranking import keep_first, nth_latest, sequence_in_small_groups, sequence_within
from sparkledger.schemas import ALIGN_GRACE, SENTINEL_DATE


def instant(value: dt.datetime) -> Column:
    """A wall-clock instant as a timestamp literal read in the session zone
    (not converted through the Python process's local zone)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def period_cutoffs(
    periods: DataFrame,
    key: str,
    date: str,
    period_id: str,
    as_of: dt.datetime,
    grace: str = ALIGN_GRACE,
) -> DataFrame:
    """``(key, _cut)``: second-newest period date (nulls sort newest) plus
    ``grace``; ``as_of`` plus ``grace`` for assets with fewer than two periods."""
    second = nth_latest(
        periods, key, [(date, "desc_nulls_first"), (period_id, "desc")], 2, date, out="_second"
    )
    base = F.when(F.col("_have") >= 2, F.col("_second")).otherwise(instant(as_of))
    return second.select(key, plus_interval(base, grace).alias("_cut"))


def align_events(
    events: DataFrame,
    periods: DataFrame,
    *,
    as_of: dt.datetime,
    key: str = "asset_id",
    date: str = "accepted_date",
    period_id: str = "id",
    out: str = "reporting_period_id",
    tiebreak: Sequence[str],
    grace: str = ALIGN_GRACE,
    sentinel: str = SENTINEL_DATE,
    observation: Observation | None = None,
    small_groups: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Return ``(aligned, rejects)``.

    ``events`` carry ``key``, ``date`` (timestamp) and payload columns, with
    ``tiebreak`` columns making ``(key, date, tiebreak)`` unique.  ``periods``
    carry ``period_id``, ``key`` and ``date``; placeholders are dated at the
    sentinel.  ``aligned`` has ``out`` plus the payload columns; ``key`` and
    ``date`` are dropped.  ``rejects`` keep every column and ``out`` (null).
    With ``observation``, the counts of resolved rows and of rows left without
    an id (``resolved``, ``unaligned``) are collected by whichever action runs
    ``aligned`` -- no separate pass; rows without a key are not among them.
    ``small_groups``: the caller knows that no key has many events or periods.
    """
    tb = list(tiebreak)
    sentinel_ts = F.lit(sentinel).cast("timestamp")
    p = periods.select(period_id, key, date).filter(F.col(key).isNotNull())
    cuts = period_cutoffs(p, key, date, period_id, as_of, grace)
    # Assets without periods fall back to as_of; a null cut (second-newest
    # period undated) makes nothing eligible.
    default_cut = plus_interval(instant(as_of), grace)
    rank = sequence_in_small_groups if small_groups else sequence_within
    newest_first = [(date, "desc_nulls_first")]

    marked = cuts.withColumn("_has_cut", F.lit(True))
    cut = F.when(F.col("_has_cut"), F.col("_cut")).otherwise(default_cut)
    keyed = events.filter(F.col(key).isNotNull()).join(marked, on=key, how="left")
    ev = keyed.withColumn("_elig", F.coalesce(F.col(date) <= cut, F.lit(False))).drop("_cut", "_has_cut")
    ev = rank(ev, [key, "_elig"], newest_first + [(c, "asc") for c in tb], name="_seq")
    per = p.join(cuts, on=key, how="inner").filter(F.col(date) <= F.col("_cut")).drop("_cut")
    per = rank(per, key, newest_first + [(period_id, "desc")], name="_seq").select(
        key, F.lit(True).alias("_elig"), "_seq", F.col(period_id).alias("_matched"))
    # Eligible events pair with the same-rank period; surplus ones drop out.
    stacked = ev.join(per, on=[key, "_elig", "_seq"], how="left").filter(~F.col("_elig") | F.col("_matched").isNotNull())
    stacked = stacked.drop("_elig", "_seq")

    # Unmatched rows move to the sentinel date and take the placeholder id.
    placeholders = periods.filter(F.col(date) == sentinel_ts).select(
        F.col(key).alias("_ph_key"), F.col(period_id).alias("_ph_id")
    )
    placeholders = keep_first(placeholders, "_ph_key", [("_ph_id", "desc")])
    dated = stacked.withColumn("_orig_date", F.col(date)).withColumn(
        date, F.when(F.col("_matched").isNull(), sentinel_ts).otherwise(F.col(date))
    )
    with_ph = dated.join(
        placeholders,
        (dated[key] == placeholders["_ph_key"]) & (dated[date] == sentinel_ts),
        "left",
    )
    resolved = with_ph.withColumn(out, F.coalesce("_ph_id", "_matched")).drop("_ph_key", "_ph_id", "_matched")
    if observation is not None:
        resolved = resolved.observe(
            observation, F.count(F.lit(1)).alias("resolved"), F.count_if(F.col(out).isNull()).alias("unaligned"))

    lost = resolved.filter(F.col(out).isNull()).withColumn(date, F.col("_orig_date")).drop("_orig_date")
    keyless = events.filter(F.col(key).isNull()).withColumn(out, F.lit(None).cast(periods.schema[period_id].dataType))
    rejects = lost.unionByName(keyless)
    good = resolved.filter(F.col(out).isNotNull())
    # Keep the last row per id in newest-first order: oldest date, nulls last.
    kept = keep_first(good, out, [("_orig_date", "asc_nulls_last")] + [(c, "desc") for c in tb])
    aligned = kept.drop(key, date, "_orig_date")
    return aligned, rejects
