"""Writing a payload into a stored table: append and keyed upsert.

An upsert is one full outer join of the stored snapshot with the payload on
the natural key, producing the next snapshot:

* payload rows win over stored rows (a *presence flag*, not ``coalesce``, so
  a null in the payload does overwrite);
* stored columns the payload lacks keep their stored value;
* new keys get surrogate ids ``max(id) + 1, +2, ...`` in key order.

Keys are unique on both sides (payload deduplicated by the caller, null keys
rejected), so the join has no hot key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparkledger.operators.ranking import with_row_index
from sparkledger.operators.shape import apply_schema



def _keys(keys: Iterable[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def append(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored rows plus ``rows`` cast to the stored types (missing columns null)."""
    typed = apply_schema(rows, stored)
    return stored.unionByName(typed, allowMissingColumns=True).select(*stored.columns)


def update_non_null(left: DataFrame, right: DataFrame, keys: Iterable[str] | str) -> DataFrame:
    """Left join; where the right side has a non-null value it replaces the left's."""
    k = _keys(keys)
    r_cols = [c for c in right.columns if c not in k and c in left.columns]
    r = right.select(*k, *[F.col(c).alias(f"_r_{c}") for c in r_cols])
    joined = left.join(r, on=k, how="left")
    return joined.withColumns({c: F.coalesce(F.col(f"_r_{c}"), F.col(c)) for c in r_cols}).select(*left.columns)


def upsert(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Iterable[str] | str,
    pk: str | None = None,
    first_id: int | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Next rows of ``stored`` after applying ``incoming`` on ``keys``.

    ``pk`` names a surrogate id column the payload does not carry; new rows get
    ids from ``first_id``, or after the stored maximum.  Ids are numbered on the
    new *keys* only (a keys-only anti-join), joined to the payload side, and the
    result is then one full outer join.  Callers that store their table in
    partitions pass only those the payload touches (and ``first_id``).

    With ``observation``, the numbers of ``inserted`` and ``updated`` rows are
    collected by whichever action writes the result (no separate pass).
    """
    k = _keys(keys)
    shared = [c for c in incoming.columns if c in stored.columns and c != pk]
    inc = apply_schema(incoming.select(*shared), stored)
    if pk is not None and first_id is None:
        first_id = next_id(stored, pk)
    return _merge(stored, inc, k, shared, pk, first_id, observation)


def next_id(stored: DataFrame, pk: str) -> int:
    """One after the stored maximum (from Parquet footers where the scan allows), 1 in an empty table."""
    top = stored.agg(F.max(pk)).collect()[0][0]
    return 1 if top is None else top + 1


def _merge(stored: DataFrame, inc: DataFrame, k: list[str], shared: list[str], pk: str | None,
           start: int | None, observation: Observation | None = None) -> DataFrame:
    if pk is not None:
        fresh = inc.select(*k).join(stored.select(*k), on=k, how="left_anti").distinct()
        ids = with_row_index(fresh, [(c, "asc") for c in k], name="_new_id", start=start)
        inc = inc.join(ids, on=k, how="left")
    inc = inc.withColumn("_in", F.lit(True))
    s, i = stored.withColumn("_st", F.lit(True)).alias("s"), inc.alias("i")
    cond = None
    for c in k:
        e = F.col(f"s.{c}") == F.col(f"i.{c}")
        cond = e if cond is None else cond & e
    joined = s.join(i, cond, "full_outer")
    if observation is not None:
        joined = joined.observe(
            observation,
            F.count_if(F.col("s._st").isNull()).alias("inserted"),
            F.count_if(F.col("s._st").isNotNull() & F.col("i._in").isNotNull()).alias("updated"),
        )
    cols = []
    for c in stored.columns:
        if c in k:
            cols.append(F.coalesce(F.col(f"s.{c}"), F.col(f"i.{c}")).alias(c))
        elif c == pk:
            cols.append(F.coalesce(F.col(f"s.{c}"), F.col("i._new_id")).alias(c))
        elif c in shared:
            cols.append(F.when(F.col("i._in").isNotNull(), F.col(f"i.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        else:
            cols.append(F.col(f"s.{c}").alias(c))
    return joined.select(*cols)
