"""Column-shape operators: blanks to null, schema casts, common columns,
constant columns and null-row removal."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(df: DataFrame) -> DataFrame:
    """Exact ``""`` in any top-level string column becomes null (no trimming)."""
    fixes = {
        f.name: F.nullif(F.col(f.name), F.lit(""))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(fixes) if fixes else df


def _schema_of(template: DataFrame | T.StructType) -> T.StructType:
    return template.schema if isinstance(template, DataFrame) else template


def apply_schema(df: DataFrame, template: DataFrame | T.StructType, lenient: bool = False) -> DataFrame:
    """Cast columns of ``df`` to the template's types where names match.

    Columns the template lacks keep their type.  Strict by default: under ANSI
    mode a value that does not fit raises; ``lenient=True`` yields null instead.
    """
    types = {f.name: f.dataType for f in _schema_of(template).fields}
    casts: dict[str, Column] = {}
    for f in df.schema.fields:
        want = types.get(f.name)
        if want is None or want == f.dataType:
            continue
        col = F.col(f.name)
        casts[f.name] = col.try_cast(want) if lenient else col.cast(want)
    return df.withColumns(casts) if casts else df


def common_columns(
    target_columns: Iterable[str] | T.StructType,
    stored: DataFrame,
    incoming: DataFrame,
    keys: Iterable[str] | str | None = None,
) -> tuple[list[str], DataFrame, DataFrame]:
    """Columns present in both the target table and the payload, in table order.

    Returns the list and both frames projected on it.  A key column missing
    from the payload is an error, since nothing could be diffed.
    """
    names = target_columns.fieldNames() if isinstance(target_columns, T.StructType) else list(target_columns)
    have = set(incoming.columns)
    cols = [c for c in names if c in have]
    for k in [keys] if isinstance(keys, str) else list(keys or []):
        if k not in cols:
            raise ValueError(f"key column {k!r} is not shared by table and payload")
    return cols, stored.select(*cols), incoming.select(*cols)


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add literal columns.  A value may be ``(value, type)`` to type a null."""
    cols: dict[str, Column] = {}
    for name, value in values.items():
        if isinstance(value, tuple):
            v, t = value
            cols[name] = F.lit(v).cast(t)
        else:
            cols[name] = F.lit(value)
    return df.withColumns(cols)


def drop_null_rows(df: DataFrame, subset: Iterable[str] | str) -> DataFrame:
    return df.dropna(subset=[subset] if isinstance(subset, str) else list(subset))
