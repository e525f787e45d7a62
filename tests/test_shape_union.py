import pytest
from pyspark.sql import types as T
from pyspark.errors import NumberFormatException

from sparkledger.operators import (
    add_constants,
    apply_schema,
    blank_to_null,
    common_columns,
    drop_null_rows,
    stack,
    stack_diagonal,
    supertype,
)


def test_blank_to_null_only_strings(spark):
    df = spark.createDataFrame([("", "left", 7), ("mid", "", 8), ("", "", 9)], "a string, b string, n long")
    out = blank_to_null(df).collect()
    assert [r.a for r in out] == [None, "mid", None]
    assert [r.b for r in out] == ["left", None, None]
    assert [r.n for r in out] == [7, 8, 9]


def test_blank_to_null_keeps_spaces(spark):
    out = blank_to_null(spark.createDataFrame([(" ",), ("",)], "a string")).collect()
    assert [r.a for r in out] == [" ", None]


def test_apply_schema_casts_matching_columns(spark):
    template = spark.createDataFrame([(2.5, 4)], "price double, units int")
    out = apply_schema(spark.createDataFrame([(9, "3", "kept")], "price long, units string, note string"), template)
    assert dict(out.dtypes) == {"price": "double", "units": "int", "note": "string"}
    assert tuple(out.first()) == (9.0, 3, "kept")


def test_apply_schema_same_schema_noop(spark):
    df = spark.createDataFrame([(3, "z")], "a long, b string")
    assert apply_schema(df, df).schema == df.schema


def test_apply_schema_strict_and_lenient(spark):
    df = spark.createDataFrame([("12",), ("x",)], "a string")
    schema = T.StructType([T.StructField("a", T.LongType())])
    with pytest.raises(NumberFormatException):
        apply_schema(df, schema).collect()
    assert [r.a for r in apply_schema(df, schema, lenient=True).collect()] == [12, None]


def test_common_columns_table_order(spark):
    stored = spark.createDataFrame([(1, "K-10", "kettle", None)], "id long, symbol string, description string, created_at string")
    incoming = spark.createDataFrame([("big kettle", "K-10", "x")], "description string, symbol string, extra_field string")
    cols, old, new = common_columns(stored.columns, stored, incoming, keys="symbol")
    assert cols == ["symbol", "description"]
    assert old.columns == new.columns == ["symbol", "description"]
    with pytest.raises(ValueError):
        common_columns(stored.columns, stored, incoming, keys="id")


def test_add_constants_and_drop_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "a long, v double")
    out = add_constants(df, {"name": "cpi-u", "flag": True, "id": (None, "bigint")})
    assert dict(out.dtypes)["id"] == "bigint"
    assert [r.a for r in drop_null_rows(out, "v").collect()] == [2]


def test_supertype_rules():
    assert supertype(T.IntegerType(), T.LongType()) == T.LongType()
    assert supertype(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert supertype(T.LongType(), T.StringType()) == T.StringType()
    assert supertype(T.NullType(), T.DateType()) == T.DateType()
    with pytest.raises(TypeError):
        supertype(T.BooleanType(), T.LongType())


def test_stack_relaxed(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    b = spark.createDataFrame([(3.5, 4)], "v double, k long")
    out = stack([a, b])
    assert dict(out.dtypes) == {"k": "bigint", "v": "double"}
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2.0), (4, 3.5)]
    with pytest.raises(ValueError):
        stack([a, spark.createDataFrame([(1,)], "k int")])


def test_stack_diagonal(spark):
    a = spark.createDataFrame([(1, "x")], "k long, s string")
    b = spark.createDataFrame([(2, 9.5)], "k long, f double")
    out = stack_diagonal([a, b])
    assert out.columns == ["k", "s", "f"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", None), (2, None, 9.5)]
