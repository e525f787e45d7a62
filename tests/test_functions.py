import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkledger.functions import (
    days_before,
    lenient_date,
    lenient_double,
    lenient_long,
    lenient_utc_timestamp,
    ref_date_text,
    snake_case,
    snake_columns,
    strip_chars,
    year_range,
)


@pytest.mark.parametrize("src,dst", [
    ("totalCurrentAssets", "total_current_assets"),
    ("already_snake", "already_snake"),
    ("plain", "plain"),
    ("epsTTM", "eps_ttm"),
    ("year1High", "year1high"),
    ("ABCd", "abcd"),
    ("aB", "a_b"),
])
def test_snake_case(src, dst):
    assert snake_case(src) == dst


def test_snake_columns_full_set(spark):
    cols = ["totalAssets", "shortTermDebt", "EBITDA", "taxRate2", "cash"]
    df = spark.createDataFrame([tuple(range(len(cols)))], cols)
    assert snake_columns(df).columns == ["total_assets", "short_term_debt", "ebitda", "tax_rate2", "cash"]


def test_snake_columns_rejects_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["fooBar", "foo_bar"])
    with pytest.raises(ValueError):
        snake_columns(df)


def test_lenient_casts(spark):
    df = spark.createDataFrame(
        [("2024", "2024-09-30", "2024-11-01 06:01:36", "0.97"),
         ("2024.7", "not a date", "junk", "x"),
         (" 12 ", "2024-09-30 10:00:00", "2024-11-01", None),
         ("", "", "", "")],
        "y string, d string, t string, v string",
    )
    out = df.select(lenient_long("y").alias("y"), lenient_date("d").alias("d"),
                    lenient_utc_timestamp("t").alias("t"), lenient_double("v").alias("v")).collect()
    assert [r.y for r in out] == [2024, None, 12, None]
    assert [r.d for r in out] == [dt.date(2024, 9, 30), None, dt.date(2024, 9, 30), None]
    assert out[0].t == dt.datetime(2024, 11, 1, 6, 1, 36)
    assert out[1].t is None and out[2].t == dt.datetime(2024, 11, 1)
    assert out[0].v == 0.97 and out[1].v is None


def test_strip_and_ref_date(spark):
    df = spark.createDataFrame([("M12", 2024), ("M01", 2023), ("S01", 2022), (None, 2021)], "p string, y int")
    out = df.select(strip_chars("p", "M").alias("m"), "y").withColumn(
        "r", ref_date_text("y", F.col("m").try_cast("int"), 14)).collect()
    assert [r.m for r in out] == ["12", "01", "S01", None]
    assert [r.r for r in out] == ["2024-12-14", "2023-1-14", None, None]


def test_date_helpers():
    assert days_before(dt.date(2025, 1, 1), 1825) == dt.date(2020, 1, 3)
    assert year_range(dt.date(2025, 6, 1), 10) == (2016, 2025)
