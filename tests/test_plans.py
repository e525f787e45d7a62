"""Plan-shape checks: the properties the design relies on at scale."""

import contextlib
import io
import os
import uuid

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from sparkledger.operators import upsert

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@needs_data
def test_top_k_limits_before_the_shuffle(spark):
    p = plan(queries()["topk_per_key"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    assert p.index("Final") < p.index("Exchange hashpartitioning") < p.index("Partial")


@needs_data
def test_filters_and_projection_reach_the_scan(spark):
    p = plan(queries()["recent_range"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    read_schema = p[p.index("ReadSchema"):].splitlines()[0]
    assert "o_totalprice" not in read_schema and "o_orderpriority" not in read_schema
    assert "Exchange" not in p


@needs_data
def test_diff_reads_only_stored_keys(spark):
    p = plan(queries()["new_rows"](spark, SF))
    assert "LeftAnti" in p
    stored_scan = [line for line in p.splitlines() if "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in line]
    assert stored_scan, p


def test_upsert_is_one_full_outer_join(spark):
    stored = spark.range(1000).select(F.col("id").alias("id"), (F.col("id") % 50).alias("k"), F.lit("v").alias("val"))
    incoming = spark.range(100).select((F.col("id") % 50).alias("k"), F.lit("n").alias("val"))
    p = plan(upsert(stored, incoming, ["k"], pk="id"))
    assert p.count("FullOuter") == 1 and "SinglePartition" not in p.split("BroadcastExchange")[0]


def jobs_of(spark, build):
    """Spark jobs that start while a plan is only being built."""
    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@needs_data
def test_no_job_is_started_by_a_size_check(spark):
    q = queries()
    assert jobs_of(spark, lambda: q["value_map"](spark, SF)) <= 4 * jobs_of(spark, lambda: q["scan_table"](spark, SF))  # four tables are opened
    assert jobs_of(spark, lambda: q["fk_filtered_map"](spark, SF)) <= 4  # opening the four tables
    # Opening the table, sampling for the ranges, and the one write of the numbered rows (a job a stage).
    assert jobs_of(spark, lambda: q["row_index"](spark, SF)) <= 8


@needs_data
def test_small_lookups_are_broadcast_by_the_planner(spark):
    p = plan(queries()["fk_filtered_map"](spark, SF))
    assert "BroadcastExchange" in p          # the category lookup, by its measured size
