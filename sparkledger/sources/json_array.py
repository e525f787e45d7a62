"""Large JSON arrays of objects, read by byte ranges.

One response file may be a single array of any size.  The text source cuts files at a separator, so with
``}`` as the separator every task reads its own range.  Whether a brace counts depends on
what lies before it (it may stand in a string), which a task cannot see.  So:

1. Each block (byte range) is scanned for both cases, starting outside or inside a string:
   the parity of its quotes and the depth it adds.
2. These totals, a row a block, are added up in the order of the blocks of a file.
3. With its true start every piece is known to close a record or not; pieces between two
   such ends are one record.  Only records that cross a border of blocks are joined once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkledger.session import staged
from sparkledger.sources.landing import FETCHED, fetch_time, parse_records

#: Blocks that one record may cross; the parts of a longer one (a file that breaks off early) are not joined.
RECORD_BLOCKS = 4
_BLOCK = ["_file", "_start"]


def _opens(piece: Column, inside: bool) -> Column:
    """Opening braces of a piece outside strings."""
    if inside:
        piece = F.regexp_replace(piece, r'^[^"]*(?:"|\z)', "")
    bare = F.regexp_replace(piece, r'"[^"]*(?:"|\z)', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit("{"), F.lit("")))


def array_texts(spark: SparkSession, path: str) -> DataFrame:
    """(text, fetch time) of every record of the arrays below ``path``, for ``parse_records(..., json_lines=True)``.

    Of a file that breaks off, the records before are whole and the rest is one text; what else stands between
    records comes with the record after it, so that ``BROKEN`` has it.  The brackets may be missing: a file may hold
    a part of an array.  An empty array, an empty file and an empty folder have no records.
    Compressed files are read by one task each and should end with their bracket.
    """
    meta = F.col("_metadata")
    raw = spark.read.text(path, lineSep="}", recursiveFileLookup=True).select(
        meta["file_path"].alias("_file"), meta["file_block_start"].alias("_start"), meta["file_size"].alias("_size"),
        fetch_time().alias(FETCHED), F.monotonically_increasing_id().alias("_seq"), F.col("value").alias("_piece"))
    plain = F.regexp_replace("_piece", r"(?s)\\.", "")
    raw = raw.withColumns({
        "_quotes": F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit(""))),
        "_open0": _opens(plain, False), "_open1": _opens(plain, True)})
    block = Window.partitionBy(*_BLOCK).orderBy("_seq")
    # Quotes up to and with the piece, from the start of its block.
    local = raw.withColumn("_after", F.sum("_quotes").over(block) % 2).withColumn("_before", (F.col("_after") + F.col("_quotes")) % 2)
    # What a piece adds to the depth where its block starts outside (0) or inside (1) a string; a brace in a string closes nothing.
    add = {f"_add{s}": F.when((F.col("_before") + s) % 2 == 0, F.col("_open0")).otherwise(F.col("_open1"))
           - F.when((F.col("_after") + s) % 2 == 0, 1).otherwise(0) for s in (0, 1)}
    local = local.withColumns(add).drop("_open0", "_open1")
    local = staged(local.withColumns({f"_depth{s}": F.sum(f"_add{s}").over(block) for s in (0, 1)}))

    totals = local.groupBy(*_BLOCK).agg(
        F.sum("_quotes").alias("_q"), F.sum("_add0").alias("_d0"), F.sum("_add1").alias("_d1"), F.max("_seq").alias("_last"),
        F.sum(F.octet_length("_piece")).alias("_bytes"), F.count(F.lit(1)).alias("_n"), F.first("_size").alias("_size"))
    order = Window.partitionBy("_file").orderBy("_start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file")
    starts = totals.withColumn("_in", F.coalesce(F.sum("_q").over(before), F.lit(0)) % 2)
    starts = starts.withColumn("_d", F.when(F.col("_in") == 0, F.col("_d0")).otherwise(F.col("_d1")))
    starts = starts.select(
        *_BLOCK, "_in", F.coalesce(F.sum("_d").over(before), F.lit(0)).alias("_base"),
        # Without a separator at its end a file has one fewer than pieces; the last piece then closes nothing.
        ((F.max("_start").over(whole) == F.col("_start")) & (F.sum("_bytes").over(whole) + F.sum("_n").over(whole) > F.max("_size").over(whole))).alias("_open_end"), "_last")

    known = local.join(starts, _BLOCK)
    outside = (F.col("_after") + F.col("_in")) % 2 == 0
    depth = F.when(F.col("_in") == 0, F.col("_depth0")).otherwise(F.col("_depth1")) + F.col("_base")
    cut = F.col("_open_end") & (F.col("_seq") == F.col("_last"))
    known = known.select(*_BLOCK, FETCHED, "_seq", "_base", "_in", (outside & (depth <= 0) & ~cut).cast("int").alias("_end"),
                         F.when(cut, F.col("_piece")).otherwise(F.concat("_piece", F.lit("}"))).alias("_piece"))
    known = known.withColumn("_local", F.sum("_end").over(block) - F.col("_end"))
    parts = known.groupBy(*_BLOCK, "_local").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_seq", "_piece"))), lambda x: x["_piece"]), "").alias("_text"),
        F.max("_end").alias("_end"), F.first("_base").alias("_base"), F.first("_in").alias("_in"), F.first(FETCHED).alias(FETCHED))
    begun = (F.col("_local") > 0) | ((F.col("_base") <= 0) & (F.col("_in") == 0))
    parts = staged(parts.withColumn("_whole", begun & (F.col("_end") == 1)))

    # Ends before a block number the records that cross borders.
    ends = parts.groupBy(*_BLOCK).agg(F.sum("_end").alias("_ends")).select(*_BLOCK, F.coalesce(F.sum("_ends").over(before), F.lit(0)).alias("_ahead"))
    loose = parts.where("not _whole").join(ends, _BLOCK).withColumn("_record", F.col("_ahead") + F.col("_local"))
    spans = loose.groupBy("_file", "_record").agg(F.count(F.lit(1)).alias("_blocks"))
    loose = loose.join(spans, ["_file", "_record"])
    joined = loose.where(F.col("_blocks") <= RECORD_BLOCKS).groupBy("_file", "_record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_start", "_text"))), lambda x: x["_text"]), "").alias("_text"), F.first(FETCHED).alias(FETCHED))
    texts = parts.where("_whole").select("_text", FETCHED).unionByName(joined.select("_text", FETCHED)).unionByName(
        loose.where(F.col("_blocks") > RECORD_BLOCKS).select("_text", FETCHED))
    # One comma or bracket before a record, a bracket after the last.
    bare = F.regexp_replace("_text", r"^\s*[\[,]?\s*", "")
    return texts.select(bare.alias("_text"), FETCHED).where(~F.col("_text").rlike(r"^\s*\]?\s*$"))


def read_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``read_landed`` for large arrays: every record, unreadable ones included (``BROKEN``)."""
    return parse_records(array_texts(spark, path), schema, json_lines=True)
