"""Consolidation of many small archive files into few, by joining their bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STREAM_DAY = ["exchange", "symbol", "stream", "utc_date"]
SMALL = 8192


def latest_listing(files: DataFrame) -> DataFrame:
    """Of each path, as stored, the row with the greatest listed_at (ties: the greater size, then n_records)."""
    row = F.max(F.struct("listed_at", "size_bytes", "n_records", "modified_at")).alias("r")
    return files.where(F.col("file_path").isNotNull()).groupBy("file_path").agg(row).select("file_path", "r.size_bytes", "r.n_records", "r.modified_at", "r.listed_at")


def plan(files: DataFrame, small: int = SMALL, target_bytes: int = 128 << 20) -> DataFrame:
    """Which small files join into which target file, in which order and at which byte.

    Input: one row for each file with path_columns and size_bytes. A file takes part if it is a base, late or
    backfill file with 0 < size_bytes < small, its stream-day has at least two such files and no daily file of
    more than 0 bytes. Order in a target: hour, then base, late and backfill by number, then path. A stream-day
    of more than target_bytes gets several targets. Offsets are prefix sums in two levels, inside
    each hour and over the totals of a day's hours (24), so that a busy stream-day spreads over its hours.

    Defined cases: null sizes count as 0; a missing number sorts first; files must be listed once each (see
    latest_listing); other columns are ignored whatever their names; no files give no rows.
    """
    kind, size = F.col("kind"), F.coalesce(F.col("size_bytes"), F.lit(0))
    is_small = kind.isin("base", "late", "backfill") & (size > 0) & (size < small)
    files = files.select("file_path", *STREAM_DAY, "kind", "hour_no", "seq", "size_bytes")
    day = files.where(is_small | ((kind == "daily") & (size > 0)))
    totals = day.groupBy(*STREAM_DAY).agg(F.count_if(is_small).alias("n"), F.count_if(kind == "daily").alias("daily")).where("n >= 2 AND daily = 0")
    rank = F.when(kind == "base", 0).when(kind == "late", 1).otherwise(2)
    mine = day.where(is_small).join(totals.select(*STREAM_DAY), STREAM_DAY, "left_semi").withColumn("rank", rank)
    hour = [*STREAM_DAY, "hour_no"]
    inner = W.partitionBy(*hour).orderBy("rank", "seq", "file_path")
    mine = mine.withColumn("no", F.row_number().over(inner).cast("long")).withColumn("upto", F.sum("size_bytes").over(inner.rowsBetween(W.unboundedPreceding, 0)))
    sums = mine.groupBy(*hour).agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"))
    before = W.partitionBy(*STREAM_DAY).orderBy("hour_no").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*hour, F.coalesce(F.sum("files").over(before), F.lit(0)).alias("files0"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"))
    out = mine.join(sums, hour).withColumn("start", F.col("bytes0") + F.col("upto") - F.col("size_bytes"))
    part = F.call_function("div", F.col("start"), F.lit(target_bytes).cast("long"))
    folder = F.concat_ws("/", F.lit("archive"), *STREAM_DAY)
    out = out.withColumn("part", part).withColumn("target_path", F.concat(folder, F.lit("/part-"), F.lpad(F.col("part").cast("string"), 5, "0"), F.lit(".jsonl.zst")))
    first = F.min("start").over(W.partitionBy(*STREAM_DAY, "part"))
    return out.select("file_path", "target_path", *STREAM_DAY, "part", "hour_no", (F.col("files0") + F.col("no")).alias("source_no"), "size_bytes", (F.col("start") - first).alias("target_offset"))
