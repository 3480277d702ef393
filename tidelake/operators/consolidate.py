"""Merging an hour's files, consolidating a day, and the manifests of both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES
from tidelake.functions.payload import sort_key

KEYS = list(NAMES)
HOUR = [*KEYS, "utc_date", "hour_no"]


def merge_hours(rows: DataFrame, order: list[str], passthrough: DataFrame | None = None) -> DataFrame:
    """rows with pos, the place of each row in the merged hour (1, 2, ...).

    Data rows go by their sort key (trades a, depth u, else exchange_ts), equal keys by `order`. A gap goes
    before the first data row, in that order, that was received at or after its start; gaps without such a row
    or without a start go last; gaps of one place by start (none as 0), then `order`. An hour in passthrough
    (HOUR columns) has a single base file and keeps its own order.

    The splice needs the least rank among data rows received at or after the start: ranks' suffix minimum in
    order of received_at, looked up as of the gap's start.
    """
    d = rows.withColumn("_is_gap", F.col("type").eqNullSafe("gap"))
    d = d.withColumn("_key", F.when(~F.col("_is_gap"), sort_key("stream", "raw_text", "exchange_ts")))
    hour = W.partitionBy(*HOUR)
    d = d.withColumn("_rank", F.when(~F.col("_is_gap"), F.row_number().over(W.partitionBy(*HOUR, "_is_gap").orderBy("_key", *order))))
    at = F.when(F.col("_is_gap"), F.col("gap_start_ts")).otherwise(F.col("received_at"))
    d = d.withColumn("_at", at)
    # Later in time first; data before a gap of the same instant, so that the gap sees it.
    back = hour.orderBy(F.col("_at").desc_nulls_last(), F.col("_is_gap")).rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("_next_rank", F.min("_rank").over(back))
    place = F.when(~F.col("_is_gap"), F.col("_rank")).when(F.col("_at").isNotNull(), F.col("_next_rank"))
    d = d.withColumn("_place", F.coalesce(place, F.lit(2**31 - 1)))
    final = hour.orderBy("_place", F.when(F.col("_is_gap"), 0).otherwise(1), F.coalesce("gap_start_ts", F.lit(0)), *order)
    d = d.withColumn("pos", F.row_number().over(final))
    if passthrough is not None:
        flags = passthrough.select(*HOUR, F.lit(True).alias("_as_is"))
        d = d.join(flags, HOUR, "left").withColumn("pos", F.when(F.col("_as_is"), F.row_number().over(hour.orderBy(*order))).otherwise(F.col("pos"))).drop("_as_is")
    return d.drop("_is_gap", "_key", "_rank", "_at", "_next_rank", "_place")


def hour_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    """total, data and gap rows; what isn't a gap counts as data."""
    gap = F.col("type").eqNullSafe("gap")
    return rows.groupBy(*by).agg(F.count("*").alias("total_records"), F.count_if(~gap).alias("data_records"), F.count_if(gap).alias("gap_records"))


def date_manifest(rows: DataFrame) -> DataFrame:
    """Per date, exchange, symbol and stream: sorted hours, record_count, and the gaps (start, end, reason)."""
    gap = F.when(F.col("type") == "gap", F.struct("gap_start_ts", "gap_end_ts", "reason", "detail"))
    return rows.groupBy("utc_date", *KEYS).agg(F.sort_array(F.collect_set("hour_no")).alias("hours"), F.count("*").alias("record_count"), F.sort_array(F.collect_list(gap)).alias("gaps"))


def day_manifest(hours: DataFrame, missing: DataFrame) -> DataFrame:
    """Per stream-day: counts, map of hours to (status, data, gap records, sources), missing hours, source files.

    hours: HOUR columns, status, data_records, gap_records, sources (array). missing: stream-day and hour_no;
    a missing hour counts as one gap record.
    """
    day = [*KEYS, "utc_date"]
    entry = F.struct("status", "data_records", "gap_records", "sources")
    m = missing.select(*HOUR, F.lit("missing").alias("status"), F.lit(0).cast("long").alias("data_records"), F.lit(1).cast("long").alias("gap_records"), F.array().cast("array<string>").alias("sources"))
    every = hours.select(*HOUR, "status", "data_records", "gap_records", "sources").where("data_records + gap_records > 0 OR status = 'missing'").unionByName(m)
    key = F.col("hour_no").cast("string")
    return every.groupBy(*day).agg(
        F.sum(F.col("data_records") + F.col("gap_records")).alias("total_records"),
        F.sum("data_records").alias("data_records"),
        F.sum("gap_records").alias("gap_records"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(key.alias("key"), entry.alias("value"))))).alias("hours"),
        F.sort_array(F.collect_list(F.when(F.col("status") == "missing", F.col("hour_no")))).alias("missing_hours"),
        F.sort_array(F.flatten(F.collect_list("sources"))).alias("source_files"),
    )


def latest_runs(results: DataFrame) -> DataFrame:
    """The latest run of each stream-day (a null time is the earliest)."""
    day = [*KEYS, "utc_date"]
    rest = [c for c in results.columns if c not in day]
    row = F.max_by(F.struct(*rest), F.struct("consolidated_at", F.coalesce("success", F.lit(False)))).alias("r")
    ranked = results.where("consolidated_at IS NOT NULL").groupBy(*day).agg(row)
    return ranked.select(*day, "r.*")


def cycle_totals(runs: DataFrame) -> DataFrame:
    """Streams, records, missing hours and failures of a consolidation cycle, by date."""
    return runs.groupBy("utc_date").agg(F.count("*").alias("streams"), F.sum(F.coalesce("total_records", F.lit(0))).alias("records"), F.sum(F.when(F.col("missing_hours").isNull(), 0).otherwise(F.size("missing_hours"))).cast("long").alias("missing_hours"), F.bool_or(~F.coalesce("success", F.lit(False))).alias("any_failed"))
