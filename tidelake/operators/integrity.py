"""Checks of envelopes, payload hashes, offsets and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.payload import sort_key
from tidelake.operators import ordered

# Fields that an envelope must have.
COMMON_FIELDS = ("v", "type", "exchange", "symbol", "stream", "received_at", "collector_session_id", "session_seq", "_topic", "_partition", "_offset")
DATA_FIELDS = COMMON_FIELDS + ("exchange_ts", "raw_text", "raw_sha256")
GAP_FIELDS = COMMON_FIELDS + ("gap_start_ts", "gap_end_ts", "reason", "detail")


def _required() -> Column:
    is_gap = F.col("type").eqNullSafe("gap")
    return F.when(is_gap, F.array(*map(F.lit, sorted(GAP_FIELDS)))).otherwise(F.array(*map(F.lit, sorted(DATA_FIELDS))))


def missing_fields_json(line: Column | str) -> Column:
    """Sorted names of the required fields that a JSON line lacks; a field that is there with null isn't missing.
    Null for a line that is no JSON object."""
    c = F.col(line) if isinstance(line, str) else line
    keys = F.json_object_keys(c)
    is_gap = F.get_json_object(c, "$.type").eqNullSafe("gap")
    need = F.when(is_gap, F.array(*map(F.lit, sorted(GAP_FIELDS)))).otherwise(F.array(*map(F.lit, sorted(DATA_FIELDS))))
    return F.when(keys.isNotNull(), F.sort_array(F.array_except(need, keys)))


def missing_columns() -> Column:
    """The same for archived rows, where a null column is a field that wasn't there."""
    have = F.array_compact(F.array(*(F.when(F.col(c).isNotNull(), F.lit(c)) for c in sorted({*DATA_FIELDS, *GAP_FIELDS}))))
    return F.sort_array(F.array_except(_required(), have))


def listed(names: Column) -> Column:
    """['a', 'b'] as text."""
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def hash_mismatches(df: DataFrame) -> DataFrame:
    """Data rows with a payload whose SHA-256 isn't the stored one (a missing one is no mismatch)."""
    d = df.where((F.col("type") == "data") & F.col("raw_text").isNotNull() & F.col("raw_sha256").isNotNull())
    return d.withColumn("actual_sha256", F.sha2(F.col("raw_text").cast("binary"), 256)).where("actual_sha256 <> raw_sha256")


def duplicate_offsets(df: DataFrame, per_file: bool = False) -> DataFrame:
    """Second and further rows of the same broker coordinates (null parts equal each other), offsets below 0 skipped.

    Counting by aggregation, then a join with the few coordinates that repeat: no window over all rows.
    """
    keys = ["_topic", "_partition", "_offset"] + ["file_path"] * per_file
    d = df.where("_offset >= 0")
    h = F.xxhash64(*keys)
    many = d.groupBy(h.alias("h")).agg(F.count("*").alias("n")).where("n > 1").select("h")
    d = d.withColumn("h", h).join(many, "h", "left_semi")
    first = d.groupBy(*keys).agg(F.min("row_id").alias("first_row"), F.count("*").alias("copies")).where("copies > 1")
    cond = F.lit(True)
    f = first.select(*(F.col(k).alias(f"f{k}") for k in keys), "first_row", "copies")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"f{k}"))
    return d.join(f, cond).where("row_id <> first_row").select("row_id", "first_row", *keys)


def ordering_violations(df: DataFrame, keys: list[str], block: str, order: list[str]) -> DataFrame:
    """Data rows whose sort key lies below that of the data row before; gap rows are exempt."""
    d = df.where("type = 'data'").withColumn("key", sort_key("stream", "raw_text", "exchange_ts"))
    d = d.select(*dict.fromkeys([*keys, block, *order, "key"]))
    d = ordered.previous(d, keys, block, order, {"key": "last_key"})
    return d.where("key < last_key")
