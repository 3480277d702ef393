"""Health of producers, consumers and connections as runs and gaps over rows of probes and arrivals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES
from tidelake.functions.timeutil import floor_div
from tidelake.operators import ordered
from tidelake.operators.coverage import HOUR_NS, S, condition_windows

KEYS = list(NAMES)


def consumer_outages(arrivals: DataFrame, time_ns: str, limit_ns: int = 30 * S) -> DataFrame:
    """Stretches of more than limit without any arrival at all: gap_start_ts, gap_end_ts. Of the whole lake's arrivals only
    the first and the last of each stretch of that length are put in order."""
    d = ordered.silent_before(arrivals.select(F.lit(1).alias("all"), F.col(time_ns).alias("t")), ["all"], "t", limit_ns).where("last IS NOT NULL")
    return d.select(F.col("last").alias("gap_start_ts"), F.col("next").alias("gap_end_ts"), F.lit("kafka_consumer_outage").alias("reason"))


# How a full disk and an unreachable state store show themselves.
DISK_FULL = "No space left on device"
CONNECTION_STATES = ("08", "57P")


def hold_reason(message: Column, sql_state: Column) -> Column:
    """disk_full_hold or pg_outage_hold if an error calls for one, else null."""
    return F.when(message.contains(DISK_FULL), "disk_full_hold").when(F.left(sql_state, F.lit(2)).isin(*CONNECTION_STATES) | F.left(sql_state, F.lit(3)).isin(*CONNECTION_STATES), "pg_outage_hold")


def producer_states(probes: DataFrame, keys: list[str], time_ns: str, failed: str, pause_after_ns: int = 30 * S) -> DataFrame:
    """State after each probe: HEALTHY, DEGRADED from the first failure on, PAUSED once failures have gone on for
    pause_after_ns; a success is HEALTHY again."""
    d = probes.withColumns({"block": floor_div(time_ns, HOUR_NS), "bad": F.coalesce(F.col(failed), F.lit(False))})
    d = d.withColumn("good_at", F.when(~F.col("bad"), F.col(time_ns)))
    d = ordered.previous(d, keys, "block", [time_ns], {"bad": "was_bad"})
    d = d.withColumn("since", F.when(F.col("bad") & ~F.coalesce("was_bad", F.lit(False)), F.col(time_ns)))
    d = ordered.last_known(d, keys, "block", [time_ns], "since", "failing_since")
    state = F.when(~F.col("bad"), "HEALTHY").when(F.col(time_ns) - F.col("failing_since") >= pause_after_ns, "PAUSED").otherwise("DEGRADED")
    return d.select(*keys, time_ns, state.alias("state"), F.when(F.col("bad"), F.col("failing_since")).alias("failing_since"))


def producer_outages(probes: DataFrame, keys: list[str], time_ns: str, failed: str) -> DataFrame:
    """A kafka_producer_outage gap for each run of failures, from its first failure to the success that ends it
    (null: still going on)."""
    d = probes.withColumns({"block": floor_div(time_ns, HOUR_NS), "bad": F.coalesce(F.col(failed), F.lit(False))})
    d = ordered.previous(d, keys, "block", [time_ns], {"bad": "was_bad"})
    d = d.withColumn("turn", (F.col("bad") != F.coalesce("was_bad", F.lit(False)))).where("turn").withColumn("edge", floor_div(time_ns, 24 * HOUR_NS))
    # Looking back from later to earlier, the row before a turn to bad is the turn to good that ends it.
    d = d.withColumns({"rt": -F.col(time_ns), "back": -F.col("edge")})
    d = ordered.previous(d, keys, "back", ["rt"], {time_ns: "ended"})
    return d.where("bad").select(*keys, F.col(time_ns).alias("gap_start_ts"), F.col("ended").alias("gap_end_ts"), F.lit("kafka_producer_outage").alias("reason"))


def holds(probes: DataFrame, keys: list[str], time_ns: str, failed: str, failures: int, reason: str) -> DataFrame:
    """Holds (disk full, state store out): runs of at least so many failures in a row, start and end markers."""
    runs = condition_windows(probes, keys, time_ns, failed, HOUR_NS)
    return runs.where(F.col("n") >= failures).select(*keys, F.col("start").alias("gap_start_ts"), F.col("end").alias("gap_end_ts"), F.lit(reason).alias("reason"), F.col("n").alias("failures"))


def disconnect_gaps(rows: DataFrame, time: str, is_disconnect: str) -> DataFrame:
    """One gap for each stream and run of disconnects until its next data row: from the last data row before (null:
    none) to the last disconnect of the run."""
    d = rows.withColumns({"off": F.coalesce(F.col(is_disconnect), F.lit(False)), "block": floor_div(time, HOUR_NS)})
    d = d.withColumns({"off_i": F.col("off").cast("int"), "data_at": F.when(~F.col("off"), F.col(time))})
    d = ordered.last_known(d, KEYS, "block", [time, "off_i"], "data_at", "last_data")
    out = d.where("off").groupBy(*KEYS, "last_data").agg(F.max(time).alias("gap_end_ts"), F.count("*").alias("n"))
    return out.select(*KEYS, F.col("last_data").alias("gap_start_ts"), "gap_end_ts", F.lit("ws_disconnect").alias("reason"), "n")


def offset_resets(rows: DataFrame) -> DataFrame:
    """Where a partition's offsets, in their own order, skip: from and to are the offsets that were never stored."""
    d = rows.where("_offset >= 0 AND _topic IS NOT NULL AND _partition IS NOT NULL").select("_topic", "_partition", "_offset").distinct().withColumn("block", floor_div("_offset", 65_536))
    d = ordered.previous(d, ["_topic", "_partition"], "block", ["_offset"], {"_offset": "last"})
    return d.where("_offset > last + 1").select("_topic", "_partition", (F.col("last") + 1).alias("from_offset"), (F.col("_offset") - 1).alias("to_offset"))


def first_frame_overdue(connections: DataFrame, first_frames: DataFrame, key: str, limit_ns: int = 30 * S) -> DataFrame:
    """Connections (key, connected_at) without a frame, or whose first frame came more than limit after them."""
    f = first_frames.groupBy(key).agg(F.min("received_at").alias("first_frame"))
    return connections.join(f, key, "left").where(F.col("first_frame").isNull() | (F.col("first_frame") - F.col("connected_at") > limit_ns))


def stagger(interval_s: float, index: int, count: int) -> float:
    """Seconds to wait before the first poll of the index-th of count pollers."""
    return interval_s * index / max(count, 1)


def backoff(attempt: int, first_s: float = 1.0, most_s: float = 60.0) -> float:
    """Seconds before reconnect number attempt (0, 1, ...): doubling up to a limit."""
    return min(most_s, first_s * 2**attempt)
