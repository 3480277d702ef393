"""Continuity of sequence ids, order-book chains, sessions and heartbeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES
from tidelake.functions.payload import json_long
from tidelake.functions.timeutil import floor_div
from tidelake.operators import ordered
from tidelake.operators.intervals import covered_and_gaps
from tidelake.operators.overlap import overlapping

HOUR_NS = 3_600_000_000_000
KEYS = list(NAMES)


def _in_file_order(df: DataFrame, stream: str, ids: list[str], keep: list[str]) -> DataFrame:
    """Data rows of a stream with their payload ids as columns and what is to be kept, unparsable and negative ids
    left out."""
    d = df.where((F.col("type") == "data") & (F.col("stream") == stream)).select(*dict.fromkeys([*keep, "raw_text"]))
    for i in ids:
        d = d.withColumn(f"k_{i}", json_long("raw_text", f"$.{i}"))
    cond = F.lit(True)
    for i in ids:
        cond = cond & (F.col(f"k_{i}") >= 0)
    d = d.where(cond)
    return d if "raw_text" in keep else d.drop("raw_text")


def trade_breaks(df: DataFrame, scope: list[str], block: str, order: list[str], keep: list[str]) -> DataFrame:
    """With scope, block, order and keep columns: rows whose trade id isn't the one before plus 1, in file order. missing may be negative (repeats)."""
    d = ordered.previous(_in_file_order(df, "trades", ["a"], [*scope, block, *order, *keep]), scope, block, order, {"k_a": "last"})
    return d.where("k_a <> last + 1").withColumns({"field": F.lit("a"), "expected": F.col("last") + 1, "actual": F.col("k_a"), "missing": F.col("k_a") - F.col("last") - 1})


def depth_breaks(df: DataFrame, scope: list[str], block: str, order: list[str], keep: list[str]) -> DataFrame:
    """Rows whose pu isn't the u of the depth row before."""
    d = ordered.previous(_in_file_order(df, "depth", ["u", "pu"], [*scope, block, *order, *keep]), scope, block, order, {"k_u": "last"})
    return d.where("k_pu <> last").withColumns({"field": F.lit("pu"), "expected": F.col("last"), "actual": F.col("k_pu"), "missing": F.lit(0).cast("long")})


def bookticker_breaks(df: DataFrame, scope: list[str], block: str, order: list[str], keep: list[str]) -> DataFrame:
    """Rows whose u lies below the greatest u before."""
    d = ordered.running_max(_in_file_order(df, "bookticker", ["u"], [*scope, block, *order, *keep]), scope, block, order, "k_u", "last")
    return d.where("k_u < last").withColumns({"field": F.lit("u"), "expected": F.col("last"), "actual": F.col("k_u"), "missing": F.lit(0).cast("long")})


def all_breaks(df: DataFrame, scope: list[str], block: str, order: list[str], keep: list[str]) -> DataFrame:
    """The three checks as one table."""
    cols = [*keep, "field", "expected", "actual", "missing"]
    parts = [f(df, scope, block, order, keep).select(*cols) for f in (trade_breaks, depth_breaks, bookticker_breaks)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sequence_gap_records(breaks: DataFrame) -> DataFrame:
    """Breaks as gap records of one instant (session_seq_skip); the text tells missing ids from other breaks."""
    ms = floor_div("received_at", 1_000_000)
    # The texts of sequence records.
    some = F.format_string("%s: expected %d, got %d (missing %d)", "field", "expected", "actual", "missing")
    text = F.when(F.col("missing") > 0, some).otherwise(F.format_string("%s: expected %d, got %d (chain break)", "field", "expected", "actual"))
    return breaks.select(F.lit("file.sequence_id").alias("source"), *KEYS, ms.alias("start_ms"), ms.alias("end_ms"), F.lit("session_seq_skip").alias("reason"), text.alias("detail"), "row_id")


def cross_source_breaks(df: DataFrame) -> DataFrame:
    """pu chain over the depth rows of all sources merged by (received_at, row_id), per exchange and symbol.

    Gives the time of the row before and of the break."""
    d = _in_file_order(df, "depth", ["u", "pu"], ["exchange", "symbol", "row_id", "received_at"]).withColumn("block", floor_div("received_at", HOUR_NS))
    d = ordered.previous(d, ["exchange", "symbol"], "block", ["received_at", "row_id"], {"k_u": "last_u", "received_at": "last_received"})
    return d.where("k_pu <> last_u").select("exchange", "symbol", "row_id", "last_received", "received_at", F.col("last_u").alias("expected"), F.col("k_pu").alias("actual"))


def session_seq_gaps(df: DataFrame) -> DataFrame:
    """Skips of the collector's own counter in a session and stream, in the counter's order."""
    d = df.where("type = 'data' AND session_seq >= 0 AND collector_session_id IS NOT NULL").select(*KEYS, "collector_session_id", "session_seq").distinct()
    d = d.withColumn("block", floor_div("session_seq", 65536))
    d = ordered.previous(d, [*KEYS, "collector_session_id"], "block", ["session_seq"], {"session_seq": "last"})
    return d.where("session_seq > last + 1").select(*KEYS, "collector_session_id", (F.col("last") + 1).alias("from_seq"), (F.col("session_seq") - 1).alias("to_seq"), (F.col("session_seq") - F.col("last") - 1).alias("missing"))


def source_of(topic: str = "_topic"):
    """primary, backup, or null for rows that no broker delivered."""
    t = F.col(topic)
    return F.when(t.startswith("backup."), "backup").when(t.isNotNull() & (t != "backfill"), "primary")


def session_changes(df: DataFrame) -> DataFrame:
    """Gap [previous, this] where a source's session changes within a stream, in storing order; a switch between
    sources is none."""
    d = df.where("type = 'data' AND collector_session_id IS NOT NULL").withColumn("source", source_of()).where("source IS NOT NULL")
    d = d.select(*KEYS, "source", "row_id", "collector_session_id", "received_at")
    d = d.withColumn("block", floor_div("row_id", 100_000))
    d = ordered.previous(d, [*KEYS, "source"], "block", ["row_id"], {"collector_session_id": "last_session", "received_at": "last_received"})
    text = F.concat(F.lit("collector_session_id changed from "), "last_session", F.lit(" to "), "collector_session_id")
    return d.where("collector_session_id <> last_session").select(*KEYS, "source", "row_id", F.col("last_received").alias("gap_start_ts"), F.col("received_at").alias("gap_end_ts"), F.lit("collector_restart").alias("reason"), text.alias("detail"))


def silences(df: DataFrame, threshold_ns: int) -> DataFrame:
    """Stretches of more than threshold between successive rows (of any kind of sign of life) of a stream."""
    d = ordered.silent_before(df, KEYS, "received_at", threshold_ns).where("last IS NOT NULL")
    return d.select(*KEYS, F.col("last").alias("silent_from"), F.col("next").alias("silent_to"))


def uncovered_silences(signs: DataFrame, gaps: DataFrame, threshold_ns: int = 30_000_000_000, keyed: bool = True) -> DataFrame:
    """Silences that no gap envelope touches. keyed: only gaps of the same stream cover; else any gap does."""
    s = silences(signs, threshold_ns)
    g = gaps.where("gap_start_ts <= gap_end_ts").select(*KEYS, "gap_start_ts", "gap_end_ts").distinct()
    if keyed:
        covered = overlapping(s, g, KEYS, ("silent_from", "silent_to"), ("gap_start_ts", "gap_end_ts"), 6 * HOUR_NS)
        out = s.join(covered.select(*KEYS, "silent_from").distinct(), [*KEYS, "silent_from"], "left_anti")
    else:
        out = _outside(s, covered_and_gaps(g.withColumn("all", F.lit(1)), ["all"], "gap_start_ts", "gap_end_ts", block=HOUR_NS).where("kind = 'period'"))
    return out.withColumn("duration_ms", F.expr("(silent_to - silent_from) div 1000000"))


def _outside(silent: DataFrame, periods: DataFrame) -> DataFrame:
    """Silences that touch none of the periods, which lie apart: the last one that starts before a silence's end also
    ends last, so one as-of pass decides, without pairs."""
    none = F.lit(None).cast("long")
    p = periods.select(*(F.lit(None).cast("string").alias(c) for c in KEYS), none.alias("silent_from"), none.alias("silent_to"), F.col("gap_start_ts").alias("t"), F.col("gap_end_ts").alias("upto"))
    u = silent.withColumns({"t": F.col("silent_to"), "upto": none}).unionByName(p)
    u = u.withColumns({"all": F.lit(1), "block": floor_div("t", HOUR_NS), "is_silence": F.col("silent_to").isNotNull().cast("int")})
    u = ordered.last_known(u, ["all"], "block", ["t", "is_silence"], "upto", "covered_to")
    return u.where("silent_to IS NOT NULL AND (covered_to IS NULL OR covered_to < silent_from)").select(*KEYS, "silent_from", "silent_to")
