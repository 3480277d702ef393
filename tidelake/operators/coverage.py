"""Two collectors: which gaps the other one covered, who was in charge when, and when both were silent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES
from tidelake.functions.timeutil import floor_div
from tidelake.operators import ordered

KEYS = list(NAMES)
S = 1_000_000_000
HOUR_NS = 3600 * S


def suppress_covered(gaps: DataFrame, data: DataFrame, grace_ns: int = 10 * S, parked: str | None = None) -> DataFrame:
    """gaps with covered: whether the gap was parked and the other source then turned out to bridge it; and with parked,
    which a column of gaps (the parameter) may have settled before.

    A gap is parked if it is a restart_gap, or if at its arrival the other source has delivered on the stream after
    the gap's start or within the grace; it is covered if that source has data after the start until the grace
    after its arrival has run out. Others are archived at once.

    gaps: gap_no, names, source, reason, gap_start_ts, received_at. data: names, source, received_at. The other
    source's next row after the start and last row before the arrival decide; both come from as-of passes over
    both tables, hour by hour.
    """
    other = F.when(F.col("source") == "primary", "backup").otherwise("primary")
    g = gaps.where("gap_start_ts IS NOT NULL").select("gap_no", *KEYS, other.alias("source"), F.col("gap_start_ts").alias("t"), F.lit(None).cast("long").alias("hit"))
    d = data.where("received_at IS NOT NULL").select(F.lit(None).cast("long").alias("gap_no"), *KEYS, "source", F.col("received_at").alias("t"), F.col("received_at").alias("hit")).distinct()
    # In reverse, so that the last known is the next; data at the gap's own instant isn't after it.
    u = g.unionByName(d).withColumn("rt", -F.col("t")).withColumn("block", floor_div("rt", HOUR_NS)).withColumn("is_data", F.col("hit").isNotNull().cast("int"))
    u = ordered.last_known(u, [*KEYS, "source"], "block", ["rt", "is_data", "gap_no"], "hit", "next_other")
    found = u.where("gap_no IS NOT NULL").select("gap_no", "next_other")
    a = gaps.where("received_at IS NOT NULL").select("gap_no", *KEYS, other.alias("source"), F.col("received_at").alias("t"), F.lit(None).cast("long").alias("hit"))
    a = a.unionByName(d).withColumns({"block": floor_div("t", HOUR_NS), "is_gap": F.col("hit").isNull().cast("int")})
    a = ordered.last_known(a, [*KEYS, "source"], "block", ["t", "is_gap", "gap_no"], "hit", "last_other")
    seen = a.where("gap_no IS NOT NULL").select("gap_no", "last_other")
    out = gaps.join(found, "gap_no", "left").join(seen, "gap_no", "left")
    start, at = F.col("gap_start_ts"), F.col("received_at")
    waits = (F.col("reason") == "restart_gap") | (F.col("last_other") > start) | (F.col("last_other") > at - grace_ns)
    if parked:
        waits = waits | F.col(parked)
    out = out.withColumn("parked", F.coalesce(waits, F.lit(False)))
    return out.withColumn("covered", F.coalesce(F.col("parked") & (F.col("next_other") <= at + grace_ns), F.lit(False)))


def failover_intervals(arrivals: DataFrame, silence_ns: int = 5 * S, recovery_ns: int = 10 * S) -> DataFrame:
    """Times at which the backup is in charge, per stream: from silence_ns after the primary's last row until the
    primary has delivered for recovery_ns without another silence; a new silence starts the wait anew.

    arrivals: names, received_at of primary rows. Output: active_from, active_to (null: still going on is not
    known from past rows, so every interval here ended or stays open after the last row).
    """
    a = arrivals.where("received_at IS NOT NULL").select(*KEYS, "received_at")
    runs = ordered.silent_before(a, KEYS, "received_at", silence_ns).withColumn("rt", -F.col("next")).withColumn("block", floor_div("rt", 24 * HOUR_NS))
    # From later to earlier: the row before a run's is the next run, whose `last` ends this one.
    runs = ordered.previous(runs, KEYS, "block", ["rt"], {"last": "until"})
    ends = a.groupBy(*KEYS).agg(F.max("received_at").alias("end"))
    runs = runs.select(*KEYS, "last", F.col("next").alias("first"), "until", "rt", "block").join(ends, KEYS).withColumn("until", F.coalesce("until", "end"))
    # A run of rows without silence ends the failover if it lasts recovery_ns; the next one begins after it.
    long = runs.where((F.col("until") - F.col("first") >= recovery_ns) | F.col("last").isNull()).select(*KEYS, "first", "until", "rt", "block")
    long = ordered.previous(long, KEYS, "block", ["rt"], {"first": "next_first"})
    return long.select(*KEYS, (F.col("until") + silence_ns).alias("active_from"), (F.col("next_first") + recovery_ns).alias("active_to"))


def route(df: DataFrame, failovers: DataFrame) -> DataFrame:
    """Data rows that are archived: the primary's always, the backup's only while it is in charge, however long that is;
    heartbeats never. Failovers of a stream lie apart, so the last one that began by a backup row decides on it: one
    as-of pass, hour by hour, without expanding intervals."""
    d = df.where("type = 'data'").withColumn("_t", F.col("received_at"))
    f = failovers.withColumn("_stop", F.coalesce("active_to", F.lit(2**63 - 1))).where("active_from < _stop").groupBy(*KEYS, "active_from").agg(F.max("_stop").alias("_stop"))
    f = f.select(*KEYS, F.col("active_from").alias("_t"), "_stop", F.lit(0).alias("_row"))
    backup = d.where("source = 'backup' AND received_at IS NOT NULL").withColumns({"_stop": F.lit(None).cast("long"), "_row": F.lit(1)})
    u = backup.unionByName(f, allowMissingColumns=True).withColumn("_block", floor_div("_t", HOUR_NS))
    u = ordered.last_known(u, KEYS, "_block", ["_t", "_row"], "_stop", "_until").where("_row = 1 AND _t < _until")
    return d.where("source <> 'backup'").drop("_t").unionByName(u.select(*df.columns))


def both_silent(signs: DataFrame, silence_ns: int = 30 * S, exempt: tuple[str, ...] = ("liquidations",)) -> DataFrame:
    """One gap for each stretch in which neither source gave a sign for longer than silence_ns, per stream."""
    from tidelake.operators.continuity import silences

    out = silences(signs.where(~F.col("stream").isin(*exempt)), silence_ns)
    return out.select(*KEYS, F.col("silent_from").alias("gap_start_ts"), F.col("silent_to").alias("gap_end_ts"), F.lit("both_collectors_silent").alias("reason"))


# Seconds after which a live stream counts as silent; liquidations are exempt.
WATCHDOG_SECONDS = {"bookticker": 30, "depth": 30, "funding_rate": 30, "trades": 60}


def watchdog(last_seen: DataFrame, now_ns: int) -> DataFrame:
    """Streams whose last row (last_received) is older at now than their threshold."""
    limit = F.create_map(*(x for k, v in WATCHDOG_SECONDS.items() for x in (F.lit(k), F.lit(v * S))))[F.col("stream")]
    return last_seen.where(F.lit(now_ns) - F.col("last_received") > limit).withColumn("silent_ms", F.expr(f"({now_ns} - last_received) div 1000000"))


def heartbeat_status(last_data: Column, connected: Column, now_ns: int, interval_ns: int) -> Column:
    """disconnected; subscribed_silent without data for more than two intervals, or ever; else alive."""
    silent = last_data.isNull() | (F.lit(now_ns) - last_data > 2 * interval_ns)
    return F.when(~connected, "disconnected").when(silent, "subscribed_silent").otherwise("alive")


def condition_windows(df: DataFrame, keys: list[str], time: str, flag: str, block_width: int, at_least: int = 0) -> DataFrame:
    """Maximal runs of rows with a true flag: start, end (times of the first and the last row) and n; runs
    shorter than at_least are left out. Overflow windows, holds and `for:` clauses of alerts are such runs."""
    d = df.select(*keys, time, F.coalesce(F.col(flag), F.lit(False)).alias("on")).withColumn("block", floor_div(time, block_width))
    d = d.withColumn("on_i", F.col("on").cast("int"))
    d = ordered.previous(d, keys, "block", [time, "on_i"], {"on": "was"})
    d = d.withColumn("new", (F.col("on") & ~F.coalesce("was", F.lit(False))).cast("int"))
    d = ordered.running_sum(d, keys, "block", [time, "on_i"], "new", "run").where("on")
    out = d.groupBy(*keys, "run").agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count("*").alias("n"))
    return out.where(F.col("end") - F.col("start") >= at_least).drop("run")


def recovery_depth_anchor(depth: DataFrame, markers: DataFrame) -> DataFrame:
    """An anchor gap from each marker to the next depth row of its symbol after it."""
    u = markers.select("exchange", "symbol", F.col("marker_ts").alias("t"), F.lit(None).cast("long").alias("hit")).unionByName(depth.select("exchange", "symbol", F.col("received_at").alias("t"), F.col("received_at").alias("hit")))
    u = u.withColumn("rt", -F.col("t")).withColumn("block", floor_div("rt", HOUR_NS)).withColumn("is_data", F.col("hit").isNotNull().cast("int"))
    u = ordered.last_known(u, ["exchange", "symbol"], "block", ["rt", "is_data"], "hit", "gap_end_ts")
    return u.where("hit IS NULL AND gap_end_ts IS NOT NULL").select("exchange", "symbol", F.col("t").alias("gap_start_ts"), "gap_end_ts", F.lit("recovery_depth_anchor").alias("reason"))
