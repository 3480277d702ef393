"""Sources of gap records: missing hours, archived gaps, and what the operational state says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES
from tidelake.functions.timeutil import DAY_MS, HOUR_MS, ns_to_ms

KEYS = list(NAMES)
DAY = [*KEYS, "utc_date"]
GAP = ["source", *KEYS, "start_ms", "end_ms", "reason", "detail"]
#: Streams whose missing hours can be fetched again.
BACKFILLABLE = ("trades", "funding_rate", "open_interest")


def date_ms(c: Column | str) -> Column:
    return F.unix_date(F.to_date(F.col(c) if isinstance(c, str) else c)).cast("long") * DAY_MS


def hour_status(files: DataFrame) -> DataFrame:
    """One row for each stream-day and hour with files: status (backfilled with backfill but no base
    file, else present), base path, late and backfill paths by number. files: path_columns and file_path, listed once."""
    d = files.where(F.col("kind").isin("base", "late", "backfill"))
    one = lambda k: F.when(F.col("kind") == k, F.struct("seq", "file_path"))
    paths = lambda k: F.transform(F.sort_array(F.collect_list(one(k))), lambda x: x["file_path"])
    out = d.groupBy(*DAY, "hour_no").agg(F.min(F.when(F.col("kind") == "base", F.col("file_path"))).alias("base"), paths("late").alias("late"), paths("backfill").alias("backfill"))
    status = F.when(F.col("base").isNull() & (F.size("backfill") > 0), "backfilled").otherwise("present")
    return out.withColumn("status", status)


def missing_hours(files: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Hours of a stream-day without any file, as gap records, for stream-days that have at least one file.

    A daily file covers all hours; hours that start after now don't count. The hours of a day are one bitmap by
    aggregation; only the zero bits are expanded, so there is no calendar to join with.
    """
    d = files.where(F.col("kind").isin("base", "late", "backfill", "daily"))
    bits = F.bit_or(F.when(F.col("kind") == "daily", (1 << 24) - 1).otherwise(F.call_function("shiftleft", F.lit(1), F.col("hour_no")))).alias("bits")
    day = d.groupBy(*DAY).agg(bits)
    gone = F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: F.call_function("shiftright", F.col("bits"), h).bitwiseAND(1) == 0)
    out = day.select(*DAY, F.explode(gone).alias("hour_no"))
    out = out.withColumn("start_ms", date_ms("utc_date") + F.col("hour_no").cast("long") * HOUR_MS)
    if now_ms is not None:
        out = out.where(F.col("start_ms") <= now_ms)
    return out.select(F.lit("file.missing_hour").alias("source"), *DAY, "hour_no", "start_ms", (F.col("start_ms") + HOUR_MS - 1).alias("end_ms"), F.lit("missing_hour").alias("reason"), F.concat(F.lit("hour "), "hour_no", F.lit(" file absent")).alias("detail"))


def missing_hour_envelopes(missing: DataFrame) -> DataFrame:
    """Gap envelopes for missing hours: the whole hour in ns, marked as injected."""
    start = F.col("start_ms") * 1_000_000
    return missing.select(F.lit(1).alias("v"), F.lit("gap").alias("type"), *KEYS, start.alias("gap_start_ts"), (start + HOUR_MS * 1_000_000 - 1).alias("gap_end_ts"), F.lit("missing_hour").alias("reason"), F.concat(F.lit("No data files found for hour "), "hour_no", F.lit("; not recoverable via backfill")).alias("detail"), F.lit(-1).cast("long").alias("session_seq"), F.lit(-1).cast("long").alias("_offset"))


def backfillable(missing: DataFrame, streams: tuple[str, ...] = BACKFILLABLE) -> DataFrame:
    return missing.where(F.col("stream").isin(*streams))


def in_scope(df: DataFrame, start_ms: int | None = None, end_ms: int | None = None, **names: list[str] | None) -> DataFrame:
    """Rows whose names are among the given (None or empty: any) and that overlap the inclusive span."""
    for c, values in names.items():
        if values:
            df = df.where(F.col(c).isin(*values))
    if start_ms is not None:
        df = df.where(F.col("end_ms") >= start_ms)
    if end_ms is not None:
        df = df.where(F.col("start_ms") <= end_ms)
    return df


def archived_gaps(envelopes: DataFrame) -> DataFrame:
    """Gap envelopes as gap records in ms."""
    return envelopes.where("type = 'gap'").select(F.lit("file.envelope").alias("source"), *KEYS, ns_to_ms("gap_start_ts").alias("start_ms"), ns_to_ms("gap_end_ts").alias("end_ms"), "reason", "detail")


def merge_same_start(gaps: DataFrame, arrival: str = "row_id") -> DataFrame:
    """Gap windows with equal names and start become one: the first one's fields, the greatest end."""
    first = F.min_by(F.struct("reason", "detail", arrival), F.col(arrival)).alias("f")
    return gaps.groupBy(*KEYS, "gap_start_ts").agg(first, F.max("gap_end_ts").alias("gap_end_ts"), F.count("*").alias("n_merged")).select(*KEYS, "gap_start_ts", "gap_end_ts", "f.reason", "f.detail", F.col(f"f.{arrival}").alias("first_row"), "n_merged")


def described(df: DataFrame, *names: str) -> Column:
    """'a=1; b=-': the named columns as text, - for nulls and for columns that df hasn't."""
    value = lambda n: F.coalesce(F.col(n).cast("string"), F.lit("-")) if n in df.columns else F.lit("-")
    return F.concat_ws("; ", *(F.concat(F.lit(f"{n}="), value(n)) for n in names))


def component_gaps(state: DataFrame, now_ms: int) -> DataFrame:
    """[last heartbeat, clean shutdown or now] of each component; planned: collector_restart, else restart_gap.

    state: component, last_heartbeat_ms, clean_shutdown_ms, planned, and for the text instance_id, host_boot_id
    and maintenance_id if they are there. Without a heartbeat no row."""
    reason = F.when(F.coalesce("planned", F.lit(False)), "collector_restart").otherwise("restart_gap")
    end = F.coalesce("clean_shutdown_ms", F.lit(now_ms).cast("long"))
    return state.where("last_heartbeat_ms IS NOT NULL").select(F.lit("pg.component_runtime").alias("source"), "component", F.col("last_heartbeat_ms").alias("start_ms"), end.alias("end_ms"), reason.alias("reason"), described(state, "component", "instance_id", "host_boot_id", "maintenance_id").alias("detail"))


def maintenance_gaps(intents: DataFrame, now_ms: int) -> DataFrame:
    """[created, consumed or expiry or now] of each maintenance intent."""
    end = F.coalesce("consumed_ms", "expires_ms", F.lit(now_ms).cast("long"))
    return intents.select(F.lit("pg.maintenance_intent").alias("source"), "maintenance_id", F.col("created_ms").alias("start_ms"), end.alias("end_ms"), F.lit("collector_restart").alias("reason"), described(intents, "maintenance_id", "scope", "reason", "planned_by").alias("detail"))


def outage_gaps(outages: DataFrame, now_ms: int, scope_end_ms: int) -> DataFrame:
    """[start, the earlier of now and the scope's end] of outages that go on."""
    return outages.select("*", F.lit(min(now_ms, scope_end_ms)).cast("long").alias("end_ms"), F.lit("kafka_producer_outage").alias("reason"))


def paired_sessions(ledger: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each clean shutdown with the last start of its session before it; shutdowns without a start are left out.

    ledger: keys, event (start or clean_shutdown), ts. The session's lifetime is the interval."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    d = ledger.withColumn("start_ts", F.last(F.when(F.col("event") == "start", F.col("ts")), ignorenulls=True).over(w))
    return d.where("event = 'clean_shutdown' AND start_ts IS NOT NULL")


def manifest_gaps(manifests: DataFrame) -> DataFrame:
    """The missing hours that manifests list, as gap records."""
    d = manifests.select(*DAY, F.explode("missing_hours").alias("hour_no"))
    start = date_ms("utc_date") + F.col("hour_no").cast("long") * HOUR_MS
    return d.select(F.lit("manifest").alias("source"), *DAY, "hour_no", start.alias("start_ms"), (start + HOUR_MS - 1).alias("end_ms"), F.lit("missing_hour").alias("reason"), F.concat(F.lit("manifest="), "utc_date", F.lit("; hour="), "hour_no").alias("detail"))


def fan_out(state_gaps: DataFrame, streams: DataFrame, on: list[str], strict: bool = False) -> DataFrame:
    """A state gap for every archived stream in its scope (equal `on` columns). strict: a gap whose scope has no
    stream keeps one row with empty names."""
    out = state_gaps.join(streams, on, "left" if strict else "inner")
    names = [c for c in streams.columns if c not in on]
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in names}).withColumn("detail", F.concat(F.coalesce("detail", F.lit("")), F.lit("; fanout=true")))


def gap_envelopes(gaps: DataFrame, session: Column, received_at: Column, session_seq: Column | None = None, topic: Column | None = None) -> DataFrame:
    """Gaps (names, gap_start_ts, gap_end_ts, reason, detail; a null bound is the time of emission) as the envelopes that
    a collector or writer emits; what has no place in a session or at a broker has -1 there. Other columns of gaps,
    such as a restart's classification, go along."""
    core = ["v", "type", *KEYS, "received_at", "collector_session_id", "session_seq", "gap_start_ts", "gap_end_ts", "reason", "detail", "_topic", "_partition", "_offset"]
    at = received_at.cast("long")
    none = F.lit(-1).cast("long")
    values = {
        "v": F.lit(1), "type": F.lit("gap"), "received_at": at, "collector_session_id": session, "session_seq": none if session_seq is None else session_seq,
        "gap_start_ts": F.coalesce("gap_start_ts", at), "gap_end_ts": F.coalesce("gap_end_ts", at), "_topic": F.lit("") if topic is None else topic, "_partition": F.lit(0), "_offset": none,
    }
    return gaps.select(*(values[c].alias(c) if c in values else F.col(c) for c in core), *[c for c in gaps.columns if c not in core])


def recovery_gaps(first_rows: DataFrame, checkpoints: DataFrame, evidence: DataFrame) -> DataFrame:
    """The restart gap of each stream that has a checkpoint: from its last row before to its first row after a restart,
    classified (component, cause, planned, evidence; see classify_restarts).

    first_rows: names, received_at, collector_session_id of the first row. checkpoints: names, last_received_at,
    last_collector_session_id and clean (see state.clean_shutdowns). evidence: at most one row with previous_boot,
    current_boot, collector_clean, system_clean, intent_id, intent_expires_ms, now_ms, host_intent, died; without one
    the sessions alone decide."""
    from tidelake.operators.classify import classify_restarts

    e = evidence.limit(1).collect()
    told = e[0].asDict() if e else {}
    kinds = {"previous_boot": "string", "current_boot": "string", "collector_clean": "boolean", "system_clean": "boolean", "intent_id": "string", "intent_expires_ms": "bigint", "now_ms": "bigint", "host_intent": "boolean", "died": "array<string>"}
    const = {c: F.array(*map(F.lit, told[c])).cast(k) if c == "died" and told.get(c) is not None else F.lit(told.get(c)).cast(k) for c, k in kinds.items()}
    d = first_rows.select(*KEYS, F.col("received_at").alias("gap_end_ts"), F.col("collector_session_id").alias("current_session")).join(checkpoints.where("last_received_at IS NOT NULL").select(*KEYS, F.col("last_received_at").alias("gap_start_ts"), F.col("last_collector_session_id").alias("previous_session"), F.col("clean").alias("_clean")), KEYS)
    d = d.withColumns(const).withColumn("collector_clean", F.coalesce("collector_clean", F.lit(False)) | F.col("_clean"))
    # Fixed value: the text of restart gaps.
    return classify_restarts(d).select(*KEYS, "gap_start_ts", "gap_end_ts", F.lit("restart_gap").alias("reason"), F.lit("writer restart detected").alias("detail"), "component", "cause", "planned", "evidence", F.col("intent_id").alias("maintenance_id"), F.col("current_session").alias("collector_session_id"))


def writer_gaps(gaps: DataFrame, data: DataFrame, bypass: Column | None = None, grace_ns: int = 10_000_000_000) -> DataFrame:
    """The gaps (gap_no, names, source, reason, gap_start_ts, received_at, and others) that a writer archives: those that
    the other source covers are suppressed, unless bypass, by which gaps known to be uncovered and those of a shutdown
    are written in any case."""
    from tidelake.operators.coverage import suppress_covered

    d = suppress_covered(gaps, data, grace_ns).where(~F.col("covered") | (F.lit(False) if bypass is None else F.coalesce(bypass, F.lit(False))))
    return d.select(*gaps.columns)
