"""Queries of the lake's own operators over the whole archived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES, norm, norm_names, path_columns
from tidelake.functions.payload import json_long, natural_key, payload_exchange_ts, sort_key
from tidelake.functions.timeutil import HOUR_MS, floor_div, latency_ms, next_funding_ms, ns_date, ns_hour, ns_to_ms
from tidelake.operators import backfill, classify, compact, consolidate, continuity, coverage, depth, gaps, health, integrity, metrics, ordered, reconcile, state
from tidelake.runtime import remove_path, scratch, table

KEYS = list(NAMES)
DAY = [*KEYS, "utc_date"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Instants that stand for "now" and for a restart, so that results don't depend on the clock. Where a table goes on
#: after NOW_MS, now is what the table has last.
NOW_MS = 1_612_400_000_000
RESTART_NS = 1_612_180_800_000_000_000


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    return norm_names(table(spark, sf, "envelopes"))


def in_files(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes with the date, hour and name of their file."""
    p = path_columns("file_path")
    return envelopes(spark, sf).where("file_path IS NOT NULL").withColumns({c: p[c] for c in ("utc_date", "file", "kind", "hour_no")})


def listing(spark: SparkSession, sf: str) -> DataFrame:
    return compact.latest_listing(table(spark, sf, "archive_files")).withColumns(path_columns("file_path"))


def listed_until(spark: SparkSession, sf: str) -> int | None:
    """The last listing's time in ms: the now of missing hours. None, so that no hour is cut, if no listing has a time."""
    return table(spark, sf, "archive_files").where("file_path IS NOT NULL").agg(F.max(F.unix_millis(F.col("listed_at").cast("timestamp")))).first()[0]


# --- continuity ---


@query
def trade_id_breaks(spark, sf):
    d = continuity.trade_breaks(in_files(spark, sf), DAY, "file", ["row_id"], ["received_at"])
    return d.select(*DAY, "file", "row_id", "expected", "actual", "missing", "received_at")


@query
def depth_chain_breaks(spark, sf):
    return continuity.depth_breaks(in_files(spark, sf), DAY, "file", ["row_id"], ["received_at"]).select(*DAY, "file", "row_id", "expected", "actual", "received_at")


@query
def bookticker_backward(spark, sf):
    return continuity.bookticker_breaks(in_files(spark, sf), DAY, "file", ["row_id"], ["received_at"]).select(*DAY, "file", "row_id", "expected", "actual", "received_at")


@query
def continuity_summary(spark, sf):
    """Records checked (all data rows of the three streams) and breaks, by stream-day."""
    e = in_files(spark, sf)
    n = e.where(F.col("type") == "data").where(F.col("stream").isin("trades", "depth", "bookticker")).groupBy(*DAY).agg(F.count("*").alias("records"))
    b = continuity.all_breaks(e, DAY, "file", ["row_id"], DAY).groupBy(*DAY).agg(F.count("*").alias("breaks"))
    return n.join(b, DAY, "left").na.fill(0, ["breaks"])


@query
def sequence_gap_records(spark, sf):
    """Breaks inside each file as gap records."""
    scope = [*KEYS, "file_path"]
    e = in_files(spark, sf).withColumn("one", F.lit(0))
    return continuity.sequence_gap_records(continuity.all_breaks(e, scope, "one", ["row_id"], [*KEYS, "row_id", "received_at"]))


@query
def cross_source_chain_breaks(spark, sf):
    return continuity.cross_source_breaks(envelopes(spark, sf))


@query
def session_seq_gaps(spark, sf):
    return continuity.session_seq_gaps(envelopes(spark, sf))


@query
def session_changes(spark, sf):
    return continuity.session_changes(envelopes(spark, sf))


@query
def silence_uncovered(spark, sf):
    e = envelopes(spark, sf)
    return continuity.uncovered_silences(e.where("type = 'data'"), e.where("type = 'gap'"))


@query
def silence_uncovered_by_any(spark, sf):
    """The same where a gap of any stream counts, for silences of at least ten minutes: the excerpt of
    silence_uncovered_by_any_whole that the SQL gives."""
    e = envelopes(spark, sf)
    return continuity.uncovered_silences(e.where("type = 'data'"), e.where("type = 'gap'"), 600_000_000_000, keyed=False)


@query
def silence_uncovered_by_any_whole(spark, sf):
    """The same for every silence beyond the operator's threshold."""
    e = envelopes(spark, sf)
    return continuity.uncovered_silences(e.where("type = 'data'"), e.where("type = 'gap'"), keyed=False)


@query
def sequence_numbers(spark, sf):
    """Consecutive numbers from 0 for the rows of a stream, in storing order."""
    e = envelopes(spark, sf).where("type = 'data'").withColumns({"block": floor_div("row_id", 100_000), "one": F.lit(1).cast("long")})
    return ordered.running_sum(e, KEYS, "block", ["row_id"], "one", "n").select("row_id", *KEYS, (F.col("n") - 1).alias("seq"))


@query
def late_file_sequence(spark, sf):
    """The next free number of a late file, by stream-hour."""
    return listing(spark, sf).where("kind = 'late'").groupBy(*DAY, "hour_no").agg(F.count("*").alias("late_files"), (F.max("seq") + 1).alias("next_seq"))


# --- integrity ---


@query
def missing_fields(spark, sf):
    d = envelopes(spark, sf).withColumn("missing", integrity.missing_columns())
    return d.where(F.size("missing") > 0).select("row_id", "file_path", integrity.listed(F.col("missing")).alias("missing"))


@query
def payload_hash_mismatch(spark, sf):
    return integrity.hash_mismatches(envelopes(spark, sf)).select("row_id", "file_path", "raw_sha256", "actual_sha256")


@query
def duplicate_offsets(spark, sf):
    return integrity.duplicate_offsets(envelopes(spark, sf))


@query
def duplicate_offsets_in_file(spark, sf):
    return integrity.duplicate_offsets(envelopes(spark, sf), per_file=True)


@query
def ordering_violations(spark, sf):
    e = in_files(spark, sf).withColumn("one", F.lit(0))
    return integrity.ordering_violations(e, [*KEYS, "file_path"], "one", ["row_id"]).select("row_id", "file_path", "last_key", "key")


@query
def document_hashes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


# --- keys and routing ---


@query
def natural_keys(spark, sf):
    e = envelopes(spark, sf).where("type = 'data'")
    args = ("stream", "raw_text", "exchange_ts")
    return e.select("row_id", natural_key(*args).alias("natural_key"), sort_key(*args).alias("sort_key"), payload_exchange_ts("stream", "raw_text").alias("payload_ts"))


@query
def time_routing(spark, sf):
    """The date and hour of arrival of each row, and how many differ from their file's, by kind of file."""
    e = in_files(spark, sf).where("received_at IS NOT NULL").withColumns({"d": F.date_format(ns_date("received_at"), "yyyy-MM-dd"), "h": ns_hour("received_at")})
    return e.groupBy("kind", "d", "h").agg(F.count("*").alias("n_rows"), F.count_if((F.col("d") != F.col("utc_date")) | (F.col("h") != F.col("hour_no"))).alias("n_elsewhere"))


@query
def topics(spark, sf):
    """Topic of each stream as it should be named, against the topics its rows carry."""
    e = envelopes(spark, sf).where("type = 'data' AND _topic IS NOT NULL")
    bare = F.regexp_replace("_topic", r"^backup\.", "")
    return e.groupBy("exchange", "stream", F.concat_ws(".", "exchange", "stream").alias("topic")).agg(F.count_if(bare == F.concat_ws(".", "exchange", "stream")).alias("n_right"), F.count_if(F.col("_topic").startswith("backup.")).alias("n_backup"), F.count("*").alias("n_rows"))


# --- gaps ---


@query
def missing_hours(spark, sf):
    return gaps.missing_hours(listing(spark, sf), listed_until(spark, sf))


@query
def missing_hour_envelopes(spark, sf):
    return gaps.missing_hour_envelopes(gaps.missing_hours(listing(spark, sf), listed_until(spark, sf)))


@query
def backfillable_hours(spark, sf):
    return gaps.backfillable(gaps.missing_hours(listing(spark, sf), listed_until(spark, sf))).select(*DAY, "hour_no", "start_ms", "end_ms")


@query
def hour_status(spark, sf):
    d = gaps.hour_status(listing(spark, sf))
    return d.select(*DAY, "hour_no", "status", "base", F.array_join("late", "|").alias("late"), F.array_join("backfill", "|").alias("backfill"))


@query
def hour_groups_check(spark, sf):
    """Hours whose recorded grouping disagrees with the listing in the number of late or backfill files or the base;
    an hour that only one side has counts as none of these on the other."""
    mine = gaps.hour_status(listing(spark, sf)).select(*DAY, "hour_no", F.col("base").isNotNull().alias("has_base"), F.size("late").alias("n_late"), F.size("backfill").alias("n_backfill"))
    g = norm_names(table(spark, sf, "hour_file_groups")).groupBy(*DAY, "hour_no").agg(F.max(F.col("base").isNotNull()).alias("g_base"), F.max(F.size("late")).alias("g_late"), F.max(F.size("backfill")).alias("g_backfill"))
    absent = {"has_base": False, "g_base": False, "n_late": 0, "g_late": 0, "n_backfill": 0, "g_backfill": 0}
    d = g.join(mine, [*DAY, "hour_no"], "full").na.fill(absent)
    return d.where("has_base <> g_base OR n_late <> g_late OR n_backfill <> g_backfill")


@query
def archived_gaps(spark, sf):
    return gaps.archived_gaps(envelopes(spark, sf))


@query
def archived_gaps_in_scope(spark, sf):
    return gaps.in_scope(gaps.archived_gaps(envelopes(spark, sf)), 1_612_180_800_000, 1_612_267_199_999, stream=["trades", "depth"], exchange=None)


@query
def gap_coalesce(spark, sf):
    return gaps.merge_same_start(envelopes(spark, sf).where("type = 'gap' AND gap_start_ts IS NOT NULL"))


@query
def manifest_missing_hours(spark, sf):
    return gaps.manifest_gaps(consolidate.latest_runs(norm_names(table(spark, sf, "consolidate_results"))))


@query
def component_runtime_gaps(spark, sf):
    """Collector sessions as components: last row as heartbeat; the end of a session that another of the same
    collector follows is its planned shutdown. Now is the last arrival of all, NOW_MS at least."""
    last = table(spark, sf, "envelopes").agg(F.max(ns_to_ms("received_at"))).first()[0]
    e = envelopes(spark, sf).where("type = 'data' AND collector_session_id IS NOT NULL AND received_at IS NOT NULL")
    s = e.groupBy("collector_session_id").agg(F.max(ns_to_ms("received_at")).alias("last_heartbeat_ms"))
    s = s.withColumns({"component": F.col("collector_session_id"), "clean_shutdown_ms": F.when(F.col("collector_session_id").contains("-a_"), F.col("last_heartbeat_ms") + 1000), "planned": F.col("collector_session_id").contains("-a_")})
    return gaps.component_gaps(s, max(NOW_MS, last or NOW_MS))


@query
def maintenance_gaps(spark, sf):
    d = table(spark, sf, "gap_state").where(norm("source") == "pg.maintenance_intent")
    d = d.groupBy(F.col("gap_id").alias("maintenance_id")).agg(F.min("start_ms").alias("created_ms"), F.max("end_ms").alias("expires_ms"))
    return gaps.maintenance_gaps(d.withColumn("consumed_ms", F.lit(None).cast("long")), NOW_MS)


@query
def outage_gaps(spark, sf):
    d = norm_names(table(spark, sf, "gap_records")).where(norm("reason") == "kafka_producer_outage").groupBy(*KEYS).agg(F.max("start_ms").alias("start_ms")).where("start_ms IS NOT NULL")
    return gaps.outage_gaps(d, NOW_MS, NOW_MS - 3_600_000)


@query
def state_fanout(spark, sf):
    """Maintenance records of an exchange for every stream that the exchange has in the archive."""
    s = norm_names(table(spark, sf, "gap_state")).where(norm("source") == "pg.maintenance_intent").select("gap_id", "exchange", "start_ms", "end_ms", "detail").distinct()
    streams = envelopes(spark, sf).select(*KEYS).distinct()
    return gaps.fan_out(s, streams, ["exchange"]).select("gap_id", *KEYS, "start_ms", "end_ms", "detail")


@query
def session_pairing(spark, sf):
    """Lifecycle ledger of users: a signup starts a session, a purchase shuts it down."""
    e = table(spark, sf, "events").where("event_type IN ('signup', 'purchase')")
    led = e.select("user_id", "event_id", F.when(F.col("event_type") == "signup", "start").otherwise("clean_shutdown").alias("event"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"))
    return gaps.paired_sessions(led, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "start_ts", F.col("ts").alias("end_ts"))


# --- reconciliation ---


def _sides(spark, sf):
    def one(t: str, key: str) -> DataFrame:
        d = norm_names(table(spark, sf, t).select("gap_id", *NAMES, "start_ms", "end_ms", "reason", "recorded_at"), (*NAMES, "reason"))
        return state.latest_by(d, ["gap_id"], "recorded_at").drop("recorded_at").withColumnRenamed("gap_id", key).where("start_ms <= end_ms")

    return one("gap_records", "file_id"), one("gap_state", "state_id")


@query
def reconcile_explained(spark, sf):
    return reconcile.chosen(*_sides(spark, sf))


@query
def reconcile_unexplained(spark, sf):
    f, s = _sides(spark, sf)
    return reconcile.unexplained(f, reconcile.chosen(f, s))


@query
def reconcile_orphans(spark, sf):
    f, s = _sides(spark, sf)
    return reconcile.orphans(s, reconcile.chosen(f, s))


@query
def reconcile_summary(spark, sf):
    f, s = _sides(spark, sf)
    return reconcile.summary(f, s, reconcile.chosen(f, s))


# --- consolidation ---


@query
def hour_merge_order(spark, sf):
    return consolidate.merge_hours(in_files(spark, sf).where("hour_no IS NOT NULL"), ["row_id"]).select("row_id", *DAY, "hour_no", F.col("pos").cast("long").alias("pos"))


@query
def hour_counts(spark, sf):
    return consolidate.hour_counts(in_files(spark, sf), [*DAY, "hour_no"])


@query
def day_counts(spark, sf):
    return consolidate.hour_counts(in_files(spark, sf), DAY)


@query
def date_manifest(spark, sf):
    d = consolidate.date_manifest(in_files(spark, sf).where("hour_no IS NOT NULL"))
    return d.select("utc_date", *KEYS, F.array_join(F.transform("hours", lambda h: h.cast("string")), ",").alias("hours"), "record_count", F.size("gaps").alias("n_gaps"))


def _day_manifest(spark, sf):
    files = listing(spark, sf)
    counts = consolidate.hour_counts(in_files(spark, sf).where("hour_no IS NOT NULL"), [*DAY, "hour_no"])
    status = gaps.hour_status(files).select(*DAY, "hour_no", "status", F.array_sort(F.concat(F.array_compact(F.array("base")), "late", "backfill")).alias("sources"))
    hours = status.join(counts, [*DAY, "hour_no"], "left").na.fill(0, ["data_records", "gap_records"])
    return consolidate.day_manifest(hours, gaps.missing_hours(files, listed_until(spark, sf)))


@query
def day_manifest(spark, sf):
    d = _day_manifest(spark, sf)
    return d.select(*DAY, "total_records", "data_records", "gap_records", F.size(F.map_keys("hours")).alias("n_hours"), F.array_join(F.transform("missing_hours", lambda h: h.cast("string")), ",").alias("missing_hours"), F.size("source_files").alias("source_files_count"))


@query
def cycle_totals(spark, sf):
    return consolidate.cycle_totals(consolidate.latest_runs(norm_names(table(spark, sf, "consolidate_results"))))


# --- state ---


@query
def high_water(spark, sf):
    return state.high_water(envelopes(spark, sf))


@query
def latest_checkpoint(spark, sf):
    d = norm_names(table(spark, sf, "stream_checkpoint")).select(*KEYS, "updated_at", "hour_start_ms", "last_received_at")
    return state.latest_by(d, KEYS, "updated_at", "hour_start_ms", "last_received_at")


@query
def file_state_upsert(spark, sf):
    s = table(spark, sf, "writer_file_state")
    return state.upsert_file_state(s, s)


@query
def files_against_state(spark, sf):
    f = listing(spark, sf)
    side = table(spark, sf, "archive_files").where(F.col("file_path").endswith(".sha256")).select(F.regexp_replace("file_path", r"\.sha256$", "").alias("file_path")).distinct().withColumn("s", F.lit(True))
    d = f.where("kind <> 'other'").join(side, "file_path", "left").select("file_path", "size_bytes", F.coalesce("s", F.lit(False)).alias("has_sidecar"))
    return state.files_against_state(d, table(spark, sf, "writer_file_state").where("file_path IS NOT NULL"))


@query
def missing_sidecars(spark, sf):
    """Data files of more than 0 bytes without checksum file."""
    f = listing(spark, sf).where("kind <> 'other' AND size_bytes > 0").withColumn("sidecar", F.concat("file_path", F.lit(".sha256")))
    side = table(spark, sf, "archive_files").where(F.col("file_path").endswith(".sha256")).select(F.col("file_path").alias("sidecar")).distinct()
    return f.join(side, "sidecar", "left_anti").select("file_path", "size_bytes")


@query
def recovery_gaps(spark, sf):
    """The first row of each stream after a restart, against its last checkpoint before: the gap between them,
    if the session changed."""
    c = norm_names(table(spark, sf, "stream_checkpoint")).where(f"hour_start_ms * 1000000 < {RESTART_NS} AND last_received_at IS NOT NULL AND last_collector_session_id IS NOT NULL")
    c = state.latest_by(c.select(*KEYS, "hour_start_ms", "updated_at", "last_received_at", "last_collector_session_id"), KEYS, "hour_start_ms", "updated_at")
    e = envelopes(spark, sf).where(f"type = 'data' AND received_at >= {RESTART_NS} AND collector_session_id IS NOT NULL")
    first = e.groupBy(*KEYS).agg(F.min(F.struct("received_at", "row_id", "collector_session_id")).alias("f"))
    d = first.join(c, KEYS).where("f.collector_session_id <> last_collector_session_id AND f.received_at > last_received_at")
    return d.select(*KEYS, F.col("last_received_at").alias("gap_start_ts"), F.col("f.received_at").alias("gap_end_ts"), F.lit("restart_gap").alias("reason"))


@query
def latest_order_of_customer(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("ordered_us"), "o_orderkey")
    return state.latest_by(o, ["o_custkey"], "ordered_us", "o_orderkey")


@query
def restart_classify(spark, sf):
    """Evidence made up from orders, so that all branches occur."""
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    d = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(k % 3 != 0, (k % 5).cast("string")).alias("previous_boot"), (k % 5 + F.when(k % 7 == 0, 1).otherwise(0)).cast("string").alias("current_boot"),
        F.when(k % 4 != 0, F.concat(F.lit("s"), (k % 2).cast("string"))).alias("previous_session"), F.concat(F.lit("s"), (k % 3).cast("string")).alias("current_session"),
        (st == "F").alias("collector_clean"), (k % 11 == 0).alias("system_clean"),
        F.when(k % 6 == 0, F.concat(F.lit("m"), k.cast("string"))).alias("intent_id"), F.when(k % 12 == 0, k % 100).alias("intent_expires_ms"), F.lit(50).cast("long").alias("now_ms"),
        (k % 9 == 0).alias("host_intent"), F.when(k % 13 == 0, F.array(F.lit("postgres"))).when(k % 17 == 0, F.array(F.lit("writer"), F.lit("redpanda"))).alias("died"),
    )
    out = classify.classify_restarts(d)
    return out.select("o_orderkey", "component", "cause", "planned", F.array_join("evidence", "|").alias("evidence"))


# --- two collectors ---


def _sourced(spark, sf):
    return envelopes(spark, sf).withColumn("source", continuity.source_of())


@query
def coverage_suppression(spark, sf):
    """Gap envelopes, told apart as covered by the other collector or not. Gaps of no broker count as the
    primary's."""
    e = _sourced(spark, sf)
    g = e.where("type = 'gap'").select(F.col("row_id").alias("gap_no"), *KEYS, F.coalesce("source", F.lit("primary")).alias("source"), norm("reason").alias("reason"), "gap_start_ts", "received_at")
    d = e.where("type = 'data' AND source IS NOT NULL").select(*KEYS, "source", "received_at")
    return coverage.suppress_covered(g, d).select("gap_no", *KEYS, "source", "gap_start_ts", "covered")


def _failovers(spark, sf, *ns: int):
    e = _sourced(spark, sf).where("type = 'data' AND source = 'primary'").select(*KEYS, "received_at")
    return coverage.failover_intervals(e, *ns)


def _routed(spark, sf, failovers: DataFrame) -> DataFrame:
    d = coverage.route(_sourced(spark, sf).where("source IS NOT NULL AND received_at IS NOT NULL").select("row_id", "type", *KEYS, "source", "received_at"), failovers)
    return d.groupBy(*KEYS, "source").agg(F.count("*").alias("n_rows"), F.sum(F.col("row_id").cast("decimal(38,0)")).cast("bigint").alias("row_sum"))


#: Silence and recovery of the SQL; the queries named whole take the operators' own thresholds.
SLOW = (600 * coverage.S, 1200 * coverage.S)


@query
def failover_intervals(spark, sf):
    return _failovers(spark, sf, *SLOW)


@query
def failover_intervals_whole(spark, sf):
    return _failovers(spark, sf)


@query
def source_routing(spark, sf):
    """Rows that would be archived, by stream and source."""
    return _routed(spark, sf, _failovers(spark, sf, *SLOW))


@query
def source_routing_whole(spark, sf):
    return _routed(spark, sf, _failovers(spark, sf))


@query
def both_silent(spark, sf):
    return coverage.both_silent(_sourced(spark, sf).where("type = 'data'"), 600 * coverage.S)


@query
def both_silent_whole(spark, sf):
    return coverage.both_silent(_sourced(spark, sf).where("type = 'data'"))


def _last_seen(spark, sf):
    return envelopes(spark, sf).where(f"type = 'data' AND received_at <= {RESTART_NS}").groupBy(*KEYS).agg(F.max("received_at").alias("last_received"))


@query
def watchdog_silent(spark, sf):
    return coverage.watchdog(_last_seen(spark, sf), RESTART_NS)


@query
def heartbeat_status(spark, sf):
    status = coverage.heartbeat_status(F.col("last_received"), F.col("exchange") != "kelpex", RESTART_NS, 10 * coverage.S)
    return _last_seen(spark, sf).select(*KEYS, "last_received", status.alias("status"))


@query
def overflow_windows(spark, sf):
    """Maximal runs of dropped rows: gap envelopes of reason buffer_overflow among a stream's rows."""
    e = envelopes(spark, sf).withColumn("drop", F.coalesce(norm("reason") == "buffer_overflow", F.lit(False)))
    return coverage.condition_windows(e, KEYS, "row_id", "drop", 100_000)


@query
def recovery_anchors(spark, sf):
    e = envelopes(spark, sf)
    m = e.where("type = 'gap' AND stream = 'depth' AND gap_end_ts IS NOT NULL").select("exchange", "symbol", F.col("gap_end_ts").alias("marker_ts")).distinct()
    return coverage.recovery_depth_anchor(e.where("type = 'data' AND stream = 'depth' AND received_at IS NOT NULL"), m)


# --- health ---


@query
def consumer_outages(spark, sf):
    return health.consumer_outages(envelopes(spark, sf), "received_at")


@query
def offset_resets(spark, sf):
    return health.offset_resets(envelopes(spark, sf))


def _marked(spark, sf, reason: str) -> DataFrame:
    e = envelopes(spark, sf).where("received_at IS NOT NULL")
    return e.withColumn("hit", F.coalesce(norm("reason") == reason, F.lit(False)))


@query
def disconnect_gaps(spark, sf):
    return health.disconnect_gaps(_marked(spark, sf, "ws_disconnect").where("type = 'data' OR hit"), "received_at", "hit")


def _probes(spark, sf):
    """Rows of an exchange as probes of its producer: failed deliveries among them are failures."""
    return _marked(spark, sf, "kafka_delivery_failed").groupBy("exchange", "received_at").agg(F.bool_or("hit").alias("failed"))


@query
def producer_outages(spark, sf):
    return health.producer_outages(_probes(spark, sf), ["exchange"], "received_at", "failed")


@query
def producer_states(spark, sf):
    d = health.producer_states(_probes(spark, sf), ["exchange"], "received_at", "failed", 50_000_000)
    return d.groupBy("exchange", "state").agg(F.count("*").alias("n"))


@query
def hold_windows(spark, sf):
    return health.holds(_probes(spark, sf), ["exchange"], "received_at", "failed", 1, "pg_outage_hold")


@query
def frame_routing(spark, sf):
    """Archived payloads put into combined frames and taken out again: rows by stream, and how many came out
    the same to the byte."""
    from tidelake.functions import frames

    e = envelopes(spark, sf).where("type = 'data' AND raw_text IS NOT NULL AND stream IN ('trades', 'depth', 'bookticker', 'funding_rate')")
    back = F.create_map(*(x for k, v in frames.STREAM_KEYS.items() for x in (F.lit(v), F.lit(k))))
    frame = F.concat(F.lit('{"stream":"'), "symbol", F.lit("@"), back[F.col("stream")], F.lit('","data":'), "raw_text", F.lit("}"))
    d = e.select(F.col("raw_text").alias("before"), F.col("stream").alias("told"), frame.alias("frame"))
    d = frames.route_frames(d, "frame", e.select("symbol"))
    return d.groupBy("stream").agg(F.count("*").alias("n"), F.count_if((F.col("before") == F.col("raw_text")) & (F.col("told") == F.col("stream"))).alias("n_same"))


# --- depth, interpolation, backfill ---


def _books(spark, sf):
    e = in_files(spark, sf)
    return depth.depth_rows(e.withColumn("symbol", F.concat_ws("|", "symbol", "utc_date"))).withColumns({"utc_date": F.substring_index("symbol", "|", -1), "symbol": F.substring_index("symbol", "|", 1)})


@query
def depth_replay(spark, sf):
    return depth.replay_any(_books(spark, sf), ["exchange", "utc_date", "symbol"])


@query
def depth_replay_asof(spark, sf):
    return depth.replay_asof(_books(spark, sf), ["exchange", "utc_date", "symbol"])


@query
def depth_online(spark, sf):
    return depth.detect_online(_books(spark, sf), ["exchange", "utc_date", "symbol"]).groupBy("exchange", "utc_date", "symbol", "outcome").agg(F.count("*").alias("n"))


@query
def snapshot_asof(spark, sf):
    """For each depth diff the latest snapshot id of its book that was received before or with it."""
    d = depth.depth_rows(envelopes(spark, sf)).where("kind <> 'gap' AND received_at IS NOT NULL").withColumn("lid", F.when(F.col("kind") == "snapshot", F.col("lid")))
    d = d.where("kind = 'diff' OR lid IS NOT NULL").withColumns({"block": floor_div("received_at", depth.HOUR_NS), "is_diff": (F.col("kind") == "diff").cast("int")})
    d = ordered.last_known(d, ["exchange", "symbol"], "block", ["received_at", "is_diff", "row_id"], "lid", "snapshot_lid")
    return d.where("kind = 'diff'").select("row_id", "exchange", "symbol", "snapshot_lid")


def _funding_pairs(spark, sf) -> DataFrame:
    """Successive readings of the mark and index prices as t0, t1 and each field at both."""
    num = lambda k: F.max(F.get_json_object("raw_text", f"$.{k}").try_cast("double"))
    e = envelopes(spark, sf).where("type = 'data' AND stream = 'funding_rate' AND exchange_ts IS NOT NULL")
    e = e.groupBy("exchange", "symbol", "exchange_ts").agg(num("p").alias("mark"), num("i").alias("idx"), num("P").alias("settle")).withColumn("block", floor_div("exchange_ts", HOUR_MS))
    names = ("mark", "idx", "settle")
    d = ordered.previous(e, ["exchange", "symbol"], "block", ["exchange_ts"], {"exchange_ts": "t0", **{n: f"{n}0" for n in names}}).withColumnsRenamed({"exchange_ts": "t1", **{n: f"{n}1" for n in names}})
    return d.where("t0 IS NOT NULL")


def _funding_grid(pairs: DataFrame, *step_ms: int) -> DataFrame:
    names = ("mark", "idx", "settle")
    g = backfill.interpolate_grid(pairs, ["exchange", "symbol"], list(names), *step_ms)
    return g.select("exchange", "symbol", "t", *(F.round(n, 6).alias(n) for n in names), "next_funding")


@query
def funding_interpolation(spark, sf):
    """Mark and index prices on a one-minute grid between readings more than ten minutes apart: the excerpt of
    funding_interpolation_whole that the SQL gives."""
    return _funding_grid(_funding_pairs(spark, sf).where("t1 - t0 > 600000"), 60_000)


@query
def funding_interpolation_whole(spark, sf):
    """Mark and index prices on the operator's one-second grid between all successive readings."""
    return _funding_grid(_funding_pairs(spark, sf))


@query
def backfill_envelopes(spark, sf):
    """Trades already archived by a backfill, wrapped again as if they had just been fetched."""
    e = envelopes(spark, sf).where("type = 'data' AND stream = 'trades' AND _topic = 'backfill'")
    t = json_long("raw_text", "$.T")
    d = e.where(t.isNotNull()).select(*KEYS, (floor_div(t, HOUR_MS) * HOUR_MS).alias("hour_start_ms"), "raw_text").distinct()
    return backfill.backfill_envelopes(d, RESTART_NS, "backfill_1").select(*KEYS, "exchange_ts", "session_seq", "raw_sha256", "_offset")


# --- metrics ---


def _latencies(spark, sf):
    return envelopes(spark, sf).where("type = 'data' AND exchange_ts IS NOT NULL AND received_at IS NOT NULL").withColumn("latency", latency_ms("received_at", "exchange_ts"))


@query
def latency_histogram(spark, sf):
    return metrics.histogram(_latencies(spark, sf), ["stream"], "latency")


@query
def latency_quantiles(spark, sf):
    h = metrics.histogram(_latencies(spark, sf), ["stream"], "latency")
    d = metrics.histogram_quantile(h, ["stream"], 0.99).unionByName(metrics.histogram_quantile(h, ["stream"], 0.5))
    return d.withColumn("value", F.round("value", 6))


@query
def increase_5m(spark, sf):
    e = envelopes(spark, sf).withColumn("ms", ns_to_ms("received_at"))
    return metrics.increase(e, ["exchange", "stream", "type"], "ms", 300_000)


@query
def rate_by_stream(spark, sf):
    e = envelopes(spark, sf).where("type = 'data'").withColumn("ms", ns_to_ms("received_at"))
    return metrics.rate(e, ["stream"], "ms", 60_000).withColumn("rate", F.round("rate", 6))


@query
def lookback_5m(spark, sf):
    """For each gap envelope how many of its exchange came in the five minutes up to it (whole seconds)."""
    g = envelopes(spark, sf).where("type = 'gap' AND received_at IS NOT NULL").select("row_id", "exchange", floor_div("received_at", 1_000_000_000).alias("s"), F.lit(1).alias("one"))
    return metrics.lookback(g, ["exchange"], "s", 300, "one").select("row_id", "exchange", "lookback")


@query
def sustained_lag(spark, sf):
    """Stretches of at least two minutes in which every data row of a stream came more than 80 ms late."""
    e = _latencies(spark, sf).where("received_at IS NOT NULL").groupBy(*KEYS, ns_to_ms("received_at").alias("ms")).agg(F.min("latency").alias("latency"))
    return coverage.condition_windows(e.withColumn("lagging", F.col("latency") > 80), KEYS, "ms", "lagging", HOUR_MS, 120_000)


@query
def gauge_summary(spark, sf):
    f = table(spark, sf, "writer_file_state").where("file_byte_size IS NOT NULL")
    return f.groupBy("topic").agg(F.max("file_byte_size").alias("max_bytes"), F.min("file_byte_size").alias("min_bytes"), F.round(F.avg("file_byte_size"), 4).alias("avg_bytes"), F.count("*").alias("n"))


@query
def write_errors_or_zero(spark, sf):
    return metrics.or_zero(envelopes(spark, sf), F.count_if(F.coalesce(norm("reason") == "write_error", F.lit(False))), "write_errors")


@query
def sealed_hours(spark, sf):
    """Hours with a base file by stream-day, how far behind the last one is, and whether the day is whole."""
    d = listing(spark, sf).where("kind = 'base' AND size_bytes > 0").groupBy(*DAY).agg(F.countDistinct("hour_no").alias("sealed"), (F.lit(23) - F.max("hour_no")).alias("hours_behind"))
    return d.withColumn("incomplete", F.col("sealed") < 24)


@query
def compression_ratio(spark, sf):
    raw = in_files(spark, sf).where("raw_text IS NOT NULL").groupBy("file_path").agg(F.sum(F.octet_length("raw_text")).alias("raw_bytes"))
    d = raw.join(listing(spark, sf).where("size_bytes > 0"), "file_path")
    return d.groupBy("exchange", "stream").agg(F.sum("raw_bytes").alias("raw_bytes"), F.sum("size_bytes").alias("size_bytes")).withColumn("ratio", F.round(F.col("raw_bytes") / F.col("size_bytes"), 6))


@query
def next_funding(spark, sf):
    e = envelopes(spark, sf).where("type = 'data' AND stream = 'funding_rate' AND exchange_ts IS NOT NULL")
    return e.select("row_id", next_funding_ms("exchange_ts").alias("next_funding"), (json_long("raw_text", "$.T") == next_funding_ms("exchange_ts")).alias("agrees"))


# --- streaming ---


@query
def dedup_stream(spark, sf):
    from tidelake.streaming import pipelines

    d = pipelines.dedup_offsets(spark, f"{sf}/envelopes.parquet").where("_offset >= 0 AND _topic IS NOT NULL AND _partition IS NOT NULL")
    return d.groupBy("_topic", "_partition").agg(F.count("*").alias("n"), F.min("_offset").alias("first_offset"), F.max("_offset").alias("last_offset"))


@query
def dedup_bypass(spark, sf):
    """Rows that no broker delivered: none of them is taken for a copy."""
    from tidelake.streaming import pipelines

    d = pipelines.dedup_offsets(spark, f"{sf}/envelopes.parquet").where("_offset < 0 OR _offset IS NULL OR _topic IS NULL OR _partition IS NULL")
    return d.groupBy("_topic").agg(F.count("*").alias("n"))


@query
def parked_gaps_stream(spark, sf):
    """coverage_suppression by the stream: gaps parked across micro-batches, all of them in the end."""
    from tidelake.streaming import exactly_once, pipelines

    e = _sourced(spark, sf).withColumn("source", F.when(F.col("type") == "gap", F.coalesce("source", F.lit("primary"))).otherwise(F.col("source")))
    e = e.where("received_at IS NOT NULL").select("row_id", *KEYS, "type", "source", "received_at", "gap_start_ts", "gap_end_ts", norm("reason").alias("reason"))
    stream, arrivals = exactly_once.as_arrivals(e, "row_id", 3)
    base = scratch(spark, "parked")
    parked = pipelines.ParkedGaps(spark, base)
    parked.follow(stream, f"{base}/checkpoint").awaitTermination()
    out = parked.flush()
    remove_path(spark, arrivals)
    return out.select(*KEYS, "source", "gap_start_ts").distinct()


@query
def hour_tumble_stream(spark, sf):
    from tidelake.streaming import pipelines

    return pipelines.hourly_counts(spark, f"{sf}/envelopes.parquet")
