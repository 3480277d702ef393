"""Queries of ingest, recovery and the archive's files: what a collector, a writer and their repair produce."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES, norm, norm_names, path_columns
from tidelake.functions.payload import json_long
from tidelake.functions.timeutil import scope_dates, session_id
from tidelake.operators import backfill, depth, gaps, health, metrics, state
from tidelake.plans.lake import DAY, KEYS, NOW_MS, RESTART_NS, _failovers, _sourced, envelopes, in_files, listed_until, listing
from tidelake.runtime import remove_path, scratch, table, write_cut
from tidelake.sources import archive, sink

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ARCHIVED_DATE = "2021-02-01"
CAPS = {"depth": 200, "trades": 100}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# --- identities, scopes, holds ---


@query
def gap_scope_dates(spark, sf):
    """The dates that each file record of a gap touches."""
    g = table(spark, sf, "gap_records").where("start_ms <= end_ms").select("gap_id", "start_ms", "end_ms").distinct()
    return g.select("gap_id", "start_ms", "end_ms", F.explode(scope_dates("start_ms", "end_ms")).alias("d")).select("gap_id", "start_ms", "end_ms", F.date_format("d", "yyyy-MM-dd").alias("utc_date"))


@query
def session_ids(spark, sf):
    """The name that a session of each exchange's collector would have, begun at each checkpoint."""
    c = norm_names(table(spark, sf, "stream_checkpoint")).where("last_received_at IS NOT NULL").select("exchange", "last_received_at").distinct()
    return c.select("exchange", "last_received_at", session_id(F.concat("exchange", F.lit("-collector-01")), "last_received_at").alias("session_id"))


@query
def hold_reasons(spark, sf):
    """Orders as errors: which of them would put the writer on hold."""
    k = F.col("o_orderkey")
    text = F.when(k % 5 == 0, F.concat(F.lit("write failed: No space left on device, order "), k.cast("string"))).when(k % 7 != 0, "other")
    code = F.when(k % 3 == 0, "08006").when(k % 11 == 0, "57P01").when(k % 13 == 0, "23505")
    d = table(spark, sf, "orders").select("o_orderkey", health.hold_reason(text, code).alias("reason"))
    return d.where("reason IS NOT NULL")


# --- restarts ---


def _checkpoints(spark, sf):
    c = norm_names(table(spark, sf, "stream_checkpoint")).where(f"hour_start_ms * 1000000 < {RESTART_NS} AND last_received_at IS NOT NULL AND last_collector_session_id IS NOT NULL")
    return state.latest_by(c.select(*KEYS, "hour_start_ms", "updated_at", "last_received_at", "last_collector_session_id"), KEYS, "hour_start_ms", "updated_at").select(*KEYS, "last_received_at", "last_collector_session_id")


def _journal(spark, sf):
    """Sessions as a lifecycle journal: each starts with its first row; every session of a name that ends in an even
    digit also ends, with its last."""
    s = envelopes(spark, sf).where("collector_session_id IS NOT NULL AND received_at IS NOT NULL").groupBy("collector_session_id").agg(F.min("received_at").alias("a"), F.max("received_at").alias("z"))
    end = s.where(F.ascii(F.right("collector_session_id", F.lit(2))) % 2 == 0).select("collector_session_id", (F.col("z") + 1).alias("ts_ns"), F.lit("clean_shutdown").alias("event"))
    return s.select("collector_session_id", F.col("a").alias("ts_ns"), F.lit("start").alias("event")).unionByName(end)


@query
def checkpoint_shutdowns(spark, sf):
    """Whether the session of each stream's last checkpoint was shut down cleanly."""
    return state.clean_shutdowns(_checkpoints(spark, sf), _journal(spark, sf))


@query
def recovery_gap_envelopes(spark, sf):
    """The classified restart gap of each stream, as the writer emits it."""
    e = envelopes(spark, sf).where(f"type = 'data' AND received_at >= {RESTART_NS} AND collector_session_id IS NOT NULL")
    first = e.groupBy(*KEYS).agg(F.min(F.struct("received_at", "row_id", "collector_session_id")).alias("f")).select(*KEYS, "f.received_at", "f.collector_session_id")
    evidence = spark.createDataFrame([("b1", "b1", False, ["writer"])], "previous_boot string, current_boot string, system_clean boolean, died array<string>").select("*", F.lit(None).alias("collector_clean"))
    g = gaps.recovery_gaps(first, state.clean_shutdowns(_checkpoints(spark, sf), _journal(spark, sf)), evidence.where("previous_boot = 'b1'"))
    out = gaps.gap_envelopes(g, F.col("collector_session_id"), F.lit(RESTART_NS))
    return out.select(*KEYS, "type", "received_at", "collector_session_id", "session_seq", "_offset", "gap_start_ts", "gap_end_ts", "reason", "component", "cause", "planned", F.array_join("evidence", "|").alias("evidence"))


@query
def component_states(spark, sf):
    """Events of users as those of components: a signup registers, a purchase shuts down, all others are heartbeats."""
    e = table(spark, sf, "events").withColumn("at_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    kind = F.when(F.col("event_type") == "signup", "register").when(F.col("event_type") == "purchase", "shutdown").otherwise("heartbeat")
    e = e.select(F.lit("collector").alias("component"), F.col("user_id").alias("instance_id"), kind.alias("event"), "at_ms", F.lit("boot").alias("host_boot_id"), F.lit(True).alias("planned"), F.lit(None).cast("string").alias("maintenance_id"))
    return state.component_state(e).drop("planned", "maintenance_id")


# --- emission of gaps ---


def _pending(spark, sf) -> DataFrame:
    """Data rows as a producer's pending messages, numbered against small caps."""
    from tidelake.streaming import pipelines

    d = envelopes(spark, sf).where("type = 'data'").select("row_id", *KEYS).withColumn("block", F.expr("row_id div 10000"))
    return pipelines.within_caps(d, KEYS, ["row_id"], "block", CAPS)


@query
def producer_caps(spark, sf):
    """Rows of each stream that a buffer of its size takes and drops."""
    return _pending(spark, sf).groupBy(*KEYS).agg(F.count_if(~F.col("dropped")).alias("taken"), F.count_if("dropped").alias("dropped"))


@query
def collector_gap_envelopes(spark, sf):
    """The overflow gap of each stream whose buffer was full, as its collector emits it."""
    from tidelake.streaming import pipelines

    g = pipelines.overflow_gaps(_pending(spark, sf), KEYS, "row_id", 10_000)
    out = gaps.gap_envelopes(g, F.lit("c-1"), F.lit(NOW_MS * 1_000_000))
    return out.select(*KEYS, "v", "type", "received_at", "collector_session_id", "session_seq", "gap_start_ts", "gap_end_ts", "reason", "detail")


@query
def writer_gap_envelopes(spark, sf):
    """Gaps that the writer archives: not covered by the other collector, or of a reason that goes past the filter."""
    e = _sourced(spark, sf)
    g = e.where("type = 'gap'").select(F.col("row_id").alias("gap_no"), *KEYS, F.coalesce("source", F.lit("primary")).alias("source"), norm("reason").alias("reason"), "gap_start_ts", "received_at")
    d = e.where("type = 'data' AND source IS NOT NULL").select(*KEYS, "source", "received_at")
    return gaps.writer_gaps(g, d, F.col("reason") == "collector_restart").select("gap_no", *KEYS, "reason")


@query
def depth_resync(spark, sf):
    """How each book that broke across sources gets in sync again; every row but a failed delivery is a good probe."""
    from tidelake.operators import continuity

    e = _sourced(spark, sf)
    breaks = continuity.cross_source_breaks(e).select("exchange", "symbol", F.col("received_at").alias("broken_at"))
    probes = e.where("received_at IS NOT NULL").select(F.col("received_at").alias("at"), F.coalesce(norm("reason") != "kafka_delivery_failed", F.lit(True)).alias("good"))
    rows = e.where("type = 'data'")
    backup = rows.where("stream = 'depth' AND source = 'backup'").select("exchange", "symbol", "received_at", json_long("raw_text", "$.u").alias("last_u"))
    snaps = rows.where("stream = 'depth_snapshot'").select("exchange", "symbol", "received_at", json_long("raw_text", "$.lastUpdateId").alias("lid"))
    return depth.resync_points(breaks, probes, backup, snaps)


# --- fetching ---


@query
def backfill_outcomes(spark, sf):
    """Missing hours put to a source that has every third, has lost every third and is down for the others."""

    def provider(exchange: str, symbol: str, stream: str, start_ms: int, end_ms: int) -> list[str]:
        turn = start_ms // 3_600_000 % 3
        if turn == 1:
            raise backfill.Unavailable("gone")
        if turn == 2:
            raise OSError("down")
        key = {"trades": "T", "funding_rate": "fundingTime", "open_interest": "timestamp"}[stream]
        return [json.dumps({key: start_ms + i, "i": i}) for i in (0, 5, 3_600_000)]

    gone = gaps.missing_hours(listing(spark, sf), listed_until(spark, sf))
    pages = write_cut(backfill.fetch_pages(gaps.backfillable(gone), provider, tries=2, first_s=0.0), "pages", spark)
    e = backfill.backfill_envelopes(pages.where("error IS NULL AND raw_text IS NOT NULL"), RESTART_NS, "b")
    got = e.groupBy("stream").agg(F.count("*").alias("records"))
    asked = pages.groupBy("stream").agg(F.count_distinct(F.when(F.col("error").isNull(), F.struct(*KEYS, "hour_start_ms"))).alias("written"), F.count_if("unavailable").alias("unavailable"), F.count_if(F.expr("error IS NOT NULL AND NOT unavailable")).alias("failed"))
    return asked.join(got, "stream", "left").na.fill(0)


@query
def snapshot_polls(spark, sf):
    """One poll of open interest and depth snapshots for every symbol; those of an x in their name give none."""

    def provider(exchange: str, symbol: str, stream: str) -> str:
        if "x" in symbol:
            raise OSError("no answer")
        return json.dumps({"time": len(symbol), "symbol": symbol} if stream == "open_interest" else {"lastUpdateId": len(symbol)})

    s = envelopes(spark, sf).select("exchange", "symbol").distinct().select("*", F.explode(F.array(F.lit("open_interest"), F.lit("depth_snapshot"))).alias("stream"))
    d = backfill.poll(s, provider, RESTART_NS, "c-1", "no answer after 2 tries", tries=2, first_s=0.0)
    return d.select(*KEYS, "type", "exchange_ts", "raw_sha256", "gap_start_ts", "reason", "detail")


@query
def kline_closes(spark, sf):
    """The marks of each minute, put into pages of candles by hour and read out again."""
    e = envelopes(spark, sf).where("type = 'data' AND stream = 'funding_rate' AND exchange_ts IS NOT NULL")
    p = F.get_json_object("raw_text", "$.p").try_cast("double")
    m = e.where(p.isNotNull()).groupBy("exchange", "symbol", (F.expr("exchange_ts div 60000") * 60_000).alias("t")).agg(F.max(p).alias("p"))
    c = F.array(F.col("t").cast("string"), *(F.lit("0") for _ in range(3)), F.col("p").cast("string"))
    pages = m.groupBy("exchange", "symbol", F.expr("t div 3600000").alias("hour")).agg(F.to_json(F.collect_list(c)).alias("page"))
    return backfill.kline_closes(pages, "page", "mark").select("exchange", "symbol", "t", "mark")


@query
def frame_routing_all(spark, sf):
    """Archived payloads of every routed stream in combined frames and out again; liquidations come in the frame of all
    symbols, take the payload's symbol and pass if that is subscribed. Every tenth frame has another key before."""
    from tidelake.functions import frames

    e = envelopes(spark, sf).where(F.col("raw_text").isNotNull() & (F.col("type") == "data") & F.col("stream").isin(*frames.STREAM_KEYS.values()))
    back = F.create_map(*(x for k, v in frames.STREAM_KEYS.items() for x in (F.lit(v), F.lit(k))))[F.col("stream")]
    key = F.when(F.col("stream") == "liquidations", "!forceOrder@arr").otherwise(F.concat("symbol", F.lit("@"), back))
    frame = F.concat(F.when(F.col("row_id") % 10 == 0, '{"id":1,"stream":"').otherwise('{"stream":"'), key, F.lit('","data":'), "raw_text", F.lit("}"))
    d = frames.route_frames(e.select(F.col("raw_text").alias("before"), F.col("stream").alias("told"), frame.alias("frame")), "frame", e.select("symbol"))
    return d.groupBy("stream").agg(F.count("*").alias("n"), F.count_if((F.col("before") == F.col("raw_text")) & (F.col("told") == F.col("stream"))).alias("n_same"))


# --- histograms ---


@query
def flush_histogram(spark, sf):
    """How long each flush took to come in, by exchange."""
    b = envelopes(spark, sf).where("batch_id IS NOT NULL").groupBy("exchange", "batch_id").agg(F.expr("(max(received_at) - min(received_at)) div 1000000").alias("ms"))
    return metrics.histogram(b, ["exchange"], "ms", metrics.FLUSH_BUCKETS)


@query
def failover_histogram(spark, sf):
    """How long each failover of ten minutes' silence lasted, by stream."""
    f = _failovers(spark, sf, 600_000_000_000, 1_200_000_000_000).where("active_to IS NOT NULL")
    return metrics.histogram(f.withColumn("s", F.expr("(active_to - active_from) div 1000000000")), ["stream"], "s", metrics.FAILOVER_BUCKETS)


# --- the archive's files ---

_BASES: dict[tuple[str, str], str] = {}


def _archive(spark, sf, fresh: bool = False) -> str:
    """A folder with every archived file as it would lie there: its envelopes in order of storing. Written once for
    the queries that only read."""
    key = (spark.sparkContext.applicationId, sf)
    if fresh or key not in _BASES:
        e = table(spark, sf, "envelopes").where("file_path IS NOT NULL")
        base = scratch(spark, "lake")
        rows = e.select("file_path", "row_id", F.to_json(F.struct(*e.columns)).alias("line"))
        write_cut(sink.write_json_lines(rows, "", ["row_id"], base=f"{base}/", line="line"), "files", spark)
        if fresh:
            return base
        _BASES[key] = base
    return _BASES[key]


def _lines(spark, sf) -> DataFrame:
    files = archive.numbered(archive.list_files(spark, _archive(spark, sf)).select("file_path", "size_bytes"))
    return archive.read_strict(spark, files)


@query
def archive_scan(spark, sf):
    """Data files of a date by stream and kind, from a listing of that date's folders."""
    at = archive.folders(f"{_archive(spark, sf)}/archive", [ARCHIVED_DATE])
    return archive.scan(archive.list_files(spark, at), ARCHIVED_DATE).groupBy(*DAY, "kind").agg(F.count("*").alias("n"))


@query
def archive_lines(spark, sf):
    """Every line of every file, strictly read: how many by stream-day, and the sum of their numbers."""
    d = _lines(spark, sf).withColumns(path_columns("file_path"))
    r = F.get_json_object("line", "$.row_id").cast("long")
    return d.groupBy(*DAY).agg(F.count("line").alias("n"), F.count("error").alias("n_torn"), F.sum(r).alias("row_sum"))


@query
def archive_tolerant(spark, sf):
    """The same files by the built-in reader."""
    d = archive.read_envelopes(spark, _archive(spark, sf))
    return d.groupBy("type").agg(F.count("*").alias("n"), F.sum(F.col("received_at").cast("decimal(38,0)")).cast("string").alias("received_sum"))


@query
def archive_sidecars(spark, sf):
    """Files by kind and state of their checksum, after the base files got one."""
    base = _archive(spark, sf)
    files = write_cut(archive.list_files(spark, base), "listing", spark)
    sink.on_paths(files.where("kind = 'base'"), "file_path", sink.repair_sidecar).agg(F.count("done")).collect()
    return archive.check_sidecars(spark, files).withColumns(path_columns("file_path")).groupBy("kind", "status").agg(F.count("*").alias("n"))


@query
def archive_torn(spark, sf):
    """Frames of each file and whether its tail is torn."""
    t = archive.torn_files(spark, archive.list_files(spark, _archive(spark, sf))).withColumns(path_columns("file_path"))
    return t.groupBy(*DAY).agg(F.count("*").alias("files"), F.sum("frames").alias("frames"), F.count_if(F.expr("good_bytes < size_bytes")).alias("torn"))


@query
def last_data_envelopes(spark, sf):
    """The last data line of each file."""
    d = archive.last_data_envelope(_lines(spark, sf))
    at = F.expr("substring(file_path, instr(file_path, '/archive/') + 1)")
    return d.select(at.alias("file_path"), F.get_json_object("line", "$.row_id").cast("long").alias("row_id"))


@query
def consolidated_days(spark, sf):
    """A date's stream-days consolidated on real files: counts of the daily files after they were read back."""
    from tidelake.api import Lake

    base = _archive(spark, sf, fresh=True)
    done = Lake(spark, f"{base}/archive", NOW_MS).consolidate(ARCHIVED_DATE)
    rows = [(r["exchange"], r["symbol"], r["stream"], r["utc_date"], r["success"], r.get("total_records"), r.get("data_records"), r.get("gap_records"), len(r.get("missing_hours") or ()), r.get("source_files_count")) for r in done]
    remove_path(spark, base)
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in DAY) + ", success boolean, total_records bigint, data_records bigint, gap_records bigint, n_missing int, source_files_count bigint")
