"""Queries of the general problems 1 to 5 over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES, norm_names, path_columns
from tidelake.functions.timeutil import DAY_MS, HOUR_MS, floor_div, ns_to_ms
from tidelake.operators import compact, diff, late_counts
from tidelake.operators.intervals import covered_and_gaps
from tidelake.runtime import drop_cut, remove_path, scratch, table, write_cut
from tidelake.sources import archive, sink
from tidelake.streaming import exactly_once

KEYS = list(NAMES)
BROKER = ["_topic", "_partition", "_offset"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = norm_names(table(spark, sf_dir, "gap_records").select(*NAMES, "start_ms", "end_ms"))
    return covered_and_gaps(rows, KEYS, "start_ms", "end_ms", max_gap=DAY_MS)


def _p2_cells(spark: SparkSession, sf_dir: str, one_identity: bool = False) -> DataFrame:
    """Counters by session, else by broker, else by row. one_identity: rows without session fields take the session
    that another copy of theirs (equal broker coordinates in the stream) has kept."""
    data = norm_names(table(spark, sf_dir, "envelopes").where("type = 'data'"))
    by_session = F.col("collector_session_id").isNotNull() & (F.col("session_seq") >= 0)
    by_broker = F.col("_topic").isNotNull() & F.col("_partition").isNotNull() & (F.col("_offset") >= 0)
    e = data.where("exchange_ts IS NOT NULL").select(*NAMES, "exchange_ts", "received_at", "collector_session_id", "session_seq", *BROKER, "row_id")
    if one_identity:
        e = late_counts.with_known_session(e, data, KEYS, BROKER, by_session, by_broker)
    source = F.when(by_session, F.concat(F.lit("s:"), "collector_session_id")).when(by_broker, F.concat(F.lit("b:"), "_topic", F.lit(":"), "_partition")).otherwise("r")
    version = F.when(by_session, F.col("session_seq")).when(by_broker, F.col("_offset")).otherwise(F.col("row_id"))
    e = e.select(*NAMES, "exchange_ts", "received_at", source.alias("source"), version.alias("version"), (floor_div("exchange_ts", HOUR_MS) * HOUR_MS).alias("hour_start_ms"))
    e = e.withColumn("salt", F.pmod(floor_div("version", 64), F.lit(16)).cast("int"))
    marks = norm_names(table(spark, sf_dir, "stream_checkpoint").select(*NAMES, "hour_start_ms", "last_received_at"))
    e = late_counts.attach_checkpoints(e, marks, KEYS, "hour_start_ms", "last_received_at", "salt")
    return late_counts.counter_cells(e, KEYS, F.col("exchange_ts"), F.col("received_at"), F.col("last_received_at"), F.col("source"), F.col("version"), HOUR_MS, 6 * HOUR_MS)


def p2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures per stream and hour: on time, corrected by late envelopes, cut off, and the corrected total."""
    c = late_counts.period_counts(_p2_cells(spark, sf_dir, one_identity=True), KEYS)
    return c.select(*KEYS, F.col("period_ms").alias("hour_start_ms"), "n_on_time", "n_corrected", "n_cut_off", "n_final")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = late_counts.period_counts(_p2_cells(spark, sf_dir), KEYS)
    kinds = F.array_compact(F.array(F.when(F.col("has_corrected"), "corrected"), F.when(F.col("has_cut_off"), "cut_off")))
    return c.select(*KEYS, F.col("period_ms").alias("hour_start_ms"), F.explode(kinds).alias("outcome"))


def _p3_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = compact.latest_listing(table(spark, sf_dir, "archive_files"))
    return files.withColumns(path_columns("file_path"))


def p3_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target file and place in it of every small file."""
    return compact.plan(_p3_listing(spark, sf_dir)).select("file_path", "target_path", "source_no", "size_bytes", "target_offset")


def _p3_joined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """(joined targets with their members, written; the folder they lie in): the plan carried out on real bytes. Each
    planned file is written with its envelopes as one compressed file (a file of which the table has no rows as an
    empty frame), and the files are joined byte by byte; every member's bytes are checked at their place."""
    files = compact.plan(_p3_listing(spark, sf_dir)).select("file_path", "target_path", "source_no")
    e = table(spark, sf_dir, "envelopes")
    e = e.select(F.col("file_path").alias("of"), "row_id", F.to_json(F.struct(*e.columns)).alias("line"))
    rows = files.join(e, files.file_path == e.of, "left").select("file_path", "row_id", "line")
    base = scratch(spark, "archive") + "/"
    small = write_cut(sink.write_json_lines(rows, base, ["row_id"], base=base, line="line"), "small", spark)
    todo = files.join(small.select(F.col("target").alias("file_path"), F.col("bytes").alias("size_bytes")), "file_path")
    joined = write_cut(sink.join_planned(todo, base), "joined", spark)
    drop_cut(small)
    return joined, base


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that were taken, as members of the joined files: found at their offset with their own checksum."""
    joined, base = _p3_joined(spark, sf_dir)
    remove_path(spark, base.rstrip("/"))
    members = joined.where("error IS NULL").select(F.explode("members").alias("m")).select("m.*")
    return members.where("bytes > 0 AND sha256 IS NOT NULL AND target_offset >= 0").select("file_path")


def p3_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the joined files hold when they are read back: files, lines, and a sum of checksums of all records (their
    number and payload), which a lost, doubled or altered record would change."""
    joined, base = _p3_joined(spark, sf_dir)
    lines = archive.read_strict(spark, joined.where("error IS NULL").select(F.concat(F.lit(base), "target_path").alias("file_path"), F.col("bytes").alias("size_bytes")))
    r = lines.select(F.substring("file_path", len(base) + 1, 2**30).alias("target_path"), "error", F.from_json("line", "row_id bigint, raw_text string").alias("r"))
    sums = r.groupBy("target_path").agg(F.count("r").alias("n_lines"), F.count("error").alias("n_torn"), F.sum(_record_sum(F.col("r.row_id"), F.col("r.raw_text"))).cast("string").alias("record_sum"))
    out = joined.select("target_path", "source_files", "error").join(sums, "target_path", "left").na.fill(0, ["n_lines", "n_torn"])
    done = write_cut(out.select("target_path", "source_files", "n_lines", "n_torn", F.coalesce("record_sum", F.lit("0")).alias("record_sum"), "error"), "consolidated", spark)
    drop_cut(joined)
    remove_path(spark, base.rstrip("/"))
    return done


def _record_sum(row_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of a record, as a decimal that doesn't overflow when summed."""
    h = F.md5(F.concat_ws("|", row_id.cast("string"), F.coalesce(text, F.lit(""))).cast("binary"))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(38,0)")


FIELDS = ["exchange", "symbol", "stream", "start_ms", "end_ms", "reason", "detail"]


def p4_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field by field: one row for each difference, with both values."""
    d = diff.diff_copies(table(spark, sf_dir, "gap_records"), table(spark, sf_dir, "gap_state"), "gap_id", "recorded_at", FIELDS, diff.gap_copy_rules())
    return d.select("gap_id", "status", F.explode_outer("differences").alias("d")).select("gap_id", "status", "d.field", "d.left_value", "d.right_value")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = p4_differences(spark, sf_dir)
    what = F.when(F.col("status") == "left_only", "missing_in_state").when(F.col("status") == "right_only", "missing_in_file").otherwise(F.col("field"))
    return d.select("gap_id", what.alias("difference"))


def _p5_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "envelopes").where("type = 'data'").select("row_id", "received_at", *NAMES, "collector_session_id", "session_seq", *BROKER)
    stream, arrivals = exactly_once.as_arrivals(rows, "row_id")
    out = exactly_once.repeated_rows(spark, stream, "row_id", "received_at", exactly_once.envelope_identifiers())
    remove_path(spark, arrivals)
    return out


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p5_repeated(spark, sf_dir).select("row_id")


def p5_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one row of each message that stays."""
    rows = table(spark, sf_dir, "envelopes").where("type = 'data'").select("row_id", "collector_session_id", "session_seq", *BROKER)
    return exactly_once.exactly_once(rows, _p5_repeated(spark, sf_dir), "row_id")


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_counts, p3_found, p3_plan, p3_consolidated, p4_found, p4_differences, p5_found, p5_kept)}
