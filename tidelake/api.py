"""The lake as one object: verification, audits, consolidation and backfill over an archive folder.

Everything heavy is a DataFrame job; only listings of result files, manifests (one for each stream-day of a date)
and counts come to the driver.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES, path_columns
from tidelake.functions.timeutil import DAY_MS, HOUR_MS, dates_in_scope, period
from tidelake.operators import backfill, consolidate, continuity, depth, gaps, integrity, reconcile, state
from tidelake.runtime import drop_cut, path_exists, spread, write_cut
from tidelake.sources import archive, sink

KEYS = list(NAMES)
DAY = [*KEYS, "utc_date"]
STAGED = ".staged"
FAN_LIMIT = 10_000
CHECKS = ("trades", "depth", "bookticker")


class Lake:
    """base: folder or URI of the archive tree. now_ms stands for the present wherever one is needed."""

    def __init__(self, spark: SparkSession, base: str, now_ms: int | None = None):
        import time

        self.spark = spark
        self.base = base.rstrip("/")
        self.now_ms = int(time.time() * 1000) if now_ms is None else now_ms

    # --- reading ---

    def files(self, date: str | list[str] | None = None, exchange: str | list[str] | None = None, symbol: str | list[str] | None = None, stream: str | list[str] | None = None, daily: bool = True) -> DataFrame:
        """Data files by name (each a value, several, or None for any). Dates and names are part of the listed paths, so
        only their folders are listed; nothing is opened."""
        names = (exchange, symbol, stream)
        at = self.base if date is None and not any(names) else archive.folders(self.base, [date] if isinstance(date, str) else date, *names)
        return archive.scan(archive.list_files(self.spark, at), date, *names, daily)

    def rows(self, files: DataFrame) -> DataFrame:
        """Strictly read lines of the files with envelope columns, names by path, error where a line or tail is bad.

        row_id rises with path and line: the file's number and the line's, so rows aren't sorted.
        """
        lines = archive.read_strict(self.spark, archive.numbered(files.select("file_path", "size_bytes")))
        p = path_columns("file_path")
        d = archive.parse_lines(lines).drop(*NAMES)
        return d.withColumns({c: p[c] for c in (*DAY, "file", "kind", "hour_no", "seq")})

    # --- verification ---

    def verify(self, date: str, exchange: str | None = None, symbol: str | None = None, stream: str | None = None, full: bool = False, repair_checksums: bool = False) -> tuple[DataFrame, DataFrame]:
        """(errors, gaps) of a date. errors: check_no, file_path, line_no, message; gaps: the archived ones."""
        files = self.files(date, exchange, symbol, stream)
        side = archive.check_sidecars(self.spark, files)
        if repair_checksums:
            sink.on_paths(side.where("status = 'missing'"), "file_path", sink.repair_sidecar).agg(F.count("error")).collect()
            side = archive.check_sidecars(self.spark, files)
        rows = write_cut(self.rows(files), "verify", self.spark)
        say = lambda no, df, text, line="line_no": df.select(F.lit(no).alias("check_no"), "file_path", (F.col(line) if line else F.lit(None)).cast("long").alias("line_no"), text.alias("message"))
        miss = integrity.missing_fields_json("line")
        whole = rows.where("line IS NOT NULL").withColumn("missing", miss)
        parts = [
            say(1, side.where("status <> 'ok'"), F.when(F.col("status") == "missing", F.concat(F.lit("Sidecar not found: "), "file_path", F.lit(".sha256"))).otherwise(F.concat(F.lit("Checksum mismatch for "), F.substring_index("file_path", "/", -1))), None),
            say(2, rows.where("error IS NOT NULL"), F.col("error")),
            say(3, whole.where(F.size("missing") > 0), F.concat(F.lit("Line "), "line_no", F.lit(": missing fields: "), integrity.listed(F.col("missing")))),
            say(4, integrity.hash_mismatches(whole.where(F.size("missing") == 0)), F.concat(F.lit("Line "), "line_no", F.lit(": raw_sha256 mismatch at offset "), "_offset")),
        ]
        where = rows.select("row_id", "file_path", "line_no")

        def at(df: DataFrame) -> DataFrame:
            return df.select("row_id", "message").join(where, "row_id")

        def duplicates(per_file: bool) -> DataFrame:
            d = integrity.duplicate_offsets(rows, per_file)
            none = lambda c: F.coalesce(c, F.lit("None"))
            tell = F.format_string("Duplicate broker record: (%s, %s, %s)", none(F.concat(F.lit("'"), "_topic", F.lit("'"))), none(F.col("_partition").cast("string")), F.col("_offset").cast("string"))
            return at(d.withColumn("message", tell))

        parts.append(say(5, duplicates(True), F.col("message")))
        if full:
            parts.append(say(6, duplicates(False), F.col("message")))
            books = depth.depth_rows(rows)
            parts.append(say(7, at(depth.replay_any(books, ["exchange", "symbol"]).withColumnRenamed("error", "message")), F.col("message")))
            cross = continuity.cross_source_breaks(rows).withColumn("message", F.format_string("cross_source_pu_chain_break: %s expected pu=%d, got pu=%d", "symbol", "expected", "actual"))
            parts.append(say(8, at(cross), F.col("message")))
            beats = rows.where(F.col("type").isin("data", "heartbeat"))
            quiet = continuity.uncovered_silences(beats, rows.where("type = 'gap'")).join(rows.where("type = 'heartbeat'").select(*KEYS).distinct(), KEYS, "left_semi")
            text = F.concat(F.lit("heartbeat_silence_uncovered: "), "symbol", F.lit("/"), "stream", F.lit(" gap_start="), "silent_from", F.lit(" gap_end="), "silent_to", F.lit(" duration_ms="), "duration_ms")
            parts.append(quiet.select(F.lit(9).alias("check_no"), F.lit(None).cast("string").alias("file_path"), F.lit(None).cast("long").alias("line_no"), text.alias("message")))
        errors = parts[0]
        for p in parts[1:]:
            errors = errors.unionByName(p)
        return errors, rows.where("type = 'gap'").select(*KEYS, "gap_start_ts", "gap_end_ts", "reason", "detail")

    def check(self, stream: str, date: str, exchange: str | None = None, symbol: str | None = None) -> DataFrame:
        """Breaks of trades, depth or bookticker over all files of a day in name order."""
        if stream not in CHECKS:
            raise ValueError(f"no continuity check for {stream!r}")
        f = dict(zip(CHECKS, (continuity.trade_breaks, continuity.depth_breaks, continuity.bookticker_breaks)))[stream]
        d = f(self.rows(self.files(date, exchange, symbol, stream)), DAY, "file", ["line_no"], ["received_at"])
        return d.select(*DAY, "file", "line_no", "field", "expected", "actual", "missing", "received_at")

    def manifest(self, date: str) -> DataFrame:
        """Per exchange, symbol and stream of a date: hours, record_count, gaps."""
        return consolidate.date_manifest(self.rows(self.files(date, daily=False)).where("error IS NULL"))

    # --- gaps and audits ---

    def missing_hours(self, date: str | None = None, **names: str) -> DataFrame:
        return gaps.missing_hours(self.files(date, **names), self.now_ms)

    def backfillable(self, date: str | None = None, **names: str) -> DataFrame:
        return gaps.backfillable(self.missing_hours(date, **names))

    def backfill(self, provider: Callable[[str, str, str, int, int], Iterable[str]], date: str | list[str] | None = None, **names: str) -> DataFrame:
        """The written files of backfill_hours."""
        return self.backfill_hours(provider, date, **names).where("target IS NOT NULL")

    def backfill_hours(self, provider: Callable[[str, str, str, int, int], Iterable[str]], date: str | list[str] | None = None, **names: str) -> DataFrame:
        """Fetches missing hours and writes hour-H.backfill-1 files with sidecars; one row for each missing hour:
        names, utc_date, hour_no, status (backfilled, empty, unavailable, failed, not_backfillable), records, target,
        error. Hours for which nothing comes stay missing; none of the records lies outside its hour."""
        gone = self.missing_hours(date, **names)
        todo = write_cut(gaps.backfillable(gone), "todo", self.spark)
        pages = write_cut(backfill.fetch_pages(todo, provider), "pages", self.spark)
        e = backfill.backfill_envelopes(pages.where("error IS NULL AND raw_text IS NOT NULL"), self.now_ms * 1_000_000, f"backfill_{self.now_ms}")
        hour = F.floor(F.col("exchange_ts") / HOUR_MS).cast("long")
        day = F.date_format(F.timestamp_millis("exchange_ts"), "yyyy-MM-dd")
        target = F.concat_ws("/", *KEYS, day, F.concat(F.lit("hour-"), (hour % 24).cast("string"), F.lit(".backfill-1.jsonl.zst")))
        base = f"{self.base}/"
        written = write_cut(sink.write_json_lines(e.withColumn("target", target), "", ["session_seq"], target="target", base=base), "backfill", self.spark)
        sealed = sink.on_paths(written.select("target"), "target", lambda t: sink.write_sidecar(base + t))
        written = written.join(sealed.select("target", F.col("error").alias("seal_error")), "target")
        mine = F.concat_ws("/", *KEYS, "utc_date", F.concat(F.lit("hour-"), "hour_no", F.lit(".backfill-1.jsonl.zst")))
        told = pages.groupBy(*KEYS, F.col("hour_start_ms").alias("start_ms")).agg(F.max("error").alias("error"), F.max("unavailable").alias("unavailable"))
        d = gone.select(*DAY, "hour_no", "start_ms").withColumn("target", mine).join(todo.select(*KEYS, "start_ms", F.lit(True).alias("asked")), [*KEYS, "start_ms"], "left")
        d = d.join(told, [*KEYS, "start_ms"], "left").join(written.select("target", "n_lines", "seal_error"), "target", "left")
        error = F.coalesce("seal_error", "error")
        status = F.when(F.col("asked").isNull(), "not_backfillable").when(F.col("unavailable"), "unavailable").when(error.isNotNull(), "failed").when(F.col("n_lines").isNull(), "empty").otherwise("backfilled")
        out = d.select(*DAY, "hour_no", status.alias("status"), F.coalesce("n_lines", F.lit(0)).alias("records"), F.when(F.col("n_lines").isNotNull(), F.col("target")).alias("target"), error.alias("error"))
        out = write_cut(out, "backfilled", self.spark)
        for used in (todo, pages):
            drop_cut(used)
        return out

    def backfill_cycle(self, provider: Callable[[str, str, str, int, int], Iterable[str]], days: int = 2, **names: str) -> dict:
        """A run over the last days: its summary (see backfill.summary) as a dict."""
        return backfill.summary(self.backfill_hours(provider, dates_in_scope(self.now_ms - days * DAY_MS, self.now_ms), **names)).first().asDict()

    def audit_files(self, start_ms: int, end_ms: int, **names: list[str] | None) -> DataFrame:
        """Gaps that the files show: archived envelopes, missing hours, sequence breaks. Only folders of the scope's
        dates and names are listed and read."""
        files = self.files(dates_in_scope(start_ms, end_ms), **names)
        cols = ["file_path", "line_no", "row_id", "type", *KEYS, "received_at", "raw_text", "gap_start_ts", "gap_end_ts", "reason", "detail", "kind"]
        rows = write_cut(self.rows(files).select(*cols), "audit", self.spark)
        breaks = continuity.all_breaks(rows, [*KEYS, "file_path"], "kind", ["line_no"], [*KEYS, "row_id", "received_at"])
        every = gaps.archived_gaps(rows).unionByName(gaps.missing_hours(files, self.now_ms).select(*gaps.GAP)).unionByName(continuity.sequence_gap_records(breaks).select(*gaps.GAP))
        out = write_cut(gaps.in_scope(every, start_ms, end_ms, **names), "file-gaps", self.spark)
        drop_cut(rows)
        return out

    def audit_state(self, start_ms: int, end_ms: int, components: DataFrame | None = None, intents: DataFrame | None = None, ledger: DataFrame | None = None, outages: DataFrame | None = None, manifests: DataFrame | None = None, strict: bool = False, **names: list[str] | None) -> DataFrame:
        """Gaps that the operational state records, fanned out to the archived streams. Inputs by column: see
        gaps.component_gaps, maintenance_gaps, paired_sessions (collector_session_id, line_no, event, ts in ms),
        outage_gaps (start_ms) and manifest_gaps."""
        streams = self.files(**names).select(*KEYS).distinct()
        cols = ["source", "start_ms", "end_ms", "reason", "detail"]
        wide: list[DataFrame] = []
        if components is not None:
            wide.append(gaps.component_gaps(components, self.now_ms).select(*cols))
        if intents is not None:
            wide.append(gaps.maintenance_gaps(intents, self.now_ms).select(*cols))
        if ledger is not None:
            p = gaps.paired_sessions(ledger, ["collector_session_id"], ["line_no"])
            why = F.when(F.coalesce("planned", F.lit(False)), "collector_restart").otherwise("restart_gap")
            wide.append(p.select(F.lit("ledger").alias("source"), F.col("start_ts").alias("start_ms"), F.col("ts").alias("end_ms"), why.alias("reason"), gaps.described(p, "collector_id", "collector_session_id", "host_boot_id", "maintenance_id").alias("detail")))
        if outages is not None:
            o = gaps.outage_gaps(outages, self.now_ms, end_ms)
            wide.append(o.select(F.lit("kafka_outage").alias("source"), "start_ms", "end_ms", "reason", gaps.described(o, "collector_id", "outage_started_at_ns").alias("detail")))
        out = None
        for w in wide:
            w = _fan(w, streams, strict)
            out = w if out is None else out.unionByName(w)
        if manifests is not None:
            m = gaps.manifest_gaps(manifests).select(*gaps.GAP)
            out = m if out is None else out.unionByName(m)
        if out is None:
            out = self.spark.createDataFrame([], "source string, exchange string, symbol string, stream string, start_ms bigint, end_ms bigint, reason string, detail string")
        return gaps.in_scope(out, start_ms, end_ms, **names)

    def reconcile(self, file_gaps: DataFrame, state_gaps: DataFrame, tolerance_ms: int = reconcile.TOLERANCE_MS) -> dict[str, DataFrame]:
        """explained, unexplained, orphan_state and summary. The audit passes if unexplained is empty."""
        f = write_cut(file_gaps.withColumn("file_id", F.monotonically_increasing_id()), "file-gaps", self.spark)
        s = write_cut(state_gaps.withColumn("state_id", F.monotonically_increasing_id()), "state-gaps", self.spark)
        m = reconcile.chosen(f, s, tolerance_ms)
        return {"explained": f.join(m, "file_id"), "unexplained": reconcile.unexplained(f, m), "orphan_state": reconcile.orphans(s, m), "summary": reconcile.summary(f, s, m)}

    def state_inputs(self, state_dir: str | None = None, data_dir: str | None = None) -> dict[str, DataFrame]:
        """The inputs of audit_state that there are: tables component_runtime_state (events, see state.component_state) and
        maintenance_intent (Parquet) in state_dir, the journals lifecycle.jsonl and kafka_outage.json of each collector
        in data_dir, and the manifests of the archive."""
        found: dict[str, DataFrame] = {}
        for name, key in (("component_runtime_state", "components"), ("maintenance_intent", "intents")):
            if state_dir and path_exists(self.spark, f"{state_dir}/{name}"):
                found[key] = self.spark.read.parquet(f"{state_dir}/{name}")
        if "components" in found:
            found["components"] = state.component_state(found["components"])
        if data_dir:
            ledger = archive.read_tolerant(self.spark, f"{data_dir}/*/lifecycle.jsonl", archive.LEDGER).where("ts_ns IS NOT NULL")
            found["ledger"] = ledger.withColumns({"ts": F.expr("ts_ns div 1000000"), "line_no": F.col("ts_ns")})
            outages = archive.read_tolerant(self.spark, f"{data_dir}/*/kafka_outage.json", archive.OUTAGE).where("outage_started_at_ns IS NOT NULL")
            found["outages"] = outages.withColumn("start_ms", F.expr("outage_started_at_ns div 1000000"))
        m = archive.manifests(self.spark, self.base).withColumnRenamed("date", "utc_date").where("missing_hours IS NOT NULL")
        found["manifests"] = m
        return found

    def audit(self, start_ms: int, end_ms: int, state_dir: str | None = None, data_dir: str | None = None, strict: bool = False, report: str | None = None, **names: list[str] | None) -> dict[str, DataFrame]:
        """reconcile over a scope; with report (a folder) what is unexplained or orphaned is written there as JSON lines."""
        out = self.reconcile(self.audit_files(start_ms, end_ms, **names), self.audit_state(start_ms, end_ms, strict=strict, **self.state_inputs(state_dir, data_dir), **names))
        if report:
            say = lambda df, what: df.select(F.lit(what).alias("divergence"), *gaps.GAP)
            say(out["unexplained"], "unexplained").unionByName(say(out["orphan_state"], "orphan_state")).write.mode("overwrite").json(report)
        return out

    def audit_backfill(self, provider: Callable[[str, str, str, int, int], Iterable[str]], start_ms: int, end_ms: int, **options) -> tuple[dict, dict[str, DataFrame]]:
        """Fetches the scope's missing hours, then audits what is left: (summary of the backfill, audit)."""
        names = {k: options.get(k) for k in NAMES}
        done = backfill.summary(self.backfill_hours(provider, dates_in_scope(start_ms, end_ms), **names)).first().asDict()
        return done, self.audit(start_ms, end_ms, **options)

    @staticmethod
    def scope(kind: str, value: str | None = None, since: str | None = None, until: str | None = None) -> tuple[int, int]:
        return period(kind, value, since, until)

    # --- consolidation ---

    def stage_days(self, date: str, exchange: str | None = None, symbol: str | None = None, stream: str | None = None) -> tuple[DataFrame, DataFrame]:
        """Merges every stream-day of a date that has no daily file yet into a staged file; (staged, broken).

        Hours 0 to 23 are merged (a single base file as it is), a missing hour becomes a gap row. staged: stream-day,
        target (the daily file to be), what the writer wrote (n_lines, bytes, sha256), the lines of each hour, the
        manifest's figures and source_files. broken: stream-days with a torn source or a line that is no envelope.
        """
        files = self.files(date, exchange, symbol, stream).withColumn("folder", F.regexp_replace("file_path", "/[^/]*$", ""))
        sealed = files.where("kind = 'daily' AND size_bytes > 0").select(*DAY).distinct()
        files = write_cut(files.where("kind <> 'daily'").join(sealed, DAY, "left_anti"), "sources", self.spark)
        rows = self.rows(files)
        broken = write_cut(rows.where("error IS NOT NULL").select(*DAY).distinct(), "broken", self.spark)
        good = files.join(broken, DAY, "left_anti")
        rows = rows.join(broken, DAY, "left_anti")

        rank = F.when(F.col("kind") == "base", 0).when(F.col("kind") == "late", 1).otherwise(2)
        rows = rows.withColumns({"rank": rank, "seq": F.coalesce("seq", F.lit(0))})
        single = good.groupBy(*consolidate.HOUR).agg(F.count("*").alias("n"), F.max("kind").alias("k")).where("n = 1 AND k = 'base'")
        merged = consolidate.merge_hours(rows, ["rank", "seq", "file_path", "line_no"], single)
        missing = gaps.missing_hours(good, None)
        lost = gaps.missing_hour_envelopes(missing).withColumns({"received_at": F.lit(self.now_ms).cast("long") * 1_000_000, "collector_session_id": F.lit(f"consolidation-{self.now_ms}"), "_topic": F.lit(""), "_partition": F.lit(0)})
        lost = lost.withColumns({"line": F.to_json(F.struct(*lost.columns)), "hour_no": F.call_function("div", F.pmod(F.col("gap_start_ts"), F.lit(24 * HOUR_MS * 1_000_000)), F.lit(HOUR_MS * 1_000_000)).cast("int"), "utc_date": F.date_format(F.timestamp_seconds(F.expr("gap_start_ts div 1000000000")), "yyyy-MM-dd"), "pos": F.lit(1)})
        both = merged.select(*DAY, "hour_no", "pos", "line", "type").unionByName(lost.select(*DAY, "hour_no", "pos", "line", "type"))
        folder = good.groupBy(*DAY).agg(F.min("folder").alias("folder"))
        both = write_cut(both.join(folder, DAY).withColumn("target", F.concat("folder", F.lit("/"), "utc_date", F.lit(".jsonl.zst"), F.lit(STAGED))), "merged", self.spark)

        written = write_cut(sink.write_json_lines(both, "", ["hour_no", "pos"], target="target", line="line"), "written", self.spark)
        counts = consolidate.hour_counts(both, [*DAY, "hour_no"])
        as_is = single.select(*consolidate.HOUR, F.lit(True).alias("as_is"))
        hours = counts.join(as_is, consolidate.HOUR, "left").groupBy(*DAY).agg(F.sort_array(F.collect_list(F.struct("hour_no", "total_records", F.coalesce("as_is", F.lit(False)).alias("as_is")))).alias("hour_lines"))
        st = gaps.hour_status(good).select(*DAY, "hour_no", "status", F.array_sort(F.concat(F.array_compact(F.array("base")), "late", "backfill")).alias("sources"))
        man = consolidate.day_manifest(st.join(counts, [*DAY, "hour_no"]), missing)
        staged = written.join(both.select("target", *DAY).distinct(), "target").join(man, DAY).join(hours, DAY)
        staged = write_cut(staged.withColumn("target", F.regexp_replace("target", f"{STAGED}$", "")), "staged", self.spark)
        for used in (files, both, written):
            drop_cut(used)
        return staged, broken

    def seal_days(self, staged: DataFrame, keep_sources: bool = False) -> list[dict]:
        """Checks each staged file where it lies, reading it back piece by piece: checksum as written, number of lines,
        and data keys that don't fall within an hour that was merged. One that passes is published under its name with
        sidecar and manifest, and then its sources are deleted; one that doesn't is removed, and nothing else changes.
        All of it runs on the executors, a day in a task; one result for each."""
        now, keep = self.now_ms, keep_sources
        cols = [*DAY, "target", "n_lines", "sha256", "hour_lines", "total_records", "data_records", "gap_records", "missing_hours", "source_files", "hours"]

        def run(frames):
            for f in frames:
                out = []
                for r in f.to_dict("records"):
                    day = json.loads(r["day"])
                    day["error"] = sink.seal_staged(day, STAGED, now, keep)
                    out.append((day["target"], day["error"]))
                yield pd.DataFrame(out, columns=["target", "error"])

        day = spread(staged.select("target", F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("day")), "target")
        done = write_cut(day.mapInPandas(run, "target string, error string"), "sealed", self.spark)
        return [r.asDict(True) | {"date": r.utc_date, "success": r.error is None, "source_files": [os.path.basename(p) for p in r.source_files], "source_files_count": len(r.source_files)} for r in staged.drop("hour_lines", "bytes").join(done, "target").collect()]

    def consolidate(self, date: str, exchange: str | None = None, symbol: str | None = None, stream: str | None = None, keep_sources: bool = False) -> list[dict]:
        """Consolidates every stream-day of a date into its daily file; one result for each.

        A stream-day with a daily file is left alone. The daily file appears whole, checked and with its sidecar and
        manifest, or not at all (see stage_days and seal_days); only then its sources are deleted. A run that is cut
        short leaves the sources and is simply run again.
        """
        staged, broken = self.stage_days(date, exchange, symbol, stream)
        out = self.seal_days(staged, keep_sources)
        return out + [r.asDict() | {"success": False, "error": "a source file is torn or has a line that is no envelope"} for r in broken.collect()]

    def consolidation_cycle(self, keep_sources: bool = False) -> dict:
        """The daily run: consolidates yesterday (UTC) and gives its totals."""
        date = dates_in_scope(self.now_ms - DAY_MS, self.now_ms - DAY_MS)[0]
        done = self.consolidate(date, keep_sources=keep_sources)
        return {"date": date, "streams": len(done), "records": sum(r.get("total_records") or 0 for r in done), "missing_hours": sum(len(r.get("missing_hours") or ()) for r in done), "any_failed": not all(r["success"] for r in done)}

    # --- maintenance ---

    def mark_maintenance(self, maintenance_id: str, scope: str, planned_by: str, reason: str, ttl_minutes: int = 60, state_dir: str | None = None) -> DataFrame:
        """The intent as one row; with state_dir it is added to the table maintenance_intent there."""
        row = (maintenance_id, scope, planned_by, reason, self.now_ms, self.now_ms + ttl_minutes * 60_000, None)
        out = self.spark.createDataFrame([row], "maintenance_id string, scope string, planned_by string, reason string, created_ms bigint, expires_ms bigint, consumed_ms bigint")
        if state_dir:
            out.write.mode("append").parquet(f"{state_dir}/maintenance_intent")
        return out

    def component_event(self, state_dir: str, component: str, instance_id: str, event: str, host_boot_id: str | None = None, planned: bool | None = None, maintenance_id: str | None = None) -> None:
        """Adds a register, heartbeat or shutdown of a component to the table component_runtime_state."""
        if event not in ("register", "heartbeat", "shutdown"):
            raise ValueError(f"unknown event: {event!r}")
        row = (component, instance_id, event, self.now_ms, host_boot_id, planned, maintenance_id)
        kinds = "component string, instance_id string, event string, at_ms bigint, host_boot_id string, planned boolean, maintenance_id string"
        self.spark.createDataFrame([row], kinds).coalesce(1).write.mode("append").parquet(f"{state_dir}/component_runtime_state")

    def torn_tails(self) -> DataFrame:
        return archive.torn_files(self.spark, self.base).where("good_bytes < size_bytes")

    def repair_tails(self) -> int:
        """Cuts torn files back to their whole frames, on the executors; how many."""
        done = sink.on_paths(self.torn_tails(), "file_path", sink.repair_tail).agg(F.count("done"), F.first("error", True)).first()
        if done[1]:
            raise OSError(done[1])
        return done[0]

    def against_state(self, file_state: DataFrame) -> DataFrame:
        """Files against the writer's state (sealed, uncommitted, oversized, short, missing_file, open)."""
        side = archive.check_sidecars(self.spark, self.base).select("file_path", (F.col("status") != "missing").alias("has_sidecar"))
        return state.files_against_state(self.files().select("file_path", "size_bytes").join(side, "file_path"), file_state)


def _fan(w: DataFrame, streams: DataFrame, strict: bool) -> DataFrame:
    """Every archived stream for every state gap (they concern the whole lake). The result is as large as asked for; the
    gaps, a few for each component, are sent to the streams if they are fewer than FAN_LIMIT, else each of 64 groups of
    gaps meets the streams in a task of its own."""
    few = w.limit(FAN_LIMIT + 1).count() <= FAN_LIMIT
    if few:
        one = F.lit(1).alias("one")
        d = gaps.fan_out(F.broadcast(w.select("*", one)), streams.select("*", one), ["one"]) if not strict else gaps.fan_out(w.select("*", one), F.broadcast(streams.select("*", one)), ["one"], True)
        return d.select(*gaps.GAP)
    g = F.pmod(F.xxhash64(*w.columns), F.lit(64)).alias("g")
    return gaps.fan_out(w.select("*", g), streams.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long")))), ["g"], strict).select(*gaps.GAP)
