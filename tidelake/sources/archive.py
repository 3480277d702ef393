"""Readers of the archive tree: listings, JSON lines, journals, state tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.names import path_columns
from tidelake.operators import ordered
from tidelake.runtime import spread
from tidelake.sources.sink import open_read
from tidelake.sources.zstd_files import read_frames, read_lines, sha256_of

#: An archived line: data and gap envelopes in one schema; unknown fields are ignored.
ENVELOPE = (
    "v int, type string, exchange string, symbol string, stream string, received_at bigint, exchange_ts bigint, collector_session_id string, session_seq bigint, "
    "raw_text string, raw_sha256 string, _topic string, _partition int, _offset bigint, gap_start_ts bigint, gap_end_ts bigint, reason string, detail string, "
    "component string, cause string, planned boolean, classifier string, evidence map<string,array<string>>, maintenance_id string, "
    "emitted_at_ns bigint, last_data_at_ns bigint, last_session_seq bigint, status string"
)
LEDGER = "ts_ns bigint, event string, host_boot_id string, collector_session_id string, planned boolean, maintenance_id string"
HOST_EVENTS = "type string, component string, clean_exit boolean, timestamp string, ts string, event_type string"
OUTAGE = "outage_started_at_ns bigint"


LISTED = "file_path string, size_bytes bigint, modified_at timestamp"


def _any_case(name: str | list[str] | None) -> str:
    """A path pattern for a name however it is spelled (case, outer blanks); what else it lets in is filtered later."""
    if not name:
        return "*"
    one = lambda n: "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c if c.isalnum() or c in "-_." else "?" for c in n.strip()) + "*"
    names = [name] if isinstance(name, str) else name
    return one(names[0]) if len(names) == 1 else "{" + ",".join(map(one, names)) + "}"


def folders(base: str, dates: list[str] | None = None, exchange=None, symbol=None, stream=None) -> list[str]:
    """Path patterns of the stream-day folders below base with the given dates and names (a name, several, or None for
    any): what is listed, so a date costs its own folders and not the tree."""
    names = "/".join(map(_any_case, (exchange, symbol, stream)))
    return [f"{base.rstrip('/')}/{names}/*{d}*" for d in dates] if dates else [f"{base.rstrip('/')}/{names}/*"]


def list_files(spark: SparkSession, base: str | list[str], glob: str = "*.jsonl.zst") -> DataFrame:
    """file_path, size_bytes, modified_at and path_columns of every file below base (a folder or patterns, see
    folders), listed by the cluster; no content is read. A pattern that nothing matches gives nothing."""
    found = []
    for at in [base] if isinstance(base, str) else base:
        try:
            d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(at)
            found.append(d.select(F.col("path").alias("file_path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")))
        except Exception as e:
            if isinstance(base, str) or "PATH_NOT_FOUND" not in str(e):
                raise
    d = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], LISTED)
    return d.withColumns(path_columns("file_path"))


def scan(files: DataFrame, date: str | list[str] | None = None, exchange: str | list[str] | None = None, symbol: str | list[str] | None = None, stream: str | list[str] | None = None, daily: bool = True) -> DataFrame:
    """Data files of a listing with the given names (one, several, or None for any)."""
    kinds = ["base", "late", "backfill"] + ["daily"] * daily
    d = files.where(F.col("kind").isin(kinds))
    for c, v in (("utc_date", date), ("exchange", exchange), ("symbol", symbol), ("stream", stream)):
        if v:
            d = d.where(F.col(c).isin([x.strip().lower() for x in ([v] if isinstance(v, str) else v)]))
    return d


def read_envelopes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Envelopes of JSON-lines files (zstandard too) with their file, by the built-in reader. Lines that don't
    parse are dropped; a torn tail goes unnoticed, for which read_strict is there."""
    d = spark.read.schema(ENVELOPE).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").json(paths)
    return d.withColumn("file_path", F.col("_metadata.file_path"))


def _paths(spark: SparkSession, paths: str | list[str] | DataFrame, glob: str = "*") -> DataFrame:
    """file_path and size_bytes, spread over the cluster; a listing is taken as it is."""
    if not isinstance(paths, DataFrame):
        paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(paths).select(F.col("path").alias("file_path"), F.col("length").alias("size_bytes"))
    return spread(paths.select("file_path", "size_bytes", *[c for c in ("file_no",) if c in paths.columns]), "file_path")


def numbered(files: DataFrame) -> DataFrame:
    """files with file_no, their place in the order of paths from 0: counted in each folder and over the folders, so
    only folders meet in one task."""
    d = files.withColumns({"_all": F.lit(1), "_folder": F.regexp_replace("file_path", "/[^/]*$", ""), "_one": F.lit(1).cast("long")})
    d = ordered.running_sum(d, ["_all"], "_folder", ["file_path"], "_one", "file_no")
    return d.select(*files.columns, (F.col("file_no") - 1).alias("file_no"))


def read_strict(spark: SparkSession, paths: str | list[str] | DataFrame, batch: int = 10_000) -> DataFrame:
    """file_path, line_no (from 0), line, error of every non-empty line. A file that ends inside a frame gives the
    lines of its whole frames and one row with the error. A task reads its files one after the other, frame by
    frame; paths is a folder, a list or a listing (file_path, size_bytes). If the listing is numbered (file_no), each
    line has a row_id that rises with file and line, without any sort of lines."""
    listing = _paths(spark, paths, "*.zst")
    has_no = "file_no" in listing.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def part(rows: dict, no: int) -> pd.DataFrame:
            return pd.DataFrame(rows | ({"row_id": [(int(no) << 32) + i for i in rows["line_no"]]} if has_no else {}))

        for f in frames:
            for path, size, no in zip(f["file_path"], f["size_bytes"], f["file_no"] if has_no else f["size_bytes"]):
                n, good = 0, 0
                with open_read(path) as src:
                    for good, content in read_frames(src):
                        lines = [x.decode("utf-8", "replace") for x in content.split(b"\n") if x.strip()]
                        for k in range(0, len(lines), batch):
                            some = lines[k : k + batch]
                            yield part({"file_path": path, "line_no": range(n, n + len(some)), "line": some, "error": None}, no)
                            n += len(some)
                if good < size:
                    yield part({"file_path": [path], "line_no": [n], "line": [None], "error": [f"torn tail after {good} of {size} bytes"]}, no)

    return listing.mapInPandas(run, "file_path string, line_no bigint, line string, error string" + ", row_id bigint" * has_no)


def read_tolerant(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """JSON lines by schema; blank and malformed lines are dropped, missing files give nothing."""
    try:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").option("ignoreMissingFiles", "true").json(paths)
    except Exception as e:  # a path that doesn't exist at all
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Envelope columns of strict lines; a line that doesn't parse gives an error instead."""
    d = lines.withColumn("_e", F.from_json(line, ENVELOPE, {"mode": "PERMISSIVE"}))
    bad = F.col(line).isNotNull() & F.col("_e.type").isNull()
    return d.withColumn("error", F.coalesce("error", F.when(bad, "line is no envelope"))).select("*", "_e.*").drop("_e")


def torn_files(spark: SparkSession, paths: str | list[str] | DataFrame) -> DataFrame:
    """file_path, size_bytes, good_bytes, frames of every compressed file, read frame by frame."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, size in zip(f["file_path"], f["size_bytes"]):
                good = n = 0
                with open_read(path) as src:
                    for good, _ in read_frames(src):
                        n += 1
                rows.append((path, size, good, n))
            yield pd.DataFrame(rows, columns=["file_path", "size_bytes", "good_bytes", "frames"])

    return _paths(spark, paths, "*.zst").mapInPandas(run, "file_path string, size_bytes bigint, good_bytes bigint, frames bigint")


def count_lines(paths: DataFrame, path: str = "target_path", base: str = "") -> DataFrame:
    """paths with n_lines and frames of each file, decompressed piece by piece in the task that has its path; error
    instead where a file is torn or gone."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for p in f[path]:
                try:
                    with open_read(base + p) as src:
                        out.append((p, sum(1 for _ in read_lines(src)), None))
                except Exception as e:  # noqa: BLE001 - reported for the file
                    out.append((p, None, str(e)))
            yield pd.DataFrame(out, columns=[path, "n_lines", "error"])

    return spread(paths.select(path), path).mapInPandas(run, f"{path} string, n_lines bigint, error string")


def check_sidecars(spark: SparkSession, paths: str | DataFrame) -> DataFrame:
    """file_path and status (ok, mismatch, missing) of every data file (below a folder, or of a listing) against its
    .sha256 file. Files are hashed piece by piece."""
    d = _paths(spark, paths).where(F.col("file_path").rlike(r"\.(zst|jsonl)$"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for path in f["file_path"]:
                try:
                    with open_read(path + ".sha256") as src:
                        told = src.read().decode("utf-8", "replace").split()
                except OSError:
                    out.append((path, "missing"))
                    continue
                with open_read(path) as src:
                    out.append((path, "ok" if told[:1] == [sha256_of(src)] else "mismatch"))
            yield pd.DataFrame(out, columns=["file_path", "status"])

    return d.mapInPandas(run, "file_path string, status string")


def last_data_envelope(rows: DataFrame) -> DataFrame:
    """Of each file the last data line (file_path, line_no, line in)."""
    d = rows.where(F.col("line").contains('"type":"data"') | (F.get_json_object("line", "$.type") == "data"))
    return d.groupBy("file_path").agg(F.max_by("line", "line_no").alias("line"))


def ledger_since(ledger: DataFrame, since_ns: int) -> DataFrame:
    """The last entry of each session since a time."""
    d = ledger.where((F.col("ts_ns") >= since_ns) & F.col("collector_session_id").isNotNull())
    rest = [c for c in ledger.columns if c != "collector_session_id"]
    return d.groupBy("collector_session_id").agg(F.max_by(F.struct(*rest), "ts_ns").alias("r")).select("collector_session_id", "r.*")


def host_events(events: DataFrame, start: str, end: str) -> DataFrame:
    """Host lifecycle events of [start, end); both spellings of the fields are taken, times without zone are UTC,
    and events without a readable time stay."""
    at = F.coalesce("timestamp", "ts").try_cast("timestamp")
    d = events.select(F.coalesce("type", "event_type").alias("type"), "component", "clean_exit", at.alias("at"))
    return d.where(F.col("at").isNull() | ((F.col("at") >= F.lit(start).cast("timestamp")) & (F.col("at") < F.lit(end).cast("timestamp"))))


def manifests(spark: SparkSession, base: str) -> DataFrame:
    """Consolidation manifests below base (whole JSON documents)."""
    schema = "version int, exchange string, symbol string, stream string, date string, daily_file string, sha256 string, total_records bigint, data_records bigint, gap_records bigint, missing_hours array<int>, source_files array<string>"
    return spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.manifest.json").json(base)


def jdbc_table(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None) -> DataFrame:
    """A state table or query over JDBC; Catalyst pushes filters and columns down. Needs the driver's jar."""
    r = spark.read.format("jdbc").option("url", url)
    r = r.option("query", query) if query.lstrip().lower().startswith("select") else r.option("dbtable", query)
    return r.options(**(properties or {})).load()
