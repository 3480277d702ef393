"""Writers of the archive tree: frames, hour and daily files, joined files, sidecars, manifests, alerts."""

from __future__ import annotations

import json
import os
import tarfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.runtime import spread
from tidelake.sources.zstd_files import compress_frame, join_files, read_frames, read_lines, sha256_of


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[5:]
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path)}")


def open_read(path: str) -> BinaryIO:
    fs, p = _fs(path)
    return fs.open_input_stream(p, compression=None)


def open_seekable(path: str) -> BinaryIO:
    fs, p = _fs(path)
    return fs.open_input_file(p)


def open_write(path: str) -> BinaryIO:
    fs, p = _fs(path)
    fs.create_dir(os.path.dirname(p), recursive=True)
    return fs.open_output_stream(p, compression=None)


def publish(temporary: str, target: str) -> None:
    fs, a = _fs(temporary)
    fs.move(a, _fs(target)[1])


def write_bytes(path: str, data: bytes) -> None:
    """Whole or not at all: a temporary name, then a move."""
    with open_write(path + ".tmp") as f:
        f.write(data)
    publish(path + ".tmp", path)


def remove(path: str) -> None:
    fs, p = _fs(path)
    fs.delete_file(p)


def write_json_lines(rows: DataFrame, path: str, order: list[str], target: str = "file_path", base: str = "", frame_lines: int = 10_000, line: str | None = None) -> DataFrame:
    """Each target file of rows as zstandard frames of JSON lines, in order; (target, n_lines, bytes, sha256).

    Null fields are left out of a line; with `line` (a column with the text itself) a null line writes nothing, so
    that a file of null lines only is one empty frame. One task writes a file at a time, in frames of frame_lines; a
    repeated task writes the same bytes again. Rows of a file arrive sorted by Spark, so no file is held in memory.
    """
    text = F.col(line) if line else F.to_json(F.struct(*[c for c in rows.columns if c not in (target, *[o for o in order if o.startswith("_o_")])]))
    d = rows.select(F.col(target).alias("t"), *(F.col(o).alias(f"o{i}") for i, o in enumerate(order)), text.alias("line"))
    d = spread(d, "t").sortWithinPartitions("t", *(f"o{i}" for i in range(len(order)))).select("t", "line")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        now, out, lines, n, size, sha = None, None, [], 0, 0, None

        def flush(last: bool = False) -> None:
            nonlocal lines, size
            if lines or (last and not size):
                data = compress_frame(lines)
                out.write(data)
                sha.update(data)
                size += len(data)
                lines = []

        def close() -> pd.DataFrame:
            flush(last=True)
            out.close()
            publish(f"{base}{now}.tmp", f"{base}{now}")
            return pd.DataFrame([(now, n, size, sha.hexdigest())], columns=["target", "n_lines", "bytes", "sha256"])

        for f in frames:
            for t, text in zip(f["t"], f["line"]):
                if t != now:
                    if out is not None:
                        yield close()
                    now, n, size, sha = t, 0, 0, hashlib.sha256()
                    out = open_write(f"{base}{t}.tmp")
                if text is not None:
                    lines.append(text.encode())
                    n += 1
                if len(lines) >= frame_lines:
                    flush()
        if out is not None:
            yield close()

    return d.mapInPandas(run, "target string, n_lines bigint, bytes bigint, sha256 string")


MEMBER = "file_path string, target_offset bigint, bytes bigint, sha256 string"


def join_planned(plan: DataFrame, base: str = "", reader: Callable[[str], BinaryIO] = open_read) -> DataFrame:
    """Carries out a compaction plan (file_path, target_path, source_no, size_bytes): one row for each target file
    with source_files, bytes, sha256, members (file_path, target_offset, bytes, sha256 of each source's bytes in it,
    all checked in the written file) and error (null if it was published). Targets are joined in parallel, each
    in one task; a task sees paths and sizes only and reads one small file at a time. A target that fails leaves
    its sources as they are. A lost task is run again and writes the same bytes.
    """
    d = plan.groupBy("target_path").agg(F.sort_array(F.collect_list(F.struct("source_no", "file_path", "size_bytes"))).alias("s"))
    d = spread(d, "target_path").select("target_path", F.transform("s", lambda x: x["file_path"]).alias("paths"), F.transform("s", lambda x: x["size_bytes"]).alias("sizes"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for target, paths, sizes in zip(f["target_path"], f["paths"], f["sizes"]):
                try:
                    r = join_files([(base + p, int(s)) for p, s in zip(paths, sizes)], base + target, reader, open_write, publish)
                    members = [{"file_path": m[0][len(base) :], "target_offset": m[1], "bytes": m[2], "sha256": m[3]} for m in r["members"]]
                    out.append((target, r["source_files"], r["bytes"], r["sha256"], members, None))
                except (OSError, ValueError) as e:
                    out.append((target, len(paths), None, None, [], str(e)))
            yield pd.DataFrame(out, columns=["target_path", "source_files", "bytes", "sha256", "members", "error"])

    return d.mapInPandas(run, f"target_path string, source_files bigint, bytes bigint, sha256 string, members array<struct<{MEMBER.replace(' ', ':').replace(',:', ',')}>>, error string")


def on_paths(paths: DataFrame, path: str, what: Callable[[str], int | str | None]) -> DataFrame:
    """(path, done, error): what(path) for every path, spread over the executors; an exception is the path's error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for p in f[path]:
                try:
                    done, error = what(p), None
                except (OSError, ValueError) as e:
                    done, error = None, str(e)
                out.append((p, None if done is None else str(done), error))
            yield pd.DataFrame(out, columns=[path, "done", "error"])

    return spread(paths.select(path), path).mapInPandas(run, f"`{path}` string, done string, error string")


def write_sidecar(path: str, sha256: str | None = None) -> str:
    """The checksum file of a file, which is hashed piece by piece unless its checksum is known."""
    if sha256 is None:
        with open_read(path) as f:
            sha256 = sha256_of(f)
    text = f"{sha256}  {os.path.basename(path)}\n"
    write_bytes(path + ".sha256", text.encode())
    return text


def size_of(path: str) -> int | None:
    """Bytes of a file; null if there is none."""
    fs, p = _fs(path)
    info = fs.get_file_info(p)
    return info.size if info.type.name == "File" else None


def repair_sidecar(path: str) -> int:
    """Writes the sidecar of a file that lacks one (1); an empty file is skipped (0)."""
    if not size_of(path):
        return 0
    write_sidecar(path)
    return 1


def repair_sidecars(missing: list[str]) -> int:
    return sum(map(repair_sidecar, missing))


def repair_tail(path: str) -> int:
    """Cuts a file back to its whole frames and renews its sidecar; bytes cut off (a wholly torn file becomes empty).
    Both passes go piece by piece."""
    size, good = size_of(path) or 0, 0
    with open_read(path) as f:
        for good, _ in read_frames(f):
            pass
    if good < size:
        with open_read(path) as f, open_write(path + ".tmp") as out:
            left = good
            while left and (piece := f.read(min(left, 1 << 20))):
                out.write(piece)
                left -= len(piece)
        publish(path + ".tmp", path)
        write_sidecar(path)
    return size - good


def append_frame(path: str, lines: list[bytes]) -> None:
    """Appends a frame to a local file and forces it to disk; on an error the file gets back its length before."""
    at = os.path.getsize(path) if os.path.exists(path) else 0
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    try:
        with open(path, "ab") as f:
            f.write(compress_frame(lines))
            f.flush()
            os.fsync(f.fileno())
    except OSError:
        with open(path, "ab") as f:
            f.truncate(at)
        raise


def append_json_line(path: str, row: dict) -> None:
    """One compact JSON line at the end of a local ledger, forced to disk."""
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(row, separators=(",", ":"), ensure_ascii=False) + "\n")
        f.flush()
        os.fsync(f.fileno())


def seal_name(hour: int, existing: set[str]) -> str:
    """Name under which an hour is sealed: the base file, or the next late file if the hour is sealed already."""
    if f"hour-{hour}.jsonl.zst" not in existing:
        return f"hour-{hour}.jsonl.zst"
    n = 1
    while f"hour-{hour}.late-{n}.jsonl.zst" in existing:
        n += 1
    return f"hour-{hour}.late-{n}.jsonl.zst"


class _Tee:
    """A writable stream over a compressor over a file."""

    def __init__(self, out: BinaryIO):
        self.out, self.z = out, zstandard.ZstdCompressor(level=3).compressobj()

    def write(self, data: bytes) -> int:
        self.out.write(self.z.compress(data))
        return len(data)

    def close(self) -> None:
        self.out.write(self.z.flush())


def seal_day(folder: str, target: str) -> str:
    """All files below a folder as one tar.zst with sidecar; names sorted, times zeroed, so the bytes repeat. Files
    stream through the compressor; neither they nor the tar are held. folder and target may be URIs."""
    fs, root = _fs(folder)
    found = sorted((i for i in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if i.type.name == "File"), key=lambda i: i.path)
    with open_write(target + ".tmp") as out:
        tee = _Tee(out)
        with tarfile.open(fileobj=tee, mode="w|") as tar:
            for i in found:
                info = tarfile.TarInfo(os.path.relpath(i.path, root))
                info.size = i.size
                with fs.open_input_stream(i.path, compression=None) as f:
                    tar.addfile(info, f)
        tee.close()
    publish(target + ".tmp", target)
    return write_sidecar(target)


def _key(stream: str, row: dict) -> int:
    """Sort key of a data row, as functions.payload.sort_key."""
    name = {"trades": "a", "depth": "u"}.get(stream)
    if name:
        try:
            raw = json.loads(row.get("raw_text") or "{}")
            if isinstance(raw, dict) and isinstance(raw.get(name), (int, str)):
                return int(raw[name])
        except ValueError:
            pass
    return row.get("exchange_ts") or 0


def check_daily(path: str, sha256: str, stream: str, hours: list[dict]) -> str | None:
    """Reads a daily file back: what is wrong with it, or null. It must have the checksum, as many lines as its hours
    (hour_no, total_records, as_is) have, and data keys that don't fall within an hour; gap rows are exempt, and so are
    hours that were taken as they are."""
    with open_read(path) as f:
        if sha256_of(f) != sha256:
            return "checksum of the written file differs"
    want = sum(h["total_records"] for h in hours)
    n, left, last, as_is = 0, 0, None, False
    todo = iter(hours)
    with open_read(path) as f:
        for line in read_lines(f):
            n += 1
            if n > want:
                break
            while not left:
                h = next(todo)
                left, last, as_is = h["total_records"], None, h["as_is"]
            left -= 1
            if as_is:
                continue
            row = json.loads(line)
            if row.get("type") != "gap":
                key = _key(stream, row)
                if last is not None and key < last:
                    return f"line {n - 1}: key {key} after {last}"
                last = key
    return None if n == want else f"{n} lines instead of {want}" if n < want else f"more than {want} lines"


def seal_staged(day: dict, suffix: str, now_ms: int, keep_sources: bool) -> str | None:
    """Publishes a staged daily file with sidecar and manifest if it passes check_daily, then deletes its sources; else
    removes it. What is wrong, or null."""
    target, staged = day["target"], day["target"] + suffix
    try:
        error = check_daily(staged, day["sha256"], day["stream"], day["hour_lines"])
    except (OSError, ValueError, zstandard.ZstdError) as e:
        error = str(e)
    if error:
        if size_of(staged) is not None:
            remove(staged)
        return error
    manifest = {
        "version": 1, "exchange": day["exchange"], "symbol": day["symbol"], "stream": day["stream"], "date": day["utc_date"], "consolidated_at": now_ms, "daily_file": os.path.basename(target), "sha256": day["sha256"],
        "total_records": day["total_records"], "data_records": day["data_records"], "gap_records": day["gap_records"], "missing_hours": day["missing_hours"],
        "hours": day["hours"], "source_files": [os.path.basename(p) for p in day["source_files"]],
    }
    write_sidecar(target, day["sha256"])
    write_manifest(target.removesuffix(".jsonl.zst") + ".manifest.json", manifest)
    publish(staged, target)
    if not keep_sources:
        for p in day["source_files"]:
            for gone in (p, p + ".sha256"):
                if size_of(gone) is not None:
                    remove(gone)
    return None


def write_manifest(path: str, manifest: dict) -> None:
    write_bytes(path, (json.dumps(manifest, indent=2, sort_keys=True) + "\n").encode())


def alert_payload(name: str, labels: dict[str, str], annotations: dict[str, str], starts_at: str, core: dict[str, str] | None = None) -> str:
    """Body of an alert in the array form of version 2 of the alert API; core labels win over given ones."""
    merged = {**labels, **(core or {}), "alertname": name}
    return json.dumps([{"labels": merged, "annotations": annotations, "startsAt": starts_at}], sort_keys=True)


def post_alert(body: str, send: Callable[[str], int], tries: int = 3) -> bool:
    """Whether a sender (returns an HTTP status) took it; errors are tried again."""
    for _ in range(tries):
        try:
            if 200 <= send(body) < 300:
                return True
        except OSError:
            continue
    return False


def as_table(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Rows as text lines of fixed-width columns; longer values end in an ellipsis."""
    cell = lambda c, n: F.rpad(F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n - 1)), F.lit("…"))).otherwise(c), n, " ")
    return df.select(F.rtrim(F.concat_ws("  ", *(cell(F.coalesce(F.col(c).cast("string"), F.lit("")), n) for c, n in widths.items()))).alias("line"))


def duration_text(seconds: int) -> str:
    """90061 as 1d 1h 1m 1s; 0 as 0s."""
    parts = ((seconds // 86400, "d"), (seconds % 86400 // 3600, "h"), (seconds % 3600 // 60, "m"), (seconds % 60, "s"))
    return " ".join(f"{n}{u}" for n, u in parts if n) or "0s"
