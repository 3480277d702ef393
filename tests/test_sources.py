"""Readers, writers and streaming pipelines on real files."""

import io
import json
import os
import random
import tarfile
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from tidelake.sources import archive, sink
from tidelake.sources.zstd_files import JoinError, TornFrame, compress_frame, frame_length, good_length, join_files, read_lines, sidecar_ok, sidecar_text
from tidelake.streaming import pipelines

DAY = "x/s/trades/2021-01-01"


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def get(path):
    with open(path, "rb") as f:
        return f.read()


# --- frames ---


def test_frame_lengths_of_many_kinds():
    r = random.Random(1)
    bodies = [b"", b"a" * 5_000_000, r.randbytes(300_000), b"one\ntwo\n"]
    whole = b""
    for body in bodies:
        for kw in ({}, {"write_checksum": True}, {"write_content_size": False}):
            whole += zstandard.ZstdCompressor(level=3, **kw).compress(body)
    whole += b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc"
    assert good_length(whole) == (len(whole), 13)
    assert b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(whole[: frame_length(whole, 0)]), read_across_frames=True).read(10) for _ in range(1)) == b""
    for cut in (1, 4, 9):
        good, frames = good_length(whole + compress_frame([b"x" * 100])[:-cut])
        assert (good, frames) == (len(whole), 13)
    assert good_length(b"garbage") == (0, 0)
    with pytest.raises(TornFrame):
        frame_length(b"garbage", 0)


def test_read_lines_over_frames_and_pieces():
    lines = [str(i).encode() * 50 for i in range(5000)]
    data = compress_frame(lines[:10]) + compress_frame(lines[10:]) + compress_frame([]) + zstandard.ZstdCompressor().compress(b"\n \nend")
    assert list(read_lines(data)) == [*lines, b"end"]
    with pytest.raises((TornFrame, zstandard.ZstdError)):
        list(read_lines(data[:-3]))


def test_sidecar():
    assert sidecar_ok(b"abc", sidecar_text(b"abc", "f")) and not sidecar_ok(b"abd", sidecar_text(b"abc", "f")) and not sidecar_ok(b"", "")


# --- joining ---


def join(tmp, sources, target="out"):
    return join_files([(str(tmp / p), n) for p, n in sources], str(tmp / target), sink.open_read, sink.open_write, sink.publish)


def test_join_is_byte_exact(tmp_path):
    frames = [compress_frame([b'{"i":%d}' % i]) for i in range(5)]
    for i, f in enumerate(frames):
        put(str(tmp_path / f"f{i}"), f)
    put(str(tmp_path / "empty"), b"")
    r = join(tmp_path, [(f"f{i}", len(f)) for i, f in enumerate(frames)] + [("empty", 0)])
    assert get(str(tmp_path / "out")) == b"".join(frames) and r["source_files"] == 5 and r["bytes"] == sum(map(len, frames))
    assert join(tmp_path, [(f"f{i}", len(f)) for i, f in enumerate(frames)])["sha256"] == r["sha256"]
    put(str(tmp_path / "p0"), b"a\nb")
    put(str(tmp_path / "p1"), b"c\n")
    join(tmp_path, [("p0", None), ("p1", 2)], "plain")
    assert get(str(tmp_path / "plain")) == b"a\nb\nc\n"


def test_join_refuses(tmp_path):
    put(str(tmp_path / "a"), compress_frame([b"1"]))
    put(str(tmp_path / "torn"), compress_frame([b"1"])[:-1])
    put(str(tmp_path / "plain"), b"1\n")
    for sources in ([("a", 3)], [("torn", None)], [("a", None), ("plain", None)]):
        with pytest.raises(JoinError):
            join(tmp_path, sources)
    with pytest.raises(OSError):
        join(tmp_path, [("gone", None)])
    assert not (tmp_path / "out").exists()


def test_join_planned(spark, tmp_path):
    r = random.Random(2)
    want, plan = Counter(), []
    for t in range(4):
        for k in range(6):
            lines = [json.dumps({"t": t, "k": k, "i": i}).encode() for i in range(r.randint(1, 9))]
            data = b"".join(compress_frame([x]) for x in lines)
            put(str(tmp_path / f"in/{t}-{k}"), data)
            plan.append((f"in/{t}-{k}", f"out/{t}", k, len(data)))
            want.update(lines)
    plan.append(("in/gone", "out/bad", 0, 5))
    d = spark.createDataFrame(plan, "file_path string, target_path string, source_no long, size_bytes long")
    out = {x.target_path: x for x in sink.join_planned(d, f"{tmp_path}/").collect()}
    assert out["out/bad"].error and all(out[f"out/{t}"].source_files == 6 and out[f"out/{t}"].error is None for t in range(4))
    assert Counter(x for t in range(4) for x in read_lines(get(str(tmp_path / f"out/{t}")))) == want
    n = archive.count_lines(d.select("target_path").distinct(), "target_path", f"{tmp_path}/").collect()
    assert sum(x.n_lines or 0 for x in n) == sum(want.values()) and [x.target_path for x in n if x.error] == ["out/bad"]


# --- archive tree ---


def test_archive_round_trip(spark, tmp_path):
    base = f"{tmp_path}/archive/"
    rows = [(f"{DAY}/hour-{h}.jsonl.zst", i, "data", "x", None if i % 7 == 0 else i * 10, '{"p":"0.00100000é"}') for h in (3, 12) for i in range(25)]
    d = spark.createDataFrame(rows, "file_path string, session_seq long, type string, exchange string, exchange_ts long, raw_text string")
    done = sink.write_json_lines(d, base, ["session_seq"], base=base, frame_lines=10).collect()
    assert sorted((r.target.split("/")[-1], r.n_lines) for r in done) == [("hour-12.jsonl.zst", 25), ("hour-3.jsonl.zst", 25)]
    assert good_length(get(base + done[0].target))[1] == 3
    again = sink.write_json_lines(d, base, ["session_seq"], base=base, frame_lines=10).collect()
    assert {r.sha256 for r in again} == {r.sha256 for r in done}
    back = archive.read_envelopes(spark, base)
    assert sorted(map(tuple, back.select("session_seq", "exchange_ts", "raw_text").collect()), key=str) == sorted(((r[1], r[4], r[5]) for r in rows), key=str)
    strict = archive.parse_lines(archive.read_strict(spark, base, batch=7))
    assert strict.where("error IS NOT NULL").count() == 0 and [r.session_seq for r in strict.where("file_path LIKE '%hour-3.%'").orderBy("line_no").collect()] == list(range(25))
    assert {json.loads(r.line)["session_seq"] for r in archive.last_data_envelope(strict).collect()} == {24}
    files = archive.list_files(spark, base)
    assert {(r.kind, r.hour_no, r.stream) for r in files.collect()} == {("base", 3, "trades"), ("base", 12, "trades")}
    assert archive.scan(files, date="2021-01-01", symbol=" S").count() == 2 and archive.scan(files, exchange="y").count() == 0


def test_torn_files_and_sidecars(spark, tmp_path):
    good, torn = str(tmp_path / "t/a.jsonl.zst"), str(tmp_path / "t/b.jsonl.zst")
    put(good, compress_frame([b'{"type":"data"}', b"no json"]))
    put(torn, compress_frame([b'{"type":"gap"}']) + compress_frame([b"x" * 99])[:-5])
    got = {r.file_path.split("/")[-1]: (r.size_bytes - r.good_bytes, r.frames) for r in archive.torn_files(spark, str(tmp_path / "t")).collect()}
    assert got["a.jsonl.zst"] == (0, 1) and got["b.jsonl.zst"][0] > 0 and got["b.jsonl.zst"][1] == 1
    errors = [r.error for r in archive.parse_lines(archive.read_strict(spark, str(tmp_path / "t"))).orderBy("file_path", "line_no").collect()]
    assert errors[0] is None and errors[1] == "line is no envelope" and errors[2] is None and errors[3].startswith("torn tail")
    sink.write_sidecar(good)
    put(torn + ".sha256", b"00  b\n")
    status = lambda: {r.file_path.split("/")[-1]: r.status for r in archive.check_sidecars(spark, str(tmp_path / "t")).collect()}
    assert status() == {"a.jsonl.zst": "ok", "b.jsonl.zst": "mismatch"}
    assert sink.repair_tail(torn) > 0 and sink.repair_tail(torn) == 0
    assert status() == {"a.jsonl.zst": "ok", "b.jsonl.zst": "ok"}
    put(str(tmp_path / "t/c.jsonl.zst"), compress_frame([b"1"]))
    put(str(tmp_path / "t/d.jsonl.zst"), b"")
    assert status()["c.jsonl.zst"] == "missing" and sink.repair_sidecars([str(tmp_path / "t/c.jsonl.zst"), str(tmp_path / "t/d.jsonl.zst")]) == 1


def test_local_appends_and_seals(tmp_path):
    p = str(tmp_path / "h/hour-1.jsonl.zst")
    sink.append_frame(p, [b"a"])
    sink.append_frame(p, [b"b", b"c"])
    assert list(read_lines(get(p))) == [b"a", b"b", b"c"]
    assert sink.seal_name(1, set()) == "hour-1.jsonl.zst" and sink.seal_name(1, {"hour-1.jsonl.zst", "hour-1.late-1.jsonl.zst"}) == "hour-1.late-2.jsonl.zst"
    first = sink.seal_day(str(tmp_path / "h"), str(tmp_path / "day.tar.zst"))
    assert sink.seal_day(str(tmp_path / "h"), str(tmp_path / "day.tar.zst")) == first
    raw = zstandard.ZstdDecompressor().decompress(get(str(tmp_path / "day.tar.zst")), max_output_size=10**6)
    assert tarfile.open(fileobj=io.BytesIO(raw)).getnames() == ["hour-1.jsonl.zst"]
    sink.append_json_line(str(tmp_path / "l"), {"a": "é"})
    assert get(str(tmp_path / "l")).decode() == '{"a":"é"}\n'
    sink.write_manifest(str(tmp_path / "m.json"), {"b": 1, "a": [2]})
    assert json.loads(get(str(tmp_path / "m.json"))) == {"a": [2], "b": 1}
    assert sink.duration_text(90061) == "1d 1h 1m 1s" and sink.duration_text(0) == "0s"


def test_tolerant_ledger_manifest_and_alert(spark, tmp_path):
    put(str(tmp_path / "l.jsonl"), b'{"ts_ns":1,"event":"start","collector_session_id":"a"}\n\nbroken\n{"ts_ns":5,"event":"clean_shutdown","collector_session_id":"a"}\n{"ts_ns":2,"event":"start","collector_session_id":"b"}\n')
    led = archive.read_tolerant(spark, str(tmp_path / "l.jsonl"), archive.LEDGER)
    assert led.where("ts_ns IS NOT NULL").count() == 3
    assert {(r.collector_session_id, r.event) for r in archive.ledger_since(led, 2).collect()} == {("a", "clean_shutdown"), ("b", "start")}
    assert archive.read_tolerant(spark, str(tmp_path / "none.jsonl"), archive.LEDGER).count() == 0
    ev = spark.createDataFrame([("die", "w", True, "2021-01-01T05:00:00Z", None, None), (None, "w", None, None, "2021-01-02T05:00:00", "stop"), ("x", "w", None, "when", None, None)], archive.HOST_EVENTS)
    assert {r.type for r in archive.host_events(ev, "2021-01-01 00:00:00", "2021-01-02 00:00:00").collect()} == {"die", "x"}
    put(str(tmp_path / "m/d.manifest.json"), b'{\n "exchange": "x", "missing_hours": [1, 2]\n}')
    assert archive.manifests(spark, str(tmp_path / "m")).first().missing_hours == [1, 2]
    body = json.loads(sink.alert_payload("n", {"alertname": "other", "s": "1"}, {}, "t", {"s": "2"}))
    assert body[0]["labels"] == {"alertname": "n", "s": "2"}
    calls = iter([OSError, 500, 200])

    def send(_):
        x = next(calls)
        if x is OSError:
            raise x
        return x

    assert sink.post_alert("", send) and not sink.post_alert("", lambda _: 404)
    t = sink.as_table(spark.createDataFrame([("abcdef", 1), (None, 22)], "a string, b int"), {"a": 4, "b": 2})
    assert sorted(r.line for r in t.collect()) == ["      22", "abc…  1"]


# --- streaming ---


def test_archive_stream_keeps_late_rows(spark, tmp_path):
    d = spark.createDataFrame([(1, "X", "s", "t", 0), (2, "x", "s", "t", 3_600_000_000_000)], "row_id long, exchange string, symbol string, stream string, received_at long")
    d.write.parquet(str(tmp_path / "in"))
    q = pipelines.archive(pipelines.read_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), 1_000, "once")
    q.awaitTermination()
    assert {(r.row_id, r.exchange, r.hour, r.part) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(1, "x", 0, "late"), (2, "x", 1, "base")}


def test_coverage_stream(spark, tmp_path):
    S = 10**9
    schema = "exchange string, symbol string, stream string, type string, source string, received_at long, gap_start_ts long, gap_end_ts long, reason string"
    k = ("x", "s", "t")
    batches = [
        [(*k, "data", "backup", 50 * S, None, None, None), (*k, "gap", "primary", 105 * S, 100 * S, 104 * S, "restart_gap"), (*k, "gap", "primary", 106 * S, 100 * S, 105 * S, "restart_gap"), (*k, "gap", "primary", 107 * S, 40 * S, 41 * S, "x"), (*k, "gap", "backup", 107 * S, 107 * S, 107 * S, "restart_gap"), (*k, "gap", "primary", 108 * S, 101 * S, 102 * S, "x")],
        [(*k, "data", "backup", 110 * S, None, None, None), (*k, "data", "backup", 130 * S, None, None, None)],
    ]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    parked = pipelines.ParkedGaps(spark, str(tmp_path / "gaps"))
    parked.follow(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "cp")).awaitTermination()
    got = {(r.source, r.gap_start_ts // S, r.gap_end_ts // S, r.covered) for r in parked.read().collect()}
    assert got == {("primary", 100, 105, True), ("primary", 40, 41, True), ("backup", 107, 107, False), ("primary", 101, 102, False)}


def test_gap_of_a_stream_that_falls_silent(spark, tmp_path):
    """Another stream's arrivals end the grace, the whole envelope comes out, and flush gives the rest."""
    S = 10**9
    schema = "exchange string, symbol string, stream string, type string, source string, received_at long, gap_start_ts long, gap_end_ts long, reason string, detail string"
    silent, alive = ("x", "s", "a"), ("x", "s", "b")
    for b in (
        [(*silent, "gap", "primary", 100 * S, 90 * S, 99 * S, "restart_gap", "why"), (*alive, "data", "primary", 101 * S, None, None, None, None)],
        [(*alive, "data", "primary", 108 * S, None, None, None, None)],
        [(*alive, "data", "primary", 200 * S, None, None, None, None), (*alive, "gap", "backup", 199 * S, 198 * S, 199 * S, "restart_gap", None), (*silent, "data", "backup", 95 * S, None, None, None, None)],
    ):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    parked = pipelines.ParkedGaps(spark, str(tmp_path / "gaps"))
    parked.follow(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "cp")).awaitTermination()
    out = parked.read().collect()
    # The backup's row of 95 s comes late but in time to show that the gap was covered.
    assert {(r.stream, r.gap_end_ts // S, r.reason, r.detail, r.covered) for r in out} == {("a", 99, "restart_gap", "why", True), ("b", 199, "restart_gap", None, True)}
    more = spark.createDataFrame([(*silent, "gap", "primary", 300 * S, 290 * S, 299 * S, "restart_gap", "q"), (*alive, "data", "primary", 320 * S, None, None, None, None), (*silent, "gap", "primary", 319 * S, 310 * S, 319 * S, "restart_gap", "end")], schema)
    more.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    parked.follow(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "cp")).awaitTermination()
    assert {(r.detail, r.covered) for r in parked.read().where("gap_start_ts >= 290000000000").collect()} == {("q", False)}
    assert {(r.detail, r.covered) for r in parked.flush().where("gap_start_ts >= 290000000000").collect()} == {("q", False), ("end", False)}


def test_caps_and_overflow_gaps(spark):
    d = spark.createDataFrame([("x", "s", "t", i, i // 4) for i in range(10)], "exchange string, symbol string, stream string, at long, block long")
    held = pipelines.within_caps(d, ["exchange", "symbol", "stream"], ["at"], "block", {"t": 7})
    assert sorted(r["at"] for r in held.where("dropped").collect()) == [7, 8, 9]
    rows = spark.createDataFrame([("x", "s", "t", i, i in (2, 3, 5, 9)) for i in range(10)], "exchange string, symbol string, stream string, at long, dropped boolean")
    got = {(r.gap_start_ts, r.gap_end_ts, r.detail) for r in pipelines.overflow_gaps(rows, ["exchange", "symbol", "stream"], "at", 4).collect()}
    tell = "Producer buffer was full; {} messages dropped for t/s".format
    assert got == {(2, 4, tell(2)), (5, 6, tell(1)), (9, None, tell(1))}


def test_stream_dedup_and_hours(spark, tmp_path):
    day = 86_400 * 10**9
    some = [("data", "x", "s", "t", "a", 0, i % 10, i * 10**12) for i in range(30)] + [("gap", "x", "s", "t", "a", 0, 1, 5)]
    synthetic = [("data", "x", "s", "t", None, None, -1, None), ("data", "x", "s", "t", "a", 0, -1, None)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(some)], "row_id long, type string, exchange string, symbol string, stream string, _topic string, _partition int, _offset long, received_at long")
    d.coalesce(1).write.parquet(str(tmp_path / "in"))
    old = spark.createDataFrame([(100 + i, *r) for i, r in enumerate([*synthetic, ("data", "x", "s", "t", "b", 0, 7, 400 * day)])], d.schema)
    old.coalesce(1).write.parquet(str(tmp_path / "more"))
    older = spark.createDataFrame([(200, "data", "x", "s", "t", "b", 0, 8, 1), (201, "data", "x", "s", "t", "b", 0, 7, 2)], d.schema)
    older.coalesce(1).write.mode("append").parquet(str(tmp_path / "more"))
    assert pipelines.dedup_offsets(spark, str(tmp_path / "in")).count() == 10
    # Rows without coordinates pass, and so does one that comes 400 days behind another.
    assert sorted(r.row_id for r in pipelines.dedup_offsets(spark, str(tmp_path / "more")).collect()) == [100, 101, 102, 200]
    h = pipelines.hourly_counts(spark, str(tmp_path / "in"))
    assert h.agg(F.sum("n")).first()[0] == 30 and h.count() == len({i * 10**12 // 3_600_000_000_000 for i in range(30)})


def test_replayed_frames_are_routed(spark, tmp_path):
    from tidelake.functions.frames import route_frames
    from tidelake.sources.replay import ReplaySource

    frames = [f'{{"stream":"btcusdt@aggTrade","data":{{"a":{i}}}}}' for i in range(25)]
    put(str(tmp_path / "frames"), ("\n".join(frames) + "\n").encode())
    spark.dataSource.register(ReplaySource)
    d = spark.readStream.format("frames_replay").option("path", str(tmp_path / "frames")).option("batch", 10).load()
    q = route_frames(d, "frame", ["btcusdt"]).writeStream.format("memory").queryName("replayed").start()
    try:
        q.processAllAvailable()
        got = spark.sql("SELECT line_no, stream, raw_text FROM replayed ORDER BY line_no").collect()
    finally:
        q.stop()
    assert [(r.line_no, r.raw_text) for r in got] == [(i, f'{{"a":{i}}}') for i in range(25)] and {r.stream for r in got} == {"trades"}
