"""The lake object end to end on small archives."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tidelake.api import Lake
from tidelake.cli import main
from tidelake.operators import health
from tidelake.sources.sink import write_sidecar
from tidelake.sources.zstd_files import compress_frame, read_lines

S = 10**9
DATE = "2021-01-01"
DAY0 = 1_609_459_200_000


def envelope(a, hour, offset, **more):
    raw = json.dumps({"a": a})
    e = {"v": 1, "type": "data", "exchange": "x", "symbol": "s", "stream": "trades", "received_at": (DAY0 + hour * 3_600_000) * 1_000_000 + offset, "exchange_ts": DAY0 + hour * 3_600_000, "collector_session_id": "c", "session_seq": offset, "raw_text": raw, "raw_sha256": hashlib.sha256(raw.encode()).hexdigest(), "_topic": "x.trades", "_partition": 0, "_offset": offset}
    return e | more


def put(base, name, rows, sidecar=True, stream="trades"):
    p = os.path.join(base, "x", "s", stream, DATE, name)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        for r in rows:
            f.write(compress_frame([r if isinstance(r, bytes) else json.dumps(r).encode()]))
    if sidecar:
        write_sidecar(p)
    return p


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "archive"), DAY0 + 10 * 86_400_000)


def test_sparse_day(lake):
    a = put(lake.base, "hour-5.jsonl.zst", [envelope(100, 5, 0), envelope(101, 5, 1)])
    b = put(lake.base, "hour-12.jsonl.zst", [envelope(200, 12, 2)])
    with open(a, "rb") as f:
        first = next(read_lines(f))
    (r,) = lake.consolidate(DATE)
    assert r["success"] and (r["total_records"], r["data_records"], r["gap_records"], r["source_files_count"]) == (25, 3, 22, 2)
    folder = os.path.dirname(a)
    assert sorted(os.listdir(folder)) == [f"{DATE}.jsonl.zst", f"{DATE}.jsonl.zst.sha256", f"{DATE}.manifest.json"] and not os.path.exists(b)
    with open(f"{folder}/{DATE}.jsonl.zst", "rb") as f:
        lines = list(read_lines(f))
    rows = [json.loads(x) for x in lines]
    assert len(rows) == 25 and first in lines
    assert [r.get("reason") or json.loads(r["raw_text"])["a"] for r in rows] == ["missing_hour"] * 5 + [100, 101] + ["missing_hour"] * 6 + [200] + ["missing_hour"] * 11
    manifest = json.load(open(f"{folder}/{DATE}.manifest.json"))
    assert len(manifest["missing_hours"]) == 22 and manifest["hours"]["5"]["data_records"] == 2
    assert lake.consolidate(DATE) == []
    errors, gaps = lake.verify(DATE)
    assert gaps.count() == 22 and {r.message.split("missing fields")[0] for r in errors.collect()} <= {f"Line {i}: " for i in range(25)}


def test_late_files_are_merged(lake):
    put(lake.base, "hour-05.jsonl.zst", [envelope(100, 5, 0), envelope(103, 5, 1)])
    put(lake.base, "hour-5.late-2.jsonl.zst", [envelope(101, 5, 3)])
    put(lake.base, "hour-5.late-10.jsonl.zst", [envelope(102, 5, 4)])
    put(lake.base, "hour-6.jsonl.zst", [envelope(9, 6, 5), envelope(8, 6, 6)])
    (r,) = lake.consolidate(DATE, keep_sources=True)
    with open(r["target"].removeprefix("file:"), "rb") as f:
        rows = [json.loads(x) for x in read_lines(f)]
    assert [json.loads(x["raw_text"])["a"] for x in rows if x["type"] == "data"] == [100, 101, 102, 103, 9, 8]
    assert r["source_files"] == ["hour-05.jsonl.zst", "hour-5.late-10.jsonl.zst", "hour-5.late-2.jsonl.zst", "hour-6.jsonl.zst"]
    assert os.path.exists(os.path.join(os.path.dirname(r["target"].removeprefix("file:")), "hour-6.jsonl.zst"))


def test_torn_source_stops_its_day_only(lake):
    p = put(lake.base, "hour-5.jsonl.zst", [envelope(1, 5, 0)])
    with open(p, "ab") as f:
        f.write(compress_frame([b"x" * 100])[:-3])
    put(lake.base, "hour-5.jsonl.zst", [envelope(1, 5, 0, stream="depth")], stream="depth")
    got = {r["stream"]: r["success"] for r in lake.consolidate(DATE)}
    assert got == {"trades": False, "depth": True} and os.path.exists(p)
    assert lake.torn_tails().count() == 1 and lake.repair_tails() == 1 and lake.torn_tails().count() == 0
    assert [r["success"] for r in lake.consolidate(DATE)] == [True]


@pytest.mark.parametrize("damage", ["corrupt", "swap", "lost", "gone"])
def test_a_file_that_fails_its_check_keeps_all_sources(lake, damage):
    """What was written is read back before anything is deleted: altered, reordered, shortened or missing files never
    appear under the daily name, and nothing but the staged file goes."""
    paths = [put(lake.base, "hour-5.jsonl.zst", [envelope(100, 5, 0), envelope(101, 5, 1)]), put(lake.base, "hour-5.late-1.jsonl.zst", [envelope(99, 5, 2)])]
    before = sorted(os.listdir(os.path.dirname(paths[0])))
    staged, _ = lake.stage_days(DATE)
    at = staged.first().target.removeprefix("file:") + ".staged"
    with open(at, "rb") as f:
        lines = list(read_lines(f))
    if damage == "gone":
        os.remove(at)
    else:
        if damage == "swap":
            lines[5], lines[6] = lines[6], lines[5]
        data = compress_frame(lines[:-1] if damage == "lost" else lines)
        with open(at, "wb") as f:
            f.write(data[:-5] if damage == "corrupt" else data)
        if damage in ("swap", "lost"):  # the checksum would tell; here the other checks must
            staged = staged.withColumn("sha256", F.lit(hashlib.sha256(data).hexdigest()))
    (r,) = lake.seal_days(staged)
    assert not r["success"] and {"swap": "after", "lost": "25 lines instead of 26", "corrupt": "checksum", "gone": "o such file"}[damage] in r["error"]
    assert sorted(os.listdir(os.path.dirname(paths[0]))) == before
    assert [r["success"] for r in lake.consolidate(DATE)] == [True] and not os.path.exists(paths[0])


def test_a_date_lists_its_own_folders(lake, spark):
    put(lake.base, "hour-5.jsonl.zst", [envelope(1, 5, 0)])
    other = os.path.join(lake.base, "X ", "S", "depth", "2021-01-02")
    os.makedirs(other)
    with open(os.path.join(other, "hour-1.jsonl.zst"), "wb") as f:
        f.write(b"x")
    assert lake.files().count() == 2
    assert [r.utc_date for r in lake.files("2021-01-02", "x", "s").collect()] == ["2021-01-02"]
    plan = lake.files(DATE)._jdf.queryExecution().toString()
    assert DATE in plan and "2021-01-02" not in plan
    assert lake.files("2020-01-01").count() == 0 and lake.files([DATE, "2021-01-02"], symbol=["s", "q"]).count() == 2


def test_verify_finds_everything(lake):
    bad = envelope(5, 1, 7)
    bad["raw_sha256"] = "0"
    lacking = envelope(6, 1, 8)
    del lacking["exchange_ts"]
    put(lake.base, "hour-1.jsonl.zst", [envelope(4, 1, 6), envelope(4, 1, 6), bad, lacking, b"no json"])
    put(lake.base, "hour-2.jsonl.zst", [envelope(9, 2, 6), {"type": "gap"}], sidecar=False)
    errors, gaps = lake.verify(DATE, full=True)
    found = sorted((r.check_no, r.line_no) for r in errors.collect())
    assert found == [(1, None), (2, 4), (3, 1), (3, 3), (4, 2), (5, 1), (6, 0), (6, 1)]
    assert gaps.count() == 1
    assert "missing fields: ['exchange_ts']" in {r.message.split(": ", 1)[1] for r in errors.where("check_no = 3 AND line_no = 3").collect()}
    errors, _ = lake.verify(DATE, repair_checksums=True)
    assert errors.where("check_no = 1").count() == 0
    assert lake.verify("2020-01-01")[0].count() == 0


def test_checks_and_cli(lake, capsys):
    put(lake.base, "hour-10.jsonl.zst", [envelope(3, 10, 2)])
    put(lake.base, "hour-2.jsonl.zst", [envelope(4, 2, 0), envelope(9, 2, 1)])
    assert [(r.expected, r.actual) for r in lake.check("trades", DATE).collect()] == [(5, 9)]
    args = ["--base-dir", lake.base]
    assert main([*args, "check-trades", "--date", DATE]) == 1 and main([*args, "check-depth", "--date", DATE]) == 0
    assert main([*args, "gaps", "--date", DATE]) == 0 and main([*args, "--json", "manifest", "--date", DATE]) == 0
    assert main([*args, "audit-files", "--period", "day", "--value", "when"]) == 2 and main([*args, "audit-files", "--period", "day", "--value", DATE]) == 0
    assert main([*args, "verify", "--date", DATE]) == 0 and main([*args, "torn"]) == 0
    assert main([*args, "consolidate-day", "--date", DATE]) == 0
    assert "missing_hour" in capsys.readouterr().out
    with pytest.raises(ValueError):
        lake.check("funding_rate", DATE)


def test_audit_and_backfill(lake, spark):
    put(lake.base, "hour-0.jsonl.zst", [envelope(1, 0, 0), envelope(5, 0, 1)])
    start, end = lake.scope("day", DATE)
    f = lake.audit_files(start, end)
    assert f.groupBy("source").count().count() == 2 and f.count() == 24
    intents = spark.createDataFrame([("m", DAY0, None, DAY0 + 3_600_000)], "maintenance_id string, created_ms long, consumed_ms long, expires_ms long")
    manifests = spark.createDataFrame([("x", "s", "trades", DATE, list(range(1, 20)))], "exchange string, symbol string, stream string, utc_date string, missing_hours array<int>")
    out = lake.reconcile(f, lake.audit_state(start, end, intents=intents, manifests=manifests))
    assert {r.status: r.n for r in out["summary"].collect()} == {"explained": 21, "unexplained": 3, "orphan_state": 0}  # the hour after the last explained one lies within the tolerance
    assert lake.audit_state(start, end).count() == 0

    def provider(exchange, symbol, stream, a, z):
        return [json.dumps({"T": a, "a": a})] if a < DAY0 + 3 * 3_600_000 else []

    from tidelake.operators import backfill

    def failing(exchange, symbol, stream, a, z):
        if a >= DAY0 + 20 * 3_600_000:
            raise backfill.Unavailable("too old")
        if a >= DAY0 + 10 * 3_600_000:
            raise OSError("down")
        return []

    told = lake.backfill_hours(failing, DATE)
    assert {r.status: r["count"] for r in told.groupBy("status").count().collect()} == {"empty": 9, "failed": 10, "unavailable": 4}
    assert backfill.summary(told).first().asDict() == {"attempted": 23, "written": 0, "records": 0, "empty": 9, "unavailable": 4, "failed": 10, "not_backfillable": 0}
    done = lake.backfill(provider, DATE)
    assert sorted(r.target.split("/")[-1] for r in done.collect()) == ["hour-1.backfill-1.jsonl.zst", "hour-2.backfill-1.jsonl.zst"]
    assert lake.missing_hours(DATE).count() == 21
    assert lake.verify(DATE)[0].where("check_no <= 2").count() == 0
    state = spark.createDataFrame([("gone", 1, 1), ], "file_path string, file_byte_size long, updated_at long")
    assert {r.status for r in lake.against_state(state).collect()} == {"sealed", "missing_file"}
    assert lake.mark_maintenance("m", "all", "me", "because").first().expires_ms == lake.now_ms + 3_600_000


def hours_of(exchange, symbol, stream, a, z):
    return [json.dumps({"T": a, "a": a})] if a < DAY0 + 3 * 3_600_000 else []


def test_audit_commands_and_their_codes(lake, spark, tmp_path, capsys):
    put(lake.base, "hour-0.jsonl.zst", [envelope(1, 0, 0)])
    put(lake.base, "hour-23.jsonl.zst", [envelope(2, 23, 1)])
    state, data, report = (str(tmp_path / x) for x in ("state", "data", "report"))
    args = ["--base-dir", lake.base, "--json"]
    day = ["--period", "day", "--value", DATE, "--state-dir", state, "--data-dir", data]
    assert main([*args, "audit-reconcile", *day, "--report", report]) == 2
    assert spark.read.json(report).groupBy("divergence").count().collect()[0]["count"] == 22
    assert main([*args, "audit-backfill", *day, "--provider", "tests.test_api:hours_of"]) == 2
    assert '"written": 2' in capsys.readouterr().out
    intents = spark.createDataFrame([("m", DAY0, None, DAY0 + 86_400_000)], "maintenance_id string, created_ms long, consumed_ms long, expires_ms long")
    intents.write.parquet(f"{state}/maintenance_intent")
    lake.component_event(state, "writer", "w1", "register", "b")
    lake.component_event(state, "writer", "w1", "shutdown", planned=True)
    os.makedirs(f"{data}/c1")
    with open(f"{data}/c1/lifecycle.jsonl", "w") as f:
        f.write(json.dumps({"ts_ns": DAY0 * 10**6, "event": "start", "collector_session_id": "c"}) + "\n" + json.dumps({"ts_ns": (DAY0 + 5000) * 10**6, "event": "clean_shutdown", "collector_session_id": "c"}) + "\n{bad\n")
    found = lake.audit_state(DAY0, DAY0 + 86_399_999, **lake.state_inputs(state, data))
    assert {r.source for r in found.collect()} == {"pg.maintenance_intent", "ledger"}
    assert main([*args, "mark-maintenance", "--id", "q", "--scope", "all", "--planned-by", "me", "--reason", "r", "--state-dir", f"{state}2"]) == 0
    assert main([*args, "audit-state", *day]) == 0 and main([*args, "audit-reconcile", "--period", "week", "--value", "x"]) == 2
    assert main([*args, "gaps-backfill", "--date", DATE, "--provider", "tests.test_api:hours_of"]) == 0
    assert main([*args, "consolidate-cycle"]) == 0 and main([*args, "backfill-cycle", "--provider", "tests.test_api:hours_of", "--days", "1"]) == 0


def test_health(spark):
    p = spark.createDataFrame([("k", t * S, f) for t, f in ((0, False), (10, True), (20, True), (45, True), (50, None), (4000, True), (4001, True))], "k string, t long, bad boolean")
    st = health.producer_states(p, ["k"], "t", "bad")
    assert [r.state for r in st.orderBy("t").collect()] == ["HEALTHY", "DEGRADED", "DEGRADED", "PAUSED", "HEALTHY", "DEGRADED", "DEGRADED"]
    assert {(r.gap_start_ts // S, r.gap_end_ts and r.gap_end_ts // S) for r in health.producer_outages(p, ["k"], "t", "bad").collect()} == {(10, 50), (4000, None)}
    assert [(r.gap_start_ts // S, r.failures) for r in health.holds(p, ["k"], "t", "bad", 3, "pg_outage_hold").collect()] == [(10, 3)]
    assert {(r.gap_start_ts // S, r.gap_end_ts // S) for r in health.consumer_outages(p, "t").collect()} == {(50, 4000)}
    d = spark.createDataFrame([("x", "s", "t", at, off) for at, off in ((1, False), (2, True), (3, True), (4, False), (9, True))], "exchange string, symbol string, stream string, t long, off boolean")
    assert {(r.gap_start_ts, r.gap_end_ts, r.n) for r in health.disconnect_gaps(d, "t", "off").collect()} == {(1, 3, 2), (4, 9, 1)}
    o = spark.createDataFrame([("a", 0, i) for i in (1, 2, 5, 5, 70_000)] + [("a", 0, -1)], "_topic string, _partition int, _offset long")
    assert {(r.from_offset, r.to_offset) for r in health.offset_resets(o).collect()} == {(3, 4), (6, 69_999)}
    c = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0)], "conn string, connected_at long")
    f = spark.createDataFrame([("a", 5 * S), ("b", 31 * S)], "conn string, received_at long")
    assert {r.conn for r in health.first_frame_overdue(c, f, "conn").collect()} == {"b", "c"}
    assert health.stagger(300, 1, 3) == 100 and [health.backoff(i) for i in (0, 1, 5, 9)] == [1, 2, 32, 60]
