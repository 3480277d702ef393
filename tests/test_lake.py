"""Lake operators against brute force and small cases."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidelake.functions import timeutil as tu
from tidelake.functions.frames import route_frames, value_at
from tidelake.functions.payload import json_long, natural_key, payload_hash_ok, sort_key
from tidelake.functions.reasons import EXPLAINS, PERSISTENT, RUNTIME_ONLY, check_reason, explains
from tidelake.operators import backfill, classify, consolidate, continuity, coverage, depth, gaps, integrity, metrics, ordered, reconcile, state
from tidelake.operators.overlap import overlapping

S = 1_000_000_000


def rows(df):
    return Counter(map(tuple, df.collect()))


# --- ordered building blocks ---


def series(spark, seed, n=200):
    r = random.Random(seed)
    data = [(r.choice("ab"), i // 17, i, r.choice([None, r.randrange(50)]), r.randrange(2)) for i in range(n)]
    return data, spark.createDataFrame(data, "k string, blk long, i long, v long, f long").repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_ordered_operators(spark, seed):
    data, df = series(spark, seed)
    prev, top, total, last = {}, {}, defaultdict(int), {}
    want = Counter()
    for k, _, i, v, f in data:
        total[k] += f
        now = v if v is not None else last.get(k)
        want[(i, prev.get(k, (None,))[0], top.get(k), total[k], now)] += 1
        prev[k], last[k] = (v,), now
        if v is not None:
            top[k] = max(v, top.get(k, v))
    d = ordered.previous(df, ["k"], "blk", ["i"], {"v": "before"})
    d = ordered.running_max(d, ["k"], "blk", ["i"], "v", "top")
    d = ordered.running_sum(d, ["k"], "blk", ["i"], "f", "total")
    d = ordered.last_known(d, ["k"], "blk", ["i"], "v", "known")
    assert rows(d.select("i", "before", "top", "total", "known")) == want


def test_overlap_gives_each_pair_once(spark):
    r = random.Random(3)
    a = [(i, r.choice("xy"), s := r.randint(-500, 500), s + r.randint(-2, 300)) for i in range(80)]
    b = [(i, r.choice("xy"), s := r.randint(-500, 500), s + r.randint(-2, 300)) for i in range(80)]
    got = overlapping(spark.createDataFrame(a, "i long, k string, s long, e long"), spark.createDataFrame(b, "j long, k string, t long, u long"), ["k"], ("s", "e"), ("t", "u"), 50, 7)
    want = Counter((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= x[3] and y[2] <= y[3] and x[2] - 7 <= y[3] and x[3] + 7 >= y[2])
    assert rows(got.select("i", "j")) == want


# --- continuity and integrity ---

ENV = "row_id long, type string, exchange string, symbol string, stream string, received_at long, exchange_ts long, collector_session_id string, session_seq long, raw_text string, raw_sha256 string, _topic string, _partition int, _offset long, gap_start_ts long, gap_end_ts long, reason string, detail string, file_path string, v int, file string"


def env(spark, *data):
    base = dict.fromkeys([c.split()[0] for c in ENV.split(", ")])
    return spark.createDataFrame([tuple((base | {"type": "data", "exchange": "x", "symbol": "s", "stream": "trades", "row_id": i, "file": "f", "received_at": i * S} | d).values()) for i, d in enumerate(data)], ENV)


def test_trade_breaks(spark):
    e = env(spark, *({"raw_text": t} for t in ('{"a":5}', '{"a":6}', "no json", '{"b":1}', '{"a":9}', '{"a":9}', '{"a":3000000000000}')))
    got = continuity.trade_breaks(e, ["symbol"], "file", ["row_id"], []).select("row_id", "expected", "actual", "missing")
    assert rows(got) == Counter({(4, 7, 9, 2): 1, (5, 10, 9, -1): 1, (6, 10, 3_000_000_000_000, 2_999_999_999_990): 1})


def test_sequence_records_tell_missing(spark):
    e = env(spark, *({"raw_text": f'{{"a":{a}}}'} for a in (1, 4, 4)))
    b = continuity.all_breaks(e, ["symbol"], "file", ["row_id"], ["exchange", "symbol", "stream", "row_id", "received_at"])
    assert {r.detail for r in continuity.sequence_gap_records(b).collect()} == {"a: expected 2, got 4 (missing 2)", "a: expected 5, got 4 (chain break)"}


def test_session_and_source(spark):
    e = env(spark, *({"collector_session_id": s, "_topic": t} for s, t in (("p1", "x.trades"), ("b1", "backup.x.trades"), ("p1", "x.trades"), ("p2", "x.trades"), ("b1", "backup.x.trades"), ("q", "backfill"))))
    assert [(r.source, r.row_id, r.gap_start_ts, r.gap_end_ts) for r in continuity.session_changes(e).collect()] == [("primary", 3, 2 * S, 3 * S)]


def test_silence(spark):
    d = env(spark, *({"received_at": t * S} for t in (0, 10, 50, 60, 200)))
    g = env(spark, {"type": "gap", "gap_start_ts": 49 * S, "gap_end_ts": 55 * S}, {"type": "gap", "symbol": "other", "gap_start_ts": 0, "gap_end_ts": 300 * S})
    assert [r.duration_ms for r in continuity.uncovered_silences(d, g).collect()] == [140_000]
    assert continuity.uncovered_silences(d, g, keyed=False).count() == 0
    assert continuity.uncovered_silences(d.limit(0), g).count() == 0


def test_envelope_checks(spark):
    import json

    full = {c: 1 for c in integrity.DATA_FIELDS} | {"type": "data", "exchange_ts": None}
    lines = [json.dumps(full), json.dumps({k: v for k, v in full.items() if k not in ("v", "_offset")}), json.dumps({"type": "gap"}), "[broken"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in lines], "line string").select(integrity.missing_fields_json("line")).collect()]
    assert got[:2] == [[], ["_offset", "v"]] and len(got[2]) == len(integrity.GAP_FIELDS) - 1 and got[3] is None
    e = env(spark, {"raw_text": "é", "raw_sha256": "4a99557e4033c3539de2eb65472017cad5f9557f7a0625a09f1c3f6e2ba69c4c"}, {"raw_text": "a", "raw_sha256": "b"}, {"raw_text": "a"})
    assert [r.row_id for r in integrity.hash_mismatches(e).collect()] == [1]
    assert [r[0] for r in e.orderBy("row_id").select(payload_hash_ok("raw_text", "raw_sha256")).collect()] == [True, False, None]


def test_duplicate_offsets(spark):
    e = env(spark, *({"_topic": t, "_partition": p, "_offset": o, "file_path": f} for t, p, o, f in (("a", 0, 1, "x"), ("a", 0, 1, "y"), ("a", 1, 1, "x"), (None, 0, 1, "x"), (None, 0, 1, "x"), ("a", 0, -1, "x"), ("a", 0, -1, "x"), ("a", 0, None, "x"))))
    assert {(r.row_id, r.first_row) for r in integrity.duplicate_offsets(e).collect()} == {(1, 0), (4, 3)}
    assert {r.row_id for r in integrity.duplicate_offsets(e, per_file=True).collect()} == {4}


# --- gaps and reconciliation ---


def test_missing_hours(spark):
    data = [("x", "s", "trades", "2021-01-01", "base", h) for h in range(24) if h not in (3, 20)] + [("x", "s", "depth", "2021-01-01", "daily", None), ("x", "s", "liquidations", "2021-01-01", "other", 1)]
    d = spark.createDataFrame(data, "exchange string, symbol string, stream string, utc_date string, kind string, hour_no int")
    now = 1_609_459_200_000 + 10 * tu.HOUR_MS
    assert [r.hour_no for r in gaps.missing_hours(d, now).collect()] == [3]
    m = gaps.missing_hours(d)
    assert {r.hour_no for r in m.collect()} == {3, 20} and gaps.backfillable(m).count() == 2
    first = gaps.missing_hour_envelopes(m.where("hour_no = 3")).first()
    assert first.gap_end_ts - first.gap_start_ts == 3_600_000_000_000 - 1 and first.session_seq == -1


def test_merge_scope_fanout_and_state_sources(spark):
    g = spark.createDataFrame([(2, "x", "s", "t", 10, 30, "b", "second"), (1, "x", "s", "t", 10, 20, "a", "first"), (3, "x", "s", "t", 11, 12, "c", None)], "row_id long, exchange string, symbol string, stream string, gap_start_ts long, gap_end_ts long, reason string, detail string")
    assert rows(gaps.merge_same_start(g).select("gap_start_ts", "gap_end_ts", "reason", "n_merged")) == Counter({(10, 30, "a", 2): 1, (11, 12, "c", 1): 1})
    c = spark.createDataFrame([("w", 5, None, None), ("c", 5, 9, True), ("n", None, 3, False)], "component string, last_heartbeat_ms long, clean_shutdown_ms long, planned boolean")
    assert rows(gaps.component_gaps(c, 77).select("component", "start_ms", "end_ms", "reason")) == Counter({("w", 5, 77, "restart_gap"): 1, ("c", 5, 9, "collector_restart"): 1})
    m = spark.createDataFrame([("m", 1, None, 8), ("n", 1, 2, 8), ("o", 1, None, None)], "maintenance_id string, created_ms long, consumed_ms long, expires_ms long")
    assert {(r.maintenance_id, r.end_ms) for r in gaps.maintenance_gaps(m, 99).collect()} == {("m", 8), ("n", 2), ("o", 99)}
    s = spark.createDataFrame([("x", "d"), ("y", None)], "exchange string, detail string")
    t = spark.createDataFrame([("x", "a", "t"), ("x", "b", "t")], "exchange string, symbol string, stream string")
    assert gaps.fan_out(s, t, ["exchange"]).count() == 2
    assert {(r.exchange, r.symbol, r.detail) for r in gaps.fan_out(s, t, ["exchange"], strict=True).collect()} >= {("y", "", "; fanout=true")}
    led = spark.createDataFrame([("u", 1, "clean_shutdown", 10), ("u", 2, "start", 20), ("u", 3, "start", 30), ("u", 4, "clean_shutdown", 40)], "sess string, no long, event string, ts long")
    assert [(r.start_ts, r.ts) for r in gaps.paired_sessions(led, ["sess"], ["no"]).collect()] == [(30, 40)]


def test_reasons(spark):
    assert explains(spark).count() == 16 and len(PERSISTENT) == 4 and len(RUNTIME_ONLY) == 17
    assert check_reason("write_error") and "missing_hour" in EXPLAINS
    with pytest.raises(ValueError):
        check_reason("bored")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reconcile_first_match(spark, seed):
    r = random.Random(seed)
    reasons = [*EXPLAINS, "ws_disconnect", "write_error", "disk_full_hold"]
    make = lambda: (r.choice("ab"), "s", "t", s := r.randint(0, 60_000), s + r.randint(0, 9000), r.choice(reasons))
    f, s = [(i, *make()) for i in range(60)], [(i, *make()) for i in range(60)]
    schema = "{0} long, exchange string, symbol string, stream string, start_ms long, end_ms long, reason string"
    fd, sd = spark.createDataFrame(f, schema.format("file_id")), spark.createDataFrame(s, schema.format("state_id"))
    want = {}
    for x in f:
        for y in s:
            if x[1:4] == y[1:4] and x[6] in EXPLAINS.get(y[6], ()) and x[4] - 2000 <= y[5] and x[5] + 2000 >= y[4]:
                want[x[0]] = y[0]
                break
    m = reconcile.chosen(fd, sd)
    assert dict(map(tuple, m.collect())) == want
    assert {r.state_id for r in reconcile.orphans(sd, m).collect()} == set(range(60)) - set(want.values())
    assert {r.status: r.n for r in reconcile.summary(fd, sd, m).collect()} == {"explained": len(want), "unexplained": 60 - len(want), "orphan_state": 60 - len(set(want.values()))}


@pytest.mark.parametrize(
    "given,want",
    [
        ({"previous_boot": "a", "current_boot": "b"}, ("host", "host_reboot", False)),
        ({"previous_boot": "a", "current_boot": "b", "intent_id": "m"}, ("host", "operator_shutdown", True)),
        ({"previous_boot": "a", "current_boot": "a", "host_intent": True, "intent_id": "m"}, ("system", "operator_shutdown", True)),
        ({"collector_clean": True, "intent_id": "m", "intent_expires_ms": 60}, ("collector", "operator_shutdown", True)),
        ({"collector_clean": True, "intent_id": "m", "intent_expires_ms": 40}, ("collector", "operator_shutdown", False)),
        ({"previous_session": "1", "current_session": "2"}, ("collector", "unclean_exit", False)),
        ({"system_clean": True}, ("writer", "operator_shutdown", False)),
        ({}, ("unknown", "unknown", False)),
        ({"died": ["writer", "postgres"], "collector_clean": True, "intent_id": "m"}, ("postgres", "unclean_exit", False)),
        ({"died": ["redpanda"], "previous_boot": "a", "current_boot": "b"}, ("host", "host_reboot", False)),
    ],
)
def test_classify(spark, given, want):
    schema = "previous_boot string, current_boot string, previous_session string, current_session string, collector_clean boolean, system_clean boolean, intent_id string, intent_expires_ms long, now_ms long, host_intent boolean, died array<string>"
    base = dict.fromkeys(c.split()[0] for c in schema.split(", ")) | {"now_ms": 50}
    r = classify.classify_restarts(spark.createDataFrame([tuple((base | given).values())], schema)).first()
    assert (r.component, r.cause, r.planned) == want


# --- consolidation ---


def brute_merge(hour):
    data = sorted((r for r in hour if r[1] == "data"), key=lambda r: (r[3], r[0]))
    gap = sorted((r for r in hour if r[1] == "gap"), key=lambda r: (r[4] or 0, r[0]))
    out, i = [], 0
    for g in gap:
        while g[4] is None and i < len(data) or i < len(data) and g[4] is not None and data[i][2] < g[4]:
            out.append(data[i][0])
            i += 1
        if g[4] is None:
            pass
        out.append(g[0])
    return out + [d[0] for d in data[i:]]


@pytest.mark.parametrize("seed", range(3))
def test_merge_order(spark, seed):
    r = random.Random(seed)
    hour = []
    for i in range(40):
        gap = r.random() < 0.25
        hour.append((i, "gap" if gap else "data", r.randint(0, 50), r.randint(0, 20), r.randint(1, 60) if gap else None))
    e = env(spark, *({"row_id": i, "type": t, "received_at": rec, "raw_text": f'{{"a":{k}}}', "gap_start_ts": g} for i, t, rec, k, g in hour)).withColumns({"utc_date": F.lit("d"), "hour_no": F.lit(1)})
    got = [x.row_id for x in consolidate.merge_hours(e, ["row_id"]).orderBy("pos").collect()]
    assert got == brute_merge(hour)


def test_merge_keeps_a_single_file_and_late_gaps(spark):
    e = env(spark, {"raw_text": '{"a":9}'}, {"raw_text": '{"a":1}'}, {"type": "gap"}).withColumns({"utc_date": F.lit("d"), "hour_no": F.lit(1)})
    one = e.select(*consolidate.HOUR).distinct()
    assert [x.row_id for x in consolidate.merge_hours(e, ["row_id"], one).orderBy("pos").collect()] == [0, 1, 2]
    assert [x.row_id for x in consolidate.merge_hours(e, ["row_id"]).orderBy("pos").collect()] == [1, 0, 2]


def test_day_manifest(spark):
    h = spark.createDataFrame([("x", "s", "t", "d", 5, "present", 2, 0, ["b5"]), ("x", "s", "t", "d", 12, "present", 1, 0, ["b12"])], "exchange string, symbol string, stream string, utc_date string, hour_no int, status string, data_records long, gap_records long, sources array<string>")
    m = spark.createDataFrame([("x", "s", "t", "d", i) for i in range(24) if i not in (5, 12)], "exchange string, symbol string, stream string, utc_date string, hour_no int")
    r = consolidate.day_manifest(h, m).first()
    assert (r.total_records, r.data_records, r.gap_records, len(r.hours), r.source_files) == (25, 3, 22, 24, ["b12", "b5"]) and len(r.missing_hours) == 22


# --- two collectors ---


def test_coverage(spark):
    rows_ = [(1, "primary", "x", 100, 105), (2, "backup", "x", 100, 105), (3, "primary", "x", 130, 131), (4, "primary", "x", None, 1), (5, "primary", "restart_gap", 101, 105), (6, "primary", "x", 101, 111), (7, "primary", "x", 101, 120)]
    g = spark.createDataFrame([(i, "x", "s", "t", src, why, a and a * S, z * S) for i, src, why, a, z in rows_], "gap_no long, exchange string, symbol string, stream string, source string, reason string, gap_start_ts long, received_at long")
    d = spark.createDataFrame([("x", "s", "t", "backup", 100 * S), ("x", "s", "t", "backup", 112 * S), ("x", "s", "t", "primary", 116 * S)], "exchange string, symbol string, stream string, source string, received_at long")
    assert {r.gap_no: r.covered for r in coverage.suppress_covered(g, d).collect()} == {1: True, 2: False, 3: False, 4: False, 5: True, 6: False, 7: True}


def test_failover(spark):
    times = [0, 2, 4, 20, 22, 40, 42, 44, 46, 48, 50, 80]  # silence 4..20, a short run, silence 22..40, a long run
    d = spark.createDataFrame([("x", "s", "t", t * S) for t in times], "exchange string, symbol string, stream string, received_at long")
    got = {(r.active_from // S, r.active_to and r.active_to // S) for r in coverage.failover_intervals(d).collect()}
    assert got == {(9, 50), (55, None)}
    e = d.select("exchange", "symbol", "stream", F.explode(F.array(*map(F.lit, [5 * S, 10 * S, 49 * S, 51 * S, 90 * S]))).alias("received_at")).distinct().withColumns({"type": F.lit("data"), "source": F.lit("backup"), "row_id": F.col("received_at")})
    assert {r.row_id // S for r in coverage.route(e, coverage.failover_intervals(d)).collect()} == {10, 49, 90}


def test_route_over_a_failover_of_any_length(spark):
    day = 86_400 * S
    f = spark.createDataFrame([("x", "s", "t", 10 * day, None), ("x", "s", "u", 0, 5 * day), ("x", "s", "u", 7 * day, 8 * day)], "exchange string, symbol string, stream string, active_from long, active_to long")
    rows = [(i, "data", "x", "s", st, src, at * day) for i, (st, src, at) in enumerate([("t", "backup", 9), ("t", "backup", 110), ("t", "backup", 410), ("t", "backup", 9000), ("t", "primary", 3), ("u", "backup", 4), ("u", "backup", 5), ("u", "backup", 6), ("u", "backup", 7), ("v", "backup", 7)])]
    d = spark.createDataFrame(rows, "row_id long, type string, exchange string, symbol string, stream string, source string, received_at long")
    assert sorted(r.row_id for r in coverage.route(d, f).collect()) == [1, 2, 3, 4, 5, 8]


def test_windows_and_status(spark):
    d = spark.createDataFrame([("k", t, f) for t, f in ((1, True), (2, True), (3, None), (4, False), (60, True), (130, True))], "k string, t long, f boolean")
    assert rows(coverage.condition_windows(d, ["k"], "t", "f", 50)) == Counter({("k", 1, 2, 2): 1, ("k", 60, 130, 2): 1})
    assert coverage.condition_windows(d, ["k"], "t", "f", 50, 60).count() == 1
    s = spark.createDataFrame([(None, True), (95 * S, True), (50 * S, True), (99 * S, False)], "at long, up boolean").select(coverage.heartbeat_status(F.col("at"), F.col("up"), 100 * S, 10 * S).alias("s"))
    assert [r.s for r in s.collect()] == ["subscribed_silent", "alive", "subscribed_silent", "disconnected"]


# --- depth ---

BOOK = "exchange string, symbol string, day string, kind string, row_id long, received_at long, first_u long, last_u long, prev_u long, lid long, gap_start_ts long, gap_end_ts long"


def book(spark, snaps, diffs, windows=(), symbol="s"):
    data = [("x", symbol, "d", "snapshot", 900 + i, at, None, None, None, lid, None, None) for i, (at, lid) in enumerate(snaps)]
    data += [("x", symbol, "d", "diff", i, at, a, u, pu, None, None, None) for i, (at, a, u, pu) in enumerate(diffs)]
    data += [("x", symbol, "d", "gap", 800 + i, 0, None, None, None, None, s, e) for i, (s, e) in enumerate(windows)]
    return spark.createDataFrame(data, BOOK)


def test_depth_replay(spark):
    run = lambda *a: sorted((r.row_id, r.error) for r in depth.replay_any(book(spark, *a), ["exchange", "symbol", "day"]).collect())
    ok = [(1, 50, 101, 0), (2, 102, 103, 101)]
    assert run([(0, 100)], ok) == []
    broken = run([(0, 100)], [(1, 50, 101, 0), (2, 102, 103, 999)])
    assert len(broken) == 1 and "pu chain break" in broken[0][1] and "expected pu=101" in broken[0][1] and "got pu=999" in broken[0][1]
    assert "First diff does not span any snapshot sync point" in run([(0, 200)], [(1, 50, 100, 0)])[0][1]
    assert "no preceding snapshot" in run([], ok)[0][1]
    assert run([(0, 100), (5, 300)], [(1, 50, 101, 0), (9, 290, 305, 999)], [(3, 4)]) == []
    asof = lambda *a: [(r.row_id, r.error) for r in depth.replay_asof(book(spark, *a), ["exchange", "symbol", "day"]).orderBy("row_id").collect()]
    assert asof([(0, 100)], ok) == []
    assert asof([(0, 100)], [(1, 50, 101, 0), (2, 102, 103, 999)]) == [(1, "chain_break")]
    assert asof([(0, 100)], [(1, 50, 101, 0), (2, 102, 103, 999)], [(2, 2)]) == []
    assert asof([(5, 200)], [(1, 1, 2, 0), (6, 50, 100, 0)]) == [(0, "no_snapshot"), (1, "not_spanning")]


def walk(snaps, diffs, windows):
    """The replay as a walk: numbers of the diffs with an error."""
    lids, out, synced, last_u, last_at = [lid for _, lid in snaps], [], False, 0, 0
    touches = lambda a, z: any(s <= z and e >= a for s, e in windows if s <= e)
    for i, (at, a, u, pu) in sorted(enumerate(diffs), key=lambda x: (x[1][0], x[0])):
        spans = any(a <= lid + 1 <= u for lid in lids)
        if not synced:
            synced = spans
            if not spans and not touches(at, at):
                out.append(i)
        elif pu != last_u:
            if touches(last_at, at):
                synced = spans
            else:
                out.append(i)
        last_u, last_at = u, at
    return sorted(out)


def test_depth_replay_is_the_walk(spark):
    r, cases = random.Random(5), {}
    hour, all_rows = 3_600_000_000_000, None
    for k in range(12):
        at, u, diffs = 0, 100, []
        for _ in range(40):
            at += r.choice([1, 5, hour])
            size = r.randint(1, 4)
            diffs.append((at, u + 1, u + size, u if r.random() < 0.7 else u - 7))
            u += size
        snaps = [(0, r.randint(95, u + 5)) for _ in range(r.choice([0, 1, 3]))]
        windows = [(s, s + r.choice([-1, 0, 3, hour])) for s in (r.choice(diffs)[0] + r.choice([-1, 0, 1]) for _ in range(r.choice([0, 2, 5])))]
        cases[f"s{k}"] = walk(snaps, diffs, windows)
        b = book(spark, snaps, diffs, windows, f"s{k}")
        all_rows = b if all_rows is None else all_rows.unionByName(b)
    got = {k: [] for k in cases}
    for x in depth.replay_any(all_rows, ["exchange", "symbol", "day"]).collect():
        got[x.symbol].append(x.row_id)
    assert {k: sorted(v) for k, v in got.items()} == cases and any(cases.values())


def test_resync(spark):
    b = spark.createDataFrame([("x", "a", 10 * S), ("x", "b", 10 * S), ("x", "c", 10 * S), ("x", "a", 500 * S)], "exchange string, symbol string, broken_at long")
    probes = spark.createDataFrame([(9 * S, True), (12 * S, False), (20 * S, True), (561 * S, True)], "at long, good boolean")
    backup = spark.createDataFrame([("x", "a", 15 * S, 7), ("x", "a", 18 * S, 6), ("x", "a", 21 * S, 9), ("x", "b", 30 * S, 1)], "exchange string, symbol string, received_at long, last_u long")
    snaps = spark.createDataFrame([("x", "b", 19 * S, 50), ("x", "b", 25 * S, 51), ("x", "b", 26 * S, 52)], "exchange string, symbol string, received_at long, lid long")
    got = {(r.symbol, r.broken_at // S, r.status, r.sync_id, r.synced_at and r.synced_at // S) for r in depth.resync_points(b, probes, backup, snaps).collect()}
    assert got == {("a", 10, "backup", 7, 20), ("b", 10, "snapshot", 51, 25), ("c", 10, "snapshot_exhausted", None, None), ("a", 500, "producer_unhealthy", None, None)}


def test_depth_online():
    d = depth.DepthDetector()
    assert d.diff(1, 2, 0) == "no_sync_point"
    d.sync(10)
    assert [d.diff(1, 9, 0), d.diff(1, 10, 0), d.diff(9, 12, 0), d.diff(13, 14, 12), d.diff(20, 21, 19), d.diff(22, 23, 21)] == ["stale", "no_sync_diff_found", "ok", "ok", "pu_chain_break", "no_sync_point"]
    b = depth.DepthBuffer(2)
    for i in range(4):
        assert b.diff(i, i, i, i - 1) == []
    assert list(b.sync(2)) == [(1, "dropped_from:0"), (2, "no_sync_diff_found"), (3, "ok")]


# --- backfill, metrics, state, time ---


def test_backfill(spark):
    m = spark.createDataFrame([("x", "s", "trades", 0), ("x", "s", "funding_rate", 3_600_000)], "exchange string, symbol string, stream string, start_ms long")

    def provider(exchange, symbol, stream, start, end):
        if stream == "funding_rate":
            raise OSError("gone")
        return ['{"T":0}', '{"T":3600000}', '{"T":3599999}', '{"x":1}']

    e = backfill.backfill_envelopes(backfill.fetch_pages(m, provider), 5, "b")
    assert {(r.exchange_ts, r._offset, r.raw_text) for r in e.collect()} == {(0, 0, '{"T":0}'), (0, 1, '{"x":1}'), (3_599_999, 2, '{"T":3599999}')}
    pages = lambda at: [(i, str(i)) for i in range(at, min(at + 3, 11))]
    assert [i for i, _ in backfill.fetch_by_id(pages, 2, 9, 3)] == list(range(2, 10))


def test_interpolation(spark):
    p = spark.createDataFrame([("s", 1500, 4500, 10.0, 16.0), ("t", 1100, 1900, 0.0, 1.0)], "symbol string, t0 long, t1 long, p0 double, p1 double")
    got = backfill.interpolate_grid(p, ["symbol"], ["p"]).select("symbol", "t", backfill.price_text(F.col("p")), "next_funding")
    assert sorted(map(tuple, got.collect())) == [("s", 2000, "11.00000000", 28_800_000), ("s", 3000, "13.00000000", 28_800_000), ("s", 4000, "15.00000000", 28_800_000)]


def test_quantile(spark):
    d = spark.createDataFrame([("a", v) for v in (1, 3, 7, 20, 20000)] + [("b", None)], "k string, v long")
    h = metrics.histogram(d, ["k"], "v", (5, 10, 100))
    assert rows(h) == Counter({("a", 5, 2): 1, ("a", 10, 3): 1, ("a", 100, 4): 1, ("a", None, 5): 1})
    assert metrics.histogram_quantile(h, ["k"], 0.5).first().value == pytest.approx(7.5)
    assert metrics.histogram_quantile(h, ["k"], 0.99).first().value == 100


def test_state(spark):
    s = spark.createDataFrame([("t", 0, "f", 5, 10, 1), ("t", 0, "f", 9, 8, 0)], "topic string, partition_id int, file_path string, high_water_offset long, file_byte_size long, updated_at long")
    once = state.upsert_file_state(s, s)
    assert rows(once) == Counter({("t", 0, "f", 9, 10, 1): 1}) and rows(state.upsert_file_state(once, s)) == rows(once)
    i = spark.createDataFrame([("a", 1, None, 10), ("b", 2, None, 3), ("c", 3, 9, None)], "maintenance_id string, created_at long, consumed_at long, expires_at long")
    assert state.active_intent(i).first().maintenance_id == "b" and state.active_intent(i, F.lit(5)).first().maintenance_id == "a"
    led = spark.createDataFrame([(None,), (0,), (8 * 86_400 * S,)], "ts_ns long")
    assert state.prune(led, 8 * 86_400 * S).count() == 2
    c = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "k string, updated_at long, v string")
    assert state.upsert_checkpoint(c.limit(0), c, ["k"]).first().v == "new"


def test_time():
    day = 1_704_067_200_000
    assert tu.period("day", "2024-01-01") == (day, day + tu.DAY_MS - 1)
    assert tu.period("week", "2024-W01") == (day, day + 7 * tu.DAY_MS - 1)
    assert tu.period("hour", "2024-01-01T05")[0] == day + 5 * tu.HOUR_MS
    assert tu.period("range", since="2024-01-01T00:00:00Z", until="2024-01-01T01:00:00+01:00") == (day, day)
    for bad in (("day", "x"), ("month", "1"), ("range", None)):
        with pytest.raises(ValueError):
            tu.period(*bad)
    assert tu.seconds_literal("5m") == 300 and tu.seconds_literal("30s") == 30
    with pytest.raises(ValueError):
        tu.seconds_literal("1h")
    assert tu.next_daily_run(0) == 9_000_000_000_000 and tu.next_daily_run(9_000_000_000_000) == 95_400_000_000_000


def test_time_columns(spark):
    d = spark.createDataFrame([(-1,), (0,), (1_700_000_000_123_456_789,)], "ns long")
    got = [tuple(map(str, r)) for r in d.select(tu.ns_to_ms("ns"), tu.ns_date("ns"), tu.ns_hour("ns"), tu.latency_ms("ns", F.lit(5).cast("long"))).collect()]
    assert got == [("-1", "1969-12-31", "23", "0"), ("0", "1970-01-01", "0", "0"), ("1700000000123", "2023-11-14", "22", "1700000000118")]


def test_payload_keys(spark):
    d = spark.createDataFrame([("trades", '{"a":9007199254740993}', 1), ("depth", '{"u":"7"}', 2), ("bookticker", '{"u":5}', 3), ("trades", "{}", 4), ("funding_rate", "x", None)], "stream string, raw_text string, ts long")
    got = [tuple(r) for r in d.select(natural_key("stream", "raw_text", "ts"), sort_key("stream", "raw_text", "ts"), json_long("raw_text", "$.a")).collect()]
    assert got == [(9007199254740993, 9007199254740993, 9007199254740993), (7, 7, None), (5, 3, None), (-1, 4, None), (-1, 0, None)]


# --- frames ---


def test_long_intervals_meet_in_wide_buckets(spark):
    r = random.Random(3)
    spans = lambda n: [(i, r.randrange(10), s, s + r.choice([0, 5, 3_000, 5_000_000, 10**12])) for i, s in enumerate(r.randrange(-10**6, 10**7) for _ in range(n))]
    a, b = spans(60), spans(60)
    left = spark.createDataFrame(a, "i long, k long, s long, e long")
    right = spark.createDataFrame(b, "j long, k long, s2 long, e2 long")
    got = Counter((x.i, x.j) for x in overlapping(left, right, ["k"], ("s", "e"), ("s2", "e2"), 10, 3).collect())
    assert got == Counter((i, j) for i, k, s, e in a for j, k2, s2, e2 in b if k == k2 and s - 3 <= e2 and e + 3 >= s2)


def test_usual_frames_need_no_walk(spark):
    from tidelake.functions.frames import _data, raw_data

    frames = ['{"stream":"a@depth","data":{"x":"}","y":[1, 2]}}', ' { "stream" : "a@depth" , "data" : "q\\"}" } ', '{"data":1,"stream":"s"}', '{"stream":"s","data":1,"data":2}', '{"stream":"a\\"b","data":{"d":1}}', '{"stream":"s","data":', '{"stream":"s","data":null}', "x", None, '{"id":1,"stream":"s","data":[{}]}']
    got = [r.d for r in spark.createDataFrame([(i, f) for i, f in enumerate(frames)], "i int, f string").orderBy("i").select(raw_data(F.col("f")).alias("d")).collect()]
    assert got == [_data(f) for f in frames] and got[0] == '{"x":"}","y":[1, 2]}' and got[6] == "null"


def test_value_at():
    cases = {'{"a":"}"} ,1': '{"a":"}"}', ' "q\\"x" ]': '"q\\"x"', "12.50 , 3": "12.50", "true}": "true", '[1,{"b":[2]}],': '[1,{"b":[2]}]', '{"open": 1': None}
    assert {k: value_at(k, 0) for k in cases} == cases


def test_route(spark):
    f = ['{"stream":"btcusdt@aggTrade","data":{"p": "0.00100000","s":"BTCUSDT","x":"\\u00e9 }{"}}', '{"data":{"o":{"s":"ETHUSDT"}},"stream":"!forceOrder@arr"}', '{"data":{"o":{"s":"XUSDT"}},"stream":"!forceOrder@arr"}', '{"stream":"btcusdt@nothing","data":{}}', '{"stream":"btcusdt@depth@100ms","x":{"data":1},"data":[1, 2]}', None]
    got = route_frames(spark.createDataFrame([(x,) for x in f], "frame string"), "frame", ["BTCUSDT", "ethusdt"])
    assert [(r.stream, r.symbol, r.raw_text) for r in got.collect()] == [("trades", "btcusdt", '{"p": "0.00100000","s":"BTCUSDT","x":"\\u00e9 }{"}'), ("liquidations", "ethusdt", '{"o":{"s":"ETHUSDT"}}'), ("depth", "btcusdt", "[1, 2]")]
