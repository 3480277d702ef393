"""The five general problems against brute force, with nulls, ties, repeats, empty tables and clashing names."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidelake.functions.names import norm, path_columns
from tidelake.operators import compact, diff, late_counts
from tidelake.operators.components import min_labels
from tidelake.operators.intervals import covered_and_gaps
from tidelake.streaming import exactly_once


def rows(df):
    return Counter(map(tuple, df.collect()))


# --- 1: intervals ---


def brute_periods(data, max_gap=None):
    by = defaultdict(list)
    for k, s, e in data:
        if s is not None and e is not None and s <= e:
            by[k].append((s, e))
    out = Counter()
    for k, spans in by.items():
        done = []
        for s, e in sorted(spans):
            if done and s <= done[-1][1] + 1:
                done[-1][1] = max(done[-1][1], e)
            else:
                done.append([s, e])
        out.update(("period", k, s, e) for s, e in done)
        out.update(("gap", k, a[1] + 1, b[0] - 1) for a, b in zip(done, done[1:]) if max_gap is None or b[0] - 1 - a[1] < max_gap)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_periods_match_brute_force(spark, seed):
    r = random.Random(seed)
    data = []
    for _ in range(400):
        s = r.choice([None, r.randint(-3000, 3000)]) if r.random() < 0.1 else r.randint(-3000, 3000)
        e = None if r.random() < 0.05 or s is None else s + r.choice([-3, 0, 0, 1, 5, 40])
        data.append((r.choice(["a", "b", None]), s, e))
    data += data[:50]
    df = spark.createDataFrame(data, "k string, s long, e long")
    assert rows(covered_and_gaps(df, ["k"], "s", "e", block=100)) == brute_periods(data)
    assert rows(covered_and_gaps(df, ["k"], "s", "e", max_gap=30, block=7)) == brute_periods(data, 30)


def test_periods_edges(spark):
    top = 2**63 - 1
    df = spark.createDataFrame([("a", 5, top, 1), ("a", 1, 3, 1), ("a", 4, 4, 2)], "k string, s long, e long, kind int")
    assert rows(covered_and_gaps(df, ["k"], "s", "e")) == Counter({("period", "a", 1, top): 1})
    assert covered_and_gaps(df.limit(0), ["k"], "s", "e").count() == 0


# --- 2: late events ---

COLS = "k string, ets long, rec long, seen long, src string, ver long"


def cells_of(df):
    return late_counts.counter_cells(df, ["k"], F.col("ets"), F.col("rec"), F.col("seen"), F.col("src"), F.col("ver"), 1000, 2000)


def brute_counts(data):
    best, late, cut = {}, set(), set()
    for k, ets, rec, seen, src, ver in data:
        if ets is None:
            continue
        p = ets // 1000 * 1000
        c = 0
        if rec is not None and seen is not None and rec > seen:
            c = 2 if rec // 1_000_000 >= p + 3000 else 1
            (cut if c == 2 else late).add((k, p))
        best[(k, p, src, ver)] = min(c, best.get((k, p, src, ver), 9))
    out = {}
    for (k, p, _, _), c in best.items():
        out.setdefault((k, p), [0, 0, 0])[c] += 1
    return Counter({(k, p, *v, (k, p) in late, (k, p) in cut): 1 for (k, p), v in out.items()})


def test_counters_match_and_are_idempotent(spark):
    r = random.Random(5)
    data = []
    for i in range(600):
        ets = None if i % 40 == 0 else r.randint(-2000, 4000)
        rec = None if i % 37 == 0 else r.randint(0, 9000) * 1_000_000
        data.append((r.choice("ab"), ets, rec, r.choice([None, 3_000_000_000]), r.choice("xy"), r.randint(-5, 200)))
    want = brute_counts(data)
    df = spark.createDataFrame(data, COLS)
    cells = cells_of(df)
    cols = ["k", "period_ms", "n_on_time", "n_corrected", "n_cut_off", "has_corrected", "has_cut_off"]
    assert rows(late_counts.period_counts(cells, ["k"]).select(*cols)) == want
    half, rest = df.where("ver < 60"), df.where("ver >= 30")
    merged = late_counts.merge_cells(cells_of(rest), cells_of(half), cells_of(rest), keys=["k"])
    assert rows(late_counts.period_counts(merged, ["k"]).select(*cols)) == want
    assert late_counts.period_counts(cells_of(df.limit(0)), ["k"]).count() == 0


def test_counters_with_nulls_and_clashing_names(spark):
    data = [(None, 5, None, None, None, None, "x", 1), (None, 7, None, None, None, None, "y", 2), ("a", 5, 1, 0, "s", 1, "x", 3)]
    df = spark.createDataFrame(data, COLS + ", on_bits string, period_ms int")
    got = late_counts.period_counts(cells_of(df), ["k"]).select("k", "n_on_time", "n_corrected")
    assert rows(got) == Counter({(None, 1, 0): 1, ("a", 0, 1): 1})


def test_checkpoints_take_the_greatest(spark):
    e = spark.createDataFrame([("a", 0, 3, "mine"), ("b", 0, 1, "mine")], "k string, h long, salt int, v string")
    c = spark.createDataFrame([("a", 0, 5), ("a", 0, 9), ("a", 0, None), ("b", 7, 1)], "k string, h long, v long")
    assert rows(late_counts.attach_checkpoints(e, c, ["k"], "h", "v", "salt").select("k", "v")) == Counter({("a", 9): 1, ("b", None): 1})


# --- 3: small files ---


def listing(spark, data):
    df = spark.createDataFrame([(p, s, 1, t, t) for p, s, t in data], "file_path string, size_bytes long, n_records long, modified_at long, listed_at long")
    return compact.latest_listing(df).withColumns(path_columns("file_path"))


def test_plan_takes_the_right_files(spark):
    d = "archive/X/ sym /trades/2021-01-01/"
    data = [
        (d + "hour-10.jsonl.zst", 100, 1), (d + "hour-10.jsonl.zst", 0, 0), (d + "hour-2.jsonl.zst", 50, 1), (d.replace("X", "x") + "hour-02.late-10.jsonl.zst", 7, 1),
        (d + "hour-2.late-9.jsonl.zst", 8, 1), (d + "hour-3.backfill-1.jsonl.zst", 8191, 1), (d + "hour-4.jsonl.zst", 8192, 1), (d + "hour-5.jsonl.zst", 0, 1),
        (d + "hour-5.jsonl.zst.tmp", 9, 1), (d + "hour-2.jsonl.zst.sha256", 9, 1), (d + "2021-01-01.jsonl.zst", 0, 1), (d + "hour-99.jsonl.zst", 9, 1),
        ("archive/x/one/trades/2021-01-01/hour-1.jsonl.zst", 9, 1), ("archive/x/day/trades/2021-01-01/hour-1.jsonl.zst", 9, 1), ("archive/x/day/trades/2021-01-01/hour-2.jsonl.zst", 9, 1),
        ("archive/x/day/trades/2021-01-01/2021-01-01.jsonl.zst", 1, 1), (None, 3, 1),
    ]
    got = compact.plan(listing(spark, data)).orderBy("source_no").collect()
    assert [(r.file_path.split("/")[-1], r.source_no, r.target_offset) for r in got] == [
        ("hour-2.jsonl.zst", 1, 0), ("hour-2.late-9.jsonl.zst", 2, 50), ("hour-02.late-10.jsonl.zst", 3, 58), ("hour-3.backfill-1.jsonl.zst", 4, 65), ("hour-10.jsonl.zst", 5, 8256),
    ]
    assert {r.target_path for r in got} == {"archive/x/sym/trades/2021-01-01/part-00000.jsonl.zst"}
    assert compact.plan(listing(spark, data).withColumns({"rank": F.lit("x"), "files0": F.lit(1), "bytes": F.lit(1)})).count() == 5
    parts = compact.plan(listing(spark, data), target_bytes=60).orderBy("source_no").collect()
    assert [r.part for r in parts] == [0, 0, 0, 1, 137] and parts[3].target_offset == 0
    assert compact.plan(listing(spark, data[:1]).limit(0)).count() == 0


# --- 4: differences ---

SIDE = "id long, v long, name string, n long, other string"


def test_differences(spark):
    a = spark.createDataFrame([(1, 1, "A", 5, "x"), (1, 2, " b", 6, "x"), (2, 1, "c", 1, "x"), (3, 1, "d", None, "q"), (None, 1, "n", 1, ""), (5, None, "z", 1, ""), (6, 1, "e", 1, ""), (6, 1, "e", 1, "")], SIDE)
    b = spark.createDataFrame([(1, 9, "B ", 7, "y"), (3, 1, "D", None, "x"), (4, 1, "e", 1, "x"), (None, 1, "m", 1, ""), (5, 1, "z", 2, ""), (6, 0, "old", 9, ""), (6, 2, "E", 1, "")], SIDE)
    out = diff.diff_copies(a, b, "id", "v", ["name", "n"], {"name": norm})
    got = {r.id: (r.status, [tuple(x) for x in r.differences]) for r in out.collect()}
    assert got == {1: ("differs", [("n", "6", "7")]), 2: ("left_only", []), 4: ("right_only", []), None: ("differs", [("name", "n", "m")]), 5: ("differs", [("n", "1", "2")])}
    assert diff.diff_copies(a.limit(0), b.limit(0), "id", "v", ["n"]).count() == 0
    assert diff.diff_copies(a.limit(0), b, "id", "v", ["n"]).where("status <> 'right_only'").count() == 0
    assert diff.gap_copy_rules()["detail"] is not None


# --- 5: exactly once ---


def brute_components(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in list(parent) if find(x) != x}


@pytest.mark.parametrize("n,m", [(60, 40), (200, 150), (30, 29)])
def test_components(spark, n, m):
    r = random.Random(n)
    pairs = [(r.randrange(n), r.randrange(n)) for _ in range(m)] if m != 29 else [(i, i + 1) for i in range(29)]
    got = dict(map(tuple, min_labels(spark.createDataFrame(pairs + pairs[:3] + [(None, 1), (2, 2)], "a long, b long")).collect()))
    assert got == brute_components(pairs)


def test_no_edges(spark):
    assert min_labels(spark.createDataFrame([], "a long, b long")).count() == 0


IDS = "row_id long, at long, s string, b string"


@pytest.mark.parametrize("watermark", ["1 second", "10 days"])
def test_exactly_once_over_many_batches(spark, tmp_path, watermark):
    r = random.Random(7)
    hour = 3_600_000_000_000
    data = []
    for i in range(300):
        s = None if r.random() < 0.2 else f"s{r.randrange(150)}"
        b = None if r.random() < 0.2 else f"b{r.randrange(200)}"
        if i % 3 == 0 and i > 100:
            s = "hot"
        data.append((i, None if i % 50 == 0 else (i // 10 + r.choice([0, 0, -20])) * hour, s, b))
    for k in range(6):
        spark.createDataFrame(data[k::6], IDS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = exactly_once.read_stream(spark, str(tmp_path / "in"), 1)
    ids = [exactly_once.identifier("s", F.col("s")), exactly_once.identifier("b", F.col("b"))]
    got = dict(map(tuple, exactly_once.repeated_rows(spark, stream, "row_id", "at", ids, watermark=watermark, shards=3).collect()))
    pairs, first = [], {}
    for i, _, s, b in data:
        for key in (("s", s), ("b", b)):
            if key[1] is not None:
                pairs.append((first.setdefault(key, i), i))
    assert got == {k: v for k, v in brute_components(pairs).items() if k != v}


def test_exactly_once_goes_on_from_its_checkpoint(spark, tmp_path):
    base = str(tmp_path / "state")
    ids = [exactly_once.identifier("s", F.col("s"))]
    for part in ([(1, 5, "a", None), (2, 6, "b", None)], [(3, 7, "a", None), (4, 8, None, None)]):
        spark.createDataFrame(part, IDS).write.mode("append").parquet(str(tmp_path / "in"))
        out = exactly_once.message_links(spark, exactly_once.read_stream(spark, str(tmp_path / "in")), "row_id", "at", ids, checkpoint=base)
    assert rows(out) == Counter({(3, 1): 1})


def test_exactly_once_with_nulls_and_other_columns(spark, tmp_path):
    data = [(None, 1, "a", None, 1, 1), (1, None, "a", None, 1, 1), (2, 5, "a", "b", 2, 2), (2, 5, "a", "b", 2, 2), (3, None, None, None, 3, 3)]
    spark.createDataFrame(data, IDS + ", owner int, h1 int").write.parquet(str(tmp_path / "in"))
    stream = exactly_once.read_stream(spark, str(tmp_path / "in"))
    ids = [exactly_once.identifier("s", F.col("s")), exactly_once.identifier("b", F.col("b"))]
    assert rows(exactly_once.repeated_rows(spark, stream, "row_id", "at", ids)) == Counter({(2, 1): 1})


def test_exactly_once_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], IDS).write.parquet(str(tmp_path / "in"))
    stream = exactly_once.read_stream(spark, str(tmp_path / "in"))
    assert exactly_once.repeated_rows(spark, stream, "row_id", "at", [exactly_once.identifier("s", F.col("s"))]).count() == 0


def test_state_is_bounded_by_the_watermark(spark, tmp_path):
    """Ten times the history: the state holds what lies within the watermark, and copies of any age are found."""
    hour = 3_600_000_000_000
    ids, base, n = [exactly_once.identifier("s", F.col("s"))], str(tmp_path / "base"), 0
    for batches in (1, 3, 6):
        for _ in range(batches):
            part = [(n * 100 + i, n * 2 * hour, "s0-1" if i == 0 and n % 4 == 0 else f"s{n}-{i}", None) for i in range(100)]
            spark.createDataFrame(part, IDS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            n += 1
        stream = exactly_once.read_stream(spark, str(tmp_path / "in"), 1)
        out = exactly_once.message_links(spark, stream, "row_id", "at", ids, watermark="1 hour", shards=2, checkpoint=base)
        with exactly_once.state_store(spark):
            held = spark.read.format("statestore").load(f"{base}/state").agg(F.sum(F.length("value.groupState.h1") / 8)).first()[0]
        assert held <= 300
    assert rows(out) == Counter({(1, 0): 1, (800, 400): 1, (400, 0): 1})
    with pytest.raises(ValueError, match="shards"):
        exactly_once.message_links(spark, stream, "row_id", "at", ids, shards=3, checkpoint=base)


def test_one_row_of_each_message_is_kept(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "x"), (None, "x")], "row_id long, v string")
    gone = spark.createDataFrame([(3, 1)], "row_id long, kept long")
    assert rows(exactly_once.exactly_once(d, gone, "row_id")) == Counter({(1, "a"): 1, (2, "b"): 1, (None, "x"): 2})


def test_rows_of_a_hot_identifier_pass_in_portions(monkeypatch):
    """However many rows an identifier has, a shard takes them in one portion after the other."""
    import pandas as pd

    class State:
        exists, kept = False, None

        def getCurrentWatermarkMs(self):  # noqa: N802
            return 5

        def update(self, v):
            self.kept = v

    monkeypatch.setattr(exactly_once, "FOLD", 10)
    frames = [pd.DataFrame({"h1": [7] * 6, "h2": [8] * 6, "row_id": range(i * 6, i * 6 + 6), "seen_ms": [i] * 6}) for i in range(9)]
    state = State()
    out = pd.concat(exactly_once._seen((0,), iter(frames), state))
    assert len(out[out.kind == "link"]) == 53 and out[out.kind == "opened"].row_id.tolist() == [0]
    assert set(out[out.kind == "link"].owner) == {0} and all(len(x) == 8 for x in state.kept)


def test_counters_follow_a_stream(spark, tmp_path):
    from tidelake.streaming.late_counts_stream import CounterTable

    r = random.Random(11)
    data = [(r.choice("ab"), r.randint(0, 4000), r.randint(0, 9000) * 1_000_000, 3_000_000_000, r.choice("xy"), r.randint(0, 150)) for _ in range(200)]
    parts = [data[:80], data[60:150], data[140:], data[:30]]  # parts overlap: rows are delivered again
    for p in parts:
        spark.createDataFrame(p, COLS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(COLS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    t = CounterTable(spark, str(tmp_path / "cells"), ["k"], 1000, 2000)
    t.follow(stream, str(tmp_path / "cp"), "ets", "rec", "seen", "src", "ver").awaitTermination()
    cols = ["k", "period_ms", "n_on_time", "n_corrected", "n_cut_off", "has_corrected", "has_cut_off"]
    assert rows(late_counts.period_counts(t.read(), ["k"]).select(*cols)) == brute_counts(data)
    t.compact(2)
    assert rows(late_counts.period_counts(t.read(), ["k"]).select(*cols)) == brute_counts(data)
