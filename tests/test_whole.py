"""Registered queries do the whole job on tables that go beyond the usual ones."""

from datetime import datetime

from tidelake.plans import lake, problems

S = 1_000_000_000
ENV = "row_id long, type string, exchange string, symbol string, stream string, received_at long, exchange_ts long, collector_session_id string, session_seq long, raw_text string, _topic string, _partition int, _offset long, gap_start_ts long, gap_end_ts long, reason string, detail string, file_path string"
DAY = 1_612_915_200_000  # 2021-02-10, after NOW_MS


def write_env(spark, base, *data):
    """envelopes.parquet in base of the given fields."""
    names = [c.split()[0] for c in ENV.split(", ")]
    rows = [tuple((dict.fromkeys(names) | {"row_id": i, "type": "data", "exchange": "x", "symbol": "s", "stream": "trades", "received_at": i * S} | d).values()) for i, d in enumerate(data)]
    spark.createDataFrame(rows, ENV).write.parquet(f"{base}/envelopes.parquet")
    return str(base)


def test_missing_hours_of_days_after_the_constant_now(spark, tmp_path):
    files = [(f"archive/x/s/trades/2021-02-10/hour-{h}.jsonl.zst", 10, 1, None, datetime(2021, 2, 10, 5, 30)) for h in (0, 2)]
    spark.createDataFrame(files, "file_path string, size_bytes long, n_records long, modified_at timestamp, listed_at timestamp").write.parquet(f"{tmp_path}/archive_files.parquet")
    write_env(spark, tmp_path, *({"file_path": f[0]} for f in files))
    for q in (lake.missing_hours, lake.backfillable_hours):
        assert sorted(r.hour_no for r in q(spark, str(tmp_path)).collect()) == [1, 3, 4, 5]
    assert lake.missing_hour_envelopes(spark, str(tmp_path)).count() == 4
    assert [r.missing_hours for r in lake.day_manifest(spark, str(tmp_path)).collect()] == ["1,3,4,5"]


def test_component_gaps_end_after_they_start(spark, tmp_path):
    at = write_env(spark, tmp_path, *({"collector_session_id": c, "received_at": (DAY + ms) * 1_000_000} for c, ms in (("p-b_1", 0), ("q-b_1", 7000))))
    got = {r.component: (r.start_ms, r.end_ms) for r in lake.component_runtime_gaps(spark, at).collect()}
    assert got == {"p-b_1": (DAY, DAY + 7000), "q-b_1": (DAY + 7000, DAY + 7000)}


def test_copies_with_and_without_session_count_once(spark, tmp_path):
    both = {"exchange_ts": 5, "collector_session_id": "c", "_topic": "x.trades", "_partition": 0}
    lost = both | {"collector_session_id": None}
    data = [both | {"session_seq": 1, "_offset": 7}, lost | {"_offset": 7}, lost | {"_offset": 7}, lost | {"session_seq": 1, "_offset": 8}, lost | {"_offset": 9}]
    data += [both | {"session_seq": 2, "_offset": 9, "exchange_ts": None}, both | {"session_seq": 2, "_topic": None}]  # told by a row that isn't counted
    data += [lost | {"_offset": 7, "stream": "depth"}, both | {"session_seq": 1, "_topic": None, "stream": "depth"}]  # another stream's numbers
    at = write_env(spark, tmp_path, *data)
    spark.createDataFrame([], "exchange string, symbol string, stream string, hour_start_ms long, last_received_at long").write.parquet(f"{tmp_path}/stream_checkpoint.parquet")
    assert {r.stream: r.n_final for r in problems.p2_counts(spark, at).collect()} == {"trades": 3, "depth": 2}


def test_funding_on_every_second_between_all_readings(spark, tmp_path):
    data = [{"stream": "funding_rate", "exchange_ts": 1000 * t + 500, "raw_text": f'{{"p":"{p}","i":"1","P":"1"}}'} for t, p in ((0, 10), (4, 50), (704, 50))]
    at = write_env(spark, tmp_path, *data)
    got = {r.t: r.mark for r in lake.QUERIES["funding_interpolation_whole"](spark, at).collect()}
    assert sorted(got) == [1000 * t for t in range(1, 705)] and [got[1000 * t] for t in range(1, 6)] == [15, 25, 35, 45, 50]


def test_short_silences_and_failovers_are_found(spark, tmp_path):
    data = [{"received_at": t * S, "_topic": "x.trades"} for t in (0, 40, 100, 101, 115, 200)] + [{"received_at": 60 * S, "_topic": "backup.x.trades"}]
    gaps = [{"type": "gap", "symbol": o, "gap_start_ts": a * S, "gap_end_ts": z * S} for o, a, z in (("p", 41, 50), ("q", 45, 55), ("q", 10, 12), ("r", 0, 1))]
    at, q = write_env(spark, tmp_path, *data, *gaps), lake.QUERIES
    assert sorted(r.silent_from // S for r in q["silence_uncovered_by_any_whole"](spark, at).collect()) == [60, 115]
    assert sorted(r.gap_start_ts // S for r in q["both_silent_whole"](spark, at).collect()) == [0, 60, 115]
    assert [(r.active_from // S, r.active_to) for r in q["failover_intervals_whole"](spark, at).collect()] == [(5, None)]
    assert {r.source: r.n_rows for r in q["source_routing_whole"](spark, at).collect()} == {"primary": 6, "backup": 1}


def test_hours_of_one_side_only_disagree(spark, tmp_path):
    files = [(f"archive/x/s/trades/2021-02-01/hour-{h}.jsonl.zst", 10, 1, None, datetime(2021, 2, 2)) for h in (0, 1)]
    spark.createDataFrame(files, "file_path string, size_bytes long, n_records long, modified_at timestamp, listed_at timestamp").write.parquet(f"{tmp_path}/archive_files.parquet")
    groups = [("x", "s", "trades", "2021-02-01", h, b, l, []) for h, b, l in ((0, "b", []), (2, None, ["l"]), (3, None, []))]
    spark.createDataFrame(groups, "exchange string, symbol string, stream string, utc_date string, hour_no int, base string, late array<string>, backfill array<string>").write.parquet(f"{tmp_path}/hour_file_groups.parquet")
    assert sorted(r.hour_no for r in lake.hour_groups_check(spark, str(tmp_path)).collect()) == [1, 2]
