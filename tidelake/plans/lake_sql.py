"""The lake queries in SQL: plain windows over whole keys, joins and anti joins."""

from __future__ import annotations

from tidelake.functions.reasons import EXPLAINS
from tidelake.operators.metrics import LATENCY_BUCKETS

NOW_MS = 1_612_400_000_000
RESTART_NS = 1_612_180_800_000_000_000
K = "exchange, symbol, stream"
DAY = f"{K}, utc_date"


def _n(c: str) -> str:
    return f"lower(trim({c}, ' \t\r\n'))"


def _j(path: str, kind: str = "BIGINT") -> str:
    return f"TRY_CAST(json_extract_string(raw_text, '{path}') AS {kind})"


_NAMES = f"{_n('exchange')} AS exchange, {_n('symbol')} AS symbol, {_n('stream')} AS stream"
_HOURLY = r"regexp_matches(file, '^hour-[0-9]{1,2}(\.(late|backfill)-[0-9]+)?\.jsonl\.zst$')"
_KIND = rf"CASE WHEN file = utc_date || '.jsonl.zst' THEN 'daily' WHEN {_HOURLY} THEN CASE WHEN file LIKE '%.late-%' THEN 'late' WHEN file LIKE '%.backfill-%' THEN 'backfill' ELSE 'base' END ELSE 'other' END"
_HOUR_NO = r"CASE WHEN file LIKE 'hour-%' THEN TRY_CAST(regexp_extract(file, '^hour-([0-9]{1,2})\.', 1) AS INTEGER) END"

E = f"""e AS (SELECT *, string_split(file_path, '/')[-2] AS utc_date, string_split(file_path, '/')[-1] AS file,
    CASE WHEN _topic LIKE 'backup.%' THEN 'backup' WHEN _topic IS NOT NULL AND _topic <> 'backfill' THEN 'primary' END AS source,
    received_at // 1000000 AS ms
  FROM (SELECT * EXCLUDE (exchange, symbol, stream), {_NAMES} FROM envelopes)),
f AS (SELECT *, {_KIND} AS kind, {_HOUR_NO} AS hour_no FROM e WHERE file_path IS NOT NULL)"""

L = f"""l0 AS (SELECT file_path, arg_max(size_bytes, listed_at) AS size_bytes FROM archive_files WHERE file_path IS NOT NULL GROUP BY 1),
l1 AS (SELECT *, string_split(file_path, '/') AS p FROM l0),
l2 AS (SELECT file_path, size_bytes, {_n('p[-5]')} AS exchange, {_n('p[-4]')} AS symbol, {_n('p[-3]')} AS stream, p[-2] AS utc_date, p[-1] AS file FROM l1),
l AS (SELECT *, {_KIND} AS kind, {_HOUR_NO} AS hour_no, TRY_CAST(nullif(regexp_extract(file, '\\.(late|backfill)-([0-9]+)\\.', 2), '') AS INTEGER) AS seq FROM l2)"""

_BREAKS = {
    "trades": f"SELECT *, {_j('$.a')} AS val, lag({_j('$.a')}) OVER w AS last FROM f WHERE type = 'data' AND stream = 'trades' AND {_j('$.a')} >= 0 WINDOW w AS (PARTITION BY {{0}} ORDER BY file, row_id)",
    "depth": f"SELECT *, {_j('$.pu')} AS val, lag({_j('$.u')}) OVER w AS last FROM f WHERE type = 'data' AND stream = 'depth' AND {_j('$.u')} >= 0 AND {_j('$.pu')} >= 0 WINDOW w AS (PARTITION BY {{0}} ORDER BY file, row_id)",
    "bookticker": f"SELECT *, {_j('$.u')} AS val, max({_j('$.u')}) OVER (PARTITION BY {{0}} ORDER BY file, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM f WHERE type = 'data' AND stream = 'bookticker' AND {_j('$.u')} >= 0",
}


def _all_breaks(scope: str) -> str:
    a, b, c = (x.format(scope) for x in _BREAKS.values())
    return f"""b AS (SELECT *, 'a' AS field, last + 1 AS expected, val - last - 1 AS missing FROM ({a}) WHERE val <> last + 1
      UNION ALL SELECT *, 'pu', last, 0 FROM ({b}) WHERE val <> last UNION ALL SELECT *, 'u', last, 0 FROM ({c}) WHERE val < last)"""


SQL: dict[str, str] = {}

SQL["trade_id_breaks"] = f"WITH {E} SELECT {DAY}, file, row_id, last + 1 AS expected, val AS actual, val - last - 1 AS missing, received_at FROM ({_BREAKS['trades'].format(DAY)}) WHERE val <> last + 1"
SQL["depth_chain_breaks"] = f"WITH {E} SELECT {DAY}, file, row_id, last AS expected, val AS actual, received_at FROM ({_BREAKS['depth'].format(DAY)}) WHERE val <> last"
SQL["bookticker_backward"] = f"WITH {E} SELECT {DAY}, file, row_id, last AS expected, val AS actual, received_at FROM ({_BREAKS['bookticker'].format(DAY)}) WHERE val < last"
SQL["continuity_summary"] = f"""WITH {E}, {_all_breaks(DAY)} SELECT {DAY}, n AS records, coalesce(m, 0) AS breaks FROM
 (SELECT {DAY}, count(*) AS n FROM f WHERE type = 'data' AND stream IN ('trades', 'depth', 'bookticker') GROUP BY ALL) LEFT JOIN (SELECT {DAY}, count(*) AS m FROM b GROUP BY ALL) USING ({DAY})"""
SQL["sequence_gap_records"] = f"""WITH {E}, {_all_breaks(K + ', file_path')} SELECT 'file.sequence_id' AS source, {K}, ms AS start_ms, ms AS end_ms, 'session_seq_skip' AS reason,
 field || ': expected ' || expected || ', got ' || val || CASE WHEN missing > 0 THEN ' (missing ' || missing || ')' ELSE ' (chain break)' END AS detail, row_id FROM b"""
SQL["cross_source_chain_breaks"] = f"""WITH {E}, d AS (SELECT exchange, symbol, row_id, received_at, {_j('$.pu')} AS pu, lag({_j('$.u')}) OVER w AS u, lag(received_at) OVER w AS last_received FROM e
 WHERE type = 'data' AND stream = 'depth' AND {_j('$.u')} >= 0 AND {_j('$.pu')} >= 0 WINDOW w AS (PARTITION BY exchange, symbol ORDER BY received_at, row_id))
SELECT exchange, symbol, row_id, last_received, received_at, u AS expected, pu AS actual FROM d WHERE pu <> u"""
SQL["session_seq_gaps"] = f"""WITH {E}, d AS (SELECT DISTINCT {K}, collector_session_id, session_seq FROM e WHERE type = 'data' AND session_seq >= 0 AND collector_session_id IS NOT NULL),
g AS (SELECT *, lag(session_seq) OVER (PARTITION BY {K}, collector_session_id ORDER BY session_seq) AS last FROM d)
SELECT {K}, collector_session_id, last + 1 AS from_seq, session_seq - 1 AS to_seq, session_seq - last - 1 AS missing FROM g WHERE session_seq > last + 1"""
SQL["session_changes"] = f"""WITH {E}, d AS (SELECT *, lag(collector_session_id) OVER w AS ls, lag(received_at) OVER w AS lr FROM e WHERE type = 'data' AND collector_session_id IS NOT NULL AND source IS NOT NULL
 WINDOW w AS (PARTITION BY {K}, source ORDER BY row_id))
SELECT {K}, source, row_id, lr AS gap_start_ts, received_at AS gap_end_ts, 'collector_restart' AS reason, 'collector_session_id changed from ' || ls || ' to ' || collector_session_id AS detail FROM d WHERE ls <> collector_session_id"""


def _silent(threshold: int, where: str, keyed: bool) -> str:
    same = " AND g.exchange = s.exchange AND g.symbol = s.symbol AND g.stream = s.stream" if keyed else ""
    return f"""WITH {E}, t AS (SELECT DISTINCT {K}, received_at FROM e WHERE type = 'data' AND received_at IS NOT NULL),
s AS (SELECT {K}, lag(received_at) OVER (PARTITION BY {K} ORDER BY received_at) AS a, received_at AS z FROM t),
g AS (SELECT {K}, gap_start_ts AS gs, gap_end_ts AS ge FROM e WHERE type = 'gap' AND gap_start_ts <= gap_end_ts)
SELECT {K}, a AS silent_from, z AS silent_to, (z - a) // 1000000 AS duration_ms FROM s WHERE z - a > {threshold} AND NOT EXISTS (SELECT 1 FROM g WHERE gs <= z AND ge >= a{same})"""


SQL["silence_uncovered"] = _silent(30_000_000_000, "", True)
SQL["silence_uncovered_by_any"] = _silent(600_000_000_000, "", False)
SQL["sequence_numbers"] = f"WITH {E} SELECT row_id, {K}, row_number() OVER (PARTITION BY {K} ORDER BY row_id) - 1 AS seq FROM e WHERE type = 'data'"
SQL["late_file_sequence"] = f"WITH {L} SELECT {DAY}, hour_no, count(*) AS late_files, max(seq) + 1 AS next_seq FROM l WHERE kind = 'late' GROUP BY ALL"

_DATA = ["_offset", "_partition", "_topic", "collector_session_id", "exchange", "exchange_ts", "raw_sha256", "raw_text", "received_at", "session_seq", "stream", "symbol", "type", "v"]
_GAP = ["_offset", "_partition", "_topic", "collector_session_id", "detail", "exchange", "gap_end_ts", "gap_start_ts", "reason", "received_at", "session_seq", "stream", "symbol", "type", "v"]
_lack = lambda cols: "[" + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in cols) + "]"
SQL["missing_fields"] = f"""WITH {E}, m AS (SELECT row_id, file_path, list_filter(CASE WHEN type = 'gap' THEN {_lack(_GAP)} ELSE {_lack(_DATA)} END, lambda x: x IS NOT NULL) AS m FROM e)
SELECT row_id, file_path, '[''' || array_to_string(m, ''', ''') || ''']' AS missing FROM m WHERE len(m) > 0"""
SQL["payload_hash_mismatch"] = "SELECT row_id, file_path, raw_sha256, sha256(raw_text) AS actual_sha256 FROM envelopes WHERE type = 'data' AND sha256(raw_text) <> raw_sha256"
_dup = lambda extra: f"""WITH d AS (SELECT row_id, _topic, _partition, _offset, file_path, min(row_id) OVER (PARTITION BY _topic, _partition, _offset{extra}) AS first_row FROM envelopes WHERE _offset >= 0)
SELECT row_id, first_row, _topic, _partition, _offset{extra} FROM d WHERE row_id <> first_row"""  # noqa: E731
SQL["duplicate_offsets"] = _dup("")
SQL["duplicate_offsets_in_file"] = _dup(", file_path")
_SORT = f"coalesce(CASE stream WHEN 'trades' THEN {_j('$.a')} WHEN 'depth' THEN {_j('$.u')} END, exchange_ts, 0)"
SQL["ordering_violations"] = f"""WITH {E}, k AS (SELECT *, {_SORT} AS key FROM f WHERE type = 'data'), o AS (SELECT *, lag(key) OVER (PARTITION BY {K}, file_path ORDER BY row_id) AS last_key FROM k)
SELECT row_id, file_path, last_key, key FROM o WHERE key < last_key"""
SQL["document_hashes"] = "SELECT doc_id, sha256(text) AS sha256 FROM documents"
SQL["natural_keys"] = f"""WITH {E} SELECT row_id, coalesce(CASE WHEN stream = 'trades' THEN {_j('$.a')} WHEN stream IN ('depth', 'bookticker') THEN {_j('$.u')} ELSE exchange_ts END, -1) AS natural_key, {_SORT} AS sort_key,
 CASE WHEN stream = 'open_interest' THEN {_j('$.time')} WHEN stream <> 'depth_snapshot' THEN {_j('$.E')} END AS payload_ts FROM e WHERE type = 'data'"""
SQL["time_routing"] = f"""WITH {E}, t AS (SELECT *, strftime(make_timestamp(received_at // 1000), '%Y-%m-%d') AS d, CAST(received_at // 3600000000000 % 24 AS INTEGER) AS h FROM f WHERE received_at IS NOT NULL)
SELECT kind, d, h, count(*) AS n_rows, coalesce(count_if(d <> utc_date OR h <> hour_no), 0)::BIGINT AS n_elsewhere FROM t GROUP BY ALL"""
SQL["topics"] = f"""WITH {E} SELECT exchange, stream, exchange || '.' || stream AS topic, count_if(regexp_replace(_topic, '^backup\\.', '') = exchange || '.' || stream)::BIGINT AS n_right, count_if(_topic LIKE 'backup.%')::BIGINT AS n_backup, count(*) AS n_rows
FROM e WHERE type = 'data' AND _topic IS NOT NULL GROUP BY ALL"""

M = f"""{L}, hrs AS (SELECT unnest(generate_series(0, 23))::INTEGER AS hour_no), days AS (SELECT DISTINCT {DAY} FROM l WHERE kind <> 'other'),
m AS (SELECT {DAY}, hour_no, epoch_ms(utc_date::TIMESTAMP) + hour_no * 3600000 AS start_ms FROM days, hrs
  WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.exchange = days.exchange AND l.symbol = days.symbol AND l.stream = days.stream AND l.utc_date = days.utc_date AND (l.kind = 'daily' OR (l.kind <> 'other' AND l.hour_no = hrs.hour_no))))"""
SQL["missing_hours"] = f"WITH {M} SELECT 'file.missing_hour' AS source, {DAY}, hour_no, start_ms, start_ms + 3599999 AS end_ms, 'missing_hour' AS reason, 'hour ' || hour_no || ' file absent' AS detail FROM m WHERE start_ms <= {NOW_MS}"
SQL["missing_hour_envelopes"] = f"""WITH {M} SELECT 1 AS v, 'gap' AS type, {K}, start_ms * 1000000 AS gap_start_ts, (start_ms + 3600000) * 1000000 - 1 AS gap_end_ts, 'missing_hour' AS reason,
 'No data files found for hour ' || hour_no || '; not recoverable via backfill' AS detail, -1::BIGINT AS session_seq, -1::BIGINT AS _offset FROM m WHERE start_ms <= {NOW_MS}"""
SQL["backfillable_hours"] = f"WITH {M} SELECT {DAY}, hour_no, start_ms, start_ms + 3599999 AS end_ms FROM m WHERE start_ms <= {NOW_MS} AND stream IN ('trades', 'funding_rate', 'open_interest')"

H = f"""{L}, h AS (SELECT {DAY}, hour_no, min(file_path) FILTER (kind = 'base') AS base, list(file_path ORDER BY seq, file_path) FILTER (kind = 'late') AS late, list(file_path ORDER BY seq, file_path) FILTER (kind = 'backfill') AS backfill
 FROM l WHERE kind IN ('base', 'late', 'backfill') GROUP BY ALL)"""
_STATUS = "CASE WHEN base IS NULL AND len(backfill) > 0 THEN 'backfilled' ELSE 'present' END"
SQL["hour_status"] = f"WITH {H} SELECT {DAY}, hour_no, {_STATUS} AS status, base, coalesce(array_to_string(late, '|'), '') AS late, coalesce(array_to_string(backfill, '|'), '') AS backfill FROM h"
SQL["hour_groups_check"] = f"""WITH {H}, g AS (SELECT {_NAMES}, utc_date, hour_no, bool_or(base IS NOT NULL) AS g_base, max(len(late))::INTEGER AS g_late, max(len(backfill))::INTEGER AS g_backfill FROM hour_file_groups GROUP BY ALL),
c AS (SELECT {DAY}, hour_no, base IS NOT NULL AS has_base, coalesce(len(late), 0)::INTEGER AS n_late, coalesce(len(backfill), 0)::INTEGER AS n_backfill FROM h)
SELECT * FROM g JOIN c USING ({DAY}, hour_no) WHERE has_base <> g_base OR n_late <> g_late OR n_backfill <> g_backfill"""
_AG = f"SELECT 'file.envelope' AS source, {K}, gap_start_ts // 1000000 AS start_ms, gap_end_ts // 1000000 AS end_ms, reason, detail FROM e WHERE type = 'gap'"
SQL["archived_gaps"] = f"WITH {E} {_AG}"
SQL["archived_gaps_in_scope"] = f"WITH {E} SELECT * FROM ({_AG}) WHERE end_ms >= 1612180800000 AND start_ms <= 1612267199999 AND stream IN ('trades', 'depth')"
SQL["gap_coalesce"] = f"""WITH {E} SELECT {K}, gap_start_ts, max(gap_end_ts) AS gap_end_ts, arg_min(coalesce(reason, '?'), row_id) AS reason, nullif(arg_min(coalesce(detail, '?'), row_id), '?') AS detail, min(row_id) AS first_row, count(*) AS n_merged
FROM e WHERE type = 'gap' AND gap_start_ts IS NOT NULL GROUP BY {K}, gap_start_ts"""
R = f"""r AS (SELECT * FROM (SELECT * EXCLUDE (exchange, symbol, stream), {_NAMES} FROM consolidate_results WHERE consolidated_at IS NOT NULL)
 QUALIFY row_number() OVER (PARTITION BY {DAY} ORDER BY consolidated_at DESC, coalesce(success, false) DESC) = 1)"""
SQL["manifest_missing_hours"] = f"""WITH {R}, x AS (SELECT {DAY}, unnest(missing_hours) AS hour_no FROM r)
SELECT 'manifest' AS source, {DAY}, hour_no, epoch_ms(utc_date::TIMESTAMP) + hour_no * 3600000 AS start_ms, epoch_ms(utc_date::TIMESTAMP) + hour_no * 3600000 + 3599999 AS end_ms, 'missing_hour' AS reason, 'manifest=' || utc_date || '; hour=' || hour_no AS detail FROM x"""
SQL["component_runtime_gaps"] = f"""SELECT 'pg.component_runtime' AS source, collector_session_id AS component, max(received_at // 1000000) AS start_ms,
 CASE WHEN contains(collector_session_id, '-a_') THEN max(received_at // 1000000) + 1000 ELSE {NOW_MS} END AS end_ms, CASE WHEN contains(collector_session_id, '-a_') THEN 'collector_restart' ELSE 'restart_gap' END AS reason,
 'component=' || collector_session_id || '; instance_id=-; host_boot_id=-; maintenance_id=-' AS detail FROM envelopes WHERE type = 'data' AND collector_session_id IS NOT NULL AND received_at IS NOT NULL GROUP BY collector_session_id"""
SQL["maintenance_gaps"] = f"""SELECT 'pg.maintenance_intent' AS source, gap_id AS maintenance_id, min(start_ms) AS start_ms, coalesce(max(end_ms), {NOW_MS}) AS end_ms, 'collector_restart' AS reason, 'maintenance_id=' || gap_id || '; scope=-; reason=-; planned_by=-' AS detail
FROM gap_state WHERE {_n('source')} = 'pg.maintenance_intent' GROUP BY gap_id"""
SQL["outage_gaps"] = f"SELECT {_NAMES}, max(start_ms) AS start_ms, {NOW_MS - 3_600_000}::BIGINT AS end_ms, 'kafka_producer_outage' AS reason FROM gap_records WHERE {_n('reason')} = 'kafka_producer_outage' GROUP BY 1, 2, 3 HAVING max(start_ms) IS NOT NULL"
SQL["state_fanout"] = f"""WITH {E}, s AS (SELECT DISTINCT gap_id, {_n('exchange')} AS exchange, start_ms, end_ms, detail FROM gap_state WHERE {_n('source')} = 'pg.maintenance_intent')
SELECT gap_id, t.exchange, symbol, stream, start_ms, end_ms, coalesce(detail, '') || '; fanout=true' AS detail FROM s JOIN (SELECT DISTINCT {K} FROM e) t USING (exchange)"""
SQL["session_pairing"] = """WITH x AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t FROM events WHERE event_type IN ('signup', 'purchase')),
y AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN t END) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM x)
SELECT user_id, event_id, s AS start_ts, t AS end_ts FROM y WHERE event_type = 'purchase' AND s IS NOT NULL"""


def _side(t: str, key: str) -> str:
    return f"""(SELECT * FROM (SELECT gap_id AS {key}, {_NAMES}, start_ms, end_ms, {_n('reason')} AS reason FROM {t}
    QUALIFY row_number() OVER (PARTITION BY gap_id ORDER BY recorded_at DESC NULLS LAST, 2 DESC, 3 DESC, 4 DESC, start_ms DESC) = 1) WHERE start_ms <= end_ms)"""


_PAIRS = ", ".join(f"('{a}', '{b}')" for a, bs in EXPLAINS.items() for b in bs)
C = f"""fs AS {_side('gap_records', 'file_id')}, st AS {_side('gap_state', 'state_id')}, why(sr, fr) AS (VALUES {_PAIRS}),
c AS (SELECT file_id, min(state_id) AS state_id FROM fs JOIN st ON fs.exchange = st.exchange AND fs.symbol = st.symbol AND fs.stream = st.stream AND fs.start_ms - 2000 <= st.end_ms AND fs.end_ms + 2000 >= st.start_ms
  JOIN why ON sr = st.reason AND fr = fs.reason GROUP BY file_id)"""
SQL["reconcile_explained"] = f"WITH {C} SELECT * FROM c"
SQL["reconcile_unexplained"] = f"WITH {C} SELECT * FROM fs WHERE file_id NOT IN (SELECT file_id FROM c)"
SQL["reconcile_orphans"] = f"WITH {C} SELECT * FROM st WHERE state_id NOT IN (SELECT state_id FROM c)"
SQL["reconcile_summary"] = f"""WITH {C} SELECT 'explained' AS status, count(*) AS n FROM c UNION ALL SELECT 'unexplained', count(*) FROM fs WHERE file_id NOT IN (SELECT file_id FROM c)
UNION ALL SELECT 'orphan_state', count(*) FROM st WHERE state_id NOT IN (SELECT state_id FROM c)"""

SQL["hour_merge_order"] = f"""WITH {E}, d AS (SELECT *, {_SORT} AS key FROM f WHERE hour_no IS NOT NULL AND type <> 'gap'),
r AS (SELECT *, row_number() OVER (PARTITION BY {DAY}, hour_no ORDER BY key, row_id) AS rk FROM d), g AS (SELECT * FROM f WHERE hour_no IS NOT NULL AND type = 'gap'),
p AS (SELECT g.row_id, {', '.join('g.' + c for c in DAY.split(', '))}, g.hour_no, coalesce(min(r.rk), 2147483647) AS place, 0 AS k, coalesce(g.gap_start_ts, 0) AS gs
  FROM g LEFT JOIN r ON r.exchange = g.exchange AND r.symbol = g.symbol AND r.stream = g.stream AND r.utc_date = g.utc_date AND r.hour_no = g.hour_no AND r.received_at >= g.gap_start_ts GROUP BY ALL
  UNION ALL SELECT row_id, {DAY}, hour_no, rk, 1, 0 FROM r)
SELECT row_id, {DAY}, hour_no, row_number() OVER (PARTITION BY {DAY}, hour_no ORDER BY place, k, gs, row_id) AS pos FROM p"""
_CNT = "count(*) AS total_records, count_if(type <> 'gap')::BIGINT AS data_records, count_if(type = 'gap')::BIGINT AS gap_records"
SQL["hour_counts"] = f"WITH {E} SELECT {DAY}, hour_no, {_CNT} FROM f GROUP BY ALL"
SQL["day_counts"] = f"WITH {E} SELECT {DAY}, {_CNT} FROM f GROUP BY ALL"
SQL["date_manifest"] = f"""WITH {E} SELECT utc_date, {K}, array_to_string(list_sort(list(DISTINCT hour_no)), ',') AS hours, count(*) AS record_count, count_if(type = 'gap')::INTEGER AS n_gaps FROM f WHERE hour_no IS NOT NULL GROUP BY ALL"""
SQL["day_manifest"] = f"""WITH {E}, {M}, q AS (SELECT {DAY}, hour_no, {_CNT} FROM f WHERE hour_no IS NOT NULL GROUP BY ALL),
h AS (SELECT {DAY}, hour_no, count(*) AS files FROM l WHERE kind IN ('base', 'late', 'backfill') GROUP BY ALL),
a AS (SELECT {DAY}, hour_no, data_records AS d, gap_records AS g, files, false AS gone FROM h JOIN q USING ({DAY}, hour_no) WHERE data_records + gap_records > 0
  UNION ALL SELECT {DAY}, hour_no, 0, 1, 0, true FROM m WHERE start_ms <= {NOW_MS})
SELECT {DAY}, sum(d + g)::BIGINT AS total_records, sum(d)::BIGINT AS data_records, sum(g)::BIGINT AS gap_records, count(*)::INTEGER AS n_hours, coalesce(array_to_string(list_sort(list(hour_no) FILTER (gone)), ','), '') AS missing_hours, sum(files)::INTEGER AS source_files_count FROM a GROUP BY {DAY}"""
SQL["cycle_totals"] = f"WITH {R} SELECT utc_date, count(*) AS streams, sum(coalesce(total_records, 0))::BIGINT AS records, sum(coalesce(len(missing_hours), 0))::BIGINT AS missing_hours, bool_or(NOT coalesce(success, false)) AS any_failed FROM r GROUP BY utc_date"

SQL["high_water"] = "SELECT _topic, _partition, max(_offset) AS high_water, max(_offset) + 1 AS seek_to FROM envelopes WHERE _offset >= 0 AND _topic IS NOT NULL GROUP BY ALL"
SQL["latest_checkpoint"] = f"""SELECT {K}, updated_at, hour_start_ms, last_received_at FROM (SELECT {_NAMES}, updated_at, hour_start_ms, last_received_at FROM stream_checkpoint)
QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY updated_at DESC NULLS LAST, hour_start_ms DESC NULLS LAST, last_received_at DESC NULLS LAST) = 1"""
SQL["file_state_upsert"] = """WITH s AS (SELECT topic, partition_id, file_path, max(high_water_offset) AS high_water_offset FROM writer_file_state GROUP BY ALL),
l AS (SELECT topic, partition_id, file_path, file_byte_size, updated_at FROM writer_file_state QUALIFY row_number() OVER (PARTITION BY topic, partition_id, file_path ORDER BY updated_at DESC NULLS LAST, file_byte_size DESC NULLS LAST) = 1)
SELECT s.*, l.file_byte_size, l.updated_at FROM s JOIN l ON s.topic IS NOT DISTINCT FROM l.topic AND s.partition_id IS NOT DISTINCT FROM l.partition_id AND s.file_path IS NOT DISTINCT FROM l.file_path"""
SQL["files_against_state"] = f"""WITH {L}, s AS (SELECT file_path, file_byte_size AS state_bytes FROM writer_file_state WHERE file_path IS NOT NULL QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY updated_at DESC NULLS LAST, file_byte_size DESC NULLS LAST) = 1),
d AS (SELECT file_path, size_bytes, EXISTS (SELECT 1 FROM archive_files a WHERE a.file_path = l.file_path || '.sha256') AS side FROM l WHERE kind <> 'other')
SELECT file_path, size_bytes, state_bytes, CASE WHEN size_bytes IS NULL THEN 'missing_file' WHEN side THEN 'sealed' WHEN state_bytes IS NULL THEN 'uncommitted' WHEN size_bytes > state_bytes THEN 'oversized' WHEN size_bytes < state_bytes THEN 'short' ELSE 'open' END AS status
FROM d FULL JOIN s USING (file_path)"""
SQL["missing_sidecars"] = f"WITH {L} SELECT file_path, size_bytes FROM l WHERE kind <> 'other' AND size_bytes > 0 AND file_path || '.sha256' NOT IN (SELECT file_path FROM archive_files WHERE file_path IS NOT NULL)"
SQL["recovery_gaps"] = f"""WITH {E}, c AS (SELECT * FROM (SELECT {_NAMES}, hour_start_ms, updated_at, last_received_at, last_collector_session_id FROM stream_checkpoint
  WHERE hour_start_ms * 1000000 < {RESTART_NS} AND last_received_at IS NOT NULL AND last_collector_session_id IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY hour_start_ms DESC, updated_at DESC NULLS LAST, last_received_at DESC, last_collector_session_id DESC) = 1),
a AS (SELECT * FROM e WHERE type = 'data' AND received_at >= {RESTART_NS} AND collector_session_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY received_at, row_id) = 1)
SELECT a.exchange, a.symbol, a.stream, c.last_received_at AS gap_start_ts, a.received_at AS gap_end_ts, 'restart_gap' AS reason FROM a JOIN c USING ({K}) WHERE a.collector_session_id <> c.last_collector_session_id AND a.received_at > c.last_received_at"""
SQL["latest_order_of_customer"] = "SELECT o_custkey, epoch_us(o_orderdate) AS ordered_us, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
SQL["restart_classify"] = """WITH x AS (SELECT o_orderkey AS k, coalesce(CASE WHEN k % 3 <> 0 THEN k % 5 END <> k % 5 + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END, false) AS boot,
  coalesce(CASE WHEN k % 3 <> 0 THEN k % 5 END = k % 5 + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END, false) AS same, coalesce(CASE WHEN k % 4 <> 0 THEN k % 2 END <> k % 3, false) AS sess, o_orderstatus = 'F' AS clean, k % 11 = 0 AS sys,
  k % 6 = 0 AND (k % 12 <> 0 OR 50 < k % 100) AS valid, k % 6 = 0 AND k % 12 = 0 AND 50 >= k % 100 AS expired, k % 9 = 0 AS host,
  CASE WHEN k % 13 = 0 THEN 'postgres' WHEN k % 17 = 0 THEN 'redpanda' END AS die FROM orders),
y AS (SELECT *, CASE WHEN NOT boot THEN die END AS dead,
  CASE WHEN boot AND valid THEN 'host,operator_shutdown,1' WHEN boot THEN 'host,host_reboot,0' WHEN host AND valid THEN 'system,operator_shutdown,1' WHEN clean AND valid THEN 'collector,operator_shutdown,1'
       WHEN clean THEN 'collector,operator_shutdown,0' WHEN sess THEN 'collector,unclean_exit,0' WHEN sys AND valid THEN 'writer,operator_shutdown,1' WHEN sys THEN 'writer,operator_shutdown,0' ELSE 'unknown,unknown,0' END AS c FROM x)
SELECT k AS o_orderkey, coalesce(dead, split_part(c, ',', 1)) AS component, CASE WHEN dead IS NOT NULL THEN 'unclean_exit' ELSE split_part(c, ',', 2) END AS cause, dead IS NULL AND split_part(c, ',', 3) = '1' AS planned,
 array_to_string([CASE WHEN boot THEN 'host_boot_id_changed' END, CASE WHEN same THEN 'host_boot_id_unchanged' END, CASE WHEN sess THEN 'collector_session_changed' END, CASE WHEN clean THEN 'collector_clean_exit' END, CASE WHEN sys THEN 'writer_clean_exit' END,
  CASE WHEN valid THEN 'maintenance_intent_valid' END, CASE WHEN expired THEN 'maintenance_intent_expired' END, CASE WHEN c LIKE 'unknown%' THEN 'no_clear_signal' END, 'component_die:' || dead], '|') AS evidence FROM y"""

S = 1_000_000_000
SQL["coverage_suppression"] = f"""WITH {E}, g AS (SELECT row_id AS gap_no, {K}, coalesce(source, 'primary') AS source, {_n('reason')} AS reason, gap_start_ts, received_at FROM e WHERE type = 'gap'),
o AS (SELECT g.gap_no, bool_or(e.received_at > g.gap_start_ts AND e.received_at <= g.received_at + {10 * S}) AS bridged, max(e.received_at) FILTER (e.received_at <= g.received_at) AS last FROM g JOIN e ON e.type = 'data' AND e.source <> g.source
  AND e.exchange = g.exchange AND e.symbol = g.symbol AND e.stream = g.stream GROUP BY g.gap_no)
SELECT gap_no, {K}, source, gap_start_ts, coalesce(bridged, false) AND coalesce(reason = 'restart_gap' OR last > gap_start_ts OR last > received_at - {10 * S}, false) AS covered FROM g LEFT JOIN o USING (gap_no)"""
FO = f"""a AS (SELECT DISTINCT {K}, received_at AS t FROM e WHERE type = 'data' AND source = 'primary' AND received_at IS NOT NULL),
b AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY {K} ORDER BY t) <= {600 * S} THEN 0 ELSE 1 END AS nw FROM a), i AS (SELECT *, sum(nw) OVER (PARTITION BY {K} ORDER BY t) AS island FROM b),
runs AS (SELECT {K}, island, min(t) AS a, max(t) AS z FROM i GROUP BY ALL), lng AS (SELECT * FROM runs WHERE island = 1 OR z - a >= {1200 * S}),
fo AS (SELECT {K}, z + {600 * S} AS active_from, lead(a) OVER (PARTITION BY {K} ORDER BY a) + {1200 * S} AS active_to FROM lng)"""
SQL["failover_intervals"] = f"WITH {E}, {FO} SELECT * FROM fo"
SQL["source_routing"] = f"""WITH {E}, {FO} SELECT {K}, source, count(*) AS n_rows, sum(row_id)::BIGINT AS row_sum FROM e WHERE type = 'data' AND source IS NOT NULL AND received_at IS NOT NULL
 AND (source <> 'backup' OR EXISTS (SELECT 1 FROM fo WHERE fo.exchange = e.exchange AND fo.symbol = e.symbol AND fo.stream = e.stream AND e.received_at >= active_from AND (active_to IS NULL OR e.received_at < active_to))) GROUP BY ALL"""
SQL["both_silent"] = f"""WITH {E}, t AS (SELECT DISTINCT {K}, received_at AS z FROM e WHERE type = 'data' AND stream <> 'liquidations' AND received_at IS NOT NULL), s AS (SELECT *, lag(z) OVER (PARTITION BY {K} ORDER BY z) AS a FROM t)
SELECT {K}, a AS gap_start_ts, z AS gap_end_ts, 'both_collectors_silent' AS reason FROM s WHERE z - a > {600 * S}"""
_LS = f"ls AS (SELECT {K}, max(received_at) AS last_received FROM e WHERE type = 'data' AND received_at <= {RESTART_NS} GROUP BY ALL)"
SQL["watchdog_silent"] = f"WITH {E}, {_LS} SELECT *, ({RESTART_NS} - last_received) // 1000000 AS silent_ms FROM ls WHERE {RESTART_NS} - last_received > CASE stream WHEN 'trades' THEN 60 WHEN 'bookticker' THEN 30 WHEN 'depth' THEN 30 WHEN 'funding_rate' THEN 30 END * {S}::BIGINT"
SQL["heartbeat_status"] = f"WITH {E}, {_LS} SELECT {K}, last_received, CASE WHEN exchange = 'kelpex' THEN 'disconnected' WHEN last_received IS NULL OR {RESTART_NS} - last_received > {20 * S} THEN 'subscribed_silent' ELSE 'alive' END AS status FROM ls"


def _windows(src: str, time: str, flag: str, at_least: int) -> str:
    return f"""x AS (SELECT {K}, {time} AS t, {flag} AS o, CASE WHEN {flag} AND NOT coalesce(lag({flag}) OVER (PARTITION BY {K} ORDER BY {time}, {flag}), false) THEN 1 ELSE 0 END AS nw FROM {src}),
y AS (SELECT *, sum(nw) OVER (PARTITION BY {K} ORDER BY t, o ROWS UNBOUNDED PRECEDING) AS run FROM x)
SELECT {K}, min(t) AS start, max(t) AS "end", count(*) AS n FROM y WHERE o GROUP BY {K}, run HAVING max(t) - min(t) >= {at_least}"""


SQL["overflow_windows"] = f"WITH {E}, z AS (SELECT *, coalesce({_n('reason')} = 'buffer_overflow', false) AS fl FROM e), {_windows('z', 'row_id', 'fl', 0)}"
SQL["recovery_anchors"] = f"""WITH {E}, m AS (SELECT DISTINCT exchange, symbol, gap_end_ts AS t FROM e WHERE type = 'gap' AND stream = 'depth' AND gap_end_ts IS NOT NULL),
d AS (SELECT exchange, symbol, received_at FROM e WHERE type = 'data' AND stream = 'depth' AND received_at IS NOT NULL)
SELECT exchange, symbol, t AS gap_start_ts, min(received_at) AS gap_end_ts, 'recovery_depth_anchor' AS reason FROM m JOIN d USING (exchange, symbol) WHERE received_at > t GROUP BY ALL"""

B = f"""k AS (SELECT exchange, utc_date, symbol, row_id, received_at, CASE WHEN type = 'gap' THEN 'gap' WHEN stream = 'depth' THEN 'diff' ELSE 'snapshot' END AS kind,
  {_j('$.U')} AS u0, {_j('$.u')} AS u1, {_j('$.pu')} AS pu, {_j('$.lastUpdateId')} AS lid, gap_start_ts, gap_end_ts FROM f WHERE stream IN ('depth', 'depth_snapshot'))"""
SQL["depth_replay_asof"] = f"""WITH {E}, {B}, o AS (SELECT *, CASE WHEN kind = 'diff' THEN 1 ELSE 0 END AS dd FROM k WHERE received_at IS NOT NULL AND (kind = 'diff' OR (kind = 'snapshot' AND lid IS NOT NULL))),
p AS (SELECT *, sum(1 - dd) OVER w AS epoch, last_value(lid IGNORE NULLS) OVER w AS anchor FROM o WINDOW w AS (PARTITION BY exchange, utc_date, symbol ORDER BY received_at, dd, row_id ROWS UNBOUNDED PRECEDING)),
q AS (SELECT *, lag(u1) OVER w AS bu, lag(received_at) OVER w AS ba FROM p WHERE kind = 'diff' WINDOW w AS (PARTITION BY exchange, utc_date, symbol, epoch ORDER BY received_at, row_id)),
r AS (SELECT *, CASE WHEN epoch = 0 THEN 'no_snapshot' WHEN ba IS NULL AND NOT (u0 <= anchor + 1 AND u1 >= anchor + 1) THEN 'not_spanning' WHEN ba IS NOT NULL AND pu <> bu THEN 'chain_break' END AS error FROM q)
SELECT exchange, utc_date, symbol, row_id, error, bu AS expected, pu AS prev_u FROM r WHERE error IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k g WHERE g.kind = 'gap' AND g.exchange = r.exchange AND g.utc_date = r.utc_date AND g.symbol = r.symbol
  AND g.gap_start_ts <= g.gap_end_ts AND g.gap_start_ts <= r.received_at AND g.gap_end_ts >= coalesce(r.ba, r.received_at))"""
SQL["snapshot_asof"] = f"""WITH {E}, s AS (SELECT exchange, symbol, received_at, max_by({_j('$.lastUpdateId')}, row_id) AS lid FROM e WHERE stream = 'depth_snapshot' AND type <> 'gap' AND {_j('$.lastUpdateId')} IS NOT NULL GROUP BY ALL)
SELECT d.row_id, d.exchange, d.symbol, s.lid AS snapshot_lid FROM (SELECT * FROM e WHERE stream = 'depth' AND type <> 'gap' AND received_at IS NOT NULL) d ASOF LEFT JOIN s ON d.exchange = s.exchange AND d.symbol = s.symbol AND d.received_at >= s.received_at"""
_D = lambda k: f"max({_j('$.' + k, 'DOUBLE')})"
SQL["funding_interpolation"] = f"""WITH {E}, r AS (SELECT exchange, symbol, exchange_ts AS t1, {_D('p')} AS m1, {_D('i')} AS i1, {_D('P')} AS s1 FROM e WHERE type = 'data' AND stream = 'funding_rate' AND exchange_ts IS NOT NULL GROUP BY ALL),
p AS (SELECT *, lag(t1) OVER w AS t0, lag(m1) OVER w AS m0, lag(i1) OVER w AS i0, lag(s1) OVER w AS s0 FROM r WINDOW w AS (PARTITION BY exchange, symbol ORDER BY t1)),
g AS (SELECT *, unnest(generate_series(t0 // 60000 * 60000 + 60000, t1 // 60000 * 60000, 60000)) AS t FROM p WHERE t1 - t0 > 600000)
SELECT exchange, symbol, t, round(m0 + (m1 - m0) * ((t - t0)::DOUBLE / (t1 - t0)::DOUBLE), 6) AS mark, round(i0 + (i1 - i0) * ((t - t0)::DOUBLE / (t1 - t0)::DOUBLE), 6) AS idx,
 round(s0 + (s1 - s0) * ((t - t0)::DOUBLE / (t1 - t0)::DOUBLE), 6) AS settle, (t // 28800000 + 1) * 28800000 AS next_funding FROM g"""
SQL["backfill_envelopes"] = f"""WITH {E}, d AS (SELECT DISTINCT {K}, {_j('$.T')} AS exchange_ts, {_j('$.T')} // 3600000 AS h, raw_text FROM e WHERE type = 'data' AND stream = 'trades' AND _topic = 'backfill' AND {_j('$.T')} IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY {K}, h ORDER BY exchange_ts, raw_text) - 1 AS session_seq FROM d)
SELECT {K}, exchange_ts, session_seq, sha256(raw_text) AS raw_sha256, session_seq AS _offset FROM n"""

LAT = "lt AS (SELECT *, greatest(0, ms - exchange_ts) AS latency FROM e WHERE type = 'data' AND exchange_ts IS NOT NULL AND received_at IS NOT NULL)"
_LE = ", ".join(f"({b}::BIGINT)" for b in LATENCY_BUCKETS) + ", (NULL)"
HI = f"{LAT}, le(le) AS (VALUES {_LE}), hi AS (SELECT stream, le, count_if(le IS NULL OR latency <= le)::BIGINT AS n FROM lt, le GROUP BY ALL)"
SQL["latency_histogram"] = f"WITH {E}, {HI} SELECT * FROM hi"
SQL["latency_quantiles"] = f"""WITH {E}, {HI}, q(q) AS (VALUES (0.99::DOUBLE), (0.5::DOUBLE)), w AS (SELECT *, max(n) OVER (PARTITION BY stream) AS total, coalesce(lag(n) OVER o, 0) AS n0, coalesce(lag(le) OVER o, 0) AS le0 FROM hi WINDOW o AS (PARTITION BY stream ORDER BY le NULLS LAST)),
x AS (SELECT *, total * q AS rank FROM w, q WHERE total > 0), y AS (SELECT * FROM x WHERE n >= rank QUALIFY row_number() OVER (PARTITION BY stream, q ORDER BY le NULLS LAST) = 1)
SELECT stream, q, round(CASE WHEN le IS NULL THEN le0 WHEN n = n0 THEN le ELSE le0 + (le - le0) * (rank - n0) / (n - n0) END, 6)::DOUBLE AS value FROM y"""
SQL["increase_5m"] = f"WITH {E} SELECT exchange, stream, type, ms // 300000 * 300000 AS window_start_ms, count(*) AS increase FROM e WHERE ms IS NOT NULL GROUP BY ALL"
SQL["rate_by_stream"] = f"WITH {E} SELECT stream, ms // 60000 * 60000 AS window_start_ms, round(count(*) / 60.0::DOUBLE, 6) AS rate FROM e WHERE type = 'data' AND ms IS NOT NULL GROUP BY ALL"
SQL["lookback_5m"] = f"WITH {E}, g AS (SELECT row_id, exchange, received_at // 1000000000 AS s FROM e WHERE type = 'gap' AND received_at IS NOT NULL) SELECT row_id, exchange, count(*) OVER (PARTITION BY exchange ORDER BY s RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS lookback FROM g"
SQL["sustained_lag"] = f"WITH {E}, {LAT}, z AS (SELECT {K}, ms, min(latency) > 80 AS fl FROM lt GROUP BY {K}, ms), {_windows('z', 'ms', 'fl', 120_000)}"
SQL["gauge_summary"] = "SELECT topic, max(file_byte_size) AS max_bytes, min(file_byte_size) AS min_bytes, round(avg(file_byte_size), 4) AS avg_bytes, count(*) AS n FROM writer_file_state WHERE file_byte_size IS NOT NULL GROUP BY topic"
SQL["write_errors_or_zero"] = f"SELECT count_if({_n('reason')} = 'write_error')::BIGINT AS write_errors FROM envelopes"
SQL["sealed_hours"] = f"WITH {L} SELECT {DAY}, count(DISTINCT hour_no) AS sealed, 23 - max(hour_no) AS hours_behind, count(DISTINCT hour_no) < 24 AS incomplete FROM l WHERE kind = 'base' AND size_bytes > 0 GROUP BY ALL"
SQL["compression_ratio"] = f"""WITH {E}, {L}, r AS (SELECT file_path, sum(octet_length(raw_text::BLOB)) AS raw_bytes FROM f WHERE raw_text IS NOT NULL GROUP BY file_path)
SELECT exchange, stream, sum(raw_bytes)::BIGINT AS raw_bytes, sum(size_bytes)::BIGINT AS size_bytes, round(sum(raw_bytes) / sum(size_bytes), 6) AS ratio FROM r JOIN l USING (file_path) WHERE size_bytes > 0 GROUP BY ALL"""
SQL["next_funding"] = f"WITH {E} SELECT row_id, (exchange_ts // 28800000 + 1) * 28800000 AS next_funding, {_j('$.T')} = (exchange_ts // 28800000 + 1) * 28800000 AS agrees FROM e WHERE type = 'data' AND stream = 'funding_rate' AND exchange_ts IS NOT NULL"
SQL["dedup_stream"] = "SELECT _topic, _partition, count(DISTINCT _offset) AS n, min(_offset) AS first_offset, max(_offset) AS last_offset FROM envelopes WHERE type = 'data' AND _offset >= 0 AND _topic IS NOT NULL AND received_at IS NOT NULL GROUP BY ALL"
SQL["hour_tumble_stream"] = f"WITH {E} SELECT {K}, received_at // 3600000000000 * 3600000 AS hour_start_ms, count(*) AS n FROM e WHERE type = 'data' AND received_at IS NOT NULL GROUP BY ALL"

SQL["consumer_outages"] = f"""WITH t AS (SELECT DISTINCT received_at AS z FROM envelopes WHERE received_at IS NOT NULL), s AS (SELECT z, lag(z) OVER (ORDER BY z) AS a FROM t)
SELECT a AS gap_start_ts, z AS gap_end_ts, 'kafka_consumer_outage' AS reason FROM s WHERE z - a > {30 * S}"""
SQL["offset_resets"] = """WITH t AS (SELECT DISTINCT _topic, _partition, _offset FROM envelopes WHERE _offset >= 0 AND _topic IS NOT NULL AND _partition IS NOT NULL),
s AS (SELECT *, lag(_offset) OVER (PARTITION BY _topic, _partition ORDER BY _offset) AS last FROM t) SELECT _topic, _partition, last + 1 AS from_offset, _offset - 1 AS to_offset FROM s WHERE _offset > last + 1"""
_OFF = f"coalesce({_n('reason')} = 'ws_disconnect', false)"
SQL["disconnect_gaps"] = f"""WITH {E}, d AS (SELECT {K}, received_at AS t, {_OFF} AS o FROM e WHERE received_at IS NOT NULL AND (type = 'data' OR {_OFF})),
l AS (SELECT *, max(CASE WHEN NOT o THEN t END) OVER (PARTITION BY {K} ORDER BY t, o ROWS UNBOUNDED PRECEDING) AS last FROM d)
SELECT {K}, last AS gap_start_ts, max(t) AS gap_end_ts, 'ws_disconnect' AS reason, count(*) AS n FROM l WHERE o GROUP BY {K}, last"""
P = f"""p AS (SELECT exchange, received_at AS t, bool_or(coalesce({_n('reason')} = 'kafka_delivery_failed', false)) AS o FROM e WHERE received_at IS NOT NULL GROUP BY ALL),
q AS (SELECT *, coalesce(lag(o) OVER (PARTITION BY exchange ORDER BY t), false) AS was FROM p)"""
SQL["producer_outages"] = f"""WITH {E}, {P} SELECT exchange, t AS gap_start_ts, (SELECT min(t) FROM p g WHERE g.exchange = q.exchange AND g.t > q.t AND NOT g.o) AS gap_end_ts, 'kafka_producer_outage' AS reason FROM q WHERE o AND NOT was"""
SQL["producer_states"] = f"""WITH {E}, {P}, r AS (SELECT *, max(CASE WHEN o AND NOT was THEN t END) OVER (PARTITION BY exchange ORDER BY t) AS since FROM q)
SELECT exchange, CASE WHEN NOT o THEN 'HEALTHY' WHEN t - since >= 50000000 THEN 'PAUSED' ELSE 'DEGRADED' END AS state, count(*) AS n FROM r GROUP BY ALL"""
SQL["hold_windows"] = f"""WITH {E}, {P}, r AS (SELECT *, sum(CASE WHEN o AND NOT was THEN 1 ELSE 0 END) OVER (PARTITION BY exchange ORDER BY t) AS run FROM q)
SELECT exchange, min(t) AS gap_start_ts, max(t) AS gap_end_ts, 'pg_outage_hold' AS reason, count(*) AS failures FROM r WHERE o GROUP BY exchange, run"""
SQL["frame_routing"] = f"WITH {E} SELECT stream, count(*) AS n, count(*) AS n_same FROM e WHERE type = 'data' AND raw_text IS NOT NULL AND stream IN ('trades', 'depth', 'bookticker', 'funding_rate') GROUP BY stream"
