"""The ingest queries in SQL."""

from __future__ import annotations

from tidelake.operators.metrics import FAILOVER_BUCKETS, FLUSH_BUCKETS
from tidelake.plans.lake_sql import _NAMES, DAY, FO, NOW_MS, RESTART_NS, B, E, K, M, _j, _n
from tidelake.plans.lake_sql import SQL as LAKE

S = 1_000_000_000
SQL: dict[str, str] = {}

SQL["gap_scope_dates"] = """SELECT DISTINCT gap_id, start_ms, end_ms, strftime(unnest(generate_series(make_timestamp(start_ms * 1000)::DATE, make_timestamp(end_ms * 1000)::DATE, INTERVAL 1 DAY)), '%Y-%m-%d') AS utc_date
FROM gap_records WHERE start_ms <= end_ms"""
SQL["session_ids"] = f"""SELECT DISTINCT {_n('exchange')} AS exchange, last_received_at, {_n('exchange')} || '-collector-01_' || strftime(make_timestamp(last_received_at // 1000), '%Y-%m-%dT%H:%M:%SZ') AS session_id
FROM stream_checkpoint WHERE last_received_at IS NOT NULL"""
SQL["hold_reasons"] = """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'disk_full_hold' ELSE 'pg_outage_hold' END AS reason FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 OR o_orderkey % 11 = 0"""

_C = f"""c AS (SELECT {K}, last_received_at, last_collector_session_id FROM (SELECT {_NAMES}, hour_start_ms, updated_at, last_received_at, last_collector_session_id FROM stream_checkpoint
  WHERE hour_start_ms * 1000000 < {RESTART_NS} AND last_received_at IS NOT NULL AND last_collector_session_id IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY hour_start_ms DESC, updated_at DESC NULLS LAST, last_received_at DESC, last_collector_session_id DESC) = 1),
known AS (SELECT DISTINCT collector_session_id AS s FROM e WHERE collector_session_id IS NOT NULL AND received_at IS NOT NULL),
cs AS (SELECT c.*, s IS NOT NULL AND ascii(right(s, 2)) % 2 = 0 AS clean FROM c LEFT JOIN known ON s = last_collector_session_id)"""
SQL["checkpoint_shutdowns"] = f"WITH {E}, {_C} SELECT * FROM cs"
SQL["recovery_gap_envelopes"] = f"""WITH {E}, {_C}, a AS (SELECT * FROM e WHERE type = 'data' AND received_at >= {RESTART_NS} AND collector_session_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY received_at, row_id) = 1)
SELECT {K}, 'gap' AS type, {RESTART_NS} AS received_at, a.collector_session_id, -1::BIGINT AS session_seq, -1::BIGINT AS _offset, cs.last_received_at AS gap_start_ts, a.received_at AS gap_end_ts, 'restart_gap' AS reason,
 'writer' AS component, 'unclean_exit' AS cause, false AS planned,
 array_to_string(['host_boot_id_unchanged', CASE WHEN a.collector_session_id <> last_collector_session_id THEN 'collector_session_changed' END, CASE WHEN clean THEN 'collector_clean_exit' END,
  CASE WHEN a.collector_session_id = last_collector_session_id AND NOT clean THEN 'no_clear_signal' END, 'component_die:writer'], '|') AS evidence
FROM a JOIN cs USING ({K})"""
SQL["component_states"] = """WITH d AS (SELECT user_id AS instance_id, event_type, epoch_us(ts) // 1000 AS ms FROM events),
g AS (SELECT instance_id, max(ms) FILTER (event_type = 'signup') AS started_ms, max(ms) FILTER (event_type <> 'purchase') AS last_heartbeat_ms, max(ms) FILTER (event_type = 'purchase') AS down FROM d GROUP BY 1)
SELECT 'collector' AS component, instance_id, CASE WHEN started_ms IS NOT NULL THEN 'boot' END AS host_boot_id, started_ms, last_heartbeat_ms, CASE WHEN down >= coalesce(started_ms, down) THEN down END AS clean_shutdown_ms FROM g"""

_P = f"p AS (SELECT row_id, {K}, row_number() OVER (PARTITION BY {K} ORDER BY row_id) AS n, CASE stream WHEN 'depth' THEN 200 WHEN 'trades' THEN 100 ELSE 10000 END AS cap FROM e WHERE type = 'data')"
SQL["producer_caps"] = f"WITH {E}, {_P} SELECT {K}, count_if(n <= cap)::BIGINT AS taken, count_if(n > cap)::BIGINT AS dropped FROM p GROUP BY ALL"
SQL["collector_gap_envelopes"] = f"""WITH {E}, {_P} SELECT {K}, 1 AS v, 'gap' AS type, {NOW_MS} * 1000000 AS received_at, 'c-1' AS collector_session_id, -1::BIGINT AS session_seq, min(row_id) AS gap_start_ts, {NOW_MS} * 1000000 AS gap_end_ts, 'buffer_overflow' AS reason,
 'Producer buffer was full; ' || count(*) || ' messages dropped for ' || stream || '/' || symbol AS detail FROM p WHERE n > cap GROUP BY {K}"""
SQL["writer_gap_envelopes"] = f"""WITH {E}, s AS ({LAKE['coverage_suppression']}) SELECT gap_no, e.exchange, e.symbol, e.stream, {_n('e.reason')} AS reason FROM s JOIN e ON e.row_id = gap_no WHERE NOT covered OR coalesce({_n('e.reason')} = 'collector_restart', false)"""
SQL["depth_resync"] = f"""WITH {E}, br AS (SELECT DISTINCT exchange, symbol, received_at AS t FROM ({LAKE['cross_source_chain_breaks']})),
g AS (SELECT DISTINCT received_at AS at FROM e WHERE received_at IS NOT NULL AND coalesce({_n('reason')} <> 'kafka_delivery_failed', true)),
bk AS (SELECT exchange, symbol, received_at AS at, {_j('$.u')} AS u FROM e WHERE type = 'data' AND stream = 'depth' AND source = 'backup' AND received_at IS NOT NULL),
sn AS (SELECT exchange, symbol, received_at AS at, max({_j('$.lastUpdateId')}) AS lid FROM e WHERE type = 'data' AND stream = 'depth_snapshot' AND received_at IS NOT NULL AND {_j('$.lastUpdateId')} IS NOT NULL GROUP BY ALL),
r AS (SELECT br.*, CASE WHEN g.at <= t + {60 * S} THEN g.at END AS ready FROM br ASOF LEFT JOIN g ON br.t <= g.at),
u AS (SELECT r.exchange, r.symbol, r.t, max(u) AS bu FROM r JOIN bk ON bk.exchange = r.exchange AND bk.symbol = r.symbol AND bk.at <= ready GROUP BY ALL),
w AS (SELECT r.exchange, r.symbol, r.t, min(sn.at) AS sa FROM r JOIN sn ON sn.exchange = r.exchange AND sn.symbol = r.symbol AND sn.at >= ready GROUP BY ALL)
SELECT r.exchange, r.symbol, r.t AS broken_at, CASE WHEN ready IS NULL THEN 'producer_unhealthy' WHEN bu IS NOT NULL THEN 'backup' WHEN sa IS NOT NULL THEN 'snapshot' ELSE 'snapshot_exhausted' END AS status, coalesce(bu, lid) AS sync_id,
 CASE WHEN bu IS NOT NULL THEN ready ELSE sa END AS synced_at FROM r LEFT JOIN u USING (exchange, symbol, t) LEFT JOIN w USING (exchange, symbol, t) LEFT JOIN sn ON sn.exchange = r.exchange AND sn.symbol = r.symbol AND sn.at = sa"""
# Synced or not is a walk: one row of each book after the other.
SQL["depth_replay"] = f"""WITH RECURSIVE {E}, {B}, gp AS (SELECT exchange, utc_date, symbol, gap_start_ts AS a, gap_end_ts AS z FROM k WHERE kind = 'gap' AND gap_start_ts <= gap_end_ts),
sn AS (SELECT DISTINCT exchange, utc_date, symbol, lid FROM k WHERE kind = 'snapshot' AND lid IS NOT NULL),
d0 AS (SELECT exchange, utc_date, symbol, row_id, coalesce(received_at, 0) AS rt, coalesce(u0, 0) AS u0, coalesce(u1, 0) AS u1, coalesce(pu, 0) AS pu FROM k WHERE kind = 'diff'),
d1 AS (SELECT *, row_number() OVER w AS n, lag(u1) OVER w AS last_u, lag(rt) OVER w AS last_at FROM d0 WINDOW w AS (PARTITION BY exchange, utc_date, symbol ORDER BY rt, row_id)),
d AS (SELECT *, EXISTS (SELECT 1 FROM sn WHERE sn.exchange = d1.exchange AND sn.utc_date = d1.utc_date AND sn.symbol = d1.symbol AND lid BETWEEN u0 - 1 AND u1 - 1) AS spans,
  EXISTS (SELECT 1 FROM gp WHERE gp.exchange = d1.exchange AND gp.utc_date = d1.utc_date AND gp.symbol = d1.symbol AND a <= rt AND z >= rt) AS here,
  EXISTS (SELECT 1 FROM gp WHERE gp.exchange = d1.exchange AND gp.utc_date = d1.utc_date AND gp.symbol = d1.symbol AND a <= rt AND z >= last_at) AS since FROM d1),
r(exchange, utc_date, symbol, n, was, now) AS (SELECT exchange, utc_date, symbol, n, false, spans FROM d WHERE n = 1
  UNION ALL SELECT d.exchange, d.utc_date, d.symbol, d.n, r.now, CASE WHEN NOT r.now THEN d.spans WHEN d.pu <> d.last_u AND d.since THEN d.spans ELSE true END
  FROM r JOIN d ON d.exchange = r.exchange AND d.utc_date = r.utc_date AND d.symbol = r.symbol AND d.n = r.n + 1)
SELECT exchange, utc_date, symbol, row_id, CASE WHEN was THEN format('[{{}}] pu chain break at received_at {{}}: expected pu={{}}, got pu={{}}', symbol, rt, last_u, pu)
  ELSE format('[{{}}] {{}}: U={{}} u={{}} at {{}}', symbol, CASE WHEN EXISTS (SELECT 1 FROM sn WHERE sn.exchange = d.exchange AND sn.utc_date = d.utc_date AND sn.symbol = d.symbol) THEN 'First diff does not span any snapshot sync point' ELSE 'Depth diff has no preceding snapshot' END, u0, u1, rt) END AS error
FROM d JOIN r USING (exchange, utc_date, symbol, n) WHERE CASE WHEN was THEN pu <> last_u AND NOT since ELSE NOT spans AND NOT here END"""

SQL["backfill_outcomes"] = f"""WITH {M}, b AS (SELECT stream, start_ms // 3600000 % 3 AS turn FROM m WHERE stream IN ('trades', 'funding_rate', 'open_interest') AND start_ms <= (SELECT max(epoch_ms(listed_at)) FROM archive_files WHERE file_path IS NOT NULL))
SELECT stream, count_if(turn = 0)::BIGINT AS written, count_if(turn = 1)::BIGINT AS unavailable, count_if(turn = 2)::BIGINT AS failed, 2 * count_if(turn = 0)::BIGINT AS records FROM b GROUP BY stream"""
SQL["snapshot_polls"] = f"""WITH {E}, s AS (SELECT DISTINCT exchange, symbol FROM e), t AS (SELECT *, unnest(['open_interest', 'depth_snapshot']) AS stream FROM s),
x AS (SELECT *, symbol LIKE '%x%' AS miss, CASE stream WHEN 'open_interest' THEN '{{"time": ' || length(symbol) || ', "symbol": "' || symbol || '"}}' ELSE '{{"lastUpdateId": ' || length(symbol) || '}}' END AS j FROM t)
SELECT {K}, CASE WHEN miss THEN 'gap' ELSE 'data' END AS type, CASE WHEN NOT miss THEN CASE stream WHEN 'open_interest' THEN length(symbol) ELSE 0 END END::BIGINT AS exchange_ts, CASE WHEN NOT miss THEN sha256(j) END AS raw_sha256,
 CASE WHEN miss THEN {RESTART_NS} END AS gap_start_ts, CASE WHEN miss THEN 'snapshot_poll_miss' END AS reason, CASE WHEN miss THEN 'no answer after 2 tries' END AS detail FROM x"""
SQL["kline_closes"] = f"WITH {E} SELECT exchange, symbol, exchange_ts // 60000 * 60000 AS t, max({_j('$.p', 'DOUBLE')}) AS mark FROM e WHERE type = 'data' AND stream = 'funding_rate' AND exchange_ts IS NOT NULL AND {_j('$.p', 'DOUBLE')} IS NOT NULL GROUP BY ALL"

SQL["frame_routing_all"] = f"""WITH {E}, s AS (SELECT DISTINCT symbol FROM e WHERE type = 'data' AND raw_text IS NOT NULL AND stream IN ('trades', 'depth', 'bookticker', 'funding_rate', 'liquidations'))
SELECT stream, count(*) AS n, count(*) AS n_same FROM e WHERE type = 'data' AND raw_text IS NOT NULL AND stream IN ('trades', 'depth', 'bookticker', 'funding_rate', 'liquidations')
 AND (stream <> 'liquidations' OR lower(coalesce(json_extract_string(raw_text, '$.o.s'), json_extract_string(raw_text, '$.s'))) IN (SELECT symbol FROM s)) GROUP BY ALL"""


def _hist(rows: str, by: str, value: str, bounds: tuple[int, ...]) -> str:
    les = ", ".join(map(str, bounds))
    return f"SELECT {by}, le, count_if(le IS NULL OR {value} <= le)::BIGINT AS n FROM {rows}, (SELECT unnest([{les}, NULL])::BIGINT AS le) WHERE {value} IS NOT NULL GROUP BY ALL"


SQL["flush_histogram"] = f"WITH {E}, b AS (SELECT exchange, batch_id, (max(received_at) - min(received_at)) // 1000000 AS v FROM e WHERE batch_id IS NOT NULL GROUP BY ALL) {_hist('b', 'exchange', 'v', FLUSH_BUCKETS)}"
SQL["failover_histogram"] = f"WITH {E}, {FO}, fb AS (SELECT stream, (active_to - active_from) // 1000000000 AS v FROM fo WHERE active_to IS NOT NULL) {_hist('fb', 'stream', 'v', FAILOVER_BUCKETS)}"

_PATH = f"pf AS (SELECT * EXCLUDE (exchange, symbol, stream), {_n("string_split(file_path, '/')[-5]")} AS exchange, {_n("string_split(file_path, '/')[-4]")} AS symbol, {_n("string_split(file_path, '/')[-3]")} AS stream FROM f)"
SQL["archive_scan"] = f"WITH {E}, {_PATH} SELECT {DAY}, kind, count(DISTINCT file_path) AS n FROM pf WHERE utc_date = '2021-02-01' AND kind <> 'other' GROUP BY ALL"
SQL["archive_lines"] = f"WITH {E}, {_PATH} SELECT {DAY}, count(*) AS n, 0::BIGINT AS n_torn, sum(row_id)::BIGINT AS row_sum FROM pf GROUP BY ALL"
SQL["archive_tolerant"] = f"WITH {E}, {_PATH} SELECT type, count(*) AS n, sum(received_at::HUGEINT)::VARCHAR AS received_sum FROM pf GROUP BY ALL"
SQL["archive_sidecars"] = f"WITH {E}, {_PATH} SELECT kind, CASE kind WHEN 'base' THEN 'ok' ELSE 'missing' END AS status, count(DISTINCT file_path) AS n FROM pf GROUP BY ALL"
SQL["archive_torn"] = f"WITH {E}, {_PATH}, c AS (SELECT {DAY}, file_path, (count(*) + 9999) // 10000 AS frames FROM pf GROUP BY ALL) SELECT {DAY}, count(*) AS files, sum(frames)::BIGINT AS frames, 0::BIGINT AS torn FROM c GROUP BY ALL"
SQL["last_data_envelopes"] = "SELECT file_path, max(row_id) AS row_id FROM envelopes WHERE type = 'data' AND file_path IS NOT NULL GROUP BY ALL"
SQL["consolidated_days"] = f"""WITH {E}, {_PATH}, d AS (SELECT {DAY}, count(*) AS n, count_if(type = 'gap') AS g, 24 - count(DISTINCT hour_no) AS gone, count(DISTINCT file_path) AS files FROM pf
  WHERE utc_date = '2021-02-01' AND kind IN ('base', 'late', 'backfill') GROUP BY ALL)
SELECT {DAY}, true AS success, (n + gone)::BIGINT AS total_records, (n - g)::BIGINT AS data_records, (g + gone)::BIGINT AS gap_records, gone::INTEGER AS n_missing, files AS source_files_count FROM d
WHERE NOT EXISTS (SELECT 1 FROM pf WHERE kind = 'daily' AND pf.exchange = d.exchange AND pf.symbol = d.symbol AND pf.stream = d.stream AND pf.utc_date = d.utc_date)"""

SQL["dedup_bypass"] = "SELECT _topic, count(*) AS n FROM envelopes WHERE type = 'data' AND (_offset < 0 OR _offset IS NULL OR _topic IS NULL OR _partition IS NULL) GROUP BY ALL"
SQL["parked_gaps_stream"] = f"WITH {E} SELECT DISTINCT {K}, coalesce(source, 'primary') AS source, gap_start_ts FROM e WHERE type = 'gap' AND received_at IS NOT NULL AND gap_start_ts IS NOT NULL"
