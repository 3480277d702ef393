"""The same results as problems.py in SQL, written another way."""

N = "lower(trim({0}, ' \t\r\n'))"
_n = lambda c: N.format(c)

_P1 = f"""
WITH r AS (SELECT {_n('exchange')} AS exchange, {_n('symbol')} AS symbol, {_n('stream')} AS stream, start_ms, end_ms
           FROM gap_records WHERE start_ms <= end_ms),
m AS (SELECT *, max(end_ms) OVER (PARTITION BY exchange, symbol, stream ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM r),
g AS (SELECT *, sum(CASE WHEN start_ms <= upto + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY exchange, symbol, stream ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS island FROM m),
p AS (SELECT exchange, symbol, stream, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM g GROUP BY exchange, symbol, stream, island),
q AS (SELECT *, lead(start_ms) OVER (PARTITION BY exchange, symbol, stream ORDER BY start_ms) AS nxt FROM p)
SELECT 'period' AS kind, exchange, symbol, stream, start_ms, end_ms FROM p
UNION ALL SELECT 'gap', exchange, symbol, stream, end_ms + 1, nxt - 1 FROM q WHERE nxt - 1 - end_ms < 86400000"""

_P2 = f"""
WITH c AS (SELECT {_n('exchange')} AS exchange, {_n('symbol')} AS symbol, {_n('stream')} AS stream, hour_start_ms, max(last_received_at) AS upto FROM stream_checkpoint GROUP BY 1, 2, 3, 4),
e AS (SELECT {_n('exchange')} AS exchange, {_n('symbol')} AS symbol, {_n('stream')} AS stream, exchange_ts // 3600000 * 3600000 AS hour_start_ms, received_at,
        CASE WHEN collector_session_id IS NOT NULL AND session_seq >= 0 THEN 's:' || collector_session_id
             WHEN _topic IS NOT NULL AND _partition IS NOT NULL AND _offset >= 0 THEN 'b:' || _topic || ':' || _partition ELSE 'r' END AS source,
        CASE WHEN collector_session_id IS NOT NULL AND session_seq >= 0 THEN session_seq
             WHEN _topic IS NOT NULL AND _partition IS NOT NULL AND _offset >= 0 THEN _offset ELSE row_id END AS version
      FROM envelopes WHERE type = 'data' AND exchange_ts IS NOT NULL),
l AS (SELECT e.*, CASE WHEN received_at > upto THEN CASE WHEN received_at >= (hour_start_ms + 25200000) * 1000000 THEN 2 ELSE 1 END ELSE 0 END AS class
      FROM e LEFT JOIN c USING (exchange, symbol, stream, hour_start_ms))"""

# Messages: a row with broker coordinates only takes the session that a copy of it in its stream has.
_BY_S = "collector_session_id IS NOT NULL AND session_seq >= 0"
_BY_B = "_topic IS NOT NULL AND _partition IS NOT NULL AND _offset >= 0"
_P2_ONE = _P2.replace("FROM envelopes WHERE type = 'data' AND exchange_ts IS NOT NULL", "FROM one WHERE exchange_ts IS NOT NULL").replace("WITH c AS", f"""WITH n AS (SELECT * EXCLUDE (exchange, symbol, stream), {_n('exchange')} AS exchange, {_n('symbol')} AS symbol, {_n('stream')} AS stream FROM envelopes WHERE type = 'data'),
t AS (SELECT exchange, symbol, stream, _topic, _partition, _offset, collector_session_id AS s, session_seq AS q FROM n WHERE {_BY_B} AND {_BY_S} QUALIFY row_number() OVER (PARTITION BY exchange, symbol, stream, _topic, _partition, _offset ORDER BY collector_session_id, session_seq) = 1),
one AS (SELECT n.* REPLACE (CASE WHEN t.s IS NOT NULL AND NOT coalesce({_BY_S}, false) THEN t.s ELSE collector_session_id END AS collector_session_id, CASE WHEN t.s IS NOT NULL AND NOT coalesce({_BY_S}, false) THEN t.q ELSE session_seq END AS session_seq)
  FROM n LEFT JOIN t USING (exchange, symbol, stream, _topic, _partition, _offset)),
c AS""", 1)

_P2_FOUND = f"{_P2} SELECT DISTINCT exchange, symbol, stream, hour_start_ms, CASE class WHEN 1 THEN 'corrected' ELSE 'cut_off' END AS outcome FROM l WHERE class > 0"

_P2_COUNTS = f"""{_P2_ONE}, u AS (SELECT exchange, symbol, stream, hour_start_ms, source, version, min(class) AS class FROM l GROUP BY ALL)
SELECT exchange, symbol, stream, hour_start_ms, count_if(class = 0)::BIGINT AS n_on_time, count_if(class = 1)::BIGINT AS n_corrected, count_if(class = 2)::BIGINT AS n_cut_off, count_if(class < 2)::BIGINT AS n_final
FROM u GROUP BY ALL"""

_P3 = r"""
WITH f AS (SELECT file_path, arg_max(size_bytes, listed_at) AS size FROM archive_files WHERE file_path IS NOT NULL GROUP BY file_path),
p AS (SELECT *, string_split(file_path, '/') AS a FROM f),
k AS (SELECT file_path, size, lower(trim(a[-5])) || '/' || lower(trim(a[-4])) || '/' || lower(trim(a[-3])) || '/' || a[-2] AS day,
        regexp_matches(a[-1], '^hour-[0-9]{1,2}(\.(late|backfill)-[0-9]+)?\.jsonl\.zst$') AS hourly, a[-1] = a[-2] || '.jsonl.zst' AS daily FROM p),
d AS (SELECT *, count_if(hourly AND size > 0 AND size < 8192) OVER (PARTITION BY day) AS n, count_if(daily AND size > 0) OVER (PARTITION BY day) AS whole FROM k)
SELECT file_path FROM d WHERE hourly AND size > 0 AND size < 8192 AND n >= 2 AND whole = 0"""

_P3_PLAN = f"""WITH t AS ({_P3}), q AS (SELECT file_path, arg_max(size_bytes, listed_at) AS size_bytes FROM archive_files WHERE file_path IN (SELECT file_path FROM t) GROUP BY file_path),
k AS (SELECT *, string_split(file_path, '/') AS a FROM q), h AS (SELECT *, 'archive/' || lower(trim(a[-5])) || '/' || lower(trim(a[-4])) || '/' || lower(trim(a[-3])) || '/' || a[-2] || '/part-00000.jsonl.zst' AS target_path,
  regexp_extract(a[-1], '^hour-([0-9]+)', 1)::INTEGER AS hour, CASE WHEN a[-1] LIKE '%.late-%' THEN 1 WHEN a[-1] LIKE '%.backfill-%' THEN 2 ELSE 0 END AS rank, TRY_CAST(nullif(regexp_extract(a[-1], '-([0-9]+)\\.jsonl', 1), '') AS INTEGER) AS n FROM k)
SELECT file_path, target_path, row_number() OVER w AS source_no, size_bytes, (sum(size_bytes) OVER w - size_bytes)::BIGINT AS target_offset FROM h
WINDOW w AS (PARTITION BY target_path ORDER BY hour, rank, CASE rank WHEN 0 THEN 0 ELSE n END, file_path ROWS UNBOUNDED PRECEDING)"""

_P3_DONE = f"""WITH t AS ({_P3}), p AS (SELECT file_path, string_split(file_path, '/') AS a FROM t),
k AS (SELECT file_path, 'archive/' || lower(trim(a[-5])) || '/' || lower(trim(a[-4])) || '/' || lower(trim(a[-3])) || '/' || a[-2] || '/part-00000.jsonl.zst' AS target_path FROM p),
e AS (SELECT file_path, ('0x' || substr(md5(row_id || '|' || coalesce(raw_text, '')), 1, 15))::BIGINT AS h FROM envelopes WHERE file_path IS NOT NULL)
SELECT target_path, count(DISTINCT file_path) AS source_files, count(h) AS n_lines, 0::BIGINT AS n_torn, coalesce(sum(h::HUGEINT), 0)::VARCHAR AS record_sum, NULL::VARCHAR AS error
FROM k LEFT JOIN e USING (file_path) GROUP BY target_path"""

_FIELDS = ["exchange", "symbol", "stream", "start_ms", "end_ms", "reason", "detail"]


def _side(t: str) -> str:
    return f"""(SELECT gap_id, {', '.join(f'{_n(c)} AS {c}' for c in ('exchange', 'symbol', 'stream', 'reason'))}, start_ms, end_ms, nullif(detail, '') AS detail
    FROM {t} QUALIFY row_number() OVER (PARTITION BY gap_id ORDER BY recorded_at DESC NULLS LAST, exchange DESC, symbol DESC, stream DESC, start_ms DESC) = 1)"""


_P4_BASE = f"WITH a AS {_side('gap_records')}, b AS {_side('gap_state')}"
_P4_DIFF = f"""{_P4_BASE}
SELECT gap_id, 'left_only' AS status, NULL::VARCHAR AS field, NULL::VARCHAR AS left_value, NULL::VARCHAR AS right_value FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.gap_id IS NOT DISTINCT FROM a.gap_id)
UNION ALL SELECT gap_id, 'right_only', NULL, NULL, NULL FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.gap_id IS NOT DISTINCT FROM b.gap_id)
""" + "".join(f"UNION ALL SELECT a.gap_id, 'differs', '{f}', a.{f}::VARCHAR, b.{f}::VARCHAR FROM a JOIN b ON a.gap_id IS NOT DISTINCT FROM b.gap_id WHERE a.{f} IS DISTINCT FROM b.{f}\n" for f in _FIELDS)
_P4 = f"SELECT gap_id, CASE status WHEN 'left_only' THEN 'missing_in_state' WHEN 'right_only' THEN 'missing_in_file' ELSE field END AS difference FROM ({_P4_DIFF})"

# Rows of a message agree in an identifier; the recursion spreads the least row over further copies.
_P5 = f"""
WITH RECURSIVE e AS (SELECT row_id,
    CASE WHEN collector_session_id IS NOT NULL AND session_seq >= 0 THEN {_n('exchange')} || chr(1) || {_n('symbol')} || chr(1) || {_n('stream')} || chr(1) || collector_session_id || chr(1) || session_seq END AS s,
    CASE WHEN _topic IS NOT NULL AND _partition IS NOT NULL AND _offset >= 0 THEN _topic || chr(1) || _partition || chr(1) || _offset END AS b
  FROM envelopes WHERE type = 'data'),
i AS (SELECT row_id, 's' || s AS id FROM e WHERE s IS NOT NULL UNION ALL SELECT row_id, 'b' || b FROM e WHERE b IS NOT NULL),
m AS (SELECT row_id, id FROM i QUALIFY count(*) OVER (PARTITION BY id) > 1),
x AS (SELECT DISTINCT a.row_id AS a, b.row_id AS b FROM m a JOIN (SELECT id, min(row_id) AS row_id FROM m GROUP BY id) b USING (id)),
y AS (SELECT a, b FROM x UNION SELECT b, a FROM x),
r(a, b) AS (SELECT a, a FROM y UNION SELECT r.a, y.b FROM r JOIN y ON r.b = y.a)
SELECT a AS row_id FROM r GROUP BY a HAVING min(b) < a"""

_P5_KEPT = f"SELECT row_id, collector_session_id, session_seq, _topic, _partition, _offset FROM envelopes WHERE type = 'data' AND row_id NOT IN (SELECT row_id FROM ({_P5}))"

SQL = {"p1_found": _P1, "p2_found": _P2_FOUND, "p2_counts": _P2_COUNTS, "p3_found": _P3, "p3_plan": _P3_PLAN, "p3_consolidated": _P3_DONE, "p4_found": _P4, "p4_differences": _P4_DIFF, "p5_found": _P5, "p5_kept": _P5_KEPT}
