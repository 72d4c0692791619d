"""The same results in SQL, computed from the columns of ``events`` and not from JSON."""

from __future__ import annotations

# Literals, not the constants of the code under test.
CACHE_PREFIX = "sfhd_origin_"
LEGACY_CACHE_PREFIX = "sfhd_origin"
CHECK_MESSAGE = "ping"

_M = """
WITH m AS (
  SELECT event_id, ts, event_type, user_id, value,
         CAST(props->>'$.k' AS BIGINT) AS k,
         CAST(event_id % 4 AS INTEGER) AS part, event_id // 4 AS off,
         CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour_s,
         CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS minute_s,
         CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS second_s,
         CAST(epoch(date_trunc('day', ts)) AS BIGINT) // 86400 AS day_n,
         event_type <> 'error' AND event_id % 97 = 0 AS poison
  FROM events
)
"""

_CLAMP = "round(greatest(least({0}, 9999999.999), -9999999.999), 3)"

_MIDDLE = "TIMESTAMP '2024-01-15 00:00:00'"

_LATEST = f"""{_M}
SELECT '{CACHE_PREFIX}' || hour_s AS key, arg_max(value, event_id) AS val FROM m GROUP BY hour_s
"""

_LATEST_BY_DEVICE = f"""{_M}
SELECT '{CACHE_PREFIX}' || hour_s || ':' || k AS key, arg_max(value, event_id) AS val FROM m GROUP BY hour_s, k
"""

_POISON = f"""{_M}
SELECT event_id, '{CHECK_MESSAGE}' AS value, 'not_json' AS reason FROM m WHERE poison
"""

_FIRST = f"""{_M}
SELECT hour_s AS time, arg_min(value, event_id) AS val FROM m GROUP BY hour_s
"""

_ENTRIES = f"""{_M}
SELECT event_id, 'time' AS key, CAST(hour_s AS DOUBLE) AS value FROM m
UNION ALL SELECT event_id, 'VALUE.AV', value FROM m
UNION ALL SELECT event_id, 'K.AV', CAST(k AS DOUBLE) FROM m
"""

_POSITIONS = f"""{_M},
positions AS (
  SELECT part, max(off) + 1 AS next_offset FROM m WHERE ts < {_MIDDLE} AND part < 3 GROUP BY part
)
"""

_RESUMED = f"""{_POSITIONS}
SELECT m.part, m.off FROM m LEFT JOIN positions p ON m.part = p.part
WHERE m.off >= coalesce(p.next_offset, 0)
"""

_STARTED = f"""{_M},
ends AS (SELECT part, max(off) + 1 AS next_offset FROM m WHERE ts < {_MIDDLE} GROUP BY part)
SELECT m.part, m.off FROM m LEFT JOIN ends e ON m.part = e.part
WHERE m.off >= coalesce(e.next_offset, 0)
"""

ORACLE: dict[str, str] = {
    "message_source": f"""{_M}
        SELECT 'readings' AS topic, part, off,
               strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS body_time FROM m""",
    "message_handler": f"""{_M}
        SELECT event_id, 'readings/' || part || '/' || off AS place FROM m""",
    "parse_readings": f"{_M} SELECT event_id, second_s AS time, value AS val, k FROM m",
    "event_epoch_seconds": f"{_M} SELECT event_id, hour_s AS time FROM m",
    "event_epoch_seconds_zone": f"{_M} SELECT event_id, hour_s - 8 * 3600 AS time FROM m",
    "event_epoch_seconds_lenient": f"{_M} SELECT event_id, second_s AS time FROM m",
    "event_epoch_seconds_long_fields": f"{_M} SELECT event_id, second_s AS time FROM m",
    "latest_by_key": _LATEST,
    "latest_by_packed_version": _LATEST,
    "rewrite_time_field": _ENTRIES,
    "reading_entries": _ENTRIES,
    "quarantine_bad_messages": _POISON,
    "cache_key_values": f"""{_M}
        SELECT event_id, '{CACHE_PREFIX}' || hour_s AS key, '{LEGACY_CACHE_PREFIX}' || hour_s AS legacy_key
        FROM m""",
    "live_keys_ttl": f"""{_M}
        SELECT hour_s AS time, arg_max(value, event_id) AS val FROM m
        WHERE hour_s <= epoch({_MIDDLE})
        GROUP BY hour_s HAVING epoch({_MIDDLE}) < max(hour_s) + 86400""",
    "live_keys_out_of_order": f"""{_M},
        w AS (SELECT *, second_s + (event_id * 37 % 5) * 86400 AS written_s FROM m),
        winner AS (
          SELECT k, arg_max(value, event_id) AS val, arg_max(written_s, event_id) + 86400 AS expires_s
          FROM w WHERE written_s <= epoch({_MIDDLE}) GROUP BY k)
        SELECT k, val, expires_s FROM winner WHERE expires_s > epoch({_MIDDLE})""",
    "latest_by_namespace": f"""{_M}
        SELECT part AS db, '{CACHE_PREFIX}' || hour_s AS key, arg_max(value, event_id) AS val
        FROM m GROUP BY part, hour_s""",
    "latest_by_extra_key": _LATEST_BY_DEVICE,
    "stream_latest_by_extra_key": _LATEST_BY_DEVICE,
    "stream_quarantine": _POISON,
    "first_by_key": _FIRST,
    "insert_ignore_existing": f"""{_M}
        SELECT minute_s AS time, arg_min(value, event_id) AS val FROM m
        WHERE NOT EXISTS (
          SELECT 1 FROM m p WHERE p.event_type = 'purchase' AND p.minute_s = m.minute_s)
        GROUP BY minute_s""",
    "infer_table_columns": f"""{_M}
        SELECT DISTINCT 'time' AS column_name, 'bigint' AS column_type FROM m WHERE NOT poison
        UNION ALL SELECT DISTINCT 'ERR.AV', 'double' FROM m WHERE event_type = 'error'
        UNION ALL SELECT DISTINCT 'VALUE.AV', 'double'
        FROM m WHERE event_type <> 'error' AND NOT poison""",
    "infer_table_columns_first": f"""{_M},
        lead AS (SELECT arg_min(event_type, event_id) AS event_type FROM m WHERE NOT poison)
        SELECT 'time' AS column_name, 'bigint' AS column_type FROM lead
        UNION ALL
        SELECT CASE WHEN event_type = 'error' THEN 'ERR.AV' ELSE 'VALUE.AV' END, 'double' FROM lead""",
    "conform_double_10_3": f"""
        SELECT event_id, {_CLAMP.format('value / 7')} AS rounded,
               {_CLAMP.format('value * 100000 - 10000000')} AS clamped FROM events""",
    "conform_to_table_schema": f"""{_M}
        SELECT event_id, second_s AS time,
               CASE WHEN event_type <> 'error' THEN value END AS value_av,
               CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS n_rejected
        FROM m WHERE NOT poison""",
    "reject_unknown_tags": f"""{_M}
        SELECT event_id, 'ERR.AV' AS tag, value, 'unknown_column' AS reason
        FROM m WHERE event_type = 'error'""",
    "offset_ranges": f"""{_M}
        SELECT day_n AS batch, part, min(off) AS from_offset, max(off) + 1 AS until_offset, count(*) AS n
        FROM m GROUP BY day_n, part""",
    "commit_offsets": f"""{_M}
        SELECT 'cache' AS "group", part, max(off) + 1 AS next_offset FROM m GROUP BY part""",
    "resume_from_offsets": _RESUMED,
    "resume_by_join": _RESUMED,
    "resume_from_offsets_two_groups": f"""{_POSITIONS},
        ahead AS (
          SELECT part, max(off) + 1 AS next_offset FROM m
          WHERE ts < {_MIDDLE} + INTERVAL 7 DAY GROUP BY part)
        SELECT 'cache' AS "group", m.part, m.off FROM m LEFT JOIN positions p ON m.part = p.part
        WHERE m.off >= coalesce(p.next_offset, 0)
        UNION ALL
        SELECT 'table', m.part, m.off FROM m LEFT JOIN ahead a ON m.part = a.part
        WHERE m.off >= coalesce(a.next_offset, 0)""",
    "resume_from_offsets_strict": f"""{_POSITIONS}
        SELECT m.part, m.off FROM m JOIN positions p ON m.part = p.part WHERE m.off >= p.next_offset""",
    "resume_pruned_log": _RESUMED,
    "stream_resume_from_offsets": _RESUMED,
    "start_latest": _STARTED,
    "stream_start_latest": _STARTED,
    "stream_pipelined_write": _LATEST,
    "stream_latest_store": _LATEST,
    "stream_live_keys": _LATEST,
    "stream_insert_ignore": _FIRST,
    "stream_first_batch": f"""{_M}
        SELECT hour_s AS time, value AS val FROM m
        QUALIFY row_number() OVER (PARTITION BY hour_s ORDER BY (event_id * 7 // 3) % 4, event_id) = 1""",
    "stream_first_arrival": f"""{_M}
        SELECT hour_s AS time, value AS val FROM m
        QUALIFY row_number() OVER (PARTITION BY hour_s ORDER BY (event_id * 7 // 3) % 4, part, off) = 1""",
    "batch_report": f"""{_M}
        SELECT day_n AS batch, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS report_time, count(*) AS n_in,
               count(*) FILTER (WHERE NOT poison) AS n_good, count(*) FILTER (WHERE poison) AS n_bad
        FROM m GROUP BY day_n""",
    "producer_records": f"""{_M}
        SELECT CAST(NULL AS VARCHAR) AS key, 'readings_out' AS topic,
               strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS time, value AS val FROM m""",
}
