"""The registered queries in SQL, over the same tables."""

from __future__ import annotations

EV = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS seq,
         CASE WHEN user_id % 10 = 9 THEN '' ELSE 'tenant-' || (user_id % 10) END AS tenant_id,
         props AS payload, epoch_us(ts) * 1000 AS timestamp, user_id AS stream_id, event_type,
         CASE WHEN user_id % 10 = 9 THEN 'default' ELSE 'tenant-' || (user_id % 10) END
           AS quota_tenant,
         epoch_us(ts) // 1000000 // 21600 AS window_idx
  FROM events)"""

ADMITTED = EV + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY quota_tenant, window_idx
                               ORDER BY timestamp, seq) <= 6 AS accepted
  FROM ev),
acks AS (
  SELECT *, CASE WHEN accepted THEN 'event queued successfully' ELSE 'rate limit exceeded' END
            AS message, timestamp AS processed_at
  FROM ranked)"""

REQUESTS = """
lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
                               ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS pos
  FROM lineitem),
sizes AS (
  SELECT l_orderkey, count(*) AS n, max(CASE WHEN pos = 1 THEN l_suppkey END) AS supplier
  FROM lines GROUP BY l_orderkey),
named AS (
  SELECT o_orderkey AS batch_id, epoch_us(o_orderdate) * 1000 AS timestamp,
         CAST(coalesce(n, 0) AS INTEGER) AS n,
         CASE WHEN o_custkey % 10 <> 9 THEN 'tenant-' || (o_custkey % 10)
              WHEN n IS NOT NULL THEN 'tenant-' || (supplier % 10) ELSE '' END AS tenant,
         epoch_us(o_orderdate) // 1000000 // 2592000 AS window_idx
  FROM orders LEFT JOIN sizes ON o_orderkey = l_orderkey),
requests AS (
  SELECT *, CASE WHEN tenant = '' THEN 'default' ELSE tenant END AS quota_tenant FROM named)"""

DELIVERIES = """
deliveries AS (
  SELECT l_orderkey || '-' || l_linenumber AS event_id, 'tenant-' || (l_suppkey % 10) AS tenant_id,
         CAST(l_partkey AS VARCHAR) AS payload, epoch_us(l_shipdate) * 1000 AS event_timestamp,
         l_shipdate, l_partkey, l_suppkey, l_shipdate < TIMESTAMP '1996-01-01' AS prior
  FROM lineitem),
firsts AS (
  SELECT * FROM deliveries
  QUALIFY row_number() OVER (PARTITION BY event_id
                             ORDER BY l_shipdate, l_partkey, l_suppkey) = 1)"""

CUSTOMERS = """
placed AS (
  SELECT o_orderkey, 'customer-' || o_custkey AS quota_tenant, epoch_us(o_orderdate) * 1000 AS ns,
         epoch_us(o_orderdate) // 1000000 // (48 * 2592000) AS window_idx
  FROM orders),
parted AS (
  SELECT *, dense_rank() OVER (ORDER BY CAST(ns - low AS HUGEINT) * 6 // (high - low + 1)) AS part
  FROM placed, (SELECT min(ns) AS low, max(ns) AS high FROM placed))"""

CALLS = """
calls AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'unary' WHEN 'N' THEN 'batch' ELSE 'stream' END AS mode,
         l_suppkey % 10 AS worker_id, l_extendedprice AS latency, l_discount < 0.09 AS ok,
         CAST(l_quantity AS INTEGER) AS n_events,
         least(CAST(l_quantity AS INTEGER), l_linenumber - 1) AS rejected_count,
         epoch_us(l_shipdate) AS started_us,
         l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem)"""

ACK_COLUMNS = "event_id, tenant_id, quota_tenant, window_idx, accepted, message, processed_at"
BACKLOG = """
waiting AS (
  SELECT tenant_id, count(*) AS waiting FROM deliveries
  WHERE event_id NOT IN (SELECT event_id FROM deliveries WHERE prior) GROUP BY tenant_id)"""


def _byte(expr: str) -> str:
    return f"printf('%02X', {expr})"


def _text_field(tag: str, column: str) -> str:
    """A string field of fewer than 128 bytes; absent when empty."""
    return (f"CASE WHEN {column} = '' THEN '' ELSE '{tag}' || "
            f"{_byte(f'octet_length(encode({column}))')} || hex(encode({column})) END")


_TIMESTAMP_FIELD = "'20' || " + " || ".join(
    _byte(f"((timestamp >> {7 * i}) & 127) + {128 if i < 8 else 0}") for i in range(9))
EVENT_HEX = " || ".join([_text_field("0A", "event_id"), _text_field("12", "tenant_id"),
                         _text_field("1A", "payload"), _TIMESTAMP_FIELD])

FITTED = ADMITTED + """,
fitted AS (
  SELECT *, NOT accepted OR sum(CAST(accepted AS INTEGER)) OVER (
              PARTITION BY window_idx ORDER BY timestamp, seq) <= 40 AS fits
  FROM acks),
capped AS (
  SELECT * EXCLUDE (accepted, message), accepted AND fits AS accepted,
         CASE WHEN accepted AND NOT fits THEN 'buffer full; shed load' ELSE message END AS message
  FROM fitted)"""

TAKEN = REQUESTS + """,
charged AS (
  SELECT *, n = 0 OR sum(n) OVER (PARTITION BY quota_tenant, window_idx
                                  ORDER BY timestamp, batch_id) <= 40 AS admitted
  FROM requests),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY window_idx ORDER BY timestamp, batch_id) AS batch_no
  FROM charged WHERE admitted AND n > 0),
taken AS (
  SELECT batch_id, greatest(0, least(n, 20 - (sum(n) OVER (
           PARTITION BY window_idx, batch_no % 4 ORDER BY batch_no) - n))) AS taken
  FROM numbered)"""

SAME_AS_ADMISSION = f"WITH {ADMITTED} SELECT {ACK_COLUMNS} FROM acks"

ROW_CAP = f"""
WITH {EV}
SELECT event_id, window_idx,
       row_number() OVER (PARTITION BY window_idx ORDER BY timestamp, seq) <= 40 AS buffered
FROM ev"""

FIRST_WRITE = f"""
WITH {DELIVERIES} SELECT event_id, tenant_id, payload, event_timestamp FROM firsts"""

ORACLE: dict[str, str] = {
    "ingest_events": f"""
WITH {EV} SELECT event_id, tenant_id, payload, timestamp, timestamp // 1000 AS arrival_us FROM ev""",
    "quota_keys": f"""
WITH {EV}
SELECT event_id, tenant_id, quota_tenant, window_idx,
       'ratelimit:' || quota_tenant || ':' || window_idx AS ledger_key
FROM ev""",
    "quota_admission": SAME_AS_ADMISSION,
    "quota_admission_split": SAME_AS_ADMISSION,
    "quota_incremental": SAME_AS_ADMISSION,
    "admission_rejects": f"""
WITH {ADMITTED} SELECT event_id, tenant_id, payload, message FROM acks WHERE NOT accepted""",
    "quota_ledger": f"""
WITH {EV}
SELECT quota_tenant, window_idx, least(count(*), 6) AS used FROM ev GROUP BY ALL""",
    "quota_leased": f"""
WITH RECURSIVE {EV},
cells AS (
  SELECT quota_tenant, window_idx, count(*) AS n,
         row_number() OVER (PARTITION BY quota_tenant ORDER BY window_idx) AS k
  FROM ev GROUP BY quota_tenant, window_idx),
fold AS (
  SELECT quota_tenant, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS window_idx,
         CAST(0 AS BIGINT) AS allowed, CAST(0 AS BIGINT) AS carry
  FROM (SELECT DISTINCT quota_tenant FROM cells)
  UNION ALL
  SELECT c.quota_tenant, c.k, c.window_idx, least(c.n, f.carry + 6),
         CASE WHEN c.n <= f.carry THEN f.carry - c.n
              ELSE least((least(c.n - f.carry, 6) + 3) // 4 * 4, 6) - least(c.n - f.carry, 6) END
  FROM fold f JOIN cells c ON c.quota_tenant = f.quota_tenant AND c.k = f.k + 1)
SELECT event_id, ev.quota_tenant, ev.window_idx,
       row_number() OVER (PARTITION BY ev.quota_tenant, ev.window_idx ORDER BY timestamp, seq)
         <= allowed AS admitted
FROM ev JOIN fold ON fold.quota_tenant = ev.quota_tenant AND fold.window_idx = ev.window_idx""",
    "quota_leased_idle": f"""
WITH RECURSIVE {EV},
gaps AS (
  SELECT *, coalesce(timestamp // 1000000000 - lag(timestamp // 1000000000)
                       OVER (PARTITION BY quota_tenant ORDER BY timestamp, seq) > 3600, TRUE)
            AS opens
  FROM ev),
sessions AS (
  SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY quota_tenant ORDER BY timestamp, seq)
            AS session
  FROM gaps),
cells AS (
  SELECT quota_tenant, window_idx, session, count(*) AS n, bool_or(opens) AS fresh,
         row_number() OVER (PARTITION BY quota_tenant ORDER BY window_idx, session) AS k
  FROM sessions GROUP BY quota_tenant, window_idx, session),
fold AS (
  SELECT quota_tenant, CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS window_idx,
         CAST(0 AS HUGEINT) AS session,
         CAST(0 AS BIGINT) AS allowed, CAST(0 AS BIGINT) AS carry, CAST(0 AS BIGINT) AS used
  FROM (SELECT DISTINCT quota_tenant FROM cells)
  UNION ALL
  SELECT quota_tenant, k, window_idx, session, least(n, c + 6 - u),
         CASE WHEN n <= c THEN c - n
              ELSE least((least(n - c, 6 - u) + 3) // 4 * 4, 6 - u) - least(n - c, 6 - u) END,
         CASE WHEN n <= c THEN u
              ELSE u + least((least(n - c, 6 - u) + 3) // 4 * 4, 6 - u) END
  FROM (SELECT s.quota_tenant, s.k, s.window_idx, s.session, s.n,
               CASE WHEN s.fresh THEN 0 ELSE f.carry END AS c,
               CASE WHEN s.window_idx = f.window_idx THEN f.used ELSE 0 END AS u
        FROM fold f JOIN cells s ON s.quota_tenant = f.quota_tenant AND s.k = f.k + 1))
SELECT event_id, s.quota_tenant, s.window_idx,
       row_number() OVER (PARTITION BY s.quota_tenant, s.window_idx, s.session
                          ORDER BY timestamp, seq) <= allowed AS admitted
FROM sessions s JOIN fold f ON f.quota_tenant = s.quota_tenant
 AND f.window_idx = s.window_idx AND f.session = s.session""",
    "quota_leased_weighted": f"""
WITH RECURSIVE {REQUESTS},
paying AS (
  SELECT *, row_number() OVER (PARTITION BY quota_tenant ORDER BY timestamp, batch_id) AS k
  FROM requests WHERE n > 0),
fold AS (
  SELECT quota_tenant, CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS batch_id,
         CAST(-1 AS BIGINT) AS window_idx, CAST(0 AS BIGINT) AS tokens, CAST(0 AS BIGINT) AS used,
         FALSE AS admitted
  FROM (SELECT DISTINCT quota_tenant FROM paying)
  UNION ALL
  SELECT quota_tenant, k, batch_id, window_idx,
         CASE WHEN t >= n THEN t - n WHEN g >= n THEN g - n ELSE 0 END,
         CASE WHEN t >= n THEN u ELSE u + g END,
         t >= n OR g >= n
  FROM (SELECT *, least(40 - u, greatest(10, n)) AS g
        FROM (SELECT p.quota_tenant, p.k, p.batch_id, p.window_idx, p.n, f.tokens AS t,
                     CASE WHEN p.window_idx = f.window_idx THEN f.used ELSE 0 END AS u
              FROM fold f JOIN paying p ON p.quota_tenant = f.quota_tenant AND p.k = f.k + 1)))
SELECT r.batch_id, r.quota_tenant, r.window_idx, r.n, coalesce(f.admitted, TRUE) AS admitted
FROM requests r LEFT JOIN fold f ON f.batch_id = r.batch_id""",
    "batch_unpack": """
SELECT o_orderkey AS batch_id,
       CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                               l_shipdate) - 1 AS INTEGER) AS position,
       l_orderkey || '-' || l_linenumber AS event_id, 'tenant-' || (l_suppkey % 10) AS tenant_id,
       l_returnflag AS payload, epoch_us(l_shipdate) * 1000 AS timestamp
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "batch_accepted_events": f"""
WITH {TAKEN}
SELECT batch_id, l_orderkey || '-' || l_linenumber AS event_id,
       'tenant-' || (l_suppkey % 10) AS tenant_id, l_returnflag AS payload,
       epoch_us(l_shipdate) * 1000 AS timestamp
FROM lines JOIN taken ON batch_id = l_orderkey WHERE pos <= taken""",
    "batch_acks": f"""
WITH {TAKEN}
SELECT c.batch_id, quota_tenant, n, n = 0 OR (admitted AND taken = n) AS accepted,
       CAST(coalesce(taken, 0) AS INTEGER) AS accepted_count,
       CAST(n - coalesce(taken, 0) AS INTEGER) AS rejected_count,
       CASE WHEN n = 0 THEN 'empty batch' WHEN NOT admitted THEN 'rate limit exceeded'
            ELSE 'batch processed' END AS message,
       timestamp AS processed_at
FROM charged c LEFT JOIN taken t ON t.batch_id = c.batch_id""",
    "stream_acks": f"""
WITH {FITTED}
SELECT stream_id, bool_or(accepted) AS accepted, count(*) AS total_received,
       count(*) FILTER (WHERE accepted) AS accepted_count,
       count(*) FILTER (WHERE NOT accepted) AS rejected_count,
       'stream ingestion completed' AS message, max(processed_at) AS processed_at
FROM capped GROUP BY stream_id""",
    "accepted_records": f"""
WITH {FITTED}
SELECT 'events' AS topic, event_id AS key, {EVENT_HEX} AS value_hex
FROM fitted WHERE accepted AND fits""",
    "event_acks": f"""
WITH {FITTED}
SELECT event_id, tenant_id, quota_tenant, window_idx, accepted AND fits AS accepted,
       CASE WHEN accepted AND NOT fits THEN 'buffer full; shed load' ELSE message END AS message,
       processed_at
FROM fitted""",
    "row_cap": ROW_CAP,
    "stream_cap": ROW_CAP,
    "batch_cap": f"""
WITH {REQUESTS},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY window_idx ORDER BY timestamp, batch_id) AS batch_no
  FROM requests WHERE n > 0),
placed AS (
  SELECT *, batch_no % 4 AS shard, sum(n) OVER (PARTITION BY window_idx, batch_no % 4
                                                ORDER BY batch_no) - n AS ahead
  FROM numbered)
SELECT r.batch_id, r.window_idx, r.n, batch_no, shard,
       CAST(coalesce(greatest(0, least(r.n, 20 - ahead)), 0) AS INTEGER) AS accepted_count
FROM requests r LEFT JOIN placed p ON p.batch_id = r.batch_id""",
    "broker_records": f"""
WITH {EV}
SELECT CASE WHEN seq % 5 = 0 THEN 'events' ELSE 'events-in' END AS topic, event_id AS key,
       {EVENT_HEX} AS value_hex
FROM ev""",
    "topic_round_trip": f"""
WITH {EV}
SELECT 'events' AS topic, event_id AS key,
       CASE WHEN seq % 97 = 0 THEN 'FFFFFF' ELSE {EVENT_HEX} END AS value_hex,
       timestamp // 1000 AS time_us
FROM ev""",
    "decode_quarantine": f"""
WITH {EV}
SELECT event_id AS key, CASE WHEN seq % 97 <> 0 THEN event_id END AS event_id,
       CASE WHEN seq % 97 <> 0 THEN tenant_id END AS tenant_id,
       CASE WHEN seq % 97 <> 0 THEN payload END AS payload,
       CASE WHEN seq % 97 <> 0 THEN timestamp END AS timestamp, seq % 97 <> 0 AS decoded
FROM ev""",
    "dead_letter_lines": f"""
WITH {EV}
SELECT regexp_replace(strftime(make_timestamp(timestamp // 1000), '%Y-%m-%dT%H:%M:%S.%f'),
                      '\\.?0+$', '') || 'Z' || chr(9) || 'events' || chr(9) || event_id || chr(9)
       || 'delivery\\tfailed' || chr(9) || base64(encode(payload)) AS line
FROM ev WHERE event_type = 'error'""",
    "dead_letter_replay": f"""
WITH {EV}
SELECT event_id, tenant_id, payload, timestamp FROM ev WHERE event_type = 'error'""",
    "failure_counters": f"""
WITH {EV}
SELECT count(DISTINCT seq // 128) AS publish_errors, count(*) AS async_errors,
       count(*) AS dead_lettered
FROM ev WHERE event_type = 'error'""",
    "constraint_quarantine": """
WITH keyed AS (SELECT doc_id, text AS event_id, lang FROM documents)
SELECT doc_id, event_id,
       CASE WHEN length(event_id) > 64 THEN 'event_id longer than 64'
            WHEN length(lang) > 64 THEN 'tenant_id longer than 64' END AS reason
FROM keyed""",
    "persist_first_write": FIRST_WRITE,
    "stream_persist": FIRST_WRITE,
    "stream_retried": FIRST_WRITE,
    "table_compacted": FIRST_WRITE,
    "persist_incremental": f"""
WITH {DELIVERIES}
SELECT event_id, tenant_id, payload, event_timestamp,
       CASE WHEN prior THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS batch_id
FROM firsts""",
    "persist_counts": f"""
WITH {DELIVERIES}
SELECT CAST(0 AS BIGINT) AS batch_id, (SELECT count(*) FROM deliveries WHERE prior) AS attempted,
       (SELECT count(*) FROM firsts WHERE prior) AS inserted
UNION ALL
SELECT CAST(1 AS BIGINT), (SELECT count(*) FROM deliveries WHERE NOT prior),
       (SELECT count(*) FROM firsts WHERE NOT prior)""",
    "backlog": f"""
WITH {DELIVERIES}, {BACKLOG} SELECT tenant_id, waiting FROM waiting""",
    "outcome_report": f"""
WITH {FITTED} SELECT tenant_id, message, count(*) AS events FROM capped GROUP BY ALL""",
    "outcome_counters": f"""
WITH {FITTED}, {TAKEN}, {DELIVERIES}, {BACKLOG},
batched AS (
  SELECT CAST(sum(coalesce(taken, 0)) AS BIGINT) AS taken,
         CAST(sum(n - coalesce(taken, 0)) AS BIGINT) AS denied
  FROM charged c LEFT JOIN taken t ON t.batch_id = c.batch_id),
failed AS (SELECT count(DISTINCT seq // 128) AS batches, count(*) AS n
           FROM ev WHERE event_type = 'error')
SELECT 'events_accepted_total' AS counter,
       count(*) FILTER (WHERE accepted) + (SELECT taken FROM batched) AS value FROM capped
UNION ALL SELECT 'events_rejected_total',
       count(*) FILTER (WHERE NOT accepted) + (SELECT denied FROM batched) FROM capped
UNION ALL SELECT 'worker_queue_depth', CAST(sum(waiting) AS BIGINT) FROM waiting
UNION ALL SELECT 'worker_publish_errors_total', batches FROM failed
UNION ALL SELECT 'kafka_async_errors_total', n FROM failed
UNION ALL SELECT 'dlq_persisted_total', n FROM failed""",
    "load_summary": f"""
WITH {CALLS},
totals AS (
  SELECT mode, count(*) AS total_rpcs, count(*) FILTER (WHERE ok) AS ok_rpcs,
         CAST(sum(CASE WHEN NOT ok THEN 0 WHEN mode = 'unary' THEN 1
                       ELSE n_events - rejected_count END) AS BIGINT) AS ok_events,
         CAST(sum(CASE WHEN mode = 'unary' THEN CASE WHEN ok THEN 0 ELSE 1 END
                       WHEN ok THEN rejected_count ELSE n_events END) AS BIGINT) AS error_events,
         (max(started_us) - min(started_us))::DOUBLE / 1000000 AS elapsed_sec
  FROM calls GROUP BY mode)
SELECT mode, total_rpcs, ok_rpcs, total_rpcs - ok_rpcs AS error_rpcs,
       ok_events + error_events AS total_events, ok_events, error_events, elapsed_sec,
       CASE WHEN elapsed_sec > 0 THEN ok_events::DOUBLE / elapsed_sec END AS events_per_sec,
       CASE WHEN elapsed_sec > 0 THEN ok_rpcs::DOUBLE / elapsed_sec END AS rpcs_per_sec,
       CASE WHEN ok_events + error_events > 0
            THEN error_events::DOUBLE / (ok_events + error_events)::DOUBLE * 100
            ELSE 0.0::DOUBLE END AS error_pct
FROM totals""",
    "latency_ranks": f"""
WITH {CALLS},
ranked AS (
  SELECT mode, latency, row_number() OVER (PARTITION BY mode ORDER BY latency) - 1 AS pos,
         count(*) OVER (PARTITION BY mode) AS n
  FROM calls)
SELECT mode, max(n) AS n,
       max(latency) FILTER (WHERE pos = CAST(floor(n * 0.50::DOUBLE) AS BIGINT)) AS p50,
       max(latency) FILTER (WHERE pos = CAST(floor(n * 0.95::DOUBLE) AS BIGINT)) AS p95,
       max(latency) FILTER (WHERE pos = CAST(floor(n * 0.99::DOUBLE) AS BIGINT)) AS p99,
       max(latency) AS max_latency
FROM ranked GROUP BY mode""",
    "latency_sample": f"""
WITH {CALLS},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY mode, worker_id ORDER BY l_shipdate, l_orderkey,
                               l_linenumber, l_partkey, l_suppkey) AS call_no
  FROM calls),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY mode, worker_id ORDER BY call_no) AS sample_no
  FROM numbered WHERE call_no % 10 = 0 AND ok)
SELECT mode, worker_id, call_no, sample_no, latency FROM kept WHERE sample_no <= 50""",
    "stream_quota": SAME_AS_ADMISSION,
    "stream_quota_ledger": SAME_AS_ADMISSION,
    "stream_quota_idle": f"""
WITH {CUSTOMERS}
SELECT o_orderkey, quota_tenant, window_idx,
       row_number() OVER (PARTITION BY quota_tenant, window_idx ORDER BY ns, o_orderkey) <= 6
         AS accepted
FROM placed""",
    "stream_quota_sweeps": f"""
WITH {CUSTOMERS},
heard AS (SELECT DISTINCT quota_tenant, part FROM parted),
flushes AS (SELECT DISTINCT part FROM parted),
last AS (
  SELECT f.part, h.quota_tenant, max(h.part) AS last,
         max(CASE WHEN h.part < f.part THEN h.part END) AS earlier
  FROM flushes f JOIN heard h ON h.part <= f.part GROUP BY ALL),
used AS (SELECT quota_tenant, window_idx, min(part) AS since FROM parted GROUP BY ALL),
ledger AS (
  SELECT l.part, count(*) AS n FROM last l JOIN used u
  ON u.quota_tenant = l.quota_tenant AND u.since <= l.part
  WHERE l.last >= l.part - 1 GROUP BY ALL)
SELECT l.part - 1 AS batch_id, count(*) FILTER (last >= l.part - 1) AS tenants_held,
       any_value(n) AS ledger_rows, count(*) FILTER (last = l.part - 2) AS tenants_forgotten,
       count(*) FILTER (last = l.part AND earlier <= l.part - 3) AS tenants_back
FROM last l JOIN ledger g ON g.part = l.part GROUP BY l.part""",
    "stream_event_acks": f"""
WITH {FITTED}
SELECT event_id, tenant_id, quota_tenant, window_idx, accepted, message, processed_at
FROM capped""",
    "stream_flushes": f"""
WITH {DELIVERIES},
days AS (SELECT *, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS day
         FROM deliveries),
bounds AS (SELECT min(day) AS low, max(day) AS high FROM days),
parts AS (SELECT event_id, dense_rank() OVER (ORDER BY ((day - low) * 4) // (high - low + 1)) - 1
                 AS batch_id
          FROM days, bounds),
fresh AS (SELECT event_id, min(batch_id) AS batch_id FROM parts GROUP BY event_id),
news AS (SELECT batch_id, count(*) AS inserted FROM fresh GROUP BY batch_id),
sums AS (SELECT batch_id, count(*) AS attempted FROM parts GROUP BY batch_id)
SELECT batch_id, attempted, coalesce(inserted, 0) AS inserted,
       CAST(0 AS BIGINT) AS undecodable, CAST(0 AS BIGINT) AS constraint_failures,
       CAST(sum(attempted) OVER (ORDER BY batch_id) AS BIGINT) AS total_persisted
FROM sums LEFT JOIN news USING (batch_id)""",
    "stream_late": f"""
WITH {EV},
bounds AS (SELECT min(seq) AS low, max(seq) AS high FROM ev),
stamped AS (
  SELECT event_id, seq, quota_tenant, ((seq - low) * 4) // (high - low + 1) AS part,
         timestamp + CASE WHEN tenant_id = 'tenant-3' AND seq % 97 = 0
                          THEN 3153600000000000000 ELSE 0 END AS stamp
  FROM ev, bounds),
windowed AS (SELECT *, stamp // 1000000000 // 21600 AS window_idx FROM stamped),
newest AS (
  SELECT quota_tenant, part, max(max(window_idx)) OVER (
           PARTITION BY quota_tenant ORDER BY part) AS newest
  FROM windowed GROUP BY quota_tenant, part),
marked AS (
  SELECT w.*, coalesce(window_idx < (
           SELECT max(newest) FROM newest n
           WHERE n.quota_tenant = w.quota_tenant AND n.part < w.part) - 8, false) AS late
  FROM windowed w),
ranked AS (
  SELECT *, NOT late AND row_number() OVER (PARTITION BY quota_tenant, window_idx, late
                                            ORDER BY part, stamp, seq) <= 6 AS accepted
  FROM marked)
SELECT event_id, quota_tenant, window_idx, accepted,
       CASE WHEN late THEN 'window closed' WHEN accepted THEN 'event queued successfully'
            ELSE 'rate limit exceeded' END AS message
FROM ranked""",
    "dead_letter_persisted": f"""
WITH {EV}
SELECT event_id, CASE WHEN seq % 97 = 0 THEN 'poison' ELSE 'stored' END AS status,
       CASE WHEN seq % 97 = 0 THEN CAST(3 AS INTEGER) END AS attempts,
       CASE WHEN seq % 97 <> 0 THEN payload END AS payload,
       CASE WHEN seq % 97 = 0 AND seq % 5 = 0 THEN CAST(2 AS BIGINT) ELSE CAST(1 AS BIGINT) END
         AS lines
FROM ev""",
    "stream_dedupe_bounded": f"""
WITH {EV} SELECT event_id, tenant_id, payload, timestamp FROM ev""",
}

ORACLE["stream_quota_leased"] = ORACLE["quota_leased"]
ORACLE["stream_batch_acks"] = ORACLE["batch_acks"]
ORACLE["live_counters"] = ORACLE["outcome_counters"]
ORACLE["latency_of_runs"] = ORACLE["latency_ranks"]
