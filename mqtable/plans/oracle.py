"""DuckDB statements that compute what each registered query computes.

They are written independently of the Spark code: plain window functions
over the whole table (``row_number``, ``lag``, running ``sum``) and
hand-written anchored regular expressions for the topic patterns.
"""

from __future__ import annotations

M = r"""
m AS (
  SELECT event_id AS message_id,
         event_type AS queue,
         CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS BIGINT) AS delivery_tag,
         'events' AS exchange,
         concat('events.', event_type, '.u', CAST(user_id % 4 AS VARCHAR)) AS routing_key,
         CASE WHEN event_id % 17 = 0 THEN substring(props, 1, length(props) - 1) ELSE props END AS body,
         CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS header_user,
         CAST(CASE WHEN user_id % 5 <> 0 THEN user_id % 7 END AS INT) AS priority,
         CAST(CASE WHEN event_id % 34 = 0 THEN 99 WHEN event_id % 17 = 0 THEN 1 + event_id % 3 ELSE 0 END AS INT) AS fail_count,
         ts AS published_at
  FROM events
),
mk AS (
  SELECT *, CASE WHEN json_valid(body) THEN TRY_CAST(json_extract_string(body, '$.k') AS BIGINT) END AS k
  FROM m
)"""

# hourly batches with a 54 min receive window: floor((t + 6 min) / 1 h)
HB = "(epoch_us(published_at) + 360000000) // 3600000000"
DB = "epoch_us(published_at) // 86400000000"

BATCHES = rf"""
c AS (SELECT {HB} AS batch_id, count(*) AS n FROM m GROUP BY 1),
ax AS (SELECT unnest(generate_series(min(batch_id), max(batch_id))) AS batch_id FROM c),
d AS (SELECT ax.batch_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM ax LEFT JOIN c USING (batch_id))"""

# topic patterns written out by hand as anchored regexes on the raw routing key
TOPIC_BINDINGS = r"""
tb(queue, pattern, rx) AS (VALUES
  ('all', '#', '^.*$'),
  ('clicks', 'events.click.*', '^events\.click\.[^.]*$'),
  ('clicks', '#.u1', '^([^.]*\.)*u1$'),
  ('u2', '#.u2', '^([^.]*\.)*u2$'),
  ('mid', '*.error.#', '^[^.]*\.error(\.[^.]*)*$'),
  ('none', 'events.*', '^events\.[^.]*$')
)"""

DEAD = r"""
p(queue, max_length, message_ttl_ms, max_length_bytes, dlx, dlrk) AS (VALUES
  ('click', 100, NULL, NULL, 'dlx', 'dead.click'),
  ('error', NULL, 86400000, NULL, 'dlx', NULL),
  ('view', NULL, NULL, 2000, NULL, NULL),
  ('signup', NULL, NULL, NULL, NULL, NULL),
  ('purchase', NULL, NULL, NULL, NULL, NULL)
),
e AS (
  SELECT m.*, p.max_length, p.max_length_bytes, p.dlx, p.dlrk,
         coalesce(epoch_us(m.published_at) + CAST(p.message_ttl_ms AS BIGINT) * 1000
                  <= (SELECT epoch_us(max(published_at)) FROM m), false) AS expired
  FROM m JOIN p USING (queue)
),
live AS (
  SELECT *, row_number() OVER (PARTITION BY queue ORDER BY published_at DESC, delivery_tag DESC) AS rn
  FROM e WHERE NOT expired
),
kept AS (SELECT * FROM live WHERE max_length IS NULL OR rn <= max_length),
kb AS (
  SELECT *, sum(coalesce(octet_length(encode(body)), 0)) OVER (
           PARTITION BY queue ORDER BY published_at DESC, delivery_tag DESC ROWS UNBOUNDED PRECEDING) AS cb
  FROM kept
),
dead AS (
  SELECT message_id, 'expired' AS reason, dlx, dlrk, routing_key FROM e WHERE expired
  UNION ALL
  SELECT message_id, 'maxlen', dlx, dlrk, routing_key FROM live WHERE max_length IS NOT NULL AND rn > max_length
  UNION ALL
  SELECT message_id, 'maxlen', dlx, dlrk, routing_key FROM kb WHERE max_length_bytes IS NOT NULL AND cb > max_length_bytes
)"""


def _hops(n: int) -> str:
    """The rounds of dead-lettering written out: what is in the queues, what leaves them, where it goes."""
    rounds = ["""
p(queue, max_length, ttl, dlx, dlrk) AS (VALUES
  ('click', 100, NULL, 'dlx', 'hop.one'), ('error', NULL, 86400000, 'dlx', NULL), ('first', 400, NULL, 'dlx', 'hop.two'),
  ('second', NULL, 604800000, 'dlx', 'hop.three'), ('third', 50, NULL, 'dlx', 'hop.one'), ('view', 1000, NULL, 'dlx', 'nowhere'),
  ('signup', NULL, NULL, NULL, NULL), ('purchase', 500, NULL, NULL, NULL)),
b(to_queue, rx) AS (VALUES ('first', '^hop[.]one$'), ('first', '^events[.]error([.].*)?$'), ('second', '^hop[.]two$'), ('third', '^hop[.]three$')),
now AS (SELECT epoch_us(max(published_at)) AS us FROM m),
in0 AS (SELECT message_id, queue, routing_key, epoch_us(published_at) AS us, queue AS path FROM m)"""]
    for h in range(n):
        rounds.append(f"""
x{h} AS (SELECT i.*, p.* EXCLUDE (queue), coalesce(i.us + CAST(ttl AS BIGINT) * 1000 <= (SELECT us FROM now), false) AS expired FROM in{h} i JOIN p USING (queue)),
y{h} AS (SELECT *, row_number() OVER (PARTITION BY queue, expired ORDER BY us DESC, message_id DESC, path DESC) AS rn FROM x{h}),
dead{h} AS (SELECT message_id, queue, path, dlx, coalesce(dlrk, routing_key) AS routing_key,
    CASE WHEN expired THEN us + CAST(ttl AS BIGINT) * 1000 ELSE us END AS us, CASE WHEN expired THEN 'expired' ELSE 'maxlen' END AS reason
  FROM y{h} WHERE expired OR rn > max_length),
out{h} AS (SELECT d.*, r.to_queue, coalesce(list_contains(string_split(path, '/'), r.to_queue), false) AS cycle
  FROM dead{h} d LEFT JOIN (SELECT DISTINCT k.routing_key, b.to_queue FROM (SELECT DISTINCT routing_key FROM dead{h}) k
    JOIN b ON regexp_matches(k.routing_key, b.rx)) r ON d.dlx IS NOT NULL AND r.routing_key = d.routing_key),
in{h + 1} AS (SELECT message_id, queue, routing_key, us, path FROM y{h} WHERE NOT expired AND (max_length IS NULL OR rn <= max_length)
  UNION ALL SELECT message_id, to_queue, routing_key, us, path || '/' || to_queue FROM out{h} WHERE to_queue IS NOT NULL AND NOT cycle)""")
    union = " UNION ALL ".join(f"SELECT message_id, CAST({h} AS INT) AS hop, queue, reason, to_queue, cycle FROM out{h}" for h in range(n))
    return _w(M, *rounds) + union


def _w(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ORACLE: dict[str, str] = {
    "decode_body": _w(M) + "SELECT message_id, body AS text FROM m",
    "envelope": _w(M) + "SELECT message_id, body, exchange, routing_key, delivery_tag FROM m",
    "header_lookup": _w(M) + "SELECT message_id, header_user FROM m",
    "handler_json": _w(M) + "SELECT message_id, k FROM mk",
    "handler_udf": _w(M) + "SELECT message_id, k FROM mk",
    "handler_split": _w(M)
    + """SELECT queue, CASE WHEN k IS NULL AND body IS NOT NULL THEN 'failed' ELSE 'ok' END AS outcome,
       count(*) AS n FROM mk GROUP BY ALL""",
    "multi_queue_union": _w(M)
    + "SELECT queue AS source, message_id FROM m WHERE queue IN ('click', 'error', 'view')",
    "topology_bindings": _w(
        M,
        r"""
s(key_index, queue, exchange, exchange_type, routing_keys) AS (VALUES
  (0, 'click', 'events', 'topic', 'events.click.*,#.u1'),
  (1, 'error', 'events', NULL, 'events.error.#'),
  (2, 'view', NULL, NULL, NULL),
  (3, 'ghost', 'events', 'topic', NULL)
),
b AS (
  SELECT queue, exchange, exchange_type, unnest(string_split(routing_keys, ',')) AS routing_key
  FROM s WHERE exchange IS NOT NULL AND exchange_type IS NOT NULL AND routing_keys IS NOT NULL
),
rx(pattern, rx) AS (VALUES ('events.click.*', '^events\.click\.[^.]*$'), ('#.u1', '^([^.]*\.)*u1$'))""",
    )
    + """SELECT b.queue, b.exchange, b.exchange_type, b.routing_key, count(m.message_id) AS n_matched
FROM b JOIN rx ON rx.pattern = b.routing_key
LEFT JOIN m ON m.exchange = b.exchange AND regexp_matches(m.routing_key, rx.rx)
GROUP BY ALL""",
    "route_direct": _w(M)
    + """SELECT DISTINCT b.queue AS bound_queue, m.message_id
FROM m JOIN (VALUES ('exact', 'events.view.u0'), ('exact', 'events.view.u1')) b(queue, key)
  ON m.exchange = 'events' AND m.routing_key = b.key""",
    "route_fanout": _w(M)
    + """SELECT b.queue AS bound_queue, m.message_id
FROM m JOIN (VALUES ('fan_a'), ('fan_b')) b(queue) ON m.exchange = 'events'""",
    "route_topic": _w(M, TOPIC_BINDINGS)
    + """SELECT DISTINCT tb.queue AS bound_queue, m.message_id
FROM m JOIN tb ON m.exchange = 'events' AND regexp_matches(m.routing_key, tb.rx)""",
    "route_unmatched": _w(M)
    + r"""SELECT message_id FROM m
WHERE NOT (regexp_matches(routing_key, '^events\.click\.[^.]*$')
        OR regexp_matches(routing_key, '^([^.]*\.)*u1$')
        OR regexp_matches(routing_key, '^([^.]*\.)*u2$'))""",
    "count_messages": _w(M)
    + """SELECT s.queue, count(m.message_id) AS n
FROM (VALUES ('click'), ('error'), ('view'), ('ghost')) s(queue) LEFT JOIN m ON m.queue = s.queue
GROUP BY s.queue""",
    "is_empty": _w(M)
    + """SELECT s.queue, count(m.message_id) = 0 AS empty
FROM (VALUES ('click'), ('error'), ('view'), ('ghost')) s(queue) LEFT JOIN m ON m.queue = s.queue
GROUP BY s.queue""",
    "count_approx": _w(M)
    + """SELECT queue,
       CAST(round(k / CAST(0.1 AS DOUBLE)) AS BIGINT) AS mean,
       CAST(round(k / CAST(0.1 AS DOUBLE) - 1.959963984540054 * sqrt(k * CAST(0.9 AS DOUBLE)) / CAST(0.1 AS DOUBLE)) AS BIGINT) AS low,
       CAST(round(k / CAST(0.1 AS DOUBLE) + 1.959963984540054 * sqrt(k * CAST(0.9 AS DOUBLE)) / CAST(0.1 AS DOUBLE)) AS BIGINT) AS high,
       CAST(0.95 AS DOUBLE) AS confidence
FROM (SELECT queue, count(*) AS k FROM m WHERE message_id % 10 = 0 GROUP BY queue)""",
    "take_messages": _w(M)
    + "SELECT queue, delivery_tag, message_id FROM m ORDER BY queue, delivery_tag LIMIT 25",
    "partition_counts": _w(M)
    + f"""SELECT {HB} AS batch_id, queue, CAST((delivery_tag - 1) % 2 AS INT) AS slot, count(*) AS n
FROM m GROUP BY ALL""",
    "batch_counts": _w(M, BATCHES)
    + "SELECT batch_id, n, lag(n) OVER (ORDER BY batch_id) AS reported_n FROM d",
    "running_total": _w(M, BATCHES)
    + "SELECT batch_id, n, CAST(sum(n) OVER (ORDER BY batch_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM d",
    "partition_plan": _w(
        M,
        """
s(key_index, queue, p, first_index) AS (VALUES (0, 'click', 2, 0), (1, 'error', 2, 2), (2, 'view', 2, 4), (3, 'ghost', 2, 6)),
pl AS (SELECT key_index, queue, p, first_index, unnest(range(p)) AS slot FROM s),
ld AS (SELECT m.queue, (m.delivery_tag - 1) % s.p AS slot, count(*) AS n FROM m JOIN s USING (queue) GROUP BY ALL)""",
    )
    + """SELECT CAST(pl.first_index + pl.slot AS INT) AS partition_index, pl.queue, CAST(pl.slot AS INT) AS slot,
       CAST(coalesce(ld.n, 0) AS BIGINT) AS n
FROM pl LEFT JOIN ld ON ld.queue = pl.queue AND ld.slot = pl.slot""",
    "balanced_slots": _w(M)
    + "SELECT queue, CAST((delivery_tag - 1) % 3 AS INT) AS slot, count(*) AS n FROM m GROUP BY ALL",
    "cap_per_partition": _w(M)
    + f"""SELECT batch_id, queue, slot, message_id FROM (
  SELECT {DB} AS batch_id, queue, CAST((delivery_tag - 1) % 2 AS INT) AS slot, message_id,
         row_number() OVER (PARTITION BY {DB}, queue, (delivery_tag - 1) % 2 ORDER BY delivery_tag) AS rn
  FROM mk WHERE NOT (k IS NULL AND body IS NOT NULL)
) WHERE rn <= 10""",
    "micro_batch_assign": _w(M) + f"SELECT message_id, {HB} AS batch_id FROM m",
    "tumbling_counts": _w(M)
    + "SELECT time_bucket(INTERVAL '1 hour', published_at) AS window_start, queue, count(*) AS n FROM m GROUP BY ALL",
    "rate_cap": _w(M, BATCHES)
    + """SELECT batch_id,
       CAST(CASE WHEN rate > 0 THEN least(rate, 10) ELSE 10 END AS BIGINT) AS cap_user,
       CAST(CASE WHEN rate > 0 THEN ceil(rate / 6) END AS BIGINT) AS cap_default
FROM (SELECT batch_id, CASE WHEN lag(batch_id) OVER w = batch_id - 1 THEN lag(n) OVER w ELSE 0 END AS rate
      FROM d WINDOW w AS (ORDER BY batch_id))""",
    "backlog": _w(M, BATCHES)
    + """SELECT batch_id, n, CAST(s - least(0, min(s) OVER (ORDER BY batch_id ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS backlog
FROM (SELECT batch_id, n, sum(n - 14) OVER (ORDER BY batch_id ROWS UNBOUNDED PRECEDING) AS s FROM d)""",
    "backlog_messages": "WITH RECURSIVE " + M.lstrip() + rf""",
a AS (SELECT queue, message_id, delivery_tag, {HB} AS batch_id FROM m),
r(queue, delivery_tag, message_id, batch_id, place) AS (
  SELECT queue, delivery_tag, message_id, batch_id, batch_id * 3 FROM a WHERE delivery_tag = 1
  UNION ALL
  SELECT a.queue, a.delivery_tag, a.message_id, a.batch_id, greatest(a.batch_id * 3, r.place + 1)
  FROM r JOIN a ON a.queue = r.queue AND a.delivery_tag = r.delivery_tag + 1)
SELECT queue, message_id, batch_id AS arrival_batch, CAST(place // 3 AS BIGINT) AS delivery_batch FROM r""",
    "remember_batches": _w(M, BATCHES)
    + "SELECT batch_id, n FROM d WHERE batch_id > (SELECT max(batch_id) FROM d) - 8",
    "ack_disposition": _w(M)
    + """SELECT a.ack_type,
       CASE WHEN a.ack_type = 'auto' THEN 'auto'
            WHEN a.ack_type = 'basic' AND o.ok THEN 'acked'
            WHEN a.ack_type = 'basic' THEN 'requeued'
            ELSE 'unacked' END AS disposition,
       count(*) AS n
FROM (SELECT NOT (k IS NULL AND body IS NOT NULL) AS ok FROM mk) o
CROSS JOIN (VALUES ('auto'), ('basic'), ('other')) a(ack_type)
GROUP BY ALL""",
    "redelivery": _w(M)
    + """SELECT message_id, CAST(attempt AS INT) AS attempt, attempt > 1 AS redelivered
FROM (SELECT message_id, unnest(generate_series(1, least(fail_count + 1, 5))) AS attempt FROM m)""",
    "dedupe_redelivered": _w(M)
    + """SELECT queue, delivery_tag, CAST(max(attempt) AS INT) AS attempt
FROM (SELECT queue, delivery_tag, unnest(generate_series(1, least(fail_count + 1, 5))) AS attempt FROM m)
GROUP BY ALL""",
    "ttl_expire": _w(M)
    + """SELECT queue, message_id FROM m
WHERE epoch_us(published_at) + CAST(86400000 AS BIGINT) * 1000 > (SELECT epoch_us(max(published_at)) FROM m)""",
    "max_length": _w(M)
    + """SELECT queue, message_id FROM (
  SELECT queue, message_id,
         row_number() OVER (PARTITION BY queue ORDER BY published_at DESC, delivery_tag DESC) AS rn FROM m
) WHERE rn <= 100""",
    "max_length_bytes": _w(M)
    + """SELECT queue, message_id FROM (
  SELECT queue, message_id,
         sum(coalesce(octet_length(encode(body)), 0)) OVER (
           PARTITION BY queue ORDER BY published_at DESC, delivery_tag DESC ROWS UNBOUNDED PRECEDING) AS cb
  FROM m
) WHERE cb <= 2000""",
    "dead_letter": _w(M, DEAD) + "SELECT message_id, reason, dlx AS exchange FROM dead WHERE dlx IS NOT NULL",
    "dead_letter_key": _w(M, DEAD)
    + "SELECT message_id, coalesce(dlrk, routing_key) AS routing_key FROM dead WHERE dlx IS NOT NULL",
    "dead_letter_routed": _w(M, DEAD)
    + """SELECT 'dead_all' AS bound_queue, message_id, reason FROM dead WHERE dlx IS NOT NULL
UNION ALL
SELECT 'dead_clicks', message_id, reason FROM dead WHERE dlx IS NOT NULL AND coalesce(dlrk, routing_key) = 'dead.click'""",
    "dead_letter_hops": _hops(6),
    "priority_order": _w(M)
    + f"""SELECT {DB} AS batch_id, queue,
       row_number() OVER (PARTITION BY {DB}, queue
                          ORDER BY least(coalesce(priority, 0), 5) DESC, delivery_tag) AS pos,
       message_id
FROM m""",
    "queue_leases": _w(M)
    + """SELECT queue, min(published_at) AS lease_start, count(*) AS n FROM (
  SELECT queue, published_at,
         sum(CASE WHEN prev IS NULL OR (queue IN ('click', 'error', 'view') AND epoch_us(published_at) - epoch_us(prev) >= 3600000000) THEN 1 ELSE 0 END)
           OVER (PARTITION BY queue ORDER BY published_at, message_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM (SELECT queue, message_id, published_at,
               lag(published_at) OVER (PARTITION BY queue ORDER BY published_at, message_id) AS prev FROM m)
) GROUP BY queue, sid""",
    "publish_messages": _w(M) + "SELECT queue, delivery_tag, message_id FROM m",
    "publish_routed": _w(M, TOPIC_BINDINGS)
    + """SELECT queue, row_number() OVER (PARTITION BY queue ORDER BY message_id) AS delivery_tag, message_id
FROM (SELECT DISTINCT tb.queue, m.message_id
      FROM m JOIN tb ON m.exchange = 'events' AND regexp_matches(m.routing_key, tb.rx))""",
    "batch_read_queue": _w(M)
    + "SELECT delivery_tag, message_id FROM m WHERE queue = 'click' AND delivery_tag BETWEEN 100 AND 199",
    "stream_single_queue": _w(M) + "SELECT queue, count(*) AS n FROM m WHERE queue = 'click' GROUP BY queue",
    "stream_multi_queue": _w(M)
    + "SELECT queue, count(*) AS n FROM m WHERE queue IN ('click', 'error', 'view') GROUP BY queue",
    "messagelog_batch_read": _w(M)
    + "SELECT delivery_tag, message_id FROM m WHERE queue = 'click' AND delivery_tag BETWEEN 100 AND 199",
    "messagelog_stream": _w(M)
    + "SELECT queue, count(*) AS n FROM m WHERE queue IN ('click', 'error', 'view') GROUP BY queue",
    "stream_leases": _w(M)
    + """SELECT queue, min(published_at) AS lease_start, count(*) AS n FROM (
  SELECT queue, published_at,
         sum(CASE WHEN prev IS NULL OR (queue IN ('click', 'error', 'view') AND epoch_us(published_at) - epoch_us(prev) >= 3600000000) THEN 1 ELSE 0 END)
           OVER (PARTITION BY queue ORDER BY published_at, message_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM (SELECT queue, message_id, published_at,
               lag(published_at) OVER (PARTITION BY queue ORDER BY published_at, message_id) AS prev FROM m)
) GROUP BY queue, sid""",
    "stream_redelivery": _w(M)
    + """SELECT message_id, CAST(least(fail_count + 1, 5) AS INT) AS attempt,
       CASE WHEN fail_count + 1 <= 5 THEN 'acked' ELSE 'dead' END AS outcome
FROM m""",
    "stream_capped": _w(
        M,
        """
s(source_index, queue, cap) AS (VALUES (0, 'click', 800), (1, 'error', 4000), (2, 'view', 1200), (3, 'click', 4000))""",
    )
    + """SELECT CAST(s.source_index AS INT) AS source_index, queue, CAST((delivery_tag - 1) % 2 AS INT) AS slot, message_id,
  CAST(((delivery_tag - 1) // 2) // cap AS BIGINT) AS batch_id
FROM (SELECT queue, message_id, CAST(row_number() OVER (
        PARTITION BY queue ORDER BY published_at >= TIMESTAMP '2024-01-16', message_id) AS BIGINT) AS delivery_tag FROM m)
JOIN s USING (queue)""",
    "stream_distinct": _w(M)
    + """SELECT queue, message_id, CAST(row_number() OVER (
  PARTITION BY queue ORDER BY published_at >= TIMESTAMP '2024-01-16', message_id) AS BIGINT) AS delivery_tag FROM m""",
    "stream_acks": _w(M)
    + """SELECT ack_type, queue, delivery_tag,
  CAST(CASE WHEN ack_type = 'basic' AND k IS NULL THEN 5 ELSE 1 END AS INT) AS attempt,
  CASE ack_type WHEN 'auto' THEN 'auto' WHEN 'other' THEN 'unacked' ELSE CASE WHEN k IS NULL THEN 'dead' ELSE 'acked' END END AS state
FROM (SELECT queue, k, CAST(row_number() OVER (
        PARTITION BY queue ORDER BY published_at >= TIMESTAMP '2024-01-16', message_id) AS BIGINT) AS delivery_tag FROM mk)
CROSS JOIN (VALUES ('auto'), ('basic'), ('other')) a(ack_type)""",
    "stream_handler": _w(M)
    + """SELECT message_id, 'ok' AS outcome,
       exchange || '|' || routing_key || '|' || delivery_tag || '|' || coalesce(header_user, '-') || '|' || body AS value
FROM m""",
}
ORACLE["stream_dedupe"] = ORACLE["dedupe_redelivered"]
