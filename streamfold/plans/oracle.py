"""DuckDB oracles: for each registered query, plain SQL over the driver's
tables (views ``events``, ``documents``, ...) that states the same result
independently of the Spark code."""

from __future__ import annotations

# Unicode white space at either end (RE2).
EDGE_SPACE = r"^[\t\n\x{0B}\f\r\x{85}\p{Z}]+|[\t\n\x{0B}\f\r\x{85}\p{Z}]+$"


def _trim(x: str) -> str:
    return "regexp_replace(" + x + ", '" + EDGE_SPACE + "', '', 'g')"


BLOCKS = """
be AS (
  SELECT CAST(user_id AS VARCHAR) AS key,
         CASE event_type
           WHEN 'click'  THEN concat_ws(':', 'block', CAST(user_id AS VARCHAR), CAST(event_id % 7 AS VARCHAR))
           WHEN 'error'  THEN concat_ws(':', 'unblock', CAST(user_id AS VARCHAR), CAST(event_id % 7 AS VARCHAR))
           WHEN 'signup' THEN concat_ws(':', 'mute', CAST(user_id AS VARCHAR), CAST(event_id % 7 AS VARCHAR))
           WHEN 'view' THEN concat_ws(':', 'view', CAST(user_id AS VARCHAR), CAST(event_id % 7 AS VARCHAR))
           WHEN 'purchase' THEN concat_ws(':', CAST(user_id AS VARCHAR), CAST(event_id % 7 AS VARCHAR))
         END AS value,
         event_id AS ev_offset, ts
  FROM events),
bp AS (SELECT *, string_split(value, ':') AS p FROM be),
valid AS (
  SELECT key AS user_id, p[1] AS action, p[3] AS blocked_id, ev_offset, ts
  FROM bp WHERE len(p) = 3 AND p[1] IN ('block', 'unblock')),
state AS (
  SELECT user_id, blocked_id, arg_max(action, ev_offset) AS last_action
  FROM valid GROUP BY user_id, blocked_id),
blocks AS (SELECT user_id, blocked_id FROM state WHERE last_action = 'block'),
block_list AS (
  SELECT user_id, blocked_id FROM blocks
  UNION ALL
  SELECT user_id, CAST(NULL AS VARCHAR) FROM state GROUP BY user_id
  HAVING max(CASE WHEN last_action = 'block' THEN 1 ELSE 0 END) = 0)"""

DICT = """
bw AS (
  SELECT unnest(regexp_extract_all(text, '\\p{L}+')) AS w FROM benchmark
  UNION ALL
  SELECT w FROM (VALUES (' The '), ('that'), ('ipsum'), ('der'), ('bad word')) AS t(w)),
dict AS (
  SELECT DISTINCT lower(""" + _trim("w") + """) AS word FROM bw),
dict2 AS (SELECT word, repeat('*', length(word)) AS mask FROM dict WHERE word <> '')"""

MSGS = """
msgs AS (
  SELECT doc_id AS id, CAST(doc_id % 7 AS VARCHAR) AS from_user_id,
         CAST(doc_id % 11 AS VARCHAR) AS to_user_id, text
  FROM documents)"""

CENSOR = "WITH " + BLOCKS + "," + DICT + "," + MSGS + """,
kept AS (
  SELECT * FROM msgs m
  WHERE NOT EXISTS (SELECT 1 FROM blocks b
                    WHERE b.user_id = m.to_user_id AND b.blocked_id = m.from_user_id)),
arr AS (SELECT id, regexp_extract_all(text, '(\\p{L}+|[^\\p{L}]+)') AS a FROM kept),
segs AS (SELECT id, unnest(a) AS seg, generate_subscripts(a, 1) AS pos FROM arr),
masked AS (
  SELECT s.id, string_agg(coalesce(d.mask, s.seg), '' ORDER BY s.pos) AS text
  FROM segs s LEFT JOIN dict2 d
    ON d.word = lower(s.seg) AND regexp_full_match(s.seg, '\\p{L}+')
  GROUP BY s.id)
SELECT k.id, k.from_user_id, k.to_user_id, coalesce(m.text, k.text) AS text
FROM kept k LEFT JOIN masked m ON m.id = k.id
"""

CENSOR_BLOCKED = "WITH " + BLOCKS + "," + MSGS + """
SELECT m.id, m.from_user_id, m.to_user_id FROM msgs m
WHERE EXISTS (SELECT 1 FROM blocks b WHERE b.user_id = m.to_user_id AND b.blocked_id = m.from_user_id)
"""

REPLAY = "WITH " + BLOCKS + """,
u AS (
  SELECT user_id AS to_u, blocked_id AS from_u, ts, ev_offset, action, CAST(NULL AS BIGINT) AS id
  FROM valid
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), CAST(event_id % 7 AS VARCHAR), ts, event_id,
         CAST(NULL AS VARCHAR), event_id
  FROM events WHERE event_type = 'view'),
s AS (
  SELECT *, last_value(action IGNORE NULLS) OVER (
      PARTITION BY to_u, from_u ORDER BY ts, ev_offset
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block_state
  FROM u)
SELECT id, from_u AS from_user_id, to_u AS to_user_id, ts, block_state
FROM s WHERE id IS NOT NULL AND (block_state IS NULL OR block_state <> 'block')
"""

BAD_WORD_DICTIONARY = "WITH " + DICT + "\nSELECT word, mask FROM dict2\n"

BAD_WORD_UNMATCHABLE = ("WITH " + DICT +
                        "\nSELECT word, mask FROM dict2 WHERE NOT regexp_full_match(word, '\\p{L}+')\n")

BAD_WORD_LOOKUP = "WITH " + DICT + """,
req AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\\p{L}+')) AS word FROM documents)
SELECT r.word, d.mask, d.mask IS NOT NULL AS found
FROM req r LEFT JOIN dict2 d ON d.word = lower(""" + _trim("r.word") + """)
"""

BLOCK_LIST = "WITH " + BLOCKS + "\nSELECT user_id, blocked_id FROM block_list\n"

BLOCK_EVENT_REJECTS = "WITH " + BLOCKS + """
SELECT key, value, ev_offset AS event_offset,
       CASE WHEN len(p) <> 3 THEN 'invalid format' ELSE 'unknown action' END AS reason
FROM bp WHERE NOT (len(p) = 3 AND p[1] IN ('block', 'unblock'))
"""

BLOCK_PAIR_STATE = "WITH " + BLOCKS + """
SELECT user_id, blocked_id, arg_max(action, ev_offset) AS last_action, max(ev_offset) AS event_offset
FROM valid GROUP BY user_id, blocked_id
"""

BLOCK_CHANGES = "WITH " + BLOCKS + """,
c AS (SELECT *, lag(action, 1, 'unblock') OVER (PARTITION BY user_id, blocked_id ORDER BY ev_offset) AS before FROM valid)
SELECT user_id, blocked_id, ev_offset AS event_offset, CASE action WHEN 'block' THEN 'added' ELSE 'removed' END AS change
FROM c WHERE action <> before
"""

USER_BLOCK_LOOKUP = "WITH " + BLOCKS + """,
req AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer)
SELECT r.user_id, b.blocked_id, CASE WHEN b.user_id IS NULL THEN 'not_found' ELSE 'found' END AS status
FROM req r LEFT JOIN block_list b ON b.user_id = r.user_id
"""


def _uint(x: str) -> str:
    return (f"CASE WHEN regexp_full_match({x}, '[0-9]+') "
            f"AND TRY_CAST({x} AS DECIMAL(38,0)) <= 18446744073709551615 "
            f"THEN CAST(CAST({x} AS DECIMAL(38,0)) AS VARCHAR) END")


INGEST_MESSAGES = """
WITH r AS (
  SELECT conv_id, turn,
         CASE WHEN role = 'system' THEN '-' || CAST(conv_id AS VARCHAR) ELSE CAST(conv_id AS VARCHAR) END AS from_uid,
         CASE WHEN turn % 5 = 0 THEN role ELSE CAST(turn AS VARCHAR) END AS to_uid,
         text
  FROM conversations),
p AS (
  SELECT conv_id, turn, """ + _uint("from_uid") + """ AS from_user_id,
         """ + _uint("to_uid") + """ AS to_user_id, """ + _trim("text") + """ AS t
  FROM r),
q AS (
  SELECT *, CASE WHEN from_user_id IS NULL THEN 'from_uid is not int'
                 WHEN to_user_id IS NULL THEN 'to_uid is not int'
                 WHEN coalesce(t, '') = '' THEN 'text is empty' END AS reason
  FROM p)
SELECT conv_id, turn, from_user_id, to_user_id, CASE WHEN reason IS NULL THEN t END AS text,
       reason, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status
FROM q
"""

INGEST_BLOCK_REQUESTS = """
WITH r AS (
  SELECT event_id AS request_id,
         CASE event_type WHEN 'click' THEN 'block' WHEN 'error' THEN 'unblock'
                         WHEN 'purchase' THEN 'block' WHEN 'signup' THEN 'mute'
                         WHEN 'view' THEN 'unblock' END AS action,
         CAST(user_id AS VARCHAR) AS user_id, CAST(event_id % 7 AS VARCHAR) AS block_uid
  FROM events),
q AS (
  SELECT *, CASE WHEN coalesce(action, '') NOT IN ('block', 'unblock') THEN 'Action must be: block or unblock'
                 WHEN coalesce(user_id, '') = coalesce(block_uid, '') THEN 'userID is equal blockUID' END AS reason
  FROM r)
SELECT request_id, action, user_id, block_uid, reason,
       CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN reason IS NULL THEN user_id END AS emit_key,
       CASE WHEN reason IS NULL THEN action || ':' || coalesce(user_id, '') || ':' || coalesce(block_uid, '') END AS event
FROM q
"""

INGEST_BAD_WORDS = """
WITH a AS (SELECT item_id, string_split_regex(text, '[.,]') AS parts FROM benchmark),
r AS (SELECT item_id, unnest(parts) AS word, generate_subscripts(parts, 1) - 1 AS pos FROM a),
c AS (SELECT *, """ + _trim("word") + """ AS clean_word FROM r)
SELECT item_id, CAST(pos AS INTEGER) AS pos, word, clean_word,
       CASE WHEN clean_word = '' THEN 'Bad word is empty' END AS reason,
       CASE WHEN clean_word = '' THEN 'rejected' ELSE 'accepted' END AS status,
       CASE WHEN clean_word <> '' THEN 'bad-word' END AS emit_key
FROM c
"""

JSON_ROUND_TRIP = """
SELECT CAST(user_id AS VARCHAR) AS record_key, CAST(user_id % 3 AS INTEGER) AS topic_partition,
       event_id AS record_offset, event_id, ts, user_id, event_type, value, props,
       false AS is_corrupt
FROM events
"""

RECORD_REJECTS = """
SELECT CAST(user_id % 3 AS INTEGER) AS topic_partition, event_id AS record_offset,
       CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'no json'
            WHEN event_id % 83 = 0 THEN '{"event_id":"seven","user_id":1}' ELSE 'null' END AS value,
       CASE WHEN event_id % 97 = 0 THEN 'no value' ELSE 'not of the declared type' END AS reason
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 OR event_id % 79 = 0
"""

CSV_ROUND_TRIP = """
SELECT o_orderkey, o_orderdate, o_orderpriority, o_totalprice, false AS is_corrupt FROM orders
"""

ORDER_RECORDS = """
WITH v AS (SELECT CAST(o_custkey AS VARCHAR) AS u, '{"user_id":' || o_custkey || ',"order_id":' || o_orderkey
           || ',"order_amount":' || CAST(floor(o_totalprice) AS BIGINT) || '}' AS value FROM orders)
SELECT u AS key, value, 'keyed' AS topic FROM v UNION ALL SELECT NULL, value, 'plain' FROM v
"""

RECORD_HEADERS = """
SELECT CAST(user_id % 3 AS INTEGER) AS topic_partition, event_id AS record_offset,
       CASE WHEN event_type <> 'purchase' THEN event_type END AS header_type,
       CASE WHEN event_type <> 'purchase' THEN CAST(user_id AS VARCHAR) END AS header_user,
       CAST(NULL AS VARCHAR) AS header_trace,
       CAST(CASE WHEN event_type <> 'purchase' THEN 2 ELSE 0 END AS INTEGER) AS n_headers
FROM events
"""

SQUARE_VALUES = "SELECT event_id, event_id AS n, event_id * event_id AS squared FROM events\n"

# The reference upper-cases rune by rune: a character without a one-rune
# upper form (here the sharp s) stays as it is.
UPPER_TEXT = """
SELECT conv_id, turn,
       replace(upper(replace(text, 'ß', chr(983040))), chr(983040), 'ß') AS upper_text
FROM conversations
"""

def _quoted(x: str) -> str:
    """A double-quoted literal's escaping, in SQL: backslash, quote, named
    escapes, then ``\\xNN`` for the other control characters."""
    named = {7: "a", 8: "b", 9: "t", 10: "n", 11: "v", 12: "f", 13: "r"}
    out = f"replace(replace({x}, '\\', '\\\\'), '\"', '\\\"')"
    for cp in [*range(0x20), 0x7F]:
        esc = "\\" + named[cp] if cp in named else "\\x%02x" % cp
        out = f"replace({out}, chr({cp}), '{esc}')"
    return out


FORMAT_MESSAGES = """
WITH m AS (SELECT event_id AS id, event_type AS payload, epoch_us(ts) * 1000 AS ts FROM events)
SELECT id, payload, ts,
       printf('Message{ID:%d, Payload:"%s", Ts:%d}', id, """ + _quoted("payload") + """, ts) AS text,
       make_timestamp(ts // 1000) AS sent_at
FROM m
"""

GENERATE_MESSAGES = """
SELECT event_id AS id, 'Hello from producer' AS payload, epoch_us(ts) * 1000 AS ts FROM events
"""

FAN_OUT_TOPICS = """
SELECT event_id AS id, event_type AS payload, epoch_us(ts) * 1000 AS ts, t.topic
FROM events CROSS JOIN (VALUES ('topic-1'), ('topic-2')) AS t(topic)
"""

ORDERS = """
o AS (SELECT o_custkey AS user_id, o_orderkey AS order_id,
             CAST(floor(o_totalprice) AS BIGINT) AS order_amount FROM orders),
rt AS (SELECT *, CAST(sum(order_amount) OVER (
          PARTITION BY user_id ORDER BY order_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM o),
cat AS (SELECT *, CASE WHEN total >= 1000000 THEN 'gold' WHEN total >= 500000 THEN 'silver'
                       ELSE 'bronze' END AS category FROM rt),
chg AS (SELECT *, lag(category) OVER (PARTITION BY user_id ORDER BY order_id) AS prev FROM cat)"""

SPEND_RUNNING_TOTAL = "WITH " + ORDERS + "\nSELECT user_id, order_id, order_amount, total FROM rt\n"

SPEND_TOTAL = """
SELECT o_custkey AS user_id, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS total
FROM orders GROUP BY o_custkey
"""

SPEND_CATEGORY_CHANGES = ("WITH " + ORDERS + "\nSELECT user_id, order_id, total, category FROM chg"
                          "\nWHERE prev IS NULL OR prev <> category\n")

SPEND_CATEGORY_LATEST = "WITH " + ORDERS + """,
e AS (SELECT * FROM chg WHERE prev IS NULL OR prev <> category)
SELECT user_id, arg_max(category, order_id) AS category, arg_max(total, order_id) AS total
FROM e GROUP BY user_id
"""

BATCH_GROUPS = """
WITH r AS (
  SELECT CAST(user_id % 3 AS INTEGER) AS topic_partition, event_id AS off,
         row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) AS rn
  FROM events)
SELECT topic_partition, CAST((rn - 1) // 10 AS BIGINT) AS batch_no, count(*) AS n_records,
       min(off) AS first_offset, max(off) AS last_offset
FROM r GROUP BY 1, 2
"""

ORDER_CUSTOMER_JOIN = """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey
"""

ORDER_ORPHANS = """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
"""

ORDER_ORPHANS_AFTER_DELETES = """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 5 <> 0)
"""

CDC = """
c AS (
  SELECT CASE WHEN (event_id % 500) % 2 = 0 THEN 'users' ELSE 'orders' END AS "table",
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         event_id AS lsn, event_id % 500 AS key_id, CAST(event_id % 500 AS INTEGER) AS id,
         value, (event_id * 7919) % 500000 + 1000 AS delay_us
  FROM events)"""

CDC_DECODE = "WITH " + CDC + '\nSELECT "table", op, lsn, key_id, id, value FROM c\n'

CDC_OP_COUNTS = "WITH " + CDC + """
SELECT "table", op, count(*) AS n_changes,
       CASE op WHEN 'c' THEN 'insert' WHEN 'u' THEN 'update' WHEN 'd' THEN 'delete'
               WHEN 'r' THEN 'snapshot' END AS op_name
FROM c GROUP BY 1, 2
"""

CDC_REJECTS = """
SELECT 'pg.public.' || CASE WHEN event_id % 500 % 2 = 0 THEN 'users' ELSE 'orders' END AS topic,
       CAST(event_id % 500 % 3 AS INTEGER) AS "partition", event_id AS "offset",
       CASE WHEN event_id % 97 <> 0 THEN 'no json' END AS value,
       CASE WHEN event_id % 97 = 0 THEN 'tombstone' ELSE 'not a change record' END AS reason
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0
"""

CDC_ACCEPTED_STATE = "WITH " + CDC + """,
l AS (SELECT "table", key_id, arg_max(op, lsn) AS op, max(lsn) AS lsn,
             arg_max(id, lsn) AS id, arg_max(value, lsn) AS value
      FROM c WHERE lsn % 97 <> 0 AND lsn % 89 <> 0 GROUP BY 1, 2)
SELECT "table", key_id, lsn, id, value FROM l WHERE op <> 'd'
"""

DELIVERY_COUNTS = """
SELECT CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'rejected' ELSE 'good' END AS output, count(*) AS n_records
FROM events GROUP BY 1
"""

CDC_CURRENT_STATE = "WITH " + CDC + """,
l AS (SELECT "table", key_id, arg_max(op, lsn) AS op, max(lsn) AS lsn,
             arg_max(id, lsn) AS id, arg_max(value, lsn) AS value
      FROM c GROUP BY 1, 2)
SELECT "table", key_id, lsn, id, value FROM l WHERE op <> 'd'
"""

CDC_DELAY_QUANTILES = "WITH " + CDC + """
SELECT "table", count(*) AS n_changes, p.probability, true AS within_error
FROM c CROSS JOIN (VALUES (CAST(0.5 AS DOUBLE)), (0.95), (0.99)) AS p(probability) GROUP BY "table", p.probability
"""

CDC_DISCOVERED_SCHEMA = """
WITH n("table", n_images) AS (
  SELECT 'users', count(*) + count(*) FILTER (c_custkey % 3 = 0) + count(*) FILTER (c_custkey % 5 = 0) FROM customer
  UNION ALL SELECT 'orders', count(*) + count(*) FILTER (o_orderkey % 4 = 0) FROM orders
  UNION ALL SELECT 'products', count(*) FROM part),
cols("table", "column", type) AS (VALUES
  ('users', 'created_at', 'BIGINT'), ('users', 'email', 'STRING'), ('users', 'id', 'BIGINT'), ('users', 'name', 'STRING'),
  ('orders', 'id', 'BIGINT'), ('orders', 'user_id', 'BIGINT'), ('orders', 'product_name', 'STRING'),
  ('orders', 'quantity', 'BIGINT'), ('orders', 'order_date', 'BIGINT'), ('products', 'id', 'BIGINT'), ('products', 'name', 'STRING'))
SELECT "table", "column", type, n_images FROM cols JOIN n USING ("table")
"""

CDC_USERS = """
WITH ops(op, n, every) AS (VALUES ('c', 1, 1), ('u', 2, 3), ('d', 3, 5))
SELECT 'users' AS "table", op, c_custkey * 4 + n AS lsn, c_custkey AS key_id, CAST(c_custkey AS INTEGER) AS id,
       c_name AS name,
       'user' || c_custkey || CASE op WHEN 'c' THEN '@example.com' ELSE '@example.org' END AS email,
       TIMESTAMP '2024-01-01' + to_seconds(c_custkey) AS created_at
FROM customer JOIN ops ON c_custkey % every = 0
"""

CDC_ORDERS = """
WITH ops(op, n, every) AS (VALUES ('c', 1, 1), ('u', 2, 4))
SELECT 'orders' AS "table", op, o_orderkey * 4 + n AS lsn, o_orderkey AS key_id, CAST(o_orderkey AS INTEGER) AS id,
       CAST(o_custkey AS INTEGER) AS user_id, o_orderpriority AS product_name,
       CAST(o_orderkey % 10 + n AS INTEGER) AS quantity, o_orderdate AS order_date
FROM orders JOIN ops ON o_orderkey % every = 0
"""

CDC_SNAPSHOT_STATE = """
SELECT 'users' AS "table", c_custkey AS key_id, CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 4 + 2 ELSE 0 END AS lsn,
       CAST(c_custkey AS INTEGER) AS id, c_name AS name,
       'user' || c_custkey || CASE WHEN c_custkey % 3 = 0 THEN '@example.org' ELSE '@example.com' END AS email,
       TIMESTAMP '2024-01-01' + to_seconds(c_custkey) AS created_at
FROM customer WHERE c_custkey % 5 <> 0
"""

CDC_DELAY = "WITH " + CDC + """
SELECT "table", count(*) AS n_changes, avg(delay_us) AS avg_delay_us,
       max(delay_us) AS max_delay_us
FROM c GROUP BY 1
"""

# Names, labels and panels as the reference's rules and dashboard give them,
# written out: none of them comes from the code under test.
SAMPLES = """
k AS (
  SELECT event_id AS sample_id, ts, event_id % 13 AS kind, user_id % 3 AS c, user_id % 2 AS t,
         CASE WHEN event_id % 13 IN (2, 3, 9, 10) THEN CAST(event_id // 13 % 40 * 10 + user_id % 3 AS DOUBLE) ELSE value END AS value
  FROM events),
r AS (
  SELECT sample_id, ts, value,
         CASE kind
           WHEN 0 THEN 'kafka_connect_worker_connector_count'
           WHEN 1 THEN 'kafka_connect_worker_task_count'
           WHEN 2 THEN 'kafka_connect_worker_connector_startup_attempts_total'
           WHEN 3 THEN 'kafka_connect_worker_connector_startup_success_total'
           WHEN 4 THEN 'kafka_connect_connector_connector_' || c || '_status'
           WHEN 5 THEN 'kafka_connect_task_connector_' || c || '_' || t || '_batch_size_avg'
           WHEN 6 THEN 'kafka_connect_sink_task_connector_' || c || '_' || t || '_sink_record_send_rate'
           WHEN 7 THEN 'kafka_connect_source_task_connector_' || c || '_' || t || '_source_record_poll_rate'
           WHEN 8 THEN 'kafka_connect_source_task_connector_' || c || '_' || t || '_source_record_write_rate'
           WHEN 9 THEN 'kafka_connect_source_task_connector_' || c || '_' || t || '_source_record_poll_total'
           WHEN 10 THEN 'kafka_connect_source_task_connector_' || c || '_' || t || '_source_record_write_total'
           WHEN 11 THEN 'kafka_consumer_fetch_manager_records_lag'
         END AS name,
         CASE WHEN kind BETWEEN 4 AND 10 THEN 'connector-' || c END AS connector,
         CASE WHEN kind BETWEEN 5 AND 10 THEN CAST(t AS VARCHAR) END AS task,
         CASE WHEN kind = 11 THEN 'client-' || t END AS client_id,
         CASE kind WHEN 0 THEN 'worker_connector_count' WHEN 1 THEN 'worker_task_count'
                   WHEN 2 THEN 'connector_startup_attempts' WHEN 3 THEN 'connector_startup_success'
                   WHEN 7 THEN 'source_record_poll_rate' WHEN 8 THEN 'source_record_write_rate'
                   WHEN 9 THEN 'source_record_poll_total' WHEN 10 THEN 'source_record_write_total' END AS panel,
         make_timestamp(epoch_us(ts) // 5000000 * 5000000) AS window_start
  FROM k WHERE kind < 12)"""

METRIC_RENAME = "WITH " + SAMPLES + "\nSELECT sample_id, name, connector, task, client_id, ts, value FROM r\n"

METRIC_MAX_LATEST = "WITH " + SAMPLES + """,
latest AS (SELECT panel, name, connector, task, arg_max(value, ts) AS value FROM r
           WHERE panel IS NOT NULL AND panel NOT IN ('source_record_poll_rate', 'source_record_write_rate')
           GROUP BY panel, name, connector, task),
panels(panel) AS (VALUES ('worker_connector_count'), ('worker_task_count'), ('source_record_poll_total'),
                         ('source_record_write_total'), ('connector_startup_attempts'), ('connector_startup_success'))
SELECT panel, max(value) AS value, count(name) AS n_series FROM panels LEFT JOIN latest USING (panel) GROUP BY panel
"""

METRIC_SCRAPE = "WITH " + SAMPLES + """
SELECT name, connector, task, client_id, window_start, arg_max(value, ts) AS value, count(*) AS n_samples
FROM r GROUP BY name, connector, task, client_id, window_start
"""

METRIC_GAUGE = "WITH " + SAMPLES + """
SELECT panel, name, connector, task, client_id, window_start, arg_max(value, ts) AS value
FROM r WHERE panel IN ('source_record_poll_rate', 'source_record_write_rate') GROUP BY panel, name, connector, task, client_id, window_start
"""

METRIC_RATE = "WITH " + SAMPLES + """
SELECT panel, window_start, count(*) AS n_records, count(*) / CAST(5 AS DOUBLE) AS per_second
FROM r WHERE panel IN ('source_record_poll_rate', 'source_record_write_rate') GROUP BY panel, window_start
"""

METRIC_CUMULATIVE = "WITH " + SAMPLES + """,
d AS (SELECT *, lag(value) OVER (PARTITION BY panel, name, connector, task ORDER BY ts, sample_id) AS prev
      FROM r WHERE panel IN ('source_record_poll_total', 'source_record_write_total')),
steps AS (
  SELECT panel, name, connector, task, client_id, window_start,
         sum(CASE WHEN prev IS NULL THEN 0 WHEN value >= prev THEN value - prev ELSE value END) AS increase
  FROM d GROUP BY panel, name, connector, task, client_id, window_start)
SELECT *, sum(increase) OVER (PARTITION BY panel, name, connector, task ORDER BY window_start
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative
FROM steps
"""

# SQL of stream queries that have no batch query of their own.
STREAM_SQL = {"delivery_counts": DELIVERY_COUNTS}

ORACLE_SQL: dict[str, str] = {
    "censor_messages": CENSOR,
    "censor_messages_large_dictionary": CENSOR,
    "censor_blocked": CENSOR_BLOCKED,
    "censor_replay_asof": REPLAY,
    "bad_word_dictionary": BAD_WORD_DICTIONARY,
    "bad_word_unmatchable": BAD_WORD_UNMATCHABLE,
    "bad_word_lookup": BAD_WORD_LOOKUP,
    "block_list": BLOCK_LIST,
    "block_event_rejects": BLOCK_EVENT_REJECTS,
    "block_pair_state": BLOCK_PAIR_STATE,
    "block_changes": BLOCK_CHANGES,
    "user_block_lookup": USER_BLOCK_LOOKUP,
    "ingest_messages": INGEST_MESSAGES,
    "ingest_block_requests": INGEST_BLOCK_REQUESTS,
    "ingest_bad_words": INGEST_BAD_WORDS,
    "json_round_trip": JSON_ROUND_TRIP,
    "record_rejects": RECORD_REJECTS,
    "csv_round_trip": CSV_ROUND_TRIP,
    "order_records": ORDER_RECORDS,
    "record_headers": RECORD_HEADERS,
    "square_values": SQUARE_VALUES,
    "upper_text": UPPER_TEXT,
    "format_messages": FORMAT_MESSAGES,
    "generate_messages": GENERATE_MESSAGES,
    "fan_out_topics": FAN_OUT_TOPICS,
    "spend_running_total": SPEND_RUNNING_TOTAL,
    "spend_total": SPEND_TOTAL,
    "spend_category_changes": SPEND_CATEGORY_CHANGES,
    "spend_category_latest": SPEND_CATEGORY_LATEST,
    "batch_groups": BATCH_GROUPS,
    "order_customer_join": ORDER_CUSTOMER_JOIN,
    "order_orphans": ORDER_ORPHANS,
    "order_orphans_after_deletes": ORDER_ORPHANS_AFTER_DELETES,
    "cdc_decode": CDC_DECODE,
    "cdc_op_counts": CDC_OP_COUNTS,
    "cdc_rejects": CDC_REJECTS,
    "cdc_accepted_state": CDC_ACCEPTED_STATE,
    "cdc_current_state": CDC_CURRENT_STATE,
    "cdc_delay": CDC_DELAY,
    "cdc_delay_quantiles": CDC_DELAY_QUANTILES,
    "cdc_discovered_schema": CDC_DISCOVERED_SCHEMA,
    "cdc_users": CDC_USERS,
    "cdc_orders": CDC_ORDERS,
    "cdc_snapshot_state": CDC_SNAPSHOT_STATE,
    "metric_rename": METRIC_RENAME,
    "metric_max_latest": METRIC_MAX_LATEST,
    "metric_scrape": METRIC_SCRAPE,
    "metric_gauge": METRIC_GAUGE,
    "metric_rate": METRIC_RATE,
    "metric_cumulative": METRIC_CUMULATIVE,
}
