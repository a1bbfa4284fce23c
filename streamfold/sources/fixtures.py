"""Deterministic mappings from the driver's tables to the shapes the
operators consume (keyed events, messages, orders, change envelopes,
metric samples).  Every mapping is a projection of a scanned table, so its
size grows with the table and nothing passes through the driver.

``event_id`` / ``o_orderkey`` play the part of the log offset.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codecs import encode_json
from ..functions.ids import topic_name
from ..functions.text import LETTER_RUN
from ..functions.timefmt import epoch_micros, utc_instant, utc_wall_clock
from .tables import read_table

# --- fixed values -----------------------------------------------------------
# Extra dictionary entries besides the letter runs of `benchmark`.
FIXED_BAD_WORDS = (" The ", "that", "ipsum", "der", "bad word")
# Block-event action per event type (`mute` and `view` are unknown actions);
# `purchase` events carry a two-part (malformed) value.
BLOCK_ACTION_BY_TYPE = {"click": "block", "error": "unblock", "signup": "mute", "view": "view"}
# Change-feed mapping.
CDC_PREFIX = "pg"
CDC_SCHEMA = "public"
CDC_KEY_SPACE = 500
USERS_FROM_US = 1_704_067_200_000_000      # 2024-01-01
CDC_OP_BY_TYPE = {"signup": "c", "error": "d"}      # everything else: "u"
# Metric samples: bean ({c}: connector, {t}: task, {k}: client) and attribute
# by event_id modulo their number; the last is no rule's.
METRICS = (
    ("kafka.connect<type=connect-worker-metrics>", "connector-count"),
    ("kafka.connect<type=connect-worker-metrics>", "task-count"),
    ("kafka.connect<type=connect-worker-metrics>", "connector-startup-attempts-total"),
    ("kafka.connect<type=connect-worker-metrics>", "connector-startup-success-total"),
    ("kafka.connect<type=connector-metrics, connector={c}>", "status"),
    ("kafka.connect<type=connector-task-metrics, connector={c}, task={t}>", "batch-size-avg"),
    ("kafka.connect<type=sink-task-metrics, connector={c}, task={t}>", "sink-record-send-rate"),
    ("kafka.connect<type=source-task-metrics, connector={c}, task={t}>", "source-record-poll-rate"),
    ("kafka.connect<type=source-task-metrics, connector={c}, task={t}>", "source-record-write-rate"),
    ("kafka.connect<type=source-task-metrics, connector={c}, task={t}>", "source-record-poll-total"),
    ("kafka.connect<type=source-task-metrics, connector={c}, task={t}>", "source-record-write-total"),
    ("kafka.consumer<type=consumer-fetch-manager-metrics, client-id={k}>", "records-lag"),
    ("java.lang<type=Memory>", "HeapMemoryUsage"),
)
COUNTER_STEPS = 40              # samples of a kind until its counters start anew
# ---------------------------------------------------------------------------


def _case(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as chat messages: id, from_user_id, to_user_id, text.
    User ids are canonical decimal strings (Q11)."""
    return user_messages_from(read_table(spark, sf_dir, "documents", "doc_id", "text", parallel=True))


def user_messages_from(d: DataFrame) -> DataFrame:
    return d.select(F.col("doc_id").alias("id"),
                    (F.col("doc_id") % 7).cast("string").alias("from_user_id"),
                    (F.col("doc_id") % 11).cast("string").alias("to_user_id"),
                    "text")


def block_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the block-event topic: key, value, offset, ts."""
    return block_events_from(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id",
                                        "event_type"))


def block_events_from(e: DataFrame) -> DataFrame:
    u = F.col("user_id").cast("string")
    b = (F.col("event_id") % 7).cast("string")
    value = _case(F.col("event_type"),
                  {**{t: F.concat_ws(":", F.lit(a), u, b) for t, a in BLOCK_ACTION_BY_TYPE.items()},
                   "purchase": F.concat_ws(":", u, b)})
    return e.select(u.alias("key"), value.alias("value"), F.col("event_id").alias("offset"), "ts")


def timed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``view`` events as messages with a send time, for the as-of replay."""
    return timed_messages_from(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type"))


def timed_messages_from(e: DataFrame) -> DataFrame:
    return (e.filter(F.col("event_type") == "view")
             .select(F.col("event_id").alias("id"),
                     (F.col("event_id") % 7).cast("string").alias("from_user_id"),
                     F.col("user_id").cast("string").alias("to_user_id"),
                     "ts", F.col("event_id").alias("offset")))


def bad_word_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw dictionary additions: the letter runs of ``benchmark.text`` plus a
    small fixed list.  Columns: word, offset (item_id, position)."""
    runs = letter_runs_from(read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return runs.unionByName(fixed_bad_words(spark))


def letter_runs_from(b: DataFrame) -> DataFrame:
    return b.select("item_id", F.posexplode(F.regexp_extract_all("text", F.lit(LETTER_RUN), 0))
                    .alias("pos", "word"))


def fixed_bad_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(-1, i, w) for i, w in enumerate(FIXED_BAD_WORDS)],
                                 "item_id bigint, pos int, word string")


def bad_word_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw request strings for ING-01: comma/period-separated pieces of
    ``benchmark.text`` (some are blank)."""
    b = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return b.select("item_id", F.posexplode(F.split("text", "[.,]")).alias("pos", "word"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as order events: user_id, order_id, order_amount, offset."""
    return order_events_from(read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey",
                                        "o_totalprice"))


def order_events_from(o: DataFrame) -> DataFrame:
    return o.select(F.col("o_custkey").alias("user_id"),
                    F.col("o_orderkey").alias("order_id"),
                    F.floor("o_totalprice").cast("bigint").alias("order_amount"),
                    F.col("o_orderkey").alias("offset"))


def block_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw block requests for ING-02: action, user_id, block_uid (strings)."""
    e = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    action = _case(F.col("event_type"), {"click": "block", "error": "unblock",
                                         "purchase": "block", "signup": "mute",
                                         "view": "unblock"})
    return e.select(F.col("event_id").alias("request_id"), action.alias("action"),
                    F.col("user_id").cast("string").alias("user_id"),
                    (F.col("event_id") % 7).cast("string").alias("block_uid"))


def message_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw message requests for ING-03: from_uid, to_uid, text (strings).
    Every fifth turn carries the role name as its receiver, and system turns
    carry a negative sender, so some requests are malformed."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    to_uid = F.when(F.col("turn") % 5 == 0, F.col("role")).otherwise(F.col("turn").cast("string"))
    from_uid = F.when(F.col("role") == "system", F.concat(F.lit("-"), F.col("conv_id").cast("string"))) \
                .otherwise(F.col("conv_id").cast("string"))
    return c.select("conv_id", "turn", from_uid.alias("from_uid"), to_uid.alias("to_uid"), "text")


def kafka_records(spark: SparkSession, sf_dir: str, topic: str = "events") -> DataFrame:
    """``events`` in the Kafka source's record layout; the event type and
    the sender travel as headers, purchases have none."""
    return kafka_records_from(read_table(spark, sf_dir, "events", parallel=True), topic)


def kafka_records_from(e: DataFrame, topic: str = "events") -> DataFrame:
    value = encode_json(*e.columns)
    return e.select(F.col("user_id").cast("string").cast("binary").alias("key"),
                    value.cast("binary").alias("value"),
                    F.lit(topic).alias("topic"),
                    (F.col("user_id") % 3).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"),
                    utc_instant("ts").alias("timestamp"),
                    F.lit(0).alias("timestampType"),
                    F.when(F.col("event_type") != "purchase", F.array(
                        _header("type", F.col("event_type")), _header("user", F.col("user_id").cast("string"))))
                    .alias("headers"))


def _header(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))


def cdc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as change records on the topics ``pg.public.users`` and
    ``pg.public.orders``: key JSON ``{"id":k}`` and a change envelope value."""
    return cdc_records_from(read_table(spark, sf_dir, "events", "event_id", "ts", "event_type",
                                       "value", parallel=True))


def cdc_records_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cdc_records`` in which some values are gone (tombstones) or no JSON."""
    return spoiled(cdc_records(spark, sf_dir))


def spoiled(records: DataFrame) -> DataFrame:
    """``records`` in which some values are gone (tombstones) or no JSON."""
    value = (F.when(F.col("offset") % 97 == 0, F.lit(None))
             .when(F.col("offset") % 89 == 0, F.lit("no json").cast("binary")).otherwise(F.col("value")))
    return records.withColumn("value", value)


def mistyped(records: DataFrame) -> DataFrame:
    """``spoiled`` records of which some more hold a field of the wrong type
    or ``null`` instead of an object."""
    value = (F.when(F.col("offset") % 83 == 0, F.lit('{"event_id":"seven","user_id":1}').cast("binary"))
             .when(F.col("offset") % 79 == 0, F.lit("null").cast("binary")).otherwise(F.col("value")))
    return spoiled(records.withColumn("value", value))


def cdc_records_from(e: DataFrame) -> DataFrame:
    k = (F.col("event_id") % CDC_KEY_SPACE).cast("int")
    return _change_records(
        e, table=F.when(k % 2 == 0, F.lit("users")).otherwise(F.lit("orders")), key=k,
        op=_case(F.col("event_type"), CDC_OP_BY_TYPE, "u"),
        image=F.struct(k.alias("id"), F.col("value").alias("value")), lsn=F.col("event_id"),
        src_us=epoch_micros("ts"), delay_us=(F.col("event_id") * 7919) % 500000 + 1000)


def _change_records(df: DataFrame, table: Column, key: Column, op: Column, image: Column, lsn: Column,
                    src_us: Column, delay_us: Column) -> DataFrame:
    """Change records of rows: key JSON, envelope, topic, partition, offset."""
    source = F.struct(
        F.lit("postgresql").alias("connector"), F.lit("customers").alias("db"),
        lsn.alias("lsn"), F.lit(CDC_PREFIX).alias("name"),
        F.lit(CDC_SCHEMA).alias("schema"),
        F.format_string('[null,"%d"]', lsn).alias("sequence"),
        F.lit("false").alias("snapshot"), table.alias("table"),
        F.floor(src_us / 1000).cast("bigint").alias("ts_ms"),
        (src_us * 1000).alias("ts_ns"), src_us.alias("ts_us"),
        (lsn + 700).alias("txId"), F.lit("3.0.0.Final").alias("version"),
        F.lit(None).cast("bigint").alias("xmin"))
    env_us = src_us + delay_us
    envelope = F.struct(
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        source.alias("source"), F.lit(None).cast("string").alias("transaction"),
        op.alias("op"), F.floor(env_us / 1000).cast("bigint").alias("ts_ms"),
        env_us.alias("ts_us"), (env_us * 1000).alias("ts_ns"))
    return df.select(
        F.to_json(F.struct(key.alias("id"))).cast("binary").alias("key"),
        F.to_json(envelope, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        topic_name(CDC_PREFIX, CDC_SCHEMA, table).alias("topic"),
        (key % 3).cast("int").alias("partition"), lsn.alias("offset"))


def _with_ops(df: DataFrame, key: str, update_every: int, delete_every: int | None = None) -> DataFrame:
    """A row per change of each row (``op``; ``lsn`` rises per key): all are
    created, some updated, some deleted at last."""
    k = F.col(key)
    ops = [F.lit("c"), F.when(k % update_every == 0, F.lit("u"))]
    if delete_every:
        ops.append(F.when(k % delete_every == 0, F.lit("d")))
    return (df.select("*", F.posexplode(F.array(*ops)).alias("_sf_n", "op")).filter(F.col("op").isNotNull())
            .withColumn("lsn", k * 4 + F.col("_sf_n") + 1))


def users_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the rows of ``users``: table, key_id, id, name, email,
    created_at (one second of 2024 per customer)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    return c.select(F.lit("users").alias("table"), F.col("c_custkey").alias("key_id"), *[
        x.alias(n) for n, x in _user(F.lit("example.com")).items() if n != "created_us"],
        utc_wall_clock(F.timestamp_micros(_user(F.lit(""))["created_us"])).alias("created_at"))


def _user(domain: Column) -> dict[str, Column]:
    return {"id": F.col("c_custkey").cast("int"), "name": F.col("c_name"),
            "email": F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@"), domain),
            "created_us": F.lit(USERS_FROM_US) + F.col("c_custkey") * 1_000_000}


def user_change_records(customers: DataFrame) -> DataFrame:
    """Change records of ``users`` with full row images."""
    c = _with_ops(customers.select("c_custkey", "c_name"), "c_custkey", 3, 5)
    u = _user(F.when(F.col("op") == "c", F.lit("example.com")).otherwise(F.lit("example.org")))
    return _change_records(
        c, F.lit("users"), F.col("c_custkey"), F.col("op"),
        F.struct(u["created_us"].alias("created_at"), u["email"].alias("email"), u["id"].alias("id"),
                 u["name"].alias("name")), F.col("lsn"), u["created_us"], F.lit(1000).cast("bigint"))


def row_change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records with full row images: ``customer`` as ``users``,
    ``orders`` as ``orders``, and ``part`` as ``products``, a table that
    consumers leave out (FLT-05)."""
    delay = F.lit(1000).cast("bigint")
    users = user_change_records(read_table(spark, sf_dir, "customer", "c_custkey", "c_name"))
    o = _with_ops(read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
                  "o_orderkey", 4)
    date_us = epoch_micros("o_orderdate")
    orders = _change_records(
        o, F.lit("orders"), F.col("o_orderkey"), F.col("op"),
        F.struct(F.col("o_orderkey").cast("int").alias("id"), F.col("o_custkey").cast("int").alias("user_id"),
                 F.col("o_orderpriority").alias("product_name"),
                 (F.col("o_orderkey") % 10 + F.when(F.col("op") == "u", 2).otherwise(1)).cast("int").alias("quantity"),
                 date_us.alias("order_date")), F.col("lsn"), date_us, delay)
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
    products = _change_records(
        p, F.lit("products"), F.col("p_partkey"), F.lit("c"),
        F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), F.col("p_partkey"),
        F.lit(USERS_FROM_US), delay)
    return users.unionByName(orders).unionByName(products)


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as JMX metric samples: sample_id, metric, ts, value.  Totals
    are counters that rise and at times start anew; other values are the
    events'."""
    return metric_samples_from(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value"))


def metric_samples_from(e: DataFrame) -> DataFrame:
    values = {"{c}": F.concat(F.lit("connector-"), (F.col("user_id") % 3).cast("string")),
              "{t}": (F.col("user_id") % 2).cast("string"),
              "{k}": F.concat(F.lit("client-"), (F.col("user_id") % 2).cast("string"))}
    kind, metric, counter = F.col("event_id") % len(METRICS), None, F.lit(False)
    for i, (bean, attribute) in enumerate(METRICS):
        name = F.concat(*[values.get(x, F.lit(x)) for x in re.split(r"({\w})", bean + attribute)])
        metric = F.when(kind == i, name) if metric is None else metric.when(kind == i, name)
        if attribute.endswith("-total"):
            counter = counter | (kind == i)
    step = F.floor(F.col("event_id") / len(METRICS)) % COUNTER_STEPS
    return e.select(F.col("event_id").alias("sample_id"), metric.alias("metric"), utc_instant("ts").alias("ts"),
                    F.when(counter, (step * 10 + F.col("user_id") % 3).cast("double")).otherwise(F.col("value")).alias("value"))
