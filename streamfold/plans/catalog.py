"""Registered batch queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the whole of the tables it reads.

Output rules (so results compare across engines): flat columns of plain
types, every computed column aliased, no random ids or current times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codecs import CODECS, CORRUPT, decode_json, record_reason, split_rejects, string_codec
from ..functions.text import LETTER_RUN
from ..functions.timefmt import utc_wall_clock
from ..operators import (batching, blocklist, cdc, censor, dictionary, ingest, joins,
                         metrics, projections, spend)
from ..sources import fixtures, kafka
from ..sources.tables import read_table

# --- fixed values -----------------------------------------------------------
BATCH_SIZE = 10                       # records per consumer batch (AGG-07)
FAN_OUT_TOPICS = ("topic-1", "topic-2")
CDC_TABLES = ("public.users", "public.orders")
CDC_FIELDS = {"id": "int", "value": "double"}
USER_FIELDS = {"id": "int", "name": "string", "email": "string", "created_at": "timestamp_micros"}
ORDER_FIELDS = {"id": "int", "user_id": "int", "product_name": "string", "quantity": "int",
                "order_date": "timestamp_micros"}
PAYLOAD = "Hello from producer"
EVENT_SCHEMA_DDL = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                    "value DOUBLE, props STRING")
# ---------------------------------------------------------------------------


# ---- shared building blocks ------------------------------------------------

def parsed_block_events(spark, sf_dir):
    return blocklist.parse_block_events(fixtures.block_events(spark, sf_dir), extra=("ts",))


def current_blocks(spark, sf_dir):
    good, _ = parsed_block_events(spark, sf_dir)
    return blocklist.current_blocks(good)


def bad_words(spark, sf_dir):
    return dictionary.bad_word_dictionary(fixtures.bad_word_events(spark, sf_dir))


# ---- moderation ---------------------------------------------------------------

def q_censor_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-01, JOIN-02, FLT-04, FN-04..07, FN-11 ."""
    return censor.censor_messages(fixtures.user_messages(spark, sf_dir),
                                  current_blocks(spark, sf_dir), bad_words(spark, sf_dir))


def q_censor_messages_large_dictionary(spark, sf_dir):
    """JOIN-03: the way of a dictionary that is too long for a set."""
    return censor.censor_messages(fixtures.user_messages(spark, sf_dir), current_blocks(spark, sf_dir),
                                  bad_words(spark, sf_dir), set_words=0)


def q_censor_blocked(spark, sf_dir):
    """Q1 rejects: messages dropped by the block check."""
    return censor.blocked_messages(fixtures.user_messages(spark, sf_dir),
                                   current_blocks(spark, sf_dir)).drop("text")


def q_censor_replay_asof(spark, sf_dir):
    """JOIN-04: block state at the time of each message."""
    good, _ = parsed_block_events(spark, sf_dir)
    return censor.replay_blocks_asof(fixtures.timed_messages(spark, sf_dir), good)


def q_bad_word_dictionary(spark, sf_dir):
    """FN-03, FN-04, FLT-01, AGG-03."""
    return bad_words(spark, sf_dir)


def q_bad_word_unmatchable(spark, sf_dir):
    """Q4: listed words that can never match."""
    return dictionary.unmatchable_words(bad_words(spark, sf_dir))


def q_bad_word_lookup(spark, sf_dir):
    """JOIN-05, FN-05: every distinct letter run of the documents looked up."""
    d = read_table(spark, sf_dir, "documents", "text", parallel=True)
    req = d.select(F.explode(F.regexp_extract_all("text", F.lit(LETTER_RUN), 0)).alias("word")) \
           .distinct()
    return dictionary.lookup_words(req, bad_words(spark, sf_dir))


def q_block_list(spark, sf_dir):
    """FN-08, FLT-02, FLT-03, AGG-04."""
    good, _ = parsed_block_events(spark, sf_dir)
    return blocklist.block_list(good)


def q_block_event_rejects(spark, sf_dir):
    """FN-08, COD-05, COD-06: malformed and unknown-action events."""
    _, bad = parsed_block_events(spark, sf_dir)
    return bad.select("key", "value", F.col("offset").alias("event_offset"), "reason")


def q_block_pair_state(spark, sf_dir):
    """AGG-04: the last action per pair, with the offset it came at."""
    good, _ = parsed_block_events(spark, sf_dir)
    return blocklist.block_pair_state(good).withColumnRenamed("offset", "event_offset")


def q_block_changes(spark, sf_dir):
    """AGG-04: the events that alter a user's set of blocked ids."""
    good, _ = parsed_block_events(spark, sf_dir)
    return blocklist.set_changes(good).withColumnRenamed("offset", "event_offset")


def q_user_block_lookup(spark, sf_dir):
    """JOIN-06: every customer's block list."""
    good, _ = parsed_block_events(spark, sf_dir)
    req = read_table(spark, sf_dir, "customer", "c_custkey") \
        .select(F.col("c_custkey").cast("string").alias("user_id"))
    return blocklist.lookup_user_blocks(req, blocklist.block_list(good))


# ---- ingestion ------------------------------------------------------------------

def q_ingest_messages(spark, sf_dir):
    """ING-03, FN-12 (the derived id is left out of the output)."""
    return ingest.validate_messages(fixtures.message_requests(spark, sf_dir))


def q_ingest_block_requests(spark, sf_dir):
    """ING-02, FN-09."""
    return ingest.validate_block_requests(fixtures.block_requests(spark, sf_dir))


def q_ingest_bad_words(spark, sf_dir):
    """ING-01."""
    return ingest.validate_bad_words(fixtures.bad_word_requests(spark, sf_dir))


# ---- codecs and projections ----------------------------------------------------

def q_json_round_trip(spark, sf_dir):
    """COD-01..04, SNK-01/02: encode events as keyed records, decode back."""
    dec = kafka.decode_value(fixtures.kafka_records(spark, sf_dir), EVENT_SCHEMA_DDL, ("key", "partition", "offset"))
    return (dec.withColumnsRenamed({"partition": "topic_partition", "offset": "record_offset"})
            .withColumn("record_key", string_codec("key")).drop("key")
            .withColumn("is_corrupt", F.col(CORRUPT).isNotNull()).drop(CORRUPT))


def q_record_rejects(spark, sf_dir):
    """COD-05, COD-06: event records without a value, without JSON, or with
    a field of another type than declared."""
    rec = fixtures.mistyped(fixtures.kafka_records(spark, sf_dir))
    d = rec.select(F.col("partition").alias("topic_partition"), F.col("offset").alias("record_offset"),
                   string_codec("value").alias("value"), decode_json("value", EVENT_SCHEMA_DDL).alias("v"))
    return split_rejects(d, record_reason("value", "v"), ["topic_partition", "record_offset", "value"])[1]


def q_csv_round_trip(spark, sf_dir):
    """UDF-04: orders through the codec of comma separated values."""
    encode, decode = CODECS["csv"]
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    lines = o.select(encode(*o.columns).alias("line"))
    got = lines.select(decode("line", "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING, o_totalprice DOUBLE").alias("v"))
    return got.select("v.*").withColumn("is_corrupt", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def q_order_records(spark, sf_dir):
    """SNK-01, SNK-02, COD-02: orders as sink records, once keyed by user and
    once without a key."""
    o, cols = fixtures.order_events(spark, sf_dir), ["user_id", "order_id", "order_amount"]
    keyed, plain = projections.to_records(o, "user_id", cols), projections.to_records(o, None, cols)
    return keyed.withColumn("topic", F.lit("keyed")).unionByName(plain.withColumn("topic", F.lit("plain")))


def q_record_headers(spark, sf_dir):
    """SRC-06: partition, offset and headers of every record."""
    return header_rows(fixtures.kafka_records(spark, sf_dir))


def header_rows(records: DataFrame) -> DataFrame:
    got = projections.header_values(records, ["type", "user", "trace"])
    return got.select(F.col("partition").alias("topic_partition"), F.col("offset").alias("record_offset"),
                      "header_type", "header_user", "header_trace",
                      F.coalesce(F.size("headers"), F.lit(0)).alias("n_headers"))


def q_square_values(spark, sf_dir):
    """FN-01 after COD-04 (integers travel as text)."""
    e = read_table(spark, sf_dir, "events", "event_id")
    recs = e.select("event_id", F.col("event_id").cast("string").cast("binary").alias("value"))
    return projections.square_encoded(recs).select("event_id", "n", "squared")


def q_upper_text(spark, sf_dir):
    """FN-02."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return projections.upper_text(c, "text").select("conv_id", "turn", "upper_text")


def q_format_messages(spark, sf_dir):
    """FN-14, FN-15."""
    e = read_table(spark, sf_dir, "events", "event_id", "event_type", "ts")
    return projections.format_messages(
        projections.payload_messages_from(e, "event_id", "event_type", "ts"))


def q_generate_messages(spark, sf_dir):
    """SRC-13 shape: one payload message per event, constant payload."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts")
    return projections.payload_messages_from(
        e.withColumn("payload", F.lit(PAYLOAD)), "event_id", "payload", "ts")


def q_fan_out_topics(spark, sf_dir):
    """SNK-05, FN-16: each message to two topics."""
    e = read_table(spark, sf_dir, "events", "event_id", "event_type", "ts")
    msgs = projections.payload_messages_from(e, "event_id", "event_type", "ts")
    return projections.fan_out(msgs, list(FAN_OUT_TOPICS))


# ---- spend ------------------------------------------------------------------------

def q_spend_running_total(spark, sf_dir):
    """AGG-01."""
    rt = spend.running_totals(fixtures.order_events(spark, sf_dir))
    return rt.select("user_id", "order_id", "order_amount", "total")


def q_spend_total(spark, sf_dir):
    """AGG-02."""
    return spend.spend_totals(fixtures.order_events(spark, sf_dir))


def q_spend_category_changes(spark, sf_dir):
    """AGG-05, FN-10."""
    return spend.category_changes(fixtures.order_events(spark, sf_dir)) \
                .select("user_id", "order_id", "total", "category")


def q_spend_category_latest(spark, sf_dir):
    """AGG-06."""
    return spend.latest_category(spend.category_changes(fixtures.order_events(spark, sf_dir)))


# ---- consumer batching -----------------------------------------------------------

def q_batch_groups(spark, sf_dir):
    """AGG-07, AGG-08, SRC-03: batches of 10 per topic partition."""
    recs = fixtures.kafka_records(spark, sf_dir)
    return batching.batch_groups(recs, BATCH_SIZE) \
                   .withColumnRenamed("partition", "topic_partition")


# ---- joins ------------------------------------------------------------------------

def q_order_customer_join(spark, sf_dir):
    """JOIN-07."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    return joins.orders_with_customers(o, c).select(
        "o_orderkey", "o_custkey", "c_name", "c_mktsegment", "o_totalprice")


def q_order_orphans(spark, sf_dir):
    """JOIN-07 integrity check (anti join)."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer", "c_custkey")
    return joins.orphan_orders(o, c)


def q_order_orphans_after_deletes(spark, sf_dir):
    """JOIN-07 over CDC-06: orders whose customer the change feed deleted."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    users = q_cdc_snapshot_state(spark, sf_dir).select(F.col("key_id").alias("c_custkey"))
    return joins.orphan_orders(o, users)


# ---- change data capture ---------------------------------------------------------

def decoded_changes(spark, sf_dir):
    return cdc.decode_changes(fixtures.cdc_records(spark, sf_dir), include=list(CDC_TABLES))


def q_cdc_decode(spark, sf_dir):
    """CDC-01..04, SRC-10, FLT-05."""
    d = decoded_changes(spark, sf_dir)
    t = cdc.typed_projection(d, CDC_FIELDS)
    return t.select("table", "op", "lsn", "key_id", "id", "value")


def q_cdc_op_counts(spark, sf_dir):
    """CDC-05."""
    return cdc.op_counts(decoded_changes(spark, sf_dir))


def q_cdc_rejects(spark, sf_dir):
    """COD-05: tombstones and garbage among the change records."""
    return cdc.change_rejects(fixtures.cdc_records_with_rejects(spark, sf_dir), list(CDC_TABLES))


def q_cdc_accepted_state(spark, sf_dir):
    """COD-05, CDC-06: the table state from what is left without the rejects."""
    good, _ = cdc.split_changes(fixtures.cdc_records_with_rejects(spark, sf_dir), list(CDC_TABLES))
    return cdc.current_state(good, CDC_FIELDS)


def q_cdc_current_state(spark, sf_dir):
    """CDC-06."""
    return cdc.current_state(decoded_changes(spark, sf_dir), CDC_FIELDS)


def row_changes(spark, sf_dir, table, fields):
    changes = cdc.decode_changes(fixtures.row_change_records(spark, sf_dir), include=[f"public.{table}"])
    return cdc.typed_projection(changes, fields)


def q_cdc_users(spark, sf_dir):
    """CDC-02, CDC-03, FLT-05: every change of a user, full row image."""
    return row_changes(spark, sf_dir, "users", USER_FIELDS)


def q_cdc_orders(spark, sf_dir):
    """CDC-02, CDC-03, FLT-05: every change of an order, full row image."""
    return row_changes(spark, sf_dir, "orders", ORDER_FIELDS)


def q_cdc_snapshot_state(spark, sf_dir):
    """SRC-11, CDC-06: the snapshot of the users, then the updates and
    deletes captured after it."""
    after = row_changes(spark, sf_dir, "users", USER_FIELDS).filter("op <> 'c'")
    both = cdc.with_snapshot(fixtures.users_snapshot(spark, sf_dir), after)
    return cdc.latest_state(both, list(USER_FIELDS))


def q_cdc_delay(spark, sf_dir):
    """CDC-07 (exact count, mean, max)."""
    return cdc.capture_delay(decoded_changes(spark, sf_dir))


def q_cdc_delay_quantiles(spark, sf_dir):
    """CDC-07: quantiles from sketches per table and day, merged, and held
    against the exact ranks."""
    d = decoded_changes(spark, sf_dir)
    return cdc.quantile_ranks(d, cdc.merged_quantiles(cdc.delay_sketches(d)))


def q_cdc_discovered_schema(spark, sf_dir):
    """CDC-01: columns and types of the tables, found from their images."""
    return cdc.discovered_columns(cdc.decode_changes(fixtures.row_change_records(spark, sf_dir)))


# ---- metrics ---------------------------------------------------------------------

def renamed_metrics(spark, sf_dir):
    return metrics.rename_metrics(fixtures.metric_samples(spark, sf_dir))


def q_metric_rename(spark, sf_dir):
    """MET-01, MET-02."""
    r = renamed_metrics(spark, sf_dir)
    return r.select("sample_id", "name", *metrics.LABELS,
                    utc_wall_clock("ts").alias("ts"), "value")


def q_metric_max_latest(spark, sf_dir):
    """MET-03 over latest samples."""
    return metrics.max_of_latest(renamed_metrics(spark, sf_dir))


def q_metric_scrape(spark, sf_dir):
    """MET-06: one sample per series per 5 s."""
    return metrics.scrape(renamed_metrics(spark, sf_dir))


def rate_tagged(spark, sf_dir):
    return metrics.rename_metrics(fixtures.metric_samples(spark, sf_dir),
                                  panels=metrics.RATE_PANELS)


def q_metric_gauge(spark, sf_dir):
    """MET-04: value of the rate gauges per series and step."""
    return metrics.gauge_steps(rate_tagged(spark, sf_dir))


def q_metric_rate(spark, sf_dir):
    """MET-04."""
    return metrics.record_rate(rate_tagged(spark, sf_dir))


def q_metric_cumulative(spark, sf_dir):
    """MET-05: running totals of the poll and write counters."""
    return metrics.cumulative(metrics.rename_metrics(fixtures.metric_samples(spark, sf_dir), panels=metrics.TOTAL_PANELS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "censor_messages": q_censor_messages,
    "censor_messages_large_dictionary": q_censor_messages_large_dictionary,
    "censor_blocked": q_censor_blocked,
    "censor_replay_asof": q_censor_replay_asof,
    "bad_word_dictionary": q_bad_word_dictionary,
    "bad_word_unmatchable": q_bad_word_unmatchable,
    "bad_word_lookup": q_bad_word_lookup,
    "block_list": q_block_list,
    "block_event_rejects": q_block_event_rejects,
    "block_pair_state": q_block_pair_state,
    "block_changes": q_block_changes,
    "user_block_lookup": q_user_block_lookup,
    "ingest_messages": q_ingest_messages,
    "ingest_block_requests": q_ingest_block_requests,
    "ingest_bad_words": q_ingest_bad_words,
    "json_round_trip": q_json_round_trip,
    "record_rejects": q_record_rejects,
    "csv_round_trip": q_csv_round_trip,
    "order_records": q_order_records,
    "record_headers": q_record_headers,
    "square_values": q_square_values,
    "upper_text": q_upper_text,
    "format_messages": q_format_messages,
    "generate_messages": q_generate_messages,
    "fan_out_topics": q_fan_out_topics,
    "spend_running_total": q_spend_running_total,
    "spend_total": q_spend_total,
    "spend_category_changes": q_spend_category_changes,
    "spend_category_latest": q_spend_category_latest,
    "batch_groups": q_batch_groups,
    "order_customer_join": q_order_customer_join,
    "order_orphans": q_order_orphans,
    "order_orphans_after_deletes": q_order_orphans_after_deletes,
    "cdc_decode": q_cdc_decode,
    "cdc_op_counts": q_cdc_op_counts,
    "cdc_rejects": q_cdc_rejects,
    "cdc_accepted_state": q_cdc_accepted_state,
    "cdc_current_state": q_cdc_current_state,
    "cdc_delay": q_cdc_delay,
    "cdc_delay_quantiles": q_cdc_delay_quantiles,
    "cdc_discovered_schema": q_cdc_discovered_schema,
    "cdc_users": q_cdc_users,
    "cdc_orders": q_cdc_orders,
    "cdc_snapshot_state": q_cdc_snapshot_state,
    "metric_rename": q_metric_rename,
    "metric_max_latest": q_metric_max_latest,
    "metric_scrape": q_metric_scrape,
    "metric_gauge": q_metric_gauge,
    "metric_rate": q_metric_rate,
    "metric_cumulative": q_metric_cumulative,
}
