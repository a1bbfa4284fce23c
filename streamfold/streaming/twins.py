"""Streaming twins of the batch queries.

Each twin runs real Structured Streaming queries (file-stream sources,
checkpoints, state stores, ``foreachBatch``) over the driver's tables with
``availableNow`` and returns a DataFrame over what they wrote, so it can
be compared with its batch twin.  Output and checkpoints go to a fresh
folder under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_word
from ..functions import codecs
from ..functions.codecs import decode_json
from ..functions.timefmt import utc_instant, utc_wall_clock
from ..operators import batching, blocklist, cdc, censor, dictionary, metrics
from ..plans.catalog import EVENT_SCHEMA_DDL, USER_FIELDS, header_rows
from ..session import scratch_path
from ..sources import fixtures
from ..sources.kafka import read_record_stream
from . import outputs, processors
from .sinks import batch_writer, read_batches, run_to_end
from .sources import table_stream
from .state import keep_changelog, latest_stream, read_changes, read_latest, read_state, replayed_changes
from .stateful import SPEND_OUTPUT, spend_category_batches, spend_category_stream

CDC_TABLES = ("public.users", "public.orders")
CDC_FIELDS = {"id": "int", "value": "double"}
CDC_STATE = "table string, key_id bigint, lsn bigint, op string, id int, value double"
PAIR_STATE = "user_id string, blocked_id string, offset bigint, last_action string"
DELIVERED = "id bigint, from_user_id string, to_user_id string, text string"


# ---- table-building streams (STR-03, SNK-06, SNK-07) --------------------------

def build_block_state(spark: SparkSession, events: DataFrame, checkpoint: str) -> None:
    """Fold streamed block events into the pair table: the last action per
    pair, kept in Spark's state at ``checkpoint``."""
    good, _ = blocklist.parse_block_events(fixtures.block_events_from(events))
    pairs = latest_stream(good.withColumnRenamed("action", "last_action"), ["user_id", "blocked_id"], "offset",
                          ["last_action"])
    run_to_end(pairs, checkpoint, output_mode="update")


def current_blocks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The current block pairs, as of the last committed micro-batch."""
    return (read_latest(spark, checkpoint, PAIR_STATE).filter(F.col("last_action") == "block")
            .select("user_id", "blocked_id"))


def build_dictionary(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Deduplicate streamed word events with ``dropDuplicates`` (state
    store); returns the path of the word table."""
    runs = fixtures.letter_runs_from(table_stream(spark, sf_dir, "benchmark"))
    words = (runs.select(normalize_word("word").alias("word")).filter(F.col("word") != "")
             .dropDuplicates(["word"]))
    path = f"{root}/words"
    run_to_end(words, f"{root}/ckpt_words", path=path)
    return path


def dictionary_table(spark: SparkSession, path: str) -> DataFrame:
    streamed = spark.read.schema("word string").parquet(path)
    extra = fixtures.fixed_bad_words(spark).select("word")
    return dictionary.bad_word_dictionary(streamed.unionByName(extra))


# ---- registered twins ------------------------------------------------------------

def q_stream_block_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01, STR-03, SNK-06, SNK-07, AGG-04: twin of ``block_list``."""
    ckpt = scratch_path(spark, "stream_block_list")
    build_block_state(spark, table_stream(spark, sf_dir, "events"), ckpt)
    return blocklist.block_list_from_state(read_latest(spark, ckpt, PAIR_STATE))


def q_stream_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-03, AGG-03: twin of ``bad_word_dictionary``."""
    root = scratch_path(spark, "stream_dictionary")
    return dictionary_table(spark, build_dictionary(spark, sf_dir, root))


def censor_batches(blocks: Callable[[], DataFrame], words: Callable[[], DataFrame],
                   write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """STR-05: a batch function that censors each micro-batch by the tables
    as they are when it starts."""
    def each(batch: DataFrame, batch_id: int) -> None:
        write(censor.censor_messages(batch, blocks(), words()), batch_id)
    return each


def q_stream_censor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-02, STR-04, STR-05, SNK-04, SNK-10: twin of ``censor_messages``.

    The table queries are drained first (STR-04).  The message query then
    reads both tables anew in every micro-batch, so table changes made
    while it runs are seen by later batches (STR-05)."""
    root = scratch_path(spark, "stream_censor")
    ckpt, out = f"{root}/ckpt_blocks", f"{root}/delivered"
    build_block_state(spark, table_stream(spark, sf_dir, "events"), ckpt)
    words = build_dictionary(spark, sf_dir, root)
    each = censor_batches(lambda: current_blocks(spark, ckpt), lambda: dictionary_table(spark, words), batch_writer(out))
    msgs = fixtures.user_messages_from(table_stream(spark, sf_dir, "documents"))
    run_to_end(msgs, f"{root}/ckpt_messages", foreach_batch=each)
    return read_batches(spark, out, DELIVERED)


def q_stream_spend_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-02, STR-03, SNK-11: twin of ``spend_category_changes`` with one
    state row per user and batch and all work in DataFrames."""
    root = scratch_path(spark, "stream_spend_category")
    orders = fixtures.order_events_from(table_stream(spark, sf_dir, "orders"))
    out = f"{root}/categories"
    run_to_end(orders, f"{root}/ckpt",
               foreach_batch=spend_category_batches(spark, f"{root}/state", out))
    return read_batches(spark, out, SPEND_OUTPUT).select("user_id", "order_id", "total", "category")


def q_stream_spend_category_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-02, STR-03, UDF-02, SNK-11: the same with ``transformWithState``
    (RocksDB state store, per-record output)."""
    root = scratch_path(spark, "stream_spend_category_state")
    orders = fixtures.order_events_from(table_stream(spark, sf_dir, "orders"))
    path = f"{root}/categories"
    run_to_end(spend_category_stream(orders), f"{root}/ckpt", path=path)
    return spark.read.parquet(path).select("user_id", "order_id", "total", "category")


def q_stream_cdc_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-06, SNK-07: twin of ``cdc_current_state``; the state keeps a
    deleted key's last change, readers drop it."""
    ckpt = scratch_path(spark, "stream_cdc_state")
    rec = fixtures.cdc_records_from(table_stream(spark, sf_dir, "events"))
    typed = cdc.typed_projection(cdc.decode_changes(rec, include=list(CDC_TABLES)), CDC_FIELDS)
    run_to_end(latest_stream(typed, ["table", "key_id"], "lsn", ["op", *CDC_FIELDS]), ckpt, output_mode="update")
    st = read_latest(spark, ckpt, CDC_STATE)
    return st.filter(F.col("op") != "d").select("table", "key_id", "lsn", *CDC_FIELDS)


def q_stream_metric_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MET-04: twin of ``metric_rate``; the counts are Spark's state.  No
    watermark, so that a late sample counts like any other; the state holds
    one row per panel and five seconds, however many samples there are."""
    ckpt = scratch_path(spark, "stream_metric_rate")
    samples = _rename_stream(fixtures.metric_samples_from(table_stream(spark, sf_dir, "events")))
    sel = metrics.tag_panels(samples, metrics.RATE_PANELS)
    iv = metrics.SCRAPE_INTERVAL_SECONDS
    step = sel.select("panel", F.window("ts", f"{iv} seconds")["start"].alias("step"))
    run_to_end(step.groupBy("panel", "step").agg(F.count("*").alias("n_records")), ckpt, output_mode="update")
    counts = read_state(spark, ckpt)
    if counts is None:
        return spark.createDataFrame([], "panel string, window_start timestamp_ntz, n_records bigint, per_second double")
    return counts.select("key.panel", utc_wall_clock(F.col("key.step")).alias("window_start"),
                         F.col("value.count").alias("n_records"),
                         (F.col("value.count") / F.lit(float(iv))).alias("per_second"))


SCRAPE_DELAY_SECONDS = 600
SCRAPE_ROW = ("name string, connector string, task string, client_id string, slot bigint, us bigint, sample_id bigint, "
              "value double, n_samples bigint")


def scraped(spark: SparkSession, samples: DataFrame, root: str, delay_s: int = SCRAPE_DELAY_SECONDS) -> dict[str, DataFrame]:
    """Stream samples to final windows and late samples; with the windows
    that are open still, from the state."""
    rows = _rename_stream(samples).filter(F.col("name").isNotNull())
    out = processors.scrape_windows(rows, metrics.SCRAPE_INTERVAL_SECONDS, delay_s)
    run_to_end(out, f"{root}/ckpt", foreach_batch=outputs.outputs_writer(f"{root}/out"))
    parts = {o: outputs.read_output(spark, f"{root}/out", o, SCRAPE_ROW) for o in (processors.WINDOW, processors.LATE)}
    return {**parts, "open": processors.read_open_windows(spark, f"{root}/ckpt")}


def q_stream_metric_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MET-06: twin of ``metric_scrape``: final windows, windows that are
    still open, and late samples together hold every sample."""
    root = scratch_path(spark, "stream_metric_scrape")
    got = scraped(spark, fixtures.metric_samples_from(table_stream(spark, sf_dir, "events")), root)
    iv = metrics.SCRAPE_INTERVAL_SECONDS * 1_000_000
    every = got["window"].unionByName(got["late"]).unionByName(got["open"])
    return (every.groupBy(*metrics.SERIES, "slot")
            .agg(F.max_by("value", F.struct("us", "sample_id")).alias("value"), F.sum("n_samples").alias("n_samples"))
            .select(*metrics.SERIES, utc_wall_clock(F.timestamp_micros(F.col("slot") * iv)).alias("window_start"), "value", "n_samples"))


def _rename_stream(stream: DataFrame) -> DataFrame:
    """MET-01 on a stream: regex rules per record (no distinct pre-pass).
    Unmatched records keep a NULL name and drop out at panel tagging."""
    return metrics.rename_names(stream, "metric")


GROUPS = {"batch-10": 10, "single": 1}


def q_stream_two_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01, SRC-02, SRC-04, SNK-08, STR-06, STR-07: two consumer groups
    over one record stream, each its own query and checkpoint, so each sees
    every record; each cuts its micro-batches into consumer batches of N
    per topic partition.  Returns per group: records seen, the largest batch
    and the partitions.  (How many batches there are depends on where the
    micro-batches end, as it depends on time-outs elsewhere: the last batch
    of a micro-batch may be short.)"""
    root = scratch_path(spark, "stream_two_groups")
    for group, n in GROUPS.items():
        out = f"{root}/{group}/batches"
        write = batch_writer(out)

        def each(batch: DataFrame, batch_id: int, n=n, write=write) -> None:
            write(batching.batch_groups(batch, n), batch_id)

        recs = fixtures.kafka_records_from(table_stream(spark, sf_dir, "events"))
        run_to_end(recs, f"{root}/{group}/ckpt", foreach_batch=each, name=None)
    parts = [read_batches(spark, f"{root}/{g}/batches",
                          "partition int, batch_no bigint, n_records bigint, first_offset bigint, "
                          "last_offset bigint")
             .agg(F.sum("n_records").alias("n_records"), F.max("n_records").alias("largest_batch"),
                  F.countDistinct("partition").alias("n_partitions"))
             .select(F.lit(g).alias("group_id"), "n_records", "largest_batch", "n_partitions") for g in GROUPS]
    return parts[0].unionByName(parts[1])


def q_stream_record_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01, SRC-06: records with their headers go to a topic folder in the
    Kafka layout, and a second query streams that folder and reads them."""
    root = scratch_path(spark, "stream_record_headers")
    run_to_end(fixtures.kafka_records_from(table_stream(spark, sf_dir, "events")), f"{root}/ckpt_topic",
               path=f"{root}/topic")
    run_to_end(header_rows(read_record_stream(spark, f"{root}/topic")), f"{root}/ckpt", path=f"{root}/out")
    return spark.read.parquet(f"{root}/out")


# ---- good records and rejects of one stream (COD-05, COD-06) -------------------

CDC_GOOD = "table string, op string, lsn bigint, key_id bigint, id int, value double"
CDC_REJECT = "topic string, partition int, offset bigint, raw string, reason string"
BLOCK_GOOD = "user_id string, blocked_id string, offset bigint, last_action string"
BLOCK_REJECT = "key string, value string, offset bigint, reason string"
RECORD_REJECT = "partition int, offset bigint, raw string, reason string"


def tagged_changes(records: DataFrame) -> DataFrame:
    """Change records, decoded once, with the columns of both outputs."""
    decoded = cdc.decode_changes(records, list(CDC_TABLES), raw=True)
    rejected = outputs.tagged(decoded, cdc.change_reason("raw"))
    img = cdc.current_image()
    return rejected.select(
        "table", "op", "lsn", "key_id", *[cdc.field(img, n, t).alias(n) for n, t in CDC_FIELDS.items()],
        "topic", "partition", "offset", F.when(F.col("reason").isNotNull(), F.col("raw").cast("string")).alias("raw"),
        "reason", outputs.OUTPUT)


def split_changes(spark: SparkSession, sf_dir: str, root: str, name: str | None = None) -> str:
    """Stream the change records, some of them broken, to good changes and
    rejects; returns the folder of both."""
    rec = fixtures.spoiled(fixtures.cdc_records_from(table_stream(spark, sf_dir, "events")))
    outputs.run_split(tagged_changes(rec), f"{root}/ckpt", f"{root}/out", name)
    return f"{root}/out"


def q_stream_cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COD-05: twin of ``cdc_rejects``: what is no change is set aside and
    the stream goes on; the good changes lie beside (``stream_cdc_accepted``)."""
    path = split_changes(spark, sf_dir, scratch_path(spark, "stream_cdc_rejects"))
    return outputs.read_output(spark, path, outputs.REJECTED, CDC_REJECT).withColumnRenamed("raw", "value")


def q_stream_cdc_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COD-05, CDC-02, STR-02: the table state folded from the good output of
    the split, which is the input of the next query."""
    root = scratch_path(spark, "stream_cdc_accepted")
    good = outputs.stream_output(spark, split_changes(spark, sf_dir, f"{root}/split"), outputs.GOOD, CDC_GOOD)
    run_to_end(latest_stream(good, ["table", "key_id"], "lsn", ["op", *CDC_FIELDS]), f"{root}/ckpt", output_mode="update")
    st = read_latest(spark, f"{root}/ckpt", CDC_STATE)
    return st.filter(F.col("op") != "d").select("table", "key_id", "lsn", *CDC_FIELDS)


def q_stream_block_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COD-05, COD-06: twin of ``block_event_rejects``; the pair table is
    folded from the good output."""
    root = scratch_path(spark, "stream_block_rejects")
    split_block_events(spark, table_stream(spark, sf_dir, "events"), root)
    return outputs.read_output(spark, f"{root}/out", outputs.REJECTED, BLOCK_REJECT).withColumnRenamed("offset", "event_offset")


def split_block_events(spark: SparkSession, events: DataFrame, root: str) -> None:
    """Block events to rejects and good events, and from these the pair
    table in the state at ``root/ckpt_pairs``."""
    parts = blocklist.tag_block_events(fixtures.block_events_from(events))
    both = outputs.tagged(parts, F.col("reason")).withColumnRenamed("action", "last_action")
    outputs.run_split(both.drop("blocker_id"), f"{root}/ckpt", f"{root}/out")
    good = outputs.stream_output(spark, f"{root}/out", outputs.GOOD, BLOCK_GOOD)
    run_to_end(latest_stream(good, ["user_id", "blocked_id"], "offset", ["last_action"]), f"{root}/ckpt_pairs", output_mode="update")


def tagged_records(records: DataFrame) -> DataFrame:
    """Event records, decoded once; a value that is missing, no JSON, null or
    of another type than the schema is a reject."""
    d = records.select("partition", "offset", F.col("value").cast("string").alias("raw"), decode_json("value", EVENT_SCHEMA_DDL).alias("v"))
    reason = codecs.record_reason("raw", "v")
    return outputs.tagged(d, reason).withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))


def q_stream_record_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COD-06, SRC-08: twin of ``record_rejects``."""
    root = scratch_path(spark, "stream_record_rejects")
    rec = fixtures.mistyped(fixtures.kafka_records_from(table_stream(spark, sf_dir, "events")))
    outputs.run_split(tagged_records(rec), f"{root}/ckpt", f"{root}/out")
    got = outputs.read_output(spark, f"{root}/out", outputs.REJECTED, RECORD_REJECT)
    return got.select(F.col("partition").alias("topic_partition"), F.col("offset").alias("record_offset"),
                      F.col("raw").alias("value"), "reason")


def q_stream_delivery_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-03, AGG-08: rows delivered to each output of the split, as Spark
    observed them while they were written."""
    root = scratch_path(spark, "stream_delivery_counts")
    with outputs.DeliveryCounter(spark) as counter:
        split_changes(spark, sf_dir, root, name="delivery_counts")
    n = counter.counts()
    return spark.createDataFrame([(o, n.get(("delivery_counts", o), 0)) for o in (outputs.GOOD, outputs.REJECTED)],
                                 "output string, n_records bigint")


# ---- tables by state variables -----------------------------------------------------

def q_stream_cdc_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11, CDC-06: twin of ``cdc_snapshot_state``: the users' snapshot is
    the initial state, and the changes captured after it stream in."""
    ckpt = scratch_path(spark, "stream_cdc_snapshot")
    snapshot = fixtures.users_snapshot(spark, sf_dir).withColumns({"op": F.lit("r"), "lsn": F.lit(0).cast("bigint")})
    records = fixtures.user_change_records(table_stream(spark, sf_dir, "customer"))
    changes = cdc.typed_projection(cdc.decode_changes(records, include=["public.users"]), USER_FIELDS).filter("op <> 'c'")
    run_to_end(processors.latest_from_snapshot(snapshot, changes, ["table", "key_id"], "lsn"), ckpt, output_mode="update")
    st = processors.read_snapshot_table(spark, ckpt, snapshot, changes.columns)
    return st.filter("op <> 'd'").select("table", "key_id", "lsn", *USER_FIELDS)


def q_stream_block_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04, STR-03: twin of ``block_changes``: each event that alters a
    user's set, which is a map state of one entry per blocked id."""
    root = scratch_path(spark, "stream_block_changes")
    good, _ = blocklist.parse_block_events(fixtures.block_events_from(table_stream(spark, sf_dir, "events")))
    run_to_end(processors.block_changes(good), f"{root}/ckpt", path=f"{root}/out")
    return spark.read.schema(processors.CHANGE_OUTPUT).parquet(f"{root}/out").withColumnRenamed("offset", "event_offset")


def q_stream_block_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-09, SNK-07: the pair table's changes as a feed, played back to the
    table."""
    ckpt = scratch_path(spark, "stream_block_feed")
    keep_changelog(spark)
    build_block_state(spark, table_stream(spark, sf_dir, "events"), ckpt)
    feed = read_changes(spark, ckpt, PAIR_STATE)
    return replayed_changes(feed, ["user_id", "blocked_id"]).withColumnRenamed("offset", "event_offset")


REPLAY_DELAY = "40 days"        # how far out of order the log's files may come


def q_stream_replay_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-04, STR-05: twin of ``censor_replay_asof``: messages wait in event
    time and are judged by the blocks of their own time, in whatever order
    the files come."""
    root = scratch_path(spark, "stream_replay_asof")
    return replayed(spark, table_stream(spark, sf_dir, "events"), root, REPLAY_DELAY)


def replayed(spark: SparkSession, events: DataFrame, root: str, delay: str) -> DataFrame:
    """The replay over a log that ends: its events, then a heartbeat."""
    at = events.withColumn("ts", utc_instant("ts"))
    good, _ = blocklist.parse_block_events(fixtures.block_events_from(at), extra=("ts",))
    rows = processors.replay_rows(fixtures.timed_messages_from(at), good)
    beats, out = f"{root}/beats", f"{root}/out"
    processors.no_beats(spark, beats)

    def run() -> None:
        got = processors.replay_asof(rows, spark.readStream.schema(processors.REPLAY_SCHEMA).parquet(beats), delay)
        run_to_end(got, f"{root}/ckpt", path=out)
    run()
    processors.heartbeat(spark, beats, "2200-01-01")
    run()
    got = spark.read.schema(processors.REPLAY_OUTPUT).parquet(out)
    return got.select("id", "from_user_id", "to_user_id", utc_wall_clock(F.timestamp_micros("us")).alias("ts"), "block_state")


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_block_list": q_stream_block_list,
    "stream_dictionary": q_stream_dictionary,
    "stream_censor": q_stream_censor,
    "stream_spend_category": q_stream_spend_category,
    "stream_spend_category_state": q_stream_spend_category_state,
    "stream_cdc_state": q_stream_cdc_state,
    "stream_metric_rate": q_stream_metric_rate,
    "stream_metric_scrape": q_stream_metric_scrape,
    "stream_two_groups": q_stream_two_groups,
    "stream_record_headers": q_stream_record_headers,
    "stream_cdc_rejects": q_stream_cdc_rejects,
    "stream_cdc_accepted": q_stream_cdc_accepted,
    "stream_block_rejects": q_stream_block_rejects,
    "stream_record_rejects": q_stream_record_rejects,
    "stream_delivery_counts": q_stream_delivery_counts,
    "stream_cdc_snapshot": q_stream_cdc_snapshot,
    "stream_block_changes": q_stream_block_changes,
    "stream_block_feed": q_stream_block_feed,
    "stream_replay_asof": q_stream_replay_asof,
}

# Twin -> batch query whose oracle SQL states the same result.
STREAM_ORACLE = {
    "stream_block_list": "block_list",
    "stream_dictionary": "bad_word_dictionary",
    "stream_censor": "censor_messages",
    "stream_spend_category": "spend_category_changes",
    "stream_spend_category_state": "spend_category_changes",
    "stream_cdc_state": "cdc_current_state",
    "stream_metric_rate": "metric_rate",
    "stream_metric_scrape": "metric_scrape",
    "stream_record_headers": "record_headers",
    "stream_cdc_rejects": "cdc_rejects",
    "stream_cdc_accepted": "cdc_accepted_state",
    "stream_block_rejects": "block_event_rejects",
    "stream_record_rejects": "record_rejects",
    "stream_delivery_counts": "delivery_counts",
    "stream_cdc_snapshot": "cdc_snapshot_state",
    "stream_block_changes": "block_changes",
    "stream_block_feed": "block_pair_state",
    "stream_replay_asof": "censor_replay_asof",
}

TWO_GROUPS_SQL = """
WITH p AS (SELECT user_id % 3 AS p, count(*) AS n FROM events GROUP BY 1),
g(group_id, most) AS (VALUES ('batch-10', 10), ('single', 1))
SELECT group_id, CAST(sum(n) AS BIGINT) AS n_records, CAST(max(least(n, most)) AS BIGINT) AS largest_batch, count(*) AS n_partitions
FROM g CROSS JOIN p GROUP BY group_id
"""
