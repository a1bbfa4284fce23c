"""Streaming twins over several micro-batches, restart from a checkpoint,
replay of a batch, and tables that change while a stream runs."""

import os
import tempfile

import pytest

from streamfold.plans import catalog
from streamfold.streaming import sinks, stateful, twins
from streamfold.streaming.sources import FILES_CONF, dir_stream, table_stream
from streamfold.streaming.state import read_latest

SF = "/root/testdata/sf0.001"
SPLIT = {"events": "event_id", "orders": "o_orderkey", "documents": "doc_id", "benchmark": "item_id",
         "customer": "c_custkey"}


@pytest.fixture(scope="module")
def split_dir(spark):
    """The smallest tables, each cut into 4 files by offset range."""
    root = tempfile.mkdtemp(prefix="streamfold-split-")
    for name, key in SPLIT.items():
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        df.repartitionByRange(4, key).sortWithinPartitions(key).write.parquet(f"{root}/{name}.parquet")
        # The file source takes files in modification-time order; stamp the
        # range files so that they arrive in offset order, as a log would.
        parts = sorted(f for f in os.listdir(f"{root}/{name}.parquet") if f.endswith(".parquet"))
        for i, f in enumerate(parts):
            os.utime(f"{root}/{name}.parquet/{f}", (1_700_000_000 + 60 * i,) * 2)
    return root


@pytest.fixture()
def multi_batch(spark, split_dir):
    """One file a micro-batch."""
    spark.conf.set(FILES_CONF, "1")
    yield split_dir
    spark.conf.unset(FILES_CONF)


def same(a, b):
    cols = sorted(a.columns)
    ra = sorted(map(tuple, a.select(*cols).collect()), key=str)
    rb = sorted(map(tuple, b.select(*cols).collect()), key=str)
    return ra == rb


@pytest.mark.parametrize("twin,batch", [
    ("stream_block_list", "block_list"),
    ("stream_dictionary", "bad_word_dictionary"),
    ("stream_spend_category", "spend_category_changes"),
    ("stream_spend_category_state", "spend_category_changes"),
    ("stream_cdc_state", "cdc_current_state"),
    ("stream_metric_rate", "metric_rate"),
    ("stream_censor", "censor_messages"),
    ("stream_record_headers", "record_headers"),
    ("stream_cdc_rejects", "cdc_rejects"),
    ("stream_cdc_accepted", "cdc_accepted_state"),
    ("stream_block_rejects", "block_event_rejects"),
    ("stream_record_rejects", "record_rejects"),
    ("stream_cdc_snapshot", "cdc_snapshot_state"),
    ("stream_block_changes", "block_changes"),
    ("stream_block_feed", "block_pair_state"),
    ("stream_metric_scrape", "metric_scrape"),
])
def test_twin_over_many_batches(spark, multi_batch, twin, batch):
    assert same(twins.STREAM_QUERIES[twin](spark, multi_batch), catalog.QUERIES[batch](spark, SF))


def test_restart_resumes_from_checkpoint(spark, split_dir):
    """Two files, stop, two more files, restart on the same checkpoint:
    the block table in Spark's state equals one run over all four."""
    from streamfold.operators import blocklist
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    files = sorted(f for f in os.listdir(f"{split_dir}/events.parquet") if f.endswith(".parquet"))
    src = tempfile.mkdtemp(prefix="streamfold-src-")
    ckpt = tempfile.mkdtemp(prefix="streamfold-restart-")
    assert read_latest(spark, f"{ckpt}/none", twins.PAIR_STATE).count() == 0      # nothing committed yet
    for part in (files[:2], files[2:]):
        for f in part:
            os.symlink(f"{split_dir}/events.parquet/{f}", f"{src}/{f}")
        twins.build_block_state(spark, dir_stream(spark, src, schema, 1), ckpt)
    got = blocklist.block_list_from_state(read_latest(spark, ckpt, twins.PAIR_STATE))
    assert same(got, catalog.QUERIES["block_list"](spark, SF))


def test_replayed_batch_is_exact(spark, tmp_path):
    """A batch that runs again after a failure rewrites its own output and
    state, and sees the state as it was before it."""
    state, out = f"{tmp_path}/state", f"{tmp_path}/out"
    each = stateful.spend_category_batches(spark, state, out)
    schema = "user_id bigint, order_id bigint, order_amount bigint, offset bigint"
    first = spark.createDataFrame([(1, 1, 400000, 1), (2, 2, 600000, 2), (1, 3, 90000, 3)], schema)
    second = spark.createDataFrame([(1, 4, 20000, 4), (1, 5, 600000, 5)], schema)
    for batch_id, batch in ((0, first), (0, first), (1, second), (1, second)):
        each(batch, batch_id)
    got = sinks.read_batches(spark, out, stateful.SPEND_OUTPUT).orderBy("offset").collect()
    assert [(r.user_id, r.total, r.category) for r in got] == [
        (1, 400000, "bronze"), (2, 600000, "silver"), (1, 510000, "silver"), (1, 1110000, "gold")]


def test_table_changes_between_micro_batches(spark, tmp_path):
    """STR-05: a block that commits while the message stream runs stops the
    next micro-batch's messages, and an unblock lets them pass again."""
    from pyspark.sql import functions as F
    src, ckpt, out = f"{tmp_path}/events", f"{tmp_path}/ckpt", f"{tmp_path}/out"
    events = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"

    def commit(event_id: int, kind: str) -> None:
        """User 7's event about user 1 (event_id mod 7)."""
        row = spark.createDataFrame([(event_id, 7, kind)], "event_id bigint, user_id bigint, event_type string")
        row.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")).select(
            "event_id", "ts", "user_id", "event_type").coalesce(1).write.mode("append").parquet(src)
        twins.build_block_state(spark, dir_stream(spark, src, events), ckpt)

    changes = {0: (1, "click"), 1: (8, "error")}        # block, then unblock
    write = sinks.batch_writer(out)

    def write_then_change(batch, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id in changes:
            commit(*changes[batch_id])
    each = twins.censor_batches(lambda: twins.current_blocks(spark, ckpt),
                                lambda: spark.createDataFrame([("bad", "***")], "word string, mask string"),
                                write_then_change)
    msgs = f"{tmp_path}/msgs"
    for i in range(3):
        spark.createDataFrame([(i, "1", "7", f"bad {i}")], twins.DELIVERED).coalesce(1).write.mode("append").parquet(msgs)
        part = max((f for f in os.listdir(msgs) if f.endswith(".parquet")), key=lambda f: os.stat(f"{msgs}/{f}").st_ctime_ns)
        os.utime(f"{msgs}/{part}", (1_700_000_000 + 60 * i,) * 2)
    sinks.run_to_end(dir_stream(spark, msgs, twins.DELIVERED, 1), f"{tmp_path}/ckpt_msgs", foreach_batch=each)
    got = sinks.read_batches(spark, out, twins.DELIVERED).orderBy("id").collect()
    assert [(r.id, r.text) for r in got] == [(0, "*** 0"), (2, "*** 2")]


def test_two_groups_over_many_batches(spark, multi_batch):
    """Each group sees every record; consumer batches never exceed N and are
    cut inside each micro-batch, so the last one of a micro-batch may be
    short (Q20)."""
    got = {r.group_id: (r.n_records, r.largest_batch, r.n_partitions)
           for r in twins.STREAM_QUERIES["stream_two_groups"](spark, multi_batch).collect()}
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    assert got == {"single": (n, 1, 3), "batch-10": (n, 10, 3)}


def test_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        table_stream(spark, str(tmp_path), "events")


def test_merged_runs_are_one_sorted_run():
    import numpy as np
    r = np.random.default_rng(1)
    for sizes in ([], [5], [1000, 3, 0, 400], [64] * 20):
        runs = [tuple(c[np.argsort(x, kind="stable")] for c in (x, x * 2, x * 3)) for x in (r.integers(0, 300, n) for n in sizes)]
        got = list(stateful.merged_runs(runs, rows=50))
        every = np.concatenate([g[0] for g in got]) if got else np.zeros(0)
        assert every.tolist() == sorted(x for run in runs for x in run[0].tolist())
        assert all((g[1] == 2 * g[0]).all() and (g[2] == 3 * g[0]).all() for g in got)
        assert all(a[0][-1] < b[0][0] for a, b in zip(got, got[1:]))          # equal offsets are together


def test_one_user_with_a_third_of_the_rows_in_bounded_memory():
    """Frames are let go as they come: what the fold holds is 24 bytes a
    record and a piece, not the frames."""
    import tracemalloc

    import numpy as np
    import pandas as pd

    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, v):
            self.value = v
    frames, rows = 200, 10_000

    def batch():
        r = np.random.default_rng(2)
        for i in range(frames):          # offsets of all frames interleave
            offset = r.permutation(rows) * frames + i
            yield pd.DataFrame({"offset": offset, "order_amount": np.ones(rows, np.int64), "order_id": offset,
                                "note": ["x" * 200 + str(k) for k in range(rows)]})
    p = stateful.SpendCategoryProcessor()
    p.state = Held()
    tracemalloc.start()
    out = pd.concat(p.handleInputRows((7,), batch(), None))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert p.state.value == (frames * rows, "gold") and out["total"].tolist() == [1, 500_000, 1_000_000]
    assert out["offset"].tolist() == [0, 499_999, 999_999]
    assert peak < 24 * frames * rows + 40_000_000


# ---- several outputs of one stream ---------------------------------------------

def test_outputs_add_up_and_replay_exactly(spark, multi_batch, tmp_path):
    """Every record is in one output, and a batch that runs again replaces
    both of its outputs."""
    from streamfold.sources import fixtures
    from streamfold.streaming import outputs
    path = twins.split_changes(spark, multi_batch, str(tmp_path))
    n = spark.read.parquet(f"{SF}/events.parquet").count()

    def sizes():
        return [outputs.read_output(spark, path, o, s).count()
                for o, s in ((outputs.GOOD, twins.CDC_GOOD), (outputs.REJECTED, twins.CDC_REJECT))]
    first = sizes()
    assert sum(first) == n and first[1] > 0
    again = twins.tagged_changes(fixtures.spoiled(fixtures.cdc_records(spark, SF)).filter("offset < 50"))
    outputs.outputs_writer(path)(again, 0)
    replaced = sizes()
    assert replaced[0] + replaced[1] < n
    outputs.outputs_writer(path)(again, 0)
    assert sizes() == replaced


def test_records_are_decoded_once(spark):
    """Both outputs come from one decode."""
    from streamfold.sources import fixtures
    from tests.test_plans import plan
    both = twins.tagged_changes(fixtures.spoiled(fixtures.cdc_records(spark, SF)))
    text = plan(both, "formatted")
    assert text.count("from_json(StructField(before") <= 1 and "Union" not in text


def test_empty_outputs(spark, tmp_path):
    from streamfold.streaming import outputs
    assert outputs.read_output(spark, f"{tmp_path}/none", outputs.GOOD, twins.CDC_GOOD).count() == 0


def test_delivery_counts_per_output(spark, multi_batch):
    """Observed counts of all micro-batches, each once."""
    got = {r.output: r.n_records for r in twins.STREAM_QUERIES["stream_delivery_counts"](spark, multi_batch).collect()}
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    assert got == {"rejected": catalog.QUERIES["cdc_rejects"](spark, SF).count(), "good": n - catalog.QUERIES["cdc_rejects"](spark, SF).count()}


# ---- tables by state variables ---------------------------------------------------

def parts_in_order(path, n):
    """Give the newest part file of ``path`` its place in the stream."""
    part = max((f for f in os.listdir(path) if f.endswith(".parquet")), key=lambda f: os.stat(f"{path}/{f}").st_ctime_ns)
    os.utime(f"{path}/{part}", (1_700_000_000 + 60 * n,) * 2)


def test_snapshot_then_changes(spark, tmp_path):
    """Changes as old as the snapshot, or older, are part of it; keys without
    a change keep their snapshot row; deletes stay as the last change."""
    from streamfold.streaming import processors
    cols = "table string, key_id bigint, op string, lsn bigint, name string"
    snapshot = spark.createDataFrame([("t", 1, "r", 10, "one"), ("t", 2, "r", 10, "two"), ("t", 3, "r", 10, None)], cols)
    src, ckpt = f"{tmp_path}/changes", f"{tmp_path}/ckpt"
    assert {r.name for r in processors.read_snapshot_table(spark, ckpt, snapshot, ["name"]).collect()} == {"one", "two", None}
    batches = [[("t", 1, "u", 9, "older than the snapshot"), ("t", 2, "u", 12, "new"), ("t", 4, "c", 13, "four")],
               [("t", 2, "u", 11, "late"), ("t", 3, "d", 14, None), ("t", 4, "u", 15, None)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(src)
        parts_in_order(src, i)
    stream = dir_stream(spark, src, cols, 1)
    sinks.run_to_end(processors.latest_from_snapshot(snapshot, stream, ["table", "key_id"], "lsn"), ckpt, output_mode="update")
    got = {r.key_id: (r.op, r.lsn, r.name) for r in processors.read_snapshot_table(
        spark, ckpt, snapshot, ["key_id", "op", "lsn", "name"]).collect()}
    assert got == {1: ("r", 10, "one"), 2: ("u", 12, "new"), 3: ("d", 14, None), 4: ("u", 15, None)}


def test_feed_replays_to_the_table_at_every_batch(spark, split_dir, tmp_path):
    """The change log of the state leads to the table as it was after each
    micro-batch, and names the batch of every change."""
    from streamfold.streaming import state
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    src, ckpt = f"{tmp_path}/events", f"{tmp_path}/ckpt"
    os.makedirs(src)
    state.keep_changelog(spark)
    tables = []
    for f in sorted(f for f in os.listdir(f"{split_dir}/events.parquet") if f.endswith(".parquet")):
        os.symlink(f"{split_dir}/events.parquet/{f}", f"{src}/{f}")
        twins.build_block_state(spark, dir_stream(spark, src, schema, 1), ckpt)
        tables.append({tuple(r) for r in read_latest(spark, ckpt, twins.PAIR_STATE).collect()})
    feed = state.read_changes(spark, ckpt, twins.PAIR_STATE)
    batches = sorted(r.batch for r in feed.select("batch").distinct().collect())
    assert len(batches) == len(tables) == 4
    for batch, table in zip(batches, tables):
        got = state.replayed_changes(feed, ["user_id", "blocked_id"], upto=batch)
        assert {tuple(r) for r in got.select("user_id", "blocked_id", "offset", "last_action").collect()} == table


def test_block_set_of_one_large_user(spark, tmp_path):
    """100,000 blocks of one user are 100,000 map entries; one more event
    touches one of them."""
    from pyspark.sql import functions as F

    from streamfold.streaming import processors
    cols = "user_id string, blocked_id string, offset bigint, action string"
    src, out, ckpt = f"{tmp_path}/events", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    many = spark.range(100_000).select(F.lit("7").alias("user_id"), F.col("id").cast("string").alias("blocked_id"),
                                       F.col("id").alias("offset"), F.lit("block").alias("action"))
    few = spark.createDataFrame([("7", "5", 200_000, "unblock"), ("7", "5", 200_001, "unblock"), ("7", "6", 200_002, "block"),
                                 ("7", "x", 200_003, "unblock"), ("8", "7", 200_004, "block")], cols)
    for i, df in enumerate((many, few)):
        df.coalesce(1).write.mode("append").parquet(src)
        parts_in_order(src, i)
    sinks.run_to_end(processors.block_changes(dir_stream(spark, src, cols, 1)), ckpt, path=out)
    got = spark.read.schema(processors.CHANGE_OUTPUT).parquet(out)
    assert got.filter("offset < 200000").count() == 100_000
    assert {(r.user_id, r.blocked_id, r.change) for r in got.filter("offset >= 200000").collect()} == {("7", "5", "removed"), ("8", "7", "added")}
    sets = processors.read_block_sets(spark, ckpt)
    assert sets.count() == 100_000 and sets.filter("blocked_id = '5'").count() == 0


def test_replay_with_shuffled_files(spark, split_dir, tmp_path):
    """Files in any order: the result is that of the whole log."""
    src = f"{tmp_path}/events.parquet"
    os.makedirs(src)
    files = sorted(f for f in os.listdir(f"{split_dir}/events.parquet") if f.endswith(".parquet"))
    for i, f in enumerate([files[2], files[0], files[3], files[1]]):
        with open(f"{split_dir}/events.parquet/{f}", "rb") as a, open(f"{src}/{f}", "wb") as b:
            b.write(a.read())
        os.utime(f"{src}/{f}", (1_700_000_000 + 60 * i,) * 2)
    spark.conf.set(FILES_CONF, "1")
    try:
        got = twins.STREAM_QUERIES["stream_replay_asof"](spark, str(tmp_path))
    finally:
        spark.conf.unset(FILES_CONF)
    assert same(got, catalog.QUERIES["censor_replay_asof"](spark, SF))


def test_replay_judges_as_time_goes_on(spark, multi_batch, tmp_path):
    """In a log that is in order, messages come out before it ends."""
    from streamfold.streaming import processors
    root = str(tmp_path)
    seen = []
    beat = processors.heartbeat
    processors.heartbeat = lambda spark, *a: (seen.append(spark.read.schema(processors.REPLAY_OUTPUT).parquet(f"{root}/out").count()),
                                              beat(spark, *a))
    try:
        got = twins.replayed(spark, table_stream(spark, multi_batch, "events"), root, "1 hour")
    finally:
        processors.heartbeat = beat
    want = catalog.QUERIES["censor_replay_asof"](spark, SF)
    assert same(got, want) and want.count() * 3 // 4 < seen[0] <= want.count()


def test_late_samples_are_kept_beside_final_windows(spark, split_dir, tmp_path):
    """Files out of order, a short delay: samples of windows that are final
    come out as late, windows come out once, and nothing is lost."""
    from streamfold.sources import fixtures
    src = f"{tmp_path}/events"
    os.makedirs(src)
    files = sorted(f for f in os.listdir(f"{split_dir}/events.parquet") if f.endswith(".parquet"))
    for i, f in enumerate([files[1], files[0], files[3], files[2]]):
        with open(f"{split_dir}/events.parquet/{f}", "rb") as a, open(f"{src}/{f}", "wb") as b:
            b.write(a.read())
        os.utime(f"{src}/{f}", (1_700_000_000 + 60 * i,) * 2)
    events = dir_stream(spark, src, spark.read.parquet(f"{SF}/events.parquet").schema, 1)
    got = twins.scraped(spark, fixtures.metric_samples_from(events), str(tmp_path), delay_s=3600)
    late, windows, still = (got[k].collect() for k in ("late", "window", "open"))
    n = sum(r.n_samples for r in catalog.QUERIES["metric_scrape"](spark, SF).collect())
    assert sum(r.n_samples for r in [*late, *windows, *still]) == n
    ids = [(r.name, r.connector, r.task, r.client_id, r.slot) for r in [*windows, *still]]
    assert len(ids) == len(set(ids)) and len(late) > n // 4 and windows


def test_windows_of_one_series(spark, tmp_path):
    """Ties in time go to the larger id; a window takes samples of several
    micro-batches while it is open, and none when it is final."""
    from pyspark.sql import functions as F
    from streamfold.streaming import processors
    cols, src = "name string, sample_id bigint, s double, value double", f"{tmp_path}/in"
    batches = [[("a", 1, 0.0, 1.0), ("a", 3, 2.0, 3.0), ("a", 2, 2.0, 2.0)], [("a", 4, 1.0, 9.0), ("a", 5, 14.0, 5.0)],
               [("a", 6, 4.0, 6.0), ("a", 7, 10.0, 7.0), ("b", 8, 3.0, 8.0)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(src)
        parts_in_order(src, i)
    none = F.lit(None).cast("string")
    stream = dir_stream(spark, src, cols, 1).select("name", none.alias("connector"), none.alias("task"), none.alias("client_id"), "sample_id",
                                                    F.timestamp_micros((F.col("s") * 1e6).cast("bigint")).alias("ts"), "value")
    out = f"{tmp_path}/out"
    sinks.run_to_end(processors.scrape_windows(stream, 5, 5), f"{tmp_path}/ckpt", path=out)
    got = {(r.name, r.output, r.slot, r.sample_id, r.value, r.n_samples) for r in spark.read.schema(processors.SCRAPE_OUTPUT).parquet(out).collect()}
    still = {(r.name, r.slot, r.sample_id, r.value, r.n_samples) for r in processors.read_open_windows(spark, f"{tmp_path}/ckpt").collect()}
    assert got == {("a", "window", 0, 3, 3.0, 4), ("a", "late", 0, 6, 6.0, 1)}
    assert still == {("a", 2, 5, 5.0, 2), ("b", 0, 8, 8.0, 1)}
