"""Per-record keyed state for streams (STR-03, UDF-02, AGG-01, AGG-05).

Input order: a key's records must arrive in offset order across
micro-batches, as they do from one Kafka partition.  Within a micro-batch
both forms sort by offset themselves.  A file source takes files in
modification-time order, so files must be written in log order.

``outputMode("update")`` gives one row per key per micro-batch; the spend
chain emits per record (a running total per order, a category only when
it changes), so it runs as one ``transformWithStateInPandas`` with a
row per user in its state.  State lives in the RocksDB state store and is
checkpointed with the query.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.spend import BRONZE, GOLD, GOLD_FROM, SILVER, SILVER_FROM

SPEND_OUTPUT = "user_id bigint, order_id bigint, offset bigint, total bigint, category string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _bands(totals: np.ndarray) -> np.ndarray:
    return np.where(totals >= GOLD_FROM, GOLD,
                    np.where(totals >= SILVER_FROM, SILVER, BRONZE)).astype(object)


# Where keys are many, a group is a bucket of keys and its state a few pages
# of Arrow rows, a row per key: a call to the state server costs about as much
# as a thousand rows of a page, and a group more than that.
BUCKET, PAGE = "sf_bucket", "sf_page"        # a frame would rename what begins with _
STATE_BUCKETS = 256             # groups of a stream that has many keys
STATE_PAGES = 16                # pages of a group
BUCKETS_CONF = "streamfold.stateBuckets"


def key_bucket(spark: SparkSession, keys: list[str]) -> Column:
    """The bucket of a row's key, one of ``BUCKETS_CONF``.  The number is to
    leave a page some MB and to exceed the cluster's cores; it is part of a
    checkpoint and stays for as long as that is used."""
    n = int(spark.conf.get(BUCKETS_CONF, str(STATE_BUCKETS)))
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def key_page(keys: list[str]) -> Column:
    """The page of a row's key in its bucket."""
    return F.pmod(F.hash(*keys), F.lit(STATE_PAGES)).cast("bigint")


def packed(rows: pa.Table) -> bytes:
    """Rows as an Arrow stream, which names its columns."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_table(rows.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpacked(cell) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(cell))).read_all()


def by_page(pages: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(page, its rows) of every page, rows as they come."""
    at = np.argsort(pages, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], np.diff(pages[at]) != 0)))
    return [(int(pages[part[0]]), part) for part in np.split(at, starts[1:])]


MERGE_ROWS = 1 << 14            # records of a key that are folded at a time


FOLDED = ("offset", "order_amount", "order_id")


def _sorted_run(frame: pd.DataFrame, columns: tuple[str, ...] = FOLDED) -> tuple[np.ndarray, ...]:
    """The columns of a frame, by offset."""
    cols = tuple(frame[c].to_numpy(dtype=np.int64) for c in columns)
    if (np.diff(cols[0]) >= 0).all():
        return tuple(c.copy() for c in cols)
    at = np.argsort(cols[0], kind="stable")
    return tuple(c[at] for c in cols)


def merged_runs(runs: list[tuple[np.ndarray, ...]], rows: int = MERGE_ROWS):
    """Sorted runs as one, in pieces of about ``rows`` records: what all runs
    have up to an offset is sorted and given, so that a piece beyond the runs
    is all that is held.  Equal offsets are never parted."""
    at = [0] * len(runs)
    share = max(1, rows // max(1, len(runs)))
    while any(a < len(r[0]) for a, r in zip(at, runs)):
        # The least of the runs' next bounds: no run has fewer than its share below.
        upto = min(r[0][min(a + share, len(r[0])) - 1] for a, r in zip(at, runs) if a < len(r[0]))
        ends = [int(np.searchsorted(r[0], upto, side="right")) for r in runs]
        parts = [tuple(c[a:z] for c in r) for a, z, r in zip(at, ends, runs) if z > a]
        at = [max(a, z) for a, z in zip(at, ends)]
        cols = [np.concatenate(c) for c in zip(*parts)]
        order = np.argsort(cols[0], kind="stable")
        yield tuple(c[order] for c in cols)


def _fold_spend(user: np.ndarray, offset: np.ndarray, amount: np.ndarray, order: np.ndarray, held: dict) -> pd.DataFrame:
    """The records of a piece that change their user's category; ``held``
    has each user's (total, category) and goes on."""
    # Vectorised fold: totals are a cumulative sum per user; a record emits when
    # its band differs from the band before it (the stored one first).
    at = np.argsort(user, kind="stable")
    user, offset, amount, order = user[at], offset[at], amount[at], order[at]
    starts = np.flatnonzero(np.concatenate(([True], user[1:] != user[:-1])))
    sizes = np.diff(np.append(starts, len(user)))
    users = user[starts].tolist()
    stored = [held.get(u, (0, None)) for u in users]
    sums = np.cumsum(amount)
    totals = sums + np.repeat(np.array([t for t, _ in stored], np.int64) - (sums[starts] - amount[starts]), sizes)
    cats = _bands(totals)
    before = np.concatenate([np.array([None], dtype=object), cats[:-1]])
    before[starts] = [c for _, c in stored]
    emit = before != cats
    ends = starts + sizes - 1
    held.update(zip(users, zip(totals[ends].tolist(), cats[ends].tolist())))
    return pd.DataFrame({"user_id": user[emit], "order_id": order[emit], "offset": offset[emit], "total": totals[emit],
                         "category": cats[emit].astype(str)})


class SpendCategoryProcessor(StatefulProcessor):
    """Running total per user; emit ``(user, order, offset, total,
    category)`` when the category differs from the stored one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        # One value state holding both fields: every state access is a call
        # to the state server, so per key there is one get and one update.
        self.state = handle.getValueState("spend", "total bigint, category string")

    def handleInputRows(self, key, rows, timerValues):
        # Only offset, amount and id of a record are held, 24 bytes each, as
        # runs sorted frame by frame; the frames themselves are let go.
        runs = [_sorted_run(f) for f in rows]
        stored = self.state.get()
        held = {0: (int(stored[0]), stored[1])} if stored is not None else {}
        for piece in merged_runs(runs):
            changes = _fold_spend(np.zeros(len(piece[0]), np.int64), *piece, held)
            if len(changes):
                yield changes.assign(user_id=np.full(len(changes), key[0], dtype=np.int64))
        self.state.update(held[0])

    def close(self) -> None:
        pass


class SpendCategoryBuckets(SpendCategoryProcessor):
    """The same for a bucket of users, whose state is pages of a row per
    user; ``user_id`` is null in the bucket below zero."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getMapState("spend", "page int", "users binary")
        self.schema = pa.schema([("user_id", pa.int64()), ("total", pa.int64()), ("category", pa.string())])

    def handleInputRows(self, key, rows, timerValues):
        # 32 bytes a record are held, and the pages of the users met.
        runs, pages = [], {}
        for f in rows:
            runs.append(_sorted_run(f, (*FOLDED, "user_id")))
            pages.update(zip(f["user_id"].tolist(), f[PAGE].tolist()))
        held, some = {}, self.pages.exists()
        for page in sorted(set(pages.values())) if some else []:
            cell = self.pages.getValue((page,))
            if cell is not None:
                user, total, category = (c.to_pylist() for c in unpacked(cell[0]).columns)
                held.update(zip(user, zip(total, category)))
                pages.update((u, page) for u in user)
        for offset, amount, order, user in merged_runs(runs):
            changes = _fold_spend(user, offset, amount, order, held)
            if len(changes):
                yield changes if key[0] >= 0 else changes.assign(user_id=pd.array([None] * len(changes), dtype="Int64"))
        user = np.fromiter(held, np.int64, len(held))
        every = pa.table([pa.array(user), pa.array([t for t, _ in held.values()], pa.int64()),
                          pa.array([c for _, c in held.values()], pa.string())], schema=self.schema)
        for page, at in by_page(np.array([pages[u] for u in held], dtype=np.int64)):
            self.pages.updateValue((page,), (packed(every.take(at)),))


def spend_category_stream(orders: DataFrame) -> DataFrame:
    """Category changes of a stream of orders (``user_id, order_id,
    order_amount, offset``).  Users are folded by buckets."""
    spark = orders.sparkSession
    # The processor travels by value: workers need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    bucket = F.when(F.col("user_id").isNull(), -1).otherwise(key_bucket(spark, ["user_id"]))
    rows = orders.select(bucket.alias(BUCKET), key_page(["user_id"]).alias(PAGE),
                         F.coalesce("user_id", F.lit(0).cast("bigint")).alias("user_id"), "order_id", "order_amount", "offset")
    return rows.groupBy(BUCKET).transformWithStateInPandas(SpendCategoryBuckets(), SPEND_OUTPUT, "Append", "None")


SPEND_STATE = "user_id bigint, total bigint, category string, offset bigint"


def spend_category_batches(spark, state_path: str, out_path: str):
    """The same fold as ``SpendCategoryProcessor`` as a ``foreachBatch``
    function over DataFrames only: per micro-batch, running totals come
    from the chunked prefix scan (no per-key task), and the carry-in is the
    user's last total.  Each batch writes one row per user it met, in its
    own folder (exact on replay); a reader takes the last row per user of
    the batches before it.  What it reads grows with the batches run, so a
    stream without an end keeps its state in ``SpendCategoryProcessor``."""
    from ..operators.scan import latest_per_key, running_sums
    from ..operators.spend import band
    from .sinks import batch_writer, read_batches

    emit, keep = batch_writer(out_path), batch_writer(state_path)

    def each(batch: DataFrame, batch_id: int) -> None:
        prev = latest_per_key(read_batches(spark, state_path, SPEND_STATE, before=batch_id),
                              ["user_id"], "offset", ["total", "category"])
        rt = running_sums(batch, ["user_id"], "offset",
                          {"_bt": "order_amount", "seq": F.lit(1).cast("bigint")})
        p = prev.select("user_id", F.col("total").alias("_pt"), F.col("category").alias("_pc"))
        j = rt.join(p, "user_id", "left").withColumn(
            "total", F.coalesce("_pt", F.lit(0).cast("bigint")) + F.col("_bt"))
        before = F.when(F.col("seq") > 1, band(F.col("total") - F.col("order_amount"))) \
                  .otherwise(F.col("_pc"))
        j = j.withColumn("category", band("total"))
        emit(j.filter(before.isNull() | (before != F.col("category")))
             .select("user_id", "order_id", "offset", "total", "category"), batch_id)
        keep(latest_per_key(j.select("user_id", "total", "category", "offset"), ["user_id"], "offset",
                            ["total", "category", "offset"]), batch_id)

    return each
