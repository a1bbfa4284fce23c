"""Keyed processors over Spark's state variables.

* ``latest_from_snapshot`` (SRC-11, CDC-06): a table that starts as a
  snapshot, given as the initial state, and follows its changes;
* ``block_changes`` (AGG-04, STR-03): a user's blocked ids as a map state,
  one entry per id, and a row per event that alters the set;
* ``replay_asof`` (JOIN-04, STR-05): messages wait in event time until the
  watermark has passed, and are judged by the blocks of their own time;
* ``scrape_windows`` (MET-06): windows of each series that are final once the
  series' own time is a delay past them, and what came too late, as it came.

Processors travel by value; workers need not have this package.  A key's
rows may come in several frames and in any order within a micro-batch.
Where keys are as many as records, a group is a bucket of keys
(``stateful.key_bucket``): Spark's cost of a group is milliseconds, that of
a key in it a row of a state entry.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.timefmt import epoch_micros
from . import stateful
from .state import read_variable
from .stateful import BUCKET, PAGE, by_page, key_bucket, key_page, merged_runs, packed, unpacked

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ready(spark: SparkSession) -> None:
    for module in (sys.modules[__name__], stateful):
        cloudpickle.register_pickle_by_value(module)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


# ---- a snapshot, then its changes ------------------------------------------------

LEAST = -(1 << 63)              # order of a row that has none


class LatestRow(StatefulProcessor):
    """The row with the greatest order per key, for a bucket of keys in
    pages.  An equal order does not replace: a replayed change alters
    nothing, and a change as old as the snapshot or older is part of it.
    Changes are reduced frame by frame; a page that they alter is read and
    written once a micro-batch.  The snapshot, which has a key once, comes
    before all changes: its frames are pieces of the pages, as they are."""

    def __init__(self, keys: list[str], order: str, schema: pa.Schema, whole: list[str]) -> None:
        self.keys, self.order, self.schema, self.whole = keys, order, schema, whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getMapState("row", "page int, piece int", "rows binary")
        self.bucket, self.pieces = None, {}

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if key != self.bucket:
            self.bucket, self.pieces = key, {}
        rows = self._arrow(initialState)
        for page, at in by_page(initialState[PAGE].to_numpy(dtype=np.int64)):
            n = self.pieces.get(page, 0)
            self.pages.updateValue((page, n), (packed(rows.take(at)),))
            self.pieces[page] = n + 1

    def handleInputRows(self, key, rows, timerValues):
        changes, pages = [], []
        for frame in rows:
            table = self._arrow(frame)
            at = self._latest(table)
            changes.append(table.take(at))
            pages.append(frame[PAGE].to_numpy(dtype=np.int64)[at])
        every = pa.concat_tables(changes)
        for page, at in by_page(np.concatenate(pages)):
            held = self._held(page)
            n = sum(map(len, held))
            table = pa.concat_tables([*held, every.take(at)])
            best = self._latest(table)
            if (best >= n).any():
                self.pages.updateValue((page, 0), (packed(table.take(best)),))
                for i in range(1, len(held)):
                    self.pages.removeKey((page, i))
        return iter(())

    def _held(self, page: int) -> list[pa.Table]:
        held = []
        while (cell := self.pages.getValue((page, len(held)))) is not None:
            held.append(unpacked(cell[0]))
        return held

    def _arrow(self, frame: pd.DataFrame) -> pa.Table:
        return pa.table([self._column(frame[f.name], f) for f in self.schema], schema=self.schema)

    def _column(self, cells: pd.Series, field: pa.Field) -> pa.Array:
        if field.name == self.order:
            order = cells.to_numpy(dtype=np.int64)
            return pa.array(order, mask=order == LEAST)
        if field.name in self.whole:
            return pa.array(cells, pa.string(), from_pandas=True).cast(field.type)
        return pa.array(cells, field.type, from_pandas=True)

    def _latest(self, table: pa.Table) -> np.ndarray:
        """Each key's row of the greatest order, the first of equal ones."""
        keys = pd.DataFrame({k: table[k].cast(pa.string()).to_pandas() for k in self.keys})
        key = keys.groupby(self.keys, dropna=False, sort=False).ngroup().to_numpy()
        at = np.lexsort((-np.arange(len(key)), table[self.order].fill_null(LEAST).to_numpy(), key))
        return np.sort(at[np.append(np.diff(key[at]) != 0, True)])

    def close(self) -> None:
        pass


def latest_from_snapshot(snapshot: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The table of ``snapshot`` and a stream of ``changes``, which have the
    same columns, kept in Spark's state (run it with ``outputMode("update")``,
    read it with ``read_snapshot_table``).  The snapshot is the state that
    the first micro-batch starts from; it is not sent through the stream.
    ``order`` is a bigint; rows without one come before all others."""
    spark = changes.sparkSession
    _ready(spark)
    schema = to_arrow_schema(changes.schema)
    # pandas has no integers beside nulls: they go as text, the order without nulls.
    whole = [f.name for f in schema if pa.types.is_integer(f.type) and f.name != order]

    def bucketed(rows: DataFrame) -> DataFrame:
        cells = [F.col(c).cast("string").alias(c) if c in whole else F.col(c) for c in changes.columns if c != order]
        return rows.select(key_bucket(spark, keys).alias(BUCKET), key_page(keys).alias(PAGE), *cells,
                           F.coalesce(order, F.lit(LEAST)).alias(order))
    first = bucketed(snapshot)
    row = F.max_by(F.struct(*[c for c in first.columns if c not in keys]), order).alias("_sf_row")
    once = first.groupBy(*keys).agg(row).select(*keys, "_sf_row.*").select(*first.columns)
    return bucketed(changes).groupBy(BUCKET).transformWithStateInPandas(
        LatestRow(keys, order, schema, whole), "done boolean", "Update", "None", initialState=once.groupBy(BUCKET))


def read_snapshot_table(spark: SparkSession, checkpoint: str, snapshot: DataFrame, columns: list[str]) -> DataFrame:
    """The table as of the last committed micro-batch; the snapshot itself
    while no change has come."""
    state = read_variable(spark, checkpoint, "row")
    table = snapshot.select(*columns)
    if state is None:
        return table
    _ready(spark)

    def rows(batches):
        for batch in batches:
            for cell in batch.column(0):
                yield from unpacked(cell.as_py()).select(columns).to_batches()
    return state.select("user_map_value.rows").mapInArrow(rows, table.schema)


# ---- blocked ids as a map ----------------------------------------------------------

CHANGE_OUTPUT = "user_id string, blocked_id string, offset bigint, change string"


class BlockSet(StatefulProcessor):
    """The ids a user blocks, one map entry each, and the changes of the set."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.blocked = handle.getMapState("blocked", "blocked_id string", "offset bigint")

    def handleInputRows(self, key, rows, timerValues):
        # Frames are let go as they come; the state is asked once per id of a
        # piece, never for the whole set.
        runs = []
        for f in rows:
            at = np.argsort(f["offset"].to_numpy(dtype=np.int64), kind="stable")
            runs.append((f["offset"].to_numpy(dtype=np.int64)[at], f["blocked_id"].to_numpy(dtype=object)[at],
                         (f["action"] == "block").to_numpy()[at]))
        for offsets, ids, adds in merged_runs(runs):
            order = np.argsort(ids.astype(str), kind="stable")
            offsets, ids, adds = offsets[order], ids[order], adds[order]
            starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            held = np.array([self.blocked.containsKey((ids[i],)) for i in starts], dtype=bool)
            before = np.concatenate(([False], adds[:-1]))
            before[starts] = held
            alters = adds != before
            ends = np.append(starts[1:], len(ids)) - 1
            for i, was in zip(ends, held):
                if adds[i] and not was:
                    self.blocked.updateValue((ids[i],), (int(offsets[i]),))
                elif was and not adds[i]:
                    self.blocked.removeKey((ids[i],))
            if alters.any():
                yield pd.DataFrame({"user_id": np.full(int(alters.sum()), key[0], dtype=object), "blocked_id": ids[alters],
                                    "offset": offsets[alters], "change": np.where(adds[alters], "added", "removed")})

    def close(self) -> None:
        pass


def block_changes(parsed: DataFrame) -> DataFrame:
    """A row per block event that alters its user's set; ``parsed`` has
    user_id, blocked_id, offset and action."""
    _ready(parsed.sparkSession)
    return parsed.select("user_id", "blocked_id", "offset", "action").groupBy("user_id").transformWithStateInPandas(
        BlockSet(), CHANGE_OUTPUT, "Append", "None")


def read_block_sets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(user_id, blocked_id) of every current block, from the map state."""
    state = read_variable(spark, checkpoint, "blocked")
    if state is None:
        return spark.createDataFrame([], "user_id string, blocked_id string")
    return state.select("key.user_id", F.col("user_map_key.blocked_id").alias("blocked_id"))


# ---- as-of replay in event time ------------------------------------------------------

REPLAY_PAIR, REPLAY_NUMBERS = ["to_user_id", "from_user_id"], ["us", "offset", "id", "kind", PAGE]
REPLAY_INPUT = ["to_user_id", "from_user_id", "ts", "us", "offset", "id", "kind"]
UNBLOCK, BLOCK, MESSAGE, BEAT = 0, 1, -1, 2          # kinds of rows
REPLAY_OUTPUT = "id bigint, from_user_id string, to_user_id string, us bigint, block_state string"
HOUR_MS = 3_600_000
SPAN_MS = 24 * HOUR_MS          # time of one piece of the state
JUDGED_ROWS = 1 << 16           # rows of a bucket that are put in order at a time, and a span more


class AsOfReplay(StatefulProcessor):
    """Blocks and messages of a bucket of (receiver, sender) pairs, held
    until the watermark has passed their hour; then they are put in order and
    the messages are judged, some ``JUDGED_ROWS`` rows at a time.  Every
    state access is a call to the state server, so there are few: a piece of
    Arrow rows per span of time and micro-batch goes in and comes out once
    (that in which the watermark stands goes back), and the last actions of
    the pairs are pages."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getValueState("spans", "span array<bigint>, pieces array<int>, hour array<bigint>")
        self.rows = handle.getMapState("rows", "span bigint, piece int", "rows binary")
        self.last = handle.getMapState("last", "page int", "pairs binary")

    def handleInputRows(self, key, rows, timerValues):
        spans = self._spans()
        first = min((h for _, h in spans.values()), default=None)
        batches, n = [], 0
        for frame in rows:
            frame = frame[frame["kind"] != BEAT]
            if len(frame):
                numbers = [pa.array(frame[c].to_numpy(dtype=np.int64)) for c in REPLAY_NUMBERS]
                pair = [pa.array(frame[c], pa.string(), from_pandas=True) for c in REPLAY_PAIR]
                batches.append(pa.table([*pair, *numbers], names=[*REPLAY_PAIR, *REPLAY_NUMBERS]))
                n += len(frame)
            if n >= JUDGED_ROWS:
                self._hold(pa.concat_tables(batches), spans)
                batches, n = [], 0
        if batches:
            self._hold(pa.concat_tables(batches), spans)
        self._wait(spans, first)
        return iter(())

    def _spans(self) -> dict[int, tuple[int, int]]:
        """Per span its pieces and the first hour of its rows."""
        held = self.spans.get()
        return {s: (n, h) for s, n, h in zip(*held)} if held is not None else {}

    def _wait(self, spans: dict[int, tuple[int, int]], first: int | None = None) -> None:
        """Keep ``spans`` and wake when their first hour has passed, unless
        a timer waits for ``first``, no later hour."""
        if not spans:
            return self.spans.clear()
        self.spans.update((list(spans), [n for n, _ in spans.values()], [h for _, h in spans.values()]))
        least = min(h for _, h in spans.values())
        if first is None or least < first:
            self.handle.registerTimer((least + 1) * HOUR_MS)

    def _hold(self, table: pa.Table, spans: dict[int, tuple[int, int]]) -> None:
        us = table["us"].to_numpy()
        for s, at in by_page(us // (SPAN_MS * 1000)):
            n, hour = spans.get(s, (0, None))
            least = int(us[at].min() // (HOUR_MS * 1000))
            self.rows.updateValue((s, n), (packed(table.take(at)),))
            spans[s] = (n + 1, least if hour is None else min(hour, least))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        spans = self._spans()
        upto = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) // HOUR_MS      # hours below are over
        over = sorted(s for s, (_, hour) in spans.items() if hour < upto)
        if not over:
            return
        stored, last, waiting, batches, n = {}, {}, None, [], 0
        for s in over:
            for i in range(spans.pop(s)[0]):
                piece = unpacked(self.rows.getValue((s, i))[0])
                self.rows.removeKey((s, i))
                done = piece["us"].to_numpy() // (HOUR_MS * 1000) < upto
                if not done.all():
                    waiting = piece.filter(~done) if waiting is None else pa.concat_tables([waiting, piece.filter(~done)])
                batches.append(piece.filter(done))
                n += len(batches[-1])
            if n >= JUDGED_ROWS or s == over[-1]:
                judged = self._judged(pa.concat_tables(batches), stored, last)
                if len(judged):
                    yield judged
                batches, n = [], 0
        for page, kinds in last.items():
            if kinds != stored[page]:
                names = [[p[i] for p in kinds] for i in (0, 1)]
                self.last.updateValue((page,), (packed(pa.table([*[pa.array(x, pa.string()) for x in names], pa.array(kinds.values(), pa.int64())],
                                                                names=[*REPLAY_PAIR, "kind"])),))
        if waiting is not None:
            self._hold(waiting, spans)
        self._wait(spans)

    def _page(self, page: int) -> dict[tuple, int]:
        """The last action of each pair of a page."""
        cell = self.last.getValue((page,))
        if cell is None:
            return {}
        to, sender, kind = (c.to_pylist() for c in unpacked(cell[0]).columns)
        return dict(zip(zip(to, sender), kind))

    def _judged(self, table: pa.Table, stored: dict, last: dict) -> pd.DataFrame:
        """The delivered messages of whole hours; ``last`` goes on, page by page."""
        to, to_ids = pd.factorize(table["to_user_id"].to_pandas(), use_na_sentinel=False)
        sender, sender_ids = pd.factorize(table["from_user_id"].to_pandas(), use_na_sentinel=False)
        to_ids, sender_ids = (np.where(pd.isna(u), None, u) for u in (np.asarray(to_ids, object), np.asarray(sender_ids, object)))
        us, offset, ids, kind, page = (table[c].to_numpy() for c in REPLAY_NUMBERS)
        order = np.lexsort((offset, us, sender, to))
        to, sender, us, ids, kind = to[order], sender[order], us[order], ids[order], kind[order]
        starts = np.flatnonzero(np.concatenate(([True], (to[1:] != to[:-1]) | (sender[1:] != sender[:-1]))))
        pairs = list(zip(to_ids[to[starts]].tolist(), sender_ids[sender[starts]].tolist()))
        pages = page[order][starts].tolist()
        for p in set(pages) - set(last):
            stored[p] = self._page(p)
            last[p] = dict(stored[p])
        sizes = np.diff(np.append(starts, len(kind)))
        carry = np.repeat(np.array([last[p].get(pair, MESSAGE) for p, pair in zip(pages, pairs)], dtype=np.int64), sizes)
        at = np.maximum.accumulate(np.where(kind == MESSAGE, -1, np.arange(len(kind))))
        state = np.where(at >= np.repeat(starts, sizes), kind[at], carry)     # the last action before each
        for p, pair, k in zip(pages, pairs, state[starts + sizes - 1].tolist()):
            if k != MESSAGE:
                last[p][pair] = k
        kept = (kind == MESSAGE) & (state != BLOCK)
        return pd.DataFrame({"id": ids[kept], "from_user_id": sender_ids[sender[kept]], "to_user_id": to_ids[to[kept]],
                             "us": us[kept], "block_state": np.where(state[kept] == UNBLOCK, "unblock", None)})

    def close(self) -> None:
        pass


def replay_rows(messages: DataFrame, block_events: DataFrame) -> DataFrame:
    """Both inputs of the replay as one: messages have id, from_user_id,
    to_user_id, ts and offset, block events user_id, blocked_id, action, ts
    and offset; ``ts`` is a timestamp of an instant."""
    us = epoch_micros("ts")
    ms = messages.select("to_user_id", "from_user_id", "ts", us.alias("us"), "offset", "id", F.lit(MESSAGE).alias("kind"))
    ev = block_events.select(F.col("user_id").alias("to_user_id"), F.col("blocked_id").alias("from_user_id"), "ts", us.alias("us"), "offset",
                             F.lit(0).cast("bigint").alias("id"), F.when(F.col("action") == "block", BLOCK).otherwise(UNBLOCK).alias("kind"))
    return ms.unionByName(ev)


def heartbeat(spark: SparkSession, path: str, ts: str) -> None:
    """An empty record that carries the stream's time to ``ts``: with it the
    last hours of a log that has ended are judged."""
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    (spark.range(1).select(none.alias("to_user_id"), none.alias("from_user_id"), F.to_timestamp(F.lit(ts)).alias("ts"),
                           zero.alias("us"), zero.alias("offset"), F.col("id"), F.lit(BEAT).alias("kind"))
     .coalesce(1).write.mode("append").parquet(path))


def no_beats(spark: SparkSession, path: str) -> None:
    """An empty folder of heartbeats."""
    spark.createDataFrame([], REPLAY_SCHEMA).write.mode("append").parquet(path)


REPLAY_SCHEMA = "to_user_id string, from_user_id string, ts timestamp, us bigint, offset bigint, id bigint, kind int"


def replay_asof(rows: DataFrame, beats: DataFrame, delay: str) -> DataFrame:
    """The delivered messages of ``replay_rows``, once the stream's time is
    ``delay`` past them: what comes later than that is late, and Spark
    counts it (``numRowsDroppedByWatermark``).  ``beats`` are heartbeats."""
    _ready(rows.sparkSession)
    timed = rows.select(*REPLAY_INPUT).unionByName(beats.select(*REPLAY_INPUT)).withWatermark("ts", delay)
    # Heartbeats go on to the processor: a filter would drop them before the watermark.
    return (timed.withColumns({BUCKET: key_bucket(rows.sparkSession, REPLAY_PAIR), PAGE: key_page(REPLAY_PAIR)}).groupBy(BUCKET)
            .transformWithStateInPandas(AsOfReplay(), REPLAY_OUTPUT, "Append", "EventTime"))


# ---- windows of a series, and what comes too late -------------------------------------

SCRAPE_KEYS = ["name", "connector", "task", "client_id"]
SCRAPE_OUTPUT = ("name string, connector string, task string, client_id string, output string, slot bigint, us bigint, "
                 "sample_id bigint, value double, n_samples bigint")
WINDOW, LATE = "window", "late"


class ScrapeWindows(StatefulProcessor):
    """The last sample and the number of samples of each window of a series.

    A series has a time of its own, its greatest sample time.  A window whose
    end lies ``delay`` before it is final: it is given out once and
    forgotten.  A sample of a window that was final before its micro-batch is
    late and is given out as it is, so windows and late samples together
    hold every sample.  Open windows, at most delay by interval of them, are
    the state; samples are folded in time order, piece by piece."""

    def __init__(self, interval_us: int, delay_us: int) -> None:
        self.interval, self.delay = interval_us, delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "slot bigint", "us bigint, sample_id bigint, value double, n_samples bigint")
        self.clock = handle.getValueState("clock", "us bigint")

    def handleInputRows(self, key, rows, timerValues):
        runs = []
        for f in rows:
            us, ids = f["us"].to_numpy(dtype=np.int64), f["sample_id"].to_numpy(dtype=np.int64)
            at = np.lexsort((ids, us))
            runs.append((us[at], ids[at], f["value"].to_numpy(dtype=np.float64)[at]))
        stored = self.clock.get()
        clock = int(stored[0]) if stored is not None else None
        closed = None if clock is None else clock - self.delay              # windows that ended by then are final
        stateful_open = {int(k[0]): tuple(v) for k, v in self.open.iterator()}
        held = dict(stateful_open)
        for us, ids, values in merged_runs(runs):
            at = np.lexsort((ids, us))
            us, ids, values = us[at], ids[at], values[at]
            slot = us // self.interval
            if closed is not None:
                late = (slot + 1) * self.interval <= closed
                if late.any():
                    yield self._rows(key, LATE, slot[late], us[late], ids[late], values[late], np.ones(int(late.sum()), np.int64))
                    us, ids, values, slot = us[~late], ids[~late], values[~late], slot[~late]
            if not len(us):
                continue
            ends = np.flatnonzero(np.append(slot[1:] != slot[:-1], True))
            counts = np.diff(np.concatenate(([-1], ends)))
            for i, n in zip(ends.tolist(), counts.tolist()):
                s, now = int(slot[i]), (int(us[i]), int(ids[i]), float(values[i]))
                old = held.get(s)
                held[s] = (*(max(now, old[:3], key=lambda r: r[:2]) if old else now), n + (old[3] if old else 0))
            clock = int(us[-1]) if clock is None else max(clock, int(us[-1]))
            done = sorted(s for s in held if (s + 1) * self.interval <= clock - self.delay)
            if done:
                cols = [np.array(c) for c in zip(*(held.pop(s) for s in done))]
                yield self._rows(key, WINDOW, np.array(done, np.int64), *cols)
        for s, was in stateful_open.items():
            if s not in held:
                self.open.removeKey((s,))
        for s, row in held.items():
            if stateful_open.get(s) != row:
                self.open.updateValue((s,), row)
        if clock is not None and (stored is None or clock != stored[0]):
            self.clock.update((clock,))

    @staticmethod
    def _rows(key, output: str, slot, us, ids, values, n) -> pd.DataFrame:
        size = len(slot)
        out = {k: np.full(size, v, dtype=object) for k, v in zip(SCRAPE_KEYS, key)}
        return pd.DataFrame({**out, "output": np.full(size, output, dtype=object), "slot": slot, "us": us, "sample_id": ids,
                             "value": values.astype(np.float64), "n_samples": n})

    def close(self) -> None:
        pass


def scrape_windows(renamed: DataFrame, interval_s: int, delay_s: int) -> DataFrame:
    """Final windows and late samples of renamed samples (``name``, the
    labels, sample_id, ts, value), marked by ``output``."""
    _ready(renamed.sparkSession)
    rows = renamed.select(*SCRAPE_KEYS, epoch_micros("ts").alias("us"), "sample_id", "value")
    return rows.groupBy(*SCRAPE_KEYS).transformWithStateInPandas(
        ScrapeWindows(interval_s * 1_000_000, delay_s * 1_000_000), SCRAPE_OUTPUT, "Append", "None")


def read_open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that are not final yet, from the map state."""
    cols = "name string, connector string, task string, client_id string, slot bigint, us bigint, sample_id bigint, value double, n_samples bigint"
    state = read_variable(spark, checkpoint, "open")
    if state is None:
        return spark.createDataFrame([], cols)
    return state.select("key.*", "user_map_key.slot", "user_map_value.*")
