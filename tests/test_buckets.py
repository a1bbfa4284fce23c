"""Keyed state by buckets of keys: a group holds many keys, and what it asks
of the state does not grow with Spark's cost of a group."""

import numpy as np
import pandas as pd

from streamfold.streaming import processors, stateful


class Value:
    """A value state that counts its calls."""

    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, v):
        self.calls += 1
        self.value = v

    def clear(self):
        self.update(None)


class Entries(dict):
    """A map state that counts its calls."""
    calls = 0

    def exists(self):
        self.calls += 1
        return bool(self)

    def getValue(self, k):
        self.calls += 1
        return self.get(k)

    def updateValue(self, k, v):
        self.calls += 1
        self[k] = v

    def removeKey(self, k):
        self.calls += 1
        del self[k]


class Handle:
    def __init__(self):
        self.timers, self.states = [], {}

    def registerTimer(self, ms):
        self.timers.append(ms)

    def getValueState(self, name, *schemas):
        return self.states.setdefault(name, Value())

    def getMapState(self, name, *schemas):
        return self.states.setdefault(name, Entries())

    def calls(self):
        return sum(s.calls for s in self.states.values()) + len(self.timers)


class Times:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


HOUR_US = processors.HOUR_MS * 1000


def test_replay_of_a_bucket_of_many_pairs():
    """rows of 1,000 pairs are a piece of the state per span of time and
    micro-batch; each pair is judged by its own blocks, over hours and
    micro-batches, and a pair without a receiver is a pair."""
    handle, p = Handle(), processors.AsOfReplay()
    p.init(handle)
    to = [None if i == 0 else str(i) for i in range(1000)]
    msg, off, on = processors.MESSAGE, processors.UNBLOCK, processors.BLOCK

    def rows(us, ids, kind):
        return pd.DataFrame({"to_user_id": to, "from_user_id": "7", "us": us, "offset": np.arange(1000) + us,
                             "id": np.arange(1000) + ids, "kind": kind, stateful.PAGE: np.arange(1000) % 16})
    half = np.where(np.arange(1000) % 2 == 0, on, off)
    p.handleInputRows((3,), iter([rows(30, 3000, msg), rows(10, 0, msg), rows(20, 0, half)]), None)
    beat = rows(0, 0, processors.BEAT)
    p.handleInputRows((3,), iter([beat, rows(HOUR_US + 5, 5000, msg), rows(40, 4000, msg)]), None)
    assert len(handle.states["rows"]) == 2 and handle.calls() < 10 and handle.timers == [processors.HOUR_MS]

    def judged(ms):
        got = pd.concat([pd.DataFrame(columns=["id"]), *p.handleExpiredTimer((3,), Times(ms), Times(handle.timers[-1]))])
        return {(r.id, r.to_user_id, r.block_state) for r in got.itertuples()}
    first = {(i, to[i], None) for i in range(1000)} | {(n + i, to[i], "unblock") for n in (3000, 4000) for i in range(1, 1000, 2)}
    assert judged(processors.HOUR_MS) == first
    assert handle.timers[-1] == 2 * processors.HOUR_MS and len(handle.states["rows"]) == 1
    assert judged(2 * processors.HOUR_MS) == {(5000 + i, to[i], "unblock") for i in range(1, 1000, 2)}
    assert not handle.states["rows"] and handle.states["spans"].value is None and len(handle.states["last"]) == 16
    p.handleInputRows((3,), iter([rows(2 * HOUR_US, 6000, msg)]), None)
    assert handle.calls() < 100
    assert judged(3 * processors.HOUR_MS) == {(6000 + i, to[i], "unblock") for i in range(1, 1000, 2)}


def test_latest_rows_of_a_bucket():
    """F2: 5,000 keys take a call or two a page and micro-batch; keys of null
    are keys, and long ids keep every digit."""
    import pyarrow as pa
    schema = pa.schema([("t", pa.string()), ("k", pa.int64()), ("lsn", pa.int64()), ("name", pa.string())])
    p, handle = processors.LatestRow(["t", "k"], "lsn", schema, ["k"]), Handle()
    p.init(handle)
    long, n = 1 << 62, 5000
    ids = [None, *[str(long + i) for i in range(1, n)]]

    def rows(lsn, name, some=slice(None)):
        return pd.DataFrame({"t": "a", "k": ids, "lsn": lsn, "name": name, stateful.PAGE: np.arange(n) % 16})[some]

    def table():
        got = [r for cell in handle.states["row"].values() for r in stateful.unpacked(cell[0]).to_pylist()]
        assert len(got) == len({r["k"] for r in got})
        return {r["k"]: (r["lsn"], r["name"]) for r in got}
    p.handleInitialState((0,), rows(5, "one", slice(0, 3000)), None)
    p.handleInitialState((0,), rows(5, "one", slice(3000, n)), None)
    want = {None if i == 0 else long + i: (5, "one") for i in range(n)}
    assert table() == want and handle.calls() == 32
    lsn = np.where(np.arange(n) % 3 == 0, 6, np.where(np.arange(n) % 3 == 1, 5, processors.LEAST))
    p.handleInputRows((0,), iter([rows(4, "older"), rows(lsn, "new"), rows(6, "again")[:1000:3]]), None)
    want.update({None if i == 0 else long + i: (6, "new") for i in range(0, n, 3)})
    assert table() == want and handle.calls() <= 32 + 5 * 16
    ids[4] = "1"
    p.handleInputRows((0,), iter([rows(processors.LEAST, "first")[4:5]]), None)
    assert table() == {**want, 1: (None, "first")}


def test_spend_of_a_bucket_of_users():
    """many users of a group, over micro-batches, against a fold of each;
    a page is read and written once a micro-batch."""
    p, handle, r = stateful.SpendCategoryBuckets(), Handle(), np.random.default_rng(0)
    p.init(handle)
    n = 40_000
    every = pd.DataFrame({"offset": r.permutation(n), "order_id": np.arange(n), "user_id": r.integers(0, 500, n),
                          "order_amount": r.integers(0, 50_000, n)})
    every[stateful.PAGE] = every["user_id"] % 16
    every = every[every["user_id"] != 0]
    first = every[every["offset"] < n // 2]
    parts = [[first.iloc[i::3] for i in range(3)], [every[every["offset"] >= n // 2]]]
    got = pd.concat([f for part in parts for f in p.handleInputRows((1,), iter(part), None)])
    log = every.sort_values("offset")
    log["total"] = log.groupby("user_id")["order_amount"].cumsum()
    log["category"] = stateful._bands(log["total"].to_numpy())
    want = log[log.groupby("user_id")["category"].shift() != log["category"]]
    cols = ["user_id", "order_id", "offset", "total", "category"]
    assert sorted(map(tuple, got[cols].to_numpy())) == sorted(map(tuple, want[cols].to_numpy()))
    assert len(handle.states["spend"]) == 16 and handle.calls() == 2 + 3 * 16


def test_users_share_groups(spark):
    """users are grouped by bucket, and the user without an id is one."""
    df = spark.range(2000).selectExpr("if(id = 0, null, id) AS user_id")
    assert df.select(stateful.key_bucket(spark, ["user_id"])).distinct().count() <= stateful.STATE_BUCKETS
