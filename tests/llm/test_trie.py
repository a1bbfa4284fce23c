"""The conversation trie: against brute force, and its parts."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from streamfold.llm import conversation_trie as ct

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def said(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows, rebuild=True):
    """{(conv_id, depth): the other columns}."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), said(r, x), (r or "", x or "")))
    own = {c: [x for _, _, x in sorted(v)] for c, v in turns.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        full[c] = (own.get(base, [])[:h] if h else []) + v[h:]
    nodes = defaultdict(list)
    for c, v in full.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    kids = defaultdict(list)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + (len(nodes[k]) - 1) * (len(k[-1][1]) if k else 0)
    return {(min(m), len(k)): (min(nodes[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                               hashlib.sha256(",".join(map(str, sorted(c for c in m if len(full[c]) == len(k)))).encode()).hexdigest())
            for k, m in nodes.items()}


def run(df, rebuild=True, **how):
    got = ct.conversation_trie(df, rebuild=ct.with_shared_heads if rebuild else ct.as_they_are, **how).collect()
    out = {(r.conv_id, r.depth): tuple(r)[2:] for r in got}
    assert len(out) == len(got)
    return out


def test_rolled_up_on_any_tree():
    r = random.Random(2)
    shapes = [lambda i: i - 1, lambda i: 0, lambda i: r.randrange(i), lambda i: max(0, i - r.randint(1, 3)), lambda i: (i - 1) // 2]
    for shape in shapes:
        for n in (1, 2, 3, 50, 3000):
            parent = [-1] + [shape(i) for i in range(1, n)]
            vals = [[r.randint(0, 9) for _ in range(n)] for _ in range(2)]
            want, sub = [list(v) for v in vals], [1] * n
            for i in range(n - 1, 0, -1):
                sub[parent[i]] += sub[i]
                for w in want:
                    w[parent[i]] += w[i]
            assert ct.rolled_up(parent, sub, vals) == want


def test_against_brute_force(spark):
    r = random.Random(5)
    rows = []
    for c in [*range(0, 60), *range(95, 130), 200, -100, -7, 1 << 62]:
        for t in range(r.randint(1, 7)):
            rows.append((c, t * 3, r.choice(["user", "assistant"]), r.choice(["a", "bb", "ccc é", "", None])))
    rows += [(5, None, "user", "first"), (5, None, None, None), (7, 0, "user", "a"), (7, 0, "user", "a"), (None, 0, "user", "a"),
             (1003, 0, "user", "absent base"), (300, 0, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).select("*", *[F.lit("x").alias(c) for c in ("o", "d", "key", "to", "sub")])
    want = brute(rows)
    assert run(df) == want
    assert run(df, component=5) == want                # split by joins, round after round
    assert run(df, rebuild=False, component=8) == brute(rows, False)


def test_long_and_wide(spark, monkeypatch):
    """One conversation of many turns, many copies of one, many first turns."""
    monkeypatch.setattr(ct, "SPAN", 16)
    rows = [(1, t, "user", f"t{t}") for t in range(200)]
    rows += [(c, t, "user", f"t{t}" if t < 100 else f"u{t}") for c in (2, 3) for t in range(120)]
    rows += [(c, 0, "user", "copy") for c in range(2000, 3100)] + [(c, 0, "user", f"only {c}") for c in range(5000, 5200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = run(df, rebuild=False, component=32)
    assert got == brute(rows, False)
    assert got[1, 0][1:4] == (3 + 1100 + 200, 202, 203) and got[2000, 1][1] == 1100


def test_rounds_halve(spark, monkeypatch):
    """Components shrink to half at least in each round of joins."""
    rows = [(1, t, "user", f"t{t}") for t in range(64)]
    nodes, paths, root = ct.named(ct.as_they_are(ct.positions(ct.turn_rows(spark.createDataFrame(rows, SCHEMA)))))
    sizes, split = [], ct.split_round

    def watched(active, *a):
        got = split(active, *a)
        if got:
            sizes.append(max(r["count"] for r in got[2].groupBy("to", "td").count().collect()))
        return got
    monkeypatch.setattr(ct, "split_round", watched)
    sums = {(r.o, r.d): r.leaves for r in ct.subtree_sums(nodes, paths, root, component=8).collect()}
    assert sums == {(1, d): 1 for d in range(65)} and sizes == [32, 16, 8]


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "a")]])
def test_empty(spark, rows):
    assert ct.conversation_trie(spark.createDataFrame(rows, SCHEMA), rebuild=ct.with_shared_heads).count() == 0


def test_turnless(spark):
    """Conversations whose turns all go are members of the root."""
    convs = [c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 2][:5]
    rows = [(c, 0, "user", f"t{c}") for c in convs]
    got = run(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and set(got) == {(convs[0], 0)} and got[convs[0], 0][1:5] == (5, 0, 1, 0)
