"""Substring dedup by automata: against brute force, and its parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamfold.llm import automaton_dedup as ad
from streamfold.llm import words
from tests.llm.test_edges import CLASH, ROWS, loose_orders

NOISE = [f"w{i}" for i in range(40)]


def brute(rows, k=ad.WINDOW):
    """{doc: (words, removed, kept text)}; every row is a document."""
    first, out = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        ws = (t or "").encode().split()
        for i in range(len(ws) - k + 1):
            first.setdefault(tuple(ws[i:i + k]), d)
    for d, t in rows:
        ws = (t or "").encode().split()
        gone = [False] * len(ws)
        for i in range(len(ws) - k + 1):
            if first[tuple(ws[i:i + k])] < d:
                gone[i:i + k] = [True] * k
        out[d] = (len(ws), sum(gone), b" ".join(w for w, g in zip(ws, gone) if not g).decode())
    return out


def made(n, seed=1):
    """Documents cut from shared passages of few words, so that passages
    overlap, repeat inside a document, and differ in single words."""
    r = random.Random(seed)
    passages = [[r.choice(NOISE) for _ in range(r.randint(8, 40))] for _ in range(12)]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(r.randint(0, 5)):
            p = list(r.choice(passages))
            if p and r.random() < .5:
                p[r.randrange(len(p))] = f"x{r.randrange(5)}"
            ws += p + [r.choice(NOISE) for _ in range(r.randint(0, 6))]
        rows.append((i, "".join(w + r.choice([" ", "  ", "\n", "\t", "\r\n"]) for w in ws)))
    return rows


def test_automaton_is_exact():
    r = random.Random(3)
    for trial in range(30):
        texts = [[r.choice("ab" if trial % 2 else "abcdef") for _ in range(r.randint(1, 40))] for _ in range(12)]
        auto = ad.Automaton()
        for d, t in enumerate(texts):
            auto.add(t, 100 - d)
        auto.settle()
        for k in (1, 3, 7):
            for t in [*texts, [r.choice("abcdefg") for _ in range(60)]]:
                want = [min([100 - d for d, u in enumerate(texts) for i in range(len(u) - k + 1) if u[i:i + k] == t[j:j + k]],
                            default=ad.LAST) for j in range(len(t) - k + 1)]
                assert auto.firsts(t, k) == want


def test_word_hashes_do_not_depend_on_the_cut():
    texts = [b"a bb  ccc " + b"y" * 300 + b" a\tbb " + "é ü a".encode(), b"", b" ", b"a"]
    by_cut = []
    for cut in (64, 1000, 1 << 20):
        got = {}
        for t in texts:
            s, e = words.word_bounds(t)
            for a, z, h in zip(s, e, ad.word_hashes(t, s, e, cut).tolist()):
                if z - a <= 64:
                    assert got.setdefault(t[a:z], h) == h
        by_cut.append(got)
    assert by_cut[0] == by_cut[1] == by_cut[2] and len(set(by_cut[0].values())) == len(by_cut[0])


def test_equal_windows_share_an_anchor():
    rows = made(40)
    batch = ad.Batch([t.encode() for _, t in rows])
    own, first, last, h = batch.anchors()
    seen, n = {}, 0
    for a, z, k in zip(first.tolist(), last.tolist(), h.tolist()):
        for w in range(a, z + 1):
            n += 1
            assert seen.setdefault(batch.passage(w, w), k) == k
    count = np.bincount(batch.doc, minlength=len(rows))
    assert n == sum(max(0, c - ad.WINDOW + 1) for c in count.tolist())


@pytest.mark.parametrize("hot,shard_rows", [(ad.HOT, ad.SHARD_ROWS), (3, 5)])
def test_against_brute_force(spark, hot, shard_rows):
    rows = made(150)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n, sum(s.end - s.start for s in r.spans), r.kept) for r in
           ad.dedup_passages(df, hot=hot, shard_rows=shard_rows).join(df, "doc_id").select(
               "doc_id", F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("n"), "spans", "kept").collect()}
    want = brute(rows)
    assert got == want and sum(w[1] for w in want.values()) > 1000


def test_edges(spark):
    rows = [(*r, None) for r in ROWS]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").select(
        "*", *[F.lit("x").alias(c) for c in [*CLASH, "start", "seg", "digest", "shard"]])
    got = ad.dedup_passages(df).collect()
    assert len(got) == len(ROWS)
    have = {r.doc_id: r.kept for r in got if r.doc_id is not None}
    assert have == {d: w[2] for d, w in brute([r[:2] for r in ROWS if r[0] is not None]).items()}
    assert have[10] != "" and have[11] == ""           # the long text, whole, but for its new end
    assert ad.dedup_passages(df.limit(0)).count() == 0
    digests = ad.dedup_passages(df, digests=True)
    assert digests.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(r.n_words for r in digests.collect() if r.doc_id is None) == [0, 16]


def test_rows_without_id(spark):
    said = " ".join(NOISE[:20])
    rows = [(None, t) for t in (None, said, f"one {said}", f"other {said} and more")] + [(3, f"{said} too"), (5, "")]
    got = ad.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    have = ({r.doc_id: r.kept for r in got if r.doc_id is not None}, sorted(r.kept for r in got if r.doc_id is None))
    assert have in loose_orders(rows, lambda rs: {d: w[2] for d, w in brute(rs).items()})


def test_hot_passage_is_one_row_of_its_shard(spark):
    """A passage of all documents folds before its shard sees it."""
    said = " ".join(NOISE[:30])
    df = spark.createDataFrame([(i, f"{said} end{i}") for i in range(300)], "doc bigint, text string")
    marked = df.join(ad.repeated_anchors(df, 1 << 30), "doc")
    every, found = ad.passages(marked, False), ad.passages(marked, True)
    assert every.count() >= 300 and every.groupBy("d1", "d2").count().filter("count = 300").count() > 0
    parts = marked.rdd.getNumPartitions()
    assert max(r["count"] for r in found.groupBy("seg").count().collect()) <= parts
    assert ad.first_documents(found, 1).count() <= found.groupBy("route", "seg").count().count()
    assert {r.kept for r in ad.dedup_passages(df.withColumnRenamed("doc", "doc_id")).filter("doc_id > 0").collect()} == {
        f"end{i}" for i in range(1, 300)}
