"""op6: the pivots eliminate, the bound holds, and blocks change nothing."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from streamfold.llm import topk

SF = "/root/testdata/sf0.1"


def pivot_table(spark, vecs):
    return topk.with_distances(vecs, topk.pick_pivots(vecs)).withColumn("qh", F.xxhash64("vec")).toPandas()


def test_at_most_a_third_is_scored(spark):
    rows = pivot_table(spark, topk.vectors(spark.read.parquet(f"{SF}/embeddings.parquet"), "vec_id", "embedding"))
    queries = rows[rows["id"] % 100 == 0]
    got, scored = topk.search_block(rows, queries, 10)
    share = scored / (len(queries) * (len(rows) - 1))
    assert len(got) == 10 * len(queries) and share <= 1 / 3, share
    x = np.stack([np.frombuffer(v, "<f8") for v in rows["vec"]])
    for qid, own in pd.DataFrame(got, columns=["q", "h", "id", "score"]).groupby("q"):
        s = x @ x[np.flatnonzero(rows["id"] == qid)[0]]
        s[rows["id"] == qid] = -np.inf
        assert own["score"].tolist() == sorted(s.astype(np.float64), reverse=True)[:10]
    # From a k-th score that another block gave, fewer still.
    least = pd.DataFrame(got, columns=["q", "h", "id", "score"]).groupby("q")["score"].min()
    again, fewer = topk.search_block(rows, queries.assign(least=queries["id"].map(least).astype(float)), 10)
    assert sorted(again) == sorted(got) and fewer <= scored


@pytest.mark.parametrize("dim,rank", [(1, 1), (8, 8), (16, 3), (64, 64)])
def test_bound_is_never_under_a_score(dim, rank):
    r = np.random.default_rng(dim)
    x = np.floor(1024 * r.normal(size=(300, rank)) @ r.normal(size=(rank, dim)) * 10 ** r.uniform(-3, 3, size=(300, 1)))
    basis = topk.span_of(x, max(1, round(topk.PIVOT_SHARE * dim)))
    assert np.allclose(basis @ basis.T, np.eye(len(basis)), atol=1e-9)
    c = x @ basis.T
    res = np.sqrt(np.maximum(0, (x * x).sum(1) - (c * c).sum(1)))
    norm = np.linalg.norm(x, axis=1)
    bound = c @ c.T + np.outer(res, res) + 1e-9 * np.outer(norm, norm) + 1
    assert (bound >= x @ x.T).all()


def test_blocks_change_nothing(spark):
    df = spark.range(500).select(F.col("id").alias("vec_id"), F.array(*[
        ((F.xxhash64("id", F.lit(j)) % 1000) / 500).cast("float") for j in range(12)]).alias("embedding"))
    want = {tuple(r) for r in topk.top_k(df, F.col("id") % 50 == 0).collect()}
    got = topk.top_k(df, F.col("id") % 50 == 0, block=60, query_block=3, pivots=5).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) == 100
    long = spark.createDataFrame([(0, [0.5] * 20_000), (1, [0.25] * 20_000), (50, [1.0] * 20_000), (2, [0.0] * 20_000)],
                                 "vec_id bigint, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in topk.top_k(long, F.col("id") % 50 == 0, k=1).orderBy("query_id").collect()] == [(0, 50), (50, 0)]
