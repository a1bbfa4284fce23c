"""Exact top-k inner-product search by pivot-table elimination (operator 6).

Vectors become integers, ``floor(1024 * x)``.  Pivots are vectors of the
table, each the farthest from the span of those before it, seven for every
eight dimensions.  A vector's distances to all pivots fix its coordinates in
their span and its distance from the span, and the pivot table keeps them in
this form, once per vector.  Of the lower bounds that the distances give,
the largest is ``d(q, x)^2 >= |c(q) - c(x)|^2 + (r(q) - r(x))^2``, with c the
coordinates and r the distance from the span: no single pivot's
``|d(q, p) - d(x, p)|`` is larger.  As ``2 q.x = |q|^2 + |x|^2 - d^2``, it
bounds a score from above.  Candidates are scored in the order of their
bounds until the k-th best score exceeds the next bound: exact, however
good the pivots are.

Queries meet candidates block by block: vectors are dealt by hash into
blocks of about ``BLOCK`` and ``QUERY_BLOCK``, and each pair of blocks is one
group of bounded size.  A first pass over one block per query gives it a
k-th score, below which no other block scores anything.  The k best of each
pair are ranked again per query.  The pivots, picked from a sample of
``PIVOT_SAMPLE`` vectors, are all that goes through the driver.

Defined results: vectors that are null, or hold a null or non-finite
component, and rows without an id take no part; vectors of another length
than the query's are no candidates; a query's own row is every row with its
id; other repeated rows count each; ties go to the smaller id; scores
outside 64 bits end at the nearest 64-bit number; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, ship, stored

SCALE = 1024.0
PIVOT_SHARE = 0.875        # pivots per dimension
PIVOT_SAMPLE = 1024
SPREAD = 1e-2              # least distance of a pivot from the span of the others, of the farthest's
BLOCK = 4096
QUERY_BLOCK = 4096
STEP = 32                  # candidates scored between two looks at the bounds
EXACT = float(1 << 53)


def quantised(batch: pa.RecordBatch, col: int) -> list[np.ndarray | None]:
    """floor(1024 * x) of each vector, None for those that take no part."""
    out = []
    for v in batch.column(col).to_pylist():
        if v is None or any(x is None for x in v):
            out.append(None)
            continue
        a = np.floor(np.asarray(v, np.float64) * SCALE)
        out.append(a if np.isfinite(a).all() else None)
    return out


def vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, vec): quantised vectors as packed doubles."""
    rows = table.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vec_col}`").alias("v")).dropna()

    def run(b: pa.RecordBatch):
        vs = quantised(b, 1)
        ok = [i for i, v in enumerate(vs) if v is not None]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(ok, pa.int64())), pa.array([len(vs[i]) for i in ok], pa.int32()),
             pa.array([vs[i].astype("<f8").tobytes() for i in ok], pa.binary())], ["id", "dim", "vec"])
    return map_batches(rows, run, "id bigint, dim int, vec binary")


def span_of(m: np.ndarray, pivots: int) -> np.ndarray:
    """An orthonormal basis of the span of up to ``pivots`` rows of ``m``,
    each the farthest from the span of those before it."""
    rest, basis, most = m.copy(), [], 0.0
    for _ in range(min(pivots, len(m))):
        far = np.linalg.norm(rest, axis=1)
        i = int(np.argmax(far))
        most = most or far[i]
        if far[i] <= SPREAD * most:
            break
        b = rest[i] / far[i]
        for _ in range(2):                             # once more, against rounding
            for c in basis:
                b = b - (b @ c) * c
            b /= np.linalg.norm(b)
        basis.append(b)
        rest = rest - np.outer(rest @ b, b)
    return np.stack(basis) if basis else np.zeros((0, m.shape[1]))


def pick_pivots(vecs: DataFrame, pivots: int | None = None, sample: int = PIVOT_SAMPLE) -> dict[int, np.ndarray]:
    """Per vector length the span of its pivots, from the ``sample`` vectors
    with the smallest hashes."""
    got = vecs.orderBy(F.xxhash64("id", "vec"), "id").limit(sample).toPandas()
    return {int(dim): span_of(_matrix(g["vec"]), pivots or max(1, round(PIVOT_SHARE * dim))) for dim, g in got.groupby("dim") if dim}


def with_distances(vecs: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """The pivot table: (id, dim, vec, norm, dist): where a vector is in the
    pivots' span, and last its distance from the span."""
    def run(b: pa.RecordBatch):
        norms, ds = [], []
        for dim, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            a = np.frombuffer(v, "<f8")
            c = pivots.get(dim, np.zeros((0, dim))) @ a
            n2 = float(a @ a)
            norms.append(n2 ** .5)
            ds.append(np.append(c, max(0.0, n2 - float(c @ c)) ** .5).astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norms, pa.float64()), pa.array(ds, pa.binary())],
                                         ["id", "dim", "vec", "norm", "dist"])
    return map_batches(vecs, run, "id bigint, dim int, vec binary, norm double, dist binary")


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of x with q, as int64."""
    if x.size == 0 or np.abs(x).max() * np.abs(q).max() * max(1, len(q)) < EXACT:
        return (x @ q).astype(np.int64)
    whole = [[int(c) for c in row] for row in x]
    return np.array([min(max(sum(a * int(b) for a, b in zip(row, q)), -(1 << 63)), (1 << 63) - 1) for row in whole],
                    np.int64)


def _matrix(col) -> np.ndarray:
    return np.stack([np.frombuffer(v, "<f8") for v in col])


def search_block(cand: pd.DataFrame, query: pd.DataFrame, k: int) -> tuple[list[tuple], int]:
    """(query id, query vector's hash, id, score) of the k best of each
    query among the candidates, by falling bound until none can enter, and
    how many were scored.  Scores under a query's ``least`` may be left out."""
    x, xd, xn, ids = _matrix(cand["vec"]), _matrix(cand["dist"]), cand["norm"].to_numpy(), cand["id"].to_numpy()
    q, qd, qn = _matrix(query["vec"]), _matrix(query["dist"]), query["norm"].to_numpy()
    least = query["least"].to_numpy(dtype=np.float64) if "least" in query else np.full(len(query), -np.inf)
    out, scored = [], 0
    for i, (qid, h) in enumerate(zip(query["id"].tolist(), query["qh"].tolist())):
        # Rounded up by far more than the error of these doubles.
        bound = xd @ qd[i] + 1e-9 * qn[i] * xn + 1
        bound[(ids == qid) | (bound < least[i])] = -np.inf
        order = np.argsort(-bound, kind="stable")
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a in range(0, len(order), STEP):
            at = order[a:a + STEP]
            floor = float(best[-1]) if len(best) == k else -np.inf
            at = at[(bound[at] >= floor) & (bound[at] > -np.inf)]
            if not len(at):
                break
            scored += len(at)
            best, best_ids = np.concatenate((best, products(x[at], q[i]))), np.concatenate((best_ids, ids[at]))
            top = np.lexsort((best_ids, -best.astype(object) if (best == -(1 << 63)).any() else -best))[:k]
            best, best_ids = best[top], best_ids[top]
        out += [(qid, h, v, s) for v, s in zip(best_ids.tolist(), best.tolist())]
    return out, scored


def search(cand: DataFrame, ask: DataFrame, k: int) -> DataFrame:
    """(query_id, qh, vec_id, score): the k best of each query in each block
    (dim, cb, qb) that it meets."""
    ship()

    def run(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        got = search_block(c, q, k)[0] if len(c) and len(q) else []
        return pd.DataFrame(got, columns=["query_id", "qh", "vec_id", "score"]).astype("int64")
    keys = ["dim", "cb", "qb"]
    return (cand.groupBy(*keys).cogroup(ask.groupBy(*keys))
            .applyInPandas(run, "query_id bigint, qh bigint, vec_id bigint, score bigint"))


def top_k(table: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
          block: int = BLOCK, query_block: int = QUERY_BLOCK, pivots: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query``
    (a column of ``id``) holds, its ``k`` best partners in the table."""
    vecs = vectors(table, id_col, vec_col)
    rows = stored(with_distances(vecs, pick_pivots(vecs, pivots)), "pivot_table")
    queries = stored(rows.filter(is_query).withColumn("qh", F.xxhash64("vec")).dropDuplicates(["id", "vec"]), "pivot_queries")
    n, nq = rows.count(), queries.count()
    blocks, qblocks = 1 + n // block, 1 + nq // query_block
    cb = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    cand = rows.withColumn("cb", cb).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))))
    ask = queries.withColumn("qb", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(qblocks)).cast("int"))
    if blocks > 1:
        # One block first: its k-th score holds against all other blocks.
        start = search(cand, ask.withColumn("cb", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)).cast("int")), k)
        start = stored(start.groupBy(F.col("query_id").alias("id"), "qh").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
                       .filter(F.col("n") >= k).drop("n"), "least_scores")
        least = F.coalesce(F.col("least").cast("double"), F.lit(float("-inf")))
        ask = ask.join(start, ["id", "qh"], "left").withColumn("least", least)
    near = search(cand, ask.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), k)
    rank = F.row_number().over(Window.partitionBy("query_id", "qh").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
