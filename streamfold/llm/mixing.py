"""Mixing sources to target weights by hash-threshold histograms (operator 4).

Sources in code-point order (null last) get the weights of ``WEIGHTS``,
repeating, and share ``SHARE`` times all words; a target stops at
``MOST`` times its source's words and the excess goes to the others by
weight.  A source's whole multiples are taken of every document; the rest
of its target is filled with the documents whose hash lies under a
threshold.  The threshold is found from histograms: words summed by
source and hash digit, the first digit that passes the budget is the
boundary, and only the boundary's documents are summed again by the next
digit.  Nothing is sorted.

A document is taken whole, so the boundary document may not fit.  Then the
search goes on above it with what is left of the budget, over documents
that are no larger, until ``TOLERANCE`` of the target is left or none fits;
the nearest of the ends met on the way is used.

One row per source reaches the driver (totals, boundaries), never a
document.  Hashes depend on id and text alone: reruns agree.

Defined results: a null text has size 0; documents without words are never
taken; rows that repeat id and text stand or fall together; an empty table
gives an empty mix; a source may be null or empty, each a source of its
own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, nonnull_text, stored

# --- fixed values of the contract ---
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
# ---
HASH_BITS = 60
DIGIT_BITS = 12
TOLERANCE = 0.001
NO_HASH = 1 << HASH_BITS


@dataclass
class Plan:
    """What is taken of one source: every document ``copies`` times, and
    once more where lo < hash < hi and size <= most for one of ``ranges``."""
    key: str
    size: int
    target: float
    copies: int = 0
    ranges: list[tuple[int, int, int]] = field(default_factory=list)


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, _sf_key (the source, distinct for null), _sf_size, _sf_h."""
    text, source = nonnull_text(text_col), F.col(f"`{source_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("_sf_id"),
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source.cast("string"))).alias("_sf_key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_sf_size"),
        F.xxhash64(F.col(f"`{id_col}`"), text).bitwiseAND(F.lit(NO_HASH - 1)).alias("_sf_h"))


def targets(sizes: list[int], weights: list[int], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words wanted of each source: shares by weight, none above ``most``
    times its size, the excess shared again among the others."""
    out = [0.0] * len(sizes)
    left, free = share * sum(sizes), set(range(len(sizes)))
    while free:
        a_weight = left / sum(weights[i] for i in free)
        over = {i for i in free if weights[i] * a_weight > most * sizes[i]}
        for i in over or free:
            out[i] = float(most * sizes[i]) if over else weights[i] * a_weight
        left -= sum(out[i] for i in over)
        free = free - over if over else set()
    return out


def local_table(spark, rows: dict[str, pa.Array]) -> DataFrame:
    return spark.createDataFrame(pa.table(rows))


def _boundaries(rows: DataFrame, asked: dict[str, tuple[int, int, float]]) -> dict[str, tuple[int, float, int]]:
    """For each source asked (lo, most, budget): the smallest hash h > lo at
    which the words of documents no larger than ``most`` pass the budget,
    the budget left before it, and the words at it.  Sources whose
    documents all fit are left out."""
    spark = rows.sparkSession
    open_, found = {k: (lo, most, budget, 0) for k, (lo, most, budget) in asked.items()}, {}
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        if not open_:
            break
        state = local_table(spark, {
            "_sf_key": pa.array(open_, pa.string()), "lo": pa.array([v[0] for v in open_.values()], pa.int64()),
            "most": pa.array([v[1] for v in open_.values()], pa.int64()),
            "budget": pa.array([v[2] for v in open_.values()], pa.float64()),
            "prefix": pa.array([v[3] for v in open_.values()], pa.int64())})
        hist = (rows.join(state, "_sf_key")
                .filter((F.col("_sf_h") > F.col("lo")) & F.col("_sf_size").between(1, F.col("most"))
                        & (F.shiftright("_sf_h", shift + DIGIT_BITS) == F.col("prefix")))
                .groupBy("_sf_key", "budget", F.shiftright("_sf_h", shift).alias("digit"))
                .agg(F.sum("_sf_size").alias("n"), F.min("_sf_h").alias("first"), F.max("_sf_h").alias("last")))
        upto = F.sum("n").over(Window.partitionBy("_sf_key").orderBy("digit"))
        edge = (hist.withColumn("upto", upto)
                .filter((F.col("upto") > F.col("budget")) & (F.col("upto") - F.col("n") <= F.col("budget"))).collect())
        still = {}
        for r in edge:
            lo, most, budget, _ = open_[r["_sf_key"]]
            left = budget - (r["upto"] - r["n"])
            if r["first"] == r["last"]:
                found[r["_sf_key"]] = (r["first"], left, r["n"])
            else:
                still[r["_sf_key"]] = (lo, most, left, r["digit"])
        open_ = still
    return found


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
         tolerance: float = TOLERANCE) -> dict[str, Plan]:
    """The plan of each source of ``rows`` (of ``sized``)."""
    totals = {r["_sf_key"]: r["n"] for r in rows.groupBy("_sf_key").agg(F.sum("_sf_size").alias("n")).collect()}
    keys = sorted(totals)
    wanted = targets([totals[k] for k in keys], [weights[i % len(weights)] for i in range(len(keys))], share)
    plans = {k: Plan(k, totals[k], t) for k, t in zip(keys, wanted)}
    asked, ends = {}, {}
    for k, p in plans.items():
        p.copies = min(MOST, int(p.target // p.size)) if p.size else 0
        rest = p.target - p.copies * p.size
        if p.copies < MOST and rest > 0:
            asked[k] = (-1, p.size, rest)
            ends[k] = (rest, [])            # distance from the target, ranges
    ranges: dict[str, list] = {k: [] for k in asked}
    while asked:
        found, more = _boundaries(rows, asked), {}
        for k, (lo, most, budget) in asked.items():
            h, left, at = found.get(k, (NO_HASH, None, 0))
            below = [*ranges[k], (lo, h, most)]
            if left is None:                # all that is no larger fits: no boundary
                ends[k] = min(ends[k], (budget - 1e-9, below), key=lambda e: e[0])
                continue
            ends[k] = min(ends[k], (left, below), (at - left, [*ranges[k], (lo, h + 1, most)]), key=lambda e: e[0])
            ranges[k] = below
            if left > tolerance * plans[k].target and left >= 1:
                more[k] = (h, int(left), left)
        asked = more
    for k, (_, r) in ends.items():
        plans[k].ranges = r
    return plans


def apply(rows: DataFrame, plans: dict[str, Plan]) -> DataFrame:
    """``rows`` with _sf_source_size, _sf_target and _sf_copies."""
    ps = list(plans.values())
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("most", pa.int64())]))
    state = local_table(rows.sparkSession, {
        "_sf_key": pa.array([p.key for p in ps], pa.string()),
        "_sf_source_size": pa.array([p.size for p in ps], pa.int64()),
        "_sf_target": pa.array([p.target for p in ps], pa.float64()),
        "_sf_copies": pa.array([p.copies for p in ps], pa.int64()),
        "_sf_ranges": pa.array([[dict(zip(("lo", "hi", "most"), r)) for r in p.ranges] for p in ps], kind)})
    extra = F.exists("_sf_ranges", lambda r: (F.col("_sf_h") > r["lo"]) & (F.col("_sf_h") < r["hi"])
                     & F.col("_sf_size").between(1, r["most"]))
    return (rows.join(state, "_sf_key")
            .withColumn("_sf_copies", (F.col("_sf_copies") + extra.cast("long")) * (F.col("_sf_size") > 0).cast("long")).drop("_sf_ranges"))


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    rows = stored(sized(docs, id_col, text_col, source_col), "mix_sizes")
    return apply(rows, plan(rows)).select(
        F.col("_sf_id").alias("doc_id"), F.col("_sf_size").alias("size"), F.col("_sf_source_size").alias("source_size"),
        F.col("_sf_target").alias("target"), (F.col("_sf_size") * F.col("_sf_copies")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: all columns, each document as often as it is taken."""
    key = sized(docs, id_col, text_col, source_col)
    plans = plan(stored(key, "mix_sizes"))
    names = {"_sf_key", "_sf_size", "_sf_h"}
    text, cols = nonnull_text(text_col), docs.columns
    source = F.col(f"`{source_col}`")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in cols if c not in names],
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source.cast("string"))).alias("_sf_key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_sf_size"),
        F.xxhash64(F.col(f"`{id_col}`"), text).bitwiseAND(F.lit(NO_HASH - 1)).alias("_sf_h"))
    return (apply(rows, plans).filter("_sf_copies > 0")
            .withColumn("_sf_copy", F.explode(F.sequence(F.lit(1), F.col("_sf_copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in cols]))
