"""Prefix scans per key that stay distributed when one key is huge.

``sum(x) OVER (PARTITION BY k ORDER BY o ROWS UNBOUNDED PRECEDING)`` puts
all rows of a key into one task.  When one key may hold a third of the
data, that task is the whole job.  Here the ordering column is cut into
chunks of ``span`` units; each (key, chunk) is scanned on its own, and a
small table of per-chunk results carries the prefix across chunks:

1. shuffle rows once by ``(key, chunk)`` and scan locally (bounded groups);
2. reduce each (key, chunk) to one row straight from the input with a
   partial aggregation, so its exchange carries one row per (key, chunk,
   task), not the records (deriving it from step 1 would need a second
   full shuffle, since the two exchanges differ in their columns);
3. exclusive prefix over the per-chunk rows of each key (rows = number of
   chunks, not number of records);
4. join the carry back on ``(key, chunk)``; only the small side moves.

The result equals the plain window function exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import epoch_micros

# Chunk width in units of the ordering column (offsets / microseconds).
DEFAULT_SPAN = 1 << 20
_CHUNK = "_sf_chunk"


def _join_back(local: DataFrame, carry: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` with null-safe equality (a NULL key is a key)."""
    ren = {c: f"_sf_j{i}" for i, c in enumerate(cols)}
    right = carry.select(*[F.col(c).alias(ren[c]) if c in ren else F.col(c)
                           for c in carry.columns])
    cond = None
    for c in cols:
        e = local[c].eqNullSafe(right[ren[c]])
        cond = e if cond is None else cond & e
    return local.join(right, cond, how).drop(*ren.values())


def _chunked(df: DataFrame, order: Column | str, span: int) -> DataFrame:
    # The chunk id is the chunk's first value: integer arithmetic, exact and
    # monotone in the ordering value.
    o = F.col(order) if isinstance(order, str) else order
    return df.withColumn(_CHUNK, o - F.pmod(o, F.lit(span)))


def running_sums(df: DataFrame, keys: list[str], order: str, sums: dict[str, Column | str],
                 span: int = DEFAULT_SPAN, order_tiebreak: list[str] | None = None) -> DataFrame:
    """Add one column per entry of ``sums``: the running sum of that value
    per ``keys`` in ``order`` (inclusive of the current row)."""
    ob = [order, *(order_tiebreak or [])]
    base = _chunked(df, order, span)
    vals = {out: (F.col(v) if isinstance(v, str) else v) for out, v in sums.items()}
    loc = {out: f"_sf_loc_{out}" for out in vals}
    w_local = (Window.partitionBy(*keys, _CHUNK).orderBy(*ob)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = base.select("*", *[F.sum(v).over(w_local).alias(loc[o]) for o, v in vals.items()])

    per_chunk = base.groupBy(*keys, _CHUNK).agg(*[F.sum(v).alias(loc[o]) for o, v in vals.items()])
    w_prev = (Window.partitionBy(*keys).orderBy(_CHUNK)
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = per_chunk.select(*keys, _CHUNK, *[
        F.coalesce(F.sum(loc[o]).over(w_prev), F.lit(0)).alias(f"_sf_carry_{o}") for o in vals])

    out = _join_back(local, carry, [*keys, _CHUNK])
    for o in vals:
        out = out.withColumn(o, F.col(loc[o]) + F.col(f"_sf_carry_{o}"))
    return out.drop(_CHUNK, *loc.values(), *[f"_sf_carry_{o}" for o in vals])


def running_last(df: DataFrame, keys: list[str], order: str, value: str, out: str,
                 span: int = DEFAULT_SPAN, order_tiebreak: list[str] | None = None,
                 hot_rows: int = 0, before: bool = False) -> DataFrame:
    """Add ``out``: the last non-null ``value`` per ``keys`` up to and
    including the current row in ``order`` (``last(value, true)`` over an
    unbounded-preceding frame); with ``before`` up to the row before it.

    Keys of at most ``hot_rows`` rows are one chunk and carry nothing; only
    the keys above are cut by ``span``.  So the carry table has a row per
    chunk of a hot key, and none for the many small keys."""
    ob = [order, *(order_tiebreak or [])]
    base = _chunked(df, order, span)
    # One row per (key, chunk): its last non-null value, or NULL when it has
    # none (max_by skips rows whose ordering value is NULL), and its rows.
    tail_order = F.when(F.col(value).isNotNull(), F.struct(*[F.col(c) for c in ob]))
    per_chunk = base.groupBy(*keys, _CHUNK).agg(F.max_by(F.col(value), tail_order).alias("_sf_tail"),
                                                F.count(F.lit(1)).alias("_sf_n"))
    w_key = Window.partitionBy(*keys)
    w_prev = w_key.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(*keys, _CHUNK, F.last("_sf_tail", ignorenulls=True).over(w_prev).alias("_sf_carry"),
                               F.sum("_sf_n").over(w_key).alias("_sf_rows"))
    carry = carried.filter(F.col("_sf_rows") > hot_rows).drop("_sf_rows") if hot_rows else carried.drop("_sf_rows")
    if hot_rows:
        # Hot keys come from the same small table as their carries.  Dealt by
        # key and chunk at once: dealt by key alone, as the join leaves them,
        # a hot key's rows would meet in one task.
        hot = carry.select(*keys).distinct().withColumn("_sf_hot", F.lit(True))
        base = (_join_back(base, hot, keys, "left")
                .withColumn(_CHUNK, F.when(F.col("_sf_hot"), F.col(_CHUNK))).drop("_sf_hot")
                .repartition(*keys, _CHUNK))
    w_local = (Window.partitionBy(*keys, _CHUNK).orderBy(*ob)
               .rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow))
    local = base.withColumn("_sf_loc", F.last(value, ignorenulls=True).over(w_local))
    res = (_join_back(local, carry, [*keys, _CHUNK], "left" if hot_rows else "inner")
           .withColumn(out, F.coalesce(F.col("_sf_loc"), F.col("_sf_carry"))))
    return res.drop(_CHUNK, "_sf_loc", "_sf_carry")


# Types whose aggregation buffers are updated in place (hash aggregation).
_FIXED = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"}


def time_order(ts: str, tiebreak: str) -> Column:
    """One number that sorts like ``(ts, tiebreak)``, nulls first: fixed
    width, so that ``max_by`` over it is a hash aggregate (a struct would
    make Spark sort all rows by key).  ``tiebreak`` is a bigint."""
    micros = F.coalesce(epoch_micros(ts), F.lit(-(1 << 60))).cast("decimal(19,0)")
    least = F.coalesce(F.col(tiebreak), F.lit(-(1 << 63)))
    return (micros * F.lit(str(1 << 64)).cast("decimal(20,0)") + least.cast("decimal(19,0)")).cast("decimal(38,0)")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str] | str,
                   values: list[str]) -> DataFrame:
    """AGG-06: the row with the greatest ``order`` per key by ``max_by``, with
    map-side partial aggregation, so a hot key is reduced before the shuffle.
    With fixed-width values and order (one column, or a time and a bigint)
    this is a hash aggregate; strings among them make Spark aggregate by sort."""
    order = [order] if isinstance(order, str) else order
    types = dict(df.dtypes)
    if len(order) == 1:
        o = F.col(order[0])
    elif len(order) == 2 and types[order[0]].startswith("timestamp") and types[order[1]] == "bigint":
        o = time_order(*order)
    else:
        o = F.struct(*[F.col(c) for c in order])
    if all(types[v] in _FIXED for v in values):
        return (df.withColumn("_sf_o", o).groupBy(*keys)
                .agg(*[F.max_by(v, "_sf_o").alias(v) for v in values]))
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(v) for v in values]), o).alias("_sf_v"))
    return picked.select(*keys, *[F.col(f"_sf_v.{v}").alias(v) for v in values])
