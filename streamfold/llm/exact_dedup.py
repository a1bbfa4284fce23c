"""Exact dedup by skew-safe combining (operator 1).

Three combining steps, each of which compares whole contents (the text is
a grouping key next to its digest, so equal digests alone never merge):

1. local: Spark's map-side aggregate folds equal texts within a task;
2. salted: ``(digest, salt, text)``, so the copies of one text meet in up
   to ``salts`` tasks, each of which gets one row a map task;
3. global: ``(digest, text)`` over the salt winners, at most ``salts`` rows
   a text.

Documents then find their group by digest.  That is exact while each
digest has one text, which step 3 has seen for all of them; would two
texts share a digest, the documents are matched by digest and text.

Defined results: a null text counts as empty; rows without an id are
grouped, but only lend their id to a group when no row has one; rows that
repeat an id and a text are one document, of which ``exact_groups`` calls
every row kept; ``exact_dedup`` leaves one row per text, also of rows that
repeat an id and of rows without one; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, nonnull_text, stored


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE_RUN, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def combine(rows: DataFrame, salts: int) -> DataFrame:
    """(id, d, t) to one row per text: d, t, keep, size."""
    salted = (rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
              .groupBy("d", "salt", "t")
              .agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("size")))
    return salted.groupBy("d", "t").agg(F.min("keep").alias("keep"), F.sum("size").alias("size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 salts: int = 16, normalise: Callable[[Column], Column] = normalised,
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: id, keep, size, d (the digest)."""
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), normalise(nonnull_text(text_col)).alias("t"))
            .withColumn("d", digest(F.col("t"))))
    groups = combine(rows, salts)
    by_digest = stored(groups.groupBy("d").agg(F.count(F.lit(1)).alias("texts"), F.min("keep").alias("keep"),
                                               F.sum("size").alias("size")), "exact_groups")
    if by_digest.filter("texts > 1").isEmpty():
        return rows.drop("t").join(by_digest.drop("texts"), "d").select("id", "keep", "size", "d")
    return rows.join(stored(groups, "exact_texts"), ["d", "t"]).select("id", "keep", "size", "d")


def is_kept() -> Column:
    return F.col("id").eqNullSafe(F.col("keep"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per text, all columns: the one with the smallest id, rows
    without an id last; of rows that are alike so far, the first as they are
    stored.  Rows are numbered once, in a stored copy, and combined as in
    ``combine``, with the number as the last key of the order."""
    cols = docs.columns
    rows = stored(docs.withColumn("_sf_row", F.monotonically_increasing_id()), "exact_rows")
    order = F.struct(F.col(f"`{id_col}`").isNull().alias("loose"), F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col("_sf_row").alias("row"))
    keyed = rows.select(order.alias("o"), normalised(nonnull_text(text_col)).alias("t")).withColumn("d", sha256(F.col("t")))
    salted = keyed.groupBy("d", F.pmod(F.xxhash64("o"), F.lit(salts)).alias("salt"), "t").agg(F.min("o").alias("o"))
    first = salted.groupBy("d", "t").agg(F.min("o").alias("o")).select(F.col("o.row").alias("_sf_first"))
    return rows.join(first, F.col("_sf_row") == F.col("_sf_first"), "left_semi").select(*[F.col(f"`{c}`") for c in cols])
