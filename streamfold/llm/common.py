"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path
from ..sources.tables import table_path

# --- fixed values: white space and words of the contracts ---
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# ---
PIECE_BYTES = 2 << 20
LAST = (1 << 63) - 1
PART_BITS = 33                  # of monotonically_increasing_id: bits of the row within its part


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """``cols`` of one table, and nothing else."""
    return spark.read.parquet(table_path(sf_dir, name)).select(*[F.col(f"`{c}`") for c in cols])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: cuts the
    lineage, survives lost executors, and leaves a plain scan, so that a
    later join deals both sides anew and AQE may split a hot key."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str, name: str) -> tuple[DataFrame, Column]:
    """``docs`` with _sf_doc, the order of its documents: the id, and for
    each row without one a number of its own after all ids; and the id that
    a _sf_doc stands for.  Rows without an id are stored, to be numbered
    once; one count per part of them reaches the driver."""
    def whole(c: Column) -> Column:             # never null: joins add no filter of theirs, and share an exchange
        return F.coalesce(c, F.lit(LAST))
    key = F.col(f"`{id_col}`").cast("bigint")
    least, most, without = docs.agg(F.min(key), F.max(key), F.count(F.when(key.isNull(), 1))).first()
    if not without:
        return docs.withColumn("_sf_doc", whole(key)), F.col("_sf_doc")
    least, most = (0, -1) if most is None else (least, most)
    shift = max(0, most + without - LAST)       # ids move down where the numbers would not fit above
    if least - shift < -LAST - 1:
        raise ValueError("the ids leave no numbers for rows without one")
    loose = stored(docs.filter(key.isNull()).withColumn("_sf_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_sf_at", PART_BITS)
    counts = sorted((r["p"], r["n"]) for r in loose.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, at = [], most - shift + 1
    for p, n in counts:
        starts.append((p, at))
        at += n
    firsts = F.broadcast(docs.sparkSession.createDataFrame(starts, "_sf_part bigint, _sf_first bigint"))
    numbered = loose.join(firsts, part == F.col("_sf_part")).withColumn(
        "_sf_doc", F.col("_sf_first") + F.col("_sf_at").bitwiseAND(F.lit((1 << PART_BITS) - 1)))
    cols = [F.col(f"`{c}`") for c in [*docs.columns, "_sf_doc"]]
    ids = docs.filter(key.isNotNull()).withColumn("_sf_doc", key - F.lit(shift))
    both = ids.unionAll(numbered.select(*cols)).withColumn("_sf_doc", whole(F.col("_sf_doc")))
    return both, F.when(F.col("_sf_doc") <= most - shift, F.col("_sf_doc") + F.lit(shift))


def nonnull_text(col: str = "text") -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def pieces(b: pa.RecordBatch, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``b`` in slices of at most ``most`` bytes (one row at least), so that
    Python never holds the values of a whole batch of long texts."""
    if b.num_rows <= 1 or b.nbytes <= most:
        if b.num_rows:
            yield b
    else:
        half = b.num_rows // 2
        yield from pieces(b.slice(0, half), most)
        yield from pieces(b.slice(half), most)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
                schema: str | StructType) -> DataFrame:
    """``mapInArrow`` piece by piece; the functions travel by value, so
    executors need not have this package installed."""
    ship()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in pieces(b):
                yield from fn(part)
    return df.mapInArrow(run, schema)


def ship() -> None:
    """Pickle this package's functions by value."""
    for name in [m for m in sys.modules if m.startswith(__package__ + ".")]:
        cloudpickle.register_pickle_by_value(sys.modules[name])


def utf8(col: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column (null: empty)."""
    return [b or b"" for b in col.cast(pa.large_binary()).to_pylist()]
