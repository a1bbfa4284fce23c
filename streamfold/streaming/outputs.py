"""Several outputs of one micro-batch: good records and rejects (COD-05,
COD-06), and how many of each were delivered (SNK-03, AGG-08).

A record that does not decode is set aside and reading goes on.  The tag
function decodes a record once and names its output; one write then lays
the outputs of the micro-batch side by side, ``path/batch=<id>/output=<name>``.
One job writes all of them, so they commit together, and a replayed batch
replaces its own folder: no record is lost between outputs or doubled.  The
rows hold the columns of all outputs; a reader names those of its own, and
the others are not read.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import batch_folder, missing_path, run_to_end

GOOD, REJECTED = "good", "rejected"
OUTPUT = "output"
DELIVERY = "delivery"


def tagged(df: DataFrame, reason: Column) -> DataFrame:
    """``df`` with ``reason`` and the output that it decides."""
    return df.withColumn("reason", reason).withColumn(
        OUTPUT, F.when(F.col("reason").isNull(), F.lit(GOOD)).otherwise(F.lit(REJECTED)))


def outputs_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write the outputs of each micro-batch, one folder each, in one job."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").partitionBy(OUTPUT).parquet(batch_folder(path, batch_id))
    return write


def read_output(spark: SparkSession, path: str, output: str, schema: str) -> DataFrame:
    """What one output holds (empty when nothing was written)."""
    try:
        got = spark.read.schema(f"{schema}, batch bigint, {OUTPUT} string").parquet(path)
        return got.filter(F.col(OUTPUT) == output).drop("batch", OUTPUT)
    except Exception as e:
        if not missing_path(e):
            raise
        return spark.createDataFrame([], schema)


def stream_output(spark: SparkSession, path: str, output: str, schema: str) -> DataFrame:
    """One output as the input of the next query (a batch that is replayed
    comes again, so what follows must be a fold that repeats don't change)."""
    got = spark.readStream.schema(f"{schema}, batch bigint, {OUTPUT} string").parquet(path)
    return got.filter(F.col(OUTPUT) == output).drop("batch", OUTPUT)


class DeliveryCounter:
    """SNK-03 / AGG-08: rows delivered per query and output.

    The counts are Spark's own observed metrics (``observed``): they are
    taken while the write of a micro-batch runs and reported with its
    progress, after the batch has committed.  A micro-batch counts once,
    however often it is replayed.  Use as a context manager."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._batches: dict[tuple[str, int], dict[str, int]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self._listener = self._made()

    def __enter__(self) -> DeliveryCounter:
        self._spark.streams.addListener(self._listener)
        return self

    def __exit__(self, *exc) -> None:
        for ended in list(self._ended.values()):          # events come a little after the query
            ended.wait(30)
        self._spark.streams.removeListener(self._listener)

    def counts(self) -> dict[tuple[str, str], int]:
        """(query, output) to rows."""
        out: dict[tuple[str, str], int] = {}
        with self._lock:
            for (query, _), metrics in self._batches.items():
                for output, n in metrics.items():
                    out[query, output] = out.get((query, output), 0) + n
        return out

    def _made(self):
        from pyspark.sql.streaming import StreamingQueryListener
        counter = self

        class _Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                counter._ended[str(event.runId)] = threading.Event()

            def onQueryProgress(self, event):
                p = event.progress
                row = p.observedMetrics.get(DELIVERY)
                if row is not None:
                    with counter._lock:
                        counter._batches[p.name or str(p.id), p.batchId] = row.asDict()

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                counter._ended.setdefault(str(event.runId), threading.Event()).set()
        return _Listener()


def observed(df: DataFrame) -> DataFrame:
    """Count the rows of each output while they are written."""
    return df.observe(DELIVERY, *[F.count_if(F.col(OUTPUT) == o).alias(o) for o in (GOOD, REJECTED)])


def run_split(stream: DataFrame, checkpoint: str, path: str, name: str | None = None) -> None:
    """Write a ``tagged`` stream to its outputs below ``path``, counted."""
    run_to_end(observed(stream), checkpoint, foreach_batch=outputs_writer(path), name=name)
