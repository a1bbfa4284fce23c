"""Sinks for streaming queries (SNK-04, SNK-08, SNK-10, STR-01, STR-06,
STR-07).

``run_to_end`` starts a query with ``availableNow``: it reads what is
there, commits every micro-batch to its checkpoint, and stops (STR-07).
A query restarted on the same checkpoint resumes after the last committed
batch; ``foreachBatch`` writers below are keyed by ``batch_id`` so a
replayed batch overwrites its own output instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_to_end(stream: DataFrame, checkpoint: str, *, foreach_batch: Callable | None = None,
               path: str | None = None, fmt: str = "parquet", output_mode: str = "append",
               name: str | None = None) -> None:
    """Run ``stream`` over all available input, then stop (STR-01, STR-07).
    Without ``path`` and ``foreach_batch`` only the state is kept."""
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif path is not None:
        w = w.format(fmt).option("path", path)
    else:
        w = w.format("noop")
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:       # STR-08: surface the failure
        raise q.exception()


def run_each(queries: dict[str, Callable[[], None]]) -> dict[str, BaseException]:
    """STR-08: run independent queries (say one per topic) so that a failure
    of one, such as a topic the principal may not read, does not stop the
    others.  Returns the failures by name."""
    with ThreadPoolExecutor(max_workers=max(1, len(queries))) as pool:   # all run at the same time
        running = {name: pool.submit(start) for name, start in queries.items()}
    return {name: f.exception() for name, f in running.items() if f.exception() is not None}


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id:012d}"


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """SNK-08/SNK-10: write each micro-batch to ``path/batch=<id>``
    (overwrite: a replayed batch replaces its own output)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(batch_folder(path, batch_id))
    return write


def missing_path(e: Exception) -> bool:
    """Whether the path does not exist; anything else must not read as an
    empty table."""
    return isinstance(e, AnalysisException) and e.getCondition() == "PATH_NOT_FOUND"


def read_batches(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """Everything ``batch_writer`` wrote (empty when nothing was), or what
    it wrote before batch ``before`` (a partition filter)."""
    try:
        got = spark.read.schema(f"{schema}, batch bigint").parquet(path)
        return (got if before is None else got.filter(F.col("batch") < before)).drop("batch")
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return spark.createDataFrame([], schema)
