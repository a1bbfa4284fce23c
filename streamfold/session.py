"""Session construction and the shared checkpoint folder.

Library code never builds a session itself; callers pass one in.  The
helpers here are for tests, the bench and the command-line entry point.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants.  AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes; skew-join splitting handles hot
# keys on the probe side of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "streamfold",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage.
    Only when it is unset (local tests) do we create one of our own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not configured:
            # Local runs only: with executors elsewhere, a folder of this
            # machine would be lost to them.
            if not re.match(r"local(\[[^\]]*\])?$", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="streamfold-ckpt-")
            spark.conf.set("spark.checkpoint.dir", configured)
        sc.setCheckpointDir(configured)   # DataFrame.checkpoint() needs it registered
    return configured or sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location under the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, *parts, uuid.uuid4().hex])
