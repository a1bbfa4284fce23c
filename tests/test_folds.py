"""Spend folds, batching and the chunked prefix scans."""

import random

import pytest
from pyspark.sql import Window, functions as F

from streamfold.operators import batching, scan, spend


def orders(spark, amounts, user=1):
    return spark.createDataFrame([(user, i, a, i) for i, a in enumerate(amounts)],
                                 "user_id bigint, order_id bigint, order_amount bigint, offset bigint")


def test_categories_emit_on_change(spark):
    o = orders(spark, [400000, 90000, 20000, 600000])
    rt = [r.total for r in spend.running_totals(o).orderBy("offset").collect()]
    assert rt == [400000, 490000, 510000, 1110000]
    ch = [r.category for r in spend.category_changes(o).orderBy("offset").collect()]
    assert ch == ["bronze", "silver", "gold"]
    latest = spend.latest_category(spend.category_changes(o)).collect()
    assert [(r.user_id, r.category, r.total) for r in latest] == [(1, "gold", 1110000)]


def test_band_edges(spark):
    df = spark.createDataFrame([(t,) for t in (499999, 500000, 999999, 1000000)], "t bigint")
    assert [r[0] for r in df.select(spend.band("t")).collect()] == ["bronze", "silver", "silver", "gold"]


@pytest.mark.parametrize("span", [1, 3, 1000])
def test_running_sums_match_window(spark, span):
    rnd = random.Random(5)
    # key 0 is hot: a third of the rows
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 6), i * 2 + rnd.randint(0, 1), rnd.randint(-50, 100))
            for i in range(600)]
    df = spark.createDataFrame(rows, "k bigint, o bigint, v bigint")
    got = scan.running_sums(df, ["k"], "o", {"s": "v", "n": F.lit(1)}, span=span)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", "o", "v", F.sum("v").over(w).alias("s"), F.count("*").over(w).alias("n"))
    assert sorted(map(tuple, got.select("k", "o", "v", "s", "n").collect())) == \
        sorted(map(tuple, exp.collect()))


@pytest.mark.parametrize("span,hot_rows", [(1, 0), (4, 0), (1000, 0), (4, 50), (4, 10_000)])
def test_running_last_matches_window(spark, span, hot_rows):
    rnd = random.Random(9)
    # key 0 is hot, and a NULL key is a key
    rows = [(0 if i % 3 == 0 else rnd.choice([None, *range(1, 40)]), i, rnd.choice([None, None, "a", "b"]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "k bigint, o bigint, v string")
    got = scan.running_last(df, ["k"], "o", "v", "last", span=span, hot_rows=hot_rows)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", "o", "v", F.last("v", ignorenulls=True).over(w).alias("last"))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got.select("k", "o", "v", "last").collect()), key=key) == \
        sorted(map(tuple, exp.collect()), key=key)


def test_null_keys_survive_scan(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), (1, 1, 5)], "k bigint, o bigint, v bigint")
    got = sorted(map(tuple, scan.running_sums(df, ["k"], "o", {"s": "v"}).select("k", "o", "s").collect()),
                 key=str)
    assert got == sorted([(None, 1, 1), (None, 2, 3), (1, 1, 5)], key=str)


def test_batches_of_ten(spark):
    recs = spark.createDataFrame([(0, i * 3) for i in range(25)], "partition int, offset bigint")
    got = batching.batch_groups(recs, 10, span=7).orderBy("batch_no").collect()
    assert [r.n_records for r in got] == [10, 10, 5]
    assert [(r.first_offset, r.last_offset) for r in got] == [(0, 27), (30, 57), (60, 72)]


def test_hot_key_is_spread_over_tasks(spark):
    """A key holding a third of the rows is scanned by many tasks: the
    window stage is partitioned by (key, chunk), not by key."""
    rows = [(0 if i % 3 == 0 else i % 50 + 1, i, 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, o bigint, v bigint")
    # AQE would merge this tiny test's shuffle partitions into one.
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        out = scan.running_sums(df, ["k"], "o", {"s": "v"}, span=100)
        hot = out.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
        assert hot > 1
        assert out.filter("k = 0").agg(F.max("s")).first()[0] == 1000
    finally:
        spark.conf.set(key, old)


def test_only_hot_keys_are_cut(spark):
    """With ``hot_rows`` a hot key's rows are spread over tasks by chunk, and
    the carry has rows for its chunks alone."""
    rows = [(0 if i % 3 == 0 else i % 500 + 1, i, "a") for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, o bigint, v string")
    key = "spark.sql.adaptive.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        out = scan.running_last(df, ["k"], "o", "v", "last", span=300, hot_rows=100)
        assert out.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count() > 1
        out.select("last").collect()
    finally:
        spark.conf.set(key, old)
    carried = scan.running_last(df.withColumn("v", F.when(F.col("o") < 300, "a")), ["k"], "o", "v", "last",
                                span=300, hot_rows=100)
    # the hot key's value is carried into every later chunk
    assert carried.filter("k = 0 and last is null").isEmpty()
