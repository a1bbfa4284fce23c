"""Near-dedup of rows that repeat an id or have none."""

from streamfold.llm import simhash


def test_one_row_of_each_group(spark):
    a, b, c = (" ".join(f"{x}{i * i % 101}" for i in range(200)) for x in ("alpha", "beta", "gamma"))
    rows = [(1, a), (1, a), (1, a), (2, a), (None, a), (5, b), (None, b), (None, c), (None, c), (None, c)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    kept = [tuple(r) for r in simhash.near_dedup(df).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (5, b), (None, c)], key=str)
