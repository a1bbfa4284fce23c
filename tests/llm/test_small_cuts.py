"""Documents without words, native rules, and texts hashed in segments."""

import os
import random

from streamfold.llm import mixing, queries, suffix_dedup
from tests.llm import brute

SF = os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.001")


def test_no_words_no_copies(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (2, " ", "x"), (3, None, "x"), (4, "d e f g", "x")], "doc_id bigint, text string, source string")
    ids = [r.doc_id for r in mixing.mix(df).collect()]
    assert {1, 4} == set(ids)


def test_rules_without_arrow(spark, monkeypatch):
    monkeypatch.setattr(mixing, "local_table", None)
    assert queries.op9_url_filters(spark, SF).count() > 0


def test_long_text_by_segments(spark):
    r = random.Random(5)
    text = " ".join(f"w{r.randrange(10 ** 6)}" for _ in range(160_000))
    assert len(text) > suffix_dedup.SEGMENT
    rows = [(1, text[400_000:400_300]), (2, text), (3, text[1_048_500:1_048_640] + " and " + text[7:400])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup_substrings(df).collect()}
    assert got == {d: w[3] for d, w in brute.substrings(rows).items()}
