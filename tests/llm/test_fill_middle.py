"""Fill-in-middle: piece tables, round trips and edges."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamfold.llm import fill_middle as fm
from streamfold.llm import words
from tests.llm.test_edges import CLASH, ROWS

TOKEN = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
text = st.text(alphabet="ab é<PSM>\n\t \x1c \U0001F600", max_size=60).map(str.encode)


@given(text, st.sampled_from([1, 3, 1 << 20]))
@settings(max_examples=200, deadline=None)
def test_tokens(t, segment):
    keep, words.SEGMENT = words.SEGMENT, segment
    try:
        assert fm.token_ends(t) == [m.end() for m in TOKEN.finditer(t)]
    finally:
        words.SEGMENT = keep


@given(text, st.lists(st.integers(0, (1 << 32) - 1), min_size=4, max_size=4))
@settings(max_examples=300, deadline=None)
def test_round_trip(t, h):
    n, form, (i, j), table = fm.transform(t, h, fim_percent=100)
    out = table.bytes()
    assert fm.restore(out, form).bytes() == t and n == len(TOKEN.findall(t))
    if form == fm.PLAIN:
        assert out == t and (not t or any(m in t for m in (b"<P>", b"<S>", b"<M>")))
    else:
        pre, mid, suf = t[:i], t[i:j], t[j:]
        assert out == {"psm": b"<P>" + pre + b"<S>" + suf + b"<M>" + mid, "spm": b"<S>" + suf + b"<P>" + pre + b"<M>" + mid}[form]


@given(text, st.lists(st.integers(0, 60), max_size=4))
@settings(max_examples=200, deadline=None)
def test_cutting_keeps_the_text(t, at):
    cut = fm.PieceTable.of(t).cut(*sorted(min(a, len(t)) for a in at))
    assert cut.bytes() == t and len(cut.pieces) == len(at) + 1
    again = cut.cut(*sorted(min(a + 1, len(t)) for a in at))
    assert again.bytes() == t and all(buf is t for buf, _, _ in again.pieces)     # no text is copied


def test_documents(spark):
    rows = [*[(*r, None) for r in ROWS], (50, "a <P> b", "en", "a", 7), (51, "word " * 300_000, "en", "a", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").select(
        "*", *[F.lit("x").alias(c) for c in [*CLASH, "n", "form", "output"]])
    got = fm.fill_in_middle(df, fim_percent=100)
    back = fm.restored(got).groupBy("doc_id", "text").count()
    want = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).groupBy("doc_id", "text").count()
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()
    form = {r.doc_id: r for r in got.collect()}
    assert form[50].form == form[2].form == form[3].form == "plain" and form[2].n == 0 and form[50].prefix_chars is None
    assert form[51].form != "plain" and form[51].n == 300_001
    digests = fm.fill_in_middle(df, fim_percent=100, digests=True)
    same = digests.join(df, "doc_id").filter("restored_sha256 <> sha2(coalesce(text, ''), 256)")
    assert same.isEmpty() and fm.fill_in_middle(df.limit(0)).count() == 0
    made = fm.fill_in_middle(df, fim_percent=100).select("doc_id", F.sha2("output", 256).alias("s"))
    assert digests.join(made, "doc_id").filter("output_sha256 <> s").isEmpty()
