"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing extra columns, for every operator and every stage."""

import hashlib
import html
from itertools import permutations

import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from streamfold.llm import (exact_dedup, html_extract, language_id, line_dedup, mixing, sentencepiece_codec,
                            simhash, suffix_dedup, topk, url_filter)
from tests.llm import brute

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i * 7919 % 3001}" for i in range(60_000))
PASSAGE = "\n".join(f"line {i} of a passage that repeats across documents" for i in range(4))
ROWS = [
    (0, "alpha beta\tgamma  delta epsilon zeta eta theta", "en", "a"), (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a"),
    (2, None, "en", None), (3, "", None, "a"), (4, " \n\t ", "en", ""), (5, "1234 %%% ---", "en", "b"),
    (6, "first\n" + PASSAGE + "\nlast", "en", "b"), (7, PASSAGE + "\n\n" + PASSAGE, "en", "b"), (8, PASSAGE, "en", None),
    (9, LONG, "en", "hot"), (10, LONG + " end", "en", "hot"), (11, LONG, "en", "hot"), (11, LONG, "en", "hot"),
    (12, "der die das und nicht ein schöner Tag für uns alle", "de", "a"), (13, "a▁b <s> \x00 \U0001F600 naïve", "de", "c"),
    (None, "no id, but a text of its own that is longer than fifty bytes in all", "en", "c"), (14, "x" * 500, "en", "c"),
    (15, "x" * 300, "en", "c"), (None, None, None, None),
]
CLASH = ["id", "doc", "d", "t", "h", "keep", "size", "fp", "k", "spans", "lang_pred", "taken", "rank"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in ROWS], DOCS)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


IDS = [r for r in ROWS if r[0] is not None]


def key(r):
    return (r is None, r)


def test_exact(spark, docs, empty):
    for digest in (exact_dedup.sha256, lambda t: F.lit("same")):     # colliding digests change nothing
        rows = exact_dedup.exact_groups(docs, digest=digest).select("id", "keep", "size").collect()
        got = sorted([tuple(r) for r in rows], key=str)
        assert (1, 0, 2) in got and (0, 0, 2) in got and got.count((11, 9, 3)) == 2 and (None, 2, 3) in got
        assert len(rows) == len(ROWS)
    kept = [r.doc_id for r in exact_dedup.exact_dedup(docs).collect()]
    assert 1 not in kept and 11 not in kept and 9 in kept and kept.count(None) == 1
    repeated = spark.createDataFrame([(None, "one"), (None, "one"), (None, "one"), (3, "x  y"), (3, "x y"), (3, "x y"), (None, "x y"),
                                      (5, None), (5, ""), (4, "z")], "doc_id bigint, text string").repartition(4)
    left = sorted((r.doc_id, (r.text or "").split()) for r in exact_dedup.exact_dedup(repeated).collect() if r.doc_id is not None)
    assert left == [(3, ["x", "y"]), (4, ["z"]), (5, [])]
    assert [r.text for r in exact_dedup.exact_dedup(repeated).filter("doc_id is null").collect()] == ["one"]
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.exact_dedup(empty).columns == empty.columns


def test_lines(spark, docs, empty):
    got = {r.doc_id: r.text or "" for r in line_dedup.dedup_lines(docs).collect() if r.doc_id is not None}
    assert got == brute.lines([r[:2] for r in IDS])
    assert got[6] == "first\n" + PASSAGE + "\nlast" and got[7] == "" and got[8] == ""
    assert line_dedup.dedup_lines(empty).columns == empty.columns and line_dedup.dedup_lines(empty).count() == 0


def test_substrings(spark, docs, empty):
    rows = [r for r in ROWS if r[0] is not None]
    got = suffix_dedup.dedup_substrings(docs).collect()
    assert len(got) == len(ROWS)
    want = brute.substrings([(r[0], r[1][:9000] if r[1] else r[1]) for r in rows])
    short = suffix_dedup.dedup_substrings(docs.withColumn("text", F.substring("text", 1, 9000))).collect()
    have = {r.doc_id: (sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in short if r.doc_id is not None}
    assert have == {d: (w[1], w[2], w[3]) for d, w in want.items()}
    assert bytes(next(r for r in got if r.doc_id == 11).kept) == b""
    assert suffix_dedup.dedup_substrings(empty).count() == 0


def loose_orders(rows, brute_force):
    """The results when rows without an id come after all others, as a
    document each, in any order: (kept texts by id, sorted kept texts)."""
    ids, loose = [r for r in rows if r[0] is not None], [t for d, t in rows if d is None]
    top = max([d for d, _ in ids], default=0)
    for order in permutations(loose):
        kept = brute_force([*ids, *[(top + 1 + i, t) for i, t in enumerate(order)]])
        yield {d: kept[d] for d, _ in ids}, sorted(kept[top + 1 + i] for i in range(len(order)))


@pytest.mark.parametrize("top", [(1 << 63) - 1, None])         # the largest id there is, and no ids at all
def test_substrings_without_id(spark, top):
    own, said = ROWS[15][1], "a passage of more than fifty bytes that two rows without any id hold"
    rows = [(None, t) for t in (None, own, own, f"one {said}", f"other {said} and more", f"known {ROWS[6][1]}")]
    rows += [(3, ""), (6, ROWS[6][1]), (top, said)] if top else []
    got = suffix_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    have = ({r.doc_id: bytes(r.kept) for r in got if r.doc_id is not None}, sorted(bytes(r.kept) for r in got if r.doc_id is None))
    assert len(got) == len(rows) and own.encode() in have[1]
    assert have in loose_orders(rows, lambda r: {d: w[3] for d, w in brute.substrings(r).items()})


def test_substrings_hot_digit(spark):
    """A phrase with other neighbours in each document is not one group."""
    phrase, n = "a phrase of thirty-nine bytes, all told", 400
    noise = [hashlib.sha256(str(i % 390).encode()).hexdigest() for i in range(n)]        # ten documents are copies but for an end
    rows = [(i, f"{s[:32]} {phrase} {s[32 - i % 3:]}{i}") for i, s in enumerate(noise)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {d: w[3] for d, w in brute.substrings(rows).items()}
    assert {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup_substrings(df, hot=20).collect()} == want
    docs = df.select(F.col("doc_id").alias("doc"), "text")
    shared = suffix_dedup.repeated_digits(suffix_dedup.first_digits(docs, 4)).groupBy("doc").agg(F.collect_list("key").alias("keys"))
    marked = docs.join(shared, "doc").withColumn("copy", F.lit(False))
    sizes = []
    for hot in (10 * n, 20):
        got = suffix_dedup.contexts(suffix_dedup.with_hot(marked, shared, 4096, hot), 4096).filter("bucket >= 0")
        sizes.append(max(r["count"] for r in got.groupBy("bucket", "h").count().collect()))
    assert sizes[0] > n // 2 and sizes[1] <= 20


def test_mixing(spark, docs, empty):
    rows = mixing.mix_report(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r.taken % max(1, r.size) for r in rows} == {0} and all(r.taken <= 2 * r.size for r in rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(r.size for r in mixing.sized(mixed).select(F.col("_sf_size").alias("size")).collect()) == sum(r.taken for r in rows)
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert mixing.targets([100, 10, 10], [5, 2, 1]) == [140.0, 20.0, 20.0]
    assert mixing.targets([0, 0], [5, 2]) == [0.0, 0.0]


def test_language(spark, docs, empty):
    model = language_id.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, model, carry=("doc_id",)).collect()}
    assert got[2] == got[3] == got[4] == got[5] == ("und", 0.0) and got[12][0] == "de" and got[9][0] == "en"
    kept = language_id.accepted(docs, model)
    assert kept.columns == docs.columns and {2, 3, 4, 5}.isdisjoint(r.doc_id for r in kept.collect())
    none = language_id.fit(empty)
    assert language_id.predict(docs, none, carry=("doc_id",)).filter("lang_pred <> 'und'").count() == 0
    assert language_id.predict(empty, model).count() == 0


def test_top_k(spark):
    rows = [(i, [float(i % 7) / 7, 0.5, -(i % 5) / 5]) for i in range(230)] + [
        (230, None), (231, [1.0, None, 0.0]), (232, [float("nan"), 0.0, 0.0]), (233, [float("inf")] * 3), (None, [1.0, 1.0, 1.0]),
        (234, [1.0, 2.0]), (7, [0.9, 0.9, 0.9]), (235, []), (236, [1e30, -1e30, 1e30]), (100, [0.0, 0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(1))
    got = [tuple(r) for r in topk.top_k(df, F.col("id") % 100 == 0, block=64, query_block=2, pivots=4).collect()]
    import math
    import numpy as np
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    lim = 1 << 63
    want = []
    for q, qv in {(i, tuple(v)) for i, v in ok if i % 100 == 0}:
        s = sorted((-min(max(sum(a * b for a, b in zip(qv, v)), -lim), lim - 1), i) for i, v in ok if i != q and len(v) == len(qv))
        want += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:10])]
    assert sorted(got) == sorted(want)
    assert topk.top_k(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_simhash(spark, docs, empty):
    got = {r.id: (f"{r.fp % (1 << 64):016x}", r.component) for r in simhash.near_duplicates(docs).collect() if r.id is not None}
    assert got == brute.simhash([r[:2] for r in IDS])
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns and simhash.near_dedup(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_cells(spark):
    """A dense cluster cut into many cells keeps every link."""
    fps = {(1 << a) ^ (1 << b) ^ (1 << c) for a in range(8) for b in range(8, 20) for c in range(20, 24)} | {
        (0xF0F0F0F0 << 30) ^ (1 << a) for a in range(40)}
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint")
    from streamfold.llm.components import components
    for cell in (16, 4096):
        comps = {r.node % (1 << 64): r.component for r in components(simhash.links(df, cell=cell)).collect()}
        assert set(comps) == fps and len(set(comps.values())) == 2
    tree = simhash.Tree(sorted(fps))
    assert all(sorted(tree.near(v, 4)) == [i for i, w in enumerate(sorted(fps)) if (v ^ w).bit_count() <= 4]
               for v in list(fps)[:50])


def test_components_chain(spark):
    from streamfold.llm.components import components
    n = 60
    df = spark.createDataFrame([(i, i + 1) for i in range(n) if i % 20], "u bigint, v bigint")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {i: (i - 1) // 20 * 20 + 1 for i in range(1, n + 1)}


def test_html(spark):
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<p></p>") == ""
    body = "<article><header><h1>T &amp; t</h1></header><p>One<br>two &lt;b&gt;\n x<p>Short<ul><li>a<li>b</ul>"
    page = ("<html><head><title>no</title><style>p{}</style></head><body class='sidebar-left'><nav><a>menu</a></nav>"
            "<div class=ad>buy</div>" + body + "<form>f</form><div class='comments'><p>me too</p></div>"
            "<script>var a='</p>'</script></article><footer>&copy;</footer><aside>x</aside>")
    assert html_extract.main_text(page) == "T & t\n\nOne two <b> x\n\nShort\n\na\n\nb"
    for cut in range(0, len(page), 7):
        html_extract.main_text(page[:cut])
    para = "A paragraph with a good number of words that make it long enough to surge. " * 2
    plain = f"<body><div><a href=x>Home</a> <a href=y>News</a></div><div><p>{para}</p><p>Short one.</p><p>{para}</p></div><div><a>c</a></div>"
    assert html_extract.main_text(plain) == "\n\n".join([para.strip(), "Short one.", para.strip()])
    assert html_extract.main_text("<article>" + "<p>x " * 20000)[:4] == "x\n\nx"
    df = spark.createDataFrame([(1, None, None), (None, "u", page), (None, "u", page)], "page_id bigint, url string, html string")
    assert html_extract.extract(df.withColumn("text", F.lit(1))).count() == 3 and html_extract.extract(df.limit(0)).count() == 0
    assert html.unescape("&amp") == "&"


def test_urls(spark):
    rules = mixing.local_table(spark, {k: pa.array(v) for k, v in dict(
        host=["net", "example.net", "example.com", "org", "a.b.example.com", None, "net"],
        path=["/", "/en/", "/de/", "/fr/", "/x", "/", "/"], verdict=["block", "allow", "block", "allow", "allow", "block", "allow"]).items()})
    urls = ["http://x.NET/en/1", "http://a.example.net/en/1?q", "http://example.net/enough", "http://notexample.com/de/", None, "", "x",
            "s://example.com/de", "s://example.com/de/#f", "s://h.org/fr/a/b", "s://org/fr/", "s://net", "s://u.a.b.example.com/xyz",
            "a://b.net:80/://c", "s://" + ".".join("abc" * 500) + ".net/" + "p/" * 500, "s://x.NET/en/1"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id int, url string").withColumn("rule", F.lit("z"))
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(df, rules).collect()}
    b, a = ("net/", "block"), (None, "allow")
    assert got == {0: b, 1: ("example.net/en/", "allow"), 2: b, 3: a, 4: a, 5: a, 6: a, 7: a, 8: ("example.com/de/", "block"),
                   9: ("org/fr/", "allow"), 10: ("org/fr/", "allow"), 11: a, 12: ("a.b.example.com/x", "allow"), 13: a, 14: b, 15: b}
    assert url_filter.judge(df, rules).count() == len(urls) + 1 and url_filter.judge(df.limit(0), rules).count() == 0
    assert url_filter.judge(df, rules.limit(0)).filter("verdict <> 'allow'").count() == 0


def test_pieces(spark, docs, empty):
    got = sentencepiece_codec.encode(docs, MODEL, digests=True)
    rows = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect() if r.doc_id is not None}
    assert rows == brute.pieces([r[:2] for r in IDS], MODEL)
    full = sentencepiece_codec.encode(docs.filter("doc_id in (0, 2, 13)"), MODEL)
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(full, MODEL).collect()}
    assert back == {r.doc_id: r.decoded for r in full.collect()} and back[0] == ROWS[0][1] and back[2] == ""
    assert sentencepiece_codec.encode(empty, MODEL).count() == 0


def test_stages(spark, docs, tmp_path):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    for start in (docs, docs.limit(0)):
        now = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, now, str(tmp_path))
            if k + 1 < len(corpus_pipeline.STAGES):
                assert out.columns == docs.columns, name
            out.write.parquet(f"{tmp_path}/{start is docs}{k}")
            now = spark.read.parquet(f"{tmp_path}/{start is docs}{k}")
        assert (now.count() > 0) == (start is docs)
    assert {r.doc_id for r in now.collect()} == set()
    assert corpus_pipeline.run(spark, str(tmp_path)).filter("doc_id = 9").count() > 0


def test_pieces_are_the_librarys(monkeypatch):
    """Any text, in any batch, with a table that is emptied all the time:
    what the library gives for the whole text."""
    import random

    import sentencepiece
    sp, r = sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(0)
    parts = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "ß", "\U0001F600", "中", "<s>", "</s>", "<unk>", "\x00", "ﬁ", "word", "1", " ⁇ ", "́", "x" * 70]
    for most in (3, 500_000):
        monkeypatch.setattr(sentencepiece_codec, "MAX_CHUNKS", most)
        codec = sentencepiece_codec.Codec(MODEL)
        for _ in range(300):
            texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 20))]
            ids = [sp.encode(t, add_eos=True) for t in texts]
            assert codec.encoded(texts) == [(" ".join(map(str, i)), sp.decode(i)) for i in ids]
            assert all(len(c) <= sentencepiece_codec.MAX_CHUNK_CHARS for c in codec.ids) and set(codec.odd) <= set(codec.ids)
