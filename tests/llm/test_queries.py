"""Each registered query on a whole small table: against its SQL where it
has one, else against a plain reading of its contract."""

import hashlib
import os

import public_tokenizers
import pytest

import __spark_entry__ as entry
from tests.llm import brute
from tests.oracle_compare import compare, duck

SF = os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.001")
SQL = [n for n in entry.queries() if n.startswith("op") and n in entry.oracle_sql()]


@pytest.fixture(scope="module")
def documents():
    return duck(SF).execute("SELECT doc_id, text, lang, source FROM documents").fetchall()


def got(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, SF).collect()]


def by_id(rows, *cols):
    out = {r["doc_id"]: tuple(r[c] for c in cols) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("name", SQL)
def test_sql(spark, name):
    assert compare(spark, name, SF, entry.queries(), entry.oracle_sql())["status"] == "match"


def test_op3(spark, documents):
    rows = by_id(got(spark, "op3_suffix_dedup"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = brute.substrings([r[:2] for r in documents])
    assert rows == {d: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for d, w in want.items()}


def test_op4(spark, documents):
    rows = got(spark, "op4_mixing")
    assert rows == sorted(got(spark, "op4_mixing"), key=lambda r: [x["doc_id"] for x in rows].index(r["doc_id"]))
    source = {d: s for d, _, _, s in documents}
    sizes, taken, target, largest = {}, {}, {}, {}
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
        largest[s] = max(largest.get(s, 0), r["size"])
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(r["source_size"] == sizes[source[r["doc_id"]]] for r in rows)
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        assert target[s] <= 2 * sizes[s] + 1e-6
        assert abs(taken[s] - target[s]) <= 0.01 * target[s] + largest[s] / 2, s


def test_op5(spark, documents):
    rows = by_id(got(spark, "op5_language_id"), "held_out", "lang_pred", "score")
    lang = {d: (l, t) for d, t, l, _ in documents}
    held = [d for d, r in rows.items() if r[0] and lang[d][0] and any(map(str.isalpha, lang[d][1] or ""))]
    right = sum(rows[d][1] == lang[d][0] for d in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r[2] <= 1 for r in rows.values()) and len(rows) == len(documents)


def test_op7(spark, documents):
    assert by_id(got(spark, "op7_simhash"), "fingerprint", "component_id") == brute.simhash([r[:2] for r in documents])


def test_op8(spark):
    import re
    pages = dict(duck(SF).execute("SELECT page_id, html FROM pages").fetchall())
    rows = got(spark, "op8_html_extraction")
    assert len(rows) == len(pages)
    import html
    for r in rows:
        inner = re.search(r"(?s)<article>(.*?)(?:</article>|$)", pages[r["page_id"]])[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_op10(spark, documents):
    want = brute.pieces([r[:2] for r in documents], public_tokenizers.path("piece_bpe_32k.model"))
    assert by_id(got(spark, "op10_sentencepiece"), "n_tokens", "ids_sha256", "decoded_sha256") == want
