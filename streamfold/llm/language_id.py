"""Language ID (operator 5): multinomial naive Bayes over hashed character
n-grams.

Training counts are summed per task into a languages x buckets matrix,
then by (language, bucket) across tasks; the log-probability matrix, whose
size is bounded by ``MAX_LANGS`` x ``BUCKETS``, is broadcast and texts are
scored batch by batch in numpy from their sparse n-gram counts.

All labelled rows of the given training set are counted, no sample.

Defined results: ``und`` with score 0 for a null text, a text without
letters, or when nothing was learned; ties go to the first language by
code point; rows with a null language or text are not learned from; more
than ``MAX_LANGS`` languages raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import map_batches, ship

BUCKETS = 1 << 15
MAX_LANGS = 500
ORDERS = (1, 2, 3)
ALPHA = 0.5                 # added to every count
PIECE = 1 << 18             # characters scored at a time
UNDETERMINED = "und"


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the id mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))


def ngram_buckets(text: str) -> np.ndarray:
    """Hash buckets of all character n-grams of the lower-cased text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out, h = [], np.zeros(len(c), dtype=np.uint64)
    for n in ORDERS:
        if len(c) < n:
            break
        h = (h[:len(c) - n + 1] + c[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        out.append((h >> np.uint64(40)) & np.uint64(BUCKETS - 1))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def _pieces(text: str):
    """Parts of at most PIECE characters that overlap so that every n-gram
    is met; n-grams inside an overlap count twice, alike in training and
    scoring."""
    step = PIECE - max(ORDERS) + 1
    for a in range(0, max(1, len(text)), step):
        yield text[a:a + PIECE]


def bucket_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sparse n-gram counts of a text: buckets and counts."""
    if len(text) <= 400:
        return np.unique(ngram_buckets(text), return_counts=True)
    total = None
    for p in _pieces(text):
        got = np.bincount(ngram_buckets(p), minlength=BUCKETS)
        total = got if total is None else total + got
    at = np.flatnonzero(total)
    return at, total[at]


def train_counts(docs: DataFrame, langs: list[str], lang_col: str, text_col: str) -> np.ndarray:
    """Counts as a len(langs) x BUCKETS matrix.  At most that many numbers
    reach the driver, however many documents there are."""
    ship()
    at = {x: i for i, x in enumerate(langs)}

    def run(batches):
        m = np.zeros((len(at), BUCKETS), dtype=np.int64)
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k, n = bucket_counts(text)
                m[at[lang], k] += n
        li, bi = np.nonzero(m)
        yield pa.RecordBatch.from_arrays([pa.array(li * BUCKETS + bi, pa.int64()), pa.array(m[li, bi], pa.int64())],
                                         ["cell", "n"])
    rows = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")).dropna()
    cells = rows.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    m = np.zeros(len(at) * BUCKETS, dtype=np.float64)
    m[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return m.reshape(len(at), BUCKETS)


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages, log-probability matrix buckets x languages) of labelled
    documents.  Priors are even: the mix of languages in the training set
    says nothing about a single text."""
    lang = F.col(f"`{lang_col}`")
    found = docs.filter(lang.isNotNull()).select(lang.alias("l")).distinct().limit(MAX_LANGS + 1).collect()
    if len(found) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = sorted(r.l for r in found)
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    m = train_counts(docs, langs, lang_col, text_col) + ALPHA
    return langs, np.ascontiguousarray(np.log(m / m.sum(axis=1, keepdims=True)).T.astype(np.float32))


def score_text(text: str | None, langs: list[str], logp: np.ndarray) -> tuple[str, float]:
    if not text or not langs or not any(map(str.isalpha, text)):
        return UNDETERMINED, 0.0
    k, n = bucket_counts(text)
    s = n.astype(np.float64) @ logp[k]
    best = int(np.argmax(s))
    return langs[best], float(1.0 / np.exp(s - s[best]).sum())


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text",
            carry: tuple[str, ...] = (), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``carry`` columns, language and score (``names``) of every document."""
    langs, logp = model
    shared = docs.sparkSession.sparkContext.broadcast(logp)
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text_col}`").alias("_sf_text"))

    def run(b: pa.RecordBatch):
        got = [score_text(t, langs, shared.value) for t in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
            [*b.schema.names[:-1], *names])
    return map_batches(rows, run, StructType([*rows.schema.fields[:-1], StructField(names[0], StringType()),
                                              StructField(names[1], DoubleType())]))


def accepted(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text",
             min_score: float = 0.5) -> DataFrame:
    """The documents whose language is determined with at least
    ``min_score``; all columns, unchanged."""
    cols = docs.columns
    full = predict(docs, model, text_col, carry=tuple(cols), names=("_sf_lang", "_sf_score"))
    keep = (full["_sf_lang"] != UNDETERMINED) & (full["_sf_score"] >= min_score)
    return full.filter(keep).select(*[F.col(f"`{c}`") for c in cols])
