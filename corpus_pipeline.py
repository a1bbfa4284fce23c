"""The corpus pipeline: language ID, line dedup, SimHash near-dedup,
mixing to target weights, SentencePiece encoding.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and gives a DataFrame, which is written as Parquet and read again
as the next one's ``docs``.  All but the last give the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfold.llm import language_id, line_dedup, mixing, sentencepiece_codec, simhash
from streamfold.llm.common import table
from streamfold.llm.queries import PIECE_MODEL
from streamfold.session import scratch_path

ORACLE_SQL = None       # naive Bayes, XXH64 and SentencePiece have no SQL form


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents whose language can't be determined go (no
    text, no letters, or a score under one half).  The model is learned from
    the labelled documents of the ``documents`` table; rows stay unchanged."""
    labelled = table(spark, sf_dir, "documents", "doc_id", "text", "lang").filter(~language_id.held_out())
    return language_id.accepted(docs, language_id.fit(labelled))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: later occurrences of three-line windows are cut out;
    ``n_chars`` follows the text.  Documents that lose all their text go."""
    cols = docs.columns
    out = line_dedup.dedup_lines(docs, report=True)
    emptied = (F.col("_sf_removed") > 0) & (F.length(F.trim("text")) == 0)
    return (out.withColumn("n_chars", F.when(F.col("_sf_removed") > 0, F.length("text").cast("bigint"))
                           .otherwise(F.col("n_chars")))
            .filter(~emptied).select(*[F.col(f"`{c}`") for c in cols]))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7, 4-word shingles and 4 bits: one document per group stays."""
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: every document as often as the mix takes it."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: doc_id, ids and the text they decode to."""
    return sentencepiece_codec.encode(docs, public_tokenizers.path(PIECE_MODEL))


STAGES = [("language ID", identify_language), ("line dedup", dedup_lines), ("SimHash near-dedup", dedup_near),
          ("mixing sources", mix_sources), ("SentencePiece encoding", encode_pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    root = scratch_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{k}")
    return docs
