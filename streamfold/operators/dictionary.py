"""Bad-word dictionary: fold word events into a deduplicated word-to-mask
table (AGG-03, FN-03, FN-04, FLT-01) and look words up (JOIN-05, FN-05).

Keyed by word, not by one fixed key as the reference stores it, so there
is no hot key and no ever-growing single state value (SURVEY §3.2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LETTER_RUN, normalize_word, word_mask


def bad_word_dictionary(word_events: DataFrame, word_col: str = "word") -> DataFrame:
    """``(word, mask)``, one row per distinct normalised, non-blank word.

    ``distinct`` is a hash aggregate with map-side partial aggregation, so a
    word repeated a billion times costs one row per task before the shuffle.
    """
    w = normalize_word(word_col).alias("word")
    return (word_events.select(w).filter(F.col("word") != "").distinct()
            .select("word", word_mask("word").alias("mask")))


def unmatchable_words(dictionary: DataFrame) -> DataFrame:
    """Q4: stored words that can never match (they contain a non-letter)."""
    return dictionary.filter(~F.col("word").rlike("^" + LETTER_RUN + "$"))


def lookup_words(requests: DataFrame, dictionary: DataFrame, word_col: str = "word"
                 ) -> DataFrame:
    """JOIN-05 / FN-05: per requested word, its mask and whether it is listed.

    The request is normalised the same way as stored words; blank requests
    are never found.  Left join, so every request gets exactly one row.
    """
    req = requests.withColumn("_sf_key", normalize_word(word_col))
    d = dictionary.select(F.col("word").alias("_sf_key"), F.col("mask"))
    return (req.join(d, "_sf_key", "left")
            .withColumn("found", F.col("mask").isNotNull())
            .drop("_sf_key"))
