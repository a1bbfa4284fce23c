"""Message censoring (JOIN-01..JOIN-04, FLT-04, FN-06, FN-07).

Order of work follows the reference: drop messages whose sender the
receiver has blocked, then mask listed words in the rest.

A short list of words goes to every task as a set.  For a longer one,
masking depends on the text alone: the distinct words of each text that may
be listed (a filter of fixed size tells, before anything is shuffled) meet
the dictionary in one join of any size, and the words that hit are gathered
per text (keyed by digest) and masked where the message is.  Messages that
repeat, or share every other column, stay what they are.  No hint and no job
at plan time: the way is chosen while the query runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LETTER_RUN, is_letter_run, mask_words, mask_words_if, word_buckets
from ..functions.timefmt import epoch_micros
from .scan import running_last

SET_WORDS = 1 << 16             # listed words that go to every task as a set
SET_CHARS = 64                  # characters of the longest of them
SET_SLOTS = 1 << 13
FILTER_BITS = 1 << 21           # of the filter before the join: 256 KB
# Pairs with more rows than this are cut into chunks of one minute in the
# as-of scan; all others are scanned whole and carry nothing.
REPLAY_HOT_ROWS = 100_000
REPLAY_SPAN_MICROS = 60 * 1_000_000


def _join_blocks(messages: DataFrame, blocks: DataFrame, how: str) -> DataFrame:
    b = blocks.select(F.col("user_id").alias("_sf_to"), F.col("blocked_id").alias("_sf_from"))
    cond = (messages["to_user_id"] == b["_sf_to"]) & (messages["from_user_id"] == b["_sf_from"])
    return messages.join(b, cond, how)


def drop_blocked(messages: DataFrame, blocks: DataFrame) -> DataFrame:
    """JOIN-01 / FLT-04: left anti join on (receiver, sender)."""
    return _join_blocks(messages, blocks, "left_anti")


def blocked_messages(messages: DataFrame, blocks: DataFrame) -> DataFrame:
    """Q1 rejects: the messages ``drop_blocked`` removes."""
    return _join_blocks(messages, blocks, "left_semi")


def matchable(dictionary: DataFrame) -> DataFrame:
    """Only words that are one letter run can ever match (Q4)."""
    return dictionary.filter(is_letter_run("word"))


def _dense(rows: DataFrame, n: int, value: Column) -> Column:
    """One array of ``n`` values, that of slot i at i, from rows with a
    ``slot``: a scalar subquery, whose size ``n`` and ``value`` bound."""
    spark = rows.sparkSession
    every = rows.unionByName(spark.range(n).select(F.col("id").alias("slot")), allowMissingColumns=True)
    slots = every.groupBy("slot").agg(value.alias("v"))
    return slots.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "v"))), lambda s: s["v"])).scalar()


def word_set(words: DataFrame) -> Column:
    """``words`` (at most ``SET_WORDS``) in ``SET_SLOTS`` lists by hash."""
    short = F.when(F.char_length("word") <= SET_CHARS, F.col("word"))
    return _dense(words.select(F.pmod(F.hash("word"), F.lit(SET_SLOTS)).cast("bigint").alias("slot"), short.alias("word")),
                  SET_SLOTS, F.collect_list("word"))


def in_set(words: Column) -> Callable[[Column], Column]:
    return lambda w: F.array_contains(F.get(words, F.pmod(F.hash(w), F.lit(SET_SLOTS))), w)


def word_bits(words: DataFrame) -> Column:
    """``FILTER_BITS`` bits, in which the one of each word's hash is set: a
    filter of fixed size for a list of any size."""
    at = F.xxhash64("word").bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = words.select(at.alias("at")).select(
        F.shiftright("at", 6).alias("slot"), F.expr("shiftleft(1L, CAST(at & 63 AS INT))").alias("bit"))
    return _dense(rows, FILTER_BITS // 64, F.coalesce(F.bit_or("bit"), F.lit(0).cast("bigint")))


def may_be_listed(bits: Column) -> Callable[[Column], Column]:
    """Whether a word's bit is set: false only for words that are not listed."""
    def test(w: Column) -> Column:
        at = F.xxhash64(w).bitwiseAND(F.lit(FILTER_BITS - 1))
        return F.getbit(F.get(bits, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1
    return test


def mask_by_set(messages: DataFrame, listed: DataFrame, text_col: str = "text") -> DataFrame:
    """JOIN-02: masking with the whole list as a set in every task; no
    message and no word is shuffled.  ``listed`` is bounded by the caller."""
    # A subquery may not stand inside a lambda; as a column of its own it may,
    # and the optimizer puts it there (it is not copied into any row).
    masked = mask_words_if(F.col(text_col), in_set(F.col("_sf_set")))
    return messages.select("*", word_set(listed).alias("_sf_set")).select(
        *[masked.alias(c) if c == text_col else F.col(c) for c in messages.columns])


def mask_by_join(messages: DataFrame, listed: DataFrame, text_col: str = "text") -> DataFrame:
    """JOIN-03: exact masking for a list of any size.  The words of a text
    are looked up once per distinct word, and only those whose bit is set
    in a filter of the list leave the task; the join then is exact."""
    cols, text = messages.columns, F.col(text_col)
    keyed = messages.withColumn("_sf_key", F.unhex(F.sha2(text, 256)))
    runs = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(LETTER_RUN), 0), F.lower))
    words = keyed.select("_sf_key", F.explode(runs).alias("_sf_word")).filter(may_be_listed(word_bits(listed))(F.col("_sf_word")))
    hits = (words.join(listed.select(F.col("word").alias("_sf_word")), "_sf_word", "left_semi")
            .groupBy("_sf_key").agg(F.collect_set("_sf_word").alias("_sf_words"))
            .select("_sf_key", word_buckets(F.col("_sf_words")).alias("_sf_words")))
    masked = F.when(F.col("_sf_words").isNull(), text).otherwise(mask_words(text, F.col("_sf_words")))
    return keyed.join(hits, "_sf_key", "left").select(
        *[masked.alias(c) if c == text_col else F.col(c) for c in cols])


def mask_messages(messages: DataFrame, dictionary: DataFrame, text_col: str = "text",
                  set_words: int = SET_WORDS) -> DataFrame:
    """JOIN-02, JOIN-03: masking for a dictionary of any size.  A list of up
    to ``set_words`` words (of up to ``SET_CHARS`` characters) goes to every
    task as a set, a longer one is joined.  Which it is shows while the query
    runs: each way starts with a semi join with one row or none, and AQE
    drops the way with none, its scan included."""
    listed = matchable(dictionary).select("word")
    few = listed.limit(set_words + 1)
    small = (F.count(F.lit(1)) <= set_words) & (F.coalesce(F.max(F.char_length("word")), F.lit(0)) <= SET_CHARS)
    size = few.agg(small.alias("small"))
    by_set = messages.join(size.filter("small"), F.lit(True), "left_semi")
    by_join = messages.join(size.filter("not small"), F.lit(True), "left_semi")
    return mask_by_set(by_set, few, text_col).unionByName(mask_by_join(by_join, listed, text_col))


def censor_messages(messages: DataFrame, blocks: DataFrame, dictionary: DataFrame,
                    text_col: str = "text", set_words: int = SET_WORDS) -> DataFrame:
    """The censor: drop blocked messages, mask listed words in the rest.

    ``messages`` needs ``to_user_id``, ``from_user_id`` and the text;
    ``blocks`` is ``(user_id, blocked_id)``; ``dictionary`` is ``(word, mask)``.
    """
    return mask_messages(drop_blocked(messages, blocks), dictionary, text_col, set_words)


def replay_blocks_asof(messages: DataFrame, block_events: DataFrame,
                       span_micros: int = REPLAY_SPAN_MICROS, hot_rows: int = REPLAY_HOT_ROWS) -> DataFrame:
    """JOIN-04: each message judged by the block state of its (receiver,
    sender) pair at the message's time; ties are broken by offset.

    ``messages``: id, from_user_id, to_user_id, ts, offset.
    ``block_events``: parsed events with user_id, blocked_id, action, ts, offset.
    Returns the delivered messages with ``block_state`` (last action before
    them, or NULL).  The union is scanned per pair, pairs above ``hot_rows``
    rows in bounded time chunks, so a hot pair does not end up in one task.
    """
    ch = block_events.select(F.col("user_id").alias("_sf_to"), F.col("blocked_id").alias("_sf_from"),
                             "ts", "offset", "action",
                             F.lit(None).cast("bigint").alias("id"))
    ms = messages.select(F.col("to_user_id").alias("_sf_to"), F.col("from_user_id").alias("_sf_from"),
                         "ts", "offset", F.lit(None).cast("string").alias("action"), "id")
    u = ch.unionByName(ms).withColumn("_sf_us", epoch_micros("ts"))
    scanned = running_last(u, ["_sf_to", "_sf_from"], "_sf_us", "action", "block_state",
                           span=span_micros, order_tiebreak=["offset"], hot_rows=hot_rows)
    return (scanned.filter(F.col("id").isNotNull()
                           & (F.col("block_state").isNull() | (F.col("block_state") != "block")))
            .select("id", F.col("_sf_from").alias("from_user_id"),
                    F.col("_sf_to").alias("to_user_id"), "ts", "block_state"))
