"""Request validation (ING-01..ING-03): what the reference's HTTP handlers
check, re-aimed as batch or stream validation with a rejects output.

Every function returns all requests with ``status`` (``accepted`` or
``rejected``), ``reason`` (NULL when accepted) and the record that an
accepted request emits: its key and value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import block_event_text, parse_uint64, repeatable_id
from ..functions.text import unicode_trim

# --- fixed values -----------------------------------------------------------
BAD_WORD_KEY = "bad-word"
REASON_EMPTY_WORD = "Bad word is empty"
REASON_ACTION = "Action must be: block or unblock"
REASON_SELF = "userID is equal blockUID"
REASON_FROM = "from_uid is not int"
REASON_TO = "to_uid is not int"
REASON_TEXT = "text is empty"
# ---------------------------------------------------------------------------


def _status(reason: Column) -> Column:
    return F.when(reason.isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))


def _given(col: str) -> Column:
    """A request parameter; one that is missing is the empty string."""
    return F.coalesce(F.col(col), F.lit(""))


def validate_bad_words(requests: DataFrame, word_col: str = "word") -> DataFrame:
    """ING-01: trimmed word must be non-blank; accepted words are emitted
    under one fixed key (the dictionary's single topic key)."""
    w = unicode_trim(_given(word_col))
    reason = F.when(w == "", F.lit(REASON_EMPTY_WORD))
    return requests.select(
        "*", w.alias("clean_word"), reason.alias("reason"), _status(reason).alias("status"),
        F.when(reason.isNull(), F.lit(BAD_WORD_KEY)).alias("emit_key"))


def validate_block_requests(requests: DataFrame, action_col: str = "action",
                            user_col: str = "user_id", target_col: str = "block_uid") -> DataFrame:
    """ING-02: action in (block, unblock) and not blocking oneself; accepted
    requests emit ``action:user:target`` keyed by user (FN-09)."""
    a, u, t = _given(action_col), _given(user_col), _given(target_col)
    reason = (F.when(~a.isin("block", "unblock"), F.lit(REASON_ACTION))
              .when(u == t, F.lit(REASON_SELF)))
    return requests.select(
        "*", reason.alias("reason"), _status(reason).alias("status"),
        F.when(reason.isNull(), u).alias("emit_key"),
        F.when(reason.isNull(), block_event_text(a, u, t)).alias("event"))


def validate_messages(requests: DataFrame, from_col: str = "from_uid", to_col: str = "to_uid",
                      text_col: str = "text", id_cols: list[str] | None = None) -> DataFrame:
    """ING-03: both ids unsigned 64-bit integers, trimmed text non-blank.

    Ids come out as canonical decimal strings; the trimmed text replaces the
    raw text.  With ``id_cols`` an id is derived from that natural key
    (FN-13, repeatable) and used as the emit key.
    """
    f, t = parse_uint64(from_col), parse_uint64(to_col)
    text = unicode_trim(text_col)
    reason = (F.when(f.isNull(), F.lit(REASON_FROM))
              .when(t.isNull(), F.lit(REASON_TO))
              .when(F.coalesce(text, F.lit("")) == "", F.lit(REASON_TEXT)))
    cols = [c for c in requests.columns if c not in (from_col, to_col, text_col)]
    out = requests.select(*cols, f.alias("from_user_id"), t.alias("to_user_id"),
                          F.when(reason.isNull(), text).alias("text"),
                          reason.alias("reason"), _status(reason).alias("status"))
    if id_cols:
        mid = repeatable_id(*id_cols)
        out = out.withColumn("id", F.when(F.col("reason").isNull(), mid)) \
                 .withColumn("emit_key", F.col("id").cast("string"))
    return out
