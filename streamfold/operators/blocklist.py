"""Block lists: parse ``action:blocker:blocked`` events (FN-08, FLT-02,
FLT-03), fold them into the current set per user (AGG-04), look a user up
(JOIN-06) and report malformed events (COD-05/06).

The fold keeps the *last action per (user, blocked) pair* rather than a
set, because a set cannot forget (unblock).  ``max_by`` is a hash
aggregate with partial aggregation: a user with millions of events is
reduced map-side, and the pair key spreads one user's pairs over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codecs import split_rejects

# --- fixed values -----------------------------------------------------------
ACTIONS = ("block", "unblock")
REASON_FORMAT = "invalid format"
REASON_ACTION = "unknown action"
# ---------------------------------------------------------------------------


def event_reason(value_col: str = "value"):
    """Why a block event is malformed, or NULL."""
    parts = F.split(F.col(value_col), ":", -1)
    return (F.when(F.col(value_col).isNull() | (F.size(parts) != 3), F.lit(REASON_FORMAT))
            .when(~parts.getItem(0).isin(*ACTIONS), F.lit(REASON_ACTION)))


def tag_block_events(events: DataFrame) -> DataFrame:
    """Every event with its reason (NULL: valid) and, where valid, its parts:
    what ``parse_block_events`` gives as two tables, in one."""
    p = F.split("value", ":", -1)
    part = [F.when(F.col("reason").isNull(), F.get(p, F.lit(i))) for i in range(3)]
    return events.withColumn("reason", event_reason()).select(
        "key", "value", "offset", "reason", F.when(F.col("reason").isNull(), F.col("key")).alias("user_id"),
        part[0].alias("action"), part[1].alias("blocker_id"), part[2].alias("blocked_id"))


def set_changes(parsed: DataFrame) -> DataFrame:
    """AGG-04 as a log: the events that alter their user's set of blocked
    ids (a block of an id that is blocked already, and an unblock of one that
    is not, alter nothing), as ``user_id, blocked_id, offset, change``.  An
    id's events are few; a user's many are spread by pair."""
    w = Window.partitionBy("user_id", "blocked_id").orderBy("offset")
    before = F.coalesce(F.lag("action").over(w), F.lit("unblock"))
    return (parsed.withColumn("_sf_before", before).filter(F.col("action") != F.col("_sf_before"))
            .select("user_id", "blocked_id", "offset",
                    F.when(F.col("action") == "block", F.lit("added")).otherwise(F.lit("removed")).alias("change")))


def parse_block_events(events: DataFrame, key_col: str = "key", value_col: str = "value",
                       offset_col: str = "offset", extra: tuple[str, ...] = ()
                       ) -> tuple[DataFrame, DataFrame]:
    """Split into valid events ``(user_id, action, blocker_id, blocked_id,
    offset)`` and rejects ``(key, value, offset, reason)``.

    The state key is the record key (Q10); ``blocker_id`` from the text is
    kept so that mismatches can be flagged.
    """
    good, bad = split_rejects(events, event_reason(value_col), keep=[key_col, value_col, offset_col])
    p = F.split(F.col(value_col), ":", -1)
    good = good.select(F.col(key_col).alias("user_id"), p.getItem(0).alias("action"),
                       p.getItem(1).alias("blocker_id"), p.getItem(2).alias("blocked_id"),
                       F.col(offset_col).alias("offset"), *extra)
    return good, bad


def block_pair_state(parsed: DataFrame) -> DataFrame:
    """Last action per ``(user_id, blocked_id)``, with the offset it came at.

    The action is folded as a 0/1 flag so that the aggregation buffer is
    fixed-width and Spark plans a hash aggregate (a string buffer would
    force a sort-based one)."""
    flag = (F.col("action") == "block").cast("int")
    agg = parsed.groupBy("user_id", "blocked_id").agg(
        F.max_by(flag, F.col("offset")).alias("_sf_block"), F.max("offset").alias("offset"))
    return agg.select("user_id", "blocked_id",
                      F.when(F.col("_sf_block") == 1, F.lit("block")).otherwise(F.lit("unblock"))
                      .alias("last_action"), "offset")


def block_list(parsed: DataFrame) -> DataFrame:
    """AGG-04: ``(user_id, blocked_id)`` for every current block, plus
    ``(user_id, NULL)`` for users that have a (possibly emptied) store but no
    current block (Q8).  Flat rows: a user's set is never collected into one
    value."""
    return block_list_from_state(block_pair_state(parsed))


def block_list_from_state(state: DataFrame) -> DataFrame:
    """``block_list`` from the pair-state table ``(user_id, blocked_id,
    last_action)`` (the table a stream keeps in its state)."""
    pairs = state.filter(F.col("last_action") == "block").select("user_id", "blocked_id")
    empty_users = (state.groupBy("user_id")
                   .agg(F.max((F.col("last_action") == "block").cast("int")).alias("_sf_any"))
                   .filter(F.col("_sf_any") == 0)
                   .select("user_id", F.lit(None).cast("string").alias("blocked_id")))
    return pairs.unionByName(empty_users)


def current_blocks(parsed: DataFrame) -> DataFrame:
    """Only the current ``(user_id, blocked_id)`` block pairs."""
    return (block_pair_state(parsed).filter(F.col("last_action") == "block")
            .select("user_id", "blocked_id"))


def key_mismatches(parsed: DataFrame) -> DataFrame:
    """Q10: events whose text names a different blocker than the record key."""
    return parsed.filter(F.col("user_id") != F.col("blocker_id"))


def lookup_user_blocks(requests: DataFrame, blocks: DataFrame, user_col: str = "user_id"
                       ) -> DataFrame:
    """JOIN-06: per requested user, one row per blocked id.

    ``status`` is ``found`` when the user has a store (even an empty one;
    then ``blocked_id`` is NULL) and ``not_found`` otherwise.

    Written as an inner join plus an anti join rather than one left outer
    join: a user with a huge block list is a hot key on the right side,
    and AQE can split a skewed partition on either side of an inner join,
    but only on the left side of a left outer join.
    """
    b = blocks.select(F.col("user_id").alias("_sf_u"), "blocked_id")
    found = (requests.join(b, requests[user_col] == b["_sf_u"], "inner").drop("_sf_u")
             .withColumn("status", F.lit("found")))
    users = blocks.select(F.col("user_id").alias("_sf_u")).distinct()
    missing = (requests.join(users, requests[user_col] == users["_sf_u"], "left_anti")
               .withColumn("blocked_id", F.lit(None).cast("string"))
               .withColumn("status", F.lit("not_found")))
    return found.unionByName(missing)
