"""Identifier helpers (FN-09, FN-11..FN-13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
UINT64_MAX = "18446744073709551615"
EVENT_SEPARATOR = ":"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_uint64(col) -> Column:
    """FN-12: an unsigned 64-bit decimal, as its canonical decimal string.

    Digits only (no sign, no blanks), value at most 2^64-1; anything else
    gives NULL.  Leading zeros are dropped (``007`` -> ``7``).
    """
    s = _c(col)
    as_dec = s.try_cast("decimal(20,0)")
    ok = s.rlike(r"^[0-9]+\z") & (as_dec <= F.lit(UINT64_MAX).cast("decimal(20,0)"))
    return F.when(ok, as_dec.cast("string"))


def block_event_text(action, user_id, blocked_id) -> Column:
    """FN-09: ``action:user:blocked``; NULL when a part is."""
    sep = F.lit(EVENT_SEPARATOR)
    return F.concat(_c(action), sep, _c(user_id).cast("string"), sep, _c(blocked_id).cast("string"))


def repeatable_id(*cols) -> Column:
    """FN-13: a 64-bit id from a natural key (repeatable, unlike a random id)."""
    return F.xxhash64(*[_c(c) for c in cols])


def topic_name(prefix, schema, table) -> Column:
    """FN-16: ``<prefix>.<schema>.<table>`` of text or columns."""
    return F.concat_ws(".", *[F.lit(x) if isinstance(x, str) else x for x in (prefix, schema, table)])
