"""Epoch helpers and message formatting (FN-14, FN-15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
MESSAGE_FORMAT = 'Message{ID:%d, Payload:"%s", Ts:%d}'
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utc_instant(ts) -> Column:
    """A ``TIMESTAMP_NTZ`` wall clock read as UTC, as an instant
    (``TIMESTAMP``), whatever the session time zone is.  A plain cast
    would read it in the session zone."""
    local_wall = F.convert_timezone(F.lit("UTC"), F.current_timezone(), _c(ts).cast("timestamp_ntz"))
    return local_wall.cast("timestamp")


def utc_wall_clock(ts) -> Column:
    """An instant (``TIMESTAMP``) as its UTC wall clock (``TIMESTAMP_NTZ``)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(ts).cast("timestamp_ntz"))


def epoch_micros(ts) -> Column:
    """Microseconds since the epoch; NTZ values are UTC wall clocks."""
    return F.unix_micros(utc_instant(ts))


def epoch_nanos(ts) -> Column:
    """Nanoseconds since the epoch of a timestamp (microsecond precision)."""
    return epoch_micros(ts) * F.lit(1000)


def now_nanos() -> Column:
    return F.unix_micros(F.current_timestamp()) * F.lit(1000)


def nanos_to_timestamp(col) -> Column:
    """Back from nanoseconds: floor to microseconds, as TIMESTAMP_NTZ (UTC)."""
    # Decimal arithmetic: a double cannot hold 19-digit nanosecond counts.
    micros = F.floor(_c(col).cast("decimal(20,0)") / F.lit(1000)).cast("bigint")
    return utc_wall_clock(F.timestamp_micros(micros))


# --- fixed values -----------------------------------------------------------
# Escapes of a double-quoted literal: named ones, then \xNN, \uNNNN or
# \UNNNNNNNN for every other character that is not printable (controls,
# formats, unassigned, and separators but the blank).
UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"
NAMED_ESCAPES = {"\a": "\\a", "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r",
                 "\t": "\\t", "\v": "\\v"}
# ---------------------------------------------------------------------------


def _escape(ch: Column) -> Column:
    """One character as a double-quoted literal prints it."""
    code = F.ascii(ch)
    out = F.when(ch.isin("\\", '"'), F.concat(F.lit("\\"), ch))
    for c, esc in NAMED_ESCAPES.items():
        out = out.when(ch == c, F.lit(esc))
    digits = F.lower(F.hex(code))
    return (out.when(~ch.rlike(UNPRINTABLE), ch)
            .when(code < 0x80, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
            .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
            .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0"))))


def quote_text(col) -> Column:
    """Escape the way a double-quoted literal is printed: backslash, quote
    and every character that is not printable.  Texts without any, nearly
    all, are passed through after one search."""
    c = _c(col)
    slow = F.array_join(F.transform(F.split(c, ""), _escape), "")
    return F.when(c.rlike('[\\\\"]|' + UNPRINTABLE), slow).otherwise(c)


def format_message(id_col, payload_col, ts_col) -> Column:
    """FN-15: ``Message{ID:<id>, Payload:"<payload>", Ts:<ts>}``."""
    return F.format_string(MESSAGE_FORMAT, _c(id_col), quote_text(payload_col), _c(ts_col))
