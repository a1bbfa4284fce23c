"""Per-record maps (FN-01, FN-02, FN-14, FN-15), fan-out (SNK-05, FN-16)
and the keyed JSON round trip (COD-01..COD-04, SNK-01, SNK-02)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codecs import encode_json, int64_codec, string_codec
from ..functions.text import rune_upper
from ..functions.timefmt import epoch_nanos, format_message, nanos_to_timestamp


def square(df: DataFrame, col: str, out: str = "squared") -> DataFrame:
    """FN-01 (ANSI arithmetic: overflow raises rather than wraps)."""
    return df.withColumn(out, F.col(col) * F.col(col))


def square_encoded(records: DataFrame, value_col: str = "value") -> DataFrame:
    """FN-01 after COD-04: decode text integers, square the ones that parse."""
    n = int64_codec(value_col)
    return records.select("*", n.alias("n")).filter(F.col("n").isNotNull()) \
                  .withColumn("squared", F.col("n") * F.col("n"))


def upper_text(df: DataFrame, col: str, out: str = "upper_text") -> DataFrame:
    """FN-02: upper-case rune by rune."""
    return df.withColumn(out, rune_upper(col))


def payload_messages_from(df: DataFrame, id_col: str, payload_col: str, ts_col: str
                          ) -> DataFrame:
    """SRC-13 shape over a table: ``(id, payload, ts)`` with ts in ns (FN-14)."""
    return df.select(F.col(id_col).alias("id"), F.col(payload_col).alias("payload"),
                     epoch_nanos(ts_col).alias("ts"))


def format_messages(msgs: DataFrame) -> DataFrame:
    """FN-15 text form, and FN-14 back from ns to a timestamp."""
    return msgs.select("id", "payload", "ts",
                       format_message("id", "payload", "ts").alias("text"),
                       nanos_to_timestamp("ts").alias("sent_at"))


def fan_out(df: DataFrame, topics: list[str]) -> DataFrame:
    """SNK-05: every record once per topic (one Kafka write with a ``topic``
    column; for independent failure run one query per topic)."""
    return df.withColumn("topic", F.explode(F.array(*[F.lit(t) for t in topics])))


def to_records(df: DataFrame, key_col: str | None, value_cols: list[str]) -> DataFrame:
    """SNK-01 / SNK-02: ``(key, value)`` rows for the Kafka sink; without a
    key the broker picks the partition."""
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), encode_json(*value_cols).alias("value"))


def header_values(records: DataFrame, names: list[str]) -> DataFrame:
    """SRC-06: the named record headers as text columns ``header_<name>``
    (NULL when a record has no such header; the last of repeated ones)."""
    def last(name: str):
        hits = F.filter("headers", lambda h: h["key"] == name)
        return F.try_element_at(hits, F.lit(-1))["value"]
    return records.select("*", *[string_codec(last(n)).alias(f"header_{n}") for n in names])
