"""Codecs (COD-01..COD-07): typed JSON decode with a corrupt-record column,
encode, string and integer codecs, and the good/rejects split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

CORRUPT = "_corrupt"
# Timestamps travel with full microsecond precision (the defaults print
# milliseconds only, which would make encode/decode lossy).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_corrupt_field(schema: StructType | str) -> StructType | str:
    if isinstance(schema, str):
        return schema if CORRUPT in schema else f"{schema}, {CORRUPT} STRING"
    if CORRUPT in schema.fieldNames():
        return schema
    return StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])


def decode_json(col, schema: StructType | str) -> Column:
    """COD-01: typed JSON decode.  The result struct carries ``_corrupt``,
    set (to the raw text) when the value is not JSON, is ``null`` or has a
    field of the wrong type; missing fields are NULL."""
    text = _c(col).cast("string")
    return F.from_json(text, with_corrupt_field(schema),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **JSON_OPTIONS})


REASON_EMPTY = "no value"
REASON_TYPE = "not of the declared type"


def record_reason(raw, decoded) -> Column:
    """COD-05/COD-06: why a record is set aside, or NULL: it has no value, or
    ``decoded`` (of ``decode_json``) is corrupt."""
    return (F.when(_c(raw).isNull(), F.lit(REASON_EMPTY))
            .when(_c(decoded).getField(CORRUPT).isNotNull(), F.lit(REASON_TYPE)))


# --- fixed values -----------------------------------------------------------
# Zero value per simple type, used where a missing JSON field must read as
# the zero value rather than NULL (Q21).
ZERO_BY_TYPE = {"bigint": 0, "int": 0, "smallint": 0, "tinyint": 0, "double": 0.0,
                "float": 0.0, "string": "", "boolean": False}
# ---------------------------------------------------------------------------


def zero_filled(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Q21: missing (NULL) values of simple-typed columns read as their zero
    value; only ``fields`` when given.  Use after ``decode_json`` for keys
    that are optional; the ``_corrupt`` column is left alone."""
    out = []
    for f in df.schema.fields:
        zero = ZERO_BY_TYPE.get(f.dataType.simpleString())
        if f.name != CORRUPT and zero is not None and (fields is None or f.name in fields):
            out.append(F.coalesce(F.col(f.name), F.lit(zero).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def encode_json(*cols, pretty: bool = False) -> Column:
    """COD-02 / COD-07: ``to_json(struct(...))``, optionally indented."""
    opts = dict(JSON_OPTIONS, **({"pretty": "true"} if pretty else {}))
    return F.to_json(F.struct(*[_c(c) for c in cols]), opts)


CSV_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', **JSON_OPTIONS}


def decode_csv(col, schema: str) -> Column:
    """UDF-04: the same contract as ``decode_json`` for one line of comma
    separated values; ``schema`` is a DDL string."""
    return F.from_csv(_c(col).cast("string"), with_corrupt_field(schema), CSV_OPTIONS)


def encode_csv(*cols) -> Column:
    """UDF-04: one line of comma separated values."""
    return F.to_csv(F.struct(*[_c(c) for c in cols]), {"escape": '"', **JSON_OPTIONS})


CODECS = {"json": (encode_json, decode_json), "csv": (encode_csv, decode_csv)}


def string_codec(col) -> Column:
    """COD-03: bytes to text."""
    return _c(col).cast("string")


def int64_codec(col) -> Column:
    """COD-04: text to BIGINT; NULL when not an integer."""
    return _c(col).cast("string").try_cast("bigint")


def split_rejects(df: DataFrame, reason: Column, keep: list[str] | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """COD-05/COD-06: split ``df`` on ``reason IS NULL`` into good rows and
    rejects.  Both sides are lazy projections of the same plan, so writing
    both re-reads the input rather than holding it in memory."""
    tagged = df.withColumn("reason", reason)
    good = tagged.filter(F.col("reason").isNull()).drop("reason")
    bad = tagged.filter(F.col("reason").isNotNull())
    if keep is not None:
        bad = bad.select(*keep, "reason")
    return good, bad
