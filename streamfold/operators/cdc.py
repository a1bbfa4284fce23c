"""Change data capture (CDC-01..CDC-07, SRC-10, SRC-11, FLT-05).

Change records arrive as Kafka-shaped rows whose value is a change
envelope.  Row images are untyped, so they decode to ``VARIANT`` and are
projected per table with ``variant_get``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codecs import decode_json
from ..functions.timefmt import utc_wall_clock
from ..schemas import CDC_ENVELOPE
from .scan import latest_per_key

# --- fixed values -----------------------------------------------------------
OPS = {"c": "insert", "u": "update", "d": "delete", "r": "snapshot"}
# ---------------------------------------------------------------------------


def decode_changes(records: DataFrame, include: list[str] | None = None,
                   topic_prefix: str = "pg", raw: bool = False) -> DataFrame:
    """CDC-01 (+ CDC-04, FLT-05): decode key and envelope.

    Output: topic, partition, offset, key_id, op, schema, table, lsn, ts_ms,
    ts_us, source_ts_us, before, after (VARIANT), _corrupt.

    ``include`` keeps only the listed ``schema.table`` names.  It filters on
    the record's topic (``<prefix>.<schema>.<table>``) before anything is
    decoded: a filter on decoded fields would be pushed below the decode
    and parse every value twice, while a topic filter costs nothing and is
    what a Kafka source turns into its subscription.
    """
    if include:
        records = records.filter(F.col("topic").isin(*[f"{topic_prefix}.{t}" for t in include]))
    env = decode_json("value", CDC_ENVELOPE)
    key = F.from_json(F.col("key").cast("string"), "id BIGINT")
    d = records.select("topic", "partition", "offset", key.alias("k"), env.alias("e"),
                       *([F.col("value").alias("raw")] if raw else []))
    out = d.select(
        "topic", "partition", "offset", F.col("k.id").alias("key_id"),
        F.col("e.op").alias("op"), F.col("e.source.schema").alias("schema"),
        F.col("e.source.table").alias("table"), F.col("e.source.lsn").alias("lsn"),
        F.col("e.ts_ms").alias("ts_ms"), F.col("e.ts_us").alias("ts_us"),
        F.col("e.source.ts_us").alias("source_ts_us"),
        F.col("e.before").alias("before"), F.col("e.after").alias("after"),
        F.col("e._corrupt").alias("_corrupt"), *(["raw"] if raw else []))
    return out


REASON_TOMBSTONE = "tombstone"
REASON_GARBAGE = "not a change record"


def change_reason(value: str, table: str = "table", op: str = "op"):
    """Why a record is no change, or NULL."""
    return (F.when(F.col(value).isNull(), F.lit(REASON_TOMBSTONE))
            .when(F.col(table).isNull() | F.col(op).isNull(), F.lit(REASON_GARBAGE)))


def change_rejects(records: DataFrame, include: list[str] | None = None, topic_prefix: str = "pg") -> DataFrame:
    """COD-05: records without a value (tombstones) and values that do not
    decode to a change with a table and an operation; they keep topic,
    partition, offset, the raw value and a reason.  Only the two fields that
    decide are decoded."""
    if include:
        records = records.filter(F.col("topic").isin(*[f"{topic_prefix}.{t}" for t in include]))
    e = decode_json("value", "op STRING, source STRUCT<table: STRING>")
    d = records.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"), e.alias("e")).select(
        "*", F.col("e.source.table").alias("table"), F.col("e.op").alias("op"))
    return d.withColumn("reason", change_reason("value")).filter("reason is not null").drop("e", "table", "op")


def split_changes(records: DataFrame, include: list[str] | None = None,
                  topic_prefix: str = "pg") -> tuple[DataFrame, DataFrame]:
    """COD-05: (decoded changes, rejects)."""
    decoded = decode_changes(records, include, topic_prefix, raw=True).withColumn("reason", change_reason("raw"))
    return (decoded.filter("reason is null").drop("raw", "reason"),
            change_rejects(records, include, topic_prefix))


def _n_changes():
    """Number of records that are changes; tombstones and garbage are not.
    (Counted, not filtered: a filter on decoded fields would be pushed
    below the decode and parse every value twice.)"""
    return F.count(F.when(F.col("table").isNotNull() & F.col("op").isNotNull(), F.lit(1)))


def image(col: str):
    """The row image, with a JSON ``null`` image (variant null) as SQL NULL."""
    c = F.col(col)
    return F.when(c.isNull() | F.is_variant_null(c), F.lit(None)).otherwise(c)


def current_image():
    """The image after the change, or the one before a delete."""
    return F.coalesce(image("after"), image("before"))


MICROS_TIMESTAMP = "timestamp_micros"


def field(img, name: str, typ: str):
    """One typed field of a row image."""
    if typ == MICROS_TIMESTAMP:
        # Row timestamps without zone travel as microseconds of wall-clock
        # time; read them back as that wall clock.
        micros = F.variant_get(img, f"$.{name}", "bigint")
        return utc_wall_clock(F.timestamp_micros(micros))
    return F.variant_get(img, f"$.{name}", typ)


def typed_projection(decoded: DataFrame, fields: dict[str, str]) -> DataFrame:
    """CDC-02: typed columns from the current image (``after``, or
    ``before`` for deletes).  ``fields`` maps column name to SQL type, or
    to ``timestamp_micros`` for a microsecond wall clock (TIMESTAMP_NTZ)."""
    img = current_image()
    return decoded.select(
        "table", "op", "lsn", "key_id",
        *[field(img, name, typ).alias(name) for name, typ in fields.items()])


def route(decoded: DataFrame, table: str) -> DataFrame:
    """CDC-03: one table's changes."""
    return decoded.filter(F.col("table") == table)


def op_counts(decoded: DataFrame) -> DataFrame:
    """CDC-05: number of changes per table and operation."""
    return (decoded.groupBy("table", "op").agg(_n_changes().alias("n_changes")).filter("n_changes > 0")
            .withColumn("op_name", F.element_at(F.create_map(
                *[x for k, v in OPS.items() for x in (F.lit(k), F.lit(v))]), F.col("op"))))


def current_state(decoded: DataFrame, fields: dict[str, str]) -> DataFrame:
    """CDC-06: table state replayed from the log: the last change per primary
    key by ``lsn``; keys whose last change is a delete are gone.  A hash
    aggregate with partial aggregation where all ``fields`` are of fixed width."""
    return latest_state(typed_projection(decoded, fields), list(fields))


def latest_state(typed: DataFrame, fields: list[str]) -> DataFrame:
    """CDC-06 on typed changes (``typed_projection``, ``with_snapshot``)."""
    typed = typed.withColumn("_sf_live", F.col("op") != "d").drop("op")
    last = latest_per_key(typed, ["table", "key_id"], "lsn", ["_sf_live", "lsn", *fields])
    return last.filter("_sf_live").drop("_sf_live")


def with_snapshot(snapshot: DataFrame, changes: DataFrame, lsn: int = 0) -> DataFrame:
    """SRC-11: an initial table snapshot tagged ``op='r'`` followed by the
    change log; ``snapshot`` has the typed columns plus ``table`` and
    ``key_id``."""
    snap = snapshot.withColumn("op", F.lit("r")).withColumn("lsn", F.lit(lsn).cast("bigint"))
    return snap.unionByName(changes, allowMissingColumns=True)


def capture_delay(decoded: DataFrame) -> DataFrame:
    """CDC-07: per table, the delay from commit to capture in microseconds
    (exact count, mean and max)."""
    delay = (F.col("ts_us") - F.col("source_ts_us"))
    return decoded.groupBy("table").agg(
        _n_changes().alias("n_changes"),
        F.avg(delay).alias("avg_delay_us"),
        F.max(delay).alias("max_delay_us")).filter("n_changes > 0")


# Rank error of a merged sketch of 200 items (the default), with room.
QUANTILE_ERROR = 0.03


def delay_sketches(decoded: DataFrame) -> DataFrame:
    """CDC-07: a quantile sketch of the delays per table and day of commit,
    of bounded size whatever the number of changes.  Sketches can be kept
    and merged later (``merged_quantiles``)."""
    day = F.to_date(F.timestamp_micros("source_ts_us"))
    d = decoded.select("table", day.alias("day"), (F.col("ts_us") - F.col("source_ts_us")).alias("delay"))
    return (d.groupBy("table", "day").agg(F.expr("kll_sketch_agg_bigint(delay)").alias("sketch"), F.count("delay").alias("n_delays"))
            .filter("n_delays > 0"))


def merged_quantiles(sketches: DataFrame, probs=(0.5, 0.95, 0.99)) -> DataFrame:
    """(table, n_delays, probability, quantile) of all days together."""
    merged = sketches.groupBy("table").agg(F.expr("kll_merge_agg_bigint(sketch)").alias("sketch"), F.sum("n_delays").alias("n_delays"))
    each = [F.struct(F.lit(float(p)).alias("probability"), F.expr(f"kll_sketch_get_quantile_bigint(sketch, {float(p)}D)").alias("quantile"))
            for p in probs]
    return merged.select("table", "n_delays", F.explode(F.array(*each)).alias("q")).select("table", "n_delays", "q.*")


def quantile_ranks(decoded: DataFrame, quantiles: DataFrame, error: float = QUANTILE_ERROR) -> DataFrame:
    """Quantiles held against all delays: whether the exact rank of each is
    within ``error`` of its probability."""
    q = quantiles.withColumnsRenamed({"table": "_sf_table"})
    d = decoded.select("table", (F.col("ts_us") - F.col("source_ts_us")).alias("delay"))
    ranks = d.join(q, F.col("table") == F.col("_sf_table")).groupBy("table", "probability").agg(
        F.first("n_delays").alias("n_delays"), F.count_if(F.col("delay") < F.col("quantile")).alias("below"),
        F.count_if(F.col("delay") <= F.col("quantile")).alias("upto"))
    near = ((F.col("below") / F.col("n_delays") <= F.col("probability") + error)
            & (F.col("upto") / F.col("n_delays") >= F.col("probability") - error))
    return ranks.select("table", F.col("n_delays").alias("n_changes"), "probability", near.alias("within_error"))


def discovered_columns(decoded: DataFrame) -> DataFrame:
    """CDC-01 for row images of unknown shape: per table the columns its
    images have, the type that holds all their values, and in how many
    images each is."""
    images = decoded.select("table", current_image().alias("image")).filter(F.col("image").isNotNull())
    return images.sparkSession.sql(
        "SELECT i.table, e.key AS column, schema_of_variant_agg(e.value) AS type, count(*) AS n_images "
        "FROM {images} AS i, LATERAL variant_explode(i.image) AS e GROUP BY i.table, e.key", images=images)
