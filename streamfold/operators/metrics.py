"""Metrics over samples (MET-01..MET-06): rename JMX bean names by ordered
regular-expression rules, select series by name pattern, latest-per-series
maxima, per-interval downsampling, rates and cumulative counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import epoch_micros, utc_wall_clock
from .scan import latest_per_key, running_last, running_sums, time_order

# --- fixed values -----------------------------------------------------------
# Rename rules, first match wins: (pattern, name template, label templates).
RENAME_RULES = (
    ("kafka.connect<type=connect-worker-metrics>(.+)",
     "kafka_connect_worker_$1", {}),
    ("kafka.connect<type=connector-metrics, connector=(.+)>(.+)",
     "kafka_connect_connector_$1_$2", {"connector": "$1"}),
    ("kafka.connect<type=connector-task-metrics, connector=(.+), task=(.+)>(.+)",
     "kafka_connect_task_$1_$2_$3", {"connector": "$1", "task": "$2"}),
    ("kafka.connect<type=sink-task-metrics, connector=(.+), task=(.+)>(.+)",
     "kafka_connect_sink_task_$1_$2_$3", {"connector": "$1", "task": "$2"}),
    ("kafka.connect<type=source-task-metrics, connector=(.+), task=(.+)>(.+)",
     "kafka_connect_source_task_$1_$2_$3", {"connector": "$1", "task": "$2"}),
    ("kafka.consumer<type=consumer-fetch-manager-metrics, client-id=(.+)>(.+)",
     "kafka_consumer_fetch_manager_$2", {"client_id": "$1"}),
)
LABELS = ("connector", "task", "client_id")
# Dashboard panels: (panel, anchored series-name pattern).
MAX_PANELS = (
    ("worker_connector_count", "kafka_connect_worker_connector_count.*"),
    ("worker_task_count", "kafka_connect_worker_task_count.*"),
    ("source_record_poll_total", "kafka_connect_source_task.*_source_record_poll_total.*"),
    ("source_record_write_total", "kafka_connect_source_task.*_source_record_write_total.*"),
    ("connector_startup_attempts", "kafka_connect_worker_connector_startup_attempts_total.*"),
    ("connector_startup_success", "kafka_connect_worker_connector_startup_success_total.*"),
)
RATE_PANELS = (
    ("source_record_poll_rate", "kafka_connect_source_task.*_source_record_poll_rate.*"),
    ("source_record_write_rate", "kafka_connect_source_task.*_source_record_write_rate.*"),
)
TOTAL_PANELS = (
    ("source_record_poll_total", "kafka_connect_source_task.*_source_record_poll_total.*"),
    ("source_record_write_total", "kafka_connect_source_task.*_source_record_write_total.*"),
)
SCRAPE_INTERVAL_SECONDS = 5
# ---------------------------------------------------------------------------


def _anchored(p: str) -> str:
    return "^(?:" + p + r")\z"


def safe_name(col: Column, lower: bool = True) -> Column:
    """Metric-name hygiene: characters outside ``[A-Za-z0-9:_]`` become ``_``
    and runs of ``_`` collapse to one; optionally lower-cased first."""
    c = F.lower(col) if lower else col
    return F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9:_]", "_"), "_+", "_")


def rename_names(names: DataFrame, metric_col: str = "metric", lower: bool = True
                 ) -> DataFrame:
    """MET-01 row by row: adds ``name`` and one column per label; rows
    whose metric matches no rule get a NULL name.  The rule is chosen once
    per row; only its own pattern is applied for the name and labels."""
    m = F.col(metric_col)
    rule = None
    for i, (pattern, _, _) in enumerate(RENAME_RULES):
        hit = m.rlike(_anchored(pattern))
        rule = F.when(hit, F.lit(i)) if rule is None else rule.when(hit, F.lit(i))
    tagged = names.withColumn("_sf_rule", rule)
    name = None
    labels = {lab: None for lab in LABELS}
    for i, (pattern, template, labs) in enumerate(RENAME_RULES):
        a = _anchored(pattern)
        hit = F.col("_sf_rule") == i
        v = F.regexp_replace(m, a, template)
        name = F.when(hit, v) if name is None else name.when(hit, v)
        for lab in LABELS:
            if lab in labs:
                lv = F.regexp_replace(m, a, labs[lab])
                labels[lab] = F.when(hit, lv) if labels[lab] is None else labels[lab].when(hit, lv)
    return tagged.select("*", safe_name(name, lower).alias("name"),
                         *[(labels[lab] if labels[lab] is not None else F.lit(None))
                           .cast("string").alias(lab) for lab in LABELS]).drop("_sf_rule")


def metric_names(samples: DataFrame, metric_col: str = "metric", lower: bool = True,
                 panels=None) -> DataFrame:
    """The rename table: one row per distinct metric that a rule matches,
    with ``name``, the labels and (with ``panels``) its panel.  The rules
    run once per distinct metric, not per sample: ``explode`` keeps the
    predicate on the name from being pushed below the ``distinct``."""
    named = rename_names(samples.select(metric_col).distinct(), metric_col, lower)
    row = F.struct(*[F.col(c) for c in named.columns if c != metric_col])
    r = named.select(metric_col, F.explode(F.array(row)).alias("_sf_row")).select(metric_col, "_sf_row.*")
    r = r.filter(F.col("name").isNotNull())
    return tag_panels(r, panels) if panels else r


def rename_metrics(samples: DataFrame, metric_col: str = "metric", lower: bool = True,
                   panels=None) -> DataFrame:
    """MET-01: ``name`` plus one column per label (plus ``panel`` when
    ``panels`` is given); samples that match no rule are dropped.  The
    join with the rename table has no hint: its size decides at run time."""
    names = metric_names(samples, metric_col, lower, panels)
    return samples.join(names, metric_col, "inner")


SERIES = ["name", *LABELS]


def latest_per_series(renamed: DataFrame) -> DataFrame:
    """The last sample of each series (name plus labels)."""
    return latest_per_key(renamed, SERIES, ["ts", "sample_id"], ["ts", "value"])


def tag_panels(df: DataFrame, panels) -> DataFrame:
    """One row per (row, panel whose pattern the series name matches)."""
    hits = F.array(*[F.when(F.col("name").rlike(_anchored(pat)), F.lit(p)) for p, pat in panels])
    return df.withColumn("panel", F.explode(F.filter(hits, lambda x: x.isNotNull())))


def max_of_latest(renamed: DataFrame, panels=MAX_PANELS) -> DataFrame:
    """MET-03: per panel, ``max`` over the latest sample of every selected
    series.  A panel with no series gives a NULL value."""
    latest = tag_panels(latest_per_series(renamed), panels)
    agg = latest.groupBy("panel").agg(F.max("value").alias("value"), F.count("*").alias("n_series"))
    spark = renamed.sparkSession
    all_panels = spark.createDataFrame([(p,) for p, _ in panels], "panel string")
    return (all_panels.join(agg, "panel", "left")
            .select("panel", "value", F.coalesce("n_series", F.lit(0)).alias("n_series")))


def scrape(renamed: DataFrame, interval_s: int = SCRAPE_INTERVAL_SECONDS) -> DataFrame:
    """MET-06: one sample per series per scrape interval (the last one)."""
    w = F.window("ts", f"{interval_s} seconds")
    return (renamed.groupBy(*SERIES, w.alias("w"))
            .agg(F.max_by("value", time_order("ts", "sample_id")).alias("value"),
                 F.count("*").alias("n_samples"))
            .select(*SERIES, utc_wall_clock(F.col("w.start")).alias("window_start"),
                    "value", "n_samples"))


def record_rate(tagged: DataFrame, interval_s: int = SCRAPE_INTERVAL_SECONDS) -> DataFrame:
    """MET-04: records per second per interval and panel; ``tagged`` has a
    ``panel`` column (``rename_metrics(..., panels=RATE_PANELS)``)."""
    sel = tagged
    w = F.window("ts", f"{interval_s} seconds")
    return (sel.groupBy("panel", w.alias("w")).agg(F.count("*").alias("n_records"))
            .select("panel", utc_wall_clock(F.col("w.start")).alias("window_start"),
                    "n_records", (F.col("n_records") / F.lit(float(interval_s))).alias("per_second")))


def gauge_steps(tagged: DataFrame, interval_s: int = SCRAPE_INTERVAL_SECONDS) -> DataFrame:
    """MET-04 as the panel shows it: the gauge's own value, the last sample
    of each series and step (the gauge is a rate already)."""
    w = F.window("ts", f"{interval_s} seconds")
    return (tagged.groupBy("panel", *SERIES, w.alias("w"))
            .agg(F.max_by("value", time_order("ts", "sample_id")).alias("value"))
            .select("panel", *SERIES, utc_wall_clock(F.col("w.start")).alias("window_start"), "value"))


DAY_MICROS = 24 * 3600 * 1_000_000


def increases(tagged: DataFrame) -> DataFrame:
    """How much each sample of a counter adds: the difference to the last
    value of its series; a counter that fell has started anew, and adds its
    whole value; the first sample adds nothing.  Series are scanned in
    chunks of a day, so that a series of any length is in no single task."""
    r = tagged.withColumn("_sf_us", epoch_micros("ts"))
    seen = running_last(r, ["panel", *SERIES], "_sf_us", "value", "_sf_prev", span=DAY_MICROS,
                        order_tiebreak=["sample_id"], before=True)
    prev, now = F.col("_sf_prev"), F.col("value")
    return seen.withColumn("increase", F.when(prev.isNull(), F.lit(0.0)).when(now >= prev, now - prev).otherwise(now)).drop(
        "_sf_prev", "_sf_us")


def cumulative(tagged: DataFrame, interval_s: int = SCRAPE_INTERVAL_SECONDS) -> DataFrame:
    """MET-05: per series of the total panels and step, the increase and the
    running total of increases, which restarts of a counter do not lower."""
    w = F.window("ts", f"{interval_s} seconds")
    steps = (increases(tagged).groupBy("panel", *SERIES, w.alias("w")).agg(F.sum("increase").alias("increase"))
             .select("panel", *SERIES, utc_wall_clock(F.col("w.start")).alias("window_start"), "increase")
             .withColumn("_sf_w", epoch_micros("window_start")))
    out = running_sums(steps, ["panel", *SERIES], "_sf_w", {"cumulative": "increase"}, span=DAY_MICROS)
    return out.select("panel", *SERIES, "window_start", "increase", "cumulative")
