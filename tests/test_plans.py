"""Plan shapes that matter at scale, read from ``explain`` output."""

import contextlib
import io

import pytest

from streamfold.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_plans_start_no_job(spark):
    """Building a batch query runs nothing, and pins no join strategy."""
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    for name, query in catalog.QUERIES.items():
        group = f"plan-{name}"
        sc.setJobGroup(group, name)
        try:
            df = query(spark, SF)
            started = [j for j in tracker.getJobIdsForGroup(group)]
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        # A scan may read a footer for its schema (one task); nothing else.
        stages = [tracker.getStageInfo(s) for j in started for s in (tracker.getJobInfo(j).stageIds or [])]
        assert all(s is None or s.numTasks <= 1 for s in stages), name
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString(), name


def test_censor_reads_only_what_it_needs(spark):
    p = plan(catalog.QUERIES["censor_messages"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p and "INSET" not in p


def test_block_fold_is_a_partial_hash_aggregate(spark):
    p = plan(catalog.QUERIES["block_list"](spark, SF))
    assert "partial_max_by" in p and "SortAggregate" not in p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in p


def test_cdc_filter_runs_before_decoding(spark):
    p = plan(catalog.QUERIES["cdc_op_counts"](spark, SF))
    filters = [line for line in p.splitlines() if line.startswith("Condition") or "DataFilters" in line]
    assert filters and not any("from_json" in f for f in filters)


def test_metric_rules_run_per_name_not_per_sample(spark):
    p = plan(catalog.QUERIES["metric_rename"](spark, SF))
    filters = [line for line in p.splitlines() if line.startswith("Condition")]
    assert filters and not any("RLIKE" in f for f in filters)      # no rule below the distinct


@pytest.mark.parametrize("name", ["spend_running_total", "batch_groups"])
def test_chunked_scan_shuffles_records_once(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    df.collect()
    p = plan(df, "simple")
    final = p.split("== Final Plan ==")[-1] if "Final Plan" in p else p
    # one hash exchange carries records by (key, chunk); the per-chunk
    # carry comes from a partial aggregate
    assert "partial_sum" in final
    assert final.count("Window [") >= 2


@pytest.mark.parametrize("name", ["cdc_current_state", "spend_category_latest", "metric_max_latest", "metric_scrape",
                                  "metric_gauge"])
def test_latest_per_key_is_a_hash_aggregate(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF))
    assert "partial_max_by" in p and "SortAggregate" not in p
