"""Physical plans: pushdown, pruning, broadcast of fixed dimensions, no Python on the hot path."""

import pytest

from __spark_entry__ import queries
from adpulse.plans import catalog

BATCH = list(catalog.batch_queries())


def plan(df, capsys):
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_plan(spark, sf_small, capsys, name):
    text = plan(queries()[name](spark, sf_small), capsys)
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in text, (name, marker)


def test_time_filter_reaches_the_scan(spark, sf_small, capsys):
    text = plan(catalog.q_trend_last_hour(spark, sf_small), capsys)
    pushed = [line for line in text.splitlines() if "PushedFilters" in line and "ts" in line]
    assert pushed and all("GreaterThan(ts,2024-01-15T11:00" in p and "LessThanOrEqual(ts,2024-01-15T12:00" in p for p in pushed)


def test_scan_reads_only_needed_columns(spark, sf_small, capsys):
    text = plan(catalog.q_click_counts(spark, sf_small), capsys)
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert scans == ["ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,props:string>"]


def test_counts_need_no_geography_join(spark, sf_small, capsys):
    for q in (catalog.q_click_counts, catalog.q_blacklist_users, catalog.q_hourly_trend, catalog.q_latest_offsets):
        assert "customer" not in plan(q(spark, sf_small), capsys).lower().replace("c_custkey", "")


def test_fixed_dimensions_are_broadcast(spark, sf_small, capsys):
    text = plan(catalog.q_daily_city_ad_clicks(spark, sf_small), capsys)
    assert "BroadcastHashJoin" in text


def test_top_n_is_limited_before_the_shuffle(spark, sf_small, capsys):
    text = plan(catalog.q_top_ads_by_province(spark, sf_small), capsys)
    assert "WindowGroupLimit" in text


def test_blacklist_filter_is_an_anti_join(spark, sf_small, capsys):
    text = plan(catalog.q_filter_blacklisted(spark, sf_small), capsys)
    assert "LeftAnti" in text


def test_counts_aggregate_map_side(spark, sf_small, capsys):
    text = plan(catalog.q_click_counts(spark, sf_small), capsys)
    assert text.count("HashAggregate") >= 2  # partial + final


def nodes(df):
    """Class names of the plan that ran, also inside its query stages; a reused stage is not entered again."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        found.append((name, node))
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_reports_shuffle_the_counts_once(spark, sf_small):
    """Once run, the offenders and the counts share a scan and an exchange; nothing is dealt by user alone or windowed."""
    df = catalog.q_hourly_trend(spark, sf_small)
    df.collect()
    found = nodes(df)
    names = [name for name, _ in found]
    events = [n for name, n in found if name == "FileSourceScanExec" and "props" in n.output().mkString(",")]
    assert names.count("ReusedExchangeExec") == 1 and len(events) == 1
    assert not [n for n in names if n.startswith("Window")]
    exchanges = [n.outputPartitioning().toString() for name, n in found if name == "ShuffleExchangeExec"]
    assert exchanges and not [e for e in exchanges if e.startswith("hashpartitioning(user_id") and e.count("#") == 1]


def test_building_a_query_runs_no_job_and_no_single_partition(spark, sf_small, capsys):
    for name, tables in (("parse_click_log", 4), ("daily_city_ad_clicks", 4), ("filter_blacklisted", 4)):
        spark.sparkContext.setJobGroup(f"building {name}", "")
        text = plan(queries()[name](spark, sf_small), capsys)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"building {name}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert "SinglePartition" not in text and len(jobs) <= tables  # the schema of each table, nothing else
