"""A user holding a third of all clicks: results stay exact when AQE splits the hot partition."""

import datetime as dt
from collections import Counter

import pytest

from adpulse.operators.blacklist import derive_blacklist, drop_flagged_users, filter_blacklisted
from adpulse.operators.counts import click_counts
from adpulse.operators.reports import top_ads

DAY0 = dt.date(2024, 1, 1)


def skewed_rows():
    rows = []
    for i in range(6000):
        user = "hot" if i % 3 == 0 else f"u{i % 97}"
        rows.append((DAY0 + dt.timedelta(days=i % 5), user, str(i % 11), f"P{i % 4}"))
    return rows


@pytest.fixture
def forced_skew_split(spark):
    """No broadcasts and tiny skew thresholds, so joins shuffle and AQE splits the hot partition."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_user_partition_is_split(spark, forced_skew_split, capsys):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "click_day date, user_id string, adv_id string, province string").repartition(8)
    left = filter_blacklisted(df, derive_blacklist(click_counts(df), 30, distinct=False))
    assert len(left.collect()) == 4000
    capsys.readouterr()
    left.explain()  # after execution: the final adaptive plan
    plan = capsys.readouterr().out
    assert "isFinalPlan=true" in plan and "skew=true" in plan


def test_hot_user_results_are_exact(spark, forced_skew_split):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "click_day date, user_id string, adv_id string, province string").repartition(8)
    groups = Counter((d, u, a) for d, u, a, _ in rows)
    threshold = 30  # the hot user has ~36 clicks in each (day, ad) group, others ~1
    flagged = {u for (d, u, a), n in groups.items() if n > threshold}
    assert flagged == {"hot"}

    counts = click_counts(df)
    assert sorted(map(tuple, counts.collect())) == sorted(k + (n,) for k, n in groups.items())

    left = filter_blacklisted(df, derive_blacklist(counts, threshold))
    assert left.count() == sum(1 for r in rows if r[1] not in flagged)
    kept = drop_flagged_users(counts, threshold)
    assert sorted(map(tuple, kept.collect())) == sorted(k + (n,) for k, n in groups.items() if k[1] not in flagged)

    # the hot user's clicks dominate an unfiltered ranking; ranks stay exact
    ranked = {(r.province, r.adv_id, r.clicks) for r in top_ads(df, by=("province",), n=2).collect()}
    per = Counter((p, a) for _, _, a, p in rows)
    expected = set()
    for p in {p for p, _ in per}:
        best = sorted(((a, n) for (q, a), n in per.items() if q == p), key=lambda x: (-x[1], x[0]))[:2]
        expected |= {(p, a, n) for a, n in best}
    assert ranked == expected


def test_the_capped_log_has_as_many_files_whatever_the_splits(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from adpulse.plans import streams
    from adpulse.sources.fixtures import messages_from_events

    for name in ("customer", "nation", "region"):
        (tmp_path / f"{name}.parquet").symlink_to(f"/root/testdata/sf0.001/{name}.parquet")
    at = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)"
    rows = spark.range(900).selectExpr("id event_id", f"{at} ts", "id % 40 user_id", "concat('{\"k\": ', id % 7, '}') props")
    rows.repartition(9).write.parquet(str(tmp_path / "events.parquet"))
    logs, read = [], streams.read_click_stream

    def stopped(spark, stream, tables, **_):
        tables.create(spark)
        return SimpleNamespace(awaitTermination=lambda: None, exception=lambda: None)

    monkeypatch.setattr(streams, "run_click_stream", stopped)
    monkeypatch.setattr(streams, "read_click_stream", lambda s, path, **k: logs.append(path) or read(s, path=path, **k))
    streams.q_stream_capped_blacklist(spark, str(tmp_path))
    assert len(logs) == 5 and len(set(logs)) == 1
    log = spark.read.parquet(logs[0])
    assert len(log.inputFiles()) == 15
    found, want = log.select("offset", "value"), messages_from_events(spark, str(tmp_path)).select("offset", "value")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
