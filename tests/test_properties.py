"""Property tests: the optimised forms against brute force in Python on random small inputs."""

import datetime as dt
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adpulse.operators.blacklist import derive_blacklist, drop_flagged_users, filter_blacklisted
from adpulse.operators.counts import click_counts
from adpulse.operators.reports import hourly_trend, top_ads

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DAY0 = dt.date(2024, 1, 1)
USERS = st.sampled_from(["a", "b", "c", "d", None])
ADS = st.sampled_from(["1", "2", "10", "9"])
CLICK = st.tuples(st.integers(0, 2), USERS, ADS)


@SETTINGS
@given(rows=st.lists(CLICK, min_size=1, max_size=40), threshold=st.integers(0, 4))
def test_blacklist_forms_agree_with_brute_force(spark, rows, threshold):
    data = [(DAY0 + dt.timedelta(days=d), u, a) for d, u, a in rows]
    df = spark.createDataFrame(data, "click_day date, user_id string, adv_id string")
    groups = Counter(data)
    flagged = {u for (d, u, a), n in groups.items() if n > threshold and u is not None}
    expected = sorted(str(k + (n,)) for k, n in groups.items() if k[1] not in flagged)
    counts = click_counts(df)
    assert {r.user_id for r in derive_blacklist(counts, threshold).collect()} == flagged
    for got in (drop_flagged_users(counts, threshold), filter_blacklisted(counts, derive_blacklist(counts, threshold), method="mark")):
        assert sorted(str(tuple(r)) for r in got.select("click_day", "user_id", "adv_id", "clicks").collect()) == expected


@SETTINGS
@given(seconds=st.lists(st.integers(0, 4 * 3600), min_size=1, max_size=30),
       shape=st.sampled_from([("1 hour", "10 minutes"), ("30 minutes", "10 minutes"), ("20 minutes", "20 minutes")]))
def test_bucketed_windows_agree_with_brute_force(spark, seconds, shape):
    length, slide = shape
    size, step = {"1 hour": 3600, "30 minutes": 1800, "20 minutes": 1200}[length], {"10 minutes": 600, "20 minutes": 1200}[slide]
    base = dt.datetime(2024, 1, 1)
    rows = [("u", "1", base + dt.timedelta(seconds=s)) for s in seconds]
    df = spark.createDataFrame(rows, "user_id string, adv_id string, ts timestamp").selectExpr("*", "to_date(ts) AS click_day")
    expected = Counter()
    for s in seconds:
        first = (s // step) * step - size + step  # earliest window start (aligned to the slide) that holds s
        for start in range(first, s + 1, step):
            if start <= s < start + size:
                expected[base + dt.timedelta(seconds=start)] += 1
    got = {r.window_start: r.clicks for r in hourly_trend(df, length, slide, by=("adv_id",)).collect()}
    assert got == dict(expected)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["P", "Q"]), ADS), min_size=1, max_size=40), n=st.integers(1, 3))
def test_top_ads_agree_with_brute_force(spark, rows, n):
    df = spark.createDataFrame([(p, a) for p, a in rows], "province string, adv_id string")
    per = defaultdict(Counter)
    for p, a in rows:
        per[p][a] += 1
    expected = set()
    for p, counts in per.items():
        ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
        expected |= {(p, a, c, i + 1) for i, (a, c) in enumerate(ranked)}
    got = {(r.province, r.adv_id, r.clicks, r.rank) for r in top_ads(df, by=("province",), n=n).collect()}
    assert got == expected
