from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskloom.operators import alerts

START = datetime(2024, 5, 1)
LOG = "source long, ts timestamp_ntz, is_error int"


def log(spark, rows):
    return spark.createDataFrame([(s, START + timedelta(seconds=t), e) for s, t, e in rows], LOG)


def minutes(pattern, source=0):
    """One letter a minute: 'x' all failed, 'o' all fine, '.' no requests."""
    rows = []
    for i, c in enumerate(pattern):
        if c != ".":
            rows += [(source, 60 * i + k, int(c == "x")) for k in range(3)]
    return rows


def episodes(spark, pattern, **how):
    found = alerts.error_rate_alert(log(spark, minutes(pattern)), **how).collect()
    return sorted(((r.started - START).seconds // 60, (r.ended - START).seconds // 60) for r in found)


def test_alert_needs_five_minutes(spark):
    assert episodes(spark, "xxxxo") == []
    assert episodes(spark, "oxxxxxo") == [(1, 6)]
    assert episodes(spark, "xxxxxoxxxxxxx") == [(0, 5), (6, 13)]


def test_a_quiet_minute_ends_an_episode(spark):
    assert episodes(spark, "xxx.xxx") == []
    assert episodes(spark, "xxxxx.xxxxxx") == [(0, 5), (6, 12)]


def test_ratio_must_be_exceeded(spark):
    rows = [(0, 60 * i + k, int(k == 0)) for i in range(6) for k in range(20)]
    assert alerts.error_rate_alert(log(spark, rows), ratio=0.05).count() == 0
    assert alerts.error_rate_alert(log(spark, rows), ratio=0.049).first().errors == 6


def test_sources_are_separate(spark):
    rows = minutes("xxx...", 1) + minutes("...xxx", 2)
    assert alerts.error_rate_alert(log(spark, rows)).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 900), st.integers(0, 1)), min_size=1, max_size=40))
def test_down_alert_equals_brute_force(spark, rows):
    expected = []
    for source in (0, 1):
        every = sorted(t for s, t, _ in rows if s == source)
        if not every:
            continue
        times = [every[0], *sorted({t for s, t, e in rows if s == source and not e}), max(t for _, t, _ in rows)]
        states = ["closed"] * (len(times) - 2) + ["open"]
        expected += [(source, a, b, state) for a, b, state in zip(times, times[1:], states) if b - a >= 60]
    found = alerts.down_alert(log(spark, rows)).collect()
    got = [(r.source, (r.down_from - START).seconds, (r.down_until - START).seconds, r.state) for r in found]
    assert sorted(got) == sorted(expected)


def test_open_and_never_healthy(spark):
    """One source stops being healthy after 100 s, the other never was."""
    rows = [(1, t, int(t > 100)) for t in range(0, 601, 10)] + [(2, t, 1) for t in range(30, 601, 10)]
    found = sorted((r.source, (r.down_from - START).seconds, (r.down_until - START).seconds, r.state) for r in alerts.down_alert(log(spark, rows)).collect())
    assert found == [(1, 100, 600, "open"), (2, 30, 600, "open")]


def test_error_states(spark):
    rows = minutes("oxxxxxoxxxxxx")
    found = alerts.error_states(alerts.error_counts(log(spark, rows))).collect()
    assert sorted(((r.started - START).seconds // 60, r.state) for r in found) == [(1, "closed"), (7, "open")]
