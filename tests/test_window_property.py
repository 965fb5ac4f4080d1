"""Point-in-time metrics against brute force on generated events and
snapshots (both strategies, random horizons, NULL keys and dates, repeated
snapshot pairs, events on the as-of day and just outside the window)."""

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trustfold.operators.features import Metric, Ratio, window_metrics

METRICS = [
    Metric("n_calls", "count", when="kind = 'call'"),
    Metric("secs", "sum", when="kind = 'call'", value="duration_s"),
    Metric("n_drop", "count", when="kind = 'call' AND dropped"),
]
RATIOS = [Ratio("rate", "n_drop", "n_calls")]
D0 = date(2026, 1, 1)
KEYS = st.sampled_from(["a", "b", "c", None])
DAY = st.integers(0, 40).map(lambda d: D0 + timedelta(days=d))
EVENT = st.tuples(KEYS, st.sampled_from(["call", "data"]), st.one_of(st.none(), st.integers(0, 500)),
                  st.one_of(st.none(), st.booleans()), DAY)
SNAP = st.tuples(KEYS, st.one_of(st.none(), DAY))


def _brute(events, snaps, horizon):
    out = {}
    for key, as_of in set(snaps):
        if key is None or as_of is None:
            out[(key, as_of)] = (0, 0.0, 0, None)
            continue
        lo = as_of - timedelta(days=horizon)
        calls = [e for e in events if e[0] == key and e[1] == "call" and lo <= e[4] < as_of]
        n = len(calls)
        secs = float(sum(e[2] for e in calls if e[2] is not None))
        drop = sum(1 for e in calls if e[3] is True)
        out[(key, as_of)] = (n, secs, drop, drop / n if n else None)
    return out


@pytest.mark.parametrize("strategy", ["window", "join"])
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=st.lists(EVENT, max_size=60), snaps=st.lists(SNAP, min_size=1, max_size=12),
       horizon=st.integers(1, 20))
def test_window_metrics_match_brute_force(spark, strategy, events, snaps, horizon):
    ev = spark.createDataFrame(events, "key string, kind string, duration_s int, dropped boolean, day date")
    sn = spark.createDataFrame(snaps, "key string, as_of date")
    out = window_metrics(ev, sn, key="key", day="day", as_of="as_of", horizon_days=horizon, metrics=METRICS,
                         ratios=RATIOS, strategy=strategy)
    got = {(r.key, r.as_of): (r.n_calls, r.secs, r.n_drop, r.rate) for r in out.collect()}
    assert got == _brute(events, snaps, horizon)
