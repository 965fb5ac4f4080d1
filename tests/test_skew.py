"""One key, one entity or one group of identical copies holding a third of
all rows: results stay exact (checked against brute force) and the plans
reduce the hot group before it crosses a shuffle."""

import random
import re
from collections import Counter
from datetime import date, timedelta

import pytest

from trustfold.operators.dedup import collapse_identical, split_conflicts
from trustfold.operators.features import Metric, daily_rollup, window_metrics
from trustfold.plans.gold import build_gold

METRICS = [
    Metric("n_calls", "count", when="kind = 'call'"),
    Metric("secs", "sum", when="kind = 'call'", value="duration_s"),
]
START = date(2026, 1, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_events(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"e{rnd.randrange(40)}"
        d = START + timedelta(days=rnd.randrange(60))
        kind = rnd.choice(["call", "call", "data"])
        rows.append((key, kind, rnd.randrange(1, 300) if kind == "call" else None, d))
    return rows


def _brute(events, snaps, horizon):
    out = {}
    for key, as_of in set(snaps):
        lo = as_of - timedelta(days=horizon)
        hits = [e for e in events if e[0] == key and lo <= e[3] < as_of and e[1] == "call"]
        out[(key, as_of)] = (len(hits), float(sum(e[2] for e in hits)))
    return out


@pytest.mark.parametrize("strategy", ["window", "join"])
def test_hot_entity_window_metrics_exact(spark, strategy):
    events = _hot_events()
    keys = ["hot"] + [f"e{i}" for i in range(40)]
    snaps = [(k, START + timedelta(days=d)) for k in keys for d in (10, 31, 45, 59)]
    ev = spark.createDataFrame(events, "key string, kind string, duration_s int, day date")
    sn = spark.createDataFrame(snaps, "key string, as_of date")
    out = window_metrics(ev, sn, key="key", day="day", as_of="as_of", horizon_days=14, metrics=METRICS,
                         strategy=strategy)
    got = {(r.key, r.as_of): (r.n_calls, r.secs) for r in out.collect()}
    assert got == _brute(events, snaps, 14)


def test_hot_entity_rollup_is_bounded_by_days(spark):
    events = _hot_events()
    ev = spark.createDataFrame(events, "key string, kind string, duration_s int, day date")
    daily = daily_rollup(ev, key="key", day="day", metrics=METRICS)
    hot_days = daily.where("key = 'hot'").count()
    assert hot_days == len({e[3] for e in events if e[0] == "hot"}) <= 60
    assert sum(1 for e in events if e[0] == "hot") == 1000


def _lines(n=1200, seed=3):
    """A third of the rows are versions of key k0 in file f1; among those,
    100 are copies of one record."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = "same" if i % 12 == 0 else f"v{rnd.randrange(50)}"
            rows.append(("k0", v, "f1"))
        else:
            rows.append((f"k{rnd.randrange(1, 300)}", f"v{rnd.randrange(3)}", f"f{rnd.randrange(1, 4)}"))
    return rows


def test_hot_key_conflicts_exact(spark):
    rows = _lines()
    df = spark.createDataFrame(rows, "key string, v string, _file string")
    ok, bad = split_conflicts(df, key="key", origin="_file")
    distinct = set(rows)
    versions = Counter((k, f) for k, _, f in distinct)
    want_ok = sorted(r for r in distinct if versions[(r[0], r[2])] == 1)
    want_bad = sorted(r for r in distinct if versions[(r[0], r[2])] > 1)
    assert sorted(tuple(r) for r in ok.collect()) == want_ok
    assert sorted(tuple(r) for r in bad.collect()) == want_bad
    assert versions[("k0", "f1")] > 1 and ("k0", "same", "f1") in want_bad


def _first_exchange_after_partial(plan: str, partial: str) -> bool:
    """In the executed plan (printed top-down), a partial aggregate sits
    below (after) the first exchange that reads it."""
    lines = plan.splitlines()
    ex = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    pa = [i for i, line in enumerate(lines) if partial in line]
    return bool(ex and pa and pa[-1] > ex[0])


def test_hot_copy_group_collapses_before_the_shuffle(spark):
    rows = [("k0", "same", "f1")] * 400 + [(f"x{i}", "v", "f1") for i in range(800)]
    df = spark.createDataFrame(rows, "key string, v string, _file string").repartition(4)
    out = collapse_identical(df, origin="_file")
    assert out.count() == 801
    plan = _plan(out)
    # the distinct is a hash aggregate with a map-side (partial) step
    assert re.search(r"HashAggregate\(keys=\[key#\d+, v#\d+, _file#\d+\], functions=\[\]", plan)
    assert _first_exchange_after_partial(plan, "HashAggregate")


def test_hot_copy_group_folder_unit_partial_aggregate(spark):
    rows = [("k0", "same", f"/b/f1/part-{i % 4}.csv") for i in range(400)] + \
           [(f"x{i}", "v", "/b/f1/part-0.csv") for i in range(800)]
    df = spark.createDataFrame(rows, "key string, v string, _file string").repartition(4)
    out = collapse_identical(df, origin="_file", unit="folder")
    got = out.collect()
    assert len(got) == 801
    assert [r._file for r in got if r.key == "k0"] == ["/b/f1/part-0.csv"]
    assert "partial_min" in _plan(out)


def test_hot_key_gold_join_keeps_every_row(spark):
    events = _hot_events()
    ev = spark.createDataFrame(events, "key string, kind string, duration_s int, day date")
    trusted = spark.createDataFrame(
        [("hot", f"r{i}") for i in range(600)] + [(f"e{i % 40}", f"r{i}") for i in range(1200)],
        "key string, payload string")
    gold = build_gold(trusted, ev, key="key", as_of_date=str(START + timedelta(days=31)), horizon_days=14,
                      metrics=METRICS)
    rows = gold.collect()
    assert len(rows) == 1800
    want = _brute(events, [("hot", START + timedelta(days=31))], 14)[("hot", START + timedelta(days=31))]
    assert {(r.n_calls, r.secs) for r in rows if r.key == "hot"} == {want}


def test_hot_key_join_back_is_split_by_aqe(spark):
    """The version-count join-back is a sort-merge join that AQE splits when
    one key dominates (thresholds lowered here so the test data counts as
    skewed; on a cluster the defaults apply)."""
    keys = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        rows = [("hot", f"v{i}", "f1") for i in range(6000)] + [(f"k{i}", "v", "f1") for i in range(600)]
        df = spark.createDataFrame(rows, "key string, v string, _file string").repartition(8)
        from trustfold.operators.dedup import tag_versions

        out = tag_versions(df, key="key", origin="_file")
        got = {r["key"]: r["__versions"] for r in out.collect()}  # runs ``out`` itself: its plan is final
        assert got["hot"] == 6000 and got["k1"] == 1
        plan = _plan(out)
        # the hot key's partition of the join is read in several splits
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
