"""Point-in-time usage metrics: for every (entity, as-of date) snapshot, the
events of that entity in the half-open window ``[as_of - N days, as_of)``.

Nothing on or after the as-of day is visible, so features never leak the
future.  All metrics are decomposable (conditional counts and sums), which
is what lets the plan stay small at any scale:

1. **Prune** the event scan to the days that some window covers: a semi join
   with the distinct covered days (at most a calendar), which on a
   day-partitioned table prunes partitions dynamically, so folders of other
   days are never opened, also between far apart snapshots.  Events of
   entities without a snapshot go by a semi join before anything is summed
   (no hint: Spark broadcasts the keys when they are few).
2. **Roll up per (entity, day)** with partial aggregation before the shuffle.
   However many events a hot entity has, it leaves at most one row per day,
   so no later group can grow with the event volume.
3. **Slide a window** (strategy ``"window"``, default): daily rows and
   snapshot rows are unioned, partitioned by entity and summed over the
   RANGE frame ``[N preceding, 1 preceding]`` on the day number.  No join,
   no candidate pairs, no broadcast, and every snapshot gets its row (empty
   frames give NULL, then zero).  A partition holds one entity's days plus
   its snapshot dates: bounded by the calendar, not by the data.

   Strategy ``"join"`` is the interval-join form: every snapshot expanded to
   the N days of its window, equi-joined to the daily rows on (entity, day),
   summed per snapshot and left joined back for zero-fill.  The expanded
   snapshots are hinted to a sort-merge join: their size before the expansion
   would make them a broadcast that the driver cannot hold.

Entity keys of the two sides may differ in type (raw batches are text):
events are read in the snapshots' type, so every snapshot key stays as it is
and keys that differ as text never become one.  An event key that does not
convert belongs to no snapshot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    """A decomposable metric over events in the window.

    ``agg`` is ``"count"`` (events where ``when`` holds, NULL-safe: a NULL
    predicate does not count) or ``"sum"`` (``value`` over events where
    ``when`` holds; NULL values are skipped).  ``divide_by`` scales the
    final sum (e.g. seconds to minutes).  Expressions are SQL text so
    specs stay plain data.
    """

    name: str
    agg: str
    when: str | None = None
    value: str | None = None
    divide_by: float | None = None

    def __post_init__(self) -> None:
        if self.agg not in ("count", "sum"):
            raise ValueError(f"metric {self.name}: agg must be 'count' or 'sum'")
        if self.agg == "sum" and not self.value:
            raise ValueError(f"metric {self.name}: a sum needs a value expression")

    @property
    def dtype(self) -> str:
        return "bigint" if self.agg == "count" else "double"

    def partial(self) -> Column:
        """Per-day partial aggregate (runs before the shuffle)."""
        pred = F.expr(self.when) if self.when else F.lit(True)
        if self.agg == "count":
            return F.count(F.when(pred, F.lit(1))).alias(self.name)
        # widen before summing (floats accumulate in double either way,
        # the cast just makes the contract explicit)
        return F.sum(F.when(pred, F.expr(self.value).cast("double"))).alias(self.name)


@dataclass(frozen=True)
class Ratio:
    """``numerator / denominator`` of two metrics; NULL when the denominator is 0."""

    name: str
    numerator: str
    denominator: str


def _finish(df: DataFrame, key: str, as_of: str, metrics: list[Metric], ratios: list[Ratio]) -> DataFrame:
    """Zero-fill, scale, type and add the ratios; key and as-of come first."""
    cols = [F.col(key), F.col(as_of)]
    for m in metrics:
        v = F.coalesce(F.col(m.name), F.lit(0))
        if m.divide_by:
            v = v / F.lit(float(m.divide_by))
        cols.append(v.cast(m.dtype).alias(m.name))
    out = df.select(*cols)
    for r in ratios:
        den = F.col(r.denominator)
        out = out.withColumn(
            r.name, F.when(den > 0, F.col(r.numerator) / den).cast("double")
        )
    return out


def covered_days(snapshots: DataFrame, *, day: str, as_of: str, horizon_days: int) -> DataFrame:
    """The distinct days that some snapshot's window covers: overlapping windows give a day once.

    The calendar bounds it, not the number of snapshots.
    """
    dates = snapshots.select(as_of).distinct()
    each = dates.select(F.explode(F.sequence(F.date_sub(as_of, horizon_days), F.date_sub(as_of, 1))).alias(day), as_of)
    return each.where(F.col(day) < F.col(as_of)).select(day).distinct()


def prune_to_snapshots(events: DataFrame, snapshots: DataFrame, *, day: str, as_of: str,
                       horizon_days: int) -> DataFrame:
    """Keep events whose day lies in some snapshot's window.

    Events are semi joined with the covered days, a broadcast of at most the
    calendar's size.  On a day-partitioned table Spark turns that join into
    dynamic partition pruning: of snapshots in January and December no
    summer folder is opened.  The outer bounds stand beside it as scalar
    subqueries, for tables without partitions, where they reach the parquet
    scan's row groups.  There is no eager job, and without snapshots both
    bounds are NULL and nothing is read.
    """
    # one subquery for both bounds: the snapshot source is aggregated once
    bounds = snapshots.select(
        F.struct(F.date_sub(F.min(as_of), horizon_days).alias("lo"), F.max(as_of).alias("hi"))
    ).scalar()
    inside = events.where((F.col(day) >= bounds["lo"]) & (F.col(day) < bounds["hi"]))
    return inside.join(F.broadcast(covered_days(snapshots, day=day, as_of=as_of, horizon_days=horizon_days)), day, "left_semi")


def _require_dates(df: DataFrame, column: str, what: str) -> None:
    """Windows count calendar days: a timestamp or text column would group
    per instant or compare as text, so anything but a date is refused (a
    schema check, no job)."""
    dtype = dict(df.dtypes).get(column)
    if dtype != "date":
        raise TypeError(f"{what}.{column} must be a date column, got {dtype}; cast it first")


def _relevant(events: DataFrame, snapshots: DataFrame, *, key: str, day: str, as_of: str, horizon_days: int) -> DataFrame:
    """Events that some snapshot can see: days in range, entities with a
    snapshot, the key in the snapshots' type."""
    kind = snapshots.schema[key].dataType
    if events.schema[key].dataType != kind:
        events = events.withColumn(key, F.col(key).try_cast(kind))
    pruned = prune_to_snapshots(events.where(F.col(key).isNotNull()), snapshots, day=day, as_of=as_of,
                                horizon_days=horizon_days)
    return pruned.join(snapshots.select(key).distinct(), key, "left_semi")


def daily_rollup(events: DataFrame, *, key: str, day: str, metrics: list[Metric]) -> DataFrame:
    """One row per (entity, day) holding every metric's partial aggregate."""
    return events.groupBy(key, day).agg(*[m.partial() for m in metrics])


def window_metrics(
    events: DataFrame,
    snapshots: DataFrame,
    *,
    key: str,
    day: str,
    as_of: str,
    horizon_days: int,
    metrics: list[Metric],
    ratios: list[Ratio] | tuple = (),
    strategy: str = "window",
) -> DataFrame:
    """One row per distinct (key, as_of) of ``snapshots`` with its window metrics.

    ``events`` needs ``key``, ``day`` (date) and the columns the metric
    expressions use; ``snapshots`` needs ``key`` and ``as_of`` (date).
    Events of entities without a snapshot are ignored.  Snapshots with a
    NULL key or as-of date keep their row, with zero metrics.
    """
    if horizon_days < 1:
        raise ValueError("horizon_days must be at least 1")
    _require_dates(events, day, "events")
    _require_dates(snapshots, as_of, "snapshots")
    metrics = list(metrics)
    ratios = list(ratios)
    snaps = snapshots.select(key, as_of).distinct()
    valid = snaps.where(F.col(key).isNotNull() & F.col(as_of).isNotNull())
    # events without an entity can never match; dropping them here also keeps
    # a NULL key from becoming one hot partition after the shuffle
    pruned = _relevant(events, valid, key=key, day=day, as_of=as_of, horizon_days=horizon_days)
    daily = daily_rollup(pruned, key=key, day=day, metrics=metrics)
    names = [m.name for m in metrics]

    if strategy == "window":
        probe = snaps.select(
            F.col(key), F.col(as_of).alias(day), *[F.lit(None).cast(m.dtype).alias(m.name) for m in metrics],
            F.lit(True).alias("__probe"),
        )
        rows = daily.select(key, day, *names, F.lit(False).alias("__probe")).unionByName(probe)
        w = (
            Window.partitionBy(key)
            .orderBy(F.unix_date(F.col(day)))
            .rangeBetween(-horizon_days, -1)
        )
        # a snapshot with a NULL key or date matches nothing (zero metrics)
        ok = F.col(key).isNotNull() & F.col(day).isNotNull()
        framed = rows.select(
            F.col(key), F.col(day).alias(as_of), F.col("__probe"),
            *[F.when(ok, F.sum(n).over(w)).alias(n) for n in names],
        ).where(F.col("__probe")).drop("__probe")
        return _finish(framed, key, as_of, metrics, ratios)

    if strategy == "join":
        days = window_days(valid, key=key, as_of=as_of, day=day, horizon_days=horizon_days)
        matched = daily.join(days, [key, day], "inner")
        sums = matched.groupBy(key, as_of).agg(*[F.sum(n).alias(n) for n in names])
        return _finish(snaps.join(sums, [key, as_of], "left"), key, as_of, metrics, ratios)

    raise ValueError(f"unknown strategy {strategy!r}; use 'window' or 'join'")


def window_days(snapshots: DataFrame, *, key: str, as_of: str, day: str, horizon_days: int) -> DataFrame:
    """Each snapshot expanded to the N days of its window: (key, as_of, day).

    Joining on (key, day) is then an exact equi-join: no range predicate,
    no candidate pairs per entity, and the join keys spread a busy entity
    over its days.  The expansion is N rows per snapshot (N fixed).

    Spark sizes an explode by its input, so it would take the N-fold table
    for a small one and collect it in the driver, for a broadcast join or to
    prune partitions.  The hint keeps it a shuffled join that spills.
    """
    return snapshots.select(
        key, as_of,
        F.explode(F.sequence(F.date_sub(F.col(as_of), horizon_days), F.date_sub(F.col(as_of), 1))).alias(day),
    ).hint("merge")


def events_in_window(events: DataFrame, snapshots: DataFrame, *, key: str, day: str, as_of: str,
                     horizon_days: int) -> DataFrame:
    """The interval join itself: every event paired with each snapshot of its
    entity whose window contains it, plus ``days_before`` (1..N).

    Meant for audits of the window edges.  The output is event-sized (an
    event can match several snapshots); it is computed as an equi-join on
    (entity, day) against the snapshots' window days.
    """
    _require_dates(events, day, "events")
    _require_dates(snapshots, as_of, "snapshots")
    snaps = snapshots.select(key, as_of).where(
        F.col(key).isNotNull() & F.col(as_of).isNotNull()
    ).distinct()
    pruned = _relevant(events, snaps, key=key, day=day, as_of=as_of, horizon_days=horizon_days)
    days = window_days(snaps, key=key, as_of=as_of, day=day, horizon_days=horizon_days)
    return pruned.join(days, [key, day], "inner").withColumn(
        "days_before", F.datediff(F.col(as_of), F.col(day))
    )


def window_edge_counts(events: DataFrame, snapshots: DataFrame, *, key: str, day: str, as_of: str,
                       horizon_days: int) -> DataFrame:
    """Events and entities per (as-of, days before as-of) of the windows.

    Counted from the daily roll-up, so at most one row per entity and day
    meets the snapshots, never the raw events.
    """
    _require_dates(events, day, "events")
    _require_dates(snapshots, as_of, "snapshots")
    snaps = snapshots.select(key, as_of).where(
        F.col(key).isNotNull() & F.col(as_of).isNotNull()
    ).distinct()
    pruned = _relevant(events, snaps, key=key, day=day, as_of=as_of, horizon_days=horizon_days)
    daily = daily_rollup(pruned, key=key, day=day, metrics=[Metric("n_events", "count")])
    days = window_days(snaps, key=key, as_of=as_of, day=day, horizon_days=horizon_days)
    return (daily.join(days, [key, day], "inner")
            .groupBy(as_of, F.datediff(F.col(as_of), F.col(day)).alias("days_before"))
            .agg(F.sum("n_events").alias("n_events"), F.count(F.lit(1)).alias("n_entities")))


def with_as_of(df: DataFrame, *, as_of: str = "as_of", date: str | None = None,
               column: str | None = None, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Add the as-of date: one literal for all rows, or parsed per row from a
    text column (bad text becomes NULL instead of failing the job)."""
    if (date is None) == (column is None):
        raise ValueError("give exactly one of date= or column=")
    if date is not None:
        return df.withColumn(as_of, F.to_date(F.lit(date)))
    return df.withColumn(as_of, F.try_to_date(F.col(column), fmt))
