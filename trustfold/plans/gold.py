"""Trusted rows + point-in-time usage = the modelling profile ("gold")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfold.operators.features import Metric, Ratio, window_metrics, with_as_of


def build_gold(
    trusted: DataFrame,
    events: DataFrame,
    *,
    key: str,
    event_key: str | None = None,
    day: str = "day",
    as_of: str = "as_of",
    as_of_date: str | None = None,
    as_of_column: str | None = None,
    horizon_days: int = 90,
    metrics: list[Metric],
    ratios: list[Ratio] | tuple = (),
    strategy: str = "window",
    null_safe: bool = False,
) -> DataFrame:
    """Every trusted row with its as-of date and window metrics.

    Row count equals ``trusted``'s: the metrics side has exactly one row per
    distinct (key, as-of), so the left join cannot multiply rows.  Output
    order is key, as-of, the other trusted columns, then the metrics.

    With ``null_safe=False`` (parity) a row whose key or as-of is NULL finds
    no metrics row and gets NULL features; ``null_safe=True`` matches NULLs
    too, so those rows get the zero-filled metrics.
    """
    dated = with_as_of(trusted, as_of=as_of, date=as_of_date, column=as_of_column)
    ev = events if not event_key or event_key == key else events.withColumnRenamed(event_key, key)
    feats = window_metrics(
        ev, dated.select(key, as_of), key=key, day=day, as_of=as_of,
        horizon_days=horizon_days, metrics=metrics, ratios=ratios, strategy=strategy,
    )
    rest = [c for c in dated.columns if c not in (key, as_of)]
    feat_cols = [c for c in feats.columns if c not in (key, as_of)]
    if null_safe:
        l, r = dated.alias("l"), feats.alias("r")
        cond = F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) & F.col(f"l.{as_of}").eqNullSafe(F.col(f"r.{as_of}"))
        return l.join(r, cond, "left").select(
            F.col(f"l.{key}").alias(key), F.col(f"l.{as_of}").alias(as_of),
            *[F.col(f"l.{c}") for c in rest], *[F.col(f"r.{c}") for c in feat_cols],
        )
    joined = dated.join(feats, [key, as_of], "left")
    return joined.select(key, as_of, *rest, *feat_cols)
