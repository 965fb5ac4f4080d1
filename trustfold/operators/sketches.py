"""Reports from small mergeable summaries instead of whole columns.

* Quantiles: a KLL sketch per group and column, merged over any groups.
* Most frequent values of wide columns: a frequent-items summary a task,
  merged; its candidates are recounted exactly, and the answer is given only
  if the summary proves that no other value can be among the first k.
* Distinct entities over several days: a bitmap a day and block of ids;
  a week is the OR of its days, without another look at the events.

The shuffles hold summaries, whose size depends on their parameters and not
on the rows (bitmaps: on the largest id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustfold.functions.casting import cast_text
from trustfold.functions.text import quoted
from trustfold.operators.profile import top_values_per_column

# ------------------------------------------------------------- quantiles

#: Size parameter of the sketches, and the rank error its quantiles stay within (twice the error that KLL exceeds in 1 % of cases).
KLL_K, KLL_RANK_ERROR = 1000, 0.01


def quantile_sketches(df: DataFrame, by: list[str], types: dict, *, int_policy: str = "legacy", k: int = KLL_K) -> DataFrame:
    """A sketch of the convertible values per group and typed column: the ``by`` columns, column_name, sketch."""
    cols = [c for c in types if c in df.columns]
    values = {c: cast_text(c, types[c], int_policy).cast("double") for c in cols}
    wide = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(values[c], k).alias(f"__s{i}") for i, c in enumerate(cols)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__s{i}").alias("sketch")) for i, c in enumerate(cols)]))
    return wide.select(*by, each.alias("__x")).select(*by, "__x.*")


def sketched_quantiles(sketches: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75), *, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Quantiles of the merged sketches per ``by`` and column: n, prob, value (NULL without values)."""
    merged = sketches.groupBy(*by, "column_name").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    n = F.kll_sketch_get_n_double("sketch")
    each = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias("value"))
                               for p in probs]))
    return merged.select(*by, "column_name", n.alias("n"), each.alias("x")).select(*by, "column_name", "n", "x.prob", "x.value")


def rank_errors(df: DataFrame, quantiles: DataFrame, types: dict, *, int_policy: str = "legacy") -> DataFrame:
    """How far each quantile is from its rank: column_name, prob, n and rank_error (0: it is the exact one).

    One pass; the few quantiles go to every task, and each cell is compared with those of its column.
    """
    cols = [c for c in types if c in df.columns]
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), cast_text(c, types[c], int_policy).cast("double").alias("cell")) for c in cols])).alias("x"))
    met = cells.select("x.*").where("cell IS NOT NULL").join(F.broadcast(quantiles.select("column_name", "prob", "value")), "column_name")
    counts = met.groupBy("column_name", "prob").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cell") < F.col("value")).alias("below"),
                                                    F.count_if(F.col("cell") <= F.col("value")).alias("upto"))
    error = F.greatest(F.lit(0.0), F.col("prob") - F.col("upto") / F.col("n"), F.col("below") / F.col("n") - F.col("prob"))
    return counts.select("column_name", "prob", "n", error.alias("rank_error"))


# -------------------------------------------------------- frequent values

def _unseen_bound(tracked: int) -> float:
    """The share of the rows that a value outside the summary's answer can have at most.

    The summary's map holds a power of two of counters, at least tracked /
    0.75; its counts are off by 3.5 / counters of the rows at most, and a value
    is left out while its count is below twice that.
    """
    counters = 1
    while counters * 0.75 < tracked:
        counters *= 2
    return 7.0 / counters


def frequent_values_per_column(df: DataFrame, cols: list[str], k: int = 20, *, tracked: int = 10_000) -> DataFrame:
    """The result of ``top_values_per_column`` without shuffling the distinct values of wide columns.

    One pass gives each task's summary of at most ``tracked`` values a column;
    merged, they name candidates, whose exact counts a second pass takes (the
    candidates, some k a column, go to every task).  If the k-th exact
    count is above what any other value can have, the first k are proven.
    Columns without that proof (values of nearly equal frequency, or fewer
    than k values) are counted in full.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return top_values_per_column(df, cols, k)
    kept = min(tracked, 10 * k + 100)
    text = {c: F.col(quoted(c)).cast("string") for c in cols}
    named = df.select(*(text[c].alias(f"_{i}") for i, c in enumerate(cols)))
    summary = named.agg(F.count(F.lit(1)).alias("n"), *(F.expr(f"approx_top_k(_{i}, {kept}, {tracked})").alias(f"t{i}") for i in range(len(cols))))
    found = summary.first()  # one row: at most ``kept`` values a column
    bound, candidates = {}, []
    for i, c in enumerate(cols):
        items = found[f"t{i}"] or []
        candidates += [(c, x["item"]) for x in items]
        bound[c] = max(found["n"] * _unseen_bound(tracked), items[-1]["count"] if len(items) == kept else 0)
    if not candidates:
        return top_values_per_column(df, cols, k)
    wanted = F.broadcast(df.sparkSession.createDataFrame(candidates, "column_name string, value string"))
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), text[c].alias("value")) for c in cols])).alias("kv")).select("kv.*").alias("l")
    w = wanted.alias("r")
    exact = (cells.join(w, (F.col("l.column_name") == F.col("r.column_name")) & F.col("l.value").eqNullSafe(F.col("r.value")), "left_semi")
             .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows")).collect())  # at most ``kept`` rows a column
    first: list[tuple] = []
    open_ = []
    for c in cols:
        own = sorted(((r["value"], r["n_rows"]) for r in exact if r["column_name"] == c), key=lambda x: (-x[1], x[0] is not None, (x[0] or "").encode()))
        if len(own) >= k and own[k - 1][1] > bound[c]:
            first += [(c, value, n, rank) for rank, (value, n) in enumerate(own[:k], 1)]
        else:
            open_.append(c)
    proven = df.sparkSession.createDataFrame(first, "column_name string, value string, n_rows long, rank int")
    return proven.union(top_values_per_column(df, open_, k)) if open_ else proven


# ------------------------------------------------------ distinct entities

def entity_bitmaps(events: DataFrame, *, day: str, key: str) -> DataFrame:
    """Which entities were active on each day: day, bucket, bitmap (one row per day and 32,768 ids that occur).

    Made for numbers given out in sequence: an integer ``key``; NULL keys are nobody.
    """
    kind = dict(events.dtypes)[key]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{key} must be an integer id, got {kind}")
    known = events.where(F.col(quoted(key)).isNotNull())
    return known.groupBy(F.col(quoted(day)).alias("day"), F.bitmap_bucket_number(quoted(key)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(quoted(key))).alias("bitmap"))


def active_entities(bitmaps: DataFrame, windows: dict[str, int]) -> DataFrame:
    """Distinct entities per day and, for each (name -> days) of ``windows``, over the days that end with it.

    Only the bitmaps are read: each is handed to the days whose window it is in, and ORed there.
    """
    days = bitmaps.select("day").distinct()
    out = days
    for name, length in windows.items():
        if length < 1:
            raise ValueError("a window has at least one day")
        ends = F.sequence(F.col("day"), F.date_add("day", length - 1))
        spread = bitmaps.select(F.explode(ends).alias("day"), "bucket", "bitmap")
        ored = spread.groupBy("day", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        out = out.join(ored.groupBy("day").agg(F.sum(F.bitmap_count("bitmap")).alias(name)), "day", "left")
    return out
