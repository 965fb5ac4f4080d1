"""Run reports: conservation of rows, rejects per rule, table sizes, profile totals.

Each report is one aggregate per input (partial aggregation, tiny
shuffle); they return DataFrames, nothing is printed or collected.

Reports on published ledgers read the values of a rejected record out of
its VARIANT by path; no record is turned back into text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustfold.functions.text import row_digest


def reconcile(*, raw: DataFrame, tagged: DataFrame, trusted: DataFrame, rejects: DataFrame,
              by: str) -> DataFrame:
    """Per group ``by``: raw rows, trusted rows, distinct rejected records,
    collapsed identical copies and the balance (0 when no row was lost).

    A record failing k rules has k rejects; it is counted once through its
    distinct original record (two different raw rows cannot share it: they
    would have been identical copies, collapsed already), told by a 128-bit
    digest, so no record is shuffled.
    """
    r = raw.groupBy(by).agg(F.count(F.lit(1)).alias("raw_rows"))
    d = tagged.groupBy(by).agg(F.count(F.lit(1)).alias("distinct_rows"))
    t = trusted.groupBy(by).agg(F.count(F.lit(1)).alias("trusted_rows"))
    q = rejects.groupBy(by).agg(F.count_distinct(row_digest(["original_record"])).alias("rejected_records"))
    j = r.join(d, by, "inner").join(t, by, "left").join(q, by, "left")
    tr = F.coalesce("trusted_rows", F.lit(0))
    rj = F.coalesce("rejected_records", F.lit(0))
    collapsed = F.col("raw_rows") - F.col("distinct_rows")
    return j.select(
        by, "raw_rows", tr.alias("trusted_rows"), rj.alias("rejected_records"),
        collapsed.alias("collapsed_copies"),
        (F.col("raw_rows") - tr - rj - collapsed).alias("balance"),
    )


def rule_counts(ledger: DataFrame) -> DataFrame:
    """Rejects per rule, most frequent first (ties by rule name)."""
    return ledger.groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows")).orderBy(
        F.desc("n_rows"), F.asc("rule")
    )


def record_field(name: str, kind: str = "string", record: str = "original_record") -> Column:
    """The value of a published record's field as ``kind``; NULL where it is missing or cannot be read so."""
    quote = '"' if "'" in name else "'"  # variant paths know no escapes
    if quote in name:
        raise ValueError(f"a variant path cannot name a field with both kinds of quotes: {name}")
    return F.try_variant_get(record, f"$[{quote}{name}{quote}]", kind)


def rejected_values(ledger: DataFrame, fields: dict[str, tuple[str, ...]], lists: dict[str, str] | None = None) -> DataFrame:
    """The values that made records fail, out of a published ledger: rule, column_name, value,
    n_rows and n_numbers (how many of them read as a number).

    ``fields`` names, per rule, the fields of the record to report;
    ``lists`` the one field that holds a list of names (a rejected header),
    reported name by name.  Other rules are left out.  Values are counted
    before anything else is done with them, so the shuffle holds one row a
    task and distinct value.
    """
    def rows(rule: str, columns: tuple[str, ...]) -> Column:
        return F.array(*(F.struct(F.lit(c).alias("column_name"), record_field(c).alias("value"), record_field(c, "double").isNotNull().alias("number"))
                         for c in columns))

    def names(column: str) -> Column:
        return F.transform(record_field(column, "array<string>"), lambda n: F.struct(
            F.lit(column).alias("column_name"), n.alias("value"), n.try_cast("double").isNotNull().alias("number")))

    found = F.lit(None)
    for rule, columns in fields.items():
        found = F.when(F.col("rule") == rule, rows(rule, tuple(columns))).otherwise(found)
    for rule, column in (lists or {}).items():
        found = F.when(F.col("rule") == rule, names(column)).otherwise(found)
    each = ledger.filter(F.col("rule").isin([*fields, *(lists or {})])).select("rule", F.explode(found).alias("x"))
    return each.groupBy("rule", "x.column_name", "x.value").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("x.number").alias("n_numbers"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table with its row count (a UNION ALL of counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_summary(profile: DataFrame, count_col: str, name: str) -> DataFrame:
    """Totals of a feature table: rows, sum of a count metric, and rows where
    that metric is zero (e.g. customers with no calls)."""
    return profile.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(count_col).cast("bigint").alias(f"sum_{count_col}"),
        F.count(F.when(F.col(count_col) == 0, 1)).alias(f"zero_{count_col}"),
    )
