"""Binding of ``orders`` to dated text batches (the raw input of the trust stage).

Every order becomes a text record in the batch of its order year.  Derived
deterministically from the order key (fixed values of this binding):

* ``o_custkey`` text: ``' '`` when key % 97 = 0, ``'abc'`` when % 89,
  NULL when % 83, ``'99999999999'`` (int overflow) when % 73, else the number
* ``o_totalprice`` text: ``'n/a'`` when key % 101 = 0, ``' '`` when % 103,
  else the price rendered from integer cents (``123.40``)
* identical copy in the same batch when key % 50 = 0
* a second version (priority ``CHANGED``) in the same batch when key % 71 = 0
* a later snapshot in the next year's batch when key % 60 = 0

Batches are written by Spark as CSV folders ``batch=<year>`` (several part
files each) in one of four header layouts, so the reader has to match by
name and the contract check has files to reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.bindings.usage import table
from trustfold.operators.contracts import Contract

ORDER_CONTRACT = Contract(
    columns=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
             "o_orderpriority", "batch_date"),
    key="o_orderkey",
    types={"o_custkey": "int", "o_totalprice": "double"},
    label="o_orderstatus",
    positive="F",
    negative="O",
)
TEXT_COLUMNS = list(ORDER_CONTRACT.columns)

# Header layouts of the batch files, per batch (exact names).
LAYOUT_CANONICAL = list(ORDER_CONTRACT.columns)
LAYOUT_RENAMED = [" O_ORDERPRIORITY", "o_comment", "O_TotalPrice ", "o_orderdate", "o_custkey",
                  "O_ORDERKEY", "o_orderstatus", "Batch_Date"]
LAYOUT_MISSING = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
                  "batch_date"]
LAYOUT_REPEATED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                   "o_orderpriority", "batch_date", " O_CUSTKEY "]
BATCH_LAYOUTS = {
    "1995": LAYOUT_CANONICAL,
    "1996": LAYOUT_REPEATED,
    "1997": LAYOUT_CANONICAL,
    "1998": LAYOUT_RENAMED,
    "1999": LAYOUT_RENAMED,
    "2000": LAYOUT_RENAMED,
    "2001": LAYOUT_MISSING,
    "2002": LAYOUT_CANONICAL,
}
ALL_BATCHES = sorted(BATCH_LAYOUTS)
REJECTED_BATCHES = ["1996", "2001"]


def _source(layout_name: str) -> str:
    """Which text column feeds a header name of a layout."""
    n = layout_name.strip().lower()
    return "o_comment" if n == "o_comment" else n


def order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw text records: ``batch`` + the contract columns (+ ``o_comment``)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    cust = (
        F.when(k % 97 == 0, F.lit(" ")).when(k % 89 == 0, F.lit("abc"))
        .when(k % 83 == 0, F.lit(None).cast("string")).when(k % 73 == 0, F.lit("99999999999"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    price = (
        F.when(k % 101 == 0, F.lit("n/a")).when(k % 103 == 0, F.lit(" "))
        .otherwise(F.concat(F.expr("cast(round(o_totalprice * 100) as bigint) div 100").cast("string"),
                            F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")))
    )
    year = F.year("o_orderdate").cast("string")
    base = o.select(
        year.alias("batch"),
        k.cast("string").alias("o_orderkey"),
        cust.alias("o_custkey"),
        F.col("o_orderstatus"),
        price.alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.col("o_orderpriority"),
        F.concat(year, F.lit("-01-01")).alias("batch_date"),
        F.concat(F.lit("note "), k.cast("string")).alias("o_comment"),
        k.alias("__k"),
    )
    # a key's records side by side: one scan, and one file a task and folder where they are written
    key = F.col("__k")
    records = base.withColumn("__record", F.explode(F.array_compact(F.array(
        F.lit("row"), F.when(key % 50 == 0, F.lit("copy")), F.when(key % 71 == 0, F.lit("version")), F.when(key % 60 == 0, F.lit("later"))))))
    version, later = F.col("__record") == "version", F.col("__record") == "later"
    nxt = (F.col("batch").cast("int") + 1).cast("string")
    return records.withColumns({
        "o_orderpriority": F.when(version, F.lit("CHANGED")).otherwise(F.col("o_orderpriority")),
        "batch_date": F.when(later, F.concat(nxt, F.lit("-01-01"))).otherwise(F.col("batch_date")),
        "batch": F.when(later, nxt).otherwise(F.col("batch")),
    }).drop("__k", "__record")


def _text_sql() -> str:
    cust = ("CASE WHEN k % 97 = 0 THEN ' ' WHEN k % 89 = 0 THEN 'abc' WHEN k % 83 = 0 THEN NULL "
            "WHEN k % 73 = 0 THEN '99999999999' ELSE CAST(o_custkey AS VARCHAR) END")
    price = ("CASE WHEN k % 101 = 0 THEN 'n/a' WHEN k % 103 = 0 THEN ' ' ELSE "
             "CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 100 AS VARCHAR) || '.' || "
             "lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') END")
    return f"""
base AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS batch, CAST(k AS VARCHAR) AS o_orderkey,
         {cust} AS o_custkey, o_orderstatus, {price} AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
         CAST(year(o_orderdate) AS VARCHAR) || '-01-01' AS batch_date, k
  FROM (SELECT o_orderkey AS k, * FROM orders) o),
raw AS (
  SELECT batch, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, batch_date FROM base
  UNION ALL
  SELECT batch, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, batch_date FROM base WHERE k % 50 = 0
  UNION ALL
  SELECT batch, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'CHANGED', batch_date FROM base WHERE k % 71 = 0
  UNION ALL
  SELECT CAST(CAST(batch AS INTEGER) + 1 AS VARCHAR), o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority, CAST(CAST(batch AS INTEGER) + 1 AS VARCHAR) || '-01-01' FROM base WHERE k % 60 = 0)"""


RAW_TEXT_CTE = _text_sql()
_rejected = ", ".join(f"'{b}'" for b in REJECTED_BATCHES)
# CTEs shared by the oracle queries: raw, accepted (header-valid batches),
# dist (identical copies collapsed), ver (versions per batch and key).
TRUST_CTES = f"""WITH {RAW_TEXT_CTE.strip()},
accepted AS (SELECT * FROM raw WHERE batch NOT IN ({_rejected})),
dist AS (SELECT DISTINCT * FROM accepted),
ver AS (SELECT batch, o_orderkey, count(*) AS n FROM dist GROUP BY batch, o_orderkey),
single AS (SELECT d.* FROM dist d JOIN ver v ON d.batch = v.batch AND d.o_orderkey = v.o_orderkey WHERE v.n = 1),
conflict AS (SELECT d.* FROM dist d JOIN ver v ON d.batch = v.batch AND d.o_orderkey = v.o_orderkey WHERE v.n > 1)"""


def write_batches(df: DataFrame, root: str) -> list[str]:
    """Write the text records as CSV batch folders in their layouts; return
    the batch folder paths (explicit list, in batch order)."""
    for layout in {tuple(v) for v in BATCH_LAYOUTS.values()}:
        batches = [b for b, lay in BATCH_LAYOUTS.items() if tuple(lay) == layout]
        cols = [F.col(_source(n)).alias(n) for n in layout]
        (
            df.where(F.col("batch").isin(batches))
            .select(*cols, "batch")
            .write.mode("append").partitionBy("batch")
            .option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(root)
        )
    return [f"{root}/batch={b}" for b in ALL_BATCHES]
