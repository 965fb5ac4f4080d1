"""Raw batch files -> trusted table + quarantine (the whole trust stage).

Order of the rules, per run:

1. headers of every file (one job) checked against the contract; a file with
   any header error is rejected whole and none of its rows is used;
2. accepted files read by name in one scan, each by its header layout;
3. identical copies collapsed, conflicting versions of a key rejected;
4. typed columns converted, rows with a NULL/bad value rejected (one reject
   per failing column); a conflicting key is only reported as a conflict;
5. label mapped (when the contract has one), lineage stamped.

The raw files are parsed once: the collapsed rows (step 3's first half) are
written to the shared scratch folder, and so are the few conflicting keys.
The trusted rows and the rejects are both computed from these two tables,
so both outputs describe the same rows; converting the typed columns twice
is cheaper than writing all rows a second time.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.functions.text import parent_path
from trustfold.operators.contracts import Contract, header_errors
from trustfold.operators.dedup import collapse_identical, conflicting_keys, count_versions, numbered_files
from trustfold.operators.lineage import map_label, stamp
from trustfold.operators.quarantine import (
    Run,
    from_file_errors,
    from_rows,
    union_all,
)
from trustfold.operators.strict_types import FAILED, tag_failures, typed_projection
from trustfold.session import materialize, scratch_path
from trustfold.sources.batches import ORIGIN, read_by_layout, read_headers


@dataclass
class TrustedOutput:
    trusted: DataFrame
    quarantine: DataFrame
    verdicts: DataFrame  # source_file, header, errors (one row per file)
    file_errors: DataFrame  # source_file (file or folder), rule, column, header
    tagged: DataFrame  # distinct rows + __versions + __failed_rules, computed from the scratch tables
    raw: DataFrame  # accepted files as read (lazy; re-reads the files when used)
    scratch: str  # folder of the scratch tables; discard it once both outputs are written


@dataclass
class Routing:
    """Which layout each file is read by."""

    layouts: dict[int, list[str]]  # number -> exact header, of the layouts that meet the contract
    routed: DataFrame  # source_file, layout (NULL: rejected), one row per file
    file_errors: DataFrame  # source_file (file or folder), rule, column, header
    verdicts: DataFrame  # source_file, header, errors


def route_files(spark: SparkSession, paths: list[str], contract: Contract, unit: str = "file") -> Routing:
    """Header verdict of every file, the layout each accepted file is read by,
    and the file-level rejects.  The contract is checked once per layout; the
    driver sees the distinct layouts and no file name.

    With ``unit="folder"`` a folder is one batch drop: if any of its files
    fails the header check the whole folder is rejected (a partial batch
    would lose rows silently), and the rejects are reported once per
    folder, distinct header and rule, with the folder as source.
    """
    heads = read_headers(spark, paths)
    distinct = heads.select("header").distinct().withColumn("source_file", F.lit(""))
    checked = header_errors(distinct, contract.columns).select("header", "errors").collect()
    error = pa.struct([("rule", pa.string()), ("column", pa.string())])
    layouts = spark.createDataFrame(pa.table({  # an Arrow table reaches the tasks without a Python worker
        "header": pa.array([r["header"] for r in checked], pa.list_(pa.string())),
        "errors": pa.array([[e.asDict() for e in r["errors"]] for r in checked], pa.list_(error)),
        "layout": pa.array(range(len(checked)), pa.int32())}))
    verdicts = heads.join(F.broadcast(layouts), "header")  # one row a layout
    named = verdicts.withColumn("unit", F.col("source_file") if unit == "file" else parent_path("source_file"))
    bad = named.where(F.size("errors") > 0)
    rejected = bad.select("unit").distinct().withColumn("rejected", F.lit(True))
    routed = named.join(rejected, "unit", "left").select("source_file", F.when(F.col("rejected").isNull(), F.col("layout")).alias("layout"))
    file_errors = bad.select(F.col("unit").alias("source_file"), F.explode("errors").alias("e"), "header").select(
        "source_file", "e.rule", "e.column", "header").distinct()
    good = {i: list(r["header"]) for i, r in enumerate(checked) if not r["errors"]}
    return Routing(good, routed, file_errors, verdicts.select("source_file", "header", "errors"))


def read_accepted(spark: SparkSession, paths: list[str], routing: Routing, contract: Contract) -> DataFrame:
    return read_by_layout(spark, paths, routing.layouts, routing.routed, contract.columns)


def build_trusted(spark: SparkSession, paths: list[str], contract: Contract, run: Run, *,
                  unit: str = "file", scratch: str | None = None) -> TrustedOutput:
    routing = route_files(spark, paths, contract, unit)
    raw = read_accepted(spark, paths, routing, contract)

    root = scratch or scratch_path(spark, "trusted", run.run_id)
    # the collapsed rows are written once: counting versions, the trusted rows and the rejects read that table
    # (the count only its unit and key columns) instead of parsing the raw files and shuffling them again
    collapsed = materialize(collapse_identical(raw, origin=ORIGIN, unit=unit, files=numbered_files(routing.routed, "source_file")), path=f"{root}/collapsed")
    conflicts = materialize(conflicting_keys(collapsed, key=contract.key, origin=ORIGIN, unit=unit), path=f"{root}/conflicts")
    tagged = count_versions(collapsed, key=contract.key, origin=ORIGIN, unit=unit, conflicts=conflicts)
    tagged = tag_failures(tagged, contract.types, int_policy=contract.int_policy,
                          prefix=contract.type_rule_prefix)

    cols = list(contract.columns) + [ORIGIN]
    single = F.col("__versions") == 1
    clean = single & (F.size(FAILED) == 0)
    trusted = tagged.where(clean).select(*typed_projection(cols, contract.types, int_policy=contract.int_policy))
    if contract.label:
        trusted = map_label(trusted, contract.label, contract.positive, contract.negative)
    trusted = stamp(trusted, run)

    conflicts = from_rows(tagged.where(~single).select(*cols), contract.conflict_rule, run,
                          key=contract.key, origin=ORIGIN)
    bad_types = tagged.where(single & (F.size(FAILED) > 0)).select(*cols, F.explode(FAILED).alias("__rule"))
    type_rejects = from_rows(bad_types, F.col("__rule"), run, key=contract.key, origin=ORIGIN)
    files = from_file_errors(routing.file_errors, run)
    quarantine = union_all([files, conflicts, type_rejects])
    return TrustedOutput(trusted, quarantine, routing.verdicts, routing.file_errors, tagged, raw, root)
