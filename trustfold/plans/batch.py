"""One batch run end to end: raw sources -> trusted tables + shared ledger ->
gold profiles -> run summary.

Per source (e.g. a labelled base and the weekly batches): the trust stage,
the trusted table replaced, and its rejects published into the
ledger slice of this run.  Gold is built from the trusted table *as written*
(read back: the trust stage's lineage is not recomputed, and a lost executor
re-reads files), and the summary is computed from the written tables, so the
event table is not scanned again for it.

Every write is a full replace (tables) or a slice replace (ledger: the run's
earlier slice goes even where the new one has no reject) behind one commit,
so a re-run of the same run id leaves the outputs exactly as one run would, and
a failed one leaves them as they were.  Outputs are read with ``read_table`` and
``read_ledger``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from trustfold.operators.contracts import Contract
from trustfold.operators.features import Metric, Ratio
from trustfold.operators.quarantine import Run, union_all
from trustfold.operators.report import profile_summary, rule_counts, table_counts
from trustfold.plans.gold import build_gold
from trustfold.plans.trusted import build_trusted
from trustfold.session import discard
from trustfold.sinks.tables import publish_ledger, read_ledger, read_table, replace_table


@dataclass(frozen=True)
class Source:
    """One raw source of a run: explicit file or folder paths, its contract,
    and how its rows get their as-of date (a literal date or a date column)."""

    paths: tuple[str, ...]
    contract: Contract
    unit: str = "file"
    as_of_date: str | None = None
    as_of_column: str | None = None


@dataclass
class BatchOutputs:
    trusted: dict[str, str]  # source name -> trusted table path
    gold: dict[str, str]  # source name -> gold table path
    ledger: str  # quarantine ledger path
    summary: DataFrame  # table, n_rows (+ gold totals when a count metric is named)
    gold_totals: dict[str, DataFrame] = field(default_factory=dict)
    rejects: DataFrame | None = None  # rule, n_rows of this run, from the published ledger


def run_batch(
    spark: SparkSession,
    sources: dict[str, Source],
    events: DataFrame,
    out_root: str,
    run: Run,
    *,
    metrics: list[Metric],
    ratios: list[Ratio] | tuple = (),
    event_key: str | None = None,
    day: str = "day",
    horizon_days: int = 90,
    summary_metric: str | None = None,
    ledger_path: str | None = None,
) -> BatchOutputs:
    """Run every source through trust and gold and write the outputs below
    ``out_root`` (``trusted/<name>``, ``gold/<name>``, ``quarantine`` unless
    ``ledger_path`` names a shared ledger)."""
    if not sources:
        raise ValueError("a run needs at least one source")
    root = out_root.rstrip("/")
    ledger = ledger_path or f"{root}/quarantine"
    trusted_paths: dict[str, str] = {}
    rejects, scratch = [], []
    for name, src in sources.items():
        out = build_trusted(spark, list(src.paths), src.contract, run, unit=src.unit)
        trusted_paths[name] = replace_table(out.trusted, f"{root}/trusted/{name}")
        rejects.append(out.quarantine)
        scratch.append(out.scratch)
    publish_ledger(union_all(rejects), ledger, run_id=run.run_id)
    for folder in scratch:  # trusted rows and rejects are written
        discard(spark, folder)

    gold_paths: dict[str, str] = {}
    for name, src in sources.items():
        trusted = read_table(spark, trusted_paths[name])
        gold = build_gold(
            trusted, events, key=src.contract.key, event_key=event_key, day=day,
            as_of_date=src.as_of_date, as_of_column=src.as_of_column, horizon_days=horizon_days,
            metrics=metrics, ratios=ratios,
        )
        gold_paths[name] = replace_table(gold, f"{root}/gold/{name}")

    tables = {f"trusted_{n}": read_table(spark, p) for n, p in trusted_paths.items()}
    tables.update({f"gold_{n}": read_table(spark, p) for n, p in gold_paths.items()})
    # a clean run publishes no reject: read_ledger copes with a ledger without files
    mine = read_ledger(spark, ledger, run_id=run.run_id)
    tables["quarantine"] = mine
    totals = {}
    if summary_metric:
        totals = {n: profile_summary(read_table(spark, p), summary_metric, f"gold_{n}")
                  for n, p in gold_paths.items()}
    return BatchOutputs(trusted_paths, gold_paths, ledger, table_counts(tables), totals, rule_counts(mine))
