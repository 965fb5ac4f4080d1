"""Header contracts: is a file's header usable, and where is each column?

Names are compared in normalised form (blanks trimmed as Python's ``strip``
does, lower case); the exact names are kept for the reject record.  Two
rules block a file:

* ``repeated_header``: a normalised name appears more than once.  One error
  per repeated name, in order of first appearance.
* ``missing_column``: an expected column is absent.  One error per missing
  column, in contract order.

Extra columns are not an error and the order of columns is irrelevant:
reading is by name.  The check is a projection over one row per file (array
functions, no shuffle), so it costs nothing next to the data scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPEATED = "repeated_header"
MISSING = "missing_column"


@dataclass(frozen=True)
class Contract:
    """What a batch file must carry.

    ``columns``: canonical names in output order; ``key``: entity key column;
    ``types``: typed columns and their Spark type (others stay text);
    ``label``: optional yes/no column mapped to 1/0.
    """

    columns: tuple[str, ...]
    key: str
    types: dict = field(default_factory=dict)
    label: str | None = None
    positive: str = "Yes"
    negative: str = "No"
    int_policy: str = "legacy"
    type_rule_prefix: str = "not_numeric_"
    conflict_rule: str = "conflicting_duplicate_key"

    def __post_init__(self) -> None:
        cols = [c.strip().lower() for c in self.columns]
        if len(set(cols)) != len(cols):
            raise ValueError("contract columns repeat after normalisation")
        for c in [self.key, *self.types, *([self.label] if self.label else [])]:
            if c not in self.columns:
                raise ValueError(f"{c} is not a contract column")


# Fixed value: the characters Python's ``str.strip()`` removes (``str.isspace``),
# so a name is normalised alike in Spark expressions and in Python code
# (Spark's ``trim`` removes spaces only).
_BLANKS = r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
_STRIP = rf"\A{_BLANKS}+|{_BLANKS}+\z"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, _STRIP, "")


def _norm(c: Column) -> Column:
    return F.lower(_strip(c))


def header_errors(headers: DataFrame, expected: list[str] | tuple[str, ...]) -> DataFrame:
    """Per file, the ordered list of header errors.

    ``headers``: ``source_file``, ``header`` (array of exact names).
    Returns ``source_file``, ``header``, ``errors`` (array of
    struct<rule, column>), empty when the file is usable.
    """
    norm = F.transform("header", _norm)
    # repeated: distinct normalised names (first-appearance order) seen twice+
    repeated = F.filter(
        F.array_distinct(norm), lambda n: F.size(F.filter(norm, lambda x: x == n)) > 1
    )
    repeated_err = F.transform(
        repeated,
        lambda n: F.struct(
            F.lit(REPEATED).alias("rule"),
            _strip(F.element_at("header", F.array_position(norm, n).cast("int"))).alias("column"),
        ),
    )
    expected_arr = F.array(*[F.lit(e) for e in expected])
    missing = F.filter(expected_arr, lambda e: ~F.array_contains(norm, _norm(e)))
    missing_err = F.transform(
        missing, lambda e: F.struct(F.lit(MISSING).alias("rule"), e.alias("column"))
    )
    return headers.select(
        "source_file", "header", F.concat(repeated_err, missing_err).alias("errors")
    )


def column_positions(header: list[str], expected: list[str] | tuple[str, ...]) -> list[int]:
    """0-based position of each expected column in a (valid) header."""
    norm = [h.strip().lower() for h in header]
    return [norm.index(e.strip().lower()) for e in expected]
