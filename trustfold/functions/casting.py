"""Column expressions for strict typing of text columns.

Spark 4 runs with ANSI mode on, where a plain ``cast`` of bad text raises.
Every conversion here goes through ``try_cast`` so bad text becomes NULL
instead, and the session setting is never touched.

Two integer policies are offered:

* ``legacy`` (default) reproduces the non-ANSI string-to-int cast the
  rules were written against: surrounding blanks are ignored and a
  fractional part is truncated (``"5.7" -> 5``, ``".5" -> 0``).
* ``strict`` is plain ``try_cast``: any fractional text is rejected.

Doubles need no policy: ``try_cast`` accepts the same spellings in both
modes (``1e3``, ``NaN``, ``Infinity``, ``5d``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_POLICIES = ("legacy", "strict")

_INTEGRAL = {"int", "integer", "bigint", "long", "smallint", "short", "tinyint", "byte"}
# The bytes Spark's string-to-number cast trims from both ends
# (ASCII control characters, space, DEL; measured on Spark 4.1), and the text
# its non-ANSI integer cast accepts once trimmed: a sign, digits, and an
# optional fraction of digits that is dropped.
_WS = r"[\x00-\x20\x7F]"
_TRIM_ALL = rf"\A{_WS}+|{_WS}+\z"
_LEGACY_INT = r"\A[+-]?[0-9]*(\.[0-9]*)?\z"
_SIGN_ONLY = r"\A[+-]?\z"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cast_text(col: str | Column, dtype: str, int_policy: str = "legacy") -> Column:
    """``try_cast`` of a text column to ``dtype`` under the chosen int policy."""
    if int_policy not in INT_POLICIES:
        raise ValueError(f"int_policy must be one of {INT_POLICIES}, got {int_policy!r}")
    c = _c(col)
    if dtype.lower() in _INTEGRAL and int_policy == "legacy":
        # the cast trims control characters too (tabs, newlines), not only
        # the spaces ``trim`` removes
        t = F.regexp_replace(c, _TRIM_ALL, "")
        whole = F.regexp_extract(t, r"\A([+-]?[0-9]*)", 1)
        # "5.7" / "5." -> "5"; ".5" / "-." / "." -> "0"; "" / "+" / "3 .5" -> NULL
        text = F.when(
            t.rlike(_LEGACY_INT) & ~t.rlike(_SIGN_ONLY),
            F.when(whole.rlike(_SIGN_ONLY), F.lit("0")).otherwise(whole),
        )
        # clean cells convert at once; only the others meet the patterns
        return F.coalesce(c.try_cast(dtype), text.try_cast(dtype))
    return c.try_cast(dtype)


def castable(col: str | Column, dtype: str, int_policy: str = "legacy") -> Column:
    """True when the text is present and converts to ``dtype``."""
    return cast_text(col, dtype, int_policy).isNotNull()


def uncastable(col: str | Column, dtype: str = "double", int_policy: str = "legacy") -> Column:
    """Non-null text that does not convert (the "silently lost" values)."""
    return _c(col).isNotNull() & cast_text(col, dtype, int_policy).isNull()


def is_blank(col: str | Column) -> Column:
    """Text that is empty once surrounding blanks are removed."""
    return F.trim(_c(col)) == F.lit("")


def is_dirty(col: str | Column, dtype: str = "double", int_policy: str = "legacy") -> Column:
    """NULL, blank, or not convertible after trimming; never NULL itself."""
    c = _c(col)
    return c.isNull() | is_blank(c) | cast_text(F.trim(c), dtype, int_policy).isNull()
