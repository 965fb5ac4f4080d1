"""The ``legacy`` integer policy equals Spark's non-ANSI string-to-int cast
(the behaviour the rules were written against), checked on generated text.
All values go through one DataFrame per policy, so Spark runs once."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trustfold.functions.casting import cast_text

# text built from the characters a numeric column can carry
_CHARS = st.sampled_from(list("0123456789") + ["+", "-", ".", " ", "\t", "\n", "\r", "\x0b", "\x00", "\x7f", "\x85", "\u2003", "e", "E", "x", "5"])
_TEXT = st.one_of(
    st.text(_CHARS, max_size=12),
    st.from_regex(r"\A[ \t]*[+-]?[0-9]{0,12}(\.[0-9]{0,4})?[ \t]*\Z", fullmatch=True),
    st.integers(min_value=-(2**40), max_value=2**40).map(str),
)


@pytest.fixture()
def non_ansi(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(_TEXT, min_size=50, max_size=200))
def test_legacy_int_policy_equals_non_ansi_cast(non_ansi, values):
    df = non_ansi.createDataFrame([(v,) for v in values], "v string")
    # the non-ANSI reference cast is computed in this test's session only
    rows = df.select("v", cast_text("v", "int", "legacy").alias("ours"),
                     df["v"].cast("int").alias("spark")).collect()
    bad = [(r.v, r.ours, r.spark) for r in rows if r.ours != r.spark]
    assert not bad, bad[:10]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(_TEXT, st.sampled_from(["1e3", "NaN", "Infinity", "-Infinity", "5d", "5f",
                                                          " 2.5\t", "1_000", "0x10", ".", "-"])),
                       min_size=50, max_size=200))
def test_double_cast_equals_non_ansi_cast(non_ansi, values):
    df = non_ansi.createDataFrame([(v,) for v in values], "v string")
    rows = df.select("v", cast_text("v", "double").alias("ours"), df["v"].cast("double").alias("spark")).collect()
    bad = [(r.v, r.ours, r.spark) for r in rows
           if not (r.ours == r.spark or (r.ours != r.ours and r.spark != r.spark))]  # NaN == NaN
    assert not bad, bad[:10]
