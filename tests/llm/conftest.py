import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, equal and null ids, and columns named like the operators' own."""
    long = "word " * 30_000 + "end"
    rows = [(1, "alpha beta gamma delta epsilon zeta", "s1", "x"), (1, "alpha beta gamma delta epsilon zeta", "s1", "x"), (2, None, None, None),
            (3, "", "s2", ""), (4, long, "s2", "y"), (None, "the mit license", None, "z"), (5, " \t\n", "s1", "w"),
            (6, "Ünïcode wörds Ünd EMOJI 😀 mixed", "s3", None), (7, "alpha beta gamma delta epsilon zeta", "s4", "v")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, node string").selectExpr(
        "doc_id", "text", "source", "node", "node as `range`", "1 as id", "'a' as token", "0 as n", "2 as size", "'k' as key", "0.5 as score",
        "'q' as `a.b`", "'r' as `back``tick`", "1.5 as `two words`")


@pytest.fixture
def nothing(odd):
    return odd.limit(0)


def rows(df):
    return [tuple(r) for r in df.collect()]
