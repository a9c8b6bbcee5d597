"""Texts of some MB, and single matches as long as their text."""

import pytest

from tests.llm.test_scans import CASES, base, bag, spans_of
from voxelyard.llm import licenses, pii, secrets

N = 1_000_000
LONG = [
    "1" * 3 * N, "1 " * N, "1-" * N + "x", "x@" + "a." * N + "b", "a." * N + "@b", "x at y" + " dot z" * N, "Mr" + " Abc" * N, "John" + " Smith" * N, "+1" + " 2" * N, "+1" + " (" * N,
    "1." * N + "1", "token=" + "aB3" * N, "token" + " " * N + "=abcdefgh", "AKIA" + "B7" * N, "0af" * N, "user=bob https://h." + "a.b/" * N, "server=" + "a." * N + "b", "mit license\n * " * 200_000,
]


@pytest.fixture(scope="module")
def long_docs(spark):
    return spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string").repartition(4).cache()


def test_secrets(long_docs):
    rules, _ = CASES[secrets]
    assert spans_of(secrets.scan(long_docs), len(rules)) == bag((i, base(t, rules)) for i, t in enumerate(LONG))


def test_spelled_chain(spark):
    """A repeat within a match doesn't use the stack of the thread: 1.2 MB in one match; the time is that of the
    windows over its 200,000 dots, so the text is no larger."""
    docs = spark.createDataFrame([(1, "x at y" + " dot z" * 200_000), (2, "mail x at y dot com")], "doc_id long, text string")
    assert {r["doc_id"] for r in pii.scan(docs).collect()} == {1, 2}


def test_license_match_of_some_mb(spark):
    docs = spark.createDataFrame([(1, "Neither the name of " + "the institute, " * 200_000 + "nor"), (2, "mit license\n * " * 100_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert got[1]["labels"] == ["bsd-3-clause"] and got[2]["n_base"] == 100_000
