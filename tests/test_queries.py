"""Every registered query against its SQL on whole tables."""

import subprocess
import sys

import pytest
from conftest import ROOT, TESTDATA

import __spark_entry__ as entry_points
import oracle
from streamwin.plans import catalog

QUERIES = catalog.queries()
SQL = catalog.oracles()
FOLDER = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


def test_every_query_is_registered_and_has_sql():
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert SQL.items() <= entry_points.oracle_sql().items()
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, db, name):
    oracle.assert_same(QUERIES[name](spark, FOLDER).toPandas(), db.sql(SQL[name]).df())


@pytest.mark.parametrize("missing", ["streamwin.llm", "xxhash", "regex", "public_tokenizers"])
def test_queries_stay_without_the_optional_package(missing):
    """A fresh interpreter in which a module can't be found."""
    code = (
        f"import sys; sys.modules[{missing!r}] = None; sys.path.insert(0, {ROOT!r})\n"
        "import __spark_entry__ as e; from streamwin.plans import catalog\n"
        "assert e.queries().keys() == catalog.queries().keys() and e.oracle_sql().keys() == catalog.oracles().keys()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True)


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns[-3:] == ["granularity", "window_start", "window_end"]
    assert result.count() > 0
