"""Every named query against its DuckDB twin on the smallest data set."""

import pytest

import __spark_entry__ as entry
import compare
from shelfweave.plans import catalogue

NAMES = sorted(catalogue.QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(catalogue.ORACLE) == set(catalogue.QUERIES)
    assert set(catalogue.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, sf_dir, name):
    line = compare.compare(spark, con, sf_dir, name)
    assert line.startswith("OK"), line
    assert "TYPES" not in line, line


def test_entry(spark):
    assert entry.entry(spark).count() > 0
