"""Every registered query against its oracle at the smallest scale."""

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tastemill.plans import catalog

# Those of the optional part have their own tests.
QUERIES, ORACLES = ({k: x for k, x in found.items() if k in catalog.QUERIES} for found in (queries(), oracle_sql()))


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, duck, name):
    ok, note = compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name])
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_scratch_tables_have_an_owner(spark):
    import os

    from tastemill.session import cut_lineage, release

    release(spark)
    path = cut_lineage(spark.range(3)).inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    assert release(spark) == 1 and not os.path.exists(path) and release(spark) == 0


def test_entry(spark):
    assert entry(spark).count() == 2
