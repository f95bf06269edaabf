"""Every registered query against its SQL counterpart on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, con, name):
    assert difference(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["f16_murmur_bucket", "s04_clinical_totals",
                                  "m05_ordinal_ridge"])
def test_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
