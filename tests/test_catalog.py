"""Every query that has a check SQL agrees with DuckDB on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry
from tools.compare import connect, table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CHECKS = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def larger_duck():
    return connect(LARGER)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_check(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    found = table(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(CHECKS[name])
    assert found == table([d[0] for d in result.description], result.fetchall())


LARGER = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no larger tables")
@pytest.mark.parametrize("name", sorted(n for n in CHECKS if re.match(r"[mw]\d\d_", n)))
def test_metrics_and_curves_on_more_rows(spark, larger_duck, name):
    """Ties and exact sums that the smallest tables do not have."""
    df = entry.queries()[name](spark, LARGER)
    result = larger_duck.execute(CHECKS[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([d[0] for d in result.description], result.fetchall())


def test_flagship_runs(spark):
    assert entry.entry(spark).count() >= 0


def test_names_follow_the_families():
    assert all(re.fullmatch(r"[pjawrocksfem]\d\d_[a-z0-9_]+|op\d+_[a-z0-9_]+|pipeline", n) for n in entry.queries())
    assert set(CHECKS) <= set(entry.queries())
