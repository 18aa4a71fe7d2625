"""Every registered query against its SQL in another engine."""

import compare
import pytest

from plaudit.plans.oracle import ORACLE
from plaudit.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, sf_dir, duck, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = compare.duck_rows(duck, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected
