"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest

from feedloom.queries import RUNS, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(RUNS) == set(SQL)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query_equals_sql(spark, compiled, duck, name):
    spark_types, (spark_columns, spark_rows) = compare.spark_side(RUNS[name](spark, SF_DIR))
    duck_types, (duck_columns, duck_rows) = compare.duck_side(duck, SQL[name])
    assert spark_columns == duck_columns
    assert spark_types == duck_types
    assert len(spark_rows) == len(duck_rows)
    assert spark_rows == duck_rows
