"""Every query with SQL gives the rows of a second engine; the others run."""

import os

import pytest

import __spark_entry__ as entry
from compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
# those of the text subpackage have tests of their own
QUERIES = {n: q for n, q in entry.queries().items() if n not in entry.LLM_QUERIES}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if n not in entry.LLM_ORACLES}
# fits that take long; their operators have tests of their own in test_models.py
LONG = {"ml_gbt_deep", "ml_gbt_plain", "ml_adaboost", "ml_cv_grid", "ml_boost_deep", "ml_boost_leafwise"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - LONG))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_city_product_equals_sql(spark, connection):
    from saleslake.plans.series_queries import CITY_PRODUCT_SQL

    assert difference(QUERIES["fc_city_product"](spark, FOLDER), connection, CITY_PRODUCT_SQL) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
