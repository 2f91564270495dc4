"""Every registered query against its SQL twin, at the smallest scale."""

import pytest

import __spark_entry__ as entry
import check_oracle
from voxmill.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"subcategory_links", "fit_classifier", "predict_all", "holdout_metrics"}


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.fixture(scope="module")
def sqls(spark):
    return oracle.oracle_sql()


def test_every_query_has_sql_or_is_known_not_to(sqls):
    assert set(catalog.queries()) - set(sqls) == ROWS_ONLY
    assert set(sqls) <= set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - ROWS_ONLY))
def test_matches_sql(spark, con, sqls, name):
    _, problem = check_oracle.compare(spark, con, SF, name, catalog.queries()[name], sqls[name])
    assert problem is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
