"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_agrees_with_sql(spark, tables, name):
    df = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, tables, sql) is None


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["photo_id", "longitude", "latitude", "license"]
    assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


# Queries whose joins and hot-key branches take another path when nothing may be broadcast.
SHUFFLED = [
    "j1_flagged_license_join", "j3_composite_join", "j4_lookup_join", "j5_unrated_items",
    "j6_point_in_box_grid", "a1_group_members", "a15_cosine", "p10_at_least_own_mean",
    "m1_zscore", "m9_knn_recommend", "t8_merge_distinct",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_without_broadcast(spark, tables, without_broadcast, name):
    df = contract.queries()[name](spark, FOLDER)
    assert difference(df, tables, contract.oracle_sql()[name]) is None
