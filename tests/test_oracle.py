"""Every registered query against its SQL, on whole tables."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as contract
from starfold.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("STARFOLD_TEST_SF", "/root/testdata/sf0.001")

# Queries whose joins are shuffled once their sides are too large to broadcast.
JOINING = [
    "fact_match_inner", "fact_match_staging", "fact_match_left_first", "dictionary_map", "join_time_dim",
    "join_computed_key", "join_lookup_name", "top_played", "topk_then_join", "fact_place", "fact_place_month",
    "nearest_region", "point_lookup", "keyed_range_ordered", "dq_referential", "fill_sentinel", "place_key",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", JOINING)
def test_query_without_broadcast(spark, duck, no_broadcast, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["song_title", "played_freq"]
