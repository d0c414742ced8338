"""Registered queries beside their SQL. CALIPERS_ALL=1 runs every one of them."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from calipers.plans.oracles import ORACLES
from calipers.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
SOME = ["dim_lookup", "eav_product", "collection_dims", "front_items", "review_json", "lookback_snapshot", "rug_labels",
        "components", "canopy_label", "ring_filter", "corner_points", "end_caps", "annotation_plan"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("CALIPERS_ALL") else SOME)
def test_same_rows(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None
