"""Every registered query against its SQL on the smallest dataset."""

import pytest

import __spark_entry__ as entry_points
import compare
from tarnworks.plans.catalogue import all_queries
from tarnworks.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    assert compare.differences(all_queries()[name](spark, sf_dir), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert all_queries()[name](spark, sf_dir).count() > 0


def test_entry_points_agree():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
