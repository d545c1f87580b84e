"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from ledgerlens.plans import catalog
from compare import differences, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_only_model_fits_lack_sql():
    assert set(catalog.QUERIES) - set(ORACLES) == {"trained_model_metrics"}
    assert set(ORACLES) <= set(QUERIES)


def test_trained_model_beats_chance(spark, sf_dir):
    row = QUERIES["trained_model_metrics"](spark, sf_dir).first()
    assert row["auc"] > 0.8 and row["accuracy"] > 0.85 and row["rows"] > 100


def test_entry(spark):
    assert entry.entry(spark).count() == 4
