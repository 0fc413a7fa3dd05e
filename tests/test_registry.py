"""Every registered query against its SQL, on the smallest of the given data sets."""

import os
from functools import partial

import pytest

import __spark_entry__ as registry
from compare import compare, connect
from tallyline.queries import catalog, oracle

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not mounted")


def test_every_query_has_its_sql():
    assert set(catalog.registered()) - set(oracle.statements()) == set()
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, catalog.registered()[name], oracle.statements()[name], SMALL) is None


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_a_published_set_builds_its_history_once(spark, monkeypatch):
    built, history = [], catalog.inputs.history
    monkeypatch.setattr(catalog.inputs, "history", lambda *given: built.append(1) or history(*given))
    monkeypatch.setattr(catalog.model, "BoostParams", partial(catalog.model.BoostParams, rounds=2))
    catalog.forget_models()
    try:
        assert catalog.set_published(spark, SMALL).count() > 0
    finally:
        catalog.forget_models()
    assert len(built) == 1
