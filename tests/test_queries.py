"""Every core query on the small tables: against its SQL form where it has one, else that it gives rows."""

import os

import pytest

from quernstone.plans.catalog import core_registry
from tests.oracle import FOLDER, compare

REGISTRY = core_registry()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(REGISTRY.oracles))
def test_against_sql(spark, name):
    compare(spark, REGISTRY.queries[name], REGISTRY.oracles[name])


@pytest.mark.parametrize("name", sorted(set(REGISTRY.queries) - set(REGISTRY.oracles)))
def test_gives_rows(spark, name):
    assert REGISTRY.queries[name](spark, FOLDER).count() > 0


def test_entry_names_agree():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
