import os

import pytest

from quernstone.llm.queries import REGISTRY
from tests.oracle import FOLDER, compare

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(REGISTRY.oracles))
def test_against_sql(spark, name):
    compare(spark, REGISTRY.queries[name], REGISTRY.oracles[name])


@pytest.mark.parametrize("name", sorted(set(REGISTRY.queries) - set(REGISTRY.oracles)))
def test_gives_rows(spark, name):
    assert REGISTRY.queries[name](spark, FOLDER).count() > 0
