"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

from lakestrata.plans import registry
from tools.check_oracle import compare, duck

SMOKE_DIR = "/root/testdata/sf0.001"
registry.load_all()
KEYS = sorted(registry.ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    res = compare(spark, con, key, registry.QUERIES[key], registry.ORACLE[key], SMOKE_DIR)
    assert res["status"] == "ok", res
