"""Every query against its SQL on the smallest tables."""

import importlib.util
from pathlib import Path

import pytest

from rateflow.catalog.oracle import ORACLE
from rateflow.catalog.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
spec = importlib.util.spec_from_file_location("compare", Path(__file__).parents[1] / "tools" / "compare.py")
compare = importlib.util.module_from_spec(spec)
spec.loader.exec_module(compare)

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="the given tables are not here")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    got = compare.actual(QUERIES[name](spark, str(SF_DIR)))
    assert got == compare.expected(compare.database(str(SF_DIR)), ORACLE[name])
