"""Named queries run on Spark and equal their SQL on DuckDB, bit for bit.

``CATALOG=all`` takes every query; by default the marts, KPIs, analyses, checks and
functions are enough to notice a fault in any operator.
"""

from __future__ import annotations

import os

import pytest

from parity import compare, oracle
from tidebook.catalog import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
USUAL = ("m", "q", "k1", "c0", "fn", "s0", "s1", "i3", "d0", "b0")
NAMES = [n for n in QUERIES if os.environ.get("CATALOG") == "all" or n.startswith(USUAL)]


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    ok, note = compare(QUERIES[name](spark, SF_DIR), duck, ORACLE[name])
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
