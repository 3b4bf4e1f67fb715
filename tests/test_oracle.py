"""Registered queries against their SQL. A part of them by default; all with PAIRLOOM_ALL=1."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, connect  # noqa: E402

from pairloom.catalog import ORACLES, QUERIES  # noqa: E402

DATA = os.environ.get("PAIRLOOM_DATA", "/root/testdata/sf0.001")
SHORT = ["a2_", "a4_", "a7_", "a10_", "a15_", "b2_", "b3_", "b11_", "c3_", "c16_", "d6_", "d8_", "e6_", "e7_", "f8_", "f10_",
         "f13_", "f15_", "f17_", "h1_", "h2_", "h3_", "h6_", "h10_", "h18_", "i1_", "i2_", "i4_", "l1_", "l2_", "l4_"]
NAMES = [n for n in QUERIES if n in ORACLES and (os.environ.get("PAIRLOOM_ALL") or any(n.startswith(s) for s in SHORT))]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    ok, _, _, _, note = compare(spark, connect(DATA), name, QUERIES[name], ORACLES[name], DATA)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
