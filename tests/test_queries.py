"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, connect

import __spark_entry__ as entry_points
from marketlake.verification import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
    assert QUERIES.keys() <= entry_points.queries().keys() and entry_points.oracle_sql().keys() <= entry_points.queries().keys()


def test_all_operators_are_registered():
    wanted = {f"s{i:02d}" for i in range(1, 25)} | {f"p{i:02d}" for i in range(1, 25)} | {f"j{i:02d}" for i in range(1, 11)}
    wanted |= {f"a{i:02d}" for i in range(1, 27)} | {f"w{i:02d}" for i in range(1, 8)} | {f"o{i:02d}" for i in range(1, 7)}
    wanted |= {f"u{i:02d}" for i in range(1, 4)} | ({f"f{i:02d}" for i in range(1, 35)} - {"f11"}) | {f"d{i:02d}" for i in range(1, 21)}
    wanted |= {f"q{i:02d}" for i in range(1, 9)} | {f"m{i:02d}" for i in range(1, 13)} | {"x01", "g01", "g02"}
    assert wanted - {n.split("_")[0] for n in QUERIES} == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, name, SF)
    assert result["ok"], result["note"]
    assert name in ORACLES or result["rows"] > 0
