"""The second source's lines are read by several branches and must be worked out once."""

import datetime

import pytest

from registry import people


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(2001, 6, 1)
    tables = {
        "nation": ([(0, "CHILE")], "n_nationkey int, n_name string"),
        "customer": ([(1, 0)], "c_custkey long, c_nationkey int"),
        "orders": (
            [(i, 1, day, "3-MEDIUM", "O", 1000.0 * i) for i in range(1, 6)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string, o_orderstatus string, o_totalprice double",
        ),
        "lineitem": (
            [(i, 1 + (i + n) % 4, n, day, 5.0) for i in range(1, 6) for n in (1, 2)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_shipdate timestamp, l_extendedprice double",
        ),
        "part": (
            [(i, f"red ring{i}", "Brand#1", i, kind, 950.0) for i, kind in enumerate(("ECONOMY", "PROMO", "LARGE", "SMALL"), 1)],
            "p_partkey long, p_name string, p_brand string, p_size int, p_type string, p_retailprice double",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.mark.parametrize("query, rows", [("live_source", 10), ("live_search", 10), ("pool_event_append", 4)])
def test_lines_are_worked_out_once(spark, folder, query, rows):
    out = people.QUERIES[query](spark, folder)
    assert not [f for f in out.inputFiles() if "lineitem" in f or "orders.parquet" in f]
    assert out.count() == rows
