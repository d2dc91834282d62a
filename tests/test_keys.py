import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from queries import drift
from queries.results import orders
from replicheck.operators import checksum, compare, keys
from replicheck.sources import read_replicas


def keys_of(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], f"k {dtype}").repartition(3)


@pytest.mark.parametrize(
    "dtype, values",
    [
        ("bigint", [7 * i - 2000 for i in range(999)]),
        ("int", list(range(10)) + [2**31 - 1, -(2**31)]),
        ("string", [f"k{i}" for i in range(300)] + ["", "é", "Z", "z", "😀"]),
        ("date", [datetime.date(2020, 1, 1) + datetime.timedelta(days=i) for i in range(50)]),
        ("decimal(20,3)", [Decimal(i) / 8 for i in range(100)]),
    ],
)
@pytest.mark.parametrize("partitions", [0, 7])
def test_rank_is_exact(spark, ws, dtype, values, partitions):
    chunked = keys.chunk_assign(keys_of(spark, values, dtype), "k", 10, ws, partitions)
    found = [tuple(r) for r in chunked.orderBy("rn").collect()]
    order = sorted(values, key=lambda v: v.encode() if isinstance(v, str) else v)
    assert found == [(v, i + 1, i // 10 + 1) for i, v in enumerate(order)]


@pytest.mark.parametrize("n, size, chunks", [(20, 10, 2), (1, 10, 1), (5, 1, 5), (11, 10, 2)])
def test_chunk_counts(spark, ws, n, size, chunks):
    chunked = keys.chunk_assign(keys_of(spark, range(n), "bigint"), "k", size, ws)
    bounds = keys.chunk_boundaries(chunked, "k").orderBy("chunk").collect()
    assert len(bounds) == chunks
    assert [b["upper_boundary"] for b in bounds] == list(range(0, n, size))
    assert bounds[-1]["lower_boundary"] == n - 1
    assert sum(b["keys"] for b in bounds) == n


def test_key_after(spark):
    df = keys_of(spark, [1, 5, 9], "bigint")
    assert keys.key_after(df, "k", 5).first()[0] == 9
    assert keys.key_after(df, "k", 9).first()[0] is None


@pytest.mark.parametrize("stored, first", [(0, 1), (1, 1), (2, 2), (3, 3)])
def test_resume_starts_at_the_last_key_before(spark, ws, stored, first):
    chunked = keys.chunk_assign(keys_of(spark, range(95), "bigint"), "k", 10, ws)
    results = keys.chunk_boundaries(chunked, "k").filter(F.col("chunk") <= stored)
    again = keys.chunk_boundaries(keys.chunk_resume(chunked, "k", results, 10), "k")
    bounds = again.orderBy("chunk").collect()
    assert bounds[0]["chunk"] == first
    assert bounds[0]["upper_boundary"] == (10 * (stored - 1) - 1 if stored > 1 else 0)
    assert bounds[-1]["lower_boundary"] == 94


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


SF = "/root/testdata/sf0.001"


def test_check_plan_has_no_loop_join_and_no_task_with_all_rows(spark):
    c = orders(spark, SF)
    chunked = c.chunked()
    chunks = c.chunks(chunked)
    found = compare.key_differ(
        compare.drill_keys(chunked, compare.chunk_differ(chunks, 3)), "id", c.nodes
    )
    for df in (chunks, found):
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    # One place sees all partitions' row counts, one row for each.
    assert plan_of(chunks).count("SinglePartition") == 1


def test_matrix_is_one_shuffle_and_ranks_are_one_more(spark, ws):
    c = orders(spark, SF)
    matrix = checksum.key_matrix(c.crcs(), "id", c.nodes)
    assert plan_of(matrix).count(") Exchange\n") == 1
    placed = keys.in_order(ws.stage(matrix, "matrix"), ["id"])
    plan = plan_of(placed)
    assert plan.count(") Exchange\n") == 1 and "rangepartitioning" in plan


def test_scans_read_only_what_they_need(spark):
    rows = read_replicas(spark, drift.customer_config(SF).replicas)
    plan = plan_of(keys.key_universe(rows, "name"))
    assert "ReadSchema: struct<c_name:string>" in plan
    assert "c_acctbal" not in plan


def test_range_reaches_the_source(spark):
    from replicheck.sources import key_range_scan, read_replica
    from replicheck.spec import ReplicaSpec

    df = read_replica(spark, ReplicaSpec(1, "dn1", f"{SF}/orders.parquet"))
    plan = plan_of(key_range_scan(df, "o_orderkey", 5, 9))
    assert "GreaterThanOrEqual(o_orderkey,5), LessThanOrEqual(o_orderkey,9)" in plan
