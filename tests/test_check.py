from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from copies import config
from queries import drift
from queries.results import Check
from replicheck.operators import checksum, compare

SF = "/root/testdata/sf0.001"


def found(c):
    df = compare.key_differ(c.drilled(), c.pk, c.nodes)
    return {r[c.pk]: r["differ_type"] for r in df.collect()}


def test_numbers_of_the_fixture(spark):
    c = Check(spark, drift.orders_config("/root/testdata/sf0.01"))
    whole = {r["ord"]: (r["cnt"], r["crc"]) for r in checksum.table_checksum(c.crcs()).collect()}
    assert whole == {1: (14927, "4a02a9b9"), 2: (14872, "f2347af2"), 3: (14862, "1fa743")}
    chunks = c.ws.stage(c.chunks(c.chunked()), "chunks")
    first = chunks.filter("chunk = 1").orderBy("ord").collect()
    assert [(r["cnt"], r["crc"]) for r in first] == [
        (100, "12be702e"),
        (98, "99f30902"),
        (100, "12be702e"),
    ]
    assert compare.chunk_differ(chunks, 3).count() == 75
    assert len(found(c)) == 554


def test_equal_copies_do_not_differ(spark):
    c = Check(spark, drift.orders_config(SF, copies=(1, 1, 1)))
    assert compare.chunk_differ(c.chunks(c.chunked()), 3).isEmpty()


def test_replica_order_changes_types_and_not_keys(spark):
    straight = found(Check(spark, drift.orders_config(SF)))
    turned = found(Check(spark, drift.orders_config(SF, copies=(3, 2, 1))))
    assert len(straight) == 70 and set(straight) == set(turned)
    assert straight != turned


@pytest.mark.parametrize("size", [1, 7, 5000])
def test_chunk_size_does_not_change_keys(spark, size):
    assert len(found(Check(spark, drift.orders_config(SF, chunk_size=size)))) == 70


def test_time_alone_is_no_difference(spark):
    cfg = drift.orders_config(SF)
    with_time = found(Check(spark, replace(cfg, exclude_columns=())))
    without = found(Check(spark, cfg))
    assert set(without) < set(with_time)
    # 113: the row without a priority has none on any copy, so its time alone is another.
    assert all(k % 127 == 0 or k % 113 == 0 for k in set(with_time) - set(without))


def test_replica_without_rows_in_a_chunk(spark):
    cfg = config(spark, "k int, v string", [(1, "a"), (2, "b"), (3, "c")], [(1, "a")])
    c = Check(spark, cfg)
    rows = c.chunks(c.chunked()).orderBy("chunk", "ord").collect()
    assert [(r["chunk"], r["ord"], r["cnt"]) for r in rows] == [
        (1, 1, 2),
        (1, 2, 1),
        (2, 1, 1),
        (2, 2, 0),
    ]
    assert rows[-1]["crc"] == "0"
    assert found(c) == {2: 1, 3: 1}


def test_first_anomaly_decides_the_type(spark):
    same, other = (1, "a"), (1, "b")
    cases = [
        (([same], [other], []), 2),
        (([same], [], [other]), 1),
        (([], [same], [other]), 1),
        (([same], [same], []), 1),
        (([same], [same], [other]), 2),
    ]
    for copies, kind in cases:
        c = Check(spark, config(spark, "k int, v string", *copies))
        assert found(c) == {1: kind}


def test_missing_result_of_a_replica_differs(spark):
    c = Check(spark, drift.orders_config(SF, copies=(1, 1, 1)))
    chunks = c.chunks(c.chunked()).filter(~((F.col("chunk") == 2) & (F.col("ord") == 3)))
    assert [r["chunk"] for r in compare.chunk_differ(chunks, 3).collect()] == [2]


def test_cancelling_changes_hide_in_a_chunk(spark):
    """Two rows that swap their whole text leave the fold as it is: chunks decide first."""
    one = [(1, "a"), (2, "b")]
    cfg = config(spark, "k int, v string", one, [(1, "b"), (2, "a")], exclude_columns=("k",))
    assert found(Check(spark, cfg)) == {}
    assert found(Check(spark, replace(cfg, chunk_size=1))) == {1: 2, 2: 2}


def test_repeated_keys_are_counted(spark):
    cfg = config(spark, "k int, v string", [(1, "a"), (1, "a"), (1, "a")], [(1, "a")])
    c = Check(spark, cfg)
    rows = c.chunks(c.chunked()).orderBy("ord").collect()
    assert [r["cnt"] for r in rows] == [3, 1]
    assert found(c) == {1: 2}
