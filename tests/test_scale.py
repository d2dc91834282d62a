"""Plans and results where nothing is small enough to broadcast, and with skewed input."""

import pytest
from pyspark.sql import functions as F

from queries import drift
from queries.results import QUERIES, Check
from replicheck.operators import checksum, keys, repair, validate
from replicheck.sources import key_lookup_rows, read_replica, readers
from replicheck.spec import ReplicaSpec
from test_keys import plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows_of(df):
    return sorted((tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("name", ["key_differ", "repair_plan", "contested_repair"])
def test_same_result_without_broadcasts(spark, conf, name):
    expected = rows_of(QUERIES[name](spark, SF))
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    assert rows_of(QUERIES[name](spark, SF)) == expected


@pytest.mark.parametrize("name", ["chunk_checksum", "contested_plan"])
def test_same_result_without_adaptive_execution(spark, conf, name):
    expected = rows_of(QUERIES[name](spark, SF))
    conf(adaptive__enabled="false", shuffle__partitions="7")
    assert rows_of(QUERIES[name](spark, SF)) == expected


def test_lookup_tests_bits_below_the_shuffle(spark, conf, ws):
    rows = read_replica(spark, ReplicaSpec(1, "dn1", f"{SF}/orders.parquet"))
    pending = ws.stage(spark.range(5).select(F.col("id").alias("o_orderkey")), "pending")
    found = rows_of(key_lookup_rows(rows, pending, "o_orderkey"))
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    lookup = key_lookup_rows(rows, pending, "o_orderkey")
    assert rows_of(lookup) == found and len(found) == rows.filter("o_orderkey < 5").count()
    plan = plan_of(lookup)
    assert "GreaterThanOrEqual(o_orderkey,0), LessThanOrEqual(o_orderkey,4)" in plan
    # from the top: the join, the exchange of wide rows, the test, the scan
    order = [plan.index(x) for x in ("SortMergeJoin", "Exchange", "BroadcastHashJoin")]
    assert order == sorted(order)


def test_key_that_holds_a_third_of_all_rows(spark):
    rows = spark.range(30_000, numPartitions=4).select(
        F.lit(1).alias("ord"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    fact = validate.pk_single(rows, "k").first()
    assert (fact["cnt"], fact["keys"], fact["is_key"]) == (30_000, 20_000, False)
    crcs = checksum.row_checksums(rows, "k", ["k", "v"], [])
    matrix = checksum.key_matrix(crcs, "k", [(1, "dn1")])
    # 10,000 rows of the hot key, and its own one
    assert matrix.filter("k = 7").first()["cnt_1"] == 10_001
    assert validate.key_faults(matrix, "k", [1]).collect()[0]["k"] == 7


def test_key_that_is_a_third_of_all_pending_entries(spark, ws):
    n = 3_000
    found = spark.range(n).select(
        F.explode(F.array(F.lit(1), F.lit(2))).alias("ord"), F.col("id").alias("k")
    )
    found = found.withColumn("t", F.col("k") + F.col("ord")).withColumn("u", F.col("k"))
    pending = spark.range(n).select(
        (F.col("id") + 1).alias("differ_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.lit(2).alias("differ_type"),
    )
    held = repair.held_rows(found, "k", "t", "int", ("u",))
    plan = repair.repair_plan(pending, held, "k", [(1, "a"), (2, "b")], ("u",), ws)
    counts = {r["status"]: r["count"] for r in plan.groupBy("status").count().collect()}
    assert counts == {1: 2_000, 5: 1_000}


def test_repair_reads_no_join_of_all_pairs(spark):
    c = Check(spark, drift.part_config(SF))
    found, plan = c.planned()
    changes = c.changes(found, plan).filter("ord = 1")
    for df in (
        repair.backup_rows(found, plan, "k", c.unique_cols),
        repair.replace_evicts(c.holders(plan), plan, "k", c.unique_cols),
        repair.replace_into(read_replica(spark, c.cfg.replicas[0]), changes, "k"),
    ):
        text = plan_of(df)
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "SinglePartition" not in text


def test_ranks_follow_settings(spark, ws, conf):
    df = spark.range(1000).select(F.col("id").alias("k"))
    conf(shuffle__partitions="50", adaptive__enabled="false")
    ranked = keys.with_rank(df, ["k"], ws)
    assert ranked.filter("rn <> k + 1").isEmpty() and ranked.count() == 1000


@pytest.mark.parametrize("step", [1, 7, 4096])
def test_bits_of_keys_are_tested_as_numbers(spark, step):
    """All bits of a word count, also its sign, and no row is turned into strings for it."""
    wanted = spark.range(0, 200_000, step).withColumnRenamed("id", "k")
    rows = spark.range(400_000).withColumnRenamed("id", "k")
    likely = readers.likely_rows(rows, wanted, "k")
    assert likely.join(wanted, "k").count() == wanted.count()
    others = likely.join(wanted, "k", "left_anti").count()
    assert others < 2 * (400_000 - wanted.count()) * wanted.count() / readers.BITS + 20
    tests = [line for line in plan_of(likely).split("\n") if "condition" in line and "__place" in line]
    assert tests and not any("hex(" in line or "conv(" in line for line in tests)
