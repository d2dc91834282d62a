"""Replicas that drifted apart, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replicheck.spec import CheckConfig, ReplicaSpec

NODES = [(1, "dn1"), (2, "dn2"), (3, "dn3")]

# The drift of a key: the first divisor that fits; keys of every second half thousand stay the same.
DRIFT = (
    ("miss_tie", 97),
    ("only_dn2", 101),
    ("dn2_newer", 103),
    ("same_time", 107),
    ("diff_then_miss", 109),
    ("null_dn3", 113),
    ("time_only", 127),
    ("uk_conflict", 131),
    ("tie_max", 137),
    ("miss_then_diff", 139),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(ts: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone, whatever the session's zone is."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _drift(key: Column) -> Column:
    d = F.when(key % 1000 >= 500, "same")
    for name, divisor in DRIFT:
        d = d.when(key % divisor == 0, name)
    return d.otherwise("same")


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, prio = F.col("o_orderkey"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.when(~prio.startswith("5"), prio).alias("prio"),
        F.concat(F.lit("U"), key.cast("string")).alias("uk"),
        epoch(F.col("o_orderdate")).alias("upd"),
        _drift(key).alias("d"),
    )


def orders_replica(ord: int):
    """Reader of one of the three copies of ``orders``."""

    def change(name: str, cases: list[tuple[tuple[str, ...], Column]]) -> Column:
        value = F.col(name)
        for drifts, new in cases:
            value = F.when(F.col("d").isin(*drifts), new).otherwise(value)
        return value.alias(name)

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        absent = {
            1: ("only_dn2",),
            2: ("miss_tie", "miss_then_diff"),
            3: ("only_dn2", "diff_then_miss"),
        }[ord]
        later = F.col("upd") + 3600
        st = {
            1: [(("tie_max",), F.lit("X"))],
            2: [(("tie_max",), F.lit("Y"))],
            3: [(("same_time",), F.lit("Z")), (("miss_then_diff",), F.lit("W"))],
        }[ord]
        upd = {
            1: [(("tie_max",), F.col("upd") + 60)],
            2: [
                (("dn2_newer", "diff_then_miss", "time_only"), later),
                (("tie_max",), F.col("upd") + 60),
            ],
            3: [(("null_dn3", "miss_then_diff"), later)],
        }[ord]
        raised = (F.col("price") + 1).cast("decimal(18,2)")
        price = [(("dn2_newer", "diff_then_miss"), raised)] if ord == 2 else []
        prio = [(("null_dn3",), F.lit(None).cast("string"))] if ord == 3 else []
        uk = [(("uk_conflict",), F.concat("uk", F.lit("x")))] if ord == 3 else []
        return (
            orders_base(spark, sf_dir)
            .filter(~F.col("d").isin(*absent))
            .select(
                "id",
                "cust",
                change("st", st),
                change("price", price),
                change("prio", prio),
                change("uk", uk),
                change("upd", upd),
            )
        )

    return read


def orders_config(sf_dir: str, copies: tuple[int, ...] = (1, 2, 3), **changes) -> CheckConfig:
    """Three copies of ``orders``; ``copies`` says which drift each of them shows."""
    specs = tuple(
        ReplicaSpec(
            ord=ord,
            datanode=dn,
            reader=lambda spark, copy=copy: orders_replica(copy)(spark, sf_dir),
        )
        for (ord, dn), copy in zip(NODES, copies)
    )
    base = dict(
        table="orders",
        pk="id",
        replicas=specs,
        chunk_size=100,
        time_column="upd",
        time_format="int",
        unique_keys=(("uk",),),
        nullable_columns=("prio",),
        auto_repair_size=0,
    )
    return CheckConfig(**{**base, **changes})


# Two copies of ``customer`` with a string key.


def customer_replica(ord: int):
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = F.col("c_custkey")
        raised = F.when(key % 59 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
        df = table(spark, sf_dir, "customer")
        df = df.filter(key % 53 != 0) if ord == 2 else df
        return df.select(
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("nation"),
            (raised if ord == 2 else F.col("c_acctbal")).cast("decimal(18,2)").alias("bal"),
            F.col("c_mktsegment").alias("seg"),
        )

    return read


def customer_config(sf_dir: str, **changes) -> CheckConfig:
    specs = tuple(
        ReplicaSpec(o, dn, reader=lambda spark, o=o: customer_replica(o)(spark, sf_dir))
        for o, dn in NODES[:2]
    )
    base = dict(
        table="customer",
        pk="name",
        replicas=specs,
        chunk_size=100,
        run_mode=1,
        nullable_columns=(),
    )
    return CheckConfig(**{**base, **changes})


# Two copies of ``part`` whose unique codes stand in each other's way. The place of a key in
# its fifty decides which copies hold it, with whose code, and how new it is.

# place: ((code offset, time) on dn1 or None, the same on dn2)
CODES = {
    10: (None, (1, 5)),
    11: ((0, 10), None),
    20: ((0, 10), None),
    21: (None, (-1, 5)),
    30: ((0, 10), None),
    31: ((0, 20), (-1, 5)),
    32: ((0, 30), (-1, 7)),
    40: ((0, 10), (0, 11)),
}


def part_replica(ord: int):
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = F.col("p_partkey")
        offset, time = F.lit(0), F.lit(1)
        for place, held in CODES.items():
            shift, at = held[ord - 1] or (0, 1)
            offset = F.when(key % 50 == place, F.lit(shift)).otherwise(offset)
            time = F.when(key % 50 == place, F.lit(at)).otherwise(time)
        absent = [place for place, held in CODES.items() if held[ord - 1] is None]
        return (
            table(spark, sf_dir, "part")
            .filter(~(key % 50).isin(absent))
            .select(
                key.alias("k"),
                F.concat(F.lit("c"), (key + offset).cast("string")).alias("code"),
                F.col("p_retailprice").alias("price"),
                time.cast("bigint").alias("t"),
            )
        )

    return read


def part_config(sf_dir: str, **changes) -> CheckConfig:
    specs = tuple(
        ReplicaSpec(o, dn, reader=lambda spark, o=o: part_replica(o)(spark, sf_dir))
        for o, dn in NODES[:2]
    )
    base = dict(
        table="part",
        pk="k",
        replicas=specs,
        chunk_size=100,
        time_column="t",
        time_format="int",
        exclude_columns=(),
        unique_keys=(("code",),),
        nullable_columns=(),
        decimals={"price": (18, 2)},
        auto_repair_size=0,
    )
    return CheckConfig(**{**base, **changes})


# Two copies of ``customer`` with shifted codes. dn2 has each key with the code that its
# predecessor has on dn1, in runs of ``RUN`` keys; dn1 lacks the keys at two places of a run.

RUN, HOLES = 64, (40, 50)


def chain_replica(ord: int):
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = F.col("c_custkey")
        place = key % RUN
        here = ~place.isin(*HOLES) if ord == 1 else place != 0
        return (
            table(spark, sf_dir, "customer")
            .filter(here)
            .select(
                key.alias("k"),
                F.concat(F.lit("c"), (key - (ord - 1)).cast("string")).alias("code"),
                (key % 7 + ord).cast("bigint").alias("t"),
            )
        )

    return read


def chain_config(sf_dir: str, **changes) -> CheckConfig:
    specs = tuple(
        ReplicaSpec(o, dn, reader=lambda spark, o=o: chain_replica(o)(spark, sf_dir))
        for o, dn in NODES[:2]
    )
    base = dict(
        table="customer",
        pk="k",
        replicas=specs,
        chunk_size=100,
        time_column="t",
        time_format="int",
        unique_keys=(("code",),),
        nullable_columns=(),
        auto_repair_size=0,
    )
    return CheckConfig(**{**base, **changes})
