"""Targets and flows by plain means; the chosen documents by sorting all."""

import random
from collections import defaultdict
from fractions import Fraction
from itertools import product

import pytest
from pyspark.sql import functions as F

from replicheck.llm import mixing


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    assert mixing.targets([10, 10, 1000], [1, 2, 3]) == [30, 30, 960]
    got = mixing.targets([1, 50, 400], [3, 2, 1])
    assert got == [3, 150, 298] and sum(got) == 451
    assert mixing.targets([0, 0], [1, 2]) == [Fraction(0)] * 2 and mixing.targets([], []) == []


def cheapest(patterns, quotas, most):
    """Least cost of a maximum flow, by trying all ways to give words away."""
    names = list(patterns)
    best = None
    options = []
    for p in names:
        room = most * patterns[p]
        options.append([x for x in product(range(room + 1), repeat=len(p)) if sum(x) <= room])
    for choice in product(*options):
        got = [0] * len(quotas)
        for p, given in zip(names, choice):
            for s, x in zip(p, given):
                got[s] += x
        if any(g > q for g, q in zip(got, quotas)):
            continue
        cost = 0
        for p, given in zip(names, choice):
            for word in range(sum(given)):
                cost += 2 * (word // patterns[p]) + 1
        key = (-sum(got), cost)
        best = key if best is None else min(best, key)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_cheapest(seed):
    rnd = random.Random(seed)
    patterns = {(0,): rnd.randint(1, 2), (0, 1): rnd.randint(1, 2), (1,): rnd.randint(1, 2)}
    quotas = [rnd.randint(0, 6), rnd.randint(0, 6)]
    taken = mixing.flow(patterns, quotas)
    cost = sum(2 * (w // patterns[p]) + 1 for p, f in taken.items() for w in range(f))
    assert (-sum(taken.values()), cost) == cheapest(patterns, quotas, 3)


def world():
    rnd = random.Random(9)
    rows = [(i, "w " * rnd.randint(0, 40), rnd.choice(["a", "a", "a", "B", "é", None])) for i in range(400)]
    return rows + [(400, None, "a"), (401, "", None), (402, "x\x0by\x1fz", "only"), (7, "w " * 3, "a"), (7, "w " * 3, "a"), (None, "q q", "a")]


def test_mix(spark, ws):
    rows = world()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int").repartition(3)
    got = mixing.mix(df, F.array("source"), keep=("doc_id", "source"), ws=ws).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, map(float, mixing.targets([sizes[s] for s in names], [1 + i % 3 for i in range(len(names))]))))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert (r.source_size, r.target) == (sizes[r.source], goal[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in names)
    again = mixing.mix(df.repartition(7), F.array("source"), keep=("doc_id", "source"), ws=ws).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_choice_is_a_prefix_of_the_seeded_order(spark, ws):
    df = spark.createDataFrame(world(), "doc_id long, text string, source string")
    got = mixing.mix(df, F.array("source"), keep=("doc_id",), ws=ws).withColumn(
        "order", F.expr(f"conv(hex(xxhash64({mixing.SEED}, doc_id)), 16, 10)").cast("decimal(20,0)")
    ).filter("size > 0").collect()
    by = defaultdict(list)
    for r in got:
        by[r.pattern].append((r.order, r.copies))
    for found in by.values():
        copies = [c for _, c in sorted(found)]
        assert copies == sorted(copies, reverse=True) and max(copies) - min(copies) <= 1


def test_repeated_and_empty(spark, ws):
    df = spark.createDataFrame([(1, "a b", "s", "row"), (2, "c d", "t", "row")], "doc_id long, text string, source string, row string")
    out = mixing.repeated(df, F.array("source"), ws)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} <= {1, 2}
    assert mixing.mix(df.limit(0), F.array("source"), ws=ws).count() == 0


def test_no_python_workers(spark, ws, monkeypatch):
    """The mix is the only stage of a chain with rows from the driver; Python workers that turn
    them into a table would stay beside those of other stages."""
    df = spark.range(40).selectExpr("id as doc_id", "repeat('w ', int(id)) as text", "string(id % 3) as source")
    empty = df.limit(0)

    def refuse(*_, **__):
        raise AssertionError("rows of the driver go through Python workers")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    assert mixing.mix(df, F.array("source"), ws=ws).count() == 40
    assert mixing.mix(empty, F.array("source"), ws=ws).count() == 0
