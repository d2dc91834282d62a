"""Tiles and tree against sorting all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from replicheck.llm import topk


@pytest.mark.parametrize(
    "shard, block, held, columns, fan", [(7, 3, 2, 4, 2), (3, 2, 1, 2, 3), (8_192, 1_024, 8, 64, 16)]
)
def test_equals_sorting(spark, ws, monkeypatch, shard, block, held, columns, fan):
    for name, value in (("SHARD", shard), ("BLOCK", block), ("HELD", held), ("COLUMNS", columns), ("FAN", fan)):
        monkeypatch.setattr(topk, name, value)
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([-0.5, 0.25, 0.1, rnd.random()]) for _ in range(4)]) for i in range(150)]
    rows += [(200, rows[0][1]), (201, None), (202, [1.0, None, 0.0, 0.0]), (203, [math.nan] * 4), (204, [math.inf] * 4),
             (205, []), (210, [0.5, 0.5]), (220, [0.25, 0.5]), (None, rows[1][1]), (30, rows[30][1])]
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(4)
    got = sorted(map(tuple, topk.search(df, F.col("vec_id") % 10 == 0, ws=ws).collect()))
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in {(i, tuple(v)) for i, v in fine if i % 10 == 0}:
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q and len(w) == len(v))[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(found, 1)]
    assert got == sorted(want)


def test_tiles_take_one_exchange_and_no_product_of_tables(spark, ws):
    df = spark.range(300).selectExpr("id AS vec_id", "array(cast(id AS float), 1f) AS embedding")
    packs = [ws.stage(topk._packed(df.selectExpr("vec_id AS id", "cast(embedding AS array<double>) AS vector"), n), "p") for n in (20, 30)]
    cells, width = topk._grid(*packs, ws)
    assert width == len(packs[1].collect())
    plan = topk._tiles(cells, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(dim") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_best_of_many_ties():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        scores = rnd.integers(0, 4, (5, 30)).astype(float)
        scores[rnd.random(scores.shape) < 0.2] = -np.inf
        ids = np.array([rnd.permutation(30) for _ in range(5)])
        got = topk._best_of(scores, ids, 6)
        for i in range(5):
            want = sorted(zip(-scores[i], ids[i]))[:6]
            assert [(-a, b) for a, b in zip(got[0][i], got[1][i])] == want or np.isinf([w[0] for w in want]).any()


def test_empty(spark, ws):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(df, F.col("vec_id") % 50 == 0, ws=ws).count() == 0
