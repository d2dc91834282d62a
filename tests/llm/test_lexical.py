"""Ranked search against scores of all documents in plain Python."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from replicheck.llm import lexical
from replicheck.llm.lexical import Best, Shard, rank_item, search
from replicheck.llm.oracle import OP11

WORDS = ["the", "of", "and", *[f"w{k}" for k in range(40)], "Éa", "日本", "x1", "1"]


def plain_terms(text):
    return re.findall(f"[^{lexical.APART}]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    terms = [plain_terms(t) for _, t in docs]
    held = [t for t in terms if t]
    count, length = len(held), sum(map(len, held))
    df = Counter(w for t in held for w in set(t))
    out = []
    for item, text in items:
        scored = []
        for (doc, _), words in zip(docs, terms):
            tf = Counter(words)
            m = 10 + (90 * len(words) * count) // max(length, 1)
            score = 0
            for t in set(plain_terms(text)) & set(tf):
                w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def texts(n, seed, longest=30):
    rng = random.Random(seed)
    sep = [" ", "-", ", ", "\n", "\x00", "_"]
    return [
        "".join(rng.choice(WORDS[: rng.choice([3, 10, 47])]) + rng.choice(sep) for _ in range(rng.randint(0, longest)))
        for _ in range(n)
    ]


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


DOCS = [*enumerate(texts(120, 1)), (3, "the of"), (3, "the of"), (None, "the of w1"), (None, None), (7, ""), (8, "THE Of W1")]
ITEMS = [*enumerate(texts(12, 2, 12)), (5, "w1 of"), (5, "w1 of"), (None, "日本 éa"), (6, None), (9, "nowhere"), (10, "--")]
MANY = [*enumerate(texts(60, 3, 200)), (99, " ".join(f"v{k}" for k in range(150)))]
WIDE = [(1, " ".join([*WORDS, *[f"v{k}" for k in range(200)]])), (2, "v1 v149 the")]


@pytest.mark.parametrize("docs, items", [(DOCS, ITEMS), (MANY, WIDE)])
@pytest.mark.parametrize("small", [False, True])
def test_all_ranks(spark, monkeypatch, docs, items, small):
    if small:  # several shards, strips of documents and blocks of items
        monkeypatch.setattr(lexical, "SHARD_POSTINGS", 50)
        monkeypatch.setattr(lexical, "MASK_BYTES", 8)
        monkeypatch.setattr(lexical, "SCORED", 3)
        monkeypatch.setattr(lexical, "BLOCK_BYTES", 200)
    assert rows(search(*frames(spark, docs, items))) == brute(docs, items)


def test_same_as_sql(spark):
    con = duckdb.connect()
    for name, key, data in (("documents", "doc_id", DOCS), ("benchmark", "item_id", ITEMS)):
        con.register(name, pa.table({key: pa.array([r[0] for r in data], pa.int64()), "text": [r[1] for r in data]}))
    expected = con.sql(f"SELECT item_id, rank, doc_id, score FROM ({OP11})").fetchall()
    assert rows(search(*frames(spark, DOCS, ITEMS))) == sorted(expected, key=repr)


def shard(held, weights):
    terms = [sorted(d) for d in held]
    parts = pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(range(len(held)), pa.int64()),
            "n": pa.array([10] * len(held), pa.int64()),
            "terms": pa.array(terms, pa.list_(pa.int32())),
            "tfs": pa.array([[d[t] for t in ts] for d, ts in zip(held, terms)], pa.list_(pa.int32())),
        }
    )
    return Shard([parts], np.array(weights, np.int64), len(held), 10 * len(held))


def test_groups_out_of_reach_are_not_scored():
    held = [{0: 1}] * 5000 + [{0: 1, 1: 1}] * 70
    best = Best(10)
    scored = rank_item(shard(held, [10, 1000]), np.array([0, 1]), best)
    assert scored == 70 and best.ids.tolist() == list(range(5000, 5010))
    assert rank_item(shard([{0: 9}] * 5000, [10, 1000]), np.array([0, 1]), best) == 0


def test_equal_bounds_go_on_to_smaller_ids():
    held = [{0: 1, 1: 1}] * 40
    best = Best(10)
    best.add(np.full(10, int(shard(held, [5, 5]).scores(np.array([0]), np.array([0, 1]))[0])), np.arange(100, 110), np.zeros(10, bool))
    rank_item(shard(held, [5, 5]), np.array([0, 1]), best)
    assert best.ids.tolist() == list(range(10))


def test_empty_tables_and_other_columns(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    expected = rows(search(docs, items))
    more = docs.selectExpr("*", "1 AS n", "'x' AS terms", "2 AS no", "3 AS score")
    assert rows(search(more, items.selectExpr("*", "1 AS doc_id", "5 AS rank", "6 AS terms"))) == expected
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        empty = search(a, b)
        assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.count() == 0


def test_long_texts(spark):
    docs = [(1, "the " * 300_000), (2, "a" * 1_000_000), (3, "the w1")]
    items = [(1, "the " + "a" * 1_000_000), (2, " ".join(f"u{k}" for k in range(20_000)) + " w1")]
    assert rows(search(*frames(spark, docs, items))) == brute(docs, items)
