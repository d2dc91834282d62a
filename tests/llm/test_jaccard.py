"""The join against all pairs of Python sets."""

import random
import re

import pytest
from pyspark.sql import Row

from replicheck.llm import jaccard
from replicheck.sources import Workspace

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, size=4, percent=85):
    sets = []
    for _, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = WORD.findall(low)
        k = min(size, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)) if d is not None)


def world(seed, n=260):
    """Families of edited copies, short texts, passages that many texts share."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(30)]
    rows, k = [], 0
    while len(rows) < n:
        base = [rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 5, 8, 10, 13, 14, 16, 25, 60, 120]))]
        if rnd.random() < 0.3:
            base += passage
        for _ in range(rnd.choice([1, 1, 2, 4, 40])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            if rnd.random() < 0.3:
                copy.append(rnd.choice(vocab))
            text = rnd.choice([" ", "\n", "  "]).join(copy)
            rows.append((k, text.upper() if rnd.random() < 0.2 else text))
            k += 1
    rnd.shuffle(rows)
    return rows


def result(spark, ws, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(tuple(r) for r in jaccard.duplicates(df, ws, **more).collect())


@pytest.mark.parametrize("seed, longest", [(1, 16), (2, 2)])
def test_equals_all_pairs(spark, ws, monkeypatch, seed, longest):
    monkeypatch.setattr(jaccard, "LIST", longest)
    monkeypatch.setattr(jaccard, "HANDFUL", 4)
    rows = world(seed)
    assert result(spark, ws, rows) == brute(rows)


def test_unusual_rows(spark, ws):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, long), (8, long + " y"),
            (8, long + " y"), (9, "É a b c d"), (10, "é a b c d")]
    df = spark.createDataFrame([Row(doc_id=d, text=t, node=1, gram=2) for d, t in [*rows, (None, "one")]])
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.duplicates(df, ws).collect()}
    assert got == {(1, 0): 1, (2, 0): 2, (3, 0): 3, (4, 1): 4, (5, 1): 4, (6, 1): 6, (7, 29_997): 7, (8, 29_998): 7,
                   (9, 2): 9, (10, 2): 10, (None, 1): None}


def test_empty_table(spark, ws):
    assert result(spark, ws, []) == []


def test_rule_is_exact():
    rule = jaccard.Rule(85)
    for a in range(1, 60):
        for b in range(a, 60):
            for both in range(a + 1):
                is_linked = 100 * both >= 85 * (a + b - both)
                assert is_linked == (both >= rule.overlap(a, b)) == rule.linked(a, b, both)
                if is_linked:
                    assert b <= rule.largest(a) and a >= rule.smallest(b)
                    assert a + b - 2 * both <= min(rule.apart(a), rule.apart(b))


def test_unlike_sets_that_quote_one_passage_are_not_described_by_a_hub(spark, monkeypatch):
    """The sketch of all texts has not seen the passage twice in a batch, as it may be in large tables."""
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(2_000)]
    passage = [rnd.choice(vocab) for _ in range(30)]
    rows = []
    for k in range(60):
        base = [rnd.choice(vocab) for _ in range(100 + 10 * k)]
        rows.append((k, " ".join(base[:50] + passage + base[50:])))
    family = [rnd.choice(vocab) for _ in range(200)]
    for k in range(60, 90):
        copy = list(family)
        for _ in range(rnd.choice([1, 3, 6])):
            copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
        rows.append((k, " ".join(copy)))
    monkeypatch.setattr(jaccard, "LIST", 8)

    class Kept(Workspace):
        def stage(self, df, name):
            out = super().stage(df, name)
            kept.setdefault(name, []).append(out)
            return out

    def sketch(docs, size):
        out = plain(docs, size)
        return out if "sketch" in kept else out.filter("gram is null")

    kept, plain = {}, jaccard._sketch
    monkeypatch.setattr(jaccard, "_sketch", sketch)
    assert result(spark, Kept(spark), rows) == brute(rows)
    described = kept["compared"][0].filter("differ").select("node", "n", "grams").collect()
    assert len({r.node for r in described}) >= 20  # the family is
    assert all(190 <= r.n <= 200 for r in described)  # the others are not
