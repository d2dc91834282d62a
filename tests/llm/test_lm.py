"""Scores against plain counting."""

import math
import random
from collections import Counter

import pytest

from replicheck.llm import lm
from replicheck.llm.text import WordHash, lower_words
from replicheck.sources import Workspace


def plain(rows):
    """``(doc_id, number of words, score)`` of every row."""
    hashes = WordHash()
    texts = [lm.classes(hashes.of(w)).tolist() if (w := lower_words(t)) else [] for _, t in rows]
    texts = [list(zip(c, c[1:])) for c in texts]
    pair = Counter(p for x in texts for p in x)
    word = Counter(p[1] for x in texts for p in x)
    total, out = sum(word.values()), []
    before = {**word, 0: sum(map(bool, texts))}
    for (d, _), x in zip(rows, texts):
        mine, logs = Counter(x), []
        for p in x:
            left = pair[p] - mine[p]
            logs.append(math.log(left / before[p[0]] if left else lm.ALPHA * word[p[1]] / total))
        out.append((d, len(logs), sum(logs) / len(logs) if logs else None))
    return out


@pytest.mark.parametrize("known", [lm.KNOWN, 3])
def test_scores(spark, ws, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    monkeypatch.setattr(lm, "PAIRED", 7)
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 12)))) for i in range(60)]
    rows += [(90, None), (91, "only ONCE"), (92, "a b " * 5_000), (93, "a b c"), (93, "a b c"), (93, "b b"), (None, "a b"),
             (None, "c c c d"), (None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, count int")
    got = lm.scores(df, ws).collect()
    shown = lambda rs: sorted(((d, n, None if s is None else round(s, 9)) for d, n, s in rs), key=repr)
    assert shown((r.doc_id, r.n_words, r.score) for r in got) == shown(plain(rows))
    assert lm.scores(df.limit(0), ws).count() == 0


def plain_words(rows):
    """The same, with the words themselves as keys and one text a doc_id."""
    docs = {d: list(zip([b"", *lower_words(t)], lower_words(t))) for d, t in rows}
    pair = Counter(p for own in docs.values() for p in own)
    word = Counter(w for own in docs.values() for _, w in own)
    total = sum(word.values())
    word[b""] = sum(bool(own) for own in docs.values())
    for d, own in docs.items():
        mine, logs = Counter(own), []
        for p in own:
            left = pair[p] - mine[p]
            logs.append(math.log(left / word[p[0]] if left else lm.ALPHA * word[p[1]] / total))
        yield d, len(own), sum(logs) / len(logs)


def test_words_are_not_merged(spark, ws):
    """Words that agree in 20 bits of their hash, and pairs with no, one and two heavy words."""
    hashes, seen, alike = WordHash(), {}, []
    for i in range(8_000):
        name = f"w{i}"
        alike += [seen[k], name] if (k := hashes[name.encode()] % ((1 << 20) - 1)) in seen else []
        seen[k] = name
    assert len(alike) >= 10
    rnd = random.Random(5)
    vocab = ["the", "of", "a"] * 300 + alike * 5 + [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 60)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm.scores(df, ws).collect()}
    for d, n, score in plain_words(rows):
        assert got[d].n_words == n
        assert abs(got[d].score - score) < 1e-9


class Plans(Workspace):
    """A workspace that keeps the plan of every staged table."""

    def stage(self, df, name):
        self.plans = {**getattr(self, "plans", {}), name: df._jdf.queryExecution().optimizedPlan().toString()}
        return super().stage(df, name)


@pytest.mark.parametrize("known, heavy", [(0, lm.HEAVY), (40, 50), (lm.KNOWN, 20)])
def test_rows_of_pairs_are_sorted_once(spark, monkeypatch, known, heavy):
    """One window and two readings of the texts, whichever words are heavy, known or neither."""
    monkeypatch.setattr(lm, "KNOWN", known)
    monkeypatch.setattr(lm, "HEAVY", heavy)
    rnd = random.Random(8)
    words = ["of"] * 200 + ["the"] * 150 + [f"k{i}" for i in range(30)] * 8 + [f"u{i}" for i in range(300)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 80)))) for i in range(90)]
    rows += [(i + 100, f"u1 u2 u3 u1 u2 {t}") for i, t in rows[:30]]  # unknown words that others share
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ws = Plans(spark)
    got = {r.doc_id: r for r in lm.scores(df, ws).collect()}
    for d, n, score in plain_words(rows):
        assert got[d].n_words == n
        assert abs(got[d].score - score) < 1e-9
    plans = "".join(ws.plans.values())
    assert plans.count("Window [") == 1 and plans.count("MapInArrow") == 2
