"""Numbers by a plain reading, and what a list learns from planted faults."""

import random

from replicheck.llm import rules
from replicheck.llm.text import WordHash, words

TEXTS = [None, "", " \n ", "a b c", "a b c d e a b c d e", "x\nx\n x\n\n \nx", "é#$ <b>|&%*\x1c q", "A1! b2? " * 3_000, "a a a a a a a"]


def plain(text):
    w = words(text)
    text = text or ""
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)} if len(w) < 100 else None
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), covered


def test_numbers():
    hashes = WordHash()
    for t in TEXTS:
        n, chars, symbols, dup, covered = plain(t)
        got = rules.stats(t, hashes)
        if n == 0:
            assert got == (0,) * len(rules.STATS)
        else:
            assert got[:4] == (n, chars, symbols, dup)
            assert got[4] == (len(covered) if covered is not None else n)
    rnd = random.Random(2)
    for _ in range(300):
        t = "".join(rnd.choice(["a ", "b ", "c\n", "\t", "# "]) for _ in range(rnd.randint(1, 60)))
        n, chars, symbols, dup, covered = plain(t)
        if n:
            assert rules.stats(t, hashes)[:5] == (n, chars, symbols, dup, len(covered))


def world(n=900, seed=3):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [f"w{rnd.randint(0, 5000)}" for _ in range(rnd.randint(12, 60))]
        kind = rnd.random()
        if kind < 0.15:
            w = [x + rnd.choice(["###", "$$", "%%%"]) for x in w]
        elif kind < 0.3:
            w = [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(kind >= 0.3)))
    return docs, labels


def test_learns_planted_faults(spark, ws):
    docs, labels = world()
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int")
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(docs, "doc_id long, text string"), known, ws).collect()}
    assert all(got[i].kept == bool(q) for i, q in labels if not got[i].base_failed)
    assert all(not got[i].kept for i in got if got[i].base_failed)


def test_list_is_an_ordered_expression(spark, ws):
    docs, labels = world(300)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    measured = ws.stage(rules.measure(df), "m")
    found = rules.fit(measured, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert found and "CASE WHEN" in str(rules.verdict(found))
    assert str(rules.verdict([])) == "Column<'true'>"


def test_unusual_rows(spark, ws):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "a b", 1), (3, "a b c", 1)], "doc_id long, text string, n_words int")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    got = rules.judge(df, none, ws).collect()
    assert len(got) == len(TEXTS) + 2
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept != r.base_failed for r in got)
    assert rules.judge(df.limit(0), none, ws).count() == 0
