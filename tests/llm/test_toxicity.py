"""Held-out accuracy on planted words, and unusual rows."""

import random
import zlib

from replicheck.llm import toxicity

BAD = ["gremph", "zorkel", "bluvid"]


def world(n=1500, seed=8):
    rnd = random.Random(seed)
    vocab = [f"{rnd.choice('abcdef')}{i}x" for i in range(900)]
    docs, labels = [], []
    for i in range(n):
        words = rnd.choices(vocab, k=rnd.randint(5, 80))
        toxic = rnd.random() < 0.15
        if toxic:
            for _ in range(rnd.randint(2, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice(BAD))
        docs.append((i, " ".join(words), "clash"))
        if rnd.random() < 0.6:
            labels.append((i, int(toxic), "clash"))
    return docs, labels


def test_held_out(spark):
    docs, labels = world()
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = {r.doc_id: r for r in toxicity.judge(d, lab).collect()}
    truth = {i: any(b in t for b in BAD) for i, t, _ in docs}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in truth)
    assert all(got[i].predicted == (got[i].score >= 0.5) and 0 <= got[i].score <= 1 for i in truth)
    held = [i for i in truth if got[i].held_out]
    assert sum(got[i].predicted == truth[i] for i in held) >= 0.97 * len(held)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = world(400)
    d = spark.createDataFrame(docs, "doc_id long, text string, more string")
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, t, x in labels]
    first, second = (
        sorted(map(tuple, toxicity.judge(d, spark.createDataFrame(x, "doc_id long, toxic int, more string")).collect()))
        for x in (labels, flipped)
    )
    assert first == second


def test_unusual_rows(spark):
    rows = [(1, None), (2, ""), (3, "a " * 60_000), (None, "gremph zorkel"), (5, "same"), (5, "same")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.judge(d, none).collect()] == [0.0] * 6
    assert toxicity.judge(d.limit(0), none).count() == 0
    docs, labels = world(300)
    lab = spark.createDataFrame([(i, t) for i, t, _ in labels] + [(1, 1), (1, 0)], "doc_id long, toxic int")
    both = spark.createDataFrame([(i, t) for i, t, _ in docs] + rows, "doc_id long, text string")
    got = toxicity.judge(both, lab).filter("doc_id is null").first()
    assert got.predicted == 1 and got.held_out is False
