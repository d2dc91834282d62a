"""Encoding against the tiktoken library, and the way back."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from replicheck.llm import bpe
from replicheck.llm.queries import vocabulary

ALPHABET = "ab 'stlmrevd \n\t\r\x0b\x1c\x1d\x85\xa0é漢字🙂1२Ⅷ.,!​́ǅ"


@pytest.fixture(scope="module")
def library():
    ranks = {t: i for i, t in enumerate(vocabulary()) if t}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_UNITS", 500)
    encoder, rnd = bpe.Encoder(vocabulary(), P.PATTERN), random.Random(4)
    for _ in range(60):
        texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(50)]
        flat, ends = encoder.batch(texts)
        for k, t in enumerate(texts):
            assert flat[ends[k] : ends[k + 1]].tolist() == library.encode_ordinary(t)


def test_tree_and_forest_agree(library):
    merges, rnd = bpe.Merges(vocabulary()), random.Random(2)
    pieces = [bytes(rnd.choice(b"thea nd\xc3\xa9") for _ in range(rnd.randint(2, 60))) for _ in range(300)]
    flat, sizes = bpe.merge_forest(pieces, merges)
    assert flat.tolist() == [i for p in pieces for i in bpe.merge_one(p, merges)]
    assert sizes.tolist() == [len(bpe.merge_one(p, merges)) for p in pieces]


def test_documents(spark, library):
    long = "ab" * 20_000 + " " * 3_000 + "word " * 5_000
    rows = [(1, None, 7), (2, "", 7), (3, "Hello  world's end\n\n", 7), (3, "Hello  world's end\n\n", 7), (4, long, 7), (None, "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    got = sorted(map(tuple, bpe.digests(df, vocabulary(), P.PATTERN).collect()), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for d, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=str)
    assert bpe.digests(df.limit(0), vocabulary(), P.PATTERN).count() == 0


def test_full_memory_keeps_what_was_met_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_UNITS", 500)
    encoder = bpe.Encoder(vocabulary(), P.PATTERN)
    learnt, held, learn = [], [], encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda new: (learnt.extend(new), learn(new)))
    for k in range(20):
        text = f"two words, {' '.join(f'w{k}x{i}' for i in range(300))} words"
        flat, _ = encoder.batch([text])
        assert flat.tolist() == library.encode_ordinary(text)
        held.append(len(encoder.units.number))
    assert max(held) < 1_000
    assert learnt.count(" words") == 1
