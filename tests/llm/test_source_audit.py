"""The audit's sort and counts against plain Python."""

import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from replicheck.llm import source_audit
from replicheck.llm.oracle import OP12
from replicheck.llm.source_audit import audit, count_shard, sort_pointers, word_counts, word_pointers

LONG = "abcdefgh" * 3
TEXTS = st.lists(
    st.one_of(
        st.none(),
        st.text(max_size=30),
        st.lists(st.sampled_from(["a", "ab", "abcdefgh", "abcdefghi", LONG, LONG + "x", "Éa", "日本", "1", "_"]), max_size=25).map(" ".join),
    ),
    max_size=12,
)


def plain_words(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(0, 3))
def test_shard_counts(texts, skip):
    texts = [t and t.encode("utf-8", "ignore").decode() for t in texts]
    column = pa.array([*["padding"] * skip, *texts], pa.string()).slice(skip)
    groups = np.arange(len(texts)) % 3
    terms, group, cnt, df = count_shard(column, groups)
    found = {(t, g): (c, d) for t, g, c, d in zip(terms.to_pylist(), group.tolist(), cnt.tolist(), df.tolist())}
    counts, docs = Counter(), defaultdict(set)
    for k, t in enumerate(texts):
        for w in plain_words(t):
            counts[w, k % 3] += 1
            docs[w, k % 3].add(k)
    assert found == {k: (c, len(docs[k])) for k, c in counts.items()}
    assert len(terms) == len(found)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["b", "a", "abcdefgh", "abcdefgha", LONG, LONG + "a", LONG + "abcdefgh"]), max_size=40))
def test_pointers_are_in_order(words):
    data = np.frombuffer((" ".join(words)).encode() + b" " * 8, np.uint8)
    data = source_audit.WORD_BYTES[data]
    starts, lengths = word_pointers(data[:-8], np.array([0, len(data) - 8]))
    order, new = sort_pointers(data, starts, lengths)
    found = [bytes(data[starts[i] : starts[i] + lengths[i]]).decode() for i in order]
    assert found == sorted(words)
    assert new.tolist() == [k == 0 or found[k] != found[k - 1] for k in range(len(found))]


def as_sql(rows, documents=30):
    con = duckdb.connect()
    table = pa.table(
        {c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(
            [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string())])}
    )
    con.register("documents", table)
    sql = OP12.replace("HAVING count(DISTINCT row) >= 30", f"HAVING count(DISTINCT row) >= {documents}")
    return sorted(con.sql(f"SELECT lang, source, part, item, value, rank FROM ({sql})").fetchall())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def sources(n):
    """Texts of n sources and two languages, with ties, rare words, nulls and repeated rows."""
    rows = []
    for k in range(6 * n):
        words = ["the"] * (k % 5) + ["of", f"w{'xyz'[k % 3]}", "Éte" if k % 2 else "ÉTE", "x" * (k % 4)]
        rows.append((k // 2, " ".join(words), "en" if k % 3 else None, None if k % n == 0 else f"s{k % n}"))
    return [*rows, *rows[:7], (None, None, "en", "s1"), (1, "", "fr", "alone"), (2, "seldom", "de", "a"), (2, "", "de", "b")]


@pytest.mark.parametrize("tile", [512, 2])
def test_all_parts_as_sql(spark, monkeypatch, tile):
    monkeypatch.setattr(source_audit, "TILE", tile)
    monkeypatch.setattr(source_audit, "BLOCK", 64 // tile)
    monkeypatch.setattr(source_audit, "SHARD_BYTES", 100)
    rows = sources(5)
    found = sorted(map(tuple, audit(frame(spark, rows), documents=3).collect()))
    assert found == as_sql(rows, 3)
    assert {r[2] for r in found} == {"pair", "term"}
    assert ("de", "a", "pair", "b", 0, 1) in found


def test_other_columns_and_empty_table(spark):
    docs = frame(spark, sources(3))
    more = docs.selectExpr("*", "1 AS term", "'x' AS cnt", "2 AS no", "3 AS value")
    assert sorted(map(tuple, audit(more, 3).collect())) == sorted(map(tuple, audit(docs, 3).collect()))
    assert audit(docs.limit(0)).count() == 0


def test_long_text_and_one_word_everywhere(spark):
    rows = [(0, "the " * 200_000 + "a" * 1_000_000, "en", "s"), (1, "the", "en", "s")]
    found = {r["term"]: (r["cnt"], r["df"]) for r in word_counts(frame(spark, rows)).collect()}
    assert found == {"the": (200_001, 2), "a" * 1_000_000: (1, 1)}


def test_two_equal_words_of_a_megabyte():
    data = np.concatenate([np.full(1_000_000, 97), [0], np.full(1_000_000, 97), [0] * 9, [98, 0] * 300_000, [0] * 8])
    starts, lengths = word_pointers(data[:-8].astype(np.uint8), np.array([0, len(data) - 8]))
    begin = time.perf_counter()
    order, new = sort_pointers(data.astype(np.uint8), starts, lengths)
    assert new.sum() == 2 and order[:2].tolist() == [0, 1]
    assert time.perf_counter() - begin < 20


def test_shares_beyond_32_bits():
    part, whole = np.array([5, 9_000_000_000_000]), np.array([10**13, 9_000_000_000_001])
    found = source_audit._digits(part, whole, np.floor_divide)
    assert found.tolist() == [10**9 * int(a) // int(b) for a, b in zip(part, whole)]
