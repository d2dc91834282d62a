"""Token counts against the library that the model belongs to."""

import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from replicheck.llm.queries import PIECES, op13_token_counts
from replicheck.llm.token_counts import PieceModel, TokenCounter, count_tokens, load_pieces, merge_pairs

PATH = public_tokenizers.path(PIECES)
MODEL = load_pieces(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
SF = "/root/testdata/sf0.001"


def test_every_document_as_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = op13_token_counts(spark, SF).collect()
    assert len(found) == docs.count()
    for r in found:
        text = texts[r["doc_id"]]
        n = len(LIBRARY.encode(text))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 4096)


PARTS = st.sampled_from(
    ["the", "ing", " ", "  ", "\n", "\t", "▁", "①", "日本", "一个", "，", "é", "é", "ß", "<s>", "</s>",
     "<0x0A>", "<unk>", "\x00", "　", "\xa0", "🙂", "a", "b", "1", "."]
)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(PARTS, max_size=60).map("".join), st.text(max_size=80)))
def test_any_text_as_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert TokenCounter(MODEL).count(text) == len(LIBRARY.encode(text))


@pytest.mark.parametrize("text", [" " * 300_000, "a" * 300_000, "日本" * 300_000, "ab" * 200_000, "the " * 200_000])
def test_long_texts(text):
    start = time.perf_counter()
    n = TokenCounter(MODEL).count(text)
    assert time.perf_counter() - start < 20
    assert n == len(LIBRARY.encode(text))


def plain(text, ranks):
    """The lowest, then leftmost pair is merged, one scan for each."""
    symbols = list(text)
    while True:
        pairs = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in ranks]
        if not pairs:
            return symbols
        _, k = min(pairs)
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=30), st.dictionaries(st.text("abc", min_size=2, max_size=5), st.integers(0, 4)))
def test_equal_ranks_and_unknown_characters(text, ranks):
    symbols = plain(text, ranks)
    assert len(text) - merge_pairs(text, ranks)[0] == len(symbols)
    model = PieceModel(ranks, dummy_prefix=False, byte_fallback=True)
    assert TokenCounter(model).count(text) == len(symbols)


def test_unknown_character_within_pieces_counts_its_bytes():
    model = PieceModel({"aé": 0, "a": 1}, dummy_prefix=False, byte_fallback=True)
    assert TokenCounter(model).count("aé") == 1
    assert TokenCounter(model).count("éa") == 3


def test_pieces_with_inner_spaces():
    ranks = {"a": 9, "▁": 9, "a▁": 0, "a▁a": 1}
    assert TokenCounter(PieceModel(ranks, False, True)).count("a a a") == len(plain("a▁a▁a", ranks))


def test_other_models_are_refused(spark, tmp_path):
    path = tmp_path / "m"
    path.write_bytes(b"\x12\x02\x18\x01")  # a trainer whose model type is not BPE
    with pytest.raises(ValueError):
        load_pieces(str(path))
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        count_tokens(docs, PieceModel({"a": 0}, False, False), 5)


def test_nulls_empties_repeats_and_names(spark):
    rows = [(1, None, 3), (1, "", 4), (None, "the the", 5), (2, "the the", 6), (2, "the the", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    out = count_tokens(docs, MODEL, 1).collect()
    n = len(LIBRARY.encode("the the"))
    assert sorted((tuple(r) for r in out), key=repr) == sorted(
        [(1, 0, 0, False), (1, 0, 0, False), (None, 7, n, True), (2, 7, n, True), (2, 7, n, True)], key=repr
    )
    assert count_tokens(docs.limit(0), MODEL, 1).count() == 0
    assert "n_tokens" in count_tokens(docs.drop("n_tokens"), MODEL, 1, keep=()).columns
