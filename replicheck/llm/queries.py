"""One query per operator over its whole table, as ``opN_<name>``."""

from __future__ import annotations

from functools import cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replicheck.llm import (
    bpe, html_diff, jaccard, lexical, lm, mixing, pii, rules, source_audit, token_counts, topk, toxicity, urls,
)
from replicheck.llm.text import read_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECES, TOKEN_LIMIT = "piece_bpe_32k.model", 4096
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@cache
def vocabulary(name: str = VOCABULARY) -> tuple[bytes, ...]:
    return tuple(bpe.load_ranks(public_tokenizers.path(name)))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), vocabulary(), public_tokenizers.PATTERN)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.duplicates(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(read_table(spark, sf_dir, "documents"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"), F.array("source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.extract(read_table(spark, sf_dir, "pages"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = token_counts.load_pieces(public_tokenizers.path(PIECES))
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), model, TOKEN_LIMIT)


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_url_filter, op3_ngram_jaccard, op4_toxicity, op5_pii, op6_lm_score, op7_topk_search,
        op8_source_mix, op9_quality_rules, op10_html_text, op11_lexical_search,
        op12_source_audit, op13_token_counts,
    )
}
