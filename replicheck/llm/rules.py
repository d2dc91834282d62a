"""Quality rules: a decision list learned by sequential covering.

Every whole text is reduced to counts and shares. From labelled rows the learner covers the bad
ones: a rule is a conjunction of thresholds on those numbers, grown one condition at a time by
FOIL's information gain on two thirds of what is left, then cut back to the prefix that keeps the
best precision on the other third. A rule is kept while its precision on that third reaches
``PRECISION`` with ``LEAST`` rows covered; the rows that it covers are taken out and the next
rule is grown. The list is emitted as an ordered Spark conditional expression: the first rule that
holds rejects, otherwise the text stays.

The fit takes at most ``SAMPLE`` labelled rows, the first by a seeded hash of doc_id; numbers
come from whole texts of all rows. Null and empty texts have no words, so the base rule rejects
them. Several labels of a document count as bad if one does. Rows of null doc_id are judged but
never learned from. Repeated rows get equal verdicts, extra columns are not read, and without
labels the list is empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replicheck.llm.text import WordHash, map_batches, record, seeded, window_hashes, words
from replicheck.sources import Workspace

SAMPLE = 20_000
SEED = 23
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST, PRECISION, CONDITIONS, THRESHOLDS, RULES = 8, 0.95, 4, 32, 24
#: What rules may test, as shares and means: they do not grow with the length of a text.
FEATURES = {
    "symbols_a_word": "n_symbols / greatest(n_words, 1)",
    "chars_a_word": "word_chars / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "words_a_line": "n_words / greatest(n_lines, 1)",
    "n_words": "double(n_words)",
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
         "n_upper", "n_digits", "n_marks")
_UPPER, _DIGIT, _MARK = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?"
_BLANK = b" \t\n\x0b\x0c\r"


def stats(text: str | None, hashes: WordHash) -> tuple[int, ...]:
    """The numbers of one text, in the order of STATS."""
    parts = words(text)
    if not parts:
        return (0,) * len(STATS)
    data = text.encode()
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    n = len(parts)
    h = hashes.of(parts)
    covered = 0
    if n >= WINDOW:
        _, first, count = np.unique(window_hashes(h, WINDOW), return_inverse=True, return_counts=True)
        marks = np.zeros(n + 1, np.int32)
        again = np.flatnonzero(count[first] > 1)
        np.add.at(marks, again, 1)
        np.add.at(marks, again + WINDOW, -1) if len(again) else None
        covered = int((np.cumsum(marks)[:n] > 0).sum())
    size = lambda chars: len(data) - len(data.translate(None, chars))
    return (
        n,
        len(text) - size(_BLANK),
        size(SYMBOLS.encode()),
        len(lines) - len(set(lines)),
        covered,
        len(lines),
        len(np.unique(h)),
        size(_UPPER),
        size(_DIGIT),
        size(_MARK),
    )


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the numbers of every whole text."""

    def make():
        hashes = WordHash()

        def step(batch: pa.RecordBatch):
            rows = [stats(t, hashes) for t in batch.column("text").to_pylist()]
            columns = {name: pa.array([r[k] for r in rows], pa.int64()) for k, name in enumerate(STATS)}
            return record(doc_id=batch.column("doc_id"), **columns)

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, "doc_id long, " + ", ".join(f"{n} long" for n in STATS), make)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x > self.bound if self.above else x <= self.bound

    def column(self) -> Column:
        x = F.expr(FEATURES[self.feature])
        return x > F.lit(self.bound) if self.above else x <= F.lit(self.bound)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound:.6g}"


def _cover(rule: Sequence[Condition], values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """Add the condition of most FOIL gain until all covered rows are bad or nothing gains."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < CONDITIONS:
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        if n == 0 or p == 0:
            break
        base = np.log2(p / (p + n))
        best, choice = 1e-9, None
        for name, x in values.items():
            own = np.sort(x[inside & bad])
            at = np.unique(own[np.linspace(0, len(own) - 1, THRESHOLDS).astype(int)])
            rest = np.sort(x[inside & ~bad])
            for above in (True, False):
                # between the bad rows' value and the next good one's
                for bound in at:
                    if above:
                        k = np.searchsorted(rest, bound, "left")
                        low = (rest[k - 1] + bound) / 2 if k else bound - 1
                        pp, nn = (own > low).sum(), (rest > low).sum()
                    else:
                        k = np.searchsorted(rest, bound, "right")
                        low = (rest[k] + bound) / 2 if k < len(rest) else bound
                        pp, nn = (own <= low).sum(), (rest <= low).sum()
                    if pp == 0 or pp + nn == p + n:
                        continue
                    gain = pp * (np.log2(pp / (pp + nn)) - base)
                    if gain > best:
                        best, choice = gain, Condition(name, above, float(low))
        if choice is None:
            break
        rule.append(choice)
        inside &= choice.holds(values)
    return rule


def learn(values: dict[str, np.ndarray], bad: np.ndarray) -> list[list[Condition]]:
    """Ordered rules that reject."""
    rules: list[list[Condition]] = []
    left = np.ones(len(bad), bool)
    test = np.arange(len(bad)) % 3 == 2  # the rows come in a seeded order
    while len(rules) < RULES:
        train, held = left & ~test, left & test
        if bad[train].sum() < LEAST:
            break
        rule = _grow({k: v[train] for k, v in values.items()}, bad[train])
        options = []
        for size in range(1, len(rule) + 1):
            hit = _cover(rule[:size], values, len(bad))
            right, all_hit = int((hit & held & bad).sum()), int((hit & held).sum())
            options.append(((right + 1) / (all_hit + 2), right, -size))
        if not options:
            break
        worth, right, size = max(options)
        rule = rule[:-size]
        hit = _cover(rule, values, len(bad)) & left
        covered, wrong = int(hit.sum()), int((hit & ~bad).sum())
        if covered < LEAST or wrong > (1 - PRECISION) * covered or right == 0:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(measured: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter(
        "quality is not null and doc_id is not null"
    )
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(seeded("doc_id", SEED), "doc_id").limit(SAMPLE)
    rows = (
        measured.join(F.broadcast(chosen), "doc_id")
        .filter("n_words > 0")
        .select("doc_id", "quality", *[F.expr(e).alias(n) for n, e in FEATURES.items()])
        .dropDuplicates(["doc_id"])
        .orderBy(seeded("doc_id", SEED), "doc_id")
        .toArrow()
    )
    values = {n: rows.column(n).to_numpy().astype(float) for n in FEATURES}
    return learn(values, rows.column("quality").to_numpy() == 0)


def verdict(rules: list[list[Condition]]) -> Column:
    """Whether a measured text stays, as an ordered conditional expression."""
    out = None
    for rule in rules:
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        out = F.when(holds, False) if out is None else out.when(holds, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """Per document its base numbers, ``base_failed`` and ``kept``."""
    ws = ws or Workspace(docs.sparkSession)
    measured = ws.stage(measure(docs), "measured")
    rules = fit(measured, labels)
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )
