"""Personal data by a semi-Markov conditional random field beside fixed patterns.

Base spans come from one pattern a kind (leftmost, not overlapping, checked as a whole). The field
then looks at every region of a text, that is, every maximal run of chunks between white space
that hold a digit or an ``@``. A region is cut into atoms (letters, digits, single others).
Segments of up to ``LONGEST`` atoms compete for the kinds, single atoms for "nothing"; a segment's
features see it whole (shape, number of digits, checks, what stands beside it). A dynamic
programme over segment ends picks boundaries and kinds together. Its spans are added where they
overlap no base span and their log-odds against nothing in that place reach ``MARGIN``.

Weights are fitted by the gradient of the conditional likelihood on at most ``REGIONS`` regions
of texts that hold base spans, whose base spans serve as labels. Every whole text is searched.

Null texts count as empty; empty texts have no spans. Equal rows give equal spans, extra
columns stay away, and without regions to learn from nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replicheck.llm.text import map_batches, record, seeded

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: The pattern of an ip as it is searched: digits are taken whole and from their first one on,
#: which finds the same and reads each digit a few times only.
WHOLE_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
SIGN, SPACE = re.compile("[0-9@]"), re.compile(r"\s")
ATOM = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)
#: Atoms and characters in a segment at most; regions a fit takes at most, and documents they
#: come from; characters of a region that a fit learns from, at most.
LONGEST, LENGTH, REGIONS, DOCUMENTS, LEARNT = 24, 320, 1_500, 20_000, 200
MARGIN = 0.5
SEED = 5


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def holds(kind: str, match: str) -> bool:
    """Whether a match of the kind's pattern passes its check."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.split("."))
    digits = re.sub("[^0-9]", "", match)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


#: What a text must hold for a kind's pattern to be worth a search.
SIGNS = {"email": re.compile("@"), "ip": re.compile(r"[0-9]\.[0-9]"), "card": re.compile("[0-9]"), "phone": re.compile(r"\+[0-9]")}


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind as listed, then by start."""
    out = []
    for kind in KINDS if text else ():
        if not SIGNS[kind].search(text):
            continue
        for m in _matches(kind, text):
            if holds(kind, m[0]):
                out.append((kind, m.start(), m.end()))
    return out


def _matches(kind: str, text: str):
    """All matches of a pattern. The search for an address starts anew at the stretch before
    each ``@``, as the pattern else tries every place of a long stretch without one."""
    if kind != "email":
        yield from (WHOLE_IP if kind == "ip" else PATTERNS[kind]).finditer(text)
        return
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = PATTERNS[kind].match(text, start) if start < at else None
        if m:
            yield m
            end = m.end()
        at = text.find("@", max(at + 1, end))


LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _shape(piece: str) -> str:
    out = re.sub("[A-Za-z]+", "a", re.sub("[0-9]", "9", piece))
    return re.sub("9{6,}", "9*", out)


def segment_features(region: str, start: int, end: int) -> list[str]:
    """What a whole segment says, without its kind."""
    piece = region[start:end]
    digits = re.sub("[^0-9]", "", piece)
    before, after = region[start - 1 : start], region[end : end + 1]
    parts = piece.split(".")
    return [
        "1",
        f"d{len(digits) if len(digits) < 20 else 20}",
        f"luhn{12 < len(digits) < 20 and luhn(digits)}",
        f"quad{len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}",
        f"at{piece.count('@') if piece.count('@') < 3 else 3}",
        f"dots{min(piece.count('.'), 4)}",
        f"dotafterat{'.' in piece.partition('@')[2]}",
        f"plus{piece[0] == '+'}",
        f"first{_shape(piece[0])}",
        f"last{_shape(piece[-1])}",
        f"letters{any(c.isalpha() for c in piece)}",
        f"spaces{' ' in piece}",
        f"other{bool(re.search('[^A-Za-z0-9@.+() %_-]', piece))}",
        f"before{_shape(before) or '^'}",
        f"after{_shape(after) or '$'}",
        f"shape{_shape(piece) if len(piece) < 40 else ''}",
    ]


def _candidates(region: str) -> tuple[list[int], list[tuple[int, int]]]:
    """Bounds of the atoms, and segments of several or one atoms that may be a span."""
    bounds = [m.start() for m in ATOM.finditer(region)] + [len(region)]
    n = len(bounds) - 1
    out = []
    for i in range(n):
        first = region[bounds[i]]
        if not (first.isascii() and (first.isalnum() or first in "+(")):
            continue
        figures, at = 0, False
        for j in range(i, min(n, i + LONGEST)):
            if bounds[j + 1] - bounds[i] > LENGTH:
                break
            atom = region[bounds[j] : bounds[j + 1]]
            figures += len(atom) if atom[0] in "0123456789" else 0
            at = at or atom == "@"
            if (figures >= 4 or at) and atom[0].isascii() and atom[0].isalnum():
                out.append((i, j + 1))
    return bounds, out


class Field:
    """Weights by ``(feature, kind)``; a segment of "nothing" scores 0."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def scored(self, region: str):
        """Segments by their end as ``(start, kind, score, features)``."""
        bounds, segments = _candidates(region)
        by_end = defaultdict(list)
        for i, j in segments:
            feats = segment_features(region, bounds[i], bounds[j])
            for kind in KINDS:
                score = sum(self.weights.get((f, kind), 0.0) for f in feats)
                by_end[j].append((i, kind, score, feats))
        return bounds, by_end

    def spans(self, region: str) -> list[tuple[str, int, int, float]]:
        """The best segmentation's spans as ``(kind, start, end, score)``."""
        bounds, by_end = self.scored(region)
        n = len(bounds) - 1
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for i, kind, score, _ in by_end.get(j, ()):
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, kind, score)
        out, j = [], n
        while j > 0:
            if back[j] is None:
                j -= 1
                continue
            i, kind, score = back[j]
            out.append((kind, bounds[i], bounds[j], score))
            j = i
        return out[::-1]

    def step(self, region: str, gold: set[tuple[str, int, int]], rate: float) -> None:
        """One step along the gradient of the log-likelihood of ``gold``."""
        bounds, by_end = self.scored(region)
        n = len(bounds) - 1
        ahead = np.full(n + 1, -np.inf)
        ahead[0] = 0.0
        for j in range(1, n + 1):
            ahead[j] = np.logaddexp.reduce(
                [ahead[j - 1], *(ahead[i] + s for i, _, s, _ in by_end.get(j, ()))]
            )
        behind = np.full(n + 1, -np.inf)
        behind[n] = 0.0
        by_start = defaultdict(list)
        for j, found in by_end.items():
            for i, _, s, _ in found:
                by_start[i].append((j, s))
        for i in range(n - 1, -1, -1):
            behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[j] + s for j, s in by_start.get(i, ()))])
        for j, found in by_end.items():
            for i, kind, s, feats in found:
                expected = float(np.exp(ahead[i] + s + behind[j] - ahead[n]))
                change = ((kind, bounds[i], bounds[j]) in gold) - expected
                if abs(change) > 1e-4:
                    for f in feats:
                        self.weights[f, kind] = self.weights.get((f, kind), 0.0) + rate * change


def regions(text: str | None) -> list[tuple[int, int]]:
    if not text:
        return []
    out: list[tuple[int, int]] = []
    at = 0
    while sign := SIGN.search(text, at):
        start = sign.start()  # widened to the white space on both sides
        while start > at and not text[start - 1].isspace():
            start -= 1
        space = SPACE.search(text, sign.end())
        end = space.start() if space else len(text)
        if out and start == out[-1][1] + 1 and text[start - 1] == " ":
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        at = end
    return out


def train(examples: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = 6) -> Field:
    """``examples``: a region and its spans, positions within the region."""
    field = Field()
    for epoch in range(epochs):
        for region, gold in examples:
            field.step(region, set(gold), 0.1 / (1 + epoch))
    return field


def fit(docs: DataFrame) -> Field:
    chosen = (
        docs.filter(F.col("text").rlike("[0-9@]"))
        .select(F.col("doc_id").cast("long").alias("doc_id"))
        .filter("doc_id is not null")
        .distinct()
        .orderBy(seeded("doc_id", SEED), "doc_id")
        .limit(DOCUMENTS)
    )

    def make():
        def step(batch: pa.RecordBatch):
            found, spans = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                for a, b in regions(text):
                    if b - a > LEARNT:
                        continue
                    inside = [(k, s - a, e - a) for k, s, e in base if a <= s and e <= b]
                    found.append(text[a:b])
                    spans.append(",".join(f"{k}:{s}:{e}" for k, s, e in inside))
            return record(region=pa.array(found, pa.string()), spans=pa.array(spans, pa.string()))

        return step

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    rows = (
        map_batches(texts.select("text"), "region string, spans string", make)
        .distinct()
        .orderBy(F.xxhash64(F.lit(SEED), "region"), "region", "spans")
        .limit(REGIONS)
        .collect()
    )
    examples = []
    for r in rows:
        parts = [p.split(":") for p in r.spans.split(",") if p]
        examples.append((r.region, [(k, int(s), int(e)) for k, s, e in parts]))
    return train(examples)


def all_spans(text: str | None, field: Field) -> tuple[list, list]:
    """Base spans and all spans, each by kind as listed, then by start."""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    more = []
    for a, b in regions(text):
        free = [(s, e) for s, e in taken if s < b and e > a]
        for kind, s, e, score in field.spans(text[a:b]) if field.weights else ():
            s, e = s + a, e + a
            if score >= MARGIN and not any(s < y and x < e for x, y in free):
                more.append((kind, s, e))
    return base, sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1]))


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, base, spans``: arrays of ``(kind, start, end)`` in code points, end exclusive."""
    field = field or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(dict(field.weights))
    kind = "array<struct<kind:string,start:long,end:long>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def make():
        field = Field(shared.value)

        def step(batch: pa.RecordBatch):
            both = [all_spans(t, field) for t in batch.column("text").to_pylist()]
            named = [[[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in pair] for pair in both]
            return record(
                doc_id=batch.column("doc_id"),
                base=pa.array([x for x, _ in named], arrow),
                spans=pa.array([x for _, x in named], arrow),
            )

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, f"doc_id long, base {kind}, spans {kind}", make)


def report(docs: DataFrame) -> DataFrame:
    """Numbers of base spans by kind, the digest of base spans, and all spans as text."""
    found = find(docs)
    listed = lambda c: F.array_join(
        F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    numbers = [number(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *numbers, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, other columns as they are.
    Overlapping spans are replaced as one, named by the one that starts first."""
    field = field or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(dict(field.weights))
    at = docs.columns.index("text")

    def make():
        field = Field(shared.value)

        def clean(text: str | None) -> str | None:
            out, done = [], 0
            for kind, s, e in sorted(all_spans(text, field)[1], key=lambda x: (x[1], -x[2])):
                if s >= done:
                    out += [text[done:s], f"<{kind.upper()}>"]
                done = max(done, e)
            return "".join([*out, text[done:]]) if out else text

        def step(batch: pa.RecordBatch):
            texts = pa.array([clean(t) for t in batch.column(at).to_pylist()], pa.string())
            return pa.RecordBatch.from_arrays(
                [texts if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names
            )

        return step

    return map_batches(docs, docs.schema, make)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
