"""Mixes sources to target weights by min-cost flow.

Documents belong to one or several sources. They are aggregated by membership pattern, so what
reaches the driver is one row a pattern, not a document. Words flow from patterns to the quotas
of their sources; taking a pattern's words a second or third time costs more than the first time
(the cost of epoch e is ``2 e - 1`` a word, so that repetition is convex), and the cheapest flow
fills the quotas. A pattern that shall give f of its s words gives every document ``f // s`` times,
and a seeded choice of documents once more: those whose hash of the doc_id lies below a bound,
found by two histograms and a running sum over what falls into one bin of both.

Targets share all words by weight; one above ``most`` times its source's own words stops there,
and the rest is shared again among the others. Quotas that overlapping sources can't fill
stay unfilled. Null texts have no words; null sources are a source of their own, ordered last.
Empty documents are taken with 0 words. Rows of equal doc_id fall together: all or none are taken
once more. Reruns agree, whatever the partitioning. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replicheck.llm.text import seeded
from replicheck.sources import Workspace

#: Bits of the hash that one histogram resolves: at most 2**BITS bins a pattern.
BITS = 12
SEED = 17


def n_words(column: str) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[int], most: int = 3) -> list[Fraction]:
    """Shares of all words by weight, none above ``most`` times its own."""
    total = sum(sizes)
    out: dict[int, Fraction] = {}
    while len(out) < len(sizes):
        free = [i for i in range(len(sizes)) if i not in out]
        rest = total - sum(out.values(), Fraction(0))
        share = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        above = [i for i in free if share[i] > most * sizes[i]]
        if not above:
            out |= share
        for i in above:
            out[i] = Fraction(most * sizes[i])
    return [out[i] for i in range(len(sizes))]


def flow(patterns: dict[tuple[int, ...], int], quotas: Sequence[int], most: int = 3) -> dict[tuple[int, ...], int]:
    """Words to take from each pattern (of source numbers, with its words): a maximum flow to the
    quotas of least cost, by successive cheapest paths."""
    names = list(patterns)
    start, goal = 0, 1
    of_pattern = {p: 2 + i for i, p in enumerate(names)}
    of_quota = {s: 2 + len(names) + s for s in range(len(quotas))}
    edges: list[list] = []  # to, left, cost; each followed by its reverse
    out: dict[int, list[int]] = {}

    def add(a: int, b: int, room: int, cost: int) -> int:
        out.setdefault(a, []).append(len(edges))
        edges.append([b, room, cost])
        out.setdefault(b, []).append(len(edges))
        edges.append([a, 0, -cost])
        return len(edges) - 2

    gives = {p: [add(start, of_pattern[p], patterns[p], 2 * e - 1) for e in range(1, most + 1)] for p in names}
    for p in names:
        for s in p:
            add(of_pattern[p], of_quota[s], most * patterns[p], 0)
    for s, quota in enumerate(quotas):
        add(of_quota[s], goal, quota, 0)
    n = 2 + len(names) + len(quotas)
    potential = [0] * n
    while True:
        far, via = [None] * n, [None] * n
        far[start] = 0
        queue = [(0, start)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in out.get(a, ()):
                b, room, cost = edges[e]
                if room > 0:
                    new = d + cost + potential[a] - potential[b]
                    if far[b] is None or new < far[b]:
                        far[b], via[b] = new, e
                        heapq.heappush(queue, (new, b))
        if far[goal] is None:
            break
        potential = [p + (f if f is not None else 0) for p, f in zip(potential, far)]
        path, a = [], goal
        while a != start:
            path.append(via[a])
            a = edges[via[a] ^ 1][0]
        push = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= push
            edges[e ^ 1][1] += push
    return {p: sum(edges[e ^ 1][1] for e in gives[p]) for p in names}


def _bounds(docs: DataFrame, plan: DataFrame, ws: Workspace) -> DataFrame:
    """``(pattern, below)``: documents ranked up to ``below`` are taken once more. ``docs`` has ``pattern, size, place``; ``plan`` ``pattern, epochs, rest``."""

    def bin_of(level: int) -> Column:
        return F.shiftrightunsigned("place", 64 - BITS * level).bitwiseAND(F.lit((1 << BITS) - 1))

    docs = docs.filter("size > 0")
    left, found = docs.join(plan.filter("rest > 0").select("pattern", "rest"), "pattern"), []
    for level in (1, 2):
        w = Window.partitionBy("pattern").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        sums = left.groupBy("pattern", "rest", bin_of(level).alias("bin")).agg(F.sum("size").alias("words"))
        before = sums.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0)))
        hit = ws.stage(
            before.filter("before < rest and before + words >= rest").select(
                "pattern", "bin", (F.col("rest") - F.col("before")).alias("missing")
            ),
            "bins",
        )
        found.append(hit)
        left = (
            left.drop("rest").withColumn("bin", bin_of(level)).join(hit, ["pattern", "bin"]).drop("bin")
            .withColumnRenamed("missing", "rest")
        )
    w = Window.partitionBy("pattern").orderBy("rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = left.withColumn("rank", _rank())
    summed = ranked.withColumn("sum", F.sum("size").over(w))
    # the nearest to what is missing, the smaller where both are as near
    nearest = summed.groupBy("pattern").agg(
        F.min(F.struct(F.abs(F.col("sum") - F.col("rest")).alias("off"), "rank")).alias("best"),
        F.min("rest").alias("rest"),
        F.min("rank").alias("first"),
    )
    short = F.col("best.off") < F.col("rest")  # else nothing of the bin is nearer
    return nearest.select(
        "pattern", F.when(short, F.col("best.rank")).otherwise(F.col("first") - 1).alias("below")
    )


def mix(
    docs: DataFrame,
    sources: Column,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    keep: Sequence[str] = ("doc_id",),
    ws: Workspace | None = None,
) -> DataFrame:
    """``keep`` columns and ``size, pattern, source_size, target, copies, taken``.

    ``sources`` is an array of a document's sources. ``source_size`` and ``target`` are of its first
    source; ``copies`` says how often it is taken, ``taken`` its words with repeats."""
    ws = ws or Workspace(docs.sparkSession)
    pattern = F.coalesce(F.to_json(F.array_sort(F.array_distinct(sources))), F.lit("[]"))
    rows = ws.stage(
        docs.select(
            *keep, n_words("text").alias("size"), pattern.alias("pattern"),
            seeded("doc_id", SEED).alias("place"),
        ),
        "documents",
    )
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("words")).collect()
    held = [(r.pattern, json.loads(r.pattern), r.words) for r in sums]
    key = lambda s: (s is None, s or "")  # noqa: E731  by code point, null last
    names = sorted({s for _, own, _ in held for s in own}, key=key)
    number = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for _, own, words in held:
        for s in own:
            sizes[number[s]] += words
    # with overlaps all words are those of documents, not of sources
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], most)
    places = {text: tuple(sorted(number[s] for s in own)) for text, own, _ in held}
    taken = flow({places[text]: words for text, own, words in held if own}, [round(g) for g in goal], most)
    decided = []
    for text, own, words in held:
        epochs, rest = divmod(taken.get(places[text], 0), words) if words else (0, 0)
        first = places[text][0] if own else None
        mine = (sizes[first], float(goal[first])) if own else (0, 0.0)
        decided.append((text, epochs, rest, *mine))
    fields = {"pattern": pa.string(), "epochs": pa.int64(), "rest": pa.int64(), "source_size": pa.int64(), "target": pa.float64()}
    columns = zip(*decided) if decided else [()] * len(fields)
    # as Arrow, which Spark reads by itself: a list of rows starts Python workers of another kind,
    # and they stay beside those of the other operators
    table = pa.table({name: pa.array(c, t) for (name, t), c in zip(fields.items(), columns)})
    plan = ws.stage(docs.sparkSession.createDataFrame(table), "plan")
    bounds = ws.stage(_bounds(rows, plan, ws), "bounds")
    once_more = F.coalesce(_rank() <= F.col("below"), F.lit(False)).cast("long")
    out = rows.join(plan, "pattern").join(bounds, "pattern", "left").withColumn("copies", F.col("epochs") + once_more)
    return out.select(
        *keep, "size", "pattern", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _rank() -> Column:
    """The place as an unsigned number, in an order that signed comparison keeps."""
    return F.col("place").bitwiseXOR(F.lit(-(1 << 63)))


def repeated(docs: DataFrame, sources: Column, ws: Workspace | None = None, **more) -> DataFrame:
    """The columns of ``docs``, each row as often as the mix takes it."""
    mine = [f"`{c}`" for c in docs.columns]
    tagged = docs.select(F.struct(*mine).alias("row"), "text", "doc_id", sources.alias("sources"))
    mixed = mix(tagged, F.col("sources"), keep=("row",), ws=ws, **more).filter("copies > 0")
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.select("row", times).select("row.*")
