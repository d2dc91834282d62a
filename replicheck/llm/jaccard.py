"""Jaccard join of documents on word n-grams, by a size-aware heavy-light join.

Documents with equal sets form a class; classes are joined, copies never are. Two sets link when
``100 * |A & B| >= percent * |A | B|``. Writing S for the sum of the sizes, that is an overlap
of at least ``percent * S / (100 + percent)``.

* Small sets (up to a size that costs decide) enumerate their subsets of just the overlap that
  a partner of each possible size would need. Whoever shares a subset is linked, so each subset
  ties its holders to one of them: no pair is compared.
* Large sets go into inverted lists by the first n-grams of their set in one global order (n-grams
  that many sets hold come last; the order only matters for speed): enough of them that linked
  sets meet in a list. Lists of up to ``LIST`` sets are scanned pair by pair.
* Two linked sets that meet in longer lists only are both holders of such lists. These holders
  are dealt again, by themselves and with what they share put last, as long as that halves
  them: what unlike sets share by chance or quote no longer brings them together.
* A list that stays long is scanned through one of its sets, the hub. Each holder is compared with the
  hub and described by its difference from it. Two holders that are not both linked to the hub
  can only be linked if their differences overlap, so the differences are joined by inverted
  lists of their own, again by just as many of their n-grams as linked sets need to meet.
* Candidates that the parities of their n-grams' numbers in bins don't already show to be too
  different are compared on their whole sets, which are rebuilt from the documents' texts.

N-grams are 64-bit hashes of word hashes. Sizes of a set, hubs and comparisons are exact but for
collisions of those (a chance of about n * n / 2e19 for two sets of n).

Null and empty texts have an empty set and link with nothing; texts shorter than an n-gram have
one n-gram, all their words. Copies and repeated rows are in one class. Rows with a null
doc_id get their size and a null component, and link nothing. Extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replicheck.llm.components import components
from replicheck.llm.text import WordHash, give_back, lower_words, map_batches, mix, record, signed, window_hashes
from replicheck.sources import Workspace

#: Longest inverted list that is scanned pair by pair.
LIST = 32
#: Documents that are compared with one set in one go; more are dealt to several tasks.
HANDFUL = 64
#: Holders of a long list that meet its hub in one task.
PART = 256
#: N-grams at most that the global order puts last, and that each new dealing of holders adds: those
#: that most sets hold. Which they are changes the work, never the result.
COMMON = 131_072
#: Largest set that may count as small, and what one entry of an inverted list costs in rows.
SMALL_MOST, ENTRY_COST = 24, 8
#: Bits of the table that keeps texts nobody asks for out of a shuffle (4 MB at most).
BITS = 1 << 25


class Rule:
    """Sizes and overlaps that a link needs, in whole numbers."""

    def __init__(self, percent: int):
        self.p, self.q = percent, 100 + percent

    def overlap(self, a: int, b: int) -> int:
        return -(-self.p * (a + b) // self.q)

    def linked(self, a: int, b: int, both: int) -> bool:
        return self.q * both >= self.p * (a + b)

    def smallest(self, n: int) -> int:
        return -(-self.p * n // 100)

    def largest(self, n: int) -> int:
        return 100 * n // self.p

    def probe(self, n: int) -> int:
        """N-grams by which a set meets each linked set that is no larger."""
        return n - self.smallest(n) + 1

    def index(self, n: int) -> int:
        """N-grams by which a set meets each linked set that is no smaller."""
        return n - self.overlap(n, n) + 1

    def apart(self, n: int) -> int:
        """N-grams at most in which a set differs from a linked one."""
        return (200 - self.q) * (n + self.largest(n)) // self.q

    def subsets(self, n: int) -> int:
        return sum(comb(n, self.overlap(m, n)) for m in range(self.smallest(n), self.largest(n) + 1))


def ngram_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct n-grams of a text's word hashes; all words where there are fewer."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes, min(size, len(hashes))))


def set_key(grams: np.ndarray) -> int:
    """One number that stands for a set."""
    return int(signed(mix(np.add.reduce(mix(grams), keepdims=True) + np.uint64(len(grams))))[0])


def _ordered(grams: np.ndarray, common: np.ndarray) -> np.ndarray:
    """By the global order: n-grams that many sets hold last, else by hash."""
    late = _is_in(grams, common)
    return np.concatenate((grams[~late], grams[late]))


def parities(grams: np.ndarray) -> bytes:
    """For each of 2 to 4 times as many bins as n-grams, whether an odd number falls into it."""
    bins = max(64, 1 << (2 * len(grams)).bit_length())
    odd = np.bincount((grams & np.uint64(bins - 1)).view(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differ_at_least(a: bytes, b: bytes) -> int:
    """A lower bound of the n-grams in which two sets differ, by their parities."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _plausible(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """``pairs`` ``(hub, node)`` without those that differ too much by their parities."""
    sides = pairs.join(nodes.select(F.col("node").alias("hub"), F.col("n").alias("m"), F.col("bits").alias("b")), "hub")
    sides = sides.join(nodes.select("node", "n", "bits"), "node").select("hub", "node", "m", "n", "b", "bits")

    def make():
        def step(batch: pa.RecordBatch):
            columns = (batch.column(c).to_pylist() for c in ("m", "n", "b", "bits"))
            keep = [differ_at_least(b, c) <= (200 - rule.q) * (m + n) // rule.q for m, n, b, c in zip(*columns)]
            return batch.select(["hub", "node"]).filter(pa.array(keep, pa.bool_()))

        return step

    return map_batches(sides, "hub long, node long", make)


def _is_in(grams: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(grams), bool)
    return common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] == grams


def _difference(grams: np.ndarray, centre: np.ndarray, common: np.ndarray) -> np.ndarray:
    """N-grams of one of two sets only, those first that few sets near ``centre`` differ in: own
    ones of ``grams``, then what many sets hold and it lacks, then what many hold and the centre
    lacks, last the centre's own."""
    more = grams[~np.isin(grams, centre, assume_unique=True)]
    lacks = centre[~np.isin(centre, grams, assume_unique=True)]
    a, b = _is_in(more, common), _is_in(lacks, common)
    return np.concatenate((more[~a], lacks[b], more[a], lacks[~b]))


def _sketch(docs: DataFrame, size: int) -> DataFrame:
    """Per row its class and size; and how many sets hold an n-gram, by slice and where several do."""

    def make():
        hashes = WordHash()

        def step(batch: pa.RecordBatch):
            ids, n, key, bits, sets = batch.column("doc_id").to_pylist(), [], [], [], {}
            for text in batch.column("text").to_pylist():
                grams = ngram_set(hashes.of(lower_words(text)), size)
                n.append(len(grams))
                key.append(set_key(grams))
                sets[key[-1]] = grams
                bits.append(parities(grams))
            gram, count = np.unique(np.concatenate(list(sets.values())), return_counts=True)
            gram, count = gram[count > 1], count[count > 1]
            rows, more = len(n), len(gram)
            return record(
                doc_id=pa.array(ids + [None] * more, pa.int64()),
                n=pa.array(n + [None] * more, pa.int64()),
                node=pa.array(key + [None] * more, pa.int64()),
                bits=pa.array(bits + [None] * more, pa.binary()),
                gram=pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(signed(gram))]),
                count=pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(count)]),
            )

        return step

    return map_batches(
        docs, "doc_id long, n long, node long, bits binary, gram long, count long", make, 5_000
    )


def small_bound(sizes: dict[int, int], rule: Rule) -> int:
    """Size up to which enumerating subsets costs less than lists."""
    costs, small = {}, 0
    lists = {n: c * rule.probe(n) * ENTRY_COST for n, c in sizes.items()}
    for bound in range(SMALL_MOST + 1):
        small += sizes.get(bound, 0) * (rule.subsets(bound) if bound else 0)
        costs[bound] = small + sum(v for n, v in lists.items() if n > bound)
    return min(costs, key=lambda b: (costs[b], b))


def _entries(docs: DataFrame, size: int, rule: Rule, bound: int, common: np.ndarray, again: bool) -> DataFrame:
    """Entries of lists ``(gram, node, n, kind)``. A subset that the smaller side holds is of
    kind 0, one of the larger side 1; there are none ``again``. An n-gram of kind 2 lets a large
    set find this small one; of kind 3 lets sets find each other; of kind 4 only finds smaller ones."""

    def make():
        hashes = WordHash()

        def subsets(grams: np.ndarray):
            n = len(grams)
            mixed = mix(grams)
            for m in range(rule.smallest(n), rule.largest(n) + 1):
                both = rule.overlap(m, n)
                if m > bound or both > min(m, n):
                    continue
                tag = mix(np.array([min(m, n) * 1000 + max(m, n)], np.uint64))
                whole = np.add.reduce(mixed, keepdims=True) + tag
                for left_out in combinations(range(n), n - both):
                    yield mix(whole - np.add.reduce(mixed[list(left_out)], keepdims=True)), int(m < n)

        def step(batch: pa.RecordBatch):
            gram, node, sizes, kinds, done = [], [], [], [], set()
            for text in batch.column("text").to_pylist():
                grams = ngram_set(hashes.of(lower_words(text)), size)
                n, key = len(grams), set_key(grams)
                if not n or key in done:
                    continue
                done.add(key)
                parts, kind = [], []
                if n <= bound and not again:
                    for value, larger in subsets(grams):
                        parts.append(value)
                        kind.append(larger)
                if n > bound or rule.largest(n) > bound:
                    few, more = rule.index(n), rule.probe(n)
                    taken = more if n > bound else few
                    parts.append(_ordered(grams, common)[:taken])
                    kind += [3 if i < few else 4 for i in range(taken)] if n > bound else [2] * taken
                if not parts:
                    continue
                found = np.concatenate(parts)
                gram.append(found)
                kinds.append(np.array(kind, np.int32))
                node.append(np.full(len(found), key))
                sizes.append(np.full(len(found), n))
            if not gram:
                return None
            return record(
                gram=signed(np.concatenate(gram)),
                node=np.concatenate(node),
                n=np.concatenate(sizes),
                kind=np.concatenate(kinds),
            )

        return step

    return map_batches(docs, "gram long, node long, n long, kind int", make, 2_000)


def _lists(
    docs: DataFrame, size: int, rule: Rule, bound: int, common: np.ndarray, ws: Workspace, again: bool = False
) -> DataFrame:
    """Entries of the lists that several sets hold, with each list's ``count`` and ``base``."""
    # dealt by n-gram once, for the lists' lengths and for the lists
    entries = _entries(docs, size, rule, bound, common, again).repartition("gram")
    lists = entries.groupBy("gram").agg(
        F.count("*").alias("count"), F.min("node").alias("least"), F.max("node").alias("most"),
        F.min(F.when(F.col("kind") == 0, F.col("node"))).alias("base"), F.max("n").alias("longest"),
    ).filter("least <> most and longest > 0").drop("least", "most", "longest")  # all columns: one exchange serves both
    return ws.stage(entries.join(lists, "gram").dropDuplicates(["gram", "node", "kind"]), "lists")


def _near(scanned: DataFrame, percent: int) -> DataFrame:
    """``(hub, node)`` of sets that meet in a short list, the larger one first."""
    light = scanned.filter(F.col("count") <= LIST)
    small, large = light.filter("kind < 4").alias("s"), light.filter("kind > 2").alias("l")
    return (
        small.join(large, F.expr("s.gram = l.gram and (s.n < l.n or (s.n = l.n and s.node < l.node))"))
        .filter(F.expr(f"100 * s.n >= {percent} * l.n"))
        .select(F.col("l.node").alias("hub"), F.col("s.node").alias("node"))
        .distinct()
    )


def _most(counts: DataFrame) -> DataFrame:
    """The n-grams that most sets hold, by the sums of ``(gram, count)``."""
    sums = counts.groupBy("gram").agg(F.sum("count").alias("count"))
    return sums.orderBy(F.desc("count"), "gram").limit(COMMON).select("gram")


def _sorted(grams: DataFrame) -> np.ndarray:
    out = np.sort(grams.toArrow().column("gram").to_numpy().view(np.uint64))
    give_back()
    return out


def _by_hubs(heavy: DataFrame) -> DataFrame:
    """``(node, hub)`` of every holder of a long list. The hub is the holder that is in most long
    lists: what many documents were copied from is nearer to each of them than another copy.
    A list is dealt to as many tasks as its counted length asks for."""
    weight = heavy.groupBy("node").agg(F.count("*").alias("weight"))
    hubs = heavy.join(weight, "node").groupBy("gram").agg(
        F.max(F.struct("weight", "node")).alias("hub"), F.max("count").alias("count")
    )
    parts = F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("count"), F.lit(PART)))
    chosen = hubs.select("gram", F.col("hub.node").alias("hub"), F.explode(parts).alias("part"))
    dealt = heavy.withColumn(
        "part", F.pmod(F.xxhash64("node"), F.call_function("div", F.col("count"), F.lit(PART)) + 1)
    )
    return dealt.join(chosen, ["gram", "part"]).filter("hub <> node").select("node", "hub").distinct()


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is among ``wanted``. A table of bits, of a size that does
    not depend on the data, drops most others before the join shuffles anything."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    bits = (
        wanted.select(slot.alias("slot"))
        .groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
    )
    place = docs.select("doc_id", "text", slot.alias("slot")).select(
        "doc_id",
        "text",
        F.expr("bitmap_bucket_number(slot)").alias("bucket"),
        F.expr("bitmap_bit_position(slot)").alias("place"),
    )
    byte = F.conv(F.hex(F.expr("substring(bits, cast(place div 8 as int) + 1, 1)")), 16, 10)
    set_bit = F.floor(byte.cast("long") / F.pow(F.lit(2), F.col("place") % 8)) % 2 == 1
    likely = place.join(F.broadcast(bits), "bucket").filter(set_bit)
    # an inner join with distinct ids: Spark would move a semi join below the test of bits
    return likely.select("doc_id", "text").join(wanted.select("doc_id").distinct(), "doc_id")


def _texts_by_list(docs: DataFrame, heavy: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text of each holder, those of a long list beside each other: batches of them show what
    they share. A list is dealt to as many tasks as its length asks for."""
    at = heavy.groupBy("node").agg(F.max(F.struct("count", "gram")).alias("list")).join(nodes, "node")
    part = F.pmod(F.xxhash64("doc_id"), F.call_function("div", F.col("list.count"), F.lit(PART)) + 1)
    at = at.groupBy("doc_id").agg(F.max("list").alias("list")).select("doc_id", F.col("list.gram").alias("gram"), part.alias("part"))
    texts = _texts_of(docs, at.select("doc_id")).join(at, "doc_id")
    return texts.repartition("gram", "part").sortWithinPartitions("gram", "part").select("doc_id", "text")


def _compare(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, rule: Rule, common: np.ndarray, ws: Workspace
) -> DataFrame:
    """``pairs`` ``(hub, node, differ)``, which are read several times, compared on whole sets: ``(hub, node, n, linked, grams,
    few)``. Where ``differ`` is true, ``grams`` holds the n-grams by which the node's difference
    from the hub meets others, and ``few`` how many of them larger differences need."""
    rep = nodes.select(F.col("node").alias("member"), "doc_id")
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / HANDFUL).alias("parts"))
    dealt = pairs.join(parts, "hub").select(
        *pairs.columns, F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")
    )
    sides = dealt.select("hub", "part", F.col("node").alias("member"), "differ").union(
        dealt.groupBy("hub", "part").agg(F.lit(None).cast("boolean").alias("differ")).select(
            "hub", "part", F.col("hub").alias("member"), "differ"
        )
    )
    placed = ws.stage(sides.join(rep, "member"), "placed")
    texts = _texts_of(docs, placed.select("doc_id").distinct())
    schema = "hub long, node long, n long, linked boolean, differ boolean, size long, few long, grams array<long>"
    together = (
        placed.join(texts, "doc_id")
        .repartition("hub", "part")
        .sortWithinPartitions("hub", "part", F.col("differ").isNotNull())
    )

    def make():
        hashes, state = WordHash(), {"at": None, "set": None}

        def step(batch: pa.RecordBatch):
            out = {k: [] for k in ("hub", "node", "n", "linked", "differ", "size", "few", "grams")}
            rows = zip(*(batch.column(c).to_pylist() for c in ("hub", "part", "member", "differ", "text")))
            for hub, part, member, differ, text in rows:
                grams = ngram_set(hashes.of(lower_words(text)), size)
                if set_key(grams) != member:  # a row that shares the id only
                    continue
                if differ is None:
                    state["at"], state["set"] = (hub, part), grams
                    continue
                if state["at"] != (hub, part):
                    raise RuntimeError(f"no text for the hub {hub}")
                centre = state["set"]
                n, both = len(grams), int(np.isin(grams, centre, assume_unique=True).sum())
                delta, few = np.empty(0, np.uint64), 0
                if differ:
                    delta = _difference(grams, centre, common)
                    few = min(len(delta), rule.apart(n) // 2 + 1)
                    if rule.linked(len(centre), n, both):
                        # it only looks for sets that are not linked to the hub, which differ from
                        # the hub by so much that they share over p / q of this difference
                        few = min(few, len(delta) - rule.p * len(delta) // rule.q)
                for k, v in (
                    ("hub", hub),
                    ("node", member),
                    ("n", n),
                    ("linked", rule.linked(len(centre), n, both)),
                    ("differ", differ),
                    ("size", len(delta)),
                    ("few", few),
                    ("grams", signed(delta[: rule.apart(n) + 1])),
                ):
                    out[k].append(v)
            return pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [("hub", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("linked", pa.bool_()),
                     ("differ", pa.bool_()), ("size", pa.int64()), ("few", pa.int64()),
                     ("grams", pa.list_(pa.int64()))]
                ),
            )

        return step

    return map_batches(together, schema, make, 500)


def link_classes(docs: DataFrame, ws: Workspace, size: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """``rows`` ``(doc_id, n, node)`` of all documents and ``(node, root)`` of linked classes."""
    rule = Rule(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = ws.stage(_sketch(docs, size), "sketch")
    sketched = first.filter("gram is null")
    rows = sketched.select("doc_id", "n", "node")
    nodes = ws.stage(
        sketched.filter("n > 0 and doc_id is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.first("bits").alias("bits")
        ),
        "classes",
    )
    late = ws.stage(_most(first.filter("gram is not null")), "late")
    common = _sorted(late)
    histogram = nodes.filter(F.col("n") <= SMALL_MOST).groupBy("n").count().collect()
    bound = small_bound({r["n"]: r["count"] for r in histogram}, rule)

    asked = docs.filter("doc_id is not null")
    held = _lists(asked, size, rule, bound, common, ws)
    ties = held.filter("kind < 2 and base is not null").select(F.col("base").alias("a"), F.col("node").alias("b"))
    scanned = held.filter("kind >= 2")
    near, most = _near(scanned, percent), None
    while True:
        heavy = ws.stage(scanned.filter(F.col("count") > LIST).select("gram", "node", "count"), "heavy")
        sets = heavy.select("node").distinct().count()
        if not sets or most is not None and sets > most:
            break
        # linked sets that no short list has brought together are both among the holders
        most = sets // 2
        asked = ws.stage(_texts_by_list(asked, heavy, nodes), "asked")
        shared = _sketch(asked, size).filter("gram is not null").select("gram", "count")
        shared = shared.union(heavy.select("gram", F.lit(1).cast("long").alias("count")))
        more = ws.stage(_most(shared.join(late, "gram", "left_anti")), "late")
        late, common = late.union(more), np.union1d(common, _sorted(more))
        scanned = _lists(asked, size, rule, bound, common, ws, again=True)
        near = near.union(_near(scanned, percent))
    near = _plausible(ws.stage(near.distinct(), "near"), nodes, rule).withColumn("differ", F.lit(False))
    through_hub = _by_hubs(heavy).withColumn("differ", F.lit(True))
    pairs = ws.stage(near.union(through_hub.select("hub", "node", "differ")), "pairs")
    met = ws.stage(_compare(pairs, nodes, docs, size, rule, common, ws), "compared")

    deltas = met.filter("differ").select(
        "hub", "node", "n", "linked", "size", "few", F.posexplode("grams").alias("place", "gram")
    )
    x, y = deltas.filter("place < few").alias("x"), deltas.alias("y")
    differing = (
        x.join(y, F.expr("x.hub = y.hub and x.gram = y.gram and x.node <> y.node"))
        .filter(
            F.expr(
                "(x.size < y.size or (x.size = y.size and x.node < y.node)) and not (x.linked and y.linked) "
                f"and (y.size - x.size) * {rule.q} <= {100 - percent} * (x.n + y.n) "
                f"and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) "
                # as the first place that a linked pair meets at; later places may go, they are the last ones
                "and (x.size + y.size - 2 * least(x.size - x.place, y.size - y.place)) "
                f"* {rule.q} <= {100 - percent} * (x.n + y.n)"
            )
        )
        .groupBy("x.hub", F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .agg(
            F.count("*").alias("met"),
            F.first(F.expr("x.size + y.size")).alias("sizes"),
            F.first(F.expr("x.n + y.n")).alias("both_n"),
            F.max("x.place").alias("last_x"), F.max("y.place").alias("last_y"),
            F.first("x.size").alias("size_x"), F.first("y.size").alias("size_y"),
        )
        # differences of one hub have one order: what else they share comes after the last place met,
        # also what the filter above has left out
        .filter(
            f"(sizes - 2 * (met + least(size_x - last_x, size_y - last_y) - 1)) * {rule.q} <= {100 - percent} * both_n"
        )
        .select(F.least("a", "b").alias("hub"), F.greatest("a", "b").alias("node"))
        .distinct()
    )
    differing = _plausible(ws.stage(differing, "differing"), nodes, rule).withColumn("differ", F.lit(False))
    met_again = ws.stage(_compare(ws.stage(differing, "pairs"), nodes, docs, size, rule, common, ws), "compared")
    links = (
        met.union(met_again).filter("linked").select(F.col("hub").alias("a"), F.col("node").alias("b")).union(ties)
    )
    return rows, components(links, ws)


def duplicates(docs: DataFrame, ws: Workspace | None = None, size: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest doc_id
    that links reach, its own included)."""
    ws = ws or Workspace(docs.sparkSession)
    rows, roots = link_classes(docs, ws, size, percent)
    root = F.coalesce("root", "node")
    known = ws.stage(rows.join(roots, "node", "left").select("doc_id", "n", root.alias("root")), "rooted")
    least = known.filter("n > 0 and doc_id is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return known.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))
