"""Exact top-k search by inner product, in tiles.

Vectors are packed in their own partitions: rows of up to ``SHARD`` candidates, rows of up to
``BLOCK`` queries. Packs of one length are numbered and dealt to the cells of a grid: the blocks of
a row of the grid go to all its cells, the shards of a column to all of its. A cell holds at most
``HELD`` blocks and reads its shards one after the other; each block and shard is a tile, a matrix
product of bounded size that keeps each query's k best. Both sides move to their cells in one
exchange, a block once a column and a shard once a row. Lists of a query are merged as a tree,
``FAN`` lists at a time, so no task ever sees more than ``FAN * k`` candidates of a query. Work is
queries times candidates, as exact search by products needs.

Components become ``floor(scale * x)``, as whole numbers in doubles: products and sums below 2**53
are exact. Vectors that are null, empty, or hold null or non-finite components take no part;
vectors only meet those of their own length. Ties go to the smaller id. Repeated rows of an id are
candidates each; only a row with the query's own id is left out. Queries that repeat an id give the
same list once. Rows with a null id take no part. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replicheck.llm.text import record
from replicheck.sources import Workspace

SHARD, BLOCK, HELD, FAN = 8_192, 1_024, 8, 16
#: Cells of a grid's row at least, where there are as many shards.
COLUMNS = 64


def _usable(column: str) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(column, fine)


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """``(pack, dim, ids, data)``: up to ``size`` vectors of one length, packed where they are."""
    part = F.spark_partition_id()

    def run(batches):
        kept: dict[int, list] = {}
        number = 0

        def pack(dim: int):
            nonlocal number
            ids, vectors, at = zip(*kept.pop(dim))
            number += 1
            return record(
                pack=pa.array([(at[0] << 32) + number], pa.int64()),
                dim=pa.array([dim], pa.int64()),
                ids=pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                data=pa.array([np.array(vectors, np.float64).tobytes()], pa.binary()),
            )

        for batch in batches:
            for i, at, v in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "vector"))):
                kept.setdefault(len(v), []).append((i, v, at))
                if len(kept[len(v)]) == size:
                    yield pack(len(v))
        for dim in list(kept):
            yield pack(dim)

    return rows.withColumn("part", part.cast("long")).mapInArrow(
        run, "pack long, dim long, ids binary, data binary"
    )


def _numbered(packs: DataFrame, name: str, ws: Workspace) -> DataFrame:
    """``(pack, dim, no)``: packs of a length numbered from 0; one row a pack is all that a task
    sees of a length."""
    place = F.row_number().over(Window.partitionBy("dim").orderBy("pack")) - 1
    return ws.stage(packs.select("pack", "dim", place.cast("long").alias("no")), name)


def _grid(queries: DataFrame, shards: DataFrame, ws: Workspace) -> tuple[DataFrame, int]:
    """``(dim, row, column, kind, ids, data)``: blocks (kind 0) and shards (kind 1) in the cells
    that they are wanted in; and the columns of the widest grid."""
    blocks, groups = _numbered(queries, "blocks", ws), _numbered(shards, "groups", ws)
    div = lambda a, b: F.call_function("div", a, b)
    rows = blocks.groupBy("dim").agg((div(F.count("*") - 1, F.lit(HELD)) + 1).alias("rows"))
    wide = F.greatest(F.lit(COLUMNS), div(F.count("*"), F.lit(COLUMNS)))
    columns = groups.groupBy("dim").agg(F.least(F.count("*"), wide).alias("columns"))
    size = ws.stage(rows.join(columns, "dim"), "grid")  # one row a length
    counted = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    def cells(packs: DataFrame, numbers: DataFrame, kind: int, own: str, own_count: str, other: str, other_count: str):
        place, all_others = (F.col("no") % F.col(own_count)).alias(own), counted(other_count).alias(other)
        dealt = numbers.join(size, "dim").select("pack", "dim", place, all_others, F.lit(kind).alias("kind"))
        return packs.drop("dim").join(dealt, "pack").select("dim", "row", "column", "kind", "ids", "data")

    dealt = cells(queries, blocks, 0, "row", "rows", "column", "columns").union(
        cells(shards, groups, 1, "column", "columns", "row", "rows")
    )
    return dealt, size.agg(F.max("columns")).first()[0] or 1


def _best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's k highest scores, equal ones by ascending id; -inf is no candidate."""
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        wide = int((scores >= least).sum(1).max())  # with all that are as good as the last of the k
        if wide < scores.shape[1]:
            at = np.argpartition(-scores, wide - 1, axis=1)[:, :wide]
            scores, ids = np.take_along_axis(scores, at, 1), np.take_along_axis(ids, at, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _tiles(cells: DataFrame, k: int) -> DataFrame:
    """``(query_id, vec_id, score, place)``: each query's k best of each cell it is in."""

    def run(batches):
        cell, held = None, []

        def out():
            for q_ids, _, scores, ids in held:
                n = (scores > -np.inf).ravel()
                yield record(
                    query_id=np.repeat(q_ids, scores.shape[1])[n],
                    vec_id=ids.ravel()[n],
                    score=scores.ravel()[n].astype(np.int64),
                    place=np.full(int(n.sum()), cell[2]),
                )

        for batch in batches:
            for i in range(batch.num_rows):
                dim, row, column, kind, ids, data = (batch.column(c)[i].as_py() for c in range(6))
                if (dim, row, column) != cell:
                    yield from out()
                    cell, held = (dim, row, column), []
                ids = np.frombuffer(ids, np.int64)
                data = np.frombuffer(data, np.float64).reshape(-1, dim)
                if kind == 0:
                    held.append((ids, data, np.empty((len(ids), 0)), np.empty((len(ids), 0), np.int64)))
                    continue
                for at, (q_ids, vectors, scores, known) in enumerate(held):
                    product = vectors @ data.T
                    product[q_ids[:, None] == ids[None, :]] = -np.inf
                    some = _best_of(product, np.broadcast_to(ids, product.shape), k)
                    both = (np.concatenate(pair, axis=1) for pair in zip((scores, known), some))
                    held[at] = (q_ids, vectors, *_best_of(*both, k))
        yield from out()

    dealt = cells.repartition("dim", "row", "column").sortWithinPartitions("dim", "row", "column", "kind")
    return dealt.mapInArrow(run, "query_id long, vec_id long, score long, place long")


def search(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id: str = "vec_id",
    vector: str = "embedding", ws: Workspace | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of every row that ``is_query``."""
    ws = ws or Workspace(vectors.sparkSession)
    as_double = F.col(vector).cast("array<double>")
    used = vectors.select(
        F.col(id).cast("long").alias("id"), as_double.alias("vector"), is_query.alias("asks")
    ).filter(F.col("id").isNotNull() & _usable("vector"))
    used = used.withColumn("vector", F.transform("vector", lambda x: F.floor(F.lit(scale) * x).cast("double")))
    asking = used.filter("asks").dropDuplicates(["id", "vector"])
    queries = ws.stage(_packed(asking, BLOCK), "queries")
    shards = ws.stage(_packed(used, SHARD), "shards")
    cells, width = _grid(queries, shards, ws)
    lists = _tiles(cells, k)
    best = Window.partitionBy("query_id", "place").orderBy(F.desc("score"), "vec_id")
    while True:
        lists = lists.withColumn("place", F.floor(F.col("place") / FAN).cast("int"))
        lists = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        width = -(-width // FAN)
        if width <= 1:
            break
    return lists.select("query_id", "rank", "vec_id", "score")
