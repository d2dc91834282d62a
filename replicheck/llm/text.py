"""Words, word hashes and batches, as the operators that run inside tasks use them."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

#: Words a task's cache of hashes holds at most; a full cache starts anew.
CACHE_WORDS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Maximal runs of characters other than space and U+0009 to U+000D, as UTF-8."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z lower-cased and other letters as they are."""
    return text.encode().lower().split() if text else []


class WordHash(dict):
    """64-bit hashes of words, looked up or computed."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value

    def of(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, parts), np.uint64, len(parts))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads close values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` word hashes, in order."""
    n = len(h) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = mix(out + h[i : i + n] + np.uint64(i + 1))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def map_batches(
    df: DataFrame, schema: str, make: Callable[[], Callable], slice_rows: int = 500
) -> DataFrame:
    """``df.mapInArrow`` with ``make()`` called once a task; what it returns gets slices of
    at most ``slice_rows`` rows and yields Arrow tables or batches, or returns one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                out = step(batch.slice(at, slice_rows))
                if out is not None and out.num_rows:
                    yield out
        step = batch = out = None
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: Spark keeps a worker's process for other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries lack it
        ctypes.CDLL(None).malloc_trim(0)


def record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def held_out() -> Column:
    """Rows whose labels no learner may see."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def seeded(column: str, seed: int) -> Column:
    """A repeatable pseudo-random place of a row."""
    return F.xxhash64(F.lit(seed), F.col(column))
