"""Helpers of the text operators: tables, written intermediates, word hashes and the contracts' held-out folds."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.session import scratch_path

MASK64 = (1 << 64) - 1
WHITE = "\x20\x09-\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written as Parquet to the folder that all executors share and read back: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def utf8(text_col: str) -> Column:
    """The text as bytes; a NULL text is empty."""
    return F.coalesce(F.col(text_col), F.lit("")).cast("binary")


@cache
def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers from a seed."""
    return np.array([xxhash.xxh3_64_intdigest(i.to_bytes(4, "little"), seed=seed) | 1 for i in range(n)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)


def windows(values: np.ndarray, size: int, seed: int) -> np.ndarray:
    """One hash per window of ``size`` neighbouring values, in order; fewer values make one window of all of them."""
    n = len(values)
    if n == 0:
        return values
    width = min(n, size)
    weights = odd_constants(width, seed + width)
    out = np.full(n - width + 1, seed + width, np.uint64)
    for j in range(width):
        out += values[j : n - width + 1 + j] * weights[j]
    return mixed(out)


class Remembered(dict):
    """word -> value, filled by ``make`` on first sight. Holds the words of the last ``most`` to ``2 * most`` misses."""

    def __init__(self, make, most: int = 500_000, longest: int = 256) -> None:
        super().__init__()
        self.make, self.most, self.longest = make, most, longest
        self.older: dict = {}

    def __missing__(self, word):
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value
