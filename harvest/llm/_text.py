"""Small helpers that several operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.session import checkpoint_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of a narrow frame: its rows go to the folder in spark.checkpoint.dir,
    which all executors share and Spark cleans up when the frame is no longer in use."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def rest_of(df: DataFrame, *without: str) -> Column:
    """All other columns as one struct, so that no name in it can clash with an operator's own."""
    cols = [F.col(f"`{c}`") for c in df.columns if c not in without]
    return (F.struct(*cols) if cols else F.struct(F.lit(None).cast("int").alias("none"))).alias("rest")


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as long as asked for."""

    base = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up), 1 << 16)
            steps = np.full(size, self.base, np.uint64)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps[1:] = pow(self.base, -1, 1 << 64)
            self.down = np.multiply.accumulate(steps)


POWERS = Powers()


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` codes: equal runs hash alike wherever they stand."""
    n = len(codes)
    if n < k:
        return np.empty(0, np.uint64)
    POWERS.grow(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(codes * POWERS.up[:n], out=total[1:])
    return mix((total[k:] - total[:-k]) * POWERS.down[:n - k + 1])


def window_min(values: np.ndarray, w: int) -> np.ndarray:
    """The least value in each run of ``w`` values."""
    have, out = 1, values
    while 2 * have <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (w - have)], out[w - have:]) if have < w else out
