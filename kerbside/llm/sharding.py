"""Shards from a keyed permutation of global row numbers.

Rows get numbers in a canonical order; an unbalanced Feistel network with cycle
walking permutes 0..n-1, so place p = permutation(row number) is computed from
the number alone, and back. Place p is slot p // shards of shard p % shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.session import Workspace

ROUNDS = 6
SEED = 20_240_229
_LOW_33_BITS = (1 << 33) - 1


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = values * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


class Permutation:
    """A bijection of 0..n-1 given by a seed, computable in both directions.

    The network permutes the smallest power-of-two range that holds n; values
    that land outside walk on along their cycle until they are inside, less than
    two steps on average.
    """

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS) -> None:
        self.n = n
        bits = max(2, math.ceil(math.log2(n)) if n > 1 else 2)
        self.low_bits = bits // 2
        self.high_bits = bits - self.low_bits
        drawn = np.random.SeedSequence(seed).generate_state(rounds, np.uint64)
        self.keys = [int(k) for k in drawn]

    def _pass(self, x: np.ndarray, backwards: bool) -> np.ndarray:
        low_mask = np.uint64((1 << self.low_bits) - 1)
        high_mask = np.uint64((1 << self.high_bits) - 1)
        high, low = x >> np.uint64(self.low_bits), x & low_mask
        rounds = list(enumerate(self.keys))
        for i, key in reversed(rounds) if backwards else rounds:
            if i % 2:
                low = low ^ (_mixed(high, key) & low_mask)
            else:
                high = high ^ (_mixed(low, key) & high_mask)
        return (high << np.uint64(self.low_bits)) | low

    def _walk(self, numbers: np.ndarray, backwards: bool) -> np.ndarray:
        x = self._pass(np.asarray(numbers, dtype=np.uint64), backwards)
        outside = np.flatnonzero(x >= self.n)
        while len(outside):
            x[outside] = self._pass(x[outside], backwards)
            outside = outside[x[outside] >= self.n]
        return x.astype(np.int64)

    def forward(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def inverse(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, True)


def with_row_numbers(rows: DataFrame, work: Workspace, *order: str) -> DataFrame:
    """The rows and ``row_number``, 0..n-1 in the given order.

    One range shuffle; the sorted rows are stored, so that numbers cannot change
    when a task runs again. Only one count per partition is put in order.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = work.store(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("place", 33)
    counts = stored.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect()
    before, total = {}, 0
    for row in sorted(counts, key=lambda r: r.part):
        before[row.part] = total
        total += row.rows
    starts = rows.sparkSession.createDataFrame(list(before.items()), "part long, before long")
    return (
        stored.withColumn("part", part)
        .join(F.broadcast(starts), "part")
        .withColumn("row_number", F.col("before") + F.col("place").bitwiseAND(F.lit(_LOW_33_BITS)))
        .drop("part", "place", "before")
    )


def shard_rows(
    docs: DataFrame,
    work: Workspace,
    shards: int = 8,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, size, text_crc32, row_number, shard and slot of every row.

    Row numbers follow (id, size, checksum), nulls first, so that a rerun, with
    the rows in any order, gives every row the same place; rows equal in all
    three are interchangeable. A null text is empty. Shards differ by one row at
    most, and slots are gapless. An empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    numbered = with_row_numbers(rows, work, "id", "size", "text_crc32")
    total = numbered.count()
    return numbered.withColumn("p", _place(total, seed)(F.col("row_number"))).select(
        "id",
        "size",
        "text_crc32",
        "row_number",
        (F.col("p") % shards).cast("int").alias("shard"),
        F.floor(F.col("p") / shards).alias("slot"),
    )


def _place(total: int, seed: int):
    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        permutation = Permutation(total, seed)
        for numbers in batches:
            yield pd.Series(permutation.forward(numbers.to_numpy()))

    return place


def row_number_at(shard: Column, slot: Column, total: int, shards: int = 8, seed: int = SEED) -> Column:
    """Which row number lies at a slot of a shard: the reader's way back."""

    @F.pandas_udf("long")
    def number(places: pd.Series) -> pd.Series:
        return pd.Series(Permutation(total, seed).inverse(places.to_numpy()))

    return number(slot * shards + shard)
