"""Best-fit packing of token pieces into sequences by the sum-of-squares rule.

A piece goes to the open sequence, or to a new one, for which the sum over gaps
g of (number of open sequences with gap g) squared becomes smallest. Only the
counts per gap decide, so a step costs the same whatever is open. Shards of
bounded size pack side by side, longest pieces first, which leaves fewer
sequences open than a random order; pieces of those are dealt again, to ever
fewer shards, and go into the best fit, until few are open.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import text_or_empty
from kerbside.llm.tokens import END_ID, encoder, slices
from kerbside.session import Workspace

CAPACITY = 1024
# Pieces that one task packs.
SHARD_PIECES = 40_000

PIECES_SCHEMA = "id long, piece int, start long, length long, ids_crc32 long, ids binary"


def cut(n_ids: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only longer ones are cut, and only the first piece is shorter."""
    first = n_ids % capacity or min(n_ids, capacity)
    edges = [0, *range(first, n_ids + 1, capacity)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    literal: bool = True,
) -> DataFrame:
    """id, piece, start, length, ids_crc32 and, if asked for, the ids (uint32, little-endian) of every piece.

    A null or empty text is one piece that holds the end id. Repeated rows have
    pieces of their own. ``literal`` is that of ``TextEncoder``.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        encode_texts = encoder(tokenizer_path, literal)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, counts = encode_texts.encode_batch(batch.column("text").to_pylist())
                found = []
                ends = np.cumsum(counts)
                for doc_id, n, end in zip(batch.column("id").to_pylist(), counts, ends, strict=True):
                    own = np.append(ids[end - n : end], np.uint32(END_ID)).astype("<u4")
                    for piece, (start, length) in enumerate(cut(len(own), capacity)):
                        data = own[start : start + length].tobytes()
                        found.append((doc_id, piece, start, length, zlib.crc32(data), data if keep_ids else None))
                columns = list(zip(*found, strict=True))
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    arrays, ["id", "piece", "start", "length", "ids_crc32", "ids"]
                )

    return rows.mapInArrow(encode, PIECES_SCHEMA)


class Packer:
    """Sequences of one shard, placed one piece at a time."""

    def __init__(self, capacity: int = CAPACITY) -> None:
        self.capacity = capacity
        self.open_count = np.zeros(capacity + 1, dtype=np.int64)
        self.open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.sequences = 0

    def place_by_squares(self, length: int) -> tuple[int, int]:
        """(sequence, offset) by the sum-of-squares rule; ties go to the tightest open sequence."""
        counts = self.open_count[length:]
        # Moving a sequence from gap g to gap g - length changes the sum by this much.
        change = 2 * (self.open_count[: self.capacity + 1 - length] - counts + 1)
        change[0] = 1 - 2 * counts[0]
        change[counts == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        anew = 2 * self.open_count[self.capacity - length] + 1 if length < self.capacity else 0
        return self._put(length, length + best if change[best] <= anew else None)

    def place_in_best_fit(self, length: int) -> tuple[int, int]:
        fitting = np.flatnonzero(self.open_count[length:])
        return self._put(length, length + int(fitting[0]) if len(fitting) else None)

    def _put(self, length: int, gap: int | None) -> tuple[int, int]:
        if gap is None:
            gap, sequence = self.capacity, self.sequences
            self.sequences += 1
        else:
            sequence = self.open_by_gap[gap].pop()
            self.open_count[gap] -= 1
        left = gap - length
        if left:
            self.open_count[left] += 1
            self.open_by_gap[left].append(sequence)
        return sequence, self.capacity - gap

    def open_sequences(self) -> list[int]:
        return [sequence for gap in self.open_by_gap for sequence in gap]


def pack_lengths(lengths: Sequence[int], capacity: int = CAPACITY, by_squares: bool = True):
    """(sequence, offset, whether the sequence stayed open) per piece, in the given order."""
    packer = Packer(capacity)
    place = packer.place_by_squares if by_squares else packer.place_in_best_fit
    placed = np.array([place(int(n)) for n in lengths], dtype=np.int64).reshape(-1, 2)
    stayed_open = np.zeros(packer.sequences, dtype=bool)
    stayed_open[packer.open_sequences()] = True
    return placed[:, 0], placed[:, 1], stayed_open[placed[:, 0]]


def _packed_shards(pieces: DataFrame, capacity: int, level: int) -> DataFrame:
    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "order"], ascending=[False, True])
        sequence, offset, stayed_open = pack_lengths(shard["length"].to_numpy(), capacity, by_squares=level == 0)
        # Fixed layout: level, shard and number within the shard.
        base = (level << 58) + (int(shard["shard"].iloc[0]) << 30)
        return pd.DataFrame(
            {"row": shard["row"], "sequence_id": base + sequence, "offset": offset, "stayed_open": stayed_open}
        )

    return pieces.groupBy("shard").applyInPandas(
        pack, "row long, sequence_id long, offset long, stayed_open boolean"
    )


def pack(
    pieces: DataFrame, work: Workspace, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """The pieces with the sequence that holds them and their offset in it, gapless from 0.

    ``pieces`` needs a ``length`` from 1 to ``capacity``; other columns travel
    along. Each level packs in shards of about ``shard_pieces`` and hands on
    what lies in open sequences; the last level is one shard or no smaller than
    the one before. Shards are dealt by a hash of the stored row's number, so
    equal rows spread too.
    """
    stored = work.store(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    todo, done, level, before = stored.select("row", "length"), None, 0, None
    count = todo.count()
    while count:
        shards = max(1, -(-count // shard_pieces))
        order = F.xxhash64(F.lit(level), "row")
        dealt = todo.select("row", "length", order.alias("order"), F.pmod(order, F.lit(shards)).alias("shard"))
        placed = work.store(_packed_shards(dealt, capacity, level), f"placed-{level}")
        last = shards == 1 and level > 0 or before is not None and count > before // 2
        final = placed if last else placed.filter("NOT stayed_open")
        final = final.select("row", "sequence_id", "offset")
        done = final if done is None else done.unionByName(final)
        if last:
            break
        left = placed.filter("stayed_open").select("row")
        todo, before, level = work.store(stored.select("row", "length").join(left, "row"), "left"), count, level + 1
        count = todo.count()
    if done is None:
        return stored.drop("row").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    return stored.join(done, "row").drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and the ids (uint32, little-endian) of every sequence; a group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id",
        "n_tokens",
        F.aggregate("parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"])).alias("ids"),
    )
