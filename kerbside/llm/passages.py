"""Passages that recur across a corpus: who shares which windows.

A window is a fixed number of units (bytes or words). Its anchor is the k-gram
in it with the smallest hash, leftmost among equals, so equal windows have equal
anchors at equal places. Runs of windows with one anchor form a piece: the units
those windows span. Everything about a window is settled among the pieces of its
anchor:

1. Documents are written as blocks of bounded size.
2. Blocks send the hashes of their anchors, each once, to buckets, which return
   those that recur. A hash that only seems to recur does no harm.
3. Blocks cut the pieces of recurring anchors, fold equal ones, and send them to
   shards by anchor. A piece that every document holds is one row per block.
4. A shard finds equal windows among its pieces by the operator's own method and
   returns to each block the owner of every window: the smallest document id.
5. Blocks apply the owners to their documents.

Only anchors, pieces and owners are shuffled by content. The number of buckets
and shards follows the input, so their sizes do not, but for shards of bytes:
where they are many, they are up to twice as large.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import text_or_empty
from kerbside.llm.tokens import slices
from kerbside.llm.wordhash import mix, windows_of, word_hashes
from kerbside.session import Workspace

BLOCK_CHARS = 2_000_000
BUCKET_ANCHORS = 1 << 20
SHARD_BYTES = 6 << 20
# Shards there are before they become larger than that.
MANY_SHARDS = 64
# Units whose windows are looked at together, so that what they need stays in a processor's cache, and bytes moved at once.
STEP, GATHERED = 1 << 14, 1 << 20
_PLACE = np.uint64(0xFFFF)
_PLACES = np.arange(1 << 16, dtype=np.uint64)
# Null ids count as smaller than all others.
NULL_ID = -(2**63)

BLOCK_SCHEMA = "block long, ids binary, lengths binary, bytes long, data binary"
PIECE_SCHEMA = "block long, shard long, payload binary"


@dataclass(frozen=True)
class Pieces:
    """Runs of windows with one anchor, in order; places count units over all texts of a block, ``within`` in its own."""

    start: np.ndarray
    within: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    key: np.ndarray
    text: np.ndarray

    def only(self, chosen: np.ndarray) -> Pieces:
        return Pieces(*[getattr(self, f)[chosen] for f in ("start", "within", "windows", "anchor", "key", "text")])


@dataclass(frozen=True)
class Kind:
    """What a unit is, how long windows and their anchors are, and what counts as recurring.

    ``cut`` gives (anchor hashes of a range of units, units per text); ``contents`` the
    bytes of pieces. ``across`` asks for two documents, else two places suffice.
    ``per_byte`` is about how many anchors a byte of text gives. ``grown`` is how many
    times as large blocks are, and shards may become: each block has a row for each
    shard and bucket, so these rows grow with the square of the text.
    """

    window: int
    anchor: int
    across: bool
    per_byte: float
    cut: Callable[[list[bytes]], tuple[Callable[[int, int], np.ndarray], np.ndarray]]
    contents: Callable[[list[bytes], np.ndarray, np.ndarray], pa.Array]
    grown: int = 1

    def pieces(self, texts: list[bytes]) -> Pieces:
        hashes, per_text = self.cut(texts)
        choices = self.window - self.anchor + 1
        ends = np.cumsum(per_text)
        begins = ends - per_text
        last = (int(ends[-1]) if len(ends) else 0) - self.window + 1
        if last <= 0:
            none = np.zeros(0, dtype=np.int64)
            return Pieces(none, none, none, none, none.astype(np.uint64), none.astype(np.int32))
        found, before = [], -1
        for begin in range(0, last, STEP):
            end = min(begin + STEP, last)
            own = hashes(begin, end + choices - 1)
            # The smallest hash and, in its lowest bits, its place: the leftmost one among equals.
            least, span = own & ~_PLACE | _PLACES[: len(own)], 1
            while span < choices:
                step = min(span, choices - span)
                least = np.minimum(least[:-step], least[step:])
                span += step
            least &= _PLACE
            new = np.empty(end - begin, dtype=bool)
            np.not_equal(least[1:], least[:-1], out=new[1:])
            new[0] = begin + int(least[0]) != before
            new[begins[slice(*np.searchsorted(begins, [begin, end]))] - begin] = True
            first = np.flatnonzero(new)
            place = least[first].astype(np.int64)
            found.append((first + begin, place + begin, own[place]))
            before = begin + int(least[-1])
        start, place, key = (np.concatenate(x) for x in zip(*found, strict=True))
        of_text = np.diff(np.searchsorted(start, begins), append=len(start))
        text = np.repeat(np.arange(len(per_text), dtype=np.int32), of_text)
        # Windows that would pass the end of their text are none.
        windows = np.minimum(np.append(start[1:], last), ends[text] - self.window + 1) - start
        pieces = Pieces(start, start - begins[text], windows, place - start, key, text)
        return pieces.only(np.flatnonzero(windows > 0))


def in_order(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(whole numbers below 2 ** ``bits`` in ascending order, their places); equal ones stay in order.

    Sorting numbers that end in their place takes a third of the time of finding the order.
    """
    own = len(values).bit_length()
    if bits + own > 64:
        order = np.argsort(values, kind="stable")
        return values[order], order
    both = (values.astype(np.uint64) << np.uint64(own)) | np.arange(len(values), dtype=np.uint64)
    both.sort()
    return both >> np.uint64(own), (both & np.uint64((1 << own) - 1)).astype(np.int64)


def changes(ordered: np.ndarray) -> np.ndarray:
    """Whether a value is another than the one before it; the first one is."""
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return new


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def binary_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The bytes of every run as an Arrow array."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    # A place takes eight bytes, so not all are held at once.
    parts = np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(offsets[1:] // GATHERED)) + 1)
    gathered = np.concatenate([data[ragged(starts[p], lengths[p])] for p in parts])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(gathered)])


# Bytes

_BYTE_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _cut_bytes(texts: list[bytes]) -> tuple[Callable[[int, int], np.ndarray], np.ndarray]:
    joined = b"".join([*texts, bytes(64)])
    eight = np.ndarray((len(joined) - 7,), dtype="<u8", buffer=joined, strides=(1,))
    of_eight, of_pair, of_all = _BYTE_FACTORS

    def hashes(begin: int, end: int) -> np.ndarray:
        words = eight[begin : end + 24].astype(np.uint64)
        pairs = words[:-8] * of_eight
        pairs += words[8:]
        all_four = pairs[:-16] * of_pair
        all_four += pairs[16:]
        all_four ^= all_four >> np.uint64(32)
        all_four *= of_all
        all_four ^= all_four >> np.uint64(32)
        return all_four

    return hashes, np.array([len(t) for t in texts], dtype=np.int64)


def _byte_contents(texts: list[bytes], starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return binary_runs(np.frombuffer(b"".join(texts), dtype=np.uint8), starts, lengths)


BYTES = Kind(50, 32, True, 0.1, _cut_bytes, _byte_contents, grown=2)

# Words

WORD_ANCHOR = 8


def _cut_words(texts: list[bytes]) -> tuple[Callable[[int, int], np.ndarray], np.ndarray]:
    words, per_text = word_hashes(texts)
    runs, places, _ = windows_of(words, per_text, WORD_ANCHOR)
    hashes = np.full(len(words), 2**64 - 1, dtype=np.uint64)
    hashes[places] = runs
    return lambda begin, end: hashes[begin:end], per_text


def _word_contents(texts: list[bytes], starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    words = [w for t in texts for w in t.split()]
    joined = np.frombuffer(b" ".join([*words, b""]), dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words])
    begins = np.concatenate([[0], ends])[starts]
    return binary_runs(joined, begins, ends[starts + lengths - 1] - 1 - begins)


WORDS = Kind(20, WORD_ANCHOR, False, 0.025, _cut_words, _word_contents)


# Blocks


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def store_blocks(docs: DataFrame, work: Workspace, kind: Kind, id_col: str, text_col: str) -> DataFrame:
    """Blocks of whole documents: ids, byte lengths, and compressed bytes."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, compressor = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for batch in slices(whole, "text", kind.grown * BLOCK_CHARS):
                ids = batch.column("id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                texts = [t.encode() for t in batch.column("text").to_pylist()]
                lengths = np.array([len(t) for t in texts], dtype=np.int64)
                row = [block, packed(ids), packed(lengths), int(lengths.sum()), compressor.compress(b"".join(texts))]
                yield pa.RecordBatch.from_pylist([dict(zip(("block", "ids", "lengths", "bytes", "data"), row, strict=True))])
                block += 1

    return work.store(rows.mapInArrow(write, BLOCK_SCHEMA), "blocks")


def read_block(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """(ids, texts) of the one block in a table."""
    ids = np.frombuffer(table.column("ids")[0].as_py(), dtype=np.int64)
    lengths = np.frombuffer(table.column("lengths")[0].as_py(), dtype=np.int64)
    data = zstandard.ZstdDecompressor().decompress(table.column("data")[0].as_py())
    ends = np.cumsum(lengths)
    return ids, [data[e - n : e] for n, e in zip(lengths.tolist(), ends.tolist(), strict=True)]


def _one_block(batch: pa.RecordBatch, i: int) -> pa.Table:
    return pa.Table.from_batches([batch.slice(i, 1)])


def recurring_anchors(blocks: DataFrame, work: Workspace, kind: Kind) -> DataFrame:
    """block, bucket and the low halves of the block's anchor hashes that recur."""
    buckets = np.uint64(_parts(blocks, kind.per_byte / BUCKET_ANCHORS))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, texts = read_block(_one_block(batch, i))
                pieces = kind.pieces(texts)
                own, order = in_order(_owns(pieces.key, buckets), 32 + int(buckets).bit_length())
                text = pieces.text[order]
                first = np.flatnonzero(changes(own))
                last = np.append(first[1:], len(own)) - 1
                several = text[last] != text[first] if kind.across else last > first
                own = own[first]
                bucket = (own >> np.uint64(32)).astype(np.int64)
                edges = np.flatnonzero(changes(bucket))
                rows = [
                    {"bucket": int(bucket[a]), "block": batch.column("block")[i].as_py(),
                     "hashes": packed(low_half(own[a:b])), "several": packed(several[a:b])}
                    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(own)], strict=True)
                ] if len(own) else []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, SEND)

    def recur(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(h.as_py(), dtype=np.uint32) for h in table.column("hashes")]
        several = np.concatenate([np.frombuffer(s.as_py(), dtype=bool) for s in table.column("several")])
        hashes = np.concatenate(parts)
        ordered, order = in_order(hashes, 32)
        first = np.flatnonzero(changes(ordered))
        times = np.diff(first, append=len(order))
        again = np.empty(len(order), dtype=bool)
        again[order] = np.repeat((times > 1) | np.logical_or.reduceat(several[order], first), times)
        bucket = table.column("bucket")[0].as_py()
        rows, at = [], 0
        for block, part in zip(table.column("block").to_pylist(), parts, strict=True):
            own = part[again[at : at + len(part)]]
            at += len(part)
            if len(own):
                rows.append({"block": block, "bucket": bucket, "hashes": packed(own)})
        return pa.Table.from_pylist(rows, RETURN)

    SEND = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("several", pa.binary())])
    RETURN = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("hashes", pa.binary())])
    sent = blocks.mapInArrow(send, "bucket long, block long, hashes binary, several binary")
    return work.store(sent.groupBy("bucket").applyInArrow(recur, "block long, bucket long, hashes binary"), "anchors")


def _parts(blocks: DataFrame, per_byte: float) -> int:
    """How many buckets or shards the text needs, from its bytes alone."""
    return max(1, math.ceil((blocks.agg(F.sum("bytes")).first()[0] or 0) * per_byte))


def _owns(key: np.ndarray, buckets: np.uint64) -> np.ndarray:
    """Each hash's bucket and, in the lower 32 bits, what stands for it there."""
    return ((key >> np.uint64(32)) % buckets) << np.uint64(32) | (key & np.uint64(0xFFFFFFFF))


def low_half(key: np.ndarray) -> np.ndarray:
    return key.astype(np.uint32)


_COLUMNS = ("slot", "anchor", "size", "least", "spread")


def _planes(values: np.ndarray) -> np.ndarray:
    """Steps from value to value, byte by byte: first all lowest bytes, then the next ones, which are mostly alike."""
    return np.diff(values.astype(np.int64), prepend=0).view(np.uint8).reshape(-1, 8).T


def _from_planes(data: bytes, n: int, offset: int) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8, count=8 * n, offset=offset).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def packed_columns(columns: Sequence[np.ndarray], content: np.ndarray | None = None) -> bytes:
    """Columns of whole numbers, as many of each, and bytes after them."""
    head = np.array([len(columns[0])], dtype=np.int64)
    parts = [head, *map(_planes, columns), *([] if content is None else [content])]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(packed(p) for p in parts))


def unpacked_columns(payload: bytes, count: int) -> tuple[list[np.ndarray], bytes]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    return [_from_planes(data, n, 8 + 8 * n * i) for i in range(count)], data[8 + 8 * n * count :]


def cut_pieces(blocks: DataFrame, anchors: DataFrame, work: Workspace, kind: Kind) -> DataFrame:
    """The folded pieces of each block, packed by shard, and in shard -1 where the block holds them.

    That row's payload is (slot, text, first window in the text, windows) of every
    place. Pieces are about as many bytes as the text at most where a sixth of its
    windows recur, so shards follow the bytes of the text. A piece's anchor is part of
    its content, so its hash stays behind.
    """
    buckets = np.uint64(_parts(blocks, kind.per_byte / BUCKET_ANCHORS))
    shards = _parts(blocks, 1 / SHARD_BYTES)
    shards = np.uint64(max(min(shards, MANY_SHARDS), math.ceil(shards / kind.grown)))
    schema = pa.schema([("block", pa.int64()), ("shard", pa.int64()), ("payload", pa.binary())])

    def cut(block: pa.Table, found: pa.Table) -> pa.Table:
        if not block.num_rows or not found.num_rows:
            return schema.empty_table()
        ids, texts = read_block(block)
        pieces = kind.pieces(texts)
        both = sorted(zip(found.column("bucket").to_pylist(), found.column("hashes").to_pylist(), strict=True))
        # A block's hashes ascend within a bucket, as it sent them.
        again = np.concatenate([(np.uint64(b) << np.uint64(32)) | np.frombuffer(h, dtype=np.uint32) for b, h in both])
        own, order = in_order(_owns(pieces.key, buckets), 32 + int(buckets).bit_length())
        at = np.minimum(np.searchsorted(again, own), len(again) - 1)
        pieces = pieces.only(np.sort(order[again[at] == own]))
        contents = kind.contents(texts, pieces.start, pieces.windows + kind.window - 1).dictionary_encode()
        slot = contents.indices.to_numpy(zero_copy_only=False)
        ordered, order = in_order(slot, 32)
        first = np.flatnonzero(changes(ordered))
        of_doc = ids[pieces.text][order]
        lead = order[first]
        size, least = pc.binary_length(contents.dictionary).to_numpy(), np.minimum.reduceat(of_doc, first)
        # The difference may pass 2^63 where a null id is the smallest; it comes back the same.
        columns = [np.arange(len(first)), pieces.anchor[lead], size, least, np.maximum.reduceat(of_doc, first) - least]
        shard = (mix(pieces.key[lead]) % shards).astype(np.int64)
        ordered, by_shard = in_order(shard, int(shards).bit_length())
        edges = np.flatnonzero(changes(ordered))
        data, offsets = flat(contents.dictionary.take(pa.array(by_shard)))
        columns = [values[by_shard] for values in columns]
        places = [slot, pieces.text, pieces.within, pieces.windows]
        number = block.column("block")[0].as_py()
        rows = [{"block": number, "shard": -1, "payload": packed_columns(places)}]
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(by_shard)], strict=True):
            payload = packed_columns([values[a:b] for values in columns], data[offsets[a] : offsets[b]])
            rows.append({"block": number, "shard": int(ordered[a]), "payload": payload})
        return pa.Table.from_pylist(rows, schema)

    cogrouped = blocks.groupBy("block").cogroup(anchors.groupBy("block"))
    return work.store(cogrouped.applyInArrow(cut, PIECE_SCHEMA), "pieces")


def flat(content: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, where each starts and the end)."""
    offsets = np.frombuffer(content.buffers()[1], dtype=np.int32)[content.offset : content.offset + len(content) + 1]
    return np.frombuffer(content.buffers()[2], dtype=np.uint8), offsets.astype(np.int64)


@dataclass(frozen=True)
class Variants:
    """The different pieces of a shard, where their anchors are in them, and the smallest id that holds each."""

    anchor: np.ndarray
    content: pa.Array
    owner: np.ndarray


def owners(pieces: DataFrame, work: Workspace, settle: Callable[[Variants], tuple[np.ndarray, np.ndarray]], keep_own: bool) -> DataFrame:
    """block and the owners of windows in its pieces, from ``settle`` on each shard.

    ``settle`` gives windows per variant and the owner of every window; windows
    that do not recur have their variant's owner. The result lists (slot, first window, window after the last, owner) of runs
    whose owner is smaller than an id of the block that holds the piece, or, with
    ``keep_own``, not larger.
    """
    schema = pa.schema([("block", pa.int64()), ("runs", pa.binary())])

    def shard(table: pa.Table) -> pa.Table:
        unpacked = [unpacked_columns(p.as_py(), len(_COLUMNS)) for p in table.column("payload")]
        held = {name: np.concatenate([columns[i] for columns, _ in unpacked]) for i, name in enumerate(_COLUMNS)}
        held["most"] = held["least"] + held["spread"]
        blocks_of = np.repeat(table.column("block").to_numpy(), [len(columns[0]) for columns, _ in unpacked])
        offsets = np.concatenate([[0], np.cumsum(held["size"])]).astype(np.int32)
        content = pa.py_buffer(b"".join(data for _, data in unpacked))
        del unpacked
        coded = pa.Array.from_buffers(pa.binary(), len(held["slot"]), [None, pa.py_buffer(offsets), content]).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        ordered, order = in_order(code, 32)
        first = np.flatnonzero(changes(ordered))
        lead = order[first]
        owner = np.minimum.reduceat(held["least"][order], first)
        variants = Variants(held["anchor"][lead], coded.dictionary, owner)
        windows, owner = settle(variants)
        starts = np.cumsum(windows) - windows
        new = changes(owner)
        new[starts] = True
        run = np.flatnonzero(new)
        runs_of = np.diff(np.searchsorted(run, starts), append=len(run))
        run_variant = np.repeat(np.arange(len(windows)), runs_of)
        run_end = np.append(run[1:], len(owner)) - starts[run_variant]
        run_from, run_owner = run - starts[run_variant], owner[run]
        run_start = np.cumsum(runs_of) - runs_of
        row = np.repeat(np.arange(len(code)), runs_of[code])
        at = ragged(run_start[code], runs_of[code])
        most = held["most"][row]
        wanted = (run_owner[at] <= most) if keep_own else (run_owner[at] < most)
        row, at = row[wanted], at[wanted]
        block, slot = blocks_of[row], held["slot"][row]
        by_block = np.argsort(block, kind="stable")
        columns = np.stack([slot, run_from[at], run_end[at], run_owner[at]])[:, by_block]
        edges = np.flatnonzero(np.diff(block[by_block])) + 1 if len(by_block) else []
        numbers = block[by_block]
        parts = np.split(np.arange(len(numbers)), edges)
        rows = [{"block": int(numbers[p[0]]), "runs": packed_columns(columns[:, p])} for p in parts if len(p)]
        return pa.Table.from_pylist(rows, schema)

    return work.store(pieces.filter("shard >= 0").groupBy("shard").applyInArrow(shard, "block long, runs binary"), "owners")


def apply_owners(
    blocks: DataFrame,
    pieces: DataFrame,
    owned: DataFrame,
    finish: Callable[[np.ndarray, list[bytes], tuple[np.ndarray, ...]], pa.Table],
    schema: str,
) -> DataFrame:
    """``finish(ids, texts, found)`` over every block.

    ``found`` holds, for runs of windows in documents: text, first window, window
    after the last, owner.
    """

    def apply(block: pa.Table, told: pa.Table) -> pa.Table:
        ids, texts = read_block(block)
        nothing = np.zeros(0, dtype=np.int64)
        places, runs = np.zeros((4, 0), dtype=np.int64), [np.zeros((4, 0), dtype=np.int64)]
        for content, run in zip(told.column("places"), told.column("runs"), strict=True):
            if content.is_valid:
                places = np.stack(unpacked_columns(content.as_py(), 4)[0])
            if run.is_valid:
                runs.append(np.stack(unpacked_columns(run.as_py(), 4)[0]))
        if not places.shape[1]:
            return finish(ids, texts, (nothing,) * 4)
        slot, run_from, run_end, owner = np.concatenate(runs, axis=1)
        order = np.argsort(slot, kind="stable")
        slot, run_from, run_end, owner = (x[order] for x in (slot, run_from, run_end, owner))
        low, high = np.searchsorted(slot, places[0], "left"), np.searchsorted(slot, places[0], "right")
        at, place = ragged(low, high - low), np.repeat(np.arange(places.shape[1]), high - low)
        first = places[2][place]
        return finish(ids, texts, (places[1][place], first + run_from[at], first + run_end[at], owner[at]))

    told = pieces.filter("shard = -1").select("block", F.col("payload").alias("places"), F.lit(None).cast("binary").alias("runs"))
    told = told.unionByName(owned.select("block", F.lit(None).cast("binary").alias("places"), "runs"))
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(apply, schema)
