"""Byte passages that occur in an earlier document, found with suffix arrays.

The suffix arrays of a shard's pieces are built by Lyndon grouping. Suffixes are
grouped by their longest Lyndon prefix, which ends at the next smaller suffix:
starting from groups by first symbol, all groups are refined at once by the next
symbol of their members' Lyndon prefixes. A suffix is its Lyndon prefix followed
by its next smaller suffix, so the order inside the groups follows from the
groups that a suffix's next smaller suffixes are in, twice as many of them every
time. A step is a sort of whole columns: no suffix is handled by itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kerbside.llm import passages
from kerbside.llm.passages import BYTES, NULL_ID, Variants, changes, in_order
from kerbside.session import Workspace

# Symbols of one suffix array, whose columns a step sorts; bounds a worker's memory, not what it compares.
ARRAY_SYMBOLS = 200_000


def next_smaller(strings: np.ndarray) -> np.ndarray:
    """The next smaller suffix of every position, for strings in rows, filled up with 0.

    Positions are inside the string; the end of the string, the empty suffix, is
    smaller than all. All strings are compared at once, diagonal by diagonal.
    """
    by_place = np.ascontiguousarray(strings.T)
    places, count = by_place.shape
    after = np.full((places, count), places, dtype=np.int16)
    for distance in range(1, places):
        less = np.zeros(count, dtype=bool)
        for i in range(places - distance - 1, -1, -1):
            j = i + distance
            less = (by_place[i] < by_place[j]) | ((by_place[i] == by_place[j]) & less)
            row = after[i]
            row[~less & (row == places)] = j
    return after.T


def split(group: np.ndarray, members: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Split the groups of some suffixes by a value of each, in place, and say which members are alone in theirs.

    A group is the place of its first suffix in the order of all, so suffixes of
    other groups keep theirs; parts ascend with the value. Of a group all suffixes
    are members, or none is.
    """
    bits = np.uint64(int(value.max()).bit_length())
    key = (group[members].astype(np.uint64) << bits) | value.astype(np.uint64)
    key, order = in_order(key, int(bits) + len(group).bit_length())
    first = np.flatnonzero(changes(key))
    sizes = np.diff(first, append=len(key))
    old = (key[first] >> bits).astype(np.int64)
    of_old = np.flatnonzero(changes(old))
    new = old + first - np.repeat(first[of_old], np.diff(of_old, append=len(old)))
    group[members[order]] = np.repeat(new, sizes)
    alone = np.empty(len(members), dtype=bool)
    alone[order] = np.repeat(sizes == 1, sizes)
    return alone


def lyndon_groups(symbols: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """The group of every suffix by its longest Lyndon prefix, groups ascending; ``prefix`` is that prefix's length.

    Groups by first symbol are split by the further symbols of their members'
    prefixes, all groups at once; a prefix that ends comes before its extensions.
    """
    group = np.zeros(len(symbols), dtype=np.int64)
    members, known = np.arange(len(symbols)), 0
    while len(members):
        goes_on = prefix[members] > known + 1
        alone = split(group, members, 2 * symbols[members + known].astype(np.int64) + goes_on)
        members, known = members[goes_on & ~alone], known + 1
    return group


def suffix_order(group: np.ndarray, following: np.ndarray) -> np.ndarray:
    """All suffixes in ascending order, from their groups and next smaller suffixes.

    ``following`` is the number of suffixes where the empty suffix, which comes
    first, is the next smaller one. Groups know one Lyndon prefix of a suffix; split
    by those of the suffix that follows what is known, they know twice as many.
    """
    group, count = group.copy(), len(group)
    following = np.append(following, count)
    members = np.arange(count)
    while len(members):
        then = following[members]
        alone = split(group, members, np.append(group + 1, 0)[then])
        members = members[(then < count) & ~alone]
        following = following[following]
    return in_order(group, count.bit_length())[1]


def suffix_array(strings: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all strings, where each string starts, suffixes in ascending order).

    ``strings`` holds positive symbols in rows filled up with 0. A string's end is
    smaller than any symbol; equal suffixes are next to each other.
    """
    place = np.arange(strings.shape[1])
    inside = place < lengths[:, None]
    after = np.minimum(next_smaller(strings), lengths[:, None])
    starts = np.cumsum(lengths) - lengths
    symbols = strings[inside]
    following = np.where(after < lengths[:, None], after + starts[:, None], len(symbols))[inside]
    groups = lyndon_groups(symbols, (after - place)[inside])
    return symbols, starts, suffix_order(groups, following)


def settle(variants: Variants) -> tuple[np.ndarray, np.ndarray]:
    """(windows per variant, owner of every window) by the suffix arrays of the variants that share an anchor.

    An anchor's bytes are one symbol of their own, as every window of a piece
    holds all of them; the bytes before and after are a symbol each. One suffix
    array holds the variants of so many anchors that they have ``ARRAY_SYMBOLS``
    symbols, or those of one anchor with more.
    """
    data, offsets = passages.flat(variants.content)
    begins, sizes = offsets[:-1], np.diff(offsets)
    windows = sizes - BYTES.window + 1
    owner = np.repeat(variants.owner, windows)
    anchors = passages.binary_runs(data, begins + variants.anchor, np.full(len(begins), BYTES.anchor)).dictionary_encode()
    anchor = anchors.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    several = np.flatnonzero(np.bincount(anchor)[anchor] > 1)
    if not len(several):
        return windows, owner
    several = several[in_order(anchor[several], 32)[1]]
    lengths = sizes - BYTES.anchor + 1
    new = changes(anchor[several])
    before = np.cumsum(lengths[several]) - lengths[several]
    array = before[np.maximum.accumulate(np.where(new, np.arange(len(several)), 0))] // ARRAY_SYMBOLS
    window_start = np.cumsum(windows) - windows
    for chosen in np.split(several, np.flatnonzero(np.diff(array)) + 1):
        length = lengths[chosen]
        place = np.arange(length.max())
        at = variants.anchor[chosen][:, None]
        source = begins[chosen][:, None] + place + np.where(place > at, BYTES.anchor - 1, 0)
        symbols = data[np.minimum(source, len(data) - 1)].astype(np.int32) + 1
        symbols = np.where(place == at, 257 + (anchor[chosen] - anchor[chosen[0]])[:, None], symbols)
        strings = np.where(place < length[:, None], symbols, 0).astype(np.int32)
        flat, starts, order = suffix_array(strings, length)
        string = np.repeat(np.arange(len(chosen)), length)
        within = np.arange(len(flat)) - starts[string]
        order = order[(within < windows[chosen][string])[order]]
        same = np.ones(len(order) - 1, dtype=bool)
        for j in range(BYTES.window - BYTES.anchor + 1):
            ahead = flat[j:][order]
            same &= ahead[1:] == ahead[:-1]
        first = np.append(0, np.flatnonzero(~same) + 1)
        least = np.minimum.reduceat(variants.owner[chosen][string[order]], first)
        target = window_start[chosen][string[order]] + within[order]
        owner[target] = np.repeat(least, np.diff(np.append(first, len(order))))
    return windows, owner


def spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs that the intervals cover; touching intervals are one run."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
    return list(zip(starts[first].tolist(), ends[np.append(first[1:], len(ends)) - 1].tolist(), strict=True))


def removed_spans(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, the spans to remove, and the bytes that stay.

    A byte goes if a 50-byte string that covers it also starts in a document with
    a smaller id; strings are judged on the input, and matches never cross
    documents. Null and empty texts have no bytes. A null id is smaller than all
    others; documents with the same id do not remove from each other. An empty
    table gives no rows. Texts may be of any length; only the pieces around
    recurring anchors leave their block.
    """
    blocks = passages.store_blocks(docs, work, BYTES, id_col, text_col)
    anchors = passages.recurring_anchors(blocks, work, BYTES)
    pieces = passages.cut_pieces(blocks, anchors, work, BYTES)
    work.drop(anchors)
    owned = passages.owners(pieces, work, settle, keep_own=False)

    def finish(ids: np.ndarray, texts: list[bytes], found: tuple[np.ndarray, ...]) -> pa.Table:
        text, first, end, owner = found
        earlier = owner < ids[text]
        text, first, end = text[earlier], first[earlier], end[earlier] - 1 + BYTES.window
        order = np.argsort(text, kind="stable")
        low, high = (np.searchsorted(text[order], np.arange(len(texts)), side) for side in ("left", "right"))
        rows = []
        for i, (doc_id, data) in enumerate(zip(ids.tolist(), texts, strict=True)):
            own = order[low[i] : high[i]]
            gone = spans(first[own], end[own]) if len(own) else []
            edges = [0, *[x for span in gone for x in span], len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append(
                {"id": None if doc_id == NULL_ID else doc_id, "n_bytes": len(data), "spans": gone and [list(s) for s in gone],
                 "kept": kept, "kept_sha256": hashlib.sha256(kept).hexdigest()}
            )
        return pa.Table.from_pylist(rows, KEPT)

    KEPT = pa.schema(
        [("id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary()),
         ("kept_sha256", pa.string())]
    )
    schema = "id long, n_bytes long, spans array<array<long>>, kept binary, kept_sha256 string"
    return passages.apply_owners(blocks, pieces, owned, finish, schema)
