"""Near-duplicate classes by Order MinHash.

A sketch key takes the few occurrence-labelled word 5-grams with the smallest
hashes and joins them in text order, so texts agree on a key when they share
5-grams in the same order: it follows edits, not just sets. Documents that agree
on a key are candidates; a banded alignment of their 5-gram sequences decides.

Similarity is L / (n + m - L), with L the longest common subsequence of n and m
5-grams: the Jaccard similarity of the 5-grams that an alignment can match.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import fresh_name, session_conf, text_or_empty
from kerbside.llm.tokens import slices
from kerbside.llm.wordhash import mix, windows_of, word_hashes
from kerbside.session import Workspace

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Keys per document and 5-grams per key: at similarity 0.8 a pair of long texts misses every key seven times in a
# million, at 0.3 it meets in one with a chance of 7 %. The fewer 5-grams, the more often a pair is missed: 25 and 20
# in 20 of them five times in 100,000, 5 and 4 in 4 always.
KEYS = 30
PER_KEY = 5
# Texts of at most so many 5-grams also meet on their rarest single ones, which misses no pair; a shorter text than
# 0.8 times this meets all that reach 0.8 that way.
SHORT_SHINGLES = 50
# Documents of a key that one task compares: so many unsettled ones with so many others.
TILE_OPEN, TILE_OTHERS = 256, 512
BATCH_CHARS = 2_000_000
NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}

SKETCH_SCHEMA = "row long, id long, digest binary, shingles long, keys array<long>, single array<long>"


def occurrence_labelled(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each shingle and how many equal ones its text has before it; ``counts`` are shingles per text."""
    if not len(hashes):
        return hashes
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, text))
    new = np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    occurrence = np.empty(len(order), dtype=np.uint64)
    occurrence[order] = (np.arange(len(order)) - first).astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(hashes + occurrence * np.uint64(0xA24BAED4963EE407))


def order_min_hashes(hashes: np.ndarray, counts: np.ndarray, keys: int = KEYS, per_key: int = PER_KEY) -> np.ndarray:
    """``keys`` sketch keys for each text with shingles; ``counts`` has no zeros."""
    text = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    labelled = occurrence_labelled(hashes, counts)
    found = np.zeros((len(counts), keys), dtype=np.int64)
    with np.errstate(over="ignore"):
        for k in range(keys):
            drawn = (labelled ^ np.uint64(0xC2B2AE3D27D4EB4F * (k + 1) % 2**64)) * np.uint64(0x9FB21C651E98DF25)
            drawn ^= drawn >> np.uint64(28)
            places = np.full((len(counts), per_key), len(hashes), dtype=np.int64)
            for j in range(per_key):
                least = np.minimum.reduceat(drawn, starts)
                at = np.flatnonzero(drawn == np.repeat(least, counts))
                at = at[(drawn[at] != np.uint64(2**64 - 1))]
                places[text[at], j] = at
                drawn[at] = np.uint64(2**64 - 1)
            places.sort(axis=1)
            joined = np.zeros(len(counts), dtype=np.uint64)
            padded = np.append(hashes, np.uint64(0))
            for j in range(per_key):
                joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + padded[places[:, j]])
            found[:, k] = joined.view(np.int64)
    return found


def sketches(rows: DataFrame) -> DataFrame:
    """row, id, digest of the word sequence, number of 5-grams, sketch keys and single shingles, from row, id and text.

    Texts with fewer than five words have one shingle, all their words; texts
    without words have none and no keys. Single shingles, labelled with their
    occurrence, are listed for short texts only.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_CHARS):
                texts = [t.encode() for t in batch.column("text").to_pylist()]
                hashes, counts = word_hashes(texts)
                shingles, _, per_text = windows_of(hashes, counts, SHINGLE_WORDS)
                some = per_text > 0
                keys = np.zeros((0, KEYS), dtype=np.int64)
                if some.any():
                    keys = order_min_hashes(shingles, per_text[some])
                ends = np.cumsum(some) * KEYS
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(keys.reshape(-1))
                )
                short = per_text <= SHORT_SHINGLES
                labelled = occurrence_labelled(shingles[np.repeat(short, per_text)], per_text[short]).view(np.int64)
                singles = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(per_text * short)]), pa.int32()), pa.array(labelled)
                )
                digests = [hashlib.sha256(b" ".join(t.split())).digest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("id"), pa.array(digests, pa.binary()),
                     pa.array(per_text, pa.int64()), lists, singles],
                    ["row", "id", "digest", "shingles", "keys", "single"],
                )

    return rows.mapInArrow(sketch, SKETCH_SCHEMA)


def common_in_band(a: Sequence, b: Sequence, band: int) -> int:
    """Length of the longest common subsequence whose matches lie within ``band`` of the diagonal.

    Bit-parallel: a zero bit of ``rows`` is a row where the count steps up. The
    window of rows moves with the columns; rows that leave it are counted.
    """
    places = defaultdict(list)
    for i, x in enumerate(a):
        places[x].append(i)
    low, high = 0, min(len(a), band + 1)
    rows, counted = (1 << high) - 1, 0
    for j, x in enumerate(b):
        if j:
            if high < len(a) and j + band + 1 > high:
                rows |= 1 << (high - low)
                high += 1
            if j - band > low and low < high:
                counted += not rows & 1
                rows >>= 1
                low += 1
        match = 0
        for i in places.get(x, ()):
            if low <= i < high:
                match |= 1 << (i - low)
        if match:
            up = rows & match
            rows = ((rows + up) | (rows - up)) & ((1 << (high - low)) - 1)
    return counted + (high - low) - rows.bit_count()


def similar(a: Sequence, b: Sequence, least: float = SIMILARITY) -> bool:
    """Whether the sequences reach the similarity.

    That needs L >= least * (n + m) / (1 + least) matches, hence at most
    n + m - 2 L insertions and deletions: no match lies farther off the diagonal.
    """
    total = len(a) + len(b)
    needed = math.ceil(least * total / (1 + least) - 1e-9)
    if min(len(a), len(b)) < needed:
        return False
    start, limit = 0, min(len(a), len(b))
    while start < limit and a[start] == b[start]:
        start += 1
    end = 0
    while end < limit - start and a[-1 - end] == b[-1 - end]:
        end += 1
    middle_a, middle_b = a[start : len(a) - end], b[start : len(b) - end]
    return start + end + common_in_band(middle_a, middle_b, total - 2 * needed) >= needed


def shingle_list(text: str) -> list:
    words = text.encode().split()
    if len(words) < SHINGLE_WORDS:
        return [tuple(words)] if words else []
    return list(zip(*[words[j:] for j in range(SHINGLE_WORDS)], strict=False))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) pairs with ``linked``; rows of one ``a`` come together so that its text is cut once."""
    both = (
        pairs.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, cut = None, []
        for batch in batches:
            linked = []
            for a, text_a, text_b in zip(*[batch.column(c) for c in ("a", "text_a", "text_b")], strict=True):
                if a.as_py() != last:
                    last, cut = a.as_py(), shingle_list(text_a.as_py())
                linked.append(similar(cut, shingle_list(text_b.as_py())))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked)], ["a", "b", "linked"])

    return both.mapInArrow(align, "a long, b long, linked boolean")


def rare_singles(sketched: DataFrame) -> DataFrame:
    """row, shingles, k and key: short texts' rarest shingles, as many as no similar text can do without.

    A text of n shingles that reaches the similarity shares at least 0.8 n of
    them, so two such texts share one of their first n - ceil(0.8 n) + 1 in any
    order that is the same for all texts. The rarest come first, which keeps
    stock phrases from being keys. Different texts of up to three shingles reach
    the similarity with no other.
    """
    short = sketched.filter(F.col("shingles").between(4, SHORT_SHINGLES))
    singles = short.select("row", "shingles", F.explode("single").alias("key"))
    ranked = singles.join(singles.groupBy("key").agg(F.count("*").alias("times")), "key")
    first = F.col("shingles") - F.ceil(SIMILARITY * F.col("shingles") - 1e-9) + 1
    rarest = F.slice(F.sort_array(F.collect_list(F.struct("times", "key"))), 1, first.cast("int"))
    chosen = ranked.groupBy("row", "shingles").agg(rarest.alias("rarest"))
    return chosen.select("row", "shingles", F.lit(KEYS).alias("k"), F.explode("rarest.key").alias("key"))


def key_members(sketched: DataFrame, work: Workspace) -> DataFrame:
    """k, key, row, shingles, n and leader of every row that shares a key with others.

    A key's leader is the row whose keys are shared most in all: among edited
    copies of a text that is the text itself, which all of them resemble most.
    """
    entries = sketched.select("row", "shingles", F.posexplode("keys").alias("k", "key"))
    entries = entries.unionByName(rare_singles(sketched))
    shared = entries.groupBy("k", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = work.store(entries.join(shared, ["k", "key"]), "met")
    known = met.groupBy("row").agg(F.sum("n").alias("known"))
    leaders = met.join(known, "row").groupBy("k", "key").agg(F.max(F.struct("known", "row"))["row"].alias("leader"))
    return work.store(met.join(leaders, ["k", "key"]), "members")


def links_within_keys(sketched: DataFrame, texts: DataFrame, work: Workspace) -> DataFrame:
    """Links (a, b) that connect what is similar among documents that share a key.

    First each document meets the leader of each of its keys. One that is then
    connected with a key's leader, by whatever links, is settled for that key.
    The few others meet all documents of the key that they are not connected
    with, in tiles of bounded size that hand on a link only where it connects
    what was not connected yet: never a pair per row, and nothing is left out.
    """
    members = key_members(sketched, work)
    candidates = members.select("row").distinct()
    texts = work.store(texts.join(candidates, "row", "left_semi"), "texts", compression="zstd")
    lengths = sketched.select(F.col("row").alias("other"), F.col("shingles").alias("other_shingles"))
    comparable = F.least("shingles", "other_shingles") >= SIMILARITY * F.greatest("shingles", "other_shingles")
    ordered = [F.least("row", "other").alias("a"), F.greatest("row", "other").alias("b")]
    stars = members.filter("row != leader").select("row", "shingles", F.col("leader").alias("other")).distinct()
    pairs = stars.join(lengths, "other").filter(comparable).select(*ordered).distinct()
    links = work.store(verified(pairs, texts), "pairs").filter("linked").select("a", "b")
    rooted = work.store(_with_roots(members, components(links, work)), "rooted")
    tiles = _tiles(rooted, texts)
    found = work.store(tiles.groupBy("k", "key", "part", "other_part").applyInArrow(_forest, "a long, b long"), "found")
    more = work.store(verified(found.distinct(), texts), "pairs").filter("linked").select("a", "b")
    return links.unionByName(more)


def _tiles(rooted: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows of every tile: unsettled documents of a key (open) and all of a fitting length."""
    unsettled = rooted.filter("root != leader_root AND n > 2")
    per_key = unsettled.groupBy("k", "key").agg(
        F.count("*").alias("n_open"), F.min("shingles").alias("shortest"), F.max("shingles").alias("longest")
    )
    near_length = F.col("shingles").between(SIMILARITY * F.col("shortest"), F.col("longest") / SIMILARITY)
    others = rooted.join(per_key, ["k", "key"]).filter(near_length)
    parts = F.ceil(F.col("n_open") / TILE_OPEN).cast("int")
    other_parts = F.ceil(F.col("n") / TILE_OTHERS).cast("int")
    spread = F.xxhash64("row", "key")

    def each(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    columns = ["k", "key", "row", "root", "is_open", "part", "other_part"]
    is_open = F.col("root") != F.col("leader_root")
    own = others.filter(is_open).withColumns(
        {"is_open": F.lit(True), "part": F.pmod(spread, parts).cast("int"), "other_part": each(other_parts)}
    )
    met = others.withColumns(
        {"is_open": F.lit(False), "part": each(parts), "other_part": F.pmod(spread, other_parts).cast("int")}
    )
    rows = own.select(columns).unionByName(met.select(columns))
    return rows.join(_hashed_shingles(texts.join(rows.select("row").distinct(), "row", "left_semi")), "row")


def _hashed_shingles(texts: DataFrame) -> DataFrame:
    """row and its 5-grams in order, as hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_CHARS):
                hashes, counts = word_hashes([t.encode() for t in batch.column("text").to_pylist()])
                shingles, _, per_text = windows_of(hashes, counts, SHINGLE_WORDS)
                parts = np.split(shingles, np.cumsum(per_text)[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([p.tobytes() for p in parts])], ["row", "hashes"])

    return texts.select("row", "text").mapInArrow(cut, "row long, hashes binary")


def _shared_counts(shingles: list[np.ndarray]) -> np.ndarray:
    """How many 5-grams, counted with repeats, every two of the documents share: no alignment matches more."""
    sizes = np.array([len(s) for s in shingles])
    text = np.repeat(np.arange(len(shingles)), sizes)
    labelled = occurrence_labelled(np.concatenate(shingles), sizes)
    _, column, times = np.unique(labelled, return_inverse=True, return_counts=True)
    useful = times > 1
    number = np.cumsum(useful) - 1
    row, column = text[useful[column]], number[column[useful[column]]]
    shared, width = np.zeros((len(shingles), len(shingles)), dtype=np.float32), 2_048
    by_column = np.argsort(column, kind="stable")
    row, column = row[by_column], column[by_column]
    for start in range(0, int(useful.sum()), width):
        low, high = np.searchsorted(column, [start, start + width])
        held = np.zeros((len(shingles), width), dtype=np.float32)
        held[row[low:high], column[low:high] - start] = 1
        shared += held @ held.T
    return shared


def _forest(tile: pa.Table) -> pa.Table:
    """Links of a tile between unsettled and other documents, none that its earlier links make needless."""
    rows, first, at = np.unique(tile.column("row").to_numpy(), return_index=True, return_inverse=True)
    is_open = tile.column("is_open").to_numpy()
    open_rows, other_rows = np.zeros(len(rows), dtype=bool), np.zeros(len(rows), dtype=bool)
    open_rows[at[is_open]] = True
    other_rows[at[~is_open]] = True
    root = tile.column("root").to_numpy()[first]
    shingles = [np.frombuffer(tile.column("hashes")[int(i)].as_py(), dtype=np.uint64) for i in first]
    sizes = np.array([len(s) for s in shingles])
    total = sizes[:, None] + sizes[None, :]
    enough = _shared_counts(shingles) >= SIMILARITY * total / (1 + SIMILARITY) - 1e-3
    wanted = enough & (root[:, None] != root[None, :]) & open_rows[:, None] & other_rows[None, :]
    group, found = {}, []

    def root_of(x: int) -> int:
        while group.get(x, x) != x:
            x = group[x]
        return x

    for i, j in np.argwhere(wanted).tolist():
        a, b = root_of(root[i]), root_of(root[j])
        if a != b and similar(shingles[i].tolist(), shingles[j].tolist()):
            group[a] = b
            found.append((min(rows[i], rows[j]), max(rows[i], rows[j])))
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _with_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with the component of the row and of its key's leader; a row without links is its own."""
    leaders = roots.select(F.col("row").alias("leader"), F.col("root").alias("leader_root"))
    return (
        members.join(roots, "row", "left")
        .join(leaders, "leader", "left")
        .withColumns({"root": F.coalesce("root", "row"), "leader_root": F.coalesce("leader_root", "leader")})
    )


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """row, root: the smallest row that links lead to, for every row with a link.

    Each round takes the smallest label among neighbours, then jumps to that
    label's label; labels are combined before the shuffle, so a row with very
    many links costs one entry a task.
    """
    both = work.store(
        links.select(F.col("a").alias("row"), F.col("b").alias("to"))
        .unionByName(links.select(F.col("b").alias("row"), F.col("a").alias("to")))
        .distinct(),
        "edges",
    )
    labels = work.store(
        both.groupBy("row").agg(F.min("to").alias("to")).select("row", F.least("row", "to").alias("root")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("row").alias("to"), "root"), "to").groupBy("row").agg(F.min("root").alias("near"))
        least = labels.join(near, "row").select("row", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("row").alias("root"), F.col("root").alias("far"))
        moved = work.store(
            least.join(jump, "root", "left").select("row", "old", F.least("root", "far").alias("root")), "labels"
        )
        labels = moved.select("row", "root")
        if moved.filter("old != root").isEmpty():
            return labels


def near_classes(
    docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame, str]:
    """(classes, stored documents, their row column).

    Classes hold row, id, class_row, class_id (smallest id of the class), class_size
    and kept (the row of its class with the smallest id; null ids first, then the
    smallest row), for every input row.

    A null text is empty. Rows with the same sequence of words are copies: they
    are one document until the end, so a large group of copies costs nothing
    more; texts without words are copies of each other. Documents whose
    similarity reaches 0.8 are linked, and classes are what links connect. An
    empty table gives no rows.
    """
    name = fresh_name(docs, "row")
    stored = work.store(docs.withColumn(name, F.monotonically_increasing_id()), "documents", compression="zstd")
    rows = stored.select(
        F.col(name).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text")
    )
    sketched = work.store(sketches(rows), "sketches")
    copies = sketched.groupBy("digest").agg(F.min("row").alias("first"))
    # Both sides of these joins grow with the documents, and a text's size on disk says little of that in memory: none
    # is broadcast, however few documents there are.
    with session_conf(docs.sparkSession, **NO_BROADCAST):
        folded = work.store(sketched.select("row", "id", "digest").join(copies, "digest").drop("digest"), "folded")
        single = sketched.join(folded.filter("row = first").select("row"), "row", "left_semi")
        links = links_within_keys(single, rows.select("row", "text"), work)
        roots = components(links, work)
    classed = folded.join(roots.withColumnRenamed("row", "first"), "first", "left").select(
        "row", "id", F.coalesce("root", "first").alias("class_row")
    )
    totals = classed.groupBy("class_row").agg(
        F.min("id").alias("class_id"), F.count("*").alias("class_size"), F.min(F.struct("id", "row")).alias("kept")
    )
    classes = classed.join(totals, "class_row").withColumn("kept", F.col("row") == F.col("kept.row"))
    return classes.select("row", "id", "class_row", "class_id", "class_size", "kept"), stored, name


def drop_near_copies(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one of each near-duplicate class, all columns as they were."""
    classes, stored, name = near_classes(docs, work, id_col, text_col)
    dropped = classes.filter("NOT kept").select(F.col("row").alias(name))
    return stored.join(dropped, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
