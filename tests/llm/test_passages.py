"""Byte and word passages against brute force; the suffix array against sorting."""

import hashlib
import sys

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from kerbside.llm import passages, phrases, suffix
from kerbside.session import Workspace
from tests.llm.edge import edge_docs, edge_rows, given, no_docs


@pytest.fixture(scope="module")
def work(spark):
    with Workspace(spark) as workspace:
        yield workspace


def smaller(a, b):
    return (float("-inf") if a is None else a) < (float("-inf") if b is None else b)


def brute_bytes(rows):
    owner = {}
    for doc_id, text in rows:
        for i in range(len(text) - 49):
            s = text[i : i + 50]
            if s not in owner or smaller(doc_id, owner[s]):
                owner[s] = doc_id
    found = []
    for doc_id, text in rows:
        gone = bytearray(len(text))
        for i in range(len(text) - 49):
            if smaller(owner[text[i : i + 50]], doc_id):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        runs = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        found.append((doc_id, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def brute_words(rows):
    least = {}
    for doc_id, text in rows:
        words = text.split()
        for i in range(len(words) - 19):
            w = tuple(words[i : i + 20])
            if w not in least or smaller(doc_id, least[w]):
                least[w] = doc_id
    found = []
    for doc_id, text in rows:
        words, gone, seen = text.split(), set(), set()
        for i in range(len(words) - 19):
            w = tuple(words[i : i + 20])
            if smaller(least[w], doc_id) or w in seen:
                gone.update(range(i, i + 20))
            seen.add(w)
        kept = b" ".join(x for i, x in enumerate(words) if i not in gone)
        found.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def rows_of(frame):
    return [(r.doc_id, (r.text or "").encode()) for r in frame.select("doc_id", "text").collect()]


def got_bytes(frame):
    rows = frame.collect()
    assert all(sum(b - a for a, b in r.spans or []) == r.n_bytes - len(r.kept) for r in rows)
    return sorted(((r.id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans or []), r.kept_sha256) for r in rows), key=repr)


def got_words(frame):
    return sorted(
        ((r.id, r.n_words, sum(b - a for a, b in r.spans), r.kept_sha256) for r in frame.collect()), key=repr
    )


def test_edge_documents(spark, work):
    rows = [(i, (t or "").encode()) for i, t, *_ in edge_rows()]
    assert got_bytes(suffix.removed_spans(edge_docs(spark), work)) == brute_bytes(rows)
    assert got_words(phrases.kept_words(edge_docs(spark), work)) == brute_words(rows)


def test_whole_given_table_in_bytes(spark, work):
    docs = given(spark)
    found = brute_bytes(rows_of(docs))
    assert sum(n for _, _, n, _, _ in found) > 100_000
    assert got_bytes(suffix.removed_spans(docs.repartition(5), work)) == found


def test_small_blocks_buckets_and_shards_change_nothing(spark, work, monkeypatch):
    monkeypatch.setattr(passages, "BUCKET_ANCHORS", 50)
    monkeypatch.setattr(passages, "SHARD_BYTES", 2_000)
    rows = [(i, (t or "").encode()) for i, t, *_ in edge_rows()]
    assert got_bytes(suffix.removed_spans(edge_docs(spark).repartition(7), work)) == brute_bytes(rows)
    assert got_words(phrases.kept_words(edge_docs(spark).repartition(7), work)) == brute_words(rows)


def test_shards_and_blocks_of_bytes_grow_before_they_are_many(spark, monkeypatch):
    stored = {}

    class Seen(Workspace):
        def store(self, df, name, **options):
            stored[name] = super().store(df, name, **options)
            return stored[name]

        def drop(self, *tables):
            pass

    monkeypatch.setattr(passages, "SHARD_BYTES", 200)
    monkeypatch.setattr(passages, "BLOCK_CHARS", 1_000)
    rows = [(i, (t or "").encode()) for i, t, *_ in edge_rows()]
    size = sum(len(t) for _, t in rows)
    with Seen(spark) as seen:
        assert got_bytes(suffix.removed_spans(edge_docs(spark).coalesce(1), seen)) == brute_bytes(rows)
        shards = stored["pieces"].filter("shard >= 0").select("shard").distinct().count()
        assert 10 < shards <= max(64, size / 400 + 1)
        assert stored["blocks"].count() <= size / 2_000 + 2


@settings(max_examples=50, deadline=None)
@cases(st.lists(st.tuples(st.integers(0, 400), st.integers(1, 4)), max_size=8), st.integers(20, 200))
def test_pieces_do_not_depend_on_steps(texts, step):
    rng = np.random.default_rng(len(texts) + step)
    texts = [bytes(rng.integers(0, symbols, n, dtype=np.uint8)) for n, symbols in texts]
    whole, usual = passages.BYTES.pieces(texts), passages.STEP
    passages.STEP = step
    try:
        stepped = passages.BYTES.pieces(texts)
    finally:
        passages.STEP = usual
    assert whole.windows.sum() == sum(max(0, len(t) - 49) for t in texts)
    for name in ("start", "within", "windows", "anchor", "key", "text"):
        assert getattr(whole, name).tolist() == getattr(stepped, name).tolist()
    anchors = {}
    for text, within, windows, at in zip(whole.text, whole.within, whole.windows, whole.anchor, strict=True):
        for i in range(windows):
            window = texts[text][within + i : within + i + 50]
            assert len(window) == 50 and anchors.setdefault(window, at - i) == at - i


def test_empty_tables(spark, work):
    assert suffix.removed_spans(no_docs(spark), work).count() == 0
    assert phrases.kept_words(no_docs(spark), work).count() == 0


@settings(max_examples=200, deadline=None)
@cases(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=12), min_size=1, max_size=6))
def test_suffix_array_is_sorted(strings):
    lengths = np.array([len(s) for s in strings])
    rows = np.zeros((len(strings), lengths.max()), dtype=np.int32)
    for row, s in zip(rows, strings, strict=True):
        row[: len(s)] = s
    symbols, starts, order = suffix.suffix_array(rows, lengths)
    string = np.repeat(np.arange(len(strings)), lengths)
    suffixes = [tuple(symbols[i : starts[string[i]] + lengths[string[i]]]) for i in order]
    assert sorted(order.tolist()) == list(range(len(symbols))) and suffixes == sorted(suffixes)


def test_a_suffix_array_is_built_by_columns():
    strings = np.random.default_rng(1).integers(1, 60, (2_000, 30)).astype(np.int32)
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(1) if event in ("call", "c_call") else None)
    try:
        suffix.suffix_array(strings, np.full(2_000, 30))
    finally:
        sys.setprofile(None)
    assert len(calls) < strings.size // 4


@pytest.mark.parametrize("symbols", [1, 60, 10_000])
def test_owners_do_not_depend_on_how_many_anchors_share_a_suffix_array(symbols, monkeypatch):
    monkeypatch.setattr(suffix, "ARRAY_SYMBOLS", symbols, raising=False)
    rng = np.random.default_rng(2)
    anchors = [bytes(rng.integers(97, 100, 32, dtype=np.uint8)) for _ in range(9)]
    pieces = sorted({bytes(rng.integers(97, 99, 18, dtype=np.uint8)) + a + bytes(rng.integers(97, 99, 18, dtype=np.uint8))
                     for a in anchors for _ in range(12)})
    ids = rng.permutation(len(pieces)) + 5
    least = {}
    for i, piece in zip(ids.tolist(), pieces, strict=True):
        for at in range(len(piece) - 49):
            window = piece[at : at + 50]
            least[window] = min(i, least.get(window, i))
    variants = passages.Variants(np.full(len(pieces), 18), pa.array(pieces, pa.binary()), ids)
    windows, owner = suffix.settle(variants)
    assert windows.tolist() == [19] * len(pieces)
    assert owner.tolist() == [least[p[at : at + 50]] for p in pieces for at in range(19)]


@settings(max_examples=100, deadline=None)
@cases(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 15)), min_size=1, max_size=8))
def test_spans_merge(intervals):
    covered = {x for a, n in intervals for x in range(a, a + n)}
    starts, ends = (np.array(x) for x in zip(*[(a, a + n) for a, n in intervals], strict=True))
    found = suffix.spans(starts, ends)
    assert {x for a, b in found for x in range(a, b)} == covered
    assert all(b < c for (_, b), (c, _) in zip(found, found[1:], strict=False))
