"""Phrases of 20 words that occurred before, located with Aho-Corasick automata.

A shard holds the pieces around recurring anchors. Windows that more than one
piece has are confirmed and compiled into an automaton over word numbers; every
piece is streamed through it, and each hit gives the phrase the smallest
document id seen with it.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kerbside.llm import passages
from kerbside.llm.passages import NULL_ID, WORD_ANCHOR, WORDS, Variants
from kerbside.llm.suffix import spans
from kerbside.session import Workspace


def confirmed(pieces: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """The windows that more than one piece has."""
    size, seen = WORDS.window, Counter()
    for words in pieces:
        seen.update({words[i : i + size] for i in range(len(words) - size + 1)})
    return [window for window, times in seen.items() if times > 1]


def compiled(phrases: list[tuple[int, ...]]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for number, phrase in enumerate(phrases):
        automaton.add_word(phrase, number)
    automaton.make_automaton()
    return automaton


def settle(variants: Variants) -> tuple[np.ndarray, np.ndarray]:
    """(windows per variant, owner of every window).

    A window that only one variant has keeps that variant's owner. Pieces with
    different anchors share no window, so anchors with one variant need no search.
    """
    size = WORDS.window
    numbers: dict[bytes, int] = {}
    pieces = [
        tuple(numbers.setdefault(word, len(numbers)) for word in content.as_py().split(b" "))
        for content in variants.content
    ]
    windows = np.array([len(p) - size + 1 for p in pieces], dtype=np.int64)
    owner = np.repeat(variants.owner, windows)
    starts = np.cumsum(windows) - windows
    anchors: dict[tuple[int, ...], int] = {}
    held = [p[at : at + WORD_ANCHOR] for p, at in zip(pieces, variants.anchor.tolist(), strict=True)]
    anchor = np.array([anchors.setdefault(words, len(anchors)) for words in held], dtype=np.int64)
    searched = np.flatnonzero(np.bincount(anchor)[anchor] > 1).tolist()
    phrases = confirmed([pieces[v] for v in searched])
    if not phrases:
        return windows, owner
    automaton = compiled(phrases)
    places, found = [], []
    for v in searched:
        base = int(starts[v]) - size + 1
        for end, phrase in automaton.iter(pieces[v]):
            places.append(base + end)
            found.append(phrase)
    place, phrase = np.array(places, dtype=np.int64), np.array(found, dtype=np.int64)
    least = np.full(len(phrases), np.iinfo(np.int64).max)
    np.minimum.at(least, phrase, owner[place])
    owner[place] = least[phrase]
    return windows, owner


def kept_words(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, the word spans to remove, and the words that stay, joined by one space.

    A word goes if a window of 20 words that covers it also starts earlier: in a
    document with a smaller id, or before it in the same document. Windows are
    judged on the input. Null and empty texts have no words. A null id is smaller
    than all others; documents with the same id do not remove from each other. An
    empty table gives no rows.
    """
    size = WORDS.window
    blocks = passages.store_blocks(docs, work, WORDS, id_col, text_col)
    anchors = passages.recurring_anchors(blocks, work, WORDS)
    pieces = passages.cut_pieces(blocks, anchors, work, WORDS)
    work.drop(anchors)
    owned = passages.owners(pieces, work, settle, keep_own=True)

    def finish(ids: np.ndarray, texts: list[bytes], found: tuple[np.ndarray, ...]) -> pa.Table:
        text, first, end, owner = found
        order = np.lexsort((first, text))
        low, high = (np.searchsorted(text[order], np.arange(len(texts)), side) for side in ("left", "right"))
        rows = []
        for i, (doc_id, data) in enumerate(zip(ids.tolist(), texts, strict=True)):
            words, own = data.split(), order[low[i] : high[i]]
            gone = spans_in(words, first[own], end[own], owner[own] < doc_id) if len(own) else []
            edges = [0, *[x for span in gone for x in span], len(words)]
            kept = b" ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b])
            rows.append(
                {"id": None if doc_id == NULL_ID else doc_id, "n_words": len(words), "spans": [list(s) for s in gone],
                 "kept": kept.decode(), "kept_sha256": hashlib.sha256(kept).hexdigest()}
            )
        return pa.Table.from_pylist(rows, KEPT)

    def spans_in(words: list[bytes], first: np.ndarray, end: np.ndarray, earlier: np.ndarray) -> list[tuple[int, int]]:
        starts, ends = first[earlier].tolist(), (end[earlier] - 1 + size).tolist()
        seen: set[tuple[bytes, ...]] = set()
        for a, b in zip(first[~earlier].tolist(), end[~earlier].tolist(), strict=True):
            for at in range(a, b):
                window = tuple(words[at : at + size])
                if window in seen:
                    starts.append(at)
                    ends.append(at + size)
                seen.add(window)
        return spans(np.array(starts), np.array(ends)) if starts else []

    KEPT = pa.schema(
        [("id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.string()),
         ("kept_sha256", pa.string())]
    )
    schema = "id long, n_words long, spans array<array<long>>, kept string, kept_sha256 string"
    return passages.apply_owners(blocks, pieces, owned, finish, schema)
