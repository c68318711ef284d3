"""Token ids of whole texts, from the tokenizers library.

Text is long and its words recur, so a worker remembers the ids of words it has
met. Cutting before a space or line break that stands alone between other
characters cannot change the ids of a byte-level vocabulary: its pattern never
joins characters across such a place. Texts with any other white space, or with
the content of a token that the vocabulary adds, are encoded in one piece.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 2
# Words a worker remembers before it starts anew; bounds its memory, not what it encodes.
REMEMBERED = 600_000
# Characters encoded in one call.
CALL_CHARS = 1 << 14


class _Numbered(dict):
    """Numbers keys in the order of their first use and notes the new ones."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


def _cuttable(text: str, cuts: int) -> bool:
    """Whether all white space is single spaces and line breaks between other characters."""
    return (
        cuts > 0
        and text[0] not in " \n"
        and text[-1] not in " \n"
        and not any(pair in text for pair in ("  ", " \n", "\n ", "\n\n", "\0"))
        and len(text.split()) == cuts + 1
    )


class TextEncoder:
    """Encodes batches of texts; ids are those of encode(text, add_special_tokens=False).

    With ``literal`` a special token's content in a text is ordinary text; without,
    it gets the token's id, as from the file as it is.
    """

    def __init__(self, tokenizer_path: str, remembered: int = REMEMBERED, literal: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = literal
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.vocabulary_size = self.tokenizer.get_vocab_size()
        self.remembered = remembered
        lengths = np.zeros(self.vocabulary_size, dtype=np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            lengths[i] = len(token)  # a byte-level token has one character for each byte
        self.id_bytes = lengths
        self._forget()

    def _forget(self) -> None:
        self.words = _Numbered()
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)

    def _encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in encoded]

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per word) of words that begin with a space or line break: together they are a text."""
        calls, chars = [[]], 0
        for word in words:
            if chars > CALL_CHARS:
                calls.append([])
                chars = 0
            calls[-1].append(word)
            chars += len(word)
        ids = np.concatenate(self._encode(["".join(call) for call in calls]))
        ends = np.cumsum(self.id_bytes[ids])
        word_ends = np.cumsum([len(word.encode()) for word in words])
        ids_before = np.searchsorted(ends, word_ends, side="right")
        return ids, np.diff(ids_before, prepend=0)

    def _learn(self) -> None:
        new, self.words.new = self.words.new, []
        if not new:
            return
        counts = np.zeros(len(new), dtype=np.int64)
        joined = [i for i, word in enumerate(new) if word[:1] in (" ", "\n")]
        alone = [i for i, word in enumerate(new) if word[:1] not in (" ", "\n")]
        ids, n = self._encode_words([new[i] for i in joined]) if joined else (self.ids[:0], counts[:0])
        counts[joined] = n
        single = self._encode([new[i] for i in alone])
        counts[alone] = [len(s) for s in single]
        starts = np.zeros(len(new), dtype=np.int64)
        starts[joined] = np.cumsum(n) - n
        starts[alone] = len(ids) + np.cumsum(counts[alone]) - counts[alone]
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.lengths = np.concatenate([self.lengths, counts])
        self.ids = np.concatenate([self.ids, ids, *single])

    def encode_batch(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; number of ids per text)."""
        numbers: list[int] = []
        per_text = np.zeros(len(texts), dtype=np.int64)
        whole: list[int] = []
        for i, text in enumerate(texts):
            cuts = text.count(" ") + text.count("\n")
            if _cuttable(text, cuts) and not any(content in text for content in self.added):
                words = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
                numbers.extend(map(self.words.__getitem__, words))
                per_text[i] = len(words)
            else:
                whole.append(i)
        self._learn()
        word = np.array(numbers, dtype=np.int64)
        lengths = self.lengths[word]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[word] - (ends - lengths), lengths) + np.arange(total)]
        word_ends = np.cumsum(per_text)
        id_ends = np.concatenate([[0], ends])[word_ends]
        counts = np.diff(id_ends, prepend=0)
        if whole:
            parts = np.split(ids, id_ends[:-1]) if len(texts) > 1 else [ids]
            for i, encoded in zip(whole, self._encode([texts[i] for i in whole]), strict=True):
                parts[i], counts[i] = encoded, len(encoded)
            ids = np.concatenate(parts)
        if len(self.words) > self.remembered:
            self._forget()
        return ids, counts


_encoders: dict[tuple[str, bool], TextEncoder] = {}


def encoder(tokenizer_path: str, literal: bool = True) -> TextEncoder:
    """One per worker process and way, with what it remembers."""
    key = tokenizer_path, literal
    if key not in _encoders:
        _encoders[key] = TextEncoder(tokenizer_path, literal=literal)
    return _encoders[key]


def slices(batch: pa.RecordBatch, column: str, most_chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts hold about ``most_chars`` at most; a longer text is a part."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    if not len(lengths):
        return
    part = np.cumsum(lengths) // most_chars
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(lengths)]])
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(int(start), int(end - start))
