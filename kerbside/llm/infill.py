"""Fill-in-the-middle: texts cut in three, their parts put in another order, and back again.

The texts of a block are one run of bytes. A scan over code points finds the cuts,
and each part of a text moves by one number of bytes. These numbers go into a
difference array at the parts' first bytes; its cumulative sum is the shift of
every byte, and one scatter writes the block's outputs, with the marks in the gaps.
The way back finds the marks, builds the inverse shifts alike and gathers.
Shifts exist for one step of bytes at a time, so a very long text needs no more
than its bytes in and out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import text_or_empty
from kerbside.llm.tokens import slices

SEED = 1
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20
# The marks before prefix, suffix and middle, and the names of the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMS = np.array([PLAIN, PSM, SPM])
_MARK = len(PREFIX)
# Bytes of a block of texts, and bytes whose shifts exist at a time.
BLOCK_BYTES, STEP_BYTES = 4_000_000, 1 << 20


@dataclass(frozen=True)
class Texts:
    """Texts one after the other in ``data``; text i ends at ``offsets[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        column = pc.cast(pc.fill_null(column, ""), pa.large_string())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        return cls(data[offsets[0] : offsets[-1]], offsets - offsets[0])

    def column(self) -> pa.Array:
        offsets = pa.py_buffer(self.offsets.astype(np.int32))
        return pa.Array.from_buffers(pa.string(), len(self.offsets) - 1, [None, offsets, pa.py_buffer(self.data)])


def _steps(size: int, step: int) -> Iterator[tuple[int, int]]:
    for low in range(0, size, step):
        yield low, min(low + step, size)


def _first_bytes(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def code_points_before(data: np.ndarray, places: np.ndarray, step: int = STEP_BYTES) -> np.ndarray:
    """How many code points start before each place; ``places`` ascend, up to the end."""
    found, seen = np.zeros(len(places), dtype=np.int64), 0
    for low, high in _steps(len(data), step):
        so_far = np.concatenate([[0], np.cumsum(_first_bytes(data[low:high]))])
        first, last = np.searchsorted(places, [low, high])
        found[first:last] = seen + so_far[places[first:last] - low]
        seen += so_far[-1]
    found[np.searchsorted(places, len(data)) :] = seen
    return found


def code_point_places(data: np.ndarray, numbers: np.ndarray, step: int = STEP_BYTES) -> np.ndarray:
    """First byte of each numbered code point, the end for one past the last; ``numbers`` ascend."""
    found, seen = np.full(len(numbers), len(data), dtype=np.int64), 0
    for low, high in _steps(len(data), step):
        starts = np.flatnonzero(_first_bytes(data[low:high]))
        first, last = np.searchsorted(numbers, [seen, seen + len(starts)])
        found[first:last] = low + starts[numbers[first:last] - seen]
        seen += len(starts)
    return found


def marks_in(texts: Texts, step: int = STEP_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, letter) of every mark that lies within one text, ascending."""
    data, parts = texts.data, [np.zeros(0, dtype=np.int64)]
    for low, high in _steps(max(len(data) - _MARK + 1, 0), step):
        at = low + np.flatnonzero((data[low:high] == PREFIX[0]) & (data[low + 2 : high + 2] == PREFIX[2]))
        parts.append(at[np.isin(data[at + 1], [mark[1] for mark in (PREFIX, SUFFIX, MIDDLE)])])
    places = np.concatenate(parts)
    text = np.searchsorted(texts.offsets, places, side="right") - 1
    inside = places + _MARK <= texts.offsets[text + 1]
    return text[inside], places[inside], data[places[inside] + 1]


def move(data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, size: int, back: bool, step: int = STEP_BYTES) -> np.ndarray:
    """Bytes displaced part by part: ``starts`` ascend, part k moves by ``shifts[k]``.

    Forward, part k of ``data`` is scattered into the ``size`` bytes of the result;
    back, ``starts`` and ``shifts`` are the parts of the result, gathered from ``data``.
    """
    out = np.zeros(size, dtype=np.uint8)
    jumps, shift = np.diff(shifts, prepend=0), 0
    for low, high in _steps(size if back else len(data), step):
        change = np.zeros(high - low, dtype=np.int64)
        first, last = np.searchsorted(starts, [low, high])
        np.add.at(change, starts[first:last] - low, jumps[first:last])
        change[0] += shift
        there = np.cumsum(change)
        shift = there[-1]
        there += np.arange(low, high)
        if back:
            out[low:high] = data[there]
        else:
            out[there] = data[low:high]
    return out


def _interleaved(*columns: np.ndarray) -> np.ndarray:
    return np.column_stack(columns).ravel()


@dataclass(frozen=True)
class Infilled:
    """Outputs of a block of texts; ``form`` numbers ``FORMS``, parts are in code points."""

    outputs: Texts
    n: np.ndarray
    form: np.ndarray
    prefix: np.ndarray
    middle: np.ndarray


def infilled(texts: Texts, draws: np.ndarray, step: int = STEP_BYTES) -> Infilled:
    """Cut and rearranged texts. ``draws``: four whole numbers per text, two for the cuts, two for the form."""
    data, starts, ends = texts.data, texts.offsets[:-1], texts.offsets[1:]
    before = code_points_before(data, texts.offsets, step)
    n = np.diff(before)
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    marked = np.zeros(len(n), dtype=bool)
    marked[marks_in(texts, step)[0]] = True
    plain = (n == 0) | marked | (draws[:, 2] % 100 >= PLAIN_FROM)
    suffix_first = draws[:, 3] % 100 < SUFFIX_FIRST_BELOW
    form = np.where(plain, 0, np.where(suffix_first, 2, 1))

    a, b = code_point_places(data, (before[:-1, None] + cuts).ravel(), step).reshape(-1, 2).T
    prefix, middle, suffix = a - starts, b - a, ends - b
    offsets = np.concatenate([[0], np.cumsum(ends - starts + np.where(plain, 0, 3 * _MARK))])
    begin = offsets[:-1]
    prefix_at = begin + _MARK + np.where(suffix_first, _MARK + suffix, 0)
    suffix_at = begin + _MARK + np.where(suffix_first, 0, _MARK + prefix)
    middle_at = begin + 3 * _MARK + prefix + suffix
    shifts = [np.where(plain, begin - starts, to - at) for at, to in ((starts, prefix_at), (a, middle_at), (b, suffix_at))]
    out = move(data, _interleaved(starts, a, b), _interleaved(*shifts), int(offsets[-1]), back=False, step=step)
    for mark, at in ((PREFIX, prefix_at), (MIDDLE, middle_at), (SUFFIX, suffix_at)):
        for i, byte in enumerate(mark):
            out[at[~plain] - _MARK + i] = byte
    return Infilled(Texts(out, offsets), n, form, cuts[:, 0], cuts[:, 1] - cuts[:, 0])


def restored(outputs: Texts, form: np.ndarray, step: int = STEP_BYTES) -> Texts:
    """The texts, from outputs and forms alone.

    A text that holds a mark stays plain, and no mark can arise where a part meets
    one, so the marks found in another output are the three that were put there.
    """
    cut = form != 0
    text, place, letter = marks_in(outputs, step)
    mine = cut[text]
    if not np.array_equal(text[mine], np.repeat(np.flatnonzero(cut), 3)):
        raise ValueError("an output does not hold one mark of each kind")
    places, letters = place[mine].reshape(-1, 3), letter[mine].reshape(-1, 3)
    suffix_first = form[cut] == 2
    wanted = np.where(suffix_first[:, None], [[SUFFIX[1], PREFIX[1], MIDDLE[1]]], [[PREFIX[1], SUFFIX[1], MIDDLE[1]]])
    if not np.array_equal(letters, wanted):
        raise ValueError("the marks of an output do not fit its form")
    lengths = np.diff(outputs.offsets) - np.where(cut, 3 * _MARK, 0)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    ends = outputs.offsets[1:][cut]
    lead, second, middle = places[:, 0] + _MARK, places[:, 1] + _MARK, places[:, 2] + _MARK
    lead_size, second_size = places[:, 1] - lead, places[:, 2] - second
    sources = np.repeat(outputs.offsets[:-1, None], 3, axis=1)
    sizes = np.stack([lengths, np.zeros_like(lengths), np.zeros_like(lengths)], axis=1)
    sources[cut] = np.stack([np.where(suffix_first, second, lead), middle, np.where(suffix_first, lead, second)], axis=1)
    sizes[cut, 0] = np.where(suffix_first, second_size, lead_size)
    sizes[cut, 1] = ends - middle
    sizes[cut, 2] = np.where(suffix_first, lead_size, second_size)
    targets = offsets[:-1, None] + np.cumsum(sizes, axis=1) - sizes
    return Texts(move(outputs.data, targets.ravel(), (sources - targets).ravel(), int(offsets[-1]), back=True, step=step), offsets)


def _draws(id_col: str, seed: int) -> list[Column]:
    """The first four 8-digit groups of the hex sha256 of ``seed:id``, a null id as text "null"."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def rearranged(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n, form, prefix_chars, middle_chars and output of every row; other columns are left out.

    A null text is empty; an empty one and one that holds a mark stay plain, and plain
    rows have null parts. The id alone decides cuts and form, so repeated rows come out
    alike in every run. An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"), *_draws(id_col, seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BLOCK_BYTES):
                draws = np.column_stack([batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(1, 5)])
                found = infilled(Texts.of(batch.column("text")), draws)
                plain = found.form == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), pa.array(found.n), pa.array(FORMS[found.form].tolist(), pa.string()),
                        pa.array(found.prefix, mask=plain), pa.array(found.middle, mask=plain), found.outputs.column(),
                    ],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def with_restored(rows: DataFrame) -> DataFrame:
    """``rows`` as ``rearranged`` gives them, with the text rebuilt from ``output`` and ``form`` as ``restored``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "output", BLOCK_BYTES):
                form = np.searchsorted(FORMS, batch.column("form").to_numpy(zero_copy_only=False).astype(str))
                texts = restored(Texts.of(batch.column("output")), form)
                yield pa.RecordBatch.from_arrays([*batch.columns, texts.column()], [*batch.schema.names, "restored"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, restored string")
