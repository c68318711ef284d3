"""Quality from trusted positives and unlabelled text: non-negative positive-unlabelled learning.

A text is measured (length, words, symbols, case, repetition), every measure becomes
steps ("at least this much"), and a document's value f is a weighted sum of steps.
With squared loss, the risk on the positives, and the risk on the negatives as
unlabelled text less the class prior's share of positives gives it, depend on the
data through how often steps, and pairs of steps, occur among positives and among
unlabelled documents. These counts are whole numbers of bounded size, taken over
all documents in one pass; no document is drawn. The negatives' estimated risk may
not fall below zero: the risk is then the larger of two convex quadratics, and its
minimum is found exactly, without a learning rate.

The class prior comes from the same two groups. Where only positives lie, the
density of unlabelled text over that of positives is the prior; elsewhere it is
larger. First models, each of one half of the rows, put the other half in order,
and the smallest ratio above a threshold, with a margin for small counts, is the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import text_or_empty
from kerbside.llm.tokens import slices
from kerbside.llm.wordhash import windows_of, word_hashes
from kerbside.session import Workspace

THRESHOLD = 0.7
# The prior that the first model assumes, and the share of positives that a region must hold to tell the prior.
FIRST_PRIOR, REGION_SHARE = 0.5, 0.2
# Places of a first model's values in the histogram that the prior is read from.
VALUE_BINS = 400
# Weight of the penalty on step weights, in documents of the smaller group.
RIDGE = 2.0
BLOCK_CHARS = 2_000_000
WINDOW = 5

_SHARES = (0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.16, 0.32, 0.64)
_PARTS = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
# Measures and where their steps are: even on a logarithmic scale, or tenths.
STEPS: dict[str, tuple[float, ...]] = {
    "log_words": tuple(range(1, 15)),
    "word_bytes": (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 48),
    "log_line_words": tuple(range(1, 12)),
    "symbols": _SHARES,
    "capitals": _SHARES,
    "exclamations": _SHARES,
    "digits": _SHARES,
    "stops": _SHARES,
    "beyond_ascii": _SHARES,
    "controls": _SHARES,
    "distinct_words": _PARTS,
    "commonest_word": _SHARES,
    "doubled_words": _SHARES,
    "repeated_runs": _SHARES,
}
_EDGES = [np.array(edges, dtype=np.float64) for edges in STEPS.values()]
WIDTH = 1 + sum(map(len, _EDGES))


def _classes() -> dict[str, np.ndarray]:
    codes = np.arange(256)
    of = lambda chars: np.isin(codes, list(chars.encode()))
    return {
        "symbols": of("#$%&*+/<=>@[\\]^_`{|}~"),
        "exclamations": of("!?"),
        "digits": of("0123456789"),
        "stops": of(".,;:"),
        "capitals": of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "small": of("abcdefghijklmnopqrstuvwxyz"),
        "beyond_ascii": codes >= 0x80,
        "controls": ((codes < 0x20) & ~of("\t\n\r")) | (codes == 0x7F),
        "lines": of("\n"),
    }


_CLASSES = _classes()


def _per_text(text: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(different hashes, occurrences of the commonest) per text."""
    different, most = np.zeros(texts, dtype=np.int64), np.zeros(texts, dtype=np.int64)
    if len(hashes):
        order = np.lexsort((hashes, text))
        text, hashes = text[order], hashes[order]
        first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])]))
        times = np.diff(np.append(first, len(hashes)))
        different += np.bincount(text[first], minlength=texts)
        np.maximum.at(most, text[first], times)
    return different, most


def measures(texts: list[bytes]) -> np.ndarray:
    """One row per text, one column per measure in ``STEPS``; shares of nothing are zero."""
    count = len(texts)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(count), size)
    of_class = {name: np.bincount(owner[members[data]], minlength=count) for name, members in _CLASSES.items()}
    hashes, words = word_hashes(texts)
    text = np.repeat(np.arange(count), words)
    different, most = _per_text(text, hashes, count)
    doubled = np.bincount(text[1:][(hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])], minlength=count)
    runs, _, runs_of = windows_of(hashes, words, WINDOW)
    different_runs, _ = _per_text(np.repeat(np.arange(count), runs_of), runs, count)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    spaces = np.bincount(owner[(data == 0x20) | ((data >= 0x09) & (data <= 0x0D))], minlength=count)
    letters = of_class["capitals"] + of_class["small"]
    solid = size - spaces
    found = {
        "log_words": np.log2(words + 1),
        "word_bytes": share(solid, words),
        "log_line_words": np.log2(words / (of_class["lines"] + 1) + 1),
        "capitals": share(of_class["capitals"], letters),
        "exclamations": share(of_class["exclamations"], words),
        "stops": share(of_class["stops"], words),
        **{name: share(of_class[name], solid) for name in ("symbols", "digits", "beyond_ascii", "controls")},
        "distinct_words": share(different, words),
        "commonest_word": share(most, words),
        "doubled_words": share(doubled, words),
        "repeated_runs": share(runs_of - different_runs, runs_of),
    }
    return np.column_stack([found[name] for name in STEPS])


def levels(texts: list[bytes]) -> np.ndarray:
    """How many steps each measure reaches, one byte each."""
    found = measures(texts)
    return np.column_stack([np.searchsorted(e, found[:, j], side="right") for j, e in enumerate(_EDGES)]).astype(np.uint8)


def indicators(reached: np.ndarray) -> np.ndarray:
    """0 and 1 per step, after a constant 1."""
    steps = [reached[:, j, None] > np.arange(len(edges)) for j, edges in enumerate(_EDGES)]
    return np.concatenate([np.ones((len(reached), 1)), *steps], axis=1)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the levels of every row, a few bytes; a null text is empty."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BLOCK_CHARS):
                reached = levels([t.encode() for t in batch.column("text").to_pylist()])
                packed = pa.array([row.tobytes() for row in reached], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), packed], ["id", "levels"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, levels binary")


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, len(_EDGES))


@dataclass(frozen=True)
class Moments:
    """``pairs[i, j]``: rows in which steps i and j are both reached; [0, 0] counts the rows."""

    positive: np.ndarray
    unlabelled: np.ndarray


def moments(rows: DataFrame) -> tuple[Moments, Moments]:
    """Of both halves of rows (levels, trusted, half): positives are the trusted ones, unlabelled is every row.

    Tasks add up their rows, Spark the tasks; what the driver gets does not grow.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 2, WIDTH, WIDTH), dtype=np.int64)
        for batch in batches:
            steps = indicators(_unpacked(batch.column("levels")))
            half, trusted = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("half", "trusted"))
            for i in (0, 1):
                good, every = steps[(half == i) & trusted], steps[half == i]
                found[i] += np.stack([good.T @ good, every.T @ every]).astype(np.int64)
        counts = pa.ListArray.from_arrays(np.arange(0, found.size + 1, WIDTH, dtype=np.int32), found.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4 * WIDTH)), counts], ["row", "counts"])

    parts = rows.select("levels", "trusted", "half").mapInArrow(count, "row long, counts array<bigint>")
    sums = parts.groupBy("row").agg(*[F.sum(F.col("counts")[j]).alias(f"c{j}") for j in range(WIDTH)])
    whole = np.zeros((4 * WIDTH, WIDTH))
    for row in sums.collect():
        whole[row.row] = row[1:]
    first, second = whole.reshape(2, 2, WIDTH, WIDTH)
    return Moments(*first), Moments(*second)


def non_negative_fit(found: Moments, prior: float, ridge: float = RIDGE) -> np.ndarray:
    """Step weights that minimise the non-negative unbiased risk with loss (1 - yf)^2 / 4.

    With the positives' risk P and the negatives' estimated risk N, both in the
    weights, the risk is P + max(0, N), the largest t-weighted mean of P + N and P.
    Each mean is a convex quadratic with a solution of its own; t is 1 where N is not negative
    there, and else where N is zero, found by halving.
    """
    rows = [max(pairs[0, 0], 1.0) for pairs in (found.positive, found.unlabelled)]
    p, u = found.positive / rows[0], found.unlabelled / rows[1]
    penalty = np.full(WIDTH, ridge / min(rows))
    penalty[0] = 1e-9  # the constant is free but for rows of neither kind

    def weights(t: float) -> np.ndarray:
        curve = t * u + (1 - t) * prior * p
        slope = prior * p[0] - t * (u[0] - prior * p[0])
        return np.linalg.solve(curve + np.diag(penalty), slope)

    def negatives_risk(w: np.ndarray) -> float:
        def risk(pairs: np.ndarray) -> float:
            return (pairs[0, 0] + 2 * w @ pairs[0] + w @ pairs @ w) / 4

        return risk(u) - prior * risk(p)

    whole = weights(1.0)
    if negatives_risk(whole) >= 0:
        return whole
    low, high = 0.0, 1.0
    for _ in range(60):
        t = (low + high) / 2
        low, high = (t, high) if negatives_risk(weights(t)) > 0 else (low, t)
    return weights(high)


def _values(weights: np.ndarray, reached: np.ndarray) -> np.ndarray:
    return indicators(reached) @ weights


def estimated_prior(rows: DataFrame, weights: tuple[np.ndarray, np.ndarray], region_share: float = REGION_SHARE) -> float:
    """Share of positives among unlabelled rows, from rows (levels, trusted, half) and a first model per half.

    Each half is put in order by its model, which should not have seen it: a model
    takes its own positives for better than they are, and the ratio would be too small.
    For each threshold: unlabelled rows above it over positives above it, as shares.
    The threshold with the smallest upper bound (two standard errors) gives the prior.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reached, half = _unpacked(batch.column("levels")), batch.column("half").to_numpy(zero_copy_only=False)
            values = np.clip(np.where(half == 0, *[_values(w, reached) for w in weights]), -1, 1)
            bins = np.minimum((values + 1) / 2 * VALUE_BINS, VALUE_BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("trusted")], ["bin", "trusted"])

    placed = rows.select("levels", "trusted", "half").mapInArrow(place, "bin long, trusted boolean")
    counts = np.zeros((VALUE_BINS, 2))
    for row in placed.groupBy("bin").agg(F.count_if("trusted").alias("p"), F.count("*").alias("u")).collect():
        counts[row.bin] = row.p, row.u
    above = counts[::-1].cumsum(axis=0)
    total = above[-1]
    able = (above[:, 0] >= np.maximum(region_share * total[0], 1)) & (above[:, 1] > 0)
    if not able.any():
        return FIRST_PRIOR
    positive, unlabelled = above[able].T
    ratio = (unlabelled / total[1]) / (positive / total[0])
    spread = np.sqrt(1 / positive - 1 / total[0] + 1 / unlabelled - 1 / total[1])
    best = np.argmin(ratio * (1 + 2 * spread))
    return float(min(ratio[best], 1.0))


@dataclass(frozen=True)
class QualityModel:
    prior: float
    weights: np.ndarray


def fit(rows: DataFrame, prior: float | None = None, ridge: float = RIDGE) -> QualityModel:
    """From rows (levels, trusted, half), all of them unlabelled, some known to be good.

    Without a trusted row nothing is known: every value is zero, every score a half.
    """
    first, second = moments(rows)
    found = Moments(first.positive + second.positive, first.unlabelled + second.unlabelled)
    if not found.positive[0, 0]:
        return QualityModel(FIRST_PRIOR if prior is None else prior, np.zeros(WIDTH))
    if prior is None:
        # Each half is judged by the other one's model.
        prior = estimated_prior(rows, tuple(non_negative_fit(m, FIRST_PRIOR, ridge) for m in (second, first)))
    return QualityModel(prior, non_negative_fit(found, prior, ridge))


def scored(rows: DataFrame, model: QualityModel) -> DataFrame:
    """id and score of rows (id, levels): (1 + f) / 2 within 0 and 1, what squared loss estimates as the chance of quality."""
    weights = model.weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.clip((1 + _values(weights, _unpacked(batch.column("levels")))) / 2, 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(values)], ["id", "score"])

    return rows.select("id", "levels").mapInArrow(score, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def with_trust(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with ``trusted``, whether all of the id's labels call it good, and ``half``, 0 or 1, by a hash of the id.

    Ids without labels, and null ones, are not trusted.
    """
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.groupBy("id").agg(F.coalesce(F.min("quality") == 1, F.lit(False)).alias("trusted"))
    half = F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)).cast("int")
    return rows.join(marks, "id", "left").withColumns({"trusted": F.coalesce("trusted", F.lit(False)), "half": half})


def quality_scores(
    docs: DataFrame, labels: DataFrame, held_out: Column, work: Workspace, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, QualityModel]:
    """(id and score of every row of ``docs``, the model); ``held_out`` may use column ``id``.

    Held-out rows take no part in the fit, neither as positives nor as unlabelled
    text. Every text is read once, whole; fit and scores use its stored levels. The
    text alone decides a score: repeated rows score alike, and a null or empty one
    scores as a text without words. An empty table gives no rows.
    """
    rows = work.store(measured(docs, id_col, text_col), "levels")
    model = fit(work.store(with_trust(rows.filter(~F.coalesce(held_out, F.lit(False))), labels, id_col), "trusted"))
    return scored(rows, model), model
