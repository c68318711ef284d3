"""Toxicity from class-conditional Kneser-Ney models of words.

Toxic and ordinary labelled documents each give a model: a word's probability
rests on the number of different words it was seen after, backs off to ever
shorter stems of the word, and the shortest stems back off to counts the classes
share, so an expression too rare to tell the classes apart tells nothing. What a
text says is the log ratio of the two likelihoods, per word. A text's language
and subject shift all its words alike; its median word shows by how much, and
words far above it are the evidence. A logistic curve fitted on other labelled
documents turns mean, median and excess into a score.

The counts are of all labelled rows and grow with them, so they stay a table. A
word and its stems have the shortest stem in common: dealt by it, a shard holds
all that its words back off to, and needs no more than the sizes of the whole
model. Blocks of documents ask the shards for their words, each once.
"""

from __future__ import annotations

import contextlib
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import session_conf, text_or_empty
from kerbside.llm.tokens import slices
from kerbside.llm.wordhash import word_hashes
from kerbside.session import Workspace

# Words count as far above the median from here on, and as no farther than this.
EXCESS_FROM, EXCESS_MOST = 2.0, 4.0
# Labelled rows that the curve's few weights are fitted on, over both classes.
CURVE_ROWS = 6_000
# Labelled ids, 16 bytes each, that are broadcast at most.
BROADCAST_MARKS = 1_000_000
DISCOUNT = 0.75
# Lengths of the stems a word backs off to.
STEM_BYTES = (6, 5, 4)
THRESHOLD = 0.3
BATCH_CHARS = 2_000_000
# Bytes of texts that Spark hands to Python at once, above which the next text ends a batch: a batch makes one block.
HANDED_BYTES = BATCH_CHARS * 9 // 10
# Characters whose word pairs a task holds at once; Spark merges the pairs of a task's parts before it writes them.
COUNT_CHARS = 500_000
# Words of the model, and bytes of what blocks ask, that a shard holds.
SHARD_WORDS, SHARD_BYTES = 200_000, 8 << 20
_LOWER = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)
_START = np.uint64(0x632BE59BD9B4E019)


@dataclass(frozen=True)
class Words:
    """The words of some texts, lower-cased and without punctuation, as hashes.

    ``stems`` are hashes of the first bytes of each word, one array per length in
    ``STEM_BYTES``; a shorter word is its own stem.
    """

    before: np.ndarray
    word: np.ndarray
    stems: tuple[np.ndarray, ...]
    per_text: np.ndarray


def words_in(texts: list[str]) -> Words:
    return _cut([lowered(t) for t in texts])


def lowered(text: str) -> bytes:
    return text.encode().translate(_LOWER)


def _cut(data: list[bytes]) -> Words:
    word, per_text = word_hashes(data)
    stems = tuple(word_hashes(data, most_bytes=n)[0] for n in STEM_BYTES)
    before = np.concatenate([[_START], word[:-1]]) if len(word) else word
    before[(np.cumsum(per_text) - per_text)[per_text > 0]] = _START
    return Words(before, word, stems, per_text)


@dataclass(frozen=True)
class Table:
    """Sorted keys and their values."""

    keys: np.ndarray
    values: np.ndarray

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each is there, its value or 0)."""
        if not len(self.keys):
            return np.zeros(len(wanted), dtype=bool), np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        there = self.keys[at] == wanted
        return there, np.where(there, self.values[at], 0.0)


@dataclass(frozen=True)
class Ratios:
    """Log ratios of the two models in lookup form.

    ``levels`` are words, then ever shorter stems, each with the log ratio of the
    probabilities and that of the weights of backing off from the level: what the
    deepest known level says, less certain by each level that was passed.
    """

    levels: tuple[tuple[Table, float], ...]

    def of_words(self, found: Words) -> np.ndarray:
        ratio = np.zeros(len(found.word))
        open_at = np.arange(len(found.word))
        for (table, passing), keys in zip(self.levels, (found.word, *found.stems), strict=True):
            there, value = table.find(keys[open_at])
            ratio[open_at] += np.where(there, value, passing)
            open_at = open_at[~there]
        return ratio


def evidence(ratio: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Mean ratio, median ratio and mean excess over the median of texts with ``n`` words each; zeros without words."""
    text = np.repeat(np.arange(len(n)), n)
    middle = np.zeros(len(n))
    middle[n > 0] = ratio[np.lexsort((ratio, text))][(np.cumsum(n) - n + n // 2)[n > 0]]
    excess = np.clip(ratio - middle[text] - EXCESS_FROM, 0, EXCESS_MOST)
    sums = [np.bincount(text, x, len(n)) / np.maximum(n, 1) for x in (ratio, excess)]
    return np.column_stack([sums[0], middle, sums[1]])


def _codes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True)


def _levels(
    word: np.ndarray, stems: list[np.ndarray], counts: list[np.ndarray]
) -> tuple[list[np.ndarray], list[np.ndarray], list[list[np.ndarray]], np.ndarray]:
    """(keys of each level, parents of each but the last, counts of each class and level, words below each shortest stem)."""
    level_keys, level_at = zip(*[_codes(k) for k in (word, *stems)], strict=True)
    parents = [_parents(level_at[i], level_at[i + 1], len(level_keys[i])) for i in range(len(stems))]
    classes = []
    for count in counts:
        totals = [np.bincount(level_at[0], count, len(level_keys[0]))]
        for parent, keys in zip(parents, level_keys[1:], strict=True):
            totals.append(np.bincount(parent, (totals[-1] > 0).astype(float), len(keys)))
        classes.append(totals)
    return level_keys, parents, classes, np.bincount(level_at[-1], minlength=len(level_keys[-1])).astype(float)


def model_sizes(word: np.ndarray, stems: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
    """Words, then sum and number of the counts of each class and level; those of shards add up."""
    classes = _levels(word, stems, counts)[2]
    return np.array([len(word), *[x for totals in classes for t in totals for x in (t.sum(), np.count_nonzero(t))]], dtype=float)


def kneser_ney_ratios(
    word: np.ndarray, stems: list[np.ndarray], counts: list[np.ndarray], sizes: np.ndarray | None = None
) -> Ratios:
    """From words, each once, their stems, and after how many words each class has seen them (toxic, ordinary).

    A stem counts in how many different words, or longer stems, a class has seen
    it. A part of the words, with all that share a shortest stem, needs the sizes
    of the whole.
    """
    sizes = model_sizes(word, stems, counts) if sizes is None else sizes
    level_keys, parents, totals_of, shared = _levels(word, stems, counts)
    shared /= sizes[0] + 1.0
    classes = []
    for totals, size in zip(totals_of, sizes[1:].reshape(len(counts), -1, 2), strict=True):
        below, probabilities, passing = shared, [], []
        for level in reversed(range(len(totals))):
            if level < len(parents):
                # Both classes split a stem among its expressions alike.
                below = below[parents[level]] / np.bincount(parents[level])[parents[level]]
            total = max(size[level, 0], 1.0)
            rest = max(DISCOUNT * size[level, 1], 1.0) / total
            below = np.maximum(totals[level] - DISCOUNT, 0) / total + rest * below
            probabilities.insert(0, below)
            passing.insert(0, rest)
        classes.append((probabilities, passing))
    (level_t, passing_t), (level_o, passing_o) = classes
    levels = zip(level_keys, level_t, level_o, passing_t, passing_o, strict=True)
    return Ratios(tuple((Table(k, np.log(t / o)), float(np.log(pt / po))) for k, t, o, pt, po in levels))


def _parents(at: np.ndarray, parent_at: np.ndarray, size: int) -> np.ndarray:
    parent = np.zeros(size, dtype=np.int64)
    parent[at] = parent_at
    return parent


@dataclass(frozen=True)
class Curve:
    """A logistic curve over standardised evidence."""

    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def __call__(self, evidence: np.ndarray) -> np.ndarray:
        z = np.column_stack([(evidence - self.middle) / self.scale, np.ones(len(evidence))])
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))


def logistic_curve(evidence: np.ndarray, y: np.ndarray, steps: int = 100) -> Curve:
    """By Newton's method, slightly regularised; without labelled rows every score is a half."""
    size = evidence.shape[1]
    if not len(y):
        return Curve(np.zeros(size), np.ones(size), np.zeros(size + 1))
    curve = Curve(evidence.mean(axis=0), evidence.std(axis=0) + 1e-9, np.zeros(size + 1))
    z = np.column_stack([(evidence - curve.middle) / curve.scale, np.ones(len(y))])
    for _ in range(steps):
        p, w = curve(evidence), curve.weights
        curvature = (z * (p * (1 - p))[:, None]).T @ z + 0.01 * np.eye(size + 1)
        step = np.linalg.solve(curvature, z.T @ (p - y) + 0.01 * w)
        # Halved until it does not overshoot.
        curve = Curve(curve.middle, curve.scale, w - step / max(1.0, np.abs(step).max() / 2))
        if np.abs(step).max() < 1e-8:
            break
    return curve


_STEMS = [f"stem_{n}" for n in STEM_BYTES]
_MODEL_COLUMNS = ["word", *_STEMS, "toxic", "ordinary"]


@dataclass(frozen=True)
class WordCounts:
    """A stored table of words, stems and in how many contexts each class has seen the word; its sizes."""

    words: DataFrame
    sizes: np.ndarray
    work: Workspace

    def shards(self, n: int) -> DataFrame:
        """The words with their shard: ranges of the shortest stem's hash, as ``shard_of`` deals them."""
        high = F.shiftrightunsigned(F.col(_STEMS[-1]), 32)
        return self.words.withColumn("shard", F.shiftrightunsigned(high * F.lit(n), 32))


def shard_of(stems: np.ndarray, n: int) -> np.ndarray:
    """Shard of each hash, ascending with the hash."""
    return ((stems >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


@dataclass(frozen=True)
class ToxicityModel:
    counts: WordCounts
    curve: Curve

    def scores(self, texts: list[str]) -> np.ndarray:
        docs = self.counts.words.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return np.array([r.score for r in sorted(scored(docs, self).collect(), key=lambda r: r.id)])


def _arrays(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(words, stems, counts of the classes) of rows of the model."""
    word, *stems, toxic, ordinary = [table.column(name).to_numpy() for name in _MODEL_COLUMNS]
    return word.view(np.uint64), [x.view(np.uint64) for x in stems], [toxic, ordinary]


def _texts_in_small_batches(work: Workspace) -> contextlib.AbstractContextManager[None]:
    """Both Spark and Python hold a batch; 10,000 whole texts are far more than a block."""
    return session_conf(work.spark, spark__sql__execution__arrow__maxBytesPerBatch=str(HANDED_BYTES))


def count_words(labelled: DataFrame, work: Workspace) -> WordCounts:
    """Continuation counts of every word of the labelled rows (text, toxic), whole texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", COUNT_CHARS):
                found = words_in(batch.column("text").to_pylist())
                if not len(found.word):
                    continue
                toxic = np.repeat(batch.column("toxic").to_numpy(zero_copy_only=False), found.per_text)
                order = np.lexsort((found.before, found.word))
                word, before, seen = found.word[order], found.before[order], np.where(toxic[order] == 1, 1, 2)
                new_word = np.concatenate([[True], word[1:] != word[:-1]])
                pair = np.flatnonzero(new_word | np.concatenate([[True], before[1:] != before[:-1]]))
                # A row for each pair, then one for each word with its stems and no word before.
                named = order[new_word]
                only_pair = np.concatenate([np.zeros(len(pair), dtype=bool), np.ones(len(named), dtype=bool)])
                columns = [
                    pa.array(np.concatenate([word[pair], found.word[named]]).view(np.int64)),
                    pa.array(np.concatenate([before[pair], found.word[named]]).view(np.int64), mask=only_pair),
                    pa.array(np.concatenate([np.bitwise_or.reduceat(seen, pair), np.zeros(len(named), dtype=np.int64)])),
                    *[pa.array(np.concatenate([word[pair], x[named]]).view(np.int64), mask=~only_pair) for x in found.stems],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["word", "before", "seen", *_STEMS])

    schema = ", ".join(f"{name} long" for name in ("word", "before", "seen", *_STEMS))
    stems = [F.max(name).alias(name) for name in _STEMS]
    with _texts_in_small_batches(work):
        words = work.store(
            labelled.select("text", F.col("toxic").cast("long").alias("toxic"))
            .mapInArrow(count, schema)
            .groupBy("word", "before")
            .agg(F.bit_or("seen").alias("seen"), *stems)
            .groupBy("word")
            .agg(
                *stems,
                F.sum(F.col("seen").bitwiseAND(F.lit(1))).alias("toxic"),
                F.sum(F.shiftright("seen", 1)).alias("ordinary"),
            ),
            "words",
        )

    def measure(table: pa.Table) -> pa.Table:
        return pa.table({"sizes": [model_sizes(*_arrays(table)).tolist()]})

    shards = max(1, -(-words.count() // SHARD_WORDS))
    counts = WordCounts(words, np.zeros(0), work)
    parts = counts.shards(shards).groupBy("shard").applyInArrow(measure, "sizes array<double>")
    each = F.posexplode("sizes").alias("place", "size")
    sums = parts.select(each).groupBy("place").agg(F.sum("size").alias("size")).collect()
    sizes = np.zeros(1 + 2 * 2 * (1 + len(STEM_BYTES)))
    for place, size in sums:
        sizes[place] = size
    return WordCounts(words, sizes, work)


def _planes(codes: np.ndarray) -> bytes:
    """32-bit numbers, all lowest bytes first: the higher ones are much alike and pack well."""
    return np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<i4").ravel()


def with_evidence(rows: DataFrame, counts: WordCounts, curve: Curve | None = None) -> DataFrame:
    """What rows (carried, text) carry, with mean, middle and excess of their words' ratios, or the score a curve gives these."""
    work, carried_type = counts.work, rows.schema["carried"].dataType.simpleString()
    names = ["score"] if curve else ["mean", "middle", "excess"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, compress = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for batch in slices(whole, "text", BATCH_CHARS):
                data = [lowered(t) for t in batch.column("text").to_pylist()]
                hashes, per_text = word_hashes(data)
                _, first, code = np.unique(hashes, return_index=True, return_inverse=True)
                words = b" ".join(data).split()
                # In the order of shards, however many there will be: a shard's answers are one run of them.
                by_shard = np.argsort(word_hashes([b" ".join(words[i] for i in first.tolist())], STEM_BYTES[-1])[0], kind="stable")
                rank = np.empty(len(first), dtype=np.int64)
                rank[by_shard] = np.arange(len(first))
                code = rank[code] if len(first) else code
                asked = b" ".join(words[i] for i in first[by_shard].tolist())
                columns = [
                    pa.array([block]), pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("carried")),
                    *[pa.array([x], pa.binary()) for x in (
                        compress(per_text.astype(np.int64).tobytes()), compress(_planes(code)), compress(asked)
                    )], pa.array([len(asked)], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["block", "carried", "per_text", "codes", "words", "n_bytes"])
                block += 1

    schema = f"block long, carried array<{carried_type}>, per_text binary, codes binary, words binary, n_bytes long"
    with _texts_in_small_batches(work):
        blocks = work.store(rows.select("carried", "text").mapInArrow(write, schema), "blocks")
    n_bytes = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(1, -(-int(counts.sizes[0]) // SHARD_WORDS), -(-n_bytes // SHARD_BYTES))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist(), strict=True):
                data = zstandard.ZstdDecompressor().decompress(packed)
                words = data.split()
                shard = shard_of(word_hashes([data], most_bytes=STEM_BYTES[-1])[0], shards)
                edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]).tolist()
                found = [
                    {"block": block, "shard": int(shard[low]), "start": low, "words": b" ".join(words[low:high])}
                    for low, high in zip(edges[:-1], edges[1:], strict=True) if high > low
                ]
                if found:
                    yield pa.RecordBatch.from_pylist(found, ASKED)

    sizes = counts.sizes

    def answer(asked: pa.Table, model: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return ANSWERED.empty_table()
        ratios, answers = kneser_ney_ratios(*_arrays(model), sizes), []
        for batch in asked.combine_chunks().to_batches():
            for part in slices(batch, "words", BATCH_CHARS):
                found = _cut(part.column("words").to_pylist())
                known = ratios.of_words(found).astype(np.float32)
                answers += [x.tobytes() for x in np.split(known, np.cumsum(found.per_text)[:-1])]
        return pa.Table.from_arrays([asked.column("block"), asked.column("start"), pa.array(answers, pa.binary())], schema=ANSWERED)

    def finish(block: pa.Table, told: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        per_text = np.frombuffer(unpack(block.column("per_text")[0].as_py()), dtype=np.int64)
        codes = _from_planes(unpack(block.column("codes")[0].as_py()))
        ratio = np.zeros(int(codes.max(initial=-1)) + 1)
        for start, ratios in zip(told.column("start").to_pylist(), told.column("ratios"), strict=True):
            known = np.frombuffer(ratios.as_py(), dtype=np.float32)
            ratio[start : start + len(known)] = known
        found = evidence(ratio[codes], per_text)
        carried = block.column("carried").combine_chunks().flatten()
        # Scored here, as a step of its own would keep a second Python process beside each task.
        told_of = [curve(found)] if curve else found.T
        return pa.table([carried, *[pa.array(x) for x in told_of]], names=["carried", *names])

    ASKED = pa.schema([("block", pa.int64()), ("shard", pa.int64()), ("start", pa.int64()), ("words", pa.binary())])
    ANSWERED = pa.schema([("block", pa.int64()), ("start", pa.int64()), ("ratios", pa.binary())])
    asked = blocks.select("block", "words").mapInArrow(ask, "block long, shard long, start long, words binary")
    answered = work.store(
        asked.groupBy("shard").cogroup(counts.shards(shards).groupBy("shard"))
        .applyInArrow(answer, "block long, start long, ratios binary"), "answers",
    )
    schema = ", ".join([f"carried {carried_type}", *[f"{name} double" for name in names]])
    # The words have been asked for; what is left of the blocks stands in for them.
    lean = work.store(blocks.select("block", "carried", "per_text", "codes"), "lean")
    work.drop(blocks)
    return lean.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(finish, schema)


def fit(labelled: DataFrame, work: Workspace, curve_rows: int = CURVE_ROWS) -> ToxicityModel:
    """From labelled rows (id, text, toxic).

    A hash of the id sets a fifth of the rows aside for the curve, which is fitted
    on at most ``curve_rows`` of them, those with the smallest hashes: spread over
    the table, the same in every run. The models count all other rows.
    """
    for_curve = F.pmod(F.xxhash64(F.lit("curve"), "id"), F.lit(5)) == 0
    counts = count_words(labelled.filter(~for_curve), work)
    drawn = labelled.filter(for_curve).orderBy(F.xxhash64(F.lit("curve"), "id"), "id").limit(curve_rows)
    drawn = work.store(drawn.select(F.col("toxic").cast("double").alias("carried"), "text"), "curve")
    weighed = with_evidence(drawn, counts).toArrow()
    work.drop(drawn)
    columns = [weighed.column(name).to_numpy() for name in ("mean", "middle", "excess", "carried")]
    return ToxicityModel(counts, logistic_curve(np.column_stack(columns[:-1]), columns[-1]))


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row; the text alone decides.

    A null or empty text has no evidence and gets the score of none at all. Repeated
    rows are scored alike. An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("carried"), text_or_empty(text_col).alias("text"))
    return with_evidence(rows, model.counts, model.curve).withColumnRenamed("carried", "id")


def labelled_rows(
    docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, text, toxic of the rows to learn from: labelled, not held out; ``held_out`` may use column ``id``.

    An id that one of its labels calls toxic is toxic. Up to ``BROADCAST_MARKS`` ids go to
    the documents; beyond that both sides are shuffled, texts with them.
    """
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(~held_out & F.col("toxic").isin(0, 1)).groupBy("id").agg(F.max("toxic").alias("toxic"))
    if marks.count() <= BROADCAST_MARKS:
        marks = F.broadcast(marks)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    return texts.join(marks, "id")
