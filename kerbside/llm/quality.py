"""Quality rules as a short-circuit cascade, in Spark functions only.

A rule is a metric of the text and a condition that rejects. On a sample the
operator measures what each rule rejects and what it costs, orders the rules by
rejection per cost, and tests them in that order in one CASE expression: a
document that one rule rejects never pays for the rules after it. The order
changes the time and the rule that is named, never the set that is kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import SPACES, fresh_name, text_or_empty

# Rows of the sample on which costs and rejections are measured.
SAMPLE_ROWS = 2_000
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Fixed value: the characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def lines_of(text: Column) -> Column:
    """Lines, cut at line feeds only, that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, "")).cast("long")


def symbol_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def duplicate_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _window_count(words: Column) -> Column:
    return F.greatest(F.size(words) - (WINDOW_WORDS - 1), F.lit(0))


def _windows(words: Column, of: Callable[[Column, Column], Column]) -> Column:
    """``of(window, place)`` for every window; ``words`` must be a column, or it is worked out per window."""
    count = _window_count(words)
    places = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: of(F.slice(words, i, WINDOW_WORDS), i))


def repeat_words(words: Column) -> Column:
    """Words covered by 8-word windows that occur at least twice in the text.

    Hashes of windows are compared first. Where none recurs, no window does, and
    that settles nearly all texts. Elsewhere the windows themselves are sorted
    with their places; each place of a recurring window covers its words, less
    those the place before covered.
    """
    count = _window_count(words)
    recur = F.size(F.array_distinct(_windows(words, lambda w, i: F.xxhash64(w)))) < count
    ordered = F.sort_array(_windows(words, lambda w, i: F.struct(F.array_join(w, " ").alias("w"), i.alias("i"))))
    neighbours = F.zip_with(
        ordered,
        F.slice(ordered, F.lit(2), count),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    places = F.sort_array(F.array_distinct(F.flatten(neighbours)))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW_WORDS).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda so_far, i: F.struct(
            i.alias("last"),
            (so_far["n"] + F.least(F.lit(WINDOW_WORDS), i - so_far["last"])).cast("long").alias("n"),
        ),
        lambda so_far: so_far["n"],
    )
    return F.when(recur, covered).otherwise(F.lit(0).cast("long"))


@dataclass(frozen=True)
class Parts:
    """A document's text cut once, as columns that all metrics share."""

    text: Column
    words: Column
    lines: Column


def with_parts(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, Parts, tuple[str, str]]:
    """The documents with their words and lines, the parts, and the two columns to drop again."""
    text, words, lines = text_or_empty(text_col), fresh_name(docs, "words"), fresh_name(docs, "lines")
    # Always true, but not to the optimizer: a filter on the metrics would else be moved below the cutting, with the
    # cutting copied into it, and windows would cut the whole text again for every word.
    once = F.monotonically_increasing_id() >= 0
    cut = docs.withColumns({words: F.when(once, words_of(text)), lines: F.when(once, lines_of(text))})
    return cut, Parts(text, F.col(words), F.col(lines)), (words, lines)


def base_metrics(parts: Parts) -> dict[str, Column]:
    """``n_words`` and the four metrics, by name."""
    return {
        "n_words": F.size(parts.words).cast("long"),
        "word_chars": word_chars(parts.text),
        "n_symbols": symbol_count(parts.text),
        "n_dup_lines": duplicate_lines(parts.lines),
        "n_repeat_words": repeat_words(parts.words),
    }


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


@dataclass(frozen=True)
class Rule:
    """``rejects`` builds the rejecting condition from the document's parts."""

    name: str
    rejects: Callable[[Parts], Column]


def _repeats(parts: Parts) -> Column:
    return 100 * repeat_words(parts.words) > MAX_REPEAT_PERCENT * F.size(parts.words)


# Every condition is false, not null, on an empty text, but for the first.
RULES = (
    Rule("short", lambda p: F.size(p.words) < MIN_WORDS),
    Rule("symbols", lambda p: 10 * symbol_count(p.text) > F.size(p.words)),
    Rule("exclamations", lambda p: 2 * F.regexp_count(p.text, F.lit("!")) > F.size(p.words)),
    Rule("shouting", lambda p: 2 * F.regexp_count(p.text, F.lit(r"\p{Lu}")) > word_chars(p.text)),
    Rule("long_words", lambda p: word_chars(p.text) > 15 * F.size(p.words)),
    Rule("short_words", lambda p: word_chars(p.text) < 2 * F.size(p.words)),
    Rule("duplicate_lines", lambda p: 2 * duplicate_lines(p.lines) > F.size(p.lines)),
    Rule("repeats", _repeats),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def rejection_per_cost(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def ordered_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, text_col: str = "text"
) -> list[Rule]:
    """Rules by rejection per cost, from about ``sample_rows`` rows spread over the whole table.

    Each rule is timed on the cached sample, in one task as it would run in the
    cascade; the first measurement, which pays for compiling, is thrown away.
    Ties keep the given order. The order changes no verdict.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample, parts, _ = with_parts(docs.select(F.col(f"`{text_col}`")).sample(fraction=share, seed=7), text_col)
    # The scan keeps its tasks; only the sampled rows come together.
    sample = sample.repartition(1).persist()
    try:
        rows = max(sample.count(), 1)
        found = []
        for rule in (rules[0], *rules):
            started = time.perf_counter()
            rejected = sample.filter(rule.rejects(parts)).count()
            found.append(Measured(rule, time.perf_counter() - started, rejected / rows))
    finally:
        sample.unpersist()
    return [m.rule for m in sorted(found[1:], key=lambda m: -m.rejection_per_cost)]


def first_rejection(parts: Parts, rules: Sequence[Rule]) -> Column:
    """Name of the first rule, in the given order, that rejects; null where none does. Later ones are not tested."""
    verdict = F.when(rules[0].rejects(parts), rules[0].name)
    for rule in rules[1:]:
        verdict = verdict.when(rule.rejects(parts), rule.name)
    return verdict


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """The documents that no rule rejects, all columns as they were.

    Null and empty texts have no words and are rejected as short. Repeated rows
    are judged alike. An empty table stays empty. The verdict is per row, so
    nothing is shuffled.
    """
    rules = rules or ordered_rules(docs, text_col=text_col)
    cut, parts, extra = with_parts(docs, text_col)
    return cut.filter(first_rejection(parts, rules).isNull()).drop(*extra)
