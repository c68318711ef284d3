"""Mixing sources to target weights: repetition rates per source, one seeded coin per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import fresh_name, text_or_empty, word_count
from kerbside.session import Workspace

SEED = "mix-1"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
# Fixed value: a coin is the first 12 hexadecimal digits of a hash, over 16 to the power of 12.
_COIN_DIGITS = 12


def ranked_weights(totals: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``totals`` with a weight per source: the given ones in turn, sources by code point, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))


def source_targets(totals: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, weight -> the same with ``target`` and ``rate``.

    Targets are proportional to weights and stop at ``most`` times their source's
    size; what is cut goes to the others by weight, until none is above. Put in
    order of size per weight, the sources that stop are the first ones: with them
    taken out, the level of the rest is known; it rises up to the first source that it
    does not fill and falls after it. One row per source is sorted, no
    document. A source without words has target 0 and rate 0.
    """
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    cap = most * F.col("source_size")
    level = (share * F.col("all_words") - F.col("stopped")) / F.col("open_weight")
    levels = (
        totals.withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("stopped", F.coalesce(F.sum(cap).over(earlier), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(later))
        .withColumn("level", level)
        .withColumn("open", F.col("level") * F.col("weight") <= cap)
    )
    # Where every source stops there is no open one, and caps hold throughout.
    filled = levels.withColumn("level", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
    target = F.least(cap.cast("double"), F.col("level") * F.col("weight"))
    rate = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.col("target") / F.col("source_size"))
    return filled.select("source", "source_size", "weight", F.coalesce(target, cap.cast("double")).alias("target")).withColumn(
        "rate", rate
    )


def coin(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the key: reruns agree, whatever the order or the executors."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    digits = F.substring(F.sha2(text, 256), 1, _COIN_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(16.0**_COIN_DIGITS)


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    """floor(rate), plus one with the probability of the fraction."""
    whole = F.floor(rate)
    return whole + F.when(coin(key, seed) < rate - whole, 1).otherwise(0)


def planned_mix(
    docs: DataFrame,
    work: Workspace,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """id, source, size, source_size, target, rate and copies of every document.

    Sizes are words; a null or empty text has none. A null source is a source of
    its own, last in order. The coin depends on the id alone: rows that repeat an
    id are taken alike. An empty table gives no rows. Words are counted once and
    stored without the texts; totals are combined before the shuffle, so a source
    with a third of all rows costs one row a task.
    """
    sizes = work.store(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").alias("source"),
            word_count(text_or_empty(text_col)).alias("size"),
        ),
        "sizes",
    )
    targets = _stored_targets(sizes, work, weights, share, most)
    return (
        sizes.alias("s")
        .join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select(
            "id",
            "s.source",
            "size",
            "source_size",
            "target",
            "rate",
            copies(F.col("rate"), F.col("id"), seed).alias("copies"),
        )
    )


def _stored_targets(sizes: DataFrame, work: Workspace, weights: Sequence[int], share: float, most: int) -> DataFrame:
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    return work.store(source_targets(ranked_weights(totals, weights), share, most), "targets")


def mixed(
    docs: DataFrame,
    work: Workspace,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents as often as the mix takes them, all columns as they were."""
    sizes = docs.select(F.col(f"`{source_col}`").alias("source"), word_count(text_or_empty(text_col)).alias("size"))
    targets = _stored_targets(sizes, work, weights, share, most)
    rates = targets.select(F.col("source").alias("mix_source"), F.col("rate").alias("mix_rate"))
    times = fresh_name(docs, "times")
    source, key = F.col(f"d.`{source_col}`"), F.col(f"d.`{id_col}`")
    return (
        docs.alias("d")
        .join(rates.alias("r"), source.eqNullSafe(F.col("r.mix_source")))
        .select("d.*", copies(F.col("r.mix_rate"), key, seed).cast("int").alias(times))
        .filter(F.col(times) > 0)
        .withColumn(times, F.explode(F.array_repeat(F.lit(1), F.col(times))))
        .drop(times)
    )
