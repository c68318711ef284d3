import zlib

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbside.llm import mixing, sharding
from kerbside.session import Workspace
from tests.llm.edge import edge_docs, edge_rows, given, no_docs


@pytest.fixture(scope="module")
def work(spark):
    with Workspace(spark) as workspace:
        yield workspace


def filled_by_hand(sizes, weights, share, most):
    """Pour in small steps: stop full sources, give what is left to the others by weight."""
    targets, left, room = [0.0] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while left > 1e-9 and room:
        level, weight = left, sum(weights[i] for i in room)
        left = 0.0
        for i in sorted(room):
            targets[i] += level * weights[i] / weight
            if targets[i] >= most * sizes[i]:
                left += targets[i] - most * sizes[i]
                targets[i] = most * sizes[i]
                room = room - {i}
    return targets


@pytest.mark.parametrize("sizes", [[10, 1000, 20, 5], [0, 0, 3], [7], [0], [1, 1, 1, 1, 10_000], [5, 5, 5, 5, 5, 5]])
def test_targets_by_hand(spark, sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    rows = [(f"s{i}", n, w) for i, (n, w) in enumerate(zip(sizes, weights, strict=True))]
    totals = spark.createDataFrame(rows, "source string, source_size long, weight int")
    got = {r.source: r.target for r in mixing.source_targets(totals).collect()}
    for i, want in enumerate(filled_by_hand(sizes, weights, mixing.SHARE, mixing.MOST)):
        assert got[f"s{i}"] == pytest.approx(want)


def test_plan_and_mix_agree(spark, work):
    for docs in (edge_docs(spark), given(spark)):
        planned = mixing.planned_mix(docs, work)
        rows = planned.collect()
        assert len(rows) == docs.count() and all(r.copies <= 2 for r in rows)
        made = mixing.mixed(docs, work)
        assert made.columns == docs.columns
        assert made.count() == sum(r.copies for r in rows)
        once = made.groupBy("doc_id").count().groupBy().sum("count").first()[0]
        assert once == sum(r.copies for r in rows)
        again = mixing.planned_mix(docs.repartition(7), work)
        assert planned.exceptAll(again).count() == 0
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, [r.target, 0, 0.0])
        by_source[r.source][1] += r.copies * r.size
        by_source[r.source][2] += r.size**2 / 4
    for target, taken, variance in by_source.values():
        assert abs(taken - target) <= 4 * variance**0.5 + 1


def test_sources_in_code_point_order_null_last(spark):
    totals = spark.createDataFrame([(s, 1) for s in ("s10", "s2", None, "é", "S")], "source string, source_size long")
    got = {r.source: r.weight for r in mixing.ranked_weights(totals).collect()}
    assert got == {"S": 3, "s10": 1, "s2": 2, "é": 3, None: 1}


def test_empty_mix(spark, work):
    assert mixing.planned_mix(no_docs(spark), work).count() == 0 and mixing.mixed(no_docs(spark), work).count() == 0


@settings(max_examples=60, deadline=None)
@cases(st.integers(1, 3_000), st.integers(0, 5))
def test_permutation_is_a_bijection(n, seed):
    permutation, numbers = sharding.Permutation(n, seed), np.arange(n)
    places = permutation.forward(numbers)
    assert np.array_equal(np.sort(places), numbers)
    assert np.array_equal(permutation.inverse(places), numbers)


def test_shards_are_even_and_gapless(spark, work):
    for docs in (edge_docs(spark), given(spark)):
        placed = sharding.shard_rows(docs, work)
        rows = placed.collect()
        sizes = np.bincount([r.shard for r in rows], minlength=8)
        assert len(rows) == docs.count() and sizes.max() - sizes.min() <= 1
        for shard in range(8):
            assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))
        again = sharding.shard_rows(docs.repartition(7), work)
        assert placed.drop("row_number").exceptAll(again.drop("row_number")).count() == 0
        back = sharding.row_number_at(F.col("shard"), F.col("slot"), len(rows))
        assert placed.filter(back != F.col("row_number")).count() == 0
    assert sharding.shard_rows(no_docs(spark), work).count() == 0


def test_sizes_and_checksums(spark, work):
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows()), key=repr)
    rows = sharding.shard_rows(edge_docs(spark), work).collect()
    assert sorted(((r.id, r.size, r.text_crc32) for r in rows), key=repr) == want


def brute_place(number, n, seed):
    """The network in plain integers: whole words of 64 bits, one value at a time."""
    word = (1 << 64) - 1
    bits = max(2, (n - 1).bit_length())
    low_bits, high_bits = bits // 2, bits - bits // 2
    keys = [int(k) for k in np.random.SeedSequence(seed).generate_state(sharding.ROUNDS, np.uint64)]

    def mixed(value, key):
        x = (value * 0x9E3779B97F4A7C15 + key) & word
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & word
        return x ^ (x >> 29)

    x = number
    while True:
        high, low = x >> low_bits, x & ((1 << low_bits) - 1)
        for i, key in enumerate(keys):
            if i % 2:
                low ^= mixed(high, key) & ((1 << low_bits) - 1)
            else:
                high ^= mixed(low, key) & ((1 << high_bits) - 1)
        x = (high << low_bits) | low
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1_000])
def test_permutation_by_plain_integers(n):
    for seed in (0, sharding.SEED):
        assert sharding.Permutation(n, seed).forward(np.arange(n)).tolist() == [brute_place(i, n, seed) for i in range(n)]


def test_whole_table_by_brute_force(spark, work):
    rows = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in given(spark).select("doc_id", "text").collect()]
    places = {row: brute_place(number, len(rows), sharding.SEED) for number, row in enumerate(sorted(rows))}
    assert len(places) == len(rows)
    want = {row: (place % 8, place // 8) for row, place in places.items()}
    placed = sharding.shard_rows(given(spark), work).collect()
    assert {(r.id, r.size, r.text_crc32): (r.shard, r.slot) for r in placed} == want
