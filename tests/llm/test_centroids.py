import hashlib
import math
import random

import numpy as np
import pytest

from kerbside.llm import centroids
from kerbside.session import Workspace

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, vector string"


def brute(rows, clusters, rounds, seed, scale=centroids.SCALE):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    named = sorted((hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centres = [v for _, v in named[:clusters]]

    def place():
        gaps = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres] for _, v in kept]
        return [min((d, j) for j, d in enumerate(g)) for g in gaps]

    for _ in range(rounds):
        found = place()
        for j in range(len(centres)):
            mine = [v for (_, v), (_, k) in zip(kept, found, strict=True) if k == j]
            if mine:
                centres[j] = [sum(xs) // len(mine) for xs in zip(*mine, strict=True)]
    return sorted(((i, j, d) for (i, _), (d, j) in zip(kept, place(), strict=True)), key=repr), [tuple(c) for c in centres]


def clustered(spark, rows, clusters=4, rounds=5, dimensions=3):
    table = spark.createDataFrame([(i, v, "c", "d", "v") for i, v in rows], SCHEMA).repartition(3)
    with Workspace(spark, "t") as work:
        vectors = centroids.integer_vectors(table, dimensions)
        found = centroids.cluster_vectors(vectors, work, clusters, rounds, seed=7)
        told = centroids.with_cluster_facts(found)
        return found, sorted((tuple(r) for r in told.collect()), key=repr)


@pytest.mark.parametrize("rounds", [0, 1, 5])
def test_equals_brute_force(spark, rounds):
    rng = random.Random(rounds)
    rows = [(i % 50, [rng.gauss(i % 3, 0.4) for _ in range(3)]) for i in range(60)]
    rows += [(None, [0.25, -0.5, 0.125])] * 3 + [(70, [1.0, 1.0, 1.0])] * 40
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    found, told = clustered(spark, rows, rounds=rounds)
    want, centres = brute(rows, 4, rounds, 7)
    assert [t[:3] for t in told] == want and found.centroids == centres
    inertia = [sum(d for _, k, d in want if k == j) for j in range(4)]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    assert all(t[3:] == (inertia[t[1]], sum(inertia), digests[t[1]]) for t in told)


def test_leaves_out_what_is_no_vector(spark):
    good = [(1, [0.0, 0.0, 0.0]), (2, [-0.001, 0.0, 5.0])]
    bad = [(3, None), (4, []), (5, [1.0, 2.0]), (6, [1.0, None, 2.0]), (7, [1.0, float("nan"), 2.0]), (8, [1.0, float("inf"), 2.0])]
    found, told = clustered(spark, good + bad, clusters=9)
    assert [t[0] for t in told] == [1, 2] and len(found.centroids) == 2
    assert sorted(found.centroids) == [(-1, 0, 1280), (0, 0, 0)] and all(t[2] == 0 for t in told)


def test_no_vectors_and_equal_vectors(spark):
    found, told = clustered(spark, [(1, None)])
    assert not told and not found.centroids
    _, told = clustered(spark, [(i, [1.0, 2.0, 3.0]) for i in range(9)])
    assert [t[1:3] for t in told] == [(0, 0)] * 9


def test_refuses_components_that_would_not_be_exact(spark):
    with pytest.raises(Exception, match="is beyond"):
        clustered(spark, [(1, [1e30, 0.0, 0.0]), (2, [0.0, 0.0, 0.0])])


def test_rounds_send_one_row_per_cluster_and_task(spark):
    vectors = centroids.integer_vectors(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"))
    placed = centroids.assigned(vectors, [(0,) * 64, (1,) * 64])
    plan = placed.groupBy("cluster").count()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1 and "partial_count" in plan
