import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import trusted
from kerbside.llm.queries import op12_quality_classifier
from kerbside.session import Workspace
from tests.llm.edge import SF_DIR, edge_docs, edge_rows, given, no_docs, prose

SPACES = " \t\n\x0b\x0c\r"


def brute_measures(text):
    words = [w for w in "".join(" " if c in SPACES else c for c in text).split(" ") if w]
    solid = [c for c in text.encode() if chr(c) not in SPACES]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words)
    letters = [c for c in text if c.isascii() and c.isalpha()]

    def share(part, whole):
        return part / max(whole, 1)

    def among(chars):
        return sum(chr(c) in chars for c in solid)

    return {
        "log_words": np.log2(len(words) + 1),
        "word_bytes": share(len(solid), len(words)),
        "log_line_words": np.log2(len(words) / (text.count("\n") + 1) + 1),
        "symbols": share(among("#$%&*+/<=>@[\\]^_`{|}~"), len(solid)),
        "capitals": share(sum(c.isupper() for c in letters), len(letters)),
        "exclamations": share(among("!?"), len(words)),
        "digits": share(among("0123456789"), len(solid)),
        "stops": share(among(".,;:"), len(words)),
        "beyond_ascii": share(sum(c >= 128 for c in solid), len(solid)),
        "controls": share(sum(c < 32 or c == 127 for c in text.encode() if chr(c) not in "\t\n\r"), len(solid)),
        "distinct_words": share(len(set(words)), len(words)),
        "commonest_word": share(max((words.count(w) for w in set(words)), default=0), len(words)),
        "doubled_words": share(sum(a == b for a, b in zip(words, words[1:], strict=False)), len(words)),
        "repeated_runs": share(len(runs) - len(set(runs)), len(runs)),
    }


def test_measures_by_brute_force():
    texts = [t or "" for _, t, *_ in edge_rows() if len(t or "") < 10_000]
    found = trusted.measures([t.encode() for t in texts])
    for text, row in zip(texts, found, strict=True):
        want = brute_measures(text)
        assert row == pytest.approx([want[name] for name in trusted.STEPS]), text


def counted(spark):
    """Levels and trust of the given documents, as rows and as arrays."""
    docs, labels = given(spark), spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = trusted.with_trust(trusted.measured(docs), labels)
    local = rows.collect()
    reached = np.frombuffer(b"".join(bytes(r.levels) for r in local), dtype=np.uint8).reshape(len(local), -1)
    return rows, trusted.indicators(reached), np.array([r.trusted for r in local]), np.array([r.half for r in local])


def test_moments_are_the_counts_of_all_rows(spark):
    rows, steps, good, half = counted(spark)
    for i, found in enumerate(trusted.moments(rows)):
        every, positive = steps[half == i], steps[(half == i) & good]
        assert np.array_equal(found.unlabelled, every.T @ every) and np.array_equal(found.positive, positive.T @ positive)


def risk(weights, positive, unlabelled, prior, ridge):
    """The non-negative risk over the rows themselves."""
    f, g = positive @ weights, unlabelled @ weights
    negatives = np.mean((1 + g) ** 2) / 4 - prior * np.mean((1 + f) ** 2) / 4
    penalty = np.full(len(weights), ridge / min(len(positive), len(unlabelled)))
    penalty[0] = 1e-9
    return prior * np.mean((1 - f) ** 2) / 4 + max(0.0, negatives) + penalty @ weights**2 / 4, negatives


@pytest.mark.parametrize("prior", [0.3, 0.85, 0.99])
def test_fit_minimises_the_risk_over_rows(spark, prior):
    _, steps, good, _ = counted(spark)
    positive = steps[good]
    found = trusted.Moments(positive.T @ positive, steps.T @ steps)
    weights = trusted.non_negative_fit(found, prior)
    least, negatives = risk(weights, positive, steps, prior, trusted.RIDGE)
    assert negatives > -1e-9
    rng = np.random.default_rng(3)
    for size in (1e-3, 1e-2, 0.1):
        for _ in range(60):
            other = weights + rng.normal(0, size, len(weights))
            assert risk(other, positive, steps, prior, trusted.RIDGE)[0] >= least - 1e-9


def test_negative_part_is_held_at_zero():
    """More positives than the prior allows: the unbiased risk of negatives falls below zero, the fit keeps it there."""
    rng = np.random.default_rng(1)
    reached = rng.integers(0, 3, (400, len(trusted.STEPS))).astype(np.uint8)
    steps = trusted.indicators(reached)
    positive = steps[:380]
    found = trusted.Moments(positive.T @ positive, steps.T @ steps)
    weights = trusted.non_negative_fit(found, 0.999, ridge=0.01)
    assert abs(risk(weights, positive, steps, 0.999, 0.01)[1]) < 1e-6


def test_held_out_accuracy_and_prior(spark):
    docs, labels = given(spark), spark.read.parquet(f"{SF_DIR}/labels.parquet")
    with Workspace(spark, "t") as work:
        held_out = F.crc32(F.encode(F.col("id").cast("string"), "UTF-8")) % 4 == 2
        scores, model = trusted.quality_scores(docs, labels, held_out, work)
        rows = scores.filter(held_out).join(labels.withColumnRenamed("doc_id", "id"), "id").collect()
    right = [(r.score >= trusted.THRESHOLD) == (r.quality == 1) for r in rows]
    assert len(right) > 80 and np.mean(right) > 0.95
    assert abs(model.prior - labels.agg(F.avg("quality")).first()[0]) < 0.08


def test_query_scores_every_row(spark):
    rows = op12_quality_classifier(spark, SF_DIR).collect()
    assert len(rows) == given(spark).count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_edge_rows_empty_tables_and_odd_labels(spark):
    labels = spark.createDataFrame(
        [(1, 1, "x"), (2, 0, "x"), (2, 1, "x"), (7, 1, "x"), (7, None, "x"), (None, 1, "x"), (999, 1, "x"), (10, None, "x")],
        "doc_id long, quality int, levels string",
    )
    for docs in (edge_docs(spark), no_docs(spark)):
        for marks in (labels, labels.limit(0)):
            with Workspace(spark, "t") as work:
                scores, _ = trusted.quality_scores(docs, marks, F.col("id") == 3, work)
                found = scores.collect()
            assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
            if not marks.count():
                assert all(r.score == 0.5 for r in found)
    rows = trusted.with_trust(trusted.measured(edge_docs(spark)), labels)
    assert {r.id for r in rows.filter("trusted").collect()} == {1, 7}


def test_same_text_same_score_in_any_order(spark):
    docs = spark.createDataFrame([(i, prose(i % 7, 60)) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    runs = []
    for parts in (1, 5):
        with Workspace(spark, "t") as work:
            scores, _ = trusted.quality_scores(docs.repartition(parts), labels, F.lit(False), work)
            runs.append(sorted(map(tuple, scores.collect())))
    assert runs[0] == runs[1]
    assert all(score == runs[0][i % 7][1] for i, score in runs[0])
