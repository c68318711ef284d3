import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import toxicity, wordhash
from kerbside.session import Workspace
from tests.llm.edge import edge_docs, edge_rows, no_docs, prose

BAD = ["grobnak", "vilexu", "snarfoo"]


def text(seed, toxic, words=80):
    own = prose(seed, words).split()
    rng = random.Random(seed)
    if toxic:
        for at in rng.sample(range(words), 4):
            own[at] = rng.choice(BAD) if seed % 3 else f"grob{own[at]}"
    return " ".join(own)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text(i, i % 5 == 0), int(i % 5 == 0)) for i in range(1_500)]
    labelled = spark.createDataFrame(rows, "id long, text string, toxic int")
    with Workspace(spark) as work:
        yield toxicity.fit(labelled, work)


def test_held_out_accuracy(model):
    texts = [text(10_000 + i, i % 5 == 0) for i in range(500)]
    marked = np.array([i % 5 == 0 for i in range(500)])
    predicted = model.scores(texts) >= toxicity.THRESHOLD
    assert (predicted & marked).sum() >= 0.95 * marked.sum()
    assert (predicted & ~marked).sum() <= 0.02 * (~marked).sum()


def test_stems_reach_words_never_seen(model):
    unseen = [f"{prose(i, 40)} grobzuzuzu grobpelpel {prose(i + 1, 20)}" for i in range(70_000, 70_020)]
    assert (model.scores(unseen) >= toxicity.THRESHOLD).mean() >= 0.8


def test_every_row_has_a_score_that_only_the_text_decides(spark, model):
    rows = toxicity.scored(edge_docs(spark), model).collect()
    assert sorted((r.id for r in rows), key=repr) == sorted((r[0] for r in edge_rows()), key=repr)
    assert all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.id in (4, 5, 6)}
    assert len(empty) == 1 and toxicity.scored(no_docs(spark), model).count() == 0


def test_words_with_equal_counts_tell_nothing():
    word = np.array([1, 2, 3, 4], dtype=np.uint64)
    stems = [word, word, word]
    same = toxicity.kneser_ney_ratios(word, stems, [np.array([1, 2, 3, 1]), np.array([1, 2, 3, 1])])
    assert all(np.allclose(table.values, 0) and abs(passing) < 1e-12 for table, passing in same.levels)
    skewed = toxicity.kneser_ney_ratios(word, stems, [np.array([1, 0, 1, 1]), np.array([0, 1, 1, 1])])
    ratio = dict(zip(skewed.levels[0][0].keys.tolist(), skewed.levels[0][0].values, strict=True))
    assert ratio[1] > 0 > ratio[2] and abs(ratio[3]) < 1e-9


def test_without_labels(spark):
    none = spark.createDataFrame([], "id long, text string, toxic int")
    with Workspace(spark) as work:
        model = toxicity.fit(none, work)
        assert model.scores(["some words here", ""]).tolist() == [0.5, 0.5]


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.labelled_rows(docs, labels, F.col("id") == 2).collect()
    assert [(r.id, r.toxic) for r in rows] == [(1, 1)]


def test_every_labelled_row_counts(spark):
    """Beyond the 4,000 rows a class that were drawn before."""
    rows = [(i, f"same words own{i}", 0) for i in range(6_000)] + [(10_000 + i, f"same bad own{i}", 1) for i in range(40)]
    with Workspace(spark) as work:
        model = toxicity.fit(spark.createDataFrame(rows, "id long, text string, toxic int"), work)
        kept = spark.createDataFrame(rows, "id long, text string, toxic int").filter(
            F.pmod(F.xxhash64(F.lit("curve"), "id"), F.lit(5)) != 0
        )
        used = [tuple(r) for r in kept.collect()]
        words = {w for _, t, _ in used for w in t.split()}
        counted = model.counts.words.collect()
        assert len(counted) == len(words) > 4_100
        assert sum(r.ordinary for r in counted) == len({p for _, t, c in used if not c for p in zip(["", *t.split()], t.split())})
        assert sum(r.toxic for r in counted) == len({p for _, t, c in used if c for p in zip(["", *t.split()], t.split())})


def test_shards_give_the_ratios_of_the_whole():
    found = toxicity.words_in([prose(3, 3_000)])
    _, first = np.unique(found.word, return_index=True)
    rng = np.random.default_rng(1)
    counts = [rng.integers(0, 5, len(first)), rng.integers(0, 5, len(first))]
    word, stems = found.word[first], [x[first] for x in found.stems]
    whole, sizes = toxicity.kneser_ney_ratios(word, stems, counts), toxicity.model_sizes(word, stems, counts)
    for shard in range(3):
        own = stems[-1] % np.uint64(3) == shard
        part = toxicity.kneser_ney_ratios(word[own], [x[own] for x in stems], [c[own] for c in counts], sizes)
        for (table, passing), (all_of, all_passing) in zip(part.levels, whole.levels, strict=True):
            there, values = all_of.find(table.keys)
            assert there.all() and np.allclose(values, table.values) and passing == all_passing


def test_an_id_with_two_labels_is_toxic_in_any_order(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    marks = [(1, 0), (1, 1), (2, 0), (2, 0)]
    for order in (marks, marks[::-1]):
        labels = spark.createDataFrame(order, "doc_id long, toxic int").coalesce(1)
        rows = toxicity.labelled_rows(docs, labels, F.lit(False)).collect()
        assert sorted((r.id, r.toxic) for r in rows) == [(1, 1), (2, 0)]


def brute_ratios(labelled, asked):
    """Kneser-Ney by the book over plain strings: what each asked word says."""
    contexts = [{}, {}]
    for content, toxic in labelled:
        words = content.split()
        for before, word in zip(["", *words], words, strict=False):
            contexts[toxic].setdefault(word, set()).add(before)
    vocabulary = {*contexts[0], *contexts[1]}

    def stem(word, level):
        return word if not level else word.encode()[: toxicity.STEM_BYTES[level - 1]].decode()

    levels = len(toxicity.STEM_BYTES) + 1
    children = [{} for _ in range(levels)]
    for word in vocabulary:
        for level in range(1, levels):
            children[level].setdefault(stem(word, level), set()).add(stem(word, level - 1))
    shared = {}
    for word in vocabulary:
        shared[stem(word, levels - 1)] = shared.get(stem(word, levels - 1), 0) + 1 / (len(vocabulary) + 1)

    def model(seen):
        totals = [{w: len(seen.get(w, ())) for w in vocabulary}]
        for level in range(1, levels):
            totals.append({s: sum(totals[-1][c] > 0 for c in below) for s, below in children[level].items()})
        passing = []
        for counts in totals:
            total = max(sum(counts.values()), 1)
            passing.append(max(toxicity.DISCOUNT * sum(c > 0 for c in counts.values()), 1) / total)

        def probability(key, level):
            if level == levels - 1:
                lower = shared[key]
            else:
                parent = stem(key, level + 1)
                lower = probability(parent, level + 1) / len(children[level + 1][parent])
            total = max(sum(totals[level].values()), 1)
            return max(totals[level][key] - toxicity.DISCOUNT, 0) / total + passing[level] * lower

        return probability, passing, totals

    (ordinary, passing_o, totals), (toxic, passing_t, _) = model(contexts[0]), model(contexts[1])
    found = []
    for word in asked:
        said = 0.0
        for level in range(levels):
            if stem(word, level) in totals[level]:
                said += np.log(toxic(stem(word, level), level) / ordinary(stem(word, level), level))
                break
            said += np.log(passing_t[level] / passing_o[level])
        found.append(said)
    return np.array(found)


def test_counts_and_ratios_by_brute_force(spark):
    rows = [(prose(i % 25, 3 + i % 30) + (" grobnak grobber" if i % 4 == 0 else " grobbis"), int(i % 4 == 0)) for i in range(60)]
    asked = [*sorted({w for t, _ in rows for w in t.split()}), "grobzuzu", "lomika", "neverseen"]
    with Workspace(spark, "t") as work:
        labelled = spark.createDataFrame(rows, "text string, toxic int").repartition(4)
        counts = toxicity.count_words(labelled, work)
        ratios = toxicity.kneser_ney_ratios(*toxicity._arrays(counts.words.toArrow()), counts.sizes)
        said = ratios.of_words(toxicity.words_in([" ".join(asked)]))
        assert said == pytest.approx(brute_ratios(rows, asked), abs=1e-9)
        # Through blocks and shards: the mean of a text's words.
        docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "carried long, text string")
        means = {r.carried: r.mean for r in toxicity.with_evidence(docs, counts).collect()}
        for i, (content, _) in enumerate(rows):
            assert means[i] == pytest.approx(brute_ratios(rows, content.split()).mean(), abs=1e-5)


def test_shards_of_the_model_and_of_the_asked_words_agree(spark):
    stems = np.random.default_rng(5).integers(0, 2**64, 500, dtype=np.uint64)
    rows = spark.createDataFrame([(int(s.astype(np.int64)),) for s in stems], "stem_4 long")
    for n in (1, 7, 1000):
        dealt = toxicity.WordCounts(rows, np.zeros(0), None).shards(n).collect()
        assert [r.shard for r in dealt] == toxicity.shard_of(stems, n).tolist()
        assert (np.diff(toxicity.shard_of(np.sort(stems), n)) >= 0).all() and max(r.shard for r in dealt) < n


def test_hashing_holds_a_few_bytes_per_byte_of_text():
    """It held over forty, in each task's Python process."""
    data = [prose(i, 2_000).encode() for i in range(130)]
    toxicity.word_hashes(data[:1])
    tracemalloc.start()
    try:
        toxicity.word_hashes(data)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 20 * sum(map(len, data))


def test_hashes_do_not_depend_on_where_sums_start(monkeypatch):
    data = [b"", b" one two  three\n", "élan 漢字 two".encode(), b"x" * 50, b"", b"one " * 9, b"two"]
    for most_bytes in (None, 4):
        whole, per_text = wordhash.word_hashes(data, most_bytes)
        words = [w[:most_bytes] for t in data for w in t.split()]
        assert len({h: w for h, w in zip(whole.tolist(), words, strict=True)}) == len(set(words))
        for chunk in (1, 7, 30):
            with monkeypatch.context() as held:
                held.setattr(wordhash, "_CHUNK", chunk)
                hashes, counts = wordhash.word_hashes(data, most_bytes)
            assert hashes.tolist() == whole.tolist() and counts.tolist() == per_text.tolist()


def test_scores_take_one_python_process_a_task(spark, model):
    """Blocks are joined to their answers and scored in one step; a second one kept its own process beside the first."""
    found = toxicity.scored(edge_docs(spark), model)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InArrow") == 1
    evidence = toxicity.with_evidence(edge_docs(spark).selectExpr("locator as carried", "coalesce(text, '') as text"), model.counts)
    columns = [evidence.toPandas()[name] for name in ("mean", "middle", "excess")]
    assert sorted(model.curve(np.column_stack(columns))) == pytest.approx(sorted(r.score for r in found.collect()), abs=1e-12)


def test_texts_are_handed_over_a_block_at_a_time(spark):
    """Spark and Python held 10,000 whole texts each."""
    option, handed = "spark.sql.execution.arrow.maxBytesPerBatch", {}

    class Seen(Workspace):
        def store(self, df, name, **options):
            handed[name] = int(spark.conf.get(option).rstrip("b"))
            return super().store(df, name, **options)

    before = spark.conf.get(option)
    docs = spark.createDataFrame([(i, prose(i, 9), i % 2) for i in range(8)], "id long, text string, toxic int")
    with Seen(spark) as work:
        counts = toxicity.count_words(docs, work)
        assert toxicity.with_evidence(docs.select(F.col("id").alias("carried"), "text"), counts).count() == 8
    assert all(handed[name] <= toxicity.BATCH_CHARS for name in ("words", "blocks"))
    assert spark.conf.get(option) == before
