import pytest

import __spark_entry__ as contract
import corpus_pipeline
from kerbside.llm import near
from kerbside.session import Workspace
from tests.llm.edge import SF_DIR, edge_docs, edge_rows, given, no_docs
from tests.llm.test_quality import brute_rejected

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents after each stage, each written and read again."""
    docs, found = given(spark), []
    with Workspace(spark) as work:
        for name, stage in corpus_pipeline.STAGES:
            docs = work.store(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
            found.append(docs)
        yield found


def test_stages_keep_the_columns(stages):
    assert all(frame.columns == COLUMNS for frame in stages[:-1])
    assert len(corpus_pipeline.STAGES) == 5


def test_each_stage_does_its_work(spark, stages):
    rules, exact, single, mix, packed = stages
    texts = [(r.doc_id, r.text) for r in given(spark).collect()]
    good = {i: t for i, t in texts if not brute_rejected(t)}
    assert {r.doc_id for r in rules.collect()} == set(good)
    last = {}
    for i, t in sorted(good.items()):
        last[t] = i
    assert {r.doc_id for r in exact.collect()} == set(last.values())
    with Workspace(spark) as work:
        classes, _, _ = near.near_classes(exact, work)
        assert single.count() == classes.select("class_id").distinct().count()
        assert {r.doc_id for r in single.collect()} == {r.class_id for r in classes.collect()}
    counts = {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert set(counts) <= {r.doc_id for r in single.collect()} and max(counts.values()) <= 2
    first = packed.filter("start = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in first} == counts


def test_run_is_the_stages_in_a_row(spark, stages):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.columns == stages[-1].columns
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert result.select(keys).exceptAll(stages[-1].select(keys)).count() == 0
    assert result.count() == stages[-1].count()


@pytest.mark.parametrize("docs", [no_docs, edge_docs])
def test_whole_pipeline_on_empty_and_awkward_tables(spark, tmp_path, docs):
    docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    rows = packed.collect()
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    good = {i for i, t, *_ in edge_rows() if not brute_rejected(t)} if docs is edge_docs else set()
    assert {r.doc_id for r in rows} <= good and bool(rows) == bool(good)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(end <= 1024 for end in ends.values())


def test_every_operator_has_its_query():
    names = contract.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
