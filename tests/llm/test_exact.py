import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kerbside.llm import exact
from kerbside.session import Workspace
from tests.llm.edge import edge_docs, edge_rows, no_docs


@pytest.fixture(scope="module")
def work(spark):
    with Workspace(spark) as workspace:
        yield workspace


def expected_groups():
    groups = defaultdict(list)
    for doc_id, text, *_ in edge_rows():
        groups[text or ""].append(doc_id)
    return groups


# With 4-bit digests unequal texts meet, and the byte check has to part them.
@pytest.mark.parametrize("digest", [exact.sha256_digest, lambda t: F.substring(F.sha2(t, 256), 1, 1)])
def test_groups_by_full_text(spark, work, digest):
    verdicts, located, locator = exact.exact_groups(edge_docs(spark), work, digest=digest)
    rows = verdicts.join(located.select(F.col(locator).alias("locator"), F.col("text")), "locator").collect()
    assert len(rows) == len(edge_rows())
    groups, kept = expected_groups(), defaultdict(list)
    for r in rows:
        ids = groups[r.text or ""]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (max(known) if known else None), r
        kept[r.text or ""].append(r.kept)
    assert all(k.count(True) == 1 for k in kept.values())


def test_digest_is_the_texts(spark, work):
    verdicts, _, _ = exact.exact_groups(edge_docs(spark), work)
    want = {hashlib.sha256(t.encode()).hexdigest() for t in expected_groups()}
    assert {r.digest for r in verdicts.select("digest").collect()} == want


def test_drop_copies_keeps_columns_and_one_row_each(spark, work):
    docs = edge_docs(spark)
    kept = exact.drop_copies(docs, work)
    assert kept.columns == docs.columns and kept.count() == len(expected_groups())
    assert kept.exceptAll(docs).count() == 0


def test_empty_table(spark, work):
    verdicts, _, _ = exact.exact_groups(no_docs(spark), work)
    assert verdicts.count() == 0 and exact.drop_copies(no_docs(spark), work).count() == 0


def test_state_goes_on_across_batches(spark, work):
    seen = exact.SeenTexts(spark, work.path("two"))
    schema = "id long, locator struct<file: string, row: long>, digest string"
    seen.ingest(spark.createDataFrame([(1, ("f", 0), "a"), (2, ("f", 1), "b"), (3, ("f", 2), "a")], schema))
    again = exact.SeenTexts(spark, seen.arrivals.removesuffix("/arrivals"))
    again.ingest(spark.createDataFrame([(9, ("g", 0), "a"), (0, ("g", 1), "b"), (5, ("g", 2), "c")], schema))
    state = {r.digest: (r.keep_id, r.keep_locator.file, r.group_size) for r in again.state().collect()}
    assert state == {"a": (9, "g", 3), "b": (2, "f", 2), "c": (5, "g", 1)}
