import random

import numpy as np
import pytest

from kerbside.llm import near
from kerbside.session import Workspace
from tests.llm.edge import edge_docs, edge_rows, given, no_docs, prose


@pytest.fixture(scope="module")
def work(spark):
    with Workspace(spark) as workspace:
        yield workspace


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def classes_by_hand(rows):
    """Smallest id per row, from all pairs; rows are (id, text)."""
    texts = {}
    for k, (_, text) in enumerate(rows):
        texts.setdefault(tuple((text or "").encode().split()), []).append(k)
    lists = list(texts.items())
    shingles = [near.shingle_list(b" ".join(words).decode()) for words, _ in lists]
    sets, parent = [set(s) for s in shingles], list(range(len(lists)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(lists)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and shared >= 0.5 * max(len(sets[i]), len(sets[j])):
                both = common(shingles[i], shingles[j])
                if both >= 0.8 * (len(shingles[i]) + len(shingles[j]) - both):
                    parent[root(i)] = root(j)
    members = {}
    for i, (_, own) in enumerate(lists):
        members.setdefault(root(i), []).extend(own)
    found = {}
    for own in members.values():
        ids = [rows[k][0] for k in own if rows[k][0] is not None]
        for k in own:
            found[k] = (min(ids) if ids else None, len(own))
    return sorted(((rows[k][0], *v) for k, v in found.items()), key=repr)


def test_banded_alignment_by_brute_force():
    rng = random.Random(5)
    for _ in range(1_500):
        a = [rng.randint(0, 30) for _ in range(rng.randint(0, 30))]
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = [rng.randint(0, 30)] * rng.randint(0, 1)
        both, total = common(a, b), len(a) + len(b)
        assert near.common_in_band(a, b, total - 2 * both) == both
        assert near.similar(a, b) == (both >= 0.8 * (total - both) - 1e-9)


def test_edge_documents(spark, work):
    classes, _, _ = near.near_classes(edge_docs(spark), work)
    got = sorted(((r.id, r.class_id, r.class_size) for r in classes.collect()), key=repr)
    assert got == classes_by_hand([r[:2] for r in edge_rows()])


def test_whole_given_table(spark, work):
    docs = given(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    classes, _, _ = near.near_classes(docs, work)
    assert sorted(((r.id, r.class_id, r.class_size) for r in classes.collect()), key=repr) == classes_by_hand(rows)


def test_copies_of_a_base_and_documents_around_a_passage(spark, work):
    """Copies resemble their base more than each other; a shared passage alone links nothing."""
    rng, base, passage = random.Random(8), prose(20, 200).split(), prose(21, 150)
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        words = list(base)
        for at in rng.sample(range(200), 3):
            words[at] = f"w{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1_000 + i, f"{prose(100 + i, 120)} {passage} {prose(400 + i, 120)}") for i in range(150)]
    classes, _, _ = near.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), work)
    found = {r.id: (r.class_id, r.class_size) for r in classes.collect()}
    assert all(found[i] == (0, 150) for i in range(150))
    assert all(found[1_000 + i] == (1_000 + i, 1) for i in range(150))


def test_chains_become_one_class(spark, work):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200)], "a long, b long")
    roots = {r.row: r.root for r in near.components(links, work).collect()}
    assert all(roots[i] == 0 for i in range(61)) and roots[200] == 100 and len(roots) == 63


def test_drop_near_copies_keeps_columns(spark, work):
    docs = edge_docs(spark)
    kept = near.drop_near_copies(docs, work)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    classes, _, _ = near.near_classes(docs, work)
    assert kept.count() == classes.select("class_row").distinct().count() == classes.filter("kept").count()
    assert near.drop_near_copies(no_docs(spark), work).count() == 0


def test_short_texts_meet_their_near_copies(spark, work):
    """Texts with so few 5-grams that no key of five can be equal, or that keys miss now and then."""
    rows = []
    for i, n in enumerate([*range(8, 30), *[9] * 20, 40, 53]):
        words = [f"w{i}x{j}" for j in range(n)]
        rows += [(4 * i, " ".join(words)), (4 * i + 1, " ".join([*words, "more"])), (4 * i + 2, " ".join(["more", *words]))]
    rows += [(900 + i, f"same stock phrase of many short texts {prose(i, 2)} {i}") for i in range(60)]
    classes, _, _ = near.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), work)
    assert sorted(((r.id, r.class_id, r.class_size) for r in classes.collect()), key=repr) == classes_by_hand(rows)


def test_tiles_tell_all_shingles_apart(spark):
    """Among 300,000 5-grams some agree in 32 bits of their hashes."""
    text = " ".join(f"w{i}" for i in range(300_000))
    row = near._hashed_shingles(spark.createDataFrame([(1, text)], "row long, text string")).first()
    assert len(set(np.frombuffer(row.hashes, dtype=np.uint64).tolist())) == 299_996
