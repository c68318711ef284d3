import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from kerbside.llm import infill
from tests.llm.edge import edge_docs, edge_rows, given, no_docs


def brute(text, draws):
    n = len(text)
    a, b = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def draws_of(doc_id):
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1 << 20])
def test_blocks_equal_brute_force_whatever_the_step(step):
    rng = random.Random(step)
    for _ in range(150):
        texts = ["".join(rng.choices("ab<PSM>é漢😀 ", k=rng.choice([0, 0, 1, 2, 5, 30]))) for _ in range(rng.randint(0, 9))]
        draws = np.array([[rng.getrandbits(32) for _ in range(4)] for _ in texts], dtype=np.int64).reshape(-1, 4)
        found = infill.infilled(infill.Texts.of(pa.array(texts, pa.string())), draws, step)
        outputs = found.outputs.column().to_pylist()
        for i, text in enumerate(texts):
            n, form, prefix, middle, output = brute(text, draws[i].tolist())
            assert (found.n[i], infill.FORMS[found.form[i]], outputs[i]) == (n, form, output)
            assert form == "plain" or (found.prefix[i], found.middle[i]) == (prefix, middle)
        assert infill.restored(found.outputs, found.form, step).column().to_pylist() == texts


def test_whole_tables_by_brute_force(spark):
    for docs in (edge_docs(spark), given(spark)):
        rows = infill.with_restored(infill.rearranged(docs)).collect()
        want = [(i, *brute(t or "", draws_of(i)), t or "") for i, t in docs.select("doc_id", "text").collect()]
        assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert len({r.form for r in rows}) == 3


def test_texts_with_marks_stay_plain_and_part_marks_do_not(spark):
    texts = ["a <S> b", "<P>", "<<P", "<M", "S>", "<S<M P>"] * 20
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = infill.with_restored(infill.rearranged(docs)).collect()
    assert sorted((r.id, r.restored) for r in rows) == list(enumerate(texts))
    assert all((r.form == "plain") >= any(m in texts[r.id] for m in ("<P>", "<S>", "<M>")) for r in rows)


def test_long_text_and_empty_table(spark):
    text = "漢字 and <P some more é " * 300_000
    docs = spark.createDataFrame([(5, text)], "doc_id long, text string")
    row = infill.with_restored(infill.rearranged(docs)).first()
    assert tuple(row)[:6] == (5, *brute(text, draws_of(5))) and row.restored == text
    assert infill.with_restored(infill.rearranged(no_docs(spark))).count() == 0


def test_damaged_outputs_are_refused():
    outputs = infill.Texts.of(pa.array(["<P>a<S>b<M>c"]))
    with pytest.raises(ValueError, match="do not fit"):
        infill.restored(outputs, np.array([2]))
    with pytest.raises(ValueError, match="one mark of each kind"):
        infill.restored(infill.Texts.of(pa.array(["<P>a<S>b c"])), np.array([1]))


def test_edge_rows_cover_every_form():
    assert {brute(t or "", draws_of(i))[1] for i, t, *_ in edge_rows()} >= {"plain", "psm"}
