import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from kerbside.llm import packing, queries, records
from kerbside.llm.tokens import END_ID, TextEncoder
from kerbside.session import Workspace
from tests.llm.edge import edge_docs, edge_rows, given, no_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def work(spark):
    with Workspace(spark) as workspace:
        yield workspace


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@cases(st.lists(st.text(st.sampled_from("ab,.!'s é漢😀\n\t   \0\x1c9<|endoftext|>"), max_size=30), max_size=6))
def test_cut_encoding_is_the_whole_texts(texts):
    encoder = test_cut_encoding_is_the_whole_texts.__dict__.setdefault("encoder", TextEncoder(PATH, remembered=40))
    ids, counts = encoder.encode_batch(texts)
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts, ends, strict=True):
        assert ids[end - n : end].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_cuts():
    assert packing.cut(5, 10) == [(0, 5)] and packing.cut(10, 10) == [(0, 10)]
    assert packing.cut(23, 10) == [(0, 3), (3, 10), (13, 10)] and packing.cut(20, 10) == [(0, 10), (10, 10)]


@settings(max_examples=200, deadline=None)
@cases(st.lists(st.integers(1, 12), max_size=60))
def test_each_step_makes_the_sum_of_squares_smallest(lengths):
    packer, gaps, capacity = packing.Packer(12), [], 12

    def squares(found):
        counts = np.bincount([g for g in found if g], minlength=capacity + 1)
        return int((counts**2).sum())

    for n in lengths:
        options = [gaps[:i] + [g - n] + gaps[i + 1 :] for i, g in enumerate(gaps) if g >= n] + [[*gaps, capacity - n]]
        best = min(map(squares, options))
        sequence, offset = packer.place_by_squares(n)
        if sequence == len(gaps):
            gaps.append(capacity)
        assert offset == capacity - gaps[sequence]
        gaps[sequence] -= n
        assert gaps[sequence] >= 0 and squares(gaps) == best


def check_packed(packed, capacity):
    rows = packed.collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in own])
        assert [r.offset for r in own] == [0, *ends[:-1]] and ends[-1] <= capacity
    return rows, len(by_sequence)


def test_pieces_and_sequences(spark, work, whole):
    packed = packing.pack(packing.token_pieces(edge_docs(spark), PATH), work)
    rows, _ = check_packed(packed, packing.CAPACITY)
    texts = {}
    for doc_id, text, *_ in edge_rows():
        texts.setdefault(doc_id, []).append(np.array([*whole(text), END_ID], dtype="<u4"))
    want = sorted(
        ((i, p, s, n, zlib.crc32(ids[s : s + n].tobytes())) for i, all_ids in texts.items() for ids in all_ids
         for p, (s, n) in enumerate(packing.cut(len(ids)))), key=repr,
    )
    assert sorted(((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == want
    made = packing.sequences(packed).collect()
    assert all(len(s.ids) == 4 * s.n_tokens for s in made)
    one = max(rows, key=lambda r: r.offset)
    ids = next(s.ids for s in made if s.sequence_id == one.sequence_id)
    assert ids[4 * one.offset : 4 * (one.offset + one.length)] == one.ids


def test_shards_fill_nearly_all_of_their_sequences(spark, work):
    rng = np.random.default_rng(4)
    lengths = [int(n) for n in rng.integers(1, 1025, 6_000)]
    pieces = spark.createDataFrame([(n,) for n in lengths], "length long").repartition(4)
    for shard_pieces, waste in ((40_000, 1.02), (1_500, 1.03)):
        rows, n = check_packed(packing.pack(pieces, work, shard_pieces=shard_pieces), packing.CAPACITY)
        assert len(rows) == 6_000 and n <= waste * sum(lengths) / packing.CAPACITY


def test_empty_tables(spark, work, tmp_path):
    packed = packing.pack(packing.token_pieces(no_docs(spark), PATH), work)
    assert packed.count() == 0 and "sequence_id" in packed.columns
    path = work.path("files")
    records.write_records(no_docs(spark), path, PATH)
    assert records.with_starts(records.build_index(spark, path, work)).count() == 0


def test_records_round_trip_and_order(spark, work, whole):
    path = work.path("files")
    records.write_records(edge_docs(spark), path, PATH, file_bytes=4_000)
    index = records.with_starts(records.build_index(spark, path, work)).orderBy("start").collect()
    assert len({r.file for r in index}) > 2
    ids = [r.id for r in index]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i) and len(ids) == len(edge_rows())
    assert [r.start for r in index] == [0, *np.cumsum([r.n_tokens for r in index])[:-1]]
    want = sorted((-1 if i is None else i, [*whole(t), END_ID]) for i, t, *_ in edge_rows())
    chosen = records.build_index(spark, path, work)
    got = sorted((-1 if r.id is None else r.id, list(r.ids)) for r in records.read_at(chosen, path, work).collect())
    assert got == want
    some = records.read_at(chosen.filter("id IN (3, 18)"), path, work).collect()
    assert {r.id for r in some} == {3, 18}
    crc = {zlib.crc32(np.array(ids, dtype="<u4").tobytes()) for _, ids in want}
    assert {r.ids_crc32 for r in index} == crc


def test_damage_is_found():
    payload = records.payload_of(7, np.arange(5, dtype=np.uint32), 2)
    content = (records.framed(payload) + b"\n") * 2
    assert [records.parsed(p)[0] for _, p in records.frames(content)] == [7, 7]
    for at in range(len(content)):
        hurt = bytearray(content)
        hurt[at] ^= 1
        with pytest.raises(ValueError, match="damaged|cut off"):
            list(records.frames(bytes(hurt)))
    with pytest.raises(ValueError, match="cut off"):
        list(records.frames(content[:-1]))


def test_whole_given_table(spark, work, whole):
    docs = given(spark)
    want = {r.doc_id: np.array([*whole(r.text), END_ID], dtype="<u4") for r in docs.collect()}
    rows, n = check_packed(packing.pack(packing.token_pieces(docs, PATH, keep_ids=False), work), packing.CAPACITY)
    assert all(zlib.crc32(want[r.id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)
    assert n <= 1.02 * sum(map(len, want.values())) / packing.CAPACITY


def test_queries_give_the_ids_of_the_file_as_it_is(spark, tmp_path):
    texts = ["a b <|endoftext|> c", "one <|endoftext|>two", "plain words", "x<|endoftext|>", "  <|endoftext|>  <|endoftext|>"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(PATH)
    own = [[*tokenizer.encode(text, add_special_tokens=False).ids, END_ID] for text in texts]
    assert own[0] == [64, 275, 220, 50256, 269, END_ID]
    want = [(i, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for i, ids in enumerate(own)]
    docs = queries.documents(spark, str(tmp_path))
    for packed in (queries.op4_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.best_fit_packing(spark, docs, "")):
        assert sorted((r.doc_id, r.length, r.ids_crc32) for r in packed.collect()) == want
    index = queries.op6_token_records(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in index) == want
