import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hitloom.llm import packing

TOKENIZER = Tokenizer.from_file(packing.default_tokenizer())


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


@given(st.integers(0, 100_000), st.sampled_from([1, 8, 2048]))
def test_piece_lengths(tokens, length):
    pieces = packing.piece_lengths(tokens, length)
    assert sum(pieces) == tokens and all(p & (p - 1) == 0 and p <= length for p in pieces) and pieces == sorted(pieces, reverse=True)
    assert len([p for p in pieces if p < length]) == len({p for p in pieces if p < length})


ENCODE = packing.id_bytes(packing.default_tokenizer())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t 　\x1c\0a'sBé9!.ß中<|>"), max_size=40), max_size=4))
def test_pieces_encode_as_whole_texts_do(texts):
    texts = [*texts, *(" ".join(t.split()) for t in texts), "ab cd's\nEf 12,3 <|endoftext|>", "a<|endoftext|>b", "it's we'll ' s", ""]
    assert [np.frombuffer(b, "<u4").tolist() for b in map(ENCODE, texts)] == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


def test_edge_documents(edge_docs, edge_rows):
    rows = packing.pack(edge_docs, length=64).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows))) and all(r.offset == 0 for r in rows)
    by_length = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert by_length == sorted(by_length)
    want = Counter()
    for doc, text, *_ in edge_rows:
        ids, at = np.array(ids_of(text), "<u4"), 0
        for n in packing.piece_lengths(len(ids), 64):
            want[doc, at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids)] += 1
            at += n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want


def test_ids_round_trip(edge_docs, edge_rows):
    got = defaultdict(list)
    for r in packing.token_pieces(edge_docs.where("doc_id >= 4 and doc_id <= 8"), keep_ids=True).collect():
        got[r.doc_id].append((r.start, r.ids))
    for doc, text, *_ in edge_rows:
        if doc in (4, 5, 6, 7, 8):
            ids = [i for _, part in sorted(got[doc]) for i in part]
            assert ids[-1] == 1 and TOKENIZER.decode(ids[:-1]) == text


def test_numbers_agree_over_partitions_and_empty(edge_docs, no_docs):
    key = lambda df: sorted((r.sequence_id, r.length, r.ids_crc32) for r in df.collect())
    assert key(packing.pack(edge_docs)) == key(packing.pack(edge_docs.repartition(9)))
    assert packing.pack(no_docs).count() == 0


def test_a_worker_without_packing_tasks_forgets_its_pieces():
    import time

    path = packing.default_tokenizer()
    packing._begin(path)
    packing._begin(path)
    before = packing.id_bytes(path)("some words here")
    state = packing._remembered(path)
    packing._end(path, 0.01)
    time.sleep(0.2)
    assert state.recent                     # another task still packs
    packing._end(path, 0.01)
    time.sleep(0.5)
    assert not state.recent and not state.older
    assert packing.id_bytes(path)("some words here") == before


def test_a_batch_looks_up_each_different_piece_once(monkeypatch):
    class Counting(dict):
        asked = 0

        def get(self, *key):
            Counting.asked += 1
            return super().get(*key)

    state = packing._remembered(packing.default_tokenizer())
    monkeypatch.setattr(state, "recent", Counting())
    text = " ".join(["the word, and the line\nends"] * 1000)
    want = TOKENIZER.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODE(text), "<u4").tolist() == want
    assert Counting.asked <= 30


def test_texts_of_a_batch_encode_as_each_alone():
    texts = ["", "one text", "", "", " led by a space", "other text, one", "two  spaces", "É, é's l'été 1a a1 x\u0660 don't.", "a\0b", "", "z\n", "last one\nof all", ""]
    assert any(len(texts[a:b]) > 1 for a, b in packing._parts(pa.array([t.encode() for t in texts], pa.large_binary()), 20))
    batch = pa.array([b"before", *(t.encode() for t in texts)], pa.large_binary()).slice(1)
    ids_of = packing.ids_of_texts(packing.default_tokenizer())
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in ids_of(batch)] == want
    assert [np.frombuffer(b, "<u4").tolist() for a, b in packing._parts(batch, 20) for b in ids_of(batch.slice(a, b - a))] == want
    assert ids_of(batch.slice(0, 0)) == [] and [bytes(b) for b in ids_of(batch.slice(2, 2))] == [b"", b""]
