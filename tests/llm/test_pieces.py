import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from studytrail.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab c  e.▁\n\t\x00ä漢字😀é́�​<s></s><0x0A> [INST]thetion123"


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(MODEL)


def random_texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randrange(80))) for _ in range(n)]


def test_ids_equal_the_library(coder):
    texts = ["", " ", "   ", "a", *random_texts(1, 4000)]
    assert [ids.tolist() for ids in coder.encode(texts)] == coder.library.encode(texts)


def test_heap_equals_matrix(coder):
    parts = [p for t in random_texts(2, 2000) for p in coder.parts(t) if len(p) <= pieces.IN_STEP]
    assert coder.in_step(parts) == {p: coder._ids(p, coder.by_heap(p)) for p in parts}


def test_long_parts(coder):
    r = random.Random(3)
    text = "abcdefghij" * 500 + "".join(r.choice("abcdefghijklmnop") for _ in range(40_000))
    assert coder.encode([text])[0].tolist() == coder.library.encode(text)


def test_parts_are_independent(coder):
    text = "Über allen Gipfeln ist Ruh,\n  in allen  Wipfeln 123"
    assert "".join(coder.parts(text)) == coder.library.normalize(text)
    assert len(coder.parts(text)) > 8


def test_texts_of_a_run_do_not_join(coder):
    """The ends of neighbouring texts would be one piece; empty texts on both sides."""
    for texts in ([], [""], ["", "", "the"], ["", "a", "", "nd", "", ""], ["th", "e", "漢", "😀", "", "字"], random_texts(7, 300)):
        assert [ids.tolist() for ids in coder.encode(texts)] == coder.library.encode(texts)
        parts, first = coder.cut(texts)
        assert first.tolist() == np.cumsum([0, *[len(coder.parts(t)) for t in texts]]).tolist()
        assert parts.to_pylist() == [p for t in texts for p in coder.parts(t)]


def test_each_different_part_of_a_run_is_looked_up_once():
    """However often a part stands in the texts, a run asks for it a fixed number of times."""

    class Counted(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            self.asked += 1
            return super().__contains__(key)

    model = pieces.PieceCoder(MODEL)
    model.young = young = Counted()
    texts = ["the cat and the dog " * 200] * 3
    different = len({p for t in texts for p in model.parts(t)})
    assert [ids.tolist() for ids in model.encode(texts)] == model.library.encode(texts)
    assert young.asked <= 2 * different


def test_few_remembered_parts():
    small = pieces.PieceCoder(MODEL, remembered=3)
    for texts in (["one two three four five"], ["two six"], ["one two three"], ["seven"]):
        assert [i.tolist() for i in small.encode(texts)] == small.library.encode(texts)


def test_any_ids_decode_as_the_library_does(coder):
    """Broken bytes, control ids between bytes, leading marks."""
    r = random.Random(4)
    pick = lambda: r.choice([0, 1, 2, r.randrange(3, 259), r.randrange(3, 259), r.randrange(259, 32_000), 28_705, 259])
    for _ in range(5000):
        ids = [pick() for _ in range(r.randrange(8))]
        assert coder.decode(np.array(ids, np.int32)) == coder.library.decode(ids), ids


def test_runs_of_ids_decode_as_one_by_one(coder):
    r = random.Random(8)
    pick = lambda: r.choice([0, 1, 2, r.randrange(3, 259), r.randrange(3, 259), r.randrange(259, 32_000), 28_705, 259])
    for n in (0, 1, 3, 500):
        many = [np.array([pick() for _ in range(r.randrange(8))], np.int32) for _ in range(n)]
        flat = np.concatenate([np.empty(0, np.int32), *many])
        got = coder.decode_all(flat, np.array([len(ids) for ids in many], np.int32))
        assert got == [coder.decode(ids) for ids in many] == [coder.library.decode(ids.tolist()) for ids in many]


def test_runs_of_null_empty_and_sliced_lists():
    lists = pa.array([[9], [1, 2], None, [], [3]], pa.list_(pa.int32()))
    ids, counts = pieces.runs_of(lists.slice(1))
    assert (ids.tolist(), counts.tolist()) == ([1, 2, 3], [2, 0, 0, 1])


def test_rows(make_docs):
    texts = [None, "", "Hello wörld", "Hello wörld", " two  spaces ", "漢字 \x00 ▁", "x" * 5000, *random_texts(5, 60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (2, "Hello wörld")]
    docs = make_docs(rows)
    library = pieces.coder(MODEL).library
    back = pieces.decoded(pieces.encoded(docs.repartition(3), MODEL), MODEL).collect()
    want = sorted((i is None, i or 0, [*library.encode(t or ""), 2], library.decode([*library.encode(t or ""), 2])) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids, r.text) for r in back) == want
    assert all(r.agreed for r in back)
    assert {r.agreed for r in pieces.encoded(docs, MODEL, checked=False).collect()} == {None}


def test_runs_keep_every_text(monkeypatch):
    monkeypatch.setattr(pieces, "AT_ONCE", 10)
    texts = pa.array(["a" * 4, None, "b" * 30, "", "c" * 5, "d" * 5, "e"])
    assert [t for some in pieces.runs(texts) for t in some.to_pylist()] == texts.to_pylist()
    assert len(list(pieces.runs(texts))) == 4


def test_query_digests(make_docs):
    import hashlib

    library = pieces.coder(MODEL).library
    text = "Ein Text, 漢字 und <0x0A>\n"
    ids = [*library.encode(text), 2]
    (row,) = pieces.token_digests(make_docs([(7, text)]), MODEL).collect()
    assert (row.doc_id, row.n_tokens, row.agreed) == (7, len(ids), True)
    assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_empty_table(make_docs):
    assert pieces.token_digests(make_docs([]), MODEL).collect() == []


def test_agreement_is_counted(make_docs):
    assert pieces.disagreements(make_docs([(i, t) for i, t in enumerate(random_texts(6, 50))]), MODEL) == {True: 50}
