"""Benchmark leaks: planted passages, other numbers and names, chance likeness."""

import random

from studytrail.llm import decontaminate as D

ITEMS = "item_id long, text string, id long, window string"


def items_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], ITEMS)


def word(rng):
    return "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def found(spark, make_docs, docs, items):
    return {(r.doc_id, r.item_id): r for r in D.leaks(make_docs(docs), items_of(spark, items)).collect()}


QUESTION = "If Anna walks 12 km to the market and then Anna walks 5 km back along the river, how far did Anna walk?"


def test_planted_passages(spark, make_docs):
    rng = random.Random(1)
    items = [(i, prose(rng, rng.randrange(15, 60))) for i in range(30)]
    docs = [(i, prose(rng, 200)) for i in range(60)]
    docs += [(100 + i, f"{prose(rng, 80)} {text} {prose(rng, 40)}") for i, text in items]
    docs += [(200 + i, f"{prose(rng, 30)}\n{text.upper()}!! {prose(rng, 10)}") for i, text in items[:5]]
    got = found(spark, make_docs, docs, items)
    # A text all in capitals reads as names and is told apart from words; it is no leak here.
    assert {k for k in got if k[0] < 200} == {(100 + i, i) for i, _ in items}
    assert all(r.kind == "verbatim" for r in got.values())


def test_windows_equal_brute_force(spark, make_docs):
    rng = random.Random(7)
    pool = [word(rng) for _ in range(40)]
    items = [(i, " ".join(rng.choice(pool) for _ in range(12))) for i in range(12)]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(30))) for i in range(20)]
    for i, text in items:
        cut = text.split()
        docs += [(100 + i, " ".join([*docs[i][1].split(), *cut[: rng.randrange(12)]]))]
    got = {k: r.n_windows for k, r in found(spark, make_docs, docs, items).items()}
    grams = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    want = {}
    for d, text in docs:
        for i, item in items:
            n = len(grams(text) & grams(item))
            if n * 100 >= 40 * 8:
                want[(d, i)] = n
    assert got == want


def test_other_numbers_and_names(spark, make_docs):
    other = QUESTION.replace("Anna", "Bob").replace("12 km", "7 miles").replace("5 km", "30 miles")
    # One item value, two document values: the windows are alike, the question is not.
    mixed = "If Eva walks 12 km to the market and then Max walks 5 km back along the river, how far did Tim walk?"
    got = found(spark, make_docs, [(1, f"intro words here. {QUESTION}"), (2, other), (3, "nothing of the kind at all")], [(1, QUESTION)])
    assert {k: r.kind for k, r in got.items()} == {(1, 1): "verbatim", (2, 1): "reparameterised"}
    assert (4, 1) not in found(spark, make_docs, [(4, mixed)], [(1, QUESTION)])


def test_one_changed_number_does_not_hide_a_passage(spark, make_docs):
    rng = random.Random(5)
    a, b, c = prose(rng, 60), prose(rng, 80), prose(rng, 60)
    pens = "a shop sells 2 pens for every customer who buys 2 books during the long summer sale in town"
    items = [(1, f"{a} 2 {b} 2 {c}"), (2, pens), (3, f"{a} then Anna {b}  and Anna {c}")]
    docs = [(1, f"{prose(rng, 30)} {a} 2 {b} 3 {c}"), (2, pens.replace("2 pens", "3 pens").replace("2 books", "4 books"))]
    docs.append((3, f"{a} then Max {b} and Tim {c}"))
    got = found(spark, make_docs, docs, items)
    # Five windows hold the changed number; the other occurrence keeps the item's own.
    assert (got[1, 1].item_windows, got[1, 1].n_windows, got[1, 1].kind) == (198, 193, "verbatim")
    # One of two meanings of the item's 2 stays.
    assert got[2, 2].n_windows < got[2, 2].item_windows and got[2, 2].kind == "reparameterised"
    # Two persons for one: the windows without a name stay.
    assert got[3, 3].item_windows - got[3, 3].n_windows == 10


def test_placeholders_alone_do_not_match(spark, make_docs):
    items = [(1, "12 km 5 km 7 km 8 km 9 km"), (2, "so Anna Berta Clara Dora Emma Frida Greta")]
    assert found(spark, make_docs, [(1, "1 km 2 km 3 km 4 km 5 km 6 km"), (2, "then Paul Otto Max Udo Kai Jan Tim")], items) == {}


def test_edges(spark, make_docs):
    items = [(1, "only four words here"), (2, None), (3, ""), (None, "no id but words in a row"), (4, "!!! ... ???")]
    items.append((1, "only four words here"))
    docs = [(1, "they are only four words here indeed"), (2, None), (3, ""), (None, "only four words here"), (4, "no id but words in a row")]
    docs.append((1, "they are only four words here indeed"))
    got = D.leaks(make_docs(docs), items_of(spark, items)).collect()
    assert [(r.doc_id, r.item_id, r.item_windows, r.n_windows, r.kind) for r in got] == [(1, 1, 1, 1, "verbatim")]
    left = D.clean(make_docs(docs), items_of(spark, items))
    assert sorted((r.doc_id for r in left.collect()), key=str) == [2, 3, 4, None]
    assert left.columns == make_docs(docs).columns
    assert D.leaks(make_docs([]), items_of(spark, items)).collect() == []
    assert D.leaks(make_docs(docs), items_of(spark, [])).collect() == []
    assert D.clean(make_docs(docs), items_of(spark, [])).count() == len(docs)


def test_without_the_filter(spark, make_docs, monkeypatch):
    monkeypatch.setattr(D, "FILTER_WINDOWS", 0)
    got = found(spark, make_docs, [(1, f"intro words here. {QUESTION}"), (2, "x y z " * 50)], [(1, QUESTION)])
    assert set(got) == {(1, 1)}


def test_long_text_is_whole(spark, make_docs):
    rng = random.Random(3)
    item = prose(rng, 20)
    got = found(spark, make_docs, [(1, prose(rng, 60_000) + " " + item)], [(5, item)])
    assert set(got) == {(1, 5)}
