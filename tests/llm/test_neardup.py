"""Near duplicates against all pairs of shingle sets."""

import random
from itertools import combinations

import numpy as np
import pytest

from studytrail.llm import neardup as N


def plain_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: plain_set(t) for i, t in rows}
    label = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
            lo, hi = sorted((label[a], label[b]))
            label = {k: lo if v == hi else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(df).collect()}


def noisy(rng, words, share):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words)


def corpus(seed=3, cluster=150):
    """Exact copies, near copies whose similarity straddles the threshold, chance likeness."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    base = [rng.choice(words) for _ in range(120)]
    texts += [noisy(rng, base, rng.choice((0.002, 0.01, 0.03, 0.05))) for _ in range(cluster)]
    for _ in range(20):
        own = [rng.choice(words) for _ in range(rng.randrange(3, 200))]
        texts += [" ".join(own)] * rng.randrange(1, 4) + [noisy(rng, own, 0.02) for _ in range(rng.randrange(3))]
    texts += ["", " \n\t", "one", "ONE", "one two three four", "One  two\nthree FOUR", "É b c d e", "é b c d e"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("short,block", [(64, 1 << 21), (8, 1 << 21), (8, 900)])
def test_equals_all_pairs(spark, make_docs, monkeypatch, short, block):
    """With short lists, with one block per list, and with many blocks."""
    monkeypatch.setattr(N, "SHORT", short)
    monkeypatch.setattr(N, "BLOCK_SHINGLES", block)
    rows = corpus()
    assert found(make_docs(rows)) == brute(rows)


def licensed(rng, n):
    """Texts that share one long licence and differ otherwise, and near copies of some."""
    licence = " ".join(f"l{i}" for i in range(80))
    own = lambda k: " ".join(f"x{rng.randrange(10**9)}" for _ in range(k))
    texts = [f"{licence} {own(rng.choice((28, 30, 32, 44)))}" for _ in range(n)]
    texts += [f"{t} {own(3)}" for t in texts[:12]]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_a_common_licence_costs_rows_in_proportion(make_docs, monkeypatch):
    """Every label differs in the licence's lists. Their members are posted under what they do not
    share with all others: twice the texts give at most 2.3 times the rows, and no block."""
    monkeypatch.setattr(N, "SHORT", 8)
    made = []

    def counted(*args, prefix_postings=N.prefix_postings):
        rows = N.kept(prefix_postings(*args), "test-prefixes")
        made.append((args[0].count(), rows.count()))
        return rows

    monkeypatch.setattr(N, "prefix_postings", counted)
    monkeypatch.setattr(N, "unsettled", None)
    for n in (150, 300):
        rows = licensed(random.Random(11), n)
        assert found(make_docs(rows)) == brute(rows)
    (members, few), (more_members, more) = made
    assert members >= 100 and more_members >= 200 and more <= 2.3 * few + 100


def test_blocks_are_bounded_where_every_label_differs(make_docs, monkeypatch):
    """Texts of 60 out of 100 passages each: their rarest shingles are common too, and as many
    labels as members. A member stands in one group; no block holds more than two chunks."""
    monkeypatch.setattr(N, "SHORT", 8)
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 4000)
    rng = random.Random(11)
    passages = [" ".join(f"p{i}x{k}" for k in range(6)) for i in range(100)]
    texts = [" ".join(passages[i] for i in sorted(rng.sample(range(100), 60))) for _ in range(60)]
    texts += [f"{t} end {i}" for i, t in enumerate(texts[:12])]
    rng.shuffle(texts)
    weights, lists = [], []

    def weighed(rows, searched=N.searched):
        rows = N.kept(rows, "test-blocks")
        sizes = rows.selectExpr("token", "size_class", "block", "octet_length(shingles) div 8 as n").groupBy("token", "size_class", "block")
        weights.extend(r[3] for r in sizes.sum("n").collect())
        lists.extend(r[0] for r in rows.select("token").distinct().collect())
        return searched(rows)

    monkeypatch.setattr(N, "searched", weighed)
    rows = list(enumerate(texts))
    assert found(make_docs(rows)) == brute(rows)
    # Chunks are dealt by a hash, so their weight varies about the bound.
    assert len(weights) > 20 and max(weights) < 2 * 4000 and len(lists) == 1


def test_links_between_chunks_join_what_all_links_join():
    rng = np.random.default_rng(2)
    base = np.arange(1, 200, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(199) < 0.12, rng.integers(1000, 10**6, 199).astype(np.uint64), base)) for _ in range(40)]
    for majority in (False, True):
        # With a majority of one label among those that search, they search all the same.
        members = [(i, 0 if majority and i < 25 else i, True, s.tobytes()) for i, s in enumerate(sets)]
        sides = [0] * 25 + [1] * 15

        def classes(links, members=members):
            label = [m[1] for m in members]
            for a, b in links:
                lo, hi = sorted((label[a], label[b]))
                label = [lo if x == hi else x for x in label]
            return label

        near = [(a, b) for a in range(25) for b in range(25, 40)
                if N.similar(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))]
        assert near and classes(N.block_links(members, sides=sides)) == classes(near)


def test_edges(make_docs):
    rows = [(1, None), (2, ""), (3, "a b c"), (4, "A B\nc"), (None, "a b c"), (5, "a b")]
    out = N.near_duplicates(make_docs(rows)).collect()
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out}
    assert by_id == {1: (0, 1, True), 2: (0, 2, True), 3: (1, 3, True), 4: (1, 3, False), 5: (1, 5, True), None: (1, None, True)}


def test_repeated_rows_and_shared_ids(make_docs):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (8, "k l m n o"), (9, "a b c d e f"), (9, "k l m n o")]
    out = sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.near_duplicates(make_docs(rows)).collect())
    assert out == [(7, 2, 7), (7, 2, 7), (8, 1, 7), (9, 1, 7), (9, 2, 7)]
    left = N.one_of_each(make_docs(rows))
    assert [(r.doc_id, r.text) for r in left.collect()] == [(7, "a b c d e f")]
    assert left.columns == make_docs(rows).columns


def test_empty(make_docs):
    assert N.near_duplicates(make_docs([])).collect() == []
    assert N.one_of_each(make_docs([])).collect() == []


def test_long_text_is_whole(make_docs):
    long = " ".join(f"w{i}" for i in range(60_000))
    out = found(make_docs([(1, long), (2, long + " tail"), (3, long[: len(long) // 2])]))
    assert out == {1: (59_996, 1, True), 2: (59_997, 1, False), 3: (len(plain_set(long[: len(long) // 2])), 3, True)}


def test_signature_estimates_similarity():
    a = N.shingle_set(" ".join(map(str, range(2000))))
    b = N.shingle_set(" ".join(map(str, range(200, 2000))))
    same = np.mean(N.signature(a, 512) == N.signature(b, 512))
    assert abs(same - 0.9) < 0.06


def test_block_links_join_what_all_links_join():
    rng = np.random.default_rng(1)
    base = np.arange(1, 200, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(199) < 0.12, rng.integers(1000, 10**6, 199).astype(np.uint64), base)) for _ in range(40)]
    members = [(i, i, True, s.tobytes()) for i, s in enumerate(sets)]
    label = list(range(40))

    def join(a, b):
        lo, hi = sorted((label[a], label[b]))
        label[:] = [lo if x == hi else x for x in label]

    for a, b in combinations(range(40), 2):
        if N.similar(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])):
            join(a, b)
    want, label[:] = list(label), range(40)
    for a, b in N.block_links(members):
        join(a, b)
    assert label == want
