import math
import random
import struct

import numpy as np
import pytest

from studytrail.llm import hardnegatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score string, block string"


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def brute_force(rows, every):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for i, label, q in kept:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, other)), j, m) for j, m, other in kept]
        for s, j in sorted((s, j) for s, j, m in scored if m == label and j != i)[:5]:
            fits = sorted((t, n) for t, n, m in scored if m != label and 80 * -s <= 100 * -t <= 100 * -s)[:5]
            out += [(i, j, rank, n, -s, -t) for rank, (t, n) in enumerate(fits, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("seed,width", [(0, 3), (1, 8), (2, 1), (3, 40)])
def test_equals_brute_force(spark, seed, width):
    """Ties, repeated vectors and ids, nulls and non-finite components, short and empty vectors."""
    r = random.Random(seed)
    rows = []
    for i in range(300):
        v = [single(r.choice([r.gauss(0.3, 0.3), 0.0, r.gauss(0, 1)])) for _ in range(width)]
        if r.random() < 0.2:
            v = [0.5] * width
        if r.random() < 0.04:
            v = r.choice([None, [float("nan")] * width, [None] * width, [], [float("inf")], [0.25]])
        rows.append((i if r.random() > 0.02 else None, v, r.choice([0, 0, 0, 1, 2, None])))
    rows += [(100, [0.25] * width, 0), (200, [0.25] * width, 1), (200, [0.25] * width, 1)]
    found = H.hard_negatives(table(spark, rows).repartition(3), every=20, block_rows=(40, 8192)[seed % 2], chunk_anchors=(7, 4096)[seed % 2])
    assert sorted(map(tuple, found.collect())) == brute_force(rows, 20)


def test_empty_table(spark):
    assert H.hard_negatives(table(spark, [])).collect() == []


def test_scores_beyond_64_bits(spark):
    rows = [(i, [3e38 if i % 3 else -1e38, float(i)], i % 3) for i in range(150)]
    assert H.hard_negatives(table(spark, rows)).columns[0] == "anchor_id"
    H.hard_negatives(table(spark, rows)).collect()


def test_exact_beyond_float():
    rows, anchors = np.array([[1 << 40, 1]], np.int64), np.array([[1 << 40, 1]], np.int64)
    a, b = H.exact(rows, anchors)
    assert int((a @ b[0])[0]) == (1 << 80) + 1


def test_stops_before_the_lists_end():
    """One dimension decides: the search reads a small part of the lists and loses nothing."""
    rng = np.random.default_rng(1)
    rows = np.zeros((4000, 4), np.int64)
    rows[:, 0] = rng.integers(0, 10_000, 4000)
    ids = rng.permutation(4000)
    values, wanted = H.exact(rows, np.array([[7, 0, 0, 0]], np.int64))
    block = H.Lists.of(ids, np.zeros(4000, np.int64), values)
    got = H.threshold_search(block, wanted[0], np.ones(4000, bool), [(None, None), (None, 69_000)])
    scores = rows[:, 0] * 7
    for found, top in zip(got, (10**9, 69_000)):
        want = sorted((-int(s), int(i)) for s, i in zip(scores, ids) if s <= top)[:5]
        assert found == [(i, -s) for s, i in want]
    assert block.reads < 4000


def test_equal_scores_are_read_to_their_end():
    """The threshold equals the k-th score: a smaller id may still come, so reading goes on."""
    ids = np.arange(1000)[::-1].copy()
    values, wanted = H.exact(np.ones((1000, 2), np.int64), np.array([[1, 1]], np.int64))
    block = H.Lists.of(ids, np.zeros(1000, np.int64), values)
    got = H.threshold_search(block, wanted[0], np.ones(1000, bool), [(None, None)])
    assert got == [[(i, 2) for i in range(5)]]
