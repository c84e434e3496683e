import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from studytrail.llm import prefixtrie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = tuple(own.get(base, [])[:h]) + tuple(v[h:])
    return out


def brute_force(rows):
    conversations = rebuilt(rows)
    nodes, children = defaultdict(list), defaultdict(int)
    for c, s in conversations.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(conversations[c]) == len(p))
        parent = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), parent, len(members), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def found(conversations, **kw):
    return sorted((tuple(r) for r in T.trie(conversations, **kw).collect()), key=repr)


@pytest.mark.parametrize("seed,block_turns", [(0, 5), (1, 20), (2, 1 << 15), (3, 1), (4, 8)])
def test_equals_brute_force(spark, seed, block_turns):
    """Few texts, so prefixes run over many blocks; nulls in every column, repeated rows, ties."""
    r = random.Random(seed)
    rows = [(None, 1, "user", "x")]
    for c in [r.choice([r.randrange(400), r.randrange(-150, 150)]) for _ in range(120)]:
        for t in range(r.randrange(7)):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["u", "a", None]), r.choice(["x", "yy", "é😀", None, ""])))
    rows += rows[3:6]
    assert found(table(spark, rows).repartition(3), block_turns=block_turns) == brute_force(rows)


def test_many_copies(spark):
    """Equal conversations over many blocks: one chain of nodes, one digest over all members."""
    rows = [(100 * c, t, "u", f"text {t}") for c in range(300) for t in range(4)]
    got = found(table(spark, rows).repartition(4), block_turns=16)
    assert got == brute_force(rows) and len(got) == 5


def test_turnless_conversations(spark):
    """All own turns are among the first h and there is no conversation to take others from."""
    one = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(one, 0, "u", "x")]
    assert found(table(spark, rows)) == brute_force(rows) == [(one, 0, None, 1, 0, 1, 0, hashlib.sha256(str(one).encode()).hexdigest())]


def test_role_and_text_are_kept_apart(spark):
    rows = [(600, 0, "ab", "c"), (700, 0, "a", "bc"), (800, 0, "", "abc")]
    assert found(table(spark, rows)) == brute_force(rows)


def test_long_conversation(spark):
    rows = [(0, t, "u", f"t{t}") for t in range(700)] + [(700, t, "u", f"t{t}") for t in range(700)]
    assert found(table(spark, rows), block_turns=50) == brute_force(rows)


def test_empty_table(spark):
    assert found(table(spark, [])) == []


def test_extents_by_binary_search():
    rng = np.random.default_rng(5)
    lcp = rng.integers(0, 5, 200)
    table = T.minima(lcp)
    rows, depths = rng.integers(0, 200, 500), rng.integers(0, 6, 500)
    right, left = T.right_ends(table, rows, depths), T.left_ends(table, rows, depths)
    for i, d, a, b in zip(rows, depths, left, right):
        r, low = i, i
        while r + 1 < 200 and lcp[r + 1] >= d:
            r += 1
        while low >= 1 and lcp[low] >= d:
            low -= 1
        assert (a, b) == (low, r)
    assert (T.least(table, left, right) == [lcp[a : b + 1].min() for a, b in zip(left, right)]).all()
