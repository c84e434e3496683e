"""Board operations against sorted Python lists, with one board holding most members."""

import random

import pytest

from studytrail.operators import boards as B

BOARD = "board string, member string, score double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [("big", f"m{i}", float(rng.randint(0, 5))) for i in range(300)]
    return out + [(f"b{i % 3}", f"m{i}", float(rng.randint(0, 9))) for i in range(60)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, BOARD)


def ordered(rows, board, desc=False):
    return [m for s, m in sorted(((s, m) for b, m, s in rows if b == board), reverse=desc)]


def places(frame, board, col="rank"):
    return [r.member for r in sorted((r for r in frame.collect() if r.board == board), key=lambda r: r[col])]


@pytest.mark.parametrize("limit", [10**6, 25])
def test_ranks(df, rows, limit):
    got = B.with_ranks(df, limit)
    for board in ("big", "b0"):
        assert places(got, board) == ordered(rows, board)
        assert places(got, board, "revrank") == ordered(rows, board, True)
    assert {r.size for r in got.collect() if r.board == "big"} == {300}


@pytest.mark.parametrize("limit", [10**6, 25])
@pytest.mark.parametrize("span", [(0, 4), (-3, -1), (2, -2), (5, 3)])
@pytest.mark.parametrize("desc", [False, True])
def test_positions(df, rows, limit, span, desc):
    got = B.by_position(df, *span, desc=desc, rows_per_slice=limit)
    for board in ("big", "b1"):
        line = ordered(rows, board, desc)
        lo, hi = (p if p >= 0 else len(line) + p for p in span)
        assert places(got, board) == line[max(lo, 0) : hi + 1]
    left = B.remove_by_position(df, *span, rows_per_slice=limit)
    line = ordered(rows, "big")
    lo, hi = (p if p >= 0 else len(line) + p for p in span)
    gone = set(line[max(lo, 0) : hi + 1])
    assert {r.member for r in left.collect() if r.board == "big"} == set(line) - gone


def test_top_and_page(df, rows):
    assert places(B.top_k(df, 3), "big") == ordered(rows, "big", True)[:3]
    page = B.by_score(df, 2, 4, offset=2, count=3)
    line = [m for m in ordered(rows, "big") if 2 <= dict((x, s) for b, x, s in rows if b == "big")[m] <= 4]
    assert sorted(r.member for r in page.collect() if r.board == "big") == sorted(line[2:5])
    rest = B.by_score(df, 2, 4, offset=2, rows_per_slice=20)
    assert sorted(r.member for r in rest.collect() if r.board == "big") == sorted(line[2:])


def test_counts_scores_and_changes(spark, df, rows):
    n = {r.board: (r.n, r.size) for r in B.count_by_score(df, 1, 3).collect()}
    assert n["big"] == (sum(b == "big" and 1 <= s <= 3 for b, _, s in rows), 300)
    asked = spark.createDataFrame([("big", "m1"), ("big", "nobody")], "board string, member string")
    scores = {r.member: r.score for r in B.scores_of(df, asked).collect()}
    assert scores["nobody"] == 0.0
    assert {r.member: r.score for r in B.scores_of(df, asked, None).collect()}["nobody"] is None
    deltas = spark.createDataFrame([("big", "m1", 2.0), ("big", "new", 1.0)], "board string, member string, delta double")
    after = {(r.board, r.member): r.score for r in B.increment(df, deltas).collect()}
    assert after[("big", "m1")] == scores["m1"] + 2 and after[("big", "new")] == 1
    ups = spark.createDataFrame(
        [("big", "m1", 9.0, 2), ("big", "m1", 8.0, 1), ("x", "y", 3.0, 1)], BOARD + ", seq long"
    )
    after = {(r.board, r.member): r.score for r in B.upsert(df, ups, "seq").collect()}
    assert after[("big", "m1")] == 9 and after[("x", "y")] == 3 and len(after) == len(rows) + 1
    assert B.remove_members(df, asked).count() == len(rows) - 1
    assert B.drop_boards(df, ["big"]).count() == 60
    assert B.remove_by_score(df, 0, 9).count() == 0
    union = {r.member: r.score for r in B.union_boards(df, ["big", "b0"], "d").collect()}
    both = {r.member for r in B.intersect_boards(df, ["big", "b0"], "d").collect()}
    assert len(union) == 300 and both == set(ordered(rows, "b0"))
    assert {r.member: r.rank for r in B.rank_of(df, asked).collect()} == {"m1": ordered(rows, "big").index("m1")}


@pytest.mark.parametrize("desc", [False, True])
def test_ranks_and_pages_of_a_board_in_slices(spark, desc):
    """Ties by member; one board in slices beside a small one; pages from either end and beyond."""
    rows = [("big", f"m{i}", float(i % 13)) for i in range(300)] + [("small", f"m{i}", float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "board string, member string, score double").repartition(3)
    order = {}
    for board in ("big", "small"):
        for place, r in enumerate(sorted(((s, m) for b, m, s in rows if b == board), reverse=desc)):
            order[board, r[1]] = place
    asked = spark.createDataFrame([("big", "m7"), ("big", "m288"), ("small", "m4"), ("big", "none"), ("no", "m1")], "board string, member string")
    found = {(r.board, r.member): r["rank"] for r in B.rank_of(df, asked, desc, 25).collect()}
    assert found == {k: order[k] for k in (("big", "m7"), ("big", "m288"), ("small", "m4"))}
    sizes = {"big": 300, "small": 5}
    for start, end in ((0, 9), (140, 160), (-3, -1), (2, -290), (298, 400)):
        page = {(r.board, r.member): r["rank"] for r in B.by_position(df, start, end, desc, 25).collect()}
        lo = lambda b: start if start >= 0 else max(sizes[b] + start, 0)  # noqa: B023, E731
        hi = lambda b: end if end >= 0 else sizes[b] + end  # noqa: B023, E731
        assert page == {k: p for k, p in order.items() if lo(k[0]) <= p <= hi(k[0])}
    by_score = B.by_score(df, 2.0, 9.0, desc, offset=40, count=2000, rows_per_slice=25).collect()
    inside = {b: sorted(((s, m) for c, m, s in rows if c == b and 2 <= s <= 9), reverse=desc)[40:] for b in sizes}
    assert sorted((r.board, r.score, r.member) for r in by_score) == sorted((b, s, m) for b, v in inside.items() for s, m in v)
