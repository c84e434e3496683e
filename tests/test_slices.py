"""Cut points, the literal binary search and places built on them."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from studytrail.operators.slices import SLICE, Slices, plan_slices, ranked, with_slice


def test_small_input_is_not_cut(spark):
    assert plan_slices(spark.range(50), [], ["id"], rows_per_slice=50) is None


def test_even_groups_are_not_cut(spark):
    df = spark.range(1000).select((F.col("id") % 500).alias("k"), "id")
    assert plan_slices(df, ["k"], ["id"], rows_per_slice=100) is None


def test_only_the_hot_group_is_cut_in_order(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    slices = plan_slices(df, ["k"], ["id"], rows_per_slice=200)
    assert slices.hot == [("0",)] and not slices.has_copies
    got = with_slice(df, slices)
    sizes = {r[SLICE]: r.n for r in got.filter("k = 0").groupBy(SLICE).agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == 2000 and len(sizes) >= 5 and max(sizes.values()) < 1000
    rows = sorted((r.id, r[SLICE]) for r in got.filter("k = 0").collect())
    assert [s for _, s in rows] == sorted(s for _, s in rows)
    assert got.filter(f"k <> 0 and {SLICE} <> 0").count() == 0


def test_number_of_slices_is_bounded(spark):
    slices = plan_slices(spark.range(5000), [], ["id"], rows_per_slice=10, max_slices=16)
    assert len(slices.cuts) <= 17


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 100])
def test_index_counts_lower_cuts(spark, n):
    rng = random.Random(n)
    t0 = datetime(2024, 1, 1)
    cuts = sorted({(rng.randint(0, 9), t0 + timedelta(microseconds=rng.randint(0, 10**9))) for _ in range(n)})
    text = [("g'\\x${user.name}", str(a), str(b)) for a, b in cuts]
    types = {"k": "string", "a": "bigint", "t": "timestamp_ntz"}
    slices = Slices(("k",), ("a", "t"), types, text, hot=[("g'\\x${user.name}",)])
    rows = [("g'\\x${user.name}", rng.randint(0, 9), t0 + timedelta(microseconds=rng.randint(0, 10**9))) for _ in range(50)]
    rows += [("g'\\x${user.name}", a, b) for a, b in cuts] + [("other", 5, t0)]
    df = spark.createDataFrame(rows, "k string, a long, t timestamp_ntz")
    for r in df.select("*", slices.column().alias("i")).collect():
        want = sum(c < (r.a, r.t) for c in cuts) if r.k != "other" else 0
        assert r.i == want


def test_null_and_negative_order_values(spark):
    rows = [(1, v) for v in [None, -5, 0, 7] * 40]
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k long, v long, i long")
    got = ranked(df, ["k"], ["v", "i"], rows_per_slice=15)
    want = sorted(((v is not None, v or 0, i) for i, (_, v) in enumerate(rows)))
    assert [r.i for r in sorted(got.collect(), key=lambda r: r.pos)] == [i for *_, i in want]
    assert {r.size for r in got.collect()} == {160}


def test_copies_are_noticed(spark):
    df = spark.range(900).select(F.lit(1).alias("k"), F.when(F.col("id") < 600, 5).otherwise(F.col("id")).alias("v"))
    assert plan_slices(df, ["k"], ["v"], rows_per_slice=50).has_copies


@pytest.mark.parametrize("page", [(0, 4), (100, 120), (-7, -1), (395, None), (-500, 2), (250, 249)])
def test_a_page_of_a_cut_group_leaves_other_slices_out(spark, page):
    """One group in slices, small ones whole; places and sizes are those of the whole order."""
    rows = [("hot", i % 50, f"m{i}") for i in range(400)] + [(f"g{i % 5}", i, "x") for i in range(30)]
    df = spark.createDataFrame(rows, "k string, s int, m string").repartition(3)
    whole = {(r.k, r.s, r.m): (r.pos, r["size"]) for r in ranked(df, ["k"], ["s", "m"], 1 << 20).collect()}
    found = {(r.k, r.s, r.m): (r.pos, r["size"]) for r in ranked(df, ["k"], ["s", "m"], 40, page=page).collect()}
    assert all(whole[key] == place for key, place in found.items())
    lo, hi = (n if n >= 0 else 400 + n for n in (page[0], -1 if page[1] is None else page[1]))
    assert {key for key, (pos, _) in whole.items() if key[0] == "hot" and lo <= pos <= hi} <= set(found)
    assert {key for key in whole if key[0] != "hot"} <= set(found)
    assert sum(key[0] == "hot" for key in found) < 400 // 2


def test_probes_are_ranked_within_their_slices(spark):
    rows = [("hot", i % 7, f"m{i:03}") for i in range(400)] + [("g", i, "x") for i in range(30)]
    df = spark.createDataFrame(rows, "k string, s int, m string").repartition(3)
    probes = df.filter("m in ('m005', 'm006', 'm399')")
    whole = {(r.k, r.s, r.m): r.pos for r in ranked(df, ["k"], ["s", "m"], 1 << 20).collect()}
    found = {(r.k, r.s, r.m): r.pos for r in ranked(df, ["k"], ["s", "m"], 40, probes=probes).collect()}
    assert all(whole[key] == pos for key, pos in found.items())
    assert {tuple(r) for r in probes.collect()} <= set(found) and sum(key[0] == "hot" for key in found) < 250
