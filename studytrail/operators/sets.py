"""Sets as distinct rows (key, member).

Operations on listed keys need one pass: each member collects one flag per key in an
aggregate that combines before its shuffle, whatever the size of a set.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studytrail.operators.slices import ROWS_PER_SLICE, ranked


def _flags(sets: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    wanted = list(dict.fromkeys(keys))
    grouped = (
        sets.filter(F.col("key").isin(wanted))
        .groupBy("member")
        .agg(*[F.max(F.col("key") == k).alias(f"in{i}") for i, k in enumerate(wanted)])
    )
    return grouped, [F.col(f"in{i}") for i in range(len(wanted))]


def intersect(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    grouped, flags = _flags(sets, keys)
    return grouped.filter(reduce(Column.__and__, flags)).select("member")


def union(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sets.filter(F.col("key").isin(list(keys))).select("member").distinct()


def difference(sets: DataFrame, first: str, others: Sequence[str]) -> DataFrame:
    """Members of ``first`` in none of the others."""
    others = [k for k in dict.fromkeys(others)]
    if first in others:
        return sets.filter(F.lit(False)).select("member")
    grouped, flags = _flags(sets, [first, *others])
    return grouped.filter(reduce(lambda kept, f: kept & ~f, flags[1:], flags[0])).select("member")


def store(sets: DataFrame, members: DataFrame, dest: str) -> DataFrame:
    """The sets with ``dest`` replaced by the members (gone if there are none)."""
    kept = sets.filter(F.col("key") != dest).select("key", "member")
    return kept.unionByName(members.select(F.lit(dest).alias("key"), "member"))


def add(sets: DataFrame, members: DataFrame) -> DataFrame:
    return sets.select("key", "member").unionByName(members.select("key", "member")).distinct()


def remove(sets: DataFrame, members: DataFrame) -> DataFrame:
    return sets.join(members.select("key", "member"), ["key", "member"], "left_anti")


def move(sets: DataFrame, moves: DataFrame) -> DataFrame:
    """Apply (key, dest, member) moves; a member not in ``key`` moves nothing."""
    moves = moves.select("key", "dest", "member").distinct()
    present = moves.join(sets.select("key", "member"), ["key", "member"], "left_semi")
    arriving = present.select(F.col("dest").alias("key"), "member")
    return add(remove(sets, present), arriving)


def cardinality(sets: DataFrame) -> DataFrame:
    return sets.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def contains(sets: DataFrame, probes: DataFrame) -> DataFrame:
    """For each (key, member) whether the set holds it."""
    found = sets.select("key", "member").withColumn("__hit", F.lit(True))
    joined = probes.select("key", "member").join(found, ["key", "member"], "left")
    return joined.select("key", "member", F.coalesce("__hit", F.lit(False)).alias("found"))


def members(sets: DataFrame, key: str) -> DataFrame:
    return sets.filter(F.col("key") == key).select("member")


def _draw_hash(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def random_members(sets: DataFrame, k: int, seed: int, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """k different members per set: those with the smallest seeded hash."""
    hashed = sets.select("key", "member", _draw_hash(seed, F.col("key"), F.col("member")).alias("__h"))
    if k <= 1000:
        w = Window.partitionBy("key").orderBy("__h", "member")
        picked = hashed.withColumn("__place", F.row_number().over(w)).filter(F.col("__place") <= k)
    else:
        picked = ranked(hashed, ["key"], ["__h", "member"], rows_per_slice).filter(F.col("pos") < k)
    return picked.select("key", "member")


def random_draws(sets: DataFrame, k: int, seed: int, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """k independent draws per set, so members may repeat: (key, draw, member).

    A draw is a place in the set's order of members, from a seeded hash of key and draw; only
    the k places per set meet the members, which are not copied."""
    placed = ranked(sets.select("key", "member"), ["key"], ["member"], rows_per_slice)
    sizes = sets.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    draws = sizes.select("key", "size", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("draw"))
    number = F.conv(F.substring(_draw_hash(seed, F.col("key"), F.col("draw").cast("string")), 1, 15), 16, 10).cast("bigint")
    return draws.select("key", "draw", F.pmod(number, F.col("size")).alias("pos")).join(
        placed.select("key", "pos", "member"), ["key", "pos"]
    ).select("key", "draw", "member")


def pop(sets: DataFrame, k: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(taken members, remaining sets)."""
    taken = random_members(sets, k, seed)
    return taken, remove(sets, taken)
