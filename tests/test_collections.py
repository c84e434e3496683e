"""Set, key/value, hash and list jobs at their edges (the catalog test covers the rest)."""

import pytest


from studytrail.operators import keyvalues as K
from studytrail.operators import lists as L
from studytrail.operators import sets as Z


@pytest.fixture(scope="module")
def sets(spark):
    rows = [("a", m) for m in "pqrs"] + [("b", m) for m in "qr"] + [("c", "r")]
    return spark.createDataFrame(rows, "key string, member string")


def names(df):
    return "".join(sorted(r.member for r in df.collect()))


def test_set_algebra(sets):
    assert names(Z.intersect(sets, ["a", "b", "c"])) == "r"
    assert names(Z.intersect(sets, ["a", "missing"])) == ""
    assert names(Z.difference(sets, "a", ["b", "missing"])) == "ps"
    assert names(Z.difference(sets, "a", ["a"])) == ""
    stored = Z.store(sets, Z.union(sets, ["b", "c"]), "a")
    assert names(Z.members(stored, "a")) == "qr"
    emptied = Z.store(sets, Z.difference(sets, "c", ["a"]), "a")
    assert names(Z.members(emptied, "a")) == "" and emptied.count() == 3


def test_move_only_present_members(spark, sets):
    moves = spark.createDataFrame([("a", "c", "p"), ("a", "c", "zz"), ("b", "a", "q")], "key string, dest string, member string")
    after = Z.move(sets, moves)
    assert names(Z.members(after, "a")) == "qrs"
    assert names(Z.members(after, "b")) == "r" and names(Z.members(after, "c")) == "pr"


def test_random(sets):
    picked = Z.random_members(sets, 2, 3)
    assert {r.key: r.n for r in Z.cardinality(picked).collect()} == {"a": 2, "b": 2, "c": 1}
    same = Z.random_members(sets, 1500, 3, rows_per_slice=2)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, sets.collect()))
    draws = Z.random_draws(sets, 30, 1).filter("key = 'b'").collect()
    assert len(draws) == 30 and {r.member for r in draws} == {"q", "r"}
    taken, left = Z.pop(sets, 1, 5)
    assert taken.count() == 3 and left.count() == 4


@pytest.mark.parametrize(
    "glob,keys",
    [("h?llo", ["hallo", "hello"]), ("h[ae]llo", ["hallo", "hello"]), ("h[^e]llo", ["hallo"]), ("h*o", ["hallo", "heeo", "hello"]), ("a.b\\*", ["a.b*"]), ("*[", ["x["])],
)
def test_glob(spark, glob, keys):
    df = spark.createDataFrame([(k, "") for k in ["hallo", "hello", "heeo", "a.b*", "axb*", "x["]], "key string, value string")
    assert sorted(r.key for r in K.matching_keys(df, glob).collect()) == keys


def test_key_values(spark):
    t = spark.createDataFrame([("a", "1"), ("b", "2.5")], "key string, value string")
    new = spark.createDataFrame([("c", "x"), ("d", "y")], "key string, value string")
    assert K.set_all_or_none(t, new).count() == 4
    assert K.set_all_or_none(t, new.union(t.limit(1))).count() == 2
    deltas = spark.createDataFrame([("b", 0.5), ("z", 1.0)], "key string, delta double")
    got = {r.key: r.value for r in K.increment(t, deltas, "double").collect()}
    assert got == {"a": "1.0", "b": "3.0", "z": "1.0"}


LIST = [("big", 3 * i, "xyz"[i % 3]) for i in range(120)] + [("s", 1, "x"), ("s", 5, "y")]


@pytest.mark.parametrize("limit", [10**6, 20])
def test_lists(spark, limit):
    df = spark.createDataFrame(LIST, "key string, pos long, value string")

    def values(frame, by="idx"):
        rows = sorted((r for r in frame.collect() if r.key == "big"), key=lambda r: r[by])
        return [r.value for r in rows]

    whole = [v for k, _, v in LIST if k == "big"]
    assert values(L.list_range(df, -4, 200, limit)) == whole[-4:]
    assert values(L.list_index(df, -1, limit)) == whole[-1:]
    assert {r.key for r in L.list_index(df, 5, limit).collect()} == {"big"}
    assert values(L.list_trim(df, 1, -2, limit), "pos") == whole[1:-1]
    assert values(L.list_sort(df, True, 2, 50, limit, alpha=True)) == sorted(whole, reverse=True)[2:52]
    left = values(L.list_remove(df, -2, "x", limit), "pos")
    assert left == whole[:114] + ["y", "z", "y", "z"]
    assert values(L.list_remove(df, 5000, "x", limit), "pos") == [v for v in whole if v != "x"]
    assert values(L.list_remove(df, -5000, "x", limit), "pos") == [v for v in whole if v != "x"]
