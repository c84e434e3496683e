"""Cell filters on the small score table the original names in its notes."""

import pytest
from pyspark.sql import functions as F

from studytrail.functions import keys
from studytrail.functions import predicates as P
from studytrail.operators import cellfilters as C
from studytrail.operators import keyvalues as K
from studytrail.sources import celltables
from studytrail.sources import celltables as T

ROWS = [
    ("lisi01", "course", "art", 5, "89"),
    ("lisi01", "course", "math", 5, "66"),
    ("lisi01", "grad", "level", 4, "A9"),
    ("zhangsan01", "course", "art", 7, "90"),
    ("zhangsan01", "course", "math", 7, "102"),
    ("zhangsan01", "info", "age", 6, "18"),
    ("zhangsan02", "info", "age", 8, "19"),
    ("zhangsan02", "info", "ma", 8, ""),
]


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame(ROWS, T.CELL_SCHEMA)


def at(df):
    return sorted((r.rowkey[-8:], r.qualifier) for r in df.collect())


def where(keep):
    return sorted((r[0][-8:], r[2]) for r in ROWS if keep(*r))


def test_cell_filters(cells):
    assert at(C.family_filter(cells, "<=", P.binary("grc"))) == where(lambda k, f, q, n, v: f <= "grc")
    assert at(C.row_filter(cells, "=", P.binary_prefix("zhang"))) == where(lambda k, *_: k.startswith("zhang"))
    assert at(C.row_regex(cells, ".*n01")) == where(lambda k, *_: "n01" in k)
    assert at(C.suffix_filter(cells, "i01")) == where(lambda k, *_: k.endswith("i01"))
    assert at(C.column_prefix(cells, "ar", "ma")) == where(lambda k, f, q, *_: q[:2] in ("ar", "ma"))
    assert at(C.column_range(cells, "a", "ma", False, False)) == where(lambda k, f, q, *_: "a" < q < "ma")
    assert at(C.column_range(cells, None, None)) == at(cells)
    assert at(C.fuzzy_row(cells, "zhangsan01", [0] * 9 + [1])) == where(lambda k, *_: k.startswith("zhangsan0"))
    assert at(C.inclusive_stop(cells, "zhangsan01")) == where(lambda k, *_: k <= "zhangsan01")
    assert at(C.timestamps(cells, [7, 4])) == where(lambda k, f, q, n, v: n in (4, 7))
    assert [r.value for r in C.key_only(cells, True).orderBy(*C.CELL).collect()][:4] == ["2", "2", "2", "2"]
    assert {r.value for r in C.key_only(cells).collect()} == {""}
    with pytest.raises(ValueError):
        C.fuzzy_row(cells, "ab", [0])


def test_row_order_filters(cells):
    assert at(C.column_count(cells, 2, "zhangsan01")) == [("angsan01", "art"), ("angsan01", "math")]
    assert at(C.column_page(cells, 2, 1, "course")) == [("angsan01", "math"), ("lisi01", "math")]
    big = C.column_page(cells, 2000, 1, rows_per_slice=2)
    assert len(at(big)) == 5
    assert len(at(C.first_key_only(cells))) == 3
    assert {r.rowkey for r in C.first_rows(cells, 2).collect()} == {"lisi01", "zhangsan01"}


def test_random_rows_keeps_rows_whole(cells):
    assert C.random_rows(cells, -1, 1).count() == 0
    assert C.random_rows(cells, 1.5, 1).count() == len(ROWS)
    for seed in range(4):
        got = at(C.random_rows(cells, 0.5, seed))
        assert got == [p for p in at(cells) if p[0] in {g[0] for g in got}]


def test_row_filters(cells):
    # Rows without the column pass; the column that exists and fails drops its row.
    got = C.single_column_value(cells, "course", "art", "=", P.substring("9"))
    assert {r.rowkey for r in got.collect()} == {"lisi01", "zhangsan01", "zhangsan02"}
    got = C.single_column_value(cells, "course", "art", "=", P.binary("90"), exclude=True)
    assert at(got) == where(lambda k, f, q, *_: k != "lisi01" and q != "art")
    tests = [C.ColumnTest("course", "math", "=", P.binary(v)) for v in ("89", "66")]
    assert {r.rowkey for r in C.row_tests(cells, tests, any_pass=True).collect()} == {"lisi01", "zhangsan02"}
    assert {r.rowkey for r in C.row_tests(cells, tests).collect()} == {"zhangsan02"}
    got = C.dependent_column(cells, "course", "art", False, "=", P.binary("90"))
    assert at(got) == [("angsan01", "art"), ("angsan01", "math")]
    assert at(C.dependent_column(cells, "course", "art", True)) == [("angsan01", "math"), ("lisi01", "math")]
    not_102 = P.test(F.col("value"), "!=", P.binary("102"))
    assert at(C.skip_rows(cells, not_102)) == where(lambda k, *_: k != "zhangsan01")
    assert at(C.while_match(cells, not_102)) == where(lambda k, f, q, *_: (k, f, q) < ("zhangsan01", "course", "math"))
    assert C.while_match(cells, F.lit(True)).count() == len(ROWS)


def test_comparators(spark):
    df = spark.createDataFrame([("abcdef",), ("AXE",), (None,)], "v string")

    def hits(op, comparator):
        return [r[0] for r in df.filter(P.test(F.col("v"), op, comparator)).collect()]

    assert hits("=", P.null()) == [None] and hits("!=", P.null()) == ["abcdef", "AXE"]
    assert hits("=", P.substring("xe")) == ["AXE"] and hits("!=", P.regex("^a")) == ["AXE"]
    assert hits("=", P.bits("abcdeg", "xor")) == ["abcdef"] and hits("=", P.bits("abcdef", "xor")) == []
    assert hits("=", P.bits("\x00\x00\x00\x00\x00\x02", "and")) == ["abcdef"]
    assert hits(">", P.binary_prefix("abb")) == ["abcdef"]
    with pytest.raises(ValueError):
        P.test(F.col("v"), "<", P.regex("a"))
    with pytest.raises(ValueError):
        P.test(F.col("v"), "~", P.binary("a"))


def test_cell_table(spark, tmp_path, cells):
    path = str(tmp_path / "scores")
    assert T.create_table(spark, path, ["course", "grad", "info"])
    assert not T.create_table(spark, path, ["other"])
    assert T.families(spark, path) == ["course", "grad", "info"]
    T.put_cells(spark, path, cells, (0, 0))
    newer = spark.createDataFrame([("lisi01", "course", "art", 9, "70"), ("lisi01", "course", "math", 1, "1")], T.CELL_SCHEMA)
    T.put_cells(spark, path, newer, (0, 1))
    T.put_cells(spark, path, newer, (0, 1))

    def current():
        return {(r.rowkey, r.qualifier): r.value for r in T.current_cells(spark, path).collect()}

    before = current()
    assert before[("lisi01", "art")] == "70" and before[("lisi01", "math")] == "66" and len(before) == len(ROWS)
    assert T.all_versions(spark, path).count() == len(ROWS) + 2
    shown = C.latest(C.delete_newest(T.all_versions(spark, path), newer.limit(1)))
    assert {r.value for r in shown.filter("rowkey = 'lisi01' and qualifier = 'art'").collect()} == {"89"}
    assert T.compact_table(spark, path) == (0, 1)
    assert current() == before and T.all_versions(spark, path).count() == len(ROWS)
    with pytest.raises(Exception, match="unknown column family"):
        T.put_cells(spark, path, newer.withColumn("family", F.lit("nope")), (0, 2))
    assert current() == before


def scanned(df):
    """Rows that the file scans of a plan gave out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Twenty batches; each holds the keys of one residue, so their bounds overlap."""
    path = str(tmp_path_factory.mktemp("cells") / "t")
    celltables.create_table(spark, path, ["f"])
    rows = spark.range(20_000).select(
        F.concat(F.lit("u"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("rowkey"),
        F.lit("f").alias("family"), F.lit("q").alias("qualifier"), F.col("id").alias("version"), F.col("id").cast("string").alias("value"),
    )
    for n in range(20):
        celltables.put_cells(spark, path, rows.filter(F.col("version") % 20 == n).coalesce(1), (0, n))
    return celltables.all_versions(spark, path)


def test_a_get_skips_batches_without_the_key(spark, table):
    wanted = spark.createDataFrame([("u00000105",), ("u00010105",), (None,), ("u00000105",)], "rowkey string")
    found = C.get_rows(table, wanted)
    assert sorted(r.value for r in found.collect()) == ["10105", "105"]
    # One batch of a thousand rows holds both keys; a few others may pass the bloom filters.
    assert scanned(found) <= 4000


def test_many_keys_are_joined_within_their_bounds(spark, table, monkeypatch):
    monkeypatch.setattr(C, "MOST_KEYS", 3)
    wanted = table.filter("version between 100 and 149").select("rowkey")
    assert sorted(int(r.value) for r in C.get_rows(table, wanted).collect()) == list(range(100, 150))


def test_a_fuzzy_key_is_bounded(spark, table):
    found = C.fuzzy_row(table, "u00000000", [0] * 6 + [1, 1, 0])
    assert sorted(int(r.value) for r in found.collect()) == [i for i in range(1000) if i % 10 == 0]
    assert "GreaterThanOrEqual(rowkey,u00000)" in found._jdf.queryExecution().toString()
    assert scanned(C.fuzzy_row(table, "v00000000", [0] * 9)) == 0


def test_successors():
    assert keys.successor("ab") == "ac" and keys.successor("a\U0010ffff") == "b"
    assert keys.successor("\U0010ffff") is None and keys.successor("") is None and keys.successor("퟿") == ""


@pytest.mark.parametrize("glob", ["ab*", "[cs]*:1?", "a[b", "a\\*b*", "*x", "[a-c]z", "[^a]b", "", "??", "a[]b", "é[ü]*", "x[]]", "[a"])
def test_glob_bounds_lose_nothing(spark, glob):
    import re

    texts = ["ab", "abc", "b", "c:1x", "s:12", "sab:13", "a[b", "a*b", "a*bz", "zx", "az", "bz", "cz", "bb", "", "xy", "a[]b", "éü", "éüx", "x]", "[a"]
    df = spark.createDataFrame([(t,) for t in texts], "key string")
    got = sorted(r.key for r in K.matching_keys(df, glob).collect())
    assert got == sorted(t for t in texts if re.search(K.glob_pattern(glob).replace("$", r"\Z"), t))
