"""Relational source options and the append that a rerun does not repeat."""

import pytest

from studytrail.functions import keys
from studytrail.runtime import shared_folder
from studytrail.sources import jdbc
from pyspark.sql import functions as F


def test_read_options():
    assert jdbc.read_options("t") == {"dbtable": "t", "fetchsize": "10000"}
    opts = jdbc.read_options("t", "id", 0, 100, 8)
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("id", "0", "100", "8")
    with pytest.raises(ValueError):
        jdbc.read_options("t", "id")


def test_new_rows(spark):
    rows = spark.createDataFrame([(1, None), (1, 2), (3, 4)], "a long, b long")
    stored = spark.createDataFrame([(1, None), (3, 4), (3, 4)], "a long, b long")
    assert [tuple(r) for r in jdbc.new_rows(rows, stored, ["a", "b"]).collect()] == [(1, 2)]
    again = stored.unionByName(jdbc.new_rows(rows, stored, ["a", "b"]))
    assert jdbc.new_rows(rows, again, ["a", "b"]).count() == 0


def test_keys(spark):
    df = spark.createDataFrame([(1, None, "5_x")], "a long, b long, k string")
    row = df.select(
        keys.join_key(F.col("a"), F.col("b")).alias("joined"),
        keys.key_long(F.col("k"), 0).alias("n"),
        keys.key_long(F.col("k"), 1).alias("bad"),
        keys.key_part(F.col("k"), 4).alias("absent"),
        keys.ratio(F.lit(0), F.lit(0)).alias("r"),
        keys.positive(F.col("b")).alias("p"),
        keys.outcome(F.lit("7_0")).alias("o"),
        keys.text_count(keys.count_text(F.lit(4))).alias("c"),
        keys.board_name("x_", F.col("a")).alias("board"),
    ).first()
    assert tuple(row) == ("1_null", 5, None, None, None, None, "wrong", 4, "x_1")
    struct = df.select(keys.to_json(F.struct("a")).alias("j")).first().j
    assert struct == '{"a":1}'
    bad = df.select(keys.parse_json(F.lit("nope"), keys.QUESTION_POINT_SCHEMA).alias("m")).select("m.*").first()
    assert tuple(bad) == (None, None, None)


def test_shared_folder_is_new_each_time(spark):
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
