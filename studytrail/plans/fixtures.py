"""Learning-platform tables derived from the given ``events`` and ``part`` tables.

Every view covers its whole input table. ``FIXTURE_SQL`` states the same views for
the SQL check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Source = Callable[[str], DataFrame]


def tables(spark: SparkSession, sf_dir: str) -> Source:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def operations(events: DataFrame, resources: int = 4) -> DataFrame:
    """Operation log: every event but the views; signup enters, the rest is activity. Some
    rows have no mark (``at``), some no id."""
    i = F.col("event_id")
    return events.filter(F.col("event_type") != "view").select(
        F.when(i % 53 != 5, i + 1).alias("id"),
        F.col("user_id").alias("uid"),
        (i % 3).alias("cid"),
        (i % resources).alias("rid"),
        (i % 11).alias("aid"),
        (i % 13).alias("hid"),
        (i % 17).alias("qid"),
        (i % 2 + 1).alias("rt"),
        F.when(i % 17 == 3, None)
        .when(F.col("event_type") == "signup", 1)
        .when(F.col("event_type") == "purchase", 2)
        .otherwise(0)
        .alias("at"),
        F.col("value").alias("sp"),
        F.col("ts").alias("ct"),
        (i % 3 + 1).alias("appid"),
        (i % 180).alias("lo"),
        (i % 90).alias("la"),
        (i % 2).alias("net"),
        (i % 7).alias("de"),
        (i % 4).alias("v"),
        (i % 19).alias("sn"),
        (i % 23).alias("lt"),
        (i % 2).alias("il"),
    )


def heartbeats(events: DataFrame) -> DataFrame:
    i = F.col("event_id")
    return events.filter(F.col("event_type") == "view").select(
        F.col("user_id").alias("uid"),
        (i % 3).alias("cid"),
        (i % 4).alias("rid"),
        (i % 2 + 1).alias("rt"),
        F.col("ts").alias("ct"),
    )


def answers(events: DataFrame) -> DataFrame:
    """Answer events in stream order; ``error`` events carry no IsRight."""
    i = F.col("event_id")
    return events.select(
        i.alias("log_offset"),
        "ts",
        i.alias("id"),
        (F.col("user_id") * 4 + i % 4).alias("TestPaper_User_ID"),
        ((i * 7) % 41).alias("QuestionID"),
        (F.col("user_id") % 5).alias("BatchCourses_ID"),
        (i % 4).alias("TestPaper_ID"),
        F.col("user_id").alias("CreateUser"),
        F.when(F.col("event_type").isin("purchase", "click"), 1)
        .when(F.col("event_type") == "error", None)
        .otherwise(0)
        .alias("IsRight"),
    )


def question_points(part: DataFrame) -> DataFrame:
    """Question to knowledge point; questions 37..40 of the answers have none."""
    return part.select(
        (F.col("p_partkey") % 37).alias("QuestionId"), (F.col("p_size") % 12).alias("PointId")
    ).distinct()


def paper_tasks(events: DataFrame) -> DataFrame:
    """Paper sitting to task and customs, assigned at signup; ids of 0 mean none."""
    sitting = F.col("user_id") * 4 + F.col("event_id") % 4
    return (
        events.filter(F.col("event_type") == "signup")
        .select(
            sitting.alias("testPaper_user_id"),
            (sitting % 9).alias("TaskID"),
            (sitting % 6).alias("CustomsID"),
            F.col("user_id").alias("UserID"),
        )
        .distinct()
    )


def cell_versions(events: DataFrame) -> DataFrame:
    """Wide-column cells with all their versions."""
    i = F.col("event_id")
    return events.select(
        F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("rowkey"),
        F.when(i % 2 == 0, "course").otherwise("info").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.floor(i / 25).cast("bigint").alias("version"),
        (i % 110).cast("string").alias("value"),
        i.alias("seq"),
    )


def cells(events: DataFrame) -> DataFrame:
    """Current cells: the newest event of each (rowkey, family, qualifier)."""
    i = F.col("event_id")
    newest = events.groupBy("user_id", (i % 2).alias("odd"), "event_type").agg(F.max(i).alias("event_id"))
    return newest.select(
        F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("rowkey"),
        F.when(F.col("odd") == 0, "course").otherwise("info").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.floor(i / 25).cast("bigint").alias("version"),
        (i % 110).cast("string").alias("value"),
    )


def boards(events: DataFrame) -> DataFrame:
    """A leaderboard for each hour of the day: purchases and clicks per learner. Who made none in an
    hour is not on its board."""
    return (
        events.filter(F.col("event_type").isin("purchase", "click"))
        .groupBy(
            F.concat(F.lit("board_"), F.hour("ts").cast("string")).alias("board"),
            F.col("user_id").cast("string").alias("member"),
        )
        .agg(F.count(F.lit(1)).cast("double").alias("score"))
    )


def member_sets(events: DataFrame) -> DataFrame:
    """Sets keyed by event type; members are user and event parity."""
    return events.select(
        F.col("event_type").alias("key"),
        F.concat_ws("_", F.col("user_id").cast("string"), (F.col("event_id") % 16).cast("string")).alias("member"),
    ).distinct()


def hashes(events: DataFrame) -> DataFrame:
    """Hash per user: field = event type, value = number of events."""
    return events.groupBy(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("key"),
        F.col("event_type").alias("field"),
    ).agg(F.count(F.lit(1)).cast("string").alias("value"))


def pairs(events: DataFrame) -> DataFrame:
    """Key/value strings: last event per user and type."""
    return events.groupBy(
        F.concat_ws(":", F.col("event_type"), F.col("user_id").cast("string")).alias("key")
    ).agg(F.max("event_id").cast("string").alias("value"))


def lists(events: DataFrame) -> DataFrame:
    """List per user: one entry per event in event order (positions have gaps)."""
    return events.select(
        F.concat(F.lit("list_"), F.col("user_id").cast("string")).alias("key"),
        F.col("event_id").alias("pos"),
        F.col("event_type").alias("value"),
    )


def messages(answers_df: DataFrame, topic: str = "answers", partitions: int = 4) -> DataFrame:
    """Answers as topic records keyed by learner, whose partition they share."""
    fields = (
        "id", "TestPaper_User_ID", "QuestionID", "BatchCourses_ID", "TestPaper_ID", "CreateUser", "IsRight",
    )
    return answers_df.select(
        F.col("CreateUser").cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("CreateUser") % partitions).cast("int").alias("partition"),
        F.col("log_offset").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


_OPS = """select case when event_id%53<>5 then event_id+1 end as id, user_id as uid, event_id%3 as cid, event_id%{r} as rid, event_id%11 as aid,
 event_id%13 as hid, event_id%17 as qid, event_id%2+1 as rt,
 case when event_id%17=3 then null when event_type='signup' then 1 when event_type='purchase' then 2 else 0 end as "at",
 value as sp, ts as ct, event_id%3+1 as appid, event_id%180 as lo, event_id%90 as la, event_id%2 as net,
 event_id%7 as de, event_id%4 as v, event_id%19 as sn, event_id%23 as lt, event_id%2 as il
 from events where event_type<>'view'"""


def ops_sql(resources: int = 4) -> str:
    return _OPS.format(r=resources)


FIXTURE_SQL = {
    "heartbeat": """select user_id as uid, event_id%3 as cid, event_id%4 as rid, event_id%2+1 as rt, ts as ct
 from events where event_type='view'""",
    "answers": """select event_id as log_offset, ts, event_id as id, user_id*4+event_id%4 as TestPaper_User_ID,
 (event_id*7)%41 as QuestionID, user_id%5 as BatchCourses_ID, event_id%4 as TestPaper_ID, user_id as CreateUser,
 case when event_type in ('purchase','click') then 1 when event_type='error' then null else 0 end as IsRight
 from events""",
    "question_point": "select distinct p_partkey%37 as QuestionId, p_size%12 as PointId from part",
    "paper_task": """select distinct user_id*4+event_id%4 as testPaper_user_id, (user_id*4+event_id%4)%9 as TaskID,
 (user_id*4+event_id%4)%6 as CustomsID, user_id as UserID from events where event_type='signup'""",
    "cell_versions": """select concat('u',lpad(cast(user_id as varchar),8,'0')) as rowkey,
 case when event_id%2=0 then 'course' else 'info' end as family, event_type as qualifier,
 cast(floor(event_id/25) as bigint) as version, cast(event_id%110 as varchar) as value, event_id as seq from events""",
    "cells": """select rowkey, family, qualifier, version, value from (
 select concat('u',lpad(cast(user_id as varchar),8,'0')) as rowkey,
 case when event_id%2=0 then 'course' else 'info' end as family, event_type as qualifier,
 cast(floor(event_id/25) as bigint) as version, cast(event_id%110 as varchar) as value,
 row_number() over (partition by user_id, event_id%2, event_type order by event_id desc) as rn from events) z
 where rn=1""",
    "boards": """select concat('board_', cast(hour(ts) as varchar)) as board, cast(user_id as varchar) as member,
 cast(count(*) as double) as score from events where event_type in ('purchase','click') group by 1, 2""",
    "member_sets": """select distinct event_type as key,
 concat(cast(user_id as varchar), '_', cast(event_id%16 as varchar)) as member from events""",
    "hashes": """select concat('user_', cast(user_id as varchar)) as key, event_type as field,
 cast(count(*) as varchar) as value from events group by 1, 2""",
    "pairs": """select concat(event_type, ':', cast(user_id as varchar)) as key,
 cast(max(event_id) as varchar) as value from events group by 1""",
    "lists": """select concat('list_', cast(user_id as varchar)) as key, event_id as pos, event_type as value
 from events""",
}
