"""Leaderboards as rows (board, member, score).

Scores combine before their shuffle. Places inside a board come from ``ranked``,
which cuts boards larger than one slice; a top-k keeps k rows per task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studytrail.functions.keys import board_name
from studytrail.operators.answers import REQUIRED, REQUIRED_OLDER, first_task, valid_answers
from studytrail.operators.slices import ROWS_PER_PAGE_SLICE, ROWS_PER_SLICE, in_positions, ranked

# Fixed board names.
TASK_SCORE = "paperSummaryRank_"
TASK_ACCURACY = "paperSummaryRank_rightpercent_"
CUSTOMS_SCORE = "customsRank_"
CUSTOMS_ACCURACY = "customsRank_rightpercent_"

KEY = ("board", "member")

# Up to this k Spark keeps k rows per task and group before the shuffle
# (its window group limit); larger k go through ``ranked``.
SMALL_K = 1000


def _right_counts(answers: DataFrame, required: Sequence[str]) -> DataFrame:
    return (
        valid_answers(answers, required)
        .filter(F.col("IsRight") == 1)
        .groupBy(F.col("TestPaper_User_ID").alias("testpaper_user_id"), F.col("CreateUser").cast("string").alias("member"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _dimension_scores(answers: DataFrame, paper_task: DataFrame, column: str, prefix: str) -> DataFrame:
    counts = _right_counts(answers, REQUIRED).join(first_task(paper_task), "testpaper_user_id")
    return (
        counts.filter(F.col(column) > 0)
        .groupBy(board_name(prefix, F.col(column)).alias("board"), "member")
        .agg(F.sum("n").cast("double").alias("score"))
    )


def task_scores(answers: DataFrame, paper_task: DataFrame) -> DataFrame:
    """Right answers per (task, user)."""
    return _dimension_scores(answers, paper_task, "task_id", TASK_SCORE)


def customs_scores(answers: DataFrame, paper_task: DataFrame) -> DataFrame:
    """Right answers per (customs, user)."""
    return _dimension_scores(answers, paper_task, "customs_id", CUSTOMS_SCORE)


def sitting_scores(answers: DataFrame) -> DataFrame:
    """Right answers per (sitting, user), by the older validation rule."""
    return _right_counts(answers, REQUIRED_OLDER).select(
        board_name(TASK_SCORE, F.col("testpaper_user_id")).alias("board"), "member", F.col("n").cast("double").alias("score")
    )


def accuracy_scores(report: DataFrame, column: str, prefix: str) -> DataFrame:
    """Accuracy of the report last updated per (board, user): the last write wins."""
    return (
        report.filter(F.col(column) > 0)
        .groupBy(board_name(prefix, F.col(column)).alias("board"), F.col("user_id").cast("string").alias("member"))
        .agg(F.max_by("accuracy", "last_seq").alias("score"))
    )


def _ordered(desc: bool) -> list[Column]:
    return [F.desc("score"), F.desc("member")] if desc else [F.asc("score"), F.asc("member")]


def with_ranks(boards: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Add ``rank`` and ``revrank`` (both from 0) and the board's ``size``; ties go by member."""
    placed = ranked(boards, ["board"], ["score", "member"], rows_per_slice)
    return placed.select(
        *boards.columns,
        F.col("pos").alias("rank"),
        (F.col("size") - 1 - F.col("pos")).alias("revrank"),
        "size",
    )


def rank_of(boards: DataFrame, members: DataFrame, desc: bool = False, rows_per_slice: int = ROWS_PER_PAGE_SLICE) -> DataFrame:
    """Rank of the listed (board, member) pairs; absent members give no row.

    Only boards asked about are read beyond their names. Their rows are counted by slice of the
    order, and only slices that hold a listed member are sorted."""
    asked = boards.join(members.select("board").distinct(), "board", "left_semi")
    listed = members.select(*KEY).distinct()
    probes = asked.join(listed, list(KEY), "left_semi")
    placed = ranked(asked, ["board"], ["score", "member"], rows_per_slice, probes=probes)
    rank = F.col("size") - 1 - F.col("pos") if desc else F.col("pos")
    return placed.join(listed, list(KEY), "left_semi").select(*KEY, rank.alias("rank"))


def top_k(boards: DataFrame, k: int, desc: bool = True) -> DataFrame:
    """The first k members of each board; each task keeps at most k rows per board."""
    if k > SMALL_K:
        return by_position(boards, 0, k - 1, desc)
    w = Window.partitionBy("board").orderBy(*_ordered(desc))
    return boards.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).select(
        *KEY, "score", (F.col("place") - 1).cast("bigint").alias("rank")
    )


def _page(start: int, end: int | None, desc: bool) -> tuple[int, int | None]:
    """Places start..end of a descending order as places of the ascending one."""
    if not desc:
        return start, end
    return (0 if end is None else -1 - end), -1 - start


def by_position(
    boards: DataFrame, start: int, end: int, desc: bool = False, rows_per_slice: int = ROWS_PER_PAGE_SLICE
) -> DataFrame:
    """Members at positions start..end of each board. Of a large board only the slices that the
    positions fall into are sorted."""
    placed = ranked(boards, ["board"], ["score", "member"], rows_per_slice, page=_page(start, end, desc))
    place = F.col("size") - 1 - F.col("pos") if desc else F.col("pos")
    return placed.filter(in_positions(place, F.col("size"), start, end)).select(*KEY, "score", place.alias("rank"))


def by_score(
    boards: DataFrame,
    low: float,
    high: float,
    desc: bool = False,
    offset: int = 0,
    count: int | None = None,
    rows_per_slice: int = ROWS_PER_PAGE_SLICE,
) -> DataFrame:
    """Members with a score in [low, high], optionally a page of them in order."""
    inside = boards.filter(F.col("score").between(low, high))
    if offset == 0 and count is None:
        return inside.select(*KEY, "score")
    if count is not None and offset + count <= SMALL_K:
        w = Window.partitionBy("board").orderBy(*_ordered(desc))
        placed = inside.withColumn("place", F.row_number().over(w))
        page = (F.col("place") <= offset + count) & (F.col("place") > offset)
        return placed.filter(page).select(*KEY, "score")
    last = None if count is None else offset + count - 1
    placed = ranked(inside, ["board"], ["score", "member"], rows_per_slice, page=_page(offset, last, desc))
    place = F.col("size") - 1 - F.col("pos") if desc else F.col("pos")
    page = place >= offset
    if count is not None:
        page = page & (place < offset + count)
    return placed.filter(page).select(*KEY, "score")


def count_by_score(boards: DataFrame, low: float, high: float) -> DataFrame:
    """Members per board in the score range, and the board's size."""
    return boards.groupBy("board").agg(
        F.count_if(F.col("score").between(low, high)).alias("n"), F.count(F.lit(1)).alias("size")
    )


def scores_of(boards: DataFrame, members: DataFrame, default: float | None = 0.0) -> DataFrame:
    """Score of each listed (board, member); ``default`` when absent."""
    found = members.select(*KEY).join(boards, list(KEY), "left")
    score = F.col("score") if default is None else F.coalesce("score", F.lit(default))
    return found.select(*KEY, score.alias("score"))


def increment(boards: DataFrame, deltas: DataFrame) -> DataFrame:
    """Add (board, member, delta) rows to the scores; new members start at the delta."""
    both = boards.select(*KEY, "score").unionByName(deltas.select(*KEY, F.col("delta").alias("score")))
    return both.groupBy(*KEY).agg(F.sum("score").alias("score"))


def upsert(boards: DataFrame, updates: DataFrame, seq: str | None = None) -> DataFrame:
    """Set or replace scores; among several updates of a member the highest ``seq`` wins."""
    order = F.col(seq) if seq else F.lit(0).cast("bigint")
    old = boards.select(*KEY, "score", F.lit(0).alias("__new"), F.lit(None).cast("bigint").alias("__seq"))
    new = updates.select(*KEY, "score", F.lit(1).alias("__new"), order.cast("bigint").alias("__seq"))
    return old.unionByName(new).groupBy(*KEY).agg(
        F.max_by("score", F.struct("__new", "__seq")).alias("score")
    )


def remove_members(boards: DataFrame, members: DataFrame) -> DataFrame:
    return boards.join(members.select(*KEY), list(KEY), "left_anti")


def drop_boards(boards: DataFrame, names: Sequence[str]) -> DataFrame:
    return boards.filter(~F.col("board").isin(list(names)))


def remove_by_position(boards: DataFrame, start: int, end: int, rows_per_slice: int = ROWS_PER_PAGE_SLICE) -> DataFrame:
    """The boards without the members at positions start..end, which are found as a page."""
    gone = by_position(boards, start, end, rows_per_slice=rows_per_slice)
    return boards.join(gone.select(*KEY), list(KEY), "left_anti").select(*KEY, "score")


def remove_by_score(boards: DataFrame, low: float, high: float) -> DataFrame:
    return boards.filter(~F.col("score").between(low, high))


def union_boards(boards: DataFrame, names: Sequence[str], dest: str) -> DataFrame:
    """Members of any listed board, scores summed."""
    return (
        boards.filter(F.col("board").isin(list(names)))
        .groupBy("member")
        .agg(F.sum("score").alias("score"))
        .select(F.lit(dest).alias("board"), "member", "score")
    )


def intersect_boards(boards: DataFrame, names: Sequence[str], dest: str) -> DataFrame:
    """Members of all listed boards, scores summed. A member is once in each board."""
    wanted = list(dict.fromkeys(names))
    return (
        boards.filter(F.col("board").isin(wanted))
        .groupBy("member")
        .agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == len(wanted))
        .select(F.lit(dest).alias("board"), "member", "score")
    )
