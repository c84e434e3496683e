"""Publishing a running report: summary cells and leaderboards of the learners that changed.

A run is driven by both sides: by the answers recorded since the run before, and by the rows
that the dimension feeds changed since, joined back to the learners they concern. It computes
the reports of these learners from the merged cells and the dimensions as they now are, and
writes them under its number; what was published of them and is no longer there gets a
tombstone, a row without a score. The run's commit record, created last, names the batches it
took, so a run that dies is done again under the same number. Readers keep the newest row of
a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.functions.keys import board_name, key_long
from studytrail.operators import answers as A
from studytrail.operators import boards as B
from studytrail.sources import celltables
from studytrail.streaming.batches import BatchFolder
from studytrail.streaming.commits import Batch, CommitLog
from studytrail.streaming.reports import CELLS_SCHEMA, AnswerReport, paper_tasks_of, question_points_of

SUMMARIES = {"paper": A.PAPER, "customs": A.CUSTOMS}
BOARD_SCHEMA = "board string, member string, score double, version long"


def score_boards(cells: DataFrame, paper_task: DataFrame) -> DataFrame:
    """Right answers per (task, learner) and per (customs, learner), from question cells."""
    counts = A.with_tasks(cells.groupBy(*A.PAPER).agg(F.sum("right").alias("n")), paper_task)
    made = [
        counts.filter(F.col(column) > 0)
        .groupBy(board_name(prefix, F.col(column)).alias("board"), F.col("user_id").cast("string").alias("member"))
        .agg(F.sum("n").cast("double").alias("score"))
        .filter("score > 0")
        for column, prefix in (("task_id", B.TASK_SCORE), ("customs_id", B.CUSTOMS_SCORE))
    ]
    return reduce(DataFrame.union, made)


def taken(batches: list[Batch]) -> dict[str, int]:
    """The last batch of each generation; keys are text, as in JSON."""
    return {str(g): n for g, n in sorted(batches)}


class Publisher:
    """Published tables under ``root`` of an answer report, whose dimensions are cell tables."""

    def __init__(self, report: AnswerReport, points_path: str, tasks_path: str, root: str | None = None):
        self.spark: SparkSession = report.spark
        self.report = report
        self.root = root or f"{report.root}/published"
        self.commits = CommitLog(self.spark, self.root)
        self.boards = BatchFolder(self.spark, f"{self.root}/boards", self.commits)
        self.points_path, self.tasks_path = points_path, tasks_path
        # What drives a run: the folders, their rows, and the key that leads to learners.
        self.sources = {
            "cells": (report.cells, CELLS_SCHEMA, F.col("user_id"), "user_id"),
            "tasks": (celltables.cell_batches(self.spark, tasks_path), celltables.CELL_SCHEMA, key_long(F.col("rowkey"), 0), "testpaper_user_id"),
            "points": (celltables.cell_batches(self.spark, points_path), celltables.CELL_SCHEMA, key_long(F.col("rowkey"), 0), "question_id"),
        }

    def _summary_path(self, kind: str) -> str:
        return f"{self.root}/{kind}_summary"

    def _changes(self, done: dict[str, dict[str, int]]) -> tuple[dict[str, dict[str, int]], list[tuple[str, DataFrame | None]]]:
        """What each source has come to, and the keys it changed since ``done``; None for all keys,
        where a base holds batches that were not taken one by one."""
        upto, changed = {}, []
        for name, (folder, schema, key, column) in self.sources.items():
            before = done.get(name, {})
            is_new = lambda b: b[1] > before.get(str(b[0]), -1)  # noqa: B023, E731
            batches, ends = folder.batches(), [end for end, _ in folder.bases()]
            upto[name] = {**before, **{g: max(n, before.get(g, -1)) for g, n in taken(batches + ends).items()}}
            if any(map(is_new, ends)):
                changed.append((column, None))
            elif new := [b for b in batches if is_new(b)]:
                changed.append((column, folder.read_some(new, schema).select(key.alias(column)).distinct()))
        return upto, changed

    def _touched(self, cells: DataFrame, changed: list[tuple[str, DataFrame | None]]) -> DataFrame | None:
        """Learners whose answers or dimensions changed; None for all."""
        if any(keys is None for _, keys in changed):
            return None
        learners = [
            keys if column == "user_id" else cells.join(keys, column, "left_semi").select("user_id") for column, keys in changed
        ]
        return reduce(DataFrame.union, learners).distinct()

    def run(self) -> Batch | None:
        """Publish what is new; the run's number, or None if there is nothing new."""
        runs = self.commits.batches()
        upto, changed = self._changes(self.commits.content(runs[-1]) if runs else {})
        if not changed:
            return None
        number = (0, runs[-1][1] + 1 if runs else 0)
        stored = self.report.cells.read(CELLS_SCHEMA)
        touched = self._touched(stored, changed)
        if touched is not None:
            touched = touched.persist()
        mine = lambda df, column: df if touched is None else df.join(
            touched.select(F.col("user_id").alias("__learner")), column.eqNullSafe(F.col("__learner")), "left_semi"
        )
        cells = A.merge_cells(mine(stored, F.col("user_id")), [*A.PAPER, "question_id"]).persist()
        points = question_points_of(celltables.current_cells(self.spark, self.points_path)).persist()
        tasks = paper_tasks_of(celltables.current_cells(self.spark, self.tasks_path)).persist()
        rows = self.report.stored_rows()
        made = {
            "paper": A.paper_summary(cells, points, tasks, self.report.mode, rows).persist(),
            "customs": A.customs_summary(cells, points, tasks, self.report.mode, rows).persist(),
        }
        version = F.lit(number[1]).cast("bigint")
        try:
            for kind, keys in SUMMARIES.items():
                celltables.create_table(self.spark, self._summary_path(kind), ["s"])
                rows = A.summary_rows(made[kind].withColumn("last_seq", version), keys)
                old = mine(self.summary_cells(kind), key_long(F.col("rowkey"), 0)).join(rows, ["rowkey", "qualifier"], "left_anti")
                gone = old.select("rowkey", "family", "qualifier", version.alias("version"), F.lit(None).cast("string").alias("value"))
                celltables.put_cells(self.spark, self._summary_path(kind), rows.union(gone), number)
            boards = (
                score_boards(cells, tasks)
                .union(B.accuracy_scores(made["paper"], "TaskID", B.TASK_ACCURACY))
                .union(B.accuracy_scores(made["customs"], "customs_id", B.CUSTOMS_ACCURACY))
            ).persist()
            old = mine(self.current_boards(), F.col("member").try_cast("bigint")).join(boards, list(B.KEY), "left_anti")
            gone = old.select(*B.KEY, F.lit(None).cast("double").alias("score"))
            self.boards.write(boards.union(gone).withColumn("version", version), number)
            boards.unpersist()
            self.commits.add(number, upto)
        finally:
            for df in (cells, points, tasks, *made.values(), *([touched] if touched is not None else [])):
                df.unpersist()
        return number

    def summary_cells(self, kind: str) -> DataFrame:
        return celltables.current_cells(self.spark, self._summary_path(kind), self.commits).filter("value is not null")

    def current_boards(self) -> DataFrame:
        return newest(self.boards.read(BOARD_SCHEMA)).filter("score is not null").drop("version")

    def compact(self) -> None:
        self.boards.compact(newest, BOARD_SCHEMA)
        for kind in SUMMARIES:
            celltables.compact_table(self.spark, self._summary_path(kind), commits=self.commits)


def newest(rows: DataFrame) -> DataFrame:
    """The newest row per (board, member), a tombstone where the score went away."""
    return rows.groupBy(*B.KEY).agg(F.max_by("score", "version").alias("score"), F.max("version").alias("version"))
