"""The running answer report and the two dimension feeds.

A batch adds mergeable question cells for its own events only; reports are finished
from the merged cells when read, with the dimensions as they then are. A batch counts
once its commit record exists, which is created last; positions that recorded batches
applied are skipped, so a restart after any failure, on the same checkpoint or a new one,
counts every event once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from studytrail.functions.keys import (
    ANSWER_SCHEMA,
    PAPER_TASK_SCHEMA,
    QUESTION_POINT_SCHEMA,
    join_key,
    parse_json,
)
from studytrail.operators import answers as A
from studytrail.sources import celltables
from studytrail.streaming.batches import Batch, BatchFolder, generation
from studytrail.streaming.commits import CommitLog
from studytrail.streaming.offsets import Positions, told_apart

# Events are ordered by time; offsets of different partitions do not compare.
PLACE_IN_TIME = "struct<timestamp:timestamp,partition:int,offset:bigint>"
CELLS_SCHEMA = (
    "user_id long, testpaper_user_id long, question_id long, attempts long, right long, wrong long, "
    f"first_seq {PLACE_IN_TIME}, first_right int, last_seq {PLACE_IN_TIME}, last_right int"
)
# Messages set aside: rejected ones, and those at positions applied before.
ASIDE_SCHEMA = "topic string, partition int, offset long, key string, value string, reason string"


def decode_answers(records: DataFrame) -> DataFrame:
    """Answer fields next to the record, with ``log_offset``, the place in the order of events:
    time, then partition and offset. A message key may be any."""
    return records.select(
        "key", "value", "topic", "partition", "offset",
        parse_json(F.col("value"), ANSWER_SCHEMA).alias("m"),
        F.struct("timestamp", "partition", F.col("offset").cast("bigint").alias("offset")).alias("log_offset"),
    ).select("key", "value", "topic", "partition", "offset", "m.*", "log_offset")


def feed_version(records: DataFrame) -> Column:
    """Version of the cells a message writes: its time in microseconds, else its offset."""
    offset = F.col("offset").cast("bigint")
    return F.coalesce(F.unix_micros("timestamp"), offset) if "timestamp" in records.columns else offset


class AnswerReport:
    """Tables of the running report under one root folder.

    ``ordered`` says that the source keeps the order of offsets and repeats no position inside
    one batch, as a topic does. ``checkpoint`` may be a new one at any time: positions applied
    under an old one stay applied."""

    def __init__(
        self, spark: SparkSession, root: str, mode: str = "clean", ordered: bool = False, checkpoint: str | None = None
    ):
        self.spark = spark
        self.mode = mode
        self.ordered = ordered
        self.commits = CommitLog(spark, root)
        self.cells = BatchFolder(spark, f"{root}/question_cells", self.commits)
        self.aside = BatchFolder(spark, f"{root}/set_aside", self.commits)
        self.positions = Positions(spark, f"{root}/positions", self.commits)
        self.root = root
        self.checkpoint = checkpoint or f"{root}/checkpoint"
        self.generation: int | None = None
        self.before: list[Batch] | None = None

    def apply(self, records: DataFrame, batch_id: int) -> None:
        """One micro-batch: three folders, then the record that makes them count. The history is
        listed once per start of the stream."""
        if self.generation is None:
            self.generation = generation(self.spark, self.root, self.checkpoint)
        batch = (self.generation, batch_id)
        if self.commits.has(batch):
            # Recorded, but the stream died before it noted so itself.
            self.positions.check(batch, records, self.ordered)
            return
        if self.before is None:
            self.before = self.commits.last_of_each()
        records = records.persist()
        applied = self.positions.after(self.before, self.ordered)
        told = told_apart(records, applied, self.ordered).persist()
        fresh = decode_answers(told.filter("is_new")).persist()
        try:
            self.cells.write(A.question_cells(fresh, self.mode), batch)
            left_out = ~F.coalesce(A.is_counted(self.mode), F.lit(False))
            columns = ["topic", "partition", "offset", "key", "value"]
            rejected = fresh.filter(left_out).select(*columns, F.lit("rejected").alias("reason"))
            again = told.filter("is_again").select(*columns, F.lit("applied").alias("reason"))
            self.aside.write(rejected.union(again), batch)
            self.positions.write(batch, records, applied, self.ordered)
            self.commits.add(batch, {f.root.rsplit("/", 1)[1]: f.name(batch) for f in self._folders()})
            self.before = [batch]
        finally:
            for df in (fresh, told, records):
                df.unpersist()

    def _folders(self) -> list[BatchFolder]:
        return [self.cells, self.aside, self.positions.folder]

    def writer(self, records: DataFrame) -> DataStreamWriter:
        self.before = None
        return records.writeStream.foreachBatch(self.apply).option("checkpointLocation", self.checkpoint)

    def question_cells(self) -> DataFrame:
        return A.merge_cells(self.cells.read(CELLS_SCHEMA), [*A.PAPER, "question_id"])

    def rejected(self) -> DataFrame:
        return self.aside.read(ASIDE_SCHEMA).filter("reason = 'rejected'").drop("reason")

    def passed_over(self) -> DataFrame:
        """Messages at positions that were applied already."""
        return self.aside.read(ASIDE_SCHEMA).filter("reason = 'applied'").drop("reason")

    def compact(self, before: Batch | None = None) -> Batch | None:
        """Fold finished batches together; a job of its own, beside the stream. Records of batches
        that an earlier call folded, and whose folders are gone, are removed."""
        folded = set(self.commits.batches()).difference(*[f.stored() for f in self._folders()])
        self.aside.compact(lambda r: r, ASIDE_SCHEMA, before)
        self.positions.compact(before, self.ordered)
        end = self.cells.compact(lambda c: A.merge_cells(c, [*A.PAPER, "question_id"]), CELLS_SCHEMA, before)
        self.commits.forget(folded)
        return end

    def stored_rows(self) -> int | None:
        """Rows the batches hold, as their files state them; only compat reports ask."""
        return self.cells.read(CELLS_SCHEMA).count() if self.mode == "compat" else None

    def papers(self, question_point: DataFrame, paper_task: DataFrame) -> DataFrame:
        return A.paper_summary(self.question_cells(), question_point, paper_task, self.mode, self.stored_rows())

    def customs(self, question_point: DataFrame, paper_task: DataFrame) -> DataFrame:
        return A.customs_summary(self.question_cells(), question_point, paper_task, self.mode, self.stored_rows())


def question_point_cells(records: DataFrame) -> DataFrame:
    """Question/point messages as cells: key question_point, one constant column."""
    m = records.select(feed_version(records).alias("version"), parse_json(F.col("value"), QUESTION_POINT_SCHEMA).alias("m"))
    return m.select(
        join_key(F.col("m.QuestionId"), F.col("m.PointId")).alias("rowkey"),
        F.lit("qp").alias("family"),
        F.lit("coeffcient").alias("qualifier"),
        "version",
        F.lit("0").alias("value"),
    )


def paper_task_cells(records: DataFrame) -> DataFrame:
    """Paper/task messages as cells: key sitting_task_customs, columns TaskID and UserID."""
    m = records.select(feed_version(records).alias("version"), parse_json(F.col("value"), PAPER_TASK_SCHEMA).alias("m"))
    pair = F.array(
        *[
            F.struct(F.lit(c).alias("qualifier"), F.coalesce(F.col(f"m.{c}").cast("string"), F.lit("null")).alias("value"))
            for c in ("TaskID", "UserID")
        ]
    )
    return m.select(
        join_key(F.col("m.testPaper_user_id"), F.col("m.TaskID"), F.col("m.CustomsID")).alias("rowkey"),
        F.lit("i").alias("family"),
        "version",
        F.explode(pair).alias("c"),
    ).select("rowkey", "family", "c.qualifier", "version", "c.value")


def feed_cells(
    spark: SparkSession, records: DataFrame, to_cells, path: str, family: str, checkpoint: str | None = None
) -> DataStreamWriter:
    """A dimension feed: every batch upserts its cells into the cell table at ``path``."""
    celltables.create_table(spark, path, [family])
    checkpoint = checkpoint or f"{path}/checkpoint"
    number: list[int] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not number:
            number.append(generation(spark, path, checkpoint))
        # Equal cells of one batch collapse before they are written.
        celltables.put_cells(spark, path, celltables.latest(to_cells(batch)), (number[0], batch_id))

    return records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def question_points_of(cells: DataFrame) -> DataFrame:
    """(QuestionId, PointId) from the feed's row keys."""
    key = F.split("rowkey", "_")
    return cells.select(
        F.get(key, F.lit(0)).try_cast("bigint").alias("QuestionId"), F.get(key, F.lit(1)).try_cast("bigint").alias("PointId")
    ).distinct()


def paper_tasks_of(cells: DataFrame) -> DataFrame:
    """(testPaper_user_id, TaskID, CustomsID) from the feed's row keys."""
    key = F.split("rowkey", "_")
    names = ("testPaper_user_id", "TaskID", "CustomsID")
    return cells.select(
        *[F.get(key, F.lit(i)).try_cast("bigint").alias(n) for i, n in enumerate(names)]
    ).distinct()
