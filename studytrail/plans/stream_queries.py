"""Streaming jobs run to the end of a file source, with batch SQL of the same result."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.operators import boards as B
from studytrail.operators.answers import COUNTS
from studytrail.plans import fixtures as X
from studytrail.plans.registry import Registry, ctes
from studytrail.plans.report_queries import accuracy_sql, clean_summary_sql, compat_summary_sql, score_sql
from studytrail.runtime import temporary_folder
from studytrail.sources import celltables
from studytrail.sources.topics import file_stream, to_files, trigger
from studytrail.streaming import relay, reports
from studytrail.streaming.batches import BatchFolder
from studytrail.streaming.commits import CommitLog
from studytrail.streaming.offsets import Positions, told_apart
from studytrail.streaming.publish import Publisher


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # A file source takes a folder or a pattern; the braces also match a single file.
    return file_stream(spark, f"{sf_dir}/{{{name}}}.parquet", schema)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.messages(X.answers(_table_stream(spark, sf_dir, "events")))


def _finish(writer) -> None:
    trigger(writer).start().awaitTermination()


def _relay(rewrite):
    def run(spark, sf_dir):
        root = temporary_folder(spark, "relay")
        out = rewrite(_messages(spark, sf_dir), "target")
        _finish(to_files(out, f"{root}/target", f"{root}/checkpoint"))
        return spark.read.schema("key string, value string, topic string").parquet(f"{root}/target").select("value", "topic")

    return run


def _report(mode: str, kind: str):
    def run(spark, sf_dir):
        report = reports.AnswerReport(spark, temporary_folder(spark, "report"), mode)
        _finish(report.writer(_messages(spark, sf_dir)))
        table = X.tables(spark, sf_dir)
        points, tasks = X.question_points(table("part")), X.paper_tasks(table("events"))
        made = report.papers(points, tasks) if kind == "paper" else report.customs(points, tasks)
        return made.drop("last_seq")

    return run


def _published(make):
    """Report and both feeds from their messages, published after each half of the answers."""

    def run(spark, sf_dir):
        root = temporary_folder(spark, "published")
        for name, path in (("points", f"{root}/points"), ("tasks", f"{root}/tasks")):
            records, to_cells, family = _feed(spark, sf_dir, name)
            _finish(reports.feed_cells(spark, records, to_cells, path, family))
        messages = _messages(spark, sf_dir)
        until = F.col("timestamp") < F.lit("2024-01-15").cast("timestamp")
        report = reports.AnswerReport(spark, f"{root}/report", checkpoint=f"{root}/checkpoint-1")
        publisher = Publisher(report, f"{root}/points", f"{root}/tasks")
        _finish(report.writer(messages.filter(until)))
        publisher.run()
        publisher.compact()
        second = reports.AnswerReport(spark, f"{root}/report", checkpoint=f"{root}/checkpoint-2")
        _finish(second.writer(messages))
        publisher.run()
        return make(publisher)

    return run


def _moved_task_records(spark, sf_dir):
    """The task feed again, with a second row for every signup: its sitting moves to customs and
    tasks that come first in byte order, some of them none."""
    records, to_cells, family = _task_records(spark, sf_dir, moved=True)
    return records, to_cells, family


def _late_tasks(spark, sf_dir):
    """Answers published first, then the points and tasks, then the tasks that change."""
    root = temporary_folder(spark, "late")
    for name, family in (("points", "qp"), ("tasks", "i")):
        celltables.create_table(spark, f"{root}/{name}", [family])
    report = reports.AnswerReport(spark, f"{root}/report")
    publisher = Publisher(report, f"{root}/points", f"{root}/tasks")
    _finish(report.writer(_messages(spark, sf_dir)))
    publisher.run()
    for name, make in (("points", _point_records), ("tasks", _task_records), ("tasks", _moved_task_records)):
        records, to_cells, family = make(spark, sf_dir)
        checkpoint = f"{root}/checkpoint-{make.__name__}"
        _finish(reports.feed_cells(spark, records, to_cells, f"{root}/{name}", family, checkpoint))
        publisher.run()
    return publisher.current_boards()


def _summary_cells(publisher: Publisher) -> DataFrame:
    tables = [publisher.summary_cells(kind).withColumn("report", F.lit(kind)) for kind in ("paper", "customs")]
    return tables[0].union(tables[1]).drop("version")


def _summary_cells_sql(kind: str) -> str:
    key = {"paper": "testpaper_user_id", "customs": "customs_id"}[kind]
    rows = " union all ".join(
        f"select concat(cast(user_id as varchar), '_', cast({key} as varchar)) as rowkey, 's' as family, '{c}' as qualifier,"
        f" cast({c} as varchar) as value, '{kind}' as report from rep"
        for c in COUNTS
    )
    return f"select * from (with rep as ({clean_summary_sql(kind)}) {rows}) z"


def _restart(spark, sf_dir):
    """The report over two streams: the first up to 15 January, then, its checkpoint lost and its
    batches folded, a new one over all messages."""
    root = temporary_folder(spark, "restart")
    everything = _messages(spark, sf_dir)
    until = F.col("timestamp") < F.lit("2024-01-15").cast("timestamp")
    first = reports.AnswerReport(spark, root, checkpoint=f"{root}/checkpoint-1")
    _finish(first.writer(everything.filter(until)))
    first.compact()
    second = reports.AnswerReport(spark, root, checkpoint=f"{root}/checkpoint-2")
    _finish(second.writer(everything))
    table = X.tables(spark, sf_dir)
    return second.papers(X.question_points(table("part")), X.paper_tasks(table("events"))).drop("last_seq")


def _rejects(spark, sf_dir):
    report = reports.AnswerReport(spark, temporary_folder(spark, "rejects"))
    _finish(report.writer(_messages(spark, sf_dir)))
    return report.rejected().select("partition", "offset", "key")


def _crash(spark, sf_dir):
    """The report over a stream that dies with all folders of a batch written but not recorded, and
    then over a new stream with a checkpoint of its own."""
    root = temporary_folder(spark, "crash")
    messages = _messages(spark, sf_dir)
    until = F.col("timestamp") < F.lit("2024-01-15").cast("timestamp")
    first = reports.AnswerReport(spark, root, checkpoint=f"{root}/checkpoint-1")

    def die(batch, content):
        raise RuntimeError("lost before the commit record")

    first.commits.add = die
    try:
        _finish(first.writer(messages.filter(until)))
    except StreamingQueryException:
        pass
    second = reports.AnswerReport(spark, root, checkpoint=f"{root}/checkpoint-2")
    _finish(second.writer(messages))
    table = X.tables(spark, sf_dir)
    return second.papers(X.question_points(table("part")), X.paper_tasks(table("events"))).drop("last_seq")


class _Deduped:
    """Records applied once each and those passed over, under one commit record a batch."""

    def __init__(self, spark: SparkSession):
        self.root = temporary_folder(spark, "dedupe")
        self.commits = CommitLog(spark, self.root)
        self.positions = Positions(spark, f"{self.root}/positions", self.commits)
        self.folders = {name: BatchFolder(spark, f"{self.root}/{name}", self.commits) for name in ("new", "again")}

    def apply(self, records: DataFrame, batch_id: int) -> None:
        batch, columns = (0, batch_id), ["partition", "offset", "key"]
        applied = self.positions.after(self.commits.last_of_each())
        told = told_apart(records.select("topic", *columns), applied).persist()
        try:
            self.folders["new"].write(told.filter("is_new").select(*columns), batch)
            self.folders["again"].write(told.filter("is_again").select(*columns), batch)
            self.positions.write(batch, told, applied)
        finally:
            told.unpersist()
        self.commits.add(batch, {})

    def run(self, records: DataFrame) -> dict[str, DataFrame]:
        _finish(records.writeStream.foreachBatch(self.apply).option("checkpointLocation", f"{self.root}/checkpoint"))
        return {name: folder.read("partition int, offset long, key string") for name, folder in self.folders.items()}


def _dedupe(spark, sf_dir):
    """Every record delivered twice; each position is applied once."""
    twice = _messages(spark, sf_dir).unionByName(_messages(spark, sf_dir))
    return _Deduped(spark).run(twice)["new"]


def _dedupe_unordered(spark, sf_dir):
    """Every record in one of six files by its hash, and all of them once more in a seventh: a batch a
    file. Late offsets are applied, once; the replays, and they alone, are passed over."""
    source = f"{temporary_folder(spark, 'unordered')}/in"
    records = X.messages(X.answers(X.tables(spark, sf_dir)("events"))).select("key", "value", "topic", "partition", "offset", "timestamp")
    for part in (*(F.pmod(F.xxhash64("offset"), F.lit(6)) == n for n in range(6)), F.lit(True)):
        records.filter(part).coalesce(1).write.mode("append").parquet(source)
    found = _Deduped(spark).run(file_stream(spark, source, files_per_batch=1))
    return found["new"].withColumn("times", F.lit(0)).union(found["again"].withColumn("times", F.lit(1)))


def _record(fields, key):
    return (
        key.cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def _feed(spark, sf_dir, name):
    return (_point_records if name == "points" else _task_records)(spark, sf_dir)


def _point_records(spark, sf_dir):
    part = _table_stream(spark, sf_dir, "part")
    fields = [
        F.col("p_partkey").alias("id"),
        (F.col("p_partkey") % 37).alias("QuestionId"),
        (F.col("p_size") % 12).cast("bigint").alias("PointId"),
    ]
    records = part.select(*_record(fields, F.col("p_partkey") % 37), F.col("p_partkey").alias("offset"))
    return records, reports.question_point_cells, "qp"


def _dim_points(spark, sf_dir):
    path = temporary_folder(spark, "question_point")
    records, to_cells, family = _point_records(spark, sf_dir)
    _finish(reports.feed_cells(spark, records, to_cells, path, family))
    return celltables.current_cells(spark, path).drop("version")


def _task_records(spark, sf_dir, moved: bool = False):
    events = _table_stream(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    sitting = F.col("user_id") * 4 + F.col("event_id") % 4
    fields = [
        F.col("event_id").alias("id"),
        sitting.alias("testPaper_user_id"),
        ((sitting + 1) % 6 if moved else sitting % 6).alias("CustomsID"),
        (sitting % 3 if moved else sitting % 9).alias("TaskID"),
        F.col("user_id").alias("UserID"),
    ]
    records = events.select(*_record(fields, F.col("user_id")), F.col("event_id").alias("offset"))
    return records, reports.paper_task_cells, "i"


def _dim_tasks(spark, sf_dir):
    path = temporary_folder(spark, "paper_task")
    records, to_cells, family = _task_records(spark, sf_dir)
    # A second stream with a checkpoint of its own reads everything again over folded batches.
    for number in (1, 2):
        _finish(reports.feed_cells(spark, records, to_cells, path, family, f"{path}/checkpoint-{number}"))
        celltables.compact_table(spark, path)
    return celltables.current_cells(spark, path).drop("version")


RECORDS = ctes("answers").rstrip() + """, m as (select *, cast(CreateUser as varchar) as mkey,
 concat('{', '"id":', id, ',"TestPaper_User_ID":', TestPaper_User_ID, ',"QuestionID":', QuestionID, ',"BatchCourses_ID":',
 BatchCourses_ID, ',"TestPaper_ID":', TestPaper_ID, ',"CreateUser":', CreateUser,
 case when IsRight is null then '' else concat(',"IsRight":', IsRight) end, '}') as mvalue from answers)
"""
POSITION = "cast(CreateUser%4 as integer) as partition, log_offset as \"offset\", mkey as key"


def _boards_sql() -> str:
    return " union all ".join(
        f"select * from ({sql}) b{i}"
        for i, sql in enumerate(
            [
                score_sql("task_id", B.TASK_SCORE), score_sql("customs_id", B.CUSTOMS_SCORE),
                accuracy_sql("task", "clean"), accuracy_sql("customs", "clean"),
            ]
        )
    )


# The sitting's second row, which the late feed brings.
MOVED_TASKS = """select testPaper_user_id, TaskID, CustomsID, UserID from first_rows
 union select testPaper_user_id, testPaper_user_id%3, (testPaper_user_id+1)%6, UserID from first_rows"""


def _late_boards_sql() -> str:
    """The boards over the tasks of both feeds."""
    first = X.FIXTURE_SQL["paper_task"]
    return _boards_sql().replace(f"paper_task as ({first})", f"first_rows as ({first}), paper_task as ({MOVED_TASKS})")


def register(reg: Registry) -> None:
    reg.add(
        "st_relay_a",
        _relay(relay.relay_a),
        f"{RECORDS} select concat('key:', mkey, ' value:', mvalue) as value, 'target' as topic from m",
    )
    reg.add("st_relay_b", _relay(relay.relay_b), f"{RECORDS} select concat('>>>>:', mvalue) as value, 'target' as topic from m")
    reg.add("st_report", _report("clean", "paper"), clean_summary_sql("paper"))
    reg.add("st_report_restart", _restart, clean_summary_sql("paper"))
    reg.add("st_report_crash", _crash, clean_summary_sql("paper"))
    reg.add("st_boards", _published(Publisher.current_boards), _boards_sql())
    reg.add("st_boards_late_tasks", _late_tasks, _late_boards_sql())
    cells = " union all ".join(_summary_cells_sql(kind) for kind in ("paper", "customs"))
    reg.add("st_summary_cells", _published(_summary_cells), cells)
    reg.add("st_report_compat", _report("compat", "customs"), compat_summary_sql("customs"))
    reg.add("st_rejects", _rejects, f"{RECORDS} select {POSITION} from m where IsRight is null")
    reg.add("st_dedupe", _dedupe, f"{RECORDS} select {POSITION} from m")
    reg.add("st_dedupe_unordered", _dedupe_unordered, f"{RECORDS} select {POSITION}, times from m, (values (0), (1)) t(times)")
    reg.add(
        "st_dim_points",
        _dim_points,
        f"""{ctes('question_point')} select concat(cast(QuestionId as varchar), '_', cast(PointId as varchar)) as rowkey,
 'qp' as family, 'coeffcient' as qualifier, '0' as value from question_point""",
    )
    key = "concat(cast(testPaper_user_id as varchar),'_',cast(TaskID as varchar),'_',cast(CustomsID as varchar)) as rowkey"
    reg.add(
        "st_dim_tasks",
        _dim_tasks,
        f"""{ctes('paper_task')} select {key}, 'i' as family, 'TaskID' as qualifier, cast(TaskID as varchar) as value from paper_task
 union all select {key}, 'i', 'UserID', cast(UserID as varchar) from paper_task""",
    )
