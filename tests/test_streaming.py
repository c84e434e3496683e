"""Streams on files: many batches, restarts, failures between writes, replays."""

import json
import random

import pytest
from pyspark.sql import functions as F

from studytrail.operators import answers as A
from studytrail.sources import celltables, topics
from studytrail.streaming import offsets, relay, reports
from studytrail.streaming.batches import BatchFolder
from studytrail.streaming.commits import CommitLog

POINTS = [(1, 1), (1, 2), (2, 2), (3, 3)]
TASKS = [(10, 3, 2), (11, 4, 0), (20, 5, 1)]


def record(i):
    user = 1 + i % 2
    right = "null" if i % 7 == 0 else str(i % 2 if i % 3 else 1 - i % 2)
    value = (
        f'{{"id":{i},"TestPaper_User_ID":{user * 10 + i % 2},"QuestionID":{i % 4 + 1},'
        f'"CreateUser":{user},"IsRight":{right}}}'
    )
    return (str(user), "not json" if i == 33 else value, "t", user, i, None)


@pytest.fixture
def world(spark, tmp_path):
    src = str(tmp_path / "in")

    def put(rows):
        spark.createDataFrame(rows, topics.RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(src)

    put([record(0)])
    return src, put, str(tmp_path)


def run(writer):
    topics.trigger(writer).start().awaitTermination()


def batch(spark, n, mode):
    df = spark.createDataFrame([record(i) for i in range(n)], topics.RECORD_SCHEMA)
    return A.question_cells(reports.decode_answers(df), mode)


def rows_of(df):
    return sorted(map(str, (sorted(r.asDict().items()) for r in df.collect())))


@pytest.mark.parametrize("mode", ["clean", "compat"])
def test_report_over_restarts_equals_batch(spark, world, mode):
    src, put, root = world
    report = reports.AnswerReport(spark, f"{root}/r", mode)
    stream = topics.file_stream(spark, src, files_per_batch=1)
    run(report.writer(stream))
    put([record(i) for i in range(1, 20)])
    put([record(i) for i in range(20, 25)])
    run(report.writer(stream))
    assert report.compact() is not None
    put([record(i) for i in range(25, 60)])
    run(reports.AnswerReport(spark, f"{root}/r", mode).writer(stream))
    # The same positions again, in a new file: nothing is counted twice.
    put([record(i) for i in range(10, 60)])
    run(report.writer(stream))
    want = batch(spark, 60, mode)
    assert rows_of(report.question_cells()) == rows_of(want)
    points = spark.createDataFrame(POINTS, "QuestionId long, PointId long")
    tasks = spark.createDataFrame(TASKS, "testPaper_user_id long, TaskID long, CustomsID long")
    assert rows_of(report.papers(points, tasks)) == rows_of(A.paper_summary(want, points, tasks, mode))
    assert rows_of(report.customs(points, tasks)) == rows_of(A.customs_summary(want, points, tasks, mode))
    # Three batches before the restart, then one per file; partitions hold every other offset.
    ranges = {(r.partition, r.from_offset, r.until_offset) for r in report.positions.ranges((0, 3)).collect()}
    assert ranges == {(1 + i % 2, i, i + 1) for i in range(25, 60)}
    bad = {r.offset for r in report.rejected().collect()}
    assert bad == {i for i in range(60) if i % 7 == 0 or i == 33}


GAPS = {
    "before cells": (BatchFolder, "write", 0),
    "before aside": (BatchFolder, "write", 1),
    "before positions": (BatchFolder, "write", 2),
    "before record": (CommitLog, "add", 0),
}


@pytest.mark.parametrize("new_checkpoint", [False, True])
@pytest.mark.parametrize("gap", GAPS)
def test_failure_between_writes_counts_once(spark, world, monkeypatch, gap, new_checkpoint):
    """A batch dies in front of each of its writes; the same or a new checkpoint goes on."""
    src, put, root = world
    put([record(i) for i in range(1, 30)])
    stream = topics.file_stream(spark, src)
    kind, method, allowed = GAPS[gap]
    kept, calls = getattr(kind, method), []

    def fail(self, *args):
        calls.append(self)
        if len(calls) > allowed:
            raise RuntimeError("lost")
        return kept(self, *args)

    monkeypatch.setattr(kind, method, fail)
    with pytest.raises(Exception, match="lost"):
        run(reports.AnswerReport(spark, f"{root}/r", checkpoint=f"{root}/one").writer(stream))
    monkeypatch.setattr(kind, method, kept)
    report = reports.AnswerReport(spark, f"{root}/r", checkpoint=f"{root}/{'two' if new_checkpoint else 'one'}")
    assert report.question_cells().count() == 0 and report.rejected().count() == 0
    run(report.writer(stream))
    assert rows_of(report.question_cells()) == rows_of(batch(spark, 30, "clean"))
    assert {r.offset for r in report.rejected().collect()} == set(range(0, 30, 7))
    assert report.passed_over().count() == 0


def test_death_after_the_record_counts_once(spark, world, monkeypatch):
    """Recorded, but the stream's own checkpoint does not know: the batch comes again and is left."""
    src, put, root = world
    put([record(i) for i in range(1, 30)])
    stream = topics.file_stream(spark, src)
    kept = CommitLog.add

    def fail(self, *args):
        kept(self, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(CommitLog, "add", fail)
    with pytest.raises(Exception, match="lost"):
        run(reports.AnswerReport(spark, f"{root}/r").writer(stream))
    monkeypatch.setattr(CommitLog, "add", kept)
    report = reports.AnswerReport(spark, f"{root}/r")
    run(report.writer(stream))
    assert rows_of(report.question_cells()) == rows_of(batch(spark, 30, "clean"))
    with pytest.raises(ValueError, match="other offsets"):
        report.apply(spark.createDataFrame([record(3)], topics.RECORD_SCHEMA), 0)


def test_old_checkpoint_goes_on_after_a_new_one(spark, world):
    """Streams of two checkpoints take turns, with folds between; no batch hides behind a base."""
    src, put, root = world
    stream = topics.file_stream(spark, src)
    upto = 1
    for checkpoint in ("one", "two", "one", "two", "one"):
        put([record(i) for i in range(upto, upto + 10)])
        upto += 10
        report = reports.AnswerReport(spark, f"{root}/r", checkpoint=f"{root}/{checkpoint}")
        run(report.writer(stream))
        report.compact()
        assert rows_of(report.question_cells()) == rows_of(batch(spark, upto, "clean"))


def test_records_are_few_after_folds(spark, world):
    src, put, root = world
    report = reports.AnswerReport(spark, f"{root}/r")
    for n in range(4):
        put([record(i) for i in range(1 + 5 * n, 6 + 5 * n)])
        run(report.writer(topics.file_stream(spark, src, files_per_batch=1)))
        report.compact()
    assert len(report.commits.batches()) <= 2
    assert rows_of(report.question_cells()) == rows_of(batch(spark, 21, "clean"))
    assert {r.partition: r.offset for r in report.positions.resume().collect()} == {1: 1, 2: 2}


def test_unfinished_folder_is_not_read(spark, tmp_path):
    folder = BatchFolder(spark, str(tmp_path / "b"))
    assert folder.read("id long").count() == 0 and folder.compact(lambda d: d, "id long") is None
    folder.write(spark.range(3), (0, 0))
    folder.write(spark.range(3, 5), (0, 1))
    (tmp_path / "b" / "batch-0-1" / "_SUCCESS").unlink()
    assert folder.read("id long").count() == 3
    folder.write(spark.range(3, 5), (0, 1))
    assert folder.read("id long").count() == 5


def test_compaction_keeps_rows_and_few_folders(spark, tmp_path):
    folder = BatchFolder(spark, str(tmp_path / "b"))
    count = 0
    for generation in range(3):
        for n in range(8):
            folder.write(spark.range(count, count + 1).coalesce(1), (generation, n))
            count += 1
            if n % 2:
                assert folder.compact(lambda d: d.coalesce(1), "id long", fanout=2) == (generation, n)
            assert sorted(r.id for r in folder.read("id long").collect()) == list(range(count))
    # 24 batches as bases of 16 and 8; folders of the last fold stay for readers still on them.
    assert folder.bases() == [((1, 7), 3), ((2, 7), 2)]
    assert folder.compact(lambda d: d, "id long") is None
    assert sorted(p.name for p in (tmp_path / "b").iterdir()) == ["base-1-7-3", "base-2-7-2"]


def test_new_checkpoint_neither_hides_nor_replaces(spark, world):
    src, put, root = world
    put([record(i) for i in range(1, 20)])
    stream = topics.file_stream(spark, src, files_per_batch=1)
    run(reports.AnswerReport(spark, f"{root}/r", checkpoint=f"{root}/one").writer(stream))
    reports.AnswerReport(spark, f"{root}/r").compact()
    put([record(i) for i in range(20, 45)])
    for checkpoint in ("two", "three"):
        report = reports.AnswerReport(spark, f"{root}/r", checkpoint=f"{root}/{checkpoint}")
        run(report.writer(stream))
        assert rows_of(report.question_cells()) == rows_of(batch(spark, 45, "clean"))
    ranges = report.positions.all_ranges().collect()
    assert {r.generation for r in ranges} == {0, 1, 2}
    applied = report.positions.applied().collect()
    assert {(r.partition, r.from_offset, r.until_offset) for r in applied} == {(1 + i % 2, i, i + 1) for i in range(45)}
    assert {r.offset for r in report.passed_over().collect()} == set(range(45))


INTERVALS = "topic string, partition int, from_offset long, until_offset long"


@pytest.mark.parametrize("seed", range(3))
def test_applied_intervals_are_exact(spark, seed, monkeypatch):
    """Any offsets against any intervals, over bucket borders, with a null topic."""
    rng = random.Random(seed)
    monkeypatch.setattr(offsets, "BUCKET", 8)
    place = lambda: (rng.choice(["t", "s", None]), rng.randrange(2))
    rows = [(None, "v", *place(), rng.randrange(60), None) for _ in range(150)]
    records = spark.createDataFrame([(k, v, t, p, o, None) for k, v, t, p, o, _ in rows], topics.RECORD_SCHEMA)
    spans = [(*place(), a, a + rng.randrange(1, 12)) for a in (rng.randrange(60) for _ in range(12))]
    applied = offsets.merged(spark.createDataFrame(spans, INTERVALS))
    held = {(t, p, o) for t, p, a, b in spans for o in range(a, b)}
    assert held == {(r.topic, r.partition, o) for r in applied.collect() for o in range(r.from_offset, r.until_offset)}
    ends = {}
    for r in sorted(applied.collect(), key=str):
        ends.setdefault((r.topic, r.partition), []).append((r.from_offset, r.until_offset))
    assert all(b[0] > a[1] for spans in map(sorted, ends.values()) for a, b in zip(spans, spans[1:]))
    found = [(r.topic, r.partition, r.offset) for r in offsets.unseen(records, applied).collect()]
    assert sorted(found, key=str) == sorted({(t, p, o) for _, _, t, p, o, _ in rows} - held, key=str)
    again = [(r.topic, r.partition, r.offset) for r in offsets.passed_over(records, applied).collect()]
    assert sorted(again, key=str) == sorted([(t, p, o) for _, _, t, p, o, _ in rows if (t, p, o) in held], key=str)
    covered = offsets.intervals_of(records).collect()
    assert {(r.topic, r.partition, o) for r in covered for o in range(r.from_offset, r.until_offset)} == {
        (t, p, o) for _, _, t, p, o, _ in rows
    }


def largest_share(df):
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_no_task_takes_all_intervals_of_a_partition(spark, tmp_path, monkeypatch):
    """One partition with gaps at every other offset: merged, and written, by several tasks."""
    monkeypatch.setattr(offsets, "BUCKET", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [("k", "v", "t", 0, o, None) for o in [*range(0, 2000, 2), *range(501, 700, 2), 15, 15, 31]]
        records = spark.createDataFrame(rows, topics.RECORD_SCHEMA)
        covered = offsets.intervals_of(records)
        assert largest_share(covered) < 0.6
        held = {r[4] for r in rows}
        spans = sorted((r.from_offset, r.until_offset) for r in covered.collect())
        assert {o for a, b in spans for o in range(a, b)} == held
        assert all(b[0] > a[1] for a, b in zip(spans, spans[1:]))
        commits = CommitLog(spark, str(tmp_path))
        positions = offsets.Positions(spark, f"{tmp_path}/positions", commits)
        positions.write((0, 0), records, spark.createDataFrame([("t", 0, 1, 40)], INTERVALS))
        commits.add((0, 0), {})
        assert {o for r in positions.applied().collect() for o in range(r.from_offset, r.until_offset)} == held | set(range(40))
        files = [spark.read.parquet(str(f)).count() for f in tmp_path.glob("positions/batch-0-0/*.parquet")]
        assert max(files) < 0.6 * sum(files)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_records_are_told_apart_without_comparing_pairs(spark):
    """60,000 records against 20,000 intervals of the same bucket, one sorted pass; a join of them
    compares every pair."""
    numbers = spark.range(60_000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    applied = numbers.filter("offset % 3 = 1").select("topic", "partition", F.col("offset").alias("from_offset"), (F.col("offset") + 1).alias("until_offset"))
    told = offsets.told_apart(numbers, applied)
    assert told.filter("is_again").count() == 20_000 and told.filter("is_new and offset % 3 <> 1").count() == 40_000
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.splitlines() if "Join" in line and "__b" in line] == []


def test_records_without_a_place(spark):
    """No interval holds a record without partition or offset; equal places count once."""
    rows = [("k", "v", "t", p, o, None) for p, o in [(None, 5), (None, 5), (0, None), (0, None), (0, 5), (0, 6)]]
    records = spark.createDataFrame(rows, topics.RECORD_SCHEMA)
    applied = spark.createDataFrame([("t", None, 0, 9), ("t", 0, 0, 6)], INTERVALS)
    place = lambda df: sorted(((r.partition, r.offset) for r in df.collect()), key=str)
    assert place(offsets.unseen(records, applied)) == [(0, 6), (0, None), (None, 5)]
    assert place(offsets.passed_over(records, applied)) == [(0, 5)]
    ordered = offsets.unseen(records, applied, ordered=True)
    assert place(ordered) == [(0, 6), (0, None), (0, None), (None, 5), (None, 5)]
    assert place(offsets.passed_over(records, applied, ordered=True)) == [(0, 5)]


def test_an_ordered_source_is_one_interval(spark):
    df = spark.createDataFrame([record(i) for i in range(6)], topics.RECORD_SCHEMA)
    got = {r.partition: (r.from_offset, r.until_offset) for r in offsets.intervals_of(df, ordered=True).collect()}
    assert got == {1: (0, 5), 2: (1, 6)}


def test_late_records_of_an_unordered_source_count_once(spark, world):
    src, put, root = world
    order = list(range(1, 40))
    random.Random(4).shuffle(order)
    for part in (order[:13], order[13:26], order[5:30], order[26:]):
        put([record(i) for i in part])
    report = reports.AnswerReport(spark, f"{root}/r")
    run(report.writer(topics.file_stream(spark, src, files_per_batch=1)))
    assert rows_of(report.question_cells()) == rows_of(batch(spark, 40, "clean"))
    assert sorted(r.offset for r in report.passed_over().collect()) == sorted(order[5:30])


def test_order_is_time_not_offset(spark):
    """Two partitions of one learner: the later message has the smaller offset."""
    from datetime import datetime

    def message(partition, offset, minute, right):
        value = f'{{"TestPaper_User_ID":"5","QuestionID":1,"CreateUser":"3","IsRight":"{right}"}}'
        return ("x", value, "t", partition, offset, datetime(2024, 1, 1, 0, minute))

    df = spark.createDataFrame([message(0, 900, 1, 0), message(1, 7, 2, 1)], topics.RECORD_SCHEMA)
    (cell,) = A.question_cells(reports.decode_answers(df)).collect()
    assert (cell.user_id, cell.first_right, cell.last_right) == (3, 0, 1)


def test_messages_with_quoted_and_missing_numbers(spark):
    fields = {"TestPaper_User_ID": 5, "QuestionID": 1, "CreateUser": 3, "IsRight": 1}
    good = [json.dumps(fields), json.dumps({k: str(v) for k, v in fields.items()})]
    bad = [json.dumps({**fields, k: v}) for k in fields for v in (None, "", "x", {"y": 1})] + ["", "[]", "5", None]
    df = spark.createDataFrame([("k", v, "t", 0, i, None) for i, v in enumerate(good + bad)], topics.RECORD_SCHEMA)
    decoded = reports.decode_answers(df)
    assert {r.offset for r in decoded.filter(A.is_valid()).collect()} == {0, 1}
    # The older rule asks for two fields only.
    older = {r.offset for r in decoded.filter(A.is_valid(A.REQUIRED_OLDER)).collect()}
    assert older == {0, 1} | {i for i, v in enumerate(good + bad) if i > 1 and v and v.startswith("{") and fits(v)}


def fits(value):
    fields = json.loads(value)
    return all(str(fields[k]).isdigit() for k in ("TestPaper_User_ID", "IsRight"))


def test_relays(spark, world):
    src, put, root = world
    put([(None, "v", "t", 0, 5, None)])
    stream = topics.file_stream(spark, src)
    for name, rewrite in (("a", relay.relay_a), ("b", relay.relay_b)):
        for _ in range(2):
            run(topics.to_files(rewrite(stream, "out"), f"{root}/{name}", f"{root}/{name}-ck"))
    got = [r.value for r in spark.read.parquet(f"{root}/a").collect()]
    assert len(got) == 2 and "key:null value:v" in got and any(v.startswith('key:1 value:{"id":0') for v in got)
    got = spark.read.parquet(f"{root}/b").collect()
    assert ">>>>:v" in [r.value for r in got] and {r.topic for r in got} == {"out"} and len(got) == 2


def test_dimension_feed_upserts(spark, world):
    src, put, root = world
    put([(None, '{"id":1,"QuestionId":7,"PointId":3}', "t", 0, i, None) for i in range(3)])
    put([(None, '{"id":2,"QuestionId":7,"PointId":4}', "t", 0, 9, None)])
    stream = topics.file_stream(spark, src, files_per_batch=1).filter(F.col("value").contains("PointId"))
    run(reports.feed_cells(spark, stream, reports.question_point_cells, f"{root}/qp", "qp"))
    cells = celltables.current_cells(spark, f"{root}/qp")
    assert sorted(r.rowkey for r in cells.collect()) == ["7_3", "7_4"]
    assert sorted(map(tuple, reports.question_points_of(cells).collect())) == [(7, 3), (7, 4)]
    tasks = spark.createDataFrame(
        [('{"testPaper_user_id":5,"CustomsID":2,"UserID":1}', 1)], "value string, offset long"
    )
    made = reports.paper_task_cells(tasks)
    assert {(r.rowkey, r.qualifier, r.value) for r in made.collect()} == {("5_null_2", "TaskID", "null"), ("5_null_2", "UserID", "1")}
    assert [tuple(r) for r in reports.paper_tasks_of(made).collect()] == [(5, None, 2)]


def test_offsets():
    assert offsets.resume_offsets({0: 5, 1: 2, 3: 9}, {0: 3, 1: 4, 2: 7}) == {0: 5, 1: 4, 2: 7, 3: 9}
    assert offsets.starting_offsets("t", {1: 4, 0: 5}) == '{"t": {"0": 5, "1": 4}}'


def test_topic_rows(spark):
    df = spark.createDataFrame([("x", "own"), ("y", None)], "value string, topic string")
    assert [r.topic for r in topics.topic_rows(df, "default").collect()] == ["own", "default"]
    with pytest.raises(Exception, match="no topic"):
        topics.topic_rows(df).collect()


def test_kafka_options():
    opts = topics.kafka_source_options("h:1", "t", '{"t":{"0":5}}', 100, extra={"kafka.security.protocol": "SSL"})
    assert opts["subscribe"] == "t" and opts["startingOffsets"] == '{"t":{"0":5}}'
    assert opts["failOnDataLoss"] == "false" and opts["maxOffsetsPerTrigger"] == "100"
    assert opts["kafka.security.protocol"] == "SSL"
