"""Published boards and summaries follow the answers and both dimension feeds."""

import json

import pytest

from studytrail.operators import answers as A
from studytrail.operators import boards as B
from studytrail.sources import celltables, topics
from studytrail.streaming import publish, reports
from studytrail.streaming.commits import CommitLog


def answer(i, user, sitting, question, right):
    fields = {"id": i, "TestPaper_User_ID": sitting, "QuestionID": question, "CreateUser": user, "IsRight": right}
    return (str(user), json.dumps(fields), "t", 0, i, None)


def task(i, sitting, task_id, customs):
    return (None, json.dumps({"id": i, "testPaper_user_id": sitting, "TaskID": task_id, "CustomsID": customs, "UserID": 1}), "k", 0, i, None)


def point(i, question, point_id):
    return (None, json.dumps({"id": i, "QuestionId": question, "PointId": point_id}), "p", 0, i, None)


class World:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.rows = {"answers": [], "tasks": [], "points": []}
        self.report = reports.AnswerReport(spark, f"{root}/report")
        for name, family in (("points", "qp"), ("tasks", "i")):
            celltables.create_table(spark, f"{root}/{name}", [family])
        self.publisher = publish.Publisher(self.report, f"{root}/points", f"{root}/tasks")

    def put(self, name, rows):
        self.rows[name] += rows
        src = f"{self.root}/in-{name}"
        self.spark.createDataFrame(rows, topics.RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = topics.file_stream(self.spark, src)
        if name == "answers":
            writer = self.report.writer(stream)
        else:
            make = {"tasks": reports.paper_task_cells, "points": reports.question_point_cells}[name]
            writer = reports.feed_cells(self.spark, stream, make, f"{self.root}/{name}", "i" if name == "tasks" else "qp")
        topics.trigger(writer).start().awaitTermination()

    def wanted(self):
        """Boards and summaries of everything so far, by the batch operators."""
        table = lambda name: self.spark.createDataFrame(self.rows[name], topics.RECORD_SCHEMA)
        cells = A.question_cells(reports.decode_answers(table("answers")))
        tasks = reports.paper_tasks_of(reports.paper_task_cells(table("tasks")))
        points = reports.question_points_of(reports.question_point_cells(table("points")))
        paper, customs = A.paper_summary(cells, points, tasks), A.customs_summary(cells, points, tasks)
        boards = publish.score_boards(cells, tasks).union(B.accuracy_scores(paper, "TaskID", B.TASK_ACCURACY))
        boards = boards.union(B.accuracy_scores(customs, "customs_id", B.CUSTOMS_ACCURACY))
        summaries = {"paper": A.summary_rows(paper, A.PAPER), "customs": A.summary_rows(customs, A.CUSTOMS)}
        return rows_of(boards), {k: rows_of(v.drop("version")) for k, v in summaries.items()}

    def published(self):
        boards = rows_of(self.publisher.current_boards())
        return boards, {k: rows_of(self.publisher.summary_cells(k).drop("version")) for k in publish.SUMMARIES}


def rows_of(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


@pytest.fixture
def world(spark, tmp_path):
    world = World(spark, str(tmp_path))
    world.put("points", [point(0, 1, 1), point(1, 2, 2)])
    world.put("answers", [answer(i, 1 + i % 3, 10 + i % 6, i % 4, i % 2) for i in range(24)])
    return world


def test_tasks_come_late_and_change(spark, world):
    assert world.publisher.run() == (0, 0)
    assert world.published()[0] == []
    world.put("tasks", [task(0, 10, 3, 2), task(1, 11, 5, 2), task(2, 15, 3, 0)])
    assert world.publisher.run() == (0, 1)
    assert world.published() == world.wanted() and world.published()[0]
    # 10_1_7 comes before 10_3_2: the sitting leaves its task and its customs.
    world.put("tasks", [task(3, 10, 1, 7), task(4, 11, 0, 0)])
    assert world.publisher.run() == (0, 2)
    assert world.published() == world.wanted()
    assert world.publisher.run() is None


def test_only_touched_learners_are_written(spark, world):
    world.put("tasks", [task(n, 10 + n, 3, 2) for n in range(6)])
    world.publisher.run()
    world.put("tasks", [task(9, 11, 1, 1)])
    world.publisher.run()
    written = world.publisher.boards.read_some([(0, 1)], publish.BOARD_SCHEMA)
    touched = {str(json.loads(r[1])["CreateUser"]) for r in world.rows["answers"] if json.loads(r[1])["TestPaper_User_ID"] == 11}
    assert {r.member for r in written.collect()} == touched
    assert world.published() == world.wanted()


def test_points_come_late(spark, world):
    world.put("tasks", [task(0, 10, 3, 2)])
    world.publisher.run()
    world.put("points", [point(7, 1, 9), point(8, 3, 4)])
    world.publisher.run()
    assert world.published() == world.wanted()


@pytest.mark.parametrize("fails_at", [1, 2, 3])
def test_a_run_that_dies_is_done_again(spark, world, monkeypatch, fails_at):
    world.put("tasks", [task(0, 10, 3, 2), task(1, 11, 5, 2)])
    world.publisher.run()
    before = world.published()
    world.put("tasks", [task(2, 10, 1, 0)])
    kept, calls = publish.BatchFolder.write, []

    def fail(self, *args):
        calls.append(1)
        if len(calls) > fails_at - 1:
            raise RuntimeError("lost")
        return kept(self, *args)

    monkeypatch.setattr(publish.BatchFolder, "write", fail)
    with pytest.raises(RuntimeError):
        world.publisher.run()
    monkeypatch.setattr(publish.BatchFolder, "write", kept)
    assert world.published() == before
    world.publisher.run()
    assert world.published() == world.wanted()


def test_folds_on_both_sides(spark, world):
    """Batches folded before they were published count as changed for all learners."""
    world.publisher.run()
    world.put("tasks", [task(0, 10, 3, 2)])
    celltables.compact_table(spark, f"{world.root}/tasks")
    celltables.compact_table(spark, f"{world.root}/tasks")
    world.put("answers", [answer(30, 2, 10, 3, 1)])
    world.report.compact()
    world.publisher.run()
    world.publisher.compact()
    assert world.published() == world.wanted()
    world.put("tasks", [task(1, 10, 1, 5)])
    world.publisher.run()
    world.publisher.compact()
    assert world.published() == world.wanted()
    assert CommitLog(spark, world.publisher.root).batches()[-1] == (0, 2)
