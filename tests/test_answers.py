"""Reports against a message-by-message replay over dictionaries."""

import random

import pytest
from pyspark.sql import functions as F

from studytrail.operators import answers as A
from studytrail.operators import boards as B

ANSWERS = "log_offset long, TestPaper_User_ID long, QuestionID long, CreateUser long, IsRight int"


def make(rng, n, outcomes):
    rows = []
    for i in range(n):
        user = 1 if rng.random() < 0.4 else rng.randint(1, 4)
        rows.append((i, user * 10 + rng.randint(0, 2), rng.randint(1, 6), user, rng.choice(outcomes)))
    return rows


POINTS = [(1, 1), (1, 2), (2, 2), (3, 3), (3, 1), (3, 4), (4, 4), (6, 1)]
TASKS = [(10, 3, 2), (11, 3, 2), (12, 0, 0), (20, 4, 1), (21, 5, 0), (30, 0, 3), (31, 7, 3), (40, 1, 1), (40, 10, 2)]


def tasks_of(tpu):
    keys = sorted(f"{a}_{b}_{c}" for a, b, c in TASKS if a == tpu)
    return tuple(map(int, keys[0].split("_")[1:])) if keys else (None, None)


def points_of(q):
    return sorted({p for qq, p in POINTS if qq == q})


def replay(rows):
    """Counters and cells as the message-by-message processor leaves them."""
    store = {"paper": {}, "customs": {}}
    boards = {}
    for _, tpu, q, user, right in sorted(rows):
        if right is None or tpu is None or q is None or user is None:
            continue
        task, customs = tasks_of(tpu)
        counts = dict.fromkeys(A.COUNTS, 0)

        def update(cells):
            for (fam, name) in cells:
                if fam in "qp":
                    kind = "f_" if name.endswith("_0") else "r_" if name.endswith("_1") else ""
                    counts[f"{fam}_{kind}count"] += 1
            pts = points_of(q)
            before = dict(cells)
            for fam, inc in (("q", 1), ("p", len(pts))):
                counts[f"{fam}_count"] += inc
                counts[f"{fam}_{'r' if right == 1 else 'f'}_count"] += inc
            for c in A.COUNTS:
                cells[("s", c)] = counts[c]
            mark = "_0" if right == 0 else "_1"
            if ("q", str(q)) in before or ("q", f"{q}{mark}") in before:
                for name in (str(q), f"{q}{mark}"):
                    if ("q", name) in before:
                        cells[("q", name)] += 1
            else:
                cells[("q", str(q))] = cells[("q", f"{q}{mark}")] = 1
            for p in pts:
                if ("p", str(p)) in before:
                    cells[("p", str(p))] += 1
                else:
                    cells[("p", str(p))] = cells[("p", f"{p}{mark}")] = 1

        update(store["paper"].setdefault((user, tpu), {}))
        if task and task > 0:
            if right == 1:
                boards[(f"paperSummaryRank_{task}", str(user))] = boards.get((f"paperSummaryRank_{task}", str(user)), 0) + 1
            boards[(f"paperSummaryRank_rightpercent_{task}", str(user))] = counts["q_r_count"] / counts["q_count"]
        if customs and customs > 0:
            update(store["customs"].setdefault((user, customs), {}))
            boards[(f"customsRank_rightpercent_{customs}", str(user))] = counts["q_r_count"] / counts["q_count"]
            if right == 1:
                boards[(f"customsRank_{customs}", str(user))] = boards.get((f"customsRank_{customs}", str(user)), 0) + 1
    return store, boards


@pytest.fixture
def data(spark):
    def build(seed, outcomes=(0, 1, None, 2)):
        rng = random.Random(seed)
        rows = make(rng, 300, outcomes)
        return (
            rows,
            spark.createDataFrame(rows, ANSWERS).repartition(3),
            spark.createDataFrame(POINTS + POINTS[:2], "QuestionId long, PointId long"),
            spark.createDataFrame(TASKS, "testPaper_user_id long, TaskID long, CustomsID long"),
        )

    return build


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_compat_summary_and_cells(data, seed):
    rows, answers, points, tasks = data(seed)
    store, boards = replay(rows)
    cells = A.question_cells(answers, "compat")
    paper = A.paper_summary(cells, points, tasks, "compat")
    customs = A.customs_summary(cells, points, tasks, "compat")
    for report, keys, kind in ((paper, A.PAPER, "paper"), (customs, A.CUSTOMS, "customs")):
        got = {tuple(r[k] for k in keys): [r[c] for c in A.COUNTS] for r in report.collect()}
        assert got == {k: [c[("s", n)] for n in A.COUNTS] for k, c in store[kind].items()}
    own = {"paper": cells, "customs": A.customs_cells(cells, tasks)}
    for kind, keys in (("paper", A.PAPER), ("customs", A.CUSTOMS)):
        rows_q = A.counter_rows(own[kind], keys, "question_id", "q")
        rows_p = A.counter_rows(A.point_cells(own[kind], points, keys), keys, "point_id", "p")
        got = {(r.rowkey, r.family, r.qualifier): r.value for r in rows_q.unionByName(rows_p).collect()}
        want = {
            (f"{k[0]}_{k[1]}", fam, name): str(v)
            for k, c in store[kind].items()
            for (fam, name), v in c.items()
            if fam != "s"
        }
        assert got == want
    made = (
        B.task_scores(answers, tasks)
        .unionByName(B.customs_scores(answers, tasks))
        .unionByName(B.accuracy_scores(paper, "TaskID", B.TASK_ACCURACY))
        .unionByName(B.accuracy_scores(customs, "customs_id", B.CUSTOMS_ACCURACY))
    )
    assert {(r.board, r.member): r.score for r in made.collect()} == boards


def test_clean_summary(data):
    rows, answers, points, tasks = data(4)
    cells = A.question_cells(answers)
    got = {(r.user_id, r.testpaper_user_id): r for r in A.paper_summary(cells, points, tasks).collect()}
    good = [r for r in rows if r[4] in (0, 1)]
    for key in {(r[3], r[1]) for r in good}:
        mine = [r for r in good if (r[3], r[1]) == key]
        q, qr, qf = {r[2] for r in mine}, {r[2] for r in mine if r[4] == 1}, {r[2] for r in mine if r[4] == 0}
        pts = [{p for x in s for p in points_of(x)} for s in (q, qr, qf)]
        r = got.pop(key)
        assert [r[c] for c in A.COUNTS] == [len(q), len(qr), len(qf), *map(len, pts)]
        assert r.accuracy == len(qr) / len(q)
        task, customs = tasks_of(key[1])
        assert (r.TaskID, r.CustomsID) == (task or None, customs or None)
    assert not got


def test_batches_merge_to_the_same_cells(data):
    rows, answers, *_ = data(5)
    whole = A.question_cells(answers, "compat")
    keys = [*A.PAPER, "question_id"]
    halves = [A.question_cells(answers.filter(c), "compat") for c in (F.col("log_offset") < 140, F.col("log_offset") >= 140)]
    merged = A.merge_cells(halves[0].unionByName(halves[1]), keys)
    assert sorted(map(tuple, merged.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_rejects(data):
    rows, answers, *_ = data(6)
    assert A.rejected_answers(answers).count() == sum(r[4] is None for r in rows)
    assert A.valid_answers(answers, A.REQUIRED_OLDER).count() == sum(r[4] is not None for r in rows)


def test_broken_task_key_is_no_match(spark):
    tasks = spark.createDataFrame([(1, None, 5), (2, 3, 4)], "testPaper_user_id long, TaskID long, CustomsID long")


def test_compat_report_of_a_hot_key_has_no_window(spark):
    """One learner holds most answers of one customs, over sittings; no window stands in the plan."""
    rng = random.Random(12)
    rows = [(i, 10 + rng.randrange(2), rng.randrange(1, 40), 1, rng.choice([0, 1, 2])) for i in range(900)]
    rows += [(900 + i, 30 + i % 2, i % 5, 3, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, ANSWERS)
    points = spark.createDataFrame(POINTS, "QuestionId long, PointId long")
    tasks = spark.createDataFrame(TASKS, "testPaper_user_id long, TaskID long, CustomsID long")
    made = A.customs_summary(A.question_cells(df, "compat"), points, tasks, "compat")
    assert "Window" not in made._jdf.queryExecution().toString()
    cells, _ = replay(rows)
    want = {key: tuple(int(c["s", n]) for n in A.COUNTS) for key, c in cells["customs"].items()}
    assert {(r.user_id, r.customs_id): tuple(r[n] for n in A.COUNTS) for r in made.collect()} == want


def test_clean_items_are_aggregated_by_hash(spark):
    """The items of a report are many times its answers; none of their aggregates may sort them."""
    cells = spark.createDataFrame(
        [(1, 10, q, 2, 1, 1, (None, 0, q), 1, (None, 0, 9 + q), 0) for q in (1, 2, 3)],
        "user_id long, testpaper_user_id long, question_id long, attempts long, right long, wrong long, "
        "first_seq struct<timestamp:timestamp,partition:int,offset:bigint>, first_right int, "
        "last_seq struct<timestamp:timestamp,partition:int,offset:bigint>, last_right int",
    )
    points = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "QuestionId long, PointId long")
    tasks = spark.createDataFrame([(10, 3, 2)], "testPaper_user_id long, TaskID long, CustomsID long")
    for make, key in ((A.paper_summary, "testpaper_user_id"), (A.customs_summary, "customs_id")):
        report = make(cells, points, tasks)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "SortAggregate" in x and "item_id" in x]
        (row,) = report.collect()
        assert (row.user_id, row[key], row.q_count, row.p_count) == (1, 10 if key != "customs_id" else 2, 3, 2)
        assert (row.TaskID, row.CustomsID, row.last_seq.offset) == (3, 2, 12)


def test_compat_items_with_places_are_aggregated_by_hash(spark):
    """The reports of a stream, whose places are structs, against the replay; no aggregate sorts the
    items, and the number of tasks follows that of the cells. Times are equal or null here and there."""
    rng = random.Random(21)
    rows = make(rng, 300, (0, 1, None, 2))
    df = spark.createDataFrame(rows, ANSWERS).repartition(3)
    moment = F.when(F.col("log_offset") >= 20, F.timestamp_seconds((F.col("log_offset") / 7).cast("bigint")))
    place = F.struct(moment.alias("timestamp"), F.lit(0).alias("partition"), F.col("log_offset").alias("offset"))
    cells = A.question_cells(df.withColumn("log_offset", place), "compat")
    points = spark.createDataFrame(POINTS + POINTS[:2], "QuestionId long, PointId long")
    tasks = spark.createDataFrame(TASKS, "testPaper_user_id long, TaskID long, CustomsID long")
    store, _ = replay(rows)
    last = {}
    for offset, sitting, _, user, right in rows:
        if right is not None:
            customs = tasks_of(sitting)[1]
            last["paper", (user, sitting)] = last["customs", (user, customs)] = offset
    for make_report, keys, kind in ((A.paper_summary, A.PAPER, "paper"), (A.customs_summary, A.CUSTOMS, "customs")):
        for count in (None, 3 * A.CELLS_PER_TASK):
            report = make_report(cells, points, tasks, "compat", count)
            plan = report._jdf.queryExecution().executedPlan().toString()
            assert not [x for x in plan.splitlines() if "SortAggregate" in x and ("item_id" in x or "attempts" in x and "is_point" in x)]
            assert count is None or ", 4), REPARTITION_BY_NUM" in plan
            got = {tuple(r[k] for k in keys): ([r[c] for c in A.COUNTS], r.last_seq.offset) for r in report.collect()}
            assert got == {k: ([c[("s", n)] for n in A.COUNTS], last[kind, k]) for k, c in store[kind].items()}
