"""Session jobs with the relational source and sink replaced by folders."""

import random

import pytest
from test_sessions import HEART, make_beats, make_log, replay_clean, replay_compat, schema_of

from studytrail import jobs
from studytrail.operators import sessions as S
from studytrail.sources import jdbc


@pytest.fixture
def database(spark, tmp_path, monkeypatch):
    def read(spark, connection, table, **ranges):
        return spark.read.parquet(str(tmp_path / table))

    def append(rows, connection, table, batch_size=0):
        # A database would not read and write one folder; here the rows are kept aside first.
        rows = spark.createDataFrame(rows.collect(), rows.schema)
        rows.write.mode("append").parquet(str(tmp_path / table))

    monkeypatch.setattr(jdbc, "read_table", read)
    def replace(rows, connection, table):
        rows = spark.createDataFrame(rows.collect(), rows.schema)
        rows.write.mode("overwrite").parquet(str(tmp_path / table))

    monkeypatch.setattr(jdbc, "append_table", append)
    monkeypatch.setattr(jdbc, "replace_table", replace)
    monkeypatch.setattr(jdbc, "read_table_by_range", lambda s, c, t, column, n: read(s, c, t))
    return tmp_path


@pytest.mark.parametrize("mode", ["clean", "compat"])
def test_session_job_twice(spark, database, mode):
    rng = random.Random(8)
    log, beats = make_log(S.COURSE, rng, 120, nulls=False), make_beats(rng, 40)
    spark.createDataFrame(log, schema_of(S.COURSE)).write.parquet(str(database / "r_courseop"))
    spark.createDataFrame(beats, HEART).write.parquet(str(database / "r_timestat"))
    want = {"clean": replay_clean, "compat": replay_compat}[mode](S.COURSE, log, beats)
    empty = S.sessionize(spark.createDataFrame([], schema_of(S.COURSE)), spark.createDataFrame([], HEART), S.COURSE)
    empty.write.parquet(str(database / "session_course"))
    for _ in range(2):
        jobs.session_jobs(spark, {}, ["course"], mode)
    stored = sorted(map(tuple, spark.read.parquet(str(database / "session_course")).collect()))
    if mode == "clean":
        stored = sorted(stored + list(map(tuple, spark.read.parquet(str(database / jobs.open_table("course"))).collect())))
    assert stored == (want if mode == "clean" else sorted(want * 2))


def test_growing_log_has_no_stale_ends(spark, database):
    rng = random.Random(3)
    log = sorted(make_log(S.COURSE, rng, 160, nulls=False), key=lambda r: r[-1])
    beats = sorted(make_beats(rng, 60), key=lambda r: r[-1])
    empty = S.sessionize(spark.createDataFrame([], schema_of(S.COURSE)), spark.createDataFrame([], HEART), S.COURSE)
    empty.write.parquet(str(database / "session_course"))
    ends = sorted(r[-1] for r in log)
    for cut in (ends[50], ends[110], ends[-1]):
        some = [r for r in log if r[-1] <= cut], [r for r in beats if r[-1] <= cut]
        spark.createDataFrame(some[0], schema_of(S.COURSE)).write.mode("overwrite").parquet(str(database / "r_courseop"))
        spark.createDataFrame(some[1], HEART).write.mode("overwrite").parquet(str(database / "r_timestat"))
        jobs.session_jobs(spark, {}, ["course"])
        tables = [spark.read.parquet(str(database / t)) for t in ("session_course", jobs.open_table("course"))]
        assert sorted(map(tuple, tables[0].union(tables[1]).collect())) == replay_clean(S.COURSE, *some)


def test_staging_is_removed(spark):
    with jobs.Staging(spark) as staging:
        copy = staging.copy(spark.range(3), "probe")
        assert copy.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(*staging.paths).count()


def test_every_session_table_is_named():
    assert len(jobs.SESSION_TABLES) == 8
    assert jobs.SESSION_KEYS["video"] == ("maxindex", "uid", "cid", "rid", "minct")


def test_stream_jobs_on_files(spark, tmp_path, monkeypatch):
    """The topic ends replaced by files and the trigger by a run to the end."""
    from studytrail.sources import celltables, topics
    from studytrail.streaming import reports

    src = str(tmp_path / "in")
    value = '{"QuestionId":7,"PointId":3,"QuestionID":7,"TestPaper_User_ID":5,"CreateUser":1,"IsRight":1}'
    spark.createDataFrame([("1", value, "t", 0, 0, None)], topics.RECORD_SCHEMA).write.parquet(src)
    run_out = topics.trigger
    monkeypatch.setattr(topics, "kafka_stream", lambda s, options: topics.file_stream(s, src))
    monkeypatch.setattr(topics, "to_kafka", lambda df, servers, ck: topics.to_files(df, str(tmp_path / "out"), ck))
    monkeypatch.setattr(topics, "trigger", lambda writer, seconds: run_out(writer))
    jobs.relay_job(spark, "h:1", "b", "in", "out", str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).first().value == ">>>>:" + value
    jobs.report_job(spark, "h:1", "answers", str(tmp_path / "report")).awaitTermination()
    assert reports.AnswerReport(spark, str(tmp_path / "report")).question_cells().first().right == 1
    jobs.dimension_job(spark, "h:1", "points", "question_point", str(tmp_path / "qp")).awaitTermination()
    assert celltables.current_cells(spark, str(tmp_path / "qp")).first().rowkey == "7_3"


def test_command_line(spark, monkeypatch, tmp_path):
    from studytrail import __main__ as cli

    calls = []
    monkeypatch.setattr(cli, "build_session", lambda name, master: spark)
    monkeypatch.setattr(jobs, "session_jobs", lambda *a: calls.append(a[1:]))
    secret = tmp_path / "connection.json"
    secret.write_text('{"url": "other", "user": "u"}')
    cli.main(["sessions", "login", "--jdbc", "url=jdbc:x", "--jdbc-file", str(secret), "--mode", "compat"])
    assert calls == [({"url": "jdbc:x", "user": "u"}, ["login"], "compat", 200)]
    cli.main(["sessions", "all", "--jdbc", "url=jdbc:x"])
    assert [c[1] for c in calls[1:]] == [list(jobs.SESSION_TABLES)]

    monkeypatch.setattr(jobs, "incremental_session_jobs", lambda *a, **k: calls.append((*a[1:], k)))
    cli.main(["sessions", "login", "--jdbc", "url=jdbc:x", "--state", "s", "--heartbeat-position", "n"])
    assert calls.pop() == ({"url": "jdbc:x"}, ["login"], "s", 200, {"heartbeat_position": "n"})
    with pytest.raises(SystemExit):
        cli.main(["sessions", "login", "--jdbc", "url=jdbc:x", "--state", "s", "--mode", "compat"])

    class Query:
        def awaitTermination(self):
            calls.append("ended")

    for job in ("relay_job", "report_job", "dimension_job"):
        monkeypatch.setattr(jobs, job, lambda *a, job=job: calls.append((job, a[1:])) or Query())
    cli.main(["relay", "a", "--servers", "h", "--topic", "s", "--target", "t", "--checkpoint", "c"])
    cli.main(["report", "--servers", "h", "--topic", "s", "--root", "r"])
    cli.main(["dimension", "paper_task", "--servers", "h", "--topic", "s", "--path", "p"])
    assert calls[-6::2] == [
        ("relay_job", ("h", "a", "s", "t", "c", "latest")),
        ("report_job", ("h", "s", "r", "clean")),
        ("dimension_job", ("h", "s", "paper_task", "p")),
    ]
    with pytest.raises(SystemExit):
        cli.main(["sessions", "login", "--jdbc", "no-value"])
