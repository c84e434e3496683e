"""Sessions from new rows alone, over runs that bring rows late."""

import random
from datetime import timedelta

import pytest
from test_sessions import HEART, T0, make_beats, make_log, replay_clean, schema_of

from studytrail.operators import sessions as S
from studytrail.streaming.batches import BatchFolder
from studytrail.streaming.sessions import SessionStore


def frames(spark, spec, log, beats):
    return spark.createDataFrame(log, schema_of(spec)), spark.createDataFrame(beats, HEART)


def stored(spark, spec, store):
    return sorted(map(tuple, store.current(spark.createDataFrame([], schema_of(spec))).drop("is_open").collect()), key=repr)


def split(rows, rng, late):
    """Rows in three runs: by time, a share of them later than that."""
    ordered = sorted(rows, key=lambda r: r[-1])
    cuts = [ordered[len(ordered) // 3][-1], ordered[2 * len(ordered) // 3][-1]] if ordered else [0, 0]
    parts = [[], [], []]
    for r in rows:
        n = sum(r[-1] > c for c in cuts)
        parts[rng.randrange(n, 3) if rng.random() < late else n].append(r)
    return parts


@pytest.mark.parametrize("name,late,limit", [("COURSE", 0.0, 1 << 20), ("COURSE", 0.5, 25), ("VIDEO", 0.3, 1 << 20), ("LOGIN", 0.6, 1 << 20)])
def test_runs_equal_sessions_computed_once(spark, tmp_path, name, late, limit):
    spec = getattr(S, name)
    rng = random.Random(len(name) * 10 + int(late * 10))
    log, beats = make_log(spec, rng, 150, nulls=False), make_beats(rng, 60)
    store = SessionStore(spark, str(tmp_path), spec, limit)
    seen = [], []
    for some_log, some_beats in zip(split(log, rng, late), split(beats, rng, late)):
        store.run(*frames(spark, spec, some_log, some_beats))
        seen[0].extend(some_log)
        seen[1].extend(some_beats)
        assert stored(spark, spec, store) == sorted(replay_clean(spec, *seen), key=repr)


def course(i, ct, at, uid=1, cid=1):
    """A course row: id, uid, cid, appid, sn, at, ct."""
    return (i, uid, cid, 0, 0, at, T0 + timedelta(minutes=ct))


@pytest.fixture
def store(spark, tmp_path):
    store = SessionStore(spark, str(tmp_path), S.COURSE)
    log = [course(2, 10, 0), course(3, 20, 1), course(4, 25, 0), course(5, 40, 1), course(6, 45, 2), course(7, 50, 1, uid=2)]
    store.run(*frames(spark, S.COURSE, log, []))
    return store


def ends(spark, store):
    return sorted((r[0], minute(r[-2]), minute(r[-1])) for r in stored(spark, S.COURSE, store))


def minute(ct):
    return int((ct - T0).total_seconds() // 60)


def written(store, number):
    return len(store.spark.read.parquet(f"{store.root}/sessions/batch-0-{number}").collect())


def test_rows_in_order_read_no_stored_rows_or_sessions(spark, store, monkeypatch):
    read = BatchFolder.read

    def only_entities(self, schema):
        assert self.root.endswith("/entities"), self.root
        return read(self, schema)

    monkeypatch.setattr(BatchFolder, "read", only_entities)
    store.run(*frames(spark, S.COURSE, [course(8, 60, 2), course(9, 70, 1)], []))
    monkeypatch.undo()
    assert ends(spark, store) == [(3, 20, 25), (5, 40, 60), (7, 50, 50), (9, 70, 70)]
    # The session that went on and the new one.
    assert written(store, 1) == 2


def test_late_activity_moves_one_end_without_stored_rows(spark, store, monkeypatch):
    read = BatchFolder.read

    def no_rows(self, schema):
        assert not self.root.endswith("/rows"), self.root
        return read(self, schema)

    monkeypatch.setattr(BatchFolder, "read", no_rows)
    store.run(*frames(spark, S.COURSE, [course(8, 30, 2)], []))
    monkeypatch.undo()
    assert ends(spark, store) == [(3, 20, 30), (5, 40, 45), (7, 50, 50)] and written(store, 1) == 1


def test_a_late_enter_row_cuts_a_session(spark, store):
    store.run(*frames(spark, S.COURSE, [course(8, 22, 1)], []))
    assert ends(spark, store) == [(3, 20, 20), (5, 40, 45), (7, 50, 50), (8, 22, 25)] and written(store, 1) == 2


def test_a_late_enter_row_before_the_first(spark, store):
    """The row at 10 belonged to no session; now it closes the new one."""
    store.run(*frames(spark, S.COURSE, [course(8, 5, 1)], []))
    assert ends(spark, store) == [(3, 20, 25), (5, 40, 45), (7, 50, 50), (8, 5, 10)]


def test_rows_taken_twice_change_nothing(spark, store):
    before = ends(spark, store)
    store.run(*frames(spark, S.COURSE, [course(3, 20, 1), course(4, 25, 0)], []))
    assert ends(spark, store) == before and written(store, 1) == 0


def test_an_unfinished_run_counts_nothing(spark, store, monkeypatch):
    before = ends(spark, store)
    log = [course(8, 60, 2), course(9, 22, 1)]

    def lost(self, df, batch):
        raise RuntimeError("lost")

    kept = BatchFolder.write
    monkeypatch.setattr(BatchFolder, "write", lambda self, df, batch: (lost if self.root.endswith("entities") else kept)(self, df, batch))
    with pytest.raises(RuntimeError):
        store.run(*frames(spark, S.COURSE, log, []))
    monkeypatch.undo()
    assert ends(spark, store) == before
    store.run(*frames(spark, S.COURSE, log, []), position={"id": 9})
    assert ends(spark, store) == [(3, 20, 20), (5, 40, 60), (7, 50, 50), (9, 22, 25)] and store.position() == {"id": 9}


def test_an_empty_run(spark, store):
    before = ends(spark, store)
    store.run(*frames(spark, S.COURSE, [], []))
    assert ends(spark, store) == before


def test_what_a_run_closed(spark, store):
    log = spark.createDataFrame([], schema_of(S.COURSE))
    closed = lambda n: sorted((r.maxindex, minute(r.maxct), r.again) for r in store.closed_in((0, n), log).collect())
    assert closed(0) == [(3, 25, False)]
    store.run(*frames(spark, S.COURSE, [course(8, 60, 2), course(9, 70, 1), course(10, 55, 0, uid=2)], []))
    assert closed(1) == [(5, 60, False)]
    # A late row moves a closed end, a late enter row closes a session that a new one precedes.
    store.run(*frames(spark, S.COURSE, [course(11, 30, 0), course(12, 65, 1)], []))
    assert closed(2) == [(3, 30, True), (12, 65, False)]


@pytest.mark.parametrize("dies", [False, True])
def test_job_reads_new_rows_and_delivers_once(spark, tmp_path, monkeypatch, dies):
    from studytrail import jobs
    from studytrail.sources import jdbc

    rng = random.Random(6)
    log, beats = sorted(make_log(S.COURSE, rng, 90, nulls=False)[:90], key=lambda r: r[0]), make_beats(rng, 40)
    tables = {"session_course": [], jobs.changed_table("course"): []}
    asked, upto, lost = [], [0], []

    def read(spark, connection, table, column, partitions):
        asked.append(table)
        if "timestat" in table:
            after = int(table.split(">")[1].split(")")[0]) if ">" in table else -1
            return spark.createDataFrame([(*b, n) for n, b in enumerate(beats[: upto[0] // 3]) if n > after], HEART + ", n int")
        after = int(table.split(">")[1].split(")")[0]) if ">" in table else 0
        return spark.createDataFrame([r for r in log[: upto[0]] if r[0] > after], schema_of(S.COURSE))

    def append(rows, connection, table, batch_size=0):
        tables[table] += rows.collect()
        if dies and not lost:
            lost.append(table)
            raise RuntimeError("lost")

    def append_new(spark, rows, connection, table, keys, partitions):
        known = {tuple(r[k] for k in keys) for r in tables[table]}
        tables[table] += [r for r in rows.collect() if tuple(r[k] for k in keys) not in known]

    monkeypatch.setattr(jdbc, "read_table_by_range", read)
    monkeypatch.setattr(jdbc, "append_table", append)
    monkeypatch.setattr(jdbc, "append_new", append_new)
    monkeypatch.setattr(jdbc, "replace_table", lambda rows, connection, table: tables.update({table: rows.collect()}))
    for n in (40, 75, 90):
        upto[0] = n
        try:
            jobs.incremental_session_jobs(spark, {}, ["course"], str(tmp_path), heartbeat_position="n")
        except RuntimeError:
            jobs.incremental_session_jobs(spark, {}, ["course"], str(tmp_path), heartbeat_position="n")
    ends = {tuple(r)[:-1]: r[-1] for r in tables["session_course"]}
    assert len(ends) == len(tables["session_course"])
    ends |= {tuple(r)[:-1]: r[-1] for r in tables[jobs.changed_table("course")]}
    found = sorted([(*k, v) for k, v in ends.items()] + list(map(tuple, tables[jobs.open_table("course")])))
    assert found == replay_clean(S.COURSE, log, beats[:30])
    assert any("id > 75" in t or "id > 40" in t for t in asked)


def test_rows_beyond():
    from studytrail.sources.jdbc import rows_beyond

    assert rows_beyond("t", "id", None) == "t"
    assert rows_beyond("t", "id", 5) == "(select * from t where id > 5) beyond_id"
    assert rows_beyond("t", "ct", "it's") == "(select * from t where ct > 'it''s') beyond_ct"
