"""Sessions against a plain replay, with ties, null marks, copies and a hot group."""

import random
from datetime import datetime, timedelta

import pytest

from studytrail.operators import sessions as S

T0 = datetime(2024, 1, 1)
TYPES = {"sp": "double", "ct": "timestamp_ntz", "at": "int"}
HEART = "uid long, cid long, rid long, rt long, ct timestamp_ntz"


def schema_of(spec):
    return ", ".join(f"{c} {TYPES.get(c, 'long')}" for c in spec.log_columns)


def make_log(spec, rng, rows, hot=False, nulls=True):
    out = []
    for i in range(rows):
        uid = 1 if hot and rng.random() < 0.5 else rng.randint(1, 6)
        row = {c: rng.randint(0, 2) for c in spec.log_columns}
        row.update(id=i + 1, uid=uid, at=rng.choice([0, 1, 1, 2] + ([None] if nulls else [])))
        row["ct"] = T0 + timedelta(minutes=rng.randint(0, rows // 2))
        if "sp" in row:
            row["sp"] = float(rng.randint(0, 50))
        out.append(tuple(row[c] for c in spec.log_columns))
    return out + out[: rows // 10]


def make_beats(rng, rows):
    return [
        (rng.randint(1, 6), rng.randint(0, 2), rng.randint(0, 2), rng.randint(0, 2), T0 + timedelta(minutes=rng.randint(0, rows)))
        for _ in range(rows)
    ]


def as_rows(spec, log, beats):
    names = ("uid", "cid", "rid", "rt", "ct")
    rows = {r for r in log}
    for b in beats:
        d = dict(zip(names, b))
        rows.add(tuple(d[c] if c in spec.heartbeat else 0 for c in spec.log_columns))
    return [dict(zip(spec.log_columns, r)) for r in rows]


def peaks_of(spec, rows):
    out = {}
    for r in rows:
        if spec.peak:
            k = tuple(r[c] for c in spec.peak_key)
            out[k] = max(out.get(k, r[spec.peak]), r[spec.peak])
    return out


def emit(spec, row, peaks, lo, hi):
    vals = [row[src] for _, src in spec.output]
    if spec.peak:
        vals.append(float(peaks[tuple(row[c] for c in spec.peak_key)]))
    return tuple(vals) + (lo, hi)


def replay_clean(spec, log, beats):
    """Peaks over all rows, as the original takes them; then rows without a mark are left out."""
    rows = as_rows(spec, log, beats)
    peaks = peaks_of(spec, rows)
    rows = [r for r in rows if r["at"] is not None]
    open_by, out = {}, []
    for r in sorted(rows, key=lambda r: (r["ct"], r["id"])):
        key = tuple(r[c] for c in spec.entity)
        if r["at"] == 1:
            open_by[key] = [r, r["ct"]]
            out.append(open_by[key])
        elif key in open_by:
            open_by[key][1] = r["ct"]
    return sorted(emit(spec, r, peaks, r["ct"], end) for r, end in out)


def replay_compat(spec, log, beats):
    """The original pipeline step by step over one global order."""
    rows = as_rows(spec, log, beats)
    peaks = peaks_of(spec, rows)
    rows.sort(key=lambda r: tuple(r[c] for c in (*spec.group, *spec.order, "ct", "id")))
    kept = [
        i
        for i, r in enumerate(rows)
        if r["at"] == 1 or (i + 1 < len(rows) and rows[i + 1]["at"] == 1)
    ]
    groups = {}
    for n, i in enumerate(kept):
        r = rows[i]
        if r["at"] is None:
            continue
        tag = i if r["at"] == 1 else (kept[n - 1] if n else None)
        groups.setdefault((tuple(r[c] for c in spec.group), tag), []).append(r)
    out = []
    for members in groups.values():
        main = min(members, key=lambda r: (r["ct"], r["id"]))
        times = [r["ct"] for r in members]
        out.append(emit(spec, main, peaks, min(times), max(times)))
    return sorted(out)


SPECS = [S.LOGIN, S.COURSE, S.ACTIVITY, S.HOMEWORK, S.VIDEO]
REPLAY = {"clean": replay_clean, "compat": replay_compat}


@pytest.mark.parametrize("mode", ["clean", "compat"])
@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
@pytest.mark.parametrize("limit", [10**6, 40])
def test_against_replay(spark, spec, mode, limit):
    rng = random.Random(f"{spec.name}-{mode}")
    log, beats = make_log(spec, rng, 400, hot=True), make_beats(rng, 150)
    got = S.sessionize(
        spark.createDataFrame(log, schema_of(spec)),
        spark.createDataFrame(beats, HEART),
        spec,
        mode,
        rows_per_slice=limit,
    )
    assert sorted(map(tuple, got.collect())) == REPLAY[mode](spec, log, beats)


def test_copies_of_one_row(spark):
    """A third of the log is one repeated heartbeat."""
    rng = random.Random(5)
    log = make_log(S.COURSE, rng, 200, nulls=False)
    beats = make_beats(rng, 50) + [(1, 1, 1, 1, T0 + timedelta(minutes=30))] * 300
    got = S.sessionize(
        spark.createDataFrame(log, schema_of(S.COURSE)),
        spark.createDataFrame(beats, HEART),
        S.COURSE,
        rows_per_slice=40,
    )
    assert sorted(map(tuple, got.collect())) == replay_clean(S.COURSE, log, beats)


def course(spark, rows, mode, beats=()):
    log = [(i, u, 1, 7, 9, at, T0 + timedelta(minutes=m)) for i, (u, at, m) in enumerate(rows, 1)]
    df = S.sessionize(
        spark.createDataFrame(log, schema_of(S.COURSE)),
        spark.createDataFrame(list(beats), HEART),
        S.COURSE,
        mode,
    )
    return sorted(
        (r.uid, r.maxindex, (r.minct - T0).seconds // 60, (r.maxct - T0).seconds // 60) for r in df.collect()
    )


def test_last_session_open_unless_next_user_enters(spark):
    rows = [(1, 1, 0), (1, 0, 5), (2, 0, 1), (2, 1, 2), (2, 0, 9)]
    assert course(spark, rows, "clean") == [(1, 1, 0, 5), (2, 4, 2, 9)]
    # User 2 begins with activity: user 1 stays open; that activity becomes an orphan.
    assert course(spark, rows, "compat") == [(1, 1, 0, 0), (2, 3, 1, 1), (2, 4, 2, 2)]
    rows = [(1, 1, 0), (1, 0, 5), (2, 1, 2)]
    assert course(spark, rows, "compat") == [(1, 1, 0, 5), (2, 3, 2, 2)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        course(spark, [(1, 1, 0)], "other")


def test_one_exchange_without_hot_groups(spark):
    rng = random.Random(1)
    df = S.sessionize(
        spark.createDataFrame(make_log(S.COURSE, rng, 50), schema_of(S.COURSE)),
        spark.createDataFrame(make_beats(rng, 10), HEART),
        S.COURSE,
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def sessions_of(spark, spec, mode, log, beats=()):
    """Sessions as (id of the naming row, start minute, end minute); log rows are dicts."""
    rows = [
        tuple(T0 + timedelta(minutes=r["ct"]) if c == "ct" else r.get(c, 0.0 if c == "sp" else 0) for c in spec.log_columns)
        for r in log
    ]
    beats = [(b["uid"], b.get("cid", 0), b.get("rid", 0), b.get("rt", 0), T0 + timedelta(minutes=b["ct"])) for b in beats]
    df = S.sessionize(spark.createDataFrame(rows, schema_of(spec)), spark.createDataFrame(beats, HEART), spec, mode)
    return sorted((r.maxindex, (r.minct - T0).seconds // 60, (r.maxct - T0).seconds // 60) for r in df.collect())


def test_login_heartbeats_sort_before_rows_with_a_type(spark):
    log = [{"id": 1, "uid": 1, "rt": 1, "at": 1, "ct": 0}, {"id": 2, "uid": 1, "rt": 1, "at": 1, "ct": 9}]
    beats = [{"uid": 1, "ct": 5}]
    assert sessions_of(spark, S.LOGIN, "clean", log, beats) == [(1, 0, 5), (2, 9, 9)]
    # The heartbeat has rt 0: it comes first, closes nothing and becomes an orphan.
    assert sessions_of(spark, S.LOGIN, "compat", log, beats) == [(0, 5, 5), (1, 0, 0), (2, 9, 9)]


def test_row_of_the_next_resource_widens_a_session(spark):
    log = [
        {"id": 1, "uid": 1, "rid": 1, "at": 1, "ct": 0},
        {"id": 2, "uid": 1, "rid": 2, "at": 0, "ct": 5},
        {"id": 3, "uid": 1, "rid": 2, "at": 1, "ct": 7},
    ]
    assert sessions_of(spark, S.VIDEO, "clean", log) == [(1, 0, 0), (3, 7, 7)]
    assert sessions_of(spark, S.VIDEO, "compat", log) == [(1, 0, 5), (3, 7, 7)]


def test_closing_row_of_a_later_type_may_be_earlier(spark):
    log = [
        {"id": 1, "uid": 1, "rt": 1, "at": 1, "ct": 10},
        {"id": 2, "uid": 1, "rt": 2, "at": 0, "ct": 3},
        {"id": 3, "uid": 1, "rt": 2, "at": 1, "ct": 20},
    ]
    assert sessions_of(spark, S.LOGIN, "clean", log) == [(1, 10, 10), (3, 20, 20)]
    assert sessions_of(spark, S.LOGIN, "compat", log) == [(2, 3, 10), (3, 20, 20)]


@pytest.mark.parametrize("mode", ["clean", "compat"])
def test_equal_rows_count_once(spark, mode):
    log = [{"id": 1, "uid": 1, "cid": 1, "at": 1, "ct": 0}] * 3
    assert sessions_of(spark, S.COURSE, mode, log) == [(1, 0, 0)]


def test_null_keys_are_one_entity(spark):
    log = [
        {"id": 1, "uid": None, "cid": 1, "at": 1, "ct": 0},
        {"id": 2, "uid": None, "cid": 1, "at": 0, "ct": 4},
        {"id": 3, "uid": 1, "cid": 1, "at": 1, "ct": 2},
    ]
    for mode in ("clean", "compat"):
        assert sessions_of(spark, S.COURSE, mode, log) == [(1, 0, 4), (3, 2, 2)]


def test_empty_input(spark):
    for mode in ("clean", "compat"):
        assert sessions_of(spark, S.VIDEO, mode, []) == []
