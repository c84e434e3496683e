"""Session jobs with their SQL over one global order."""

from __future__ import annotations

from pyspark.sql import functions as F

from studytrail.jobs import SESSION_KEYS
from studytrail.operators import sessions as S
from studytrail.plans import fixtures as X
from studytrail.plans.registry import Registry
from studytrail.runtime import temporary_folder
from studytrail.sources.jdbc import new_rows
from studytrail.streaming.sessions import SessionStore

# Resource logs differ in how many resources a course has.
JOBS = {
    "login": (S.LOGIN, 4),
    "course": (S.COURSE, 4),
    "activity": (S.ACTIVITY, 4),
    "homework": (S.HOMEWORK, 4),
    "video": (S.VIDEO, 4),
    "document": (S.DOCUMENT, 5),
    "live": (S.LIVE, 6),
    "pictext": (S.PICTEXT, 7),
}


def _rows_sql(spec: S.SessionSpec, resources: int) -> str:
    log = ", ".join(f'"{c}"' for c in spec.log_columns)
    beat = ", ".join(c if c in spec.heartbeat else f'0 as "{c}"' for c in spec.log_columns)
    return (
        f"with ops as ({X.ops_sql(resources)}), heartbeat as ({X.FIXTURE_SQL['heartbeat']}), "
        f"logrows as (select {log} from ops union select {beat} from heartbeat)"
    )


def _peak_sql(spec: S.SessionSpec) -> str:
    return f", max({spec.peak}) over (partition by {', '.join(spec.peak_key)}) as maxsp" if spec.peak else ""


def _out(spec: S.SessionSpec, alias: str) -> str:
    cols = [f"{alias}.{src} as {out}" for out, src in spec.output]
    return ", ".join(cols + ([f"{alias}.maxsp"] if spec.peak else []))


def clean_sql(spec: S.SessionSpec, resources: int) -> str:
    key = ", ".join(spec.entity)
    on = " and ".join(f"b.{c}=s.{c}" for c in spec.entity)
    return f"""{_rows_sql(spec, resources)},
 p as (select *{_peak_sql(spec)} from logrows),
 s as (select *, sum(case when "at"=1 then 1 else 0 end)
   over (partition by {key} order by ct, id nulls first rows unbounded preceding) as sid from p where "at" is not null),
 b as (select {key}, sid, min(ct) as minct, max(ct) as maxct from s where sid>0 group by {key}, sid)
 select {_out(spec, 's')}, b.minct, b.maxct from b join s on {on} and b.sid=s.sid and s."at"=1"""


def compat_sql(spec: S.SessionSpec, resources: int) -> str:
    key = ", ".join(spec.group)
    order = ", ".join([*spec.group, *spec.order, "ct", "id nulls first"])
    return f"""{_rows_sql(spec, resources)},
 numbered as (select *, row_number() over (order by {order}) as n, lead("at") over (order by {order}) as nxt{_peak_sql(spec)}
   from logrows),
 kept as (select * from numbered where "at"=1 or nxt=1),
 tagged as (select *, case when "at"=1 then n else lag(n) over (order by n) end as tag from kept),
 g as (select *, min(ct) over (partition by {key}, tag) as minct, max(ct) over (partition by {key}, tag) as maxct,
   row_number() over (partition by {key}, tag order by ct, id nulls first) as rn from tagged where "at" is not null)
 select {_out(spec, 'g')}, minct, maxct from g where rn=1"""


def _job(spec: S.SessionSpec, resources: int, mode: str, limit: int | None = None):
    def run(spark, sf_dir):
        events = X.tables(spark, sf_dir)("events")
        extra = {} if limit is None else {"rows_per_slice": limit}
        return S.sessionize(X.operations(events, resources), X.heartbeats(events), spec, mode, **extra)

    return run


def _append_new(spark, sf_dir):
    """All sessions after two runs over a growing log, the first of them up to 15 January: those
    stored closed by either run, and those still open after the second."""
    events = X.tables(spark, sf_dir)("events")
    log, beats = X.operations(events), X.heartbeats(events)
    until = F.col("ct") < F.lit("2024-01-15").cast("timestamp_ntz")

    def run(log, beats):
        found = S.sessionize(log, beats, S.COURSE, with_open=True)
        return [found.filter(F.col("is_open") == state).drop("is_open") for state in (False, True)]

    stored, _ = run(log.filter(until), beats.filter(until))
    closed, still_open = run(log, beats)
    return stored.union(new_rows(closed, stored, SESSION_KEYS["course"])).union(still_open)


def _incremental(spec: S.SessionSpec, resources: int):
    """Sessions kept over three runs: up to 11 January, up to 21 January, the rest. One row in five
    comes a run late, enter rows and heartbeats among them."""

    def run(spark, sf_dir):
        events = X.tables(spark, sf_dir)("events")
        number = sum((F.col("ts") >= F.lit(day).cast("timestamp_ntz")).cast("int") for day in ("2024-01-11", "2024-01-21"))
        arrives = F.least(number + (F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0).cast("int"), F.lit(2))
        store = SessionStore(spark, temporary_folder(spark, "sessions"), spec)
        for n in range(3):
            some = events.filter(arrives == n)
            store.run(X.operations(some, resources), X.heartbeats(some))
        return store.current(X.operations(events, resources)).drop("is_open")

    return run


def register(reg: Registry) -> None:
    for name, (spec, resources) in JOBS.items():
        reg.add(f"ses_{name}_clean", _job(spec, resources, "clean"), clean_sql(spec, resources))
        reg.add(f"ses_{name}_compat", _job(spec, resources, "compat"), compat_sql(spec, resources))
    # The same jobs with the row limit low enough that groups are cut into slices.
    reg.add("ses_course_clean_sliced", _job(S.COURSE, 4, "clean", 20), clean_sql(S.COURSE, 4))
    reg.add("ses_login_compat_sliced", _job(S.LOGIN, 4, "compat", 50), compat_sql(S.LOGIN, 4))
    reg.add("ses_append_new", _append_new, clean_sql(S.COURSE, 4))
    reg.add("ses_incremental", _incremental(S.COURSE, 4), clean_sql(S.COURSE, 4))
    reg.add("ses_incremental_video", _incremental(S.VIDEO, 4), clean_sql(S.VIDEO, 4))
