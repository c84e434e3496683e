"""Operation logs and heartbeats to sessions.

``clean`` gives what the session jobs are meant to compute: a session opens at an
enter row and lasts to the last row before the next enter row of the same entity.
``compat`` gives what the original SQL yields, whose windows run over all users at
once.

Both build on ``chain``: rows in order become runs, one per enter row, each with
its opening and its last row. clean partitions by entity and cuts only hot entities
into slices; compat cuts the one global order into slices. ``chain`` runs per slice
and once more over the few pieces at the slice borders.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studytrail.operators.slices import ROWS_PER_SLICE, SLICE, Slices, plan_slices, with_slice

# Slices of the global order are also the unit of parallel work, hence smaller.
GLOBAL_SLICE_ROWS = 500_000


@dataclass(frozen=True)
class SessionSpec:
    """Columns of one session job.

    log_columns      columns taken from the operation log
    heartbeat        log columns the heartbeat table supplies; the rest become 0
    entity           key of the clean mode
    group            key of the compat mode (a prefix of its order)
    order            compat order inside the group, before the time
    output           (output name, log column) pairs taken from the opening row
    peak             log column whose maximum per ``peak_key`` is output as maxsp
    """

    name: str
    log_columns: tuple[str, ...]
    heartbeat: tuple[str, ...]
    entity: tuple[str, ...]
    group: tuple[str, ...]
    order: tuple[str, ...]
    output: tuple[tuple[str, str], ...]
    peak: str | None = None
    peak_key: tuple[str, ...] = ()


def _same(*names: str) -> tuple[tuple[str, str], ...]:
    return tuple((n, n) for n in names)


LOGIN = SessionSpec(
    name="login",
    log_columns=("id", "uid", "appid", "lo", "la", "net", "de", "v", "rt", "at", "sn", "ct"),
    heartbeat=("uid", "ct"),
    entity=("uid",),
    group=("uid",),
    order=("rt",),
    output=(("maxindex", "id"), *_same("uid", "appid", "lo", "la", "net", "de", "v", "sn")),
)
COURSE = SessionSpec(
    name="course",
    log_columns=("id", "uid", "cid", "appid", "sn", "at", "ct"),
    heartbeat=("uid", "cid", "ct"),
    entity=("uid", "cid"),
    group=("uid", "cid"),
    order=(),
    output=(("maxindex", "id"), *_same("uid", "cid", "appid", "sn")),
)
ACTIVITY = SessionSpec(
    name="activity",
    log_columns=("id", "uid", "rid", "aid", "rt", "ct", "at"),
    heartbeat=("uid", "rid", "rt", "ct"),
    entity=("uid", "rid"),
    group=("uid", "rid"),
    order=(),
    output=(("maxindex", "id"), *_same("uid", "rid"), ("maxaid", "aid"), ("rt", "rt")),
)
HOMEWORK = SessionSpec(
    name="homework",
    log_columns=("id", "uid", "cid", "hid", "qid", "rt", "at", "ct", "lt", "il"),
    heartbeat=("uid", "cid", "rt", "ct"),
    entity=("uid", "cid"),
    group=("uid", "cid"),
    order=(),
    output=(("maxindex", "id"), *_same("uid", "cid"), ("maxqid", "qid"), *_same("rt", "lt", "il")),
)


def resource_spec(name: str) -> SessionSpec:
    """The four resource jobs (video, document, live, picture/text) share one shape."""
    return SessionSpec(
        name=name,
        log_columns=("id", "uid", "cid", "rid", "rt", "ct", "at", "sp"),
        heartbeat=("uid", "cid", "rid", "rt", "ct"),
        entity=("uid", "cid", "rid"),
        group=("uid", "cid"),
        order=("rid",),
        output=(("maxindex", "id"), *_same("uid", "cid", "rid", "rt")),
        peak="sp",
        peak_key=("uid", "cid", "rid"),
    )


VIDEO, DOCUMENT, LIVE, PICTEXT = map(resource_spec, ("video", "document", "live", "pictext"))


def union_rows(log: DataFrame, heartbeat: DataFrame, spec: SessionSpec) -> DataFrame:
    """Log rows plus heartbeats in the log's shape, absent columns 0 (not yet distinct)."""
    rows = log.select(*spec.log_columns)
    types = {f.name: f.dataType for f in rows.schema.fields}
    beats = heartbeat.select(
        *[
            (F.col(c) if c in spec.heartbeat else F.lit(0)).cast(types[c]).alias(c)
            for c in spec.log_columns
        ]
    )
    return rows.unionByName(beats)


def _place(rows: DataFrame, keys: Sequence[str], slices: Slices | None) -> tuple[DataFrame, list[str]]:
    """Distinct rows, partitioned by group (and slice) once for all later windows.

    Equal rows agree on every key, so the one exchange also serves the distinct.
    Only when the sample met a large set of equal rows does a separate distinct,
    which combines before its shuffle, go first.
    """
    part = list(keys)
    if slices is not None and slices.has_copies:
        rows = rows.distinct()
    if slices is not None or not keys:
        rows = with_slice(rows, slices)
        part.append(SLICE)
    return rows.repartition(*part).distinct(), part


def chain(df: DataFrame, part: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Runs of rows: (part, order, enter, s, e, head, tail).

    Needs ``enter`` (bool) and the structs ``s``, ``e``. A run starts at an enter row;
    ``head`` marks rows before the first one (no opening row), ``tail`` the last run
    of the partition. ``e`` becomes that of the run's last row. One sort serves all
    windows; only opening and closing rows survive the filter.
    """
    w = Window.partitionBy(*part).orderBy(*order)
    flagged = df.withColumns(
        {
            "__opens": F.sum(F.col("enter").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "__next": F.lead("enter").over(w),
        }
    )
    ends = F.coalesce(F.col("__next"), F.lit(True))
    kept = flagged.filter(F.col("enter") | ends).withColumn(
        "__end", F.struct("e", F.col("__next").isNull().alias("tail"))
    )
    linked = kept.withColumn("__end", F.when(ends, F.col("__end")).otherwise(F.lead("__end").over(w)))
    runs = linked.filter(F.col("enter") | (F.col("__opens") == 0))
    return runs.withColumns(
        {
            "head": ~F.col("enter"),
            "e": F.col("__end.e"),
            "tail": F.col("__end.tail"),
        }
    ).drop("__opens", "__next", "__end")


def _runs(
    rows: DataFrame,
    spec: SessionSpec,
    keys: Sequence[str],
    order: Sequence[str],
    opening: Sequence[Column],
    closing: Sequence[Column],
    slices: Slices | None,
    only_marked: bool = False,
) -> DataFrame:
    """Final runs per group: (keys, enter, s, e, head, tail). s holds the opening
    fields of a run's first row, e the closing fields of its last, both with the peak as
    far as the slice knows it. The peak counts all rows; ``only_marked`` leaves those without
    an enter mark out of the runs."""
    placed, part = _place(rows, keys, slices)
    if spec.peak:
        # Ordered like the windows of the runs, so that one sort serves all.
        whole = (
            Window.partitionBy(*dict.fromkeys((*part, *spec.peak_key)))
            .orderBy(*[c for c in order if c not in spec.peak_key])
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        )
        placed = placed.withColumn("maxsp", F.max(spec.peak).over(whole))
        opening, closing = [[*fields, F.col("maxsp")] for fields in (opening, closing)]
    if only_marked:
        placed = placed.filter(F.col("at").isNotNull())
    marked = placed.select(
        *part,
        *[F.col(c).alias(f"__o_{c}") for c in order],
        F.coalesce(F.col("at") == 1, F.lit(False)).alias("enter"),
        F.struct(*opening).alias("s"),
        F.struct(*closing).alias("e"),
    )
    sort = [f"__o_{c}" for c in order]
    runs = chain(marked, part, sort)
    if slices is None:
        return runs.drop(SLICE, *sort)
    # Only the pieces at the borders of a cut group's slices meet again, at most two a slice; all
    # other runs stay where they are.
    border = (F.col("head") | F.col("tail")) & slices.is_hot()
    pieces = runs.filter(border).drop("head", "tail").withColumn("__piece", F.least(SLICE, F.lit(-1)))
    stitched = chain(pieces, [*keys, "__piece"], [SLICE, *sort])
    return runs.filter(~border).drop(SLICE, *sort).unionByName(stitched.drop(SLICE, "__piece", *sort))


def _whole_peaks(sessions: DataFrame, rows: DataFrame, spec: SessionSpec, slices: Slices) -> DataFrame:
    """The peak over all slices for keys that have a cut among their rows. They are no
    more than the cuts, which bounds the broadcast."""
    peaks = (
        rows.filter(slices.is_split(spec.peak_key))
        .groupBy(*[F.col(c).alias(f"__p_{c}") for c in spec.peak_key])
        .agg(F.max(spec.peak).alias("__peak"))
    )
    match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__p_{c}")) for c in spec.peak_key])
    joined = sessions.join(F.broadcast(peaks), match, "left")
    return joined.withColumn("maxsp", F.coalesce("__peak", "maxsp"))


def _columns(spec: SessionSpec) -> list[str]:
    names = [out for out, _ in spec.output]
    return names + (["maxsp"] if spec.peak else []) + ["minct", "maxct"]


def sessionize(
    log: DataFrame,
    heartbeat: DataFrame,
    spec: SessionSpec,
    mode: str = "clean",
    rows_per_slice: int = ROWS_PER_SLICE,
    with_open: bool = False,
) -> DataFrame:
    """Session rows of one job; ``mode`` is ``clean`` or ``compat``. ``with_open`` adds, in clean
    mode, ``is_open``: no later enter row of the entity has closed the session yet.

    Inputs beyond one slice are counted and sampled here, before any action on the result."""
    rows = union_rows(log, heartbeat, spec)
    if mode == "clean":
        return _clean(rows, spec, rows_per_slice, with_open)
    if mode == "compat":
        return _compat(rows, spec, rows_per_slice)
    raise ValueError(f"unknown mode {mode!r}")


def clean_runs(rows: DataFrame, spec: SessionSpec, rows_per_slice: int) -> DataFrame:
    """Sessions of rows in the log's shape, with ``is_open`` and ``last_id``, the id of the last row."""
    if not spec.peak:
        rows = rows.filter(F.col("at").isNotNull())
    slices = plan_slices(rows, spec.entity, ("ct", "id"), rows_per_slice)
    opening = [*[F.col(src).alias(out) for out, src in spec.output], F.col("ct")]
    runs = _runs(rows, spec, spec.entity, ("ct", "id"), opening, [F.col("ct"), F.col("id")], slices, True).filter("enter")
    sessions = runs.select(
        "s.*", F.col("e.ct").alias("maxct"), F.col("tail").alias("is_open"), F.col("e.id").alias("last_id")
    ).withColumnRenamed("ct", "minct")
    if spec.peak and slices is not None:
        sessions = _whole_peaks(sessions, rows, spec, slices)
    return sessions.select(*_columns(spec), "is_open", "last_id")


def _clean(rows: DataFrame, spec: SessionSpec, rows_per_slice: int, with_open: bool) -> DataFrame:
    sessions = clean_runs(rows, spec, rows_per_slice)
    return sessions.select(*_columns(spec), *(["is_open"] if with_open else []))


def runs_between(rows: DataFrame, spec: SessionSpec, fields: Sequence[str], rows_per_slice: int) -> DataFrame:
    """For rows (entity, ct, id, at, fields): every row with ``at`` 1, as ``s``, and the last row
    before the next such row of its entity, as ``e``; both hold the fields."""
    slices = plan_slices(rows, spec.entity, ("ct", "id"), rows_per_slice)
    kept = [F.col(c) for c in fields]
    return _runs(rows, replace(spec, peak=None), spec.entity, ("ct", "id"), kept, kept, slices).filter("enter")


def _compat(rows: DataFrame, spec: SessionSpec, rows_per_slice: int) -> DataFrame:
    order = (*spec.group, *spec.order, "ct", "id")
    slices = plan_slices(rows, (), order, min(rows_per_slice, GLOBAL_SLICE_ROWS))
    fields = [
        *[F.col(src).alias(out) for out, src in spec.output],
        F.col("ct").alias("__ct"),
        F.col("id").alias("__id"),
        F.col("at").alias("__at"),
        F.struct(*spec.group).alias("__group"),
    ]
    runs = _runs(rows, spec, (), order, fields, fields, slices)

    # A run's last row counts if it is no enter row and an enter row follows it. It
    # closes the session its run opened if both are of one group; if not, or if no
    # enter row came before, it makes a session of its own.
    s, e = F.col("s"), F.col("e")
    counts = F.coalesce((e["__at"] != 1) & ~F.col("tail"), F.lit(False))
    closes = F.col("enter") & counts & s["__group"].eqNullSafe(e["__group"])
    e_first = F.struct(e["__ct"], e["__id"]) < F.struct(s["__ct"], s["__id"])

    def session(row: Column, start: Column, end: Column) -> Column:
        return F.struct(row.alias("r"), start.alias("minct"), end.alias("maxct"))

    opened = (
        F.when(
            closes,
            session(
                F.when(e_first, e).otherwise(s),
                F.least(s["__ct"], e["__ct"]),
                F.greatest(s["__ct"], e["__ct"]),
            ),
        )
        .when(F.col("enter"), session(s, s["__ct"], s["__ct"]))
        .alias("opened")
    )
    orphan = F.when(counts & ~closes, session(e, e["__ct"], e["__ct"])).alias("orphan")
    sessions = (
        runs.filter(F.col("enter") | counts)
        .select(F.explode(F.array_compact(F.array(opened, orphan))).alias("x"))
        .select("x.r.*", "x.minct", "x.maxct")
    )
    if spec.peak and slices is not None:
        sessions = _whole_peaks(sessions, rows, spec, slices)
    return sessions.select(*_columns(spec))
