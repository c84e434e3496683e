"""Answer events to reports per paper sitting and per customs.

Everything rests on one mergeable table, ``question_cells``: per (learner, sitting,
question) the attempts, right and wrong counts and the first and last outcome. It
combines before its shuffle, so a hot learner or question shrinks to one row per
question early; batches of a stream merge by the same aggregate. Both modes are
finished from it:

``clean``   counts of distinct questions and points, IsRight limited to 0 and 1
``compat``  what the message-by-message counter stores after its last event
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from studytrail.functions.keys import count_text, join_key, key_long, positive, ratio

REQUIRED = ("IsRight", "TestPaper_User_ID", "QuestionID", "CreateUser")
REQUIRED_OLDER = ("IsRight", "TestPaper_User_ID")

PAPER = ("user_id", "testpaper_user_id")
CUSTOMS = ("user_id", "customs_id")

# Cells that one task turns into items.
CELLS_PER_TASK = 200_000


def is_valid(required: Sequence[str] = REQUIRED) -> Column:
    ok = F.lit(True)
    for name in required:
        ok = ok & F.col(name).isNotNull()
    return ok


def valid_answers(messages: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    return messages.filter(is_valid(required))


def rejected_answers(messages: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    return messages.filter(~is_valid(required))


def is_counted(mode: str) -> Column:
    """Whether an answer enters the report: complete, and in clean mode IsRight is 0 or 1."""
    if mode == "compat":
        return is_valid()
    if mode == "clean":
        return is_valid() & F.col("IsRight").isin(0, 1)
    raise ValueError(f"unknown mode {mode!r}")


def question_cells(answers: DataFrame, mode: str = "clean", seq: str = "log_offset") -> DataFrame:
    """Mergeable counts per (user_id, testpaper_user_id, question_id)."""
    rows = answers.filter(is_counted(mode))
    right = F.col("IsRight")
    return rows.groupBy(
        F.col("CreateUser").alias("user_id"),
        F.col("TestPaper_User_ID").alias("testpaper_user_id"),
        F.col("QuestionID").alias("question_id"),
    ).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(right == 1).alias("right"),
        F.count_if(right == 0).alias("wrong"),
        F.min(seq).alias("first_seq"),
        F.min_by(right, seq).alias("first_right"),
        F.max(seq).alias("last_seq"),
        F.max_by(right, seq).alias("last_right"),
    )


def _merged_columns() -> list[Column]:
    return [
        F.sum("attempts").alias("attempts"),
        F.sum("right").alias("right"),
        F.sum("wrong").alias("wrong"),
        F.min("first_seq").alias("first_seq"),
        F.min_by("first_right", "first_seq").alias("first_right"),
        F.max("last_seq").alias("last_seq"),
        F.max_by("last_right", "last_seq").alias("last_right"),
    ]


def merge_cells(cells: DataFrame, keys: Sequence[str], *carried: str) -> DataFrame:
    """Re-aggregate question cells to coarser keys or across batches.

    ``carried`` columns are taken from the first event.
    """
    return cells.groupBy(*keys).agg(
        *_merged_columns(), *[F.min_by(c, "first_seq").alias(c) for c in carried]
    )


def first_task(paper_task: DataFrame) -> DataFrame:
    """One (task_id, customs_id) per sitting: that of the first row key in byte order."""
    rowkey = join_key(F.col("testPaper_user_id"), F.col("TaskID"), F.col("CustomsID"))
    best = paper_task.groupBy(F.col("testPaper_user_id").alias("testpaper_user_id")).agg(
        F.min(rowkey).alias("rowkey")
    )
    return best.select(
        "testpaper_user_id",
        key_long(F.col("rowkey"), 1).alias("task_id"),
        key_long(F.col("rowkey"), 2).alias("customs_id"),
    )


def with_tasks(cells: DataFrame, paper_task: DataFrame) -> DataFrame:
    return cells.join(first_task(paper_task), "testpaper_user_id", "left")


def customs_cells(cells: DataFrame, paper_task: DataFrame) -> DataFrame:
    """Question cells per (user, customs) for sittings that belong to a customs."""
    tagged = with_tasks(cells, paper_task).filter(F.col("customs_id") > 0)
    return merge_cells(tagged, [*CUSTOMS, "question_id"], "task_id")


def point_cells(cells: DataFrame, question_point: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per point: events touching it, right, wrong, first outcome, first and last event.

    Whether the dimension is broadcast is left to its measured size; a shuffled
    join with a hot question falls under AQE's skew join.
    """
    points = question_point.select(
        F.col("QuestionId").cast("bigint").alias("question_id"), F.col("PointId").cast("bigint").alias("point_id")
    ).distinct()
    return merge_cells(cells.join(points, "question_id"), [*keys, "point_id"])


def report_items(cells: DataFrame, question_point: DataFrame) -> DataFrame:
    """One row per cell for its question (``is_point`` false) and one for each of its points.

    The dimension gains a row without a point per question, so a single left join
    yields both kinds and the answers are read and shuffled once for a report.
    """
    point = F.col("PointId").cast("bigint")
    dimension = question_point.select(
        F.col("QuestionId").cast("bigint").alias("question_id"),
        F.explode(F.array(point, F.lit(None).cast("bigint"))).alias("point_id"),
    ).distinct()
    joined = cells.join(dimension, "question_id", "left")
    return joined.withColumns(
        {
            "is_point": F.col("point_id").isNotNull(),
            "item_id": F.coalesce("point_id", "question_id"),
        }
    )


def _numbered(cells: DataFrame) -> DataFrame:
    """Cells whose places in the order of events, if they are structs, are numbers of the same order.

    A report's items are many times its cells, and rows with numbers are aggregated by hash, those
    with structs by sorting. The cells are sorted once by each place, in ranges; no group has to
    fit one task."""
    if isinstance(cells.schema["first_seq"].dataType, StructType):
        for place in ("first_seq", "last_seq"):
            cells = cells.orderBy(place).withColumn(place, F.monotonically_increasing_id())
    return cells


def _with_places(report: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A report over numbered cells with the last place of each key instead of its number."""
    if not isinstance(cells.schema["last_seq"].dataType, StructType):
        return report
    last = cells.groupBy(*keys).agg(F.max("last_seq").alias("last_seq"))
    return report.drop("last_seq").join(last, list(keys))


COUNTS = ("q_count", "q_r_count", "q_f_count", "p_count", "p_r_count", "p_f_count")


def _clean_counts() -> list[Column]:
    """Aggregates over the merged items of a key."""
    out = []
    for letter, kind in (("q", ~F.col("is_point")), ("p", F.col("is_point"))):
        out += [
            F.count_if(kind).alias(f"{letter}_count"),
            F.count_if(kind & (F.col("right") > 0)).alias(f"{letter}_r_count"),
            F.count_if(kind & (F.col("wrong") > 0)).alias(f"{letter}_f_count"),
        ]
    return out


def _compat_report(items: DataFrame, keys: Sequence[str], *carried: str) -> DataFrame:
    """Counters of each key as stored by its last event, with ``last_seq`` and the greatest of the
    ``carried`` columns.

    The counters are the items known before the last event, by their first outcome, plus the
    last event's own question and points. Two mergeable aggregates tell them apart: items of a
    key that were last touched by one event are counted together, then the counts of all its
    events are summed, and those of the last one kept. An item the last event created is one it
    touched with a single attempt."""
    letters = (("q", ~F.col("is_point")), ("p", F.col("is_point")))
    shares = (("", F.lit(True)), ("_r", F.col("first_right") != 0), ("_f", F.col("first_right") == 0))
    total, created = [], []
    for letter, kind in letters:
        for share, which in shares:
            total.append(F.count_if(kind & which).alias(f"{letter}{share}"))
            created.append(F.count_if(kind & which & (F.col("attempts") == 1)).alias(f"{letter}{share}_new"))
    right = F.max(F.when(~F.col("is_point"), F.col("last_right"))).alias("last_right")
    by_event = items.groupBy(*keys, "last_seq").agg(*total, *created, right, *[F.max(c).alias(c) for c in carried])
    names = [f"{letter}{share}" for letter, _ in letters for share, _ in shares]
    # One by one: a struct would have the rows sorted.
    last = [F.max_by(n, "last_seq").alias(f"last_{n}") for n in ("q", "p", *[f"{n}_new" for n in names])]
    summed = by_event.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in names],
        F.max_by("last_right", "last_seq").alias("last_right"),
        *last,
        F.max("last_seq").alias("last_seq"),
        *[F.max(c).alias(c) for c in carried],
    )
    is_right = (F.col("last_right") == 1).cast("bigint")
    counters = []
    for letter, _ in letters:
        own = {"": F.lit(1), "_r": is_right, "_f": 1 - is_right}
        for share, _ in shares:
            known = F.col(f"{letter}{share}") - F.col(f"last_{letter}{share}_new")
            counters.append((known + own[share] * F.col(f"last_{letter}")).alias(f"{letter}{share}_count"))
    return summed.select(*keys, *counters, "last_seq", *carried)


def _compat_items(cells: DataFrame, question_point: DataFrame, paper_task: DataFrame, rows: int | None) -> DataFrame:
    """The merged items of each (user, sitting), with its task and customs: as ``report_items``, but the
    points are joined as one array a question, and the cells are brought together by sitting before
    they become items. Whoever aggregates items of a sitting moves none of them.

    The size of the cells tells little about that of their items, so with ``rows``, the number of cells
    or more, it sets the number of tasks."""
    points = question_point.groupBy(F.col("QuestionId").cast("bigint").alias("question_id")).agg(
        F.collect_set(F.col("PointId").cast("bigint")).alias("points")
    )
    tagged = with_tasks(_numbered(cells), paper_task).join(points, "question_id", "left")
    by = "testpaper_user_id"
    tagged = tagged.repartition(by) if rows is None else tagged.repartition(rows // CELLS_PER_TASK + 1, by)
    none = F.array(F.lit(None).cast("bigint"))
    every = F.explode(F.when(F.col("points").isNull(), none).otherwise(F.concat(none, "points"))).alias("point_id")
    items = tagged.select("*", every).withColumns(
        {"is_point": F.col("point_id").isNotNull(), "item_id": F.coalesce("point_id", "question_id")}
    )
    return merge_cells(items, [*PAPER, "task_id", "customs_id", "is_point", "item_id"])


def _clean_report(cells: DataFrame, question_point: DataFrame, keys: Sequence[str], *heads: Column) -> DataFrame:
    """Counts of distinct items per key. Only numbers are carried to the items, which are many times
    the cells: such rows are aggregated by hash, those with structs as places in the order of events by
    sorting. ``heads`` are aggregates of numbers that go with the items, so the cells are read once."""
    items = report_items(cells, question_point).groupBy(*keys, "is_point", "item_id")
    merged = items.agg(F.sum("right").alias("right"), F.sum("wrong").alias("wrong"), *heads)
    return merged.groupBy(*keys).agg(*_clean_counts(), *heads)


def paper_summary(
    cells: DataFrame, question_point: DataFrame, paper_task: DataFrame, mode: str = "clean", rows: int | None = None
) -> DataFrame:
    """Report per (user, sitting) with accuracy, TaskID and CustomsID.

    compat joins the tasks to the cells: rows partitioned by sitting are also partitioned
    for (user, sitting). ``rows`` is the number of cells or more, where it is known.
    """
    if mode == "clean":
        last = F.max("last_seq").alias("last_seq")
        if isinstance(cells.schema["last_seq"].dataType, StructType):
            heads = with_tasks(cells.groupBy(*PAPER).agg(last), paper_task)
            report = _clean_report(cells, question_point, PAPER).join(heads, list(PAPER))
        else:
            report = with_tasks(_clean_report(cells, question_point, PAPER, last), paper_task)
    else:
        items = _compat_items(cells, question_point, paper_task, rows)
        report = _with_places(_compat_report(items, PAPER, "task_id", "customs_id"), cells, PAPER)
    return report.select(
        *PAPER,
        *COUNTS,
        _accuracy(),
        positive(F.col("task_id")).alias("TaskID"),
        positive(F.col("customs_id")).alias("CustomsID"),
        "last_seq",
    )


def _accuracy() -> Column:
    return ratio(F.col("q_r_count"), F.col("q_count")).alias("accuracy")


def customs_summary(
    cells: DataFrame, question_point: DataFrame, paper_task: DataFrame, mode: str = "clean", rows: int | None = None
) -> DataFrame:
    """Report per (user, customs).

    compat adds the counters of the paper the last event belongs to, because the
    original never resets them between its two updates, and has no business ids.
    ``rows`` is the number of cells or more, where it is known.
    """
    if mode == "clean":
        tagged = with_tasks(cells, paper_task).filter(F.col("customs_id") > 0)
        heads = [F.min_by("task_id", "first_seq").alias("task_id"), F.max("last_seq").alias("last_seq")]
        if isinstance(cells.schema["last_seq"].dataType, StructType):
            report = _clean_report(tagged, question_point, CUSTOMS)
            report = report.join(tagged.groupBy(*CUSTOMS).agg(*heads), list(CUSTOMS))
        else:
            first = F.min("first_seq").alias("first_seq")
            report = _clean_report(tagged, question_point, CUSTOMS, first, *heads)
        return report.select(
            *CUSTOMS,
            *COUNTS,
            _accuracy(),
            positive(F.col("task_id")).alias("TaskID"),
            F.col("customs_id").alias("CustomsID"),
            "last_seq",
        )
    # Every item counts twice: for its sitting and, with no sitting named, for the customs as a whole.
    # One report over both scopes gives the customs' own counters and those of each sitting, of
    # which the last one's are carried over.
    item = ["is_point", "item_id"]
    sittings = _compat_items(cells, question_point, paper_task, rows).filter(F.col("customs_id") > 0)
    scope = F.explode(F.array(F.col("testpaper_user_id"), F.lit(None).cast("bigint"))).alias("scope")
    scoped = merge_cells(sittings.select("*", scope), [*CUSTOMS, "scope", *item])
    reports = _compat_report(scoped, [*CUSTOMS, "scope"])
    whole = F.col("scope").isNull()
    both = reports.groupBy(*CUSTOMS).agg(
        *[F.max(F.when(whole, F.col(c))).alias(c) for c in COUNTS],
        *[F.max_by(c, F.when(~whole, F.col("last_seq"))).alias(f"paper_{c}") for c in COUNTS],
        F.max("last_seq").alias("last_seq"),
    )
    summed = both.select(*CUSTOMS, *[(F.col(c) + F.col(f"paper_{c}")).alias(c) for c in COUNTS], "last_seq")
    summed = _with_places(summed, with_tasks(cells, paper_task).filter(F.col("customs_id") > 0), CUSTOMS)
    return summed.select(*CUSTOMS, *COUNTS, _accuracy(), "last_seq")


def counter_rows(cells: DataFrame, keys: Sequence[str], item: str, family: str) -> DataFrame:
    """compat cells as stored: the bare counter and the suffix cell of the first outcome.

    A question's suffix cell counts attempts with that outcome class; a point's stays 1.
    """
    wrong_first = F.col("first_right") == 0
    name = F.col(item).cast("string")
    suffix = F.concat(name, F.when(wrong_first, "_0").otherwise("_1"))
    if family == "q":
        suffix_count = F.when(wrong_first, F.col("wrong")).otherwise(F.col("attempts") - F.col("wrong"))
    else:
        suffix_count = F.lit(1).cast("bigint")
    pair = F.array(
        F.struct(name.alias("qualifier"), F.col("attempts").alias("n")),
        F.struct(suffix.alias("qualifier"), suffix_count.alias("n")),
    )
    return cells.select(
        join_key(*[F.col(k) for k in keys]).alias("rowkey"), F.lit(family).alias("family"), F.explode(pair).alias("c")
    ).select("rowkey", "family", "c.qualifier", count_text(F.col("c.n")).alias("value"))


def summary_rows(report: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A report as cells of the summary family, for the cell table; version = last event."""
    pairs = F.array(*[F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value")) for c in COUNTS])
    return report.select(
        join_key(*[F.col(k) for k in keys]).alias("rowkey"),
        F.lit("s").alias("family"),
        F.col("last_seq").alias("version"),
        F.explode(pairs).alias("c"),
    ).select("rowkey", "family", "c.qualifier", "version", "c.value")
