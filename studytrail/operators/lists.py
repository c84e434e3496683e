"""Lists as rows (key, pos, value); ``pos`` orders a list and may have gaps.

Places are computed with ``ranked``, so a list of any length is cut into slices.
Results carry ``idx``, the place from 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studytrail.operators.slices import ROWS_PER_PAGE_SLICE, ROWS_PER_SLICE, in_positions, ranked

ITEM = ("key", "pos", "value")


def _placed(lists: DataFrame, page: tuple[int, int], rows_per_slice: int) -> DataFrame:
    """Items with their place; of a long list only the slices that the page falls into."""
    rows = lists.select("key", F.col("pos").alias("at"), "value")
    return ranked(rows, ["key"], ["at"], rows_per_slice, page=page).withColumnsRenamed({"pos": "idx", "at": "pos"})


def list_range(lists: DataFrame, start: int, end: int, rows_per_slice: int = ROWS_PER_PAGE_SLICE) -> DataFrame:
    """Items start..end (inclusive, negative from the end) of every list."""
    placed = _placed(lists, (start, end), rows_per_slice)
    return placed.filter(in_positions(F.col("idx"), F.col("size"), start, end)).select("key", "idx", "value")


def list_index(lists: DataFrame, index: int, rows_per_slice: int = ROWS_PER_PAGE_SLICE) -> DataFrame:
    """The item at one place; lists that are too short give no row."""
    placed = _placed(lists, (index, index), rows_per_slice)
    want = F.lit(index) if index >= 0 else F.col("size") + index
    return placed.filter(F.col("idx") == want).select("key", "idx", "value")


def list_length(lists: DataFrame) -> DataFrame:
    return lists.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def list_trim(lists: DataFrame, start: int, end: int, rows_per_slice: int = ROWS_PER_PAGE_SLICE) -> DataFrame:
    """Lists cut to the position range, keeping their ``pos``."""
    placed = _placed(lists, (start, end), rows_per_slice)
    return placed.filter(in_positions(F.col("idx"), F.col("size"), start, end)).select(*ITEM)


def list_remove(lists: DataFrame, count: int, value: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Drop matching items: the first ``count``, the last ``-count``, or all when 0."""
    if count == 0:
        return lists.filter(~F.col("value").eqNullSafe(F.lit(value)))
    hits = lists.filter(F.col("value") == value).select("key", "pos")
    n = abs(count)
    if n <= 1000:
        w = Window.partitionBy("key").orderBy("pos" if count > 0 else F.desc("pos"))
        gone = hits.withColumn("__place", F.row_number().over(w)).filter(F.col("__place") <= n)
    else:
        placed = ranked(hits.withColumnRenamed("pos", "at"), ["key"], ["at"], rows_per_slice)
        limit = F.col("pos") < n if count > 0 else F.col("pos") >= F.col("size") - n
        gone = placed.filter(limit).select("key", F.col("at").alias("pos"))
    return lists.join(gone.select("key", "pos"), ["key", "pos"], "left_anti").select(*lists.columns)


def list_sort(
    lists: DataFrame,
    desc: bool = False,
    offset: int = 0,
    count: int | None = None,
    rows_per_slice: int = ROWS_PER_PAGE_SLICE,
    alpha: bool = False,
) -> DataFrame:
    """Every list sorted by value, optionally a page of it; ``idx`` is the sorted place.

    Values are compared as numbers (equal ones as text, then by pos), values that are no number
    come first; ``alpha`` compares them as text."""
    rows = lists.select("key", F.col("pos").alias("at"), "value")
    order = ["value", "at"]
    if not alpha:
        rows = rows.withColumn("number", F.col("value").try_cast("double"))
        order = ["number", *order]
    last = None if count is None else offset + count - 1
    page = (offset, last) if not desc else (0 if last is None else -1 - last, -1 - offset)
    placed = ranked(rows, ["key"], order, rows_per_slice, page=page).withColumnRenamed("pos", "idx")
    idx = F.col("size") - 1 - F.col("idx") if desc else F.col("idx")
    keep = idx >= offset
    if count is not None:
        keep = keep & (idx < offset + count)
    return placed.filter(keep).select("key", idx.alias("idx"), "value")
