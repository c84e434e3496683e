"""Scan filters over wide-column cells (rowkey, family, qualifier, version, value).

Filters on single cells are plain column predicates, so they reach the parquet scan.
Filters on whole rows first find the few deciding cells and join back by row key;
whether that side is broadcast is left to its measured size.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studytrail.functions.keys import between_keys
from studytrail.functions.predicates import Comparator, test
from studytrail.operators.slices import ROWS_PER_SLICE, ranked

CELL = ("rowkey", "family", "qualifier")
COLUMNS = (*CELL, "version", "value")


def latest(cells: DataFrame) -> DataFrame:
    """The newest version of every cell."""
    return cells.groupBy(*CELL).agg(
        F.max("version").alias("version"), F.max_by("value", "version").alias("value")
    )


# Keys that are looked up by a filter of the scan; more of them meet the cells in a join.
MOST_KEYS = 1000


def get_rows(cells: DataFrame, keys: DataFrame | Sequence[str]) -> DataFrame:
    """Cells of the given row keys. Up to MOST_KEYS reach the scan as a filter, where the bounds and the
    bloom filters of a stored cell table leave out row groups; a table of more keys is joined, and
    its least and greatest key bound the scan."""
    if not isinstance(keys, DataFrame):
        return cells.filter(F.col("rowkey").isin(list(keys)))
    distinct = keys.select("rowkey").filter("rowkey is not null").distinct()
    few = [r.rowkey for r in distinct.limit(MOST_KEYS + 1).collect()]
    if len(few) <= MOST_KEYS:
        return cells.filter(F.col("rowkey").isin(few))
    low, high = distinct.agg(F.min("rowkey"), F.max("rowkey")).first()
    return cells.filter(F.col("rowkey").between(low, high)).join(distinct, "rowkey", "left_semi")


def scan_family(cells: DataFrame, family: str, qualifier: str | None = None) -> DataFrame:
    """All cells of a family, or one column of it."""
    picked = cells.filter(F.col("family") == family)
    return picked if qualifier is None else picked.filter(F.col("qualifier") == qualifier)


def column_as_field(cells: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per key with the listed (family, qualifier) columns as fields ``family_qualifier``."""
    wanted = [(F.col("family") == f) & (F.col("qualifier") == q) for f, q in columns]
    return (
        cells.filter(reduce(Column.__or__, wanted))
        .groupBy("rowkey")
        .agg(*[F.max(F.when(w, F.col("value"))).alias(f"{f}_{q}") for w, (f, q) in zip(wanted, columns)])
    )


# Filters on single cells


def family_filter(cells: DataFrame, op: str, comparator: Comparator) -> DataFrame:
    return cells.filter(test(F.col("family"), op, comparator))


def qualifier_filter(cells: DataFrame, op: str, comparator: Comparator) -> DataFrame:
    return cells.filter(test(F.col("qualifier"), op, comparator))


def row_filter(cells: DataFrame, op: str, comparator: Comparator) -> DataFrame:
    return cells.filter(test(F.col("rowkey"), op, comparator))


def value_filter(cells: DataFrame, op: str, comparator: Comparator) -> DataFrame:
    return cells.filter(test(F.col("value"), op, comparator))


def prefix_filter(cells: DataFrame, prefix: str) -> DataFrame:
    return cells.filter(F.col("rowkey").startswith(prefix))


def row_regex(cells: DataFrame, pattern: str) -> DataFrame:
    """Rows whose key contains the pattern (the original filter finds, it does not anchor)."""
    return cells.filter(F.col("rowkey").rlike(pattern))


def suffix_filter(cells: DataFrame, suffix: str) -> DataFrame:
    return cells.filter(F.col("rowkey").endswith(suffix))


def column_prefix(cells: DataFrame, *prefixes: str) -> DataFrame:
    return cells.filter(reduce(Column.__or__, [F.col("qualifier").startswith(p) for p in prefixes]))


def column_range(
    cells: DataFrame,
    low: str | None,
    high: str | None,
    low_inclusive: bool = True,
    high_inclusive: bool = True,
) -> DataFrame:
    q, keep = F.col("qualifier"), F.lit(True)
    if low is not None:
        keep = keep & (q >= low if low_inclusive else q > low)
    if high is not None:
        keep = keep & (q <= high if high_inclusive else q < high)
    return cells.filter(keep)


def fuzzy_row(cells: DataFrame, pattern: str, mask: Sequence[int]) -> DataFrame:
    """Rows whose key agrees with the pattern where the mask is 0 (longer keys match too). The part
    before the first free place bounds the keys that are read."""
    if len(pattern) != len(mask):
        raise ValueError("pattern and mask differ in length")
    body = "".join("." if free else re.escape(ch) for ch, free in zip(pattern, mask))
    fixed = pattern[: next((i for i, free in enumerate(mask) if free), len(pattern))]
    return cells.filter(between_keys(F.col("rowkey"), fixed) & F.col("rowkey").rlike("(?s)^" + body))


def inclusive_stop(cells: DataFrame, stop: str) -> DataFrame:
    return cells.filter(F.col("rowkey") <= stop)


def timestamps(cells: DataFrame, versions: Sequence[int]) -> DataFrame:
    return cells.filter(F.col("version").isin(list(versions)))


def key_only(cells: DataFrame, length_as_value: bool = False) -> DataFrame:
    """Values dropped, or replaced by their length in bytes."""
    value = F.octet_length("value").cast("string") if length_as_value else F.lit("")
    return cells.withColumn("value", value)


def random_rows(cells: DataFrame, chance: float, seed: int) -> DataFrame:
    """Each row with the given chance; all cells of a row stay together."""
    return cells.filter(hashed_unit(F.col("rowkey"), seed) < chance)


def hashed_unit(text: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the seed and the text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), text))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def any_of(cells: DataFrame, *predicates: Column) -> DataFrame:
    return cells.filter(reduce(Column.__or__, predicates))


def all_of(cells: DataFrame, *predicates: Column) -> DataFrame:
    return cells.filter(reduce(Column.__and__, predicates))


# Filters on the order of cells inside a row


def column_page(
    cells: DataFrame,
    limit: int,
    offset: int = 0,
    family: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Cells offset+1 .. offset+limit of every row, in (family, qualifier) order.

    Small pages keep that many cells per task and row before the shuffle; larger
    ones use places from ``ranked``, which copes with rows of very many columns.
    """
    picked = cells if family is None else scan_family(cells, family)
    if offset + limit <= 1000:
        w = Window.partitionBy("rowkey").orderBy("family", "qualifier")
        placed = picked.withColumn("__place", F.row_number().over(w))
        page = (F.col("__place") <= offset + limit) & (F.col("__place") > offset)
    else:
        placed = ranked(picked, ["rowkey"], ["family", "qualifier"], rows_per_slice)
        page = (F.col("pos") < offset + limit) & (F.col("pos") >= offset)
    return placed.filter(page).select(*cells.columns)


def column_count(cells: DataFrame, n: int, rowkey: str | None = None) -> DataFrame:
    """The first n cells of one row, or of every row."""
    return column_page(cells if rowkey is None else get_rows(cells, [rowkey]), n)


def first_key_only(cells: DataFrame) -> DataFrame:
    return column_page(cells, 1)


# Filters on whole rows


@dataclass(frozen=True)
class ColumnTest:
    """A test on one column of a row; rows without the column pass."""

    family: str
    qualifier: str
    op: str
    comparator: Comparator

    def here(self) -> Column:
        return (F.col("family") == self.family) & (F.col("qualifier") == self.qualifier)

    def holds(self) -> Column:
        return test(F.col("value"), self.op, self.comparator)


def row_tests(cells: DataFrame, tests: Sequence[ColumnTest], any_pass: bool = False) -> DataFrame:
    """Rows that pass all tests, or at least one. Only tested cells reach the aggregate."""
    tested = cells.filter(reduce(Column.__or__, [t.here() for t in tests]))
    fails = [
        F.coalesce(F.max(F.when(t.here(), ~t.holds())), F.lit(False)).alias(f"f{i}") for i, t in enumerate(tests)
    ]
    verdict = tested.groupBy("rowkey").agg(*fails)
    flags = [F.col(f"f{i}") for i in range(len(tests))]
    dropped = verdict.filter(reduce(Column.__and__ if any_pass else Column.__or__, flags))
    return cells.join(dropped.select("rowkey"), "rowkey", "left_anti")


def single_column_value(
    cells: DataFrame, family: str, qualifier: str, op: str, comparator: Comparator, exclude: bool = False
) -> DataFrame:
    """Rows whose column passes or is absent; ``exclude`` leaves the tested column out."""
    column = ColumnTest(family, qualifier, op, comparator)
    failing = cells.filter(column.here() & ~column.holds()).select("rowkey")
    kept = cells.join(failing, "rowkey", "left_anti")
    return kept.filter(~column.here()) if exclude else kept


def dependent_column(
    cells: DataFrame,
    family: str,
    qualifier: str,
    drop: bool = False,
    op: str | None = None,
    comparator: Comparator | None = None,
) -> DataFrame:
    """Cells with the same version as the row's reference cell, if that exists and passes."""
    here = (F.col("family") == family) & (F.col("qualifier") == qualifier)
    reference = cells.filter(here)
    if op is not None:
        reference = reference.filter(test(F.col("value"), op, comparator))
    kept = cells.join(reference.select("rowkey", "version"), ["rowkey", "version"], "left_semi")
    return kept.filter(~here) if drop else kept


def skip_rows(cells: DataFrame, keep: Column) -> DataFrame:
    """Rows all of whose cells satisfy ``keep``."""
    failing = cells.filter(~keep).select("rowkey").distinct()
    return cells.join(failing, "rowkey", "left_anti")


def while_match(cells: DataFrame, keep: Column) -> DataFrame:
    """Cells before the first failing one in scan order.

    The first failing cell is one value (a scalar subquery), so the second scan is
    a plain filter.
    """
    place = F.struct(*CELL)
    stop = cells.filter(~keep).agg(F.min(F.struct(*CELL)).alias("stop")).scalar()
    return cells.filter(F.coalesce(place < stop, F.lit(True)))


def first_rows(cells: DataFrame, n: int) -> DataFrame:
    """All cells of the first n row keys."""
    keys = cells.select("rowkey").distinct().orderBy("rowkey").limit(n)
    return cells.join(keys, "rowkey", "left_semi")


# Changes


def put(cells: DataFrame, changes: DataFrame) -> DataFrame:
    """Current cells after the changes: per cell the highest version wins, a change on a tie."""
    old = cells.select(*COLUMNS, F.lit(0).alias("__new"))
    new = changes.select(*COLUMNS, F.lit(1).alias("__new"))
    order = F.struct("version", "__new")
    return (
        old.unionByName(new)
        .groupBy(*CELL)
        .agg(F.max("version").alias("version"), F.max_by("value", order).alias("value"))
    )


def delete_newest(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """All versions but the newest one of each target cell (older ones show again). The join and
    the window share one exchange of the cells."""
    marked = cells.join(targets.select(*CELL, F.lit(True).alias("__target")).distinct(), list(CELL), "left")
    whole = Window.partitionBy(*CELL).orderBy(*CELL).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    newest = marked.withColumn("__newest", F.max("version").over(whole))
    kept = F.col("__target").isNull() | (F.col("version") < F.col("__newest"))
    return newest.filter(kept).select(*cells.columns)

