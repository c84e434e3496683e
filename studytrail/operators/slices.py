"""Cutting hot groups into ordered slices.

A window over one key runs in one task. When a single user, board or list holds
a large part of all rows that task never ends, so groups above a row limit are
cut into consecutive pieces along their sort order. The cut points come from a
bounded sample and enter the plan as one literal: a row's slice depends on its own
values only, so retried tasks and repeated scans always agree.

Callers compute per (group, slice) and then stitch the pieces; the number of
pieces is bounded by ``MAX_SLICES``: 10^12 rows give slices of 15 million.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SLICE = 1_000_000
# Where only some places are asked for, finer slices leave less to sort.
ROWS_PER_PAGE_SLICE = 50_000
MAX_SLICES = 65_536
SAMPLE_PER_SLICE = 20

SLICE = "__slice"


@dataclass(frozen=True)
class Slices:
    """Cut points of the hot groups, each a (keys..., order...) tuple of text, in sort order;
    ``hot`` are the keys of the cut groups, in the same order."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    types: dict[str, str]
    cuts: list[tuple[str | None, ...]]
    has_copies: bool = False
    hot: list[tuple[str | None, ...]] = field(default_factory=list)

    def is_split(self, names: Sequence[str]) -> Column:
        """True where rows that agree on ``names``, leading columns of the sort order,
        may lie in several slices: only values with a cut among them do."""
        if tuple(names) != (self.keys + self.order)[: len(names)]:
            raise ValueError(f"{names} do not lead the order")
        return self._is_one_of(names, dict.fromkeys(c[: len(names)] for c in self.cuts))

    def is_hot(self) -> Column:
        """True for rows whose group is cut."""
        return self._is_one_of(self.keys, self.hot) if self.keys else F.lit(True)

    def _table(self, names: Sequence[str], values: Sequence[Sequence[str | None]]) -> Column:
        """The values as an array of typed structs, from JSON text that is read once, when the
        query is planned; thousands of literals would take seconds each time."""
        places = [f"c{i}" for i in range(len(names))]
        text = json.dumps([dict(zip(places, v)) for v in values])
        raw = F.from_json(F.lit(text), "array<struct<%s>>" % ",".join(f"{p}:string" for p in places))
        return raw.cast("array<struct<%s>>" % ",".join(f"`{n}`:{self.types[n]}" for n in names))

    def _below(self, names: Sequence[str], values: Sequence[Sequence[str | None]], probe: Column) -> Column:
        """Number of the sorted values below the probe, by binary search."""
        table, count, step = self._table(names, values), len(values), 1
        while step * 2 <= count:
            step *= 2
        steps = []
        while step:
            steps.append(F.lit(step))
            step //= 2

        def search(place: Column) -> Column:
            def advance(pos: Column, width: Column) -> Column:
                below = F.get(table, pos + width - F.lit(1)) < place
                return F.when((pos + width <= F.lit(count)) & below, pos + width).otherwise(pos)

            return F.aggregate(F.array(*steps), F.lit(0), advance)

        # The one-element array binds the row's tuple once for all steps.
        return F.get(F.transform(F.array(probe), search), F.lit(0))

    def _probe(self, names: Sequence[str]) -> Column:
        return F.struct(*[F.col(f"`{n}`").alias(n) for n in names])

    def _is_one_of(self, names: Sequence[str], values: Iterable[Sequence[str | None]]) -> Column:
        """Lookup in a sorted set."""
        values, probe = list(values), self._probe(names)
        if not values:
            return F.lit(False)
        return F.get(self._table(names, values), self._below(names, values, probe)).eqNullSafe(probe)

    def index(self) -> Column:
        """Number of cut points below the row."""
        names = self.keys + self.order
        return self._below(names, self.cuts, self._probe(names))

    def column(self) -> Column:
        return F.when(self.is_hot(), self.index()).otherwise(F.lit(0))


def plan_slices(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    max_slices: int = MAX_SLICES,
    seed: int = 11,
    total: int | None = None,
) -> Slices | None:
    """Cut points for groups of ``keys`` that exceed the row limit, or None.

    Inputs no larger than one slice cost one count and no sample. Empty ``keys``
    treats the whole input as one group, which gives range buckets. ``total`` saves
    the count when the caller has it.
    """
    rows = df.select(*keys, *order)
    if total is None:
        total = rows.count()
    if total <= rows_per_slice:
        return None
    per_slice = max(rows_per_slice, -(-total // max_slices))
    fraction = min(1.0, SAMPLE_PER_SLICE / per_slice)
    every = max(1, round(per_slice * fraction))

    # At most about SAMPLE_PER_SLICE * max_slices rows reach these windows.
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    names = [*keys, *order]
    sample = rows.sample(withReplacement=False, fraction=fraction, seed=seed)
    ranked = sample.select(
        *names,
        F.row_number().over(group.orderBy(*order)).alias("__rn"),
        F.count(F.lit(1)).over(group).alias("__n"),
        F.count(F.lit(1)).over(Window.partitionBy(*names)).alias("__copies"),
    )
    picked = (
        ranked.filter((F.col("__n") > every) & (F.col("__rn") % every == 0))
        .groupBy(*names)
        .agg(F.max("__copies").alias("__copies"))
        .orderBy(*names)
        .select(*[F.col(n).cast("string").alias(n) for n in names], "__copies")
        .collect()
    )
    if not picked:
        return None
    cuts = [tuple(row[n] for n in names) for row in picked]
    hot = list(dict.fromkeys(c[: len(keys)] for c in cuts))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    copies = any(row["__copies"] > every for row in picked)
    return Slices(tuple(keys), tuple(order), types, cuts, copies, hot)


def with_slice(df: DataFrame, slices: Slices | None) -> DataFrame:
    return df.withColumn(SLICE, slices.column() if slices else F.lit(0))


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    page: tuple[int, int | None] | None = None,
    probes: DataFrame | None = None,
) -> DataFrame:
    """Add ``pos`` (0-based place in ascending order) and ``size`` of each group.

    Ordinary groups take one window. In a cut group the place is the place inside
    the slice plus the rows of the slices before it; that table of slice sizes has
    at most MAX_SLICES rows per cut group set and is broadcast for that reason.

    ``page`` (first and last place, negative from the end, None for the end) and ``probes``
    (keys and order columns of some rows) say which places are asked for. Slices of a cut
    group without any are counted, but neither shuffled nor sorted, and their rows left out.
    """
    slices = plan_slices(df, keys, order, rows_per_slice)
    part = Window.partitionBy(*keys, *([SLICE] if slices else []))
    sliced = with_slice(df, slices) if slices else df

    def places(rows: DataFrame) -> DataFrame:
        return rows.select(
            "*",
            (F.row_number().over(part.orderBy(*order)) - 1).cast("bigint").alias("pos"),
            F.count(F.lit(1)).over(part).alias("size"),
        )

    if slices is None:
        return places(sliced)
    over_slices = Window.partitionBy(*keys).orderBy(SLICE)
    sizes = (
        sliced.filter(slices.is_hot())
        .groupBy(*keys, SLICE)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            *[F.col(k).alias(f"__k_{k}") for k in keys],
            F.col(SLICE).alias("__k_slice"),
            F.coalesce(F.sum("__n").over(over_slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
            F.sum("__n").over(Window.partitionBy(*keys)).alias("__total"),
            "__n",
        )
    )

    def matches(k: str) -> Column:
        return F.col(k).eqNullSafe(F.col(f"__k_{k}"))

    match = reduce(Column.__and__, map(matches, keys), F.col(SLICE) == F.col("__k_slice"))
    if page is not None:
        first, last = page
        lo, hi = (F.lit(n) if n >= 0 else F.col("__total") + n for n in (first, -1 if last is None else last))
        sizes = sizes.filter((F.col("__before") <= hi) & (F.col("__before") + F.col("__n") > lo))
    if probes is not None:
        asked = with_slice(probes.select(*keys, *order), slices).select(*keys, SLICE).distinct()
        sizes = sizes.join(asked, match, "left_semi")
    joined = sliced.join(F.broadcast(sizes.drop("__n")), match, "left")
    if page is not None or probes is not None:
        joined = joined.filter(~slices.is_hot() | F.col("__before").isNotNull())
    return places(joined).select(
        *df.columns,
        (F.col("pos") + F.coalesce("__before", F.lit(0))).alias("pos"),
        F.coalesce("__total", "size").alias("size"),
    )


def in_positions(pos: Column, size: Column, start: int, end: int) -> Column:
    """Inclusive position range; negative numbers count from the end."""
    lo = F.lit(start) if start >= 0 else F.greatest(size + start, F.lit(0))
    hi = F.lit(end) if end >= 0 else size + end
    return (pos >= lo) & (pos <= hi)
