"""Positions in a topic: where to resume, what a batch covered, what was applied.

What was applied is a set of disjoint offset intervals per partition, merged by bucket of offsets.
A source that keeps the order of offsets has one interval a partition; one that does not (files
in any order) has as many as there are gaps, and a late record fills its gap and counts once.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from studytrail.streaming.batches import BatchFolder
from studytrail.streaming.commits import Batch, CommitLog

PLACE = ("topic", "partition")
BOUNDS = ("from_offset", "until_offset")
# ``own`` rows are what a batch covered, the others all that was applied after it.
POSITION_SCHEMA = (
    "generation int, batch long, topic string, partition int, from_offset long, until_offset long, own boolean"
)
# Offsets that meet the intervals under one key.
BUCKET = 1 << 16


def resume_offsets(saved: Mapping[int, int], earliest: Mapping[int, int]) -> dict[int, int]:
    """Start offset per partition: the saved one, raised to the earliest still kept.

    A partition without a saved offset starts at its earliest (it is not left out).
    """
    return {p: max(saved.get(p, first), first) for p, first in earliest.items()} | {
        p: o for p, o in saved.items() if p not in earliest
    }


def starting_offsets(topic: str, offsets: Mapping[int, int]) -> str:
    """The JSON the topic source takes as ``startingOffsets``."""
    return json.dumps({topic: {str(p): int(o) for p, o in sorted(offsets.items())}})


def batch_ranges(records: DataFrame) -> DataFrame:
    """Offsets covered by the records of a source that keeps their order: [from_offset,
    until_offset) per partition."""
    return records.groupBy(*PLACE).agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def _bucket(offset) -> F.Column:
    return F.floor(offset / BUCKET).cast("bigint")


def intervals_of(records: DataFrame, ordered: bool = False) -> DataFrame:
    """Disjoint intervals [from_offset, until_offset) per partition that hold the records' offsets
    and, unless the source is ``ordered``, no others."""
    if ordered:
        return batch_ranges(records)
    offset = F.col("offset").cast("bigint")
    points = records.filter(offset.isNotNull()).select(*PLACE, offset.alias("from_offset"), (offset + 1).alias("until_offset"))
    return merged(points)


def _cut(intervals: DataFrame) -> DataFrame:
    """Intervals cut at the borders of buckets."""
    bucket = F.col("__bucket")
    buckets = F.sequence(_bucket(F.col("from_offset")), _bucket(F.col("until_offset") - 1))
    return intervals.select(*PLACE, *BOUNDS, F.explode(buckets).alias("__bucket")).select(
        *PLACE, "__bucket",
        F.greatest("from_offset", bucket * BUCKET).alias("from_offset"),
        F.least("until_offset", (bucket + 1) * BUCKET).alias("until_offset"),
    )


def _joined(intervals: DataFrame, *keys: str) -> DataFrame:
    """The union of each group's intervals as disjoint ones, neighbours joined, by one window a group."""
    order = Window.partitionBy(*keys).orderBy(*BOUNDS)
    reach = F.max("until_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("from_offset") > reach, F.lit(True)).cast("int")
    numbered = intervals.select(*keys, *BOUNDS, opens.alias("__opens")).withColumn("__run", F.sum("__opens").over(order))
    return numbered.groupBy(*keys, "__run").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")
    ).drop("__run")


def merged(intervals: DataFrame, ordered: bool = False) -> DataFrame:
    """The union of intervals as disjoint ones, neighbours joined.

    They are joined inside buckets first. What touches no border of its bucket is done; the others,
    at most two a bucket, are joined by partition. An ``ordered`` source has few intervals, however
    long, and goes without buckets."""
    if ordered:
        return _joined(intervals.select(*PLACE, *BOUNDS), *PLACE)
    local = _joined(_cut(intervals), *PLACE, "__bucket")
    start = F.col("__bucket") * BUCKET
    at_border = (F.col("from_offset") == start) | (F.col("until_offset") == start + BUCKET)
    inside, edges = [local.filter(which).select(*PLACE, *BOUNDS) for which in (~at_border, at_border)]
    return inside.union(_joined(edges, *PLACE))


def _near(records: DataFrame, applied: DataFrame) -> DataFrame:
    """The parts of intervals that lie among the records' offsets, cut into buckets."""
    seen = records.groupBy(F.col("topic").alias("__t"), F.col("partition").alias("__p")).agg(
        F.min("offset").alias("__lo"), (F.max("offset") + 1).alias("__end")
    )
    here = F.col("topic").eqNullSafe(F.col("__t")) & (F.col("partition") == F.col("__p"))
    # One row a partition.
    near = applied.join(F.broadcast(seen), here & (F.col("from_offset") < F.col("__end")) & (F.col("until_offset") > F.col("__lo")))
    return _cut(
        near.select(*PLACE, F.greatest("from_offset", "__lo").alias("from_offset"), F.least("until_offset", "__end").alias("until_offset"))
    )


def told_apart(records: DataFrame, applied: DataFrame, ordered: bool = False) -> DataFrame:
    """Records with ``is_new``, whether no applied interval holds their offset, one of each position,
    and ``is_again``, whether one does.

    Records and intervals are sorted together inside buckets, so a record meets the interval that
    starts last before it, not all of its bucket. A source that never repeats a position inside a
    batch (``ordered``: a topic) has few intervals, and its records are joined to them."""
    at, near = F.col("offset").cast("bigint"), _near(records, applied)
    if ordered:
        spread = near.select(F.col("topic").alias("__t"), F.col("partition").alias("__p"), F.col("__bucket").alias("__b"), *BOUNDS)
        same = (
            F.col("topic").eqNullSafe(F.col("__t"))
            & (F.col("partition") == F.col("__p"))
            & (_bucket(at) == F.col("__b"))
            & (at >= F.col("from_offset"))
            & (at < F.col("until_offset"))
        )
        held = F.col("__b").isNotNull()
        return records.join(spread, same, "left").select(*records.columns, (~held).alias("is_new"), held.alias("is_again"))
    starts = near.select(*PLACE, "__bucket", F.col("from_offset").alias("__at"), F.col("until_offset").alias("__until"), F.lit(False).alias("__record"))
    rows = records.withColumns({"__bucket": _bucket(at), "__at": at, "__record": F.lit(True)})
    order = Window.partitionBy(*PLACE, "__bucket").orderBy("__at", "__record")
    reach = F.max("__until").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = F.coalesce(reach > F.col("__at"), F.lit(False))
    repeats = F.coalesce(F.lag("__record").over(order), F.lit(False)) & F.lag("__at").over(order).eqNullSafe(F.col("__at"))
    both = rows.unionByName(starts, allowMissingColumns=True).withColumns({"__held": held, "__repeats": repeats})
    return both.filter("__record").select(
        *records.columns, (~F.col("__held") & ~F.col("__repeats")).alias("is_new"), F.col("__held").alias("is_again")
    )


def unseen(records: DataFrame, applied: DataFrame, ordered: bool = False) -> DataFrame:
    """Records at offsets that no applied interval holds, each position once."""
    return told_apart(records, applied, ordered).filter("is_new").select(*records.columns)


def passed_over(records: DataFrame, applied: DataFrame, ordered: bool = False) -> DataFrame:
    """Records at positions that were applied before."""
    return told_apart(records, applied, ordered).filter("is_again").select(*records.columns)


class Positions:
    """Applied positions kept with the results; each recorded batch stores what it covered, for
    good, and all that was applied after it."""

    def __init__(self, spark: SparkSession, root: str, commits: CommitLog):
        self.commits = commits
        self.folder = BatchFolder(spark, root, commits)

    def after(self, batches: Sequence[Batch], ordered: bool = False) -> DataFrame:
        """The intervals applied after the given batches, one of each generation: what a batch knows
        to be applied includes all that came before it."""
        if all(self.folder.has(b) for b in batches):
            rows = self.folder.read_some(batches, POSITION_SCHEMA)
        else:
            rows = self.folder.read(POSITION_SCHEMA)
        known = F.lit(False)
        for g, n in batches:
            known = known | ((F.col("generation") == g) & (F.col("batch") == n))
        rows = rows.filter(known & ~F.col("own")).select(*PLACE, *BOUNDS)
        return rows if len(batches) == 1 else merged(rows, ordered)

    def applied(self) -> DataFrame:
        """All intervals applied so far."""
        return self.after(self.commits.last_of_each())

    def resume(self) -> DataFrame:
        """(topic, partition, offset): the first offset of each partition that is not applied behind
        the first one that is."""
        return self.applied().groupBy(*PLACE).agg(F.min_by("until_offset", "from_offset").alias("offset"))

    def all_ranges(self) -> DataFrame:
        """What every batch of every generation covered, replays included."""
        return self.folder.read(POSITION_SCHEMA).filter("own").drop("own")

    def ranges(self, batch: Batch) -> DataFrame:
        own = (F.col("generation") == batch[0]) & (F.col("batch") == batch[1])
        return self.all_ranges().filter(own).select(*PLACE, *BOUNDS)

    def write(self, batch: Batch, records: DataFrame, applied: DataFrame, ordered: bool = False) -> None:
        covered = intervals_of(records, ordered).select(*PLACE, *BOUNDS).persist()
        named = [F.lit(batch[0]).cast("int").alias("generation"), F.lit(batch[1]).cast("bigint").alias("batch"), *PLACE, *BOUNDS]
        own = covered.select(*named, F.lit(True).alias("own"))
        total = merged(covered.union(applied.select(*PLACE, *BOUNDS)), ordered).select(*named, F.lit(False).alias("own"))
        rows = own.union(total)
        try:
            # Intervals of an unordered source may be as many as its records.
            self.folder.write(rows.coalesce(1) if ordered else rows, batch)
        finally:
            covered.unpersist()

    def check(self, batch: Batch, records: DataFrame, ordered: bool = False) -> None:
        """A recorded batch that comes again has to cover the same offsets."""
        now = intervals_of(records, ordered).select(*PLACE, *BOUNDS)
        then = self.ranges(batch)
        if not (now.exceptAll(then).isEmpty() and then.exceptAll(now).isEmpty()):
            raise ValueError(f"batch {batch} covered other offsets before")

    def compact(self, before: Batch | None = None, ordered: bool = False) -> None:
        def merge(rows: DataFrame) -> DataFrame:
            last = rows.groupBy("generation").agg(F.max("batch").alias("__last"))
            kept = rows.join(F.broadcast(last), "generation").filter(F.col("own") | (F.col("batch") == F.col("__last")))
            kept = kept.drop("__last").select(*rows.columns)
            return kept.coalesce(1) if ordered else kept

        self.folder.compact(merge, POSITION_SCHEMA, before)
