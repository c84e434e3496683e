"""Mixing sources to target weights by Poisson replication.

A source that should have ``rate`` times its rows gets each document a Poisson(rate) number
of times: a hash of seed and doc_id gives a uniform number, and the inverse of the
distribution function turns it into the count. The draw depends on the document alone, so a
retried task or another partitioning gives the same sample, and no row waits for another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studytrail.llm.common import kept, packed

SEED = 8
# Sources whose rates are sent to every task; beyond this the rates are joined by a shuffle.
SMALL = 20_000
# Up to this rate the whole table of the distribution function is kept with the rate; beyond it,
# the part around the rate. Rates of a caller above it are refused.
MOST_RATE = 500.0


def uniform(seed: int, *columns: str) -> Column:
    """A number in [0, 1) with 52 bits from a digest of the seed and the columns."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, power: float = 0.5, expected: float = 1.0) -> DataFrame:
    """(source, rate): target weight size^power per source, ``expected`` copies a row on
    average. Documents without a source are a source of their own."""
    sizes = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.sum("n").alias("all_n"), F.sum(F.pow("n", F.lit(power))).alias("all_w")).first()
    return sizes.select(
        "source",
        rate_of(F.col("n"), row["all_n"], row["all_w"], power, expected).alias("rate"),
    )


def rate_of(n: Column, all_n: int | None, all_w: float | None, power: float, expected: float) -> Column:
    return F.round(F.lit(expected * (all_n or 0) / (all_w or 1.0)) * F.pow(n, F.lit(power)) / n, 9)


def cumulative(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... to where the rest is below the uniform's resolution."""
    upto = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        p = acc.p * rate / k
        return F.struct(p.alias("p"), (acc.c + p).alias("c"), F.concat(acc["all"], F.array(acc.c + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), upto), start, step, lambda acc: acc["all"])


def lowest(rate: Column) -> Column:
    """The count that ``around`` begins with; what lies below it is below the uniform's resolution."""
    return (F.floor(rate) - F.ceil(12 * F.sqrt(rate) + 30)).cast("bigint")


def around(rate: Column) -> Column:
    """P(count <= k) for k = lowest(rate), ... to as far above the rate, for rates above MOST_RATE.

    exp(-rate) leaves the range of doubles at 745, so the terms are relative to the first one and
    divided by their sum."""
    first, upto = lowest(rate), (F.floor(rate) + F.ceil(12 * F.sqrt(rate) + 30)).cast("bigint")
    one = F.lit(1.0)
    start = F.struct(one.alias("p"), one.alias("c"), F.array(one).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        p = acc.p * rate / k
        return F.struct(p.alias("p"), (acc.c + p).alias("c"), F.concat(acc["all"], F.array(acc.c + p)).alias("all"))

    return F.aggregate(F.sequence(first + 1, upto), start, step, lambda acc: F.transform(acc["all"], lambda c: c / acc.c))


def replicated(docs: DataFrame, rates: DataFrame, seed: int = SEED, most: float | None = MOST_RATE) -> DataFrame:
    """(row, copy): the columns of ``docs`` and 0, 1, ..., each row as often as its draw says.

    A source without a rate, or with rate null or below zero, is left out; so is every row of a
    source of rate zero. Rates above ``most`` are an error, None allows any. Repeated rows draw the
    same number, and rows without doc_id one common number per source."""
    if most is not None and not rates.filter(F.col("rate") > most).isEmpty():
        raise ValueError(f"a rate is above {most}")
    rate = F.col("rate")
    table = rates.filter("rate > 0").select(
        F.coalesce("source", F.lit("")).alias("source"),
        F.when(rate <= MOST_RATE, F.lit(0)).otherwise(lowest(rate)).alias("least"),
        F.when(rate <= MOST_RATE, cumulative(rate)).otherwise(around(rate)).alias("cdf"),
    )
    if table.count() <= SMALL:
        table = F.broadcast(table)
    rows = packed(docs).withColumn("source", F.coalesce("row.source", F.lit("")))
    drawn = rows.join(table, "source").withColumn("u", uniform(seed, "row.doc_id"))
    below = F.size(F.filter("cdf", lambda c: c <= F.col("u")))
    counted = drawn.select("row", (F.col("least") + below).cast("int").alias("n")).filter("n > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))


def shuffled(copies: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows in an order of their own draw: dealt to partitions by the hash of (seed, doc_id,
    copy) and sorted by it there, so copies of one document do not stand together."""
    key = F.xxhash64(F.lit(seed), F.col("row.doc_id"), F.col("copy"), F.xxhash64("row.text"))
    return copies.withColumn("place", key).repartition("place").sortWithinPartitions("place").drop("place")


def mixed(docs: DataFrame, rates: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """(row, copy) of ``docs`` replicated and shuffled; by default each source weighs as the
    square root of its size, whatever rate that gives a small source. An empty table gives an
    empty result."""
    if rates is None:
        return shuffled(replicated(docs, kept(source_rates(docs), "rates"), seed, most=None), seed)
    return shuffled(replicated(docs, rates, seed), seed)
