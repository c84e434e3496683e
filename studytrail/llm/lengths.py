"""Exact length histogram of a corpus and what follows from its suffix sums.

The histogram has a row per distinct encoded length. With the documents and tokens at or
above each length it answers, for any context limit L without reading the corpus again:
tokens in all, documents cut by L, tokens left after cutting at L, and every quantile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Lengths of one window; the sums of whole ranges are added from a table of ranges.
RANGE = 4096


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs) from (n_tokens); null lengths count as zero."""
    return lengths.groupBy(F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens")).agg(
        F.count(F.lit(1)).alias("n_docs")
    )


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per distinct length: n_tokens, n_docs, docs_from and tokens_from (documents at least this
    long and their tokens), docs_below, cut_total (tokens of the corpus with every document cut
    at this length), quantile_ppm (documents up to this length per million, rounded down).

    Lengths are summed within ranges of ``RANGE`` and then over the ranges, so no window holds
    all lengths; the table of ranges has a row per 4096 tokens of the longest document."""
    part = F.floor(F.col("n_tokens") / RANGE).alias("part")
    rows = hist.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("part", part)
    down = Window.partitionBy("part").orderBy(F.desc("n_tokens"))
    local = rows.select(
        "part", "n_tokens", "n_docs", F.sum("n_docs").over(down).alias("docs_in"), F.sum("tokens").over(down).alias("tokens_in")
    )
    sums = rows.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranges = sums.select(
        "part",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(everything).alias("all_docs"),
        F.sum("t").over(everything).alias("all_tokens"),
    )
    docs_from = F.col("docs_in") + F.col("docs_above")
    tokens_from = F.col("tokens_in") + F.col("tokens_above")
    below = F.col("all_docs") - docs_from
    return local.join(ranges, "part").select(
        "n_tokens",
        "n_docs",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        below.alias("docs_below"),
        (F.col("all_tokens") - tokens_from + F.col("n_tokens") * docs_from).alias("cut_total"),
        F.call_function("div", (below + F.col("n_docs")) * 1_000_000, F.col("all_docs")).alias("quantile_ppm"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> dict[int, dict[str, int]]:
    """Per limit: docs_over (documents longer than it), tokens_left after every document is cut
    there, and tokens_lost. One pass over the sums answers all limits."""
    found = [
        F.min(F.when(F.col("n_tokens") > limit, F.struct("n_tokens", "docs_from", "tokens_from"))).alias(str(limit))
        for limit in limits
    ]
    row = sums.agg(F.max("tokens_from").alias("total"), *found).first()
    out = {}
    for limit in limits:
        over, tokens = (row[str(limit)]["docs_from"], row[str(limit)]["tokens_from"]) if row[str(limit)] else (0, 0)
        lost = tokens - over * limit
        out[limit] = {"docs_over": over, "tokens_left": (row["total"] or 0) - lost, "tokens_lost": lost}
    return out


def quantile(sums: DataFrame, share: float) -> int | None:
    """The least length that at least this share of the documents does not exceed; None for an
    empty corpus."""
    return sums.filter(F.col("quantile_ppm") >= int(share * 1_000_000)).agg(F.min("n_tokens")).first()[0]
