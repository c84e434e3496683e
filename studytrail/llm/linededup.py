"""Lines that many documents share, counted in levelled sorted runs of line hashes.

A batch of documents becomes one run: a row per line key with the number of its documents,
hash-partitioned and sorted by key. The keys of a new batch are merge-anti-joined with the runs
of keys that are known to be shared; the others are merged with the runs of counts, and those
that come to ``min_docs`` documents go to the shared keys, the rest into a run of the batch.
``FANOUT`` runs of a level are merged into one run of the next, without the keys that became
shared, so a key lies in few runs however many batches came. Lines are dropped after the last
batch: a line goes from every document, also from those that came before it was frequent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.llm.common import ascii_lower, scratch, stripped, whole
from studytrail.runtime import drop_folder

MIN_DOCS = 10
MIN_CHARS = 1
FANOUT = 4
BATCHES = 5

KEY = ("h1", "h2")
RUN_SCHEMA = "h1 long, h2 long, n_docs long"


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, pos, h1, h2) of every line whose key has ``min_chars`` code points or more.

    The key is the line without white space at its ends and with A-Z lowered; it is known by
    two 64-bit hashes, so that even 10^12 different lines do not meet by chance."""
    key = lambda x: ascii_lower(stripped(x))
    known = lambda k: F.when(
        F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))
    )
    keys = F.transform(F.transform(lines(whole("text")), key), known)
    rows = docs.select("doc_id", F.posexplode(keys).alias("pos", "k")).filter("k is not null")
    return rows.select("doc_id", "pos", "k.h1", "k.h2")


class LineRuns:
    """Runs of one corpus under a folder that all executors share. With ``min_docs``, keys in so many
    documents are settled: they go to runs of their own and are no longer counted."""

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = FANOUT, min_docs: int | None = None):
        self.spark = spark
        self.root = root or scratch(spark, "line-runs")
        self.fanout = fanout
        self.min_docs = min_docs
        self.levels: list[list[str]] = [[]]
        self.settled: list[str] = []
        self.made = 0

    def _write(self, counts: DataFrame, level: int) -> None:
        path = f"{self.root}/level-{level}/run-{self.made}"
        self.made += 1
        counts.select("h1", "h2", F.col("n_docs").cast("bigint")).sortWithinPartitions(*KEY).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def add(self, keys: DataFrame) -> None:
        """The run of a batch (rows of ``line_keys``), and the merges it sets off. A document
        counts once per key within its batch, so all its rows belong into one batch."""
        per_doc = keys.select("doc_id", *KEY).distinct()
        counts = per_doc.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"))
        if self.min_docs is None:
            self._write(counts, 0)
        else:
            before = self.counts().withColumnRenamed("n_docs", "before")
            total = F.col("n_docs") + F.coalesce("before", F.lit(0))
            merged = self._open(counts).join(before.hint("merge"), list(KEY), "left").select(*KEY, "n_docs", total.alias("total"))
            path = f"{self.root}/batch-{self.made}"
            merged.write.parquet(path)
            merged = self.spark.read.schema(merged.schema).parquet(path)
            self._settle(merged.filter(F.col("total") >= self.min_docs))
            self._write(merged.filter(F.col("total") < self.min_docs), 0)
            drop_folder(self.spark, path)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            self._write(self._merged(old), level + 1)
            self.levels[level] = []
            for path in old:
                drop_folder(self.spark, path)
            level += 1

    def _settle(self, rows: DataFrame) -> None:
        path = f"{self.root}/settled/run-{self.made}"
        rows.select(*KEY).sortWithinPartitions(*KEY).write.parquet(path)
        self.settled.append(path)

    def _open(self, rows: DataFrame) -> DataFrame:
        """Rows whose key is not settled."""
        if not self.settled:
            return rows
        known = self.spark.read.schema("h1 long, h2 long").parquet(*self.settled)
        return rows.join(known.hint("merge"), list(KEY), "left_anti")

    def _merged(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.schema(RUN_SCHEMA).parquet(*paths)
        return self._open(rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs")))

    def counts(self) -> DataFrame:
        """(h1, h2, n_docs) over all runs, of keys that are not settled."""
        paths = [p for level in self.levels for p in level]
        return self._merged(paths) if paths else self.spark.createDataFrame([], RUN_SCHEMA)

    def shared(self) -> DataFrame:
        """Keys in at least ``min_docs`` documents; each is in one settled run."""
        empty = self.spark.createDataFrame([], "h1 long, h2 long")
        return self.spark.read.schema(empty.schema).parquet(*self.settled) if self.settled else empty


def dropped_places(keys: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc_id, drops): places of the lines to drop; documents that lose none have no row."""
    hit = keys.join(shared, list(KEY), "left_semi")
    return hit.groupBy("doc_id").agg(F.collect_set("pos").alias("drops"))


def cleaned(docs: DataFrame, keys: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows of ``docs`` with ``__lines`` (lines before) and ``__left`` (lines that stay).

    ``doc_id`` has to name a row's text: rows that share it share the places."""
    drops = dropped_places(keys, shared).select(F.col("doc_id").alias("__id"), "drops")
    joined = docs.join(drops, docs["doc_id"].eqNullSafe(F.col("__id")), "left").drop("__id")
    split = joined.withColumn("__lines", lines(whole("text")))
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.coalesce("drops", F.array().cast("array<int>")))
    return split.withColumn("__left", F.transform(places, lambda p: F.get("__lines", p))).drop("drops")


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text: the documents without the lines whose key is in
    at least ``min_docs`` documents (distinct doc_id).

    One row per input row. A null or empty text is one empty line and stays empty; a line of
    white space has no key and stays. Rows without doc_id count as one document. An exact
    repeat of a row gives the same result and does not count twice. Rows that share a doc_id
    but not the text are told apart by the text. An empty table gives no rows. Other columns
    are not read."""
    spark = docs.sparkSession
    # A row's own name: several texts under one id stay apart in the join, not in the count.
    named = docs.select("doc_id", F.xxhash64("text").alias("__text"), "text")
    rows = named.select(F.struct("doc_id", "__text").alias("doc_id"), "text")
    path = scratch(spark, "line-keys")
    batch = F.pmod(F.xxhash64("doc_id.doc_id"), F.lit(batches)).cast("int")
    found = line_keys(rows).withColumn("batch", batch)
    found.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(found.schema).parquet(path)
    runs = LineRuns(spark, min_docs=min_docs)
    for number in range(batches):
        own = keys.filter(F.col("batch") == number)
        runs.add(own.select("doc_id.doc_id", *KEY))
    done = cleaned(rows, keys, runs.shared())
    return done.select(
        F.col("doc_id.doc_id").alias("doc_id"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        (F.size("__lines") - F.size("__left")).cast("bigint").alias("n_dropped"),
        F.array_join("__left", "\n").alias("kept_text"),
    )
