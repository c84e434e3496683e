"""Wide-column cell tables on parquet.

A put adds a folder of cells; the current cell is the one with the highest version,
found by the reader's aggregate, so a put costs its own rows. Files are ordered by
row key: key ranges and prefixes prune row groups, bloom filters prune gets by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.operators.cellfilters import COLUMNS, latest
from studytrail.streaming.batches import BatchFolder
from studytrail.streaming.commits import Batch, CommitLog

CELL_SCHEMA = "rowkey string, family string, qualifier string, version long, value string"

# Row groups carry a bloom filter of their row keys, as large as its keys need: a get by key
# leaves out those of all the batches that do not hold it.
ROW_KEY_FILTER = {"parquet.bloom.filter.enabled#rowkey": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _table_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/families/_SUCCESS")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def create_table(spark: SparkSession, path: str, families: Sequence[str]) -> bool:
    """Create the table with its column families; False if it exists already."""
    if _table_exists(spark, path):
        return False
    rows = spark.createDataFrame([(f,) for f in families], "family string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/families")
    return True


def families(spark: SparkSession, path: str) -> list[str]:
    """The column families, as few as the table was created with."""
    return sorted(r.family for r in spark.read.parquet(f"{path}/families").collect())


def put_cells(spark: SparkSession, path: str, cells: DataFrame, batch: Batch) -> None:
    """Store cells as a batch (generation, number); the same batch again replaces it.

    A family the table does not have is an error.
    """
    known = families(spark, path)
    wrong = F.raise_error(F.concat(F.lit("unknown column family "), F.col("family"))).cast("string")
    checked = cells.select(*COLUMNS).withColumn(
        "family", F.when(F.col("family").isin(known), F.col("family")).otherwise(wrong)
    )
    ordered = checked.repartitionByRange("rowkey", "family", "qualifier").sortWithinPartitions("rowkey")
    cell_batches(spark, path).write(ordered, batch)


def cell_batches(spark: SparkSession, path: str, commits: CommitLog | None = None) -> BatchFolder:
    """The table's batches; with a commit log, only those it has recorded."""
    return BatchFolder(spark, f"{path}/cells", commits, **ROW_KEY_FILTER)


def all_versions(spark: SparkSession, path: str, commits: CommitLog | None = None) -> DataFrame:
    return cell_batches(spark, path, commits).read(CELL_SCHEMA)


def current_cells(spark: SparkSession, path: str, commits: CommitLog | None = None) -> DataFrame:
    return latest(all_versions(spark, path, commits))


def compact_table(
    spark: SparkSession, path: str, before: Batch | None = None, commits: CommitLog | None = None
) -> Batch | None:
    """Fold batches into one base folder that keeps only current cells."""

    def merge(cells: DataFrame) -> DataFrame:
        return latest(cells).repartitionByRange("rowkey").sortWithinPartitions("rowkey")

    return cell_batches(spark, path, commits).compact(merge, CELL_SCHEMA, before)
