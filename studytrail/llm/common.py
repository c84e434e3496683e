"""What the corpus operators share: words, keys, scratch tables."""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.runtime import temporary_folder

# The six ASCII white-space characters, as a regular expression and as a set.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that names added beside it clash with none."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def words(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space."""
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def stripped(text: Column) -> Column:
    """Without ASCII white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    return temporary_folder(spark, name)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage, survives
    lost executors, and is computed once however often it is read."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_path(uri: str) -> str:
    """The path of a ``file:`` URI or plain path."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"not a mounted path: {uri}")
    return unquote(parts.path)


def open_new(uri: str):
    """A binary stream to a new file in the shared folder, from any task. Mounted paths
    are opened as files, other stores through Arrow's file systems."""
    if urlparse(uri).scheme in ("", "file"):
        path = local_path(uri)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(path)
