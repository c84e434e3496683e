"""Topic to topic relays: read records, rewrite them as text, write to another topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.functions.keys import marked_text, record_text


def relay_a(records: DataFrame, target: str) -> DataFrame:
    """Key and value as one text, sent without a key."""
    text = record_text(F.col("key"), F.col("value"))
    return records.select(F.lit(None).cast("string").alias("key"), text.alias("value"), F.lit(target).alias("topic"))


def relay_b(records: DataFrame, target: str) -> DataFrame:
    """The value with a mark in front; the key is dropped."""
    text = marked_text(F.col("value"))
    return records.select(F.lit(None).cast("string").alias("key"), text.alias("value"), F.lit(target).alias("topic"))
