"""Topic records as streaming DataFrames, and topic sinks.

Records have the columns key, value, topic, partition, offset, timestamp. The same
jobs run on a Kafka topic (needs the Kafka connector on the classpath) or on files
of such records.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

RECORD_SCHEMA = "key string, value string, topic string, partition int, offset long, timestamp timestamp"

# Fixed batch intervals of the two relays, in seconds.
RELAY_INTERVALS = {"a": 5, "b": 1}


def kafka_source_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_batch: int | None = None,
    fail_on_data_loss: bool = False,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of the topic source; ``starting`` is latest, earliest or the offsets JSON.

    With ``failOnDataLoss`` off, a checkpointed offset the broker no longer keeps
    is raised to the earliest available one.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options | dict(extra or {})


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset", "timestamp"
    )


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str = RECORD_SCHEMA,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def topic_rows(df: DataFrame, default_topic: str | None = None) -> DataFrame:
    """Rows a topic sink takes: (key, value, topic). A row with no topic at all is an error."""
    key = F.col("key").cast("string") if "key" in df.columns else F.lit(None).cast("string")
    named = F.col("topic") if "topic" in df.columns else F.lit(None).cast("string")
    topic = F.coalesce(
        named, F.lit(default_topic).cast("string"), F.raise_error(F.lit("no topic given and no default")).cast("string")
    )
    return df.select(key.alias("key"), F.col("value").cast("string").alias("value"), topic.alias("topic"))


def trigger(writer: DataStreamWriter, seconds: int | None = None) -> DataStreamWriter:
    """A fixed batch interval, or (None) everything available and then stop."""
    if seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def to_kafka(df: DataFrame, servers: str, checkpoint: str, default_topic: str | None = None) -> DataStreamWriter:
    return (
        topic_rows(df, default_topic)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )


def to_files(df: DataFrame, path: str, checkpoint: str, default_topic: str | None = None) -> DataStreamWriter:
    """As ``to_kafka`` with a folder for the topic; the file sink writes every batch once."""
    return (
        topic_rows(df, default_topic)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
