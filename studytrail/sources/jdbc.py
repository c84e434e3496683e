"""Relational log tables: partitioned reads and appends that a rerun does not repeat.

Connection options come from the caller; none are kept here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_options(
    table: str,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if lower is None or upper is None or partitions < 1:
            raise ValueError("a partition column needs lower, upper and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, connection: Mapping[str, str], table: str, **ranges) -> DataFrame:
    """A table read by ``partitions`` tasks, each a range of the partition column."""
    return spark.read.format("jdbc").options(**connection).options(**read_options(table, **ranges)).load()


def read_table_by_range(
    spark: SparkSession, connection: Mapping[str, str], table: str, partition_column: str, partitions: int
) -> DataFrame:
    """As ``read_table`` with the bounds asked from the database (one aggregate row)."""
    query = f"(select min({partition_column}) as lo, max({partition_column}) as hi from {table}) bounds"
    row = spark.read.format("jdbc").options(**connection).option("dbtable", query).load().first()
    if row is None or row[0] is None:
        return read_table(spark, connection, table)
    return read_table(
        spark,
        connection,
        table,
        partition_column=partition_column,
        lower=row[0],
        upper=row[1],
        partitions=partitions,
    )


def rows_beyond(table: str, column: str, value: int | float | str | None) -> str:
    """A table's rows whose column lies beyond a value, as what stands in ``from``; the database
    evaluates it, so that no other rows travel."""
    if value is None:
        return table
    shown = "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)
    return f"(select * from {table} where {column} > {shown}) beyond_{column}"


def new_rows(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet (null keys compare equal)."""
    known = stored.select(*[stored[k].alias(f"__{k}") for k in keys])
    match = None
    for k in keys:
        part = rows[k].eqNullSafe(known[f"__{k}"])
        match = part if match is None else match & part
    return rows.join(known, match, "left_anti")


def append_table(rows: DataFrame, connection: Mapping[str, str], table: str, batch_size: int = 10_000) -> None:
    """Plain append: running it twice stores the rows twice."""
    rows.write.format("jdbc").options(**connection).option("dbtable", table).option("batchsize", batch_size).mode(
        "append"
    ).save()


def append_new(
    spark: SparkSession, rows: DataFrame, connection: Mapping[str, str], table: str, keys: Sequence[str], partitions: int
) -> None:
    """Append only rows whose key the table lacks; the table is read in ranges of its first key."""
    stored = read_table_by_range(spark, connection, table, keys[0], partitions)
    append_table(new_rows(rows, stored, keys), connection, table)


def replace_table(rows: DataFrame, connection: Mapping[str, str], table: str, batch_size: int = 10_000) -> None:
    """The rows in place of the table's, whose definition stays."""
    rows.write.format("jdbc").options(**connection).option("dbtable", table).option("batchsize", batch_size).option(
        "truncate", "true"
    ).mode("overwrite").save()
