"""Registration, CSV and parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a frame queryable by name, replacing what had the name."""
    df.createOrReplaceTempView(name)
    return df


def save_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header, one per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a stage (replacing an earlier run) and return a scan of it: later stages restart from the files."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def save_partitioned(df: DataFrame, key: str, path: str, order: list[str] | None = None, files: int | None = None) -> None:
    """One entity's rows lie together and in order. Range partitioning by (key, order) lets a huge entity span files."""
    order = order or []
    keys = [key, *order]
    parted = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    parted.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def save_bucketed(df: DataFrame, path: str, table: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table in buckets of its keys, sorted by them inside, and read it back: later joins, aggregates and windows on the
    keys with tables of as many buckets need no shuffle.

    `path` is a shared folder, `table` its name in the session's catalog. Rows are dealt to the buckets before writing, so each
    bucket is one file. All rows of a key lie in one bucket: choose as many as there are row targets, and keep keys that exceed a
    task by themselves out.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)
