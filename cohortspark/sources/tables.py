"""Scans: parquet tables, relational sources, CSV lookups."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cohortspark.functions.columns import lower_names


def load(
    spark: SparkSession,
    folder: str,
    name: str,
    cols: list[str] | None = None,
    n: int | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Scan `<folder>/<name>.parquet` (a file or a folder); optionally some columns, the first n rows, a fixed schema."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(os.path.join(folder, f"{name}.parquet"))
    if cols is not None:
        df = df.select(*cols)
    return df if n is None else df.limit(n)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a table of a relational database in parallel ranges of a numeric column. Credentials come from the caller."""
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=properties or {},
    )


def load_lookup(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV lookup with a header: typed by the schema (whose column order is the file's), names in lower case."""
    return lower_names(spark.read.schema(schema).csv(path, header=True, enforceSchema=True))
