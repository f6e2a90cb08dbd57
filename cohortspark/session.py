"""Session settings, literal tables and intermediate results."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Runtime SQL settings the operators rely on. Partition counts and memory stay with the cluster's own defaults.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a later aggregate could have reused the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; start-up settings are never touched."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def inline(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """A literal table of known size: a local relation, so the planner sees how small it is and broadcasts by itself."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    return spark.createDataFrame(
        pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow), schema
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir. Only a local session may do without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="shared-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str = "settled") -> DataFrame:
    """Write an intermediate result that is read more than once to the shared folder; later reads restart from there, and the
    planner knows its size."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
