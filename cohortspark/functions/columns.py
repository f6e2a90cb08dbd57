"""Choosing, dropping and renaming columns by their name or type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, NumericType, StringType, TimestampNTZType, TimestampType

TYPE_CLASSES: dict[str, tuple[type[DataType], ...]] = {
    "string": (StringType,),
    "datetime": (TimestampType, TimestampNTZType),
    "numeric": (NumericType,),
}


def columns_of_type(df: DataFrame, cls: str) -> list[str]:
    """Names of the string, datetime or numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TYPE_CLASSES[cls])]


def columns_like(df: DataFrame, prefix: str = "", suffix: str = "", contains: str = "", capital: bool = False) -> list[str]:
    """Names with the given prefix, suffix and part; `capital` asks for an upper-case first letter."""
    return [
        c
        for c in df.columns
        if c.startswith(prefix) and c.endswith(suffix) and contains in c and (not capital or c[:1] == c[:1].upper())
    ]


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in set(b.columns)]


def align_columns(df: DataFrame, wanted: list[str], fill: float = 0) -> DataFrame:
    """Exactly the wanted columns in their order: absent ones are filled, others left out."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in wanted])


def rename_from_map(df: DataFrame, names: DataFrame, old: str = "old", label: str = "label") -> DataFrame:
    """Rename by a table of (old, label). Only entries for columns of `df` travel, so the width of `df` bounds them."""
    hits = names.filter(F.col(old).isin(*df.columns)).groupBy(old).agg(F.min(label).alias("label"))
    return df.withColumnsRenamed({r[0]: r[1] for r in hits.collect()})
