"""Validation and tolerant parsing of JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_fields(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows in which every required field is present."""
    return df.na.drop(subset=list(required))


def rejected(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The rows :func:`require_fields` leaves out."""
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    return df.filter(missing)


def parse_json(df: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """Decode JSON text into typed columns.

    Every field is read as text and cast tolerantly, so ``5`` and ``"5"`` both
    become numbers. Text that is not JSON, or not a number, gives nulls, which
    :func:`rejected` then finds.
    """
    loose = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    parsed = df.withColumn("__json", F.from_json(F.col(text), loose))
    typed = [F.col(f"__json.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema]
    return parsed.select(*[c for c in df.columns if c != text], *typed)


def encode_json(df: DataFrame, key: Column) -> DataFrame:
    """Keyed messages: ``key`` text and the whole row as JSON ``value``."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
