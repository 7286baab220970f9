"""Batch sinks, catalog tables and named SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clean import encode_json
from tidemark.sources.readers import versioned_format


def write_parquet(df: DataFrame, path: str) -> None:
    """Parquet export with overwrite, to any Hadoop path (``s3a://`` with its package)."""
    df.write.mode("overwrite").parquet(path)


def write_versioned(df: DataFrame, path: str) -> None:
    """Versioned overwrite; plain Parquet overwrite where the Delta package is absent."""
    df.write.format(versioned_format(df.sparkSession)).mode("overwrite").save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; an empty input is an error."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).csv(path)
    if not seen.get["rows"]:
        raise ValueError("no rows to write")


def write_keyed_json(df: DataFrame, key: Column, path: str) -> None:
    """Keyed JSON messages as files, one ``{key, value}`` document per line."""
    encode_json(df, key).write.mode("overwrite").json(path)


def write_kafka(df: DataFrame, key: Column, servers: str, topic: str, acks: str = "all") -> None:
    """Keyed JSON messages to a topic; a failed delivery fails the write."""
    (
        encode_json(df, key).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("kafka.acks", acks)
        .option("topic", topic).save()
    )


def write_snapshot(one_row: DataFrame, path: str) -> None:
    """A one-row frame as a JSON document at a fixed path."""
    one_row.coalesce(1).write.mode("overwrite").json(path)


def rebuild_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Drop the table if present and build it from the frame; data live at ``path``."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)


def list_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {name}")


def run_script(spark: SparkSession, statements: Iterable[str]) -> list[DataFrame]:
    """Run statements in order. A list, not a text split on ``;``."""
    return [spark.sql(s) for s in statements]


def run_named(spark: SparkSession, named: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: spark.sql(text) for name, text in named.items()}

