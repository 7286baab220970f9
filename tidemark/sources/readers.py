"""Batch and stream sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.clean import parse_json

TARGET_SCHEMA = T.StructType([
    T.StructField("seller_id", T.StringType()),
    T.StructField("seller_name", T.StringType()),
    T.StructField("target_gmv", T.DoubleType()),
    T.StructField("target_orders", T.IntegerType()),
    T.StructField("target_date", T.DateType()),
])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table, one file or a folder of part files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def is_folder(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath).isDirectory()


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def targets_or_default(spark: SparkSession, path: str, default: DataFrame) -> DataFrame:
    """Seller targets from the CSV when it is there, else the given frame."""
    if path_exists(spark, path):
        return read_csv(spark, path, TARGET_SCHEMA).select(*default.columns)
    return default


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A JSON snapshot, or None when there is none; other errors surface."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(schema).json(path)


def read_versioned(spark: SparkSession, path: str) -> DataFrame:
    """A versioned table; its Parquet files where the Delta package is absent."""
    return spark.read.format(versioned_format(spark)).load(path)


def versioned_format(spark: SparkSession) -> str:
    try:
        spark._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
    except Exception:
        return "parquet"
    return "delta"


def frame_from_rows(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType) -> DataFrame:
    """Small literal rows; bulk data comes from files or ``number_range``."""
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)


def number_range(spark: SparkSession, start: int, stop: int, name: str = "i") -> DataFrame:
    """Integers from ``start`` up to, not including, ``stop``."""
    return spark.range(start, stop).withColumnRenamed("id", name)


def json_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
) -> DataFrame:
    """A keyed JSON log as a stream: one document per line, typed tolerantly."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_json(reader.load(path), schema)


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: T.StructType,
    max_offsets: int | None = None,
) -> DataFrame:
    """The same from a Kafka topic, from its earliest offset; needs the connector jar."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    try:
        raw = reader.load()
    except AnalysisException as err:
        raise RuntimeError("the Kafka connector is not on the classpath") from err
    text = raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset",
    )
    return parse_json(text, schema)


def parquet_stream(
    spark: SparkSession, folder: str, name: str, max_files: int | None = None
) -> DataFrame:
    """The files of one Parquet table as a stream: part files of a folder, or the one file."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def with_position(stream: DataFrame) -> DataFrame:
    """Add ``position``: the place of a row in a file log, in order of arrival."""
    return stream.withColumn("position", F.struct(
        "_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index"))
