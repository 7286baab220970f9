"""What several operators of this package share: table access, written intermediate results, files of shared folders."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written below the shared folder and read again: cuts the lineage, outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null is the empty text."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(text, F.lit("")), upper, lower)


def crc_bucket(key: Column, buckets: int) -> Column:
    """CRC-32 of the key as decimal text, modulo ``buckets``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(buckets))


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column one by one, null as empty; no list of all of them is built."""
    for value in column:
        yield value.as_py() or ""


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``: what a task makes of a batch, and hands back, stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def open_store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a shared folder given as URI; ``settled`` makes one of a path without scheme."""
    scheme = re.match(r"([a-z][a-z0-9+.-]+):", uri)
    if scheme is None:
        return arrow_fs.LocalFileSystem(), uri
    if scheme[1] == "file":
        return arrow_fs.LocalFileSystem(), re.sub(r"^file:(//[^/]*)?", "", uri)
    try:
        return arrow_fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))  # Hadoop's names of one store
    except pa.ArrowInvalid as error:
        raise ValueError(f"files cannot be written to {uri}: a store that Arrow does not know") from error


def settled(spark: SparkSession, folder: str) -> str:
    """The folder as Spark resolves it: a path without scheme gets that of the default file system.

    A row written beside the folder tells where such a path leads; executors then use the same store as Spark.
    """
    if re.match(r"[a-z][a-z0-9+.-]+:", folder):
        return folder
    beside = f"{folder.rstrip('/')}.place"
    spark.range(1).write.mode("overwrite").parquet(beside)
    found = urlsplit(spark.read.parquet(beside).inputFiles()[0])
    return f"{found.scheme}://{found.netloc}{unquote(found.path).rsplit('.place/', 1)[0]}"


def put_file(uri: str, name: str, data: bytes | list[bytes]) -> str:
    """Write ``name`` below the folder in one step: a repeated or doubled task replaces the file by an equal one."""
    store, root = open_store(uri)
    store.create_dir(root, recursive=True)
    final, draft = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        for part in [data] if isinstance(data, bytes) else data:
            out.write(part)
    store.move(draft, final)
    return f"{uri}/{name}"
