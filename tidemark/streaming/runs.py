"""Starting, ending and reading back streaming runs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

BatchWriter = Callable[[DataFrame, int], None]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Seconds between two looks at a running query.
POLL_S = 0.2
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Keep stream state in RocksDB, so that it may exceed executor memory; the session's own setting comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def run_available(
    writer: DataStreamWriter, checkpoint: str, timeout_s: int | None = None
) -> StreamingQuery:
    """Process everything that is there, then stop; failures of the query surface. No time limit unless one is given."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        if timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_s):
            raise TimeoutError(f"stream did not end in {timeout_s} s")
    finally:
        query.stop()
    return query


class RunTotals(StreamingQueryListener):
    """Totals of all micro-batches of the queries that run while it listens, however many they are."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.batches = self.input_rows = self.late_rows = self.state_rows = self.ended = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended += 1

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.input_rows += event.progress.numInputRows
        self.late_rows += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.state_rows = max([self.state_rows, *(op.numRowsTotal for op in event.progress.stateOperators)])

    def __enter__(self) -> RunTotals:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)


def run_continuously(
    writer: DataStreamWriter, checkpoint: str, interval: str = "2 seconds"
) -> StreamingQuery:
    """A long-running query with a fixed trigger interval."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def run_until_idle(
    writer: DataStreamWriter, checkpoint: str, max_idle_s: float, interval: str = "1 second",
    enough: Callable[[], bool] = lambda: False,
) -> StreamingQuery:
    """A running query that ends by itself: once no data came for ``max_idle_s`` seconds, or ``enough`` says so.

    Time that a micro-batch takes is not idle. A failure of the query surfaces.
    """
    query = run_continuously(writer, checkpoint, interval)
    try:
        busy, seen = time.monotonic(), None
        while query.isActive and not enough():
            progress = query.lastProgress
            batch = progress["batchId"] if progress and progress["numInputRows"] else seen
            if query.status["isDataAvailable"] or batch != seen:
                busy, seen = time.monotonic(), batch
            if time.monotonic() - busy > max_idle_s:
                break
            query.awaitTermination(POLL_S)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()
    return query


def first_records(path: str, wanted: int, order: Sequence[str]) -> BatchWriter:
    """Batch writer of the first ``wanted`` records over all micro-batches, in ``order`` inside each.

    ``path/taken`` holds the number taken so far under the batch's id; a repeated batch starts from its predecessor's.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = taken(spark, path, upto=batch_id - 1)
        write_batch(df.orderBy(*order).limit(wanted - before), f"{path}/rows", batch_id)
        more = spark.read.schema(df.schema).parquet(batch_path(f"{path}/rows", batch_id)).count()
        write_batch(spark.createDataFrame([(before + more,)], "taken long").coalesce(1), f"{path}/taken", batch_id)
        forget_batches(spark, f"{path}/taken", before=batch_id - 1)

    return write


def taken(spark: SparkSession, path: str, upto: int | None = None) -> int:
    """Records that :func:`first_records` has taken."""
    done = [b for b in complete_batches(spark, f"{path}/taken") if upto is None or b <= upto]
    return spark.read.schema("taken long").parquet(batch_path(f"{path}/taken", done[-1])).first()["taken"] if done else 0


def forget_batches(spark: SparkSession, path: str, before: int) -> None:
    """Remove the folders of the batches below ``before``: states that a later batch has taken over."""
    for batch_id in complete_batches(spark, path):
        if batch_id < before:
            folder = spark._jvm.org.apache.hadoop.fs.Path(batch_path(path, batch_id))
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch to its own folder; a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(batch_path(path, batch_id))


def is_complete(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether the write of this batch ended: one look-up."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{batch_path(path, batch_id)}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def complete_batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches whose write ended, in order: one listing."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found)


def read_batches(spark: SparkSession, path: str, schema: StructType | str, after: int = -1, upto: int | None = None) -> DataFrame:
    """The complete batches of a sink, with their ``batch_id``; without any, no rows of ``schema``."""
    done = [b for b in complete_batches(spark, path) if b > after and (upto is None or b <= upto)]
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType([f for f in schema if f.name != "batch_id"])
    if not done:
        return spark.createDataFrame([], full).withColumn("batch_id", F.lit(None).cast("long"))
    rows = spark.read.schema(full.add("batch_id", "long")).option("basePath", path)
    return rows.parquet(*[batch_path(path, b) for b in done])
