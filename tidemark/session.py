"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and a disk-backed state store.

    Nothing here fixes the parallelism: the cluster's own
    ``spark.sql.shuffle.partitions`` is kept and AQE coalesces from there.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are zone-less; epoch milliseconds are taken in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, ``spark.checkpoint.dir``.

    Where it is unset, a local session (one machine) gets a folder of its own for its life; a cluster gets an error,
    as a folder of one machine would split the data over machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, "") or _own_folder(spark)


def _own_folder(spark: SparkSession) -> str:
    folder = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
