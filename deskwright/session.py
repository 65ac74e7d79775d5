"""Session helpers."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. Every one can also be set by the cluster.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Timestamps with file statistics, so that filters on them prune.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(master: str | None = None, app: str = "deskwright", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_set_here: dict[str, str] = {}


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Start shuffles with partitions that fit in memory for this input, unless it is configured.

    Adaptive execution merges small partitions but does not split a plain one, so starting with
    many is safe and starting with few is not. What an earlier run set here is set anew.
    """
    session = spark.sparkContext.applicationId
    given = spark.conf.get(_INITIAL_PARTITIONS, None)
    if given is not None and given != _set_here.get(session):
        return
    wanted = input_bytes // SHUFFLE_PARTITION_BYTES
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        _set_here[session] = str(wanted)
        spark.conf.set(_INITIAL_PARTITIONS, str(wanted))
    elif given is not None:
        spark.conf.unset(_INITIAL_PARTITIONS)


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="deskwright-")


@functools.cache
def _session_folder(base: str, application: str) -> str:
    return f"{base}/deskwright/{application}-{uuid.uuid4().hex}"


_registered: set[str] = set()


def _delete_at_end(spark: SparkSession, folder: str) -> None:
    """Have the folder deleted when the driver ends in order."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None or folder in _registered:
        return
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    _registered.add(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder that the cluster names, for this session only.

    ``spark.checkpoint.dir`` is read from the session. Only a local session may fall back to a
    temporary folder; on a cluster the executors would not see it. What is written there is
    deleted when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_scratch()
    application = getattr(spark.sparkContext, "applicationId", "session")
    folder = _session_folder(base.rstrip("/"), application)
    _delete_at_end(spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"
