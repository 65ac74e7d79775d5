"""The first row of every key over the units of a run, as keyed state.

A run of several units (micro-batches, or the commits of a one-pass run) has to know the keys of all
earlier ones. They are the state of a streaming aggregate, ``min(row_number)`` per key, in a RocksDB
state store whose changes are checkpointed under the store's root. A unit writes its claims as files
that this stream has not seen; the stream shuffles these alone and looks their keys up in the
partitions of the state that they hash to. In update mode it gives back the first row of each key
that the unit has, and those that lie in the unit are new. So a unit costs its own rows, however many
units came before.

Claims that are delivered again, after a crash, change nothing: the minimum is the same. Every attempt
writes to a folder of its own, so that files which the stream has planned to read stay there.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLAIM = "ticket_key string, row_number long"
FIRST = "ticket_key string, first_row_number long"
# How the state is kept, for the stream's own session.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class KeyState:
    """First rows by key of one run. The stream runs while the context is open."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.query = None
        self._lock = threading.Lock()
        self._written: list[str] = []

    def _keep(self, firsts: DataFrame, batch: int) -> None:
        path = f"{self.folder}/firsts/{batch}-{uuid.uuid4().hex}"
        firsts.write.parquet(path)
        with self._lock:
            self._written.append(path)

    def _hand_over(self, claims: DataFrame) -> None:
        """Write a unit's claims and show them to the stream at once, so that it reads them in one batch."""
        name, hadoop = uuid.uuid4().hex, self.spark._jvm.org.apache.hadoop.fs.Path
        claims.write.parquet(f"{self.folder}/written/{name}")
        written, shown = hadoop(f"{self.folder}/written/{name}"), hadoop(f"{self.folder}/claims/{name}")
        system = shown.getFileSystem(self.spark._jsc.hadoopConfiguration())
        system.mkdirs(shown.getParent())
        if not system.rename(written, shown):
            raise OSError(f"the claims in {written} could not be moved to {shown}")

    def _start(self) -> None:
        claims = (
            self.spark.readStream.schema(CLAIM)
            .option("recursiveFileLookup", "true")
            .parquet(f"{self.folder}/claims")
        )
        firsts = claims.groupBy("ticket_key").agg(F.min("row_number").alias("first_row_number"))
        before = {name: self.spark.conf.get(name, None) for name in STATE_CONF}
        for name, value in STATE_CONF.items():
            self.spark.conf.set(name, value)
        try:
            self.query = (
                firsts.writeStream.outputMode("update")
                .foreachBatch(self._keep)
                .option("checkpointLocation", f"{self.folder}/checkpoint")
                .start()
            )
        finally:
            for name, value in before.items():
                if value is None:
                    self.spark.conf.unset(name)
                else:
                    self.spark.conf.set(name, value)

    def first_rows(self, claims: DataFrame, row_offset: int) -> DataFrame:
        """ticket_key and first_row_number of the keys that no row up to ``row_offset`` has.

        ``claims(ticket_key, row_number)`` are the rows of a unit, all of them after the offset.
        """
        self._hand_over(claims)
        if self.query is None:
            self._start()
        self.query.processAllAvailable()
        with self._lock:
            written, self._written = self._written, []
        if not written:
            return self.spark.createDataFrame([], FIRST)
        found = self.spark.read.schema(FIRST).parquet(*written)
        # After a crash a unit's claims may come in several micro-batches, the later ones with earlier rows.
        least = found.groupBy("ticket_key").agg(F.min("first_row_number").alias("first_row_number"))
        return least.where(F.col("first_row_number") > row_offset)

    def progress(self) -> list[dict]:
        """What the stream says of its recent micro-batches."""
        return [] if self.query is None else [dict(p) for p in self.query.recentProgress]

    def __enter__(self) -> KeyState:
        return self

    def __exit__(self, *error) -> None:
        if self.query is not None:
            self.query.stop()
