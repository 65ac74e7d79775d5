"""Run tables on shared storage.

Every table is a Parquet folder. A unit of work writes all its outputs under its own
(run_id, batch_id) folders, overwriting what a failed attempt left there, and then writes one commit
row. Readers use only committed units, so a crash leaves files that nobody reads. One driver works on
a run, the one that holds its claim; different runs may load at the same time, since a load number
can be created once.

Tickets lie in buckets by the hash of their key. A load adds files to buckets or rewrites them, and
its record names the buckets of either kind, so that the records up to any load are a version of the
table: readers keep theirs while others load, and files of untouched buckets stay as they are. In a
bucket tickets are sorted by status, priority and time, with Bloom filters on their ids.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Collection
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskwright import fixed
from deskwright.functions.text import truncate
from deskwright.operators.scoring import MEASURES
from deskwright.session import RECOMMENDED

TICKET_SCHEMA = T.StructType(
    [T.StructField("source_system", T.StringType()), T.StructField("ticket_id", T.StringType())]
    + [
        T.StructField(name, T.TimestampType() if name.endswith("_at") else T.StringType())
        for name in fixed.EXPORT_COLUMNS
        if name not in ("source_system", "ticket_id")
    ]
    + [
        T.StructField("source_input_hash", T.StringType()),
        T.StructField("source_run_id", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

SCHEMAS = {
    "runs": "run_id string, run_key string, status string, event_at timestamp, input_path string, "
    "input_hash string, input_format string, config_hash string, config_json string, "
    "dry_run boolean, incremental boolean, duration_seconds double, error_message string",
    "lineage": "run_id string, source_system string, original_path string, input_size_bytes long, "
    "input_hash string, input_format string, config_hash string, schema_version int, "
    "recorded_at timestamp",
    "commits": "row_offset long, batch_index long, committed_at timestamp, "
    + ", ".join(f"{name} long" for name in MEASURES)
    + ", run_id string, batch_id long",
    "keys": "ticket_key string, first_row_number long, run_id string, batch_id long",
    "repeats": "row_number long, run_id string, batch_id long",
    "quarantine": "row_number long, masked_raw string, "
    "violations array<struct<code:string,dimension:string,message:string>>, "
    "quarantined_at timestamp, run_id string, batch_id long",
    "quality_metrics": "dimension string, score double, measured_at timestamp, run_id string",
    "loads": "load_number long, run_id string, through_batch long, folder string, n_buckets int, "
    "rewritten array<int>, added array<int>, loaded_records long, unchanged_records long, "
    "published_at timestamp",
}

# The first load of a store decides how many buckets it has.
LEAST_BUCKETS, MOST_BUCKETS, BUCKET_ROWS = 8, 65_536, 1_000_000
# A bucket with so many folders is rewritten as one by the next load that adds to it.
MOST_PARTS = 8
TICKET_ORDER = ["status", "priority", "updated_at"]


class RunClaimed(RuntimeError):
    """Another driver works on the run."""


def _link_record(path: str, values: dict) -> bool:
    """Create a record on a local file system; readers skip the hidden name that it has before."""
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    hidden = f"{folder}/_{name}-{uuid.uuid4().hex}"
    with open(hidden, "x", encoding="utf-8") as out:
        out.write(json.dumps(values) + "\n")
    try:
        os.link(hidden, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(hidden)
    return True


class TicketStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        timestamps = "spark.sql.parquet.outputTimestampType"
        spark.conf.set(timestamps, RECOMMENDED[timestamps])

    def path(self, table: str, run_id: str | None = None, batch_id: int | None = None) -> str:
        parts = [self.root, table]
        if run_id is not None:
            parts.append(f"run_id={run_id}")
        if batch_id is not None:
            parts.append(f"batch_id={batch_id}")
        return "/".join(parts)

    def _hadoop(self, path: str) -> tuple:
        """A path and its file system."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        found, system = self._hadoop(path)
        return system.exists(found)

    def create(self, path: str, values: dict) -> bool:
        """Create a record, unless there is one of that name.

        Of several drivers that try, one succeeds, as long as the file system creates exclusively as
        HDFS does. Hadoop's local one does not: there a name is linked to the whole record instead.
        """
        found, system = self._hadoop(path)
        if system.getUri().getScheme() == "file":
            return _link_record(found.toUri().getPath(), values)
        try:
            out = system.create(found, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(json.dumps(values) + "\n", "utf-8"))
        out.close()
        return True

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        """A table, or its part for one run; empty when nothing was written yet."""
        schema = T.StructType.fromDDL(SCHEMAS[table])
        nested = table not in ("runs", "lineage", "loads")
        path = self.path(table, run_id if nested else None)
        if not self.exists(path):
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        rows = reader.json(path) if table == "loads" else reader.parquet(path)
        return rows if run_id is None else rows.where(F.col("run_id") == run_id)

    def append(self, table: str, **values) -> None:
        """Append one log row; columns not given are null."""
        schema = T.StructType.fromDDL(SCHEMAS[table])
        columns = [
            (values[f.name] if hasattr(values.get(f.name), "cast") else F.lit(values.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
        self.spark.range(1).select(*columns).coalesce(1).write.mode("append").parquet(
            self.path(table)
        )

    # Runs

    def log_run(self, run: dict, status: str, error: str | None = None, **values) -> None:
        message = None if error is None else truncate(F.lit(error), fixed.ERROR_CHARS)
        self.append(
            "runs",
            **run,
            status=status,
            error_message=message,
            event_at=F.lit(datetime.now(timezone.utc)),
            **values,
        )

    def run_states(self, run_id: str | None = None) -> DataFrame:
        """Latest event of every run, with its start, end and summed attempt time."""
        order = F.struct("event_at", F.col("status").isin(fixed.COMPLETED, fixed.FAILED))
        events = self.read("runs", run_id)
        values = [c for c in events.columns if c not in ("run_id", "duration_seconds", "event_at")]
        return (
            events.groupBy("run_id")
            .agg(
                F.max_by(F.struct(*values), order).alias("_last"),
                F.min("event_at").alias("started_at"),
                F.max(F.when(F.col("status") == fixed.COMPLETED, F.col("event_at"))).alias(
                    "completed_at"
                ),
                F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("duration_seconds"),
            )
            .select("run_id", "_last.*", "started_at", "completed_at", "duration_seconds")
        )

    def run_status(self, run_id: str) -> str | None:
        """Status of the latest of a run's few events."""
        events = self.read("runs", run_id).select("event_at", "status").collect()
        return max(events)["status"] if events else None

    def record_lineage(self, run_id: str, check: bool = True, **values) -> None:
        """Insert the lineage of a run unless it is there; a new run needs no check."""
        if not check or self.read("lineage", run_id).isEmpty():
            self.append("lineage", run_id=run_id, recorded_at=F.current_timestamp(), **values)

    # The driver of a run

    def _claim(self, run_id: str, number: int, end: bool = False) -> str:
        return f"{self.path('claims', run_id)}/claim-{number:06d}{'-ended' if end else ''}.json"

    def last_claim(self, run_id: str) -> int:
        """Number of the latest claim to a run, 0 if there is none."""
        folder, system = self._hadoop(self.path("claims", run_id))
        if not system.exists(folder):
            return 0
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return max((int(n.split("-")[1].split(".")[0]) for n in names if n.startswith("claim-")), default=0)

    def claim(self, run_id: str, take_over: bool = False) -> int:
        """Make this driver the one that works on a run; returns the number of its claim.

        A claim's number can be created once, so of two drivers that start together one gets the run.
        The claim lasts until it is released. ``take_over`` passes over that of a driver that has died.
        """
        last = self.last_claim(run_id)
        if last and not take_over and not self.exists(self._claim(run_id, last, end=True)):
            raise RunClaimed(f"a driver works on run {run_id}; take the run over if it has died")
        who = {"application": self.spark.sparkContext.applicationId}
        if not self.create(self._claim(run_id, last + 1), who):
            raise RunClaimed(f"another driver has just started run {run_id}")
        return last + 1

    def owns(self, run: dict) -> bool:
        """Whether nobody has taken the run over from the holder of its claim."""
        return "claim" not in run or self.last_claim(run["run_id"]) == run["claim"]

    def check_claim(self, run: dict) -> None:
        if not self.owns(run):
            raise RunClaimed(f"run {run['run_id']} was taken over by another driver")

    def release(self, run: dict) -> None:
        self.create(self._claim(run["run_id"], run["claim"], end=True), {})

    # Units of work

    def commits_of(self, run_id: str) -> list[Row]:
        """The commit rows of a run in order, one per unit of work."""
        columns = ["batch_id", "row_offset", "batch_index", "total_records", "accepted_records"]
        return sorted(self.read("commits", run_id).select(*columns).collect())

    def committed(self, table: str, run_id: str | None = None) -> DataFrame:
        """The rows of a table that belong to committed units."""
        done = self.read("commits", run_id).select("run_id", "batch_id")
        return self.read(table, run_id).join(done, ["run_id", "batch_id"], "left_semi")

    def write_unit(
        self, rows: DataFrame, table: str, run_id: str, batch_id: int, sparse: bool = False
    ) -> str:
        """Write an output of a unit. ``sparse`` rows come from many tasks with few rows each and
        are gathered into files of a sensible size first."""
        path = self.path(table, run_id, batch_id)
        rows = rows.hint("rebalance") if sparse else rows
        rows.write.mode("overwrite").parquet(path)
        return path

    # Tickets

    def loads(self) -> list[Row]:
        """The published loads in order: the manifest of the tickets table, one row per load."""
        rows = self.read("loads").drop("published_at").collect()
        return sorted(rows, key=lambda load: load["load_number"])

    def publish(self, **load) -> bool:
        """Create the record of a load, unless its number is taken already."""
        return self.create(f"{self.path('loads')}/load-{load['load_number']:012d}.json", load)

    def n_buckets(self, loads: list[Row], rows: int) -> int:
        """Buckets of the store; an empty one gets as many as suit its first ``rows``."""
        if loads:
            return loads[0]["n_buckets"]
        return min(max(-(-rows // BUCKET_ROWS), LEAST_BUCKETS), MOST_BUCKETS)

    @staticmethod
    def parts(loads: list[Row]) -> dict[int, list[str]]:
        """The folders of every bucket in the version after the given loads."""
        live: dict[int, list[str]] = {}
        for load in loads:
            for bucket in load["rewritten"]:
                live[bucket] = [load["folder"]]
            for bucket in load["added"]:
                live.setdefault(bucket, []).append(load["folder"])
        return live

    def tickets(
        self, loads: list[Row] | None = None, buckets: Collection[int] | None = None
    ) -> DataFrame:
        """The tickets after the given loads (all, if not given), of some buckets or of all."""
        live = self.parts(self.loads() if loads is None else loads)
        wanted = live if buckets is None else {b: live[b] for b in buckets if b in live}
        paths = [f"{self.root}/{f}/bucket={b}" for b in sorted(wanted) for f in wanted[b]]
        if not paths:
            return self.spark.createDataFrame([], TICKET_SCHEMA)
        return self.spark.read.schema(TICKET_SCHEMA).parquet(*paths)

    def write_tickets(self, rows: DataFrame, folder: str) -> None:
        """Write ``rows`` with their ``bucket``; keys are hashed, so buckets are of one size."""
        order = ["bucket", *TICKET_ORDER]
        writer = rows.repartition("bucket").sortWithinPartitions(*order).write.mode("overwrite")
        writer = writer.option("parquet.bloom.filter.enabled#ticket_id", "true")
        writer.partitionBy("bucket").parquet(f"{self.root}/{folder}")

    def vacuum(self, keep_versions: int = 1) -> list[str]:
        """Delete ticket folders that none of the last ``keep_versions`` versions names.

        No run may be loading, and readers of older versions must have ended.
        """
        loads = self.loads()
        used = {
            f"{folder}/bucket={bucket}"
            for version in range(max(len(loads) - keep_versions, 0), len(loads))
            for bucket, folders in self.parts(loads[: version + 1]).items()
            for folder in folders
        }
        named = {
            f"{load['folder']}/bucket={bucket}"
            for load in loads
            for bucket in (*load["rewritten"], *load["added"])
        }
        deleted = []
        for folder in sorted(named - used):
            path, system = self._hadoop(f"{self.root}/{folder}")
            if system.delete(path, True):
                deleted.append(folder)
        return deleted
