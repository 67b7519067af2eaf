"""Tables at rest: run-scoped staging, the star schema as segments, and the control table.

Every run writes under paths of its own. Readers resolve tables through the latest control row of
the pipeline, so committing that row publishes the run and nothing before it is visible. The row's
file is named by its number and comes to its place only if no such file is there: of two writers that
began at one commit, one fails. A run whose parent is no longer the latest commit is refused.
"""

from __future__ import annotations

import os
import tempfile
import time
from collections.abc import Sequence
from datetime import datetime
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.sources.segments import RUN, SegmentTable, empty

PIPELINE = "transactions_pipeline"
#: Commits whose tables and staging are kept, and seconds that files of no commit may belong to a run under way.
KEEP, GRACE = 8, 7 * 24 * 3600


class ControlError(Exception):
    """The control table does not allow the operation."""


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for intermediate tables, visible to all executors."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Warehouse:
    """A warehouse below one root folder."""

    def __init__(self, spark: SparkSession, root: str, pipeline: str = PIPELINE):
        self.spark, self.root, self.pipeline = spark, root.rstrip("/"), pipeline
        self.departments = SegmentTable(spark, self.root, "dim_department", schemas.DIM_DEPARTMENT, "department_id", "department_key")
        self.employees = SegmentTable(spark, self.root, "dim_employee", schemas.DIM_EMPLOYEE, "employee_id", "employee_key")
        self.facts = SegmentTable(
            spark, self.root, "fact_transactions", schemas.FACT_TRANSACTIONS, "transaction_id", "transaction_key", "last_updated_at"
        )

    @property
    def tables(self) -> list[SegmentTable]:
        return [self.departments, self.employees, self.facts]

    # control

    def control(self) -> DataFrame:
        """All commits of all pipelines."""
        try:
            return self.spark.read.schema(schemas.ETL_CONTROL).parquet(f"{self.root}/etl_control")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty(self.spark, schemas.ETL_CONTROL)

    def latest(self) -> Row | None:
        """The current commit of this pipeline."""
        return self.control().where(F.col("pipeline_name") == self.pipeline).orderBy(F.col("seq").desc()).first()

    def watermark(self) -> Row:
        """The commit holding the watermark; without one no incremental run is possible."""
        commit = self.latest()
        if commit is None:
            raise ControlError("Watermark not found in etl_control")
        return commit

    def committed(self, run_id: str) -> bool:
        return not self.control().where((F.col("pipeline_name") == self.pipeline) & (F.col("run_id") == run_id)).isEmpty()

    def register(self, watermark: datetime | None) -> Row:
        """Create the control record of this pipeline with its first watermark."""
        if self.latest() is not None:
            raise ControlError(f"{self.pipeline} is already registered")
        return self._append(
            pipeline_name=self.pipeline, last_successful_watermark=watermark, seq=0, run_id="registered",
            last_department_key=0, last_employee_key=0, last_transaction_key=0,
            dim_department=[], dim_employee=[], fact_transactions=[],
        )

    def publish(self, parent: Row, run_id: str, watermark: datetime | None, as_of: datetime, **state) -> Row | None:
        """Append the commit of a finished run.

        ``watermark`` None means an empty batch: only the time of the run moves on, and a control
        record that has gone missing is not noticed.
        """
        current = self.latest()
        if current is None:
            if watermark is None:
                return None
            raise ControlError("ETL_CONTROL_RECORD_NOT_FOUND")
        if current["run_id"] != parent["run_id"]:
            raise ControlError(f"CONCURRENT_COMMIT: {parent['run_id']} is no longer the latest commit")
        state = {k: [dict(s) if isinstance(s, dict) else s.asDict() for s in v] if isinstance(v, list) else v for k, v in state.items()}
        values = parent.asDict(recursive=True) | state
        values |= {
            "last_successful_watermark": parent["last_successful_watermark"] if watermark is None else watermark,
            "last_successful_run": as_of, "seq": parent["seq"] + 1,
            "run_id": run_id, "parent_run_id": parent["run_id"],
        }
        return self._append(**values)

    def _append(self, **values) -> Row:
        """Commit a control row; fails if another writer has committed its number."""
        row = {name: values.get(name) for name in schemas.ETL_CONTROL.names}
        df = self.spark.createDataFrame(pa.Table.from_pylist([row]), schemas.ETL_CONTROL)
        draft = f"{self.root}/etl_control_drafts/{RUN}={row['run_id']}"
        df.coalesce(1).write.mode("overwrite").parquet(draft)
        files = Files(self.spark, self.root)
        (written,) = [f for f in files.listed(draft) if f.endswith(".parquet")]
        place = f"{self.root}/etl_control/{quote(self.pipeline, safe='')}-{row['seq']:012d}.parquet"
        files.make_folder(f"{self.root}/etl_control")
        if not files.move_if_absent(written, place):
            raise ControlError(f"CONCURRENT_COMMIT: another writer has committed number {row['seq']} of {self.pipeline}")
        files.delete(draft)
        return self.control().where((F.col("pipeline_name") == self.pipeline) & (F.col("seq") == row["seq"])).first()

    # staging

    def stage(self, df: DataFrame, run_id: str, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace a staging table of this run and return it as read from its files.

        Later steps and retries see the same rows, and the planner knows the size of the table.
        """
        path = f"{self.root}/staging/run_id={run_id}/{table}"
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def staged(self, run_id: str, table: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/staging/run_id={run_id}/{table}")

    # tables

    def dim_department(self, commit: Row | None = None) -> DataFrame:
        return self.departments.read(self.segments("dim_department", commit))

    def dim_employee(self, commit: Row | None = None) -> DataFrame:
        return self.employees.read(self.segments("dim_employee", commit))

    def fact_transactions(self, commit: Row | None = None, updated: tuple[datetime, datetime] | None = None) -> DataFrame:
        """The fact as of a commit; with ``updated`` only what was updated in [from, to)."""
        return self.facts.read(self.segments("fact_transactions", commit), updated)

    def segments(self, table: str, commit: Row | None = None) -> list[Row]:
        commit = commit or self.latest()
        return list(commit[table] or []) if commit else []

    def verify(self, commit: Row | None = None) -> DataFrame:
        """What is wrong with the stored tables: (table, run_id, file, problem); empty if nothing is."""
        parts = [t.verify(self.segments(t.name, commit)).select(F.lit(t.name).alias("table"), RUN, "file", "problem") for t in self.tables]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    # retention

    def sweep(self, keep: int = KEEP, grace: float = GRACE) -> list[str]:
        """Delete what none of the last ``keep`` commits of any pipeline refers to; returns the folders.

        That is staging of earlier runs, segments that were merged, and leavings of runs that failed. A folder
        younger than ``grace`` seconds that no commit at all knows of may belong to a run under way and stays.
        """
        commits = self.control().select("pipeline_name", "seq", RUN, "parent_run_id", *[t.name for t in self.tables]).collect()
        latest: dict[str, int] = {}
        for c in commits:
            latest[c["pipeline_name"]] = max(c["seq"], latest.get(c["pipeline_name"], 0))
        known = {c[RUN] for c in commits} | {s[RUN] for c in commits for t in self.tables for s in c[t.name] or []}
        kept = [c for c in commits if c["seq"] > latest[c["pipeline_name"]] - keep]
        reachable = {"staging": {c[RUN] for c in kept}, "etl_control_drafts": set()}
        for t in self.tables:
            reachable |= {f"{t.name}{part}": {s[RUN] for c in kept for s in c[t.name] or []} for part in ("", "_files", "_blooms")}
        files, gone = Files(self.spark, self.root), []
        for name, runs in reachable.items():
            for folder, changed in files.folders(f"{self.root}/{name}"):
                run_id = unquote(folder.rsplit(f"{RUN}=", 1)[-1])
                if run_id not in runs and (run_id in known or changed < time.time() - grace):
                    files.delete(folder)
                    gone.append(folder)
        return gone


class Files:
    """The few file operations that commits and retention need, on whatever file system holds the warehouse."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.system = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(self, folder: str) -> list[str]:
        return [s.getPath().toString() for s in self._status(folder)]

    def folders(self, folder: str) -> list[tuple[str, float]]:
        """Folders in a folder and when they were changed; none if it isn't there."""
        return [(s.getPath().toString(), s.getModificationTime() / 1000) for s in self._status(folder) if s.isDirectory()]

    def _status(self, folder: str) -> list:
        path = self.path(folder)
        return list(self.system.listStatus(path)) if self.system.exists(path) else []

    def make_folder(self, folder: str) -> None:
        self.system.mkdirs(self.path(folder))

    def delete(self, folder: str) -> None:
        self.system.delete(self.path(folder), True)

    def move_if_absent(self, source: str, target: str) -> bool:
        """Give a file its name unless there is a file of that name, in one step.

        Renaming does so on file systems such as HDFS. On a local one it would replace the file; a link does not.
        """
        if self.system.getUri().getScheme() != "file":
            return self.system.rename(self.path(source), self.path(target))
        try:
            os.link(urlparse(source).path, urlparse(target).path)
        except FileExistsError:
            return False
        return True


def latest_commits(control: DataFrame) -> DataFrame:
    """The current commit of every pipeline."""
    newest = control.groupBy("pipeline_name").agg(F.max_by(F.struct(*control.columns), "seq").alias("commit"))
    return newest.select("commit.*")
