"""The incremental load as a Structured Streaming job over arriving files."""

from __future__ import annotations

from concurrent.futures import Future
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.load import load_batch
from millrace.schemas import TRANSACTIONS
from millrace.sources.incremental import run_clock
from millrace.sources.segments import empty
from millrace.sources.warehouse import Warehouse


def stream_transactions(
    warehouse: Warehouse,
    source_path: str,
    employees: DataFrame,
    departments: DataFrame,
    checkpoint: str,
    as_of: datetime | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load all files that have arrived since the last call, one commit per micro-batch, then stop.

    The checkpoint remembers which files are done, so a file is loaded whatever its update times
    are, and the watermark only ever moves up. Files may arrive out of order: a fact row is never
    replaced by an older version. Run ids are made of the query's id, which lives in the checkpoint,
    and the batch number, so a micro-batch that is replayed after its commit is recognised. Rows without
    update time can't be loaded; since their file won't be read again, they are kept by run below
    ``untimed``, read by ``untimed_transactions`` and counted by ``stream_runs``.
    """
    query_id: Future[str] = Future()
    reader = warehouse.spark.readStream.schema(TRANSACTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(batch: DataFrame, batch_id: int) -> None:
        run_id = f"stream-{query_id.result()}-{batch_id}"
        if warehouse.committed(run_id):
            return
        untimed = batch.where(F.col("last_updated_at").isNull())
        if not untimed.isEmpty():
            untimed.write.mode("overwrite").parquet(f"{warehouse.root}/untimed/run_id={run_id}")
        load_batch(
            warehouse,
            warehouse.watermark(),
            batch.where(F.col("last_updated_at").isNotNull()),
            employees,
            departments,
            as_of or run_clock(warehouse.spark),
            run_id,
            newer_wins=True,
            lower_watermark=False,
        )

    writer = reader.parquet(source_path).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    try:
        query = writer.trigger(availableNow=True).start()
    except BaseException as error:
        query_id.set_exception(error)  # a batch that has begun must not wait for the id
        raise
    query_id.set_result(query.id)
    return query


def untimed_transactions(warehouse: Warehouse) -> DataFrame:
    """Rows that streams met without update time, with the run that met them; none if all had one."""
    schema = T.StructType([*TRANSACTIONS.fields, T.StructField("run_id", T.StringType())])
    try:
        return warehouse.spark.read.schema(schema).parquet(f"{warehouse.root}/untimed")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(warehouse.spark, schema)


def stream_runs(warehouse: Warehouse) -> DataFrame:
    """The micro-batches that were committed: commit number, watermark after it, and rows that could not be loaded.

    Counts are reduced to a row per run before they meet the commits.
    """
    untimed = untimed_transactions(warehouse).groupBy("run_id").agg(F.count(F.lit(1)).alias("untimed_rows"))
    commits = warehouse.control().where((F.col("pipeline_name") == warehouse.pipeline) & F.col("run_id").startswith("stream-"))
    return commits.join(untimed, "run_id", "left").select(
        "seq", "run_id", "last_successful_watermark", F.coalesce("untimed_rows", F.lit(0)).alias("untimed_rows")
    )
