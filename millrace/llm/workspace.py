"""Folders for intermediate tables. Apart from the modules whose functions travel to tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.warehouse import shared_folder


#: Copies of the smaller side over which a join by few keys is dealt.
SALTS = 64
#: Bytes of rows that small batches have at most, or one row.
BATCH_BYTES = 2 << 20


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder name for one run's intermediate tables, below the folder all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Let Spark delete the shuffle files of the jobs inside as soon as each has ended: nothing reads them again."""
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Hand texts to Python some megabytes at a time, in the jobs inside.

    A batch is held several times over: by Spark on its way there and back, and by the worker with its results.
    """
    return _set(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of their own, read back: lineage ends there and its size is known."""
    folder = workspace(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def removed(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once what was built on them is written too."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def apart(df: DataFrame) -> DataFrame:
    """The same rows under columns of their own, for another side of a join with themselves."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def spare(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def beside(rows: DataFrame, models: DataFrame, keys: Sequence[str], small: bool, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Rows with the columns of their group's one row in ``models``; null keys are groups like others.

    ``small`` says that the caller has counted the models and found them fit to be broadcast. If not, every
    group is dealt over ``salts`` copies of its model, so that a group with many rows is no task of its own.
    """
    other = models.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    if small:
        return rows.join(F.broadcast(other), same, how).drop(*[f"_{k}" for k in keys])
    rows = rows.withColumn("_salt", F.monotonically_increasing_id() % salts)
    other = other.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.join(other, [*same, F.col("_salt") == F.col("_copy")], how).drop("_salt", "_copy", *[f"_{k}" for k in keys])
