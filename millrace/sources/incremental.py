"""Incremental reading of the transaction source."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.normalize import ntz
from millrace.schemas import TRANSACTIONS, conform

FETCH_ROWS = 5000


def _bound(value: datetime | None) -> Column:
    return F.lit(None).cast(T.TimestampNTZType()) if value is None else ntz(value)


def incremental_window(
    source: DataFrame, after: datetime | None, until: datetime, day_column: str | None = None
) -> DataFrame:
    """Rows updated after the watermark, up to and including ``until``.

    Rows without an update time never qualify, and a NULL watermark selects nothing. If the source
    is partitioned by the day of the update, ``day_column`` restricts the partitions as well.
    """
    updated = F.col("last_updated_at")
    changed = source.where((updated > _bound(after)) & (updated <= ntz(until)))
    if day_column and after is not None:
        changed = changed.where(F.col(day_column).between(after.date(), until.date()))
    return conform(changed, TRANSACTIONS)


def period(source: DataFrame, start: datetime, end: datetime, day_column: str | None = None) -> DataFrame:
    """Rows updated in ``[start, end)``, the bounds of a backfill."""
    updated = F.col("last_updated_at")
    chosen = source.where((updated >= ntz(start)) & (updated < ntz(end)))
    if day_column:
        chosen = chosen.where(F.col(day_column).between(start.date(), end.date()))
    return conform(chosen, TRANSACTIONS)


#: Position of a row in the order that slices follow; the row id tells rows of one update time apart.
PLACE = ("last_updated_at", "source_row_id")


def _timestamp(value: datetime) -> str:
    if value.tzinfo is not None:
        raise ValueError("update times are without zone")
    return f"TIMESTAMP '{value.isoformat(' ', 'microseconds')}'"


def _between(after: datetime | None, until: datetime) -> str:
    """The window of ``incremental_window`` in SQL."""
    if after is None:
        return "1 = 0"
    return f"last_updated_at > {_timestamp(after)} AND last_updated_at <= {_timestamp(until)}"


def slice_ends_query(table: str, after: datetime | None, until: datetime, slices: int) -> str:
    """SQL for the last rows of all but the last of ``slices`` parts of a window, each with equally many rows.

    Rows are counted in order of update time and row id, so neither a batch whose rows all lie at the
    end of the window nor a bulk update under a single time makes a part larger than the others.
    """
    if slices < 1:
        raise ValueError("at least one slice is needed")
    order = ", ".join(PLACE)
    return (
        f"SELECT {order} FROM (SELECT {order}, ROW_NUMBER() OVER (ORDER BY {order}) AS place, COUNT(*) OVER () AS total"
        f" FROM {table} WHERE {_between(after, until)}) AS placed"
        f" WHERE place < total AND MOD(place, CAST(CEIL(total / {slices}.0) AS BIGINT)) = 0"
    )


def slice_predicates(after: datetime | None, until: datetime, ends: Iterable[tuple[datetime, int]]) -> list[str]:
    """Conditions of the parts that end at the given rows; together they are the window, and no two meet."""
    updated, row_id = PLACE
    window = _between(after, until)
    bounds = [(_timestamp(time), f"{number:d}") for time, number in sorted(ends)]
    # the first comparison of each bound is one that an index on the update time can serve
    lower = ["", *[f" AND {updated} >= {t} AND ({updated} > {t} OR {row_id} > {i})" for t, i in bounds]]
    upper = [*[f" AND {updated} <= {t} AND ({updated} < {t} OR {row_id} <= {i})" for t, i in bounds], ""]
    return [f"{window}{a}{b}" for a, b in zip(lower, upper, strict=True)]


def run_clock(spark: SparkSession) -> datetime:
    """The current time in UTC, without zone. Read once per run and used as a literal from then on."""
    return spark.sql("SELECT convert_timezone('UTC', localtimestamp()) AS now").first()["now"]


@dataclass(frozen=True)
class Database:
    """Connection parameters of a PostgreSQL database; the driver jar comes with the session."""

    host: str
    name: str
    user: str
    password: str = field(repr=False)
    port: int = 5432

    @classmethod
    def from_environment(
        cls, host: str, name_var: str, user_var: str, password_var: str, env: Mapping[str, str] = os.environ
    ) -> Database:
        return cls(host, env[name_var], env[user_var], env[password_var])

    def options(self) -> dict[str, str]:
        return {
            "url": f"jdbc:postgresql://{self.host}:{self.port}/{self.name}",
            "driver": "org.postgresql.Driver",
            "user": self.user,
            "password": self.password,
            "fetchsize": str(FETCH_ROWS),
            "preferTimestampNTZ": "true",
        }

    def partitioned(self, table: str, column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
        """Reader options that split a table into parallel range queries on a numeric column."""
        return self.options() | {
            "dbtable": table,
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }

    def transactions(
        self, spark: SparkSession, rows: tuple[int, int], partitions: int, table: str = "source_transactions"
    ) -> DataFrame:
        """The source table, read in parallel over ranges of its row id.

        Filters of ``incremental_window`` and the column list travel to the database.
        """
        reader: DataFrameReader = spark.read.format("jdbc")
        return reader.options(**self.partitioned(table, "source_row_id", *rows, partitions)).load()

    def changed(
        self, spark: SparkSession, after: datetime | None, until: datetime, slices: int, table: str = "source_transactions"
    ) -> DataFrame:
        """The rows of a window, read by as many queries as there are slices, of equally many rows each.

        The database finds where slices end, which takes one index-only scan of the window if it has an index on
        update time and row id. A row that changes between the two queries leaves the window and
        belongs to the next run. Row ids are the table's primary key and so not NULL.
        """
        ends = self.answer(spark, slice_ends_query(table, after, until, slices))
        return conform(self.sliced(spark, table, slice_predicates(after, until, [tuple(row) for row in ends])), TRANSACTIONS)

    def clock(self, spark: SparkSession) -> datetime:
        """The database's own clock, for the upper bound of a run."""
        return self.answer(spark, "SELECT CURRENT_TIMESTAMP AT TIME ZONE 'UTC' AS now")[0]["now"]

    def answer(self, spark: SparkSession, query: str) -> list[Row]:
        """The few rows of a query that the database answers."""
        return spark.read.format("jdbc").options(**self.options(), query=query).load().collect()

    def sliced(self, spark: SparkSession, table: str, predicates: list[str]) -> DataFrame:
        """A table with one partition, and one query to the database, per predicate."""
        properties = self.options()
        return spark.read.jdbc(properties.pop("url"), table, predicates=predicates, properties=properties)
