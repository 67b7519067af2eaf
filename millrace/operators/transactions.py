"""Verdicts on a raw transaction batch: clean, rejected with a reason, or neither."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import normalize as n
from millrace.operators.salted import ROWS_PER_SALT, heavy_keys, salted_join
from millrace.schemas import TRANSACTIONS

ROW_ID = "batch_row_id"
CLEAN, REJECTED, UNACCOUNTED = "clean", "rejected", "unaccounted"

# Rejection reasons in order of precedence.
REASONS = (
    "MISSING_TRANSACTION_ID",
    "DUPLICATE_TRANSACTION",
    "MISSING_EMPLOYEE",
    "UNKNOWN_EMPLOYEE",
    "NULL_AMOUNT",
    "NEGATIVE_AMOUNT",
    "RECEIVED_BEFORE_CREATED",
    "COMPLETED_BEFORE_CREATED",
    "UPDATED_BEFORE_CREATED",
    "FUTURE_TRANSACTION",
)


def with_row_id(batch: DataFrame) -> DataFrame:
    """Number the rows of a batch before it is staged, so that identical copies can be told apart.

    The numbers follow from the position in the input and are only good once they are in a file:
    reading the input twice may number it differently.
    """
    return batch.withColumn(ROW_ID, F.monotonically_increasing_id())


def repeated_ids(staged: DataFrame) -> DataFrame:
    """Raw transaction ids with several rows in a staged batch, and the row id of the one that counts.

    The latest row counts; a row without a timestamp is the latest, ties fall to the greater
    source_row_id. Only ids, timestamps and row ids are shuffled, each group is reduced on the map
    side, and the result has a row per repeated id only. It is the whole input of the duplicate
    rule, so the wide rows of the batch need no ranking and no sort.
    """
    recency = F.struct(F.col("last_updated_at").isNull(), "last_updated_at", "source_row_id", ROW_ID)
    return (
        staged.where(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(F.count(F.lit(1)).alias("copies"), F.max(recency)[ROW_ID].alias("latest_row_id"))
        .where("copies > 1")
        .select("transaction_id", "latest_row_id")
    )


def flag_duplicates(batch: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The batch with a boolean ``is_duplicate``; rows without an id are not duplicates.

    ``repeated`` holds the repeated ids of a staged batch. It is normally small and then broadcast
    by the planner, which leaves the batch where it is. Otherwise rows without an id are spread by
    their row id instead of meeting in one task, and a frequent id has a single row on the other
    side, which adaptive skew handling can split. Without ``repeated`` the batch is ranked as it
    comes, see ``rank_duplicates``.
    """
    if repeated is None:
        return rank_duplicates(batch)
    spread = F.when(F.col("transaction_id").isNull(), F.col(ROW_ID)).otherwise(F.xxhash64("transaction_id"))
    return (
        batch.withColumn("_spread", spread)
        .join(repeated.withColumn("_spread", F.xxhash64("transaction_id")), ["_spread", "transaction_id"], "left")
        .withColumn("is_duplicate", F.coalesce(F.col("latest_row_id") != F.col(ROW_ID), F.lit(False)))
        .drop("_spread", "latest_row_id")
    )


def rank_duplicates(batch: DataFrame) -> DataFrame:
    """``is_duplicate`` for a batch that is not staged, in a single pass over it.

    Rows of one id are ranked in two rounds, first among those of the same input partition, then
    the firsts among each other; all others go to groups of their own in the second round. So a
    frequent id is never one group, at the price of moving the wide rows twice. Rows that differ
    nowhere are interchangeable, all others are told apart by their columns.
    """
    others = [c for c in TRANSACTIONS.names if c not in ("transaction_id", "last_updated_at", "source_row_id")]
    newest_first = [F.col("last_updated_at").desc_nulls_first(), *[F.col(c).desc() for c in ("source_row_id", *others)]]
    here = Window.partitionBy("transaction_id", "_part").orderBy(*newest_first)
    firsts = Window.partitionBy("transaction_id", "_group").orderBy(*newest_first)
    none = F.col("transaction_id").isNull()
    return (
        # the row number keeps rows without an id apart, which need no rank at all
        batch.withColumn("_part", F.when(none, F.monotonically_increasing_id()).otherwise(F.spark_partition_id()))
        .withColumn("_first", F.row_number().over(here) == 1)
        .withColumn("_group", F.when(F.col("_first") & ~none, F.lit(-1)).otherwise(F.col("_part")))
        .withColumn("is_duplicate", ~none & ~(F.col("_first") & (F.row_number().over(firsts) == 1)))
        .drop("_part", "_first", "_group")
    )


def heavy_employees(batch: DataFrame, row_count: int, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame | None:
    """Normalised employee ids that too many rows of the batch have, for ``match_employees`` and the fact."""
    return heavy_keys(batch, n.norm("employee_id"), row_count, rows_per_salt)


def match_employees(
    batch: DataFrame, employees: DataFrame, how: str = "left", heavy: DataFrame | None = None
) -> DataFrame:
    """The batch with the cleaned employee its normalised id names (``matched_employee_id``).

    Rows without an employee id get a key of their own that starts with a space; cleaned ids never
    do, so it matches nothing and only spreads those rows over the tasks. Rows of ``heavy`` employees
    are dealt over copies of the employee.
    """
    position = F.col(ROW_ID) if ROW_ID in batch.columns else F.monotonically_increasing_id()
    if heavy is not None and ROW_ID not in batch.columns:
        raise ValueError("only the rows of a staged batch can be dealt")
    key = F.coalesce(n.norm("employee_id"), F.concat(F.lit(" "), position.cast("string")))
    known = employees.select(F.col("employee_id").alias("matched_employee_id"))
    return salted_join(batch, key, position, known, "matched_employee_id", heavy, how)


def rejection_reason(as_of: datetime) -> Column:
    """The first broken rule, NULL if none is known to be broken."""
    broken = (
        F.col("transaction_id").isNull(),
        F.col("is_duplicate"),
        F.col("employee_id").isNull(),
        F.col("matched_employee_id").isNull(),
        F.col("amount").isNull(),
        F.col("amount") < 0,
        F.col("received_at") < F.col("created_at"),
        F.col("completed_at") < F.col("created_at"),
        F.col("last_updated_at") < F.col("created_at"),
        F.col("created_at") > n.ntz(as_of),
    )
    (first, rule), *rest = zip(REASONS, broken)
    reason = F.when(rule, first)
    for name, rule in rest:
        reason = reason.when(rule, name)
    return reason


def verdicts(
    raw: DataFrame,
    employees: DataFrame,
    as_of: datetime,
    repeated: DataFrame | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Raw columns plus ``rejection_reason`` and ``outcome``, evaluated once for all outcomes.

    ``repeated`` are the repeated ids of ``raw`` if that is a staged batch, see ``flag_duplicates``, and
    ``heavy`` its frequent employees, see ``match_employees``.
    A row is clean only if every rule is known to hold. Without created_at or last_updated_at
    that cannot be said, and unless another rule is broken such a row is in neither set.
    """
    timed = F.col("created_at").isNotNull() & F.col("last_updated_at").isNotNull()
    return (
        match_employees(flag_duplicates(raw, repeated), employees, heavy=heavy)
        .withColumn("rejection_reason", rejection_reason(as_of))
        .withColumn(
            "outcome",
            F.when(F.col("rejection_reason").isNotNull(), REJECTED).when(timed, CLEAN).otherwise(UNACCOUNTED),
        )
        .select(*TRANSACTIONS.names, "rejection_reason", "outcome")
    )


_CLEANED = {
    "transaction_id": n.norm,
    "employee_id": n.norm,
    "transaction_type": F.trim,
    "classification": n.classification,
    "priority": F.trim,
    "channel": F.trim,
    "region_code": F.trim,
    "status": n.transaction_status,
}


def settle(judged: DataFrame) -> DataFrame:
    """Verdicts with the clean rows normalised; all others keep their raw values.

    Written partitioned by ``outcome``, one pass yields the clean and the rejected table.
    """
    is_clean = F.col("outcome") == CLEAN
    return judged.withColumns(
        {name: F.when(is_clean, rule(name)).otherwise(F.col(name)) for name, rule in _CLEANED.items()}
    )


def transactions_clean(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("outcome") == CLEAN).select(
        *[_CLEANED[c](c).alias(c) if c in _CLEANED else F.col(c) for c in TRANSACTIONS.names]
    )


def transactions_rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("outcome") == REJECTED).select(*TRANSACTIONS.names, "rejection_reason")


def rejection_summary(rejected: DataFrame, *batch_columns: str) -> DataFrame:
    """Rejected rows per reason, and per batch if the given columns name it."""
    return rejected.groupBy(*batch_columns, "rejection_reason").agg(F.count(F.lit(1)).alias("row_count"))
