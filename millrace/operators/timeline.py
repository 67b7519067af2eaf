"""Timeline of transactions: what their own timestamps say happened, in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import normalize as n

# Outcome code of a finished transaction by status.
OUTCOMES = {
    n.COMPLETED: "COMPLETED",
    n.COMPLETED_VARIANT: "COMPLETED",
    n.REJECTED: "REJECTED",
    n.SAVED: "SAVED",
    n.ON_HOLD: "ON_HOLD",
}
OTHER_OUTCOME = "REFERRED"


def outcome(status: Column) -> Column:
    code = F.lit(OTHER_OUTCOME)
    for value, name in OUTCOMES.items():
        code = F.when(status == value, name).otherwise(code)
    return code


def status_timeline(transactions: DataFrame) -> DataFrame:
    """One row per timestamp a transaction has, numbered in order of time.

    Equal times keep the order in which they are listed here. All steps of a transaction come from its one row, so
    nothing is shuffled or sorted across rows.
    """
    listed = [("created_at", F.lit("CREATED")), ("received_at", F.lit("RECEIVED")), ("due_at", F.lit("DUE")), ("completed_at", outcome(F.col("status")))]
    steps = [F.struct(F.col(at).alias("at"), F.lit(i).alias("place"), code.alias("code")) for i, (at, code) in enumerate(listed)]
    ordered = F.array_sort(F.filter(F.array(*steps), lambda s: s["at"].isNotNull()))
    expanded = transactions.select("source_row_id", "transaction_id", F.posexplode(ordered).alias("step", "s"))
    return expanded.select(
        "source_row_id", "transaction_id", (F.col("step") + 1).alias("step_no"),
        F.col("s.code").alias("status_code"), F.col("s.at").alias("status_timestamp"),
    )
