"""Rows for the transaction fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import measures, normalize
from millrace.operators.salted import salted_join
from millrace.schemas import FACT_TRANSACTIONS


def with_measures(clean: DataFrame, as_of: datetime) -> DataFrame:
    return clean.withColumns(
        {
            "cycle_hours": measures.cycle_hours("created_at", "completed_at"),
            "sla_breached": measures.sla_breached("due_at", "completed_at", normalize.ntz(as_of)),
        }
    )


def fact_rows(
    clean: DataFrame, dim_employee: DataFrame, as_of: datetime, heavy: DataFrame | None = None
) -> DataFrame:
    """Clean transactions with the employee's key, the employee's current department and the measures.

    Rows of ``heavy`` employees are dealt by their transaction, which is unique.
    """
    keys = dim_employee.select(F.col("employee_id").alias("keyed_employee_id"), "employee_key", "department_key")
    columns = [c for c in FACT_TRANSACTIONS.names if c != "transaction_key"]
    keyed = salted_join(clean, F.col("employee_id"), F.col("transaction_id"), keys, "keyed_employee_id", heavy, "inner")
    return with_measures(keyed, as_of).select(*columns)


def sla_by_department(fact: DataFrame, dim_department: DataFrame) -> DataFrame:
    """Transactions, breaches, amount and mean cycle time per department.

    The fact is reduced to a row per department key before names are joined.
    """
    per_key = fact.groupBy("department_key").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if("sla_breached").alias("breached"),
        F.sum("amount").alias("total_amount"),
        F.sum("cycle_hours").alias("total_cycle_hours"),
    )
    return per_key.join(dim_department, "department_key").select(
        "department_id", "department_name", "transactions", "breached", "total_amount", "total_cycle_hours"
    )
