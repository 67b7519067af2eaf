"""Named issue counts over the raw tables. They report; they never fail a run."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import normalize as n
from millrace.schemas import duplicate_keys


def employee_rules(today: date) -> dict[str, Column]:
    return {
        "employees_missing_department": F.col("department_id").isNull(),
        "employees_bad_email": F.col("email").isNull() | ~F.col("email").like(n.EMAIL_SHAPE),
        "employees_future_hire_date": F.col("hire_date") > n.day(today),
        "employees_non_standard_status": ~F.col("employment_status").isin(*n.EMPLOYMENT_STATUSES),
    }


def transaction_rules(as_of: datetime) -> dict[str, Column]:
    return {
        "transactions_missing_employee": F.col("employee_id").isNull(),
        "transactions_negative_amount": F.col("amount") < 0,
        "transactions_null_amount": F.col("amount").isNull(),
        "received_before_created": F.col("received_at") < F.col("created_at"),
        "completed_before_created": F.col("completed_at") < F.col("created_at"),
        "updated_before_created": F.col("last_updated_at") < F.col("created_at"),
        "future_transactions": F.col("created_at") > n.ntz(as_of),
        "non_standard_transaction_status": ~F.col("status").isin(*n.TRANSACTION_STATUSES),
    }


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(check_name, issue_count) for all row rules of a table, in one pass over it."""
    counted = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], list(rules), "check_name", "issue_count")


def repeated_key_count(df: DataFrame, key: str, check_name: str) -> DataFrame:
    """How many key values have several rows; the NULLs of a key are one value."""
    return duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("issue_count")).select(
        F.lit(check_name).alias("check_name"), "issue_count"
    )


def unknown_key_count(df: DataFrame, key: str, known: DataFrame, check_name: str) -> DataFrame:
    """How many rows hold a key that ``known`` lacks, spelled exactly.

    Both sides are reduced to a row per key before the join, however frequent a key is.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    unknown = per_key.join(known.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return unknown.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("issue_count")).select(
        F.lit(check_name).alias("check_name"), "issue_count"
    )


def quality_report(
    transactions: DataFrame, employees: DataFrame, departments: DataFrame, as_of: datetime, today: date
) -> DataFrame:
    """All sixteen checks over raw, un-normalised staging as (check_name, issue_count)."""
    parts = [
        repeated_key_count(employees, "employee_id", "duplicate_employee_ids"),
        unknown_key_count(employees, "department_id", departments, "employees_invalid_department"),
        rule_counts(employees, employee_rules(today)),
        repeated_key_count(transactions, "transaction_id", "duplicate_transaction_ids"),
        unknown_key_count(transactions, "employee_id", employees, "transactions_unknown_employee"),
        rule_counts(transactions, transaction_rules(as_of)),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def total_issues(report: DataFrame) -> DataFrame:
    """Sum over all checks; a row that breaks several rules counts several times."""
    return report.agg(F.sum("issue_count").alias("total_issues"))
