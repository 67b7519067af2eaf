"""Cleaning of the two reference tables, departments and employees."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import normalize as n
from millrace.schemas import EMPLOYEES

MISSING_DEPARTMENT = "MISSING_DEPARTMENT"
INVALID_DEPARTMENT = "INVALID_DEPARTMENT"
FUTURE_HIRE_DATE = "FUTURE_HIRE_DATE"


def departments_clean(raw: DataFrame) -> DataFrame:
    """Normalised departments, distinct over the whole row; rows without an id are dropped.

    Two attribute versions of one id both survive; the dimension load refuses them.
    """
    return (
        raw.where(F.col("department_id").isNotNull())
        .select(
            n.norm("department_id").alias("department_id"),
            F.trim("department_name").alias("department_name"),
            F.trim("sector").alias("sector"),
            F.trim("location").alias("location"),
            n.norm("manager_employee_id").alias("manager_employee_id"),
            F.trim("cost_center").alias("cost_center"),
            n.norm("active_flag").alias("active_flag"),
        )
        .distinct()
    )


def match_departments(employees: DataFrame, departments: DataFrame, how: str) -> DataFrame:
    """Employees with the cleaned department their normalised id names (``matched_department_id``)."""
    known = departments.select(F.col("department_id").alias("matched_department_id"))
    return employees.join(known, n.norm(employees["department_id"]) == known["matched_department_id"], how)


def employees_rejected(raw: DataFrame, departments: DataFrame, today: date) -> DataFrame:
    """Every raw employee row, duplicates included, that breaks a rule, with the first broken rule."""
    reason = (
        F.when(F.col("department_id").isNull(), MISSING_DEPARTMENT)
        .when(F.col("matched_department_id").isNull(), INVALID_DEPARTMENT)
        .when(F.col("hire_date") > n.day(today), FUTURE_HIRE_DATE)
    )
    return (
        match_departments(raw, departments, "left")
        .withColumn("rejection_reason", reason)
        .where(F.col("rejection_reason").isNotNull())
        .select(*EMPLOYEES.names, "rejection_reason")
    )


def latest_employees(raw: DataFrame) -> DataFrame:
    """The newest row of each raw employee id.

    A row without a timestamp counts as newest, and ties fall to the greatest remaining columns.
    Keeping rank 1 only lets Spark cut each group to one row per task before the shuffle, so a
    very frequent id is harmless.
    """
    others = [c for c in EMPLOYEES.names if c not in ("employee_id", "source_updated_at")]
    newest_first = Window.partitionBy("employee_id").orderBy(
        F.col("source_updated_at").desc_nulls_first(), *[F.col(c).desc() for c in others]
    )
    return raw.withColumn("rn", F.row_number().over(newest_first)).where("rn = 1").drop("rn")


def employees_clean(raw: DataFrame, departments: DataFrame, today: date) -> DataFrame:
    """Normalised newest employees with a known department who have already been hired.

    Ranking comes first: if the newest version is not valid, older ones are not tried.
    """
    valid = match_departments(latest_employees(raw), departments, "inner").where(
        F.col("hire_date") <= n.day(today)
    )
    return valid.select(
        n.norm("employee_id").alias("employee_id"),
        F.trim("employee_name").alias("employee_name"),
        n.norm("department_id").alias("department_id"),
        F.trim("job_title").alias("job_title"),
        "hire_date",
        n.employment_status("employment_status").alias("employment_status"),
        F.trim("grade").alias("grade"),
        n.email("email").alias("email"),
        F.trim("location").alias("location"),
        n.norm("manager_employee_id").alias("manager_employee_id"),
        "source_updated_at",
    )


def employee_accounting(raw: DataFrame, clean: DataFrame, rejected: DataFrame) -> DataFrame:
    """Row counts of the employee stage. No gate looks at them: superseded versions and rows without
    a hire date are in neither set, and a superseded row can be rejected while its id is clean."""
    parts = [("raw_count", raw), ("clean_count", clean), ("rejected_count", rejected)]
    rows = None
    for name, df in parts:
        part = df.select(F.lit(name).alias("part"), F.col("employee_id").isNull().alias("no_id"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.agg(
        *[F.count_if(F.col("part") == name).alias(name) for name, _ in parts],
        F.count_if((F.col("part") == "clean_count") & F.col("no_id")).alias("clean_without_id"),
    ).withColumn("neither_count", F.col("raw_count") - F.col("clean_count") - F.col("rejected_count"))
