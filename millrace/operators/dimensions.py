"""Rows for the two dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def department_rows(departments: DataFrame) -> DataFrame:
    return departments.select(
        "department_id", "department_name", "sector", "location", "cost_center", "active_flag"
    )


def employee_rows(employees: DataFrame, dim_department: DataFrame) -> DataFrame:
    """Employees with their department's surrogate key; unknown departments drop the row.

    Employees without an id cannot be upserted and are left out (the employee accounting counts them).
    """
    keys = dim_department.select("department_id", "department_key")
    return (
        employees.where(F.col("employee_id").isNotNull())
        .join(keys, "department_id")
        .select(
            "employee_id", "employee_name", "department_key", "job_title", "hire_date",
            "employment_status", "grade", "email", "location",
        )
    )
