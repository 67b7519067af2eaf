"""Table contracts: explicit column lists and key rules, never inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_str, _ts, _long, _bool = T.StringType(), T.TimestampNTZType(), T.LongType(), T.BooleanType()
_date, _money = T.DateType(), T.DecimalType(12, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


def _plus(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    return T.StructType(schema.fields + _schema(**columns).fields)


TRANSACTIONS = _schema(
    source_row_id=_long, transaction_id=_str, employee_id=_str, transaction_type=_str,
    classification=_str, priority=_str, channel=_str, region_code=_str,
    created_at=_ts, received_at=_ts, due_at=_ts, completed_at=_ts,
    status=_str, amount=_money, is_escalated=_bool, last_updated_at=_ts, source_system=_str,
)
TRANSACTIONS_REJECTED = _plus(TRANSACTIONS, rejection_reason=_str)

EMPLOYEES = _schema(
    employee_id=_str, employee_name=_str, department_id=_str, job_title=_str, hire_date=_date,
    employment_status=_str, grade=_str, email=_str, location=_str, manager_employee_id=_str,
    source_updated_at=_ts,
)
EMPLOYEES_REJECTED = _plus(EMPLOYEES, rejection_reason=_str)

DEPARTMENTS = _schema(
    department_id=_str, department_name=_str, sector=_str, location=_str,
    manager_employee_id=_str, cost_center=_str, active_flag=_str,
)

DIM_DEPARTMENT = _schema(
    department_key=_long, department_id=_str, department_name=_str, sector=_str,
    location=_str, cost_center=_str, active_flag=_str,
)
DIM_EMPLOYEE = _schema(
    employee_key=_long, employee_id=_str, employee_name=_str, department_key=_long, job_title=_str,
    hire_date=_date, employment_status=_str, grade=_str, email=_str, location=_str,
)
FACT_TRANSACTIONS = _schema(
    transaction_key=_long, transaction_id=_str, employee_key=_long, department_key=_long,
    transaction_type=_str, classification=_str, priority=_str, channel=_str, region_code=_str,
    created_at=_ts, due_at=_ts, completed_at=_ts, status=_str, amount=_money, is_escalated=_bool,
    cycle_hours=_money, sla_breached=_bool, source_system=_str, last_updated_at=_ts,
)

# One row per commit; the row with the highest seq of a pipeline is its current state. Next to the
# watermark it names the segments of each table, so committing it publishes everything at once.
SEGMENTS = T.ArrayType(_schema(run_id=_str, row_count=_long, replacing=_long, file_count=_long, last_key=_long))
ETL_CONTROL = _schema(
    pipeline_name=_str, last_successful_watermark=_ts, last_successful_run=_ts,
    seq=_long, run_id=_str, parent_run_id=_str,
    last_department_key=_long, last_employee_key=_long, last_transaction_key=_long,
    dim_department=SEGMENTS, dim_employee=SEGMENTS, fact_transactions=SEGMENTS,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns by name, cast to the contract's types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row. NULLs form one group, as in GROUP BY."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-NULL foreign keys without a parent row.

    The child is reduced to its distinct keys before the join, so a key that most rows share is
    one row in the shuffle.
    """
    used = child.where(F.col(foreign_key).isNotNull()).select(F.col(foreign_key).alias("orphan_key")).distinct()
    return used.join(parent, used["orphan_key"] == parent[parent_key], "left_anti")
