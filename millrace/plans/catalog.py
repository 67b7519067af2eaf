"""Named queries over the sample tables, one per operator; ``oracle`` holds the same in plain SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import measures, normalize as n
from millrace.operators import dimensions, fact, quality, reference, salted, timeline, transactions, validation
from millrace.operators.upsert import upsert
from millrace.plans.load import load_batch, new_run_id, run_backfill, run_incremental
from millrace.sources import fixtures, sheets
from millrace.sources.incremental import incremental_window, period, slice_predicates
from millrace.sources.warehouse import Warehouse, empty, latest_commits, shared_folder
from millrace.streaming.incremental import stream_transactions

AS_OF, TODAY, WINDOW_START = fixtures.AS_OF, fixtures.TODAY, fixtures.WINDOW_START
EARLIER = datetime(1998, 7, 1)  # clock of the first of two overlapping loads
BACKFILL = (datetime(1996, 1, 1), datetime(1999, 1, 1))
SLOTS = 8
#: Transactions of one employee that a task takes in the queries of salted joins.
ROWS_PER_SALT = 12

# Days until due by the priority names of the sample tables.
SAMPLE_DUE_DAYS = {"1-URGENT": 1, "2-HIGH": 3, "3-MEDIUM": 5}
FIRST_SECTORS = ("AFRICA", "ASIA", "EUROPE")
LATER_SECTORS = ("ASIA", "EUROPE", "AMERICA", "MIDDLE EAST")
FIRST_EMPLOYEES = "source_updated_at < TIMESTAMP_NTZ '1999-07-01 00:00:00'"
LATER_EMPLOYEES = "source_updated_at >= TIMESTAMP_NTZ '1999-04-01 00:00:00' OR source_updated_at IS NULL"


class Sample:
    """Raw and derived tables of one scale, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def transactions(self) -> DataFrame:
        return fixtures.transactions_raw(self.spark, self.sf_dir)

    @cached_property
    def employees(self) -> DataFrame:
        return fixtures.employees_raw(self.spark, self.sf_dir)

    @cached_property
    def departments(self) -> DataFrame:
        return fixtures.departments_raw(self.spark, self.sf_dir)

    @cached_property
    def window(self) -> DataFrame:
        return incremental_window(self.transactions, WINDOW_START, AS_OF)

    @cached_property
    def departments_clean(self) -> DataFrame:
        return reference.departments_clean(self.departments)

    @cached_property
    def employees_clean(self) -> DataFrame:
        return reference.employees_clean(self.employees, self.departments_clean, TODAY)

    @cached_property
    def employees_rejected(self) -> DataFrame:
        return reference.employees_rejected(self.employees, self.departments_clean, TODAY)

    def staged(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """A batch in staging and its repeated ids."""
        name = uuid.uuid4().hex
        raw = self.stage(transactions.with_row_id(batch), f"transactions_raw_{name}")
        return raw, self.stage(transactions.repeated_ids(raw), f"transactions_repeated_{name}")

    def judged(self, batch: DataFrame, as_of: datetime = AS_OF) -> DataFrame:
        """Verdicts on a batch that is staged first, as a run does it."""
        raw, repeated = self.staged(batch)
        return transactions.verdicts(raw, self.employees_clean, as_of, repeated)

    @property
    def clean(self) -> DataFrame:
        """Clean rows of the whole table as one batch."""
        return transactions.transactions_clean(self.judged(self.transactions))

    @property
    def window_clean(self) -> DataFrame:
        return transactions.transactions_clean(self.judged(self.window))

    @cached_property
    def warehouse(self) -> Warehouse:
        """An empty warehouse in a folder of its own."""
        root = f"{shared_folder(self.spark)}/warehouse-{uuid.uuid4().hex}"
        return Warehouse(self.spark, root)

    def stage(self, df: DataFrame, table: str) -> DataFrame:
        return self.warehouse.stage(df, "query", table)

    @cached_property
    def staged_reference(self) -> tuple[DataFrame, DataFrame]:
        """Both cleaned reference tables, written once for everything built from here on."""
        self.departments_clean = self.stage(self.departments_clean, "departments_clean")
        self.employees_clean = self.stage(self.employees_clean, "employees_clean")
        return self.departments_clean, self.employees_clean

    @cached_property
    def dim_department(self) -> DataFrame:
        self.staged_reference
        rows = dimensions.department_rows(self.departments_clean)
        loaded = upsert(
            empty(self.spark, schemas.DIM_DEPARTMENT), rows, "department_id", "department_key", 0, SLOTS
        )
        return self.stage(schemas.conform(loaded, schemas.DIM_DEPARTMENT), "dim_department")

    @cached_property
    def dim_employee(self) -> DataFrame:
        rows = dimensions.employee_rows(self.staged_reference[1], self.dim_department)
        loaded = upsert(empty(self.spark, schemas.DIM_EMPLOYEE), rows, "employee_id", "employee_key", 0, SLOTS)
        return self.stage(schemas.conform(loaded, schemas.DIM_EMPLOYEE), "dim_employee")

    def first_load(self, clean: DataFrame, as_of: datetime = AS_OF) -> DataFrame:
        rows = fact.fact_rows(clean, self.dim_employee, as_of)
        return upsert(
            empty(self.spark, schemas.FACT_TRANSACTIONS), rows, "transaction_id", "transaction_key", 0, SLOTS
        ).select(*schemas.FACT_TRANSACTIONS.names)

    def run(self, watermark: datetime | None = WINDOW_START, as_of: datetime = AS_OF):
        """Load the window into the empty warehouse."""
        self.warehouse.register(watermark)
        return run_incremental(self.warehouse, self.transactions, self.employees, self.departments, as_of)

    def business_fact(self) -> DataFrame:
        warehouse = self.warehouse
        commit = warehouse.latest()
        return with_business_keys(
            warehouse.fact_transactions(commit), warehouse.dim_employee(commit), warehouse.dim_department(commit)
        )


def with_business_keys(fact_table: DataFrame, dim_employee: DataFrame, dim_department: DataFrame) -> DataFrame:
    """The fact with ids instead of surrogate keys, whose numbers are arbitrary."""
    employees = dim_employee.select("employee_key", "employee_id")
    departments = dim_department.select("department_key", "department_id")
    return (
        fact_table.join(employees, "employee_key")
        .join(departments, "department_key")
        .drop("employee_key", "department_key", "transaction_key")
    )


_QUERIES: dict[str, Callable[[Sample], DataFrame]] = {}


def _query(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Sample], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Sample(spark, sf_dir))

    return {name: bind(build) for name, build in _QUERIES.items()}


# Sources and staging


@_query
def incremental_scan(s: Sample) -> DataFrame:
    return s.window


@_query
def backfill_scan(s: Sample) -> DataFrame:
    return period(s.transactions, *BACKFILL)


@_query
def database_slices(s: Sample) -> DataFrame:
    """The conditions of a database read that ends a slice with each month's last row, and what each of them reads."""
    month = F.date_trunc("month", F.col("last_updated_at"))
    last = F.max(F.struct("last_updated_at", "source_row_id")).alias("last")
    ends = [r["last"] for r in s.window.groupBy(month.alias("month")).agg(last).orderBy("month").collect()]
    conditions = slice_predicates(WINDOW_START, AS_OF, [tuple(end) for end in ends[:-1]])
    which = [F.when(F.expr(c.replace("TIMESTAMP ", "TIMESTAMP_NTZ ")), i) for i, c in enumerate(conditions)]
    met = s.transactions.withColumn("slice", F.explode(F.array_compact(F.array(*which))))
    return met.groupBy("slice").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("last_updated_at").alias("first"), F.max("last_updated_at").alias("last")
    )


@_query
def current_watermarks(s: Sample) -> DataFrame:
    """A control history, one pipeline per region and one commit per year, reduced to its current rows."""
    commits = s.transactions.groupBy(
        F.col("region_code").alias("pipeline_name"), F.year("created_at").cast("bigint").alias("seq")
    ).agg(F.max("last_updated_at").alias("last_successful_watermark"))
    return latest_commits(commits)


@_query
def staged_batch(s: Sample) -> DataFrame:
    return s.stage(s.window, "transactions_raw")


@_query
def employees_sheet(s: Sample) -> DataFrame:
    """A CSV sheet with a foreign header, read back by position."""
    path = f"{s.warehouse.root}/employees.csv"
    sheet = s.employees.toDF(*[f"Column {i}" for i in range(len(schemas.EMPLOYEES))])
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    sheet.write.options(header=True, escape='"', **spaces).csv(path)
    return sheets.read_employees(s.spark, path, "csv")


@_query
def departments_sheet(s: Sample) -> DataFrame:
    path = f"{s.warehouse.root}/departments.parquet"
    s.departments.toDF(*[f"column_{i}" for i in range(len(schemas.DEPARTMENTS))]).write.parquet(path)
    return sheets.read_departments(s.spark, path)


@_query
def sheet_cells(s: Sample) -> DataFrame:
    """NaN, unreadable and empty cells next to good ones."""
    cells = fixtures.table(s.spark, s.sf_dir, "customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_custkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END",
        "CASE WHEN c_custkey % 5 = 0 THEN 'n/a' WHEN c_custkey % 5 = 1 THEN NULL ELSE '1999-01-0' || (c_custkey % 5) END",
        "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END",
    )
    contract = T.StructType.fromDDL("cell_id BIGINT, balance DOUBLE, hired DATE, name STRING")
    return sheets.bind_sheet(cells, contract, strict=False)


@_query
def contract_violations(s: Sample) -> DataFrame:
    """Keys that break the uniqueness and reference rules of the raw tables."""
    known_departments = s.departments.where("department_id IS NOT NULL")
    broken = {
        "unique transaction source_row_id": schemas.duplicate_keys(s.transactions, "source_row_id"),
        "unique transaction transaction_id": schemas.duplicate_keys(s.transactions, "transaction_id"),
        "unique employee employee_id": schemas.duplicate_keys(s.employees, "employee_id"),
        "known department of employee": schemas.orphan_keys(
            s.employees, "department_id", known_departments, "department_id"
        ),
        "known employee of transaction": schemas.orphan_keys(
            s.transactions, "employee_id", s.employees, "employee_id"
        ),
    }
    counted = validation.tally(broken)
    return counted.unpivot([], list(broken), "rule", "violations")


# Expressions


@_query
def text_expressions(s: Sample) -> DataFrame:
    return s.transactions.select(
        "source_row_id",
        F.trim("transaction_id").alias("trimmed"),
        F.upper("employee_id").alias("upper_id"),
        F.lower("priority").alias("lower_priority"),
        F.replace(F.col("priority"), F.lit("-"), F.lit(" ")).alias("spaced_priority"),
        F.lpad(F.col("source_row_id").cast("string"), 3, "0").alias("cut_row_id"),
        F.concat(F.lit("ROW"), F.lpad(F.col("source_row_id").cast("string"), 12, "0")).alias("row_code"),
        F.concat(F.col("employee_id"), F.lit("/"), F.col("status")).alias("null_spreads"),
        F.element_at(F.array(*map(F.lit, "abcd")), (F.col("source_row_id") % 4 + 1).cast("int")).alias("letter"),
        F.lit("CORE_TXN_DB").alias("constant"),
    )


@_query
def predicate_expressions(s: Sample) -> DataFrame:
    at = n.ntz(AS_OF)
    return s.transactions.select(
        "source_row_id",
        F.col("transaction_id").like("TXN-%9").alias("ends_in_nine"),
        F.col("employee_id").isNull().alias("no_employee"),
        F.col("completed_at").isNotNull().alias("is_completed"),
        (~F.col("status").isin(*n.TRANSACTION_STATUSES)).alias("odd_status"),
        (F.col("received_at").isNull() | (F.col("received_at") >= F.col("created_at"))).alias("received_in_order"),
        (F.col("created_at") > at).alias("in_future"),
        (F.col("amount") < 0).alias("is_negative"),
        (F.col("completed_at") > F.col("due_at")).alias("completed_late"),
    )


@_query
def mapped_values(s: Sample) -> DataFrame:
    """Every raw classification and status with its canonical form."""
    pairs = [("classification", n.classification("classification")), ("status", n.transaction_status("status"))]
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("attribute"), F.col(name).alias("raw_value"), mapped.alias("mapped_value"))
            for name, mapped in pairs
        ]
    )
    exploded = s.transactions.select(F.inline(rows))
    return exploded.groupBy("attribute", "raw_value", "mapped_value").agg(F.count(F.lit(1)).alias("row_count"))


@_query
def mapped_employee_values(s: Sample) -> DataFrame:
    return s.employees.select(
        "employee_id",
        "source_updated_at",
        n.employment_status("employment_status").alias("employment_status"),
        n.email("email").alias("email"),
    )


@_query
def due_by_priority(s: Sample) -> DataFrame:
    return s.transactions.select(
        "source_row_id",
        measures.due_by_priority("created_at", "priority", SAMPLE_DUE_DAYS).alias("due_at"),
        (F.col("created_at") - F.make_dt_interval(hours=F.lit(1))).alias("hour_before"),
    )


@_query
def status_timeline(s: Sample) -> DataFrame:
    return timeline.status_timeline(s.transactions)


# Joins


@_query
def employee_department_match(s: Sample) -> DataFrame:
    matched = reference.match_departments(s.employees, s.departments_clean, "left")
    return matched.select("employee_id", "department_id", "source_updated_at", "matched_department_id")


@_query
def employee_with_department(s: Sample) -> DataFrame:
    matched = reference.match_departments(reference.latest_employees(s.employees), s.departments_clean, "inner")
    return matched.select("employee_id", "matched_department_id")


@_query
def transaction_employee_match(s: Sample) -> DataFrame:
    matched = transactions.match_employees(s.transactions, s.employees_clean)
    return matched.select("source_row_id", "employee_id", "matched_employee_id")


@_query
def transaction_with_employee(s: Sample) -> DataFrame:
    matched = transactions.match_employees(s.transactions, s.employees_clean, "inner")
    return matched.select("source_row_id", "matched_employee_id")


@_query
def heavy_employees(s: Sample) -> DataFrame:
    """Employees with more transactions than a task is meant to take here, and over how many salts they are dealt."""
    heavy = transactions.heavy_employees(s.transactions, s.transactions.count(), ROWS_PER_SALT)
    return heavy.select(F.col(salted.KEY).alias("employee_id"), F.col(salted.SALTS).alias("salts"))


@_query
def transaction_employee_match_salted(s: Sample) -> DataFrame:
    raw, _ = s.staged(s.transactions)
    heavy = transactions.heavy_employees(raw, raw.count(), ROWS_PER_SALT)
    matched = transactions.match_employees(raw, s.employees_clean, heavy=heavy)
    return matched.select("source_row_id", "employee_id", "matched_employee_id")


@_query
def employee_department_keys(s: Sample) -> DataFrame:
    """Key lookup of the employee dimension, shown by the department the key stands for."""
    keyed = dimensions.employee_rows(s.employees_clean, s.dim_department)
    named = s.dim_department.select("department_key", "department_id", "sector")
    return keyed.join(named, "department_key").select("employee_id", "department_id", "sector")


@_query
def fact_key_lookup_salted(s: Sample) -> DataFrame:
    s.staged_reference
    clean = s.stage(s.clean, "clean")
    heavy = transactions.heavy_employees(clean, clean.count(), ROWS_PER_SALT)
    rows = fact.fact_rows(clean, s.dim_employee, AS_OF, heavy)
    employees = s.dim_employee.select("employee_key", "employee_id")
    departments = s.dim_department.select("department_key", "department_id")
    named = rows.join(employees, "employee_key").join(departments, "department_key")
    return named.select("transaction_id", "employee_id", "department_id")


@_query
def fact_key_lookup(s: Sample) -> DataFrame:
    s.staged_reference
    rows = fact.fact_rows(s.clean, s.dim_employee, AS_OF)
    employees = s.dim_employee.select("employee_key", "employee_id")
    departments = s.dim_department.select("department_key", "department_id")
    named = rows.join(employees, "employee_key").join(departments, "department_key")
    return named.select("transaction_id", "employee_id", "department_id")


@_query
def loaded_from_batch(s: Sample) -> DataFrame:
    """Clean rows of the first load's batch that are in the fact of a later, overlapping one."""
    s.staged_reference
    earlier = transactions.transactions_clean(
        s.judged(incremental_window(s.transactions, datetime(1997, 1, 1), EARLIER), EARLIER)
    )
    return validation.tally({"loaded_count": validation.loaded_rows(earlier, s.first_load(s.window_clean))})


@_query
def unknown_departments(s: Sample) -> DataFrame:
    return quality.unknown_key_count(s.employees, "department_id", s.departments, "employees_invalid_department")


@_query
def unknown_employees(s: Sample) -> DataFrame:
    return quality.unknown_key_count(s.transactions, "employee_id", s.employees, "transactions_unknown_employee")


# Aggregations and ranks


@_query
def table_counts(s: Sample) -> DataFrame:
    return validation.tally(
        {
            "transactions": s.transactions,
            "employees": s.employees,
            "departments": s.departments,
            "window_rows": s.window,
            "distinct_employee_ids": s.employees.select("employee_id").distinct(),
        }
    )


@_query
def repeated_transaction_ids(s: Sample) -> DataFrame:
    return schemas.duplicate_keys(s.transactions, "transaction_id")


@_query
def next_watermark(s: Sample) -> DataFrame:
    return validation.next_watermark(s.window)


@_query
def latest_employees(s: Sample) -> DataFrame:
    return reference.latest_employees(s.employees)


@_query
def duplicate_transactions(s: Sample) -> DataFrame:
    flagged = transactions.flag_duplicates(*s.staged(s.transactions))
    return flagged.select("source_row_id", "transaction_id", "is_duplicate")


@_query
def duplicate_transactions_in_window(s: Sample) -> DataFrame:
    flagged = transactions.flag_duplicates(*s.staged(s.window))
    return flagged.select("source_row_id", "transaction_id", "is_duplicate")


@_query
def duplicate_transactions_unstaged(s: Sample) -> DataFrame:
    flagged = transactions.flag_duplicates(s.transactions)
    return flagged.select("source_row_id", "transaction_id", "is_duplicate")


# Quality report


@_query
def quality_report(s: Sample) -> DataFrame:
    return quality.quality_report(s.transactions, s.employees, s.departments, AS_OF, TODAY)


@_query
def quality_total(s: Sample) -> DataFrame:
    return quality.total_issues(quality_report(s))


@_query
def employee_rule_counts(s: Sample) -> DataFrame:
    return quality.rule_counts(s.employees, quality.employee_rules(TODAY))


@_query
def transaction_rule_counts(s: Sample) -> DataFrame:
    return quality.rule_counts(s.transactions, quality.transaction_rules(AS_OF))


# Cleaning


@_query
def departments_clean(s: Sample) -> DataFrame:
    return s.departments_clean


@_query
def employees_clean(s: Sample) -> DataFrame:
    return s.employees_clean


@_query
def employees_rejected(s: Sample) -> DataFrame:
    return s.employees_rejected


@_query
def employee_rejection_summary(s: Sample) -> DataFrame:
    return transactions.rejection_summary(s.employees_rejected)


@_query
def employee_accounting(s: Sample) -> DataFrame:
    return reference.employee_accounting(s.employees, s.employees_clean, s.employees_rejected)


@_query
def transaction_verdicts(s: Sample) -> DataFrame:
    return s.judged(s.transactions).select("source_row_id", "outcome", "rejection_reason")


@_query
def transaction_verdicts_in_window(s: Sample) -> DataFrame:
    return s.judged(s.window).select("source_row_id", "outcome", "rejection_reason")


@_query
def transactions_clean(s: Sample) -> DataFrame:
    return s.clean


@_query
def transactions_rejected(s: Sample) -> DataFrame:
    return transactions.transactions_rejected(s.judged(s.transactions))


@_query
def transactions_rejected_of_all(s: Sample) -> DataFrame:
    return transactions.transactions_rejected(s.judged(s.transactions))


@_query
def transactions_settled(s: Sample) -> DataFrame:
    """Both sets as one staged table, partitioned by outcome and read back."""
    settled = transactions.settle(s.judged(s.transactions))
    return s.warehouse.stage(settled, "query", "transactions", ["outcome"]).select(*settled.columns)


@_query
def rejection_summary(s: Sample) -> DataFrame:
    by_year = s.judged(s.transactions).withColumn("batch_year", F.year("last_updated_at"))
    rejected = by_year.where(F.col("outcome") == transactions.REJECTED)
    return transactions.rejection_summary(rejected, "batch_year")


def _rejected_for(reason: str) -> None:
    def build(s: Sample) -> DataFrame:
        rejected = transactions.transactions_rejected(s.judged(s.transactions))
        return rejected.where(F.col("rejection_reason") == reason)

    _QUERIES[f"rejected_{reason.lower()}"] = build


for _reason in transactions.REASONS:
    _rejected_for(_reason)


@_query
def transactions_unaccounted(s: Sample) -> DataFrame:
    judged = s.judged(s.transactions)
    return judged.where(F.col("outcome") == transactions.UNACCOUNTED).drop("outcome", "rejection_reason")


# Dimensions and fact


@_query
def dim_department_upsert(s: Sample) -> DataFrame:
    """Some sectors first, then an overlapping set: kept, overwritten and new rows."""
    rows = dimensions.department_rows(s.departments_clean)
    first = rows.where(F.col("sector").isin(*FIRST_SECTORS)).withColumns(
        {"department_name": F.concat("department_name", F.lit(" (old)")), "cost_center": F.lit("OLD")}
    )
    target = upsert(
        empty(s.spark, schemas.DIM_DEPARTMENT), first, "department_id", "department_key", 0, SLOTS
    ).select(*schemas.DIM_DEPARTMENT.names)
    later = rows.where(F.col("sector").isin(*LATER_SECTORS)).withColumn(
        "location", F.when(F.col("sector") != "ASIA", F.col("location"))
    )
    merged = upsert(target, later, "department_id", "department_key", 10**6, SLOTS)
    kept = F.when(F.col("department_key") <= 10**6, "kept").otherwise("new")
    return merged.withColumn("key_origin", kept).drop("department_key", "slot")


@_query
def dim_employee_upsert(s: Sample) -> DataFrame:
    first = s.employees_clean.where(FIRST_EMPLOYEES).withColumns(
        {"job_title": F.lit("TRAINEE"), "grade": F.lit("G0")}
    )
    target = upsert(
        empty(s.spark, schemas.DIM_EMPLOYEE), dimensions.employee_rows(first, s.dim_department),
        "employee_id", "employee_key", 0, SLOTS,
    ).select(*schemas.DIM_EMPLOYEE.names)
    later = dimensions.employee_rows(s.employees_clean.where(LATER_EMPLOYEES), s.dim_department)
    merged = upsert(target, later, "employee_id", "employee_key", 10**12, SLOTS)
    departments = s.dim_department.select("department_key", "department_id")
    kept = F.when(F.col("employee_key") <= 10**12, "kept").otherwise("new")
    named = merged.withColumn("key_origin", kept).join(departments, "department_key")
    return named.drop("employee_key", "department_key", "slot")


@_query
def fact_first_load(s: Sample) -> DataFrame:
    s.staged_reference
    return with_business_keys(s.first_load(s.clean), s.dim_employee, s.dim_department)


def _two_loads(s: Sample) -> tuple[DataFrame, DataFrame]:
    """The fact of an earlier load, and the rows of a later one that overlaps it."""
    s.staged_reference
    earlier = incremental_window(s.transactions, datetime(1997, 1, 1), EARLIER)
    target = s.stage(
        s.first_load(transactions.transactions_clean(s.judged(earlier, EARLIER)), EARLIER), "fact_transactions"
    )
    return target, fact.fact_rows(s.window_clean, s.dim_employee, AS_OF)


@_query
def fact_upsert(s: Sample) -> DataFrame:
    target, later = _two_loads(s)
    merged = upsert(target, later, "transaction_id", "transaction_key", 10**12, SLOTS)
    origin = F.when(F.col("transaction_key") <= 10**12, "kept").otherwise("new")
    return with_business_keys(merged.withColumn("key_origin", origin).drop("slot"), s.dim_employee, s.dim_department)


@_query
def rows_upserted(s: Sample) -> DataFrame:
    """Inserted plus updated rows, and how many of them were inserted."""
    target, later = _two_loads(s)
    merged = upsert(target, later, "transaction_id", "transaction_key", 10**12, SLOTS)
    return validation.tally({"affected": later, "inserted": merged.where(F.col("transaction_key") > 10**12)})


@_query
def surrogate_keys(s: Sample) -> DataFrame:
    """Keys are unique, stable for known rows, and above all earlier ones for new rows."""
    target, later = _two_loads(s)
    merged = upsert(target, later, "transaction_id", "transaction_key", 10**12, SLOTS)
    before = target.select("transaction_id", F.col("transaction_key").alias("earlier_key"))
    both = merged.join(before, "transaction_id", "left")
    per_key = both.groupBy("transaction_key").agg(
        F.count(F.lit(1)).alias("uses"),
        F.count_if(F.col("earlier_key") == F.col("transaction_key")).alias("stable"),
        F.count_if(F.col("earlier_key").isNull() & (F.col("transaction_key") > 10**12)).alias("above"),
    )
    return per_key.agg(
        F.sum("uses").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum("stable").alias("stable_keys"),
        F.sum("above").alias("new_keys"),
    )


@_query
def foreign_key_violations(s: Sample) -> DataFrame:
    s.staged_reference
    return validation.orphan_counts(s.first_load(s.clean), s.dim_employee, s.dim_department)


@_query
def foreign_key_violations_after_loss(s: Sample) -> DataFrame:
    """The same check against dimensions that lost a sector."""
    s.staged_reference
    remaining = s.dim_department.where(F.col("sector") != "ASIA")
    return validation.orphan_counts(s.first_load(s.clean), s.dim_employee.where("grade <> 'G3'"), remaining)


@_query
def fact_measures(s: Sample) -> DataFrame:
    measured = fact.with_measures(s.clean, AS_OF)
    return measured.select("transaction_id", "created_at", "completed_at", "due_at", "cycle_hours", "sla_breached")


@_query
def cycle_hours_of_all(s: Sample) -> DataFrame:
    """Over the raw rows, so that negative durations and open rows occur too."""
    return s.transactions.select(
        "source_row_id",
        measures.cycle_hours("created_at", "completed_at").alias("cycle_hours"),
        measures.sla_breached("due_at", "completed_at", n.ntz(AS_OF)).alias("sla_breached"),
    )


@_query
def sla_by_department(s: Sample) -> DataFrame:
    s.staged_reference
    rows = fact.fact_rows(s.clean, s.dim_employee, AS_OF)
    return fact.sla_by_department(rows, s.dim_department)


# Validation, control and whole runs


@_query
def batch_counts(s: Sample) -> DataFrame:
    s.staged_reference
    judged = s.stage(s.judged(s.transactions), "judged")
    clean = transactions.transactions_clean(judged)
    return validation.batch_counts(
        s.transactions, clean, transactions.transactions_rejected(judged), s.first_load(clean), s.dim_employee, s.dim_department
    )


@_query
def batch_gates(s: Sample) -> DataFrame:
    return validation.gates(batch_counts(s))


@_query
def batch_gates_of_all(s: Sample) -> DataFrame:
    """The whole table as one batch holds rows that are in neither set, which a gate must notice."""
    s.staged_reference
    judged = s.stage(s.judged(s.transactions), "judged")
    clean = transactions.transactions_clean(judged)
    counts = validation.batch_counts(
        s.transactions, clean, transactions.transactions_rejected(judged), s.first_load(clean),
        s.dim_employee.where("false"), s.dim_department,
    )
    return validation.gates(counts)


@_query
def control_after_run(s: Sample) -> DataFrame:
    s.run()
    return s.warehouse.control().select(
        "pipeline_name", "seq", "last_successful_watermark", "last_successful_run",
        F.aggregate("fact_transactions", F.lit(0).cast("bigint"), lambda a, s: a + s["row_count"] - s["replacing"])
        .alias("fact_rows"),
    )


@_query
def control_after_empty_run(s: Sample) -> DataFrame:
    """A second run finds nothing: the time of the run moves, the watermark does not."""
    s.run(as_of=EARLIER)
    run_incremental(s.warehouse, s.transactions.where("false"), s.employees, s.departments, AS_OF)
    return latest_commits(s.warehouse.control()).select(
        "pipeline_name", "seq", "last_successful_watermark", "last_successful_run"
    )


@_query
def loaded_fact(s: Sample) -> DataFrame:
    s.run()
    return s.business_fact()


@_query
def loaded_dim_employee(s: Sample) -> DataFrame:
    s.run()
    commit = s.warehouse.latest()
    departments = s.warehouse.dim_department(commit).select("department_key", "department_id")
    return s.warehouse.dim_employee(commit).join(departments, "department_key").drop("department_key", "employee_key")


@_query
def loaded_dim_department(s: Sample) -> DataFrame:
    s.run()
    return s.warehouse.dim_department().drop("department_key")


@_query
def loaded_quality_report(s: Sample) -> DataFrame:
    """The report a run leaves in staging, over its batch."""
    result = s.run()
    report = T.StructType.fromDDL("check_name STRING, issue_count BIGINT")
    return s.warehouse.staged(result.run_id, "quality_report", report)


@_query
def fact_after_two_windows(s: Sample) -> DataFrame:
    s.run(watermark=datetime(1997, 1, 1), as_of=EARLIER)
    run_incremental(s.warehouse, s.transactions, s.employees, s.departments, AS_OF)
    return s.business_fact()


@_query
def fact_after_same_batch_twice(s: Sample) -> DataFrame:
    s.run()
    commit = s.warehouse.latest()
    load_batch(s.warehouse, commit, s.window, s.employees, s.departments, AS_OF, new_run_id("again"))
    return s.business_fact()


@_query
def fact_after_backfill(s: Sample) -> DataFrame:
    s.run()
    run_backfill(s.warehouse, s.transactions, s.employees, s.departments, *BACKFILL, AS_OF)
    return s.business_fact()


@_query
def fact_after_stream(s: Sample) -> DataFrame:
    """The window arriving as one file set per update year, loaded in order of the years."""
    source = f"{s.warehouse.root}/arrivals"
    s.warehouse.register(WINDOW_START)
    window = s.stage(s.window, "window")
    years = window.select(F.year("last_updated_at").alias("year")).distinct().orderBy("year").collect()
    for (year,) in years:
        arrived = window.where(F.year("last_updated_at") == year)
        arrived.write.mode("append").parquet(source)
        query = stream_transactions(
            s.warehouse, source, s.employees, s.departments, f"{s.warehouse.root}/stream_checkpoint", as_of=AS_OF
        )
        query.awaitTermination()
    return s.business_fact()
