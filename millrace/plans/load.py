"""The whole load of one batch: stage, check, clean, load, validate, publish."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import dimensions, fact, quality, reference, transactions, validation
from millrace.operators.upsert import require_unique, slots_for, versions
from millrace.sources.incremental import Database, incremental_window, period, run_clock
from millrace.sources.segments import SegmentTable, live_rows
from millrace.sources.warehouse import ControlError, Warehouse


class ForeignKeyViolation(Exception):
    """A stored key has no parent row."""


@dataclass
class RunResult:
    run_id: str
    commit: Row | None
    counts: dict[str, int]
    seconds: dict[str, float] = field(default_factory=dict)


def new_run_id(kind: str) -> str:
    return f"{kind}-{uuid.uuid4().hex}"


def run_incremental(
    warehouse: Warehouse,
    source: DataFrame,
    employees: DataFrame,
    departments: DataFrame,
    as_of: datetime | None = None,
    day_column: str | None = None,
) -> RunResult:
    """Load everything updated since the watermark and move the watermark."""
    as_of = as_of or run_clock(warehouse.spark)
    parent = warehouse.watermark()
    batch = incremental_window(source, parent["last_successful_watermark"], as_of, day_column)
    return load_batch(warehouse, parent, batch, employees, departments, as_of, new_run_id("incremental"))


def run_from_database(
    warehouse: Warehouse,
    database: Database,
    employees: DataFrame,
    departments: DataFrame,
    slices: int,
    table: str = "source_transactions",
) -> RunResult:
    """``run_incremental`` on a database, by its clock and in slices of equally many rows.

    Update times are given by the source, so its clock bounds the window: a clock here that is ahead would
    move the watermark past rows not yet written.
    """
    as_of = database.clock(warehouse.spark)
    parent = warehouse.watermark()
    batch = database.changed(warehouse.spark, parent["last_successful_watermark"], as_of, slices, table)
    return load_batch(warehouse, parent, batch, employees, departments, as_of, new_run_id("incremental"))


def run_backfill(
    warehouse: Warehouse,
    source: DataFrame,
    employees: DataFrame,
    departments: DataFrame,
    start: datetime,
    end: datetime,
    as_of: datetime | None = None,
    day_column: str | None = None,
) -> RunResult:
    """Reprocess the rows updated in ``[start, end)``.

    The watermark stays, and a fact row is only replaced by a version that is not older.
    """
    as_of = as_of or run_clock(warehouse.spark)
    parent = warehouse.latest()
    if parent is None:
        raise ControlError("ETL_CONTROL_RECORD_NOT_FOUND")
    batch = period(source, start, end, day_column)
    return load_batch(
        warehouse, parent, batch, employees, departments, as_of, new_run_id("backfill"),
        move_watermark=False, newer_wins=True,
    )


def load_batch(
    warehouse: Warehouse,
    parent: Row,
    batch: DataFrame,
    employees: DataFrame,
    departments: DataFrame,
    as_of: datetime,
    run_id: str,
    move_watermark: bool = True,
    lower_watermark: bool = True,
    newer_wins: bool = False,
) -> RunResult:
    """Process one batch on top of a commit and publish it.

    An error in any step leaves readers on the parent commit and the watermark where it was. The
    new watermark is the greatest update time of the batch; ``move_watermark`` off keeps the old
    one, ``lower_watermark`` off keeps the greater of the two.
    """
    seconds: dict[str, float] = {}
    today = as_of.date()

    def stage(df: DataFrame, table: str, *partition_by: str) -> DataFrame:
        return warehouse.stage(df, run_id, table, partition_by)

    with ThreadPoolExecutor(max_workers=8) as pool:
        # The reference tables are cleaned while the transactions are still being staged.
        departments_staging = pool.submit(lambda: stage(departments, "departments_raw"))
        employees_staging = pool.submit(lambda: stage(employees, "employees_raw"))
        staging = pool.submit(lambda: stage(transactions.with_row_id(batch), "transactions_raw"))

        # Needed later, read from staging as soon as it is there.
        repeating = pool.submit(lambda: stage(transactions.repeated_ids(staging.result()), "transactions_repeated"))
        dealing = pool.submit(lambda: _heavy_employees(staging.result(), stage))
        watermarking = pool.submit(lambda: validation.next_watermark(staging.result()).first()["next_watermark"])

        with _timed(seconds, "clean_reference"):
            departments_raw = departments_staging.result()
            departments_clean = stage(reference.departments_clean(departments_raw), "departments_clean")
            require_unique(departments_clean, "department_id", "dim_department")
            departing = pool.submit(
                lambda: _appended(
                    warehouse.departments, parent, dimensions.department_rows(departments_clean), departments_clean.count(),
                    run_id, changed_only=True,
                )
            )
            employees_raw = employees_staging.result()
            rejecting = pool.submit(
                lambda: stage(
                    reference.employees_rejected(employees_raw, departments_clean, today), "employees_rejected"
                )
            )
            employees_clean = stage(reference.employees_clean(employees_raw, departments_clean, today), "employees_clean")

        with _timed(seconds, "extract"):
            raw = staging.result()
        reporting = pool.submit(
            lambda: stage(
                quality.quality_report(raw, employees_raw, departments_raw, as_of, today), "quality_report"
            )
        )

        checking = pool.submit(
            lambda: require_unique(employees_clean.where("employee_id IS NOT NULL"), "employee_id", "dim_employee")
        )

        def load_employees() -> list:
            with _timed(seconds, "dimensions"):
                dim_department = warehouse.departments.read(departing.result())
                rows = dimensions.employee_rows(employees_clean, dim_department)
                return _appended(warehouse.employees, parent, rows, employees_clean.count(), run_id, changed_only=True)

        employing = pool.submit(load_employees)
        with _timed(seconds, "clean_transactions"):
            judged = transactions.verdicts(raw, employees_clean, as_of, repeating.result(), dealing.result())
            settled = stage(transactions.settle(judged), "transactions", "outcome")
            clean = settled.where(F.col("outcome") == transactions.CLEAN)
            rejected = settled.where(F.col("outcome") == transactions.REJECTED)
            checking.result()
            require_unique(clean, "transaction_id", "fact_transactions")

        dim_department = warehouse.departments.read(departing.result())
        dim_employee = warehouse.employees.read(employing.result())
        with _timed(seconds, "fact"):
            rows = fact.fact_rows(clean, dim_employee, as_of, dealing.result())
            facts = _appended(
                warehouse.facts, parent, rows, clean.count(), run_id, newer_wins="last_updated_at" if newer_wins else None
            )
            appended = [s for s in facts if s not in parent["fact_transactions"]]
            written = warehouse.facts.read(appended)

        with _timed(seconds, "validation"):
            # What the batch didn't append is unchanged; rows that an older version kept out are held before.
            loaded = written
            if newer_wins:
                held = warehouse.facts.current(parent["fact_transactions"], clean.select("transaction_id"), clean.count())
                loaded = written.select("transaction_id").unionByName(held.join(written, "transaction_id", "left_anti").select("transaction_id"))
            counts, orphans = _together(
                pool,
                lambda: validation.batch_counts(raw, clean, rejected, loaded, dim_employee, dim_department).first().asDict(),
                lambda: validation.orphan_counts(written, dim_employee, dim_department).first().asDict(),
            )
            counts["fact_count"] = live_rows(facts)
            validation.require_valid(counts)
            if any(orphans.values()):
                raise ForeignKeyViolation(str(orphans))

        reporting.result()
        rejecting.result()
        watermark = watermarking.result()
        held_watermark = parent["last_successful_watermark"]
        if not move_watermark:
            watermark = None
        elif watermark and held_watermark and not lower_watermark:
            watermark = max(watermark, held_watermark)
        with _timed(seconds, "publish"):
            state = {"dim_department": departing.result(), "dim_employee": employing.result(), "fact_transactions": facts}
            tables = {t.name: t for t in warehouse.tables}
            merged = _together(pool, *[lambda n=n, held=held: tables[n].merged(held, run_id) for n, held in state.items()])
            last = {f"last_{key}_key": max([parent[f"last_{key}_key"], *[s["last_key"] for s in held]]) for key, held in zip(("department", "employee", "transaction"), state.values(), strict=True)}
            commit = warehouse.publish(parent, run_id, watermark, as_of, **last, **dict(zip(state, merged, strict=True)))
    return RunResult(run_id, commit, counts, seconds)


def _heavy_employees(raw: DataFrame, stage: Callable[..., DataFrame]) -> DataFrame | None:
    heavy = transactions.heavy_employees(raw, raw.count())
    return None if heavy is None else stage(heavy, "employees_heavy")


def _appended(
    table: SegmentTable,
    parent: Row,
    rows: DataFrame,
    row_count: int,
    run_id: str,
    newer_wins: str | None = None,
    changed_only: bool = False,
) -> list:
    """The segments of a table after an upsert; at most one more, none if nothing is to be written."""
    held = list(parent[table.name] or [])
    if not row_count:
        return held
    if changed_only:
        # a reference table comes as a whole each time
        current = table.read(held)
    else:
        current = table.current(held, rows.select(table.business_key), row_count, *([newer_wins] if newer_wins else []))
    last_key = parent[f"last_{table.surrogate_key}"]
    new = versions(current, rows, table.business_key, table.surrogate_key, last_key, slots_for(row_count), newer_wins, changed_only)
    segment = table.append(new, run_id, row_count)
    return [*held, segment] if segment["row_count"] else held


def _together(pool: ThreadPoolExecutor, *steps: Callable) -> list:
    """Results of independent steps, whose jobs run side by side."""
    return [pending.result() for pending in [pool.submit(step) for step in steps]]


@contextmanager
def _timed(seconds: dict[str, float], step: str) -> Iterator[None]:
    start = time.monotonic()
    yield
    seconds[step] = round(time.monotonic() - start, 3)
