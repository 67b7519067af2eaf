"""Headline timings as one JSON line.

The source table and the two sheets are written first, untimed: they stand for the source database
and the workbook. Then, each into a new warehouse: a full load, and an incremental batch of about
one per cent on top of it. The first pair starts on a cold JVM and is reported as such; the value is
the second pair. Single operators are timed over the views of the sample tables, written to a sink
that discards them.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame

from millrace.plans import catalog
from millrace.plans.load import RunResult, run_incremental
from millrace.session import local_session
from millrace.sources import fixtures, sheets
from millrace.sources.warehouse import Warehouse, shared_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
BEGINNING, CUT, END = datetime(1900, 1, 1), datetime(2000, 12, 20), fixtures.AS_OF
OPERATORS = (
    "quality_report", "departments_clean", "employees_clean", "employees_rejected", "transaction_verdicts",
    "transactions_clean", "rejection_summary", "status_timeline", "fact_first_load", "fact_upsert", "sla_by_department",
)


def timed(action) -> tuple[float, object]:
    start = time.monotonic()
    result = action()
    return round(time.monotonic() - start, 3), result


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS)
    scratch = f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"
    fixtures.transactions_raw(spark, SF_DIR).repartition(CPUS).write.parquet(f"{scratch}/transactions")
    fixtures.employees_raw(spark, SF_DIR).write.parquet(f"{scratch}/employees")
    fixtures.departments_raw(spark, SF_DIR).write.parquet(f"{scratch}/departments")
    source = spark.read.parquet(f"{scratch}/transactions")
    employees = sheets.read_employees(spark, f"{scratch}/employees")
    departments = sheets.read_departments(spark, f"{scratch}/departments")

    queries: dict[str, float] = {}
    rows: dict[str, int] = {}

    def load(label: str) -> None:
        warehouse = Warehouse(spark, f"{scratch}/{label or 'warm'}")
        warehouse.register(BEGINNING)
        for name, until in (("full_load", CUT), ("incremental", END)):
            seconds, result = timed(lambda: run_incremental(warehouse, source, employees, departments, until))
            queries[f"{name}{label}"] = seconds
            if not label:
                report(name, result)

    def report(name: str, result: RunResult) -> None:
        queries.update({f"{name}.{step}": s for step, s in result.seconds.items()})
        rows.update({f"{name}.{count}": n for count, n in result.counts.items()})

    load("_cold")
    load("")
    known = catalog.queries()
    for name in OPERATORS:
        queries[name], _ = timed(lambda: discard(known[name](spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "full load plus one-per-cent incremental load",
                "value": round(queries["full_load"] + queries["incremental"], 3),
                "unit": "sec",
                "queries": queries,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
                "cpus": CPUS,
                "rows": rows,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
