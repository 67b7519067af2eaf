"""Known numbers of the sample views at the smallest scale."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import fact, quality
from millrace.plans.catalog import AS_OF, TODAY, Sample

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sample(spark):
    return Sample(spark, SMALLEST)


def _verdicts(judged):
    key = F.coalesce("rejection_reason", "outcome")
    return {r[0]: r[1] for r in judged.groupBy(key.alias("verdict")).count().collect()}


def test_reference_tables(sample):
    assert sample.departments.count() == 30 and sample.departments_clean.count() == 25
    assert sample.employees.count() == 164 and sample.employees_clean.count() == 136
    by_status = {r[0]: r[1] for r in sample.employees_clean.groupBy("employment_status").count().collect()}
    assert by_status == {None: 23, " Terminated ": 21, "Active": 27, "Inactive": 23, "On Leave": 42}
    assert sample.employees_clean.where("job_title = 'OLD TITLE'").count() == 5


def test_verdicts_of_the_whole_table(sample):
    assert _verdicts(sample.judged(sample.transactions)) == {
        "clean": 1195, "MISSING_TRANSACTION_ID": 2, "DUPLICATE_TRANSACTION": 9, "MISSING_EMPLOYEE": 8,
        "UNKNOWN_EMPLOYEE": 138, "NULL_AMOUNT": 6, "NEGATIVE_AMOUNT": 3, "RECEIVED_BEFORE_CREATED": 13,
        "COMPLETED_BEFORE_CREATED": 9, "UPDATED_BEFORE_CREATED": 11, "FUTURE_TRANSACTION": 103, "unaccounted": 3,
    }


def test_verdicts_of_the_window(sample):
    assert _verdicts(sample.judged(sample.window)) == {
        "clean": 612, "MISSING_TRANSACTION_ID": 2, "MISSING_EMPLOYEE": 4, "UNKNOWN_EMPLOYEE": 62, "NULL_AMOUNT": 6,
        "RECEIVED_BEFORE_CREATED": 4, "COMPLETED_BEFORE_CREATED": 2, "UPDATED_BEFORE_CREATED": 4,
    }


def test_measures_of_the_window(sample):
    row = fact.with_measures(sample.window_clean, AS_OF).agg(
        F.sum("amount"), F.count("cycle_hours"), F.sum("cycle_hours"), F.count("sla_breached"), F.count_if("sla_breached")
    ).first()
    assert tuple(row) == (Decimal("155100709.70"), 206, Decimal("27671.18"), 606, 518)


def test_quality_report(sample):
    report = quality.quality_report(sample.transactions, sample.employees, sample.departments, AS_OF, TODAY)
    assert {r[0]: r[1] for r in report.collect()} == {
        "duplicate_employee_ids": 14, "employees_missing_department": 4, "employees_invalid_department": 33,
        "employees_bad_email": 34, "employees_future_hire_date": 6, "employees_non_standard_status": 100,
        "duplicate_transaction_ids": 10, "transactions_missing_employee": 8, "transactions_unknown_employee": 189,
        "transactions_negative_amount": 3, "transactions_null_amount": 7, "received_before_created": 15,
        "completed_before_created": 14, "updated_before_created": 12, "future_transactions": 122,
        "non_standard_transaction_status": 4,
    }
