"""Cases the sample tables do not contain."""

from datetime import date
from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import measures, normalize as n
from millrace.operators import reference, transactions
from millrace.schemas import EMPLOYEES
from millrace.sources import sheets
from millrace.sources.incremental import Database, incremental_window, period

NOW = at("2024-06-01T00:00")
TODAY = date(2024, 6, 1)


def outcomes(make, raw, *employees):
    clean = reference.employees_clean(
        make.employees(*(employees or [{}])), reference.departments_clean(make.departments({})), TODAY
    )
    judged = transactions.verdicts(raw, clean, NOW)
    return {r["source_row_id"]: r["rejection_reason"] or r["outcome"] for r in judged.collect()}


def test_null_update_time_is_the_latest(make):
    raw = make.transactions(dict(), dict(last_updated_at=None))
    assert outcomes(make, raw) == {1: "DUPLICATE_TRANSACTION", 2: "unaccounted"}


def test_equal_update_times_fall_to_the_greater_row_id(make):
    assert outcomes(make, make.transactions({}, {}, {})) == {
        1: "DUPLICATE_TRANSACTION", 2: "DUPLICATE_TRANSACTION", 3: "clean"
    }


def test_identical_copies_leave_one(make):
    raw = make.transactions(*[dict(source_row_id=7)] * 5).repartition(3)
    employees = reference.employees_clean(make.employees({}), reference.departments_clean(make.departments({})), TODAY)
    judged = transactions.verdicts(raw, employees, NOW)
    assert judged.where("outcome = 'clean'").count() == 1
    assert judged.where("rejection_reason = 'DUPLICATE_TRANSACTION'").count() == 4


def test_ids_are_ranked_as_spelled(make):
    raw = make.transactions(dict(transaction_id="t1 "), dict(transaction_id="T1"))
    assert outcomes(make, raw) == {1: "clean", 2: "clean"}


def test_invalid_newest_does_not_revive_an_older_version(make):
    raw = make.transactions(dict(), dict(amount=None, last_updated_at=at("2024-02-01T00:00")))
    assert outcomes(make, raw) == {1: "DUPLICATE_TRANSACTION", 2: "NULL_AMOUNT"}


def test_missing_ids_are_not_duplicates_and_do_not_match(make):
    raw = make.transactions(
        dict(transaction_id=None), dict(transaction_id=None), dict(transaction_id="A", employee_id=None),
        dict(transaction_id="", employee_id=" e1 "), dict(transaction_id="B", employee_id=""),
    )
    assert outcomes(make, raw) == {
        1: "MISSING_TRANSACTION_ID", 2: "MISSING_TRANSACTION_ID", 3: "MISSING_EMPLOYEE", 4: "clean",
        5: "UNKNOWN_EMPLOYEE",
    }


def test_unknown_creation_time_is_neither_clean_nor_rejected(make):
    raw = make.transactions(dict(created_at=None), dict(transaction_id="B", created_at=None, amount=Decimal("-1")))
    assert outcomes(make, raw) == {1: "unaccounted", 2: "NEGATIVE_AMOUNT"}


def test_boundaries_are_inclusive(make):
    same = at("2024-01-01T00:00")
    raw = make.transactions(
        dict(received_at=same, completed_at=same, last_updated_at=same, amount=Decimal("0.00")),
        dict(transaction_id="B", created_at=NOW, last_updated_at=NOW),
    )
    assert outcomes(make, raw) == {1: "clean", 2: "clean"}


def test_first_broken_rule_wins(make):
    early = at("2023-01-01T00:00")
    raw = make.transactions(
        dict(transaction_id="A", received_at=early, completed_at=early, last_updated_at=early),
        dict(transaction_id="B", completed_at=early, last_updated_at=early),
        dict(transaction_id="C", last_updated_at=early),
        dict(transaction_id="D", created_at=at("2025-01-01T00:00"), last_updated_at=at("2025-01-02T00:00")),
    )
    assert list(outcomes(make, raw).values()) == [
        "RECEIVED_BEFORE_CREATED", "COMPLETED_BEFORE_CREATED", "UPDATED_BEFORE_CREATED", "FUTURE_TRANSACTION"
    ]


def test_rejected_keep_raw_values_and_clean_are_normalised(make):
    raw = make.transactions(
        dict(transaction_id=" t1 ", employee_id=" e1", classification=" عاجل جدا ", status="مكتمل ", channel=" API "),
        dict(transaction_id=" t2 ", employee_id=" e1", amount=None, channel=" API "),
    )
    employees = reference.employees_clean(make.employees({}), reference.departments_clean(make.departments({})), TODAY)
    judged = transactions.verdicts(raw, employees, NOW)
    for clean, rejected in [
        (transactions.transactions_clean(judged), transactions.transactions_rejected(judged)),
        (
            transactions.settle(judged).where("outcome = 'clean'"),
            transactions.settle(judged).where("outcome = 'rejected'"),
        ),
    ]:
        row = clean.first()
        assert (row["transaction_id"], row["employee_id"], row["channel"]) == ("T1", "E1", "API")
        assert (row["classification"], row["status"]) == (n.URGENT, n.COMPLETED)
        row = rejected.first()
        assert (row["transaction_id"], row["employee_id"], row["channel"]) == (" t2 ", " e1", " API ")


def test_trim_removes_spaces_only(make):
    raw = make.departments(dict(department_id="\td1  "))
    assert reference.departments_clean(raw).first()["department_id"] == "\tD1 "


def test_departments_are_distinct_as_whole_rows(make):
    raw = make.departments({}, dict(department_id=" d1 "), dict(department_name="other"), dict(department_id=None))
    clean = reference.departments_clean(raw)
    assert sorted(r["department_name"] for r in clean.collect()) == ["n", "other"]


def test_newest_employee_without_hire_date_vanishes(make):
    raw = make.employees(
        dict(hire_date=None, source_updated_at=None), dict(), dict(employee_id="E2", hire_date=date(2030, 1, 1)),
        dict(employee_id="E3", department_id="D9"), dict(employee_id=None), dict(employee_id=None, employee_name="m"),
    )
    departments = reference.departments_clean(make.departments({}))
    clean = reference.employees_clean(raw, departments, TODAY)
    rejected = reference.employees_rejected(raw, departments, TODAY)
    assert [r["employee_id"] for r in clean.collect()] == [None]
    assert sorted((r["employee_id"], r["rejection_reason"]) for r in rejected.collect()) == [
        ("E2", "FUTURE_HIRE_DATE"), ("E3", "INVALID_DEPARTMENT")
    ]
    assert reference.employee_accounting(raw, clean, rejected).first().asDict() == dict(
        raw_count=6, clean_count=1, rejected_count=2, clean_without_id=1, neither_count=3
    )


def test_employee_ties_fall_to_the_greater_columns(make):
    raw = make.employees(dict(employee_name="a"), dict(employee_name="b"), dict(employee_name="b"))
    assert [r["employee_name"] for r in reference.latest_employees(raw).collect()] == ["b"]


@pytest.mark.parametrize(
    "raw, expected",
    [("aCtive ", "Active"), (" INACTIVE", "Inactive"), ("on_leave", "On Leave"), (" On Leave ", "On Leave"),
     (" other ", " other "), (None, None), ("", "")],
)
def test_employment_status(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(n.employment_status("s")).first()[0] == expected


@pytest.mark.parametrize(
    "completed, expected",
    [("2024-01-01T00:00:18", "0.01"), ("2024-01-01T00:00:17.999999", "0.00"), ("2023-12-31T23:59:42", "-0.01"),
     ("2024-01-13T00:00:00", "288.00"), ("9999-01-01T00:00:00", "69907416.00"), (None, None)],
)
def test_cycle_hours_rounds_halves_away_from_zero(spark, completed, expected):
    df = spark.createDataFrame(
        [(at("2024-01-01T00:00"), completed and at(completed))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert df.select(measures.cycle_hours("a", "b")).first()[0] == (expected and Decimal(expected))


def test_the_session_time_zone_does_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        over_a_clock_change = spark.createDataFrame(
            [(at("2024-03-09T12:00"), at("2024-03-10T12:00"))], "a timestamp_ntz, b timestamp_ntz"
        )
        assert over_a_clock_change.select(measures.cycle_hours("a", "b")).first()[0] == Decimal("24.00")
        due = over_a_clock_change.withColumn("p", F.lit("Low")).select(measures.due_by_priority("a", "p"))
        assert due.first()[0] == at("2024-03-16T12:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sla_is_strict_and_three_valued(spark):
    rows = [
        (None, at("2024-01-01T00:00")), (at("2024-01-01T00:00"), at("2024-01-01T00:00")),
        (at("2024-01-01T00:00"), at("2024-01-01T00:00:01")), (NOW, None), (at("2024-05-31T00:00"), None),
    ]
    df = spark.createDataFrame(rows, "due timestamp_ntz, done timestamp_ntz")
    assert [r[0] for r in df.select(measures.sla_breached("due", "done", n.ntz(NOW))).collect()] == [
        None, False, True, False, True
    ]


def test_due_by_priority(spark):
    df = spark.createDataFrame([("Critical",), ("High",), ("Medium",), ("Low",), (None,)], "p string")
    due = df.withColumn("c", n.ntz(at("2024-01-01T00:00"))).select(measures.due_by_priority("c", "p"))
    assert [r[0].day - 1 for r in due.collect()] == [1, 3, 5, 7, 7]


def test_window_bounds(make):
    raw = make.transactions(
        dict(last_updated_at=at("2024-01-01T00:00")), dict(last_updated_at=at("2024-01-01T00:00:00.000001")),
        dict(last_updated_at=NOW), dict(last_updated_at=None),
    )

    def ids(df):
        return sorted(r["source_row_id"] for r in df.collect())

    assert ids(incremental_window(raw, at("2024-01-01T00:00"), NOW)) == [2, 3]
    assert ids(incremental_window(raw, None, NOW)) == []
    assert ids(period(raw, at("2024-01-01T00:00"), NOW)) == [1, 2]
    by_day = raw.withColumn("day", F.to_date("last_updated_at"))
    assert ids(incremental_window(by_day, at("2024-01-01T00:00"), NOW, "day")) == [2, 3]
    assert ids(period(by_day, at("2024-01-01T00:00"), NOW, "day")) == [1, 2]


def test_zoned_clock_is_refused():
    from datetime import timezone

    with pytest.raises(ValueError):
        n.ntz(NOW.replace(tzinfo=timezone.utc))


def test_csv_sheet(spark, tmp_path):
    path = tmp_path / "employees.csv"
    path.write_text(
        "a,b,c,d,e,f,g,h,i,j,k\n"
        ' E1 ,"x, y",,"",2024-01-05,Active,G,a@b.c,l,m,2024-01-05 10:00:00\n'
        "E2,n,D1,j,,Active,G,a@b.c,l,m,\n",
        encoding="utf-8",
    )
    rows = sheets.read_employees(spark, str(path), "csv").collect()
    assert rows[0].asDict() == dict(zip(EMPLOYEES.names, [
        " E1 ", "x, y", None, "", date(2024, 1, 5), "Active", "G", "a@b.c", "l", "m", at("2024-01-05T10:00")
    ]))
    assert rows[1]["hire_date"] is None and rows[1]["source_updated_at"] is None


@pytest.mark.parametrize("line", ["E2,n,D1,j,soon,Active,G,a@b.c,l,m,\n", "E2,n,D1,j\n", "E2,n,D1,j,,Active,G,a@b.c,l,m,,more\n"])
def test_unreadable_cells_and_uneven_lines_fail(spark, tmp_path, line):
    path = tmp_path / "employees.csv"
    path.write_text("a,b,c,d,e,f,g,h,i,j,k\n" + line, encoding="utf-8")
    with pytest.raises(Exception, match="unreadable as date|MALFORMED"):
        sheets.read_employees(spark, str(path), "csv").collect()


@pytest.mark.parametrize("header", ["a,b", "a,b,c,d,e,f,g,h"])
def test_csv_of_wrong_width_is_refused(spark, tmp_path, header):
    path = tmp_path / "departments.csv"
    path.write_text(header + "\n" + header + "\n", encoding="utf-8")
    with pytest.raises(ValueError):
        sheets.read_departments(spark, str(path), "csv")


def test_sheet_with_wrong_width_is_refused(spark):
    with pytest.raises(ValueError):
        sheets.bind_sheet(spark.range(1), T.StructType.fromDDL("a INT, b INT"))


def test_database_options():
    env = {"N": "source", "U": "reader", "P": "secret"}
    database = Database.from_environment("db-host", "N", "U", "P", env)
    options = database.partitioned("source_transactions", "source_row_id", 1, 120_000, 16)
    assert options["url"] == "jdbc:postgresql://db-host:5432/source"
    assert (options["fetchsize"], options["numPartitions"], options["upperBound"]) == ("5000", "16", "120000")
    assert "secret" not in repr(database)
