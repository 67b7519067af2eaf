"""The queries of ``catalog`` in plain SQL over the same sample tables, written independently."""

from __future__ import annotations

from millrace.operators.transactions import REASONS
from millrace.plans.catalog import BACKFILL, EARLIER, FIRST_SECTORS, LATER_SECTORS, ROWS_PER_SALT
from millrace.sources import fixtures

AS_OF = f"TIMESTAMP '{fixtures.AS_OF}'"
TODAY = f"DATE '{fixtures.TODAY}'"
START = f"TIMESTAMP '{fixtures.WINDOW_START}'"
SWITCH = f"TIMESTAMP '{EARLIER}'"
WINDOW = f"last_updated_at > {START} AND last_updated_at <= {AS_OF}"
EARLY_WINDOW = f"last_updated_at > TIMESTAMP '1997-01-01' AND last_updated_at <= {SWITCH}"
PERIOD = f"last_updated_at >= TIMESTAMP '{BACKFILL[0]}' AND last_updated_at < TIMESTAMP '{BACKFILL[1]}'"

TXN = (
    "source_row_id, transaction_id, employee_id, transaction_type, classification, priority, channel, region_code, "
    "created_at, received_at, due_at, completed_at, status, amount, is_escalated, last_updated_at, source_system"
)
EMP = (
    "employee_id, employee_name, department_id, job_title, hire_date, employment_status, grade, email, location, "
    "manager_employee_id, source_updated_at"
)
FACT = (
    "transaction_id, employee_id, department_id, transaction_type, classification, priority, channel, region_code, "
    "created_at, due_at, completed_at, status, amount, is_escalated, cycle_hours, sla_breached, source_system, "
    "last_updated_at"
)


def _raw(text: str) -> str:
    return text.replace("<TS>", "TIMESTAMP").strip()


# Spellings of statuses, classifications and address patterns.
STATUS_CASE = """CASE WHEN lower(trim(employment_status)) = 'active' THEN 'Active'
  WHEN lower(trim(employment_status)) = 'inactive' THEN 'Inactive'
  WHEN lower(replace(trim(employment_status), '_', ' ')) = 'on leave' THEN 'On Leave' ELSE employment_status END"""
EMAIL_CASE = "CASE WHEN email LIKE '%@%.%' THEN lower(trim(email)) END"
CLASS_CASE = "CASE WHEN trim(classification) = 'عاجل جدا' THEN 'عاجل' ELSE trim(classification) END"
TXN_STATUS_CASE = """CASE WHEN trim(status) = 'مكتمل' THEN 'مكتملة'
  WHEN trim(status) = 'قيد المعالجه' THEN 'قيد المعالجة' ELSE trim(status) END"""
CANONICAL = "('مكتملة', 'قيد المعالجة', 'مرفوضة', 'محفوظة', 'معلقة', 'محالة')"

EMPLOYEE_MATCH = """SELECT t.source_row_id, t.employee_id, e.employee_id AS matched_employee_id
FROM transactions_raw t LEFT JOIN employees_clean e ON upper(trim(t.employee_id)) = e.employee_id"""
BASE = f"""WITH departments_raw AS ({_raw(fixtures.DEPARTMENTS_SQL)}),
employees_raw AS ({_raw(fixtures.EMPLOYEES_SQL)}),
transactions_raw AS ({_raw(fixtures.TRANSACTIONS_SQL)}),
departments_clean AS (
 SELECT DISTINCT upper(trim(department_id)) AS department_id, trim(department_name) AS department_name,
  trim(sector) AS sector, trim(location) AS location, upper(trim(manager_employee_id)) AS manager_employee_id,
  trim(cost_center) AS cost_center, upper(trim(active_flag)) AS active_flag
 FROM departments_raw WHERE department_id IS NOT NULL),
employees_newest AS (
 SELECT * FROM employees_raw QUALIFY row_number() OVER (
  PARTITION BY employee_id ORDER BY source_updated_at DESC NULLS FIRST, employee_name DESC, department_id DESC,
  job_title DESC, hire_date DESC) = 1),
employees_clean AS (
 SELECT upper(trim(e.employee_id)) AS employee_id, trim(employee_name) AS employee_name,
  upper(trim(e.department_id)) AS department_id, trim(job_title) AS job_title, hire_date,
  {STATUS_CASE} AS employment_status, trim(grade) AS grade, {EMAIL_CASE} AS email, trim(e.location) AS location,
  upper(trim(e.manager_employee_id)) AS manager_employee_id, source_updated_at
 FROM employees_newest e JOIN departments_clean d ON upper(trim(e.department_id)) = d.department_id
 WHERE hire_date <= {TODAY}),
employees_rejected AS (
 SELECT e.*, CASE WHEN e.department_id IS NULL THEN 'MISSING_DEPARTMENT'
  WHEN d.department_id IS NULL THEN 'INVALID_DEPARTMENT' ELSE 'FUTURE_HIRE_DATE' END AS rejection_reason
 FROM employees_raw e LEFT JOIN departments_clean d ON upper(trim(e.department_id)) = d.department_id
 WHERE e.department_id IS NULL OR d.department_id IS NULL OR hire_date > {TODAY})"""


def _hours(created: str, completed: str) -> str:
    us = f"date_diff('microsecond', {created}, {completed})"
    hundredths = f"sign({us}) * ((abs({us}) * 2 + 36000000) // 72000000)"
    return f"CAST(CAST({hundredths} AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"


def _breached(as_of: str) -> str:
    return f"""CASE WHEN due_at IS NULL THEN NULL WHEN completed_at IS NOT NULL THEN completed_at > due_at
  ELSE {as_of} > due_at END"""


def _batch(name: str, where: str = "TRUE", as_of: str = AS_OF) -> str:
    """The tables of one batch: _raw, _judged, _rejected, _clean and _fact."""
    return f"""{name}_raw AS (SELECT * FROM transactions_raw WHERE {where}),
{name}_joined AS (
 SELECT t.*, e.employee_id AS known_id, row_number() OVER (
  PARTITION BY transaction_id ORDER BY last_updated_at DESC NULLS FIRST, source_row_id DESC) AS rn
 FROM {name}_raw t LEFT JOIN employees_clean e ON upper(trim(t.employee_id)) = e.employee_id),
{name}_marked AS (
 SELECT *, CASE WHEN transaction_id IS NULL THEN 'MISSING_TRANSACTION_ID' WHEN rn > 1 THEN 'DUPLICATE_TRANSACTION'
   WHEN employee_id IS NULL THEN 'MISSING_EMPLOYEE' WHEN known_id IS NULL THEN 'UNKNOWN_EMPLOYEE'
   WHEN amount IS NULL THEN 'NULL_AMOUNT' WHEN amount < 0 THEN 'NEGATIVE_AMOUNT'
   WHEN received_at < created_at THEN 'RECEIVED_BEFORE_CREATED'
   WHEN completed_at < created_at THEN 'COMPLETED_BEFORE_CREATED'
   WHEN last_updated_at < created_at THEN 'UPDATED_BEFORE_CREATED'
   WHEN created_at > {as_of} THEN 'FUTURE_TRANSACTION' END AS rejection_reason,
  coalesce(rn = 1 AND transaction_id IS NOT NULL AND employee_id IS NOT NULL AND known_id IS NOT NULL AND amount >= 0
   AND (received_at IS NULL OR received_at >= created_at) AND (completed_at IS NULL OR completed_at >= created_at)
   AND last_updated_at >= created_at AND created_at <= {as_of}, FALSE) AS valid
 FROM {name}_joined),
{name}_judged AS (
 SELECT *, CASE WHEN rejection_reason IS NOT NULL THEN 'rejected' WHEN valid THEN 'clean' ELSE 'unaccounted' END
  AS outcome FROM {name}_marked),
{name}_rejected AS (SELECT {TXN}, rejection_reason FROM {name}_judged WHERE outcome = 'rejected'),
{name}_clean AS (
 SELECT source_row_id, upper(trim(transaction_id)) AS transaction_id, upper(trim(employee_id)) AS employee_id,
  trim(transaction_type) AS transaction_type, {CLASS_CASE} AS classification, trim(priority) AS priority,
  trim(channel) AS channel, trim(region_code) AS region_code, created_at, received_at, due_at, completed_at,
  {TXN_STATUS_CASE} AS status, amount, is_escalated, last_updated_at, source_system
 FROM {name}_judged WHERE outcome = 'clean'),
{name}_fact AS (
 SELECT t.transaction_id, t.employee_id, e.department_id, transaction_type, classification, priority, channel,
  region_code, created_at, due_at, completed_at, status, amount, is_escalated,
  {_hours('created_at', 'completed_at')} AS cycle_hours, {_breached(as_of)} AS sla_breached, source_system,
  last_updated_at
 FROM {name}_clean t JOIN employees_clean e ON t.employee_id = e.employee_id)"""


def _sql(select: str, *ctes: str) -> str:
    return ",\n".join([BASE, *ctes]) + "\n" + select


def _quality(transactions: str) -> str:
    checks = {
        "duplicate_employee_ids": "(SELECT employee_id FROM employees_raw GROUP BY employee_id HAVING count(*) > 1)",
        "employees_missing_department": "employees_raw WHERE department_id IS NULL",
        "employees_invalid_department": "employees_raw e LEFT JOIN departments_raw d "
        "ON e.department_id = d.department_id WHERE e.department_id IS NOT NULL AND d.department_id IS NULL",
        "employees_bad_email": "employees_raw WHERE email IS NULL OR email NOT LIKE '%@%.%'",
        "employees_future_hire_date": f"employees_raw WHERE hire_date > {TODAY}",
        "employees_non_standard_status": "employees_raw "
        "WHERE employment_status NOT IN ('Active', 'Inactive', 'On Leave')",
        "duplicate_transaction_ids": f"(SELECT transaction_id FROM {transactions} GROUP BY transaction_id "
        "HAVING count(*) > 1)",
        "transactions_missing_employee": f"{transactions} WHERE employee_id IS NULL",
        "transactions_unknown_employee": f"{transactions} t LEFT JOIN (SELECT DISTINCT employee_id FROM employees_raw "
        "WHERE employee_id IS NOT NULL) e ON t.employee_id = e.employee_id "
        "WHERE t.employee_id IS NOT NULL AND e.employee_id IS NULL",
        "transactions_negative_amount": f"{transactions} WHERE amount < 0",
        "transactions_null_amount": f"{transactions} WHERE amount IS NULL",
        "received_before_created": f"{transactions} WHERE received_at < created_at",
        "completed_before_created": f"{transactions} WHERE completed_at < created_at",
        "updated_before_created": f"{transactions} WHERE last_updated_at < created_at",
        "future_transactions": f"{transactions} WHERE created_at > {AS_OF}",
        "non_standard_transaction_status": f"{transactions} WHERE status NOT IN {CANONICAL}",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS issue_count FROM {source}" for name, source in checks.items()
    )


_WIN = _batch("win", WINDOW)
_ALL = _batch("whole")
_EARLY = _batch("early", EARLY_WINDOW, SWITCH)
_LATE = _batch("late", f"last_updated_at > {SWITCH} AND last_updated_at <= {AS_OF}")
_PERIOD = _batch("past", PERIOD)
_YEARS = [_batch(f"y{year}", f"{WINDOW} AND year(last_updated_at) = {year}") for year in (1998, 1999, 2000, 2001)]
_DEPARTMENT = "department_id, department_name, sector, location, cost_center, active_flag"
_EMPLOYEE = "employee_id, employee_name, department_id, job_title, hire_date, employment_status, grade, email, location"

_COUNTS = """(SELECT count(*) FROM {b}_raw) AS raw_count, (SELECT count(*) FROM {b}_clean) AS clean_count,
 (SELECT count(*) FROM {b}_rejected) AS rejected_count,
 (SELECT count(*) FROM {b}_clean c JOIN {b}_fact f ON c.transaction_id = f.transaction_id) AS loaded_count,
 (SELECT count(*) FROM {b}_fact) AS fact_count,
 (SELECT count(*) FROM (SELECT transaction_id FROM {b}_fact GROUP BY 1 HAVING count(*) > 1)) AS duplicate_count,
 (SELECT count(*) FROM {employees}) AS employee_count, (SELECT count(*) FROM departments_clean) AS department_count"""


def _gates(batch: str, employees: str, cte: str) -> str:
    counts = _COUNTS.format(b=batch, employees=employees)
    return _sql(
        """SELECT 1 AS gate_order, 'DIM_EMPLOYEE_IS_EMPTY' AS gate, employee_count = 0 AS failed FROM counts
UNION ALL SELECT 2, 'DIM_DEPARTMENT_IS_EMPTY', department_count = 0 FROM counts
UNION ALL SELECT 3, 'DUPLICATE_TRANSACTIONS_FOUND', duplicate_count > 0 FROM counts
UNION ALL SELECT 4, 'BATCH_COUNT_MISMATCH', clean_count <> loaded_count FROM counts
UNION ALL SELECT 5, 'BATCH_ACCOUNTING_ERROR', raw_count <> clean_count + rejected_count FROM counts""",
        cte,
        f"counts AS (SELECT {counts})",
    )


def _quoted(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _duplicates(where: str) -> str:
    return _sql(
        f"""SELECT source_row_id, transaction_id, transaction_id IS NOT NULL AND row_number() OVER (
 PARTITION BY transaction_id ORDER BY last_updated_at DESC NULLS FIRST, source_row_id DESC) > 1 AS is_duplicate
FROM transactions_raw WHERE {where}"""
    )


def oracle_sql() -> dict[str, str]:
    after_early = f"SELECT * FROM win_fact UNION ALL SELECT {FACT} FROM early_fact WHERE transaction_id NOT IN " \
        "(SELECT transaction_id FROM win_fact)"
    newest = " UNION ALL ".join(f"SELECT * FROM y{year}_fact" for year in (1998, 1999, 2000, 2001))
    sql = {
        "incremental_scan": _sql(f"SELECT {TXN} FROM transactions_raw WHERE {WINDOW}"),
        "backfill_scan": _sql(f"SELECT {TXN} FROM transactions_raw WHERE {PERIOD}"),
        "database_slices": _sql(
            f"""SELECT CAST(dense_rank() OVER (ORDER BY month) - 1 AS INTEGER) AS slice, row_count, first, last FROM (
 SELECT date_trunc('month', last_updated_at) AS month, count(*) AS row_count, min(last_updated_at) AS first,
  max(last_updated_at) AS last FROM transactions_raw WHERE {WINDOW} GROUP BY 1)"""
        ),
        "current_watermarks": _sql(
            """SELECT pipeline_name, seq, last_successful_watermark FROM (
 SELECT region_code AS pipeline_name, year(created_at) AS seq, max(last_updated_at) AS last_successful_watermark
 FROM transactions_raw GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY pipeline_name ORDER BY seq DESC) = 1"""
        ),
        "staged_batch": _sql(f"SELECT {TXN} FROM transactions_raw WHERE {WINDOW}"),
        "employees_sheet": _sql(f"SELECT {EMP} FROM employees_raw"),
        "departments_sheet": _sql("SELECT * FROM departments_raw"),
        "sheet_cells": """SELECT c_custkey AS cell_id, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance,
 CASE WHEN c_custkey % 5 > 1 THEN CAST('1999-01-0' || CAST(c_custkey % 5 AS VARCHAR) AS DATE) END AS hired,
 CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS name FROM customer""",
        "contract_violations": _sql(
            """SELECT 'unique transaction source_row_id' AS rule, count(*) AS violations
 FROM (SELECT source_row_id FROM transactions_raw GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique transaction transaction_id', count(*)
 FROM (SELECT transaction_id FROM transactions_raw GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique employee employee_id', count(*)
 FROM (SELECT employee_id FROM employees_raw GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'known department of employee', count(DISTINCT department_id) FROM employees_raw
 WHERE department_id NOT IN (SELECT department_id FROM departments_raw WHERE department_id IS NOT NULL)
UNION ALL SELECT 'known employee of transaction', count(DISTINCT employee_id) FROM transactions_raw
 WHERE employee_id NOT IN (SELECT employee_id FROM employees_raw)"""
        ),
        "text_expressions": _sql(
            """SELECT source_row_id, trim(transaction_id) AS trimmed, upper(employee_id) AS upper_id,
 lower(priority) AS lower_priority, replace(priority, '-', ' ') AS spaced_priority,
 lpad(CAST(source_row_id AS VARCHAR), 3, '0') AS cut_row_id,
 'ROW' || lpad(CAST(source_row_id AS VARCHAR), 12, '0') AS row_code, employee_id || '/' || status AS null_spreads,
 ['a', 'b', 'c', 'd'][source_row_id % 4 + 1] AS letter, 'CORE_TXN_DB' AS constant FROM transactions_raw"""
        ),
        "predicate_expressions": _sql(
            f"""SELECT source_row_id, transaction_id LIKE 'TXN-%9' AS ends_in_nine, employee_id IS NULL AS no_employee,
 completed_at IS NOT NULL AS is_completed, status NOT IN {CANONICAL} AS odd_status,
 received_at IS NULL OR received_at >= created_at AS received_in_order, created_at > {AS_OF} AS in_future,
 amount < 0 AS is_negative, completed_at > due_at AS completed_late FROM transactions_raw"""
        ),
        "mapped_values": _sql(
            f"""SELECT 'classification' AS attribute, classification AS raw_value, {CLASS_CASE} AS mapped_value,
 count(*) AS row_count FROM transactions_raw GROUP BY ALL
UNION ALL SELECT 'status', status, {TXN_STATUS_CASE}, count(*) FROM transactions_raw GROUP BY ALL"""
        ),
        "mapped_employee_values": _sql(
            f"""SELECT employee_id, source_updated_at, {STATUS_CASE} AS employment_status, {EMAIL_CASE} AS email
FROM employees_raw"""
        ),
        "due_by_priority": _sql(
            """SELECT source_row_id, created_at + INTERVAL '1' DAY * (CASE priority WHEN '1-URGENT' THEN 1
 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 5 ELSE 7 END) AS due_at, created_at - INTERVAL '1' HOUR AS hour_before
FROM transactions_raw"""
        ),
        "status_timeline": _sql(
            """SELECT source_row_id, transaction_id, status_code, status_timestamp,
 row_number() OVER (PARTITION BY source_row_id ORDER BY status_timestamp, place) AS step_no
FROM (SELECT source_row_id, transaction_id, 0 AS place, 'CREATED' AS status_code, created_at AS status_timestamp FROM transactions_raw
 UNION ALL SELECT source_row_id, transaction_id, 1, 'RECEIVED', received_at FROM transactions_raw
 UNION ALL SELECT source_row_id, transaction_id, 2, 'DUE', due_at FROM transactions_raw
 UNION ALL SELECT source_row_id, transaction_id, 3, CASE WHEN status IN ('مكتملة', 'مكتمل') THEN 'COMPLETED'
  WHEN status = 'مرفوضة' THEN 'REJECTED' WHEN status = 'محفوظة' THEN 'SAVED' WHEN status = 'معلقة' THEN 'ON_HOLD'
  ELSE 'REFERRED' END, completed_at FROM transactions_raw)
WHERE status_timestamp IS NOT NULL"""
        ),
        "employee_department_match": _sql(
            """SELECT e.employee_id, e.department_id, e.source_updated_at, d.department_id AS matched_department_id
FROM employees_raw e LEFT JOIN departments_clean d ON upper(trim(e.department_id)) = d.department_id"""
        ),
        "employee_with_department": _sql(
            """SELECT e.employee_id, d.department_id AS matched_department_id
FROM employees_newest e JOIN departments_clean d ON upper(trim(e.department_id)) = d.department_id"""
        ),
        "heavy_employees": _sql(
            f"""SELECT upper(trim(employee_id)) AS employee_id, CAST(ceil(count(*) / any_value(least_rows)) AS INTEGER) AS salts
FROM transactions_raw, (SELECT greatest({ROWS_PER_SALT}, ceil(count(*) / 4096)) AS least_rows FROM transactions_raw)
WHERE employee_id IS NOT NULL GROUP BY 1 HAVING count(*) > any_value(least_rows)"""
        ),
        "transaction_employee_match": _sql(EMPLOYEE_MATCH),
        "transaction_employee_match_salted": _sql(EMPLOYEE_MATCH),
        "transaction_with_employee": _sql(
            """SELECT t.source_row_id, e.employee_id AS matched_employee_id
FROM transactions_raw t JOIN employees_clean e ON upper(trim(t.employee_id)) = e.employee_id"""
        ),
        "employee_department_keys": _sql(
            """SELECT e.employee_id, d.department_id, d.sector
FROM employees_clean e JOIN departments_clean d ON e.department_id = d.department_id"""
        ),
        "fact_key_lookup_salted": _sql("SELECT transaction_id, employee_id, department_id FROM whole_fact", _ALL),
        "fact_key_lookup": _sql("SELECT transaction_id, employee_id, department_id FROM whole_fact", _ALL),
        "loaded_from_batch": _sql(
            "SELECT count(*) AS loaded_count FROM early_clean c JOIN win_fact f ON c.transaction_id = f.transaction_id",
            _EARLY, _WIN,
        ),
        "unknown_departments": _sql(
            """SELECT 'employees_invalid_department' AS check_name, count(*) AS issue_count FROM employees_raw e
WHERE e.department_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM departments_raw d WHERE d.department_id = e.department_id)"""
        ),
        "unknown_employees": _sql(
            """SELECT 'transactions_unknown_employee' AS check_name, count(*) AS issue_count FROM transactions_raw t
WHERE t.employee_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM employees_raw e WHERE e.employee_id = t.employee_id)"""
        ),
        "table_counts": _sql(
            f"""SELECT (SELECT count(*) FROM transactions_raw) AS transactions,
 (SELECT count(*) FROM employees_raw) AS employees, (SELECT count(*) FROM departments_raw) AS departments,
 (SELECT count(*) FROM transactions_raw WHERE {WINDOW}) AS window_rows,
 (SELECT count(DISTINCT employee_id) FROM employees_raw) AS distinct_employee_ids"""
        ),
        "repeated_transaction_ids": _sql(
            "SELECT transaction_id, count(*) AS row_count FROM transactions_raw GROUP BY 1 HAVING count(*) > 1"
        ),
        "next_watermark": _sql(f"SELECT max(last_updated_at) AS next_watermark FROM transactions_raw WHERE {WINDOW}"),
        "latest_employees": _sql(f"SELECT {EMP} FROM employees_newest"),
        "duplicate_transactions": _duplicates("TRUE"),
        "duplicate_transactions_in_window": _duplicates(WINDOW),
        "duplicate_transactions_unstaged": _duplicates("TRUE"),
        "quality_report": _sql(_quality("transactions_raw")),
        "quality_total": _sql(
            f"SELECT CAST(sum(issue_count) AS BIGINT) AS total_issues FROM ({_quality('transactions_raw')})"
        ),
        "employee_rule_counts": _sql(
            f"""SELECT * FROM ({_quality('transactions_raw')}) WHERE check_name IN ('employees_missing_department',
 'employees_bad_email', 'employees_future_hire_date', 'employees_non_standard_status')"""
        ),
        "transaction_rule_counts": _sql(
            f"""SELECT * FROM ({_quality('transactions_raw')}) WHERE check_name IN ('transactions_missing_employee',
 'transactions_negative_amount', 'transactions_null_amount', 'received_before_created', 'completed_before_created',
 'updated_before_created', 'future_transactions', 'non_standard_transaction_status')"""
        ),
        "departments_clean": _sql("SELECT * FROM departments_clean"),
        "employees_clean": _sql("SELECT * FROM employees_clean"),
        "employees_rejected": _sql(f"SELECT {EMP}, rejection_reason FROM employees_rejected"),
        "employee_rejection_summary": _sql(
            "SELECT rejection_reason, count(*) AS row_count FROM employees_rejected GROUP BY 1"
        ),
        "employee_accounting": _sql(
            """SELECT *, raw_count - clean_count - rejected_count AS neither_count FROM (
 SELECT (SELECT count(*) FROM employees_raw) AS raw_count, (SELECT count(*) FROM employees_clean) AS clean_count,
  (SELECT count(*) FROM employees_rejected) AS rejected_count,
  (SELECT count(*) FROM employees_clean WHERE employee_id IS NULL) AS clean_without_id)"""
        ),
        "transaction_verdicts": _sql("SELECT source_row_id, outcome, rejection_reason FROM whole_judged", _ALL),
        "transaction_verdicts_in_window": _sql(
            "SELECT source_row_id, outcome, rejection_reason FROM win_judged", _WIN
        ),
        "transactions_clean": _sql("SELECT * FROM whole_clean", _ALL),
        "transactions_rejected": _sql("SELECT * FROM whole_rejected", _ALL),
        "transactions_rejected_of_all": _sql("SELECT * FROM whole_rejected", _ALL),
        "transactions_settled": _sql(
            f"""SELECT {TXN}, NULL AS rejection_reason, 'clean' AS outcome FROM whole_clean
UNION ALL SELECT {TXN}, rejection_reason, 'rejected' FROM whole_rejected
UNION ALL SELECT {TXN}, NULL, 'unaccounted' FROM whole_judged WHERE outcome = 'unaccounted'""",
            _ALL,
        ),
        "rejection_summary": _sql(
            """SELECT year(last_updated_at) AS batch_year, rejection_reason, count(*) AS row_count
FROM whole_rejected GROUP BY 1, 2""",
            _ALL,
        ),
        "transactions_unaccounted": _sql(f"SELECT {TXN} FROM whole_judged WHERE outcome = 'unaccounted'", _ALL),
        "dim_department_upsert": _sql(
            f"""SELECT department_id, department_name, sector, CASE WHEN sector <> 'ASIA' THEN location END AS location,
 cost_center, active_flag, CASE WHEN sector IN {_quoted(FIRST_SECTORS)} THEN 'kept' ELSE 'new' END AS key_origin
FROM departments_clean WHERE sector IN {_quoted(LATER_SECTORS)}
UNION ALL SELECT department_id, department_name || ' (old)', sector, location, 'OLD', active_flag, 'kept'
FROM departments_clean WHERE sector IN {_quoted(FIRST_SECTORS)} AND sector NOT IN {_quoted(LATER_SECTORS)}"""
        ),
        "dim_employee_upsert": _sql(
            f"""SELECT {_EMPLOYEE}, CASE WHEN source_updated_at < TIMESTAMP '1999-07-01' THEN 'kept' ELSE 'new' END
 AS key_origin
FROM employees_clean WHERE source_updated_at >= TIMESTAMP '1999-04-01' OR source_updated_at IS NULL
UNION ALL SELECT employee_id, employee_name, department_id, 'TRAINEE', hire_date, employment_status, 'G0', email,
 location, 'kept' FROM employees_clean WHERE source_updated_at < TIMESTAMP '1999-04-01'"""
        ),
        "fact_first_load": _sql(f"SELECT {FACT} FROM whole_fact", _ALL),
        "fact_upsert": _sql(
            f"""SELECT m.*, CASE WHEN e.transaction_id IS NULL THEN 'new' ELSE 'kept' END AS key_origin
FROM ({after_early}) m LEFT JOIN early_fact e ON m.transaction_id = e.transaction_id""",
            _WIN, _EARLY,
        ),
        "rows_upserted": _sql(
            """SELECT (SELECT count(*) FROM win_fact) AS affected, (SELECT count(*) FROM win_fact
 WHERE transaction_id NOT IN (SELECT transaction_id FROM early_fact)) AS inserted""",
            _WIN, _EARLY,
        ),
        "surrogate_keys": _sql(
            f"""SELECT count(*) AS row_count, count(DISTINCT transaction_id) AS distinct_keys,
 (SELECT count(*) FROM early_fact) AS stable_keys, (SELECT count(*) FROM win_fact
 WHERE transaction_id NOT IN (SELECT transaction_id FROM early_fact)) AS new_keys FROM ({after_early})""",
            _WIN, _EARLY,
        ),
        "foreign_key_violations": _sql(
            """SELECT (SELECT count(DISTINCT department_id) FROM employees_clean
  WHERE department_id NOT IN (SELECT department_id FROM departments_clean)) AS employee_without_department,
 (SELECT count(DISTINCT employee_id) FROM whole_fact
  WHERE employee_id NOT IN (SELECT employee_id FROM employees_clean WHERE employee_id IS NOT NULL)) AS fact_without_employee,
 (SELECT count(DISTINCT department_id) FROM whole_fact
  WHERE department_id NOT IN (SELECT department_id FROM departments_clean)) AS fact_without_department""",
            _ALL,
        ),
        "foreign_key_violations_after_loss": _sql(
            """SELECT (SELECT count(DISTINCT department_id) FROM employees_clean
  WHERE grade <> 'G3' AND department_id IN (SELECT * FROM lost)) AS employee_without_department,
 (SELECT count(DISTINCT f.employee_id) FROM whole_fact f JOIN employees_clean e ON f.employee_id = e.employee_id
  WHERE grade = 'G3') AS fact_without_employee,
 (SELECT count(DISTINCT department_id) FROM whole_fact WHERE department_id IN (SELECT * FROM lost))
  AS fact_without_department""",
            _ALL,
            "lost AS (SELECT department_id FROM departments_clean WHERE sector = 'ASIA')",
        ),
        "fact_measures": _sql(
            f"""SELECT transaction_id, created_at, completed_at, due_at,
 {_hours('created_at', 'completed_at')} AS cycle_hours, {_breached(AS_OF)} AS sla_breached FROM whole_clean""",
            _ALL,
        ),
        "cycle_hours_of_all": _sql(
            f"""SELECT source_row_id, {_hours('created_at', 'completed_at')} AS cycle_hours,
 {_breached(AS_OF)} AS sla_breached FROM transactions_raw"""
        ),
        "sla_by_department": _sql(
            """SELECT d.department_id, d.department_name, count(*) AS transactions,
 count(*) FILTER (WHERE sla_breached) AS breached, CAST(sum(amount) AS DECIMAL(22,2)) AS total_amount,
 CAST(sum(cycle_hours) AS DECIMAL(22,2)) AS total_cycle_hours
FROM whole_fact f JOIN departments_clean d ON f.department_id = d.department_id GROUP BY 1, 2""",
            _ALL,
        ),
        "batch_counts": _sql("SELECT " + _COUNTS.format(b="whole", employees="employees_clean"), _ALL),
        "batch_gates": _gates("whole", "employees_clean", _ALL),
        "batch_gates_of_all": _gates("whole", "(SELECT 1 WHERE FALSE)", _ALL),
        "control_after_run": _sql(
            f"""SELECT 'transactions_pipeline' AS pipeline_name, 0 AS seq, {START} AS last_successful_watermark,
 CAST(NULL AS TIMESTAMP) AS last_successful_run, 0 AS fact_rows
UNION ALL SELECT 'transactions_pipeline', 1, (SELECT max(last_updated_at) FROM win_raw), {AS_OF},
 (SELECT count(*) FROM win_fact)""",
            _WIN,
        ),
        "control_after_empty_run": _sql(
            f"""SELECT 'transactions_pipeline' AS pipeline_name, 2 AS seq, max(last_updated_at)
 AS last_successful_watermark, {AS_OF} AS last_successful_run
FROM transactions_raw WHERE last_updated_at > {START} AND last_updated_at <= {SWITCH}"""
        ),
        "loaded_fact": _sql(f"SELECT {FACT} FROM win_fact", _WIN),
        "loaded_dim_employee": _sql(f"SELECT {_EMPLOYEE} FROM employees_clean"),
        "loaded_dim_department": _sql(f"SELECT {_DEPARTMENT} FROM departments_clean"),
        "loaded_quality_report": _sql(_quality("win_raw"), _WIN),
        "fact_after_two_windows": _sql(
            f"""SELECT {FACT} FROM late_fact UNION ALL SELECT {FACT} FROM early_fact
WHERE transaction_id NOT IN (SELECT transaction_id FROM late_fact)""",
            _EARLY, _LATE,
        ),
        "fact_after_same_batch_twice": _sql(f"SELECT {FACT} FROM win_fact", _WIN),
        "fact_after_backfill": _sql(
            f"""SELECT {FACT} FROM (SELECT *, 1 AS step FROM win_fact UNION ALL SELECT *, 2 FROM past_fact)
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY last_updated_at DESC, step DESC) = 1""",
            _WIN, _PERIOD,
        ),
        "fact_after_stream": _sql(
            f"""SELECT {FACT} FROM ({newest})
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY last_updated_at DESC) = 1""",
            *_YEARS,
        ),
    }
    for reason in REASONS:
        sql[f"rejected_{reason.lower()}"] = _sql(
            f"SELECT * FROM whole_rejected WHERE rejection_reason = '{reason}'", _ALL
        )
    return sql
