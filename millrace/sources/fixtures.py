"""The three raw tables as views over the sample tables, by key arithmetic only.

The text is valid in Spark SQL and, with another name for the zone-less timestamp type, in the SQL
engine the results are checked with.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from millrace.schemas import DEPARTMENTS, EMPLOYEES, TRANSACTIONS, conform

AS_OF = datetime(2001, 1, 1)
TODAY = AS_OF.date()
WINDOW_START = datetime(1998, 1, 1)

DEPARTMENTS_SQL = """
SELECT CASE WHEN n_nationkey % 6 = 1 THEN ' dep' || lpad(CAST(n_nationkey AS STRING),3,'0') || ' ' ELSE 'DEP' || lpad(CAST(n_nationkey AS STRING),3,'0') END AS department_id,
 ' ' || n_name AS department_name, r_name AS sector, 'HQ' || CAST(n_regionkey AS STRING) AS location,
 'EMP' || lpad(CAST(n_nationkey AS STRING),7,'0') AS manager_employee_id, 'CC' || CAST(n_nationkey AS STRING) AS cost_center,
 CASE WHEN n_nationkey % 2 = 0 THEN 'y' ELSE 'N ' END AS active_flag
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT 'DEP' || lpad(CAST(n_nationkey AS STRING),3,'0'), n_name || ' ', r_name, 'HQ' || CAST(n_regionkey AS STRING),
 'emp' || lpad(CAST(n_nationkey AS STRING),7,'0'), 'CC' || CAST(n_nationkey AS STRING), CASE WHEN n_nationkey % 2 = 0 THEN 'Y' ELSE 'n' END
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 6 = 1
UNION ALL SELECT CAST(NULL AS STRING), n_name, 'X', 'X', CAST(NULL AS STRING), 'X', 'N' FROM nation WHERE n_nationkey = 3
"""

EMPLOYEES_SQL = """
SELECT 'EMP' || lpad(CAST(c_custkey AS STRING),7,'0') AS employee_id, ' ' || c_name AS employee_name,
 CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 37 = 0 THEN 'DEP999' WHEN c_custkey % 5 = 0 THEN ' dep' || lpad(CAST(c_nationkey AS STRING),3,'0') ELSE 'DEP' || lpad(CAST(c_nationkey AS STRING),3,'0') END AS department_id,
 c_mktsegment AS job_title,
 CASE WHEN c_custkey % 29 = 0 THEN DATE '2030-01-01' WHEN c_custkey % 53 = 52 THEN NULL ELSE DATE '1990-01-01' + CAST(c_custkey % 3000 AS INT) END AS hire_date,
 CASE c_custkey % 6 WHEN 0 THEN 'Active' WHEN 1 THEN ' inactive' WHEN 2 THEN 'ON_LEAVE ' WHEN 3 THEN 'on leave' WHEN 4 THEN ' Terminated ' ELSE NULL END AS employment_status,
 'G' || CAST(c_custkey % 9 AS STRING) AS grade,
 CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'bad-email' ELSE ' User' || CAST(c_custkey AS STRING) || '@Example.COM ' END AS email,
 'L' || CAST(c_nationkey AS STRING) AS location, 'emp0000001' AS manager_employee_id,
 <TS> '1999-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 365 AS INT) AS source_updated_at
FROM customer
UNION ALL
SELECT 'EMP' || lpad(CAST(c_custkey AS STRING),7,'0'), c_name, 'DEP' || lpad(CAST(c_nationkey AS STRING),3,'0'), 'OLD TITLE', DATE '1990-01-01', 'Active', 'G0', CAST(NULL AS STRING), 'L0', CAST(NULL AS STRING),
 CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE <TS> '1998-01-01 00:00:00' END
FROM customer WHERE c_custkey % 11 = 0
"""

TRANSACTIONS_SQL = """
SELECT o_orderkey + 1 AS source_row_id,
 CASE WHEN o_orderkey % 1009 = 7 THEN NULL WHEN o_orderkey % 400 = 399 OR o_orderkey % 250 = 249 THEN 'TXN-' || lpad(CAST(o_orderkey - 1 AS STRING),9,'0') WHEN o_orderkey % 10 = 3 THEN ' txn-' || lpad(CAST(o_orderkey AS STRING),9,'0') || ' ' ELSE 'TXN-' || lpad(CAST(o_orderkey AS STRING),9,'0') END AS transaction_id,
 CASE WHEN o_orderkey % 211 = 1 THEN NULL WHEN o_orderkey % 307 = 1 THEN 'EMP9999999' WHEN o_orderkey % 8 = 5 THEN ' emp' || lpad(CAST(o_custkey AS STRING),7,'0') ELSE 'EMP' || lpad(CAST(o_custkey AS STRING),7,'0') END AS employee_id,
 ' service ' AS transaction_type,
 CASE WHEN o_orderkey % 503 = 2 THEN 'عاجل جدا' WHEN o_orderkey % 3 = 0 THEN ' عاجل' ELSE 'عادي ' END AS classification,
 o_orderpriority AS priority, 'Portal' AS channel, 'R0' || CAST(1 + o_orderkey % 5 AS STRING) AS region_code,
 o_orderdate AS created_at,
 CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 97 = 3 THEN o_orderdate - INTERVAL '1' HOUR ELSE o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey % 480 AS INT) END AS received_at,
 CASE WHEN o_orderkey % 89 = 4 THEN NULL ELSE o_orderdate + INTERVAL '1' DAY * (CASE WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN o_orderpriority = '2-HIGH' THEN 3 WHEN o_orderpriority = '3-MEDIUM' THEN 5 ELSE 7 END) END AS due_at,
 CASE WHEN o_orderkey % 113 = 5 THEN o_orderdate - INTERVAL '2' DAY WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1' SECOND * CAST((o_orderkey * 7919) % 1036800 AS INT) ELSE NULL END AS completed_at,
 CASE WHEN o_orderkey % 601 = 6 THEN 'قيد المعالجه' WHEN o_orderkey % 809 = 6 THEN 'مكتمل ' WHEN o_orderkey % 701 = 6 THEN NULL WHEN o_orderstatus = 'F' THEN 'مكتملة' WHEN o_orderstatus = 'O' THEN 'معلقة' ELSE 'قيد المعالجة' END AS status,
 CASE WHEN o_orderkey % 223 = 8 THEN NULL WHEN o_orderkey % 431 = 8 THEN CAST(-o_totalprice AS DECIMAL(12,2)) ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS amount,
 o_orderkey % 12 = 0 AS is_escalated,
 CASE WHEN o_orderkey % 400 = 398 THEN NULL WHEN o_orderkey % 127 = 9 THEN o_orderdate - INTERVAL '1' HOUR ELSE o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 480 AS INT) END AS last_updated_at,
 'CORE_TXN_DB' AS source_system
FROM orders
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    text = text.replace("<TS>", "TIMESTAMP_NTZ")
    for name in tables:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in tables})


def departments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_view(spark, sf_dir, DEPARTMENTS_SQL, "nation", "region"), DEPARTMENTS)


def employees_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_view(spark, sf_dir, EMPLOYEES_SQL, "customer"), EMPLOYEES)


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_view(spark, sf_dir, TRANSACTIONS_SQL, "orders"), TRANSACTIONS)
