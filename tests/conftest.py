import io
import os
import sys
from contextlib import redirect_stdout
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace import schemas  # noqa: E402
from millrace.session import local_session  # noqa: E402
from millrace.sources.warehouse import Warehouse  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def plan_of(df, mode="simple") -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


class Make:
    """Small literal tables; unnamed columns get a valid default."""

    def __init__(self, spark):
        self.spark = spark

    def _table(self, schema, defaults, rows):
        filled = [{name: (defaults | row)[name] for name in schema.names} for row in rows]
        return self.spark.createDataFrame(pa.Table.from_pylist(filled), schema)

    def transactions(self, *rows):
        defaults = dict(
            source_row_id=1, transaction_id="T1", employee_id="E1", transaction_type="x", classification="c",
            priority="Low", channel="API", region_code="R01", created_at=at("2024-01-01T00:00"), received_at=None,
            due_at=None, completed_at=None, status="محالة", amount=Decimal("1.00"), is_escalated=False,
            last_updated_at=at("2024-01-02T00:00"), source_system="S",
        )
        numbered = [{"source_row_id": i} | row for i, row in enumerate(rows, 1)]
        return self._table(schemas.TRANSACTIONS, defaults, numbered)

    def employees(self, *rows):
        defaults = dict(
            employee_id="E1", employee_name="n", department_id="D1", job_title="j", hire_date=at("2020-01-01T00:00").date(),
            employment_status="Active", grade="G", email="a@b.c", location="l", manager_employee_id=None,
            source_updated_at=at("2023-01-01T00:00"),
        )
        return self._table(schemas.EMPLOYEES, defaults, rows)

    def departments(self, *rows):
        defaults = dict(
            department_id="D1", department_name="n", sector="s", location="l", manager_employee_id=None,
            cost_center="c", active_flag="Y",
        )
        return self._table(schemas.DEPARTMENTS, defaults, rows)


@pytest.fixture(scope="session")
def make(spark):
    return Make(spark)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))
