"""The database read: slices of equal size, found and read by SQL that DuckDB answers in place of the source."""

import random
from datetime import timedelta

import duckdb
import pyarrow as pa
import pytest
from conftest import at

from millrace.plans.load import run_from_database
from millrace.schemas import TRANSACTIONS
from millrace.sources.incremental import Database, slice_ends_query, slice_predicates

AFTER, UNTIL = at("2024-01-01T00:00"), at("2024-06-01T00:00")


class Answering(Database):
    """A database whose queries an in-process engine answers; connection options aside, all is as in production."""

    def use(self, df, now=UNTIL):
        con = duckdb.connect()
        con.register("arriving", df.toArrow())
        con.execute("CREATE TABLE source_transactions AS SELECT * FROM arriving")
        object.__setattr__(self, "con", con)
        object.__setattr__(self, "now", now)
        return self

    def answer(self, spark, query):
        if "CURRENT_TIMESTAMP" in query:
            return [{"now": self.now}]
        return self.con.execute(query).fetchall()

    def sliced(self, spark, table, predicates):
        parts = [self.con.sql(f"SELECT * FROM {table} WHERE {p}").to_arrow_table() for p in predicates]
        object.__setattr__(self, "sizes", [p.num_rows for p in parts])
        return spark.createDataFrame(pa.concat_tables(parts), TRANSACTIONS)


def database(df, now=UNTIL):
    return Answering("host", "name", "user", "password").use(df, now)


def rows_at(times):
    return [dict(transaction_id=f"T{i}", source_row_id=i, last_updated_at=t) for i, t in enumerate(times, 1)]


END = UNTIL - timedelta(seconds=1)
SPREAD = [AFTER + timedelta(hours=h) for h in range(1, 1001)]
BATCHES = {
    "spread": SPREAD,
    "all at the end": [END + timedelta(microseconds=i) for i in range(1000)],
    "one time": [END] * 1000,
    "a third at one time": [END] * 333 + SPREAD[:667],
    "fewer rows than slices": SPREAD[:5],
    "one row": SPREAD[:1],
    "none": [],
}


@pytest.mark.parametrize("name", BATCHES)
def test_slices_are_even_and_whole(spark, make, name):
    times = BATCHES[name]
    outside = [AFTER, AFTER - timedelta(days=1), UNTIL + timedelta(microseconds=1), None]
    rows = rows_at([*times, *outside])
    random.Random(5).shuffle(rows)
    source = database(make.transactions(*rows))
    read = source.changed(spark, AFTER, UNTIL, 16).select("source_row_id").collect()
    assert sorted(r[0] for r in read) == list(range(1, len(times) + 1))
    assert len(source.sizes) <= 16 and max(source.sizes) <= -(-len(times) // 16) + 1


def test_bounds_are_as_in_a_window(spark, make):
    source = database(make.transactions(*rows_at([AFTER, AFTER + timedelta(microseconds=1), UNTIL])))
    assert sorted(r["source_row_id"] for r in source.changed(spark, AFTER, UNTIL, 4).collect()) == [2, 3]


def test_no_watermark_reads_nothing(spark, make):
    assert database(make.transactions(*rows_at(SPREAD[:3]))).changed(spark, None, UNTIL, 4).count() == 0


def test_awkward_arguments_are_refused():
    with pytest.raises(ValueError):
        slice_ends_query("t", AFTER, UNTIL, 0)
    with pytest.raises(ValueError):
        slice_predicates(at("2024-01-01T00:00+00:00"), UNTIL, [])


def test_one_query_per_slice():
    ends = [(at("2024-03-01T00:00"), 7), (at("2024-02-01T00:00"), 9)]
    first, second, third = slice_predicates(AFTER, UNTIL, ends)
    assert ">=" not in first and "source_row_id <= 9" in first
    assert "source_row_id > 9" in second and "source_row_id <= 7" in second
    assert "last_updated_at >= TIMESTAMP '2024-03-01 00:00:00.000000'" in third and "<= 7" not in third
    assert all("last_updated_at <= TIMESTAMP '2024-06-01 00:00:00.000000'" in p for p in (first, second, third))


def test_a_run_ends_at_the_clock_of_the_source(make, warehouse):
    """What the source will write after its own time belongs to the next run, whatever the time is here."""
    warehouse.register(AFTER)
    reference = make.employees({}), make.departments({})
    rows = rows_at([END, UNTIL + timedelta(minutes=1)])
    first = run_from_database(warehouse, database(make.transactions(*rows)), *reference, slices=4)
    assert [r["transaction_id"] for r in warehouse.fact_transactions().collect()] == ["T1"]
    assert first.commit["last_successful_watermark"] == END
    run_from_database(warehouse, database(make.transactions(*rows), UNTIL + timedelta(hours=1)), *reference, slices=4)
    assert sorted(r["transaction_id"] for r in warehouse.fact_transactions().collect()) == ["T1", "T2"]
