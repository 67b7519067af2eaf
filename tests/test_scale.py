"""Plans and skew: what must hold however large the tables are."""

import random
from collections import defaultdict
from contextlib import contextmanager

import pytest
from conftest import at, plan_of
from pyspark.sql import functions as F

from millrace.operators import fact, quality, reference, salted, transactions, validation
from millrace.plans.catalog import AS_OF, TODAY, WINDOW_START, Sample
from millrace.schemas import TRANSACTIONS, orphan_keys
from millrace.sources.incremental import incremental_window


@contextmanager
def settings(spark, **values):
    names = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The raw transactions as files partitioned by update day."""
    path = str(tmp_path_factory.mktemp("source") / "transactions")
    raw = Sample(spark, sf_dir).transactions.where("source_row_id <= 100")
    raw = raw.withColumn("update_day", F.to_date("last_updated_at"))
    raw.write.partitionBy("update_day").parquet(path)
    return spark.read.parquet(path)


def test_window_reaches_the_scan(stored):
    plan = plan_of(incremental_window(stored, WINDOW_START, AS_OF, "update_day"), "formatted")
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "GreaterThan(last_updated_at" in pushed and "LessThanOrEqual(last_updated_at" in pushed
    partitions = plan.split("PartitionFilters: ")[1].split("\n")[0]
    assert "update_day" in partitions and "1998-01-01" in partitions
    assert "Exchange" not in plan


def test_only_needed_columns_are_read(stored, spark, sf_dir):
    plan = plan_of(validation.next_watermark(incremental_window(stored, WINDOW_START, AS_OF)))
    assert "ReadSchema: struct<last_updated_at:timestamp_ntz>" in plan
    plan = plan_of(quality.repeated_key_count(stored, "transaction_id", "x"))
    assert "ReadSchema: struct<transaction_id:string>" in plan


def test_a_batch_is_judged_where_it_lies(spark, stored, make, tmp_path):
    """With staged inputs no wide row is shuffled; the ranking reads four narrow columns."""
    raw = transactions.with_row_id(stored.select(*TRANSACTIONS.names))
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    transactions.repeated_ids(raw).write.parquet(str(tmp_path / "repeated"))
    reference.employees_clean(make.employees({}), reference.departments_clean(make.departments({})), TODAY).write.parquet(
        str(tmp_path / "employees")
    )
    judged = transactions.verdicts(
        raw, spark.read.parquet(str(tmp_path / "employees")), AS_OF, spark.read.parquet(str(tmp_path / "repeated"))
    )
    plan = plan_of(transactions.settle(judged))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "Window" not in plan
    ranking = plan_of(transactions.repeated_ids(raw))
    assert "ReadSchema: struct<source_row_id:bigint,transaction_id:string,last_updated_at:timestamp_ntz,batch_row_id" in ranking


def test_latest_employees_are_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(reference.latest_employees(Sample(spark, sf_dir).employees))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")  # plans read from the result down


def skewed(make):
    """A third of the rows share one id, a third are copies of one row, the rest is mixed."""
    pick = random.Random(11)
    rows = [dict(transaction_id="HOT", source_row_id=i, last_updated_at=pick.choice([None, *DAYS]) if i % 50 == 0 else pick.choice(DAYS)) for i in range(1500)]
    rows += [dict(transaction_id="COPY", source_row_id=5000, employee_id="HOT")] * 1500
    for i in range(1500):
        rows.append(
            dict(
                transaction_id=pick.choice([None, f"T{pick.randrange(900)}"]), source_row_id=10_000 + i,
                employee_id=pick.choice([None, "E1", "HOT", f"X{i}"]), last_updated_at=pick.choice([None, *DAYS]),
            )
        )
    pick.shuffle(rows)
    return rows, make.transactions(*rows).repartition(6)


DAYS = [at(f"2024-01-{d:02}T00:00") for d in range(2, 20)]


def expected_duplicates(rows):
    """Number of non-latest rows per id, and the row id of the latest."""
    groups = defaultdict(list)
    for row in rows:
        if row["transaction_id"] is not None:
            updated = row.get("last_updated_at", at("2024-01-02T00:00"))
            groups[row["transaction_id"]].append((updated is None, updated or at("1970-01-01T00:00"), row["source_row_id"]))
    return {key: (len(members) - 1, max(members)[2]) for key, members in groups.items()}


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("staged", [True, False])
def test_duplicates_of_hot_ids(spark, make, threshold, staged, tmp_path):
    rows, raw = skewed(make)
    repeated = None
    if staged:
        transactions.with_row_id(raw).write.parquet(str(tmp_path / "raw"))
        raw = spark.read.parquet(str(tmp_path / "raw"))
        repeated = transactions.repeated_ids(raw)
    small = dict(
        spark_sql_autoBroadcastJoinThreshold=threshold, spark_sql_adaptive_autoBroadcastJoinThreshold=threshold,
        spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="1k", spark_sql_adaptive_advisoryPartitionSizeInBytes="1k",
        spark_sql_adaptive_skewJoin_skewedPartitionFactor="1.0",
    )
    with settings(spark, **small):
        flagged = transactions.flag_duplicates(raw, repeated).select("transaction_id", "source_row_id", "is_duplicate").collect()
    assert len(flagged) == len(rows)
    found = defaultdict(lambda: [0, None])
    for row in flagged:
        if row["transaction_id"] is None:
            assert row["is_duplicate"] is False
        elif row["is_duplicate"]:
            found[row["transaction_id"]][0] += 1
        else:
            assert found[row["transaction_id"]][1] is None
            found[row["transaction_id"]][1] = row["source_row_id"]
    assert {key: tuple(value) for key, value in found.items()} == expected_duplicates(rows)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_matches_and_counts_of_hot_employees(spark, make, threshold):
    rows, raw = skewed(make)
    employees = make.employees(dict(employee_id="E1"), dict(employee_id="HOT"), *[dict(employee_id=f"Y{i}") for i in range(50)])
    ids = [row.get("employee_id", "E1") for row in rows]
    with settings(
        spark, spark_sql_autoBroadcastJoinThreshold=threshold, spark_sql_adaptive_autoBroadcastJoinThreshold=threshold,
        spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="1k", spark_sql_adaptive_advisoryPartitionSizeInBytes="1k",
        spark_sql_adaptive_skewJoin_skewedPartitionFactor="1.0",
    ):
        matched = transactions.match_employees(raw, employees)
        counted = {r[0]: r[1] for r in matched.groupBy("matched_employee_id").count().collect()}
        unknown = quality.unknown_key_count(raw, "employee_id", employees, "x").first()["issue_count"]
        orphans = orphan_keys(raw, "employee_id", employees, "employee_id").count()
    assert counted == {
        "E1": ids.count("E1"), "HOT": ids.count("HOT"), None: sum(i not in ("E1", "HOT") for i in ids)
    }
    missing = [i for i in ids if i is not None and i.startswith("X")]
    assert unknown == len(missing) and orphans == len(set(missing))


def task_sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())


def test_a_hot_employee_is_dealt_without_adaptive_execution(spark, make, tmp_path):
    """One employee has half of all rows; its rows are met by copies of the employee in many tasks."""
    rows = [dict(transaction_id=f"T{i}", employee_id="HOT" if i % 2 else f"E{i}") for i in range(4000)]
    rows += [dict(transaction_id=f"N{i}", employee_id=None) for i in range(200)]
    transactions.with_row_id(make.transactions(*rows)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    employees = make.employees(dict(employee_id="HOT"), *[dict(employee_id=f"E{i}") for i in range(0, 4000, 4)])
    off = dict(spark_sql_adaptive_enabled="false", spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_shuffle_partitions="40")
    with settings(spark, **off):
        heavy = transactions.heavy_employees(raw, raw.count(), 50)
        assert [tuple(r) for r in heavy.collect()] == [("HOT", 40)]
        plain = transactions.match_employees(raw, employees)
        dealt = transactions.match_employees(raw, employees, heavy=heavy)
        assert "ReusedExchange" in plan_of(dealt) or "BroadcastHashJoin" in plan_of(dealt)
        columns = ["source_row_id", "transaction_id", "employee_id", "matched_employee_id"]
        assert sorted(map(str, dealt.select(*columns).collect())) == sorted(map(str, plain.select(*columns).collect()))
        assert dealt.columns == plain.columns
        assert task_sizes(plain)[-1] > 2000 and task_sizes(dealt)[-1] < 500
        inner = transactions.match_employees(raw, employees, "inner", heavy)
        assert inner.count() == 2000 + 1000


def test_the_fact_deals_a_hot_employee(spark, make):
    rows = [dict(transaction_id=f"T{i}", employee_id="HOT" if i % 2 else f"E{i}") for i in range(2000)]
    clean = make.transactions(*rows)
    dimension = spark.createDataFrame([(1, "HOT", 7)] + [(i + 2, f"E{i}", i % 5) for i in range(2000)], "employee_key long, employee_id string, department_key long")
    off = dict(spark_sql_adaptive_enabled="false", spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_shuffle_partitions="20")
    with settings(spark, **off):
        heavy = transactions.heavy_employees(clean, 2000, 50)
        plain, dealt = fact.fact_rows(clean, dimension, AS_OF), fact.fact_rows(clean, dimension, AS_OF, heavy)
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
        assert task_sizes(plain)[-1] > 1000 and task_sizes(dealt)[-1] < 500


def test_the_list_of_hot_keys_is_bounded(spark):
    """However many rows there are, a key must have its share of them to be listed."""
    rows = spark.range(1 << 16).selectExpr("CAST(id % 5000 AS STRING) AS employee_id")
    assert transactions.heavy_employees(rows, 1 << 16, 1).count() <= salted.SHARES
    assert transactions.heavy_employees(rows, 1 << 16) is None
    with pytest.raises(ValueError):
        transactions.match_employees(rows, rows, heavy=rows)
