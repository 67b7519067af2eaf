"""Whole runs: commits, gates, failures, repeated and empty batches, backfill, streaming."""

import random
import shutil
import threading
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import at
from pyspark.sql import functions as F

from millrace.operators.upsert import DuplicateUpsertKey, versions
from millrace.operators import validation
from millrace.operators.validation import ValidationError, require_valid
from millrace.plans.load import load_batch, run_backfill, run_incremental
from millrace.sources import segments as segments_module
from millrace.sources import warehouse as warehouse_module
from millrace.sources.incremental import incremental_window, run_clock
from millrace.sources.segments import live_rows
from millrace.sources.warehouse import ControlError, Warehouse
from millrace.streaming.incremental import stream_runs, stream_transactions, untimed_transactions

START, NOW = at("2024-01-01T00:00"), at("2024-06-01T00:00")


@pytest.fixture(scope="module")
def reference(make):
    return make.employees({}, dict(employee_id="E2")), make.departments({})


def facts(warehouse, *columns):
    return sorted(tuple(r) for r in warehouse.fact_transactions().select(*columns).collect())


def test_first_load_update_and_empty_batch(make, warehouse, reference):
    warehouse.register(START)
    first = make.transactions(
        dict(transaction_id="A"), dict(transaction_id="B", amount=Decimal("-1")), dict(transaction_id="C"),
    )
    result = run_incremental(warehouse, first, *reference, at("2024-02-01T00:00"))
    assert (result.counts["clean_count"], result.counts["rejected_count"], result.counts["fact_count"]) == (2, 1, 2)
    assert result.commit["last_successful_watermark"] == at("2024-01-02T00:00")
    keys = dict(facts(warehouse, "transaction_id", "transaction_key"))

    later = make.transactions(
        dict(transaction_id="A"),  # behind the watermark: not read again
        dict(transaction_id="c ", amount=Decimal("9.00"), employee_id="E2", last_updated_at=at("2024-03-01T00:00")),
        dict(transaction_id="D", last_updated_at=at("2024-03-02T00:00")),
    )
    result = run_incremental(warehouse, later, *reference, NOW)
    assert (result.counts["raw_count"], result.counts["loaded_count"], result.counts["fact_count"]) == (2, 2, 3)
    after = dict(facts(warehouse, "transaction_id", "transaction_key"))
    assert {k: after[k] for k in "AC"} == keys and after["D"] > max(keys.values())
    assert facts(warehouse, "transaction_id", "amount") == [
        ("A", Decimal("1.00")), ("C", Decimal("9.00")), ("D", Decimal("1.00"))
    ]

    result = run_incremental(warehouse, later, *reference, at("2024-07-01T00:00"))
    assert result.counts["raw_count"] == 0 and result.counts["fact_count"] == 3
    assert result.commit["last_successful_watermark"] == at("2024-03-02T00:00")
    assert result.commit["last_successful_run"] == at("2024-07-01T00:00")
    assert dict(facts(warehouse, "transaction_id", "transaction_key")) == after
    assert warehouse.control().count() == 4


def test_reference_is_cleaned_while_transactions_are_staged(make, warehouse, reference, monkeypatch):
    warehouse.register(START)
    cleaned, in_time, stage = threading.Event(), [], Warehouse.stage

    def slow(self, df, run_id, table, partition_by=()):
        if table == "transactions_raw":
            in_time.append(cleaned.wait(60))
        staged = stage(self, df, run_id, table, partition_by)
        if table == "employees_clean":
            cleaned.set()
        return staged

    monkeypatch.setattr(Warehouse, "stage", slow)
    result = run_incremental(warehouse, make.transactions(dict(transaction_id="A")), *reference, NOW)
    assert in_time == [True] and result.counts["fact_count"] == 1


def test_a_run_writes_its_batch_only(make, warehouse, reference):
    warehouse.register(START)
    first = make.transactions(*[dict(transaction_id=f"T{i}") for i in range(40)])
    before = run_incremental(warehouse, first, *reference, at("2024-02-01T00:00")).commit
    keys = dict(facts(warehouse, "transaction_id", "transaction_key"))
    some = make.transactions(
        dict(transaction_id="T7", last_updated_at=at("2024-03-01T00:00"), created_at=at("2024-02-05T00:00")),
        dict(transaction_id="NEW", last_updated_at=at("2024-03-01T00:00")),
    )
    after = run_incremental(warehouse, some, *reference, NOW).commit
    assert [(s["row_count"], s["replacing"]) for s in after["fact_transactions"]] == [(40, 0), (2, 1)]
    # the reference tables are the same: nothing is written for them
    assert after["dim_employee"] == before["dim_employee"] and after["dim_department"] == before["dim_department"]
    assert warehouse.fact_transactions().count() == 41
    assert keys.items() <= dict(facts(warehouse, "transaction_id", "transaction_key")).items()
    # the earlier commit still reads as it was
    assert warehouse.fact_transactions(before).count() == 40
    assert warehouse.fact_transactions(before).where(F.col("last_updated_at") > at("2024-02-01T00:00")).isEmpty()
    recent = warehouse.fact_transactions(after, updated=(at("2024-02-01T00:00"), NOW))
    assert sorted(r["transaction_id"] for r in recent.collect()) == ["NEW", "T7"]
    assert len(recent.inputFiles()) <= 2 and warehouse.verify().isEmpty()


def test_an_empty_batch_writes_no_table(make, warehouse, reference):
    warehouse.register(START)
    before = run_incremental(warehouse, make.transactions({}), *reference, at("2024-02-01T00:00")).commit
    after = run_incremental(warehouse, make.transactions({}).where("false"), *reference, NOW).commit
    for table in ("dim_department", "dim_employee", "fact_transactions"):
        assert after[table] == before[table]


def test_segments_merge_and_keep_every_row(warehouse, spark):
    """Nine upserts of some departments, against a dictionary."""
    table, held, expected, keys, last = warehouse.departments, [], {}, {}, 0
    pick = random.Random(2)
    for step in range(9):
        ids = pick.sample(range(60), 12)
        rows = spark.createDataFrame([(f"D{i}", f"{step}") for i in ids], "department_id string, department_name string")
        rows = rows.select(*[(F.col(c) if c in rows.columns else F.lit("x")).alias(c) for c in table.schema.names if c != "department_key"])
        new = versions(table.current(held, rows, 12), rows, "department_id", "department_key", last)
        held = table.merged([*held, table.append(new, f"run{step}", 12)], f"run{step}")
        last = max(last, held[-1]["last_key"])
        expected |= {f"D{i}": f"{step}" for i in ids}
        found = table.read(held).collect()
        assert {r["department_id"]: r["department_name"] for r in found} == expected
        now = {r["department_id"]: r["department_key"] for r in found}
        assert live_rows(held) == len(found) == len(set(now.values())) and keys.items() <= now.items()
        keys = now
    assert len(held) < 9 and any(s["run_id"].endswith("-merged") for s in held)
    assert table.verify(held).isEmpty()


def test_merging_leaves_a_large_old_segment_alone(warehouse):
    def of(*sizes):
        return warehouse.facts.merging([{"row_count": n} for n in sizes])

    assert of() == 0 and of(10) == 1 and of(10, 10, 10) == 3 and of(10, 10, 10, 10) == 0
    assert of(1000, 10, 10, 10) == 4 and of(1000, 10, 10, 10, 10) == 1 and of(150, 10, 10, 10, 10) == 0
    assert of(10**6, 10**4, 100, 100, 100) == 5


@pytest.fixture
def many_files(warehouse, spark, monkeypatch):
    """Ten thousand facts in some twenty files, and a later segment with a few of them again."""
    monkeypatch.setattr(segments_module, "ROWS_PER_FILE", 500)

    def versions_of(lower, upper, replaces):
        typed = {f.name: F.lit(None).cast(f.dataType) for f in warehouse.facts.schema.fields}
        typed |= {"transaction_key": F.col("id"), "transaction_id": F.concat(F.lit("T"), "id"), "last_updated_at": F.expr("CAST(timestamp_micros(id) AS TIMESTAMP_NTZ)")}
        return spark.range(lower, upper).select(*[c.alias(n) for n, c in typed.items()], F.lit(replaces).alias("replaces"))

    return [
        warehouse.facts.append(versions_of(0, 10_000, False), "base", 10_000),
        warehouse.facts.append(versions_of(0, 30, True), "later", 30),
    ]


def test_a_small_batch_opens_only_files_that_can_hold_it(warehouse, many_files, spark):
    facts_table, held = warehouse.facts, many_files
    assert [s["file_count"] for s in held] == [20, 1] and [s["replacing"] for s in held] == [0, 30]
    where = {r["transaction_id"]: r["file"] for r in facts_table._rows(held[:1]).select("transaction_id", F.col("_metadata.file_name").alias("file")).collect()}
    ids = [f"T{i}" for i in range(40, 43)]
    keys = spark.createDataFrame([(i,) for i in ids], "transaction_id string")
    files = {f.rsplit("/", 1)[-1] for f in facts_table.files_for(held, keys, len(ids))}
    assert {where[i] for i in ids} <= files and len(files) <= len({where[i] for i in ids}) + 1
    found = facts_table.current(held, keys, len(ids))
    assert {r["transaction_id"]: r["transaction_key"] for r in found.collect()} == {i: int(i[1:]) for i in ids}
    assert {f.rsplit("/", 1)[-1] for f in found.inputFiles()} == files
    # of a hundred ids that are nowhere, the filters let hardly any through
    unknown = spark.range(100).select(F.concat(F.lit("new"), "id").alias("transaction_id"))
    assert len(facts_table.files_for(held, unknown, 100)) <= 5
    # with more keys than that, all files would be hit anyway
    assert facts_table.files_for(held, unknown, 10_000) is None


def test_zone_maps_of_update_times_choose_files(warehouse, many_files):
    early = warehouse.facts.read(many_files, (at("1970-01-01T00:00"), at("1970-01-01T00:00:00.000020")))
    assert early.count() == 20
    assert warehouse.facts.read(many_files, (at("1980-01-01T00:00"), at("1981-01-01T00:00"))).inputFiles() == []


def test_damage_is_found(warehouse, many_files, tmp_path):
    facts_table = warehouse.facts
    assert facts_table.verify(many_files).isEmpty()
    folder = Path(facts_table.folder("base"))
    first, second = sorted(folder.glob("*.parquet"))[:2]
    shutil.copy(first, folder / "copy.parquet")
    problems = [tuple(r)[1:] for r in facts_table.verify(many_files).collect()]
    assert ("copy.parquet", "unlisted") in problems and (None, "transaction_id repeated: 500") in [(f, p.replace(p.split(": ")[-1], "500")) for f, p in problems if f is None]
    (folder / "copy.parquet").unlink()
    content = second.read_bytes()
    shutil.copy(first, second)
    for crc in folder.glob(".*.crc"):
        crc.unlink()
    problems = {tuple(r)[1:] for r in facts_table.verify(many_files).collect()}
    assert (second.name, "damaged") in problems
    second.write_bytes(content)
    second.rename(tmp_path / "away")
    assert {tuple(r)[1:] for r in facts_table.verify(many_files).collect()} >= {(second.name, "missing")}


def test_one_of_two_writers_fails(make, warehouse, reference, monkeypatch):
    parent = warehouse.register(START)
    batch = make.transactions(dict(transaction_id="A"))
    second = Warehouse(warehouse.spark, warehouse.root)
    monkeypatch.setattr(second, "latest", lambda: parent)  # it looked before the first committed
    run_incremental(warehouse, batch, *reference, NOW)
    with pytest.raises(ControlError, match="CONCURRENT_COMMIT"):
        load_batch(second, parent, batch, *reference, NOW, "second")
    assert warehouse.control().count() == 2 and warehouse.latest()["run_id"] != "second"
    assert facts(warehouse, "transaction_id") == [("A",)] and warehouse.verify().isEmpty()


def test_sweep_keeps_disk_use_level(make, warehouse, reference):
    warehouse.register(START)
    held = []
    for step in range(4):
        updated = at(f"2024-01-0{1 + step}T01:00")
        run_incremental(warehouse, make.transactions(*[dict(transaction_id=f"T{i}", last_updated_at=updated) for i in range(9)]), *reference, NOW)
        abandoned = Path(warehouse.root) / "fact_transactions" / f"run_id=broken{step}"
        abandoned.mkdir()
        warehouse.sweep(keep=1, grace=0.0)
        assert not abandoned.exists()
        held.append(len([p for p in Path(warehouse.root).rglob("*") if p.is_dir() and p.name.startswith("run_id=")]))
        assert warehouse.fact_transactions().count() == 9 and warehouse.verify().isEmpty()
    assert max(held[2:]) <= held[1] + 3
    # what an unfinished run has written stays for the time being
    abandoned.mkdir()
    warehouse.sweep(keep=2)
    assert abandoned.exists()


def test_failure_before_the_commit_changes_nothing(make, warehouse, reference, monkeypatch):
    warehouse.register(START)
    raw = make.transactions(dict(transaction_id="A"))
    run_incremental(warehouse, raw, *reference, at("2024-02-01T00:00"))
    before = (warehouse.latest(), facts(warehouse, "transaction_id", "amount"))
    changed = make.transactions(dict(amount=Decimal("5.00"), transaction_id="A", last_updated_at=at("2024-03-01T00:00")))

    def broken(*args, **kwargs):
        raise OSError("lost the connection")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_append", broken)
        with pytest.raises(OSError):
            run_incremental(warehouse, changed, *reference, NOW)
    assert (warehouse.latest(), facts(warehouse, "transaction_id", "amount")) == before
    run_incremental(warehouse, changed, *reference, NOW)
    assert facts(warehouse, "transaction_id", "amount") == [("A", Decimal("5.00"))]


def test_missing_control_row(make, warehouse, reference):
    with pytest.raises(ControlError, match="Watermark not found"):
        run_incremental(warehouse, make.transactions({}), *reference, NOW)
    with pytest.raises(ControlError, match="ETL_CONTROL_RECORD_NOT_FOUND"):
        run_backfill(warehouse, make.transactions({}), *reference, START, NOW, NOW)
    parent = warehouse.register(None)
    other = Warehouse(warehouse.spark, warehouse.root, "another_pipeline")
    with pytest.raises(ControlError, match="ETL_CONTROL_RECORD_NOT_FOUND"):
        other.publish(parent, "r", NOW, NOW)
    assert other.publish(parent, "r", None, NOW) is None
    with pytest.raises(ControlError, match="already registered"):
        warehouse.register(START)


def test_null_watermark_selects_nothing(make, warehouse, reference):
    nothing = validation.next_watermark(incremental_window(make.transactions({}), None, NOW)).collect()
    assert [r["next_watermark"] for r in nothing] == [None]
    warehouse.register(None)
    result = run_incremental(warehouse, make.transactions({}), *reference, NOW)
    assert result.counts["raw_count"] == 0 and result.commit["last_successful_watermark"] is None


def test_a_writer_that_was_overtaken_is_refused(make, warehouse, reference):
    stale = warehouse.register(START)
    run_incremental(warehouse, make.transactions({}), *reference, NOW)
    with pytest.raises(ControlError, match="CONCURRENT_COMMIT"):
        load_batch(warehouse, stale, make.transactions({}), *reference, NOW, "late")
    assert warehouse.latest()["seq"] == 1


@pytest.mark.parametrize(
    "change, message",
    [
        (dict(employee_count=0, department_count=0), "^DIM_EMPLOYEE_IS_EMPTY$"),
        (dict(department_count=0, duplicate_count=1), "^DIM_DEPARTMENT_IS_EMPTY$"),
        (dict(duplicate_count=2, clean_count=1), "^DUPLICATE_TRANSACTIONS_FOUND: 2$"),
        (dict(loaded_count=2, raw_count=9), "^BATCH_COUNT_MISMATCH: clean=3, loaded=2$"),
        (dict(raw_count=6), "^BATCH_ACCOUNTING_ERROR: raw=6, clean=3, rejected=2$"),
    ],
)
def test_gates_in_order(change, message):
    good = dict(raw_count=5, clean_count=3, rejected_count=2, loaded_count=3, fact_count=3, duplicate_count=0,
                employee_count=1, department_count=1)
    require_valid(good)
    with pytest.raises(ValidationError, match=message):
        require_valid(good | change)


def test_rows_in_neither_set_stop_the_run(make, warehouse, reference):
    warehouse.register(START)
    with pytest.raises(ValidationError, match="BATCH_ACCOUNTING_ERROR: raw=2, clean=1, rejected=0"):
        run_incremental(
            warehouse, make.transactions(dict(transaction_id="A"), dict(transaction_id="B", created_at=None)),
            *reference, NOW,
        )
    assert warehouse.latest()["seq"] == 0


def test_empty_reference_tables_stop_the_run(make, warehouse, reference):
    warehouse.register(START)
    employees, departments = reference
    with pytest.raises(ValidationError, match="DIM_EMPLOYEE_IS_EMPTY"):
        run_incremental(warehouse, make.transactions({}), employees.where("false"), departments, NOW)


def test_one_business_key_twice_stops_the_run(make, warehouse, reference):
    warehouse.register(START)
    employees, departments = reference
    same_after_trim = make.transactions(dict(transaction_id="t1 "), dict(transaction_id="T1"))
    with pytest.raises(DuplicateUpsertKey, match="fact_transactions.transaction_id: 1"):
        run_incremental(warehouse, same_after_trim, employees, departments, NOW)
    with pytest.raises(DuplicateUpsertKey, match="dim_employee.employee_id: 1"):
        run_incremental(warehouse, make.transactions({}), make.employees({}, dict(employee_id="e1 ")), departments, NOW)
    with pytest.raises(DuplicateUpsertKey, match="dim_department.department_id: 1"):
        run_incremental(
            warehouse, make.transactions({}), employees, make.departments({}, dict(department_name="other")), NOW
        )
    assert warehouse.latest()["seq"] == 0


def test_dimensions_keep_rows_that_left_the_source(make, warehouse, reference):
    warehouse.register(START)
    run_incremental(
        warehouse, make.transactions({}), make.employees({}, dict(employee_id=None)),
        make.departments({}, dict(department_id="D2")), at("2024-02-01T00:00"),
    )
    keys = {r["department_id"]: r["department_key"] for r in warehouse.dim_department().collect()}
    run_incremental(
        warehouse, make.transactions({}), make.employees(dict(department_id="D3", email=None)),
        make.departments(dict(sector=None), dict(department_id="D3")), NOW,
    )
    now = {r["department_id"]: r for r in warehouse.dim_department().collect()}
    assert set(now) == {"D1", "D2", "D3"} and now["D1"]["sector"] is None
    assert {d: now[d]["department_key"] for d in keys} == keys
    (employee,) = warehouse.dim_employee().collect()
    assert employee["department_key"] == now["D3"]["department_key"] and employee["email"] is None


def test_backfill_brings_back_rejected_rows_and_keeps_newer_ones(make, warehouse, reference):
    warehouse.register(START)
    employees, departments = reference
    source = make.transactions(
        dict(transaction_id="A", employee_id="E9"), dict(transaction_id="B"),
        dict(transaction_id="B", amount=Decimal("7.00"), last_updated_at=at("2024-04-01T00:00")),
    )
    result = run_incremental(warehouse, source, employees, departments, NOW)
    assert result.counts["rejected_count"] == 2
    mark = result.commit["last_successful_watermark"]
    with_e9 = employees.unionByName(make.employees(dict(employee_id="E9")))
    result = run_backfill(warehouse, source, with_e9, departments, START, at("2024-02-01T00:00"), NOW)
    assert result.counts["raw_count"] == 2 and result.commit["last_successful_watermark"] == mark
    assert facts(warehouse, "transaction_id", "amount") == [("A", Decimal("1.00")), ("B", Decimal("7.00"))]


def test_windows_add_up_to_one_window(make, warehouse, reference, spark, tmp_path):
    raw = make.transactions(
        *[dict(transaction_id=f"T{i}", last_updated_at=at(f"2024-0{1 + i % 5}-1{i % 7}T00:00")) for i in range(30)]
    )
    warehouse.register(START)
    whole = run_incremental(warehouse, raw, *reference, NOW)
    parts = Warehouse(spark, str(tmp_path / "parts"))
    parts.register(START)
    for month in (3, 4, 6):
        last = run_incremental(parts, raw.where(f"last_updated_at < TIMESTAMP_NTZ '2024-0{month}-01'"), *reference, NOW)
    columns = [c for c in parts.fact_transactions().columns if not c.endswith("_key")]
    assert facts(parts, *columns) == facts(warehouse, *columns)
    assert last.commit["last_successful_watermark"] == whole.commit["last_successful_watermark"]


def test_stream_skips_a_replayed_batch(make, warehouse, reference, tmp_path, monkeypatch):
    warehouse.register(START)
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def run():
        query = stream_transactions(warehouse, source, *reference, checkpoint, NOW)
        query.awaitTermination()

    make.transactions(dict(transaction_id="A", last_updated_at=at("2024-03-01T00:00")), dict(transaction_id="N", last_updated_at=None)).write.parquet(source)
    run()
    assert [r["seq"] for r in warehouse.control().orderBy("seq").collect()] == [0, 1]
    assert [r["transaction_id"] for r in untimed_transactions(warehouse).collect()] == ["N"]
    assert [(r["seq"], r["untimed_rows"]) for r in stream_runs(warehouse).collect()] == [(1, 1)]
    run()  # nothing new
    assert warehouse.latest()["seq"] == 1

    # the commit is written, but the stream dies before it can record the batch
    make.transactions(dict(transaction_id="B")).write.mode("append").parquet(source)
    publish = Warehouse.publish

    def die_afterwards(self, *args, **kwargs):
        publish(self, *args, **kwargs)
        raise OSError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "publish", die_afterwards)
        with pytest.raises(Exception, match="killed"):
            run()
    assert warehouse.latest()["seq"] == 2
    run()
    assert warehouse.latest()["seq"] == 2
    assert facts(warehouse, "transaction_id") == [("A",), ("B",)]
    assert warehouse.latest()["last_successful_watermark"] == at("2024-03-01T00:00")
    assert sorted((r["seq"], r["untimed_rows"]) for r in stream_runs(warehouse).collect()) == [(1, 1), (2, 0)]
    assert len(list(Path(warehouse.root, "untimed").iterdir())) == 1


def test_a_stream_of_late_rows_keeps_newer_ones(make, warehouse, reference, tmp_path):
    """Files out of order, across a restart: each fact is the newest version that has arrived, late ones are no loss."""
    warehouse.register(START)
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    assert untimed_transactions(warehouse).count() == 0

    def arrive(*rows):
        versions_of = [dict(transaction_id=t, amount=Decimal(a), last_updated_at=at(u)) for t, a, u in rows]
        make.transactions(*versions_of).write.mode("append").parquet(source)
        stream_transactions(warehouse, source, *reference, checkpoint, NOW).awaitTermination()

    arrive(("A", "3.00", "2024-03-03T00:00"), ("B", "1.00", "2024-03-01T00:00"))
    arrive(("A", "1.00", "2024-03-01T00:00"), ("B", "2.00", "2024-03-02T00:00"), ("C", "1.00", "2024-02-01T00:00"))
    assert facts(warehouse, "transaction_id", "amount") == [("A", Decimal("3.00")), ("B", Decimal("2.00")), ("C", Decimal("1.00"))]
    assert warehouse.latest()["last_successful_watermark"] == at("2024-03-03T00:00")
    assert stream_runs(warehouse).where("untimed_rows > 0").count() == 0


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = warehouse_module.shared_folder(spark)
    assert folder == (named or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir"))


def test_clock_has_no_zone(spark):
    assert run_clock(spark).tzinfo is None
