"""The upsert against a dictionary, surrogate keys and the duplicate guard."""

import random

import pytest
from conftest import at, plan_of
from pyspark.sql import functions as F

from millrace.operators.upsert import KEY_BLOCK, DuplicateUpsertKey, last_key, require_unique, upsert, versions

SCHEMA = "k bigint, id string, v string, at timestamp_ntz"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return {r["id"]: (r["k"], r["v"]) for r in df.collect()}


def test_against_a_dictionary(spark):
    pick = random.Random(5)
    held, expected, last = [], {}, 0
    for step in range(3):
        ids = pick.sample(range(400), 150)
        incoming = [(f"id{i}", pick.choice([None, f"v{step}"]), at("2024-01-01T00:00")) for i in ids]
        target = table(spark, held)
        merged = upsert(target, spark.createDataFrame(incoming, "id string, v string, at timestamp_ntz"), "id", "k", last, 7)
        now = rows_of(merged)
        assert merged.count() == len(now)
        before = {i: k for k, i, _, _ in held}
        expected |= {i: v for i, v, _ in incoming}
        assert {i: v for i, (_, v) in now.items()} == expected
        assert len({k for k, _ in now.values()}) == len(now)
        assert all(now[i][0] == k for i, k in before.items())
        assert all(k > last for i, (k, _) in now.items() if i not in before)
        held = [(k, i, v, at("2024-01-01T00:00")) for i, (k, v) in now.items()]
        last = last_key(table(spark, held), "k")


def test_same_input_gives_the_same_keys_however_it_is_partitioned(spark):
    incoming = spark.range(500).select(F.concat(F.lit("x"), "id").alias("id"), F.lit("v").alias("v"), F.lit(None).cast("timestamp_ntz").alias("at"))
    first = upsert(table(spark, []), incoming, "id", "k", 0, 16)
    again = upsert(table(spark, []), incoming.repartition(5, F.rand(3)), "id", "k", 0, 16)
    assert rows_of(first) == rows_of(again)


def test_older_versions_lose_when_newer_wins(spark):
    day = [at(f"2024-01-0{i}T00:00") for i in range(1, 5)]
    target = table(spark, [(1, "a", "old", day[1]), (2, "b", "old", day[1]), (3, "c", "old", day[1]), (4, "d", "old", None), (5, "e", "old", day[1])])
    incoming = spark.createDataFrame(
        [("a", "new", day[0]), ("b", "new", day[1]), ("c", "new", day[2]), ("d", "new", day[0]), ("f", "new", day[0]), ("e", "new", None)],
        "id string, v string, at timestamp_ntz",
    )
    assert rows_of(upsert(target, incoming, "id", "k", 5, 1, newer_wins="at")) == {
        "a": (1, "old"), "b": (2, "new"), "c": (3, "new"), "d": (4, "new"), "e": (5, "old"),
        "f": (rows_of(upsert(target, incoming, "id", "k", 5, 1, newer_wins="at"))["f"][0], "new"),
    }
    assert rows_of(upsert(target, incoming, "id", "k", 5, 1))["a"] == (1, "new")


def test_two_rows_for_one_key_are_refused(spark):
    with pytest.raises(DuplicateUpsertKey, match="DUPLICATE_UPSERT_KEY: dim.id: 1"):
        require_unique(table(spark, [(1, "a", "x", None), (2, "a", "y", None), (3, "b", "y", None)]), "id", "dim")


def test_held_rows_are_looked_up_and_not_sorted(spark):
    held = spark.range(10**6).select(F.col("id").alias("k"), F.col("id").cast("string").alias("id"))
    new = spark.createDataFrame([("5", "v"), ("x", "w")], "id string, v string")
    found = versions(held.drop("k").withColumn("k", F.col("id").cast("bigint")), new, "id", "k", 10**6, 1)
    text = plan_of(found)
    assert text.count("Window [") == 1 and "CartesianProduct" not in text
    assert {r["id"]: (r["k"], r["replaces"]) for r in found.collect()} == {"5": (5, True), "x": (10**6 + 1, False)}


def test_keys_come_in_blocks(spark):
    incoming = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    for slots in (1, 3):
        keys = sorted(r["k"] for r in versions(spark.createDataFrame([], "k bigint, id string"), incoming, "id", "k", 70, slots).collect())
        assert len(set(keys)) == 5000 and keys[0] == 71
        assert keys[-1] <= 70 + 5000 + slots * 2 * KEY_BLOCK and (slots > 1 or keys == list(range(71, 5071)))


def test_rows_that_change_nothing_are_not_written(spark):
    target = table(spark, [(1, "a", "x", None), (2, "b", None, None), (3, "c", "z", at("2024-01-01T00:00"))])
    incoming = table(spark, [(0, "a", "x", None), (0, "b", "y", None), (0, "c", "z", None), (0, "d", None, None)]).drop("k")
    found = versions(target, incoming, "id", "k", 3, 1, changed_only=True).collect()
    assert {(r["id"], r["replaces"]) for r in found} == {("b", True), ("c", True), ("d", False)}
