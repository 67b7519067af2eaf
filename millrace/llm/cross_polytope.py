"""Nearest neighbours by cross-polytope hashing.

A hash turns a unit vector by a pseudo-rotation, three rounds of random signs and a fast Hadamard
transform, and takes the nearest signed axis; a table's code is one such axis or several. Every vector
is in one bucket of each table, a query looks into the buckets of its best codes in each (multiprobe),
and the union is ranked by exact cosine in double precision. Each bucket ranks its own candidates and
hands on only the best, so no list of candidate pairs is ever written.

The number of axes per code, one or two, follows from the number of vectors, so that a bucket has about
``BUCKET`` vectors or fewer as long as two axes suffice; a bucket with more is dealt out over several tasks by its counted size,
and its queries go to each part. Equal vectors are one class, hashed and ranked once, whose smallest
ids answer for it: five others at most can be asked for, so no more are needed. Nothing is capped.

Queries for which the probed buckets hold too few ids, and all of a length with ``FEW`` classes or fewer,
are ranked against all classes of their length instead, in blocks of about ``PART`` of either.

Vectors that are null, zero or hold null or non-finite components, and rows without id, take no part
in either role. Vectors of different lengths are never compared. Rows with the query's id are its own.
Repeated rows count once. Equal cosines go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import apart, written

BUCKET = 2048
PART = 4096
#: Classes of a length up to which all are compared.
FEW = 256
#: Tables and probes by the number of axes in a code.
TABLES, PROBES = {1: 16, 2: 32, 3: 64}, {1: 5, 2: 96, 3: 256}
#: Best codes per axis that probes are put together from.
_NEXT = 16


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding as array of double) that take part."""
    values = F.col("embedding").cast("array<double>")
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable & F.exists("embedding", lambda x: x != 0))


def _smallest(keep: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per batch and vector the smallest ids: what a frequent vector sends on doesn't grow with its rows."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            column = batch.column("embedding")
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy() + 0.0
            for i, vec_id in enumerate(batch.column("vec_id").to_pylist()):
                found.setdefault(values[offsets[i] : offsets[i + 1]].tobytes(), []).append(vec_id)
            ids = [sorted(set(x))[:keep] for x in found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(ids, pa.list_(pa.int64()))], names=["vector", "ids"])

    return reduce


def classes(vectors: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: class_id (its smallest id), vector, and its ``keep`` smallest ids."""
    reduced = unit_vectors(vectors).mapInArrow(_smallest(keep), "vector binary, ids array<long>")
    merged = reduced.groupBy("vector").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))
    return merged.select(F.xxhash64("vector").alias("class_id"), "vector", "ids")


def _rotations(dimension: int, rounds: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).choice([-1.0, 1.0], (rounds, dimension))


def _hadamard(x: np.ndarray) -> np.ndarray:
    half, n = 1, x.shape[1]
    while half < n:
        x = x.reshape(-1, n // (2 * half), 2, half)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(-1, n)
        half *= 2
    return x / np.sqrt(n)


def codes(vectors: np.ndarray, table: int, axes: int, probes: int, seed: int = 5) -> np.ndarray:
    """Per vector its ``probes`` best codes in a table, best first; the first is its bucket."""
    padded = 1 << max(0, int(vectors.shape[1] - 1).bit_length())
    unit = np.zeros((len(vectors), padded))
    unit[:, : vectors.shape[1]] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    total, found = np.zeros((len(vectors), 1)), np.zeros((len(vectors), 1), dtype=np.int64)
    for axis in range(axes):
        turned = unit
        for signs in _rotations(padded, 3, seed + 1000 * table + axis):
            turned = _hadamard(turned * signs)
        signed = np.concatenate((turned, -turned), axis=1)
        if probes == 1:
            found = found * (2 * padded) + signed.argmax(axis=1)[:, None]
            continue
        nearest = np.argsort(-signed, axis=1, kind="stable")[:, : max(_NEXT, probes if axes == 1 else 0)]
        value = np.take_along_axis(signed, nearest, axis=1)
        cost = total[:, :, None] + ((value[:, :1] - value) ** 2)[:, None, :]
        both = found[:, :, None] * (2 * padded) + nearest[:, None, :]
        order = np.argsort(cost.reshape(len(unit), -1), axis=1, kind="stable")[:, :probes]
        total = np.take_along_axis(cost.reshape(len(unit), -1), order, axis=1)
        found = np.take_along_axis(both.reshape(len(unit), -1), order, axis=1)
    return found


def _hasher(axes: int, tables: int, probes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) // 8 for x in batch.column("vector").to_pylist()])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                own = batch.take(pa.array(rows))
                vectors = np.frombuffer(b"".join(own.column("vector").to_pylist()), dtype="<f8").reshape(len(rows), size)
                for table in range(tables):
                    found = codes(vectors, table, axes, probes)
                    several = np.repeat(np.arange(len(rows)), found.shape[1])
                    out = own.take(pa.array(several))
                    columns = [pa.array(np.full(len(several), size * tables + table, dtype=np.int64)), pa.array(found.reshape(-1))]
                    yield pa.RecordBatch.from_arrays([*columns, *out.columns], names=["table", "code", *out.schema.names])

    return hashed


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of a with rows of b, summed in the same order for every pair."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _ranker(best: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def ranked(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_class": np.zeros(0, np.int64), "class_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(queries) or not len(members):
            return none
        q = np.frombuffer(b"".join(queries["vector"]), dtype="<f8").reshape(len(queries), -1)
        v = np.frombuffer(b"".join(members["vector"]), dtype="<f8").reshape(len(members), -1)
        unit = (v / np.linalg.norm(v, axis=1, keepdims=True)).T
        ids, parts = members["class_id"].to_numpy(), []
        for i in range(0, len(q), 512):
            near = q[i : i + 512] @ unit
            keep = min(best, len(v))
            # places within rounding of the last one kept stay, the exact cosine decides
            edge = np.partition(near, len(v) - keep, axis=1)[:, len(v) - keep]
            row, at = np.nonzero(near >= (edge - 1e-9 * np.abs(edge) - 1e-12)[:, None])
            parts.append(pd.DataFrame({"query_class": queries["class_id"].to_numpy()[i + row], "class_id": ids[at], "score": cosine(q[i + row], v[at])}))
        return pd.concat(parts)

    return ranked


def _compared(queries: DataFrame, members: DataFrame, best: int) -> DataFrame:
    """The best of all ``members`` of its length for each of ``queries`` (class_id, vector, bytes, n: members of the length)."""
    parts = queries.groupBy("bytes").agg(F.ceil(F.count("*") / PART).cast("int").alias("query_parts"), F.ceil(F.max("n") / PART).cast("int").alias("parts"))
    parts = written(parts, "ann-parts")
    spread = F.xxhash64("class_id")
    asked = queries.join(parts, "bytes").withColumn("query_part", F.pmod(spread, "query_parts").cast("int"))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    held = members.select("class_id", "vector", F.length("vector").alias("bytes")).join(apart(parts), "bytes").withColumn("part", F.pmod(spread, "parts").cast("int"))
    held = apart(held.withColumn("query_part", F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1))))
    key = ["bytes", "query_part", "part"]
    return asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(_ranker(best), "query_class long, class_id long, score double")


def neighbours(vectors: DataFrame, every: int, k: int = 5, axes: int | None = None, tables: int | None = None, probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for rows whose id is divisible by ``every``."""
    held = written(classes(vectors, k + 1), "ann-classes")
    if axes is None:
        n = held.count()
        # a code of one axis has twice as many values as dimensions
        size = max(2, 2 * int(held.agg(F.max(F.length("vector"))).first()[0] or 8) // 8)
        # three axes find too few of the nearest (0.46 to 0.69 with 64 tables and 256 probes); beyond, buckets grow and are dealt out
        axes = 1 if n <= BUCKET * size else 2
    tables, probes = tables or TABLES[axes], probes or PROBES[axes]
    asking = unit_vectors(vectors).where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding").distinct()
    asking = asking.mapInArrow(_query_vectors, "query_id long, vector binary").select("query_id", F.xxhash64("vector").alias("class_id"))
    asking = written(asking, "ann-queries")
    counted = written(held.groupBy(F.length("vector").alias("bytes")).agg(F.count("*").alias("n")), "ann-lengths")
    asked = held.join(asking.select("class_id").distinct(), "class_id", "left_semi").select("class_id", "vector", F.length("vector").alias("bytes"))
    asked = written(asked.join(counted, "bytes"), "ann-asked")
    bucket = "table long, code long, class_id long, vector binary"
    index = held.select("class_id", "vector").mapInArrow(_hasher(axes, tables, 1), bucket)
    codes_only = index.groupBy("table", "code").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    large = written(codes_only.where("parts > 1"), "ann-large")
    key = ["table", "code"]
    one = F.coalesce("parts", F.lit(1))
    members = apart(index.join(large, key, "left").withColumn("part", F.pmod(F.xxhash64("class_id"), one).cast("int")))
    queries = asked.where(F.col("n") > FEW).select("class_id", "vector").mapInArrow(_hasher(axes, tables, probes), bucket).join(apart(large), key, "left")
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), one - 1)))
    groups = ["table", "code", "part"]
    near = queries.groupBy(*groups).cogroup(members.groupBy(*groups)).applyInPandas(_ranker(k + 1), "query_class long, class_id long, score double")
    # a pair can meet in several tables, always with the same score
    near = written(near.distinct(), "ann-near")
    enough = near.join(apart(held).select("class_id", "ids"), "class_id").groupBy("query_class").agg(F.sum(F.size("ids")).alias("ids")).where(F.col("ids") > k)
    enough = written(enough.select("query_class"), "ann-enough")
    short = written(asked.join(enough, F.col("class_id") == F.col("query_class"), "left_anti"), "ann-short")
    near = near.join(apart(enough), "query_class", "left_semi").union(_compared(short, held, k + 1))
    near = near.join(apart(held).select("class_id", "ids"), "class_id")
    answer = F.slice(F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("far"), i.alias("vec_id")))))), 1, k + 1)
    answers = near.groupBy("query_class").agg(answer.alias("found"))
    found = asking.join(answers, F.col("class_id") == F.col("query_class"))
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return found.select("query_id", F.posexplode(others).alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score")
    )


def _query_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("embedding")
        offsets, values = column.offsets.to_numpy(), column.values.to_numpy() + 0.0
        raw = [values[offsets[i] : offsets[i + 1]].tobytes() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(raw, pa.binary())], names=["query_id", "vector"])
