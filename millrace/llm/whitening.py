"""Whitening of embeddings: projection on the leading components of their covariance, with unit variance.

A component c of a vector becomes the whole number floor(256 c). The list of distinct vectors is written
once; one pass sums it, exactly, a second takes products of the centred vectors: every task adds up its own
part, parts are added by row of the matrix, dealt out first. The matrix goes to one task, which reduces it to
tridiagonal form by Householder reflections, finds the leading eigenvalues by bisection on Sturm counts and
their vectors by inverse iteration, made orthogonal inside clusters. A third pass checks the covariance of
the projected list against the identity; the last projects every row. All rows see one and the same model.

What reaches the driver and every task is the sums and the few components of a length: ``MODEL_CELLS``
numbers in all. Tables with more lengths than that are worked off in several rounds of lengths.

Vectors that are null or hold null or non-finite components take no part. Vectors of different lengths are
fitted apart; n, components and errors are those of the length. Empty vectors have no components and give
no rows. A row without id stays, as do repeated rows, with the same numbers; the fit counts each distinct
vector once. A component without variance (fewer distinct vectors than components, equal vectors) has null
``whitened``; ``explained`` is null if nothing varies, and ``identity_error`` is taken over the others, null
without any. ``deviation`` is null where it exceeds a long. An empty table gives an empty result. Columns
other than vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import eigen
from millrace.llm.workspace import written

UNIT = 256
#: Numbers of all models that are sent to tasks at once (sums and components).
MODEL_CELLS = 1 << 21
#: Numbers of a block of vectors in a task.
_BLOCK = 1 << 19
_LONG = 1 << 63
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

Batches = Iterator[pa.RecordBatch]


def whole_vectors(vectors: DataFrame, unit: int = UNIT) -> DataFrame:
    """Rows (vec_id, x as array of long) that take part."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(F.col("embedding").cast("array<double>"), lambda c: F.floor(c * float(unit)))
    rows = vectors.where(F.col("embedding").isNotNull() & finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<long>").alias("x"))


def blocks(batches: Batches) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Vectors of one length as a matrix, the rows of the batch they are, and the batch."""
    for batch in batches:
        column = batch.column("x")
        offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        lengths = np.diff(offsets)
        for length in np.unique(lengths[lengths > 0]):
            rows = np.flatnonzero(lengths == length)
            step = max(1, _BLOCK // int(length))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                yield values[offsets[part][:, None] + np.arange(length)], part, batch


def _sums(batches: Batches) -> Batches:
    """Exact sums per length and dimension of a task's vectors."""
    total: dict[int, np.ndarray] = {}
    for x, _, _ in blocks(batches):
        wide = np.abs(x.astype(float)).max() * len(x) >= _LONG // 2
        added = (x.astype(object) if wide else x).sum(axis=0).astype(object)
        total[x.shape[1]] = total.get(x.shape[1], 0) + added
    for length, s in total.items():
        columns = [pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()), pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, names=["length", "at", "s"])


@dataclass
class Model:
    """What tasks need to know of the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    trace: float = 0.0
    error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])

    def varied(self) -> np.ndarray:
        """Which components have a variance beyond rounding."""
        return self.values > len(self.sums) * np.finfo(float).eps * self.trace

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections with unit variance, not a number for components without any."""
        scale = np.where(self.varied(), self.values, np.nan) ** -0.5
        return (self.centred(x) @ self.vectors.T) * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        most = self.n * int(np.abs(x.astype(float)).max()) + max(abs(s) for s in self.sums)
        if most * most * len(self.sums) < _LONG // 2:
            return ((x * self.n - np.array(self.sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((x.astype(object) * self.n - np.array(self.sums, dtype=object)) ** 2).sum(axis=1)
        return [int(v) if v < _LONG else None for v in exact]


def _products(models: dict[int, Model]) -> Callable[[Batches], Batches]:
    def multiply(batches: Batches) -> Batches:
        """Products of a task's centred vectors, a row per row of the matrix."""
        deal = TaskContext.get().partitionId() % 64
        total: dict[int, np.ndarray] = {}
        for x, _, _ in blocks(batches):
            y = models[x.shape[1]].centred(x)
            total[x.shape[1]] = total.get(x.shape[1], 0) + y.T @ y
        for length, p in total.items():
            columns = [pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()), pa.array([deal] * length, pa.int32()), pa.array(list(p), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["length", "at", "deal", "p"])

    return multiply


def _added(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the matrix rows of one key."""
    total, names = 0, []
    for batch in rows:
        names = batch.schema.names
        total = total + batch.column("p").values.to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
    columns = [pa.array([k.as_py()], pa.int32()) for k in key]
    kept = [n for n in names if n not in ("p", "deal")] + ["deal"] * (len(key) == 3)
    yield pa.RecordBatch.from_arrays([*columns, pa.array([total], pa.list_(pa.float64()))], names=[*kept, "p"])


def _solved(counts: dict[int, int], components: int) -> Callable:
    def solve(key: tuple, table: pa.Table) -> pa.Table:
        """Trace, leading eigenvalues and eigenvectors of the covariance of one length."""
        length = key[0].as_py()
        table = table.sort_by("at")
        matrix = np.array(table.column("p").combine_chunks().values).reshape(length, length) / counts[length]
        values, vectors = eigen.leading((matrix + matrix.T) / 2, components)
        fields = [pa.array([length], pa.int32()), pa.array([float(np.trace(matrix))]), pa.array([values.tolist()], pa.list_(pa.float64())), pa.array([vectors.ravel().tolist()], pa.list_(pa.float64()))]
        return pa.Table.from_arrays(fields, names=["length", "trace", "values", "vectors"])

    return solve


def _checks(models: dict[int, Model]) -> Callable[[Batches], Batches]:
    def check(batches: Batches) -> Batches:
        """Products of a task's whitened vectors."""
        total: dict[int, np.ndarray] = {}
        for x, _, _ in blocks(batches):
            u = np.nan_to_num(models[x.shape[1]].whitened(x))
            total[x.shape[1]] = total.get(x.shape[1], 0) + u.T @ u
        for length, p in total.items():
            k = len(p)
            columns = [pa.array([length] * k * k, pa.int32()), pa.array(np.repeat(np.arange(k), k), pa.int32()), pa.array(np.tile(np.arange(k), k), pa.int32()), pa.array(p.ravel())]
            yield pa.RecordBatch.from_arrays(columns, names=["length", "i", "j", "p"])

    return check


def _projected(models: dict[int, Model]) -> Callable[[Batches], Batches]:
    def project(batches: Batches) -> Batches:
        for x, rows, batch in blocks(batches):
            model = models[x.shape[1]]
            k = len(model.values)
            ids = batch.column("vec_id").take(pa.array(np.repeat(rows, k)))
            u = model.whitened(x).ravel()
            explained = model.values / model.trace if model.trace > 0 else np.full(k, np.nan)
            columns = [
                ids, pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array([model.n] * len(u), pa.int64()),
                pa.array([d for d in model.deviations(x) for _ in range(k)], pa.int64()), pa.array(u, mask=np.isnan(u)),
                pa.array(np.tile(explained, len(x)), mask=np.tile(np.isnan(explained), len(x))), pa.array([model.error] * len(u), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return project


def fit(distinct: DataFrame, counts: dict[int, int], components: int) -> dict[int, Model]:
    """Models of the lengths in ``counts`` from the table of distinct vectors."""
    distinct = distinct.where(F.size("x").isin(list(counts)))
    summed = distinct.mapInArrow(_sums, "length int, at int, s decimal(38,0)").groupBy("length", "at").agg(F.sum("s").alias("s"))
    models = {length: Model(n, [0] * length) for length, n in counts.items()}
    for row in summed.collect():
        models[row["length"]].sums[row["at"]] = int(row["s"])
    products = distinct.mapInArrow(_products(models), "length int, at int, deal int, p array<double>")
    dealt = products.groupBy("length", "at", "deal").applyInArrow(_added, "length int, at int, deal int, p array<double>")
    matrix = dealt.groupBy("length", "at").applyInArrow(_added, "length int, at int, p array<double>")
    solved = matrix.groupBy("length").applyInArrow(_solved(counts, components), "length int, trace double, values array<double>, vectors array<double>")
    for row in solved.collect():
        model = models[row["length"]]
        model.trace, model.values = row["trace"], np.array(row["values"])
        model.vectors = np.array(row["vectors"]).reshape(-1, row["length"])
    checked = distinct.mapInArrow(_checks(models), "length int, i int, j int, p double").groupBy("length", "i", "j").agg(F.sum("p").alias("p"))
    for row in checked.collect():
        model, varied = models[row["length"]], models[row["length"]].varied()
        if varied[row["i"]] and varied[row["j"]]:
            off = abs(row["p"] / model.n - (row["i"] == row["j"]))
            model.error = max(off, model.error or 0.0)
    return models


def whitened(vectors: DataFrame, components: int = 4, unit: int = UNIT) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = whole_vectors(vectors, unit)
    distinct = written(rows.where(F.size("x") > 0).select("x").distinct(), "vectors")
    counts = {r["length"]: r["n"] for r in distinct.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n")).orderBy("length").collect()}
    rounds: list[dict[int, int]] = [{}]
    for length, n in counts.items():
        if rounds[-1] and (sum(rounds[-1]) + length) * (components + 1) > MODEL_CELLS:
            rounds.append({})
        rounds[-1][length] = n
    parts = []
    for of in rounds:
        models = fit(distinct, of, components) if of else {}
        parts.append(rows.where(F.size("x").isin(list(of))).mapInArrow(_projected(models), RESULT))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
