"""Quality rules from robust multivariate outliers: minimum covariance determinant per language and source.

Every text becomes a vector of four transformed statistics: logarithms of the mean length of its words, and
of its shares of odd signs, of lines that repeat an earlier one and of words in repeated windows. Shares of
short texts are drawn towards those of an ordinary text. For each pair of language and source, the estimate is the mean
and covariance of the ``CORE`` share of its texts with the smallest Mahalanobis distances, found by
concentration steps from three starts (medians and deviations; those with covariances of spatial signs;
with covariances of bounded scores); the start that ends with the smallest determinant counts. As usual, a
consistency factor and one reweighting follow. A text is rejected beyond the ``TAIL`` quantile of the
distance.

A concentration step is one pass: distances are put into fine bins, and count, sums and products are added up
per group and bin, on the map side first, so that a group with a third of all rows is no task of its own. The
bin in which the core ends counts with the share it is needed with. All texts that pass the base rules count,
whatever their number. Small groups have no covariance of their own, so every group's mean and covariance are
drawn towards those of its language, and the language's towards those of all texts, with the weight of
``PRIOR`` texts; in a group of thousands that changes nothing. Variances have a floor, since most texts have no odd signs at all.

The models, one row a group, are broadcast if their counted size is small, else joined by group, salted.

Null and empty texts, and those without words, have no words and fail the base rules. Null languages and
sources are groups like others. Repeated rows and rows without id are judged like any; copies count as often
as they occur. Texts of any length are read whole. An empty table gives an empty result. Columns other than
doc_id, text, lang and source are ignored, so none can clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import text
from millrace.llm.workspace import beside, written

#: Base rules: fewest words, and most per cent of words in repeated windows.
FEWEST = 20
REPEATED = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Share of texts an estimate rests on, and tails of the distance at the reweighting and the verdict.
CORE = 0.75
REWEIGHT = 0.025
TAIL = 1e-6
#: Words of an ordinary text, with the mean length given, that every text's shares are drawn towards.
ORDINARY = 64
ORDINARY_LENGTH = 5.0
#: Texts that the estimate of the next larger group counts for.
PRIOR = 50.0
#: Least standard deviation of each transformed statistic.
FLOORS = (0.06, 0.45, 0.45, 0.8)
STARTS = 3
STEPS = 10
#: Groups up to which models are broadcast: some 700 bytes each.
BROADCAST_GROUPS = 20_000
#: A step that lowers no logarithm of a determinant by more ends the search.
SETTLED = 1e-3
#: Bins of distances per doubling, and of a statistic per unit.
_BINS, _FINE = 16, 64
_WHITESPACE = " \t\n\x0b\f\r"
_GROUP = ("lang", "source")
P = len(FLOORS)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


# the statistics of a text


def repeated_words(words: text.Words, window: int = WINDOW) -> np.ndarray:
    """Per text, its words that lie in a window of words found twice or more in it."""
    hashes, at, offsets = words.shingles(window)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    same = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
    twin = np.zeros(len(h), dtype=bool)
    twin[1:] = same
    twin[:-1] |= same
    begins = np.sort(at[order[twin]])
    marks = np.zeros(len(words.starts) + 1, dtype=np.int64)
    np.add.at(marks, begins, 1)
    np.add.at(marks, begins + window, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(marks[:-1]) > 0)))
    return covered[words.first[1:]] - covered[words.first[:-1]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over words; the text itself goes no further."""
    reader = text.WordReader(np.arange(256, dtype=np.uint8), text.unspaced())
    names = ["doc_id", *_GROUP, "n_symbols", "n_lines", "n_dup_lines"]
    symbols = np.zeros(256, dtype=bool)
    symbols[list(SYMBOLS.encode())] = True
    for batch in text.steps(batches, "text"):
        data, bounds = text.utf8(batch.column("text"))
        words = reader.read_bytes(data, bounds)
        # a code point has one byte that doesn't continue another
        points = np.concatenate(([0], np.cumsum(reader.word[data] & ((data & 0xC0) != 0x80))))
        signs = np.concatenate(([0], np.cumsum(symbols[data])))
        lines, repeats = _lines(data, bounds, words)
        counts = {
            "n_words": np.diff(words.first), "word_chars": np.diff(points[bounds]), "n_symbols": np.diff(signs[bounds]),
            "n_lines": lines, "n_dup_lines": repeats, "n_repeat_words": repeated_words(words),
        }
        columns = [batch.column(n) for n in names[:3]] + [pa.array(counts[n], pa.int64()) for n in STATISTICS]
        yield pa.RecordBatch.from_arrays(columns, names=[*names[:3], *STATISTICS])


def _lines(data: np.ndarray, bounds: np.ndarray, words: text.Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text its lines with a word, and how many of them equal an earlier one, byte for byte."""
    lines, repeats = np.zeros(len(bounds) - 1, dtype=np.int64), np.zeros(len(bounds) - 1, dtype=np.int64)
    for i in range(len(bounds) - 1):
        found = [line for line in data[bounds[i] : bounds[i + 1]].tobytes().split(b"\n") if line.strip(b" \t\x0b\f\r")]
        lines[i], repeats[i] = len(found), len(found) - len(set(found))
    return lines, repeats


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counted statistics, base_failed and the transformed vector t0, t1, ..."""
    rows = docs.select("doc_id", *[F.col(c).cast("string").alias(c) for c in (*_GROUP, "text")])
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang string, source string, " + ", ".join(f"{n} long" for n in STATISTICS)
    counted = rows.mapInArrow(_counted, schema)
    n = F.col("n_words")
    failed = (n < FEWEST) | (100 * F.col("n_repeat_words") > REPEATED * n)
    length = F.log((F.col("word_chars") + ORDINARY * ORDINARY_LENGTH) / (n + ORDINARY))
    shares = [F.log1p(100 * F.col(c) / (of + least)) for c, of, least in (("n_symbols", n, ORDINARY), ("n_dup_lines", F.col("n_lines"), ORDINARY // WINDOW), ("n_repeat_words", n, ORDINARY))]
    return counted.withColumns({"base_failed": failed} | {f"t{i}": t for i, t in enumerate((length, *shares))})


# the distribution of a distance


def within(x: float, p: int) -> float:
    """Share of squared distances of p normal variables, p even, up to x."""
    terms = [1.0]
    for k in range(1, p // 2):
        terms.append(terms[-1] * x / (2 * k))
    return 1 - math.exp(-x / 2) * sum(terms)


def quantile(share: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if within(middle, p) < share else (low, middle)
    return high


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of normal vectors has to be multiplied with."""
    return share / within(quantile(share, P), P + 2)


# models: per group and start a mean and a matrix that turns deviations into unit distances

_MODEL = [f"m{i}" for i in range(P)] + [f"w{i}{j}" for i, j in PAIRS]
_SUMS = [f"s{i}" for i in range(P)] + [f"q{i}{j}" for i, j in PAIRS]


def _moments(t: list[Column], weight: Column | None = None) -> list[Column]:
    each = t + [t[i] * t[j] for i, j in PAIRS]
    return [F.sum(c if weight is None else c * weight).alias(n) for c, n in zip(each, _SUMS, strict=True)]


def _drawn(sums: DataFrame) -> DataFrame:
    """Means c0.. and covariances k00.. of groups, drawn towards their language and all texts.

    ``sums`` has lang, source, start, h and weighted sums. Covariances of larger groups are taken
    about the means of the groups in them, so that sources may differ in their means.
    """
    about = {f"q{i}{j}": F.col(f"q{i}{j}") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("h") for i, j in PAIRS}
    held = sums.where("h > 0").withColumns(about)
    added = [F.sum(c).alias(f"_{c}") for c in ("h", *_SUMS)]
    # a row a language, with the totals of all languages beside it
    tongues = held.groupBy("start", "lang").agg(*added)
    totals = tongues.groupBy("start").agg(*[F.sum(f"_{c}").alias(f"_all_{c}") for c in ("h", *_SUMS)])
    tongues = tongues.join(totals, "start")
    other = tongues.withColumnsRenamed({k: f"_{k}" for k in ("start", "lang")})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ("start", "lang")]
    mean = {}
    for name in _SUMS:
        top = F.col(f"_all_{name}") / F.col("_all_h")
        middle = (F.col(f"_{name}") + PRIOR * top) / (F.col("_h") + PRIOR)
        mean["c" + name[1:] if name[0] == "s" else "k" + name[1:]] = (F.col(name) + PRIOR * middle) / (F.col("h") + PRIOR)
    return held.join(other, same).withColumns(mean)


def _turned(drawn: DataFrame, factor: float) -> DataFrame:
    """Models from means and covariances, and the logarithm of the covariance's determinant."""
    names = [f"c{i}" for i in range(P)] + [f"k{i}{j}" for i, j in PAIRS]
    floors = np.diag(np.square(FLOORS))

    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            covariance = np.zeros((len(part), P, P))
            for i, j in PAIRS:
                covariance[:, i, j] = covariance[:, j, i] = part[f"k{i}{j}"] * factor
            lower = np.linalg.cholesky(covariance + floors)
            turned = np.linalg.inv(lower)
            out = part[["lang", "source", "start"]].copy()
            for i in range(P):
                out[f"m{i}"] = part[f"c{i}"]
            for i, j in PAIRS:
                out[f"w{i}{j}"] = turned[:, i, j]
            out["size"] = 2 * np.log(np.diagonal(lower, axis1=1, axis2=2)).sum(axis=1)
            yield out

    fields = ["lang string", "source string", "start int", *[f"{n} double" for n in (*_MODEL, "size")]]
    return drawn.select("lang", "source", "start", *names).mapInPandas(turn, ", ".join(fields))


def _distance(model: Column | None = None) -> Column:
    """Squared distance of a row's vector by the model in its columns, or in a struct."""

    def of(name: str) -> Column:
        return F.col(name) if model is None else model[name]

    total = F.lit(0.0)
    for i in range(P):
        y = sum(((F.col(f"t{j}") - of(f"m{j}")) * of(f"w{i}{j}") for j in range(i + 1)), F.lit(0.0))
        total = total + y * y
    return total


def _starts(rows: DataFrame, small: bool) -> DataFrame:
    """First models: per group, medians and deviations of each statistic, and three covariances about them."""
    binned = F.array(*[F.floor(F.col(f"t{i}") * _FINE) for i in range(P)])
    counts = rows.select(*_GROUP, F.posexplode(binned).alias("at", "bin")).groupBy(*_GROUP, "at", "bin").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "bins")
    medians = _weighted_median(counts, "bin").withColumnRenamed("bin", "median")
    apart = counts.join(medians.select(*[F.col(c).alias(f"_{c}") for c in (*_GROUP, "at")], "median"), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*_GROUP, "at")])
    spread = _weighted_median(apart.withColumn("far", F.abs(F.col("bin") - F.col("median"))), "far", "median")
    flat = [F.max(F.when(F.col("at") == i, (F.col("median") + 0.5) / _FINE)).alias(f"c{i}") for i in range(P)]
    flat += [F.max(F.when(F.col("at") == i, F.greatest(1.4826 * F.col("far") / _FINE, F.lit(f)))).alias(f"d{i}") for i, f in enumerate(FLOORS)]
    centres = written(spread.groupBy(*_GROUP).agg(*flat), "centres")

    placed = beside(rows, centres, _GROUP, small)
    z = [(F.col(f"t{i}") - F.col(f"c{i}")) / F.col(f"d{i}") for i in range(P)]
    placed = placed.withColumns({f"z{i}": c for i, c in enumerate(z)})
    length = F.sqrt(sum((F.col(f"z{i}") ** 2 for i in range(P)), F.lit(1e-12)))
    placed = placed.withColumn("length", length)
    signs = [F.col(f"z{i}") / F.col("length") for i in range(P)]
    scores = [F.tanh(F.col(f"z{i}")) for i in range(P)]
    agg = [F.avg(signs[i] * signs[j]).alias(f"a{i}{j}") for i, j in PAIRS] + [F.covar_pop(scores[i], scores[j]).alias(f"b{i}{j}") for i, j in PAIRS]
    firsts = placed.groupBy(*_GROUP, *[f"{k}{i}" for k in "cd" for i in range(P)]).agg(*agg)
    each = []
    for start in range(STARTS):
        k = {0: lambda i, j: F.lit(float(i == j)), 1: lambda i, j: P * F.col(f"a{i}{j}"), 2: lambda i, j: F.col(f"b{i}{j}")}[start]
        each.append(firsts.select(*_GROUP, F.lit(start).alias("start"), *[f"c{i}" for i in range(P)], *[(k(i, j) * F.col(f"d{i}") * F.col(f"d{j}")).alias(f"k{i}{j}") for i, j in PAIRS]))
    return _turned(each[0].unionByName(each[1]).unionByName(each[2]), 1.0)


def _weighted_median(counts: DataFrame, value: str, *carried: str) -> DataFrame:
    """Per group and statistic, the value with half of the count up to it."""
    up = Window.partitionBy(*_GROUP, "at").orderBy(value, *[c for c in ("bin",) if c in counts.columns and c != value])
    whole = Window.partitionBy(*_GROUP, "at")
    ranked = counts.withColumn("_up", F.sum("n").over(up)).withColumn("_all", F.sum("n").over(whole))
    found = ranked.where((2 * F.col("_up") >= F.col("_all")) & (2 * (F.col("_up") - F.col("n")) < F.col("_all")))
    return found.select(*_GROUP, "at", value, *carried)


def _concentrated(rows: DataFrame, models: DataFrame, small: bool) -> DataFrame:
    """One concentration step: models from the core of each group by the distances of the models before."""
    t = [F.col(f"t{i}") for i in range(P)]
    wide = models.groupBy(*_GROUP).agg(*[F.max(F.when(F.col("start") == k, F.struct(*_MODEL))).alias(f"model{k}") for k in range(STARTS)])
    placed = beside(rows, wide, _GROUP, small)
    bins = [F.greatest(F.floor(F.log2(_distance(F.col(f"model{k}")) + 1e-9) * _BINS), F.lit(-20 * _BINS)) for k in range(STARTS)]
    binned = placed.select(*_GROUP, *[f"t{i}" for i in range(P)], F.posexplode(F.array(*bins)).alias("start", "bin"))
    counts = written(binned.groupBy(*_GROUP, "start", "bin").agg(F.count(F.lit(1)).alias("n"), *_moments(t)), "core")
    up = Window.partitionBy(*_GROUP, "start").orderBy("bin")
    whole = Window.partitionBy(*_GROUP, "start")
    before = F.sum("n").over(up) - F.col("n")
    needed = F.ceil(F.sum("n").over(whole) * CORE)
    share = F.least(F.greatest((needed - before) / F.col("n"), F.lit(0.0)), F.lit(1.0))
    weighted = counts.withColumn("share", share).where("share > 0")
    sums = weighted.groupBy(*_GROUP, "start").agg(F.sum(F.col("n") * F.col("share")).alias("h"), *[F.sum(F.col(n) * F.col("share")).alias(n) for n in _SUMS])
    return _turned(_drawn(sums), consistency(CORE))


def estimates(rows: DataFrame, small: bool) -> DataFrame:
    """Per language and source the reweighted estimate, as a model."""
    models = written(_starts(rows, small), "models")
    for _ in range(STEPS):
        after = written(_concentrated(rows, models, small), "models")
        old = models.select(*[F.col(c).alias(f"_{c}") for c in (*_GROUP, "start", "size")])
        moved = after.join(old, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*_GROUP, "start")])
        change = moved.agg(F.max(F.abs(F.col("size") - F.col("_size")))).first()[0]
        models = after
        if change is None or change < SETTLED:
            break
    best = models.groupBy(*_GROUP).agg(F.min_by(F.struct(*_MODEL), F.struct("size", "start")).alias("m")).select(*_GROUP, "m.*")
    best = written(best, "models")
    t = [F.col(f"t{i}") for i in range(P)]
    near = beside(rows, best, _GROUP, small).where(_distance() <= quantile(1 - REWEIGHT, P))
    sums = near.groupBy(*_GROUP).agg(F.lit(0).alias("start"), F.count(F.lit(1)).alias("h"), *_moments(t))
    return written(_turned(_drawn(sums), consistency(1 - REWEIGHT)), "models")


def judged(docs: DataFrame, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """doc_id, lang, source, the statistics, base_failed, the squared distance and kept."""
    rows = written(statistics(docs), "statistics")
    small = rows.select(*_GROUP).distinct().count() <= broadcast_groups
    models = estimates(rows.where(~F.col("base_failed")), small)
    found = beside(rows, models.drop("size", "start"), _GROUP, small, "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & (F.col("distance") <= quantile(1 - TAIL, P))
    return found.select("doc_id", *_GROUP, *STATISTICS, "base_failed", "distance", F.coalesce(kept, F.lit(False)).alias("kept"))
