"""Quality classifier from weak labels.

Heuristic labellers look at the shape of a text and vote low, high or not at all. Expectation
maximisation over the counts of vote patterns, for all documents, estimates how often each labeller
votes each way on texts of either kind, without any given label; that gives every pattern a posterior.
The posteriors of a sample of documents train a logistic scorer over hashed word shapes, which then
scores every document from its whole text, also where no labeller voted.

The patterns are at most 3 ** (number of labellers) and one, whatever the corpus. The scorer is fitted on
about ``SAMPLE`` documents, chosen by a hash. Scoring needs no shuffle.

Null and empty texts, and texts without words, have no votes, the posterior of no votes, score 0 and
are not kept. An empty table gives an empty result. Repeated rows are judged alike, and count as often
as they occur. Columns of the input that clash with the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import text

#: Documents the scorer is fitted on, about.
SAMPLE = 6000
DIMENSIONS = 1 << 13
#: Scores from here on are kept: a text is dropped only if it is rather surely low.
KEEP = 0.5
#: Votes of a labeller: share at or below which it votes the one way, at or above which the other.
LABELLERS = {
    "odd_signs": (0.02, 0.15, "low"),
    "capitals": (0.20, 0.35, "low"),
    "repeats": (0.03, 0.15, "low"),
    "variety": (0.45, 0.60, "high"),
    "letters": (0.75, 0.90, "high"),
    "separators": (0.01, 0.10, "low"),
    "stops": (0.35, 0.60, "low"),
}
#: The vote on texts of fewer words.
SILENT = 3
_FEWEST_WORDS = 20
_STRETCH = 50
_PRIOR_WORDS = 8


def shapes() -> np.ndarray:
    """Byte table of signs: a for lower case and letters beyond ASCII, A, 0; the others stand for themselves."""
    table = np.arange(256, dtype=np.uint8)
    table[97:123] = table[128:] = ord("a")
    table[65:91] = ord("A")
    table[48:58] = ord("0")
    return table


class ShapeReader:
    """Words of texts as they are and as shapes. One per task."""

    def __init__(self) -> None:
        self.table = shapes()
        self.words = text.WordReader(text.lowering(), text.unspaced())
        self.shaped = text.WordReader(np.arange(256, dtype=np.uint8), text.unspaced())

    def read(self, texts: pa.Array) -> tuple[text.Words, np.ndarray, np.ndarray]:
        raw, bounds = text.utf8(texts)
        return self.words.read_bytes(raw, bounds), self.table[raw], bounds

    def shape_hashes(self, signs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Hash per word of its shape, with runs of the same sign as one, in the order of the words."""
        keep = np.ones(len(signs), dtype=bool)
        keep[1:] = signs[1:] != signs[:-1]
        keep[signs <= 32] = True
        keep[bounds[:-1][bounds[:-1] < len(signs)]] = True
        before = np.concatenate(([0], np.cumsum(keep)))
        return self.shaped.read_bytes(signs[keep], before[bounds]).hashes


def _per_text(values: np.ndarray, words: text.Words) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=float)))
    return total[words.first[1:]] - total[words.first[:-1]]


def _per_bytes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def same_as_before(words: text.Words) -> np.ndarray:
    same = np.zeros(len(words.hashes), dtype=bool)
    same[1:] = words.hashes[1:] == words.hashes[:-1]
    starts = words.first[:-1]
    same[starts[starts < len(same)]] = False
    return same


def votes(words: text.Words, signs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text and labeller: 0 low, 1 high, 2 no vote, 3 on a text too short to judge."""
    count = np.maximum(np.diff(words.first), 1)
    letter = (signs == ord("a")) | (signs == ord("A"))
    odd = ~letter & (signs != ord("0")) & (signs > 32)
    for plain in b".,;:!?'\"()-":
        odd &= signs != plain
    in_word = np.concatenate(([0], np.cumsum(odd)))
    letters_in_word = np.concatenate(([0], np.cumsum(letter | (signs == ord("0")))))
    has_odd = (in_word[words.ends] - in_word[words.starts] > 0) & (letters_in_word[words.ends] > letters_in_word[words.starts])
    only_signs = letters_in_word[words.ends] == letters_in_word[words.starts]
    last = signs[words.ends - 1] if len(words.ends) else signs[:0]
    ends_sentence = np.isin(last, list(b".,;:!?"))
    # distinct words by stretches of some tens, so that long texts compare with short ones
    owner = np.repeat(np.arange(len(count)), np.diff(words.first))
    stretch = (np.arange(len(owner)) - words.first[owner]) // _STRETCH
    order = np.lexsort((words.hashes, stretch, owner))
    fresh = np.ones(len(order), dtype=bool)
    if len(order) > 1:
        a, b = order[1:], order[:-1]
        fresh[1:] = (words.hashes[a] != words.hashes[b]) | (stretch[a] != stretch[b]) | (owner[a] != owner[b])
    distinct = np.bincount(owner[order][fresh], minlength=len(count)).astype(float)
    letters = _per_bytes(letter, bounds)
    share = {
        "odd_signs": _per_text(has_odd, words) / count,
        "capitals": _per_bytes(signs == ord("A"), bounds) / np.maximum(letters, 1),
        "repeats": _per_text(same_as_before(words), words) / count,
        "variety": distinct / count,
        "letters": letters / np.maximum(_per_bytes(signs > 32, bounds), 1),
        "separators": _per_text(only_signs, words) / count,
        "stops": _per_text(ends_sentence, words) / count,
    }
    out = np.full((len(count), len(LABELLERS)), 2, dtype=np.int64)
    enough = np.diff(words.first) >= _FEWEST_WORDS
    for j, (name, (lower, upper, above)) in enumerate(LABELLERS.items()):
        out[share[name] <= lower, j] = 1 if above == "low" else 0
        out[share[name] >= upper, j] = 0 if above == "low" else 1
    out[~enough] = SILENT
    return out


def _patterns(found: np.ndarray) -> np.ndarray:
    return found @ 4 ** np.arange(found.shape[1])


def _unpacked(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 4 ** np.arange(len(LABELLERS)) % 4


@dataclass
class LabelModel:
    """Share of high texts, and per class, labeller and vote how often it occurs.

    That a labeller doesn't vote on a text long enough is a vote as well. The votes on a short text
    (``SILENT``) say nothing, and its posterior is the share of high texts.
    """

    high: float
    chance: np.ndarray

    def posterior(self, found: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is high."""
        logs = np.concatenate((np.log(self.chance), np.zeros((2, len(LABELLERS), 1))), axis=2)
        both = [np.log(p) + sum(logs[c, j, found[:, j]] for j in range(found.shape[1])) for c, p in enumerate((1 - self.high, self.high))]
        return 1 / (1 + np.exp(np.clip(both[0] - both[1], -700, 700)))

    def accuracies(self) -> dict[str, float]:
        """How often a labeller is right where it votes."""
        prior = np.array([1 - self.high, self.high])
        right = sum(prior[c] * self.chance[c, :, c] for c in (0, 1))
        return dict(zip(LABELLERS, (right / (prior @ self.chance[:, :, :2].sum(axis=2).reshape(2, -1))).tolist(), strict=True))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """EM over vote patterns; it starts from any low vote being a sign of a low text."""
    found, weight = _unpacked(patterns), counts.astype(float)
    found, weight = found[found[:, 0] != SILENT], weight[found[:, 0] != SILENT]
    low, high = (found == 0).sum(axis=1), (found == 1).sum(axis=1)
    posterior = np.where(low > 0, 0.15, np.where(high > 0, 0.95, 0.5))
    model = LabelModel(0.5, np.full((2, len(LABELLERS), 3), 1 / 3))
    for _ in range(rounds):
        total = np.array([(weight * (1 - posterior)).sum(), (weight * posterior).sum()])
        chance = np.empty((2, len(LABELLERS), 3))
        for c, own in enumerate((weight * (1 - posterior), weight * posterior)):
            for j in range(len(LABELLERS)):
                chance[c, j] = np.bincount(found[:, j], weights=own, minlength=4)[:3] + 0.5
        chance /= chance.sum(axis=2, keepdims=True)
        model = LabelModel(float((total[1] + 1) / (total.sum() + 2)), chance)
        moved = model.posterior(found)
        if np.abs(moved - posterior).max(initial=0) < 1e-9:
            break
        posterior = moved
    return model


def features(reader: ShapeReader, words: text.Words, signs: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a sparse matrix: text, dimension, share of the text's words with that shape."""
    count = np.diff(words.first)
    owner = np.repeat(np.arange(len(count)), count)
    shape = reader.shape_hashes(signs, bounds)
    shape = np.where(same_as_before(words), text.mix(shape ^ np.uint64(0x5EED)), shape)
    place = (shape >> np.uint64(20)).astype(np.int64) % DIMENSIONS
    cells, n = np.unique(owner * DIMENSIONS + place, return_counts=True)
    rows = cells // DIMENSIONS
    return rows, cells % DIMENSIONS, np.sqrt(n / count[rows])


def fit_scorer(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Weights, the last being the constant, of a logistic scorer for soft labels (gradient descent with momentum)."""
    weights, momentum = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    if not len(labels):
        return weights
    for _ in range(rounds):
        raw = np.bincount(rows, weights=weights[columns] * values, minlength=len(labels)) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(raw, -500, 500))) - labels
        slope = np.append(np.bincount(columns, weights=error[rows] * values, minlength=DIMENSIONS), error.sum()) / len(labels)
        slope[:-1] += decay * weights[:-1]
        momentum = 0.9 * momentum - 2.0 * slope
        weights += momentum
    return weights


def _sampled(docs: DataFrame, n: int, sample: int) -> DataFrame:
    return docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, n // sample))) == 0)


def _count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, total = ShapeReader(), np.zeros(4 ** len(LABELLERS), dtype=np.int64)
    for batch in text.steps(batches, "text"):
        words, signs, bounds = reader.read(batch.column("text"))
        np.add.at(total, _patterns(votes(words, signs, bounds)), 1)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["pattern", "n"])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = ShapeReader()
    for batch in text.steps(batches, "text"):
        words, signs, bounds = reader.read(batch.column("text"))
        rows, columns, values = features(reader, words, signs, bounds)
        split = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        lists = [(columns[a:b].tolist(), values[a:b].tolist()) for a, b in zip(split[:-1], split[1:], strict=True)]
        arrays = [batch.column("doc_id"), pa.array(_patterns(votes(words, signs, bounds)))]
        arrays += [pa.array([x[0] for x in lists], pa.list_(pa.int64())), pa.array([x[1] for x in lists], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "pattern", "columns", "values"])


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[LabelModel, np.ndarray]:
    """The label model over all documents (doc_id, text) and the scorer's weights."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    counted = docs.select("text").mapInArrow(_count_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas()
    model = fit_labels(counted["pattern"].to_numpy(), counted["n"].to_numpy())
    drawn = _sampled(docs, int(counted["n"].sum()), sample).mapInArrow(_sample_features, "doc_id long, pattern long, columns array<long>, values array<double>")
    # texts too short to judge teach nothing
    silent = int(_patterns(np.full((1, len(LABELLERS)), SILENT))[0])
    drawn = drawn.where((F.size("columns") > 0) & (F.col("pattern") != silent)).toPandas().sort_values(["doc_id", "pattern"], kind="stable")
    sizes = drawn["columns"].map(len).to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(drawn)), sizes)
    columns = np.concatenate([*drawn["columns"], np.zeros(0, dtype=np.int64)]).astype(np.int64)
    values = np.concatenate([*drawn["values"], np.zeros(0)])
    labels = model.posterior(_unpacked(drawn["pattern"].to_numpy().astype(np.int64)))
    return model, fit_scorer(rows, columns, values, labels)


def scored(docs: DataFrame, sample: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` with votes (low, high or null per labeller), posterior, score and keep."""
    model, weights = fit(docs, sample)
    held = docs.sparkSession.sparkContext.broadcast((model.high, model.chance, weights))
    names = list(LABELLERS)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, chance, weight = held.value
        own, reader = LabelModel(high, chance), ShapeReader()
        spelled = pa.array(["low", "high", None, None])
        for batch in text.steps(batches, "text"):
            words, signs, bounds = reader.read(batch.column("text"))
            found = votes(words, signs, bounds)
            rows, columns, values = features(reader, words, signs, bounds)
            raw = np.bincount(rows, weights=weight[columns] * values, minlength=batch.num_rows) + weight[-1]
            # the fewer words, the more a text is taken for one like all others
            size, usual = np.diff(words.first), np.log(high / (1 - high))
            raw = (raw * size + usual * _PRIOR_WORDS) / (size + _PRIOR_WORDS)
            result = np.where(size > 0, 1 / (1 + np.exp(-np.clip(raw, -500, 500))), 0.0)
            by_name = pa.StructArray.from_arrays([spelled.take(pa.array(found[:, j])) for j in range(len(names))], names=names)
            added = [by_name, pa.array(own.posterior(found)), pa.array(result), pa.array(result >= keep) if keep > 0 else pa.array(result > 0)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "votes", "posterior", "score", "keep"])

    kept = docs.drop(*[c for c in docs.columns if c.lower() in ("votes", "posterior", "score", "keep")])
    kinds = T.StructType([T.StructField(x, T.StringType()) for x in names])
    added = [T.StructField("votes", kinds), T.StructField("posterior", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("keep", T.BooleanType())]
    return kept.mapInArrow(score, T.StructType([*kept.schema.fields, *added]))
