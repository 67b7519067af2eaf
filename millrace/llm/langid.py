"""Language identification by character language models.

Each language has an interpolated Kneser-Ney model over characters: raw counts for the longest
n-grams, counts of distinct left neighbours below, one discount per order. Texts are lower-cased and
every run of characters that aren't letters becomes one space. The models lie side by side: per order,
one array of n-gram hashes in order, and beside it the log-probabilities in every language. A text
goes to the language with the lowest cross-entropy per character.

Calibration: part of the training sample is held back from the counts. On it a factor is chosen that
turns differences of cross-entropy into probabilities (least log-loss), which gives ``score``, and per
language a limit on the cross-entropy. Above the limit, which is wider for short texts, a text is
rejected: it is unlike every language learned.

The models are fitted on a sample of about ``TRAINING_DOCS`` documents per language, chosen by a hash
of the document, whatever the size of the corpus; that bounds the tables that are broadcast. Every
whole text is scored, without a shuffle.

Null, empty and letterless texts get ``und`` with score 0 and are rejected. Ties go to the language
first by code point. Without training rows everything is ``und``. Repeated rows are judged alike.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import text

#: Documents per language that models and calibration are fitted on, about.
TRAINING_DOCS = 1000
ORDER = 4
UNKNOWN = "und"
#: Places whose probabilities are looked up at a time.
PLACES = 1 << 17
_SPACE, _EDGE, _OTHER = 1, 2, 3
_FACTORS = 2.0 ** np.arange(0, 12)

#: Per order from 1: gram hashes, their index, log-probabilities; context hashes, index, log back-off weights.
Tables = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def letter_codes() -> np.ndarray:
    """Code of each code point: its lower-case letter (one code for all letters beyond 16 bits), else a space."""
    codes = np.full(sys.maxunicode + 1, _SPACE, dtype=np.uint16)
    for point in range(sys.maxunicode + 1):
        letter = chr(point)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            codes[point] = low if low < 65536 else _OTHER
    return codes


def _stream(texts: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts, each after ORDER - 1 edge codes, runs of spaces as one; text of each code; texts with letters."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4") for t in texts]
    sizes = np.array([len(p) + ORDER - 1 for p in points])
    out = np.full(int(sizes.sum()), _EDGE, dtype=np.uint16)
    begin = np.cumsum(sizes) - sizes
    for b, p in zip(begin.tolist(), points, strict=True):
        out[b + ORDER - 1 : b + ORDER - 1 + len(p)] = codes[p]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != _SPACE) | (out[:-1] != _SPACE)
    letters = np.bincount(owner[out > _EDGE], minlength=len(texts)) > 0
    return out[keep], owner[keep], letters


def _grams(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER codes up to each predicted place, in one number, and the places."""
    at = np.flatnonzero(stream != _EDGE)
    keys = np.zeros(len(at), dtype=np.uint64)
    for i in range(ORDER - 1, -1, -1):
        keys = keys << np.uint64(16) | stream[at - i].astype(np.uint64)
    return keys, at


def _counter(codes: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.steps(batches, "text"):
            stream, owner, _ = _stream(batch.column("text").to_pylist(), codes.value)
            keys, at = _grams(stream)
            for language in sorted(set(batch.column("lang").to_pylist())):
                own = np.array([x == language for x in batch.column("lang").to_pylist()])
                grams, n = np.unique(keys[own[owner[at]]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    return count


def _unite(arrays: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(arrays)) if arrays else np.zeros(0, dtype=np.uint64)


def _by_hash(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes in order, an index of them by their upper 16 bits, and the values in that order."""
    hashes = text.mix(keys)
    order = np.argsort(hashes)
    hashes = hashes[order]
    index = np.searchsorted(hashes >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64))
    return hashes, index.astype(np.int32), values[order]


def _find(hashes: np.ndarray, index: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, or -1."""
    wanted = text.mix(keys)
    top = (wanted >> np.uint64(48)).astype(np.int64)
    place, stop = index[top], index[top + 1]
    found = np.full(len(keys), -1, dtype=np.int64)
    open_ = np.flatnonzero(place < stop)
    at = place[open_]
    while len(open_):
        hit = hashes[at] == wanted[open_]
        found[open_[hit]] = at[hit]
        at += 1
        left = ~hit & (at < stop[open_])
        open_, at = open_[left], at[left]
    return found


def fit_tables(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Tables:
    """Kneser-Ney models of all languages from counts of their longest n-grams (gram codes, counts)."""
    languages = sorted(counts)
    levels: list[dict[str, tuple[np.ndarray, np.ndarray]]] = [counts]
    for size in range(ORDER - 1, 0, -1):
        mask = np.uint64((1 << 16 * size) - 1)
        levels.insert(0, {x: np.unique(levels[0][x][0] & mask, return_counts=True) for x in languages})
    tables: Tables = []
    below: np.ndarray | None = None
    below_keys = np.zeros(0, dtype=np.uint64)
    for size, level in enumerate(levels, 1):
        grams = _unite([level[x][0] for x in languages])
        contexts = np.unique(grams >> np.uint64(16))
        own, weight = np.zeros((len(grams), len(languages))), np.ones((len(contexts), len(languages)))
        for j, x in enumerate(languages):
            keys, n = level[x]
            once, twice = int((n == 1).sum()), int((n == 2).sum())
            discount = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
            context = np.searchsorted(contexts, keys >> np.uint64(16))
            total = np.bincount(context, weights=n, minlength=len(contexts))
            kinds = np.bincount(context, minlength=len(contexts))
            known = total > 0
            weight[known, j] = discount * kinds[known] / total[known]
            own[np.searchsorted(grams, keys), j] = (n - discount) / total[context]
        lower = np.full((len(grams), len(languages)), 1 / (len(grams) + 1)) if below is None else below[np.searchsorted(below_keys, grams & np.uint64((1 << 16 * (size - 1)) - 1))]
        below, below_keys = own + weight[np.searchsorted(contexts, grams >> np.uint64(16))] * lower, grams
        tables.append((*_by_hash(grams, np.log(below).astype(np.float32)), *_by_hash(contexts, np.log(weight).astype(np.float32))))
    return tables


def _log_probabilities(keys: np.ndarray, tables: Tables) -> np.ndarray:
    """Per place and language."""
    languages = tables[0][2].shape[1]
    out = np.zeros((len(keys), languages), dtype=np.float32)
    left = np.arange(len(keys))
    for size in range(ORDER, 0, -1):
        grams, gram_index, probability, contexts, context_index, weight = tables[size - 1]
        own = keys[left] & np.uint64((1 << 16 * size) - 1)
        place = _find(grams, gram_index, own)
        hit = place >= 0
        if hit.all() and size == ORDER:
            return probability[place]
        out[left[hit]] += probability[place[hit]]
        left, own = left[~hit], own[~hit]
        if not len(left):
            break
        place = _find(contexts, context_index, own >> np.uint64(16))
        hit = place >= 0
        out[left[hit]] += weight[place[hit]]
    else:
        out[left] -= np.log(len(tables[0][0]) + 1)
    return out


def cross_entropies(texts: list[str | None], codes: np.ndarray, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Per text and language the mean of -log p over its characters, and characters (0 without a letter)."""
    stream, owner, letters = _stream([t or "" for t in texts], codes)
    keys, at = _grams(stream)
    sums = np.zeros((len(texts), tables[0][2].shape[1]))
    chars = np.bincount(owner[at], minlength=len(texts))
    # a bounded part of the places at a time
    for i in range(0, len(at), PLACES):
        part = owner[at[i : i + PLACES]]
        values = _log_probabilities(keys[i : i + PLACES], tables)
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        sums[part[first]] += np.add.reduceat(values, first, axis=0, dtype=np.float64)
    chars = np.where(letters, chars, 0)
    return -sums / np.maximum(chars, 1)[:, None], chars


def _chances(entropies: np.ndarray, factor: float) -> np.ndarray:
    raised = np.exp(-factor * (entropies - entropies.min(axis=1, keepdims=True)))
    return raised / raised.sum(axis=1, keepdims=True)


#: Labelled texts below which a language gives none for calibration.
FEW_DOCS = 40


class Calibration:
    """Score factor and, per language, the mean cross-entropy and the distance from it that is still accepted."""

    #: Letters of an ordinary text, and texts for a limit of their own.
    REFERENCE, FEWEST = 200, 20

    def __init__(self, entropies: np.ndarray, chars: np.ndarray, truth: np.ndarray):
        languages = entropies.shape[1]
        used = chars > 0
        entropies, chars, truth = entropies[used], chars[used], truth[used]
        self.factor = 16.0
        if len(truth):
            loss = [-np.log(np.maximum(_chances(entropies, f)[np.arange(len(truth)), truth], 1e-9)).mean() for f in _FACTORS]
            self.factor = float(_FACTORS[int(np.argmin(loss))])
        # without any text to calibrate with, nothing with letters is rejected
        self.mean, self.reach = np.full(languages, 3.0), np.full(languages, 3.0)
        if not len(truth):
            return
        own = entropies[np.arange(len(truth)), truth]
        self.mean[:] = np.median(own)
        for j in np.unique(truth):
            self.mean[j] = np.median(own[truth == j])
        far = (own - self.mean[truth]) / np.maximum(1, np.sqrt(self.REFERENCE / chars))
        # languages with few texts of their own take the reach of all together
        self.reach[:] = self._limit(far)
        for j in np.unique(truth):
            if (truth == j).sum() >= self.FEWEST:
                self.reach[j] = self._limit(far[truth == j])

    @staticmethod
    def _limit(far: np.ndarray) -> float:
        return max(1.0, 2 * float(np.quantile(far, 0.999)))

    def parameters(self) -> tuple[float, np.ndarray, np.ndarray]:
        return self.factor, self.mean, self.reach


def _judge(entropies: np.ndarray, chars: np.ndarray, parameters: tuple[float, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    factor, mean, reach = parameters
    best = entropies.argmin(axis=1)
    rows = np.arange(len(best))
    score = _chances(entropies, factor)[rows, best]
    limit = mean[best] + reach[best] * np.maximum(1, np.sqrt(Calibration.REFERENCE / np.maximum(chars, 1)))
    return best, np.where(chars > 0, score, 0.0), (chars == 0) | (entropies[rows, best] > limit)


class LanguageModels:
    """Fitted models, held for broadcasting to tasks."""

    def __init__(self, languages: list[str], tables: Tables, parameters: tuple[float, np.ndarray, np.ndarray] | None, codes: np.ndarray):
        self.languages, self.tables, self.parameters, self.codes = languages, tables, parameters, codes


def fit(docs: DataFrame, docs_per_language: int = TRAINING_DOCS) -> LanguageModels:
    """Models from rows with doc_id, text and lang; the caller chooses which rows may be learned from."""
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    codes = letter_codes()
    if not sizes:
        return LanguageModels([], [], None, codes)
    # chosen by id and content, so that the same rows give the same sample however they are partitioned
    number = F.coalesce(*[F.when(F.col("lang") == x, F.lit(max(1, n // docs_per_language))) for x, n in sizes.items()])
    drawn = labelled.withColumn("drawn", F.xxhash64("doc_id", "text")).where(F.pmod("drawn", number) == 0)
    # a fifth calibrates; languages of few texts need all to learn from, and take the limits of the others
    few = [x for x, n in sizes.items() if n < FEW_DOCS]
    part = (F.pmod(F.shiftright("drawn", 32), F.lit(5)) == 0) & ~F.col("lang").isin(few)
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(codes)
    rows = drawn.where(~part).select("lang", "text").mapInArrow(_counter(held), "lang string, gram long, n long")
    counted = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    counts = {}
    for language, own in counted.groupby("lang"):
        own = own.assign(key=own["gram"].to_numpy().view(np.uint64)).sort_values("key")
        counts[language] = (own["key"].to_numpy(), own["n"].to_numpy())
    languages = sorted(counts)
    if not languages:
        return LanguageModels([], [], None, codes)
    tables = fit_tables(counts)
    models = spark.sparkContext.broadcast((codes, tables))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.steps(batches, "text"):
            entropies, chars = cross_entropies(batch.column("text").to_pylist(), *models.value)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(entropies.tolist(), pa.list_(pa.float64())), pa.array(chars, pa.int64())], names=["lang", "entropies", "chars"])

    sample = drawn.where(part).select("lang", "text").mapInArrow(measure, "lang string, entropies array<double>, chars long").toPandas()
    sample = sample[sample["lang"].isin(languages)]
    entropies = np.array(sample["entropies"].tolist()).reshape(len(sample), len(languages))
    truth = np.array([languages.index(x) for x in sample["lang"]], dtype=int)
    return LanguageModels(languages, tables, Calibration(entropies, sample["chars"].to_numpy(), truth).parameters(), codes)


def identify(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """The rows of ``docs`` with lang_pred, score and rejected, from the text alone."""
    kept = docs.drop(*[c for c in docs.columns if c.lower() in ("lang_pred", "score", "rejected")])
    if not models.languages:
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "rejected": F.lit(True)})
    held = docs.sparkSession.sparkContext.broadcast((models.codes, models.tables, models.parameters, [*models.languages, UNKNOWN]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, tables, parameters, names = held.value
        names = np.array(names, dtype=object)
        for batch in text.steps(batches, "text"):
            entropies, chars = cross_entropies(batch.column("text").to_pylist(), codes, tables)
            best, score, rejected = _judge(entropies, chars, parameters)
            found = names[np.where(chars > 0, best, len(names) - 1)]
            columns = [pa.array(found, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "lang_pred", "score", "rejected"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return kept.mapInArrow(predict, T.StructType([*kept.schema.fields, *added]))


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: the remainder of crc32(doc_id as text) by 4 is 2. A null id isn't."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
