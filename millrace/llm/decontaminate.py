"""Benchmark decontamination by exact word windows.

The windows of all benchmark items, normalised, form a hash set that every task holds. One pass over
the documents, without a shuffle, hashes each document's word windows, looks them up, and verifies
every hit word by word. A word inside a window that occurs is hit.

The hash set is broadcast only while its words stay below ``SET_WORDS``; a larger benchmark is cut
into slices of items below that bound, each a broadcast of its own that one more scan step looks up,
and the hits are united per document. An item too large for one slice is cut too, at window borders.

Null and empty texts have no words and no hits. An item without words has no windows. An empty
benchmark hits nothing. Repeated rows are judged alike, each for itself. Other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import text

WINDOW = 13
#: Words of benchmark text that are broadcast at once.
SET_WORDS = 4_000_000
_HIT = T.StructType([T.StructField("item", T.StringType()), T.StructField("first", T.LongType()), T.StructField("size", T.IntegerType())])


#: Per window size: hashes in order, and for each the windows that have it, as item and words.
WindowSets = dict[int, tuple[np.ndarray, list[list[tuple[str, tuple[bytes, ...]]]]]]


def window_sets(items: list[tuple[str, list[bytes]]], window: int) -> WindowSets:
    """The windows of some benchmark items; an item with fewer words is one window of its own size."""
    reader = text.WordReader(text.lowering(), text.alphanumeric())
    found: dict[int, dict[int, dict[tuple[str, tuple[bytes, ...]], None]]] = defaultdict(lambda: defaultdict(dict))
    for item, words in items:
        size = min(window, len(words))
        if not size:
            continue
        hashes, _, _ = reader.read(pa.array([b" ".join(words).decode()])).shingles(size)
        for i, value in enumerate(hashes.tolist()):
            found[size][value][(item, tuple(words[i : i + size]))] = None
    return {
        size: (np.array(sorted(values), dtype=np.uint64), [list(values[v]) for v in sorted(values)])
        for size, values in found.items()
    }


def _items(benchmark: DataFrame, window: int, set_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Slices of items with their words, each below the bound; one slice is on the driver at a time."""
    reader = text.WordReader(text.lowering(), text.alphanumeric())
    part: list[tuple[str, list[bytes]]] = []
    held = 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        words = reader.read(pa.array([row["text"]], pa.string()))
        spelled = [words.word(i) for i in range(len(words.starts))]
        for i in range(0, max(1, len(spelled) - window + 1), set_words):
            piece = spelled[i : i + set_words + window - 1]
            if part and held + len(piece) > set_words:
                yield part
                part, held = [], 0
            part.append((row["item_id"], piece))
            held += len(piece)
    if part:
        yield part


def _scan(reader: text.WordReader, sets: WindowSets, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[str, int, int]]]]:
    """Words per text, and per text the verified occurrences: item, first word, words."""
    words = reader.read(texts)
    counts = np.diff(words.first)
    hits: list[list[tuple[str, int, int]]] = [[] for _ in range(len(counts))]
    for size, (known, spelled) in sets.items():
        hashes, at, offsets = words.shingles(size)
        # most windows are told apart by 16 bits
        table = np.zeros(1 << 16, dtype=bool)
        table[(known >> np.uint64(48)).astype(np.int64)] = True
        likely = np.flatnonzero(table[(hashes >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(known, hashes[likely]), len(known) - 1)
        exact = known[place] == hashes[likely]
        for i, k in zip(likely[exact].tolist(), place[exact].tolist(), strict=True):
            own = tuple(words.word(j) for j in range(at[i], at[i] + size))
            doc = int(np.searchsorted(offsets, i, "right")) - 1
            for item, window in spelled[k]:
                if window == own:
                    hits[doc].append((item, int(at[i] - words.first[doc]), size))
    return counts, hits


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_words: int = SET_WORDS) -> DataFrame:
    """Rows of ``docs`` with n_words and the occurrences of benchmark windows: hits(item, first, size)."""
    spark = docs.sparkSession
    taken = [c for c in docs.columns if c.lower() in ("n_words", "hits")]
    result = docs.drop(*taken)
    schema = T.StructType([*result.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(_HIT))])
    for i, sets in enumerate(_broadcast(spark, benchmark, window, set_words)):
        result = result.mapInArrow(_matcher(sets, i > 0), schema)
    return result


def _broadcast(spark: SparkSession, benchmark: DataFrame, window: int, set_words: int) -> Iterator[Broadcast]:
    empty = True
    for part in _items(benchmark, window, set_words):
        empty = False
        yield spark.sparkContext.broadcast(window_sets(part, window))
    if empty:
        yield spark.sparkContext.broadcast({})


def _matcher(sets: Broadcast, again: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held = text.WordReader(text.lowering(), text.alphanumeric()), sets.value
        kind = pa.list_(pa.struct([("item", pa.string()), ("first", pa.int64()), ("size", pa.int32())]))
        for batch in text.steps(batches, "text"):
            counts, hits = _scan(reader, held, batch.column("text"))
            names, columns = list(batch.schema.names), list(batch.columns)
            if again:
                before = batch.column("hits").to_pylist()
                hits = [[*((x["item"], x["first"], x["size"]) for x in old), *new] for old, new in zip(before, hits, strict=True)]
                names, columns = names[:-2], columns[:-2]
            found = pa.array([[{"item": a, "first": b, "size": c} for a, b, c in x] for x in hits], kind)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), found], names=[*names, "n_words", "hits"])

    return match


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_words: int = SET_WORDS) -> DataFrame:
    """Rows of ``docs`` with n_words, hits, n_hit, n_items, items_sha256 and contaminated.

    A document is contaminated if at least a twentieth of its words are hit, and one at least.
    """
    found = occurrences(docs.drop(*[c for c in docs.columns if c.lower() in ("n_hit", "n_items", "items_sha256", "contaminated")]), benchmark, window, set_words)
    positions = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["first"], h["first"] + h["size"] - 1)))))
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item"])))
    return (
        found.withColumn("n_hit", F.when(F.size("hits") > 0, positions).otherwise(0).cast("long"))
        .withColumn("n_items", F.size(items).cast("long"))
        .withColumn("items_sha256", F.when(F.size("hits") > 0, F.sha2(F.array_join(items, ","), 256)).otherwise(F.lit(hashlib.sha256(b"").hexdigest())))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_words: int = SET_WORDS) -> DataFrame:
    """Documents that are not contaminated, as they were."""
    return judged(docs, benchmark, window, set_words).where(~F.col("contaminated")).select(*docs.columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_words: int = SET_WORDS) -> DataFrame:
    """The documents with the text of all hit words cut out, from the first to the last byte of each range."""
    found = occurrences(docs, benchmark, window, set_words)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = text.WordReader(text.lowering(), text.alphanumeric())
        for batch in text.steps(batches, "text"):
            words, texts = reader.read(batch.column("text")), batch.column("text").to_pylist()
            raw, bounds = text.utf8(batch.column("text"))
            for i, hits in enumerate(batch.column("hits").to_pylist()):
                if not hits:
                    continue
                keep, first = np.ones(bounds[i + 1] - bounds[i], dtype=bool), words.first[i]
                for hit in hits:
                    a, b = first + hit["first"], first + hit["first"] + hit["size"] - 1
                    keep[words.starts[a] - bounds[i] : words.ends[b] - bounds[i]] = False
                texts[i] = raw[bounds[i] : bounds[i + 1]][keep].tobytes().decode()
            at = batch.schema.get_field_index("text")
            columns = [pa.array(texts, batch.column("text").type) if j == at else batch.column(j) for j in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-2])

    kept = docs.drop(*[c for c in docs.columns if c.lower() in ("n_words", "hits")])
    return found.mapInArrow(cut, kept.schema)
