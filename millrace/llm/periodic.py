"""Periodic runs of words in texts, and the texts without their repeats.

A run is a stretch of words with smallest period q, at least twice q and ``LEAST`` words long, that no
neighbouring word extends. Every run has a Lyndon root; Lyndon arrays under both orders of the words come from
Baier's grouping, roots are completed by longest common extensions (module ``lyndon``).

A run of ``LEAST`` words repeats every window of ``WINDOW`` words that lies in its first length - q words, and
such windows cover it without a gap. So only stretches of words covered by windows that occur twice in the
text, or in the same such stretch, are sorted; this leaves out most texts altogether and loses no run. Hashes
only choose the stretches; inside them words are numbered by their bytes.

Each text is handled by itself, without a shuffle; a long text is one step of a task, and needs memory in
proportion to its bytes.

Null texts have no words, as have empty ones and those of white space only: no runs, and the collapsed text
is empty. Texts of any length are read whole. Repeated rows and rows without id are handled like any other.
An empty table gives an empty result. Columns of the input named ``runs`` or ``collapsed`` are replaced,
others stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import lyndon, text
from millrace.llm.workspace import spare

LEAST = 12
#: A run of LEAST words with period q has length - q >= LEAST / 2 words before its last period.
WINDOW = LEAST // 2
RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SPACE = "[\\x20\\x09-\\x0D]+"


def stretches(words: text.Words) -> np.ndarray:
    """First word and the word behind the last of each stretch that can hold a run; none crosses two texts."""
    hashes, at, offsets = words.shingles(WINDOW)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    total = len(words.starts)
    held = -1
    while True:
        order = np.lexsort((hashes, owner))
        h, o = hashes[order], owner[order]
        same = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
        twin = np.zeros(len(h), dtype=bool)
        twin[1:] = same
        twin[:-1] |= same
        kept = np.sort(order[twin])
        hashes, at, owner = hashes[kept], at[kept], owner[kept]
        # stretches: windows of one owner that touch or overlap
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] > at[:-1] + WINDOW) | (owner[1:] != owner[:-1])
        label = np.cumsum(new) - 1
        first = at[new]
        last = at[np.append(new[1:], True)[: len(at)]] + WINDOW if len(at) else at
        long = (last - first) >= LEAST
        inside = long[label] if len(at) else np.zeros(0, dtype=bool)
        hashes, at, owner = hashes[inside], at[inside], label[inside]
        covered = int((last - first)[long].sum())
        if covered == held or not covered:
            return np.stack((first[long], last[long]), axis=1) if total else np.zeros((0, 2), dtype=np.int64)
        held = covered


def numbered(words: text.Words, first: int, last: int) -> np.ndarray:
    """A stretch of words as numbers; equal numbers are equal words, byte for byte."""
    joined, ends = joined_words(words, np.arange(first, last))
    offsets = np.concatenate(([0], ends)).astype(np.int32 if len(joined) < 1 << 31 else np.int64)
    kind = pa.BinaryArray if offsets.dtype == np.int32 else pa.LargeBinaryArray
    array = kind.from_buffers(pa.binary() if offsets.dtype == np.int32 else pa.large_binary(), last - first, [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    return array.dictionary_encode().indices.to_numpy().astype(np.int64)


def joined_words(words: text.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the chosen words, each followed by a space, and where each ends (behind the space)."""
    sizes = words.ends[which] - words.starts[which] + 1
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(words.starts[which] - (ends - sizes), sizes)
    out = words.data[np.minimum(at, len(words.data) - 1)] if len(at) else np.zeros(0, dtype=np.uint8)
    out[ends - 1] = 32
    return out, ends


def _found(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    reader = text.WordReader(np.arange(256, dtype=np.uint8), text.unspaced())
    for batch in text.steps(batches, name):
        words = reader.read(batch.column(name))
        n = len(words.first) - 1
        runs: list[list[dict]] = [[] for _ in range(n)]
        drops = np.zeros(len(words.starts) + 1, dtype=np.int64)
        for first, last in stretches(words):
            owner = int(np.searchsorted(words.first, first, "right")) - 1
            begin = int(first - words.first[owner])
            for start, length, period in lyndon.runs(numbered(words, first, last), LEAST):
                runs[owner].append({"start": begin + start, "length": length, "period": period})
                drops[first + start + period] += 1
                drops[first + start + length] -= 1
        which = np.flatnonzero(np.cumsum(drops[:-1]) == 0)
        data, ends = joined_words(words, which)
        bounds = np.searchsorted(which, words.first)
        stops = np.concatenate(([0], ends))[bounds]
        raw = data.tobytes()
        collapsed = [raw[a : max(a, b - 1)] for a, b in zip(stops[:-1], stops[1:], strict=True)]
        columns = [batch.column(c) for c in batch.schema.names if c != name]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(runs, pa.list_(_RUN)), pa.array(collapsed, pa.binary())], names=[c for c in batch.schema.names if c != name] + ["runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The input's columns without the text, then ``runs``, by start and period, and ``collapsed``.

    Collapsed are the words outside of every run, or in the first period of all runs that hold them, joined by
    one space.
    """
    kept = docs.drop("runs", "collapsed")
    name = spare(kept, "text_")
    rows = kept.withColumn(name, F.col("text").cast("string")).drop("text")
    others = [f for f in rows.schema.fields if f.name != name]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], f"runs {RUNS}", "collapsed binary"])
    found = rows.mapInArrow(lambda batches: _found(batches, name), schema)
    # equal starts: shorter periods first
    return found.withColumns({"runs": F.array_sort("runs"), "collapsed": F.decode("collapsed", "UTF-8")})


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts, chosen by the id, repeat some of their words to the end.

    With h = crc32(doc_id), texts with h % 10 = 0 and n > 0 words go on from word a = floor(h / 10) % n with
    period 1 + floor((n - a) / (3 + floor(h / 10) % 8)). They come out with single spaces, others untouched.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", _SPACE), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    rows = rows.select("*", n.alias("n"), (g % n).alias("a"), g.alias("g"))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = F.transform(F.sequence(F.col("a"), F.col("n") - 1), lambda i: F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    head = F.slice("words", F.lit(1), F.col("a").cast("int"))
    changed = F.array_join(F.concat(head, place), " ")
    return rows.select("doc_id", F.when(F.col("words").isNotNull() & (F.col("n") > 0), changed).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run with its exponent, and digests of runs and collapsed text."""
    by_length = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    rows = found.withColumn("_top", F.get(by_length, F.lit(0)))
    length, period = -F.col("_top.n"), F.col("_top.period")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_top.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

