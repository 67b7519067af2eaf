"""Stupid-backoff scores of all documents from n-gram counts of all documents.

The tokens are characters, lower-cased A-Z, the n-grams up to ``ORDER`` of them. A character after its
context of k - 1 characters scores count(n-gram) / count(context) for the longest n-gram that also occurs
outside of the document, times ``ALPHA`` for each order given up; a single character always counts. Counts are
those of all documents, so a text is no evidence for itself only where nothing else is. Nothing is cut off: every
n-gram of the corpus is in the tables. A document's score is the sum of the logarithms.

The work is relational and in blocks. Documents are dealt to blocks of some megabytes by their place in
a written table, so that copies are spread. Each block is exploded into its distinct n-grams with their counts;
a frequent n-gram is one row per block, however often it occurs. The count tables are the sums by n-gram hash,
partitioned by it, and joined back to the blocks' rows. With the counts of its own n-grams at hand a block
adds up the scores of its documents. Whether an n-gram occurs elsewhere is seen from its count if that
exceeds the block's own or the document's length; the few others are counted in the document.

Null and empty texts have no characters, score 0 and no mean. Repeated rows count as often as they
occur, each as a document of its own, and get a row each. A long text is one step and needs memory in
proportion. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text
from millrace.llm.workspace import removed, written

ORDER = 5
ALPHA = 0.4
#: Bytes of text per block, about.
BLOCK_BYTES = 12 << 20
_PLACES = 1 << 18
#: Most bits of an n-gram that is written as places in the alphabet of its texts.
_PACKED = 64


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts in a row, and the number of each text."""
    raw, bounds = text.utf8(texts)
    lead = (raw & 0xC0) != 0x80
    points = np.frombuffer(text.lowering()[raw].tobytes().decode().encode("utf-32-le"), dtype="<u4")
    before = np.concatenate(([0], np.cumsum(lead)))
    return points, np.diff(before[bounds])


def _grams(points: np.ndarray, depth: np.ndarray, order: int, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per size the places in [first, last) with that many characters of their text up to them, and the hashes there."""
    factors = text.position_factors(order)
    total = np.zeros(last - first, dtype=np.uint64)
    for size in range(1, order + 1):
        at = np.arange(first, last) - (size - 1)
        total += np.where(at >= 0, points[np.maximum(at, 0)], 0).astype(np.uint64) * factors[size - 1]
        places = np.flatnonzero(depth[first:last] >= size - 1)
        yield places, text.mix(total[places] + np.uint64(size))


def _packed(points: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """The code points there are, the place of each character among them, and bits per place; None if n-grams need too many."""
    there = np.bincount(points)
    alphabet = np.flatnonzero(there)
    bits = max(1, int(len(alphabet) - 1).bit_length())
    if order * bits > _PACKED:
        return None
    there[alphabet] = np.arange(len(alphabet))
    return alphabet.astype(np.uint64), there[points].astype(np.uint32 if order * bits <= 32 else np.uint64), bits


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[: len(keys)]
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _counted(points: np.ndarray, depth: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sizes, hashes of n-grams of the size and how often they occur; an n-gram may come several times.

    The shorter n-grams are the ends of the longest, so only distinct ones are cut, beside those at a text's beginning.
    """
    packed = _packed(points, order) if len(points) else None
    factors = text.position_factors(order)
    for start in range(0, len(points), _PLACES * 2):
        stop = min(len(points), start + _PLACES * 2)
        if packed is None:
            for size, (_, hashes) in enumerate(_grams(points, depth, order, start, stop), 1):
                yield size, *np.unique(hashes, return_counts=True)
            continue
        alphabet, codes, bits = packed
        before = min(start, order - 1)
        part, whole = codes[start - before : stop], np.zeros(stop - start, dtype=codes.dtype)
        for back in range(order):
            whole[max(0, back - before) :] |= part[max(0, before - back) : max(0, len(part) - back)] << codes.dtype.type(bits * back)
        ends, mask = depth[start:stop], codes.dtype.type((1 << bits) - 1)
        keys, counts = np.zeros(0, dtype=codes.dtype), np.zeros(0, dtype=np.int64)
        for size in range(order, 0, -1):
            kept = codes.dtype.type((1 << bits * size) - 1)
            # of that many characters and no more before them, or of any number for the longest
            new = whole[ends >= size - 1] if size == order else whole[ends == size - 1] & kept
            own, n = np.unique(new, return_counts=True)
            keys, counts = (own, n) if size == order else _summed(np.concatenate((keys & kept, own)), np.concatenate((counts, n)))
            total = np.zeros(len(keys), dtype=np.uint64)
            for back in range(size):
                total += alphabet[(keys >> codes.dtype.type(bits * back) & mask).astype(np.int64)] * factors[back]
            yield size, text.mix(total + np.uint64(size)), counts


def _depth(sizes: np.ndarray) -> np.ndarray:
    """Characters of the same text before each place."""
    begin = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(begin, sizes)


def _pieces(table: pa.Table) -> Iterator[pa.RecordBatch]:
    return text.steps(iter(table.combine_chunks().to_batches()), "text")


def _exploded(order: int) -> Callable[[pa.Table], pa.Table]:
    def explode(block: pa.Table) -> pa.Table:
        parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order)]
        for piece in _pieces(block):
            points, sizes = _codes(piece.column("text"))
            for size, hashes, n in _counted(points, _depth(sizes), order):
                parts[size - 1].append((hashes, n))
        grams, counts, sizes_of = [], [], []
        for size, found in enumerate(parts, 1):
            if not found:
                continue
            keys, n = _summed(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))
            grams.append(keys)
            counts.append(n)
            sizes_of.append(np.full(len(keys), size, dtype=np.int8))
        key = block.column("block")[0].as_py() if block.num_rows else 0
        gram = np.concatenate([*grams, np.zeros(0, np.uint64)]).view(np.int64)
        return pa.table(
            {
                "block": pa.array(np.full(len(gram), key, dtype=np.int32)),
                "gram": pa.array(gram),
                "size": pa.array(np.concatenate([*sizes_of, np.zeros(0, np.int8)]).astype(np.int8)),
                "n": pa.array(np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64)),
            }
        )

    return explode


class _Counts:
    """Counts by n-gram hash, in order, with an index of the upper bits."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alone: np.ndarray):
        grams = grams.view(np.uint64)
        order = np.argsort(grams)
        # one row more, for n-grams that aren't in the table
        self.grams = np.append(grams[order], np.uint64(0))
        self.counts = np.append(counts[order].astype(float), 0.0)
        self.alone = np.append(alone[order], False)
        bits = max(18, len(grams).bit_length())
        self.shift = np.uint64(64 - bits)
        self.index = np.searchsorted(self.grams[:-1] >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32 if len(grams) < 1 << 31 else np.int64)
        #: ln of count(n-gram) / count(context), once it was needed
        self.logs = np.full(len(self.grams), np.nan)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row of each, the last if it isn't in the table."""
        top = (wanted >> self.shift).astype(np.int64)
        at, stop = self.index[top], self.index[top + 1]
        out = np.where((at < stop) & (self.grams[at] == wanted), at, len(self.grams) - 1)
        left = np.flatnonzero((at + 1 < stop) & (out == len(self.grams) - 1))
        at, stop, wanted = at[left] + 1, stop[left], wanted[left]
        while len(left):
            hit = self.grams[at] == wanted
            out[left[hit]] = at[hit]
            at = at + 1
            more = np.flatnonzero(~hit & (at < stop))
            left, at, stop, wanted = left[more], at[more], stop[more], wanted[more]
        return out


def _hashes(points: np.ndarray, ends: np.ndarray, size: int, factors: np.ndarray) -> np.ndarray:
    """Hashes of the n-grams of ``size`` characters that end at some places, as ``_grams`` has them."""
    if len(ends) and 2 * len(ends) > ends[-1] - ends[0]:
        # nearly all places in a row
        first, last = int(ends[0]), int(ends[-1]) + 1
        total = np.zeros(last - first, dtype=np.uint64)
        for back in range(size):
            total += points[first - back : last - back] * factors[back]
        if len(total) > len(ends):
            total = total[ends - first]
    else:
        total = np.zeros(len(ends), dtype=np.uint64)
        for back in range(size):
            total += points[ends - back] * factors[back]
    return text.mix(total + np.uint64(size))


def _log_scores(points: np.ndarray, sizes: np.ndarray, order: int, alpha: float, tables: _Counts, characters: float) -> np.ndarray:
    """ln S of each place of some texts."""
    points = points.astype(np.uint64)
    depth, owner, factors = _depth(sizes), np.repeat(np.arange(len(sizes)), sizes), text.position_factors(order)
    out, open_ = np.zeros(len(points)), np.ones(len(points), dtype=bool)
    for size in range(order, 0, -1):
        tried, alone = [], []
        for first in range(0, len(points), _PLACES):
            ends = first + np.flatnonzero(open_[first : first + _PLACES] & (depth[first : first + _PLACES] >= size - 1))
            grams = _hashes(points, ends, size, factors)
            rows = tables.find(grams)
            logs = tables.logs[rows]
            new = np.flatnonzero(np.isnan(logs))
            if len(new):
                # an n-gram has one context, so each is looked up for few of the places
                before = tables.counts[tables.find(_hashes(points, ends[new] - 1, size - 1, factors))] if size > 1 else characters
                logs[new] = np.log(tables.counts[rows[new]] / before)
                tables.logs[rows[new]] = logs[new]
            out[ends] += logs
            tried.append(ends)
            if size > 1:
                few = np.flatnonzero(tables.alone[rows])
                few = few[tables.counts[rows[few]] <= sizes[owner[ends[few]]]]
                alone.append((ends[few], grams[few], rows[few]))
        back = np.zeros(0, dtype=np.int64)
        if alone:
            ends, grams, rows = (np.concatenate(x) for x in zip(*alone, strict=True))
            n = tables.counts[rows]
            # owners are in order, so one number stands for owner and n-gram
            _, run, times = np.unique(owner[ends] * len(tables.grams) + rows, return_inverse=True, return_counts=True)
            # places that a longer n-gram has scored hold this one too
            own = times[run]
            own += _scored_elsewhere(points, depth, owner, open_, size, factors, owner[ends], grams, n > own)
            only = own >= n
            back = ends[only]
            out[back] += np.log(alpha) - tables.logs[rows[only]]
        done = np.concatenate([*tried, np.zeros(0, dtype=np.int64)])
        open_[done] = False
        open_[back] = True
    return out


def _scored_elsewhere(
    points: np.ndarray, depth: np.ndarray, owner: np.ndarray, open_: np.ndarray, size: int, factors: np.ndarray,
    owners: np.ndarray, grams: np.ndarray, wanted: np.ndarray,
) -> np.ndarray:
    """How often each wanted n-gram of a text also ends at places that are no longer open."""
    found = np.zeros(len(grams), dtype=np.int64)
    wanted = np.flatnonzero(wanted)
    if not len(wanted) or open_.all():
        return found
    keys = text.mix(grams[wanted] ^ text.mix(owners[wanted].astype(np.uint64)))
    known, place = np.unique(keys, return_inverse=True)
    times = np.zeros(len(known), dtype=np.int64)
    texts = np.zeros(int(owner[-1]) + 1, dtype=bool)
    texts[owners[wanted]] = True
    for first in range(0, len(points), _PLACES):
        part = slice(first, first + _PLACES)
        ends = first + np.flatnonzero(~open_[part] & (depth[part] >= size - 1) & texts[owner[part]])
        here = text.mix(_hashes(points, ends, size, factors) ^ text.mix(owner[ends].astype(np.uint64)))
        at = np.minimum(np.searchsorted(known, here), len(known) - 1)
        np.add.at(times, at[known[at] == here], 1)
    found[wanted] = times[place]
    return found


def _scorer(order: int, alpha: float, characters: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(docs: pa.Table, counts: pa.Table) -> pa.Table:
        tables = _Counts(*(counts.column(c).to_numpy() for c in ("gram", "total", "alone")))
        ids, lengths, sums = [], [], []
        for piece in _pieces(docs):
            points, sizes = _codes(piece.column("text"))
            values = _log_scores(points, sizes, order, alpha, tables, characters)
            total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=values, minlength=len(sizes))
            ids.append(piece.column("doc_id"))
            lengths.append(sizes)
            sums.append(total)
        return pa.table(
            {
                "doc_id": pa.chunked_array(ids, pa.int64()),
                "n_chars": pa.array(np.concatenate([*lengths, np.zeros(0)]).astype(np.int64)),
                "log_score": pa.array(np.concatenate([*sums, np.zeros(0)]).astype(float)),
            }
        )

    return score


def scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_chars, log_score and mean_log_score for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    dealt = written(rows.withColumn("block", block), "backoff-texts")
    grams = written(dealt.groupBy("block").applyInArrow(_exploded(order), "block int, gram long, size byte, n long"), "backoff-grams")
    tables = grams.groupBy("gram").agg(F.sum("n").alias("total"))
    characters = grams.where("size = 1").agg(F.sum("n")).first()[0] or 0
    # n-grams that also occur in other blocks need no look into the documents
    wanted = grams.select("block", F.col("gram").alias("wanted"), "n")
    answers = wanted.join(tables, F.col("wanted") == F.col("gram")).select("block", "gram", "total", (F.col("n") == F.col("total")).alias("alone"))
    answers = written(answers, "backoff-counts")
    removed(grams)
    found = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _scorer(order, alpha, float(characters)), "doc_id long, n_chars long, log_score double"
    )
    return found.withColumn("mean_log_score", F.when(F.col("n_chars") > 0, F.col("log_score") / F.col("n_chars")))
