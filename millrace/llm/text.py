"""Words of many texts at once, as arrays of hashes, and small helpers the operators share.

Texts are handled as UTF-8 bytes. A run of word bytes is a word; its hash adds up the bytes, each times
a factor of its own for its place in the word, modulo 2**64, from one running sum per segment, then
mixed. Bytes differ by less than 2**8, so two words that differ share a hash for at most one in 2**56
choices of the factors, of whatever length they are and however they repeat; where a decision rests
on a single hit, callers compare the words themselves.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Hashable, Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes whose running sums are held at a time.
SEGMENT = 1 << 18
#: Places in a word whose factors are at hand; longer words are hashed by themselves.
PLACES = 1 << 14
#: Bytes of text that one step of a task works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def lowering() -> np.ndarray:
    """Byte table that lower-cases A-Z and nothing else."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def alphanumeric() -> np.ndarray:
    """Word bytes of the class [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F], after lower-casing."""
    table = np.zeros(256, dtype=bool)
    table[48:58] = table[97:123] = table[128:] = True
    return table


def unspaced() -> np.ndarray:
    """Word bytes of the class [^\\x20\\x09-\\x0D]."""
    table = np.ones(256, dtype=bool)
    table[9:14] = table[32] = False
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a list of texts: byte ranges in ``data``, hashes, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and first word of each run of k words inside one text, and each text's first run."""
        counts = np.maximum(np.diff(self.first) - (k - 1), 0)
        offsets = np.concatenate(([0], np.cumsum(counts)))
        at = np.arange(offsets[-1]) + np.repeat(self.first[:-1] - offsets[:-1], counts)
        total = np.zeros(len(at), dtype=np.uint64)
        for i, factor in enumerate(position_factors(k)):
            total += self.hashes[at + i] * factor
        return mix(total + np.uint64(k)), at, offsets

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def position_factors(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def _byte_factors(start: int, stop: int) -> np.ndarray:
    return mix((np.arange(start, stop, dtype=np.uint64) + np.uint64(1 << 40)) * np.uint64(_BASE)) | np.uint64(1)


class WordReader:
    """Cuts texts into words by two byte tables. One per task: it holds factors of the hash."""

    def __init__(self, lower: np.ndarray, word: np.ndarray):
        self.lower, self.word = lower, word
        self.factors = _byte_factors(0, PLACES)

    def read(self, texts: pa.Array) -> Words:
        """Words of all texts; a null text has none."""
        return self.read_bytes(*utf8(texts))

    def read_bytes(self, raw: np.ndarray, bounds: np.ndarray) -> Words:
        """Words of texts given as their bytes in a row and where each begins."""
        data = self.lower[raw]
        inside = np.zeros(len(data) + 1, dtype=bool)
        inside[:-1] = self.word[data]
        begins = inside[:-1].copy()
        begins[1:] &= ~inside[:-2]
        # two texts may touch without a byte between them
        seams = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
        begins[seams] = inside[seams]
        ends = inside[:-1] & ~inside[1:]
        ends[seams - 1] = inside[seams - 1]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        return Words(data, starts, stops, self.hashes(data, starts, stops), np.searchsorted(starts, bounds))

    def hashes(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=np.uint64)
        done = 0
        while done < len(starts):
            origin = starts[done]
            upto = max(done + 1, int(np.searchsorted(stops, origin + SEGMENT, "right")))
            s, e = starts[done:upto] - origin, stops[done:upto] - origin
            part, longest = data[origin : origin + e[-1]], int((e - s).max())
            if longest > PLACES:
                # rare: one word at a time, a segment of it after the other
                out[done:upto] = [self._long(part[a:b]) for a, b in zip(s, e, strict=True)]
            else:
                places = np.arange(len(part)) - np.repeat(s, np.diff(s, append=len(part)))
                sums = np.zeros(len(part) + 1, dtype=np.uint64)
                # bytes between words may lie beyond the table; they are in no sum
                terms = self.factors.take(places, mode="clip")
                terms *= part.astype(np.uint64) + np.uint64(1)
                np.cumsum(terms, out=sums[1:])
                out[done:upto] = sums[e] - sums[s]
            out[done:upto] += (e - s).astype(np.uint64)
            done = upto
        return mix(out)

    def _long(self, word: np.ndarray) -> np.uint64:
        total = np.uint64(0)
        with np.errstate(over="ignore"):
            for at in range(0, len(word), SEGMENT):
                part = word[at : at + SEGMENT]
                total += ((part.astype(np.uint64) + np.uint64(1)) * _byte_factors(at, at + len(part))).sum()
        return total


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more for the end)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    content = texts.buffers()[2]
    data = np.frombuffer(content, dtype=np.uint8)[offsets[0] : offsets[-1]] if content is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def give_back() -> None:
    """Return memory that is free again to the system.

    A worker process outlives its task. What the allocators keep for it adds up with the next task's own, next to a JVM
    that has grown to its limit by then.
    """
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim is not None:
            trim(0)


def _kept() -> dict[str, tuple[tuple[Hashable, ...], object]]:
    """What this process keeps from task to task, by name.

    These modules travel to tasks by value, so that each task has its own; a module that only the process knows outlives them.
    """
    return vars(sys.modules.setdefault("_millrace_kept", ModuleType("_millrace_kept"))).setdefault("kept", {})


def kept(name: str, make: Callable[..., object], *key: Hashable) -> object:
    """What ``make`` has made under this name in this process for the same key, or makes now."""
    held = _kept()
    if name not in held or held[name][0] != key:
        held[name] = key, make(*key)
    return held[name][1]


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES, keeping: str = "") -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``limit`` bytes of text, or one row.

    Between batches, after the last, and before the first for what an earlier task has left, unused memory is given back. So is what
    tasks of other kinds have kept for the next of theirs: all but what is named ``keeping``.
    """
    held = _kept()
    for name in [n for n in held if n != keeping]:
        del held[name]
    for batch in batches:
        give_back()
        sizes = np.nan_to_num(np.asarray(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=float))
        total = np.concatenate(([0], np.cumsum(sizes)))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto
    give_back()
