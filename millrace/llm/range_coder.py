"""Adaptive context-mixing range coder for token ids.

A block holds the ids of one stretch and can be decoded alone: its model starts from nothing and a
checksum covers the ids. Inside a block the ids are cut into lanes of equal length that advance
together, one id of every lane per step, so each step is a handful of array operations. All lanes
share one adaptive model; each has a range coder of its own.

The model mixes three orders. Order 2 predicts the id that last followed the two ids before, order 1
the one that last followed the id before, each with a confidence that hits raise and misses lower.
Order 0 is an adaptive frequency table over all ids. The probability of an id is

    w2 [id = order 2's] + w1 [id = order 1's] + w0 frequency(id)

and the weights are learned: for each pair of confidences, and by whether both orders agree, they
follow how often each order was right. All arithmetic is on integers, so any machine decodes alike.

Layout of a block, little-endian: magic "MRC1", lanes, steps, ids in all, alphabet size, words of
code, crc32 of the ids (six unsigned 32-bit), then the length of each lane's code and all codes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"MRC1"
LANES = 8192
#: Steps of a full block, so that a block has up to LANES * STEPS ids.
STEPS = 512
_HEADER = "<4s6I"
_SCALE = 24
_SHARE = 20
_CONTEXTS = 20
_REFRESH = 32
_U = np.uint64
#: What an entry gains by confidence, after a miss and after a hit; one without confidence is replaced by a miss.
_GAIN = np.array([0, -1, -1, -1, 1, 1, 1, 0]).astype(np.uint32)


class _Model:
    """What encoder and decoder both know after the same steps."""

    def __init__(self, lanes: int, alphabet: int, decoding: bool = False):
        self.alphabet = alphabet
        #: the id at each unit of the cumulative frequencies, for the decoder
        self.inverse = np.zeros(0, dtype=np.uint32) if decoding else None
        # places in tables are 64-bit, as NumPy looks them up
        self.previous = np.zeros(lanes, dtype=np.int64)
        self.context = np.zeros(lanes, dtype=np.int64)
        # id times 4 plus confidence
        self.first = np.zeros(alphabet, dtype=np.uint32)
        self.second = np.zeros(1 << _CONTEXTS, dtype=np.uint32)
        self.outcomes = np.tile(np.array([2, 1, 3], dtype=np.int64), (32, 1))
        self.counts = np.zeros(alphabet, dtype=np.int64)
        self.recent: list[np.ndarray] = []
        self.step = 0
        self._frequencies()
        self._weights()

    def _frequencies(self) -> None:
        if self.recent:
            self.counts += np.bincount(np.concatenate(self.recent), minlength=self.alphabet)
            self.recent = []
        free = (1 << _SHARE) - self.alphabet
        seen = max(1, int(self.counts.sum()))
        share = 1 + self.counts * free // seen
        share[0] += (1 << _SHARE) - int(share.sum())
        self.cumulative = np.zeros(self.alphabet + 1, dtype=np.uint64)
        np.cumsum(share, out=self.cumulative[1:])
        if self.inverse is not None:
            self.inverse = np.repeat(np.arange(self.alphabet, dtype=np.uint32), share)

    def _weights(self) -> None:
        """Shares of 2**24 per state; order 0 keeps a sixteenth at least, so that every id can be coded."""
        total = self.outcomes.sum(axis=1)
        free = (1 << _SCALE) - (1 << _SHARE)
        two = self.outcomes[:, 0] * free // total
        one = self.outcomes[:, 1] * free // total
        self.two, self.both = two.astype(np.uint64), (two + one).astype(np.uint64)

    def predict(self) -> None:
        self.entry1, self.entry2 = self.first.take(self.previous), self.second.take(self.context)
        self.id1, self.id2 = self.entry1 >> 2, self.entry2 >> 2
        self.sure1, self.sure2 = self.entry1 & 3, self.entry2 & 3
        self.state = (self.sure2 << 2 | self.sure1 | (self.id1 == self.id2).astype(np.uint32) << 4).astype(np.int64)
        self.end2, self.end1 = self.two.take(self.state), self.both.take(self.state)

    def hits(self, start: np.ndarray, size: np.ndarray, right2: np.ndarray, right1: np.ndarray) -> None:
        """Put the intervals of orders 1 and 2 where they are right; if both are, order 2's."""
        at = np.flatnonzero(right1 | right2)
        two, end2 = right2.take(at), self.end2.take(at)
        start[at] = np.where(two, _U(0), end2)
        size[at] = np.where(two, end2, self.end1.take(at) - end2)

    def learn(self, ids: np.ndarray, right2: np.ndarray, right1: np.ndarray) -> None:
        """Where each order is right; if both are, order 2 counts."""
        outcome = np.where(right2, 0, 2 - right1.astype(np.int64))
        self.outcomes += np.bincount(self.state * 3 + outcome, minlength=96).reshape(32, 3)
        fresh = ids << np.uint32(2) | np.uint32(1)
        self.second[self.context] = self._moved(self.entry2, self.sure2, fresh, right2)
        self.first[self.previous] = self._moved(self.entry1, self.sure1, fresh, right1)
        place = ids.astype(np.int64)
        pair = (self.previous.astype(np.uint32) * np.uint32(0x9E3779B1)) ^ (ids * np.uint32(0x85EBCA6B))
        self.context = (pair * np.uint32(0xC2B2AE35) >> np.uint32(32 - _CONTEXTS)).astype(np.int64)
        self.previous = place
        self.recent.append(place)
        self.step += 1
        if self.step % _REFRESH == 0 or self.step & (self.step - 1) == 0:
            self._frequencies()
        if self.step % 4 == 0 or self.step < 4:
            self._weights()

    @staticmethod
    def _moved(entry: np.ndarray, sure: np.ndarray, fresh: np.ndarray, right: np.ndarray) -> np.ndarray:
        case = sure | right.astype(np.uint32) << 2
        return np.where(case == 0, fresh, entry + _GAIN.take(case.astype(np.int64)))


class _Lanes:
    """Range coder state per lane: the range stays at or above 2**32 between ids."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, dtype=np.uint64)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)

    def narrow(self, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Take the interval; returns lanes whose upper 32 bits are now settled."""
        self.low += unit * start
        self.range = unit * size
        short = np.flatnonzero(self.range < _U(1 << 32))
        if len(short):
            low, size = self.low.take(short), self.range.take(short)
            # an interval across a multiple of 2**32 is cut to its larger part
            upper = ((low >> _U(32)) + _U(1)) << _U(32)
            below = upper - low
            across = size > below
            larger = across & (size - below > below)
            low = np.where(larger, upper, low)
            size = np.where(across, np.maximum(below, size - below), size)
            self.low[short], self.range[short] = low, size
        return short

    def shift(self, short: np.ndarray) -> None:
        self.low[short] = self.low.take(short) << _U(32)
        self.range[short] = self.range.take(short) << _U(32)


def _turned(grid: np.ndarray) -> np.ndarray:
    """Rows as columns, some columns at a time: a write then meets memory that is still at hand."""
    out = np.empty(grid.shape[::-1], dtype=grid.dtype)
    for i in range(0, grid.shape[1], 16):
        for j in range(0, grid.shape[0], 512):
            out[i : i + 16, j : j + 512] = grid[j : j + 512, i : i + 16].T
    return out


def encode(ids: np.ndarray, lanes: int = LANES, steps: int = STEPS) -> bytes:
    """One block. ids: any number of unsigned 32-bit ids below 2**19."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    n = len(ids)
    alphabet = int(ids.max()) + 1 if n else 1
    if alphabet > 1 << (_SHARE - 1):
        raise ValueError(f"ids must be below {1 << (_SHARE - 1)}")
    length = max(1, min(steps, -(-n // 16)))
    width = max(1, -(-n // length)) if n else 1
    width = min(width, lanes)
    length = -(-n // width)
    grid = ids
    if n < width * length:
        grid = np.zeros(width * length, dtype=np.uint32)
        grid[:n] = ids
    model, coder = _Model(width, alphabet), _Lanes(width)
    lanes_of: list[np.ndarray] = []
    words: list[np.ndarray] = []
    whole = _U(1 << _SCALE)
    for current in _turned(grid.reshape(width, length)):
        model.predict()
        right2, right1 = model.id2 == current, model.id1 == current
        # most ids are order 0's, so that is worked out for all lanes
        left, id0 = whole - model.end1, current.astype(np.int64)
        begin = model.cumulative.take(id0) * left >> _U(_SHARE)
        size = (model.cumulative.take(id0 + 1) * left >> _U(_SHARE)) - begin
        start = model.end1 + begin
        model.hits(start, size, right2, right1)
        short = coder.narrow(coder.range >> _U(_SCALE), start, size)
        if len(short):
            lanes_of.append(short.astype(np.int32))
            words.append((coder.low.take(short) >> _U(32)).astype("<u4"))
            coder.shift(short)
        model.learn(current, right2, right1)
    for half in (32, 0):
        lanes_of.append(np.arange(width, dtype=np.int32))
        words.append(((coder.low >> _U(half)) & _U(0xFFFFFFFF)).astype("<u4"))
    of = np.concatenate(lanes_of)
    used = np.bincount(of, minlength=width)
    taken = np.concatenate(words)[np.argsort(of.astype(np.uint16) if width <= 1 << 16 else of, kind="stable")]
    head = struct.pack(_HEADER, MAGIC, width, length, n, alphabet, len(taken), zlib.crc32(ids.tobytes()))
    return head + used.astype("<u4").tobytes() + taken.tobytes()


def decode(block: bytes) -> tuple[np.ndarray, int]:
    """The ids of the block at the head of ``block``, and its length in bytes. Raises on a wrong checksum."""
    magic, width, length, n, alphabet, words, checksum = struct.unpack_from(_HEADER, block)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = struct.calcsize(_HEADER)
    used = np.frombuffer(block, dtype="<u4", count=width, offset=at).astype(np.int64)
    code = np.frombuffer(block, dtype="<u4", count=words, offset=at + 4 * width).astype(np.uint64)
    end = at + 4 * (width + words)
    code = np.concatenate((code, np.zeros(2, dtype=np.uint64)))
    place = np.concatenate(([0], np.cumsum(used)[:-1]))
    model, coder = _Model(width, alphabet, decoding=True), _Lanes(width)
    value = code[place] << _U(32) | code[place + 1]
    place = place + 2
    columns = np.empty((length, width), dtype=np.uint32)
    whole, last = _U(1 << _SCALE), _U((1 << _SCALE) - 1)
    for step in range(length):
        model.predict()
        unit = coder.range >> _U(_SCALE)
        found = np.minimum((value - coder.low) // unit, last)
        hit2, hit = found < model.end2, found < model.end1
        # most ids are order 0's, so that is worked out for all lanes; what it gives for the others is replaced
        left = whole - model.end1
        share = (((found - model.end1 + _U(1)) << _U(_SHARE)) - _U(1)) // left
        named = model.inverse.take(share.astype(np.int64), mode="clip")
        id0 = named.astype(np.int64)
        begin = model.cumulative.take(id0) * left >> _U(_SHARE)
        size = (model.cumulative.take(id0 + 1) * left >> _U(_SHARE)) - begin
        start = model.end1 + begin
        model.hits(start, size, hit2, hit)
        current = np.where(hit2, model.id2, np.where(hit, model.id1, named))
        short = coder.narrow(unit, start, size)
        if len(short):
            coder.shift(short)
            value[short] = value.take(short) << _U(32) | code.take(np.minimum(place.take(short), words))
            place[short] += 1
        # as the encoder saw it: an id that order 2 and order 0 both name counts for order 2
        columns[step] = current
        model.learn(current, model.id2 == current, model.id1 == current)
    ids = _turned(columns).reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != checksum:
        raise ValueError("checksum of a block doesn't match")
    return ids, end
