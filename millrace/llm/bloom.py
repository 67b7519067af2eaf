"""Blocked Bloom filter over 64-bit keys: all bits of a key lie in one block of 512.

Built by Spark, a row per block, and held by tasks as one array whose size ``max_blocks`` bounds
(64 bytes each). More keys than it was sized for only let more through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 20
WORDS = 8
PROBES = 6


def _probes(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Block of each key, and the word and bit in it of each probe; every probe has nine hash bits of its own."""
    keys = keys.astype(np.int64).view(np.uint64)
    block = ((keys >> np.uint64(56)) ^ keys) % np.uint64(blocks)
    spread = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bits = [(spread >> np.uint64(9 * i)) & np.uint64(511) for i in range(PROBES)]
    return block.astype(np.int64), [((b >> np.uint64(6)).astype(np.int64), np.uint64(1) << (b & np.uint64(63))) for b in bits]


def blocks_of(keys: DataFrame, bits_per_key: int = BITS_PER_KEY, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """Blocks with any bit set (block, w0 to w7) of the filter over ``keys`` (key), and how many blocks it has."""
    blocks = max(1, min(max_blocks, -(-keys.count() * bits_per_key // (64 * WORDS))))

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            block, probes = _probes(batch["key"].to_numpy(), blocks)
            words = np.zeros((len(block), WORDS), dtype=np.uint64)
            for word, bit in probes:
                words[np.arange(len(block)), word] |= bit
            yield pd.DataFrame({"block": block, **{f"w{i}": words[:, i].view(np.int64) for i in range(WORDS)}})

    schema = "block long, " + ", ".join(f"w{i} long" for i in range(WORDS))
    rows = keys.select("key").mapInPandas(marked, schema)
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]), blocks


def build(keys: DataFrame, bits_per_key: int = BITS_PER_KEY, max_blocks: int = MAX_BLOCKS) -> Broadcast:
    """The filter over distinct ``keys`` (key long), at most ``max_blocks`` * 64 bytes."""
    rows, blocks = blocks_of(keys, bits_per_key, max_blocks)
    table = np.zeros((blocks, WORDS), dtype=np.uint64)
    found = rows.toPandas()
    if len(found):
        table[found["block"].to_numpy()] = found[[f"w{i}" for i in range(WORDS)]].to_numpy().astype(np.int64).view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


def possible(held: Broadcast) -> Callable[[Column], Column]:
    """A condition on a 64-bit key: false means that it isn't in the filter."""

    @F.pandas_udf("boolean")
    def test(keys: pd.Series) -> pd.Series:
        table = held.value
        block, probes = _probes(keys.to_numpy(), len(table))
        hit = np.ones(len(block), dtype=bool)
        for word, bit in probes:
            hit &= table[block, word] & bit != 0
        return pd.Series(hit)

    return test
