"""Joins on keys of which some are very frequent: those are counted and dealt over copies of their other side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows a task takes of one key, and the parts a key's rows are at least counted in; see ``heavy_keys``.
ROWS_PER_SALT, SHARES = 1 << 20, 4096
KEY, SALTS, SALT = "_heavy_key", "_salts", "_salt"


def heavy_keys(rows: DataFrame, key: Column, row_count: int, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame | None:
    """Keys with more rows than a task should take, and over how many salts to deal them; None if none can have.

    A key counts as heavy above ``rows_per_salt`` rows and above one part in ``SHARES`` of all rows, so there are
    fewer than ``SHARES`` of them however large the input is, and the sum of their salts is below twice that.
    """
    least = max(rows_per_salt, -(-row_count // SHARES))
    if row_count <= least:
        return None
    counted = rows.where(key.isNotNull()).groupBy(key.alias(KEY)).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where(F.col("_rows") > least).select(KEY, F.ceil(F.col("_rows") / least).cast("int").alias(SALTS))


def salted_join(
    rows: DataFrame, key: Column, position: Column, other: DataFrame, other_key: str, heavy: DataFrame | None, how: str = "left"
) -> DataFrame:
    """``rows`` joined with ``other``, whose ``other_key`` is unique, on ``key``.

    Rows of a heavy key are dealt by a hash of ``position``, which must tell them apart and be the same if a task is
    repeated; their row in ``other`` is copied to each salt. The list of heavy keys is bounded, see ``heavy_keys``,
    and is broadcast. Without it this is a plain join.
    """
    rows = rows.withColumn("_key", key)
    if heavy is None:
        return rows.join(other, rows["_key"] == other[other_key], how).drop("_key")
    heavy = F.broadcast(heavy)
    salted = rows.join(heavy, F.col("_key") == F.col(KEY), "left").withColumn(
        SALT, F.when(F.col(SALTS).isNull(), 0).otherwise(F.pmod(F.xxhash64(position), F.col(SALTS)).cast("int"))
    )
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1))
    copied = other.join(heavy, F.col(other_key) == F.col(KEY), "left").withColumn("_copy", copies)
    copied = copied.drop(KEY, SALTS)
    met = (salted["_key"] == copied[other_key]) & (salted[SALT] == copied["_copy"])
    return salted.drop(KEY, SALTS).join(copied, met, how).drop("_key", SALT, "_copy")
