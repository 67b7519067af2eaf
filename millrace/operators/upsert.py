"""Type-1 upsert with surrogate keys: versions of the batch's keys, found by joining the batch with what is held."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.schemas import duplicate_keys

REPLACES = "replaces"
#: Keys handed to a slot at a time, and new rows a slot is meant to have.
KEY_BLOCK, ROWS_PER_SLOT = 1024, 1 << 18


class DuplicateUpsertKey(Exception):
    """One upsert holds several rows for the same business key."""


def require_unique(incoming: DataFrame, key: str, table: str) -> None:
    """Refuse a batch that would touch one target row twice."""
    repeated = duplicate_keys(incoming, key).count()
    if repeated:
        raise DuplicateUpsertKey(f"DUPLICATE_UPSERT_KEY: {table}.{key}: {repeated}")


def slots_for(rows: int) -> int:
    """Tasks that number the new rows of a batch."""
    return max(1, -(-rows // ROWS_PER_SLOT))


def versions(
    held: DataFrame,
    incoming: DataFrame,
    business_key: str,
    surrogate_key: str,
    last_key: int,
    slots: int = 1,
    newer_wins: str | None = None,
    changed_only: bool = False,
) -> DataFrame:
    """The rows an upsert writes: incoming rows with their surrogate keys, and whether they replace one.

    Existing keys take all incoming attributes, NULLs included, and keep their surrogate key. ``held`` has
    at least the batch's keys, as far as they exist; both inputs must be unique and non-NULL in the
    business key. With ``newer_wins`` naming a timestamp, an incoming row older than the held one is
    left out; with ``changed_only``, one that equals it.

    New keys come in blocks: the n-th block of slot s begins at ``last_key + (n * slots + s) * KEY_BLOCK``, and
    a row takes the place its rank among the slot's new rows says. So keys are unique and greater than every earlier
    key without counting anything across slots, and the same again if a task is repeated. Rows of the
    batch are ranked, held rows are only looked up.
    """
    columns = incoming.columns
    compared = [c for c in columns if c != business_key] if changed_only else [newer_wins] if newer_wins else []
    before = held.select(business_key, F.col(surrogate_key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in compared])
    both = incoming.join(before, business_key, "left")
    known = F.col("_key").isNotNull()
    if newer_wins is not None:
        at, held_at = F.col(newer_wins), F.col(f"_{newer_wins}")
        older = held_at.isNotNull() & F.coalesce(at < held_at, F.lit(True))
        both = both.where(~(known & older))
    if changed_only:
        same = F.lit(True)
        for c in compared:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        both = both.where(~(known & same))
    both = both.withColumns({"_slot": F.pmod(F.xxhash64(business_key), F.lit(slots)), REPLACES: known})
    rank = F.row_number().over(Window.partitionBy("_slot", REPLACES).orderBy(business_key)).cast("bigint") - 1
    block = F.floor(rank / KEY_BLOCK) * slots + F.col("_slot")
    new_key = F.lit(last_key) + block * KEY_BLOCK + rank % KEY_BLOCK + 1
    return both.withColumn(surrogate_key, F.coalesce("_key", new_key)).select(surrogate_key, *columns, REPLACES)


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    business_key: str,
    surrogate_key: str,
    last_key: int,
    slots: int = 1,
    newer_wins: str | None = None,
) -> DataFrame:
    """The whole target after the upsert; keys absent from the batch stay."""
    new = versions(target, incoming, business_key, surrogate_key, last_key, slots, newer_wins)
    # without older rows to leave out, the batch's keys are those written
    keys = (incoming if newer_wins is None else new).select(business_key)
    kept = target.join(keys, business_key, "left_anti")
    return kept.select(*target.columns).unionByName(new.select(*target.columns))


def last_key(table: DataFrame, surrogate_key: str) -> int:
    """The highest surrogate key handed out so far, 0 for an empty table."""
    return table.agg(F.max(surrogate_key)).first()[0] or 0
