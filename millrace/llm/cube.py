"""Mixing sources to target sizes by balanced sampling (cube method).

Every source has a weight and gets a target share of all words; a target stops at ``MOST`` times the
source's size and the excess goes to the other sources by weight until none is above. A document of a
source whose target is f times its size is taken floor(f) times, and once more with probability
f - floor(f). Which ones is decided so that the words and the number of documents taken both come out
as planned, not just on average: the flight phase moves the probabilities of three documents at a time
along the one direction that changes neither total, until one of them reaches 0 or 1.

The documents of a source fly in blocks of about ``BLOCK``, dealt by a hash of the document, so that a
source with a third of all rows has many blocks. Each block leaves two documents undecided at most;
those meet in new blocks, level by level, until one block a source remains. Only its last two
documents are landed: of the four ways, a keyed draw takes one with the planned chances.

Sizes count runs of ``[^\\x20\\x09-\\x0D]``; null and empty texts have size 0 and are drawn too. Sources
are ordered by code point with null last, null being a source. Of n rows alike in doc_id, text and source
floor(n p) are taken once more, and one further with the probability left. Without words at
all, targets are 0 and every document is taken 0 times. Draws depend only on the key and the
documents, so reruns agree. Columns of ``docs`` are kept; a clashing one is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.workspace import written

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3.0
BLOCK = 2048
_STATE = "source string, uid long, size long, n long, p double, more int"
_NEAR = 1e-9


def words(column: Column) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, n_docs, target. docs: source, size.

    A target is the smaller of ``most`` times the size and weight times a level common to all sources.
    With the sources in order of the level at which they stop, the common level follows from the sum
    over those before. The windows cover one row per source.
    """
    sums = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary")))
    sized = sums.withColumn("weight", F.element_at(cycle, ((place - 1) % len(weights) + 1).cast("int")))
    sized = sized.withColumn("cap", most * F.col("source_size")).withColumn("stop", F.col("cap") / F.col("weight"))
    ranked = Window.orderBy("stop", F.col("source").isNull(), F.col("source").cast("binary"))
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # the first source that doesn't stop at or below its level sets the level for it and all after
    levels = sized.withColumn("level", level).withColumn("rank", F.row_number().over(ranked))
    common = F.min(F.when(F.col("level") <= F.col("stop"), F.struct("rank", "level"))).over(everything)["level"]
    return levels.withColumn("common", common).select(
        "source", "source_size", "n_docs", F.least("cap", F.coalesce(F.col("weight") * F.col("common"), F.col("cap"))).alias("target")
    )


def fly(size: np.ndarray, number: np.ndarray, p: np.ndarray, seed: int) -> np.ndarray:
    """Move the probabilities until two at most lie strictly between 0 and 1; both totals stay.

    Balanced are size and number. What leaves both unchanged for three documents is the cross product
    of their sizes and numbers; of both ways along it the one that ends sooner or the other is taken,
    with the chances that keep every document's probability as planned. Documents come by falling size,
    and the large ones are settled before, so that those left over are small.
    """
    generator = np.random.default_rng(seed)
    p = _settle_large(size.astype(float), number.astype(float), p.astype(float), generator)
    sizes, numbers, chance = size.tolist(), number.tolist(), p.tolist()
    draws = generator.random(len(chance)).tolist()
    active: list[int] = []
    for nxt, draw in enumerate(draws):
        if not 0 < chance[nxt] < 1:
            continue
        active.append(nxt)
        if len(active) < 3:
            continue
        a, b, c = active
        way = (
            numbers[b] * sizes[c] - numbers[c] * sizes[b],
            numbers[c] * sizes[a] - numbers[a] * sizes[c],
            numbers[a] * sizes[b] - numbers[b] * sizes[a],
        )
        if way == (0, 0, 0):
            # all three have the same size per row: two of them suffice
            way = (numbers[b], -numbers[a], 0)
        up = down = float("inf")
        for i, u in zip(active, way, strict=True):
            if u > 0:
                up, down = min(up, (1 - chance[i]) / u), min(down, chance[i] / u)
            elif u < 0:
                up, down = min(up, chance[i] / -u), min(down, (1 - chance[i]) / -u)
        step = up if draw * (up + down) < down else -down
        for i, u in zip(active, way, strict=True):
            moved = chance[i] + step * u
            chance[i] = 0.0 if moved < _NEAR else 1.0 if moved > 1 - _NEAR else moved
        active = [i for i in active if 0 < chance[i] < 1]
    return np.array(chance, dtype=float)


def _settle_large(size: np.ndarray, number: np.ndarray, p: np.ndarray, generator: np.random.Generator) -> np.ndarray:
    """Settle documents with over a 64th of the block's words against all others at once.

    Two others can't outweigh a large document, so it would stay open to the end. Its counterweight is
    the least change of all other probabilities that keeps both totals.
    """
    open_ = (p > 0) & (p < 1)
    for large in np.flatnonzero(size > size[open_].sum() / 64):
        while 0 < p[large] < 1:
            others = np.flatnonzero((p > 0) & (p < 1))
            others = others[others != large]
            n, s = number[others], size[others]
            nn, ns, ss = (n * n).sum(), (n * s).sum(), (s * s).sum()
            determinant = nn * ss - ns * ns
            if len(others) < 8 or determinant <= 1e-6 * nn * ss:
                return p
            u = -(((ss * number[large] - ns * size[large]) * n + (nn * size[large] - ns * number[large]) * s) / determinant)
            at, u = np.append(others, large), np.append(u, 1.0)
            at, u = at[np.abs(u) > 1e-12], u[np.abs(u) > 1e-12]
            room_up = np.where(u > 0, 1 - p[at], p[at]) / np.abs(u)
            room_down = np.where(u > 0, p[at], 1 - p[at]) / np.abs(u)
            up, down = room_up.min(), room_down.min()
            moved = p[at] + u * (up if generator.random() * (up + down) < down else -down)
            p[at] = np.where(moved < _NEAR, 0.0, np.where(moved > 1 - _NEAR, 1.0, moved))
    return p


def _flight(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["size", "uid", "n"], ascending=[False, True, True], kind="stable")
    p = fly(block["size"].to_numpy(), block["n"].to_numpy(), block["p"].to_numpy(), int(block["uid"].iloc[0]) & 0xFFFFFFFF)
    more = np.where((p == 0) | (p == 1), p, -1).astype(np.int32)
    return block[["source", "uid", "size", "n"]].assign(p=p, more=more)


def _landing(block: pd.DataFrame) -> pd.DataFrame:
    """The rest of a source: fly, then land the last two documents, each with its own chance.

    One draw serves both, which keeps their number within one of what was planned.
    """
    out = _flight(block)
    more, p = out["more"].to_numpy().copy(), out["p"].to_numpy()
    left = np.flatnonzero(more < 0)
    draw = np.random.default_rng(int(out["uid"].iloc[-1]) & 0xFFFFFFFF).random()
    edge = 0.0
    for i in left:
        more[i] = edge <= draw < edge + p[i] or draw < edge + p[i] - 1
        edge += p[i]
    return out.assign(more=more)


def with_identity(docs: DataFrame, key: int) -> DataFrame:
    """Rows with size and uid, the hash that stands for a document in the draws."""
    kept = docs.drop(*[c for c in docs.columns if c.lower() in ("size", "uid", "source_size", "target", "copies", "taken")])
    return kept.withColumn("size", words(F.col("text"))).withColumn("uid", F.xxhash64(F.lit(key), "doc_id", "text"))


def decisions(narrow: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """source, uid, size, source_size, target, copies for rows (source, uid, size), one row for rows alike."""
    if most < 1:
        raise ValueError("the targets can't hold all words if most is below 1")
    plan = written(targets(narrow, weights, most), "mix-targets")
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(factor + _NEAR)
    share = F.when(factor - whole > _NEAR, factor - whole).otherwise(F.lit(0.0))
    shares = plan.select(
        F.col("source").alias("of"), "source_size", "target", whole.cast("int").alias("whole"), share.alias("p"),
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / block)).cast("int").alias("blocks"),
    )
    same = F.col("source").eqNullSafe(F.col("of"))
    alike = narrow.groupBy("source", "uid", "size").agg(F.count("*").alias("rows"))
    # of n rows alike floor(n p) are taken once more; only what is left of n p flies, as one document
    planned = F.col("rows") * F.col("p")
    surely = F.floor(planned + _NEAR)
    left = F.when(planned - surely > _NEAR, planned - surely).otherwise(F.lit(0.0))
    state = alike.join(shares, same).select("source", "uid", "size", F.lit(1).cast("long").alias("n"), left.alias("p"), "blocks")
    levels: list[DataFrame] = []
    blocks = int(plan.agg(F.max(F.ceil(F.col("n_docs") / block))).first()[0] or 1)
    while True:
        last = blocks <= 1
        dealt = F.pmod(F.xxhash64(F.lit(len(levels)), "uid", "size"), F.col("blocks")).cast("int")
        flown = state.withColumn("block", dealt).groupBy("source", "block").applyInPandas(_landing if last else _flight, _STATE)
        flown = written(flown, "mix-flight")
        levels.append(flown.where("more >= 0").select("source", "uid", "size", "n", "more"))
        if last:
            break
        # each block leaves two documents at most
        undecided = flown.where("more < 0").drop("more")
        counts = undecided.groupBy(F.col("source").alias("of")).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("int").alias("blocks"))
        blocks = int(counts.agg(F.max("blocks")).first()[0] or 1)
        state = undecided.join(counts, same).drop("of")
    decided = levels[0]
    for level in levels[1:]:
        decided = decided.unionByName(level)
    counted = alike.select(*[F.col(c).alias(f"alike_{c}") for c in ("source", "uid", "size")], "rows")
    own = F.col("source").eqNullSafe(F.col("alike_source")) & (F.col("uid") == F.col("alike_uid")) & (F.col("size") == F.col("alike_size"))
    return decided.join(shares, same).join(counted, own).select("source", "uid", "size", "source_size", "target", "rows", "whole", (surely + F.col("more")).alias("more"))


def joined(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``with_identity`` with source_size, target, copies and taken.

    Of rows alike, the first ones get the additional copies. Their ranks come from their places in the input:
    among those of one partition, after those of the partitions before; so many rows alike are no one group.
    """
    drawn = decided.select(*[F.col(c).alias(f"drawn_{c}") for c in decided.columns])
    kept = [c for c in rows.columns if c != "uid"]
    placed = rows.withColumn("drawn_place", F.monotonically_increasing_id()).withColumn("drawn_part", F.shiftright("drawn_place", 33))
    same = placed["uid"].eqNullSafe(drawn["drawn_uid"]) & (placed["size"] == drawn["drawn_size"]) & placed["source"].eqNullSafe(drawn["drawn_source"])
    found = placed.join(drawn, same)
    one, several = found.where("drawn_rows = 1"), found.where("drawn_rows > 1")
    key = ["drawn_source", "drawn_uid", "drawn_size"]
    per_part = placed.join(drawn.where("drawn_rows > 1"), same).groupBy(*key, "drawn_part").agg(F.count("*").alias("drawn_here"))
    before = F.sum("drawn_here").over(Window.partitionBy(*key).orderBy("drawn_part")) - F.col("drawn_here")
    before = per_part.select(*[F.col(c).alias(f"of_{c}") for c in (*key, "drawn_part")], before.alias("drawn_before"))
    own = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*key, "drawn_part")]
    here = F.row_number().over(Window.partitionBy(*key, "drawn_part").orderBy("drawn_place"))
    ranked = several.join(before, own).withColumn("drawn_rank", F.col("drawn_before") + here)
    more = F.col("drawn_whole") + (F.col("drawn_rank") <= F.col("drawn_more")).cast("int")

    def shown(part: DataFrame, copies: Column) -> DataFrame:
        made = [F.col(f"drawn_{c}").alias(c) for c in ("source_size", "target")]
        return part.select(*[F.col(c) for c in kept], *made, copies.cast("int").alias("copies"))

    result = shown(one, F.col("drawn_whole") + F.col("drawn_more")).unionByName(shown(ranked, more))
    return result.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, block: int = BLOCK, key: int = 17) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, ...) with size, source_size, target, copies and taken."""
    rows = with_identity(docs, key)
    narrow = written(rows.select("source", "uid", "size"), "mix-sizes")
    return joined(rows, decisions(narrow, weights, most, block))


def mix_sizes(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, block: int = BLOCK, key: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: the mix without its texts, which are read once."""
    rows = written(with_identity(docs, key).select("doc_id", "source", "uid", "size"), "mix-sizes")
    return joined(rows, decisions(rows.select("source", "uid", "size"), weights, most, block))
