"""Similarity join on word shingles by grouped prefixes, and the components of its links.

A document's set is its distinct 5-word shingles (``[^\\x20\\x09-\\x0D]`` words, A-Z lower-cased), or its
whole word sequence if that is shorter. Two documents link if the Jaccard similarity of their sets is
0.8 or more. The result gives each document its set's size and the least doc_id it reaches by links.

1. All documents' shingles are counted in a sketch of fixed size. It orders shingles from rare to
   frequent; the order decides only how much work there is, so an approximate count will do.
2. Documents with equal sets become one node. The first n - ceil(0.8 n) + 1 shingles of a set in the
   order are its prefix; similar sets share one there. Nodes with the same prefix and size become one
   group, and only groups are joined.
3. Within each shingle and size class every group is paired with the class's first group, members
   are verified against its first member, and components are formed. A group of near copies is linked
   by as many pairs as it has members, not by the square.
4. What is left beside the most frequent component of a shingle is paired with one of its groups, in
   some rounds with another group each.
5. What can still be missing are links between components, also inside a group, whose members share its
   first shingle. For shingles that occur in several, groups
   of all components but the most frequent are joined with the groups of all others, and the members
   of the pairs that pass the filters on size, place and signature are verified.

A signature holds, for each of so many classes of hashes, whether a set has an odd number of shingles
there. Two sets differ in at least as many shingles as their signatures in bits, so that sets which are
too far apart are told without being read. It only ever rules out pairs that can't link. Groups carry one
of ``SIGNATURE`` bits along with their shingles. Pairs of documents are held against another whose length
grows with the set (a 64th of the set itself), since a short one says nothing about a long text.

Every pair that could link is thus verified or already connected; nothing is capped. Pairs are verified
on the whole sets, which are read again from the texts of the nodes in question; a Bloom filter of
bounded size spares most other texts the shuffle.

Documents with null or empty text, or without words, have size 0 and are components of their own.
Equal sets are linked, so repeated rows are. Null ids don't count as least ids; a component of rows
without id has none. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import bloom, text
from millrace.llm.components import components
from millrace.llm.workspace import apart, removed, shuffles_removed, small_batches, spare, written

SHINGLE = 5
#: Similarity in hundredths.
SIMILARITY = 80
SKETCH_BITS = 21
#: Rounds that link what is left to the largest component of each shingle, one pair per group.
STAR_ROUNDS = 1
#: Bits of a group's signature, and least bits of a document's. Powers of two.
SIGNATURE = 512
_CHUNKS = 64
_DOCS = "doc_id long, key binary, n int, prefix binary, group_key binary, signature array<long>, wide binary"


def _sets(reader: text.WordReader, texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """Per text the hashes of its shingles, distinct and in order."""
    words = reader.read(texts)
    hashes, _, first = words.shingles(shingle)
    counts = np.diff(words.first)
    for i, count in enumerate(counts):
        if count >= shingle:
            yield np.unique(hashes[first[i] : first[i + 1]])
        elif count:
            own = words.hashes[words.first[i] : words.first[i + 1]]
            yield text.mix(np.array([(own * text.position_factors(count)).sum() + np.uint64(count)], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _reader() -> text.WordReader:
    return text.WordReader(text.lowering(), text.unspaced())


def _sketch(docs: DataFrame, shingle: int, bits: int) -> np.ndarray:
    """Counts of shingles by the lower bits of their hash, over all documents, as powers of two above the mean."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        reader, total = _reader(), np.zeros(1 << bits, dtype=np.uint32)
        for batch in text.steps(batches, "text"):
            found = [s & np.uint64((1 << bits) - 1) for s in _sets(reader, batch.column("text"), shingle)]
            if found:
                total += np.bincount(np.concatenate(found).astype(np.int64), minlength=1 << bits).astype(np.uint32)
        if total.any():
            parts = [x.tobytes() for x in np.split(total, _CHUNKS)]
            salt = TaskContext.get().partitionId() % _CHUNKS
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(_CHUNKS, dtype=np.int32)), pa.array(np.full(_CHUNKS, salt, dtype=np.int32)), pa.array(parts, pa.binary())], names=["chunk", "salt", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros((1 << bits) // _CHUNKS, dtype=np.uint64)
        for part in group.column("counts").to_pylist():
            total += np.frombuffer(part, dtype="<u4" if len(part) == 4 * len(total) else "<u8")
        return pa.table({"chunk": group.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    rows = docs.select("text").mapInArrow(count, "chunk int, salt int, counts binary")
    # in two steps, so that no task holds the chunks of all tasks
    partial = rows.groupBy("chunk", "salt").applyInArrow(add, "chunk int, counts binary")
    with shuffles_removed(docs.sparkSession), small_batches(docs.sparkSession):
        merged = partial.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect()
    total = np.zeros(1 << bits, dtype=np.uint64)
    for row in merged:
        size = (1 << bits) // _CHUNKS
        total[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["counts"], dtype="<u8")
    mean = max(1.0, float(total.mean()))
    return np.floor(2 * np.log2(np.maximum(1.0, total / mean))).astype(np.uint8)


def _signature(own: np.ndarray) -> np.ndarray:
    """For each class of hashes, by their lower bits, whether their number is odd: as many bits as hashes or more, in bytes."""
    size = max(SIGNATURE, 1 << (len(own) - 1).bit_length())
    part = (own & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(part, minlength=size) & 1).astype(np.uint8))


def _folded(signature: np.ndarray, size: int) -> np.ndarray:
    """The signature that the same hashes have in ``size`` bytes."""
    return np.bitwise_xor.reduce(signature.reshape(-1, size), axis=0)


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _prefixes(classes: Broadcast, shingle: int, similarity: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, rank = _reader(), classes.value
        for batch in text.steps(batches, "text"):
            keys, sizes, parts, groups, signatures, wide = [], [], [], [], [], []
            for own in _sets(reader, batch.column("text"), shingle):
                n = len(own)
                length = n - -(-similarity * n // 100) + 1 if n else 0
                order = np.argsort(rank[(own & np.uint64((1 << bits) - 1)).astype(np.int64)], kind="stable")
                prefix = own[order[:length]].tobytes()
                keys.append(_digest(own.tobytes()))
                sizes.append(n)
                parts.append(prefix)
                groups.append(_digest(n.to_bytes(8, "little") + prefix))
                signature = _signature(own)
                signatures.append(_folded(signature, SIGNATURE // 8).view(np.int64))
                wide.append(signature.tobytes())
            arrays = [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(parts, pa.binary()), pa.array(groups, pa.binary())]
            arrays += [pa.array(signatures, pa.list_(pa.int64())), pa.array(wide, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "n", "prefix", "group_key", "signature", "wide"])

    return prefixes


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per shingle of a group's prefix."""
    for batch in batches:
        parts = [np.frombuffer(p, dtype=np.int64) for p in batch.column("prefix").to_pylist()]
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        several = np.repeat(np.arange(len(parts)), sizes)
        place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        n = batch.column("n").to_numpy()
        arrays = [pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])), batch.column("group").take(pa.array(several)), pa.array(n[several]), pa.array(place.astype(np.int32)), batch.column("nodes").take(pa.array(several))]
        yield pa.RecordBatch.from_arrays(arrays, names=["token", "group", "n", "place", "nodes"])


def _can_link(n1: Column, place1: Column, n2: Column, place2: Column, similarity: int) -> Column:
    """By the sizes, and by what can follow the places of the first shingle that both share."""
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    most = F.least(n1 - place1, n2 - place2)
    return (100 * small >= similarity * large) & ((100 + similarity) * most >= similarity * (n1 + n2))


def _near_enough(n1: Column, signature1: Column, n2: Column, signature2: Column, similarity: int) -> Column:
    """By the bits in which the signatures differ; without a signature a pair passes."""
    bits = [F.bit_count(signature1[i].bitwiseXOR(signature2[i])) for i in range(SIGNATURE // 64)]
    return F.coalesce((100 + similarity) * sum(bits[1:], bits[0]) <= (100 - similarity) * (n1 + n2), F.lit(True))


def _possible(similarity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Leaves out pairs whose signatures differ in more bits than sets that link can."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.asarray(batch.column("n_a")).astype(np.int64) + np.asarray(batch.column("n_b"))
            least = []
            for x, y in zip(batch.column("wide_a"), batch.column("wide_b"), strict=True):
                one, two = np.frombuffer(x.as_buffer(), dtype=np.uint8), np.frombuffer(y.as_buffer(), dtype=np.uint8)
                size = min(len(one), len(two))
                least.append(int(np.bitwise_count(_folded(one, size) ^ _folded(two, size)).sum(dtype=np.int64)))
            near = (100 + similarity) * np.array(least, dtype=np.int64) <= (100 - similarity) * both
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return possible


def _verified(similarity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                one, two = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                hit.append(100 * both >= similarity * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return verify


def _links(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Those of ``pairs`` (a, b: nodes) whose whole sets are similar enough."""
    pairs = pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("wide").alias("wide_a"))
    two = apart(nodes).select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("wide").alias("wide_b"))
    with small_batches(docs.sparkSession):
        pairs = written(pairs.join(one, "a").join(two, "b").mapInArrow(_possible(similarity), "a long, b long"), "pairs")
    asked = pairs.select(F.col("a").alias("asked")).union(pairs.select("b")).distinct()
    of = written(nodes.join(asked, F.col("node") == F.col("asked"), "left_semi").select("node", "key", _known(F.col("doc_id")).alias("of_id")), "asked")
    held = bloom.possible(bloom.build(of.select(F.xxhash64("of_id").alias("key")).distinct()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader()
        for batch in text.steps(batches, "text"):
            sets = [s.tobytes() for s in _sets(reader, batch.column("text"), shingle)]
            same = [_digest(s) == k for s, k in zip(sets, batch.column("key").to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "set"])
            yield out.filter(pa.array(same, pa.bool_()))

    near = docs.select(_known(F.col("doc_id")).alias("own_id"), "text").where(F.col("text").isNotNull())
    near = near.where(held(F.xxhash64("own_id")))
    # an id can come with several texts, of which one has the node's set; with a broadcast, the filter and the reader
    # would be one stage, and every task of it would take two workers, which stay
    texts = near.join(of.hint("merge"), F.col("own_id") == F.col("of_id")).select("node", "key", "text")
    with small_batches(docs.sparkSession):
        sets = written(texts.mapInArrow(read, "node long, set binary").dropDuplicates(["node"]), "sets")
    first = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    second = apart(sets).select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    with small_batches(docs.sparkSession):
        links = written(pairs.join(first, "a").join(second, "b").mapInArrow(_verified(similarity), "a long, b long"), "links")
    removed(pairs, of, sets)
    return links


def _known(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 62)))


def _mixed(tokens: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the shingles' groups by component, and the shingles that several components have, with the most frequent."""
    kinds = placed.select(F.col("group").alias("own_group"), "component").distinct()
    spread = written(tokens.join(kinds, F.col("group") == F.col("own_group")).drop("own_group"), "spread")
    counted = spread.groupBy("token", "component").agg(F.count("*").alias("groups"))
    mixed = counted.groupBy("token").agg(F.count("*").alias("kinds"), F.max_by("component", F.struct("groups", "component")).alias("main"))
    return spread, written(mixed.where("kinds > 1").select("token", "main"), "mixed")


def _signed(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows of groups by component with the signature of their member, null where there are several."""
    alone = placed.groupBy(F.col("group").alias("signed_group"), F.col("component").alias("signed_component"))
    alone = alone.agg(F.when(F.count("*") == 1, F.first("signature")).alias("signature"))
    same = (F.col("group") == F.col("signed_group")) & (F.col("component") == F.col("signed_component"))
    return rows.join(alone, same).drop("signed_group", "signed_component")


def _merged(placed: DataFrame, links: DataFrame) -> DataFrame:
    """Nodes with the components that the links make of the ones before."""
    of = apart(placed).select(F.col("node").alias("node_a"), F.col("component").alias("a"))
    to = apart(placed).select(F.col("node").alias("node_b"), F.col("component").alias("b"))
    bridges = links.select(F.col("a").alias("node_a"), F.col("b").alias("node_b")).join(of, "node_a").join(to, "node_b").select("a", "b").distinct()
    merged = components(bridges).select(F.col("node").alias("old"), F.col("component").alias("new"))
    joined = placed.join(merged, F.col("component") == F.col("old"), "left")
    after = written(joined.select("node", "group", "n", "signature", F.coalesce("new", "component").alias("component")), "placed")
    removed(placed, links, merged)
    return after


def _components(docs: DataFrame, shingle: int, similarity: int, sketch_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, n, ...) of all documents, and (key, doc_id, component) for the distinct sets that aren't empty."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    classes = spark.sparkContext.broadcast(_sketch(docs, shingle, sketch_bits))
    # prefixes are wide: each table that holds them is replaced by one without as soon as the next is written
    with small_batches(spark):
        prefixed = written(docs.mapInArrow(_prefixes(classes, shingle, similarity, sketch_bits), _DOCS), "prefixes")
    distinct = prefixed.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n", "prefix", "group_key", "signature", "wide")])
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    rows = written(prefixed.select("doc_id", "key", "n"), "rows")
    removed(prefixed)
    groups = distinct.groupBy("group_key").agg(F.min("node").alias("group"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.count("*").alias("nodes"))
    groups = written(groups, "groups")
    nodes = written(distinct.drop("prefix"), "nodes")
    removed(distinct)
    members = nodes.select("node", F.col("n").alias("size"), "signature", F.col("group_key").alias("own_key")).join(groups.select("group_key", "group"), F.col("own_key") == F.col("group_key"))
    members = written(members.select("node", "group", F.col("size").alias("n"), "signature"), "members")

    # shingles that several groups share, with the first group per class of size; the first shingle of a group
    # of several nodes stays in any case, by it members meet that link with each other but not with the first one
    tokens = groups.select("prefix", "group", "n", "nodes").mapInArrow(_tokens, "token long, group long, n int, place int, nodes long")
    own = (F.col("place") == 0) & (F.col("nodes") > 1)
    shared = tokens.groupBy("token").agg(F.count("*").alias("groups"), F.max(own).alias("own")).where("groups > 1 OR own").select(F.col("token").alias("shared"))
    tokens = written(tokens.join(shared, F.col("token") == F.col("shared"), "left_semi").drop("nodes"), "tokens")
    removed(groups)
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / similarity)))
    classed = tokens.withColumn("size_class", size_class)
    leaders = classed.groupBy("token", "size_class").agg(F.count("*").alias("groups"), F.min(F.struct("group", "n", "place")).alias("leader")).where("groups > 1")
    leaders = apart(leaders.select("token", "size_class", "leader"))
    star = classed.join(leaders, ["token", "size_class"]).where(F.col("group") != F.col("leader.group"))
    star = star.where(_can_link(F.col("n"), F.col("place"), F.col("leader.n"), F.col("leader.place"), similarity))
    star = star.select(F.col("group").alias("of"), F.col("leader.group").alias("b")).distinct()
    across = members.join(star, F.col("group") == F.col("of")).select(F.col("node").alias("a"), "b")
    inside = members.select(F.col("node").alias("a"), F.col("group").alias("b"))
    linked_first = _links(docs, across.union(inside), nodes, shingle, similarity)
    first = components(linked_first)

    # links between components
    placed = members.join(first.select(F.col("node").alias("linked_node"), "component"), F.col("node") == F.col("linked_node"), "left")
    placed = written(placed.select("node", "group", "n", "signature", F.coalesce("component", "node").alias("component")), "placed")
    removed(members, first, linked_first)
    for turn in range(STAR_ROUNDS):
        spread, mixed = _mixed(tokens, placed)
        rest = _signed(spread.join(mixed, "token"), placed)
        # one group of the most frequent component stands for it, another in each round
        chosen = rest.where("component = main").groupBy("token").agg(F.min_by(F.struct("group", "n", "place", "signature"), F.xxhash64(F.lit(turn), "group")).alias("leader"))
        near = rest.where("component != main").join(apart(chosen), "token")
        near = near.where(_can_link(F.col("n"), F.col("place"), F.col("leader.n"), F.col("leader.place"), similarity))
        near = near.where(_near_enough(F.col("n"), F.col("signature"), F.col("leader.n"), F.col("leader.signature"), similarity))
        near = near.select(F.col("group").alias("group_1"), F.col("component").alias("component_1"), F.col("leader.group").alias("group_2"), F.col("main").alias("component_2")).distinct()
        stands = placed.groupBy(F.col("group").alias("group_2"), F.col("component").alias("component_2")).agg(F.min("node").alias("b"))
        one = apart(placed).select(F.col("node").alias("a"), F.col("group").alias("group_1"), F.col("component").alias("component_1"))
        pairs = near.join(one, ["group_1", "component_1"]).join(stands, ["group_2", "component_2"]).select("a", "b")
        links = _links(docs, pairs, nodes, shingle, similarity)
        removed(spread, mixed)
        placed = _merged(placed, links)
    spread, mixed = _mixed(tokens, placed)
    rest = _signed(spread.join(mixed, "token"), placed)
    fewer = rest.where("component != main").select("token", *[F.col(c).alias(f"{c}_1") for c in ("group", "component", "n", "place", "signature")])
    others = apart(rest)
    pairs = fewer.join(others, "token").where((F.col("component_1") != F.col("component")) & ((F.col("component") == F.col("main")) | (F.col("component_1") < F.col("component"))))
    pairs = pairs.where(_can_link(F.col("n_1"), F.col("place_1"), F.col("n"), F.col("place"), similarity))
    pairs = pairs.where(_near_enough(F.col("n_1"), F.col("signature_1"), F.col("n"), F.col("signature"), similarity))
    pairs = pairs.select("group_1", "component_1", F.col("group").alias("group_2"), F.col("component").alias("component_2")).distinct()
    one = placed.select(F.col("node").alias("a"), *[F.col(c).alias(f"{c}_1") for c in ("group", "component", "n", "signature")])
    two = apart(placed).select(F.col("node").alias("b"), *[F.col(c).alias(f"{c}_2") for c in ("group", "component", "n", "signature")])
    more = pairs.join(one, ["group_1", "component_1"]).join(two, ["group_2", "component_2"])
    more = more.where(_near_enough(F.col("n_1"), F.col("signature_1"), F.col("n_2"), F.col("signature_2"), similarity)).select("a", "b")
    links = _links(docs, more, nodes, shingle, similarity)
    removed(spread, mixed, tokens)
    final = _merged(placed, links)
    named = nodes.select("node", "key", "doc_id").join(final.select("node", "component"), "node").select("key", "doc_id", "component")
    named = written(named, "components")
    removed(nodes, final)
    return rows, named


def linked(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    rows, named = _components(docs, shingle, similarity, sketch_bits)
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_key = apart(named).select(F.col("key").alias("of_key"), "component").join(least, "component").select("of_key", "component_id")
    found = rows.select("doc_id", "key", "n").join(by_key, F.col("key") == F.col("of_key"), "left")
    return found.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One document of each component, as it was: that with the least id, ids before null, then the least key.

    Documents without words link with nothing and all stay.
    """
    own, named = _components(docs, shingle, similarity, sketch_bits)
    removed(own)
    first = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
    kept = first.select(_known(F.col("first.doc_id")).alias("kept_id"), F.col("first.key").alias("kept_key"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader()
        for batch in text.steps(batches, "text"):
            keys = [_digest(s.tobytes()) if len(s) else None for s in _sets(reader, batch.column("text"), shingle)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, set_key])

    set_key, known_id = spare(docs, "set_key"), spare(docs, "known_id")
    schema = T.StructType([*docs.schema.fields, T.StructField(set_key, T.BinaryType())])
    with small_batches(docs.sparkSession):
        rows = written(docs.mapInArrow(keyed, schema), "keyed")
    full = rows.where(F.col(set_key).isNotNull()).withColumn(known_id, _known(F.col("doc_id")))
    kept = kept.withColumnsRenamed({"kept_id": known_id, "kept_key": set_key})
    full = full.join(kept, [known_id, set_key], "left_semi").dropDuplicates([known_id, set_key])
    return full.select(*docs.columns).unionByName(rows.where(F.col(set_key).isNull()).select(*docs.columns))
