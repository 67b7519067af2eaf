"""Tables that grow by segments: every run appends the versions it has, and later versions replace earlier ones.

A segment is what one run wrote: rows dealt over files by ranges of a hash of the business key, so that within a
segment one file at most can hold a key. Each row says whether an earlier segment holds a version of its
key (``replaces``); a key's rows are that chain, and its newest row is the live one. So the number of
live rows is that of all rows less the replacing ones, and readers leave out the earlier versions with one
anti-join against the replacing rows of later segments, which are few until they are merged.

Two small tables beside the rows say what each file holds: the range of hashes (a zone map), the range of update
times, counts and digests of its rows; and a Bloom filter of its keys, as words of 64 bits. A batch is
matched with both, by joins, before any row is read: only files that can hold one of its keys are opened.

When the newest segments have grown together to a share of the one before, they are merged into one. A row is
rewritten a logarithmic number of times, and a table has a logarithmic number of segments.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import SEGMENTS

HASH, REPLACES, RUN = "id_hash", "replaces", "run_id"
#: Rows of a file; some hundred megabytes of facts.
ROWS_PER_FILE = 1 << 20
#: Bits of the Bloom filter per key, and bits set for each in its word.
BITS_PER_KEY, BITS_SET = 16, 4
#: Merge the newest segments if there are so many, each at most so many times the rows of all newer ones.
FAN, RATIO = 4, 4
#: With more keys per file than this nearly every file is hit: none is looked for.
KEYS_PER_FILE = 8
#: Files that are opened sooner than looked up.
FEW_FILES = 16
#: Most files named one by one to a reader.
LISTED = 10_000

_long = T.LongType()


def key_hash(key: str) -> Column:
    """A hash of the key that is never negative."""
    return F.shiftrightunsigned(F.xxhash64(key), 1)


def _mask(hashed: Column) -> Column:
    """The bits of a key in its word of a Bloom filter."""
    other = F.xxhash64(hashed)
    mask = F.lit(0).cast("bigint")
    for i in range(BITS_SET):
        bit = F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows, known as such to the planner."""
    return spark.range(0).where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def live_rows(segments: Sequence) -> int:
    return sum(s["row_count"] - s["replacing"] for s in segments)


class SegmentTable:
    """One table below a folder. ``segments`` everywhere are those of a commit, oldest first."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        schema: T.StructType,
        business_key: str,
        surrogate_key: str,
        updated: str | None = None,
    ):
        self.spark, self.root, self.name, self.schema = spark, root, name, schema
        self.business_key, self.surrogate_key, self.updated = business_key, surrogate_key, updated
        self.stored = T.StructType(
            schema.fields + [T.StructField(HASH, _long), T.StructField(REPLACES, T.BooleanType()), T.StructField(RUN, T.StringType())]
        )

    def folder(self, run_id: str, part: str = "") -> str:
        return f"{self.root}/{self.name}{part}/{RUN}={run_id}"

    def _rows(self, segments: Sequence, files: Collection[str] | None = None) -> DataFrame:
        """All stored rows of some segments, or of some of their files, with the segment's place in time."""
        paths = [self.folder(s[RUN]) for s in segments] if files is None else sorted(files)
        if not paths:
            return empty(self.spark, self.stored).withColumn("place", F.lit(0))
        places = F.create_map(*[F.lit(v) for i, s in enumerate(segments) for v in (s[RUN], i)])
        reader = self.spark.read.schema(self.stored).option("basePath", f"{self.root}/{self.name}")
        return reader.parquet(*paths).withColumn("place", places[F.col(RUN)])

    def _beside(self, segments: Sequence, part: str) -> DataFrame:
        reader = self.spark.read.option("basePath", f"{self.root}/{self.name}{part}")
        return reader.parquet(*[self.folder(s[RUN], part) for s in segments])

    # reading

    def read(self, segments: Sequence, updated: tuple[datetime, datetime] | None = None) -> DataFrame:
        """The live rows; with ``updated`` only those updated in [from, to), from files that can hold some."""
        columns, key = self.schema.names, self.surrogate_key
        files, wanted = None, F.lit(True)
        if updated is not None:
            at = F.col(self.updated)
            wanted = (at >= F.lit(updated[0])) & (at < F.lit(updated[1]))
            files = self._files(self._beside(segments, "_files").where((F.col("max_at") >= F.lit(updated[0])) & (F.col("min_at") < F.lit(updated[1])))) if segments else None
        last = max((i for i, s in enumerate(segments) if i and s["replacing"]), default=0)
        rows = self._rows(segments, files).where(wanted)
        if not last:
            return rows.select(*columns)
        replacing = [s for i, s in enumerate(segments) if i and s["replacing"]]
        places = F.create_map(*[F.lit(v) for i, s in enumerate(segments) for v in (s[RUN], i)])
        marks = self._rows(replacing).where(F.col(REPLACES)).select(F.col(key).alias("_key"), places[F.col(RUN)].alias("_place"))
        newest = marks.groupBy("_key").agg(F.max("_place").alias("_newest"))
        kept = rows.where(F.col("place") < last).join(newest, (F.col(key) == F.col("_key")) & (F.col("place") < F.col("_newest")), "left_anti")
        return kept.select(*columns).unionByName(rows.where(F.col("place") >= last).select(*columns))

    def current(self, segments: Sequence, keys: DataFrame, key_count: int, *columns: str) -> DataFrame:
        """Key, surrogate key and further columns of the newest versions of some distinct business keys."""
        names = [self.surrogate_key, *columns]
        if not segments:
            return empty(self.spark, T.StructType([self.schema[n] for n in (self.business_key, *names)]))
        rows = self._rows(segments, self.files_for(segments, keys, key_count)).select(self.business_key, *names, "place")
        # a key that a third of the batch shares can't be: keys are distinct, versions one a segment
        found = rows.join(keys.select(self.business_key), self.business_key, "left_semi")
        newest = found.groupBy(self.business_key).agg(F.max_by(F.struct(*names), "place").alias("newest"))
        return newest.select(self.business_key, "newest.*")

    def files_for(self, segments: Sequence, keys: DataFrame, key_count: int) -> set[str] | None:
        """The files that can hold some of the keys; None means all."""
        total = sum(s["file_count"] for s in segments)
        if total <= FEW_FILES or key_count > KEYS_PER_FILE * total:
            return None
        shift = 63 - max(s["file_count"] for s in segments).bit_length()
        probes = keys.select(key_hash(self.business_key).alias("h")).distinct().withColumn("span", F.shiftright("h", shift))
        spans = self._beside(segments, "_files").withColumn("span", F.explode(F.sequence(F.shiftright("min_hash", shift), F.shiftright("max_hash", shift))))
        pairs = probes.join(spans, "span").where(F.col("h").between(F.col("min_hash"), F.col("max_hash")))
        pairs = pairs.select("h", RUN, "file", (F.col("h") % F.col("words")).alias("word"))
        hits = pairs.join(self._beside(segments, "_blooms"), [RUN, "file", "word"]).where(F.col("bits").bitwiseAND(_mask(F.col("h"))) == _mask(F.col("h")))
        return self._files(hits)

    def _files(self, listed: DataFrame) -> set[str] | None:
        found = listed.select(RUN, "file").distinct().limit(LISTED + 1).collect()
        return None if len(found) > LISTED else {f"{self.folder(r[RUN])}/{r['file']}" for r in found}

    # writing

    def append(self, versions: DataFrame, run_id: str, rows: int) -> Row:
        """Write the segment of a run: ``rows`` versions with their surrogate keys and ``replaces``."""
        files = max(1, -(-rows // ROWS_PER_FILE))
        placed = versions.select(*self.schema.names, key_hash(self.business_key).alias(HASH), REPLACES)
        if files > 1:
            share = F.floor(F.col(HASH) / F.lit(float(1 << 63) / files)).cast("int")
            placed = placed.repartitionById(files, F.least(share, F.lit(files - 1)))
        else:
            placed = placed.repartition(1)
        placed.sortWithinPartitions(HASH).write.mode("overwrite").parquet(self.folder(run_id))
        words = 1 + -(-rows // files) * BITS_PER_KEY // 64
        written = self._rows([{RUN: run_id}]).withColumn("file", F.col("_metadata.file_name"))
        if written.isEmpty():
            return Row(**dict(zip(SEGMENTS.elementType.names, (run_id, 0, 0, 0, 0), strict=True)))
        at = F.col(self.updated) if self.updated else F.lit(None).cast("timestamp_ntz")
        listed = written.groupBy("file").agg(
            *self._digests(), F.count_if(REPLACES).alias("replacing"), F.max(self.surrogate_key).alias("last_key"),
            F.min(HASH).alias("min_hash"), F.max(HASH).alias("max_hash"), F.min(at).alias("min_at"), F.max(at).alias("max_at"),
            F.lit(words).cast("bigint").alias("words"),
        )
        blooms = written.groupBy("file", (F.col(HASH) % words).alias("word")).agg(F.bit_or(_mask(F.col(HASH))).alias("bits"))
        with ThreadPoolExecutor(2) as pool:
            list(pool.map(lambda x: x[0].write.mode("overwrite").parquet(self.folder(run_id, x[1])), [(listed, "_files"), (blooms, "_blooms")]))
        total = self._beside([{RUN: run_id}], "_files").agg(F.sum("row_count"), F.sum("replacing"), F.count(F.lit(1)), F.max("last_key")).first()
        return Row(**dict(zip(SEGMENTS.elementType.names, (run_id, total[0] or 0, total[1] or 0, total[2], total[3] or 0), strict=True)))

    def _digests(self) -> list[Column]:
        hashed = F.xxhash64(*self.schema.names)
        return [F.count(F.lit(1)).alias("row_count"), F.bit_xor(hashed).alias("xor_hash"), F.sum(hashed.cast("decimal(38,0)")).alias("sum_hash")]

    def merging(self, segments: Sequence) -> int:
        """From which segment on they are to be merged; their number if none are."""
        at, newer = len(segments), 0
        while at and segments[at - 1]["row_count"] <= RATIO * newer or at == len(segments) and at:
            at -= 1
            newer += segments[at]["row_count"]
        return at if len(segments) - at >= FAN else len(segments)

    def merged(self, segments: Sequence, run_id: str) -> list:
        """The segments after merging the newest, if they have grown together."""
        at = self.merging(segments)
        if at == len(segments):
            return list(segments)
        rows = self._rows(segments[at:])
        newest = rows.groupBy(self.surrogate_key).agg(
            F.max_by(F.struct(*self.schema.names), "place").alias("newest"), F.bool_and(REPLACES).alias(REPLACES)
        )
        total = sum(s["row_count"] for s in segments[at:])
        return [*segments[:at], self.append(newest.select("newest.*", REPLACES), f"{run_id}-merged", total)]

    # checking

    def verify(self, segments: Sequence) -> DataFrame:
        """What is wrong with the stored table, read as a whole: (run_id, file, problem); empty if nothing is.

        Files are held against the digests written with them, keys and ids against being there twice.
        """
        problems = [empty(self.spark, T.StructType([T.StructField(n, T.StringType()) for n in (RUN, "file", "problem")]))]
        if segments:
            found = self._rows(segments).groupBy(RUN, F.col("_metadata.file_name").alias("file")).agg(*self._digests())
            digests = ["row_count", "xor_hash", "sum_hash"]
            there = found.select(RUN, "file", F.struct(*digests).alias("found"))
            listed = self._beside(segments, "_files").select(RUN, "file", F.struct(*digests).alias("listed"))
            problem = F.when(F.col("found").isNull(), "missing").when(F.col("listed").isNull(), "unlisted").when(F.col("found") != F.col("listed"), "damaged")
            problems.append(there.join(listed, [RUN, "file"], "full").select(RUN, "file", problem.alias("problem")).where("problem IS NOT NULL"))
            live = self.read(segments)
            for key in (self.business_key, self.surrogate_key):
                twice = live.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                total = twice.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
                problems.append(total.select(F.lit(None).cast("string").alias(RUN), F.lit(None).cast("string").alias("file"), F.concat(F.lit(f"{key} repeated: "), "n").alias("problem")))
        result = problems[0]
        for part in problems[1:]:
            result = result.unionByName(part)
        return result
