"""Token-id output: tokenise every text, code the ids in independent blocks, read them back.

Documents are dealt to shards by ranges of the id, so shard after shard is in ascending order. Each
shard is written by one task as rows of a Parquet table, each a segment: the ids of whole documents,
coded by ``range_coder`` in one or more blocks, with the ids and lengths of its documents beside the
code. Spark's own committer publishes the files, so a lost executor leaves nothing half written, and
any segment can be read alone.

Null text counts as empty text. Null ids come first; equal ids are ordered by text. Empty tables give
an empty file. Other columns are ignored. A text of any length is one document of one segment.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import range_coder, text
from millrace.llm.workspace import small_batches, workspace

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Ids after which a segment is closed at the end of a document.
SEGMENT_IDS = range_coder.LANES * range_coder.STEPS
#: Distinct pieces of text whose ids a worker keeps, and pieces encoded in one call.
KEPT_PIECES = 1 << 20
PIECES_AT_ONCE = 256
#: Bytes up to which a piece is hashed eight by eight.
HASHED_BY_EIGHTS = 64
#: The name of a worker's encoder.
_KEPT = "token_files.encoder"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Masks of the first bytes of eight.
_HEAD = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)
_SPACE, _SIGN, _LETTER, _GLUE, _STRANGE = range(5)
#: What each byte is: white space, a letter's, a sign that is cut from letters, one whose words stay whole, or none of these.
_KINDS = np.full(256, _SIGN, dtype=np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = _SPACE
_KINDS[[*range(65, 91), *range(97, 123), *range(128, 0xC2), 0xC3]] = _LETTER
_KINDS[[39, 60]] = _GLUE
_KINDS[[*range(9), *range(14, 32), 127, 0xC2, *range(0xC4, 256)]] = _STRANGE
_FILE = "shard int, segment long, n_ids long, doc_ids array<long>, lengths array<int>, code binary"


class PieceEncoder:
    """Ids of whole texts through a tokenizer that splits at white space and drops it.

    Such a tokenizer gives a text the ids of its pieces in a row. Each distinct piece is encoded once
    by the library and kept, up to ``KEPT_PIECES`` of them, for all tasks of a worker, and the ids of texts are put
    together from those. A piece is a run without ASCII white space; if it has only ASCII and Latin-1 letters besides
    ASCII signs, no apostrophe and no ``<``, it is cut further where letters meet other signs, since
    the tokenizer cuts there too. Texts with white space or line breaks outside ASCII, or with an added
    token in any case, pass through the library whole, as does any text if the tokenizer has another make.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_pieces = self.tokenizer.encode("a b", add_special_tokens=False).ids == [
            i for x in ("a", "b") for i in self.tokenizer.encode(x, add_special_tokens=False).ids
        ] and self.tokenizer.encode(" \n\t\r\x0b\x0c", add_special_tokens=False).ids == []
        self.reader = text.WordReader(text.lowering(), text.unspaced())
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        # added tokens are matched in the raw text, by exact case
        self.marks = sorted({x.content.encode().lower().decode() for x in self.tokenizer.get_added_tokens_decoder().values()})
        self.word_ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool) if suffix else None
        if suffix:
            self.word_ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.spelling = self._spelling() if self.by_pieces else self.tokenizer
        self._empty()

    def _spelling(self) -> Tokenizer:
        """The tokenizer for words of Latin-1 letters: without patterns if it does without, by all pairs of letters."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        plain = Tokenizer(self.tokenizer.model)
        plain.normalizer = normalizers.Lowercase()
        plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        letters = [chr(i) for i in (*range(97, 123), *range(0xC0, 0x100)) if chr(i).isalpha()]
        pairs = [" ".join([a, *(a + b for b in letters)]) for a in letters]
        one, two = ([x.ids for x in t.encode_batch_fast(pairs, add_special_tokens=False)] for t in (self.tokenizer, plain))
        return plain if one == two else self.tokenizer

    def _empty(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.sizes, self.begins = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each text closed by ``end``; ids per text."""
        texts = texts.fill_null("")
        if not self.by_pieces:
            return self._whole(texts.to_pylist(), end)
        odd = self._odd(*text.utf8(texts))
        lowered = pc.ascii_lower(texts)
        for mark in self.marks:
            odd |= pc.match_substring(lowered, mark).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._pieces(texts, end)
        ids, sizes = self._pieces(pa.array(["" if o else t for o, t in zip(odd, texts.to_pylist(), strict=True)], pa.large_string()), end)
        own, own_sizes = self._whole([t for o, t in zip(odd, texts.to_pylist(), strict=True) if o], end)
        parts, at = np.split(ids, np.cumsum(sizes)[:-1]), 0
        for i, size in zip(np.flatnonzero(odd), own_sizes, strict=True):
            parts[i], at = own[at : at + size], at + size
        sizes[odd] = own_sizes
        return np.concatenate(parts), sizes

    def _whole(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        lists = [[*x.ids, end] for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.array(x, dtype=np.uint32) for x in lists]), np.array([len(x) for x in lists], dtype=np.int64)

    @staticmethod
    def _odd(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Texts with characters beyond Latin-1 (where the first byte is over 0xC3) or control signs."""
        at = np.flatnonzero(_KINDS[raw] == _STRANGE)
        odd = np.zeros(len(bounds) - 1, dtype=bool)
        odd[np.searchsorted(bounds, at, "right") - 1] = True
        return odd

    def _pieces(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        words = self._cut(*text.utf8(texts))
        unique, place = np.unique(words.hashes, return_inverse=True)
        self._learn(words, unique, place)
        at = np.searchsorted(self.known, unique)[place]
        sizes, begins = self.sizes[at].astype(np.int64), self.begins[at]
        # ids of words in a row, with room for the end of each text
        texts_n = len(words.first) - 1
        before = np.concatenate(([0], np.cumsum(sizes)))
        per_text = np.diff(before[words.first]) + 1
        out = np.full(int(per_text.sum()), end, dtype=np.uint32)
        text_of = np.repeat(np.arange(texts_n), np.diff(words.first))
        source = np.repeat(begins - before[:-1], sizes) + np.arange(before[-1])
        out[np.arange(before[-1]) + np.repeat(text_of, sizes)] = self.ids[source]
        return out, per_text

    def _cut(self, raw: np.ndarray, bounds: np.ndarray) -> text.Words:
        """The pieces of texts without strange characters, given as their bytes in a row and where each begins."""
        data = self.reader.lower[raw]
        kind = _KINDS[raw]
        # 0xC3 0x97 and 0xC3 0xB7 are signs, not letters
        cross = np.flatnonzero((data == 0x97) | (data == 0xB7))
        cross = cross[data[cross - 1] == 0xC3] if len(cross) else cross
        glue = np.concatenate((np.flatnonzero(kind == _GLUE), cross))
        kind[kind == _GLUE] = _SIGN
        # whether a piece begins, and one ends before the byte
        turn = np.ones(len(data) + 1, dtype=bool)
        np.not_equal(kind[1:], kind[:-1], out=turn[1:-1])
        turn[bounds] = True
        if len(glue):
            edge = turn.copy()
            edge[1:-1] &= (kind[1:] == _SPACE) | (kind[:-1] == _SPACE)
            edge[bounds] = True
            edges = np.flatnonzero(edge)
            word = np.unique(np.searchsorted(edges, glue, "right"))
            inner, lengths = edges[word - 1] + 1, edges[word] - edges[word - 1] - 1
            turn[np.arange(int(lengths.sum())) + np.repeat(inner - np.cumsum(lengths) + lengths, lengths)] = False
        turns = np.flatnonzero(turn)
        full = np.flatnonzero(kind[turns[:-1]] != _SPACE)
        starts, ends = turns[full], turns[full + 1]
        return text.Words(data, starts, ends, self._hashes(data, starts, ends), np.searchsorted(starts, bounds))

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each piece: of its bytes, eight by eight; pieces of up to eight bytes never share one."""
        eights = np.zeros(len(data) // 8 + 2, dtype="<u8")
        eights.view(np.uint8)[: len(data)] = data
        sizes = ends - starts

        def eight(at: np.ndarray, left: np.ndarray) -> np.ndarray:
            block, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
            found = eights.take(block) >> shift
            found |= eights.take(block + 1) << np.uint64(1) << (np.uint64(63) - shift)
            return found & _HEAD.take(np.minimum(left, 8))

        out = text.mix(eight(starts, sizes))
        for done in range(8, HASHED_BY_EIGHTS, 8):
            more = np.flatnonzero(sizes > done)
            if not len(more):
                return out
            out[more] = text.mix((out.take(more) + np.uint64(done)) * _FACTOR + eight(starts.take(more) + done, sizes.take(more) - done))
        more = np.flatnonzero(sizes > HASHED_BY_EIGHTS)
        if len(more):
            out[more] = self.reader.hashes(data, starts[more], ends[more])
        return out

    def _distinct(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces in a row, and ids per piece.

        Pieces of letters alone are one word to the tokenizer each. They go to it many at a time, and
        its marks of word ends tell them apart; if the marks don't, and for other pieces, one by one.
        """
        ids: list[np.ndarray] = []
        sizes = np.zeros(len(pieces), dtype=np.int64)
        place = np.empty(len(pieces), dtype=np.int64)
        plain = [i for i, x in enumerate(pieces) if x.isalpha()] if self.word_ends is not None else []
        single = np.ones(len(pieces), dtype=bool)
        at = 0
        for k in range(0, len(plain), PIECES_AT_ONCE):
            part = np.array(plain[k : k + PIECES_AT_ONCE])
            found = np.array(self.spelling.encode_batch_fast([" ".join(pieces[i] for i in part)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            stops = np.flatnonzero(self.word_ends[found]) + 1
            if len(stops) == len(part) and stops[-1] == len(found):
                sizes[part], place[part] = np.diff(stops, prepend=0), at + np.concatenate(([0], stops[:-1]))
                single[part] = False
                ids.append(found)
                at += len(found)
        rest = np.flatnonzero(single)
        for i, x in zip(rest, self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            sizes[i], place[i] = len(x.ids), at
            ids.append(np.array(x.ids, dtype=np.uint32))
            at += len(x.ids)
        total = np.concatenate(([0], np.cumsum(sizes)))
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
        return flat[np.repeat(place - total[:-1], sizes) + np.arange(total[-1])], sizes

    def _learn(self, words: text.Words, unique: np.ndarray, place: np.ndarray) -> None:
        if len(self.known) + len(unique) > KEPT_PIECES:
            self._empty()
        found = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), dtype=bool)
        inside = found < len(self.known)
        new[inside] = self.known[found[inside]] != unique[inside]
        fresh = np.flatnonzero(new)
        if not len(fresh):
            return
        example = np.empty(len(unique), dtype=np.int64)
        example[place] = np.arange(len(place))
        spans = zip(words.starts[example[fresh]].tolist(), words.ends[example[fresh]].tolist(), strict=True)
        raw = words.data.tobytes()
        # lower-casing of ASCII came first and changes no ids without added tokens; the library does the rest
        flat, sizes = self._distinct([raw[s:e].decode() for s, e in spans])
        begins = len(self.ids) + np.concatenate(([0], np.cumsum(sizes)[:-1]))
        # both are in order, so the new ones are let in at their places
        at = found[fresh]
        self.known = np.insert(self.known, at, unique[fresh])
        self.sizes = np.insert(self.sizes, at, sizes)
        self.begins = np.insert(self.begins, at, begins)
        self.ids = np.concatenate((self.ids, flat))


def encoder_of(path: str) -> PieceEncoder:
    """The process's encoder: a worker's next task goes on with the pieces that its tasks before have met."""
    status = os.stat(path)
    return text.kept(_KEPT, lambda *file: PieceEncoder(path), path, status.st_mtime_ns, status.st_size)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end: int, shards: int | None = None, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of ``docs`` (doc_id, text) below ``folder``, in order of doc_id."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    with small_batches(docs.sparkSession):
        dealt.mapInArrow(_writer(tokenizer, end, segment_ids), _FILE).write.parquet(folder)


def _writer(tokenizer: str, end: int, segment_ids: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, segment = TaskContext.get().partitionId(), 0
        encoder = encoder_of(tokenizer)
        names: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            parts.clear()
            most = range_coder.LANES * range_coder.STEPS
            code = b"".join(range_coder.encode(ids[i : i + most]) for i in range(0, len(ids), most))
            docs, lengths = pa.chunked_array(names, pa.int64()).to_pylist(), np.concatenate(sizes).tolist()
            return pa.RecordBatch.from_pylist(
                [{"shard": shard, "segment": segment, "n_ids": len(ids), "doc_ids": docs, "lengths": lengths, "code": code}],
                schema=pa.schema([("shard", pa.int32()), ("segment", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("code", pa.binary())]),
            )

        for batch in text.steps(batches, "text", keeping=_KEPT):
            ids, counts = encoder.encode(batch.column("text"), end)
            docs, at, done = batch.column("doc_id"), 0, 0
            total = np.cumsum(counts)
            while done < len(counts):
                upto = min(len(counts), int(np.searchsorted(total, at + segment_ids - held, "left")) + 1)
                names.append(docs.slice(done, upto - done))
                sizes.append(counts[done:upto])
                parts.append(ids[at : total[upto - 1]])
                held += int(total[upto - 1]) - at
                at, done = int(total[upto - 1]), upto
                if held >= segment_ids:
                    yield close()
                    segment, held = segment + 1, 0
                    names.clear(), sizes.clear()
        if parts:
            yield close()

    return write


def read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray]]:
    """Each segment's row and its decoded ids; a wrong checksum raises."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in ("shard", "segment", "n_ids", "doc_ids", "lengths")}
            code, at, parts = memoryview(batch.column("code")[i].as_buffer()), 0, []
            while at < len(code):
                ids, size = range_coder.decode(code[at:])
                parts.append(ids)
                at += size
            ids = np.concatenate(parts)
            if len(ids) != row["n_ids"] or sum(row["lengths"]) != row["n_ids"]:
                raise ValueError(f"segment {row['segment']} of shard {row['shard']} is incomplete")
            yield row, ids


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, ids in read_segments(batches):
        lengths = np.array(row["lengths"], dtype=np.int64)
        stops = np.cumsum(lengths)
        raw = memoryview(ids.astype("<u4")).cast("B")
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((stops - lengths).tolist(), stops.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in ((np.full(len(lengths), row["shard"]), pa.int32()), (np.full(len(lengths), row["segment"]), pa.int64()), (row["doc_ids"], pa.int64()), (stops - lengths, pa.int64()), (lengths, pa.int64()), (sums, pa.int64()))],
            names=["shard", "segment", "doc_id", "offset", "n_tokens", "ids_crc32"],
        )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a written folder: doc_id, start, n_tokens, ids_crc32, and where it lies (shard, segment)."""
    files = spark.read.schema(_FILE).parquet(folder)
    sizes = files.select("shard", "segment", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(shards, "shard")
    starts = starts.select("shard", "segment", (F.col("shard_start") + F.col("before")).alias("segment_start"))
    docs = files.select("shard", "segment", "n_ids", "doc_ids", "lengths", "code").mapInArrow(
        _digests, "shard int, segment long, doc_id long, offset long, n_tokens long, ids_crc32 long"
    )
    return docs.join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("segment_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard", "segment"
    )


def token_digests(docs: DataFrame, tokenizer: str, end: int = 2, folder: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` as token files and give each document's place and checksum as read back."""
    folder = folder or workspace(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, end)
    return read_digests(docs.sparkSession, folder)
