"""Token ids in binary: fixed-size blocks, transposed into byte or bit planes, each plane compressed.

``write_ids`` encodes documents in ascending id order and writes one Parquet row per block of
``block_ids`` ids: the zstandard-compressed planes (Parquet itself does not compress them again) and
the block's entry of the chunk index, namely its shard, number, first id, number of ids, checksum and
the document segments that it holds. A document may span blocks, and a block many documents. The index
columns can be read without the planes. Spark's own writer commits the files, so a lost executor or a
second attempt leaves no partial block.

``read_digests`` and ``read_segments`` decode each block by itself; nothing but one small row per
segment is shuffled, however long a document is.

Order: ascending id (null first), rows of one id as the table has them; so a hot id is spread over
shards like any other. Null and empty texts consist of the end id alone. An empty table gives no
blocks. Columns other than the two named are ignored.
"""

from __future__ import annotations

import json
import re
import string
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

#: Ids of a block.
BLOCK_IDS = 1 << 18

#: Parts of texts whose ids a worker keeps, and bytes of text encoded at a time (both for speed only).
CACHED_PARTS = 800_000
PIECE_BYTES = 4_000_000

#: Parts that are encoded as one text (for speed only), and the sign before a part as byte-level vocabularies write it.
JOINED_PARTS = 500
SIGNS = {" ": "\u0120", "\n": "\u010a"}

#: A newline between two other characters than white space: it is a token, and a text can be cut on both sides of it.
_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")

#: What is cut off behind a letter or digit, if that is older than any difference between tables of Unicode.
MARKS, _KNOWN = string.punctuation, "\u0250"


class _Parts(dict):
    """Packed ids by part. A part not met yet gets an empty buffer, which ``Tokens`` fills later, and a place in ``new``.

    A part has a space before it, or begins with its newline. Parts that begin or end with other white
    space, and empty ones, have None: texts are not cut there.
    """

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, part: str) -> bytearray | None:
        found = None
        if part and not part[-1].isspace() and not part[part[0] == "\n"].isspace():
            found = bytearray()
            self.new.append(part)
        self[part] = found
        return found

    def shrink(self) -> None:
        """Keeps the parts met first, which are the frequent ones."""
        kept = dict(islice(self.items(), CACHED_PARTS // 2))
        self.clear()
        self.update(kept)


class Tokens:
    """Ids of texts from the tokenizers library.

    A plain byte-level BPE (no normalizer, no prefix space, no post-processing, no merged white space)
    cuts a text at every single space or newline between two other characters before merging, and
    between a letter or digit and the marks behind it. For such a tokenizer, the parts between these
    spaces and newlines are encoded once and remembered, words apart from the marks behind them. Any
    other tokenizer, and any text with other white space around a space, is encoded as it is.
    """

    def __init__(self, source: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(source)
        self._tokenizer.encode_special_tokens = True
        self._end = np.array([end_id], "<u4").tobytes()
        self._plain = self._is_plain(json.loads(source))
        self._parts = _Parts()
        words = self._tokenizer.get_vocab(with_added_tokens=True)
        self._begins = {sign: np.zeros(max(words.values(), default=0) + 1, bool) for sign in SIGNS}
        for sign, begins in self._begins.items():
            begins[[i for word, i in words.items() if word.startswith(SIGNS[sign])]] = True

    @staticmethod
    def _is_plain(spec: dict) -> bool:
        cut = spec.get("pre_tokenizer") or {}
        own = (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
        special = all(added.get("special") for added in spec.get("added_tokens") or [])
        unchanged = not any(spec.get(part) for part in ("normalizer", "post_processor", "truncation", "padding"))
        return own and unchanged and special and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout")

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn(self) -> None:
        """Fills in the ids of the new parts, each with the sign before it."""
        known, spaced, lines, several, marked, marks = self._parts, [], [], [], [], set()
        for part in known.new:  # grows by the words that have only been met with marks
            if part[-1] in MARKS:
                word = part.rstrip(MARKS)
                if word and word[-1] < _KNOWN and word[-1].isalnum():
                    known[word]
                    marked.append(part)
                    marks.add(part[len(word) :])
                    continue
            (spaced if part[0] != "\n" else several if "\n" in part[1:] else lines).append(part)
        self._fill(spaced, " ", " ")
        self._fill(lines, "\n", "")
        for part, ids in zip(several, self._whole(several), strict=True):
            known[part].extend(ids)
            known[part] = ids
        marks = dict(zip(marks, self._whole(list(marks)), strict=True))
        for part in marked:
            word = part.rstrip(MARKS)
            ids = known[word] + marks[part[len(word) :]]
            known[part].extend(ids)
            known[part] = ids
        known.new.clear()

    def _fill(self, parts: list[str], sign: str, before: str) -> None:
        """Many parts make one text, so that the library is not called for each: a part has one sign, in front,
        so a token that begins with one begins a part. ``before`` is the sign if parts lack it."""
        known, begins = self._parts, self._begins[sign]
        groups = [parts[i : i + JOINED_PARTS] for i in range(0, len(parts), JOINED_PARTS)]
        for group, packed in zip(groups, self._whole([before + before.join(group) for group in groups]), strict=True):
            cuts = (np.flatnonzero(begins[np.frombuffer(packed, "<u4")]) * 4).tolist()
            for part, start, end in zip(group, cuts, [*cuts[1:], len(packed)], strict=True):
                ids = packed[start:end]
                known[part].extend(ids)
                known[part] = ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian ids, each with the end id behind it."""
        if not self._plain:
            return [x + self._end for x in self._whole(texts)]
        if len(self._parts) > CACHED_PARTS:
            self._parts.shrink()
        cut = [_LINE.sub(" \n", text).split(" ") for text in texts]
        firsts, known = self._whole([parts[0] for parts in cut]), self._parts.__getitem__
        later = [list(map(known, islice(parts, 1, None))) for parts in cut]
        self._learn()
        out = []
        for text, parts, first, others in zip(texts, cut, firsts, later, strict=True):
            try:
                if others and (not parts[0] or parts[0][-1].isspace() or " \n" in text):
                    raise TypeError
                out.append(first + b"".join(others) + self._end)
            except TypeError:  # white space around a space
                out.append(self._whole([text])[0] + self._end)
        return out


_TOKENS: dict[tuple[int, int], Tokens] = {}


def _tokens(source: str, end_id: int) -> Tokens:
    """One per worker process and tokenizer."""
    key = (hash(source), end_id)
    if key not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[key] = Tokens(source, end_id)
    return _TOKENS[key]


def split_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The ids' bytes (4 planes) or bits (32 planes), lowest first."""
    columns = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(columns[:, i]).tobytes() for i in range(4)]
    each = np.unpackbits(columns, axis=1, bitorder="little")
    return [np.packbits(each[:, i], bitorder="little").tobytes() for i in range(32)]


def join_planes(planes: list[bytes], count: int) -> np.ndarray:
    """Back from 4 byte planes or 32 bit planes."""
    if len(planes) == 4:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")
    each = np.stack(
        [np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in planes], axis=1
    )
    return np.packbits(each, axis=1, bitorder="little").reshape(-1).view("<u4")


def _segments(key: pa.DataType) -> pa.DataType:
    return pa.list_(pa.struct([("id", key), ("document", pa.int64()), ("offset", pa.int64()), ("count", pa.int64())]))


class _Blocks:
    """Gathers documents and gives out full blocks."""

    def __init__(self, block_ids: int, bits: bool, level: int, key: pa.DataType) -> None:
        self._size, self._bits, self._key = block_ids, bits, key
        self._compress = zstandard.ZstdCompressor(level=level).compress
        self._shard = TaskContext.get().partitionId()
        self._ids, self._held, self._segments = [], 0, []
        self._block = self._first = 0

    def add(self, key: object, packed: bytes) -> Iterator[pa.RecordBatch]:
        ids, begins, offset = np.frombuffer(packed, "<u4"), self._first + self._held, 0
        while offset < len(ids):
            part = ids[offset : offset + self._size - self._held]
            self._ids.append(part)
            self._segments.append({"id": key, "document": begins, "offset": offset, "count": len(part)})
            self._held += len(part)
            offset += len(part)
            if self._held == self._size:
                yield self.flush()

    def flush(self) -> pa.RecordBatch:
        ids = np.concatenate(self._ids) if self._ids else np.zeros(0, "<u4")
        row = {
            "shard": self._shard, "block": self._block, "first": self._first, "n_ids": len(ids),
            "checksum": zlib.crc32(ids.tobytes()), "segments": self._segments,
            "planes": [self._compress(plane) for plane in split_planes(ids, self._bits)],
        }
        types = {
            "shard": pa.int32(), "block": pa.int32(), "first": pa.int64(), "n_ids": pa.int64(),
            "checksum": pa.int64(), "segments": _segments(self._key), "planes": pa.list_(pa.binary()),
        }
        out = pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in types.items()], list(types)) if len(ids) else None
        self._block, self._first = self._block + 1, self._first + len(ids)
        self._ids, self._held, self._segments = [], 0, []
        return out


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
    bits: bool = False,
    level: int = 3,
) -> None:
    """Encodes all texts, each followed by ``end_id``, and writes the blocks to a new folder ``path``.

    The tokenizer file is read once here and broadcast (it is a vocabulary, a few MB).
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        source = spark.sparkContext.broadcast(file.read())
    ordered = (
        docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(F.col("id").asc_nulls_first(), "place")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "place")
        .select("id", "text")
    )
    kind = docs.schema[key].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, out = _tokens(source.value, end_id), None
        for batch in batches:
            for ids, texts in _slices(batch):
                out = out or _Blocks(block_ids, bits, level, ids.type)
                for one, packed in zip(ids.to_pylist(), tokens.encode(texts.to_pylist()), strict=True):
                    yield from out.add(one, packed)
        if out and (last := out.flush()):
            yield last

    schema = (
        f"shard int, block int, first bigint, n_ids bigint, checksum bigint, "
        f"segments array<struct<id:{kind},document:bigint,offset:bigint,count:bigint>>, planes array<binary>"
    )
    ordered.mapInArrow(blocks, schema).write.option("compression", "uncompressed").parquet(path)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    ids, texts = batch.column(0), batch.column(1)
    ends, start = np.cumsum(np.asarray(pa.compute.binary_length(texts), dtype=np.int64)), 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + PIECE_BYTES, side="right")))
        yield ids.slice(start, end - start), texts.slice(start, end - start)
        start = end


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index: one row per block, with ``start``, the ids in all shards and blocks before it."""
    index = spark.read.parquet(path).select("shard", "block", "first", "n_ids", "checksum", "segments")
    return index.join(_shard_starts(index), "shard").withColumn("start", F.col("shard_start") + F.col("first"))


def _shard_starts(index: DataFrame) -> DataFrame:
    """Ids before each shard. The window runs over one row per shard, that is per file written."""
    totals = index.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))


def _decoded(row: dict, decompress: Callable[[bytes], bytes]) -> np.ndarray:
    ids = join_planes([decompress(plane) for plane in row["planes"]], row["n_ids"])
    if zlib.crc32(ids.tobytes()) != row["checksum"]:
        raise ValueError(f"block {row['block']} of shard {row['shard']} is damaged")
    return ids


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The ids again: rows (id, shard, document, offset, ids), several for a document that spans blocks.

    ``document`` is where it begins in its shard, ``offset`` where the segment begins in the document.
    """
    return _per_segment(spark, path, "ids array<bigint>", lambda ids: ids.tolist(), pa.list_(pa.int64()))


def _per_segment(
    spark: SparkSession, path: str, column: str, value: Callable[[np.ndarray], object], arrow: pa.DataType
) -> DataFrame:
    stored = spark.read.parquet(path)
    kind = stored.schema["segments"].dataType.elementType["id"].dataType.simpleString()
    name = column.split(" ")[0]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("shard", "block", "n_ids", "checksum", "planes")}
                ids, segments = _decoded(row, decompress), batch.column("segments")[i].values
                ends = np.cumsum(segments.field("count").to_numpy()).tolist()
                values = [value(ids[start:end]) for start, end in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        segments.field("id"),
                        pa.array(np.full(len(values), row["shard"], np.int32)),
                        *[segments.field(c) for c in ("document", "offset", "count")],
                        pa.array(values, arrow),
                    ],
                    ["id", "shard", "document", "offset", "count", name],
                )

    schema = f"id {kind}, shard int, document bigint, offset bigint, count bigint, {column}"
    return stored.mapInArrow(decode, schema)


_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), modulo the one of crc32, lowest power in the top bit."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return product


def crc32_of_parts(parts: list[tuple[int, int]]) -> int:
    """The crc32 of byte strings put together, from the (crc32, length) of each."""
    total = 0
    for crc, length in parts:
        shift, square, bits = 1 << 31, 1 << 23, length  # x^0; x^8: one byte
        while bits:
            shift = _times(shift, square) if bits & 1 else shift
            square, bits = _times(square, square), bits >> 1
        total = _times(total, shift) ^ crc
    return total


@F.arrow_udf(LongType())
def _combined(parts: pa.Array) -> pa.Array:
    crc = parts.flatten().field("crc").to_numpy()
    sizes = parts.value_lengths().to_numpy()
    out = crc[np.cumsum(sizes) - sizes]
    for i in np.flatnonzero(sizes > 1).tolist():
        out[i] = crc32_of_parts([(x["crc"], 4 * x["count"]) for x in parts[i].as_py()])
    return pa.array(out, pa.int64())


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: id, start (ids of all documents before it), n_tokens, ids_crc32."""
    parts = _per_segment(spark, path, "crc bigint", lambda ids: zlib.crc32(ids.tobytes()), pa.int64())
    segment: Column = F.struct("offset", "count", "crc")
    whole = parts.groupBy("shard", "document", "id").agg(
        F.sum("count").alias("n_tokens"), F.sort_array(F.collect_list(segment)).alias("parts")
    )
    starts = _shard_starts(spark.read.parquet(path).select("shard", "n_ids"))
    return whole.join(starts, "shard").select(
        "id",
        (F.col("shard_start") + F.col("document")).alias("start"),
        "n_tokens",
        _combined(F.col("parts")).alias("ids_crc32"),
    )
