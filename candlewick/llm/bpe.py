"""Byte-level BPE through sentencepiece: the model is written straight from a vocabulary of ranks.

Every byte stands for one printable character, every vocabulary entry for a piece whose score is its
negative rank, and nothing is normalised. sentencepiece merges the adjacent pair whose union has the
highest score, leftmost first, which is the pair of lowest rank: the ids are those of the ranks.
Decoding maps ids back to bytes.

Texts are cut by a pattern before merging. A single space between two other characters that are not
white space always begins a match of the usual patterns, so texts are first cut there and the ids of
the parts are remembered per worker. A text with any other white space around a space is cut by
looking at both sides. The memory is bounded and affects speed only.

Null and empty texts have no ids; null ids decode to null. Repeated rows repeat; an empty table stays
empty; other columns are untouched.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

#: Parts of texts whose ids a worker keeps.
CACHED_PARTS = 250_000

#: Bytes of text that are encoded, or ids decoded, at a time.
PIECE_BYTES = 4_000_000

_CUT = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    of = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [of[b] for b in range(256)]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _bytes_field(number: int, value: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialize_model(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a vocabulary whose ranks are 0..n-1; its unknown piece gets id n."""
    characters = byte_characters()
    ordered = sorted(ranks, key=ranks.get)
    if [ranks[token] for token in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must be 0..n-1 without gaps")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a token: {missing[:5]}")
    model = bytearray()
    for rank, token in enumerate(ordered):
        piece = "".join(characters[b] for b in token).encode()
        # piece = 1, score = 2 (float), type = 3 (1: normal)
        model += _bytes_field(1, _bytes_field(1, piece) + b"\x15" + struct.pack("<f", -rank) + _int_field(3, 1))
    unknown = _bytes_field(1, "⁇unk".encode()) + b"\x15" + struct.pack("<f", 0.0) + _int_field(3, 2)
    model += _bytes_field(1, unknown)
    # trainer: model_type = 3 (2: BPE), vocab_size = 4, unk_id = 40
    model += _bytes_field(2, _int_field(3, 2) + _int_field(4, len(ordered) + 1) + _int_field(40, len(ordered)))
    # normalizer: name = 1, no dummy prefix = 3, no removed spaces = 4, no escaped spaces = 5
    model += _bytes_field(3, _bytes_field(1, b"identity") + _int_field(3, 0) + _int_field(4, 0) + _int_field(5, 0))
    return bytes(model)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, and the way back."""

    def __init__(self, model: bytes, pattern: str) -> None:
        import regex
        import sentencepiece

        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._match = regex.compile(pattern).findall
        self._map = {b: c for b, c in enumerate(byte_characters())}
        characters = {c: bytes([b]) for b, c in self._map.items()}
        count = self._pieces.get_piece_size() - 1
        names = [self._pieces.id_to_piece(i) for i in range(count)]
        self._bytes = [b"".join(map(characters.__getitem__, name)) for name in names]
        self._whole = {name: i for i, name in enumerate(names)}
        self._parts: dict[str, bytes | None] = {}

    def _learn(self, parts: list[str]) -> None:
        """Ids of parts; None for a part that must be seen with its neighbours."""
        kept, words = [], []
        for part in parts:
            inner = part[1:] if part[:1] == " " else part
            if not inner or inner[0].isspace() or inner[-1].isspace():
                self._parts[part] = None
            else:
                kept.append(part)
                words.append(self._match(part))
        for part, ids in zip(kept, self._encode_words(words), strict=True):
            self._parts[part] = ids

    def _encode_words(self, texts: list[list[str]]) -> list[bytes]:
        """Each match separately; a match that is a token as a whole is that token."""
        mapped = {w: w.encode().decode("latin-1").translate(self._map) for words in texts for w in words}
        ids = {w: [self._whole[m]] for w, m in mapped.items() if m in self._whole}
        rest = [w for w in mapped if w not in ids]
        ids.update(zip(rest, self._pieces.encode([mapped[w] for w in rest], num_threads=1) if rest else [], strict=True))
        packed = {w: struct.pack(f"<{len(x)}I", *x) for w, x in ids.items()}
        return [b"".join(map(packed.__getitem__, words)) for words in texts]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = []
        for text in texts:
            first, *others = text.split(" ")
            cut.append([first, *map(" ".__add__, others)] if text else [])
        if len(self._parts) > CACHED_PARTS:  # the parts met first are the frequent ones
            self._parts = dict(islice(self._parts.items(), CACHED_PARTS // 2))
        new = set().union(*cut).difference(self._parts) if cut else set()
        self._learn(list(new))
        known, out = self._parts.__getitem__, []
        for text, parts in zip(texts, cut, strict=True):
            try:
                out.append(b"".join(map(known, parts)))
            except TypeError:  # a part with white space at its edge
                out.append(b"".join(self._encode_words([self._match(x) for x in self._spaced(text)])))
        return out

    @staticmethod
    def _spaced(text: str) -> list[str]:
        first, *others = _CUT.split(text)
        return [first, *(f" {x}" for x in others)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(model: bytes, pattern: str) -> Encoder:
    """One per worker process and model."""
    key = (hash(model), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model, pattern)
    return _ENCODERS[key]


def _slices(values: pa.Array) -> Iterator[pa.Array]:
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(values), 0), dtype=np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(values):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + PIECE_BYTES, side="right")))
        yield values.slice(start, end - start)
        start = end


class ByteBpe:
    """Adds columns by one vocabulary. The model (about the size of its rank file) is broadcast.

    Rows pass through in slices of a few MB, so a worker holds little more than the model and its
    memory of parts. A column that has the result's name is replaced.
    """

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str) -> None:
        self._model = spark.sparkContext.broadcast(serialize_model(read_ranks(ranks_path)))
        self._pattern = pattern

    def _added(self, rows: DataFrame, source: str, make: Callable[[Encoder, pa.Array], list], names: list[str]) -> DataFrame:
        model, pattern = self._model, self._pattern
        kept = [name for name in rows.columns if name not in names or name == source]

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = _encoder(model.value, pattern)
            for batch in batches:
                start = 0
                for part in _slices(batch.column(source)):
                    columns = [batch.column(name).slice(start, len(part)) for name in kept]
                    new = [pa.array(x, pa.binary()) for x in make(encoder, part)]
                    yield pa.RecordBatch.from_arrays(columns + new, kept + names)
                    start += len(part)

        fields = [rows.schema[name] for name in kept] + [StructField(name, BinaryType()) for name in names]
        return rows.select(*[F.col(f"`{name}`") for name in kept]).mapInArrow(add, StructType(fields))

    def encode(self, rows: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        """Adds binary ``ids``: little-endian unsigned 32-bit integers."""
        return self._added(rows, text, lambda coder, x: [coder.encode([t or "" for t in x.to_pylist()])], [ids])

    def decode(self, rows: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """Adds binary ``decoded``: the bytes of the text."""
        back = lambda coder, x: [[None if i is None else coder.decode(i) for i in x.to_pylist()]]
        return self._added(rows, ids, back, [decoded])

    def encode_and_decode(
        self, rows: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded"
    ) -> DataFrame:
        """Both in one pass over the rows."""

        def both(coder: Encoder, texts: pa.Array) -> list[list[bytes]]:
            encoded = coder.encode([t or "" for t in texts.to_pylist()])
            return [encoded, [coder.decode(x) for x in encoded]]

        return self._added(rows, text, both, [ids, decoded])


def token_count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
