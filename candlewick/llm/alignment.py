"""Which tokens of two tokenizers cover the same bytes, and in how many documents each pair of ids does.

Side A is a byte-level BPE (tokenizers file), side B a sentencepiece model that puts a space before a text; A
sees the text with that space. Both sides' tokens are cut from the same bytes, so the union of their ends cuts
a text into links: each piece lies in one token of A and one of B, and no two pieces have the same two tokens.
Ends that both sides have close a group.

Counting is external and side-major:

1. Every ``RUN_BYTES`` of text make a run: its (pair, document) records, sorted by pair with A's id first,
   are stored with zstandard. The pairs are also dealt into ``RADIX`` parts by A's id, with the number of the
   run's documents for each.
2. ``FAN`` runs (on average) of a part at a time are merged by a heap over the runs' blocks of one A id; merged
   runs are merged again until a part has one. All pairs of an A id come together, so the last merge also
   knows the largest count of each A id. A merge holds ``FAN`` runs at most of what the vocabularies allow
   for a part, however frequent an id is.
3. Counts, and whether they are their A id's largest, go the same way back: from merged runs to the runs that
   they were made of, position by position, and at last into the run's records, where they are added up for
   each document.

Records are never shuffled by id; only one number for each pair of a run travels.

Null and empty texts, and texts whose tokens do not spell the text (white space or characters that a side
replaces), have no tokens: counts of 0, and '' instead of a digest. Repeated rows are documents of their own;
null ids are kept; an empty table gives an empty result; other columns are ignored. Vocabularies are limited
to 65,536 entries a side.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.graph import _dropped, _stored
from candlewick.llm.text import pieces

#: Text of a run, parts by A's id, and runs that are merged at once (on average).
RUN_BYTES, RADIX, FAN = 4_000_000, 64, 48

#: More rows than this make another run: documents of a run are numbered in 16 bits.
RUN_ROWS = 1 << 15

_IDS = 1 << 16
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")

#: tiktoken's pattern engine refuses longer runs of white space.
_LONG_SPACE = re.compile(r"\s{2000}")


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, the
    other bytes for the characters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteLevel:
    """Side A. Where the file's merges are its ids in order, tiktoken gives the same ids faster."""

    def __init__(self, source: str, pattern: str) -> None:
        from tokenizers import Tokenizer

        spec, byte = json.loads(source), byte_alphabet()
        self._slow = Tokenizer.from_str(source)
        self._slow.encode_special_tokens = True
        vocabulary = self._slow.get_vocab(with_added_tokens=True)
        added = {x["content"] for x in spec.get("added_tokens", [])}
        spell = lambda entry: entry.encode() if entry in added else bytes(map(byte.__getitem__, entry))
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes[i] = spell(entry)
        self._fast = self._as_ranks(spec, vocabulary, added, pattern)

    def _as_ranks(self, spec: dict, vocabulary: dict[str, int], added: set[str], pattern: str):
        import tiktoken

        cut = spec.get("pre_tokenizer") or {}
        plain = (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
        model = spec["model"]
        merges = [x if isinstance(x, list) else x.split(" ") for x in model.get("merges", [])]
        made = [vocabulary.get(a + b, -1) for a, b in merges]
        in_order = made == sorted(set(made)) and len(merges) + 256 == len(vocabulary) - len(added & set(vocabulary))
        if not plain or not in_order or model.get("dropout") or model.get("ignore_merges") or any(
            spec.get(x) for x in ("normalizer", "post_processor", "truncation", "padding")
        ):
            return None
        ranks = {self.bytes[i]: i for entry, i in vocabulary.items() if entry not in added}
        return tiktoken.Encoding("side", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self._fast is None or _LONG_SPACE.search(text):
            return self._slow.encode(text, add_special_tokens=False).ids
        return self._fast.encode_ordinary(text)


class Pieces:
    """Side B."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_proto=model)
        name = self._model.id_to_piece
        self.bytes = [
            bytes([int(name(i)[3:5], 16)]) if self._model.is_byte(i) else name(i).replace("▁", " ").encode()
            for i in range(self._model.get_piece_size())
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1) if texts else []


class Aligner:
    """Links and records of the texts of a run."""

    def __init__(self, a: str, pattern: str, b: bytes) -> None:
        self.a, self.b = ByteLevel(a, pattern), Pieces(b)
        if max(len(self.a.bytes), len(self.b.bytes)) > _IDS:
            raise ValueError("vocabularies of up to 65,536 entries")
        self._sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        most = max(len(self.a.bytes), len(self.b.bytes))
        self._written = [f"{i}{mark}" for i in range(most) for mark in ",|;"]

    def _tokens(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        full = [i for i, t in enumerate(texts) if t]
        a: list[list[int]] = [[] for _ in texts]
        b: list[list[int]] = [[] for _ in texts]
        spell_a, spell_b = self.a.bytes.__getitem__, self.b.bytes.__getitem__
        for i, other in zip(full, self.b.encode([texts[i] for i in full]), strict=True):
            spaced = " " + texts[i]
            want = spaced.encode()
            if b"".join(map(spell_b, other)) == want:
                own = self.a.encode(spaced)
                if self.a._fast is not None or b"".join(map(spell_a, own)) == want:
                    a[i], b[i] = own, other
        return a, b

    def run(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray | list[str]], dict[str, np.ndarray]]:
        """Columns of one row per text, and the run's records sorted by (A id as dealt, B id, text)."""
        sides = self._tokens(texts)
        counts = [np.array([len(x) for x in side], np.int64) for side in sides]
        ids = [np.fromiter((t for x in side for t in x), np.uint32, int(n.sum())) for side, n in zip(sides, counts, strict=True)]
        del sides
        ends_a, ends_b = (np.cumsum(size[own]) for size, own in zip(self._sizes, ids, strict=True))
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        cut = ends[np.r_[ends[1:] != ends[:-1], len(ends) > 0][: len(ends)]]
        at_a, at_b = np.searchsorted(ends_a, cut), np.searchsorted(ends_b, cut)
        doc = np.repeat(np.arange(len(texts)), counts[0])[at_a]
        both = (ends_a[at_a] == cut) & (ends_b[at_b] == cut)
        numbers = lambda of: np.bincount(of, minlength=len(texts))
        columns = {
            "n_a": counts[0], "n_b": counts[1], "n_groups": numbers(doc[both]), "n_links": numbers(doc),
            "groups_sha256": self._digests(ids, ends_a, ends_b, cut[both], counts),
        }
        a = ids[0][at_a].astype(np.uint64)
        dealt = (a % RADIX) * (_IDS // RADIX) + a // RADIX
        keys = (((dealt << 16) | ids[1][at_b]) << 16) | doc.astype(np.uint64)
        keys.sort()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        times = np.diff(np.r_[first, len(keys)])
        keys = keys[first]
        return columns, {"pair": (keys >> 16).astype(np.uint32), "doc": (keys & 0xFFFF).astype(np.uint16), "times": times}

    def _digests(
        self, ids: list[np.ndarray], ends_a: np.ndarray, ends_b: np.ndarray, common: np.ndarray, counts: list[np.ndarray]
    ) -> list[str]:
        """sha256 of each text's groups as they are written: A's ids, a bar, B's ids; semicolons between."""
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        till_a, till_b = np.searchsorted(ends_a, common, side="right"), np.searchsorted(ends_b, common, side="right")
        codes = np.empty(len(ends_a) + len(ends_b), np.int64)
        # In front of A's tokens are B's of earlier groups; in front of B's are also A's of their own group.
        place_a = np.arange(len(ends_a)) + np.r_[0, till_b][group_a]
        place_b = np.arange(len(ends_b)) + till_a[group_b] if len(till_a) else np.zeros(0, np.int64)
        codes[place_a] = ids[0].astype(np.int64) * 3 + (common[group_a] == ends_a)
        codes[place_b] = ids[1].astype(np.int64) * 3 + 2 * (common[group_b] == ends_b)
        written, out, start = self._written.__getitem__, [], 0
        for n in (counts[0] + counts[1]).tolist():
            if not n:
                out.append("")
                continue
            text = "".join(map(written, codes[start : start + n].tolist()))
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest())
            start += n
        return out


class AlignerSource:
    """What tasks need to build the aligner, once per worker process."""

    _built: dict[int, Aligner] = {}

    def __init__(self, a_file: str, pattern: str, b_file: str) -> None:
        with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
            self._parts = a.read(), pattern, b.read()
        self._name = hash(self._parts)

    def here(self) -> Aligner:
        if self._name not in self._built:
            self._built.clear()
            self._built[self._name] = Aligner(*self._parts)
        return self._built[self._name]


def _packed(values: np.ndarray) -> bytes:
    """Numbers as byte planes, zstandard."""
    width = values.dtype.itemsize
    planes = values.view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=3).compress(bytes([width]) + np.ascontiguousarray(planes).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    width = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{width}")


def _small(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8")


def _gaps(values: np.ndarray) -> np.ndarray:
    """Ascending numbers as distances from the one before."""
    return np.diff(values, prepend=values[:1] * 0)


def _pairs(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.int64)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", RUN_BYTES):
        for start in range(0, batch.num_rows, RUN_ROWS):
            yield batch.slice(start, RUN_ROWS)


def _runs(docs: DataFrame, key: str, text: str, source: AlignerSource) -> DataFrame:
    """Step 1: a row per run with its documents' columns, its records, and its pairs by part."""
    kind = docs.schema[key].dataType.simpleString()
    part = pa.struct([("radix", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(_sliced(batches)):
            columns, records = source.here().run(batch.column("text").to_pylist())
            pair, doc = records["pair"].astype(np.int64), records["doc"].astype(np.int64)
            first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]][: len(pair)])
            sizes = np.diff(np.r_[first, len(pair)])
            gaps = np.diff(doc, prepend=0)
            gaps[first] = doc[first]
            pair = pair[first]
            bounds = np.searchsorted(pair, np.arange(RADIX + 1) << 26)
            parts = [
                {"radix": r, "pairs": _packed(_small(_gaps(pair[x:y]))), "counts": _packed(_small(sizes[x:y]))}
                for r, (x, y) in enumerate(pairwise(bounds)) if y > x
            ]
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("id"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task | number], pa.int64()), ids,
                    *[pa.array([columns[x]], pa.list_(pa.int64())) for x in _COUNTS],
                    pa.array([columns["groups_sha256"]], pa.list_(pa.string())),
                    *[pa.array([_packed(_small(x))], pa.binary()) for x in (sizes, gaps, records["times"])],
                    pa.array([parts], pa.list_(part)),
                ],
                ["run", "ids", *_COUNTS, "groups_sha256", "sizes", "gaps", "times", "parts"],
            )

    schema = (
        f"run bigint, ids array<{kind}>, " + ", ".join(f"{x} array<bigint>" for x in _COUNTS)
        + ", groups_sha256 array<string>, sizes binary, gaps binary, times binary,"
        " parts array<struct<radix:int,pairs:binary,counts:binary>>"
    )
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(make, schema)


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and summed counts of sorted runs (pairs, counts): a heap has each run's next A id, and
    the blocks of the smallest one are merged."""
    blocks = []
    for pairs, _ in runs:
        sides = pairs >> 16
        starts = np.flatnonzero(np.r_[True, sides[1:] != sides[:-1]][: len(sides)])
        blocks.append((sides[starts].tolist(), np.r_[starts, len(pairs)].tolist()))
    heap = [(sides[0], run, 0) for run, (sides, _) in enumerate(blocks) if sides]
    heapq.heapify(heap)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    while heap:
        side, own = heap[0][0], []
        while heap and heap[0][0] == side:
            _, run, block = heap[0]
            sides, starts = blocks[run]
            own.append((run, starts[block], starts[block + 1]))
            if block + 1 < len(sides):
                heapq.heapreplace(heap, (sides[block + 1], run, block + 1))
            else:
                heapq.heappop(heap)
        if len(own) == 1:
            run, x, y = own[0]
            out.append((runs[run][0][x:y], runs[run][1][x:y]))
            continue
        pairs = np.concatenate([runs[run][0][x:y] for run, x, y in own])
        counts = np.concatenate([runs[run][1][x:y] for run, x, y in own])
        order = np.argsort(pairs, kind="stable")
        pairs = pairs[order]
        first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        out.append((pairs[first], np.add.reduceat(counts[order], first)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _merged(grouped: DataFrame) -> DataFrame:
    """Step 2, one round: rows (radix, run, pairs, counts) from rows with lists of runs."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "first", 1):
            (own,) = batch.to_pylist()
            pairs, counts = merge_runs([(_pairs(x["pairs"]), _unpacked(x["counts"]).astype(np.int64)) for x in own["children"]])
            made = [own["radix"]], [own["run"]], [_packed(_small(_gaps(pairs)))], [_packed(_small(counts))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(made, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                ["radix", "run", "pairs", "counts"],
            )

    one = grouped.withColumn("first", F.col("children")[0]["pairs"])
    return one.mapInArrow(make, "radix int, run bigint, pairs binary, counts binary")


def _largest(top: DataFrame) -> DataFrame:
    """Rows (radix, run, pairs, counts, best): whether a count is its A id's largest."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for pairs, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sides, counts = _pairs(pairs) >> 16, _unpacked(counts)
                first = np.flatnonzero(np.r_[True, sides[1:] != sides[:-1]])
                most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.r_[first, len(sides)]))
                best.append(_packed((counts == most).astype("<u1")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.binary())], [*batch.schema.names, "best"])

    return top.mapInArrow(make, "radix int, run bigint, pairs binary, counts binary, best binary")


def _handed_down(grouped: DataFrame, known: DataFrame) -> DataFrame:
    """Step 3, one round: counts and marks of the runs that merged runs were made of."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "known_pairs", 1):
            (own,) = batch.to_pylist()
            pairs, counts, best = _pairs(own["known_pairs"]), _unpacked(own["known_counts"]), _unpacked(own["best"])
            made: list[list] = [[], [], [], [], []]
            for child in own["children"]:
                at = np.searchsorted(pairs, _pairs(child["pairs"]))
                row = own["radix"], child["run"], child["pairs"], _packed(_small(counts[at])), _packed(best[at])
                for column, value in zip(made, row, strict=True):
                    column.append(value)
            kinds = pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(made, kinds, strict=True)], ["radix", "run", "pairs", "counts", "best"]
            )

    named = known.withColumnsRenamed({"pairs": "known_pairs", "counts": "known_counts"})
    joined = grouped.join(named, ["radix", "run"]).select("radix", "children", "known_pairs", "known_counts", "best")
    return joined.mapInArrow(make, "radix int, run bigint, pairs binary, counts binary, best binary")


def _summed(runs: DataFrame, known: DataFrame, key: str, kind: str) -> DataFrame:
    """Step 3, the end: rows of documents, from runs and what is known of their pairs."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "gaps", 1):
            (own,) = batch.to_pylist()
            n = len(own["ids"])
            n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
            if own["known"]:
                parts = sorted(own["known"], key=lambda x: x["radix"])
                sizes, times = _unpacked(own["sizes"]).astype(np.int64), _unpacked(own["times"]).astype(np.int64)
                gaps = np.cumsum(_unpacked(own["gaps"]), dtype=np.int64)
                first = np.cumsum(sizes) - sizes
                doc = gaps - np.repeat(np.r_[0, gaps][first], sizes)
                counts = np.concatenate([_unpacked(x["counts"]).astype(np.int64) for x in parts])
                best = np.concatenate([_unpacked(x["best"]) for x in parts])
                np.add.at(count_sum, doc, np.repeat(counts, sizes) * times)
                np.add.at(n_best, doc, np.repeat(best, sizes) * times)
            numbers = [pa.array(own[x], pa.int64()) for x in _COUNTS]
            ids = batch.column("ids").flatten()
            yield pa.RecordBatch.from_arrays(
                [ids, *numbers, pa.array(n_best), pa.array(count_sum), pa.array(own["groups_sha256"], pa.string())], names
            )

    names = [key, *_COUNTS, "n_best", "count_sum", "groups_sha256"]
    schema = ", ".join([f"`{key}` {kind}", *[f"{x} bigint" for x in names[1:-1]], "groups_sha256 string"])
    lists = known.groupBy("run").agg(F.collect_list(F.struct("radix", "counts", "best")).alias("known"))
    return runs.drop("parts").join(lists, "run", "left").mapInArrow(make, schema)


def aligned(
    docs: DataFrame, a_file: str, pattern: str, b_file: str, key: str = "doc_id", text: str = "text", fan: int = FAN
) -> DataFrame:
    """Rows (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one per row of ``docs``."""
    kind = docs.schema[key].dataType.simpleString()
    runs = _stored(_runs(docs, key, text, AlignerSource(a_file, pattern, b_file)), "runs")
    parts = runs.select("run", F.explode("parts").alias("part")).select("part.radix", "run", "part.pairs", "part.counts")
    # Runs are merged in rounds. The driver gets one number: how many runs there are.
    left, now, rounds = runs.count(), parts, []
    while not rounds or left > 1:
        left = max(1, -(-left // fan))
        group = F.pmod(F.xxhash64("run"), F.lit(left))
        lists = now.groupBy("radix", group.alias("group")).agg(F.collect_list(F.struct("run", "pairs", "counts")).alias("children"))
        rounds.append(_stored(lists.withColumnRenamed("group", "run"), "merging"))
        _dropped(now)
        now = _stored(_merged(rounds[-1]), "merged")
    known = _stored(_largest(now), "known")
    _dropped(now)
    for grouped in reversed(rounds):
        above, known = known, _stored(_handed_down(grouped, known), "known")
        _dropped(above)
        _dropped(grouped)
    return _summed(runs, known.select("run", "radix", "counts", "best"), key, kind)
