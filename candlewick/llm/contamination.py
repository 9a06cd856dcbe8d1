"""Benchmark leaks, also re-parameterised ones: templates of word windows and consistent slots.

Texts become templates: numbers (also in words), units behind numbers, and names (capitalised words)
turn into typed placeholders. A capitalised word that begins a sentence may be a name or not: windows
with such words are taken both ways. Every run of ``WINDOW`` template words of every benchmark
item is looked up in every document by hash, and so are its words as they stand: verbatim windows
always count, and templates with fewer than ``LEAST_PLAIN`` other words are left out. Windows that follow each other in item and document form a run. In a run,
equal slots of the item must hold equal values in the document and different ones different values;
else the run is cut there. A document leaks an item if a run covers ``LEAST_WORDS`` words of it, or
the whole item if that is shorter.

Documents are scanned once for each block of ``BLOCK_WINDOWS`` distinct benchmark windows: a block of
hashes has a fixed size and is broadcast, so a benchmark of any size is handled and no document text
is shuffled. Only hits are; a run of hits stays with its document.

Null and empty texts leak nothing; items with fewer than ``LEAST_PLAIN`` other words leak by verbatim copies.
Repeated rows get equal results (documents are told apart by id and text); items of one id are one. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.graph import _stored, _unused
from candlewick.llm.text import LongGrams, pieces, split_words

WINDOW = 8
LEAST_PLAIN = 5
LEAST_WORDS = 13

#: Distinct windows of the benchmark in one pass over the documents (8 bytes each in the broadcast).
BLOCK_WINDOWS = 2_000_000

NUMBER, NAME, UNIT = b"<number>", b"<name>", b"<unit>"

# Units of measure that may follow a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml cl l liter liters litre litres "
    "gallon gallons s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months "
    "year years mph kmh percent % $ € £ usd eur dollar dollars cent cents euro euros".split()
)

# Number words. They are numbers wherever they stand.
NUMBER_WORDS = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen".split()
)

_EDGE = re.compile(r"^[^\w%$€£]+|[^\w%$€£]+$")
_NUMBER = re.compile(r"[$€£]?[+-]?[0-9][0-9.,:/]*(%|[a-z]{1,3})?")
_SENTENCE_END = re.compile(r"[.!?:][\"')\]]*$")

#: Distinct words whose kinds a worker keeps (speed only).
CACHED_WORDS = 240_000

_IS_NUMBER, _IS_UNIT, _IS_CAPITAL, _ENDS, _EMPTY = 1, 2, 4, 8, 16


class _Kinds(dict):
    """What can be said of a word by itself: its number here; by number its plain form, hash and kind."""

    def __init__(self) -> None:
        super().__init__()
        self.plain: list[str] = []
        self.hashes: list[int] = []
        self.kinds: list[int] = []

    def __missing__(self, raw: bytes) -> int:
        text = raw.decode()
        word = _EDGE.sub("", text)
        low = word.lower()
        kind = _ENDS if _SENTENCE_END.search(text) else 0
        if not word:
            kind |= _EMPTY
        elif _NUMBER.fullmatch(low) or all(x in NUMBER_WORDS for x in low.split("-")):
            kind |= _IS_NUMBER
        else:
            kind |= _IS_UNIT if low in UNITS else 0
            kind |= _IS_CAPITAL if word[0].isupper() and word != "I" else 0
        number = self[raw] = len(self.plain)
        self.plain.append(low)
        self.hashes.append(xxhash.xxh3_64_intdigest(low.encode()))
        self.kinds.append(kind)
        return number

    def first(self, count: int) -> _Kinds:
        """Only the words that were met first, which are the frequent ones."""
        out = _Kinds()
        out.update(islice(self.items(), count))
        out.plain, out.hashes, out.kinds = self.plain[:count], self.hashes[:count], self.kinds[:count]
        return out


_KNOWN = _Kinds()


class Templates:
    """The templates of several texts, one behind the other: word hashes with placeholders, and values."""

    def __init__(self, texts: list[str | None]) -> None:
        global _KNOWN
        if len(_KNOWN) > CACHED_WORDS:
            _KNOWN = _KNOWN.first(CACHED_WORDS // 2)
        known = _KNOWN
        split = [split_words(text) for text in texts]
        counts = np.array([len(words) for words in split], np.int64)
        which = np.fromiter((i for words in split for i in map(known.__getitem__, words)), np.int64, int(counts.sum()))
        kinds = np.array(known.kinds, np.uint8)[which]
        of = np.repeat(np.arange(len(split)), counts)
        begins = np.r_[True, (kinds[:-1] & _ENDS) > 0] if len(kinds) else np.zeros(0, bool)
        begins[np.r_[True, of[1:] != of[:-1]] if len(of) else slice(0)] = True
        there = (kinds & _EMPTY) == 0
        kinds, of, begins, which = kinds[there], of[there], begins[there], which[there]
        number = (kinds & _IS_NUMBER) > 0
        counted = np.zeros(len(kinds), bool)
        counted[1:] = number[:-1] & (of[1:] == of[:-1])
        unit = ((kinds & _IS_UNIT) > 0) & counted
        capital = ((kinds & _IS_CAPITAL) > 0) & ~unit
        name = capital & ~begins
        self.literal = np.array(known.hashes, np.uint64)[which]
        self.text_of, self._which, self._plain = of, which, known.plain
        # A capitalised word that begins a sentence is a word in the first template and a name in the second.
        self._templates = []
        for names in (name, capital):
            hashes = self.literal.copy()
            for chosen, mark in ((number, NUMBER), (unit, UNIT), (names, NAME)):
                hashes[chosen] = np.uint64(xxhash.xxh3_64_intdigest(mark))
            self._templates.append((hashes, np.cumsum(np.r_[0, ~(number | unit | names)])))
        self.counts = np.bincount(of, minlength=len(split))
        self.first = np.cumsum(self.counts) - self.counts

    def windows(self, size: int, least_plain: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all runs of ``size`` words of one text: as both templates if they have enough
        plain words, and as they stand in any case (once where they are the same)."""
        starts = np.arange(max(0, len(self.literal) - size + 1))
        starts = starts[self.text_of[starts] == self.text_of[starts + size - 1]]
        (first, plain), (second, fewer) = (
            (hashes, count[starts + size] - count[starts]) for hashes, count in self._templates
        )
        listed = (
            (first, starts[plain >= least_plain]),
            (second, starts[(fewer >= least_plain) & (fewer < plain)]),
            (self.literal, starts[(plain < size) | (plain < least_plain)]),
        )
        hashes = [LongGrams(words).between(at, at + size) for words, at in listed]
        return np.concatenate([at for _, at in listed]), np.concatenate(hashes)

    def values(self, start: int, size: int) -> list[str]:
        return [self._plain[i] for i in self._which[start : start + size].tolist()]


def benchmark_windows(
    items: DataFrame, key: str, text: str, window: int = WINDOW, least_plain: int = LEAST_PLAIN
) -> DataFrame:
    """Rows (item, copy, hash, at, size, n_words, values): the windows of every item.

    ``values`` are the words under the window; ``copy`` tells items of equal id apart.
    """
    kind = items.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = Templates(batch.column("text").to_pylist())
            # An item of fewer words than a window is one window.
            for size in sorted({min(window, n) for n in texts.counts.tolist()} - {0}):
                starts, hashes = texts.windows(size, least_plain)
                of = texts.text_of[starts]
                mine = np.minimum(window, texts.counts[of]) == size
                starts, hashes, of = starts[mine], hashes[mine], of[mine]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item").take(pa.array(of)), batch.column("copy").take(pa.array(of)),
                        pa.array(hashes.view(np.int64)), pa.array(starts - texts.first[of]),
                        pa.array(np.full(len(of), size)), pa.array(texts.counts[of].astype(np.int64)),
                        pa.array([texts.values(s, size) for s in starts.tolist()], pa.list_(pa.string())),
                    ],
                    ["item", "copy", "hash", "at", "size", "n_words", "values"],
                )

    schema = f"item {kind}, copy bigint, hash bigint, at bigint, size bigint, n_words bigint, values array<string>"
    named = items.select(F.col(key).alias("item"), F.xxhash64(F.col(text)).alias("copy"), F.col(text).alias("text"))
    return named.mapInArrow(rows, schema)


def _hits(docs: DataFrame, sizes: list[int], known: np.ndarray, least_plain: int) -> DataFrame:
    """Rows (id, mark, hash, at, values) of document windows whose hash is among the known ones, stored.

    The broadcast of the known hashes is gone afterwards."""
    spark, kind = docs.sparkSession, docs.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(np.sort(known))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in pieces(batches, "text"):
            texts = Templates(batch.column("text").to_pylist())
            for size in sizes:
                starts, hashes = texts.windows(size, least_plain)
                place = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                hit = wanted[place] == hashes
                starts, hashes = starts[hit], hashes[hit]
                of = texts.text_of[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(of)), batch.column("mark").take(pa.array(of)),
                        pa.array(hashes.view(np.int64)), pa.array(starts - texts.first[of]),
                        pa.array([texts.values(s, size) for s in starts.tolist()], pa.list_(pa.string())),
                    ],
                    ["id", "mark", "hash", "at", "values"],
                )

    found = _stored(docs.mapInArrow(rows, f"id {kind}, mark bigint, hash bigint, at bigint, values array<string>"), "hits")
    shared.unpersist()
    return found


def _longest(windows: list[dict]) -> tuple[int, int]:
    """Words of the longest run with consistent slots, and the words of its item.

    Windows of one distance follow each other. A slot maps the item's word to the document's; a word
    that maps to another value than before, or a value that another word has, ends the run. A plain
    word is the same on both sides by its hash.
    """
    by_distance = defaultdict(dict)
    for w in windows:
        by_distance[w["doc_at"] - w["item_at"]][w["item_at"]] = w
    best, n_words = 0, 0
    for placed in by_distance.values():
        there: dict[str, str] = {}
        back: dict[str, str] = {}
        begin = last = None
        for at in sorted(placed):
            w = placed[at]
            pairs = list(zip(w["item_values"], w["doc_values"], strict=True))
            follows = last is not None and at <= last + w["size"]
            if not follows or not _agree(pairs, there, back):
                there, back, begin = {}, {}, at
                if not _agree(pairs, there, back):
                    there, back, last = {}, {}, None
                    continue
            last = at
            if at + w["size"] - begin > best:
                best, n_words = at + w["size"] - begin, w["n_words"]
    return best, n_words


def _agree(pairs: list[tuple[str, str]], there: dict[str, str], back: dict[str, str]) -> bool:
    """Takes the pairs into both maps; False at the first contradiction."""
    return all(there.setdefault(a, b) == b and back.setdefault(b, a) == a for a, b in pairs)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    least_plain: int = LEAST_PLAIN,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Rows (id, mark, item, n_words): each document and item that it leaks, with the words of the run."""
    known = _stored(benchmark_windows(items, item_key, item_text, window, least_plain), "benchmark")
    keyed = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))
    distinct = known.select("hash", "size").distinct()
    total = distinct.count()
    blocks = max(1, -(-total // BLOCK_WINDOWS))
    hits = None
    for block in range(blocks):
        # Hashes spread evenly, so a block holds about total / blocks of them.
        part = distinct.where(F.pmod("hash", F.lit(blocks)) == block).toPandas()
        if len(part) == 0:
            continue
        sizes = sorted({int(x) for x in part["size"]})
        one = _hits(keyed, sizes, part["hash"].to_numpy(np.int64).view(np.uint64), least_plain)
        hits = one if hits is None else hits.unionByName(one)
    if hits is None:
        hits = _hits(keyed.limit(0), [window], np.zeros(1, np.uint64), least_plain)
    met = hits.withColumnsRenamed({"at": "doc_at", "values": "doc_values"}).join(
        known.withColumnsRenamed({"at": "item_at", "values": "item_values"}), "hash"
    )
    met = met.where(F.size("doc_values") == F.col("size"))
    kept = F.struct("doc_at", "item_at", "size", "n_words", "doc_values", "item_values")
    # Windows of a run have one distance between document and item: no group has more than an item's windows,
    # however often document and item repeat them.
    distance = (F.col("doc_at") - F.col("item_at")).alias("distance")
    runs = met.groupBy("id", "mark", "item", "copy", distance).agg(F.collect_set(kept).alias("windows"))

    @F.arrow_udf("struct<covered:bigint,n_words:bigint>")
    def longest(groups: pa.Array) -> pa.Array:
        found = [_longest(g) for g in groups.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], ["covered", "n_words"]
        )

    judged = runs.select("id", "mark", "item", longest("windows").alias("run"))
    enough = F.col("run.covered") >= F.least(F.lit(least_words), F.col("run.n_words"))
    found = judged.where(enough & (F.col("run.covered") > 0))
    return found.groupBy("id", "mark", "item").agg(F.max("run.covered").alias("n_words"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **settings: object) -> DataFrame:
    """All rows and columns of the documents that leak no item."""
    i, m = _unused(docs.columns, "_id", "_mark")
    found = leaks(docs, items, key, text, **settings).select(F.col("id").alias(i), F.col("mark").alias(m)).distinct()
    same = F.col(f"`{key}`").eqNullSafe(F.col(i)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(m))
    return docs.join(found, same, "left_anti")


def with_leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", into: str = "leaked", **settings: object
) -> DataFrame:
    """All rows and columns, plus ``into``: an array of (item, n_words) by item, empty for clean documents.

    A column of that name is replaced."""
    i, m, listed = _unused(docs.columns, "_id", "_mark", "_leaked")
    found = leaks(docs, items, key, text, **settings).groupBy(F.col("id").alias(i), F.col("mark").alias(m)).agg(
        F.array_sort(F.collect_list(F.struct("item", "n_words"))).alias(listed)
    )
    same = F.col(f"`{key}`").eqNullSafe(F.col(i)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(m))
    kind = found.schema[listed].dataType.simpleString()
    joined = docs.join(found, same, "left")
    return joined.withColumn(into, F.coalesce(listed, F.expr(f"cast(array() as {kind})"))).drop(i, m, listed)
