"""Substring duplicates: windows of words counted over the corpus by anchors and contexts.

The reference is every text. It is indexed by anchors: of the runs of ``ANCHOR`` words in a window of
``window`` words, the one with the smallest hash. Equal windows choose the same anchor at the same
place, so a group of one anchor holds every text that could match a window of it. No document is
parsed against a reference block: counts of contexts and windows decide which words go.

1. Anchors of all texts; those that occur once in the corpus cannot be in a factor and are dropped.
2. Long factors: all windows of an anchor form its context. Occurrences with equal contexts match in
   every window; they are counted with a combine before the shuffle and refer to the first of them.
3. Factor boundaries: where contexts of one anchor differ, matches end inside them. One occurrence of
   each such context is looked up window by window.
4. Every word under a match is a duplicate. Matches are also chained greedily into factors (same
   referenced document, same distance), which are listed but decide nothing.

The result is exact up to hash collisions (128 bits: anchor and context or window). Documents are
identified by id and a hash of the text; rows that repeat both are occurrences like any other, so
both lose the repeated words. Null texts have no words, texts with fewer than ``window`` words no
windows; an empty table gives an empty result. Null ids and other columns are kept apart from the
computation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.graph import _dropped, _stored
from candlewick.llm.text import LongGrams, gram_hashes, pieces, split_words, word_hashes

WINDOW = 35

#: Words of an anchor.
ANCHOR = 8

_LOW = (1 << 32) - 1


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value in each run of ``width`` values, the last one on ties."""
    best, place, size = values, np.arange(len(values)), 1

    def merge(shift: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        later = best[shift : shift + count] <= best[:count]
        return (
            np.where(later, best[shift : shift + count], best[:count]),
            np.where(later, place[shift : shift + count], place[:count]),
        )

    while size * 2 <= width:
        best, place = merge(size, len(best) - size)
        size *= 2
    if size < width:
        best, place = merge(width - size, len(values) - width + 1)
    return place


def anchors_of(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Per anchor of a text: its hash, the hash of its context, its first window, the number of windows."""
    if len(hashes) < window:
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    grams = gram_hashes(hashes, anchor)
    chosen = _smallest(grams, window - anchor + 1)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    counts = np.diff(np.r_[first, len(chosen)])
    at = chosen[first]
    context = LongGrams(hashes).between(first, first + counts - 1 + window)
    context ^= (at - first).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return grams[at], context, first, counts


def _place(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of windows and first word (32 bits) in one number."""
    return (counts << 32) | first


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("mark"))


def _anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found, repeat, places = [], [], []
            for text in batch.column("text").to_pylist():
                grams, context, first, counts = anchors_of(word_hashes(split_words(text)), window, anchor)
                found.append((grams, context))
                repeat.append(len(grams))
                places.append(_place(first, counts))
            of = pa.array(np.repeat(np.arange(len(repeat)), repeat))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(of), batch.column("mark").take(of),
                    pa.array(np.concatenate([x for x, _ in found]).view(np.int64)),
                    pa.array(np.concatenate([x for _, x in found]).view(np.int64)),
                    pa.array(np.concatenate(places).astype(np.int64)),
                ],
                ["id", "mark", "anchor", "context", "place"],
            )

    return docs.mapInArrow(rows, f"id {kind}, mark bigint, anchor bigint, context bigint, place bigint")


def _windows(listed: DataFrame, window: int) -> DataFrame:
    """Rows (text, mark, listed: struct<anchor, place, n>) as one row for each listed window."""
    kind = listed.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out: list[list[np.ndarray]] = [[], [], [], []]
            repeat = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                items = batch.column("listed")[i].values
                place = items.field("place").to_numpy()
                counts, first = place >> 32, place & _LOW
                total = int(counts.sum())
                within = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = np.repeat(first, counts) + within
                grams = LongGrams(word_hashes(split_words(text)))
                out[0].append(np.repeat(items.field("anchor").to_numpy(), counts))
                out[1].append(grams.between(starts, starts + window).view(np.int64))
                out[2].append(_place(starts, np.int64(1)))
                out[3].append(np.repeat(items.field("n").to_numpy(), counts))
                repeat.append(total)
            of = pa.array(np.repeat(np.arange(len(repeat)), repeat))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(of), batch.column("mark").take(of),
                    *(pa.array(np.concatenate(x).astype(np.int64)) for x in out),
                ],
                ["id", "mark", "anchor", "words", "place", "n"],
            )

    return listed.select("id", "text", "mark", "listed").mapInArrow(
        rows, f"id {kind}, mark bigint, anchor bigint, words bigint, place bigint, n bigint"
    )


def _referred(occurrences: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Each occurrence with the group's first one, or the last one for the first itself."""
    here = F.struct(F.col("id"), F.col("mark"), F.col("place"))
    reference = F.when(F.col("first").eqNullSafe(here), F.col("last")).otherwise(F.col("first"))
    return occurrences.join(groups.select(*keys, "first", "last"), keys).select("id", "mark", "place", reference.alias("reference"))


def matches(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, mark, place, reference): runs of duplicate windows, each with another place of the same words."""
    if not anchor < window < 128 + anchor:
        raise ValueError("an anchor is shorter than a window, a window shorter than 128 words more")
    keyed = _keyed(docs, key, text)
    # Stored, so that texts are hashed once for the counts and the join.
    found = _stored(_anchors(keyed, window, anchor), "anchors")
    repeated = found.groupBy("anchor").count().where("count > 1").select("anchor")
    shared = _stored(found.join(repeated, "anchor"), "shared")
    _dropped(found)

    here = F.struct(F.col("id"), F.col("mark"), F.col("place"))
    contexts = shared.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(here).alias("first"), F.max(here).alias("last")
    )
    long = _referred(shared, contexts.where("n > 1"), ["anchor", "context"])

    mixed = contexts.groupBy("anchor").count().where("count > 1").select("anchor")
    edges = contexts.join(mixed, "anchor").select(
        F.col("first.id").alias("id"), F.col("first.mark").alias("mark"),
        F.struct("anchor", F.col("first.place").alias("place"), "n").alias("listed"),
    )
    listed = _with_text(keyed, edges.groupBy("id", "mark").agg(F.collect_list("listed").alias("listed")), "inner")
    looked_up = _windows(listed, window)
    equal = looked_up.groupBy("anchor", "words").agg(
        F.count(F.lit(1)).alias("groups"), F.min(here).alias("first"), F.max(here).alias("last")
    )
    edge = _referred(looked_up.where("n = 1"), equal.where("groups > 1"), ["anchor", "words"])
    return long.unionByName(edge)


def _with_text(keyed: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    other = lists.withColumnsRenamed({"id": "_id", "mark": "_mark"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    return keyed.join(other, same, how).drop("_id", "_mark")


def _chain(place: np.ndarray, others: list, other_place: np.ndarray, window: int) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """Greedy factors of one document and its duplicate runs as starts and ends in words."""
    first, counts, target = place & _LOW, place >> 32, other_place & _LOW
    order = np.argsort(first, kind="stable")
    factors: list[dict] = []
    for i in order.tolist():
        start, end, begin = int(first[i]), int(first[i] + counts[i] - 1 + window), int(target[i])
        last = factors[-1] if factors else None
        if (
            last and last["document"] == others[i] and last["position"] - last["start"] == begin - start
            and start <= last["start"] + last["length"] - window + 1
        ):
            last["length"] = max(last["length"], end - last["start"])
        else:
            factors.append({"start": start, "length": end - start, "document": others[i], "position": begin})
    return factors, first[order], (first + counts - 1 + window)[order]


def remove_duplicates(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: its id, n_words, n_removed, the kept words joined by single spaces, and its factors.

    A factor is (start, length) in words and the (document, position) that it was parsed from.
    """
    found = matches(docs, window, anchor, key, text).select(
        "id", "mark", F.struct("place", "reference").alias("match")
    )
    lists = found.groupBy("id", "mark").agg(F.collect_list("match").alias("matches"))
    joined = _with_text(_keyed(docs, key, text), lists, "left").select("id", "text", "matches")
    kind = joined.schema["id"].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            counts, removed, kept, factors = [], [], [], []
            for i, body in enumerate(batch.column("text").to_pylist()):
                words, chained = split_words(body), []
                items = batch.column("matches")[i].values
                drop = np.zeros(len(words), bool)
                if items is not None:
                    reference = items.field("reference")
                    chained, starts, ends = _chain(
                        items.field("place").to_numpy(), reference.field("id").to_pylist(),
                        reference.field("place").to_numpy(), window,
                    )
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, ends, -1)
                    drop = np.cumsum(edges)[:-1] > 0
                counts.append(len(words))
                removed.append(int(drop.sum()))
                kept.append(b" ".join(w for w, d in zip(words, drop.tolist(), strict=True) if not d))
                factors.append(chained)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()), pa.array(factors, factor_type(batch.column("id").type)),
                ],
                ["id", "n_words", "n_removed", "kept", "factors"],
            )

    factor = f"array<struct<start:bigint,length:bigint,document:{kind},position:bigint>>"
    parsed = joined.mapInArrow(parse, f"id {kind}, n_words bigint, n_removed bigint, kept string, factors {factor}")
    return parsed.withColumnRenamed("id", key)


def factor_type(kind: pa.DataType) -> pa.DataType:
    return pa.list_(
        pa.struct([("start", pa.int64()), ("length", pa.int64()), ("document", kind), ("position", pa.int64())])
    )
