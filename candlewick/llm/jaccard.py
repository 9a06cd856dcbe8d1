"""Join of documents by the Jaccard similarity of their word n-grams, and the groups that it links.

The incidence matrix has a row for each distinct set of n-grams (documents of equal sets are one row)
and a column for each n-gram. Its product with itself is never formed: a block (a column's rows) gives
candidate pairs where bounds derived from the set sizes leave a pair possible, and those are verified
on the whole sets. With t the least similarity and s a set's size:

1. Two linked sets share the fewer of ``depth(s)`` columns among the ``s - ceil(t * s) + depth(s)``
   smallest of each, in any order common to all. In hash order, rows with too few columns that another
   row has cannot link and go; most rows go here.
2. Of the rest, whole sets are counted: ``ceil(t * s)`` columns must occur in another row. Columns are
   then ordered by the number of rows, rare ones first, so that a passage that many documents hold lies
   behind the part of a set that forms blocks.
3. In each block, rows meet the block's leader first; the overlap of the whole sets decides. Rows that
   are connected by then need no comparison among themselves. Leaders of other orders follow, and at
   last all pairs of a block that are still in different components and that the bound of the columns
   before the shared one allows: no link that could connect something is left out, and a group of
   thousands of near copies costs few comparisons.

Sets are told apart by 64-bit hashes of their n-grams, which are 64-bit hashes as well. Texts with
fewer than n words have their whole word sequence as the one n-gram; null and word-free texts have an
empty set and no links. Rows that repeat id and text are equal documents. Null ids never name a
component that has other ids. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.graph import _dropped, _stored, _unused, components
from candlewick.llm.text import gram_hashes, pieces, word_hashes

WORDS = 5
PERCENT = 80

#: One more column in this many is shared by linked rows in step 1.
DEPTH = 12


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of the words, A-Z in lower case."""
    words = text.encode().lower().split() if text else []
    return np.unique(gram_hashes(word_hashes(words), min(n, len(words)))) if words else np.zeros(0, np.uint64)


def _least_overlap(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """ceil(t * s): what a set of this size shares with any partner at least."""
    return (percent * size + 99) // 100


def _depth(size: int) -> int:
    return max(1, size // DEPTH)


def _rows(docs: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """Rows (id, mark, row, size, first): each document's set by hash and size, and its smallest columns."""
    kind = docs.schema[key].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            names, sizes, firsts = [], [], []
            for body in batch.column("text").to_pylist():
                columns = shingles(body, n)
                size = len(columns)
                names.append(xxhash.xxh3_64_intdigest(columns.tobytes()) - (1 << 63))
                sizes.append(size)
                firsts.append(columns[: size - _least_overlap(size, percent) + _depth(size)].tobytes() if size else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("mark"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(firsts, pa.binary()),
                ],
                ["id", "mark", "row", "size", "first"],
            )

    return _keyed(docs, key, text).mapInArrow(make, f"id {kind}, mark bigint, row bigint, size bigint, first binary")


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))


def _entries(rows: DataFrame, packed: str) -> DataFrame:
    """The matrix's entries (column, row), from rows with packed columns."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, packed):
            columns = [np.frombuffer(x, np.int64) for x in batch.column(packed).to_pylist()]
            counts = np.array([len(x) for x in columns])
            rows_ = np.repeat(batch.column("row").to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(columns)), pa.array(rows_)], ["column", "row"])

    return rows.select("row", packed).mapInArrow(make, "column bigint, row bigint")


def _possible(rows: DataFrame, percent: int) -> DataFrame:
    """Step 1: rows (row, size, id, mark) that may link, with one document of each."""
    entries = _entries(rows.where("size > 0"), "first")
    # A window, not a join with an aggregate: the entries are shuffled once.
    column = Window.partitionBy("column")
    ends = entries.withColumns({"low": F.min("row").over(column), "high": F.max("row").over(column)})
    counts = ends.where("low <> high").groupBy("row").agg(F.count(F.lit(1)).alias("shared"))
    # Every document of a row has the same entries: the counts hold all of them.
    classes = rows.where("size > 0").groupBy("row", "size").agg(
        F.count(F.lit(1)).alias("documents"), F.min(F.struct("id", "mark")).alias("document")
    )
    least = F.floor((F.col("size") * percent + 99) / 100)
    depth = F.greatest(F.lit(1), F.floor(least / DEPTH))
    return classes.join(counts, "row").where(F.col("shared") >= F.col("documents") * depth).select(
        "row", "size", F.col("document.id").alias("_id"), F.col("document.mark").alias("_mark")
    )


def _chosen(docs: DataFrame, possible: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (row, size, text): the documents of the rows that may link."""
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    return _keyed(docs, key, text).join(possible, same).select("row", "size", "text")


def _sets(chosen: DataFrame, n: int) -> DataFrame:
    """Rows (row, size, columns): the whole sets of the rows that may link."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            packed = [shingles(x, n).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("size"), pa.array(packed, pa.binary())], ["row", "size", "columns"]
            )

    return chosen.mapInArrow(make, "row bigint, size bigint, columns binary").dropDuplicates(["row"])


def _blocks(sets: DataFrame, percent: int) -> DataFrame:
    """Step 2: rows (column, row, size, at) of the rarest columns of each set that can still link.

    ``at`` is the column's place in the set's order: columns that no other row has come first.
    """
    counted = _entries(sets, "columns").withColumn("rows", F.count(F.lit(1)).over(Window.partitionBy("column"))).where("rows > 1")
    shared = counted.groupBy("row").agg(F.collect_list(F.struct("rows", "column")).alias("shared"))
    least = F.floor((F.col("size") * percent + 99) / 100)
    alone = F.col("size") - F.size("shared")
    fit = shared.join(sets.select("row", "size"), "row").where(F.size("shared") >= least)
    taken = F.slice(F.sort_array("shared"), F.lit(1), (F.col("size") - least + 1 - alone).cast("int"))
    blocks = fit.select("row", "size", alone.alias("alone"), F.posexplode(taken).alias("place", "entry"))
    return blocks.select(F.col("entry.column").alias("column"), "row", "size", (F.col("alone") + F.col("place")).alias("at"))


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with sizes and the number of common columns of the whole sets.

    Each candidate pair is one intersection of two sorted sets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "a_columns"):
            common = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                for x, y in zip(batch.column("a_columns").to_pylist(), batch.column("b_columns").to_pylist(), strict=True)
            ]
            kept = [batch.column(name) for name in ("a", "b", "a_size", "b_size")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(common, pa.int64())], ["a", "b", "a_size", "b_size", "common"])

    of = lambda side: sets.select(*[F.col(x).alias(y) for x, y in (("row", side), ("size", f"{side}_size"), ("columns", f"{side}_columns"))])
    joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "a_size", "b_size", "a_columns", "b_columns")
    return joined.mapInArrow(count, "a bigint, b bigint, a_size bigint, b_size bigint, common bigint")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    union = F.col("a_size") + F.col("b_size") - F.col("common")
    return _overlaps(pairs, sets).where(F.col("common") * 100 >= union * percent).select("a", "b")


def _may_link(percent: int) -> Column:
    """False where two rows that meet in a block cannot link.

    Seen from the first column that they share, what lies before it in either set is not shared. So
    a linked pair has a block with ``overlap <= min(size - at, b_size - b_at)``, and other blocks may
    drop it. Smaller sets than ``t`` times the larger one are refused by the same bound.
    """
    most = F.least(F.col("size") - F.col("at"), F.col("b_size") - F.col("b_at"))
    return most * (100 + percent) >= (F.col("size") + F.col("b_size")) * percent


def _connected(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Step 3: rows (node, component)."""
    links = _stored(blocks.limit(0).select(F.col("row").alias("a"), F.col("row").alias("b")), "links")
    groups = links.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def labelled() -> DataFrame:
        known = groups.withColumnRenamed("node", "row")
        rows = blocks.join(known, "row", "left")
        return _stored(rows.select("column", "row", "size", "at", F.coalesce("component", "row").alias("component")), "labelled")

    def more(pairs: DataFrame) -> None:
        nonlocal links, groups
        new = _stored(pairs.distinct(), "pairs")
        if not new.isEmpty():
            links, old = _stored(links.union(_links(new, sets, percent)), "links"), links
            groups = components(links)
            _dropped(old)
        _dropped(new)

    apart = F.col("component") != F.col("other")
    # The first leader has the fewest columns of its own: of near copies, the one closest to the source.
    for order in (F.struct("at", "row"), F.struct("row"), F.struct(F.xxhash64("row"))):
        now = labelled()
        leader = F.struct(
            order.alias("order"), F.col("row").alias("b"), F.col("size").alias("b_size"), F.col("at").alias("b_at"),
            F.col("component").alias("other"),
        )
        leaders = now.groupBy("column").agg(F.min(leader).alias("leader")).select("column", "leader.*")
        met = now.join(leaders, "column").where(apart & _may_link(percent))
        more(met.select(F.col("row").alias("a"), "b"))
        _dropped(now)
    now = labelled()
    other = now.select("column", *[F.col(x).alias(y) for x, y in (("row", "b"), ("size", "b_size"), ("at", "b_at"), ("component", "other"))])
    rest = now.withColumnRenamed("row", "a").join(other, "column").where((F.col("a") < F.col("b")) & apart & _may_link(percent))
    more(rest.select("a", "b"))
    _dropped(now)
    return groups


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Rows (id, mark, n_shingles, component_id), one per document; ``mark`` is a hash of the text.

    The component is the smallest id reachable by links of ``percent`` similarity at least.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent is 50 to 100")
    rows = _stored(_rows(docs, key, text, n, percent), "rows")
    possible = _stored(_possible(rows, percent), "possible")
    names = _stored(rows.select("id", "mark", "row", "size"), "names")
    _dropped(rows)
    # Stored first: the shuffle of all texts is over when that of the sets begins.
    chosen = _stored(_chosen(docs, possible, key, text), "chosen")
    _dropped(possible)
    sets = _stored(_sets(chosen, n), "sets")
    _dropped(chosen)
    blocks = _stored(_blocks(sets, percent), "blocks")
    linked = _connected(blocks, sets, percent)
    for stored in (sets, blocks):
        _dropped(stored)
    named = names.join(linked.withColumnRenamed("node", "row"), "row", "left").select(
        "id", "mark", "size", F.coalesce("component", "row").alias("component")
    )
    least = named.where("size > 0").groupBy("component").agg(F.min("id").alias("component_id"))
    joined = named.join(least, "component", "left")
    return joined.select(
        "id", "mark", F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def keep_one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """All columns of the documents that name their component, and of those with empty sets. Rows that
    repeat id and text are one document: they stay or go together."""
    groups = similar_groups(docs, key, text, n, percent)
    first = groups.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("component_id").agg(F.min("mark").alias("_mark"))
    chosen = groups.join(first.withColumnRenamed("component_id", "_id"), F.col("id").eqNullSafe(F.col("_id")), "left")
    chosen = chosen.where((F.col("n_shingles") == 0) | (F.col("id").eqNullSafe(F.col("component_id")) & (F.col("mark") == F.col("_mark"))))
    i, m = _unused(docs.columns, "_id", "_mark")
    chosen = chosen.select(F.col("id").alias(i), F.col("mark").alias(m)).distinct()
    same = F.col(f"`{key}`").eqNullSafe(F.col(i)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(m))
    return docs.join(chosen, same, "left_semi")
