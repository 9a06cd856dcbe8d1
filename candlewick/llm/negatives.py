"""Hard negatives of anchors by inner product, from candidate lists that a cluster of anchors shares.

A row's components become integers, ``floor(256 * x)``; a score is the integer inner product of two rows.
An anchor's positives are its ``positives`` best other rows of its label. Its hard negatives, for each
positive, are the ``negatives`` best rows of other labels whose score is between ``low`` and ``high`` percent
of the positive's.

Anchors are clustered by direction. In every block of candidates a cluster has one list, sorted once by an
upper bound that holds for all its members: with ``t`` the angle between candidate and cluster centre and
``r`` the largest angle between the centre and a member, a member ``a`` scores at most
``|a| * |candidate| * cos(max(0, t - r))``. Members walk that list together, a slice at a time, and a member
leaves when the next bound proves that nothing behind it can enter its result: below the worst score of a
full result, or below the window of scores that its positives allow. So results are exact. One walk finds the
positives, a second one the negatives, and the best of all blocks are the best of all rows.

Blocks hold ``BLOCK_ROWS`` candidates and groups ``GROUP_ROWS`` anchors on average, whatever the data; a task
has one of each. A cluster with more anchors than a group has several groups. Centres are fitted on the driver
to ``SAMPLE`` anchors at most; they decide how good the bounds are, never the result.

Rows with a null label, a null vector, or a null or non-finite component take no part. Rows that repeat id,
label and vector are one row. A null id is no anchor and comes last among equal scores; equal ids with other
vectors are rows of their own. Shorter vectors count as filled up with zeros, empty ones score 0. Scores end at
2**56 on either side. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90

BLOCK_ROWS, GROUP_ROWS = 4096, 4096

#: Anchors that a cluster has on average, the most clusters, and the most anchors that centres are fitted to.
CLUSTER_ROWS, MOST_CLUSTERS, SAMPLE = 64, 256, 8192

#: Candidates of a list that are scored at once.
SLICE = 256

_EXACT = 2.0**53
_MOST = 1 << 56


def usable_rows(vectors: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """Distinct rows (id, label, vector) that take part."""
    numbers = F.col(vector).cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), numbers.alias("vector"))
    return rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite).distinct()


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Integer components, as doubles."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.floor(256 * out)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles as long as every partial sum is an exact integer, else in Python's integers."""
    if a.size == 0 or b.size == 0 or np.abs(a).max() * np.abs(b).max() * a.shape[1] < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object)
    return np.clip(whole(a) @ whole(b).T, -_MOST, _MOST).astype(np.int64)


def fit_centres(vectors: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """Unit centres of directions (spherical k-means, seeded)."""
    norms = np.linalg.norm(vectors, axis=1)
    unit = vectors[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.zeros((1, vectors.shape[1]))
    centres = unit[np.random.default_rng(0).choice(len(unit), min(count, len(unit)), replace=False)]
    for _ in range(rounds):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        length = np.linalg.norm(sums, axis=1)
        centres = np.where(length[:, None] > 1e-12, sums / np.maximum(length, 1e-12)[:, None], centres)
    return centres


def _angles(vectors: np.ndarray, norms: np.ndarray, centre: np.ndarray) -> np.ndarray:
    cos = vectors @ centre / np.where(norms > 0, norms, 1)
    return np.arccos(np.clip(cos, -1, 1))


def shared_list(members: np.ndarray, candidates: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidates' order for a cluster, and the bound of each for a member of length 1, largest first.

    Rounding is on the safe side: angles are narrowed and bounds raised by more than their error.
    """
    lengths, norms = np.linalg.norm(members, axis=1), np.linalg.norm(candidates, axis=1)
    radius = np.pi if not lengths.all() else _angles(members, lengths, centre).max()
    bound = norms * np.cos(np.maximum(0, _angles(candidates, norms, centre) - radius - 1e-6))
    bound = np.where(np.isfinite(bound), bound + 1e-9 * norms, np.inf)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


class _Best:
    """The best ``k`` rows of each of a number of results; ``places`` orders rows of equal score."""

    def __init__(self, results: int, k: int, places: np.ndarray) -> None:
        self.k, self.places = k, places
        self.owner = self.score = self.row = np.zeros(0, np.int64)
        #: The worst score of each full result, and whether it is full.
        self.worst, self.full = np.zeros(results, np.int64), np.zeros(results, bool)

    def add(self, owner: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if not len(owner):
            return
        owner, score, row = (np.concatenate(x) for x in ((self.owner, owner), (self.score, score), (self.row, row)))
        order = np.lexsort((self.places[row], -score, owner))
        owner, score, row = owner[order], score[order], row[order]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        place = np.arange(len(owner)) - np.repeat(starts, np.diff(np.r_[starts, len(owner)]))
        last = place == self.k - 1
        self.worst[owner[last]], self.full[owner[last]] = score[last], True
        kept = place < self.k
        self.owner, self.score, self.row = owner[kept], score[kept], row[kept]


def _walk(
    members: np.ndarray, candidates: np.ndarray, centre: np.ndarray,
    step: Callable[[np.ndarray, np.ndarray, np.ndarray], None], finished: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> None:
    """Gives ``step`` the scores of the active members with each slice of the list; ``finished`` says, for
    active members and the bound of what follows, who leaves."""
    order, bound = shared_list(members, candidates, centre)
    lengths = np.linalg.norm(members, axis=1)
    active = np.arange(len(members))
    for start in range(0, len(order), SLICE):
        rows = order[start : start + SLICE]
        step(active, rows, _products(members[active], candidates[rows]))
        if start + SLICE < len(order):
            ahead = lengths[active] * bound[start + SLICE]
            active = active[~finished(active, ahead + 1e-9 * np.abs(ahead) + 1e-6)]
            if not len(active):
                return


def nearest_positives(anchors: pd.DataFrame, block: pd.DataFrame, centres: np.ndarray, positives: int) -> pd.DataFrame:
    """The best rows of a block for each anchor among other rows of its label."""
    parts = []
    for cluster, own, members, candidates in _clusters(anchors, block):
        labels, names = block["label"].to_numpy(), block["row"].to_numpy()
        wanted, own_names = own["label"].to_numpy(), own["row"].to_numpy()
        best = _Best(len(own), positives, _places(block))

        def step(active: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> None:
            fits = (labels[rows] == wanted[active, None]) & (names[rows] != own_names[active, None])
            fits &= ~best.full[active, None] | (scores >= best.worst[active, None])
            at, col = np.nonzero(fits)
            best.add(active[at], scores[at, col], rows[col])

        _walk(members, candidates, centres[cluster], step, lambda active, ahead: best.full[active] & (ahead < best.worst[active]))
        parts.append(pd.DataFrame({"anchor": own_names[best.owner], "positive": _ids(block, best.row), "score": best.score}))
    return pd.concat(parts)


def nearest_negatives(
    anchors: pd.DataFrame, block: pd.DataFrame, centres: np.ndarray, negatives: int, low: int, high: int
) -> pd.DataFrame:
    """The best rows of a block in the window of each (anchor, positive)."""
    parts = []
    for cluster, own, members, candidates in _clusters(anchors, block):
        labels, wanted = block["label"].to_numpy(), own["label"].to_numpy()
        scores_of = [np.asarray(x, np.int64) for x in own["scores"]]
        counts = np.array([len(x) for x in scores_of])
        pair_score = np.concatenate(scores_of)
        owner = np.repeat(np.arange(len(own)), counts)
        first = np.cumsum(counts) - counts
        best = _Best(len(pair_score), negatives, _places(block))
        floor = np.array([(low * x).min() for x in scores_of])

        def step(active: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> None:
            others = labels[rows] != wanted[active, None]
            for nth in range(counts[active].max()):
                has = np.flatnonzero(counts[active] > nth)
                pair = first[active[has]] + nth
                given, own_scores = pair_score[pair, None], scores[has]
                fits = others[has] & (low * given <= 100 * own_scores) & (100 * own_scores <= high * given)
                fits &= ~best.full[pair, None] | (own_scores >= best.worst[pair, None])
                at, col = np.nonzero(fits)
                best.add(pair[at], own_scores[at, col], rows[col])

        def finished(active: np.ndarray, ahead: np.ndarray) -> np.ndarray:
            settled = best.full.copy()
            bound = np.full(len(own), np.inf)
            bound[active] = ahead
            settled &= bound[owner] < best.worst
            left = np.bincount(owner[~settled], minlength=len(own))
            return (left[active] == 0) | (100 * ahead < floor[active])

        _walk(members, candidates, centres[cluster], step, finished)
        at = owner[best.owner]
        parts.append(pd.DataFrame({
            "anchor": own["row"].to_numpy()[at], "place": best.owner - first[at],
            "negative": _ids(block, best.row), "score": best.score,
        }))
    return pd.concat(parts)


def _places(block: pd.DataFrame) -> np.ndarray:
    """The rank of each row by id, rows without id last."""
    order = np.lexsort((block["row"], block["id"], block["nameless"]))
    places = np.empty(len(block), np.int64)
    places[order] = np.arange(len(block))
    return places


def _ids(block: pd.DataFrame, rows: np.ndarray) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(block["id"].to_numpy(np.int64)[rows], block["nameless"].to_numpy(bool)[rows])


def _clusters(anchors: pd.DataFrame, block: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray, np.ndarray]]:
    """Each cluster of a group with its anchors' and the block's components."""
    width = max(anchors["vector"].map(len).max(), block["vector"].map(len).max(), 1)
    candidates, vectors = _matrix(block["vector"], width), _matrix(anchors["vector"], width)
    for cluster, at in anchors.groupby("cluster").indices.items():
        yield int(cluster), anchors.iloc[at], vectors[at], candidates


def _grouped_anchors(anchors: DataFrame, cluster_rows: int, group_rows: int) -> tuple[DataFrame, np.ndarray, int]:
    """The anchors with cluster and group, the clusters' centres, and the number of groups.

    The driver sees a bounded sample of anchors and one count for each cluster (bounded as well)."""
    total = anchors.count()
    if not total:
        return anchors.withColumns({"cluster": F.lit(0), "group": F.lit(0)}), np.zeros((1, 1)), 1
    share = min(1.0, SAMPLE / total)
    chosen = anchors.where(F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("vector").limit(SAMPLE).toPandas()["vector"]
    width = max([1, *map(len, chosen)])
    centres = fit_centres(_matrix(chosen, width), min(MOST_CLUSTERS, max(1, total // cluster_rows)))

    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        wide = max([width, *map(len, vectors)])
        return pd.Series((_matrix(vectors, wide)[:, :width] @ centres.T).argmax(axis=1))

    placed = anchors.withColumn("cluster", nearest("vector"))
    sizes = sorted((r["cluster"], r["count"]) for r in placed.groupBy("cluster").count().collect())
    first, pieces, used, room = {}, {}, 0, 0
    for cluster, size in sizes:  # whole clusters together as long as a group has room; large ones in several groups
        if room < size:
            used, room = used + 1, group_rows
        first[cluster], pieces[cluster] = used - 1, -(-size // group_rows)
        used, room = used + pieces[cluster] - 1, max(0, room - size) if pieces[cluster] == 1 else 0
    of = lambda values: F.create_map(*[F.lit(int(x)) for pair in values.items() for x in pair])[F.col("cluster")]
    group = of(first) + F.pmod(F.xxhash64("id", "vector"), of(pieces))
    return placed.withColumn("group", group.cast("int")), centres, used


def _met(anchors: DataFrame, candidates: DataFrame, blocks: int, groups: int, run: Callable, schema: str) -> DataFrame:
    """``run(anchors, block)`` for every group of anchors and block of candidates."""
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("block", each(blocks))
    right = candidates.withColumn("group", each(groups))

    def both(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) and len(b):
            return run(a, b)
        return pd.DataFrame({x.split()[0]: pd.Series([], dtype="int64") for x in schema.split(", ")})

    return left.groupBy("group", "block").cogroup(right.groupBy("group", "block")).applyInPandas(both, schema)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_rows: int = BLOCK_ROWS,
    group_rows: int = GROUP_ROWS,
    cluster_rows: int = CLUSTER_ROWS,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``id``; ``label`` an expression on the table's columns.
    """
    from candlewick.llm.graph import _stored

    rows = usable_rows(vectors, key, vector, label)
    # A row's own number: ids may repeat.
    rows = _stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    total = rows.count()
    blocks = max(1, -(-total // block_rows))
    # Ids reach the tasks without nulls: pandas would turn the others into doubles.
    plain = [F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("nameless")]
    candidates = rows.select("row", *plain, "label", "vector", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
    anchors, centres, groups = _grouped_anchors(rows.where(is_anchor & F.col("id").isNotNull()), cluster_rows, group_rows)
    anchors = _stored(anchors, "anchors")

    found = _met(
        anchors.select("row", "label", "vector", "cluster", "group"), candidates, blocks, groups,
        lambda a, b: nearest_positives(a, b, centres, positives), "anchor long, positive long, score long",
    )
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("positive"))
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    listed = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive", "score"))).alias("list"))
    known = anchors.join(listed.withColumnRenamed("anchor", "row"), "row").withColumn("scores", F.col("list.score"))
    known = _stored(known, "positives")

    found = _met(
        known.select("row", "label", "vector", "cluster", "group", "scores"), candidates, blocks, groups,
        lambda a, b: nearest_negatives(a, b, centres, negatives, low, high), "anchor long, place long, negative long, score long",
    )
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("negative"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    joined = ranked.join(known.select(F.col("row").alias("anchor"), "id", "list"), "anchor")
    pair = F.element_at("list", (F.col("place") + 1).cast("int"))
    return joined.select(
        F.col("id").alias("anchor_id"), pair["positive"].alias("positive_id"), "rank",
        F.col("negative").alias("negative_id"), pair["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )
