"""Ordered series of one entity, and how a long one is spread over many tasks.

A window partitioned by the entity puts a whole series into one task. That is fine while the calendar
bounds the series, as it does for bars with one row per entity and day. Raw points are not bounded:
one entity may hold a third of a huge table. Their :class:`Series` carries a :class:`Split`. Rows are then
shuffled once, to (entity, time bucket), and what crosses buckets is small:

* running values (last known value, position, total) come from one summary row per bucket, added up in
  two levels (:func:`running`);
* bounded ROWS frames get copies of the few rows at the edge of a bucket that frames of its neighbours
  reach (:func:`in_blocks`);
* unbroken runs of a condition are summarised per bucket and stitched together (:func:`longest_streak`,
  :func:`sustained`), so that no row is joined back.

All give the same rows as the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlewick.functions.scalar import packed_order


#: In what the buckets of a grain are added up, so that no summary is one task per entity.
COARSER = {"millisecond": "minute", "second": "hour", "minute": "day", "hour": "month", "day": "year", "week": "year"}


@dataclass(frozen=True)
class Split:
    """How to cut a series: ``grain`` of the time buckets.

    Choose a grain whose buckets fit one task and hold more rows than a frame: one (entity, bucket)
    group is sorted as a whole, and edges are copied. :func:`choose_split` measures.
    """

    grain: str = "hour"

    def bucket(self, time: str) -> Column:
        return F.date_trunc(self.grain, F.col(time))

    def coarse(self, bucket: str) -> Column:
        """The larger bucket of a bucket; buckets keep their order. Never null, so that joins on it add no filter."""
        grain = COARSER.get(self.grain)
        return F.col(bucket) if grain is None else F.coalesce(F.date_trunc(grain, F.col(bucket)), F.col(bucket))


@dataclass(frozen=True)
class Series:
    """Names the entity columns, the time column and the tie-break columns of a table.

    (key, time, tie) must be unique, so that the order within a series is total. A single tie-break
    column must be a non-negative integer below 10^18, such as an event number. Leave ``split`` out
    only where the calendar bounds the rows per entity.
    """

    key: tuple[str, ...] = ("Ticker",)
    time: str = "Date"
    tie: tuple[str, ...] = ()
    split: Split | None = None

    @property
    def order(self) -> list[str]:
        return [self.time, *self.tie]

    def order_value(self) -> Column:
        """The order as one value; of fixed width (so hash aggregation applies) with up to one tie."""
        if not self.tie:
            return F.col(self.time)
        if len(self.tie) == 1:
            return packed_order(self.time, self.tie[0])
        return F.struct(*self.order)

    def window(self, *extra: str) -> WindowSpec:
        return Window.partitionBy(*self.key, *extra).orderBy(*self.order)

    def newest_first(self) -> WindowSpec:
        return Window.partitionBy(*self.key).orderBy(*[F.col(c).desc() for c in self.order])


# One row per symbol and day.
BARS = Series()

GRAINS = ("day", "hour", "minute", "second", "millisecond")


def choose_split(df: DataFrame, series: Series, rows_per_task: int = 5_000_000) -> Split | None:
    """The coarsest split whose largest (entity, bucket) group fits one task; None if every entity fits.

    Measures instead of guessing: each step is one aggregation over the entity and time columns, and
    only the largest count comes back. An error if even the finest grain is too coarse.
    """
    def largest(*groups: Column | str) -> int:
        sizes = df.groupBy(*series.key, *groups).agg(F.count(F.lit(1)).alias("_n"))
        return sizes.agg(F.max("_n")).first()[0] or 0

    if largest() <= rows_per_task:
        return None
    for grain in GRAINS:
        if largest(F.date_trunc(grain, F.col(series.time))) <= rows_per_task:
            return Split(grain)
    raise ValueError(f"one {GRAINS[-1]} of a series has more than {rows_per_task} rows")


def _entity(series: Series) -> list[str]:
    return [name for i in range(len(series.key)) for name in (f"_k{i}", f"_m{i}")]


def _bucketed(df: DataFrame, series: Series) -> DataFrame:
    """Adds stand-ins of the entity columns and the bucket that are never null.

    Rows that are partitioned by them stay where they are in a join; a null-safe join would shuffle.
    """
    names = {}
    for i, k in enumerate(series.key):
        names |= {f"_k{i}": F.coalesce(F.col(k).cast("string"), F.lit("")), f"_m{i}": F.col(k).isNull()}
    first = F.lit("0001-01-01").cast("timestamp")  # times that are missing come first
    return df.withColumns({**names, "_bucket": F.coalesce(series.split.bucket(series.time).cast("timestamp"), first)})


def _attached(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the summary of each row's group. Adaptive execution broadcasts it only if it is small."""
    renamed = summary.withColumnsRenamed({k: f"_r{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_r{k}"))
    return rows.join(renamed, same).drop(*[f"_r{k}" for k in keys])


def _inherited(rows: DataFrame, series: Series, own: Sequence[str]) -> DataFrame:
    """Per bucket: rows before it (``_base``), in it (``_n``) and of the series (``_total``), and the last known
    value of each ``own`` column before it.

    Buckets are added up inside coarser ones, those over the series; a series has few of them.
    """
    entity, order = _entity(series), series.order_value()
    known = lambda c, by: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), by)).alias(c)
    fine = rows.groupBy(*entity, "_bucket").agg(F.count(F.lit(1)).alias("_n"), *[known(c, order) for c in own])
    fine = fine.withColumn("_coarse", series.split.coarse("_bucket"))
    coarse = fine.groupBy(*entity, "_coarse").agg(F.sum("_n").alias("_n"), *[known(c, F.col("_bucket")) for c in own])

    def before(of: DataFrame, groups: Sequence[str], by: str, prefix: str) -> dict[str, Column]:
        w = Window.partitionBy(*groups).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return {
            f"_{prefix}base": F.coalesce(F.sum("_n").over(w), F.lit(0)),
            **{f"_{prefix}{c}": F.last(F.col(c), ignorenulls=True).over(w) for c in own},
        }

    coarse = coarse.withColumns({
        **before(coarse, entity, "_coarse", "c"), "_total": F.sum("_n").over(Window.partitionBy(*entity)),
    }).drop("_n", *own)
    fine = fine.withColumns(before(fine, [*entity, "_coarse"], "_bucket", "f"))
    both = _attached(fine, coarse, [*entity, "_coarse"])
    return both.select(
        *entity, "_bucket", "_n", "_total", (F.col("_fbase") + F.col("_cbase")).alias("_base"),
        *[F.coalesce(F.col(f"_f{c}"), F.col(f"_c{c}")).alias(f"_in{c}") for c in own],
    )


def _run_in_buckets(df: DataFrame, fill: Mapping[str, Column], series: Series) -> DataFrame:
    """The running values of a split series, its position ``_pos``, and the helpers of its buckets."""
    own = {n: f"_own_{n}" for n in fill}
    rows = _bucketed(df.withColumns({own[n]: c for n, c in fill.items()}), series)
    keys = [*_entity(series), "_bucket"]
    w = Window.partitionBy(*keys).orderBy(*series.order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {c: F.last(F.col(c), ignorenulls=True).over(upto) for c in own.values()}
    summary = _inherited(rows, series, list(own.values()))
    rows = _attached(rows.withColumns({**local, "_place": F.row_number().over(w)}), summary, keys)
    done = {n: F.coalesce(F.col(c), F.col(f"_in{c}")) for n, c in own.items()}
    rows = rows.withColumns({**done, "_pos": (F.col("_place") + F.col("_base")).cast("long")})
    return rows.drop(*own.values(), *[f"_in{c}" for c in own.values()])


_HELPERS = ("_bucket", "_n", "_total", "_base", "_place")


def running(
    df: DataFrame,
    fill: Mapping[str, Column] | None = None,
    position: str | None = None,
    series: Series = BARS,
    total: str | None = None,
) -> DataFrame:
    """Adds running values of each series.

    ``fill`` maps a new column to an expression whose last non-null value at or before the row it
    holds; ``position`` names a column for the 1-based place of the row, ``total`` one for the number
    of rows of its series.
    """
    fill = dict(fill or {})
    if series.split is None:
        w = series.window()
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        added = {n: F.last(c, ignorenulls=True).over(upto) for n, c in fill.items()}
        if position:
            added[position] = F.row_number().over(w).cast("long")
        if total:
            added[total] = F.count(F.lit(1)).over(Window.partitionBy(*series.key))
        return df.withColumns(added)
    rows = _run_in_buckets(df, fill, series)
    asked = {name: F.col(own) for name, own in ((position, "_pos"), (total, "_total")) if name}
    return rows.select(*df.columns, *fill, *[c.alias(name) for name, c in asked.items()])


def with_position(df: DataFrame, series: Series = BARS, name: str = "_pos") -> DataFrame:
    """1-based position of each row within its series."""
    return running(df, position=name, series=series)


def fill_forward(df: DataFrame, values: Mapping[str, Column], series: Series = BARS) -> DataFrame:
    """Adds, per entry, the last non-null value of its expression at or before each row."""
    return running(df, values, series=series)


def in_blocks(
    df: DataFrame,
    series: Series,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int,
    after: int = 0,
    fill: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Runs ``compute(rows, window)`` over each series, bucket by bucket if the series has a split.

    ``before`` and ``after`` say how many rows the composed frames reach back and ahead; they must
    cover chains (a 5-row deviation of 1-row returns reaches back 5). ``fill`` adds forward-filled
    columns first, as :func:`running` does. ``compute`` may add columns but must neither drop nor
    reorder rows.

    Rows stay in their bucket; only those at its edges are copied to the buckets whose frames reach
    them (several, where buckets hold fewer rows than a frame).
    """
    if series.split is None:
        return compute(running(df, fill, series=series) if fill else df, series.window())
    entity = _entity(series)
    keys = [*entity, "_bucket"]
    rows = _run_in_buckets(df, dict(fill or {}), series)
    wanted = [*df.columns, *(fill or {}), "_pos", *keys]

    whole = rows.select(*wanted, F.lit(True).alias("_home"))
    if before or after:
        ordered = Window.partitionBy(*entity).orderBy("_bucket")
        near = lambda low, high: F.collect_list(F.struct("_bucket", "_base", "_n")).over(ordered.rowsBetween(low, high))
        ends = F.col("_base") + F.col("_n")
        # Of the buckets around, those that a frame can reach from the nearest row.
        reach = {}
        if before:
            reach["_later"] = F.filter(near(1, before), lambda b: b["_base"] < ends + before)
        if after:
            reach["_earlier"] = F.filter(near(-after, -1), lambda b: b["_base"] + b["_n"] >= F.col("_base") + 1 - after)
        around = _inherited(_bucketed(df, series), series, ()).withColumns(reach).select(*keys, *reach)
        at_edge = (F.col("_n") - F.col("_place") < before) | (F.col("_place") <= after)
        edge = _attached(rows.filter(at_edge), around, keys)
        targets = []
        if before:
            targets.append(F.filter("_later", lambda b: b["_base"] < F.col("_pos") + before))
        if after:
            targets.append(F.filter("_earlier", lambda b: b["_base"] + b["_n"] >= F.col("_pos") - after))
        copies = edge.withColumn("_to", F.explode(F.concat(*targets))).withColumn("_bucket", F.col("_to._bucket"))
        whole = whole.unionByName(copies.select(*wanted, F.lit(False).alias("_home")).repartition(*keys))
    done = compute(whole, Window.partitionBy(*keys).orderBy("_pos"))
    return done.filter("_home").drop("_pos", "_home", *keys)


def islands(df: DataFrame, condition: Column, series: Series = BARS) -> DataFrame:
    """Adds ``_holds`` and ``_island``: rows of one unbroken run share the id.

    The id is the order value of the last row where the condition failed (null before the first).
    A null condition counts as failed.
    """
    mark = series.order_value()
    rows = df.withColumn("_holds", F.coalesce(condition, F.lit(False)))
    return fill_forward(rows, {"_island": F.when(~F.col("_holds"), mark)}, series)


def _pieces(df: DataFrame, condition: Column, series: Series) -> DataFrame:
    """Per bucket the pieces of its runs: rows, start and end, and whether the run may go on to the left or
    to the right of the bucket. The last piece is there even if it is empty: it parts its neighbours."""
    slim = df.select(*series.key, *series.order, F.coalesce(condition, F.lit(False)).alias("_holds"))
    keys = [*_entity(series), "_bucket"]
    w = Window.partitionBy(*keys).orderBy(*series.order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _bucketed(slim, series).withColumn("_run", F.sum((~F.col("_holds")).cast("int")).over(w))
    held = F.when(F.col("_holds"), F.col(series.time))
    pieces = rows.groupBy(*keys, "_run").agg(
        *[F.any_value(k).alias(k) for k in series.key], F.sum(F.col("_holds").cast("int")).alias("_points"),
        F.min(held).alias("_from"), F.max(held).alias("_till"),
    )
    return pieces.withColumns({
        "_left": F.col("_run") == 0, "_right": F.col("_run") == F.max("_run").over(Window.partitionBy(*keys)),
    })


def _stitched(pieces: DataFrame, groups: Sequence[str], series: Series) -> DataFrame:
    """The pieces of the runs of a larger group, from pieces of its parts in order of ``_bucket``."""
    w = Window.partitionBy(*groups).orderBy("_bucket", "_run")
    goes_on = F.col("_left") & F.coalesce(F.lag("_right").over(w), F.lit(False))
    marked = pieces.withColumns({
        "_new": (~goes_on).cast("int"), "_first": F.row_number().over(w) == 1, "_last": F.lead(F.lit(1)).over(w).isNull(),
    }).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return marked.groupBy(*groups, "_run").agg(
        *[F.any_value(k).alias(k) for k in series.key], F.sum("_points").alias("_points"), F.min("_from").alias("_from"),
        F.max("_till").alias("_till"), F.max(F.col("_left") & F.col("_first")).alias("_left"),
        F.max(F.col("_right") & F.col("_last")).alias("_right"),
    )


def _runs(df: DataFrame, condition: Column, series: Series, kept: Callable[[DataFrame, Sequence[str]], DataFrame]) -> DataFrame:
    """Runs of a split series. ``kept`` reduces the runs that ended inside a group to those that matter."""
    entity = _entity(series)

    def reduced(pieces: DataFrame, groups: Sequence[str]) -> DataFrame:
        return kept(pieces.withColumn("_open", F.col("_left") | F.col("_right")), groups).drop("_open")

    pieces = reduced(_pieces(df, condition, series), [*entity, "_bucket"])
    if series.split.grain in COARSER:
        pieces = pieces.withColumn("_coarse", series.split.coarse("_bucket"))
        pieces = reduced(_stitched(pieces, [*entity, "_coarse"], series), [*entity, "_coarse"])
        pieces = pieces.withColumnRenamed("_coarse", "_bucket")
    return _stitched(pieces, entity, series)


def longest_streak(
    df: DataFrame, condition: Column, series: Series = BARS, min_run: int = 2
) -> DataFrame:
    """Per entity: longest run of rows that meet the condition, and whether it reaches ``min_run``."""
    if series.split is None:
        held = F.sum(F.col("_holds").cast("int"))
        runs = islands(df, condition, series).groupBy(*series.key, "_island").agg(held.alias("_points"))
        groups = series.key
    else:
        def best(pieces: DataFrame, groups: Sequence[str]) -> DataFrame:
            """Of the runs that ended, the longest one of each group."""
            place = F.row_number().over(Window.partitionBy(*groups, "_open").orderBy(F.desc("_points"), "_run"))
            return pieces.withColumn("_at", place).filter(F.col("_open") | (F.col("_at") == 1)).drop("_at")

        runs, groups = _runs(df, condition, series, best), _entity(series)
    out = runs.groupBy(*groups).agg(
        *[F.any_value(k).alias(k) for k in series.key if series.split],
        F.max("_points").alias("max_streak"), (F.max("_points") >= min_run).alias("confirmed"),
    )
    return out.select(*series.key, "max_streak", "confirmed")


def newest_rows(df: DataFrame, n: int, series: Series = BARS, name: str = "_rank") -> DataFrame:
    """The last ``n`` rows of each series, ranked 1 = newest.

    Spark keeps at most ``n`` rows per series and task before the shuffle, so a hot entity is cheap.
    """
    return df.withColumn(name, F.row_number().over(series.newest_first())).filter(F.col(name) <= n)


def trailing_streak(
    df: DataFrame, condition: Column, last_n: int = 20, series: Series = BARS
) -> DataFrame:
    """Per entity: length of the run at the very end, looking at the last ``last_n`` rows only."""
    rows = newest_rows(df.withColumn("_holds", F.coalesce(condition, F.lit(False))), last_n, series)
    first_miss = F.min(F.when(~F.col("_holds"), F.col("_rank")))
    return rows.groupBy(*series.key).agg(
        F.coalesce(first_miss - 1, F.count(F.lit(1))).cast("long").alias("streak")
    )


def latest_change(df: DataFrame, value: str = "Close", series: Series = BARS) -> DataFrame:
    """Newest against previous value of each series; a one-row series is compared with itself."""
    rows = newest_rows(df, 2, series)
    newest = F.max(F.when(F.col("_rank") == 1, F.col(value)))
    earlier = F.max(F.when(F.col("_rank") == 2, F.col(value)))
    only = F.count(F.lit(1)) == 1
    out = rows.groupBy(*series.key).agg(
        F.max(series.time).alias("as_of"),
        newest.alias("latest"),
        F.when(only, newest).otherwise(earlier).alias("previous"),
    )
    change = F.col("latest") - F.col("previous")
    return out.withColumn("change", change).withColumn(
        "change_pct", F.try_divide(change, F.col("previous")) * 100
    )


def sequences(
    df: DataFrame, value: str = "Close", n: int = 60, series: Series = BARS
) -> DataFrame:
    """Per row: array of the ``n`` values before it (``lags``, oldest first) and its own (``label``).

    Rows with fewer than ``n`` earlier values are left out.
    """
    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn("lags", F.collect_list(value).over(w.rowsBetween(-n, -1)))

    slim = df.select(*series.key, *series.order, value)
    rows = in_blocks(slim, series, compute, before=n).filter(F.size("lags") == n)
    return rows.withColumn("label", F.col(value)).drop(value)


def chrono_split(df: DataFrame, fraction: float = 0.8, series: Series = BARS) -> DataFrame:
    """Adds ``part``: 'train' for the first floor(fraction * rows) of each series, else 'test'."""
    rows = running(df, position="_pos", series=series, total="_total")
    train = F.col("_pos") <= F.floor(F.lit(fraction) * F.col("_total"))
    return rows.withColumn("part", F.when(train, "train").otherwise("test")).drop("_pos", "_total")


def sustained(df: DataFrame, condition: Column, at_least: str, series: Series) -> DataFrame:
    """Unbroken runs of the condition that last ``at_least`` (an interval such as '1 minute')."""
    long_enough = F.col("_from") + F.expr(f"INTERVAL {at_least}") <= F.col("_till")
    if series.split is None:
        runs = islands(df, condition, series).filter("_holds").groupBy(*series.key, "_island").agg(
            F.min(series.time).alias("_from"), F.max(series.time).alias("_till"), F.count(F.lit(1)).alias("_points")
        )
    else:
        runs = _runs(df, condition, series, lambda pieces, _: pieces.filter(F.col("_open") | long_enough))
    return runs.filter(long_enough).select(
        *series.key, F.col("_from").alias("started"), F.col("_till").alias("ended"), F.col("_points").alias("n_points")
    )


def min_rows(df: DataFrame, n: int, key: Sequence[str] = ("Ticker",)) -> DataFrame:
    """Rows of the entities that have at least ``n`` of them (counted before any shuffle of rows)."""
    enough = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n)
    return df.join(enough.select(*key), list(key), "left_semi")
