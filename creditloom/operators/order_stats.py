"""Order statistics without a global sort or a one-task group.

Rank-based measures (AUC, exact quantiles, positional splits) normally sort a whole group in one task.  Here the
values are first counted (ties collapse map-side), then cut into value ranges that follow the data's own
distribution.  Sorting happens inside one (group, range) at a time, and the ranges are stitched together by a running
sum over the small table of range totals.  A group holding most of the rows is therefore spread over as many tasks as
any other data of its size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.measures import gini

RANGE, GROUP = "__range", "__group"
ROWS_PER_PREFIX = 50_000
#: Rows of a value range, as long as there are no more than so many ranges.
ROWS_PER_RANGE, MAX_RANGES = 1_000_000, 4096


def _default_ranges(df: DataFrame) -> int:
    """Ranges follow the number of rows, neither partitions nor settings."""
    return min(MAX_RANGES, max(1, math.ceil(df.count() / ROWS_PER_RANGE)))


def _sketch(value: Column, ranges: int) -> Column:
    """About ``ranges`` - 1 evenly placed values; one literal of shares, however many."""
    return F.percentile_approx(F.when(~F.isnan(value), value), F.lit(np.arange(1, ranges) / ranges), 2 * ranges)


def _cuts(df: DataFrame, column: str, ranges: int) -> list[float]:
    """Cut points from one pass of a sketch; fewer than ``ranges`` numbers reach the driver."""
    if ranges < 2:
        return []
    return sorted(set(df.agg(_sketch(F.col(column).cast("double"), ranges).alias("cuts")).first()["cuts"] or []))


def _searched(value: Column, cuts: Column, ranges: int) -> Column:
    """Number of cut points at or below the value, by halving steps; an expression of one size for any number of cuts.
    NaN counts as the largest value."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((ranges - 1).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at)
    )


def order_statistics(df: DataFrame, wanted: dict[str, Sequence[float]], ranges: int | None = None) -> DataFrame:
    """One row with a list of exact quantiles for every column in ``wanted``: for each share q the smallest value with
    at least q of the column's rows at or below it.  NULLs are left out; a column without values gives NULLs.

    Values are counted, then placed by range totals; only the ranges that hold a wanted rank are sorted.  All columns
    share the pass that counts and the pass that finds cut points, and the cut points stay in the plan as a scalar
    subquery; neither partitioning nor settings change a result.
    """
    names = list(wanted)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    ranges = _default_ranges(df) if ranges is None else ranges
    places = [F.lit(0) for _ in names]
    if ranges > 1:
        cuts = numbers.agg(F.struct(*[F.array_sort(F.array_distinct(_sketch(F.col(c), ranges))).alias(f"c{k}") for k, c in enumerate(names)]).alias("cuts"))
        numbers = numbers.withColumn(RANGE, cuts.scalar())
        places = [_searched(F.col(c), F.col(RANGE)[f"c{k}"], ranges) for k, c in enumerate(names)]
    entries = [F.struct(F.lit(c).alias("name"), p.alias(RANGE), F.col(c).alias("v")) for c, p in zip(names, places)]
    long = numbers.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter("v IS NOT NULL")
    counts = long.groupBy("name", RANGE, "v").agg(F.count(F.lit(1)).alias("n"))
    per_range = (
        counts.groupBy("name", RANGE)
        .agg(F.sum("n").alias("range_n"))
        .withColumn("range_start", _sum_before("range_n", _before(["name"], RANGE)))
        .withColumn("total", F.sum("range_n").over(Window.partitionBy("name")))
    )
    shares = F.lit(None)
    for c in names:
        points = F.array(*[F.struct(F.lit(k).alias("at"), F.lit(float(q)).alias("q")) for k, q in enumerate(wanted[c])])
        shares = F.when(F.col("name") == c, points).otherwise(shares)
    # The first rank at or above the share, counted down from the total so that rounding of q * total cannot show.
    rank = F.greatest(F.lit(1), F.col("total") - F.floor(F.col("total") - F.col("q") * F.col("total"))) - 1
    needed = (
        per_range.withColumn("share", F.explode(shares))
        .select("name", RANGE, "range_start", "range_n", "total", "share.at", "share.q")
        .select("name", RANGE, "at", "range_n", (rank - F.col("range_start")).alias("rank"))
        .filter("rank >= 0 AND rank < range_n")
    )
    inside = counts.join(needed, ["name", RANGE]).withColumn("start", _sum_before("n", _before(["name", RANGE, "at"], "v")))
    found = inside.filter("start <= rank AND rank < start + n")
    return found.agg(
        *[
            F.array(*[F.max(F.when((F.col("name") == c) & (F.col("at") == k), F.col("v"))) for k in range(len(wanted[c]))]).alias(c)
            for c in names
        ]
    )


def range_cuts(df: DataFrame, value: str, ranges: int | None = None) -> list[float]:
    """Cut points that split the rows into about ``ranges`` equal parts.

    One pass; what reaches the driver is fewer than ``ranges`` numbers.  Cut points only steer the work: any
    increasing list gives the same results.
    """
    return _cuts(df, value, _default_ranges(df) if ranges is None else ranges)


def with_range(df: DataFrame, value: str, cuts: Sequence[float]) -> DataFrame:
    """Add the number of the value range each row falls into; higher values never get lower numbers."""
    if not cuts:
        # Not a constant, so that plans over one range have the shape of plans over many.
        return df.withColumn(RANGE, F.when(F.col(value).isNull(), -1).otherwise(0))
    splits = [float("-inf"), *cuts, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="__v", outputCol=RANGE, handleInvalid="keep")
    return (
        bucketizer.transform(df.withColumn("__v", F.col(value).cast("double")))
        # Declared as never missing, so that no filter is inferred and plans over the same ranges stay equal.
        .withColumn(RANGE, F.coalesce(F.col(RANGE).cast("int"), F.lit(-1)))
        .drop("__v")
    )


def _group(by: Sequence[str]) -> Column:
    """The group as one never-missing value, so that a missing group value still joins with itself by equality."""
    return F.struct(*by) if by else F.lit(0)


def _before(by: Sequence[str], order: str):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def auc(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), cuts: Sequence[float] | None = None
) -> DataFrame:
    """Area under the ROC curve per group, ties counted half; NULL when a class is missing.

    Columns: ``by``, positives, negatives, auc, gini.
    """
    by = list(by)
    scored = df.select(*by, F.col(score).alias("__s"), F.col(label).alias("__y")).filter(
        "__s IS NOT NULL AND __y IS NOT NULL"
    )
    cuts = range_cuts(scored, "__s", _default_ranges(df)) if cuts is None else cuts
    per_score = (
        with_range(scored, "__s", cuts)
        .groupBy(*by, RANGE, "__s")
        .agg(F.sum("__y").cast("double").alias("pos"), F.sum(1 - F.col("__y")).cast("double").alias("neg"))
    )
    in_range = per_score.withColumn("below", _sum_before("neg", _before([*by, RANGE], "__s")))
    per_range = in_range.groupBy(*by, RANGE).agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("pairs"),
    )
    # At most one row per range and group from here on.
    stitched = per_range.withColumn("below", _sum_before("neg", _before(by, RANGE)))
    area = F.sum(F.col("pairs") + F.col("pos") * F.col("below"))
    return (
        stitched.groupBy(*by)
        .agg(
            F.sum("pos").cast("bigint").alias("positives"),
            F.sum("neg").cast("bigint").alias("negatives"),
            F.try_divide(area, F.sum("pos") * F.sum("neg")).alias("auc"),
        )
        .withColumn("gini", gini(F.col("auc")))
    )


def exact_quantiles(
    df: DataFrame, value: str, points: dict[str, float], by: Sequence[str] = (), cuts: Sequence[float] | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours, one column per entry of ``points``.

    Only the ranges that hold a wanted rank are sorted.
    """
    by = list(by)
    values = df.select(_group(by).alias(GROUP), F.col(value).cast("double").alias("__s")).filter("__s IS NOT NULL")
    cuts = range_cuts(values, "__s", _default_ranges(df)) if cuts is None else cuts
    counts = with_range(values, "__s", cuts).groupBy(GROUP, RANGE, "__s").agg(F.count(F.lit(1)).alias("n"))
    per_range = (
        counts.groupBy(GROUP, RANGE)
        .agg(F.sum("n").alias("range_n"))
        .withColumn("range_start", _sum_before("range_n", _before([GROUP], RANGE)))
        .withColumn("total", F.sum("range_n").over(Window.partitionBy(GROUP)))
    )

    def rank(point: float, neighbour) -> Column:
        return neighbour(F.lit(point) * (F.col("total") - 1)).cast("bigint")

    def holds(start: Column, size: Column, wanted: Column) -> Column:
        return (start <= wanted) & (wanted < start + size)

    wanted = [rank(q, side) for q in points.values() for side in (F.floor, F.ceil)]
    hit = F.lit(False)
    for w in wanted:
        hit = hit | holds(F.col("range_start"), F.col("range_n"), w)
    needed = counts.join(per_range.filter(hit).drop("range_n"), [GROUP, RANGE], "inner")
    placed = needed.withColumn("start", F.col("range_start") + _sum_before("n", _before([GROUP, RANGE], "__s")))

    picks = []
    for name, q in points.items():
        for side, neighbour in (("lo", F.floor), ("hi", F.ceil)):
            at = holds(F.col("start"), F.col("n"), rank(q, neighbour))
            picks.append(F.max(F.when(at, F.col("__s"))).alias(f"{name}__{side}"))
    picked = placed.groupBy(GROUP).agg(F.max("total").alias("total"), *picks)

    def interpolate(name: str, q: float) -> Column:
        position = F.lit(q) * (F.col("total") - 1)
        low, high = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        return (low + (high - low) * (position - F.floor(position))).alias(name)

    groups = [F.col(f"{GROUP}.{c}") for c in by]
    return picked.select(*groups, *[interpolate(n, q) for n, q in points.items()])


def row_hash(*keys: str, seed: str | None = None) -> Column:
    """A text hash of the key columns: the same in every run and every engine, and unrelated to the keys' order.
    Different seeds give independent hashes."""
    parts = [F.col(k).cast("string") for k in keys]
    if seed is not None:
        parts.append(F.lit(seed))
    return F.md5(F.concat_ws("|", *parts))


def hash_fraction(*keys: str, seed: str | None = None) -> Column:
    """The leading 32 bits of ``row_hash`` as a number in [0, 1)."""
    return F.conv(F.substring(row_hash(*keys, seed=seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def hash_digits(rows: int) -> int:
    """Length of a hash prefix that leaves about ``ROWS_PER_PREFIX`` rows to each, however many rows there are."""
    return max(1, math.ceil(math.log(max(rows, 1) / ROWS_PER_PREFIX, 16)))


def hash_position(df: DataFrame, *keys: str, by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Add ``position`` (from 0) and ``group_rows``: each row's place in a repeatable shuffled order of its group.

    Keys must identify rows.  Rows are ordered by hash.  Hash prefixes spread any group evenly over 16**digits parts,
    as many as the row count asks for; each part is sorted by itself, and the table of part sizes supplies the offsets.
    """
    digits = hash_digits(df.count()) if digits is None else digits
    hashed = df.withColumns({GROUP: _group(by), "__hash": row_hash(*keys)}).withColumn(
        RANGE, F.substring("__hash", 1, digits)
    )
    sizes = hashed.groupBy(GROUP, RANGE).agg(F.count(F.lit(1)).alias("part_rows"))
    offsets = sizes.select(
        GROUP,
        RANGE,
        _sum_before("part_rows", _before([GROUP], RANGE)).alias("part_start"),
        F.sum("part_rows").over(Window.partitionBy(GROUP)).alias("group_rows"),
    )
    inside = F.row_number().over(Window.partitionBy(GROUP, RANGE).orderBy("__hash", *keys)) - 1
    return (
        hashed.withColumn("__inside", inside)
        .join(offsets, [GROUP, RANGE], "inner")
        .withColumn("position", F.col("part_start") + F.col("__inside"))
        .drop(GROUP, "__hash", RANGE, "__inside", "part_start")
    )


PLACE, BOUNDARIES = "__place", "__boundaries"


def with_boundaries(df: DataFrame, keys: Sequence[str], positions: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Add ``__place`` (hash and keys of the row) and ``__boundaries`` (the places of the rows at some positions of the
    group's shuffled order, NULL beyond its end).  A row's position is below the k-th one wanted exactly if its place is
    below the k-th boundary, so rows are cut by comparison and never sorted.

    ``positions`` are expressions over ``group_rows``.  Keys must identify rows.  Hash prefixes are counted, and only the
    one prefix that holds a wanted position is looked into; prefixes follow the row count, so each holds about
    ``ROWS_PER_PREFIX`` rows, whatever the group.  Groups meet their boundaries in a join that Spark broadcasts while
    they are few.
    """
    hashed = df.select(_group(by).alias(GROUP), F.struct(row_hash(*keys).alias("hash"), *keys).alias(PLACE)).withColumn(
        RANGE, F.substring(F.col(f"{PLACE}.hash"), 1, hash_digits(df.count()))
    )
    sizes = hashed.groupBy(GROUP, RANGE).agg(F.count(F.lit(1)).alias("n"))
    placed = sizes.withColumns(
        {"start": _sum_before("n", _before([GROUP], RANGE)), "group_rows": F.sum("n").over(Window.partitionBy(GROUP))}
    )
    wanted = F.array(*[F.struct(F.lit(k).alias("at"), p.cast("bigint").alias("position")) for k, p in enumerate(positions)])
    holders = (
        placed.withColumn("wanted", F.explode(wanted))
        .select(GROUP, RANGE, "n", "wanted.at", (F.col("wanted.position") - F.col("start")).alias("inside"))
        .filter("inside >= 0 AND inside < n")
        .select(GROUP, RANGE, F.struct("at", "inside").alias("w"))
    )
    # One list of places for a prefix, however many positions it holds.
    holders = holders.groupBy(GROUP, RANGE).agg(F.collect_list("w").alias("wanted"))
    found = (
        hashed.join(holders, [GROUP, RANGE])
        .groupBy(GROUP, RANGE)
        .agg(F.array_sort(F.collect_list(PLACE)).alias("places"), F.first("wanted").alias("wanted"))
        .select(GROUP, F.explode(F.transform("wanted", lambda w: F.struct(w["at"].alias("at"), F.get("places", w["inside"].cast("int")).alias("place")))).alias("b"))
    )
    boundaries = F.array(*[F.max(F.when(F.col("b.at") == k, F.col("b.place"))) for k in range(len(positions))])
    place = F.struct(row_hash(*keys).alias("hash"), *keys)
    if not by:
        return df.withColumns({PLACE: place, BOUNDARIES: found.agg(boundaries.alias(BOUNDARIES)).scalar()})
    per_group = found.groupBy(GROUP).agg(boundaries.alias(BOUNDARIES))
    # A group shorter than its first position has no boundary at all.
    every = placed.select(GROUP).distinct().join(per_group, GROUP, "left")
    return df.withColumns({GROUP: _group(by), PLACE: place}).join(every, GROUP).drop(GROUP)


def below(boundary: int) -> Column:
    """Whether a row with ``__place`` and ``__boundaries`` comes before a boundary; all rows do where there is none."""
    at = F.get(BOUNDARIES, F.lit(boundary))
    return at.isNull() | (F.col(PLACE) < at)
