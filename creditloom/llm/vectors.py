"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2t) of each other, and a rotation onto principal dimensions
keeps distances, so boxes over the leading dimensions bound them from below.  Vectors are sorted by their grid cells
of width eps on the leading principal dimensions and cut into intervals of that sequence; interval pairs whose boxes
are within eps are joined by recursive halving, skipping provably distant parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import column, prepare, staged
from creditloom.llm.components import components

INTERVAL = 4096  # vectors of a sequence interval; results do not depend on it
LEAF = 128  # below this length an interval pair is multiplied out
BOX_DIMENSIONS = 16
GRID_DIMENSIONS = 8
KEY_DIMENSIONS = 3
CELL = 0.25  # least width of the cells in which interval boxes meet; unit vectors span 2, so a box lies in few cells
SLACK = 1e-9  # rounding allowance of the bounds; links themselves are decided by the cosine


def matrix(arrays: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as doubles."""
    if isinstance(arrays, pa.ChunkedArray):
        arrays = arrays.combine_chunks()
    flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(arrays), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1)[:, None]  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def principal_axes(classes: DataFrame, dimensions: int) -> np.ndarray:
    """Rotation onto the principal dimensions of all vectors, largest variance first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimensions + 1, dimensions + 1))
        for batch in batches:
            if batch.num_rows:
                x = np.hstack([unit(matrix(batch.column("vector"))), np.ones((batch.num_rows, 1))])
                total += x.T @ x
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "value"])

    summed = classes.select("vector").mapInArrow(moments, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    total = np.zeros((dimensions + 1) ** 2)
    for row in summed.collect():
        total[row["at"]] = row["value"]
    total = total.reshape(dimensions + 1, -1)
    mean = total[-1, :-1] / total[-1, -1]
    spread = total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean)
    return np.linalg.eigh(spread)[1][:, ::-1].copy()


def intervals(classes: DataFrame, axes: np.ndarray, eps: float, length: int) -> DataFrame:
    """The vectors in grid order, cut into intervals: (interval, ids, sizes, vectors, low, high)."""
    spark = classes.sparkSession
    sent = spark.sparkContext.broadcast(axes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                place = np.floor(unit(matrix(batch.column("vector"))) @ sent.value[:, :GRID_DIMENSIONS] / eps)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(place.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                    names=[*batch.schema.names, "cells"],
                )

    kind = classes.schema["vector"].dataType.simpleString()
    placed = staged(classes.mapInArrow(cells, f"class long, size long, vector {kind}, cells array<int>"), "cells")
    pieces = max(1, math.ceil(placed.count() / (0.8 * length)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting = TaskContext.get().partitionId() << 32, []

        def pack(part: pa.Table) -> pa.RecordBatch:
            nonlocal number
            z = unit(matrix(part.column("vector"))) @ sent.value[:, :BOX_DIMENSIONS]
            row = {
                "interval": [number],
                "ids": [part.column("class").to_pylist()],
                "sizes": [part.column("size").to_pylist()],
                "vectors": [part.column("vector").combine_chunks().flatten().to_pylist()],
                "low": [z.min(axis=0).tolist()],
                "high": [z.max(axis=0).tolist()],
            }
            number += 1
            entry = part.schema.field("vector").type.value_type
            kinds = (pa.int64(), *map(pa.list_, (pa.int64(), pa.int64(), entry, pa.float64(), pa.float64())))
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= length:
                whole = pa.Table.from_batches(waiting).combine_chunks()
                while whole.num_rows >= length:
                    yield pack(whole.slice(0, length))
                    whole = whole.slice(length)
                waiting = whole.to_batches()
        if sum(b.num_rows for b in waiting):
            yield pack(pa.Table.from_batches(waiting))

    ordered = placed.repartitionByRange(pieces, "cells", "class").sortWithinPartitions("cells", "class")
    schema = f"interval long, ids array<long>, sizes array<long>, vectors {kind}, low array<double>, high array<double>"
    return staged(ordered.mapInArrow(cut, schema), "intervals")


def close_pairs(boxes: DataFrame, eps: float) -> DataFrame:
    """Interval pairs (i <= j) whose boxes are within eps, met in shared or adjacent cells of the leading dimensions.
    Cells may be wider than eps, never narrower, so boxes within eps always meet."""
    cell = max(eps, CELL)

    def keyed(prefix: str, margin: int) -> DataFrame:
        df = boxes.select(*(F.col(c).alias(prefix + c) for c in ("interval", "low", "high")))
        for k in range(KEY_DIMENSIONS):
            first = F.floor(F.coalesce(F.get(prefix + "low", F.lit(k)), F.lit(0.0)) / cell).cast("int") - margin
            last = F.floor(F.coalesce(F.get(prefix + "high", F.lit(k)), F.lit(0.0)) / cell).cast("int") + margin
            df = df.withColumn(f"{prefix}c{k}", F.explode(F.sequence(first, last)))
        return df

    a, b = keyed("a_", 0), keyed("b_", 1)
    same_cell = [F.col(f"a_c{k}") == F.col(f"b_c{k}") for k in range(KEY_DIMENSIONS)]
    gaps = F.zip_with(
        F.zip_with("a_low", "b_high", lambda x, y: x - y),
        F.zip_with("b_low", "a_high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    distance = F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)
    met = a.join(b, same_cell).filter((F.col("a_interval") <= F.col("b_interval")) & (distance <= eps * eps + SLACK))
    return met.select(F.col("a_interval").alias("i"), F.col("b_interval").alias("j")).distinct()


def ego_join(a: np.ndarray, b: np.ndarray | None, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= threshold between two intervals, or within one (b is None, left index < right)."""
    reach = 2 - 2 * threshold + SLACK
    left = a @ axes
    right = left if b is None else b @ axes
    other = a if b is None else b
    rows, columns = [], []

    def far(a0: int, a1: int, b0: int, b1: int) -> bool:
        x, y = left[a0:a1], right[b0:b1]
        gap = np.maximum(np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)), 0)
        return float(gap @ gap) > reach

    todo = [(0, len(a), 0, len(other))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        same = b is None and a0 == b0 and a1 == b1
        if not same and far(a0, a1, b0, b1):
            continue
        if max(a1 - a0, b1 - b0) <= LEAF:
            i, j = np.nonzero(a[a0:a1] @ other[b0:b1].T >= threshold)
            if same:
                i, j = i[i < j], j[i < j]
            rows.append(i + a0)
            columns.append(j + b0)
        elif same:
            m = (a0 + a1) // 2
            todo += [(a0, m, a0, m), (a0, m, m, a1), (m, a1, m, a1)]
        elif a1 - a0 >= b1 - b0:
            m = (a0 + a1) // 2
            todo += [(a0, m, b0, b1), (m, a1, b0, b1)]
        else:
            m = (b0 + b1) // 2
            todo += [(a0, a1, b0, m), (a0, a1, m, b1)]
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *rows]), np.concatenate([empty, *columns])


def spanning(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def interval_links(stored: DataFrame, axes: np.ndarray, threshold: float) -> DataFrame:
    """Rows (class, weight) of linked vectors and (class, other) of spanning links, over all close interval pairs."""
    eps = max(math.sqrt(2 - 2 * threshold), SLACK)
    sent = stored.sparkSession.sparkContext.broadcast(axes[:, :BOX_DIMENSIONS].copy())
    pairs = close_pairs(stored.select("interval", "low", "high"), eps)

    def side(name: str, prefix: str) -> DataFrame:
        return stored.select(F.col("interval").alias(name), *(F.col(c).alias(prefix + c) for c in ("ids", "sizes", "vectors")))

    met = pairs.join(side("i", "a_"), "i").join(side("j", "b_"), "j")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row] for c in batch.schema.names}
                ids, sizes, vectors = ({s: one[s + c].values.to_numpy() for s in ("a_", "b_")} for c in ("ids", "sizes", "vectors"))
                a = unit(vectors["a_"].astype(np.float64).reshape(len(ids["a_"]), -1))
                if one["i"] == one["j"]:
                    i, j = ego_join(a, None, sent.value, threshold)
                    names, weights = ids["a_"], sizes["a_"]
                else:
                    b = unit(vectors["b_"].astype(np.float64).reshape(len(ids["b_"]), -1))
                    i, j = ego_join(a, b, sent.value, threshold)
                    j = j + len(a)
                    names, weights = (np.concatenate([x["a_"], x["b_"]]) for x in (ids, sizes))
                if not len(i):
                    continue
                n = len(names)
                linked = np.bincount(i, weights[j], n) + np.bincount(j, weights[i], n)
                root = spanning(n, i, j)
                has, child = np.nonzero(linked)[0], np.nonzero(root != np.arange(n))[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([names[has], names[child]])),
                        pa.array([*linked[has].astype(np.int64).tolist(), *[None] * len(child)], pa.int64()),
                        pa.array([*[None] * len(has), *names[root[child]].tolist()], pa.int64()),
                    ],
                    names=["class", "weight", "other"],
                )

    return met.mapInArrow(work, "class long, weight long, other long")


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    interval: int = INTERVAL,
) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept).

    Vectors link when their cosine in double precision is at least ``threshold`` (above 0, at most 1).  ``n_links``
    counts the other rows linked directly, ``component_id`` is the smallest id reachable, ``kept`` marks the row with
    that id.  A vector that is null, zero or holds null or non-finite components links with nothing and is kept; vectors
    of different lengths never link, and those of each length are compared in full.  Identical vectors are one class with
    a size throughout, so copies are never paired.  Rows that repeat an id and a vector are linked rows like any copies
    and all kept.  An empty table gives an empty result.
    """
    spark = prepare(vectors.sparkSession)
    vector = column(vectors, vector_col)
    base = vectors.select(column(vectors, id_col).alias("vec_id"), F.when(usable(vector), vector).alias("vector"))
    classes = base.filter("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("size"))
    classes = staged(classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    # A table holds few lengths.  Of a length with one vector only there is nothing to compare.
    lengths = classes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).filter("n > 1").orderBy("d").collect()
    eps = max(math.sqrt(2 - 2 * threshold), SLACK)
    found = spark.createDataFrame([], "class long, weight long, other long")
    for length in lengths:
        own = classes.filter(F.size("vector") == length.d)
        axes = principal_axes(own, length.d)
        cut = intervals(own.select("class", "size", "vector"), axes, eps, interval)
        found = found.unionByName(staged(interval_links(cut, axes, threshold), "vector-links"))
    weights = found.filter("weight is not null").groupBy("class").agg(F.sum("weight").alias("weight"))
    joined = components(found.filter("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b")))
    rooted = classes.join(joined, classes["class"] == joined["node"], "left").select(
        "class", "first", F.coalesce("component", "class").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = staged(
        classes.join(rooted.join(smallest, "root").select("class", "component_id"), "class")
        .join(weights, "class", "left")
        .select("vector", (F.col("size") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"), "component_id"),
        "vector-components",
    )
    linked = base.filter("vector is not null").join(named, "vector").select("vec_id", "n_links", "component_id")
    alone = base.filter("vector is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
