"""Lloyd clustering whose assignment step is Fagin's threshold algorithm.

For every dimension the centroids stand in a list sorted by their value. A vector enters each
list at its own value and walks outward, one centroid of every list a round, nearest first. A
centroid seen for the first time gets its exact distance. One not yet seen is, in every
dimension, at least as far as that list's frontier; once the squared frontiers of a vector sum
to strictly more than its best exact distance, the walk ends. Strictly, as a centroid with a
smaller number may still tie.

The centroids (k rows) are all that the driver holds and all that tasks receive. Coordinate sums
leave a task as one row per cluster, dimension and 30-bit limb, so they are exact whatever the
magnitude of the components, and a cluster with most of the vectors is k rows a task like any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolyard.llm.common import durable

#: Components up to this size keep every squared distance of 2^16 dimensions within a long.
SMALL = 1 << 22
LONGEST = (1 << 63) - 1
#: Sums are split in limbs of so many bits; 2^33 tasks can add theirs before a long overflows.
LIMB = 30

SUMS = "cluster int, dim int, limb int, part long"
ASSIGNED = "vec_id long, cluster int, distance long"


def scaled(x: float) -> int:
    """floor(1024 x), also where 1024 x is no finite double."""
    above, below = x.as_integer_ratio()
    return 1024 * above // below


class Lists:
    """The sorted lists of a set of centroids (rows of an integer matrix)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")  # list position -> centroid
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For every vector the nearest centroid, ties to the smaller number, its squared
        distance, and over all vectors the number of exact distances made."""
        n, dims = vectors.shape
        k = len(self.centroids)
        entry = np.empty((n, dims), np.int64)
        for d in range(dims):
            entry[:, d] = np.searchsorted(self.values[:, d], vectors[:, d])
        left, right = entry - 1, entry  # next position on either side of the own value
        seen = np.zeros((n, k), bool)
        best = np.zeros(n, vectors.dtype)
        winner = np.full(n, -1, np.int64)
        live, made = np.arange(n), 0
        columns = np.arange(dims)
        for _ in range(k):
            if not len(live):
                break
            own, lo, hi = vectors[live], left[live], right[live]
            below = own - self.values[np.maximum(lo, 0), columns]
            above = self.values[np.minimum(hi, k - 1), columns] - own
            go_left = (lo >= 0) & ((hi >= k) | (below <= above))
            at = np.where(go_left, lo, hi)
            frontier = np.where(go_left, below, above)
            left[live], right[live] = lo - go_left, hi + ~go_left
            found = np.zeros((len(live), k), bool)
            found[np.arange(len(live))[:, None], self.order[at, columns]] = True
            found &= ~seen[live]
            seen[live] |= found
            for c in range(k):  # in the order of their numbers, so a tie keeps the smaller one
                new = np.flatnonzero(found[:, c])
                if not len(new):
                    continue
                made += len(new)
                rows = live[new]
                away = vectors[rows] - self.centroids[c]
                distance = (away * away).sum(axis=1)
                held = winner[rows]
                closer = (held < 0) | (distance < best[rows]) | ((distance == best[rows]) & (c < held))
                best[rows[closer]], winner[rows[closer]] = distance[closer], c
            reach = (frontier * frontier).sum(axis=1)
            live = live[(reach <= best[live]) & ~seen[live].all(axis=1)]
        return winner, best, made


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as floor(1024 x): longs, or Python integers where longs could overflow."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    if np.abs(values).max(initial=0.0) * 1024 < SMALL:
        return np.floor(values * 1024.0).astype(np.int64)
    return np.array([[scaled(x) for x in row] for row in values.tolist()], object).reshape(values.shape)


def _lists_for(vectors: np.ndarray, small: Lists | None, wide: Lists) -> tuple[np.ndarray, Lists]:
    if small is None or vectors.dtype == object:
        return vectors.astype(object), wide
    return vectors, small


def _prepared(centroids: list[list[int]]) -> tuple[Lists | None, Lists]:
    wide = Lists(np.array(centroids, object))
    fits = all(abs(x) <= SMALL for c in centroids for x in c)
    return (Lists(np.array(centroids, np.int64)) if fits else None), wide


def limbs(total: int) -> list[int]:
    """The integer as signed limbs, lowest first, no zero on top."""
    sign, rest, parts = (-1 if total < 0 else 1), abs(total), []
    while rest:
        parts.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    return parts


def _summing(centroids: list[list[int]], dims: int):
    """Per task: the sum of every cluster's components in limbs; dimension -1 is the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small, wide = _prepared(centroids)
        totals = np.zeros((len(centroids), dims + 1), object)
        for batch in batches:
            vectors, lists = _lists_for(_matrix(batch.column(1), dims), small, wide)
            cluster, _, _ = lists.nearest(vectors)
            for c in np.unique(cluster).tolist():
                own = vectors[cluster == c]
                totals[c, :dims] += own.sum(axis=0).astype(object)
                totals[c, dims] += len(own)
        rows = [
            (c, -1 if d == dims else d, i, part)
            for c in range(len(centroids))
            for d in range(dims + 1)
            for i, part in enumerate(limbs(int(totals[c, d])))
        ]
        ints = [pa.array([r[i] for r in rows], pa.int32()) for i in range(3)]
        parts = pa.array([r[3] for r in rows], pa.int64())
        yield pa.RecordBatch.from_arrays([*ints, parts], names=["cluster", "dim", "limb", "part"])

    return run


def _assigning(centroids: list[list[int]], dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small, wide = _prepared(centroids)
        for batch in batches:
            vectors, lists = _lists_for(_matrix(batch.column(1), dims), small, wide)
            cluster, distance, _ = lists.nearest(vectors)
            held = [min(int(x), LONGEST) for x in distance.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(held, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return run


def moved(centroids: list[list[int]], sums: list) -> list[list[int]]:
    """The centroids after one round: floor(sum / count), an empty one stays."""
    totals: dict[tuple[int, int], int] = {}
    for cluster, dim, limb, part in sums:
        totals[cluster, dim] = totals.get((cluster, dim), 0) + (int(part) << LIMB * limb)
    return [
        [totals.get((c, d), 0) // totals[c, -1] for d in range(len(own))] if totals.get((c, -1)) else own
        for c, own in enumerate(centroids)
    ]


def clusters(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector.

    Vectors with other than `dims` components, or a null or non-finite one, take no part.
    Components are floor(1024 x). Centroids start as the k vectors with the smallest sha256 of
    `seed:id`; a null id comes last, and rows with one id are taken by their components. With
    fewer than k vectors there are fewer centroids; with none the result is empty. Repeated rows
    are vectors of their own. Distances and inertias beyond a long are held at its largest
    value, after the exact comparison. Other columns are not read. `k` and `dims` bound what the
    driver and every task hold; the vectors are written once and read back in each round.
    """
    usable = (F.size("v") == dims) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    own = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    ).filter(F.col("v").isNotNull() & usable)
    own = durable(own)
    ranked = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = own.orderBy(ranked.asc_nulls_last(), "v").limit(k).collect()
    centroids = [[scaled(x) for x in row["v"]] for row in first]
    if centroids:
        for _ in range(rounds):
            sums = own.mapInArrow(_summing(centroids, dims), SUMS)
            after = moved(centroids, sums.groupBy("cluster", "dim", "limb").agg(F.sum("part")).collect())
            if after == centroids:
                break  # every further round is the same
            centroids = after
    else:
        centroids = [[0] * dims]  # nothing to assign
    assigned = durable(own.mapInArrow(_assigning(centroids, dims), ASSIGNED))
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(wide.alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = assigned.sparkSession.createDataFrame(
        [(c, min(sums.get(c, 0), LONGEST), min(sum(sums.values()), LONGEST), digests[c]) for c in range(len(centroids))],
        "number int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), F.col("cluster") == F.col("number")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
