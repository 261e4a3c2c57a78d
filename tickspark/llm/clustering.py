"""Centroid clustering in exact integers, with a vantage-point tree over the centroids.

Each component x of a vector becomes the integer floor(scale * x). A round sends every vector to its nearest centroid and puts
the componentwise floor of the mean in every centroid's place. The centroids (k of them, a parameter, so a bounded table) are
put in a vantage-point tree by the driver each round and shipped with the tasks: a node is a centroid, with the smallest
and largest distance from it to the centroids of its inner and its outer half.

A task searches best first: each vector opens the node with the smallest lower bound next, takes the exact squared distance to
its centroid, and gives the halves the bounds that follow from the triangle inequality. It stops when the smallest bound lies
beyond the best distance. The vectors of a batch do this side by side, and those that open the same node share one matrix
product. Bounds are floating-point numbers and are lowered by a margin beyond their rounding, and a half at just the best
distance is still opened, so that a centroid at an equal distance with a smaller number is always found.

Vectors never move: a task sums components by cluster, and only k rows of sums a task are shuffled.

Defined cases: vectors that are null, have another number of components, or a null, NaN or infinite one are left out; rows and
ids may repeat and each counts; a null id hashes as ``null``; with fewer vectors than k there are as many centroids as vectors;
equal centroids are legal (the smaller number wins, the others stay empty and keep their place); an empty table gives an empty
result; other columns are not read. Components must be below 2^26 after scaling, so that distances fit a long: larger ones
raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import cut

#: Largest component, scaled, of which the squared distance of up to 512 components fits a long.
LARGEST = 1 << 26
#: Bounds are lowered by this share, far above what rounding adds.
MARGIN = 1e-9


class VpTree:
    """Nodes are centroids in the order in which they were placed; halves are given by node number, -1 for none."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.node, self.child, self.near, self.far = [], [], [], []  # a row a node; child, near and far for the inner and outer half
        if len(centroids):
            self._place(np.arange(len(centroids)))
        self.node, self.child = np.array(self.node, np.int64), np.array(self.child, np.int64).reshape(-1, 2)
        self.near, self.far = np.array(self.near, float).reshape(-1, 2), np.array(self.far, float).reshape(-1, 2)

    def _place(self, numbers: np.ndarray) -> int:
        at, rest = len(self.node), numbers[1:]
        self.node.append(int(numbers[0]))
        self.child.append([-1, -1])
        self.near.append([0.0, 0.0])
        self.far.append([0.0, 0.0])
        d = squared(self.centroids[rest], self.centroids[numbers[0]])
        order = np.argsort(d, kind="stable")
        for half, part in enumerate((order[: len(order) // 2 + len(order) % 2], order[len(order) // 2 + len(order) % 2 :])):
            if len(part):
                self.near[at][half], self.far[at][half] = float(np.sqrt(d[part].min())), float(np.sqrt(d[part].max()))
                self.child[at][half] = self._place(rest[part])
        return at

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of each row, its squared distance, and how many distances were taken."""
        n, nodes = len(x), len(self.node)
        best, number, taken = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.centroids), np.int64), 0
        bound = np.full((n, nodes), np.inf)
        bound[:, 0] = 0.0
        active = np.arange(n)
        while len(active):
            nxt = bound[active].argmin(axis=1)
            low = bound[active, nxt]
            radius = np.sqrt(best[active].astype(float))
            go = np.isfinite(low) & (low * (1 - MARGIN) <= radius * (1 + MARGIN))  # inclusive: ties are opened
            active, nxt = active[go], nxt[go]
            order = np.argsort(nxt, kind="stable")
            active, nxt = active[order], nxt[order]
            for part in np.split(np.arange(len(nxt)), np.flatnonzero(np.diff(nxt)) + 1):
                if not len(part):
                    continue
                rows, at = active[part], int(nxt[part[0]])
                c = self.node[at]
                d = squared(x[rows], self.centroids[c])
                taken += len(rows)
                better = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
                best[rows[better]], number[rows[better]] = d[better], c
                root = np.sqrt(d.astype(float))
                above = bound[rows, at]
                bound[rows, at] = np.inf
                for half in (0, 1):
                    if (to := self.child[at, half]) >= 0:
                        low = np.maximum(root * (1 - MARGIN) - self.far[at, half] * (1 + MARGIN), self.near[at, half] * (1 - MARGIN) - root * (1 + MARGIN))
                        bound[rows, to] = np.maximum(above, low)
        return number, best, taken


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    d = rows - point
    return np.einsum("ij,ij->i", d, d)


def integers(vectors: DataFrame, components: int, scale: int, column: str = "embedding") -> DataFrame:
    """vec_id, v: the vectors that count, as integers."""
    good = F.coalesce(F.size(column) == components, F.lit(False)) & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(good).select("vec_id", F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))
    fits = F.forall("v", lambda x: F.abs(x) < LARGEST)
    return rows.select("vec_id", F.when(fits, F.col("v")).otherwise(F.raise_error(F.lit("a component is too large for exact distances"))).cast("array<int>").alias("v"))


def matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes; equal ids by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    found = rows.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()  # k rows
    return np.array([r.v for r in found], np.int64)


def sums_by_cluster(rows: DataFrame, centroids: np.ndarray) -> list:
    """cluster, n, and the sum of each component, of the non-empty clusters."""
    tree, k = VpTree(centroids), len(centroids)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
        for part in parts:
            if part.num_rows:
                x = matrix(part.column(0))
                number, _, _ = tree.search(x)
                order = np.argsort(number, kind="stable")
                here, starts = np.unique(number[order], return_index=True)
                total[here] += np.add.reduceat(x[order], starts)
                count += np.bincount(number, minlength=k)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(held, pa.int32()), "n": pa.array(count[held]), "total": pa.array(total[held].tolist(), pa.list_(pa.int64()))})

    parts = rows.select("v").mapInArrow(add, "cluster int, n long, total array<long>")
    n, exact = F.col("n").cast("decimal(38,0)"), lambda i: F.get("total", F.lit(i)).cast("decimal(38,0)")
    return parts.groupBy("cluster").agg(F.sum(n).alias("n"), F.array(*[F.sum(exact(i)) for i in range(centroids.shape[1])]).alias("total")).collect()  # at most k rows


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance."""
    tree = VpTree(centroids)

    def nearest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                number, best, _ = tree.search(matrix(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number, pa.int32()), pa.array(best)], ["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "v").mapInArrow(nearest, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int, rounds: int, components: int = 64, scale: int = 256, seed: int = 2) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every vector that counts, and the centroids."""
    rows = cut(integers(vectors, components, scale), "vectors")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        for r in sums_by_cluster(rows, centroids):
            centroids[r.cluster] = [int(t) // int(r.n) for t in r.total]
    return assign(rows, centroids), centroids


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the inertia of its cluster and of all, and the digest of the final centroid."""
    spark = assigned.sparkSession
    assigned = cut(assigned, "assigned")
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    known = spark.createDataFrame(pd.DataFrame(digests, columns=["cluster", "centroid_sha256"]), "cluster int, centroid_sha256 string") if digests else spark.createDataFrame([], "cluster int, centroid_sha256 string")
    by = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_i"))  # at most k rows
    whole = by.agg(F.sum("_i").cast("long").alias("inertia"))
    per = by.select("cluster", F.col("_i").cast("long").alias("cluster_inertia")).join(F.broadcast(known), "cluster").crossJoin(F.broadcast(whole))
    return assigned.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
