"""Centroid clustering of integer vectors by exact k-means with Shallot search.

Every vector keeps, between rounds, its centroid ``a``, the centroid it last found second nearest ``b``,
an upper bound ``u`` on its distance to ``a`` and a lower bound ``l`` on its distance to every other
centroid. After centroids move, ``u`` grows by ``a``'s shift and ``l`` shrinks by the largest shift of
the others. Where ``u`` stays under ``l`` (or under half the distance from ``a`` to its nearest other
centroid) the vector keeps ``a`` without any distance computed. Otherwise the exact distances to ``a`` and
``b`` are computed; the search starts from the closer of the two, ``c``, and scans ``c``'s neighbours in
the order of their distance to ``c``. A centroid nearer than the best found so far lies within the
distance of ``x`` to ``c`` plus that best distance from ``c``, so that ball shrinks as better centroids
are met and the scan stops at its edge. The
survivors are compared by exact integer squared distances, ties going to the smaller centroid number;
floating point bounds only decide what can be skipped, with a margin, so they never change a result.

Spark work: each round is one pass of ``mapInArrow`` over the vectors with the centroids (``k x d``
integers, a size fixed by the parameters) in the closure, written to the shared checkpoint folder and read
back so that lineage stays one round deep; the previous round's table is then deleted. New centroids come
from one grouping with partial aggregation: at most ``k`` rows reach the driver.

Edge cases: vectors of another length, with a null or non-finite component, or null are left out; rows
with a null ``vec_id`` are clustered like others and keep their null id, but have no starting hash and
come after all others when centroids are chosen; repeated rows are all clustered.
Ties among the starting hashes (repeated ids) go to the smaller vector, compared component by component.
With fewer kept vectors than ``k``, all of them start as centroids. An empty table gives no rows. Extra
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditframe.session import ensure_checkpoint_dir

STATE = "vec_id long, p array<int>, a int, b int, u double, l double"


def _centre_geometry(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distances between centroids, each one's neighbours nearest first, and half the nearest distance."""
    squares = (centres * centres).sum(axis=1)
    between = np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * centres @ centres.T, 0).astype(np.float64))
    order = np.lexsort((np.broadcast_to(np.arange(len(centres)), between.shape), between), axis=1)
    ranked = np.take_along_axis(between, order, axis=1)
    others = between + np.diag(np.full(len(centres), np.inf))
    return between, order, ranked, others.min(axis=1) / 2


def _exact(x: np.ndarray, centres: np.ndarray, which: np.ndarray) -> np.ndarray:
    d = x - centres[which]
    return np.einsum("ij,ij->i", d, d)


def _before(d1, c1, d2, c2):
    """Whether (distance, number) pairs of the first kind come before those of the second."""
    return (d1 < d2) | ((d1 == d2) & (c1 < c2))


def assign(x: np.ndarray, centres: np.ndarray, shifts: np.ndarray | None, a, b, u, l):  # noqa: E741
    """New ``a, b, u, l`` and exact squared distances of vectors ``x`` (int64, n x d)."""
    n, k = len(x), len(centres)
    never = np.iinfo(np.int64).max
    margin = lambda v: 1e-9 * (1.0 + np.abs(v))
    _, order, ranked, half = _centre_geometry(centres)
    if shifts is None:
        a, b = np.zeros(n, np.int64), np.zeros(n, np.int64)
        u, l = np.full(n, np.inf), np.full(n, -np.inf)  # noqa: E741
    else:
        top = np.argsort(-shifts, kind="stable")
        largest_other = np.where(a == top[0], shifts[top[1]] if k > 1 else 0.0, shifts[top[0]])
        u, l = u + shifts[a], l - largest_other  # noqa: E741
    stay = (u + margin(u) < l) | (u + margin(u) < half[a])
    todo = np.flatnonzero(~stay)
    a, b, u, l = a.copy(), b.copy(), u.copy(), l.copy()  # noqa: E741
    dist = np.zeros(n, np.int64)
    if len(todo):
        xs, at, bt = x[todo], a[todo], b[todo]
        da, db = _exact(xs, centres, at), _exact(xs, centres, bt)
        first = _before(da, at, db, bt) | (at == bt)
        best, best_c = np.where(first, da, db), np.where(first, at, bt)
        second = np.where(at == bt, never, np.where(first, db, da))
        second_c = np.where(at == bt, -1, np.where(first, bt, at))
        c, reach = best_c.copy(), np.sqrt(best.astype(np.float64))
        bound = np.full(len(todo), np.inf)
        live = np.ones(len(todo), bool)
        for t in range(k):
            # Every centroid nearer to x than the best so far lies within reach + sqrt(best) of c.
            radius = reach + np.sqrt(best.astype(np.float64))
            inside = ranked[c, t] <= radius + margin(radius)
            ending = live & ~inside
            bound[ending] = ranked[c[ending], t] - reach[ending]
            live &= inside
            idx = np.flatnonzero(live)
            if not len(idx):
                break
            jj = order[c[idx], t]
            dj = _exact(xs[idx], centres, jj)
            known = (jj == best_c[idx]) | (jj == second_c[idx])
            better = ~known & _before(dj, jj, best[idx], best_c[idx])
            middle = ~known & ~better & _before(dj, jj, second[idx], second_c[idx])
            up, mid = idx[better], idx[middle]
            second[up], second_c[up] = best[up], best_c[up]
            best[up], best_c[up] = dj[better], jj[better]
            second[mid], second_c[mid] = dj[middle], jj[middle]
        a[todo], dist[todo] = best_c, best
        u[todo] = np.sqrt(best.astype(np.float64))
        seen = np.where(second == never, np.inf, np.sqrt(np.minimum(second, 2**62).astype(np.float64)))
        l[todo] = np.minimum(seen, bound)
        b[todo] = np.where(second == never, best_c, second_c)
    kept = np.flatnonzero(stay)
    if len(kept):
        dist[kept] = _exact(x[kept], centres, a[kept])
    return a, b, u, l, dist


def _round(centres: np.ndarray, shifts: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p = batch.column(1)
            x = p.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, centres.shape[1])
            col = lambda i, kind: batch.column(i).to_numpy(zero_copy_only=False).astype(kind)
            a, b, u, l, _ = assign(x, centres, shifts, col(2, np.int64), col(3, np.int64), col(4, np.float64), col(5, np.float64))  # noqa: E741
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), p, pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(u), pa.array(l)],
                names=["vec_id", "p", "a", "b", "u", "l"],
            )

    return run


def _final(centres: np.ndarray, shifts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, centres.shape[1])
            col = lambda i, kind: batch.column(i).to_numpy(zero_copy_only=False).astype(kind)
            a, _, _, _, dist = assign(x, centres, shifts, col(2, np.int64), col(3, np.int64), col(4, np.float64), col(5, np.float64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, pa.int32()), pa.array(dist, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def integer_vectors(embeddings: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``p``: floor(scale * x) of each component, of vectors of ``dim`` finite components."""
    v = F.col(f"`{vector_col}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    scaled = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    return embeddings.where(v.isNotNull() & (F.size(v) == dim) & finite).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), scaled.alias("p"))


def starting_centres(vectors: DataFrame, k: int, dim: int, seed: int = 2) -> np.ndarray:
    """The ``k`` vectors of smallest SHA-256 of ``<seed>:<vec_id>``, in that order (a top-k, not a collect)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("h"), "p").orderBy(F.col("h").asc_nulls_last(), "p").limit(k).collect()
    return np.array([r.p for r in rows], np.int64).reshape(len(rows), dim)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cluster(embeddings: DataFrame, *, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2, **columns) -> tuple[DataFrame, np.ndarray]:
    """Per vector ``vec_id, cluster, distance`` after ``rounds`` updates, and the final centroids."""
    spark = embeddings.sparkSession
    vectors = integer_vectors(embeddings, dim=dim, scale=scale, **columns)
    centres = starting_centres(vectors, k, dim, seed)
    if not len(centres):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centres
    folder = f"{ensure_checkpoint_dir(spark)}/centroids-{uuid.uuid4().hex}"
    state = vectors.select("vec_id", "p", F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0.0).alias("u"), F.lit(0.0).alias("l"))
    shifts, previous = None, None
    for r in range(rounds):
        path = f"{folder}/round-{r}"
        state.mapInArrow(_round(centres, shifts), STATE).write.parquet(path)
        if previous:
            _delete(spark, previous)
        state, previous = spark.read.parquet(path), path
        sums = state.groupBy("a").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(dim)]).collect()
        moved = centres.copy()
        for row in sums:
            total = np.array([row[f"s{i}"] for i in range(dim)], np.int64)
            moved[row["a"]] = np.floor_divide(total, row["n"])
        shifts = np.sqrt(((moved - centres) ** 2).sum(axis=1).astype(np.float64))
        centres = moved
    result = state.mapInArrow(_final(centres, shifts if shifts is not None else np.zeros(len(centres))), "vec_id long, cluster int, distance long")
    return result, centres


def with_inertia(assigned: DataFrame, centres: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; the per-cluster table has at most ``k`` rows."""
    spark = assigned.sparkSession
    per = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    table = [
        (c, int(per.get(c, 0)), hashlib.sha256(",".join(str(int(x)) for x in centres[c]).encode()).hexdigest())
        for c in range(len(centres))
    ]
    small = spark.createDataFrame(table, "cluster int, cluster_inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(small), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(int(sum(per.values()))).cast("long").alias("inertia"), "centroid_sha256"
    )
