"""Centroid clustering: exact k-means whose stored bounds are loosened by total displacement (ns-bounds).

Every vector keeps, for every centroid, the exact distance at its last
evaluation and the round of that evaluation. Centroids of all rounds are kept.
In a later round the stored distance less the norm of the centroid's total
displacement *since that round* is still a lower bound (triangle inequality);
summing the norms of each round's drift would loosen it more. A centroid whose
bound doesn't exceed the exact distance to the vector's own centroid fails and
is evaluated anew, exactly. Distances are squared Euclidean over integers, so
assignments, ties (smaller number) and updates (componentwise floor of the mean)
don't depend on the order of rows or the number of tasks.

State passes from round to round as a table in the shared folder, vectors with
their bounds, so no shuffle moves a vector. What is shuffled is a sum per task,
centroid and component; what the driver holds is k centroids a round.

Defined cases: vectors that are null, of another length than ``dims``, or hold a
null or non-finite component take no part; a row with a null id is clustered
like any other, but starts no centroid unless ids run out; repeated rows are
vectors of their own (repeated starting centroids tie to the smaller number);
with fewer vectors than k there are as many centroids as vectors; an empty table
gives an empty result; other input columns are ignored, whatever their names. An
integer component beyond 2**26 either way is an error (squared distances of up
to 128 such components fill 64 bits), never a wrong distance.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

LIMIT = 1 << 26
#: Share by which a bound must exceed a distance: above the rounding of square roots.
SLACK = 1e-9

STATE = "vec_id long, vector array<int>, cluster int, distance long, bounds binary, rounds binary, evaluated long"


def grid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, vector) of the rows that take part: floor(scale * component) as integers."""
    x = F.col(vector_col)
    whole = (F.size(x) == dims) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    steps = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    fits = F.forall(steps, lambda v: F.abs(v) <= LIMIT)
    checked = F.when(fits, F.transform(steps, lambda v: v.cast("int"))).otherwise(
        F.raise_error(F.lit("a component is beyond 2**26 steps")).cast("array<int>")
    )
    return vectors.where(x.isNotNull()).where(whole).select(F.col(id_col).cast("long").alias("vec_id"), checked.alias("vector"))


def starts(points: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:id``, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.select(name.alias("h"), "vector").orderBy(F.col("h").asc_nulls_last(), "vector").limit(k).collect()
    return np.array([r.vector for r in rows], np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def evaluate(
    x: np.ndarray, own: np.ndarray, bounds: np.ndarray, rounds: np.ndarray, history: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of the last round for every row of ``x`` and its exact squared distance.

    ``bounds`` (distances) and ``rounds`` (when they were exact) are brought up
    to date in place; the third value is the number of exact evaluations.
    """
    now, k = len(history) - 1, len(history[-1])
    new = history[-1]
    # norm of the whole way each centroid went since each round
    moved = np.stack([np.sqrt(_squared(new, old).astype(np.float64)) for old in history])
    rows = np.arange(len(x))
    near = _squared(x, new[own])
    bounds[rows, own], rounds[rows, own] = np.sqrt(near.astype(np.float64)), now
    least = bounds - moved[rounds, np.arange(k)[None, :]]
    reach = bounds[rows, own]
    fails = least <= (reach * (1 + SLACK) + SLACK)[:, None]
    fails[rows, own] = False
    best, at, count = near.copy(), own.copy(), len(x)
    for j in range(k):
        hit = np.flatnonzero(fails[:, j])
        if not len(hit):
            continue
        d = _squared(x[hit], new[j][None, :])
        bounds[hit, j], rounds[hit, j] = np.sqrt(d.astype(np.float64)), now
        nearer = (d < best[hit]) | ((d == best[hit]) & (j < at[hit]))
        best[hit[nearer]], at[hit[nearer]] = d[nearer], j
        count += len(hit)
    return at, best, count


def _assign(state: DataFrame, history: list[np.ndarray], rows: int = 4096) -> DataFrame:
    """One round: every row of ``state`` to its nearest centroid, its bounds brought up to date."""
    k, dims = history[-1].shape
    first = len(history) == 1

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                n = part.num_rows
                x = _matrix(part.column(1), dims)
                if first:
                    own = np.zeros(n, np.int64)
                    bounds, when = np.zeros((n, k)), np.zeros((n, k), np.uint16)
                else:
                    own = part.column(2).to_numpy().astype(np.int64)
                    bounds = np.frombuffer(b"".join(part.column(4).to_pylist()), "<f8").reshape(n, k).copy()
                    when = np.frombuffer(b"".join(part.column(5).to_pylist()), "<u2").reshape(n, k).copy()
                at, best, count = evaluate(x, own, bounds, when, history)
                counts = np.zeros(n, np.int64)
                counts[0] = count
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(at.astype(np.int32)), pa.array(best),
                        pa.array([b.tobytes() for b in bounds.astype("<f8")], pa.binary()),
                        pa.array([r.tobytes() for r in when.astype("<u2")], pa.binary()), pa.array(counts),
                    ],
                    names=["vec_id", "vector", "cluster", "distance", "bounds", "rounds", "evaluated"],
                )

    return state.mapInArrow(run, STATE)


def _means(state: DataFrame, old: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of every centroid's vectors; empty centroids stay."""
    k, dims = old.shape

    def run(batches):
        # one task's sums; Python integers, as a task's rows may pass 64 bits
        sums, counts = np.zeros((k, dims), object), np.zeros(k, object)
        for batch in batches:
            x, at = _matrix(batch.column(1), dims), batch.column(0).to_numpy()
            for j in np.unique(at).tolist():
                mine = x[at == j]
                sums[j] += mine.sum(axis=0).astype(object)
                counts[j] += len(mine)
        for j in range(k):
            if counts[j]:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(dims, j, np.int32)), pa.array(np.arange(dims, dtype=np.int32)),
                        pa.array([str(v) for v in sums[j]]), pa.array(np.full(dims, int(counts[j]), np.int64)),
                    ],
                    names=["cluster", "place", "total", "n"],
                )

    parts = state.select("cluster", "vector").mapInArrow(run, "cluster int, place int, total string, n long")
    sums = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    new = old.copy()
    for r in sums.collect():  # k x dims rows
        new[r.cluster, r.place] = int(r.total) // r.n
    return new


def fit(points: DataFrame, k: int, rounds: int, seed: int = 1) -> tuple[DataFrame, list[np.ndarray]]:
    """(state after a last assignment, centroids of every round) for integer vectors (vec_id, vector)."""
    points = materialize(points, "points")
    history = [starts(points, k, seed)]
    state = points
    if not len(history[0]):
        empty = points.selectExpr("vec_id", "vector", "0 AS cluster", "0L AS distance", "X'' AS bounds", "X'' AS rounds", "0L AS evaluated")
        return empty.where("false"), history
    for _ in range(rounds):
        state = materialize(_assign(state, history), "assigned")
        history.append(_means(state, history[-1]))
    return materialize(_assign(state, history), "assigned"), history


def clusters(points: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    state, history = fit(points, k, rounds, seed)
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1].tolist()]
    sums = {r.cluster: int(r.s) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    facts = [(j, sums.get(j, 0), sum(sums.values()), mark) for j, mark in enumerate(marks)]
    about = state.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
