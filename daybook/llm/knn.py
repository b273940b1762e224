"""Exact top-k search by a Voronoi join.

Queries and data are integer vectors scored by inner product, larger first, ties
to the smaller id; a query's own row is no candidate.

1. Of equal vectors only the ``k + 1`` smallest ids can be anyone's answer, so
   the rest of a group of copies leaves the candidates. Equal queries are solved
   once.
2. Pivots come from a bounded sample. Each query belongs to the cell of its
   nearest pivot; a cell's summary is its size and its radius R.
3. For a query q of a cell with pivot p and a vector x, <q, x> lies within
   <p, x> -+ R |x|. The (k + 1)-th largest lower end over all x (kept for each
   cell and task, then merged) is a score that every query of the cell reaches.
4. A vector is sent to the groups of cells in which its upper end reaches that
   score, and to no other. Groups hold about ``group_rows`` queries: small cells
   near each other share one, large ones are split. A group's vectors are dealt
   to blocks of about ``block_rows``, each solved on its own with matrix
   products, and the blocks' answers are merged.

Components shorter than the longest vector count as zero. Scores are exact:
products in float64 while every sum fits 53 bits, in 64-bit integers beyond.

Defined cases: null vectors, vectors with a null component and rows with a null
id take no part; repeated rows count once, and an id with several vectors is a
row for each; a query with fewer than k candidates
gets them all; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as int64, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _pivots(sample: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Centres of ``count`` cells after a few rounds of k-means."""
    at = sample[:: max(1, len(sample) // count)][:count].astype(float)
    for _ in range(rounds):
        own = _nearest(sample, at)[0]
        for c in range(len(at)):
            if (own == c).any():
                at[c] = sample[own == c].mean(axis=0)
    return np.unique(at, axis=0)


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each row and its distance to the pivot."""
    x = x.astype(float)
    own = ((pivots**2).sum(axis=1)[None, :] - 2 * x @ pivots.T).argmin(axis=1)
    return own, np.sqrt(((x - pivots[own]) ** 2).sum(axis=1))


def _groups(sizes: np.ndarray, pivots: np.ndarray, rows: int) -> list[tuple[list[int], int, int]]:
    """(cells, split, splits): cells near each other together up to ``rows`` queries, large cells split."""
    out, left = [], [c for c in np.argsort(-sizes, kind="stable").tolist() if sizes[c]]
    while left:
        seed = left.pop(0)
        splits = -(-int(sizes[seed]) // rows)
        if splits > 1:
            out += [([seed], s, splits) for s in range(splits)]
            continue
        cells, total = [seed], int(sizes[seed])
        for c in sorted(left, key=lambda c: float(((pivots[c] - pivots[seed]) ** 2).sum())):
            if total + sizes[c] <= rows:
                cells.append(c)
                total += int(sizes[c])
                left.remove(c)
        out.append((cells, 0, 1))
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if top < 2**53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def knn_join(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "vector",
    pivots: int = 64,
    sample_rows: int = 4096,
    group_rows: int = 512,
    block_rows: int = 32_768,
    least_blocks: int = 8,
) -> DataFrame:
    """(query_id, rank, id_col, score): the k best rows for every row that ``is_query`` holds for.

    ``vector_col`` is an array of long. ``pivots`` and ``sample_rows`` bound what
    the driver sees of the data.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<bigint>").alias("v"), is_query.alias("q"))
    rows = rows.where("id is not null and v is not null and forall(v, x -> x is not null)").distinct()
    rows = materialize(rows, "vectors")
    # of equal vectors the smallest ids; Spark limits each task's rows of a vector before the shuffle
    copies = Window.partitionBy("v").orderBy("id")
    data = materialize(rows.select("id", "v").distinct().withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1).drop("n"), "data")
    asked = materialize(rows.where("q").groupBy("v").agg(F.min("id").alias("id")), "asked")
    # a vector's name: its smallest id, and its hash in case an id has several vectors
    asked = asked.select("v", F.concat_ws(":", "id", F.xxhash64("v")).alias("key"))
    width, n = data.agg(F.max(F.size("v")), F.count("*")).first()
    if not width or not asked.head(1):
        return _all_zero(rows, data, k, id_col) if n and asked.head(1) else empty
    sample = [r.v for r in data.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(sample_rows).collect()]
    at = _pivots(_matrix(pa.array(sample, pa.list_(pa.int64())), width), pivots)

    # ---- summaries of the query cells
    def summary(batches):
        for batch in batches:
            own, far = _nearest(_matrix(batch.column(0), width), at)
            for c in np.unique(own).tolist():
                yield pa.RecordBatch.from_pydict({"cell": [c], "rows": [int((own == c).sum())], "far": [float(far[own == c].max())]})

    cells = asked.select("v").mapInArrow(summary, "cell long, rows long, far double").groupBy("cell").agg(F.sum("rows"), F.max("far")).collect()
    sizes, radius = np.zeros(len(at), np.int64), np.zeros(len(at))
    for cell, count, far in cells:
        sizes[cell], radius[cell] = count, far
    used = np.flatnonzero(sizes)

    def ends(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper end of the scores of each used cell's queries with each row, widened for rounding."""
        middle, reach = x.astype(float) @ at[used].T, np.sqrt((x.astype(float) ** 2).sum(axis=1))[:, None] * radius[used][None, :]
        slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
        return middle - reach - slack, middle + reach + slack

    def lower(batches):
        best = np.full((len(used), k + 1), -np.inf)
        for batch in batches:
            low = np.concatenate((best, ends(_matrix(batch.column(0), width))[0].T), axis=1)
            best = -np.partition(-low, k, axis=1)[:, : k + 1]
        where, _ = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_pydict({"cell": pa.array(where), "low": pa.array(best[np.isfinite(best)])})

    ranked = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("low")))
    lows = data.select("v").mapInArrow(lower, "cell long, low double").withColumn("n", ranked).where(F.col("n") == k + 1).collect()
    reached = np.full(len(used), -np.inf)  # fewer than k + 1 rows: everything is sent
    for r in lows:
        reached[r.cell] = r.low

    # ---- rows to groups, groups to blocks
    groups = _groups(sizes, at, group_rows)
    place = {int(c): i for i, c in enumerate(used)}
    # small tables are spread as well; each block answers each of its queries, so no more than that
    blocks = max(-(-n // block_rows), min(least_blocks, n))
    homes: dict[int, list[int]] = {}
    for g, (members, _, _) in enumerate(groups):
        for c in members:
            homes.setdefault(c, []).append(g)
    members = [[place[c] for c in cells] for cells, _, _ in groups]

    def send(batches):
        for batch in batches:
            x = _matrix(batch.column(1), width)
            wanted = ends(x)[1] >= reached[None, :]
            for g, own in enumerate(members):
                some = pa.array(np.flatnonzero(wanted[:, own].any(axis=1)))
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), g)), batch.column(2).take(some), batch.column(0).take(some), batch.column(1).take(some)],
                        names=["g", "block", "id", "v"],
                    )

    def ask(batches):
        for batch in batches:
            own, _ = _nearest(_matrix(batch.column(1), width), at)
            turn = batch.column(2).to_numpy()
            g = np.array([homes[c][t % len(homes[c])] for c, t in zip(own.tolist(), turn.tolist())], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(g), batch.column(0), batch.column(1)], names=["g", "key", "v"])

    sent = data.select("id", "v", F.pmod(F.xxhash64("v", "id"), F.lit(blocks)).alias("block")).mapInArrow(send, "g long, block long, id long, v array<long>")
    asks = asked.select("key", "v", F.pmod(F.xxhash64("v"), F.lit(1 << 30)).alias("turn")).mapInArrow(ask, "g long, key string, v array<long>")
    asks = asks.select("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "key", "v")
    both = asks.withColumn("side", F.lit(0)).unionByName(sent.withColumn("side", F.lit(1)), allowMissingColumns=True)

    def solve(batches):
        key, q, qid, qparts, best = None, None, [], [], None

        def done():
            if best is None or not len(best):
                return None
            keys = [key for key, (scores, _) in zip(qid, best) for _ in scores]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array(np.concatenate([b[c] for b in best])) for c in (0, 1))], names=["key", "score", "id"]
            )

        for batch in batches:
            g, block, side = (batch.column(c).to_numpy() for c in (0, 1, 4))
            cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(block) != 0) | (np.diff(side) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if lo == hi:
                    continue
                now = (int(g[lo]), int(block[lo]))
                if now != key:
                    if (out := done()) is not None:
                        yield out
                    key, q, qid, qparts, best = now, None, [], [], None
                x = _matrix(batch.column(3).slice(lo, hi - lo), width)
                if side[lo] == 0:
                    qid += batch.column(5).slice(lo, hi - lo).to_pylist()
                    qparts.append(x)
                    continue
                ids = batch.column(2).slice(lo, hi - lo).to_numpy()
                if q is None and qparts:
                    q = np.concatenate(qparts)
                    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in qid]
                if q is None:
                    continue
                for a in range(0, len(ids), 4096):
                    scores, part = _products(q, x[a : a + 4096]), ids[a : a + 4096]
                    for i in range(len(q)):
                        held, names = best[i]
                        new = scores[i]
                        if len(held) > k:
                            some = np.flatnonzero(new >= held[-1])
                            if not len(some):
                                continue
                            s, d = np.concatenate((held, new[some])), np.concatenate((names, part[some]))
                        else:
                            s, d = np.concatenate((held, new)), np.concatenate((names, part))
                        keep = _best(s, d, k + 1)
                        best[i] = (s[keep], d[keep])
        if (out := done()) is not None:
            yield out

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.select("g", "block", "id", "v", "side", "key").repartition(parts, "g", "block").sortWithinPartitions("g", "block", "side")
    found = dealt.mapInArrow(solve, "key string, score long, id long")
    merged = found.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id"))).where(F.col("n") <= k + 1)
    return _answers(rows, asked, materialize(merged.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("top")), "tops"), k, id_col)


def _answers(rows: DataFrame, asked: DataFrame, tops: DataFrame, k: int, id_col: str) -> DataFrame:
    """Every query's own answer: its vector's k + 1 best without its own row."""
    squares = F.aggregate("v", F.lit(0).cast("long"), lambda total, x: total + x * x)
    queries = rows.where("q").select(F.col("id").alias("query_id"), "v").join(asked, "v").select("query_id", "key", squares.alias("self"))
    own = F.array_min(F.transform(F.filter("top", lambda x: (x["id"] == F.col("query_id")) & (x["score"] == F.col("self"))), lambda x: x["n"]))
    found = queries.join(tops, "key").withColumn("own", F.coalesce(own, F.lit(0)))
    mine = F.slice(F.filter("top", lambda x: x["n"] != F.col("own")), 1, k)
    return found.select("query_id", F.posexplode(mine).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_col), F.col("hit.score").alias("score")
    )


def _all_zero(rows: DataFrame, data: DataFrame, k: int, id_col: str) -> DataFrame:
    """Vectors without components: every score is 0, so the smallest ids win."""
    ranked = data.orderBy("id").limit(k + 1).withColumn("n", F.row_number().over(Window.orderBy("id")))
    hit = F.struct("n", "id", F.lit(0).cast("long").alias("score"))
    tops = ranked.groupBy(F.lit("").alias("key")).agg(F.array_sort(F.collect_list(hit)).alias("top"))
    asked = rows.where("q").select("v").distinct().withColumn("key", F.lit(""))
    return _answers(rows, asked, tops, k, id_col)
