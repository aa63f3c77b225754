"""Approximate nearest neighbours by few stable projections and kd-trees.

Unit vectors are projected on ``dims`` Gaussian directions: if two vectors are
d apart, their squared projected distance over d squared follows a chi-square
law with ``dims`` degrees of freedom.  Candidates are verified on the original
vectors in the order of their projected distance, and a search stops once a
projected distance r to everything left has r^2 > q d_k^2, where d_k is the
distance of the k-th best so far and q the law's ``confidence`` quantile: a
closer vector would lie that far out with probability 1 - confidence.

The index has two levels.  A kd-tree fitted on a bounded sample cuts the
projected space into regions (blocks of bounded size, large regions being
salted); inside a block a kd-tree over all its vectors gives leaves in the
order of their distance.  A query first searches its own region, which gives
d_k, then only the regions that the chi-square test leaves open; in a leaf it
verifies only the vectors that the test leaves open one by one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewstar.llm.tables import by_batch, hash_share, importable, written


def chi_square_quantile(confidence: float, dims: int) -> float:
    """Quantile for an even number of degrees of freedom (closed form, bisected)."""
    def below(x: float) -> float:
        return 1.0 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
    lo, hi = 0.0, 1.0
    while below(hi) < confidence:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < confidence else (lo, mid)
    return hi


def _leaves(points: np.ndarray, size: int, depth: int | None = None) -> list[np.ndarray]:
    """kd-tree leaves: rows split at the median of the widest side, down to ``size`` rows (or ``depth`` cuts)."""
    out, stack = [], [(np.arange(len(points)), 0)]
    while stack:
        rows, level = stack.pop()
        own = points[rows]
        wide = own.max(axis=0) - own.min(axis=0) if len(rows) else np.zeros(1)
        if len(rows) <= size or wide.max() == 0 or level == depth:
            out.append(rows)
            continue
        axis = int(wide.argmax())
        half = np.argpartition(own[:, axis], len(rows) // 2)
        stack += [(rows[half[:len(rows) // 2]], level + 1), (rows[half[len(rows) // 2:]], level + 1)]
    return out


@dataclass
class Regions:
    """A kd-tree of cuts over the projected space; region boxes reach to infinity at the rim."""

    axis: np.ndarray   # per inner node, heap order
    cut: np.ndarray
    low: np.ndarray    # (regions, dims)
    high: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, depth: int, dims: int) -> "Regions":
        inner = (1 << depth) - 1
        axis, cut = np.zeros(inner, np.int64), np.zeros(inner)
        low = np.full((2 * inner + 1, dims), -np.inf)
        high = np.full((2 * inner + 1, dims), np.inf)
        held = {0: sample}
        for node in range(inner):
            own = held.pop(node)
            k = int(np.ptp(own, axis=0).argmax()) if len(own) else 0
            c = float(np.median(own[:, k])) if len(own) else 0.0
            axis[node], cut[node] = k, c
            for child, left in ((2 * node + 1, True), (2 * node + 2, False)):
                low[child], high[child] = low[node], high[node]
                (high if left else low)[child, k] = c
                held[child] = own[(own[:, k] < c) == left] if len(own) else own
        return cls(axis, cut, low[inner:], high[inner:])

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        inner = len(self.axis)
        while inner and (node < inner).any():
            right = points[np.arange(len(points)), self.axis[node]] >= self.cut[node]
            node = 2 * node + 1 + right
        return node - inner

    def reach(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of every point to every region's box."""
        out = np.zeros((len(points), len(self.low)))
        for k in range(points.shape[1]):
            x = points[:, k:k + 1]
            out += np.maximum(np.maximum(self.low[None, :, k] - x, x - self.high[None, :, k]), 0) ** 2
        return out


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _search(ids: np.ndarray, data: np.ndarray, near: np.ndarray, q_ids: np.ndarray, queries: np.ndarray,
            q_near: np.ndarray, bound: np.ndarray, k: int, quantile: float, leaf: int):
    """(query row, data row) of the candidates kept, and the number of pairs verified: per query the best found
    in this block.

    ``bound`` is the squared distance of the k-th best known from elsewhere.
    """
    spare = k + 7  # a few more than asked, so that exact scores settle the order of near ties
    leaves = _leaves(near, leaf)
    low = np.stack([near[r].min(axis=0) for r in leaves])
    high = np.stack([near[r].max(axis=0) for r in leaves])
    far = np.zeros((len(q_ids), len(leaves)))
    for d in range(near.shape[1]):
        x = q_near[:, d:d + 1]
        far += np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0) ** 2
    order = np.argsort(far, axis=1, kind="stable")
    best = np.full((len(q_ids), spare), -np.inf)
    where = np.full((len(q_ids), spare), -1)
    active, verified = np.arange(len(q_ids)), 0
    for step in range(len(leaves)):
        # The k-th best is sought among others than the query itself, which may be in the block.
        own = np.partition(best, spare - k - 1, axis=1)[:, spare - k - 1] if spare > k else best[:, 0]
        limit = np.minimum(bound, np.maximum(2 - 2 * own, 0))
        active = active[far[active, order[active, step]] <= quantile * limit[active]]
        if not len(active):
            break
        chosen = order[active, step]
        for one in np.unique(chosen):
            q, rows = active[chosen == one], leaves[one]
            apart = (q_near[q] ** 2).sum(1)[:, None] + (near[rows] ** 2).sum(1) - 2 * (q_near[q] @ near[rows].T)
            open_ = apart <= quantile * limit[q][:, None] + 1e-9
            rows, open_ = rows[open_.any(axis=0)], open_[:, open_.any(axis=0)]
            verified += int(open_.sum())
            merged = np.concatenate([best[q], np.where(open_, queries[q] @ data[rows].T, -np.inf)], axis=1)
            from_rows = np.concatenate([where[q], np.broadcast_to(rows, (len(q), len(rows)))], axis=1)
            top = np.argpartition(-merged, spare - 1, axis=1)[:, :spare]
            best[q] = np.take_along_axis(merged, top, axis=1)
            where[q] = np.take_along_axis(from_rows, top, axis=1)
    q, c = np.nonzero((where >= 0) & np.isfinite(best))
    return q, where[q, c], verified


#: Projections, confidence of the stopping test, and rows a block may have before it is salted.
DIMS, CONFIDENCE, MOST_BLOCK_ROWS = 32, 0.9, 65_536


def neighbours(vectors: DataFrame, k: int = 5, every: int = 50, dims: int = DIMS, confidence: float = CONFIDENCE,
               block_rows: int = 4096, sample_rows: int = 50_000, query_rows: int = 20_000, leaf: int = 64,
               id_column: str = "vec_id", vector_column: str = "embedding", seed: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine): the ``k`` nearest found of every row whose id is
    divisible by ``every``, among all other rows; ties go to the smaller id.

    Vectors that are null, zero, or hold a null or non-finite component take no
    part, nor do rows without id and vectors of another length than most.  Of
    rows that repeat an id the smallest vector counts.  Of equal vectors only
    the k + 1 smallest ids can be anyone's k nearest, so the rest is left out
    of the blocks.  An empty table gives no rows.  Other columns are not read.

    Bounds: the regions are fitted on about ``sample_rows`` projected vectors
    (every vector is indexed); a task holds about ``block_rows`` vectors, at
    most about MOST_BLOCK_ROWS once the regions are as many as the sample
    allows, and ``query_rows`` queries.  Only blocks with more queries are
    copied, once per portion of them.
    """
    spark = vectors.sparkSession
    importable(spark)
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0)) \
        .groupBy("id").agg(F.min("v").alias("v"))
    rows = written(rows, "vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("m")) \
        .orderBy(F.desc("m"), "n").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not lengths:
        return empty
    length = lengths[0]["n"]
    rows = rows.where(F.size("v") == length)
    directions = np.random.default_rng(seed).normal(size=(length, dims))
    copies = Window.partitionBy(F.xxhash64("v"), F.hash("v")).orderBy("id")
    listed = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("id", "v")

    def project(batch):
        x = _unit(_matrix(batch.column("v"), batch.num_rows)) @ directions
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("v"),
             pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * dims, pa.array(x.ravel()))], ["id", "v", "p"])

    schema = "id long, v array<double>, p array<double>"
    index = written(by_batch(listed, project, schema), "projected")
    asked = written(by_batch(rows.where(F.pmod("id", F.lit(every)) == 0), project, schema), "queries")
    total, n_queries = index.count(), asked.count()
    if not n_queries:
        return empty
    sample = np.array([r["p"] for r in hash_share(index.select("id", "p"), F.col("id"), F.lit(float(sample_rows)),
                                                  F.lit(total)).collect()], dtype=np.float64).reshape(-1, dims)
    depth = max(0, math.ceil(math.log2(max(total / block_rows, 1))))
    depth = min(depth, max(0, int(math.log2(max(len(sample) / 8, 1)))))
    regions = Regions.fit(sample, depth, dims)
    shared = spark.sparkContext.broadcast(regions)
    salts = max(1, math.ceil(total / (max(block_rows, MOST_BLOCK_ROWS) << depth)))
    quantile = chi_square_quantile(confidence, dims)

    def locate(batch):
        block = shared.value.of(_matrix(batch.column("p"), batch.num_rows))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block.astype(np.int32))], [*batch.schema.names, "block"])

    blocks = by_batch(index, locate, schema + ", block int") \
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        x, y = _matrix(left["v"], left.num_rows), _matrix(right["v"], right.num_rows)
        u, w = _unit(x), _unit(y)
        ids, q_ids = left["id"].to_numpy(), right["id"].to_numpy()
        bound = right["bound"].to_numpy()
        q, c, _ = _search(ids, u, _matrix(left["p"], left.num_rows), q_ids, w, _matrix(right["p"], right.num_rows),
                       bound, k, quantile, leaf)
        keep = ids[c] != q_ids[q]
        q, c = q[keep], c[keep]
        norm_x, norm_y = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", y, y))
        score = np.einsum("ij,ij->i", y[q], x[c]) / (norm_y[q] * norm_x[c])
        order = np.lexsort((ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        top = place < k
        return pa.table({"query_id": q_ids[q][top], "vec_id": ids[c][top], "score": score[top]})

    def searched(targets: DataFrame) -> DataFrame:
        """``targets``: id, v, p, bound, block.  The best of each block a query goes to."""
        targets = written(targets, "targets")
        portions = targets.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("portions"))
        portions = F.broadcast(portions)  # one row per region at most, and regions are bounded by the sample
        right = targets.join(portions, "block").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))) \
            .withColumn("chunk", F.expr("cast(pmod(xxhash64(id), portions) as int)")).drop("portions")
        left = blocks.join(portions, "block").withColumn("chunk", F.explode(F.expr("sequence(0, portions - 1)"))).drop("portions")
        return left.groupBy("block", "salt", "chunk").cogroup(right.groupBy("block", "salt", "chunk")) \
            .applyInArrow(find, "query_id long, vec_id long, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def topped(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    home = by_batch(asked, locate, schema + ", block int").withColumn("bound", F.lit(float("inf")))
    first = written(topped(searched(home)), "home-neighbours")
    known = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), (2 - 2 * F.col("score")).alias("bound"))
    known = asked.join(known, "id", "left").select("id", "v", "p", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))

    def others(batch):
        x = _matrix(batch.column("p"), batch.num_rows)
        bound = batch.column("bound").to_numpy()
        far = shared.value.reach(x)
        near = far <= quantile * np.maximum(bound, 0)[:, None]
        near[np.arange(len(x)), shared.value.of(x)] = False
        row, block = np.nonzero(near)
        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(row)).columns, pa.array(block.astype(np.int32))],
                                         [*batch.schema.names, "block"])

    second = searched(by_batch(known, others, schema + ", bound double, block int"))
    return topped(first.drop("rank").union(second)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
