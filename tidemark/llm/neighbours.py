"""Nearest neighbours with a forest of random-projection trees (operator 9).

Trees are fitted on a bounded sample: a node splits at the median of the projection on the difference of two of its rows.
Every vector is filed in one leaf of each tree. A query keeps one queue over all trees, ordered by the smallest margin on
the way to a node, and opens leaves in that order until it has opened `share` of all leaves. The vectors of the opened
leaves are ranked by their exact Euclidean distance, in double precision on the original values, ties to the smaller id.
Leaves of one part of a tree are ranked together: a query is sent once to each such bundle, with the leaves it opens there.

Of equal vectors only the `k + 1` with the smallest ids are filed: a query can't return more, so the result is the same,
and a vector that is very common costs no more than that. A large bundle is cut into blocks.

Defined cases: vectors that are null, zero, hold null or non-finite components, or are not of the most frequent length, and
null ids take no part. Fewer candidates than k: all of them. An empty table or no query gives no rows. A repeated row (same
id and vector) is one candidate.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import stored
from .vectors import main_length, matrix, sample, usable

NEIGHBOURS = 10
TREES = 8
LEAF_ROWS = 400
MAX_DEPTH = 11
SAMPLE_ROWS = 32_768
SHARE = 0.14
#: Vector components of a bundle of leaves, and of a block of it, about.
BUNDLE_VALUES = 1 << 20


class Forest:
    """Complete trees: planes and thresholds of the inner nodes in level order."""

    def __init__(self, planes: np.ndarray, cuts: np.ndarray, depth: int):
        self.planes, self.cuts, self.depth = planes, cuts, depth

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree."""
        out = np.zeros((len(x), len(self.planes)), dtype=np.int32)
        for t in range(len(self.planes)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", x, self.planes[t][node]) > self.cuts[t][node])
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def search(self, q: np.ndarray, leaves: int) -> list[tuple[int, int]]:
        """The first `leaves` (tree, leaf) that the queue of this query reaches."""
        inner = (1 << self.depth) - 1
        side = np.einsum("tnd,d->tn", self.planes, q) - self.cuts if inner else np.zeros((len(self.planes), 0))
        side = side.tolist()
        queue = [(-math.inf, t, 0) for t in range(len(side))]
        found = []
        while queue and len(found) < leaves:
            far, t, node = heapq.heappop(queue)
            if node >= inner:
                found.append((t, node - inner))
                continue
            s = side[t][node]
            heapq.heappush(queue, (max(far, s), t, 2 * node + 1))
            heapq.heappush(queue, (max(far, -s), t, 2 * node + 2))
        return found


def grow(x: np.ndarray, trees: int, depth: int, seed: int = 9) -> Forest:
    rng = np.random.default_rng(seed)
    inner = (1 << depth) - 1
    planes, cuts = np.zeros((trees, inner, x.shape[1])), np.zeros((trees, inner))
    for t in range(trees):
        rows = {0: np.arange(len(x))}
        for node in range(inner):
            own = rows.pop(node)
            if len(own) > 1:
                a, b = x[rng.choice(own, 2, replace=False)]
                w = a - b if (a != b).any() else rng.normal(size=x.shape[1])
            else:
                w = rng.normal(size=x.shape[1])
            w = w / np.linalg.norm(w)
            z = x[own] @ w
            planes[t, node], cuts[t, node] = w, np.median(z) if len(own) else 0.0
            rows[2 * node + 1], rows[2 * node + 2] = own[z <= cuts[t, node]], own[z > cuts[t, node]]
    return Forest(planes, cuts, depth)


def _file(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                leaves = shared.value.leaves(matrix(part.column("embedding")))
                trees = leaves.shape[1]
                out = part.take(pa.array(np.repeat(np.arange(len(part)), trees)))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(np.tile(np.arange(trees, dtype=np.int32), len(part))), pa.array(leaves.ravel())], names=[*out.schema.names, "tree", "leaf"])

    return run


def _visit(shared, leaves: int, bits: int):
    """A query once for each bundle of 2^`bits` leaves with leaves it opens, and these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                rows, trees, bundles, opened = [], [], [], []
                for row, q in enumerate(matrix(part.column("embedding"))):
                    by_bundle = defaultdict(list)
                    for tree, leaf in shared.value.search(q, leaves):
                        by_bundle[tree, leaf >> bits].append(leaf)
                    for (tree, bundle), found in by_bundle.items():
                        rows.append(row)
                        trees.append(tree)
                        bundles.append(bundle)
                        opened.append(found)
                out = part.take(pa.array(rows, pa.int64()))
                columns = [pa.array(trees, pa.int32()), pa.array(bundles, pa.int32()), pa.array(opened, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*out.columns, *columns], names=[*out.schema.names, "tree", "bundle", "leaves"])

    return run


def _rank(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not len(queries) or not len(vectors):
            return schema.empty_table()
        vectors = vectors.sort_by("leaf")
        all_ids, x, leaf = vectors.column("vec_id").to_numpy(), matrix(vectors.column("embedding")), vectors.column("leaf").to_numpy()
        out = []
        for query, q, opened in zip(queries.column("vec_id").to_numpy(), matrix(queries.column("embedding")), queries.column("leaves").to_pylist(), strict=True):
            parts = [slice(a, b) for a, b in zip(np.searchsorted(leaf, opened).tolist(), np.searchsorted(leaf, opened, "right").tolist(), strict=True)]
            ids, far = np.concatenate([all_ids[p] for p in parts]), np.empty(sum(p.stop - p.start for p in parts))
            at = 0
            for p in parts:
                gap = x[p] - q
                np.sum(np.square(gap, out=gap), axis=1, out=far[at : at + len(gap)])
                at += len(gap)
            far = np.sqrt(far, out=far)
            far[ids == query] = np.inf
            near = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1]) if len(far) > 2 * k else np.arange(len(far))  # ties with the k-th stay in
            near = near[np.lexsort((ids[near], far[near]))][:k]
            near = near[np.isfinite(far[near])]
            out.append((np.full(len(near), query), ids[near], far[near]))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], schema=schema)

    return run


def nearest(vectors: DataFrame, queries_modulo: int = 100, k: int = NEIGHBOURS, trees: int = TREES, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found of every row whose id is divisible by `queries_modulo`."""
    spark = vectors.sparkSession
    good = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(usable("embedding") & F.col("vec_id").isNotNull()).distinct()
    good = stored(good, "points")
    length = main_length(good, "embedding")
    good = good.filter(F.size("embedding") == length)
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    filed = stored(good.withColumn("_copy", first).filter(F.col("_copy") <= k + 1).drop("_copy"), "filed")
    depth = min(MAX_DEPTH, max(0, round(math.log2(max(1, filed.count()) / LEAF_ROWS))))
    fitted = sample(filed, "vec_id", "embedding", SAMPLE_ROWS)
    forest = grow(fitted if len(fitted) else np.zeros((0, max(1, length))), trees, depth)
    shared = spark.sparkContext.broadcast(forest)
    schema = f"vec_id long, embedding {dict(good.dtypes)['embedding']}, tree int, leaf int"
    index = stored(filed.mapInArrow(_file(shared), schema), "leaves")
    opened = max(trees, math.ceil(share * trees * (1 << depth)))
    side = max(LEAF_ROWS, BUNDLE_VALUES // max(1, length))
    bits = min(depth, max(0, int(math.log2(side / LEAF_ROWS))))
    # Queries are few, but each makes hundreds of rows: from their small shuffle they would be taken for a table to broadcast. Here
    # the sizes of bundles are broadcast, `trees` x 2^`MAX_DEPTH` rows at most.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    visits = good.filter(F.col("vec_id") % queries_modulo == 0).repartition(parts, "vec_id")
    visits = visits.mapInArrow(_visit(shared, opened, bits), f"vec_id long, embedding {dict(good.dtypes)['embedding']}, tree int, bundle int, leaves array<int>")
    index = index.withColumn("bundle", F.shiftright("leaf", bits))
    blocks = F.broadcast(index.groupBy("tree", "bundle").agg(F.ceil(F.count(F.lit(1)) / side).cast("int").alias("blocks")))
    index = index.join(blocks, ["tree", "bundle"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).drop("blocks")
    visits = visits.join(blocks, ["tree", "bundle"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    keys = ["tree", "bundle", "block"]
    ranked = visits.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(_rank(k), "query_id long, vec_id long, score double")
    ranked = ranked.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return ranked.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
