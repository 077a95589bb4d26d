"""Near-duplicate vectors by spherical k-means cells (operator 5).

Equal vectors are folded first, with their number. Centroids are fitted on a bounded sample that stays with the executors: a
round sums the vectors of each cell there, and the driver holds the centroids alone. Every vector owns a place in
the cell of its nearest centroid and visits each cell whose border it is close to: y can have a neighbour within angle a
in the cell of c only if y . (own - c) / |own - c| <= sin a. That bound (`margin` = sin a, the default) is exact: no link
is lost, whatever the vectors' directions.

Neighbouring cells are joined to groups of `BLOCK_VALUES` to `MAX_BLOCK_VALUES` numbers. A vector is sent once to each group it visits a
cell of, not once to each cell, and the visits are found again where the group is compared. Groups are compared in
blocks: owners against owners and visitors, cosine products in double precision. A block puts out the number of links of
each owner and a forest of links, never pairs. Large groups become many blocks.

Defined cases: vectors that are null, zero, hold null or non-finite components, or are not of the most frequent length
link with nothing and are kept. A null vec_id links with nothing, component null. An empty table gives no rows. Other
columns (labels) are not looked at. Rows with one vec_id and different vectors count as vectors of one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .tables import stored
from .vectors import main_length, matrix, sample, usable

COSINE = 0.95
ROWS_PER_CELL = 200
MAX_CELLS = 4096
SAMPLE_PER_CELL = 64
ROUNDS = 8
OWNERS, VISITORS = 1024, 2048
#: Vector components on one side of a block, at least and at most, and blocks in a row before they grow.
BLOCK_VALUES, MAX_BLOCK_VALUES, BLOCKS = 1 << 20, 1 << 22, 8
#: Numbers of a product with all centroids that are held at once.
STEP_VALUES = 1 << 21
#: Rounding of products of unit vectors.
SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _step(cells: int) -> int:
    """Rows whose products with all centroids are held at once."""
    return max(64, min(2048, STEP_VALUES // max(1, cells)))


def _cell_sums(x: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, sum of its rows) of the cells that have rows."""
    order = np.argsort(cells, kind="stable")
    found, starts = np.unique(cells[order], return_index=True)
    return found, np.add.reduceat(x[order], starts, axis=0)


def _moved(c: np.ndarray, cells: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Unit centroids after a round; an empty cell keeps its centroid."""
    norm = np.linalg.norm(sums, axis=1)
    c, some = c.copy(), norm > 1e-9
    c[cells[some]] = sums[some] / norm[some, None]
    return c


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Unit centroids of rows that the driver holds."""
    x = np.unique(_unit(x), axis=0)
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]]
    for _ in range(rounds):
        nearest = np.concatenate([(x[at : at + _step(len(c))] @ c.T).argmax(axis=1) for at in range(0, len(x), _step(len(c)))])
        c = _moved(c, *_cell_sums(x, nearest))
    return c


def _totals(parts: Iterator[tuple[np.ndarray, np.ndarray]], c: np.ndarray) -> pa.RecordBatch:
    total, seen = np.zeros_like(c), np.zeros(len(c), dtype=bool)
    for cells, sums in parts:
        total[cells] += sums
        seen[cells] = True
    cells = np.flatnonzero(seen)
    flat = pa.FixedSizeListArray.from_arrays(pa.array(total[cells].ravel()), c.shape[1]).cast(pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), flat], names=["cell", "total"])


def _sum_rows(shared):
    """Sums of the unit vectors of each cell, over the rows of a task."""

    def parts(batches: Iterator[pa.RecordBatch], c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for at in range(0, len(batch), _step(len(c))):
                x = _unit(matrix(batch.column("embedding").slice(at, _step(len(c)))))
                yield _cell_sums(x, (x @ c.T).argmax(axis=1))

    return lambda batches: iter([_totals(parts(batches, shared.value), shared.value)])


def _sum_sums(shared):
    """The tasks' sums added up; a cell's sums are in one task."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return (_cell_sums(matrix(b.column("total")), b.column("cell").to_numpy()) for b in batches if len(b))

    return lambda batches: iter([_totals(parts(batches), shared.value)])


def fit_centroids(unique: DataFrame, n: int, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most `cells` unit centroids of the `n` rows (id, embedding), fitted on those whose ids hash lowest. Rows stay with the
    executors but for one a cell, where the rounds begin."""
    c = np.unique(_unit(sample(unique, "id", "embedding", cells)), axis=0)
    if len(c) < 2:
        return c
    share = min(1.0, cells * SAMPLE_PER_CELL / n)
    lowest = F.xxhash64("id") <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))
    fitted, spark = stored(unique.filter(lowest).select("embedding"), "fitted"), unique.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(c)
        sums = fitted.mapInArrow(_sum_rows(shared), "cell int, total array<double>").repartition("cell").mapInArrow(_sum_sums(shared), "cell int, total array<double>")
        sums = sums.toArrow()
        c = _moved(c, sums.column("cell").to_numpy(), matrix(sums.column("total")))
        shared.unpersist()
    return c


def _visits(near: np.ndarray, own_near: np.ndarray, between: np.ndarray, margin: float) -> np.ndarray:
    return own_near[:, None] - near <= margin * between + SLACK


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a @ b.T
    out *= -2  # in place: of all centroids this is the largest matrix here
    out += 2
    return np.sqrt(np.maximum(out, 0, out=out), out=out)


def _assign(shared, margin: float):
    """A vector's own cell, and the groups of the cells it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, group = shared.value
        between = _distances(c, c)
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
        step = _step(len(c))
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                x = _unit(matrix(part.column("embedding")))
                near = x @ c.T
                own = near.argmax(axis=1)
                visits = _visits(near, near[np.arange(len(x)), own], between[own], margin)
                row, k = np.nonzero(np.logical_or.reduceat(visits[:, order], starts, axis=1))
                visited = group[order][starts][k]
                out = part.take(pa.array(row))
                columns = [pa.array(own[row].astype(np.int32)), pa.array(visited.astype(np.int32)), pa.array(group[own[row]] == visited)]
                yield pa.RecordBatch.from_arrays([*out.columns, *columns], names=[*out.schema.names, "own", "cell", "owner"])

    return run


def _linked(x: np.ndarray, ids: np.ndarray, y: np.ndarray, other_ids: np.ndarray, copies: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(id, links, smallest id that links lead to) of those that have links here."""
    linked = x @ y.T >= cosine
    if not linked.any():
        return None
    linked &= ids[:, None] != other_ids[None, :]
    own, other = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(own):
        return None
    linked = linked[np.ix_(own, other)]
    n = linked @ copies[other]
    top = np.iinfo(np.int64).max
    a, b = ids[own], other_ids[other]
    while True:
        new_a = np.minimum(a, np.where(linked, b[None, :], top).min(axis=1))
        new_b = np.minimum(b, np.where(linked, new_a[:, None], top).min(axis=0))
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    return np.concatenate([ids[own], other_ids[other]]), np.concatenate([n, np.zeros(len(other), dtype=np.int64)]), np.concatenate([a, b])


def _compare(shared, cosine: float, margin: float):
    def run(key, owners: pa.Table, others: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])
        if not len(owners) or not len(others):
            return schema.empty_table()
        c, _ = shared.value
        ids, other_ids, copies = (t.to_numpy() for t in (owners.column("id"), others.column("id"), others.column("copies")))
        x, y = _unit(matrix(owners.column("embedding"))), _unit(matrix(others.column("embedding")))
        cell_of, home = owners.column("own").to_numpy(), others.column("own").to_numpy()
        own_near = np.einsum("ij,ij->i", y, c[home])
        found = []
        for cell in np.unique(cell_of):
            mine = np.flatnonzero(cell_of == cell)
            between = _distances(c, c[cell : cell + 1])[home]
            guests = np.flatnonzero(_visits(y @ c[cell][:, None], own_near, between, margin)[:, 0])
            for g in range(0, len(guests), VISITORS):
                some = guests[g : g + VISITORS]
                near_y = y[some]
                for m in range(0, len(mine), OWNERS):
                    few = mine[m : m + OWNERS]
                    found.append(_linked(x[few], ids[few], near_y, other_ids[some], copies[some], cosine))
        found = [f for f in found if f is not None]
        return pa.table([np.concatenate(p) for p in zip(*found, strict=True)], schema=schema) if found else schema.empty_table()

    return run


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, margin: float | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    good = rows.filter(usable("embedding") & F.col("vec_id").isNotNull())
    length = main_length(good, "embedding")
    good = good.filter(F.size("embedding") == length)
    unique = stored(good.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors")
    n = unique.count()
    cells = min(MAX_CELLS, max(1, n // ROWS_PER_CELL))
    if margin is None:
        margin = (1 - cosine**2) ** 0.5 if cosine > 0 else 1.0
    centroids = fit_centroids(unique, n, cells) if n else np.zeros((1, max(1, length)))
    # Vectors of one side of a block. Without structure all blocks meet, and each vector is sent as often as there are blocks
    # in a row, so these grow with the table while there are enough of them.
    side = max(OWNERS, min(max(BLOCK_VALUES, n * length // BLOCKS), MAX_BLOCK_VALUES) // max(1, length))
    heads = spherical_kmeans(centroids, max(1, min(len(centroids), n // side))) if n else centroids
    shared = spark.sparkContext.broadcast((centroids, (centroids @ heads.T).argmax(axis=1)))
    kind = dict(rows.dtypes)["embedding"]
    placed = stored(unique.mapInArrow(_assign(shared, margin), f"embedding {kind}, id long, copies long, own int, cell int, owner boolean"), "cells")
    sizes = placed.groupBy("cell").agg(
        F.ceil(F.count_if("owner") / side).cast("int").alias("own_blocks"), F.ceil(F.count(F.lit(1)) / side).cast("int").alias("blocks")
    )
    sized = placed.join(sizes, "cell")
    spread = F.xxhash64("id", F.lit(1))
    owners = sized.filter("owner").withColumn("i", F.pmod(spread, "own_blocks").cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    others = sized.withColumn("j", F.pmod(spread, "blocks").cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.greatest("own_blocks", F.lit(1)) - 1)))
    keys = ["cell", "i", "j"]
    columns = [*keys, "id", "copies", "own", "embedding"]
    owners, others = (rows_of.select(*[F.col(c).alias(c) for c in columns]) for rows_of in (owners, others))
    found = owners.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInArrow(_compare(shared, cosine, margin), "id long, n long, root long")
    found = stored(found.groupBy("id", "root").agg(F.sum("n").alias("n")), "links")
    direct = found.groupBy("id").agg(F.sum("n").alias("n"))
    members = stored(good.join(unique, "embedding").select("vec_id", "id", "copies").distinct(), "members")
    edges = found.select(F.col("id").alias("u"), F.col("root").alias("v")).unionByName(members.select(F.col("vec_id").alias("u"), F.col("id").alias("v")))
    component = connected_components(edges, "u", "v").select(F.col("node").alias("vec_id"), "component")
    counted = members.join(direct, "id", "left").groupBy("vec_id").agg((F.sum(F.coalesce("n", F.lit(0)) + F.col("copies")) - F.lit(1)).alias("n_links"))
    out = rows.select("vec_id").join(counted, "vec_id", "left").join(component, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
