"""MinHash near-duplicates by a multi-index Hamming join (operator 2).

A document is the set of its distinct five-word shingles. Equal sets are folded first. Every distinct set has a signature
of `CHUNKS * CHUNK` MinHash values of 16 bits. Two signatures that differ in fewer than 2 * CHUNKS places have a chunk
with at most one difference (pigeonhole), so each signature is filed under every chunk with each one of its values left
out; a pair within that distance shares a key for certain. A pair is looked at only under the first key it shares, and a
key of many documents is cut into blocks that are compared pairwise. Links are exact: 100 * intersection >= 75 * union on
full sets. Each member of a key is first compared with the key's smallest document. After that only pairs of documents in
different components matter; they are never put out: the documents concerned fetch their texts, and their full sets are
compared under the same key until they are known to be connected. What leaves a key is a forest of links.

For sets of similarity 0.75 the distance is 12 of 48 on average with a deviation of 3, and 23 are allowed.

Defined cases: null or empty text has no set and no links; texts of fewer than five words are compared whole. A null
doc_id has no place in the order of ids: no links, component null, kept. Rows with one doc_id are one document in the
graph. Columns besides doc_id and text are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .tables import bounded_batches, stored
from .words import mix, row_slices, shingles, text_buffers, word_hashes

CHUNKS, CHUNK = 12, 4
PLACES = CHUNKS * CHUNK
MAX_DISTANCE = 2 * CHUNKS - 1
THRESHOLD = 75
BLOCK = 1024
BROADCAST_IDS = 1_000_000

_SEEDS = mix(np.arange(1, PLACES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mix(_SEEDS) | np.uint64(1)
_PRINT = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16-bit MinHash values of non-empty sets, one row each."""
    every = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), PLACES), dtype=np.uint16)
    for j in range(PLACES):
        low = np.minimum.reduceat((every ^ _SEEDS[j]) * _FACTORS[j], starts)
        out[:, j] = (mix(low) >> np.uint64(48)).astype(np.uint16)
    return out


def index_keys(signature: np.ndarray) -> np.ndarray:
    """Keys of every chunk with each of its values left out: chunk, place left out, and the other values."""
    parts = signature.reshape(-1, CHUNKS, CHUNK).astype(np.int64)
    keys = np.empty((len(signature), CHUNKS, CHUNK), dtype=np.int64)
    for p in range(CHUNK):
        code = np.arange(CHUNKS, dtype=np.int64)[None, :] * CHUNK + p
        for k in range(CHUNK):
            if k != p:
                code = (code << 16) | parts[:, :, k]
        keys[:, :, p] = code
    return keys.reshape(len(signature), PLACES)


def _sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    raw, bounds = text_buffers(column)
    for lo, hi in row_slices(bounds):
        yield lo, shingles(*word_hashes(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, sets in _sets(batch.column("text")):
            n = np.array([len(s) for s in sets], dtype=np.int64)
            a = np.array([int(s.sum()) for s in sets], dtype=np.uint64).view(np.int64)
            b = np.array([int(np.bitwise_xor.reduce(mix(s))) for s in sets], dtype=np.uint64).view(np.int64)
            full = np.flatnonzero(n)
            packed = [None] * len(n)
            if len(full):
                for i, v in zip(full.tolist(), signatures([sets[i] for i in full]), strict=True):
                    packed[i] = v.tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, len(n)), pa.array(n), pa.array(a), pa.array(b), pa.array(packed, pa.binary())], names=["doc_id", "n_shingles", "set_a", "set_b", "signature"]
            )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Set size, digest of the set and signature of every row."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_fingerprints, _PRINT)


def _filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every id under each of its keys."""
    for batch in batches:
        if len(batch):
            keys = index_keys(_values(batch.column("signature")))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("id").to_numpy(), PLACES)), pa.array(keys.ravel())], names=["id", "key"])


def close_pairs(
    group: np.ndarray, key: np.ndarray, side: np.ndarray, cross: np.ndarray, component: np.ndarray, signature: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one group (rows of a group are consecutive) of different components, within MAX_DISTANCE, whose
    first shared key is this one: (row, row, distance). Of a group of two blocks only pairs between the blocks count."""
    left, right, far = [], [], []
    place = (key >> 48).astype(np.int64)
    values = signature.reshape(-1, CHUNKS, CHUNK)
    step = 1
    at = np.flatnonzero(group[1:] == group[:-1])
    while len(at):
        for lo in range(0, len(at), 1 << 14):
            a = at[lo : lo + (1 << 14)]
            b = a + step
            use = (~cross[a] | (side[a] != side[b])) & (component[a] != component[b])
            a, b = a[use], b[use]
            same = (values[a] == values[b]).sum(axis=2)
            distance = PLACES - same.sum(axis=1)
            near = same >= CHUNK - 1
            first = near.argmax(axis=1)
            here = near.any(axis=1) & (first == place[a] // CHUNK) & (distance <= MAX_DISTANCE)
            # a chunk that agrees whole is shared under each of its keys: the one without its first value stands for it
            here &= (same[np.arange(len(a)), first] < CHUNK) | (place[a] % CHUNK == 0)
            left.append(a[here])
            right.append(b[here])
            far.append(distance[here])
        step += 1
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
    if not left:
        return (np.zeros(0, dtype=np.int64),) * 3
    return np.concatenate(left), np.concatenate(right), np.concatenate(far)


def _group(table: pa.Table) -> np.ndarray:
    columns = [table.column(c).to_numpy() for c in ("key", "i", "j")]
    new = np.zeros(len(table), dtype=bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables in which no group (key, i, j) of sorted input is cut, of about `rows` rows or one group."""
    rest: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        for at in range(0, len(batch), rows):
            part = batch.slice(at, rows)
            rest.append(part)
            held += len(part)
            if held < rows:
                continue
            table = pa.Table.from_batches(rest)
            group = _group(table)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield table.slice(0, cut)
                rest = table.slice(cut).to_batches()
                held = len(table) - cut
    if held:
        yield pa.Table.from_batches(rest)


def _values(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), PLACES)


def _pairs_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, i, j, side, component = (table.column(c).to_numpy() for c in ("key", "i", "j", "side", "component"))
    return close_pairs(_group(table), key, side, i != j, component, _values(table.column("signature")))


def _with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a close pair under their key."""
    for table in _whole_groups(batches, 1 << 14):
        a, b, _ = _pairs_of(table)
        if len(a):
            yield from table.take(pa.array(np.unique(np.concatenate([a, b])))).combine_chunks().to_batches()


def _similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < threshold * large:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= threshold * (small + large - shared)


def _within_distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) whose signatures are close."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if len(table):
            close = (_values(table.column("signature")) != _values(table.column("other"))).sum(axis=1) <= MAX_DISTANCE
            yield from table.select(["u", "v"]).filter(pa.array(close)).to_batches()


def _confirmed(threshold: int):
    """Pairs (u, v) whose full sets are similar; neighbouring rows share v."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                u, v = part.column("u").to_numpy(), part.column("v").to_numpy()
                keep = np.zeros(len(part), dtype=bool)
                for lo, sets in _sets(part.column("text_u")):
                    for k, own in enumerate(sets, lo):
                        if v[k] != last:
                            ((_, (of_last,)),) = _sets(part.column("text_v").slice(k, 1))
                            last = v[k]
                        keep[k] = _similar(own, of_last, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], names=["u", "v"])

    return run


def _forest(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, 1 << 10):
            table = table.combine_chunks()
            a, b, far = _pairs_of(table)
            sets: list[np.ndarray] = []
            for _, part in _sets(table.column("text")):
                sets.extend(part)
            ids, group, component = table.column("id").to_numpy(), _group(table), table.column("component").to_numpy()
            firsts: dict[tuple[int, int], int] = {}
            root = [firsts.setdefault(k, i) for i, k in enumerate(zip(group.tolist(), component.tolist(), strict=True))]

            def find(x: int, root: list[int] = root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            u, v = [], []
            for k in np.argsort(far, kind="stable").tolist():
                x, y = int(a[k]), int(b[k])
                p, q = find(x), find(y)
                if p != q and _similar(sets[x], sets[y], threshold):
                    root[p] = q
                    u.append(ids[x])
                    v.append(ids[y])
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _listed(ids: DataFrame) -> DataFrame:
    """A stored list of ids, broadcast if it is known to be short, so that texts need not move to meet it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents named."""
    ids = _listed(stored(ids.distinct(), "wanted"))
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).join(ids, "id", "left_semi")


def _met(signed: DataFrame) -> DataFrame:
    """(key, id, n, first): the ids filed under a key that n > 1 of them share, and the smallest of these.

    Rows are dealt by key once and counted where they lie: nearly every key is another one, so adding up before the shuffle
    would only move them twice."""
    filed = signed.filter("signature IS NOT NULL").mapInArrow(_filed, "id long, key long")
    group = Window.partitionBy("key")
    counted = filed.withColumns({"n": F.count(F.lit(1)).over(group), "first": F.min("id").over(group)})
    return counted.filter("n > 1").select("key", "id", "n", "first")


def links(docs: DataFrame, prints: DataFrame, threshold: int = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(u, v): exact links that connect what is connected among different sets. `prints` has one row per set.

    First every member of a key is compared with the key's smallest document, which settles most groups of copies. Then
    all pairs of a key whose documents are still in different components are compared."""
    signed = prints.select(F.col("doc_id").alias("id"), "signature")
    met = stored(_met(signed), "met")
    star = met.filter("id <> first").select(F.col("id").alias("u"), F.col("first").alias("v")).distinct()
    star = star.join(signed.select(F.col("id").alias("u"), "signature"), "u").join(signed.select(F.col("id").alias("v"), F.col("signature").alias("other")), "v")
    star = stored(star.select("u", "v", "signature", "other").mapInArrow(_within_distance, "u long, v long"), "star")
    texts = _texts_of(docs, star.select(F.explode(F.array("u", "v")).alias("id")))
    both = star.join(texts.select(F.col("id").alias("u"), F.col("text").alias("text_u")), "u").join(texts.select(F.col("id").alias("v"), F.col("text").alias("text_v")), "v")
    direct = stored(both.select("u", "v", "text_u", "text_v").mapInArrow(_confirmed(threshold), "u long, v long"), "direct")

    found = connected_components(direct, "u", "v").select(F.col("node").alias("id"), "component")
    blocks = F.ceil(F.col("n") / block).cast("int")
    rest = met.select("key", "id", blocks.alias("blocks")).join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rest = stored(rest, "rest")
    open_keys = rest.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a < b").select("key")
    rest = rest.join(open_keys, "key", "left_semi").withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "id", "component").join(signed, "id")
    columns = ["key", "i", "j", "side", "id", "component", "signature"]
    rest = rest.select(columns).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    close = stored(rest.mapInArrow(_with_partners, "key long, i int, j int, side int, id long, component long, signature binary"), "close")
    ready = close.join(_texts_of(docs, close.select("id")), "id").select(*columns, "text")
    ready = ready.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    return ready.mapInArrow(_forest(threshold), "u long, v long").unionByName(direct)


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs`."""
    bounded_batches(docs)
    prints = stored(fingerprints(docs), "prints")
    known = prints.filter("doc_id IS NOT NULL")
    sets = known.filter("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("first"))
    same = known.filter("n_shingles > 0").join(sets, ["set_a", "set_b", "n_shingles"])
    copies = stored(same.select("doc_id", "first", "set_a", "set_b").distinct(), "copies")
    one = stored(known.join(copies.filter("doc_id = first").select("doc_id", "set_a", "set_b"), ["doc_id", "set_a", "set_b"]).dropDuplicates(["doc_id", "set_a", "set_b"]), "sets")
    near = links(docs, one, threshold, block)
    edges = near.unionByName(copies.filter("doc_id <> first").select(F.col("doc_id").alias("u"), F.col("first").alias("v")))
    found = connected_components(edges, "u", "v")
    out = prints.select("doc_id", "n_shingles").join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each group, columns as they are. Of rows that repeat a kept doc_id and text, one stays."""
    judged = near_duplicates(docs, threshold).filter("doc_id IS NOT NULL").groupBy("doc_id")
    found = stored(judged.agg(F.bool_or("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows")).filter("NOT _kept OR _rows > 1"), "judged")
    gone, repeated = found.filter("NOT _kept").select("doc_id"), found.filter("_kept").select("doc_id")
    stay = docs.join(_listed(gone), "doc_id", "left_anti")
    if repeated.isEmpty():
        return stay.select(docs.columns)
    repeated = _listed(repeated)
    return stay.join(repeated, "doc_id", "left_anti").unionByName(stay.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select(docs.columns)
