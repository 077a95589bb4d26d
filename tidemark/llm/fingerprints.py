"""Document fingerprints: quartile digests of hashed byte triplets (operator 12).

The bytes of a text, between two zero bytes on either side, are read in windows of four; two triplets of each window
(bytes 1, 2, 3 and 1, 2, 4) are hashed to one of `BUCKETS` buckets and counted. A bucket's code, two bits, is the number
of quartiles of all counts that its count exceeds. The digest is one byte for the length (eighths of an octave of the byte
count), then the codes; as a column it is base64 text. The difference of two digests is the sum over buckets of the
difference of their codes, plus `LENGTH_WEIGHT` for each step of length. It is bounded by what two unrelated digests
reach: 1.25 a bucket for dense ones, all codes together for sparse ones (short texts). Likeness is 1 - difference / bound.

`compare_with_next` also needs each document's successor in falling order of an id. No window over the whole table is
used: documents are dealt into ranges of the id by quantiles, an id with many documents is split further by a hash of the
text, and the first document of a range is sent to the range before it as well (from the first range to the last one).

Defined cases: a null text counts as empty; the empty text has no codes and is like itself only. Null ids come after all
others. Documents of one id are ordered by a 64-bit hash of their texts; repeated rows stay rows, each followed by its
copy but the last. A single document is its own successor. Other columns of the input are left alone and not read.
An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches
from .words import mix, row_slices, text_buffers

BUCKET_BITS = 11
BUCKETS = 1 << BUCKET_BITS
#: Offsets of the triplets within a window of four bytes.
TRIPLETS = ((0, 1, 2), (0, 1, 3))
PAD = 2
#: What one step of length adds to a difference.
LENGTH_WEIGHT = BUCKETS // 128
#: Bytes of text of one range of documents, about.
RANGE_BYTES = 64 << 20
#: Rows digested at once, as each has a counter per bucket.
ROWS = 256
_SLICE = 1 << 19


@lru_cache(maxsize=1)
def _tables() -> np.ndarray:
    """Random bucket numbers per (triplet, place, byte); a triplet's bucket is their exclusive or."""
    every = mix(np.arange(1, 3 * len(TRIPLETS) * 256 + 1, dtype=np.uint64))
    return (every >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16).reshape(len(TRIPLETS), 3, 256)


def _padded(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text between `PAD` zero bytes on either side; an empty text stays empty."""
    sizes = np.diff(bounds)
    grown = np.concatenate([[0], np.cumsum(np.where(sizes > 0, sizes + 2 * PAD, 0))])
    out = np.zeros(grown[-1], dtype=np.uint8)
    out[np.arange(len(raw)) + np.repeat(grown[:-1] + PAD - bounds[:-1], sizes)] = raw
    return out, grown


def _digest_slice(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    rows = len(bounds) - 1
    padded, grown = _padded(raw, bounds)
    counts = np.zeros(rows * BUCKETS, dtype=np.int64)
    row = np.repeat(np.arange(rows, dtype=np.int64) * BUCKETS, np.diff(grown))
    for tables, places in zip(_tables(), TRIPLETS, strict=True):
        n = len(padded) - places[2]
        if n > 0:
            bucket = tables[0][padded[places[0] : places[0] + n]]
            for k in (1, 2):
                bucket = bucket ^ tables[k][padded[places[k] : places[k] + n]]
            inside = row[:n] == row[places[2] :]
            counts += np.bincount((row[:n] + bucket)[inside], minlength=len(counts))
    counts = counts.reshape(rows, BUCKETS)
    at = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
    quartiles = np.partition(counts, at, axis=1)[:, at]
    codes = sum((counts > quartiles[:, k : k + 1]).astype(np.uint8) for k in range(3)).reshape(rows, BUCKETS // 4, 4)
    out = np.empty((rows, 1 + BUCKETS // 4), dtype=np.uint8)
    out[:, 0] = np.minimum(np.round(8 * np.log2(1 + np.diff(bounds))), 255)
    out[:, 1:] = codes[..., 0] | codes[..., 1] << 2 | codes[..., 2] << 4 | codes[..., 3] << 6
    return out


def digests(texts: pa.Array) -> np.ndarray:
    """One digest a row, as bytes."""
    raw, bounds = text_buffers(texts)
    out = [np.zeros((0, 1 + BUCKETS // 4), dtype=np.uint8)]
    for lo, hi in row_slices(bounds, _SLICE):
        for a in range(lo, hi, ROWS):
            b = min(a + ROWS, hi)
            out.append(_digest_slice(raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]))
    return np.concatenate(out)


def _codes(digest: np.ndarray) -> np.ndarray:
    body = digest[:, 1:]
    return np.stack([body >> 2 * k & 3 for k in range(4)], axis=2).reshape(len(digest), BUCKETS).astype(np.int8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 for those that differ as unrelated ones do."""
    out = []
    for lo in range(0, len(a), ROWS):
        left, right = a[lo : lo + ROWS], b[lo : lo + ROWS]
        x, y = _codes(left), _codes(right)
        total = x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64)
        apart = np.abs(x - y).sum(axis=1, dtype=np.int64) + LENGTH_WEIGHT * np.abs(left[:, 0].astype(np.int64) - right[:, 0])
        bound = np.maximum(np.minimum(1.25 * BUCKETS, total), 1)
        out.append(1 - np.minimum(apart, bound) / bound)
    return np.concatenate(out) if out else np.zeros(0)


def shown(digest: np.ndarray) -> list[str]:
    return [base64.b64encode(row.tobytes()).decode() for row in digest]


def read(column: pa.Array) -> np.ndarray:
    rows = [np.frombuffer(base64.b64decode(s), dtype=np.uint8) for s in column.to_pylist()]
    return np.stack(rows) if rows else np.zeros((0, 1 + BUCKETS // 4), dtype=np.uint8)


def fingerprint(text: Column) -> Column:
    """The digest of a text column."""

    @F.arrow_udf("string")
    def digest(texts: pa.Array) -> pa.Array:
        return pa.array(shown(digests(texts)), pa.string())

    return digest(text.cast("string"))


def fingerprint_likeness(a: Column, b: Column) -> Column:
    """Likeness of two columns of digests without nulls."""

    @F.arrow_udf("double")
    def compared(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(likeness(read(x), read(y)), pa.float64())

    return compared(a, b)


class _Ranges:
    """Ranges of (null last, id falling, hash rising). An id that fills several ranges is split by its hash."""

    def __init__(self, splits: list[int], null_parts: int):
        self.splits = np.sort(~np.array(splits, dtype=np.int64))
        self.known = len(self.splits) + 1
        self.n = self.known + null_parts
        self.null_parts = null_parts

    def of(self, null: np.ndarray, key: np.ndarray, h: np.ndarray) -> np.ndarray:
        part = (h >> np.int64(32)) + np.int64(1 << 31)
        lo, hi = np.searchsorted(self.splits, key, "left"), np.searchsorted(self.splits, key, "right")
        own = lo + (part * (hi - lo + 1) >> np.int64(32))
        return np.where(null, self.known + (part * max(self.null_parts, 1) >> np.int64(32)), own)


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = batch.column("id")
    return (
        ids.is_null().to_numpy(zero_copy_only=False),
        ~ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
        batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64),
    )


def _first_rows(ranges: _Ranges):
    """The first key of every range among a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null, key, h = _keys(batch)
            place = ranges.of(null, key, h)
            order = np.lexsort((h, key, null, place))
            first = order[np.flatnonzero(np.diff(place[order], prepend=-1))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[first], pa.int32()), pa.array(null[first]), pa.array(key[first]), pa.array(h[first])], names=["place", "null", "key", "h"]
            )

    return run


def _deal(ranges: _Ranges, also: dict[tuple[bool, int, int], int]):
    """Rows with their range; equal rows of a batch as one with its number of copies, and the first of a range once more
    (`role` 1) for the range before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null, key, h = _keys(batch)
            _, first, copies = np.unique(np.stack([null.astype(np.int64), key, h]), axis=1, return_index=True, return_counts=True)
            place = ranges.of(null[first], key[first], h[first])
            extra = [(k, also[row]) for k, row in enumerate(zip(null[first].tolist(), key[first].tolist(), h[first].tolist(), strict=True)) if row in also]
            at = np.array([k for k, _ in extra], dtype=np.int64)
            rows = np.concatenate([first, first[at]])
            columns = [
                pa.array(np.concatenate([place, np.array([p for _, p in extra], dtype=np.int64)]), pa.int32()),
                pa.array(np.repeat([0, 1], [len(first), len(at)]), pa.int32()),
                pa.array(null[rows]),
                pa.array(key[rows]),
                pa.array(h[rows]),
                pa.array(np.concatenate([copies, np.ones(len(at), dtype=np.int64)]), pa.int64()),
                batch.column("text").take(pa.array(rows)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "role", "null", "key", "h", "copies", "text"])

    return run


def _edited(text: str, after: str) -> str:
    cut = len(text) // 3
    return text[: len(text) - cut] + after[:cut]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order, each with its successor, which may stand in the next batch."""
    last: tuple | None = None
    for batch in batches:
        if not len(batch):
            continue
        ids = [None if n else ~k for n, k in zip(batch.column("null").to_pylist(), batch.column("key").to_pylist(), strict=True)]
        rows = list(zip(ids, batch.column("role").to_pylist(), batch.column("copies").to_pylist(), (t or "" for t in batch.column("text").to_pylist()), strict=True))
        rows = rows if last is None else [last, *rows]
        last = rows[-1]
        for lo in range(0, len(rows) - 1, ROWS):
            part = rows[lo : lo + ROWS + 1]
            own = digests(pa.array([r[3] for r in part], pa.large_string()))
            jobs = [(k, k + 1, 1) for k in range(len(part) - 1) if part[k][1] == 0]
            jobs += [(k, k, part[k][2] - 1) for k in range(len(part) - 1) if part[k][1] == 0 and part[k][2] > 1]
            if not jobs:
                continue
            a, b, times = (np.array(x, dtype=np.int64) for x in zip(*jobs, strict=True))
            texts = [_edited(part[i][3], part[j][3]) for i, j, _ in jobs]
            changed = digests(pa.array(texts, pa.large_string()))
            columns = [
                pa.array([part[i][0] for i in a.tolist()], pa.int64()),
                pa.array([len(part[i][3]) for i in a.tolist()], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                pa.array(shown(own[a]), pa.string()),
                pa.array(shown(changed), pa.string()),
                pa.array(likeness(own[a], changed), pa.float64()),
                pa.array(likeness(own[a], own[b]), pa.float64()),
            ]
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays(columns, names=names).take(pa.array(np.repeat(np.arange(len(jobs)), times)))


def compare_with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per document its fingerprint, that of its edited text (the last third replaced by the head of the next document in
    falling order of doc_id), and the likeness of its fingerprint to that and to the next document's."""
    spark = docs.sparkSession
    bounded_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.count("id").alias("n"), F.count_if(F.col("id").isNull()).alias("nulls")).first()
    wanted = max((total["bytes"] or 0) // range_bytes + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = max(1, round(wanted * total["n"] / max(1, total["n"] + total["nulls"])))
    splits: list[int] = []
    if known > 1 and total["n"]:
        splits = rows.agg(F.percentile_approx("id", [k / known for k in range(1, known)], 100 * known)).first()[0]
    ranges = _Ranges(splits, -(-wanted * total["nulls"] // max(1, total["n"] + total["nulls"])))

    keyed = rows.select("id", F.xxhash64("text").alias("h"), "text")
    first = keyed.select("id", "h").mapInArrow(_first_rows(ranges), "place int, null boolean, key long, h long")
    first = first.groupBy("place").agg(F.min(F.struct("null", "key", "h")).alias("row")).orderBy("place").collect()  # one entry a range
    also = {tuple(b["row"]): a["place"] for a, b in zip([first[-1], *first[:-1]], first, strict=True)} if first else {}

    dealt = keyed.mapInArrow(_deal(ranges, also), "place int, role int, null boolean, key long, h long, copies long, text string")
    ordered = dealt.repartitionById(ranges.n, F.col("place")).sortWithinPartitions("role", "null", "key", "h")
    return ordered.mapInArrow(
        _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
