"""Cross-tokenizer alignment of two tokenisations of the same bytes (operator 13).

Both tokenisations of a text cover the same bytes, so their tokens are intervals on one axis. All A and B tokens of a
slice of texts are sorted by start and the running maximum of their ends is taken; a group breaks where a start reaches
the maximum of all before it, so groups are the finest pieces whose borders both sides share. Within a group every A token
is linked with the B tokens that its interval overlaps.

A pair of ids is counted once for each document that links it. Texts are tokenised once: a slice of texts (`SLICE` bytes)
is stored as one row with its digests, its distinct pairs, and each document's pairs as compressed references to them. Pairs
are then counted corpus-wide, and every group of slices (`GROUP_BYTES` of text, one task's neighbours) asks for the counts
of its own distinct pairs by a join; the documents are completed where references and counts meet. The only thing that
goes through the driver is the highest count of each A id, one number an id of the vocabulary.

Defined cases: texts that are null, empty, or whose joined tokens of either side are not space + text have no tokens: all
numbers are 0 and the checksum is ''. Strings of special tokens within a text are ordinary text. doc_id may be null or
repeated: rows are told apart by their place, and a repeated row counts as one more document. Other columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import CACHE_PARTS, LONGEST_CACHED, SPECIAL, Encoder, _byte_alphabet, part_hashes
from .tables import bounded_batches, stored
from .words import row_slices, text_buffers

SLICE = 2 << 20
#: Text whose slices are completed together.
GROUP_BYTES = 64 << 20
_DOC = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_STORED = (
    "part long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "n_pairs array<int>, pair binary, docs binary, ref binary, times binary"
)


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """The bytes and the decimal writing of every id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        digits = [str(k).encode() for k in range(len(tokens))]
        self.digits = np.array([len(d) for d in digits], dtype=np.uint64)
        self.written = np.frombuffer(b"".join(d.ljust(8, b"\0") for d in digits), dtype="<u8")

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens."""
        sizes = self.size[ids]
        total = np.cumsum(sizes)
        return self.flat[np.repeat(self.at[ids] - total + sizes, sizes) + np.arange(total[-1] if len(total) else 0)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum())), sizes


def _spaced(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_buffers(pa.array([" " + t for t in texts], pa.large_string()))


class ByteLevel(Vocabulary):
    """Byte-level BPE of space + text; special tokens are ordinary text.

    With the pre-tokeniser that the packing operator's encoder knows, equal parts of texts are encoded once."""

    KNOWN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.tokenizer = self.encoder.tokenizer
        self.tokenizer.encode_special_tokens = True
        made = json.loads(self.tokenizer.to_str())
        how = {k: v for k, v in (made["pre_tokenizer"] or {}).items() if k != "trim_offsets"}
        self.by_parts = how == self.KNOWN and made["normalizer"] is None and not made["model"].get("dropout")
        self.by_parts &= [t["content"] for t in made["added_tokens"]] in ([], [SPECIAL])
        back = {c: b for b, c in _byte_alphabet().items()}
        known = {k: t for t, k in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        super().__init__([bytes(back.get(c, 0) for c in known.get(k, "")) for k in range(max(known) + 1)])

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.by_parts and texts:
            ids, bounds = self.encoder.encode(*_spaced(texts))
            return ids.astype(np.int64), np.diff(bounds)
        return _flat([e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)])


class Pieces(Vocabulary):
    """Sentence pieces with byte fallback; the model itself puts a space before the text.

    If no piece has a space behind another character, no merge crosses the start of a run of spaces: texts are split there,
    and equal parts are encoded once. (A text that has U+2581 itself may be split elsewhere; it is not given back in any case.)"""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        plain = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        super().__init__(plain)
        self.space = self.model.piece_to_id("▁")
        keeps_spaces = self.model.encode("  a  b ", out_type=str)
        self.by_parts = not any("▁" in p.lstrip("▁") for p in pieces) and "".join(keeps_spaces) == "▁▁▁a▁▁b▁"
        self.cache: dict[str, list[int]] = {}

    def _parts(self, parts: list[str]) -> list[list[int]]:
        if len(self.cache) > CACHE_PARTS:
            self.cache = {}
        new = [p for p in parts if p not in self.cache]
        found = dict(zip(new, self.model.encode([p[1:] for p in new], num_threads=1), strict=True))
        if " " in found:
            found[" "] = [self.space]
        self.cache |= {p: ids for p, ids in found.items() if len(p) <= LONGEST_CACHED}
        return [self.cache.get(p) or found[p] for p in parts]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not (self.by_parts and texts):
            return _flat(self.model.encode(texts, num_threads=1))
        raw, bounds = _spaced(texts)
        opens = raw == 0x20
        opens[1:] &= raw[:-1] != 0x20
        opens[bounds[:-1]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(raw))
        _, first, which = np.unique(part_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        data = raw.tobytes()
        flat, size = _flat(self._parts([data[lo:hi].decode() for lo, hi in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]))
        sizes = size[which]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(starts, bounds)])


@lru_cache(maxsize=1)
def _sides(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    """One pair for each Python worker."""
    return ByteLevel(a), Pieces(b)


def interval_groups(starts: list[np.ndarray], ends: list[np.ndarray]) -> list[np.ndarray]:
    """Group number of every interval of each side. Intervals that overlap, or are linked by overlaps, share a group."""
    start, end = np.concatenate(starts), np.concatenate(ends)
    side = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), dtype=np.int64)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(opens) - 1
    return np.split(group, np.cumsum([len(s) for s in starts])[:-1])


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of A, place of B) of every overlapping pair. The intervals of a side lie end to end."""
    low = np.searchsorted(b_end, a_start, "right")
    n = np.searchsorted(b_start, a_end, "left") - low
    total = np.cumsum(n)
    return np.repeat(np.arange(len(n)), n), np.repeat(low - total + n, n) + np.arange(total[-1] if len(total) else 0)


class Aligned:
    """The alignment of a slice of texts: tokens of both sides, their groups and links, and the document of each."""

    def __init__(self, texts: list[str], sides: tuple[Vocabulary, Vocabulary]):
        self.n = len(texts)
        self.sides = sides
        full = np.array([k for k, t in enumerate(texts) if t], dtype=np.int64)
        found = [side.ids([texts[k] for k in full.tolist()]) for side in sides] if len(full) else [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2
        good = self._same([texts[k] for k in full.tolist()], found)
        self.ids, self.doc, self.start, self.end = [], [], [], []
        for side, (ids, sizes) in zip(sides, found, strict=True):
            keep = np.repeat(good, sizes)
            self.ids.append(ids[keep])
            self.doc.append(np.repeat(full[good], sizes[good]))
            self.end.append(np.cumsum(side.size[self.ids[-1]]))
            self.start.append(self.end[-1] - side.size[self.ids[-1]])
        self.group = interval_groups(self.start, self.end)
        self.a, self.b = overlaps(self.start[0], self.end[0], self.start[1], self.end[1])

    def _same(self, texts: list[str], found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Which texts both sides give back whole."""
        whole = [b" " + t.encode() for t in texts]
        good = np.ones(len(texts), dtype=bool)
        for side, (ids, sizes) in zip(self.sides, found, strict=True):
            data = side.joined(ids).tobytes()
            ends = np.concatenate([[0], np.cumsum(side.size[ids])])[np.cumsum(sizes)].tolist()
            good &= np.array([data[lo:hi] == t for lo, hi, t in zip([0, *ends][:-1], ends, whole, strict=True)], dtype=bool)
        return good

    def per_doc(self, docs: np.ndarray) -> np.ndarray:
        return np.bincount(docs, minlength=self.n)

    def n_groups(self) -> np.ndarray:
        opens = np.diff(self.group[0], prepend=-1) > 0
        return self.per_doc(self.doc[0][opens])

    def checksums(self) -> list[str]:
        """SHA-256 of the groups as text, '' without tokens."""
        (a_ids, b_ids), (a_group, b_group) = self.ids, self.group
        out = np.empty(len(a_ids) + len(b_ids), dtype="<u8")
        last_a, last_b = np.diff(a_group, append=-1) != 0, np.diff(b_group, append=-1) != 0
        ends_doc = np.diff(self.doc[1], append=-1) != 0
        places = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group, "left"), np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, "right")
        marks = np.where(last_a, ord("|"), ord(",")), np.where(ends_doc, 0, np.where(last_b, ord(";"), ord(",")))
        size = np.zeros(self.n, dtype=np.int64)
        for side, ids, place, mark, doc in zip(self.sides, (a_ids, b_ids), places, marks, self.doc, strict=True):
            out[place] = side.written[ids] | mark.astype(np.uint64) << (side.digits[ids] * np.uint64(8))
            size += np.bincount(doc, weights=side.digits[ids] + (mark > 0), minlength=self.n).astype(np.int64)
        flat = out.view(np.uint8)
        data = flat[flat > 0].tobytes()
        ends = np.cumsum(size).tolist()
        return [hashlib.sha256(data[lo:hi]).hexdigest() if hi > lo else "" for lo, hi in zip([0, *ends][:-1], ends, strict=True)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(distinct pairs, documents of each; per document and pair: place of the pair and number of links, with the document)."""
        width = len(self.sides[1].size)
        pair, place = np.unique(self.ids[0][self.a] * width + self.ids[1][self.b], return_inverse=True)
        seen, times = np.unique(self.doc[0][self.a] * max(len(pair), 1) + place, return_counts=True)
        doc, ref = np.divmod(seen, max(len(pair), 1))
        return pair, np.bincount(ref, minlength=len(pair)), np.stack([doc, ref]), times


_CODEC = "zstd"


def _squeezed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32 by byte planes, compressed; most upper planes are zero."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.Codec(_CODEC, compression_level=1).compress(planes.tobytes(), asbytes=True)


def _restored(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.Codec(_CODEC).decompress(data[8:], 4 * n, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, n).T).view("<u4").reshape(-1).astype(np.int64)


def _align(paths: tuple[str, str] | None):
    """One row per slice of texts, with everything but corpus-wide counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        sides = _sides(*(paths or tokenizer_paths()))
        part, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            _, bounds = text_buffers(batch.column("text"))
            for lo, hi in row_slices(bounds, SLICE):
                texts = pc.fill_null(batch.column("text").slice(lo, hi - lo), "").to_pylist()
                found = Aligned(texts, sides)
                pair, docs, seen, times = found.pairs()
                counts = [found.per_doc(d) for d in (found.doc[0], found.doc[1])] + [found.n_groups(), found.per_doc(found.doc[0][found.a])]
                fresh = np.diff(seen[0], prepend=-1) > 0
                ref = np.where(fresh, seen[1], np.diff(seen[1], prepend=0))
                columns = [pa.array([part + filled // GROUP_BYTES], pa.int64()), pa.array([batch.column("doc_id").slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64()))]
                columns += [pa.array([c], pa.list_(pa.int64())) for c in counts]
                columns += [pa.array([found.checksums()], pa.list_(pa.string())), pa.array([np.bincount(seen[0], minlength=found.n).astype(np.int32)], pa.list_(pa.int32()))]
                columns += [pa.array([_squeezed(x)], pa.binary()) for x in (np.diff(pair, prepend=0), docs, ref, times)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", *_DOC, "n_pairs", "pair", "docs", "ref", "times"])
                filled += int(bounds[hi] - bounds[lo])

    return run


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of every part with the documents that hold them; slices of a part follow each other."""

    def out(part: int, found: list) -> pa.RecordBatch:
        pair, back = np.unique(np.concatenate([p for p, _ in found]), return_inverse=True)
        docs = np.bincount(back, weights=np.concatenate([d for _, d in found]), minlength=len(pair)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.repeat(part, len(pair)), pa.array(pair), pa.array(docs)], names=["part", "pair", "docs"])

    part, found = None, []
    for batch in batches:
        for p, pair, docs in zip(*(batch.column(c).to_pylist() for c in ("part", "pair", "docs")), strict=True):
            if p != part and found:
                yield out(part, found)
                found = []
            part = p
            found.append((np.cumsum(_restored(pair)), _restored(docs)))
    if found:
        yield out(part, found)


def _complete(best: np.ndarray, width: int):
    """Documents of a part with the counts of their pairs."""

    def run(slices: pa.Table, counts: pa.Table) -> pa.Table:
        pair, n = counts.column("pair").to_numpy(), counts.column("n").to_numpy()
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], n[order]
        done = []
        for row in slices.to_batches(max_chunksize=1):
            own = np.cumsum(_restored(row.column("pair")[0].as_py()))
            count = n[np.searchsorted(pair, own)] if len(own) else own
            top = count == best[own // width]
            sizes = row.column("n_pairs").flatten().to_numpy().astype(np.int64)
            steps, times = _restored(row.column("ref")[0].as_py()), _restored(row.column("times")[0].as_py())
            doc = np.repeat(np.arange(len(sizes)), sizes)
            # References of a document are steps from its first one.
            total = np.cumsum(steps)
            before = np.concatenate([[0], total])[np.cumsum(sizes) - sizes]
            ref = total - np.repeat(before, sizes)
            sums = np.zeros((2, len(sizes)), dtype=np.int64)
            np.add.at(sums[0], doc, times * top[ref])
            np.add.at(sums[1], doc, times * count[ref])
            columns = {c: row.column(c).flatten() for c in _DOC}
            columns |= {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
            done.append(pa.table({c: columns[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")}))
        return pa.concat_tables(done)

    return run


def align(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `paths` None: the public byte-level vocabulary and sentence pieces that every executor has."""
    bounded_batches(docs)
    sides = _sides(*(paths or tokenizer_paths()))
    width = len(sides[1].size)
    slices = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_align(paths), _STORED), "aligned")
    asked = slices.select("part", "pair", "docs").mapInArrow(_asked, "part long, pair long, docs long")
    counts = stored(asked.groupBy("pair").agg(F.sum("docs").alias("n")), "pairs")
    best = np.zeros(len(sides[0].size), dtype=np.int64)
    # One row for each id of the first vocabulary at most.
    for row in counts.groupBy(F.floor(F.col("pair") / width).cast("int").alias("id")).agg(F.max("n").alias("n")).collect():
        best[row["id"]] = row["n"]
    answers = asked.select("part", "pair").join(counts, "pair")
    left, right = slices.drop("docs").groupBy("part"), answers.select("part", "pair", "n").groupBy("part")
    return left.cogroup(right).applyInArrow(_complete(best, width), _OUT)


def token_links(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """The links themselves, one row each: doc_id, group_no (within the document), a_pos, a_id, b_pos, b_id."""
    bounded_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        sides = _sides(*(paths or tokenizer_paths()))
        for batch in batches:
            _, bounds = text_buffers(batch.column("text"))
            for lo, hi in row_slices(bounds, SLICE):
                found = Aligned(pc.fill_null(batch.column("text").slice(lo, hi - lo), "").to_pylist(), sides)
                doc = found.doc[0][found.a]
                first = [np.concatenate([[0], np.cumsum(found.per_doc(d))]) for d in found.doc]
                groups = np.concatenate([[0], np.cumsum(found.n_groups())])
                columns = [
                    batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)),
                    pa.array(found.group[0][found.a] - groups[doc]),
                    pa.array(found.a - first[0][doc]),
                    pa.array(found.ids[0][found.a]),
                    pa.array(found.b - first[1][doc]),
                    pa.array(found.ids[1][found.b]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "group_no", "a_pos", "a_id", "b_pos", "b_id"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, group_no long, a_pos long, a_id long, b_pos long, b_id long")
