"""Best-fit decreasing packing of tokenised documents into windows (operator 7).

Texts are tokenised where they are read; only (document, start, length, checksum) goes on, so no text is shuffled. A
document of more than `window` tokens is first cut into full windows and a rest. Rests are dealt into groups by a hash of their row number, a
group being a bounded number of pieces, and each group is packed on its own: pieces by falling length, each into the
tightest open window that still takes it, found in a segment tree over the remaining capacities. The waste of grouping is
at most a few windows a group of up to `GROUP_PIECES` pieces.

Tokenising gives the tokenizer's own ids, with less work: texts are split where its pre-tokens always end (at a single space
or line feed between words), equal parts are encoded once, and ids of short parts are kept in a bounded cache. That holds for
vocabularies with the public one's pre-tokens; texts for any other tokenizer file go through the whole of it.

Defined cases: a null or empty text is one piece of the end id alone. A null doc_id is packed like any other. Repeated
rows are packed once each. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, stored
from .words import row_slices, span_hashes, text_buffers

WINDOW = 1024
END_ID = 0
GROUP_PIECES = 65_536
#: Entries of the younger half of the cache; the older half is what was young before.
CACHE_PARTS = 200_000
LONGEST_CACHED = 40
SLICE = 4 << 20
#: Bytes hashed at once.
HASHED = 1 << 19
#: ASCII but white space.
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[:0x80] = True
_PLAIN[[0x20, *range(0x09, 0x0E)]] = False
#: Characters that the pattern's library counts as white space and the tokenizer doesn't.
_ODD = re.compile("[\x1c-\x1f]")
#: Fixed values of the vocabulary: its pre-token pattern and its one special token.
_PRETOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SPECIAL = "<|endoftext|>"


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in a byte-level vocabulary: itself where printable, else 256, 257, ... in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


def by_parts(form: dict) -> bool:
    """Whether a tokenizer (its file's content) gives a text's ids part by part: pre-tokens and special token as expected, no
    normaliser, and nothing that depends on the rest of the text."""
    split, model, plain = form.get("pre_tokenizer") or {}, form["model"], ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
    expected = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    special = [(t["content"], t["single_word"], t["lstrip"], t["rstrip"]) for t in form["added_tokens"]]
    return (
        {k: split.get(k) for k in expected} == expected
        and not any(form.get(k) for k in ("normalizer", "post_processor", "truncation", "padding"))
        and special == [(SPECIAL, False, False, False)]
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in plain)
    )


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    Pre-tokens of a new part go straight to the tokenizer's model; a part with the special token goes through all of it.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.by_parts = by_parts(json.loads(self.tokenizer.to_str()))
        self.alphabet = _byte_alphabet()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, part: str) -> bytes:
        if part.isascii() and part[-1] > " ":  # then only the first character can be white space
            shown = part if part[0] > " " else self.alphabet[ord(part[0])] + part[1:]
        else:
            shown = part.encode().decode("latin-1").translate(self.alphabet)
        ids = array("I", [t.id for t in self.model.tokenize(shown)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _learn(self, new: set[str]) -> None:
        cache, word = self.cache, self._word
        for part in new:
            if (part[1:] if part[0] == " " else part).isalpha():
                cache[part] = word(part)
            elif SPECIAL in part or _ODD.search(part):
                cache[part] = self._whole([part])[0]
            else:
                pieces = _PRETOKENS.findall(part)
                for piece in pieces:
                    if piece not in cache:
                        cache[piece] = word(piece)
                cache[part] = b"".join([cache[piece] for piece in pieces])

    def part_ids(self, parts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHE_PARTS:
            self.older, self.cache = self.cache, {}
        cache, older = self.cache, self.older
        new = set(parts)
        new.difference_update(cache.keys())
        known = new & older.keys()
        cache.update(zip(known, map(older.__getitem__, known), strict=True))
        new -= known
        self._learn(new)
        out = list(map(cache.__getitem__, parts))
        for p in new:
            if len(p) > LONGEST_CACHED:
                cache.pop(p, None)
        return out

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text's ids). Equal parts are told by a 64-bit hash and encoded once."""
        if not self.by_parts:
            data = raw.tobytes()
            whole = self._whole([data[lo:hi].decode() for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)])
            return np.frombuffer(b"".join(whole), dtype="<u4"), np.cumsum([0, *(len(w) // 4 for w in whole)])
        starts = part_starts(raw, bounds)
        ends = np.append(starts[1:], len(raw))
        _, first, which = np.unique(part_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        data = raw.tobytes()
        found = self.part_ids([data[lo:hi].decode() for lo, hi in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        at = np.cumsum(size) - size
        sizes = size[which]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.repeat(at[which] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, bounds)]


def part_starts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where texts are split: at a space or line feed between two characters that are surely no white space. There the
    pre-token before has ended, and the one that follows starts with the space, or the line feed stands alone."""
    n = len(raw)
    start = np.zeros(n, dtype=bool)
    if n > 2:
        two_bytes = (raw[:-1] >= 0xC3) & (raw[:-1] <= 0xDF)  # first byte of a character of two, none of them white space
        before = np.zeros(n, dtype=bool)
        before[:-1] = _PLAIN[raw[:-1]]
        before[1:] |= two_bytes
        after = _PLAIN[raw] | ((raw >= 0xC3) & (raw <= 0xDF))
        start[1:-1] = ((raw[1:-1] == 0x20) | (raw[1:-1] == 0x0A)) & before[:-2] & after[2:]
    start[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(start)


def part_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every part; about `HASHED` bytes at a time, so that the arrays in between stay small. Parts lie end to end."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = np.unique(np.searchsorted(starts, np.arange(0, len(raw), HASHED)))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(starts)], strict=True):
        if b > a:
            out[a:b] = span_hashes(raw[starts[a] : ends[b - 1]], starts[a:b] - starts[a], ends[a:b] - starts[a])
    return out


@lru_cache(maxsize=1)
def encoder(tokenizer_file: str) -> Encoder:
    """One for each Python worker: its cache serves the tasks that follow."""
    return Encoder(tokenizer_file)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _cut(window: int, end_id: int, tokenizer_file: str | None, with_ids: bool = False):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(tokenizer_file or tokenizer_path()).encode
        for batch in batches:
            raw_all, bounds_all = text_buffers(batch.column("text"))
            names_all = batch.column("doc_id").to_pylist()
            for first, last in row_slices(bounds_all, SLICE):
                doc, start, length, crc, total, ids = [], [], [], [], [], []
                tokens, at = encode(raw_all[bounds_all[first] : bounds_all[last]], bounds_all[first : last + 1] - bounds_all[first])
                data, at = tokens.tobytes(), (4 * at).tolist()
                for d, p, q in zip(names_all[first:last], at[:-1], at[1:], strict=True):
                    b = data[p:q]
                    b += end
                    n = len(b) // 4
                    for lo in range(0, n, window):
                        piece = b[4 * lo : 4 * (lo + window)]
                        doc.append(d)
                        start.append(lo)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        if with_ids:
                            ids.append(np.frombuffer(piece, dtype="<u4").astype(np.int32))
                columns = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
        pa.default_memory_pool().release_unused()  # the worker lives on

    return run


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree that finds the smallest sufficient one."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, capacity: int, by: int) -> None:
        k = capacity + self.leaves
        while k:
            self.tree[k] += by
            k >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        if len(self.open[capacity]) == 1:
            self._change(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(window, its capacity) of the tightest window with at least this capacity."""
        tree, k = self.tree, least + self.leaves
        if not tree[k]:
            while k and not (k % 2 == 0 and tree[k + 1]):
                k >>= 1
            if not k:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if tree[2 * k] else 2 * k + 1
        capacity = k - self.leaves
        window = self.open[capacity].pop()
        if not self.open[capacity]:
            self._change(capacity, -1)
        return window, capacity


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset) of every piece; `lengths` must fall."""
    number, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    windows, used = OpenWindows(window), 0
    for i, n in enumerate(lengths.tolist()):
        found = windows.take(n)
        if found is None:
            found, used = (used, window), used + 1
        number[i], offset[i] = found[0], window - found[1]
        if found[1] > n:
            windows.put(found[1] - n, found[0])
    return number, offset


def _pack(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        group = pa.Table.from_batches(parts).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        number, offset = best_fit_decreasing(group.column("length").to_numpy(), window)
        base = TaskContext.get().partitionId() << 33
        yield from group.append_column("sequence_id", pa.array(number + base)).append_column("offset", pa.array(offset)).to_batches()

    return run


def pack(
    docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, tokenizer_file: str | None = None, group_pieces: int = GROUP_PIECES, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    `tokenizer_file` None: the public byte-level vocabulary that every executor has. `sequence_id` is unique, not gapless.
    """
    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    bounded_batches(docs)
    pieces = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_cut(window, end_id, tokenizer_file, with_ids=with_ids), columns).withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = pieces.count() // group_pieces + 1
    dealt = pieces.repartition(groups, F.xxhash64("row", F.lit(7))).drop("row")
    return dealt.mapInArrow(_pack(window), columns + ", sequence_id long, offset long")
