"""Language identification by prediction by partial matching under frozen statistics (operator 8).

Training counts every (context, byte) of up to `order` preceding bytes, A-Z lower-cased, per language. The counts form
one context tree per language. A symbol is coded by the longest context that has been seen; a symbol that is new there
costs an escape (method C: types / (count + types)) and goes on with the next shorter context, down to uniform bytes. With
frozen counts the cost of a byte depends on the `order` bytes before it only, so the trees are unrolled once into a table
(known context state, byte) -> bits per language and texts are scored by looking it up. The table has rows for the
`max_contexts` most frequent contexts of each language and their suffixes; bytes after any other known context are looked
up in the sparse tree itself, at the same cost in bits. The language with the shortest code wins (ties: the smaller name);
its score is its posterior under equal priors.

Defined cases: null text, empty text, or text without a letter gives `und`, score 0. No training rows: every text is
`und`. Any number of languages; rows without a language are not learnt from. A repeated row counts as often as it occurs.
No count is dropped: all contexts (at most 256^order a language) take part in every order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import bounded_batches, shielded, stored
from .words import _LOWER, row_slices, text_buffers

ORDER = 3
MAX_CONTEXTS = 16_384
UNKNOWN = "und"
#: The pipeline rejects a document whose winner has less than this posterior.
MIN_SCORE = 0.5


def _codes(raw: np.ndarray, bounds: np.ndarray, order: int) -> np.ndarray:
    """Each byte with the `order` bytes before it as one number; before a text lie zero bytes."""
    low = _LOWER[raw].astype(np.int64)
    out = low.copy()
    offset = np.arange(len(raw)) - np.repeat(bounds[:-1], np.diff(bounds))
    for k in range(1, order + 1):
        before = np.zeros_like(low)
        before[k:] = low[:-k]
        before[offset < k] = 0
        out += before << (8 * k)
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(back, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _count_grams(order: int, keep: int = 1 << 19):
    """Counts of a task's texts per language; parts are merged when they hold `keep` entries, and then put out if still as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list] = {}

        def out(lang: str) -> pa.RecordBatch:
            grams, n = _merged(parts.pop(lang))
            return pa.RecordBatch.from_arrays([pa.repeat(lang, len(grams)), pa.array(grams.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            raw_all, bounds_all = text_buffers(batch.column("text"))
            names, codes = np.unique(np.asarray(batch.column("lang").to_pylist(), dtype=str), return_inverse=True)
            for lo, hi in row_slices(bounds_all):
                bounds = bounds_all[lo : hi + 1] - bounds_all[lo]
                grams = _codes(raw_all[bounds_all[lo] : bounds_all[hi]], bounds, order)
                grams = grams.astype(np.uint32) if order <= 3 else grams
                owner = np.repeat(codes[lo:hi], np.diff(bounds))
                for k in np.unique(owner):
                    own = parts.setdefault(str(names[k]), [])
                    own.append(np.unique(grams[owner == k], return_counts=True))
                    if sum(len(g) for g, _ in own) > keep:
                        own[:] = [_merged(own)]
                        if len(own[0][0]) > keep // 2:
                            yield out(str(names[k]))
        for lang in list(parts):
            yield out(lang)

    return run


class Tree:
    """One language's context tree as sorted tables: for each depth the contexts with their bits of an escape, and the
    seen (context, symbol) with their bits."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, order: int, symbols: np.ndarray):
        self.width = int(symbols.max()) + 1
        self.levels: list[tuple[np.ndarray, ...]] = []
        own, n = _gram_codes(grams, order, symbols), np.asarray(n, dtype=np.float64)
        for depth in range(order + 1):
            seen, back = np.unique(own % self.width ** (depth + 1), return_inverse=True)
            count = np.bincount(back, weights=n)
            contexts, row = np.unique(seen // self.width, return_inverse=True)
            total, types = np.bincount(row, weights=count), np.bincount(row)
            scale = total + types
            # What the shorter context leaves to the symbols not seen here, in exact counts.
            if depth:
                at = np.searchsorted(shorter[0], contexts % self.width ** (depth - 1))
                taken = np.bincount(row, weights=shorter[4][np.searchsorted(shorter[3], seen % self.width**depth)])
                rest = (shorter[2][at] + shorter[1][at] - taken) / (shorter[1][at] + shorter[2][at])
            else:
                rest = np.full(len(contexts), (self.width - len(seen)) / 256)
            shorter = (contexts, total, types, seen, count)
            escape = -np.log2(types / scale / np.maximum(rest, 1e-300))
            self.levels.append((contexts, escape, seen, -np.log2(count / scale[row])))

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Bits of symbols, each given as a number together with the `order` symbols before it."""
        out, open_ = np.zeros(len(codes)), np.arange(len(codes))
        for depth in range(len(self.levels) - 1, -1, -1):
            contexts, escape, seen, cost = self.levels[depth]
            if not len(seen):
                continue
            asked = codes[open_] % self.width ** (depth + 1)
            at = np.minimum(np.searchsorted(seen, asked), len(seen) - 1)
            hit = seen[at] == asked
            out[open_[hit]] += cost[at[hit]]
            open_, asked = open_[~hit], asked[~hit] // self.width
            at = np.minimum(np.searchsorted(contexts, asked), len(contexts) - 1)
            out[open_] += np.where(contexts[at] == asked, escape[at], 0.0)
        out[open_] += 8.0
        return np.minimum(out, -np.log2(1e-12))


class Model:
    """Frozen statistics as a table: state of the preceding bytes and the byte -> bits in each language; the trees for
    contexts without a state."""

    def __init__(self, languages: list[str], order: int, symbols: np.ndarray, states: np.ndarray, bits: np.ndarray, trees: list[Tree]):
        self.languages, self.order, self.symbols, self.states, self.bits, self.trees = languages, order, symbols, states, bits, trees

    def costs(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits of every row in every language."""
        out = np.zeros((len(bounds) - 1, len(self.languages)))
        if not len(raw):
            return out
        width = int(self.symbols.max()) + 1
        sym = self.symbols[_LOWER[raw]].astype(np.int32)
        context = np.zeros(len(raw), dtype=np.int32)
        offset = np.arange(len(raw)) - np.repeat(bounds[:-1], np.diff(bounds))
        for k in range(self.order, 0, -1):
            before = np.zeros_like(sym)
            before[k:] = sym[:-k]
            before[offset < k] = self.symbols[0]
            context = context * width + before
        state = self.states[context]
        odd = np.flatnonzero(state < 0)
        codes, back = np.unique(context[odd].astype(np.int64) * width + sym[odd], return_inverse=True)
        at = np.maximum(state, 0) * width + sym
        full = np.flatnonzero(np.diff(bounds))
        for k in range(len(self.languages)):
            bits = self.bits[k].take(at)
            if len(odd):
                bits[odd] = self.trees[k].bits(codes)[back]
            out[full, k] = np.add.reduceat(bits, bounds[full], dtype=np.float64)
        return out


def _gram_codes(grams: np.ndarray, order: int, symbols: np.ndarray) -> np.ndarray:
    """Grams as numbers over the symbols, first byte highest."""
    width = int(symbols.max()) + 1
    code = np.zeros(len(grams), dtype=np.int64)
    for k in range(order, -1, -1):
        code = code * width + symbols[(grams >> (8 * k)) & 255]
    return code


def _ppm_bits(grams: np.ndarray, n: np.ndarray, order: int, symbols: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Bits of every symbol after each context (rows: contexts as numbers over the symbols, longest first byte)."""
    width = int(symbols.max()) + 1
    sym = np.stack([symbols[(grams >> (8 * k)) & 255] for k in range(order + 1)], axis=1).astype(np.int64)
    p = np.full((len(contexts), width), 1.0 / 256)
    for depth in range(order + 1):
        own = np.zeros(len(grams), dtype=np.int64)
        asked = contexts % (width**depth) if depth else np.zeros(len(contexts), dtype=np.int64)
        for k in range(depth, 0, -1):
            own = own * width + sym[:, k]
        keys, first = np.unique(own, return_inverse=True)
        cell, back = np.unique(first.astype(np.int64) * width + sym[:, 0], return_inverse=True)
        count = np.bincount(back, weights=n)
        row = cell // width
        total, types = np.bincount(row, weights=count, minlength=len(keys)), np.bincount(row, minlength=len(keys))
        at = np.searchsorted(keys, asked)
        at[at == len(keys)] = 0
        seen = keys[at] == asked
        starts = np.searchsorted(row, np.arange(len(keys) + 1))
        for lo in range(0, len(contexts), 4096):
            hi = min(lo + 4096, len(contexts))
            block = at[lo:hi][seen[lo:hi]]
            if not len(block):
                continue
            counts = np.zeros((len(block), width))
            sizes = starts[block + 1] - starts[block]
            who = np.repeat(np.arange(len(block)), sizes)
            where = np.repeat(starts[block], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            counts[who, cell[where] % width] = count[where]
            scale = (total[block] + types[block])[:, None]
            parent = p[lo:hi][seen[lo:hi]]
            known = counts > 0
            rest = np.where(known, 0.0, parent).sum(axis=1, keepdims=True)
            escape = types[block][:, None] / scale
            p_new = np.where(known, counts / scale, escape * parent / np.maximum(rest, 1e-300))
            p[np.arange(lo, hi)[seen[lo:hi]]] = p_new
    return -np.log2(np.maximum(p, 1e-12)).astype(np.float32)


def train(labelled: DataFrame, order: int = ORDER, max_contexts: int = MAX_CONTEXTS) -> Model:
    """Learn from the columns text and lang of all rows given. What reaches the driver is one count for each distinct
    gram of a language, never rows."""
    bounded_batches(labelled)
    rows = labelled.select(F.col("text"), F.col("lang").cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    grams = rows.mapInArrow(_count_grams(order), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    grams = stored(grams, "grams")
    languages = sorted(r["lang"] for r in grams.select("lang").distinct().collect())
    counts = {}
    for lang in languages:
        part = grams.filter(F.col("lang") == lang).select("gram", "n").toArrow()
        counts[lang] = (part.column("gram").to_numpy(), part.column("n").to_numpy().astype(np.float64))
    return build(languages, counts, order, max_contexts)


def build(languages: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int, max_contexts: int = MAX_CONTEXTS) -> Model:
    used = np.zeros(256, dtype=bool)
    used[0] = True
    for grams, _ in counts.values():
        for k in range(order + 1):
            used[np.unique((grams >> (8 * k)) & 255)] = True
    symbols = np.zeros(256, dtype=np.int64)
    symbols[~used] = used.sum()  # all bytes never seen share one symbol
    symbols[used] = np.arange(used.sum())
    width = int(symbols.max()) + 1
    known, rows = [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)]
    for grams, n in counts.values():
        contexts, back = np.unique(_gram_codes(grams, order, symbols) // width, return_inverse=True)
        known.append(contexts)
        rows.append(contexts[np.argsort(-np.bincount(back, weights=n), kind="stable")[:max_contexts]])
    known, rows = np.unique(np.concatenate(known)), np.unique(np.concatenate(rows))
    # A context that was never seen whole falls back to its longest suffix that was: one state for each suffix with a row.
    # -1: the longest known suffix has no row.
    states = np.full(width**order, -2, dtype=np.int32)
    reached, size = [], 0
    for depth in range(order, -1, -1):
        marked = states.reshape(width ** (order - depth), width**depth)
        ids = np.full(width**depth, -2, dtype=np.int32)
        ids[known % (width**depth)] = -1
        suffix = np.unique(rows % (width**depth))
        ids[suffix] = np.arange(size, size + len(suffix))
        size += len(suffix)
        np.copyto(marked, ids[None, :], where=marked == -2)
        reached.append((depth, suffix))
    bits = [np.concatenate([_suffix_bits(counts[lang], order, depth, symbols, asked) for depth, asked in reached]).ravel() for lang in languages]
    trees = [Tree(*counts[lang], order, symbols) for lang in languages]
    return Model(languages, order, symbols, states.ravel(), np.stack(bits) if bits else np.zeros((0, 0), dtype=np.float32), trees)


def _suffix_bits(counts: tuple[np.ndarray, np.ndarray], order: int, depth: int, symbols: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    grams, n = counts
    return _ppm_bits(grams & ((1 << (8 * (depth + 1))) - 1), n, depth, symbols, contexts)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score; existing columns of these names are replaced. Only the text is looked at."""
    bounded_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base, names_back = shielded(docs.drop("lang_pred", "score"), ["_letters"])
    clean = base.withColumn("_letters", F.coalesce(F.regexp_like(F.col(text), F.lit(r"\p{L}")), F.lit(False)))
    schema = T.StructType([*clean.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            raw_all, bounds_all = text_buffers(batch.column(text))
            letters = batch.column("_letters").to_numpy(zero_copy_only=False)
            names, scores = np.full(len(letters), UNKNOWN, dtype=object), np.zeros(len(letters))
            for lo, hi in row_slices(bounds_all) if known.languages else ():
                bits = known.costs(raw_all[bounds_all[lo] : bounds_all[hi]], bounds_all[lo : hi + 1] - bounds_all[lo])
                best = bits.argmin(axis=1)
                behind = bits - bits[np.arange(len(bits)), best][:, None]
                own = letters[lo:hi]
                names[lo:hi] = np.where(own, np.array(known.languages, dtype=object)[best], UNKNOWN)
                scores[lo:hi] = np.where(own, 1.0 / np.exp2(-np.minimum(behind, 1000)).sum(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores)], names=[*batch.schema.names, "lang_pred", "score"])

    return names_back(clean.mapInArrow(run, schema).drop("_letters"))


def fold(doc_id: str, folds: int) -> Column:
    """Fold of a document; a null id is in none (null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def identify(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Train on the four folds of five that are not held out, then predict every row."""
    return predict(docs, train(docs.filter(fold("doc_id", 5) != 0), order))
