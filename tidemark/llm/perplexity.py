"""Language-model scores by a hierarchical Pitman-Yor model (operator 3).

Restaurants: the root restaurant of words, whose base is uniform over the words and one unknown word, and below it
one restaurant for the context of each word and of a text's start; all share the root as parent. Counts are exact and
cover all training rows and words.

The `VOCABULARY` most frequent words are numbered, and what is known of them is kept in arrays (34 MB at most, broadcast once). The other words
go by their 64-bit hash: pairs with such a word and the sums of such words are Spark tables, joined by hash. Their part of
the model is the same; no such word is frequent enough to be a hot key, and pairs' numbered side is salted out of the joins.
Rows are numbered once, in a stored table.

Seating is sampled by Gibbs. The first sweep seats the customers of each (context, word) one after the other (beyond
`ONE_BY_ONE`, an eighth of those before at a time) and is burnt. Every later sweep starts from the seating it finds: a
customer drawn at random gets up, a table left empty goes, and it sits down again given all that remain: at a table by its
customers less the discount, or at a new one by the context's other tables, the pair's own and the parent's probability. A
pair gets as many such steps a sweep as it has customers, `MOVES` at most. Between pairs a sweep goes by the tables and
the parent's probabilities of the sweep before, so that pairs are seated in parallel. Tables are the parent's customers;
the root is seated one after the other in each sweep. The predictive probabilities of the sweeps kept are averaged.

Spark's work: word counts and (context, word) counts are pre-aggregated where texts are read, and dealt out by hash. A
sweep runs over the dealt counts and only returns sums per vocabulary word, a bounded array. Scores never leave the
buckets: each chunk of texts sends its distinct pairs with the places they occur in, a bucket returns one sum for each
text, and sums are added up. A hot pair is one entry per chunk; chunks are dealt into groups of `CHUNKS_PER_TASK`.

A chunk goes by the number of its first row, and draws are seeded by bucket and sweep: a lost task repeats itself.

Defined cases: a null or empty text is scored as the end token alone. A null doc_id is in no fold: it is scored and not
learnt from. Repeated rows are each scored and count as often. No training rows: every token is unknown, probability 1 over
the vocabulary of one. Only doc_id and text are looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, stored
from .words import mix, row_slices, text_buffers, word_hashes

ID_BITS = 19
IDS = 1 << ID_BITS
RARE, START, END, FIRST = 0, 1, 2, 3
VOCABULARY = IDS - FIRST
FOLDS = 10
SWEEPS = 4
STRENGTH = 1.0
BURNT = 1
ONE_BY_ONE = 64
MOVES = 32
#: Numbers of one grid of seatings.
GRID = 1 << 18
CHUNK_BYTES = 10 << 20
PAIRS_PER_BUCKET = 4_000_000
CHUNKS_PER_TASK = 512
BASE_PRIOR = 0.1
#: Hash of the end token: no word has it but by chance.
END_HASH = np.uint64(0x5BD1E995C6A4A793)
_SHIFT, _LOW = np.uint64(ID_BITS), np.uint64(IDS - 1)
#: A slice has fewer rows, so that a pair and a row fit into 64 bits.
_ROW_BITS = 64 - 2 * ID_BITS


def _tokens(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, token hashes with an end for every text, bounds), in slices of about `limit` bytes."""
    raw, bounds = text_buffers(batch.column("text"))
    for lo, hi in ((a, min(z, a + (1 << _ROW_BITS))) for y, z in row_slices(bounds, limit) for a in range(y, z, 1 << _ROW_BITS)):
        hashes, words = word_hashes(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
        ends = words[1:] + np.arange(hi - lo)
        out = np.empty(len(hashes) + hi - lo, dtype=np.uint64)
        is_word = np.ones(len(out), dtype=bool)
        is_word[ends] = False
        out[is_word], out[ends] = hashes, END_HASH
        yield lo, hi, out, np.concatenate([[0], ends + 1])


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches joined to about `limit` bytes of text, so that a chunk repeats much of what it asks."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if sum(map(len, held)):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        words, back = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        return words, np.bincount(back, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

    def batch_of(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    for batch in batches:
        for _, _, tokens, _ in _tokens(batch, CHUNK_BYTES // 4):
            parts.append(np.unique(tokens, return_counts=True))
            if sum(len(w) for w, _ in parts) > 1 << 21:
                parts[:] = [merged()]
                if len(parts[0][0]) > 1 << 20:
                    yield batch_of(*parts.pop())
    if parts:
        yield batch_of(*merged())


def _ids(tokens: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Vocabulary numbers of token hashes (`vocabulary` is sorted)."""
    out = np.full(len(tokens), RARE, dtype=np.uint32)
    if len(vocabulary):
        at = np.searchsorted(vocabulary, tokens)
        at[at == len(vocabulary)] = 0
        known = vocabulary[at] == tokens
        out[known] = at[known] + FIRST
    out[tokens == END_HASH] = END
    return out


def _pairs(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(context, word) of every token as one number."""
    before = np.empty(len(ids), dtype=np.uint64)
    before[1:] = ids[:-1]
    before[bounds[:-1]] = START
    return (before << _SHIFT) | ids


def _sides(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the contexts and of the words."""
    return (pairs >> _SHIFT).astype(np.int64), (pairs & _LOW).astype(np.int64)


def _in_tail(pairs: np.ndarray) -> np.ndarray:
    """Whether the context or the word is beyond the numbered ones."""
    context, word = _sides(pairs)
    return (context == RARE) | (word == RARE)


_TAIL = "row long, context long, word long, cid int, wid int, times long"


def _tail_pairs(shared, by_row: bool):
    """Pairs with a word beyond the numbered ones, counted in each text or in each slice of texts (then of row 0); a text's
    start is the context END_HASH."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, CHUNK_BYTES):
            numbers = batch.column("row").to_numpy() if by_row else np.zeros(len(batch), dtype=np.int64)
            for lo, hi, tokens, bounds in _tokens(batch, CHUNK_BYTES // 4):
                pairs = _pairs(_ids(tokens, shared.value), bounds)
                before = np.concatenate([[END_HASH], tokens[:-1]])
                before[bounds[:-1]] = END_HASH
                at = np.flatnonzero(_in_tail(pairs))
                row = np.repeat(numbers[lo:hi], np.diff(bounds))[at]
                _, first, times = np.unique(mix(mix(before[at]) + tokens[at]) + mix(row.astype(np.uint64)), return_index=True, return_counts=True)
                at, row = at[first], row[first]
                cid, wid = _sides(pairs[at])
                columns = [row, before[at].view(np.int64), tokens[at].view(np.int64), cid.astype(np.int32), wid.astype(np.int32), times]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _TAIL.split(", ")])

    return run


def _with_words(pairs: DataFrame, contexts: DataFrame, words: DataFrame) -> DataFrame:
    """`pairs` with the columns of the context (c_...) and of the word (w_...) where these are beyond the numbered ones."""
    for key, number, of in (("context", "cid", contexts), ("word", "wid", words)):
        side = of.select(F.col("key").alias("_key"), *[F.col(c).alias(f"{key[0]}_{c}") for c in of.columns if c != "key"])
        salted = F.when(F.col(number) == RARE, F.col(key)).otherwise(F.xxhash64("context", "word"))
        pairs = pairs.withColumn("_at", salted).join(side, F.col("_at") == F.col("_key"), "left").drop("_at", "_key")
    return pairs


def _numbers(batch, column: str) -> np.ndarray:
    return np.nan_to_num(batch.column(column).to_numpy(zero_copy_only=False).astype(np.float64)) if isinstance(batch, pa.RecordBatch) else np.nan_to_num(batch.column(column).to_numpy().astype(np.float64))


def _seat_pairs(shared: list, discount: float, k: int):
    """Sweep k over a bucket of tail pairs of several customers: adds t{k}. The sweeps before it repeat their draws."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        sweeps = [s.value for s in shared]
        rows = rows.sort_by([("context", "ascending"), ("word", "ascending")])
        cid, wid = rows.column("cid").to_numpy(), rows.column("wid").to_numpy()
        tables = [np.where(cid == RARE, _numbers(rows, f"c_tables{i}"), s.tables[cid]) for i, s in enumerate(sweeps)]
        root = [np.where(wid == RARE, _numbers(rows, f"w_root{i}"), s.root[wid]) for i, s in enumerate(sweeps)]
        *_, t = seatings(rows.column("n").to_numpy(), tables, root, discount, [key[0].as_py(), 1])
        kept = rows.drop_columns([c for c in rows.column_names if c[:2] in ("c_", "w_")])
        return kept.append_column(f"t{k}", pa.array(t))

    return run


def _seat_words(others: float, uniform: float, discount: float, k: int):
    """The root's tables of words beyond the numbered ones. The result is stored before it is used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.sort_by("key")
            n = batch.column("customers").to_numpy()
            seed = [int(batch.column("key")[0].as_py()) % 2**64, k] if len(n) else [k]
            t = seat(n, np.full(len(n), others), np.full(len(n), uniform), discount, np.random.default_rng(seed))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(t)], names=[*batch.schema.names, "root_tables"])

    return run


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _count_pairs(shared, buckets: int):
    """Distinct pairs of each slice of texts with their counts, one row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, CHUNK_BYTES):
            for _, _, tokens, bounds in _tokens(batch, 2 * CHUNK_BYTES):
                pairs = _pairs(_ids(tokens, shared.value), bounds)
                pairs, n = np.unique(pairs[~_in_tail(pairs)], return_counts=True)
                where = _bucket(pairs, buckets)
                order = np.argsort(where, kind="stable")
                offsets = np.searchsorted(where[order], np.arange(buckets + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(buckets, dtype=np.int32)), _lists(pairs[order].view(np.int64), offsets), _lists(n[order].astype(np.int32), offsets)],
                    names=["bucket", "pairs", "n"],
                )

    return run


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _merge_pairs(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    pairs, back = np.unique(_flat(rows.column("pairs")).view(np.uint64), return_inverse=True)
    n = np.bincount(back, weights=_flat(rows.column("n"))).astype(np.int64)
    ends = np.array([0, len(pairs)])
    return pa.table([pa.array([key[0].as_py()], pa.int32()), _lists(pairs.view(np.int64), ends), _lists(n, ends)], names=["bucket", "pairs", "n"])


class Sweep:
    """What one sweep knows of vocabulary words: tables of each context, and the root's probability of each word."""

    def __init__(self, tables: np.ndarray, root: np.ndarray):
        self.tables, self.root = tables, root.astype(np.float32)


def seat(customers: np.ndarray, others: np.ndarray, root: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of one dish each, seated one after the other: a customer opens one with weight
    (others + discount * tables) * root, or sits down with weight (customers - discount * tables)."""
    tables = np.minimum(customers, 1).astype(np.float64)
    order = np.argsort(-customers, kind="stable")
    sorted_n, sorted_others, sorted_root = customers[order], others[order], root[order]
    t = tables[order]
    seated = 1
    top = int(sorted_n[0]) if len(sorted_n) else 0
    while seated < top:
        step = 1 if seated < ONE_BY_ONE else max(1, seated // 8)
        live = int(np.searchsorted(-sorted_n, -seated, "left"))  # dishes with more customers than are seated
        more = np.minimum(sorted_n[:live] - seated, step)
        a = (sorted_others[:live] + discount * t[:live]) * sorted_root[:live]
        chance = a / (np.maximum(seated - discount * t[:live], 1e-9) + a)
        t[:live] += rng.random(live) < chance if step == 1 else rng.binomial(more, chance)
        seated += step
    tables[order] = t
    return tables


def shared_out(customers: np.ndarray, tables: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Customers of every table, dish after dish: one each, the others by random shares. A seating to start from."""
    owner = np.repeat(np.arange(len(tables)), tables)
    first = np.cumsum(tables) - tables
    share = rng.gamma(1 - discount, size=len(owner)) + 1e-9
    share /= np.add.reduceat(share, first)[owner] if len(first) else 1
    size = 1 + (share * (customers - tables)[owner]).astype(np.int64)
    if len(first):
        size[first] += customers - np.add.reduceat(size, first)
    return size


def reseat(
    size: np.ndarray, tables: np.ndarray, others: np.ndarray, root: np.ndarray, discount: float, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """(customers of every table, tables of every dish) after one sweep: a customer drawn at random gets up and sits down
    again given all that remain, as often as there are customers, `MOVES` times at most."""
    first = np.cumsum(tables) - tables
    customers = np.add.reduceat(size, first) if len(first) else tables
    moves = np.minimum(customers, MOVES)
    width = np.int64(1) << np.ceil(np.log2(np.maximum(np.minimum(customers, tables + moves), 2))).astype(np.int64)
    order = np.lexsort((-moves, width))
    new_tables = tables.copy()
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(order):
        w = int(width[order[at]])
        rows = order[at : min(int(np.searchsorted(width[order], w, "right")), at + max(1, GRID // w))]
        at += len(rows)
        t = tables[rows]
        line = np.repeat(np.arange(len(rows)), t)
        place = np.arange(len(line)) - np.repeat(np.cumsum(t) - t, t)
        grid = np.zeros((len(rows), w), dtype=np.int64)
        grid[line, place] = size[np.repeat(first[rows], t) + place]
        n, a, r, m = customers[rows], others[rows], root[rows], moves[rows]
        for step in range(int(m[0])):
            live = int(np.searchsorted(-m, -step, "left"))  # dishes with more moves than are made
            g, who = grid[:live], np.arange(live)
            up = rng.random(live) * n[:live]
            g[who, np.minimum((g.cumsum(axis=1) <= up[:, None]).sum(axis=1), w - 1)] -= 1
            taken = g > 0
            weight = (g - discount * taken).cumsum(axis=1)
            x = rng.random(live) * (weight[:, -1] + (a[:live] + discount * taken.sum(axis=1)) * r[:live])
            old = (weight <= x[:, None]).sum(axis=1)
            g[who, np.where(old < w, old, taken.argmin(axis=1))] += 1
        line, place = np.nonzero(grid)
        new_tables[rows] = np.bincount(line, minlength=len(rows))
        kept.append((rows[line], grid[line, place]))
    if not kept:
        return size, tables
    dish, sizes = np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept])
    return sizes[np.argsort(dish, kind="stable")], new_tables


def seatings(n: np.ndarray, tables: list[np.ndarray], root: list[np.ndarray], discount: float, seed: list[int]) -> Iterator[np.ndarray]:
    """Tables of pairs with `n` customers after each sweep; the first state has one table a pair. `tables` and `root`: of the
    pair's context, and the parent's probability of its word, before each sweep. The same draws every time."""
    own = np.ones(len(n))
    yield own
    many = np.flatnonzero(n > 1)
    customers, size, t = n[many], None, np.ones(len(many), dtype=np.int64)
    for k, (of_context, of_word) in enumerate(zip(tables, root, strict=True)):
        rng = np.random.default_rng([*seed, k])
        others = STRENGTH + discount * np.maximum(of_context[many] - t, 0)
        if size is None:
            t = seat(customers, others, of_word[many], discount, rng).astype(np.int64)
            size = shared_out(customers, t, discount, rng)
        else:
            size, t = reseat(size, t, others, of_word[many], discount, rng)
        own = own.copy()
        own[many] = t
        yield own


def kept_sweeps(states: int) -> range:
    """Which of the states (the first one, and one after each sweep) are averaged."""
    return range(min(1 + BURNT, states - 1), states)


def _seatings(pairs: np.ndarray, n: np.ndarray, bucket: int, sweeps: list[Sweep], discount: float) -> Iterator[np.ndarray]:
    context, word = _sides(pairs)
    return seatings(n, [s.tables[context] for s in sweeps], [s.root[word] for s in sweeps], discount, [bucket])


def _sum_tables(shared: list, discount: float, once: bool):
    """Per bucket: tables by context and by word, of the pairs with one customer or of those with more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweeps = [s.value for s in shared]
        for batch in batches:
            for row in range(len(batch)):
                pairs = np.asarray(batch.column("pairs")[row].values.to_numpy(zero_copy_only=False)).view(np.uint64)
                n = batch.column("n")[row].values.to_numpy(zero_copy_only=False)
                pairs, n = pairs[(n == 1) == once], n[(n == 1) == once]
                if not len(pairs):
                    continue
                *_, tables = _seatings(pairs, n, batch.column("bucket")[row].as_py(), sweeps, discount)
                context, word = _sides(pairs)
                ids = int(max(context.max(), word.max())) + 1
                as_context, as_word = np.bincount(context, weights=tables, minlength=ids), np.bincount(word, weights=tables, minlength=ids)
                some = np.flatnonzero(as_context + as_word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(as_context[some].astype(np.int64)), pa.array(as_word[some].astype(np.int64))],
                    names=["id", "as_context", "as_word"],
                )

    return run


class Model:
    """Word counts, vocabulary, the sweeps that are averaged, and the stored pair counts."""

    def __init__(
        self, words: DataFrame, pairs: DataFrame, buckets: int, vocabulary: np.ndarray, counts: np.ndarray, total: int, types: int,
        rare: tuple[float, int, int], discount: float, sweeps: list[Sweep],
    ):
        self.words, self.pairs, self.buckets, self.vocabulary, self.counts = words, pairs, buckets, vocabulary, counts
        self.total, self.types, self.rare, self.discount, self.sweeps = total, types, rare, discount, sweeps


def _discount(once: int, twice: int) -> float:
    """The usual estimate from the numbers of types seen once and twice."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5


def train(docs: DataFrame, sweeps: int = SWEEPS, vocabulary: int = VOCABULARY) -> Model:
    """Learn from all rows given. The driver sees the vocabulary and sums over it, which are bounded."""
    spark = docs.sparkSession
    texts = docs.select("text")
    words = stored(texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    end = int(END_HASH.view(np.int64))
    top = words.filter(F.col("word") != end).orderBy(F.desc("n"), "word").limit(vocabulary).toArrow()
    order = np.argsort(top.column("word").to_numpy().view(np.uint64))
    known, n_known = top.column("word").to_numpy().view(np.uint64)[order], top.column("n").to_numpy()[order]
    counts = np.zeros(len(known) + FIRST, dtype=np.int64)
    counts[FIRST:] = n_known
    ends = words.filter(F.col("word") == end).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts[END] = counts[START] = ends
    beyond = words.filter(F.col("word") != end)
    last = (int(top.column("n")[-1].as_py()), int(top.column("word")[-1].as_py())) if len(top) else None
    if last:
        beyond = beyond.filter((F.col("n") < last[0]) | ((F.col("n") == last[0]) & (F.col("word") > last[1])))
    rare_n, rare_types, once, twice = beyond.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    ).first()
    counts[RARE] = rare_n
    buckets = max(8, math.ceil(total / 2 / PAIRS_PER_BUCKET))
    shared = spark.sparkContext.broadcast(known)
    dealt = texts.mapInArrow(_count_pairs(shared, buckets), "bucket int, pairs array<long>, n array<int>")
    pairs = stored(dealt.groupBy("bucket").applyInArrow(_merge_pairs, "bucket int, pairs array<long>, n array<long>"), "pairs")
    keys = ["context", "word", "cid", "wid"]
    tail = stored(texts.mapInArrow(_tail_pairs(shared, False), _TAIL).groupBy(*keys).agg(F.sum("times").alias("n")), "tail")
    seen = [F.coalesce(F.sum(F.size(F.expr(f"filter(n, c -> c = {k})"))), F.lit(0)) for k in (1, 2)]
    tail_seen = tail.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    discount = _discount(*[x + y for x, y in zip(pairs.agg(*seen).first(), tail_seen, strict=True)])

    def sides(of: DataFrame, t: Column) -> DataFrame:
        both = F.explode(F.array(*[F.struct(F.lit(c == "cid").alias("before"), F.col(key).alias("key"), F.col(c).alias("id")) for key, c in (("context", "cid"), ("word", "wid"))]))
        return of.select(both.alias("side"), t.cast("double").alias("t"), "n").select("side.*", "t", "n")

    def of_numbered(flat: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        sums = flat.filter(F.col("id") != RARE).groupBy("before", "id").agg(F.sum("t").alias("t")).toArrow()
        before, ids, t = (sums.column(c).to_numpy() for c in ("before", "id", "t"))
        tables, customers = np.zeros(len(counts)), np.zeros(len(counts), dtype=np.int64)
        tables[ids[before]], customers[ids[~before]] = t[before], t[~before].astype(np.int64)
        return tables, customers

    def of_words(flat: DataFrame, name: str) -> DataFrame:
        return flat.filter(F.col("id") == RARE).groupBy("key").agg(
            F.sum(F.when(F.col("before"), F.col("t")).otherwise(0.0)).alias(f"{name}_tables"), F.sum(F.when(F.col("before"), F.col("n")).otherwise(0)).alias(f"{name}_count"),
            F.sum(F.when(F.col("before"), 0.0).otherwise(F.col("t"))).cast("long").alias(f"{name}_customers"),
        )

    def both_parts(column: str) -> Column:
        return F.coalesce(f"once_{column}", F.lit(0)) + F.coalesce(f"many_{column}", F.lit(0))

    alone = sides(tail.filter("n = 1"), F.lit(1))
    once_tail, state = of_numbered(alone), of_words(alone, "once")
    many = tail.filter("n > 1").withColumn("bucket", F.pmod(F.xxhash64("context", "word"), F.lit(buckets)).cast("int")).withColumn("t0", F.lit(1.0))
    def sums_of(once: bool) -> tuple[np.ndarray, np.ndarray]:
        by_id = pairs.mapInArrow(_sum_tables([] if once else list(sent), discount, once), "id int, as_context long, as_word long")
        by_id = by_id.groupBy("id").agg(F.sum("as_context").alias("as_context"), F.sum("as_word").alias("as_word")).toArrow()
        tables, customers = np.zeros(len(counts)), np.zeros(len(counts), dtype=np.int64)
        ids = by_id.column("id").to_numpy()
        tables[ids], customers[ids] = by_id.column("as_context").to_numpy(), by_id.column("as_word").to_numpy()
        return tables, customers

    sent: list[Broadcast] = []
    once_numbered = sums_of(True)
    done: list[Sweep] = []
    unknown: list[float] = []
    rng = np.random.default_rng(3)
    for k in range(sweeps + 1):
        if k:
            schema = ", ".join(f"{n} {kind}" for n, kind in many.dtypes) + f", t{k} double"
            asked = state.filter("several")
            contexts, dishes = (asked.select("key", *[f"{c}{i}" for i in range(k)]) for c in ("tables", "root"))
            many = stored(_with_words(many, contexts, dishes).groupBy("bucket").applyInArrow(_seat_pairs(list(sent), discount, k), schema), "tail-many")
        tables, customers = (x + y for x, y in zip(sums_of(False), once_numbered, strict=True))
        flat = sides(many, F.col(f"t{k}"))
        for own_tables, own_customers in (once_tail, of_numbered(flat)):
            tables, customers = tables + own_tables, customers + own_customers
        words_k = state.join(of_words(flat, "many"), "key", "left" if k else "full")
        if not k:
            words_k = words_k.withColumn("several", F.col("many_count").isNotNull()).withColumn("count", both_parts("count").cast("long"))
        words_k = words_k.withColumn(f"tables{k}", both_parts("tables").cast("double")).withColumn("customers", both_parts("customers").cast("long"))
        words_k = words_k.drop("once_count", "many_count", "many_tables", "many_customers")
        schema = ", ".join(f"{n} {kind}" for n, kind in words_k.dtypes) + ", root_tables double"
        words_k = stored(words_k.mapInArrow(_seat_words(STRENGTH + discount * (types - 1), 1.0 / (types + 1), discount, k), schema), "tail-words")
        more_n, more_t = words_k.agg(F.coalesce(F.sum("customers"), F.lit(0)), F.coalesce(F.sum("root_tables"), F.lit(0.0))).first()
        root, new, all_n = root_probabilities(customers, types, discount, rng, more_n, more_t)
        done.append(Sweep(tables, root))
        sent.append(spark.sparkContext.broadcast(done[-1]))
        unknown.append(new)
        given = (F.greatest(F.col("customers") - discount * F.col("root_tables"), F.lit(0.0)) / (all_n + STRENGTH) + new).alias(f"root{k}")
        state = words_k.withColumn(f"root{k}", given).drop("customers", "root_tables")
    out = Model(words, pairs, buckets, known, counts, int(total), int(types), (_discount(once, twice), int(rare_n), int(rare_types)), discount, done)
    every = [F.lit(1.0).alias(f"t{k}") for k in range(sweeps + 1)]
    out.tail = tail.filter("n = 1").select("context", "word", "n", *every).unionByName(many.select("context", "word", "n", *[f"t{k}" for k in range(sweeps + 1)]))
    out.tail_words, out.unknown, out.sent, out.numbers = state, unknown, sent, shared
    return out


def root_probabilities(customers: np.ndarray, types: int, discount: float, rng: np.random.Generator, more_n: int, more_t: float) -> tuple[np.ndarray, float, int]:
    """The root restaurant's probability of every numbered dish and of an unknown word, and all its customers; its base is
    uniform over the words and one unknown. `more_n`, `more_t`: customers and tables of the other words."""
    uniform = 1.0 / (types + 1)
    tables = seat(customers, np.full(len(customers), STRENGTH + discount * max(types - 1, 0)), np.full(len(customers), uniform), discount, rng)
    all_n, all_t = int(customers.sum()) + more_n, tables.sum() + more_t
    new = (STRENGTH + discount * all_t) * uniform / (all_n + STRENGTH)
    return np.maximum(customers - discount * tables, 0) / (all_n + STRENGTH) + new, new, all_n


def _tail_scores(shared, sent: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, discount, unknown = shared.value
        sweeps = [s.value for s in sent]
        for batch in batches:
            cid, wid, own = batch.column("cid").to_numpy(), batch.column("wid").to_numpy(), _numbers(batch, "own")
            total = np.zeros(len(batch))
            kept = kept_sweeps(len(sweeps))
            for k in kept:
                tables = np.where(cid == RARE, _numbers(batch, f"c_tables{k}"), sweeps[k].tables[cid])
                root = np.where(wid == RARE, _numbers(batch, f"w_root{k}"), sweeps[k].root[wid])
                root = np.where(root > 0, root, unknown[k])
                total += (STRENGTH + discount * tables) * root
            total = (own + total / len(kept)) / (np.where(cid == RARE, _numbers(batch, "c_count"), counts[cid]) + STRENGTH)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.log10(total) * batch.column("times").to_numpy())], names=["row", "score"])

    return run


def _word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _pack(places: np.ndarray) -> bytes:
    """Small numbers as bytes: two each where they fit, with a first byte that says so."""
    wide = len(places) > 0 and int(places.max()) >= 1 << 16
    return (b"\4" if wide else b"\2") + places.astype("<u4" if wide else "<u2").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4" if data[:1] == b"\4" else "<u2", offset=1).astype(np.int64)


_QUESTION = (
    "chunk long, bucket int, pairs array<long>, spans array<int>, places binary, times binary, words array<long>, word_places binary, "
    "ids array<long>, base array<double>, known array<long>, n array<long>, runs array<int>, firsts array<long>"
)
_ANSWER = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double"


def _questions(numbered, shared, buckets: int):
    """For each slice of texts and bucket: its distinct pairs with the texts they occur in and how often, and the words
    beyond the vocabulary with their texts. A slice goes by the row number of its first text, and its rows by the runs of
    consecutive numbers in it: a task may read several files of numbered rows. The row of bucket 0 also has what needs no
    bucket: document ids, token numbers, and the sums over vocabulary words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = numbered.value
        counts, discount, rare_parts, total, types = shared.value
        base = Scores(counts, [], discount, rare_parts, total, types).base(counts)
        for batch in _gathered(batches, CHUNK_BYTES):
            numbers = batch.column("row").to_numpy()
            for lo, hi, tokens, bounds in _tokens(batch, 2 * CHUNK_BYTES):
                rows, n = hi - lo, np.diff(bounds)
                runs = np.flatnonzero(np.diff(numbers[lo:hi], prepend=-2) != 1)
                firsts, runs = numbers[lo:hi][runs], runs.astype(np.int32)
                ids = _ids(tokens, vocabulary)
                text = np.repeat(np.arange(rows), n)
                rare = ids == RARE
                base_sum = np.bincount(text, weights=np.where(rare, 0.0, base[ids]), minlength=rows)
                known = np.bincount(text, weights=~rare & (counts[ids] > 0), minlength=rows).astype(np.int64)
                head = _pairs(ids, bounds)
                inside = ~_in_tail(head)
                both = (head[inside] << np.uint64(_ROW_BITS)) | text[inside].astype(np.uint64)
                both, times = np.unique(both, return_counts=True)
                pairs, places = both >> np.uint64(_ROW_BITS), (both & np.uint64((1 << _ROW_BITS) - 1)).astype(np.int64)
                where = _bucket(pairs, buckets)
                order = np.argsort(where, kind="stable")
                cuts = np.searchsorted(where[order], np.arange(buckets + 1))
                words, word_text = tokens[rare], text[rare]
                word_where = _word_bucket(words, buckets)
                word_order = np.argsort(word_where, kind="stable")
                word_cuts = np.searchsorted(word_where[word_order], np.arange(buckets + 1))
                out: list[list] = [[] for _ in range(14)]
                for b in range(buckets):
                    own, mine = order[cuts[b] : cuts[b + 1]], word_order[word_cuts[b] : word_cuts[b + 1]]
                    distinct, first = np.unique(pairs[own], return_index=True)
                    some = slice(lo, hi) if b == 0 else slice(0, 0)
                    row = (
                        numbers[lo], b, distinct.view(np.int64), np.diff(np.append(first, len(own))).astype(np.int32), _pack(places[own]), _pack(times[own]),
                        words[mine].view(np.int64), _pack(word_text[mine]), batch.column("doc_id")[some].to_pylist(),
                        base_sum if b == 0 else base_sum[:0], known if b == 0 else known[:0], n if b == 0 else n[:0], runs, firsts,
                    )
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 2, pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()), *[pa.list_(pa.int64())] * 2, pa.list_(pa.int32()), pa.list_(pa.int64())]
                names = [c.split()[0] for c in _QUESTION.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)

    return run


def _answers(shared, sent: list):
    """Sums per text of one bucket's pairs and words."""

    def run(key, questions: pa.Table, known: pa.Table) -> pa.Table:
        counts, discount, rare_parts, total, types = shared.value
        sweeps = [s.value for s in sent]
        model = Scores(counts, sweeps, discount, rare_parts, total, types)
        pairs, n = _flat(known.column("pairs")).view(np.uint64), _flat(known.column("pn"))
        tables = list(_seatings(pairs, n, key[0].as_py(), sweeps[:-1], discount))
        words = known.filter(known.column("word").is_valid()).sort_by("word")
        word, word_n = words.column("word").to_numpy(), words.column("wn").to_numpy()
        out: dict[str, list] = {c.split()[0]: [] for c in _ANSWER.split(", ")}
        for q in range(len(questions)):
            row = {c: questions.column(c)[q] for c in questions.column_names}
            asked = row["pairs"].values.to_numpy(zero_copy_only=False).view(np.uint64)
            at, seen = _find(pairs, asked)
            c = np.where(seen, n[at], 0) if len(pairs) else np.zeros(len(asked))
            logs = model.log_pairs(asked, c, [np.where(seen, t[at], 0.0) if len(pairs) else c for t in tables])
            logs = np.repeat(logs, row["spans"].values.to_numpy(zero_copy_only=False))
            places, times = _unpack(row["places"].as_py()), _unpack(row["times"].as_py())
            rare, rare_places = row["words"].values.to_numpy(zero_copy_only=False), _unpack(row["word_places"].as_py())
            at, seen = _find(word, rare)
            c = np.where(seen, word_n[at], 0) if len(word) else np.zeros(len(rare))
            rows = int(max(places.max(initial=-1), rare_places.max(initial=-1))) + 1
            score = np.bincount(places, weights=logs * times, minlength=rows)
            base = np.bincount(rare_places, weights=model.base(c), minlength=rows)
            hits = np.bincount(rare_places, weights=c > 0, minlength=rows).astype(np.int64)
            some = np.flatnonzero((score != 0) | (base != 0))
            runs, firsts = (row[x].values.to_numpy(zero_copy_only=False) for x in ("runs", "firsts"))
            none = [None] * len(some)
            parts = [(_numbers_of(some, runs, firsts), none, np.zeros(len(some), dtype=np.int64), hits[some], base[some], score[some])]
            if len(row["ids"]):
                m = len(row["ids"])
                parts.append((_numbers_of(np.arange(m), runs, firsts), row["ids"].as_py(), *(row[x].values.to_numpy(zero_copy_only=False) for x in ("n", "known", "base")), np.zeros(m)))
            for part in parts:
                for column, value in zip(out.values(), part, strict=True):
                    column.append(pa.array(value))
        kinds = [pa.int64()] * 4 + [pa.float64()] * 2
        return pa.table({c: pa.chunked_array([x.cast(k) for x in v], type=k) for (c, v), k in zip(out.items(), kinds, strict=True)})

    return run


def _numbers_of(places: np.ndarray, runs: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Row numbers of the places of a slice, whose runs of consecutive numbers begin at `runs` with the numbers `firsts`."""
    run = np.searchsorted(runs, places, "right") - 1
    return firsts[run] + places - runs[run]


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(asked), dtype=np.int64), np.zeros(len(asked), dtype=bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


class Scores:
    """Probabilities from counts and seatings."""

    def __init__(self, counts: np.ndarray, sweeps: list[Sweep], discount: float, rare: tuple[float, int, int], total: int, types: int):
        self.counts, self.sweeps, self.discount, self.rare, self.total, self.types = counts, sweeps, discount, rare, total, types

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + BASE_PRIOR) / (self.total + BASE_PRIOR * (self.types + 1)))

    def log_pairs(self, pairs: np.ndarray, n: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """log10 of the predictive probability of each (context, word), averaged over the sweeps kept."""
        context, word = _sides(pairs)
        total = np.zeros(len(pairs))
        states = kept_sweeps(len(tables))
        for k in states:
            sweep, t = self.sweeps[k], tables[k]
            own = np.maximum(n - self.discount * t, 0.0) + (STRENGTH + self.discount * sweep.tables[context]) * sweep.root[word]
            total += own / (self.counts[context] + STRENGTH)
        return np.log10(total / len(states))


def score(docs: DataFrame, model: Model, chunks_per_task: int = CHUNKS_PER_TASK) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row."""
    context = docs.sparkSession.sparkContext
    fitted = context.broadcast((model.counts, model.discount, model.rare, model.total, model.types))
    numbered = stored(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "numbered")
    groups = int(model.total * 8 // CHUNK_BYTES // chunks_per_task) + 1
    asked = numbered.mapInArrow(_questions(model.numbers, fitted, model.buckets), _QUESTION).withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(groups)).cast("int"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    least = int(model.counts[FIRST:].min()) if len(model.vocabulary) else 0
    rare = model.words.filter(F.col("n") <= least).select(
        (F.shiftrightunsigned("word", 33) % model.buckets).cast("int").alias("bucket"), F.lit(None).cast("array<bigint>").alias("pairs"),
        F.lit(None).cast("array<bigint>").alias("pn"), "word", F.col("n").alias("wn"),
    )
    held = model.pairs.select("bucket", "pairs", F.col("n").alias("pn"), F.lit(None).cast("long").alias("word"), F.lit(None).cast("long").alias("wn"))
    held = held.unionByName(rare).withColumn("part", parts)
    answers = asked.groupBy("bucket", "part").cogroup(held.groupBy("bucket", "part")).applyInArrow(_answers(fitted, model.sent), _ANSWER)
    kept = list(kept_sweeps(len(model.sweeps)))
    left = [F.greatest(F.col("n") - model.discount * F.col(f"t{k}"), F.lit(0.0)) for k in kept]
    own = model.tail.select("context", "word", (sum(left[1:], left[0]) / len(kept)).alias("own"))
    occurrences = numbered.mapInArrow(_tail_pairs(model.numbers, True), _TAIL).join(own, ["context", "word"], "left")
    contexts = model.tail_words.select("key", "count", *[f"tables{k}" for k in kept])
    dishes = model.tail_words.select("key", *[f"root{k}" for k in kept])
    parts = context.broadcast((model.counts, model.discount, model.unknown))
    beyond = _with_words(occurrences, contexts, dishes).mapInArrow(_tail_scores(parts, model.sent), "row long, score double")
    nothing = [F.lit(None).cast("long").alias("doc_id"), *[F.lit(0).cast(kind).alias(c) for c, kind in (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"))]]
    answers = answers.unionByName(beyond.groupBy("row").agg(F.sum("score").alias("score")).select("row", *nothing, "score"))
    sums = answers.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return sums.drop("row")


def fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def score_corpus(docs: DataFrame, sweeps: int = SWEEPS, vocabulary: int = VOCABULARY) -> DataFrame:
    """Train on the nine folds of ten that are not held out and score every row; held_out null without a doc_id."""
    bounded_batches(docs)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    model = train(texts.filter(fold("doc_id") != 0), sweeps, vocabulary)
    scored = score(texts, model)
    return scored.select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
