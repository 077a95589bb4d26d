"""Collocations of each language by best-first branch-and-bound growth (operator 11).

A phrase of 2 to `LONGEST` words with count a >= `min_count` scores min over its cuts of floor(1000 a n / (l r)), l and r
being the counts of the parts and n the words of the language. As r >= a, no phrase that starts with a word w can score
more than floor(1000 n / f(w)): the count of the first word, the longest of the prefix counts, bounds a whole branch, and
the count of a prefix bounds those of its children. So phrases are grown word by word from first words taken in order of
their bound, best first:

1. A batch of first words per language is opened: at first the `batch` words with the best bounds. Prefixes of this batch
   are grown level by level; only children of prefixes with enough occurrences are counted.
2. Grown phrases and the parts of their cuts are counted exactly, as text, with the words beside them.
3. The language's `top`-th surviving score settles which branches can still matter: all first words whose bound reaches it
   are opened in the next batch (while fewer than `top` phrases survive, four times as many as before). When no unopened
   word has a bound of that score or more, the list is final, ties included.

A phrase is dropped if a longer candidate that contains it is as frequent. That is so exactly if one word more on the left
or on the right keeps the count, which is so if all its occurrences have the same neighbour there: a local test. (A phrase
of `LONGEST` words is never dropped.)

Growth works on 64-bit hashes of (language, words). What must be counted is told to the tasks by bit sets of a fixed size
(`FILTER_BITS`), in which more phrases than meant may seem to be members: they cost counting and change nothing, as results
come from the exact counts of step 2 (neighbours and slices of a task's texts are compared by hash). No vocabulary
and no list of phrases is broadcast or collected. Texts are read once for each level of a batch; nothing else of the size of
the corpus is shuffled than counts, added up within tasks first.

Defined cases: null or empty texts have no words. A null language is `und`. Repeated rows count as often as they occur.
Other columns are not read. An empty table, or one without frequent phrases, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import bounded_batches, stored
from .words import _LOWER, mix, row_slices, span_hashes, text_buffers

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
#: First words of a language opened in the first batch.
BATCH = 2 * TOP
#: Bits of a filter: 4 MB, whatever the corpus.
FILTER_BITS = 25
_SLICE = 1 << 19
#: Words of a row of a stream, about, and rows of it taken together.
_ROW_WORDS = 4096
_JOINED = 64
_U = np.uint64
_STEP = _U(0x9FB21C651E98DF25)
_LANG = _U(0xD6E8FEB86659FD93)
#: What stands for the border of a piece as a neighbour.
_BORDER = np.int64(np.iinfo(np.int64).min)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True

Rows = Iterator[pa.RecordBatch]


class Stream:
    """Words of one after another piece as keys of (language, word), a zero after each piece, and the keys of the phrases
    that start with every word."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self._keys = [words]
        #: How many words of its piece follow a word, up to LONGEST.
        self.room = np.zeros(self.n, dtype=np.int64)
        run = words != 0
        for k in range(1, LONGEST + 1):
            run = run[:-1] & (words[k:] != 0) if k <= self.n else run[:0]
            self.room[: len(run)] += run

    def keys(self, length: int) -> np.ndarray:
        """Key of the phrase of `length` words from every word on; only where `room` >= length - 1 it is one."""
        while len(self._keys) < length:
            k = len(self._keys)
            after = np.zeros(self.n, dtype=_U)
            after[: max(self.n - k, 0)] = self._keys[0][k:]
            self._keys.append(mix(self._keys[-1] * _STEP + after))
        return self._keys[length - 1]

    def starts(self, length: int) -> np.ndarray:
        """Where a phrase of that length starts."""
        return np.flatnonzero((self.room >= length - 1) & (self._keys[0] != 0))


class Words(Stream):
    """The words of a slice of texts: the stream of all rows, and where each word is."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, langs: np.ndarray):
        self.low = _LOWER[raw]
        inside = ~(_SPACE | _MARK)[raw]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        full = np.flatnonzero(np.diff(bounds))
        first, last = bounds[full], bounds[full + 1] - 1
        opens[first], closes[last] = inside[first], inside[last]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        row = np.searchsorted(bounds, start, "right") - 1
        word = span_hashes(self.low, start, end)
        piece = np.cumsum(_MARK[raw])[start] + row
        # A word stands behind as many zeros as pieces have ended before it.
        place = np.arange(len(start)) + np.concatenate([[0], np.cumsum(np.diff(piece) > 0)]) if len(start) else start
        size = int(place[-1]) + 2 if len(start) else 0
        keys, self.word = np.zeros(size, dtype=_U), np.zeros(size, dtype=_U)
        self.start, self.end, self.row = (np.zeros(size, dtype=np.int64) for _ in range(3))
        keys[place] = mix(word + langs[row] * _LANG) | _U(1)
        self.word[place], self.start[place], self.end[place], self.row[place] = word, start, end, row
        super().__init__(keys)

    def of_rows(self, chosen: np.ndarray) -> np.ndarray:
        """The stream of some rows."""
        real = self._keys[0] != 0
        own = real & chosen[self.row]
        own[1:] |= own[:-1] & ~real[1:]
        return self._keys[0][own]

    def text(self, at: int, length: int) -> str:
        return b" ".join(self.low[self.start[k] : self.end[k]].tobytes() for k in range(at, at + length)).decode(errors="replace")


def _lang_hashes(names: list[str]) -> np.ndarray:
    known = {s: np.frombuffer(s.encode(), dtype=np.uint8) for s in set(names)}
    hashes = {s: span_hashes(b, np.array([0]), np.array([len(b)]))[0] if len(b) else _U(0) for s, b in known.items()}
    return np.array([hashes[s] for s in names], dtype=_U)


def _slices(batches: Rows) -> Iterator[tuple[Words, np.ndarray]]:
    """The words of about half a MB of texts at a time, with the language of every row."""
    for batch in batches:
        raw, bounds = text_buffers(batch.column("text"))
        names = batch.column("lang").to_pylist()
        hashes = _lang_hashes(names)
        for lo, hi in row_slices(bounds, _SLICE):
            yield Words(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], hashes[lo:hi]), np.array(names[lo:hi], dtype=object)


def _write_streams(batches: Rows) -> Rows:
    """Rows of about `_ROW_WORDS` words, per slice of texts and language; small ones, as Spark handles them whole."""
    for words, langs in _slices(batches):
        names, which = np.unique(langs.astype(str), return_inverse=True)
        for k, lang in enumerate(names.tolist()):
            own = words.of_rows(which == k).astype("<u8")
            ends = np.flatnonzero(own == 0) + 1
            at = np.unique(ends[np.searchsorted(ends, np.arange(_ROW_WORDS, len(own), _ROW_WORDS))]) if len(own) else ends
            rows = [x.tobytes() for x in np.split(own, at[at < len(own)])]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows)), pa.array(rows, pa.binary())], names=["lang", "words"])


def _streams(batches: Rows) -> Iterator[tuple[str, Stream]]:
    """Streams of some rows of a language, joined."""
    for batch in batches:
        for lang, group in groupby(zip(batch.column("lang").to_pylist(), batch.column("words"), strict=True), itemgetter(0)):
            rows = [np.frombuffer(x.as_buffer(), dtype="<u8") for _, x in group]
            for k in range(0, len(rows), _JOINED):
                yield lang, Stream(np.concatenate(rows[k : k + _JOINED]))


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys >> _U(64 - FILTER_BITS)).astype(np.int64)
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0


def filter_bits(keys: DataFrame) -> np.ndarray:
    """The filter of the column `key`: one bit for each of 2^FILTER_BITS ranges of hashes, built by Spark's bitmaps."""
    slot = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    chunks = keys.select((slot / 32768).cast("long").alias("chunk"), (slot % 32768).alias("bit")).groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for row in chunks.collect():  # 2^FILTER_BITS / 8 bytes at most
        out[row["chunk"] * 4096 : (row["chunk"] + 1) * 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


class _Adder:
    """Counts of keys, added up over slices until they fill `keep` entries."""

    def __init__(self, keep: int = 1 << 19):
        self.keep, self.parts, self.size = keep, [], 0

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, back = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        return keys, np.bincount(back, weights=np.concatenate([n for _, n in self.parts])).astype(np.int64)

    def add(self, keys: np.ndarray) -> Rows:
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > self.keep:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
            if self.size > self.keep // 2:
                yield from self.close()

    def close(self) -> Rows:
        if self.parts:
            keys, n = self.merged()
            self.parts, self.size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])


def _count_words(batches: Rows) -> Rows:
    """Counts of single words by language."""
    adders: dict[str, _Adder] = {}

    def named(lang: str, rows: Rows) -> Rows:
        for b in rows:
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(b)), *b.columns], names=["lang", "key", "n"])

    for lang, words in _streams(batches):
        yield from named(lang, adders.setdefault(lang, _Adder()).add(words.keys(1)[words.starts(1)]))
    for lang, adder in adders.items():
        yield from named(lang, adder.close())
    pa.default_memory_pool().release_unused()  # the worker lives on


def _grow(length: int, frequent, opened, prefixes):
    """Counts of phrases of `length` words: a frequent word after a prefix that is alive."""

    def run(batches: Rows) -> Rows:
        adder = _Adder()
        common, first = frequent.value, opened.value
        alive = prefixes.value if length > 2 else first
        for _, words in _streams(batches):
            at = words.starts(length)
            at = at[_has(first, words.keys(1)[at])]
            at = at[_has(common, words.keys(1)[at + length - 1])]
            if length > 2:
                at = at[_has(alive, words.keys(length - 1)[at])]
                # What follows the first word has been counted too if it starts with a word of this batch.
                at = at[~_has(first, words.keys(1)[at + 1]) | _has(alive, words.keys(length - 1)[at + 1])]
            yield from adder.add(words.keys(length)[at])
        yield from adder.close()

    return run


_MEASURED = "lang string, phrase string, f long, left_low long, left_high long, right_low long, right_high long"


def _measure(wanted):
    """Exact counts of the phrases in a filter, as text, with the least and the greatest neighbour on either side."""

    def run(batches: Rows) -> Rows:
        bits = wanted.value
        known: dict[int, tuple[str, str]] = {}
        parts: list[list[np.ndarray]] = []

        def merged() -> list[np.ndarray]:
            keys, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
            return _by_key(keys, *rest)

        def out() -> pa.RecordBatch:
            keys, n, *beside = merged()
            names = [known[k] for k in keys.tolist()]
            columns = [pa.array([x for x, _ in names], pa.string()), pa.array([x for _, x in names], pa.string()), pa.array(n), *map(pa.array, beside)]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f", "left_low", "left_high", "right_low", "right_high"])

        for words, langs in _slices(batches):
            before = np.full(words.n, _BORDER, dtype=np.int64)
            inner = words.keys(1)[:-1] != 0
            before[1:][inner] = words.word[:-1][inner].view(np.int64)
            for length in range(1, LONGEST + 1):
                at = words.starts(length)
                at = at[_has(bits, words.keys(length)[at])]
                after = np.full(len(at) if length > 1 else 0, _BORDER, dtype=np.int64)
                if length > 1:
                    more = words.room[at] >= length
                    after[more] = words.word[at[more] + length].view(np.int64)
                keys = words.keys(length)[at]
                order = np.argsort(keys)
                keys = keys[order]
                starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
                places = at[order[starts]]
                for key, place in zip(keys[starts].tolist(), places.tolist(), strict=True):
                    if key not in known:
                        known[key] = (langs[words.row[place]], words.text(place, length))
                counts = np.diff(starts, append=len(keys))
                if length == 1:  # a single word is a part only; nobody asks what stands beside it
                    parts.append([keys[starts], counts, *[np.full(len(starts), _BORDER, dtype=np.int64)] * 4])
                elif len(keys):
                    sides = [before[at][order]] * 2 + [after[order]] * 2
                    ends = [(np.minimum, np.maximum)[k % 2].reduceat(x, starts) for k, x in enumerate(sides)]
                    parts.append([keys[starts], counts, *ends])
            if sum(len(p[0]) for p in parts) > 1 << 18:
                parts[:] = [merged()]
                if len(parts[0][0]) > 1 << 17:
                    yield out()
                    parts.clear()
                    known.clear()
        if parts:
            yield out()
        pa.default_memory_pool().release_unused()

    return run


def _by_key(keys: np.ndarray, n: np.ndarray, *beside: np.ndarray) -> list[np.ndarray]:
    """Sums of `n` and alternating least and greatest neighbours by key."""
    if not len(keys):
        return [keys, n, *beside]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = [(np.minimum, np.maximum)[k % 2].reduceat(x[order], at) for k, x in enumerate(beside)]
    return [keys[at], np.add.reduceat(n[order], at), *ends]


def _phrases_and_parts(opened, frequent, alive: dict[int, object]):
    """Keys of the grown phrases of a batch and of all parts of their cuts."""

    def run(batches: Rows) -> Rows:
        adder = _Adder()
        common, first = frequent.value, opened.value
        for _, words in _streams(batches):
            every = words.starts(2)
            every = every[_has(first, words.keys(1)[every])]
            for length in sorted(alive):
                at = every[words.room[every] >= length - 1]
                at = at[_has(common, words.keys(1)[at + length - 1])]
                at = at[_has(alive[length].value, words.keys(length)[at])]
                every = at  # a phrase is alive only if its prefixes are
                yield from adder.add(np.concatenate([words.keys(length)[at], *(words.keys(k)[at] for k in range(1, length)), *(words.keys(length - k)[at + k] for k in range(1, length))]))
        yield from adder.close()

    return run


def _scored(measured: DataFrame, opened: DataFrame, sizes: DataFrame, min_count: int, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, a, l, r, n, score and whether the phrase survives, for candidates that start with an opened word.
    measured: exact counts; opened: lang, low, high (the counts of first words in this batch)."""
    words = F.split("phrase", " ", -1)
    counts = measured.select("lang", F.col("phrase").alias("part"), "f")
    found = measured.withColumn("words", words).filter((F.size("words") > 1) & (F.col("f") >= min_count))
    firsts = counts.join(F.broadcast(opened), "lang").filter(F.col("f").between(F.col("low"), F.col("high"))).select("lang", F.col("part").alias("head"))
    found = found.withColumn("head", F.col("words")[0]).join(firsts, ["lang", "head"], "left_semi")
    left, right = ((F.col(f"{side}_low") == F.col(f"{side}_high")) & (F.col(f"{side}_low") != F.lit(int(_BORDER))) for side in ("left", "right"))
    dropped = (F.size("words") < longest) & (left | right)
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), dropped.alias("dropped"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "dropped", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("one"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("two"),
    )
    cuts = cuts.join(counts.select("lang", F.col("part").alias("one"), F.col("f").alias("l")), ["lang", "one"])
    cuts = cuts.join(counts.select("lang", F.col("part").alias("two"), F.col("f").alias("r")), ["lang", "two"]).join(F.broadcast(sizes), "lang")
    score = F.expr("div(cast(1000 AS decimal(4,0)) * (cast(a AS decimal(17,0)) * cast(n AS decimal(16,0))), cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))")
    best = F.min(F.struct(score.alias("score"), F.col("k"), "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "dropped", "n").agg(best).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "dropped"
    )


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    kept = scored.filter(~F.col("dropped")).withColumn("rank", F.row_number().over(order).cast("long"))
    return kept.filter(F.col("rank") <= top)


def _next_batch(levels: DataFrame, limits: DataFrame, opened: DataFrame | None, wanted: int, min_count: int) -> DataFrame:
    """(lang, low, high) of the counts of first words to be opened next, by falling bound; languages that are done have none.

    levels: lang, f, words (how many words have that count); limits: lang, limit (the score that decides; null: not enough yet)."""
    if opened is None:
        left = levels.withColumn("high", F.lit(min_count - 1).cast("long")).withColumn("limit", F.lit(None).cast("long"))
    else:
        left = levels.join(F.broadcast(opened.select("lang", "high")), "lang").join(F.broadcast(limits), "lang", "left")
    left = left.filter((F.col("f") >= min_count) & (F.col("f") > F.col("high")))
    before = Window.partitionBy("lang").orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    bound = F.expr("div(cast(1000 AS decimal(4,0)) * cast(n AS decimal(16,0)), cast(f AS decimal(18,0)))")
    enough = F.coalesce(F.sum("words").over(before), F.lit(0)) < wanted
    chosen = left.withColumn("open", F.when(F.col("limit").isNull(), enough).otherwise(bound >= F.col("limit"))).filter("open")
    return chosen.groupBy("lang").agg(F.min("f").alias("low"), F.max("f").alias("high"))


def collocations(
    docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, batch: int = BATCH, longest: int = LONGEST, on_round: Callable[[int, DataFrame], None] | None = None
) -> DataFrame:
    """The `top` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    `on_round` is told the number and the (lang, low, high) of every batch of first words that is opened."""
    spark = docs.sparkSession
    bounded_batches(docs)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    share = spark.sparkContext.broadcast

    # Tasks have added up their counts themselves: rows are dealt first, so that Spark keeps no table of them on that side.
    streams = stored(texts.mapInArrow(_write_streams, "lang string, words binary"), "streams")
    words = stored(streams.mapInArrow(_count_words, "lang string, key long, n long").repartition("lang", "key").groupBy("lang", "key").agg(F.sum("n").alias("f")), "words")
    sizes = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    levels = stored(words.filter(F.col("f") >= min_count).groupBy("lang", "f").agg(F.count("*").alias("words")).join(sizes, "lang"), "levels")
    frequent = share(filter_bits(words.filter(F.col("f") >= min_count)))

    scored: DataFrame | None = None
    opened, limits, wanted, number = None, None, batch, 0
    while True:
        now = stored(_next_batch(levels, limits, opened, wanted, min_count), "opened")
        if now.isEmpty():
            break
        number, wanted = number + 1, 4 * wanted
        if on_round:
            on_round(number, now)
        first_words = words.join(F.broadcast(now), "lang").filter(F.col("f").between(F.col("low"), F.col("high")))
        first = share(filter_bits(first_words))
        alive: dict[int, object] = {}
        for length in range(2, longest + 1):
            counts = streams.mapInArrow(_grow(length, frequent, first, alive.get(length - 1)), "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
            bits = filter_bits(counts.filter(F.col("n") >= min_count))
            if not bits.any():
                break
            alive[length] = share(bits)
        if alive:
            parts = streams.mapInArrow(_phrases_and_parts(first, frequent, alive), "key long, n long").select("key")
            counted = texts.mapInArrow(_measure(share(filter_bits(parts))), _MEASURED).groupBy("lang", "phrase")
            measured = stored(
                counted.agg(
                    F.sum("f").alias("f"), F.min("left_low").alias("left_low"), F.max("left_high").alias("left_high"),
                    F.min("right_low").alias("right_low"), F.max("right_high").alias("right_high"),
                ),
                "measured",
            )
            fresh = stored(_scored(measured, now, sizes, min_count, longest), "scored")
            scored = fresh if scored is None else scored.unionByName(fresh)
        high = now.select("lang", "high")
        opened = high if opened is None else stored(opened.select("lang", "high").unionByName(high).groupBy("lang").agg(F.max("high").alias("high")), "opened")
        if scored is None:
            limits = sizes.select("lang", F.lit(None).cast("long").alias("limit"))
        else:
            limits = stored(_ranked(scored, top).filter(F.col("rank") == top).select("lang", F.col("score").alias("limit")), "limits")
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    if scored is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    return _ranked(scored, top).select(*columns)
