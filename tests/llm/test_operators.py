"""Training-data operators against brute force on small tables, with nulls, empty and long texts, ties and repeats."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import chat, embedding_dedup, language, mixing, near_duplicates, neighbours, packing, perplexity, sharding, url_rules
from tidemark.llm.words import word_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{chr(97 + i % 26)}{i}" for i in range(120)]


def words(text):
    return (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.5:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            text = " ".join(w)
        else:
            text = " ".join(rng.choice(WORDS) for _ in range(rng.choice([3, 8, 40, 90])))
        texts.append(text)
        rows.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b", None]), len(text)))
    rows += [
        (500, None, "en", "a", 0), (501, "", None, "b", 0), (502, " \t\n", "en", "b", 3), (503, "A b C", "fr", "a", 5), (504, "a B c", "fr", "a", 5),
        (505, "one two", None, None, 7), (505, "one two", None, None, 7), (None, "no id here at all", "en", None, 3), (506, "x " * 30_000, "en", "a", 60_000),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def brute_near(rows):
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets.setdefault(r[0], shingle_set(r[1]))
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return components(ids, links), sets


@pytest.mark.parametrize("block", [2, 1024])
def test_near_duplicates(spark, docs, block):
    want, sets = brute_near(corpus())
    got = near_duplicates.near_duplicates(docs, block=block).collect()
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_near_copies_around_a_base_that_comes_last(spark):
    """Copies that are similar to their base but not to each other."""
    rng = random.Random(2)
    base = [rng.choice(WORDS) for _ in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in rng.sample(range(200), 4):
            w[k] = f"new{i}x{k}"
        rows.append((i, " ".join(w), "en", "a", 1))
    rows.append((999, " ".join(base), "en", "a", 1))
    want, _ = brute_near(rows)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, DOCS), block=8).collect()}
    assert got == want


def test_signature_index_keeps_its_promise():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 16, (200, near_duplicates.PLACES)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(near_duplicates.PLACES, near_duplicates.MAX_DISTANCE, replace=False)] ^= 1
    ka, kb = near_duplicates.index_keys(a), near_duplicates.index_keys(b)
    assert all(set(x) & set(y) for x, y in zip(ka.tolist(), kb.tolist(), strict=True))


def test_keys_are_dealt_once(spark, docs):
    """What the keys of all signatures cost: one shuffle, in which they are counted too."""
    prints = near_duplicates.fingerprints(docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    assert "keys" not in prints.columns
    signed = prints.selectExpr("doc_id AS id", "signature")
    own = {r["id"]: near_duplicates.index_keys(np.frombuffer(r["signature"], dtype=np.uint16)[None, :])[0].tolist() for r in signed.collect() if r["signature"]}
    under = {}
    for i, keys in own.items():
        for k in keys:
            under.setdefault(k, []).append(i)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = near_duplicates._met(signed)
        plan = met._jdf.queryExecution().executedPlan().toString()
        got = Counter((r["key"], r["id"], r["n"], r["first"]) for r in met.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert got == Counter((k, i, len(ids), min(ids)) for k, ids in under.items() if len(ids) > 1 for i in ids)
    assert plan.count("Exchange hashpartitioning(key") == 1 and "Join" not in plan


def test_drop_near_duplicates(spark, docs):
    want, _ = brute_near(corpus())
    got = Counter(r["doc_id"] for r in near_duplicates.drop_near_duplicates(docs).collect())
    assert got == Counter([*{c for c in want.values()}, None])


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert near_duplicates.near_duplicates(none).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert sharding.shuffle_rows(none).count() == 0
    assert packing.pack(none).count() == 0
    assert language.identify(none).count() == 0
    assert perplexity.score_corpus(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_duplicate_vectors(vectors).count() == 0
    assert neighbours.nearest(vectors).count() == 0
    assert url_rules.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_mix_sources(spark):
    rows = [(i, "abc" * (1 + i % 3), "en", ["a", "b", None][i % 7 % 3], 1) for i in range(4000)] + [(None, None, None, "a", None)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS copy", "'x' AS rate")
    got = mixing.mix_sources(df, {"a": 0.7, "gone": 0.1}, epochs=30.0).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1] or "") + 1
    total = sum(size.values())
    out = Counter()
    copies = {}
    for r in got:
        out[r["source"]] += len(r["text"] or "") + 1
        copies.setdefault(r["doc_id"], set()).add(r["copy"])
        assert r["copy"] <= r["copies"]
    assert abs(out["a"] / (30 * total) - 0.7) < 0.01
    assert all(c == set(range(1, len(c) + 1)) for c in copies.values())
    rate = 0.7 * 30 * total / size["a"]
    n = np.array([len(copies.get(r[0], ())) for r in rows if r[3] == "a" and r[0] is not None])
    assert abs(n.mean() - rate) < 5 * math.sqrt(rate / len(n)) and 0.85 < n.var() / rate < 1.15
    assert sorted(r["doc_id"] or -1 for r in got) == sorted(r["doc_id"] or -1 for r in mixing.mix_sources(df.repartition(3), {"a": 0.7, "gone": 0.1}, epochs=30.0).collect())


def test_hypergeometric_draw_has_the_right_law(spark):
    from pyspark.sql import functions as F

    for population, good, draws in ((50, 8, 40), (30, 11, 7), (6, 3, 6), (9, 0, 4), (1000, 300, 100)):
        m = 4000
        u = (F.col("id") + 0.5) / m
        x = spark.range(m).select(sharding.hypergeometric(F.lit(population), F.lit(good), F.lit(draws), u).alias("x")).collect()
        n = Counter(r["x"] for r in x)
        for k in range(max(0, draws + good - population), min(good, draws) + 1):
            p = math.comb(good, k) * math.comb(population - good, draws - k) / math.comb(population, draws)
            assert abs(n[k] / m - p) < 2.5 / m


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shuffle_rows(spark, docs, shards):
    df = docs.repartition(5).selectExpr("*", "'old' AS law", "7 AS slot")
    got = sharding.shuffle_rows(df, shards, part_rows=4).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in corpus())
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == shards


def test_shuffle_is_uniform(spark):
    df = spark.range(0, 400, 1, 7).selectExpr("id AS doc_id", "'t' AS text")
    where = Counter()
    for seed in range(12):
        for r in sharding.shuffle_rows(df, 4, seed).select("doc_id", "shard").collect():
            where[r["doc_id"] // 100, r["shard"]] += 1
    assert all(abs(n - 300) < 5 * math.sqrt(225) for n in where.values()) and len(where) == 16


def test_pack(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    odd = [(900 + i, t, None, None, 0) for i, t in enumerate(["a  b", "x \n y\n\n z ", "é\xa0 z　w", "<|endoftext|> b", "it's\x1cme", "日本 語\n x ", "  "])]
    rows = corpus() + odd
    ids = [[*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows]
    for r, own in zip(rows, ids, strict=True):
        for lo in range(0, len(own), 64):
            piece = own[lo : lo + 64]
            want[r[0], lo, len(piece), zlib.crc32(np.array(piece, dtype="<u4").tobytes()), len(own)] += 1
    got = packing.pack(spark.createDataFrame(rows, DOCS), window=64, group_pieces=300, with_ids=True).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(r["ids"]) == r["length"]
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert len(windows) <= 1.05 * sum(map(len, ids)) / 64 + 8


def test_best_fit_decreasing_is_best_fit():
    lengths = np.sort(np.random.default_rng(5).integers(1, 33, 500))[::-1]
    number, offset = packing.best_fit_decreasing(lengths, 32)
    left = []
    for n, w, o in zip(lengths.tolist(), number.tolist(), offset.tolist(), strict=True):
        fits = [c for c in left if c >= n]
        if w == len(left):
            assert not fits
            left.append(32)
        else:
            assert left[w] == min(fits)
        assert o == 32 - left[w]
        left[w] -= n


LANGUAGES = {"en": "the of and that with this from have", "fr": "les des une dans pour avec être où", "de": "der die und nicht ein für über größe"}


def test_language(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(LANGUAGES[k].split()) for _ in range(rng.choice([4, 30]))), k, "s", 1) for i in range(300) for k in [rng.choice(sorted(LANGUAGES))]]
    rows += [(900, None, "en", "s", 0), (901, "", "fr", "s", 0), (902, "123 !?", "de", "s", 6), (None, "the of and", "en", "s", 1), (903, "das ist nicht über", None, "s", 1)]
    got = language.identify(spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS score")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] in (900, 901, 902):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None and r["lang"]:
            assert r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1
    assert {r["doc_id"]: r["lang_pred"] for r in got}[903] == "de"
    assert {r["lang_pred"] for r in language.identify(spark.createDataFrame([(5, "some text", None, "s", 1)], DOCS)).collect()} == {"und"}


def test_language_costs_match_a_plain_context_tree():
    counts = Counter()
    for text in (b"abracadabra", b"abra cadabra abrasion"):
        padded = b"\0\0" + text
        for i in range(2, len(padded)):
            counts[padded[i - 2 : i + 1]] += 1
    grams = np.array([g[2] | g[1] << 8 | g[0] << 16 for g in counts])
    model = language.build(["x"], {"x": (grams, np.array(list(counts.values()), dtype=float))}, 2)

    def probability(context, symbol):
        p = np.full(256, 1 / 256)
        for depth in range(len(context) + 1):
            own = Counter()
            for g, n in counts.items():
                if g[2 - depth : 2] == context[len(context) - depth :]:
                    own[g[2]] += n
            if not own:
                break
            total, rest = sum(own.values()) + len(own), 1 - sum(p[s] for s in own)
            p = np.array([own[s] / total if s in own else len(own) / total * p[s] / rest for s in range(256)])
        return p[symbol]

    for text in (b"abra", b"cabd", b"a", b"ra ab"):
        padded = b"\0\0" + text
        want = -sum(math.log2(probability(padded[i - 2 : i], padded[i])) for i in range(2, len(padded)))
        got = model.costs(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))[0, 0]
        assert abs(want - got) < 1e-3


def test_language_keeps_rare_contexts(spark):
    """Contexts beyond the unrolled table cost what they cost in it, and no count is dropped."""
    rng = random.Random(12)
    letters = [chr(0x4E00 + 7 * i) for i in range(300)]
    rows = [(i, "".join(rng.choice(letters) for _ in range(40)), "zh", "s", 1) for i in range(60)] + [(100 + i, "the of and with", "en", "s", 1) for i in range(9)]
    labelled = spark.createDataFrame(rows, DOCS)
    few, all_ = language.train(labelled, max_contexts=3), language.train(labelled, max_contexts=1 << 24)
    texts = [rows[0][1].encode(), rows[9][1][::-1].encode(), b"the and of q", "é中 the".encode(), b"x"]
    raw, bounds = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])
    assert len(few.bits[0]) < len(all_.bits[0])
    np.testing.assert_allclose(few.costs(raw, bounds), all_.costs(raw, bounds), rtol=1e-5)


@pytest.mark.parametrize("step, limit", [(language._count_grams(3), 60e6), (near_duplicates._fingerprints, 28e6)])
def test_memory_of_a_task_over_many_texts(step, limit):
    """What a task holds beside its batch stays small: counts are merged early, texts are taken in small slices."""
    letters = np.random.default_rng(1).integers(97, 123, (1000, 600, 5), dtype=np.uint8)
    texts = [" ".join(bytes(w).decode() for w in words) for words in letters]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": texts, "lang": ["en"] * 1000})
    tracemalloc.start()
    try:
        for _ in step(iter([batch] * 3)):
            pass
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < limit


def test_language_model(spark, docs):
    rows = corpus()
    tokens = [[*words(r[1]), None] for r in rows]
    counts = Counter(t for r, own in zip(rows, tokens, strict=True) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 for t in own)
    n, types = sum(counts.values()), len(counts)
    want = Counter((r[0], len(own), sum(counts[t] > 0 for t in own), round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (types + 1))) for t in own), 6)) for r, own in zip(rows, tokens, strict=True))
    for vocabulary in (perplexity.VOCABULARY, 40):
        got = perplexity.score_corpus(docs, vocabulary=vocabulary).collect()
        assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
        assert all(r["train_tokens"] == n and math.isfinite(r["score"]) and r["score"] < 0 for r in got)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in got if r["doc_id"] is not None)
        learnt = [r for r in got if r["held_out"] is False]
        assert sum(r["score"] for r in learnt) > sum(r["base_score"] for r in learnt)


def test_language_model_over_many_small_files(spark):
    """A task that reads several files of numbered rows gives each row its own sums."""
    rows = [(i, None if i % 17 == 0 else f"a w{i % 5} only{i} " * (i % 4)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    for vocabulary in (perplexity.VOCABULARY, 4):
        got = sorted((r["doc_id"], r["n_tokens"]) for r in perplexity.score_corpus(docs, vocabulary=vocabulary).collect())
        assert got == [(i, len((t or "").split()) + 1) for i, t in rows]


def language_model(spark, docs, vocabulary):
    """The model's scores as plain dictionaries: what a reader of the seating would compute for any (context, word)."""
    model = perplexity.train(docs.filter("doc_id IS NOT NULL").select("doc_id", "text"), vocabulary=vocabulary)
    numbers = {int(h): i for i, h in enumerate(model.vocabulary, perplexity.FIRST)}
    hashes = {i: h for h, i in numbers.items()} | {perplexity.START: None, perplexity.END: None}
    n, t = {}, [{} for _ in model.sweeps]
    for r in model.pairs.collect():
        pairs = np.array(r["pairs"], dtype=np.int64).view(np.uint64)
        states = perplexity._seatings(pairs, np.array(r["n"]), r["bucket"], model.sweeps[:-1], model.discount)
        names = [(hashes[c], hashes[w]) for c, w in zip(*(x.tolist() for x in perplexity._sides(pairs)), strict=True)]
        n.update(zip(names, r["n"], strict=True))
        for k, state in enumerate(states):
            t[k].update(zip(names, state.tolist(), strict=True))
    end = int(perplexity.END_HASH)
    name = lambda h: None if h % 2**64 == end else h % 2**64
    for r in model.tail.collect():
        pair = (name(r["context"]), name(r["word"]))
        n[pair] = r["n"]
        for k in range(len(t)):
            t[k][pair] = r[f"t{k}"]
    tail = {r["key"] % 2**64: r for r in model.tail_words.collect()}
    roots = [{**{h: float(s.root[i]) for h, i in numbers.items()}, None: float(s.root[perplexity.END]), **{h: r[f"root{k}"] for h, r in tail.items()}} for k, s in enumerate(model.sweeps)]
    by_context = Counter()
    for (c, _), x in n.items():
        by_context[c] += x
    tables = [Counter() for _ in t]
    for k, own in enumerate(t):
        for (c, _), x in own.items():
            tables[k][c] += x

    def probability(c, w):
        states = range(2, len(t))
        return sum(
            max(n.get((c, w), 0) - model.discount * t[k].get((c, w), 0), 0) + (1 + model.discount * tables[k][c]) * roots[k].get(w, model.unknown[k]) for k in states
        ) / len(states) / (by_context[c] + 1)

    return model, probability, set(roots[0]), n, t


def word_hash(w):
    return int(word_hashes(np.frombuffer(w, dtype=np.uint8), np.array([0, len(w)]))[0][0])


@pytest.mark.parametrize("vocabulary", [perplexity.VOCABULARY, 12])
def test_language_model_scores_equal_a_plain_reading_of_the_seating(spark, docs, vocabulary):
    model, probability, dishes, n, t = language_model(spark, docs, vocabulary)
    assert all(1 <= x <= n[pair] for own in t for pair, x in own.items()) and any(x > 1 for x in t[-1].values())
    for context in [None, *list(dishes)[:6], 12345]:  # the last one is never seen
        total = sum(probability(context, w) for w in dishes) + probability(context, 54321)
        assert abs(total - 1) < 1e-6
    got = Counter((r["doc_id"], round(r["score"], 4)) for r in perplexity.score(docs.repartition(3), model).collect())
    want = Counter()
    for r in corpus():
        own = [*map(word_hash, words(r[1])), None]
        want[(r[0], round(sum(math.log10(probability(c, w)) for c, w in zip([None, *own[:-1]], own, strict=True)), 4))] += 1
    assert got == want


def test_gibbs_steps_keep_the_law_of_the_seating():
    """Tables of one dish in the long run, against the sum over all set partitions of its customers."""
    a, root, d = 1.7, 0.2, 0.6

    def partitions(n):
        if n == 0:
            yield ()
            return
        for p in partitions(n - 1):
            yield (*p, 1)
            for i in range(len(p)):
                yield (*p[:i], p[i] + 1, *p[i + 1 :])

    for n in (2, 3, 5):
        law = Counter()
        for p in partitions(n):
            weight = math.prod((a + d * k) * root for k in range(len(p)))
            law[len(p)] += weight * math.prod(math.prod(j - d for j in range(1, s)) for s in p)
        m, rng = 4000, np.random.default_rng(n)
        tables, size = np.ones(m, dtype=np.int64), np.full(m, n)
        seen = Counter()
        for sweep in range(16):
            size, tables = perplexity.reseat(size, tables, np.full(m, a), np.full(m, root), d, rng)
            assert size.min() > 0 and (np.add.reduceat(size, np.cumsum(tables) - tables) == n).all()
            if sweep > 5:
                seen.update(tables.tolist())
        for k, x in law.items():
            assert abs(seen[k] / (10 * m) - x / sum(law.values())) < 0.015


def test_gibbs_steps_of_many_customers():
    rng = np.random.default_rng(1)
    n = np.array([100_000, 65, 64, 2, 700, 33])
    tables = perplexity.seat(n, np.full(6, 3.0), np.full(6, 0.3), 0.7, rng).astype(np.int64)
    size = perplexity.shared_out(n, tables, 0.7, rng)
    for _ in range(5):
        assert size.min() > 0 and (np.add.reduceat(size, np.cumsum(tables) - tables) == n).all()
        size, tables = perplexity.reseat(size, tables, np.full(6, 3.0), np.full(6, 0.3), 0.7, rng)


def test_language_model_knows_words_beyond_the_numbered(spark, docs):
    """The numbered words are a matter of storage: scores hardly differ, but for the draws."""
    runs = [{r["doc_id"]: r["score"] for r in perplexity.score_corpus(docs, vocabulary=v).collect() if r["doc_id"] is not None} for v in (perplexity.VOCABULARY, 12)]
    assert all(abs(runs[0][i] - runs[1][i]) < 0.05 * abs(runs[0][i]) + 0.2 for i in runs[0])
    assert abs(sum(runs[0].values()) / sum(runs[1].values()) - 1) < 0.01


def vectors(seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(12):
            rows.append(centre + rng.normal(size=16) * rng.choice([0.02, 0.08, 0.5]))
    x = np.array(rows, dtype=np.float32)
    out = [(i, v.tolist()) for i, v in enumerate(x)] + [(300 + i, x[5].tolist()) for i in range(15)]
    bad = [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [float("inf")] * 16), (404, [None] * 16), (405, [1.0, 2.0]), (406, [])]
    return out, out + bad + [(None, x[0].tolist())]


def test_embedding_dedup(spark):
    good, rows = vectors()
    x = np.array([v for _, v in good], dtype=np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    ids = [i for i, _ in good]
    near = unit @ unit.T >= 0.95
    want = components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True)])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'l' AS label", "1 AS id")
    for margin in (None, math.sin(math.acos(0.95))):
        got = embedding_dedup.near_duplicate_vectors(df, margin=margin).collect()
        assert len(got) == len(rows)
        for r in got:
            if r["vec_id"] in want:
                assert (r["n_links"], r["component_id"]) == (near[ids.index(r["vec_id"])].sum() - 1, want[r["vec_id"]])
                assert r["kept"] == (r["vec_id"] == r["component_id"])
            else:
                assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)


def test_embedding_dedup_in_a_subspace(spark):
    """Vectors of rank 3 in 64 dimensions: steps to near copies point across cell borders."""
    rng = np.random.default_rng(11)
    low = rng.normal(size=(1500, 3))
    x = (low @ np.linalg.qr(rng.normal(size=(64, 3)))[0].T).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    want = near.sum(axis=1) - 1
    root = components(range(len(x)), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    assert got == {i: (want[i], root[i]) for i in range(len(x))}


def test_embedding_dedup_fits_with_the_executors(spark, monkeypatch):
    """Of 3,000 vectors the driver gets one a cell and the centroids, and no product with all centroids is held whole."""
    rng = np.random.default_rng(4)
    heart = rng.normal(size=(15, 8))
    x = (heart[np.arange(3000) % 15] + 0.05 * rng.normal(size=(3000, 8))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(7)
    got, asked, rows = embedding_dedup.sample, [], []
    monkeypatch.setattr(embedding_dedup, "sample", lambda *a: asked.append(a[3]) or got(*a))
    cut = embedding_dedup.spherical_kmeans
    monkeypatch.setattr(embedding_dedup, "spherical_kmeans", lambda x, *a: rows.append(len(x)) or cut(x, *a))
    monkeypatch.setattr(embedding_dedup, "STEP_VALUES", 15 * 100)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicate_vectors(df).collect()} == dict(enumerate(near))
    assert asked == [15] and max(rows) <= 15
    unique = df.selectExpr("vec_id AS id", "embedding")
    c = embedding_dedup.fit_centroids(unique, 900, 15, rounds=1)  # few enough rows to be all of them in the fit
    start = np.unique(embedding_dedup._unit(got(unique, "id", "embedding", 15)), axis=0)
    own = (unit @ start.T).argmax(axis=1)
    want = embedding_dedup._unit(np.array([unit[own == k].sum(axis=0) for k in range(len(start))]))
    assert np.allclose(c, want, atol=1e-9)


def test_neighbours(spark):
    good, rows = vectors()
    x = {i: np.array(v, dtype=np.float32).astype(float) for i, v in good}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.nearest(df, 100, share=1.0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 100, 300}
    for q, found in got.items():
        want = sorted((float(np.sqrt(((x[i] - x[q]) ** 2).sum())), i) for i in x if i != q)[:10]
        assert [(k, i) for k, i, _ in sorted(found)] == [(k, i) for k, (_, i) in enumerate(want, 1)]
        assert all(abs(s - d) < 1e-12 for (_, _, s), (d, _) in zip(sorted(found), want, strict=True))


def test_neighbours_recall(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 24)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    hits = total = 0
    got = {}
    for r in neighbours.nearest(df, 100).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    for q, found in got.items():
        d = ((x.astype(float) - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(found & set(np.argsort(d)[:10].tolist()))
        total += 10
    assert hits / total >= 0.9


@pytest.mark.parametrize("values", [1 << 20, 24 * 900])
def test_neighbours_are_sent_once_to_a_bundle(spark, monkeypatch, values):
    """Rows of queries and leaves are never broadcast, however small the table of queries, and bundles hold what leaves hold."""
    monkeypatch.setattr(neighbours, "BUNDLE_VALUES", values)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 24)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = neighbours.nearest(df, 100)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") and "BuildLeft" not in plan
    full = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in neighbours.nearest(df, 100, share=1.0).collect()}
    d = np.sqrt(((x[::100, None].astype(float) - x[None].astype(float)) ** 2).sum(axis=2))
    for (q, rank), (i, score) in full.items():
        order = [k for k in np.lexsort((np.arange(6000), d[q // 100])) if k != q]
        assert (i, score) == (order[rank - 1], d[q // 100, i])
    forest = neighbours.grow(neighbours.sample(df, "vec_id", "embedding", neighbours.SAMPLE_ROWS), 8, 4)
    leaves = forest.leaves(x.astype(float))
    for q in range(0, 6000, 100):
        opened = forest.search(x[q].astype(float), math.ceil(0.14 * 8 * 16))
        held = sorted({int(i) for t, n in opened for i in np.flatnonzero(leaves[:, t] == n)} - {q}, key=lambda i: (d[q // 100, i], i))[:10]
        assert [got[q, k + 1] for k in range(10)] == [(i, d[q // 100, i]) for i in held]


def test_url_rules(spark):
    urls = [
        "http://a.example.com/en/x?q", "https://WWW.Example.com/en/", "x://example.com/fr/", "http://b.net/es/1", "http://net/fr/", "http://other.org/en/", "http://example.com",
        None, "no address", "http://", "http://com#f", "http://b.net/e", "a://b.com://c/d", "http://x.com/" + "p/" * 5000, "http://" + "s." * 200 + "com/", "http://b.net/es/1",
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'old' AS rule", "1 AS head")

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:end].lower(), rest[end:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        return host, path, best[1], best[2]

    want = {i: judge(u) for i, u in enumerate(urls)}
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(df).collect()} == want
    limit, url_rules.BROADCAST_RULES = url_rules.BROADCAST_RULES, 0
    try:
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(df).collect()} == want
    finally:
        url_rules.BROADCAST_RULES = limit


def test_quotation_threads(spark):
    rows = [
        (1, 0, "u", "First thing.\nSecond  line here."), (1, 1, "a", "> second line here.\nI agree."), (1, 2, "u", "Unrelated."),
        (1, 3, "a", ">> Second line here.\n> I agree.\nMe too."), (1, 4, "u", "> never said\nwhat?"), (1, 5, "a", "> Unrelated.\r\nwell"), (1, 6, "u", "> First thing.\n> Second line here."),
        (2, 0, "u", "I agree."), (2, 1, "u", None), (2, None, "u", "> I agree.\nx"), (None, 0, "u", "> I agree."), (2, 2, "a", "> I agree."), (2, 2, "a", "> I agree."),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'old' AS body")
    got = {}
    for r in chat.format_conversations(df).collect():
        got.setdefault((r["conv_id"], r["turn"]), []).append((r["body"], r["n_passages"], r["n_linked"], r["max_level"], r["parent_turn"], r["root_turn"], r["depth"], r["position"]))
    assert got[1, 1] == [("I agree.", 1, 1, 1, 0, 0, 1, 2)]
    assert got[1, 3] == [("Me too.", 2, 2, 2, 1, 0, 2, 4)]
    assert got[1, 6] == [("", 1, 1, 1, 0, 0, 1, 3)]
    assert got[1, 4][0][:5] == ("what?", 1, 0, 1, None)
    assert got[1, 5] == [("well", 1, 1, 1, 2, 2, 1, 6)]
    assert [r[-1] for r in sorted(got[1, k][0] for k in range(7)) if r] and sorted(got[1, k][0][-1] for k in range(7)) == list(range(1, 8))
    assert got[2, 1][0][0] == "" and got[2, None][0][4] is None and got[None, 0][0][4] is None
    assert [x[4] for x in got[2, 2]] == [0, 0] and {x[-1] for x in got[2, 2]} == {3, 4}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    rows = []
    for i in range(150):
        k = rng.choice(sorted(LANGUAGES))
        rows.append((i, " ".join(rng.choice(LANGUAGES[k].split()) + rng.choice("abcdefgh") * rng.randint(0, 1) for _ in range(60)), k, rng.choice("ab"), 1))
    rows += [(200 + i, rows[i][1], rows[i][2], "b", 1) for i in range(20)] + [(300, "12 34", "en", "a", 5), (301, None, None, "a", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    judged = corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path))
    assert judged.columns == docs.columns and {r["doc_id"] for r in judged.collect()} == {r[0] for r in rows} - {300, 301}
    unique = corpus_pipeline.STAGES[1][1](spark, judged, str(tmp_path))
    want, _ = brute_near([r for r in rows if r[0] < 300])
    assert unique.columns == docs.columns and {r["doc_id"] for r in unique.collect()} == set(want.values())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert packed and {r["doc_id"] for r in packed} <= set(want.values())


def test_columns_named_like_helpers_are_kept(spark):
    from corpus_pipeline import identify_language, mix

    text = "a plain line of words that is long enough to be told apart"
    rows = [(i, text, ["en", "fr"][i % 2], "a", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    for run, names in (
        (mixing.mix_sources, ["_parts", "_cum", "_source", "size", "given"]), (sharding.shuffle_rows, ["_key", "_at", "_block", "_PLACE", "_part", "_rank", "n", "ends"]),
        (language.identify, ["_letters", "_letters__own"]), (lambda d: identify_language(spark, d, ""), ["lang_pred", "score"]), (lambda d: mix(spark, d, ""), ["copy", "copies", "rate", "shuffle_key"]),
    ):
        extra = docs.selectExpr("*", *[f"doc_id * 10 + {k} AS {c}" for k, c in enumerate(names)])
        out = run(extra)
        assert set(extra.columns) <= set(out.columns)
        got = out.collect()
        assert got and all(r[c] == r["doc_id"] * 10 + k for r in got for k, c in enumerate(names))


def test_pack_spreads_equal_rows(spark):
    rows = [(7, "one two three", None, None, 0)] * 3000
    got = packing.pack(spark.createDataFrame(rows, DOCS), window=64, group_pieces=200).collect()
    assert len(got) == 3000
    groups = Counter(r["sequence_id"] >> 33 for r in got)
    assert len(groups) == 16 and max(groups.values()) < 300


def test_pack_gives_the_ids_of_another_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Digits(individual_digits=True), pre_tokenizers.ByteLevel(add_prefix_space=False)])
    path = str(tmp_path / "digits.json")
    tokenizer.save(path)
    texts = ["year 2024 and 12345 items", None, "", "a 1b22\n333 x"]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r["ids"] for r in packing.pack(docs, tokenizer_file=path, with_ids=True).collect()}
    assert got == {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert packing.Encoder(packing.tokenizer_path()).by_parts and not packing.Encoder(path).by_parts
