"""Collocations, fingerprints and token alignment against brute force, with nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import alignment, fingerprints, phrases

DOCS = "doc_id long, text string, lang string, key string, h long, phrase string, part long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed, n=150):
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(60)]
    fixed = [[rng.choice(names) for _ in range(rng.choice([2, 3, 5, 7]))] for _ in range(12)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.choice([1, 4, 12])):
            out += rng.choice(fixed) if rng.random() < 0.6 else [rng.choice(names)]
            if rng.random() < 0.25:
                out[-1] += rng.choice([".", ",", " ; ", "\n", "! ", "\r\n", "?:"])
        rows.append((i, rng.choice([" ", "  ", "\t"]).join(out).replace("w1 ", "W1 "), rng.choice(["en", "fr", None, "und"]), "x", 1, "y", 2))
    rows += [(None, "no id", "en", None, None, None, None), (None, "w1 w2 w3", None, "k", 5, "p", 9), (900, None, "en", "k", 5, "p", 9), (901, "", "fr", "k", 5, "p", 9)]
    rows += [(902, "w1 w2, w3 " * 3000, "en", "k", 5, "p", 9), (903, "équipe ünter " * 40, "fr", "k", 5, "p", 9), (904, " \t\n", None, "k", 5, "p", 9)]
    rows += [(905, "same text twice", "en", "k", 5, "p", 9)] * 3 + [(905, "another of that id", "en", "k", 5, "p", 9)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(3), DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def best_phrases(rows, top, least, longest=5):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        dropped = {p[i:j] for p, c in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and found.get(p[i:j]) == c}
        rows = []
        for p, a in found.items():
            if p not in dropped:
                score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, sizes[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


@pytest.mark.parametrize(("top", "least", "batch"), [(2000, 5, 4000), (15, 3, 4), (40, 2, 1), (1, 6, 2)])
def test_collocations_equal_brute_force(docs, top, least, batch):
    opened = []
    found = phrases.collocations(docs, top=top, min_count=least, batch=batch, on_round=lambda k, rows: opened.append(k)).collect()
    assert sorted(map(tuple, found)) == best_phrases(corpus(3), top, least)
    assert len(opened) == 1 if batch == 4000 else len(opened) > 1


def test_collocations_stop_before_all_words_are_opened(spark):
    """Rare words that always stand together settle the list; branches of frequent words are never grown."""
    rows = [(i, f"a{i % 7} b{i % 7} . the of . of the", "en", "", 0, "", 0) for i in range(140)]
    batches = []
    found = phrases.collocations(spark.createDataFrame(rows, DOCS), top=5, min_count=10, batch=7, on_round=lambda k, b: batches.extend(b.collect())).collect()
    assert sorted(map(tuple, found)) == best_phrases(rows, 5, 10)
    assert max(b.high for b in batches) == 20  # `the` and `of` occur 280 times


def test_collocation_scores_pass_64_bits(spark):
    rows = [(0, "k l", "en", 1 << 62)]
    big = 3_000_000_000
    measured = spark.createDataFrame(
        [("en", "k l", big, 1, 2, 1, 2), ("en", "k", big + 1, 1, 2, 1, 2), ("en", "l", big + 7, 1, 2, 1, 2)], phrases._MEASURED
    )
    opened = spark.createDataFrame([("en", 1, 1 << 60)], "lang string, low long, high long")
    sizes = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    row = phrases._scored(measured, opened, sizes, 100).first()
    assert rows and row.score == 1000 * big * 10**13 // ((big + 1) * (big + 7))


def test_collocations_of_nothing(empty):
    assert phrases.collocations(empty).collect() == []


def edited(text, after):
    cut = len(text) // 3
    return text[: len(text) - cut] + after[:cut]


@pytest.mark.parametrize("range_bytes", [64 << 20, 2000])
def test_fingerprints_of_texts_and_their_edited_form(docs, range_bytes):
    rows = [(i, t or "") for i, t, *_ in corpus(3)]
    found = fingerprints.compare_with_next(docs, range_bytes).collect()
    assert len(found) == len(rows)
    own = {t: fingerprints.shown(fingerprints.digests(pa.array([t])))[0] for _, t in rows}
    single = sorted((i, t) for i, t in rows if i is not None and i != 905)[::-1]
    by_id = {r.doc_id: r for r in found if r.doc_id not in (905, None)}
    assert len(by_id) == len(single)
    heads = {904: None}
    for (i, t), (_, after) in zip(single[1:], single[2:], strict=False):
        r = by_id[i]
        assert (r.n_chars, r.fingerprint, r.edited_sha256) == (len(t), own[t], hashlib.sha256(edited(t, after).encode()).hexdigest())
        a, b, c = (fingerprints.digests(pa.array([x])) for x in (t, edited(t, after), after))
        assert r.near_edited == pytest.approx(fingerprints.likeness(a, b)[0]) and r.near_next == pytest.approx(fingerprints.likeness(a, c)[0])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert heads
    # The documents of one id follow each other: three copies give two pairs of equal texts, and one chain of all.
    same = [r for r in found if r.doc_id == 905]
    assert len(same) == 4 and sum(r.near_next == 1 for r in same) >= 2
    follow = {hashlib.sha256(edited(t, u).encode()).hexdigest() for _, t in rows for _, u in rows if t}
    assert all(r.edited_sha256 in follow for r in found if r.n_chars)
    # After the last (without id) comes the first, the largest id: 905.
    last = [r for r in found if r.doc_id is None]
    first_texts = {"same text twice", "another of that id"}
    assert any(r.edited_sha256 == hashlib.sha256(edited(t, u).encode()).hexdigest() for r in last for t in ("no id", "w1 w2 w3") for u in first_texts)


def test_fingerprints_tell_edited_texts_from_others(spark):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("aeiourstlnmk") for _ in range(rng.randint(2, 9))) for _ in range(n)) for n in [1, 5, 40, 300, 2000] * 30]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = fingerprints.compare_with_next(rows, 1000).collect()
    assert np.mean([r.near_edited > r.near_next for r in found if r.n_chars > 20]) == 1
    both = fingerprints.fingerprint_likeness(fingerprints.fingerprint(rows.text), fingerprints.fingerprint(rows.text))
    assert rows.select(both.alias("x")).where("x <> 1").count() == 0


def test_fingerprints_of_one_document_and_of_none(spark, empty):
    one = fingerprints.compare_with_next(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1
    assert fingerprints.compare_with_next(empty).collect() == []
    void = fingerprints.digests(pa.array(["", None, "a"]))
    assert fingerprints.likeness(void[:2], void[[1, 2]]).tolist() == [1.0, 0.0]


def test_many_copies_of_one_row_are_one_entry_a_batch(spark):
    rows = spark.createDataFrame([(7, "a hot row")] * 500 + [(8, "before"), (6, "after")], "doc_id long, text string")
    found = Counter((r.doc_id, r.edited_sha256) for r in fingerprints.compare_with_next(rows).collect())
    digest = lambda t, u: hashlib.sha256(edited(t, u).encode()).hexdigest()
    assert found == {(7, digest("a hot row", "a hot row")): 499, (7, digest("a hot row", "after")): 1, (8, digest("before", "a hot row")): 1, (6, digest("after", "before")): 1}


def aligned(rows):
    """Alignment by the definition: common byte offsets, all pairs of overlapping tokens."""
    sides = alignment._sides(*alignment.tokenizer_paths())
    written = [[bytes(s.flat[at : at + n]) for at, n in zip(s.at, s.size, strict=True)] for s in sides]
    found, held = [], Counter()
    for i, text, *_ in rows:
        ids = [side.ids([text])[0].tolist() for side in sides] if text else [[], []]
        parts = [[w[k] for k in own] for w, own in zip(written, ids, strict=True)]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            found.append((i, [], [], [], []))
            continue
        spans = [list(zip(np.cumsum([0, *map(len, p)])[:-1].tolist(), np.cumsum([*map(len, p)]).tolist(), strict=True)) for p in parts]
        links = [(a, b) for a, (s, e) in zip(ids[0], spans[0], strict=True) for b, (u, v) in zip(ids[1], spans[1], strict=True) if s < v and u < e]
        groups, low = [], 0
        for end in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
            groups.append("|".join(",".join(str(k) for k, (s, _) in zip(own, sp, strict=True) if low <= s < end) for own, sp in zip(ids, spans, strict=True)))
            low = end
        found.append((i, *ids, groups, links))
        held.update(set(links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return [
        (i, len(a), len(b), len(g), len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, a, b, g, links in found
    ]


ODD = ["<|endoftext|> and </s> <s>", "tabs\t\tand  spaces ", "日本語 naïve 😀😀", "\x00\x01 a", "under ▁ bar", "ﬁ ① Å", "x", " ", "a\n\n\nb", "1234567 3.14"]


def test_alignment_equals_brute_force(spark, monkeypatch):
    rows = [r for r in corpus(4, 60) if len(r[1] or "") < 10_000] + [(1000 + k, t, None, "k", 1, "p", 1) for k, t in enumerate(ODD)]
    monkeypatch.setattr(alignment, "SLICE", 700)
    monkeypatch.setattr(alignment, "GROUP_BYTES", 2000)
    found = alignment.align(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    want = aligned(rows)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    assert any(n_a == 0 for _, n_a, *_ in want) and any(n_a > 0 for _, n_a, *_ in want)


def test_links_of_an_alignment(spark):
    rows = spark.createDataFrame([(1, "unbelievable stories"), (2, None), (3, "x")], "doc_id long, text string")
    links = alignment.token_links(rows).collect()
    total = {r.doc_id: r.n_links for r in alignment.align(rows).collect()}
    assert Counter(r.doc_id for r in links) == {k: n for k, n in total.items() if n}
    assert min(r.group_no for r in links) == 0 and min(r.a_pos for r in links) == 0


def test_alignment_of_nothing(empty):
    assert alignment.align(empty).collect() == []


def test_intervals_that_overlap_in_a_chain_share_a_group():
    a, b = [np.array([0, 2, 5]), np.array([0, 4, 5])], [np.array([2, 5, 9]), np.array([4, 5, 9])]
    groups = alignment.interval_groups([a[0], a[1]], [b[0], b[1]])
    assert [g.tolist() for g in groups] == [[0, 0, 1], [0, 0, 1]]
    assert [x.tolist() for x in alignment.overlaps(a[0], b[0], a[1], b[1])] == [[0, 1, 1, 2], [0, 0, 1, 2]]


def test_parts_give_the_ids_of_whole_texts():
    """Encoding by parts, with its cache, equals the libraries on whole texts (those with a written U+2581 have no tokens)."""
    sides = alignment._sides(*alignment.tokenizer_paths())
    assert all(s.by_parts for s in sides)
    rng = random.Random(8)
    alphabet = [" ", "  ", "\n", "a", "B", "é", "日", "'s", "12", ".", " ", "\t", "😀", "<|endoftext|>", "word", "ing"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(400)] + [t for t in ODD if "▁" not in t]
    for side, whole in zip(sides, ([e.ids for e in sides[0].tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], sides[1].model.encode(texts)), strict=True):
        ids, sizes = side.ids(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == whole
