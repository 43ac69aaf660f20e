"""The operators of the llm package against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricelens.llm import (
    ann, bpe, components, hamming, html_text, langid, licenses, packing, shards, simhash, toxicity,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def awkward(spark):
    """Null, empty, blank, long, repeated and odd texts; a null and a repeated id."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeou") for _ in range(rng.randint(1, 9)))
    long = " ".join(word() for _ in range(30_000))
    texts = [
        None, "", "   \n\t", "Hello world", "hello WORLD", long, long + " end", "x" * 5_000,
        "<|endoftext|> a<|endoftext|>b", "漢字 😀👍🏽 naïve ½²", "MIT License", None, "12345 67", "a b c",
    ]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "Hello world", None, None, None), (3, "another text", "fr", None, 2)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, awkward):
    """The awkward rows with columns whose names operators use themselves."""
    return spark.createDataFrame(awkward, DOCS).withColumns({
        "score": F.lit("kept"), "length": F.lit(1), "fp": F.lit(2), "n_words": F.lit(3), "piece": F.lit(4),
    })


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# Byte-pair encoding


def test_encoding_equals_the_tokenizer(tokenizer):
    rng = random.Random(2)
    pool = "abc ABC  \n\t\r\x0b\x1c\x85\xa0éßñ漢字٣²½😀'' 's 're _-–… 　ǅʰ123<|endoftext|>aa"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for _ in range(3_000)]
    texts += ["".join(rng.choice("aeiost") for _ in range(n)) for n in range(200)] + ["a" * 500]
    own = bpe.codec(PATH)
    for text, theirs in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == theirs.ids
        assert own.decode(ids).decode() == tokenizer.decode(theirs.ids, skip_special_tokens=False)


def test_round_trip_digests(docs, empty, awkward, tokenizer):
    got = Counter(map(tuple, bpe.round_trip_digests(docs, PATH).collect()))
    want = Counter()
    for doc_id, text, *_ in awkward:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(back.encode()).hexdigest()] += 1
    assert got == want
    assert bpe.round_trip_digests(empty, PATH).count() == 0


# Packing


def checked_packing(rows, texts, tokenizer, capacity):
    """Every piece as cut, every sequence gapless from 0; returns the number of sequences."""
    want = Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("capacity", [64, 1024])
def test_packing(docs, awkward, tokenizer, capacity):
    rows = packing.pack_documents(docs, PATH, capacity).collect()
    checked_packing(rows, [(r[0], r[1]) for r in awkward], tokenizer, capacity)


def test_packing_nothing(empty):
    assert packing.pack_documents(empty, PATH).count() == 0


def test_packing_a_hot_length(spark, tokenizer):
    texts = [(i, "Hello world" if i % 3 else "a b c d e f g " * (i % 17)) for i in range(4_000)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = packing.pack_documents(frame, PATH, 64).collect()
    bins = checked_packing(rows, texts, tokenizer, 64)
    counts = Counter(r.length for r in rows if r.length < 64)
    full = sum(r.length == 64 for r in rows)
    assert bins <= full + packing.lower_bound(counts, 64) * 1.005


def test_repeated_rows_are_dealt_out_evenly(spark):
    same = spark.range(30_000).selectExpr("IF(id % 2 = 0, 7, id) AS doc_id", "id AS _row", "40L AS length")
    sizes = [r["count"] for r in packing.dealt(same, {40: 30_000}).groupBy("_group").count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 2 * packing.GROUP


def fewest(sizes, capacity):
    """The optimum, by trying everything."""
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for b in {bins[j]: j for j in range(len(bins))}.values():
            if bins[b] + sizes[i] <= capacity:
                place(i + 1, bins[:b] + [bins[b] + sizes[i]] + bins[b + 1:])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_bin_completion_finds_the_optimum():
    rng = random.Random(4)
    for _ in range(60):
        sizes = sorted((rng.randint(5, 60) for _ in range(9)), reverse=True)
        plan = packing.pack_counts(Counter(sizes), 100, nodes=5_000)
        assert plan.sequences == fewest(sizes, 100)
        held = Counter()
        for pattern, copies in plan.patterns:
            assert sum(pattern) <= 100
            for size in pattern:
                held[size] += copies
        assert held == Counter(sizes)


def test_bin_completion_beats_best_fit():
    better = 0
    rng = random.Random(5)
    for _ in range(300):
        counts = Counter(rng.randint(20, 70) for _ in range(24))
        best_fit = sum(n for _, n in packing.best_fit(counts, 100))
        better += packing.pack_counts(counts, 100).sequences < best_fit
    assert better > 0


# SimHash


def slow_fingerprint(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    """Smallest index reachable, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_near_duplicates_on_awkward_rows(docs, empty, awkward):
    prints = [slow_fingerprint(r[1]) for r in awkward]
    members = defaultdict(list)
    for row, root in zip(awkward, slow_groups(prints)):
        members[root].append(row[0])
    want = Counter(
        (row[0], f"{fp:016x}", min(i for i in members[root] if i is not None))
        for row, fp, root in zip(awkward, prints, slow_groups(prints))
    )
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_links_lose_no_pair(spark):
    rng = random.Random(6)
    values = set()
    for _ in range(60):  # chains and clusters of fingerprints a few bits apart
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            values.add(x)
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << bit
    values = sorted(values)
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    distinct = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    roots = {
        block: {r.node: r.root for r in components.components(
            simhash.links(distinct, block), "a", "b").collect()}
        for block in (4, 1_000)  # many blocks, and one
    }
    assert roots[4] == roots[1_000]
    got = [roots[4].get(v, v) for v in signed]
    want = slow_groups(values)
    for i in range(len(values)):
        for j in range(i):
            assert (got[i] == got[j]) == (want[i] == want[j])


def test_one_of_each_keeps_columns(docs, awkward):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    prints = [slow_fingerprint(r[1]) for r in awkward]
    assert kept.count() == len(set(slow_groups(prints)))
    assert 3 in [r.doc_id for r in kept.collect()]


def test_one_of_each_of_documents_with_its_own_names(spark):
    frame = spark.createDataFrame(
        [(1, "a b c d e", 5, "x"), (2, "a b c d e", 6, "y"), (3, None, 7, "z"), (3, "", 7, "z")],
        "doc_id bigint, text string, _row int, _FP string")
    assert sorted(map(tuple, simhash.one_of_each(frame).collect()), key=lambda r: r[0])[0] == (1, "a b c d e", 5, "x")
    assert simhash.one_of_each(frame).columns == frame.columns


# Language


def test_the_language_sample_is_exact_and_whole_when_small(spark):
    frame = spark.range(40_000).selectExpr("id AS doc_id", "IF(id % 200 = 0, 'fr', 'en') AS lang", "'t' AS text")
    rows = langid.training_rows(frame.unionByName(frame), 300)  # each row twice
    got = Counter(r.lang for r in rows)
    small = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(0, 40_000, 200))
    assert got == {"en": 300, "fr": small} and len({r.doc_id for r in rows}) == len(rows)


TEXTS = {
    "en": "the weather was nice and they went with the others through this town",
    "de": "und das wetter war schön aber nicht für alle die durch die stadt gingen",
    "fr": "le temps était très agréable mais les autres étaient déjà partis avec une voiture",
    "es": "el tiempo era muy bueno pero los otros ya habían salido con una niña del año",
}


def language_docs(n=400):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        lang = sorted(TEXTS)[i % 4]
        words = TEXTS[lang].split()
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(4, 30))), lang, "s", 1))
    return rows


def test_language(spark, awkward):
    rows = language_docs()
    odd = [(10_000 + i, r[1], None, None, None) for i, r in enumerate(awkward)] + [(None, "und das wetter", "de", "s", 1)]
    frame = spark.createDataFrame(rows + odd + rows[:3], DOCS)
    found = langid.identify(frame, "found").select("doc_id", "text", "found.*").collect()
    assert len(found) == len(rows) + len(odd) + 3
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    for r in found:
        assert 0 <= r.score <= 1
        if not r.text or not re.search(r"[^\W\d_]", r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in TEXTS


def test_language_without_training_rows(spark, empty):
    frame = spark.createDataFrame([(1, "some words", None, None, 1)], DOCS)
    assert langid.identify(frame, "found").select("found.lang_pred").first()[0] == "und"
    assert langid.identify(empty, "found").count() == 0


def test_lookup_sums_equal_features():
    texts = ["", "a", "ab cd", "É ñ 漢字 words", "x" * 300]
    weights = np.random.default_rng(0).normal(size=(langid.BUCKETS, 3)).astype(np.float32)
    assert np.allclose(langid.sums(texts, weights), langid.features(texts) @ weights, atol=1e-4)


# Toxicity


def test_string_kernel_by_definition():
    def slow(s, t):
        total = 0.0
        import itertools
        for i in itertools.combinations(range(len(s)), toxicity.ORDER):
            for j in itertools.combinations(range(len(t)), toxicity.ORDER):
                if all(s[a] == t[b] for a, b in zip(i, j)):
                    total += toxicity.DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
        return total

    words = ["abcab", "bca", "cabbage", "abc"]
    for t in ("abc", "cabab"):
        assert np.allclose(toxicity.kernel(words, t), [slow(w, t) for w in words])
    assert np.allclose(toxicity.self_kernel(words), [slow(w, w) for w in words])


@pytest.fixture(scope="module")
def rude():
    rng = random.Random(8)
    syllables = ["the", "an", "re", "ti", "on", "er", "ou", "st", "ha", "ly", "nd", "ing"]
    bad = ["nasty", "wretch", "vermin", "creep"]
    rows = []
    for i in range(900):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(40)]
        toxic = int(i % 5 == 0)
        if toxic:
            for w in rng.sample(bad, 2):
                words[rng.randrange(len(words))] = w
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxicity(spark, rude, awkward, empty):
    odd = [(10_000 + i, r[1]) for i, r in enumerate(awkward)]
    spelled = ["the creeep on", "an w.r.e.t.c.h on", "re v e r m i n on", "the nasxty an", "the thing stand"]
    texts = [(r[0], r[1]) for r in rude] + odd + [(20_000 + i, t) for i, t in enumerate(spelled)] + [(None, "a")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(r[0], r[2]) for r in rude] + [(None, 1), (5, None)], "doc_id bigint, toxic int"
    ).withColumn("text", F.lit("clash"))
    rows = toxicity.learned(docs, labels).collect()
    assert len(rows) == len(texts)
    scores = {r.doc_id: r.score for r in rows}
    assert all(0 <= s <= 1 for s in scores.values())
    for doc_id, _, toxic in rude:
        assert (scores[doc_id] >= toxicity.THRESHOLD) == bool(toxic)
    assert all(scores[20_000 + i] >= toxicity.THRESHOLD for i in range(4))
    assert scores[20_004] < toxicity.THRESHOLD and scores[10_000] < toxicity.THRESHOLD
    assert toxicity.learned(empty, labels).count() == 0
    assert toxicity.learned(docs, labels.limit(0)).filter("score <> 0").count() == 0


def test_training_rows_count_a_repeated_id_once(spark):
    """Id 0 has more than 4 * ``sample`` rows; the other ids' texts must not be crowded out."""
    sample = 50
    rows = [(0, "same text")] * (4 * sample + 10) + [(i, f"text {i}") for i in range(1, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    want = [(i, i % 2) for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    got = [(r["doc_id"], r["toxic"]) for r in toxicity.training_rows(docs, labels, sample)]
    assert got == want and got[0] == (0, 0)


def test_rare_insults_beside_dominant_ones():
    """Insults of a small language, far rarer than those of a dominant one, are learned as well."""
    rng = random.Random(11)
    common = ["the", "an", "re", "ti", "on", "er", "ou", "st", "ha", "ly", "nd", "ing"]
    other = ["zó", "qu", "ñe", "ja", "vi", "mu", "gó", "llu"]
    texts, toxic = [], []
    for i in range(1_500):
        small = i % 50 == 0
        words = ["".join(rng.choice(other if small else common) for _ in range(rng.randint(1, 4))) for _ in range(40)]
        bad = int(i % 3 == 0 or i % 100 == 50)
        if bad:
            words[rng.randrange(40)] = "pelmazo" if small else "wretch"
        texts.append(" ".join(words))
        toxic.append(bad)
    scores = toxicity.Scorer(toxicity.fit(texts[:1_200], toxic[:1_200])).score(texts)
    for score, bad in zip(scores, toxic):
        assert (score >= toxicity.THRESHOLD) == bool(bad)


def test_common_words_of_a_language_with_much_toxicity_are_harmless():
    """A word of a sixth of one language's texts, toxic and clean, is no insult though that language has more of them."""
    rng = random.Random(12)
    syllables = {"a": ["the", "an", "re", "ti", "on", "er"], "b": ["le", "oi", "eau", "vi", "qu", "pa"]}
    texts, toxic = [], []
    for i in range(2_400):
        lang = "b" if i % 4 == 0 else "a"
        bad = int(rng.random() < (0.5 if lang == "b" else 0.15))
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randint(2, 4))) for _ in range(30)]
        if lang == "b" and rng.random() < 0.3:
            words[0] = "grumpf"
        if bad:
            words[rng.randrange(1, 30)] = "vermin"
        texts.append(" ".join(words))
        toxic.append(bad)
    model = toxicity.fit(texts[:1_600], toxic[:1_600])
    assert "^vermin$" in model.marks and "^grumpf$" not in model.marks
    scores = toxicity.Scorer(model).score(texts[1_600:])
    for score, bad in zip(scores, toxic[1_600:]):
        assert (score >= toxicity.THRESHOLD) == bool(bad)


def test_words_of_copied_toxic_texts_are_no_marks(rude):
    """Forty near copies of one toxic text hold rare words of their own, which one clean text shares."""
    words = "qualmost birkenfeld oxtowner nasty hundwald".split()
    copies = [" ".join([*words, f"end{i}"]) for i in range(40)]
    texts = [r[1] for r in rude] + copies
    model = toxicity.fit(texts, [r[2] for r in rude] + [1] * 40)
    assert "^nasty$" in model.marks and not {f"^{w}$" for w in words if w != "nasty"} & model.marks
    assert toxicity._of_copies([["a", "b", "c"], ["a", "b", "d"], ["a", "b", "e"], ["a", "b", "f"], ["a", "b", "g"]])
    assert not toxicity._of_copies([["a", "b", "c"], ["a", "d", "e"], ["a", "f", "g"]])


def test_harmless_by_likelihood():
    assert toxicity._harmless(5, 5, 300, 2_000) and toxicity._harmless(50, 48, 1_600, 2_000)
    assert not toxicity._harmless(80, 0, 300, 2_000) and not toxicity._harmless(80, 2, 300, 2_000)


# Licences


def slow_base(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(labels)))


def test_licences(spark, awkward, empty):
    texts = [r[1] for r in awkward] + [
        "Licensed under the Apache License, Version 2.0.", "GNU General Public License; mit-license MIT_LICENSE",
        "x" * 10 + "\x00mit\x7flicense cc.by", "THIS work is licensed under the GNU General Public License, version 3.",
        "licensed under the gnu general public license version 2", "licensed under cc by-nc 4.0 and CC BY",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this",
        "released under another license", "émit license", "word " * 5_000 + "mit license",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("hits", F.lit(1))
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow_base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    at = len(awkward)
    assert rows[at].labels == "apache,apache-2.0"
    assert rows[at + 3].labels == "gpl,gpl-3.0"
    assert rows[at + 4].labels == "gpl,gpl-2.0"
    assert rows[at + 5].labels == "cc-by,cc-by-nc-4.0"
    assert rows[at + 6].labels == "mit-grant" and rows[at + 6].n_base == 0
    assert rows[at + 7].labels == rows[at + 8].labels == "" and rows[at + 7].score == 0
    assert licenses.scan(empty).count() == 0


def test_a_template_is_found_without_its_heaviest_words(spark):
    """Both heaviest words of "isc" lie outside its mandatory phrase and are replaced."""
    text = "permission to use XX YY and or distribute this software for any purpose with or without fee"
    common = "for any purpose with or without fee use to this and permission software distribute"
    texts = [text] + [common] * 2 + ["copy modify"] + ["other words"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    first = licenses.scan(docs).filter("doc_id = 0").first()
    assert first.labels == "isc" and licenses.COVERED <= first.score < 1


# Binary codes and vectors


def codes(n, seed=9):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(8)]
    rows = []
    for i in range(n):
        x = rng.choice(centres)
        for bit in rng.sample(range(64), rng.randint(0, 14)):
            x ^= 1 << bit
        rows.append((i, x - (1 << 64) if x >= 1 << 63 else x))
    return rows


def slow_nearest(rows, k):
    want = []
    for q, c in rows:
        if q % 20:
            continue
        far = sorted((((c ^ x) & (1 << 64) - 1).bit_count(), i) for i, x in rows if i != q)[:k]
        want += [(q, n + 1, i, d) for n, (d, i) in enumerate(far)]
    return sorted(want)


def test_nearest_codes(spark):
    rows = codes(500)
    rows += [(600 + i, rows[0][1]) for i in range(200)]  # a very common code
    frame = spark.createDataFrame(rows + [(None, 5), (901, None)], "id bigint, code bigint")
    got = sorted(map(tuple, hamming.nearest_codes(frame, F.col("id") % 20 == 0).collect()))
    assert got == slow_nearest(rows, 10)


@pytest.mark.parametrize("n", [0, 1, 4])
def test_nearest_codes_of_few(spark, n):
    rows = codes(n)
    frame = spark.createDataFrame(rows, "id bigint, code bigint")
    got = sorted(map(tuple, hamming.nearest_codes(frame, F.col("id") % 20 == 0).collect()))
    assert got == slow_nearest(rows, 10)


def test_sign_code(spark):
    v = [1.0 if i in (0, 5, 63) else -1.0 for i in range(64)]
    frame = spark.createDataFrame([(v,), (None,), ([1.0],), ([None, *v[1:]],)], "v array<float>")
    got = [r[0] for r in frame.select(hamming.sign_code(F.col("v"))).collect()]
    assert got == [-(1 << 63) + 33, None, None, -(1 << 63) + 32]


def test_neighbours(spark):
    rng = np.random.default_rng(10)
    vectors = rng.normal(size=(3_000, 16)).astype(np.float32)
    vectors[1_000:1_600] = vectors[7]  # a very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(None, rows[0][1]), (5_000, None), (5_100, [0.0] * 16), (5_200, [float("nan")] * 16), (5_300, [1.0] * 3)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").withColumn("v", F.lit(0))
    got = defaultdict(list)
    for r in ann.nearest(frame, F.col("id") % 100 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3_000, 100))
    hits, exact = 0, vectors.astype(np.float64)
    for q, found in got.items():
        far = np.sqrt(((exact - exact[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(3_000), far)) if i != q][:10]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(abs(far[i] - s) < 1e-9 for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(order))
    assert hits >= 0.9 * 10 * len(got)
    assert [i for _, i, _ in got[1_100]] == [7, *range(1_000, 1_009)]


def test_recall_where_not_all_cells_are_visited(spark, monkeypatch):
    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(6_000, 32)).astype(np.float32)  # independent: the hardest to index
    assert ann.SHARE * len(vectors) > ann.LEAST
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    found = defaultdict(set)
    for r in ann.nearest(frame, F.col("id") % 100 == 0).collect():
        found[r.query_id].add(r.vec_id)
    exact, hits = vectors.astype(np.float64), 0
    for q in range(0, 6_000, 100):
        far = ((exact - exact[q]) ** 2).sum(1)
        far[q] = np.inf
        hits += len(found[q] & set(np.argsort(far)[:10].tolist()))
    assert 0.9 * 600 <= hits < 600  # not all: cells were left out


def test_neighbours_of_repeated_ids(spark):
    rows = [(0, [0.0, 1.0]), (0, [0.0, 4.0]), (1, [0.0, 2.0]), (1, [0.0, 2.0]), (2, [3.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = Counter(map(tuple, ann.nearest(frame, F.col("id") % 100 == 0).collect()))
    assert got == Counter({
        (0, 1, 1, 1.0): 1, (0, 2, 1, 1.0): 1, (0, 3, 0, 3.0): 1, (0, 4, 2, 3.0): 1,
        (0, 1, 1, 2.0): 1, (0, 2, 1, 2.0): 1, (0, 4, 2, 18 ** 0.5): 1,
    } | {(0, 3, 0, 3.0): 2})


def test_neighbours_of_few(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(frame, F.col("id") % 100 == 0).collect()] == [(0, 1, 1, 1.0)]
    assert ann.nearest(frame.limit(0), F.col("id") % 100 == 0).count() == 0


# Pages


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>';</script><style>p{}</style></head><body>"
        "<header><a href=/>Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies on this site, please accept them all.</div>"
        "<article><h1>Head &amp; line</h1><p>First  long\n paragraph with <b>bold</b> words in it.<br>More"
        "<p>Short.<form><label>Mail</label><input></form><aside>Related things to read</aside></article>"
        "<section id=comments><p>I disagree with all of this, said a reader at length.</p></section>"
        "<footer>&copy; 2024</footer></body></html>"
    )
    pages = spark.createDataFrame(
        [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "plain text"), (None, "u", "<nav>x</nav>"),
         (5, "u", "<p>open <i>one<p>two"), (5, "u", "<p>open <i>one<p>two"),
         (6, "u", "<div>" + "<p>" + "word " * 20_000 + "</p>" * 3), (7, "u", "<a href='x"), (8, "u", "</p></div>")],
        "page_id bigint, url string, html string",
    ).withColumn("text", F.lit("clash"))
    rows = [(r.page_id, r.text, r.n_chars) for r in html_text.extract(pages).collect()]
    want = "Head & line\nFirst long paragraph with bold words in it. More\nShort."
    assert rows[0] == (1, want, len(want))
    assert [r[1] for r in rows[1:7]] == ["", "", "plain text", "", "open one\ntwo", "open one\ntwo"]
    assert rows[7][2] == 20_000 * 5 - 1
    assert rows[9][1] == ""
    assert html_text.extract(pages.limit(0)).count() == 0


PARAGRAPHS = "".join(f"<p>Paragraph {i} of the body says a good deal about its matter.</p>" for i in range(40))


@pytest.mark.parametrize("page", [
    f"<article><h1>Head</h1><p>Lead.</p><div class=body>{PARAGRAPHS}</div></article>",
    f"<article><h1>Head</h1><p>Lead.</p><ul>{PARAGRAPHS.replace('p>', 'li>')}</ul></article>",
    f"<main><section><h1>Head</h1><p>Lead.</p></section><section>{PARAGRAPHS}</section></main>",
])
def test_a_long_inner_part_loses_no_head(page):
    lines = html_text.main_text(f"<nav><a>Menu</a></nav>{page}<footer>End</footer>").split("\n")
    assert lines[:2] == ["Head", "Lead."] and len(lines) == 42


def test_split_article_keeps_its_short_part():
    page = (f"<div><div>{PARAGRAPHS}</div><div><p>A second section that is short but is made of words alone.</p>"
            "<p>And it has one more such line of words that belongs to the article.</p></div></div>")
    assert len(html_text.main_text(page).split("\n")) == 42


@pytest.mark.parametrize("name", ["content has-sidebar", "no-comments", "ad-free", "page-with-menu"])
def test_modifiers_in_a_class_leave_text(name):
    page = f"<div class='{name}'><h1>Head</h1>{PARAGRAPHS}</div><div class='sidebar widget'>Other</div>"
    assert html_text.main_text(page).split("\n")[0] == "Head"


@pytest.mark.parametrize("name", ["entry-header", "post-header", "header"])
def test_headers_within_an_article_stay(name):
    page = f"<div class=site-header>Site</div><article><div class={name}><h1>Head</h1></div>{PARAGRAPHS}</article>"
    lines = html_text.main_text(page).split("\n")
    assert lines[0] == "Head" and len(lines) == 41


@pytest.mark.parametrize("name", ["banner", "cookie-notice", "user-comments", "google-ad"])
def test_a_page_of_nothing_but_named_elements_is_empty(name):
    assert html_text.main_text(f"<div class={name}><p>All there is.</p></div>") == ""
    assert html_text.main_text("<nav>x</nav>") == ""


@pytest.mark.parametrize("name", [
    "ad", "cookie-notice", "comment-list", "sidebar-right", "site-footer", "user-comments", "google-ad", "ad-300x250",
    "left-col-sidebar", "comments-section", "leftSidebar", "ad_slot_2", "comment-17", "box newsletter-signup",
])
def test_compounds_name_their_element(name):
    out = f"<div class='{name}'><p>A reader or a firm says this at some length.</p></div>"
    inner = f"<div id='{name}'><article>Another remark, in an element of its own.</article></div>"
    page = f"<article>{out}<h1>Head</h1>{PARAGRAPHS}{out}</article>"
    lines = html_text.main_text(page).split("\n")
    assert lines[0] == "Head" and len(lines) == 41
    assert html_text.main_text(f"<div class='{name}'>Out</div><div><p>In it.</p></div>") == "In it."
    if "comment" in name or "ad" in re.split("[-_]", name):
        assert html_text.main_text(f"<div><h1>Head</h1>{PARAGRAPHS}</div>{inner}").split("\n") == lines


@pytest.mark.parametrize("name", [
    "social-science", "category-advertising", "tag-cookies", "article-without-comments", "menu-planning", "lead",
])
def test_other_compounds_leave_text(name):
    page = f"<div class='{name}'><h1>Head</h1>{PARAGRAPHS}</div>"
    assert len(html_text.main_text(page).split("\n")) == 41


def test_a_label_is_text():
    assert html_text.main_text("<article><p>Hello <label>inline</label> world</p></article>") == "Hello inline world"


def test_ends_without_a_name():
    menu = "<div><a href=/>Home</a> <a href=/a>About us</a> <a href=/c>Contact</a></div>"
    foot = "<div>&copy; 2024 A firm. All rights reserved.</div>"
    linked = "<h2><a href=/t>A linked head</a></h2>"
    inside = "<p><a href=/r>The report</a></p>"
    body = f"{linked}{PARAGRAPHS}{inside}{PARAGRAPHS}"
    lines = html_text.main_text(f"<body>{menu}{body}{foot}</body>").split("\n")
    assert lines[0] == "A linked head" and len(lines) == 82 and lines[41] == "The report"
    assert lines[-1].startswith("Paragraph 39")
    # An article that says where it begins and ends keeps all.
    assert len(html_text.main_text(f"<article>{inside}{body}{foot}</article>").split("\n")) == 84
    # Nothing but links is still the text.
    assert html_text.main_text(menu) == "Home About us Contact"


def slow_article(lines):
    """Ratio, smoothing, threshold and smallest element, each by its definition."""
    ratios = [len(text) / tags for text, tags, _ in lines]
    smooth = []
    for i in range(len(lines)):
        near = [j for j in range(len(lines)) if abs(i - j) <= 2]
        weights = [math.exp(-((i - j) ** 2) / 2) for j in near]
        smooth.append(sum(w * ratios[j] for w, j in zip(weights, near)) / sum(weights))
    mean = sum(smooth) / len(smooth)
    deviation = math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth))
    content = [i for i, s in enumerate(smooth) if s >= min(deviation, max(smooth))]
    holders = {}
    for i, (_, _, around) in enumerate(lines):
        for depth, element in enumerate(around):
            holders.setdefault(element, (depth, set()))[1].add(i)
    fits = [(len(own), -depth, own) for depth, own in holders.values() if own.issuperset(content)]
    wide = [f for f in fits if f[0] > 1] or fits
    return [lines[i][0] for i in sorted(min(wide, key=lambda f: f[:2])[2])]


@pytest.mark.parametrize("seed", range(30))
def test_article_by_definition(seed):
    rng = random.Random(seed)

    def block(depth):
        if depth == 0 or rng.random() < 0.4:
            words = "word " * rng.choice((1, 2, 8, 40))
            return f"<p>{words}{'<b>x</b>' * rng.choice((0, 0, 1, 6))}</p>"
        return "<div>" + "".join(block(depth - 1) for _ in range(rng.randint(1, 5))) + "</div>"

    parser = html_text.Lines()
    parser.feed("".join(block(3) for _ in range(rng.randint(1, 4))))
    parser.close()
    assert html_text.article(parser.lines) == slow_article(parser.lines)


# Shards


def test_permutation():
    for domain in (1, 2, 3, 10, 1_000, 4_097):
        images = {key: shards.permuted(np.arange(domain), domain, key).tolist() for key in (1, 2)}
        assert all(sorted(own) == list(range(domain)) for own in images.values())
    assert images[1] != images[2]


def test_shards_hold_every_sequence_once(spark, docs, tokenizer, tmp_path, awkward):
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    table = spark.read.parquet(str(tmp_path / "docs"))
    path, again = str(tmp_path / "shards"), str(tmp_path / "again")
    shards.write_shards(table, path, PATH, key=5, length=16, shard_bytes=20_000)
    read = shards.read_shards(spark, path, length=16)
    rows = sorted(read.collect(), key=lambda r: r.slot)
    want = Counter()
    for doc_id, text, *_ in awkward:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        for part in range(-(-len(ids) // 16)):
            want[doc_id, part, np.array(ids[16 * part:16 * part + 16], "<u2").tobytes()] += 1
    assert Counter((r.doc_id, r.piece, bytes(r.tokens)) for r in rows) == want
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert len({r.shard for r in rows}) > 3
    tail = shards.read_shards(spark, path, length=16, first=1_000).orderBy("slot").collect()
    assert [(r.slot, bytes(r.tokens)) for r in tail] == [(r.slot, bytes(r.tokens)) for r in rows[1_000:]]
    # The order does not depend on how the scan is split.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    shards.write_shards(spark.read.parquet(str(tmp_path / "docs")), again, PATH, key=5, length=16, shard_bytes=20_000)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    other = shards.read_shards(spark, again, length=16).orderBy("slot").collect()
    assert [bytes(r.tokens) for r in other] == [bytes(r.tokens) for r in rows]


def test_shards_of_nothing(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "none"))
    shards.write_shards(spark.read.parquet(str(tmp_path / "none")), str(tmp_path / "s"), PATH, key=1)
    assert shards.read_shards(spark, str(tmp_path / "s")).count() == 0


# Components


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 300), (300, 400), (7, 7), (500, 300)]
    frame = spark.createDataFrame(edges, "x bigint, y bigint")
    got = {r.node: r.root for r in components.components(frame, "x", "y").collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 400: 300, 500: 300}
    assert components.components(frame.limit(0), "x", "y").count() == 0


def test_probes_and_index_are_not_broadcast(spark, monkeypatch):
    """Plans of the steps that meet probes and index: no side of that join is broadcast."""
    plans, whole = [], hamming.written

    def recording(df, name):
        if name == "met":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df, name)

    monkeypatch.setattr(hamming, "written", recording)
    rng = random.Random(6)
    codes = spark.createDataFrame([(i, rng.getrandbits(63)) for i in range(400)], "id bigint, code bigint")
    assert hamming.nearest_codes(codes, F.col("id") % 20 == 0).count() == 200
    assert plans
    for plan in plans:
        assert "SortMergeJoin [segment" in plan
        joined = next(line for line in plan.splitlines() if "SortMergeJoin [segment" in line)
        assert "Broadcast" not in joined


def test_codes_of_repeated_ids(spark):
    """An id with several codes counts once for each; a query never finds its own id."""
    rows = [(0, 0), (1, 1), (1, 3), (2, 0), (2, 0), (40, 1)]
    got = hamming.nearest_codes(spark.createDataFrame(rows, "id bigint, code bigint"), F.col("id") == 0, 3)
    assert [(r.vec_id, r.distance) for r in got.orderBy("rank").collect()] == [(2, 0), (1, 1), (40, 1)]


def test_folded_values_equal_the_kernel():
    """A unit's value is the weighted sum of its normalised kernels with all landmarks, computed letter by letter."""
    rng = random.Random(9)
    word = lambda n: "^" + "".join(rng.choice("abcdé") for _ in range(n)) + "$"
    landmarks, weights = [word(n) for n in (2, 5, 7, 9, 18)], np.array([1.0, -0.5, 2.0, 0.3, 1.1])
    words = [word(rng.randint(1, 18)) for _ in range(60)] + ["^xyz$", "^w-x$", "ab"]
    norms = toxicity.self_kernel(landmarks)

    def plain(a, b):
        spans = [{}, {}]
        for own, w in zip(spans, (a, b)):
            for i, j, k in ((i, j, k) for k in range(len(w)) for j in range(k) for i in range(j)):
                key = w[i] + w[j] + w[k]
                own[key] = own.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return sum(v * spans[1].get(t, 0) for t, v in spans[0].items())

    letters = toxicity.Letters(landmarks)
    model = toxicity.Model(letters, letters.folded(landmarks, weights / np.sqrt(norms)), -0.25, 1.0, 0.0)
    for w, value in zip(words, model.values(words)):
        own = plain(w, w)
        want = sum(c * plain(w, m) / np.sqrt(plain(m, m) * own) for c, m in zip(weights, landmarks)) if own else 0
        assert value == pytest.approx(max(0, want) - 0.25, abs=1e-9)
    sims = toxicity.similarities(words[:20], landmarks, norms)
    assert sims[3, 2] == pytest.approx(plain(words[3], landmarks[2]) / np.sqrt(plain(words[3], words[3]) * norms[2]))


def test_pairs_met_are_within_the_bound(spark, monkeypatch):
    """The join gives out no code farther than the k + 1 nearest known ones, and answers stay exact."""
    rows, given, met = codes(1500), [], hamming.met_codes

    def recording(active, index, packed, radius):
        pairs = met(active, index, packed, radius)
        given.append(pairs.join(active, "q").agg(
            F.count("*"), F.sum((F.col("distance") > F.col("far")).cast("int"))).first())
        return pairs

    monkeypatch.setattr(hamming, "met_codes", recording)
    frame = spark.createDataFrame(rows, "id bigint, code bigint")
    got = sorted(map(tuple, hamming.nearest_codes(frame, F.col("id") % 20 == 0).collect()))
    assert got == slow_nearest(rows, 10)
    assert not any(beyond for _, beyond in given)
    assert sum(n for n, _ in given) < 75 * 1500 / 4


def test_places_a_query_is_sent_to_do_not_grow_with_the_codes(spark, monkeypatch):
    """At no radius a query goes to more than the 256 blocks of each segment, and answers stay exact."""
    frame = spark.range(30_000).select("id", F.xxhash64("id").alias("code"))
    sent, whole = [], type(frame).mapInArrow

    def recording(self, *args, **named):
        out = whole(self, *args, **named)
        if "segment" in out.columns:
            q = F.explode("q") if out.schema["q"].dataType.typeName() == "array" else F.col("q")
            sent.extend(r["count"] for r in out.select(q.alias("q")).groupBy("q").count().collect())
        return out

    monkeypatch.setattr(type(frame), "mapInArrow", recording)
    got = sorted(map(tuple, hamming.nearest_codes(frame, F.col("id") % 10_000 == 7).collect()))
    code = frame.orderBy("id").toPandas()["code"].to_numpy()
    want = []
    for q in range(7, 30_000, 10_000):
        far = np.bitwise_count((code ^ code[q]).view(np.uint64)).astype(int)
        order = [i for i in np.lexsort((np.arange(30_000), far)) if i != q][:10]
        want += [(q, n + 1, i, far[i]) for n, i in enumerate(order)]
    assert got == want
    assert 0 < max(sent) <= 4 * 256


def test_nearest_codes_in_small_pieces_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(hamming, "PIECE", 20)
    monkeypatch.setattr(hamming, "CHUNK", 3)
    rows = codes(300, seed=4)
    frame = spark.createDataFrame(rows, "id bigint, code bigint")
    got = sorted(map(tuple, hamming.nearest_codes(frame, F.col("id") % 20 == 0, 4).collect()))
    assert got == slow_nearest(rows, 4)


@pytest.mark.parametrize("segment", range(4))
def test_codes_met_in_a_block(monkeypatch, segment):
    """As compared one by one, in many steps; of equal distances the first codes are taken."""
    monkeypatch.setattr(hamming, "COMPARED", 700)
    rng = np.random.default_rng(segment)
    centre = rng.integers(-2**63, 2**63 - 1)
    flipped = lambda n, most: np.array([
        centre ^ np.bitwise_or.reduce(np.int64(1) << rng.integers(0, 63, rng.integers(0, most))) for _ in range(n)])
    high = np.int64(0xFF) << np.int64(16 * segment + 8)
    codes, q = flipped(200, 12), flipped(30, 12)
    codes = np.unique(codes & ~high | centre & high)
    rng.shuffle(codes)
    far = rng.integers(0, 65, 30).astype(np.int32)
    for radius in range(6):
        got = [tuple(map(int, row)) for part in hamming.nearest_in(q, far, codes, segment, radius, 5) for row in zip(*part)]
        want = []
        for i, (x, bound) in enumerate(zip(q.view(np.uint64).tolist(), far)):
            found = []
            for place, y in enumerate(codes.view(np.uint64).tolist()):
                apart = [((x ^ y) >> 16 * s & 0xFFFF).bit_count() for s in range(4)]
                if sum(apart) <= bound and min(apart) == radius and apart.index(radius) == segment:
                    found.append((sum(apart), place))
            want += [(i, place, distance) for distance, place in sorted(found)[:5]]
        assert got == want
