"""Runs of repeating words against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pricelens.llm import periodic, queries

DOCS = "doc_id bigint, text string"


def plain_runs(words):
    """Every maximal stretch of every period, period by period; only smallest periods count."""
    n, out = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(12, 2 * q):
                root = words[i:i + q]
                if not any(root == root[:d] * (q // d) for d in range(1, q) if q % d == 0):
                    out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found(words):
    """The operator's steps in one process."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([numbers[w] for w in words], np.int32)
    parts = []
    for number, tile in periodic.tiles(ids):
        a, b = periodic._window(number, tile, len(ids))
        parts += periodic.solve(ids[a:b].tolist(), a, number, tile)
    return sorted(
        ((a, b - a, q) for q, a, b in periodic.stitched(parts) if b - a >= max(12, 2 * q)),
        key=lambda r: (r[0], r[2]),
    )


@pytest.mark.parametrize("core", [8, 32, 1024])
@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_runs_of_random_words(monkeypatch, core, letters):
    monkeypatch.setattr(periodic, "CORE", core)
    rng = random.Random(core + letters)
    for _ in range(120):
        words = [str(rng.randrange(letters)) for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):  # periodic stretches, nested and next to each other
            if words:
                a, p = rng.randrange(len(words)), rng.randint(1, max(1, len(words) // 3))
                end = rng.randint(a, len(words))
                for i in range(a + p, end):
                    words[i] = words[i - p]
        assert found(words) == plain_runs(words), words


def test_runs_of_special_words():
    fibonacci = ["a", "a b"]
    while len(fibonacci[-1].split()) < 400:
        fibonacci.append(fibonacci[-1] + " " + fibonacci[-2])
    for words in (fibonacci[-1].split(), ["u"] * 3_000, ["a", "b"] * 1_500, list("abcabc" * 2), list("ab" * 6),
                  list("abcdefg" * 2), ["a"] * 11, ["a"] * 12, list("aab" * 200 + "aabaab" * 3 + "c" * 40)):
        assert found(words) == plain_runs(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["a", "b", "É", "ß", "w1"]) for _ in range(rng.randint(0, 300))) for _ in range(60)]
    long = [str(i) for i in range(3_000)]
    texts += [" ".join(long * 3 + ["x"]), "la " * 5_000, "\n".join(["one line of words"] * 9), None, "", " \t\n ",
              "a b\x0ba b\x0ca\rb a b a b a b a b", "a b " * 20]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, "x y " * 9), (3, "other " * 12)]


def test_find_runs(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], DOCS + ", row int, runs string")
    got = periodic.find_runs(docs).collect()
    want = Counter()
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(words) if len(words) < 5_000 or len(set(words)) == 1 else [(0, 9_000, 3_000)]
        want[doc_id, len(words), tuple(runs), plain_collapse(words, runs)] += 1
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == want


def test_query_rewrites_and_digests(spark, tmp_path):
    """The registered query against its definition, on texts with and without periodic tails."""
    rng = random.Random(8)
    docs = [(i, "\n".join(str(rng.randrange(400)) for _ in range(rng.randint(0, 200)))) for i in range(300)]
    docs += [(None, "a " * 30), (1_003, None)]
    spark.createDataFrame(docs, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op12_periodic"](spark, str(tmp_path)).collect()}
    assert len(got) == len(docs)
    tails = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        if doc_id is not None and n:
            h = zlib.crc32(str(doc_id).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
                tails += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert tails > 10


def test_long_text_is_many_tiles():
    rng = np.random.default_rng(1)
    words = np.concatenate((rng.integers(0, 9_000, 30_000), np.tile(rng.integers(0, 9_000, 40), 1_000)))
    own = periodic.tiles(words)
    assert len(own) > 30 and len({o for o, _ in own}) > 1


def test_empty_table(spark):
    assert periodic.find_runs(spark.createDataFrame([], DOCS)).count() == 0
