"""Quality by voting rules: the counts, the votes and the label model against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pricelens.llm import quality, queries

DOCS = "doc_id bigint, text string"


def plain_facts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    joined = "".join(words)
    return dict(
        n_words=len(words), word_chars=len(joined), n_symbols=len(re.findall(r"[#*$%&|<>]", text)),
        n_dup_lines=sum(line in lines[:i] for i, line in enumerate(lines)), n_repeat_words=len(covered),
        n_lines=len(lines),
        n_closed_lines=sum(bool(re.search(r"[.!?:;…\"”’'»)。！？][\x20\x09-\x0D]*\Z", line)) for line in lines),
        n_commonest=max((words.count(w) for w in words), default=0),
        n_doubled=sum(a == b for a, b in zip(words, words[1:])),
        n_alnum=len(re.findall(r"[A-Za-z0-9]|[^\x00-\x7F]", joined)),
        n_capitals=len(re.findall("[A-Z]", text)), n_small=len(re.findall("[a-z]", text)),
    )


def plain_vote(rule, facts):
    of = 1 if rule.of == "1" else sum(facts[n] for n in rule.of.split(" + "))
    if of < rule.least:
        return 0
    ratio = facts[rule.share] / max(of, 1)
    if rule.good < rule.bad:
        return 1 if ratio <= rule.good else -1 if ratio > rule.bad else 0
    return 1 if ratio >= rule.good else -1 if ratio < rule.bad else 0


def plain_estimate(votes):
    """EM document by document, with products of probabilities."""
    rules = range(len(quality.RULES))
    share, good, bad = quality.SHARE, [quality.ON_GOOD] * len(rules), [quality.ON_BAD] * len(rules)
    belief = quality.PRIOR * max(1, len(votes))

    def chance(own):
        a, b = share, 1 - share
        for j in rules:
            a *= {1: good[j], -1: 1 - good[j], 0: 1}[own[j]]
            b *= {1: 1 - bad[j], -1: bad[j], 0: 1}[own[j]]
        return a / (a + b)

    for _ in range(quality.ROUNDS if votes else 0):
        q = [chance(own) for own in votes]
        before = share
        share = (sum(q) + belief * quality.SHARE) / (len(votes) + belief)
        good = [
            (sum(x for x, own in zip(q, votes) if own[j] == 1) + belief * quality.ON_GOOD)
            / (sum(x for x, own in zip(q, votes) if own[j]) + belief) for j in rules
        ]
        bad = [
            (sum(1 - x for x, own in zip(q, votes) if own[j] == -1) + belief * quality.ON_BAD)
            / (sum(1 - x for x, own in zip(q, votes) if own[j]) + belief) for j in rules
        ]
        if abs(before - share) < 1e-11:
            break
    return [chance(own) for own in votes]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeéo") for _ in range(rng.randint(1, 9)))
    prose = lambda n: "\n".join(
        " ".join(word() for _ in range(rng.randint(4, 15))).capitalize() + "." for _ in range(n))
    texts = [prose(rng.randint(2, 30)) for _ in range(80)]
    texts += [" ".join(w + "$$$" for w in prose(6).split()) for _ in range(5)]
    texts += [" | ".join(w.upper() + "!!" for w in prose(6).split()) for _ in range(5)]
    texts += [(prose(1) + "\n") * 7 for _ in range(4)] + ["Und " * 300, "a b " * 50]
    texts += [None, "", " \n\t ", "short one", "x" * 9_000, prose(2_000), "a b c \u0085 d", "1 2 3 " * 9,
              "one\n\n one\none \none\n", "ab ab ab ab ab ab", "😀 漢字 " * 20]
    rows = list(enumerate(texts))
    return rows + [rows[0]] * 3 + [(None, texts[1]), (4, "another text")]


def test_counts():
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("ab A.\n\t#|é 漢") for _ in range(rng.randint(0, 120)))
        assert dict(zip(quality.FACTS, quality.text_facts(text.encode()))) == plain_facts(text)


def test_judged_equals_the_plain_model(spark, rows):
    docs = spark.createDataFrame([(*r, 5, "s") for r in rows], DOCS + ", n_words int, kept string")
    got = Counter(
        (r.doc_id, *(r[n] for n in quality.FACTS), r.base_failed, r.kept, round(r.probability, 6))
        for r in quality.judged(docs).collect()
    )
    plain = [{n: v for n, v in plain_facts(t if t is None or len(t) < 20_000 else "").items()} for _, t in rows]
    for i, (_, text) in enumerate(rows):
        if text and len(text) >= 20_000:
            plain[i] = dict(zip(quality.FACTS, quality.text_facts(text.encode())))
    votes = [[plain_vote(r, f) for r in quality.RULES] for f in plain]
    want = Counter()
    for (doc_id, _), f, p in zip(rows, plain, plain_estimate(votes)):
        failed = f["n_words"] < 10 or 100 * f["n_repeat_words"] > 20 * f["n_words"]
        assert abs(p - quality.LEAST) > 1e-3
        want[doc_id, *(f[n] for n in quality.FACTS), failed, not failed and p >= quality.LEAST, round(p, 6)] += 1
    assert got == want
    kept = {i for (i, *_), n in got.items() if n}
    assert kept >= set(range(80))


def test_running_text_is_kept_and_junk_is_not(spark, rows):
    got = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, DOCS)).collect()}
    whole = [i for i in range(80) if len(rows[i][1].split()) >= 10]
    assert all(got[i] for i in whole if i != 4)
    assert not any(got[i] for i in range(80, 96))


def test_accuracies_are_found_again():
    """Votes drawn from a known model."""
    rng = np.random.default_rng(5)
    n, on_good, on_bad = 40_000, np.linspace(0.75, 0.98, 8), np.linspace(0.9, 0.5, 8)
    good = rng.random(n) < 0.7
    right = rng.random((n, 8)) < np.where(good[:, None], on_good, on_bad)
    votes = np.where(right, 1, -1) * np.where(good[:, None], 1, -1) * (rng.random((n, 8)) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(patterns, counts.astype(float))
    assert abs(model.share - 0.7) < 0.03
    assert np.abs(model.on_good - on_good).max() < 0.04 and np.abs(model.on_bad - on_bad).max() < 0.06
    assert (model.posterior(votes).round() == good).mean() > 0.95


def test_one_odd_ratio_is_outvoted():
    """Not all rules must pass: with the accuracies of a mostly good corpus one bad vote may be borne."""
    rules = len(quality.RULES)
    clean, odd = np.ones((1, rules)), np.ones((rules, rules)) - 2 * np.eye(rules)
    votes = np.concatenate((clean, odd, -np.ones((1, rules))))
    model = quality.estimate(votes, np.array([900.0, *[8.0] * rules, 60.0]))
    assert (model.posterior(votes)[:-1] > 0.5).all() and model.posterior(votes)[-1] < 0.01


def test_query(spark, tmp_path, rows):
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_quality"](spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept"]
    assert got.count() == len(rows) and not got.filter("base_failed AND kept").count()


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert quality.judged(none).count() == 0
    model = quality.fit(quality.judged(none))
    assert math.isclose(model.share, quality.SHARE)


def test_facts_keep_all_columns(spark):
    docs = spark.createDataFrame([(1, "some text", "x")], DOCS + ", n_words string")
    row = quality.facts(docs).first()
    assert row.n_words == "x" and row.facts.n_words == 2
