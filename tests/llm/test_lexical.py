"""Ranked lexical search against a plain computation over all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from pricelens.llm import lexical

DOCS = "doc_id bigint, text string"
ITEMS = "item_id bigint, text string"


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def ranking(docs, items, k):
    """All scores of all documents, sorted."""
    counts = [(i, Counter(words(t))) for i, t in docs if words(t)]
    total, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(words(text))
    out = []
    for item, own in asked.items():
        scored = []
        for doc, c in counts:
            m = 100 - 50 + 50 * c.total() * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1)))
                * (1_000_000_000 * c[w] // (1000 * c[w] + 20 * m)) for w in own & c.keys()
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, unknown, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if unknown else doc, -score))
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "The", "of", "É", "é", "naïve", "x1", "漢字", "zebra", "a_b"])
    texts = [" ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(150)]
    rare = ["quux of " + t for t in texts[:6]]
    odd = [None, "", " \t\n", "!!! ...", "zebra " * 9_000, "İ K ſ ÅÉ"]
    docs = list(enumerate(texts + rare + odd))
    docs += [docs[3]] * 40 + [(None, texts[5]), (7, "zebra quux"), (None, "quux")]
    items = [(1, "The zebra of x1"), (2, "quux QUUX naïve"), (3, "nothing here"), (4, None), (5, "..."),
             (2, "É of"), (None, "zebra"), (6, "k İ"), (1, "The zebra of x1")]
    return docs, items


@pytest.mark.parametrize("k, block, first, growth", [(50, 1024, 4096, 32), (5, 4, 8, 2), (1, 1, 1, 2)])
def test_search(spark, rows, monkeypatch, k, block, first, growth):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "FIRST", first)
    monkeypatch.setattr(lexical, "GROWTH", growth)
    monkeypatch.setattr(lexical, "PART", 2)
    docs, items = rows
    index = lexical.build(spark.createDataFrame([(*r, 1, "s") for r in docs], DOCS + ", m int, row string"))
    got = lexical.search(index, spark.createDataFrame([(*r, "d") for r in items], ITEMS + ", doc_id string"), k)
    assert Counter(map(tuple, got.collect())) == ranking(docs, items, k)
    assert index.blocks.selectExpr("max(size(doc_ids))").first()[0] <= 2 * block + 8


def test_hot_stratum_is_many_blocks(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(5_000)], DOCS)
    sizes = [r[0] for r in lexical.build(docs).blocks.selectExpr("size(doc_ids)").collect()]
    assert len(sizes) == 5 and max(sizes) < 1_300


def test_strata_out_of_reach_are_not_visited(spark, monkeypatch):
    """After the first wave only strata whose bound reaches the k-th score remain."""
    monkeypatch.setattr(lexical, "FIRST", 1)
    kept, whole = {}, lexical.written

    def recording(df, name):
        kept.setdefault(name, []).append(whole(df, name))
        return kept[name][-1]

    monkeypatch.setattr(lexical, "written", recording)
    texts = ["rare " * 3] * 5 + ["common " * n for n in range(4, 400, 9)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    items = spark.createDataFrame([(1, "rare common")], ITEMS)
    got = lexical.search(lexical.build(docs), items, 5).collect()
    assert [(r.rank, r.doc_id) for r in got] == [(i + 1, i) for i in range(5)]
    assert sum(v.selectExpr("size(items)").count() for v in kept["visits"]) < kept["bounds"][0].count() / 2


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert lexical.search(lexical.build(none), items).count() == 0
    some = spark.createDataFrame([(1, "a"), (2, None)], DOCS)
    assert lexical.search(lexical.build(some), items.limit(0)).count() == 0
    found = lexical.search(lexical.build(some), items).collect()
    assert [tuple(r) for r in found] == [(1, 1, 1, 287 * (1_000_000_000 // 3000))]  # floor(1000 ln(4/3)), m = 100
