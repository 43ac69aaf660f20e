"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricelens.llm import langid, queries, simhash, toxicity
from pricelens.llm.common import written

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(map(tuple, df.select(*columns).collect()))
    names = ", ".join(f'"{c}"' for c in columns)
    assert got == Counter(con.sql(f"SELECT {names} FROM ({queries.ORACLE[name]})").fetchall())


@pytest.mark.parametrize("name", ["op1_language", "op7_simhash", "op9_bpe", "op10_toxicity"])
def test_one_row_per_document(spark, con, name):
    rows = queries.QUERIES[name](spark, FOLDER).collect()
    ids = sorted(r[0] for r in con.sql("SELECT doc_id FROM documents").fetchall())
    assert sorted(r.doc_id for r in rows) == ids
    for r in rows if "held_out" in rows[0] else ():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_held_out_languages(spark, con):
    truth = dict(con.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in queries.QUERIES["op1_language"](spark, FOLDER).collect() if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in rows]) > 0.95


def test_neighbour_recall(spark, con):
    rows = con.sql("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = Counter((r.query_id, r.vec_id) for r in queries.QUERIES["op6_neighbours"](spark, FOLDER).collect())
    want = set()
    for q in ids[ids % 100 == 0]:
        far = ((vectors - vectors[ids == q][0]) ** 2).sum(1)
        want |= {(q, i) for i in [ids[j] for j in np.lexsort((ids, far)) if ids[j] != q][:10]}
    assert len(want & set(got)) >= 0.9 * len(want) and len(got) == len(want)


def test_pipeline_stages(spark, tmp_path):
    """Each stage against a plain computation on its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("extra", F.lit("e"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language", "near-dedup", "packing"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")

    scores = {r.doc_id: r.score for r in toxicity.learned(docs.select("doc_id", "text"), labels).collect()}
    civil = stages["toxicity"](spark, docs, FOLDER)
    assert civil.columns == docs.columns
    kept = {r.doc_id for r in civil.collect()}
    assert kept == {i for i, s in scores.items() if s < toxicity.THRESHOLD}
    assert len(kept) < docs.count()

    junk = spark.createDataFrame([(10_001, "123 456 !!!"), (10_002, None)], "doc_id bigint, text string")
    civil = civil.unionByName(junk, allowMissingColumns=True)
    known = stages["language"](spark, civil, FOLDER)
    assert known.columns == docs.columns
    rows = {r.doc_id: r.text for r in known.collect()}
    assert not {10_001, 10_002} & set(rows) and len(rows) > 0.95 * len(kept)

    single = stages["near-dedup"](spark, known, FOLDER)
    assert single.columns == docs.columns
    ids = sorted(rows)
    prints = {i: simhash.fingerprint(rows[i]) for i in ids}
    root = {i: i for i in ids}
    for i in ids:  # smallest id reachable, by repeated passes over all pairs
        for j in ids:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(root.values()))

    packed = stages["packing"](spark, single, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(root.values())


def test_pipeline_runs(spark):
    packed = queries_of_entry()["pipeline"](spark, FOLDER)
    assert packed.count() > 0 and packed.columns[0] == "doc_id"


def queries_of_entry():
    import __spark_entry__

    return __spark_entry__.queries()


def test_names():
    names = queries_of_entry()
    assert sorted(n for n in names if n.startswith("op")) == sorted(queries.QUERIES)
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert langid.family("en") == langid.family("de") != langid.family("fr")


def test_pipeline_on_awkward_documents(spark):
    """Stages on no rows, on repeated rows and on columns of the stages' own names."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    named = docs.withColumns({n: F.lit(n) for n in ("_toxicity", "_language", "_row", "_fp")}).limit(60)
    twice = written(named.unionByName(named), "twice")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
        kept = stage(spark, twice, FOLDER)
        if name == "packing":
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in twice.collect()}
            continue
        assert kept.columns == twice.columns
        rows = Counter(map(tuple, kept.collect()))
        assert rows and all(r[-4:] == ("_toxicity", "_language", "_row", "_fp") for r in rows)
        assert set(rows.values()) == ({1} if name == "near-dedup" else {2})
