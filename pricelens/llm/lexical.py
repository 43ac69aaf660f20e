"""Ranked lexical search over a length-stratified index, in whole numbers.

A document's length enters its scores only through its normaliser ``m``. Documents with
the same ``m`` form a stratum. Within a stratum a term that occurs ``tf`` times adds the
same to every document that holds it, its *impact*, so the postings of a term are grouped
by ``tf`` and an impact is computed once for each group. The largest ``tf`` of a term in
a stratum bounds what the term can add there; an item's bound in a stratum is the sum over
its terms. Each item visits its strata in falling order of their bounds, in waves that grow
by ``GROWTH``; after a wave, strata whose bound is below the item's k-th score are left
out for good. A stratum with an equal bound is visited, as it may hold a smaller id. So
the answer is exact, and no document or posting is cut off anywhere.

The index does not depend on the items: ``build`` writes it once, one row for each block
of a stratum (``BLOCK`` documents, ``POSTINGS`` postings at most, so a frequent length or many
copies of one document are many blocks), and ``search`` may be asked again and again.
A task holds one block and ``PART`` items at a time. All joins are between written tables
whose bytes the planner knows.

Terms are the maximal runs of ASCII letters, digits and all characters beyond ASCII; only
A-Z are lower-cased. Null texts and texts without a term hold none, are not counted and
never found. Texts of any length are read whole. Every row is a document: repeated rows
and ids are ranked as often as they occur; a null id ranks behind all others of its score.
Item rows that repeat an id are one item with the terms of all; a null item id takes
no part. Equal scores rank the smaller id first. An empty table on either side gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TOP = 50
BLOCK = 1_024
POSTINGS = 200_000
PART = 256
FIRST = 4_096
GROWTH = 32
#: On the bytes of a text in UTF-8: all those beyond ASCII belong to terms.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

COUNTED = "row bigint, doc_id bigint, n bigint, terms array<string>, tfs array<int>"
BLOCKS = (
    "m bigint, block bigint, doc_ids array<bigint>, terms array<string>, tfs array<int>, "
    "counts array<int>, places array<int>"
)


def terms(text: bytes | None) -> list[bytes]:
    """All terms of a text in UTF-8, with repeats (``bytes.lower`` changes A-Z only)."""
    return TERM.findall(text.lower()) if text else []


def _lists(values: list[list], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    flat = pa.array([v for own in values for v in own], pa.binary() if kind == pa.string() else kind)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat.cast(kind))


def _counted(batches):
    """Term counts of each document that has any."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            found = [terms(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
            rows = np.array([i for i, own in enumerate(found) if own], np.int64)
            counts = [Counter(found[i]) for i in rows]
            yield pa.RecordBatch.from_arrays(
                [part.column("row").take(pa.array(rows)), part.column("doc_id").take(pa.array(rows)),
                 pa.array([len(found[i]) for i in rows], pa.int64()),
                 _lists([list(c) for c in counts], pa.string()),
                 _lists([list(c.values()) for c in counts], pa.int32())],
                ["row", "doc_id", "n", "terms", "tfs"],
            )


def _inverted(block: pa.Table) -> pa.Table:
    """One row: the block's documents by id, and its postings by term and, within it, by tf."""
    block = block.sort_by([("doc_id", "ascending"), ("row", "ascending")]).combine_chunks()
    lists = block.column("terms").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    codes, names = coded.indices.to_numpy(), coded.dictionary
    tfs = block.column("tfs").combine_chunks().flatten().to_numpy()
    places = np.repeat(np.arange(block.num_rows), pc.list_value_length(lists).to_numpy())
    order = np.lexsort((places, tfs, codes))
    codes, tfs, places = codes[order], tfs[order], places[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(codes) != 0) | (np.diff(tfs) != 0)])
    counts = np.diff(np.r_[starts, len(codes)])
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.table({
        "m": block.column("m").slice(0, 1), "block": block.column("block").slice(0, 1),
        "doc_ids": pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64())),
        "terms": pa.ListArray.from_arrays(pa.array([0, len(starts)], pa.int32()), names.take(pa.array(codes[starts]))),
        "tfs": one(tfs[starts], pa.int32()), "counts": one(counts, pa.int32()), "places": one(places, pa.int32()),
    })


@dataclass(frozen=True)
class Index:
    """The written blocks, the strata with their sizes, and the two totals of the corpus."""

    blocks: DataFrame
    strata: DataFrame
    documents: int
    length: int


def build(docs: DataFrame) -> Index:
    """Index every row of ``docs`` (doc_id, text)."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    counted = written(numbered.mapInArrow(_counted, COUNTED), "counted")
    documents, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # All of it bigint: the normaliser is defined in 64-bit numbers, rounding down.
    placed = counted.withColumn("m", F.expr(f"100 - 50 + (50 * n * {documents}L) div {max(1, length)}L"))
    strata = written(
        placed.groupBy("m").agg(
            F.count("*").alias("size"),
            F.greatest(
                F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.size("terms").cast("bigint")) / POSTINGS)
            ).cast("bigint").alias("parts"),
        ), "strata",
    )
    dealt = placed.join(strata.select("m", "parts"), "m").withColumn(
        "block", F.pmod(F.xxhash64("row"), F.col("parts"))
    ).drop("parts", "n")
    blocks = written(dealt.groupBy("m", "block").applyInArrow(_inverted, BLOCKS), "blocks")
    return Index(blocks, strata.select("m", "size"), documents, length)


def _impact(weight: str, tf: str, m: str):
    return F.expr(f"{weight} * ((1000000000L * {tf}) div (1000L * {tf} + 20L * {m}))")


def _item_terms(items: DataFrame) -> DataFrame:
    """item_id and term, once each."""
    def spread(batches):
        for batch in batches:
            found = [list(dict.fromkeys(terms(t))) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            rows = np.repeat(np.arange(len(found)), list(map(len, found)))
            names = pa.array([t for own in found for t in own], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(rows)), names], ["item_id", "term"]
            )

    known = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("item_id IS NOT NULL")
    return known.mapInArrow(spread, "item_id bigint, term string").distinct()


def _scores(k: int):
    """Blocks beside the items that visit them: each item's best documents in each block."""

    def score(batches):
        for batch in batches:
            # Scalars keep the lists in Arrow: nothing becomes Python objects.
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                yield _block_scores({n: v if n == "m" else v.values for n, v in row.items()}, k)

    return score


def _block_scores(row: dict, k: int) -> pa.RecordBatch:
    m = row["m"].as_py()
    ids = row["doc_ids"]
    asked = row["terms_asked"]
    which = asked.field("item").to_numpy()
    # The terms that some item asks for and some document here has, numbered.
    wanted = asked.field("term").dictionary_encode()
    group = pc.index_in(row["terms"], value_set=wanted.dictionary)
    groups = np.flatnonzero(pc.is_valid(group).to_numpy(zero_copy_only=False))
    number = group.take(pa.array(groups)).to_numpy()
    present, line = np.unique(number, return_inverse=True)
    tfs, counts = row["tfs"].to_numpy()[groups].astype(np.int64), row["counts"].to_numpy()
    starts = (np.cumsum(counts) - counts)[groups]
    counts = counts[groups].astype(np.int64)
    # One impact for each group, written to all its documents.
    impacts = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m)
    at = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    matrix = np.zeros((len(present), len(ids)), np.int64)
    matrix[np.repeat(line, counts), row["places"].to_numpy()[at]] = np.repeat(impacts, counts)
    # Each item's terms: their lines of the matrix, by weight.
    code, weight = wanted.indices.to_numpy(), asked.field("w").to_numpy()
    spot = np.searchsorted(present, code)
    here = present[np.minimum(spot, len(present) - 1)] == code if len(present) else np.zeros(len(code), bool)
    order = np.flatnonzero(here)[np.argsort(which[here], kind="stable")]
    cuts = np.searchsorted(which[order], [row["items"].to_numpy(), row["items"].to_numpy() + 1])
    out_item, out_place, out_score = [], [], []
    for item, floor, a, b in zip(row["items"].to_pylist(), row["floors"].to_pylist(), *cuts):
        own = order[a:b]
        total = weight[own] @ matrix[spot[own]]
        best = np.flatnonzero(total >= floor)
        if len(best) > k:
            best = best[np.lexsort((best, -total[best]))[:k]]
        out_item.append(np.full(len(best), item))
        out_place.append(best)
        out_score.append(total[best])
    joined = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(joined(out_item)), ids.take(pa.array(joined(out_place))), pa.array(joined(out_score))],
        ["item_id", "doc_id", "score"],
    )


def search(index: Index, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 of each item."""
    asked = written(_item_terms(items), "asked")
    vocabulary = written(asked.select("term").distinct(), "vocabulary")
    tops = written(
        index.blocks.select("m", F.inline(F.arrays_zip("terms", "tfs", "counts")))
        .withColumnRenamed("terms", "term").join(vocabulary, "term").groupBy("m", "term")
        .agg(F.max("tfs").cast("bigint").alias("top"), F.sum("counts").alias("found")), "tops",
    )
    share = F.lit(float(2 * index.documents + 2)) / (2 * F.col("df") + 1).cast("double")
    weights = tops.groupBy("term").agg(F.sum("found").alias("df")).select(
        "term", F.floor(1000.0 * F.log(share)).cast("bigint").alias("w")
    )
    weighted = written(asked.join(weights, "term"), "weighted")
    # How far down its own order of strata an item's stratum lies, in documents before it.
    down = Window.partitionBy("item_id").orderBy(F.desc("bound"), "m")
    bounds = written(
        weighted.join(tops, "term").groupBy("item_id", "m")
        .agg(F.sum(_impact("w", "top", "m")).alias("bound")).filter("bound > 0")
        .join(index.strata, "m")
        .withColumn("before", F.sum("size").over(down.rowsBetween(Window.unboundedPreceding, -1)))
        .fillna(0, ["before"]), "bounds",
    )
    parts = max(1, -(-asked.select("item_id").distinct().count() // PART))
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts)).alias("part")
    packed = written(
        weighted.groupBy(part).agg(
            F.collect_list(F.struct(F.col("item_id").alias("item"), "term", "w")).alias("terms_asked")
        ), "packed",
    )
    ranked = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best, near, far = None, 0, FIRST
    while near <= index.documents:
        wave = bounds.filter((F.col("before") >= near) & (F.col("before") < far))
        if best is None:
            wave = wave.withColumn("floor", F.lit(1).cast("bigint"))
        else:
            kth = best.filter(F.col("rank") == k).select("item_id", F.col("score").alias("floor"))
            wave = wave.join(kth, "item_id", "left").fillna(1, ["floor"]).filter(
                F.col("bound") >= F.col("floor")
            )
        visits = written(
            wave.groupBy("m", part).agg(F.sort_array(F.collect_list(F.struct("item_id", "floor"))).alias("v"))
            .select("m", "part", F.col("v.item_id").alias("items"), F.col("v.floor").alias("floors")), "visits",
        )
        found = index.blocks.drop("block").join(visits, "m").join(packed, "part").drop("part").mapInArrow(
            _scores(k), "item_id bigint, doc_id bigint, score bigint"
        )
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = written(
            found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k), "best"
        )
        near, far = far, far * GROWTH
    return best.select("item_id", "rank", "doc_id", "score")


def oracle_sql(k: int = TOP) -> str:
    return f"""
WITH terms AS (
    SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
), tf AS (
    SELECT row, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), doc AS (
    SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row
), total AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM doc
), normal AS (
    SELECT row, 50 + (50 * n * docs) // length AS m FROM doc, total
), weight AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, total GROUP BY term
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL
), scored AS (
    SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN normal USING (row) GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id::BIGINT AS item_id, rank, doc_id::BIGINT AS doc_id, score FROM ranked WHERE rank <= {k}
"""
