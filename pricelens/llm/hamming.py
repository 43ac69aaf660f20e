"""Exact nearest binary codes by incremental multi-index hashing.

64-bit codes are cut into four segments of 16 bits, each with an index from its value to
the codes that have it. Radius by radius, a query looks up all segment values within that
radius of its own. After radius r every code at a distance up to ``4 * r + 3`` has been
met, as one of its segments then differs in r bits at most; a query is finished when its
k-th verified distance is no larger, which proves its answer exact.

The index lies in blocks by segment and the high byte of its value, a large block in pieces of
about ``PIECE`` codes. Queries go to the blocks within reach in chunks of ``CHUNK``: what is shuffled
is at most 4 * 256 places a query and radius, however many codes there are. Where chunk and piece
meet, the low bytes that occur in the piece are looked up and the codes found are compared at once;
each query gives out the ``k + 1`` nearest ones of the piece at most. A code is taken at the smallest
radius, and there in the first segment, that meets it, so none is given out twice. Once ``k + 1`` codes
are known, the farthest of them bounds a query: no code beyond it is given out, and at a radius only those
segments are looked up without which a code within it could be missed. Equal codes are one entry with the ``k + 1``
smallest ids that have it; no other id of theirs can be in an answer.

Codes compared still grow with queries times rows, as for any exact search of spread codes; they
are never rows of a table.

A row takes part if it has an id and a code. Equal distances rank the smaller id first.
Rows that repeat an id count once for each code; a query never finds its own id. With
fewer than ``k`` others all are returned; an empty table gives an empty table.
"""

from __future__ import annotations

from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SEGMENTS, BITS = 4, 16
#: Of a segment's value, those that name its block.
HIGH = 8
#: Codes in a piece of the index, queries in a chunk, codes compared at once.
PIECE, CHUNK, COMPARED = 16_384, 2_048, 1 << 20


def sign_code(vector: Column, length: int = 64) -> Column:
    """Bit i of the code is set if component i is above zero; null for any other kind of vector."""
    bits = [
        F.when(F.coalesce(F.get(vector, F.lit(i)) > 0, F.lit(False)), F.lit(1 << i if i < 63 else -(1 << 63)))
        .otherwise(F.lit(0)).cast("bigint")
        for i in range(length)
    ]
    code = bits[0]
    for bit in bits[1:]:
        code = code.bitwiseOR(bit)
    return F.when(F.size(vector) == length, code)


class Known(NamedTuple):
    """What tasks are told: the blocks (segment, high byte) that have codes, and the codes a query needs."""

    blocks: np.ndarray
    most: int


def _block(code: Column, s: int) -> Column:
    return F.shiftrightunsigned(code, BITS * (s + 1) - HIGH).bitwiseAND(F.lit((1 << HIGH) - 1)).cast("int")


def _byte(codes: np.ndarray, shift: int) -> np.ndarray:
    return (codes.view(np.uint64) >> np.uint64(shift)).astype(np.uint8)


def nearest_in(q, far, codes, segment: int, radius: int, most: int):
    """Places in q and in codes, and the distance, of the codes of one block that are met at ``radius``.

    For each q at most the ``most`` nearest within its ``far``; of equal ones those that come first in ``codes``.
    """
    low, high = BITS * segment, BITS * segment + BITS - HIGH
    order = np.argsort(own := _byte(codes, low), kind="stable")
    values, start, n = np.unique(own[order], return_index=True, return_counts=True)
    left = radius - np.bitwise_count(_byte(q, high) ^ _byte(codes[:1], high)).astype(np.int16)
    step = max(1, COMPARED // len(codes))
    for at in range(0, len(q), step):
        part, bound = q[at:at + step], far[at:at + step]
        i, j = np.nonzero(np.bitwise_count(_byte(part, low)[:, None] ^ values) == left[at:at + step, None])
        length = n[j]
        i = np.repeat(i, length)
        place = order[np.repeat(start[j] - (np.cumsum(length) - length), length) + np.arange(len(i))]
        differ = part[i] ^ codes[place]
        distance = np.bitwise_count(differ.view(np.uint64))
        within = distance <= bound[i]
        i, place, differ, distance = i[within], place[within], differ[within], distance[within]
        apart = np.bitwise_count(differ.astype("<i8").view("<u2").reshape(-1, SEGMENTS))
        new = (apart.min(axis=1) == radius) & (apart.argmin(axis=1) == segment)
        i, place, distance = i[new], place[new], distance[new]
        by = np.lexsort((place, distance, i))
        i, place, distance = i[by], place[by], distance[by]
        needed = np.arange(len(i)) - np.searchsorted(i, i) < most
        yield at + i[needed], place[needed], distance[needed]


def met_codes(active: DataFrame, index: DataFrame, known: Known, radius: int) -> DataFrame:
    """q, code and distance of the codes that ``active`` (q, far) meets at ``radius``, none farther than ``far``.

    A code within ``4 * radius + s`` that was not met before differs
    in ``radius`` bits in one of the segments 0 to s: later ones are looked up only for a larger ``far``.
    Of the codes met in one piece of ``index`` (segment, block, codes) those that cannot be in an answer are left out.
    """
    byte = np.arange(1 << HIGH, dtype=np.uint8)
    # The rest of the radius must fit into the low byte.
    own = byte[(np.bitwise_count(byte) <= radius) & (np.bitwise_count(byte) >= radius - (BITS - HIGH))]

    def probes(batches):
        for batch in batches:
            every = batch.column("q").to_numpy()
            limits = batch.column("far").fill_null(SEGMENTS * BITS).to_numpy()
            for at in range(0, len(every), CHUNK):
                for s in range(SEGMENTS):
                    asked = limits[at:at + CHUNK] >= SEGMENTS * radius + s
                    q, far = every[at:at + CHUNK][asked], limits[at:at + CHUNK][asked]
                    blocks = _byte(q, BITS * (s + 1) - HIGH)[:, None] ^ own
                    i, j = np.nonzero(known.blocks[s][blocks])
                    block = blocks[i, j]
                    i = i[np.argsort(block, kind="stable")]
                    n = np.bincount(block, minlength=1 << HIGH)
                    ends = pa.array(np.append(0, np.cumsum(n[n > 0])), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ends) - 1, s), pa.int32()), pa.array(np.flatnonzero(n), pa.int32()),
                         pa.ListArray.from_arrays(ends, pa.array(q[i], pa.int64())),
                         pa.ListArray.from_arrays(ends, pa.array(far[i], pa.int32()))],
                        ["segment", "block", "q", "far"],
                    )

    def compared(batches):
        names = ["q", "code", "distance"]
        for batch in batches:
            found, rows = [], 0
            for s, *lists in zip(*(batch.column(c) for c in ("segment", "q", "far", "codes"))):
                q, far, codes = (x.values.to_numpy() for x in lists)
                for i, place, distance in nearest_in(q, far, codes, s.as_py(), radius, known.most):
                    found.append((q[i], codes[place], distance.astype(np.int32)))
                    rows += len(i)
                    if rows >= COMPARED:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names)
                        found, rows = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names)

    chunks = max(1, ceil(active.count() / CHUNK))
    # The planner takes the probes for as few as the queries: neither side may be broadcast.
    return (
        active.repartition(chunks).mapInArrow(probes, "segment int, block int, q array<bigint>, far array<int>")
        .hint("merge").join(index.hint("merge"), ["segment", "block"])
        .mapInArrow(compared, "q bigint, code bigint, distance int")
    )


def nearest_codes(codes: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, distance of every row of ``codes`` (id, code) for which ``queries`` holds."""
    rows = written(codes.select("id", "code").filter("id IS NOT NULL AND code IS NOT NULL").distinct(), "codes")
    smallest = Window.partitionBy("code").orderBy("id")
    ids = written(
        rows.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= k + 1)
        .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "code-ids",
    )
    entries = ids.select(
        "code", F.col("ids")[0].alias("first"),
        F.inline(F.array(*[
            F.struct(F.lit(s).alias("segment"), _block(F.col("code"), s).alias("block")) for s in range(SEGMENTS)
        ])),
    )
    blocks = written(entries.groupBy("segment", "block").agg(F.count("*").alias("n")), "blocks")
    index = written(
        entries.join(F.broadcast(blocks), ["segment", "block"])  # 4 * 256 rows at most
        .groupBy("segment", "block", F.pmod(F.xxhash64("code"), F.ceil(F.col("n") / PIECE)).alias("piece"))
        .agg(F.sort_array(F.collect_list(F.struct("first", "code")))["code"].alias("codes"))
        .select("segment", "block", "codes"), "segments",
    )
    occurs = np.zeros((SEGMENTS, 1 << HIGH), bool)
    met = blocks.toArrow()
    occurs[met.column("segment").to_numpy(), met.column("block").to_numpy()] = True
    known = Known(occurs, k + 1)
    nearer = Window.partitionBy("q").orderBy("distance")

    def nearest_of(pairs: DataFrame) -> DataFrame:
        """Codes that can be in an answer: of those farther than the k + 1 nearest ones none can."""
        ranked = pairs.withColumn("_n", F.rank().over(nearer))
        return ranked.filter(F.col("_n") <= k + 1).drop("_n")

    active = written(
        rows.filter(queries).select(F.col("code").alias("q")).distinct().withColumn("far", F.lit(None).cast("int")),
        "asked",
    )
    best = None
    for radius in range(BITS + 1):
        if active.isEmpty():
            break

        pairs = met_codes(active, index, known, radius)
        met = nearest_of(pairs).join(ids, "code").select("q", "distance", F.explode("ids").alias("id"))
        if best is not None:
            met = met.unionByName(best.join(active, "q", "left_semi"))
        order = Window.partitionBy("q").orderBy("distance", "id")
        # Of k + 1 ids one may be the query's own.
        ranked = written(
            met.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1).drop("_n"), "met"
        )
        reached = ranked.groupBy("q").agg(F.count("*").alias("n"), F.max("distance").alias("far"))
        covered = SEGMENTS * (radius + 1) - 1
        done = reached.filter((F.col("n") > k) & (F.col("far") <= covered)) if radius < BITS else reached
        finished = ranked.join(done, "q", "left_semi")
        answers = finished if radius == 0 else answers.unionByName(finished)  # noqa: F821
        bounds = reached.select("q", F.when(F.col("n") > k, F.col("far")).cast("int").alias("far"))
        left = active.select("q").join(done, "q", "left_anti").join(bounds, "q", "left")
        active, best = written(left, "active"), ranked
    if best is None:
        return rows.selectExpr("id AS query_id", "1 AS rank", "id AS vec_id", "0 AS distance").limit(0)
    per_query = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (
        rows.filter(queries).select(F.col("id").alias("query_id"), F.col("code").alias("q"))
        .join(answers, "q").filter("query_id <> id")
        .select("query_id", F.col("id").alias("vec_id"), "distance")
        .withColumn("rank", F.row_number().over(per_query)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "distance")
    )
