"""SimHash near-duplicates, found by anchor-point covering.

A 64-bit fingerprint is cut into two parts of 23 bits and one of 18. With at most four
differing bits one of these holds: at most one in the first part, at most one in the
second, none in the third. The anchors of a 23-bit part are the 4096 words of the binary
Golay code, a perfect covering code of radius 3: every value lies within 3 of exactly
one anchor, so with a threshold of 1 each fingerprint is sent to every anchor within 4
(six at most), found by a table over syndromes. Two values that differ in one bit
then meet at the anchor that covers either. The anchors of the last part are all its
values, radius and threshold 0. Fingerprints are compared within each anchor, on all 64
bits, so no link is lost and none is false.

Exact copies share a fingerprint and are merged before anything is sent; an anchor with
more than ``BLOCK`` fingerprints is cut into blocks, and pairs of blocks are compared in
tasks of their own. A block returns a spanning forest of its links, never all its pairs;
components of the forests are found by star contraction.

The number of comparisons at an anchor grows with the square of its fingerprints: about
0.003 n^2 in all, of one machine instruction each, for n different fingerprints.

Null and empty texts have no shingles: fingerprint zero, linked like any other.
Texts of fewer than four words are one shingle; texts of any length are read whole.
Repeated rows each get a row; a null id never names a component unless all its ids are
null; an empty table gives an empty table; further columns are left alone.
"""

from __future__ import annotations

from functools import cache
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import unused, written
from .components import components

WORDS = 4
SEED = 42
THRESHOLD = 4
BLOCK = 2_048
#: Generator polynomial of the binary Golay code of length 23 (fixed).
GOLAY = 0b110001110101


def fingerprint(text: str | None) -> int:
    """SimHash over word shingles, repeats included: a bit is set if over half the hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(accumulate(map(len, words), lambda end, n: end + n + 1))
    starts = [0, *(e + 1 for e in ends)]
    if len(words) <= WORDS:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1:])]
    values = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 4096):
        part = values[at:at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(values), bitorder="little")
    return int(bits.view(np.uint64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    """Fingerprints as signed 64-bit integers."""
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def _syndrome(values: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit value by the generator polynomial."""
    values = values.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        values ^= np.where(values >> bit & 1, GOLAY << (bit - 11), 0)
    return values


@cache
def _shifts() -> np.ndarray:
    """For each of 2048 syndromes the error patterns of weight 4 or less with it, padded by -1."""
    errors = np.array(
        [sum(1 << b for b in bits) for n in range(5) for bits in combinations(range(23), n)], np.int64
    )
    found = [errors[_syndrome(errors) == s] for s in range(2048)]
    table = np.full((2048, max(map(len, found))), -1, np.int64)
    for s, own in enumerate(found):
        table[s, :len(own)] = own
    return table


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every fingerprint's anchors: index into ``values``, part (0 to 2), anchor."""
    index, part, anchor = [], [], []
    table = _shifts()
    for p, low in enumerate((0, 23)):
        own = (values >> np.uint64(low) & np.uint64((1 << 23) - 1)).astype(np.int64)
        shifts = table[_syndrome(own)]
        rows, places = np.nonzero(shifts >= 0)
        index.append(rows)
        part.append(np.full(len(rows), p))
        anchor.append(own[rows] ^ shifts[rows, places])
    index.append(np.arange(len(values)))
    part.append(np.full(len(values), 2))
    anchor.append((values >> np.uint64(46)).astype(np.int64))
    return np.concatenate(index), np.concatenate(part), np.concatenate(anchor)


def forest(left: np.ndarray, right: np.ndarray | None) -> list[tuple[int, int]]:
    """Edges that connect all that links connect, within ``left`` or between two blocks."""
    values = left if right is None else np.concatenate((left, right))
    n = len(values)
    if n <= 64:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= THRESHOLD
        if near.sum() == n:
            return []
    # Breadth first; each fingerprint is compared with those not reached yet.
    edges, waiting = [], np.arange(n)
    while len(waiting):
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            at = front.pop()
            linked = np.bitwise_count(values[waiting] ^ values[at]) <= THRESHOLD
            if linked.any():
                edges.extend((at, b) for b in waiting[linked])
                front.extend(waiting[linked])
                waiting = waiting[~linked]
    return edges


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` between fingerprints (column ``fp``, all different) that connect what links do."""

    def sent(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            index, part, anchor = anchors(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(anchor, pa.int64()),
                 pa.array(values.view(np.int64)[index], pa.int64())],
                ["part", "anchor", "fp"],
            )

    def compared(batches):
        for batch in batches:
            left, right = [], []
            for a, b in zip(batch.column("own"), batch.column("other")):
                own = np.array(a.as_py() or [], np.int64)
                other = np.array(b.as_py() or [], np.int64)
                values = np.concatenate((own, other))
                for x, y in forest(values.view(np.uint64), None):
                    left.append(int(values[x]))
                    right.append(int(values[y]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"]
            )

    at = written(distinct.select("fp").mapInArrow(sent, "part int, anchor bigint, fp bigint"), "anchors")
    # There are at most 2 * 4096 + 262144 anchors, whatever the corpus is.
    sizes = at.groupBy("part", "anchor").count().filter("count > 1").withColumn(
        "blocks", F.ceil(F.col("count") / block).cast("int")
    ).drop("count")
    # Row i goes to the block pairs (i, j) and (j, i): as the first's own or the second's other.
    dealt = (
        at.join(sizes, ["part", "anchor"])
        .withColumn("i", F.pmod(F.xxhash64("fp", "anchor"), "blocks").cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .selectExpr("part", "anchor", "least(i, j) AS i", "greatest(i, j) AS j", "i > j AS second", "fp")
    )
    blocks = dealt.groupBy("part", "anchor", "i", "j").agg(
        F.collect_list(F.when(~F.col("second"), F.col("fp"))).alias("own"),
        F.collect_list(F.when(F.col("second"), F.col("fp"))).alias("other"),
    ).filter("size(own) + size(other) > 1")
    return blocks.select("own", "other").mapInArrow(compared, "a bigint, b bigint")


def groups(prints: DataFrame) -> DataFrame:
    """Of every fingerprint in ``prints`` (doc_id, fp): ``root``, the same for all that are linked, and
    ``component_id``, the smallest id reachable."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("_first")), "fingerprints")
    roots = components(links(distinct), "a", "b").withColumnRenamed("node", "fp")
    rooted = written(
        distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots"
    )
    named = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    return rooted.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, fingerprint as 16 hex digits, component_id."""
    prints = written(docs.select("doc_id", fingerprints("text").alias("fp")), "prints")
    return prints.join(groups(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component stays, that with the smallest id, with all its columns."""
    fp, row = unused(docs, "_fp"), unused(docs, "_row")
    marked = written(
        docs.select("*", fingerprints("text").alias(fp), F.monotonically_increasing_id().alias(row)),
        "marked",
    )
    prints = marked.select("doc_id", F.col(fp).alias("fp"), F.col(row).alias("_row"))
    kept = (
        prints.join(groups(prints), "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_row")).alias("m"))
        .select(F.col("m._row").alias(row))
    )
    return marked.join(kept, row, "left_semi").select(*docs.columns)
