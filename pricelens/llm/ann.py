"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, each quantised by its own codebook, so ``CENTROIDS``
centroids a half make ``CENTROIDS ** 2`` cells. A query visits pairs of centroids in the
order of their summed distance, taken from a heap, until their cells hold ``SHARE`` of all
vectors (``LEAST`` at least); these are ranked by their exact distance. The codebooks are
fitted on a bounded sample (``SAMPLE`` rows by hash); every usable row is indexed.

Cells are dealt out in blocks of bounded size, each compared as one matrix with the
queries that visit the cell, so a common vector or a full cell is many tasks' work. Of
equal vectors, only the ``k + 1`` rows of smallest ids can be among a query's nearest; the
others are left out before blocks are built, which changes no answer.

A row takes part if it has an id and its vector is not null, not all zero, of finite
numbers throughout, and of the length most vectors have. Equal distances rank the smaller
id first. Every row is a candidate but the query's own row: of rows that repeat an id each is
found by the others, and each asks where ``queries`` holds. With fewer than ``k`` other vectors all are returned; an empty table gives an empty
table; further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CENTROIDS = 32
SAMPLE = 20_000
SHARE = 0.55
LEAST = 2_000
BLOCK = 1_000
ROUNDS = 15


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Columns ``id``, ``v`` (doubles) and ``row`` (a key of its own) of the rows that take part."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("v"),
        F.monotonically_increasing_id().alias("row"),
    ).filter(F.col("id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (common["n"] if common else 0))


def codebook(points: np.ndarray, size: int) -> np.ndarray:
    """Centroids by Lloyd's algorithm, from a spread start."""
    rng = np.random.default_rng(0)
    points = np.unique(points, axis=0)
    if len(points) <= size:
        return points
    chosen = [points[rng.integers(len(points))]]
    nearest = ((points - chosen[0]) ** 2).sum(1)
    while len(chosen) < size:
        chosen.append(points[rng.choice(len(points), p=nearest / nearest.sum())])
        nearest = np.minimum(nearest, ((points - chosen[-1]) ** 2).sum(1))
    centroids = np.array(chosen)
    for _ in range(ROUNDS):
        own = _distances(points, centroids).argmin(1)
        counts = np.bincount(own, minlength=size)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
        if np.allclose(moved, centroids):
            break
        centroids = moved
    return centroids


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (centroids**2).sum(1)[None, :]
    return square - 2 * points @ centroids.T


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of summed distance until they hold ``wanted`` vectors."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, cells, held = [(first[a[0]] + second[b[0]], 0, 0)], [], 0
    seen = {(0, 0)}
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return cells


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id_column: str = "vec_id",
            vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row for which ``queries`` holds.

    ``queries`` is a condition on the column ``id``.
    """
    rows = written(usable(vectors, id_column, vector_column), "vectors")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    if not sample.num_rows:  # no usable row
        return rows.selectExpr("id AS query_id", "1 AS rank", "id AS vec_id", "0D AS score").limit(0)
    points = sample.column("v").combine_chunks().flatten().to_numpy().reshape(sample.num_rows, -1)
    width, half = points.shape[1], max(1, points.shape[1] // 2)
    books = codebook(points[:, :half], CENTROIDS), codebook(points[:, half:], CENTROIDS)

    def halves(batch):
        v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return _distances(v[:, :half], books[0]), _distances(v[:, half:], books[1])

    def with_cell(batches):
        for batch in batches:
            first, second = halves(batch)
            cells = first.argmin(1) * len(books[1]) + second.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.int32())], ["id", "v", "row", "cell"]
            )

    # Of equal vectors, those with the smallest ids.
    same = Window.partitionBy("v").orderBy("id", "row")
    kept = rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1).drop("_n")
    index = written(kept.mapInArrow(with_cell, "id bigint, v array<double>, row bigint, cell int"), "index")
    counts = {r["cell"]: r["count"] for r in index.groupBy("cell").count().collect()}  # CENTROIDS^2 at most
    sizes = np.zeros(len(books[0]) * len(books[1]), np.int64)
    for cell, n in counts.items():
        sizes[cell] = n
    wanted = max(LEAST, int(SHARE * sizes.sum()))

    def visits(batches):
        for batch in batches:
            first, second = halves(batch)
            cells = [traverse(a, b, sizes, wanted) for a, b in zip(first, second)]
            at = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
            yield pa.RecordBatch.from_arrays(
                [*(column.take(pa.array(at)) for column in batch.columns),
                 pa.array([c for own in cells for c in own], pa.int32())],
                ["id", "v", "row", "cell"],
            )

    def blocks(df: DataFrame, parts: Column, name: str) -> DataFrame:
        """Bounded lists of the rows of each cell."""
        dealt = df.withColumn("_part", F.pmod(F.xxhash64("row"), parts))
        return dealt.groupBy("cell", "_part").agg(
            F.collect_list(F.struct("id", "row", "v")).alias(name)).drop("_part")

    asked = written(rows.filter(queries), "asked")
    # The number of parts of each cell: a list of CENTROIDS^2 rows at most, as a literal.
    part_counts = F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, n // BLOCK + 1)])
    asked_blocks = blocks(
        asked.mapInArrow(visits, "id bigint, v array<double>, row bigint, cell int"),
        F.lit(asked.count() // BLOCK + 1), "q",
    )
    index_blocks = blocks(index, part_counts[F.col("cell")], "c")

    def compared(batches):
        for batch in batches:
            out = ([], [], [], [])
            for q, c in zip(batch.column("q"), batch.column("c")):
                q_ids = q.values.field("id").to_numpy(zero_copy_only=False)
                c_ids = c.values.field("id").to_numpy(zero_copy_only=False)
                q_rows = q.values.field("row").to_numpy(zero_copy_only=False)
                c_rows = c.values.field("row").to_numpy(zero_copy_only=False)
                q_v = q.values.field("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                c_v = c.values.field("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                for one, row, v in zip(q_ids, q_rows, q_v):
                    far = np.sqrt(((c_v - v) ** 2).sum(1))
                    at = np.flatnonzero(c_rows != row)
                    if len(at) > k:
                        at = at[far[at] <= np.partition(far[at], k - 1)[k - 1]]
                    at = at[np.lexsort((c_ids[at], far[at]))][:k]
                    out[0].append(np.full(len(at), one))
                    out[1].append(c_ids[at])
                    out[2].append(far[at])
                    out[3].append(np.full(len(at), row))
            arrays = [np.concatenate(x) if x else np.zeros(0) for x in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(arrays[0].astype(np.int64)), pa.array(arrays[1].astype(np.int64)),
                 pa.array(arrays[2].astype(np.float64)), pa.array(arrays[3].astype(np.int64))],
                ["query_id", "vec_id", "score", "row"],
            )

    # Both sides grow with the table: neither is broadcast.
    found = asked_blocks.hint("merge").join(index_blocks, "cell").select("q", "c").mapInArrow(
        compared, "query_id bigint, vec_id bigint, score double, row bigint"
    )
    by_distance = Window.partitionBy("row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(by_distance)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
