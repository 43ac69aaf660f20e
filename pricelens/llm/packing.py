"""Packing documents into as few sequences as possible: bin completion, branch and bound.

Documents are tokenized in one pass; longer ones are cut into full pieces, the first
piece being shorter. Full pieces are sequences of their own. How the others are packed
depends only on how many pieces there are of each length, at most ``capacity - 1``
numbers however large the corpus is. The search works on these counts: around the
largest length left it enumerates the undominated fillings, takes one as often as the
counts allow, and prunes where the waste so far shows that the incumbent, first the
best-fit packing, cannot be beaten. Its result is a short list of patterns, each with a
number of copies; pieces find their place by their rank within their length. Ranks are
counted in groups of bounded size and offset by running sums, so a length that holds
most pieces is spread over many tasks.

``NODES`` bounds the search as the problem is NP-hard; the best packing known then is
returned, and the bounds say how far it can be from the optimum. The number of pieces
packed is never bounded.

Fillings are bounded, too, so not all undominated ones are tried: around a piece the list
ends after ``4 * FILLINGS`` found or ``64 * FILLINGS`` steps, with 8 second pieces for each
first; four and more pieces are completed greedily; dominance is tested for up to four
pieces, and ``FILLINGS`` fillings are kept.

Null texts are empty; an empty document is its end token alone; documents of any length
are packed whole; repeated rows (also repeated or null ids) are packed each on its own;
an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import written

NODES = 300
FILLINGS = 64
GROUP = 1_000

Pattern = tuple[tuple[int, ...], int]


@dataclass(frozen=True)
class Plan:
    """Patterns with their number of copies, and the bounds on the number of sequences."""

    patterns: list[Pattern]
    sequences: int
    lower_bound: int


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's bound L2: volume, with lengths that cannot share set apart."""
    total = sum(s * n for s, n in counts.items())
    best = math.ceil(total / capacity)
    for k in sorted({s for s in counts if s <= capacity // 2} | {0}):
        alone = sum(n for s, n in counts.items() if s > capacity - k)
        half = {s: n for s, n in counts.items() if capacity / 2 < s <= capacity - k}
        small = sum(s * n for s, n in counts.items() if k <= s <= capacity / 2)
        room = sum(half.values()) * capacity - sum(s * n for s, n in half.items())
        best = max(best, alone + sum(half.values()) + max(0, math.ceil((small - room) / capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counts: equal pieces are placed many at a time."""
    groups: dict[int, Counter] = {}  # room left: fillings with that room, and how many
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in groups if r >= size), default=None)
            if room is None:
                take = min(capacity // size, left)
                bins = left // take
                groups.setdefault(capacity - take * size, Counter())[(size,) * take] += bins
                left -= take * bins
                continue
            filling, bins = next(iter(groups[room].items()))
            take = min(room // size, left)
            used = min(bins, left // take)
            groups[room][filling] -= used
            if not groups[room][filling]:
                del groups[room][filling]
            if not groups[room]:
                del groups[room]
            groups.setdefault(room - take * size, Counter())[filling + (size,) * take] += used
            left -= take * used
    return [x for fillings in groups.values() for x in fillings.items()]


def _dominated(items: tuple[int, ...], by: tuple[int, ...]) -> bool:
    """Whether ``items`` can be dealt into groups that each fit into one item of ``by``."""
    if not items:
        return True
    return any(
        items[0] <= room and _dominated(items[1:], by[:i] + (room - items[0],) + by[i + 1:])
        for i, room in enumerate(by)
    )


def fillings(room: int, sizes: list[int], counts: dict[int, int], most: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` by up to three pieces, least waste first.

    Longer fillings come about as the same step is taken around the largest of them:
    a filling of three whose rest still has room is completed by best fit.
    """
    fitting = [s for s in sizes if s <= room]
    if not fitting:
        return [()]
    single = fitting[0]
    found = [(single,)]
    if single == room:
        return found
    has = set(fitting)
    steps = 0

    def largest(limit: int, used: tuple[int, ...]) -> int | None:
        while limit > 0:
            if limit in has and counts[limit] > used.count(limit):
                return limit
            limit -= 1
        return None

    for a in fitting:
        if len(found) >= most * 4 or steps > most * 64:
            break
        b = largest(min(a, room - a), (a,))
        if b is None:
            continue
        if a + b > single:
            found.append((a, b))
        tried, second = 0, b
        while second and tried < 8:
            tried, steps = tried + 1, steps + 1
            c = largest(min(second, room - a - second), (a, second))
            if c and a + second + c > single:
                rest, whole = room - a - second - c, (a, second, c)
                while rest and (d := largest(min(c, rest), whole)):
                    whole, rest = (*whole, d), rest - d
                found.append(whole)
            second = largest(second - 1, (a,)) if second > 1 else None
    found = sorted(set(found), key=lambda f: (room - sum(f), len(f), [-x for x in f]))
    kept: list[tuple[int, ...]] = []
    for items in found:
        if len(kept) >= most:
            break
        if not any(len(k) < len(items) and len(items) <= 4 and _dominated(items, k) for k in kept):
            kept.append(items)
    return kept


def pack_counts(counts: dict[int, int], capacity: int, nodes: int = NODES) -> Plan:
    """Patterns for the pieces counted in ``counts`` (length: number, all below capacity)."""
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return Plan([], 0, 0)
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    fewest = sum(n for _, n in best)
    total = sum(s * n for s, n in counts.items())
    visited = 0

    def branches(left: dict[int, int], waste: int):
        """The next (filling, copies) to try, within the waste that still beats the incumbent."""
        sizes = sorted(left, reverse=True)
        size = sizes[0]
        rest = dict(left)
        rest[size] -= 1
        if not rest[size]:
            del rest[size]
        allowed = (fewest - 1) * capacity - total - waste
        for filling in fillings(capacity - size, sorted(rest, reverse=True), rest, FILLINGS):
            pattern = (size, *filling)
            need = Counter(pattern)
            copies = min(left[s] // k for s, k in need.items())
            spare = capacity - sum(pattern)
            if spare:
                copies = min(copies, allowed // spare)
            if copies > 0:
                yield pattern, copies, need, spare

    # Depth first without recursion: a frame is (counts left, waste, bins, iterator, step taken).
    frames = [(counts, 0, 0, branches(counts, 0), None)]
    while frames and visited < nodes and fewest > bound:
        left, waste, bins, tries, _ = frames[-1]
        step = next(tries, None)
        if step is None:
            frames.pop()
            continue
        visited += 1
        pattern, copies, need, spare = step
        after = {s: n - copies * need.get(s, 0) for s, n in left.items()}
        after = {s: n for s, n in after.items() if n}
        taken, lost = bins + copies, waste + copies * spare
        if taken + math.ceil(sum(s * n for s, n in after.items()) / capacity) >= fewest:
            continue
        frames.append((after, lost, taken, branches(after, lost), (pattern, copies)))
        rest = best_fit(after, capacity)  # a new incumbent from here
        if taken + sum(n for _, n in rest) < fewest:
            fewest = taken + sum(n for _, n in rest)
            best = [f[4] for f in frames[1:]] + rest
    return Plan(best, fewest, bound)


def placement_rows(plan: Plan) -> list[tuple[int, int, int, int, int]]:
    """Of each place in each pattern: length, its first and last rank, first sequence, offset."""
    rows, ranks, first = [], Counter(), 0
    for pattern, copies in plan.patterns:
        at = 0
        for size in pattern:
            rows.append((size, ranks[size], ranks[size] + copies - 1, first, at))
            ranks[size] += copies
            at += size
        first += copies
    return rows


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. One pass, no shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        own = tokens.encoder(path)
        for batch in batches:
            rows, out = [], ([], [], [], [])
            for i, text in enumerate(batch.column("text")):
                ids = own.encode(text.as_py()) + end
                length = len(ids) // 4
                start, part = 0, 0
                while start < length:
                    stop = start + ((length - start - 1) % capacity + 1 if not start else capacity)
                    rows.append(i)
                    out[0].append(part)
                    out[1].append(start)
                    out[2].append(stop - start)
                    out[3].append(zlib.crc32(ids[4 * start:4 * stop]))
                    start, part = stop, part + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())),
                 pa.array(out[0], pa.int32()), *(pa.array(x, pa.int64()) for x in out[1:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def dealt(short: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``short`` with a ``_group``: about ``GROUP`` rows of one length each, by a hash of ``_row``."""
    groups = short.sparkSession.createDataFrame(
        [(s, n // GROUP + 1) for s, n in counts.items()], "length bigint, _groups bigint"
    )
    # One row a length: bounded by the capacity, not by the corpus.
    return short.join(F.broadcast(groups), "length").withColumn(
        "_group", F.pmod(F.xxhash64("_row"), "_groups")
    ).drop("_groups")


def pack(cut: DataFrame, capacity: int, nodes: int = NODES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` up to ``capacity``.

    Pieces get a row number as they are written, which deals the pieces of a length out in
    groups of even size, repeated pieces too; a task run again gives the same places. Another
    run may put two pieces of one length in each other's place.
    """
    spark = cut.sparkSession
    cut = written(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    full = cut.filter(F.col("length") >= capacity).withColumns({
        "sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint"),
    })
    full = full.drop("_row")
    short = cut.filter(F.col("length") < capacity)
    counts = {int(r["length"]): r["count"] for r in short.groupBy("length").count().collect()}
    plan = pack_counts(counts, capacity, nodes)
    if not counts:
        return full
    # This list, too, is bounded by the capacity, not by the corpus.
    places = spark.createDataFrame(
        placement_rows(plan),
        "length bigint, _first bigint, _last bigint, _sequence bigint, offset bigint",
    )
    own = ["doc_id", "piece", "start", "ids_crc32"]
    grouped = dealt(short, counts)
    before = grouped.groupBy("length", "_group").count().selectExpr(
        "length", "_group",
        "sum(count) OVER (PARTITION BY length ORDER BY _group) - count AS _before",
    )
    ranked = grouped.selectExpr(
        "*", "row_number() OVER (PARTITION BY length, _group "
             "ORDER BY _row) - 1 AS _at",
    ).join(before, ["length", "_group"]).withColumn("_rank", F.expr("_at + _before"))
    packed = ranked.join(
        F.broadcast(places),
        (ranked["length"] == places["length"])
        & F.col("_rank").between(F.col("_first"), F.col("_last")),
    ).select(
        *own[:3], ranked["length"], "ids_crc32",
        F.expr("_sequence + _rank - _first").alias("sequence_id"), "offset",
    )
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row per piece."""
    packed = pack(pieces(docs, path, capacity, end_id), capacity)
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
