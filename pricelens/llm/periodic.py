"""Runs of repeating words, by tiles of each period octave.

A run is a stretch of consecutive words with smallest period q, at least ``max(12, 2 * q)``
words long, that no neighbouring word extends keeping the period.

*Tiles.* Periods are taken an octave at a time: 1 to 7, 8 to 15, 16 to 31, and so on. For the octave
below ``hi`` a text has a boundary every ``hi`` words; a run of such a period is so long that it holds
one. A tile is a stretch of ``max(CORE, hi)`` words with its boundaries and ``2 * hi`` words on
either side. Tiles are rows dealt out to all tasks, so a long text is worked on in many.

*Boundary Z-functions.* With the words left of a boundary u and right of it v, the Z-functions of v
(against itself and against the words before it) and of u backwards tell for each period q how far
words q apart stay equal to the right and to the left of the boundary. Where both together
reach q, a stretch of period q lies across it. Its root is v's or u's end of q words, and the same
Z-function tells whether that is a power of a shorter word; then q is not the smallest period.

*Stitching.* What a boundary sees of a run is at least ``2 * q`` words, and neighbouring boundaries
of one run see at least q words in common; different runs of one period never share q. So stretches of
one document and period are one run exactly if they share q words. They are shuffled by both.

*Which tiles.* A stretch of period q has runs of six words that come again q words later. A tile is
left out if too few of its six-word windows come again within ``hi`` words, or if all of it has a
period below its octave: neither can hold a run (windows are compared by a hash, which can only add tiles).

Null and empty texts have no words and no run. Texts of any length are read whole; rows that repeat
are worked on one by one, each gives a row; a null id is kept; an empty table gives an empty
table; further columns are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHORTEST = 12
CORE = 1_024
#: The longest window that every run has twice: ``max(12, 2 * q) - q`` is never below 6.
GRAM = 6
BASE = 8

READ = (
    "row bigint, doc_id bigint, n_words bigint, words string, ids array<int>, "
    "tiles array<struct<octave: int, tile: int>>"
)
TILE = "row bigint, octave int, tile int, at int, ids array<int>"
FRAGMENT = "row bigint, period bigint, start bigint, stop bigint"
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def octave(number: int) -> tuple[int, int]:
    """Smallest period of an octave, and the smallest beyond it."""
    return (BASE << number - 1, BASE << number) if number else (1, BASE)


def _window(number: int, tile: int, n: int) -> tuple[int, int]:
    """The words a tile holds."""
    hi = octave(number)[1]
    core = max(CORE, hi)
    return max(0, tile * core - 2 * hi), min(n, (tile + 1) * core + 2 * hi)


def _gaps(ids: np.ndarray) -> np.ndarray:
    """How far on each window of ``GRAM`` words comes next; a length beyond the text if never."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    count = len(ids) - GRAM + 1
    hashed = np.zeros(count, np.uint64)
    for j in range(GRAM):
        hashed = hashed * np.uint64(0xBF58476D1CE4E5B9) + mixed[j:j + count]
    order = np.argsort(hashed, kind="stable")
    same = np.flatnonzero(hashed[order[1:]] == hashed[order[:-1]])
    gaps = np.full(count, len(ids) + 1)
    gaps[order[same]] = order[same + 1] - order[same]
    return gaps


def tiles(ids: np.ndarray) -> list[tuple[int, int]]:
    """Octave and number of the tiles that may hold a run."""
    n, out = len(ids), []
    if n < SHORTEST:
        return out
    gaps = _gaps(ids)
    if gaps.min() > n // 2:
        return out
    number = 0
    while octave(number)[0] <= n // 2:
        lo, hi = octave(number)
        seen = np.concatenate(([0], np.cumsum(gaps < hi)))
        if seen[-1]:
            for tile in range(-(-n // max(CORE, hi))):
                a, b = _window(number, tile, n)
                end = max(a, min(b, len(gaps)))
                if a >= len(gaps) or seen[end] - seen[a] < max(1, lo - GRAM + 1):
                    continue
                d = gaps[a]
                if d < lo and np.array_equal(ids[a + d:b], ids[a:b - d]):
                    continue
                out.append((number, tile))
        number += 1
    return out


def z_function(words: list, upto: int) -> list[int]:
    """For each place below ``upto`` how many words from there on equal the first ones."""
    n, out, left, right = len(words), [0] * upto, 0, 0
    for i in range(1, upto):
        k = 0
        if i < right:
            k = out[i - left]
            if k < right - i:
                out[i] = k
                continue
            k = right - i
        while i + k < n and words[k] == words[i + k]:
            k += 1
        if k:
            out[i], left, right = k, i, i + k
    return out


@cache
def _proper(q: int) -> tuple[int, ...]:
    """The largest proper divisors of q, one for each prime factor."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    if rest > 1:
        out.append(q // rest)
    return tuple(out)


def across(words: list[int], c: int, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """Period, start and end of the stretches at the boundary before word ``c``, of periods from ``lo`` below ``hi``."""
    after, before = words[c:c + 2 * hi], words[max(0, c - 2 * hi):c][::-1]
    ahead, back = min(hi, len(words) - c), min(hi, c)
    # -1 is no word: nothing matches across it.
    right = z_function([*after, -1, *words[c - back:c + 2 * hi]], len(after) + 1 + back)
    left = z_function([*before, -1, *words[max(0, c - 2 * hi):c + ahead][::-1]], len(before) + 1 + ahead)
    out = []
    for own, other, far, forward in ((right, left, ahead, True), (left, right, back, False)):
        size, match = (len(after), len(before) + 1) if forward else (len(before), len(after) + 1)
        own = own[:size] + [0]
        for q in range(lo, min(hi - 1, far, size) + 1):
            on, against = own[q], other[match + far - q]
            if on + against >= q and not any(own[d] >= q - d for d in _proper(q)):
                out.append((q, c - against, c + q + on) if forward else (q, c - q - on, c + against))
    return out


def stitched(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Stretches that share a period's words become one."""
    out: list[tuple[int, int, int]] = []
    for q, start, stop in sorted(found):
        if out and out[-1][0] == q and start <= out[-1][2] - q:
            out[-1] = (q, out[-1][1], max(stop, out[-1][2]))
        else:
            out.append((q, start, stop))
    return out


def _read(batches):
    """Words, their numbers and the tiles to solve, for each text."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            # Bytes split at exactly the six white-space characters of ASCII.
            split = [t.split() if t else [] for t in part.column("text").cast(pa.binary()).to_pylist()]
            flat = pa.array([w for own in split for w in own], pa.binary()).dictionary_encode()
            numbers, ends = flat.indices.to_numpy(), np.cumsum([0, *map(len, split)])
            ids, cut = [], []
            for a, b in zip(ends, ends[1:]):
                own = tiles(numbers[a:b])
                ids.append(numbers[a:b] if own else None)
                cut.append([{"octave": o, "tile": t} for o, t in own] if own else None)
            kind = pa.list_(pa.struct([("octave", pa.int32()), ("tile", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)),
                 pa.array([b" ".join(own) for own in split], pa.binary()).cast(pa.string()),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(cut, kind)],
                ["row", "doc_id", "n_words", "words", "ids", "tiles"],
            )


def _cut(batches):
    """One row a tile, with its words."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column("ids")[i].values.to_numpy()
            own = batch.column("tiles")[i].as_py()
            # A batch holds about a million words, whatever the length of the text.
            step = max(1, 1_000_000 // (len(ids) + 1))
            for at in range(0, len(own), step):
                part = own[at:at + step]
                spans = [_window(t["octave"], t["tile"], len(ids)) for t in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("row")[i].as_py()] * len(part), pa.int64()),
                     pa.array([t["octave"] for t in part], pa.int32()),
                     pa.array([t["tile"] for t in part], pa.int32()),
                     pa.array([a for a, _ in spans], pa.int32()),
                     pa.array([ids[a:b] for a, b in spans], pa.list_(pa.int32()))],
                    ["row", "octave", "tile", "at", "ids"],
                )


def solve(ids: list[int], at: int, number: int, tile: int) -> list[tuple[int, int, int]]:
    """Period, start and end in the document of the stretches that a tile's boundaries see."""
    lo, hi = octave(number)
    core = max(CORE, hi)
    found = []
    for c in range(tile * core - at, min(len(ids), (tile + 1) * core - at), hi):
        found += across(ids, c, lo, hi)
    return [(q, at + a, at + b) for q, a, b in stitched(found)]


def _solved(batches):
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            row, number, tile, at = (batch.column(c)[i].as_py() for c in ("row", "octave", "tile", "at"))
            ids = batch.column("ids")[i].values.to_pylist()
            out += [(row, *f) for f in solve(ids, at, number, tile)]
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["row", "period", "start", "stop"]
        )


def _collapsed(batches):
    """Words without the repeats of their runs."""
    for batch in batches:
        out = []
        runs = batch.column("runs").to_pylist()
        for text, own in zip(batch.column("words").cast(pa.binary()).to_pylist(), runs):
            if own:
                words = text.split()
                change = np.zeros(len(words) + 1, np.int64)
                for r in own:
                    change[r["start"] + r["period"]] += 1
                    change[r["start"] + r["length"]] -= 1
                text = b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])
            out.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), batch.column("runs"),
             pa.array(out, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"],
        )


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length and period, by start and period) and the collapsed text of each row.

    The collapsed text is the words, joined by one space, without those that a run
    holds after its first period.
    """
    spark = docs.sparkSession
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    read = written(numbered.mapInArrow(_read, READ), "words")
    doubtful = read.filter("tiles IS NOT NULL")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = doubtful.select("row", "ids", "tiles").mapInArrow(_cut, TILE).repartition(tasks, "row", "octave", "tile")
    fragments = written(dealt.mapInArrow(_solved, FRAGMENT), "fragments")

    order = Window.partitionBy("row", "period").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce((F.col("start") > reach - F.col("period")).cast("int"), F.lit(1))
    runs = (
        fragments.withColumn("_apart", apart).withColumn("_run", F.sum("_apart").over(order))
        .groupBy("row", "period", "_run")
        .agg(F.min("start").alias("start"), (F.max("stop") - F.min("start")).alias("length"))
        .filter((F.col("length") >= SHORTEST) & (F.col("length") >= 2 * F.col("period")))
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("r"))
        .select("row", F.transform("r", lambda r: F.struct(r["start"], r["length"], r["period"])).cast(RUNS).alias("runs"))
    )
    with_runs = doubtful.select("row", "doc_id", "n_words", "words").join(written(runs, "runs"), "row", "left")
    none = F.from_json(F.lit("[]"), RUNS)
    schema = f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string"
    return with_runs.withColumn("runs", F.coalesce("runs", none)).drop("row").mapInArrow(_collapsed, schema).unionByName(
        read.filter("tiles IS NULL").select("doc_id", "n_words", none.alias("runs"), F.col("words").alias("collapsed"))
    )
