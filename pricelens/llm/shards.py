"""Token shards in training order, placed by a keyed Feistel permutation.

Documents are tokenized and cut into sequences of ``length`` tokens. Every sequence has an
index: its row's number times the most sequences any row can have, plus its own number in
the row. A row's number is its place in its file after all files before it, so it does
not depend on how Spark splits the scan. A Feistel network keyed by ``key`` permutes the indices;
cycle-walking (permuting again until the value is below the number of indices) makes it a
permutation of exactly those. The order of the permuted indices is the training order,
and a sequence's rank in it its global slot.

Permuted indices are spread evenly, so cutting them into equal ranges deals the sequences
out evenly whatever the corpus holds; each range is one task and one shard file. A shard
is a plain file of records of one fixed size, so the n-th sequence is found by
multiplication and a reader can resume at any slot. Texts are tokenized once and tokens
shuffled once. Records are written by Spark's own file writer and its commit
protocol: a record is a line whose length is known, and readers never look for line ends.

A record holds: id (8 bytes), flags (1 if the id is null, 4 bytes), number of the sequence
in its row (4), number of tokens (4), tokens (2 bytes each, zero-padded), three zero bytes
and a line end; all numbers are little-endian.

Null and empty texts have no tokens and no sequence; texts of any length are written whole; repeated
rows and ids are sequences of their own; an empty table gives no shard; further columns
are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens

LENGTH = 256
SHARD_BYTES = 16 << 20
ROUNDS = 4
HEADER = 20
MASK = (1 << 64) - 1


def sliced(batch: pa.RecordBatch, rows: int = 500):
    """A batch in parts, so that what is made of it stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def stride(length: int) -> int:
    return HEADER + 2 * length + 4


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    """A keyed hash of 64-bit numbers (the finaliser of SplitMix64)."""
    x = values + np.uint64(key & MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, domain: int, key: int) -> np.ndarray:
    """Each index's image under a permutation of ``range(domain)``."""
    half = max(1, ((domain - 1).bit_length() + 1) // 2)
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & low
        for n in range(ROUNDS):
            left, right = right, left ^ (_mixed(right, key + 0x9E3779B97F4A7C15 * (n + 1)) & low)
        return left << shift | right

    out = network(index.astype(np.uint64))
    outside = np.flatnonzero(out >= domain)
    while len(outside):
        out[outside] = network(out[outside])
        outside = outside[out[outside] >= domain]
    return out.astype(np.int64)


def write_shards(docs: DataFrame, path: str, vocabulary: str, key: int, length: int = LENGTH,
                 shard_bytes: int = SHARD_BYTES) -> None:
    """Write the shards of ``docs``, a table read from files, under ``path``."""
    spark = docs.sparkSession
    placed = docs.select(
        "doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    files = placed.groupBy("file").agg(
        F.max("row").alias("last"), F.max(size).alias("longest"), F.sum(size).alias("bytes")
    ).orderBy("file").collect()  # one row per input file
    most = max((r["longest"] for r in files), default=0) // length + 1  # a token has a byte at least
    first, rows = {}, 0
    for r in files:
        first[r["file"]] = rows
        rows += r["last"] + 1
    domain = max(1, rows * most)
    shards = max(1, -(-sum(r["bytes"] for r in files) // shard_bytes))
    wide = -(-domain // shards)  # indices a shard

    def cut(batches):
        own = tokens.encoder(vocabulary)
        for batch in (part for whole in batches for part in sliced(whole)):
            pieces, counts = [], []
            for text in batch.column("text"):
                ids = np.frombuffer(own.encode(text.as_py()), "<u4").astype("<u2").tobytes()
                cuts = range(0, len(ids), 2 * length)
                pieces += [ids[c:c + 2 * length] for c in cuts]
                counts.append(len(cuts))
            rows = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = np.array([first[f] for f in batch.column("file").to_pylist()], np.int64)
            number = start + batch.column("row").to_numpy()
            place = permuted(number[rows] * most + piece, domain, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array((place // wide).astype(np.int32)), pa.array(place),
                 batch.column("doc_id").cast(pa.int64()).take(pa.array(rows)),
                 pa.array(piece.astype(np.int32)), pa.array(pieces, pa.binary())],
                ["shard", "place", "doc_id", "piece", "tokens"],
            )

    def records(batches):
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "piece", "tokens"))
            for doc, piece, ids in zip(*columns):
                head = struct.pack("<qiii", doc or 0, doc is None, piece, len(ids) // 2)
                out.append((head + ids).ljust(stride(length) - 1, b"\0"))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    sequences = placed.mapInArrow(cut, "shard int, place bigint, doc_id bigint, piece int, tokens binary")
    dealt = sequences.repartitionById(shards, F.col("shard")).sortWithinPartitions("place")
    lines = dealt.mapInArrow(records, "record binary").select(F.col("record").cast("string"))
    lines.write.option("lineSep", "\n").option("compression", "none").text(path)


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, first: int = 0) -> DataFrame:
    """Sequences from global slot ``first`` on: slot, shard, offset, doc_id, piece, length, tokens.

    Only shards that hold wanted slots are read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    sizes = sorted((r["path"], r["length"]) for r in files.select("path", "length").collect() if r["length"])
    wide, shards, slot = stride(length), {}, 0
    for number, (name, size) in enumerate(sizes):
        shards[name] = (number, slot)
        slot += size // wide
    wanted = [n for n, size in sizes if shards[n][1] + size // wide > first]
    if not wanted:
        wanted = [""]

    def parsed(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                number, start = shards[name]
                view = np.frombuffer(content.as_buffer(), np.uint8)
                for at in range(max(0, first - start), len(view) // wide, 4096):
                    rows = view[at * wide:(at + 4096) * wide].reshape(-1, wide)
                    ids = rows[:, :8].copy().view("<i8")[:, 0]
                    head = rows[:, 8:HEADER].copy().view("<i4")
                    slots = start + at + np.arange(len(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slots), pa.array(np.full(len(rows), number), pa.int32()),
                         pa.array((slots - start) * wide),
                         pa.array(ids, mask=head[:, 0] == 1), pa.array(head[:, 1]), pa.array(head[:, 2]),
                         pa.array([r[HEADER:HEADER + 2 * n].tobytes() for r, n in zip(rows, head[:, 2])],
                                  pa.binary())],
                        ["slot", "shard", "offset", "doc_id", "piece", "length", "tokens"],
                    )

    return files.filter(F.col("path").isin(wanted)).select("path", "content").mapInArrow(
        parsed,
        "slot bigint, shard int, offset bigint, doc_id bigint, piece int, length int, tokens binary",
    )


def digests(sequences: DataFrame) -> DataFrame:
    """The sequences with a checksum in place of their tokens."""
    return sequences.withColumn("tokens_crc32", F.crc32("tokens")).drop("tokens")
