"""Repeated byte strings, found by suffix arrays over shards.

1. Anchors of all 400-byte windows are counted over the corpus. A run of windows with one anchor occurrence
   whose anchor recurs is cut into pieces of at most 97 windows, by the distance of the window from its
   anchor, so equal windows lie in equal places of pieces that share at least 304 bytes around the anchor.
2. Pieces that occur twice as a whole are repeated throughout. Of the others, only those that share their
   core with a different piece are left, and of these the windows that share a finer core of 385 bytes:
   one text each is cut out and dealt to a shard by its core.
3. A shard's suffix array and common prefixes come from induced sorting on disk (:mod:`induced`), whose
   memory still grows with the shard, by some 23 bytes a byte. A window repeats if it has 400 bytes in common with a neighbour.
   The windows of a core with thousands of different pieces are counted instead, spread over all tasks.
4. Every occurrence of a repeated window is removed; windows are judged on the input.

Texts move twice, compressed. Index rows grow with the corpus by one per some 200 bytes.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.anchors import MASK64, Recurring, constants, mixed, recurring, runs
from cadastra.llm.common import let
from cadastra.llm.induced import suffixes
from cadastra.llm.substring import keyed
from cadastra.shared import stage

LENGTH = 400
GRAM = 16
# Windows per piece, a quarter of those around an anchor; the core is what all windows of a piece cover.
CLASS = 97
BUCKET_BYTES = 4 << 20
# Windows of a finer core, compared before pieces are sorted.
BLOCK = 16
SHARD_BYTES = 4 << 20
# A core with more different pieces than this is spread by window instead of going to one shard.
CROWD = 2_000
# No UTF-8 text has this byte; it ends each piece of a shard.
_END = 0xFF
_STEP = 1 << 18


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """A hash of every ``gram`` consecutive bytes; ``gram`` is a power of two."""
    if len(data) < gram:
        return np.zeros(0, np.uint64)
    table = constants(257, 0xB17E)
    hashes, factor, reach = table[np.frombuffer(data, np.uint8)], int(table[256]), 1
    while reach < gram:
        hashes = hashes[:-reach] * np.uint64(factor) + hashes[reach:]
        factor, reach = factor * factor & MASK64, reach * 2
    return mixed(hashes)


def _anchor_counts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for value in batch.column(0):
                data = value.as_py().encode()
                if len(data) >= length:
                    grams = gram_hashes(data, gram)
                    found.append(grams[runs(grams, length - gram + 1)[2]])
            anchors, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchors.view(np.int64)), "n": pa.array(n)})

    return docs.select("text").mapInArrow(count, "anchor long, n long")


def _pieces(docs: DataFrame, length: int, gram: int, known: Recurring) -> DataFrame:
    """(id, print, start, size, piece, core, ahead) of the windows whose anchor may recur; size in windows.

    ``ahead`` is the core's place in the piece.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, core_hash = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
        for batch in batches:
            rows, starts, sizes, pieces, cores, aheads = [], [], [], [], [], []
            for at, value in enumerate(batch.column(0)):
                data = value.as_py().encode()
                if len(data) < length:
                    continue
                grams = gram_hashes(data, gram)
                first, end, place = runs(grams, length - gram + 1)
                often = known.holds(grams[place])
                for a, b, p in zip(first[often].tolist(), end[often].tolist(), place[often].tolist()):
                    # Windows a..b-1 begin p-a..p-b+1 bytes before the anchor.
                    for number in range((p - b + 1) // CLASS, (p - a) // CLASS + 1):
                        low = max(a, p - number * CLASS - CLASS + 1)
                        high = min(b, p - number * CLASS + 1)
                        middle = p - number * CLASS
                        rows.append(at)
                        starts.append(low)
                        sizes.append(high - low)
                        pieces.append(whole(data[low:high - 1 + length]))
                        cores.append(core_hash(data[middle:middle + length - CLASS + 1], number))
                        aheads.append(middle - low)
            if rows:
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(taken), batch.column(2).take(taken), pa.array(starts, pa.int32()),
                     pa.array(sizes, pa.int32()), pa.array(pieces, pa.binary()),
                     pa.array(np.array(cores, np.uint64).view(np.int64)), pa.array(aheads, pa.int32())],
                    ["id", "print", "start", "size", "piece", "core", "ahead"],
                )

    return docs.select("text", "id", "print").mapInArrow(
        cut, "id long, print long, start int, size int, piece binary, core long, ahead int"
    )


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id", "print"), F.lit(buckets))


def _packed(docs: DataFrame, id_type: str, buckets: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(value.as_py().encode()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), batch.column(2), batch.column(3)],
                ["doc_id", "packed", "id", "print"],
            )

    return docs.mapInArrow(pack, f"doc_id {id_type}, packed binary, id long, print long").withColumn(
        "bucket", _bucket(buckets)
    )


def _cut_out(texts: pa.Table, places: pa.Table, length: int) -> pa.Table:
    """Texts of the wanted pieces of one bucket, and their finer cores.

    A finer core is what ``BLOCK`` neighbouring windows of the piece cover: its number, its hash, and the
    first and end of those windows.
    """
    unpack = zstandard.ZstdDecompressor()
    wanted: dict = {}
    for row in places.to_pylist():
        wanted.setdefault((row["id"], row["print"]), []).append(row)
    found, finer = [], xxhash.xxh3_64_intdigest
    keys = zip(texts.column("id").to_pylist(), texts.column("print").to_pylist())
    for at, key in enumerate(keys):
        if key in wanted:
            whole = unpack.decompress(texts.column("packed")[at].as_py())
            for row in wanted.pop(key):
                size, ahead = row["size"], row["ahead"]
                data = whole[row["start"]:row["start"] + size - 1 + length]
                blocks = []
                for number in range((ahead - size + 1) // BLOCK, ahead // BLOCK + 1):
                    last = ahead - number * BLOCK
                    blocks.append({
                        "number": number,
                        "hash": finer(data[last:last + length - BLOCK + 1]) - (1 << 63),
                        "first": max(0, last - BLOCK + 1), "end": min(size, last + 1),
                    })
                found.append((row["core"], row["piece"], size, row["crowded"], data, blocks))
    columns = list(zip(*found)) or [()] * 6
    block = pa.struct([("number", pa.int32()), ("hash", pa.int64()), ("first", pa.int32()), ("end", pa.int32())])
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.binary(), pa.list_(block))
    names = ["core", "piece", "size", "crowded", "data", "blocks"]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _sharing(cut: DataFrame, length: int) -> DataFrame:
    """The pieces cut down to the windows whose finer core another piece has: core, piece, base, size, data."""
    blocks = cut.select("core", "piece", F.inline("blocks"))
    often = blocks.groupBy("core", "number", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = blocks.join(often, ["core", "number", "hash"]).groupBy("piece").agg(
        F.min("first").alias("base"), F.max("end").alias("end")
    )
    part = F.expr(f"substring(data, base + 1, end - base + {length - 1})")
    return cut.join(kept, "piece").select(
        "core", "piece", "base", (F.col("end") - F.col("base")).alias("size"), part.alias("data")
    )


class _Shard:
    """Pieces of one shard: their texts in a file, their ids and sizes in memory."""

    def __init__(self):
        self.folder = tempfile.TemporaryDirectory()
        self.path = os.path.join(self.folder.name, "text")
        self.file = open(self.path, "wb")
        self.pieces, self.bases, self.sizes, self.begins, self.length = [], [], [], [], 0

    def add(self, piece: bytes, base: int, size: int, data: bytes) -> None:
        self.file.write(data)
        self.file.write(bytes([_END]))
        self.pieces.append(piece)
        self.bases.append(base)
        self.sizes.append(size)
        self.begins.append(self.length)
        self.length += len(data) + 1

    def repeated(self, length: int) -> pa.RecordBatch:
        """(piece, first window, end) of each run of windows that repeat in the shard."""
        self.file.close()
        text = np.memmap(self.path, np.uint8, "r")
        order, shared = suffixes(text, 256, length, self.folder.name)
        repeats = np.memmap(os.path.join(self.folder.name, "repeats"), bool, "w+", shape=(len(text) + 1,))
        for at in range(0, len(order), _STEP):
            long = np.flatnonzero(shared[at:at + _STEP] >= length) + at
            if len(long):
                repeats[order[long]] = True
                repeats[order[long - 1]] = True
        found = []
        for piece, base, size, begin in zip(self.pieces, self.bases, self.sizes, self.begins):
            flags = np.concatenate([[0], repeats[begin:begin + size].astype(np.int8), [0]])
            edges = (np.flatnonzero(np.diff(flags)) + base).tolist()
            found += [(piece, first, end) for first, end in zip(edges[::2], edges[1::2])]
        self.folder.cleanup()
        columns = list(zip(*found)) or [()] * 3
        kinds = (pa.binary(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["piece", "first", "end"])


def _sorted_shards(cut: DataFrame, shards: int, length: int) -> DataFrame:
    """(piece, first, end) for all shards; a partition is one shard, whose rows go to its file as they arrive."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            shard = shard or _Shard()
            for row in batch.to_pylist():
                shard.add(row["piece"], row["base"], row["size"], row["data"])
        if shard:
            yield shard.repeated(length)

    # The number of the shard is the number of its partition, so no two shards meet in a task.
    dealt = cut.repartitionById(shards, F.pmod(F.xxhash64("core"), F.lit(shards)).cast("int"))
    return dealt.select("piece", "base", "size", "data").mapInArrow(work, "piece binary, first int, end int")


def _crowded(cut: DataFrame, length: int) -> DataFrame:
    """(piece, first, end) for pieces of crowded cores, by counting their windows over all tasks."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            sizes = batch.column(2).to_pylist()
            hashes = [
                digest(data[at:at + length]) for data, size in zip(batch.column(3).to_pylist(), sizes)
                for at in range(size)
            ]
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            places = np.concatenate([np.arange(size) for size in sizes]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(places),
                 pa.array(np.array(hashes, np.uint64).view(np.int64))],
                ["core", "piece", "at", "window"],
            )

    listed = cut.select("core", "piece", "size", "data").mapInArrow(
        windows, "core long, piece binary, at int, window long"
    )
    often = listed.groupBy("core", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    places = listed.join(often, ["core", "window"]).groupBy("piece").agg(
        F.sort_array(F.collect_set("at")).alias("places")
    )

    def edges(found: Column) -> Column:
        first = F.filter(found, lambda at, i: (i == 0) | (F.get(found, i - 1) != at - 1))
        last = F.filter(found, lambda at, i: (i == F.size(found) - 1) | (F.get(found, i + 1) != at + 1))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), (b + 1).alias("end")))

    return places.select("piece", F.inline(let(F.col("places"), edges)))


def _kept(texts: pa.Table, spans: pa.Table, length: int, emit) -> list:
    unpack = zstandard.ZstdDecompressor()
    gone: dict = {}
    for row in spans.to_pylist():
        gone.setdefault((row["id"], row["print"]), []).append((row["first"], row["end"] - 1 + length))
    made = []
    for doc_id, key, packed in zip(
        texts.column("doc_id"), zip(texts.column("id").to_pylist(), texts.column("print").to_pylist()), texts.column("packed")
    ):
        data = unpack.decompress(packed.as_py())
        parts, at, removed, runs_gone = [], 0, 0, 0
        for first, end in sorted(gone.get(key, ())):
            if first > at or not runs_gone:
                parts.append(data[at:first])
                runs_gone += 1
                removed += end - first
                at = end
            elif end > at:
                removed += end - at
                at = end
        parts.append(data[at:])
        made.append((doc_id.as_py(), len(data), removed, runs_gone, emit(b"".join(parts))))
    return made


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, emit=None,
                    kept: str = "kept binary", bucket_bytes: int = BUCKET_BYTES,
                    shard_bytes: int = SHARD_BYTES, crowd: int = CROWD) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay).

    A byte goes if a string of ``length`` bytes covers it that also starts anywhere else, the same document
    included; matches lie within documents. A null text counts as empty. Rows with equal doc_id and text are
    repetitions of one another like any other two documents. Other columns are not read. ``gram`` is a power of
    two, and ``length`` leaves a core around it.
    """
    if gram & (gram - 1) or length < gram + CLASS:
        raise ValueError(f"length {length} or gram {gram} is out of range")
    emit = emit or bytes
    source = keyed(docs, text)
    known = recurring(_anchor_counts(source, length, gram))
    pieces = stage(_pieces(source, length, gram, known), "pieces")
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, -(-total // bucket_bytes))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    packed = _packed(source, id_type, buckets)

    distinct = stage(pieces.groupBy("core", "piece").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "print", "start")).alias("place"), F.max("size").alias("size"),
        F.max("ahead").alias("ahead"),
    ), "distinct")
    shared = distinct.groupBy("core").agg(
        F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("single")
    ).where("kinds > 1 AND single > 0").select("core", (F.col("kinds") > crowd).alias("crowded"))
    open_pieces = stage(distinct.join(shared, "core").select(
        "core", "piece", "size", "ahead", "crowded", "place.id", "place.print", "place.start"
    ).withColumn("bucket", _bucket(buckets)), "open")
    cut = stage(packed.groupBy("bucket").cogroup(open_pieces.groupBy("bucket")).applyInArrow(
        lambda left, right: _cut_out(left, right, length), "core long, piece binary, size int, crowded boolean, data binary, "
        "blocks array<struct<number: int, hash: long, first: int, end: int>>"
    ), "cut")
    sharing = stage(_sharing(cut.where(~F.col("crowded")), length), "sharing")
    weight = sharing.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    runs_found = _sorted_shards(sharing, max(parts, -(-weight // shard_bytes)), length)
    if not cut.where("crowded").isEmpty():
        runs_found = runs_found.unionAll(_crowded(cut.where("crowded"), length))

    whole = distinct.where("n > 1").select("piece", F.lit(0).alias("first"), F.col("size").alias("end"))
    partly = runs_found.join(distinct.where("n > 1").select("piece"), "piece", "left_anti")
    repeated = stage(whole.unionAll(partly.select("piece", "first", "end")), "repeated")
    spans = pieces.select("id", "print", "start", "piece").join(repeated, "piece").select(
        "id", "print", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("end")).alias("end")
    ).distinct().withColumn("bucket", _bucket(buckets))

    kept_kind = {"string": pa.string(), "binary": pa.binary()}[kept.split()[1]]
    doc_kind = pa.int32() if id_type == "int" else pa.int64()

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = list(zip(*_kept(left, right, length, emit))) or [()] * 5
        kinds = (doc_kind, pa.int64(), pa.int64(), pa.int64(), kept_kind)
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", kept.split()[0]]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return packed.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(
        finish, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, {kept}"
    )


def digests(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): the digest of the bytes that stay."""
    return without_repeats(
        docs, text, length, emit=lambda kept: hashlib.sha256(kept).hexdigest(), kept="kept_sha256 string"
    )
