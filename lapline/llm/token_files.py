"""Token-ID output: ids packed at the fewest bits that hold the vocabulary, read back by vectorised numpy.

A token folder is a Parquet dataset with one row per shard (``part``, ``shard``, ``n_ids``, ``content``): Spark
writes it to any file system and commits only whole task outputs, so a lost executor leaves no half file.
Shards follow the document order (``id_col``, then a hash of the text for repeated ids; null ids first), and a
shard holds whole documents.  ``content`` is the file format proper, little-endian:

====================  =====================================================================
8 bytes               ``LAPIDS01``
5 x uint64            bits, n_docs, n_ids, ids per block, n_blocks
n_docs x uint64       first id of each document within the shard
n_blocks x uint64     byte offset of each block within the block area
blocks                64 ids are ``bits`` words of 64 bits; id i starts at bit ``i * bits``
====================  =====================================================================

Any range of ids is unpacked from the blocks that hold it (:func:`read_ids`); nothing before them is decoded.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapline.llm._common import arrow_batches
from lapline.llm.tokens import encoder

MAGIC = b"LAPIDS01"
BLOCK_IDS = 4096
SHARD_IDS = 1 << 20  # a shard is closed at the first document end past this many ids
LANES = 64


def vocabulary_bits(size: int) -> int:
    """The fewest bits that hold the ids 0 .. size - 1."""
    return max(1, int(size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> np.ndarray:
    """uint64 words of ``ids`` at ``bits`` each (at most 32), zero-padded to whole groups of 64 ids."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit {bits} bits")
    lanes = np.zeros((-(-len(ids) // LANES), LANES), dtype=np.uint64)
    lanes.reshape(-1)[:len(ids)] = ids
    words = np.zeros((len(lanes), bits), dtype=np.uint64)
    for j in range(LANES):
        at, off = divmod(j * bits, 64)
        words[:, at] |= lanes[:, j] << np.uint64(off)
        if off + bits > 64:
            words[:, at + 1] |= lanes[:, j] >> np.uint64(64 - off)
    return words.reshape(-1)


def unpack_bits(words: np.ndarray, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of :func:`pack_bits` words, as uint32."""
    groups = words.reshape(-1, bits)
    out, mask = np.empty((len(groups), LANES), dtype=np.uint32), np.uint64((1 << bits) - 1)
    for j in range(LANES):
        at, off = divmod(j * bits, 64)
        lane = groups[:, at] >> np.uint64(off)
        if off + bits > 64:
            lane = lane | (groups[:, at + 1] << np.uint64(64 - off))
        out[:, j] = lane & mask
    return out.reshape(-1)[:count]


def pack_shard(ids: np.ndarray, starts: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """One shard's bytes. ``starts``: first id of each document."""
    if block_ids % LANES:
        raise ValueError("a block holds whole groups of 64 ids")
    blocks = [pack_bits(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    offsets = np.cumsum([0] + [b.nbytes for b in blocks], dtype="<u8")[:-1]
    head = MAGIC + struct.pack("<5Q", bits, len(starts), len(ids), block_ids, len(blocks))
    return b"".join([head, starts.astype("<u8").tobytes(), offsets.tobytes(), *(b.astype("<u8").tobytes() for b in blocks)])


class Shard:
    """Reader of one shard's bytes."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token shard")
        self.bits, self.n_docs, self.n_ids, self.block_ids, n_blocks = struct.unpack_from("<5Q", content, 8)
        self.starts = np.frombuffer(content, "<u8", self.n_docs, 48)
        self.offsets = np.frombuffer(content, "<u8", n_blocks, 48 + 8 * self.n_docs)
        self.area, self.content = 48 + 8 * (self.n_docs + n_blocks), content

    def read_ids(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` .. ``start + count - 1``, from their blocks only."""
        if start < 0 or count < 0 or start + count > self.n_ids:
            raise IndexError("ids outside the shard")
        if not count:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (start + count - 1) // self.block_ids
        end_id = min(self.n_ids, (last + 1) * self.block_ids)
        have = end_id - first * self.block_ids
        words = np.frombuffer(self.content, "<u8", -(-have // LANES) * self.bits, self.area + int(self.offsets[first]))
        return unpack_bits(words, self.bits, have)[start - first * self.block_ids:][:count]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id",
                      text_col: str = "text", mode: str = "errorifexists") -> None:
    """Encode every whole text (null or empty: only the end id) and write a token folder at ``path``.

    One range shuffle by (id, hash of the text) puts the documents in order, so a repeated id cannot fill one
    task; encoding, packing and writing follow in the same stage, a shard at a time.  Other columns are not read.
    An empty table gives an empty folder.
    """
    arrow_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .withColumn("tie", F.xxhash64("text"))
            .repartitionByRange(F.asc("id"), F.asc("tie"))
            .sortWithinPartitions(F.asc("id"), F.asc("tie")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard, enc = TaskContext.get().partitionId(), 0, encoder(tokenizer_path)
        bits, end = vocabulary_bits(max(enc.vocabulary, end_id + 1)), struct.pack("<I", end_id)
        keys: list = []
        texts: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(texts), "<u4")
            ends = np.cumsum([len(t) // 4 for t in texts])
            content = pack_shard(ids, np.concatenate([[0], ends[:-1]]), bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([keys], pa.list_(key_type)), pa.array([content], pa.binary())],
                names=["part", "shard", "n_ids", "ids_of", "content"])

        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = enc.ids([text.as_py()])[0] + end
                keys.append(key)
                texts.append(got)
                held += len(got) // 4
                if held >= SHARD_IDS:
                    yield closed()
                    shard, held, keys, texts = shard + 1, 0, [], []
        if keys:
            yield closed()

    out = rows.select("id", "text").mapInArrow(write, f"part int, shard int, n_ids long, ids_of array<{kind}>, content binary")
    out.write.mode(mode).parquet(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Every document of a token folder: id, start (ids of all documents before it), n_tokens, ids_crc32 and,
    if asked for, its ids.  Each shard is unpacked by itself; only sums by part are put in order."""
    shards = spark.read.parquet(path)
    kind = shards.schema["ids_of"].dataType.elementType.simpleString()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sizes = shards.select("part", "shard", "n_ids")
    parts = (sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), none).alias("part_start")))
    bases = (sizes.withColumn("at", F.coalesce(F.sum("n_ids").over(inside), none)).join(parts, "part")
             .select("part", "shard", (F.col("at") + F.col("part_start")).alias("base")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column("content")[i].as_py())
                ends = np.append(shard.starts[1:], shard.n_ids).astype(np.int64)
                starts = shard.starts.astype(np.int64)
                ids = shard.read_ids(0, shard.n_ids).astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                n = len(starts)
                keys = batch.column("ids_of")[i].values
                cols = [keys, pa.array(np.full(n, batch.column("part")[i].as_py(), np.int32)),
                        pa.array(np.full(n, batch.column("shard")[i].as_py(), np.int32)),
                        pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())]
                names = ["id", "part", "shard", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([ids[a:b].tolist() for a, b in zip(starts, ends)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"id {kind}, part int, shard int, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    docs = shards.select("part", "shard", "ids_of", "content").mapInArrow(read, schema)
    more = ["ids"] * with_ids
    return docs.join(bases, ["part", "shard"]).select(
        F.col("id").alias(id_col), (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", *more)
