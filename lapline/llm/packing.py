"""Packing: shortest-pack-first over the length histogram, joined back to documents by rank.

Documents are encoded, longer ones cut into pieces of ``max_tokens`` and a rest, and only the histogram of piece
lengths (at most ``max_tokens`` entries, whatever the input) reaches the driver.  There lengths are placed longest
first, each into the shortest pack that exists with room for it, and counts of packing patterns are updated;
a pattern is a list of lengths with the number of sequences that follow it.  Every piece then has a rank
among those of its length, and the rank names its pattern, sequence and offset.

The plan is bounded by ``max_tokens`` alone: a length opens at most one new pattern and splits at most one.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapline.llm._common import arrow_batches, cut, shuffle_partitions
from lapline.llm.tokens import encoder

MAX_TOKENS = 2048


def tokenize(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = 1,
             id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``max_tokens`` ids of every whole text with its end id.

    Columns: id, row (64 bits that tell repeated ids apart), start, length, doc_tokens, ids_crc32 and, with
    ``with_ids``, the ids as little-endian uint32 bytes.  Null and empty texts have the end id alone; rows that
    repeat an id are documents of their own; other columns are not read.
    """
    arrow_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer_path), struct.pack("<I", end_id)
        for batch in batches:
            of, start, length, total, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                got = enc.ids([text.as_py()])[0] + end
                n = len(got) // 4
                for at in range(0, n, max_tokens):
                    piece = got[4 * at:4 * (at + max_tokens)]
                    of.append(i)
                    start.append(at)
                    length.append(len(piece) // 4)
                    total.append(n)
                    crc.append(zlib.crc32(piece))
                    if with_ids:
                        ids.append(piece)
            at = pa.array(of, pa.int64())
            cols = [batch.column(0).take(at), batch.column(2).take(at), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(total, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "row", "start", "length", "doc_tokens", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    schema = f"id {kind}, row long, start long, length long, doc_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(read, schema)


def shortest_pack_first(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(sequences, [(length, times), ...])`` that place every length of the histogram.

    As if one at a time, longest first, each into the pack with the least content if it has room, else into a new
    one; equal packs are counted, not listed, so the work follows the histogram and not the documents.
    """
    patterns: dict[int, list] = {}  # by content: [sequences, lengths]
    filled: list[int] = []  # the contents there are, in order

    def add(content: int, count: int, lengths: tuple) -> None:
        if content not in patterns:
            patterns[content] = []
            bisect.insort(filled, content)
        patterns[content].append([count, lengths])

    for length in sorted(histogram, reverse=True):
        left = int(histogram[length])
        if not 0 < length <= max_tokens:
            raise ValueError(f"length {length} is outside 1 .. {max_tokens}")
        while left:
            content = filled[0] if filled else None
            if content is None or content + length > max_tokens:
                times = max_tokens // length
                full, rest = divmod(left, times)
                if full:
                    add(length * times, full, ((length, times),))
                if rest:
                    add(length * rest, 1, ((length, rest),))
                break
            group = patterns[content]
            count, lengths = group.pop()
            if not group:
                del patterns[content]
                filled.pop(0)
            used = min(count, left)
            if used < count:
                add(content, count - used, lengths)
            if lengths[-1][0] == length:
                longer = (*lengths[:-1], (length, lengths[-1][1] + 1))
            else:
                longer = (*lengths, (length, 1))
            add(content + length, used, longer)
            left -= used
    return [(count, list(lengths)) for content in sorted(patterns) for count, lengths in patterns[content]]


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per length, in rank order: (first rank, first sequence, times in a sequence, offset of the first)."""
    out: dict[int, list] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for count, lengths in patterns:
        offset = 0
        for length, times in lengths:
            out.setdefault(length, []).append((rank.get(length, 0), sequence, times, offset))
            rank[length] = rank.get(length, 0) + count * times
            offset += length * times
        sequence += count
    return out


def ranked(pieces: DataFrame, group: Column, order: list[Column]) -> DataFrame:
    """``pieces`` with ``rank`` (from 0) in each group, with no window over a whole group.

    A hot group is dealt over hash buckets; ranks run inside (group, bucket), and counts by (group, bucket),
    summed before the shuffle, give the bucket its start.
    """
    buckets = max(16, 4 * shuffle_partitions(pieces.sparkSession))
    dealt = pieces.withColumn("_g", group).withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.withColumn("_from", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("_g", "_b").orderBy(*order)) - 1)
    return inside.join(starts, ["_g", "_b"]).withColumn("rank", (F.col("_from") + F.col("_r")).cast("long")).drop("_g", "_b", "_from", "_r")


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``pieces`` (id, row, start, length, and any more columns) with ``sequence_id``, ``offset`` and
    ``padded_to``: a sequence is padded to ``max_tokens`` unless its content is a power of two.

    Reads ``pieces`` twice; pass a cut or stored table.  No pieces: no rows.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns = shortest_pack_first(histogram, max_tokens)
    table = places(patterns)
    contents = np.array([sum(length * times for length, times in lengths) for _, lengths in patterns] or [0], dtype=np.int64)
    firsts = np.cumsum([0] + [count for count, _ in patterns[:-1]])
    arrays = {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for length, rows in table.items()}

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                first, seq, times, off = arrays[int(one)]
                mine = np.flatnonzero(length == one)
                k = np.searchsorted(first, rank[mine], side="right") - 1
                along, again = np.divmod(rank[mine] - first[k], times[k])
                sequence[mine], offset[mine] = seq[k] + along, off[k] + again * one
            content = contents[np.searchsorted(firsts, sequence, side="right") - 1] if len(rank) else np.zeros(0, np.int64)
            padded = np.where(content & (content - 1), max_tokens, content)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset), pa.array(padded)],
                                             names=[*batch.schema.names, "sequence_id", "offset", "padded_to"])

    rows = ranked(pieces, F.col("length"), [F.col("id"), F.col("row"), F.col("start")])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(locate, schema + ", sequence_id long, offset long, padded_to long").drop("rank")


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode, cut, plan and place: one row per piece, with its ids if asked for."""
    pieces = cut(tokenize(docs, tokenizer_path, max_tokens, end_id, id_col, text_col, with_ids))
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to"] + ["ids"] * with_ids
    return pack(pieces, max_tokens).select(F.col("id").alias(id_col), *names)
