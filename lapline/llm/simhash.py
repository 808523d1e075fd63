"""SimHash near-duplicates: Golay-code fuzzy hashing of 64-bit fingerprints.

Fingerprints link at ``MAX_BITS`` (4) or fewer differing bits.  A fingerprint is cut into three segments, each
read as a word of the perfect (23, 12) Golay code, which puts every 23-bit word within 3 bits of exactly one of
4096 codewords.  A segment has the index of its own codeword and, as further keys, the indices its one-bit
neighbours decode to (5.3 in the mean):

* segments that differ in one bit: the own index of either is among the keys of the other;
* segments that differ in two bits: both have the index of the word half-way as a key.

Four errors over three segments leave either two segments with at most one error each, or one segment without
and two with two each.  So two kinds of keys find every link: for each pair of segments, own index of the one
with a key of the other, from both sides; and for each segment, its exact bits with a key of the next.
Fingerprints that share a key meet, and only pairs within ``MAX_BITS`` bits become links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm import tokens
from lapline.llm._common import arrow_batches, cut, shuffle_partitions
from lapline.llm.graph import components

MAX_BITS = 4
SHINGLE = 4
SEED = 42
GENERATOR = 0xC75  # fixed value: generator polynomial of the (23, 12) Golay code
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit, bits; the last is filled up with zeros
PAIRWISE = 8  # up to so many fingerprints of a key are compared in one numpy step for all keys of a batch
TILE = 2048  # a key with more fingerprints is compared in tiles of this size, dealt over tasks


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint; null and wordless texts: 0."""
    words = [] if text is None else text.encode().lower().split()  # lower() and split() of bytes know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], SEED) for a, b in zip([0, *ends], ends[shingle - 1:])]
    h = np.array(hashes, dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits by the generator, and the error of weight 3 or less of each remainder."""
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    upper = np.array([remainder(m << 11) for m in range(4096)], dtype=np.uint32)
    errors = np.zeros(2048, dtype=np.uint32)
    single = [1 << i for i in range(23)]
    for i, a in enumerate(single):
        errors[remainder(a)] = a
        for j, b in enumerate(single[:i]):
            errors[remainder(a ^ b)] = a ^ b
            for c in single[:j]:
                errors[remainder(a ^ b ^ c)] = a ^ b ^ c
    return upper, errors


UPPER, ERRORS = _tables()


def decode(words: np.ndarray) -> np.ndarray:
    """Index (0 .. 4095) of the codeword nearest to each 23-bit word."""
    words = words.astype(np.uint32)
    return (words ^ ERRORS[UPPER[words >> np.uint32(11)] ^ (words & np.uint32(2047))]) >> np.uint32(11)


def segment_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own index of each word; and rows, keys: every index that the word or a one-bit neighbour decodes to, once."""
    own = decode(words)
    near = np.stack([own, *(decode(words.astype(np.uint32) ^ np.uint32(1 << i)) for i in range(bits))], axis=1)
    near.sort(axis=1)
    new = np.ones(near.shape, dtype=bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    rows, _ = np.nonzero(new)
    return own, rows, near[new]


def keys_of(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """rows, keys (int64): every key of every fingerprint, at most once each."""
    f = fingerprints.view(np.uint64) if fingerprints.dtype == np.int64 else fingerprints
    words = [((f >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    found = [segment_keys(w, n) for w, (_, n) in zip(words, SEGMENTS)]
    rows, keys = [], []
    for a in range(3):
        b = (a + 1) % 3
        (own_a, rows_a, keys_a), (own_b, rows_b, keys_b) = found[a], found[b]
        rows += [rows_a, rows_b, rows_b]
        keys += [(a << 60) | (keys_a.astype(np.int64) << 12) | own_b[rows_a],
                 (a << 60) | (own_a[rows_b].astype(np.int64) << 12) | keys_b,
                 ((3 + a) << 60) | (words[a][rows_b] << 12) | keys_b]
    rows, keys = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
    return rows[new], keys[new]


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= MAX_BITS


def forest(f: np.ndarray, g: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined by pairs within MAX_BITS in ``f`` (with ``g``: between ``f`` and ``g``):
    at most one link less than there are fingerprints."""
    n = len(f)
    every = f if g is None else np.concatenate([f, g])
    open_, a, b = np.ones(len(every), dtype=bool), [], []
    for i in range(len(every)):
        if not open_[i]:
            continue
        open_[i] = False
        todo = [i]
        while todo:
            k = todo.pop()
            mine = open_ if g is None else (open_ & ((np.arange(len(every)) >= n) == (k < n)))
            hit = np.flatnonzero(mine)
            hit = hit[near(np.full(len(hit), every[k]), every[hit])]
            open_[hit] = False
            todo += hit.tolist()
            a += [every[k]] * len(hit)
            b += every[hit].tolist()
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, f) in order of key: links of every key; rows of a key beyond TILE pass on with their tile."""
    held_k, held_f = np.empty(0, np.int64), np.empty(0, np.int64)
    hot, passed = None, 0

    def out(kind: int, a, b, key=None, tile=None):
        n = len(a)
        key = np.zeros(n, np.int64) if key is None else key
        tile = np.zeros(n, np.int64) if tile is None else tile
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(a), pa.array(b), pa.array(key), pa.array(tile)],
                                          names=["kind", "a", "b", "key", "tile"])

    def links(k: np.ndarray, f: np.ndarray):
        if len(k) < 2:
            return
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        sizes = np.diff(np.append(first, len(k)))
        small = np.repeat(sizes <= PAIRWISE, sizes)
        a, b = [], []
        for d in range(1, PAIRWISE):
            at = np.flatnonzero((k[d:] == k[:-d]) & small[d:])
            at = at[near(f[at], f[at + d])]
            a.append(f[at])
            b.append(f[at + d])
        for i in np.flatnonzero(sizes > PAIRWISE):
            x, y = forest(f[first[i]:first[i] + sizes[i]])
            a.append(x)
            b.append(y)
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
            yield out(0, pairs[0].copy(), pairs[1].copy())

    for batch in batches:
        k = np.concatenate([held_k, batch.column(0).to_numpy()])
        f = np.concatenate([held_f, batch.column(1).to_numpy()])
        if hot is not None:  # the rest of a hot key
            n = int(np.searchsorted(k, hot, side="right"))
            if n:
                yield out(1, f[:n], f[:n], k[:n], (passed + np.arange(n)) // TILE)
            passed, k, f = passed + n, k[n:], f[n:]
            if not len(k):
                held_k, held_f = k, f
                continue
            hot = None
        last = int(np.searchsorted(k, k[-1], side="left"))
        yield from links(k[:last], f[:last])
        k, f = k[last:], f[last:]
        if len(k) > TILE:
            hot, passed = k[0], len(k)
            yield out(1, f, f, k, np.arange(len(k)) // TILE)
            k, f = k[:0], f[:0]
        held_k, held_f = k, f
    yield from links(held_k, held_f)


def _compare_tiles(rows):
    """One cell of a hot key: its tile against itself or against another one."""
    import pandas as pd

    f, side = rows["f"].to_numpy(), rows["side"].to_numpy()
    same = rows["i"].iloc[0] == rows["j"].iloc[0]
    a, b = forest(np.unique(f)) if same else forest(f[side == 0], f[side == 1])
    return pd.DataFrame({"a": a, "b": b})


def link(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column ``f``, long) that join exactly what pairs within
    MAX_BITS join.  Keys with many fingerprints, as in a large group of near copies, are compared tile by tile
    over many tasks, and a tile gives at most as many links as it has fingerprints."""
    spark = fingerprints.sparkSession

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column(0).to_numpy()
            rows, keys = keys_of(f)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(f[rows])], names=["key", "f"])

    keys = fingerprints.select("f").mapInArrow(spread, "key long, f long")
    dealt = keys.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", "f")
    found = cut(dealt.mapInArrow(_compare, "kind int, a long, b long, key long, tile long"))
    links = found.filter("kind = 0").select("a", "b")
    hot = found.filter("kind = 1").select("key", F.col("a").alias("f"), "tile")
    last = hot.groupBy("key").agg(F.max("tile").alias("last"))
    cells = hot.join(last, "key").select("key", "f", "tile", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    cells = cells.select("key", "f", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
                         (F.col("tile") > F.col("other")).cast("int").alias("side"))
    return links.union(cells.groupBy("key", "i", "j").applyInPandas(_compare_tiles, "a long, b long"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id``, ``h`` (hash of the text), ``f`` of every row; whole texts, other columns are not read."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch in batches:
            f = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(f)], names=["id", "h", "f"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")).mapInArrow(read, f"id {kind}, h long, f long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: id, text hash ``h``, fingerprint ``f`` (long), ``root`` and ``component_id``.

    ``component_id`` is the smallest id reachable by links; null ids count only where a component has no other.
    Rows that repeat an id, a text or both each have their row.  Wordless and null texts have fingerprint 0.
    """
    marks = cut(fingerprints(docs, id_col, text_col, shingle))
    firsts = marks.groupBy("f").agg(F.min("id").alias("first"))
    roots = components(link(firsts.select("f")))
    rooted = firsts.join(roots.withColumnRenamed("node", "f"), "f", "left").select("f", "first", F.coalesce("root", "f").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.select("f", "root").join(smallest, "root").select("f", "root", "component_id")
    return marks.join(of, "f").select("id", "h", "f", "root", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The documents with one row of each group: the smallest id; among rows of that id in the group the smallest
    text hash; of wholly equal ids and texts any one row."""
    marks = cut(near_duplicates(docs, id_col, text_col, shingle))
    kept = marks.filter(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root", "component_id", "f", "h").agg(F.count(F.lit(1)).alias("n"))
    kept = kept.groupBy("root", "component_id").agg(F.min(F.struct("h", "n")).alias("k")).select(
        F.col("component_id").alias("_id"), F.col("k.h").alias("_h"), F.col("k.n").alias("_n"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("h"))

    def of(some: DataFrame) -> DataFrame:
        return rows.join(some, rows["id"].eqNullSafe(some["_id"]) & (rows["h"] == some["_h"]), "left_semi")

    once = of(kept.filter("_n = 1"))
    more = of(kept.filter("_n > 1")).dropDuplicates(["id", "h"])
    return once.union(more).select(*[F.col(f"row.`{c}`") for c in docs.columns])
