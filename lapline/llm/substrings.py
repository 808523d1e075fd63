"""Substring dedup: repeated word windows found level by level, each level twice as long as the last.

Windows of ``base`` words come first.  Only where two neighbouring windows are both found again is the window
of twice the length a candidate, and so on up to ``window`` words or until no candidate survives.

Documents lie in *blocks* (a bounded number of words, one compressed row each).  For a level every block sends
each bucket of the hash space its distinct candidate hashes, sorted and packed as differences; the bucket
answers one bit a hash.  So a window that every document holds counts once a block, no task gathers its
occurrences, and what is shuffled is a few bytes a distinct window.  The lower levels keep so many bits of
a hash as make chance matches rare (they only leave needless candidates); the last one compares 96 bits together
with the first document of each block and answers whether an earlier document has the window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm import tokens
from lapline.llm._common import arrow_batches, cut, cut_dealt, give_back, mix64, shuffle_partitions, words_of

WINDOW = 20
BASE = 5
BLOCK_WORDS = 1_000_000  # a block is closed at the first document end past this many words
BUCKET_WINDOWS = 2_000_000  # windows for each bucket, about
SPARE_BITS = 6  # bits of a hash beyond those that number the windows: chance matches under 2 ** -SPARE_BITS
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
CACHE_WORDS = 100_000
NULL_ID = -(1 << 63)

_ODD = np.random.default_rng(20).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_HASHES = _Hashes()


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _rows(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _pack(a: np.ndarray) -> bytes:
    """Bytes of an array by significance, compressed: zero bytes of small numbers cost nothing."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


class _Block:
    """Documents of a block in order of id (null first, rows of one id as they came) and their word hashes."""

    def __init__(self, payload: bytes, id_at: int, text_at: int):
        self.rows = _rows(payload).column(0).combine_chunks()
        ids = self.rows.field(id_at).cast(pa.int64()).fill_null(NULL_ID)
        self.order = np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable")
        self.ids = ids.to_numpy(zero_copy_only=False)[self.order]
        self.texts = self.rows.field(text_at).cast(pa.string())
        hashes, ends = [], [0]
        for i in self.order:
            words = words_of(self.texts[int(i)].as_py())
            hashes.append(np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)))
            ends.append(ends[-1] + len(words))
        self.words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.ends = np.array(ends)
        self.doc = np.repeat(np.arange(len(hashes)), np.diff(self.ends))

    def fits(self, length: int) -> np.ndarray:
        """Where a window of ``length`` words lies within one document."""
        return np.arange(len(self.words)) + length <= self.ends[1:][self.doc]

    def hashes(self, length: int, base: int) -> np.ndarray:
        """Hash of the window from each word on (meaningless where it does not fit)."""
        n = len(self.words)
        h = np.zeros(n, np.uint64)
        for j in range(base):
            h[:max(0, n - j)] += self.words[j:] * _ODD[j]
        h, at, k = mix64(h), base, 32
        while at < length:
            later = np.zeros(n, np.uint64)
            later[:max(0, n - at)] = h[at:]
            h, at, k = mix64(h * _ODD[k] + later * _ODD[k + 1]), 2 * at, k + 2
        return h


def _bucket_of(values: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Bucket by the upper 32 bits of a value of ``bits`` bits: in the order of the values."""
    upper = values >> np.uint64(bits - 32) if bits >= 32 else values << np.uint64(32 - bits)
    return ((upper * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _checks(h: np.ndarray, block: _Block, at: np.ndarray, length: int) -> np.ndarray:
    """A second hash of 32 bits from the words themselves."""
    out = np.zeros(len(at), np.uint64)
    for j in range(length):
        out = (out + block.words[at + j]) * _ODD[63]
    return (mix64(out) >> np.uint64(32)).astype(np.uint32)


class _Levels:
    """The work on one block: requests of a level, and what its answers leave."""

    def __init__(self, base: int, window: int, bits: int, buckets: int):
        self.base, self.window, self.bits, self.buckets = base, window, bits, buckets

    def candidates(self, block: _Block, length: int, alive: np.ndarray | None) -> np.ndarray:
        """Starts of windows to ask for; ``alive``: where a window of half the length is found again."""
        if alive is None:
            return np.flatnonzero(block.fits(length))
        later = np.zeros_like(alive)
        half = length // 2
        later[:max(0, len(alive) - half)] = alive[half:]
        return np.flatnonzero(alive & later & block.fits(length))

    def distinct(self, block: _Block, length: int, at: np.ndarray):
        """Sorted distinct values of the candidates, the place of each candidate among them, its count and first."""
        h = block.hashes(length, self.base)[at]
        bits = 64 if length == self.window else self.bits
        if length < self.window:
            values, inverse, counts = np.unique(h >> np.uint64(64 - bits), return_inverse=True, return_counts=True)
            return bits, values, inverse, counts, None, None
        check = _checks(h, block, at, length)
        order = np.lexsort((at, check, h))
        new = np.ones(len(at), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1])
        inverse = np.empty(len(at), np.int64)
        inverse[order] = np.cumsum(new) - 1
        first = order[new]
        return bits, h[first], inverse, None, check[first], first

    def requests(self, block: _Block, length: int, at: np.ndarray):
        bits, values, _, _, check, first = self.distinct(block, length, at)
        bucket = _bucket_of(values, bits, self.buckets)
        edges = np.searchsorted(bucket, np.arange(self.buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            some = slice(edges[b], edges[b + 1])
            steps = np.diff(values[some], prepend=np.uint64(0))
            if check is None:
                yield int(b), _pack(steps), None, None
            else:
                yield int(b), _pack(steps), _pack(check[some]), _pack(block.ids[block.doc[at[first[some]]]])

    def found(self, block: _Block, length: int, at: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
        """Whether each candidate is found again (below the window) or has an earlier occurrence (at the window)."""
        bits, values, inverse, counts, _, first = self.distinct(block, length, at)
        bucket = _bucket_of(values, bits, self.buckets)
        edges = np.searchsorted(bucket, np.arange(self.buckets + 1))
        hit = np.zeros(len(values), bool)
        for b in np.flatnonzero(np.diff(edges)):
            n = edges[b + 1] - edges[b]
            hit[edges[b]:edges[b + 1]] = np.unpackbits(np.frombuffer(answers[int(b)], np.uint8), count=n).astype(bool)
        if first is None:
            return (hit | (counts > 1))[inverse]
        mine = np.zeros(len(at), bool)
        mine[first] = True
        return hit[inverse] | ~mine


def _answer(length: int, window: int):
    """All requests of one bucket: one bit for each value of each block.  Negative buckets hold a block's own
    survivors, which pass on."""
    def answer(rows):
        import pandas as pd

        if rows["bucket"].iloc[0] < 0:
            return rows[["block", "bucket", "steps"]].rename(columns={"steps": "bits"})
        rows = rows.sort_values("block", ignore_index=True)
        parts = [np.cumsum(_unpack(x, np.uint64)) for x in rows["steps"]]
        sizes = [len(p) for p in parts]
        values = np.concatenate(parts)
        if length < window:
            order = np.argsort(values, kind="stable")
            same = values[order][1:] == values[order][:-1]
            flag = np.zeros(len(values), bool)
            flag[1:] |= same
            flag[:-1] |= same
        else:
            check = np.concatenate([_unpack(x, np.uint32) for x in rows["checks"]])
            ids = np.concatenate([_unpack(x, np.int64) for x in rows["ids"]])
            order = np.lexsort((np.repeat(np.arange(len(parts)), sizes), ids, check, values))
            flag = np.zeros(len(values), bool)
            flag[1:] = (values[order][1:] == values[order][:-1]) & (check[order][1:] == check[order][:-1])
        hit = np.zeros(len(values), bool)
        hit[order] = flag
        bits = [np.packbits(x).tobytes() for x in np.split(hit, np.cumsum(sizes)[:-1])]
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "bits": bits})

    return answer


ASKED = "block long, bucket long, steps binary, checks binary, ids binary"
ANSWERED = "block long, bucket long, bits binary"


def blocks_of(rows: DataFrame, text_at: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``block``, ``n_words``, ``payload``: the structs of ``rows`` in bounded compressed blocks, dealt by block."""
    spark = rows.sparkSession
    arrow_batches(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens.forget()
        number, held, words = TaskContext.get().partitionId() << 32, [], 0

        def closed() -> pa.RecordBatch:
            some = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([words]), pa.array([_ipc(some)], pa.binary())],
                                              names=["block", "n_words", "payload"])

        for batch in batches:
            texts = batch.column(0).field(text_at).cast(pa.string())
            sizes = np.array([len(words_of(t.as_py())) for t in texts])
            at = 0
            while at < len(sizes):  # a batch is cut where the block is full
                upto = at + int(np.searchsorted(np.cumsum(sizes[at:]) + words, block_words)) + 1
                held.append(batch.slice(at, upto - at))
                words, at = words + int(sizes[at:upto].sum()), min(upto, len(sizes))
                if words >= block_words:
                    yield closed()
                    number, held, words = number + 1, [], 0
        if held:
            yield closed()

    made = rows.mapInArrow(read, "block long, n_words long, payload binary")
    return made.repartition(shuffle_partitions(spark), "block")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, base: int = BASE,
            own_space: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every input row with what earlier text leaves of it.

    ``row`` (the input row as a struct), ``n_words``, ``spans`` (removed words as [start, end) word numbers) and
    ``kept`` (the kept words joined by one space; with ``own_space``, kept runs keep their own white space and
    are joined by one).  A word goes if some window of ``window`` consecutive words of its document covers it
    whose word sequence also starts earlier: in a smaller id (an integer; null is smallest), or earlier in the
    same document.  Rows that repeat an id are documents one after another in a fixed order.  Null, empty and
    short texts have no window.  ``window`` must be ``base`` doubled some times.
    """
    length = base
    while length < window:
        length *= 2
    if length != window:
        raise ValueError("window must be base times a power of two")
    spark, names = docs.sparkSession, docs.columns
    where = names.index(id_col), names.index(text_col)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    # dealt by block once: later levels bring their answers to where the blocks lie
    blocks = cut_dealt(blocks_of(packed, where[1], block_words))
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = min(63, max(33, int(total).bit_length() + SPARE_BITS))
    work = _Levels(base, window, bits, max(shuffle_partitions(spark), -(-total // BUCKET_WINDOWS)))
    data = blocks.select("block", "payload")

    def first_ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = _Block(payload.as_py(), *where)
                rows = list(work.requests(block, base, work.candidates(block, base, None)))
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(rows), pa.int64()), pa.array(cols[0], pa.int64()),
                         *(pa.array(c, pa.binary()) for c in cols[1:])], names=["block", "bucket", "steps", "checks", "ids"])

    def settle(block: _Block, length: int, answers) -> tuple[np.ndarray, np.ndarray | None]:
        """Windows of ``length`` found again; ``answers`` holds the last level's survivors under a negative bucket."""
        got = dict(zip(answers["bucket"], answers["bits"]))
        alive = None
        if min(got, default=0) < 0:
            alive = np.unpackbits(np.frombuffer(got[min(got)], np.uint8), count=len(block.words)).astype(bool)
        elif length > base:
            alive = np.zeros(len(block.words), bool)
        at = work.candidates(block, length, alive)
        out = np.zeros(len(block.words), bool)
        if len(at):
            out[at[work.found(block, length, at, got)]] = True
        return out

    def next_ask(length: int):
        def ask(mine, answers):
            import pandas as pd

            number, block = int(mine["block"].iloc[0]), _Block(mine["payload"].iloc[0], *where)
            alive = settle(block, length, answers)
            rows = [(number, -1 - number, np.packbits(alive).tobytes(), None, None)]
            at = work.candidates(block, 2 * length, alive)
            if len(at):
                rows += [(number, *r) for r in work.requests(block, 2 * length, at)]
            return pd.DataFrame(rows, columns=["block", "bucket", "steps", "checks", "ids"])

        return lambda mine, answers: ask(mine, answers) if len(mine) else _none(ASKED)

    def answers_to(asked: DataFrame, length: int) -> DataFrame:
        return asked.groupBy("bucket").applyInPandas(_answer(length, window), ANSWERED)

    kind = packed.schema["row"].dataType

    def finish(mine, answers):
        made = finished(mine, answers)
        give_back()  # of the block just settled
        return made

    def finished(mine, answers):
        import pandas as pd

        if not len(mine):
            return _none("block long, payload binary")
        block = _Block(mine["payload"].iloc[0], *where)
        starts = settle(block, window, answers)
        gone = np.zeros(len(block.words) + 1, np.int64)
        at = np.flatnonzero(starts)
        np.add.at(gone, at, 1)
        np.add.at(gone, at + window, -1)
        gone = np.cumsum(gone)[:-1] > 0
        n_words, spans, kept = [], [], []
        for k, i in enumerate(block.order):
            a, b = block.ends[k], block.ends[k + 1]
            text, mark = block.texts[int(i)].as_py(), gone[a:b]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.view(np.int8), [0]])))
            n_words.append(int(b - a))
            spans.append([{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)])
            kept.append(_kept(text, mark, own_space))
        out = pa.RecordBatch.from_arrays(
            [block.rows.take(pa.array(block.order)), pa.array(n_words, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string())],
            names=["row", "n_words", "spans", "kept"])
        return pd.DataFrame({"block": [mine["block"].iloc[0]], "payload": [_ipc(out)]})

    def open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(1):
                for some in _rows(payload.as_py()).to_batches(max_chunksize=1000):
                    yield some
        give_back()

    answers, length = cut(answers_to(data.mapInArrow(first_ask, ASKED), base)), base
    while length < window and not answers.filter("bucket >= 0").isEmpty():
        asked = data.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(next_ask(length), ASKED)
        length *= 2
        answers = cut(answers_to(asked, length))
    if length < window:  # no candidate survives: nothing is found again
        answers = spark.createDataFrame([], ANSWERED)
    done = data.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, "block long, payload binary")
    return done.mapInArrow(open_blocks, f"row {kind.simpleString()}, n_words long, spans array<struct<start:long,end:long>>, kept string")


def _none(schema: str):
    import pandas as pd

    return pd.DataFrame(columns=[x.split()[0] for x in schema.split(", ")])


def _kept(text: str | None, gone: np.ndarray, own_space: bool) -> str:
    if text is None:
        return ""
    if not own_space:
        words = words_of(text)
        return (b" ".join(words) if not gone.any() else b" ".join([w for w, g in zip(words, gone) if not g])).decode()
    if not gone.any():
        return text
    raw, runs, last = text.encode(), [], None
    for i, m in enumerate(WORD.finditer(raw)):
        if gone[i]:
            last = None
        elif last is None:
            runs.append([m.start(), m.end()])
            last = i
        else:
            runs[-1][1] = m.end()
    return b" ".join([raw[a:b] for a, b in runs]).decode()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, repeated passages taken from ``text_col``; texts without any stay as they are
    (null too), and texts of which nothing is left become empty."""
    found = repeats(docs, id_col, text_col, window, own_space=True)
    text = F.when(F.size("spans") > 0, F.col("kept")).otherwise(F.col(f"row.`{text_col}`"))
    return found.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
