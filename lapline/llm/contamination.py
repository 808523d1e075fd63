"""Benchmark decontamination: suffix arrays over the training documents, searched for every suffix of the test items.

Documents lie in *shards* (``SHARD_WORDS`` words, about, closed at a document's end), inside the task that read them.
A shard's words become numbers of the items' vocabulary (0: a word no item has, and the end of a document), and its
suffix array holds the places of the numbered words, sorted by prefix doubling up to the longest item.  Every
suffix of every item is then sought by binary search, all suffixes at once: its neighbours give the longest verbatim
match, and where that is a window long, a second search gives the range of all places where the window occurs.

Nothing is shuffled: the test items, in blocks of bounded size, go to the shards.  Each further block of items is one
more pass within the same tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.llm import tokens
from lapline.llm._common import arrow_batches
from lapline.llm.terms import item_blocks, terms_of, texts

WINDOW = 10  # words
SHARD_WORDS = 4_000_000


class Items:
    """A block of test items: vocabulary, words with an end mark after each text, suffixes and distinct windows."""

    def __init__(self, block: list[tuple[object, list[bytes]]], window: int):
        self.ids = [i for i, _ in block]
        self.vocabulary: dict[bytes, int] = {}
        words, starts, ends, of = [], [], [], []
        for k, (_, its) in enumerate(block):
            for text in its:
                found = terms_of(text)
                if found:
                    starts.append(len(words))
                    words += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found]
                    ends.append(len(words))
                    of.append(k)
                    words.append(-1)
        self.words = np.array(words, np.int32)
        # suffixes: where they start, their item, their place in its text, how long a window that starts here is (0: none)
        at = [np.arange(a, b) for a, b in zip(starts, ends)]
        self.suffix = np.concatenate([np.empty(0, np.int64), *at])
        size = np.array([b - a for a, b in zip(starts, ends)], np.int64)
        self.item = np.repeat(np.array(of, np.int64), size)
        self.place = self.suffix - np.repeat(np.array(starts, np.int64), size)
        left = np.repeat(size, size) - self.place
        need = np.minimum(np.repeat(size, size), window)
        self.need = np.where(left >= need, need, 0)
        self.longest = int(size.max(initial=0))
        # distinct windows by their words: one suffix stands for each, with the items that have it
        table: dict[bytes, list[int]] = {}
        for s in np.flatnonzero(self.need):
            table.setdefault(self.words[self.suffix[s]:self.suffix[s] + self.need[s]].tobytes(), []).append(int(s))
        self.windows = np.array([found[0] for found in table.values()], np.int64)
        self.window_items = [np.unique(self.item[found]) for found in table.values()]


def suffix_array(text: np.ndarray, longest: int) -> np.ndarray:
    """Places of the numbered words (``text`` > 0) in order of what starts there, up to a 0 or ``longest`` words.

    Prefix doubling: a round sorts groups that share ``k`` words by the ranks ``k`` words on; groups of one and those that
    end within ``k`` words are done.  ``text`` ends with a 0.
    """
    at = np.flatnonzero(text > 0)
    if not len(at):
        return at
    order = at[np.argsort(text[at], kind="stable")]
    # words from each place to the next 0
    zero = np.flatnonzero(text == 0)
    run = zero[np.searchsorted(zero, order)] - order
    rank = np.zeros(len(text), np.int64)

    def groups(values: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """For each sorted value the first slot of its equals, from 1."""
        first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        return slots[np.repeat(first, np.diff(np.r_[first, len(values)]))] + 1

    rank[order] = groups(text[order], np.arange(len(order)))
    slots, k = np.arange(len(order)), 1
    while k < longest:
        of = rank[order[slots]]
        alone = np.r_[True, of[1:] != of[:-1]] & np.r_[of[1:] != of[:-1], True]
        slots = slots[~alone & (run[slots] >= k)]
        if not len(slots):
            break
        places = order[slots]
        key = rank[places] * np.int64(len(text) + 1) + rank[places + k]
        by = np.argsort(key, kind="stable")
        order[slots], run[slots] = places[by], run[slots][by]
        rank[order[slots]] = groups(key[by], slots)
        k *= 2
    return order


class Shard:
    """The suffix array of some documents, searched for the items of a block."""

    def __init__(self, documents: list[np.ndarray], items: Items):
        """``documents``: the numbered words of each."""
        self.items = items
        self.ends = np.cumsum([len(d) + 1 for d in documents], dtype=np.int64)
        self.starts = np.r_[0, self.ends[:-1]] if len(documents) else self.ends
        end = np.zeros(1, np.int32)
        self.text = np.concatenate([x for d in documents for x in (d, end)] or [end])
        self.order = suffix_array(self.text, items.longest)
        self.first = self.text[self.order]

    def common(self, places: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
        """Words that the text from each place and the item from each suffix share."""
        out, live = np.zeros(len(places), np.int64), np.arange(len(places))
        q = self.items.suffix[suffixes]
        while len(live):
            live = live[self.text[places[live] + out[live]] == self.items.words[q[live] + out[live]]]
            out[live] += 1
        return out

    def bound(self, suffixes: np.ndarray, size: np.ndarray, after: bool) -> np.ndarray:
        """First slot whose text is not before the first ``size`` words of each suffix; ``after``: that is past them."""
        word = self.items.words[self.items.suffix[suffixes]]
        lo, hi = np.searchsorted(self.first, word, "left"), np.searchsorted(self.first, word, "right")
        while len(live := np.flatnonzero(lo < hi)):
            mid = (lo[live] + hi[live]) // 2
            place, s = self.order[mid], suffixes[live]
            same = np.minimum(self.common(place, s), size[live])
            whole = same == size[live]
            before = np.where(whole, after, self.text[place + same] < self.items.words[self.items.suffix[s] + np.where(whole, 0, same)])
            lo[live], hi[live] = np.where(before, mid + 1, lo[live]), np.where(before, hi[live], mid)
        return lo

    def longest(self) -> np.ndarray:
        """For every suffix of the items the words of its longest verbatim match here."""
        every = np.arange(len(self.items.suffix))
        if not len(self.order):
            return np.zeros(len(every), np.int64)
        left = np.full(len(every), 1 << 40)  # whole suffixes
        at = self.bound(every, left, False)
        out = np.zeros(len(every), np.int64)
        for slot in (at - 1, at):
            good = np.flatnonzero((slot >= 0) & (slot < len(self.order)))
            out[good] = np.maximum(out[good], self.common(self.order[slot[good]], every[good]))
        return out

    def ranges(self, suffixes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.bound(suffixes, size, False), self.bound(suffixes, size, True)

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, place and words of every occurrence of a distinct window (a place has one window of each size)."""
        items = self.items
        found = np.flatnonzero(self.longest()[items.windows] >= items.need[items.windows]) if len(items.windows) else np.empty(0, np.int64)
        s = items.windows[found] if len(found) else np.empty(0, np.int64)
        lo, hi = self.ranges(s, items.need[s])
        n = hi - lo
        slots = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(n) else np.empty(0, np.int64)
        return np.repeat(found, n), self.order[slots], np.repeat(items.need[s], n)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")


def _numbered(column: pa.Array, items: Items) -> list[np.ndarray]:
    out, get = [], items.vocabulary.get
    for text in texts(column):
        words = terms_of(text)
        out.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
    return out


def _shards(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[tuple[pa.Table, list[np.ndarray]]]:
    """The batches as shards: their rows and the numbered words of column ``t``."""
    held, words, size = [], [], 0
    for batch in batches:
        at = 0
        found = _numbered(batch.column(batch.schema.names.index("t")), items)
        for k, one in enumerate(found):
            size += len(one) + 1
            if size >= SHARD_WORDS:
                held.append(batch.slice(at, k + 1 - at))
                yield pa.Table.from_batches(held), words + found[at:k + 1]
                held, words, size, at = [], [], 0, k + 1
        if at < len(found):
            held.append(batch.slice(at))
            words += found[at:]
    if held:
        yield pa.Table.from_batches(held), words


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values)


def _marked(table: pa.Table, words: list[np.ndarray], items: Items) -> tuple[pa.Array, pa.Array]:
    """Hit spans and places of the items of each row, with those it has from earlier blocks."""
    shard = Shard(words, items)
    window, place, size = shard.occurrences()
    depth = np.zeros(len(shard.text) + 1, np.int64)
    np.add.at(depth, place, 1)
    np.add.at(depth, place + size, -1)
    before = table.column("spans").combine_chunks()
    if len(before.values):
        row = np.repeat(shard.starts, np.diff(before.offsets.to_numpy()))
        flat = before.flatten()
        np.add.at(depth, row + flat.field("start").to_numpy(), 1)
        np.add.at(depth, row + flat.field("end").to_numpy(), -1)
    hit = np.r_[False, np.cumsum(depth[:-1]) > 0, False]
    edge = np.flatnonzero(hit[1:] != hit[:-1])
    a, b = edge[::2], edge[1::2]
    doc = shard.document(a)
    spans = _lists(np.bincount(doc, minlength=len(words)), pa.StructArray.from_arrays(
        [pa.array(a - shard.starts[doc]), pa.array(b - shard.starts[doc])], ["start", "end"]))
    # distinct windows of each document, then their items
    pair = np.unique(shard.document(place) * np.int64(max(1, len(items.windows))) + window)
    cut = np.searchsorted(pair, np.arange(len(words) + 1) * np.int64(max(1, len(items.windows))))
    mine = [np.unique(np.concatenate([items.window_items[w] for w in pair[x:y] % len(items.windows)])) if y > x else np.empty(0, np.int64)
            for x, y in zip(cut[:-1], cut[1:])]
    return spans, _lists(np.array([len(x) for x in mine], np.int64), pa.array(np.concatenate([np.empty(0, np.int64), *mine])))


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                 window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the input row as a struct, or its columns ``keep``, whatever they are called), ``n_words``, ``spans`` (start and end, in
    words, of the runs of hit words) and ``items`` (ids of the items with a window in the document, as strings in order).

    A window is ``window`` consecutive words of an item, or all words of a shorter one.  Null and empty texts have no
    words, items without words no window; rows that repeat are judged alike; items without an id take no part, and rows that
    repeat an item's id are one item.  No items: nothing is hit.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("t"),
                       F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    blocks = item_blocks(items, item_id, item_text)
    block = next(blocks, [])
    while block is not None:
        later = next(blocks, None)
        rows = _pass(rows, spark.sparkContext.broadcast((block, window)), later is None)
        block = later
    return rows


def _pass(rows: DataFrame, sent, last: bool) -> DataFrame:
    kept = [f for f in rows.schema.fields if f.name != "t" or not last]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        items = Items(*sent.value)
        names = np.array([str(i) for i in items.ids], dtype=object)
        for table, words in _shards(batches, items):
            spans, found = _marked(table, words, items)
            known = table.column("items").to_pylist()
            now = [sorted({*(k or ()), *names[i]}) if len(i) or k else [] for k, i in zip(known, (x.as_py() for x in found))]
            new = {"n_words": pa.array([len(w) for w in words], pa.int64()), "spans": spans, "items": pa.array(now, pa.list_(pa.string()))}
            out = pa.table([new.get(f.name, table.column(f.name)) for f in kept], names=[f.name for f in kept])
            yield from out.to_batches(max_chunksize=1000)

    return rows.mapInArrow(mark, T.StructType(kept))


def longest_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                    item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``item_id`` (string), ``item_start``, ``n_words``, ``doc_id``, ``doc_start``: for every suffix of an item that starts with a
    window found in a document, the longest verbatim match in all documents and where the first one (by doc_id,
    then place) begins.  Starts count words.  Null texts and rows without an id take no part."""
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t")).filter("id IS NOT NULL")
    schema = "item_id string, item_start long, n_words long, doc_id long, doc_start long"
    out = spark.createDataFrame([], schema)
    for block in item_blocks(items, item_id, item_text):
        sent = spark.sparkContext.broadcast((block, window))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            its = Items(*sent.value)
            for table, words in _shards(batches, its):
                shard, ids = Shard(words, its), table.column("id").to_numpy()
                size = shard.longest()
                good = np.flatnonzero((its.need > 0) & (size >= its.need))
                lo, hi = shard.ranges(good, size[good])
                where = []
                for x, y in zip(lo, hi):
                    doc = shard.document(places := shard.order[x:y])
                    best = np.lexsort((places, ids[doc]))[0]
                    where.append((ids[doc[best]], places[best] - shard.starts[doc[best]]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([str(its.ids[i]) for i in its.item[good]], pa.string()), pa.array(its.place[good]), pa.array(size[good]),
                    pa.array([int(d) for d, _ in where], pa.int64()), pa.array([int(p) for _, p in where], pa.int64())], names=["item_id", "item_start", "n_words", "doc_id", "doc_start"])

        out = out.unionByName(rows.mapInArrow(search, schema))
    best = F.min(F.struct((-F.col("n_words")).alias("less"), "doc_id", "doc_start")).alias("best")
    found = out.groupBy("item_id", "item_start").agg(best)
    return found.select("item_id", "item_start", (-F.col("best.less")).alias("n_words"), "best.doc_id", "best.doc_start")


def remove_contaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents in which no window of an item occurs, as they were."""
    return contaminated(docs, items, **settings).filter(F.size("spans") == 0).select("row.*")
