"""Ranked lexical search over a length-stratified index.

Documents of equal normaliser ``m`` form a *stratum*.  A shard of the index holds a bounded run of documents,
numbered in order of ``m``; its postings lie by term, then stratum, then falling tf, so all documents of a *cell*
(term, stratum, tf) score the same and a cell's impact is computed once.  The first cell of a term in a stratum is its
largest impact there; summed over an item's terms these bound the stratum.  An item visits strata by falling bound and
stops when the next bound is below its k-th best score.

Each shard is one row, built by the task that reads the documents; no text and no posting is shuffled.  Searching
sends blocks of items (bounded size) to the shards; a task keeps the k best of each item over its shards, and two ranking
steps merge the tasks.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapline.llm import tokens
from lapline.llm._common import arrow_batches, scratch_path
from lapline.llm.terms import item_blocks, terms_of, texts

TOP = 50
WEIGHT = 1000  # a term's weight is floor(WEIGHT * ln(...))
IMPACT = 1_000_000_000
SATURATION = 20
BASE, SLOPE = 50, 50  # m = BASE + SLOPE * n / (mean n), rounded down
SHARD_TERMS = 2_000_000  # terms (with repeats) of a shard, about
VISIT = 8  # strata of an item's first round of visits; each round takes twice as many
MERGE = 256  # groups of tasks in the first ranking step
EXACT = float(1 << 53)
SHARD = "ids binary, m binary, terms binary, df binary, stratum binary, tf binary, size binary, docs binary"


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def _read(packed: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), kind)


def build_shard(ids: list[int | None], found: list[np.ndarray], terms: list[bytes], n_docs: int, n_terms: int) -> tuple:
    """One row of the index: ``found`` has the places in ``terms`` of each document's terms, with repeats."""
    n = np.array([len(x) for x in found], np.int64)
    m = BASE + (SLOPE * n * n_docs) // n_terms
    none = np.array([i is None for i in ids], bool)
    known = np.array([0 if i is None else i for i in ids], np.int64)
    by = np.lexsort((known, none, m))
    number = np.empty(len(by), np.int64)
    number[by] = np.arange(len(by))
    m = m[by]
    stratum = np.cumsum(np.r_[0, m[1:] != m[:-1]]) if len(m) else m
    pairs, tf = np.unique(np.concatenate(found).astype(np.int64) * len(ids) + np.repeat(number, n), return_counts=True)
    term, doc = np.divmod(pairs, len(ids))
    # within a term documents are in order of their number, so in order of the stratum: falling tf is what is left to sort
    order = np.lexsort((-tf, term * (stratum[-1] + 1) + stratum[doc]))
    term, doc, tf = term[order], doc[order], tf[order]
    s = stratum[doc]
    first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (s[1:] != s[:-1]) | (tf[1:] != tf[:-1])])
    cells = np.bincount(term[first], minlength=len(terms))
    packed_ids = np.where(none, np.iinfo(np.int64).min, known)[by]
    return (_pack(packed_ids), _pack(m), zstandard.compress(b" ".join(terms), 1), _pack(np.bincount(term, minlength=len(terms)).astype(np.int32)),
            _pack(s[first].astype(np.int32)), _pack(tf[first].astype(np.int32)), _pack(np.diff(np.r_[first, len(term)]).astype(np.int32)),
            _pack(doc.astype(np.int32)), _pack(cells.astype(np.int32)))


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[int, int]:
    """Writes the index of every row of ``docs`` to ``path`` (Parquet, a shard a row); returns N, L.

    N counts the documents with a term, L all their terms with repeats.  Null and empty texts have none.  A document
    without an id counts in N, L and df but is never returned.  Rows that repeat an id are documents of their own.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        n = total = 0
        for batch in batches:
            sizes = [len(terms_of(t)) for t in texts(batch.column(0))]
            n, total = n + sum(map(bool, sizes)), total + sum(sizes)
        yield pa.RecordBatch.from_pydict({"n": [n], "total": [total]})

    n_docs, n_terms = rows.select("t").mapInArrow(count, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        names = [f.split()[0] for f in SHARD.split(", ")] + ["cells"]

        def row(ids, found, numbers):
            return pa.RecordBatch.from_pydict(dict(zip(names, ([x] for x in build_shard(ids, found, list(numbers), n_docs, n_terms)))))

        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        ids, found, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                terms = terms_of(text)
                if terms:
                    ids.append(i)
                    found.append(np.fromiter(map(numbers.__getitem__, terms), np.int32, len(terms)))
                    size += len(terms)
                    if size >= SHARD_TERMS:
                        yield row(ids, found, numbers)
                        numbers.clear()
                        ids, found, size = [], [], 0
        if ids:
            yield row(ids, found, numbers)

    rows.mapInArrow(build, f"{SHARD}, cells binary").write.parquet(path)
    return n_docs, n_terms


class Best:
    """The k best documents of an item: falling score, then rising id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        """Scores below it cannot enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.floor
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        by = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[by], ids[by]


def search_shard(shard: dict[str, bytes], numbers: dict[bytes, int], weights: np.ndarray, items: list[np.ndarray], best: list[Best]) -> int:
    """Visits the shard for each item (places of its terms in ``weights``); returns how many (item, stratum) were visited."""
    terms = zstandard.decompress(shard["terms"]).split(b" ")
    asked = np.fromiter(map(numbers.get, terms, repeat(-1)), np.int64, len(terms))
    ids, m, cells = _read(shard["ids"], np.int64), _read(shard["m"], np.int64), _read(shard["cells"], np.int32).astype(np.int64)
    stratum, tf, size = (_read(shard[c], np.int32).astype(np.int64) for c in ("stratum", "tf", "size"))
    docs = _read(shard["docs"], np.int32)
    m_of = m[np.r_[True, m[1:] != m[:-1]]]
    cell_end, start = np.cumsum(cells), np.cumsum(size) - size
    mine = np.flatnonzero(asked >= 0)
    place = np.full(len(weights), -1)  # of each asked term among those the shard has
    place[asked[mine]] = np.arange(len(mine))
    n = cells[mine]
    at = np.repeat(cell_end[mine] - n - np.cumsum(n) + n, n) + np.arange(n.sum())  # the cells of these terms
    own = np.repeat(np.arange(len(mine)), n)
    s, first = stratum[at], np.cumsum(n) - n
    impact = weights[asked[mine]][own] * ((IMPACT * tf[at]) // (1000 * tf[at] + SATURATION * m_of[s]))
    most = np.zeros((len(mine), len(m_of)), np.int64)
    leads = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (s[1:] != s[:-1])]) if len(at) else at
    most[own[leads], s[leads]] = impact[leads]
    visits = 0
    for terms_here, top in zip(items, best):
        here = place[terms_here]
        here = here[here >= 0]
        bound = most[here].sum(axis=0)
        order = np.argsort(-bound, kind="stable")
        mask, done, step = np.zeros(len(m_of), bool), 0, VISIT
        c = np.repeat(first[here] - np.cumsum(n[here]) + n[here], n[here]) + np.arange(n[here].sum())
        while done < len(order) and bound[order[done]] >= top.floor:
            now = order[done:done + step]
            now = now[bound[now] >= top.floor]
            mask[:] = False
            mask[now] = True
            some = c[mask[s[c]]]
            width = size[at[some]]
            posting = docs[np.repeat(start[at[some]] - np.cumsum(width) + width, width) + np.arange(width.sum())]
            told = np.repeat(impact[some], width)
            if bound[order[0]] < EXACT:
                scores = np.bincount(posting, told, len(ids)).astype(np.int64)
            else:
                scores = np.zeros(len(ids), np.int64)
                np.add.at(scores, posting, told)
            hit = np.flatnonzero((scores >= top.floor) & (ids != np.iinfo(np.int64).min))
            top.take(scores[hit], ids[hit])
            visits, done, step = visits + len(now), done + step, step * 2
    return visits


def search(spark: SparkSession, path: str, n_docs: int, items: DataFrame, k: int = TOP, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of each item with a score above 0.

    Equal scores rank by ascending doc_id.  Null, empty and wordless items, and items without an id, get no rows; rows
    that repeat an item's id are one item with the terms of all.  No documents or no items: no rows.
    """
    arrow_batches(spark)
    kind = items.schema[item_id].dataType
    index, out = spark.read.parquet(path), None
    for block in item_blocks(items, item_id, item_text):
        numbers: dict[bytes, int] = {}
        asked = [np.unique(np.array([numbers.setdefault(t, len(numbers)) for text in its for t in terms_of(text)], np.int64)) for _, its in block]
        sent = spark.sparkContext.broadcast(numbers)

        def frequencies(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            df = np.zeros(len(sent.value), np.int64)
            for batch in batches:
                for terms, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    terms = zstandard.decompress(terms).split(b" ")
                    place = np.fromiter(map(sent.value.get, terms, repeat(-1)), np.int64, len(terms))
                    df[place[place >= 0]] += _read(counts, np.int32)[place >= 0]
            yield pa.RecordBatch.from_pydict({"term": np.flatnonzero(df), "df": df[df > 0]})

        df = {r["term"]: r["df"] for r in index.select("terms", "df").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weights = np.array([math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(numbers))], np.int64)
        told = spark.sparkContext.broadcast((weights, asked))

        def visit(batches: Iterator[pa.RecordBatch], sent=sent, told=told, k=k) -> Iterator[pa.RecordBatch]:
            weights_, asked_ = told.value
            best = [Best(k) for _ in asked_]
            for batch in batches:
                for row in range(batch.num_rows):  # shards are large: one at a time
                    search_shard({c: batch.column(j)[row].as_py() for j, c in enumerate(batch.schema.names)}, sent.value, weights_, asked_, best)
            for x in range(0, len(best), 100):
                some = best[x:x + 100]
                yield pa.RecordBatch.from_pydict({"item": np.repeat(np.arange(x, x + len(some)), [len(b.ids) for b in some]),
                                                  "doc_id": np.concatenate([b.ids for b in some]), "score": np.concatenate([b.scores for b in some])})

        found = index.mapInArrow(visit, "item long, doc_id long, score long").withColumn("task", F.spark_partition_id() % MERGE)
        for group in (["item", "task"], ["item"]):
            by = Window.partitionBy(*group).orderBy(F.desc("score"), "doc_id")
            found = found.withColumn("rank", F.row_number().over(by).cast("int")).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(block)], f"item long, {item_id} {kind.simpleString()}")
        ranked = found.join(names, "item").select(item_id, "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return spark.createDataFrame([], f"{item_id} {kind.simpleString()}, rank int, doc_id long, score long") if out is None else out


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                   item_text: str = "text") -> DataFrame:
    """Indexes ``docs`` in the shared folder and searches it for ``items`` (see :func:`build_index`, :func:`search`)."""
    path = scratch_path(docs.sparkSession, "lexical-index")
    n_docs, _ = build_index(docs, path, id_col, text_col)
    return search(docs.sparkSession, path, n_docs, items, k, item_id, item_text)
