"""Exact top-k by inner product: norm-bucketed retrieval.

Candidates are grouped by length into buckets of ``BUCKET_ROWS``, longest first.  A query enters a bucket with the
score ``t`` of its k-th best so far.  ``t / (|q| max|p|)`` is then the cosine a vector of the bucket must reach:

* above 1, the bucket is passed over (and every later one);
* near 1, *coordinate pruning*: on the query's largest coordinates, a unit vector with that cosine must
  lie within an interval around the query's, and only vectors inside all of them are multiplied;
* else *length pruning*: only the vectors at least ``t / |q|`` long are multiplied, all of them if ``t`` is low.

What survives is verified by its integer product.  Queries in blocks meet candidates in chunks of whole
buckets, a cell a task; each cell returns at most k rows a query, and a ranking per query merges them.  The first
thresholds are true scores, from the longest vectors, so no cell starts from nothing.

They also prune before the shuffle.  A query needs candidates of length ``t / |q|`` at least, so it goes to the chunks
down to the class of that length only.  Queries are numbered into blocks by that need, hardest first; a candidate goes to
the blocks from the first one on that may use its class, and nowhere if none does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapline.llm._common import arrow_batches, cut

K = 20
SCALE = 64.0
BUCKET_ROWS = 1024
CHUNK_ROWS = 16 * BUCKET_ROWS  # candidates of a cell, about
QUERY_ROWS = 1024  # queries of a cell, about
SEED_ROWS = 4096  # longest candidates that give the first thresholds (a speed setting: results do not depend on it)
CLASSES = 16  # length classes for each doubling of the length
COORDINATE_COSINE = 0.9  # from this local cosine on, coordinate pruning
FOCUS = 4  # coordinates it looks at
EXACT = float(1 << 53)


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: float = SCALE) -> DataFrame:
    """``id``, ``v`` (floor(scale * x) as doubles) and ``length`` of the rows that take part: neither the vector
    nor a component is null, NaN or infinite, and the id is not null."""
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x * F.lit(scale)).cast("double"))
    rows = vectors.filter(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    return rows.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def _matrix(column, dim: int | None = None) -> np.ndarray:
    """Rows of doubles, shorter ones filled up with zeros."""
    rows = [np.asarray(r, dtype=np.float64) for r in column]
    dim = max([dim or 0, *(len(r) for r in rows)])
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where they are exact there, else in Python's integers (scores past
    the range of a long stop at its ends)."""
    bound = np.abs(q).max(initial=0) * np.abs(p).max(initial=0) * max(1, q.shape[1])
    if bound < EXACT:
        return (q @ p.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    out = whole(q) @ whole(p).T
    return np.clip(out, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, in that order."""
    if len(scores) > 4 * k:
        low = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= low)
        return some[np.lexsort((ids[some], -scores[some]))][:k]
    return np.lexsort((ids, -scores))[:k]


class Search:
    """Top k of a few queries over buckets of falling length."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, floors: np.ndarray):
        self.ids, self.q, self.k = ids, q, k
        self.length = np.sqrt((q * q).sum(axis=1))
        self.floor = floors  # scores that k others are known to reach; -inf if unknown
        self.scores = [np.empty(0, np.int64) for _ in ids]
        self.found = [np.empty(0, np.int64) for _ in ids]
        order = np.argsort(-np.abs(q), axis=1, kind="stable")
        self.focus = order[:, :FOCUS]

    def bucket(self, ids: np.ndarray, p: np.ndarray, length: np.ndarray) -> None:
        """``p`` in falling order of ``length``."""
        top = length[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where((self.length > 0) & (top > 0), self.floor / (self.length * top), np.where(self.floor > 0, np.inf, -np.inf))
        live = np.flatnonzero(cosine <= 1 + 1e-9)
        steep = live[cosine[live] >= COORDINATE_COSINE]
        flat = live[cosine[live] < COORDINATE_COSINE]
        if len(flat):  # length pruning: the shortest vector that any of these queries can still use
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(self.length[flat] > 0, self.floor[flat] / self.length[flat], -np.inf)
            n = int(np.searchsorted(-length, -(need.min() * (1 - 1e-9) if need.min() > 0 else -np.inf), side="right"))
            if n:
                scores = products(self.q[flat], p[:n])
                for row, i in enumerate(flat):
                    self._take(i, ids[:n], scores[row])
        if len(steep):
            with np.errstate(divide="ignore", invalid="ignore"):
                unit = np.where(length[:, None] > 0, p / length[:, None], 0.0)
            for i in steep:
                c = min(1.0, cosine[i])
                qi = self.q[i] / self.length[i]
                slack = math.sqrt(max(0.0, 1 - c * c)) + 1e-7
                inside = length * self.length[i] >= self.floor[i] * (1 - 1e-9)
                for f in self.focus[i]:
                    middle, width = qi[f] * c, slack * math.sqrt(max(0.0, 1 - qi[f] * qi[f])) + 1e-7
                    if qi[f] >= c:
                        inside &= unit[:, f] >= middle - width
                    elif qi[f] <= -c:
                        inside &= unit[:, f] <= middle + width
                    else:
                        inside &= (unit[:, f] >= middle - width) & (unit[:, f] <= middle + width)
                at = np.flatnonzero(inside)
                if len(at):
                    self._take(i, ids[at], products(self.q[i:i + 1], p[at])[0])

    def _take(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        good = (scores >= self.floor[i]) & (ids != self.ids[i])
        if not good.any():
            return
        scores = np.concatenate([self.scores[i], scores[good]])
        ids = np.concatenate([self.found[i], ids[good]])
        best = _best(scores, ids, self.k)
        self.scores[i], self.found[i] = scores[best], ids[best]
        if len(best) == self.k:
            self.floor[i] = max(self.floor[i], float(scores[best[-1]]))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = [len(x) for x in self.found]
        return np.repeat(self.ids, sizes), np.concatenate([*self.found, np.empty(0, np.int64)]), np.concatenate([*self.scores, np.empty(0, np.int64)])


def _length_class(length: Column) -> Column:
    """Classes of nearly equal length, rising; ``CLASSES`` a doubling, so doubles have some 16,400 of them at most."""
    return F.floor(F.log2(length + 1) * CLASSES).cast("int")


def cells(vectors: DataFrame, queries: Column, k: int, id_col: str, vector_col: str, scale: float) -> tuple[DataFrame | None, int]:
    """The rows of every cell (``part``, ``chunk``): ``side`` 0 queries with their ``floor``, 1 candidates; and the
    dimension.  None without queries.  No pair of a query and a candidate that may score its floor is apart.

    Tables of length classes (candidates') and of need classes (queries') come to the driver: both are bounded by
    ``CLASSES`` and the range of doubles, not by the data.
    """
    spark = vectors.sparkSession
    arrow_batches(spark, 4096)
    rows = cut(scaled(vectors, id_col, vector_col, scale).join(
        vectors.filter(queries).select(F.col(id_col).cast("long").alias("asked")).filter("asked IS NOT NULL").distinct(),
        F.col("id") == F.col("asked"), "left"))
    asked = rows.filter("asked IS NOT NULL").groupBy("id").agg(F.min("v").alias("v"))
    n, dim, n_asked = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.countDistinct("asked")).first()
    if not n_asked:
        return None, 0
    dim = max(dim, 1)

    # first thresholds: each query's k-th best among the longest vectors (bounded by SEED_ROWS)
    seeds = rows.select("id", "v", "length").orderBy(F.desc("length"), "id").limit(SEED_ROWS).collect() if n > k else []
    seed_ids, seed = np.array([r["id"] for r in seeds], dtype=np.int64), _matrix([r["v"] for r in seeds], dim)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, q = batch.column(0).to_numpy(), _matrix(batch.column(1).to_pylist(), dim)
            floors = np.full(len(ids), -np.inf)
            if len(seed_ids):
                scores = products(q, seed)
                for i in range(len(ids)):
                    others = scores[i][seed_ids != ids[i]]
                    if len(others) >= k:
                        floors[i] = np.partition(others, len(others) - k)[len(others) - k]
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                need = np.where(floors > 0, floors / np.sqrt((q * q).sum(axis=1)), 0.0) * (1 - 1e-9)
                # the class of the shortest vector of use, or the one below it where rounding may matter; -1: any vector
                classes = np.where(floors > 0, np.floor(np.log2(need + 1) * CLASSES - 1e-6), -1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors), pa.array(classes.astype(np.int32))], names=["id", "v", "floor", "need"])

    floors = cut(asked.select("id", "v").mapInArrow(first, "id long, v array<double>, floor double, need int"))
    needs = floors.groupBy("need").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("need", ascending=False)
    classes = rows.groupBy(_length_class(F.col("length")).alias("c")).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("c", ascending=False)

    # classes in falling order, filled up to a chunk or block; large ones take several
    def numbered(table, most: int):
        before = table["n"].cumsum() - table["n"]
        return before // most, -(-table["n"] // most)

    classes["first"], classes["cells"] = numbered(classes, CHUNK_ROWS)
    needs["first"], needs["cells"] = numbered(needs, QUERY_ROWS)
    parts = int((needs["first"] + needs["cells"]).max())
    length, need = classes["c"].to_numpy(np.int64), needs["need"].to_numpy(np.int64)
    # a need's last chunk: that of the shortest class that it can use; -1 if there is none
    ends = np.concatenate([[0], np.maximum.accumulate((classes["first"] + classes["cells"]).to_numpy(np.int64))])
    needs["last"] = ends[np.searchsorted(-length, -need, side="right")] - 1
    # a class's first block: that of the hardest need that can use it; ``parts`` if there is none
    starts = np.append(needs["first"].to_numpy(np.int64), parts)
    classes["part"] = starts[np.searchsorted(-need, -length, side="left")]
    small = lambda table, names: F.broadcast(spark.createDataFrame(
        [tuple(int(x) for x in row) for row in table[names].itertuples(index=False)], ", ".join(f"{x} int" for x in names)))

    left = floors.join(small(needs, ["need", "first", "cells", "last"]), "need").filter("last >= 0").select(
        F.lit(0).alias("side"), "id", "v", "floor", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("cells"))).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("last"))).alias("chunk"))
    right = rows.withColumn("c", _length_class(F.col("length"))).join(small(classes, ["c", "first", "cells", "part"]), "c").filter(F.col("part") < parts).select(
        F.lit(1).alias("side"), "id", "v", F.lit(0.0).alias("floor"), F.explode(F.sequence(F.col("part"), F.lit(parts - 1))).alias("part"),
        (F.col("first") + F.pmod(F.xxhash64("id", "v"), F.col("cells"))).cast("int").alias("chunk"))
    return left.unionByName(right), dim


def top_k(vectors: DataFrame, queries: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row that ``queries`` selects, the ``k`` highest
    integer inner products over every row of another id.

    Vectors that are null or hold null or non-finite components, and rows without an id, take no part.  Shorter
    vectors count as filled up with zeros, so an empty vector scores 0.  Rows that repeat an id are all
    candidates; as a query the id is asked once, with its first vector in array order.  No queries: no rows.  Columns
    other than the two named are not read, whatever their names.
    """
    dealt, dim = cells(vectors, queries, k, id_col, vector_col, scale)
    if dealt is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def cell(rows_):
        import pandas as pd

        q = rows_[rows_["side"] == 0]
        p = rows_[rows_["side"] == 1]
        if not len(q) or not len(p):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        search = Search(q["id"].to_numpy(np.int64), _matrix(q["v"], dim), k, q["floor"].to_numpy(np.float64).copy())
        matrix, ids = _matrix(p["v"], dim), p["id"].to_numpy(np.int64)
        length = np.sqrt((matrix * matrix).sum(axis=1))
        order = np.lexsort((ids, -length))
        for at in range(0, len(order), BUCKET_ROWS):
            some = order[at:at + BUCKET_ROWS]
            search.bucket(ids[some], matrix[some], length[some])
        a, b, c = search.rows()
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})

    found = dealt.groupBy("part", "chunk").applyInPandas(cell, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
