"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and pieces of words is trained in numpy from confirmed toxic documents and
unlabelled text.  Some of the unlabelled text is toxic too; the risk of calling it clean is therefore corrected by
the class prior, and where the corrected part falls below zero (it cannot in truth) the step goes the other way.
Only features that the confirmed documents have more often than the unlabelled ones take part.

The sample is bounded (``MAX_POSITIVE``, ``MAX_UNLABELLED`` documents, the smallest by a hash of their id, whole
texts); it is turned into feature numbers by tasks, and only those reach the driver.  Every document is scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapline.llm._common import arrow_batches

MAX_POSITIVE = 2000
MAX_UNLABELLED = 6000
FEATURES = 1 << 20
PIECES = (4, 5)  # lengths in bytes of the pieces of a word, its two ends marked
USED, LEAST_EXCESS, LEAST_DOCUMENTS = 1000, 3.0, 3  # most features, their least excess in standard errors, and least documents
EPOCHS, BATCHES = 40, 12
RATE, PENALTY, BIAS = 0.05, 1e-4, -2.0
HELD_OUT = 5  # labels are learnt only where crc32(id as text) mod HELD_OUT is not 0
EDGES = b".,;:!?\"'()[]{}*#<>|-_"
CACHE_WORDS = 300_000


def word_features(word: bytes) -> list[int]:
    """Numbers of a word and its pieces."""
    marked = b"<" + word.strip(EDGES) + b">"
    parts = [marked] + [marked[i:i + n] for n in PIECES for i in range(len(marked) - n + 1)]
    return [xxhash.xxh32_intdigest(p) % FEATURES for p in parts]


class _Known(dict):
    """Features of a raw word, only those of ``named`` if given."""

    def __init__(self, named: dict | None = None):
        super().__init__()
        self.named = named

    def __missing__(self, word: bytes) -> tuple:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = tuple([f for f in word_features(word) if self.named is None or f in self.named])
        return found

    def of(self, text: str | None) -> set[int]:
        """Features of a text: of its distinct words in ASCII lower case, without marks at their ends."""
        return set() if text is None else set().union(*map(self.__getitem__, set(text.encode().lower().split())))


def held_out(id_: Column) -> Column:
    """Whether a document's label must not be used; null ids never lend a label."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(True))


class Rows:
    """Documents as runs of feature numbers."""

    def __init__(self, lists: list):
        self.sizes = np.array([len(x) for x in lists], dtype=np.int64)
        self.flat = np.concatenate([np.asarray(x, dtype=np.int32) for x in lists]) if len(lists) else np.empty(0, np.int32)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of the documents, and for each the document's place in ``which``."""
        sizes = self.sizes[which]
        shift = np.repeat(self.starts[which] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return self.flat[np.arange(int(sizes.sum())) + shift], np.repeat(np.arange(len(which)), sizes)


def select(p: Rows, u: Rows) -> np.ndarray:
    """Mask of the features to use: those with the largest excess among the positive documents."""
    in_p, in_u = (np.bincount(r.flat, minlength=FEATURES) for r in (p, u))
    n_p, n_u = max(1, len(p.sizes)), max(1, len(u.sizes))
    a, b = in_p / n_p, in_u / n_u
    excess = (a - b) / np.sqrt((a + b + 1e-9) / 2 * (1 / n_p + 1 / n_u))
    best = np.lexsort((np.arange(FEATURES), -excess))[:USED]
    mask = np.zeros(FEATURES, bool)
    mask[best[(excess[best] > LEAST_EXCESS) & (in_p[best] >= LEAST_DOCUMENTS)]] = True
    return mask


def train(positive: list, unlabelled: list, prior: float, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the sigmoid loss (Adam, shuffled batches)."""
    p, u, rng = Rows(positive), Rows(unlabelled), np.random.default_rng(seed)
    weights = np.zeros(FEATURES)
    if not len(positive) or not len(unlabelled):
        return weights, BIAS
    mask = select(p, u)
    place, n = np.cumsum(mask) - 1, int(mask.sum())  # used features have the numbers 0 .. n - 1
    p, u = (Rows([place[x[mask[x]]] for x in np.split(r.flat, r.starts[1:-1])]) for r in (p, u))
    w = np.zeros(n + 1)
    w[-1] = BIAS
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for _ in range(EPOCHS):
        of_p = np.array_split(rng.permutation(len(positive)), BATCHES)
        of_u = np.array_split(rng.permutation(len(unlabelled)), BATCHES)
        for some_p, some_u in zip(of_p, of_u):
            if not len(some_p) or not len(some_u):
                continue
            fp, dp = p.take(some_p)
            fu, du = u.take(some_u)
            sp = sigmoid(np.bincount(dp, w[fp], len(some_p)) + w[-1])
            su = sigmoid(np.bincount(du, w[fu], len(some_u)) + w[-1])
            # risk of calling clean text toxic: that of the unlabelled, less the toxic share's part of it
            risk = su.mean() - prior * sp.mean()
            gp, gu = -prior * sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
            if risk < 0:
                gp, gu = -gp, -gu
            else:
                gp = gp - prior * sp * (1 - sp) / len(sp)
            g = np.bincount(fp, gp[dp], n + 1) + np.bincount(fu, gu[du], n + 1)
            g[-1] = gp.sum() + gu.sum()
            g[:-1] += PENALTY * w[:-1]
            step += 1
            first = 0.9 * first + 0.1 * g
            second = 0.999 * second + 0.001 * g * g
            w -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    weights[mask] = w[:-1]
    return weights, float(w[-1])


def _sample(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> list:
    """Feature numbers of the chosen documents (a bounded list of ids)."""
    rows = docs.join(F.broadcast(chosen), docs[id_col] == chosen["_id"], "left_semi").select(F.col(text_col).cast("string").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(known.of(t.as_py())) for t in batch.column(0)], pa.list_(pa.int32()))], names=["f"])

    lists = rows.mapInArrow(read, "f array<int>").toArrow().column("f").combine_chunks()
    flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:])]  # flat starts at the first offset


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        prior: float | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias. ``prior``: share of toxic documents; None: that of the labels that may be used.

    Labels other than 1 serve for that share alone.  Without a usable toxic label there is nothing to learn, and
    every score is that of the bias alone.
    """
    arrow_batches(docs.sparkSession)
    usable = labels.filter(F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    if prior is None:
        prior = usable.agg(F.avg((F.col(label_col) == 1).cast("double"))).first()[0]
    prior = min(max(prior if prior is not None else 0.01, 0.005), 0.5)
    key = F.xxhash64(F.col("_id"))
    toxic = usable.filter(F.col(label_col) == 1).select(F.col(id_col).alias("_id")).distinct()
    toxic = toxic.orderBy(key, "_id").limit(MAX_POSITIVE)
    plain = docs.filter(~held_out(F.col(id_col))).select(F.col(id_col).alias("_id")).distinct().orderBy(key, "_id").limit(MAX_UNLABELLED)
    return train(_sample(docs, toxic, id_col, text_col), _sample(docs, plain, id_col, text_col), prior)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of every row; null and empty texts are
    scored as texts without words; rows that repeat are scored alike; other columns are not read."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    weights, bias = model
    named = {int(i): float(weights[i]) for i in np.flatnonzero(weights)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(named)
        for batch in batches:
            out = []
            for text in batch.column(1):
                z = bias + math.fsum(map(named.__getitem__, known.of(text.as_py())))
                out.append(1 / (1 + math.exp(-min(max(z, -30.0), 30.0))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(read, f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
