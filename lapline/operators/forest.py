"""Regression forest grown until its leaves are pure (M04, M11), on Spark.

Growth is hybrid.  *Top*: nodes with more than ``small_rows`` rows are split level by level over the cluster: a pass for each
node's totals and ranges, passes for histograms that narrow the search, and one that compares the cuts that are left; only sums of bins
and splits come to the driver, in waves of ``WAVE_NODES`` nodes and ``WAVE_CELLS`` bins.  *Bottom*: a node with few rows goes to one task by
(tree, node) and is grown there to purity, all its nodes of a depth at once (numpy over presorted columns).  Both find the same
splits, so the size at which one takes over from the other shows in the time only.  Neither depth nor leaf size is capped unless asked for.

A grown forest holds about as many nodes as its rows times its trees, so below the top it stays a table (one packed
subtree a row) and scoring streams rows past their subtrees, sorted by (tree, node); no group is held.
Bootstrap weights are Poisson(1) from a hash of the row and the tree, so they depend on neither order nor partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.session import ensure_checkpoint_dir

SMALL_ROWS = 200_000   # rows of a node that one task grows to purity
BINS = 128             # bins of a histogram in the top phase
WAVE_NODES = 2_000     # (tree, node) pairs whose totals and ranges a task holds at a time
WAVE_CELLS = 1_000_000 # bins of histograms that a task, and the driver, hold at a time (24 bytes each)
ZOOMS = 3              # times that a bin of many rows is divided again before its rows are summed by value
BOTTOM_TASKS = 2_000   # tasks of the bottom phase, at most
BATCH_ROWS = 10_000
NEAR = 1e-10           # gains nearer than this share of the tree's sum of squares are equal, whatever the order of the sums
TIE_ROWS = 200_000     # the sum of squares of at most so many rows: that of a large tree would be more than its small nodes have

_GOLDEN, _MIX1, _MIX2 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_MAX = np.finfo(float).max
_POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])


def bootstrap_weights(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson(1) of a hash of (row, tree, seed)."""
    with np.errstate(over="ignore"):
        x = row.astype(np.uint64) + _GOLDEN * np.uint64(tree + 1) + _MIX1 * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        x ^= x >> np.uint64(31)
    return np.searchsorted(_POISSON, (x >> np.uint64(11)) / float(1 << 53), "right")


@dataclass
class Tree:
    """Nodes as arrays: ``feature`` (-1: none), ``threshold`` (<= goes left), ``left`` (the right child follows it), ``value``."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node at which each row of ``x`` ends."""
        at = np.zeros(len(x), np.int64)
        live = np.flatnonzero(self.feature[at] >= 0)
        while len(live):
            f, t = self.feature[at[live]], self.threshold[at[live]]
            at[live] = self.left[at[live]] + (x[live, f] > t)
            live = live[self.feature[at[live]] >= 0]
        return at

    def pack(self) -> bytes:
        return b"".join([np.int64(len(self.feature)).tobytes(), self.feature.astype("<i4").tobytes(), self.threshold.astype("<f8").tobytes(),
                         self.left.astype("<i4").tobytes(), self.value.astype("<f8").tobytes()])

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        return cls(np.frombuffer(data, "<i4", n, 8), np.frombuffer(data, "<f8", n, 8 + 4 * n),
                   np.frombuffer(data, "<i4", n, 8 + 12 * n), np.frombuffer(data, "<f8", n, 8 + 16 * n))


def tolerance(squares, rows):
    """How near gains of a tree are equal, from its labels' sum of squares about their mean and its number of rows."""
    return NEAR * squares * np.minimum(1.0, TIE_ROWS / np.maximum(rows, 1))


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, max_depth: int | None = None, near: float | None = None) -> tuple[Tree, np.ndarray]:
    """A least-squares tree over weighted rows, to purity: a node stays a leaf only when its labels are equal or no
    feature tells its rows apart.  Returns the tree and each feature's sum of squares removed.

    Thresholds lie midway between neighbouring values; equal gains go to the first feature, then the smallest threshold.
    ``near``: the tolerance of the tree that these rows are a node of (default: they are the whole tree).
    All nodes of a depth are split together: each column keeps its rows by (node, value), so a level is running sums
    within segments, and the rows of the children are dealt without sorting again.  Segments have the same rows in every
    column, so what depends on a node alone is made once a level.
    """
    columns = [np.ascontiguousarray(c) for c in x.T]
    orders = [np.argsort(c, kind="stable") for c in columns]
    gains = np.zeros(len(columns))
    feature, threshold, left, value = [np.array([-1])], [np.zeros(1)], [np.zeros(1, np.int64)], [np.array([np.average(y, weights=w)])]
    at, size = np.zeros(1, np.int64), np.array([len(y)])   # open nodes: place among the nodes of their depth, rows
    made, depth, packed = 1, 0, 1
    both, goes_to = w * 1j, np.zeros(len(y), np.int8)       # label less its node's mean, times weight, and the weight: one running sum for both
    if not len(y) or y.min() == y.max():
        max_depth = 0
    elif near is None:
        near = tolerance(float((w * (y - value[0][0]) ** 2).sum()), len(y))
    while len(at) and (max_depth is None or depth < max_depth):
        start, rows = np.cumsum(size) - size, orders[0]
        seg = np.repeat(np.arange(len(size)), size)
        z, own = y.take(rows) - value[-1][at].take(seg), w.take(rows)
        both.real[rows] = own * z
        whole = np.add.reduceat(own, start).take(seg)
        inner = np.ones(len(rows), bool)
        inner[start + size - 1] = False
        best, best_f, best_t = np.full(len(size), -1e300), np.full(len(size), -1), np.zeros(len(size))
        for f, order in enumerate(orders):
            v = columns[f].take(order)
            edge = np.flatnonzero((v[1:] > v[:-1]) & inner[:-1])
            if not len(edge):
                continue
            run, s, we = np.cumsum(both.take(order)), seg.take(edge), whole.take(edge)
            base = run.take(start - 1)
            base[0] = 0.0
            low = run.take(edge) - base.take(s)
            sl, wl = low.real, low.imag
            gain = sl * sl * we / (wl * (we - wl))
            head = np.r_[0, np.flatnonzero(s[1:] != s[:-1]) + 1]
            of, top = s.take(head), np.maximum.reduceat(gain, head)
            better = top > best[of] + near
            if better.any():
                number = np.repeat(np.arange(len(of)), np.diff(np.r_[head, len(s)]))
                high = np.flatnonzero(gain >= (top - near).take(number))
                cut = edge[high[np.r_[True, number[high][1:] != number[high][:-1]]]][better]
                of = of[better]
                best[of], best_f[of], best_t[of] = top[better], f, midway(v[cut], v[cut + 1])
        split = best_f >= 0
        if not split.any():
            break
        gains += np.bincount(best_f[split], np.maximum(best[split], 0.0), len(columns))
        many = int(split.sum())
        feature[-1][at[split]], threshold[-1][at[split]], left[-1][at[split]] = best_f[split], best_t[split], made + 2 * np.arange(many)
        goes_to[rows] = 0
        if many < len(size):
            rows = rows[np.repeat(split, size)]
        node = np.repeat(np.arange(many), size[split])
        child = 2 * node + (x[rows, best_f[split].take(node)] > best_t[split].take(node))
        sizes, moved = np.bincount(child, minlength=2 * many), both.take(rows)
        value.append(np.repeat(value[-1][at[split]], 2) + np.bincount(child, moved.real, 2 * many) / np.bincount(child, moved.imag, 2 * many))
        feature.append(np.full(2 * many, -1))
        threshold.append(np.zeros(2 * many))
        left.append(np.zeros(2 * many, np.int64))
        made += 2 * many
        depth += 1
        if max_depth is not None and depth >= max_depth:
            break
        low, high = np.full(2 * many, np.inf), np.full(2 * many, -np.inf)
        labels = y.take(rows)
        np.minimum.at(low, child, labels)
        np.maximum.at(high, child, labels)
        opened = low < high
        # the stable deal: in every column the rows of left children, in their order, take the places of left children, and so do the right ones
        goes_to[rows] = (1 + (child & 1)) * opened.take(child)
        at, size = np.flatnonzero(opened), sizes[opened]
        places = np.repeat(at & 1, size)
        places = np.flatnonzero(places == 0), np.flatnonzero(places)
        new = []
        for order in orders:
            side, dealt = goes_to.take(order), np.empty(int(size.sum()), np.int64)
            dealt[places[0]], dealt[places[1]] = order.compress(side == 1), order.compress(side == 2)
            new.append(dealt)
        orders = new
        if len(at) >= 8 * packed:      # the rows of a node lie together again, and the rows of leaves are gone
            rows, packed = orders[0], len(at)
            place = np.empty(len(y), np.int64)
            place[rows] = np.arange(len(rows))
            orders, columns = [place.take(o) for o in orders], [c.take(rows) for c in columns]
            x, y, w, both, goes_to = x[rows], y.take(rows), w.take(rows), both.take(rows), goes_to[:len(rows)]
    return Tree(np.concatenate(feature), np.concatenate(threshold), np.concatenate(left), np.concatenate(value)), gains


def midway(a, b):
    """A threshold between neighbouring values: ``a`` where no number lies between them."""
    with np.errstate(over="ignore"):
        middle = a + (b - a) / 2
    return np.where(middle < b, middle, a)


@dataclass
class _Top:
    """The top of one tree while it grows: open leaves are to be split, others go to the bottom phase or are done."""

    feature: list = field(default_factory=lambda: [-1])
    threshold: list = field(default_factory=lambda: [0.0])
    left: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])

    def tree(self) -> Tree:
        return Tree(np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.value))

    def split(self, node: int, feature: int, threshold: float) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.threshold[node], self.left[node] = feature, threshold, at
        for mine, zero in ((self.feature, -1), (self.threshold, 0.0), (self.left, 0), (self.value, 0.0)):
            mine.extend([zero, zero])
        return at, at + 1


def _step(step: np.ndarray) -> np.ndarray:
    return np.where(step > 0, step, 1.0)


def _bin(x: np.ndarray, low: np.ndarray, step: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each value: never a lower one for a larger value."""
    with np.errstate(over="ignore"):
        at = x - low
        at /= step
    np.minimum(at, bins - 1, out=at)
    return np.maximum(at, 0, out=at).astype(np.int64)


def _matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.column_stack([batch.column(j).to_numpy(zero_copy_only=False) for j in range(features)]).astype(np.float64, copy=False)


class PureForest:
    """Estimator: ``fit(frame)`` gives a :class:`PureForestModel`.

    Rows with a null or NaN feature or label take no part.  ``partitions``: tasks that the training rows are dealt to once
    (by a hash of the row), before the passes; None keeps the frame's own.
    """

    def __init__(self, features: list[str], label: str = "final_time", trees: int = 100, seed: int = 42, max_depth: int | None = None,
                 small_rows: int = SMALL_ROWS, bins: int = BINS, bootstrap: bool = True, partitions: int | None = None):
        self.features, self.label, self.trees, self.seed, self.max_depth = list(features), label, trees, seed, max_depth
        self.small_rows, self.bins, self.bootstrap, self.partitions = small_rows, bins, bootstrap, partitions

    def _weights(self, row: np.ndarray, tree: int) -> np.ndarray:
        return bootstrap_weights(row, tree, self.seed) if self.bootstrap else np.ones(len(row), np.int64)

    def fit(self, frame: DataFrame) -> PureForestModel:
        spark, k, trees = frame.sparkSession, len(self.features), self.trees
        base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lapline-forest-{uuid.uuid4().hex}"
        cols = [F.col(f"`{c}`").cast("double").alias(f"x{j}") for j, c in enumerate(self.features)] + [F.col(f"`{self.label}`").cast("double").alias("y")]
        rows = frame.select(*cols, F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]).alias("r")).dropna()
        rows = rows.filter(~F.exists(F.array(*[c for c in rows.columns if c != "r"]), F.isnan))
        if self.partitions:
            rows = rows.repartition(self.partitions, "r")
        rows.write.parquet(f"{base}/rows")
        rows = spark.read.parquet(f"{base}/rows")
        tops = [_Top() for _ in range(trees)]
        open_nodes = [(t, 0) for t in range(trees)]
        bottom: list[tuple[int, int]] = []
        gains, depth = np.zeros((trees, k)), 0
        ties: dict[int, float] = {}      # of the trees that are split here
        pending: dict[tuple[int, int], tuple[int, int, float]] = {}   # right child -> node, feature and largest value on the left
        while open_nodes:
            following = []
            for at in range(0, len(open_nodes), WAVE_NODES):
                facts = self._facts(rows, tops, open_nodes[at:at + WAVE_NODES], k)
                large = {}
                for node, (n, weight, total, low, high, ranges) in sorted(facts.items()):
                    tops[node[0]].value[node[1]] = total / weight
                    if node in pending:
                        parent, f, v = pending.pop(node)
                        tops[node[0]].threshold[parent] = float(midway(v, ranges[f][0]))
                    capped = self.max_depth is not None and depth >= self.max_depth
                    if low == high or capped or all(a == b for a, b in ranges):
                        continue
                    if n <= self.small_rows:
                        bottom.append(node)
                    else:
                        large[node] = (ranges, weight, total, n)
                some = list(large)
                for a in range(0, len(some), max(1, WAVE_CELLS // (k * self.bins))):
                    part = {node: large[node] for node in some[a:a + max(1, WAVE_CELLS // (k * self.bins))]}
                    for node, (f, v, gain) in self._splits(rows, tops, part, ties, k).items():
                        gains[node[0], f] += gain
                        children = tops[node[0]].split(node[1], f, v)
                        pending[node[0], children[1]] = node[1], f, v
                        following += [(node[0], child) for child in children]
            open_nodes, depth = sorted(following), depth + 1
        made = [t.tree() for t in tops]
        grown = self._bottoms(rows, made, bottom, k, ties) if bottom else spark.createDataFrame([], _SUBTREE)
        grown.write.parquet(f"{base}/subtrees")
        below = spark.read.parquet(f"{base}/subtrees")
        for r in below.select("tree", F.posexplode("gains").alias("f", "gain")).groupBy("tree", "f").agg(F.sum("gain").alias("gain")).collect():
            gains[r["tree"], r["f"]] += r["gain"]
        total = gains.sum(axis=1, keepdims=True)
        shares = np.divide(gains, total, out=np.zeros_like(gains), where=total > 0).mean(axis=0)
        return PureForestModel(self.features, made, f"{base}/subtrees", shares / shares.sum() if shares.sum() else shares)

    def _walk(self, batch: pa.RecordBatch, tops: list[Tree], nodes: dict[int, dict[int, int]], k: int):
        """For each tree with wanted nodes: rows drawn there, their weights, and which wanted node they are in."""
        x, y, r = _matrix(batch, k), batch.column(k).to_numpy(), batch.column(k + 1).to_numpy()
        for tree, wanted in nodes.items():
            w = self._weights(r, tree)
            drawn = np.flatnonzero(w > 0)
            number = np.full(len(tops[tree].feature), -1)
            number[list(wanted)] = list(wanted.values())
            own = x[drawn]
            of = number[tops[tree].leaves(own)]
            if (of < 0).any():
                own, drawn, of = own[of >= 0], drawn[of >= 0], of[of >= 0]
            if len(drawn):
                yield own, y[drawn], w[drawn], of

    def _numbered(self, wanted: list[tuple[int, int]]) -> dict[int, dict[int, int]]:
        out: dict[int, dict[int, int]] = {}
        for i, (tree, node) in enumerate(wanted):
            out.setdefault(tree, {})[node] = i
        return out

    def _facts(self, rows: DataFrame, tops: list[_Top], wanted: list[tuple[int, int]], k: int) -> dict:
        """Rows, weight, label sum, label range and feature ranges of the wanted nodes: one pass, bounded rows a task."""
        nodes, frozen = self._numbered(wanted), [t.tree() for t in tops]

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, weight, total = np.zeros(len(wanted), np.int64), np.zeros(len(wanted)), np.zeros(len(wanted))
            low, high = np.full((len(wanted), k + 1), np.inf), np.full((len(wanted), k + 1), -np.inf)
            for batch in batches:
                for x, y, w, of in self._walk(batch, frozen, nodes, k):
                    base = of.min()        # the nodes of a tree are neighbours
                    found = np.bincount(of - base)
                    span = slice(base, base + len(found))
                    n[span] += found
                    weight[span] += np.bincount(of - base, w)
                    total[span] += np.bincount(of - base, w * y)
                    z = np.column_stack([x, y])
                    if len(found) == 1:
                        own, at = np.array([base]), np.zeros(1, np.int64)
                    else:
                        by = np.argsort((of - base).astype(np.uint16 if len(found) < 65_536 else np.int64), kind="stable")
                        z, of = z[by], of[by]
                        at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                        own = of[at]
                    low[own], high[own] = np.minimum(low[own], np.minimum.reduceat(z, at)), np.maximum(high[own], np.maximum.reduceat(z, at))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"i": some, "n": n[some], "weight": weight[some], "total": total[some]}
                                             | {f"a{j}": low[some, j] for j in range(k + 1)} | {f"b{j}": high[some, j] for j in range(k + 1)})

        schema = "i long, n long, weight double, total double, " + ", ".join([f"a{j} double" for j in range(k + 1)] + [f"b{j} double" for j in range(k + 1)])
        got = rows.mapInArrow(scan, schema).groupBy("i").agg(*[F.sum(c).alias(c) for c in ("n", "weight", "total")],
                                                            *[F.min(f"a{j}").alias(f"a{j}") for j in range(k + 1)], *[F.max(f"b{j}").alias(f"b{j}") for j in range(k + 1)])
        return {wanted[r["i"]]: (r["n"], r["weight"], r["total"], r[f"a{k}"], r[f"b{k}"], [(r[f"a{j}"], r[f"b{j}"]) for j in range(k)]) for r in got.collect()}

    def _splits(self, rows: DataFrame, tops: list[_Top], large: dict, ties: dict[int, float], k: int) -> dict:
        """The split of each large node that ``grow`` finds: node -> (feature, largest value on the left, gain).

        Histograms only narrow the search.  A bin's rows bound the gain of any cut among them; bins that may hold the best
        cut are divided again while they have many rows (``ZOOMS`` times at most), then their rows are summed by value, and
        every cut between two values is compared.  So the bins decide about time alone, not about the split.
        """
        wanted, bins = list(large), self.bins
        nodes, frozen = self._numbered(wanted), [t.tree() for t in tops]
        weight, centre = np.array([large[n][1] for n in wanted]), np.array([large[n][2] / large[n][1] for n in wanted])
        drawn = np.array([large[n][3] for n in wanted])
        ranges = np.array([large[n][0] for n in wanted], float)
        f, i = np.nonzero((ranges[:, :, 0] < ranges[:, :, 1]).T)   # cells: parts of a node's values of a feature
        ranges = np.clip(ranges, -_MAX, _MAX)
        first = np.full((k, len(wanted)), -1)
        first[f, i] = np.arange(len(f))
        cells = {"i": i, "f": f, "low": ranges[i, f, 0], "step": _step(ranges[i, f, 1] / bins - ranges[i, f, 0] / bins), "w": np.zeros(len(f)), "s": np.zeros(len(f))}
        path: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []   # of each round: low and step of its cells; what each bin leads to
        least, whole, near = np.full(len(wanted), -1e300), np.zeros(len(wanted)), np.array([ties.get(t, -1.0) for t, _ in wanted])   # -1: a root, to be found
        ends: list[dict] = []

        def reach(x: np.ndarray, at: np.ndarray, want_ends: bool) -> tuple[np.ndarray, np.ndarray]:
            """The open cells (or the ends) that rows with these values are in, and which rows those are."""
            some = np.flatnonzero(at >= 0)
            at, found = at if len(some) == len(at) else at[some], []
            for low, step, then in path:
                at = then[at, _bin(x[some], low[at], step[at], bins)]
                found.append((-2 - at[at <= -2], some[at <= -2]))
                at, some = at[at >= 0], some[at >= 0]
            return tuple(np.concatenate(z) for z in zip(*found)) if want_ends else (at, some)

        while len(cells["i"]):
            then, following, n_ends = np.full((len(cells["i"]), bins), -1, np.int32), [], sum(len(e["i"]) for e in ends)
            n_following = 0
            for a in range(0, len(cells["i"]), max(1, WAVE_CELLS // bins)):
                part = {c: z[a:a + max(1, WAVE_CELLS // bins)] for c, z in cells.items()}
                bound, (w, s), (wl, sl) = self._bounds(self._histogram(rows, frozen, nodes, centre, first, reach, part, a, k), part, weight, drawn, near, whole, least, k + 2, not path)
                c, b = np.nonzero(bound >= least[part["i"]][:, None])
                more = (w[c, b] > self.small_rows) & (len(path) < ZOOMS)
                sub = {"i": part["i"][c], "f": part["f"][c], "low": part["low"][c] + part["step"][c] * b, "step": _step(part["step"][c] / bins),
                       "w": (wl - w)[c, b], "s": (sl - s)[c, b], "bound": bound[c, b]}
                then[a + c[more], b[more]] = n_following + np.arange(more.sum())
                then[a + c[~more], b[~more]] = -2 - n_ends - np.arange((~more).sum())
                n_following, n_ends = n_following + int(more.sum()), n_ends + int((~more).sum())
                following.append({x: z[more] for x, z in sub.items()})
                ends.append({x: z[~more] for x, z in sub.items()})
            path.append((cells["low"], cells["step"], then))
            cells = {x: np.concatenate([z[x] for z in following]) for x in following[0]}
        ties.update({tree: float(n) for (tree, _), n in zip(wanted, near)})
        end = {x: np.concatenate([z[x] for z in ends]) for x in ends[0]}
        kept = np.flatnonzero(end["bound"] >= least[end["i"]])        # later rounds have raised the least gain
        number = np.full(len(end["i"]), -1)
        number[kept] = np.arange(len(kept))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for x, y, w, of in self._walk(batch, frozen, nodes, k):
                    w = w.astype(float)
                    y = (y - centre[of]) * w
                    for f, column in enumerate(np.ascontiguousarray(x.T)):
                        e, some = reach(column, first[f, of], True)
                        e = number[e]
                        e, some = e[e >= 0], some[e >= 0]
                        by = np.lexsort((column[some], e))
                        e, some = e[by], some[by]
                        v = column[some]
                        head = np.flatnonzero(np.r_[True, (e[1:] != e[:-1]) | (v[1:] != v[:-1])]) if len(e) else []
                        if len(head):
                            out.append((e[head], v[head], np.add.reduceat(w[some], head), np.add.reduceat(y[some], head)))
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip("evws", (np.concatenate(z) for z in zip(*out)))))

        spark, i = rows.sparkSession, end["i"][kept]
        before = spark.createDataFrame(pa.table({"e": np.arange(len(kept)), "v": pa.nulls(len(kept), pa.float64()), "w": end["w"][kept], "s": end["s"][kept]}))
        about = spark.createDataFrame(pa.table({"e": np.arange(len(kept)), "i": i, "f": end["f"][kept], "all_w": weight[i], "all_s": whole[i], "least": least[i], "near": near[i]}))
        run = Window.partitionBy("e").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)   # what lies before the end comes first: its value is null
        cuts = rows.mapInArrow(scan, "e long, v double, w double, s double").unionByName(before).groupBy("e", "v").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
        cuts = cuts.select("e", "v", F.sum("w").over(run).alias("w"), F.sum("s").over(run).alias("s")).join(about, "e")
        other_w, other_s = F.col("all_w") - F.col("w"), F.col("all_s") - F.col("s")
        gain = F.col("s") * F.col("s") / F.col("w") + other_s * other_s / other_w - F.col("all_s") * F.col("all_s") / F.col("all_w")
        cuts = cuts.filter(F.col("v").isNotNull() & (other_w > 0)).withColumn("gain", gain).filter("gain >= least")
        cuts = cuts.withColumn("top", F.max("gain").over(Window.partitionBy("i", "f"))).filter("gain >= top - near")
        best: dict[int, tuple[float, int, float]] = {}
        for r in cuts.groupBy("i", "f").agg(F.max("top").alias("top"), F.min("v").alias("v")).orderBy("i", "f").collect():
            if r["i"] not in best or r["top"] > best[r["i"]][0] + near[r["i"]]:
                best[r["i"]] = r["top"], r["f"], r["v"]
        return {wanted[i]: (f, v, max(top, 0.0)) for i, (top, f, v) in best.items()}

    def _histogram(self, rows: DataFrame, frozen: list[Tree], nodes: dict, centre: np.ndarray, first: np.ndarray, reach, part: dict, a: int, k: int) -> np.ndarray:
        """Weight, sum and sum of squares of the labels (less their node's mean) by (cell, bin), for the cells from ``a`` on: one pass."""
        bins, low, step = self.bins, part["low"], part["step"]

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((3, len(low) * bins))
            for batch in batches:
                for x, y, w, of in self._walk(batch, frozen, nodes, k):
                    y, w = y - centre[of], w.astype(float)
                    wy = w * y
                    facts = w, wy, wy * y
                    for f, column in enumerate(np.ascontiguousarray(x.T)):
                        c, some = reach(column, first[f, of], False)
                        if len(c) and (c.min() < a or c.max() >= a + len(low)):
                            some, c = some[(c >= a) & (c < a + len(low))], c[(c >= a) & (c < a + len(low))]
                        if len(c):
                            c = c - a
                            all_in = len(c) == len(y)
                            cell = c * bins + _bin(column if all_in else column[some], low[c], step[c], bins)
                            base = cell.min()      # the cells of a tree and feature are neighbours
                            cell -= base
                            for total, fact in zip(sums, facts):
                                found = np.bincount(cell, fact if all_in else fact[some])
                                total[base:base + len(found)] += found
            cell = np.flatnonzero(sums[0])
            yield pa.RecordBatch.from_pydict({"cell": cell} | {n: z[cell] for n, z in zip("wsq", sums)})

        got = rows.mapInArrow(scan, "cell long, w double, s double, q double").groupBy("cell").agg(*[F.sum(c).alias(c) for c in "wsq"]).toArrow()
        out = np.zeros((3, len(low) * bins))
        out[:, got.column("cell").to_numpy()] = [got.column(c).to_numpy() for c in "wsq"]
        return out.reshape(3, len(low), bins)

    @staticmethod
    def _bounds(hist: np.ndarray, part: dict, weight: np.ndarray, drawn: np.ndarray, near: np.ndarray, whole: np.ndarray, least: np.ndarray, ties: int, fresh: bool):
        """For each (cell, bin) a bound of the gain of cuts after one of its values (-inf: no rows), its sums, and those up to its end.

        Cuts between bins raise ``least``, the gain below which no cut can matter: ties may chain over the features, so it
        lies some ``near`` below the best known gain.  A part with weight a of a bin's rows has a label sum within
        sqrt(w * SS) / 2 of a times their mean, and the gain is convex in (a, sum), so its corners bound it.
        """
        w, s, q = hist
        wl, sl = part["w"][:, None] + np.cumsum(w, axis=1), part["s"][:, None] + np.cumsum(s, axis=1)
        if fresh:
            whole[part["i"]] = sl[:, -1]
            found = tolerance(q.sum(axis=1) - sl[:, -1] ** 2 / wl[:, -1], drawn[part["i"]])
            near[part["i"]] = np.where(near[part["i"]] < 0, found, near[part["i"]])
        all_w, all_s = weight[part["i"]][:, None], whole[part["i"]][:, None]

        def share(total, n):
            return np.divide(total * total, n, out=np.zeros_like(total), where=n > 0)

        floor = all_s * all_s / all_w
        gain = np.where((w > 0) & (wl < all_w), share(sl, wl) + share(all_s - sl, all_w - wl) - floor, -np.inf)
        np.maximum.at(least, part["i"], gain.max(axis=1) - ties * near[part["i"]])
        spread = np.maximum(w * q - s * s, 0.0) + 1e-13 * w * q      # w * SS of the bin's labels, and what rounding may hide
        off, all_in = np.sqrt(spread) / 2, (np.abs(s) + np.sqrt(spread)) ** 2
        all_in = np.divide(all_in, w, out=np.zeros_like(w), where=w > 0)   # of sum * sum / weight, over all parts of the bin
        left, right, both = [], [], []
        for n, total in ((wl - w, sl - s), (wl, sl)):
            for t in (total - off, total + off):
                left.append(share(t, n))
                right.append(share(all_s - t, all_w - n))
                both.append(left[-1] + right[-1])
        begins, finishes = wl - w <= 0, wl >= all_w      # nothing before or behind the bin
        apart = np.where(begins, all_in, np.max(left, axis=0)) + np.where(finishes, all_in, np.max(right, axis=0))
        bound = np.where(begins | finishes, apart, np.max(both, axis=0)) - floor
        return np.where(w > 0, bound, -np.inf), (w, s), (wl, sl)

    def _bottoms(self, rows: DataFrame, tops: list[Tree], bottom: list[tuple[int, int]], k: int, ties: dict[int, float]) -> DataFrame:
        """The subtrees: drawn rows dealt by (tree, node), each node grown in one task."""
        nodes = {}
        for tree, node in bottom:
            nodes.setdefault(tree, {})[node] = node
        schema = "tree int, node int, w int, y double, " + ", ".join(f"x{j} double" for j in range(k))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, wanted in nodes.items():
                    for x, y, w, of in self._walk(batch, tops, {tree: wanted}, k):
                        yield pa.RecordBatch.from_pydict({"tree": pa.array(np.full(len(y), tree, np.int32)), "node": pa.array(of.astype(np.int32)),
                                                          "w": pa.array(w.astype(np.int32)), "y": y} | {f"x{j}": x[:, j] for j in range(k)})

        depths = [_depths(t) for t in tops]
        cap = self.max_depth

        def grown(table: pa.Table) -> pa.Table:
            tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
            x = np.column_stack([table.column(f"x{j}").to_numpy() for j in range(k)])
            made, gains = grow(x, table.column("y").to_numpy(), table.column("w").to_numpy().astype(np.float64), None if cap is None else cap - int(depths[tree][node]), ties.get(tree))
            return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()), "packed": [made.pack()], "gains": [gains.tolist()]})

        # little data is much work here, so tasks go by the nodes: a shuffle of this number is not coalesced by its bytes
        dealt = rows.mapInArrow(deal, schema).repartition(min(len(bottom), BOTTOM_TASKS), "tree", "node")
        return dealt.groupBy("tree", "node").applyInArrow(grown, _SUBTREE)


_SUBTREE = "tree int, node int, packed binary, gains array<double>"


def _depths(tree: Tree) -> np.ndarray:
    out = np.zeros(len(tree.feature), np.int64)
    for i in np.flatnonzero(tree.feature >= 0):  # children stand after their parents
        out[tree.left[i]] = out[tree.left[i] + 1] = out[i] + 1
    return out


class PureForestModel:
    """A grown forest: the tops (small), and the stored table of subtrees."""

    def __init__(self, features: list[str], tops: list[Tree], path: str, importances: np.ndarray):
        self.features, self.tops, self.path, self.importances = features, tops, path, importances

    def subtrees(self, spark) -> DataFrame:
        return spark.read.parquet(self.path)

    def transform(self, frame: DataFrame) -> DataFrame:
        """Adds ``prediction``: the mean over the trees (null where a feature is null)."""
        spark, k, tops = frame.sparkSession, len(self.features), self.tops
        below = self.subtrees(spark).select("tree", "node", "packed")
        has_below: dict[int, set[int]] = {}
        for r in below.select("tree", "node").collect():   # as many as the open ends of the tops
            has_below.setdefault(r["tree"], set()).add(r["node"])
        row = F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row")
        xs = [F.col(f"`{c}`").cast("double").alias(f"x{j}") for j, c in enumerate(self.features)]
        if not has_below:
            return self._by_tops(frame.select(*xs, row))
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lapline-scored-{uuid.uuid4().hex}"
        frame.select(row, *xs, F.monotonically_increasing_id().alias("_id")).write.parquet(path)
        rows = spark.read.parquet(path)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, names = _matrix(batch, k), batch.column(k)
                total, n = np.zeros(len(x)), np.zeros(len(x), np.int64)    # over the trees whose tops hold the row's leaf
                for tree, top in enumerate(tops):
                    node = top.leaves(x)
                    done = ~np.isin(node, list(has_below.get(tree, ())))
                    total[done] += top.value[node[done]]
                    n += done
                    some = np.flatnonzero(~done)
                    if len(some):
                        yield pa.RecordBatch.from_pydict({"tree": pa.array(np.full(len(some), tree, np.int32)), "node": pa.array(node[some].astype(np.int32)),
                                                          "packed": pa.nulls(len(some), pa.binary()), "_id": names.take(pa.array(some)), "value": pa.nulls(len(some), pa.float64()),
                                                          "n": pa.array(np.zeros(len(some), np.int64))} | {f"x{j}": x[some, j] for j in range(k)})
                some = np.flatnonzero(n)
                if len(some):
                    yield pa.RecordBatch.from_pydict({"tree": pa.nulls(len(some), pa.int32()), "node": pa.nulls(len(some), pa.int32()), "packed": pa.nulls(len(some), pa.binary()),
                                                      "_id": names.take(pa.array(some)), "value": total[some], "n": n[some]}
                                                     | {f"x{j}": x[some, j] for j in range(k)})

        schema = "tree int, node int, packed binary, _id long, value double, n long, " + ", ".join(f"x{j} double" for j in range(k))
        asked = rows.select(*[f"x{j}" for j in range(k)], "_id").dropna().mapInArrow(deal, schema)
        done = asked.filter("value IS NOT NULL").select("_id", "value", "n")
        empty = [F.lit(None).cast("long").alias("_id"), F.lit(None).cast("double").alias("value"), F.lit(0).cast("long").alias("n"),
                 *[F.lit(0.0).alias(f"x{j}") for j in range(k)]]
        met = asked.filter("value IS NULL").unionByName(below.select("tree", "node", "packed", *empty))
        met = met.repartition("tree", "node").sortWithinPartitions("tree", "node", F.col("_id").isNotNull())

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            subtree = None
            for batch in batches:
                kind, x, names = batch.column(2), np.column_stack([batch.column(6 + j).to_numpy() for j in range(k)]), batch.column(3)
                heads = np.flatnonzero(kind.is_valid().to_numpy(zero_copy_only=False)).tolist()
                for a, b in zip([-1, *heads], [*heads, len(kind)]):
                    if a >= 0:
                        subtree = Tree.unpack(kind[a].as_py())
                    if b > a + 1:
                        some = x[a + 1:b]
                        yield pa.RecordBatch.from_pydict({"_id": names.slice(a + 1, b - a - 1), "value": subtree.value[subtree.leaves(some)]})

        scored = met.mapInArrow(score, "_id long, value double").withColumn("n", F.lit(1).cast("long"))
        if any(set(np.flatnonzero(t.feature < 0).tolist()) - has_below.get(tree, set()) for tree, t in enumerate(tops)):    # else every row goes on below
            scored = scored.unionByName(done)
        means = scored.groupBy("_id").agg((F.sum("value") / F.sum("n")).alias("prediction"))
        return rows.join(means, "_id", "left").select("row.*", "prediction")

    def _by_tops(self, rows: DataFrame) -> DataFrame:
        """The mean over trees that end in their tops: a map over the rows, nothing is stored or shuffled."""
        k, tops = len(self.features), self.tops

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch, k)
                mean = np.mean([top.value[top.leaves(x)] for top in tops], axis=0)
                yield pa.RecordBatch.from_arrays([batch.column(k), pa.array(mean, mask=np.isnan(x).any(axis=1))], ["row", "prediction"])

        made = T.StructType([rows.schema["row"], T.StructField("prediction", T.DoubleType())])
        return rows.mapInArrow(score, made).select("row.*", "prediction")
