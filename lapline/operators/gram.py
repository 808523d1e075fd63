"""Least squares from moment matrices (M02, M03, M07-M10): every fold, prefix and polynomial from one pass.

The sums of products of a model's terms are aggregated once by group (fold, or training and test rows).  A model that leaves
a group out is solved from the total less that group's matrix, in a few numbers on the driver; a last pass scores all
models together.  So the jobs are three, however many models and folds there are: covariances, matrices, errors.

A polynomial in some features is one in any full linear transform of them.  The features of a model are first
made uncorrelated (from their covariances), so the matrices stay well posed where features are nearly collinear.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL = "final_time"
RCOND = 1e-14          # directions below this share of the largest are left out


@dataclass(frozen=True)
class LeastSquares:
    """A polynomial of ``degree`` in ``features`` (degree 1: linear), with an intercept."""

    features: tuple[str, ...]
    degree: int = 1

    def fit(self, frame: DataFrame, label: str = LABEL) -> LeastSquaresModel:
        found = Moments.of(frame.withColumn("_all", F.lit(0)), [self], "_all", label)
        return LeastSquaresModel(found.bases[self.features], self.degree, found.solve(self, set()))


@dataclass(frozen=True)
class Basis:
    """Uncorrelated combinations of features: ``(x - centre) @ turn``; and their products up to a degree."""

    features: tuple[str, ...]
    centre: np.ndarray
    turn: np.ndarray

    def terms(self, degree: int) -> list[tuple[int, ...]]:
        """Lower degrees first, so those of a lower degree are the first ones."""
        return [t for d in range(1, degree + 1) for t in combinations_with_replacement(range(self.turn.shape[1]), d)]

    def design(self, x: np.ndarray, degree: int) -> np.ndarray:
        """Rows of (1, terms)."""
        u = (x - self.centre) @ self.turn
        return np.column_stack([np.ones(len(x)), *[np.prod(u[:, t], axis=1) for t in self.terms(degree)]])

    def prediction(self, degree: int, weights: np.ndarray) -> Column:
        u = [sum((F.lit(float(w)) * (F.col(f"`{c}`") - F.lit(float(m))) for c, m, w in zip(self.features, self.centre, column)), F.lit(0.0))
             for column in self.turn.T]
        out = F.lit(float(weights[0]))
        for w, term in zip(weights[1:], self.terms(degree)):
            product = F.lit(float(w))
            for i in term:
                product = product * u[i]
            out = out + product
        return out


@dataclass(frozen=True)
class LeastSquaresModel:
    basis: Basis
    degree: int
    weights: np.ndarray    # intercept, then the terms

    def transform(self, frame: DataFrame) -> DataFrame:
        """Adds ``prediction``, one expression of the columns (null where a feature is null)."""
        return frame.withColumn("prediction", self.basis.prediction(self.degree, self.weights))


def _bases(frame: DataFrame, sets: list[tuple[str, ...]]) -> dict[tuple[str, ...], Basis]:
    """One aggregation: means and covariances of the features that stand in one set."""
    column = {c: F.col(f"`{c}`").cast("double") for s in sets for c in s}
    pairs = sorted({(a, b) for s in sets for a in s for b in s if a <= b})
    got = frame.agg(*[F.avg(column[c]).alias(f"m{i}") for i, c in enumerate(column)], *[F.covar_pop(column[a], column[b]).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]).first()
    mean = {c: got[f"m{i}"] or 0.0 for i, c in enumerate(column)}
    cov = {p: got[f"c{i}"] or 0.0 for i, p in enumerate(pairs)}
    out = {}
    for s in sets:
        c = np.array([[cov[min(a, b), max(a, b)] for b in s] for a in s])
        size = np.sqrt(np.diag(c))
        size[size == 0] = 1.0
        values, vectors = np.linalg.eigh(c / size / size[:, None])
        good = values > RCOND * max(values[-1], 1e-300)
        out[s] = Basis(s, np.array([mean[x] for x in s]), vectors[:, good] / np.sqrt(values[good]) / size[:, None])
    return out


@dataclass
class Moments:
    """For each set of features the sums of products of (1, terms, label), by group of rows."""

    bases: dict[tuple[str, ...], Basis]
    degrees: dict[tuple[str, ...], int]
    groups: dict[int, dict[tuple[str, ...], np.ndarray]]

    @cached_property
    def features(self) -> list[str]:
        return sorted({c for s in self.bases for c in s})

    def columns(self, features: tuple[str, ...]) -> list[int]:
        return [self.features.index(c) for c in features]

    def selected(self, frame: DataFrame, group: str, label: str) -> DataFrame:
        return frame.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(self.features)],
                            F.col(f"`{label}`").cast("double").alias("y"), F.col(f"`{group}`").cast("int").alias("g")).dropna()

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(self.features)
        return np.column_stack([batch.column(i).to_numpy() for i in range(n)]), batch.column(n).to_numpy(), batch.column(n + 1).to_numpy()

    @classmethod
    def of(cls, frame: DataFrame, specs: list[LeastSquares], group: str, label: str = LABEL) -> Moments:
        degrees: dict[tuple[str, ...], int] = {}
        for s in specs:
            degrees[s.features] = max(s.degree, degrees.get(s.features, 1))
        found = cls(_bases(frame, list(degrees)), degrees, {})

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                x, y, of = found.read(batch)
                for s, d in degrees.items():
                    z = np.column_stack([found.bases[s].design(x[:, found.columns(s)], d), y])
                    for g in np.unique(of):
                        some = z[of == g]
                        total.setdefault((int(g), s), np.zeros((z.shape[1],) * 2))[...] += some.T @ some
            keys = list(total)
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in keys], pa.int32()), pa.array([list(degrees).index(s) for _, s in keys], pa.int32()),
                                              pa.array([total[k].ravel().tolist() for k in keys], pa.list_(pa.float64()))], names=["g", "s", "m"])

        cells = found.selected(frame, group, label).mapInArrow(sums, "g int, s int, m array<double>").select("g", "s", F.posexplode("m").alias("i", "x"))
        flat: dict[tuple[int, int], dict[int, float]] = {}
        for r in cells.groupBy("g", "s", "i").agg(F.sum("x").alias("x")).collect():   # groups x sets x terms squared numbers
            flat.setdefault((r["g"], r["s"]), {})[r["i"]] = r["x"]
        for (g, s), values in flat.items():
            size = int(round(len(values) ** 0.5))
            found.groups.setdefault(g, {})[list(degrees)[s]] = np.array([values[i] for i in range(size * size)]).reshape(size, size)
        return found

    def solve(self, spec: LeastSquares, without: set[int]) -> np.ndarray:
        """Weights (intercept, terms of ``spec``) over the rows of all groups but those."""
        n = 1 + len(self.bases[spec.features].terms(spec.degree))
        kept = [m[spec.features] for g, m in self.groups.items() if g not in without]
        if not kept:
            return np.zeros(n)
        total = sum(kept)
        a, b = total[:n, :n], total[:n, -1]
        size = np.sqrt(np.maximum(np.diag(a), 1e-300))
        values, vectors = np.linalg.eigh(a / size / size[:, None])
        good = values > RCOND * max(values[-1], 1e-300)
        return (vectors[:, good] / values[good]) @ (vectors[:, good].T @ (b / size)) / size

    def label_spread(self, group: int) -> float:
        """The label's sum of squares about its mean in a group."""
        m = next(iter(self.groups.get(group, {}).values()), None)
        return 0.0 if m is None else m[-1, -1] - m[0, -1] ** 2 / m[0, 0]


def errors(frame: DataFrame, found: Moments, models: list[tuple[LeastSquares, int, np.ndarray]], group: str, label: str = LABEL) -> list[tuple[float, float, float]]:
    """For each (model, group, weights) the rows of the group, the sum of absolute and of squared errors: one pass."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(models), 3))
        for batch in batches:
            x, y, of = found.read(batch)
            z = {s: found.bases[s].design(x[:, found.columns(s)], d) for s, d in found.degrees.items()}
            for i, (spec, g, w) in enumerate(models):
                e = z[spec.features][of == g][:, :len(w)] @ w - y[of == g]
                out[i] += len(e), np.abs(e).sum(), e @ e
        yield pa.RecordBatch.from_pydict({"i": np.arange(len(models)), "n": out[:, 0], "a": out[:, 1], "q": out[:, 2]})

    rows = found.selected(frame, group, label).mapInArrow(scan, "i long, n double, a double, q double")
    got = {r["i"]: (r["n"], r["a"], r["q"]) for r in rows.groupBy("i").agg(*[F.sum(c).alias(c) for c in "naq"]).collect()}
    return [got.get(i, (0.0, 0.0, 0.0)) for i in range(len(models))]


def cross_validated(frame: DataFrame, specs: dict[str, LeastSquares], fold: str = "fold", label: str = LABEL) -> dict[str, float]:
    """Mean over the folds of the mean absolute error on the fold, fitted without it."""
    found = Moments.of(frame, list(specs.values()), fold, label)
    models = [(name, spec, g) for name, spec in specs.items() for g in sorted(found.groups)]
    told = errors(frame, found, [(spec, g, found.solve(spec, {g})) for _, spec, g in models], fold, label)
    return {name: sum(a / n for (m, _, _), (n, a, _) in zip(models, told) if m == name) / max(1, len(found.groups)) for name in specs}


def held_out(frame: DataFrame, specs: dict[str, LeastSquares], test: str = "is_test", label: str = LABEL) -> dict[str, tuple[float, float, float | None]]:
    """MAE, RMSE and R² on the test rows (``test`` true), fitted on the others."""
    found = Moments.of(frame, list(specs.values()), test, label)
    told = errors(frame, found, [(spec, 1, found.solve(spec, {1})) for spec in specs.values()], test, label)
    spread = found.label_spread(1)
    return {name: (a / n, (q / n) ** 0.5, 1 - q / spread if spread > 0 else None) for name, (n, a, q) in zip(specs, told) if n}
