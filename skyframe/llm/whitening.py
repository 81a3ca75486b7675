"""Whitening by an incremental eigendecomposition of the covariance.

Every task goes through its vectors once and keeps the eigenpairs of what it has seen: a new
vector is a centred rank-one update, whose eigenvalues solve a secular equation. Spectra of
tasks are merged by as many rank-one updates as they have eigenvectors, and one for the means.
A last pass over the data refines the merged basis by Rayleigh and Ritz.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.common import materialise, schema_of
from skyframe.llm.vectors import as_matrix, column_of, is_whole, longest, padded
from skyframe.session import discard

EPS = np.finfo(float).eps
#: Rows of one merge step; the number of steps grows with the logarithm of the tasks.
FAN_IN = 8
STEPS = 100


# --- one rank-one update --------------------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + rho z z'`` (``d`` rising, no ``z`` 0, ``rho`` positive).

    Returned as the nearest entry of ``d`` below or above and the signed distance from it, which
    stays accurate where the eigenvalue itself would cancel. Each root is bracketed by its poles;
    a step solves the two-pole rational model of the equation, and is a bisection where that
    leaves the bracket.
    """
    p, squares = len(d), rho * z * z
    above = np.append(d[1:], d[-1] + squares.sum())
    gap = above - d
    half = 0.5 * gap
    upto = np.tril(np.ones((p, p), bool))
    at_half = 1 + (squares / (d[None, :] - d[:, None] - half[:, None])).sum(1)
    right = at_half < 0
    right[-1] = False
    base = np.where(right, np.arange(p) + 1, np.arange(p))
    origin = d[base]
    apart = d[None, :] - origin[:, None]
    lo, hi = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    hi[-1] = gap[-1]
    below, over = d - origin, above - origin
    mu = 0.5 * (lo + hi)
    for _ in range(STEPS):
        with np.errstate(all="ignore"):
            inverse = 1 / (apart - mu[:, None])
            terms = squares * inverse
            slopes = terms * inverse
            f = 1 + terms.sum(1)
            weight = 1 + np.abs(terms).sum(1)
            left = np.where(upto, slopes, 0.0).sum(1)
            rest = slopes.sum(1) - left
            lo, hi = np.where(f < 0, mu, lo), np.where(f > 0, mu, hi)
            done = (np.abs(f) <= EPS * weight) | (hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if done.all():
                break
            one, two = below - mu, over - mu
            a = (one + two) * f - one * two * (left + rest)
            b = one * two * f
            c = f - one * left - two * rest
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = mu + step
            bad = ~np.isfinite(new) | (new <= lo) | (new >= hi)
            new = np.where(bad, 0.5 * (lo + hi), new)
        mu = np.where(done, mu, new)
    return base, mu


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs (rising) of ``vectors diag(values) vectors' + rho u u'`` for a ``rho`` over 0.

    Deflation: an entry of ``vectors' u`` that is 0 to working precision leaves its pair as it
    is; of two values that agree to that precision, a rotation makes one entry 0.
    """
    z = vectors.T @ u
    size = float(z @ z) * rho
    if not size > 0:
        return values, vectors
    tiny = 8 * EPS * (abs(values).max() + size)
    if np.any(np.diff(values) <= tiny):
        vectors = vectors.copy()
        last = -1
        for j in np.flatnonzero(rho * z * z > tiny * EPS):
            if last >= 0:
                length = np.hypot(z[last], z[j])
                c, s = z[j] / length, z[last] / length
                if abs((values[j] - values[last]) * c * s) <= tiny:
                    first, second = vectors[:, last].copy(), vectors[:, j].copy()
                    vectors[:, last], vectors[:, j] = c * first - s * second, s * first + c * second
                    z[last], z[j] = 0.0, length
            last = j
    live = np.flatnonzero(rho * np.abs(z) * np.sqrt(size / rho) > tiny)
    if not len(live):
        return values, vectors
    d, zs = values[live], z[live]
    base, mu = secular_roots(d, zs, rho)
    # Differences of root i and pole j; then z for which these roots are exact, so that the
    # eigenvectors are orthogonal however close the roots are.
    away = (d[base][:, None] - d[None, :]) + mu[:, None]
    away = np.where(away == 0, np.copysign(EPS * EPS, zs)[None, :], away)
    p = len(d)
    poles = np.empty((p, p))
    spread = d[:, None] - d[None, :]
    i, j = np.arange(p)[:, None], np.arange(p)[None, :]
    poles = np.where(i < j, spread, np.vstack([spread[1:], np.ones((1, p))]))
    exact = np.sqrt(np.abs(np.prod(away / poles, axis=0)) / rho)
    turned = np.copysign(exact, zs)[None, :] / -away
    turned /= np.linalg.norm(turned, axis=1)[:, None]
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[live] = d[base] + mu
    new_vectors[:, live] = vectors[:, live] @ turned.T
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


@dataclass
class Spectrum:
    """Number, mean and eigenpairs of the centred scatter of the vectors seen."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, length: int) -> Spectrum:
        return cls(0, np.zeros(length), np.zeros(length), np.eye(length))

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        n, away = self.n + other.n, other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * (other.n / n))
        self.mean = self.mean + away * (other.n / n)
        self.n = n


# --- over a table ---------------------------------------------------------------------------

_PART = T.StructType([T.StructField("slot", T.LongType()), T.StructField("n", T.LongType()), T.StructField("state", T.BinaryType())])


def _part(slot: int, n: int, state: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"slot": [slot], "n": [n], "state": [state.astype("<f8").tobytes()]})


def _written(s: Spectrum) -> np.ndarray:
    return np.concatenate([s.mean, s.values, s.vectors.ravel()])


def _spectrum(n: int, state: bytes, length: int) -> Spectrum:
    x = np.frombuffer(state, "<f8")
    return Spectrum(int(n), x[:length].copy(), x[length : 2 * length].copy(), x[2 * length :].reshape(length, length).copy())


def _merge_spectra(length: int, pdf: pd.DataFrame) -> tuple[int, np.ndarray]:
    out = Spectrum.empty(length)
    for n, state in zip(pdf["n"], pdf["state"], strict=True):
        out.merge(_spectrum(n, state, length))
    return out.n, _written(out)


def _add_up(pdf: pd.DataFrame) -> tuple[int, np.ndarray]:
    return int(pdf["n"].sum()), sum(np.frombuffer(s, "<f8") for s in pdf["state"])


def _per_task(df: DataFrame, fold: Callable[[Iterator[np.ndarray]], tuple[int, np.ndarray]], length: int) -> DataFrame:
    """One row per task from the matrices of column ``x`` that it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, state = fold(as_matrix(column_of(b, "x"), length) for b in batches)
        if n:
            yield pa.RecordBatch.from_pandas(_part(TaskContext.get().partitionId(), n, state), preserve_index=False)

    return df.select("x").mapInArrow(run, _PART)


def _combined(parts: DataFrame, merge: Callable[[pd.DataFrame], tuple[int, np.ndarray]], label: str) -> tuple[int, bytes]:
    """All rows merged, ``FAN_IN`` a task and step, in the order of their slots; one row reaches the driver."""

    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        return _part(int(pdf["slot"].iloc[0]) // FAN_IN, *merge(pdf.sort_values("slot")))

    at = materialise(parts, label)
    left = at.agg(F.max("slot")).first()[0] + 1
    while left > 1:
        new = materialise(at.groupBy(F.floor(F.col("slot") / FAN_IN)).applyInPandas(step, _PART), label)
        discard(at)
        at, left = new, -(-left // FAN_IN)
    row = at.first()
    discard(at)
    return row["n"], bytes(row["state"])


def _spectra(length: int, shift: np.ndarray, matrices: Iterator[np.ndarray]) -> tuple[int, np.ndarray]:
    s = Spectrum.empty(length)
    for m in matrices:
        for x in m - shift:
            s.add(x)
    return s.n, _written(s)


def _products(centre: np.ndarray, basis: np.ndarray, matrices: Iterator[np.ndarray]) -> tuple[int, np.ndarray]:
    """Number, sums and products of the coordinates of centred vectors in a basis."""
    n, width = 0, basis.shape[1]
    sums, products = np.zeros(width), np.zeros((width, width))
    for m in matrices:
        y = (m - centre) @ basis
        n, sums, products = n + len(y), sums + y.sum(0), products + y.T @ y
    return n, np.concatenate([sums, products.ravel()])


def _covariance(n: int, state: bytes, width: int) -> np.ndarray:
    x = np.frombuffer(state, "<f8")
    mean = x[:width] / n
    out = x[width:].reshape(width, width) / n - np.outer(mean, mean)
    return (out + out.T) / 2


@dataclass
class Whitening:
    """A fit: ``n`` vectors with exact sums (above ``offset``), components by falling eigenvalue."""

    n: int
    offset: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The mean, less the offset."""
        return np.array([s / self.n for s in self.sums]) if self.n else np.zeros(len(self.sums))


def exact_sums(fit: DataFrame, length: int, offset: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each entry less ``offset``: one row per entry reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = as_matrix(column_of(b, "x"), length, np.int64) - offset
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(length), pa.int64()), pa.array([len(m)] * length, pa.int64()), pa.array(m.sum(0))],
                ["entry", "n", "total"],
            )

    found = fit.select("x").mapInArrow(add, "entry long, n long, total long").groupBy("entry")
    rows = found.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {r["entry"]: int(r["total"]) for r in rows}
    return (rows[0]["n"] if rows else 0), [total.get(i, 0) for i in range(length)]


def fit_whitening(fit: DataFrame, length: int, offset: int = 0, most: int = 16) -> Whitening:
    """Learn from the whole vectors ``x`` (array of long, ``length`` entries each) of ``fit``, a written table.

    What a task holds and sends is the square of ``length``, however many vectors it reads.
    Components whose eigenvalue is 0 to working precision are left out, so fewer than ``most``
    can come back; none for an empty table or a single distinct vector.
    """
    n, sums = exact_sums(fit, length, offset)
    out = Whitening(n, offset, sums, np.zeros(0), np.zeros((length, 0)), 0.0)
    if not n:
        return out
    shift = np.array([float(offset + round(s / n)) for s in sums])
    parts = _per_task(fit, partial(_spectra, length, shift), length)
    merged = _spectrum(*_combined(parts, partial(_merge_spectra, length), "spectra"), length)
    # Rayleigh and Ritz in the merged basis: exact up to rounding, since it spans the whole space.
    basis = np.linalg.qr(merged.vectors[:, ::-1])[0]
    moved = _per_task(fit, partial(_products, out.centre + offset, basis), length)
    values, turned = np.linalg.eigh(_covariance(*_combined(moved, _add_up, "ritz"), length))
    values, vectors = values[::-1], (basis @ turned)[:, ::-1]
    real = values > length * EPS * max(values[0], 0)
    out.trace = float(values.sum())
    out.values, out.components = values[real][:most], vectors[:, real][:, :most]
    return out


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list, less the identity; 0 without components."""
    if not len(w.values):
        return 0.0
    parts = _per_task(fit, partial(_products, w.centre + w.offset, w.components / np.sqrt(w.values)), len(w.sums))
    width = len(w.values)
    return float(np.abs(_covariance(*_combined(parts, _add_up, "checked"), width) - np.eye(width)).max())


def _deviations(m: np.ndarray, w: Whitening) -> list[int | None]:
    """The exact sum of squares of ``n x - S``; null where it is too large for a long."""
    reach = max((abs(s) for s in w.sums), default=0) + w.n * int(np.abs(m).max(initial=0))
    if reach * reach * max(1, m.shape[1]) < 1 << 63:
        away = w.n * m - np.array(w.sums, np.int64)
        return (away * away).sum(1).tolist()
    away = w.n * m.astype(object) - np.array(w.sums, object)
    return [s if s < 1 << 63 else None for s in (away * away).sum(1)]


def whiten(rows: DataFrame, w: Whitening, keep: str = "vec_id") -> DataFrame:
    """``keep, component, deviation, whitened, explained`` for each vector ``x`` and component."""
    length, width = len(w.sums), len(w.values)
    scaled, centre = w.components / np.sqrt(w.values), w.centre
    share = w.values / w.trace if width else w.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not width or not b.num_rows:
                continue
            m = as_matrix(column_of(b, "x"), length, np.int64) - w.offset
            each = np.repeat(np.arange(len(m)), width)
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(b, keep).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(m))),
                    pa.array(_deviations(m, w), pa.int64()).take(pa.array(each)),
                    pa.array(((m - centre) @ scaled).ravel()),
                    pa.array(np.tile(share, len(m))),
                ],
                [keep, "component", "deviation", "whitened", "explained"],
            )

    more = [("component", T.IntegerType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType())]
    return rows.select(keep, "x").mapInArrow(run, schema_of(rows.select(keep), *more))


def whiten_embeddings(
    rows: DataFrame, scale: int = 64, offset: int = 1_000_000, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error`` for each row and component.

    An entry ``c`` counts as ``floor(scale c) + offset``. Rows whose vector is null or holds an
    entry that is null or not finite are left out; shorter vectors count as filled up with zeros.
    The fit list holds each distinct vector once, so repeated rows and copies change nothing, but
    every row comes back, also one with a null id. An empty table, one without usable vectors and
    one of a single distinct vector give no rows. Other columns are ignored.
    """
    given = rows.select(F.col(id_col), F.col(vector_col).alias("x")).where(is_whole(F.col("x")))
    length = longest(given, "x")
    whole = F.transform("x", lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))
    ready = given.select(id_col, padded(whole, length, F.lit(offset).cast("long")).alias("x"))
    fit = materialise(ready.select("x").distinct(), "fit-list")
    w = fit_whitening(fit, length, offset, most)
    error = identity_error(fit, w)
    out = whiten(ready, w, id_col)
    return out.select(
        id_col,
        "component",
        F.lit(w.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
    )
