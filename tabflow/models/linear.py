"""Linear models from per-fold sufficient statistics.

A least-squares family (OLS, ridge, lasso, elastic net, and the mean
predictor) needs only the first and second moments of ``(x, y)``.  So one
batch pass over the data gives, for every fold, the row count, the means and
the centred cross products (``X'X`` per batch in numpy, partials merged on
executors); the statistics of a training fold are *total minus fold*.  Every
grid point of every fold is then a d x d problem solved on the driver (d =
number of features).  RMSE and R^2 of a held-out fold follow from its own
moments; only the absolute errors need a second batch pass, in which every
batch is multiplied by the coefficients of all configurations at once.

Two passes over the data for a whole linear grid, independent of the number
of folds and grid points and without copies of rows; memory per task is
O(d^2).  Population scaling (M1) is folded into the solve: the scaled problem
is expressed through the same moments, and the coefficients are mapped back to
raw units, so scoring is one arithmetic expression per row.

Objectives (scikit-learn conventions, which the reference uses):
  ols    min ||y - Xw - b||^2                      (minimum-norm solution)
  ridge  min ||y - Xw - b||^2 + a ||w||^2
  lasso  min 1/(2n) ||y - Xw - b||^2 + a ||w||_1
  enet   min 1/(2n) ||y - Xw - b||^2 + a r ||w||_1 + a (1 - r) / 2 ||w||^2
  mean   predicts the training mean
with X population-standardized on the training rows when ``scale``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import q

KINDS = ("mean", "ols", "ridge", "lasso", "enet")


@dataclass(frozen=True)
class LinearConfig:
    name: str
    kind: str = "ols"
    alpha: float = 0.0
    l1_ratio: float = 1.0
    scale: bool = True

    def params(self) -> dict:
        return {"kind": self.kind, "alpha": self.alpha, "l1_ratio": self.l1_ratio, "scale": self.scale}


@dataclass
class Moments:
    """Moments of shifted columns: n, sums, cross-product sums."""
    n: float
    sx: np.ndarray
    sy: float
    sxx: np.ndarray
    sxy: np.ndarray
    syy: float

    def __sub__(self, o: "Moments") -> "Moments":
        return Moments(self.n - o.n, self.sx - o.sx, self.sy - o.sy, self.sxx - o.sxx,
                       self.sxy - o.sxy, self.syy - o.syy)

    def __add__(self, o: "Moments") -> "Moments":
        return Moments(self.n + o.n, self.sx + o.sx, self.sy + o.sy, self.sxx + o.sxx,
                       self.sxy + o.sxy, self.syy + o.syy)


def complete_rows(df: DataFrame, features, target: str, on_null: str = "error") -> DataFrame:
    """Rows usable for a fit and its metrics.

    ``on_null="error"`` (default) leaves the rows as they are: the passes over
    them count rows with a null feature or target and fail with that count.
    ``"drop"`` leaves those rows out; every result carries the number of rows used.
    """
    if on_null == "error":
        return df
    if on_null != "drop":
        raise ValueError(f"on_null must be 'error' or 'drop', not {on_null!r}")
    cond = q(target).isNotNull()
    for c in features:
        cond = cond & q(c).isNotNull()
    return df.where(cond)


def check_complete(df: DataFrame, features, target: str) -> None:
    """Fail with the number of rows that have a null feature or target (one aggregate)."""
    bad = q(target).isNull()
    for c in features:
        bad = bad | q(c).isNull()
    n = df.agg(F.count_if(bad).alias("n")).first()["n"]
    if n:
        raise ValueError(f"{n} rows have a null feature or target; fill them or pass on_null='drop'")


SUM_GROUPS = 8               # tasks that add up the partial moments before the driver does
ROWS_AT_ONCE = 8192


@dataclass
class Centred:
    """Count, means and centred cross products of z = (x..., y); merging keeps full precision."""
    n: float
    mean: np.ndarray
    cross: np.ndarray

    @classmethod
    def of(cls, z: np.ndarray) -> "Centred":
        mean = z.mean(axis=0)
        d = z - mean
        return cls(float(len(z)), mean, d.T @ d)

    def __add__(self, o: "Centred") -> "Centred":
        n = self.n + o.n
        step = o.mean - self.mean
        return Centred(n, self.mean + step * (o.n / n), self.cross + o.cross + np.outer(step, step) * (self.n * o.n / n))

    def row(self, fold) -> dict:
        return {"fold": fold, "n": self.n, "mean": self.mean.tolist(), "cross": self.cross.ravel().tolist()}


_PARTIAL = "fold int, n double, mean array<double>, cross array<double>"


def _matrix(batch, names) -> np.ndarray:
    """The named columns as a rows x columns array; nulls become NaN."""
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names], axis=1)


def _partials(rows: dict) -> pa.RecordBatch:
    got = [m.row(f) for f, m in rows.items()]
    return pa.RecordBatch.from_pydict({
        "fold": pa.array([r["fold"] for r in got], pa.int32()), "n": pa.array([r["n"] for r in got], pa.float64()),
        "mean": pa.array([r["mean"] for r in got], pa.list_(pa.float64())),
        "cross": pa.array([r["cross"] for r in got], pa.list_(pa.float64()))})


def _merge(rows: dict, fold, part: Centred) -> None:
    rows[fold] = rows[fold] + part if fold in rows else part


def fold_moments(df: DataFrame, features, target: str, fold_col: str | None) -> tuple[dict, tuple]:
    """``({fold: Moments}, shift)`` from one batch pass; ``shift`` is the mean of all rows.

    Every task multiplies its batches (``X'X`` per fold, d x d at any width) and
    emits one partial per fold; a few tasks add the partials up, the driver the
    last of them.  Partials are centred and merged pairwise, so large means do
    not cancel.  A null or NaN in a feature or the target fails with the count.
    """
    features = list(features)
    d = len(features)
    names = [f"x{i}" for i in range(d)] + ["y"]
    rows = df.select((q(fold_col) if fold_col else F.lit(0)).cast("int").alias("fold"),
                     *[q(c).cast("double").alias(n) for c, n in zip(features, names)], q(target).cast("double").alias("y"))

    def multiply(batches):
        sums, bad = {}, 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                z, fold = _matrix(part, names), part.column("fold").to_numpy(zero_copy_only=False)
                fine = ~np.isnan(z).any(axis=1)
                bad += int((~fine).sum())
                z, fold = z[fine], fold[fine]
                for f in np.unique(fold):
                    _merge(sums, int(f), Centred.of(z[fold == f]))
        if bad:                       # a partial without a fold carries the count of bad rows
            sums[None] = Centred(float(bad), np.zeros(0), np.zeros(0))
        if sums:
            yield _partials(sums)

    def add_up(batches):
        sums = {}
        for batch in batches:
            for f, n, mean, cross in zip(*(batch.column(c).to_pylist() for c in ("fold", "n", "mean", "cross"))):
                mean, cross = np.array(mean), np.array(cross)
                part = Centred(n, mean, cross.reshape(len(mean), len(mean)) if len(mean) else cross)
                _merge(sums, f, part) if f is not None else sums.__setitem__(None, Centred(
                    n + (sums[None].n if None in sums else 0.0), mean, cross))
        if sums:
            yield _partials(sums)

    partial = rows.mapInArrow(multiply, _PARTIAL)
    few = partial.repartition(SUM_GROUPS).mapInArrow(add_up, _PARTIAL)
    found, bad = {}, 0
    for r in few.collect():           # at most SUM_GROUPS x folds partials
        mean = np.array(r["mean"])
        if r["fold"] is None:
            bad += int(r["n"])
        else:
            _merge(found, r["fold"], Centred(r["n"], mean, np.array(r["cross"]).reshape(len(mean), len(mean))))
    if bad:
        raise ValueError(f"{bad} rows have a null feature or target; fill them or pass on_null='drop'")
    total = None
    for m in found.values():
        total = m if total is None else total + m
    if total is None:
        return {}, (np.zeros(d), 0.0)
    centre = total.mean
    out = {}
    for f, m in found.items():
        off = m.mean - centre
        full = m.cross + m.n * np.outer(off, off)
        out[f] = Moments(m.n, m.n * off[:d], float(m.n * off[d]), full[:d, :d], full[:d, d], float(full[d, d]))
    return out, (centre[:d], float(centre[d]))


def _sweeps(G, c, w, l1, l2, n):
    """``n`` cyclic coordinate-descent sweeps in place; returns the largest step."""
    diag = np.diag(G)
    step = 0.0
    for _ in range(n):
        step = 0.0
        for j in range(len(c)):
            if diag[j] <= 0:
                continue
            r = c[j] - G[j] @ w + diag[j] * w[j]
            new = np.sign(r) * max(abs(r) - l1, 0.0) / (diag[j] + l2)
            step = max(step, abs(new - w[j]))
            w[j] = new
    return step


def _admm(G: np.ndarray, c: np.ndarray, l1: float, l2: float, iters: int = 5000,
          tol: float = 1e-10) -> np.ndarray:
    """ADMM warm start: x-steps solve ``(G + (l2 + rho) I) x = c + rho (z - u)``
    with one precomputed inverse, z-steps soft-threshold, so the iterate has
    exact zeros that give the support and signs for the exact solve."""
    d = len(c)
    if d == 0:
        return np.zeros(0)
    rho = max(float(np.mean(np.diag(G))), 1e-12)
    inv = np.linalg.inv(G + (l2 + rho) * np.eye(d))
    z, u = np.zeros(d), np.zeros(d)
    thr = l1 / rho
    for _ in range(iters):
        x = inv @ (c + rho * (z - u))
        v = x + u
        z_new = np.sign(v) * np.maximum(np.abs(v) - thr, 0.0)
        u = u + x - z_new
        if (np.max(np.abs(x - z_new)) <= tol * max(1.0, float(np.max(np.abs(z_new))))
                and np.max(np.abs(z_new - z)) <= tol * max(1.0, float(np.max(np.abs(z_new))))):
            z = z_new
            break
        z = z_new
    return z


def _coordinate_descent(G: np.ndarray, c: np.ndarray, l1: float, l2: float,
                        max_rounds: int = 500) -> np.ndarray:
    """min 1/2 w'Gw - c'w + l1 |w|_1 + l2/2 |w|^2 (G, c already divided by n).

    Cyclic coordinate descent finds the support and signs; the active set
    is then solved exactly (``(G_AA + l2 I) w_A = c_A - l1 sign(w_A)``,
    minimum norm when collinear features make ``G_AA`` singular) and
    accepted only if it satisfies the optimality conditions.
    """
    d = len(c)
    w = _admm(G, c, l1, l2)
    scale = max(float(np.max(np.abs(c))) if d else 0.0, 1e-300)
    for _ in range(max_rounds):
        _sweeps(G, c, w, l1, l2, 5)
        # rounding leaves ~1e-17 weights on exactly collinear twins; they are not active
        w[np.abs(w) <= 1e-12 * max(float(np.max(np.abs(w))), 1e-300)] = 0.0
        a = np.flatnonzero(w)
        sgn = np.sign(w[a])
        cand = np.zeros(d)
        if len(a):
            cand[a] = np.linalg.lstsq(G[np.ix_(a, a)] + l2 * np.eye(len(a)), c[a] - l1 * sgn, rcond=None)[0]
        grad = c - G @ cand - l2 * cand
        tol = 1e-7 * scale + 1e-12
        inactive = np.setdiff1d(np.arange(d), a)
        if (np.all(np.sign(cand[a]) == sgn) and np.all(np.abs(grad[inactive]) <= l1 + tol)
                and np.all(np.abs(grad[a] - l1 * sgn) <= tol * 10)):
            return cand
    return w


def _pop_std(m: Moments, shift) -> np.ndarray:
    d = len(m.sx)
    cx = shift[0] if shift is not None else np.zeros(d)
    mx = m.sx / m.n
    s = np.sqrt(np.maximum(np.diag(m.sxx - m.n * np.outer(mx, mx)), 0.0) / m.n)
    s[s <= 1e-12 * np.maximum(1.0, np.abs(mx + cx))] = 1.0   # constant column -> divisor 1
    return s


def solve(m: Moments, cfg: LinearConfig, shift=None, scale_std=None) -> tuple[float, np.ndarray]:
    """Coefficients ``(intercept, w)`` in raw units for one configuration.
    ``scale_std``: population stds to scale by instead of the training
    rows' own (the reference's scaler fitted on all rows, T10)."""
    d = len(m.sx)
    cx, cy = shift if shift is not None else (np.zeros(d), 0.0)
    if m.n <= 0:
        return float("nan"), np.zeros(d)
    mx, my = m.sx / m.n, m.sy / m.n
    if cfg.kind == "mean" or d == 0:
        return float(cy + my), np.zeros(d)
    C = m.sxx - m.n * np.outer(mx, mx)           # centered cross-products
    cxy = m.sxy - m.n * mx * my
    if cfg.scale:
        s = np.array(scale_std, dtype=float) if scale_std is not None else _pop_std(m, shift)
    else:
        s = np.ones(d)
    Cs = C / np.outer(s, s)
    cs = cxy / s
    if cfg.kind == "ols":
        ws = np.linalg.lstsq(Cs, cs, rcond=None)[0]
    elif cfg.kind == "ridge":
        ws = np.linalg.solve(Cs + cfg.alpha * np.eye(d), cs)
    elif cfg.kind in ("lasso", "enet"):
        r = 1.0 if cfg.kind == "lasso" else cfg.l1_ratio
        ws = _coordinate_descent(Cs / m.n, cs / m.n, cfg.alpha * r, cfg.alpha * (1.0 - r))
    else:
        raise ValueError(f"unknown linear kind {cfg.kind!r}")
    w = ws / s
    intercept = cy + my - float(w @ (cx + mx))
    return float(intercept), w


def prediction_expr(features, intercept: float, coef) -> F.Column:
    e = F.lit(float(intercept))
    for c, w in zip(features, coef):
        if w != 0.0:
            e = e + F.lit(float(w)) * q(c).cast("double")
    return e


def _absolute_errors(df: DataFrame, features, target: str, fold_col: str, weights: dict) -> dict:
    """``{(config position, fold): sum of |error|}`` from one batch pass.

    ``weights``: ``{fold: (intercepts, d x configs coefficients)}``, bounded by
    configs x folds; each batch is multiplied by its fold's coefficients.
    """
    features = list(features)
    names = [f"x{i}" for i in range(len(features))]
    rows = df.select(q(fold_col).cast("int").alias("fold"), *[q(c).cast("double").alias(n) for c, n in zip(features, names)],
                     q(target).cast("double").alias("y"))
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def errors(batches):
        sums: dict = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                z, fold = _matrix(part, [*names, "y"]), part.column("fold").to_numpy(zero_copy_only=False)
                for f in np.unique(fold):
                    own = z[fold == f]
                    b, w = shared.value[int(f)]
                    e = np.abs(own[:, -1:] - (own[:, :-1] @ w + b)).sum(axis=0)
                    sums[int(f)] = sums.get(int(f), 0.0) + e
        for f, e in sums.items():
            yield pa.RecordBatch.from_pydict({"fold": pa.array([f] * len(e), pa.int32()), "config": pa.array(range(len(e)), pa.int32()),
                                              "e": pa.array(e, pa.float64())})

    out = rows.mapInArrow(errors, "fold int, config int, e double").groupBy("fold", "config").agg(F.sum("e").alias("e"))
    return {(r["config"], r["fold"]): r["e"] for r in out.collect()}


def moment_scores(m: Moments, k: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Correlation and F-score of every feature with the target, and the ``k`` best features in column order (ties to the first)."""
    cov, var, var_y = m.sxy / m.n - m.sx / m.n * m.sy / m.n, np.diag(m.sxx) / m.n - (m.sx / m.n) ** 2, m.syy / m.n - (m.sy / m.n) ** 2
    fine = (var > 0) & (var_y > 0)
    r = np.where(fine, cov / np.sqrt(np.where(fine, var * var_y, 1)), 0.0)
    r2 = r * r
    top = np.finfo(float).max
    scores = np.where(r2 < 1, r2 / np.where(r2 < 1, 1 - r2, 1) * (m.n - 2), top)
    best = sorted(range(len(scores)), key=lambda i: (-round(float(scores[i]), 6), i))[:k]
    return r, scores, sorted(best)


def _solve_selected(m: Moments, cfg: LinearConfig, shift, std, k: int | None) -> tuple[float, np.ndarray]:
    """A fit on the ``k`` features that score best on the same rows; the others have the coefficient 0."""
    if k is None:
        return solve(m, cfg, shift, std)
    at = moment_scores(m, k)[2]
    part = Moments(m.n, m.sx[at], m.sy, m.sxx[np.ix_(at, at)], m.sxy[at], m.syy)
    b, w = solve(part, cfg, (shift[0][at], shift[1]), None if std is None else std[at])
    full = np.zeros(len(m.sx))
    full[at] = w
    return b, full


def cv_linear(df: DataFrame, features, target: str, fold_col: str, configs,
              fit_scope: str = "fold", on_null: str = "error", select_k: int | None = None) -> tuple[DataFrame, dict]:
    """M3 for the linear family: ``(fold_metrics, solutions)``.

    ``fold_metrics``: ``(model, fold, n, rmse, mae, r2)`` for every config and
    fold.  RMSE and R^2 follow from the held-out fold's moments; only the
    absolute errors need a second pass, without copies of rows.
    ``solutions[(name, fold)] = (intercept, coef)`` plus ``solutions[(name,
    None)]`` fitted on all rows.  ``fit_scope``: ``"fold"`` scales on each
    training fold (default, no leak); ``"global"`` scales on all rows first, as
    the reference does (T10).  ``on_null``: see :func:`complete_rows`.
    ``select_k``: every fit uses the k features of best F-score on its own training rows.
    """
    features, configs = list(features), list(configs)
    if fit_scope not in ("fold", "global"):
        raise ValueError(f"fit_scope must be 'fold' or 'global', not {fit_scope!r}")
    data = complete_rows(df, features, target, on_null)
    per_fold, shift = fold_moments(data, features, target, fold_col)
    total = None
    for m in per_fold.values():
        total = m if total is None else total + m
    glob = _pop_std(total, shift) if fit_scope == "global" and total is not None else None
    sol, rows = {}, []
    for cfg in configs if total is not None else ():
        sol[(cfg.name, None)] = _solve_selected(total, cfg, shift, None, select_k)
        for f, m in per_fold.items():
            sol[(cfg.name, f)] = _solve_selected(total - m, cfg, shift, glob, select_k)
    weights = {f: (np.array([sol[(c.name, f)][0] for c in configs]), np.stack([sol[(c.name, f)][1] for c in configs], axis=1))
               for f in per_fold} if configs else {}
    absolute = _absolute_errors(data, features, target, fold_col, weights) if weights else {}
    for i, cfg in enumerate(configs if weights else ()):
        for f, m in sorted(per_fold.items()):
            sse, sst = held_out_sse(m, *sol[(cfg.name, f)], shift)
            r2 = 1.0 - sse / sst if sst > 0 else 1.0 if sse == 0 else 0.0
            rows.append((cfg.name, int(f), int(m.n), float(np.sqrt(sse / m.n)), float(absolute[i, f] / m.n), float(r2)))
    schema = "model string, fold int, n bigint, rmse double, mae double, r2 double"
    return df.sparkSession.createDataFrame(rows, schema), sol


def held_out_sse(m: Moments, intercept: float, coef: np.ndarray, shift) -> tuple[float, float]:
    """Sum of squared errors of a linear model on the rows behind ``m``, and their total sum of squares."""
    cx, cy = shift
    mx, my = m.sx / m.n, m.sy / m.n
    cxx, cxy = m.sxx - m.n * np.outer(mx, mx), m.sxy - m.n * mx * my
    sst = m.syy - m.n * my * my
    off = (cy + my) - intercept - float(coef @ (cx + mx))
    return max(float(sst - 2 * coef @ cxy + coef @ cxx @ coef + m.n * off * off), 0.0), float(sst)


class _LinearParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "feature columns", typeConverter=TypeConverters.toListString)
    coefficients = Param(Params._dummy(), "coefficients", "raw-unit coefficients",
                         typeConverter=TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", typeConverter=TypeConverters.toFloat)
    predictionCol = Param(Params._dummy(), "predictionCol", "output column", typeConverter=TypeConverters.toString)


class LinearFormulaModel(Model, _LinearParams, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted linear model applied as one arithmetic column expression."""

    def __init__(self, inputCols=None, coefficients=None, intercept: float = 0.0,
                 predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(predictionCol="prediction", intercept=0.0, inputCols=[], coefficients=[])
        self._set(inputCols=list(inputCols or []), coefficients=[float(x) for x in (coefficients or [])],
                  intercept=float(intercept), predictionCol=predictionCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return df.withColumn(g(self.predictionCol),
                             prediction_expr(g(self.inputCols), g(self.intercept), g(self.coefficients)))


def fit_linear(df: DataFrame, features, target: str, cfg: LinearConfig,
               prediction_col: str = "prediction", on_null: str = "error") -> LinearFormulaModel:
    """Fit one configuration on all rows (one batch pass)."""
    features = list(features)
    data = complete_rows(df, features, target, on_null)
    per_fold, shift = fold_moments(data, features, target, None)
    if not per_fold:
        raise ValueError("no rows to fit on")
    b, w = solve(per_fold[0], cfg, shift)
    return LinearFormulaModel(features, list(w), b, prediction_col)


class PopulationScalerModel(Model, Params, DefaultParamsReadable, DefaultParamsWritable):
    """M1 as a stage: ``(x - mean) / std_pop`` per named column (constant
    column -> divisor 1), written in place."""
    inputCols = Param(Params._dummy(), "inputCols", "columns", typeConverter=TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "column means", typeConverter=TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population stds", typeConverter=TypeConverters.toListFloat)

    def __init__(self, inputCols=None, means=None, stds=None):
        super().__init__()
        self._setDefault(inputCols=[], means=[], stds=[])
        self._set(inputCols=list(inputCols or []), means=[float(x) for x in (means or [])],
                  stds=[float(x) for x in (stds or [])])

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return df.withColumns({c: (q(c).cast("double") - F.lit(m)) / F.lit(s)
                               for c, m, s in zip(g(self.inputCols), g(self.means), g(self.stds))})


def fit_population_scaler(df: DataFrame, cols) -> PopulationScalerModel:
    """M1 fit: means and population stds of all columns in one aggregate."""
    cols = list(cols)
    row = df.agg(*[F.avg(q(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(q(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    means = [float(row[f"m{i}"] or 0.0) for i in range(len(cols))]
    stds = [float(row[f"s{i}"]) if row[f"s{i}"] else 1.0 for i in range(len(cols))]
    return PopulationScalerModel(cols, means, stds)
