"""Many penalised logistic regressions fitted together: one scan of the rows per optimiser step.

Cross-validation fits the same rows under every grid point, and MLlib decodes, summarises and copies
them anew for each fit: 30 times for five folds and six points. Here the standardised rows are laid out
once as matrix blocks (numpy, one fold to a block), and a scan gives the mean log-loss and its
gradient for all fits that wait for one, as matrix products. The optimisers are MLlib's kind, L-BFGS with
a strong Wolfe line search, or OWL-QN with backtracking where there is an L1 part, with the same start,
history, constants and stopping rule, so a fit ends where MLlib's ends. They run on the driver on vectors
of one number per feature, each as a generator that yields a point and is sent its loss and gradient.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1024              # rows of a matrix block, about 130 kB at 15 features
PARTITION_ROWS = 500_000       # most rows of a task
HISTORY = 10                   # corrections an optimiser keeps


# ------------------------------------------------------------------ the rows ---
def blocks(scaled: DataFrame, label: str, fold: str, rows: int) -> DataFrame:
    """``fold, y, z``: up to BLOCK_ROWS labels and standardised rows of one fold, as bytes of doubles.

    The blocks are dealt evenly over the tasks, however the input was split; ``rows`` is their rows in all.
    """
    def pack(batches):
        kept: dict[int, list] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy()
            y = batch.column(1).to_numpy()
            z = batch.column(2).flatten().to_numpy().reshape(len(y), -1)
            if not np.isfinite(z).all():
                raise ValueError("a training row has a NaN or infinite feature")
            for k in np.unique(folds):
                mine = folds == k
                kept.setdefault(int(k), []).append((y[mine], z[mine]))
                if sum(len(a) for a, _ in kept[int(k)]) >= BLOCK_ROWS:
                    yield from out(int(k), kept.pop(int(k)))
        for k, parts in kept.items():
            yield from out(k, parts)

    def out(k, parts):
        y, z = np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
        cuts = range(0, len(y), BLOCK_ROWS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k] * len(cuts), pa.int32()), pa.array([y[i:i + BLOCK_ROWS].tobytes() for i in cuts], pa.binary()),
             pa.array([z[i:i + BLOCK_ROWS].tobytes() for i in cuts], pa.binary())], ["fold", "y", "z"])

    columns = scaled.select(F.col(fold).cast("int"), F.col(label).cast("double"), vector_to_array("scaledFeatures"))
    tasks = max(2 * scaled.sparkSession.sparkContext.defaultParallelism, -(-rows // PARTITION_ROWS))
    return columns.mapInArrow(pack, "fold int, y binary, z binary").repartition(tasks)


def block_sums(y: np.ndarray, z: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of sums over a block, a column per fit: the log-loss, the residuals, the residuals times each feature.

    With m = z w + b the loss is max(m, 0) - y m + log(1 + exp(-|m|)). The logarithms are taken of products of
    up to 512 factors, each between 1 and 2; arrays are used again in place, as the passes over them are the cost.
    """
    m = z @ w
    m += b
    e = np.abs(m)
    loss = 0.5 * (m.sum(axis=0) + e.sum(axis=0)) - y @ m
    np.exp(np.negative(e, out=e), out=e)
    factors = e + 1.0
    for i in range(0, len(y), 512):
        loss += np.log(np.multiply.reduce(factors[i:i + 512], axis=0))
    r = np.subtract(1.0, e, out=e)
    r /= factors
    r = np.copysign(r, m, out=r)       # tanh(m / 2)
    r *= 0.5
    r += (0.5 - y)[:, None]
    return np.vstack([loss, r.sum(axis=0), z.T @ r])


def sums(blocked: DataFrame, points: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, np.ndarray]:
    """Per held-out fold, and per column of its weights: the log-loss, the residuals and the residuals
    times each feature, summed over the rows of the other folds, in one scan.

    ``points`` has (weights, one column per fit; intercepts) per held-out fold. A task
    returns one row of that many sums, and they are added in the order of the tasks.
    """
    order = sorted(points)
    width = {k: points[k][0].shape[1] for k in order}

    def partial(batches):
        total = {k: np.zeros((points[k][0].shape[0] + 2, width[k])) for k in order}
        for batch in batches:
            for f, yb, zb in zip(*(c.to_pylist() if i == 0 else c for i, c in enumerate(batch.columns))):
                fits = [k for k in order if k != f]
                if not fits:
                    continue
                y = np.frombuffer(yb.as_buffer())
                z = np.frombuffer(zb.as_buffer()).reshape(len(y), -1)
                found = block_sums(y, z, np.hstack([points[k][0] for k in fits]), np.hstack([points[k][1] for k in fits]))
                for k, part in zip(fits, np.split(found, np.cumsum([width[k] for k in fits])[:-1], axis=1)):
                    total[k] += part
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([total[k].ravel() for k in order]).tobytes()], pa.binary())], ["s"])

    rows = blocked.mapInArrow(partial, "s binary").collect()
    flat = np.sum([np.frombuffer(bytes(r["s"])) for r in rows], axis=0)
    sizes = [(points[k][0].shape[0] + 2) * width[k] for k in order]
    return {k: part.reshape(-1, width[k]) for k, part in zip(order, np.split(flat, np.cumsum(sizes)[:-1]))}


# ------------------------------------------------------------- the optimisers ---
class _SearchFailed(Exception):
    pass


def _direction(grad: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton step: the two loops over the latest (step, gradient change), newest first."""
    d, a = grad.copy(), []
    for s, y in history:
        a.append((s @ d) / (s @ y))
        d -= a[-1] * y
    if history:
        s, y = history[0]
        if not s @ y >= 0:
            raise _SearchFailed
        d *= (s @ y) / (y @ y)
    for (s, y), ai in zip(reversed(history), reversed(a)):
        d += (ai - (y @ d) / (s @ y)) * s
    return -d


def _between(low, high) -> float:
    """The minimum of the cubic through two (step, loss, slope), kept off the ends."""
    (lt, lf, ld), (rt, rf, rd) = sorted((low, high))
    d1 = ld + rd - 3.0 * (lf - rf) / (lt - rt)
    inside = d1 * d1 - ld * rd
    d2 = math.sqrt(inside) if inside >= 0 else math.nan
    t = rt - (rt - lt) * (rd + d2 - d1) / (rd - ld + 2.0 * d2)
    return min(max(t, lt + 0.1 * (rt - lt)), lt + 0.9 * (rt - lt)) if t == t else t


def _strong_wolfe(x, value, grad, d, t):
    """The step length along ``d``, from ``t``: sufficient decrease 1e-4, slope 0.9."""
    slope = grad @ d
    if slope > 0:
        raise _SearchFailed

    def at(t):
        f, g = yield x + t * d
        return t, f, g @ d

    def zoom(low, high):
        for _ in range(10):
            c = yield from at(_between(low, high))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
            else:
                if abs(c[2]) <= 0.9 * abs(slope):
                    return c[0]
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _SearchFailed

    low = (0.0, value, slope)
    for i in range(10):
        c = yield from at(t)
        if not math.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            return (yield from zoom(low, c))
        if abs(c[2]) <= 0.9 * abs(slope):
            return t
        if c[2] >= 0:
            return (yield from zoom(c, low))
        low, t = c, t * 1.5
    raise _SearchFailed


def _backtrack(point, adjusted, value, slope, d, t, shrink):
    """The step length along ``d``, from ``t``: shrunk or grown (by 2.1) until loss and slope fit."""
    for _ in range(20):
        x = point(t)
        f, g = adjusted(x, *(yield x))
        s = g @ d
        if f > value + t * slope * 1e-4:
            factor = shrink
        elif s < 0.9 * slope:
            factor = 2.1
        elif abs(s) > 0.9 * abs(slope):
            factor = shrink
        else:
            return t
        last, t = t, t * factor
        if not 1e-10 <= t <= 1e10:
            raise _SearchFailed
    return last


def minimise(x: np.ndarray, l1: np.ndarray | None, max_iter: int, tol: float) -> Iterator:
    """Yields points and is sent their (loss, gradient); returns the point it ends at.

    With ``l1`` (a weight per coordinate) the loss gets the L1 part here. It ends after ``max_iter`` steps,
    when the loss fell by at most ``tol`` times the first one below the highest of the last 20, or when the
    gradient is at most ``tol`` times the loss; a search that fails twice running, without history, ends it too.
    """
    def adjusted(x, f, g):
        if l1 is None:
            return f, g
        at_zero = np.where(g - l1 > 0, g - l1, np.where(g + l1 < 0, g + l1, 0.0))
        return f + float(np.abs(l1 * x).sum()), np.where(l1 == 0, g, np.where(x == 0, at_zero, g + np.sign(x) * l1))

    value, grad = yield x
    full, steep = adjusted(x, value, grad)
    first, seen, history, failed, step = full, [math.inf], [], False, 0
    while step < max_iter and np.linalg.norm(steep) > max(tol * abs(full), 1e-8):
        try:
            d = _direction(steep, history)
            if l1 is None:
                t = yield from _strong_wolfe(x, value, grad, d, 1.0 if step else 1.0 / np.linalg.norm(d))
                if t * np.linalg.norm(grad) < 1e-10:
                    raise _SearchFailed
                new = x + t * d
            else:
                d = np.where(d * steep < 0, d, 0.0)
                orthant = np.where(x != 0, np.sign(x), np.sign(-steep))

                def point(t, x=x, d=d, orthant=orthant):
                    moved = x + t * d
                    return np.where(np.sign(moved) == np.sign(orthant), moved, 0.0)
                t = yield from _backtrack(point, adjusted, full, steep @ d, d,
                                          1.0 if step else 0.05 / np.linalg.norm(grad), 0.5 if step else 0.1)
                new = point(t)
            value, after = yield new
        except _SearchFailed:
            if failed:
                break
            failed, history = True, []
            continue
        failed = False
        history = [(new - x, after - grad), *history][:HISTORY]
        x, grad, step = new, after, step + 1
        full, steep = adjusted(x, value, grad)
        seen = [*seen, full][-20:]
        if abs(full - max(seen)) <= tol * abs(first):
            break
    return x


# ------------------------------------------------------------------ the fits ---
@dataclass
class Part:
    """What is left when a fold is held out: its rows by label, and its mean and 1 / stddev (0 for a
    constant column) in the units of the blocks."""
    negatives: int
    positives: int
    mean: np.ndarray
    inverse: np.ndarray


def fit_all(blocked: DataFrame, parts: dict[int, Part], grid: Sequence[tuple[float, float]], max_iter: int,
            tol: float) -> dict[int, list[tuple[np.ndarray, float]]]:
    """(coefficients on the part's standardised features, intercept) per held-out fold and (reg, elastic net)."""
    def fit(part: Part, reg: float, enet: float):
        n, wide = part.negatives + part.positives, len(part.mean)
        start = np.append(np.zeros(wide), math.log(part.positives / part.negatives))
        l1 = np.append(np.full(wide, reg * enet), 0.0) if reg * enet else None
        return minimise(start, l1, max_iter, tol), n, reg * (1.0 - enet)

    running = {(k, i): fit(part, *g) for k, part in parts.items() for i, g in enumerate(grid)}
    wanted = {at: next(search) for at, (search, _, _) in running.items()}
    ended: dict[tuple[int, int], np.ndarray] = {}
    known: dict[tuple[int, int], tuple[bytes, tuple]] = {}
    while wanted:
        points, columns = {}, {}
        for k in parts:
            columns[k] = [i for i in range(len(grid)) if (k, i) in wanted]
            if columns[k]:
                w = np.array([wanted[k, i][:-1] for i in columns[k]]).T * parts[k].inverse[:, None]
                points[k] = w, np.array([wanted[k, i][-1] for i in columns[k]]) - parts[k].mean @ w
        found = sums(blocked, points)
        for k in points:
            loss, residual, cross = found[k][0], found[k][1], found[k][2:]
            slopes = (cross - parts[k].mean[:, None] * residual) * parts[k].inverse[:, None]
            for c, i in enumerate(columns[k]):
                search, n, l2 = running[k, i]
                x = wanted.pop((k, i))
                answer = (float(loss[c] / n + 0.5 * l2 * x[:-1] @ x[:-1]),
                          np.append(slopes[:, c] / n + l2 * x[:-1], residual[c] / n))
                known[k, i] = x.tobytes(), answer
                try:
                    x = search.send(answer)
                    while x.tobytes() == known[k, i][0]:   # the point that a line search ended at
                        x = search.send(known[k, i][1])
                    wanted[k, i] = x
                except StopIteration as e:
                    ended[k, i] = e.value
    return {k: [(ended[k, i][:-1], float(ended[k, i][-1])) for i in range(len(grid))] for k in parts}
