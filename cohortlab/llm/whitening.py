"""Embedding whitening by shifted CholeskyQR (operator 12).

The centred rows A are never gathered. Each pass over them sums the Gram matrix
of Q = A R1^-1 R2^-1 .. by task and then by matrix entry; its Cholesky factor is the next
R, and rows meet the factors by triangular solves. The first factor is shifted, so
that badly conditioned rows do not break it; each pass brings Q nearer to
orthonormal. The composed factor R = .. R2 R1 holds all that is needed: A = Q R, so
the singular values and right vectors of R, a d x d matrix, are those of A.

The driver and the tasks hold d x d matrices, d being the vectors' length, whatever
the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortlab.llm.tables import written

SCALE, OFFSET = 64, 1_000_000   #: entry c becomes floor(SCALE * c) + OFFSET
COMPONENTS = 16
MAX_PASSES = 6                  #: Gram passes; three suffice for a full-rank table
EPS = np.finfo(np.float64).eps
LIMIT = 2.0 ** 50               #: scaled entries beyond it have no exact long


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is there and holds finite entries only, as doubles."""
    v = F.transform(F.col(column), lambda c: c.cast("double"))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return vectors.withColumn(column, v).where(F.col(column).isNotNull() & (F.size(column) > 0)
                                               & ~F.exists(column, odd))


def _grid(column: str) -> Column:
    """The long vector of a double vector; an entry without an exact long is an error."""
    far = F.exists(column, lambda c: F.abs(c * SCALE) > LIMIT)
    cells = F.transform(column, lambda c: (F.floor(c * SCALE) + OFFSET).cast("long"))
    return F.when(far, F.raise_error(F.lit("an embedding entry is too large for exact whole numbers"))
                  .cast("array<bigint>")).otherwise(cells)


def _matrix(column) -> np.ndarray:
    """The rows of a list column as one array; all have the same length."""
    col = pa.concat_arrays([column])
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def solve_right(a: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """A R^-1 by forward substitution over the columns of the upper triangle R, all rows at once."""
    out = np.empty_like(a)
    for j in range(a.shape[1]):
        out[:, j] = (a[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


@dataclass
class Whitening:
    """The fit: n distinct x-vectors with sums S, components (columns) and their eigenvalues."""
    n: int
    sums: np.ndarray             # int64, by dimension
    components: np.ndarray       # d x k, unit columns by falling eigenvalue
    eigenvalues: np.ndarray      # of the covariance, all d
    passes: int = 0
    identity_error: float | None = None

    @property
    def explained(self) -> np.ndarray:
        total = self.eigenvalues.sum()
        return self.eigenvalues / total if total > 0 else np.full(len(self.eigenvalues), np.nan)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact in whole numbers."""
        return self.n * x - self.sums

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the components, over the roots of their eigenvalues; NaN where that is 0."""
        k = self.components.shape[1]
        spread = np.sqrt(self.eigenvalues[:k])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(spread > 0, (self.centred(x) / self.n) @ self.components / spread, np.nan)


def _gram(fit: DataFrame, of_rows, size: int) -> np.ndarray:
    """Sum over the table's vectors of q'q, for q = of_rows(x): a triangle per task, added up by
    entry in Spark."""
    rows_at, cols_at = np.tril_indices(size)

    def run(batches):
        total = np.zeros((size, size))
        for b in batches:
            if b.num_rows:
                q = of_rows(_matrix(b.column(0)))
                total += q.T @ q
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows_at), dtype=np.int32)),
                                              pa.array(total[rows_at, cols_at])], names=["at", "value"])

    found = (fit.select("x").mapInArrow(run, "at int, value double").groupBy("at")
             .agg(F.sum("value").alias("value"))).toArrow()  # size^2 / 2 numbers
    flat = np.zeros(len(rows_at))
    flat[found["at"].to_numpy()] = found["value"].to_numpy()
    out = np.zeros((size, size))
    out[rows_at, cols_at] = flat
    return out + np.tril(out, -1).T


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, int, np.ndarray]:
    """(table of the distinct `x`, their number, their sums by dimension): equal vectors are
    combined in every task before they meet, so a vector that half the rows share is no hot key."""
    fit = written(rows.select("x").distinct(), "whitening-fit")
    got = (fit.select(F.posexplode("x").alias("at", "v")).groupBy("at")
           .agg(F.count("*").alias("n"), F.sum("v").alias("s")).orderBy("at").collect())  # a row per dimension
    return fit, (got[0]["n"] if got else 0), np.array([r["s"] for r in got], np.int64)


def factor(gram, max_passes: int = MAX_PASSES, n: int = 1) -> tuple[np.ndarray, int]:
    """(R, passes) with R'R = A'A, of centred rows A known by `gram(factors)`: the Gram
    matrix of A R1^-1 R2^-1 ...

    The first factor is that of G + s I, with the shift s = 11 (n d + d (d + 1)) u |G| of shifted CholeskyQR.
    Passes go on until Q'Q is the identity to rounding. Where the rows do not span all dimensions it never is:
    a factor that breaks down is shifted too, and the last Gram matrix enters R by
    its symmetric root, which is exact for every rank.
    """
    factors: list[np.ndarray] = []
    composed = None
    while True:
        g = gram(factors)
        d = len(g)
        composed = np.eye(d) if composed is None else composed
        if factors and np.abs(g - np.eye(d)).max() <= 64 * d * EPS or len(factors) >= max_passes - 1:
            break
        norm = max(np.linalg.norm(g, 2), np.finfo(float).tiny)
        shift = 11 * (n * d + d * (d + 1)) * EPS / 2 * norm if not factors else 0.0
        while True:
            try:
                upper = np.linalg.cholesky(g + shift * np.eye(d)).T
                break
            except np.linalg.LinAlgError:
                shift = max(10 * shift, d * EPS * norm)
        factors.append(upper)
        composed = upper @ composed
    values, vectors = np.linalg.eigh(g)
    root = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
    return root @ composed, len(factors) + 1


def fit_whitening(rows: DataFrame, components: int = COMPONENTS, max_passes: int = MAX_PASSES) -> Whitening | None:
    """The whitening of the distinct vectors in column `x` (arrays of long, of one length); None without rows."""
    fit, n, sums = distinct_vectors(rows)
    if not n:
        return None
    d = len(sums)
    plain = Whitening(n, sums, np.zeros((d, 0)), np.zeros(d))

    def gram(factors):
        def of_rows(x):
            q = plain.centred(x) / n
            for upper in factors:
                q = solve_right(q, upper)
            return q
        return _gram(fit, of_rows, d)

    r, passes = factor(gram, max_passes, n)
    _, singular, right = np.linalg.svd(r)
    singular[singular <= singular[0] * d * EPS * 8] = 0.0  # a direction without spread
    k = min(components, d)
    found = Whitening(n, sums, right[:k].T.copy(), singular ** 2 / n, passes)
    spread = int((found.eigenvalues[:k] > 0).sum())
    if spread:
        # whiten() centres the rows, so their products are those of the covariance
        cov = _gram(fit, lambda x: found.whiten(x)[:, :spread], spread) / n
        found.identity_error = float(np.abs(cov - np.eye(spread)).max())
    return found


def whiten(vectors: DataFrame, components: int = COMPONENTS, max_passes: int = MAX_PASSES,
           key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per usable row and component: `vec_id`, `component` (from 1), `n`, `deviation`
    (sum over dimensions of (n x - S)^2, exact), `whitened`, `explained`, `identity_error`.

    Rows whose vector is null, empty or holds a null or non-finite entry are left out. Vectors have the
    length that most have (of equally many, the longer); others are left out too. Repeated rows repeat
    and count once in the fit; a null key stays null. A direction without spread has explained 0 and
    whitened null; if all vectors are equal, explained and identity_error are null. An empty table gives
    no rows; other columns are not read. A deviation beyond a long is an error.
    """
    rows = usable(vectors.select(key, column), column)
    lengths = rows.groupBy(F.size(column).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    schema = (f"`{key}` {vectors.schema[key].dataType.simpleString()}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    x = rows.where(F.size(column) == lengths["d"]).select(key, _grid(column).alias("x"))
    model = fit_whitening(x, components, max_passes)
    k = model.components.shape[1]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cells = _matrix(b.column(1))
            off = model.centred(cells)
            if (np.square(off.astype(np.float64)).sum(axis=1) >= 2.0 ** 62).any():
                raise OverflowError("a deviation is beyond a long")
            deviation = np.square(off).sum(axis=1)
            whitened = model.whiten(cells).ravel()
            share = np.tile(model.explained[:k], b.num_rows)
            worst = pa.scalar(model.identity_error, pa.float64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                 pa.array(np.full(b.num_rows * k, model.n, np.int64)), pa.array(np.repeat(deviation, k)),
                 pa.array(whitened, from_pandas=True), pa.array(share, from_pandas=True),
                 pa.repeat(worst, b.num_rows * k)],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, schema)
