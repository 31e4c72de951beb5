"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation (Golub & Kahan, 1965).

Every step multiplies the centred rows by one vector and the result by their transpose, in one pass over the data:
``p = X t`` and ``z = X' p``. The left vectors are combinations of the rows, ``u = X w``, so that only the small ``w``
is kept, and reorthogonalising against all of them needs ``W' z`` alone. The driver holds vectors of one entry per
dimension and a bidiagonal matrix, whose singular values and vectors give deviations and components.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from formbook.llm.common import other_columns, quoted, row_columns, row_of, schema_after, staged

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
BLOCK_BYTES = 1 << 21  # centred rows of one block, about
SMALL = 1e-13  # against the largest singular value: no direction left


@dataclass
class Whitening:
    """What a fit leaves: exact sums, components by falling eigenvalue, and how well they whiten."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues
    components: np.ndarray  # a row each
    trace: float
    identity_error: float


def usable(embedding: Column) -> Column:
    """Neither null nor with a null or non-finite entry."""
    finite = F.forall(embedding.cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(embedding.isNotNull() & finite, F.lit(False))


def integers(embedding: Column) -> Column:
    """Entries as whole numbers, ``floor(64 c) + 1000000``."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _fit_list(vectors: DataFrame) -> tuple[DataFrame, int, list[int]]:
    """The rows of the commonest length, their number and exact sums per dimension."""
    sizes = vectors.groupBy(F.size("_x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), "d").first()
    if first is None or not first["d"]:
        return vectors.filter(F.lit(False)), 0, []
    d, n = first["d"], first["n"]

    def partial(batches):
        total = np.zeros(d, np.int64)
        for batch in batches:
            total += _matrix(batch.column(0), d).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], ["s"])

    fit = vectors.filter(F.size("_x") == d)
    parts = fit.select("_x").mapInArrow(partial, "s array<long>").collect()  # d numbers a task
    return fit, n, [sum(column) for column in zip(*(r["s"] for r in parts))]


def _blocks(fit: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """Centred rows as blocks of doubles, ``(n x - S) / n``: the difference is exact before it is rounded."""
    total, rows = np.array(sums, np.int64), max(1, BLOCK_BYTES // (8 * len(sums)))

    def pack(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                x = _matrix(batch.slice(lo, rows).column(0), len(total))
                data = ((n * x - total) / n).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    return fit.select("_x").mapInArrow(pack, "data binary")


def _sum_over(blocks: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of a small array computed from each; one array a task reaches the driver."""

    def partial(batches):
        total = None
        for batch in batches:
            for data in batch.column(0):
                part = of(np.frombuffer(data.as_buffer(), np.float64).reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = blocks.mapInArrow(partial, "part binary").collect()
    return np.sum([np.frombuffer(r["part"], np.float64) for r in parts], axis=0)


def _against(basis: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """``vector`` without its parts along the rows of ``basis``; twice, which is enough."""
    for _ in range(2):
        vector = vector - basis.T @ (basis @ vector)
    return vector


def bidiagonalise(
    product: Callable[[np.ndarray], tuple[np.ndarray, float]], d: int, trace: float, k: int, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values, and right vectors as rows, of a matrix with ``d`` columns.

    ``product(t)`` returns ``X'X t`` and ``|X t|^2`` from one pass; ``trace`` is the sum of all squared entries. Stops
    when the leading values have converged and what lies outside the space searched is too small to hold another of
    their size, after ``d`` steps at the latest. A direction that is used up is followed by a random one, so repeated
    values are found as often as they occur.
    """
    random = np.random.default_rng(seed)
    v = random.standard_normal(d)
    v /= np.linalg.norm(v)
    vs, ws, images = np.zeros((0, d)), np.zeros((0, d)), np.zeros((0, d))  # right vectors; u = X w; X'u
    alphas, betas = [], []
    beta, scale = 0.0, np.sqrt(trace)
    while True:
        vs = np.vstack([vs, v])
        t = v - beta * ws[-1] if len(ws) else v
        image, square = product(t)  # p = X t, the image is X'p
        c = ws @ image  # U'p; zero but for rounding
        w, image = t - c @ ws, image - c @ images
        alpha = np.sqrt(max(square - c @ c, 0.0))
        if alpha <= SMALL * scale:
            alpha, w, image = 0.0, np.zeros(d), np.zeros(d)
        else:
            w, image = w / alpha, image / alpha
        ws, images, alphas = np.vstack([ws, w]), np.vstack([images, image]), [*alphas, alpha]
        steps = len(alphas)
        v = _against(vs, image - alpha * v)
        beta = float(np.linalg.norm(v))
        left, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        if steps == d:
            break
        if beta <= SMALL * scale:
            beta, v = 0.0, _against(vs, random.standard_normal(d))
        v /= np.linalg.norm(v)
        outside = trace - float(values @ values)
        settled = steps >= k and (beta * np.abs(left[-1, :k]) <= SMALL * values[0]).all()
        if settled and (outside < values[k - 1] ** 2 or outside <= SMALL * trace):
            break
        betas.append(beta)
    return values[:k], right[:k] @ vs


def fit(vectors: DataFrame, components: int = COMPONENTS, embedding: str = "embedding") -> Whitening:
    """Fit on every usable vector of the commonest length (ties: the shorter).

    Null vectors, those with null or non-finite entries and those of another length take no part. Directions without
    spread, up to rounding, are no components: none at all for an empty table, a single row or equal rows. Entries must
    be below 2**50 in size.
    """
    rows = vectors.filter(usable(quoted(embedding))).select(integers(quoted(embedding)).alias("_x"))
    rows, n, sums = _fit_list(rows)
    d = len(sums)
    none = Whitening(n, sums, np.zeros(0), np.zeros((0, d)), 0.0, 0.0)
    if not n:
        return none
    blocks = staged(_blocks(rows, n, sums), "centred_blocks").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trace = float(_sum_over(blocks, d, lambda x: np.array([np.einsum("ij,ij->", x, x)]))[0])
        if trace <= 0:
            return none

        def product(t: np.ndarray) -> tuple[np.ndarray, float]:
            def both(x: np.ndarray) -> np.ndarray:
                p = x @ t
                return np.append(x.T @ p, p @ p)

            found = _sum_over(blocks, d, both)
            return found[:-1], float(found[-1])

        values, vectors_ = bidiagonalise(product, d, trace, min(components, d))
        kept = values > max(d, 10) * np.finfo(float).eps * values[0]
        values, vectors_ = values[kept], vectors_[kept]
        largest = np.abs(vectors_).argmax(1)
        vectors_ = vectors_ * np.sign(vectors_[np.arange(len(values)), largest])[:, None]
        eigenvalues, k = values**2 / n, len(values)
        into = vectors_.T / np.sqrt(eigenvalues)

        def spread(x: np.ndarray) -> np.ndarray:
            y = x @ into
            return np.concatenate([(y.T @ y).ravel(), y.sum(0)])

        found = _sum_over(blocks, d, spread) / n
        covariance = found[: k * k].reshape(k, k) - np.outer(found[k * k :], found[k * k :])
        return Whitening(n, sums, eigenvalues, vectors_, trace / n, float(np.abs(covariance - np.eye(k)).max()))
    finally:
        blocks.unpersist()


def whitened(vectors: DataFrame, model: Whitening, embedding: str = "embedding") -> DataFrame:
    """A row per usable vector and component, the vector itself left out of the caller's columns.

    ``component`` counts from 1, ``deviation`` is the exact sum over dimensions of ``(n x - S)^2``, an error beyond 38
    digits. Rows that the fit left out are not returned; equal rows are returned one by one. Columns named like the
    added ones, in any case, are replaced.
    """
    added = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    rest = other_columns(vectors, [embedding, *added])
    n, d, k = model.n, len(model.sums), len(model.values)
    into = model.components.T / np.sqrt(model.values)
    total = np.array(model.sums, np.int64)

    def project(batches):
        for batch in batches:
            y = ((n * _matrix(batch.column("_x"), d) - total) / n) @ into
            ends = pa.array(np.arange(0, (len(y) + 1) * k, k, dtype=np.int32))
            scores = pa.ListArray.from_arrays(ends, pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("_deviation"), scores], ["_row", "_deviation", "_y"])

    rows = vectors.filter(usable(quoted(embedding)))
    rows = rows.select(row_of(rest).alias("_row"), integers(quoted(embedding)).alias("_x")).filter(F.size("_x") == d)
    if not k:
        rows = rows.filter(F.lit(False))
    exact = F.zip_with(
        "_x", F.array(*[F.lit(s).cast("decimal(38,0)") for s in model.sums]).cast("array<decimal(38,0)>"),
        lambda x, s: (F.lit(n).cast("decimal(19,0)") * x.cast("decimal(19,0)") - s).cast("decimal(18,0)"),
    )
    squares = F.aggregate(
        exact, F.lit(0).cast("decimal(38,0)"), lambda a, b: (a + b * b).cast("decimal(38,0)")
    )
    rows = rows.select("_row", "_x", squares.alias("_deviation"))
    scored = rows.mapInArrow(project, schema_after(rows, ["_row", "_deviation"], "_y array<double>"))
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    return scored.select("_row", "_deviation", F.posexplode("_y").alias("_at", "_value")).select(
        *row_columns(rest),
        (F.col("_at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        F.col("_deviation").alias("deviation"),
        F.col("_value").alias("whitened"),
        F.get(shares, "_at").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
