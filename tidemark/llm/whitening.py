"""Whitening of embeddings by the leading eigenvectors of their covariance, found by a block Jacobi-Davidson method.

The covariance is never formed: all that is asked of the table is its product with a block of directions, the sum of
``z (z . u)`` over the centred vectors z, which each task adds up for its share and Spark adds up for all tasks. The
driver holds the search space, some multiples of (dimensions x components) numbers, whatever the number of vectors.

A step takes the Ritz pairs of the search space, locks those whose residual is at the limit of double precision, and
widens the space by a correction for every other one: an approximate solution, by some steps of MINRES on all of them at
once, of the equation projected off the Ritz vectors. A space that grows too wide restarts with its best Ritz vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import with_id, without_id
from tidemark.session import cut_lineage

# Numbers in one packed block of vectors, and rows of output made at a time.
BLOCK_NUMBERS = 1 << 19
OUTPUT_ROWS = 1 << 16
# Extra directions beside those asked for, steps of MINRES per correction, width of the space in blocks of directions.
GUARDS = 8
INNER_STEPS = 6
SPACE_BLOCKS = 4
OUTER_STEPS = 200

EPS = float(np.finfo(np.float64).eps)

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Moments:
    """Number of vectors, exact sums per dimension, and the trace of the covariance."""

    n: int
    sums: list[int]
    trace: float


def packed(vectors: DataFrame, scale: int, shift: int) -> tuple[DataFrame, int]:
    """Blocks of vectors as 64-bit numbers x = floor(scale * c) + shift (``ids``, ``x``), and their width.

    Of the vectors without null and non-finite entries those of the commonest width stay (the wider of two equally
    common ones); others have no place in one covariance. Empty vectors are left out.
    """
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    usable = vectors.where((F.size("embedding") > 0) & finite)
    width = F.size("embedding")
    common = usable.groupBy(width.alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width"))
    first = common.first()
    d = first["width"] if first else 1
    rows_at_once = max(1, BLOCK_NUMBERS // d)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(start, rows_at_once)
                steps = np.floor(part.column(1).flatten().to_numpy(zero_copy_only=False) * scale)
                if np.abs(steps).max(initial=0) >= 2.0**62:
                    raise ValueError("a component does not fit a 64-bit number of steps")
                x = steps.astype(np.int64) + shift
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], ["ids", "x"]
                )

    rows = usable.where(width == d).select(with_id("vec_id"), F.col("embedding").cast("array<double>"))
    return cut_lineage(rows.mapInArrow(pack, "ids binary, x binary"), "blocks"), d


def _scaled_deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: in 64 bits where it fits, else in Python's whole numbers."""
    largest = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    if n * largest < 1 << 62:
        return n * x - sums
    return n * x.astype(object) - sums.astype(object)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return _scaled_deviations(x, n, sums).astype(np.float64) / n


def _blocks_of(batches: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for ids, x in zip(batch["ids"], batch["x"], strict=True):
            yield np.frombuffer(ids, np.int64), np.frombuffer(x, np.int64).reshape(-1, width)


def _summed(blocks: DataFrame, width: int, of_block: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all blocks of a small matrix per block, as ``{(i, j): value}`` in a dense array.

    Each task sends one matrix; Spark adds them by entry.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for _, x in _blocks_of(batches, width):
            part = of_block(x)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape).reshape(2, -1)
            yield pd.DataFrame({"i": i, "j": j, "value": total.ravel()})

    cells = blocks.mapInPandas(run, f"i int, j int, value {kind}").groupBy("i", "j").agg(F.sum("value").alias("value"))
    got = cells.toPandas()
    if got.empty:
        return np.zeros((0, 0))
    out = np.zeros((int(got["i"].max()) + 1, int(got["j"].max()) + 1), dtype=np.int64 if kind == "bigint" else np.float64)
    out[got["i"], got["j"]] = got["value"]
    return out


def moments(blocks: DataFrame, width: int) -> Moments:
    first = _summed(blocks, width, lambda x: np.append(x.sum(axis=0), len(x))[None, :], "bigint")
    if not first.size:
        return Moments(0, [0] * width, 0.0)
    n, sums = int(first[0, -1]), first[0, :-1]
    squares = _summed(blocks, width, lambda x: np.square(_centred(x, n, sums)).sum().reshape(1, 1), "double")
    return Moments(n, [int(s) for s in sums], float(squares[0, 0]) / n)


def covariance_product(blocks: DataFrame, width: int, m: Moments) -> Product:
    """Directions (width x b) to covariance times directions: one pass over the vectors."""
    sums = np.array(m.sums, dtype=np.int64)

    def product(directions: np.ndarray) -> np.ndarray:
        def of_block(x: np.ndarray) -> np.ndarray:
            z = _centred(x, m.n, sums)
            return z.T @ (z @ directions)

        return _summed(blocks, width, of_block, "double") / m.n

    return product


def minres(apply: Product, right: np.ndarray, steps: int, tolerance: float = 0.01) -> np.ndarray:
    """Some steps of MINRES for every column at once; ``apply`` maps a block of columns by their own operators.

    A column whose residual fell below ``tolerance`` of its start, or whose space is exhausted, stays as it is.
    """
    beta = np.linalg.norm(right, axis=0)
    start = beta.copy()
    live = beta > 0
    v = right / np.where(live, beta, 1.0)
    v_old, w, w_old, x = (np.zeros_like(right) for _ in range(4))
    c, c_old = np.ones(len(beta)), np.ones(len(beta))
    s, s_old = np.zeros(len(beta)), np.zeros(len(beta))
    eta, beta = beta.copy(), np.zeros(len(beta))
    for _ in range(steps):
        if not live.any():
            break
        p = apply(v)
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v - beta * v_old
        beta_next = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        rho1 = np.hypot(delta, beta_next)
        live &= rho1 > 0
        safe = np.where(rho1 > 0, rho1, 1.0)
        rho2, rho3 = s * alpha + c_old * c * beta, s_old * beta
        c_old, s_old, c, s = c, s, delta / safe, beta_next / safe
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / safe
        x = x + np.where(live, c * eta * w, 0.0)
        eta = -s * eta
        live &= (np.abs(eta) > tolerance * start) & (beta_next > EPS * start)
        v_old, v = v, p / np.where(beta_next > 0, beta_next, 1.0)
        beta = beta_next
    return x


def _orthonormal(new: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Orthonormal directions that ``new`` adds to an orthonormal space."""
    norms = np.linalg.norm(new, axis=0)
    new = new[:, norms > 0] / norms[norms > 0]
    for _ in range(2):
        new = new - space @ (space.T @ new)
    if not new.shape[1]:
        return new
    left, sizes, _ = np.linalg.svd(new, full_matrices=False)
    left = left[:, sizes > 1e-8 * max(1.0, sizes[0])]
    left = left - space @ (space.T @ left)
    return np.linalg.qr(left)[0] if left.shape[1] else left


@dataclass(frozen=True)
class Pairs:
    """Eigenvalues falling, their unit eigenvectors as columns, the largest residual and the products it took."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float
    products: int


def leading_pairs(product: Product, width: int, wanted: int, seed: int = 11) -> Pairs:
    """The ``wanted`` largest eigenpairs of a symmetric matrix that is known by its product only."""
    wanted = min(wanted, width)
    block = min(width, wanted + GUARDS)
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, block)))[0]
    images, products = product(space), 1
    locked = 0
    for _ in range(OUTER_STEPS):
        small = space.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1]
        values, turn = values[order], turn[:, order]
        # from here on the space is spanned by its Ritz vectors
        space, images = space @ turn, images @ turn
        residuals = images[:, :wanted] - space[:, :wanted] * values[:wanted]
        sizes = np.linalg.norm(residuals, axis=0)
        limit = 8 * EPS * width * max(abs(values[0]), np.finfo(float).tiny)
        # pairs are locked from the largest on, so that none is passed over
        settled = sizes <= limit
        locked = wanted if settled.all() else int(np.argmin(settled))
        whole = space.shape[1] == width
        if locked == wanted or whole:
            # a space of all dimensions leaves nothing but rounding
            return Pairs(values[:wanted], space[:, :wanted], float(sizes.max(initial=0.0)), products)
        if space.shape[1] + (wanted - locked) > SPACE_BLOCKS * block and SPACE_BLOCKS * block < width:
            space, images = space[:, : 2 * block], images[:, : 2 * block]
        ritz, shifts = space[:, :wanted], values[locked:wanted]

        def off_ritz(x: np.ndarray, ritz: np.ndarray = ritz) -> np.ndarray:
            return x - ritz @ (ritz.T @ x)

        def projected(x: np.ndarray, shifts: np.ndarray = shifts, off_ritz: Product = off_ritz) -> np.ndarray:
            nonlocal products
            products += 1
            x = off_ritz(x)
            return off_ritz(product(x) - x * shifts)

        corrections = minres(projected, off_ritz(-residuals[:, locked:]), INNER_STEPS)
        added = _orthonormal(off_ritz(corrections), space)
        if not added.shape[1]:
            added = _orthonormal(np.random.default_rng(seed + products).standard_normal((width, 1)), space)
        space, images = np.hstack([space, added]), np.hstack([images, product(added)])
        products += 1
    raise RuntimeError(f"{wanted - locked} eigenpairs did not reach double precision in {OUTER_STEPS} steps")


@dataclass(frozen=True)
class Whitening:
    """Fitted moments and eigenpairs; eigenvalues that are zero to double precision are left out."""

    moments: Moments
    pairs: Pairs

    @property
    def directions(self) -> np.ndarray:
        return self.pairs.vectors / np.sqrt(self.pairs.values)


def fit(blocks: DataFrame, width: int, components: int) -> Whitening | None:
    m = moments(blocks, width)
    if not m.n or not m.trace:
        return None
    pairs = leading_pairs(covariance_product(blocks, width, m), width, components)
    some = pairs.values > 16 * EPS * width * pairs.values[0]
    return Whitening(m, Pairs(pairs.values[some], pairs.vectors[:, some], pairs.residual, pairs.products))


def identity_error(blocks: DataFrame, width: int, fitted: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity: one pass."""
    n, sums, directions = fitted.moments.n, np.array(fitted.moments.sums, dtype=np.int64), fitted.directions

    def of_block(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ directions
        return np.vstack([w.T @ w, w.sum(axis=0)])

    total = _summed(blocks, width, of_block, "double") / n
    means = total[-1]
    return float(np.abs(total[:-1] - np.outer(means, means) - np.eye(len(means))).max())


def _whole_numbers(values: np.ndarray) -> list[int | None]:
    return [int(v) if abs(int(v)) < 1 << 63 else None for v in values]


def _squared(deviations: np.ndarray) -> list[int | None]:
    if deviations.dtype != object and np.square(deviations.astype(np.float64)).sum(axis=1).max(initial=0) < 2.0**62:
        return np.square(deviations).sum(axis=1).tolist()
    return _whole_numbers(np.square(deviations.astype(object)).sum(axis=1))


def whiten(vectors: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row per usable row of ``vectors`` (``vec_id``, ``embedding``) and component, numbered from 1.

    Returns ``vec_id``, ``component``, ``n`` (vectors of the fit), ``deviation`` (exact sum of (n x - S)^2, null beyond
    64 bits), ``whitened``, ``explained`` (share of the trace) and ``identity_error``. Vectors that are null or hold a
    null or non-finite entry are left out, as are empty ones and those of another than the commonest width. Repeated
    rows each count and each give rows; null ids stay null. Components without variance are left out, so a table of
    equal vectors, or none, gives no rows. Other columns are ignored. A component of 2^62 steps or more is an error.
    """
    blocks, width = packed(vectors, scale, shift)
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    fitted = fit(blocks, width, components)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(blocks, width, fitted)
    n, sums, directions = fitted.moments.n, np.array(fitted.moments.sums, dtype=np.int64), fitted.directions
    explained = fitted.pairs.values / fitted.moments.trace
    k = len(explained)
    rows_at_once = max(1, OUTPUT_ROWS // k)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, x in _blocks_of(batches, width):
            for start in range(0, len(x), rows_at_once):
                deviations = _scaled_deviations(x[start : start + rows_at_once], n, sums)
                rows = len(deviations)
                whitened = (deviations.astype(np.float64) / n) @ directions
                squares = pd.array(_squared(deviations), dtype="Int64")
                yield pd.DataFrame(
                    {
                        "vec_id": np.repeat(ids[start : start + rows_at_once], k),
                        "component": np.tile(np.arange(1, k + 1, dtype=np.int32), rows),
                        "n": n,
                        "deviation": squares.repeat(k),
                        "whitened": whitened.ravel(),
                        "explained": np.tile(explained, rows),
                        "identity_error": error,
                    }
                )

    found = blocks.mapInPandas(run, schema)
    return found.withColumn("vec_id", without_id("vec_id"))
