"""Embedding whitening: leading eigenvectors of the covariance by a block Jacobi-Davidson method, without the matrix."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import store

#: bytes of vectors in one stored row
BLOCK_BYTES = 4 << 20
TINY = float(np.finfo(float).eps)
#: the largest magnitude of x; beyond it a component stays there
MOST = 2**62
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors without null and non-finite entries."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.filter(F.col("embedding").isNotNull()).filter(~bad).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))


def blocks(rows: DataFrame, dim: int) -> DataFrame:
    """Rows packed into blocks: ids, and x = floor(1024 c) + 100000 as one matrix of longs; missing trailing entries count as zero."""
    most = max(1, BLOCK_BYTES // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, sizes = batch.column("v"), batch.column("v").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(sizes)])
            flat = column.flatten().to_numpy(zero_copy_only=False)
            for i in range(0, batch.num_rows, most):
                part = sizes[i:i + most]
                c = np.zeros((len(part), dim))
                c[np.arange(dim)[None, :] < part[:, None]] = flat[at[i]:at[min(i + most, batch.num_rows)]]
                x = np.clip(np.floor(1024 * c), -MOST, MOST).astype(np.int64) + 100000
                ids = pa.array([batch.column("vec_id").slice(i, most).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

    return rows.mapInArrow(run, "ids array<long>, x binary")


def longs(value: pa.Scalar, dim: int) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.int64).reshape(-1, dim)


@dataclass
class Packed:
    """The stored blocks, the length of their vectors, and how many tasks add up partial sums (none: the driver does)."""

    df: DataFrame
    dim: int
    adders: int


def total(packed: Packed, part: Callable[[np.ndarray], np.ndarray], kind: str = "float64") -> np.ndarray:
    """The sum of ``part(x)`` over all blocks: each task adds up its own, a second level those of many tasks, the driver the rest."""
    dim = packed.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for value in batch.column("x"):
                own = part(longs(value, dim))
                out = own if out is None else out + own
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()] if out is not None else [], pa.binary())], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(v.as_buffer(), kind) for batch in batches for v in batch.column("sums")]
        yield pa.RecordBatch.from_arrays([pa.array([sum(parts[1:], parts[0]).tobytes()] if parts else [], pa.binary())], ["sums"])

    sums = packed.df.select("x").mapInArrow(run, "sums binary")
    if packed.adders:
        sums = sums.repartition(packed.adders).mapInArrow(add, "sums binary")
    parts = [np.frombuffer(r[0], kind) for r in sums.collect()]  # one small matrix for each of at most 64 tasks or the adders
    return sum(parts[1:], parts[0])


def orthonormal(v: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of ``v`` add to the orthonormal columns of ``against``."""
    kept = against
    for i in range(v.shape[1]):
        x = v[:, i]
        size = np.linalg.norm(x)
        for _ in range(3):
            x = x - kept @ (kept.T @ x)
        left = np.linalg.norm(x)
        if size and left > 1e-10 * size:
            x = x / left
            x = x - kept @ (kept.T @ x)
            kept = np.column_stack([kept, x / np.linalg.norm(x)])
    return kept[:, against.shape[1]:]


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, most: int, tolerance: float = 0.05) -> np.ndarray:
    """MINRES for several symmetric systems side by side, a column each; every step is one block product."""
    x = np.zeros_like(b)
    beta = np.linalg.norm(b, axis=0)
    start, safe = beta.copy(), lambda a: np.where(a > 0, a, 1.0)
    v_old, v = np.zeros_like(b), b / safe(beta)
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    phi, delta, epsilon, c, s = beta.copy(), np.zeros_like(beta), np.zeros_like(beta), -np.ones_like(beta), np.zeros_like(beta)
    for step in range(most):
        live = phi > tolerance * start
        if not live.any():
            break
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - (beta if step else 0.0) * v_old
        beta_next = np.linalg.norm(p, axis=0)
        # the last two rotations on the new column of the tridiagonal matrix, then a new rotation
        d, g_bar = c * delta + s * alpha, s * delta - c * alpha
        e_next, delta = s * beta_next, -c * beta_next
        gamma = np.hypot(g_bar, beta_next)
        c, s = np.where(gamma > 0, g_bar / safe(gamma), 1.0), np.where(gamma > 0, beta_next / safe(gamma), 0.0)
        w_old, w = w, np.where(gamma > 0, (v - epsilon * w_old - d * w) / safe(gamma), 0.0)
        x = np.where(live, x + c * phi * w, x)
        phi, epsilon = phi * s, e_next
        v_old, v, beta = v, np.where(beta_next > 0, p / safe(beta_next), 0.0), beta_next
    return x


@dataclass
class Pairs:
    values: np.ndarray
    vectors: np.ndarray
    #: residual norms, products of the covariance with a block, and rounds of the outer iteration
    residuals: np.ndarray
    products: int
    rounds: int


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, k: int, inner: int = 4, most: int = 128, guard: int = 4, rounds: int = 200) -> Pairs:
    """The k largest eigenpairs of a symmetric positive operator that is known by its products with blocks of vectors.

    Rayleigh-Ritz on a search space gives Ritz pairs. Each wanted pair that has not converged asks for a correction t
    from the projected equation (I - QQ')(A - theta I)(I - QQ') t = -r, where Q holds the locked vectors and
    the pair's own; a few MINRES steps solve it, for all pairs side by side, and the corrections widen the space. Pairs are locked from
    the largest on when their residual is at the rounding error of the products, and the space is kept orthogonal to them.
    A full space (``most`` vectors) starts again from its best Ritz vectors. ``guard`` more pairs are
    followed than wanted, so that one which shows up late still takes its place before the last ones are locked.
    """
    k, count = min(k, dim), 0

    def counted(v: np.ndarray) -> np.ndarray:
        nonlocal count
        count += 1
        return product(v)

    rnd = np.random.default_rng(11)
    width = min(k + guard, dim)
    locked, locked_product = np.zeros((dim, 0)), np.zeros((dim, 0))
    basis = orthonormal(rnd.standard_normal((dim, width)), locked)
    image, scale, done = counted(basis), 0.0, 0
    for done in range(1, rounds + 1):
        small = basis.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        u, au = basis @ y, image @ y
        scale = max(scale, abs(theta[0]) if len(theta) else 0.0)
        want, full = k - locked.shape[1], basis.shape[1] + locked.shape[1] >= dim
        wide = min(want + guard, u.shape[1])
        r = au[:, :wide] - u[:, :wide] * theta[:wide]
        r -= locked @ (locked.T @ r)
        norms = np.linalg.norm(r, axis=0)
        # a space that is everything holds every eigenvector as well as doubles can
        good = (norms <= 8 * TINY * np.sqrt(dim) * scale) | full
        now = int(np.argmin(np.append(good[:want], False)))
        if now < want and now and not full:
            # one more pair than is locked must have settled, so that none can come before the last of them
            now = now if good[min(now, wide - 1)] else now - 1
        if now:
            locked, locked_product = np.column_stack([locked, u[:, :now]]), np.column_stack([locked_product, au[:, :now]])
            basis, image, theta, r, norms, u, au = u[:, now:], au[:, now:], theta[now:], r[:, now:], norms[now:], u[:, now:], au[:, now:]
            want, wide = want - now, wide - now
        if not want:
            break
        if basis.shape[1] + wide > most:
            basis, image = u[:, :2 * width], au[:, :2 * width]
        # each correction keeps off the locked vectors and off its own Ritz vector
        own, shift = u[:, :wide], theta[:wide]
        off = lambda t: (lambda t: t - own * (own * t).sum(axis=0))(t - locked @ (locked.T @ t))  # noqa: E731, B023
        t = minres(lambda x: off(counted(off(x)) - x * shift), -off(r), inner)  # noqa: B023
        new = orthonormal(np.where(np.isfinite(t), t, 0.0), np.column_stack([locked, basis]))
        if not new.shape[1]:
            new = orthonormal(rnd.standard_normal((dim, min(2, dim))), np.column_stack([locked, basis]))
        basis, image = np.column_stack([basis, new]), np.column_stack([image, counted(new)])
    values = (locked * locked_product).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    residuals = np.linalg.norm(locked_product - locked * values, axis=0)
    return Pairs(values[order], locked[:, order], residuals[order], count, done)


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2 for each row; null beyond the range of long."""
    top = max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, sums))
    if top < 2**62:
        away = n * x - np.array(sums, np.int64)
        if int(np.abs(away).max()) ** 2 * x.shape[1] < 2**63:
            return (away * away).sum(axis=1).tolist()
        rows = away.astype(object)
    else:
        rows = n * x.astype(object) - np.array(sums, object)
    found = [int(v) for v in (rows * rows).sum(axis=1)]
    return [v if v < 2**63 else None for v in found]


@dataclass
class Whitening:
    """Everything that the rows need, at most some tens of vectors: it is what goes to every task."""

    n: int
    sums: list[int]
    pairs: Pairs
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the mean is taken off as a long, and only the rest as a double."""
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])
        return (x - np.array(whole, np.int64)).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.pairs.vectors / np.sqrt(self.pairs.values))


def fit(packed: Packed, components: int) -> Whitening:
    """Sums, trace and leading eigenpairs of all stored blocks."""
    dim = packed.dim
    low = 2**31 - 1  # sums of the low and high halves cannot overflow
    counts = total(packed, lambda x: np.concatenate([[len(x)], (x & low).sum(axis=0), (x >> 31).sum(axis=0)]), "int64")
    n, sums = int(counts[0]), [int(a) + (int(b) << 31) for a, b in zip(counts[1:dim + 1], counts[dim + 1:])]
    model = Whitening(n, sums, Pairs(*[np.zeros(0)] * 3, 0, 0), 0.0)
    centred = model.centred
    model.trace = float(total(packed, lambda x: np.array([(centred(x) ** 2).sum()]))[0]) / n

    def product(v: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = centred(x)
            return (y.T @ (y @ v)).ravel()
        return total(packed, part).reshape(dim, -1) / n

    pairs = jacobi_davidson(product, dim, components)
    real = pairs.values > dim * TINY * model.trace
    model.pairs = Pairs(pairs.values[real], pairs.vectors[:, real], pairs.residuals[real], pairs.products, pairs.rounds)
    return model


def identity_error(packed: Packed, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity."""
    k = len(model.pairs.values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    sums = total(packed, moments)
    mean, square = sums[:k] / model.n, sums[k:].reshape(k, k) / model.n
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def whitened(embeddings: DataFrame, components: int = 8) -> DataFrame:
    """Every usable vector on the leading principal components, each scaled to variance one.

    Returns vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error; a row for each vector
    and component. The vectors are packed once into a stored table. The covariance matrix is never
    made: each product with a block of directions is a pass over that table, with rows centred first, whose
    partial sums (dimensions x directions) are added on the executors. Eigenpairs come from ``jacobi_davidson``, whose
    small matrices (dimensions x 128 at most) stay on the driver.

    Vectors that are null or hold null or non-finite entries are left out; shorter vectors are filled with zeros
    up to the longest. Null, repeated and equal vec_ids are rows of their own, all in the fit. A finite
    component beyond 2^62 / 1024 stays at that bound. A component without variance (eigenvalue zero in double precision) is
    left out, so equal vectors, a single one, and an empty table give no rows. A deviation beyond
    the range of long is null. Eigenvectors of equal eigenvalues are any orthonormal ones, the same for all rows. Other columns are not read.
    """
    rows = usable(embeddings)
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    spark = embeddings.sparkSession
    if not dim:
        return spark.createDataFrame([], RESULT)
    stored = store(blocks(rows, dim), "vectors")
    n_blocks = stored.count()
    packed = Packed(stored, dim, int(n_blocks**0.5) if n_blocks > 64 else 0)
    model = fit(packed, components)
    k = len(model.pairs.values)
    if not k:
        return spark.createDataFrame([], RESULT)
    error, share = identity_error(packed, model), model.pairs.values / model.trace
    sent = spark.sparkContext.broadcast(model)
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for ids, value in zip(batch.column("ids"), batch.column("x")):
                x = longs(value, dim)
                vec, w, away = ids.values, own.whitened(x), pa.array(exact_deviation(x, own.n, own.sums), pa.int64())
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays([
                    vec.take(each), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(len(each), own.n), pa.int64()), away.take(each),
                    pa.array(w.ravel()), pa.array(np.tile(share, len(x))), pa.array(np.full(len(each), error))], names)

    return stored.mapInArrow(run, RESULT)
