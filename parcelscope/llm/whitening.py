"""Whitening of embeddings with leading eigenvectors found by Jacobi-Davidson.

An entry c becomes the integer x = floor(64 c) + 1000000.  Vectors are packed once, as blocks of integers of at most
``BLOCK_BYTES``; the covariance V of all x (divisor n) is never formed.  What the solver asks for are products V Q: every
task centres its blocks exactly (x minus the integer part of the mean, minus its remainder), multiplies, and gives a
partial sum of d x k numbers, which Spark adds up.  The driver holds a few vectors of length d.

Solver (block Jacobi-Davidson).  The search space W with its products V W gives Ritz pairs (Rayleigh-Ritz).  Leading pairs
whose residuals reach double precision are locked, and the search goes on orthogonally to them.  For the others that are
wanted, corrections t solve (I - QQ')(V - theta I)(I - QQ') t = -r, with Q the locked and current Ritz vectors, by a
few steps of MINRES, all columns in one distributed product a step; W grows by them, and restarts from its best Ritz
vectors beyond ``WIDEST`` columns.  It ends when all wanted pairs are locked.

Rows whose vector is null, or holds a null, NaN or infinite entry, are dropped, as are vectors of another length than
the commonest (of equally common ones the longest).  Null vec_ids are kept, repeated rows count as often
as they occur.  Components whose eigenvalue is zero to working precision are left out, as nothing can be divided by it: so are all
for a single row or equal rows.  An empty table gives no rows.  Entries beyond 2^52 / 64 in size end the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
EXTRA = 8  # columns of the first search space beyond the wanted ones
INNER = 4  # MINRES steps for a correction
WIDEST = 4  # columns of the search space, as a multiple of the wanted ones
ROUNDS = 200
BLOCK_BYTES = 2 << 20
TOLERANCE = 4 * np.finfo(float).eps  # of a residual, times the largest eigenvalue and the root of d
ZERO = 1e-12  # eigenvalues below this share of the largest are none
SEED = 20240229

BLOCKS = "vec_ids array<long>, n int, wide boolean, x binary, sums array<long>"


# --- packing -----------------------------------------------------------------------------------

def fit_rows(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding (array<double>) of the rows without null or non-finite entries."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    odd = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.filter(F.col("embedding").isNotNull() & ~odd)


def _packed(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1, BLOCK_BYTES // (8 * max(dim, 1)))
        for b in batches:
            for at in range(0, b.num_rows, most):
                part = b.slice(at, most)
                c = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dim)
                if c.size and np.abs(c).max() >= 2.0 ** 46:
                    raise ValueError("an entry of an embedding is too large to be an exact integer")
                y = np.floor(SCALE * c).astype(np.int64)  # the shift is added where x itself is needed
                wide = bool(y.size) and max(y.max(), -y.min()) >= 1 << 31
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([part.num_rows], pa.int32()), pa.array([wide]),
                    pa.array([y.astype("<i8" if wide else "<i4").tobytes()], pa.binary()),
                    pa.array([y.sum(axis=0).tolist()], pa.list_(pa.int64()))], ["vec_ids", "n", "wide", "x", "sums"])
    return run


@dataclass
class Fit:
    """The packed vectors, without the shift: their number, dimension and exact sums."""
    blocks: DataFrame
    n: int
    dim: int
    sums: list[int]

    def centred(self, wide: bool, packed: bytes) -> np.ndarray:
        """x - S/n of a block."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (self.raw(wide, packed) - whole).astype(np.float64) - rest

    def raw(self, wide: bool, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, "<i8" if wide else "<i4").reshape(-1, self.dim)

    def bare(self) -> "Fit":
        """Without the table: what tasks need."""
        return Fit(None, self.n, self.dim, self.sums)


def pack(embeddings: DataFrame) -> Fit:
    rows = fit_rows(embeddings)
    usual = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = usual["dim"] if usual else 0
    blocks = written(rows.filter(F.size("embedding") == dim).mapInArrow(tidy(_packed(dim)), BLOCKS), "vectors")
    n = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sums = (blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())  # one row for each dimension
    total = {r["i"]: int(r["s"]) for r in sums}
    return Fit(blocks, n, dim, [total.get(i, 0) for i in range(dim)])


# --- distributed products ------------------------------------------------------------------------

def _summed(fit: Fit, partial, size: int) -> np.ndarray:
    """The sum over all blocks of ``partial(centred rows)``, an array of ``size`` numbers; a partial sum for each task."""
    bare = fit.bare()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for wide, packed in zip(b.column(0).to_pylist(), b.column(1)):
                total += partial(bare.centred(wide, packed.as_buffer())).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["p"])

    rows = (fit.blocks.select("wide", "x").mapInArrow(tidy(run), "p array<double>")
            .select(F.posexplode("p").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect())
    out = np.zeros(size)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def product(fit: Fit, q: np.ndarray) -> np.ndarray:
    """V q for the columns of q, and nothing of V."""
    return _summed(fit, lambda y: y.T @ (y @ q), q.size).reshape(q.shape) / fit.n


# --- solver --------------------------------------------------------------------------------------

def orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``new`` adds to the orthonormal ``bases``."""
    for _ in range(2):
        for b in bases:
            new = new - b @ (b.T @ new)
        norms = np.linalg.norm(new, axis=0)
        new = new[:, norms > 0] / norms[norms > 0]
        if not new.shape[1]:
            return new
        u, s, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, s > 1e-10 * s[0]]
    for b in bases:
        new = new - b @ (b.T @ new)
    return np.linalg.qr(new)[0] if new.shape[1] else new


def minres(apply, b: np.ndarray, steps: int) -> np.ndarray:
    """Some MINRES steps for every column of b at once: ``apply`` maps a block of columns (symmetric for each of them)."""
    tiny = np.finfo(float).tiny

    def over(a, c):
        return np.where(np.abs(c) > tiny, a / np.where(np.abs(c) > tiny, c, 1), 0)

    x, w, w_old = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    beta = np.linalg.norm(b, axis=0)
    v, v_old = over(b, beta), np.zeros_like(b)
    eta = beta.copy()
    c = c_old = np.ones(b.shape[1])
    s = s_old = np.zeros(b.shape[1])
    beta_k = np.zeros(b.shape[1])
    for _ in range(steps):
        av = apply(v)
        alpha = (v * av).sum(axis=0)
        av = av - alpha * v - beta_k * v_old
        beta_next = np.linalg.norm(av, axis=0)
        # the new column of the tridiagonal matrix, turned by the last two rotations and its own
        delta = c * alpha - c_old * s * beta_k
        rho1 = np.hypot(delta, beta_next)
        rho2 = s * alpha + c_old * c * beta_k
        rho3 = s_old * beta_k
        c_old, s_old = c, s
        c, s = np.where(rho1 > tiny, over(delta, rho1), 1.0), over(beta_next, rho1)
        w, w_old = over(v - rho3 * w_old - rho2 * w, rho1), w
        x = x + c * eta * w
        eta = -s * eta
        v_old, v = v, over(av, beta_next)
        beta_k = beta_next
    return x


@dataclass
class Pairs:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int


def jacobi_davidson(times, dim: int, wanted: int, inner: int = INNER, seed: int = SEED) -> Pairs:
    """The ``wanted`` largest eigenvalues of a symmetric positive matrix, known by ``times(block) = A block``."""
    wanted = min(wanted, dim)
    rng = np.random.default_rng(seed)
    calls = 0

    def multiplied(block: np.ndarray) -> np.ndarray:
        nonlocal calls
        calls += 1
        return times(block)

    locked, values, residuals = np.zeros((dim, 0)), [], []
    w = orthonormal(rng.standard_normal((dim, min(dim, wanted + EXTRA))))
    aw = multiplied(w)
    for _ in range(ROUNDS):
        # Rayleigh-Ritz
        h = w.T @ aw
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        u, au = w @ y, aw @ y
        r = au - u * theta
        r = r - locked @ (locked.T @ r)
        norms = np.linalg.norm(r, axis=0)
        limit = TOLERANCE * np.sqrt(dim) * max([*values, theta[0], np.finfo(float).tiny])
        # lock the leading pairs that are done
        done = 0
        while done < len(theta) and len(values) < wanted and norms[done] <= limit:
            locked = np.concatenate((locked, u[:, done:done + 1]), axis=1)
            values.append(theta[done])
            residuals.append(norms[done])
            done += 1
        u, au, theta, r = u[:, done:], au[:, done:], theta[done:], r[:, done:]
        left = wanted - len(values)
        if not left:
            order = np.argsort(values)[::-1]
            return Pairs(np.array(values)[order], locked[:, order], np.array(residuals)[order], calls)
        # corrections of the wanted pairs that are left
        front, shift = u[:, :left], theta[:left]
        held = np.concatenate((locked, front), axis=1)

        def outside(t: np.ndarray) -> np.ndarray:
            t = t - held @ (held.T @ t)
            return t - held @ (held.T @ t)

        new = np.zeros((dim, 0))
        if w.shape[1] + locked.shape[1] - done < dim:
            new = minres(lambda t: outside(multiplied(t) - t * shift), -outside(r[:, :left]), inner)
        if u.shape[1] + new.shape[1] > max(WIDEST * wanted, 8):
            u, au = u[:, :2 * left], au[:, :2 * left]
        new = orthonormal(new, locked, u)[:, :dim - locked.shape[1] - u.shape[1]]
        if new.shape[1]:
            w, aw = np.concatenate((u, new), axis=1), np.concatenate((au, multiplied(new)), axis=1)
        else:  # the space is whole, or nothing new came: rounding is all that is left, so the products are made anew
            w = orthonormal(np.concatenate((u, rng.standard_normal((dim, 1 if u.shape[1] + locked.shape[1] < dim else 0))), axis=1), locked)
            aw = multiplied(w)
    raise ArithmeticError(f"{wanted - len(values)} pairs have not converged")


# --- result --------------------------------------------------------------------------------------

def _projected(bare: Fit, projection: np.ndarray):
    """Per vector: vec_id, deviation (exact), and its projections."""
    n, dim = bare.n, bare.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(bare.sums, object)
        for b in batches:
            for ids, wide, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                buffer = packed.as_buffer()
                y = bare.raw(wide, buffer).astype(np.int64)
                z = bare.centred(wide, buffer) @ projection
                most = n * int(np.abs(y).max(initial=0)) + max((abs(s) for s in bare.sums), default=0)
                if dim * most * most < 1 << 62:  # fits into 64 bits
                    d = ((n * y - np.array(bare.sums, np.int64)) ** 2).sum(axis=1).tolist()
                else:
                    d = [int(((n * row.astype(object) - sums) ** 2).sum()) for row in y]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array([str(v) for v in d]), pa.array(z.tolist(), pa.list_(pa.float64()))],
                    ["vec_id", "deviation", "z"])
    return run


def whiten(embeddings: DataFrame, components: int = COMPONENTS, inner: int = INNER) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation (decimal), whitened, explained, identity_error.

    Every task's memory is a block of vectors and d x k numbers; the passes over the data are the solver's products and two more.
    """
    fit = pack(embeddings)
    columns = "vec_id long, deviation string, z array<double>"
    if fit.n and fit.dim:
        pairs = jacobi_davidson(lambda q: product(fit, q), fit.dim, components, inner)
        trace = float(_summed(fit, lambda y: np.array([(y * y).sum()]), 1)[0]) / fit.n
        some = pairs.values > ZERO * max(pairs.values[0], np.finfo(float).tiny) if trace > 0 else np.zeros(len(pairs.values), bool)
    else:
        pairs, trace, some = Pairs(np.zeros(0), np.zeros((fit.dim, 0)), np.zeros(0), 0), 0.0, np.zeros(0, bool)
    values, vectors = pairs.values[some], pairs.vectors[:, some]
    k = len(values)
    projection = vectors / np.sqrt(values)
    error = 0.0
    if k:
        def moments(y: np.ndarray) -> np.ndarray:
            z = y @ projection
            return np.concatenate((z.sum(axis=0), (z.T @ z).ravel()))
        got = _summed(fit, moments, k + k * k) / fit.n
        cov = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
        error = float(np.abs(cov - np.eye(k)).max())
    some_rows = fit.blocks if k else fit.blocks.filter(F.lit(False))
    rows = some_rows.select("vec_ids", "wide", "x").mapInArrow(tidy(_projected(fit.bare(), projection)), columns)
    explained = F.array(*[F.lit(float(v / trace)) for v in values]) if k else F.array().cast("array<double>")
    return rows.select("vec_id", F.col("deviation").cast("decimal(38,0)").alias("deviation"), F.posexplode("z").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
