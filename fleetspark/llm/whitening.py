"""Whitening of embeddings along the leading eigenvectors of their covariance, found by Jacobi-Davidson.

1. ``pack`` turns entries c into whole numbers floor(SCALE c) + OFFSET and stores them as blocks of rows, once.
2. ``Centred`` is the covariance V as an operator: ``multiply(W)`` is one job over the blocks that gives V W for a few columns W. Rows are
   centred exactly (whole numbers less a whole part of the mean, then less the rest) before anything is multiplied, each task adds up
   its own product, and the tasks' sums are added by place: what reaches the driver is as large as W. V itself is never formed.
3. ``leading_eigenpairs`` keeps a subspace with its image. Rayleigh-Ritz gives approximate pairs; from the largest on, those whose residual
   has come down to rounding are locked. For each wanted pair that is left, Jacobi-Davidson's correction equation
   (I - QQ')(V - theta I)(I - QQ') t = -r is solved by MINRES, where Q holds the locked vectors and the pair's own. All these systems step
   together, so a step is one job for the block. Corrections, made orthogonal, extend the subspace; a large one is cut back to its best part.
4. ``whiten`` projects centred rows on the components and divides by the root of the eigenvalue, and measures what came out.

Defined cases: rows whose vector is null or holds null, NaN or infinite entries are left out; so are vectors of another length than most
have (of lengths as common, the longer counts). An entry beyond 2**40 counts as that. Repeated rows count each, ids are never looked at,
and null ids stay. Components of eigenvalue zero (up to ``NO_SPREAD`` of the trace) can't be whitened and are left out, so a table of one
vector, or of equal ones, gives no row; nor does an empty one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.llm.common import short_batches, stored

SCALE, OFFSET = 1024, 100_000
#: Steps of an inner solution at most, and how far each outer round brings its residual down, by a factor, before the next.
INNER_STEPS, INNER_DROP = 4, 1e-3
#: Residuals of locked pairs, over the largest eigenvalue and the root of the dimension; rounds before giving up.
PRECISION, ROUNDS = 16 * np.finfo(float).eps, 200
#: Share of the trace below which an eigenvalue is zero.
NO_SPREAD = 1e-13
_LARGEST = float(1 << 40)


def _matrices(vectors: pa.ListArray) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Of each length of sound vectors the places of its rows, and these as whole numbers without the offset."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy()
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    good = vectors.is_valid().to_numpy(zero_copy_only=False)
    good[owner[~np.isfinite(values)]] = False
    found = {}
    for length in np.unique(lengths[good]):
        rows = good & (lengths == length)
        entries = values[rows[owner]].reshape(int(rows.sum()), int(length))
        found[int(length)] = np.flatnonzero(rows), np.floor(np.clip(SCALE * entries, -_LARGEST, _LARGEST)).astype(np.int64)
    return lengths, found


def pack(rows: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """A stored table of ``dim, rows, wide, block``: whole numbers of several rows, of 64 bits if ``wide`` and 32 else."""
    short_batches(rows.sparkSession)

    def packed(batches):
        for batch in batches:
            _, found = _matrices(batch.column(0))
            for dim, (places, y) in found.items():
                wide = bool(y.size) and int(np.abs(y).max()) >= 1 << 31
                block = y.astype("<i8" if wide else "<i4").tobytes()
                yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "rows": [len(places)], "wide": [wide], "block": pa.array([block], pa.binary())})

    return stored(rows.select(vector_col).mapInArrow(packed, "dim int, rows long, wide boolean, block binary"), "whitening-blocks")


def _blocks(batches, dim: int):
    for batch in batches:
        for wide, block in zip(batch["wide"].to_pylist(), batch["block"]):
            yield np.frombuffer(block.as_buffer(), "<i8" if wide else "<i4").reshape(-1, dim)


@dataclass(frozen=True)
class Centred:
    """The covariance (divisor n) of packed rows, as an operator; ``whole + part`` is the mean without the offset."""

    blocks: DataFrame
    dim: int
    n: int
    whole: np.ndarray
    part: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(packed: DataFrame) -> Centred | None:
        """Of the commonest length; None if there is no vector."""
        most = packed.groupBy("dim").agg(F.sum("rows").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()  # a row a length
        if most is None or most["dim"] == 0:
            return None
        dim, n = most["dim"], most["n"]
        blocks = packed.where(F.col("dim") == dim).select("wide", "block")
        sums = np.array(added(blocks, dim, lambda y: y.sum(0, dtype=np.int64), dim, exact=True), dtype=object)
        whole = np.array([s // n for s in sums], np.int64)
        rest = np.array([s - int(w) * n for s, w in zip(sums, whole)], np.int64)
        return Centred(blocks, dim, n, whole, rest / n, rest)

    def centre(self, y: np.ndarray) -> np.ndarray:
        return (y - self.whole) - self.part

    def added(self, of_rows: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The mean over rows of what ``of_rows`` sums over centred rows, ``size`` numbers."""
        dim, whole, part = self.dim, self.whole, self.part
        return np.array(added(self.blocks, dim, lambda y: of_rows((y - whole) - part), size)) / self.n

    def multiply(self, columns: np.ndarray) -> np.ndarray:
        return self.added(lambda x: x.T @ (x @ columns), columns.size).reshape(columns.shape)


def added(blocks: DataFrame, dim: int, of_rows: Callable[[np.ndarray], np.ndarray], size: int, exact: bool = False) -> list:
    """The sum over blocks of ``size`` numbers: over a task's blocks in the task, over tasks by place."""
    kind, dtype = ("long", np.int64) if exact else ("double", np.float64)

    def of_task(batches):
        total = np.zeros(size, dtype)
        for y in _blocks(batches, dim):
            total += of_rows(y).ravel()
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(size, dtype=np.int32)), "value": pa.array(total)})

    value = F.col("value").cast("decimal(38,0)") if exact else F.col("value")
    rows = blocks.mapInArrow(of_task, f"place int, value {kind}").groupBy("place").agg(F.sum(value).alias("value")).collect()  # as many as asked for
    found = [0] * size
    for row in rows:
        found[row["place"]] = int(row["value"]) if exact else row["value"]
    return found


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, drop: float) -> np.ndarray:
    """Solve symmetric systems, one a column, together by MINRES, until all residuals fell by ``drop``."""
    x, v_old, w_old, w_older = (np.zeros_like(right) for _ in range(4))
    beta = np.linalg.norm(right, axis=0)
    first = eta = beta.copy()
    v = right / np.where(beta > 0, beta, 1)
    cos_old = cos = np.ones_like(beta)
    sin_old = sin = np.zeros_like(beta)
    for _ in range(steps):
        z = apply(v)
        alpha = (v * z).sum(0)
        z = z - alpha * v - beta * v_old
        beta_new = np.linalg.norm(z, axis=0)
        diagonal = cos * alpha - cos_old * sin * beta
        above, far = sin * alpha + cos_old * cos * beta, sin_old * beta
        length = np.hypot(diagonal, beta_new)
        length = np.where(length > 0, length, 1)
        cos_old, cos, sin_old, sin = cos, diagonal / length, sin, beta_new / length
        w_older, w_old = w_old, (v - far * w_older - above * w_old) / length
        x = x + cos * eta * w_old
        eta = -sin * eta
        v_old, v, beta = v, z / np.where(beta_new > 0, beta_new, 1), beta_new
        if np.all(np.abs(eta) <= drop * first):
            break
    return x


def _against(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """``new`` made orthonormal and orthogonal to ``bases``, twice over; columns of which rounding alone is left go."""
    for _ in range(2):
        norms = np.linalg.norm(new, axis=0)
        new = new[:, norms > 0] / norms[norms > 0]
        for basis in bases:
            new = new - basis @ (basis.T @ new)
        kept = np.zeros((new.shape[0], 0))
        for column in new.T:
            rest = column - kept @ (kept.T @ column)
            if np.linalg.norm(rest) > 1e-10:
                kept = np.column_stack((kept, rest / np.linalg.norm(rest)))
        new = kept
    return new


def leading_eigenpairs(multiply: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, most: int | None = None, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors of a symmetric operator, by Jacobi-Davidson with locking.

    ``most`` columns of a subspace are kept at most. Once the locked and the subspace fill the whole space, Rayleigh-Ritz is exact but for
    rounding and its pairs are locked as they are.
    """
    wanted = min(wanted, dim)
    most = most or 6 * wanted + 4
    locked, values = np.zeros((dim, 0)), []
    basis = _against(np.random.default_rng(seed).standard_normal((dim, min(dim, wanted + 2))))
    image = multiply(basis)
    scale = 0.0
    for _ in range(ROUNDS):
        inner = basis.T @ image
        ritz, turn = np.linalg.eigh((inner + inner.T) / 2)
        ritz, basis, image = ritz[::-1], basis @ turn[:, ::-1], image @ turn[:, ::-1]
        residual = image - basis * ritz
        residual -= locked @ (locked.T @ residual)
        scale = max(scale, *np.abs(ritz), *map(abs, values)) if len(ritz) else scale
        full = locked.shape[1] + basis.shape[1] == dim
        small = np.linalg.norm(residual, axis=0) <= PRECISION * np.sqrt(dim) * scale
        take = 0
        while take < len(ritz) and (small[take] or full) and (len(values) < wanted or ritz[take] > min(sorted(values)[-wanted:])):
            values.append(float(ritz[take]))
            take += 1
        locked, basis, image, ritz, residual = np.column_stack((locked, basis[:, :take])), basis[:, take:], image[:, take:], ritz[take:], residual[:, take:]
        if len(values) >= wanted and (not len(ritz) or ritz[0] <= min(sorted(values)[-wanted:])):
            order = np.argsort(values, kind="stable")[::-1][:wanted]
            return np.array(values)[order], locked[:, order]
        if basis.shape[1] > most - wanted:
            keep = min(basis.shape[1], wanted + 2)
            basis, image, ritz, residual = basis[:, :keep], image[:, :keep], ritz[:keep], residual[:, :keep]
        open_ = max(1, wanted - len(values))
        own, theta = basis[:, :open_], ritz[:open_]

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - locked @ (locked.T @ t)
            return t - own * (own * t).sum(0)

        def corrected(t: np.ndarray) -> np.ndarray:
            t = projected(t)
            return projected(multiply(t) - t * theta)

        correction = minres(corrected, -projected(residual[:, :open_]), min(INNER_STEPS, dim), INNER_DROP)
        new = _against(correction, locked, basis)
        if not new.shape[1]:  # nothing new was found: go on from a random direction
            new = _against(np.random.default_rng(seed + 1 + len(values)).standard_normal((dim, 1)), locked, basis)
        basis, image = np.column_stack((basis, new)), np.column_stack((image, multiply(new)))
    raise ValueError("the eigenvectors did not reach the precision asked for")


@dataclass(frozen=True)
class Whitening:
    """Components (columns, numbered from 1), their eigenvalues, the trace, and how far whitened rows are from unit covariance."""

    centred: Centred
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = 8) -> Whitening | None:
    centred = Centred.of(pack(rows, vector_col))
    if centred is None:
        return None
    trace = float(centred.added(lambda x: (x * x).sum(), 1)[0])
    values, vectors = leading_eigenpairs(centred.multiply, centred.dim, components) if trace > 0 else (np.zeros(0), np.zeros((centred.dim, 0)))
    values, vectors = values[values > NO_SPREAD * trace], vectors[:, values > NO_SPREAD * trace]
    k, by = len(values), vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = x @ by
        return np.concatenate((w.sum(0), (w.T @ w).ravel()))

    error = 0.0
    if k:
        found = centred.added(moments, k + k * k)
        error = float(np.abs(found[k:].reshape(k, k) - np.outer(found[:k], found[:k]) - np.eye(k)).max())
    return Whitening(centred, vectors, values, trace, error)


def whiten(rows: DataFrame, fitted: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each sound vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``deviation`` is the sum over dimensions of (n x - S)^2, exact, as a decimal number.
    """
    short_batches(rows.sparkSession)
    kind = rows.schema[id_col].dataType
    schema = T.StructType([T.StructField("vec_id", kind), *T._parse_datatype_string("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")])
    if fitted is None or not len(fitted.values):
        return rows.sparkSession.createDataFrame([], schema)
    c, by, k = fitted.centred, fitted.vectors / np.sqrt(fitted.values), len(fitted.values)
    dim, n, whole, part, rest = c.dim, c.n, c.whole, c.part, c.rest
    explained, error = fitted.values / fitted.trace, fitted.identity_error

    def made(batches):
        for batch in batches:
            _, found = _matrices(batch.column(1))
            if dim not in found:
                continue
            places, y = found[dim]
            near = y - whole
            if (float(np.abs(near).max()) + 1) * n < 2**31 / np.sqrt(dim):
                deviation = ((near * n - rest) ** 2).sum(1).tolist()
            else:
                deviation = (((near.astype(object) * n) - rest.astype(object)) ** 2).sum(1).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(places, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(places))),
                    pa.array(np.full(k * len(places), n)),
                    pa.array([d for d in deviation for _ in range(k)], pa.decimal128(38, 0)),
                    pa.array((((near - part) @ by).ravel())),
                    pa.array(np.tile(explained, len(places))),
                    pa.array(np.full(k * len(places), error)),
                ],
                names=schema.names,
            )

    return rows.select(id_col, vector_col).mapInArrow(made, schema)
