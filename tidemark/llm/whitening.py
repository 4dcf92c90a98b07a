"""Whitening of embeddings: leading eigenpairs of their covariance by a block Jacobi-Davidson method.

The covariance is never formed: each step multiplies it by a block of vectors in one pass over the rows, which are
centred before they are multiplied. All wanted pairs are corrected at once, their correction equations solved by
inner MINRES steps that share the passes; pairs whose residual is at rounding level are locked. The driver holds
matrices of as many rows as the embeddings have dimensions, whatever the number of embeddings.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Rows packed into one.
PACK = 1024
#: A pair is done when its residual is at most this part of the largest eigenvalue.
DONE = 256 * np.finfo(float).eps
#: Eigenvalues up to this part of the largest are zero but for rounding: there is nothing to whiten by.
NOTHING = 1e-10
#: Bounds of the inner steps for one correction, of the corrections, and of scaled components.
INNER, OUTER, LARGEST = 5, 60, float(1 << 31)
_SEED = 13


# -- rows ----------------------------------------------------------------------------------------------


def packed(rows: DataFrame, scale: int = 64) -> DataFrame:
    """The rows that take part, up to ``PACK`` of them in one, written: ids, z, width, d, n, sums, squares.

    Left out are rows whose vector is null or has null or non-finite entries. ``z`` holds floor(scale * entry) as
    little-endian integers of ``width`` bytes, as few as hold them; ``sums`` and ``squares`` are exact, by dimension.
    """
    vector = F.col("embedding")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    taken = rows.where(vector.isNotNull() & finite).select(F.col("vec_id").cast("long"), whole.alias("z"))
    fits = F.forall("z", lambda c: F.abs(c) < LARGEST)
    message = F.lit(f"a component times {scale} is {LARGEST:.0f} or more")
    taken = taken.withColumn("z", F.when(fits, F.col("z")).otherwise(F.raise_error(message).cast("array<long>")))

    def pack(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, PACK):
                part = batch.slice(start, PACK)
                vectors = part.column("z")
                lengths = np.unique(np.diff(np.asarray(vectors.offsets)))
                for d in lengths.tolist():  # as a rule there is one
                    chosen = part.filter(pc.equal(pc.list_value_length(vectors), d))
                    z = np.asarray(chosen.column("z").flatten()).reshape(len(chosen), d)
                    width = next(w for w in (1, 2, 4) if not z.size or np.abs(z).max() < 1 << 8 * w - 1)
                    yield pa.RecordBatch.from_pylist([{
                        "ids": chosen.column("vec_id").to_pylist(), "z": z.astype(f"<i{width}").tobytes(), "width": width, "d": d, "n": len(z),
                        "sums": z.sum(0), "squares": (z.astype(object) ** 2).sum(0).astype(np.int64) if width == 4 else (z * z).sum(0),
                    }], _PACKED)

    return written(taken.mapInArrow(pack, "ids array<long>, z binary, width int, d int, n long, sums array<long>, squares array<long>"))


_PACKED = pa.schema([
    ("ids", pa.list_(pa.int64())), ("z", pa.binary()), ("width", pa.int32()), ("d", pa.int32()), ("n", pa.int64()),
    ("sums", pa.list_(pa.int64())), ("squares", pa.list_(pa.int64())),
])


@dataclass(frozen=True)
class Moments:
    """Exact sums of the rows, by dimension."""

    n: int
    sums: tuple[int, ...]
    squares: tuple[int, ...]

    @property
    def d(self) -> int:
        return len(self.sums)

    def near(self) -> np.ndarray:
        """The whole number next to each mean, so that what remains of the mean is below 1."""
        return np.array([s // self.n for s in self.sums], float)

    def rest(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def trace(self) -> float:
        """The trace of the covariance, from whole numbers."""
        return sum(self.n * q - s * s for s, q in zip(self.sums, self.squares)) / self.n**2


def moments(packs: DataFrame) -> Moments:
    found = packs.agg(F.sum("n").alias("n"), F.min("d").alias("least"), F.max("d").alias("most")).first()
    if not found.n:
        return Moments(0, (), ())
    if found.least != found.most:
        raise ValueError(f"vectors have {found.least} to {found.most} entries; a covariance needs equally many")
    sums = packs.select(F.posexplode(F.arrays_zip("sums", "squares")).alias("i", "of")).groupBy("i")
    wide = [F.sum(F.col(f"of.{c}").cast("decimal(38,0)")).alias(c) for c in ("sums", "squares")]
    rows = sorted(sums.agg(*wide).collect())
    return Moments(found.n, tuple(int(r.sums) for r in rows), tuple(int(r.squares) for r in rows))


def _vectors(z: bytes, width: int, d: int) -> np.ndarray:
    return np.frombuffer(z, f"<i{width}").reshape(-1, d).astype(float)


def _added(packs: DataFrame, per_pack: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all packs of a matrix made from each pack's vectors; tasks add up before the shuffle."""
    d = F.col("d")

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            for z, width, d in zip(*(c.to_pylist() for c in batch.columns)):
                total += per_pack(_vectors(z, width, d))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "value"])

    found = packs.select("z", "width", d).mapInArrow(run, "i long, value double").groupBy("i").agg(F.sum("value").alias("value"))
    out = np.zeros(shape[0] * shape[1])
    for i, value in found.collect():
        out[i] = value
    return out.reshape(shape)


def covariance_times(packs: DataFrame, known: Moments, block: np.ndarray) -> np.ndarray:
    """The covariance times a block of vectors: each row is centred, multiplied, and weighted by its products."""
    near, rest = known.near(), known.rest()

    def centred_products(vectors):
        centred = vectors - near - rest
        return centred.T @ (centred @ block)

    return _added(packs, centred_products, block.shape) / known.n


# -- eigenpairs ----------------------------------------------------------------------------------------


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal vectors that add what ``block`` has beside the orthonormal ``against``; none for what it lacks."""
    kept = against
    for v in block.T:
        size = np.linalg.norm(v)
        for _ in range(3):
            v = v - kept @ (kept.T @ v)
        left = np.linalg.norm(v)
        if size > 0 and left > 1e-10 * size:
            v = v / left
            kept = np.column_stack([kept, v - kept @ (kept.T @ v)])
            kept[:, -1] /= np.linalg.norm(kept[:, -1])
    return kept[:, against.shape[1] :]


def minres(times: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Solutions x of times(x) = right, one for each column, by MINRES steps that share each product.

    Stops early when all residuals are at most ``tolerance`` of the right sides.
    """
    norm = lambda block: np.sqrt((block * block).sum(0))
    divided = lambda block, by: np.divide(block, by, out=np.zeros_like(block), where=by > 1e-300)
    x = np.zeros_like(right)
    size = beta = norm(right)
    older, v = np.zeros_like(right), divided(right, np.broadcast_to(beta, right.shape))
    w_older, w_old = np.zeros_like(right), np.zeros_like(right)
    k = right.shape[1]
    c_old, s_old, c, s = np.ones(k), np.zeros(k), np.ones(k), np.zeros(k)
    left, before = beta.copy(), np.zeros(k)
    for _ in range(steps):
        if (np.abs(left) <= tolerance * size).all():
            break
        product = times(v)
        alpha = (v * product).sum(0)
        following = product - alpha * v - before * older
        after = norm(following)
        # the new column of the tridiagonal matrix, turned by the two last rotations
        far, near = s_old * before, c_old * before
        diagonal, near = c * alpha - s * near, s * alpha + c * near
        length = np.hypot(diagonal, after)
        length = np.where(length > 1e-300, length, 1.0)
        c_old, s_old, c, s = c, s, diagonal / length, after / length
        direction = (v - far * w_older - near * w_old) / length
        x = x + c * left * direction
        left = -s * left
        w_older, w_old = w_old, direction
        older, v, before = v, divided(following, np.broadcast_to(after, following.shape)), after
        if not np.any(after > 1e-300):
            break
    return x


def jacobi_davidson(times: Callable[[np.ndarray], np.ndarray], d: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues (falling) and unit eigenvectors of a symmetric matrix given by its products.

    Rayleigh-Ritz on the subspace gives approximations; those with a residual at rounding level are locked, the
    others corrected by solving the projected equation (I-QQ')(A-tI)(I-QQ') z = -r. The subspace starts again from
    its best vectors when it is four times as large as what is wanted.
    """
    k = min(k, d)
    basis = _orthonormal(np.random.default_rng(_SEED).standard_normal((d, k)), np.zeros((d, 0)))
    images = times(basis)
    for _ in range(OUTER):
        small = basis.T @ images
        values, inner = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, ritz, ritz_images = values[order], basis @ inner[:, order], images @ inner[:, order]
        residuals = ritz_images - ritz * values
        largest = max(values[0], 0.0)
        sizes = np.sqrt((residuals[:, :k] ** 2).sum(0))
        locked = sizes <= DONE * largest
        if locked.all() and (largest == 0 or _holds(times, ritz[:, :k], values[:k], largest)):
            return values[:k], ritz[:, :k]
        if basis.shape[1] > 4 * k:
            basis, images = ritz[:, : 2 * k], ritz_images[:, : 2 * k]
        todo = np.flatnonzero(~locked)
        if not len(todo):  # products drifted: take them anew
            images = times(basis)
            continue
        # locked vectors and those being corrected stay out of the corrections
        near, shifts = ritz[:, :k], values[todo]

        def projected(block, near=near):
            return block - near @ (near.T @ block)

        def shifted(block, shifts=shifts):
            block = projected(block)
            return projected(times(block) - block * shifts)

        corrections = minres(shifted, -projected(residuals[:, todo]), min(INNER, d - k), 0.05) if d > k else np.zeros((d, 0))
        fresh = _orthonormal(corrections, basis)
        if not fresh.shape[1]:  # nothing new to see from here: any direction that is still missing
            fresh = _orthonormal(np.random.default_rng(_SEED + basis.shape[1]).standard_normal((d, min(k, d - basis.shape[1]))), basis)
        if not fresh.shape[1]:  # the whole space: what is left is the rounding of the products
            basis = _orthonormal(ritz, np.zeros((d, 0)))
            images = times(basis)
            continue
        basis, images = np.column_stack([basis, fresh]), np.column_stack([images, times(fresh)])
    raise RuntimeError(f"{(~locked).sum()} of {k} eigenpairs have residuals over {DONE * largest:.3g}")


def _holds(times, vectors: np.ndarray, values: np.ndarray, largest: float) -> bool:
    """Whether the residuals are as small by a product taken from the vectors themselves."""
    residuals = times(vectors) - vectors * values
    return bool((np.sqrt((residuals**2).sum(0)) <= 2 * DONE * largest).all())


# -- whitening -----------------------------------------------------------------------------------------


def whitened(rows: DataFrame, components: int = 32, scale: int = 64) -> DataFrame:
    """One row for each row that takes part: vec_id, n, deviation, whitened, explained, identity_error.

    ``rows`` has vec_id and embedding; other columns are not read. Left out are rows whose vector is null or has null
    or non-finite entries. With z = floor(scale * entry) and their sums s over the n rows, ``deviation``
    (decimal) is the exact sum of (n*z - s)^2; ``whitened`` holds up to ``components`` numbers: z - s/n, projected on
    the unit eigenvectors of the covariance by falling eigenvalue e, over sqrt(e). ``explained`` is the e over the
    trace, ``identity_error`` the largest entry of the whitened rows' covariance minus the identity, measured in
    one more pass. Components whose e is zero but for rounding are left out: equal rows have none. A null vec_id
    stays null, repeated rows count each; an empty table gives no rows. Vectors of different lengths are an error.
    """
    packs = packed(rows, scale)
    known = moments(packs)
    kinds = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if not known.n:
        return rows.sparkSession.createDataFrame([], kinds)
    trace = known.trace()
    values, vectors = np.zeros(0), np.zeros((known.d, 0))
    if trace > 0:
        values, vectors = jacobi_davidson(lambda block: covariance_times(packs, known, block), known.d, components)
        real = values > NOTHING * values[0]
        values, vectors = values[real], vectors[:, real]
    near, rest, turned = known.near(), known.rest(), vectors / np.sqrt(values)
    error = identity_error(packs, known, turned)
    sums = np.array(known.sums, object)
    most = max(map(abs, known.sums), default=0)

    def run(batches):
        for batch in batches:
            for ids, z, width, d in zip(*(c.to_pylist() for c in batch.columns)):
                whole = np.frombuffer(z, f"<i{width}").reshape(len(ids), d)
                # products with the sums fit 64 bits unless these are very large; then Python's whole numbers take over
                kind = np.int64 if most * d << 8 * width < 1 << 62 else object
                squares = (whole.astype(object) ** 2).sum(1) if width == 4 else (whole.astype(np.int64) ** 2).sum(1)
                crossed = whole.astype(kind) @ sums.astype(kind)
                turn = (whole.astype(float) - near - rest) @ turned
                parts = [ids, [int(x) for x in squares], [str(x) for x in crossed], list(turn)]
                types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(p, t) for p, t in zip(parts, types)], ["vec_id", "squares", "crossed", "whitened"])

    found = packs.select("ids", "z", "width", "d").mapInArrow(run, "vec_id long, squares long, crossed string, whitened array<double>")
    n, of_sums = F.lit(known.n).cast("decimal(20,0)"), F.lit(str(sum(s * s for s in known.sums))).cast("decimal(38,0)")
    # sum of (n*z - s)^2, multiplied out
    deviation = (n * F.col("squares") - 2 * F.col("crossed").cast("decimal(38,0)")) * n + of_sums
    return found.select(
        "vec_id", F.lit(known.n).cast("long").alias("n"), deviation.cast("decimal(38,0)").alias("deviation"), "whitened",
        F.array(*[F.lit(float(e / trace)) for e in values]).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"),
    )


def identity_error(packs: DataFrame, known: Moments, turned: np.ndarray) -> float:
    """How far the covariance of the whitened rows is from the identity."""
    k = turned.shape[1]
    if not k:
        return 0.0
    near, rest = known.near(), known.rest()

    def both(vectors):
        white = (vectors - near - rest) @ turned
        return np.vstack([white.T @ white, white.sum(0)])

    total = _added(packs, both, (k + 1, k)) / known.n
    mean = total[-1]
    return float(np.abs(total[:-1] - np.outer(mean, mean) - np.eye(k)).max())
