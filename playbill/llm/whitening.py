"""Whitening of embeddings by an eigendecomposition that is updated row by row.

Components are read as whole numbers x = floor(scale * c) + shift, so that sums and deviations
are exact. One pass gives the number of rows and the sum of each dimension. In a second pass
every partition keeps the spectrum of its own scatter matrix: each row, centred on the
partition's running mean, is a rank-one update, whose new eigenvalues are the roots of a secular
equation. Entries of the update that are too small to matter, and equal eigenvalues, are taken
out before (deflation). Spectra of partitions are combined in rounds of ``AT_ONCE``: the vectors
of the one, scaled by the roots of their eigenvalues, and the difference of the means are
successive rank-one updates of the other. The combined vectors are a basis that is right but for
rounding; a third pass projects the covariance on it (Rayleigh-Ritz), centred exactly before
multiplying, and the small projected matrix gives the components to double precision.

What a task or the driver holds is the square of the dimensions at most, never rows.

Rows whose vector is null, or holds a null or a number that is not finite, are left out. The
others must be of one length, and their numbers below 2**40 in size; anything else is an error,
not a wrong result. Null ids stay null, repeated rows count and are returned as often as they
occur. Components with no variance (fewer different rows than components, a constant dimension)
have ``whitened`` null; ``explained`` is null if there is no variance at all, and
``identity_error`` null if no component has any. An empty table gives no rows. Other columns
play no part, whatever their names.
"""

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.support import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Spectra that one task combines.
AT_ONCE = 16
LARGEST = 2.0**40
EPS = float(np.finfo(float).eps)
#: Eigenvalues below this share of all variance count as none.
NO_VARIANCE = 1e-13


def secular_roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """The matrix d_j - root_i of the roots of 1 + sum z2_j / (d_j - root) = 0.

    ``d`` rises, with gaps, and all ``z2`` are above 0, so one root lies after each ``d_i`` and
    before the next one. A root is sought from the nearer of its two poles, which keeps the
    small differences exact. Steps come from the rational function that meets value and slopes
    of both sides ("middle way"); where one leaves the bracket, the bracket is halved.
    """
    n = len(d)
    after = np.r_[d[1:], d[-1] + z2.sum() * (1 + 1e-6)]
    width = after - d
    at = np.arange(n)
    weights = z2[:, None]
    # The sign half-way tells the nearer pole.
    half = 1 + (weights / (d[:, None] - (d + width / 2))).sum(0)
    right = (half < 0) & (at < n - 1)
    base = d[:, None] - np.where(right, after, d)
    low = np.where(right, -width / 2, np.where(half < 0, width / 2, 0.0))
    high = np.where(right, 0.0, np.where(half < 0, width, width / 2))
    step = (low + high) / 2
    before = at[:, None] <= at
    nearest, following = base[at, at], np.r_[base[at[1:], at[:-1]], 0.0]
    open_ = at  # the roots still sought
    for _ in range(80):
        own = step[open_]
        delta = base[:, open_] - own
        terms = weights / delta
        slopes = terms / delta
        value = 1 + terms.sum(0)
        low[open_] = np.where(value < 0, own, low[open_])
        high[open_] = np.where(value > 0, own, high[open_])
        done = np.abs(value) <= 2 * EPS * n**0.5 * (1 + np.abs(terms).sum(0))
        slope_before = (slopes * before[:, open_]).sum(0)
        slope_after = slopes.sum(0) - slope_before
        left, last = nearest[open_] - own, open_ == n - 1
        other = np.where(last, 0.0, following[open_] - own)
        c = value - left * slope_before - other * slope_after
        a = (left + other) * value - left * other * (slope_before + slope_after)
        b = left * other * value
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            move = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = own + np.where(last, left + left * left * slope_before / c, move)
        new = np.where((new > low[open_]) & (new < high[open_]), new, (low + high)[open_] / 2)
        done |= np.abs(new - own) <= 2 * EPS * np.abs(own)
        step[open_] = np.where(done, own, new)
        open_ = open_[~done]
        if not len(open_):
            break
    return base - step


def rank_one_update(d: np.ndarray, vectors: np.ndarray, v: np.ndarray):
    """Spectrum (rising ``d``, columns ``vectors``) of ``U diag(d) U' + v v'``.

    What of ``v`` lies outside the columns is a new column with eigenvalue 0 before the update.
    """
    z = vectors.T @ v
    length = float(np.sqrt(v @ v))
    if not length:
        return d, vectors
    if len(d) < len(v):
        rest = v - vectors @ z
        again = vectors.T @ rest
        rest -= vectors @ again
        z += again
        size = float(np.sqrt(rest @ rest))
        if size > 1e-10 * length:
            vectors = np.column_stack((rest / size, vectors))
            d, z = np.r_[0.0, d], np.r_[size, z]
    tolerance = 8 * EPS * max(float(np.abs(d).max(initial=0.0)), length * length)
    order = np.argsort(d, kind="stable")
    d, z, vectors = d[order], z[order], vectors[:, order]
    # Deflation, first kind: no part of the update in this direction.
    live = np.abs(z) * length > tolerance
    # Second kind: of two directions with the same eigenvalue, turn one out of the update.
    own = np.flatnonzero(live)
    if len(own) > 1:
        close = np.abs(np.diff(d[own]) * z[own][:-1] * z[own][1:])
        if (close <= tolerance * (z[own][:-1] ** 2 + z[own][1:] ** 2)).any():
            d, z, vectors = d.copy(), z.copy(), vectors.copy()
            before = own[0]
            for j in own[1:]:
                r = np.hypot(z[before], z[j])
                cos, sin = z[j] / r, z[before] / r
                if abs((d[j] - d[before]) * cos * sin) <= tolerance:
                    turned = cos * vectors[:, before] - sin * vectors[:, j]
                    vectors[:, j] = sin * vectors[:, before] + cos * vectors[:, j]
                    vectors[:, before] = turned
                    low, high = d[before], d[j]
                    d[before] = low * cos**2 + high * sin**2
                    d[j] = low * sin**2 + high * cos**2
                    z[j], z[before], live[before] = r, 0.0, False
                before = j
    own = np.flatnonzero(live)
    if not len(own):
        return d, vectors
    poles = d[own]
    if len(own) > 1 and (np.diff(poles) <= 0).any():  # turning moved two past each other
        sorted_own = np.argsort(poles, kind="stable")
        own, poles = own[sorted_own], poles[sorted_own]
        poles = poles + np.arange(len(poles)) * EPS * max(tolerance, poles[-1])
    delta = secular_roots(poles, z[own] ** 2)
    # The update whose exact roots these are: its vectors are orthogonal to working precision.
    gaps = poles[None, :] - poles[:, None]
    np.fill_diagonal(gaps, 1.0)
    square = np.prod(-delta / gaps, axis=1)
    exact = np.copysign(np.sqrt(np.maximum(square, 0.0)), z[own])
    turn = exact[:, None] / delta
    turn /= np.sqrt((turn * turn).sum(0))
    nearest = np.abs(delta).argmin(0)
    new_d, new_vectors = d.copy(), vectors.copy()
    new_d[own] = poles[nearest] - delta[nearest, np.arange(len(own))]
    new_vectors[:, own] = vectors[:, own] @ turn
    order = np.argsort(new_d, kind="stable")
    return new_d[order], new_vectors[:, order]


@dataclass
class Spectrum:
    """Rows seen, their mean, and the eigenvalues and vectors of their scatter about it."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> "Spectrum":
        return cls(0, np.zeros(size), np.zeros(0), np.zeros((size, 0)))

    def _update(self, v):
        self.values, self.vectors = rank_one_update(self.values, self.vectors, v)

    def add(self, row: np.ndarray) -> None:
        away = row - self.mean
        if self.n:
            self._update(away * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + away / self.n

    def combine(self, other: "Spectrum") -> None:
        if not self.n or not other.n:
            if other.n:
                self.__dict__.update(other.__dict__)
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self._update(np.sqrt(value) * vector)
        away, n = other.mean - self.mean, self.n + other.n
        self._update(away * np.sqrt(self.n * other.n / n))
        self.mean = self.mean + away * (other.n / n)
        self.n = n

    def orthonormal(self) -> "Spectrum":
        """Take out what rounding of many updates has left between the vectors."""
        if self.vectors.size:
            q, r = np.linalg.qr(self.vectors)
            self.vectors = q * np.sign(np.where(np.diag(r) == 0, 1, np.diag(r)))
        return self

    def as_row(self) -> list:
        return [self.n, self.mean.tolist(), self.values.tolist(), self.vectors.ravel().tolist()]

    @classmethod
    def of_row(cls, n, mean, values, vectors) -> "Spectrum":
        vectors = np.array(vectors, float).reshape(len(mean), len(values))
        return cls(n, np.array(mean, float), np.array(values, float), vectors)


def _whole_numbers(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * c) of a batch of vectors of one length, exact, without the shift."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    whole = np.floor(scale * flat)
    if len(whole) and np.abs(whole).max() > LARGEST * SCALE:
        raise ValueError(f"numbers beyond {LARGEST:.0f} in size are not supported")
    return whole.astype(np.int64).reshape(len(column), -1)


def usable(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, v) of the rows whose vector is there and holds finite numbers only."""
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    rows = df.filter(F.col(vector).isNotNull() & finite)
    return rows.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))


def totals(rows: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> tuple[int, list[int]]:
    """(number of rows, sum of each dimension), exact; an error if lengths differ."""

    def run(batches):
        for batch in batches:
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            for size in np.unique(sizes):
                own = batch.column("v").filter(pa.array(sizes == size))
                sums = _whole_numbers(own, scale).sum(0) if size else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"length": pa.array([size], pa.int32()), "n": pa.array([len(own)], pa.int64()),
                     "sums": pa.array([sums.tolist()], pa.list_(pa.int64()))}
                )

    parts = stored(rows.select("v").mapInArrow(run, "length int, n long, sums array<long>"), "sums")
    lengths = parts.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").take(2)
    if not lengths:
        return 0, []
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths, {lengths[0][0]} and {lengths[1][0]}")
    n = lengths[0].n
    each = parts.select(F.posexplode("sums").alias("at", "part")).groupBy("at")
    sums = each.agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("sum")).orderBy("at")
    return n, [int(r["sum"]) + shift * n for r in sums.collect()]


def _floor_mean(n, sums, shift):
    """The mean less the shift as whole numbers and the parts of one above them."""
    whole = [s // n for s in sums]
    part = np.array([(s - w * n) / n for s, w in zip(sums, whole)])
    return np.array([w - shift for w in whole], np.int64), part


def partial_spectra(rows: DataFrame, base: np.ndarray, scale: int = SCALE) -> DataFrame:
    """One spectrum for each partition, of the numbers less ``base``."""

    def run(batches):
        seen = Spectrum.empty(len(base))
        for batch in batches:
            for row in (_whole_numbers(batch.column("v"), scale) - base).astype(float):
                seen.add(row)
        if seen.n:
            yield _spectrum_batch(seen.orthonormal())

    made = rows.select("v").mapInArrow(run, SPECTRUM)
    return made.withColumn("key", F.spark_partition_id().cast("long"))


SPECTRUM = "n long, mean array<double>, values array<double>, vectors array<double>"


def _spectrum_batch(spectrum, *key):
    arrays = [pa.array([x]) for x in spectrum.as_row()]
    names = ["n", "mean", "values", "vectors"]
    kinds = [pa.int64(), *[pa.list_(pa.float64())] * 3]
    arrays = [a.cast(k) for a, k in zip(arrays, kinds)]
    return pa.RecordBatch.from_arrays(
        [*arrays, *[pa.array([k], pa.int64()) for k in key]], [*names, *["key"] * len(key)]
    )


def combined(spectra: DataFrame, at_once: int = AT_ONCE) -> Spectrum:
    """All spectra combined to one, ``at_once`` in a task, round after round."""
    spectra = stored(spectra, "spectra")
    left = spectra.count()

    def run(key, groups: Iterable[pa.RecordBatch]):
        total = None
        table = pa.Table.from_batches(list(groups)).sort_by("key")  # at most ``at_once`` rows
        for part in table.to_pylist():
            own = Spectrum.of_row(part["n"], part["mean"], part["values"], part["vectors"])
            total = total or Spectrum.empty(len(own.mean))
            total.combine(own)
        yield _spectrum_batch(total.orthonormal(), key[0].as_py())

    while left > 1:
        # Partition numbers are below the number of partitions, so groups hold ``at_once`` at most.
        grouped = spectra.withColumn("group", F.floor(F.col("key") / at_once)).groupBy("group")
        spectra = stored(grouped.applyInArrow(_merge_of(run), f"{SPECTRUM}, key long"), "spectra")
        left = spectra.count()
    return Spectrum.of_row(*spectra.select("n", "mean", "values", "vectors").first())


def _merge_of(run):
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(run(key, table.to_batches())))

    return merge


def rayleigh_ritz(
    rows: DataFrame, basis: np.ndarray, base: np.ndarray, part: np.ndarray, n: int,
    scale: int = SCALE,
) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, unit vectors) of the covariance within the span of ``basis``."""

    def run(batches):
        total = np.zeros((basis.shape[1], basis.shape[1]))
        for batch in batches:
            away = (_whole_numbers(batch.column("v"), scale) - base) - part
            own = away @ basis
            total += own.T @ own
        yield pa.RecordBatch.from_pydict(
            {"at": pa.array(np.arange(total.size)), "part": pa.array(total.ravel())}
        )

    parts = rows.select("v").mapInArrow(run, "at long, part double")
    sums = parts.groupBy("at").agg(F.sum("part").alias("part")).collect()  # basis squared
    projected = np.zeros(basis.shape[1] ** 2)
    for at, value in sums:
        projected[at] = value / n
    projected = projected.reshape(basis.shape[1], basis.shape[1])
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    vectors = basis @ turn[:, ::-1]
    largest = np.abs(vectors).argmax(0)
    vectors *= np.sign(vectors[largest, np.arange(vectors.shape[1])])
    return values[::-1], vectors


def projected_rows(
    rows: DataFrame, components: np.ndarray, roots: np.ndarray, base: np.ndarray,
    part: np.ndarray, n: int, sums: list[int], shift: int = SHIFT, scale: int = SCALE,
) -> DataFrame:
    """(id, deviation, w): each row's exact deviation and its whitened components."""
    rest = [s - n * (int(b) + shift) for s, b in zip(sums, base)]  # n times the part, exact
    kind = pa.decimal128(38, 0)

    def run(batches):
        for batch in batches:
            whole = _whole_numbers(batch.column("v"), scale) - base
            w = ((whole - part) @ components) / roots
            largest = n * (int(np.abs(whole).max(initial=0)) + 1)
            if largest**2 * max(1, len(base)) < 1 << 63:
                deviation = pa.array(((n * whole - np.array(rest)) ** 2).sum(1)).cast(kind)
            else:
                deviation = pa.array([sum((n * x - r) ** 2 for x, r in zip(row, rest))
                                      for row in whole.tolist()], kind)
            width = w.shape[1]
            flat = pa.array(w.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, len(whole) * width + 1, max(1, width)), pa.int32())
                if width else pa.array(np.zeros(len(whole) + 1), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), deviation, lists], ["id", "deviation", "w"]
            )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, deviation decimal(38,0), w array<double>")


def identity_error(white: DataFrame, width: int) -> float | None:
    """The largest entry by which the covariance of stored whitened rows misses the identity."""
    if not width:
        return None
    w = [F.col("w")[i] for i in range(width)]
    missed = [
        F.abs(F.covar_pop(w[i], w[j]) - (1.0 if i == j else 0.0))
        for i in range(width)
        for j in range(i + 1)
    ]
    return white.agg(*[m.alias(f"e{k}") for k, m in enumerate(missed)]).select(
        F.array_max(F.array(*[f"e{k}" for k in range(len(missed))]))
    ).first()[0]


def whiten(
    df: DataFrame,
    components: int = COMPONENTS,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    shift: int = SHIFT,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each row and component.

    ``deviation`` is decimal(38,0), as it grows with the square of the number of rows.
    """
    rows = usable(df, id, vector)
    schema = (f"{id} {rows.schema['id'].dataType.simpleString()}, component int, n long, "
              "deviation decimal(38,0), whitened double, explained double, identity_error double")  # fmt: skip
    n, sums = totals(rows, scale, shift)
    if not n or not sums:
        return df.sparkSession.createDataFrame([], schema)
    base, part = _floor_mean(n, sums, shift)
    found = combined(partial_spectra(rows, base, scale), at_once).vectors
    basis = np.linalg.qr(found, mode="complete")[0]  # directions without variance too
    values, vectors = rayleigh_ritz(rows, basis, base, part, n, scale)
    total = float(values.sum())
    shown = min(components, len(sums))
    varied = int((values[:shown] > NO_VARIANCE * total).sum()) if total > 0 else 0
    white = stored(
        projected_rows(rows, vectors[:, :varied], np.sqrt(values[:varied]), base, part, n, sums,
                       shift, scale),
        "whitened",
    )
    error = identity_error(white, varied)
    shares = [float(values[k]) / total if k < varied else 0.0 for k in range(shown)]
    each = F.array(*[
        F.struct(F.lit(k + 1).alias("component"),
                 (F.col("w")[k] if k < varied else F.lit(None).cast("double")).alias("whitened"),
                 (F.lit(shares[k]) if total > 0 else F.lit(None).cast("double")).alias("explained"))
        for k in range(shown)
    ])
    exploded = white.select("id", "deviation", F.explode(each).alias("own"))
    return exploded.select(
        F.col("id").alias(id),
        "own.component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "own.whitened",
        "own.explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
