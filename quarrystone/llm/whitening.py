"""Whitening of embeddings by the covariance of their distinct vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import Boxed, col_of, need, spread_join
from quarrystone.session import materialize, table

#: A vector's entries become whole numbers of this part of one; those of the registered query are fixed by its contract.
SCALE = 256
COMPONENTS = 4
#: Vectors that are multiplied at once.
SLICE = 4096
#: Largest whole number that a vector's entry may have to be exact in a long.
LARGEST = 2.0**63


def _quantize(dimension: int, scale: int):
    """(_row, x): the whole numbers of valid vectors, as bytes of little-endian longs."""

    def quantize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("_vec")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
            x = np.floor(scale * flat)
            ok = np.isfinite(x).all(axis=1) & (np.abs(x) < LARGEST).all(axis=1)  # null entries are NaN here
            keys = [r.tobytes() for r in x[ok].astype("<i8")]
            yield pa.RecordBatch.from_arrays([batch.column("_doc").filter(pa.array(ok)), pa.array(keys, pa.binary())], ["_doc", "x"])

    return quantize


def _slices(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            x = np.frombuffer(b"".join(part.column("x").to_pylist()), "<i8").reshape(-1, dimension)
            yield part, x, part.column("w").to_numpy().astype(np.int64)


def _matrix_rows(matrix: np.ndarray) -> pa.RecordBatch:
    i, j = np.indices(matrix.shape).reshape(2, -1)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(matrix.ravel(), pa.float64())], ["i", "j", "v"])


def _products(dimension: int, mean: np.ndarray):
    """Each task's sum of w (x - mean) (x - mean)', one row for an entry."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for _, x, w in _slices(batches, dimension):
            centred = x - mean
            total += (centred * w[:, None]).T @ centred
        yield _matrix_rows(total)

    return products


def _exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)**2; None beyond a long."""
    rough = ((n * x.astype(np.float64) - np.array(sums, np.float64)) ** 2).sum(axis=1)
    if rough.max(initial=0) < 2.0**62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return [d if d < 1 << 63 else None for d in exact]


def _projected(dimension: int, n: int, sums: list[int], mean: np.ndarray, basis: np.ndarray):
    """(x, w, deviation, z): each distinct vector's exact deviation and whitened components."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x, _ in _slices(batches, dimension):
            z = (x - mean) @ basis
            yield pa.RecordBatch.from_arrays(
                [part.column("x"), part.column("copies"), part.column("w"), pa.array(_exact_deviation(x, n, sums), pa.int64()), pa.array(list(z), pa.list_(pa.float64()))],
                ["x", "copies", "w", "deviation", "z"],
            )

    return project


def _summed(entries: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """A matrix from rows (i, j, v) of the tasks: as many rows come to the driver as it has entries."""
    out = np.zeros(shape)
    for r in entries.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out


def _column_sums(dimension: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x, w in _slices(batches, dimension):
            total = (x.astype(object) * w[:, None].astype(object)).sum(axis=0) if len(x) and np.abs(x).max() * float(w.max()) * len(x) > 2.0**62 else (x * w[:, None]).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(range(dimension), pa.int32()), pa.array([str(v) for v in total]), pa.array(np.full(dimension, w.sum()), pa.int64())], ["i", "v", "n"])

    return sums


class Whitening:
    """What the fit gives: ``n`` and ``sums`` (exact), ``mean``, ``eigenvalues`` and unit ``vectors`` (falling, as columns), ``trace``."""

    def __init__(self, distinct: DataFrame, dimension: int):
        parts = distinct.mapInArrow(_column_sums(dimension), "i int, v string, n long")
        sums = parts.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.sum("n").alias("n")).orderBy("i").collect()
        self.n = sums[0].n if sums else 0
        self.sums = [int(r.v) for r in sums] if sums else [0] * dimension
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(dimension)
        covariance = _summed(distinct.mapInArrow(_products(dimension, self.mean), "i int, j int, v double"), (dimension, dimension)) / max(self.n, 1)
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        self.eigenvalues, self.vectors, self.trace = values[::-1], vectors[:, ::-1], float(np.trace(covariance))

    def basis(self, components: int) -> np.ndarray:
        """Columns that whiten; NaN where a component has no variance."""
        e = self.eigenvalues[:components]
        none = e <= len(self.eigenvalues) * np.finfo(float).eps * max(self.eigenvalues[0], 0) if len(e) else e
        return self.vectors[:, :components] / np.sqrt(np.where(none, np.nan, e))


def _identity_error(whitened: DataFrame, components: int) -> float | None:
    """Largest entry of |covariance of z - identity|, centred, with the fit's weights; over components with variance."""
    got = whitened.agg(F.sum("w").alias("n"), *[F.sum(F.col("w") * F.get("z", F.lit(i))).alias(f"s{i}") for i in range(components)]).first()
    if not got.n:
        return None
    mean = [got[f"s{i}"] / got.n for i in range(components)]
    at = lambda i: F.get("z", F.lit(i)) - F.lit(mean[i])
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    sums = whitened.agg(*[F.sum(F.col("w") * at(i) * at(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    errors = [abs(sums[f"c{i}_{j}"] / got.n - (i == j)) for i, j in pairs]
    return max((e for e in errors if e == e), default=None)


def whiten(docs: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS, keep: list[str] | None = None, weights: str = "one", scale: int = SCALE, dimension: int | None = None) -> DataFrame:
    """Principal components of every valid vector, scaled to variance one.

    A row for each valid row and component, 1 to ``components`` (or ``dimension`` if that is less). Added to ``keep`` (all columns
    by default; those named like a new one, in any case, are replaced): ``component``; ``n``, the fit's weight; ``deviation``,
    the exact sum over dimensions of (n x - S)**2 (null beyond a long); ``whitened``; ``explained``, the component's share of the
    variance; ``identity_error``, the largest entry of the whitened covariance less the identity.

    Entries c become whole numbers x = floor(``scale`` c). Rows of one x vector are grouped, and only distinct vectors go on: each
    weighs its number of rows (``weights="count"``) or one (``"one"``). Sums are exact, so the mean does not depend on the
    layout; each task multiplies its centred vectors into one matrix of ``dimension`` squared and the matrices are added, so as
    many numbers reach the driver as the covariance has. Components are unit eigenvectors by falling eigenvalue, their sign
    such that the largest entry is above zero. Every distinct vector is projected once and joined back to its rows; vectors of
    over a thousandth of the rows (fewer than a thousand) are broadcast for that.

    Null vectors and vectors with a null or non-finite entry, or one too large for a long, are dropped. ``dimension`` is the most
    frequent length (of equally frequent ones the longest) unless given; vectors of other lengths, empty ones too, are dropped. A
    component without variance has a null ``whitened`` (one distinct vector, or fewer than dimensions) and leaves ``identity_error``
    to the others. Repeated rows come out as often as they are there. An empty table gives an empty result.
    """
    need(docs, vec_col)
    if weights not in ("one", "count"):
        raise ValueError(f"weights: one or count, not {weights!r}")
    boxed = Boxed(docs, keep, ["component", "n", "deviation", "whitened", "explained", "identity_error"])
    rows = docs.select(boxed.box, col_of(vec_col).cast("array<double>").alias("_vec")).where("size(_vec) > 0 and not exists(_vec, c -> c is null)")
    if dimension is None:
        sizes = rows.groupBy(F.size("_vec").alias("d")).agg(F.count("*").alias("n"))
        best = sizes.agg(F.max(F.struct("n", "d"))["d"].alias("d")).first()
        dimension = best.d or 1
    rows = rows.where(F.size("_vec") == dimension)
    kind = rows.schema["_doc"].dataType.simpleString()
    rows = materialize(rows.mapInArrow(_quantize(dimension, scale), f"_doc {kind}, x binary"))
    distinct = rows.groupBy("x").agg(F.count("*").alias("copies"))
    distinct = materialize(distinct.select("x", "copies", (F.lit(1).cast("long") if weights == "one" else F.col("copies")).alias("w")))

    fit = Whitening(distinct, dimension)
    k = min(components, dimension)
    basis = fit.basis(k)
    basis *= np.where(basis[np.abs(np.nan_to_num(basis)).argmax(axis=0), np.arange(k)] < 0, -1, 1)
    whitened = distinct.mapInArrow(_projected(dimension, fit.n, fit.sums, fit.mean, basis), "x binary, copies long, w long, deviation long, z array<double>")
    whitened = materialize(whitened)
    error = _identity_error(whitened, k)
    explained = [float(e / fit.trace) if fit.trace > 0 else 0.0 for e in np.maximum(fit.eigenvalues[:k], 0)]

    out = spread_join(rows, whitened, "x", "copies").select("_doc", "deviation", F.posexplode("z").alias("c", "z"))
    return out.select(
        *boxed.columns(),
        (F.col("c") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        F.when(~F.isnan("z"), F.col("z")).alias("whitened"),
        F.get(F.lit(explained), F.col("c")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), keep=["vec_id"])
