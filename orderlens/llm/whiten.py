"""Whitening of embeddings from an exact scatter of bit planes.

Entries become whole numbers, ``x = floor(1024 c) + 100000``. A block of rows is shifted
by its own smallest numbers, and each dimension is cut into bit planes, packed across the
rows into 64-bit words. The cross-product of two dimensions is then the sum over their
planes of 2^(a + b) times the bits set in both: an AND and a popcount. Blocks undo their
shift in whole numbers and tasks add them up; Spark adds the tasks' sums as 32-bit limbs,
so the scatter, the sums and the covariance are exact for any number of rows. The driver
gets the scatter, one number for each pair of dimensions, centres it as integers
(n X - S S'), and takes the eigenvectors of the covariance.

The time of a block grows with the square of its planes: about 700 for 64 dimensions of
unit vectors; planes that no row sets are left out.

Defined cases: null vectors, vectors without entries and vectors with a null or
non-finite entry are left out. The dimension is that of most vectors (ties: the larger);
vectors of another length cannot be compared with them and are left out too. Numbers
beyond a long stop at its ends. ``deviation`` is null where the exact sum has more than
38 digits. A component whose variance is zero (next to the largest) cannot be
whitened: its ``whitened`` is null and it does not count in ``identity_error``, which is
null when no component is left. Rows are judged one by one, repeated ids too; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import stages

# Scale and shift of the whole numbers, and the ends of a long.
SCALE, SHIFT = 1024, 100_000
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1
# 32-bit limbs of a sum: products of two longs, added over up to 2^50 rows.
LIMB_BITS, LIMBS = 32, 6
# Numbers in a block, and the share of the largest variance below which a variance is zero.
BLOCK_NUMBERS, ZERO_SHARE = 1 << 20, 1e-13


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf")))
                      & ~F.isnan(c.cast("double")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def numbers(batch: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) whole numbers of a list column."""
    c = np.asarray(batch.flatten()).astype(np.float64).reshape(-1, dim)
    with np.errstate(over="ignore"):
        scaled = np.floor(c * SCALE)
    inside = (scaled > -2.0**62) & (scaled < 2.0**62)
    x = np.where(inside, scaled, 0).astype(np.int64) + SHIFT
    if not inside.all():
        for i, j in zip(*np.nonzero(~inside)):
            whole = LONG_MAX if scaled[i, j] == np.inf else LONG_MIN if scaled[i, j] == -np.inf else int(scaled[i, j])
            x[i, j] = min(LONG_MAX, max(LONG_MIN, whole) + SHIFT)
    return x


def planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bit planes (planes, words) of unsigned (rows, dim); dimension and bit of each, by dimension."""
    rows, dim = shifted.shape
    padded = np.zeros((dim, -(-rows // 64) * 64), np.uint64)
    padded[:, :rows] = shifted.T
    found, owner, bit = [], [], []
    for b in range(int(shifted.max()).bit_length()):
        packed = np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.uint64)
        set_in = np.flatnonzero(packed.any(axis=1))
        found.append(packed[set_in])
        owner.append(set_in)
        bit.append(np.full(len(set_in), b))
    if not found:
        return np.empty((0, padded.shape[1] // 64), np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    owner, bit = np.concatenate(owner), np.concatenate(bit)
    order = np.lexsort((bit, owner))
    return np.concatenate(found)[order], owner[order], bit[order]


def plane_products(packed: np.ndarray) -> np.ndarray:
    """Rows that two planes have in common, for all pairs: AND and popcount."""
    n = len(packed)
    common = np.zeros((n, n), np.int64)
    for k in range(n):
        own = np.bitwise_count(packed[k:] & packed[k]).sum(axis=1, dtype=np.int64)
        common[k, k:] = own
        common[k:, k] = own
    return common


def weigh(common: np.ndarray, owner: np.ndarray, bit: np.ndarray, dim: int, rows: int) -> np.ndarray:
    """Cross-products (dim, dim) from the counts of plane pairs; Python integers where a long is too short."""
    kind = np.int64 if 2 * (int(bit.max(initial=0)) + 1) + rows.bit_length() < 63 else object
    weight = np.array([1 << int(b) for b in bit], kind)
    out = np.zeros((dim, dim), kind)
    if not len(owner):
        return out
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    by_row = np.add.reduceat(common.astype(kind) * weight[:, None], heads, axis=0)
    by_both = np.add.reduceat(by_row * weight[None, :], heads, axis=1)
    out[np.ix_(owner[heads], owner[heads])] = by_both
    return out


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of a block, as Python integers."""
    rows, dim = x.shape
    least = x.min(axis=0)
    packed, owner, bit = planes(x.view(np.uint64) - least.view(np.uint64))
    common = plane_products(packed)
    cross = weigh(common, owner, bit, dim, rows).astype(object)
    total = np.zeros(dim, object)
    for p, d, b in zip(np.diag(common).tolist(), owner.tolist(), bit.tolist()):
        total[d] += p << b
    base = least.astype(object)
    cross = cross + np.outer(base, total) + np.outer(total, base) + rows * np.outer(base, base)
    return total + rows * base, cross


def limbs(value: int) -> tuple[int, ...]:
    low = [value >> (LIMB_BITS * k) & ((1 << LIMB_BITS) - 1) for k in range(LIMBS - 1)]
    return (*low, value >> (LIMB_BITS * (LIMBS - 1)))


SUMS = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))


def _scatter_rows(dim: int):
    """Rows (i, j, limbs): cross-products for i <= j, sums with j = -1, the number of rows with i = j = -1."""
    step = max(64, BLOCK_NUMBERS // dim // 64 * 64)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        n, total, cross = 0, np.zeros(dim, object), np.zeros((dim, dim), object)

        def add(x: np.ndarray) -> None:
            nonlocal n, total, cross
            s, c = scatter(x)
            n, total, cross = n + len(x), total + s, cross + c

        for batch in batches:
            for at in range(0, batch.num_rows, step):
                x = numbers(batch.column(0).slice(at, step), dim)
                held.append(x)
                size += len(x)
                while size >= step:
                    x = np.concatenate(held)
                    add(x[:step])
                    held, size = [x[step:]], size - step
        if size:
            add(np.concatenate(held))
        if n:
            rows = [(-1, -1, n), *((i, -1, total[i]) for i in range(dim)),
                    *((i, j, cross[i, j]) for i in range(dim) for j in range(i, dim))]
            for at in range(0, len(rows), 1 << 16):
                i, j, value = zip(*rows[at:at + (1 << 16)])
                parts = zip(*(limbs(int(v)) for v in value))
                yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                       *[pa.array(p, pa.int64()) for p in parts]],
                                      ["i", "j", *[f"l{k}" for k in range(LIMBS)]])

    return sums


@dataclass
class Whitening:
    """What the fit list gives: rows, sums, the unit components (count, dim), their variances, the total variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def scales(self) -> np.ndarray:
        """One over the root of each variance; nan where it is zero."""
        most = self.variances.max(initial=0.0)
        real = self.variances > ZERO_SHARE * most
        return np.where(real, 1 / np.sqrt(np.where(real, self.variances, 1.0)), np.nan)


def dimension(vectors: DataFrame) -> int:
    """The length of most vectors; 0 for none."""
    top = (vectors.groupBy(F.size("_vector").alias("d")).count()
           .orderBy(F.desc("count"), F.desc("d")).first())
    return top["d"] if top else 0


def fit(vectors: DataFrame, dim: int, count: int = 8) -> Whitening:
    """Components of all rows of ``_vector``. The driver gets (dim + 1)(dim + 2) / 2 sums."""
    rows = (vectors.select("_vector").mapInArrow(_scatter_rows(dim), SUMS)
            .groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)])).toArrow()
    i, j, *parts = (rows.column(c).to_pylist() for c in range(2 + LIMBS))
    value = {(a, b): sum(p << (LIMB_BITS * k) for k, p in enumerate(own)) for a, b, *own in zip(i, j, *parts)}
    n, sums = value[-1, -1], [value[d, -1] for d in range(dim)]
    # n X - S S' is whole; its quotient by n^2 is rounded once.
    cov = np.empty((dim, dim))
    for a in range(dim):
        for b in range(a, dim):
            cov[a, b] = cov[b, a] = (n * value[a, b] - sums[a] * sums[b]) / (n * n)
    found, axes = np.linalg.eigh(cov)
    order = np.argsort(-found, kind="stable")[:count]
    return Whitening(n, sums, axes[:, order].T.copy(), np.maximum(found[order], 0.0), float(np.trace(cov)))


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: longs where they are long enough, Python integers otherwise."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * most + max(map(abs, sums)) < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(y: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if y.dtype == object:
        return [int(s) for s in (y * y).sum(axis=1)]
    most = int(np.abs(y).max(initial=0)).bit_length()
    if 2 * most + y.shape[1].bit_length() < 63:
        return (y * y).sum(axis=1).tolist()
    if most > 57:
        return squares(y.astype(object))
    high, low = y >> 28, y & ((1 << 28) - 1)
    return [(h << 56) + (m << 29) + s for h, m, s in zip(
        _sum_exact(high, high), _sum_exact(high, low), _sum_exact(low, low))]


def _sum_exact(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Row sums of products below 2^58 each, 16 columns at a time."""
    totals = np.zeros(len(a), object)
    for k in range(0, a.shape[1], 16):
        totals = totals + (a[:, k:k + 16] * b[:, k:k + 16]).sum(axis=1).astype(object)
    return totals.tolist()


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` (``_id``, ``_vector``) as ``_id``, ``deviation`` (decimal) and ``whitened`` (one entry a component)."""
    dim, axes = len(model.sums), model.components
    scales, n, sums = model.scales(), model.n, model.sums

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.decimal128(38, 0)
        step = max(1, BLOCK_NUMBERS // dim)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                own = batch.slice(at, step)
                y = centred(numbers(own.column(1), dim), n, sums)
                told = [str(s) if s < 10**38 else None for s in squares(y)]
                white = ((y / n).astype(np.float64) @ axes.T) * scales
                flat = pa.array(white.ravel(), from_pandas=True)
                ends = pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1])
                yield pa.record_batch([own.column(0), pa.array(told, pa.string()).cast(whole),
                                       pa.ListArray.from_arrays(ends, flat)], ["_id", "deviation", "whitened"])

    return rows.select("_id", "_vector").mapInArrow(
        project, "_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(white: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened rows' covariance minus the identity, over all rows."""
    real = [k for k, s in enumerate(model.scales()) if not np.isnan(s)]
    if not real:
        return None
    entries = [F.abs(F.covar_pop(F.col("whitened")[a], F.col("whitened")[b]) - float(a == b))
               for a in real for b in real if a <= b]
    return white.agg(F.array_max(F.array(*entries)).alias("worst")).first()["worst"]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = 8) -> DataFrame:
    """One row for each usable vector and component up to ``count``.

    ``_id``, ``component`` (from 1), ``n``, ``deviation`` (decimal), ``whitened``, ``explained``, ``identity_error``.
    """
    spark = rows.sparkSession
    vectors = rows.filter(usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_vector"))
    dim = dimension(vectors)
    if not dim:
        return spark.createDataFrame([], "_id long, component int, n long, deviation decimal(38,0), "
                                         "whitened double, explained double, identity_error double")
    vectors = vectors.filter(F.size("_vector") == dim)
    model = fit(vectors, dim, count)
    white = stages.stage(transform(vectors, model), "whitened")
    error = identity_error(white, model)
    shares = [float(v) / model.trace if model.trace else None for v in model.variances]
    return (white.select("_id", "deviation", F.posexplode("whitened").alias("_k", "whitened"))
            .select("_id", (F.col("_k") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened",
                    F.array(*[F.lit(s).cast("double") for s in shares])[F.col("_k")].alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))
