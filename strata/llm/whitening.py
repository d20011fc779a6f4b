"""Embedding whitening from a weighted multiplicity covariance.

Vectors are put on an integer grid, identical ones are grouped, and the
covariance is a centred matrix product over the distinct vectors, weighted by
their counts (or by one each). Every distinct vector is whitened once; rows
get theirs by a join.

How it is spread: a task groups its own rows before anything moves, so a
vector that a third of all rows share is one row a batch; sums and products
leave a task as one vector and one matrix. Only these (dimension times
dimension numbers) reach the driver, for the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, frees_memory, materialize

GRID, OFFSET = 64, 1_000_000
MAX_DIM = 4096
HOT_PARTS = 200  # a vector with more than this part of all rows is hot
_SAFE = 1 << 62


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, x as int64) of the usable vectors of a batch."""
    sizes = pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == d)
        flat = column.take(pa.array(rows)).flatten()
        c = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)  # NULL entries become NaN
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(GRID * c) + OFFSET
        ok = (np.isfinite(c) & (np.abs(x) < float(_SAFE))).all(axis=1)
        yield d, rows[ok], np.floor(GRID * c[ok]).astype(np.int64) + OFFSET


def group_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(dim, x binary, ids array): the ids of equal vectors of a batch
    together; stored. ``x`` holds little-endian longs."""
    src = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, keys, ids = [], [], []
            row_ids = b.column(0).to_pylist()
            for d, at, x in _vectors(b.column(1)):
                groups: dict[bytes, list] = {}
                for r, blob in zip(at.tolist(), x.astype("<i8").view(f"V{8 * d}").ravel().tolist()):
                    groups.setdefault(blob, []).append(row_ids[r])
                dims += [d] * len(groups)
                keys += groups
                ids += groups.values()
            yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(ids, pa.list_(pa.int64()))],
                                             ["dim", "x", "ids"])

    return materialize(src.mapInArrow(frees_memory(run), "dim int, x binary, ids array<long>"), "whiten-groups")


# -- exact sums and centred products ----------------------------------------

def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, d)


def column_sums(distinct: DataFrame, d: int) -> tuple[int, list[int]]:
    """Exact (n, sums) of the weighted vectors (x, w)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for b in batches:
            w = b.column(1).to_numpy(zero_copy_only=False)
            x = _matrix(b.column(0), d)
            if len(x):
                n += int(w.sum())
                safe = int(np.abs(x).max()) * int(w.sum()) < _SAFE
                s = w @ x if safe else w.astype(object) @ x.astype(object)
                total = [a + int(v) for a, v in zip(total, s)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38, 0))], ["i", "v"])

    found = distinct.select("x", "w").mapInArrow(run, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()
    by = {r["i"]: int(r["v"]) for r in found}  # one number a dimension
    return by.get(0, 0), [by.get(i + 1, 0) for i in range(d)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: int64 where it fits, else Python integers."""
    top = max(int(np.abs(x).max()) if x.size else 0, 1)
    if top * n < _SAFE and max(map(abs, sums)) < _SAFE:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def weighted_product(frame: DataFrame, columns: list[str], d: int, vectors: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum of w * y y' over all rows; ``vectors`` gives (y, w) of a batch of
    ``columns``. Tasks send one matrix each, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for b in batches:
            y, w = vectors(b)
            total += (y * w[:, None]).T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([r.tobytes() for r in total.astype("<f8")], pa.binary())], ["i", "row"])

    def add(t: pa.Table) -> pa.Table:
        row = np.sum([np.frombuffer(r, "<f8") for r in sorted(t["row"].to_pylist())], axis=0)
        return pa.table([pa.array([t["i"][0].as_py()], pa.int32()), pa.array([row.tobytes()], pa.binary())], names=["i", "row"])

    rows = frame.select(*columns).mapInArrow(frees_memory(run), "i int, row binary").groupBy("i").applyInArrow(add, "i int, row binary").collect()
    out = np.zeros((d, d))
    for r in rows:  # d rows of d numbers
        out[r["i"]] = np.frombuffer(r["row"], "<f8")
    return out


# -- model ------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """Fit of the vectors: exact sums, eigenvalues (falling) and unit
    eigenvectors (columns) of the leading components."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def project(self, d: np.ndarray) -> np.ndarray:
        """Whitened vectors from n * x - sums."""
        return (np.asarray(d, np.float64) / self.n) @ self.vectors / np.sqrt(self.values)


def fit(distinct: DataFrame, d: int, components: int) -> Whitening:
    """Whitening of the weighted vectors (x, w). Components whose eigenvalue
    is zero to double precision are left out: nothing can be whitened there."""
    n, sums = column_sums(distinct, d)

    def vectors(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return np.asarray(centred(_matrix(b.column(0), d), n, sums), np.float64) / n, b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)

    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    cov = weighted_product(distinct, ["x", "w"], d, vectors) / n
    cov = (cov + cov.T) / 2
    values, directions = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")
    values, directions = values[order], directions[:, order]
    keep = int((values > max(values[0], 0.0) * d * np.finfo(float).eps).sum())
    keep = min(keep, components)
    directions = directions[:, :keep]
    sign = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(keep)])  # the largest entry is positive
    return Whitening(n, sums, values[:keep], directions * sign, float(np.trace(cov)))


def _whitened(distinct: DataFrame, model: Whitening, d: int) -> DataFrame:
    """(x, w, deviation, z array): every distinct vector once; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            diff = centred(_matrix(b.column(0), d), model.n, model.sums)
            top = max(abs(int(v)) for v in (diff.min(), diff.max())) if diff.size else 0
            if diff.dtype == object or top * top * d >= _SAFE:
                far = [sum(int(v) * int(v) for v in row) for row in diff]
            else:
                far = (diff * diff).sum(axis=1).tolist()
            z = model.project(diff)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([v if v < 1 << 63 else None for v in far], pa.int64()),
                 pa.array(list(z), pa.list_(pa.float64()))], ["x", "w", "deviation", "z"])

    return materialize(distinct.select("x", "w").mapInArrow(frees_memory(run), "x binary, w long, deviation long, z array<double>"), "whitened")


def _identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest entry of the whitened covariance minus the identity, measured
    on the whitened vectors, centred with their own mean."""
    means = whitened.select("w", F.posexplode("z").alias("i", "v")).groupBy("i").agg((F.sum(F.col("w") * F.col("v")) / n).alias("m")).collect()
    mean = np.zeros(k)
    for r in means:  # one number a component
        mean[r["i"]] = r["m"]

    def vectors(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        z = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        return z - mean, b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)

    return float(np.abs(weighted_product(whitened, ["z", "w"], k, vectors) / n - np.eye(k)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, weighting: str = "count") -> DataFrame:
    """Per usable row: vec_id, n, deviation, z (whitened, leading components),
    explained (share of the variance of each), identity_error.

    Entries c become x = floor(64 c) + 1000000. ``weighting``: ``count`` fits
    on all rows, ``one`` on the distinct vectors (n and the sums are then
    theirs). ``deviation`` is the exact sum over dimensions of (n x - S)^2,
    NULL where no long holds it. Eigenvectors have unit length and a positive
    largest entry. Components without variance are left out, so equal vectors
    only (or a single row) give empty lists.

    Rows are dropped if the vector is NULL or empty, holds NULL or non-finite
    entries or one whose x is beyond 2^62, or is not as long as most vectors
    (ties: the longer). NULL ids keep their row, repeated rows give repeated
    results, an empty table gives no rows, other columns are not read.
    """
    if weighting not in ("count", "one"):
        raise ValueError("weighting is count or one")
    groups = group_vectors(rows, id_col, vector_col)
    usual = groups.groupBy("dim").agg(F.sum(F.size("ids")).alias("n")).orderBy(F.desc("n"), F.desc("dim")).head()
    d = usual["dim"] if usual else 1
    if d > MAX_DIM:
        raise ValueError(f"vectors of more than {MAX_DIM} dimensions: their covariance does not fit one machine")
    groups = groups.where(F.col("dim") == d)
    weight = F.sum(F.size("ids")) if weighting == "count" else F.lit(1)
    distinct = groups.groupBy("x").agg(F.sum(F.size("ids")).alias("rows"), weight.cast("long").alias("w"))
    distinct = materialize(distinct, "whiten-distinct")
    model = fit(distinct, d, components)
    k = len(model.values)
    done = _whitened(distinct, model, d)
    error = _identity_error(done, model.n, k) if k else 0.0

    # a hot vector's groups are dealt to several tasks; there are fewer than HOT_PARTS such vectors
    total = distinct.agg(F.sum("rows")).head()[0] or 1
    hot = cut(distinct.where(F.col("rows") * HOT_PARTS > total).select("x", F.ceil(F.col("rows") * HOT_PARTS / total).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    spread = groups.join(F.broadcast(hot), "x", "left").select("x", "ids", F.pmod(F.xxhash64("ids"), salts).cast("int").alias("salt"))
    copies = done.join(F.broadcast(hot), "x", "left").select("x", "deviation", "z", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if k else F.array().cast("array<double>")
    return spread.join(copies, ["x", "salt"]).select(
        F.explode("ids").alias("vec_id"), F.lit(model.n).cast("long").alias("n"), "deviation", "z", share.alias("explained"),
        F.lit(error).alias("identity_error"))


def by_component(whitened: DataFrame) -> DataFrame:
    """The result of ``whiten`` in long form: one row a row and component."""
    return whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("z", "explained")).alias("at", "c")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.z").alias("whitened"), F.col("c.explained").alias("explained"),
        "identity_error")
