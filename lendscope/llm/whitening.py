"""Whitening of vectors by their covariance, fitted on distinct vectors weighted by their multiplicity or by one.

Identical vectors are grouped first. Their sums are whole numbers and exact; each distinct vector is centred by them
before it enters the covariance as one weighted matrix product a batch, and partial products are added up in Spark.
Only the covariance, whose size is the square of the vectors' length, reaches the driver. Each distinct vector is then
whitened once, and the rows find theirs by a join: through a bounded broadcast for vectors that very many rows share,
through a shuffle for all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import stored

COMPONENTS = 16
HOT = 1_000  # vectors that more than one row in so many shares are joined by broadcast: fewer than so many vectors
# Components with less than this part of the largest eigenvalue hold no variance beyond rounding.
NO_VARIANCE = 1e-9
# Codes stay whole numbers of a double within this bound.
BOUND = 2.0**52

WHITENED = "x array<long>, copies long, n long, deviation long, parts array<struct<whitened: double, explained: double>>"


def usable(embedding: str) -> Column:
    """True for a vector without null, NaN or infinite entries; false for a null one."""
    entries = F.col(embedding).cast("array<double>")
    good = F.forall(entries, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return F.coalesce(good, F.lit(False))


def grid(embedding: str, steps: int = 64, shift: int = 1_000_000) -> Column:
    """Entries as whole numbers: floor(steps * entry) + shift. What leaves the doubles' whole numbers is clamped."""
    scaled = F.transform(F.col(embedding).cast("array<double>"), lambda e: F.floor(_clamped(e * F.lit(float(steps)))))
    return F.transform(scaled, lambda x: x + F.lit(shift))


def _clamped(value: Column) -> Column:
    return F.greatest(F.least(value, F.lit(BOUND)), F.lit(-BOUND))


@dataclass
class Fit:
    """Exact sums of the fit list for one vector length, and what follows from them."""

    n: int
    sums: list[int]
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    axes: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    trace: float = 0.0

    def __post_init__(self) -> None:
        # n * x - sum = n * (x - base) - rest, with small numbers.
        self.base = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sum / n."""
        return (x - self.base) - (self.rest / self.n).astype(float)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum) squared, exact; null where that leaves a long."""
        y = x - self.base
        reach = int(np.abs(y).max(initial=0)) + 1
        small = x.shape[1] * (self.n * reach) ** 2 < 1 << 63
        off = y * self.n - self.rest.astype(np.int64) if small else y.astype(object) * self.n - self.rest
        return [int(d) if d < 1 << 63 else None for d in (off * off).sum(axis=1)]

    def solve(self, covariance: np.ndarray, components: int) -> None:
        """The leading unit eigenvectors, each with its largest entry positive."""
        values, axes = np.linalg.eigh(covariance)
        values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
        kept = values > max(NO_VARIANCE * values.max(initial=0), 0)
        self.values, axes = values[kept], axes[:, kept]
        sign = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]) if kept.any() else 1.0
        self.axes, self.trace = axes * sign, float(np.trace(covariance))

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)


def _by_length(batch: pa.RecordBatch, column: str, kind: type) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) for each length of the vectors in a batch."""
    lists = batch.column(batch.schema.get_field_index(column))
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield int(d), at, flat.astype(kind, copy=False).reshape(len(at), int(d))


def _weights(batch: pa.RecordBatch, at: np.ndarray) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("weight")).to_numpy(zero_copy_only=False)[at]


def exact_sums(weighted: DataFrame) -> dict[int, Fit]:
    """Number and sums of the vectors in column ``x``, by length. Partial sums are whole numbers of any size."""
    schema = pa.schema([("d", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("s", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for d, at, x in _by_length(batch, "x", np.int64):
                w = _weights(batch, at)
                wide = int(np.abs(x).max(initial=0)) * int(w.sum()) >= 1 << 62
                sums = (x.astype(object) * w[:, None]).sum(axis=0) if wide else w @ x
                n, before = held.get(d, (0, [0] * d))
                held[d] = n + int(w.sum()), [a + int(b) for a, b in zip(before, sums)]
        for d, (n, sums) in held.items():
            if d:
                yield pa.record_batch([[d] * d, list(range(d)), [n] * d, list(map(str, sums))], schema=schema)

    parts = weighted.mapInArrow(run, "d int, i int, n long, s string").groupBy("d", "i")
    found = parts.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    fits: dict[int, Fit] = {}
    for d in {r.d for r in found}:
        own = sorted((r for r in found if r.d == d), key=lambda r: r.i)
        fits[d] = Fit(own[0].n, [int(r.s) for r in own])
    return fits


def covariances(weighted: DataFrame, column: str, centred: dict[int, Callable], n: dict[int, int]) -> dict[int, np.ndarray]:
    """The covariance of the vectors in ``column`` by key: one weighted product a batch, added up in Spark.

    ``centred`` maps a length to the function that takes the mean from a matrix of such vectors; ``n`` has the divisors.
    """
    schema = pa.schema([("d", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())])
    kind = np.int64 if column == "x" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, at, x in _by_length(batch, column, kind):
                if d in centred:
                    z = centred[d](x)
                    held[d] = held.get(d, 0.0) + (z * _weights(batch, at)[:, None]).T @ z
        for d, product in held.items():
            i, j = np.triu_indices(len(product))
            columns = (np.full(len(i), d), i, j, product[i, j])
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    parts = weighted.mapInArrow(run, "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    for r in parts.collect():
        size = out.setdefault(r.d, np.zeros((r.d, r.d)))
        size[r.i, r.j] = size[r.j, r.i] = r.v / n[r.d]
    return out


def whiten(
    vectors: DataFrame, x: Column, components: int = COMPONENTS, weights: str = "one", vec_id: str = "vec_id"
) -> DataFrame:
    """One row per row of ``vectors`` and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``x`` gives a row's vector as whole numbers. The fit list has each distinct vector once (``weights="one"``) or as
    often as it occurs (``"count"``); vectors that are null or hold null take no part. ``n`` is the list's length, ``deviation`` the exact sum over dimensions of
    (n * x - S)^2, null where it leaves a long. Components are unit eigenvectors of the fit list's covariance by
    falling eigenvalue; ``whitened`` is the centred vector projected on one, over the root of its eigenvalue, and
    ``identity_error`` the largest absolute entry of whitened's covariance minus the identity.

    Vectors of different lengths are fitted apart. Components without variance give no rows, and so do a table with
    one distinct vector, empty vectors, and an empty table. Null ids and repeated rows are rows like any other.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights are 'one' or 'count', not {weights!r}")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.where(F.col("x").isNotNull() & ~F.exists("x", lambda e: e.isNull()))
    weight = F.col("copies") if weights == "count" else F.lit(1).cast("long")
    distinct = stored(rows.groupBy("x").agg(F.count("*").alias("copies")).withColumn("weight", weight), "distinct")
    fits = exact_sums(distinct)
    centred, n = {d: f.centred for d, f in fits.items()}, {d: f.n for d, f in fits.items()}
    for d, covariance in covariances(distinct, "x", centred, n).items():
        fits[d].solve(covariance, components)
    whitened = stored(_whitened(distinct, fits), "whitened")
    error = _identity_error(whitened.withColumn("weight", weight), fits)

    total = whitened.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") > max(HOT, total // HOT)
    common, rare = (whitened.where(c).select("x", "n", "deviation", "parts") for c in (hot, ~hot))
    by_broadcast = rows.join(F.broadcast(common), "x")
    by_shuffle = rows.join(F.broadcast(common.select("x")), "x", "left_anti").join(rare, "x")
    joined = by_broadcast.unionByName(by_shuffle)
    each = joined.select("vec_id", "n", "deviation", F.posexplode("parts").alias("at", "part"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "part.whitened", "part.explained",
        F.lit(error).alias("identity_error"),
    )


def _whitened(distinct: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """Each distinct vector with its deviation and its leading components."""
    part = pa.struct([("whitened", pa.float64()), ("explained", pa.float64())])
    schema = pa.schema(
        [("x", pa.list_(pa.int64())), ("copies", pa.int64()), ("n", pa.int64()), ("deviation", pa.int64()), ("parts", pa.list_(part))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, x in _by_length(batch, "x", np.int64):
                if d not in fits:
                    continue
                fit = fits[d]
                own = batch.take(pa.array(at))
                values = fit.whiten(x)
                k = values.shape[1]
                explained = np.tile(fit.values / fit.trace if k else fit.values, len(at))
                flat = pa.StructArray.from_arrays([pa.array(values.ravel()), pa.array(explained)], fields=list(part))
                parts = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * k, pa.int32()), flat)
                columns = [own.column(0), own.column(1), pa.array(np.full(len(at), fit.n)), pa.array(fit.deviation(x)), parts]
                yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return distinct.select("x", "copies").mapInArrow(run, WHITENED)


def _identity_error(whitened: DataFrame, fits: dict[int, Fit]) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity; 0 without components.

    Fits are told apart by the length of ``x``; their whitened vectors are centred by their own mean first.
    """
    worst = 0.0
    for d, fit in fits.items():
        k = len(fit.values)
        if not k:
            continue
        own = whitened.where(F.size("x") == d).select(F.transform("parts", lambda p: p["whitened"]).alias("w"), "weight")
        sums = own.select(F.posexplode("w").alias("i", "v"), "weight").groupBy("i").agg(F.sum(F.col("v") * F.col("weight")).alias("s"))
        mean = np.zeros(k)
        for r in sums.collect():
            mean[r.i] = r.s / fit.n
        covariance = covariances(own, "w", {k: lambda w, mean=mean: w - mean}, {k: fit.n})[k]
        worst = max(worst, float(np.abs(covariance - np.eye(k)).max()))
    return worst


def whiten_embeddings(vectors: DataFrame, components: int = COMPONENTS, weights: str = "one", embedding: str = "embedding") -> DataFrame:
    """``whiten`` for real vectors on a grid of whole numbers; null vectors and those with null, NaN or infinite
    entries take no part."""
    return whiten(vectors.where(usable(embedding)), grid(embedding), components, weights)
