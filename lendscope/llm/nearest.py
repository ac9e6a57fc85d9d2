"""Nearest neighbours with randomly rotated one-bit codes.

Every vector is centred, normalised, rotated by a random orthogonal matrix and kept as one sign bit a dimension, with
two correction scalars: its distance from the centre and the inner product of its code with itself. A query is
rotated alike and cut to 8 bits a dimension; its inner product with a code is eight popcounts of packed words. From
it follow an estimate of the distance and a bound on the estimate's error. Only vectors whose lower bound does not
exceed the k-th smallest upper bound are reranked on their original components. Bounds and ranks count distinct ids: an
id with several vectors has one place, that of its nearest.

Queries meet the index in blocks: a block of queries and a block of codes make one cell, a cell gives each of its
queries at most k rows, and these are merged by query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import bucket_of, stored, width

SAMPLE = 4_096  # vectors that the centre is fitted on, in the order of a hash of the id
SURE = 4.0  # error bound in standard deviations of the estimate
LEVELS = 255  # steps of a query component
QUERY_BLOCK = 1_024
CODE_BLOCK = 8_192

INDEX = "vec_id long, dim int, vector binary, code binary, far double, fit double"
_INDEX_ARROW = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("dim", pa.int32()),
        ("vector", pa.binary()),
        ("code", pa.binary()),
        ("far", pa.float64()),
        ("fit", pa.float64()),
    ]
)
FOUND = "query_id long, vec_id long, score double"
_FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same on every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, dim, vector as packed doubles) without null, empty, zero or non-finite vectors and null ids."""
    kind = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("vector", pa.binary())])
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, v in zip(batch["vec_id"].to_pylist(), batch["v"]):
                x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
                # Nulls arrive as not-a-number.
                if np.isfinite(x).all() and x.any():
                    out.append((name, len(x), x.tobytes()))
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)

    return rows.where("vec_id is not null and v is not null").mapInArrow(run, "vec_id long, dim int, vector binary")


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean length of each row; scaled by powers of two, so that squares neither overflow nor vanish."""
    top = np.abs(x).max(axis=1, initial=0)
    scale = np.where((top > 0) & np.isfinite(top), np.ldexp(1.0, np.frexp(top)[1] - 1), 1.0)
    with np.errstate(over="ignore"):
        return scale * np.sqrt(((x / scale[:, None]) ** 2).sum(axis=1))


def centres(rows: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """For each dimension the component-wise median of a bounded sample, which a few enormous vectors do not move."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample).collect()
    by: dict[int, list] = {}
    for r in picked:
        by.setdefault(r.dim, []).append(np.frombuffer(r.vector))
    return {dim: np.median(v, axis=0) for dim, v in by.items()}


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def _unit(x: np.ndarray, centre: np.ndarray | None, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rotated unit directions from the centre, distances from it)."""
    with np.errstate(over="ignore", invalid="ignore"):
        moved = x - (0 if centre is None else centre)
        far = lengths(moved)
        # Without a finite distance there is no direction; such a vector is always reranked.
        return np.nan_to_num(moved / np.where(far > 0, far, 1)[:, None], posinf=0, neginf=0) @ rotation(dim), far


def build_index(rows: DataFrame, middle: dict[int, np.ndarray]) -> DataFrame:
    """Codes and correction scalars of every usable vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            names, raw = batch["vec_id"].to_numpy(), batch["vector"].to_pylist()
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join(raw[i] for i in own)).reshape(-1, dim)
                turned, far = _unit(x, middle.get(dim), dim)
                fit = np.abs(turned).sum(axis=1) / math.sqrt(dim)
                codes = [c.tobytes() for c in _pack(turned > 0)]
                columns = [names[own], np.full(len(own), dim), [raw[i] for i in own], codes, far, fit]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _INDEX_ARROW)], schema=_INDEX_ARROW)

    return rows.mapInArrow(run, INDEX)


class Codes:
    """A block of the index, rows in the order of their ids."""

    def __init__(self, dim: int, rows: list[tuple[int, bytes, bytes, float, float]]):
        rows = sorted(rows, key=lambda r: r[0])
        names, vectors, codes, far, fit = zip(*rows)
        self.dim, self.names = dim, np.array(names)
        self.first = np.flatnonzero(np.concatenate([[True], self.names[1:] != self.names[:-1]]))
        self.vectors = np.frombuffer(b"".join(vectors)).reshape(-1, dim)
        self.codes = np.ascontiguousarray(np.frombuffer(b"".join(codes), np.uint64).reshape(len(rows), -1).T)
        self.ones = np.bitwise_count(self.codes).sum(axis=0, dtype=np.int64)
        self.far, self.fit = np.array(far), np.array(fit)
        spread = np.sqrt(np.maximum(0, 1 - self.fit**2) / max(1, dim - 1)) * SURE
        # Where a vector lies on the centre its direction means nothing, and its factor makes the error zero.
        self.safe = np.where(self.fit > 0, self.fit, 1)
        self.error = spread / self.safe

    def nearest(self, name: int, query: np.ndarray, turned: np.ndarray, far: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest ids of this block, ties to smaller ids; the query's own id left out."""
        root = math.sqrt(self.dim)
        low = float(turned.min())
        step = (float(turned.max()) - low) / LEVELS or 1.0
        level = np.rint((turned - low) / step).astype(np.uint64)
        dot = np.zeros(len(self.names), np.int64)
        for bit in range(8):
            plane = _pack(((level >> np.uint64(bit)) & np.uint64(1)).astype(bool)[None])[0]
            for word, codes in zip(plane, self.codes):
                dot += np.bitwise_count(codes & word).astype(np.int64) << bit
        # Inner product of the code (components of size 1 / root) with the query as cut to levels.
        product = (2 * (step * dot + low * self.ones) - (step * int(level.sum()) + low * self.dim)) / root
        estimate = product / self.safe
        error = self.error + step / 2 * root / self.safe
        # In units of about the query's distance; what then still overflows has no bounds and is reranked.
        unit = math.ldexp(1.0, math.frexp(far)[1] - 1) if far > 0 and math.isfinite(far) else 1.0
        with np.errstate(over="ignore", invalid="ignore"):
            own, far = self.far / unit, far / unit
            both = 2 * own * far
            middle = own**2 + far**2 - both * estimate
            slack = both * error + 1e-9 * (own**2 + far**2)
            bounded = np.isfinite(middle) & np.isfinite(slack)
            lower = np.where(bounded, middle - slack, -np.inf)
            upper = np.where(bounded, middle + slack, np.inf)
        other = self.names != name
        upper = np.where(other, upper, np.inf)
        n = min(k, int(other[self.first].sum()))
        if not n:
            return self.names[:0], self.far[:0]
        reach = np.partition(np.minimum.reduceat(upper, self.first), n - 1)[n - 1]
        rows = np.flatnonzero(other & (lower <= reach))
        with np.errstate(over="ignore"):
            exact = lengths(self.vectors[rows] - query)
        names = self.names[rows]
        first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        names, exact = names[first], np.minimum.reduceat(exact, first)
        best = np.lexsort((names, exact))[:n]
        return names[best], exact[best]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries, codes = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal queries, codes
            out = []
            for dim in sorted({q[1] for q in queries}):
                own = [c[:1] + c[2:] for c in codes if c[1] == dim]
                if own:
                    block = Codes(dim, own)
                    for name, d, vector, turned, far in queries:
                        if d == dim:
                            names, exact = block.nearest(name, np.frombuffer(vector), turned, far, k)
                            out.append((np.full(len(names), name), names, exact))
            queries, codes = [], []
            if out:
                yield pa.record_batch([np.concatenate(c) for c in zip(*out)], schema=_FOUND_ARROW)

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("cell", "is_query", "vec_id", "dim", "vector", "code", "far", "fit", "turned"))):
                if row[0] != cell:
                    yield from flush()
                    cell = row[0]
                if row[1]:
                    queries.append((row[2], row[3], row[4], np.frombuffer(row[8]), row[6]))
                else:
                    codes.append((row[2], row[3], row[4], row[5], row[6], row[7]))
        yield from flush()

    return run


def nearest(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    code_block: int = CODE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of each row whose id is divisible by ``every``.

    Score is the Euclidean distance in double precision, ties go to the smaller vec_id. Vectors that are null, empty,
    zero or not finite take no part, nor do null ids. Vectors are compared with those of their own dimension. A
    vec_id that occurs more than once counts once per answer, with its nearest row. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, vec_id, vector).dropDuplicates(["vec_id", "vector"]), "vectors")
    middle = centres(rows)
    index = stored(build_index(rows, middle), "codes")
    n = index.count()
    code_blocks = max(1, math.ceil(n / code_block))
    asked = index.where(F.col("vec_id") % every == 0)
    query_blocks = max(1, math.ceil(asked.count() / query_block))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = []
            for dim, raw in zip(batch["dim"].to_pylist(), batch["vector"].to_pylist()):
                turned.append(_unit(np.frombuffer(raw).reshape(1, -1), middle.get(dim), dim)[0][0].tobytes())
            yield batch.append_column("turned", pa.array(turned, pa.binary()))

    def cells(rows: DataFrame, own: str, blocks: int, others: int, query: bool) -> DataFrame:
        """Each row in its own block, once for each block of the other side."""
        block = bucket_of("vec_id", "vector", n=blocks)
        dealt = rows.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        pair = ("own", "other") if own == "query" else ("other", "own")
        cell = F.col(pair[0]) * code_blocks + F.col(pair[1])
        return dealt.select(cell.cast("long").alias("cell"), F.lit(query).alias("is_query"), *INDEX_NAMES, "turned")

    queries = cells(asked.mapInArrow(turn, INDEX + ", turned binary"), "query", query_blocks, code_blocks, True)
    codes = cells(index.withColumn("turned", F.lit(None).cast("binary")), "code", code_blocks, query_blocks, False)
    found = (
        queries.unionByName(codes)
        .repartition(width(spark), "cell")
        .sortWithinPartitions("cell")
        .mapInArrow(_search(k), FOUND)
    )
    single = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


INDEX_NAMES = [f.split()[0] for f in INDEX.split(", ")]
