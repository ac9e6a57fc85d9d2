"""Order statistics over data of any size.

A window without partition columns would pull everything into one task. These
operators cut the order into slices whose edges come from a quantile sketch,
add up the slices, and then work inside one slice at a time. The sketch only
balances the work; the results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICE = "_slice"
SLICE_ROWS = 500_000  # rows of a slice, about
FEW = 100_000  # rows that one task may rank


def _slice_edges(df: DataFrame, column: str, slices: int) -> list[float]:
    steps = [i / slices for i in range(1, slices)]
    return sorted(set(df.approxQuantile(column, steps, 0.5 / slices)))


def _with_slice(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    if not edges:
        return df.withColumn(_SLICE, F.lit(0.0))
    splits = [-math.inf, *edges, math.inf]
    return Bucketizer(splits=splits, inputCol=column, outputCol=_SLICE, handleInvalid="keep").transform(df)


def running_totals(
    df: DataFrame, order: str, measures: Sequence[str], by: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """Per distinct ``order`` value, descending: its sums and the sums so far.

    Adds ``cum_<measure>``, which includes the row itself, and
    ``total_<measure>`` of the whole group. Rows that share a value are summed
    before any shuffle, so one very frequent value costs one row per task; the
    slice sums are folded the same way straight from the input. The number of
    slices follows the number of rows. Rows without an ``order`` value have no
    place in it and are left out; callers report them.
    """
    df = df.filter(F.col(order).isNotNull())
    if slices is None:
        slices = max(16, math.ceil(df.count() / SLICE_ROWS))
    edges = _slice_edges(df, order, slices)
    sums = [F.sum(m).alias(m) for m in measures]

    per_slice = _with_slice(df, order, edges).groupBy(*by, _SLICE).agg(*sums)
    # At most ``slices`` rows per group reach these windows.
    group = Window.partitionBy(*by)
    earlier = group.orderBy(F.desc(_SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *by,
        _SLICE,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(m).over(group).alias(f"total_{m}") for m in measures],
    )

    per_value = _with_slice(df.groupBy(*by, order).agg(*sums), order, edges)
    inside = Window.partitionBy(*by, _SLICE).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    return per_value.join(offsets, [*by, _SLICE]).select(
        *by,
        order,
        *measures,
        *[(F.col(f"_before_{m}") + F.sum(m).over(inside)).alias(f"cum_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], error: float = 1e-4
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column, NULL and NaN skipped.

    A sketch brackets every wanted rank, one pass counts what lies below and
    inside each bracket, and a bracket that holds more than ``FEW`` rows is
    sketched again by itself. Only the rows inside the brackets are grouped by
    value. The driver receives a few numbers per quantile.
    """
    numbers = df.select(
        *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns]
    )
    counts = numbers.agg(*[F.count(c).alias(c) for c in columns]).first()
    filled = [c for c in columns if counts[c]]
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    if not filled:
        return result
    # The margin covers the sketch's own error and the step between ranks.
    margin = 2 * error + 2 / min(counts[c] for c in filled)
    ends = [e for p in probabilities for e in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = dict(zip(filled, numbers.approxQuantile(filled, ends, error)))
    brackets = {
        f"{c}#{i}": (c, p, *sketch[c][2 * i : 2 * i + 2]) for c in filled for i, p in enumerate(probabilities)
    }
    ranks = {slot: p * (counts[c] - 1) for slot, (c, p, _, _) in brackets.items()}
    while True:
        sizes, within = _bracket_sizes(numbers, brackets)
        wide = [s for s, (_, _, low, high) in brackets.items() if within[s] > FEW and low < high]
        narrowed = {s: _narrowed(numbers, brackets[s], ranks[s] - sizes[s], within[s], error) for s in wide}
        if all(brackets[s] == b for s, b in narrowed.items()):
            break
        brackets |= narrowed

    inside = [
        F.when(F.col(c).between(low, high), F.struct(F.lit(slot).alias("slot"), F.col(c).alias("value")))
        for slot, (c, _, low, high) in brackets.items()
    ]
    candidates = (
        numbers.select(F.inline(F.filter(F.array(*inside), lambda s: s.isNotNull())))
        .groupBy("slot", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    ordered = Window.partitionBy("slot").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = candidates.withColumn("upto", F.sum("rows").over(ordered))

    wanted_rows = _any(
        [
            (F.col("slot") == slot) & (_covers(math.floor(r) - sizes[slot]) | _covers(math.ceil(r) - sizes[slot]))
            for slot, r in ranks.items()
        ]
    )
    found: dict[str, list] = {slot: [] for slot in brackets}
    for row in ranked.filter(wanted_rows).collect():
        found[row.slot].append((row.upto - row.rows + sizes[row.slot], row.upto + sizes[row.slot], row.value))

    for slot, (c, p, _, _) in brackets.items():
        low, high = (_value_at(found[slot], k) for k in (math.floor(ranks[slot]), math.ceil(ranks[slot])))
        result[c][int(slot.rsplit("#", 1)[1])] = _between(low, high, ranks[slot] - math.floor(ranks[slot]))
    return result


def _bracket_sizes(numbers: DataFrame, brackets: dict) -> tuple[dict, dict]:
    """Rows below and inside each bracket, in one pass."""
    below = [F.count_if(F.col(c) < low).alias(f"below_{s}") for s, (c, _, low, _) in brackets.items()]
    inside = [F.count_if(F.col(c).between(low, high)).alias(f"in_{s}") for s, (c, _, low, high) in brackets.items()]
    row = numbers.agg(*below, *inside).first()
    return {s: row[f"below_{s}"] for s in brackets}, {s: row[f"in_{s}"] for s in brackets}


def _narrowed(numbers: DataFrame, bracket: tuple, rank: float, rows: int, error: float) -> tuple:
    """A bracket around the same rank, from a sketch of the rows inside alone."""
    column, p, low, high = bracket
    share = rank / max(1, rows - 1)
    margin = 2 * error + 2 / rows
    ends = [max(0.0, share - margin), min(1.0, share + margin)]
    inside = numbers.filter(F.col(column).between(low, high))
    return (column, p, *inside.approxQuantile(column, ends, error))


def _covers(rank: int) -> Column:
    """True where the rows of this value include the given rank of the bracket."""
    return (F.col("upto") - F.col("rows") <= rank) & (F.col("upto") > rank)


def _value_at(spans: list[tuple[int, int, float]], rank: int) -> float:
    for start, stop, value in spans:
        if start <= rank < stop:
            return value
    raise RuntimeError("the input changed between two passes over it")


def _between(low: float, high: float, share: float) -> float:
    if share >= 0.5:
        return high - (high - low) * (1 - share)
    return low + (high - low) * share


# 60 bits of md5, cut into 4096 equal slices by their top 12 bits.
_HASH_DIGITS, _SLICE_SHIFT, _SLICE_BITS = 15, 48, 12


def split_hash(key: str, seed: int) -> Column:
    """A seeded 60-bit number per key, the same on every run and engine."""
    text = F.concat(F.lit(f"{seed}-"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, _HASH_DIGITS), 16, 10).cast("long")


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = 0.25, seed: int = 42
) -> DataFrame:
    """Adds ``is_test``: within each label, the rows of lowest seeded hash.

    ``ceil(test_share * rows)`` rows are shared out over the labels in
    proportion, largest remainders first. Sizes are exact; the rank at which a
    label is cut is found from counts per hash slice, slices of slices where
    one is large, plus one look into the slice it falls in, so the table itself
    is never sorted or shuffled.
    """
    hashed = df.select(F.col(key), F.col(label), split_hash(key, seed).alias("_h"))

    def of(value) -> Column:
        return F.col(label).eqNullSafe(F.lit(value))

    def slice_counts(rows: DataFrame, shift: int) -> dict:
        found: dict = {}
        grouped = rows.groupBy(label, F.shiftright("_h", shift).alias(_SLICE)).agg(F.count(F.lit(1)).alias("n"))
        for row in grouped.collect():
            found.setdefault(row[label], {})[row[_SLICE]] = row.n
        return found

    shift = _SLICE_SHIFT
    counts = slice_counts(hashed, shift)
    left = _test_sizes({v: sum(s.values()) for v, s in counts.items()}, test_share)
    cuts: dict = {}
    while True:
        # The slice in which a label's last test row lies; cut again while one task would rank too many rows.
        for value, size in left.items():
            for piece in sorted(counts.get(value, ())):
                if size and size <= counts[value][piece]:
                    cuts[value] = (shift, piece, size)
                    break
                size -= counts[value][piece]
        large = {v: c for v, c in cuts.items() if c[0] == shift and counts[v][c[1]] > FEW}
        if not large or not shift:
            break
        inside = _any([of(v) & (F.shiftright("_h", s) == piece) for v, (s, piece, _) in large.items()])
        left = {v: rank for v, (_, _, rank) in large.items()}
        shift -= _SLICE_BITS
        counts = slice_counts(hashed.filter(inside), shift)
    if not cuts:
        return df.withColumn("is_test", F.lit(False))

    in_cut = _any([of(v) & (F.shiftright("_h", s) == piece) for v, (s, piece, _) in cuts.items()])
    place = F.row_number().over(Window.partitionBy(label).orderBy("_h", key))
    at_cut = _any([of(v) & (F.col("_place") == rank) for v, (_, _, rank) in cuts.items()])
    edges = hashed.filter(in_cut).withColumn("_place", place).filter(at_cut).collect()

    h = split_hash(key, seed)
    chosen = [
        of(row[label]) & ((h < row["_h"]) | ((h == row["_h"]) & (F.col(key) <= F.lit(row[key])))) for row in edges
    ]
    return df.withColumn("is_test", _any(chosen))


def _any(rules: Sequence[Column]) -> Column:
    result = rules[0]
    for rule in rules[1:]:
        result = result | rule
    return result


def _test_sizes(sizes: dict, test_share: float) -> dict:
    total = sum(sizes.values())
    wanted = math.ceil(test_share * total)
    shares = {v: divmod(wanted * n, total) for v, n in sizes.items()}
    result = {v: whole for v, (whole, _) in shares.items()}
    by_remainder = sorted(shares, key=lambda v: (-shares[v][1], str(v)))
    for value in by_remainder[: wanted - sum(result.values())]:
        result[value] += 1
    return result
