"""Spelling variants: which words of a corpus differ by one inserted, deleted or replaced character.

The vocabulary is an acceptor: a minimised automaton whose paths are its words. Composed with a transducer that makes
exactly one edit, and with the acceptor again, it accepts the pairs of near words. Before the edit both tapes read the
same prefix, so the pairs are enumerated per initial state: the state a prefix leads to. A first pass reads words from
the left and finds edits behind the first letters; a second reads them from the right and finds the rest, so that
each pair belongs to one initial state of one pass.

An initial state with more words than ``limit`` is cut: its words go on to states of longer prefixes. An edit at the
cut leaves both tapes with the same rest to read, so those composed states are dealt out by that rest; one holds at
most a word per letter, and one more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import in_batches, stored, width

LEAST = 7  # code points of a word
TIMES = 2  # occurrences of a word
RATIO = 10  # a form is so many times as frequent
LIMIT = 20_000  # words of one initial state
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GROUP = 0xF0000  # first of the code points that stand for initial states
_LONG = 63  # rests of this length and more share a bit
_SLICE = 400_000  # composed states begun at once

FOUND = "word string, n long, n_near long, best struct<less: long, word: string>"


def runs(docs: DataFrame, least: int = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run): each maximal run of letters with ``least`` code points or more, A to Z lower-cased."""
    found = F.regexp_extract_all(F.col(text).cast("string"), F.lit(f"{RUN}{{{least},}}"), F.lit(0))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("run"))
    return rows.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def vocabulary(words: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(word, n): the distinct values of column ``word`` that are long and frequent enough."""
    counted = words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= times)


class Acceptor:
    """The minimised acceptor of sorted distinct words; a path's numbers add up to the place of its word."""

    def __init__(self, words: list[str]):
        made: dict[tuple, int] = {}
        size: list[int] = []
        lengths: list[int] = []

        def freeze(node: list) -> int:
            key = (node[0], tuple(node[1]))
            number = made.get(key)
            if number is None:
                number = made[key] = len(size)
                size.append(node[0] + sum(size[target] for _, target in node[1]))
                mask = int(node[0])
                for _, target in node[1]:
                    longer = lengths[target] << 1
                    mask |= longer & ((1 << _LONG + 1) - 1) | (longer >> _LONG + 1) << _LONG
                lengths.append(mask)
            return number

        path, before = [[False, []]], ""
        for word in [*words, ""]:
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            while len(path) > same + 1:
                done = path.pop()
                path[-1][1].append((ord(before[len(path) - 1]), freeze(done)))
            path.extend([False, []] for _ in word[same:])
            path[-1][0] = path[-1][0] or bool(word)
            before = word
        self.root = freeze(path[0])

        self.final = np.array([key[0] for key in made], bool)
        self.lengths = np.array(lengths, np.uint64)
        degree = np.array([len(key[1]) for key in made], np.int64)
        self.first = np.concatenate([[0], np.cumsum(degree)])
        edges = [edge for key in made for edge in key[1]]
        self.symbol = np.array([s for s, _ in edges], np.int64)
        self.target = np.array([t for _, t in edges], np.int64)
        self.source = np.repeat(np.arange(len(size)), degree)
        # Words before an edge: its state's own word and all words of the edges to its left.
        below = np.concatenate([[0], np.cumsum(np.array(size, np.int64)[self.target])])
        self.skip = below[:-1] - below[self.first[self.source]] + self.final[self.source]
        self.keys = self.source << 21 | self.symbol  # sorted: by state, then by symbol

    def out(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``states``, edge) for every edge that leaves them."""
        degree = self.first[states + 1] - self.first[states]
        at = np.repeat(np.arange(len(states)), degree)
        inner = np.arange(len(at)) - np.repeat(np.cumsum(degree) - degree, degree)
        return at, self.first[states[at]] + inner

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """(state, number) of every path at or behind an initial state, ordered by state."""
        states, numbers = [], []
        state, number = np.array([self.root]), np.array([0])
        while len(state):
            at, edge = self.out(state)
            state, number = self.target[edge], number[at] + self.skip[edge]
            states.append(state)
            numbers.append(number)
        state, number = np.concatenate(states), np.concatenate(numbers)
        order = np.argsort(state, kind="stable")
        return state[order], number[order]


def composed(machine: Acceptor, rest: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The accepted pairs of acceptor, one-edit transducer and acceptor, each once, as places of two words.

    The edit follows the longest common prefix, behind the initial state. With ``rest``, at most so many symbols
    follow it.
    """
    state, number = machine.paths()
    if not len(state):
        return
    held, begin = np.unique(state, return_index=True)
    times = np.diff(np.append(begin, len(state)))
    degree = machine.first[held + 1] - machine.first[held]
    cost = np.cumsum(degree * (degree + 1) // 2)
    allowed = np.uint64(~0 & (1 << 64) - 1 if rest is None else (1 << rest + 1) - 1)
    for part in np.split(np.arange(len(held)), np.searchsorted(cost, np.arange(_SLICE, cost[-1], _SLICE))):
        for origin, left, right in _edits(machine, held[part], allowed):
            origin = part[origin]
            # A pair holds for every path that leads to its state.
            n = times[origin]
            at = np.repeat(np.arange(len(origin)), n)
            base = number[begin[origin[at]] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
            yield base + left[at], base + right[at]


def _edits(machine: Acceptor, states: np.ndarray, allowed: np.uint64) -> Iterator[tuple[np.ndarray, ...]]:
    """(place in ``states``, number, number) of pairs whose edit happens in a state, relative to the path there."""
    at, edge = machine.out(states)
    # Replaced: two edges of the state. Inserted: the state itself beside one of its edges, whose symbol must not
    # come next, or the common prefix would be longer.
    after = machine.first[states[at] + 1] - edge - 1
    later = np.repeat(np.arange(len(edge)), after)
    other = edge[later] + 1 + np.arange(len(later)) - np.repeat(np.cumsum(after) - after, after)
    origin = np.concatenate([at[later], at])
    p = np.concatenate([machine.target[edge[later]], states[at]])
    r = np.concatenate([machine.target[other], machine.target[edge]])
    left = np.concatenate([machine.skip[edge[later]], np.zeros(len(at), np.int64)])
    right = np.concatenate([machine.skip[other], machine.skip[edge]])
    barred = np.concatenate([np.full(len(later), -1), machine.symbol[edge]])
    while len(p):
        live = (machine.lengths[p] & machine.lengths[r] & allowed) != 0
        origin, p, r, left, right, barred = (a[live] for a in (origin, p, r, left, right, barred))
        both = machine.final[p] & machine.final[r]
        if both.any():
            yield origin[both], left[both], right[both]
        at, edge = machine.out(p)
        free = machine.symbol[edge] != barred[at]
        at, edge = at[free], edge[free]
        key = r[at] << 21 | machine.symbol[edge]
        slot = np.minimum(np.searchsorted(machine.keys, key), len(machine.keys) - 1)
        same = machine.keys[slot] == key
        at, edge, slot = at[same], edge[same], slot[same]
        origin, p, r = origin[at], machine.target[edge], machine.target[slot]
        left, right = left[at] + machine.skip[edge], right[at] + machine.skip[slot]
        barred = np.full(len(p), -1)
        allowed = allowed >> np.uint64(1) if allowed >> np.uint64(_LONG) == 0 else allowed


def near_words(
    groups: list[tuple[str, list[tuple[str, int]]]], backwards: bool = False, head: int = 0
) -> Iterator[tuple[str, int, int, tuple[int, str] | None]]:
    """(word, n, near words, best) for the words of some initial states: (prefix, [(rest, n)]).

    ``backwards`` words are spelled from the right; then pairs that share their first ``head`` letters are left out,
    fewer than ``head`` symbols follow an edit, and words without a pair are not returned.
    """
    rows = [(chr(_GROUP + i) + rest, start + rest, n) for i, (start, rests) in enumerate(groups) for rest, n in rests]
    rows.sort()
    words = [word[::-1] if backwards else word for _, word, _ in rows]
    counts = [n for _, _, n in rows]
    machine = Acceptor([spelled for spelled, _, _ in rows])
    # Places ordered from the best form to the worst: most frequent, then first in code-point order.
    order = sorted(range(len(rows)), key=lambda i: (-counts[i], words[i]))
    worth = np.empty(len(rows), np.int64)
    worth[order] = np.arange(len(rows), 0, -1)
    near, best = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    heads: dict[str, int] = {}
    first = np.array([heads.setdefault(w[:head], len(heads)) for w in words]) if backwards else None
    for left, right in composed(machine, head - 1 if backwards else None):
        if backwards:
            new = first[left] != first[right]
            left, right = left[new], right[new]
        near += np.bincount(left, minlength=len(rows)) + np.bincount(right, minlength=len(rows))
        np.maximum.at(best, left, worth[right])
        np.maximum.at(best, right, worth[left])
    for i, word in enumerate(words):
        if backwards and not near[i]:
            continue
        form = order[len(rows) - best[i]] if best[i] else None
        yield word, counts[i], int(near[i]), None if form is None else (-counts[form], words[form])


def initial_states(words: DataFrame, base: int, limit: int) -> DataFrame:
    """``words`` with ``depth``: the length of the prefix of ``spelled`` that names a word's initial state.

    Prefixes that more than ``limit`` words share are lengthened, again and again; they are counted and joined in
    Spark, and number at most words / limit.
    """
    start = F.substring(F.col("spelled"), F.lit(1), F.col("depth"))
    dealt, depth = words.withColumn("depth", F.lit(base)), base
    while True:
        counted = dealt.where(F.col("depth") == depth).groupBy(start.alias("start")).count()
        full = stored(counted.where((F.col("count") > limit) & (F.length("start") == depth)).select("start"), "full")
        if full.isEmpty():
            return dealt
        depth += max(1, depth // 2)
        longer = F.when(F.col("start").isNotNull(), F.lit(depth)).otherwise(F.col("depth"))
        dealt = dealt.join(full, start == F.col("start"), "left").withColumn("depth", longer).drop("start")


def at_cuts(dealt: DataFrame, base: int, head: int = 0) -> DataFrame:
    """Near words whose edit happens at a state that was cut, from the words that share prefix and rest around it."""
    cut = dealt.where(F.col("depth") > base).withColumn("at", F.explode(F.sequence(F.lit(base), F.col("depth") - 1)))
    prefix = F.substring(F.col("spelled"), F.lit(1), F.col("at")).alias("prefix")
    symbol = F.substring(F.col("spelled"), F.col("at") + 1, F.lit(1))
    own = [F.col("word"), F.col("n"), F.col("at"), prefix]
    behind = F.substring(F.col("spelled"), F.col("at") + 2, F.length("spelled"))
    from_here = F.substring(F.col("spelled"), F.col("at") + 1, F.length("spelled"))
    read = cut.where(F.col("at") < F.length("spelled")).select(*own, symbol.alias("symbol"), behind.alias("rest"))
    kept = cut.where(F.col("at") <= F.length("spelled")).select(*own, F.lit("").alias("symbol"), from_here.alias("rest"))
    rows = read.unionByName(kept)
    if head:
        rows = rows.where(F.length("rest") < head)
    members = rows.groupBy("at", "prefix", "rest").agg(F.collect_list(F.struct("symbol", "n", "word")).alias("members"))
    following = F.substring(F.col("rest"), F.lit(1), F.lit(1))

    def near(one: Column, other: Column) -> Column:
        differ = one["symbol"] != other["symbol"]
        # A letter inserted before its like belongs to a longer common prefix.
        for a, b in ((one, other), (other, one)):
            differ &= ~((a["symbol"] == "") & (b["symbol"] == following))
        if head:
            differ &= F.substring(one["word"], 1, head) != F.substring(other["word"], 1, head)
        return differ

    def found(one: Column) -> Column:
        others = F.filter("members", lambda other: near(one, other))
        best = F.array_min(F.transform(others, lambda o: F.struct((-o["n"]).alias("less"), o["word"].alias("word"))))
        return F.struct(one["word"].alias("word"), one["n"].alias("n"), F.size(others).cast("long").alias("n_near"), best.alias("best"))

    each = members.where(F.size("members") > 1).select(F.explode(F.transform("members", found)).alias("m"))
    return each.where("m.n_near > 0").select("m.*")


def _pass(words: DataFrame, total: int, base: int, limit: int, backwards: bool, head: int) -> DataFrame:
    """Every word with the near words one reading direction finds, and again with those at its cuts."""
    spelled = words.withColumn("spelled", F.reverse("word") if backwards else F.col("word"))
    dealt = initial_states(spelled, base, limit)
    rows = dealt.select(
        F.substring(F.col("spelled"), F.lit(1), F.col("depth")).alias("start"),
        F.substring(F.col("spelled"), F.col("depth") + 1, F.length("spelled")).alias("rest"),
        "n",
    )
    parts = max(width(words.sparkSession), total // (4 * limit) + 1)
    best = pa.struct([("less", pa.int64()), ("word", pa.string())])
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best", best)])

    def machines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((_named(r) for g in _bundles(batches, limit) for r in near_words(g, backwards, head)), schema)

    inside = rows.repartition(parts, "start").sortWithinPartitions("start").mapInArrow(machines, FOUND)
    return inside.unionByName(at_cuts(dealt, base, head if backwards else 0))


def _named(row: tuple) -> tuple:
    word, n, near, best = row
    return word, n, near, None if best is None else {"less": best[0], "word": best[1]}


def _bundles(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[tuple[str, list[tuple[str, int]]]]]:
    """Whole initial states, taken together until a machine has work enough."""
    rows = (row for b in batches for row in zip(*(b[c].to_pylist() for c in ("start", "rest", "n"))))
    held: list[tuple[str, list[tuple[str, int]]]] = []
    size = 0
    for start, members in groupby(rows, key=lambda row: row[0]):
        held.append((start, [(rest, n) for _, rest, n in members]))
        size += len(held[-1][1])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def variants(words: DataFrame, least: int = LEAST, ratio: int = RATIO, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``words`` (word, n): word, form, root, n, n_near, form_n.

    ``n_near`` counts the words that differ by exactly one inserted, deleted or replaced code point. ``form`` is the
    most frequent of them (ties: first in code-point order) if its ``form_n`` is at least ``ratio`` times n, else null;
    ``root`` is where following forms ends. Words are distinct and at least ``least`` code points long; an empty table
    gives no rows.
    """
    words = stored(words.select("word", "n"), "words")
    if not words.where(F.length("word") < least).isEmpty():
        raise ValueError(f"words of less than {least} code points")
    total = words.count()
    head = (least - 1) // 2
    found = _pass(words, total, head, limit, False, 0)
    if head:
        # Edits in the first letters leave so many letters at the end in common.
        found = found.unionByName(_pass(words, total, least - head, limit, True, head))
    folded = found.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    near = folded.select("word", "n", "n_near", F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n"))
    enough = F.col("form_n") >= ratio * F.col("n")
    rows = stored(
        near.select("word", "n", "n_near", *[F.when(enough, F.col(c)).alias(c) for c in ("form", "form_n")]), "variants"
    )
    joined = rows.join(roots(rows), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(rows: DataFrame) -> DataFrame:
    """(word, root) of every word with a form. Links are doubled, and each multiplies n, so a few rounds end it."""
    links = stored(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "links")
    while True:
        following = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(following, "root", "left_semi").isEmpty():
            return links
        ahead = links.join(following, "root", "left")
        links = stored(ahead.select("word", F.coalesce("next", "root").alias("root")), "links")
