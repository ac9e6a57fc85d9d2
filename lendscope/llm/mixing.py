"""Mixing by soft membership: document rates whose expected token totals meet target weights.

A classifier fitted on a labelled table gives each document a posterior over domains, and the document's tokens count
towards each domain by that share. Rates r >= 0 (expected copies of a document) are fitted by least squares: the
domains' expected totals against the targets, plus a small pull of each rate towards 1. The fit is projected
gradient: a pass sums a few numbers per domain over all documents, the driver turns the remaining difference into a
direction, and every document moves along it and is cut off at zero. Differences are whitened by the second
moments of the posteriors that can still move, so a few passes suffice; only these sums reach the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.boosting import Trees, fit
from lendscope.llm.common import doc_rows, stored
from lendscope.llm.quality import statistics

SAMPLE = 6_000  # most labelled rows that the classifier is fitted on, in the order of a hash of the id
MARKERS = 20  # words of a domain whose frequency the classifier sees
LEAST = 5  # sampled documents a marker occurs in
ROUNDS = 40
PASSES = 12
PULL = 1e-4
GROWTHS = 8  # how often the token total is raised for domains that are not to be thinned
CLOSE = 1e-3  # of the token total: how near a share comes to its target
UNLABELLED = "unknown"
_WORD = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


@dataclass
class Classifier:
    """One set of boosted trees per domain, over text statistics and marker words; scores are scaled to sum 1."""

    names: list[str]
    words: list[bytes]
    trees: list[Trees]

    def posteriors(self, texts: list[bytes]) -> np.ndarray:
        if len(self.names) == 1:
            return np.ones((len(texts), 1))
        x = np.array([features(t, self.words) for t in texts]).reshape(len(texts), -1)
        scores = np.stack([t.score(x) for t in self.trees], axis=1)
        return scores / scores.sum(axis=1, keepdims=True)


def plain_words(text: bytes) -> list[bytes]:
    return text.lower().translate(_WORD).split()


def features(text: bytes, words: list[bytes]) -> list[float]:
    """Statistics of the text, and each marker's occurrences in a hundred words."""
    own = plain_words(text)
    counts = Counter(own)
    return statistics(text) + [100 * counts[w] / max(1, len(own)) for w in words]


def markers(counts: dict[bytes, dict[str, int]], size: dict[str, int], most: int = MARKERS) -> list[bytes]:
    """For each domain the words whose document share is furthest above that of the other domains."""
    total, out = sum(size.values()), set()
    for name, n in size.items():
        rated = []
        for word, by in counts.items():
            inside, all_ = by.get(name, 0), sum(by.values())
            share = all_ / total
            lead = inside / n - (all_ - inside) / max(1, total - n)
            rated.append((lead / (share * (1 - share) + 1e-3) ** 0.5, word))
        out |= {word for lead, word in sorted(rated)[-most:] if lead > 0}
    return sorted(out)


def domain_of(quality: str = "quality", toxic: str = "toxic") -> F.Column:
    """The domain of a labelled row: toxic, else low or good."""
    return (
        F.when(F.col(toxic) == 1, "toxic").when(F.col(quality) == 0, "low").when(F.col(quality) == 1, "good")
    )


def train(
    docs: DataFrame, labelled: DataFrame, domain: str = "domain", sample: int = SAMPLE, doc_id: str = "doc_id",
    text: str = "text",
) -> Classifier:
    """Fit on at most ``sample`` rows of ``labelled`` (doc_id, domain) that have a domain and a text in ``docs``."""
    known = labelled.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(domain).alias("domain"))
    usable = known.where(F.col("doc_id").isNotNull() & F.col("domain").isNotNull()).distinct()
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(sample)
    # At most ``sample`` ids.
    rows = stored(doc_rows(docs, doc_id, text).join(F.broadcast(picked), "doc_id"), "labelled")
    size = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return Classifier(list(size) or [UNLABELLED], [], [])
    kind = pa.schema([("domain", pa.string()), ("word", pa.binary())])

    def each_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch["domain"].to_pylist(), batch["text"].to_pylist()):
                own = list(set(plain_words(text)))
                yield pa.record_batch([pa.array([name] * len(own), pa.string()), pa.array(own, pa.binary())], schema=kind)

    met = rows.mapInArrow(each_word, "domain string, word binary").groupBy("word", "domain").agg(F.count("*").alias("n"))
    counts: dict[bytes, dict[str, int]] = {}
    for r in met.groupBy("word").agg(F.sum("n").alias("all"), F.collect_list(F.struct("domain", "n")).alias("by")).where(
        F.col("all") >= LEAST
    ).toLocalIterator():
        counts[bytes(r.word)] = {x.domain: x.n for x in r.by}
    words = markers(counts, size)
    made = pa.schema([("doc_id", pa.int64()), ("domain", pa.string()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t, words) for t in batch["text"].to_pylist()]
            yield pa.record_batch([batch["doc_id"], batch["domain"], pa.array(x, pa.list_(pa.float64()))], schema=made)

    found = rows.mapInArrow(run, "doc_id long, domain string, x array<double>").orderBy("doc_id", "domain", "x").collect()
    x, names = np.array([r.x for r in found]), sorted(size)
    own = np.array([r.domain for r in found])
    return Classifier(names, words, [fit(x, (own == n).astype(float), rounds=ROUNDS) for n in names])


def memberships(docs: DataFrame, model: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, n_tokens, posterior) for each row; ``row`` is a hash of the text, tokens are runs without white space."""
    kind = pa.schema(
        [("doc_id", pa.int64()), ("row", pa.int64()), ("n_tokens", pa.int64()), ("posterior", pa.list_(pa.float64()))]
    )
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = sent.value.posteriors(texts).tolist()
            sizes = pa.array([len(t.split()) for t in texts], pa.int64())
            yield pa.record_batch(
                [batch["doc_id"], batch["row"], sizes, pa.array(found, pa.list_(pa.float64()))], schema=kind
            )

    rows = doc_rows(docs, doc_id, text).withColumn("row", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, row long, n_tokens long, posterior array<double>")


def _dot(a: F.Column, b: list[float]) -> F.Column:
    out = F.lit(0.0)
    for i, x in enumerate(b):
        out = out + F.get(a, F.lit(i)) * F.lit(float(x))
    return out


def fit_rates(
    members: DataFrame, target: np.ndarray, passes: int = PASSES, pull: float = PULL, close: float = CLOSE
) -> tuple[DataFrame, list[list[float]]]:
    """``members`` with a column ``rate``, and each pass's expected shares.

    ``target`` holds each domain's share of the present token total. A column ``floor`` of ``members``, if there is one, is
    the least rate of a document, else it is 0; a column ``rate`` is where the fit starts, else at 1. Ends when all shares are ``close``, or after ``passes``; the last of the
    returned shares says which.
    """
    d = len(target)
    weight = F.col("n_tokens").cast("double")
    p = [F.get("posterior", F.lit(i)) for i in range(d)]
    floors = "floor" in members.columns
    least = F.col("floor") if floors else F.lit(0.0)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    rated, seen = members if "rate" in members.columns else members.withColumn("rate", F.lit(1.0)), []

    def moments(free: F.Column) -> list[F.Column]:
        return [F.sum(weight * free.cast("double") * p[i] * p[j]) for i, j in pairs]

    for turn in range(passes + 1):
        # Without floors a document that may move has a rate above 0, which the same pass over the rows sees.
        own = () if floors else moments(F.col("rate") > 0)
        sums = rated.agg(F.sum(weight), *[F.sum(weight * F.col("rate") * p[i]) for i in range(d)], *own).first()
        total, *rest = [x or 0.0 for x in sums]
        if not total:
            break
        shares = np.array(rest[:d]) / total
        seen.append(shares.tolist())
        if np.abs(shares - target).max() <= close or turn == passes:
            break
        if floors:
            # One on its floor moves only if the gradient lifts it.
            lifted = _dot(F.col("posterior"), (target - shares).tolist()) > 0
            rest[d:] = [x or 0.0 for x in rated.agg(*moments((F.col("rate") > least) | lifted)).first()]
        second = np.zeros((d, d))
        for (i, j), x in zip(pairs, rest[d:]):
            second[i, j] = second[j, i] = x / total
        # Gradient step of length 1 in the whitened metric, then the projection onto the least rates.
        direction = np.linalg.solve(second + 1e-6 * np.eye(d), target - shares).tolist()
        moved = F.col("rate") + _dot(F.col("posterior"), direction) - F.lit(pull) * (F.col("rate") - 1)
        rated = stored(rated.withColumn("rate", F.greatest(least, moved)), "rates")
    return rated, seen


def mixture(
    docs: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    domain: str = "domain",
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, domains, posterior, rate, copies, row, targets_met.

    ``weights`` are target shares by domain, scaled to 1; a domain that is not named keeps its present expected
    share, scaled with the rest. The token total stays, unless domains to ``keep`` hold more than their share of it:
    then it grows until they need not be thinned, and documents whose largest posterior is theirs get a rate of 1 or
    more. ``targets_met`` is false on every row where the last pass left a share off its target. ``row`` is a hash of the text. ``copies`` is the rate rounded up or down by a hash of id and text, so that its mean
    is the rate; the same row always gets the same number. Null and empty texts have no tokens and the
    posterior of no words. Without labels there is one domain and all rates are 1. Repeated rows are rated as often as
    they occur; an empty table gives no rows.
    """
    model = train(docs, labelled, domain, doc_id=doc_id, text=text)
    members = stored(memberships(docs, model, doc_id, text), "memberships")
    present = members.agg(
        F.sum("n_tokens").alias("n"),
        *[F.sum(F.col("n_tokens") * F.get("posterior", F.lit(i))) for i in range(len(model.names))],
    ).first()
    now = np.array([x or 0.0 for x in present[1:]]) / max(1, present.n or 0)
    target = np.array([weights.get(name, share) for name, share in zip(model.names, now)], float)
    if target.sum() > 0:
        target /= target.sum()
    kept = [i for i, name in enumerate(model.names) if name in keep]
    if kept:
        target *= max([1.0, *(now[i] / target[i] for i in kept if target[i] > 0)])
        most = F.array_max("posterior")
        held = F.lit(False)
        for i in kept:
            held = held | (F.get("posterior", F.lit(i)) == most)
        members = members.withColumn("floor", F.when(held, F.lit(1.0)).otherwise(F.lit(0.0)))
    rated, seen = fit_rates(members, target, close=CLOSE)
    for _ in range(GROWTHS if kept and seen else 0):
        # Repeated texts of other domains count towards the kept ones in part: their share needs a larger total yet.
        over = max(s / t for s, t in zip(seen[-1], target) if t > 0)
        if np.abs(np.array(seen[-1]) - target).max() <= CLOSE or over <= 1:
            break
        target *= over * 1.02
        rated, seen = fit_rates(rated, target, close=CLOSE)
    met = not seen or bool(np.abs(np.array(seen[-1]) - target).max() <= CLOSE)
    rate = F.col("rate")
    draw = F.pmod(F.xxhash64("doc_id", "row"), F.lit(1 << 30)) / float(1 << 30)
    return rated.select(
        "doc_id",
        "n_tokens",
        F.lit(model.names).cast("array<string>").alias("domains"),
        "posterior",
        "rate",
        (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("int").alias("copies"),
        "row",
        F.lit(met).alias("targets_met"),
    )
