"""Language identification with bit-sliced Bloom filters over character trigrams.

One filter per language, all of one size and with the same hashes, stored across: word i holds bit i of every filter,
one bit for each of 64 languages, and every further 64 languages have words of their own. Looking up a trigram is an AND
of a few words and gives, as a bit mask, all languages whose filter holds it. A filter holds a language's most frequent
trigrams (``KEPT``) that are not rare next to their best language (``SHARE``). A text's masks are counted by language, the share expected from false positives is taken off, and
the largest count decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import doc_rows, remainder

SAMPLE = 2_000  # most documents of a language that the filters are built from, in the order of a hash of the id
KEPT = 20_000  # most trigrams of a language, the most frequent ones
SHARE = 0.3  # a trigram belongs to a language if it is at least this frequent there, relative to its best language
LANGUAGES = 64  # languages of a block: bits of a word
BITS = 20
HASHES = 3
SALTS = 256  # parts of a language's ids that are ranked on their own before the sample is taken
UNKNOWN = "und"
FOLDS, HELD = 4, 2
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def trigrams(text: str) -> np.ndarray:
    """Trigrams of the lower-cased letters, words apart by one space, as 21 bits for each character."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = letter_table()[points]
    if not letter.any():
        return np.zeros(0, np.uint64)
    points = np.where(letter, points, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = np.concatenate([[32], points[keep], [32]]).astype(np.uint64)
    grams = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
    return grams[(points[1:-1] != 32) | (points[:-2] != 32)]


@dataclass
class Filters:
    names: list[str]
    words: np.ndarray  # bit l of word i in row b: bit i of the filter of language 64 b + l
    false: np.ndarray  # false-positive rate of each language's filter

    def masks(self, grams: np.ndarray, block: int = 0) -> np.ndarray:
        """The languages of a block that contain each trigram, as a bit mask."""
        out = None
        for odd in _ODD[:HASHES]:
            found = self.words[block][_slots(grams, odd)]
            out = found if out is None else out & found
        return out

    def decide(self, text: str | None) -> tuple[str, float]:
        """(language, its share of the corrected counts); ``und`` and 0 without a letter."""
        grams = trigrams(text) if text else np.zeros(0, np.uint64)
        if not len(grams) or not self.names:
            return UNKNOWN, 0.0
        counts = np.zeros(len(self.names))
        for at in range(0, len(grams), 1 << 20):
            for block in range(len(self.words)):
                first = block * LANGUAGES
                masks, n = np.unique(self.masks(grams[at : at + (1 << 20)], block), return_counts=True)
                for bit in range(min(LANGUAGES, len(self.names) - first)):
                    counts[first + bit] += n[(masks >> np.uint64(bit)) & np.uint64(1) == 1].sum()
        true = np.maximum(0, counts - len(grams) * self.false) / (1 - self.false)
        best = int(true.argmax())
        total = float(true.sum())
        return self.names[best], float(true[best] / total) if total else 1 / len(self.names)


def _slots(grams: np.ndarray, odd: np.uint64) -> np.ndarray:
    mixed = (grams ^ (grams >> np.uint64(23))) * odd
    return ((mixed ^ (mixed >> np.uint64(31))) * _ODD[0] >> np.uint64(64 - BITS)).astype(np.int64)


def filters(counted: list[tuple[str, int, int]]) -> Filters:
    """Build from (language, trigram, count) rows."""
    by: dict[str, list[tuple[int, int]]] = {}
    for name, gram, n in counted:
        by.setdefault(name, []).append((gram, n))
    names = sorted(by)
    total = {name: sum(n for _, n in own) for name, own in by.items()}
    best: dict[int, float] = {}
    for name, gram, n in counted:
        best[gram] = max(best.get(gram, 0), n / total[name])
    words = np.zeros((max(1, -(-len(names) // LANGUAGES)), 1 << BITS), np.uint64)
    fill = []
    for language, name in enumerate(names):
        block, bit = divmod(language, LANGUAGES)
        own = [g for g, n in by[name] if n / total[name] >= SHARE * best[g]]
        grams = np.array(own, np.uint64)
        for odd in _ODD[:HASHES]:
            words[block][_slots(grams, odd)] |= np.uint64(1 << bit)
        fill.append(float(((words[block] >> np.uint64(bit)) & np.uint64(1)).mean()))
    return Filters(names, words, np.array(fill) ** HASHES)


def sampled(ids: DataFrame, sample: int) -> DataFrame:
    """The first ``sample`` rows of each language in the order of a hash of the id.

    Ranked by part of a language first, so that the task that ranks a language has at most SALTS x ``sample`` rows.
    """
    salted = ids.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS)))
    for by in (["language", "salt"], ["language"]):
        order = Window.partitionBy(*by).orderBy(F.xxhash64("doc_id"), "doc_id")
        salted = salted.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).drop("n")
    return salted.drop("salt")


def train(docs: DataFrame, lang: str = "lang", sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> Filters:
    """Filters from at most ``sample`` documents of each language outside the held-out fold."""
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("language"))
    usable = ids.where((remainder("doc_id", FOLDS) != HELD) & F.col("language").isNotNull()).distinct()
    picked = sampled(usable, sample)
    kind = pa.schema([("language", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch["language"].to_numpy(zero_copy_only=False)
            texts = batch["text"].to_pylist()
            for name in dict.fromkeys(languages):
                some = [trigrams(t.decode("utf-8", "replace")) for t, l in zip(texts, languages) if l == name]
                grams, n = np.unique(np.concatenate(some), return_counts=True)
                yield pa.record_batch([[name] * len(grams), grams.view(np.int64), n], schema=kind)

    own = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(lang).cast("string").alias("language"),
        F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b"")).alias("text"),
    )
    # At most ``sample`` ids for each language.
    rows = own.join(F.broadcast(picked), ["doc_id", "language"], "left_semi")
    counts = rows.mapInArrow(run, "language string, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("language").orderBy(F.desc("n"), "gram")
    kept = counts.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= KEPT)
    return filters([(r.language, r.gram, r.n) for r in kept.orderBy("language", "rank").collect()])


def identify(docs: DataFrame, model: Filters, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 where the text is null or has no letter, or no language was learned. A null id is held out.
    Ties go to the first language by name. Repeated rows are scored as often as they occur; an empty table gives no rows.
    """
    kind = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.decide(t.decode("utf-8", "replace")) for t in batch["text"].to_pylist()]
            if found:
                names, scores = zip(*found)
                yield pa.record_batch([batch["doc_id"], pa.array(names), pa.array(scores, pa.float64())], schema=kind)

    scored = doc_rows(docs, doc_id, text).mapInArrow(run, "doc_id long, lang_pred string, score double")
    held = F.coalesce(remainder("doc_id", FOLDS) == HELD, F.lit(True))
    return scored.select("doc_id", held.alias("held_out"), "lang_pred", "score")
