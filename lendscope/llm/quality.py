"""Quality scores: boosted trees over statistics of whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.boosting import Trees, fit
from lendscope.llm.common import doc_rows, remainder

SAMPLE = 20_000  # most labelled rows that the model is fitted on; taken in the order of a hash of the id
FOLDS, HELD = 3, 1

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(192, 256)]] = True
_SIGNS = b"!#$%&*.,|?-:;/"

FEATURES = (
    "words", "bytes_log", "mean_word", "word_spread", "long_words", "one_letter", "distinct_words", "top_word",
    "capitals", "digits", "letters", "other", "capital_words", "signed_words", "lines", "mean_line", "repeated_lines",
    "repeated_line_words", "short_lines", "repeated_pairs", "entropy", *(f"sign_{chr(s)}" for s in _SIGNS),
)


def statistics(text: bytes) -> list[float]:
    """The features of one text, in the order of ``FEATURES``; an empty text is all zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    line_counts = Counter(lines)
    again = sum(len(x.split()) * (c - 1) for x, c in line_counts.items() if c > 1)
    letters = int(raw[_LETTER].sum())
    share = raw[raw > 0] / len(text)
    pairs = len(set(zip(words, words[1:])))
    return [
        float(n),
        float(np.log1p(len(text))),
        float(size.mean()),
        float(size.std()),
        float((size > 14).mean()),
        float((size == 1).mean()),
        len(counts) / n,
        max(counts.values()) / n,
        float(raw[65:91].sum()) / max(1, letters),
        float(raw[48:58].sum()) / len(text),
        letters / len(text),
        float(raw[:9].sum() + raw[14:32].sum() + raw[127:].sum()) / len(text),
        sum(map(bytes.isupper, words)) / n,
        sum(not w[-1:].isalpha() for w in words) / n,
        float(len(lines)),
        n / max(1, len(lines)),
        1 - len(line_counts) / max(1, len(lines)),
        again / n,
        sum(len(x) < 20 for x in lines) / max(1, len(lines)),
        1 - pairs / (n - 1) if n > 1 else 0.0,
        float(-(share * np.log2(share)).sum()),
        *(raw[list(_SIGNS)] / len(text)).tolist(),
    ]


def with_statistics(rows: DataFrame) -> DataFrame:
    """(doc_id, x) for rows of (doc_id, text as bytes)."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in batch["text"].to_pylist()]
            yield pa.record_batch([batch["doc_id"], pa.array(found, pa.list_(pa.float64()))], schema=schema)

    return rows.mapInArrow(run, "doc_id long, x array<double>")


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, doc_id: str = "doc_id",
    text: str = "text",
) -> Trees:
    """Fit on at most ``sample`` labelled rows outside the held-out fold; an id with more rows than one counts them all."""
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = known.where((remainder("doc_id", FOLDS) != HELD) & F.col("label").isin(0, 1))
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    # At most ``sample`` ids: small enough for every executor.
    rows = doc_rows(docs, doc_id, text).join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi")
    # An id may have any number of rows: again at most ``sample`` of them.
    drawn = with_statistics(rows).orderBy(F.xxhash64("doc_id", "x"), "doc_id", "x").limit(sample)
    found = drawn.join(F.broadcast(picked), "doc_id").orderBy("doc_id", "label", "x").limit(sample).collect()
    x = np.array([r.x for r in found]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.label for r in found], np.float64))


def score(docs: DataFrame, model: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, and ``row``, a hash of the text (bytes).

    Null texts count as empty and are scored like any other. A null id is held out. Repeated rows are scored as
    often as they occur; an empty table gives no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("row", pa.int64())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            if texts:
                x = np.array([statistics(t) for t in texts])
                yield pa.record_batch([batch["doc_id"], pa.array(sent.value.score(x)), batch["row"]], schema=schema)

    rows = doc_rows(docs, doc_id, text).withColumn("row", F.xxhash64("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double, row long")
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", FOLDS) == HELD, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "row",
    )
