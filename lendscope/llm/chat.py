"""Conversations as training sequences: rendered with a template, encoded once, with a mask of what is trained on.

A turn is written as mark, role, mark, text, and a last mark ends the conversation. The mark is one special token of
the vocabulary, so that no token reaches across a border of a text. A whole conversation is encoded once with the
character offsets of its tokens; the sorted spans of the trained texts and the sorted tokens are intersected by binary
search. Control strings inside texts and roles take a backslash behind their first character, one more than they had,
which is undone when they are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import width
from lendscope.llm.token_counts import WORDS

# Characters of conversations encoded by one call of the library.
BATCH_CHARS = 2_000_000
CACHED_WORDS = 400_000  # a worker's cache starts anew at this size
LONGEST = 64  # characters of a word worth keeping

ENCODED = "conv_id long, formatted string, ids binary, loss binary"
READ = "conv_id long, turns array<struct<role: string, text: string>>, trained array<string>, formatted string"

_coders: dict[tuple, "OffsetEncoder"] = {}


@dataclass(frozen=True)
class Template:
    """How turns are marked. ``mark`` must be a special token; ``controls`` are escaped inside texts as well."""

    mark: str = "<|endoftext|>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        strings = (self.mark, *self.controls)
        firsts = {s[0] for s in strings}
        if any(len(s) < 2 or s[1] == "\\" or firsts & set(s[1:]) for s in strings):
            raise ValueError("a control string needs a first character that no control string holds further on")

    def escape(self, text: str) -> str:
        return _pattern((self.mark, *self.controls), "*").sub(lambda found: found[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return _pattern((self.mark, *self.controls), "+").sub(lambda found: found[0][:-1], text)

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The text of a conversation and the sorted spans of its trained texts, in characters."""
        parts, spans, at = [], [], 0
        for role, text in turns:
            head, body = self.mark + self.escape(role) + self.mark, self.escape(text)
            parts += [head, body]
            at += len(head)
            if role in self.trained and body:
                spans.append((at, at + len(body)))
            at += len(body)
        return "".join(parts) + self.mark, spans

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a rendered conversation."""
        parts = formatted.split(self.mark)[1:-1]
        return [(self.unescape(role), self.unescape(text)) for role, text in zip(parts[::2], parts[1::2])]


@lru_cache
def _pattern(strings: tuple[str, ...], times: str) -> re.Pattern:
    """Each control string's first character and the backslashes (``times``) before the rest of it."""
    by_first: dict[str, list[str]] = {}
    for s in strings:
        by_first.setdefault(s[0], []).append(re.escape(s[1:]))
    return re.compile("|".join(f"{re.escape(first)}\\\\{times}(?={'|'.join(rest)})" for first, rest in by_first.items()))


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for each token (start, end) that shares a character with a span; both are sorted."""
    if not spans or not len(offsets):
        return np.zeros(len(offsets), np.uint8)
    begin, end = np.array(spans).T
    # The first span that ends behind the token's start is the only one that can begin before the token's end.
    at = np.searchsorted(end, offsets[:, 0], side="right")
    return ((at < len(end)) & (begin[np.minimum(at, len(end) - 1)] < offsets[:, 1])).astype(np.uint8)


class OffsetEncoder:
    """Token ids of whole texts with the characters each token covers, as the library gives them.

    A byte-level vocabulary without a normaliser splits a text into words by a fixed rule and encodes each by itself,
    so a word's ids and offsets are kept and shared by all texts. Any other vocabulary encodes whole texts.
    """

    def __init__(self, path: str, library, mark: str):
        self.library, self.mark = library, mark
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        step = rules.get("pre_tokenizer") or {}
        plain = step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space")
        added = [(a["content"], a["lstrip"] or a["rstrip"] or a["single_word"]) for a in rules.get("added_tokens", [])]
        self.by_word = plain and not rules.get("normalizer") and not rules.get("post_processor") and added == [(mark, False)]
        self.split = regex.compile(WORDS)
        self.known: dict[str, tuple[bytes, bytes, int]] = {}

    def _encoded(self, texts: list[str]) -> Iterator[tuple[bytes, bytes, int]]:
        for e in self.library.encode_batch(texts, add_special_tokens=False):
            yield np.array(e.ids, "<u4").tobytes(), np.array(e.offsets, "<i8").tobytes(), len(e.ids)

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
        """(ids, (token, 2) first character and end) of each text."""
        if not self.by_word:
            for ids, offsets, n in self._encoded(texts):
                yield ids, np.frombuffer(offsets, "<i8").reshape(n, 2)
            return
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        known = self.known
        split = []
        for text in texts:
            words: list[str] = []
            for i, part in enumerate(text.split(self.mark)):
                if i:
                    words.append(self.mark)
                words += self.split.findall(part)
            split.append(words)
        new = list({w for words in split for w in words}.difference(known))
        known.update(zip(new, self._encoded(new)))
        for words in split:
            ids, offsets, counts = zip(*map(known.__getitem__, words)) if words else ((), (), ())
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            at = np.repeat(np.cumsum(sizes) - sizes, np.array(counts, np.int64))
            yield b"".join(ids), np.frombuffer(b"".join(offsets), "<i8").reshape(-1, 2) + at[:, None]
        for w in new:
            if len(w) > LONGEST:
                del known[w]


def _coder(vocabulary: str, mark: str) -> OffsetEncoder:
    """This worker's encoder for a vocabulary; the mark must be one of its special tokens."""
    if (vocabulary, mark) not in _coders:
        from lendscope.llm.tokens import encoder

        library = encoder(vocabulary).library
        if not any(t.content == mark and t.special for t in library.get_added_tokens_decoder().values()):
            raise ValueError(f"{mark!r} is not a special token of the vocabulary")
        _coders[vocabulary, mark] = OffsetEncoder(vocabulary, library, mark)
    return _coders[vocabulary, mark]


def format_chats(rows: DataFrame, vocabulary: str, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, formatted, ids (little-endian unsigned 32-bit), loss (a byte per id, 1 or 0).

    ``rows`` has conv_id, turn, role and text. Turns are ordered by turn, then role, then text, nulls first; every row
    is a turn, also a repeated one or one without text or role (empty). Rows without a conv_id are one conversation.
    An empty table gives no rows. A conversation is held by one task, whatever its length; the table is not.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("ids", pa.binary()), ("loss", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, template.mark)
        for chats in _portions(_chats(batches, template)):
            ids, masks = [], []
            for (own, offsets), chat in zip(coder.encode([c[1] for c in chats]), chats):
                ids.append(own)
                masks.append(loss_mask(offsets, chat[2]).tobytes())
            names, texts, _ = zip(*chats)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip((names, texts, ids, masks), schema)], schema=schema)

    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.col(c).cast("string").alias(c) for c in ("role", "text")]
    )
    dealt = turns.repartition(width(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.drop("turn").mapInArrow(run, ENCODED)


def _chats(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[tuple[int | None, str, list]]:
    rows = (row for b in batches for row in zip(*(b[c].to_pylist() for c in ("conv_id", "role", "text"))))
    for conv_id, turns in groupby(rows, key=lambda row: row[0]):
        yield conv_id, *template.render([(role or "", text or "") for _, role, text in turns])


def _portions(chats: Iterator[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for chat in chats:
        held.append(chat)
        size += len(chat[1])
        if size >= BATCH_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def read_chats(chats: DataFrame, vocabulary: str, template: Template = Template()) -> DataFrame:
    """What ``format_chats`` made, read back: conv_id, turns, trained, formatted.

    ``turns`` come from the formatted text; ``trained`` are the decoded runs of ids under the loss mask, unescaped.
    """
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    schema = pa.schema(
        [("conv_id", pa.int64()), ("turns", pa.list_(turn)), ("trained", pa.list_(pa.string())), ("formatted", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _coder(vocabulary, template.mark).library
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                masked = [runs_of(i, m) for i, m in zip(part["ids"].to_pylist(), part["loss"].to_pylist())]
                texts = iter(library.decode_batch([r for runs in masked for r in runs], skip_special_tokens=False))
                trained = [[template.unescape(next(texts)) for _ in runs] for runs in masked]
                turns = [[{"role": r, "text": t} for r, t in template.parse(f)] for f in part["formatted"].to_pylist()]
                columns = (part["conv_id"].to_pylist(), turns, trained, part["formatted"].to_pylist())
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return chats.select("conv_id", "formatted", "ids", "loss").mapInArrow(run, READ)


def runs_of(ids: bytes, loss: bytes) -> list[list[int]]:
    """The runs of ids whose loss is 1."""
    own, mask = np.frombuffer(ids, "<u4"), np.frombuffer(loss, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8)))
    return [own[a:b].tolist() for a, b in zip(edges[::2], edges[1::2])]
