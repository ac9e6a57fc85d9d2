"""Exact token counts at every prefix of a text, by dynamic programming.

For byte-pair encoding, the last token of a prefix decides its whole encoding: the count at prefix i is the count
at i - len(t) plus one, where t is the one token that ends at i and may follow the last token of that shorter prefix.
Whether two tokens may stand side by side depends on these two only, so a table of (count, last token) for all
prefixes is filled from left to right and never encodes anything twice. Words share tables: a task keeps the tables of
words it has met, and sorted new words reuse the rows of their common prefix.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lendscope.llm.common import doc_rows
from lendscope.llm.tokens import PLAIN, STAND_INS

LIMIT = 1024
CACHED_CHUNKS = 700_000
_LONGEST = 64

# Fixed value: how byte-level vocabularies split a text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_BYTES = {c: b for b, c in STAND_INS.items()}

_models: dict[str, "PrefixCounter"] = {}


class PrefixCounter:
    """Prefix tables for one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        step = rules.get("pre_tokenizer") or {}
        if rules.get("normalizer") or rules["model"]["type"] != "BPE" or step.get("type") != "ByteLevel":
            raise ValueError("prefix tables need a byte-level BPE vocabulary without a normaliser")
        if step.get("add_prefix_space") or not step.get("use_regex", True):
            raise ValueError("prefix tables need the plain byte-level splitting rules")
        names = rules["model"]["vocab"]
        added = rules.get("added_tokens", [])
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError("added tokens that reach into their neighbours are not covered")
        special = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = regex.compile(WORDS)
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in rules["model"]["merges"]]
        made = {a + b for a, b in merges}
        base = [n for n in names if n not in made and len(n) == 1 and n in _BYTES]
        # A token's number is its rank: single bytes, then the merges in their order.
        number = {n: i for i, n in enumerate(base)}
        self.split: list[tuple[int, int]] = [(i, i) for i in range(len(base))]
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if a + b not in number:
                number[a + b] = len(self.split)
                self.split.append((number[a], number[b]))
            self.joined[number[a], number[b]] = number[a + b]
        self.tokens = {bytes(_BYTES[c] for c in n): i for n, i in number.items()}
        self.longest = max(map(len, self.tokens))
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.signs: dict[str, int] = {}

    def follows(self, left: int, right: int) -> bool:
        """True if ``left`` and ``right`` stay as they are when encoded side by side."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > CACHED_CHUNKS:
                self.pairs.clear()
            known = self.pairs[key] = self._follows(left, right)
        return known

    def _follows(self, left: int, right: int) -> bool:
        # Undo the later of the two merges until a merge across the border would have come first, or none is left.
        before, split, joined = 1 << 60, self.split, self.joined
        while True:
            across = joined.get((left, right))
            if across is not None and across < before:
                return False
            undo_left = left > right
            for _ in range(2):
                if undo_left:
                    part = split[left][1]
                    if part != left:
                        before, left = left, part
                        break
                else:
                    part = split[right][0]
                    if part != right:
                        before, right = right + 1, part
                        break
                undo_left = not undo_left
            else:
                return True

    def extend(self, word: bytes, counts: list[int], last: list[int], upto: int) -> None:
        """Fill the table of ``word`` behind its first ``upto`` rows; row i is the prefix of i bytes."""
        del counts[upto + 1 :], last[upto + 1 :]
        tokens, pairs, longest = self.tokens, self.pairs, self.longest
        for i in range(upto + 1, len(word) + 1):
            # Exactly one token fits, so the order of trial is free; short ones are the likely ones.
            for j in range(i - 1, max(-1, i - longest - 1), -1):
                t = tokens.get(word[j:i])
                if t is None:
                    continue
                if j:
                    ok = pairs.get(last[j] << 32 | t)
                    if ok is None:
                        ok = self.follows(last[j], t)
                    if not ok:
                        continue
                counts.append(counts[j] + 1)
                last.append(t)
                break
            else:
                raise ValueError("no token ends at this prefix: the vocabulary lacks a byte")

    def table(self, word: bytes) -> list[int]:
        """Token count at each prefix of one split word."""
        counts, last = [0], [-1]
        self.extend(word, counts, last, 0)
        return counts

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The split words of a text, and its special strings (True)."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield from ((w, False) for w in self.words.findall(text[at : found.start()]))
            yield found.group(), True
            at = found.end()
        yield from ((w, False) for w in self.words.findall(text[at:] if at else text))

    def count(self, text: str) -> int:
        """Token count of the whole text: the last entry of its prefix table."""
        return self.counts([text])[0]

    def counts(self, texts: list[str]) -> list[int]:
        """Token count of each text. Texts are cut before single spaces; the cut pieces' totals are kept."""
        if len(self.known) > CACHED_CHUNKS:
            self.known, self.older = {}, self.known
            if len(self.signs) > CACHED_CHUNKS:
                self.signs = {}
        known = self.known
        split = [t.split(" ") for t in texts]
        heads = [p.pop(0) for p in split]
        found = [list(map(known.get, pieces)) for pieces in split]
        gaps = [[i for i, n in enumerate(f) if n is None] if None in f else () for f in found]
        new = {pieces[i] for pieces, gap in zip(split, gaps) for i in gap}
        odd = {p for p in new if not p or p[0].isspace() or p[-1].isspace()}
        self._learn({" " + p for p in new - odd})
        out = []
        for text, head, pieces, totals, gap in zip(texts, heads, split, found, gaps):
            if (odd and any(pieces[i] in odd for i in gap)) or not head or head[-1].isspace():
                out.append(sum(self._chunk_total(c) for c in _chunks(text)))
            else:
                for i in gap:
                    totals[i] = known[pieces[i]]
                out.append(self._chunk_total(head) + sum(totals))
        for p in new - odd:
            if len(p) > _LONGEST:
                del known[p]
        return out

    def _chunk_total(self, chunk: str) -> int:
        if chunk[:1] == " ":
            total = self.known.get(chunk[1:])
            if total is not None:
                return total
        return sum(1 if special else self.table(part.encode())[-1] for part, special in self.parts(chunk))

    def _learn(self, new: set[str]) -> None:
        """Totals of chunks that begin with a space, in sorted order so that prefixes are shared."""
        totals = dict.fromkeys(new, 0)
        words: list[tuple[bytes, str]] = []
        for chunk in new:
            older = self.older.get(chunk[1:])
            if older is not None:
                totals[chunk] = older
            elif found := PLAIN.fullmatch(chunk, 1):
                words.append((b" " + found[1].encode(), chunk))
                totals[chunk] = self.signs.get(found[2], -1)
                if totals[chunk] < 0:
                    totals[chunk] = self.signs[found[2]] = self.table(found[2].encode())[-1]
            else:
                for part, special in self.parts(chunk):
                    if special:
                        totals[chunk] += 1
                    else:
                        words.append((part.encode(), chunk))
        words.sort()
        counts, last, before = [0], [-1], b""
        for word, chunk in words:
            if word != before:
                same, most = 0, min(len(before), len(word))
                while same < most and before[same] == word[same]:
                    same += 1
                self.extend(word, counts, last, same)
                before = word
            totals[chunk] += counts[-1]
        self.known.update((chunk[1:], total) for chunk, total in totals.items())

    def prefix_counts(self, text: str) -> list[int]:
        """Token count of ``text[:k]`` for each k from 0 to its length, as if that prefix were encoded alone.

        Split words end where they end in the whole text, except near the cut: a prefix that ends inside white
        space, a special string or a contraction splits its last words anew, and reads their tables.
        """
        out = [0]
        base, at = 0, 0
        before: list[tuple[int, int]] = [(0, 0)]  # (character, count) at word starts
        for part, special in self.parts(text):
            table = None if special else self.table(part.encode())
            width = 0
            plain = not special and part.lstrip(" ").isalpha()
            for k, char in enumerate(part, 1):
                width += len(char.encode())
                if plain and (k > 1 or char != " "):
                    out.append(base + table[width])
                else:
                    # From a word start two words back: no rule looks further.
                    start, had = before[max(0, len(before) - 3)]
                    out.append(had + self.count(text[start : at + k]))
            at += len(part)
            base += 1 if special else table[-1]
            before.append((at, base))
        return out

    def longest_prefix(self, text: str, budget: int) -> int:
        """Most characters of ``text`` whose tokens fit ``budget``."""
        counts = self.prefix_counts(text)
        # Counts can fall by one where a longer token forms; the running minimum from the right is sorted.
        floor = list(accumulate(reversed(counts), min))[::-1]
        return bisect_right(floor, budget) - 1


def _chunks(text: str) -> list[str]:
    """Cut before each single space between two other characters; no word or special string spans such a cut."""
    pieces = text.split(" ")
    if len(pieces) == 1:
        return pieces if text else []
    out = [pieces[0]]
    for piece in pieces[1:]:
        if not piece or piece[0].isspace() or not out[-1] or out[-1][-1].isspace():
            out[-1] += " " + piece
        else:
            out.append(" " + piece)
    return out


def model(path: str) -> PrefixCounter:
    """This worker's tables for a vocabulary file."""
    if path not in _models:
        _models[path] = PrefixCounter(path)
    return _models[path]


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit, fits.

    Counts are those of the whole text without added tokens; strings of special tokens inside a text count as that
    token. Null counts as empty (0 tokens). Null ids and repeated rows are counted like any other row; an empty
    table gives no rows.
    """
    kind = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = model(vocabulary)
        for batch in batches:
            texts = batch["text"].to_pylist()
            counts = []
            for at in range(0, len(texts), 256):
                counts += counter.counts([t.decode("utf-8", "replace") for t in texts[at : at + 256]])
            columns = [batch["doc_id"], pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64())]
            yield pa.record_batch([*columns, pa.array([c > limit for c in counts], pa.bool_())], schema=kind)

    return docs.transform(doc_rows, doc_id, text).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def fitting_prefixes(
    docs: DataFrame, vocabulary: str, budget: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_chars): the longest prefix of each text that fits ``budget`` tokens, read from its prefix table."""
    kind = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = model(vocabulary)
        for batch in batches:
            texts = (t.decode("utf-8", "replace") for t in batch["text"].to_pylist())
            fits = [counter.longest_prefix(t, budget) for t in texts]
            yield pa.record_batch([batch["doc_id"], pa.array(fits, pa.int64())], schema=kind)

    return doc_rows(docs, doc_id, text).mapInArrow(run, "doc_id long, n_chars long")
