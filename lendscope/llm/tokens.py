"""Token ids of whole texts, as the tokenizers library gives them, with a cache of words."""

from __future__ import annotations

import json
import os
import re

import numpy as np

os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core

CACHED_WORDS = 600_000  # a worker's cache starts anew at this size
_LONGEST = 64  # bytes of a word worth keeping

# Words whose ids are those of their letters and then of their signs. Lower case maps each of these letters to one
# letter, and no rule composes them.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]{1,40})([.,!?;:*#$%&|]*)")
# The printable stand-ins of the bytes in byte-level vocabularies.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_REST = [b for b in range(256) if b not in set(_PRINTABLE)]
STAND_INS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(_REST)}

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Encodes UTF-8 texts to little-endian unsigned 32-bit ids.

    Where the vocabulary's rules drop white space and never look across it, a text's ids are its words' ids one after
    the other, and words are looked up before they are encoded. Otherwise whole texts are encoded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.largest = self.library.get_vocab_size() - 1
        self.by_word = drops_white_space(rules)
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.merges = Merges.of(rules) if self.by_word else None

    def _library(self, texts: list[bytes]) -> list[bytes]:
        found = self.library.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, new: set[bytes]) -> None:
        """Ids of new words: plain ones by merging many at a time, the others by the library."""
        known, older = self.words, self.older
        plain, other, letters = [], [], set()
        for w in new:
            ids = older.get(w)
            if ids is not None:
                known[w] = ids
            elif self.merges is not None and (found := PLAIN.fullmatch(w.decode("utf-8", "replace"))):
                core = found[1].lower().encode()
                plain.append((w, core, found[2].encode()))
                if core not in known:
                    letters.add(core)
            else:
                other.append(w)
        signs = {s for _, _, s in plain if s}.difference(known)
        for at in range(0, len(other), 2_000):
            part = other[at : at + 2_000]
            known.update(zip(part, self._library(part)))
        known.update(zip(signs, self._library(list(signs))))
        cores = sorted(letters, key=len)
        for at in range(0, len(cores), 4_000):
            part = cores[at : at + 4_000]
            known.update(zip(part, self.merges.encode(part)))
        for w, core, sign in plain:
            known[w] = known[core] + known[sign] if sign else known[core]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_word:
            return self._library(texts)
        if len(self.words) > CACHED_WORDS:
            self.words, self.older = {}, self.words
        known = self.words
        split = [t.split() for t in texts]
        parts = [list(map(known.get, words)) for words in split]
        gaps = [[i for i, ids in enumerate(p) if ids is None] if None in p else () for p in parts]
        new = {words[i] for words, gap in zip(split, gaps) for i in gap}
        if new:
            self._learn(new)
        for words, part, gap in zip(split, parts, gaps):
            for i in gap:
                part[i] = known[words[i]]
        for w in new:
            if len(w) > _LONGEST:
                known.pop(w, None)
        return list(map(b"".join, parts))


class Merges:
    """Byte-pair merges of many words at once.

    Words are rows of token ids. Each step looks up the rank of every neighbouring pair in a hash table and merges
    the first pair of least rank in every row; rows without a pair are done.
    """

    PAD = 0xFFFF
    NONE = np.int32(1 << 30)

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.inner = np.array([vocab[STAND_INS[b]] for b in range(256)], np.uint32)
        self.final = np.array([vocab[STAND_INS[b] + suffix] for b in range(256)], np.uint32)
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint32)
        made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        self.bits = max(8, int(len(keys) * 4).bit_length())
        self.key = np.full(1 << self.bits, 0xFFFFFFFF, np.uint32)
        self.rank = np.full(1 << self.bits, self.NONE, np.int32)
        self.made = np.zeros(1 << self.bits, np.uint32)
        for rank, (slot, key) in enumerate(zip(self._slot(keys).tolist(), keys.tolist())):
            while self.key[slot] != 0xFFFFFFFF:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.key[slot], self.rank[slot], self.made[slot] = key, rank, made[rank]

    @classmethod
    def of(cls, rules: dict) -> Merges | None:
        """The merges of a lower-casing byte-level vocabulary with word ends; None for any other."""
        model, steps = rules["model"], (rules.get("normalizer") or {}).get("normalizers", [])
        usual = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and len(model["vocab"]) < cls.PAD
        plain = model["type"] == "BPE" and model.get("end_of_word_suffix") and not model.get("dropout")
        return cls(model["vocab"], model["merges"], model["end_of_word_suffix"]) if usual and plain else None

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or of the empty slot that ends its search."""
        slot = self._slot(keys)
        held = self.key[slot]
        open_ = np.flatnonzero((held != keys) & (held != 0xFFFFFFFF))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            held = self.key[slot[open_]]
            open_ = open_[(held != keys[open_]) & (held != 0xFFFFFFFF)]
        return slot

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        longest = int(size.max())
        raw = np.frombuffer(b"".join(w.ljust(longest, b"\0") for w in words), np.uint8).reshape(-1, longest)
        ids = self.inner[raw]
        at = np.arange(len(words))
        ids[at, size - 1] = self.final[raw[at, size - 1]]
        ids[np.arange(longest) >= size[:, None]] = self.PAD
        done = np.full((len(words), longest), self.PAD, np.uint32)
        while ids.shape[1] > 1:
            pairs = (ids[:, :-1] << np.uint32(16)) | ids[:, 1:]
            slot = self._find(pairs.ravel()).reshape(pairs.shape)
            rank = self.rank[slot]
            first = rank.argmin(axis=1)
            row = np.arange(len(ids))
            more = rank[row, first] < self.NONE
            if not more.all():
                rest = ~more
                done[at[rest], : ids.shape[1]] = ids[rest]
                ids, at, slot, first = ids[more], at[more], slot[more], first[more]
                row = np.arange(len(ids))
            if not len(ids):
                break
            ids[row, first] = self.made[slot[row, first]]
            column = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, column + (column > first[:, None]), axis=1)
        else:
            done[at, : ids.shape[1]] = ids
        kept = done != self.PAD
        flat = done[kept].astype("<u4").tobytes()
        ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
        return list(map(flat.__getitem__, map(slice, [0, *ends[:-1]], ends)))


def drops_white_space(rules: dict) -> bool:
    """True for rules that keep only matches of a pattern which matches no white space."""
    steps = rules.get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    kept = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    return kept and "[^\\s" in pattern and "\\s+" not in pattern and " ?" not in pattern


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
