import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lendscope.llm import packing, shards, token_counts, tokens
from llm_tables import empty, hard, hard_rows

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    found = Tokenizer.from_file(path)
    return lambda text: found.encode(text, add_special_tokens=False).ids


def texts():
    rng = random.Random(11)
    alphabet = ["a", "b", "The", "ing", "'s", "'", " ", "  ", "\n", "\t", "1", "é", "Ö", "İ", "Σ", "日", ".", "!!", "́",
                "<|endoftext|>", "<|startoftext|>", "\x00", "\x1c", "\x85", "　", " "]
    drawn = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(800)]
    return ["", " ", *drawn, *[r[1] for r in hard_rows() if r[1] and len(r[1]) < 10_000]]


def test_words_give_the_librarys_ids():
    coder, ids = tokens.Encoder(WORD), library(WORD)
    assert coder.by_word and coder.merges is not None
    for _ in range(2):  # unseen, then from the cache
        for text, found in zip(texts(), coder.encode([t.encode() for t in texts()])):
            assert np.frombuffer(found, "<u4").tolist() == ids(text), text


def test_a_new_cache_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 5)
    coder, ids = tokens.Encoder(WORD), library(WORD)
    for text in texts()[:200]:
        assert np.frombuffer(coder.encode([text.encode()])[0], "<u4").tolist() == ids(text)


def test_other_vocabularies_encode_whole_texts():
    coder, ids = tokens.Encoder(BYTE), library(BYTE)
    assert not coder.by_word
    assert np.frombuffer(coder.encode([b"a  b\n c"])[0], "<u4").tolist() == ids("a  b\n c")


def test_token_counts_are_the_librarys():
    counter, ids = token_counts.PrefixCounter(BYTE), library(BYTE)
    assert counter.counts(texts()) == [len(ids(t)) for t in texts()]


def test_every_prefix():
    counter, ids = token_counts.PrefixCounter(BYTE), library(BYTE)
    for text in texts()[:250]:
        want = [len(ids(text[:k])) for k in range(len(text) + 1)]
        assert counter.prefix_counts(text) == want, text
        for budget in (0, 1, 3, 1000):
            assert counter.longest_prefix(text, budget) == max(k for k, n in enumerate(want) if n <= budget)


def test_table_of_one_word():
    counter, ids = token_counts.PrefixCounter(BYTE), library(BYTE)
    word = " internationalisations"
    assert counter.table(word.encode()) == [len(ids(word[:k])) for k in range(len(word) + 1)]


def test_prefix_tables_refuse_other_rules():
    with pytest.raises(ValueError):
        token_counts.PrefixCounter(WORD)


def test_count_rows(spark):
    ids = library(BYTE)
    found = token_counts.token_counts(hard(spark), BYTE).collect()
    want = []
    for r in hard_rows():
        text = r[1] or ""
        n = len(ids(text))
        want.append((r[0], len(text.encode()), n, n > 1024))
    assert sorted(want, key=repr) == sorted(map(tuple, found), key=repr)
    assert token_counts.token_counts(empty(spark), BYTE).count() == 0


def test_fitting_prefixes(spark):
    ids = library(BYTE)
    docs = hard(spark).where("length(text) < 2000")
    by_text = {r[0]: r[1] for r in hard_rows() if r[0] != 9}
    for r in token_counts.fitting_prefixes(docs, BYTE, 7).collect():
        if r.doc_id in by_text and r.doc_id is not None:
            text = by_text[r.doc_id]
            assert len(ids(text[: r.n_chars])) <= 7
            assert r.n_chars == len(text) or len(ids(text[: r.n_chars + 1])) > 7


def naive_best_fit(lengths, capacity):
    rooms, window = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [w for w, room in enumerate(rooms) if room >= lengths[i]]
        if fits:
            w = min(fits, key=lambda w: rooms[w])
        else:
            w = len(rooms)
            rooms.append(capacity)
        rooms[w] -= lengths[i]
        window[i] = w
    return sorted(rooms)


@pytest.mark.parametrize(("capacity", "n"), [(16, 300), (100, 400), (4096, 200), (7, 1)])
def test_best_fit_decreasing(capacity, n):
    lengths = np.random.default_rng(capacity).integers(1, capacity + 1, n)
    window, offset, opened = packing.best_fit(lengths, capacity)
    used = np.bincount(window, lengths, opened).astype(int)
    assert sorted(capacity - used) == naive_best_fit(lengths.tolist(), capacity)
    for w in range(opened):
        own = np.flatnonzero(window == w)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist()


@pytest.mark.parametrize("round_tokens", [1 << 24, 500])
def test_pieces_hold_every_id_once(spark, round_tokens):
    ids = library(WORD)
    found = packing.pack(hard(spark), WORD, length=256, round_tokens=round_tokens).collect()
    want = sorted((str(r[0]), [*ids(r[1] or ""), 2]) for r in hard_rows())
    rows, sequences = {}, {}
    for r in found:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert len(own) == r.length <= 256
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        rows.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, own))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    got = []
    for (name, total), parts in rows.items():
        parts.sort(key=lambda p: (p[0], p[1]))
        times = sum(len(p) for _, p in parts) // total
        flat = [i for _, p in parts[::times] for i in p]
        got += [(name, flat)] * times
    assert sorted(got) == want
    assert packing.pack(empty(spark), WORD).count() == 0


def test_sequences_are_padded(spark):
    pieces = packing.pack(hard(spark), WORD, length=64)
    for r in packing.sequences(pieces.where("doc_tokens < 500"), 64, pad=9).collect():
        own = np.frombuffer(r.ids, "<u4")
        assert len(own) == 64 and (own[r.n_tokens :] == 9).all()


def test_shards_round_trip(spark, tmp_path):
    ids = library(WORD)
    written = shards.write_shards(hard(spark), str(tmp_path / "s"), WORD, length=32, rows=4)
    found = shards.read_shards(spark, str(tmp_path / "s"), written).collect()
    low = -(1 << 63)
    names = [low if r.doc_id is None else r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert names == sorted(names)
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    want = [(str(r[0]), [*ids(r[1] or ""), 2]) for r in hard_rows()]
    assert sorted(want) == sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in found)
    assert shards.token_shards(empty(spark), WORD, str(tmp_path / "none")).count() == 0


def test_shards_give_any_sequence(spark, tmp_path):
    written = shards.write_shards(hard(spark).where("length(text) < 5000"), str(tmp_path / "s"), WORD, length=16, rows=3)
    for shard, _, n in written:
        reader = shards.ShardReader(str(tmp_path / "s"), shard)
        stream = reader.tokens(0, n)
        assert all(pa.types.is_fixed_size_list(b.schema.field("ids").type) for b in reader.batches)
        for row in range(reader.first[-1]):
            own, mask = reader.sequence(row)
            real = stream[16 * row : 16 * row + 16]
            assert own[: len(real)].tolist() == real.tolist()
            assert mask.tolist() == [True] * len(real) + [False] * (16 - len(real))
        assert len(list((tmp_path / "s").glob(f"{shard:06d}.*"))) == 2


def test_paths_of_object_stores():
    assert shards.open_path("file:///a/b")[1] == "/a/b" and shards.open_path("file:/a/b")[1] == "/a/b"
    assert shards.open_path("/a/b")[1] == "/a/b"
