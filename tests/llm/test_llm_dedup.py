import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from lendscope.llm import exact, simhash, substrings
from lendscope.llm.components import components
from llm_tables import DOCS, empty, hard, hard_rows, row

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("capacity", [1, 3, 50_000])
def test_exact_groups(spark, capacity):
    found = exact.exact_groups(hard(spark), capacity=capacity).collect()
    groups = {}
    for r in hard_rows():
        groups.setdefault(SPACE.sub(" ", r[1] or ""), []).append(r[0])
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert ordered(want) == ordered((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found)
    kept = [r for r in found if r.kept]
    assert len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in kept)
    assert exact.exact_groups(empty(spark)).count() == 0


def test_directory_splits_until_buckets_fit(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5_000).tolist()
    close = [(7 << 40) + i for i in range(600)]  # one prefix of 24 bits
    entries = spark.createDataFrame([(k,) for k in keys + close + [77] * 900], "hash long")
    starts = np.array(exact.directory(entries, capacity=200), np.uint64)
    own = np.searchsorted(starts, np.array(keys + close, np.int64).view(np.uint64), side="right") - 1
    assert np.bincount(own).max() <= 200
    assert starts[0] == 0 and (np.diff(starts) > 0).all()


def test_directory_brings_few_counts_to_the_driver(spark, monkeypatch):
    keys = np.random.default_rng(6).integers(0, 1 << 50, 20_000) + (np.arange(20_000) % 4 << 52)
    entries = spark.createDataFrame([(int(k),) for k in keys], "hash long")
    brought, collect = [], type(entries).collect

    def counted(df):
        brought.append(collect(df))
        return brought[-1]

    monkeypatch.setattr(type(entries), "collect", counted)
    starts = np.array(exact.directory(entries, capacity=100), np.uint64)
    own = np.searchsorted(starts, keys.view(np.uint64), side="right") - 1
    assert np.bincount(own).max() <= 100
    # Four first-level prefixes are too full: each further pass brings at most 16 counts for a full bucket.
    assert len(brought[0]) == 4 and len(brought[1]) <= 64 and max(map(len, brought)) <= 16 * 256


def test_collisions_are_chained_and_bytes_compared():
    import pyarrow as pa

    names = ["entry", "hash", "text", "doc_ids", "bucket"]
    columns = [[1, 2, 3], [7, 7, 7], [b"a", b"b", b"a"], [[1], [2], [3]], [0, 0, 0]]
    found = next(exact._owner(iter([pa.record_batch(columns, names)])))
    assert found["chain"].to_pylist() == [0, 1, 0]


def reference_fingerprint(text, shingle=4):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def reference_groups(ids, fps, radius):
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, name in enumerate(ids):
        if name is not None:
            least[top(i)] = min(name, least.get(top(i), name))
    return [least.get(top(i)) for i in range(len(fps))]


@pytest.mark.parametrize("hot_rows", [1_000, 1])
def test_near_duplicates_against_brute_force(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(simhash, "HOT_ROWS", hot_rows)
    rows = hard_rows()
    fps = [reference_fingerprint(r[1]) for r in rows]
    groups = reference_groups([r[0] for r in rows], fps, 4)
    found = simhash.near_duplicates(hard(spark)).collect()
    want = [(r[0], f"{f:016x}", g) for r, f, g in zip(rows, fps, groups)]
    assert ordered(want) == ordered(tuple(r) for r in found)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def close_fingerprints(n, seed):
    """Chains and clusters: every value is a few bits from an earlier one."""
    rng = random.Random(seed)
    fps = [rng.getrandbits(64)]
    while len(fps) < n:
        fp = rng.choice(fps) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randrange(9)):
            fp ^= 1 << rng.randrange(64)
        fps.append(fp)
    return list(dict.fromkeys(fps))


@pytest.mark.parametrize(("blocks", "chunk"), [(5, 8192), (6, 8192), (5, 7)])
def test_links_lose_nothing(spark, blocks, chunk):
    fps = close_fingerprints(500, blocks + chunk)
    signed = [f - (f >> 63 << 64) for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.links(table, 4, blocks, chunk)
    found = {r.node: r.root for r in components(links).collect()}
    by_root = {}
    for f in signed:
        by_root.setdefault(found.get(f, f), set()).add(f)
    want = {}
    for f, g in zip(signed, reference_groups(signed, fps, 4)):
        want.setdefault(g, set()).add(f)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, want.values()))
    assert links.count() < 16 * len(fps)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    fps = np.array(close_fingerprints(150, radius), np.uint64)
    planes = simhash.Planes(fps)
    who = np.repeat(np.arange(len(fps)), planes.words)
    words = np.tile(np.arange(planes.words), len(fps))
    found = set()
    for row, lane in simhash.near(fps[who], words, planes, radius):
        found |= set(zip(who[row].tolist(), lane.tolist()))
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
    assert found == want


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(1000, 1100)]
    edges = spark.createDataFrame([*chain, *hub, (5, 5), (3, 1), (1, 3)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(1000, 1100)]} | {1: 1, 3: 1}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def reference_removed(rows, window):
    """(id, words, removed, kept) by looking every window up in a dictionary, in document order."""
    last = 1 << 63
    order = sorted(
        range(len(rows)),
        key=lambda i: (last if rows[i][0] is None else rows[i][0], xxhash.xxh32_intdigest((rows[i][1] or "").encode())),
    )
    first, out = {}, []
    for i in order:
        name, text = rows[i][0], rows[i][1] or ""
        words = [w for w in SPACE.split(text) if w]
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            place = (name, text, p)
            if first.setdefault(tuple(words[p : p + window]), place) != place:
                gone[p : p + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((name, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [3, 20])
def test_repeats_against_brute_force(spark, window):
    found = substrings.repeats_digest(hard(spark), window=window).collect()
    assert ordered(reference_removed(hard_rows(), window)) == ordered(tuple(r) for r in found)
    assert substrings.repeats_digest(empty(spark)).count() == 0


def test_repeats_in_many_groups_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HELD_WORDS", 300)
    rng = random.Random(5)
    rows = [row(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(60)))) for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    found = substrings.remove_repeats(docs, window=4, group=50).collect()
    want = {r[0]: r for r in reference_removed(rows, 4)}
    for r in found:
        assert (r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) == want[r.doc_id]
        assert sum(s.length for s in r.spans) == r.n_removed


def test_groups_stay_small_where_texts_share_a_line(spark):
    # A third of the documents begin with the same four words and go on differently.
    rng = random.Random(8)
    texts = ["a b c d " * (i % 3 == 0) + " ".join(str(rng.randrange(10**6)) for _ in range(20)) for i in range(3_000)]
    rows = [row(i, t) for i, t in enumerate(texts)]
    source = spark.createDataFrame(rows, DOCS).repartition(4).selectExpr("doc_id", "cast(text as binary) as text")
    groups = substrings.find_groups(source, 4, 20, 200)
    own = [groups.of(substrings.word_hashes(w), len(w) - 19) for w in (t.encode().split() for t in texts)]
    assert np.bincount(np.concatenate(own)).max() <= 400
    # Four words are too frequent, and of what follows them only the line itself; ten words are not.
    assert [len(x) for x in groups.extended] == [4, 1, 0]


def test_two_levels_are_counted_in_one_pass(spark, monkeypatch):
    # All texts begin one of four words; no four words are frequent.
    rng = random.Random(9)
    rows = [row(i, " ".join(rng.choice("abcd") + f" {rng.randrange(10**6)}" for _ in range(20))) for i in range(500)]
    source = spark.createDataFrame(rows, DOCS).repartition(4).selectExpr("doc_id", "cast(text as binary) as text")
    passes, written = [], substrings.stored
    monkeypatch.setattr(substrings, "stored", lambda df, name: passes.append(name) or written(df, name))
    groups = substrings.find_groups(source, 4, 20, 1_000)
    assert [len(x) for x in groups.extended] == [4, 0]
    assert len(passes) == 1


@pytest.mark.parametrize("chunk", [1, 12, 1_000_000])
def test_words_of_many_texts_are_cut_at_once(monkeypatch, chunk):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    pieces = [b"a", b"bc", b" ", b"\n", b"\t\r", b"\x0b\x0c", b"eightsof", b"more than eight letters", b"\xc3\xa9", b"\0", b"\x85", b"\x1f"]
    rng = random.Random(3)
    texts = [b"".join(rng.choices(pieces, k=rng.randrange(9))) for _ in range(200)]
    batch = substrings.pa.record_batch([[b"other", *texts, b"other"]], names=["text"]).slice(1, len(texts))
    found = {}
    for row_, data, offsets, hashes, count in substrings._chunks(batch):
        for i, own in enumerate(np.split(hashes, np.cumsum(count)[:-1])):
            assert bytes(data[offsets[i] : offsets[i + 1]]) == texts[row_ + i]
            found[row_ + i] = own.tolist()
    assert [found.get(i, []) for i in range(len(texts))] == [substrings.word_hashes(t.split()).tolist() for t in texts]
    words = list({w for t in texts for w in t.split()} | {b"\0" * i for i in range(20)})
    assert len(np.unique(substrings.word_hashes(words))) == len(words)


def test_copies_are_all_but_the_first_place():
    rng = np.random.default_rng(4)
    for n in rng.integers(1, 60, 200):
        doc, tag, at = rng.integers(-2, 3, n), rng.integers(0, 2, n).astype(np.uint32), rng.integers(0, 3, n).astype(np.uint32)
        # Hashes that differ in their lowest bit only.
        key = rng.choice(np.array([1, 2, 1 << 63, (1 << 63) + 1, (1 << 64) - 1], np.uint64), n)
        group = rng.integers(0, 2, n).astype(np.int32)
        same = {}
        for i in range(n):
            same.setdefault((key[i], group[i]), []).append((doc[i], tag[i], at[i], i))
        same = [s for s in same.values() if len(s) > 1]
        behind, firsts, alike = substrings.copies(doc, tag, at, key, group)
        assert sorted(alike) == sorted(p[3] for s in same for p in s)
        assert sorted(behind) == sorted(p[3] for s in same for p in s if p[:3] != min(s)[:3])
        assert sorted((doc[i], tag[i], at[i]) for i in firsts) == sorted(min(s)[:3] for s in same)


def test_packed_rows_come_back():
    rng = np.random.default_rng(7)
    part, doc = np.repeat([3, 5, 9], [4, 1, 7]), np.array([1, 1, 1, 1, 1, 1, 1, -4, -4, 1, 2, 2])
    tag, at = rng.integers(0, 1 << 32, (2, 12), dtype=np.uint32)
    tag[:4], key = 8, rng.integers(0, 1 << 64, 12, dtype=np.uint64)
    packed = list(substrings._packed(part, doc, tag, at, key))
    assert [p for p, _ in packed] == [3, 5, 9]
    for found, want in zip(substrings._unpacked([data for _, data in packed], 4), (doc, tag, at, key)):
        assert found.tolist() == want.tolist()
    assert substrings._unpacked([packed[1][1]], 4)[3].tolist() == [key[4]]


def test_frequent_prefixes_are_extended():
    keys = np.concatenate([np.full(900, 5 << 16) + np.arange(900), np.arange(100) << 16]).astype(np.uint32)
    starts = substrings.group_starts(keys, 10)
    sizes = np.bincount(np.searchsorted(starts, keys, side="right") - 1)
    assert starts[0] == 0 and len(starts) >= 8 and sizes.max() <= 220
