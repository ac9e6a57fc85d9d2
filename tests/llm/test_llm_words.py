"""Spelling variants, whitening and chat formatting against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.llm import chat, queries, spelling, whitening
from llm_tables import empty, hard, hard_rows

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=10):
    out, forms = {}, {}
    for w, n in counts.items():
        near = sorted((x for x in counts if one_edit(w, x)), key=lambda x: (-counts[x], x))
        form = near[0] if near and counts[near[0]] >= ratio * n else None
        forms[w] = form
        out[w] = (form, n, len(near), counts[form] if form else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows, key=repr)


def vocabulary(seed, letters, sizes, words, heads=("",)):
    rng = random.Random(seed)
    made = {rng.choice(heads) + "".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(words)}
    return {w: 2 * 10 ** rng.randrange(4) + rng.randrange(3) for w in made}


CASES = {
    "dense": vocabulary(1, "ab", (7, 8, 9), 500),
    "runs of one letter": {"a" * k + t: 2 + k for k in range(7, 14) for t in ("", "b", "ba")},
    "beyond ascii": vocabulary(2, "aéÀÿz", (7, 8), 600),
    "hot head": vocabulary(3, "abc", (4, 5, 6), 600, ("prefix", "pre", "xyz")),
    "hot tail": {w[::-1]: n for w, n in vocabulary(4, "abc", (4, 5, 6), 600, ("tion", "noitaz", "xyz")).items()},
    "long": {"x" * 3000: 2, "x" * 3001: 30, "x" * 1500 + "y" + "x" * 1500: 5, "y" + "x" * 3000: 4},
    "chain": {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000, "aabbbbb": 200000},
}


@pytest.mark.parametrize(("name", "limit"), [*((name, 5) for name in CASES), ("dense", 40), ("hot tail", spelling.LIMIT)])
def test_variants(spark, name, limit):
    counts = CASES[name]
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.variants(words, limit=limit).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, found), key=repr) == brute_variants(counts)


def test_shorter_words_and_other_ratio(spark):
    for least in (1, 4):
        counts = vocabulary(least, "ab", (least, least + 1, least + 2), 60)
        words = spark.createDataFrame(list(counts.items()), "word string, n long")
        found = spelling.variants(words, least=least, ratio=3, limit=4)
        rows = found.select("word", "form", "root", "n", "n_near", "form_n").collect()
        assert sorted(map(tuple, rows), key=repr) == brute_variants(counts, 3)
    with pytest.raises(ValueError):
        spelling.variants(words, least=1 + max(map(len, counts)))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=6), min_size=1, max_size=40))
def test_acceptor_is_minimal_and_numbers_its_words(words):
    words = sorted("\U000f0000" + w for w in words)
    machine = spelling.Acceptor(words)
    state, number = machine.paths()
    assert sorted(number[machine.final[state]].tolist()) == list(range(len(words)))
    rights = {tuple(sorted({w[k:] for w in words if w[:k] == p})) for w in words for k in range(len(w) + 1) for p in [w[:k]]}
    assert len(machine.final) == len(rights)
    pairs = [(words[a], words[b]) for left, right in spelling.composed(machine) for a, b in zip(left, right)]
    want = {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    assert len(pairs) == len(want) and set(map(frozenset, pairs)) == want


def test_words_of_hard_texts(spark):
    counts = Counter()
    for doc_id, text, *_ in hard_rows() * 2:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            if len(word) >= 7:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    path = spark.conf.get("spark.checkpoint.dir") + "/spelling-docs"
    docs = hard(spark)
    docs.union(docs).write.mode("overwrite").parquet(path + "/documents.parquet")
    found = queries.op11_spelling(spark, path).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(found) > 3 and sorted(map(tuple, found), key=repr) == brute_variants(counts)


def test_no_words(spark):
    assert spelling.variants(spelling.vocabulary(spelling.runs(empty(spark)).withColumnRenamed("run", "word"))).count() == 0


VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        # Names the operator uses itself.
        *[T.StructField(c, T.StringType()) for c in ("x", "copies", "weight", "n", "parts", "component")],
    ]
)


def vector_rows(d=6, n=300, seed=7):
    rng = np.random.default_rng(seed)
    own = (rng.normal(size=(n, d)) @ rng.normal(size=(d, d))).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(own)]
    rows += [(1000 + i, own[0]) for i in range(200)] + [(0, own[0]), (None, own[1])]
    rows += [(2000, None), (2001, [None] + own[0][1:]), (2002, [float("nan")] * d), (2003, [float("inf")] + own[0][1:]), (2004, [])]
    return rows


def vectors(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], VECTORS).repartition(3)


def brute_whitening(rows, components, weights):
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in kept])
    fit = np.unique(x, axis=0) if weights == "one" else x
    n, s = len(fit), fit.sum(axis=0)
    z = fit - s / n
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1], axes[:, ::-1]
    white = (x - s / n) @ axes[:, :components] / np.sqrt(values[:components])
    return [i for i, _ in kept], n, ((n * x - s) ** 2).sum(axis=1), white, values / values.sum()


@pytest.mark.parametrize(("weights", "hot"), [("one", 1000), ("one", 50), ("count", 1000)])
def test_whitening(spark, monkeypatch, weights, hot):
    monkeypatch.setattr(whitening, "HOT", hot)
    rows = vector_rows()
    ids, n, deviation, white, share = brute_whitening(rows, 4, weights)
    found = whitening.whiten_embeddings(vectors(spark, rows), components=4, weights=weights)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = found.collect()
    assert len(got) == 4 * len(ids) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    signs = {}
    want = sorted((str(i), int(d), c + 1, abs(round(float(w), 6))) for i, d, ws in zip(ids, deviation, white) for c, w in enumerate(ws))
    assert sorted((str(r.vec_id), r.deviation, r.component, abs(round(r.whitened, 6))) for r in got) == want
    for r in got:
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
        if r.vec_id is not None and 0 < r.vec_id < 300:
            sign = np.sign(r.whitened * white[ids.index(r.vec_id), r.component - 1])
            assert signs.setdefault(r.component, sign) == sign


def test_whitening_of_hard_vectors(spark):
    def white(rows, **kw):
        return whitening.whiten_embeddings(vectors(spark, rows), **kw).collect()

    assert white([]) == [] and white([(1, None), (2, [])]) == []
    # One distinct vector has no variance, and so has a constant entry.
    assert white([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    flat = white([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [4.0, 2.0])])
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-12
    # Lengths are fitted apart; enormous entries are clamped and leave a long.
    rows = [(1, [1.0]), (2, [5.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [3.0, 3.0]), (6, [1e38]), (7, [-1e38])]
    found = white(rows)
    assert Counter(r.vec_id for r in found) == {1: 1, 2: 1, 3: 2, 4: 2, 5: 2, 6: 1, 7: 1}
    assert {r.n for r in found if r.vec_id in (3, 4, 5)} == {3}
    assert all(r.deviation is None for r in found if r.vec_id == 6) and max(r.identity_error for r in found) < 1e-9
    with pytest.raises(ValueError):
        white(rows, weights="none")


def test_partial_sums_are_exact(spark):
    big = [(1 << 52) - i for i in range(400)]
    rows = spark.createDataFrame([(i, [b, -b, i]) for i, b in enumerate(big)], "vec_id long, x array<long>")
    fit = whitening.exact_sums(rows.withColumn("weight", F.lit(1 << 14).cast("long")))[3]
    assert fit.n == 400 << 14
    assert fit.sums == [sum(big) << 14, -sum(big) << 14, sum(range(400)) << 14]
    x = np.array([[big[3], -big[3], 3]])
    exact = sum((fit.n * int(v) - s) ** 2 for v, s in zip(x[0], fit.sums))
    assert fit.deviation(x) == [exact if exact < 1 << 63 else None]


CONTROLS = ["<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]
PIECES = st.one_of(st.sampled_from([*CONTROLS, "<", "[", "|", "\\", "<\\s>", "[\\\\/INST]", "\n", " ", "é", "日", "😀"]), st.text(max_size=4))
TEXTS = st.lists(PIECES, max_size=8).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", ""]), TEXTS), TEXTS), max_size=5))
def test_template_round_trip(turns):
    template = chat.Template()
    formatted, spans = template.render(turns)
    assert template.parse(formatted) == turns
    assert [template.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]
    for _, text in turns:
        assert not any(c in template.escape(text) for c in CONTROLS)
    coder = chat._coder(BYTE, template.mark)
    library = coder.library
    encoded = library.encode(formatted, add_special_tokens=False)
    ((ids, offsets),) = coder.encode([formatted])
    assert np.frombuffer(ids, "<u4").tolist() == encoded.ids and list(map(tuple, offsets.tolist())) == encoded.offsets
    mask = chat.loss_mask(offsets, spans)
    assert mask.tolist() == [int(any(a < e and s < b for a, b in spans)) for s, e in encoded.offsets]
    runs = chat.runs_of(np.array(encoded.ids, "<u4").tobytes(), mask.tobytes())
    texts = [template.unescape(library.decode(r, skip_special_tokens=False)) for r in runs]
    assert texts == [t for r, t in turns if r == "assistant" and t]


def test_templates_that_cannot_be_read_back_are_refused():
    for controls in (("<a<b>",), ("x",), ("<\\s>",)):
        with pytest.raises(ValueError):
            chat.Template(controls=controls)
    with pytest.raises(ValueError):
        chat._coder(BYTE, "[INST]")


TURNS = "conv_id long, turn long, role string, text string, formatted string, ids string, loss string, turns string"


def chat_rows():
    long = " ".join(f"word{i}</s>" for i in range(40_000))
    rows = [
        (1, 2, "user", "third"),
        (1, 0, "system", "first"),
        (1, 1, "assistant", " \n<|endoftext|> second\\ "),
        (1, 1, "assistant", " \n<|endoftext|> second\\ "),
        (2, 0, "assistant", None),
        (2, 1, "assistant", ""),
        (2, 2, None, "no role"),
        (2, None, "assistant", "no turn"),
        (3, 0, "user\nassistant", "odd role"),
        (3, 1, "[INST]", "[INST]"),
        (4, 0, "assistant", long),
        (4, 1, "assistant", "日本 😀"),
        (None, 0, "user", "a"),
        (None, 1, "assistant", "b"),
    ]
    return [(*r, *["x"] * 4) for r in rows]


def test_chats(spark, tmp_path):
    frame = spark.createDataFrame(chat_rows(), TURNS).repartition(3)
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r.conv_id: r for r in queries.op13_chat(spark, str(tmp_path)).collect()}
    planted = [(-1, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))]
    by_chat = {}
    for conv_id, turn, role, text, *_ in sorted([*chat_rows(), *planted], key=lambda r: tuple((v is not None, v or "") if i != 1 else (v is not None, v or 0) for i, v in enumerate(r[1:4], 1))):
        by_chat.setdefault(conv_id, []).append((role or "", text or ""))
    assert set(found) == set(by_chat)
    for conv_id, turns in by_chat.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        got = found[conv_id]
        assert (got.n_turns, got.loss_chars) == (len(turns), len(loss))
        assert got.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got.formatted_chars == len(chat.Template().render(turns)[0])


def test_words_of_any_kind_keep_the_librarys_offsets(monkeypatch):
    monkeypatch.setattr(chat, "CACHED_WORDS", 3)
    coder = chat.OffsetEncoder(BYTE, chat._coder(BYTE, "<|endoftext|>").library, "<|endoftext|>")
    assert coder.by_word
    rng = random.Random(5)
    signs = ["a", "The", "'s", "'", " ", "  ", "\n", "\t", "1", "é", "日本", "😀", ".", "!!", "<|endoftext|>", "\x1c", "\x85", "\u3000", "x" * 80]
    texts = ["", *["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(300)]]
    for part in (texts[:100], texts[100:]):
        for text, (ids, offsets) in zip(part, coder.encode(part)):
            want = coder.library.encode(text, add_special_tokens=False)
            assert np.frombuffer(ids, "<u4").tolist() == want.ids
            assert list(map(tuple, offsets.tolist())) == want.offsets
    whole = chat.OffsetEncoder(BYTE, coder.library, "<other>")
    assert not whole.by_word and next(whole.encode(["a b"]))[1].tolist() == [[0, 1], [1, 3]]


def test_chat_ids_are_the_librarys(spark):
    frame = spark.createDataFrame(chat_rows(), TURNS)
    library = chat._coder(BYTE, "<|endoftext|>").library
    for r in chat.format_chats(frame, BYTE).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode(r.formatted, add_special_tokens=False).ids and len(r.loss) == len(ids)
    assert chat.format_chats(frame.where("false"), BYTE).count() == 0
    assert chat.read_chats(chat.format_chats(frame.where("false"), BYTE), BYTE).count() == 0
