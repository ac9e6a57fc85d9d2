import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from conftest import SMOKE_DIR
from lendscope.llm import boosting, common, language, mixing, nearest, packing, quality, queries, simhash
from llm_tables import DOCS, empty, hard, hard_rows, labels, row


def table(spark, name):
    return queries.table(spark, SMOKE_DIR, name)


def test_boosting_learns_a_step_and_an_interaction():
    x = np.random.default_rng(2).uniform(size=(3_000, 4))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.3)).astype(float)
    trees = boosting.fit(x[:2_000], y[:2_000], rounds=60)
    assert ((trees.score(x[2_000:]) >= 0.5) == y[2_000:]).mean() > 0.97


def test_flattened_trees_walk_as_one_row_at_a_time():
    x = np.random.default_rng(4).normal(size=(400, 3))
    trees = boosting.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float), rounds=7, depth=3)

    def one(row):
        total = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [one(r) for r in x])


@pytest.mark.parametrize("y", [[], [1.0] * 5, [0.0] * 5])
def test_boosting_without_two_classes(y):
    trees = boosting.fit(np.ones((len(y), 2)), np.array(y))
    score = trees.score(np.ones((3, 2)))
    assert ((0 < score) & (score < 1)).all() and len(set(score)) == 1


def test_statistics_of_any_text():
    for r in hard_rows():
        found = quality.statistics((r[1] or "").encode())
        assert len(found) == len(quality.FEATURES) and np.isfinite(found).all()


def test_quality_on_held_out_rows(spark):
    found = queries.op2_quality(spark, SMOKE_DIR)
    assert found.count() == table(spark, "documents").count()
    known = found.join(table(spark, "labels"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in known)
    assert sum(r.predicted == r.quality for r in known) / len(known) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in known)


def test_quality_of_hard_rows(spark):
    known = labels(spark, [(i, i % 2, 0, "x") for i in (5, 2, 9, 9, 11, 13, 99)] + [(None, 1, 0, "x"), (20, None, None, None)])
    model = quality.train(hard(spark), known)
    found = quality.score(hard(spark), model).collect()
    assert len(found) == len(hard_rows()) and all(0 <= r.score <= 1 for r in found)
    assert quality.score(empty(spark), model).count() == 0
    blank = quality.train(hard(spark), labels(spark, []))
    assert {r.score for r in quality.score(hard(spark), blank).collect()} == {0.5}


def test_held_out_labels_do_not_matter(spark):
    docs, known = table(spark, "documents"), table(spark, "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    turned = known.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, known), quality.train(docs, turned)
    assert (a.value == b.value).all() and (a.feature == b.feature).all()


def test_language_on_held_out_rows(spark):
    found = queries.op9_language(spark, SMOKE_DIR)
    known = found.join(table(spark, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(known) == table(spark, "documents").count()
    held = [r for r in known if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in known)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95


def test_language_of_hard_rows(spark):
    model = language.train(table(spark, "documents"))
    found = language.identify(hard(spark), model).collect()
    assert len(found) == len(hard_rows())
    for r in found:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (13, 14, 15, 17) or (r.doc_id is None and r.score == 0))
    nothing = language.train(empty(spark))
    assert {r.lang_pred for r in language.identify(hard(spark), nothing).collect()} == {"und"}
    assert language.identify(empty(spark), model).count() == 0


def test_filters_return_every_language_of_a_trigram():
    counted = [("a", 1, 50), ("b", 1, 5), ("b", 2, 5), ("c", 3, 5), ("a", 4, 100), ("c", 4, 1)]
    found = language.filters(counted)
    masks = found.masks(np.array([1, 2, 3, 4, 999], np.uint64)).tolist()
    assert masks == [0b011, 0b010, 0b100, 0b001, 0]


def test_more_languages_than_a_word_has_bits(spark):
    spell = [f"{a}{b}" for a in "bcdfghjklmnpq" for b in "aeiouy"]
    rows = [row(i, f"{x}{x}{x} {x}r{x}", lang=f"l{i % 70:02}") for i, x in enumerate(spell[:70] * 4)]
    model = language.train(spark.createDataFrame(rows, DOCS))
    assert len(model.names) == 70 and len(model.words) == 2
    found = language.identify(spark.createDataFrame(rows, DOCS), model).collect()
    assert len(found) == len(rows)
    assert all(r.lang_pred == f"l{r.doc_id % 70:02}" for r in found)


def test_a_language_is_sampled_in_parts(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("language"))
    found = language.sampled(ids, 2_000)
    parts = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window " in line]
    assert len(parts) == 2 and sum("salt" in line.split("windowspecdefinition(")[1] for line in parts) == 1
    want = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2_000).collect()]
    assert sorted(r.doc_id for r in found.collect()) == sorted(want)


def brute(rows, every, k):
    out = {}
    for q, x in rows:
        if q % every == 0:
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), v) for v, y in rows if v != q and len(y) == len(x))
            out[q] = near[:k]
    return out


def test_nearest_recall_and_scores(spark):
    vectors = table(spark, "embeddings")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in vectors.collect()]
    want, found = brute(rows, 20, 10), {}
    for blocks in ((65_536, 1_024), (100, 7)):
        result = nearest.nearest(vectors, every=20, code_block=blocks[0], query_block=blocks[1]).collect()
        found = {(r.query_id, r["rank"]): (r.score, r.vec_id) for r in result}
        assert len(found) == 10 * len(want)
        hits = sum(len({v for _, v in want[q]} & {found[q, i][1] for i in range(1, 11)}) for q in want)
        assert hits / (10 * len(want)) >= 0.99
        exact = {q: dict((v, s) for s, v in brute([*rows], 20, len(rows))[q]) for q in list(want)[:3]}
        for q in exact:
            assert all(abs(exact[q][found[q, i][1]] - found[q, i][0]) < 1e-12 for i in range(1, 11))


def test_nearest_of_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (4, [0.0, 2.0, 0.0]), (4, [0.0, 9.0, 0.0]),
        (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 0.0]), (7, [inf, 1.0, 0.0]), (8, [None, 1.0, 0.0]), (9, None), (10, []),
        (None, [1.0, 0.0, 0.0]), (100, [1.0, 1.0]), (12, [1.0, 2.0]), (200, [5.0]), (0, [1.0, 0.0, 0.0]),
    ]
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.DoubleType())),
        ]
    )
    vectors = spark.createDataFrame(rows, schema).withColumn("score", F.lit("x")).withColumn("cell", F.lit(1))
    found = sorted(tuple(r) for r in nearest.nearest(vectors, k=3).collect())
    far = 5**0.5
    assert found == [(0, 1, 1, 0.0), (0, 2, 3, 0.0), (0, 3, 4, far), (100, 1, 12, 1.0)]
    assert nearest.nearest(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1e160, 1e-200, 1e300])
def test_nearest_of_enormous_and_tiny_vectors(spark, size):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8))
    x[5:300] *= size
    x[7] = [1e308, -1e308] * 4
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")

    def distance(a, b):
        gap = [abs(p - q) for p, q in zip(a.tolist(), b.tolist())]
        return math.dist(gap, [0.0] * len(gap))

    for block in (8_192, 64):
        found = {}
        for r in nearest.nearest(vectors, every=100, code_block=block).collect():
            found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
        assert sorted(found) == list(range(0, 600, 100))
        for q, answers in found.items():
            best = sorted((distance(x[i], x[q]), i) for i in range(600) if i != q)[:10]
            assert [v for _, _, v in sorted(answers)] == [i for _, i in best]
            assert all(s == pytest.approx(d, rel=1e-12) for (_, s, _), (d, _) in zip(sorted(answers), best))


def test_an_id_in_many_rows_takes_one_place(spark):
    rng = np.random.default_rng(9)
    rows = [(0, rng.normal(size=6).tolist())]
    near = np.array(rows[0][1])
    rows += [(7, (near + 0.01).tolist())] * 15  # one row again and again
    rows += [(8, (near + 0.02 + i / 1e4).tolist()) for i in range(15)]  # one id, other vectors
    rows += [(i, rng.normal(size=6).tolist()) for i in range(10, 40)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {}
    for v, x in rows[1:]:
        d = float(np.sqrt(((np.array(x) - near) ** 2).sum()))
        want[v] = min(d, want.get(v, d))
    best = sorted((d, v) for v, d in want.items())[:10]
    for block in (8_192, 20):
        found = nearest.nearest(vectors, code_block=block).orderBy("rank").collect()
        assert [(r["rank"], r.vec_id) for r in found] == [(i + 1, v) for i, (_, v) in enumerate(best)]
        assert np.allclose([r.score for r in found], [d for d, _ in best])


def test_rates_meet_the_targets(spark):
    labelled = table(spark, "labels").withColumn("domain", mixing.domain_of())
    for weights in (queries.WEIGHTS, {"good": 0.5, "low": 0.3, "toxic": 0.2}):
        found = mixing.mixture(table(spark, "documents"), labelled, weights).collect()
        assert len(found) == table(spark, "documents").count()
        p, n = np.array([r.posterior for r in found]), np.array([r.n_tokens for r in found])
        rate, copies = np.array([r.rate for r in found]), np.array([r.copies for r in found])
        assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all()
        shares = (p * (n * rate)[:, None]).sum(axis=0) / n.sum()
        assert np.abs(shares - [weights[d] for d in found[0].domains]).max() < 0.01
        assert ((copies == np.floor(rate)) | (copies == np.ceil(rate))).all()


def test_kept_domains_are_not_thinned(spark, monkeypatch):
    labelled = table(spark, "labels").withColumn("domain", mixing.domain_of())
    docs = table(spark, "documents")
    weights = {"good": 0.3, "low": 0.4, "toxic": 0.3}
    found = mixing.mixture(docs, labelled, weights, keep=("good",)).collect()
    p, n = np.array([r.posterior for r in found]), np.array([r.n_tokens for r in found])
    rate = np.array([r.rate for r in found])
    own = p.argmax(axis=1) == found[0].domains.index("good")
    assert own.any() and (rate[own] >= 1).all() and all(r.copies >= 1 for r, o in zip(found, own) if o)
    assert found[0].targets_met
    shares = (p * (n * rate)[:, None]).sum(axis=0)
    assert np.abs(shares / shares.sum() - [weights[d] for d in found[0].domains]).max() < 0.01
    # What cannot be met is said.
    monkeypatch.setattr(mixing, "GROWTHS", 0)
    assert not mixing.mixture(docs, labelled, weights, keep=("good",)).first().targets_met


def test_rates_are_the_least_squares_ones(spark):
    """The targets a plain projected gradient meets are met; the pull of the rates towards 1 costs less than 1e-4."""
    rng = np.random.default_rng(12)
    p = rng.dirichlet([0.4, 0.3, 0.3], 60)
    n = rng.integers(1, 50, 60).astype(float)
    rows = [(i, i, int(n[i]), p[i].tolist()) for i in range(60)]
    members = spark.createDataFrame(rows, "doc_id long, row long, n_tokens long, posterior array<double>")
    target = np.array([0.5, 0.2, 0.3])
    rated, seen = mixing.fit_rates(members, target, passes=30, close=1e-4)
    rate = np.array([r.rate for r in sorted(rated.collect(), key=lambda r: r.doc_id)])
    a = p * n[:, None] / n.sum()
    assert (rate >= 0).all() and np.abs(rate @ a - target).max() < 1e-4 and np.abs(np.array(seen[-1]) - target).max() < 1e-4
    plain = np.ones(60)
    for _ in range(200_000):
        plain = np.maximum(0, plain - 20 * a @ (plain @ a - target))
    assert np.abs(plain @ a - target).max() < 1e-6


def test_mixture_of_hard_rows(spark):
    known = labels(spark, [(5, 1, 0, "x"), (9, 0, 0, "x"), (17, 0, 1, "x"), (None, 1, 0, "x")])
    labelled = known.withColumn("domain", mixing.domain_of())
    assert len(mixing.mixture(hard(spark), labelled, {"good": 1.0}).collect()) == len(hard_rows())
    alone = mixing.mixture(hard(spark), labelled.limit(0), queries.WEIGHTS).collect()
    assert {r.rate for r in alone} == {1.0} and {r.copies for r in alone} == {1}
    assert mixing.mixture(empty(spark), labelled, queries.WEIGHTS).count() == 0


def test_every_stage_takes_hard_and_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (hard(spark), empty(spark)):
            found = stage(spark, docs, SMOKE_DIR)
            assert found.columns == docs.columns, name
            known = {tuple(r) for r in docs.collect()}
            assert all(tuple(r) in known for r in found.collect()), name


def test_stages_on_hard_rows(spark):
    kept = [r.doc_id for r in corpus_pipeline.drop_copies(spark, hard(spark), SMOKE_DIR).collect()]
    # Of five rows with the passage alone (ids -4, 9, 9, 11, null), the smallest id; of the empty texts one.
    assert sorted(str(i) for i in kept) == sorted(
        str(i) for i in (5, 2, 9, -4, 13, 15, 16, 17, 18, 19, 2**62, 20, 21, 22)
    )
    near = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, hard(spark), SMOKE_DIR).collect()]
    assert 18 in near and 19 not in near and 11 not in near


def by_text(monkeypatch):
    """Stages that decide by the text alone: rows with 'bad' are rejected, and rates are 0 or 3."""

    def score(docs, model):
        bad = F.col("text").contains("bad")
        return docs.select("doc_id", F.when(bad, 0).otherwise(1).alias("predicted"), F.xxhash64(common.text_bytes("text")).alias("row"))

    def mixture(docs, labelled, weights, keep):
        row = F.xxhash64(common.text_bytes("text")).alias("row")
        return docs.select("doc_id", row, F.when(F.col("text").contains("often"), 3).otherwise(0).alias("copies"))

    monkeypatch.setattr(quality, "train", lambda docs, labels: None)
    monkeypatch.setattr(quality, "score", score)
    monkeypatch.setattr(mixing, "mixture", mixture)


def test_stages_judge_rows_not_ids(spark, monkeypatch):
    rows = [row(1, "fine"), row(1, "bad one"), row(1, "bad two"), row(None, "bad three"), row(None, "often"), row(None, None), row(2, "often")]
    extra = ["__row", "__copies", "__copy", "__text", "__id"]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(c) for c in extra})
    by_text(monkeypatch)
    good = corpus_pipeline.keep_good(spark, docs, SMOKE_DIR)
    assert good.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in good.collect()), key=repr) == [(1, "fine"), (2, "often"), (None, "often"), (None, None)]
    mixed = corpus_pipeline.mix(spark, docs, SMOKE_DIR)
    assert mixed.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in mixed.collect()) == {(None, "often"): 3, (2, "often"): 3}
    for stage in (corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies):
        left = stage(spark, docs, SMOKE_DIR)
        assert left.columns == docs.columns and 0 < left.count() <= len(rows)


def test_near_copies_are_dropped_by_row(spark):
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, hard(spark), SMOKE_DIR).collect()]
    assert (9, "another text under the same id") in kept
    found = simhash.grouped_rows(hard(spark), shingle=4, radius=4).collect()
    assert len(kept) == len(set(kept)) == len({r.root for r in found})
    # The kept row's id has a second text, a copy in another group; both groups leave one row.
    rows = [row(1, "b c d e f g"), row(1, "p q r s t u"), row(0, "p q r s t u"), row(2, "b c d e f g"), row(2, "b c d e f g")]
    rows += [row(None, "only without an id"), row(None, "only without an id"), row(None, "p q r s t u")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    left = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, SMOKE_DIR).collect()]
    assert sorted(left, key=repr) == [(0, "p q r s t u"), (1, "b c d e f g"), (None, "only without an id")]


def test_pipeline(spark):
    pieces = corpus_pipeline.run(spark, SMOKE_DIR)
    found = pieces.drop("ids").collect()
    fill = {}
    for r in found:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= packing.LENGTH
    known = {r.doc_id: r for r in table(spark, "labels").collect()}
    ids = {r.doc_id for r in found}
    bad = [i for i in ids if i in known and known[i].quality == 0]
    good = [i for i, r in known.items() if r.quality == 1 and r.toxic == 0]
    copies = {r.doc_id for r in queries.op8_exact_dedup(spark, SMOKE_DIR).where("not kept").collect()}
    near = {r.doc_id for r in queries.op3_simhash(spark, SMOKE_DIR).where("doc_id <> component_id").collect()}
    lost = [i for i in good if i not in ids and i not in copies and i not in near]
    assert len(bad) <= 1 and len(lost) <= 1
    assert not ids & copies
