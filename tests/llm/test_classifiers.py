"""Held-out accuracy of the fitted models and brute-force versions of their rules."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import features, langid, mixing, quality_knn
from shelfwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents():
    return {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


@pytest.fixture(scope="module")
def labels():
    return {r["doc_id"]: r for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}


def test_language_on_held_out_rows(spark, documents):
    got = QUERIES["op8_language"](spark, SF).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(documents) and held
    assert np.mean([r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_quality_on_held_out_rows(spark, documents, labels):
    got = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, SF).collect()}
    held = [i for i in got if got[i]["held_out"] and i in labels]
    assert len(got) == len(documents) and held
    truth = np.array([labels[i]["quality"] for i in held])
    said = np.array([got[i]["predicted"] for i in held])
    assert (truth == said).mean() > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_nearest_centroid_equals_brute_force(spark):
    draw = random.Random(1)
    rows = [(i, "".join(draw.choice("abc " if i % 2 else "xyz ") for _ in range(60)), "ab" if i % 2 else "xy") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.fit_centroids(df, "doc_id", "text", "lang")
    odd = [(100, None), (101, ""), (102, "123 !!"), (103, "ABC abc"), (104, "ж" * 50), (105, "abc " * 30000)]
    out = {r["doc_id"]: r for r in langid.identify(
        spark.createDataFrame([(*o, "k", 1.0) for o in odd], "doc_id long, text string, lang_pred string, score double"),
        "text", model, ["doc_id", "lang_pred", "score"]).collect()}
    assert [out[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3
    assert out[103]["lang_pred"] == "ab" and not out[103]["rejected"] and out[104]["rejected"]
    one = features.weighted(features.letter_counts(*features.as_bytes(__import__("pyarrow").array([odd[5][1]]))), model["idf"])
    cos = one @ model["centres"].T
    assert out[105]["score"] == pytest.approx(float(cos.max()), abs=1e-5)
    assert langid.identify(df.limit(0), "text", model, ["doc_id"]).count() == 0
    untold = langid.fit_centroids(df.where("lang = 'none'"), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in langid.identify(df, "text", untold, ["doc_id"]).collect()} == {"und"}


def test_vote_equals_brute_force():
    draw = np.random.RandomState(1)
    space = np.linalg.qr(draw.randn(30, 8))[0].astype(np.float32)
    voters = quality_knn._unit(draw.randn(50, 8)).astype(np.float32)
    labels = draw.randint(0, 2, 50).astype(float)
    x = draw.rand(2500, 30).astype(np.float32)
    got = quality_knn.vote(x, {"space": space, "voters": voters, "labels": labels}, 7)
    for i in range(0, 2500, 97):
        cos = quality_knn._unit(x[i:i + 1] @ space)[0] @ voters.T
        near = np.argsort(-cos)[:7]
        w = np.maximum(cos[near].astype(float), 1e-9) ** 4
        assert got[i] == pytest.approx((w * labels[near]).sum() / w.sum(), rel=1e-4)


def test_quality_without_labels_and_empty_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_knn.quality_report(docs, none).collect()
    assert len(got) == 4 and all(r["score"] == 0 for r in got)
    some = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    assert quality_knn.quality_report(docs, some).count() == 4
    assert quality_knn.quality_report(docs.limit(0), some).count() == 0


def test_sample_is_bounded_and_even(spark):
    df = spark.createDataFrame([(i, "a" if i % 50 else "b") for i in range(5000)], "id long, label string")
    rows = features.sample_ids(df, "id", ["label"], 100).collect()
    counts = {k: sum(r["label"] == k for r in rows) for k in "ab"}
    assert len(rows) <= 100 and counts["a"] == counts["b"] == 50


def solve_plainly(p, tokens, goal, steps=20000):
    rate, total = np.ones(len(p)), tokens.sum()
    size = 1 / np.linalg.eigvalsh((p * tokens[:, None]).T @ p / total).max()
    for _ in range(steps):
        rate = np.maximum(rate - size * (p @ (((rate * tokens) @ p - goal) / total)), 0)
    return rate


def test_rates_reach_the_targets(spark):
    draw = np.random.RandomState(3)
    p = draw.dirichlet([0.3, 0.3, 0.3], 400)
    tokens = draw.randint(0, 500, 400)
    rows = [(i, int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(tokens, p))]
    mix = spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>").repartition(3)
    targets = {"a": 0.6, "b": 0.3, "c": 0.1}
    taken = mixing.solve(mix, ["a", "b", "c"], targets, steps=200)
    out = {r["doc_id"]: r for r in mixing.rated(mix, taken, "doc_id").collect()}
    rate = np.array([out[i]["rate"] for i in range(400)])
    goal = np.array([0.6, 0.3, 0.1]) * tokens.sum()
    assert (rate >= 0).all()
    assert np.abs((rate * tokens) @ p / tokens.sum() - goal / tokens.sum()).max() < 1e-3
    plain = solve_plainly(p, tokens.astype(float), goal)
    assert np.abs((plain * tokens) @ p - goal).max() / tokens.sum() < 1e-3
    assert all(abs(r["copies"] - r["rate"]) <= 1 for r in out.values())


@pytest.mark.parametrize("shares,sure", [((0.76, 0.13, 0.11), 0.7), ((0.97, 0.02, 0.01), 0.95), ((0.1,) * 10, 0.7)])
def test_rates_reach_the_targets_by_default(spark, shares, sure):
    draw, k = np.random.RandomState(5), len(shares)
    domain = draw.choice(k, 4000, p=shares)
    p = draw.dirichlet(np.ones(k), 4000) * (1 - sure)
    p[np.arange(4000), domain] += sure
    tokens = draw.randint(1, 500, 4000)
    names = [f"d{i}" for i in range(k)]
    goal = np.array([0.92, 0.05, 0.03]) if k == 3 else np.arange(1, 11) / 55
    rows = [(i, int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(tokens, p))]
    mix = spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>")
    now = tokens @ p / tokens.sum()
    # Targets within what rates from 0 up can give.
    goal = 0.5 * goal + 0.5 * now
    out = mixing.rated(mix, mixing.solve(mix, names, dict(zip(names, goal))), "doc_id").orderBy("doc_id").collect()
    rate = np.array([r["rate"] for r in out])
    assert (rate >= 0).all()
    assert ((rate * tokens) @ p / tokens.sum()) == pytest.approx(goal, rel=mixing.CLOSE)


def test_unreachable_targets_are_named(spark):
    mix = spark.createDataFrame([(i, 10, [0.6, 0.4]) for i in range(20)], "doc_id long, tokens long, posterior array<double>")
    with pytest.warns(UserWarning, match="a 0.669231 for 0.900000, b 0.446154 for 0.100000"):
        taken = mixing.solve(mix, ["a", "b"], {"a": 0.9, "b": 0.1})
    rates = [r["rate"] for r in mixing.rated(mix, taken, "doc_id").collect()]
    assert rates == pytest.approx([(0.9 * 0.6 + 0.1 * 0.4) / (0.6 ** 2 + 0.4 ** 2)] * 20, abs=1e-4)


def test_domains_told_by_many_words(spark):
    # Forty words tell the domain, each of them in few documents; a word in all of them tells nothing.
    draw = random.Random(2)
    words = [["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(40)] for _ in range(2)]
    rows = [(i, " ".join(["the", *draw.sample(words[i % 2], 4)]), "ab"[i % 2]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string").repartition(4)
    told = docs.where("doc_id < 1500").select("doc_id", "domain")
    chosen = mixing.told_words(docs, told, "doc_id", "text", ["a", "b"])
    buckets = mixing.word_buckets(*features.as_bytes(__import__("pyarrow").array([" ".join(words[0] + words[1])])))[1]
    assert set(chosen) == set(buckets)
    model = mixing.fit_domains(docs, told, "doc_id", "text", "domain", bound=400)
    out = mixing.posteriors(docs.where("doc_id >= 1500"), "text", model, ["doc_id"]).collect()
    assert np.mean([np.argmax(r["posterior"]) == r["doc_id"] % 2 for r in out]) > 0.99


def test_copies_have_the_expected_totals(spark):
    # A hot domain leaves the others rates of 0.053 and 0.033.
    n = 9000
    rows = [(i, 10, [float(i % 3 == d) for d in range(3)]) for i in range(n)]
    mix = spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>")
    taken = mixing.solve(mix, ["clean", "poor", "toxic"], mixing.TARGETS, anchor="clean")
    out = mixing.rated(mix, taken, "doc_id").collect()
    copies = np.bincount([r["doc_id"] % 3 for r in out], [r["copies"] for r in out])
    rates = np.bincount([r["doc_id"] % 3 for r in out], [r["rate"] for r in out])
    assert copies[0] == n // 3
    assert rates[1:] == pytest.approx([3000 * 5 / 92, 3000 * 3 / 92], rel=1e-3)
    assert (np.abs(copies - rates) <= 4 * np.sqrt(rates)).all()


def test_rates_keep_to_their_bound(spark):
    # poor is rarer than its target: kept whole, never repeated; toxic reaches its own.
    p = [[0.9, 0.1, 0.0]] * 60 + [[0.0, 1.0, 0.0]] + [[0.1, 0.0, 0.9]] * 30
    rows = [(i, 10, q) for i, q in enumerate(p)]
    mix = spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>")
    targets = {"clean": 0.6, "poor": 0.3, "toxic": 0.1}
    with pytest.warns(UserWarning, match="no rates reach"):
        taken = mixing.solve(mix, ["clean", "poor", "toxic"], targets, anchor="clean", most=1.0)
    rate = np.array([r["rate"] for r in mixing.rated(mix, taken, "doc_id").orderBy("doc_id").collect()])
    assert (rate >= 0).all() and (rate <= 1).all() and rate[60] == 1
    p, best = np.array(p), np.ones(len(p))
    goal = np.array([0.6, 0.3, 0.1]) * p[:, 0].sum() / 0.6
    for _ in range(20000):
        best = np.clip(best - 0.02 * p @ (best @ p - goal), 0, 1)
    assert rate @ p == pytest.approx(best @ p, abs=1e-3)


def test_an_unreachable_target_leaves_the_nearest_mix(spark):
    rows = [(i, 10, [1.0, 0.0]) for i in range(20)]
    mix = spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>")
    taken = mixing.solve(mix, ["a", "b"], {"a": 0.5, "b": 0.5}, steps=200)
    rates = [r["rate"] for r in mixing.rated(mix, taken, "doc_id").collect()]
    assert rates == pytest.approx([0.5] * 20, abs=1e-2)


def test_mix_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, domain string")
    got = mixing.mixed(docs, none, {}).collect()
    assert len(got) == 3 and all(r["rate"] == 1 and r["copies"] == 1 for r in got)
    told = spark.createDataFrame([(1, "x")], "doc_id long, domain string")
    assert mixing.mixed(docs, told, {"x": 1.0}).count() == 3
    assert mixing.mixed(docs.limit(0), told, {"x": 1.0}).count() == 0


def test_domains_of_repeated_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["domain"] for r in mixing.label_domains(labels).collect()}
    assert got == {1: "poor", 2: "toxic", 3: "clean", 4: None}


def test_letter_counts_do_not_cross_rows():
    import pyarrow as pa

    both = features.letter_counts(*features.as_bytes(pa.array(["abc", "", "deé"])))
    alone = [features.letter_counts(*features.as_bytes(pa.array([t])))[0] for t in ("abc", "", "deé")]
    assert (both == np.stack(alone)).all()
    shapes = features.shape_counts(*features.as_bytes(pa.array(["a!! a!!", None, "B"])))
    assert (shapes == np.stack([features.shape_counts(*features.as_bytes(pa.array([t], pa.string())))[0] for t in ("a!! a!!", None, "B")])).all()


def test_words_of_bytes():
    import pyarrow as pa

    from shelfwise.llm.texts import as_bytes, hash_of, hashed_words

    texts = ["The cat\x0bsat", "", None, " \t", "É the", "x" * 3000]
    words, rows = hashed_words(*as_bytes(pa.array(texts)))
    want = [(i, hash_of(w.decode())) for i, t in enumerate(texts) for w in (t or "").encode().lower().split()]
    assert list(zip(rows.tolist(), words.tolist())) == want
    assert F is not None


def test_copies_of_null_and_repeated_ids_are_drawn_row_by_row(spark):
    rows = [(None, 10, [1.0], i) for i in range(400)] + [(7, 10, [1.0], 5)] * 400 + [(8, 10, [1.0], i) for i in range(400)]
    mix = spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>, text_hash long").repartition(5)
    out = mixing.rated(mix, {"steps": [[0.5]], "most": np.inf}, "doc_id")
    assert out.columns == [*mix.columns, "rate", "copies"]
    kept = [sum(r.copies for r in out.where(c).collect()) for c in ("doc_id is null", "doc_id = 7", "doc_id = 8")]
    assert all(abs(n - 200) < 60 for n in kept) and out.count() == 1200


def test_steps_are_projected_gradients(spark):
    # With the plain gradient alone (one domain, one length) the loop is the textbook one.
    p, tokens = np.array([[1.0], [0.5], [0.2]]), np.array([10.0, 20.0, 5.0])
    rate = np.ones(3)
    for u in ([0.4], [0.9], [-0.2]):
        rate = np.clip(rate - p @ np.array(u), 0, 1)
    assert mixing.rates_of(p, [[0.4], [0.9], [-0.2]], 1.0) == pytest.approx(rate)
    mix = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "tokens long, posterior array<double>")
    sums, curve = mixing.totals(mix, [[0.4], [0.9]], np.array([[-0.2], [0.0]]), 1.0)
    assert sums[0] == pytest.approx((rate * tokens) @ p)
    inner = (rate > 0) & (rate < 1)
    assert curve[0] == pytest.approx((p[inner] * tokens[inner][:, None]).T @ p[inner])


def test_words_without_columns_fit_as_with_columns():
    draw = np.random.RandomState(1)
    rows, held = draw.rand(80, 6).astype(np.float32), draw.rand(80, 9) < 0.3
    label = (held[:, 0] | (rows[:, 1] > 0.7)).astype(int)
    of, word = np.nonzero(held)
    sparse = mixing.fit_softmax(rows, label, 2, steps=150, of=of, word=word, n_words=9)
    dense = mixing.fit_softmax(np.concatenate([rows, mixing.WORD_WEIGHT * held.astype(np.float32)], 1), label, 2, steps=150)
    assert sparse == pytest.approx(dense, abs=1e-3)


def test_one_repeated_id_among_the_labelled_leaves_the_others(spark):
    rows = [(1, f"hot text {i % 3}") for i in range(300)] + [(i, f"plain words {i} abc") for i in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    told = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(1, 300)], "doc_id long, domain string")
    seen = []
    plain = mixing.fit_softmax
    mixing.fit_softmax = lambda rows, label, *a, **b: (seen.append(len(rows)), plain(rows, label, *a, **b))[1]
    try:
        mixing.mixed(docs.withColumn("tokens", F.lit(1)).withColumn("rate", F.lit("x")), told, {"a": 0.5, "b": 0.5}).count()
    finally:
        mixing.fit_softmax = plain
    assert seen == [299]
