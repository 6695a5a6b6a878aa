import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import blocks, id_quality, ranking, semantic_ids, similarity
from shelfwise.operators import vector_index as index
from shelfwise.sources import writers

RNG = np.random.default_rng(3)
DIM = 6


def frame(spark, x, key="item_id", start=0, extra=()):
    data = [(start + i, [float(v) for v in row], *e) for i, (row, e) in
            enumerate(zip(x, extra or [()] * len(x)))]
    schema = f"{key} long, embedding array<double>"
    return spark.createDataFrame(data, schema + (", label long" if extra else ""))


@pytest.mark.parametrize("tile, group", [(3, 2), (4096, 2048)])
@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_block_top_k(spark, tile, group, metric):
    x, q = RNG.normal(size=(23, DIM)), RNG.normal(size=(7, DIM))
    x[5] = x[11]
    score = q @ x.T if metric == "ip" else ((q[:, None] - x[None]) ** 2).sum(2)
    sign = -1 if metric == "ip" else 1
    found = blocks.block_top_k(
        frame(spark, q, "query_id"), frame(spark, x), 5, metric, tile=tile, query_block=group
    ).collect()
    got = {(r.query_id, r["rank"]): r.item_id for r in found}
    for i in range(7):
        order = sorted((sign * round(score[i, j], 6), j) for j in range(23))[:5]
        assert [got[i, k + 1] for k in range(5)] == [j for _, j in order]


def test_block_top_k_exclusions_and_small_index(spark, rows):
    x = RNG.normal(size=(4, DIM))
    both = frame(spark, x)
    queries = both.withColumnRenamed("item_id", "query_id")
    found = blocks.block_top_k(queries, both, 10, skip_self=True, tile=2, query_block=2)
    assert found.count() == 12 and found.where("query_id = item_id").count() == 0
    skip = spark.createDataFrame([(0, 1), (0, 2), (3, 0)], "query_id long, item_id long")
    left = blocks.block_top_k(queries, both, 10, exclude=skip, tile=2, query_block=2)
    pairs = set(rows(left, "query_id", "item_id"))
    assert len(pairs) == 13 and not pairs & {(0, 1), (0, 2), (3, 0)}


def test_profile_excludes_long_histories(spark):
    x = RNG.normal(size=(12, DIM))
    history = spark.createDataFrame([(1, i) for i in range(11)] + [(2, 3)],
                                    "user_id long, item_id long")
    found = similarity.recommend_from_profile(history, frame(spark, x), 2).collect()
    assert [r.item_id for r in found if r.user_id == 1] == [11]
    assert sum(r.user_id == 2 for r in found) == 2


def test_all_cells_probed_is_exact(spark, rows):
    x = RNG.normal(size=(40, DIM))
    vectors, queries = frame(spark, x), frame(spark, RNG.normal(size=(6, DIM)), "query_id")
    cells, centroids = index.ivf_build(vectors, nlist=5)
    exact = index.search_flat(index.build_flat(vectors, DIM), queries, 7)
    assert rows(index.ivf_search(cells, centroids, queries, 7, nprobe=5)) == rows(exact)
    few = index.ivf_search(cells, centroids, queries, 7, nprobe=2)
    recall = index.recall_at_k(few, exact, sample=4).first()
    assert recall["expected"] == 28 and 0 < recall["recall"] <= 1


def test_nearest_code_beyond_the_model_bound(spark, rows, monkeypatch):
    x, c = RNG.normal(size=(30, DIM)), RNG.normal(size=(5, DIM))
    vectors, book = frame(spark, x), frame(spark, c, "code")
    small = rows(index.nearest_code(vectors, book), "item_id", "code")
    monkeypatch.setattr(index, "MODEL_CODES", 3)
    assert rows(index.nearest_code(vectors, book), "item_id", "code") == small
    want = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
    assert small == [(i, int(k)) for i, k in enumerate(want)]


def test_hash_search_recall(spark):
    centers = RNG.normal(size=(8, DIM))
    x = centers[RNG.integers(0, 8, 200)] + 0.05 * RNG.normal(size=(200, DIM))
    vectors = index.build_flat(frame(spark, x))
    queries = frame(spark, centers, "query_id")
    exact = index.search_flat(vectors, queries, 10)
    found = index.lsh_search(vectors, queries, 10, DIM, tables=8, bits=3)
    assert found.groupBy("query_id", "item_id").count().where("count > 1").count() == 0
    assert index.recall_at_k(found, exact).first()["recall"] > 0.8


def test_product_codes(spark):
    x = RNG.normal(size=(30, DIM))
    vectors = frame(spark, x)
    books = index.pq_first_k_codebooks(vectors, 3, DIM, bits=2)
    codes = {r.item_id: r.codes for r in index.pq_encode(vectors, books).collect()}
    for i in range(30):
        for p in range(3):
            part = slice(2 * p, 2 * p + 2)
            assert codes[i][p] == ((x[i, part] - x[:4, part]) ** 2).sum(1).argmin()
    with pytest.raises(ValueError):
        index.sub_vectors(vectors, 4, DIM)
    trained = index.pq_kmeans_codebooks(vectors, 3, DIM, bits=2)
    assert trained.groupBy("sub").count().collect() and trained.count() <= 12


def test_added_items_replace(spark):
    x = RNG.normal(size=(4, DIM))
    base = index.build_flat(frame(spark, x))
    whole = index.add_items(base, frame(spark, -x[:2], start=3))
    assert sorted(r.item_id for r in whole.collect()) == [0, 1, 2, 3, 4]
    replaced = whole.where("item_id = 3").first()["embedding"]
    assert np.allclose(replaced, -x[0] / np.linalg.norm(x[0]))


def test_silhouette_and_singletons(spark):
    x = np.array([[0.0, 0], [0, 1], [10, 0], [10, 1], [50, 50]])
    labels = [(0,), (0,), (1,), (1,), (2,)]
    points = frame(spark, x, extra=labels)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    l = np.array([0, 0, 1, 1, 2])
    want = []
    for i in range(5):
        own = (l == l[i]) & (np.arange(5) != i)
        if not own.any():
            want.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, l == k].mean() for k in set(l) - {l[i]})
        want.append((b - a) / max(a, b))
    assert id_quality.silhouette(points).first()[0] == pytest.approx(np.mean(want), abs=1e-6)
    same = points.withColumn("label", F.lit(1).cast("long"))
    assert id_quality.silhouette(same).first()[0] == -1.0
    assert id_quality.calinski_harabasz(same).first()[0] == 0.0


@pytest.mark.parametrize("spread", [0.2, 1.0, 4.0])
def test_near_labels_hold_the_nearest(spark, spread):
    n, dim = 240, 12
    label = np.r_[np.zeros(80, int), RNG.integers(1, 9, size=n - 81), [20]]
    x = RNG.normal(size=(21, dim))[label] * 2 + spread * RNG.normal(size=(n, dim))
    x[5] = x[6]
    points = frame(spark, x, extra=[(int(v),) for v in label])
    kept = {(r.query_id, r.cell) for r in id_quality.near_labels(points).collect()}
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(n):
        mean = {v: far[i, label == v].mean() for v in set(label.tolist()) - {label[i]}}
        assert (i, label[i]) in kept and (i, min(mean, key=mean.get)) in kept
    assert len(kept) < n * 10 * (0.6 if spread < 4 else 1)
    near, every = (id_quality.silhouette(points, bound=b, whole=0).first()[0] for b in (1 << 20, 1))
    assert near == every



def test_block_sums_over_tiles(spark):
    x = RNG.normal(size=(20, DIM))
    points = frame(spark, x, extra=[(i % 3,) for i in range(20)])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for r in blocks.block_distance_sums(points, "label", tile=4).collect():
        members = [j for j in range(20) if j % 3 == r.other]
        assert r.distance == pytest.approx(d[r.item_id, members].sum(), abs=1e-6)


def python_nodes(df):
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_codes_are_found_by_one_python_worker(spark):
    """A join on the code, or an explode of the cells, does not repeat the function in a filter."""
    vectors = frame(spark, RNG.normal(size=(30, DIM)))
    book = index.settle_codebook(index.first_k_codebook(vectors, 4))
    assert python_nodes(semantic_ids.lloyd_step(vectors, book)) == 1
    assert python_nodes(semantic_ids.with_centroid(index.nearest_code(vectors, book), book)) == 1
    queries = vectors.withColumnRenamed("item_id", "query_id")
    assert python_nodes(index.nearest_cells(queries, book, 2).select("cell").distinct()) == 1


def test_near_labels_over_several_slices(spark):
    n = 2 * blocks.LINES + 7
    x = RNG.normal(size=(n, DIM))
    points = frame(spark, x, extra=[(i % 5,) for i in range(n)]).coalesce(1)
    kept = id_quality.near_labels(points)
    assert {r.query_id for r in kept.select("query_id").distinct().collect()} == set(range(n))
    near, every = (id_quality.silhouette(points, bound=b, whole=0).first()[0] for b in (1 << 20, 1))
    assert near == every


@pytest.mark.parametrize("empty", [None, 0, 1, 2])
def test_levels_are_quantized_by_one_python_worker(spark, monkeypatch, empty):
    x = RNG.normal(size=(40, DIM))
    vectors = frame(spark, x)
    books = [RNG.normal(size=(k, DIM)) / (level + 1) for level, k in enumerate((5, 4, 3))]
    rows = [(level, code, [float(t) for t in c]) for level, book in enumerate(books) if level != empty
            for code, c in enumerate(book)]
    table = spark.createDataFrame(rows, "level long, code long, embedding array<double>")
    out = semantic_ids.residual_quantize(vectors, table, 3)
    assert out.columns == ["item_id", "residual", "embedding", "codes", "inputs", "quantized"]
    assert python_nodes(out) == 1
    got = {r.item_id: r for r in out.collect()}
    left = x.copy()
    for level, book in enumerate(books):
        near = np.zeros(40, int)
        if level != empty:
            near = ((left[:, None] - book[None]) ** 2).sum(2).argmin(1)
        for i in range(40):
            assert got[i].codes[level] == near[i] and got[i].inputs[level] == left[i].tolist()
        if level != empty:
            left = left - book[near]
    assert all(got[i].residual == left[i].tolist() for i in range(40))
    # A codebook that is too large to travel gives the same.
    monkeypatch.setattr(index, "MODEL_CODES", 2)
    large = {r.item_id: r for r in semantic_ids.residual_quantize(vectors, table, 3).collect()}
    assert large == got


def test_kmeans_codebooks(spark):
    vectors = frame(spark, RNG.normal(size=(60, DIM)))
    books = semantic_ids.fit_codebooks(vectors, [8, 4], init="kmeans")
    assert {(r.level, r["count"]) for r in books.groupBy("level").count().collect()} == {(0, 8), (1, 4)}
    out = semantic_ids.residual_quantize(vectors, books, 2)
    rebuilt = semantic_ids.reconstruct(out, books, 2).withColumnRenamed("embedding", "rebuilt")
    loss = {r.level: r.loss for r in semantic_ids.quantization_loss(out, books, 2).collect()}
    assert 0 <= loss[1] < loss[0] and loss[-1] >= 0
    for r in out.join(rebuilt, "item_id").collect():
        assert len(r.codes) == 2
        assert np.allclose(np.array(r.quantized), r.rebuilt)
        assert np.allclose(np.array(r.embedding) - r.rebuilt, r.residual)


def test_levels_without_spread_are_skipped(spark):
    flat = frame(spark, np.ones((10, DIM)))
    with pytest.raises(ValueError):
        semantic_ids.fit_codebooks(flat, [2], init="kmeans")
    few = frame(spark, RNG.normal(size=(5, DIM)))
    books = semantic_ids.fit_codebooks(few, [2, 9], init="first_k")
    assert {r.level for r in books.collect()} == {0}


def test_variance_penalty_depends_on_scale(spark):
    x = RNG.normal(size=(50, DIM))
    a = semantic_ids.variance_penalty(frame(spark, x)).first()[0]
    b = semantic_ids.variance_penalty(frame(spark, 5 * x)).first()[0]
    assert a != b and a >= 0


def test_dead_codes_with_noise_repeat(spark, rows):
    book = frame(spark, RNG.normal(size=(6, DIM)), "code")
    used = spark.createDataFrame([(0, 5), (1, 9)], "code long, used long")
    a = semantic_ids.reset_dead_codes(book, used)
    first, again = rows(a, "code", "embedding"), rows(a, "code", "embedding")
    assert first == again and a.where("dead").count() == 4
    live = [np.array(v) for _, v in first[:2]]
    for _, v in first[2:]:
        gap = min(np.abs(np.array(v) - w).max() for w in live)
        assert 0 < gap < 0.1
    state = {r.code: r for r in a.collect()}
    assert [state[c].cluster_size for c in range(6)] == [5.0, 9.0, 1.0, 1.0, 1.0, 1.0]
    assert state[3].embed_avg == state[3].embedding
    assert np.allclose(state[1].embed_avg, 9 * np.array(state[1].embedding))
    later = semantic_ids.reset_dead_codes(a.drop("dead"), used.where("code = 1"))
    kept = {r.code: r for r in later.collect()}
    assert kept[1] == state[1] and kept[0].cluster_size == 1.0 and kept[0].dead
    nothing = semantic_ids.reset_dead_codes(book, used.where("code = 99"))
    assert rows(nothing, "code", "embedding") == rows(book, "code", "embedding")


def test_joint_score_against_numpy(spark):
    layers = [
        {"weight": RNG.normal(size=(5, 6)), "bias": RNG.normal(size=5),
         "scale": RNG.normal(size=5), "shift": RNG.normal(size=5)},
        {"weight": RNG.normal(size=(1, 5)), "bias": RNG.normal(size=1)},
    ]
    x = RNG.normal(size=(9, 6))
    data = [(1, i, list(map(float, r[:2])), list(map(float, r[2:4])), list(map(float, r[4:])))
            for i, r in enumerate(x)]
    df = spark.createDataFrame(data, "user_id long, item_id long, user_features array<double>, "
                               "item_features array<double>, cross_features array<double>")
    h = x @ layers[0]["weight"].T + layers[0]["bias"]
    h = (h - h.mean(1, keepdims=True)) / np.sqrt(h.var(1, keepdims=True) + 1e-5)
    h = np.maximum(h * layers[0]["scale"] + layers[0]["shift"], 0)
    want = (h @ layers[1]["weight"].T + layers[1]["bias"]).ravel()
    got = {r.item_id: r.score for r in ranking.joint_score(df, layers).collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in range(9))


def test_top_k_of_large_scores(spark):
    values = frame(spark, [[float(i), 1e5 * i] for i in range(300)])
    found = blocks.block_top_k(frame(spark, [[1.0, 1e8]], "query_id"), values, 5).orderBy("rank").collect()
    assert [r.item_id for r in found] == [299, 298, 297, 296, 295]


def test_ties_go_to_the_lowest_id_and_exclusions_take_no_slot(spark):
    values = frame(spark, [[1.0], [2.0], [2.0], [2.0], [0.5]])
    asked = frame(spark, [[1.0]], "query_id")
    out = spark.createDataFrame([(0, 1)], "query_id long, item_id long")
    found = blocks.block_top_k(asked, values, 3, exclude=out).orderBy("rank").collect()
    assert [r.item_id for r in found] == [2, 3, 0]
    empty = values.where("item_id < 0")
    assert blocks.block_top_k(asked, empty, 3, exclude=out).count() == 0


def test_small_residuals_get_the_same_code_both_ways(spark, rows, monkeypatch):
    x, c = 1e-4 * RNG.normal(size=(40, DIM)), 1e-4 * RNG.normal(size=(9, DIM))
    vectors, book = frame(spark, x), frame(spark, c, "code")
    small = rows(index.nearest_code(vectors, book), "item_id", "code")
    monkeypatch.setattr(index, "MODEL_CODES", 3)
    assert rows(index.nearest_code(vectors, book), "item_id", "code") == small
    assert len({k for _, k in small}) > 1


def test_skipped_level_keeps_every_vector(spark):
    vectors = frame(spark, RNG.normal(size=(20, DIM)))
    books = semantic_ids.fit_codebooks(vectors, [4, 100], init="first_k")
    coded = semantic_ids.residual_quantize(vectors, books, 2)
    assert coded.count() == 20
    assert all(r["codes"][1] == 0 for r in coded.collect())
    assert semantic_ids.reconstruct(coded, books, 2).count() == 20


def test_many_parts_of_product_codes(spark):
    width = 96
    vectors = frame(spark, RNG.normal(size=(256, width)))
    books = index.pq_first_k_codebooks(vectors, width, width, 8)
    assert index.pq_encode(vectors, books).count() == 256


def test_new_rows_of_one_id_leave_one(spark):
    stock = index.build_flat(frame(spark, RNG.normal(size=(3, DIM))))
    new = frame(spark, RNG.normal(size=(2, DIM)), "row").withColumn("item_id", F.lit(1).cast("long"))
    both = index.add_items(stock, new.select("item_id", "embedding"))
    assert both.count() == 3 and both.where("item_id = 1").count() == 1


def test_reloaded_clustered_index_is_searchable(spark, rows, tmp_path):
    vectors, asked = frame(spark, RNG.normal(size=(30, DIM))), frame(spark, RNG.normal(size=(4, DIM)), "query_id")
    cells, centroids = index.ivf_build(vectors, nlist=4)
    path = str(tmp_path / "index")
    writers.save_index(cells, path, by_cell=True, centroids=centroids)
    again = index.ivf_search(
        writers.load_index(spark, path), writers.load_centroids(spark, path), asked, 5, nprobe=2)
    assert rows(again) == rows(index.ivf_search(cells, centroids, asked, 5, nprobe=2))


def trained(spark, n=300, parts=3, bits=3):
    centers = 3 * RNG.normal(size=(6, DIM))
    x = centers[RNG.integers(0, 6, n)] + 0.4 * RNG.normal(size=(n, DIM))
    vectors = frame(spark, x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    book = semantic_ids.level_of(semantic_ids.fit_codebooks(index.build_flat(vectors), [6], init="first_k"), 0)
    cells = index.nearest_code(index.build_flat(vectors), book, "cell")
    books = index.pq_lloyd_codebooks(index.cell_residuals(cells, book), parts, DIM, bits, iters=3)
    return x, unit, vectors, book, books


def test_part_codebooks_follow_plain_lloyd(spark):
    x = RNG.normal(size=(60, DIM))
    books = {(r.sub, r.code): r.embedding for r in index.pq_lloyd_codebooks(frame(spark, x).repartition(3), 2, DIM, 2, iters=4).collect()}
    for p in range(2):
        part = x[:, 3 * p:3 * p + 3]
        c = part[:4].copy()
        for _ in range(4):
            near = ((part[:, None] - c[None]) ** 2).sum(2).argmin(1)
            c = np.array([part[near == j].mean(0) if (near == j).any() else c[j] for j in range(4)])
        assert np.allclose([books[p, j] for j in range(4)], c)


@pytest.mark.parametrize("nprobe", [2, 6])
def test_coded_search_is_the_distance_to_centroid_plus_codes(spark, nprobe):
    x, unit, vectors, book, books = trained(spark)
    q = RNG.normal(size=(9, DIM))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    coded = {r.item_id: (r.cell, r.codes) for r in index.ivfpq_build(vectors, book, books).collect()}
    center = {r.code: np.array(r.embedding) for r in book.collect()}
    sub = {(r["sub"], r.code): np.array(r.embedding) for r in books.collect()}
    rebuilt = np.array([center[coded[i][0]] + np.concatenate([sub[p, c] for p, c in enumerate(coded[i][1])]) for i in range(len(x))])
    built = index.ivfpq_build(vectors, book, books)
    found = index.ivfpq_search(built, book, books, frame(spark, q, "query_id"), 7, nprobe)
    assert "decode" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r.query_id, r["rank"]): (r.item_id, r.score) for r in found.collect()}
    for i in range(9):
        near = sorted(center, key=lambda c: (round(((q[i] - center[c]) ** 2).sum(), 6), c))[:nprobe]
        order = sorted((round(((q[i] - rebuilt[j]) ** 2).sum(), 6), j) for j in range(len(x)) if coded[j][0] in near)[:7]
        assert [got[i, r + 1][0] for r in range(7)] == [j for _, j in order]
    best = index.rerank_exact(
        index.ivfpq_search(built, book, books, frame(spark, q, "query_id"), 60, 6), vectors, frame(spark, q, "query_id"), 7)
    exact = index.search_flat(index.build_flat(vectors), frame(spark, q, "query_id"), 7)
    assert index.recall_at_k(best, exact).first()["recall"] >= 0.9


def test_nearest_cells_of_a_large_codebook_are_the_same(spark, monkeypatch, rows):
    book = index.local_codebook(spark, np.arange(9), RNG.normal(size=(9, DIM)))
    queries = frame(spark, RNG.normal(size=(20, DIM)), "query_id")
    want = rows(index.nearest_cells(queries, book, 4), "query_id", "cell")
    monkeypatch.setattr(index, "MODEL_CODES", 3)
    assert rows(index.nearest_cells(queries, book, 4), "query_id", "cell") == want and len(want) == 80


def test_an_item_in_several_cells_counts_once_and_only_full_lists_leave_a_task(spark, monkeypatch):
    """Neither queries nor vectors are repeated per block: one row per query and place is given on."""
    x, q = RNG.normal(size=(90, DIM)), RNG.normal(size=(9, DIM))
    vectors, asked = frame(spark, x), frame(spark, q, "query_id")
    cells = vectors.withColumn("cell", F.explode(F.array(F.col("item_id") % 3, F.lit(3), 4 + F.col("item_id") % 2)))
    named = asked.withColumn("cells", F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long")))
    want = {(i, r + 1): int(j) for i in range(9) for r, j in enumerate(np.lexsort((range(90), -np.round(q @ x.T, 6)[i]))[:7])}
    found = index.block_top_k(named, cells, 7, tile=8)
    assert {(r.query_id, r["rank"]): r.item_id for r in found.collect()} == want
    monkeypatch.setattr(blocks, "FILE_ROWS", 20)
    given, top_k = [], blocks.top_k
    monkeypatch.setattr(blocks, "top_k", lambda df, *args, **names: given.append(df) or top_k(df, *args, **names))
    for tables, one in ((named, cells), (asked, vectors)):
        again = index.block_top_k(tables, one, 7, tile=8)
        assert {(r.query_id, r["rank"]): r.item_id for r in again.collect()} == want
    monkeypatch.setattr(blocks, "QUERY_BLOCK", 1)
    given.clear()
    every = [index.block_top_k(asked.unionByName(asked.withColumn("query_id", F.col("query_id") + 100 * n)), vectors, 7, tile=8)
             for n in (1, 2)]
    assert not given and all(df.count() == 18 * 7 for df in every)
