import os

import numpy as np

from shelfwise.operators import live_index as live
from shelfwise.operators import vector_index as index
from shelfwise.session import scratch_path, stored
from shelfwise.streaming import jobs

RNG = np.random.default_rng(11)
DIM = 5
SCHEMA = "item_id long, embedding array<double>"


def frame(spark, vectors, key="item_id"):
    data = [(i, None if x is None else [float(t) for t in x]) for i, x in vectors]
    return spark.createDataFrame(data, f"{key} long, embedding array<double>")


def started(spark, x):
    path = scratch_path(spark, "live")
    cells, centroids = index.ivf_build(frame(spark, enumerate(x)), nlist=6)
    centroids = index.settle_codebook(centroids)
    live.create_live(cells, path)
    return path, centroids


def unit(x):
    return np.asarray(x) / np.linalg.norm(x)


def answer(spark, path, centroids, queries):
    found = live.search_live(path, centroids, queries, 7, nprobe=3)
    return sorted((r.query_id, r["rank"], r.item_id, r.score) for r in found.collect())


def rebuilt(spark, state, centroids, queries):
    cells, _ = index.ivf_build(frame(spark, state.items()), centroids=centroids)
    found = index.ivf_search(cells, centroids, queries, 7, nprobe=3)
    return sorted((r.query_id, r["rank"], r.item_id, r.score) for r in found.collect())


def folders(path):
    return {d for d in os.listdir(path) if d.startswith("cell=")}


def test_changes_and_compactions_answer_like_an_index_built_anew(spark):
    x = RNG.normal(size=(60, DIM))
    path, centroids = started(spark, x)
    queries = frame(spark, enumerate(RNG.normal(size=(9, DIM))), "query_id")
    state = dict(enumerate(x))
    batches = [
        [(3, -x[3]), (100, RNG.normal(size=DIM)), (5, None), (999, None)],
        [(5, x[7]), (100, None), (8, RNG.normal(size=DIM))],
        [(i, None) for i in range(20, 40)] + [(101, x[1])],
    ]
    for number, batch in enumerate(batches):
        live.add_changes(frame(spark, batch), path, number, centroids)
        for i, v in batch:
            if v is None:
                state.pop(i, None)
            else:
                state[i] = v
        want = rebuilt(spark, state, centroids, queries)
        assert answer(spark, path, centroids, queries) == want
        if number != 1:
            assert live.compact(spark, path)
            assert answer(spark, path, centroids, queries) == want
    got = {r.item_id: np.array(r.embedding) for r in live.live_rows(spark, path).collect()}
    assert got.keys() == state.keys()
    assert all(np.allclose(got[i], unit(state[i])) for i in state)
    assert live.compact(spark, path) == []


def test_only_touched_cells_are_written(spark):
    x = RNG.normal(size=(80, DIM))
    path, centroids = started(spark, x)
    homes = {r.item_id: r.cell for r in live.live_rows(spark, path).collect()}
    live.remove_items(spark.createDataFrame([(4,), (None,)], "item_id long"), path, 0)
    live.add_changes(frame(spark, [(9, x[10])]), path, 1, centroids)
    touched = {homes[4], homes[9], homes[10]}
    before = {d: os.listdir(f"{path}/base/version=0/{d}") for d in folders(f"{path}/base/version=0")}
    assert live.compact(spark, path) == sorted(touched)
    assert folders(f"{path}/base/version=1") <= {f"cell={c}" for c in touched}
    assert before == {d: os.listdir(f"{path}/base/version=0/{d}") for d in folders(f"{path}/base/version=0")}
    assert live.live_rows(spark, path).count() == 79


def test_unfinished_and_repeated_steps(spark):
    """A compaction that wrote cells but no state changes nothing; batches may be written again."""
    x = RNG.normal(size=(30, DIM))
    path, centroids = started(spark, x)
    change = frame(spark, [(2, -x[2]), (2, -x[2]), (None, x[1]), (50, x[0])])
    live.add_changes(change, path, 0, centroids)
    want = sorted((r.item_id, r.cell) for r in live.live_rows(spark, path).collect())
    live._write_cells(live.live_rows(spark, path).limit(3), path, 1)
    assert sorted((r.item_id, r.cell) for r in live.live_rows(spark, path).collect()) == want
    live.compact(spark, path)
    live.add_changes(change, path, 0, centroids)
    assert sorted((r.item_id, r.cell) for r in live.live_rows(spark, path).collect()) == want
    assert live.compact(spark, path) == []


def test_empty_index_and_everything_removed(spark):
    path = scratch_path(spark, "live")
    centroids = index.local_codebook(spark, np.arange(2), np.eye(2))
    queries = frame(spark, [(0, [1.0, 0.2])], "query_id")
    live.create_live(spark.createDataFrame([], SCHEMA + ", cell long"), path)
    assert answer(spark, path, centroids, queries) == []
    live.add_changes(frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 2.0])]), path, 0, centroids)
    assert len(answer(spark, path, centroids, queries)) == 2
    assert live.compact(spark, path) == [0, 1]
    live.remove_items(spark.createDataFrame([(1,), (2,)], "item_id long"), path, 1)
    assert answer(spark, path, centroids, queries) == []
    assert live.compact(spark, path) == [0, 1]
    assert answer(spark, path, centroids, queries) == []


def test_only_probed_folders_are_read(spark):
    x = RNG.normal(size=(80, DIM))
    path, centroids = started(spark, x)
    one = stored(spark.createDataFrame([(0,)], "cell long"), "cells")
    rows = live.live_rows(spark, path, one)
    assert {r.cell for r in rows.collect()} == {0}
    assert "dynamicpruning" in rows._jdf.queryExecution().toString()


def test_stream_feeds_a_live_index(spark):
    x = RNG.normal(size=(12, DIM))
    path, centroids = started(spark, x)
    source, state = scratch_path(spark, "arrivals"), scratch_path(spark, "state")
    for batch in ([(1, -x[1]), (2, None)], [(2, x[3]), (40, x[4])]):
        frame(spark, batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        jobs.stream_live_changes(stream, path, state, centroids).awaitTermination()
    got = {r.item_id: np.array(r.embedding) for r in live.live_rows(spark, path).collect()}
    assert got.keys() == set(range(12)) | {40}
    assert np.allclose(got[1], unit(-x[1])) and np.allclose(got[2], unit(x[3]))
