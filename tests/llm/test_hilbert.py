"""The curve visits neighbours, runs are even, and order follows the curve."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfwise.llm import hilbert as H

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_steps_to_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = H.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def documents(n):
    draw = random.Random(n)
    return [(i, draw.choice([None, "", "é" * draw.randrange(50), "x" * draw.randrange(900)]),
             draw.choice([None, "en", "de", "fr"]), draw.choice([None, "src0", "src0", "src1", "src12"])) for i in range(n)]


@pytest.mark.parametrize("n", [0, 3, 8, 1001])
def test_rows_law(spark, n):
    rows = documents(n)
    got = H.shard_report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == n
    for i, text, _, _ in rows:
        data = (text or "").encode()
        assert (by_id[i]["size"], by_id[i]["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    counts = Counter(r["shard"] for r in got)
    assert all(0 <= s < 8 for s in counts)
    sizes = [counts.get(s, 0) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in got)


def test_neighbours_share_shards(spark):
    rows = [(i, "x" * (i % 40), f"l{i % 4}", f"s{i % 10}") for i in range(2000)]
    got = {r["doc_id"]: r["shard"] for r in H.shard_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    langs = [len({rows[i][2] for i in got if got[i] == s}) for s in range(8)]
    assert sum(langs) < 8 * 4  # shards leave values out, so files can be pruned


def test_clashing_columns_repeats_and_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 7, 9), (1, "a", 7, 9), (None, None, 1, 1)] * 5, "id long, kind string, shard int, slot int")
    out = H.hilbert_shards(df, ["kind", "id"], ["id"], n_shards=2)
    assert out.columns == ["id", "kind", "shard", "slot"] and out.count() == 15
    H.write_shards(out, str(tmp_path / "shards"), 2)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 15
