"""Each stage of the pipeline against its operator's rule, and the registry."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from shelfwise.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(seed, n=60):
    import random

    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    item = text("item", 30)
    docs = [(i, text(i), "en", "src0", 1) for i in range(40)]
    docs += [(100 + i, text(i), "en", "src1", 1) for i in range(5)]                # exact copies
    docs += [(200 + i, text(i) + " end", "en", "src1", 1) for i in range(5)]       # near copies
    docs += [(300, text(77, 20) + " " + item + " " + text(78, 20), "en", "s", 1)]  # a benchmark passage
    docs += [(400, None, "en", None, None), (401, "", None, "s", 0), (402, "12 !!", "en", "s", 5)]
    docs += [(None, text("none"), "en", "s", 1), (None, text("none"), "en", "s", 1), (39, text(39), "en", "src0", 1)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, folder)
        if name != "shards":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = sorted((r["doc_id"] for r in docs.collect()), key=str)
    assert not {400, 401, 402} & set(kept["language"]) and len(kept["language"]) == 54
    clean = [*range(40), 300, None, None]
    assert kept["near_copies"] == sorted(clean, key=str)
    assert kept["benchmark_overlap"] == sorted((x for x in clean if x != 300), key=str)
    assert kept["mix"] == kept["benchmark_overlap"] == kept["shards"]
    assert C.run(spark, folder).count() == len(kept["shards"])


def test_an_empty_table_passes_through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_registry():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in QUERIES) == 1 for n in names) and len(QUERIES) == 13
    assert QUERIES.items() <= entry.queries().items() and "pipeline" in entry.queries()
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = sorted(d[0] for d in cursor.description)
    at = [[d[0] for d in cursor.description].index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=str)
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == columns
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=str) == want
