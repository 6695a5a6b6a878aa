import json
import os

from shelfwise.session import scratch_path
from shelfwise.sources import readers, writers


def test_missing_files_are_empty(spark, tmp_path):
    assert readers.read_links(spark, str(tmp_path / "no.csv")).count() == 0
    empty = readers.read_descriptions(spark, str(tmp_path / "no.csv"))
    assert empty.columns == ["title", "description", "genres"] and empty.count() == 0


def test_descriptions_keep_line_breaks_and_quotes(spark, tmp_path, rows):
    path = tmp_path / "d.csv"
    path.write_text('Title,Overview,Genre\n"A","first\nline, ""quoted""","x|y"\n,"no title",z\n')
    assert rows(readers.read_descriptions(spark, str(path))) == [
        ("A", 'first\nline, "quoted"', "x|y"), (None, "no title", "z"),
    ]


def test_piped_items_are_latin1(spark, tmp_path):
    flags = "|".join(["0"] * 18 + ["1"])
    path = tmp_path / "u.item"
    path.write_bytes(f"5|Misérables (1995)|01-Jan-1995||http://x|{flags}\n".encode("latin-1"))
    row = readers.read_items_piped(spark, str(path), ["title", "Western"]).first()
    assert tuple(row) == ("Misérables (1995)", 1)


def test_tsv(spark, tmp_path):
    path = tmp_path / "u.data"
    path.write_text("196\t242\t3\t881250949\n")
    assert tuple(readers.read_interactions_tsv(spark, str(path)).first()) == (196, 242, 3.0, 881250949)


def test_served_rows_are_cut_per_key(spark, rows):
    df = spark.createDataFrame([(1, i, float(i % 3)) for i in range(5)],
                               "user_id long, item_id long, score double")
    best = readers.best_rows(df, "user_recommendations", 3)
    assert rows(best, "rank", "item_id") == [(1, 2), (2, 1), (3, 4)]


def test_json_records(spark):
    df = spark.createDataFrame([("m", 2, 7, 0.5), ("m", 1, 9, 0.9)],
                               "method string, rank long, item_id long, score double")
    path = scratch_path(spark, "json")
    writers.write_recommendations_json(df, path, ["method"])
    lines = [json.loads(l) for f in os.listdir(path) if f.endswith(".json")
             for l in open(os.path.join(path, f))]
    assert lines == [{"method": "m", "top_k": [9, 7], "scores": [0.9, 0.5]}]
