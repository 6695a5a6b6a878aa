import pytest
from pyspark.sql import functions as F

from shelfwise.functions import checks, text
from shelfwise.functions import vectors as V


def one(df):
    return df.first()[0]


@pytest.mark.parametrize(
    "title, clean",
    [
        ("Heat (1995)", "Heat"),
        ("Lost (2004-2010) ", "Lost"),
        ("1984 (1984)", "1984"),
        ("Brazil (1885)", "Brazil (1885)"),
        ("Se7en", "Se7en"),
        ("Two (1999) (2001)", "Two (1999)"),
    ],
)
def test_clean_title(spark, title, clean):
    df = spark.createDataFrame([(title,)], "title string")
    assert one(df.select(text.clean_title("title"))) == clean


def test_null_texts(spark):
    df = spark.createDataFrame([(None, None, None)], "t string, g string, d string")
    row = df.select(
        text.content_text("t", "g").alias("c"), text.item_blob("t", "g", "d").alias("b"),
        text.split_genres("g").alias("s"),
    ).first()
    assert (row.c, row.b, row.s) == (" ", ". . ", [])


def test_title_word_is_literal(spark, rows):
    df = spark.createDataFrame([(1, "The C.T. Story"), (2, "The CAT story"), (3, None)],
                               "id int, title string")
    assert rows(text.title_has_word(df, "c.t"), "id") == [(1,)]
    assert rows(text.title_starts_with(df, "The"), "id") == [(1,), (2,)]
    assert rows(text.with_title(df), "id") == [(1,), (2,)]


def test_parse_event_time(spark, rows):
    df = spark.createDataFrame([(1, "86400"), (2, "x"), (3, None)], "id int, timestamp string")
    parsed = text.parse_event_time(df).select("id", F.unix_micros("ts"))
    assert rows(parsed) == [(1, 86_400_000_000)]
    written = spark.createDataFrame([(1, "1970-01-02 00:00:00"), (2, "no")], "id int, timestamp string")
    parsed = text.parse_event_time(written, unit=None).select("id", F.unix_micros("ts"))
    assert rows(parsed) == [(1, 86_400_000_000)]


def test_genre_flags(spark):
    flags = {g: 0 for g in text.GENRE_FLAGS} | {"Action": 1, "Sci-Fi": 1}
    df = spark.createDataFrame([(7, *flags.values())], ["item_id", *flags])
    assert text.genre_flags_to_array(df).first()["genres"] == ["Action", "Sci-Fi"]


def test_vector_edge_cases(spark):
    df = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0])], "z array<double>, v array<double>")
    row = df.select(
        V.cosine("z", "v").alias("c"), V.l2_normalize("z").alias("z"),
        V.l2_normalize("v").alias("n"), V.sq_l2("z", "v").alias("d"), V.dot("v", "v").alias("p"),
    ).first()
    assert row.c == 0.0 and row.z == [0.0, 0.0] and row.n == [0.6, 0.8]
    assert row.d == 25.0 and row.p == 25.0


def test_jaccard(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])],
                               "a array<string>, b array<string>")
    assert [r[0] for r in df.select(V.jaccard("a", "b")).collect()] == [1 / 3, 0.0]


def test_mean_vectors_both_ways(spark, rows):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 6.0]), (2, [5.0, 5.0])],
                               "k int, embedding array<double>")
    want = [(1, (2.0, 4.0)), (2, (5.0, 5.0))]
    assert rows(V.mean_vectors(df, "k")) == want
    assert rows(V.mean_vectors(df, "k", dim=2)) == want


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert checks.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="missing columns: c, d"):
        checks.require_columns(df, ["d", "a", "c"])
    assert checks.resolve_column(df, ["x", "b"]) == "b"
    with pytest.raises(ValueError):
        checks.resolve_column(df, ["x"])


def test_vector_checks(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "item_id int, embedding array<double>")
    with pytest.raises(ValueError, match="1 vectors do not have 2"):
        checks.vector_dim_check(df, 2)
    ids = spark.createDataFrame([(1,), (3,)], "item_id int")
    with pytest.raises(ValueError):
        checks.id_vector_alignment(ids, df)
    assert checks.id_vector_alignment(df.select("item_id"), df) is df
