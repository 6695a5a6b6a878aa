"""Queries of the semantic ids and their quality measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.draws import normal_sql
from shelfwise.operators import id_quality as quality
from shelfwise.operators import semantic_ids as sids
from shelfwise.operators.ordering import rounded
from shelfwise.operators.vector_index import first_k_codebook
from shelfwise.plans.catalog import query
from shelfwise.plans.search import sq_sql
from shelfwise.plans.views import SIZES, STEPS, Views

LAST = STEPS
K0, K1 = SIZES


def cells(df: DataFrame, *keys: str, vec: str = "embedding") -> DataFrame:
    """One row per key and dimension, rounded."""
    return df.select(*keys, F.posexplode(vec).alias("dim", "x")).select(
        *keys, F.col("dim").cast("bigint").alias("dim"), rounded("x").alias("x")
    )


CELLS = """CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS dim,
      round(unnest(embedding), 6) AS x"""


@query(
    "i01_fit_codebooks",
    f"""SELECT CAST(0 AS BIGINT) AS level, code, {CELLS} FROM v_book0_{LAST}
        UNION ALL SELECT CAST(1 AS BIGINT), code, {CELLS} FROM v_book1_{LAST}""",
)
def codebooks(v: Views) -> DataFrame:
    return cells(v.codebooks, "level", "code")


@query("i01_fit_codebooks_kmeans")
def codebooks_kmeans(v: Views) -> DataFrame:
    return cells(sids.fit_codebooks(v.vectors, SIZES, init="kmeans"), "level", "code")


@query("i02_assign_codes", "SELECT item_id, code FROM v_near0_0")
def assigned(v: Views) -> DataFrame:
    book = first_k_codebook(v.vectors, K0)
    return sids.assign_codes(v.vectors, book).select("item_id", "code")


@query(
    "i03_residual_quantize",
    f"""SELECT i.item_id, c0, c1, round(list_dot_product(r1.embedding, r1.embedding), 6)
          AS after_first, round(list_dot_product(r2.embedding, r2.embedding), 6) AS after_second,
          round(list_sum(q.embedding), 6) AS quantized_sum
        FROM v_ids i JOIN v_res1 r1 USING (item_id) JOIN v_res2 r2 USING (item_id)
        JOIN v_rebuilt q USING (item_id)""",
)
def quantized(v: Views) -> DataFrame:
    from shelfwise.functions.vectors import dot

    total = F.aggregate("quantized", F.lit(0.0), lambda a, x: a + x)
    inner = F.col("inputs")[1]
    return v.quantized.select(
        "item_id", F.col("codes")[0].alias("c0"), F.col("codes")[1].alias("c1"),
        rounded(dot(inner, inner)).alias("after_first"),
        rounded(dot("residual", "residual")).alias("after_second"),
        rounded(total).alias("quantized_sum"),
    )


@query("i04_reconstruct", f"SELECT item_id, {CELLS} FROM v_rebuilt")
def rebuilt(v: Views) -> DataFrame:
    return cells(sids.reconstruct(v.codes, v.codebooks, len(SIZES)), "item_id")


@query(
    "i05_assign_semantic_ids",
    """SELECT item_id, title, leaf_id, c0 || ',' || c1 AS semantic_id,
         c0 || ',' || c1 || ',' || leaf_id AS final_id FROM (
         SELECT item_id, title, c0, c1, row_number() OVER (PARTITION BY c0, c1
           ORDER BY title NULLS LAST, item_id) - 1 AS leaf_id
         FROM v_ids JOIN v_items USING (item_id))""",
)
def named(v: Views) -> DataFrame:
    def joined(col: str):
        return F.array_join(F.col(col).cast("array<string>"), ",").alias(col)

    return v.semantic_ids.select(
        "item_id", "title", "leaf_id", joined("semantic_id"), joined("final_id")
    )


HIST = """v_hist AS (SELECT level, code, count(*) AS items FROM v_levels GROUP BY ALL),
    v_sized AS (SELECT *, CASE WHEN level = 0 THEN {k0} ELSE {k1} END AS k FROM v_hist)""".format(
    k0=K0, k1=K1
)
USAGE_SQL = f"""WITH {HIST} SELECT level, count(*) AS used, min(items) AS min_items,
      max(items) AS max_items, round(avg(items), 6) AS mean_items,
      round(count(*) * CAST(100 AS DOUBLE) / any_value(k), 6) AS used_pct,
      round(count(*) * CAST(100 AS DOUBLE) / any_value(k), 6) < 80 AS low_usage
    FROM v_sized GROUP BY level"""


@query("i06_codebook_usage", USAGE_SQL)
def usage(v: Views) -> DataFrame:
    return quality.codebook_usage(v.ids, SIZES)


@query("i07_code_histogram", f"WITH {HIST} SELECT * FROM v_hist")
def histogram(v: Views) -> DataFrame:
    return quality.code_histogram(v.ids)


ENTROPY = HIST + """, v_p AS (SELECT level, k, items / sum(items) OVER (PARTITION BY level) AS p
      FROM v_sized),
    v_h AS (SELECT level, any_value(k) AS k, -sum(p * ln(p)) AS h FROM v_p GROUP BY level)"""


@query("i08_code_perplexity", f"WITH {ENTROPY} SELECT level, round(exp(h), 6) AS perplexity FROM v_h")
def perplexity(v: Views) -> DataFrame:
    return quality.code_perplexity(v.ids)


@query(
    "i09_usage_imbalance",
    f"""WITH {ENTROPY} SELECT level, round(1 - h / ln(k), 6) AS imbalance,
          round((ln(k) - h) * (ln(k) - h), 6) AS diversity_loss FROM v_h""",
)
def imbalance(v: Views) -> DataFrame:
    return quality.usage_imbalance(v.ids, SIZES)


@query(
    "i10_collapse_check",
    f"""WITH {HIST} SELECT round(min(share), 6) AS min_usage, round(min(share), 6) < 0.05 AS collapsed
        FROM (SELECT count(*) / any_value(k) AS share FROM v_sized GROUP BY level)""",
)
def collapse(v: Views) -> DataFrame:
    return quality.collapse_check(v.ids, SIZES)


@query(
    "i11_quantization_loss",
    """SELECT CAST(0 AS BIGINT) AS level, round(1.5e0 * sum(list_dot_product(embedding, embedding))
         / sum(len(embedding)), 6) AS loss FROM v_res1
       UNION ALL SELECT CAST(1 AS BIGINT), round(1.5e0 * sum(list_dot_product(embedding, embedding))
         / sum(len(embedding)), 6) FROM v_res2
       UNION ALL SELECT CAST(-1 AS BIGINT), round(1e-2 * sum(list_dot_product(embedding, embedding))
         / sum(len(embedding)), 6) FROM v_res2""",
)
def loss(v: Views) -> DataFrame:
    return sids.quantization_loss(v.quantized, v.codebooks, len(SIZES))


@query(
    "i12_variance_penalty",
    """SELECT round((avg(s) - 1) * (avg(s) - 1), 6) AS penalty FROM (
         SELECT dim, stddev_samp(x) AS s FROM (SELECT unnest(embedding) AS x,
           generate_subscripts(embedding, 1) AS dim FROM v_vectors) GROUP BY dim)""",
)
def variance(v: Views) -> DataFrame:
    return sids.variance_penalty(v.vectors)


@query(
    "i13_ema_update",
    """WITH v_sum AS (SELECT code, dim, sum(x) AS s FROM (
           SELECT n.code, unnest(v.embedding) AS x, generate_subscripts(v.embedding, 1) AS dim
           FROM v_near0_0 n JOIN v_vectors v USING (item_id)) GROUP BY ALL),
         v_n AS (SELECT code, count(*) AS n FROM v_near0_0 GROUP BY code),
         v_size AS (SELECT b.code, 0.9e0 * 1 + coalesce(n, 0) * (1 - 0.9e0) AS cs
           FROM v_book0_0 b LEFT JOIN v_n USING (code)),
         v_smooth AS (SELECT code, cs, (cs + 1e-5) / (sum(cs) OVER () + count(*) OVER () * 1e-5)
           * sum(cs) OVER () AS size FROM v_size),
         v_avg AS (SELECT c.code, c.dim, 0.9e0 * c.x + (1 - 0.9e0) * coalesce(s.s, 0.0) AS a FROM (
             SELECT code, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim
             FROM v_book0_0) c LEFT JOIN v_sum s ON s.code = c.code AND s.dim = c.dim)
       SELECT a.code, CAST(a.dim - 1 AS BIGINT) AS dim, round(cs, 6) AS cluster_size,
         round(a / size, 6) AS x FROM v_avg a JOIN v_smooth USING (code)""",
)
def ema(v: Views) -> DataFrame:
    book = first_k_codebook(v.vectors, K0)
    start = book.select(
        "code", "embedding", F.lit(1.0).alias("cluster_size"), F.col("embedding").alias("embed_avg")
    )
    moved = sids.ema_update(start, sids.assign_codes(v.vectors, book))
    return cells(moved, "code", "cluster_size").withColumn("cluster_size", rounded("cluster_size"))


@query(
    "i14_usage_ema",
    f"""SELECT b.code, round(0.99e0 / {K0} + (1 - 0.99e0) * coalesce(n, 0)
          / (SELECT count(*) FROM v_near0_0), 6) AS usage
        FROM v_book0_0 b LEFT JOIN (SELECT code, count(*) AS n FROM v_near0_0 GROUP BY code)
        USING (code)""",
)
def smoothed(v: Views) -> DataFrame:
    book = first_k_codebook(v.vectors, K0)
    start = book.select("code", F.lit(1.0 / K0).alias("usage"))
    moved = sids.usage_ema(start, sids.assign_codes(v.vectors, book))
    return moved.select("code", rounded("usage").alias("usage"))


DEAD_BELOW = 30


@query(
    "i15_reset_dead_codes",
    f"""WITH v_m AS (SELECT b.code, b.embedding, coalesce(n, 0) < {DEAD_BELOW} AS dead
          FROM v_book0_0 b LEFT JOIN (SELECT code, count(*) AS n FROM v_near0_0 GROUP BY code)
          USING (code)),
        v_live AS (SELECT row_number() OVER (ORDER BY code) - 1 AS place, embedding FROM v_m
          WHERE NOT dead),
        v_new AS (SELECT m.code, m.dead, CASE WHEN m.dead THEN coalesce(l.embedding, m.embedding)
            ELSE m.embedding END AS embedding FROM v_m m LEFT JOIN v_live l
          ON l.place = (m.code * 7919 + 42) % greatest((SELECT count(*) FROM v_live), 1))
        SELECT code, dead, {CELLS} FROM v_new""",
)
def revived(v: Views) -> DataFrame:
    book = first_k_codebook(v.vectors, K0)
    used = sids.assign_codes(v.vectors, book).groupBy("code").agg(F.count("*").alias("used"))
    fresh = sids.reset_dead_codes(book, used, threshold=DEAD_BELOW, noise=0)
    return cells(fresh, "code", "dead")


@query(
    "i15_reset_with_noise",
    f"""WITH v_m AS (SELECT b.code, b.embedding, coalesce(n, 0) AS n FROM v_book0_0 b LEFT JOIN
          (SELECT code, count(*) AS n FROM v_near0_0 GROUP BY code) USING (code)),
        v_live AS (SELECT row_number() OVER (ORDER BY code) - 1 AS place, embedding FROM v_m
          WHERE n >= {DEAD_BELOW}),
        v_new AS (SELECT m.code, m.n, m.n < {DEAD_BELOW} AS dead,
            m.n < {DEAD_BELOW} AND l.embedding IS NOT NULL AS revived,
            CASE WHEN m.n < {DEAD_BELOW} THEN coalesce(l.embedding, m.embedding) ELSE m.embedding
            END AS embedding FROM v_m m LEFT JOIN v_live l
          ON l.place = (m.code * 7919 + 42) % greatest((SELECT count(*) FROM v_live), 1)),
        v_x AS (SELECT code, n, dead, revived, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT)
            AS dim, unnest(embedding) AS x FROM v_new),
        v_y AS (SELECT code, dead, dim, CASE WHEN revived THEN 1.0e0 ELSE CAST(n AS DOUBLE) END AS size,
            CASE WHEN revived THEN x + 0.01e0 * {normal_sql(42, "code", "dim")} ELSE x END AS y FROM v_x)
        SELECT code, dead, dim, round(y, 6) AS x, size AS cluster_size, round(y * size, 6) AS total
        FROM v_y""",
)
def revived_with_noise(v: Views) -> DataFrame:
    book = first_k_codebook(v.vectors, K0)
    used = sids.assign_codes(v.vectors, book).groupBy("code").agg(F.count("*").alias("used"))
    fresh = sids.reset_dead_codes(book, used, threshold=DEAD_BELOW)
    both = F.arrays_zip(F.col("embedding").alias("x"), F.col("embed_avg").alias("total"))
    return fresh.select("code", "dead", "cluster_size", F.posexplode(both).alias("dim", "_b")).select(
        "code", "dead", F.col("dim").cast("bigint").alias("dim"), "cluster_size",
        rounded("_b.x").alias("x"), rounded("_b.total").alias("total"),
    )


def rebuilt_pairs(v: Views) -> DataFrame:
    return v.quantized.select("item_id", "embedding", F.col("quantized").alias("rebuilt"))


RECON_SQL = """SELECT round(avg((x - y) * (x - y)), 6) AS mse,
      (SELECT round(avg(list_dot_product(v.embedding, r.embedding) / sqrt(
         list_dot_product(v.embedding, v.embedding) * list_dot_product(r.embedding, r.embedding))),
         6) FROM v_vectors v JOIN v_rebuilt r USING (item_id)) AS cosine,
      round(corr(x, y), 6) AS correlation
    FROM (SELECT unnest(v.embedding) AS x, unnest(r.embedding) AS y
          FROM v_vectors v JOIN v_rebuilt r USING (item_id))"""


@query("i16_reconstruction_metrics", RECON_SQL)
def reconstruction(v: Views) -> DataFrame:
    return quality.reconstruction_metrics(rebuilt_pairs(v))


def silhouette_sql(label: str) -> str:
    return f"""WITH v_pt AS (SELECT item_id, {label} AS l, embedding FROM v_ids
          JOIN v_vectors USING (item_id)),
        v_n AS (SELECT l, count(*) AS n FROM v_pt GROUP BY l),
        v_d AS (SELECT a.item_id, a.l, b.l AS o,
            sum(sqrt({sq_sql('a.embedding', 'b.embedding')})) AS d
          FROM v_pt a JOIN v_pt b ON a.item_id <> b.item_id GROUP BY ALL),
        v_ab AS (SELECT p.item_id, any_value(own.n) AS n,
            max(CASE WHEN d.o = p.l THEN d.d / (own.n - 1) END) AS a,
            min(CASE WHEN d.o <> p.l THEN d.d / oth.n END) AS b
          FROM v_pt p JOIN v_n own ON own.l = p.l JOIN v_d d ON d.item_id = p.item_id
          JOIN v_n oth ON oth.l = d.o GROUP BY p.item_id)
        SELECT round(CASE WHEN (SELECT count(*) FROM v_n) < 2 THEN -1.0e0 ELSE
          avg(CASE WHEN n = 1 THEN 0.0e0 ELSE (b - a) / greatest(a, b) END) END, 6) AS silhouette
        FROM v_ab"""


def coded_points(v: Views) -> DataFrame:
    """Vectors with the first code and the two-level prefix as labels."""
    codes = F.col("codes")
    return v.quantized.select(
        "item_id", "embedding", codes[0].alias("first"), (codes[0] * K1 + codes[1]).alias("prefix")
    )


@query("i17_silhouette_first", silhouette_sql("c0"))
def silhouette_first(v: Views) -> DataFrame:
    return quality.silhouette(coded_points(v), "first")


@query("i17_silhouette_near", silhouette_sql(f"c0 * {K1} + c1"))
def silhouette_near(v: Views) -> DataFrame:
    """By the bounds, however small the table is."""
    return quality.silhouette(coded_points(v), "prefix", whole=0)


@query("i17_silhouette_prefix", silhouette_sql(f"c0 * {K1} + c1"))
def silhouette_prefix(v: Views) -> DataFrame:
    return quality.silhouette(coded_points(v), "prefix")


@query(
    "i18_calinski_harabasz",
    """WITH v_x AS (SELECT c0 AS l, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim
           FROM v_ids JOIN v_vectors USING (item_id)),
         v_c AS (SELECT *, avg(x) OVER (PARTITION BY l, dim) AS m, avg(x) OVER (PARTITION BY dim)
           AS g FROM v_x)
       SELECT round((sum((m - g) * (m - g)) / (count(DISTINCT l) - 1)) / (sum((x - m) * (x - m)) /
         ((SELECT count(*) FROM v_ids) - count(DISTINCT l))), 6) AS calinski_harabasz FROM v_c""",
)
def calinski(v: Views) -> DataFrame:
    return quality.calinski_harabasz(coded_points(v), "first")


PAIRS_SQL = """v_pairs AS (SELECT a.item_id AS item_a, a.item_id + 1 AS item_b,
      CASE WHEN a.label = b.label THEN 'high' ELSE 'low' END AS expected
      FROM v_vectors a LEFT JOIN v_vectors b ON b.item_id = a.item_id + 1),
    v_match AS (SELECT p.*, round((CASE WHEN a.c0 = b.c0 THEN 1 ELSE 0 END
        + CASE WHEN a.c1 = b.c1 THEN 1 ELSE 0 END) / 2, 6) AS m, a.c0 IS NOT NULL AND
        b.c0 IS NOT NULL AS known FROM v_pairs p LEFT JOIN v_ids a ON a.item_id = item_a
      LEFT JOIN v_ids b ON b.item_id = item_b)"""


def neighbour_pairs(v: Views) -> DataFrame:
    """Every item with the next id; expected to match when the labels are equal."""
    a = v.vectors.select(
        F.col("item_id").alias("item_a"), (F.col("item_id") + 1).alias("item_b"),
        F.col("label").alias("_la"),
    )
    b = v.vectors.select(F.col("item_id").alias("item_b"), F.col("label").alias("_lb"))
    expected = F.when(F.col("_la") == F.col("_lb"), "high").otherwise("low")
    return a.join(b, "item_b", "left").select("item_a", "item_b", expected.alias("expected"))


@query(
    "i19_id_match",
    f"""WITH {PAIRS_SQL} SELECT item_a, item_b, expected, CASE WHEN known THEN m END AS match
        FROM v_match""",
)
def matches(v: Views) -> DataFrame:
    return quality.id_match(neighbour_pairs(v), v.ids)


COHERENCE_SQL = f"""WITH {PAIRS_SQL} SELECT count(*) AS pairs, count(*) FILTER (
      (expected = 'high' AND m >= 0.5) OR (expected = 'low' AND m < 0.5)) AS passed,
      round(count(*) FILTER ((expected = 'high' AND m >= 0.5) OR (expected = 'low' AND m < 0.5))
        / count(*), 6) AS pass_rate FROM v_match WHERE known"""


@query("i20_coherence", COHERENCE_SQL)
def coherent(v: Views) -> DataFrame:
    return quality.coherence(neighbour_pairs(v), v.ids)


@query(
    "i21_id_report",
    f"""WITH v_r AS (SELECT 'reconstruction' AS measure, cosine AS value, 0.9 AS good, 0.8 AS fair
          FROM ({RECON_SQL}) UNION ALL
        SELECT 'silhouette', silhouette, 0.4, 0.3 FROM ({silhouette_sql('c0')}) UNION ALL
        SELECT 'coherence', pass_rate, 0.8, 0.6 FROM ({COHERENCE_SQL})),
        v_g AS (SELECT measure, value, CASE WHEN value > good THEN 'good' WHEN value > fair
          THEN 'acceptable' ELSE 'poor' END AS grade FROM v_r)
        SELECT *, (SELECT count(*) FROM v_g WHERE grade = 'poor') = 0 AS overall_pass FROM v_g""",
)
def report(v: Views) -> DataFrame:
    return quality.id_report(reconstruction(v), silhouette_first(v), coherent(v))


@query(
    "i22_id_counts",
    """SELECT CAST(sum(n) AS BIGINT) AS items, count(*) AS distinct_ids,
         round(count(*) * CAST(100 AS DOUBLE) / sum(n), 6) AS unique_pct,
         round(sum(n) / count(*), 6) AS mean_items
         FROM (SELECT c0, c1, count(*) AS n FROM v_ids GROUP BY ALL)""",
)
def counted(v: Views) -> DataFrame:
    return quality.id_counts(v.ids)


LARGEST = """v_big AS (SELECT c0, c1, count(*) AS members FROM v_ids GROUP BY ALL
      ORDER BY members DESC, c0, c1 LIMIT 1)"""


@query(
    "i23_largest_group",
    f"""WITH {LARGEST} SELECT i.item_id, t.title FROM v_ids i JOIN v_big b ON b.c0 = i.c0
          AND b.c1 = i.c1 JOIN v_items t USING (item_id)""",
)
def largest(v: Views) -> DataFrame:
    return quality.largest_group_members(v.ids, v.items).select("item_id", "title")


@query(
    "i23_largest_group_genres",
    f"""WITH {LARGEST} SELECT genre, count(*) AS items, row_number() OVER
          (ORDER BY count(*) DESC, genre) AS rank FROM (
          SELECT unnest(t.genres) AS genre FROM v_ids i JOIN v_big b ON b.c0 = i.c0
            AND b.c1 = i.c1 JOIN v_items t USING (item_id)) GROUP BY genre QUALIFY rank <= 10""",
)
def largest_genres(v: Views) -> DataFrame:
    return quality.largest_group_genres(v.ids, v.items)


def _stats_sql(level: int) -> str:
    return f"""SELECT CAST({level} AS BIGINT) AS level, round(avg(x), 6) AS mean,
      round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max
      FROM (SELECT unnest(embedding) AS x FROM v_res{level})"""


@query("i24_vector_stats", " UNION ALL ".join(_stats_sql(i) for i in range(3)))
def stats(v: Views) -> DataFrame:
    """What each level quantizes, and what is left at the end."""
    inputs = v.quantized.select("item_id", F.array_append("inputs", F.col("residual")).alias("all"))
    rows = None
    for level in range(len(SIZES) + 1):
        vectors = inputs.select(F.col("all")[level].alias("embedding"))
        row = quality.vector_stats(vectors).select(F.lit(level).cast("bigint").alias("level"), "*")
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query(
    "i24_mean_pair_distance",
    f"""WITH v_f AS (SELECT * FROM v_vectors ORDER BY item_id LIMIT 100)
        SELECT round(avg(sqrt({sq_sql('a.embedding', 'b.embedding')})), 6) AS mean_distance
        FROM v_f a CROSS JOIN v_f b""",
)
def pair_distance(v: Views) -> DataFrame:
    return quality.mean_pair_distance(v.vectors, 100)
