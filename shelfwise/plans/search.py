"""Queries of the vector indexes. The query vectors are all user profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import vectors as V
from shelfwise.functions.draws import normal_sql
from shelfwise.operators import live_index
from shelfwise.operators import vector_index as index
from shelfwise.operators.ordering import rounded
from shelfwise.plans.catalog import query
from shelfwise.plans.views import DIM, PARTS, STEPS, Views
from shelfwise.session import scratch_path, stored
from shelfwise.sources import writers

PROBES = 4

FLAT_SQL = """v_flat AS (SELECT q.query_id, u.item_id,
      round(list_dot_product(q.embedding, u.embedding), 6) AS score, row_number() OVER
      (PARTITION BY q.query_id ORDER BY round(list_dot_product(q.embedding, u.embedding), 6) DESC,
       u.item_id) AS rank FROM v_queries q CROSS JOIN v_unit u)"""


@query(
    "h01_build_flat",
    """SELECT item_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS dim,
         round(unnest(embedding), 6) AS x FROM v_unit""",
)
def flat(v: Views) -> DataFrame:
    built = index.build_flat(v.vectors, DIM)
    return built.select("item_id", F.posexplode("embedding").alias("dim", "x")).select(
        "item_id", F.col("dim").cast("bigint").alias("dim"), rounded("x").alias("x")
    )


@query("h02_search_flat", f"WITH {FLAT_SQL} SELECT * FROM v_flat WHERE rank <= 50")
def flat_search(v: Views) -> DataFrame:
    return index.search_flat(v.unit, v.profile_queries, 50)


def sq_sql(a: str, b: str) -> str:
    return (f"list_sum(list_transform(list_zip({a}, {b}), "
            "lambda p: (p[1] - p[2]) * (p[1] - p[2])))")


@query(
    "h03_search_by_item",
    f"""SELECT request_id, seed_item_id, item_id, round(d, 6) AS distance, row_number() OVER
          (PARTITION BY request_id ORDER BY round(d, 6), item_id) AS rank FROM (
          SELECT r.request_id, r.seed_item_id, x.item_id,
            {sq_sql('s.embedding', 'x.embedding')} AS d
          FROM v_requests r JOIN v_unit s ON s.item_id = r.seed_item_id CROSS JOIN v_unit x)
        QUALIFY rank <= 20""",
)
def by_item(v: Views) -> DataFrame:
    return index.search_by_item(v.unit, v.requests, 20)


CELL_SQL = f"""v_cent AS (SELECT code, embedding FROM v_bookU_{STEPS}),
    v_cell AS (SELECT item_id, code AS cell FROM v_nearU_{STEPS})"""
IVF_SQL = FLAT_SQL + f""", {CELL_SQL},
    v_probe AS (SELECT query_id, code AS cell FROM (SELECT q.query_id, c.code, row_number() OVER
        (PARTITION BY q.query_id ORDER BY round({sq_sql('q.embedding', 'c.embedding')}, 6), c.code)
        AS n FROM v_queries q CROSS JOIN v_cent c) WHERE n <= {PROBES}),
    v_ivf AS (SELECT f.query_id, f.item_id, f.score, row_number() OVER (PARTITION BY f.query_id
        ORDER BY f.score DESC, f.item_id) AS rank FROM v_flat f JOIN v_cell c USING (item_id)
      JOIN v_probe p ON p.query_id = f.query_id AND p.cell = c.cell)"""


def ivf_index(v: Views) -> tuple[DataFrame, DataFrame]:
    """The built index as a stored table, and its centroids."""
    cells, centroids = index.ivf_build(v.vectors, centroids=v.seed_codebook)
    return stored(cells, "ivf"), centroids


@query("h04_ivf_build", f"WITH {CELL_SQL} SELECT * FROM v_cell")
def ivf(v: Views) -> DataFrame:
    return ivf_index(v)[0].select("item_id", "cell")


@query("h04_ivf_build_kmeans")
def ivf_kmeans(v: Views) -> DataFrame:
    return index.ivf_build(v.vectors)[0].select("item_id", F.col("cell").cast("bigint").alias("cell"))


@query("h05_ivf_search", f"WITH {IVF_SQL} SELECT * FROM v_ivf WHERE rank <= 20")
def ivf_search(v: Views) -> DataFrame:
    cells, centroids = ivf_index(v)
    return index.ivf_search(cells, centroids, v.profile_queries, 20, nprobe=PROBES)


def coded_index(v: Views) -> DataFrame:
    """Cell lists with the codes of the residuals, as a stored table."""
    return stored(index.ivfpq_build(v.vectors, v.seed_codebook, v.part_codebooks), "coded-cells")


@query(
    "h06_pq_encode",
    f"""SELECT c.item_id, n.code AS cell, array_to_string(list(c.code ORDER BY part), ',') AS codes
        FROM v_part_codes c JOIN v_nearU_{STEPS} n USING (item_id) GROUP BY c.item_id, n.code""",
)
def pq(v: Views) -> DataFrame:
    codes = index.ivfpq_build(v.vectors, v.seed_codebook, v.part_codebooks)
    return codes.select(
        "item_id", "cell", F.array_join(F.col("codes").cast("array<string>"), ",").alias("codes")
    )


WIDTH = DIM // PARTS
PQ_SQL = IVF_SQL + f""",
    v_apart AS (SELECT p.query_id, p.cell, generate_subscripts(b.embedding, 1) AS d,
        unnest(q.embedding) - unnest(b.embedding) AS x
      FROM v_probe p JOIN v_queries q USING (query_id) JOIN v_cent b ON b.code = p.cell),
    v_qpart AS MATERIALIZED (SELECT query_id, cell, (d - 1) // {WIDTH} AS part, list(x ORDER BY d) AS x
      FROM v_apart GROUP BY ALL),
    v_table AS MATERIALIZED (SELECT query_id, cell, part, code, {sq_sql('q.x', 'b.embedding')} AS d
      FROM v_qpart q JOIN v_part_books b USING (part)),
    v_coded AS (SELECT t.query_id, c.item_id, round(sum(t.d), 6) AS score, row_number() OVER
        (PARTITION BY t.query_id ORDER BY round(sum(t.d), 6), c.item_id) AS rank
      FROM v_table t JOIN v_cell l ON l.cell = t.cell
      JOIN v_part_codes c ON c.item_id = l.item_id AND c.part = t.part AND c.code = t.code
      GROUP BY t.query_id, c.item_id)"""


@query("h07_pq_search", f"WITH {PQ_SQL} SELECT * FROM v_coded WHERE rank <= 20")
def pq_search(v: Views) -> DataFrame:
    return index.ivfpq_search(
        coded_index(v), v.seed_codebook, v.part_codebooks, v.profile_queries, 20, nprobe=PROBES
    )


@query("h07_pq_recall")
def pq_recall(v: Views) -> DataFrame:
    """Recall of the 20 best, when 200 found by codes in three quarters of the cells are compared exactly."""
    found = index.ivfpq_search(
        coded_index(v), v.seed_codebook, v.part_codebooks, v.profile_queries, 200, nprobe=12
    )
    best = index.rerank_exact(stored(found, "found"), v.vectors, v.profile_queries, 20)
    return index.recall_at_k(best, index.search_flat(v.unit, v.profile_queries, 20))


@query("h05_search_reloaded", f"WITH {IVF_SQL} SELECT * FROM v_ivf WHERE rank <= 20")
def reloaded_search(v: Views) -> DataFrame:
    """The index and its centroids as saved and loaded again give the same lists."""
    path = scratch_path(v.spark, "saved-index")
    cells, centroids = index.ivf_build(v.vectors, centroids=v.seed_codebook)
    writers.save_index(cells, path, True, centroids)
    loaded = writers.load_index(v.spark, path)
    return index.ivf_search(loaded, writers.load_centroids(v.spark, path), v.profile_queries, 20, nprobe=PROBES)


def lsh_sql(tables: int, bits: int) -> str:
    """All items that share a bucket with the query, by the same planes."""
    def buckets(of: str, key: str) -> str:
        return f"""(SELECT {key}, b // {bits} AS t, sum(CASE WHEN list_dot_product(embedding, plane) > 0
            THEN 1 << (b % {bits}) ELSE 0 END) AS bucket FROM {of} CROSS JOIN v_plane GROUP BY ALL)"""
    return f"""{FLAT_SQL}, v_plane AS (SELECT b, list(g ORDER BY d) AS plane FROM (SELECT b, d,
          {normal_sql(42, "b", "d")} AS g FROM (SELECT unnest(range({tables * bits})) AS b)
          CROSS JOIN (SELECT unnest(range({DIM})) AS d)) GROUP BY b),
        v_met AS (SELECT DISTINCT query_id, item_id FROM {buckets("v_queries", "query_id")} q
          JOIN {buckets("v_unit", "item_id")} x USING (t, bucket)),
        v_lsh AS (SELECT query_id, item_id, f.score, row_number() OVER (PARTITION BY query_id
          ORDER BY f.score DESC, item_id) AS rank FROM v_met JOIN v_flat f USING (query_id, item_id))"""


@query("h08_lsh_search", f"WITH {lsh_sql(8, 6)} SELECT * FROM v_lsh WHERE rank <= 20")
def lsh(v: Views) -> DataFrame:
    return index.lsh_search(v.unit, v.profile_queries, 20, DIM)


@query(
    "h08_lsh_recall",
    f"""WITH {lsh_sql(16, 3)} SELECT count(l.item_id) AS hits, count(*) AS expected,
          round(count(l.item_id) / count(*), 6) AS recall
        FROM (SELECT * FROM v_flat WHERE rank <= 20) f LEFT JOIN
          (SELECT * FROM v_lsh WHERE rank <= 20) l
          ON l.query_id = f.query_id AND l.item_id = f.item_id""",
)
def lsh_recall(v: Views) -> DataFrame:
    """Wide buckets (3 bits) in 16 tables."""
    found = index.lsh_search(v.unit, v.profile_queries, 20, DIM, tables=16, bits=3)
    return index.recall_at_k(found, index.search_flat(v.unit, v.profile_queries, 20))


@query(
    "h09_recall_at_k",
    f"""WITH {IVF_SQL} SELECT count(i.item_id) AS hits, count(*) AS expected,
          round(count(i.item_id) / count(*), 6) AS recall
        FROM (SELECT * FROM v_flat WHERE rank <= 20) f LEFT JOIN
          (SELECT * FROM v_ivf WHERE rank <= 20) i
          ON i.query_id = f.query_id AND i.item_id = f.item_id""",
)
def recall(v: Views) -> DataFrame:
    exact = index.search_flat(v.unit, v.profile_queries, 20)
    return index.recall_at_k(ivf_search(v), exact, sample=None)


NEW_SQL = f"""{CELL_SQL}, v_new AS (SELECT item_id, list_transform(u.embedding, lambda x: -x)
            AS embedding FROM v_unit u JOIN v_vectors v USING (item_id) WHERE v.label % 2 = 0
          UNION ALL SELECT item_id + 1000000, u.embedding FROM v_unit u
            JOIN v_vectors v USING (item_id) WHERE v.label % 2 = 1),
          v_new_cell AS (SELECT item_id, embedding, code AS cell FROM (
            SELECT u.item_id, u.embedding, c.code, row_number() OVER (PARTITION BY u.item_id
              ORDER BY {sq_sql('u.embedding', 'c.embedding')}, c.code) AS n
            FROM v_new u CROSS JOIN v_cent c) WHERE n = 1),
          v_whole AS (SELECT item_id, embedding, cell FROM v_new_cell UNION ALL
            SELECT u.item_id, u.embedding, c.cell FROM v_unit u JOIN v_cell c USING (item_id)
            ANTI JOIN v_new n ON n.item_id = u.item_id)"""


def arrivals(v: Views) -> DataFrame:
    even = F.col("label") % 2 == 0
    return v.vectors.select(
        F.when(even, F.col("item_id")).otherwise(F.col("item_id") + 1_000_000).alias("item_id"),
        F.when(even, F.transform("embedding", lambda x: -x)).otherwise(F.col("embedding"))
        .alias("embedding"),
    )


@query(
    "h10_add_items",
    f"""WITH {NEW_SQL}
        SELECT item_id, cell, round(list_sum(embedding), 6) AS total FROM v_whole""",
)
def added(v: Views) -> DataFrame:
    """Even labels come again with the opposite vector, odd labels as new items."""
    cells, centroids = ivf_index(v)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    whole = index.add_items(cells.select("item_id", "embedding", "cell"), arrivals(v), centroids)
    return whole.select("item_id", "cell", rounded(total).alias("total"))


LIVE_SQL = f"""WITH {IVF_SQL}, {NEW_SQL.removeprefix(CELL_SQL + ", ")}
    SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id
      ORDER BY score DESC, item_id) AS rank FROM (
      SELECT p.query_id, x.item_id, round(list_dot_product(q.embedding, x.embedding), 6) AS score
      FROM v_probe p JOIN v_queries q USING (query_id) JOIN v_whole x USING (cell)
      WHERE x.item_id % 5 <> 0)
    QUALIFY rank <= 20"""


def live_search(v: Views, compact_last: bool) -> DataFrame:
    """A base, a compacted batch of arrivals, a batch of removals; then a search."""
    path = scratch_path(v.spark, "live-index")
    cells, centroids = ivf_index(v)
    live_index.create_live(cells, path)
    live_index.add_changes(arrivals(v), path, 0, centroids)
    live_index.compact(v.spark, path)
    gone = live_index.live_rows(v.spark, path).where("item_id % 5 = 0")
    live_index.remove_items(gone, path, 1)
    if compact_last:
        live_index.compact(v.spark, path)
    return live_index.search_live(path, centroids, v.profile_queries, 20, nprobe=PROBES)


@query("h10_live_search", LIVE_SQL)
def fresh_search(v: Views) -> DataFrame:
    """Removals are still changes beside the base."""
    return live_search(v, False)


@query("h10_compacted_search", LIVE_SQL)
def compacted_search(v: Views) -> DataFrame:
    """The same search when everything is in the base."""
    return live_search(v, True)
