"""Registered queries of this subpackage and their SQL, where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.licenses import report_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.pii import pii_report
    from shelfwise.llm.shared import deal_out

    return pii_report(deal_out(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op5_warc_revisits", """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
               sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM f
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages"))


@query("op7_hilbert_shards")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.hilbert import shard_report

    return shard_report(table(spark, sf_dir, "documents"))


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.langid import language_report

    return language_report(table(spark, sf_dir, "documents"))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.quality_knn import quality_report

    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_kneser_ney")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.kneser_ney import lm_report

    return lm_report(table(spark, sf_dir, "documents"))


@query("op10_parity_join", r"""
    WITH w AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    s AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    l AS (
        SELECT p.a, p.b FROM (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (g)
            WHERE x.doc_id <> y.doc_id GROUP BY ALL) p
        JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
        WHERE 100 * k >= 80 * (na.n + nb.n - k)),
    r AS (
        WITH RECURSIVE reach(s, t) AS (
            SELECT a, b FROM l UNION SELECT reach.s, l.b FROM reach JOIN l ON reach.t = l.a)
        SELECT s, min(t) AS m FROM reach GROUP BY s)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id)) AS component_id
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.s = d.doc_id
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.parity_join import jaccard_classes

    return jaccard_classes(table(spark, sf_dir, "documents"))


@query("op2_spaced_seeds")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.decontaminate import find_overlaps
    from shelfwise.llm.shared import deal_out

    documents = deal_out(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return find_overlaps(documents, table(spark, sf_dir, "benchmark"))


@query("op6_multi_index", """
    WITH v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
          AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
    l AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
        AND list_cosine_similarity(a.x, b.x) >= 0.98),
    r AS (
        WITH RECURSIVE reach(s, t) AS (
            SELECT a, b FROM l UNION SELECT reach.s, l.b FROM reach JOIN l ON reach.t = l.a)
        SELECT s, min(t) AS m FROM reach GROUP BY s)
    SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(r.m, e.vec_id)) AS component_id,
           e.vec_id = least(e.vec_id, coalesce(r.m, e.vec_id)) AS kept
    FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) n ON n.a = e.vec_id
    LEFT JOIN r ON r.s = e.vec_id
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.imi_dedup import link_vectors

    return link_vectors(table(spark, sf_dir, "embeddings"))


@query("op9_soft_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm import mixing

    labelled = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.mixed(table(spark, sf_dir, "documents"), labelled, mixing.TARGETS)


@query("op11_licenses", report_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.licenses import license_report
    from shelfwise.llm.shared import deal_out

    return license_report(deal_out(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.runs import runs_report
    from shelfwise.llm.shared import deal_out

    return runs_report(deal_out(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op13_lexical_search", r"""
    WITH t AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents),
    i AS (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
    a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
    f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, a GROUP BY term, docs),
    s AS (
        SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))) AS s
        FROM f JOIN w USING (term) JOIN d USING (doc_id), a),
    r AS (SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM i JOIN s USING (term) GROUP BY ALL)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM r WHERE score > 0
    QUALIFY rank <= 20
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.blas_rank import rank_documents

    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
