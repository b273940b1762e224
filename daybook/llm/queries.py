"""Registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, clusters, decontaminate, extract, knn, lines, packing, phrases, pii, records, simhash, substring, toxicity
from .common import materialize, table
from .tokens import vocabulary_path


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.kept_digest(substring.substring_dedup(table(spark, sf_dir, "documents"), window=13))


def op4_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64))
    vectors = table(spark, sf_dir, "embeddings").where(whole).select("vec_id", steps.alias("vector"))
    return knn.knn_join(vectors, F.col("vec_id") % 20 == 0, k=20)


def op5_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(spark, table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), end_id=1)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", lines.host_of(F.col("url")).alias("host"), lines.page_lines(F.col("html")).alias("text")
    )
    pages = materialize(pages, "pages")  # read twice: counted, then cleaned
    kept = lines.drop_boilerplate(pages, F.col("host"), ratio=0.2, min_pages=5, counts=True)
    return kept.select("page_id", "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), max_length=1024, end_id=0))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8)
    share = F.round(F.col("matched") / F.col("n_shingles"), 6)
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "matched", "n_shingles", share.alias("containment"))


CONTROL = "\\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = F.lit(CONTROL).alias("content")
    extra = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.array(F.struct(F.lit("user").alias("role"), says), F.struct(F.lit("assistant").alias("role"), says)).alias("messages"),
    )
    both = chat.canonical(turns).unionByName(chat.canonical(extra))
    return chat.digest(materialize(chat.format_turns(both), "chat"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op11_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"), references_per_host=3, share=0.9, support=5)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, top=2000, covered=80)


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clusters(clusters.grid(table(spark, sf_dir, "embeddings"), dims=64, scale=64), k=16, rounds=3)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_pii": op2_pii,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_knn_join": op4_knn_join,
    "op5_binary_records": op5_binary_records,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_decontaminate": op8_decontaminate,
    "op9_chat_format": op9_chat_format,
    "op10_simhash": op10_simhash,
    "op11_extract": op11_extract,
    "op12_collocations": op12_collocations,
    "op13_clusters": op13_clusters,
}



def _kmeans_sql(k: int, rounds: int) -> str:
    """SQL of the rounds of op13: an assignment and an update each, one assignment more."""
    steps = [
        f"""
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, * FROM (
                SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS e
                FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
        ), x AS MATERIALIZED (SELECT r, unnest(e) AS x, unnest(generate_series(1, 64)) AS p FROM v),
        c0 AS MATERIALIZED (
            SELECT j, unnest(e) AS x, unnest(generate_series(1, 64)) AS p FROM (
                SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, e) - 1 AS j, e FROM v
                QUALIFY j < {k}))"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
            SELECT r, j, d FROM (
                SELECT r, j, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS d FROM x JOIN c{i} c USING (p) GROUP BY r, j)
            QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)""")
        if i < rounds:
            steps.append(f"""
        s{i} AS (SELECT j, p, sum(x) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{i} JOIN x USING (r) GROUP BY j, p),
        c{i + 1} AS MATERIALIZED (
            SELECT j, p, CAST(CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
            FROM c{i} c LEFT JOIN s{i} USING (j, p))""")
    return (
        "WITH"
        + ",".join(steps)
        + f""",
        m AS (SELECT j, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p)) AS mark FROM c{rounds} GROUP BY j)
        SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance,
               CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
               mark AS centroid_sha256
        FROM a{rounds} JOIN v USING (r) JOIN m USING (j)"""
    )


#: DuckDB SQL where it can express the operator.
ORACLE: dict[str, str] = {
    "op4_knn_join": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS e
            FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM s
        )
        SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 20
    """,
    "op6_line_dedup": r"""
        WITH a AS (
            SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)), '') AS host,
                   regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g') AS t,
                   row_number() OVER () AS r
            FROM pages
        ), b AS (
            SELECT page_id, host, r, regexp_replace(regexp_replace(t,
                   '(?i)</?(?:p|br|div|li|ul|ol|tr|table|h[1-6]|nav|article|section|header|footer|title|body|head|html|blockquote|pre)\b[^>]*>',
                   chr(10), 'g'), '<[^>]*>', '', 'g') AS t
            FROM a
        ), p AS (
            SELECT page_id, host, r, string_split(trim(regexp_replace(t, '[ \t]*\n[ \t\n]*', chr(10), 'g')), chr(10)) AS ls FROM b
        ), l AS (
            SELECT page_id, host, r, ls[i] AS line, i FROM (SELECT *, unnest(generate_series(1, len(ls))) AS i FROM p)
        ), n AS (SELECT host, count(*) AS total FROM a WHERE host IS NOT NULL GROUP BY host),
        c AS (
            SELECT host, trim(line) AS line, count(DISTINCT r) AS pages FROM l WHERE trim(line) <> '' AND host IS NOT NULL GROUP BY ALL
        ), d AS (SELECT c.host, c.line FROM c JOIN n USING (host) WHERE pages >= 5 AND pages > 0.2 * total),
        k AS (
            SELECT l.r, count(*) AS n_lines, count(d.line) AS n_dropped,
                   coalesce(string_agg(l.line, chr(10) ORDER BY i) FILTER (WHERE d.line IS NULL), '') AS kept
            FROM l LEFT JOIN d ON l.host = d.host AND trim(l.line) = d.line GROUP BY l.r
        )
        SELECT page_id, host, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
               CASE WHEN n_lines IS NOT NULL THEN sha256(kept) END AS kept_sha256
        FROM a LEFT JOIN k USING (r)
    """,
    "op8_decontaminate": r"""
        WITH i AS (
            SELECT DISTINCT item_id, array_to_string(w[k:k+4], ' ') AS s
            FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 4)) AS k
                  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark))
        ), n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id),
        d AS (
            SELECT DISTINCT doc_id, text, array_to_string(w[k:k+4], ' ') AS s
            FROM (SELECT doc_id, text, w, unnest(generate_series(1, len(w) - 4)) AS k
                  FROM (SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents))
        ), m AS (SELECT doc_id, text, item_id, count(*) AS matched FROM d JOIN i USING (s) GROUP BY ALL)
        SELECT doc_id, item_id, matched, n_shingles, round(matched / n_shingles, 6) AS containment
        FROM m JOIN n USING (item_id) WHERE matched * 10 >= n_shingles * 8
    """,
    "op9_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS x FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), e AS (
            SELECT *, replace(replace(replace(x, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>') AS ex,
                   replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), ':', '\:') AS er
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, role, x)) AS turns_sha256,
               CAST(coalesce(sum(length(x)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, role, x) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(4 + length(er) + 2 + length(ex) + 8) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op12_collocations": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), p AS (SELECT r, doc_id, lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS MATERIALIZED (SELECT doc_id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        g AS (
            SELECT doc_id, lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
            FROM (SELECT doc_id, lang, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS i
                  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m))
        ), c AS MATERIALIZED (
            SELECT lang, m, phrase, count(*) AS f, min(doc_id) AS first_doc FROM g GROUP BY ALL
        ), n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE m = 1 GROUP BY lang),
        k AS (SELECT lang, m, phrase, f, first_doc, string_split(phrase, ' ') AS ws FROM c WHERE m > 1 AND f >= 30),
        s AS (
            SELECT lang, phrase, f, first_doc, i, array_to_string(ws[1:i], ' ') AS lp, array_to_string(ws[i + 1:], ' ') AS rp
            FROM (SELECT *, unnest(generate_series(1, m - 1)) AS i FROM k)
        ), o AS (
            SELECT s.lang, s.phrase, s.f AS a, s.first_doc, x.f AS l, y.f AS r, i,
                   CAST((CAST(2000000 AS HUGEINT) * s.f) // (x.f + y.f) AS BIGINT) AS score
            FROM s JOIN c x ON x.lang = s.lang AND x.phrase = lp JOIN c y ON y.lang = s.lang AND y.phrase = rp
            QUALIFY row_number() OVER (PARTITION BY s.lang, s.phrase ORDER BY score, i) = 1
        ), u AS (
            SELECT lang, array_to_string(ws[i:i + q - 1], ' ') AS phrase, max(f) AS longer
            FROM (SELECT *, unnest(generate_series(1, m - q + 1)) AS i
                  FROM k, (SELECT unnest([2, 3]) AS q) WHERE q < m)
            GROUP BY ALL
        ), z AS (
            SELECT o.*, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, o.phrase) AS "rank"
            FROM o LEFT JOIN u USING (lang, phrase) WHERE longer IS NULL OR CAST(longer AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80
        )
        SELECT lang, "rank", phrase, a, l, r, n, score, first_doc FROM z JOIN n USING (lang) WHERE "rank" <= 2000
    """,
    "op13_clusters": _kmeans_sql(16, 3),
}
