"""The registered queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_pipeline import run
from freightmill.llm.common import read_table
from freightmill.llm.decontaminate import contaminated_windows
from freightmill.llm.exact_dedup import mark_exact_duplicates
from freightmill.llm.hard_negatives import mine_hard_negatives
from freightmill.llm.html_text import extract_main_text
from freightmill.llm.jaccard_join import near_duplicate_components
from freightmill.llm.line_dedup import line_classes
from freightmill.llm.packing import pack_documents
from freightmill.llm.quality import score_quality, train_quality
from freightmill.llm.substring_dedup import remove_repeats
from freightmill.llm.token_counts import token_counts
from freightmill.llm.toxicity import score_documents, train
from freightmill.llm.url_filter import KEYWORDS, judge_urls, keyword_rule, site_rule
from freightmill.llm.whitening import whitened_components

SITE_RULES = [
    site_rule("com", "/", "allow"),
    site_rule("example.com", "/en/", "block"),
    site_rule("www.example.com", "/en/", "allow"),
    site_rule("net", "/es/", "block"),
    site_rule("net", "/fr/", "block"),
]


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(read_table(spark, folder, "pages"), keep=["page_id", "url"])


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_components(read_table(spark, folder, "documents"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(read_table(spark, folder, "documents"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = SITE_RULES + [keyword_rule(words) for words in KEYWORDS]
    return judge_urls(read_table(spark, folder, "pages"), rules, keep=["page_id"])


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return mark_exact_duplicates(read_table(spark, folder, "documents"), columns=["doc_id"])


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(read_table(spark, folder, "documents"), keep=["doc_id"])


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read_table(spark, folder, "documents"))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated_windows(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )
    return found.select("doc_id", "item_id", "similarity", "start", "n_words")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = train(docs, read_table(spark, folder, "labels"))
    return score_documents(docs, model, keep=["doc_id"])


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_classes(read_table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = train_quality(docs, read_table(spark, folder, "labels"))
    return score_quality(docs, model, keep=["doc_id"])


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitened_components(read_table(spark, folder, "embeddings"))
    # The contract names a long; a sum that is none fails here instead of wrapping around.
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_packing": op3_packing,
    "op4_url_filter": op4_url_filter,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality": op12_quality,
    "op13_whitening": op13_whitening,
    "pipeline": run,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SITES = ", ".join(
    f"('{r.name.partition('/')[0]}', '/{r.name.partition('/')[2]}', '{r.name}', '{r.verdict}')"
    for r in SITE_RULES
)
_KEYWORD = "|".join("[^a-z0-9]+".join(words.split()) for words in KEYWORDS)

ORACLES: dict[str, str] = {
    "op2_jaccard_join": f"""
        WITH RECURSIVE worded AS (
          SELECT doc_id, list_filter(
                   regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
          FROM documents),
        listed AS (
          SELECT doc_id, CASE
              WHEN len(w) >= 5 THEN list_distinct(list_transform(
                range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS shingles
          FROM worded),
        sized AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM listed),
        single AS (SELECT doc_id, unnest(shingles) AS shingle FROM listed),
        pairs AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
          FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
          GROUP BY a.doc_id, b.doc_id),
        links AS (
          SELECT x, y FROM pairs JOIN sized p ON p.doc_id = x JOIN sized q ON q.doc_id = y
          WHERE 100 * c >= 80 * (p.n + q.n - c)),
        reach(doc_id, other) AS (
          SELECT doc_id, doc_id FROM documents
          UNION
          SELECT r.doc_id, l.other FROM reach r
          JOIN (SELECT x AS here, y AS other FROM links
                UNION ALL SELECT y, x FROM links) l ON r.other = l.here)
        SELECT r.doc_id, s.n AS n_shingles, min(r.other) AS component_id
        FROM reach r JOIN sized s ON s.doc_id = r.doc_id GROUP BY r.doc_id, s.n
    """,
    "op4_url_filter": f"""
        WITH parts AS (
          SELECT page_id, lower(coalesce(url, '')) AS url,
                 translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
          FROM pages),
        rules(site, prefix, rule, verdict) AS (VALUES {_SITES}),
        best AS (
          SELECT page_id, host, path, url,
                 arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS fits
          FROM parts LEFT JOIN rules
            ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, prefix)
          GROUP BY page_id, host, path, url)
        SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
               coalesce(fits, CASE WHEN regexp_matches(
                 url, '(^|[^a-z0-9])({_KEYWORD})([^a-z0-9]|$)') THEN 'block' ELSE 'allow' END)
                 AS verdict
        FROM best
    """,
    "op5_exact_dedup": f"""
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               text_sha256
        FROM (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
        WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op11_hard_negatives": """
        WITH rows AS (
          SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS kind,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT a.id AS anchor_id, r.id AS id, a.kind = r.kind AS same,
                 CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
          FROM rows a JOIN rows r ON a.id % 50 = 0 AND a.id <> r.id),
        positives AS (
          SELECT anchor_id, id, score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, p.id AS positive_id,
               CAST(row_number() OVER best AS INTEGER) AS rank, n.id AS negative_id,
               p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
          AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        WINDOW best AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
        QUALIFY row_number() OVER best <= 3
    """,
}
