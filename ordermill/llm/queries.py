"""Registered queries of this subpackage: opN_<name> over the whole intended table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_documents, read_file
from .common import staged, table
from .importance import resample
from .jaccard_join import near_duplicates
from .labelled import id_crc
from .line_dedup import dedup_lines
from .logbilinear import score_documents
from .merkle_audit import audit, digested, warc_layout, warc_payload
from .packing import pack_documents
from .pivot_search import top_inner_products
from .quality_nbsvm import fit_quality, score_quality
from .repeat_removal import remove_repeats
from .string_tiling import benchmark_matches
from .toxicity import fit_toxicity, score_toxicity
from .url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]

#: Rules of the url query (fixed values).
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixity audit of a damaged replica of ``pages`` as WARC records: by fixed arithmetic on page_id some
    records have a changed byte, lack their last byte, or are gone."""
    page = F.col("page_id")
    damaged = (
        F.when(page % 97 == 3, F.concat(F.lit("X"), F.substr("payload", F.lit(2))))
        .when(page % 103 == 7, F.substr("payload", F.lit(1), F.length("payload") - 1))
        .otherwise(F.col("payload"))
    )
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long"), warc_payload().alias("payload"))
    both = digested(pages.withColumn("copy", damaged)).withColumns(
        {"copy_length": F.octet_length("copy").cast("long"), "copy_sha256": F.sha2("copy", 256)}
    )
    records = staged(warc_layout(both.drop("copy"), "page_id"), "warc-records")
    replica = records.filter(~F.coalesce(page % 101 == 5, F.lit(False))).select(
        "file", "offset", F.col("copy_length").alias("length"), F.col("copy_sha256").alias("sha256")
    )
    return audit(records, replica)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents``: five-word shingles, similarity 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=80).select(
        "doc_id", "n_shingles", "component_id"
    )


def op3_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of ``documents``, learned from labels whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), learn=id_crc() % 5 != 0)
    return score_quality(docs.select("doc_id", "text"), model, 0.3).select(
        "doc_id", (id_crc() % 5 == 0).alias("held_out"), "score", "predicted"
    )


def op4_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of ``documents``, learned from labels whose crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=id_crc() % 3 != 1)
    return score_toxicity(docs.select("doc_id", "text"), model, 0.7).select(
        "doc_id", (id_crc() % 3 == 1).alias("held_out"), "score", "predicted"
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of 2,048 words for ``documents``, no two of one source or of equal texts in a bin."""
    return pack_documents(table(spark, sf_dir, "documents"), capacity=2048)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all urls of ``pages``."""
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of ``documents`` that three documents hold, kept in the largest doc_id."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op8_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` left when every repeated string of 200 bytes is removed."""
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), least=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best integer inner products in ``embeddings`` of every vec_id divisible by 100."""
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of ``benchmark`` of which ``documents`` cover 60 % in tiles of five words or more."""
    found = benchmark_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_match=5, percent=60
    )
    return found.select("doc_id", "item_id", "item_words", "covered_words", "n_tiles", "coverage")


def op11_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of ``documents``, learned from those whose crc32(doc_id) mod 10 is not 0."""
    return score_documents(table(spark, sf_dir, "documents"), learn=id_crc() % 10 != 0)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draw of 10 % of the longer ``documents`` towards the words of ``benchmark``."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Vocabulary files of op13: a byte-level one and a piece model.
TOKENIZERS = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over ``documents``."""
    return align_documents(table(spark, sf_dir, "documents"), *map(read_file, TOKENIZERS))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_merkle_fixity,
        op2_ngram_jaccard_join,
        op3_quality_nbsvm,
        op4_counterfactual_toxicity,
        op5_best_fit_packing,
        op6_url_filter,
        op7_line_dedup,
        op8_repeat_removal,
        op9_pivot_topk,
        op10_string_tiling,
        op11_log_bilinear,
        op12_importance_resampling,
        op13_tokenizer_alignment,
    )
}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op1_merkle_fixity": """
        WITH r AS (
            SELECT page_id, chr(13) || chr(10) AS nl, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
        ), p AS (
            SELECT page_id,
                   'WARC/1.0' || nl || 'WARC-Type: response' || nl || 'WARC-Target-URI: ' || url || nl
                   || 'Content-Type: text/html' || nl || 'Content-Length: ' || strlen(html) || nl || nl
                   || html || nl || nl AS payload
            FROM r
        ), d AS (
            SELECT page_id, 'pages-' || CAST(page_id // 512 AS VARCHAR) AS file, payload, sha256(payload) AS sha,
                   CASE WHEN page_id % 97 = 3 THEN 'X' || substr(payload, 2)
                        WHEN page_id % 103 = 7 THEN substr(payload, 1, length(payload) - 1)
                        ELSE payload END AS copy
            FROM p
        ), o AS (
            SELECT *, CAST(coalesce(sum(strlen(payload)) OVER (PARTITION BY file ORDER BY page_id, sha
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
            FROM d
        )
        SELECT file, "offset", CASE WHEN page_id % 101 = 5 THEN 'missing' ELSE 'corrupt' END AS status,
               CAST(strlen(payload) AS BIGINT) AS expected_length,
               CASE WHEN page_id % 101 <> 5 THEN CAST(strlen(copy) AS BIGINT) END AS actual_length,
               sha AS expected_sha256, CASE WHEN page_id % 101 <> 5 THEN sha256(copy) END AS actual_sha256
        FROM o WHERE page_id % 101 = 5 OR copy <> payload
    """,
    "op2_ngram_jaccard_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(words[i : i + least(5, len(words)) - 1], ' ') AS g
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
                  FROM w WHERE len(words) > 0)
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), meet AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY ALL
        ), links AS (
            SELECT a, b FROM meet JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * c >= 80 * (x.n + y.n - c)
        ), reach AS (
            SELECT doc_id AS node, doc_id AS root FROM documents
            UNION SELECT b, root FROM reach JOIN links ON a = node
        )
        SELECT node AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(root) AS component_id
        FROM reach LEFT JOIN n ON n.doc_id = node GROUP BY node
    """,
    "op7_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
        ), k AS (
            SELECT *, trim({LOWER.format('line')}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
            FROM l
        ), c AS (
            SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), m AS (
            SELECT doc_id, pos, line, c.key IS NOT NULL AND doc_id <> last AS gone FROM k LEFT JOIN c ON k.key = c.key
        )
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op8_repeat_removal": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), w AS (
            SELECT doc_id, s, md5(substr(h, CAST(2 * s + 1 AS BIGINT), 400)) AS k
            FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS s FROM d WHERE length(h) >= 400)
        ), r AS (
            SELECT doc_id, s FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)
        ), i AS (
            SELECT doc_id, s, s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 IS NOT FALSE AS first FROM r
        ), g AS (
            SELECT doc_id, s, sum(CAST(first AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM i
        ), p AS (
            SELECT doc_id, run, min(s) AS a, max(s) + 200 AS b FROM g GROUP BY doc_id, run
        ), q AS (
            SELECT doc_id, run, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM p
        ), k AS (
            SELECT q.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
                   string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS kept
            FROM q JOIN d ON d.doc_id = q.doc_id GROUP BY q.doc_id
        )
        SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(coalesce(kept || substr(h, CAST(2 * last + 1 AS BIGINT)), h))) AS kept_sha256
        FROM d LEFT JOIN k ON d.doc_id = k.doc_id
    """,
    "op12_importance_resampling": f"""
        WITH tab AS (
            SELECT [list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1
                    THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) FOR b IN range(256)] AS crc
        ), f AS (
            SELECT 'd' AS side, doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")},
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
            UNION ALL
            SELECT 'b', NULL, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")},
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
        ), h AS (
            SELECT w, [16 * (instr('0123456789ABCDEF', substr(x, 2 * i - 1, 1)) - 1)
                       + instr('0123456789ABCDEF', substr(x, 2 * i, 1)) - 1 FOR i IN range(1, length(x) // 2 + 1)] AS bytes
            FROM (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM f))
        ), k AS (
            SELECT w, xor(list_reduce(list_prepend(4294967295, bytes),
                   lambda c, x: xor(c >> 8, crc[CAST((xor(c, x) & 255) + 1 AS BIGINT)])), 4294967295) % 10000 AS bucket
            FROM h, tab
        ), n AS (
            SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
            FROM f JOIN k ON f.w = k.w GROUP BY bucket
        ), a AS (SELECT CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t FROM n
        ), g AS (
            SELECT bucket, CAST(floor(1000.0::DOUBLE * ln(((n.t + 1)::DOUBLE * (a.s + 10000))
                                      / ((n.s + 1)::DOUBLE * (a.t + 10000)))) AS BIGINT) AS gain
            FROM n, a
        ), d AS (
            SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
            FROM f JOIN k ON f.w = k.w JOIN g ON g.bucket = k.bucket WHERE side = 'd' GROUP BY doc_id
        ), u AS (
            SELECT doc_id, list_reduce(list_prepend(0, [instr('0123456789abcdef', substr(sha256('2024:' || doc_id), i, 1)) - 1
                                                        FOR i IN range(1, 9)]), lambda x, y: 16 * x + y) AS h
            FROM documents
        ), o AS (
            SELECT u.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))
                                              AS BIGINT) AS score
            FROM u LEFT JOIN d ON d.doc_id = u.doc_id
        ), r AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
            FROM o WHERE n_features >= 20
        )
        SELECT o.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
        FROM o LEFT JOIN r ON r.doc_id = o.doc_id
    """,
    "op9_pivot_topk": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
