"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import (
    byte_bpe,
    exact_dedup,
    fingerprints,
    hard_negatives,
    language_id,
    mixing,
    near_dedup,
    page_text,
    secret_scan,
    substring_dedup,
    token_alignment,
    toxicity,
    warc,
)
from casemill.llm.common import table


def op1_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op2_minhash_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op3_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op4_line_block_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op5_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("payload", "url")


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op7_oph_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def op8_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def vocabulary() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public byte-level vocabulary, from the driver's installation."""
    import public_tokenizers

    return byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    trip = byte_bpe.round_trip(table(spark, sf_dir, "documents"), *vocabulary())
    return trip.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_strassen_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_ftrl_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op13_spill_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_alignment.aligned(table(spark, sf_dir, "documents"), *paths, public_tokenizers.PATTERN)


QUERIES = {
    "op1_hash_threshold_mix": op1_hash_threshold_mix,
    "op2_minhash_hamming_join": op2_minhash_hamming_join,
    "op3_trigram_secret_scan": op3_trigram_secret_scan,
    "op4_line_block_text": op4_line_block_text,
    "op5_warc_zstd": op5_warc_zstd,
    "op6_sentence_spans": op6_sentence_spans,
    "op7_oph_fingerprints": op7_oph_fingerprints,
    "op8_chunk_recipes": op8_chunk_recipes,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ftrl_toxicity": op10_ftrl_toxicity,
    "op11_strassen_hard_negatives": op11_strassen_hard_negatives,
    "op12_ftrl_language_id": op12_ftrl_language_id,
    "op13_spill_token_alignment": op13_spill_token_alignment,
}


def _secret_sql() -> str:
    """Spans of all rules from the lengths of matches and of the pieces between them."""
    parts = []
    for k, r in enumerate(secret_scan.RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT n, {k} AS ord, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(text, '{pattern}') AS whole, "
            f"regexp_extract_all(text, '{pattern}', {r.group}) AS tested, regexp_split_to_array(text, '{pattern}') AS gaps FROM t"
        )
    return f"""
        WITH t AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
        found AS ({" UNION ALL ".join(parts)}),
        each AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM found),
        spans AS (
            SELECT n, ord, kind, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS begin, length(whole[i]) AS len
            FROM each WHERE length(tested[i]) >= least
        ),
        joined AS (
            SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                   count(*) FILTER (kind = 'hex') AS n_hex,
                   string_agg(kind || ':' || begin::BIGINT || ':' || (begin + len)::BIGINT, ',' ORDER BY begin, ord) AS spans,
                   string_agg(kind || ':' || begin::BIGINT || ':' || (begin + len)::BIGINT, ',' ORDER BY begin, ord)
                       FILTER (ord < {len(secret_scan.BASE)}) AS base
            FROM spans GROUP BY n
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM t LEFT JOIN joined USING (n)
    """


ORACLE = {
    "op1_hash_threshold_mix": r"""
        WITH docs AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS cap,
                   [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
            FROM docs GROUP BY source
        ), rising AS (
            SELECT *, sum(source_size) OVER ()::DOUBLE * 1.5 AS total,
                   coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
                   sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
                   row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k
            FROM sources
        ), cut AS (
            SELECT min(k) FILTER ((total - spent) * w / open_w <= cap) AS k FROM rising
        ), targets AS (
            SELECT r.source, r.source_size,
                   CASE WHEN r.k < c.k OR c.k IS NULL THEN r.cap ELSE (f.total - f.spent) * r.w / f.open_w END AS target
            FROM rising r CROSS JOIN cut c LEFT JOIN rising f ON f.k = c.k
        ), plan AS (
            SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END AS base FROM targets
        ), steps AS (
            SELECT source, h, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto_here
            FROM docs GROUP BY source, h
        ), crossing AS (
            SELECT p.source, min(struct_pack(h := s.h, words := s.words, upto_here := s.upto_here)) AS b
            FROM plan p JOIN steps s ON p.source IS NOT DISTINCT FROM s.source
                AND s.upto_here > p.target - p.base * p.source_size
            GROUP BY p.source
        ), limits AS (
            SELECT p.*, CASE WHEN p.base >= 2 OR p.target <= 0 THEN -1 WHEN c.b IS NULL THEN 1::BIGINT << 61
                WHEN c.b.upto_here - (p.target - p.base * p.source_size)
                     <= (p.target - p.base * p.source_size) - (c.b.upto_here - c.b.words) THEN c.b.h ELSE c.b.h - 1 END AS upto
            FROM plan p LEFT JOIN crossing c ON p.source IS NOT DISTINCT FROM c.source
        )
        SELECT d.doc_id, d.source, d.size, l.source_size, l.target,
               (d.size * (l.base + CASE WHEN d.h <= l.upto THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM docs d JOIN limits l ON d.source IS NOT DISTINCT FROM l.source
    """,
    "op8_chunk_recipes": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_strassen_hard_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS n, vec_id AS id,
                   CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT a.n AS a, a.id AS anchor_id, c.n AS c, c.id AS id, a.label = c.label AS same,
                   coalesce(list_sum(list_transform(range(1, least(len(a.q), len(c.q)) + 1), lambda i: a.q[i] * c.q[i])), 0)::BIGINT AS score
            FROM v a JOIN v c ON a.n <> c.n WHERE a.id % 50 = 0
        ), positives AS (
            SELECT * FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST) <= 5
        )
        SELECT p.anchor_id, p.id AS positive_id,
               row_number() OVER (PARTITION BY p.a, p.c ORDER BY n.score DESC, n.id NULLS LAST)::INT AS rank,
               n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN pairs n ON p.a = n.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY rank <= 3
    """,
    "op3_trigram_secret_scan": _secret_sql(),
    "op5_warc_zstd": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
        g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (((('0x' || substr(sha, (5 * i // 4 + 1)::BIGINT, 2))::BIGINT >> (3 - (5 * i) % 4)::INT) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM g
    """,
}
