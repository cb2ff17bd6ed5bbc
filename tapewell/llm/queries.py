"""Registered queries of the training-data operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    chat,
    decontamination,
    fingerprint,
    language,
    mixing,
    neardup,
    negatives,
    phrases,
    quality,
    tokens,
    toxicity,
    warc,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_of_documents(_read(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_of_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints_of_documents(_read(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_of_pages(_read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_of_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokens_of_documents(_read(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_pairs(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest_conversations(
        chat.format_conversations(turns.unionByName(chat.control_conversation(spark)))
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_counts(_read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.negatives_of_embeddings(_read(spark, sf_dir, "embeddings"))


def op12_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.repeats_of_documents(_read(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_quality": op2_quality,
    "op3_order_minhash": op3_order_minhash,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_tokens": op6_tokens,
    "op7_decontamination": op7_decontamination,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_chat": op9_chat,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_repeated_phrases": op12_repeated_phrases,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}

_ESCAPED = "{0}"
for _plain, _marked in (
    ("\\", "\\\\"),
    ("<|", "<\\|"),
    ("<s>", "<\\s>"),
    ("</s>", "<\\/s>"),
    ("<SYS>>", "<\\SYS>>"),
    ("</SYS>>", "<\\/SYS>>"),
    ("[INST]", "[\\INST]"),
    ("[/INST]", "[\\/INST]"),
):
    _ESCAPED = f"replace({_ESCAPED}, '{_plain}', '{_marked}')"

SQL: dict[str, str] = {
    "op4_warc": """
        WITH p AS (
          SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
          SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h,
                 min(page_id) OVER (PARTITION BY payload) AS head
          FROM p
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i:
                 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST((CAST('0x' || substr(h, 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS BIGINT)
                     >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
               CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> head THEN head END AS refers_to
        FROM d
    """,
    "op8_near_duplicates": """
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x20\\x09-\\x0D]+') AS words
          FROM documents
        ), s AS (
          SELECT DISTINCT doc_id, array_to_string(words[k : k + 3], ' ') AS shingle
          FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS k
                FROM w WHERE len(words) > 0)
        ), n AS (
          SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
        ), overlap AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
          FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
          GROUP BY 1, 2
        ), link AS (
          SELECT a, b FROM overlap JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * shared >= 80 * (x.size + y.size - shared)
        ), both_ways AS (
          SELECT a, b FROM link UNION ALL SELECT b, a FROM link
        ), reach AS (
          SELECT doc_id, doc_id AS other FROM documents
          UNION
          SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
        )
        SELECT r.doc_id, coalesce(any_value(n.size), 0) AS n_shingles, min(r.other) AS component_id,
               min(r.other) = r.doc_id AS kept
        FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id
        GROUP BY r.doc_id
    """,
    "op9_chat": f"""
        WITH t AS (
          SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
          UNION ALL
          SELECT -1, k, ['user', 'assistant'][k + 1], '</s>[INST] ok [/INST]' FROM range(0, 2) AS g(k)
        ), o AS (
          SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS opens FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length({_ESCAPED.format('text')})
                 + CASE WHEN opens THEN length(role) + length('<|turn|>') + 1 + length('<|end|>') + 1
                        ELSE length('<|next|>') END) AS BIGINT) AS formatted_chars
        FROM o GROUP BY conv_id
    """,
    "op11_hard_negatives": """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                 CAST(list_dot_product(a.vector, b.vector) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE a.vec_id % 100 = 0
        ), positive AS (
          SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT p.anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
                 AS INTEGER) AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM positive p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
          AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5
    """,
    "op12_repeated_phrases": """
        WITH w AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
        ), windows AS (
          SELECT doc_id, s, array_to_string(words[s : s + 19], ' ') AS phrase
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM w)
        ), again AS (
          SELECT doc_id, s FROM windows
          QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY doc_id, s) > 1
        ), gone AS (
          SELECT doc_id, list(DISTINCT s + k) AS places FROM again, range(0, 20) AS g(k) GROUP BY doc_id
        )
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
               CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
               sha256(array_to_string(
                 list_filter(words, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' ')) AS kept_sha256
        FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id
    """,
}
