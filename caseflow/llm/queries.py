"""The operators over their whole tables, one query each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm import bpe_tree, chat, decontaminate, fingerprints, language, phrases, pitman_yor, secrets, simhash, token_alignment, token_counts, token_files, warc
from caseflow.llm.common import table
from caseflow.workspace import scratch

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
MODEL_LIMIT = 2048
SIMHASH_SHINGLE, SIMHASH_RADIUS = 3, 3


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return fingerprints.sensitivity(table(spark, sf_dir, "documents"), buckets)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_tokens(docs, folder, TOKENIZER, END_ID)
    read = token_files.read_tokens(manifest, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids_le").alias("ids_crc32"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.training_samples(docs)))
    base = F.col("base")
    return found.select(
        "doc_id",
        *[secrets.count_of(base, kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    page_id = warc.page_of(F.col("record_id")).alias("page_id")
    responses = warc.read_warc(spark, folder).filter(F.col("record_type") == "response")
    revisits = warc.read_warc(spark, folder, payload=False).filter(F.col("record_type") == "revisit")
    return responses.select(
        page_id,
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        revisits.select(
            page_id,
            F.col("payload_length").alias("payload_bytes"),
            F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
            "record_type",
            warc.page_of(F.col("refers_to")).alias("refers_to"),
        )
    )


OP5_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), q AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d, n) ELSE page_id END AS original FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM q
"""


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), SIMHASH_SHINGLE, SIMHASH_RADIUS)


def held_out(doc_id: Column) -> Column:
    """Rows that no language model may learn from; a row without an id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    test = held_out(F.col("doc_id"))
    model = language.train(docs.filter(~test).select("doc_id", "text", "lang"), PIECES)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", test.alias("held_out"), "lang_pred", "score")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_tree.encode(docs, TOKENIZER, decoded=True)
    plain_ids = F.translate(F.col("ids").cast("string"), "[],", "")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(plain_ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


OWN_CONVERSATION = "</s>[INST] ok [/INST]"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").cast(said.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(OWN_CONVERSATION).alias("text"),
    )
    messages = said.unionByName(own).withColumn("parts", chat.text_part(F.col("text")))
    formatted = chat.format_chat(messages)
    read = formatted.select(
        "conv_id", "formatted", chat.parse_chat(F.col("formatted")).alias("turns"),
        F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), chat.unescape(t["content"]), F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9_SQL = f"""
WITH m AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{OWN_CONVERSATION}'
  UNION ALL SELECT -1, 1, 'assistant', '{OWN_CONVERSATION}'
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         regexp_replace(coalesce(role, ''), '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS role_out,
         regexp_replace(coalesce(text, ''), '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS text_out
  FROM m
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text_out)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text_out)
              FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role_out) + length(text_out) + {len(chat.TURN + chat.SAYS + chat.END)}) AS BIGINT)
         AS formatted_chars
FROM t GROUP BY conv_id
"""


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, TOKENIZER)
    return counted.withColumn("over_limit", F.col("n_tokens") > MODEL_LIMIT)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), at_least=30, percent=80, top=2000)


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4)) AS lengths(m) WHERE len(w) >= m
), counted AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1 AND f >= 30
), cuts AS (
  SELECT lang, phrase, a, w, unnest(range(1, m)) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, a AS over, w, unnest(range(2, m)) AS size FROM candidates WHERE m > 2
), covers AS (
  SELECT lang, over, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM inside
), kept AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM covers o WHERE o.lang = c.lang AND o.phrase = c.phrase AND 100 * o.over >= 80 * c.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""


def op12_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", test.alias("held_out"))
    return pitman_yor.score_documents(docs, shuffle_partitions(spark))


BYTE_LEVEL, BYTE_RANKS = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_alignment.align_documents(docs, BYTE_LEVEL, BYTE_RANKS, PIECES, shuffle_partitions(spark))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_decontaminate, op2_order_minhash, op3_token_files, op4_secrets, op5_warc, op6_simhash, op7_language, op8_bpe, op9_chat, op10_token_counts, op11_phrases, op12_pitman_yor, op13_alignment)
}
ORACLE_SQL: dict[str, str] = {"op5_warc": OP5_SQL, "op9_chat": OP9_SQL, "op11_phrases": OP11_SQL}
