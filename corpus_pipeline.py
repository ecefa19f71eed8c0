"""A training corpus from raw documents, in five stages.

Language ID, near-duplicates, benchmark passages, secrets, tokens. ``run`` writes every stage's result to
the shared folder and reads it back as the documents of the next, so a lost executor costs a re-read of
one stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm import bpe_tree, decontaminate, language, secrets, simhash
from caseflow.llm.common import DOCUMENT_COLUMNS, materialise, table
from caseflow.llm.queries import PIECES, SIMHASH_RADIUS, SIMHASH_SHINGLE, TOKENIZER, held_out

# A document is rejected if its best language is less likely than all others together.
MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without text or a letter go, and those whose best learned language is
    less likely than all others together. That is relative: a longer text in a language that was not
    learned, or of letter junk, usually stays under the least unlikely one, and a short text that several
    languages share may go."""
    model = language.train(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), PIECES)
    found = language.identify(docs.select(*DOCUMENT_COLUMNS), model)
    kept = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
    return found.filter(kept).select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the one with the smallest doc_id, rows without one last, then by text and the
    other columns. Rows of different groups stay, whether they share a doc_id or have none."""
    return simhash.representatives(docs.select(*DOCUMENT_COLUMNS), SIMHASH_SHINGLE, SIMHASH_RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.uncontaminated(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced in the text and n_chars counted again."""
    ratios = secrets.train(secrets.training_samples(docs))
    hidden = secrets.redact(secrets.scan(docs.select(*DOCUMENT_COLUMNS), ratios))
    return hidden.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the digest of the decoded text."""
    given = docs.select("doc_id", "lang", "source", "text")
    coded = bpe_tree.encode(given, TOKENIZER, decoded=True)
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Fingerprints, segmentations and merges are beyond SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None
