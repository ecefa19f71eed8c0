"""RAW landing: delimited text to all-string tables, without losing damaged rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.functions.text import clean_strings, null_if_token
from caseflow.functions.time import ntz

CORRUPT = "_corrupt_record"

# Columns bind by position under a skipped header; short rows are padded with NULL and
# extra fields ignored. Doubled quotes escape a quote, so a backslash is plain text.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "enforceSchema": "true",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def read_text_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, multi_line: bool = False
) -> DataFrame:
    """The rows as text, with ``_corrupt_record`` holding the line of each damaged row.

    Column pruning in the parser is off: with it, whether a row counts as damaged would
    depend on which columns a query happens to read.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .options(**CSV_OPTIONS)
        .option("header", header)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")
        .csv(path)
    )


def broken_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, odd_lines`` of the files with lines whose quotes do not pair up.

    A line break inside a quoted field leaves such a line before and after it, so an even number of them says
    that the file has such fields. An odd number says that a quote is missing somewhere. The scan only counts; it
    is split like any other text, and sends a row for each file that has such lines.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (quotes % 2).alias("odd"))
    return lines.filter("odd = 1").groupBy("file").agg(F.count("*").alias("odd_lines"))


def read_quoted_rows(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """:func:`read_text_rows` with line breaks inside quoted fields, and ``_source_file``.

    Only files that have such fields are read whole, one task each; all others in splits. A file in which a quote
    is missing is read by lines, so that the quote spoils its row and not all that follow; its cut rows are
    damaged ones.
    """
    spanning = sorted(r["file"] for r in broken_lines(spark, path).filter("odd_lines % 2 = 0").toLocalIterator())
    file = F.col("_metadata.file_path")
    names = [*schema.names, CORRUPT]
    rows = read_text_rows(spark, path, schema).select(*names, file.alias("_source_file"))
    if not spanning:
        return rows
    whole = read_text_rows(spark, spanning, schema, multi_line=True).select(*names, file.alias("_source_file"))
    return rows.filter(~F.col("_source_file").isin(spanning)).unionByName(whole)


def with_audit(rows: DataFrame, run_ts: datetime, source_file) -> DataFrame:
    return rows.withColumns(
        {"_loaded_at": ntz(run_ts), "_source_file": source_file}
    )


def land(rows: DataFrame, run_ts: datetime, source_file) -> DataFrame:
    """Normalise NULL tokens and add the ingestion columns."""
    return with_audit(clean_strings(rows), run_ts, source_file)


def land_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, run_ts: datetime, keep_damaged: bool = False
) -> DataFrame:
    """Land delimited files; damaged rows load too, as far as they could be read, and with ``keep_damaged`` the
    text of their line beside them. Quoted fields may hold line breaks. No file gives no row."""
    if path:
        rows = read_quoted_rows(spark, path, schema)
    else:
        empty = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in (CORRUPT, "_source_file")]])
        rows = spark.createDataFrame([], empty)
    kept = [F.col(CORRUPT)] if keep_damaged else []
    cleaned = rows.select(*[null_if_token(F.col(c)).alias(c) for c in schema.names], *kept, "_source_file")
    return with_audit(cleaned, run_ts, F.col("_source_file"))


def quarantine(rows: DataFrame) -> DataFrame:
    """Only the damaged rows of :func:`read_text_rows`, with the text of their line."""
    return rows.filter(F.col(CORRUPT).isNotNull())


def feed_name(source_file):
    """Name of the feed a part file belongs to: the folder that holds it."""
    return F.regexp_extract(source_file, r"([^/]+)/[^/]+$", 1)


def load_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and source file."""
    parts = [
        df.groupBy("_source_file")
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("tbl"), "_source_file", "row_count")
        for name, df in tables.items()
    ]
    audit = parts[0]
    for part in parts[1:]:
        audit = audit.unionByName(part)
    return audit


def load_counts(landed: dict[str, DataFrame], damaged: dict[str, DataFrame]) -> DataFrame:
    """Rows and damaged lines per table and source file."""
    lines = load_audit(damaged).withColumnRenamed("row_count", "damaged_lines")
    counts = load_audit(landed).join(lines, ["tbl", "_source_file"], "left")
    return counts.withColumn("damaged_lines", F.coalesce("damaged_lines", F.lit(0).cast("long")))
