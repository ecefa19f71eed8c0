"""Text normalisation columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.schemas import NULL_TOKENS


def null_if_token(col: Column, tokens=NULL_TOKENS) -> Column:
    """Trim surrounding spaces, then read the NULL tokens as NULL."""
    trimmed = F.trim(col)
    return F.when(trimmed.isin(*tokens), F.lit(None)).otherwise(trimmed)


def clean_strings(df: DataFrame) -> DataFrame:
    """Apply :func:`null_if_token` to every string column, in one projection."""
    return df.select(
        *[
            null_if_token(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
