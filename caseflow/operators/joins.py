"""Lookup and relationship joins that hold up under NULL and hot keys.

No broadcast is forced on a table that grows with the data: Spark broadcasts a lookup side
below its size threshold by itself. Beyond it the join shuffles, and AQE splits the hot
partitions of the row side; NULL keys, which can never match, are spread here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 4096


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    spread_by: str,
    condition: Column | None = None,
) -> DataFrame:
    """``rows`` left-joined to ``lookup`` on text keys; unmatched rows keep NULLs.

    Rows with a NULL key would all hash to one partition. A second join key replaces NULL by
    one of many texts drawn from ``spread_by``, so they spread; the plain key comparison
    stays, so such a text can never match.
    """
    filler = F.concat(
        F.lit("none-"), F.pmod(F.xxhash64(spread_by), F.lit(NULL_SPREAD)).cast("string")
    )
    on = (F.col(key) == F.col(lookup_key)) & (F.coalesce(F.col(key), filler) == F.col(lookup_key))
    if condition is not None:
        on = on & condition
    return rows.join(lookup, on, "left")


def unmatched_counts(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows per child key that no parent has, the NULL key included.

    The child is counted per key before any join, so a hot key is one row by then.
    """
    keys = child.groupBy(F.col(fk).alias("fk")).agg(F.count("*").alias("row_count"))
    return keys.join(parent.select(F.col(pk).alias("pk")), F.col("fk") == F.col("pk"), "left_anti")
