"""Every row with the row that follows it in the order of a key, without a global window."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import map_arrow

NO_KEY = -(1 << 63)


def cut_points(df: DataFrame, key: str, buckets: int) -> list[int]:
    """Values that cut ``df`` into at most ``buckets`` about even ranges; the first is the smallest key. The
    others need not be keys: quantiles are taken in double precision."""
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    some = F.percentile_approx(key, shares, max(10_000, 4 * buckets))
    least, cuts = df.agg(F.min(key), some).first()
    return sorted({x for x in [least, *(cuts or [])] if x is not None}) if buckets > 1 else [least or 0]


def first_keys(ranged: DataFrame) -> dict[int, tuple[int, int]]:
    """The exact first key of every range that has rows, and the range before it that has some (before the
    first of all, the last): one row for each range visits the driver."""
    firsts = sorted((r["range"], r["first"]) for r in ranged.groupBy("range").agg(F.min("key").alias("first")).collect())
    return {where: (first, firsts[i - 1][0]) for i, (where, first) in enumerate(firsts)}


def map_with_next(
    df: DataFrame, key: str, value: str, function: Callable[[object, object], tuple], schema: str, buckets: int
) -> DataFrame:
    """``function`` results for pairs of a row's and the next row's prepared value, by ascending key.

    ``function`` has two parts: ``prepare(value)`` for each row and ``pair(key, prepared, next)`` for
    each pair. Rows are dealt to ranges of the key and sorted there; the first row of a range goes to the
    last range before it that has rows as well, the first of all to the last range. Only the key visits
    the driver, as quantiles and as the first of each range. A null key comes first; rows of equal
    keys follow each other by value; the only row of a table is its own next.
    """
    prepare, pair = function
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"), F.col(value).alias("value"))
    cuts = cut_points(rows.select("key"), "key", buckets)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, np.int64), keys.to_numpy(), side="right") - 1).astype("int32")

    firsts = first_keys(rows.select("key", range_of("key").alias("range")))

    @F.pandas_udf("array<struct<range:int,guest:boolean>>")
    def places(keys: pd.Series) -> pd.Series:
        at = np.searchsorted(np.array(cuts, np.int64), keys.to_numpy(), side="right") - 1
        out = []
        for where, key in zip(at.tolist(), keys.tolist(), strict=True):
            first, before = firsts[where]
            out.append([{"range": where, "guest": False}, *([{"range": before, "guest": True}] if key == first else [])])
        return pd.Series(out)

    dealt = rows.withColumn("place", F.explode(places("key"))).select("place.range", "place.guest", "key", "value")
    ordered = dealt.repartition(buckets, "range").sortWithinPartitions("range", "guest", "key", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row that still waits for its next: (range, key, prepared)
        for batch in batches:
            out = []
            for where, guest, k, v in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if guest and (held is None or held[0] != where):
                    continue  # a second guest of equal key
                ready = prepare(v)
                if held is not None and held[0] == where:
                    out.append(pair(None if held[1] == NO_KEY else held[1], held[2], ready))
                held = None if guest else (where, k, ready)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out, strict=True)], names)

    names = [part.split()[0] for part in schema.split(", ")]
    return map_arrow(ordered, run, schema)
