"""SimHash near-duplicates by exact comparison in tiles.

Two fingerprints within a radius differ by at most that radius in the sum, over any cut into words of
bits, of the differences of the words' population counts. Distinct fingerprints are put into tiles by
the counts of their four 16-bit words, and only tiles whose counts lie within the radius meet; there
every pair is compared by exclusive-or and bit counts. No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import map_arrow, materialise, text_bytes, without_caches
from caseflow.llm.components import connected_components

SEED = 42
WORDS = 4
WORD_BITS = 16
# Fingerprints of a tile, about; a larger one is split by hash. Pairs held at once in a comparison.
TILE = 4096
HELD_PAIRS = 1 << 20
SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of the word shingles, repeats included: bit i is set where more than half of the
    shingles' XXH64 values have it. No word gives 0; fewer words than a shingle are one shingle."""
    words = text.lower().split()  # lower() and split() of bytes know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    k = min(shingle, len(words))
    begins, ends = (ends - sizes)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(ends), SHINGLES_AT_ONCE):
        spans = zip(begins[at : at + SHINGLES_AT_ONCE], ends[at : at + SHINGLES_AT_ONCE], strict=True)
        values = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(ends), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_caches("simhash")
        for batch in batches:
            values = [fingerprint(t, shingle) for t in text_bytes(batch.column(1))]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(given, run, "doc_id long, fp long")


def with_fingerprints(docs: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """``docs`` with ``fp`` of every whole text; other columns are kept, one named ``fp`` is replaced."""
    kept = [f for f in docs.schema.fields if f.name != "fp"]
    names = [f.name for f in kept]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_caches("simhash")
        for batch in batches:
            values = [fingerprint(t, shingle) for t in text_bytes(batch.column(at))]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, fps], [*names, "fp"])

    schema = T.StructType([*kept, T.StructField("fp", T.LongType())])
    return map_arrow(docs.select(*[F.col(f"`{n}`") for n in names]), run, schema)


def _offsets(radius: int) -> list[list[int]]:
    """Differences of the words' counts within the radius, one of each pair of opposite ones."""
    steps = range(-radius, radius + 1)
    near = [o for o in product(steps, repeat=WORDS) if sum(map(abs, o)) <= radius]
    return [list(o) for o in near if o >= (0,) * WORDS]


def _roots(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> np.ndarray:
    """For a and b laid end to end, the first member of each one's component under links a-b
    (inside a where ``same``): as many as there are fingerprints, however many pairs link."""
    root = np.arange(len(a) if same else len(a) + len(b))
    shift = 0 if same else len(a)
    rows = max(1, HELD_PAIRS // max(1, len(b)))
    for at in range(0, len(a), rows):
        near = np.bitwise_count(a[at : at + rows, None] ^ b[None, :]) <= radius
        u, v = np.nonzero(near)
        u, v = u + at, v + shift
        while len(u):
            x, y = root[u], root[v]
            apart = x != y
            u, v, x, y = u[apart], v[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root != (up := root[root])).any():
                root = up
    return root


def links(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` as all pairs within ``radius`` would:
    each tile pair returns a spanning forest of its links, never all pairs of a group."""
    words = [F.shiftrightunsigned("fp", WORD_BITS * i).bitwiseAND((1 << WORD_BITS) - 1) for i in range(WORDS)]
    placed = distinct.select("fp", F.array(*[F.bit_count(w) for w in words]).alias("counts"))
    # at most 17^4 tiles, however many fingerprints
    sizes = placed.groupBy("counts").agg(F.ceil(F.count("*") / F.lit(tile)).alias("blocks"))
    split = placed.join(F.broadcast(sizes), "counts")
    tiles = materialise(
        split.groupBy("counts", F.expr("pmod(xxhash64(fp), blocks)").alias("block")).agg(
            F.collect_list("fp").alias("fps")
        ),
        "tiles",
    )
    offsets = F.array(*[F.array(*[F.lit(x) for x in o]) for o in _offsets(radius)])
    left = tiles.select(
        F.col("counts").alias("own"), F.col("block").alias("a_block"), F.col("fps").alias("a"),
        F.explode(offsets).alias("offset"),
    ).withColumn("counts", F.zip_with("own", "offset", lambda c, o: c + o))
    pairs = left.join(tiles.withColumnsRenamed({"block": "b_block", "fps": "b"}), "counts")
    pairs = pairs.withColumn("inside", F.col("own") == F.col("counts"))
    pairs = pairs.filter("not inside or a_block <= b_block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_caches("simhash")
        for batch in batches:
            found = []
            for a, b, same in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                a = a.values.to_numpy(zero_copy_only=False).view(np.uint64)
                b = b.values.to_numpy(zero_copy_only=False).view(np.uint64)
                root = _roots(a, b, same, radius)
                own = a if same else np.concatenate([a, b])
                (at,) = np.nonzero(root != np.arange(len(root)))
                if len(at):
                    found.append(np.stack([own[root[at]], own[at]]))
            linked = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in linked], ["a", "b"])

    chosen = pairs.select("a", "b", (F.col("inside") & (F.col("a_block") == F.col("b_block"))).alias("same"))
    return map_arrow(chosen, run, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int, radius: int, doc_id: str = "doc_id", text: str = "text", tile: int = TILE
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id: the smallest doc_id reachable over links
    between fingerprints at most ``radius`` bits apart, itself included.

    Copies collapse to one fingerprint before any comparison. A repeated row comes back repeated; a row
    with a null doc_id is linked like any other but never names its component unless all its members
    lack one. An empty table gives no rows; other columns of ``docs`` are not read.
    """
    prints = materialise(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(links(distinct, radius, tile)).withColumnRenamed("node", "fp")
    members = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = members.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = members.join(named, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(
    docs: DataFrame, shingle: int, radius: int, doc_id: str = "doc_id", text: str = "text", tile: int = TILE
) -> DataFrame:
    """One row of each component of near-duplicates, whatever its doc_id: the first by doc_id (nulls last),
    then text, then the other columns as they stand.

    Rows of one fingerprint collapse within tasks before anything is shuffled; only linked fingerprints
    are compared again by component.
    """
    names = docs.columns
    others = [F.col(f"`{n}`").alias(n) for n in names if n not in (doc_id, text)]
    order = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id), F.col(text), *others)
    rows = with_fingerprints(docs, shingle, text).select("fp", order.alias("row"))
    best = materialise(rows.groupBy("fp").agg(F.min("row").alias("row")), "first-rows")
    roots = connected_components(links(best.select("fp"), radius, tile)).withColumnRenamed("node", "fp")
    alone = best.join(roots, "fp", "left_anti").select("row")
    linked = best.join(roots, "fp").groupBy("root").agg(F.min("row").alias("row")).select("row")
    return alone.unionByName(linked).select(*[F.col("row").getField(n).alias(n) for n in names])
