"""Document fingerprints, and how they tell a document from its edited text and from its neighbour."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm import order_minhash as omh
from caseflow.llm.common import map_arrow
from caseflow.llm.neighbours import map_with_next


def fingerprint(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` with the Order MinHash of each whole text as hex, eight digits for each slot.

    A null text counts as empty; equal texts have equal fingerprints. Other columns are kept, one named
    like ``into`` is replaced.
    """
    kept = [f for f in docs.schema.fields if f.name != into]
    names = [f.name for f in kept]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            prints = [omh.as_text(omh.fingerprint(omh.code_points(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], [*names, into])

    schema = T.StructType([*kept, T.StructField(into, T.StringType())])
    return map_arrow(docs.select(*[F.col(f"`{n}`") for n in names]), run, schema)


def _prepare(text: str | None) -> tuple:
    points = omh.code_points(text)
    return points, omh.fingerprint(points)


def _pair(doc_id: int | None, own: tuple, following: tuple) -> tuple:
    points, slots = own
    half = len(points) // 2
    edited = points[: len(points) - half].tobytes() + following[0][:half].tobytes()
    edited_text = edited.decode("utf-32-le", "surrogatepass")
    edited_slots = omh.fingerprint(omh.code_points(edited_text))
    digest = hashlib.sha256(edited_text.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id, len(points), digest, omh.as_text(slots), omh.as_text(edited_slots),
        omh.likeness(slots, edited_slots), omh.likeness(slots, following[1]),
    )


def sensitivity(docs: DataFrame, buckets: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last half of its code points, rounded
    down, replaced by as many of the first of the next document (or all it has), by ascending doc_id;
    after the last comes the first. See ``map_with_next`` for null and equal doc_ids."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    given = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return map_with_next(given, "id", "text", (_prepare, _pair), schema, buckets)
