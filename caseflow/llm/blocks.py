"""Arrays of many rows as one value, so that a shuffle moves blocks rather than rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from caseflow.llm.common import map_arrow

_FAST = zstandard.ZstdCompressor(level=1)


def narrow(values: np.ndarray) -> np.ndarray:
    """Unsigned whole numbers in the narrowest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0), copy=False)


def pack(*arrays: np.ndarray) -> bytes:
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return _FAST.compress(len(head).to_bytes(4, "little") + head + body)


def unpack(block: bytes) -> list[np.ndarray]:
    held = zstandard.decompress(block)
    at = 4 + int.from_bytes(held[:4], "little")
    found = []
    for part in held[4:at].decode().split(";"):
        kind, n = part.split(",")
        found.append(np.frombuffer(held, kind, int(n), at))
        at += found[-1].nbytes
    return found


def chunk_numbers() -> Iterator[int]:
    """Numbers that no other task of the stage gives, the same when a task runs again."""
    task = TaskContext.get()
    first = (task.partitionId() if task else 0) << 32
    while True:
        yield first
        first += 1


def runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal neighbours begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def batches(rows: list[dict], schema: pa.Schema, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """``rows`` as batches of about ``limit`` bytes of binary values."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, bytes))
        if size >= limit or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


SUMS = "chunk long, sums binary"
SUMS_ARROW = pa.schema([("chunk", pa.int64()), ("sums", pa.binary())])


def document_sums(blocks: DataFrame, names: dict[str, str]) -> DataFrame:
    """``chunk, at`` and a sum for each of ``names`` (name to type), from blocks of (documents, a value of each name).

    The blocks of a chunk meet at one task, and what is there are as many numbers as its documents.
    """
    kinds = {"long": np.int64, "double": np.float64}
    schema = "chunk long, at int, " + ", ".join(f"{name} {kind}" for name, kind in names.items())

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in given:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                docs, *values = unpack(packed)
                sums = held.setdefault(chunk, [np.zeros(0, np.int64), *(np.zeros(0, kinds[k]) for k in names.values())])
                if (missing := int(docs[-1]) + 1 - len(sums[0])) > 0:
                    sums[:] = [np.concatenate([x, np.zeros(missing, x.dtype)]) for x in sums]
                sums[0][docs] = 1
                for total, value in zip(sums[1:], values, strict=True):
                    total[docs] += value
        for chunk, (present, *values) in held.items():
            at = np.flatnonzero(present)
            columns = [np.full(len(at), chunk, np.int64), at.astype(np.int32), *(v[at] for v in values)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "at", *names])

    return map_arrow(blocks.repartition("chunk"), run, schema)
