"""WARC archives: written by Spark's text writer, read by a Python data source.

The reader plans partitions of whole files, takes record-type and header predicates from Spark, parses
the header of each record first, and seeks past the block of any record that the predicates refuse.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
)

from caseflow.llm.common import materialise, qualified, ship, store

# Payloads from this size on are stored once; the others are all responses.
REVISIT_BYTES = 1000
CRLF = "\r\n"
HEADER_READ = 1 << 16
BATCH_BYTES = 4 << 20
PARTITION_BYTES = 32 << 20
_PAGE = "<urn:page:"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_digest string,"
    " payload_length long, payload binary"
)
# result column -> WARC header field
_FIELDS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}


# --- writing ------------------------------------------------------------------


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit(_PAGE), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def write_warc(pages: DataFrame, folder: str, written: datetime | None = None) -> None:
    """One record for each row of ``pages`` (page_id, url, html), the html as UTF-8 payload. All records bear
    the time ``written``, else that of the call, so a repeated task writes the same bytes.

    Of rows with equal payloads of REVISIT_BYTES or more, those with the largest page_id are
    responses and the others revisits that refer to it; all else are responses. A null html is an empty
    payload; line breaks in a url are escaped; a null url is left out. Spark commits the files, so
    a lost executor leaves no half-written archive. An empty table gives no record.
    """
    moment = (written or datetime.now(UTC)).astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("size"),
        F.sha1(html.cast("binary")).alias("digest"),
    )
    large = rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size")
    repeated = large.agg(F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1")
    repeated = materialise(repeated.select(F.col("digest").alias("key"), "original"), "repeated")
    # small payloads look nothing up; a key of their own spreads them
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    keyed = rows.withColumn("key", F.when(F.col("size") >= REVISIT_BYTES, F.col("digest")).otherwise(alone))
    marked = keyed.join(repeated, "key", "left")
    revisit = F.coalesce(F.col("original") > F.col("page_id"), F.lit(False))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("size").cast("string"), F.lit(CRLF + CRLF),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    nothing = F.lit("")
    record = F.concat(
        F.lit("WARC/1.1" + CRLF),
        field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", _record_id(F.col("page_id"))),
        field("WARC-Date", F.lit(moment)),
        F.when(F.col("url").isNull(), nothing).otherwise(field("WARC-Target-URI", F.col("url"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("X-Payload-Length", F.col("size").cast("string")),
        F.when(
            revisit,
            F.concat(
                field("WARC-Refers-To", _record_id(F.col("original"))),
                field("WARC-Profile", F.lit(_REVISIT_PROFILE)),
            ),
        ).otherwise(nothing),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
    )
    marked.select(record.alias("value")).write.option("lineSep", CRLF + CRLF).text(folder)


# --- reading ------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass(frozen=True)
class HeaderTest:
    """A predicate on one header field: a value among some, a prefix, or being there."""

    column: str
    values: frozenset | None = None
    prefix: str | None = None

    def passes(self, value: str | None) -> bool:
        if value is None:
            return False
        if self.values is not None:
            return value in self.values
        return self.prefix is None or value.startswith(self.prefix)


def parse_header(block: bytes) -> dict[str, str]:
    """Fields of a record header by lower-case name; a folded line continues the one above."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", block).split(b"\r\n")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return fields


class _Window:
    """Sequential bytes of a file; what is skipped is not read."""

    def __init__(self, file) -> None:
        self.file, self.size = file, file.size()
        self.begin, self.held = 0, b""

    def upto(self, begin: int, mark: bytes) -> int:
        """Position of ``mark`` from ``begin`` on; -1 at the end of the file."""
        span = HEADER_READ
        while True:
            at = self.bytes(begin, min(span, self.size - begin)).find(mark)
            if at >= 0:
                return begin + at
            if begin + span >= self.size:
                return -1
            span *= 2

    def bytes(self, begin: int, n: int) -> bytes:
        offset = begin - self.begin
        if offset < 0 or offset + n > len(self.held):
            self.file.seek(begin)
            self.begin, self.held, offset = begin, self.file.read(max(n, min(HEADER_READ, self.size - begin))), 0
        return self.held[offset : offset + n]


def records(file, tests: Iterable[HeaderTest], payload: bool) -> Iterator[tuple]:
    """Rows of one archive whose header passes all tests."""
    window, at = _Window(file), 0
    tests = list(tests)
    while at < window.size:
        if window.bytes(at, 2) == b"\r\n":  # between records
            at += 2
            continue
        end = window.upto(at, b"\r\n\r\n")
        if end < 0:
            raise ValueError(f"record without header end at byte {at}")
        header = window.bytes(at, end - at)
        if not header.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = parse_header(header)
        if not fields.get("content-length", "").isdecimal():
            raise ValueError(f"record without length at byte {at}")
        length = int(fields["content-length"])
        begin, at = end + 4, end + 4 + length
        row = {column: fields.get(name) for column, name in _FIELDS.items()}
        if not all(t.passes(row[t.column]) for t in tests):
            continue
        content = None
        if payload and row["record_type"] != "revisit":
            content = window.bytes(begin, length)
            if "application/http" in fields.get("content-type", ""):
                content = content.partition(b"\r\n\r\n")[2]
        size = fields.get("x-payload-length")
        yield (*row.values(), int(size) if size else None, content)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[HeaderTest] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in _FIELDS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append(HeaderTest(column, frozenset([f.value])))
            elif isinstance(f, In):
                self.tests.append(HeaderTest(column, frozenset(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append(HeaderTest(column, prefix=f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append(HeaderTest(column))
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Whole files, packed in order of name up to the partition size."""
        files_at, path = store(self.folder)
        found = files_at.get_file_info(arrow_fs.FileSelector(path, recursive=False))
        files = [
            f for f in found
            if f.type == arrow_fs.FileType.File and f.size and not f.base_name.startswith(("_", "."))
        ]
        packed: list[Files] = []
        room = 0
        for f in sorted(files, key=lambda f: f.path):
            if not packed or room < f.size:
                packed.append(Files([]))
                room = self.partition_bytes
            packed[-1].paths.append(f.path)
            room -= f.size
        return packed or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        files_at, _ = store(self.folder)
        rows: list[tuple] = []
        size = 0
        for path in partition.paths:
            with files_at.open_input_file(path) as file:
                for row in records(file, self.tests, self.payload):
                    rows.append(row)
                    size += 200 + len(row[-1] or b"")
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


_ARROW = pa.schema(
    [*[(c, pa.string()) for c in _FIELDS], ("payload_length", pa.int64()), ("payload", pa.binary())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` of a folder with its scheme; option ``payload`` false reads headers only, option
    ``partitionBytes`` bounds the files of a partition."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})


def read_warc(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Records of the archives in ``folder``. Predicates on record_type, record_id, target_uri,
    refers_to and payload_digest reach the reader; the session setting that allows it is switched on.
    Revisits and header-only reads have a null payload."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(qualified(spark, folder))


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"<urn:page:(-?\d+)>", 1).try_cast("long")
