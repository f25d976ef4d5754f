"""WARC archives: written by Spark, read through a Python data source.

Writing needs no Python: a record is a line of text for Spark's text writer, with the
blank lines that end a record as line separator. Payloads that repeat are written
once; the others become revisit records that refer to it.

Reading plans a partition for each archive file and passes over a file record by
record: headers are parsed first, filters on header columns are applied, and the
payload of an unwanted record is skipped by its length without being read. Payloads
are decoded only with the option `payload`.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import Any, BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

LEAST_BYTES = 100  # shorter payloads are never replaced by a revisit record
SALTS = 32  # rows of one payload are spread over so many groups
FILE_RECORDS = 20_000
EPOCH = "1970-01-01T00:00:00Z"  # pages carry no time of capture
BATCH_BYTES = 4 << 20

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, "
    "payload_length bigint, content_length bigint, payload binary, sha256 string"
)
# Header names.
HEADERS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "payload_length": "x-payload-length",
    "content_length": "content-length",
}
NUMBERS = ("payload_length", "content_length")


# Writing ---------------------------------------------------------------------


def with_revisits(pages: DataFrame) -> DataFrame:
    """`pages(page_id, url, html)` with `payload`, `digest`, `size` and `first`: the page that a revisit refers to.

    Among payloads that are equal and long enough the least page_id is the response;
    a null page_id is a response always, and rows that share the least id all are.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).select(
        "*", F.sha2(F.encode("payload", "UTF-8"), 256).alias("digest"), F.octet_length("payload").cast("bigint").alias("size"))
    long = rows.filter((F.col("size") >= LEAST_BYTES) & F.col("page_id").isNotNull())
    repeated = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first < last")
    # A payload of many pages is cut by page, so each group of the join is small.
    spread = repeated.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(spread, ["digest", "salt"], "left")
    revisit = F.col("page_id").isNotNull() & (F.col("page_id") > F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", "size", F.when(revisit, F.col("first")).alias("first"))


def _id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line; without a value none. Control characters would end the line and are escaped."""
    clean = F.regexp_replace(value, r"[\x00-\x1F\x7F]", "%20")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))).otherwise("")


def as_records(rows: DataFrame, date: str = EPOCH) -> DataFrame:
    """One text per row of `with_revisits`: header and payload of a WARC record."""
    revisit = F.col("first").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    kind = F.when(revisit, "revisit").otherwise("response")
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", _id(F.col("page_id"))),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Refers-To", F.when(revisit, _id(F.col("first")))),
        _header("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("X-Payload-Length", F.col("size").cast("string")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
        body,
    ).alias("value"))


def write_warc(pages: DataFrame, path: str, date: str = EPOCH, compression: str = "none") -> None:
    writer = as_records(with_revisits(pages), date).write.option("lineSep", "\r\n\r\n").option("compression", compression)
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(path)


# Reading ---------------------------------------------------------------------


class File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def _test(filter_: Filter):
    """A test on parsed headers for a filter on a header column; None if it isn't one."""
    name = filter_.attribute[0] if len(getattr(filter_, "attribute", ())) == 1 else None
    if name not in HEADERS:
        return None
    tests = {
        EqualTo: lambda x, v: x is not None and x == v, EqualNullSafe: lambda x, v: x == v,
        In: lambda x, v: x is not None and x in v, GreaterThan: lambda x, v: x is not None and x > v,
        GreaterThanOrEqual: lambda x, v: x is not None and x >= v, LessThan: lambda x, v: x is not None and x < v,
        LessThanOrEqual: lambda x, v: x is not None and x <= v, StringStartsWith: lambda x, v: x is not None and x.startswith(v),
    }
    if isinstance(filter_, IsNotNull):
        return name, lambda x: x is not None
    if isinstance(filter_, IsNull):
        return name, lambda x: x is None
    test = tests.get(type(filter_))
    return test and (name, lambda x, v=filter_.value: test(x, v))


def records(source: BinaryIO, wanted, payload: bool, digest: bool) -> Iterator[dict[str, Any]]:
    """Records whose headers pass `wanted`; other payloads are skipped unread."""
    while True:
        line = source.readline()
        while line in (b"\r\n", b"\n"):
            line = source.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        found = {}
        while (line := source.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            found[name.strip().lower()] = value.strip()
        row: dict[str, Any] = {k: found.get(h) for k, h in HEADERS.items()}
        for k in NUMBERS:
            row[k] = int(row[k]) if row[k] is not None else None
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].partition(":")[2] or row["payload_digest"]
        length = row["content_length"] or 0
        if not wanted(row):
            source.seek(length, 1)
            continue
        row["payload"] = row["sha256"] = None
        if payload or digest:
            if payload:
                row["payload"] = body = source.read(length)
                row["sha256"] = hashlib.sha256(body).hexdigest() if digest else None
            else:
                total, left = hashlib.sha256(), length
                while left:
                    piece = source.read(min(left, 1 << 20))
                    if not piece:
                        raise ValueError("the archive ends inside a record")
                    total.update(piece)
                    left -= len(piece)
                row["sha256"] = total.hexdigest()
        else:
            source.seek(length, 1)
        yield row


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "false").lower() == "true"
        self.digest = options.get("digest", "false").lower() == "true"
        self.tests: list[tuple[str, Any]] = []

    def pushFilters(self, filters: list[Filter]):
        for filter_ in filters:
            test = _test(filter_)
            if test is None:
                yield filter_
            else:
                self.tests.append(test)

    def partitions(self) -> list[InputPartition]:
        store, root = _store(self.path)
        if store.get_file_info(root).type == fs.FileType.File:
            return [File(self.path)]
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        names = [f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
        prefix = self.path[: len(self.path) - len(root)] if self.path.endswith(root) else self.path.partition("/")[0] + "//"
        return [File(prefix + n) for n in sorted(names)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(k, pa.int64() if k in NUMBERS else pa.string()) for k in HEADERS] + [("payload", pa.binary()), ("sha256", pa.string())])
        kinds = pa.schema([kinds.field(n) for n in (
            "record_id", "record_type", "target_uri", "date", "payload_digest", "refers_to", "payload_length", "content_length", "payload", "sha256")])
        store, path = _store(partition.value)
        tests = self.tests
        rows, size = [], 0
        with store.open_input_file(path) as raw:
            source = gzip.open(raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
            for row in records(source, lambda r: all(t(r[n]) for n, t in tests), self.payload, self.digest):
                rows.append(row)
                size += 500 + len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, kinds)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))


def read_warc(spark, path: str, payload: bool = False, digest: bool = False) -> DataFrame:
    """Records below `path`: headers, and on demand the payload and its SHA-256."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload)).option("digest", str(digest)).load(path)


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")


def archived_pages(spark, path: str) -> DataFrame:
    """What the archives say of each page; digests of responses are computed from the payloads read back."""
    full = read_warc(spark, path, digest=True).filter("record_type = 'response'")
    short = read_warc(spark, path).filter("record_type = 'revisit'")

    def told(rows: DataFrame, size: str, digest: str) -> DataFrame:
        return rows.select(
            page_of(F.col("record_id")).alias("page_id"), F.col(size).alias("payload_bytes"), F.col(digest).alias("payload_digest"),
            "record_type", page_of(F.col("refers_to")).alias("refers_to"))

    return told(full, "content_length", "sha256").unionByName(told(short, "payload_length", "payload_digest"))
