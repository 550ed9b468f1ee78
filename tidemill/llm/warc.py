"""WARC archives: written by Spark, read by a Python data source.

Records are text rows that end in two line ends, so Spark's own text writer makes the
archives, on any file system it knows and with its commit protocol. The reader plans
partitions of whole files, takes predicates on record type and headers, reads a record's
headers first, and passes over the blocks of records that nobody wants.
"""

from __future__ import annotations

import gzip
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import IO
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, LessThan, LessThanOrEqual, StringStartsWith,
)

LEAST_REVISIT = 1000
DATE = "1970-01-01T00:00:00Z"
PARTITION_BYTES = 128 << 20
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
_END = "\r\n"
_PAGE = "urn:x-page:"

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, payload_digest string, "
    "refers_to string, content_length long, payload_length long, payload binary"
)
# Header names and the revisit profile of the format.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
    "date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
    "content_length": "content-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

COLUMNS = (*HEADERS, "payload_length", "payload")


def page_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """One column ``value``: the record of each page, without the line ends behind it.

    Of equal payloads of at least 1,000 bytes the one with the largest key is a response,
    the others are revisits of it; so is every row with a null key that has such an equal.
    Rows that repeat the largest key are all responses. A null payload is empty; a null
    address is left out.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(key).cast("string").alias("id"), F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("size"),
    )
    latest = (
        rows.where(f"size >= {LEAST_REVISIT}").groupBy(F.col("digest").alias("d"))
        .agg(F.max("key").alias("latest"), F.count("*").alias("n"))
        .where("n > 1 and latest is not null").drop("n")
    )
    rows = rows.join(latest, (F.col("digest") == F.col("d")) & (F.col("size") >= LEAST_REVISIT), "left")
    again = F.col("latest").isNotNull() & ~F.col("key").eqNullSafe(F.col("latest"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit(""))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.col("size").cast("string"), F.lit(_END * 2),
    )
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    id_ = F.concat(F.lit(f"<{_PAGE}"), F.coalesce("id", F.lit("null")), F.lit(">"))
    # An address with a line end would break the header.
    address = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", id_), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", address),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(again, F.concat(F.lit(f"<{_PAGE}"), F.col("latest").cast("string"), F.lit(">")))),
        line("WARC-Profile", F.when(again, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(_END),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Writes the column ``value`` to compressed archives below ``path``."""
    records.select("value").write.option("lineSep", _END * 2).option("compression", "gzip").text(path)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return uri if not parts.scheme else unquote(parts.path) if parts.scheme == "file" else None


def _listed(uri: str) -> list[tuple[str, int]]:
    """(address, bytes) of the files below a folder, or of the file itself."""
    local = _local(uri)
    if local is not None:
        found = [os.path.join(d, f) for d, _, files in os.walk(local) for f in files] or [local] * os.path.isfile(local)
        sized = [(f, os.path.getsize(f)) for f in found]
    else:
        system, path = pyarrow.fs.FileSystem.from_uri(uri)
        infos = system.get_file_info(pyarrow.fs.FileSelector(path, recursive=True))
        parts = urlparse(uri)
        sized = [(f"{parts.scheme}://{parts.netloc}/{i.path.lstrip('/')}", i.size) for i in infos if i.is_file]
    return sorted(x for x in sized if os.path.basename(x[0])[0] not in "_.")


def _opened(uri: str) -> IO[bytes]:
    local = _local(uri)
    if local is not None:
        raw = open(local, "rb", buffering=1 << 20)
    else:
        system, path = pyarrow.fs.FileSystem.from_uri(uri)
        raw = system.open_input_file(path)
    packed = raw.read(2) == b"\x1f\x8b"
    raw.seek(0)
    return gzip.open(raw) if packed else raw


def _value(headers: dict[str, str], column: str) -> str | int | None:
    value = headers.get(HEADERS[column])
    if value is None:
        return None
    if column in ("record_id", "refers_to"):
        return value.strip("<>")
    return int(value) if column == "content_length" else value


def _holds(value, test: Filter) -> bool:
    if value is None:
        return False
    match test:
        case EqualTo():
            return value == test.value
        case In():
            return value in test.value
        case GreaterThan():
            return value > test.value
        case GreaterThanOrEqual():
            return value >= test.value
        case LessThan():
            return value < test.value
        case LessThanOrEqual():
            return value <= test.value
        case StringStartsWith():
            return value.startswith(test.value)
    return True  # IsNotNull


def _headers(file: IO[bytes]) -> dict[str, str]:
    found: dict[str, str] = {}
    while line := file.readline().rstrip(b"\r\n"):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        kinds = (EqualTo, In, IsNotNull, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith)
        for test in filters:
            if isinstance(test, kinds) and len(test.attribute) == 1 and test.attribute[0] in HEADERS:
                self.tests.append(test)
            else:
                yield test

    def partitions(self) -> list[Files]:
        """Whole files, small ones together."""
        groups: list[Files] = []
        own: list[str] = []
        room = PARTITION_BYTES
        for path, size in _listed(self.path):
            if own and size > room:
                groups.append(Files(tuple(own)))
                own, room = [], PARTITION_BYTES
            own.append(path)
            room -= size
        return [*groups, Files(tuple(own))]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64() if c.endswith("_length") else pa.string()) for c in COLUMNS[:-1]] + [("payload", pa.binary())])
        rows, size = [], 0
        for path in partition.paths:
            with _opened(path) as file:
                for row in self._records(file, path):
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield _batch(rows, schema)
                        rows, size = [], 0
        if rows:
            yield _batch(rows, schema)

    def _records(self, file: IO[bytes], path: str) -> Iterator[tuple]:
        while line := file.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record where one must begin: {path}")
            headers = _headers(file)
            left = int(headers.get("content-length", 0))
            if not all(_holds(_value(headers, t.attribute[0]), t) for t in self.tests):
                _skip(file, left)
                continue
            payload, length = None, left
            if headers.get("content-type", "").startswith("application/http"):
                start = file.readline()
                http, taken = {}, len(start)
                while (line := file.readline()).strip():
                    taken += len(line)
                    name, _, value = line.decode("latin-1").partition(":")
                    http[name.strip().lower()] = value.strip()
                left -= taken + len(line)
                length = int(http.get("content-length", left))
            if self.payload and headers.get("warc-type") != "revisit":
                payload = file.read(left)
                if len(payload) < left:
                    raise ValueError(f"the last record is cut: {path}")
            else:
                _skip(file, left)
            yield (*(_value(headers, c) for c in HEADERS), length, payload)


def _skip(file: IO[bytes], size: int) -> None:
    while size > 0:
        part = len(file.read(min(size, 1 << 20)))
        if not part:
            raise ValueError("the last record is cut")
        size -= part


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below ``path``. Comparisons of header columns with constants are pushed
    to the reader; without ``payload`` no block is decoded. ``payload_length`` is that of the
    full payload also for revisits, whose ``payload`` is null."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_of(column: str) -> Column:
    """The page key in a record's address; null if it has none."""
    return F.expr(f"try_cast(regexp_extract({column}, '^{_PAGE}(-?[0-9]+)$', 1) as bigint)")
