"""WARC (op 4): archives as a PySpark Python data source, read and written.

`spark.read.format("warc")` plans partitions of whole files of about the same bytes. Predicates on the record type, the ids, the
target and the digest are pushed down; a record's header is parsed first, and the block of a record that a predicate
excludes is not read but passed over. Payloads are decoded only if the schema asks for `payload`: give a schema without it
to read headers alone. Files may be plain or compressed record by record (.gz); other files are ignored.

`df.write.format("warc")` takes the columns record_id, record_type, target_uri, refers_to, payload_digest, payload_bytes, payload.
Each task writes files of about `FILE_BYTES` under names of their own; the commit writes the list of the files of successful
tasks, and readers open only listed files, so that tasks done twice leave no records. A record is a WARC/1.1 record with
an HTTP response as its block; a revisit's block is the HTTP header alone, which keeps the payload's length.

Paths are those that pyarrow's file systems know (file, hdfs, s3, gs, ...). Line breaks in header values are percent-encoded.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from casemart.llm.common import shared_folder, stored

FILE_BYTES = 64 << 20
PARTITION_BYTES = 64 << 20
#: Each commit writes a listing of its own, `_files-<hex>.json`; readers take the files of all.
LISTING = "_files"
SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, "
    "headers map<string,string>, payload binary"
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_SHARED = 1000  # bytes of a payload that is stored once

#: The header that holds each column.
HEADER = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _safe(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _to_header(column: str, value: str) -> str:
    return f"sha1:{value}" if column == "payload_digest" else f"<{_safe(value)}>" if column in ("record_id", "refers_to") else _safe(value)


def _from_header(column: str, value: str) -> str:
    return value.removeprefix("sha1:") if column == "payload_digest" else value.strip("<>") if column in ("record_id", "refers_to") else value


def record_bytes(row: dict) -> bytes:
    """One record. payload None: nothing but the HTTP header."""
    payload = row["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    head = ["WARC/1.1", "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response"]
    head += [f"{HEADER[c]}: {_to_header(c, row[c])}" for c in HEADER if row[c] is not None]
    if row["record_type"] == "revisit":
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
    head.append(f"Content-Length: {len(http) + len(payload or b'')}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + (payload or b"") + b"\r\n\r\n"


def _headers(file) -> tuple[str, dict[str, str]] | None:
    """The first line and the named fields up to a blank line; None at the end of the file."""
    line = file.readline()
    while line in (b"\r\n", b"\n"):
        line = file.readline()
    if not line:
        return None
    first, fields, last = line.decode("utf-8", "replace").strip(), {}, ""
    while (line := file.readline().decode("utf-8", "replace").rstrip("\r\n")):
        if line[0] in " \t":  # a folded line
            fields[last] += " " + line.strip()
            continue
        last, _, value = line.partition(":")
        fields[last] = value.strip()
    return first, fields


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], partition_bytes: int):
        self.path, self.columns, self.partition_bytes = path, columns, partition_bytes
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps what headers can answer; gives the rest back to Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADER and isinstance(f, EqualTo):
                self.wanted.append((column, "in", {f.value}))
            elif column in HEADER and isinstance(f, In):
                self.wanted.append((column, "in", set(f.value)))
            elif column in HEADER and isinstance(f, StringStartsWith):
                self.wanted.append((column, "starts", f.value))
            elif column in HEADER and isinstance(f, IsNotNull):
                self.wanted.append((column, "there", None))
            else:
                yield f

    def _passes(self, fields: dict[str, str]) -> bool:
        for column, test, value in self.wanted:
            there = fields.get(HEADER[column])
            if there is None:
                return False
            own = _from_header(column, there)
            if test == "in" and own not in value or test == "starts" and not own.startswith(value):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        fs, path = _place(self.path)
        if fs.get_file_info(path).type == pafs.FileType.File:
            infos = [fs.get_file_info(path)]
        elif listings := _listings(fs, path):
            names = []
            for listing in listings:
                with fs.open_input_stream(listing) as f:
                    names += json.loads(f.read())
            infos = fs.get_file_info([f"{path}/{name}" for name in names])
        else:
            infos = [i for i in fs.get_file_info(pafs.FileSelector(path, recursive=True)) if i.path.endswith((".warc", ".warc.gz"))]
        out, held = [], 0
        for info in sorted(infos, key=lambda i: (-(i.size or 0), i.path)):
            if not out or held + info.size > self.partition_bytes:
                out.append(Files([]))
                held = 0
            out[-1].paths.append(info.path)
            held += info.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        fs, _ = _place(self.path)
        for path in partition.paths:
            if path.endswith(".gz"):
                with fs.open_input_stream(path, compression=None) as raw, gzip.open(raw, "rb") as file:
                    yield from self._records(file)
            else:
                with fs.open_input_file(path) as raw:
                    yield from self._records(io.BufferedReader(raw, 1 << 18))

    def _records(self, file) -> Iterator[tuple]:
        while (head := _headers(file)) is not None:
            first, fields = head
            if not first.startswith("WARC/"):
                raise ValueError(f"not a WARC record: {first[:80]!r}")
            start, length = file.tell(), int(fields["Content-Length"])
            if self._passes(fields):
                yield self._row(fields, file, start + length)
            file.seek(start + length)

    def _row(self, fields: dict[str, str], file, end: int) -> tuple:
        size, payload = None, None
        if "payload" in self.columns or "payload_bytes" in self.columns:
            if fields.get("Content-Type", "").startswith("application/http"):
                _, http = _headers(file)
                size = int(http["Content-Length"]) if "Content-Length" in http else end - file.tell()
            else:
                size = end - file.tell()
            if "payload" in self.columns and fields.get(HEADER["record_type"]) != "revisit":
                payload = file.read(end - file.tell())
        row = {c: _from_header(c, fields[h]) if h in fields else None for c, h in HEADER.items()}
        row |= {"payload_bytes": size, "headers": fields, "payload": payload}
        return tuple(row[c] for c in self.columns)


def _listings(fs: pafs.FileSystem, path: str) -> list[str]:
    """The listings of all commits to a folder."""
    infos = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return [i.path for i in infos if i.base_name.startswith(LISTING) and i.base_name.endswith(".json")]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, file_bytes: int, gz: bool, overwrite: bool = False):
        self.path, self.file_bytes, self.gz, self.overwrite = path, file_bytes, gz, overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, path = _place(self.path)
        fs.create_dir(path, recursive=True)
        names, file, size = [], None, 0
        for batch in batches:
            for row in batch.to_pylist():
                record = record_bytes(row)
                record = gzip.compress(record, 6, mtime=0) if self.gz else record
                if file is not None and size + len(record) > self.file_bytes:
                    file.close()
                    file = None
                if file is None:
                    names.append(f"{uuid.uuid4().hex}.warc{'.gz' * self.gz}")
                    file, size = fs.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                file.write(record)
                size += len(record)
        if file is not None:
            file.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = _place(self.path)
        fs.create_dir(path, recursive=True)
        before = _listings(fs, path) if self.overwrite else []
        with fs.open_output_stream(f"{path}/{LISTING}-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps([name for m in messages if m for name in m.paths]).encode())
        for listing in before:
            fs.delete_file(listing)

    def abort(self, messages: list[Written | None]) -> None:
        """Files of a failed write stay unlisted: no reader opens them."""


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema.fieldNames(), int(self.options.get("partitionBytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("fileBytes", FILE_BYTES)), self.options.get("compression") == "gzip", overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """Records of pages (page_id, url, html) as the writer takes them.

    Of equal payloads of at least least_shared bytes, the one with the largest page_id is stored and the others revisit it.
    Rows that repeat the largest page_id are all stored, and so are rows without a page_id. Null html is an empty payload.
    """
    text = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", text.alias("_html"), F.sha1(text.cast("binary")).alias("_digest"), F.octet_length(text).cast("long").alias("_bytes"))
    owners = rows.filter(F.col("_bytes") >= least_shared).groupBy("_digest").agg(F.max("page_id").alias("_owner"), F.min("page_id").alias("_other"))
    # Written first: when few payloads are shared, Spark sees a small table and need not shuffle the pages.
    owners = stored(owners.filter("_other < _owner").select("_digest", "_owner"), "owners")
    joined = rows.join(owners, "_digest", "left")
    revisit = (F.col("_owner") > F.col("page_id")) & (F.col("_bytes") >= least_shared)

    def name(column: str):
        return F.concat(F.lit("urn:page:"), F.col(column).cast("string"))

    return joined.select(
        F.coalesce(name("page_id"), F.lit("urn:page:")).alias("record_id"),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(revisit, name("_owner")).alias("refers_to"),
        F.col("_digest").alias("payload_digest"),
        F.col("_bytes").alias("payload_bytes"),
        F.when(revisit, F.lit(None).cast("binary")).otherwise(F.col("_html").cast("binary")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, compression: str = "none") -> None:
    register(pages.sparkSession)
    page_records(pages).write.format("warc").option("compression", compression).mode("append").save(path)


def read_records(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest of a response are those of the payload that was read; a revisit's come from its headers. Both reads push their
    record type down, and that of revisits asks for no payload.
    """
    spark = pages.sparkSession
    path = shared_folder(spark, "warc")
    write_pages(pages, path)
    heads = "record_id string, record_type string, refers_to string"
    kind = pages.schema["page_id"].dataType.simpleString()

    def number(column: str):
        return F.nullif(F.substring_index(column, ":", -1), F.lit("")).cast(kind)

    def records(record_type: str, columns: str, size, digest) -> DataFrame:
        found = read_records(spark, path, f"{heads}, {columns}").filter(F.col("record_type") == record_type)
        return found.select(
            number("record_id").alias("page_id"), size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to")
        )

    whole = records("response", "payload binary", F.octet_length("payload").cast("long"), F.sha1("payload"))
    return whole.union(records("revisit", "payload_digest string, payload_bytes long", F.col("payload_bytes"), F.col("payload_digest")))
