"""WARC derivatives: each response gives a metadata record and a plain-text conversion record that refer to it.

Both carry WARC-Refers-To (the response's record id), its target URI and date, and its payload digest; the metadata
record holds the source's HTTP headers, title, language, links and the digests, so that each derivative can be traced to
the bytes that it was made from. WARC files are read and written as a Spark source (``read``, ``sources``, ``save``), a
file a partition. Identifiers are derived from the response's identifier, so that a rerun gives the same.

A null or empty payload gives an empty conversion record. A null target is left out of the headers. Bytes that the
charset can't decode become U+FFFD. Repeated rows give repeated records. Pages are read whole, in time linear in their
length: an unclosed comment, script or style hides the rest of its page, and a "<" that opens no tag is text. An empty
table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from askmine.llm.base import row_blocks, with_fields

#: What one pass over a page stops at: comments, hidden elements whole, declarations, and tags by name.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|head)\b[^<>]*>.*?(?:</\1\s*>|\Z)|<[!?][^<>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>",
    re.S | re.I,
)
HIDDEN = frozenset(("script", "style", "template", "noscript", "head"))
BREAKS = frozenset(
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HREF = re.compile(r"""\shref\s*=\s*(?:"([^"<>]*)"|'([^'<>]*)'|([^\s"'<>]+))""", re.I)
LANG = re.compile(r"""\slang\s*=\s*["']?([A-Za-z0-9-]+)""", re.I)
TITLE = re.compile(r"<title\b[^<>]*>([^<]*)", re.I)
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
SPACE = re.compile(r"[^\S\n]+")
FIELDS = "warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, content_length bigint, block_digest string, payload_digest string, source_headers string, block binary"
SHARD_BYTES = 4 << 20


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: str) -> str:
    """A record id made from what it names."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(chr(0).join(parts).encode('utf-8', 'replace')).digest()[:16], version=5)}>"


def decoded(payload: bytes, headers: str) -> str:
    """By the charset of the headers, else of the page's first bytes, else UTF-8."""
    for said in (headers, payload[:1024].decode("latin-1")):
        if m := CHARSET.search(said):
            try:
                return payload.decode(m[1], "replace")
            except LookupError:
                continue
    return payload.decode("utf-8", "replace")


def page(source: str, base: str) -> tuple[str, str, str, list[str]]:
    """(text, title, language, links) of a page: lines without white space at their ends, none empty."""
    parts, links, at = [], [], 0
    title, lang, low = TITLE.search(source), None, source.lower()
    # a head without an end would hide the body
    if "<head" in low and "</head" not in low and (body := low.find("<body", low.find("<head"))) >= 0:
        source = source[: low.find("<head")] + source[body:]
    for m in TOKEN.finditer(source):
        parts.append(source[at : m.start()])
        at = m.end()
        name = (m[3] or m[1] or "").lower()
        if name in BREAKS or name in HIDDEN:
            parts.append("\n")
        if m[3] and not m[2]:
            if name == "a" and (h := HREF.search(m[4])):
                links.append(_joined(base, html.unescape(next(x for x in h.groups() if x is not None)).strip()))
            elif name == "html" and lang is None:
                lang = LANG.search(m[4])
    parts.append(source[at:])
    text = SPACE.sub(" ", html.unescape("".join(parts)).replace("\r", "\n"))
    lines = (line.strip() for line in text.split("\n"))
    return "\n".join(line for line in lines if line), " ".join(html.unescape(title[1]).split()) if title else "", lang[1] if lang else "", links


def _joined(base: str, link: str) -> str:
    try:
        return urljoin(base, link)
    except ValueError:
        return link


def one_line(value: str) -> str:
    return " ".join(value.split())


def derivatives(record_id: str, target: str | None, date: str | None, headers: str | None, payload: bytes | None) -> Iterator[tuple]:
    """(type, record id, refers-to, target, date, content type, block, payload digest) of the metadata and the conversion."""
    payload, headers = payload or b"", headers or ""
    text, title, lang, links = page(decoded(payload, headers), target or "")
    source = digest(payload)
    block = text.encode("utf-8", "replace")
    made = identifier(record_id, "conversion")
    fields = [("title", title), ("language", lang), ("source-payload-digest", source), ("source-payload-length", str(len(payload))), ("conversion", made), ("conversion-digest", digest(block))]
    fields += [("source-header", line) for line in headers.splitlines() if line.strip()] + [("outlink", link) for link in links]
    facts = "".join(f"{k}: {one_line(v)}\r\n" for k, v in fields if v).encode("utf-8", "replace")
    yield "metadata", identifier(record_id, "metadata"), record_id, target, date, "application/warc-fields", facts, source
    yield "conversion", made, record_id, target, date, "text/plain; charset=utf-8", block, source


def serialised(warc_type: str, record_id: str, refers_to: str | None, target: str | None, date: str | None, content_type: str, block: bytes, payload_digest: str | None = None) -> bytes:
    """A WARC/1.1 record. The payload digest of a derivative is its source's: what it was made from."""
    named = [
        ("WARC-Type", warc_type), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Refers-To", refers_to),
        ("WARC-Payload-Digest", payload_digest), ("WARC-Block-Digest", digest(block)), ("Content-Type", content_type), ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in named if v)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of the records of a file."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        stop = data.index(b"\r\n\r\n", start)
        lines = data[start:stop].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        at = stop + 4 + int(headers.get("content-length", 0))
        yield headers, data[stop + 4 : at]


def response_of(block: bytes) -> tuple[str, bytes]:
    """(headers, payload) of an HTTP response's block."""
    head, _, payload = block.partition(b"\r\n\r\n")
    return head.decode("latin-1"), payload


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", date: str | Column = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages as responses: key, record_id (from key, address and payload), target_uri, date, headers, payload.

    date: the same for all pages, or a column's expression.
    """
    payload = F.coalesce(F.col(source).cast("string"), F.lit("")).cast("binary")
    h = F.sha1(F.concat_ws("\0", F.col(key).cast("string"), F.col(url).cast("string"), F.sha1(payload)).cast("binary"))
    dashed = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"))
    when = F.lit(date) if isinstance(date, str) else date
    return pages.select(F.col(key).alias("key"), F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"), F.col(url).cast("string").alias("target_uri"), when.alias("date"), headers.alias("headers"), payload.alias("payload"))


def sources(records: DataFrame) -> DataFrame:
    """The responses among the records of WARC files (as WarcSource reads them), ready for build; key is the record's id."""
    header = lambda name: F.col("headers")[name]
    cut = F.position(F.lit(b"\r\n\r\n"), F.col("block"))
    responses_ = records.filter(header("warc-type") == "response")
    head = F.decode(F.when(cut > 0, F.substring("block", 1, cut - 1)).otherwise(F.col("block")), "ISO-8859-1")
    payload = F.when(cut > 0, F.expr("substring(block, position(X'0D0A0D0A', block) + 4)")).otherwise(F.lit(b""))
    id_ = header("warc-record-id")
    return responses_.select(id_.alias("key"), id_.alias("record_id"), header("warc-target-uri").alias("target_uri"), header("warc-date").alias("date"), head.alias("headers"), payload.alias("payload"))


def build(sources: DataFrame) -> DataFrame:
    """Two rows per response (key, record_id, target_uri, date, headers, payload), in one pass without a shuffle."""
    slim = sources.select("key", "record_id", "target_uri", "date", "headers", "payload")
    schema = with_fields(slim.schema[:1], FIELDS)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(x) if x is not None else 0 for x in (v.as_buffer() if v.is_valid else None for v in batch.column(5))]
            for a, b in row_blocks(sizes, SHARD_BYTES):
                part = batch.slice(a, b - a).to_pylist()
                out = []
                for r in part:
                    for kind, record, refers, target, date, content, block, source in derivatives(r["record_id"], r["target_uri"], r["date"], r["headers"], r["payload"]):
                        out.append((r["key"], kind, record, refers, target, date, content, len(block), digest(block), source, r["headers"], block))
                columns = list(zip(*out)) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [batch.schema.field(0).type, *[pa.string()] * 6, pa.int64(), *[pa.string()] * 3, pa.binary()])], names)

    return slim.mapInArrow(run, schema)


def records_of(derived: DataFrame) -> DataFrame:
    """build's rows as the bytes of one WARC record each (column record)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (serialised(r["warc_type"], r["record_id"], r["refers_to"], r["target_uri"], r["date"], r["content_type"], r["block"], r["payload_digest"]) for r in batch.to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.binary())], ["record"])

    return derived.mapInArrow(run, "record binary")


def write(records: DataFrame, folder: str) -> None:
    """build's rows as WARC bytes, one record to a row of Parquet files (column ``record``): their concatenation is a WARC file."""
    records_of(records).write.mode("overwrite").parquet(folder)


def save(derived: DataFrame, folder: str) -> None:
    """build's rows as WARC files in a folder, one per partition, whole or absent."""
    derived.sparkSession.dataSource.register(WarcSource)
    records_of(derived).write.format("warc").mode("append").save(folder)


def read(spark: SparkSession, path: str) -> DataFrame:
    """headers (by lower-case name) and block of the records of the WARC files of a folder, or of one file."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").load(path)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:", path) else (fs.LocalFileSystem(), path)


def records_in(stream, at_once: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of an open file, one record in memory at a time."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while (line := stream.readline()) and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", 0)))


@dataclass
class Written(WriterCommitMessage):
    part: str
    final: str


class WarcFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[WarcFile]:
        system, path = file_system(self.path)
        if system.get_file_info(path).type == fs.FileType.File:
            return [WarcFile(self.path)]
        inside = system.get_file_info(fs.FileSelector(path, recursive=True))
        return [WarcFile(self.path.rstrip("/") + x.path[len(path.rstrip("/")) :]) for x in sorted(inside, key=lambda x: x.path) if x.is_file and x.path.endswith((".warc", ".warc.gz"))]

    def read(self, part: WarcFile) -> Iterator[tuple]:
        system, path = file_system(part.path)
        with system.open_input_stream(path, compression="gzip" if path.endswith(".gz") else None) as raw, io.BufferedReader(raw, 1 << 20) as stream:
            yield from records_in(stream)


class WarcWriter(DataSourceWriter):
    """A task writes a file under a name of its own attempt; the commit gives the files of the tasks that count their names."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, rows: Iterator) -> Written:
        system, folder = file_system(self.folder)
        system.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4()}"
        with system.open_output_stream(f"{folder}/_{name}") as out:
            for row in rows:
                out.write(bytes(row["record"]))
        return Written(f"{folder}/_{name}", f"{folder}/{name}.warc")

    def commit(self, messages: list) -> None:
        system, _ = file_system(self.folder)
        for m in messages:
            system.move(m.part, m.final)

    def abort(self, messages: list) -> None:
        system, _ = file_system(self.folder)
        for m in messages:
            if m is not None:
                system.delete_file(m.part)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return "headers map<string,string>, block binary"

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])
