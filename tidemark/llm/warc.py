"""WARC files: responses in, linked metadata and plain-text conversion records out.

``write`` packs pages as response records, one gzip member each, a file for each task.
``derive`` reads such files and builds, for every response, a metadata record (what the
page says of itself and links to) and a conversion record (its text). Both name the
response they come from by WARC-Refers-To, keep its address, date and payload digest, and
have digests of their own. They are written next to the source as .wat.gz and .wet.gz
files and returned as rows.

Record ids are hashes of what the record holds, so a repeated task makes the same records;
its files have new names, and only those in the returned table count.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import scratch_path
from tidemark.llm.common import Tables


@dataclass(frozen=True)
class WarcFiles:
    """``date`` stands in the response records, as pages carry none. ``level`` is gzip's."""

    date: str = "1970-01-01T00:00:00Z"
    level: int = 3


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: bytes) -> str:
    h = hashlib.sha256()
    for part in parts:
        h.update(len(part).to_bytes(8, "little") + part)
    return f"<urn:uuid:{uuid.UUID(bytes=h.digest()[:16], version=5)}>"


def record(headers: dict[str, str], block: bytes) -> bytes:
    """A record as bytes. Line breaks within a value would end it and become spaces."""
    lines = [f"{k}: {re.sub(r'[\r\n]+', ' ', v)}" for k, v in headers.items()]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.partition(": ")[::2] for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of a gzipped file, a member at a time. What follows a member is copied
    once for each, so the file is read in pieces that are not much longer than one."""
    unpacker, parts = zlib.decompressobj(31), []
    data = stream.read(1 << 16)
    while data:
        parts.append(unpacker.decompress(data))
        data = unpacker.unused_data
        if unpacker.eof:
            yield parse(b"".join(parts))
            unpacker, parts = zlib.decompressobj(31), []
        data = data or stream.read(1 << 16)


# Elements without readable content, and those that end a line.
_SILENT = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|svg)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_LINE = re.compile(
    r"<(?:br|hr|/?(?:p|div|h[1-6]|li|ul|ol|tr|td|th|table|article|section|nav|header|footer|aside|main|title|blockquote|pre))\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")


def readable(page: str) -> str:
    """A page without comments and scripts."""
    return _SILENT.sub(" ", page)


def plain_text(page: str) -> str:
    """The readable text of a page, a line for each block."""
    return text_of(readable(page))


def text_of(page: str) -> str:
    """``plain_text`` of a readable page."""
    text = _TAG.sub("", _LINE.sub("\n", page))
    return _LINES.sub("\n", _BLANK.sub(" ", html.unescape(text))).strip()


def page_fields(page: str) -> dict:
    """Title, language and link targets of a readable page."""
    title, lang = _TITLE.search(page), _LANG.search(page)
    links = [html.unescape(a or b or c) for a, b, c in _LINK.findall(page)]
    name = " ".join(html.unescape(_TAG.sub("", title[1])).split()) if title else ""
    return {"title": name, "language": lang[1] if lang else "", "links": links}


def response(page_id: int | None, url: str | None, page: str | None, p: WarcFiles) -> tuple[dict[str, str], bytes]:
    payload = (page or "").encode()
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        + payload
    )
    headers = {
        "WARC-Type": "response",
        "WARC-Record-ID": record_id(b"response", str(page_id).encode(), (url or "").encode(), payload),
        "WARC-Date": p.date,
        "WARC-Target-URI": url or "",
        "WARC-Payload-Digest": digest(payload),
        "WARC-Block-Digest": digest(block),
        "Content-Type": "application/http; msgtype=response",
    }
    # An extension field: the table's own id.
    return headers | ({} if page_id is None else {"X-Page-ID": str(page_id)}), block


def derivatives(headers: dict[str, str], block: bytes) -> list[tuple[dict[str, str], bytes, dict]]:
    """Metadata and conversion record of a response, each with its headers, block and fields."""
    head, _, payload = block.partition(b"\r\n\r\n")
    page = readable(payload.decode("utf-8", "replace"))
    fields = page_fields(page)
    source = headers["WARC-Record-ID"]
    shared = {
        "WARC-Date": headers["WARC-Date"],
        "WARC-Target-URI": headers["WARC-Target-URI"],
        "WARC-Refers-To": source,
        "WARC-Refers-To-Target-URI": headers["WARC-Target-URI"],
        "WARC-Refers-To-Date": headers["WARC-Date"],
        "WARC-Payload-Digest": headers["WARC-Payload-Digest"],
    } | {k: v for k, v in headers.items() if k.startswith("X-")}
    text = text_of(page)
    conversion = text.encode()
    text_id = record_id(b"conversion", source.encode(), conversion)
    about = json.dumps(
        fields
        | {
            "source_headers": {k: v for k, v in headers.items() if k != "Content-Length"},
            "http_headers": head.decode("utf-8", "replace").split("\r\n"),
            "payload_length": len(payload),
            "conversion": text_id,
        },
        ensure_ascii=False,
    ).encode()
    out = []
    for kind, body, content_type, own in (
        ("metadata", about, "application/json", record_id(b"metadata", source.encode(), about)),
        ("conversion", conversion, "text/plain; charset=utf-8", text_id),
    ):
        made = {"WARC-Type": kind, "WARC-Record-ID": own} | shared
        made |= {"WARC-Block-Digest": digest(body), "Content-Type": content_type}
        out.append((made, body, fields))
    return out


def _system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":/" in uri else (pafs.LocalFileSystem(), uri)


def write(pages: DataFrame, folder: str, p: WarcFiles) -> DataFrame:
    """Response files of the pages; rows (path, n) name them."""

    def run(batches):
        out, path, n = None, "", 0
        for batch in batches:
            for page_id, url, page in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    system, base = _system(folder)
                    system.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path = system.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}"
                out.write(member(record(*response(page_id, url, page, p)), p.level))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n])], names=["path", "n"])

    chosen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return chosen.mapInArrow(run, "path string, n long")


ROWS = pa.schema(
    [("page_id", pa.int64())]
    + [
        (name, pa.string())
        for name in ("kind", "record_id", "refers_to", "target_uri", "date", "payload_digest", "block_digest")
    ]
    + [("length", pa.int64()), ("n_links", pa.int64()), ("title", pa.string()), ("text", pa.string()), ("path", pa.string())]
)


def derive(files: DataFrame, p: WarcFiles) -> DataFrame:
    """One row for each derived record of the files named by ``path``. ``text`` is the
    block, of a metadata record its JSON; ``path`` the file it was written to."""

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, base = _system(path)
                own = uuid.uuid4().hex
                stem, base_stem = (f"{x.removesuffix('.warc.gz')}-{own}" for x in (path, base))
                ends = {"metadata": ".wat.gz", "conversion": ".wet.gz"}
                outs = {k: system.open_output_stream(base_stem + e, compression=None) for k, e in ends.items()}
                rows, held = [], 0
                with system.open_input_stream(base, compression=None) as stream:
                    for headers, block in records(stream):
                        if headers["WARC-Type"] != "response":
                            continue
                        page_id = headers.get("X-Page-ID")
                        for made, body, fields in derivatives(headers, block):
                            kind = made["WARC-Type"]
                            outs[kind].write(member(record(made, body), p.level))
                            rows.append(
                                (
                                    None if page_id is None else int(page_id),
                                    kind,
                                    made["WARC-Record-ID"],
                                    made["WARC-Refers-To"],
                                    made["WARC-Target-URI"],
                                    made["WARC-Date"],
                                    made["WARC-Payload-Digest"],
                                    made["WARC-Block-Digest"],
                                    len(body),
                                    len(fields["links"]),
                                    fields["title"],
                                    body.decode(),
                                    stem + ends[kind],
                                )
                            )
                            held += len(body)
                        if held > 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                for out in outs.values():
                    out.close()
                if rows:
                    yield _batch(rows)

    schema = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in ROWS)
    return files.select("path").mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ROWS)], schema=ROWS)


def derivative_records(
    spark: SparkSession, pages: DataFrame, p: WarcFiles = WarcFiles(), folder: str | None = None
) -> DataFrame:
    """Pack pages as responses and derive their records: two rows for each page.

    A null html is an empty page, a null url an empty address, and a null page_id stays
    null. A repeated row gives records with the same ids again. An empty table gives an
    empty result; other columns are ignored. Text that is no valid HTML is read as far as
    its tags can be told.
    """
    tables = Tables(spark, "warc")
    files = tables.keep(write(pages, folder or scratch_path(spark, "warc-files"), p), "files")
    count = max(1, files.count())
    return tables.keep(derive(files.repartition(min(count, 1 << 16)), p), "derived")
