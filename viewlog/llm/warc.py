"""WARC derivative builder: metadata and plain-text conversion records from responses.

Every response record yields a ``metadata`` record (named fields about the
capture, its headers and its links) and a ``conversion`` record (its readable
text). Both carry ``WARC-Refers-To`` with the response's record id, its target
URI and date, and digests of their own blocks; ids are derived from the
response's, so rebuilding gives the same records. A response's own record id,
date, payload digest and HTTP header block are preserved where the input has
them (``responses`` takes them from WARC response records); only pages without
get a derived id, the digest of their text and ``CAPTURE_DATE``. Each response is
converted in its own task; nothing is shuffled. ``write_warc`` lets Spark write
the records as gzipped WARC files of any number of parts, ``read_warc`` reads
them back.

Defined results: a null page counts as an empty payload, a null url as an empty
target; a null id takes part in the record id as an empty string; responses
that repeat in every field give equal records; an empty or null record id, date
or digest counts as missing; an empty table gives no records
(and files without records); other columns are ignored. Digests are SHA-1 in
base 32, as is usual in WARC headers.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.llm.common import map_batches

VERSION = "WARC/1.1"
#: Captures without a date of their own get this one: records depend on the input only.
CAPTURE_DATE = "2024-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, names that are URLs

_DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)|<![^>]*>", re.S | re.I)
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|"
                    r"header|hr|html|body|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>")
_SPACE = re.compile(r"[ \t\r\f\v\xa0]+")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
_HREF = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def plain_text(page: str) -> str:
    """The readable text of a page: one line per block, single spaces, entities resolved."""
    text = _TAG.sub("", _BREAK.sub("\n", _DROP.sub("", page).replace("\n", " ")))
    lines = (_SPACE.sub(" ", line).strip() for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def page_facts(page: str) -> tuple[str, str, list[str]]:
    """Title, language and link targets of a page."""
    clean = _DROP.sub("", page)
    title, lang = _TITLE.search(clean), _LANG.search(clean)
    links = [html.unescape(a or b or c) for a, b, c in _HREF.findall(clean)]
    return _SPACE.sub(" ", html.unescape(title[1])).strip() if title else "", lang[1] if lang else "", links


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(10).join(parts))}>"


def _field(value: str) -> str:
    """A header value: no line breaks, which would end the field."""
    return " ".join(value.split("\r")).replace("\n", " ")


def record_head(kind: str, fields: list[tuple[str, str]], block: bytes) -> str:
    fixed = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    return VERSION + "\r\n" + "".join(f"{name}: {_field(value)}\r\n" for name, value in fixed) + "\r\n"


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            rows = []
            for key, url, http, page, *own in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "http", "html", *OWN))):
                rows += derived(key, url or "", http or "", page or "", *(value or "" for value in own))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _COLUMNS)], names=[n for n, _ in _COLUMNS])


#: What a response may bring itself.
OWN = ("source_id", "source_date", "source_digest")
_COLUMNS = [("page_id", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
            ("target_uri", pa.string()), ("source_digest", pa.string()), ("block_digest", pa.string()),
            ("head", pa.string()), ("block", pa.string())]
RECORDS = "page_id long, " + ", ".join(f"{n} string" for n, _ in _COLUMNS[1:])


def derived(key: int | None, url: str, http: str, page: str, source: str = "", date: str = "", source_digest: str = "") -> list[tuple]:
    """The metadata and the conversion record of one response."""
    payload = page.encode()
    source = source or record_id("response", "" if key is None else str(key), url, digest(payload))
    source_digest, date = source_digest or digest(payload), date or CAPTURE_DATE
    title, lang, links = page_facts(page)
    facts = [("title", title), ("language", lang), ("source-payload-digest", source_digest), ("source-length", str(len(payload)))]
    facts += [("http-header", line) for line in http.splitlines() if line]
    facts += [("outlink", link) for link in links]
    metadata = "".join(f"{name}: {_field(value)}\r\n" for name, value in facts)
    out = []
    for kind, content, block in (("metadata", "application/warc-fields", metadata), ("conversion", "text/plain; charset=utf-8", plain_text(page))):
        own = record_id(kind, source)
        fields = [("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Refers-To", source), ("WARC-Target-URI", url),
                  ("WARC-Refers-To-Target-URI", url), ("WARC-Refers-To-Date", date), ("Content-Type", content)]
        if kind == "conversion":
            fields.append(("WARC-Source-Payload-Digest", source_digest))
        data = block.encode()
        out.append((key, kind, own, source, url, source_digest, digest(data), record_head(kind, fields, data), block))
    return out


def derivatives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                http_col: str | None = None, record_id_col: str | None = None, date_col: str | None = None,
                digest_col: str | None = None) -> DataFrame:
    """Two records per response: ``RECORDS``, with the record's header ``head`` and its ``block``.

    ``http_col`` holds the response's header lines; without it a page's only
    known header is its type. ``record_id_col``, ``date_col`` and ``digest_col``
    hold the response's own, which both records then refer to.
    """
    http = F.col(http_col).cast("string") if http_col else F.lit("Content-Type: text/html")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        http.alias("http"), F.col(html_col).cast("string").alias("html"),
                        *(F.col(c).cast("string").alias(name) if c else F.lit("").alias(name)
                          for c, name in zip((record_id_col, date_col, digest_col), OWN)))
    return map_batches(rows, _derive, RECORDS)


def responses(records: DataFrame) -> DataFrame:
    """Of the records that ``read_warc`` returns the responses, ready for ``from_responses``: header block and body apart."""
    parts = F.split("block", "\r\n\r\n", 2)
    return records.where("record_type = 'response'").select(
        F.col("record_id").alias("source_id"), F.col("warc_date").alias("source_date"), F.col("payload_digest").alias("source_digest"),
        F.col("target_uri").alias("url"), parts[0].alias("http"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("html"))


def from_responses(records: DataFrame) -> DataFrame:
    """``derivatives`` of the response records among ``records``; they have no ``page_id``."""
    rows = responses(records).withColumn("page_id", F.lit(None).cast("long"))
    return derivatives(rows, http_col="http", record_id_col="source_id", date_col="source_date", digest_col="source_digest")


def write_warc(records: DataFrame, path: str) -> None:
    """The records as gzipped WARC files, as many as there are partitions, in a folder that all executors share."""
    (records.select(F.concat("head", "block").alias("value")).write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("record_type", "record_id", "refers_to", "target_uri", "warc_date", "payload_digest", "block_digest", "block")
    wanted = ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest", "WARC-Block-Digest")
    for batch in batches:
        rows = []
        for data in batch.column("content").to_pylist():
            at = 0
            while data.startswith(VERSION.encode(), at):
                stop = data.index(b"\r\n\r\n", at)
                head = dict(line.split(": ", 1) for line in data[at:stop].decode().split("\r\n")[1:])
                size = int(head["Content-Length"])
                block = data[stop + 4:stop + 4 + size]
                if digest(block) != head.get("WARC-Block-Digest", digest(block)):
                    raise ValueError(f"block of {head['WARC-Record-ID']} does not match its digest")
                rows.append((*(head.get(w) for w in wanted), block.decode("utf-8", "replace")))
                at = stop + 4 + size + 4
        columns = zip(*rows) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=list(names))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files under ``path``; a block that contradicts its digest is an error.

    Blocks are read as UTF-8, other bytes are replaced; digests are those of the bytes.
    A file is read by one task, so files should stay within a task's memory.
    """
    import gzip

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([gzip.decompress(c) for c in batch.column("content").to_pylist()], pa.binary())],
                                             names=["content"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    fields = ("record_type string, record_id string, refers_to string, target_uri string, warc_date string, payload_digest string, "
              "block_digest string, block string")
    return map_batches(files, lambda batches: _parse(unzip(batches)), fields)


def record_digests(records: DataFrame) -> DataFrame:
    """One row per record: its identifiers and digests, and sizes instead of the texts."""
    return records.select("page_id", "record_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest",
                          F.octet_length("block").cast("long").alias("n_bytes"), F.sha2(F.concat("head", "block"), 256).alias("record_sha256"))
