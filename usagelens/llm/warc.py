"""WARC derivatives: linked metadata and plain-text conversion records of responses.

``responses`` writes every page as a WARC/1.1 response record. ``derive`` reads response
records, whoever wrote them, and gives two records for each:

* ``metadata`` (application/warc-fields): title, language, charset, status, the source's
  HTTP headers and one ``outlink`` line per link, in order;
* ``conversion`` (text/plain): the page's text without markup.

Both name the response in WARC-Refers-To and keep its target, date and payload digest
(WARC-Target-URI, and the extension fields X-Source-Date and X-Source-Payload-Digest), the
conversion also names its metadata record in the extension field X-Metadata-Record; both carry
digests of their own blocks. Record ids are name-based UUIDs of the response's id and the kind, so a
re-run, or a task run again after a lost executor, writes the same bytes. A record is
independent of all others: no stage shuffles. ``parse_record`` checks lengths and digests.

Text: comments, script, style, head, template and noscript are dropped, block elements
become line breaks, entities are resolved, blanks are collapsed. Markup is read from left
to right and every tag once, so a page takes time in proportion to its length, whatever it holds.

``write_warc`` writes records as WARC files with Spark's text sink (any file system; one file a
task), ``read_warc`` reads files of plain or record-wise compressed records back; a file is
read by one task, up to the 2 GB that a row of Spark's binary file source can hold.

Cases: null html is an empty payload (empty text, no links); a null url gives an empty
target; a null page_id is written as empty; repeated rows give equal records; markup that
isn't closed runs to the end; an empty table gives an empty result; other columns are
ignored. A record whose length or digest is wrong gives a row of kind ``error``.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm.common import ship

DATE = "2026-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122

_DROPPED = re.compile(r"<!--|<(script|style|head|template|noscript)\b", re.I)
_CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "head", "template", "noscript", "title")}
_BLOCKS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 tr table section article header footer nav aside main pre blockquote "
                    "dl dt dd hr form figure body html td th".split())
_TAG = re.compile(r"</?([A-Za-z!][A-Za-z0-9]*)[^>]*>?")
_TITLE, _HTML, _ANCHOR = (re.compile(rf"<{name}\b", re.I) for name in ("title", "html", "a"))
_LANG = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_BARE = re.compile(r"[^\s>]+")
_BLANKS = re.compile(r"[ \t\f\v\r\xa0]+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {_line(v)}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _line(value: str) -> str:
    return " ".join(value.split())


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"


def response(page_id: int | None, url: str | None, page: str | None, date: str = DATE) -> bytes:
    payload = (page or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + payload
    name = f"{'' if page_id is None else page_id} {url or ''} {digest(payload)}"
    return record([("WARC-Type", "response"), ("WARC-Record-ID", record_id(name)), ("WARC-Date", date),
                   ("WARC-Target-URI", url or ""), ("Content-Type", "application/http; msgtype=response"),
                   ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(payload))], block)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block); ValueError where length or digest is wrong."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        k, _, v = line.partition(":")
        headers.setdefault(k.strip().lower(), v.strip())
    n = int(headers.get("content-length", "-1"))
    block = rest[:n] if n >= 0 else b""
    if n < 0 or len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("record length does not match")
    if headers.get("warc-block-digest", digest(block)) != digest(block):
        raise ValueError("block digest does not match")
    return headers, block


def _kept(page: str) -> Iterator[str]:
    """The page without comments and dropped elements, a blank in place of each."""
    at = 0
    closed = page.rfind(">")  # no tag after this one ends
    start = 0
    while m := _DROPPED.search(page, at):
        name = m[1]
        if name is None:
            end = page.find("-->", m.end())
            end = end + 3 if end >= 0 else len(page)
        elif m.end() > closed:
            at = m.end()
            continue
        else:
            last = _CLOSING[name.lower()].search(page, page.find(">", m.end()) + 1)
            end = last.end() if last else len(page)
        yield page[start:m.start()]
        yield " "
        start = at = end
    yield page[start:]


def plain_text(page: str) -> str:
    text = _TAG.sub(lambda m: "\n" if m[1].lower() in _BLOCKS and m[0][-1] == ">" else "", "".join(_kept(page)))
    lines = (_BLANKS.sub(" ", x).strip() for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def outlinks(page: str) -> list[str]:
    """The href of every anchor, in order."""
    links, at = [], 0
    unclosed: set[str] = set()
    while m := _ANCHOR.search(page, at):
        end = page.find(">", m.end())
        end = len(page) if end < 0 else end
        at = m.end()
        while True:
            name = _HREF.search(page, at, end)
            if name is None:
                at = end  # no anchor that starts before this end has one either
                break
            at = name.end()
            quote = page[at:at + 1]
            close = page.find(quote, at + 1) if quote in ("\"", "'") and quote not in unclosed else -1
            if close >= 0:
                links.append(page[at + 1:close])
                at = close + 1
                break
            if quote in ("\"", "'"):
                unclosed.add(quote)
            bare = _BARE.match(page, at)
            if bare:
                links.append(bare[0])
                at = bare.end()
                break
    return [html.unescape(x).strip() for x in links]


def title_of(page: str) -> str:
    m = _TITLE.search(page)
    start = page.find(">", m.end()) + 1 if m else 0
    if not start:
        return ""
    end = _CLOSING["title"].search(page, start)
    return html.unescape(page[start:end.start() if end else len(page)])


def language_of(page: str) -> str:
    m = _HTML.search(page)
    if not m:
        return ""
    end = page.find(">", m.end())
    lang = _LANG.search(page, m.end(), end if end >= 0 else len(page))
    return lang[1] if lang else ""


def derive_record(data: bytes) -> list[dict]:
    """The metadata and the conversion record of one response record."""
    source, block = parse_record(data)
    if source.get("warc-type") != "response":
        return []
    head, _, payload = block.partition(b"\r\n\r\n")
    if "warc-payload-digest" in source and source["warc-payload-digest"] != digest(payload):
        raise ValueError("payload digest does not match")
    status, *http = head.decode("latin-1").split("\r\n")
    charset = next((m[1] for h in http if (m := re.match(r"(?i)content-type:.*charset=[\"']?([\w-]+)", h))), "utf-8")
    try:
        page = payload.decode(charset, "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    links = outlinks(page)
    of, target, date = (source.get(k, "") for k in ("warc-record-id", "warc-target-uri", "warc-date"))
    fields = [("title", title_of(page)), ("language", language_of(page)),
              ("charset", charset), ("status", status), *[("source-header", h) for h in http], *[("outlink", x) for x in links]]
    bodies = {"metadata": ("application/warc-fields", "".join(f"{k}: {_line(v)}\r\n" for k, v in fields)),
              "conversion": ("text/plain; charset=utf-8", plain_text(page))}
    out = []
    for kind, (mime, body) in bodies.items():
        body_bytes = body.encode("utf-8", "replace")
        me = record_id(f"{of} {kind}")
        headers = [("WARC-Type", kind), ("WARC-Record-ID", me), ("WARC-Date", date), ("WARC-Target-URI", target),
                   ("WARC-Refers-To", of), ("X-Source-Date", date),
                   ("X-Source-Payload-Digest", source.get("warc-payload-digest", digest(payload)))]
        if kind == "conversion":
            headers.append(("X-Metadata-Record", record_id(f"{of} metadata")))
        headers += [("Content-Type", mime), ("WARC-Block-Digest", digest(body_bytes))]
        out.append({"kind": kind, "record_id": me, "refers_to": of, "target_uri": target,
                    "source_digest": source.get("warc-payload-digest", digest(payload)), "block_digest": digest(body_bytes),
                    "n_links": len(links), "body": body, "record": record(headers, body_bytes)})
    return out


RESPONSES = "page_id long, record binary"
DERIVED = ("page_id long, kind string, record_id string, refers_to string, target_uri string, source_digest string, "
           "block_digest string, n_links long, body string, record binary")
_DERIVED = pa.schema([("page_id", pa.int64()), ("kind", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
                      ("target_uri", pa.string()), ("source_digest", pa.string()), ("block_digest", pa.string()),
                      ("n_links", pa.int64()), ("body", pa.string()), ("record", pa.binary())])


def response_batches(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rows = [response(i, u.as_py(), h.as_py(), date) for i, u, h in zip(ids, batch.column(1), batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["page_id", "record"])


def derive_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # a slice at a time bounds what is held
            rows = []
            part = batch.slice(at, 256)
            for page_id, data in zip(part.column(0).to_pylist(), part.column(1)):
                try:
                    got = derive_record(data.as_py() or b"")
                except ValueError as e:
                    got = [{"kind": "error", "body": str(e)}]
                rows += [{"page_id": page_id, **r} for r in got]
            yield pa.RecordBatch.from_pylist(rows, schema=_DERIVED)


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """page_id, record: a response record of every page."""
    ship(pages.sparkSession)
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
            .mapInArrow(lambda it: response_batches(it, date), RESPONSES))


def derive(records: DataFrame) -> DataFrame:
    """DERIVED rows of every response record (columns ``page_id`` and ``record``)."""
    ship(records.sparkSession)
    return records.select("page_id", "record").mapInArrow(derive_batches, DERIVED)


_END = b"\r\n\r\n"
_PLAIN_HEAD = re.compile(rb"WARC/[^\r\n]*\r\n(?:[^\r\n]+\r\n)*?content-length:[ \t]*(\d+)[ \t]*\r\n(?:[^\r\n]+\r\n)*\r\n", re.I)


def write_warc(records: DataFrame, path: str) -> None:
    """The column ``record`` as WARC files under ``path``. A record ends in two line ends, which
    are the text sink's separator; its bytes are written as they are."""
    whole = F.col("record").isNotNull() & (F.octet_length("record") > len(_END))
    body = F.expr(f"substring(record, 1, octet_length(record) - {len(_END)})")
    records.where(whole).select(body.cast("string").alias("value")).write.option("lineSep", _END.decode()).text(path)


def split_records(data: bytes) -> Iterator[bytes]:
    """The records of a file, plain or one gzip member each; what is no record is one by itself,
    to the end, and fails in ``parse_record``."""
    if data[:2] == b"\x1f\x8b":
        while data:
            member = zlib.decompressobj(31)
            try:
                yield member.decompress(data) + member.flush()
            except zlib.error:
                yield data
                return
            data = member.unused_data
        return
    at = 0
    while at < len(data):
        head = _PLAIN_HEAD.match(data, at)
        end = head.end() + int(head[1]) + len(_END) if head else len(data)
        yield data[at:end]
        at = end


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id (null), record: the records of all files under ``path``."""
    ship(spark)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for one in split_records(content.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([one], pa.binary())], names=["page_id", "record"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(split, RESPONSES)
