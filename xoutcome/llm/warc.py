"""Derivatives of WARC responses: linked metadata and plain-text conversion records.

A response becomes two records. The metadata record is JSON with the response's headers, title and links; the
conversion record is the page's text. Both name the response in ``WARC-Refers-To``, keep its target, date and payload
digest, have an id of their own (a UUID derived from the response's id and their type, so that a task that runs twice
writes the same record), and a block digest. Digests are SHA-1 in base 32.

The payload is read once for links, title and text: chunked transfer and gzip or deflate coding are undone, the charset is
that of Content-Type, else of the page's own declaration, else UTF-8. A coding that can't be undone leaves no links and no
text. Headers that are there repeatedly, of the record or of HTTP, are kept as lists in their order.

Null and empty bodies are responses with an empty payload: their records have no links and no text. A null target is
written as an empty one. A null, another type of record, or bytes that are no record give a row in which all but the key is
null. Texts of any length are read whole, in linear time. Repeated rows give repeated records. Other columns are left
behind, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.dom import INLINE, SPACE

DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
# Elements and attributes that hold links (fixed values of the HTML standard).
LINKS = {("a", "href"), ("area", "href"), ("link", "href"), ("img", "src"), ("script", "src"), ("iframe", "src"), ("form", "action"),
         ("source", "src"), ("video", "src"), ("audio", "src"), ("embed", "src"), ("object", "data")}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record: version, headers, an empty line, the block, two line ends."""
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _headers(lines: list[str]) -> dict[str, str | list[str]]:
    """Headers by name; one that is there repeatedly has a list of its values."""
    out: dict[str, str | list[str]] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        name, value = name.strip(), value.strip()
        if not colon:
            continue
        if name not in out:
            out[name] = value
        elif isinstance(out[name], list):
            out[name].append(value)
        else:
            out[name] = [out[name], value]
    return out


def _one(headers: dict[str, str | list[str]], name: str) -> str:
    """The first value of a header, in whatever letters its name is written; empty if it is not there."""
    found = next((v for k, v in headers.items() if k.lower() == name), "")
    return found[0] if isinstance(found, list) else found


def parse(data: bytes) -> tuple[str, dict[str, str | list[str]], bytes]:
    """Type, headers by lower-case name, and block of one record; ``ValueError`` for anything else."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = _headers([(name.lower() + colon + value) for name, colon, value in (line.partition(":") for line in lines)])
    size = _one(headers, "content-length")
    if not size.isdecimal() or not _one(headers, "warc-type"):
        raise ValueError("not a WARC record")
    return _one(headers, "warc-type"), headers, rest[:int(size)]


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def response(key: str, url: str, body: bytes, date: str = DATE) -> bytes:
    """A response record around an HTML body."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    return record("response", [("WARC-Record-ID", record_id("response", key, url)), ("WARC-Target-URI", _line(url)), ("WARC-Date", date),
                               ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(http)),
                               ("Content-Type", "application/http; msgtype=response")], http)


def _line(text: str) -> str:
    return " ".join(text.split())


# A tag or a comment; attributes run to the first > outside of quotes and never over another <.
_TAG = re.compile(r"""<(?:!--(?P<comment>)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/><]*+)(?P<attrs>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|[!?/][^<>]*+>)""")
_ATTR = re.compile(r"""([^\s"'=<>/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_RAW = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in ("script", "style", "title", "textarea")}
_HIDDEN = frozenset("head noscript template".split())
_LINKED = {t: [k for n, k in sorted(LINKS) if n == t] for t, _ in LINKS}


def page(html: str, base: str) -> tuple[str, list[dict[str, str]], list[str]]:
    """Title, links in page order, and text blocks of a page, in one pass.

    Elements other than inline ones end a block. Heads, scripts, styles and templates have no text.
    """
    title, links, blocks, held = [], [], [], []
    hidden: list[str] = []
    at = 0

    def flush() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                blocks.append(text)
    while (m := _TAG.search(html, at)) is not None:
        if not hidden and m.start() > at:
            held.append(html[at:m.start()])
        at = m.end()
        if m["comment"] is not None:
            close = html.find("-->", at)
            at = len(html) if close < 0 else close + 3
            continue
        if m["name"] is None:
            continue
        tag = m["name"].lower()
        if tag == "br":
            held.append(" ")
        elif tag not in INLINE or tag in SPACE:
            flush()
        if m["end"]:
            if tag in hidden:
                del hidden[hidden.index(tag):]
            continue
        if tag in _LINKED and m["attrs"]:
            own: dict[str, str] = {}
            for k, v in _ATTR.findall(m["attrs"]):
                own.setdefault(k.lower(), v)
            for k in _LINKED[tag]:
                if k in own:
                    value = unescape(own[k].strip("\"'")).strip()
                    if value:
                        try:
                            value = urljoin(base, value)
                        except ValueError:
                            pass
                        links.append({"path": f"{tag.upper()}@/{k}", "url": value})
        if tag == "body":
            hidden = [t for t in hidden if t != "head"]
        elif tag in _RAW:
            close = _RAW[tag].search(html, at)
            end = len(html) if close is None else close.start()
            if tag == "title":
                title.append(unescape(html[at:end]))
            elif tag == "textarea" and not hidden:
                held.append(html[at:end])
            at = end
        elif tag in _HIDDEN and not m["attrs"].endswith("/"):
            hidden.append(tag)
    if not hidden:
        held.append(html[at:])
    flush()
    return _line(" ".join(title)), links, blocks


def _unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        size = int(data[at:end].split(b";")[0] or b"0", 16) if end >= 0 else 0
        if size <= 0:
            return b"".join(out)
        out.append(data[end + 2:end + 2 + size])
        at = end + 4 + size


_DECLARED = re.compile(rb"<meta[^>]{0,200}?charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.I)


def payload_text(http: dict[str, str | list[str]], body: bytes) -> str | None:
    """The body as text, its transfer and content codings undone; None if they can't be."""
    try:
        if "chunked" in _one(http, "transfer-encoding").lower():
            body = _unchunked(body)
        for coding in reversed([c.strip().lower() for c in _one(http, "content-encoding").split(",") if c.strip()]):
            if coding in ("gzip", "x-gzip"):
                body = zlib.decompress(body, 47)
            elif coding == "deflate":
                body = zlib.decompress(body) if body[:1] == b"\x78" else zlib.decompress(body, -15)
            elif coding != "identity":
                return None
    except (ValueError, zlib.error):
        return None
    named = re.search(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", _one(http, "content-type"), re.I)
    declared = None if named else _DECLARED.search(body[:2048])
    charset = named[1] if named else declared[1].decode() if declared else "utf-8"
    try:
        return body.decode(charset, "replace")
    except (LookupError, UnicodeError):  # no charset, or none of text
        return body.decode("utf-8", "replace")


def derive(data: bytes | None) -> tuple | None:
    """Of a response record the values of ``FIELDS``, its metadata and conversion records last; None of anything else."""
    try:
        kind, source, block = parse(data or b"")
    except ValueError:
        return None
    refers = _one(source, "warc-record-id")
    if kind != "response" or not refers:
        return None
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("latin-1").split("\r\n")
    http, url = _headers(lines), _one(source, "warc-target-uri")
    title, links, blocks = page(payload_text(http, body) or "", url)
    meta = {"Envelope": {"WARC-Header-Metadata": source, "Payload-Metadata": {"HTTP-Response-Metadata": {
        "Response-Message": status, "Headers": http, "HTML-Metadata": {"Title": title, "Links": links}}}}}
    payload = _one(source, "warc-payload-digest") or digest(body)
    shared = [("WARC-Refers-To", refers), ("WARC-Target-URI", url), ("WARC-Date", _one(source, "warc-date")), ("WARC-Payload-Digest", payload)]

    def made(what: str, content: bytes, type_: str) -> tuple[str, str, bytes]:
        own, sign = record_id(what, refers), digest(content)
        return own, sign, record(what, [("WARC-Record-ID", own), *shared, ("WARC-Block-Digest", sign), ("Content-Type", type_)], content)
    first_id, _, first = made("metadata", json.dumps(meta, ensure_ascii=False, sort_keys=True).encode("utf-8", "replace"), "application/json")
    second_id, sign, second = made("conversion", "\n".join(blocks).encode("utf-8", "replace"), "text/plain")
    return refers, first_id, second_id, refers, url, payload, sign, title, len(links), first, second


FIELDS = [("source_id", pa.string()), ("metadata_id", pa.string()), ("conversion_id", pa.string()), ("refers_to", pa.string()),
          ("target_uri", pa.string()), ("payload_digest", pa.string()), ("conversion_digest", pa.string()), ("title", pa.string()),
          ("n_links", pa.int64()), ("metadata", pa.binary()), ("conversion", pa.binary())]
SCHEMA = ", ".join(f"{n} {'long' if t == pa.int64() else 'binary' if t == pa.binary() else 'string'}" for n, t in FIELDS)


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, response): each page as a response record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [response(str(k), u, h.encode()) for k, u, h in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["page_id", "response"])

    def whole(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`"), F.lit(""))
    return pages.select(F.col(f"`{id_col}`").alias("page_id"), whole(url_col), whole(html_col)).mapInArrow(
        run, f"page_id {dict(pages.dtypes)[id_col]}, response binary")


def derivatives(df: DataFrame, id_col: str = "page_id", response_col: str = "response") -> DataFrame:
    """One row per row of ``df``: ids, kept headers, digests, and both records as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [derive(data) or (None,) * len(FIELDS) for data in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [[] for _ in FIELDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, (_, t) in zip(columns, FIELDS))],
                                             names=["page_id", *(n for n, _ in FIELDS)])
    return df.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{response_col}`")).mapInArrow(
        run, f"page_id {dict(df.dtypes)[id_col]}, {SCHEMA}")


def digests(pages: DataFrame) -> DataFrame:
    """The registered query: each page's response and what its derivatives keep of it."""
    return derivatives(responses(pages)).select(
        "page_id", "source_id", "metadata_id", "conversion_id", "refers_to", "target_uri", "payload_digest", "conversion_digest", "title",
        "n_links", F.sha2("metadata", 256).alias("metadata_sha256"), F.sha2("conversion", 256).alias("conversion_sha256"))
