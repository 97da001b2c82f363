"""WARC derivatives: metadata and plain-text conversion records from response records.

Every response gives a metadata record, a JSON object with the source's WARC and HTTP
headers, its digests, title and links; and, if its content is text, a conversion record with
the plain text. Both name the response in WARC-Refers-To, keep its URI, date and payload
digest, and name each other in WARC-Concurrent-To. Identifiers follow from the response's, so
a task that runs again makes the same records. Rows are independent: nothing is shuffled.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import json
import re
import uuid
import zlib
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # that of URLs, RFC 4122
END = b"\r\n\r\n"
# Codecs of names and of program text.
NO_TEXTS = {"idna", "punycode", "undefined", "unicode-escape", "raw-unicode-escape", "unicode_escape", "raw_unicode_escape"}
HIDDEN = {"script", "style", "template", "noscript"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "em", "font", "i", "kbd", "mark", "q", "s", "samp", "small", "span",
          "strong", "sub", "sup", "time", "tt", "u", "var", *HIDDEN}
LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}


class _Page(HTMLParser):
    """Title, links and visible text of a page; any tag but an inline one ends a line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.title: list[str] = []
        self.links: list[tuple[str, str]] = []
        self.hidden, self.in_title = "", False

    def handle_starttag(self, tag, attrs):
        if tag in LINKS and (target := dict(attrs).get(LINKS[tag])):
            self.links.append((tag, target))
        if tag in HIDDEN and not self.hidden:
            self.hidden = tag
        self.in_title = tag == "title"
        if tag not in INLINE:
            self.text.append("\n")

    def handle_startendtag(self, tag, attrs):
        hidden = self.hidden
        self.handle_starttag(tag, attrs)
        self.hidden, self.in_title = hidden, False

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # no known section: a comment up to the next bracket
            return self.rawdata.find(">", i) + 1 or -1

    def handle_endtag(self, tag):
        if tag == self.hidden:
            self.hidden = ""
        self.in_title = False
        if tag not in INLINE:
            self.text.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.hidden:
            self.text.append(data.replace("\n", " "))


def _tidy(text: str) -> str:
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def read_html(html: str) -> tuple[str, str, list[tuple[str, str]]]:
    """Plain text, title and (tag, target) links."""
    page = _Page()
    # No character has so large a number, and very long ones can't be read.
    page.feed(re.sub(r"&#(\d{8,})", lambda m: f"&#{min(m[1].lstrip('0') or '0', '9' * 7, key=len)}", html))
    page.close()
    return _tidy("".join(page.text)), " ".join("".join(page.title).split()), page.links


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def matches(data: bytes, labelled: str) -> bool | None:
    """Whether data has a labelled digest, in base32 or hexadecimal; None if its kind is unknown."""
    kind, _, value = labelled.partition(":")
    if kind.lower() not in ("md5", "sha1", "sha256", "sha512"):
        return None
    found = hashlib.new(kind.lower(), data).digest()
    return value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def _headers(lines: list[bytes]) -> list[tuple[str, str]]:
    """Named fields in order; a line that starts with white space continues the one before."""
    out: list[tuple[str, str]] = []
    for line in lines:
        text = line.decode("utf-8", "replace").strip("\r\n")
        if text[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        elif ":" in text:
            name, _, value = text.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def _first(headers: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def parse_record(record: bytes) -> tuple[str, list[tuple[str, str]], bytes] | None:
    """Version line, headers and block of one WARC record; None if it is none."""
    head, found, rest = record.partition(END)
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/"):
        return None
    headers = _headers(lines[1:])
    length = _first(headers, "Content-Length")
    return lines[0].decode("ascii", "replace"), headers, rest[: int(length)] if re.fullmatch(r"\d{1,15}", length or "", re.A) else rest.removesuffix(END)


def parse_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response."""
    head, _, payload = block.partition(END)
    lines = head.split(b"\r\n")
    return lines[0].decode("utf-8", "replace"), _headers(lines[1:]), payload


def write_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record; line breaks inside a header's value become blanks."""
    lines = ["WARC/1.1", *(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def _decoded(payload: bytes, http: list[tuple[str, str]]) -> bytes:
    if "gzip" in (_first(http, "Content-Encoding") or "").lower():
        try:
            return gzip.decompress(payload)
        except (OSError, EOFError, zlib.error):
            return payload
    return payload


def _charset(payload: bytes, content_type: str) -> str:
    named = re.search(r"charset=[\"']?([\w.:-]+)", content_type, re.I) or re.search(
        r"<meta[^>]{0,200}?charset=[\"']?([\w.:-]+)", payload[:4096].decode("latin-1"), re.I)
    try:
        return codecs.lookup(named[1]).name if named else "utf-8"
    except LookupError:
        return "utf-8"


def _text(payload: bytes, content_type: str) -> str:
    """The payload as its charset reads it, or as UTF-8 where that is no encoding of texts."""
    charset = _charset(payload, content_type)
    try:
        return payload.decode("utf-8" if charset in NO_TEXTS else charset, "replace")
    except (LookupError, ValueError):
        return payload.decode("utf-8", "replace")


def _identifier(kind: str, source: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind} {source}')}>"


def derivatives(record: bytes | None) -> list[tuple]:
    """(type, record_id, refers_to, target_uri, date, payload_digest, content, record) of what a
    response record yields. Anything but a response yields nothing."""
    parsed = parse_record(record) if record else None
    if not parsed or (_first(parsed[1], "WARC-Type") or "").lower() != "response":
        return []
    _, source, block = parsed
    status, http, payload = parse_http(block)
    source_id = _first(source, "WARC-Record-ID") or _identifier("response", hashlib.sha256(record).hexdigest())
    labelled = _first(source, "WARC-Payload-Digest")
    ids = {kind: _identifier(kind, source_id) for kind in ("metadata", "conversion")}
    content_type = _first(http, "Content-Type") or "text/html"
    body = _decoded(payload, http)
    text, title, links = None, "", []
    if re.match(r"text/html|application/xhtml", content_type, re.I):
        text, title, links = read_html(_text(body, content_type))
    elif re.match(r"text/", content_type, re.I):
        text = _tidy(_text(body, content_type))
    meta = {
        "warc": source, "http": {"status": status, "headers": http},
        "payload": {"digest": labelled or digest(payload), "length": len(payload), "valid": matches(payload, labelled) if labelled else True},
        "block-digest": _first(source, "WARC-Block-Digest") or digest(block),
        "title": title, "links": [{"tag": tag, "url": url} for tag, url in links],
    }
    blocks = [("metadata", "application/json", json.dumps(meta, ensure_ascii=False).encode("utf-8", "replace"))]
    if text is not None:
        blocks.append(("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")))
    kept = [(k, v) for k in ("WARC-Target-URI", "WARC-Date", "WARC-IP-Address", "WARC-Warcinfo-ID") if (v := _first(source, k))]
    out = []
    for kind, mime, content in blocks:
        other = "conversion" if kind == "metadata" else "metadata"
        headers = [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Refers-To", source_id), *kept]
        if len(blocks) == 2:
            headers.append(("WARC-Concurrent-To", ids[other]))
        headers += [("WARC-Payload-Digest", meta["payload"]["digest"]), ("WARC-Block-Digest", digest(content)), ("Content-Type", mime)]
        out.append((kind, ids[kind], source_id, _first(source, "WARC-Target-URI"), _first(source, "WARC-Date"),
                    meta["payload"]["digest"], content.decode(), write_record(headers, content)))
    return out


FIELDS = [("warc_type", pa.string(), T.StringType()), ("record_id", pa.string(), T.StringType()), ("refers_to", pa.string(), T.StringType()),
          ("target_uri", pa.string(), T.StringType()), ("warc_date", pa.string(), T.StringType()), ("payload_digest", pa.string(), T.StringType()),
          ("content", pa.string(), T.StringType()), ("record", pa.binary(), T.BinaryType())]


def build_derivatives(responses: DataFrame, record_col: str = "record", keep: list[str] = ()) -> DataFrame:
    """The metadata and conversion records of a table of response records, with the columns in keep.

    Null, empty and broken records, and those of other types, yield no rows; a response
    without a payload yields empty text. Repeated rows yield their records each. A kept
    column that has the name of a new one comes out as source_<name>.
    """
    new = {name for name, _, _ in FIELDS}
    kept = [column(c).alias(f"source_{c}" if c in new else c) for c in keep]
    rows = responses.select(column(record_col).cast("binary").alias("record"), *kept)
    fields = [*rows.schema[1:], *(T.StructField(name, kind) for name, _, kind in FIELDS)]
    names = [f.name for f in fields]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # a page's records together exceed the page
                part = batch.slice(at, 256)
                taken, out = [], []
                for i, record in enumerate(part.column(0).to_pylist()):
                    made = derivatives(record)
                    taken += [i] * len(made)
                    out += made
                columns = [part.column(i).take(pa.array(taken, pa.int64())) for i in range(1, part.num_columns)]
                values = zip(*out, strict=True) if out else [[] for _ in FIELDS]
                columns += [pa.array(list(v), kind) for v, (_, kind, _) in zip(values, FIELDS, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, T.StructType(fields))


def response_record(key: Column, url: Column, html: Column, date: str) -> Column:
    """A response record of a page, as a crawler would have written it. Nulls count as empty."""
    line = F.lit("\r\n")
    html, url = F.coalesce(html, F.lit("")), F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", " ")
    name = F.sha2(F.concat_ws(" ", key.cast("string"), url, html).cast("binary"), 256)
    part = lambda a, n: F.substring(name, a, n)
    identifier = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(html).cast("string"), line, line, html)
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: "), identifier, F.lit("\r\nWARC-Target-URI: "), url,
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha256:"), F.sha2(html.cast("binary"), 256),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(http).cast("string"))
    return F.concat(head, line, line, http, line, line).cast("binary")
