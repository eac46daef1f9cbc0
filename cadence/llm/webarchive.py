"""Web-archive derivatives: from every response record a metadata record (title,
links, source headers) and a plain-text conversion record.  Both name the
response in WARC-Refers-To and keep its target, date and payload digest."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import prepared, scratch_dir, staged

DATE = "2024-01-01T00:00:00Z"
SHARD_BYTES = 64 << 20
RESPONSE = (
    "page_id long, record_id string, target_uri string, date string, http_headers string, payload binary, payload_digest string"
)
DERIVED = (
    "page_id long, type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "source_headers string, payload_digest string, block_digest string, content_length long, block binary"
)
#: Elements whose content is not text, and those that start a line.
_HIDDEN = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template")}
_LINES = frozenset(
    "p div br li ul ol tr table h1 h2 h3 h4 h5 h6 article section header footer nav title blockquote pre hr td th main aside "
    "form option".split()
)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)")
_TITLE_END = re.compile(r"</title\s*>", re.I)
_LINKING = frozenset(("a", "link", "img", "script", "iframe"))
_REFERENCE = re.compile(r"\s(href|src)\s*=\s*", re.I)
_UNQUOTED = re.compile(r"[^\s>]+")
_LANG = re.compile(r"\slang\s*=\s*[\"']?([A-Za-z-]+)", re.I)


def tags(page: str) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, name, hidden) of every tag, in one pass: a tag goes to the
    next ``>``; what has none is text.  Comments, and elements whose content is
    not text, are one hidden tag with all they hold; unclosed, they go to the
    page's end."""
    at, n = 0, len(page)
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = n if end < 0 else end + 3
            yield at, end, "!--", True
            at = end
            continue
        if not (page[at + 1 : at + 2].isascii() and page[at + 1 : at + 2].isalpha() or page[at + 1 : at + 2] in ("!", "?", "/")):
            at += 1
            continue
        end = page.find(">", at) + 1
        if not end:
            return
        m = _NAME.match(page, at, end)
        name = m[1].lower() if m else ""
        if name in _HIDDEN and page[at + 1] != "/":
            close = _HIDDEN[name].search(page, end)
            end = close.end() if close else n
            yield at, end, name, True
        else:
            yield at, end, name, False
        at = end


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def plain_text(page: str) -> str:
    """Visible text: blocks on lines of their own, blanks single.  Linear in the
    page's length, as are the other readers of pages."""
    out, done = [], 0
    for start, end, name, hidden in tags(page):
        out += [page[done:start], " " if hidden else "\n" if name in _LINES else ""]
        done = end
    text = html.unescape("".join([*out, page[done:]]))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(x for x in lines if x)


def title(page: str) -> str | None:
    for start, end, name, hidden in tags(page):
        if name == "title" and not hidden and page[start + 1] != "/":
            close = _TITLE_END.search(page, end)
            return page[end : close.start()] if close else None
    return None


def links(page: str, base: str) -> list[dict[str, str]]:
    out, done = [], 0
    quotes = {"'": True, '"': True}  # whether one may still follow
    for start, end, name, _ in tags(page):
        if name not in _LINKING or start < done or page[start + 1] == "/":
            continue
        m = _REFERENCE.search(page, start, page.find(">", start) + 1 or end)
        if not m:
            continue
        quote, ref = page[m.end() : m.end() + 1], None
        if quote in quotes and quote and quotes[quote]:
            close = page.find(quote, m.end() + 1)
            quotes[quote] = close >= 0
            if close >= 0:
                ref, done = page[m.end() + 1 : close], close + 1
        if ref is None:
            plain = _UNQUOTED.match(page, m.end(), end)
            if not plain:
                continue
            ref = plain[0]
        ref = html.unescape(ref)
        path = f"{name}@/{m[1].lower()}"
        try:
            out.append({"path": path, "url": urljoin(base, ref)})
        except ValueError:  # not an address
            out.append({"path": path, "url": ref})
    return out


def declared_language(page: str) -> str | None:
    for start, end, name, hidden in tags(page):
        if name == "html" and not hidden and page[start + 1] != "/":
            m = _LANG.search(page, start, end)
            if m:
                return m[1].lower().split("-")[0]
    return None


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of a table of pages (page_id, url, html); nulls are empty."""
    prepared(pages.sparkSession)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page_id, url, page in zip(b["page_id"], b["url"], b["html"]):
                body = page.encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
                rows.append((page_id, _urn("response", url, date, digest(body)), url, date, head, body, digest(body)))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in RESPONSE.split(", ")])
            yield out.assign(page_id=out["page_id"].astype("Int64"))

    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    return own.mapInPandas(make, RESPONSE)


def _headers(block: str) -> dict[str, str]:
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.split("\r\n")[1:] if ":" in x)}


def derivatives(records: DataFrame) -> DataFrame:
    """The metadata and the conversion record of every response (columns of
    RESPONSE).  Bytes that are no UTF-8 are replaced; an empty payload gives
    empty text and no links.  Responses that repeat give equal records."""
    prepared(records.sparkSession)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                page = bytes(r.payload).decode("utf-8", "replace")
                meta = {
                    "title": " ".join(html.unescape(title(page) or "").split()),
                    "language": declared_language(page),
                    "links": links(page, r.target_uri),
                    "http_headers": _headers(r.http_headers),
                }
                for kind, content_type, block in (
                    ("metadata", "application/json", json.dumps(meta, ensure_ascii=False, sort_keys=True).encode()),
                    ("conversion", "text/plain; charset=utf-8", plain_text(page).encode("utf-8", "replace")),
                ):
                    rows.append(
                        (r.page_id, kind, _urn(kind, r.record_id), r.record_id, r.target_uri, r.date, content_type)
                        + (r.http_headers, r.payload_digest, digest(block), len(block), block)
                    )
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in DERIVED.split(", ")])
            yield out.assign(page_id=out["page_id"].astype("Int64"))

    return records.mapInPandas(make, DERIVED)


def record_bytes(r) -> bytes:
    """One record as a member of a .warc.gz file."""
    head = [
        ("WARC-Type", r.type),
        ("WARC-Record-ID", r.record_id),
        ("WARC-Refers-To", r.refers_to),
        ("WARC-Target-URI", r.target_uri),
        ("WARC-Date", r.date),
        ("WARC-Payload-Digest", r.payload_digest),
        ("WARC-Block-Digest", r.block_digest),
        ("Content-Type", r.content_type),
        ("Content-Length", str(r.content_length)),
    ]
    text = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(text.encode() + bytes(r.block) + b"\r\n\r\n", mtime=0)


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a .warc.gz file."""
    f = gzip.GzipFile(fileobj=io.BytesIO(data))
    while line := f.readline():
        if not line.startswith(b"WARC/"):
            continue
        head = {}
        while (line := f.readline().decode().rstrip("\r\n")):
            k, _, v = line.partition(": ")
            head[k] = v
        yield head, f.read(int(head["Content-Length"]))


def write_files(derived: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes .warc.gz files of about SHARD_BYTES and returns the manifest
    (file, records); files of lost attempts are not in it."""
    from cadence.llm.tokens import _open

    spark = prepared(derived.sparkSession)
    folder = folder or scratch_dir(spark, "warc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f, n, size, k = None, None, 0, 0, 0
        for b in batches:
            for r in b.itertuples(index=False):
                if f is None:
                    name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{k:04d}-{uuid.uuid4().hex[:12]}.warc.gz"
                    f, n, size, k = _open(name, "w"), 0, 0, k + 1
                data = record_bytes(r)
                f.write(data)
                n, size = n + 1, size + len(data)
                if size >= SHARD_BYTES:
                    f.close()
                    yield pd.DataFrame([(name, n)], columns=["file", "records"])
                    f = None
        if f is not None:
            f.close()
            yield pd.DataFrame([(name, n)], columns=["file", "records"])

    return staged(derived.mapInPandas(write, "file string, records long"), "warc-manifest")
