"""WARC derivatives: metadata and conversion records of response records.

``responses`` shapes pages into response records (headers, HTTP block,
payload). ``derive`` builds from each response a metadata record (fields about
the payload) and a conversion record (its plain text). Both carry the target
URI and date of the response, refer to its record id, and have ids and digests
of their own; the conversion keeps the source's content headers and payload
digest. ``write`` lays records out as WARC/1.1 files, ``read`` parses them.

Record ids are name-based UUIDs over type, URI, date and payload digest, so
reruns agree. Digests are SHA-1 in base 32.

Defined results: a null payload is an empty one; a null URI gives a record
without target URI; repeated rows give repeated records with equal ids.
Further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html as _html
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import ship

ship(__name__)

RECORD = ("page_id long, warc_type string, record_id string, refers_to string, target_uri string, date string, "
          "content_type string, block_digest string, payload_digest string, content_length long, headers map<string,string>, block binary")

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TITLE_END = re.compile(r"</title|\Z", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w-]+)", re.I)
_ATTR = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?")
# What begins a tag or a declaration is markup, every other "<" is text. Quotes hide a ">" only in attribute values.
_MARK = re.compile(r"<[!?][^>]*+>|</?([A-Za-z][^\s/>]*+)(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+>")
_BREAK = set("p div br li ul ol h1 h2 h3 h4 h5 h6 tr td th table section article nav header footer aside main form title head body html blockquote pre".split())


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def _plain(page: str) -> str:
    page = _HIDDEN.sub("", page)
    end = page.rfind(">") + 1  # no tag ends after it, so none is sought there
    text = _html.unescape(_MARK.sub(lambda m: "\n" if m[1] and m[1].lower() in _BREAK else "", page[:end]) + page[end:])
    return "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)


def _attributes(tag: str) -> dict[str, str]:
    """Attributes of a start tag by lower-case name; of equal names the first counts."""
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(tag):
        out.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return out


def _facts(page: str) -> tuple[str, str, str, list[str]]:
    """Charset, language, title and link targets of a page, from one walk over its tags outside scripts and comments."""
    charset = lang = title = None
    links = []
    page = _HIDDEN.sub("", page)
    end = page.rfind(">") + 1
    for m in _MARK.finditer(page, 0, end):
        tag = (m[1] or "").lower()
        if m[0][1] == "/" or tag not in ("a", "html", "meta", "title"):
            continue
        attributes = _attributes(m[0][1 + len(tag): -1])
        if tag == "a" and "href" in attributes:
            links.append(_html.unescape(attributes["href"]))
        elif tag == "html" and lang is None and attributes.get("lang"):
            lang = attributes["lang"].lower()
        elif tag == "meta" and charset is None and (found := _CHARSET.search(m[0])):
            charset = found[1].lower()
        elif tag == "title" and title is None:
            title = " ".join(_html.unescape(page[m.end(): _TITLE_END.search(page, m.end()).start()]).split())
    return charset or "", lang or "", title or "", links


def _row(page_id, kind: str, record_id: str, refers_to, uri, date: str, content_type: str, payload_digest, block: bytes, headers: dict) -> tuple:
    return (page_id, kind, record_id, refers_to, uri, date, content_type, _digest(block), payload_digest, len(block), headers, block)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in RECORD.replace("map<string,string>", "map").split(", ")]
    return pd.DataFrame(rows, columns=names, dtype=object).astype({"page_id": "Int64", "content_length": "int64"})


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One response record per page, captured at ``date``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for i, uri, body in zip(frame["page_id"], frame["url"], frame["html"]):
                uri = uri if isinstance(uri, str) else None
                payload = (body if isinstance(body, str) else "").encode()
                digest = _digest(payload)
                headers = {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}
                block = ("HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n").encode() + payload
                out.append(_row(i, "response", _record_id("response", uri or "", date, digest), None, uri, date,
                                "application/http; msgtype=response", digest, block, headers))
            yield _frame(out)

    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(page).cast("string").alias("html")).mapInPandas(run, RECORD)


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response record; others give none."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                if r.warc_type != "response":
                    continue
                head, _, payload = bytes(r.block or b"").partition(b"\r\n\r\n")
                page = payload.decode("utf-8", "replace")
                source = dict(r.headers or {})
                uri = r.target_uri if isinstance(r.target_uri, str) else None
                charset, lang, title, links = _facts(page)
                fields = [("status", head.split(b" ")[1].decode() if head.count(b" ") else ""), ("content-type", source.get("Content-Type", "")),
                          ("payload-digest", r.payload_digest or ""), ("charset", charset),
                          ("language", lang), ("title", title), ("outlinks", str(len(links)))] + [("outlink", x) for x in links]
                meta = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields if v).encode()
                text = _plain(page).encode()
                kept = {f"X-Source-{k}": v for k, v in source.items()} | {"X-Source-Payload-Digest": r.payload_digest or ""}
                for kind, content, block in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
                    out.append(_row(r.page_id, kind, _record_id(kind, uri or "", r.date or "", r.record_id), r.record_id, uri, r.date, content,
                                    _digest(block) if kind == "conversion" else None, block, kept))
            yield _frame(out)

    return records.mapInPandas(run, RECORD)


# Header of each column in a record.
_HEADER = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "content_type": "Content-Type", "block_digest": "WARC-Block-Digest", "payload_digest": "WARC-Payload-Digest", "content_length": "Content-Length"}


def _bytes(r) -> bytes:
    own = {_HEADER[c]: getattr(r, c) for c in _HEADER}
    lines = [f"{k}: {v}" for k, v in own.items() if isinstance(v, str) or k == "Content-Length"]
    lines += [f"{k}: {v}" for k, v in sorted(dict(r.headers or {}).items()) if k.startswith("X-")]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + bytes(r.block or b"") + b"\r\n\r\n"


def write(records: DataFrame, path: str) -> None:
    """Records as serialised WARC, one row each, in Parquet files under ``path``.

    Each row's ``warc`` bytes are a whole record; rows of a file in order, put
    one after the other, are a valid WARC file.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "warc": [_bytes(r) for r in frame.itertuples(index=False)]})

    records.mapInPandas(run, "page_id long, warc binary").write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records back from what ``write`` wrote."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for i, data in zip(frame["page_id"], frame["warc"]):
                head, _, rest = bytes(data).partition(b"\r\n\r\n")
                h = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
                block = rest[: int(h["Content-Length"])]
                extra = {k: v for k, v in h.items() if k.startswith("X-")}
                if h["WARC-Type"] == "response":
                    extra = dict(x.split(": ", 1) for x in block.partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:])
                own = {c: h.get(name) for c, name in _HEADER.items()}
                out.append((i, own["warc_type"], own["record_id"], own["refers_to"], own["target_uri"], own["date"], own["content_type"],
                            own["block_digest"], own["payload_digest"], len(block), extra, block))
            yield _frame(out)

    return spark.read.parquet(path).mapInPandas(run, RECORD)
