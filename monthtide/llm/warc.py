"""WARC derivatives: linked metadata and plain-text conversion records of response records.

Each response gives two records. The metadata record (application/warc-fields) holds the
title, the language, the links, and what the source said of itself: its HTTP status, headers
and digests. The conversion record (text/plain) holds the text a reader sees. Both refer to the
response by its identifier, keep its target and date, carry digests of their own, and name each
other as concurrent. Identifiers are derived from the response's, so reruns agree.

Rows are worked on where they are; nothing is shuffled.

The target and the source's headers are kept character by character, but for line ends, which
would end a field. A tag is read up to the next angle bracket, so that every pattern takes time
in proportion to the page, whatever is left open in it.

Defined results: a null url is the empty target, null html an empty page, a null date the
epoch. Responses that repeat give derivatives that repeat. Pages are read whole, whatever their
length. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthtide.llm.words import slices

EPOCH = "1970-01-01T00:00:00Z"

RESPONSE = (
    "record_id string, target_uri string, date string, http_headers string, payload string, "
    "block_digest string, payload_digest string"
)
RECORD = (
    "record_id string, type string, refers_to string, target_uri string, date string, "
    "headers string, block string, block_digest string, source_payload_digest string"
)

# Elements that begin a line of their own.
BLOCKS = set(
    "address article aside blockquote br dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead "
    "title tr ul".split()
)
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|noscript)\b[^<>]*>.*?(?:</\1\s*>|\Z)"
    r"|</?([a-z][a-z0-9:-]*)[^<>]*>"
    r"|<[!?][^<>]*>",
    re.DOTALL | re.IGNORECASE,
)
TITLE = re.compile(r"<title\b[^<>]*>", re.IGNORECASE)
TITLE_END = re.compile(r"</title\s*>", re.IGNORECASE)
LANGUAGE = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([^\"'\s>]*)", re.IGNORECASE)
LINK = re.compile(r"<a\s(?:[^<>]*?\s)?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template)\b[^<>]*>.*?(?:</\1\s*>|\Z)", re.DOTALL | re.IGNORECASE
)
BLANKS = re.compile(r"[^\S\n]+")
LINES = re.compile(r" ?\n[\n ]*")


def plain_text(page: str) -> str:
    """The text of a page: one line for each block, entities decoded, blanks single."""
    text = MARKUP.sub(
        lambda m: "\n" if (m.group(2) or "").lower() in BLOCKS else "", page
    )
    return LINES.sub("\n", BLANKS.sub(" ", html.unescape(text).replace("\r", "\n"))).strip()


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def one_line(text: str) -> str:
    return " ".join(html.unescape(text).split())


def bare(field: str) -> str:
    """A field's value as it is, without the line ends that would end it."""
    return field.replace("\r", "").replace("\n", "")


def title_of(page: str) -> str:
    """What the first title element holds, if it is closed."""
    start = TITLE.search(page)
    end = TITLE_END.search(page, start.end()) if start else None
    return one_line(page[start.end() : end.start()]) if end else ""


def links(page: str) -> list[str]:
    """Where a page's anchors lead, each once, in order."""
    found = (one_line(a or b or c) for a, b, c in LINK.findall(HIDDEN.sub(" ", page)))
    return list(dict.fromkeys(x for x in found if x))


def derived_id(record_id: str, kind: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id} {kind}')}"


def header_block(fields: list[tuple[str, str]]) -> str:
    return "".join(f"{name}: {value}\r\n" for name, value in fields if value)


def derivatives_of(response: dict) -> Iterator[dict]:
    """The metadata and the conversion record of one response."""
    page, source = response["payload"] or "", response["record_id"]
    language = LANGUAGE.search(page)
    http = (response["http_headers"] or "").split("\r\n")
    fields = [
        ("title", title_of(page)),
        ("language", one_line(language.group(1)) if language else ""),
        ("http-status", bare(http[0])),
        *[("http-header", bare(line)) for line in http[1:]],
        ("source-block-digest", response["block_digest"]),
        ("source-payload-digest", response["payload_digest"]),
        *[("outlink", x) for x in links(page)],
    ]
    ids = {kind: derived_id(source, kind) for kind in ("metadata", "conversion")}
    for kind, other, content, block in (
        ("metadata", "conversion", "application/warc-fields", header_block(fields)),
        ("conversion", "metadata", "text/plain; charset=utf-8", plain_text(page)),
    ):
        data = block.encode()
        date = response["date"] or EPOCH
        own = digest(data)
        headers = header_block(
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", f"<{ids[kind]}>"),
                ("WARC-Date", date),
                ("WARC-Target-URI", bare(response["target_uri"] or "")),
                ("WARC-Refers-To", f"<{source}>"),
                ("WARC-Concurrent-To", f"<{ids[other]}>"),
                ("WARC-Block-Digest", own),
                ("Content-Type", content),
                ("Content-Length", str(len(data))),
            ]
        )
        yield {
            "record_id": ids[kind],
            "type": kind,
            "refers_to": source,
            "target_uri": response["target_uri"] or "",
            "date": date,
            "headers": headers,
            "block": block,
            "block_digest": own,
            "source_payload_digest": response["payload_digest"],
        }


def responses(
    pages: DataFrame,
    page_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = EPOCH,
) -> DataFrame:
    """Response records of raw pages; their identifiers follow from page and url."""
    rows = pages.select(
        F.coalesce(F.col(page_col).cast("string"), F.lit("")).alias("page"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            out = []
            for row in part.to_pylist():
                payload = row["html"].encode()
                http = (
                    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"Content-Length: {len(payload)}"
                )
                out.append(
                    {
                        "record_id": derived_id(row["url"], f"response {row['page']}"),
                        "target_uri": row["url"],
                        "date": date,
                        "http_headers": http,
                        "payload": row["html"],
                        "block_digest": digest(f"{http}\r\n\r\n".encode() + payload),
                        "payload_digest": digest(payload),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, _strings(RESPONSE))

    return rows.mapInArrow(run, RESPONSE)


def derivatives(of: DataFrame) -> DataFrame:
    """Two rows for each response: its metadata and its conversion record."""
    names = [f.split()[0] for f in RESPONSE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "payload"):
            out = [d for row in part.to_pylist() for d in derivatives_of(row)]
            yield pa.RecordBatch.from_pylist(out, _strings(RECORD))

    return of.select(*names).mapInArrow(run, RECORD)


def _strings(ddl: str) -> pa.Schema:
    return pa.schema([(f.split()[0], pa.string()) for f in ddl.split(", ")])


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """The records as WARC files, one for each partition."""
    text = F.concat(F.lit("WARC/1.1\r\n"), "headers", F.lit("\r\n"), "block")
    records.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "compression", compression
    ).text(path)
