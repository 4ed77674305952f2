"""WARC derivatives: link each response to a metadata and a plain-text conversion record.

A response row holds one archived HTTP response.  The builder keeps its target, date and
record id (as WARC-Refers-To), its source headers and its digests, and gives both derived
records their own ids, digests and bytes.  Ids follow from the content, so a task that runs
twice writes the same records.  Each row is handled alone: nothing is shuffled.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.llm.frames import small_batches

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
CONVERSION_TYPE = "text/plain"
METADATA_TYPE = "application/json"
RESPONSE_TYPE = "application/http; msgtype=response"

#: Crawl date of rows that bring none.
NO_DATE = "1970-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("5c6c2d0e-53f1-4f43-9f59-0d5e1d6e0c11")

#: Where hidden content begins, and where each kind of it ends.
HIDDEN = re.compile(r"<(script|style|noscript|template)(?=[\s/>])|<!--", re.I)
CLOSING = {k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "noscript", "template")} | {"": re.compile("-->")}
BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|div|dl|dd|dt|figure|footer|form|h[1-6]|head|header|hr|html|li|main"
    r"|nav|ol|p|pre|section|table|tbody|td|th|thead|title|tr|ul)\b[^>]*>", re.I
)
TAG = re.compile(r"<[!/?]?[a-zA-Z][^>]*>")
SPACES = re.compile(r"[ \t\r\f\v ]+")
TITLE = re.compile(r"<title\b[^>]*", re.I)
TITLE_END = re.compile(r"</title\s*>", re.I)
LANG = re.compile(r"<html\b([^>]*)", re.I)
LANG_VALUE = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
ANCHOR = re.compile(r"<a\b[^>]*", re.I)
HREF = re.compile(r"\bhref\s*=\s*", re.I)
VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")
#: Where a page may say its charset, in the first bytes of the payload.
META = re.compile(rb"<meta\b[^<>]*?\bcharset\s*=\s*[\"']?\s*([\w:.-]+)", re.I)
CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([\w:.-]+)", re.I)
META_BYTES = 4096

RESPONSE_FIELDS = "record_id string, target_uri string, date string, block binary, block_digest string, payload_digest string"
RECORD_FIELDS = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "block_digest string, content_length bigint, record binary"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(parts))}>"


def without_hidden(markup: str) -> str:
    """Scripts, styles, comments and the like become a space, in one pass forward.

    An opening without an end hides the rest of the page if it is a script or style, and
    nothing otherwise; that an end is not there is found once for each kind.
    """
    out, done, none_left = [], 0, set()
    for m in HIDDEN.finditer(markup):
        kind = (m[1] or "").lower()
        if m.start() < done or kind in none_left:
            continue
        end = CLOSING[kind].search(markup, m.end())
        if end is None:
            none_left.add(kind)
            if kind in ("script", "style"):
                return "".join([*out, markup[done : m.start()], " "])
            continue
        out += [markup[done : m.start()], " "]
        done = end.end()
    return "".join([*out, markup[done:]])


def chunks_joined(payload: bytes) -> bytes | None:
    """The body of a chunked transfer, None where it is not one."""
    out, at = [], 0
    while True:
        stop = payload.find(b"\r\n", at, at + 1024)
        if stop < 0:
            return None
        head = payload[at:stop].partition(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", head):
            return None
        size = int(head, 16)
        if size == 0:
            return b"".join(out)
        if stop + 2 + size > len(payload):
            return None
        out.append(payload[stop + 2 : stop + 2 + size])
        at = stop + 2 + size + 2


def decoded_body(headers: list[tuple[str, str]], payload: bytes) -> tuple[str, str, list[str]]:
    """The body as text, the charset it was read in, and what could not be undone.

    Chunked transfer and gzip or deflate coding are undone in the headers' order; the charset
    is that of the Content-Type, else of the page's meta tag, else UTF-8.
    """
    named = {k.lower(): v for k, v in headers}
    failed: list[str] = []
    if "chunked" in named.get("transfer-encoding", "").lower():
        joined = chunks_joined(payload)
        failed += ["chunked"] if joined is None else []
        payload = payload if joined is None else joined
    for coding in reversed([x.strip().lower() for x in named.get("content-encoding", "").split(",")]):
        if coding in ("", "identity"):
            continue
        try:
            if coding in ("gzip", "x-gzip"):
                payload = zlib.decompress(payload, 47)
            elif coding == "deflate":
                try:
                    payload = zlib.decompress(payload)
                except zlib.error:
                    payload = zlib.decompress(payload, -15)
            else:
                failed.append(coding)
                break
        except zlib.error:
            failed.append(coding)
            break
    said = CHARSET.search(named.get("content-type", ""))
    meta = META.search(payload, 0, META_BYTES)
    charset = said[1] if said else meta[1].decode("ascii", "replace") if meta else "utf-8"
    try:
        charset = codecs.lookup(charset).name
        if not codecs.lookup(charset)._is_text_encoding:
            raise LookupError(charset)
    except (LookupError, ValueError):
        failed.append(f"charset {charset}")
        charset = "utf-8"
    return payload.decode(charset, "replace"), charset, failed


def plain_text(markup: str) -> str:
    """Visible text: hidden elements and tags go, block elements end a line."""
    shown = without_hidden(markup)
    # Behind the last > no tag can end, and a search there would run on to the end every time.
    tags, end, rest = shown.rpartition(">")
    text = TAG.sub("", BLOCK.sub("\n", tags + end)) + rest
    lines = (SPACES.sub(" ", x).strip() for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def split_response(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in order and payload of an HTTP response block."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        return "", [], block
    lines = head.decode("utf-8", "replace").split(CRLF)
    pairs = [x.partition(":") for x in lines[1:]]
    return lines[0], [(k.strip(), v.strip()) for k, _, v in pairs], payload


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record: version, headers, empty line, block, two line ends."""
    clean = [(k, re.sub(r"[\r\n]+", " ", v)) for k, v in headers]
    head = CRLF.join([VERSION, *(f"{k}: {v}" for k, v in clean)]) + CRLF + CRLF
    return head.encode() + block + (CRLF + CRLF).encode()


def parse_records(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Headers and block of every record on end; the inverse of ``serialise``."""
    out, at = [], 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split(CRLF)
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        out.append((headers, data[stop + 4 : stop + 4 + size]))
        at = stop + 4 + size + 4
    return out


def record(kind: str, source: dict, block: bytes, content_type: str) -> tuple:
    """A derived record as a row of ``RECORD_FIELDS``."""
    own = urn(kind, source["record_id"])
    block_digest = digest(block)
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source["record_id"]),
        ("WARC-Target-URI", source["target_uri"]), ("WARC-Date", source["date"]),
        ("WARC-Block-Digest", block_digest), ("Content-Type", content_type), ("Content-Length", str(len(block))),
    ]
    return (
        kind, own, source["record_id"], source["target_uri"], source["date"], content_type, block_digest,
        len(block), serialise(headers, block),
    )


def derive(source: dict) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    status, headers, payload = split_response(source["block"])
    markup, charset, failed = decoded_body(headers, payload)
    opened, page = TITLE.search(markup), LANG.search(markup)
    closed = TITLE_END.search(markup, opened.end()) if opened else None
    lang = LANG_VALUE.search(page[1]) if page else None
    named = (HREF.search(markup, a.start(), a.end()) for a in ANCHOR.finditer(markup))
    links = [VALUE.match(markup, h.end()) for h in named if h]
    found = {
        "refers_to": source["record_id"], "target_uri": source["target_uri"], "date": source["date"],
        "block_digest": source["block_digest"], "payload_digest": source["payload_digest"],
        "block_digest_valid": source["block_digest"] == digest(source["block"]),
        "payload_digest_valid": source["payload_digest"] == digest(payload),
        "http_status": status, "http_headers": [list(x) for x in headers],
        "title": plain_text(markup[opened.end() + 1 : closed.start()]) if closed else None, "lang": lang[1] if lang else None,
        "links": [html.unescape(m[1] or m[2] or m[3] or "") for m in links if m],
        "payload_length": len(payload),
    }
    if charset != "utf-8":
        found["charset"] = charset
    if failed:
        found["not_decoded"] = failed
    about = json.dumps(found, ensure_ascii=False, separators=(",", ":")).encode()
    return [
        record("metadata", source, about, METADATA_TYPE),
        record("conversion", source, plain_text(markup).encode(), CONVERSION_TYPE),
    ]


def derive_batches(batches: Iterator[pa.RecordBatch], key: pa.Field, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, keys = [], []
        for source in batch.to_pylist():
            made = derive(source)
            rows += made
            keys += [source[key.name]] * len(made)
        if rows:
            columns = [pa.array(keys, key.type), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:]))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def derivatives(responses: DataFrame, key: str = "page_id") -> DataFrame:
    """Two records per response: ``metadata`` (JSON) and ``conversion`` (plain text).

    ``responses`` has ``key`` and the columns of ``RESPONSE_FIELDS``; other columns are not
    read.  ``record`` holds the record's bytes as a WARC file has them.  Digests that do not
    match the source are kept as they were and marked in the metadata.  NULL uri, date, id
    or block count as empty; an empty or header-less block gives an empty or whole-block
    conversion.  Chunked, gzip and deflate bodies are undone and the header's or page's
    charset is used for the text; the digests stay those of the bytes as they came, and what
    cannot be undone is named in the metadata.  Repeated rows give equal records, one pair
    each.  Long pages are read whole, in passes forward; an empty table gives no records.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    small_batches(responses.sparkSession, 200)
    kind = responses.schema[key].dataType
    fields = f"`{key}` {kind.simpleString()}, {RECORD_FIELDS}"
    names = [x.split()[0] for x in RECORD_FIELDS.split(", ")]
    types = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    arrow_key = pa.field(key, to_arrow_type(kind))
    schema = pa.schema([arrow_key, *(pa.field(n, types[x.split()[1]]) for n, x in zip(names, RECORD_FIELDS.split(", ")))])
    text = ("record_id", "target_uri", "date", "block_digest", "payload_digest")
    source = responses.select(
        key, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in text],
        F.coalesce(F.col("block"), F.lit("").cast("binary")).alias("block"),
    )
    return source.mapInArrow(lambda it: derive_batches(it, arrow_key, schema), fields)


def response_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page in batch.to_pylist():
            payload = (page["html"] or "").encode()
            head = CRLF.join(
                ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
            )
            block = head.encode() + b"\r\n\r\n" + payload
            uri = page["url"] or ""
            own = urn("response", str(page["page_id"]), uri, digest(payload))
            out.append((page["page_id"], own, uri, NO_DATE, block, digest(block), digest(payload)))
        if out:
            names = ["page_id", "record_id", "target_uri", "date", "block", "block_digest", "payload_digest"]
            types = [batch.schema.field(0).type, pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def responses_of(pages: DataFrame) -> DataFrame:
    """Crawled pages as response rows.  NULL url or html count as empty."""
    small_batches(pages.sparkSession, 200)
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(response_batches, f"page_id {kind}, {RESPONSE_FIELDS}")


def write_files(records: DataFrame, path: str) -> None:
    """Every partition's records as one gzip member each, in binary files of a table.

    The member bytes are rows of a Parquet table; concatenated in any order they are a
    valid ``.warc.gz`` file.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for x in batch.column(0):
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed.append(z.compress(x.as_py()) + z.flush())
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["member"])

    records.select("record").mapInArrow(members, "member binary").write.parquet(path)


def op7(pages: DataFrame) -> DataFrame:
    made = derivatives(responses_of(pages))
    return made.select("*", F.sha2("record", 256).alias("record_sha256"))
