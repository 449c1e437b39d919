"""WARC derivatives: linked metadata and plain-text conversion records from response records.

Responses come from WARC files (read) or are made of a table of pages (responses). A derived record names the response it
comes from by that record's own identifier (WARC-Refers-To), keeps the response's target and date
(WARC-Refers-To-Target-URI, WARC-Refers-To-Date) and carries digests of its own block; the metadata record keeps the
response's HTTP headers and payload digest. Identifiers are made from the content and the response's identifier, so a rerun
makes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, small

VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
HEADERS = "HTTP/1.1 200 OK\nContent-Type: text/html; charset=utf-8"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's name space of URLs

#: What ends an open tag or comment at the end of a page, so that no pattern looks for an end that isn't there, tag by tag.
_END = "-->"
_DROP = regex.compile(r"<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)|<head\b[^>]*>.*?(?:</head\s*>|(?=<body\b)|\Z)", regex.S | regex.I)
_TAG = regex.compile(r"<(?:/?(?P<name>[a-z][^\s/>]*)|[!/?])[^>]*>", regex.I)
_OPEN = regex.compile(r"<(html|a)\b([^>]*)>|<title\b[^>]*>([^<]*(?:<(?!/title\b)[^<]*)*)", regex.I)
_LANG = regex.compile(r"\blang\s*+=\s*+[\"']?([\w-]+)", regex.I)
_HREF = regex.compile(r"\bhref\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", regex.I)
_BLANK = regex.compile(r"[^\S\n]+")
#: Elements that begin a new line.
_BLOCKS = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul title body html".split()
)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def identifier(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(map(str, parts)))}>"


def _line_or_nothing(tag: regex.Match) -> str:
    return "\n" if (tag["name"] or "").lower() in _BLOCKS else ""


def plain_text(page: str) -> str:
    """Visible text: comments, scripts, styles and the head go, block elements break lines, entities are resolved.

    Every pattern eats what it has looked at, so the time is linear in the page, whatever is left open in it.
    """
    text = _TAG.sub(_line_or_nothing, _DROP.sub(" ", page + _END)).removesuffix(_END)
    lines = (_BLANK.sub(" ", x).strip() for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def _one_line(value: str) -> str:
    return " ".join(value.split())


def metadata(page: str, headers: str, payload: str) -> str:
    """A block of application/warc-fields: title, language, the response's headers and digest, and its links in order."""
    title = language = None
    links: dict[str, None] = {}
    for found in _OPEN.finditer(page + _END):
        tag = (found[1] or "").lower()
        if tag == "a":
            if link := _HREF.search(found[2]):
                links.setdefault(_one_line(html.unescape(link[1] or link[2] or link[3] or "")))
        elif tag == "html":
            if language is None and (said := _LANG.search(found[2])):
                language = said[1]
        elif title is None:
            title = _one_line(html.unescape(_TAG.sub("", found[3])))
    lines = [("title", title)] if title is not None else []
    lines += [("language", language)] if language is not None else []
    lines += [("source-header", _one_line(h)) for h in headers.split("\n") if h.strip()]
    lines.append(("source-payload-digest", payload))
    lines += [("outlink", x) for x in links]
    return "".join(f"{k}: {v}\r\n" for k, v in lines)


#: A response, besides its key; and a derived record.
RESPONSE = "record_id string, target_uri string, date string, http_headers string, payload string"
RECORD = "warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, payload_digest string, block_digest string, source_headers string, source_digest string, block string"


def _uuid(name: Column) -> Column:
    """The name's UUID of version 5 among URLs, as identifier makes it."""
    h = F.sha1(F.concat(F.lit(bytearray(_SPACE.bytes)), name.cast("binary")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", date: str | Column = DATE, headers: str | Column = HEADERS) -> DataFrame:
    """(_key, record_id, target_uri, date, http_headers, payload) of a table of pages. Nulls count as empty.

    Pages that come without dates and HTTP headers get the given ones; columns of the table may be given for them. Record
    identifiers are made from key, target, date and payload; rows that repeat all four get one of their own by a number of
    the run's, as no two records may share one. Other columns are not read.
    """
    text = lambda x: F.coalesce((x if isinstance(x, Column) else F.lit(x)).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).alias("_key"), text(F.col(url)).alias("target_uri"), text(date).alias("date"), text(headers).alias("http_headers"), text(F.col(page)).alias("payload"))
    name = F.concat_ws("\x00", F.lit("response"), F.coalesce(F.col("_key").cast("string"), F.lit("")), "target_uri", "date", F.sha1(F.col("payload").cast("binary")))
    rows = rows.withColumn("_name", name)
    again = rows.groupBy(F.xxhash64("_name").alias("_same")).count().where("count > 1").select("_same")
    if not again.isEmpty():
        few = F.broadcast(again) if small(again, 500_000) else again
        number = F.when(F.col("_same").isNotNull(), F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string"))).otherwise(F.lit(""))
        rows = rows.join(few, F.xxhash64("_name") == F.col("_same"), "left").withColumn("_name", F.concat("_name", number))
    return rows.select("_key", _uuid(F.col("_name")).alias("record_id"), "target_uri", "date", "http_headers", "payload")


def derive_one(source: str, uri: str, date: str, headers: str, page: str) -> list[dict]:
    raw = page.encode("utf-8", "replace")
    out = []
    for kind, content, block in (("metadata", "application/warc-fields", metadata(page, headers, digest(raw))), ("conversion", "text/plain; charset=utf-8", plain_text(page))):
        own = digest(block.encode("utf-8", "replace"))
        out.append(
            {
                "warc_type": kind, "record_id": identifier(kind, source, own), "refers_to": source, "target_uri": uri, "date": date, "content_type": content,
                "payload_digest": own, "block_digest": own, "source_headers": headers, "source_digest": digest(raw), "block": block,
            }
        )
    return out


def derivatives(found: DataFrame, key: str = "record_id", record_id: str = "record_id", target_uri: str = "target_uri", date: str = "date", http_headers: str = "http_headers", payload: str = "payload", out: str | None = None) -> DataFrame:
    """Two records of each response: its metadata and its text, with the key and the columns of RECORD.

    found holds response records (see responses and read); their own identifiers, targets, dates and headers are kept as
    they are, nulls as empty. out: what the key is called in the result (as in found, with an underscore if a column of
    RECORD is called so). Empty payloads give a metadata record without title or links and an empty conversion. Each row is
    worked on by itself: no shuffle.
    """
    names = [c.split(" ")[0] for c in RECORD.split(", ")]
    named = out or key
    while named.lower() in names:
        named += "_"
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    few = found.select(F.col(key).alias("_key"), *[text(c).alias(f"_{i}") for i, c in enumerate((record_id, target_uri, date, http_headers, payload))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):  # the records of so many pages are held at a time
                part = batch.iloc[at : at + 256]
                rows = [{"_key": k} | r for k, *x in part.itertuples(index=False, name=None) for r in derive_one(*x)]
                yield pd.DataFrame(rows, columns=["_key", *names])

    kind = found.schema[key].dataType.simpleString()
    return few.mapInPandas(run, f"_key {kind}, {RECORD}").withColumnRenamed("_key", named)


# --- files ----------------------------------------------------------------------------------------------------------------
def serialize(record: dict) -> bytes:
    """A record of RECORD's columns as it stands in a WARC file."""
    block = record["block"].encode("utf-8", "replace")
    head = {
        "WARC-Type": record["warc_type"], "WARC-Record-ID": record["record_id"], "WARC-Refers-To": record["refers_to"],
        "WARC-Refers-To-Target-URI": record["target_uri"], "WARC-Refers-To-Date": record["date"], "WARC-Target-URI": record["target_uri"], "WARC-Date": record["date"],
        "WARC-Block-Digest": record["block_digest"], "WARC-Payload-Digest": record["payload_digest"], "Content-Type": record["content_type"], "Content-Length": len(block),
    }
    return "".join([VERSION, "\r\n", *(f"{k}: {_one_line(str(v))}\r\n" for k, v in head.items()), "\r\n"]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a WARC file's bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(head["Content-Length"])
        yield head, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def _unzipped(data: bytes) -> Iterator[bytes]:
    """The members of a gzip file, which hold a record each; a file that isn't compressed, as it is."""
    if not data.startswith(b"\x1f\x8b"):
        yield data
        return
    at = 0
    while at < len(data):
        member = zlib.decompressobj(31)
        text = member.decompress(memoryview(data)[at:])
        yield text
        if not member.eof or len(member.unused_data) == len(data) - at:
            return
        at = len(data) - len(member.unused_data)


def response(head: dict[str, str], block: bytes) -> tuple | None:
    """The columns of RESPONSE of a response record; null for any other. HTTP headers stand one a line."""
    by = {k.lower(): v for k, v in head.items()}
    if by.get("warc-type") != "response":
        return None
    top, _, body = block.partition(b"\r\n\r\n")
    headers = "\n".join(top.decode("latin-1").split("\r\n"))
    said = regex.search(r"(?im)^content-type:.*?charset=[\"']?([\w.:-]+)", headers)
    try:
        text = body.decode(said[1] if said else "utf-8", "replace")
    except LookupError:
        text = body.decode("utf-8", "replace")
    return by.get("warc-record-id", ""), by.get("warc-target-uri", "").strip("<>"), by.get("warc-date", ""), headers, text


def read(spark: SparkSession, path: str) -> DataFrame:
    """(path, error, record_id, target_uri, date, http_headers, payload) of the response records of WARC files, compressed or not.

    Files are read where Spark runs the tasks, each by one, and records given on in small batches. A file that breaks off
    gives its records up to there and one row with an error and no record; where(error is null) leaves the responses.
    """
    names = [c.split(" ")[0] for c in RESPONSE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place, content in zip(batch["path"], batch["content"]):
                rows: list[tuple] = []
                try:
                    for member in _unzipped(content):
                        for record in parse(member):
                            if (found := response(*record)) is not None:
                                rows.append((place, None, *found))
                        if len(rows) >= 256:
                            yield pd.DataFrame(rows, columns=["path", "error", *names])
                            rows = []
                except (ValueError, KeyError, zlib.error) as e:
                    rows.append((place, f"{type(e).__name__}: {e}", None, None, None, None, None))
                if rows:
                    yield pd.DataFrame(rows, columns=["path", "error", *names])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, f"path string, error string, {RESPONSE}")
