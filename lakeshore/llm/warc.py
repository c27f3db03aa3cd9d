"""WARC derivatives: metadata and plain-text conversion records of response records.

For each response a metadata record (title, links, the source's headers and
digests) and a conversion record (plain text) are derived. Both name the response
in ``WARC-Refers-To`` and keep its target and date; identifiers and digests follow
from the content, so a task that runs again writes the same records.

Files are written by Spark's text writer: a record is its header and block, and
the record separator is the format's own two line ends, so each part is a valid
WARC file. Blocks made here hold no carriage return, hence no separator of records
inside a block; ``read_warc`` still compares every block with its Content-Length.

Defined cases: a null or empty page gives records with an empty text and no links;
a null url becomes an empty target; line breaks in a url are dropped from headers;
rows that repeat are derived each, with equal identifiers; a null ``page_id`` is
left out of the headers; an empty table gives no records; extra columns are
ignored; very long pages are converted whole; a head that is not closed hides
nothing of the body.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import fresh_path, table

VERSION = "WARC/1.1"
CRLF = "\r\n"
SEPARATOR = CRLF + CRLF
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_NAME_ENDS = r"(?=[\s/>]|\Z)"  # <head-banner> is no <head>
_HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|title)" + _NAME_ENDS, re.I)
_CLOSE = {"": re.compile("-->")} | {
    name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "title")
}
_HEAD = re.compile("<head" + _NAME_ENDS, re.I)
_HEAD_END = re.compile("</head" + _NAME_ENDS, re.I)
_BODY = re.compile("<body" + _NAME_ENDS, re.I)
_BREAK = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|table|tr|article|section|nav|header|footer|main|aside|pre|blockquote|form|title)\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[\s]*")
_TITLE = re.compile(rf"<title{_NAME_ENDS}[^>]*>(.*?)</title{_NAME_ENDS}", re.S | re.I)
_LINK = re.compile(r"<(?:a|area)\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def without_hidden(page: str) -> str:
    """The page without comments and the elements that show no text.

    Nothing else of a head shows, so the head's own tags, which HTML allows to leave
    out, need not be paired. What is not closed ends with the head, else at the body,
    else with the page; a title ends at the next tag at the latest.
    """
    head = _HEAD.search(page)
    head_end = head and _HEAD_END.search(page, head.end())
    kept, at, unclosed = [], 0, set()
    while found := _HIDDEN.search(page, at):
        kept += [page[at : found.start()], " "]
        name = (found[1] or "").lower()
        close = None if name in unclosed else _CLOSE[name].search(page, found.end())
        if close:
            at = close.end()
        else:
            unclosed.add(name)
            end = (_TAG if name == "title" else _BODY).search(page, found.end())
            at = end.start() if end else len(page)
        if head_end and found.start() < head_end.start():
            at = min(at, head_end.start())
    return "".join([*kept, page[at:]])


def plain_text(page: str) -> str:
    """The visible text of a page: a line for each block, blanks folded."""
    text = _TAG.sub("", _BREAK.sub("\n", without_hidden(page)))
    text = _BLANK.sub(" ", entities.unescape(text).replace("\r", "\n"))
    return _LINES.sub("\n", text).strip()


def title_and_links(page: str) -> tuple[str, list[str]]:
    found = _TITLE.search(page)
    title = " ".join(entities.unescape(found[1]).split()) if found else ""
    return title, [" ".join(entities.unescape(a or b or c).split()) for a, b, c in _LINK.findall(page)]


def _urn(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("\n", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """record_id, target_uri, date, page_id, headers, payload of raw pages (page_id, url, html).

    The pages carry neither HTTP headers nor a time of capture: a record's block is the page
    under ``HTTP_HEAD``, and ``date`` is given by the caller.
    """
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\\r\\n]+", "")
    payload = F.coalesce(F.col("html"), F.lit(""))
    page_id = F.col("page_id").cast("bigint")
    return pages.select(
        _urn(F.lit("response"), F.coalesce(page_id.cast("string"), F.lit("")), uri, F.sha2(payload, 256)).alias("record_id"),
        uri.alias("target_uri"),
        F.lit(date).alias("date"),
        page_id.alias("page_id"),
        F.map_from_arrays(
            F.array(F.lit("WARC-Type"), F.lit("Content-Type"), F.lit("WARC-Payload-Digest"), F.lit("Content-Length")),
            F.array(
                F.lit("response"), F.lit("application/http;msgtype=response"), _digest(payload),
                (F.octet_length(payload) + len(HTTP_HEAD)).cast("string"),
            ),
        ).alias("headers"),
        payload.alias("payload"),
    )


def write_responses(source: DataFrame, path: str) -> None:
    """The responses as WARC files."""
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("target_uri")),
        F.concat(F.lit("WARC-Date: "), F.col("date")),
        F.concat(F.lit("WARC-Page: "), F.col("page_id").cast("string")),
        F.array_join(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), CRLF),
    ]
    record = F.concat(F.concat_ws(CRLF, *lines), F.lit(SEPARATOR + HTTP_HEAD), F.col("payload"))
    source.select(record.alias("value")).write.option("lineSep", SEPARATOR).text(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The response records of WARC files, for ``derive``; the payload is what follows the HTTP head."""
    records = read_warc(spark, path).where(F.col("headers")["WARC-Type"] == "response")
    h = F.col("headers")
    kept = F.map_filter("headers", lambda k, _: ~k.isin("WARC-Record-ID", "WARC-Target-URI", "WARC-Date", "WARC-Page"))
    head = F.length(F.substring_index("block", SEPARATOR, 1)) + len(SEPARATOR)
    return records.select(
        h["WARC-Record-ID"].alias("record_id"),
        F.coalesce(h["WARC-Target-URI"], F.lit("")).alias("target_uri"),
        h["WARC-Date"].alias("date"),
        h["WARC-Page"].cast("bigint").alias("page_id"),
        kept.alias("headers"),
        F.substring(F.col("block"), head + 1, F.length("block")).alias("payload"),
    )


def derive(source: DataFrame) -> DataFrame:
    """The records derived from responses: header (name and value pairs in order) and block."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, fields = [], []
            for page, kept in zip(batch.column("payload").to_pylist(), batch.column("headers").to_pylist(), strict=True):
                texts.append(plain_text(page))
                title, links = title_and_links(page)
                lines = [("title", title), *(("source-" + k.lower(), v) for k, v in kept), *(("outlink", x) for x in links)]
                fields.append("".join(f"{k}: {v}\n" for k, v in lines))
            names = ["record_id", "target_uri", "date", "page_id", "headers"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(texts, pa.string()), pa.array(fields, pa.string())],
                [*names, "text", "fields"],
            )

    schema = "record_id string, target_uri string, date string, page_id bigint, headers map<string,string>, text string, fields string"
    made = source.select("record_id", "target_uri", "date", "page_id", "headers", "payload").mapInArrow(convert, schema)
    return made.select(
        "record_id", "target_uri", "date", "page_id", F.col("headers").alias("source"),
        F.inline(
            F.array(
                F.struct(F.lit("metadata").alias("type"), F.lit("application/warc-fields").alias("kind"), F.col("fields").alias("block")),
                F.struct(F.lit("conversion").alias("type"), F.lit("text/plain; charset=utf-8").alias("kind"), F.col("text").alias("block")),
            )
        ),
    )


def _record(rows: DataFrame) -> Column:
    """A derived record as text: version, header lines, empty line, block."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value)

    lines = [
        F.lit(VERSION),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", _urn(F.col("type"), F.col("record_id"), F.sha2(F.col("block"), 256))),
        line("WARC-Refers-To", F.col("record_id")),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("date")),
        line("WARC-Block-Digest", _digest(F.col("block"))),
        line("WARC-Source-Payload-Digest", F.col("source")["WARC-Payload-Digest"]),
        line("WARC-Source-Page", F.col("page_id").cast("string")),
        line("Content-Type", F.col("kind")),
        line("Content-Length", F.octet_length("block").cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(SEPARATOR), F.col("block"))  # a null line is left out


def write_warc(derived: DataFrame, path: str) -> None:
    derived.select(_record(derived).alias("value")).write.option("lineSep", SEPARATOR).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """headers (map) and block of every record below ``path``; fails on a record of another length."""
    raw = spark.read.option("lineSep", SEPARATOR + VERSION + CRLF).text(path)
    rows = raw.select(F.regexp_replace("value", f"^{VERSION}{CRLF}", "").alias("value")).select(
        F.str_to_map(F.substring_index("value", SEPARATOR, 1), F.lit(CRLF), F.lit(": ")).alias("headers"),
        F.expr(f"substring(value, length(substring_index(value, '{SEPARATOR}', 1)) + {len(SEPARATOR) + 1})").alias("block"),
    )
    length = F.col("headers")["Content-Length"].cast("int")
    # a file's last record still has its separator
    last = (F.octet_length("block") == length + len(SEPARATOR)) & F.endswith(F.col("block"), F.lit(SEPARATOR))
    rows = rows.withColumn(
        "block", F.when(last, F.expr(f"substring(block, 1, length(block) - {len(SEPARATOR)})")).otherwise(F.col("block"))
    )
    sound = F.octet_length("block") == length
    return rows.withColumn("block", F.when(sound, F.col("block")).otherwise(F.raise_error(F.lit("record length"))))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived records of all pages, read back from their WARC files."""
    path = fresh_path(spark, "warc")
    write_warc(derive(responses(table(spark, sf_dir, "pages"))), path)
    header = F.col("headers")
    return read_warc(spark, path).select(
        header["WARC-Source-Page"].cast("bigint").alias("page_id"),
        header["WARC-Type"].alias("record_type"),
        header["WARC-Record-ID"].alias("record_id"),
        header["WARC-Refers-To"].alias("refers_to"),
        header["WARC-Target-URI"].alias("target_uri"),
        header["WARC-Source-Payload-Digest"].alias("source_digest"),
        header["WARC-Block-Digest"].alias("block_digest"),
        F.octet_length("block").cast("bigint").alias("n_bytes"),
        _digest(F.col("block")).alias("block_sha256"),
    )
