"""WARC derivatives: responses become linked metadata and plain-text conversion records.

A record is a row: its type, identifiers, headers and block.  Each response gives a
conversion record (the page's visible text) and a metadata record (what is known of
the response: its HTTP headers, digests, title, links and the conversion's id).  Both
refer to the response; identifiers are name-based, so building again gives the same
records.  ``write`` stores records as WARC/1.1 files through Spark's text writer, one
file per task, and ``read`` gets rows back from such files.
"""

from __future__ import annotations

import base64
import re
from hashlib import sha1
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import map_slices
from tidepool.llm.html_layout import Node, parse, render_tree
from tidepool.session import ship_package

VERSION = "WARC/1.1"
CRLF = "\r\n"
RECORD = ("page_id long, record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, warc_date string, "
          "content_type string, payload_digest string, block_digest string, content_length long, block string")
_FIELDS = [f.split(" ")[0] for f in RECORD.split(", ")]
_HEADERS = {"WARC-Type": "record_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to", "WARC-Concurrent-To": "concurrent_to",
            "WARC-Target-URI": "target_uri", "WARC-Date": "warc_date", "Content-Type": "content_type",
            "WARC-Payload-Digest": "payload_digest", "WARC-Block-Digest": "block_digest"}
_BREAK = re.compile(r"[\r\n]+")


def digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1(raw).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def _record(**values) -> tuple:
    raw = values["block"].encode("utf-8")
    values |= {"block_digest": digest(raw), "content_length": len(raw)}
    return tuple(values.get(f) for f in _FIELDS)


def response(page_id, url: str | None, page: str | None, date: str) -> tuple:
    """The response record of a crawled page."""
    body = page or ""
    raw = body.encode("utf-8")
    head = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(raw)}{CRLF}{CRLF}"
    payload = digest(raw)
    return _record(page_id=page_id, record_type="response", record_id=record_id("response", page_id, url, payload), target_uri=_line(url),
                   warc_date=date, content_type="application/http;msgtype=response", payload_digest=payload, block=head + body)


def _line(value: str | None) -> str | None:
    """A header value on one line."""
    return None if value is None else _BREAK.sub(" ", value)


def title_links(page: Node) -> tuple[str, list[str]]:
    """Title and link targets of a parsed page, in page order."""
    title, links, todo = "", [], [page]
    while todo:
        node = todo.pop()
        if node.tag == "title" and not title:
            title = " ".join("".join(c for c in node.children if isinstance(c, str)).split())
        if node.tag in ("a", "area") and (href := node.get("href")):
            links.append(" ".join(href.split()))
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return title, links


def derive(source: dict) -> list[tuple]:
    """The conversion and metadata records of one response record (a dict of its fields)."""
    head, _, body = (source["block"] or "").partition(CRLF + CRLF)
    status, *headers = head.split(CRLF)
    shared = {"page_id": source["page_id"], "refers_to": source["record_id"], "target_uri": source["target_uri"],
              "warc_date": source["warc_date"], "payload_digest": source["payload_digest"]}
    text_id, data_id = record_id("conversion", source["record_id"]), record_id("metadata", source["record_id"])
    page = parse(body)
    title, links = title_links(page)
    fields = [("http-status", status), *(("http-header", h) for h in headers if h), ("source-payload-digest", source["payload_digest"]),
              ("source-block-digest", source["block_digest"]), ("conversion-record", text_id), ("title", title), *(("outlink", x) for x in links)]
    block = "".join(f"{k}: {v}{CRLF}" for k, v in fields if v)
    return [_record(**shared, record_type="conversion", record_id=text_id, concurrent_to=data_id, content_type="text/plain; charset=utf-8",
                    block=render_tree(page)),
            _record(**shared, record_type="metadata", record_id=data_id, concurrent_to=text_id, content_type="application/warc-fields", block=block)]


def _columns(rows: list[tuple]) -> dict:
    return dict(zip(_FIELDS, map(list, zip(*rows)))) if rows else {f: [] for f in _FIELDS}


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Response records of ``pages`` (page_id, url, html), all dated ``date``.

    A null url leaves out the target, a null page is an empty payload; repeated rows give
    the same record again; an empty table gives no records.
    """
    def make():
        return lambda cols: _columns([response(*r, date) for r in zip(cols["page_id"], cols["url"], cols["html"])])
    return map_slices(pages.select("page_id", "url", "html"), make, RECORD)


def derivatives(records: DataFrame) -> DataFrame:
    """Conversion and metadata records of the response records among ``records``; other records give none.

    A response whose block is null or holds no HTTP payload gives an empty conversion and
    the metadata that are left; an empty table gives no records.
    """
    def make():
        def step(cols):
            rows = [dict(zip(cols, r)) for r in zip(*cols.values())]
            return _columns([d for r in rows for d in derive(r)])
        return step
    return map_slices(records.where("record_type = 'response'").select(*_FIELDS), make, RECORD)


def build(pages: DataFrame, date: str) -> DataFrame:
    """The derivatives of ``pages``' responses in one pass, without moving the responses out of the task."""
    def make():
        def step(cols):
            made = [response(*r, date) for r in zip(cols["page_id"], cols["url"], cols["html"])]
            return _columns([d for r in made for d in derive(dict(zip(_FIELDS, r)))])
        return step
    return map_slices(pages.select("page_id", "url", "html"), make, RECORD)


def write(records: DataFrame, path: str, compression: str = "none") -> None:
    """Store records as WARC/1.1 files under ``path``, a folder that all executors share."""
    head = [F.lit(VERSION), *(F.concat(F.lit(f"{name}: "), F.col(column)) for name, column in _HEADERS.items()),
            F.concat(F.lit("Content-Length: "), F.col("content_length")), F.lit("")]
    # concat_ws passes over nulls, so a header without a value is left out
    text = F.concat(F.concat_ws(CRLF, *head), F.lit(CRLF), F.col("block"))
    records.select(text.alias("value")).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)


_SEPARATOR = f"{CRLF}{CRLF}{VERSION}{CRLF}"
_STATED = re.compile(r"(?:^|\n)Content-Length: ([0-9]{1,18})(?:\r|$)")


def _rejoined(batches):
    """Record texts of files whose pieces come in order: a piece that lacks bytes of its stated length takes the next ones."""
    file, held, lacking = None, [], 0  # pieces of the record so far, and the bytes of its block that are still to come
    for batch in batches:
        out = []
        for name, piece in zip(*(batch.column(c).to_pylist() for c in ("file", "value"))):
            first = name != file
            if first:
                out += held  # a file that ends in the middle of a record: what came of it, piece by piece
                file, held = name, []
                piece = piece.removeprefix(VERSION + CRLF)
            if held:
                lacking -= len(_SEPARATOR) + len(piece.encode("utf-8"))
                held.append(piece)
                if lacking < 0 and not (lacking == -4 and piece.endswith(CRLF * 2)):
                    out += held  # the stated length was wrong: every piece is taken for a record
                    held = []
                elif lacking <= 0:
                    out.append(_SEPARATOR.join(held))
                    held = []
                continue
            head, _, block = piece.partition(CRLF * 2)
            stated = _STATED.search(head)
            lacking = int(stated[1]) - len(block.encode("utf-8")) if stated else 0
            if lacking > 0:
                held = [piece]
            else:
                out.append(piece)
        yield pa.RecordBatch.from_pydict({"v": pa.array(out, pa.string())})
    yield pa.RecordBatch.from_pydict({"v": pa.array(held, pa.string())})


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, plain or compressed (by the file's ending); page_id is not stored and comes back null.

    Files are split at record starts.  Where a block holds the text of a record start, its
    record is cut there and lacks bytes of its stated length; only the files that hold
    such a piece are put in order and their records joined again by the stated lengths.
    ``whole`` tells whether the block has its stated length: false in a damaged file.
    """
    ship_package(spark)
    pieces = spark.read.option("lineSep", _SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("nth"), "value")
    plain = pieces.select("file", F.regexp_replace("value", rf"^{VERSION}{CRLF}", "").alias("v"))
    odd = _parsed(plain).where("not coalesce(whole, false)").select("file").distinct()
    joined = (pieces.join(odd, "file", "left_semi").repartition("file").sortWithinPartitions("file", "at", "nth")
              .select("file", "value").mapInArrow(_rejoined, "v string"))
    return _parsed(plain.join(odd, "file", "left_anti").select("v").unionByName(joined)).select(*_FIELDS, F.coalesce("whole", F.lit(False)).alias("whole"))


def _parsed(records: DataFrame) -> DataFrame:
    """The fields of record texts (v), with what else the rows have."""
    rows = records.withColumn("head", F.substring_index("v", CRLF * 2, 1))
    block = F.expr("substring(v, length(head) + 5)")
    # the last record of a file still has the two line ends that close it
    size = F.regexp_extract("head", r"(?:^|\n)Content-Length: ([0-9]{1,18})(?:\r|$)", 1).try_cast("long")
    block = F.when((F.octet_length(block) == size + 4) & block.endswith(CRLF * 2), F.expr("substring(v, length(head) + 5, length(v) - length(head) - 8)")).otherwise(block)
    value = {c: F.regexp_extract("head", rf"(?:^|\n){n}: ([^\r]*)", 1) for n, c in _HEADERS.items()}
    rows = rows.select("*", F.lit(None).cast("long").alias("page_id"), *[F.when(x != "", x).alias(c) for c, x in value.items()],
                       size.alias("content_length"), block.alias("block"))
    return rows.withColumn("whole", F.octet_length("block") == F.col("content_length"))
