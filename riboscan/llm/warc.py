"""WARC archives, and their index by an external merge of sorted runs.

Archives are written by Spark's text writer with the record separator CRLF CRLF
as line end, so a lost task is written again and no half file stays. Of equal
payloads one record is the response; the others are revisits without the
payload. Each archive is read whole (its size is that of a shuffle partition)
and yields a run of index rows sorted by URL key, time and page. The runs are
dealt by ranges of that key, and in each range a loser tree merges the slices of
all runs: the ranges, in order, are the capture history of every URL.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.llm.core import Workspace, table

#: Rows of the index that one range holds, about.
RANGE = 100_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
INDEX = "url_key string, captured string, page_id long, url string, archive string, offset long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hexadecimal digits give four of base 32."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    parts = [F.lpad(F.conv(F.substring(F.sha1(data), 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), digits, BASE32)


def iso_time(seconds: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` of seconds since 1970, whatever the session's time zone."""
    day = F.floor(seconds / 86400)
    rest = seconds - day * 86400
    two = lambda c: F.lpad(F.floor(c).cast("string"), 2, "0")
    return F.concat(F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int")).cast("string"), F.lit("T"), two(rest / 3600), F.lit(":"), two(rest % 3600 / 60), F.lit(":"), two(rest % 60), F.lit("Z"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Writes a WARC record for each row: page_id, url, html, captured (seconds since 1970).

    Rows whose payloads of at least ``least_bytes`` bytes are equal share the
    response with the largest page_id; the others revisit it. A null html is an
    empty payload, a null url leaves out the target, a null time is 1970; a
    null page_id never is another's response. Line ends inside a url are
    dropped.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.regexp_replace("url", "[\r\n]+", "").alias("url"), F.coalesce("captured", F.lit(0)).alias("captured"), payload.alias("payload"), base32_sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    first = rows.groupBy("digest").agg(F.max("page_id").alias("first"))
    rows = rows.join(first, "digest")
    again = (F.col("n") >= least_bytes) & F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name("page_id"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.col("url")), F.lit("")),
        F.lit("\r\nWARC-Date: "), iso_time(F.col("captured")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name("first"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    rows.select(F.concat(head, body)).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", 20000).text(path)


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then path and query, lower-case: captures of a site lie together."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return (url or "").lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path.rstrip('/') or '/'}{query}".lower()


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of an unpacked archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        begin = end + 4
        size = int(headers["Content-Length"])
        if data[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} doesn't end where it says")
        yield at, headers, data[begin : begin + size]
        at = begin + size + 4


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def key_of(row: tuple) -> tuple:
    """Order of index rows: URL key, time, page; a null page first."""
    return row[0], row[1], row[2] is not None, row[2] or 0


def run_of(archive: str, data: bytes) -> list[tuple]:
    """The archive's index rows (see INDEX), sorted. Response payloads are checked against their digests."""
    out = []
    for offset, headers, block in records(data):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        if headers["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"the payload at {offset} of {archive} isn't what was written")
        url = headers.get("WARC-Target-URI")
        time = re.sub(r"\D", "", headers["WARC-Date"])
        out.append((url_key(url), time, _page(headers["WARC-Record-ID"]), url, archive, offset, size, digest, headers["WARC-Type"], _page(headers.get("WARC-Refers-To"))))
    return sorted(out, key=key_of)


class LoserTree:
    """Merges sorted runs; each step replays one path of the tree.

    ``tree[0]`` is the run with the least head, ``tree[i]`` the loser of the
    match at node i; an ended run loses every match, and equal heads come in
    the order of the runs.
    """

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.at = [0] * self.k
        self.heads = [key_of(r[0]) if r else None for r in runs]
        self.tree = [0] * max(1, self.k)
        winner = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.tree[node] = (a, b) if self.less(a, b) else (b, a)
        self.tree[0] = winner[1] if self.k > 1 else 0

    def less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None and (x is not None or a < b) or x is not None and y is not None and (x, a) < (y, b)

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[run := self.tree[0]] is not None:
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.heads[run] = key_of(self.runs[run][self.at[run]]) if self.at[run] < len(self.runs[run]) else None
            node, best = (run + self.k) // 2, run
            while node:
                if self.less(self.tree[node], best):
                    self.tree[node], best = best, self.tree[node]
                node //= 2
            self.tree[0] = best


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    part = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def _schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in INDEX.split(", "))])


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index rows of the archives in a folder, each archive's as a sorted run."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1), strict=True):
                data = zlib.decompress(content.as_buffer(), 31)
                yield from _batches(iter(run_of(archive.as_py().rpartition("/")[2], data)), _schema())

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, INDEX)


def merged_index(runs: DataFrame, rows: int) -> DataFrame:
    """The runs' rows in global order of URL key, time and page.

    ``rows``: how many there are. A range holds about RANGE of them; ranges cut
    the history of a URL with very many captures as well.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                parts.setdefault(row[4], []).append(row)
        # a shuffle block keeps the order of its run; sorting a sorted slice costs one pass
        yield from _batches(iter(LoserTree([sorted(parts[a], key=key_of) for a in sorted(parts)])), _schema())

    return runs.repartitionByRange(max(1, math.ceil(rows / RANGE)), "url_key", "captured", "page_id").mapInArrow(merge, INDEX)


def archive_and_index(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes ``pages`` (page_id, url, html, captured) to archives, reads them back and returns their merged index (INDEX).

    One row per row of ``pages``; an empty table gives none. Other columns
    aren't read. See ``write_archives`` for nulls.
    """
    ws = Workspace(spark, "warc")
    write_archives(pages, ws.path("archives"))
    runs = ws.keep(capture_runs(spark, ws.path("archives")), "runs")
    return merged_index(runs, runs.count())


def op1_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no capture time; a page counts as captured page_id seconds after 2024 began."""
    pages = table(spark, sf_dir, "pages").withColumn("captured", F.col("page_id") + 1704067200)
    return archive_and_index(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, n, list_aggregate(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INT), 1)), 'string_agg', '') AS digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM m
"""
