"""WARC archives of captured pages, and an external merge of their indexes.

Writing: each page becomes a record with its HTML as UTF-8 payload. Of the records with equal
payloads the one of the smallest page id is a response; the others are revisit records that
carry headers only and refer to it. Archives are text files whose records end in two line
breaks, so Spark's text writer and reader handle them as streams on any file system.

Reading: records are parsed by their lengths, payload digests are checked, and each archive's
records form a capture run. Runs are cut by key range, sorted locally by (URL key, timestamp),
and the runs of a range are merged by a loser tree into one globally ordered capture history.
Ranges run over (URL key, timestamp, page id), so a URL with a third of all captures is spread.

Defined results: null html is an empty payload; a null url is an empty key, which sorts first;
rows that repeat the smallest page id of a payload are all responses; a null page id never is
the smallest if another is there. An empty table writes an empty archive and gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bounded_batches, saved, small

VERSION = "WARC/1.1"
END = "\r\n\r\n"
#: What stands between two records; a payload that holds it is sent in two HTTP chunks.
BETWEEN = f"{END}{VERSION}\r\n"
#: Digests of repeated payloads are broadcast up to this many; else they are joined.
BROADCAST_DIGESTS = 500_000
#: Captures merged by one task.
RANGE_ROWS = 100_000
EPOCH = "2026-01-01T00:00:00"


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _escaped(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def record(page_id, url: str | None, payload: bytes, sha1: str, first, when: str) -> bytes:
    """One record without its end. ``first``: the page it revisits, or None."""
    body, coding = payload, ""
    cut = BETWEEN.encode()
    if cut in payload:  # the reader splits at this text, so no record may hold it
        body = b"".join(b"%x\r\n%s\r\n" % (len(x), x) for x in _split(payload, cut) if x) + b"0\r\n\r\n"
        coding = "Transfer-Encoding: chunked\r\n"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{coding}"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + (body if first is None else b"")
    kind = "response" if first is None else "revisit"
    refers = "" if first is None else (f"WARC-Refers-To: <urn:page:{first}>\r\n"
                                       "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")
    head = (f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{page_id}>\r\nWARC-Date: {when}\r\n"
            f"WARC-Target-URI: {_escaped(url)}\r\nWARC-Payload-Digest: sha1:{_base32(sha1)}\r\n{refers}"
            f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n")
    return head.encode() + block


def _split(payload: bytes, cut: bytes) -> list[bytes]:
    parts, at = [], 0
    while (k := payload.find(cut, at)) >= 0:
        parts.append(payload[at:k + 8])
        at = k + 8
    return [*parts, payload[at:]]


def parse(data: bytes) -> tuple:
    """(page_id, url, date, type, refers_to, payload_bytes, digest) of a record without its
    version line. Raises ValueError if lengths or digest disagree with the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n") if ": " in x)
    block = rest[:int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda x: None if x is None or "None" in x else int(x.removeprefix("<urn:page:").rstrip(">"))
    if fields["WARC-Type"] == "response":
        if b"Transfer-Encoding: chunked" in http:
            parts, at = [], 0
            while n := int(body[at:(k := body.index(b"\r\n", at))], 16):
                parts.append(body[k + 2:k + 2 + n])
                at = k + 4 + n
            body = b"".join(parts)
        if len(body) != size or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its length or digest")
    return (number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI", ""), fields["WARC-Date"], fields["WARC-Type"],
            number(fields.get("WARC-Refers-To")), size, digest)


def url_key(url: str) -> str:
    """Host labels reversed, then path and query: captures of a site sort together."""
    host, slash, rest = re.sub(r"^[^:/?#]*://", "", url).partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")" + slash + rest


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [record(*x) for x in zip(b["page_id"].to_pylist(), b["url"].to_pylist(),
                                       b["html"].cast(pa.binary()).to_pylist(), b["sha1"].to_pylist(),
                                       b["first"].to_pylist(), b["date"].to_pylist(), strict=True)]
        yield pa.record_batch([pa.array(out, pa.binary()).cast(pa.string())], ["value"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write one record per page under ``path``; payloads under ``min_bytes`` are all responses."""
    bounded_batches(pages.sparkSession)
    when = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH), "yyyy-MM-dd'T'HH:mm:ss")
                                             + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(100_000_000))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"),
                        when.alias("date"))
    many = (rows.where(F.octet_length("html") >= min_bytes).groupBy("sha1")
                .agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("sha1", "least"))
    both = rows.join(small(saved(many, "payloads"), BROADCAST_DIGESTS), "sha1", "left")
    first = F.when(F.col("least").isNotNull() & ~F.col("least").eqNullSafe(F.col("page_id")), F.col("least"))
    (both.withColumn("first", first).mapInArrow(_records, "value string")
         .write.option("lineSep", END).option("compression", "gzip").text(path))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(url_key(r[1]), r[2], r[0], r[5], r[6], r[3], r[4]) for x in b.column(0).cast(pa.binary()).to_pylist()
                if x.strip() for r in [parse(x.removeprefix(f"{VERSION}\r\n".encode()))]]
        cols = list(zip(*rows, strict=True)) or [()] * 7
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        run = b.column(1).slice(0, len(rows)) if len(rows) == b.num_rows else b.column(1).filter(
            pa.array([bool(x.strip()) for x in b.column(0).cast(pa.binary()).to_pylist()]))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)] + [run], INDEX.names)


INDEX = pa.schema([("url_key", pa.string()), ("captured_at", pa.string()), ("page_id", pa.int64()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64()), ("run", pa.string())])
INDEX_DDL = ("url_key string, captured_at string, page_id long, payload_bytes long, payload_digest string, "
             "record_type string, refers_to long, run string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index rows of every record; ``run`` names the archive."""
    bounded_batches(spark)
    lines = spark.read.option("lineSep", BETWEEN).text(path).select("value", F.input_file_name().alias("run"))
    return lines.mapInArrow(_parsed, INDEX_DDL)


class LoserTree:
    """Merges k sorted sequences; each step replays one leaf-to-root path of log k matches."""

    def __init__(self, runs: Sequence[Sequence]):
        self.runs, self.at, self.k = runs, [0] * len(runs), max(len(runs), 1)
        self.losers = [-1] * self.k
        for leaf in range(len(runs)):
            self._replay(leaf)

    def _less(self, a: int, b: int) -> bool:
        """Exhausted runs lose to all; equal heads go by run."""
        x = self.runs[a][self.at[a]] if self.at[a] < len(self.runs[a]) else None
        y = self.runs[b][self.at[b]] if self.at[b] < len(self.runs[b]) else None
        return x is not None and (y is None or (x, a) < (y, b))

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node:
            if self.losers[node] < 0:  # still filling the tree: wait here for the other side
                self.losers[node] = winner
                return
            if self._less(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.runs:
            w = self.losers[0]
            if self.at[w] >= len(self.runs[w]):
                return
            yield w, self.at[w]
            self.at[w] += 1
            self._replay(w)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one key range, sorted by run and key: merges the runs."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got).combine_chunks()
    runs, bounds = t["run"].to_pylist(), [0]
    bounds += [i for i in range(1, len(runs)) if runs[i] != runs[i - 1]] + [len(runs)]
    low = -(1 << 63)
    keys = list(zip(t["url_key"].to_pylist(), t["captured_at"].to_pylist(),
                    (low if x is None else x for x in t["page_id"].to_pylist()), strict=True))
    parts = [keys[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    order = [bounds[r] + i for r, i in LoserTree(parts)]
    yield from t.take(pa.array(order)).to_batches(max_chunksize=10_000)


def merge_runs(index: DataFrame) -> DataFrame:
    """The index in global order of (url_key, captured_at, page_id): partitions are ranges in
    order, and rows within each are in order."""
    ranges = max(1, -(-index.count() // RANGE_ROWS), int(index.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")) // 4)
    key = ("url_key", "captured_at", "page_id")
    return (index.repartitionByRange(ranges, *key).sortWithinPartitions("run", *key).mapInArrow(_merge, INDEX_DDL))


def capture_history(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write archives of ``pages``, read them back and merge their indexes."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, f"llm/warc-{uuid.uuid4().hex}")
    write_archives(pages, path, min_bytes)
    return merge_runs(saved(read_archives(spark, path), "warc-index"))
