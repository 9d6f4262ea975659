"""WARC archives of captured pages, read back through an index that merges sorted capture runs.

Writing: of rows with equal payloads (SHA-1, length and a second hash) the least id is written as ``response``, the others as
``revisit`` records that refer to it and hold only the HTTP header. Payloads held by more than one in ``HOT_SHARE`` of the copied rows are
less than ``HOT_SHARE`` and are looked up by broadcast; rows of the others meet their original in a shuffled join, so no copied
payload gathers in one task. Spark's own text writer writes the files (one per task, gzip), hence any file system and
the usual commit on retries: a record ends with an empty line, which is the line separator.

Reading: Spark's text reader cuts the files before each record's version line. A payload that holds such a line is written
in HTTP chunks that end inside it. Lengths and the digests of responses are checked while reading; a damaged record raises.

Index: each reading task sorts captures by (URL key, time, id, file, offset) into runs of at most ``RUN_ROWS`` and stores
them. Regular samples of the sorted runs give splitters, about one per ``RANGE_ROWS`` captures. Each range gets its slice of
every run and merges the slices with a loser tree; ranges follow each other, so the whole index is in order. Splitters
are whole sort keys, so that captures of one URL, however many, are cut too. Only the splitters (some 100 bytes a range)
and one row a range (for the link to the previous capture) leave the tasks.

Defined cases: null payload is empty; equal payloads shorter than ``least`` bytes are all responses; a null id comes last,
never is an original, and is a response only if no row with an id has its payload; repeated rows are records of their own, all
responses if their id is the least; null URL: no URL line, and the empty key; control characters and spaces in a
URL become percent codes; very long payloads stay whole; an empty table gives no row; other columns are not read,
whatever their names. Without ``seconds`` the time of a capture is 2000-01-01 plus its id in seconds (modulo 10^9).
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import shared_folder, stored
from llm.tokens import slices

HOT_SHARE = 10_000
RUN_ROWS = 50_000
RANGE_ROWS = 200_000
SAMPLES = 32  # of each run per range
EPOCH = 946_684_800
# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "page_id long, url string, url_key string, seconds long, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, file string, offset long"
)
ORDER = ["url_key", "seconds", "page_id", "file", "offset"]
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


# --- records ------------------------------------------------------------------------------


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Host from the top domain down, then the path: ``https://www.a.example.com:443/B?c`` is ``com,example,a)/B?c``."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url or "")
    host, slash, path = rest.partition("/")
    host = re.sub(r":(80|443)?$", "", host.rpartition("@")[2].lower()).removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + slash + path.partition("#")[0] if url else ""


def chunked(payload: bytes) -> bytes:
    """HTTP chunks none of which holds a whole version line."""
    parts = payload.split(b"WARC/")
    pieces = [p + (b"WARC" if i < len(parts) - 1 else b"") for i, p in enumerate(parts)]
    pieces = [pieces[0], *(b"/" + p for p in pieces[1:])]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in pieces if p) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + size])
        at = line + 4 + size


def encode(page_id: int | None, url: str | None, seconds: int, payload: bytes, original: int | None) -> bytes:
    """One record without its closing empty line; ``original`` makes it a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if original is None and VERSION in b"\r\n" + payload:
        http, body = http + b"Transfer-Encoding: chunked\r\n\r\n", chunked(payload)
    else:
        http, body = http + b"Content-Length: %d\r\n\r\n" % len(payload), payload if original is None else b""
    when = dt.datetime.fromtimestamp(seconds, dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    lines = [
        VERSION[:-2], b"WARC-Type: " + (b"response" if original is None else b"revisit"),
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>".encode(), f"WARC-Date: {when}".encode(),
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}".encode(), b"Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + len(body)}".encode(),
    ]
    if url is not None:
        safe = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(b"WARC-Target-URI: " + safe.encode("utf-8", "surrogatepass"))
    if original is not None:
        lines += [b"WARC-Profile: " + PROFILE, f"WARC-Refers-To: <urn:page:{original}>".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + http + body


def decode(record: bytes) -> tuple:
    """(page_id, url, seconds, type, refers_to, payload bytes, digest) of a record after its version line."""
    head, _, block = record.partition(b"\r\n\r\n")
    field = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n"))
    size = int(field["Content-Length"])
    if len(block) < size or block[size:] not in (b"", b"\r\n\r\n"):
        raise ValueError(f"record {field['WARC-Record-ID']}: {len(block)} bytes where {size} are announced")
    http, _, body = block[:size].partition(b"\r\n\r\n")
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if field["WARC-Type"] == "response":
        payload = unchunked(body) if b"\r\nTransfer-Encoding: chunked" in http else body
        if base32_sha1(payload) != digest:
            raise ValueError(f"record {field['WARC-Record-ID']}: payload differs from its digest")
        length = len(payload)
    else:
        length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    number = lambda x: int(x[len("<urn:page:") : -1]) if x and x != "<urn:page:>" else None
    seconds = int(dt.datetime.fromisoformat(field["WARC-Date"]).timestamp())
    return (
        number(field["WARC-Record-ID"]), field.get("WARC-Target-URI"), seconds, field["WARC-Type"], number(field.get("WARC-Refers-To")),
        length, digest,
    )


# --- archives -----------------------------------------------------------------------------


def _with_originals(rows: DataFrame, least: int) -> DataFrame:
    """Rows (page_id, url, seconds, payload) with ``original``, the id that a copy refers to."""
    payload = F.struct(F.unhex(F.sha1("payload")).alias("s"), F.octet_length("payload").alias("n"), F.xxhash64("payload").alias("h"))
    keyed = rows.withColumn("sum", payload)
    groups = keyed.where(F.octet_length("payload") >= least).groupBy("sum").agg(F.min("page_id").alias("first"), F.count("*").alias("rows"))
    groups = stored(groups.where("rows > 1 AND first IS NOT NULL"), "op12-copies")
    most = max(1000, (groups.agg(F.sum("rows")).first()[0] or 0) // HOT_SHARE)
    hot = groups.where(F.col("rows") > most).select(F.col("sum").alias("hot_sum"), F.col("first").alias("hot_first"))
    marked = keyed.join(F.broadcast(hot), F.col("sum") == F.col("hot_sum"), "left")
    # Rows whose original is known already may go anywhere; the others go to their payload's group.
    nth = F.monotonically_increasing_id()
    anywhere = F.struct(F.lit(b"").alias("s"), F.lit(-1).alias("n"), nth.alias("h"))
    marked = marked.withColumn("key", F.when(F.col("hot_first").isNull(), F.col("sum")).otherwise(anywhere))
    cold = groups.where(F.col("rows") <= most).select(F.col("sum").alias("key"), "first")
    original = F.coalesce("hot_first", "first")
    return marked.join(cold, "key", "left").select(
        "page_id", "url", "seconds", "payload", F.when(~F.col("page_id").eqNullSafe(original), original).alias("original")
    )


def write_archives(
    pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    seconds: Column | None = None,
) -> str:
    """Write one record per row into a new folder of the shared scratch space; returns the folder."""
    chosen = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
        (F.lit(EPOCH) + F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(10**9)) if seconds is None else seconds).cast("long").alias("seconds"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, payloads in slices(batches, "payload"):
            columns = [rows.column(c).to_pylist() for c in ("page_id", "url", "seconds", "original")]
            made = [encode(i, u, s, p or b"", o) for i, u, s, o, p in zip(*columns, payloads, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    records = _with_originals(chosen, least).mapInArrow(run, "value binary")
    records.select(F.col("value").cast("string")).write.option("lineSep", END).option("compression", "gzip").text(folder)
    return folder


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (``RECORD``) of all archives, sorted within runs: ``run`` and ``place`` say where, ``run_rows`` how many it has.

    ``offset`` counts bytes of the decompressed file."""
    texts = spark.read.option("lineSep", END + VERSION.decode()).text(folder)
    texts = texts.select(F.col("_metadata.file_name").alias("file"), F.col("value").cast("binary").alias("value"))
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at, made, task = {}, 0, TaskContext.get().partitionId()

        def close() -> pa.RecordBatch:
            held.sort(key=sort_key)
            columns = [pa.array(c, kind) for c, kind in zip(zip(*held, strict=True), KINDS, strict=True)]
            n = len(held)
            extra = [pa.array(np.full(n, task * (1 << 32) + made)), pa.array(np.arange(n, dtype=np.int64)), pa.array(np.full(n, n, np.int64))]
            held.clear()
            return pa.RecordBatch.from_arrays([*columns, *extra], [*names, "run", "place", "run_rows"])

        for rows, records in slices(batches, "value"):
            for file, record in zip(rows.column("file").to_pylist(), records, strict=True):
                offset = at.get(file, 0)
                # The separator took the version line of all records but the file's first.
                at[file] = offset + len(record) + (len(END) if not offset else len(END) + len(VERSION))
                page_id, url, seconds, kind, refers_to, size, digest = decode(record[len(VERSION) :] if not offset else record)
                held.append((page_id, url, url_key(url), seconds, kind, refers_to, size, digest, file, offset))
                if len(held) == RUN_ROWS:
                    yield close()
                    made += 1
        if held:
            yield close()

    return texts.mapInArrow(run, RECORD + ", run long, place long, run_rows long")


KINDS = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def sort_key(r: tuple) -> tuple:
    """Order of captures from a row of ``RECORD``: URL key, time, id (null last), file, offset."""
    return r[2], r[3], r[0] is None, r[0] or 0, r[8], r[9]


# --- index --------------------------------------------------------------------------------


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, the winner of all is next."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.size = 1 << max(len(runs) - 1, 0).bit_length()
        self.losers = [-1] * self.size
        winners = [*([-1] * self.size), *(i if i < len(runs) and runs[i] else -1 for i in range(self.size))]
        for node in range(self.size - 1, 0, -1):
            winners[node], self.losers[node] = self._match(winners[2 * node], winners[2 * node + 1])
        self.winner = winners[1] if self.size > 1 else winners[-1]

    def _match(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs; -1 has nothing left."""
        if a < 0 or b < 0:
            return (b, a) if a < 0 else (a, b)
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return (b, a) if (y, b) < (x, a) else (a, b)

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place) in order."""
        while self.winner >= 0:
            run = self.winner
            yield run, self.at[run]
            self.at[run] += 1
            now, node = run if self.at[run] < len(self.runs[run]) else -1, (self.size + run) // 2
            while node:
                now, self.losers[node] = self._match(now, self.losers[node])
                node //= 2
            self.winner = now


def splitters(runs: DataFrame) -> list[tuple]:
    """Sort keys that cut the captures into ranges of about ``RANGE_ROWS``, from regular samples of the sorted runs."""
    total = runs.count()
    ranges = -(-total // RANGE_ROWS)
    if ranges < 2:
        return []
    step = max(1, RANGE_ROWS // SAMPLES)
    drawn = runs.where(F.col("place") % step == 0).select(*ORDER, F.least(F.lit(step), F.col("run_rows") - F.col("place")).alias("stands_for"))
    sample = sorted(((k, s, i is None, i or 0, f, o), n) for k, s, i, f, o, n in drawn.toLocalIterator())
    weight = np.cumsum([n for _, n in sample])
    cuts = np.searchsorted(weight, total * np.arange(1, ranges) / ranges)
    return sorted({sample[min(c, len(sample) - 1)][0] for c in cuts.tolist()})


def merged(runs: DataFrame) -> DataFrame:
    """The captures of all runs (stored) in order of (``range``, ``position``), with the id of the same URL's capture before."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    cuts = splitters(runs)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys = zip(*(rows.column(c).to_pylist() for c in ORDER), strict=True)
            of = [bisect_right(cuts, (k, s, i is None, i or 0, f, o)) for k, s, i, f, o in keys]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(of, pa.int64())], [*rows.schema.names, "range"])

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by([("run", "ascending"), ("place", "ascending")]).combine_chunks()
        run = group.column("run").to_numpy()
        keys = [sort_key(r) for r in zip(*(group.column(c).to_pylist() for c in names), strict=True)]
        starts = np.flatnonzero(np.diff(run, prepend=run[0] - 1)).tolist()
        lists = [keys[a:b] for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)]
        order = [starts[r] + p for r, p in LoserTree(lists)]
        out = group.select([*names, "range"]).take(pa.array(order, pa.int64()))
        urls, ids = out.column("url_key").to_pylist(), out.column("page_id").to_pylist()
        before = [ids[i - 1] if i and urls[i] == urls[i - 1] else None for i in range(len(ids))]
        return out.append_column("position", pa.array(np.arange(len(ids)))).append_column("previous_id", pa.array(before, pa.int64()))

    dealt = runs.mapInArrow(deal, RECORD + ", run long, place long, run_rows long, range long")
    index = stored(dealt.groupBy("range").applyInArrow(merge, RECORD + ", range long, position long, previous_id long"), "op12-index")
    # The first capture of a range may follow the last one of the range before.
    last = F.max_by(F.struct("url_key", "page_id"), "position")
    edges = index.groupBy("range").agg(last.alias("last")).select("range", F.lag("last").over(Window.orderBy("range")).alias("before"))
    carried = F.when((F.col("position") == 0) & (F.col("before.url_key") == F.col("url_key")), F.col("before.page_id"))
    return index.join(F.broadcast(edges), "range", "left").select(
        *names, "range", "position", F.coalesce("previous_id", carried).alias("previous_id")
    )


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write the pages as WARC records, read them back and return their merged index."""
    runs = stored(read_archives(pages.sparkSession, write_archives(pages, **options)), "op12-runs")
    return merged(runs)


ORACLE = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS original
  FROM pages
), digit AS (
  SELECT page_id, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest
  FROM page
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM page JOIN digit USING (page_id)
"""
