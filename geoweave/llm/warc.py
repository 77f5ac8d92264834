"""WARC archives and capture histories by an external index merge.

Writing: payloads are digested (SHA-1, base32). Of the captures with equal payloads of at least
MIN_REVISIT_BYTES bytes the one with the largest id becomes the response, the others revisits
that refer to it. Records are gzip members in archives of about ARCHIVE_BYTES; an archive is a
row (archive, content) of a table, whose contents are valid .warc.gz files.

Reading: archives are parsed record by record, and the index entries (one capture each) are
written as runs, each sorted by URL key, timestamp and id.

Merge: the runs are cut into ranges of that key by sampled bounds (a hot URL key is split by
timestamp and id). The number of ranges follows the number of captures, so that a range has about
RANGE_ENTRIES of them however large the crawl. Each range merges its slices of the runs with a loser
tree, in passes of at most FAN_IN slices: a pass makes one longer run of each FAN_IN, until one is
left. The result holds the capture histories in global order, over its partitions.

Memory: a task holds the archive it writes or reads, record by record, or the index entries of
one range (payloads are in neither index nor merge).

Defined results: a null payload is empty, a null URL has an empty key and comes first, a null id
is smaller than all others and is never referred to unless all equal payloads have it. Of
repeated rows one is the response. A null timestamp is the epoch. Other columns are not read.
An empty table gives no archives and an empty history.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise
from typing import Any
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoweave.llm.common import saved

ARCHIVE_BYTES = 8 << 20
MIN_REVISIT_BYTES = 0
EPOCH = "1970-01-01T00:00:00Z"
#: Captures of one range of the merge, and runs that one loser tree merges.
RANGE_ENTRIES = 100_000
FAN_IN = 64
_CHUNK = 1 << 16

_HOST = re.compile(r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?", re.S)


def url_key(url: str | None) -> str:
    """Host labels in reverse order, then the rest: captures of a site stand together."""
    if not url:
        return ""
    m = _HOST.match(url)
    if not m:
        return url
    host = m[1].lower().removeprefix("www.").split(".")
    return f"{','.join(reversed(host))}{m[2] or ''}){url[m.end() :].split('#')[0] or '/'}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


class LoserTree:
    """K-way merge of sorted iterators: inner nodes keep the loser of their match, the root the winner."""

    def __init__(self, runs: list[Iterator[Any]], key: Callable[[Any], Any]):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.keys = [key(h) if h is not None else None for h in self.heads]
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._build(i)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a wins against run b; ended runs lose, ties go to the earlier run."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None or self.keys[b] is None and a < b
        return (self.keys[a], a) < (self.keys[b], b)

    def _build(self, leaf: int) -> None:
        """Send a new leaf up; it waits at the first node that has no loser yet."""
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = winner
                return
            if self._before(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[Any]:
        if not self.k:
            return
        while self.keys[winner := self.losers[0]] is not None:
            yield self.heads[winner]
            head = next(self.runs[winner], None)
            self.heads[winner], self.keys[winner] = head, self.key(head) if head is not None else None
            node = (winner + self.k) // 2
            while node > 0:
                if self._before(self.losers[node], winner):
                    self.losers[node], winner = winner, self.losers[node]
                node //= 2
            self.losers[0] = winner


# ---------------------------------------------------------------- writing


def captures(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None) -> DataFrame:
    """id, url, time, payload, digest."""
    time = F.coalesce(F.col(time_col).cast("string"), F.lit(EPOCH)) if time_col else F.lit(EPOCH)
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), time.alias("time"), payload.alias("payload"))
    return rows.withColumn("sha1", F.sha1("payload"))


def decisions(rows: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """rows of captures(). For ids whose payload others have too: other_id, other_sha1, other_size, refers_to, times (rows with the id and payload).

    Only ids, digests and sizes are grouped and joined; payloads stay where they are.
    """
    light = rows.select("id", "sha1", F.octet_length("payload").cast("long").alias("size")).where(F.col("size") >= min_bytes)
    shared = light.groupBy("sha1", "size").agg(F.max("id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    found = light.join(shared, ["sha1", "size"]).groupBy("id", "sha1", "size", "refers_to").agg(F.count("*").alias("times"))
    return saved(found.select(F.col("id").alias("other_id"), F.col("sha1").alias("other_sha1"), F.col("size").alias("other_size"), "refers_to", "times"), "decisions")


def decided(rows: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """captures() with size, response (boolean) and refers_to."""
    known = decisions(rows, min_bytes)
    # `known` is a table whose size Spark knows: it is broadcast if small, else the payloads are dealt by their digest once.
    same = F.col("id").eqNullSafe(F.col("other_id")) & (F.col("sha1") == F.col("other_sha1")) & (F.col("size") == F.col("other_size"))
    marked = rows.withColumn("size", F.octet_length("payload").cast("long")).join(known, same, "left")
    largest = F.col("times").isNull() | F.col("id").eqNullSafe(F.col("refers_to"))
    out = ["id", "url", "time", "payload", "sha1", "size", "response", "refers_to"]
    tie = F.coalesce(F.col("times") > 1, F.lit(False)) & largest
    if known.where(F.col("other_id").eqNullSafe(F.col("refers_to")) & (F.col("times") > 1)).isEmpty():
        return marked.withColumn("response", largest).select(*out)
    # Of repeated rows that hold the largest id, the first by URL and time is the response.
    first = F.row_number().over(W.partitionBy("sha1", "size", "id").orderBy("url", "time")) == 1
    return marked.where(~tie).withColumn("response", largest).select(*out).unionByName(marked.where(tie).withColumn("response", first).select(*out))


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + b"\r\n" + block + b"\r\n\r\n"


def _safe(value: str) -> str:
    """A header value: line ends and percent signs as escapes."""
    return re.sub(r"[%\r\n]", lambda m: f"%{ord(m.group()):02X}", value)


def _unsafe(value: str) -> str:
    return re.sub(r"%(25|0D|0A)", lambda m: chr(int(m[1], 16)), value)


def capture_record(row: dict[str, Any]) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    headers = [
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row["id"]} {row["url"]} {row["time"]} {digest}')}>"),
        ("WARC-Date", _safe(row["time"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(row["size"])),
    ]
    headers += [("WARC-Target-URI", _safe(row["url"]))] if row["url"] is not None else []
    headers += [("X-Capture-ID", str(row["id"]))] if row["id"] is not None else []
    if row["response"]:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + row["payload"]
        return warc_record("response", [*headers, ("Content-Type", "application/http; msgtype=response")], block)
    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    headers += [("WARC-Refers-To", str(row["refers_to"]))] if row["refers_to"] is not None else []
    return warc_record("revisit", headers, b"")


def write_archives(rows: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """rows of decided(). Archives (archive, content): gzip members, one record each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, parts, size = TaskContext.get().partitionId(), 0, [], 0
        pack = lambda: pa.RecordBatch.from_pylist([{"archive": f"part-{task:06d}-{number:06d}.warc.gz", "content": b"".join(parts)}], schema=pa.schema([("archive", pa.string()), ("content", pa.binary())]))
        for b in batches:
            for row in b.to_pylist():
                member = gzip.compress(capture_record(row), 1, mtime=0)
                if parts and size + len(member) > archive_bytes:
                    yield pack()
                    number, parts, size = number + 1, [], 0
                parts.append(member)
                size += len(member)
        if parts:
            yield pack()

    return rows.mapInArrow(run, "archive string, content binary")


# ---------------------------------------------------------------- reading


def read_records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers in lower case, block) of each gzip member of an archive. The archive is read once, in chunks."""
    view, at = memoryview(content), 0
    while at < len(view):
        unpack, parts, end = zlib.decompressobj(31), [], at
        while not unpack.eof and end < len(view):
            chunk = view[end : end + _CHUNK]
            parts.append(unpack.decompress(chunk))
            end += len(chunk)
        used = end - at - len(unpack.unused_data)
        record = io.BytesIO(b"".join(parts))
        if not record.readline().startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = {}
        while (line := record.readline().rstrip(b"\r\n")) != b"":
            k, _, v = line.decode().partition(": ")
            headers[k.lower()] = _unsafe(v)
        yield at, used, headers, record.read(int(headers["content-length"]))
        at += used


def index_entries(archives: DataFrame) -> DataFrame:
    """One row a capture, in runs (one an archive) that are sorted by urlkey, time and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("archive"), b.column("content"), strict=True):
                rows = []
                for at, used, h, block in read_records(content.as_py()):
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    response = h["warc-type"] == "response"
                    if response and payload_digest(payload) != digest:
                        raise ValueError(f"wrong digest in {name} at {at}")
                    url = h.get("warc-target-uri")
                    number = lambda k: int(h[k]) if k in h else None  # noqa: E731, B023
                    rows.append({"urlkey": url_key(url), "time": h["warc-date"], "id": number("x-capture-id"), "url": url, "record_type": h["warc-type"], "payload_bytes": len(payload) if response else number("x-payload-length"), "payload_digest": digest, "refers_to": number("warc-refers-to"), "archive": name.as_py(), "offset": at, "length": used})
                rows.sort(key=entry_key)
                yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY)

    return archives.mapInArrow(run, ENTRY)


ENTRY = "urlkey string, time string, id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, offset long, length long"
_ENTRY = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (x.split() for x in ENTRY.split(", "))])


def entry_key(e: dict[str, Any]) -> tuple:
    return _key(e["urlkey"], e["time"], e["id"], e["archive"], e["offset"])


def _key(urlkey: str, time: str, number: int | None, archive: str, offset: int) -> tuple:
    return urlkey.encode(), time.encode(), number is not None, number or 0, archive, offset


def merged(slices: list[list[tuple]]) -> Iterator[tuple]:
    """Sorted slices as one sorted sequence, in passes of loser trees of at most FAN_IN slices."""
    while len(slices) > FAN_IN:
        slices = [list(LoserTree([iter(x) for x in slices[i : i + FAN_IN]], lambda e: e)) for i in range(0, len(slices), FAN_IN)]
    return iter(LoserTree([iter(x) for x in slices], lambda e: e))


def merge_runs(runs: DataFrame) -> DataFrame:
    """runs: a table of index_entries(). The captures in global order."""
    sort = ["urlkey", "time", F.col("id").asc_nulls_first(), "archive", "offset"]
    ranges = -(-runs.count() // RANGE_ENTRIES)
    # Ranges are dealt by the key; the rows of a run stay in order, so that a range holds a sorted slice of each run.
    dealt = runs.repartitionByRange(max(1, ranges), *sort)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        slices: dict[str, list[tuple]] = {}
        columns = (table.column(c).to_pylist() for c in ("urlkey", "time", "id", "archive", "offset"))
        for i, (urlkey, time, number, archive, offset) in enumerate(zip(*columns, strict=True)):
            slices.setdefault(archive, []).append((_key(urlkey, time, number, archive, offset), i))
        for s in slices.values():
            if any(a > b for a, b in pairwise(s)):  # only if the slice came in several parts
                s.sort()
        order = pa.array([i for _, i in merged([slices[a] for a in sorted(slices)])], pa.int64())
        yield from table.take(order).to_batches(4096)

    return dealt.mapInArrow(run, ENTRY)


def archive_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the archives of a table of pages; the table (archive, content) of what was written."""
    rows = decided(captures(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, time_col=time_col), min_revisit_bytes)
    return saved(write_archives(rows), "archives")


def capture_histories(archives: DataFrame) -> DataFrame:
    return merge_runs(saved(index_entries(archives), "index-runs"))


def warc_report(histories: DataFrame, id_name: str = "page_id") -> DataFrame:
    refers: Column = F.when(F.col("record_type") == "revisit", F.col("refers_to"))
    return histories.select(F.col("id").alias(id_name), "payload_bytes", "payload_digest", "record_type", refers.alias("refers_to"))


REPORT_SQL = """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(('0b' || substr(bits, 5 * i + 1, 5)) AS INTEGER), 1), '' ORDER BY i) FROM range(32) t(i)) AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS largest,
    (SELECT string_agg(bin(CAST(('0x' || substr(hex, j + 1, 1)) AS INTEGER) + 16)[2:5], '' ORDER BY j) FROM range(40) u(j)) AS bits
  FROM (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages)
)
"""
