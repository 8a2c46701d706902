"""Web archives: writing, reading back, and one capture index in global order.

Every page becomes one record of a WARC/1.1 file, each record its own gzip member. Pages
with equal payloads are told by SHA-1; of those that are long enough the one with the
largest id is a full response and the others are revisits that point to it and keep only its
HTTP header. Reading an archive gives one capture per record with the place of the record;
captures of an archive are sorted by URL key and time into a run. The runs are merged:
splitters from all runs cut the keys into ranges, every range opens its slice of each run
through the run's sparse index and merges the slices with a loser tree, so the ranges
together are the capture history of all archives in order.

A null html is an empty payload; null urls and ids are kept as empty fields and come first;
repeated rows are records of their own; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, open_file, partitions_for, write_whole
from tidewatch.session import work_dir

EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
SPARSE = 256  # captures of a run between two entries of its index
READ = 1 << 20
READ_RUN = 1 << 16  # a merge holds this much of every run
CAPTURE = "key string, time string, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, file string, offset long, length long"
FIELDS = [f.split()[0] for f in CAPTURE.split(", ")]


def url_key(url: str | None) -> str:
    """Host labels from the top down, then path and query, lower-cased, without scheme and port."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    labels = [x for x in host.split(".") if x]
    if labels[:1] == ["www"]:
        labels = labels[1:]
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{','.join(reversed(labels))}){(parts.path or '/')}{'?' + query if query else ''}".lower()


def capture_time(page_id: int | None) -> str:
    """Captures follow each other by a second in the order of page ids."""
    moment = EPOCH + timedelta(seconds=(page_id or 0) % (1 << 32))
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {capture_time(page_id)}",
        f"WARC-Target-URI: {re.sub(r'[\r\n]', ' ', url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            f"WARC-Refers-To-Date: {capture_time(refers_to)}",
        ]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode("utf-8", "replace")
    return gzip.compress(head + block + b"\r\n\r\n", 4, mtime=0)


def members(file) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of a file, one at a time."""
    start, rest = 0, b""
    while True:
        engine, parts, used = zlib.decompressobj(31), [], 0
        while not engine.eof:
            rest = rest or file.read(READ)
            if not rest:
                return
            used += len(rest)
            parts.append(engine.decompress(rest))
            rest = engine.unused_data
        used -= len(rest)
        yield start, used, b"".join(parts)
        start += used


def parse(content: bytes) -> dict:
    head, _, block = content[:-4].partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda value: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", value or "")) else None
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind, digest = named["WARC-Type"], named["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        length, digest = len(payload), sha1(payload)
    return {
        "page_id": number(named["WARC-Record-ID"]),
        "url": named["WARC-Target-URI"],
        "time": named["WARC-Date"],
        "record_type": kind,
        "payload_digest": digest,
        "payload_bytes": length,
        "refers_to": number(named.get("WARC-Refers-To")),
    }


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(pages: DataFrame, least: int = 0, uri: str | None = None) -> tuple[DataFrame, str]:
    """Write ``pages`` (page_id, url, html); returns (file, records) of the archives and their folder."""
    spark = pages.sparkSession
    uri = uri or work_dir(spark, "warc")
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    shaped = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html")).select(
        "*", F.sha1("html").alias("digest")
    )
    # Only digests that occur twice; the sums are combined before they are shuffled.
    again = (
        shaped.where(F.length("html") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    linked = shaped.join(again, "digest", "left").select("page_id", "url", "html", "first")

    def write(batches):
        name, done = f"pages-{TaskContext.get().partitionId():06d}.warc.gz", {"records": 0, "answered": set()}

        def chunks():
            for batch in batches:
                for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns)):
                    # A repeated row of the response itself is one more response.
                    revisit = first is not None and page_id != first
                    done["records"] += 1
                    yield record(page_id, url, payload, sha1(payload), first, revisit)

        stream = chunks()
        head = next(stream, None)
        if head is not None:
            write_whole(uri, name, (c for part in ([head], stream) for c in part))
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [done["records"]]})

    return kept(linked.mapInArrow(write, "file string, records long"), "archives"), uri


def sort_runs(archives: DataFrame, uri: str) -> DataFrame:
    """Read every archive and write its captures as a sorted run; (run, sparse keys) of the runs.

    A run is a file of JSON lines; its index has the key and byte offset of every 256th line.
    """

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                captures = []
                with open_file(uri, name) as file:
                    for offset, length, content in members(file):
                        got = parse(content)
                        got |= {"key": url_key(got["url"]), "file": name, "offset": offset, "length": length}
                        captures.append([got[f] for f in FIELDS])
                captures.sort(key=order)
                lines = [json.dumps(c).encode() + b"\n" for c in captures]
                ends = [0]
                for line in lines:
                    ends.append(ends[-1] + len(line))
                run = f"{name}.run"
                write_whole(uri, run, lines)
                yield pa.RecordBatch.from_pydict(
                    {
                        "run": [run],
                        "keys": [[c[0] for c in captures[::SPARSE]]],
                        "times": [[c[1] for c in captures[::SPARSE]]],
                        "offsets": [ends[:-1:SPARSE]],
                        "size": [ends[-1]],
                    }
                )

    dealt = archives.select("file").repartition(partitions_for(archives.sparkSession), "file")
    return kept(
        dealt.mapInArrow(read, "run string, keys array<string>, times array<string>, offsets array<long>, size long"), "runs"
    )


def order(capture: list) -> tuple:
    return capture[0], capture[1], -1 if capture[2] is None else capture[2], capture[8], capture[9]


def lines_between(uri: str, run: str, start: int, low, high) -> Iterator[list]:
    """Captures of a run with low <= (key, time) < high, from a byte offset at or before the first."""
    with open_file(uri, run) as file:
        file.seek(start)
        rest = b""
        while True:
            raw = file.read(READ_RUN)
            *whole, rest = (rest + raw).split(b"\n")
            for line in whole:
                capture = json.loads(line)
                at = (capture[0], capture[1])
                if high is not None and at >= high:
                    return
                if low is None or at >= low:
                    yield capture
            if not raw:
                return


class LoserTree:
    """Merge of k sorted streams; one comparison per level for each item taken."""

    def __init__(self, streams: list[Iterator[list]]):
        self.streams = streams
        self.k = len(streams)
        self.heads = [next(s, None) for s in streams]
        self.keys = [None if h is None else (*order(h), i) for i, h in enumerate(self.heads)]
        self.losers = [0] * max(1, self.k)
        self.winner = self._build(1) if self.k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        return self.keys[b] is None or (self.keys[a] is not None and self.keys[a] <= self.keys[b])

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        left, right = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (left, right) if self._beats(left, right) else (right, left)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator[list]:
        while self.k and self.keys[self.winner] is not None:
            i = self.winner
            yield self.heads[i]
            self.heads[i] = head = next(self.streams[i], None)
            self.keys[i] = None if head is None else (*order(head), i)
            node = (i + self.k) // 2
            while node:
                if self._beats(self.losers[node], i):
                    i, self.losers[node] = self.losers[node], i
                node //= 2
            self.winner = i


def merge_runs(runs: DataFrame, uri: str, ranges: int | None = None) -> DataFrame:
    """All captures, in global order of (part, position)."""
    spark = runs.sparkSession
    ranges = ranges or partitions_for(spark)
    # Every run has one entry per 256 captures; a quantile sketch over them gives the splitters.
    entries = runs.select(F.explode(F.arrays_zip("keys", "times")).alias("e")).select("e.keys", "e.times")
    sketch = (
        entries.repartitionByRange(ranges, "keys", "times")
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min(F.struct("keys", "times")).alias("low"))
        .select("low.keys", "low.times")
    )
    cuts = sorted((r[0], r[1]) for r in sketch.collect())  # at most `ranges` rows
    bounds = [None, *cuts[1:], None]

    def clip(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                marks = list(zip(r["keys"], r["times"]))
                for part, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    if marks and not (high and marks[0] >= high):
                        at = max(0, bisect_left(marks, low) - 1) if low else 0
                        rows.append((part, r["run"], r["offsets"][at]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64()))],
                names=["part", "run", "start"],
            )

    located = runs.mapInArrow(clip, "part int, run string, start long")
    work = located.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("run", "start"))).alias("runs"))
    types = [pa.string()] * 2 + [pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.int64()] * 2 + [pa.string()] + [pa.int64()] * 2

    def merge(batches):
        for batch in batches:
            for row in batch.to_pylist():
                low, high = bounds[row["part"]], bounds[row["part"] + 1]
                tree = LoserTree([lines_between(uri, r["run"], r["start"], low, high) for r in row["runs"]])
                block, position = [], 0

                def emit():
                    columns = [pa.array([c[i] for c in block], t) for i, t in enumerate(types)]
                    places = [
                        pa.array([row["part"]] * len(block), pa.int32()),
                        pa.array(range(position - len(block), position), pa.int64()),
                    ]
                    return pa.RecordBatch.from_arrays(columns + places, names=[*FIELDS, "part", "position"])

                for capture in tree:
                    block.append(capture)
                    position += 1
                    if len(block) == 4096:
                        yield emit()
                        block.clear()
                if block:
                    yield emit()

    return work.repartition(ranges, "part").mapInArrow(merge, f"{CAPTURE}, part int, position long")


def capture_history(pages: DataFrame, least: int = 0) -> DataFrame:
    archives, uri = write_archives(pages, least)
    return merge_runs(sort_runs(archives, uri), uri)
