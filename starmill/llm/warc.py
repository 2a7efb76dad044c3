"""WARC archives with revisit records, and their capture index by an external merge.

Each task writes its pages to archives of bounded size and the captures of each archive, sorted by URL key, time and
page, as one run.  Spark deals the runs into ranges of that order; within a range the k runs meet in a loser tree.  The
ranges one after the other are the capture histories of all URLs.  Names of archives are unique to a task attempt and
only the runs of tasks that ended are read, so what a lost attempt wrote is never seen.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from typing import Any
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.sources import scratch_root

from .common import stored, text_slices

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Captures that one merge of runs holds, on average.
RANGE = 100_000
RUN = "urlkey string, captured string, page_id long, run string, place long, offset long, length long"
_RUN_ARROW = pa.schema(
    [("urlkey", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("run", pa.string())]
    + [(c, pa.int64()) for c in ("place", "offset", "length")]
)


def url_key(url: str | None) -> str:
    """The host's labels reversed, then path and query, in lower case; ``-`` without a URL."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url.lower()
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}{port}){path}".lower()


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _record(page: dict, date: str) -> bytes:
    payload = (page["html"] or "").encode()
    name = page["page_id"] if page["page_id"] is not None else f"none-{uuid.uuid4().hex}"
    revisit = page["refers_to"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{name}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(page['url'] or '', safe=':/?#[]@!$&()*+,;=%~-._')}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:x-page:{page['refers_to']}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzipped(data: bytes, level: int) -> bytes:
    member = zlib.compressobj(level, zlib.DEFLATED, 31)
    return member.compress(data) + member.flush()


def parse_record(data: bytes) -> dict[str, Any]:
    """The fields of one record; the digest of a response is checked against its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page = fields["WARC-Record-ID"][len("<urn:x-page:") : -1]
    other = fields.get("WARC-Refers-To")
    return {
        "page_id": None if page.startswith("none-") else int(page),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(other[len("<urn:x-page:") : -1]) if other else None,
    }


class LoserTree:
    """Merge sorted runs: each inner node keeps the run that lost there, so the next winner costs one walk to the root."""

    def __init__(self, runs: Sequence[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        self.size = max(1, len(runs))
        self.losers = [-1] * self.size
        self.winner = self._play(1) if runs else -1

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        first, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return first

    def __iter__(self) -> Iterator[tuple[int, tuple]]:
        """(run, head) in order."""
        while self.winner >= 0 and self.heads[self.winner] is not None:
            now = self.winner
            yield now, self.heads[now]
            self.heads[now] = next(self.runs[now], None)
            node = (now + self.size) // 2
            while node:
                if self._beats(self.losers[node], now):
                    now, self.losers[node] = self.losers[node], now
                node //= 2
            self.winner = now


def _written(folder: str, date: str, file_bytes: int, level: int):
    captured = re.sub(r"\D", "", date)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, name, captures, at = None, "", [], 0

        def run() -> pa.RecordBatch:
            out.close()
            rows = sorted(captures, key=lambda c: (c["urlkey"], c["captured"], _first(c["page_id"]), c["offset"]))
            return pa.RecordBatch.from_pylist([r | {"run": name, "place": i} for i, r in enumerate(rows)], _RUN_ARROW)

        for part in text_slices(batches, "html"):
            for page in part.to_pylist():
                if out is None:
                    store.create_dir(root, recursive=True)
                    name, captures, at = f"{uuid.uuid4().hex}.warc.gz", [], 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                data = _gzipped(_record(page, date), level)
                out.write(data)
                captures.append(
                    {"urlkey": url_key(page["url"]), "captured": captured, "page_id": page["page_id"]}
                    | {"offset": at, "length": len(data)}
                )
                at += len(data)
                if at >= file_bytes:
                    yield run()
                    out = None
        if out is not None:
            yield run()

    return write


def _first(page_id: int | None) -> tuple[bool, int]:
    return page_id is not None, page_id or 0


def write_archives(
    pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = 64 << 20, level: int = 1
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the sorted runs of captures.

    Of the rows with equal payloads the one with the largest page_id is a response and the others revisit it; rows that
    share that page_id are responses too.  A null html is an empty payload, equal to an empty one.  Rows without page_id
    revisit a row that has one, else they are responses.  Rows without url are captures of the key ``-``.  Only payloads
    that occur more than once are looked up.  Other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", F.sha1(F.coalesce("html", F.lit(""))).alias("sha1"))
    first = stored(
        rows.groupBy("sha1").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    marked = rows.join(first, "sha1", "left").select("page_id", "url", "html", refers.alias("refers_to"))
    return stored(marked.mapInArrow(_written(folder, date, file_bytes, level), RUN))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if not held:
        return
    rows = pa.Table.from_batches(held).sort_by([("run", "ascending"), ("place", "ascending")]).combine_chunks()
    columns = (rows[c].to_pylist() for c in ("urlkey", "captured", "page_id"))
    keys = [(urlkey, captured, _first(page)) for urlkey, captured, page in zip(*columns, strict=True)]
    changed = pc.not_equal(rows["run"].slice(1), rows["run"].slice(0, len(rows) - 1)).to_pylist()
    starts = [0, *(i + 1 for i, c in enumerate(changed) if c)]
    ends = [*starts[1:], len(rows)]
    runs = [((key, at) for at, key in enumerate(keys[a:b], a)) for a, b in zip(starts, ends, strict=True)]
    order = pa.array([at for _, (_, at) in LoserTree(runs)], pa.int64())
    yield from rows.take(order).combine_chunks().to_batches(max_chunksize=8192)


def capture_histories(runs: DataFrame) -> DataFrame:
    """All captures in the order of URL key, time and page, range after range, merged from the runs of the archives."""
    ranges = max(1, runs.count() // RANGE, runs.sparkSession.sparkContext.defaultParallelism)
    dealt = runs.repartitionByRange(ranges, "urlkey", "captured", F.col("page_id").asc_nulls_first(), "run", "place")
    return dealt.mapInArrow(_merged, RUN)


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, archive = None, None
        for batch in batches:
            found: list[tuple[int, dict]] = []
            places = batch.select(["run", "offset", "length"]).to_pylist()
            # Each archive is walked forwards; the captures are put back into their order afterwards.
            for at in sorted(range(len(places)), key=lambda i: (places[i]["run"], places[i]["offset"])):
                place = places[at]
                if place["run"] != name:
                    if archive:
                        archive.close()
                    name, archive = place["run"], store.open_input_file(f"{root}/{place['run']}")
                archive.seek(place["offset"])
                data = zlib.decompress(archive.read(place["length"]), 31)
                found.append((at, parse_record(data) | {"urlkey": batch.column("urlkey")[at].as_py()}))
            yield pa.RecordBatch.from_pylist([row for _, row in sorted(found, key=lambda f: f[0])], _READ_ARROW)

    return read


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, urlkey string"
_READ_ARROW = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("record_type", pa.string()), ("refers_to", pa.int64()), ("urlkey", pa.string())]
)


def read_captures(histories: DataFrame, folder: str) -> DataFrame:
    """The records of captures, read from the archives at their offsets, in the order of the histories."""
    return histories.mapInArrow(_read(folder), READ)


def archived(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder, merge their index and read every capture back."""
    folder = scratch_root(pages.sparkSession)
    return read_captures(capture_histories(write_archives(pages, folder)), folder)
