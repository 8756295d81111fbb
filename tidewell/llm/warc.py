"""WARC archives with an externally merged capture index.

Pages are dealt to tasks. Each task sorts its captures by URL key and time and writes them as gzip members of a WARC file.
The files are then read back, one record at a time, and checked; each gives a sorted run of index entries, in blocks of
BLOCK_ROWS, and a row for each block with its first and last key. Runs are merged FAN_IN at a time: keys are cut into ranges
of a bounded number of entries, a task reads of each run the blocks that touch its range, one block a run at a time, and a
loser tree merges them. While more than FAN_IN runs are left, the merged ranges are written as blocks of longer runs. The
ranges of the last merge in order are the capture histories of all keys.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import math
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.arrow import pieces
from tidewell.llm.common import col_or_null, partitions, prefix_sum, shared_path, written
from tidewell.llm.storage import create, open_input

#: Payloads of at least as many bytes are stored once; other records of the same payload revisit it.
LEAST_SHARED = 100
#: A run goes on in a new file beyond this size.
FILE_BYTES = 1 << 30
#: Bytes read from a WARC file at once.
READ_BYTES = 1 << 20
LEVEL = 1
#: Copies of a hot payload are spread over as many tasks.
SALTS = 8
#: Entries of a block, entries of a range that one task merges, about, and runs that are merged at once, about.
BLOCK_ROWS, RANGE_ROWS, FAN_IN = 256, 1 << 17, 64
#: Time of capture of page 0, for pages without a time of their own: page n follows n seconds later, within a year.
EPOCH, YEAR = 1704067200, 31536000

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, urlkey string, captured long, url string, file string, offset long"
_KINDS = {"long": pa.int64(), "string": pa.string()}
_ENTRY = pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in RESULT.split(", "))])


def url_key(url: Column) -> Column:
    """Host labels from right to left, then path and query: scheme, user, www, port and fragment are dropped. Null: empty."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"^www[0-9]*\.", "")
    path = F.regexp_extract(bare, r"^[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", F.lit("/")).otherwise(path))


def _head(pairs: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in pairs).encode() + b"\r\n"


def _one_line(url: str | None) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")


def _time(captured: int) -> str:
    return datetime.fromtimestamp(captured, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page: int | None, key: str, url: str | None, captured: int, payload: bytes, digest: str, refers_to: tuple[int, str | None, int] | None) -> bytes:
    """A response or, with refers_to (page, URL and time of the response), a revisit record, which leaves out the payload.

    Record ids are new for each record. The page's id, its URL key and the page referred to stand in headers of our own.
    """
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    pairs = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", _time(captured)), ("WARC-Target-URI", _one_line(url)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("X-Page-ID", json.dumps(page)), ("X-URL-Key", json.dumps(key))]
    if refers_to is None:
        block += payload
    else:
        first, first_url, first_time = refers_to
        pairs += [("WARC-Profile", REVISIT), ("WARC-Refers-To-Target-URI", _one_line(first_url)), ("WARC-Refers-To-Date", _time(first_time)), ("X-Refers-To-Page-ID", json.dumps(first))]
    return _head([*pairs, ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict[str, Any]:
    """Headers of a record, its HTTP head's length of payload, and its payload (a revisit's is empty)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block, http, payload = rest[: int(fields["Content-Length"])], b"", b""
    if fields["WARC-Type"] != "warcinfo":
        http, _, payload = block.partition(b"\r\n\r\n")
    stated = [int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return fields | {"payload": payload, "payload_bytes": stated[0] if stated else len(payload)}


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _write_files(folder: str):
    """Sorted captures to WARC files; the name of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, names = None, 0, []
        for batch in batches:
            for piece in pieces(batch, 4):
                for key, captured, page, url, payload, digest, refers in zip(*(c.to_pylist() for c in piece.columns)):
                    if out is None or at > FILE_BYTES:
                        if out:
                            out.close()
                        names.append(f"{folder}/run-{uuid.uuid4().hex}.warc.gz")
                        out = create(names[-1])
                        info = b"software: tidewell\r\nformat: WARC File Format 1.1\r\n"
                        at = out.write(_member(_head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", _time(EPOCH)), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))]) + info + b"\r\n\r\n"))
                    raw = _member(record(page, key, url, captured, payload.encode(), digest, refers and (refers["page"], refers["url"], refers["captured"])))
                    out.write(raw)
                    at += len(raw)
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["file"])

    return run


def records(name: str) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each member of a WARC file; one is held at a time."""
    with open_input(name) as file:
        unpacker, parts, start, at = zlib.decompressobj(31), [], 0, 0
        while data := file.read(READ_BYTES):
            while data:
                parts.append(unpacker.decompress(data))
                rest = unpacker.unused_data
                at += len(data) - len(rest)
                if unpacker.eof:
                    yield start, b"".join(parts)
                    unpacker, parts, start = zlib.decompressobj(31), [], at
                data = rest
        if at != start:
            raise ValueError(f"{name}: its last record is cut off")


def _entries(name: str) -> Iterator[tuple]:
    """The index entries of a WARC file's records, which are checked."""
    for offset, raw in records(name):
        got = parse(raw)
        if got["WARC-Type"] == "warcinfo":
            continue
        digest = got["WARC-Payload-Digest"].removeprefix("sha256:")
        if got["WARC-Type"] == "response" and (hashlib.sha256(got["payload"]).hexdigest() != digest or len(got["payload"]) != got["payload_bytes"]):
            raise ValueError(f"{name} at {offset}: the payload doesn't have its digest")
        captured = int(datetime.strptime(got["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC).timestamp())
        yield json.loads(got["X-Page-ID"]), got["payload_bytes"], digest, got["WARC-Type"], json.loads(got.get("X-Refers-To-Page-ID", "null")), json.loads(got["X-URL-Key"]), captured, got["WARC-Target-URI"], name, offset


# --- index runs: blocks of entries in order of their keys

_PLACE = "struct<urlkey: string, captured: long, has: int, page: long, file: string, offset: long>"
_PLACE_ARROW = pa.struct([("urlkey", pa.string()), ("captured", pa.int64()), ("has", pa.int32()), ("page", pa.int64()), ("file", pa.string()), ("offset", pa.int64())])
BLOCKS = f"run string, file string, offset long, length long, rows long, first {_PLACE}, last {_PLACE}"


def _key(entry: tuple) -> tuple:
    """Entries' order: URL key, time, page (null first), place in the archive."""
    return entry[5].encode(), entry[6], entry[0] is not None, entry[0] or 0, entry[8], entry[9]


def _place(entry: tuple) -> dict:
    return {"urlkey": entry[5], "captured": entry[6], "has": int(entry[0] is not None), "page": entry[0] or 0, "file": entry[8], "offset": entry[9]}


def _key_of(place: Any) -> tuple:
    return place["urlkey"].encode(), place["captured"], bool(place["has"]), place["page"], place["file"], place["offset"]


def _write_blocks(entries: Iterable[tuple], folder: str, run: str) -> Iterator[pa.RecordBatch]:
    """Sorted entries to blocks in a file of their own; rows of BLOCKS."""
    out, name, at, held, rows = None, f"{folder}/index-{uuid.uuid4().hex}", 0, [], []

    def flush() -> None:
        nonlocal out, at
        if held:
            out = out or create(name)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _ENTRY, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_batch(pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), _ENTRY)], schema=_ENTRY))
            raw = sink.getvalue()
            out.write(raw)
            rows.append((run, name, at, len(raw), len(held), _place(held[0]), _place(held[-1])))
            at += len(raw)
            held.clear()

    def done() -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), _PLACE_ARROW, _PLACE_ARROW)
        found = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["run", "file", "offset", "length", "rows", "first", "last"])
        rows.clear()
        return found

    for entry in entries:
        held.append(entry)
        if len(held) == BLOCK_ROWS:
            flush()
            if len(rows) == 1024:
                yield done()
    flush()
    if out:
        out.close()
    if rows:
        yield done()


def _index(folder: str):
    """Names of WARC files to the blocks of their index runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from _write_blocks(_entries(name), folder, name)

    return run


class _Files:
    """Open files, the last used ones."""

    def __init__(self) -> None:
        self.open: dict[str, Any] = {}

    def read(self, name: str, offset: int, length: int) -> bytes:
        file = self.open.pop(name, None) or open_input(name)
        self.open[name] = file
        if len(self.open) > 2 * FAN_IN:
            self.open.pop(next(iter(self.open))).close()
        file.seek(offset)
        return file.read(length)

    def close(self) -> None:
        for file in self.open.values():
            file.close()
        self.open.clear()


def _stretch(files: _Files, blocks: list[tuple[str, int, int]], low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """The entries of a run's blocks from low on and below high; one block is held at a time."""
    for block in blocks:
        with pa.ipc.open_stream(files.read(*block)) as stream:
            entries = list(zip(*(c.to_pylist() for c in stream.read_all().columns)))
        for entry in entries:
            key = _key(entry)
            if high is not None and key >= high:
                return
            if low is None or key >= low:
                yield entry


class LoserTree:
    """Merges sorted sequences as they are read: each inner node holds the loser of its match, the top the smallest head."""

    def __init__(self, runs: list[Iterable], key) -> None:
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _next(self, i: int) -> tuple:
        """A run's head as (ended, key, run, entry)."""
        for entry in self.runs[i]:
            return False, self.key(entry), i, entry
        return True, None, i, None

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y[0] and (not x[0] or a < b) if x[0] or y[0] else (x[1], a) < (y[1], b)

    def _play(self, winner: int) -> None:
        """A run's new head goes up; where an entry is missing, in the building, it waits."""
        node = (winner + self.k) // 2
        while node > 0:
            if self.tree[node] < 0:
                self.tree[node] = winner
                return
            if self._less(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while self.k and not self.heads[top := self.tree[0]][0]:
            yield self.heads[top][3]
            self.heads[top] = self._next(top)
            self._play(top)


def _merge(bounds: dict[int, list[tuple]], folder: str | None):
    """Blocks sorted by group, range, run and key, to the entries of each range in order: rows, or blocks in folder."""

    def merged(files: _Files, group: int, part: int, runs: dict[str, list]) -> Iterator[tuple]:
        edges = bounds.get(group, [])
        low, high = edges[part - 1] if part else None, edges[part] if part < len(edges) else None
        return iter(LoserTree([_stretch(files, blocks, low, high) for blocks in runs.values()], _key))

    def out(files: _Files, group: int, part: int, runs: dict[str, list]) -> Iterator[pa.RecordBatch]:
        entries = merged(files, group, part, runs)
        if folder is not None:
            yield from _write_blocks(entries, folder, f"merged-{group}")
            return
        rows: list[tuple] = []
        for entry in entries:
            rows.append(entry)
            if len(rows) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _ENTRY)], schema=_ENTRY)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _ENTRY)], schema=_ENTRY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at, runs = _Files(), None, {}
        for batch in batches:
            for group, part, name, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if at not in (None, (group, part)):
                    yield from out(files, *at, runs)
                    runs = {}
                at = (group, part)
                runs.setdefault(name, []).append((file, offset, length))
        if at:
            yield from out(files, *at, runs)
        files.close()

    return run


def _touched(bounds: dict[int, list[tuple]]):
    """For each block, a row for each range of its group that it touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, part = [], []
            for k, (group, first, last) in enumerate(zip(batch.column(0).to_pylist(), batch.column(5).to_pylist(), batch.column(6).to_pylist())):
                edges = bounds.get(group, [])
                own = range(bisect.bisect_right(edges, _key_of(first)), bisect.bisect_right(edges, _key_of(last)) + 1)
                place += [k] * len(own)
                part += own
            rows = batch.take(pa.array(place, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(part, pa.int64()), *rows.columns[1:6]], ["group", "range", "run", "file", "offset", "length", "first"])

    return run


def _merge_once(blocks: DataFrame, runs: int, folder: str | None) -> DataFrame:
    """Blocks of runs to blocks of FAN_IN times fewer ones or, without a folder, to the entries of all in order.

    The first keys of ranges, one for each RANGE_ROWS entries, go to the driver and all tasks.
    """
    groups = math.ceil(runs / FAN_IN) if folder else 1
    placed = blocks.withColumn("group", F.pmod(F.xxhash64("run"), F.lit(groups)))
    placed = prefix_sum(placed, [F.col("group"), F.col("first")], "rows", "before", "warc-blocks")
    total = placed.agg(F.sum("rows")).head()[0] or 0
    size = max(1, min(RANGE_ROWS, total // partitions(blocks.sparkSession)))
    begins = placed.filter(F.floor((F.col("before") + F.col("rows")) / size) > F.floor(F.col("before") / size)).select("group", "first").collect()
    bounds: dict[int, list[tuple]] = {}
    for group, first in begins:
        bounds.setdefault(group, []).append(_key_of(first))
    for edges in bounds.values():
        edges.sort()
    held = blocks.sparkSession.sparkContext.broadcast(bounds)
    rows = placed.select("group", "run", "file", "offset", "length", "first", "last")
    rows = rows.mapInArrow(lambda batches: _touched(held.value)(batches), f"group long, range long, run string, file string, offset long, length long, first {_PLACE}")
    dealt = rows.repartitionByRange(len(begins) + groups, "group", "range").sortWithinPartitions("group", "range", "run", "first").drop("first")
    return dealt.mapInArrow(lambda batches: _merge(held.value, folder)(batches), BLOCKS if folder else RESULT)


def archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", captured: Column | None = None) -> DataFrame:
    """Writes a record for each row of pages to WARC files in folder; the files' names.

    Null html is an empty payload, null url an empty target. Of rows with equal payloads of LEAST_SHARED bytes or more,
    those with the smallest id are responses, and the others revisit it; rows of a payload that no row with an id has are
    all responses.
    """
    page, url = F.col(f"`{id_col}`").cast("long"), col_or_null(pages, url_col)
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    time = F.lit(EPOCH) + F.pmod(F.coalesce(page, F.lit(0)), F.lit(YEAR)) if captured is None else captured
    rows = pages.select(url_key(url).alias("urlkey"), time.cast("long").alias("captured"), page.alias("page_id"), url.alias("url"), payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct(F.col("page_id").alias("page"), "url", "captured")))
    shared = rows.filter(F.octet_length("payload") >= LEAST_SHARED).groupBy("digest").agg(first.alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
    shared = written(shared.select("digest", "first"), "warc-shared").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(shared, ["digest", "salt"], "left")
    rows = rows.withColumn("refers", F.when(~F.col("first.page").eqNullSafe(F.col("page_id")), F.col("first")))
    runs = rows.sortWithinPartitions("urlkey", "captured", "page_id").select("urlkey", "captured", "page_id", "url", "payload", "digest", "refers")
    return written(runs.mapInArrow(_write_files(folder), "file string"), "warc-files")


def histories(files: DataFrame, folder: str) -> DataFrame:
    """The records of all WARC files, read and checked, in order of URL key, time and page: see RESULT. Index runs go to folder."""
    runs = files.count()
    blocks = written(files.repartition(max(1, runs)).mapInArrow(_index(folder), BLOCKS), "warc-index")
    while runs > FAN_IN:
        blocks, runs = written(_merge_once(blocks, runs, folder), "warc-index"), math.ceil(runs / FAN_IN)
    return _merge_once(blocks, runs, None)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """histories() of archive(), a row for each row of pages; an empty table gives none."""
    folder = folder or shared_path(pages.sparkSession, "warc")
    return histories(archive(pages, folder, id_col, url_col, html_col), folder)
