"""WARC archives with a two-level capture index (operator 9).

`write_archives` writes one record per page, each its own gzip member: a `response` with the
whole page, or a `revisit` without it where the payload is the same as that of a page with a
larger id. `build_capture_index` sorts the captures by reversed-host URL key into blocks,
compresses the blocks one by one, and closes each index file with a sparse directory of its
blocks. `lookup` finds captures by a binary search of the files' first keys, then of the
directory, then of one block, read by its range. `read_records` reads records by ranges.

Defined cases: a null payload is empty, a null url has the key "-"; payloads under
`min_payload` bytes are always responses; of equal rows with the largest id each is a
response; a page without id refers to the response like others, and is a response where no
equal page has an id; an empty table gives no archives and no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.files import create, open_random, task_suffix
from millrace.session import materialize, scratch_path

ARCHIVE_BYTES = 1 << 30
BLOCK_LINES = 3000
READ_BYTES = 8 << 20
FOOTER = "<QQ8s"
MAGIC = b"CAPTIDX1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: http://www.a.example/b?c is "example,a,www)/b?c"."""
    if url is None:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return f")/{url}"
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest


def _clean(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page: int | None, url: str | None, payload: bytes, kind: str, digest: str, refers: int | None, date: str) -> bytes:
    """One record as a gzip member. The block is an HTTP answer, for a revisit only its head."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {date}"]
    lines += [f"WARC-Target-URI: {_clean(url)}"] if url is not None else []
    lines += [f"WARC-Payload-Digest: sha1:{digest}"]
    lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"] if kind == "revisit" else []
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(member: bytes) -> dict:
    """Fields and payload of one gzip member; raises where it is damaged."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    size = int(fields["content-length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    answer, _, payload = rest[:size].partition(b"\r\n\r\n")
    stated = next(int(x.split(b":")[1]) for x in answer.split(b"\r\n") if x.lower().startswith(b"content-length"))
    number = lambda x: int(x.removeprefix("<urn:page:").removesuffix(">")) if x and x != "<urn:page:>" else None
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("the payload is not the one that was written")
    return {"page": number(fields["warc-record-id"]), "type": fields["warc-type"], "bytes": stated, "digest": digest, "refers": number(fields.get("warc-refers-to")), "payload": payload}


def decide_records(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", min_payload: int = 1000) -> DataFrame:
    """Page, url, html, digest, and the page it refers to where it is a revisit. Only ids and
    digests are grouped; pages meet their decision by id, so a payload with very many copies
    is spread like any other."""
    rows = pages.select(F.col(page).cast("long").alias("page"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    narrow = rows.select("page", "digest", F.octet_length("html").alias("n")).where(F.col("n") >= min_payload)
    kept = narrow.groupBy("digest", "n").agg(F.max("page").alias("refers"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    revisits = narrow.join(kept, ["digest", "n"]).where("refers is not null and not (page <=> refers)").select(F.col("page").alias("own"), F.col("digest").alias("own_digest"), "refers").distinct()
    same = F.col("page").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("own_digest"))
    return rows.join(revisits, same, "left").select("page", "url", "html", "digest", "refers")


def write_archives(decided: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives; the stored captures have url_key, page, path, offset, length, digest, type."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at, number = None, "", 0, 0
        for batch in batches:
            found = []
            for p, u, h, d, r in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "html", "digest", "refers")), strict=True):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    path, at, number = f"{folder}/pages-{task_suffix()}-{number:04d}.warc.gz", 0, number + 1
                    out = create(path)
                kind = "response" if r is None else "revisit"
                member = record_bytes(p, u, h.encode(), kind, d, r, date)
                out.write(member)
                found.append((url_key(u), p, path, at, len(member), d, kind))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(x) if i not in (1, 3, 4) else pa.array(x, pa.int64()) for i, x in enumerate(zip(*found, strict=True))], ["url_key", "page", "path", "offset", "length", "digest", "type"])
        if out is not None:
            out.close()

    schema = "url_key string, page long, path string, offset long, length long, digest string, type string"
    return materialize(decided.mapInArrow(write, schema), "captures")


def build_capture_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index files; the stored file list has path, first (key and page) and lines.

    Index lines are (url_key, page, path, offset, length, digest, type) as JSON, in order.
    """
    rows = captures.withColumn("page", F.coalesce("page", F.lit(-(2**63)).cast("long")))
    rows = rows.repartitionByRange("url_key", "page").sortWithinPartitions("url_key", "page", "path", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at, total, first, directory, held = None, f"{folder}/captures-{task_suffix()}.idx", 0, 0, None, [], []

        def flush() -> None:
            nonlocal at, total
            block = zlib.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in held).encode())
            directory.append([held[0][0], held[0][1], at, len(block)])
            out.write(block)
            at, total = at + len(block), total + len(held)
            held.clear()

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out, first = create(path), line[:2]
                held.append(line)
                if len(held) == block_lines:
                    flush()
        if out is not None:
            if held:
                flush()
            end = zlib.compress(json.dumps(directory, ensure_ascii=False).encode())
            out.write(end + struct.pack(FOOTER, at, len(end), MAGIC))
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "first_key": [first[0]], "first_page": pa.array([first[1]], pa.int64()), "lines": pa.array([total], pa.int64())})

    columns = ["url_key", "page", "path", "offset", "length", "digest", "type"]
    return materialize(rows.select(columns).mapInArrow(write, "path string, first_key string, first_page long, lines long"), "capture-files")


class IndexFile:
    """One index file: its directory, and the block last read."""

    def __init__(self, path: str):
        self.handle = open_random(path)
        size = self.handle.size()
        at, length, magic = struct.unpack(FOOTER, self.handle.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError("not a capture index")
        self.directory = json.loads(zlib.decompress(self.handle.read_at(length, at)))
        self.firsts = [(d[0], d[1]) for d in self.directory]
        self.block, self.lines, self.keys = -1, [], []

    def _load(self, block: int) -> None:
        if block != self.block:
            _, _, at, length = self.directory[block]
            self.lines = [json.loads(x) for x in zlib.decompress(self.handle.read_at(length, at)).decode().split("\n")]
            self.block, self.keys = block, [(x[0], x[1]) for x in self.lines]

    def find(self, key: str, page: int) -> list[list]:
        """All captures of that key and page, also where they run over block borders."""
        wanted, found = (key, page), []
        block = max(0, bisect.bisect_left(self.firsts, wanted) - 1)
        while block < len(self.directory) and self.firsts[block] <= wanted:
            self._load(block)
            at = bisect.bisect_left(self.keys, wanted)
            while at < len(self.keys) and self.keys[at] == wanted:
                found.append(self.lines[at])
                at += 1
            block += 1
        return found


def lookup(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Captures of the rows (url, page) of `wanted`, each capture once however often it is asked for.

    The first keys of the index files, one row per range partition of the index build, come to
    the driver; blocks and directories are read in the tasks.
    """
    held = sorted((r["first_key"], r["first_page"], r["path"]) for r in files.collect())
    firsts, paths = [h[:2] for h in held], [h[2] for h in held]
    wanted = wanted.select("url", F.coalesce("page", F.lit(-(2**63)).cast("long")).alias("page")).distinct()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, pages = [url_key(u) for u in batch.column("url").to_pylist()], batch.column("page").to_pylist()
            at, out = [], []
            for k, p in zip(keys, pages, strict=True):
                # Rows of one key and page may run over several files.
                low, high = max(0, bisect.bisect_left(firsts, (k, p)) - 1), bisect.bisect_right(firsts, (k, p))
                for f in range(low, high):
                    at.append((k, p))
                    out.append(f)
            yield pa.RecordBatch.from_pydict({"file": pa.array(out, pa.int64()), "url_key": pa.array([a[0] for a in at], pa.string()), "page": pa.array([a[1] for a in at], pa.int64())})

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, index = None, None
        for batch in batches:
            found = []
            for f, k, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if f != current:
                    current, index = f, IndexFile(paths[f])
                found += [(x[0], None if x[1] == -(2**63) else x[1], *x[2:]) for x in index.find(k, p)]
            cols = list(zip(*found, strict=True)) or [()] * 7
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["url_key", "page", "path", "offset", "length", "digest", "type"])

    routed = wanted.mapInArrow(route, "file long, url_key string, page long").distinct()
    ordered = routed.repartition("file").sortWithinPartitions("file", "url_key", "page")
    return ordered.mapInArrow(find, "url_key string, page long, path string, offset long, length long, digest string, type string")


def read_records(captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """Read the records of the captures by ranges of at most `READ_BYTES` (or one record)."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        for batch in batches:
            paths = batch.column("path").to_pylist()
            begins = batch.column("offset").to_numpy()
            ends, out, at = begins + batch.column("length").to_numpy(), [], 0
            while at < len(paths):
                to = at + 1
                while to < len(paths) and paths[to] == paths[at] and ends[to] - begins[at] <= READ_BYTES:
                    to += 1
                if paths[at] != name:
                    if handle is not None:
                        handle.close()
                    name, handle = paths[at], open_random(paths[at])
                base = int(begins[at])
                data = handle.read_at(int(ends[to - 1]) - base, base)
                out += [parse_record(data[begins[i] - base : ends[i] - base]) for i in range(at, to)]
                at = to
            cols = {"page_id": pa.array([x["page"] for x in out], pa.int64()), "payload_bytes": pa.array([x["bytes"] for x in out], pa.int64()), "payload_digest": pa.array([x["digest"] for x in out], pa.string()), "record_type": pa.array([x["type"] for x in out], pa.string()), "refers_to": pa.array([x["refers"] for x in out], pa.int64())}
            yield pa.RecordBatch.from_pydict(cols | ({"payload": pa.array([x["payload"] for x in out], pa.binary())} if with_payload else {}))

    return captures.repartition("path").sortWithinPartitions("path", "offset").mapInArrow(read, schema)


def archive(pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write the archives and their index, then look every page up and read its record back."""
    folder = folder or scratch_path(pages.sparkSession, "archives")
    captures = write_archives(decide_records(pages, **columns), folder)
    files = build_capture_index(captures, folder)
    page, url = columns.get("page", "page_id"), columns.get("url", "url")
    return read_records(lookup(pages.select(F.col(url).alias("url"), F.col(page).cast("long").alias("page")), files))
