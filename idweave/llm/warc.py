"""WARC archives with a two-level capture index.

*Writing.* Every page becomes one record, each a gzip member of its own, so any record
can be read alone by its range. Of equal payloads the smallest id is the response, the
others are revisits without a body. Tasks write files of bounded size under fresh names; the
list of records is written by Spark, so files of a failed attempt are never named.

*Index.* (reversed-host key, id) is range-partitioned and sorted. Each partition
writes one index file of compressed blocks of lines, and beside it its sparse block
directory (first key, offset, length of each block). The upper level is the first key of
every index file.

*Look-up.* A request goes to its index file by the upper level, finds its block
by binary search in the directory, reads that block's range, finds its lines by binary
search, and reads the records' ranges.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections import OrderedDict
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch_path, ship

FILE_BYTES = 256 << 20  # an archive file ends with the record that reaches this
BLOCK_LINES = 1000      # captures in a block of the index
READ_TASK = 5000        # captures a look-up task reads on average, if all are asked for
LEVEL = 4               # of gzip
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
NO_ID = -(1 << 63)      # sorts a null id first
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- files ----------------------------------------------------------------

def file_system(path: str):
    """(file system, path in it) of a folder all executors share."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") \
        else (pafs.LocalFileSystem(), path)


def member(data: bytes) -> bytes:
    """``data`` as one gzip member."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Reader:
    """Range reads on a bounded number of open files."""

    def __init__(self, most: int = 32):
        self.open, self.most = OrderedDict(), most

    def member(self, path: str, offset: int, length: int) -> bytes:
        f = self.open.pop(path, None)
        if f is None:
            fs, inner = file_system(path)
            f = fs.open_input_file(inner)
            if len(self.open) >= self.most:
                self.open.popitem(last=False)[1].close()
        self.open[path] = f
        f.seek(offset)
        return zlib.decompress(f.read(length), 31)


# ---- records --------------------------------------------------------------

def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def url_key(url: str) -> str:
    """Reversed-host sort key: ``com,example,www)/path?query``, free of control characters."""
    text = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    _, found, rest = text.partition("://")
    if not found:
        return text
    host = re.match(r"[^/?#]*", rest)[0]
    return ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host):]


def record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """A response, or a revisit of ``refers_to`` which leaves the body out."""
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "urn:page:none"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {uri}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a record; the payload of a revisit is None."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
    page = fields["WARC-Record-ID"][len("<urn:page:"):-1]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    refers = fields.get("WARC-Refers-To")
    if refers is None and (len(payload) != size or
                           base32_sha1(hashlib.sha1(payload).hexdigest()) != digest):
        raise ValueError(f"record of page {page}: the payload does not match its digest")
    return {"page_id": int(page) if page else None, "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "target_uri": fields["WARC-Target-URI"],
            "refers_to": int(refers[len("<urn:page:"):-1]) if refers else None,
            "payload": None if refers else payload}


# ---- writing --------------------------------------------------------------

def write_warc(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """Archive every row of ``pages`` under ``folder``; one row per record:
    url_key, page_id, file, offset, length."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                        F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    first = (rows.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("digest", "first_id"))
    rows = rows.join(first, "digest", "left").select(
        "page_id", "url", F.encode("html", "UTF-8").alias("html"), "digest",
        F.when(F.col("first_id") != F.coalesce("page_id", F.lit(NO_ID)), F.col("first_id"))
        .alias("refers_to"))

    def run(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        name, out, at = None, None, 0
        try:
            for part in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
                done = []
                for r in part.to_pylist():
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    data = member(record(r["page_id"], r["url"], r["html"],
                                         base32_sha1(r["digest"]), r["refers_to"]))
                    out.write(data)
                    done.append({"url_key": url_key(r["url"]), "page_id": r["page_id"],
                                 "file": name, "offset": at, "length": len(data)})
                    at += len(data)
                yield pa.RecordBatch.from_pylist(done, _RECORDS)
        finally:
            if out is not None:
                out.close()

    return materialize(rows.mapInArrow(
        run, "url_key string, page_id long, file string, offset long, length long"), "captures")


_RECORDS = pa.schema([("url_key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                      ("offset", pa.int64()), ("length", pa.int64())])


@dataclass
class CaptureIndex:
    folder: str                        # of archives and index files
    files: list[tuple[tuple, str]]     # (first key, index file): the upper level
    captures: int


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Sorted, compressed index blocks and their directories under ``folder``."""
    key = [F.col("url_key"), F.coalesce("page_id", F.lit(NO_ID)).alias("id")]
    rows = captures.select(*key, "file", "offset", "length")
    rows = rows.repartitionByRange("url_key", "id").sortWithinPartitions("url_key", "id")

    def run(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        name, at, blocks, lines, first = f"{uuid.uuid4().hex}.idx", 0, [], [], None
        out, n = None, 0
        for batch in batches:
            for k, i, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                lines.append(f"{k}\t{i}\t{file}\t{offset}\t{length}")
                n += 1
                first = first or (k, i)
                if len(lines) == block_lines:
                    at = _put(out, at, blocks, lines, first)
                    lines, first = [], None
        if out is None:
            return
        if lines:
            _put(out, at, blocks, lines, first)
        out.close()
        with fs.open_output_stream(f"{root}/{name}.dir", compression=None) as f:
            f.write(json.dumps(blocks).encode())
        yield pa.RecordBatch.from_pylist([{"url_key": blocks[0][0], "id": blocks[0][1], "name": name,
                                           "n": n}])

    # one row per index file, so as many as the shuffle has partitions
    made = materialize(rows.mapInArrow(run, "url_key string, id long, name string, n long"),
                       "index_files").collect()
    files = sorted(((r.url_key.encode(), r.id), r.name) for r in made)
    return CaptureIndex(folder, files, sum(r.n for r in made))


def _put(out, at: int, blocks: list, lines: list[str], first: tuple) -> int:
    data = member("\n".join(lines).encode())
    out.write(data)
    blocks.append([*first, at, len(data)])
    return at + len(data)


# ---- look-up --------------------------------------------------------------

_FOUND = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, target_uri string, payload binary")


def lookup(index: CaptureIndex, requests: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of ``requests`` (url_key, page_id; each key once); keys that
    were never captured give no row."""
    if not index.files:
        requests = requests.where("false")
    first, names = [k for k, _ in index.files], [n for _, n in index.files]
    folder = index.folder

    @F.arrow_udf("int")
    def index_file(keys: pa.Array, ids: pa.Array) -> pa.Array:
        return pa.array([max(bisect.bisect_right(first, (k.encode(), i)) - 1, 0)
                         for k, i in zip(keys.to_pylist(), ids.to_pylist())], pa.int32())

    def run(batches):
        reader, fs_root = Reader(), file_system(folder)
        held, blocks, starts, block, lines, keys = None, [], [], None, [], []
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("target_uri", pa.string()),
                            ("payload", pa.binary())])
        for batch in batches:
            out, size = [], 0
            for n, k, i in zip(*(c.to_pylist() for c in batch.columns)):
                key = (k.encode(), i)
                if n != held:  # the directory of this index file
                    with fs_root[0].open_input_file(f"{fs_root[1]}/{names[n]}.dir") as f:
                        blocks = json.loads(f.read())
                    starts, held, block = [(b[0].encode(), b[1]) for b in blocks], n, None
                # equal keys may begin at the end of the block before
                b = max(bisect.bisect_left(starts, key) - 1, 0)
                while b < len(blocks) and (starts[b] <= key):
                    if block != b:
                        data = reader.member(f"{folder}/{names[n]}", *blocks[b][2:])
                        lines = [x.split("\t") for x in data.decode().split("\n")]
                        keys, block = [(x[0].encode(), int(x[1])) for x in lines], b
                    at = bisect.bisect_left(keys, key)
                    while at < len(keys) and keys[at] == key:
                        _, _, file, offset, length = lines[at]
                        row = parse(reader.member(f"{folder}/{file}", int(offset), int(length)))
                        if not with_payload:
                            row["payload"] = None
                        out.append(row)
                        size += len(row["payload"] or b"")
                        if size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, size = [], 0
                        at += 1
                    b += 1
            yield pa.RecordBatch.from_pylist(out, schema)

    ship(requests.sparkSession)
    asked = (requests.select("url_key", F.coalesce("page_id", F.lit(NO_ID)).alias("id"))
             .select(index_file("url_key", "id").alias("n"), "url_key", "id"))
    # contiguous key ranges, so few tasks read the same block; the rows are small but each
    # stands for a range read, so the number of tasks follows the captures
    tasks = max(len(names), -(-index.captures // READ_TASK), 1)
    return (asked.repartitionByRange(tasks, "n", "url_key", "id").sortWithinPartitions("n", "url_key", "id")
            .mapInArrow(run, _FOUND))


def warc_round_trip(pages: DataFrame, folder: str | None = None, with_payload: bool = False, *,
                    id_col: str = "page_id", url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """Write ``pages`` to WARC files, index them, and read every capture back by its key.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to,
    target_uri, payload (only if ``with_payload``; null for revisits). A null html is an
    empty payload; a null url has the empty key. Of equal payloads the smallest page_id is the
    response and the others revisit it; a row without page_id revisits it too, and is a
    response where no row of its payload has an id. Rows that repeat a page_id and its
    payload are the same capture and share its record type. Other columns are left out; an
    empty table gives no rows. ``folder`` must be shared by all executors; by default it
    is a fresh one under the checkpoint folder.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    captures = write_warc(pages, folder, id_col=id_col, url_col=url_col, html_col=html_col)
    index = build_index(captures, folder)
    requests = captures.select("url_key", "page_id").distinct()
    return lookup(index, requests, with_payload)
