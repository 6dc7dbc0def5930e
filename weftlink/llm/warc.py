"""Writing WARC archives and reading them back, also when they are damaged.

Archives hold one gzip member per record (plain records are read too). The reader checks
what it parses: gzip's own check, the version line, lengths and digests. Where a check
fails it searches for the next gzip member that begins a record, or the next version line,
goes on from there, and logs the bytes in between as a quarantined gap. The same holds
inside a member of several records, and for what inflates of a damaged one.

Contract of write_pages() and read_archives(): a null url is an empty one, a null html an
empty payload. Of records with equal payloads of at least `least` bytes the smallest
page_id (null only if all are) is the response and those with another page_id revisit it,
so repeated rows of that page_id are responses again; smaller payloads are all responses.
Payloads are whole; an empty table writes no archive. Other columns are not read. A task
names its files by its attempt and only files of finished tasks come into the manifest,
so a lost executor leaves nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm.common import Workspace, small_enough

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ROLL_BYTES = 64 << 20
#: Bytes first read for a header; a longer one is read on in doubled blocks.
HEADER = 1 << 12
#: Compressed bytes read at a time, and salted copies of a duplicate group's first page.
CHUNK = 1 << 20
SALTS = 64
#: Fields a header has once.
SINGLE = ("warc-type", "warc-record-id", "content-length")
_MEMBER = b"\x1f\x8b\x08"
_LINE = b"WARC/1."


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    name = identifier.strip("<>").rpartition(":")[2]
    return int(name) if name else None


def encode_record(page_id: int | None, url: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record, not compressed. A revisit keeps the HTTP head and leaves out the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to else head + payload
    clean = "".join(c for c in url if c not in "\r\n\x00")
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", clean),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if refers_to:
        fields += [("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE)]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    deflate = zlib.compressobj(5, zlib.DEFLATED, 31)
    return deflate.compress(record) + deflate.flush()


@dataclass
class Record:
    offset: int
    length: int
    fields: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]

    @property
    def payload_bytes(self) -> int:
        """Length of the full payload: a revisit's is in its HTTP head."""
        for line in self.block.partition(b"\r\n\r\n")[0].split(b"\r\n"):
            if line.lower().startswith(b"content-length:"):
                return int(line.partition(b":")[2])
        return len(self.payload)


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


class Damaged(Exception):
    """A check that failed."""


class _Blocks:
    """fetch(offset, size) through a buffer of CHUNK bytes or more, so that reading on reads each byte about once."""

    def __init__(self, fetch: Callable[[int, int], bytes], length: int):
        self.fetch, self.length, self.at, self.data = fetch, length, 0, b""

    def __call__(self, at: int, n: int) -> bytes:
        n = min(n, self.length - at)
        if n <= 0:
            return b""
        if at < self.at or at + n > self.at + len(self.data):
            self.at, self.data = at, self.fetch(at, min(max(n, CHUNK), self.length - at))
        return self.data[at - self.at : at - self.at + n]


class Salvage:
    """Reads records of an archive of `length` bytes through fetch(offset, size).

    What lies in a member is scanned like an archive of its own. Of a member that is cut off
    or fails its check, what inflates before that is scanned too, and records come of it if
    they state a digest of their block and it holds.
    """

    def __init__(self, fetch: Callable[[int, int], bytes], length: int, members: bool = True):
        self.fetch, self.length, self.members = _Blocks(fetch, length) if members else fetch, length, members

    def __iter__(self) -> Iterator[Record | Gap]:
        at, gap, reason = 0, None, ""
        while at < self.length:
            found, end, broken = self._read(at)
            if broken is None:
                if gap is not None:
                    yield Gap(gap, at - gap, reason)
                    gap = None
                at = end
            else:
                if gap is None:
                    gap, reason = at, broken
                at = self._next(at + 1)
            yield from found
        if gap is not None:
            yield Gap(gap, self.length - gap, reason)

    def _next(self, at: int) -> int:
        """Where the next member or version line may begin."""
        while at < self.length:
            part = self.fetch(at, CHUNK)
            hits = [h for h in (part.find(_MEMBER) if self.members else -1, part.find(_LINE)) if h >= 0]
            if hits:
                return at + min(hits)
            if at + len(part) >= self.length:
                break
            at += max(1, len(part) - len(_LINE) + 1)
        return self.length

    def _read(self, at: int) -> tuple[list[Record | Gap], int, str | None]:
        """What is found at a place, where it ends, and why it is damaged, if it is."""
        start = self.fetch(at, len(_LINE))
        if self.members and start.startswith(_MEMBER):
            return self._member(at)
        if not start.startswith(_LINE):
            return [], at, "no member or version line"
        try:
            record, size = parse(lambda begin, n: self.fetch(at + begin, n), self.length - at)
        except Damaged as broken:
            return [], at, str(broken)
        return [Record(at, size, *record)], at + size, None

    def _member(self, at: int) -> tuple[list[Record | Gap], int, str | None]:
        inflate, content, here, size, broken = zlib.decompressobj(31), bytearray(), at, 1 << 13, None
        while not inflate.eof and broken is None:
            data, before = self.fetch(here, size), inflate.copy()
            if not data:
                broken = "member is cut off"
                break
            try:
                content += inflate.decompress(data)
            except zlib.error as error:
                broken = f"member fails its check: {error}"
                content += _until_error(before, data)
            here, size = here + len(data), min(2 * size, CHUNK)
            if len(content) >= len(_LINE) and not content.startswith(_LINE):
                return [], at, "member holds no record"
        end = here - len(inflate.unused_data)
        view = memoryview(content)
        found: list[Record | Gap] = list(Salvage(lambda begin, n: bytes(view[begin : begin + n]), len(content), members=False))
        records = [Record(at, end - at, r.fields, r.block) for r in found if isinstance(r, Record)]
        if broken:
            return [r for r in records if r.fields.get("warc-block-digest", "").startswith("sha1:")], at, broken
        gaps = [Gap(at, end - at, f"{g.length} bytes at {g.offset} in the member: {g.reason}") for g in found if isinstance(g, Gap)]
        if gaps and not records:
            return [], at, gaps[0].reason
        return [*records, *gaps], end, None


def _until_error(inflate, data: bytes) -> bytes:
    """What inflates of data before the error in it."""
    out = bytearray()
    try:
        for i in range(len(data)):
            out += inflate.decompress(data[i : i + 1])
    except zlib.error:
        pass
    return bytes(out)


def parse(fetch: Callable[[int, int], bytes], length: int) -> tuple[tuple[dict[str, str], bytes], int]:
    """(fields, block) of the plain record at 0, and its size with the closing line ends; raises Damaged."""
    head = fetch(0, min(HEADER, length))
    close = head.find(b"\r\n\r\n")
    while close < 0 and len(head) < length and head.startswith(_LINE):
        more = fetch(len(head), min(len(head), length - len(head)))
        if not more or any(b":" not in line for line in head.split(b"\r\n")[1:-1]):  # no header, however long
            break
        begin = max(0, len(head) - 3)
        head += more
        close = head.find(b"\r\n\r\n", begin)
    if not head.startswith(_LINE) or close < 0:
        raise Damaged("no version line or no end of the header")
    fields = {}
    for line in head[:close].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        key = name.decode("latin-1").lower()
        if key in fields and key in SINGLE:
            raise Damaged("header runs into another record's")
        fields[key] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise Damaged("no length")
    begin, n = close + 4, int(size)
    if begin + n + 4 > length:
        raise Damaged("block is cut off")
    block = fetch(begin, n)
    if fetch(begin + n, 4) != b"\r\n\r\n":
        raise Damaged("block does not end where its length says")
    told = fields.get("warc-block-digest", "")
    if told.startswith("sha1:") and told[5:] != digest(block):
        raise Damaged("block digest differs")
    told = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "response" and told.startswith("sha1:") and told[5:] != digest(block.partition(b"\r\n\r\n")[2]):
        raise Damaged("payload digest differs")
    return (fields, block), begin + n + 4


def salvage(data: bytes) -> list[Record | Gap]:
    return list(Salvage(lambda at, n: data[at : at + n], len(data)))


def with_originals(pages: DataFrame, least: int = 0, work: Workspace | None = None) -> DataFrame:
    """page_id, url, payload and refers_to (null, or the page_id of the response that it repeats)."""
    work = work or Workspace(pages.sparkSession, "warc")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("_sha", F.sha1("payload"))
    groups = rows.where(F.octet_length("payload") >= least).groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").select(F.col("_sha").alias("_g"), "_first")
    groups, small = small_enough(work.save(groups, "groups"))
    if small:
        met = rows.join(groups, F.col("_sha") == F.col("_g"), "left")
    else:  # the rows of a large group go to as many tasks as there are salts
        salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.withColumn("_s", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))).join(salted, (F.col("_sha") == F.col("_g")) & (F.col("_s") == F.col("_salt")), "left")
    other = F.col("_g").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return met.select("page_id", "url", "payload", other.alias("revisit"), F.when(other, F.col("_first")).alias("refers_to"))


def write_pages(pages: DataFrame, folder: str, least: int = 0, roll: int = ROLL_BYTES, work: Workspace | None = None) -> DataFrame:
    """Write pages(page_id, url, html) as archives into a shared folder; the manifest (path, records, bytes)."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"{root}/pages-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        done, out, records, size, path = [], None, 0, 0, ""
        for batch in batches:
            for page, url, payload, revisit, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path = f"{name}-{len(done):04d}.warc.gz"
                    out, records, size = store.open_output_stream(path, compression=None), 0, 0
                data = member(encode_record(page, url, payload.encode(), record_id(refers) if revisit else None))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= roll:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        scheme = folder.partition("://")[0] + "://" if "://" in folder else ""
        host = folder.partition("://")[2].partition("/")[0] if scheme and scheme != "file://" else ""
        paths = [scheme + host + p if p.startswith("/") else p for p, _, _ in done]
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["path", "records", "bytes"])

    work = work or Workspace(pages.sparkSession, "warc")
    manifest = with_originals(pages, least, work).mapInArrow(run, "path string, records long, bytes long")
    return work.save(manifest, "manifest")


RECORD_DDL = "path string, offset long, length long, kind string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, payload binary, reason string"


def read_archives(paths: DataFrame, payloads: bool = True) -> DataFrame:
    """Records (kind response or revisit) and quarantined gaps (kind gap, with a reason) of archives, by path."""
    spark: SparkSession = paths.sparkSession
    tasks = max(1, min(paths.count(), 8 * spark.sparkContext.defaultParallelism))

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        schema = ["path", "offset", "length", "kind", "page_id", "url", "payload_bytes", "payload_digest", "refers_to", "payload", "reason"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]

        def flush(rows):
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=schema)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, where = fs.FileSystem.from_uri(path)
                with store.open_input_file(where) as source:
                    rows = []
                    for item in Salvage(lambda at, n, source=source: source.read_at(n, at) if n > 0 else b"", source.size()):
                        if isinstance(item, Gap):
                            rows.append((path, item.offset, item.length, "gap", None, None, None, None, None, None, item.reason))
                        else:
                            f = item.fields
                            refers = f.get("warc-refers-to")
                            rows.append((path, item.offset, item.length, f.get("warc-type"), page_of(f.get("warc-record-id", "")), f.get("warc-target-uri"), item.payload_bytes, f.get("warc-payload-digest", "").removeprefix("sha1:"), page_of(refers) if refers else None, item.payload if payloads else None, None))
                        if len(rows) >= 500:
                            yield flush(rows)
                            rows = []
                    yield flush(rows)

    return paths.select("path").repartition(tasks).mapInArrow(run, RECORD_DDL)


#: What the round trip must give, without any archive: digests are spelled in base 32 bit by bit.
ORACLE = """
with hashed as (
    select page_id, octet_length(encode(coalesce(html, '')))::BIGINT as payload_bytes, sha1(coalesce(html, '')) as h from pages
), bits as (
    select *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * instr('0123456789abcdef', substr(h, i, 1)) - 3, 4)), '') as b,
        min(page_id) over (partition by h) as first_page from hashed
)
select page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * (substr(b, 5 * i + 1, 1) = '1')::INT
        + 8 * (substr(b, 5 * i + 2, 1) = '1')::INT + 4 * (substr(b, 5 * i + 3, 1) = '1')::INT + 2 * (substr(b, 5 * i + 4, 1) = '1')::INT + (substr(b, 5 * i + 5, 1) = '1')::INT, 1)), '') as payload_digest,
    case when page_id is not distinct from first_page then 'response' else 'revisit' end as record_type, case when page_id is distinct from first_page then first_page end as refers_to
from bits
"""
