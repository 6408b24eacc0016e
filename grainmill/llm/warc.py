"""Web archives: pages to WARC files, each one gzip stream; these to files with a member for each record and an offset index.

A task writes its records into files that are one gzip stream from beginning to end, as some crawlers leave
them. The normaliser inflates such a file once, as a stream, deflates every record again as a member of its own,
and writes beside the new file a list of offsets. Single records are then read without what stands before them.

Records with equal payloads are kept once: one is a response, the others revisit it and carry no payload. Payloads
are grouped with a partial aggregation, so a payload that a third of all pages share leaves a map task once; the
narrow rows of very common payloads are dealt over salted keys before they meet the page they revisit.

Files have names of their own for every attempt of a task, and only files named in a stored manifest are read, so
lost or repeated tasks leave at most files that nobody reads. Folders are any that pyarrow's file systems open.
"""

from __future__ import annotations

import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.batches import as_batches, by_row
from grainmill.llm.staging import stored

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31  # window bits of zlib for a gzip stream
CHUNK = 1 << 18
#: Bytes of records after which a task begins another file; a file is inflated by one task.
FILE_BYTES = 64 << 20
#: Packed bytes that a task reads back.
READ_BYTES = 64 << 20
#: Rows of one payload from which its key is salted, unless fewer than `1 / MOST_HEAVY` of all rows.
HEAVY, MOST_HEAVY = 100_000, 10_000


# --- records ------------------------------------------------------------------------------------


def header_value(value: str) -> str:
    """A text that may stand in a header: control characters and spaces as percent codes."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in value)


def record_head(fields: dict[str, object], length: int) -> bytes:
    """Version line and named fields; null ones are left out."""
    lines = [VERSION.decode()] + [f"{name}: {value}" for name, value in fields.items() if value is not None]
    return ("\r\n".join(lines) + f"\r\nContent-Length: {length}\r\n\r\n").encode("utf-8", "surrogatepass")


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def base32_digest(payload: bytes) -> str:
    return b32encode(sha1(payload).digest()).decode()


def record_bytes(page_id, url, payload, size, digest, record_id, refers_id, refers_page, refers_url) -> bytes:
    """One record: a response with its payload, or a revisit (`refers_id` not null) without."""
    revisit = refers_id is not None
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{record_id}>",
        "WARC-Target-URI": None if url is None else header_value(url),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Page-ID": page_id,
        "X-Payload-Length": size,
    }
    if revisit:
        fields |= {
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": f"<urn:uuid:{refers_id}>",
            "WARC-Refers-To-Target-URI": None if refers_url is None else header_value(refers_url),
            "X-Refers-To-Page-ID": refers_page,
        }
    fields["Content-Type"] = "application/http; msgtype=response"
    block = http_head(0) if revisit else http_head(size) + payload
    return record_head(fields, len(block)) + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    """The named fields of a record's head, names in lower case."""
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


class Inflated:
    """A gzip file of one or more members as one stream of bytes, a chunk at a time."""

    def __init__(self, source):
        self.source, self.inflate, self.held, self.ended = source, zlib.decompressobj(GZIP), b"", False

    def fill(self) -> bool:
        """More bytes into `held`; false at the end of the file."""
        while not self.ended:
            packed = self.inflate.unconsumed_tail or self.inflate.unused_data or self.source.read(CHUNK)
            if self.inflate.eof:
                if not packed:
                    self.ended = True
                    break
                self.inflate = zlib.decompressobj(GZIP)
            elif not packed:
                raise ValueError("the archive ends within a gzip stream")
            found = self.inflate.decompress(packed, CHUNK)
            if found:
                self.held += found
                return True
        return False

    def head(self) -> bytes | None:
        """The bytes up to and with the blank line that ends a head; None at the end."""
        while True:
            while self.held[:2] == b"\r\n":
                self.held = self.held[2:]
            at = self.held.find(b"\r\n\r\n")
            if at >= 0:
                found, self.held = self.held[: at + 4], self.held[at + 4 :]
                return found
            if not self.fill():
                if self.held.strip():
                    raise ValueError("the archive ends within the head of a record")
                return None

    def block(self, length: int) -> Iterator[bytes]:
        """The next `length` bytes."""
        while length:
            if not self.held and not self.fill():
                raise ValueError("the archive ends within a record")
            part, self.held = self.held[:length], self.held[length:]
            length -= len(part)
            yield part


# --- writing ------------------------------------------------------------------------------------


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder)
    return system, path.rstrip("/")


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, heavy: int = HEAVY) -> DataFrame:
    """One row for each record to be written, payloads in UTF-8 (null: empty).

    Of records with equal payloads of at least `least` bytes, the one with the largest id (null is the smallest,
    the largest url on a tie, one of them if all is equal) is a response, the others revisit it. Shorter ones are
    all responses. `heavy` only decides from how many rows on a payload's key is salted.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.unhex(F.sha2("payload", 256)).alias("key"), F.unhex(F.sha1("payload")).alias("sha1"))
    small = F.col("size") < least

    page = F.struct("page_id", "url")
    alone = rows.groupBy("key", F.when(small, page).alias("own")).agg(
        F.any_value("payload").alias("payload"), F.any_value("size").alias("size"), F.any_value("sha1").alias("sha1"),
        F.max(page).alias("page"), F.count("*").alias("n"),
    )
    copies = F.when(F.col("size") < least, F.col("n")).otherwise(F.lit(1))
    first = _copied(alone, copies).select("key", "page", "payload", "size", "sha1", "copy", F.lit(None).cast("struct<page_id: bigint, url: string>").alias("refers"))

    narrow = rows.where(~small).groupBy("key", "page_id", "url").agg(F.any_value("size").alias("size"), F.any_value("sha1").alias("sha1"), F.count("*").alias("n"))
    narrow = stored(narrow, "payloads")
    groups = stored(narrow.groupBy("key").agg(F.max(page).alias("refers"), F.sum("n").alias("total")).where("total > 1"), "groups")
    total = groups.agg(F.sum("total")).first()[0] or 0
    limit = max(heavy, total // MOST_HEAVY)
    salts = F.when(F.col("total") > limit, F.ceil(F.col("total") / limit)).otherwise(F.lit(1)).cast("long")
    common = groups.where(F.col("total") > limit).select("key", salts.alias("salts"))  # at most MOST_HEAVY rows
    salted = narrow.join(F.broadcast(common), "key", "left")
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("salts", F.lit(1).cast("long")))).drop("salts")
    dealt = groups.select("key", "refers", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"))
    met = salted.join(dealt, ["key", "salt"])
    later = _copied(met, F.col("n") - F.when(page.eqNullSafe(F.col("refers")), 1).otherwise(0), begin=1)
    later = later.select("key", page.alias("page"), F.lit(None).cast("binary").alias("payload"), "size", "sha1", "copy", "refers")
    return first.union(later)


def _copied(rows: DataFrame, n, begin: int = 0) -> DataFrame:
    """Every row `n` times, numbered by `copy`, in steps so that no long array is made."""
    step = 10_000
    steps = rows.withColumn("copies", n.cast("long")).where("copies > 0")
    steps = steps.withColumn("step", F.explode(F.expr(f"sequence(0L, (copies - 1) div {step})")))
    return steps.withColumn("copy", F.explode(F.expr(f"sequence(step * {step} + {begin}, least((step + 1) * {step}, copies) - 1 + {begin})"))).drop("copies", "step")


def record_id(key, page, copy):
    """A UUID made from payload, page and number of the copy."""
    parts = F.concat_ws(":", F.hex(key), F.coalesce(page["page_id"].cast("string"), F.lit("-")), F.coalesce(F.sha1(page["url"].cast("binary")), F.lit("-")), copy.cast("string"))
    text = F.sha2(parts, 256)
    return F.concat_ws("-", *[F.substring(text, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = 6) -> DataFrame:
    """Archives of `page_records`, each one gzip stream, as a stored manifest `(path, records, bytes)`; no records, no files."""
    page, refers = F.col("page"), F.col("refers")
    rows = records.select(
        "page.page_id", "page.url", "payload", "size", "sha1", record_id(F.col("key"), page, F.col("copy")).alias("record_id"),
        F.when(refers.isNotNull(), record_id(F.col("key"), refers, F.lit(0))).alias("refers_id"),
        F.col("refers.page_id").alias("refers_page"), F.col("refers.url").alias("refers_url"),
    )

    def run(batches):
        system, root = _opened(folder)

        def files():
            system.create_dir(root, recursive=True)
            rows, row = by_row(batches), None
            row = next(rows, None)
            while row is not None:
                path, count, held = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                deflate = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                with system.open_output_stream(path, compression=None) as out:
                    while row is not None and held < file_bytes:
                        page_id, url, payload, size, digest, *ids = row
                        data = record_bytes(page_id, url, payload, size, b32encode(digest).decode(), *ids)
                        out.write(deflate.compress(data))
                        count, held = count + 1, held + len(data)
                        row = next(rows, None)
                    out.write(deflate.flush())
                yield path.rpartition("/")[2], count, held

        return as_batches(files(), {"path": pa.string(), "records": pa.int64(), "bytes": pa.int64()}, size=1)

    return stored(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")


# --- normalising --------------------------------------------------------------------------------


def normalise(archives: DataFrame, folder: str, into: str, level: int = 6) -> DataFrame:
    """Archives named by `archives(path)` below `folder`, written anew below `into` with a gzip member for each record.

    Gives the stored index `(path, offset, length, record_id, record_type)`, offsets in the new file of the same
    name; the same rows stand as tab separated lines in `<path>.idx` beside it. Members may have been one or many
    before. An archive that ends within a record fails the job.
    """
    count = archives.count()

    def run(batches):
        source, root = _opened(folder)
        target, new_root = _opened(into)

        def index():
            target.create_dir(new_root, recursive=True)
            for (path,) in by_row(batches):
                name = f"{uuid.uuid4().hex}-{path}"
                at = 0
                with (
                    source.open_input_stream(f"{root}/{path}", compression=None) as packed,
                    target.open_output_stream(f"{new_root}/{name}", compression=None) as out,
                    target.open_output_stream(f"{new_root}/{name}.idx", compression=None) as sidecar,
                ):
                    stream = Inflated(packed)
                    while (head := stream.head()) is not None:
                        fields = parse_head(head)
                        deflate = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                        length = 0
                        for part in (head, *stream.block(int(fields["content-length"])), b"\r\n\r\n"):
                            packed_part = deflate.compress(part)
                            length += len(packed_part)
                            out.write(packed_part)
                        rest = deflate.flush()
                        out.write(rest)
                        length += len(rest)
                        row = (name, at, length, fields.get("warc-record-id"), fields.get("warc-type"))
                        sidecar.write(("\t".join(map(str, row[1:])) + "\n").encode("utf-8", "surrogatepass"))
                        yield row
                        at += length

        return as_batches(index(), {"path": pa.string(), "offset": pa.int64(), "length": pa.int64(), "record_id": pa.string(), "record_type": pa.string()})

    paths = archives.select("path").repartition(max(1, min(count, 10_000)))
    return stored(paths.mapInArrow(run, "path string, offset long, length long, record_id string, record_type string"), "offsets")


# --- reading ------------------------------------------------------------------------------------

RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_member(data: bytes) -> tuple:
    """The row of one gzip member; a payload that does not have its digest is an error."""
    record = zlib.decompress(data, GZIP)
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = parse_head(head)
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest, size, kind = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"]), fields["warc-type"]
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    if kind == "response":
        size = len(payload)
        if base32_digest(payload) != digest:
            raise ValueError(f"record {fields['warc-record-id']}: the payload does not have its digest")
    return (
        None if page is None else int(page), fields.get("warc-target-uri"), size, digest, kind,
        None if refers is None else int(refers), payload if kind == "response" else None,
    )


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of an index as `RECORD`, each read from its offset; payloads are null for revisits or if not wanted.

    Lengths and digests are those of the whole payload, of revisits as their record tells them.
    """

    def run(batches):
        system, root = _opened(folder)

        def records():
            for path, members in groupby(by_row(batches), key=lambda row: row[0]):
                with system.open_input_file(f"{root}/{path}") as archive:
                    for _, offset, length in members:
                        row = read_member(archive.read_at(length, offset))
                        yield row if payloads else (*row[:-1], None)

        fields = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        return as_batches(records(), dict(zip((f.split()[0] for f in RECORD.split(", ")), fields)), size=200)

    size = index.agg(F.sum("length")).first()[0] or 0
    # the index is small beside what it names, so the number of tasks follows the bytes that they read
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-size // READ_BYTES))
    rows = index.select("path", "offset", "length").repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset")
    return rows.mapInArrow(run, RECORD)
