"""WARC archives: writer, and a reader that salvages damaged files.

The writer makes one gzip member per record and starts a new file after
``roll_bytes``. Only files named in the manifest that the write job commits
are read, so a task that is run twice leaves no double records.

The reader checks each record (member, version line, header, length, digest).
After a failed check it searches for the next valid member or version line,
goes on from there and logs the bytes between as a quarantined gap. A file is
read in byte ranges, so a large archive is spread over many tasks; a range
owns the records that begin in it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstlight.llm.tables import filesystem, shuffle_partitions, stored
from firstlight.session import scratch_dir

ROLL_BYTES = 32 << 20
RANGE_BYTES = 64 << 20
LEVEL = 3
REVISIT_BYTES = 1000

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
EPOCH = "1970-01-01T00:00:00Z"

RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, gap_begin long, gap_end long, gap_reason string, path string"
)


def _urn(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, str(page_id))}>"


def _line(value: str) -> str:
    """A header value stands on one line."""
    return " ".join(value.split())


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed WARC record."""
    sha = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        VERSION.decode(),
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {EPOCH}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha.digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes, level: int = LEVEL) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


class Damaged(ValueError):
    """A check of a record failed."""


def parse_record(raw: bytes) -> tuple[dict, int]:
    """The record at the beginning of ``raw`` and its length; raises ``Damaged``."""
    if not raw.startswith(b"WARC/1."):
        raise Damaged("no version line")
    split = raw.find(b"\r\n\r\n")
    if split < 0:
        raise Damaged("header without end")
    if b"\0" in raw[:split]:
        raise Damaged("null byte in the header")
    head = {}
    for line in raw[:split].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without colon")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "surrogatepass")
    try:
        begin, length = split + 4, int(head["content-length"])
        page = int(head["x-page-id"]) if "x-page-id" in head else None
        refers = int(head["x-refers-to-page-id"]) if "x-refers-to-page-id" in head else None
    except (KeyError, ValueError):
        raise Damaged("bad header value") from None
    block = raw[begin : begin + length]
    if length < 0 or len(block) < length or raw[begin + length : begin + length + 4] != b"\r\n\r\n":
        raise Damaged("wrong length")
    if not head.get("warc-type") or not head.get("warc-record-id"):
        raise Damaged("no type or no id")
    record = {"page_id": page, "url": head.get("warc-target-uri"), "record_type": head.get("warc-type"), "refers_to": refers}
    digest = head.get("warc-payload-digest", "")
    try:
        told = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest.startswith("sha1:") else None
    except ValueError:
        raise Damaged("bad digest value") from None
    body = block.find(b"\r\n\r\n")
    payload = block[body + 4 :] if body >= 0 and block.startswith(b"HTTP/") else block
    if record["record_type"] == "revisit":
        size = head.get("x-payload-length", "")
        record |= {"payload": None, "payload_bytes": int(size) if size.isdigit() else None, "payload_digest": told}
    else:
        actual = hashlib.sha1(payload).hexdigest()
        if told is not None and told != actual:
            raise Damaged("digest differs")
        record |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": actual}
    return record, begin + length + 4


class _Window:
    """Random access to a file through one growing window, so that little is held in memory."""

    def __init__(self, file, size: int, step: int = 1 << 20):
        self.file, self.size, self.step, self.at, self.data = file, size, step, 0, b""

    def get(self, begin: int, n: int) -> bytes:
        """Up to n bytes from ``begin``."""
        if begin < self.at or begin + n > self.at + len(self.data):
            if not self.at <= begin <= self.at + len(self.data):
                self.at, self.data = begin, b""
            else:
                self.at, self.data = begin, self.data[begin - self.at :]
            need = min(self.size, begin + max(n, self.step)) - self.at - len(self.data)
            if need > 0:
                self.file.seek(self.at + len(self.data))
                self.data += self.file.read(need)
        return self.data[begin - self.at : begin - self.at + n]


def _member(window: _Window, begin: int) -> tuple[dict, int]:
    """The record in the gzip member at ``begin`` and the member's length."""
    z, out, at = zlib.decompressobj(31), [], begin
    try:
        while not z.eof:
            part = window.get(at, 1 << 16)
            if not part:
                raise Damaged("member without end")
            out.append(z.decompress(part))
            at += len(part)
            if len(out) == 1 and out[0] and not out[0].startswith(b"WARC/1."[: len(out[0])]):
                raise Damaged("no version line")
    except zlib.error as e:
        raise Damaged(f"gzip: {e}") from None
    raw = b"".join(out)
    record, length = parse_record(raw)
    if length != len(raw):
        raise Damaged("bytes after the record")
    return record, at - len(z.unused_data) - begin


def _plain(window: _Window, begin: int) -> tuple[dict, int]:
    """The uncompressed record at ``begin``; reads more until its length is known to be there."""
    n = 1 << 16
    while True:
        raw = window.get(begin, n)
        try:
            return parse_record(raw)
        except Damaged:
            # More bytes help only while the header or the block may be cut off.
            if len(raw) < n or not raw.startswith(b"WARC/1.") or not _cut_off(raw):
                raise
        n *= 4


def _cut_off(raw: bytes) -> bool:
    """Whether the record may go on behind ``raw``."""
    split = raw.find(b"\r\n\r\n")
    if split < 0:
        return len(raw) < 1 << 20
    for line in raw[:split].lower().split(b"\r\n"):
        if line.startswith(b"content-length:"):
            value = line.partition(b":")[2].strip()
            return value.isdigit() and split + 8 + int(value) > len(raw)
    return False


def _valid_at(window: _Window, at: int) -> tuple[dict, int]:
    head = window.get(at, 7)
    if head.startswith(GZIP_MAGIC):
        return _member(window, at)
    if head == b"WARC/1.":
        return _plain(window, at)
    raise Damaged("neither member nor version line")


def _search(window: _Window, at: int) -> int:
    """Where the next valid record begins, at ``at`` or later; the file's size when there is none."""
    while at < window.size:
        part = window.get(at, 1 << 16)
        found = sorted(
            i for mark in (GZIP_MAGIC, b"WARC/1.") for i in _places(part, mark)
        )
        for i in found:
            try:
                _valid_at(window, at + i)
                return at + i
            except Damaged:
                continue
        at += max(1, len(part) - 6) if at + len(part) < window.size else len(part)
    return window.size


def _places(part: bytes, mark: bytes) -> Iterator[int]:
    i = part.find(mark)
    while i >= 0:
        yield i
        i = part.find(mark, i + 1)


def salvage(file, size: int, begin: int = 0, end: int | None = None) -> Iterator[dict]:
    """Records that begin in [begin, end) and gaps behind them, in file order.

    A range that does not begin the file starts at its first valid record;
    what stands before that is told by the range of the record before.
    """
    window, end = _Window(file, size), size if end is None else end
    at, inside = (begin, True) if begin == 0 else (_search(window, begin), False)
    while at < size and (at < end or inside):
        try:
            record, length = _valid_at(window, at)
        except Damaged as e:
            after = _search(window, at + 1)
            yield {"gap_begin": at, "gap_end": after, "gap_reason": str(e)}
            at = after
            inside = False
            continue
        if at >= end:
            return
        yield record
        at, inside = at + length, True


def write_archives(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, level: int = LEVEL) -> DataFrame:
    """Writes ``page_id, url, payload, refers_to`` rows; returns the committed manifest ``path, bytes, records``."""

    def run(batches):
        fs = part = out = path = None
        written = records = 0

        def done():
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "bytes": written, "records": records}], schema=manifest)

        manifest = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
        for b in batches:
            for row in b.to_pylist():
                if out is None:
                    path = f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
                    fs, part = filesystem(path)
                    fs.create_dir(part.rpartition("/")[0], recursive=True)
                    out, written, records = fs.open_output_stream(part, compression=None), 0, 0
                payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                raw = gzip_member(encode_record(row["page_id"], row["url"], payload, row["refers_to"]), level)
                out.write(raw)
                written, records = written + len(raw), records + 1
                if written >= roll_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    rows = pages.select(F.col("page_id").cast("long"), "url", "html", "refers_to")
    return stored(rows.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """Records and quarantined gaps of the files in ``manifest (path, bytes)``; gaps have a ``gap_reason``.

    ``payloads=False`` leaves the payloads out of the rows; they are checked all the same.
    """
    spark = manifest.sparkSession
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = manifest.select("path", "bytes", starts.alias("begin")).repartition(shuffle_partitions(spark))
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORD_SCHEMA.split(", ")])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, path = filesystem(r["path"])
                rows, held = [], 0
                with fs.open_input_file(path) as file:
                    for x in salvage(file, r["bytes"], r["begin"], min(r["bytes"], r["begin"] + range_bytes)):
                        if not payloads:
                            x.pop("payload", None)
                        held += len(x.get("payload") or b"") + 200
                        rows.append({n: x.get(n) for n in names[:-1]} | {"path": r["path"]})
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ranges.mapInArrow(run, RECORD_SCHEMA)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """A manifest of existing archives under ``path``, listed by Spark."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"))


def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages with ``refers_to``: the largest ``page_id`` of an equal payload of at least ``least_bytes``, if another row's.

    A link belongs to a ``page_id`` and a payload, so rows of one id with different payloads are linked apart.
    """

    def run(batches):
        for b in batches:
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary()), pa.array([len(x) for x in raw], pa.int64())],
                ["page_id", "digest", "size"],
            )

    keyed = pages.select(F.col("page_id").cast("long"), "html").mapInArrow(run, "page_id long, digest binary, size long")
    large = stored(keyed.filter(F.col("size") >= least_bytes), "warc-digests")
    groups = large.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("last")).filter("n > 1")
    links = (
        large.join(groups, "digest").filter("page_id <> last")
        .select(F.col("page_id").alias("revisit_id"), "digest", F.col("last").alias("refers_to")).distinct()
    ).withColumnRenamed("digest", "revisit_digest")
    # sha2 of the UTF-8 bytes, as above.
    own = F.unhex(F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256))
    same = (F.col("page_id").cast("long") == F.col("revisit_id")) & (own == F.col("revisit_digest"))
    return pages.join(links, same, "left").drop("revisit_id", "revisit_digest")


def round_trip(pages: DataFrame, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the pages and reads them back: one row per page.

    A null ``html`` is an empty payload; a null ``page_id`` or ``url`` is kept
    as null; columns other than ``page_id, url, html`` are ignored; an empty
    table gives no file and no row.
    """
    cols = pages.select("page_id", "url", "html")
    manifest = write_archives(with_revisits(cols), scratch_dir(pages.sparkSession, "warc"), roll_bytes)
    records = read_archives(manifest, payloads=False)
    checked = F.when(F.col("gap_reason").isNotNull(), F.raise_error(F.concat(F.lit("damaged archive: "), F.col("path"))).cast("long"))
    return records.select(
        checked.alias("_gap"), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    ).filter("_gap is null").drop("_gap")
