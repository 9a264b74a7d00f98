"""WARC archives: a writer of gzip members, and a reader that splits files anywhere.

*Writing.* Each task writes one file, a gzip member for each record, under a name of its
own attempt; only files of tasks that succeeded are in the manifest, so lost executors
and repeated tasks leave nothing that is read. Payloads that occur before (in a smaller
id) become revisit records that refer to the first.

*Reading.* Files are cut into byte ranges, and a task scans its range for the gzip
magic. A candidate counts if its member inflates to a WARC header, which random bytes do
not. The task owns the records that start in its range and reads past its end to
finish the last one. After a damaged member it scans on. No task needs to know where
another's records are.

Files are read and written through ``pyarrow.fs``, which takes the URIs of local,
HDFS and object stores, as ``spark.checkpoint.dir`` names them.

Cases: a null payload is empty, a null URL is left out of the record. A null id comes
after all others; two null ids with one payload are both responses, as neither has a
name to refer to, and so are rows that repeat the first id. Empty payloads are payloads
like any other. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as store
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterflow.llm.tables import new_path, stored

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range, of a read, fed to the unpacker at once, and of the header a candidate is judged by.
SPLIT, READ, FEED, HEADER = 32 << 20, 1 << 20, 1 << 14, 5
NO_ID = (1 << 63) - 1
PREFIX = "urn:page:"
DATE = "2000-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value: object) -> str:
    return f"{name}: {value}\r\n"


def record(page: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """A response record, or a revisit of ``first``; both carry the HTTP header of the payload."""
    revisit = first is not None
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    if not revisit:
        block += payload
    head = "WARC/1.1\r\n" + _line("WARC-Type", "revisit" if revisit else "response")
    head += _line("WARC-Record-ID", f"<{PREFIX}{page}>" if page is not None else f"<urn:uuid:{uuid.uuid4()}>")
    if url is not None:
        head += _line("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A"))
    head += _line("WARC-Date", DATE) + _line("WARC-Payload-Digest", f"sha1:{digest(payload)}")
    if revisit:
        head += _line("WARC-Refers-To", f"<{PREFIX}{first}>")
        head += _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += _line("Content-Type", "application/http;msgtype=response") + _line("Content-Length", len(block))
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0
) -> DataFrame:
    """Writes a record for each row; returns the manifest: path, length and records of each file.

    Payloads of at least ``least`` bytes that occur in a smaller id become revisits.
    """
    given = pages.select(
        F.col(id_col).cast("long").alias("page"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    ).withColumns({"sha": F.unhex(F.sha1("payload")), "size": F.octet_length("payload")})
    # only payloads that occur twice or more are joined to
    firsts = (
        given.where(F.col("size") >= least)
        .groupBy("sha")
        .agg(F.count("*").alias("n"), F.min("page").alias("first"))
        .where("n > 1 and first is not null")
        .drop("n")
    )
    joined = given.join(firsts, "sha", "left")
    other = F.col("first") < F.coalesce("page", F.lit(NO_ID))
    records = joined.select("page", "url", "payload", F.when((F.col("size") >= least) & other, F.col("first")).alias("first"))

    def write(batches):
        files, base = store.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        path, n, length, out = f"{base}/part-{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for page, url, payload, first in zip(*columns, strict=True):
                out = out or files.open_output_stream(path, compression=None)
                data = _gzip(record(page, url, payload.encode(), first))
                out.write(data)
                n, length = n + 1, length + len(data)
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path.rsplit("/", 1)[1]]), pa.array([length]), pa.array([n])], names=["file", "length", "records"])

    return stored(records.mapInArrow(write, "file string, length long, records long"), "warc-manifest")


class _Window:
    """Bytes of a file from a moving place on."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size = file, size
        self.data, self.begin, self.at = b"", at, at

    def has(self, n: int) -> int:
        """How many of the next ``n`` bytes there are, after reading on if need be."""
        have = self.begin + len(self.data) - self.at
        if have < n and self.at + have < self.size:
            self.file.seek(self.at + have)
            self.data = self.data[self.at - self.begin :] + self.file.read(max(READ, n - have))
            self.begin, have = self.at, len(self.data)
        return min(have, n)

    def part(self, skipped: int, n: int) -> bytes:
        """Up to ``n`` bytes, ``skipped`` bytes further on."""
        n = self.has(skipped + n) - skipped
        low = self.at - self.begin + skipped
        return self.data[low : low + max(n, 0)]

    def find(self) -> bool:
        """Moves to the next gzip magic."""
        while self.has(len(MAGIC)) == len(MAGIC):
            found = self.data.find(MAGIC, self.at - self.begin)
            if found >= 0:
                self.at = self.begin + found
                return True
            self.at = self.begin + len(self.data) - len(MAGIC) + 1  # the magic may go on behind
        return False


def _inflate(window: _Window) -> tuple[bytes, int] | None:
    """The member at the window's place and its length; None if there is no WARC member."""
    unpack, out, used = zlib.decompressobj(31), bytearray(), 0
    while not unpack.eof:
        part = window.part(used, FEED)
        if not part:
            return None  # cut short
        try:
            out += unpack.decompress(part)
        except zlib.error:
            return None
        used += len(part) - len(unpack.unused_data)
        if not b"WARC/".startswith(out[:HEADER]):
            return None
    return (bytes(out), used) if len(out) >= HEADER else None


def members(file, size: int, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of the members that start from ``start`` up to ``end``."""
    window = _Window(file, size, start)
    while window.find() and window.at < end:
        member = _inflate(window)
        if member is None:
            window.at += 1
        else:
            yield window.at, member[0]
            window.at += member[1]


def parse(data: bytes) -> dict | None:
    """Fields of a record; None if it isn't whole."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError):
        return None
    if len(rest) < length:
        return None
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    size = len(payload)
    for line in http.decode("latin-1").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        if name.strip().lower() == "content-length" and value.strip().isdigit():
            size = int(value)
    return {
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id", "").strip("<>") or None,
        "target_uri": fields.get("warc-target-uri"),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
        "payload_bytes": size,
        "payload": payload,
    }


RECORDS = (
    "file string, offset long, record_type string, record_id string, target_uri string, "
    "payload_digest string, refers_to string, payload_bytes long, payload binary"
)
_KINDS = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary())
_NAMES = [x.split()[0] for x in RECORDS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS, strict=True)], names=_NAMES)


def read_warc(spark: SparkSession, folder: str, files: DataFrame, split: int = SPLIT) -> DataFrame:
    """The records of ``files`` (file, length) in a folder, read by ranges of ``split`` bytes."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split).cast("long")))
    ranges = files.select("file", "length", starts.alias("start"))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def read(batches):
        access, base = store.FileSystem.from_uri(folder)
        for batch in batches:
            for r in batch.to_pylist():
                rows, held = [], 0
                with access.open_input_file(f"{base}/{r['file']}") as file:
                    for offset, data in members(file, r["length"], r["start"], min(r["start"] + split, r["length"])):
                        fields = parse(data)
                        if fields is None:
                            continue
                        rows.append((r["file"], offset, *[fields[n] for n in _NAMES[2:]]))
                        held += len(data)
                        if held > READ:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return ranges.repartition(tasks, "file", "start").mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads the records back."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    if "://" not in folder:  # a bare path, or file:/path
        folder = f"file://{folder.removeprefix('file:')}"
    manifest = write_warc(pages, folder, id_col, url_col, payload_col)
    return read_warc(spark, folder, manifest)
