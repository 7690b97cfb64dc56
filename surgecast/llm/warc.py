"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames. A file ends with the
seek table of the seekable format: a skippable frame that lists compressed and
decompressed sizes of all frames, then their number, a descriptor and a magic.
The index maps a record id to file, frame, and offset and length inside the
decompressed frame, so one record is read by decompressing one frame.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.llm import sharedfiles, words
from surgecast.session import materialize, ship_package

MIN_REVISIT = 1000
FRAME_BYTES = 1 << 18
FILE_BYTES = 1 << 26
LEVEL = 3
#: Keys a payload's equal copies are dealt over.
SALTS = 32
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the seekable Zstandard format.
SKIP_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, path string, frame_at long, frame_size long, at long, size long"


def _header(fields: list[tuple[str, str]], body: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + body + b"\r\n\r\n"


def _one_line(x: str) -> str:
    return x.replace("\r", "%0D").replace("\n", "%0A")


def record(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """A response record, or a revisit of ``refers_to`` without its payload."""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", _one_line(url)))
    if refers_to is None:
        return _header(fields, payload)
    return _header([*fields, ("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)], b"")


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Fields and body of the record at ``at``, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    a = end + 4
    z = a + int(fields["Content-Length"])
    if data[z : z + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut off")
    return fields, data[a:z], z + 4


class Bundle:
    """Writer of one file of frames."""

    def __init__(self, path: str, level: int):
        import zstandard

        self.path, self.out = path, sharedfiles.create(path)
        self.tool = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.at, self.frames, self.waiting, self.held = 0, [], [], 0

    def add(self, record_id: str, data: bytes) -> None:
        self.waiting.append((record_id, self.held, data))
        self.held += len(data)

    def flush(self) -> list[tuple]:
        """End the frame; index rows of its records."""
        if not self.waiting:
            return []
        raw = b"".join(x for _, _, x in self.waiting)
        data = self.tool.compress(raw)
        self.out.write(data)
        rows = [(r, self.path, self.at, len(data), at, len(x)) for r, at, x in self.waiting]
        self.frames.append((len(data), len(raw)))
        self.at += len(data)
        self.waiting, self.held = [], 0
        return rows

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *x) for x in self.frames)
        foot = struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIP_MAGIC, len(table) + len(foot)) + table + foot)
        self.out.close()


def read_frames(path: str) -> Iterator[bytes]:
    """Decompressed frames of a file, found by its seek table."""
    import zstandard

    with sharedfiles.open_for_seek(path) as f:
        end = f.size()
        f.seek(end - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError(f"{path} has no seek table")
        f.seek(end - 9 - 8 * n)
        sizes = list(struct.iter_unpack("<II", f.read(8 * n)))
        at = 0
        for size, raw in sizes:
            f.seek(at)
            yield zstandard.ZstdDecompressor().decompress(f.read(size), max_output_size=raw)
            at += size


def read_record(path: str, frame_at: int, frame_size: int, at: int) -> tuple[dict[str, str], bytes]:
    """One record by its index row: decompresses one frame."""
    import zstandard

    with sharedfiles.open_for_seek(path) as f:
        f.seek(frame_at)
        data = zstandard.ZstdDecompressor().decompressobj().decompress(f.read(frame_size))
    fields, body, _ = parse(data, at)
    return fields, body


def _id(page: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("null")))


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT, salts: int = SALTS) -> DataFrame:
    """(page_id, url, html, digest, refers_to) of every row.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the
    largest page_id are responses, the others refer to it. Copies of one
    payload are counted before the shuffle and dealt over ``salts`` keys.
    """
    row = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    row = row.withColumns({"digest": F.sha1(F.encode("html", "UTF-8")), "large": F.octet_length("html") >= min_bytes})
    first = row.where("large").groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")
    out = row.withColumn("salt", salt).join(first, ["digest", "salt"], "left")
    other = F.col("large") & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("page_id", "url", "html", "digest", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT, frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES, level: int = LEVEL) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html) and return the index.

    Null html is an empty payload, a null url gives no target field; a null
    page_id has the id ``urn:page:null`` and never is what others refer to,
    unless no copy has an id (then all are responses). Repeated rows give a
    record each. An empty table gives no files.
    """
    ship_package(pages.sparkSession)
    rows = with_revisits(pages, min_bytes).select(_id(F.col("page_id")).alias("record_id"), "url", "html", "digest", F.when(F.col("refers_to").isNotNull(), _id(F.col("refers_to"))).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, names = None, [x.split()[0] for x in INDEX.split(", ")]
        rows = lambda x: pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in x])
        for b in batches:
            _, off = words.utf8(b.column(2))
            for a, z in words.chunks(off):
                for r in b.slice(a, z - a).to_pylist():
                    if out is None:
                        out = Bundle(sharedfiles.unique_name(folder, ".warc.zst"), level)
                    out.add(r["record_id"], record(r["record_id"], r["url"], r["html"].encode("utf-8"), r["digest"], r["refers_to"]))
                    if out.held >= frame_bytes:
                        yield rows(out.flush())
                        if out.at >= file_bytes:
                            out.close()
                            out = None
        if out is not None:
            if out.waiting:
                yield rows(out.flush())
            out.close()

    return materialize(rows.mapInArrow(run, INDEX))


def read_archives(index: DataFrame) -> DataFrame:
    """All records of the files in ``index``, read file by file: record_id,
    record_type, url, payload_bytes, payload_digest, refers_to, payload (null
    for revisits). Digests and lengths are recomputed from the bytes read for
    responses."""
    spark = index.sparkSession
    kind = "record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary"
    names = [x.split()[0] for x in kind.split(", ")]
    ship_package(spark)

    def rows(data: bytes) -> pa.RecordBatch:
        out, at = [], 0
        while at < len(data):
            f, body, at = parse(data, at)
            full = f["WARC-Type"] == "response"
            digest = hashlib.sha1(body).hexdigest() if full else f["WARC-Payload-Digest"].removeprefix("sha1:")
            if f["WARC-Payload-Digest"] != f"sha1:{digest}":
                raise ValueError(f"{f['WARC-Record-ID']} doesn't have its payload's digest")
            ref = f.get("WARC-Refers-To")
            out.append((f["WARC-Record-ID"][1:-1], f["WARC-Type"], f.get("WARC-Target-URI"), len(body) if full else int(f["X-Payload-Length"]), digest, ref[1:-1] if ref else None, body if full else None))
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                for data in read_frames(path):
                    yield rows(data)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return index.select("path").distinct().repartition(n, "path").mapInArrow(run, kind)


def page_id(record_id: Column) -> Column:
    """The page_id in a record id."""
    return F.nullif(F.substring_index(record_id, ":", -1), F.lit("null")).cast("long")
