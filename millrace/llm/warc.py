"""WARC archives of pages, written in shards and read back.

Records are sorted by page_id and cut into shards of about equal size. The cuts come from the sum
of bytes in each of many ranges of page_id, so they depend on the pages alone and equal input gives
equal files, however Spark deals out its tasks. A shard is written as gzip members (one record
each) into files that are rolled by compressed size, under temporary names. A finished file is
moved to its final name, which shard and number decide; a manifest, written last by Spark, lists
the files that count, with size and digest. A task that runs again after a lost executor writes
the same bytes to the same names; what a dead one left is in no manifest and is removed at the end.

Defined results
* null html counts as the empty payload; null url is kept as null;
* of equal payloads of at least 100 bytes the record with the smallest page_id is the response,
  all others revisit it; shorter payloads are all responses;
* rows that share the smallest page_id and the payload are all responses; a null page_id is never
  the smallest, and where all are null all are responses;
* urls may hold anything: the header has them percent-encoded, a second one keeps them exactly;
* an empty table gives an empty archive; other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.textops import prepare, tidy

LEAST_REVISIT_BYTES = 100
ROLL_BYTES = 64 * 2**20
# Bytes of html and url in a shard, and ranges of page_id of which it is made. A range that holds
# more (a repeated page_id, say) is split by the digest of the payload.
SHARD_BYTES = 32 * 2**20
RANGES = 1 << 14
# Compressed bytes that one task reads back.
READ_BYTES = 16 * 2**20
LEVEL = 4
# Regenerated headers carry one date, so that equal input gives equal files.
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

TEMPORARY = "_temporary-"
MANIFEST = "file string, records long, bytes long, sha256 string"
PAGES = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path that Spark uses, for code in tasks."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


# --- records ---------------------------------------------------------------------------------


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record with regenerated headers and digests; a revisit has no payload of its own."""
    digest = hashlib.sha256(payload).hexdigest()
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    target = "urn:page:unknown" if url is None else urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": target or "urn:page:empty",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
        "X-Page-Id": json.dumps(page_id),
        "X-Page-Url": json.dumps(url),
        "X-Payload-Length": str(len(payload)),
    }
    if revisit:
        headers["WARC-Profile"] = PROFILE
        headers["WARC-Refers-To"] = record_id(refers_to, digest)
        headers["X-Refers-To-Page-Id"] = json.dumps(refers_to)
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def info_record(name: str) -> bytes:
    block = b"software: millrace\r\nformat: WARC File Format 1.1\r\n"
    headers = {
        "WARC-Type": "warcinfo",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        "WARC-Date": DATE,
        "WARC-Filename": name,
        "Content-Type": "application/warc-fields",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{key}: {value}\r\n" for key, value in headers.items())
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def member(content: bytes) -> bytes:
    """A gzip member without a time, so equal content gives equal bytes."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed stream."""
    while first := stream.readline():
        if first.rstrip(b"\r\n") != VERSION.encode():
            raise ValueError(f"not a WARC record: {first[:60]!r}")
        headers = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        size = int(headers["Content-Length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut off")
        yield headers, block


def parsed(headers: dict[str, str], block: bytes) -> tuple:
    """A page's row from its record; digests are checked against the content."""
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != headers["WARC-Block-Digest"]:
        raise ValueError(f"record {headers['WARC-Record-ID']} does not match its block digest")
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(headers["X-Payload-Length"])
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"record {headers['WARC-Record-ID']} does not match its payload")
    return (
        json.loads(headers["X-Page-Id"]),
        json.loads(headers["X-Page-Url"]),
        size,
        digest,
        kind,
        json.loads(headers.get("X-Refers-To-Page-Id", "null")),
    )


# --- files -----------------------------------------------------------------------------------


class _Shard:
    """The files of one task: rolled by compressed size, moved to their names when complete."""

    def __init__(self, folder: str, number: int, roll_bytes: int):
        self.system, self.folder = file_system(folder)
        self.number, self.roll_bytes, self.rolls = number, roll_bytes, 0
        self.out = None

    def start(self) -> None:
        self.name = f"shard-{self.number:06d}-{self.rolls:05d}.warc.gz"
        self.hidden = f"{self.folder}/{TEMPORARY}{uuid.uuid4().hex}"
        self.out = self.system.open_output_stream(self.hidden)
        self.size, self.records, self.digest = 0, 0, hashlib.sha256()
        self.put(info_record(self.name))
        self.records = 0

    def put(self, content: bytes) -> None:
        packed = member(content)
        self.out.write(packed)
        self.digest.update(packed)
        self.size += len(packed)
        self.records += 1

    def add(self, content: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.start()
        self.put(content)
        if self.size >= self.roll_bytes:
            yield self.finish()

    def finish(self) -> tuple:
        self.out.close()
        self.out = None
        final = f"{self.folder}/{self.name}"
        if self.system.get_file_info(final).type != pafs.FileType.NotFound:
            self.system.delete_file(final)  # the same bytes, from an earlier attempt
        self.system.move(self.hidden, final)
        self.rolls += 1
        return self.name, self.records, self.size, self.digest.hexdigest()


def _write(folder: str, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, noted, target = None, None, None
        for batch in batches:
            done = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                number, page_id, digest, note, refers_to, url, html = row
                if shard is None or shard.number != number:
                    if shard is not None and shard.out is not None:
                        done.append(shard.finish())
                    shard = _Shard(folder, number, roll_bytes)
                if note == 0:
                    noted, target = (page_id, digest), refers_to
                    continue
                found = target if noted == (page_id, digest) else None
                done += shard.add(record(page_id, url, (html or "").encode(), found))
            if done:
                yield _manifest(done)
        if shard is not None and shard.out is not None:
            yield _manifest([shard.finish()])

    return write


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        names=["file", "records", "bytes", "sha256"],
    )


def _sharded(rows: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """For each range of page_id its shards (range, first, pieces), and how many there are."""
    ends = rows.agg(F.min("page_id"), F.max("page_id")).first()
    low, high = (0 if end is None else end for end in ends)
    width = (high - low) // RANGES + 1
    place = F.coalesce(F.expr(f"(page_id - {low}) div {width}"), F.lit(-1).cast("long"))
    weight = F.col("size") + F.coalesce(F.octet_length("url"), F.lit(0)) + 500  # headers
    sums = rows.groupBy(place.alias("range")).agg(F.sum(weight).alias("bytes"))
    shards, number, filled = [], -1, shard_bytes
    for part, size in sorted((row["range"], row["bytes"]) for row in sums.collect()):
        pieces = -(-size // shard_bytes)
        if filled + size > shard_bytes:
            number, filled = number + 1, 0
        shards.append((part, number, pieces))
        filled += size
        number += pieces - 1
    named = rows.sparkSession.createDataFrame(shards, "range long, first long, pieces long")
    # RANGES rows and one at most, so no page is moved to meet them.
    dealt = rows.withColumn("range", place).join(F.broadcast(named), "range")
    piece = F.pmod(F.xxhash64("digest"), F.col("pieces"))
    dealt = dealt.withColumn("shard", (F.col("first") + piece).cast("int"))
    return dealt.drop("range", "first", "pieces"), number + 1


def write_archive(
    pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES
) -> None:
    """Write pages (page_id, url, html) as WARC files and, last, their manifest."""
    prepare(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.sha2(html, 256).alias("digest"),
        "url",
        "html",
        F.octet_length(html).alias("size"),
    )
    rows, shards = _sharded(rows, shard_bytes)
    # The first page of each payload that occurs more than once; a frequent one is summed up
    # before the shuffle, and no payload is shuffled for this.
    long_rows = rows.where(F.col("size") >= LEAST_REVISIT_BYTES).select("shard", "page_id", "digest")
    firsts = long_rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"))
    notes = (
        long_rows.join(firsts, "digest")
        .where("page_id IS NULL OR page_id <> refers_to")
        .where("refers_to IS NOT NULL")
        .distinct()
    )
    # One shuffle brings each page and the note on what it revisits together, in order.
    both = notes.select(
        "shard",
        "page_id",
        "digest",
        F.lit(0).alias("note"),
        "refers_to",
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("html"),
    ).unionAll(
        rows.select(
            "shard",
            "page_id",
            "digest",
            F.lit(1).alias("note"),
            F.lit(None).cast("long").alias("refers_to"),
            "url",
            "html",
        )
    )
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    ordered = both.repartitionByRange(max(shards, 1), "shard")
    ordered = ordered.sortWithinPartitions("shard", "page_id", "digest", "note", "url")
    files = ordered.mapInArrow(tidy(_write(folder, roll_bytes)), MANIFEST)
    files.write.parquet(f"{folder}/manifest")
    for found in system.get_file_info(pafs.FileSelector(path)):
        if found.base_name.startswith(TEMPORARY):
            system.delete_file(found.path)


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            for name, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found, count = [], 0
                with (
                    system.open_input_stream(f"{path}/{name}", compression=None) as raw,
                    gzip.GzipFile(fileobj=raw) as stream,
                ):
                    for headers, block in records(stream):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        found.append(parsed(headers, block))
                        count += 1
                        if len(found) == 5000:
                            yield rows(found)
                            found = []
                if count != wanted:
                    raise ValueError(f"{name} holds {count} records, its manifest says {wanted}")
                if found:
                    yield rows(found)

    return read


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of an archive, from the files that its manifest names: see PAGES."""
    prepare(spark)
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    size = files.agg(F.sum("bytes"), F.count("file")).first()
    # As many tasks as the archive asks for; a given number is not merged at run time.
    tasks = min(size[1], max(-(-(size[0] or 0) // READ_BYTES), spark.sparkContext.defaultParallelism))
    files = files.select("file", "records").repartition(max(tasks, 1))
    return files.mapInArrow(tidy(_read(folder)), PAGES)
