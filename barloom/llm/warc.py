"""Deterministic sharded WARC archives of web pages.

Records are range-sorted by page_id: the distinct ids are ranked exactly and cut into parts of equal numbers of ids, and each part
goes to files of its own that roll by compressed size, whichever task writes it. Every record is a gzip member of its own with fixed header fields, so equal input gives
equal bytes; lengths, digests and record ids are regenerated from the content. Files are written under a
temporary name and moved when complete, and only those in the manifest count.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest page_id is a
``response``; the others are ``revisit`` records without a payload that name it. Which payloads are equal is settled
on (digest, page_id) alone, combined before the shuffle. What is found travels to the part as narrow rows that stand before their pages
in its order, and the first ids of the parts, ``MOST_PARTS`` at most, pass the driver; so payloads are moved once, straight to
their part. Reading streams member by member and checks every digest.

Defined cases: null html is an empty payload. A null or empty url becomes ``urn:page:<page_id>``; control characters and
blanks in a url are percent-encoded. Of rows that repeat the smallest page_id of a payload all
are responses. A null page_id comes first and names no response. An empty table gives no files and no rows. Extra columns are not read.
"""
from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import first_n_rank, stage
from barloom.llm.shards import committed, read_file
from barloom.sources.tables import scratch_dir

MIN_REVISIT = 100
ROLL_BYTES = 16 << 20  # compressed size at which a file ends
LEAST_IDS, MOST_PARTS = 256, 8_192  # ids of a part at least, parts at most
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def in_parts(pages: DataFrame) -> DataFrame:
    """Pages and, ahead of each page that is a revisit, a row without ``payload_bytes`` that tells ``refers_to``; with their part."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    facts = stage(rows.select("page_id", "digest", "payload_bytes"), "warc-facts")
    shared = (
        facts.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    links = (
        facts.select("digest", "page_id").join(shared, "digest").where("page_id > first_id")
        .select("page_id", "digest", F.col("first_id").alias("refers_to")).distinct()
    )
    return rows.unionByName(links, allowMissingColumns=True).withColumn("part", _part_of(F.col("page_id"), _first_ids(facts)))


def _first_ids(facts: DataFrame) -> list[int]:
    """First page_id of every part but the lowest: equal numbers of ids by exact rank, so layouts and runs agree."""
    ranked = first_n_rank(facts.select("page_id").distinct(), [F.col("page_id").asc_nulls_first()], "rank", "warc-ids")
    each = max(LEAST_IDS, -(-ranked.count() // MOST_PARTS))
    return sorted(r.page_id for r in ranked.where((F.col("rank") > 0) & (F.col("rank") % each == 0)).select("page_id").collect())


def _part_of(page_id: Column, first_ids: list[int]) -> Column:
    """How many of the ascending ids are not above ``page_id``, by halving; a null id is in part 0."""
    if not first_ids:
        return F.lit(0).cast("long")
    bounds = F.split(F.lit(",".join(map(str, first_ids))), ",").cast("array<bigint>")  # one literal
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(first_ids).bit_length()))])
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= page_id, at + step).otherwise(at)
    )
    return found.cast("long")


def _settled(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    """Pages in order, each with what the row ahead of it tells; a revisit has no payload."""
    told = None
    for batch in batches:
        for part, page_id, url, payload, digest, size, refers_to in zip(*(batch.column(c).to_pylist() for c in columns)):
            if size is None:
                told = page_id, digest, refers_to
                continue
            refers_to = told[2] if told is not None and told[:2] == (page_id, digest) else None
            yield part, page_id, url, payload if refers_to is None else None, digest, size, refers_to


def _uri(url: str | None, page_id: int | None) -> str:
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    return url or f"urn:page:{'' if page_id is None else page_id}"


def _record_id(page_id: int | None, digest: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}").urn


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    revisit = refers_to is not None
    block = HTTP_HEAD % size + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_record_id(page_id, digest)}>"),
        ("WARC-Date", WARC_DATE),
        ("WARC-Target-URI", _uri(url, page_id)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{_record_id(refers_to, digest)}>"),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # gzip without a time stamp
    return packer.compress(data) + packer.flush()


MANIFEST = "part long, number long, file string, records long, bytes long, sha256 string"


def write_warc(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archives; the manifest, one row per file."""

    columns = ("part", "page_id", "url", "payload", "digest", "payload_bytes", "refers_to")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _settled(batches, columns)
        part, number, row = None, 0, next(rows, None)
        while row is not None:
            part, number = row[0], number + 1 if row[0] == part else 0
            name, records, content = f"part-{part:06d}-{number:06d}.warc.gz", 0, hashlib.sha256()
            with committed(folder, name) as out:
                while row is not None and row[0] == part and (records == 0 or out.tell() < roll_bytes):
                    member = _member(record(*row[1:]))
                    out.write(member)
                    content.update(member)
                    records += 1
                    row = next(rows, None)
                size = out.tell()
            yield pa.RecordBatch.from_pylist([{
                "part": part, "number": number, "file": name, "records": records, "bytes": size, "sha256": content.hexdigest(),
            }])

    spark = pages.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ahead = F.col("payload_bytes").isNotNull()  # false comes first
    ordered = in_parts(pages).repartition(tasks, "part").sortWithinPartitions("part", "page_id", "digest", ahead, "url")
    ordered.select(*columns).mapInArrow(written, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a gzip-compressed archive, one member at a time."""
    pending = b""
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            data = pending or stream.read(1 << 20)
            pending = b""
            if not data:
                if parts:
                    raise ValueError("an archive ends within a record")
                return
            parts.append(unpacker.decompress(data))
        pending = unpacker.unused_data
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        block = rest[:int(fields["Content-Length"])]
        if version != "WARC/1.1" or fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError("a record's digest does not match its block")
        yield fields, block


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _read_row(fields: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError("a payload does not match its digest or length")
    number = lambda k: int(fields[k]) if fields.get(k) else None
    return {
        "page_id": number("X-Page-ID"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": number("X-Refers-To-Page-ID"), "url": fields["WARC-Target-URI"], "payload": payload if kind == "response" else None,
    }


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Every record of the archives that the manifest names; ``payloads`` adds the response bodies."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    schema = READ if payloads else READ.removesuffix(", payload binary")
    names = [c.split()[0] for c in schema.split(", ")]
    arrow = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for n, c in zip(names, schema.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with read_file(folder, name) as stream:
                    rows, size = [], 0
                    for fields, block in records_of(stream):
                        row = _read_row(fields, block)
                        rows.append({n: row[n] for n in names})
                        size += len(block)
                        if size > 8_000_000 or len(rows) >= 5_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    tasks = spark.sparkContext.defaultParallelism * 4
    return manifest.select("file").repartition(tasks, "file").mapInArrow(read, schema)


def archive(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    write_warc(pages, folder)
    return read_warc(pages.sparkSession, folder)
