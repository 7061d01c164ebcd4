"""Deterministic sharded WARC writer and reader.

Records are sorted by page id and digest. The bytes of all pages are added up in that order, and a
new shard begins wherever the sum passes another ``SHARD_BYTES`` (more if there would be more than
``SHARDS`` of them), so shards depend on the pages alone, however their ids lie. The sum is one of
ranges, one row each, plus one within each range; what the tasks that write get is where
shards begin. A task writes one shard record by record, each its own gzip
member, and begins a new file when one has ``FILE_BYTES`` compressed. Headers,
digests and record ids are made anew from the page; nothing depends on time or host.

Commit. Tasks write under temporary names that no other attempt has, and return one
row per file. Spark keeps the rows of one attempt per task; those files are renamed,
and then the manifest (a table with name, records, bytes and SHA-256 of each
file) is written. Readers open what the manifest names. What lost attempts leave has
temporary names and is never read.

Of pages with equal payloads of at least ``REVISIT_BYTES``, the one with the smallest
id is written in full, others as revisits of it. A marker row per revisit is sorted in front
of its page, so the pages are shuffled once.

Defined cases: a null html is an empty payload; a null url is an empty target URI; a null id is
written last, and revisits a page with an id if one has its payload; one id on many pages, or
none, is cut by digest; rows equal in id and payload stay in one shard, whose files are rolled;
equal rows are written once each, and if they have the smallest id of their payload all are
responses; no pages make an empty manifest. Other columns are not written.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listmill.llm.common import stored, table
from listmill.operators.joins import join_unique
from listmill.session import work_dir

SHARD_BYTES = 16 << 20
# Most shards; their beginnings take 5 MB.
SHARDS = 1 << 16
FILE_BYTES = 8 << 20
REVISIT_BYTES = 100
# Bytes of headers counted per record.
HEADER_BYTES = 700
LEVEL = 6

# Date of records whose time is not known, and the profile of revisits.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_FILE = "temporary string, name string, records long, bytes long, sha256 string"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def _quoted(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def record(
    page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One WARC record; with ``refers_to`` a revisit without the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _quoted(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{_sha256(block)}"),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    if page is not None:
        fields.append(("X-Page", str(page)))
    return _framed([*fields, ("Content-Type", "application/http; msgtype=response")], block)


def _framed(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"".join([b"WARC/1.1\r\n", lines.encode(), b"\r\n", block, b"\r\n\r\n"])


def info_record(name: str) -> bytes:
    block = f"filename: {name}\r\nformat: WARC File Format 1.1\r\n".encode()
    fields = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", _record_id(None, name)),
        ("WARC-Date", DATE),
        ("WARC-Block-Digest", f"sha256:{_sha256(block)}"),
        ("Content-Type", "application/warc-fields"),
    ]
    return _framed(fields, block)


class _File:
    """An archive under a temporary name."""

    def __init__(self, where: fs.FileSystem, folder: str, name: str):
        self.name, self.temporary = name, f".{name}.{uuid.uuid4().hex}"
        self.stream = where.open_output_stream(f"{folder}/{self.temporary}", compression=None)
        self.bytes = self.records = 0
        self.sha = hashlib.sha256()
        self.add(info_record(name))
        self.records = 0

    def add(self, data: bytes) -> None:
        member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        packed = member.compress(data) + member.flush()
        self.stream.write(packed)
        self.sha.update(packed)
        self.bytes += len(packed)
        self.records += 1

    def close(self) -> list:
        self.stream.close()
        return [self.temporary, self.name, self.records, self.bytes, self.sha.hexdigest()]


def _rows(found: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [dict(zip(schema.names, row, strict=True)) for row in found], schema
    )


def _writer(folder: str, file_bytes: int):
    schema = pa.schema(
        [("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64())]
        + [("bytes", pa.int64()), ("sha256", pa.string())]
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = fs.FileSystem.from_uri(folder)
        file, shard, number, marker = None, None, 0, None
        for batch in batches:
            for row in _each(batch):
                if row["is_page"] == 0:
                    marker = (row["page_id"], row["digest"], row["refers_to"])
                    continue
                if row["shard"] != shard or (file and file.bytes >= file_bytes):
                    number = number + 1 if row["shard"] == shard else 0
                    shard = row["shard"]
                    if file:
                        yield _rows([file.close()], schema)
                    file = _File(where, path, f"pages-{shard:06d}-{number:04d}.warc.gz")
                same = marker and marker[:2] == (row["page_id"], row["digest"])
                refers_to = marker[2] if same else None
                payload = row["payload"] or b""
                file.add(record(row["page_id"], row["url"], payload, row["digest"], refers_to))
        if file:
            yield _rows([file.close()], schema)

    return written


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _renamer(folder: str):
    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                here = where.get_file_info(f"{path}/{row['temporary']}")
                if here.type == fs.FileType.File:  # else an attempt before has renamed it
                    where.move(f"{path}/{row['temporary']}", f"{path}/{row['name']}")
            yield batch

    return renamed


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages to write as revisits, each once."""
    large = pages.where(F.col("n") >= REVISIT_BYTES).select("page_id", "digest")
    firsts = (
        large.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND refers_to IS NOT NULL")
        .drop("copies")
    )
    return (
        join_unique(large, firsts, "digest", "inner")
        .where("page_id IS NULL OR page_id <> refers_to")
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def page_shards(pages: DataFrame, shard_bytes: int) -> list[tuple[bool, int, str]]:
    """The first (id is null, id, digest) of each shard, in order."""
    order = [F.col("page_id").asc_nulls_last(), F.col("digest")]
    groups = pages.groupBy("page_id", "digest").agg(F.sum(F.col("n") + HEADER_BYTES).alias("bytes"))
    # stored, so that the ranges stay as they are for both sums
    ranges = stored(
        groups.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "warc-ranges"
    )
    sums = ranges.groupBy("range").agg(F.sum("bytes").alias("bytes")).orderBy("range").collect()
    total = sum(r["bytes"] for r in sums)
    size = max(shard_bytes, -(-total // SHARDS))
    starts, so_far = [], 0
    for r in sums:
        starts.append((r["range"], so_far))
        so_far += r["bytes"]
    offsets = pages.sparkSession.createDataFrame(starts, "range int, start long")
    before = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("start") + F.coalesce(F.sum("bytes").over(before), F.lit(0))
    key = F.struct(
        F.col("page_id").isNull().alias("none"),
        F.coalesce("page_id", F.lit(0)).alias("id"),
        "digest",
    )
    shards = (
        ranges.join(F.broadcast(offsets), "range")  # a row per range
        .select(key.alias("key"), F.floor(place / size).alias("shard"))
        .groupBy("shard")
        .agg(F.min("key").alias("key"))
    )
    return sorted((r["none"], r["id"], r["digest"]) for r in shards.select("key.*").collect())


def _shard(begins: list[tuple[bool, int, str]]):
    """The shard of a page's id and digest."""

    @F.arrow_udf("int")
    def shard(ids: pa.Array, digests: pa.Array) -> pa.Array:
        rows = zip(ids.to_pylist(), digests.to_pylist(), strict=True)
        found = [bisect_right(begins, (i is None, i or 0, d)) - 1 for i, d in rows]
        return pa.array(found, pa.int32())

    return shard


def write_warc(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write the pages to ``folder``; returns the manifest, stored there too."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    slim = stored(
        rows.select("page_id", "digest", F.octet_length("payload").cast("long").alias("n")),
        "warc-pages",
    )
    begins = page_shards(slim, shard_bytes)
    nothing = F.lit(None)
    full = rows.select("*", nothing.cast("long").alias("refers_to"), F.lit(1).alias("is_page"))
    marks = revisits(slim).select(
        "page_id",
        nothing.cast("string").alias("url"),
        nothing.cast("binary").alias("payload"),
        "digest",
        "refers_to",
        F.lit(0).alias("is_page"),
    )
    ranged = (
        full.unionByName(marks)
        .withColumn("shard", _shard(begins)("page_id", "digest"))
        .repartitionById(max(len(begins), 1), "shard")
        .sortWithinPartitions("shard", F.asc_nulls_last("page_id"), "digest", "is_page")
    )
    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path)
    files = stored(ranged.mapInArrow(_writer(folder, file_bytes), _FILE), "warc-files")
    renamed = files.repartition(max(files.count(), 1), "name").mapInArrow(_renamer(folder), _FILE)
    renamed.drop("temporary").write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    schema = "name string, records long, bytes long, sha256 string"
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def members(stream) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, one at a time."""
    rest, member, parts = b"", zlib.decompressobj(31), []
    while True:
        data = rest or stream.read(1 << 16)
        rest = b""
        if not data:
            break
        parts.append(member.decompress(data))
        if member.eof:
            yield b"".join(parts)
            rest, member, parts = member.unused_data, zlib.decompressobj(31), []
    if parts:
        raise ValueError("archive ends within a record")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def _page_of(fields: dict[str, str], block: bytes) -> list | None:
    """The record's row, its digests checked; None for records that are no pages."""
    if fields["WARC-Block-Digest"] != f"sha256:{_sha256(block)}":
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload), _sha256(payload)) != (size, digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']}")
    page, refers_to = fields.get("X-Page"), fields.get("X-Refers-To-Page")
    return [
        None if page is None else int(page),
        size,
        digest,
        fields["WARC-Type"],
        None if refers_to is None else int(refers_to),
    ]


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """A row per page record of the archives that the manifest names."""
    manifest = read_manifest(spark, folder).select("name", "records")
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.to_pylist():
                with where.open_input_stream(f"{path}/{file['name']}", compression=None) as stream:
                    rows = [_page_of(*parse_record(data)) for data in members(stream)]
                rows = [row for row in rows if row]
                if len(rows) != file["records"]:
                    raise ValueError(f"{file['name']}: {len(rows)} records, not {file['records']}")
                yield _rows(rows, schema)

    files = manifest.repartition(max(manifest.count(), 1), "name")
    return files.mapInArrow(parsed, _RECORD)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages and read the archives back."""
    folder = work_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder)
