"""Deterministic sharded WARC writer and reader.

Records are put in the order of their keys and cut into shards of about
``shard_bytes`` of payload, the edges taken from exact running sums over the whole
order; within a shard, files are rolled by compressed size.  The files therefore
depend on the records alone, not on partitions, retries or the cluster.  Each
record is a gzip member of its own, compressed before it is shuffled to its
shard.  A file is written under a temporary name, renamed when complete, and
listed in a manifest table; the reader opens only what the manifest lists, so
that leftovers of lost tasks are never read.  Headers and digests are
regenerated from the payloads.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.llm.common import shared, shuffle_partitions, staged

# fixed values of the WARC 1.1 format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LENGTH_FIELD = "X-Payload-Length"  # extension field: a revisit holds no payload
KEY_FIELD = "X-Record-Key"


def _clean(value: str) -> str:
    """A header value on one line: control characters percent-encoded."""
    return "".join(c if " " <= c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = [f"{k}: {_clean(str(v))}".encode("utf-8", "surrogatepass") for k, v in fields if v is not None]
    return VERSION + b"\r\n" + b"\r\n".join(lines) + b"\r\n\r\n"


def _record_id(key: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{key}/{digest}')}>"


def _http(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)


def _member(data: bytes, level: int) -> bytes:
    """One gzip member without a time stamp."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _b32(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def build_record(key, url: str | None, payload: bytes, refers_to, date: str, level: int) -> bytes:
    """A compressed response record, or a revisit of the record with key
    ``refers_to`` (no payload, the same digest)."""
    digest = hashlib.sha1(payload).hexdigest()
    revisit = refers_to is not None
    block = _http(payload) + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(key, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _b32(digest)),
        ("WARC-Block-Digest", _b32(hashlib.sha1(block).hexdigest())),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", _record_id(refers_to, digest) if revisit else None),
        ("X-Refers-To-Key", refers_to),
        (KEY_FIELD, key),
        (LENGTH_FIELD, len(payload)),
        ("Content-Length", len(block)),
    ]
    return _member(_header(fields) + block + b"\r\n\r\n", level)


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit_bytes: int) -> DataFrame:
    """(key, tie, url, payload, refers_to): tie orders records of one key; of equal payloads of at least
    ``min_revisit_bytes`` the one with the largest key is the response, the others
    revisit it."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("key"), F.xxhash64(F.col(url_col), payload).alias("tie"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.when(F.octet_length(payload) >= min_revisit_bytes, F.sha2(payload.cast("binary"), 256)).alias("same"),
    )
    # only payloads that occur again are joined, by digest
    again = rows.filter("same is not null").groupBy("same").agg(F.max("key").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # records without a digest are dealt by themselves: no task gets all of them
    own = F.coalesce("same", F.concat(F.lit("-"), F.xxhash64("key", "tie").cast("string")))
    joined = rows.withColumn("same", own).join(staged(again.select("same", "last"), "repeats"), "same", "left")
    refers = F.when(~F.col("key").eqNullSafe(F.col("last")), F.col("last"))
    return joined.select("key", "tie", "url", "payload", refers.alias("refers_to"))


def _shard_edges(pages: DataFrame, id_col: str, url_col: str, payload_col: str, shard_bytes: int, max_shards: int) -> list[tuple]:
    """First (key, tie) of every shard, from running sums over the sorted keys;
    at most ``max_shards`` of them (shards grow beyond that)."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("key"), F.xxhash64(F.col(url_col), payload).alias("tie"), (F.octet_length(payload) + 500).cast("long").alias("bytes"))
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "key", "tie").withColumn("part", F.spark_partition_id())
    ordered = staged(ordered, "warc-order")
    sizes = ordered.groupBy("part").agg(F.sum("bytes").alias("n")).collect()  # a number per partition
    starts, at = [], 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        starts.append((r["part"], at))
        at += r["n"]
    size = max(shard_bytes, -(-at // max_shards))
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType())])
    shift = F.broadcast(spark.createDataFrame(starts, schema))  # as many rows as partitions
    before = F.expr("sum(bytes) over (partition by part order by key, tie) - bytes")  # equal rows together
    dealt = ordered.join(shift, "part").withColumn("shard", F.floor((F.col("start") + before) / F.lit(size)))
    edges = dealt.groupBy("shard").agg(F.min(F.struct("key", "tie")).alias("first")).collect()
    return sorted(_order(r["first"]["key"], r["first"]["tie"]) for r in edges)


def _order(key, tie: int) -> tuple:
    """Sorts like Spark does: nulls first."""
    return (0, 0, tie) if key is None else (1, key, tie)


def _build(date: str, level: int, opened):
    def run(batches):
        edges = opened()
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            shard = [max(0, bisect.bisect_right(edges, _order(k, t)) - 1) for k, t in zip(cols[0], cols[1])]
            data = [build_record(k, u, p.encode("utf-8", "surrogatepass"), r, date, level) for k, _, u, p, r in zip(*cols)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), b.column(0), b.column(1), pa.array(data, pa.binary())], names=["shard", "key", "tie", "data"])

    return run


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _warcinfo(name: str, date: str, level: int) -> bytes:
    body = b"software: crease\r\nformat: WARC File Format 1.1\r\n"
    fields = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", _record_id(name, "warcinfo")),
        ("WARC-Date", date),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
        ("Content-Length", len(body)),
    ]
    return _member(_header(fields) + body + b"\r\n\r\n", level)


class _File:
    """One archive file: written under a temporary name, renamed when complete."""

    def __init__(self, folder: str, name: str, date: str, level: int):
        self.fs, root = _store(folder)
        self.name = name
        self.final, self.temporary = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.fs.create_dir(root, recursive=True)
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.sha, self.size, self.records = hashlib.sha1(), 0, 0
        self._put(_warcinfo(self.name, date, level))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._put(data)
        self.records += 1

    def commit(self) -> dict:
        self.out.close()
        self.fs.move(self.temporary, self.final)  # a repeated task puts the same bytes there
        return {"file": self.name, "records": self.records, "bytes": self.size, "sha1": self.sha.hexdigest()}


def _write_files(folder: str, file_bytes: int, date: str, level: int):
    """Rows (shard, data) sorted by shard and key: one manifest row per file."""

    def run(batches):
        out, shard, number, done = None, None, 0, []
        for b in batches:
            for n, data in zip(b.column("shard").to_pylist(), b.column("data")):
                if out and (n != shard or out.size >= file_bytes):
                    done.append(out.commit())
                    out = None
                if out is None:
                    number = number + 1 if n == shard else 0
                    out, shard = _File(folder, f"part-{n:06d}-{number:04d}.warc.gz", date, level), n
                out.add(data.as_py())
        if out:
            done.append(out.commit())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())]))

    return run


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    shard_bytes: int = 64 << 20,
    file_bytes: int = 32 << 20,
    max_shards: int = 200_000,
    min_revisit_bytes: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
    level: int = 6,
) -> DataFrame:
    """Write a record per row of ``pages`` to ``folder`` and return the manifest
    (file, records, bytes, sha1), itself a table under ``folder``/manifest.

    A null payload is empty, a null url leaves out the target, a null key writes
    no key.  Rows with the same key and payload as the response are responses as
    well (a record does not revisit itself).  Texts of any length are one
    record.  An empty table writes no file and an empty manifest.  Keys may be
    of any type that sorts; other columns are not read.
    """
    spark = pages.sparkSession
    # bounded: max_shards edges
    edges = _shard_edges(pages, id_col, url_col, payload_col, shard_bytes, max_shards)
    opened = shared(spark, edges)
    records = plan_records(pages, id_col, url_col, payload_col, min_revisit_bytes)
    key = pages.schema[id_col].dataType.simpleString()
    built = records.select("key", "tie", "url", "payload", "refers_to").mapInArrow(_build(date, level, opened), f"shard int, key {key}, tie long, data binary")
    # a task for each shard, however many there are
    dealt = built.repartitionById(max(1, len(edges)), "shard").sortWithinPartitions("shard", "key", "tie")
    manifest = dealt.select("shard", "data").mapInArrow(_write_files(folder, file_bytes, date, level), "file string, records long, bytes long, sha1 string")
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("file string, records long, bytes long, sha1 string").parquet(f"{folder}/manifest")


FILES_PER_TASK = 4  # that a task reads, where there are many


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    d, out, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(chunk)
        rest = b""
        if not data:
            break
        out.append(d.decompress(data))
        if d.eof:
            yield b"".join(out)
            rest, d, out = d.unused_data, zlib.decompressobj(31), []
    if out:
        raise ValueError("the archive ends inside a record")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _read_files(folder: str):
    def run(batches):
        schema = pa.schema([(n, pa.string()) for n in ("key", "url", "record_type", "refers_to", "payload_digest")] + [("payload_bytes", pa.int64()), ("payload", pa.binary()), ("intact", pa.bool_())])
        for b in batches:
            fs, root = _store(folder)
            for name, sha1 in zip(b.column("file").to_pylist(), b.column("sha1").to_pylist()):
                rows = []
                with fs.open_input_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20) as raw:
                    for data in members(io.BufferedReader(raw, 1 << 20)):
                        f, block = parse_record(data)
                        if f["WARC-Type"] == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2] if f["WARC-Type"] == "response" else None
                        digest = base64.b32decode(f["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        intact = _b32(hashlib.sha1(block).hexdigest()) == f["WARC-Block-Digest"]
                        size = int(f[LENGTH_FIELD])
                        if payload is not None:  # both are taken from the payload itself
                            read = hashlib.sha1(payload).hexdigest()
                            intact = intact and read == digest and len(payload) == size
                            digest, size = read, len(payload)
                        rows.append((f.get(KEY_FIELD), f.get("WARC-Target-URI"), f["WARC-Type"], f.get("X-Refers-To-Key"), digest, size, payload, intact))
                        if len(rows) == 256:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return run


def read_warc(spark: SparkSession, folder: str, key_type: str = "bigint") -> DataFrame:
    """The records of the files that the manifest lists: key, url, record_type,
    refers_to, payload_bytes, payload_digest, payload (null for a revisit) and
    intact (block and payload agree with their digests)."""
    files = read_manifest(spark, folder).select("file", "sha1")
    files = files.repartition(max(shuffle_partitions(spark), -(-files.count() // FILES_PER_TASK)), "file")
    out = files.mapInArrow(
        _read_files(folder),
        "key string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary, intact boolean",
    )
    return out.withColumn("key", F.col("key").cast(key_type)).withColumn("refers_to", F.col("refers_to").cast(key_type))
