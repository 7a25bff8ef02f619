"""Web archives: a deterministic sharded writer, and a reader.

Records are sorted by key in ranges, a task writes one range as a series of
files that roll by compressed size, and every header and digest is made anew.
Files are written under temporary names. Only when all tasks have ended are
those of the successful attempts renamed, and the manifest appears last, so a
reader never sees half of an archive, however often tasks were run. The same
rows give the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import Stored, delete, integer_cuts, range_of

C = F.col
ROLL_BYTES = 256 << 20  # compressed, of one file
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 6
CHUNK = 1 << 20
ENTRY = "shard int, part int, temporary string, name string, records long, bytes long, sha256 string"
RECORD = "url string, record_type string, refers_to {kind}, payload_bytes long, payload_digest string, payload binary"


def write(
    spark: SparkSession,
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    shards: int | None = None,
    least: int = 0,
    roll_bytes: int = ROLL_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write a record per row to a new folder; returns the manifest, a row per file.

    Of rows with equal payloads of at least ``least`` bytes those with the
    largest integer key are responses with the payload, the others revisits that
    refer to it; smaller payloads are all responses. Several rows with that
    largest key and payload are all responses. A null payload counts as empty, a
    null key comes first and is a response only if no row of its payload has a
    key. An empty table gives a manifest without files. Other columns are not
    read. ``shards`` ranges of about equal bytes, by default as many as the root
    of the size in MiB; their limits depend on the rows alone.
    """
    store = Stored(spark, "warc")
    content = F.coalesce(C(payload), F.lit("")).cast("binary")
    rows = pages.select(C(key).cast("long").alias("key"), C(url).cast("string").alias("url"), content.alias("payload"))
    narrow = store.put(rows.select("key", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size")))
    # the response of each payload that occurs again; minima and maxima are combined before the shuffle
    same = narrow.where(C("size") >= least).groupBy("sha1").agg(F.max("key").alias("refers"), F.count("*").alias("n"))
    repeated = same.where("n > 1 AND refers IS NOT NULL").select("sha1", "refers")
    revisits = narrow.join(repeated, "sha1").where("key IS NULL OR key < refers").select("key", "sha1", "refers").distinct()

    if shards is None:
        total = narrow.agg(F.sum("size")).first()[0] or 0
        shards = max(1, round((total / (1 << 20)) ** 0.5))
    cuts = integer_cuts(narrow, "key", C("size") + 1024, shards)
    place = range_of(C("key"), cuts).alias("shard")
    # a range's revisits come in before its rows, so that payloads are shuffled once
    notes = revisits.select(place, "key", F.lit(0).alias("turn"), "sha1", "refers", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    full = rows.select(place, "key", F.lit(1).alias("turn"), F.sha1("payload").alias("sha1"), F.lit(None).cast("long").alias("refers"), "url", "payload")
    dealt = notes.unionByName(full).repartitionById(len(cuts) + 1, C("shard")).sortWithinPartitions("shard", "key", "turn", "sha1", "url")
    staged = store.put(dealt.mapInArrow(writer(folder, roll_bytes, date), ENTRY))
    manifest = commit(spark, staged, folder)
    store.drop(narrow, staged)
    return manifest


def commit(spark: SparkSession, staged: DataFrame, folder: str) -> DataFrame:
    """Give the files their names, then the manifest; files of attempts that failed go."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    files = path("").getFileSystem(conf)

    def renamed(temporary: str, name: str) -> None:
        if not files.rename(path(temporary), path(name)):
            raise OSError(f"could not rename {temporary} to {name} in {folder}")

    for entry in staged.toLocalIterator():
        if not files.exists(path(entry.name)):
            renamed(entry.temporary, entry.name)
    staged.drop("temporary").write.mode("overwrite").parquet(f"{folder}/_manifest.tmp")
    renamed("_manifest.tmp", "_manifest")
    delete(spark, f"{folder}/_tmp")
    return manifest_of(spark, folder)


def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ENTRY.replace("temporary string, ", "")).parquet(f"{folder}/_manifest")


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: int | None, sha1: str, again: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}:{sha1}:{again}')}>"


def shown(url: str | None) -> str:
    """A target for the header: no white space or control characters, not empty."""
    text = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    return text or "urn:none"


def block_of(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)


def member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    fields += [("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


class Roll:
    """The files of one shard; each begins with a description of itself."""

    def __init__(self, folder: str, shard: int, most: int, date: str):
        self.files, self.root = opened(folder)
        self.shard, self.most, self.date, self.part, self.out = shard, most, date, 0, None
        self.done: list[tuple] = []

    def add(self, data: bytes) -> None:
        if self.out is not None and self.bytes + len(data) > self.most:
            self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.part:06d}.warc.gz"
            self.temporary = f"_tmp/{uuid.uuid4().hex}-{self.name}"
            self.files.create_dir(f"{self.root}/_tmp", recursive=True)
            self.out = self.files.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.bytes, self.records, self.sum = 0, 0, hashlib.sha256()
            about = b"software: colloquy\r\nformat: WARC File Format 1.1\r\n"
            named = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name, 0)), ("WARC-Date", self.date),
                     ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self.put(member(named, about))
        self.put(data)
        self.records += 1

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.sum.update(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.part, self.temporary, self.name, self.records, self.bytes, self.sum.hexdigest()))
            self.part, self.out = self.part + 1, None


def writer(folder: str, most: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, at, refers, again = None, None, {}, {}
        done: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "key", "turn", "sha1", "refers", "url", "payload")]
            for values in zip(*columns):
                shard, key, turn, sha1, target, url, payload = (v.as_py() for v in values)
                if roll is None or roll.shard != shard:
                    if roll is not None:
                        roll.close()
                        done += roll.done
                    roll, at = Roll(folder, shard, most, date), None
                if at is None or at != (key,):
                    at, refers, again = (key,), {}, {}
                if turn == 0:
                    refers[sha1] = target
                    continue
                again[sha1] = again.get(sha1, -1) + 1
                roll.add(record(key, sha1, again[sha1], url, payload, refers.get(sha1), sha1 in refers, date))
        if roll is not None:
            roll.close()
            done += roll.done
        if done:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            names = [f.split()[0] for f in ENTRY.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    return run


def record(key, sha1: str, again: int, url: str | None, payload: bytes, target, revisit: bool, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(key, sha1, again)),
        ("WARC-Date", date),
        ("WARC-Target-URI", shown(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Row-Key", "" if key is None else str(key)),
        ("Row-Payload-Length", str(len(payload))),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(target, sha1, 0)), ("Row-Refers-To", str(target))]
    return member(fields, block_of(payload) + (b"" if revisit else payload))


def read(spark: SparkSession, folder: str, key: str = "page_id") -> DataFrame:
    """All records of an archive: ``key`` and the columns of ``RECORD``; the payload of a revisit is null.

    Reads the files that the manifest names, each as a stream in one task, and
    fails if a record's digests do not fit its content.
    """
    manifest = manifest_of(spark, folder)
    count = max(1, manifest.count())
    named = manifest.select("name").repartition(count, "name")
    return named.mapInArrow(reader(folder, key), f"{key} long, {RECORD.format(kind='long')}")


AT_ONCE = 8 << 20


def reader(folder: str, key: str):
    names = [key, *[f.split()[0] for f in RECORD.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        files, root = opened(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for data in members(source):
                        row = parsed(data)
                        if row is not None:
                            rows.append(row)
                            size += len(data)
                        if size > AT_ONCE:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def members(source) -> Iterator[bytes]:
    """The gzip members of a stream, unpacked."""
    rest = b""
    unpacker, parts = zlib.decompressobj(31), []
    while True:
        data = rest or source.read(CHUNK)
        if not data:
            break
        parts.append(unpacker.decompress(data))
        rest = b""
        if unpacker.eof:
            rest = unpacker.unused_data
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []


def parsed(data: bytes) -> tuple | None:
    """A response or revisit as a row; other records are passed over."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"record {fields['WARC-Record-ID']} does not fit its block digest")
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if base32_sha1(payload) != digest:
            raise ValueError(f"record {fields['WARC-Record-ID']} does not fit its payload digest")
    number = lambda name: int(fields[name]) if fields.get(name) else None
    return (
        number("Row-Key"), fields["WARC-Target-URI"], fields["WARC-Type"], number("Row-Refers-To"),
        number("Row-Payload-Length"), digest, payload,
    )
