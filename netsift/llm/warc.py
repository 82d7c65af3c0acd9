"""WARC archives written and read as a chunked record table.

A payload travels as rows of (record, chunk number, bytes): Spark cuts it into chunks, writer tasks stream the
chunks of one record after another into gzip members, reader tasks stream them back.  Every chunk row carries
the SHA-256 of the payload up to its end, so the last one carries the payload's digest.  The scan holds the payload of the row it
reads, as any reader of a string column does; nothing behind it holds more than a chunk a row, nor an Arrow batch more than
``BATCH_BYTES``.  Of records with equal payloads of at least ``least`` bytes that with the smallest page_id is
a response and the others revisit it.

Files get a name per task attempt, and the committed table of files says which count.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.scratch import folder, written

CHUNK = 1 << 18
BATCH_BYTES = 8 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"


def records(pages: DataFrame, least: int = 100, chunk: int = CHUNK) -> DataFrame:
    """page_id, url, size, digest, refers_to, chunk_no, last, data: the chunks of one record in order, side by side.

    Null html counts as empty.  Rows without a page_id are responses.  Of rows with equal payloads those with the smallest
    page_id are responses, repeated ids included; each input row is a record of its own, in the order of page_id.
    A revisit has one row and no data.  Other columns are ignored, an empty table has no records.

    Chunks are cut one by one from numbers, so no row after the scan holds more of a payload than a chunk.  Who revisits
    whom is worked out on ids and digests alone and joined to the chunks.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    light = rows.select("page_id", "size", "digest").where((F.col("size") >= least) & F.col("page_id").isNotNull())
    firsts = light.groupBy("digest", "size").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    again = light.join(firsts, ["digest", "size"]).where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()
    count = F.greatest(F.ceil(F.col("size") / chunk), F.lit(1)).cast("int")
    cut = (rows.withColumn("rid", F.monotonically_increasing_id()).withColumn("chunks", count)
           .select("rid", "page_id", "url", "size", "digest", "chunks", "payload", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk_no"))
           .withColumn("data", F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk))).drop("payload"))
    named = cut.where("page_id is not null").join(again, ["page_id", "digest"], "left")
    loose = cut.where("page_id is null").withColumn("refers_to", F.lit(None).cast(pages.schema["page_id"].dataType))
    second = F.col("refers_to").isNotNull()
    every = named.unionByName(loose).where(~second | (F.col("chunk_no") == 0))
    return (every.withColumn("data", F.when(second, F.lit(b"")).otherwise(F.col("data")))
            .withColumn("last", second | (F.col("chunk_no") == F.col("chunks") - 1))
            .sortWithinPartitions("page_id", "rid", "chunk_no")
            .select("page_id", "url", "size", "digest", "refers_to", "chunk_no", "data", "last"))


def _head(page_id, url, size: int, digest: str, refers_to) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
             f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    length = len(HTTP) + (size if refers_to is None else 0)
    return ("\r\n".join([*lines, f"Content-Length: {length}"]) + "\r\n\r\n").encode()


def write(chunks: DataFrame, roll: int = 128 << 20, level: int = 1) -> DataFrame:
    """Write the records; returns the committed table of files: root, path, records.

    Arrow batches hold at most ``BATCH_BYTES`` of chunks.
    """
    spark = chunks.sparkSession
    target = folder(spark, "warc")

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(target)
        store.create_dir(root)
        attempt, number, out, path, count, at, packer = uuid.uuid4().hex, 0, None, "", 0, 0, None
        for b in batches:
            for row in zip(*(b.column(k) for k in range(b.num_columns))):
                page_id, url, size, digest, refers_to, chunk_no, data, last = (x.as_py() for x in row)
                if chunk_no == 0:
                    if out is None:
                        path = f"{root}/part-{attempt}-{number:05d}.warc.gz"
                        out, count, at = store.open_output_stream(path, compression=None), 0, 0
                    packer, own = zlib.compressobj(level, zlib.DEFLATED, 31), hashlib.sha256()
                    at += out.write(packer.compress(_head(page_id, url, size, digest, refers_to) + HTTP)) or 0
                own.update(data)
                if refers_to is None:
                    at += out.write(packer.compress(data)) or 0
                if last:
                    if refers_to is None and own.hexdigest() != digest:
                        raise ValueError(f"payload of record {page_id} changed on its way")
                    at += out.write(packer.compress(b"\r\n\r\n") + packer.flush()) or 0
                    count += 1
                    if at >= roll:
                        out.close()
                        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count])], ["path", "records"])
                        out, number = None, number + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count])], ["path", "records"])

    streamed = chunks.select("page_id", "url", "size", "digest", "refers_to", "chunk_no", "data", "last").mapInArrow(
        run, "path string, records long").withColumn("root", F.lit(target))
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(max(1, BATCH_BYTES // CHUNK)))
    try:
        return written(streamed, "files")
    finally:
        spark.conf.set(limit, before)


class _Inflated:
    """Bytes of a file of gzip members, read forward in blocks."""

    def __init__(self, source, block: int = CHUNK):
        self.source, self.block, self.buffer = source, block, b""
        self.unpack, self.rest, self.done = zlib.decompressobj(31), b"", False

    def fill(self) -> bool:
        while not self.done:
            if self.unpack.eof:
                self.rest, self.unpack = self.unpack.unused_data, zlib.decompressobj(31)
            raw = self.rest or self.unpack.unconsumed_tail or self.source.read(self.block)
            self.rest = b""
            if not raw:
                self.done = True
                return False
            got = self.unpack.decompress(raw, self.block)
            if got:
                self.buffer += got
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        while mark not in self.buffer:
            if not self.fill():
                return b""
        head, self.buffer = self.buffer.split(mark, 1)
        return head

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.fill():
            pass
        got, self.buffer = self.buffer[:n], self.buffer[n:]
        return got


def read(files: DataFrame, data: bool = True, chunk: int = CHUNK, page_id: str = "bigint") -> DataFrame:
    """page_id, record_type, refers_to, size, digest, chunk_no, last (and data): the chunk table of the archives.

    ``digest`` is the SHA-256 of the payload up to the chunk's end; a revisit has one row, with the digest and size
    of the payload it refers to.  Raises ValueError where a payload does not match its header.
    """
    fields = f"page_id {page_id}, record_type string, refers_to {page_id}, size long, digest string, chunk_no int, last boolean"

    def run(batches):
        from pyarrow import fs

        def flush(rows):
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.binary()]
            names = ["page_id", "record_type", "refers_to", "size", "digest", "chunk_no", "last", "data"]
            n = 8 if data else 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], kinds)], names[:n])

        def number(text):
            found = text.removeprefix(f"<{URN}").removesuffix(">")
            return int(found) if found else None

        for b in batches:
            for path, root in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, _ = fs.FileSystem.from_uri(root)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as f:
                    text = _Inflated(f)
                    while head := text.until(b"\r\n\r\n"):
                        at = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
                        kind, left = at["WARC-Type"], int(at["Content-Length"])
                        left -= len(text.until(b"\r\n\r\n")) + 4
                        size, want = int(at["WARC-Payload-Length"]), at["WARC-Payload-Digest"].removeprefix("sha256:")
                        page, first = number(at["WARC-Record-ID"]), at.get("WARC-Refers-To")
                        if kind == "revisit":
                            rows.append((page, kind, number(first), size, want, 0, True, b""))
                        else:
                            own = hashlib.sha256()
                            for k in range(max(1, -(-left // chunk))):
                                piece = text.take(min(chunk, left))
                                left -= len(piece)
                                own.update(piece)
                                rows.append((page, kind, None, size, own.hexdigest(), k, not left, piece))
                                held += len(piece)
                                if held >= 8 << 20 or len(rows) >= 5000:
                                    yield flush(rows)
                                    rows, held = [], 0
                            if own.hexdigest() != want:
                                raise ValueError(f"record {page} in {path} does not match its digest")
                        text.take(4)
                if rows:
                    yield flush(rows)

    spread = max(2, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.select("path", "root").repartition(spread, "path").mapInArrow(run, fields + (", data binary" if data else ""))


def payloads(files: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: one row per record, from the archives."""
    return read(files, data=False).where("last").select(
        "page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
