"""WARC: archives of pages as a table of chunks, written and read as streams."""

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh_path, stored

CHUNK = 1 << 20
FILE = 128 << 20
#: Keys that each digest is dealt over when its pages look up the one they revisit.
SALTS = 16
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"

MANIFEST = "file string, n_records long, n_bytes long"
CHUNKS = (
    "file string, record_id string, record_type string, refers_to string, url string, declared_digest string, "
    "chunk_no long, chunk binary, bytes_so_far long, digest_so_far string, last boolean"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _opened(path: str):
    """The file system of a path and the path in it; local paths may come without a scheme."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


def records(pages: DataFrame, least_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The rows to write: one per chunk of a response, one for a revisit.

    Of pages with equal payloads of ``least_bytes`` or more the one with the largest page_id is the
    response and the others revisit it. A page without an id, and rows alike in id and payload, are
    responses each. Null html is an empty payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    plain = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumns(
        {"length": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")}
    )
    first = (
        plain.where((F.col("length") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest", "length")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    revisits = F.col("page_id") != F.col("keeper")
    # Digests without payloads meet under SALTS keys each; payloads are dealt by page.
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    ids = plain.where("page_id is not null").select("page_id", "digest", "length", salt.alias("salt"))
    spread = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = ids.join(spread, ["digest", "length", "salt"]).where(revisits).select("page_id", "digest", "length", F.col("keeper").alias("refers_to")).distinct()
    named, unnamed = plain.where("page_id is not null"), plain.where("page_id is null")
    told = named.join(known, ["page_id", "digest", "length"], "left").unionByName(
        unnamed.withColumn("refers_to", F.lit(None).cast(named.schema["page_id"].dataType))
    )
    held = F.when(F.col("refers_to").isNull(), F.col("length")).otherwise(0)
    return told.select(
        "page_id", "url", "refers_to", "length", "digest", "payload",
        F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(held / chunk), F.lit(1).cast("long")) - 1)).alias("chunk_no"),
    ).select(
        "page_id", "url", "refers_to", "length", "digest", "chunk_no",
        F.when(F.col("refers_to").isNull(), F.substring("payload", (F.col("chunk_no") * chunk + 1).cast("int"), F.lit(chunk))).alias("chunk"),
    )


def _head(page_id, url, refers_to, length, digest) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (length if refers_to is None else 0)}",
    ]
    if url is not None:
        lines.insert(3, "WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {REVISIT}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _opened(folder)
        fs.create_dir(base, recursive=True)
        out, name, size, count, sha, packer, left = None, "", 0, 0, None, None, 0
        done = []
        for batch in batches:
            for r in range(batch.num_rows):
                row = {k: batch.column(k)[r].as_py() for k in ("page_id", "url", "refers_to", "length", "digest", "chunk_no")}
                if row["chunk_no"] == 0:
                    if left:
                        raise ValueError("a record ended before its last chunk")
                    if out is None:
                        # A name of its own for every attempt: a task that runs again leaves files that no manifest names.
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, size, count = fs.open_output_stream(os.path.join(base, name), compression=None), 0, 0
                    sha, packer = hashlib.sha1(), zlib.compressobj(3, zlib.DEFLATED, 31)
                    left = row["length"] if row["refers_to"] is None else 0
                    head = _head(row["page_id"], row["url"], row["refers_to"], row["length"], base32(bytes.fromhex(row["digest"])))
                    size += out.write(packer.compress(head)) or 0
                chunk = batch.column("chunk")[r].as_buffer()
                if chunk is not None and chunk.size:
                    sha.update(chunk)
                    left -= chunk.size
                    out.write(packer.compress(chunk))
                if left == 0:
                    if row["refers_to"] is None and sha.hexdigest() != row["digest"]:
                        raise ValueError(f"chunks of page {row['page_id']} are out of order")
                    out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    count += 1
                    if (size := out.tell()) >= FILE:
                        out.close()
                        done.append((name, count, size))
                        out = None
        if left:
            raise ValueError("a record ended before its last chunk")
        if out is not None:
            size = out.tell()
            out.close()
            done.append((name, count, size))
        if done:
            yield pa.RecordBatch.from_pydict({"file": [os.path.join(folder, d[0]) for d in done], "n_records": [d[1] for d in done], "n_bytes": [d[2] for d in done]})

    return write


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Write a record per page below ``folder``; the manifest (file, n_records, n_bytes) of what was written.

    Every record is a gzip member of its own; a file is closed at 128 MB. A chunk at a time is
    compressed and its digest added up. Only files of the manifest count.
    """
    folder = folder or fresh_path(pages.sparkSession, "warc")
    return stored(records(pages, least_bytes, chunk).mapInArrow(_writer(folder), MANIFEST), "manifest")


class _Members:
    """The bytes of consecutive gzip members, as they are asked for."""

    def __init__(self, stream):
        self.stream, self.unpack, self.rest, self.held = stream, zlib.decompressobj(31), b"", bytearray()

    def more(self) -> bool:
        while True:
            if self.unpack.eof:
                self.rest, self.unpack = self.unpack.unused_data or self.rest, zlib.decompressobj(31)
            data = self.rest or self.stream.read(1 << 16)
            if not data:
                return False
            got = self.unpack.decompress(data, 1 << 18)
            self.rest = self.unpack.unconsumed_tail or (b"" if not self.unpack.eof else self.unpack.unused_data)
            if got:
                self.held += got
                return True

    def head(self) -> bytes | None:
        while (at := self.held.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.held.strip():
                    raise ValueError("an archive ends within a record")
                return None
        out = bytes(self.held[: at + 4])
        del self.held[: at + 4]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("an archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:] if line)}


def _reader(chunk: int, with_data: bool):
    columns = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[c.split()[1]]) for c in CHUNKS.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                fs, path = _opened(file)
                out, held = {c: [] for c in columns}, 0
                with fs.open_input_stream(path, compression=None) as stream:
                    members = _Members(stream)
                    while (head := members.head()) is not None:
                        about = _fields(head)
                        http = members.head()
                        size = int(about["content-length"]) - len(http)
                        sha, so_far, number = hashlib.sha1(), 0, 0
                        while True:
                            data = members.take(min(chunk, size - so_far))
                            sha.update(data)
                            so_far += len(data)
                            row = (file, about["warc-record-id"].strip("<>").removeprefix(ID), about["warc-type"], (about.get("warc-refers-to") or "").strip("<>").removeprefix(ID) or None,
                                   about.get("warc-target-uri"), about["warc-payload-digest"].removeprefix("sha1:"), number, data if with_data else None, so_far, base32(sha.digest()), so_far == size)
                            for c, v in zip(columns, row, strict=True):
                                out[c].append(v)
                            held += len(data) if with_data else 0
                            number += 1
                            if held >= 8 * chunk or len(out["file"]) >= 5000:
                                yield pa.RecordBatch.from_pydict(out, kinds)
                                out, held = {c: [] for c in columns}, 0
                            if so_far == size:
                                break
                        if members.take(4) != b"\r\n\r\n":
                            raise ValueError(f"a record of {file} has no end")
                if out["file"]:
                    yield pa.RecordBatch.from_pydict(out, kinds)

    return read


def read_chunks(manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk table of all archives of a manifest: a row per chunk, with the digest of the payload so far.

    ``digest_so_far`` of the row marked ``last`` is that of the whole payload. No more than a few chunks are
    in memory. Without ``with_data`` the column chunk is null; everything is read and digested all the same.
    """
    files = manifest.select("file")
    return files.repartition(max(1, files.count())).mapInArrow(_reader(chunk, with_data), CHUNKS)


def read_pages(chunks: DataFrame) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type, refers_to; revisits get the size of their response.

    A response whose payload doesn't have the digest its record declares is damaged: that is an error.
    """
    ends = chunks.where("last").select(
        F.expr("try_cast(record_id as bigint)").alias("page_id"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
        "declared_digest",
        "bytes_so_far",
        "digest_so_far",
    )
    ends = stored(ends, "records")
    payloads = (
        ends.where("record_type = 'response' and page_id is not null")
        .groupBy(F.col("page_id").alias("refers_to"), F.col("digest_so_far").alias("declared_digest"))
        .agg(F.max("bytes_so_far").alias("held_bytes"))
    )
    damaged = F.raise_error(F.concat(F.lit("the payload of a record is not that of its digest: page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    digest = F.when(F.col("digest_so_far") == F.col("declared_digest"), F.col("digest_so_far")).otherwise(damaged)
    responses = ends.where("record_type = 'response'").select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to"
    )
    revisits = (
        ends.where("record_type = 'revisit'")
        .join(payloads, ["refers_to", "declared_digest"], "left")
        .select("page_id", F.col("held_bytes").alias("payload_bytes"), F.col("declared_digest").alias("payload_digest"), "record_type", "refers_to")
    )
    return responses.unionByName(revisits)
