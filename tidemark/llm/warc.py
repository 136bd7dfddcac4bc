"""WARC archives as a chunked record table.

A payload travels as rows of record identifier and chunk number, in order;
writer and reader hold one chunk at a time and carry the digest along, so no
Python task ever allocates a whole record.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import new_path
from tidemark.llm.record_files import filesystem

#: Payload bytes of a chunk row.
CHUNK_BYTES = 256 << 10
#: Smaller equal payloads are stored each.
REVISIT_BYTES = 1000
READ_BYTES = 1 << 20
RECORD_ID = "urn:page:"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, body_key, refers_to`` of the pages whose payload another page stores.

    Of equal payloads of at least ``least`` bytes the largest ``page_id`` stores
    it. A group counts its maximum before any shuffle, so a payload of a third
    of all rows costs one row a task; its rows then join with that one row,
    which adaptive execution may split.
    """
    slim = pages.where(F.length("payload") >= least).select("page_id", "body_key")
    stored = slim.groupBy("body_key").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    return slim.join(stored.select("body_key", "refers_to"), "body_key").where("not (page_id <=> refers_to)").distinct()


def chunk_rows(pages: DataFrame, least: int = REVISIT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Record table to write: ``page_id, url, refers_to, total, sha1, chunk_no, chunk``, chunks of a record in order.

    ``pages`` has ``page_id, url, html``. A null html is an empty payload; a
    null ``page_id`` is kept, and revisits where a numbered page stores its
    payload; rows that repeat the storing page store it again.
    """
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", body.alias("payload")).withColumn("body_key", F.sha2("payload", 256))
    again = revisits(rows, least).select(F.col("page_id").alias("v_id"), F.col("body_key").alias("v_key"), "refers_to")
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("v_id")) & (F.col("body_key") == F.col("v_key")), "left")
    total = F.length("payload")
    stored = F.when(F.col("refers_to").isNull(), total).otherwise(0)
    last = F.greatest(F.ceil(stored / chunk_bytes) - 1, F.lit(0)).cast("int")
    rows = rows.select("page_id", "url", "refers_to", total.cast("bigint").alias("total"), F.sha1("payload").alias("sha1"), "payload", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    chunk = F.when(F.col("refers_to").isNull(), F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))).otherwise(F.lit(b""))
    return rows.select("page_id", "url", "refers_to", "total", "sha1", "chunk_no", chunk.alias("chunk"))


def _record_id(page_id: int | None, sha1: str) -> str:
    return f"<{RECORD_ID}{'' if page_id is None else page_id}:{sha1}>"


def _page_of(record_id: str) -> int | None:
    number = record_id.strip("<>").removeprefix(RECORD_ID).partition(":")[0]
    return int(number) if number else None


def _heads(row: dict) -> bytes:
    """WARC and HTTP headers of a record."""
    http = HTTP_HEAD.format(row["total"]).encode()
    revisit = row["refers_to"] is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(row['page_id'], row['sha1'])}",
        "WARC-Date: 2000-01-01T00:00:00Z",
    ]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + row["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(row['refers_to'], row['sha1'])}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{row['sha1']}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else row['total'])}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


INDEX_SCHEMA = "file int, page_id bigint, byte_offset bigint, byte_length bigint"


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write the record table as gzip members, one a record, and return the written index ``file, page_id, byte_offset, byte_length``.

    A file is written under a name of its attempt and renamed when whole. A
    payload whose chunks do not give its length and SHA-1 fails the task.
    """
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    fs, root = filesystem(uri)
    fs.create_dir(f"{root}/archives", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        store, base = filesystem(uri)
        draft = f"{base}/archives/.draft-{number:06d}-{uuid.uuid4().hex}"
        out, record = None, None

        def close() -> tuple:
            nonlocal record
            row, packer, digest, written, begun = record
            revisit = row["refers_to"] is not None
            if not revisit and (written != row["total"] or digest.hexdigest() != row["sha1"]):
                raise ValueError(f"chunks of page {row['page_id']} do not make its payload")
            out.write(packer.compress(b"\r\n\r\n") + packer.flush())
            record = None
            return number, row["page_id"], begun, out.tell() - begun

        def emit(done: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], ["file", "page_id", "byte_offset", "byte_length"])

        for batch in batches:
            done = []
            heads = batch.select(["page_id", "url", "refers_to", "total", "sha1", "chunk_no"]).to_pylist()
            for row, chunk in zip(heads, batch.column("chunk")):
                out = out or store.open_output_stream(draft, compression=None, buffer_size=1 << 20)
                if row["chunk_no"] == 0:
                    if record:
                        done.append(close())
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    record = [row, packer, hashlib.sha1(), 0, out.tell()]
                    out.write(packer.compress(_heads(row)))
                piece = chunk.as_buffer()
                record[2].update(piece)
                record[3] += piece.size
                out.write(record[1].compress(piece))
            if done:
                yield emit(done)
        if record:
            yield emit([close()])
        if out:
            out.close()
            store.move(draft, f"{base}/archives/part-{number:06d}.warc.gz")

    chunks.mapInArrow(run, INDEX_SCHEMA).write.parquet(f"{uri}/index")
    return chunks.sparkSession.read.schema(INDEX_SCHEMA).parquet(f"{uri}/index")


class _Members:
    """Bounded pieces of the gzip members of a stream."""

    def __init__(self, source, piece: int):
        self.source, self.piece = source, piece
        self.raw, self.ended, self.plain, self.unpacker = b"", False, b"", None

    def begin(self) -> bool:
        if not self.raw:
            self.raw = self.source.read(READ_BYTES)
        self.unpacker = zlib.decompressobj(31) if self.raw else None
        self.ended, self.plain = False, b""
        return self.unpacker is not None

    def more(self) -> bool:
        """Unpack one more piece; False at the member's end."""
        while not self.ended:
            if not self.raw:
                self.raw = self.source.read(READ_BYTES)
                if not self.raw:
                    raise EOFError("archive ends inside a record")
            got = self.unpacker.decompress(self.raw, self.piece)
            self.ended = self.unpacker.eof
            self.raw = self.unpacker.unused_data if self.ended else self.unpacker.unconsumed_tail
            if got:
                self.plain += got
                return True
        return False

    def head(self) -> tuple[dict[str, str], int]:
        """A header block, its first line under the empty name, and its size."""
        while (at := self.plain.find(b"\r\n\r\n")) < 0:
            if not self.more():
                raise EOFError("record ends inside its header")
        first, *lines = self.plain[:at].decode("utf-8").split("\r\n")
        self.plain = self.plain[at + 4 :]
        return {"": first} | {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}, at + 4

    def body(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes in pieces."""
        while size:
            if not self.plain and not self.more():
                raise EOFError("record ends inside its payload")
            part, self.plain = self.plain[: min(size, self.piece)], self.plain[min(size, self.piece) :]
            size -= len(part)
            yield part


CHUNK_SCHEMA = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
    "chunk_no int, last boolean, bytes_so_far bigint, digest_so_far string, chunk binary"
)
_CHUNK_TYPES = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary())
_CHUNK_NAMES = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]


def _record_chunks(source, piece: int) -> Iterator[tuple]:
    """Chunk rows of every record of an archive; the header's digest is checked against the payload's."""
    members = _Members(source, piece)
    while members.begin():
        warc, _ = members.head()
        if not warc[""].startswith("WARC/"):
            raise ValueError("not a WARC record")
        http, size = members.head()
        kind = warc["warc-type"]
        page = _page_of(warc["warc-record-id"])
        url = warc.get("warc-target-uri")
        url = url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        refers = _page_of(warc["warc-refers-to"]) if "warc-refers-to" in warc else None
        total, said = int(http["content-length"]), warc["warc-payload-digest"].removeprefix("sha1:")
        stored = int(warc["content-length"]) - size
        digest, so_far, number = hashlib.sha1(), 0, 0
        fixed = (page, url, kind, refers, total, said)
        for part in members.body(stored):
            digest.update(part)
            so_far += len(part)
            yield (*fixed, number, so_far == stored, so_far, digest.copy().hexdigest(), part)
            number += 1
        if not stored:
            yield (*fixed, 0, True, 0, digest.hexdigest(), b"")
        if kind == "response" and (stored != total or digest.hexdigest() != said):
            raise ValueError(f"payload of page {page} does not match its digest")
        if b"".join(members.body(4)) != b"\r\n\r\n" or members.plain or members.more():
            raise ValueError("record has no proper end")


def read_archives(spark: SparkSession, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The record table of all archives of ``folder``, a row for each chunk.

    ``payload_bytes`` and ``payload_digest`` are the full payload's by the
    record's headers; ``bytes_so_far`` and ``digest_so_far`` run along the
    chunks as read, and a response whose last ones differ from its headers
    fails. ``record_type`` is response or revisit; ``refers_to`` the storing page.
    """
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    files = [r["file"] for r in spark.read.schema(INDEX_SCHEMA).parquet(f"{uri}/index").select("file").distinct().collect()]  # one row a file
    if not files:
        return spark.createDataFrame([], CHUNK_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(uri)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{base}/archives/part-{number:06d}.warc.gz", compression=None) as source:
                    for row in _record_chunks(source, chunk_bytes):
                        rows.append(row)
                        held += len(row[-1])
                        if held > 4 << 20 or len(rows) >= 2000:
                            yield _chunk_batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _chunk_batch(rows)

    listing = spark.createDataFrame(spark.sparkContext.parallelize([(f,) for f in sorted(files)], len(files)), "file int")
    return listing.mapInArrow(run, CHUNK_SCHEMA)


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _CHUNK_TYPES)], _CHUNK_NAMES)


def archive(pages: DataFrame, least: int = REVISIT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write every row of ``pages`` (``page_id, url, html``) as a record in the shared folder and read all archives back.

    Returns the record table of :func:`read_archives`. Null html: an empty
    payload, stored; null url: a record without target; null ``page_id``: kept
    as null; repeated rows: a record each; other columns are ignored; an empty
    table gives an empty record table.
    """
    folder = new_path(pages.sparkSession, "warc")
    write_archives(chunk_rows(pages, least, chunk_bytes), folder)
    return read_archives(pages.sparkSession, folder, chunk_bytes)
