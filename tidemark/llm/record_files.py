"""Length-delimited binary files of token sequences, with masked checksums and an offset index.

A record is framed as: length (unsigned 64-bit), masked CRC-32C of these eight
bytes, payload, masked CRC-32C of the payload; all numbers little-endian. The
payload is a flag word (bit 0: the document has an id; bit 1: wide ids), the id
(signed 64-bit) and the token ids, unsigned 32-bit if wide, else 16-bit.
"""

from __future__ import annotations

import functools
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import new_path, partitions, slices
from tidemark.llm.tokens import default_tokenizer, encoder

HEAD = "<Iq"
HEAD_BYTES = struct.calcsize(HEAD)
# The reflected Castagnoli polynomial, and the constant and turn of the mask.
POLYNOMIAL = 0x82F63B78
MASK_ADD = 0xA282EAD8
MASK_TURN = 15
#: Bytes that one lane of the vectorised checksum takes.
LANE = 64
READ_BYTES = 8 << 20


@functools.cache
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return table


@functools.cache
def _pair_table() -> np.ndarray:
    """Effect of two bytes at once, by the low 16 bits of state and input."""
    byte = _byte_table()
    low = np.arange(1 << 16, dtype=np.uint32)
    once = byte[low & 255] ^ (low >> np.uint32(8))
    return byte[once & 255] ^ (once >> np.uint32(8))


def _apply(maps: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return maps[0][crc & 255] ^ maps[1][(crc >> 8) & 255] ^ maps[2][(crc >> 16) & 255] ^ maps[3][crc >> 24]


@functools.cache
def _shift(power: int) -> np.ndarray:
    """Tables that carry a checksum over ``2**power`` zero bytes."""
    values = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    if power == 0:
        return _byte_table()[values & 255] ^ (values >> np.uint32(8))
    half = _shift(power - 1)
    return _apply(half, _apply(half, values))


def _shifted(crc: int, count: int) -> int:
    value = np.array([crc], dtype=np.uint32)
    for power in range(count.bit_length()):
        if count >> power & 1:
            value = _apply(_shift(power), value)
    return int(value[0])


@functools.lru_cache(maxsize=65536)
def _start(count: int) -> int:
    return _shifted(0xFFFFFFFF, count) ^ 0xFFFFFFFF


def crc32c(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of each payload. All lanes of all payloads advance together, two bytes a step; lanes then fold in pairs."""
    if not payloads:
        return np.zeros(0, dtype=np.uint32)
    lanes = np.array([max(1, -(-len(p) // LANE)) for p in payloads])
    # zeros before the data leave a zero state as it is
    blob = b"".join(x for p, k in zip(payloads, lanes.tolist()) for x in (bytes(k * LANE - len(p)), p))
    columns = np.ascontiguousarray(np.frombuffer(blob, dtype="<u2").reshape(-1, LANE // 2).T)
    table = _pair_table()
    state = np.zeros(columns.shape[1], dtype=np.uint32)
    for column in columns:
        state = table[(state ^ column) & np.uint32(0xFFFF)] ^ (state >> np.uint32(16))
    power = LANE.bit_length() - 1
    while lanes.max() > 1:
        starts = np.cumsum(lanes) - lanes
        odd = lanes % 2
        padded = np.zeros(int((lanes + odd).sum()), dtype=np.uint32)
        new_starts = np.cumsum(lanes + odd) - (lanes + odd)
        place = np.arange(len(state)) + np.repeat(new_starts + odd - starts, lanes)
        padded[place] = state
        state = _apply(_shift(power), padded[0::2]) ^ padded[1::2]
        lanes = (lanes + odd) // 2
        power += 1
    return state ^ np.array([_start(len(p)) for p in payloads], dtype=np.uint32)


def masked(crc: np.ndarray) -> np.ndarray:
    turned = (crc >> np.uint32(MASK_TURN)) | (crc << np.uint32(32 - MASK_TURN))
    return turned + np.uint32(MASK_ADD)


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    sums = masked(crc32c(lengths + payloads)).astype("<u4")
    head, body = sums[: len(payloads)], sums[len(payloads) :]
    return [n + h.tobytes() + p + b.tobytes() for n, h, p, b in zip(lengths, head, payloads, body)]


class DamagedRecord(ValueError):
    """A length or checksum of a record file does not hold."""


def unframed(buffer: bytes) -> tuple[list[bytes], int]:
    """Payloads of all whole frames at the start of ``buffer``, checked, and the bytes they take."""
    payloads, sums, at = [], [], 0
    while at + 12 <= len(buffer):
        (length,) = struct.unpack_from("<Q", buffer, at)
        (head_sum,) = struct.unpack_from("<I", buffer, at + 8)
        if int(masked(crc32c([buffer[at : at + 8]]))[0]) != head_sum if length > len(buffer) else False:
            raise DamagedRecord("length checksum differs")
        if at + 16 + length > len(buffer):
            break
        payloads.append(buffer[at + 12 : at + 12 + length])
        sums.append((buffer[at : at + 8], head_sum, struct.unpack_from("<I", buffer, at + 12 + length)[0]))
        at += 16 + length
    if payloads:
        found = masked(crc32c([s[0] for s in sums] + payloads))
        if (found != np.array([s[1] for s in sums] + [s[2] for s in sums], dtype=np.uint32)).any():
            raise DamagedRecord("checksum differs")
    return payloads, at


def payload(doc_id: int | None, ids: bytes) -> bytes:
    """A record's payload; ``ids`` are little-endian unsigned 32-bit."""
    numbers = np.frombuffer(ids, dtype="<u4")
    wide = bool(len(numbers)) and int(numbers.max()) >= 1 << 16
    return struct.pack(HEAD, (doc_id is not None) | wide << 1, doc_id or 0) + (ids if wide else numbers.astype("<u2").tobytes())


def from_payload(payload: bytes) -> tuple[int | None, bytes]:
    flags, doc_id = struct.unpack_from(HEAD, payload)
    ids = payload[HEAD_BYTES:]
    return doc_id if flags & 1 else None, ids if flags & 2 else np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def write_records(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Encode every whole text and write record files under ``folder`` in ascending ``doc_id`` order.

    Returns the offset index, written as Parquet beside the files: ``file,
    ordinal, doc_id, n_tokens, byte_offset, byte_length``, one row for each
    record. A null text counts as empty (the end id alone); null ids come
    first; repeated rows give a record each, ties in id are ordered by text;
    other columns are ignored; an empty table gives no file. Each file is
    written under a name of its own attempt and then renamed, so a task that is
    run again replaces whole files by equal ones.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    fs, root = filesystem(uri)
    fs.create_dir(f"{root}/records", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId()
        store, base = filesystem(uri)
        draft = f"{base}/records/.draft-{number:06d}-{uuid.uuid4().hex}"
        out, at, ordinal = None, 0, 0
        for batch in batches:
            for part in slices(batch):
                if not part.num_rows:
                    continue
                out = out or store.open_output_stream(draft, compression=None, buffer_size=1 << 20)
                ids = part.column("doc_id").to_pylist()
                bodies = [x + end for x in words.ids_of(part.column("text").to_pylist())]
                framed = frames([payload(k, b) for k, b in zip(ids, bodies)])
                sizes = np.array([len(f) for f in framed], dtype=np.int64)
                out.write(b"".join(framed))
                offsets = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), number, dtype=np.int32)),
                        pa.array(np.arange(ordinal, ordinal + len(ids))),
                        part.column("doc_id"),
                        pa.array([len(b) // 4 for b in bodies], pa.int64()),
                        pa.array(offsets),
                        pa.array(sizes),
                    ],
                    ["file", "ordinal", "doc_id", "n_tokens", "byte_offset", "byte_length"],
                )
                ordinal += len(ids)
        if out:
            out.close()
            store.move(draft, f"{base}/records/part-{number:06d}.rec")

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )
    schema = "file int, ordinal bigint, doc_id bigint, n_tokens bigint, byte_offset bigint, byte_length bigint"
    ordered.mapInArrow(run, schema).write.parquet(f"{uri}/index")
    return spark.read.schema(schema).parquet(f"{uri}/index")


def _payload_rows(payloads: list[bytes], first: int, before: int) -> pa.RecordBatch:
    found = [from_payload(p) for p in payloads]
    ids = [x for _, x in found]
    counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(first, first + len(ids))),
            pa.array([k for k, _ in found], pa.int64()),
            pa.array(before + np.cumsum(counts) - counts),
            pa.array(counts),
            pa.array(ids, pa.binary()),
        ],
        ["ordinal", "doc_id", "start", "n_tokens", "ids"],
    )


RECORD_SCHEMA = "ordinal bigint, doc_id bigint, start bigint, n_tokens bigint, ids binary"


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the files in their order: ``ordinal`` in its file, ``doc_id``, ``start`` (ids before it over all files), ``n_tokens``, ``ids``.

    Each task streams whole files in bounded reads and checks every length and
    checksum. Only one row a file (its id total, from the index) reaches the driver.
    """
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    totals = spark.read.parquet(f"{uri}/index").groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    files, before = [], 0
    for r in totals:
        files.append((r["file"], before))
        before += r["n"]
    if not files:
        return spark.createDataFrame([], RECORD_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(uri)
        for batch in batches:
            for number, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ordinal, held = 0, b""
                with store.open_input_stream(f"{base}/records/part-{number:06d}.rec", compression=None) as source:
                    while block := source.read(max(READ_BYTES, len(held))):
                        held += block
                        payloads, used = unframed(held)
                        held = held[used:]
                        for at in range(0, len(payloads), 256):
                            rows = _payload_rows(payloads[at : at + 256], ordinal, start)
                            ordinal += rows.num_rows
                            start += sum(rows.column("n_tokens").to_pylist())
                            yield rows
                if held:
                    raise DamagedRecord(f"part-{number:06d}.rec ends inside a record")

    listing = spark.createDataFrame(spark.sparkContext.parallelize(files, len(files)), "file int, start bigint")
    return listing.mapInArrow(run, RECORD_SCHEMA)


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """Records in an order that ``seed`` decides: ``place, doc_id, n_tokens, ids``, by seeks at the offsets of the index."""
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    index = spark.read.parquet(f"{uri}/index").withColumn("place", F.xxhash64(F.lit(seed), "file", "ordinal"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(uri)
        opened: dict[int, pa.NativeFile] = {}
        for batch in batches:
            for part in slices(batch):
                found = []
                for number, at, size in zip(*(part.column(c).to_pylist() for c in ("file", "byte_offset", "byte_length"))):
                    if number not in opened:
                        if len(opened) >= 64:
                            opened.pop(next(iter(opened))).close()
                        opened[number] = store.open_input_file(f"{base}/records/part-{number:06d}.rec")
                    payloads, _ = unframed(opened[number].read_at(size, at))
                    found += payloads
                rows = _payload_rows(found, 0, 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("place"), rows.column("doc_id"), rows.column("n_tokens"), rows.column("ids")], ["place", "doc_id", "n_tokens", "ids"]
                )

    ordered = index.repartitionByRange(partitions(spark), "place").sortWithinPartitions("place")
    return ordered.select("place", "file", "byte_offset", "byte_length").mapInArrow(run, "place bigint, doc_id bigint, n_tokens bigint, ids binary")


def write_and_read(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to a new folder of the session's shared folder and read all records back."""
    folder = new_path(docs.sparkSession, "records")
    write_records(docs, folder, tokenizer, end_id)
    return read_records(docs.sparkSession, folder)
