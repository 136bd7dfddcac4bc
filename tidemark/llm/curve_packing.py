"""Packing along a space-filling curve: neighbouring documents share sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, partitions, slices
from tidemark.llm.tokens import default_tokenizer, encoder

FEATURES = 512
DIMENSIONS = 4
BITS = 10
#: Low bits of a position that tell documents of one curve cell apart.
TIE_BITS = 63 - DIMENSIONS * BITS


def projection(features: int = FEATURES, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Fixed matrix of signs that takes hashed token counts to a few dimensions."""
    mixed = (np.arange(features * dimensions, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.where(mixed >> np.uint64(63) == 1, 1.0, -1.0).reshape(features, dimensions)


def cells(vectors: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Grid cells of projected unit vectors: each axis through the logistic curve, in ``2**bits`` steps."""
    unit = 1.0 / (1.0 + np.exp(-1.702 * vectors))
    return np.minimum((unit * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def hilbert_key(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of each row of a grid of integers in ``[0, 2**bits)``.

    Gray-code form: going down from the highest bit, each axis either reflects
    the first axis' lower bits or swaps them with its own; the transposed bits
    are then read across the axes.
    """
    x = grid.T.astype(np.int64).copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(n):
            reflect = (x[axis] >> level) & 1 == 1
            swap = np.where(reflect, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(reflect, x[0] ^ low, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << 1) | ((x[axis] >> level) & 1)
    return key


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id, pos, n, wide, ids`` of every row: curve position and whole token ids with the end id.

    Ids are little-endian unsigned, 32-bit if ``wide``, else 16-bit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        matrix = projection()
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for part in slices(batch):
                ids = [x + end for x in words.ids_of(part.column("text").to_pylist())]
                tokens = [np.frombuffer(x, dtype="<u4") for x in ids]
                counts = np.stack([np.bincount(t & np.uint32(FEATURES - 1), minlength=FEATURES) for t in tokens]).astype(float)
                vectors = counts / np.linalg.norm(counts, axis=1, keepdims=True) @ matrix
                key = hilbert_key(cells(vectors))
                wide = [int(t.max()) >= 1 << 16 for t in tokens]
                kept = [x if w else t.astype("<u2").tobytes() for x, t, w in zip(ids, tokens, wide)]
                tie = part.column("tie").to_numpy() & ((1 << TIE_BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array((key << TIE_BITS) | tie), pa.array([len(t) for t in tokens], pa.int64()), pa.array(wide), pa.array(kept, pa.binary())],
                    ["doc_id", "pos", "n", "wide", "ids"],
                )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("doc_id", "text").alias("tie"),
    )
    return rows.mapInArrow(run, "doc_id bigint, pos bigint, n bigint, wide boolean, ids binary")


def cut_points(total: int, length: int) -> np.ndarray:
    """Starts of all sequences after the last full one, and the end: the rest splits into powers of two, which need no padding."""
    at = total // length * length
    out = [at]
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        out.append(at)
    return np.array(out, dtype=np.int64)


def pieces_of(base: int, lengths: np.ndarray, tail: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Cut documents that follow each other from global token ``base`` on: ``document, start, length, sequence, offset`` of each piece."""
    ends = base + np.cumsum(lengths)
    begins = ends - lengths
    last = int(ends[-1])
    full = int(tail[0])
    inner = np.arange((base // length + 1) * length, min(last, full + 1), length, dtype=np.int64)
    cuts = np.concatenate((begins, inner, tail[(tail > base) & (tail < last)]))
    cuts = np.unique(cuts)
    stops = np.append(cuts[1:], last)
    document = np.searchsorted(begins, cuts, side="right") - 1
    in_tail = cuts >= full
    nth = np.searchsorted(tail, cuts, side="right") - 1
    sequence = np.where(in_tail, full // length + nth, cuts // length)
    first = np.where(in_tail, tail[np.maximum(nth, 0)], cuts // length * length)
    return document, cuts - begins[document], stops - cuts, sequence, cuts - first


def pack(docs: DataFrame, length: int = 2048, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Pack whole documents into sequences of ``length`` tokens along a Hilbert curve.

    Returns one row for each piece: ``doc_id, start, length, doc_tokens,
    sequence_id, offset, ids`` (little-endian unsigned 32-bit). Hashed token
    counts are projected to four dimensions; documents follow each other by
    their curve position, ties by a hash of id and text; the stream is cut
    every ``length`` tokens. Only the stream's last sequences are shorter, with
    power-of-two lengths, so nothing needs padding.

    A null text counts as empty (one piece, the end id alone), a null
    ``doc_id`` stays null, repeated rows are packed each, other columns are
    ignored, an empty table gives no pieces. Positions carry 23 hash bits, so a
    cell with a third of all rows still splits over partitions.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    rows = materialize(encoded(docs, tokenizer, end_id), "encoded")
    n = partitions(spark)
    found = rows.agg(F.percentile_approx("pos", [k / n for k in range(1, n)], 50 * n)).first()[0] if n > 1 else []
    bounds = np.array(found or [], dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(pos):
        import pandas as pd

        return pd.Series(np.searchsorted(bounds, pos.to_numpy(), side="right").astype(np.int32))

    # one row a partition: the tokens that come before it
    sums = dict(rows.select(range_of("pos").alias("p"), "n").groupBy("p").agg(F.sum("n")).collect())
    bases, total = {}, 0
    for p in range(len(bounds) + 1):
        bases[p] = total
        total += sums.get(p, 0)
    tail = cut_points(total, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if at is None:
                at = bases[batch.column("p")[0].as_py()]
            for part in slices(batch):
                lengths = part.column("n").to_numpy()
                document, start, size, sequence, offset = pieces_of(at, lengths, tail, length)
                at += int(lengths.sum())
                kinds = ["<u4" if w else "<u2" for w in part.column("wide").to_pylist()]
                ids = [np.frombuffer(x.as_buffer(), dtype=k) for x, k in zip(part.column("ids"), kinds)]
                cut = [ids[d][s : s + z].astype("<u4").tobytes() for d, s, z in zip(document.tolist(), start.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(document)), *(pa.array(x) for x in (start, size, lengths[document], sequence, offset)), pa.array(cut, pa.binary())],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    ordered = rows.withColumn("p", range_of("pos")).repartitionById(n, "p").sortWithinPartitions("pos", "doc_id", "ids")
    return ordered.mapInArrow(
        run, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    )
