"""Byte-level BPE: Spark's higher-order functions fold ranked merges over the byte arrays of distinct words.

Texts are cut by the pattern of the rank file's tokenizer. The words of some
megabytes of text form a chunk. The chunks' distinct words meet in one shuffle
and each is encoded once, by a fold whose every step merges a pair of the least
rank; their ids go back to the chunks in another. Ranks are probed in a
literal map. Decoding looks the pieces up in a literal array and concatenates
them.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import new_path, partitions

#: Bytes of text whose words are encoded together; a longer text makes a chunk of its own.
CHUNK_BYTES = 32 << 20
#: Buckets of the two literal maps, and slots of the second.
BUCKETS, SLOTS = 1 << 16, 1 << 18
#: Words of more bytes are merged by ranks, not by pairs.
SHORT = 200
#: An id, a rank and a place in a word take so many bits; NONE is the rank of a pair that is no piece, END the id beyond a word's ends.
BITS = 20
NONE = END = (1 << BITS) - 1
#: Multiplier that spreads pairs over buckets.
SPREAD = 31_337
#: Slots of partitions, of the chunks of a partition and of the words of a chunk in a key of 64 bits; words are encoded once for so many partitions.
CHUNK_BITS, PLACE_BITS, SPAN_BITS = 16, 24, 12
#: Words whose ids are gathered or packed at once, and what packed ones look like.
GATHER_WORDS, FOUND = 1 << 18, "struct<places:binary,lengths:binary,ids:binary>"
#: Fixed value: Unicode's White_Space characters; Java's ``\\s`` has those of ASCII alone.
SPACE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def default_ranks() -> str:
    """Path of the byte-level rank file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    """The pattern by which the installed rank files' tokenizers cut texts."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def java_pattern(pattern: str) -> str:
    """``pattern`` with ``\\s`` and ``\\S`` as explicit classes, which Java's engine reads alike."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """The pieces of a rank file with their ids. It must hold every single byte."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path}: not every byte is a piece")
    return ranks


def _pair_table(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """A hash table without collisions from pairs of ids to the rank of the two pieces' bytes together.

    Pairs fall into buckets, and every bucket has a multiplier that sends its
    pairs to slots of their own; a slot holds left id, right id and rank.
    """
    buckets: list[list[tuple[int, int, int]]] = [[] for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        for k in range(1, len(piece)):
            left, right = ranks.get(piece[:k]), ranks.get(piece[k:])
            if left is not None and right is not None:
                buckets[(left * SPREAD + right) % BUCKETS].append((left, right, rank))
    factors, slots = [0] * BUCKETS, [-1] * SLOTS
    for g in sorted(range(BUCKETS), key=lambda g: -len(buckets[g])):
        for trial in range(1 << BITS):
            factor = (trial * 245_489 + g * 104_729) % (1 << BITS)
            mine = {((left + 1) * factor + right) % SLOTS: (left, right, rank) for left, right, rank in buckets[g]}
            if len(mine) == len(buckets[g]) and all(slots[k] < 0 for k in mine):
                break
        else:
            raise ValueError("the pairs of the rank file do not fit the table")
        factors[g] = factor
        for k, (left, right, rank) in mine.items():
            slots[k] = (left << 2 * BITS) + (right << BITS) + rank
    return factors, slots


@lru_cache(maxsize=4)
def _rank_json(path: str) -> str:
    ranks = read_ranks(path)
    pieces: list[list[str]] = [[] for _ in range(BUCKETS)]
    places: list[list[int]] = [[] for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        h = xxhash.xxh64_intdigest(piece, seed=42) % BUCKETS
        pieces[h].append(base64.b64encode(piece).decode())
        places[h].append(rank)
    factors, slots = _pair_table(ranks)
    bytes_ = [0] * 256
    for b in range(256):
        bytes_[zlib.crc32(bytes([b])) >> 24] = ranks[bytes([b])]
    table = {"pieces": pieces, "ranks": places, "factors": factors, "slots": slots, "bytes": bytes_}
    return json.dumps(table, separators=(",", ":"))


@lru_cache(maxsize=4)
def _piece_json(path: str) -> str:
    ranks = read_ranks(path)
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = base64.b64encode(piece).decode()
    return json.dumps(pieces, separators=(",", ":"))


def rank_map(path: str) -> Column:
    """The rank file as one literal: maps from bytes and from pairs of ids to ranks (Spark folds the JSON when it plans)."""
    return F.from_json(F.lit(_rank_json(path)), "pieces array<array<binary>>, ranks array<array<int>>, factors array<bigint>, slots array<bigint>, bytes array<bigint>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rank_of(piece: Column, table: Column) -> Column:
    """The rank of a byte string, null where it is no piece."""
    bucket = F.xxhash64(piece).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    place = F.array_position(F.get(table["pieces"], bucket), piece).cast("int") - 1
    return F.get(F.get(table["ranks"], bucket), place)


def _low(x: Column, size: int) -> Column:
    return x.bitwiseAND(F.lit(size - 1))


def _pair_rank(left: Column, right: Column, table: Column) -> Column:
    """The rank of two ids together, NONE where that is no piece. All are long integers."""
    factor = F.get(table["factors"], _low(left * SPREAD + right, BUCKETS).cast("int"))
    slot = F.get(table["slots"], _low((left + 1) * factor + right, SLOTS).cast("int"))
    return let(slot, lambda x: F.when(F.shiftright(x, BITS) == left * (1 << BITS) + right, _low(x, 1 << BITS)).otherwise(F.lit(NONE).cast("bigint")))


def _run_start(starts: Column, i: Column) -> Column:
    """The greatest of the ascending ``starts`` that is not over ``i``, by binary search."""
    bits = F.array(*[F.lit(1 << b) for b in range(29, -1, -1)])

    def closer(at: Column, bit: Column) -> Column:
        return F.when(F.get(starts, at + bit) <= i, at + bit).otherwise(at)

    return F.get(starts, F.aggregate(bits, F.lit(0), closer))


def _merged(state: Column, table: Column) -> Column:
    """One step of the fold: all pairs of the least rank merge, from left to right without overlap."""
    parts, ranks, least = state["parts"], state["ranks"], state["least"]

    def is_least(i: Column) -> Column:
        return F.coalesce(F.get(ranks, i) == least, F.lit(False))

    def with_hits(hits: Column) -> Column:
        def hit(i: Column) -> Column:
            return F.coalesce(F.get(hits, i), F.lit(False))

        left = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: ~hit(i - 1))

        def with_left(left: Column) -> Column:
            fused = F.transform(left, lambda i: F.when(hit(i), least).otherwise(F.get(parts, i)))

            def with_parts(fused: Column) -> Column:
                def rank(i: Column, j: Column) -> Column:
                    after = F.get(left, j + 1)
                    fresh = _pair_rank(F.get(fused, j), F.get(fused, j + 1), table)
                    return F.when(after.isNull(), F.lit(NONE).cast("bigint")).when(hit(i) | hit(after), fresh).otherwise(F.get(ranks, i))

                return let(
                    F.transform(left, rank),
                    lambda r: F.struct(fused.alias("parts"), r.alias("ranks"), F.array_min(r).alias("least")),
                )

            return let(fused, with_parts)

        return let(left, with_left)

    first = F.transform(ranks, lambda r, i: (r == least) & ~is_least(i - 1))
    starts = F.filter(F.sequence(F.lit(0), F.size(ranks) - 1), lambda i: is_least(i) & ~is_least(i - 1))
    apart = let(
        starts,
        lambda s: F.transform(ranks, lambda r, i: F.when(r != least, False).when(~is_least(i - 1), True).otherwise((i - _run_start(s, i)) % 2 == 0)),
    )
    runs = F.exists(F.sequence(F.lit(0), F.size(ranks) - 1), lambda i: is_least(i) & is_least(i + 1))
    return F.when(least == NONE, state).otherwise(let(F.when(runs, apart).otherwise(first), with_hits))


def _packed(rank: Column, place: Column, part: Column) -> Column:
    return rank * (1 << 2 * BITS) + place * (1 << BITS) + part


def _merged_once(line: Column, table: Column) -> Column:
    """One step of the fold of a short word: the leftmost pair of the least rank merges.

    ``line`` packs, for each part, the rank of it with the next part, its place
    and its id; place 0 is END. The least number is so the pair to merge.
    """

    def at_least(least: Column) -> Column:
        place, rank = _low(F.shiftright(least, BITS), 1 << BITS), F.shiftright(least, 2 * BITS)
        at = place.cast("int")
        before = _low(F.get(line, at - 1), 1 << BITS)
        after = F.coalesce(_low(F.get(line, at + 2), 1 << BITS), F.lit(END).cast("bigint"))
        fresh = F.array(_packed(_pair_rank(before, rank, table), place - 1, before), _packed(_pair_rank(rank, after, table), place, rank))
        moved = F.transform(F.slice(line, at + 3, F.size(line)), lambda x: x - (1 << BITS))
        return F.when(rank == NONE, line).otherwise(F.concat(F.slice(line, F.lit(1), at - 1), fresh, moved))

    return let(F.array_min(line), at_least)


def _ranks(parts: Column, table: Column) -> Column:
    """The rank of each part with the next."""
    return F.transform(parts, lambda p, i: _pair_rank(p, F.coalesce(F.get(parts, i + 1), F.lit(END).cast("bigint")), table))


def _short_word(parts: Column, table: Column) -> Column:
    front = F.array(F.lit((NONE << 2 * BITS) + END).cast("bigint"))
    ranked = F.zip_with(_ranks(parts, table), F.transform(parts, lambda p, i: p + (i + 1) * F.lit(1 << BITS).cast("bigint")), lambda r, p: r * (1 << 2 * BITS) + p)
    return F.aggregate(
        F.sequence(F.lit(2), F.size(parts)),
        F.concat(front, ranked),
        lambda line, _: _merged_once(line, table),
        lambda line: F.transform(F.slice(line, F.lit(2), F.size(line)), lambda x: _low(x, 1 << BITS).cast("int")),
    )


def _long_word(parts: Column, table: Column) -> Column:
    return F.aggregate(
        F.sequence(F.lit(2), F.size(parts)),
        let(_ranks(parts, table), lambda r: F.struct(parts.alias("parts"), r.alias("ranks"), F.array_min(r).alias("least"))),
        lambda state, _: _merged(state, table),
        lambda state: F.transform(state["parts"], lambda p: p.cast("int")),
    )


def fold(word: Column, table: Column) -> Column:
    """Ids of one word (binary, not empty): a fold over as many steps as the word has pairs.

    A step merges one pair of a short word; of a long one it merges all pairs of
    the least rank, so that a word of a million equal bytes takes a few steps.
    Both give the same ids, as a piece made by a merge ranks behind its parts.
    """

    def letter(i: Column) -> Column:  # the highest byte of a byte's CRC-32 is another for every byte
        return F.get(table["bytes"], F.shiftright(F.crc32(F.substring(word, i, F.lit(1))), 24).cast("int"))

    parts = F.transform(F.sequence(F.lit(1), F.octet_length(word)), letter)
    merged = let(parts, lambda p: F.when(F.size(p) <= SHORT, _short_word(p, table)).otherwise(_long_word(p, table)))
    return let(rank_of(word, table), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(merged))


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as four runs of bytes, lowest first: the high ones are nearly all zero and compress away."""
    return np.ascontiguousarray(numbers.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _coded(part: pa.Table, number: int) -> pa.RecordBatch:
    """One chunk: its documents, their counts of words, the words' places and the distinct words, the most frequent first."""
    lists = part.column("found")
    coded = pc.list_flatten(lists).dictionary_encode()  # its parts share one dictionary
    dictionary = coded.chunk(0).dictionary if coded.num_chunks else pa.array([], pa.string())
    codes = np.concatenate([np.zeros(0, dtype=np.int32), *(c.indices.to_numpy(zero_copy_only=False) for c in coded.chunks)])
    del coded
    order = np.argsort(-np.bincount(codes, minlength=len(dictionary)), kind="stable")
    place = np.empty(len(order), dtype=np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    distinct = dictionary.cast(pa.binary()).take(pa.array(order))
    counts = np.concatenate([np.zeros(0, dtype=np.int32), *(pc.list_value_length(c).to_numpy(zero_copy_only=False) for c in lists.chunks)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            pa.array([counts], pa.list_(pa.int32())),
            pa.array([_planes(place[codes])], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct),
        ],
        ["chunk", "doc_id", "counts", "codes", "words"],
    )


def _chunks(docs: DataFrame, pattern: str) -> DataFrame:
    """Documents as numbers of words: ``chunk, doc_id, counts, codes, words`` with about CHUNK_BYTES of text a row.

    ``counts`` has the words of each document, ``codes`` the place of each word
    in ``words``, the distinct words of the chunk, as planes of 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, size = TaskContext.get().partitionId() << CHUNK_BITS, [], 0
        for batch in batches:
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff((size + np.cumsum(sizes)) // CHUNK_BYTES, prepend=size // CHUNK_BYTES)) + 1
            size = (size + int(sizes.sum())) % CHUNK_BYTES
            first = 0
            for last in cuts.tolist():
                yield _coded(pa.Table.from_batches([*waiting, batch.slice(first, last - first)]), number)
                number, waiting, first = number + 1, [], last
                pa.default_memory_pool().release_unused()
            if first < batch.num_rows:
                waiting.append(batch.slice(first))
        if waiting:
            yield _coded(pa.Table.from_batches(waiting), number)
        del waiting
        pa.default_memory_pool().release_unused()  # the worker lives on; its memory goes back

    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.octet_length(text).alias("size"),
        F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0)).alias("found"),
    )
    return found.mapInArrow(run, "chunk bigint, doc_id array<bigint>, counts array<int>, codes binary, words array<binary>")


def _bucketed(chunks: DataFrame) -> DataFrame:
    """``chunks`` as a table in the shared folder, bucketed by chunk: a join on the chunk moves the other side only."""
    spark = chunks.sparkSession
    name = f"tidemark_chunks_{uuid.uuid4().hex}"
    options = {"path": new_path(spark, "chunks"), "compression": "zstd"}
    chunks.write.format("parquet").options(**options).bucketBy(partitions(spark), "chunk").saveAsTable(name)
    return spark.table(name)


def _by_chunk(rows: DataFrame) -> DataFrame:
    """``chunk, ids``: rows of ``key, ids`` packed by chunk within each task, places as differences."""

    def packed(keys: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(keys, kind="stable")
        start = np.cumsum(lengths) - lengths
        keys, sizes = keys[order], lengths[order]
        stops = np.cumsum(sizes)
        ids = ids[np.repeat(start[order] - (stops - sizes), sizes) + np.arange(len(ids))]
        chunks = keys >> PLACE_BITS
        cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:]):
            place = np.diff(keys[i:j] & ((1 << PLACE_BITS) - 1), prepend=0)
            line = ids[stops[i] - sizes[i] : stops[j - 1]]
            parts = {"places": _planes(place), "lengths": _planes(sizes[i:j]), "ids": _planes(line)}
            found = pa.StructArray.from_arrays([pa.array([x], pa.binary()) for x in parts.values()], list(parts))
            yield pa.RecordBatch.from_arrays([pa.array([chunks[i]], pa.int64()), found], ["chunk", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            lists = batch.column("ids")
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            waiting.append((keys, pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)))
            size += len(keys)
            if size > GATHER_WORDS:
                yield from packed(*map(np.concatenate, zip(*waiting)))
                waiting, size = [], 0
        if size:
            yield from packed(*map(np.concatenate, zip(*waiting)))
        del waiting
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, f"chunk bigint, found {FOUND}")


def _encoded_words(chunks: DataFrame, path: str) -> DataFrame:
    """``chunk, found``: place and ids of every word of a chunk. Each distinct word is encoded once for 4096 partitions."""
    words = chunks.select("chunk", F.posexplode("words").alias("place", "word"))
    words = words.select("word", F.shiftleft("chunk", PLACE_BITS).bitwiseOR(F.col("place")).alias("key"))
    # a number of partitions that is asked for stays: words are small and the fold is long, so few large tasks would be slow
    words = words.repartition(partitions(chunks.sparkSession), "word")
    span = F.shiftright("key", PLACE_BITS + CHUNK_BITS + SPAN_BITS)
    group = words.groupBy("word", span.alias("span")).agg(F.collect_list("key").alias("keys"))
    ids = let(rank_map(path), lambda table: fold(F.col("word"), table))
    found = group.select(ids.alias("ids"), "keys").select("ids", F.explode("keys").alias("key"))
    return _by_chunk(found).groupBy("chunk").agg(F.collect_list("found").alias("found"))


def _gathered(row: dict) -> Iterator[pa.RecordBatch]:
    """The documents of one chunk with their ids, some at a time."""
    found = [{k: _unplaned(x) for k, x in part.items()} for part in row["found"]]
    none = [np.zeros(0, dtype=np.uint32)]
    place = np.concatenate([np.cumsum(part["places"], dtype=np.int64) for part in found] or none).astype(np.int64)
    lengths = np.concatenate([part["lengths"] for part in found] or none).astype(np.int64)
    values = np.concatenate([part["ids"] for part in found] or none)
    start = np.empty(len(place), dtype=np.int64)
    length = np.empty(len(place), dtype=np.int64)
    start[place], length[place] = np.cumsum(lengths) - lengths, lengths
    codes = _unplaned(row["codes"])
    counts = row["counts"].to_numpy(zero_copy_only=False)
    ends = np.cumsum(counts)
    first, begun = 0, 0
    while first < len(counts):
        last = max(first + 1, int(np.searchsorted(ends, begun + GATHER_WORDS, side="right")))
        mine = codes[begun : ends[last - 1]]
        sizes = length[mine]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        ids = values[np.repeat(start[mine] - (stops - sizes), sizes) + np.arange(total)]
        # tokens before each document's end
        edges = np.concatenate(([0], stops))[np.concatenate(([0], ends[first:last] - begun))].astype(np.int32)
        blob = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer((edges * 4).astype(np.int32)), pa.py_buffer(ids.tobytes())])
        tokens = pa.ListArray.from_arrays(pa.array(edges), pa.array(ids.view(np.int32)))
        yield pa.RecordBatch.from_arrays(
            [row["doc_id"].slice(first, last - first), tokens, blob, pa.array(np.diff(edges).astype(np.int64))], ["doc_id", "tokens", "ids", "n_tokens"]
        )
        first, begun = last, int(ends[last - 1])


def encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, tokens, ids, n_tokens`` of every row of ``docs``: the ids of the whole text, as integers and as little-endian unsigned 32-bit bytes.

    ``ranks`` is a rank file, ``pattern`` the expression whose matches are
    encoded separately. A null text counts as empty, an empty one has no token; a
    very long text makes a chunk of its own, a very long word takes as many
    steps as it has different ranks; repeated rows are encoded each; a null
    ``doc_id`` stays null; other columns are ignored; an empty table gives an
    empty result. Text does not move: what does are the distinct words of each
    chunk, and their ids. The chunks are a table in the shared folder.
    """
    path = ranks or default_ranks()
    chunks = _bucketed(_chunks(docs, pattern or default_pattern()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name).slice(k, 1) for name in batch.schema.names}
                row = {"codes": row["codes"][0].as_buffer(), "found": row["found"][0].as_py() or [], "counts": row["counts"].flatten(), "doc_id": row["doc_id"].flatten()}
                yield from _gathered(row)
        pa.default_memory_pool().release_unused()

    rows = chunks.select("chunk", "doc_id", "counts", "codes").join(_encoded_words(chunks, path), "chunk", "left")
    return rows.drop("chunk").mapInArrow(run, "doc_id bigint, tokens array<int>, ids binary, n_tokens bigint")


def decode(rows: DataFrame, ranks: str | None = None) -> DataFrame:
    """``rows`` with a last column ``bytes``: the pieces of ``tokens`` one after another, as binary. Null tokens give null, none give no bytes."""
    pieces = F.from_json(F.lit(_piece_json(ranks or default_ranks())), "array<binary>")
    joined = let(pieces, lambda table: F.array_join(F.transform("tokens", lambda t: F.get(table, t).cast("string")), ""))
    return rows.withColumn("bytes", joined.cast("binary"))
