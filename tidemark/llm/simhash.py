"""SimHash near-duplicates by pigeonring filtering (Qin and Xiao, 2018).

A 64-bit fingerprint is a ring of ``m`` segments. If two fingerprints differ in
at most ``t`` bits, then from some segment on, every chain of ``l`` consecutive
segments differs in at most ``l * t / m`` bits (cycle lemma). So candidates are
found by the chain's segments that its budgets force to be equal, pruned by the
cumulative budgets along the ring, and checked by the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, slices, text_hash
from tidemark.llm.components import connected_components

SEED = 42
SEGMENTS = 8
#: Fingerprints of one bucket that a task compares at once; larger buckets are compared block by block.
BLOCK = 4096


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of a text's word shingles: A-Z lower-cased, ASCII white space, XXH64 with seed 42."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[i:j], SEED) for i, j in zip(starts.tolist(), ends.tolist())], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id``, ``body_hash`` (of the text) and ``fp`` (the fingerprint as a signed long), a row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fps = np.array([fingerprint(t.as_py(), width) for t in part.column("body")], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("body_hash"), pa.array(fps.view(np.int64))],
                    ["doc_id", "body_hash", "fp"],
                )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_hash("text").alias("body_hash"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"),
    )
    return rows.mapInArrow(run, "doc_id bigint, body_hash bigint, fp bigint")


def chain_plan(distance: int, segments: int = SEGMENTS) -> list[tuple[int, tuple[int, ...]]]:
    """``(first segment, segments that must be equal)`` of every candidate key.

    Budgets of a chain grow 0, 0, .., 1, 1, ..; over the part whose budget is
    at most 1, either nothing differs or one of the later segments does, so a
    key for each left-out segment loses no pair.
    """
    budgets = [length * distance // segments for length in range(1, segments + 1)]
    if budgets[0] > 0:
        raise ValueError("take more segments than bits of distance")
    zero = sum(b == 0 for b in budgets)
    most = sum(b <= 1 for b in budgets)
    out = []
    for first in range(segments):
        if most == zero:
            out.append((first, tuple((first + k) % segments for k in range(zero))))
        for left_out in range(zero, most):
            out.append((first, tuple((first + k) % segments for k in range(most) if k != left_out)))
    return out


def _segment_edges(segments: int) -> list[int]:
    return [64 * k // segments for k in range(segments + 1)]


def _key(fp: Column, segments: int, chosen: tuple[int, ...], number: int) -> Column:
    edges = _segment_edges(segments)
    mask = sum(((1 << (edges[s + 1] - edges[s])) - 1) << edges[s] for s in chosen)
    signed = mask - (1 << 64) if mask >= 1 << 63 else mask
    return F.struct(F.lit(number).cast("smallint").alias("plan"), fp.bitwiseAND(F.lit(signed)).alias("bits"))


def _linked(a: np.ndarray, b: np.ndarray, first: np.ndarray, distance: int, segments: int) -> np.ndarray:
    """Which pairs keep every chain budget from their segment ``first`` on and the whole distance."""
    diff = a ^ b
    alive = np.arange(len(diff))
    edges = np.array(_segment_edges(segments), dtype=np.uint64)
    total = np.zeros(len(diff), dtype=np.int64)
    for length in range(1, segments + 1):
        at = (first[alive] + length - 1) % segments
        width = edges[at + 1] - edges[at]
        part = (diff[alive] >> edges[at]) & ((np.uint64(1) << width) - np.uint64(1) if segments > 1 else ~np.uint64(0))
        total[alive] += np.bitwise_count(part)
        alive = alive[total[alive] <= length * distance // segments]
    good = np.zeros(len(diff), dtype=bool)
    good[alive] = np.bitwise_count(diff[alive]) <= distance
    return good


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the edges ``a - b``."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        if (low == high).all():
            break
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _bucket_edges(fps: np.ndarray, side: np.ndarray, first: int, distance: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of one group. ``side``: 0 rows are compared with the 1 rows, or all with all if no 1 occurs."""
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    whole = not len(right)
    label = np.arange(len(fps))
    step = max(1, 1_000_000 // max(1, len(left) if whole else len(right)))
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        columns = left if whole else right
        a, b = np.repeat(rows, len(columns)), np.tile(columns, len(rows))
        if whole:
            keep = a < b
            a, b = a[keep], b[keep]
        good = _linked(fps[a], fps[b], np.full(len(a), first), distance, segments)
        a, b = a[good], b[good]
        merged = _forest(len(fps), np.concatenate((a, np.arange(len(fps)))), np.concatenate((b, label)))
        label = merged
    child = np.flatnonzero(label != np.arange(len(fps)))
    return fps[child], fps[label[child]]


def _group_edges(table: pa.Table, distance: int, segments: int, firsts: list[int]) -> pa.RecordBatch:
    """Edges of every group of a table that is sorted by group."""
    plan, bits = (table.column(c).to_numpy() for c in ("plan", "bits"))
    i, j, side = (table.column(c).to_numpy() for c in ("i", "j", "side"))
    fps = table.column("fp").to_numpy().view(np.uint64)
    new = np.ones(len(fps), dtype=bool)
    new[1:] = (plan[1:] != plan[:-1]) | (bits[1:] != bits[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    starts = np.append(np.flatnonzero(new), len(fps))
    sizes = np.diff(starts)
    first_of = np.array(firsts)[plan]
    out_a, out_b = [], []
    two = starts[:-1][sizes == 2]  # most groups are pairs: all at once
    if len(two):
        good = _linked(fps[two], fps[two + 1], first_of[two], distance, segments)
        out_a.append(fps[two][good])
        out_b.append(fps[two + 1][good])
    for s, n in zip(starts[:-1][sizes > 2], sizes[sizes > 2]):
        a, b = _bucket_edges(fps[s : s + n], side[s : s + n], int(first_of[s]), distance, segments)
        out_a.append(a)
        out_b.append(b)
    a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (out_a, out_b))
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def fingerprint_edges(fps: DataFrame, distance: int = 3, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct fingerprints of ``fps.fp`` within ``distance`` bits.

    Buckets give spanning forests, not all their pairs. A bucket of more than
    ``block`` fingerprints is dealt over tasks as pairs of blocks, so no task
    holds more than two blocks, and none is capped.
    """
    plans = chain_plan(distance, segments)
    firsts = [first for first, _ in plans]
    keys = fps.select("fp", F.explode(F.array(*[_key(F.col("fp"), segments, c, n) for n, (_, c) in enumerate(plans)])).alias("k"))
    keys = keys.select("fp", "k.plan", "k.bits")
    shared = keys.groupBy("plan", "bits").count().where("count > 1").withColumn("blocks", F.ceil(F.col("count") / block).cast("int")).drop("count")
    members = keys.join(shared, ["plan", "bits"])
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    members = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = members.select(
        "plan",
        "bits",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"),
        "fp",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group = ["plan", "bits", "i", "j"]
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = list(zip(*[batch.column(c).to_numpy().tolist() for c in group]))
            cut = next((n for n in range(len(ids) - 1, -1, -1) if ids[n] != ids[-1]), -1) + 1
            if cut == 0 and (last is None or last == ids[0]):
                held.append(batch)
            else:
                if cut == 0:  # a new group fills the batch
                    done, rest = held, [batch]
                else:
                    done, rest = [*held, batch.slice(0, cut)], [batch.slice(cut)]
                yield _group_edges(pa.Table.from_batches(done), distance, segments, firsts)
                held = rest
            last = ids[-1]
        if held:
            yield _group_edges(pa.Table.from_batches(held), distance, segments, firsts)

    groups = groups.repartition("plan", "bits", "i", "j").sortWithinPartitions("plan", "bits", "i", "j", "side")
    return groups.mapInArrow(run, "a bigint, b bigint").distinct()


def simhash_components(docs: DataFrame, width: int = 3, distance: int = 3, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Near-duplicate classes of ``docs`` by SimHash: ``doc_id, body_hash, fp, root, component_id``.

    One row for each row of ``docs``. ``root`` names the class (its smallest
    fingerprint), ``component_id`` is the smallest ``doc_id`` of the class, null
    if it has none. Null and empty texts have fingerprint zero and link like any
    other; repeated rows and equal texts share a fingerprint; a null ``doc_id``
    stays null; other columns are ignored; an empty table gives an empty result.
    """
    rows = materialize(with_fingerprints(docs, width), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = materialize(connected_components(fingerprint_edges(distinct, distance, segments, block)), "roots")
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(best, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "body_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class does: the smallest ``doc_id``, null ids last.

    Of repeated rows of that document one stays. All columns are returned as they were.
    """
    winners = (
        classes.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body_hash")).alias("w"), F.count("*").alias("n"))
        .select(F.col("w.doc_id").alias("w_id"), F.col("w.body_hash").alias("w_hash"))
    )
    repeats = classes.groupBy("doc_id", "body_hash").count().where("count > 1").select(F.col("doc_id").alias("r_id"), F.col("body_hash").alias("r_hash"))
    marked = winners.join(
        repeats, F.col("w_id").eqNullSafe(F.col("r_id")) & (F.col("w_hash") == F.col("r_hash")), "left"
    ).select(F.struct("w_id", "w_hash", F.col("r_hash").isNotNull().alias("many")).alias("__winner"))
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    joined = left.join(
        marked,
        F.col("__row.doc_id").cast("bigint").eqNullSafe(F.col("__winner.w_id")) & (text_hash("__row.text") == F.col("__winner.w_hash")),
    )
    from pyspark.sql import Window

    number = F.row_number().over(Window.partitionBy("__winner.w_id", "__winner.w_hash").orderBy(F.lit(0)))
    single = joined.where("not __winner.many").select("__row")
    many = joined.where("__winner.many").withColumn("__n", number).where("__n = 1").select("__row")
    return single.union(many).select("__row.*")
