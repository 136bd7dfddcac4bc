"""Filter interaction audit: what each of five text filters removes, in every order of them.

A table-driven byte transducer reads each text once. Its states are the bytes
that a UTF-8 sequence still needs, inside or outside a word; its output marks
word starts and ends, capitals, code points and symbols. The spans between word
starts and ends go into a hash table whose hits are verified byte by byte, which
counts distinct words. Numpy drives the table over thousands of places of the
text at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: The filters, their limits and characters.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITAL_PERCENT = 50, 65, 5
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#$%&*|"
#: Output of the transducer at a byte.
START, STOP, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8, 16
#: Places of a text that advance together, bytes that settle the state before a place, bytes of text read at once.
LANES, SETTLE, PASS_BYTES = 4096, 4, 2 << 20


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each byte; next state (times the number of classes) and output by state and class.

    A state is twice the bytes still needed, plus one inside a word. A byte that
    continues nothing, or is none of UTF-8, counts as a code point.
    """
    space, capital, symbol, other, follow, lead2, lead3, lead4 = range(8)
    classes = np.full(256, other, dtype=np.uint8)
    for chosen, kind in ((SPACES, space), (range(65, 91), capital), (SYMBOLS, symbol), (range(0x80, 0xC0), follow), (range(0xC2, 0xE0), lead2), (range(0xE0, 0xF0), lead3), (range(0xF0, 0xF5), lead4)):
        classes[list(chosen)] = kind
    after, output = np.zeros(64, dtype=np.uint8), np.zeros(64, dtype=np.uint8)
    for needed in range(4):
        for inside in range(2):
            for kind in range(8):
                k = (2 * needed + inside) * 8 + kind
                goes_on = kind == follow and needed > 0
                left = needed - 1 if goes_on else {lead2: 1, lead3: 2, lead4: 3}.get(kind, 0)
                after[k] = (2 * left + (kind != space)) * 8
                output[k] = 0 if goes_on else POINT
                output[k] |= {capital: CAPITAL, symbol: SYMBOL}.get(kind, 0)
                output[k] |= STOP if kind == space and inside else START if kind != space and not inside else 0
    return classes, after, output


CLASSES, AFTER, OUTPUT = _tables()
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def transduce(code: np.ndarray) -> np.ndarray:
    """Output at every byte, read from outside a word. The bytes are read at LANES places at once.

    The state at a place depends on the SETTLE bytes before it at most, so each
    place settles on those first.
    """
    steps = max(SETTLE, -(-len(code) // LANES))
    lanes = -(-len(code) // steps)
    padded = np.full(lanes * steps, 32, dtype=np.uint8)
    padded[: len(code)] = code
    kinds = np.ascontiguousarray(CLASSES[padded].reshape(lanes, steps).T)
    state = np.zeros(lanes, dtype=np.uint8)
    for t in range(steps - SETTLE, steps):
        state[1:] = AFTER[state[1:] + kinds[t, :-1]]
    for t in range(steps):
        kinds[t] += state
        state = AFTER[kinds[t]]
    return np.ascontiguousarray(OUTPUT[kinds].T).reshape(-1)[: len(code)]


def distinct_spans(code: np.ndarray, start: np.ndarray, stop: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which spans are the first entered of their bytes and owner: a hash table with open addresses, its hits verified.

    ``code`` has 8 bytes more than the last span needs. All spans are entered
    together: each claims its slot, compares itself with the span that has it,
    byte by byte, and moves to the next slot where they differ.
    """
    size = stop - start
    eight = np.ndarray((len(code) - 7,), dtype="<u8", buffer=code, strides=(1,))
    head = eight[start] & _MASKS[np.minimum(size, 8)]
    mix = np.uint64(0x9E3779B97F4A7C15)
    key = (head ^ (owner.astype(np.uint64) << np.uint64(32)) ^ size.astype(np.uint64)) * mix
    longer = np.flatnonzero(size > 8)
    at = 8
    while longer.size:
        part = eight[start[longer] + at] & _MASKS[np.minimum(size[longer] - at, 8)]
        key[longer] = ((key[longer] ^ (key[longer] >> np.uint64(29))) + part) * mix
        at += 8
        longer = longer[size[longer] > at]
    key ^= key >> np.uint64(32)
    slots = 1 << max(4, int(2 * len(start)).bit_length())
    table = np.full(slots, -1, dtype=np.int64)
    slot = (key & np.uint64(slots - 1)).astype(np.int64)
    waiting, first = np.arange(len(start)), np.zeros(len(start), dtype=bool)
    while waiting.size:
        free = table[slot[waiting]] < 0
        table[slot[waiting[free]]] = waiting[free]
        holder = table[slot[waiting]]
        same = (head[holder] == head[waiting]) & (size[holder] == size[waiting]) & (owner[holder] == owner[waiting])
        check, at = np.flatnonzero(same & (size[waiting] > 8)), 8
        while check.size:
            a, b = waiting[check], holder[check]
            mask = _MASKS[np.minimum(size[a] - at, 8)]
            differ = (eight[start[a] + at] & mask) != (eight[start[b] + at] & mask)
            same[check[differ]] = False
            at += 8
            check = check[~differ & (size[a] > at)]
        first[waiting[holder == waiting]] = True
        waiting = waiting[~same]
        slot[waiting] = (slot[waiting] + 1) & (slots - 1)
    return first


def _pass(texts: list[bytes]) -> tuple[np.ndarray, bytes]:
    """``words, distinct words, capitals, code points, symbols`` of each text, and the last text's distinct words, a blank behind each."""
    line = b" ".join([*texts, b" " * 8])
    code = np.frombuffer(line, dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    out = transduce(code[: ends[-1]])
    starts = np.concatenate(([0], ends[:-1]))
    counts = [np.add.reduceat((out & bit) > 0, starts, dtype=np.int64) for bit in (START, CAPITAL, POINT, SYMBOL)]
    counts[2] -= 1  # the blank behind each text
    start, stop = np.flatnonzero(out & START), np.flatnonzero(out & STOP)
    owner = np.repeat(np.arange(len(texts)), counts[0])
    first = distinct_spans(code, start, stop, owner)
    distinct = np.bincount(owner[first], minlength=len(texts))
    words = b""
    if len(texts) == 1 and len(texts[0]) > PASS_BYTES:
        words = b"".join(line[i : j + 1] for i, j in zip(start[first].tolist(), stop[first].tolist()))
    return np.stack([counts[0], distinct, *counts[1:]], axis=1), words


def _long(text: bytes) -> np.ndarray:
    """The counts of a text of any length, from passes over its parts, cut behind white space; distinct words of the parts are entered again."""
    total, words, at = np.zeros(5, dtype=np.int64), b"", 0
    while at < len(text):
        end = at + 2 * PASS_BYTES
        if end < len(text):
            cut = max(text.rfind(bytes([s]), at, end) for s in SPACES)
            if cut < 0:  # a word longer than a part
                found = [k for k in (text.find(bytes([s]), end) for s in SPACES) if k >= 0]
                cut = min(found, default=len(text) - 1)
            end = cut + 1
        counts, mine = _pass([text[at:end]])
        total += counts[0]
        words += mine if mine else text[at:end] + b" "
        at = end
        if len(words) > 4 * PASS_BYTES:
            kept = _pass([words])[1]
            words = kept or words
    total[1] = _pass([words])[0][0, 1]
    return total


def count_texts(texts: list[bytes]) -> np.ndarray:
    """``words, distinct words, capitals, code points, symbols`` of each text, a row a text."""
    out = np.zeros((len(texts), 5), dtype=np.int64)
    batch: list[int] = []
    size = 0
    for k, text in enumerate([*texts, None]):
        if text is not None and len(text) > PASS_BYTES:
            out[k] = _long(text)
            continue
        if batch and (text is None or size + len(text) > PASS_BYTES):
            out[batch] = _pass([texts[j] for j in batch])[0]
            batch, size = [], 0
        if text is not None:
            batch.append(k)
            size += len(text)
    return out


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, n_words, n_distinct, n_capitals, n_points, n_symbols`` of every row, over whole texts."""
    names = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_texts(batch.column("body").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "part", "digest")), *(pa.array(counts[:, k]) for k in range(5))], ["doc_id", "part", "digest", *names]
            )

    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        body.alias("body"),
    )
    return rows.mapInArrow(run, "doc_id bigint, part string, digest binary, " + ", ".join(f"{n} bigint" for n in names))


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, fails``: the letters of the filters that each row fails, in order.

    A: under 50 words; B: distinct words under 65 % of the words; C: capitals
    over 5 % of the code points; D: a symbol; E: the text of a row with a smaller
    ``doc_id``. Equal texts are those of equal SHA-256. The smallest ids are a
    written table, so adaptive execution can split the rows of a frequent text.
    """
    rows = materialize(measured(docs), "measured")
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").select("digest", "least")
    rows = rows.join(materialize(least, "least"), "digest", "left")
    fails = [
        ("A", F.col("n_words") < LEAST_WORDS),
        ("B", 100 * F.col("n_distinct") < LEAST_DISTINCT_PERCENT * F.col("n_words")),
        ("C", 100 * F.col("n_capitals") > MOST_CAPITAL_PERCENT * F.col("n_points")),
        ("D", F.col("n_symbols") > 0),
        ("E", F.col("doc_id") > F.col("least")),
    ]
    return rows.select("doc_id", "part", F.concat(*[F.when(test, name).otherwise("") for name, test in fails]).alias("fails"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each place of each order, by part (``source``, null as empty string).

    A row per part, order and step: ``kept`` after the step, ``removed`` at it,
    ``redundant`` (fail its filter, removed earlier), ``unique_fails`` (fail its
    filter alone), ``good_lost`` and ``toxic_lost`` (removed, with such a label),
    ``shapley`` (removed by its filter, over all orders).

    A null text counts as empty: it has no words and fails A. Texts of any length
    are read in passes. Ties need no order: rows are counted. Rows that repeat an
    id and a text are counted each, and none is a copy of the other by E; a row
    with a null id is no copy and makes none, and has no label. A document with
    several labels is good or toxic if one says so. Extra columns are ignored.
    An empty table gives no rows. Documents are reduced to a count by part,
    failed filters and label before orders are looked at, which then are 120 x 5
    rows for each of at most 32 sets of filters.
    """
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    counts = (
        failures(docs)
        .join(marks, "doc_id", "left")
        .groupBy("part", "fails")
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    )
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = counts.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    steps = steps.selectExpr(
        "part", "filter_order", "step", "n", "good", "toxic", "fails",
        "contains(fails, substr(filter_order, step, 1)) as hit",
        "translate(left(filter_order, step - 1), fails, '') = left(filter_order, step - 1) as here",
    )

    def total(value: str, when: str) -> Column:
        return F.expr(f"sum(case when {when} then {value} else 0 end)").cast("bigint")

    return steps.groupBy("part", "filter_order", "step").agg(
        total("n", "here and not hit").alias("kept"),
        total("n", "here and hit").alias("removed"),
        total("n", "hit and not here").alias("redundant"),
        total("n", "hit and length(fails) = 1").alias("unique_fails"),
        total("good", "here and hit").alias("good_lost"),
        total("toxic", "here and hit").alias("toxic_lost"),
        total("n * (120 div length(fails))", "hit").alias("shapley"),
    )
