"""Spelling variant grouping: words one edit apart, found in a trie of letter-group counts.

Letters fall into groups; a word's vector counts its letters by group. One edit
adds at most one to one count and takes at most one from another. Words are
arranged by the counts of one group after the other. A depth-first search for
all queries of a task goes down with a budget of one surplus and one deficit,
and what it reaches is verified letter by letter. The first levels of the trie
are the keys by which Spark deals words and queries over tasks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, partitions

#: The letters of a run, the share of runs that lose a letter, least length and count of a word, and how much more frequent a form is.
RUN = re.compile("[a-zÀ-ÿ]+")
LOSS, LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 97, 5, 3, 2
#: Number of letter groups (code point modulo it), and the order of the trie's levels: groups of frequent letters first.
GROUPS = 16
LEVELS = (5, 4, 1, 9, 15, 14, 3, 2, 12, 8, 0, 13, 7, 6, 11, 10)
#: Levels that deal words over tasks, and the most words and queries of a task (about, as they are dealt by hash).
DEPTH, TASK_WORDS, TASK_QUERIES = 3, 16_384, 65_536
#: Different words counted in a task before they are handed on.
COUNTED_WORDS = 500_000
#: Pairs of vectors that the search compares at once, and the longest words whose letters are compared in a matrix.
BLOCK_PAIRS, MATRIX_LETTERS = 8192, 40


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of all runs of letters of whole texts, some of which lose a letter by the checksum of id and run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            kept = {w: n for w, n in total.items() if len(w) >= LEAST_LENGTH}
            return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, body in zip(batch.column("doc_id"), batch.column("body")):
                start = zlib.crc32(b":" if doc_id.as_py() is None else b"%d:" % doc_id.as_py())
                for word, n in Counter(RUN.findall(body.as_py().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % LOSS == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    total[word] += n
                if len(total) > COUNTED_WORDS:
                    yield rows()
                    total.clear()
        yield rows()

    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body")).mapInArrow(run, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Words:
    """Words of a task with their vectors and letters."""

    def __init__(self, words: list[str]):
        self.words = words
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(words)), self.size)
        vectors = np.bincount(owner * GROUPS + letters % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
        self.vectors = np.ascontiguousarray(vectors[:, LEVELS].astype(np.int32))
        # letters from the front and from the back; a long word's rows stay empty
        width = MATRIX_LETTERS
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        short = (self.size <= width)[owner]
        self.front = np.zeros((len(words), width), dtype=np.uint16)
        self.back = np.zeros((len(words), width), dtype=np.uint16)
        self.front[owner[short], place[short]] = letters[short]
        self.back[owner[short], (self.size[owner] - 1 - place)[short]] = letters[short]


def _plain_near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[at:] == b[at + 1 :] if len(a) < len(b) else a[at + 1 :] == b[at + 1 :]


def verified(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs differ by exactly one inserted, deleted or replaced letter."""
    sa, sb = words.size[a], words.size[b]
    shorter = np.minimum(sa, sb)
    out = np.abs(sa - sb) <= 1
    long = out & (np.maximum(sa, sb) > MATRIX_LETTERS)
    check = np.flatnonzero(out & ~long)
    out[long] = [_plain_near(words.words[i], words.words[j]) for i, j in zip(a[long].tolist(), b[long].tolist())]
    width = MATRIX_LETTERS
    for at in range(0, len(check), 1 << 16):
        k = check[at : at + (1 << 16)]
        i, j, s = a[k], b[k], shorter[k]
        differ = words.front[i] != words.front[j]
        ahead = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        behind = words.back[i] != words.back[j]
        after = np.where(behind.any(axis=1), behind.argmax(axis=1), width)
        same = sa[k] == sb[k]
        # one replaced: what agrees before and behind is all but one letter; one more: it is all of the shorter word
        out[k] = np.where(same, ahead + after == s - 1, np.minimum(ahead, s) + np.minimum(after, s) >= s)
    return out


def search(words: Words, entries: np.ndarray, queries: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a query (place in ``queries``) and an entry whose vectors fit the budgets, by depth-first search below the DEPTH levels that are spent.

    ``surplus`` and ``deficit`` are what a query has left. An entry's vector may
    exceed the query's by the one and fall short by the other, over all levels.
    """
    vectors = words.vectors
    entries = entries[np.lexsort(vectors[entries].T[::-1])]
    tree, asked = vectors[entries], vectors[queries]
    stack = [(DEPTH, 0, len(entries), np.arange(len(queries)), surplus, deficit)]
    while stack:
        level, low, high, rows, more, less = stack.pop()
        if not len(rows):
            continue
        if level == GROUPS or len(rows) * (high - low) <= BLOCK_PAIRS or high - low <= 4:
            step = max(1, BLOCK_PAIRS * 16 // (high - low))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                gap = tree[None, low:high, level:] - asked[part][:, None, level:]
                up = np.maximum(gap, 0).sum(axis=2)
                down = up - gap.sum(axis=2)
                q, e = np.nonzero((up <= more[at : at + step, None]) & (down <= less[at : at + step, None]))
                if len(q):
                    yield part[q], entries[low + e]
            continue
        column = tree[low:high, level]
        bounds = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), high - low]
        mine = asked[rows, level]
        for first, last in zip(bounds, bounds[1:]):
            gap = column[first] - mine
            fits = (gap <= more) & (-gap <= less)
            if fits.any():
                gap = gap[fits]
                stack.append((level + 1, low + first, low + last, rows[fits], more[fits] - np.maximum(gap, 0), less[fits] - np.maximum(-gap, 0)))


def _near_in_task(table: pa.Table) -> pa.Table:
    """``word, n_near, best_n, best`` of the words of one task, from its entries and queries.

    A query of the entries' own part of the trie speaks for itself, as the other
    word of a pair asks too; one from another part speaks for both.
    """
    words = Words(table.column("word").to_pylist())
    n = table.column("n").to_numpy()
    role = table.column("role").to_numpy()
    surplus, deficit = table.column("surplus").to_numpy().astype(np.int32), table.column("deficit").to_numpy().astype(np.int32)
    entries, queries = np.flatnonzero(role == 0), np.flatnonzero(role > 0)
    left, right = [], []
    for q, e in search(words, entries, queries, surplus[queries], deficit[queries]):
        a = queries[q]
        near = verified(words, a, e)
        a, e = a[near], e[near]
        both = role[a] == 2
        left += [a, e[both]]
        right += [e, a[both]]
    names = ["word", "n_near", "best_n", "best"]
    if not left or not sum(map(len, left)):
        return pa.table([pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.string())], names)
    a, b = np.concatenate(left), np.concatenate(right)
    # a word may be an entry and a query here: one number for each different word
    distinct, number = np.unique(np.array(words.words, dtype=object), return_inverse=True)
    a, b_n, b = number[a], n[b], number[b]
    order = np.lexsort((b, -b_n, a))
    a, b, b_n = a[order], b[order], b_n[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    return pa.table(
        [pa.array(distinct[a[first]].tolist(), pa.string()), pa.array(np.diff(np.r_[first, len(a)])), pa.array(b_n[first]), pa.array(distinct[b[first]].tolist(), pa.string())], names
    )


def _prefix(word: Column) -> Column:
    """The word's counts of the first DEPTH groups of the trie's order."""
    letters = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))]
    groups = ["".join(x for x in letters if ord(x) % GROUPS == k) for k in LEVELS[:DEPTH]]
    return F.array(*[F.length(word) - F.length(F.translate(word, g, "")) for g in groups])


def _moves() -> list[tuple[list[int], int, int, int]]:
    """What a query adds to its prefix to reach another's, with the surplus and deficit it has left, and its role.

    Role 1 asks in its own part. Role 2 asks in parts whose first other count is
    one more; the pairs whose first other count is one less are those in turn.
    """
    moves = [([0] * DEPTH, 1, 1, 1)]
    for up in range(DEPTH):
        one = [int(k == up) for k in range(DEPTH)]
        moves.append((one, 0, 1, 2))
        for down in range(up + 1, DEPTH):
            moves.append(([x - (k == down) for k, x in enumerate(one)], 0, 0, 2))
    return moves


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of every row of ``word, n`` that has a word one edit away; ``word`` is unique.

    Parts of the trie with many words or queries are cut by hash into blocks, and
    every block of words meets every block of queries: nothing is left out, and
    a task holds about TASK_WORDS words and TASK_QUERIES queries.
    """
    spark = words.sparkSession
    words = materialize(words.select("word", "n", _prefix(F.col("word")).alias("prefix")), "words")
    moves = F.array(*[F.struct(F.array(*map(F.lit, m)).alias("by"), F.lit(s).alias("surplus"), F.lit(d).alias("deficit"), F.lit(r).alias("role")) for m, s, d, r in _moves()])
    asked = words.select("word", "n", "prefix", F.explode(moves).alias("m"))
    asked = asked.select("word", "n", F.zip_with("prefix", "m.by", lambda a, b: a + b).alias("prefix"), "m.surplus", "m.deficit", "m.role")
    sizes = words.groupBy("prefix").agg(F.count("*").alias("n_words"))
    counts = asked.groupBy("prefix").agg(F.count("*").alias("n_queries"))
    blocks = materialize(
        sizes.join(counts, "prefix").select(
            "prefix", F.ceil(F.col("n_words") / TASK_WORDS).cast("int").alias("word_blocks"), F.ceil(F.col("n_queries") / TASK_QUERIES).cast("int").alias("query_blocks")
        ),
        "blocks",
    )

    def dealt(rows: DataFrame, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        return rows.join(blocks, "prefix").select(
            "prefix",
            F.pmod(F.xxhash64("word"), F.col(own)).cast("int").alias(own_block),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_block),
            "word", "n", "surplus", "deficit", "role",
        )

    entries = words.select("*", F.lit(0).alias("surplus"), F.lit(0).alias("deficit"), F.lit(0).alias("role"))
    rows = dealt(entries, "word_blocks", "query_blocks", "word_block", "query_block").unionByName(dealt(asked, "query_blocks", "word_blocks", "query_block", "word_block"))
    keys = ["prefix", "word_block", "query_block"]
    rows = rows.repartition(partitions(spark), *keys)
    found = rows.groupBy(*keys).applyInArrow(_near_in_task, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of ``word, form``, by rounds that double the steps taken."""
    current = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialize(current.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        current = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return current


def spelling_groups(docs: DataFrame) -> DataFrame:
    """``word, n, form, form_n, root, n_near`` of every word of the texts: its frequent near word, and the end of the chain of those.

    Runs of letters are lower-cased (A to Z only) and, where the checksum of id
    and run says so, lose a letter. A null text has no runs; a null ``doc_id``
    stands as nothing before the colon; repeated rows count each; texts and words
    may have any length (letters of words over MATRIX_LETTERS are compared one by
    one); of near words that are equally frequent the smallest is the form; extra
    columns are ignored; an empty table gives no rows. A form is at least twice
    as frequent as its word, so chains end after as many steps as counts double.
    """
    words = materialize(count_words(docs), "counts")
    near = words.join(near_words(words), "word", "left")
    takes = F.col("best_n") >= FORM_RATIO * F.col("n")
    rows = materialize(
        near.select(
            "word", "n", F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n"), F.coalesce("n_near", F.lit(0)).alias("n_near")
        ),
        "near",
    )
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near")
