"""Quality rules as a short-circuit cascade, ordered by rejection per cost on a sample."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, text_hash

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
#: Words of a window that counts as repeated when it is found again.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: Documents, about, on which cost and selectivity of the rules are estimated.
SAMPLE_ROWS = 2000


@dataclass
class Features:
    """Base counts of a slice of texts, one entry a text; ``bodies`` are the whole texts."""

    bodies: list[bytes]
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_lines: np.ndarray
    n_repeat_words: np.ndarray


def _repeated(words: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Words inside windows that their text holds twice or more, by text. Exact: windows get dense ranks, not hashes."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(texts, dtype=np.int64)
    inside = owner[:n] == owner[WINDOW - 1 :]

    def ranked(key: np.ndarray) -> np.ndarray:
        return np.unique(key, return_inverse=True)[1].astype(np.int64)

    span = int(words.max()) + 1
    two = ranked(words[:-1] * span + words[1:])
    four = ranked(two[:-2] * (int(two.max()) + 1) + two[2:])
    five = ranked(four[: n] * span + words[WINDOW - 1 :])
    at = np.flatnonzero(inside)
    key = five[at] * texts + owner[at]
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    first = at[count[where] > 1]
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, first, 1)
    np.add.at(covered, first + WINDOW, -1)
    return np.bincount(owner[np.cumsum(covered[:-1]) > 0], minlength=texts)


def features(bodies: list[bytes]) -> Features:
    """Base counts of whole texts. Words are runs of anything but ASCII white space; lines are split at ``\\n``."""
    ids: dict[bytes, int] = {}
    words, n_words, word_chars, n_symbols, n_dup, n_lines = [], [], [], [], [], []
    for body in bodies:
        split = body.split()
        n_words.append(len(split))
        words += [ids.setdefault(w, len(ids)) for w in split]
        # code points: bytes but for continuation bytes, without the white space
        code = np.frombuffer(body, dtype=np.uint8)
        word_chars.append(int(np.count_nonzero((code & 0xC0) != 0x80)) - sum(body.count(bytes([s])) for s in SPACE))
        n_symbols.append(sum(body.count(bytes([s])) for s in SYMBOLS))
        lines = [x for x in body.split(b"\n") if x.strip()]
        n_lines.append(len(lines))
        n_dup.append(len(lines) - len(set(lines)))
    counts = np.array(n_words, dtype=np.int64)
    owner = np.repeat(np.arange(len(bodies)), counts)
    repeated = _repeated(np.array(words, dtype=np.int64), owner, len(bodies))
    return Features(bodies, counts, *(np.array(x, dtype=np.int64) for x in (word_chars, n_symbols, n_dup, n_lines)), repeated)


@dataclass(frozen=True)
class Rule:
    """``rejects(features, rows)`` says which of the chosen rows of a slice a rule rejects."""

    name: str
    rejects: Callable[[Features, np.ndarray], np.ndarray]


def _capitals(f: Features, rows: np.ndarray) -> np.ndarray:
    """Shouting: over 60 % of the ASCII letters are capitals, of 50 letters or more."""
    out = []
    for k in rows:
        code = np.frombuffer(f.bodies[k], dtype=np.uint8)
        upper = np.count_nonzero((code >= 65) & (code <= 90))
        lower = np.count_nonzero((code >= 97) & (code <= 122))
        out.append(upper + lower >= 50 and 10 * upper > 6 * (upper + lower))
    return np.array(out, dtype=bool)


_MARKS = re.compile(rb"[!?.]{2,}")


def _shouts(f: Features, rows: np.ndarray) -> np.ndarray:
    """Runs of end marks in over 15 % of the words."""
    runs = np.array([len(_MARKS.findall(f.bodies[k])) for k in rows])
    return 100 * runs > 15 * f.n_words[rows]


def _few_letters(f: Features, rows: np.ndarray) -> np.ndarray:
    """Under 40 % of the characters of words are letters, taking every byte beyond ASCII for one."""
    out = []
    for k in rows:
        code = np.frombuffer(f.bodies[k], dtype=np.uint8)
        folded = code | 0x20
        letters = np.count_nonzero(((folded >= 97) & (folded <= 122)) | (code >= 0xC0))
        out.append(100 * letters < 40 * f.word_chars[k])
    return np.array(out, dtype=bool)


#: Rules beside the base rule. Each is a function of the text alone, so their order changes the work and not the verdict.
RULES = (
    Rule("word_length", lambda f, r: (f.word_chars[r] > 20 * f.n_words[r]) | (f.word_chars[r] < 2 * f.n_words[r])),
    Rule("symbols", lambda f, r: 100 * f.n_symbols[r] > 30 * f.n_words[r]),
    Rule("duplicate_lines", lambda f, r: 100 * f.n_dup_lines[r] > 70 * f.n_lines[r]),
    Rule("few_letters", _few_letters),
    Rule("capitals", _capitals),
    Rule("shouts", _shouts),
)


def base_failed(f: Features) -> np.ndarray:
    return (f.n_words < MIN_WORDS) | (100 * f.n_repeat_words > MAX_REPEATED_PERCENT * f.n_words)


def verdicts(f: Features, ordered: list[Rule]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``kept``, the name of the rejecting rule (or None) and ``base_failed`` of every text; each rule sees what is left."""
    failed = base_failed(f)
    why = np.where(failed, "base", None).astype(object)
    left = np.flatnonzero(~failed)
    for rule in ordered:
        if not len(left):
            break
        hit = rule.rejects(f, left)
        why[left[hit]] = rule.name
        left = left[~hit]
    kept = np.zeros(len(failed), dtype=bool)
    kept[left] = True
    return kept, why, failed


def _bodies(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_hash("text").alias("body_hash"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"),
    )


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejected documents per second, highest first, on about ``sample_rows`` random documents.

    Each rule is timed and counted on all sampled documents that pass the base
    rule; ties and an empty sample keep the given order.
    """
    total = docs.count()
    if not total:
        return [r.name for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, hits = np.zeros(len(rules)), np.zeros(len(rules), dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                f = features(part.column("body").to_pylist())
                rows = np.flatnonzero(~base_failed(f))
                for k, rule in enumerate(rules):
                    began = time.perf_counter()
                    hits[k] += int(np.count_nonzero(rule.rejects(f, rows)))
                    spent[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array([r.name for r in rules]), pa.array(spent), pa.array(hits)], ["rule", "seconds", "hits"])

    sample = _bodies(docs.sample(min(1.0, sample_rows / total), seed=11))
    found = sample.mapInArrow(run, "rule string, seconds double, hits bigint").groupBy("rule").agg(F.sum("seconds").alias("s"), F.sum("hits").alias("h"))
    rate = {r["rule"]: r["h"] / max(r["s"], 1e-9) for r in found.collect()}  # a row a rule
    return sorted((r.name for r in rules), key=lambda name: -rate.get(name, 0.0))


RESULT = (
    "doc_id bigint, body_hash bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, rejected_by string, kept boolean"
)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base counts and verdict of every row of ``docs``, over whole texts.

    Base counts are computed for all rows. Documents that pass the base rule
    (10 words, at most 20 % repeated words) go through the cascade, in the order
    that :func:`cascade_order` finds: each rule sees only what those before it
    let pass, so ``rejected_by`` is the first rule in that order while ``kept``
    depends on no order. A null text has no words and fails the base rule;
    repeated rows are judged each; a null ``doc_id`` stays null; other columns
    are ignored; an empty table gives an empty result.
    """
    order = cascade_order(docs, rules, sample_rows)
    by_name = {r.name: r for r in rules}
    ordered = [by_name[name] for name in order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                f = features(part.column("body").to_pylist())
                kept, why, failed = verdicts(f, ordered)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("body_hash"),
                        *(pa.array(x) for x in (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words)),
                        pa.array(failed),
                        pa.array(why.tolist(), pa.string()),
                        pa.array(kept),
                    ],
                    [c.split()[0] for c in RESULT.split(", ")],
                )

    return _bodies(docs).mapInArrow(run, RESULT)


def passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all columns as they were. No shuffle: whole rows pass by the rules."""
    order = cascade_order(docs, rules, sample_rows)
    by_name = {r.name: r for r in rules}
    ordered = [by_name[name] for name in order]
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                bodies = part.column(at).cast(pa.binary()).fill_null(b"").to_pylist()
                yield part.filter(pa.array(verdicts(features(bodies), ordered)[0]))

    return docs.mapInArrow(run, docs.schema)
