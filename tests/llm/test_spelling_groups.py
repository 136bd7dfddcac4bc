"""Spelling groups against brute force: words by deletion neighbourhoods in plain Python, no trie."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, spelling_groups
from tidemark.llm.spelling_groups import _plain_near

COLUMNS = ["word", "n", "form", "form_n", "root", "n_near"]


def plain_words(rows):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def near_pairs(words):
    """All pairs one edit apart meet in a word with one letter less."""
    meet = defaultdict(set)
    for w in words:
        meet[w].add(w)
        for k in range(len(w)):
            meet[w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for group in meet.values():
        for a in group:
            for b in group:
                if a < b and plain_distance_one(a, b):
                    near[a].add(b)
                    near[b].add(a)
    return near


def plain_distance_one(a, b):
    """The textbook table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1] == 1


def plain_groups(rows):
    words = plain_words(rows)
    near = near_pairs(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, form[w], words.get(form[w]), root, len(near[w])))
    return sorted(out)


def groups(docs):
    return sorted(map(tuple, spelling_groups.spelling_groups(docs).select(COLUMNS).collect()))


def messy(draw, count):
    stems = ["colour", "colouring", "naïveté", "theatre", "abcdefgh", "aaaaaa", "aaaaaaa", "ÿÿÿÿÿ", "×÷×÷×"]
    out = []
    for _ in range(count):
        w = list(draw.choice(stems))
        for _ in range(draw.choice([0, 0, 0, 1, 1, 2])):
            k, c = draw.randrange(len(w)), draw.choice("abeéu")
            kind = draw.randrange(3)
            w[k : k + (kind > 0)] = [c] if kind < 2 else []
        out.append("".join(w))
    return out


def test_groups_equal_brute_force(spark):
    draw = random.Random(4)
    rows = [(k, " ".join(messy(draw, 60))) for k in range(120)]
    rows += [(None, "Colour COLOUR colour coloür İstanbul"), (7, None), (7, ""), (8, "long" * 40 + " " + "long" * 39 + "lon" + " x"), (9, ("z" * 50 + " " + "z" * 49 + "y ") * 3)]
    rows += [(500 + k, "q" * 70 + " " + "q" * 71 + " " + "q" * 40 + " " + "q" * 41) for k in range(4)] + [(7, "colour " * 30)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("word", "n", "prefix", "form", "root", "role", "best", "body"):
        docs = docs.withColumn(name, F.lit("clash"))
    want = plain_groups(rows)
    assert any(r[4] != r[0] and r[4] != r[2] for r in want)  # a chain of two forms
    assert groups(docs.repartition(5)) == want


def test_small_blocks_find_the_same(spark, monkeypatch):
    """Blocks of ten words and twenty queries: every block of words meets every block of queries."""
    draw = random.Random(6)
    words = spark.createDataFrame([(w, n) for w, n in Counter(messy(draw, 3000)).items()], "word string, n bigint")
    plain = {r.word: r.n for r in words.collect()}
    near = near_pairs(plain)
    want = sorted((w, len(x), max(plain[y] for y in x), min(x, key=lambda y: (-plain[y], y))) for w, x in near.items() if x)
    for limits in ((16_384, 65_536), (10, 20)):
        monkeypatch.setattr(spelling_groups, "TASK_WORDS", limits[0])
        monkeypatch.setattr(spelling_groups, "TASK_QUERIES", limits[1])
        got = spelling_groups.near_words(words).select("word", "n_near", "best_n", "best").collect()
        assert sorted(map(tuple, got)) == want


def test_search_reaches_what_fits_the_budgets(monkeypatch):
    draw = random.Random(8)
    words = sorted(set(messy(draw, 400)))
    made = spelling_groups.Words(words)
    everything = np.arange(len(words))
    ones = np.ones(len(words), dtype=np.int32)
    monkeypatch.setattr(spelling_groups, "DEPTH", 0)
    for limit in (8192, 1):
        monkeypatch.setattr(spelling_groups, "BLOCK_PAIRS", limit)
        got = {(int(a), int(b)) for q, e in spelling_groups.search(made, everything, everything, ones, ones) for a, b in zip(q, e)}
        gap = made.vectors[None, :, :] - made.vectors[:, None, :]
        fits = (np.maximum(gap, 0).sum(axis=2) <= 1) & (np.maximum(-gap, 0).sum(axis=2) <= 1)
        assert got == set(zip(*map(lambda x: x.tolist(), np.nonzero(fits))))


@pytest.mark.parametrize("limit", [40, 6])
def test_verified_is_the_edit_distance(monkeypatch, limit):
    monkeypatch.setattr(spelling_groups, "MATRIX_LETTERS", limit)
    draw = random.Random(9)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(5, 8))) for _ in range(250)]
    made = spelling_groups.Words(words)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(250), np.arange(250)))
    got = spelling_groups.verified(made, a, b)
    want = [plain_distance_one(words[i], words[j]) for i, j in zip(a, b)]
    assert got.tolist() == want and want == [_plain_near(words[i], words[j]) for i, j in zip(a, b)]


def test_awkward_and_empty(awkward, empty):
    assert groups(awkward) == plain_groups([(r.doc_id, r.text) for r in awkward.collect()])
    assert groups(empty) == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_spelling_groups"](spark, folder).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == plain_groups([tuple(r) for r in rows])
