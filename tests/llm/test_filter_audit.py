"""Filter audit: the transducer against plain Python, the audit against a document-by-document simulation, and awkward tables."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def plain_audit(rows, labels):
    """Every document goes through every order of filters."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    out, removed_by = Counter(), Counter()
    parts = {s or "" for *_, s in rows}
    for doc, text, source in rows:
        n, distinct, capitals, points, symbols = plain_counts(text or "")
        fails = {"A": n < 50, "B": 100 * distinct < 65 * n, "C": 100 * capitals > 5 * points, "D": symbols > 0, "E": doc is not None and doc > least[text or ""]}
        part = source or ""
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, "".join(order), step)
                if fails[f] and gone:
                    out[*key, "redundant"] += 1
                if fails[f] and sum(fails.values()) == 1:
                    out[*key, "unique_fails"] += 1
                if fails[f] and not gone:
                    gone = True
                    out[*key, "removed"] += 1
                    out[*key, "good_lost"] += doc in good
                    out[*key, "toxic_lost"] += doc in toxic
                    removed_by[part, f] += 1
                out[*key, "kept"] += not gone
    return sorted(
        (p, "".join(o), k, *(out[p, "".join(o), k, c] for c in COLUMNS[3:9]), removed_by[p, o[k - 1]]) for p in parts for o in permutations("ABCDE") for k in range(1, 6)
    )


@pytest.mark.parametrize("limit", [filter_audit.PASS_BYTES, 700])
def test_counts_equal_plain_python(limit, monkeypatch):
    monkeypatch.setattr(filter_audit, "PASS_BYTES", limit)
    draw = random.Random(1)
    alphabet = " \t\nabAB#|é中😀x\x85\x1c"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.choice([0, 1, 2, 5, 30, 300, 5000]))) for _ in range(600)]
    texts += ["", " ", "word éé " * 10, "longwordlongword longwordlongwore longwordlongword", "a" * 9000 + " " + "a" * 9000 + " b", "x y " * 5000, " " * 7000]
    texts += ["12345678 1234567 123456789 12345678 123456789", "é" * 4 + " " + "é" * 5 + " " + "é" * 4]
    assert filter_audit.count_texts([t.encode() for t in texts]).tolist() == [plain_counts(t) for t in texts]


def test_transducer_takes_bytes_that_are_no_utf8():
    code = np.frombuffer(b"a\x80\xff\xe4\xb8 \xe4\xb8\xad\xf0\x9f\x98\x80\xc3", dtype=np.uint8)
    out = filter_audit.transduce(code)
    assert ((out & filter_audit.POINT) > 0).tolist() == [True, True, True, True, False, True, True, False, False, True, False, False, False, True]
    assert np.flatnonzero(out & filter_audit.START).tolist() == [0, 6] and np.flatnonzero(out & filter_audit.STOP).tolist() == [5]


def test_spans_are_told_apart_by_bytes_and_owner():
    line = b"aaaaaaaab aaaaaaaac aaaaaaaab a b a" + b" " * 8
    code = np.frombuffer(line, dtype=np.uint8)
    out = filter_audit.transduce(code)
    start, stop = np.flatnonzero(out & 1), np.flatnonzero(out & 2)
    first = filter_audit.distinct_spans(code, start, stop, np.zeros(len(start), dtype=np.int64))
    assert first.sum() == 4
    assert filter_audit.distinct_spans(code, start, stop, np.arange(len(start))).all()


ROWS = [
    (1, "Clean words " + " ".join(f"w{k}" for k in range(60)), "a"),
    (2, "Clean words " + " ".join(f"w{k}" for k in range(60)), "b"),
    (3, "same " * 60, "a"),
    (4, "SHOUT #1 " * 30, "a"),
    (5, None, None),
    (6, "", ""),
    (7, "few words", "b"),
    (7, "few words", "b"),
    (None, "few words", "b"),
    (8, "| " + " ".join(f"w{k}" for k in range(60)), "a"),
]
LABELS = [(1, 1, 0), (3, 1, 0), (3, 0, 1), (4, 0, 1), (7, 1, None), (None, 1, 1), (99, 1, 1)]


def test_audit_equals_simulation(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string")
    for name in ("part", "fails", "n", "digest", "least", "step", "good"):
        docs = docs.withColumn(name, F.lit("clash"))
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int").withColumn("good", F.lit("clash"))
    got = filter_audit.audit(docs.repartition(3), labels).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == plain_audit(ROWS, LABELS)


def test_awkward_and_empty(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    got = filter_audit.audit(awkward, labels).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == plain_audit(rows, [(4, 1, 1)])
    assert filter_audit.audit(empty, labels).count() == 0
    assert filter_audit.audit(awkward, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0
