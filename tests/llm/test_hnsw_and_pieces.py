import itertools
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import hnsw, piece_codec


def brute_links(rows, least):
    """``n_links`` and smallest reachable id of each row, by all pairs in double precision."""
    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    n = len(rows)
    unit = [hnsw._unit(np.array([v], dtype=np.float64))[0] if fine(v) else None for _, v in rows]
    links, parent = [0] * n, list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, j in itertools.combinations(range(n), 2):
        if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
            links[i] += 1
            links[j] += 1
            parent[find(i)] = find(j)
    least_id = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least_id[find(i)] = min(least_id.get(find(i), k), k)
    return [(rows[i][0], links[i], least_id.get(find(i))) for i in range(n)]


def test_links_equal_brute_force(spark, awkward):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + rng.normal(size=16) * (0.02 if i % 3 else 0.15)).astype(np.float32).tolist()) for i in range(400)]
    hot = (rng.normal(size=16)).astype(np.float32)
    rows += [(1000 + i, (hot + rng.normal(size=16) * 0.01).astype(np.float32).tolist()) for i in range(150)]
    rows += [(2000 + i, hot.tolist()) for i in range(50)]
    nan, inf = float("nan"), float("inf")
    rows += [
        (3000, None), (3001, [0.0] * 16), (3002, [nan] + [1.0] * 15), (3003, [inf] + [1.0] * 15), (3004, [None] + [1.0] * 15), (3005, []),
        (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [1e-30] * 16), (3009, [1e30] * 16), (3010, [-0.0] * 15 + [1.0]), (3011, [0.0] * 15 + [1.0]),
        (5, rows[5][1]), (None, rows[7][1]), (None, None),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("class_id", F.lit("clash")).withColumn("label", F.lit(1)).repartition(4)
    got = hnsw.near_vectors(df, 0.95, shards=3)
    want = [(k, n, c) for k, n, c in brute_links([(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows], 0.95)]
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got.collect()), key=str) == sorted(want, key=str)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect() if r.vec_id is not None)
    assert hnsw.near_vectors(df.limit(0)).collect() == []
    assert [tuple(r) for r in hnsw.near_vectors(df.where("vec_id = 3000")).collect()] == [(3000, 0, 3000, True)]


def test_recall_of_a_graph_against_brute_force():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 32))
    unit = hnsw._unit(np.concatenate([base + rng.normal(size=base.shape) * 0.08 for _ in range(10)]))
    graph, order = hnsw.Graph.build(unit, np.arange(len(unit)))
    assert len(graph.layers) > 1
    graph, raw = hnsw.Graph.from_bytes(graph.to_bytes(unit[order]))
    assert (raw == unit[order]).all()
    q, n = graph.within(unit, 0.95, hnsw.FIRST_BEAM)
    found = set(zip(q.tolist(), order[n].tolist()))
    truth = set(zip(*(x.tolist() for x in np.nonzero(unit @ unit.T >= 0.95))))
    assert len(found & truth) >= 0.98 * len(truth)


def test_tight_groups_are_found_whole_at_a_fixed_beam():
    """Lists that are chosen anew drop links; every node is still reached, on every layer, and found by those it links with."""
    rng = np.random.default_rng(7)
    groups = [rng.normal(size=(1, 64)) + rng.normal(size=(200, 64)) * 0.01 for _ in range(2)]
    unit = hnsw._unit(np.concatenate([rng.normal(size=(2600, 64)), *groups]))
    graph, _ = hnsw.Graph.build(unit, np.arange(len(unit)))
    for table in graph.layers:
        reached, front = {0}, [0]
        while front:
            front = [k for k in set(table[front].ravel().tolist()) if k >= 0 and k not in reached]
            reached.update(front)
        assert len(reached) == len(table)
    assert np.bincount(graph.layers[0][graph.layers[0] >= 0], minlength=len(unit)).min() >= 1
    asked = np.arange(2600, 3000)
    q, _ = graph.within(unit[asked], 0.95, hnsw.FIRST_BEAM)
    truth = (unit[asked] @ unit.T >= 0.95).sum(axis=1)
    assert (np.bincount(q, minlength=len(asked)) >= truth).mean() >= 0.99


def test_lost_nodes_are_mended():
    """A layer whose links lead nowhere becomes one in which a walk from the first node meets all."""
    rng = np.random.default_rng(8)
    vectors = hnsw._unit(rng.normal(size=(50, 8))).astype(np.float32)
    graph = hnsw.Graph(vectors, [])
    table = np.full((50, 4), -1, dtype=np.int32)
    table[10:, 0] = 3  # all lead to one node, from which nothing leads on
    mended = graph._mended(table)
    assert (mended[:, :4] == table).all()
    reached, front = {0}, [0]
    while front:
        front = [k for k in set(mended[front].ravel().tolist()) if k >= 0 and k not in reached]
        reached.update(front)
    assert len(reached) == 50


def test_beams_widen_over_a_large_group():
    rng = np.random.default_rng(4)
    unit = hnsw._unit(np.concatenate([rng.normal(size=(500, 16)), rng.normal(size=(1, 16)) + rng.normal(size=(700, 16)) * 0.01]))
    graph, order = hnsw.Graph.build(unit, np.arange(len(unit)))
    q, n = graph.within(unit[500:510], 0.95, 8)
    assert np.bincount(q, minlength=10).min() >= 690


def test_audit_is_never_empty(spark):
    """Without any link the nearest others are asked for, and the beam widens until they are found."""
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(4000, 64)).astype(np.float32))]
    _, classes = hnsw.vector_classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    classes = hnsw.materialize(classes, "test-classes")
    queries, truth = hnsw.draw_audit(classes, 4000, 0.95, most=600)
    assert len(truth) == queries.count() == 600 and not any(r.links for r in truth) and all(len(r.near) == hnsw.NEAREST for r in truth)
    index = hnsw.build_index(classes, 2)
    assert hnsw.beam_recall(index, queries, truth, 2, 0.95, hnsw.FIRST_BEAM)[1] < hnsw.AUDIT_RECALL
    width = hnsw.audited_beam(index, classes, 2, 4000, 0.95)
    assert width > hnsw.FIRST_BEAM
    assert hnsw.beam_recall(index, queries, truth, 2, 0.95, width)[1] >= hnsw.AUDIT_RECALL - 0.01
    assert hnsw.beam_recall(index, queries, truth, 2, 0.95, 4000) == (1.0, 1.0)


def test_audit_counts_vectors_and_draws_on_for_links(spark):
    """A group of a thousand links a member doesn't outvote vectors with one link."""
    rng = np.random.default_rng(6)
    single = rng.normal(size=(900, 16))
    hot = rng.normal(size=16) + rng.normal(size=(300, 16)) * 0.01
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((single, single[:60] + rng.normal(size=(60, 16)) * 0.01, hot)))]
    _, classes = hnsw.vector_classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    classes = hnsw.materialize(classes, "test-classes")
    queries, truth = hnsw.draw_audit(classes, len(rows), 0.95, rows=40, linked=200)
    assert len(truth) > 40 and sum(r.links > 0 for r in truth) >= 200 and queries.count() == len(truth)
    unit = hnsw._unit(np.array([r.v for r in classes.orderBy("class_id").collect()]))
    ids = [r.class_id for r in classes.orderBy("class_id").collect()]
    cosines = unit @ unit.T
    np.fill_diagonal(cosines, -1)
    for r in truth:
        mine = np.sort(cosines[ids.index(r.a)])[::-1]
        assert r.links == (mine >= 0.95).sum() and r.near == pytest.approx(mine[: hnsw.NEAREST].tolist())
    index = hnsw.build_index(classes.where(F.col("class_id").isin([r.a for r in truth if r.links > 100])), 1)
    whole, _ = hnsw.beam_recall(index, queries, truth, 1, 0.95, 4000)
    linked = [r for r in truth if r.links]
    assert whole <= sum(r.links > 100 for r in linked) / len(linked) < 0.99


# --------------------------------------------------------------------- pieces


def brute_best(word, table, unknown):
    keys = {p: s for p, s in zip(table.pieces, table.scores.tolist())}
    best = None
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate((*cuts, 1), 1):
            if c:
                parts.append(word[at:i])
                at = i
        if any(p not in keys and len(p) > 1 for p in parts):
            continue
        score = sum(keys.get(p, unknown) for p in parts)
        best = score if best is None else max(best, score)
    return best


def test_viterbi_finds_the_best_path():
    pieces = ["a", "b", "ab", "ba", "aba", "bb", "abab", "c"]
    rng = random.Random(1)
    table = piece_codec.PieceTable(pieces, [-rng.random() * 5 for _ in pieces], list(range(len(pieces))))
    for n in range(1, 9):
        words = ["".join(rng.choice("abcx") for _ in range(n)) for _ in range(40)]
        owner, start, end, place = piece_codec.viterbi(words, table, -20.0)
        for k, w in enumerate(words):
            mine = owner == k
            path = list(zip(start[mine].tolist(), end[mine].tolist(), place[mine].tolist()))
            assert [s for s, _, _ in path] == [0] + [e for _, e, _ in path][:-1] and path[-1][1] == n
            got = sum(table.scores[p] if p >= 0 else -20.0 for _, _, p in path)
            assert got == pytest.approx(brute_best(w, table, -20.0))
            assert all(p < 0 and e - s == 1 or table.pieces[p] == w[s:e] for s, e, p in path)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())


parts = st.one_of(st.text(max_size=12), st.sampled_from([" ", "  ", "    ", "\n", "the", "naïve", "▁", "😀", "aaaaaaaaaaaaaaaaaaaaaaa", "----------------", "\x00", "</s>", "<0x41>"]))


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(parts, max_size=10))
def test_codec_equals_the_library(pieces):
    codec = piece_codec.codec(piece_codec.default_model())
    text = "".join(pieces).encode("utf-8", "ignore").decode()
    ids = codec.encode(text)
    assert np.frombuffer(ids, dtype="<u4").tolist() == codec.model.encode(text)
    assert codec.decode(ids) == codec.model.decode(codec.model.encode(text))


def test_documents_equal_the_library(spark, awkward, empty, library):
    rows = piece_codec.decode(piece_codec.encode(awkward)).collect()
    want = []
    for r in awkward.collect():
        ids = None if r.text is None else library.encode(r.text)
        want.append((r.doc_id, ids, 0 if ids is None else len(ids), None if ids is None else library.decode(ids)))
    got = [(r.doc_id, None if r.ids is None else np.frombuffer(r.ids, dtype="<u4").tolist(), r.n_tokens, r.text) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert piece_codec.decode(piece_codec.encode(empty)).collect() == []
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    both = piece_codec.encode(docs).join(docs, "doc_id").collect()
    assert all(np.frombuffer(r.ids, dtype="<u4").tolist() == library.encode(r.text) for r in both)
