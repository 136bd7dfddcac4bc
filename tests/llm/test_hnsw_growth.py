"""Work of building and of wide searches: in proportion to the vectors, and nothing missed."""

import numpy as np
import pytest

from tidemark.llm import hnsw


def test_lists_are_chosen_a_few_times_a_node(monkeypatch):
    """Nodes come in rounds that grow with the graph, so that lists aren't chosen anew for every thousand new nodes."""
    chosen, choose = [], hnsw.Graph._choose
    monkeypatch.setattr(hnsw.Graph, "_choose", lambda self, ids, *a: chosen.append(len(ids)) or choose(self, ids, *a))
    n = 12_000
    unit = hnsw._unit(np.random.default_rng(1).normal(size=(n, 16)))
    hnsw.Graph.build(unit, np.arange(n), links=8, ground=16, beam=32)
    assert sum(chosen) <= 4 * n


@pytest.mark.parametrize("nodes", [300, 5000])
def test_nearest_of_a_node(nodes):
    rng = np.random.default_rng(2)
    unit = hnsw._unit(np.concatenate([rng.normal(size=(nodes - 100, 24)), rng.normal(size=24) + rng.normal(size=(100, 24)) * 0.01]))
    graph = hnsw.Graph(unit[rng.permutation(nodes)].astype(np.float32), [])
    ids, sims = graph._nearest(50, 90, nodes, 64)
    truth = graph.vectors[50:90] @ graph.vectors.T
    truth[np.arange(40), np.arange(50, 90)] = -np.inf
    for k in range(40):
        mine = ids[k][ids[k] >= 0]
        best = np.argsort(-truth[k])[:64]
        assert len(mine) == len(set(mine.tolist())) <= 64 and 50 + k not in mine
        # a node whose floor came out too high has fewer, but the nearest of all
        assert np.isin(best[: len(mine)], mine).mean() >= 0.98 and len(mine) >= 48
        assert sims[k][ids[k] >= 0] == pytest.approx(truth[k][mine], abs=1e-5)
    few = graph._nearest(0, 3, 5, 64)[0]
    assert [sorted(x[x >= 0].tolist()) for x in few] == [[1, 2, 3, 4], [0, 2, 3, 4], [0, 1, 3, 4]]


@pytest.mark.parametrize(("dims", "least"), [(64, 0.95), (64, 0.05), (8, 0.9)])
def test_wide_beams_give_way_to_all_nodes(monkeypatch, dims, least):
    """A widened beam that would cost more than all nodes isn't walked; all links are found, whether leading axes tell or not."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(1500, dims))
    unit = hnsw._unit(np.concatenate([base, base[:900] + rng.normal(size=(900, dims)) * 0.1]))
    graph = hnsw.Graph(unit.astype(np.float32), [np.full((len(unit), 4), -1, dtype=np.int32)])
    monkeypatch.setattr(hnsw.Graph, "_beam", lambda *a: pytest.fail("a beam was walked"))
    reach = np.where(np.arange(len(unit)) % 2, least, least / 2)
    q, n = graph.within(unit, least, 2 * hnsw.FIRST_BEAM, reach)
    single = unit.astype(np.float32)
    cosines = single @ single.T
    found = np.zeros(cosines.shape, dtype=bool)
    found[q, n] = True
    assert len(q) == found.sum()
    assert found[cosines >= reach[:, None] + 1e-5].all() and not found[cosines < reach[:, None] - 1e-5].any()


def test_descending_in_slices_is_descending():
    rng = np.random.default_rng(4)
    unit = hnsw._unit(rng.normal(size=(3000, 12)))
    graph, _ = hnsw.Graph.build(unit, np.arange(len(unit)), links=8, ground=16, beam=32)
    start = np.zeros(len(unit), dtype=np.int64)
    found = graph._descend(unit.astype(np.float32), start, 1)
    assert (found == graph._walk(unit.astype(np.float32), start, 1)).all()
    assert len(graph._descend(unit[:0].astype(np.float32), start[:0], 1)) == 0
