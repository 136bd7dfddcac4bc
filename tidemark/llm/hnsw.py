"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one a shard.

Vectors are dealt into shards by a hash of their id; each shard's graph is
built in one task and stored in the shared folder. Every vector queries every
shard, in blocks. Beams widen until an audit against brute force passes, and
for each query as long as its whole beam is within the threshold; a widened beam
that would cost more than a comparison with all nodes of the graph gives way to
it, which is brute force and finds all. What is found
is verified by the cosine in double precision, then links are joined into
components.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from tidemark.llm.common import materialize
from tidemark.llm.components import connected_components

#: Links of a node on the upper layers, on the ground layer, and the beam that finds them.
LINKS, GROUND_LINKS, BUILD_BEAM = 48, 96, 256
#: Links that a node may get beyond those, so that every node is reached, and the incoming links that it should have.
SPARE, LEAST_INCOMING = 8, 3
FIRST_BEAM = 32
#: Nodes added to a graph at once, at most.
INSERT_ROWS = 16_384
#: A place of a beam takes the time in which a query is compared with about so many nodes at once
#: (25,600 nodes of 64 numbers: 0.02 ms a place, 4e-6 ms a node).
BEAM_NODES = 4_096
#: Every so many nodes tell about where the nearest begin.
SAMPLE_STRIDE = 16
#: Leading axes whose cosines bound the whole ones.
BOUND_AXES = 16
#: Shards at least, and vectors of a shard at most (about 140 MB of graph and vectors of 64 numbers).
SHARDS, SHARD_ROWS = 8, 200_000
#: Queries that a task answers.
QUERY_ROWS = 32_768
#: Vectors that the audit draws first, how many with links it draws on for, and the most that it draws.
AUDIT_ROWS, AUDIT_LINKED, AUDIT_MOST = 512, 128, 8_192
#: Nearest others of each audited vector, whether links or not, that the audit asks for.
NEAREST = 10
#: The least share of the linked audited vectors whose links are all found, and of the nearest others that are found.
AUDIT_RECALL = 0.99
#: Cosines of one pair from two computations differ by less.
ROUNDING = 1e-9
#: Below the threshold by this much, single precision may still hide a link.
SLACK = 1e-4
#: Bytes of a graph in one row; larger ones leave the JVM's heap in pieces.
INDEX_CHUNK = 256 << 10


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def _single_unit(vectors: np.ndarray) -> np.ndarray:
    """:func:`_unit` in single precision, without a copy of the whole in double."""
    out = np.empty(vectors.shape, dtype=np.float32)
    for s in range(0, len(vectors), 8192):
        out[s : s + 8192] = _unit(vectors[s : s + 8192])
    return out


class Graph:
    """A navigable small-world graph over unit vectors; nodes are ordered by falling level, so a layer is a prefix."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray]):
        self.vectors, self.layers = vectors, layers

    @classmethod
    def build(cls, unit: np.ndarray, ids: np.ndarray, links: int = LINKS, ground: int = GROUND_LINKS, beam: int = BUILD_BEAM) -> tuple[Graph, np.ndarray]:
        """Graph of ``unit`` rows and the order they have in it. Levels come from a hash of the ids."""
        mixed = (ids.astype(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        u = ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        level = np.minimum((-np.log(u) / math.log(links)).astype(np.int64), 12)
        order = np.lexsort((mixed, -level))
        level = level[order]
        counts = [int((level >= k).sum()) for k in range(int(level[0]) + 1)]
        layers = [np.full((c, ground if k == 0 else links), -1, dtype=np.int32) for k, c in enumerate(counts)]
        graph = cls(unit[order].astype(np.float32), layers)
        at = 1
        while at < len(unit):
            stop = min(len(unit), at + min(at, INSERT_ROWS))
            graph._insert(at, stop, beam)
            at = stop
        graph.layers = [graph._mended(table) for table in layers]
        return graph, order

    def _mended(self, table: np.ndarray) -> np.ndarray:
        """``table`` with SPARE more links a node, through which every node is reached from the first.

        A list that is chosen anew may drop a node's last incoming link, and no
        beam finds a node that nothing leads to. So nodes with few incoming links
        get some from the nodes they link to; then those that a walk from the
        first node does not reach get one from the nearest that it reaches.
        """
        nodes, width = table.shape
        wide = np.full((nodes, width + SPARE), -1, dtype=np.int32)
        wide[:, :width] = table
        used = np.zeros(nodes, dtype=np.int64)

        def add(source: np.ndarray, target: np.ndarray) -> None:
            """Links in the order given, as far as the sources have spare places."""
            order = np.argsort(source, kind="stable")
            source, target = source[order], target[order]
            starts = np.flatnonzero(np.r_[True, source[1:] != source[:-1]]) if len(source) else np.zeros(0, dtype=np.int64)
            rank = np.arange(len(source)) - np.repeat(starts, np.diff(np.r_[starts, len(source)]))
            place = used[source] + rank
            fits = place < SPARE
            wide[source[fits], width + place[fits]] = target[fits]
            np.add.at(used, source[fits], 1)

        incoming = np.bincount(table[table >= 0], minlength=nodes)
        poor = np.flatnonzero(incoming < LEAST_INCOMING)
        best = np.full((LEAST_INCOMING, len(poor)), -1, dtype=np.int64)
        for s in range(0, len(poor), 1024):
            mine = poor[s : s + 1024]
            near = table[mine].astype(np.int64)
            sims = np.einsum("ijk,ik->ij", self.vectors[np.maximum(near, 0)], self.vectors[mine])
            back = (table[np.maximum(near, 0)] == mine[:, None, None]).any(axis=2)
            sims = np.where((near >= 0) & ~back, sims, -np.inf)
            rows = np.arange(len(mine))
            for k in range(LEAST_INCOMING):
                at = np.argmax(sims, axis=1)
                best[k, s : s + 1024] = np.where(sims[rows, at] > -np.inf, near[rows, at], -1)
                sims[rows, at] = -np.inf
        for source in best:
            add(source[source >= 0], poor[source >= 0])
        while True:
            reached = np.zeros(nodes, dtype=bool)
            reached[0] = True
            front = np.zeros(1, dtype=np.int64)
            while len(front):
                found = np.unique(wide[front])
                front = found[found >= 0].astype(np.int64)
                front = front[~reached[front]]
                reached[front] = True
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return wide
            open_ = np.flatnonzero(reached & (used < SPARE))
            source = np.zeros(len(lost), dtype=np.int64)
            sims = np.zeros(len(lost), dtype=np.float32)
            for s in range(0, len(lost), 256):
                value = self.vectors[lost[s : s + 256]] @ self.vectors[open_].T
                top = np.argmax(value, axis=1)
                source[s : s + 256], sims[s : s + 256] = open_[top], value[np.arange(len(top)), top]
            order = np.argsort(-sims, kind="stable")
            add(source[order], lost[order])

    def _insert(self, at: int, stop: int, most: int) -> None:
        """Add the nodes ``at`` to ``stop`` to every layer they reach, linked with some of the nearest ``most`` that the layer has by then.

        Those are found among all nodes of the layer: a graph is bounded by
        SHARD_ROWS, and products of matrices are faster than walks and miss none.
        """
        for table in self.layers:
            here = min(stop, len(table))
            step = max(16, min(256, (1 << 23) // here))
            for s in range(at, here, step):
                ids, sims = self._nearest(s, min(s + step, here), here, most)
                table[s : min(s + step, here)] = self._choose(ids, sims, table.shape[1])
            if here > at:
                self._link_back(table, np.repeat(np.arange(at, here), table.shape[1]), table[at:here].ravel())

    def _nearest(self, start: int, stop: int, nodes: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """About the nearest ``most`` of the first ``nodes`` to each of ``start`` to ``stop`` but itself, in no order; -1 where fewer."""
        sims = self.vectors[start:stop] @ self.vectors[:nodes].T
        rows = np.arange(stop - start)
        sims[rows, rows + start] = -np.inf
        if nodes > SAMPLE_STRIDE * most:
            expected = most / SAMPLE_STRIDE
            sample = sims[:, ::SAMPLE_STRIDE]
            rank = min(sample.shape[1], math.ceil(expected + 3 * math.sqrt(expected)))
            floor = -np.partition(-sample, rank - 1, axis=1)[:, rank - 1]
            row, ids = np.divmod(np.flatnonzero(sims >= floor[:, None]), nodes)
            counts = np.bincount(row, minlength=len(rows))
            if counts.max() <= nodes // 4:  # else many are equally near
                place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                near = np.full((len(rows), counts.max()), -1, dtype=np.int64)
                near[row, place] = ids
                sims = np.where(near >= 0, np.take_along_axis(sims, np.maximum(near, 0), axis=1), -np.inf)
            else:
                near = np.broadcast_to(np.arange(nodes), sims.shape)
        else:
            near = np.broadcast_to(np.arange(nodes), sims.shape)
        if near.shape[1] > most:
            top = np.argpartition(-sims, most - 1, axis=1)[:, :most]
            near, sims = np.take_along_axis(near, top, axis=1), np.take_along_axis(sims, top, axis=1)
        return np.where(sims > -np.inf, near, -1), sims

    def _choose(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` diverse neighbours: nearer to the node than to any chosen one; the nearest others fill up."""
        sims = np.where(ids >= 0, sims, -np.inf)
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * most]
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        same = np.zeros(ids.shape, dtype=bool)
        by_id = np.argsort(ids, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(ids, by_id, axis=1)
        twice = np.zeros(ids.shape, dtype=bool)
        twice[:, 1:] = sorted_ids[:, 1:] == sorted_ids[:, :-1]
        np.put_along_axis(same, by_id, twice, axis=1)
        valid = (ids >= 0) & ~same
        out = np.full((len(ids), most), -1, dtype=np.int32)
        for s in range(0, len(ids), 256):
            part, ok, sim = ids[s : s + 256], valid[s : s + 256], sims[s : s + 256]
            v = self.vectors[np.maximum(part, 0)]
            between = np.matmul(v, v.transpose(0, 2, 1))
            nearest = np.full(part.shape, -np.inf, dtype=np.float32)
            picked = np.zeros(part.shape, dtype=bool)
            room = np.full(len(part), most)
            for k in range(part.shape[1]):
                take = np.flatnonzero(ok[:, k] & (nearest[:, k] < sim[:, k]) & (room > 0))
                picked[take, k] = True
                room[take] -= 1
                if len(take) == len(part):
                    np.maximum(nearest[:, k + 1 :], between[:, k, k + 1 :], out=nearest[:, k + 1 :])
                elif len(take):
                    nearest[take, k + 1 :] = np.maximum(nearest[take, k + 1 :], between[take, k, k + 1 :])
                if not (room > 0).any():
                    break
            rank = np.argsort(np.where(picked, 0, np.where(ok, 1, 2)), axis=1, kind="stable")[:, :most]
            best = np.where(np.take_along_axis(ok, rank, axis=1), np.take_along_axis(part, rank, axis=1), -1)
            out[s : s + 256, : best.shape[1]] = best
        return out

    def _link_back(self, table: np.ndarray, source: np.ndarray, target: np.ndarray) -> None:
        """Add the links target to source; a full list is chosen anew."""
        fine = target >= 0
        source, target = source[fine], target[fine].astype(np.int64)
        sims = np.empty(len(source), dtype=np.float32)
        for s in range(0, len(source), 65_536):
            part = slice(s, s + 65_536)
            sims[part] = np.einsum("ij,ij->i", self.vectors[source[part]], self.vectors[target[part]])
        order = np.lexsort((-sims, target))
        source, target, sims = source[order], target[order], sims[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        for s in range(0, len(nodes), 1024):
            mine, many = nodes[s : s + 1024], counts[s : s + 1024]
            width = min(int(many.max()), 2 * table.shape[1])
            part = slice(first[s], first[s] + many.sum())
            rank = np.arange(many.sum()) - np.repeat(first[s : s + 1024] - first[s], many)
            keep = rank < width
            row = np.repeat(np.arange(len(mine)), many)[keep]
            new_ids = np.full((len(mine), width), -1, dtype=np.int64)
            new_sims = np.full((len(mine), width), -np.inf, dtype=np.float32)
            new_ids[row, rank[keep]], new_sims[row, rank[keep]] = source[part][keep], sims[part][keep]
            old = table[mine].astype(np.int64)
            old_sims = np.einsum("ijk,ik->ij", self.vectors[np.maximum(old, 0)], self.vectors[mine])
            table[mine] = self._choose(np.concatenate((old, new_ids), axis=1), np.concatenate((old_sims, new_sims), axis=1), table.shape[1])

    def _descend(self, queries: np.ndarray, entry: np.ndarray, layer: int) -> np.ndarray:
        """Greedy walk of every query on a layer."""
        return np.concatenate([self._walk(queries[s : s + 2048], entry[s : s + 2048], layer) for s in range(0, len(queries), 2048)] or [entry])

    def _walk(self, queries: np.ndarray, entry: np.ndarray, layer: int) -> np.ndarray:
        entry = entry.copy()
        table = self.layers[layer]
        best = np.einsum("ij,ij->i", queries, self.vectors[entry])
        alive = np.arange(len(queries))
        while len(alive):
            near = table[entry[alive]]
            sims = np.einsum("ijk,ik->ij", self.vectors[np.maximum(near, 0)], queries[alive])
            sims = np.where(near >= 0, sims, -np.inf)
            top = np.argmax(sims, axis=1)
            value = sims[np.arange(len(alive)), top]
            better = value > best[alive]
            alive, top, value, near = alive[better], top[better], value[better], near[better]
            entry[alive] = near[np.arange(len(alive)), top]
            best[alive] = value
        return entry

    def _beam(self, queries: np.ndarray, entry: np.ndarray, layer: int, width: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` nodes found for every query, nearest first, -1 where fewer; ``nodes`` is the layer's size so far."""
        table = self.layers[layer]
        out_ids = np.full((len(queries), width), -1, dtype=np.int64)
        out_sims = np.full((len(queries), width), -np.inf, dtype=np.float32)
        step = max(1, min(512, (32 << 20) // max(1, nodes), (1 << 21) // width))
        for s in range(0, len(queries), step):
            q = queries[s : s + step]
            rows = np.arange(len(q))
            seen = np.zeros((len(q), nodes + 1), dtype=bool)
            seen[:, nodes] = True  # the place of -1
            ids = np.full((len(q), width), -1, dtype=np.int64)
            sims = np.full((len(q), width), -np.inf, dtype=np.float32)
            open_ = np.zeros((len(q), width), dtype=bool)
            ids[:, 0] = entry[s : s + step]
            sims[:, 0] = np.einsum("ij,ij->i", q, self.vectors[ids[:, 0]])
            open_[:, 0] = True
            seen[rows, ids[:, 0]] = True
            alive = rows
            while len(alive):
                waiting = np.where(open_[alive], sims[alive], -np.inf)
                at = np.argmax(waiting, axis=1)
                some = waiting[np.arange(len(alive)), at] > -np.inf
                alive, at = alive[some], at[some]
                if not len(alive):
                    break
                open_[alive, at] = False
                near = table[ids[alive, at]].astype(np.int64)
                near = np.where(near < 0, nodes, near)
                fresh = ~seen[alive[:, None], near]
                # only nodes that a query meets for the first time are compared with it
                row, k = np.nonzero(fresh)
                met = near[row, k]
                seen[alive[row], met] = True
                value = np.full(near.shape, -np.inf, dtype=np.float32)
                value[row, k] = np.einsum("ij,ij->i", self.vectors[met], q[alive[row]])
                useful = (value > sims[alive].min(axis=1, keepdims=True)).any(axis=1)
                rest = alive[useful]
                if len(rest):
                    all_ids = np.concatenate((ids[rest], near[useful]), axis=1)
                    all_sims = np.concatenate((sims[rest], value[useful]), axis=1)
                    all_open = np.concatenate((open_[rest], fresh[useful]), axis=1)
                    top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
                    ids[rest] = np.take_along_axis(all_ids, top, axis=1)
                    sims[rest] = np.take_along_axis(all_sims, top, axis=1)
                    open_[rest] = np.take_along_axis(all_open, top, axis=1) & (sims[rest] > -np.inf)
            order = np.argsort(-sims, axis=1, kind="stable")
            sims = np.take_along_axis(sims, order, axis=1)
            out_sims[s : s + step] = sims
            out_ids[s : s + step] = np.where(sims > -np.inf, np.take_along_axis(ids, order, axis=1), -1)
        return out_ids, out_sims

    def within(self, queries: np.ndarray, least: float, width: int, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(query, node)`` of all found nodes with a cosine of ``least`` or more; a beam that is all within is widened until it isn't.

        ``reach`` may lower the cosine by query; what lies between widens no beam.
        """
        queries = queries.astype(np.float32)
        reach = np.full(len(queries), least) if reach is None else np.minimum(reach, least)
        entry = np.zeros(len(queries), dtype=np.int64)
        for layer in range(len(self.layers) - 1, 0, -1):
            entry = self._descend(queries, entry, layer)
        rows, out_q, out_n = np.arange(len(queries)), [], []
        nodes = len(self.vectors)
        while len(rows) and width < nodes and (width <= FIRST_BEAM or width * BEAM_NODES < nodes):
            ids, sims = self._beam(queries[rows], entry[rows], 0, width, nodes)
            full = ((sims >= least) & (ids >= 0)).sum(axis=1) > 0.75 * width
            q, k = np.nonzero((sims >= reach[rows, None]) & (ids >= 0) & ~full[:, None])
            out_q.append(rows[q])
            out_n.append(ids[q, k])
            rows, width = rows[full], 2 * width
        if len(rows):
            q, n = self._scan(queries[rows], reach[rows].astype(np.float32))
            out_q.append(rows[q])
            out_n.append(n)
        return np.concatenate(out_q) if out_q else rows, np.concatenate(out_n) if out_n else rows

    def _scan(self, queries: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(query, node)`` of all nodes within the queries' reach, by comparison with all, tile by tile.

        A cosine is at most that of the leading axes plus the product of what the
        two vectors have beside them. Where that bound leaves few pairs, only
        those are compared whole; where it doesn't, the tiles are.
        """
        out_q, out_n = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        bounded = self.vectors.shape[1] >= 2 * BOUND_AXES
        if bounded:
            sample = self.vectors[:: max(1, len(self.vectors) // 4096)]
            axes = np.linalg.eigh(sample.T @ sample)[1][:, : -BOUND_AXES - 1 : -1]

            def short(vectors: np.ndarray) -> np.ndarray:
                lead = vectors @ axes
                rest = np.maximum(0, np.square(vectors).sum(axis=1) - np.square(lead).sum(axis=1))
                return np.concatenate((lead, np.sqrt(rest)[:, None]), axis=1)

            near, asked = short(self.vectors), short(queries)
        for s in range(0, len(queries), 256):
            mine, least = queries[s : s + 256], reach[s : s + 256, None]
            for n in range(0, len(self.vectors), 1024):
                nodes = self.vectors[n : n + 1024]
                if bounded:
                    hits = np.flatnonzero(asked[s : s + 256] @ near[n : n + 1024].T >= least - SLACK)
                    bounded = len(hits) <= len(mine) * len(nodes) // 32
                if bounded:
                    q, k = np.divmod(hits, len(nodes))
                    fine = np.einsum("ij,ij->i", mine[q], nodes[k]) >= least[q, 0]
                    q, k = q[fine], k[fine]
                else:
                    q, k = np.divmod(np.flatnonzero(mine @ nodes.T >= least), len(nodes))
                if len(q):
                    out_q.append(q + s)
                    out_n.append(k + n)
        return np.concatenate(out_q), np.concatenate(out_n)

    def to_bytes(self, raw: np.ndarray) -> bytes:
        """The graph with the given vectors (in the nodes' order) as they came, from which :meth:`from_bytes` makes it again."""
        out = io.BytesIO()
        np.savez(out, raw=raw, **{f"layer{k}": x for k, x in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, blob: bytes) -> tuple[Graph, np.ndarray]:
        found = np.load(io.BytesIO(blob))
        raw = found["raw"]
        return cls(_single_unit(raw), [found[f"layer{k}"] for k in range(len(found.files) - 1)]), raw


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def vector_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, classes)``: ``vec_id, class_id`` of every row (null where the vector can't link), and the distinct vectors.

    ``classes`` has ``class_id, n, dims, v``; equal vectors are one class, so
    copies are never compared with each other.
    """
    v = F.col("embedding").cast("array<double>")
    limit = F.lit(float("inf"))
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < limit) & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(fine, F.transform(v, lambda x: x + 0.0)).alias("v"))
    rows = rows.withColumn("digest", F.sha2(F.array_join(F.transform("v", lambda x: x.cast("string")), " "), 256))
    classes = (
        rows.where("v is not null")
        .groupBy("digest")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("v").alias("v"))
        .withColumn("class_id", F.xxhash64("digest"))
        .withColumn("dims", F.size("v"))
    )
    return rows.select("vec_id", F.when(F.col("v").isNotNull(), F.xxhash64("digest")).alias("class_id")), classes.drop("digest")


def build_index(classes: DataFrame, shards: int) -> DataFrame:
    """Graphs of all shards: ``shard, dims, chunk_no, class_ids, blob``, a row for each chunk of a graph.

    Each shard is one task's; its rows are bounded by the shard count. Vectors
    of different lengths have graphs of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        shard = None
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                held.setdefault(int(d), []).append((part.column("class_id").to_numpy(), _matrix(part.column("v"))))
                shard = part.column("shard")[0].as_py()
        for d, parts in sorted(held.items()):
            ids, unit = np.concatenate([p[0] for p in parts]), _unit(np.concatenate([p[1] for p in parts]))
            graph, order = Graph.build(unit, ids)
            raw = np.concatenate([p[1] for p in parts])[order]
            single = raw.astype(np.float32)
            blob = graph.to_bytes(single if (single == raw).all() else raw)
            for number, at in enumerate(range(0, len(blob), INDEX_CHUNK)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()),
                        pa.array([d], pa.int32()),
                        pa.array([number], pa.int32()),
                        pa.array([ids[order].astype("<i8").tobytes() if number == 0 else b""], pa.binary()),
                        pa.array([blob[at : at + INDEX_CHUNK]], pa.binary()),
                    ],
                    ["shard", "dims", "chunk_no", "class_ids", "blob"],
                )

    dealt = classes.withColumn("shard", F.pmod("class_id", F.lit(shards)).cast("int")).repartitionById(shards, "shard")
    rows = dealt.select("shard", "class_id", "dims", "v").mapInArrow(run, "shard int, dims int, chunk_no int, class_ids binary, blob binary")
    return materialize(rows, "hnsw-index")


def _by_task(index: DataFrame, queries: DataFrame, shards: int, rows: int) -> PandasCogroupedOps:
    """Queries (about ``rows``) and graphs by task, which is a shard and a block of queries."""
    blocks = max(1, math.ceil(rows / QUERY_ROWS))
    asked = queries.select("class_id", "dims", "v").withColumn("block", F.pmod(F.shiftright("class_id", 20), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    task = (F.col("shard") * blocks + F.col("block")).cast("int").alias("task")
    asked = asked.select(task, "class_id", "dims", "v").repartitionById(shards * blocks, "task")
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    graphs = graphs.select(task, "dims", "chunk_no", "class_ids", "blob").repartitionById(shards * blocks, "task")
    return asked.groupBy("task").cogroup(graphs.groupBy("task"))


def _matches(left: pa.Table, right: pa.Table, least: float, width: int, floors: dict[int, float] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Class ids of the pairs that one task finds, and their cosines of ``least`` (or the query's floor, if that is lower) or more in double precision."""
    dims, graph_dims = left.column("dims").to_numpy(), right.column("dims").to_numpy()
    for d in np.intersect1d(dims, graph_dims):
        part = left.filter(pa.array(dims == d))
        rows = np.flatnonzero(graph_dims == d)
        rows = rows[np.argsort(right.column("chunk_no").to_numpy()[rows])].tolist()
        graph, raw = Graph.from_bytes(b"".join(right.column("blob")[k].as_buffer() for k in rows))
        nodes = np.frombuffer(right.column("class_ids")[rows[0]].as_py(), dtype="<i8")
        ids = part.column("class_id").to_numpy()
        unit = _unit(_matrix(part.column("v")))
        reach = np.full(len(ids), least) if floors is None else np.minimum(least, [floors[x] - ROUNDING for x in ids.tolist()])
        q, n = graph.within(unit, least - SLACK, width, reach - SLACK)
        for k in range(0, len(q), 50_000):
            at, to = q[k : k + 50_000], n[k : k + 50_000]
            cosines = np.einsum("ij,ij->i", unit[at], _unit(raw[to]))
            good = (cosines >= reach[at]) & (ids[at] != nodes[to])
            yield ids[at[good]], nodes[to[good]], cosines[good]


def query_index(index: DataFrame, queries: DataFrame, shards: int, rows: int, least: float, width: int) -> DataFrame:
    """``a, b`` of all found links of different classes: ``a`` of ``queries`` (about ``rows``), ``b`` of any shard.

    What the graphs find near the threshold is verified in the same task, in
    double precision and from the vectors as they came, so only links move.
    """

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b, _ in _matches(left, right, least, width):
            out_a.append(a)
            out_b.append(b)
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return _by_task(index, queries, shards, rows).applyInArrow(search, "a bigint, b bigint")


def brute_force(classes: DataFrame, queries: pa.Table, least: float) -> DataFrame:
    """``a, links, near``: of a few given query rows (``class_id, dims, v``) the number of links and the cosines of the nearest others, against all classes.

    A task keeps a row a query, whatever it reads.
    """
    query_dims = queries.column("dims").to_numpy()
    fixed = {}
    for d in np.unique(query_dims):
        part = queries.filter(pa.array(query_dims == d))
        fixed[int(d)] = part.column("class_id").to_numpy(), _unit(_matrix(part.column("v")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = {d: np.zeros(len(ids), dtype=np.int64) for d, (ids, _) in fixed.items()}
        near = {d: np.full((len(ids), NEAREST), -np.inf) for d, (ids, _) in fixed.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                dims = rows.column("dims").to_numpy()
                for d in np.intersect1d(dims, list(fixed)).tolist():
                    ids, unit = fixed[d]
                    part = rows.filter(pa.array(dims == d))
                    cosines = unit @ _unit(_matrix(part.column("v"))).T
                    _, mine, same = np.intersect1d(ids, part.column("class_id").to_numpy(), return_indices=True)
                    cosines[mine, same] = -np.inf
                    links[d] += (cosines >= least + ROUNDING).sum(axis=1)
                    both = np.concatenate((near[d], cosines), axis=1)
                    near[d] = -np.partition(-both, NEAREST - 1, axis=1)[:, :NEAREST]
        for d, (ids, _) in fixed.items():
            lists = [x[x > -np.inf].tolist() for x in near[d]]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links[d]), pa.array(lists, pa.list_(pa.float64()))], ["a", "links", "near"])

    parts = classes.select("class_id", "dims", "v").mapInArrow(run, "a bigint, links bigint, near array<double>")
    nearest = F.slice(F.sort_array(F.flatten(F.collect_list("near")), False), 1, NEAREST)
    return parts.groupBy("a").agg(F.sum("links").alias("links"), nearest.alias("near"))


def draw_audit(classes: DataFrame, total: int, least: float, rows: int = AUDIT_ROWS, linked: int = AUDIT_LINKED, most: int = AUDIT_MOST) -> tuple[DataFrame, list]:
    """``(queries, truth)``: classes in the order of a hash, and a row of :func:`brute_force` of each.

    Four times as many are drawn until ``linked`` of them have links, the
    classes are all drawn, or ``most`` are: where links are rarer than that, the
    nearest others tell how well the graphs are searched.
    """
    truth, done, stop = [], 0, min(rows, most)
    while True:
        queries = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(stop).select("class_id", "dims", "v")
        truth += brute_force(classes, queries.toArrow().slice(done), least).collect()  # a row a drawn class
        if sum(r["links"] > 0 for r in truth) >= linked or stop >= min(most, total):
            return materialize(queries, "hnsw-audit"), truth
        done, stop = stop, min(4 * stop, most)


def beam_recall(index: DataFrame, queries: DataFrame, truth: list, shards: int, least: float, width: int) -> tuple[float, float]:
    """``(whole, near)`` at a beam's width: the share of the audit's linked vectors whose links are all found, and of the nearest others that are found.

    A vector counts once, however many links it has; others as near as the last of the nearest stand for it.
    """
    floors = {r["a"]: r["near"][-1] if r["near"] else 1.0 for r in truth}

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out_a, out_links, out_near = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, _, cosines in _matches(left, right, least, width, floors):
            ids, where = np.unique(a, return_inverse=True)
            floor = np.array([floors[x] for x in ids.tolist()])[where] - ROUNDING
            out_a.append(ids)
            out_links.append(np.bincount(where, weights=cosines >= least, minlength=len(ids)).astype(np.int64))
            out_near.append(np.bincount(where, weights=cosines >= floor, minlength=len(ids)).astype(np.int64))
        return pa.table({"a": np.concatenate(out_a), "links": np.concatenate(out_links), "near": np.concatenate(out_near)})

    parts = _by_task(index, queries, shards, len(truth)).applyInArrow(search, "a bigint, links bigint, near bigint")
    found = {r["a"]: r for r in parts.groupBy("a").agg(F.sum("links").alias("links"), F.sum("near").alias("near")).collect()}
    whole = [r["a"] in found and found[r["a"]]["links"] >= r["links"] for r in truth if r["links"]]
    asked = sum(len(r["near"]) for r in truth)
    near = sum(min(found[r["a"]]["near"], len(r["near"])) for r in truth if r["a"] in found)
    return sum(whole) / len(whole) if whole else 1.0, near / asked if asked else 1.0


def audited_beam(index: DataFrame, classes: DataFrame, shards: int, total: int, least: float, recall: float = AUDIT_RECALL) -> int:
    """The first beam width, doubling, at which both shares of :func:`beam_recall` are ``recall`` or more."""
    queries, truth = draw_audit(classes, total, least)
    width = FIRST_BEAM
    while width < total and min(beam_recall(index, queries, truth, shards, least, width)) < recall:
        width *= 2
    return width


def near_vectors(vectors: DataFrame, least: float = 0.95, shards: int | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, embedding``).

    ``n_links`` counts the other rows whose cosine is ``least`` or more,
    ``component_id`` is the smallest ``vec_id`` reachable. Null, zero and empty
    vectors and those with null, NaN or infinite numbers link with nothing;
    vectors of different lengths aren't compared. Equal vectors (also repeated
    rows) are one class and link with each other. A null ``vec_id`` stays null
    and names no component unless alone in it, where the component is null;
    other columns are ignored; an empty table gives an empty result.
    """
    rows, classes = vector_classes(vectors)
    rows, classes = materialize(rows, "vectors"), materialize(classes, "vector-classes")
    total = classes.count()
    shards = shards or max(SHARDS, math.ceil(total / SHARD_ROWS))
    if total:
        index = build_index(classes, shards)
        width = audited_beam(index, classes, shards, total, least)
        found = query_index(index, classes, shards, total, least, width)
        links = materialize(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    else:
        links = rows.select(F.col("class_id").alias("a"), F.col("class_id").alias("b")).limit(0)
    roots = connected_components(links).select(F.col("node").alias("class_id"), "root")
    ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("class_id").alias("b"), "n")
    outside = ends.join(sizes, "b").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("outside"))
    named = (
        classes.select("class_id", "n", "least")
        .join(outside, "class_id", "left")
        .join(roots, "class_id", "left")
        .withColumn("root", F.coalesce("root", "class_id"))
    )
    best = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(best, "root").select("class_id", (F.col("n") - 1 + F.coalesce("outside", F.lit(0))).alias("links"), "component")
    out = rows.join(named, "class_id", "left")
    component = F.when(F.col("class_id").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
