"""Near duplicates of embeddings by hierarchical navigable small-world graphs per shard.

Vectors are compared only within a label (and dimension). Equal vectors become one, with a multiplicity. The vectors of a
label are dealt into cells around pivots (random vectors of the label, ``PIVOTS`` at most over all labels), and cells into
shards of about ``SHARD_ROWS`` by hash. Every shard's graph is built once and kept as one row of a table in the shared
folder. A vector asks all shards of all cells that can hold a link of it: a link is an angle of ``THRESHOLD`` at most, so by
the triangle inequality a cell further away than its radius and that angle, or further than the vector's own pivot and
twice that angle, holds none. A task searches one graph for a block of vectors that ask it. Its beam is widened, and then
its entries, until an audit of brute-force answers shows ``RECALL``; with all vectors as entries nothing is missed, so that
always ends. Every link counted is verified by the cosine in double precision. A task returns for each vector the number of
linked vectors and one link to the smallest vector of its part of a component, never the pairs. So no link below the
threshold is counted, and of those above ``RECALL`` is audited in every task: n_links may fall short by that much.

Vectors that are null or zero, hold null or non-finite components, or lack a label or an id, link with nothing. Rows that
repeat id, label and vector are one vector; rows with the same id and other vectors stay rows of their own. Empty tables
give no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import stored
from .components import components

THRESHOLD, SHARD_ROWS, RECALL, AUDIT = 0.98, 8192, 0.999, 256
#: Vectors that ask a shard together; pivots of all labels together, which every executor gets.
QUERY_ROWS, PIVOTS = 32_768, 16_384
#: Links of a node, how many of them are followed backward too, beams of building and of the first search, entries from one
#: layer to the next, size of the top layer.
LINKS, BACK, EF_BUILD, EF_SEARCH, DOWN, TOP = 24, 3, 24, 16, 3, 32
#: Queries side by side; how far below the threshold a vector is still followed.
BLOCK, MARGIN = 512, 0.015


class SmallWorld:
    """A layered graph over unit vectors; batches are inserted and searched side by side."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        self.x = x
        n = len(x)
        order = np.random.default_rng(seed).permutation(n)
        sizes = [n]
        while sizes[-1] > TOP:
            sizes.append(max(1, sizes[-1] // 8))
        self.order, self.top = order, order[: sizes[-1]]
        #: Links of the layers from the top; each layer holds a prefix of ``order``, so it contains all layers above.
        self.links: list[np.ndarray] = []
        self.back: list[tuple[np.ndarray, np.ndarray]] = []
        for size in sizes[-2::-1]:
            self._layer(order, size)

    def pack(self) -> bytes:
        small = lambda x: x.astype(np.int32)
        return pickle.dumps((self.x, small(self.order), len(self.top), [small(links) for links in self.links], [(small(a), small(b)) for a, b in self.back]))

    @classmethod
    def unpack(cls, raw: bytes) -> SmallWorld:
        self = cls.__new__(cls)
        self.x, order, top, links, back = pickle.loads(raw)
        self.order, self.links = order.astype(np.int64), [x.astype(np.int64) for x in links]
        self.back = [(a.astype(np.int64), b.astype(np.int64)) for a, b in back]
        self.top = self.order[:top]
        return self

    def widen(self) -> None:
        """Twice as many vectors are entries of the search."""
        self.top = self.order[: 2 * len(self.top)]

    def _layer(self, order: np.ndarray, size: int) -> None:
        links = np.full((len(self.x), LINKS), -1, np.int64)
        self.links.append(links)
        done = len(self.top)
        self._connect(links, order[:done], *self._exact(order[:done], order[:done]))
        while done < size:
            batch = order[done : min(size, done + min(1024, max(128, done)))]
            ids, sims = self._near(self.x[batch], EF_BUILD, len(self.links))
            mine, own = self._exact(batch, batch)
            self._connect(links, batch, np.concatenate([ids, mine], 1), np.concatenate([sims, own], 1))
            done += len(batch)
        self.back.append(self._backward(links, order[:size]))

    def _backward(self, links: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each node those that have it among their BACK nearest links: where its list starts, and all lists in a row.

        Searches follow these too. Else a node of a dense group that is among the nearest of no other one, as pruning
        leaves them, could be found from few places only.
        """
        near = np.full((len(rows), BACK), -1, np.int64)
        for at in range(0, len(rows), 1024):
            part = rows[at : at + 1024]
            own = links[part]
            s = np.where(own >= 0, np.einsum("bkd,bd->bk", self.x[np.maximum(own, 0)], self.x[part]), -2)
            near[at : at + 1024] = np.take_along_axis(own, np.argsort(-s, axis=1)[:, :BACK], 1)
        there = near >= 0
        to, source = near[there], np.repeat(rows, there.sum(1))
        order = np.argsort(to, kind="stable")
        return np.searchsorted(to[order], np.arange(len(self.x) + 1)), source[order]

    def _exact(self, rows: np.ndarray, among: np.ndarray, k: int = EF_BUILD) -> tuple[np.ndarray, np.ndarray]:
        sims = self.x[rows] @ self.x[among].T
        sims[rows[:, None] == among[None, :]] = -2
        k = min(k, len(among))
        part = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        got = np.take_along_axis(sims, part, 1)
        return np.where(got > -2, among[part], -1), got

    def _select(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Of the candidates of each row those closer to it than to one already chosen; the nearest others fill up."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        same = ids[:, 1:] == ids[:, :-1]
        ids[:, 1:][same] = -1
        sims[:, 1:][same] = -2
        k = ids.shape[1]
        v = self.x[np.maximum(ids, 0)]
        between = v @ v.transpose(0, 2, 1)
        chosen = np.zeros(ids.shape, bool)
        count = np.zeros(len(ids), np.int64)
        for j in range(k):
            worst = np.where(chosen[:, :j], between[:, j, :j], -2).max(1, initial=-2)
            take = (ids[:, j] >= 0) & (sims[:, j] > worst) & (count < width // 2)
            chosen[:, j] = take
            count += take
        rank = np.where(ids < 0, 3, np.where(chosen, 0, 1))
        keep = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.take_along_axis(ids, keep, 1)
        if out.shape[1] < width:
            out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)
        return out

    def _connect(self, links: np.ndarray, rows: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        links[rows] = self._select(ids, sims, links.shape[1])
        src = np.repeat(rows, links.shape[1])
        dst = links[rows].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
        for at in range(0, len(nodes), 1024):  # the other way round, with the old links as candidates
            part = slice(at, at + 1024)
            size = int(count[part].max())
            new = np.full((len(nodes[part]), size), -1, np.int64)
            col = np.arange(size)
            ok = col < count[part][:, None]
            new[ok] = src[(first[part][:, None] + col)[ok]]
            if size > LINKS:  # a hub: the nearest of the new ones
                s = np.where(new >= 0, np.einsum("bkd,bd->bk", self.x[np.maximum(new, 0)], self.x[nodes[part]]), -2)
                best = np.argpartition(-s, LINKS, axis=1)[:, :LINKS]
                new = np.take_along_axis(new, best, 1)
            cand = np.sort(np.concatenate([links[nodes[part]], new], 1), axis=1)
            cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            s = np.where(cand >= 0, np.einsum("bkd,bd->bk", self.x[np.maximum(cand, 0)], self.x[nodes[part]]), -2)
            links[nodes[part]] = self._select(cand, s, links.shape[1])

    def _near(self, q: np.ndarray, ef: int, layers: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` best vectors that the beams of the queries see; -1 where there are fewer."""
        ids, sims = [], []
        for at in range(0, len(q), BLOCK):
            part = q[at : at + BLOCK]
            got = _ranked(len(part), ef, *self.search(part, ef, layers=layers))
            ids.append(got[0])
            sims.append(got[1])
        return np.concatenate(ids), np.concatenate(sims)

    def search(self, q: np.ndarray, ef: int, own: np.ndarray | None = None, floor: float = 2.0, layers: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, node, cosine) of what the beams of the queries have found, each pair once: the ``ef`` best of each
        query at least, and all visited that reach ``floor``.

        The beam goes down the layers. It expands what is among the ``ef`` best so far (``DOWN`` in upper layers), and, so
        that a dense group is seen whole, all that reaches ``floor``. ``own``: nodes of the queries themselves (-1: none),
        where they start too.
        """
        layers = len(self.links) if layers is None else layers
        n, m = len(self.x), len(q)
        seen = np.zeros(m * n, bool)
        claim = np.empty(m * n, np.int32)
        start = q @ self.x[self.top].T
        seen[(np.arange(m)[:, None] * n + self.top).ravel()] = True
        part = np.argpartition(-start, min(ef, len(self.top)) - 1, axis=1)[:, :ef]
        got = np.take_along_axis(start, part, 1)
        best = np.full((m, ef), -2.0)
        best[:, : got.shape[1]] = -np.sort(-got, axis=1)
        row, node = np.nonzero(start >= np.minimum(best[:, -1], floor)[:, None])
        found = [(row, self.top[node], start[row, node])]
        for j, links in enumerate(self.links[:layers]):
            last = j == layers - 1
            row, node, sim = (np.concatenate(c) for c in zip(*found))
            # the lowest layer goes on from all that upper ones have met and that counts
            near = sim >= (np.minimum(best[row, ef - 1], floor) if last else best[row, min(DOWN, ef) - 1])
            row, node = row[near], node[near]
            if last and own is not None:
                has = np.flatnonzero(own >= 0)
                key = has * n + own[has]
                fresh = has[~seen[key]]
                seen[key] = True
                if len(fresh):
                    ones = np.ones(len(fresh))
                    found.append((fresh, own[fresh], ones))
                    best = _merged(best, fresh, ones)
                row, node = np.concatenate([row, has]), np.concatenate([node, own[has]])
            width = ef if last else min(DOWN, ef)
            while len(row):
                nb = links[node]
                r = np.repeat(row, nb.shape[1])
                nb = nb.ravel()
                if j < len(self.back):  # an unfinished layer has none
                    begin, lists = self.back[j]
                    n_back = begin[node + 1] - begin[node]
                    at = np.repeat(begin[node] - (np.cumsum(n_back) - n_back), n_back) + np.arange(int(n_back.sum()))
                    nb, r = np.concatenate([nb, lists[at]]), np.concatenate([r, np.repeat(row, n_back)])
                key = r * n + nb
                fresh = nb >= 0
                fresh[fresh] = ~seen[key[fresh]]
                key, r, nb = key[fresh], r[fresh], nb[fresh]
                order = np.arange(len(key), dtype=np.int32)
                claim[key] = order
                once = claim[key] == order
                key, r, nb = key[once], r[once], nb[once]
                seen[key] = True
                sim = np.empty(len(r))
                for a in range(0, len(r), 1 << 16):
                    part = slice(a, a + (1 << 16))
                    sim[part] = np.einsum("id,id->i", q[r[part]], self.x[nb[part]])
                stay = sim >= np.minimum(best[:, -1], floor)[r]
                r, nb, sim = r[stay], nb[stay], sim[stay]
                found.append((r, nb, sim))
                best = _merged(best, r, sim)
                good = sim >= np.minimum(best[r, width - 1], floor)
                row, node = r[good], nb[good]
        row, node, sim = (np.concatenate(c) for c in zip(*found))
        stay = sim >= np.minimum(best[:, -1], floor)[row]
        return row[stay], node[stay], sim[stay]


def _ranked(m: int, k: int, row: np.ndarray, node: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k best nodes and their similarities per row; -1 and -2 where there are fewer."""
    order = np.argsort(row * 4.0 - sim)  # by row, then falling similarity
    row, node, sim = row[order], node[order], sim[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    ids, best = np.full((m, k), -1, np.int64), np.full((m, k), -2.0)
    ids[row[keep], rank[keep]] = node[keep]
    best[row[keep], rank[keep]] = sim[keep]
    return ids, best


def _merged(best: np.ndarray, row: np.ndarray, sim: np.ndarray) -> np.ndarray:
    """Best similarities per row, falling, with new ones."""
    if not len(row):
        return best
    rows = np.unique(row)
    _, new = _ranked(len(best), best.shape[1], row, row, sim)
    best = best.copy()
    best[rows] = -np.sort(-np.concatenate([best[rows], new[rows]], 1), axis=1)[:, : best.shape[1]]
    return best


def linked(graph: SmallWorld, q: np.ndarray, own: np.ndarray, threshold: float):
    """For blocks of queries: (first query, cosines over the threshold as rows and nodes), by audited search."""
    x = graph.x
    audit = np.unique(np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int))
    exact = np.flatnonzero((q[audit] @ x.T >= threshold).ravel())
    ef = min(EF_SEARCH, len(x))
    while True:
        row, node, sim = graph.search(q[audit], ef, own[audit], threshold - MARGIN)
        hit = np.isin(exact, (row * len(x) + node)[sim >= threshold])
        if hit.sum() >= RECALL * len(exact):
            break
        if ef < len(x):
            ef = min(2 * ef, len(x))
        else:
            graph.widen()
    for at in range(0, len(q), BLOCK):
        row, node, sim = graph.search(q[at : at + BLOCK], ef, own[at : at + BLOCK], threshold - MARGIN)
        yield at, row[sim >= threshold], node[sim >= threshold]


def _unit(col: pa.Array, rows: int) -> np.ndarray:
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _by_shape(batch: pa.RecordBatch, label: int, v: int):
    """(label, dimension, rows) of the parts of a batch that are equal in both."""
    dim = batch.column(v).value_lengths().to_numpy()
    codes = batch.column(label).dictionary_encode()
    key = codes.indices.to_numpy().astype(np.int64) * (int(dim.max(initial=0)) + 1) + dim
    for k in np.unique(key):
        rows = np.flatnonzero(key == k)
        yield codes.dictionary[codes.indices[int(rows[0])].as_py()].as_py(), int(dim[rows[0]]), rows


def _deal(pivots: dict[tuple[str, int], np.ndarray]):
    def run(batches):
        """Rows (label, rep, mult, v) with the cell of the nearest pivot and the angle to it."""
        for batch in batches:
            cell, angle = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for label, dim, rows in _by_shape(batch, 0, 3):
                if (p := pivots.get((label, dim))) is not None:
                    for part in np.array_split(rows, -(-len(rows) // BLOCK)):
                        cos = _unit(batch.column(3).take(pa.array(part)), len(part)) @ p.T
                        cell[part] = cos.argmax(1)
                        angle[part] = np.arccos(np.clip(cos.max(1), -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"])

    return run


def _ask(pivots: dict[tuple[str, int], np.ndarray], radius: dict[tuple[str, int], np.ndarray], threshold: float):
    #: Angles are rounded, so the bounds get some room.
    reach, room = float(np.arccos(threshold)), 1e-6

    def run(batches):
        """Rows (label, rep, mult, v, cell, angle) with the cells that can hold links."""
        for batch in batches:
            asks = [[0]] * batch.num_rows
            own = batch.column(5).to_numpy()
            for label, dim, rows in _by_shape(batch, 0, 3):
                if (p := pivots.get((label, dim))) is not None:
                    for part in np.array_split(rows, -(-len(rows) // BLOCK)):
                        away = np.arccos(np.clip(_unit(batch.column(3).take(pa.array(part)), len(part)) @ p.T, -1, 1))
                        near = (away <= radius[label, dim] + reach + room) & (away <= own[part][:, None] + 2 * reach + room)
                        for i, cells in zip(part.tolist(), near):
                            asks[i] = np.flatnonzero(cells).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(asks, pa.list_(pa.int32()))], names=["label", "rep", "mult", "v", "cells"])

    return run


SHARD = ["label", "dim", "cell", "shard"]
GRAPH = "label string, dim int, cell int, shard long, graph binary"


def _build(rows: pa.Table) -> pa.Table:
    """The graph of a shard, with ids and multiplicities of its vectors in order of id."""
    rep, mult = rows.column("rep").to_numpy(), rows.column("mult").to_numpy()
    order = np.argsort(rep, kind="stable")
    graph = SmallWorld(_unit(rows.column("v").combine_chunks(), len(rep))[order])
    blob = pickle.dumps((rep[order], mult[order], graph.pack()))
    return pa.table({**{c: rows.column(c).slice(0, 1) for c in SHARD}, "graph": pa.array([blob], pa.binary())})


OUT = "rep long, part long, to long"


def _search(threshold: float):
    def run(asking: pa.Table, graphs: pa.Table) -> pa.Table:
        if not asking.num_rows or not graphs.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("rep", "part", "to")})
        inside, mult, packed = pickle.loads(graphs.column("graph")[0].as_py())
        graph = SmallWorld.unpack(packed)
        order = np.argsort(asking.column("rep").to_numpy(), kind="stable")
        ids = asking.column("rep").to_numpy()[order]
        q = _unit(asking.column("v").combine_chunks(), len(ids))[order]
        rep = np.union1d(ids, inside)  # nodes of the union-find, by rising id
        query, member = np.searchsorted(rep, ids), np.searchsorted(rep, inside)
        at = np.minimum(np.searchsorted(inside, ids), len(inside) - 1)
        own = np.where(inside[at] == ids, at, -1)
        part = np.zeros(len(rep), np.int64)
        parent = np.arange(len(rep))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for at, r, node in linked(graph, q, own, threshold):
            a, b = query[at + r], member[node]
            other = a != b
            a, b = a[other], b[other]
            np.add.at(part, a, mult[node[other]])
            # each query meets the roots of its partners; pairs already joined cost nothing more
            some, where = np.unique(np.concatenate([a, b]), return_inverse=True)
            roots = np.array([root(i) for i in some.tolist()], np.int64)[where]
            pair = np.unique(np.stack([roots[: len(a)], roots[len(a) :]], 1), axis=0) if len(a) else np.zeros((0, 2), int)
            for i, j in pair[pair[:, 0] != pair[:, 1]].tolist():
                ri, rj = root(i), root(j)
                if ri != rj:
                    parent[max(ri, rj)] = min(ri, rj)
        to = np.array([root(i) for i in range(len(rep))], np.int64)
        keep = (part > 0) | (to != np.arange(len(rep)))
        return pa.table({"rep": rep[keep], "part": part[keep], "to": rep[to[keep]]})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector."""
    kind = vectors.schema[embedding].dataType.elementType
    v = F.col(f"`{embedding}`") if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0)
    keys = [F.xxhash64(F.lit(k), "label", "v").alias(f"k{k}") for k in (1, 2)]  # 128 bits tell vectors apart
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False))).select("id", "label", "v", "fine", *keys)
    base = stored(rows.select("id", "label", "fine", "k1", "k2").distinct())
    same = ["label", "k1", "k2"]
    shape = rows.where("fine").groupBy(*same).agg(F.any_value("v").alias("v"))
    reps = base.where("fine").groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("mult"))
    reps = stored(reps.join(shape.hint("merge"), same).select(*same, F.col("rep").cast("long").alias("rep"), "mult", "v", F.size("v").alias("dim")))
    counts = reps.groupBy("label", "dim").agg(F.count("*").alias("n"))
    total = reps.count()
    # pivots: of labels with more than one shard, two for each shard, and of all labels PIVOTS at most
    wanted = F.least(2 * F.ceil(F.col("n") / shard_rows), F.col("n") * (PIVOTS / max(1, total)))
    chance = F.pmod(F.xxhash64(F.lit(3), "k1"), F.lit(1 << 40)) / float(1 << 40)
    drawn = reps.join(counts.where(F.col("n") > shard_rows).hint("merge"), ["label", "dim"]).where(chance < wanted / F.col("n")).select("label", "dim", "v").collect()
    by: dict[tuple[str, int], list] = {}
    for r in sorted(drawn, key=lambda r: (r.label, r.dim, r.v)):
        by.setdefault((r.label, r.dim), []).append(r.v)
    pivots = {k: _unit(pa.array(p, pa.list_(pa.float64())), len(p)) for k, p in by.items()}
    deal = reps.select("label", "rep", "mult", "v")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in deal.schema)
    dealt = stored(deal.mapInArrow(_deal(pivots), f"{fields}, cell int, angle double")).withColumn("dim", F.size("v"))
    cells = stored(dealt.groupBy("label", "dim", "cell").agg(F.max("angle").alias("radius"), F.ceil(F.count("*") / shard_rows).cast("long").alias("shards")))
    radius = {k: np.full(len(p), -np.pi) for k, p in pivots.items()}  # of cells without vectors: nothing is near enough
    apart = counts.where(F.col("n") > shard_rows).select("label", "dim")
    for r in cells.join(apart.hint("merge"), ["label", "dim"]).collect() if pivots else []:  # a row for each pivot at most
        if (r.label, r.dim) in radius:
            radius[r.label, r.dim][r.cell] = r.radius
    sized = cells.select("label", "dim", "cell", "shards").hint("merge")
    members = dealt.join(sized, ["label", "dim", "cell"]).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")))
    # few rows, much work: as many partitions as shards, which adaptive execution leaves alone
    many = max(1, cells.agg(F.sum("shards")).first()[0] or 1)
    graphs = stored(members.select(*SHARD, "rep", "mult", "v").repartition(many, *SHARD).groupBy(*SHARD).applyInArrow(_build, GRAPH))
    asks = deal.columns
    asking = dealt.select(*asks, "cell", "angle").mapInArrow(_ask(pivots, radius, threshold), f"{fields}, cells array<int>").withColumn("dim", F.size("v"))
    asking = asking.select("label", "dim", "rep", "v", F.explode("cells").alias("cell")).join(sized, ["label", "dim", "cell"])
    asking = stored(asking.select("label", "dim", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "rep", "v"))
    blocks = asking.groupBy(*SHARD).agg(F.ceil(F.count("*") / QUERY_ROWS).cast("long").alias("blocks"))
    blocks = stored(blocks)
    left = asking.join(blocks.hint("merge"), SHARD).select(*SHARD, F.pmod(F.xxhash64("rep", F.lit(5)), F.col("blocks")).alias("block"), "rep", "v")
    right = graphs.join(blocks.hint("merge"), SHARD).select(*SHARD, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "graph")
    task = [*SHARD, "block"]
    many = max(1, blocks.agg(F.sum("blocks")).first()[0] or 1)
    left, right = left.repartition(many, *task), right.repartition(many, *task)
    found = stored(left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(_search(threshold), OUT))
    links = found.groupBy("rep").agg(F.sum("part").alias("part"))
    comp = components(found.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    whole = reps.select(*same, "rep", "mult").join(links, "rep", "left").join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left")
    out = base.join(whole.withColumn("fine", F.lit(True)), [*same, "fine"], "left")
    component = F.coalesce("component", "rep", F.col("id").cast("long"))
    return out.select(F.col("id").alias(id_col), (F.coalesce("mult", F.lit(1)) - 1 + F.coalesce("part", F.lit(0))).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
