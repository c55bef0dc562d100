"""Near duplicates of documents by a chosen-path set similarity join over word shingles.

A document's set holds the hashes of its distinct runs of ``SHINGLE`` words (with fewer words: the whole sequence). Equal
sets become one representative first, under a key of their own (64 of the 128 bits that tell sets apart). ``TREES``
independent trees branch the representatives by minwise tokens: at a node one coordinate of the signature (now and then
two, 1/similarity on average) is selected, and documents with the same minwise token there go to the same child. Every tree
has ``OWN`` coordinates for its first levels; deeper nodes select among all by their hash. Nodes of at most ``LEAF``
documents are compared exhaustively on signatures, larger ones branch on until they are small, however many levels that
takes. A child that keeps ``STUCK`` of its parent's documents holds mostly such as agree with most others there, as copies
do: it is dealt into chunks of ``LEAF`` documents that share four leaders. Candidates join into clusters with a margin below
the threshold.

Links are confirmed on full sets: a cluster's sets meet once (a large cluster in chunks of bounded documents and shingles
with shared leaders, and then every document outside its largest component meets all chunks), and the intersections are
counted exactly, for all documents but those of the largest component, whose links to others are links of those others.

Recall: a pair of similarity 0.85 stays together in one tree with a probability of 0.78 if nodes are small after two
levels and of 0.54 after six, so all trees miss it with 1e-9 to 2e-5 (levels beyond ``OWN`` / 2 share coordinates, so their
part is an estimate); that its signatures agree in less than 0.66 of the coordinates has a probability of 1e-7. More
similar pairs are missed less often.

Null and wordless texts have empty sets and link with nothing; rows without id are kept and link with nothing; equal rows
stay equal rows; rows with the same id and different texts are one document with the links of all its texts. Ids may have
any type with an order. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import FOLD_AZ, Words, byte_table, flat, map_text, mix, spread, stored, window_hashes
from .components import components

SHINGLE, NUMERATOR, DENOMINATOR = 5, 85, 100
COORDINATES, TREES, OWN, START, LEAF = 128, 14, 8, 2, 48
#: A large node that keeps this share of its parent holds mostly documents that are candidates of one another and of leaders.
STUCK = 0.7
#: Documents, and shingles of all of them, that are confirmed together.
CHUNK, CHUNK_SHINGLES = 600, 1 << 20
#: Share of equal coordinates from which a pair is a candidate: the threshold less six standard deviations.
CANDIDATE = 0.66
#: Word bytes: all but space and 09-0D.
WORD = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
_DOC_BITS = 52


def shingle_sets(data: np.ndarray, offs: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes (52 bits) of each text in a row, and n + 1 offsets."""
    docs = len(offs) - 1
    words = Words(data, offs, WORD, FOLD_AZ)
    hashes = words.hashes()
    parts, owners = [], []
    full = window_hashes(hashes, n)
    ok = words.doc[: len(full)] == words.doc[n - 1 :] if len(full) else np.zeros(0, bool)
    parts.append(full[ok])
    owners.append(words.doc[: len(full)][ok])
    for k in range(1, n):
        short = np.flatnonzero(words.count == k)
        if len(short):
            parts.append(window_hashes(hashes, k)[words.first[short]])
            owners.append(short)
    found, owner = np.concatenate(parts), np.concatenate(owners)
    out, counts = [], np.zeros(docs, np.int64)
    step = 1 << (64 - _DOC_BITS)
    for at in range(0, docs, step):
        mine = (owner >= at) & (owner < at + step) if docs > step else slice(None)
        key = ((owner[mine] - at).astype(np.uint64) << np.uint64(_DOC_BITS)) | (found[mine] >> np.uint64(64 - _DOC_BITS))
        key = np.unique(key)
        counts += np.bincount((key >> np.uint64(_DOC_BITS)).astype(np.int64) + at, minlength=docs)
        out.append(key & np.uint64((1 << _DOC_BITS) - 1))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(counts)))


_ODD = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def signatures(sets: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """COORDINATES minwise tokens of each set (0 for empty sets)."""
    filled = np.flatnonzero(np.diff(offs))
    out = np.zeros((len(offs) - 1, COORDINATES), np.int16)
    if len(filled):
        spread, starts = mix(sets), offs[:-1][filled]
        for k in range(COORDINATES):
            # the minimum of a large set begins with zeros, so it is spread again before it is cut
            out[filled, k] = (mix(np.minimum.reduceat(spread * _ODD[k], starts)) >> np.uint64(48)).astype(np.uint16).view(np.int16)
    return out


SKETCH = T.StructType([T.StructField("n_shingles", T.LongType(), False), T.StructField("set1", T.LongType(), False), T.StructField("set2", T.LongType(), False), T.StructField("sig", T.BinaryType(), False)])


def sketches(docs: DataFrame, keep: list[str], text: str = "text", n: int = SHINGLE) -> DataFrame:
    """``keep`` columns with the size of the set, 128 bits that tell equal sets, and the signature."""

    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        sets, at = shingle_sets(data, offs, n)
        sums = []
        for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(sets + np.uint64(salt)), dtype=np.uint64)))
            sums.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
        sig = signatures(sets, at)
        rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * COORDINATES), len(sig), [None, pa.py_buffer(sig.tobytes())])
        return [np.diff(at), *sums, rows.cast(pa.binary())]

    return map_text(docs, text, keep, SKETCH, kernel)


# --- candidates -------------------------------------------------------------------------------------------------------


def branch(node: np.ndarray, tree: np.ndarray, level: int, sig: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) of signatures at nodes: under one coordinate each, or under two."""
    h = mix(node.view(np.uint64) + np.uint64(level + 1))
    if 2 * level + 1 < OWN:
        first, second = tree.astype(np.int64) * OWN + 2 * level, tree.astype(np.int64) * OWN + 2 * level + 1
    else:
        first, second = (h % np.uint64(COORDINATES)).astype(np.int64), (mix(h) % np.uint64(COORDINATES)).astype(np.int64)
    two = (mix(h ^ np.uint64(0x9FB21C651E98DF25)) % np.uint64(1000)).astype(np.int64) < int(1000 * (1 / similarity - 1))
    rows = np.arange(len(node))
    again = rows[two & (first != second)]

    def child(at: np.ndarray, c: np.ndarray) -> np.ndarray:
        token = (c[at].astype(np.uint64) << np.uint64(16)) | sig[at, c[at]].view(np.uint16)
        return mix(h[at] + mix(token + np.uint64(1))).view(np.int64)

    return np.concatenate([rows, again]), np.concatenate([child(rows, first), child(again, second)])


def _matrix(col: pa.Array) -> np.ndarray:
    return flat(col)[0].view(np.int16).reshape(-1, COORDINATES)


def _first_nodes(trees: range, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (rep, sig) to (node, tree, rep) at level START of the trees."""
        for batch in batches:
            rep, sig = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for t in trees:
                rows, node = np.arange(len(rep)), np.full(len(rep), t, np.int64)
                for level in range(START):
                    more, node = branch(node, np.full(len(node), t), level, sig[rows], similarity)
                    rows = rows[more]
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.full(len(node), t, np.int8)), pa.array(rep[rows])], names=["node", "tree", "rep"])

    return run


NODES = "node long, tree byte, rep long"


def _selected(level: int, similarity: float):
    """Children of a node in DataFrame functions: under one coordinate of its signature, or under two."""
    pick = lambda k: F.pmod(F.xxhash64("node", F.lit(k)), F.lit(COORDINATES)).cast("int")
    first, second = pick(1), pick(2)
    if 2 * level + 1 < OWN:
        first, second = F.col("tree").cast("int") * OWN + 2 * level, F.col("tree").cast("int") * OWN + 2 * level + 1
    child = lambda c: F.xxhash64("node", c, F.substring(F.col("sig"), 2 * c + 1, 2))
    two = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1000)) < int(1000 * (1 / similarity - 1))
    return F.when(two & (first != second), F.array(child(first), child(second))).otherwise(F.array(child(first)))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, rep, sig) sorted by node: links of each document to the smallest of its part of the node."""

    def links(node: np.ndarray, rep: np.ndarray, sig: np.ndarray) -> pa.RecordBatch:
        label = np.arange(len(rep))
        pairs = []
        d = 1
        while d < len(node):
            i = np.flatnonzero(node[d:] == node[:-d])
            if not len(i):
                break
            near = np.concatenate([(sig[p] == sig[p + d]).sum(1) for p in np.array_split(i, max(1, len(i) // 20000))]) >= CANDIDATE * COORDINATES
            pairs.append(np.stack([i[near], i[near] + d]))
            d += 1
        a, b = np.concatenate(pairs, 1) if pairs else np.zeros((2, 0), int)
        order = np.lexsort((rep, node))
        rank = np.empty(len(rep), np.int64)
        rank[order] = np.arange(len(rep))
        label = rank.copy()
        while True:  # minimum over the links until nothing changes
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            if (new == label).all():
                break
            label = new
        to = rep[order[label]]
        keep = to != rep
        found = np.unique(np.stack([rep[keep], to[keep]], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        node, rep = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        sig = _matrix(batch.column(2))
        if rest is not None:
            node, rep, sig = (np.concatenate([x, y]) for x, y in zip(rest, (node, rep, sig)))
        cut = int(np.searchsorted(node, node[-1]))
        rest = node[cut:], rep[cut:], sig[cut:]
        if cut:
            yield links(node[:cut], rep[:cut], sig[:cut])
    if rest is not None:
        yield links(*rest)


def candidate_links(reps: DataFrame, similarity: float = NUMERATOR / DENOMINATOR, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) that join candidates, some of them repeated; ``reps`` has rep and sig, each set once."""
    rows = stored(reps.select("rep", "sig").mapInArrow(_first_nodes(range(trees), similarity), NODES))
    counts = rows.groupBy("node").count().where("count > 1")
    live = rows.join(spread(counts, "node").hint("merge"), "node")
    live = stored(live.join(reps, "rep").select("node", "tree", "rep", "sig", "count", F.lit(1 << 60).cast("long").alias("parent")))
    leaves, level = [], START
    while True:
        leaves.append(live.where(F.col("count") <= leaf).select("node", "rep", "sig"))
        big = live.where(F.col("count") > leaf)
        if not big.take(1):
            break
        stuck = F.col("count") >= STUCK * F.col("parent")
        leaves += _chunked(big.where(stuck), leaf)
        grown = big.where(~stuck).select("rep", "tree", "sig", F.col("count").alias("parent"), F.explode(_selected(level, similarity)).alias("node"))
        sizes = grown.groupBy("node").count().where("count > 1")
        live = stored(grown.join(spread(sizes, "node").hint("merge"), "node").select("node", "tree", "rep", "sig", "count", "parent"))
        level += 1
    union = leaves[0]
    for more in leaves[1:]:
        union = union.unionByName(more)
    # a leader may stand twice in its chunk, which adds no link
    return union.repartition("node").sortWithinPartitions("node").mapInArrow(_compare, "a long, b long")


def _chunked(rows: DataFrame, leaf: int) -> list[DataFrame]:
    """Nodes that hardly shrink, dealt into chunks of ``leaf`` documents that share leaders."""
    leader = lambda k: F.min_by(F.struct("rep", "sig"), F.xxhash64(F.lit(k), "node", "rep")).alias(f"l{k}")
    heads = rows.groupBy("node").agg(F.first("count").alias("n"), *[leader(k) for k in range(4)]).select("node", "n", F.explode(F.array_distinct(F.array(*[f"l{k}" for k in range(4)]))).alias("l"))
    chunks = lambda n: F.ceil(n / leaf).cast("long")
    every = heads.select(F.explode(F.transform(F.sequence(F.lit(0).cast("long"), chunks(F.col("n")) - 1), lambda c: F.xxhash64("node", c))).alias("node"), "l.rep", "l.sig")
    return [every, rows.select(F.xxhash64("node", F.pmod(F.xxhash64("rep", "node"), chunks(F.col("count")))).alias("node"), "rep", "sig")]


# --- confirmation -----------------------------------------------------------------------------------------------------


def linked_sets(sets: list[np.ndarray], extra: np.ndarray | None = None, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> list[tuple[int, int]]:
    """Exact links that connect ``sets`` as all links would.

    The shingles of one set are looked up in all others at once. A link between two components has an end outside the
    largest one, so the sets outside it are enough. With ``extra`` only these sets are looked up.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    parent = list(range(m))
    members = {i: [i] for i in range(m)}
    out = []

    def partners(i: int) -> np.ndarray:
        lo, hi = np.searchsorted(value, sets[i]), np.searchsorted(value, sets[i], side="right")
        n = hi - lo
        take = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        common = np.bincount(owner[take], minlength=m)
        hit = denominator * common >= numerator * (size + size[i] - common)
        hit[i] = False
        return np.flatnonzero(hit)

    def join(i: int, j: int) -> None:
        a, b = parent[i], parent[j]
        if a != b:
            if len(members[a]) < len(members[b]):
                a, b = b, a
            for k in members[b]:
                parent[k] = a
            members[a] += members.pop(b)
            out.append((i, j))

    done = np.zeros(m, bool)
    if extra is not None:
        done[:] = True
        done[extra] = False
    while True:
        largest = max(members.values(), key=len)
        inside = np.zeros(m, bool)
        if extra is None and len(largest) > 1:
            inside[largest] = True
        todo = np.flatnonzero(~done & ~inside)
        if not len(todo):
            return out
        for i in todo[: 1 if len(largest) == 1 else 16].tolist():
            done[i] = True
            for j in partners(i).tolist():
                join(i, j)


def _confirm(numerator: int, denominator: int):
    def run(rows: pa.Table) -> pa.Table:
        rep, ask = rows.column("rep").to_numpy(), rows.column("ask").to_numpy()
        lists = rows.column("shingles").combine_chunks()
        all_sets, at = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        _, first = np.unique(rep[np.argsort(~ask, kind="stable")], return_index=True)
        first = np.argsort(~ask, kind="stable")[first]  # each document once, as one that asks if it does
        sets = [all_sets[at[i] : at[i + 1]] for i in first]
        rep, ask = rep[first], ask[first]
        found = linked_sets(sets, np.flatnonzero(ask) if ask.any() else None, numerator, denominator) if len(sets) > 1 else []
        return pa.table({"a": pa.array([int(rep[i]) for i, _ in found], pa.int64()), "b": pa.array([int(rep[j]) for _, j in found], pa.int64())})

    return run


SETS = T.StructType([T.StructField("shingles", T.ArrayType(T.LongType()), False)])


def confirmed_links(texts: DataFrame, clusters: DataFrame, shingle: int = SHINGLE, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, chunk: int = CHUNK, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """Exact links (a, b) that connect the sets of each cluster as all its links would.

    ``texts`` has rep and the text of each set, ``clusters`` rep, cluster and n_shingles.
    """

    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        sets, at = shingle_sets(data, offs, shingle)
        return [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))]

    parts = lambda: F.ceil(F.greatest(F.count("*") / chunk, F.sum("n_shingles") / chunk_shingles)).cast("long")
    sizes = clusters.groupBy("cluster").agg(parts().alias("chunks"))
    placed = clusters.join(spread(sizes, "cluster").hint("merge"), "cluster").select("rep", "cluster", "chunks", "n_shingles")
    # the clustered documents grow with the table, so they are never broadcast: one plan at every size
    joined = texts.join(placed.hint("merge"), "rep")
    sets = stored(map_text(joined, "text", ["rep", "cluster", "chunks", "n_shingles"], SETS, kernel))
    mine = F.pmod(F.xxhash64("rep"), F.col("chunks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    many = sets.where("chunks > 1")
    leader = lambda k: F.min_by("rep", F.xxhash64(F.lit(k), "rep")).alias(f"l{k}")
    heads = many.groupBy("cluster").agg(*[leader(k) for k in range(6)]).select(F.explode(F.array_distinct(F.array(*[f"l{k}" for k in range(6)]))).alias("rep"))
    task = _confirm(numerator, denominator)
    no = F.lit(False).alias("ask")
    first = sets.select("cluster", mine.alias("chunk"), "rep", no, "shingles").unionByName(many.join(heads, "rep", "left_semi").select("cluster", every.alias("chunk"), "rep", no, "shingles"))
    links = stored(first.groupBy("cluster", "chunk").applyInArrow(task, "a long, b long"))
    if not many.take(1):
        return links
    # large clusters: what is outside the largest component asks every chunk
    comp = components(links)
    state = many.select("rep", "cluster", "n_shingles").join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left").select("rep", "cluster", "n_shingles", F.coalesce("component", "rep").alias("component"))
    state = stored(state)
    sizes = state.groupBy("cluster", "component").count().groupBy("cluster").agg(F.max_by("component", F.struct("count", "component")).alias("largest"))
    outside = state.join(sizes, "cluster").where(F.col("component") != F.col("largest"))
    blocks = outside.groupBy("cluster").agg(parts().alias("blocks"))
    asking = many.join(outside.select("rep"), "rep", "left_semi").join(blocks, "cluster")
    asked = many.join(blocks, "cluster")
    block = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks"))
    all_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = asking.select("cluster", every.alias("chunk"), block.alias("block"), "rep", F.lit(True).alias("ask"), "shingles").unionByName(
        asked.select("cluster", mine.alias("chunk"), all_blocks.alias("block"), "rep", no, "shingles"))
    return links.unionByName(rows.groupBy("cluster", "chunk", "block").applyInArrow(task, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """The id with n_shingles, component_id (smallest id reachable by links) and kept, one row for each row of ``docs``."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    sketch = sketches(slim, ["id", "th"], n=shingle).withColumn("rep", F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), F.xxhash64("set1", "set2", "n_shingles")))
    sketch = stored(sketch.drop("set1", "set2"))
    filled = sketch.where(F.col("rep").isNotNull())
    reps = filled.groupBy("rep").agg(F.min_by(F.struct("id", "th", "sig", "n_shingles"), F.struct("id", "th")).alias("r")).select("rep", "r.*")
    reps = stored(reps)
    clusters = components(candidate_links(reps, numerator / denominator)).select(F.col("id").alias("rep"), F.col("component").alias("cluster"))
    clusters = stored(clusters.join(reps.select("rep", "id", "th", "n_shingles"), "rep"))
    texts = slim.join(clusters.select("rep", "id", "th").hint("merge"), ["id", "th"]).select("rep", "text").dropDuplicates(["rep"])
    links = confirmed_links(texts, clusters.select("rep", "cluster", "n_shingles"), shingle, numerator, denominator)
    several = stored(sketch.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count("*").alias("n"), F.count("rep").alias("f")).where("a <> b or n > f"))
    twice = bool(several.take(1))  # ids with several texts: their sets belong together
    if twice:
        links = links.unionByName(filled.select("id", "rep").distinct().join(several.where("a <> b").select("id", "a"), "id").select("a", F.col("rep").alias("b")))
    comp = components(links)
    of = (reps if twice else clusters).select("rep", "id").join(comp.select(F.col("id").alias("rep"), "component"), "rep")
    least = of.groupBy("component").agg(F.min("id").alias("least"))
    final = of.join(spread(least, "component").hint("merge"), "component").select("rep", "least")
    final = reps.select("rep", "id").join(final, "rep", "left").select("rep", F.coalesce("least", "id").alias("component_id"))
    out = sketch.select("id", "n_shingles", "rep").join(spread(final, "rep").hint("merge"), "rep", "left").select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    if twice:
        lowest = out.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("component_id").alias("lowest"))
        out = out.join(spread(lowest, "id").hint("merge"), "id", "left").select("id", "n_shingles", F.coalesce("lowest", "component_id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
