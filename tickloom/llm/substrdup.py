"""Removal of repeated substrings of ``LENGTH`` bytes across and within documents.

Every window of LENGTH bytes has an anchor, its q-gram of smallest hash (leftmost on ties), so equal windows have equal
anchors at equal offsets and only windows of one anchor bucket need to meet. A document sends, for each anchor, the
bucket, 128 bits of the bytes that the anchor's windows span (its context), and where they start. In a bucket equal
contexts prove all their windows repeated at once; contexts that a batch of texts holds several times are known before
the shuffle, and only the first of them goes to its bucket. What is left, one of each distinct context of a bucket with several,
fetches its bytes and goes through bucket-pointer refinement: positions start in buckets of equal q-grams, and are sorted
again and again on the pair of their own bucket and the bucket of the position 32, 64 and then 72 bytes later; each
round's buckets are the next one's keys, and positions alone in their bucket drop out. Windows that share the last
bucket are equal in all their bytes. Buckets of over ``HOT`` distinct contexts are counted by window hash instead, dealt
out over all tasks.

Null texts are empty. Texts of fewer than LENGTH bytes lose nothing. Equal rows count as copies of each other; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import BYTE_CODE, CHUNK_BYTES, chunks, flat, map_text, mix, stored

LENGTH, GRAM = 200, 32
#: Window starts of a long text that are looked at together; distinct contexts of a bucket that one task refines.
SEGMENT, HOT = 1 << 18, 4_000
_MASK = np.uint64((1 << 21) - 1)
_STEPS = [(1, np.uint64(0x9E3779B97F4A7C15 | 1)), (2, np.uint64(0xC2B2AE3D27D4EB4F | 1)), (4, np.uint64(0xD6E8FEB86659FD93 | 1)), (8, np.uint64(0xA0761D6478BD642F | 1)), (16, np.uint64(0xE7037ED1A0B428DB | 1))]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all runs of GRAM bytes."""
    h = BYTE_CODE[data]
    for step, factor in _STEPS:
        if len(h) <= step:
            return np.zeros(0, np.uint64)
        h = h[:-step] * factor + h[step:]
        if step in (4, 16):
            h ^= h >> np.uint64(29)
    return h


def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    m, w = key, 1
    while 2 * w <= width:
        m = np.minimum(m[:-w], m[w:])
        w *= 2
    return np.minimum(m[: len(m) - (width - w)], m[width - w :]) if w < width else m


def anchors(data: np.ndarray, offs: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Anchors of all windows: document, bucket, context hashes, position of the anchor, first and last window start."""
    out: dict[str, list] = {k: [] for k in ("doc", "q", "c1", "c2", "p", "lo", "hi")}

    def part(base: int, bytes_: np.ndarray, bounds: np.ndarray, docs: np.ndarray) -> None:
        if len(bytes_) < length:
            return
        h = gram_hashes(bytes_)
        key = (mix(h) & ~_MASK) | np.arange(len(h), dtype=np.uint64)
        low = _sliding_min(key, length - GRAM + 1)
        n = np.diff(bounds)
        ends = np.repeat(bounds[1:], n)[: len(low)]
        start = np.flatnonzero(np.arange(len(low)) + length <= ends)
        if not len(start):
            return
        p = (low[start] & _MASK).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), n)[start]
        new = np.concatenate(([True], (p[1:] != p[:-1]) | (doc[1:] != doc[:-1])))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        lo, hi, p, doc = start[first], start[last], p[first], doc[first]
        size = hi - lo + length
        c1 = mix((p - lo).astype(np.uint64) * np.uint64(4096) + size.astype(np.uint64))
        c2 = mix(c1 ^ np.uint64(0xA0761D6478BD642F))
        for k in range(-(-(2 * length) // GRAM)):
            at = h[lo + np.minimum(GRAM * k, size - GRAM)]
            c1, c2 = mix(c1 + at), mix(c2 ^ (at * np.uint64(0x9FB21C651E98DF25)))
        origin = bounds[doc] - base
        for name, v in (("doc", docs[doc]), ("q", mix(h[p]).view(np.int64)), ("c1", c1.view(np.int64)), ("c2", c2.view(np.int64)), ("p", p - origin), ("lo", lo - origin), ("hi", hi - origin)):
            out[name].append(v)

    sizes = np.diff(offs)
    if len(data) <= SEGMENT + length:
        part(0, data, offs, np.arange(len(sizes)))
    else:
        at = 0
        while at < len(sizes):
            if sizes[at] > SEGMENT:  # a long text in parts that share length - 1 bytes
                whole = data[offs[at] : offs[at + 1]]
                for a in range(0, len(whole) - length + 1, SEGMENT):
                    piece = whole[a : a + SEGMENT + length - 1]
                    part(a, piece, np.array([0, len(piece)]), np.array([at]))
                at += 1
                continue
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + SEGMENT, side="right")) - 1)
            part(0, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at], np.arange(at, to))
            at = to
    kinds = {"doc": np.int64, "q": np.int64, "c1": np.int64, "c2": np.int64, "p": np.int32, "lo": np.int32, "hi": np.int32}
    return {k: np.concatenate(v).astype(kinds[k]) if v else np.zeros(0, kinds[k]) for k, v in out.items()}


_ANCHOR = T.StructType([T.StructField(c, T.LongType(), False) for c in ("q", "c1", "c2")] + [T.StructField(c, T.IntegerType(), False) for c in ("p", "lo", "hi", "seen")])
ANCHORS = T.StructType([T.StructField("anchors", T.ArrayType(_ANCHOR, False), False)])


def _anchor_kernel(length: int):
    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        a = anchors(data, offs, length)
        # 0: alone in this batch, 1: the first of several, 2: a further one, which needs no bucket
        order = np.lexsort((a["c2"], a["c1"]))
        same = (np.diff(a["c1"][order]) == 0) & (np.diff(a["c2"][order]) == 0) if len(order) else np.zeros(0, bool)
        a["seen"] = np.zeros(len(order), np.int32)
        a["seen"][order[:-1][same]] = 1
        a["seen"][order[1:][same]] = 2
        at = np.concatenate(([0], np.cumsum(np.bincount(a["doc"], minlength=len(offs) - 1))))
        fields = [pa.field(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.int32(), False) for f in _ANCHOR]
        rows = pa.StructArray.from_arrays([pa.array(a[f.name]) for f in fields], fields=fields)
        return [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), rows)]

    return kernel


#: kind 0: windows lo..hi of a document repeat; kind 1: a context whose bytes must be compared.
MET = "kind int, q long, kid long, th long, p int, lo int, hi int"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (q, c1, c2, kid, th, p, lo, hi, seen) sorted by the first three. Only the last row and one waiting context are kept."""
    cols: list[np.ndarray] = []
    same_before, several, waiting = False, False, None
    columns = [0, 3, 4, 5, 6, 7]

    def out(kind: int, rows: list[np.ndarray]) -> pa.RecordBatch:
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows[0]), kind, np.int32)), *[pa.array(r, t) for r, t in zip(rows, types[1:])]], names=["kind", "q", "kid", "th", "p", "lo", "hi"])

    for batch in batches:
        if not batch.num_rows:
            continue
        new = [c.to_numpy() for c in batch.columns]
        known = new[8] == 2
        if known.any():
            yield out(0, [new[k][known] for k in columns])
            new = [c[~known] for c in new]
            if not len(new[0]):
                continue
        held = len(cols) > 0
        cols = [np.concatenate([c[-1:], x]) for c, x in zip(cols, new)] if held else new
        n = len(cols[0])
        q = cols[0]
        same_q = q[1:] == q[:-1]
        same = same_q & (cols[1][1:] == cols[1][:-1]) & (cols[2][1:] == cols[2][:-1])
        before = np.concatenate(([same_before], same))
        after = np.append(same, False)
        twice = np.flatnonzero((before | after | (cols[8] == 1))[: n - 1])
        yield out(0, [cols[k][twice] for k in columns])
        # first rows of contexts; the held row was seen as one in its own batch
        fresh = np.flatnonzero(~before[1:]) + 1 if held else np.flatnonzero(~before)
        starts = np.concatenate(([0], np.flatnonzero(~same_q) + 1))
        bucket = np.searchsorted(starts, fresh, side="right") - 1
        count = np.bincount(bucket, minlength=len(starts))
        earlier = np.zeros(len(starts), np.int64)
        if held:
            earlier[0] = 2 if several else 1
        total = count + earlier
        if held and waiting is not None and total[0] >= 2:
            yield out(1, waiting)
        more = fresh[total[bucket] >= 2]
        yield out(1, [cols[k][more] for k in columns])
        end = len(starts) - 1
        if total[end] >= 2:
            waiting = None
        elif count[end]:
            waiting = [cols[k][fresh[-1:]] for k in columns]
        several = bool(total[end] >= 2)
        same_before = bool(before[-1])
    if cols and (same_before or cols[8][-1] == 1):
        yield out(0, [c[-1:] for c in (cols[k] for k in columns)])


def refine(data: np.ndarray, offs: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each byte of the contexts in a row: whether the window of ``length`` bytes that starts there occurs again."""
    n = len(data)
    room = np.repeat(offs[1:], np.diff(offs)) - np.arange(n)  # bytes up to the end of the context
    h = gram_hashes(data)
    bucket = np.full(n, -1, np.int64)

    def renamed(at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Bucket numbers by equal keys; -1 for positions alone in theirs."""
        order = np.argsort(key, kind="stable")
        k = key[order]
        first = np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.zeros(0, bool)
        number = np.cumsum(first) - 1
        alone = np.bincount(number, minlength=1)[number] == 1 if len(k) else np.zeros(0, bool)
        out = np.full(n, -1, np.int64)
        out[at[order]] = np.where(alone, -1, number)
        return out

    at = np.flatnonzero(room >= GRAM)
    bucket = renamed(at, h[at])
    size = GRAM
    while size < length:
        step = min(size, length - size)
        at = np.flatnonzero((room >= size + step) & (bucket >= 0))
        at = at[bucket[at + step] >= 0]
        bucket = renamed(at, (bucket[at].astype(np.uint64) << np.uint64(32)) | bucket[at + step].astype(np.uint64))
        size += step
    return bucket >= 0


SPANS = "kid long, th long, lo int, hi int"


def _spans(kid: np.ndarray, th: np.ndarray, lo: np.ndarray, offs: np.ndarray, hit: np.ndarray) -> pa.RecordBatch:
    """Runs of hit window starts per context as rows."""
    owner = np.repeat(np.arange(len(kid)), np.diff(offs))
    at = np.flatnonzero(hit)
    if not len(at):
        first = last = np.zeros(0, np.int64)
    else:
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(owner[at]) != 0))
        first, last = at[np.concatenate(([0], cut + 1))], at[np.append(cut, len(at) - 1)]
    o = owner[first]
    base = lo[o] - offs[o]
    return pa.RecordBatch.from_arrays([pa.array(kid[o]), pa.array(th[o]), pa.array((first + base).astype(np.int32)), pa.array((last + base).astype(np.int32))], names=["kid", "th", "lo", "hi"])


def _refine_buckets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (q, kid, th, lo, ctx) sorted by q; whole buckets of half a MB are refined together."""
        held: list[pa.RecordBatch] = []
        size = 0

        def ready(table: pa.Table) -> pa.RecordBatch:
            data, offs = flat(table.column("ctx").combine_chunks() if table.num_rows else pa.array([], pa.binary()))
            kid, th, lo = (table.column(c).to_numpy() for c in ("kid", "th", "lo"))
            return _spans(kid, th, lo.astype(np.int64), offs, refine(data, offs, length))

        for batch in batches:
            for small in chunks(batch, 4, CHUNK_BYTES // 4):
                held.append(small)
                size += small.nbytes
                if size > CHUNK_BYTES // 2:
                    table = pa.Table.from_batches(held)
                    q = table.column("q").to_numpy()
                    cut = int(np.searchsorted(q, q[-1]))
                    if cut:
                        yield ready(table.slice(0, cut))
                    rest = table.slice(cut).combine_chunks().to_batches()
                    held, size = rest, sum(b.nbytes for b in rest) if cut else 0
        if held:
            yield ready(pa.Table.from_batches(held))

    return run


def _packed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(kid, th, z): the key of a row and its compressed text, so that text shuffles small."""

    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        import zstandard

        raw, z = data.tobytes(), zstandard.ZstdCompressor(level=1)
        return [pa.array([z.compress(raw[a:b]) for a, b in zip(offs[:-1], offs[1:])], pa.binary())]

    return map_text(_keyed(docs, id_col, text), "text", ["id", "kid", "th"], T.StructType([T.StructField("z", T.BinaryType(), False)]), kernel)


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    t = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return t.select("id", F.coalesce(F.xxhash64("id"), F.lit(0)).alias("kid"), F.xxhash64(F.col("id").isNull(), "text").alias("th"), "text")


def _contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        for batch in batches:
            kid, th = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            q, k, t, lo, ctx, size = [], [], [], [], [], 0
            for i in range(batch.num_rows):
                text = z.decompress(batch.column(2)[i].as_py())
                for r in batch.column(3)[i].as_py():
                    q.append(r["q"])
                    k.append(kid[i])
                    t.append(th[i])
                    lo.append(r["lo"])
                    ctx.append(text[r["lo"] : r["hi"] + length])
                    size += len(ctx[-1])
                if size > CHUNK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(k, pa.int64()), pa.array(t, pa.int64()), pa.array(lo, pa.int32()), pa.array(ctx, pa.binary())], names=["q", "kid", "th", "lo", "ctx"])
                    q, k, t, lo, ctx, size = [], [], [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(k, pa.int64()), pa.array(t, pa.int64()), pa.array(lo, pa.int32()), pa.array(ctx, pa.binary())], names=["q", "kid", "th", "lo", "ctx"])

    return run


def _window_rows(length: int):
    """Of contexts in hot buckets a row for each window: 128 bits of its bytes and where it starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for small in chunks(batch, 4, CHUNK_BYTES // 8):
                data, offs = flat(small.column(4))
                h = gram_hashes(data)
                n = np.maximum(0, np.diff(offs) - length + 1)
                owner = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                at = offs[:-1][owner] + step
                a = b = np.zeros(len(at), np.uint64)
                for k in [*range(0, length - GRAM, GRAM), length - GRAM]:
                    a, b = mix(a + h[at + k]), mix(b ^ (h[at + k] * np.uint64(0x9FB21C651E98DF25)))
                kid, th, lo = (small.column(i).to_numpy()[owner] for i in (1, 2, 3))
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(kid), pa.array(th), pa.array((lo + step).astype(np.int32))], names=["w1", "w2", "kid", "th", "s"])

    return run


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(kid, th, lo, hi): starts lo..hi of windows that occur elsewhere too, by key of the row."""
    found = map_text(_keyed(docs, id_col, text), "text", ["kid", "th"], ANCHORS, _anchor_kernel(length))
    rows = found.select("kid", "th", F.explode("anchors").alias("a")).select("a.q", "a.c1", "a.c2", "kid", "th", "a.p", "a.lo", "a.hi", "a.seen")
    place = F.when(F.col("seen") == 2, F.xxhash64("kid", "p")).otherwise(F.col("q"))
    met = stored(rows.repartition(place).sortWithinPartitions("q", "c1", "c2").mapInArrow(_meet, MET))
    asked = met.where("kind = 1").groupBy("kid", "th").agg(F.collect_list(F.struct("q", "lo", "hi")).alias("asked"))
    texts = _packed(docs, id_col, text).select("kid", "th", "z").join(asked.hint("merge"), ["kid", "th"]).dropDuplicates(["kid", "th"])
    crowded = met.where("kind = 1").groupBy("q").count().where(F.col("count") > hot).select("q")
    context = texts.select("kid", "th", "z", "asked").mapInArrow(_contexts(length), "q long, kid long, th long, lo int, ctx binary")
    out = met.where("kind = 0").select("kid", "th", "lo", "hi")
    if crowded.take(1):
        context, crowded = stored(context), stored(crowded)
        windows = context.join(crowded, "q", "left_semi").mapInArrow(_window_rows(length), "w1 long, w2 long, kid long, th long, s int")
        again = windows.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
        out = out.unionByName(windows.join(again, ["w1", "w2"]).select("kid", "th", F.col("s").alias("lo"), F.col("s").alias("hi")))
        context = context.join(crowded, "q", "left_anti")
    return out.unionByName(context.repartition("q").sortWithinPartitions("q").mapInArrow(_refine_buckets(length), SPANS))


def covered(lo: np.ndarray, hi: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows that start at lo..hi."""
    out: list[list[int]] = []
    for i in np.argsort(lo, kind="stable").tolist():
        a, b = int(lo[i]), int(hi[i]) + length
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


RESULT = "id {id}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{more}"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, kept_bytes: bool = False, hot: int = HOT) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, and with ``kept_bytes`` the remaining bytes as ``kept``."""
    spans = repeated_windows(docs, id_col, text, length, hot).groupBy("kid", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    rows = _packed(docs, id_col, text).join(spans.hint("merge"), ["kid", "th"], "left").select("id", "z", F.coalesce("spans.lo", F.array().cast("array<int>")).alias("lo"), F.coalesce("spans.hi", F.array().cast("array<int>")).alias("hi"))
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        for batch in batches:
            n, removed, count, sha, rest = [], [], [], [], []
            los, his = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                raw = z.decompress(batch.column(1)[i].as_py())
                cut = covered(los[i].values.to_numpy(), his[i].values.to_numpy(), length)
                edges = [0, *[x for c in cut for x in c], len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                n.append(len(raw))
                removed.append(len(raw) - len(kept))
                count.append(len(cut))
                sha.append(hashlib.sha256(kept).hexdigest())
                if kept_bytes:
                    rest.append(kept)
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(rest, pa.binary())] * kept_bytes, names=names + ["kept"] * kept_bytes)

    schema = RESULT.format(id=kind.simpleString(), more=", kept binary" if kept_bytes else "")
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
