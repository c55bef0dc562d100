"""Benchmark decontamination: n-gram windows of benchmark items looked up in every document.

The hash set of all windows is broadcast only while the benchmark's size, which is measured first, stays below
``broadcast_bytes``. The windows of a larger one stay in a table: a filter of fixed size, made from their hashes, picks the
document windows that may occur there, these are shuffled and joined by hash and text, and their spans are united per
document. Both ways give the same rows.

Null or wordless documents have no words and no hits; null or wordless items have no windows; repeated items count once
by id; the windows of an item without an id hit like all others, but it is no item of the list and of the count; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import FOLD_AZ, Words, boxed, byte_table, map_text, stored, window_hashes

WINDOW = 13
#: A window takes some 250 bytes of memory in every Python worker, and a text of this size has about 400,000.
BROADCAST_BYTES = 2 << 20
#: Word bytes: all but 00-2F, 3A-60 and 7B-7F, after A-Z became a-z.
WORD = byte_table(lambda b: not (b <= 0x2F or 0x3A <= FOLD_AZ[b] <= 0x60 or 0x7B <= b <= 0x7F))


def _windows(items: list[tuple[str | None, str | None]], n: int) -> tuple[dict[bytes, list[str]], dict[int, np.ndarray]]:
    """Text of each window with the items that have it; for each window length the sorted hashes."""
    texts = [(t or "").encode() for _, t in items]
    offs = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    words = Words(np.frombuffer(b"".join(texts), np.uint8), offs, WORD, FOLD_AZ)
    hashes = words.hashes()
    of: dict[bytes, set[str]] = {}
    by_length: dict[int, list[int]] = {}
    for i, (item, _) in enumerate(items):
        first, count = int(words.first[i]), int(words.count[i])
        if count:
            k = min(n, count)
            by_length.setdefault(k, []).extend(window_hashes(hashes[first : first + count], k).tolist())
            for j in range(first, first + count - k + 1):
                of.setdefault(words.text(j, k), set()).update([] if item is None else [item])
    return {w: sorted(s) for w, s in of.items()}, {k: np.unique(np.array(v, np.uint64)) for k, v in by_length.items()}


BITS = 22


def _kernel(of: dict[bytes, list[str]], by_length: dict[int, np.ndarray]):
    filters = {}
    for k, known in by_length.items():
        filters[k] = np.zeros(1 << BITS, bool)
        filters[k][(known >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        words = Words(data, offs, WORD, FOLD_AZ)
        hashes = words.hashes()
        n = len(offs) - 1
        cover = np.zeros(len(hashes) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(n)]
        for k, known in by_length.items():
            found = window_hashes(hashes, k)
            at = np.flatnonzero(filters[k][(found >> np.uint64(64 - BITS)).astype(np.int64)])
            at = at[np.isin(found[at], known)]
            for i in at[words.doc[at] == words.doc[at + k - 1]].tolist():
                if (whose := of.get(words.text(i, k))) is not None:
                    items[words.doc[i]].update(whose)
                    cover[i] += 1
                    cover[i + k] -= 1
        hit = np.concatenate(([False], np.cumsum(cover)[:-1] > 0, [False]))
        fresh = np.zeros(len(hit), bool)
        fresh[words.first] = True  # spans end with their document
        starts = np.flatnonzero(hit[1:] & (~hit[:-1] | fresh[: len(hit) - 1]))
        ends = np.flatnonzero(hit[:-1] & (~hit[1:] | fresh[: len(hit) - 1]))
        starts, ends = starts[starts < len(hashes)], ends[ends > 0]
        spans: list[list[dict]] = [[] for _ in range(n)]
        for s, e in zip(starts.tolist(), ends.tolist()):
            d = words.doc[s]
            f = int(words.first[d])
            spans[d].append({"first": s - f, "end": e - f, "from_byte": int(words.start[s] - offs[d]), "to_byte": int(words.end[e - 1] - offs[d])})
        return [words.count, spans, [sorted(x) for x in items]]

    return kernel


SPANS = T.ArrayType(T.StructType([T.StructField(c, T.LongType(), False) for c in ("first", "end", "from_byte", "to_byte")]))
FOUND = T.StructType([T.StructField("n_words", T.LongType(), False), T.StructField("spans", SPANS, False), T.StructField("items", T.ArrayType(T.StringType()), False)])


def find_hits(docs: DataFrame, bench: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``keep`` columns with n_words, the hit spans (words and bytes, end exclusive) and the ids of the items that occur."""
    small = bench.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    size = small.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("b")).first().b or 0
    if size <= broadcast_bytes:
        return map_text(docs, text, keep, FOUND, _kernel(*_windows([(r.item, r.text) for r in small.collect()], window)))
    return _joined(docs, small, keep, text, window)


# --- benchmarks too large to broadcast ------------------------------------------------------------------------------------

#: Bits of the filter that decides which document windows are shuffled at all: 16 MB at every size of the benchmark.
FILTER_BITS = 27
_WINDOW = T.StructType([T.StructField("k", T.IntegerType(), False), T.StructField("h", T.LongType(), False), T.StructField("g", T.BinaryType(), False)])
WINDOWS = T.StructType([T.StructField("windows", T.ArrayType(_WINDOW, False), False)])
_PLACE = T.StructType([*_WINDOW.fields, *[T.StructField(c, T.LongType(), False) for c in ("first", "end", "from_byte", "to_byte")]])
PLACES = T.StructType([T.StructField("n_words", T.LongType(), False), T.StructField("places", T.ArrayType(_PLACE, False), False)])


def _item_kernel(n: int):
    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        words = Words(data, offs, WORD, FOLD_AZ)
        hashes = words.hashes()
        out: list[list[dict]] = []
        for first, count in zip(words.first[:-1].tolist(), words.count.tolist()):
            k = min(n, count)
            h = window_hashes(hashes[first : first + count], k).view(np.int64).tolist() if count else []
            out.append([{"k": k, "h": x, "g": words.text(first + j, k)} for j, x in enumerate(h)])
        return [out]

    return kernel


def _place_kernel(lengths: list[int], known: np.ndarray):
    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        words = Words(data, offs, WORD, FOLD_AZ)
        hashes = words.hashes()
        out: list[list[dict]] = [[] for _ in range(len(offs) - 1)]
        for k in lengths:
            found = window_hashes(hashes, k)
            bit = (found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            at = np.flatnonzero((known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
            for i in at[words.doc[at] == words.doc[at + k - 1]].tolist():
                d = int(words.doc[i])
                f, e = int(words.first[d]), i + k
                out[d].append({"k": k, "h": int(found[i].view(np.int64)), "g": words.text(i, k), "first": i - f, "end": e - f, "from_byte": int(words.start[i] - offs[d]), "to_byte": int(words.end[e - 1] - offs[d])})
        return [words.count, out]

    return kernel


def _joined(docs: DataFrame, bench: DataFrame, keep: list[str], text: str, window: int) -> DataFrame:
    """One pass over the documents at every size of the benchmark: windows that the filter knows meet by hash and text."""
    of = map_text(bench, "text", ["item"], WINDOWS, _item_kernel(window)).select("item", F.explode("windows").alias("w")).select("item", "w.*").distinct()
    of = stored(of)
    lengths = [r.k for r in of.select("k").distinct().collect()]  # 1 to ``window``
    bit = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    known = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in of.groupBy(F.shiftright(bit, 15).alias("b")).agg(F.bitmap_construct_agg(bit.bitwiseAND(F.lit((1 << 15) - 1))).alias("m")).collect():
        known[r.b << 12 : (r.b + 1) << 12] = np.frombuffer(r.m, np.uint8)
    keyed = boxed(docs, text).withColumnsRenamed({text: "text"}).select("row", "text", *[F.xxhash64(F.lit(k), "row").alias(f"id{k}") for k in (1, 2)])
    ids = ["id1", "id2"]
    seen = stored(map_text(keyed, "text", ids, PLACES, _place_kernel(lengths, known)).dropDuplicates(ids))
    places = seen.select(*ids, F.explode("places").alias("p")).select(*ids, "p.*")
    hits = stored(places.join(of.hint("merge"), ["k", "h", "g"]).select(*ids, "item", "first", "end", "from_byte", "to_byte"))
    items = hits.where(F.col("item").isNotNull()).select(*ids, "item").distinct().groupBy(*ids).agg(F.array_sort(F.collect_list("item")).alias("items"))
    at = Window.partitionBy(*ids).orderBy("first", "end")
    fresh = F.coalesce(F.max("end").over(at.rowsBetween(Window.unboundedPreceding, -1)) < F.col("first"), F.lit(True))
    runs = hits.drop("item").distinct().withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(at.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*ids, "run").agg(F.min("first").alias("first"), F.max("end").alias("end"), F.min("from_byte").alias("from_byte"), F.max("to_byte").alias("to_byte"))
    spans = runs.groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct("first", "end", "from_byte", "to_byte"))).alias("spans"))
    found = seen.select(*ids, "n_words").join(spans.hint("merge"), ids, "left").join(items.hint("merge"), ids, "left")
    made = [F.coalesce(c, F.array().cast(FOUND[c].dataType.simpleString())).alias(c) for c in ("spans", "items")]
    names = {c.lower() for c in FOUND.names}
    kept = [F.col(f"row.`{c}`") for c in keep if c.lower() not in names]
    return keyed.join(found.hint("merge"), ids).select(*kept, "n_words", *made)


def judged(hits: DataFrame) -> DataFrame:
    """``find_hits`` with n_hit, n_items and the decision: contaminated if a twentieth of the words or more are hit."""
    out = hits.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"]))
    out = out.withColumn("n_items", F.size("items").cast("long"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def digest(hits: DataFrame) -> DataFrame:
    return judged(hits).select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")
