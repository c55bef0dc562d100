"""What the corpus operators share: Arrow text batches as flat numpy bytes, word hashing, samples, shared folders."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of text that a kernel looks at at once; one longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 20
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def table(spark: SparkSession, sf_dir: str, name: str, dealt: bool = False) -> DataFrame:
    """A table of the folder; with ``dealt`` its rows are dealt out over all cores where its files give fewer partitions."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if dealt and df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder serves a local master, as in tests; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tickloom-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    (df.coalesce(partitions) if partitions else df).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """An aggregate dealt out evenly once more, so that a join by ``key`` brings both sides by exchanges of its own.

    Only then can adaptive execution split a hot key; directly above an aggregate the join would reuse its distribution.
    """
    return df.repartition(F.xxhash64(key, F.lit(7)))


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores after it until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def boxed(docs: DataFrame, *columns: str) -> DataFrame:
    """Each row as the struct ``row`` beside the given columns, so that no name of a user's column meets a helper's."""
    return docs.select(F.struct("*").alias("row"), *[F.col(f"`{c}`") for c in columns])


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column (null: empty) and the n + 1 offsets into them."""
    col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have at most ``limit`` bytes, or a single row."""
    _, offs = flat(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def map_text(docs: DataFrame, text: str, keep: list[str], outputs: T.StructType, kernel: Callable, limit: int = CHUNK_BYTES) -> DataFrame:
    """``keep`` columns of ``docs`` with the columns of ``kernel(data, offsets) -> list of arrays`` beside them.

    The kernel sees flat bytes of whole texts. Of a kept column that has the name of an output (in any case), the output
    stays.
    """
    made_names = {c.lower() for c in outputs.names}
    kept = [c for c in keep if c.lower() not in made_names]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(unused("text", kept)))
    schema = T.StructType([*[source.schema[c] for c in kept], *outputs.fields])
    arrow = to_arrow_schema(schema, timestamp_utc=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, len(kept), limit):
                found = kernel(*flat(part.column(len(kept))))
                made = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type) for x, f in zip(found, list(arrow)[len(kept) :], strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(i).cast(arrow.field(i).type) for i in range(len(kept))], *made], schema=arrow)

    return source.mapInArrow(run, schema)


# --- words and their hashes -------------------------------------------------------------------------------------------

_P, _Q = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93 | 1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i < n at least."""
    found = _powers.get(int(base))
    if found is None or len(found[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        found = _powers[int(base)] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return found


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


#: For every byte a random odd number; the same in every process.
BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


class Words:
    """Maximal runs of word bytes in flat texts: where they start and end, the text of each, prefix sums for hashes."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, word: np.ndarray, fold: np.ndarray):
        self.data, self.offs = fold[data], offs
        is_word = word[data]
        fresh = np.zeros(len(data) + 1, bool)
        fresh[offs[:-1][offs[:-1] < len(data)]] = True
        inside = np.concatenate(([False], is_word, [False]))
        begin = is_word & (~inside[:-2] | fresh[:-1])
        end = is_word & (~inside[2:] | fresh[1:])
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.doc = np.searchsorted(offs, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=len(offs) - 1)
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        up, _ = powers(_P, len(data) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODE[self.data] * up[: len(data)], dtype=np.uint64)))

    def hashes(self, length: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the words, or of their first ``length`` bytes."""
        end = self.end if length is None else self.start + length
        _, down = powers(_P, len(self.data) + 1)
        return mix((self.sums[end] - self.sums[self.start]) * down[self.start])

    def text(self, i: int, n: int = 1) -> bytes:
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[i : i + n], self.end[i : i + n]))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbouring word hashes (also of those that cross texts)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, down = powers(_Q, len(words) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)))
    return mix((sums[n:] - sums[:-n]) * down[: len(words) - n + 1] + np.uint64(n))


def byte_table(keep: Callable[[int], bool]) -> np.ndarray:
    return np.array([keep(b) for b in range(256)], bool)


#: A-Z become a-z; all other bytes stay.
FOLD_AZ = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SAME = np.arange(256, dtype=np.uint8)


# --- labelled samples -------------------------------------------------------------------------------------------------


def remainder(col: str, mod: int):
    """crc32 of an id as text, modulo ``mod``."""
    return F.crc32(F.col(col).cast("string")) % mod


def held_out(col: str, mod: int, held: int):
    """Whether a row is held out of training; false for rows without an id, which have no label either."""
    return F.coalesce(remainder(col, mod) == held, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held: int, per_class: int, max_chars: int) -> tuple[list[tuple[int, str]], float]:
    """(label, text) of at most ``per_class`` training rows of each class, and the share of label 1 among training rows.

    Of the rows that have both a label and a text of at most ``max_chars`` characters those of smallest id hash are taken,
    so the driver gets 2 * per_class * max_chars characters at most. Both tables are cut by the hash before they meet; where
    too few labelled rows have a text, the cut is raised until there are enough or all took part. Held-out rows
    (crc32(doc_id) mod ``mod`` = ``held``) and rows without an id never take part; rows that repeat id, label and text
    count once. Without labels the share is 0.5.
    """
    whole = 1 << 40
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(whole))
    base = labels.select("doc_id", F.col(label).cast("int").alias("y"), place.alias("h")).where(F.col("doc_id").isNotNull() & (remainder("doc_id", mod) != held) & F.col("y").isin(0, 1))
    texts = docs.select("doc_id", "text", place.alias("h")).where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    counts = {r.y: r["count"] for r in base.groupBy("y").count().collect()}
    cut = {y: whole * 2 * per_class // n for y, n in counts.items()}
    found: dict[int, list[tuple[int, str]]] = {}
    expected = 2 * per_class  # labelled rows of a class below the cut
    while cut:
        near = base.where(F.coalesce(*[F.when((F.col("y") == y) & (F.col("h") < c), F.lit(True)) for y, c in cut.items()], F.lit(False))).dropDuplicates()
        near = F.broadcast(near) if expected <= 100_000 else near  # some 32 bytes a row
        pairs = texts.where(F.col("h") < max(cut.values())).drop("h").join(near, "doc_id").dropDuplicates(["y", "doc_id", "text"])
        first = [pairs.where(F.col("y") == y).orderBy("h", "text").limit(per_class) for y in cut]
        for y, part in zip(cut, first):
            found[y] = sorted((r.h, r.text) for r in part.collect())
        cut, expected = {y: 16 * c for y, c in cut.items() if len(found[y]) < per_class and c < whole}, 16 * expected
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    return [(y, text) for y in (0, 1) for _, text in found.get(y, [])], share


def platt(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Weights (last: bias) of a ridge logistic regression by Newton steps; x has a row for each sample."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + ridge * np.eye(len(w)), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
