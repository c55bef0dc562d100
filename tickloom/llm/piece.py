"""SentencePiece BPE with byte fallback, encoded by vectorised merge rounds and decoded by table look-up.

A text becomes symbols (characters) in one flat numpy array. Every round finds, for each word, the adjacent pair of best
rank (segmented minimum), merges it at its leftmost place in all words at once, compacts the array, and goes on until no
pair is left. Where no piece that starts or ends with the merged one ranks as high or higher, all places of that pair in
the word are merged in the same round; the result is the same as one by one. Words end where no piece can span: before a
space mark that follows another character, and around characters that are in no longer piece.

In words of over ``LONG`` symbols a round merges every pair that is the best in its own surroundings. No piece is longer
than ``longest`` characters, so a pair can lose its symbols only to a better one at most that far away; a pair whose piece
would at once merge on at its own rank or better waits until it is the first and best of surroundings twice as wide. So
hardly any round depends on the word's length, and the result is again that of merging one by one.

Null and empty texts have the ids [begin, end] and decode to an empty text; equal rows stay equal rows; an empty table
gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import map_text

SPACE = "▁"
#: Words kept with their ids in each Python worker, and bytes of both; then the memory is cleared.
CACHE_WORDS, CACHE_BYTES = 300_000, 64 << 20
#: Symbols of a word from which its rounds look at surroundings instead of the whole word.
LONG = 64
#: Bytes of text whose new words are merged together: a round costs the same for few words as for many.
MERGE_BYTES = 2 << 20
NONE = np.int64(1 << 40)


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


import codecs  # noqa: E402

codecs.register_error("tickloom.each_byte", _each_byte)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` elements."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


class Cache(dict):
    """Ids by word; knows how many bytes both take."""

    size = 0

    def keep(self, words: list[str], ids: list[bytes]) -> None:
        self.update(zip(words, ids))
        self.size += sum(map(len, words)) + sum(map(len, ids))

    def clear(self) -> None:
        super().clear()
        self.size = 0


class PairTable:
    """Pairs of symbols with their rank and piece, by open addressing in a sparse table; all look-ups of a round at once."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray):
        bits = max(10, int(len(keys) * 8 - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.full(1 << bits, -1, np.int64)
        at, wait = self._slot(keys), np.arange(len(keys))
        where = np.zeros(len(keys), np.int64)
        while len(wait):  # in every round the first key that wants a free slot gets it
            slots, first = np.unique(at[wait], return_index=True)
            free = self.key[slots] < 0
            won = wait[first[free]]
            self.key[at[won]], where[won] = keys[won], at[won]
            wait = np.setdiff1d(wait, won, assume_unique=True)
            at[wait] = (at[wait] + 1) & self.mask
        # of a pair that makes no piece: rank NONE
        self.rank, self.made = np.full(1 << bits, NONE), np.zeros(1 << bits, np.int64)
        self.rank[where], self.made[where] = ranks, made

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair."""
        at = self._slot(keys)
        there = self.key[at]
        off = np.flatnonzero((there != keys) & (there >= 0))
        while len(off):
            at[off] = (at[off] + 1) & self.mask
            there[off] = self.key[at[off]]
            off = off[(there[off] != keys[off]) & (there[off] >= 0)]
        return self.rank[at], self.made[at]


class PieceModel:
    """Vocabulary and merge table of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        byte = [sp.is_byte(i) for i in range(n)]
        normal = [not (s or b) for s, b in zip(special, byte)]
        self.byte_id = np.full(256, self.unk, np.int64)
        self.raw: list[bytes] = []
        for i, p in enumerate(pieces):
            if byte[i]:
                self.byte_id[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            else:
                self.raw.append(b"" if sp.is_control(i) else " ⁇ ".encode() if special[i] else p.replace(SPACE, " ").encode())
        self.is_byte = np.array(byte)
        self.control = np.array([sp.is_control(i) for i in range(n)])
        self.marked = np.array([p.startswith(SPACE) and k for p, k in zip(pieces, normal)])
        self.raw_len = np.array([len(x) for x in self.raw])
        self.raw_at = np.concatenate(([0], np.cumsum(self.raw_len)))[:-1]
        self.raw_all = np.frombuffer(b"".join(self.raw), np.uint8)
        # symbols: pieces by id; single characters without a piece get symbols from n on, for each text anew
        self.n = n
        self.of_char = {p: i for i, p in enumerate(pieces) if normal[i] and len(p) == 1}
        by_text = {p: i for i, p in enumerate(pieces) if normal[i]}
        _, dense = np.unique(-np.array([sp.get_score(i) for i in range(n)]), return_inverse=True)
        keys, ranks, made = [], [], []
        safe = np.ones(n, bool)
        for p, i in by_text.items():
            for k in range(1, len(p)):
                a, b = by_text.get(p[:k]), by_text.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    ranks.append(dense[i])
                    made.append(i)
                for part in (a, b):
                    if part is not None and dense[i] <= dense[part]:
                        safe[part] = False
        self.pairs = PairTable(np.array(keys, np.int64), np.array(ranks, np.int64), np.array(made, np.int64))
        self.safe = safe
        self.longest = max(map(len, by_text), default=1)
        long = {c for p in by_text if len(p) > 1 for c in p}
        if any(SPACE in p.strip(SPACE) or (p[-1] == SPACE and p.strip(SPACE)) for p in by_text):
            raise ValueError("a piece spans a space inside it; such models are not supported")
        self.splitter = re.compile(f"{SPACE}*[{''.join(re.escape(c) for c in sorted(long - {SPACE}))}]+|{SPACE}+|[^{''.join(re.escape(c) for c in sorted(long))}]")

    # -- encoding ------------------------------------------------------------------------------------------------------

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        distinct, where = np.unique(points, return_inverse=True)
        sym = np.array([self.of_char.get(chr(c), self.n + k) for k, c in enumerate(distinct)], np.int64)[where]
        sizes = np.array([len(w) for w in words])
        seg = np.repeat(np.arange(len(words)), sizes)
        long = np.repeat(sizes > LONG, sizes)
        done = [*self._by_word(sym[~long], seg[~long])]
        if long.any():
            done.append(self._by_surroundings(sym[long], seg[long]))
        segs = np.concatenate([s for s, _ in done]) if done else np.zeros(0, np.int64)
        syms = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(segs, kind="stable")
        segs, syms = segs[order], syms[order]
        if len(syms) and syms.max() >= self.n:  # characters without a piece: their bytes
            extra = {self.n + k: self.byte_id[list(chr(c).encode("utf-8", "replace"))] for k, c in enumerate(distinct) if chr(c) not in self.of_char}
            odd = np.flatnonzero(syms >= self.n)
            parts = [extra[x] for x in syms[odd].tolist()]
            n = np.ones(len(syms), np.int64)
            n[odd] = [len(p) for p in parts]
            ends = np.cumsum(n)
            syms, segs = np.repeat(syms, n), np.repeat(segs, n)
            for i, p in zip(odd.tolist(), parts):
                syms[ends[i] - len(p) : ends[i]] = p
        raw = syms.astype("<u4").tobytes()
        at = (np.searchsorted(segs, np.arange(len(words) + 1)) * 4).tolist()
        return [raw[x:y] for x, y in zip(at, at[1:])]

    def _by_word(self, sym: np.ndarray, seg: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words and symbols of what no round can merge any more; finished words leave the arrays."""
        rank, piece = self._ranked(sym, seg, np.arange(len(sym)))
        while len(sym):
            first = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(sym)))
            live = best < NONE
            if not live.all():
                stay = np.repeat(live, sizes)
                yield seg[~stay], sym[~stay]
                sym, seg, rank, piece = sym[stay], seg[stay], rank[stay], piece[stay]
                best, sizes = best[live], sizes[live]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            head = np.append(True, seg[hit[1:]] != seg[hit[:-1]])
            # leftmost of overlapping places: in a run of neighbouring hits every second one counts
            run = np.append(True, (hit[1:] != hit[:-1] + 1) | head[1:])
            index = np.arange(len(hit))
            even = (index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 0
            take = head | (even & self.safe[piece[hit]])  # all hits of a word make the same piece
            sym, seg, rank, piece = self._merged(sym, seg, rank, piece, hit[take])

    def _by_surroundings(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for long words; symbols that pair with nothing keep their surroundings apart."""
        w = self.longest + 2
        ends = np.repeat(np.flatnonzero(np.append(seg[1:] != seg[:-1], True)) + 1, 2 * w)
        sym, seg = np.insert(sym, ends, self.n), np.insert(seg, ends, -1)
        rank, piece = self._ranked(sym, seg, np.arange(len(sym)))
        none = np.full(w, NONE)
        while (rank < NONE).any():
            before, after = _least(np.concatenate([none, rank[:-1]]), w), _least(np.concatenate([rank[1:], none]), w)
            calm = (rank < NONE) & (before >= rank) & (after >= rank)
            quiet = calm.copy()  # the piece starts nothing of its rank or better with what stands beside it
            ask = np.flatnonzero(calm & ~self.safe[piece])
            made, limit = piece[ask], rank[ask]
            for left, right in ((sym[ask - 1], made), (made, sym[np.minimum(ask + 2, len(sym) - 1)]), (made, made)):
                known = (left < self.n) & (right < self.n)
                more, _ = self.pairs.find(np.where(known, left * self.n + right, 0))
                quiet[ask] &= ~known | (more > limit)
            loud = np.where(calm & ~quiet, rank, NONE)
            index = np.arange(len(rank))
            begin = np.maximum.accumulate(np.where(np.append(True, rank[1:] != rank[:-1]), index, 0))  # of the run of equal pairs
            restless = np.maximum.accumulate(np.where(quiet, -1, index))
            take = quiet & (_least(np.concatenate([none, loud[:-1]]), w) > rank) & ((index - begin) % 2 == 0) & (restless < begin)
            far = np.minimum(before, np.concatenate([none, before[:-w]])), np.minimum(after, np.concatenate([after[w:], none]))
            take |= calm & ~quiet & (far[0] > rank) & (far[1] >= rank)
            sym, seg, rank, piece = self._merged(sym, seg, rank, piece, np.flatnonzero(take))
        return seg[seg >= 0], sym[seg >= 0]

    def _merged(self, sym: np.ndarray, seg: np.ndarray, rank: np.ndarray, piece: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, ...]:
        """The arrays after the pairs at ``hit`` became their pieces; only pairs with a merged symbol are ranked anew."""
        sym[hit] = piece[hit]
        stay = np.ones(len(sym), bool)
        stay[hit + 1] = False
        new = hit - np.arange(len(hit))  # where the merged symbols are after compaction
        sym, seg, rank, piece = sym[stay], seg[stay], rank[stay], piece[stay]
        near = np.concatenate([new, new[new > 0] - 1])
        rank[near], piece[near] = self._ranked(sym, seg, near)
        return sym, seg, rank, piece

    def _ranked(self, sym: np.ndarray, seg: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the symbols at ``at`` with the next one of the same word."""
        nxt = np.minimum(at + 1, len(sym) - 1)
        a, b = sym[at], sym[nxt]
        ok = (nxt > at) & (seg[at] == seg[nxt]) & (a < self.n) & (b < self.n)
        rank, piece = self.pairs.find(np.where(ok, a * self.n + b, 0))
        return np.where(ok, rank, NONE), piece

    def split(self, text: str) -> list[str]:
        return self.splitter.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode_all(self, texts: list[str], cache: Cache, begin_end: bool = True) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        fresh = list(dict.fromkeys(w for words in split for w in words if w not in cache))
        if len(cache) + len(fresh) > CACHE_WORDS or cache.size > CACHE_BYTES:
            cache.clear()
            fresh = list(dict.fromkeys(w for words in split for w in words))
        cache.keep(fresh, self.merge(fresh) if fresh else [])
        a, b = (np.array([x], "<u4").tobytes() if begin_end and x >= 0 else b"" for x in (self.bos, self.eos))
        get = cache.__getitem__
        return [a + b"".join(map(get, words)) + b for words in split]

    # -- decoding ------------------------------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: space marks become spaces, the first one goes, byte pieces join to UTF-8."""
        ids = np.asarray(ids, np.int64)
        ids = ids[~self.control[ids]]
        if not len(ids):
            return ""
        n = self.raw_len[ids]
        ends = np.cumsum(n)
        raw = self.raw_all[np.arange(ends[-1]) + np.repeat(self.raw_at[ids] - (ends - n), n)].tobytes()
        if self.marked[ids[0]]:
            raw = raw[1:]
        return raw.decode("utf-8", "tickloom.each_byte")


@functools.lru_cache(maxsize=4)
def model(path: str) -> PieceModel:
    return PieceModel(path)


_caches: dict[str, Cache] = {}


def encode(texts: Iterable[str | None], path: str, begin_end: bool = True) -> list[np.ndarray]:
    """Ids of whole texts, as the sentencepiece library gives them for the same model."""
    got = model(path).encode_all([t or "" for t in texts], _caches.setdefault(path, Cache()), begin_end)
    return [np.frombuffer(x, "<u4") for x in got]


def decode(ids: Iterable[int], path: str) -> str:
    return model(path).decode(np.fromiter(ids, np.int64))


def tokenize(docs: DataFrame, path: str, keep: list[str], text: str = "text", ids: str | None = "ids", decoded: str | None = None, digests: bool = False) -> DataFrame:
    """``keep`` columns with token ids (array of int), the decoded text, and n_tokens; with ``digests`` also SHA-256 of both."""
    fields = [T.StructField("n_tokens", T.LongType(), False)]
    fields += [T.StructField(ids, T.ArrayType(T.IntegerType()), False)] if ids else []
    fields += [T.StructField(decoded, T.StringType(), False)] if decoded else []
    fields += [T.StructField("ids_sha256", T.StringType(), False), T.StructField("decoded_sha256", T.StringType(), False)] if digests else []

    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        m, raw = model(path), data.tobytes()
        got = m.encode_all([raw[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:])], _caches.setdefault(path, Cache()))
        flat = np.frombuffer(b"".join(got), "<u4").astype(np.int32)
        at = np.concatenate(([0], np.cumsum([len(x) // 4 for x in got])))
        out: list = [np.diff(at)]
        if ids:
            out.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat)))
        if decoded or digests:
            back = [m.decode(flat[a:b]) for a, b in zip(at[:-1], at[1:])]
        if decoded:
            out.append(back)
        if digests:
            out += [[hashlib.sha256(x).hexdigest() for x in got], [hashlib.sha256(x.encode()).hexdigest() for x in back]]
        return out

    return map_text(docs, text, keep, T.StructType(fields), kernel, limit=MERGE_BYTES)
