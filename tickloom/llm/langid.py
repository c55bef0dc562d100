"""Language identification by cross-parsing entropy.

A suffix automaton is built over labelled text of every language. A document is parsed against each automaton into
phrases, each the longest match that starts where the last one ended; the language that needs the fewest phrases,
normalised by the text's length and the size of the automaton's text (phrases * log2(size) / letters), wins. Ties go to
the language that sorts first. Every letter that occurs in any sample is a symbol of its own; one that a language's sample
lacks is a phrase of its own there. Letters are folded to lower case; a run of other characters reads as one break.

Transitions are stored sparsely (about 1 MB for each language, at every size of alphabet): the edges of all states are
laid into one array, each state's at an offset where they meet free places. All blocks of ``BLOCK`` symbols of a batch are
parsed side by side, one numpy step for the next symbol of each. The parse that comes from the block before goes on until it
begins a phrase where the block's own parse began one; from there both are the same, so the count is that of one uncut
parse.

The fit takes a bounded sample: the ``PER_LANG`` labelled texts of smallest id hash per language, whole texts until
``SAMPLE_CHARS`` characters. Null texts and texts without a letter are ``und`` with score 0; without any labelled text
every text is ``und``. Rows without an id are predicted and not held out; equal rows stay equal rows; an empty table gives
no rows.
"""

from __future__ import annotations

import dataclasses
import functools
import pickle
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import held_out, map_text, remainder

PER_LANG, SAMPLE_CHARS = 40, 24_000
#: Symbols that are parsed side by side with others, and of these how many at the front are known to a parse from before.
BLOCK, HEAD = 768, 192
#: Distinct languages up to which their counts are broadcast.
BROADCAST_LANGS = 10_000
#: Bytes of text in a batch: many blocks share each numpy step.
BATCH_BYTES = 2 << 20


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter; its lower case."""
    letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            letter[c] = True
            if len(low := ch.lower()) == 1:
                lower[c] = ord(low)
    return letter, lower


def _points(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)


def _letters(points: np.ndarray) -> np.ndarray:
    """Folded letters with 0 for a run of other characters."""
    letter, lower = _tables()
    is_letter = letter[points]
    folded = np.where(is_letter, lower[points], 0)
    stay = is_letter.copy()
    stay[1:] |= is_letter[:-1]
    return folded[stay]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton: for each state the next ones by symbol; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Automaton:
    """Transitions in one array: the edge of state s by symbol c is at ``base[s] + c``, if ``owner`` there is s."""

    def __init__(self, base: np.ndarray, owner: np.ndarray, to: np.ndarray, root: np.ndarray):
        self.base, self.owner, self.to, self.root = base, owner, to, root

    @classmethod
    def of(cls, nxt: list[dict[int, int]], alphabet: int) -> Automaton:
        """``alphabet``: number of symbols. The root's edges have an array of their own."""
        base = np.zeros(len(nxt), np.int64)
        by_degree: dict[int, list[int]] = {}
        for s, edges in enumerate(nxt[1:], 1):
            by_degree.setdefault(len(edges), []).append(s)
        taken = np.zeros(alphabet + 3 * sum(d * len(v) for d, v in by_degree.items() if d > 1) + 64, bool)
        random = np.random.default_rng(7)
        for d in sorted((d for d in by_degree if d > 1), reverse=True):
            wait = np.array(by_degree[d])
            symbols = np.array([list(nxt[s]) for s in by_degree[d]])
            while len(wait):  # all states of this many edges draw offsets; those whose places are free and their own stay
                at = random.integers(0, len(taken) - alphabet, len(wait))
                place = at[:, None] + symbols
                first = np.zeros(place.size, bool)
                first[np.unique(place.ravel(), return_index=True)[1]] = True
                won = (~taken[place] & first.reshape(place.shape)).all(1)
                base[wait[won]] = at[won]
                taken[place[won].ravel()] = True
                wait, symbols = wait[~won], symbols[~won]
                if not won.any():
                    taken = np.append(taken, np.zeros(len(taken), bool))
        single = np.array(by_degree.get(1, []), np.int64)
        symbol = np.array([next(iter(nxt[s])) for s in single.tolist()], np.int64)
        taken = np.append(taken, np.zeros(alphabet + len(single), bool))
        base[single] = np.flatnonzero(~taken[alphabet:])[: len(single)] + alphabet - symbol
        owner = np.full(int(base.max(initial=0)) + alphabet + 1, -1, np.int32)
        to = np.zeros(len(owner), np.int32)
        for s, edges in enumerate(nxt[1:], 1):
            at = int(base[s])
            for c, t in edges.items():
                owner[at + c], to[at + c] = s, t
        root = np.zeros(alphabet, np.int32)
        for c, t in nxt[0].items():
            root[c] = t
        return cls(base.astype(np.int32), owner, to, root)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and whether the symbols go on with the phrase; otherwise they begin one."""
        at = self.base[state] + symbol
        on = self.owner[at] == state
        return np.where(on, self.to[at], self.root[symbol]), on

    def pack(self) -> bytes:
        return zlib.compress(pickle.dumps((self.base, self.owner, self.to, self.root)), 1)

    @classmethod
    def unpack(cls, raw: bytes) -> Automaton:
        return cls(*pickle.loads(zlib.decompress(raw)))


@dataclasses.dataclass
class LanguageModel:
    langs: list[str]
    points: np.ndarray  # known letters, sorted; symbol 0 is a break, 1 any other letter, 2 the first known one
    packed: list[bytes]  # automata
    sizes: list[int]

    def automata(self) -> tuple[np.ndarray, list[Automaton]]:
        """Symbols by code point, and the automata; unpacked once in each process."""
        if (found := _unpacked.get(key := hash(tuple(map(zlib.crc32, self.packed))))) is None:
            code = np.ones(0x110000, np.int32)
            code[0] = 0
            code[self.points] = np.arange(2, 2 + len(self.points))
            _unpacked.clear()
            found = _unpacked[key] = code, [Automaton.unpack(p) for p in self.packed]
        return found

    def phrases(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Phrases per document (rows) and language; ``symbols`` of all documents in a row, ``counts`` of each."""
        n = len(counts)
        blocks = -(-counts // BLOCK)
        owner = np.repeat(np.arange(n), blocks)
        head = np.cumsum(blocks) - blocks  # first block of each document
        k = np.arange(len(owner)) - head[owner]
        begin = np.cumsum(counts) - counts
        first = begin[owner] + k * BLOCK
        size = np.minimum(BLOCK, counts[owner] - k * BLOCK)
        out = np.zeros((n, len(self.langs)), np.int64)
        if not len(owner):
            return out
        order = np.argsort(-size, kind="stable")  # rows of the arrays below; blocks keep their numbers in ``order``
        start = first[order]
        live = np.searchsorted(-size[order], -np.arange(1, size.max() + 1), side="right")
        inner = k[order] > 0  # blocks that a parse from before comes into
        more = k + 1 < blocks[owner]  # blocks that their parse leaves
        end = (begin + counts)[owner]
        for j, automaton in enumerate(self.automata()[1]):
            mark = np.full(len(symbols) if inner.any() else 0, -1, np.int32)  # which phrase of its block begins here
            state, begun = np.zeros(len(start), np.int32), np.zeros(len(start), np.int64)
            for t, m in enumerate(live.tolist()):
                state[:m], on = automaton.step(state[:m], symbols[start[:m] + t])
                if t < HEAD and len(mark):
                    at = np.flatnonzero(~on & inner[:m])
                    mark[start[at] + t] = begun[at]
                begun[:m] += ~on
            total, where = np.empty(len(start), np.int64), np.empty(len(start), np.int32)
            total[order], where[order] = begun, state
            target, entry = np.full(len(owner), -1), np.zeros(len(owner), np.int64)
            b = np.flatnonzero(more)
            at, here = first[b] + BLOCK, where[b]
            while len(b):
                here, on = automaton.step(here, symbols[at])
                met = ~on & (mark[at] >= 0)
                total[b] += ~on & ~met
                i = b[met]
                target[i], entry[i] = head[owner[i]] + (at[met] - begin[owner[i]]) // BLOCK, mark[at[met]]
                at += 1
                go = ~met & (at < end[b])
                b, at, here = b[go], at[go], here[go]
            doc = np.flatnonzero(blocks)
            now, into = head[doc], np.zeros(len(doc), np.int64)
            while len(doc):
                out[doc, j] += total[now] - into
                into, now = entry[now], target[now]
                go = now >= 0
                doc, now, into = doc[go], now[go], into[go]
        return out

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        parts = [_letters(_points(t)) for t in texts]
        counts = np.array([len(p) for p in parts], np.int64)
        letters = np.array([np.count_nonzero(p) for p in parts], np.int64)
        if not self.langs:
            return ["und"] * n, np.zeros(n)
        points = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        got = self.phrases(self.automata()[0][points], counts)
        rate = got * np.log2(np.maximum(2, np.array(self.sizes))) / np.maximum(1, counts)[:, None]
        best = rate.argmin(1)
        z = -8 * (rate - rate.min(1, keepdims=True))
        score = 1 / np.exp(z).sum(1)
        return [self.langs[b] if k else "und" for b, k in zip(best, letters)], np.where(letters > 0, score, 0.0)


_unpacked: dict[int, tuple[np.ndarray, list[Automaton]]] = {}


def train(sample: dict[str, list[str]], max_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Of each language whole texts in the given order, as many as fit into ``max_chars`` letters and breaks, one at least."""
    langs = sorted(k for k, v in sample.items() if any(_letters(_points(t.encode())).any() for t in v))
    if not langs:
        return LanguageModel([], np.zeros(0, np.uint32), [], [])
    texts = {}
    for lang in langs:
        parts = [np.append(p, 0) for p in (_letters(_points(t.encode())) for t in sample[lang]) if p.any()]
        total = np.cumsum([len(p) for p in parts])
        texts[lang] = np.concatenate(parts[: max(1, int(np.searchsorted(total, max_chars, side="right")))])
    points = np.unique(np.concatenate(list(texts.values())))
    points = points[points > 0]
    packed = [Automaton.of(suffix_automaton((np.searchsorted(points, t) + np.where(t > 0, 2, 0)).tolist()), len(points) + 2).pack() for t in texts.values()]
    return LanguageModel(langs, points, packed, [len(t) for t in texts.values()])


def fit(docs: DataFrame, mod: int = 3, held: int = 1, per_lang: int = PER_LANG) -> LanguageModel:
    """Two passes: labelled rows per language are counted, then rows of small id hash are taken, ``per_lang`` at most."""
    base = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS) & (remainder("doc_id", mod) != held))
    counts = base.groupBy("lang").count()
    if counts.count() <= BROADCAST_LANGS:  # one row for each; a join by shuffle would gather a language in a task
        counts = F.broadcast(counts)
    share = F.least(F.lit(1.0), 4.0 * per_lang / F.col("count"))
    # a hash threshold leaves a few rows per language before any ordering, so no language fills a task
    few = base.join(counts, "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30) < share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "text"))
    rows = few.select("lang", "text", rank.alias("k")).where(F.col("k") <= per_lang).collect()
    sample: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.k)):
        sample.setdefault(r.lang, []).append(r.text)
    return train(sample)


FOUND = T.StructType([T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)])


def identify(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        raw = data.tobytes()
        return list(model.predict([raw[a:b] for a, b in zip(offs[:-1], offs[1:])]))

    return map_text(docs, text, keep, FOUND, kernel, limit=BATCH_BYTES)


def digest(docs: DataFrame) -> DataFrame:
    return identify(docs, fit(docs), ["doc_id"]).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")
