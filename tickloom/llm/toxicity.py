"""Toxicity by a linear-chain conditional random field over words.

Words are tagged toxic or not; the features of a word are hashes of the whole word and of its first 3 to 6 bytes, in
lower case. No token labels exist: the data label documents only. So the tags are hidden, and the field is fitted on the
document labels: a clean document has no toxic word, a toxic one has at least one. Both chances come from forward-backward
over the whole document (``train``), and emissions and transitions follow the exact gradient of their likelihood by
AdaGrad, from a start at the features' log-odds among documents. A word's marginal is its probability to be toxic. The
document's score is a logistic function, fitted on other labelled documents, of the strongest marginal and of the
expected number of toxic words; offending offsets are spans of words with marginals of 0.5 and more.

The fit takes a bounded sample (``PER_CLASS`` rows of each class, texts of at most ``SAMPLE_CHARS`` characters). Null
and empty texts have no words and get the score of a document without any toxic word. Without rows of both classes
every score is the share of label 1 (0.5 without labels). Rows without an id are scored and not held out; equal rows stay
equal rows; an empty table gives no rows.
"""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import Words, byte_table, held_out, labelled_sample, map_text, mix, platt, sigmoid

PER_CLASS, SAMPLE_CHARS, BITS = 1500, 12_000, 18
#: Words that run side by side with others; emission weights are clipped; steps of the fit and its pull to the start.
BLOCK, CLIP, ROUNDS, RIDGE = 64, 20.0, 60, 0.1
PREFIXES = (3, 4, 5, 6)
THRESHOLD = 0.3
#: Marginals below count for nothing, so that long texts do not add up noise.
FAINT = 0.1
#: Buckets of features are odd; of the even ones, 0 holds the bias and 2 stays without weight.
BIAS, NO_FEATURE = 0, 2

#: Letters, digits and all bytes of other than ASCII characters make words.
WORD = byte_table(lambda b: b >= 0x80 or chr(b).isalnum())
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def features(words: Words) -> list[np.ndarray]:
    """For each kind of feature a bucket per word; bucket ``NO_FEATURE``, which has no weight, where the word is shorter."""
    length = words.end - words.start
    out = [(words.hashes() >> np.uint64(64 - BITS)).astype(np.int64) | 1]
    for k in PREFIXES:
        h = mix(words.hashes(np.minimum(length, k)) + np.uint64(k)) >> np.uint64(64 - BITS)
        out.append(np.where(length >= k, h.astype(np.int64) | 1, NO_FEATURE))
    return out


class Chains:
    """Forward-backward over whole documents, linear in their words.

    Words are dealt into blocks of ``BLOCK`` for speed only: the 2 x 2 transfer matrices of all blocks are multiplied out
    side by side, a scan over the blocks of each document carries the messages across, and with them every block runs its
    own recurrences. All messages equal those of one uncut run.
    """

    def __init__(self, words: Words):
        n = -(-words.count // BLOCK)
        doc = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        first = words.first[doc] + k * BLOCK
        size = np.minimum(BLOCK, words.first[doc + 1] - first)
        order = np.argsort(-size, kind="stable")
        self.first, self.size, self.slot = first[order], size[order], np.argsort(order, kind="stable")
        self.live = np.searchsorted(-self.size, -np.arange(1, BLOCK + 1), side="right")
        self.blocks, self.at = n, np.cumsum(n) - n  # blocks of each document, and the first of them in document order
        self.words, self.docs = int(words.first[-1]), len(n)
        ends = words.first[1:][words.count > 0] - 1
        self.inner = np.ones(self.words, bool)  # words with another one after them
        self.inner[ends] = False
        self.begin = words.first[:-1][words.count > 0]

    def run(self, e: np.ndarray, trans: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(forward odds with emission, backward odds with emission, p(toxic)) of each word, and log Z of each document.

        ``e`` holds exp of the emission weights of tag 1, ``trans`` and ``start`` exp of the transition weights.
        """
        (t00, t01), (t10, t11) = trans
        m = len(self.first)
        a, b, c, d = np.ones(m), np.zeros(m), np.zeros(m), np.ones(m)  # product of diag(1, e) T over the block
        last = np.zeros((m, 4))  # the same without the last T
        scale = np.zeros(m)
        for t in range(BLOCK if m else 0):
            n = self.live[t]
            if not n:
                break
            x = e[self.first[:n] + t]
            b[:n] *= x
            d[:n] *= x
            done = slice(self.live[t + 1] if t + 1 < BLOCK else 0, n)
            last[done] = np.stack([a[done], b[done], c[done], d[done]], 1)
            p, q, r, s = a[:n], b[:n], c[:n], d[:n]
            a[:n], b[:n], c[:n], d[:n] = p * t00 + q * t10, p * t01 + q * t11, r * t00 + s * t10, r * t01 + s * t11
            if t % 8 == 7:
                total = a[:n] + b[:n] + c[:n] + d[:n]
                for v in (a, b, c, d):
                    v[:n] /= total
                last[done] /= total[done, None]
                scale[:n] += np.log(total)
        enter, leave = np.ones((m, 2)), np.ones((m, 2))
        logz = np.zeros(self.docs)
        deep = np.argsort(-self.blocks, kind="stable")
        counts = self.blocks[deep]
        alive = np.searchsorted(-counts, -np.arange(1, (counts[0] if len(counts) else 0) + 1), side="right")
        now = np.tile([1.0, start], (len(deep), 1))
        for k, n in enumerate(alive.tolist()):
            i = self.slot[self.at[deep[:n]] + k]
            enter[i] = now[:n]
            end = alive[k + 1] if k + 1 < len(alive) else 0
            f = slice(end, n)
            g = last[i[f]]
            u, v = now[f, 0], now[f, 1]
            logz[deep[f]] += np.log(u * (g[:, 0] + g[:, 1]) + v * (g[:, 2] + g[:, 3])) + scale[i[f]]
            i = i[:end]
            u, v = now[:end, 0], now[:end, 1]
            nxt = np.stack([u * a[i] + v * c[i], u * b[i] + v * d[i]], 1)
            total = nxt.sum(1)
            now[:end] = nxt / total[:, None]
            logz[deep[:end]] += np.log(total) + scale[i]
        for k in range(len(alive) - 2, -1, -1):
            n = alive[k + 1]
            i, j = self.slot[self.at[deep[:n]] + k], self.slot[self.at[deep[:n]] + k + 1]
            g, y = last[j], leave[j]
            u, v = g[:, 0] * y[:, 0] + g[:, 1] * y[:, 1], g[:, 2] * y[:, 0] + g[:, 3] * y[:, 1]
            back = np.stack([t00 * u + t01 * v, t10 * u + t11 * v], 1)
            leave[i] = back / back.sum(1, keepdims=True)
        fore, post = np.empty(self.words), np.empty(self.words)
        r = enter[:, 1] / enter[:, 0]
        for t in range(BLOCK if m else 0):
            n = self.live[t]
            if not n:
                break
            at = self.first[:n] + t
            f = r[:n] * e[at]
            fore[at] = f
            r[:n] = (t01 + f * t11) / (t00 + f * t10)
        back = np.empty(self.words)
        b = leave[:, 1] / leave[:, 0]
        for t in range(BLOCK - 1, -1, -1):
            n = self.live[t] if m else 0
            if not n:
                continue
            at = self.first[:n] + t
            odds = fore[at] * b[:n]
            post[at] = odds / (1 + odds)
            x = b[:n] * e[at]
            back[at] = x
            b[:n] = (t10 + t11 * x) / (t00 + t01 * x)
        return fore, back, post, logz

    def pairs(self, fore: np.ndarray, back: np.ndarray, trans: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Sums over neighbouring words of ``weight`` (of the first) times the chances of the four pairs of tags."""
        i = np.flatnonzero(self.inner)
        f, x, w = fore[i], back[i + 1], weight[i]
        four = np.stack([np.full(len(i), trans[0, 0]), trans[0, 1] * x, trans[1, 0] * f, trans[1, 1] * f * x])
        return ((four / four.sum(0)) @ w).reshape(2, 2)


@dataclasses.dataclass
class ToxicityModel:
    weights: np.ndarray
    trans: np.ndarray
    start: float
    calibration: np.ndarray

    def tag(self, words: Words) -> np.ndarray:
        """Marginal chance of every word to be toxic."""
        if not len(words.start):
            return np.zeros(0)
        emit = sum(self.weights[f] for f in features(words)) + self.weights[BIAS]
        return Chains(words).run(np.exp(np.clip(emit, -CLIP, CLIP)), np.exp(self.trans), float(np.exp(self.start)))[2]

    def aggregate(self, words: Words, p: np.ndarray) -> np.ndarray:
        n = len(words.count)
        doc = words.doc
        strongest = np.zeros(n)
        np.maximum.at(strongest, doc[p > FAINT], p[p > FAINT])
        expected = np.bincount(doc, weights=np.where(p > FAINT, p, 0), minlength=n)
        return np.column_stack([strongest, np.log1p(expected)])


def _arrays(texts: list[str]) -> Words:
    raw = [t.encode() for t in texts]
    return Words(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64), WORD, LOWER)


def _first_guess(words: Words, toxic: np.ndarray, feats: list[np.ndarray]) -> np.ndarray:
    """Weights to start from: log-odds of the documents that have a feature, damped by how few these are."""
    w = np.zeros(1 << BITS)
    base = toxic.sum() / (~toxic).sum()
    for f in feats:
        seen = np.unique(words.doc * np.int64(1 << BITS) + f)  # once per document
        doc, bucket = seen >> BITS, seen & ((1 << BITS) - 1)
        a = np.bincount(bucket[toxic[doc]], minlength=1 << BITS)
        b = np.bincount(bucket[~toxic[doc]], minlength=1 << BITS) * base
        w = np.maximum(w, (np.log(a + 0.5) - np.log(b + 0.5)) * (a / (a + 3.0)))
    w[[BIAS, NO_FEATURE]] = 0
    return w


def train(sample: list[tuple[int, str]], share: float = 0.5, rounds: int = ROUNDS, rate: float = 0.3, ridge: float = RIDGE) -> ToxicityModel:
    """Labels are of documents, so tags are hidden: a clean document has no toxic word, a toxic one at least one.

    The likelihood of a clean label is the chance of the path without any toxic word, 1 / Z; that of a toxic label is the
    rest, 1 - 1 / Z. Its exact gradient weighs the marginals of forward-backward by -1, and by 1 / (Z - 1).
    """
    prior = min(max(share, 1e-3), 1 - 1e-3)
    logit = float(np.log(prior / (1 - prior)))
    model = ToxicityModel(np.zeros(1 << BITS), np.zeros((2, 2)), 0.0, np.array([0.0, 0.0, logit]))
    y_all = np.array([y for y, _ in sample], bool)
    if min(y_all.sum(), (~y_all).sum()) < 8:
        return model
    apart = np.zeros(len(sample), bool)
    for y in (False, True):
        apart[np.flatnonzero(y_all == y)[::4]] = True  # a fourth is for the calibration
    words = _arrays([t for (_, t), h in zip(sample, apart) if not h])
    toxic = y_all[~apart]
    feats = features(words)
    w = _first_guess(words, toxic, feats)
    used = np.unique(np.concatenate([np.unique(f) for f in feats]))
    small = np.searchsorted(used, np.arange(1 << BITS))  # buckets in use, numbered without gaps
    cols = [small[f].astype(np.int32) for f in feats]
    w, fixed = w[used], used == NO_FEATURE
    chains = Chains(words)
    bias, trans, start = -np.log(max(2.0, len(words.start) / max(1, len(toxic)))) - 2.0, np.zeros((2, 2)), 0.0
    g2, b2, t2, s2 = np.full(len(w), 1e-2), 1e-2, np.full((2, 2), 1e-2), 1e-2
    first = w.copy()
    for _ in range(rounds):
        emit = sum(w[c] for c in cols) + bias
        e = np.exp(np.clip(emit, -CLIP, CLIP))
        fore, back, p, logz = chains.run(e, np.exp(trans), float(np.exp(start)))
        push = np.where(toxic, 1 / np.expm1(np.clip(logz, 0.05, 50)), -1.0)
        each = push[words.doc]
        err = each * p
        grad = sum(np.bincount(c, weights=err, minlength=len(w)) for c in cols) - ridge * (w - 0.5 * first)
        grad[fixed] = 0
        g2 += grad**2
        w += rate * grad / np.sqrt(g2)
        step = float(err.sum()) - 0.05 * (bias + 6)
        b2 += step**2
        bias += rate * step / np.sqrt(b2)
        step = chains.pairs(fore, back, np.exp(trans), each) - 0.5 * trans
        step[0, 0] = 0  # the path without a toxic word weighs 1
        t2 += step**2
        trans += 0.1 * step / np.sqrt(t2)
        step = float(err[chains.begin].sum()) - 0.5 * start
        s2 += step**2
        start += 0.1 * step / np.sqrt(s2)
    weights = np.zeros(1 << BITS)
    weights[used] = w
    weights[BIAS] = bias
    model = ToxicityModel(weights, trans, start, np.zeros(3))
    rest = _arrays([t for (_, t), h in zip(sample, apart) if h])
    x = model.aggregate(rest, model.tag(rest))
    y = y_all[apart].astype(float)
    cal = platt(x, y, ridge=0.01)
    cal[-1] += logit - float(np.log(y.sum() / (1 - y).sum()))
    model.calibration = cal
    return model


def fit(docs: DataFrame, labels: DataFrame, mod: int = 4, held: int = 2) -> ToxicityModel:
    return train(*labelled_sample(docs, labels, "toxic", mod, held, PER_CLASS, SAMPLE_CHARS))


SPAN = T.ArrayType(T.StructType([T.StructField("from_byte", T.LongType(), False), T.StructField("to_byte", T.LongType(), False)]))
SCORES = T.StructType([T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False), T.StructField("spans", SPAN, False)])


def score(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns with score, decision and the byte offsets (end exclusive) of toxic spans."""

    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        words = Words(data, offs, WORD, LOWER)
        p = model.tag(words)
        s = sigmoid(model.aggregate(words, p) @ model.calibration[:-1] + model.calibration[-1])
        spans: list[list[dict]] = [[] for _ in range(len(offs) - 1)]
        last = (-2, -1)
        for i in np.flatnonzero(p >= 0.5).tolist():
            d = int(words.doc[i])
            at = {"from_byte": int(words.start[i] - offs[d]), "to_byte": int(words.end[i] - offs[d])}
            if last == (i - 1, d):
                spans[d][-1]["to_byte"] = at["to_byte"]
            else:
                spans[d].append(at)
            last = (i, d)
        return [s, (s >= threshold).astype(np.int32), spans]

    return map_text(docs, text, keep, SCORES, kernel)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score(docs, fit(docs, labels), ["doc_id"])
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")
