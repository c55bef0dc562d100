"""Quality by compression: zstandard dictionaries of good and of bad text, and what each saves on a document.

Two dictionaries are trained from labelled texts. A document is cut into blocks of ``BLOCK`` bytes; every block is
compressed with both. (Bytes with the bad dictionary - bytes with the good one) / length of the text, and the same by the
sum of both, are the normalised differences; the logarithm of what both save stands beside them. Labelled rows that the
dictionaries have not seen turn it into a probability (Platt scaling), weighted so that both classes count as often as
they occur among the labels.

The fit takes a bounded sample (``PER_CLASS`` rows of each class, texts of at most ``SAMPLE_CHARS`` characters, smallest
id hash first). Null and empty texts have the differences 0 and so the score of the calibration's prior. Without rows of
both classes every score is the share of label 1 (0.5 without labels). Rows without an id are scored and not held out;
equal rows stay equal rows; an empty table gives no rows.
"""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import held_out, labelled_sample, map_text, platt, sigmoid

PER_CLASS, SAMPLE_CHARS, DICTIONARY_BYTES, BLOCK, LEVEL = 2000, 12_000, 112 << 10, 1024, 3
THRESHOLD = 0.3
#: Bytes added to all sizes: frames of very short texts cost more than they hold.
DAMP = 64


@dataclasses.dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def compressors(self) -> list:
        import zstandard

        if (found := _compressors.get(self)) is None:
            found = []
            for raw in (self.bad, self.good):
                d = zstandard.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                found.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))
            _compressors.clear()
            _compressors[self] = found
        return found

    def differences(self, texts: list[bytes]) -> np.ndarray:
        if not self.good:
            return np.zeros((len(texts), 3))
        bad, good = (c.compress for c in self.compressors())
        out = np.zeros((len(texts), 3))
        for i, t in enumerate(texts):
            if t:
                a = b = 0
                for at in range(0, len(t), BLOCK):
                    block = t[at : at + BLOCK]
                    a += len(bad(block))
                    b += len(good(block))
                out[i] = (a - b) / (len(t) + DAMP), (a - b) / (a + b + DAMP), np.log((a + b + DAMP) / (len(t) + DAMP))
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        x = self.differences(texts)
        w = np.array(self.weights)
        return sigmoid(x @ w[:-1] + w[-1])


_compressors: dict[QualityModel, list] = {}


def train(sample: list[tuple[int, str]], share: float = 0.5) -> QualityModel:
    """From (label, text) rows; every second text of a class makes the dictionary, the others the calibration.

    ``share``: of label 1 among all labels, to which the calibration is weighted.
    """
    import zstandard

    by = {y: [t.encode() for k, t in sample if k == y and t] for y in (0, 1)}
    prior = min(max(share, 1e-3), 1 - 1e-3)
    logit = float(np.log(prior / (1 - prior)))
    if min(len(v) for v in by.values()) < 8:
        return QualityModel(b"", b"", (0.0, 0.0, 0.0, logit))
    # each line once, and none that both classes have: licence lines and the like tell nothing
    lines = {y: dict.fromkeys(line for t in texts[::2] for line in t.split(b"\n")) for y, texts in by.items()}
    made = {}
    for y in by:
        own = b"\n".join(line for line in lines[y] if line not in lines[1 - y])
        parts = [own[a : a + BLOCK] for a in range(0, len(own), BLOCK)]
        try:
            made[y] = zstandard.train_dictionary(DICTIONARY_BYTES, parts, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # too few or too equal samples for the trainer: the texts themselves
            made[y] = zstandard.ZstdCompressionDict(b"".join(parts)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT).as_bytes()
    model = QualityModel(made[1], made[0], ())
    x = np.concatenate([model.differences(by[y][1::2]) for y in (0, 1)])
    y = np.concatenate([np.full(len(by[k][1::2]), k) for k in (0, 1)])
    w = platt(x, y, ridge=1e-4)
    w[-1] += logit - float(np.log((y == 1).sum() / (y == 0).sum()))
    return dataclasses.replace(model, weights=tuple(float(v) for v in w))


def fit(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0) -> QualityModel:
    return train(*labelled_sample(docs, labels, "quality", mod, held, PER_CLASS, SAMPLE_CHARS))


SCORES = T.StructType([T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)])


def score(docs: DataFrame, model: QualityModel, keep: list[str], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    def kernel(data: np.ndarray, offs: np.ndarray) -> list:
        raw = data.tobytes()
        s = model.score([raw[a:b] for a, b in zip(offs[:-1], offs[1:])])
        return [s, (s >= threshold).astype(np.int32)]

    return map_text(docs, text, keep, SCORES, kernel)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score(docs, fit(docs, labels), ["doc_id"])
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")
