"""Quality by compression: zstandard dictionaries of good and bad text, their size difference calibrated.

Two dictionaries are trained on chunks of good and of bad labelled texts. A
text is compressed chunk by chunk with either, all of it; the chunks keep a
text's own repetitions from outweighing the dictionaries. The evidence is the
difference of the two sizes and the smaller text's size itself, both by the
text's length (a word repeated a hundred times is small under either), and a logistic
curve fitted on labelled texts that the dictionaries never saw makes a score of it.

Fitting takes a bounded sample of labelled rows (`labelled_sample`) with their whole texts to the
driver; scoring runs where the documents are, and sends nothing but scores.

Cases. Null and empty texts have no evidence and get the curve's value for no
difference and the usual size. Without labels of both kinds every score is 0.5 (predicted 1): nothing
is rejected. Repeated rows are scored each; a null id is kept. Labels, languages
and sources are never read when scoring.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import shielded, small_batches
from .labelled import labelled_sample, logistic, sigmoid

CHUNK, DICTIONARY, LEVEL = 1024, 112_640, 3
#: Bytes of usual text that each text is taken with, so that a few words prove little.
LIGHT = 48


class Model(NamedTuple):
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]
    usual: float  # compressed size of a byte of good text


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    options = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), **options)


def _chunks(text: bytes):
    return (text[i : i + CHUNK] for i in range(0, len(text), CHUNK))


def sizes(text: bytes | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[int, int, int]:
    """Length, and compressed sizes by the good and the bad dictionary."""
    text = text or b""
    return len(text), sum(len(good.compress(c)) for c in _chunks(text)), sum(len(bad.compress(c)) for c in _chunks(text))


def evidence(found: np.ndarray, usual: float) -> np.ndarray:
    """Per row of `sizes`: how many bytes the good dictionary saves, and how many it needs, for some bytes of text."""
    length, good, bad = found.reshape(-1, 3).astype(np.float64).T
    return np.stack([10 * (bad - good), 4 * (good + usual * LIGHT)], 1) / (length + LIGHT)[:, None]


def _dictionary(texts: list[bytes]) -> bytes:
    samples = [c for t in texts for c in _chunks(t) if len(c) > 8]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their text is the dictionary
        return b"".join(samples)[-DICTIONARY:]


def fit(texts: list[bytes], target: np.ndarray, share: float = 0.5, seed: int = 5) -> Model:
    """Dictionaries on one half of the sample, the curve on the other; `share` is that of good texts among all labelled."""
    order = np.random.default_rng(seed).permutation(len(texts))
    learn, rest = order[: len(order) // 2], order[len(order) // 2 :]
    if len(set(target[learn].tolist())) < 2 or len(set(target[rest].tolist())) < 2:
        return Model(b"", b"", (0.0, 0.0, 0.0), 0.0)
    good, bad = (_dictionary([texts[i] for i in learn if target[i] == k]) for k in (1, 0))
    pair = _compressor(good), _compressor(bad)
    seen = np.array([sizes(texts[i], *pair) for i in rest])
    of_good = seen[target[rest] == 1]
    usual = float(of_good[:, 1].sum() / max(of_good[:, 0].sum(), 1))
    return Model(good, bad, tuple(logistic(evidence(seen, usual), target[rest], share).tolist()), usual)


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """The rows of `docs` with a score and predicted label; columns of the two names are replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of a fixed size

    @F.pandas_udf("double")
    def quality(texts):
        m = shared.value
        pair = _compressor(m.good), _compressor(m.bad)
        found = evidence(np.array([sizes(t, *pair) for t in texts]), m.usual)
        return type(texts)(sigmoid(found @ m.weights[:2] + m.weights[2]))

    scored = docs.withColumn(score, quality(F.col(text_col).cast("binary")))
    return scored.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))


@shielded
def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score is at least a half."""
    scored = score_texts(docs, model, text_col, score="_quality", predicted="_accepted")
    return scored.where("_accepted = 1").select(*docs.columns)


def fit_on_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, **bounds: int) -> Model:
    """Fit on a bounded sample of the allowed labels."""
    return fit(*labelled_sample(docs, labels, label, allowed, **bounds))
