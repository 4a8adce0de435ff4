"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A text is the bag of its distinct words' byte n-grams (3 to 6 bytes, the blank before and
behind a word included, A-Z lowered), hashed into buckets. Each bucket has an
embedding; a bag is the mean of its embeddings, and a linear softmax tells
toxic from not. So a misspelt word that was never seen still carries the vectors
of the n-grams it shares. As the classifier is linear in the mean, a text is
scored with one number a bucket: the embedding's share of the softmax margin.

A few insults in a long text would drown in the whole text's mean, so in the second half of the
training a text is the worst passage that the first half found in it, and when scoring means are
taken over overlapping windows of `window` bytes and the text gets its worst
window. Windows cover the whole text: a word is left out only where it occurred less than
`REPEAT` bytes before, so that a word said over and over is one piece of evidence, and a
passage is scored where it stands, whatever was said earlier. Long texts are gone through in
stretches, so a worker holds a text and a fixed amount beside it. A logistic curve, fitted on part of the
sample that the embeddings never saw, turns that margin into the score.

Training takes a bounded sample of labelled rows (`labelled_sample`) with their whole texts to
the driver; everything else runs where the documents are.

Cases. Null and empty texts have no n-grams and get the curve's value for a
margin of `BLANK`, which is clean. Without labels of both kinds every score is
0.5's lower neighbour: nothing is called toxic. Repeated rows are scored each. A
null id is kept. Labels, languages and sources are never read when scoring.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import small_batches, words
from .labelled import labelled_sample, logistic, sigmoid

BITS, DIM, SIZES = 18, 8, (3, 4, 5, 6)
BLANK = -50.0
REPEAT = 240
STRETCH = 1 << 16

_blank = re.compile(rb"[\x20\x09-\x0D]")


class Model(NamedTuple):
    margins: np.ndarray  # one number a bucket
    bias: float
    slope: float
    shift: float
    window: int


def _cuts(text: bytes):
    """Begin and end of the stretches of a text: behind a word, or within one that is longer than a stretch."""
    begin = 0
    while begin < len(text):
        found = _blank.search(text, begin + STRETCH, begin + 2 * STRETCH)
        end = found.start() if found else min(begin + 2 * STRETCH, len(text))
        yield begin, end
        begin = end


def cleaned(text: bytes | None, overlap: int = 0):
    """Stretches of lower-case words, each between blanks; a word that occurred less than `REPEAT` bytes before is left out.

    A stretch begins with the last words of the one before, up to `overlap` bytes of them.
    """
    at, seen, tail = 0, {}, []
    for begin, end in _cuts(text or b""):
        part = tail
        for word in words(text[begin:end]):
            if at - seen.get(word, -REPEAT) >= REPEAT:
                seen[word] = at
                at += len(word) + 1
                part.append(word)
        yield b" " + b" ".join(part) + b" "
        seen = {w: p for w, p in seen.items() if at - p < REPEAT}
        size, first = 0, len(part)
        while first and size + len(part[first - 1]) < overlap:
            first -= 1
            size += len(part[first]) + 1
        tail = part[first:]


def _grams(clean: bytes):
    """For each size of n-gram: buckets at every byte, and which of them lie in one word."""
    raw = np.frombuffer(clean, np.uint8)
    blank = np.cumsum(raw == 32, dtype=np.int32)
    value = np.zeros(len(raw), np.uint64)
    for n in range(1, min(max(SIZES), len(raw)) + 1):
        m = len(raw) - n + 1
        value = value[:m]
        value |= raw[n - 1 :].astype(np.uint64) << np.uint64(8 * (n - 1))
        if n in SIZES:
            with np.errstate(over="ignore"):
                mixed = (value + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed >>= np.uint64(64 - BITS)
            # No blank but at either end.
            yield mixed.astype(np.int64), blank[n - 2 : n - 2 + m] == blank[:m]


def bag(text: bytes | None) -> np.ndarray:
    """Buckets of the n-grams of all distinct words: what a labelled text teaches."""
    clean = b" " + b" ".join(dict.fromkeys(words(text))) + b" "
    found = [buckets[inside] for buckets, inside in _grams(clean)]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def margin(text: bytes | None, model: Model) -> float:
    """The largest softmax margin of any window."""
    return worst(text, model)[0]


def worst(text: bytes | None, model: Model) -> tuple[float, bytes]:
    """The largest softmax margin of any window, and what stands in it and a window to either side."""
    found = [(*_margin(clean, model), clean) for clean in cleaned(text, 2 * model.window)]
    if not found:
        return BLANK, b""
    most, at, clean = max(found, key=lambda f: f[0])
    return most, clean[max(0, at - model.window) : at + 2 * model.window]


def _margin(clean: bytes, model: Model) -> tuple[float, int]:
    """The largest margin of a stretch, and where its window begins."""
    size = len(clean)
    total, count = np.zeros(size, np.float32), np.zeros(size, np.int16)
    for buckets, inside in _grams(clean):
        total[: len(buckets)] += model.margins[buckets] * inside
        count[: len(buckets)] += inside
    cells = np.arange(0, size, model.window // 2)
    total = np.add.reduceat(total, cells, dtype=np.float64)
    count = np.add.reduceat(count, cells, dtype=np.float64)
    if not count.any():
        return BLANK, 0
    if len(cells) > 1:  # a window is two neighbouring cells
        total, count = total[:-1] + total[1:], count[:-1] + count[1:]
    # A short window's mean is pulled towards no evidence.
    margins = np.where(count > 0, total / (count + model.window / 4) + model.bias, -np.inf)
    at = int(margins.argmax())
    return float(margins[at]), int(cells[at])


def fit(
    texts: list[bytes], target: np.ndarray, share: float = 0.5, steps: int = 560, batch: int = 64, seed: int = 3, window: int = 120
) -> Model:
    """Embeddings and softmax by Adagrad on 17 twentieths of the sample, the curve on the rest.

    `share` is the part of toxic texts among all labelled ones; the curve is fitted to it.
    """
    flat = Model(np.zeros(2**BITS, np.float32), 0.0, 0.0, -1e-9, window)
    if len(set(target.tolist())) < 2:
        return flat
    random = np.random.default_rng(seed)
    order = random.permutation(len(texts))
    cut = max(len(order) * 17 // 20, 1)
    learn, rest = order[:cut], order[cut:]
    bags = {int(i): bag(texts[i]).astype(np.int32) for i in learn}
    learn = np.array([i for i in learn if len(bags[int(i)])])
    emb = random.normal(0, 0.1, (2**BITS, DIM)).astype(np.float32)
    soft = random.normal(0, 0.5, (2, DIM)).astype(np.float32)
    bias = np.zeros(2)
    sum_emb, sum_soft, sum_bias = np.full(2**BITS, 1e-6, np.float32), np.full((2, DIM), 1e-6), np.full(2, 1e-6)
    weight = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean()))
    rate = 0.5
    rounds = max(2, -(-steps // max(1, -(-len(learn) // batch))))
    for turn in range(rounds):
        if turn == rounds // 2:
            # What a label stands for is a passage: from here on each text is its worst one.
            now = Model((emb @ (soft[1] - soft[0])).astype(np.float32), float(bias[1] - bias[0]), 1.0, 0.0, window)
            parts = {int(i): bag(worst(texts[i], now)[1]).astype(np.int32) for i in learn}
            bags |= {i: found for i, found in parts.items() if len(found)}
        random.shuffle(learn)
        for at in range(0, len(learn), batch):
            part = learn[at : at + batch]
            lengths = np.array([len(bags[int(i)]) for i in part])
            ids = np.concatenate([bags[int(i)] for i in part])
            heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            # Of two labels only the margin between them counts; their errors are each other's opposite.
            margins = np.add.reduceat((emb @ (soft[1] - soft[0]))[ids], heads) / lengths + bias[1] - bias[0]
            error = (sigmoid(margins) - target[part]) * weight[part] / len(part)
            # How far each bucket pushed: the gradients of both layers follow from it.
            push = np.bincount(ids, np.repeat(error / lengths, lengths), 2**BITS)
            touched = np.flatnonzero(push)
            towards = push[touched] @ emb[touched]
            d_soft = np.stack([-towards, towards])
            d_emb = push[touched, None] * (soft[1] - soft[0])
            sum_emb[touched] += (d_emb**2).mean(1)
            emb[touched] -= (rate * d_emb / np.sqrt(sum_emb[touched])[:, None]).astype(np.float32)
            sum_soft += d_soft**2
            soft -= (0.1 * d_soft / np.sqrt(sum_soft)).astype(np.float32)
            d_bias = np.array([-error.sum(), error.sum()])
            sum_bias += d_bias**2
            bias -= 0.1 * d_bias / np.sqrt(sum_bias)
    model = Model((emb @ (soft[1] - soft[0])).astype(np.float32), float(bias[1] - bias[0]), 1.0, 0.0, window)
    seen = np.array([margin(texts[i], model) for i in rest])
    keep = seen > BLANK
    if len(set(target[rest][keep].tolist())) < 2:
        return flat
    slope, shift = logistic(seen[keep, None], target[rest][keep], share)
    return model._replace(slope=float(max(slope, 0.0)), shift=float(shift))


def score_texts(docs: DataFrame, model: Model, held_out: Column, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a fixed size: one number a bucket

    def run(batches):
        m = shared.value
        for batch in batches:
            margins = np.array([margin(t.as_py(), m) for t in batch.column("text")])
            scores = sigmoid(m.slope * margins + m.shift)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("binary").alias("text")
    )
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, held_out: Column, **bounds: int
) -> DataFrame:
    """Fit on a bounded sample of the allowed labels, score every document."""
    texts, target, share = labelled_sample(docs, labels, label, allowed, **bounds)
    return score_texts(docs, fit(texts, target, share), held_out)
