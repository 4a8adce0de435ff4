"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, mapped by workers.

Training. Each task counts its documents' words and word pairs in blocks of a
bounded number of tokens and sends, per key range ("shard"), one row of sorted
keys and counts: a frequent pair costs one entry a block. A reducer adds one
shard up. A pair's key is the scrambled 32+32 bits of its two words' hashes,
so shards are even whatever the pairs are, and the key gives both words back:
each shard also yields, by word, how many pairs it begins (with counts 1, 2, 3 or more)
and how many different words it follows. These are added up again by word
range, next to the words' own counts. Sorted keys and values go to
files in the shared folder; the driver sees file names and a few totals.

Model. p(w|u) = (c(u,w) - D) / c(u) + g(u) * p1(w), with D by count 1, 2, 3+ from
the counts of counts and g(u) the mass taken off; p1 is the same over continuation
counts, interpolated with 1/(V+1), which is all an unknown word gets.

Scoring. A worker maps the files, sorts the distinct pairs of a block of documents
and looks them up shard by shard, so it walks each array once in order and holds
one block in memory. Words are cut as in `words`; an end token closes each
document and counts as a token. Word counts use 64-bit hashes, pairs 32 bits a word.

Cases. Null and empty texts are the end token alone. An empty table gives an empty
result; with no training rows every word is unknown. Repeated rows are scored
and counted each. A null id is kept. Further columns are neither read nor returned.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import WordHashes, mix, partitions, shared_dir, small_batches, stored, words
from .files import mapped, write_file

#: Tokens counted or scored together by one worker.
BLOCK = 1_500_000
END, START = b"\x03end", b"\x02start"
HALF = np.uint64(32)
_BLOB = "kind string, shard int, keys binary, counts binary"
_PART = "kind string, shard int, file string, keys binary, counts binary, totals array<long>"


class Model(NamedTuple):
    """File names by shard, how many bits of a key name its shard, and the totals."""

    pairs: list[str | None]
    words: list[str | None]
    bits: int
    tokens: int
    vocabulary: int
    kinds: int  # distinct word pairs
    spread: float
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]


def _inverse(h: np.ndarray) -> np.ndarray:
    """Undoes `mix`: a fold by half the bits is its own inverse, an odd factor has one."""
    factor = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
    with np.errstate(over="ignore"):
        for _ in range(2):
            h = (h ^ (h >> HALF)) * factor
    return h ^ (h >> HALF)


def _pair_keys(hashes: np.ndarray, starts: np.ndarray, begin: int) -> np.ndarray:
    """Keys of (word before, word); at `starts` the word before is the start mark."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[starts] = begin
    return mix((before >> HALF << HALF) | (hashes >> HALF))


def _cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each shard begins and ends in sorted keys."""
    edges = np.arange(1, 2**bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their values (rows) added up."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[heads], np.add.reduceat(values[order], heads, axis=0) if len(heads) else values[:0]


class _Blocks:
    """Hashes of documents, gathered until a block is full."""

    def __init__(self):
        self.known = WordHashes()
        self.start, self.end = self.known[START], self.known[END]
        self.clear()

    def clear(self) -> None:
        self.parts, self.lengths, self.size = [], [], 0

    def add(self, text: bytes | None) -> None:
        found = self.known.of([*words(text), END])
        self.parts.append(found)
        self.lengths.append(len(found))
        self.size += len(found)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All hashes, all pair keys, and where each document starts."""
        hashes = np.concatenate(self.parts)
        starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        return hashes, _pair_keys(hashes, starts, self.start), starts


def packed(values: np.ndarray) -> bytes:
    """Counts as 32-bit numbers where they all fit, as 64-bit ones elsewhere."""
    return values.astype(np.uint32 if not values.size or int(values.max()) < 2**32 else np.uint64).tobytes()


def unpacked(raw, n: int) -> np.ndarray:
    """`n` counts of `packed`, of either width."""
    return np.frombuffer(raw, np.uint64 if n and len(raw) == 8 * n else np.uint32).astype(np.int64)


def _counting(bits: int):
    def emit(block: _Blocks):
        hashes, pairs, _ = block.arrays()
        for kind, values in (("word", hashes), ("pair", pairs)):
            keys, counts = np.unique(values, return_counts=True)
            cuts = _cuts(keys, bits)
            rows = [(s, keys[i:j].tobytes(), packed(counts[i:j])) for s, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if j > i]
            yield pa.record_batch(
                [pa.array([kind] * len(rows)), pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)]],
                names=["kind", "shard", "keys", "counts"],
            )

    def run(batches):
        block = _Blocks()
        for batch in batches:
            for text in batch.column("text"):
                block.add(text.as_py())
                if block.size >= BLOCK:
                    yield from emit(block)
                    block.clear()
        if block.size:
            yield from emit(block)

    return run


def _joined(table: pa.Table, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.frombuffer(b.as_py(), np.uint64) for b in table.column("keys")]
    values = [unpacked(b.as_py(), width * len(k)) for b, k in zip(table.column("counts"), keys, strict=True)]
    return np.concatenate(keys), np.concatenate(values).reshape(-1, width)


def _counts_of_counts(values: np.ndarray) -> list[int]:
    return [int((values == n).sum()) for n in (1, 2, 3, 4)]


def _add_up_pairs(folder: str, bits: int):
    """One shard of pairs: its file, and the shares of its words in the words' tables."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = _summed(*_joined(table))
        counts = counts[:, 0]
        file = write_file(f"{folder}/model", f"pairs-{shard}", [keys.tobytes(), packed(counts), np.int64(len(keys)).tobytes()])
        both = _inverse(keys)
        once, twice = counts == 1, counts == 2
        begins, starts = _summed(both >> HALF << HALF, np.stack([counts, once, twice, ~once & ~twice, np.zeros_like(counts)], 1))
        ends, follows = _summed(both << HALF, np.ones((len(both), 1), np.int64))
        follows = np.concatenate([np.zeros((len(ends), 4), np.int64), follows], 1)
        words_of, parts = _summed(np.concatenate([begins, ends]), np.concatenate([starts, follows]))
        cuts = _cuts(words_of, bits)
        rows = [("share", s, None, words_of[i:j].tobytes(), packed(parts[i:j]), None) for s, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if j > i]
        rows.append(("pairs", shard, file, None, None, _counts_of_counts(counts)))
        return _table(rows)

    return run


def _add_up_words(folder: str):
    """One shard of words: exact counts by 64 bits, and by 32 bits what pairs say of the word."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        is_share = pa.compute.equal(table.column("kind"), "share")
        own, shares = table.filter(pa.compute.invert(is_share)), table.filter(is_share)
        keys, counts = _summed(*_joined(own)) if len(own) else (np.empty(0, np.uint64), np.empty((0, 1), np.int64))
        halves, sums = _summed(*_joined(shares, 5)) if len(shares) else (np.empty(0, np.uint64), np.empty((0, 5), np.int64))
        own_file = write_file(f"{folder}/model", f"words-{shard}", [keys.tobytes(), counts[:, 0].tobytes(), halves.tobytes(), sums.T.astype(np.int64).tobytes(), np.array([len(keys), len(halves)], np.int64).tobytes()])
        follows = sums[:, 4]
        totals = [int(counts.sum()), len(keys), int(follows.sum()), int((follows > 0).sum()), *_counts_of_counts(follows)]
        return _table([("words", shard, own_file, None, None, totals)])

    return run


def _table(rows) -> pa.Table:
    kinds = [pa.string(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = ["kind", "shard", "file", "keys", "counts", "totals"]
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts; too small a corpus to fill the counts of counts gets fixed ones."""
    n1, n2, n3, n4 = n
    if min(n) == 0:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.01), k - 0.01) for k, d in zip((1, 2, 3), found, strict=True))


def train(docs: DataFrame, text_col: str = "text", folder: str | None = None) -> Model:
    """Counts over all rows of `docs`."""
    import pyarrow.compute  # noqa: F401  (used by the reducers)

    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or shared_dir(spark)
    shards = partitions(spark)
    bits = max(1, min(16, (shards - 1).bit_length()))
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    blobs = texts.mapInArrow(_counting(bits), _BLOB)
    # One pass over the texts: words go through as they are, pairs are added up.
    counted = stored(
        blobs.withColumn("slot", F.when(F.col("kind") == "word", -1 - F.col("shard")).otherwise(F.col("shard")))
        .groupBy("slot")
        .applyInArrow(_first_sum(folder, bits), _PART),
        folder,
        "counted",
    )
    pair_rows = counted.where("kind = 'pairs'").select("shard", "file", "totals").collect()
    by_word = counted.where("kind != 'pairs'").groupBy("shard").applyInArrow(_add_up_words(folder), _PART)
    word_rows = stored(by_word, folder, "words").select("shard", "file", "totals").collect()
    totals = np.sum([r["totals"] for r in word_rows], axis=0).tolist() if word_rows else [0] * 8
    of_pairs = np.sum([r["totals"] for r in pair_rows], axis=0).tolist() if pair_rows else [0] * 4
    files = lambda rows: [dict((r["shard"], r["file"]) for r in rows).get(s) for s in range(2**bits)]
    tokens, vocabulary, kinds, following, n1, n2 = totals[:6]
    low = _discounts(totals[4:])
    spread = (low[0] * n1 + low[1] * n2 + low[2] * (following - n1 - n2)) / max(kinds, 1)
    return Model(files(pair_rows), files(word_rows), bits, tokens, vocabulary, kinds, spread, _discounts(of_pairs), low)


def _first_sum(folder: str, bits: int):
    add_pairs = _add_up_pairs(folder, bits)

    def run(table: pa.Table) -> pa.Table:
        if table.column("kind")[0].as_py() == "pair":
            return add_pairs(table)
        keys, counts = _summed(*_joined(table))
        return _table([("word", table.column("shard")[0].as_py(), None, keys.tobytes(), packed(counts[:, 0]), None)])

    return run


class _Tables:
    """The model's arrays in a worker: mapped files, opened at need."""

    def __init__(self, model: Model):
        self.model, self.pair_files, self.word_files = model, {}, {}

    def _find(self, keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(table, keys)
        at[at == len(table)] = 0
        return at, table[at] == keys

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pair keys."""
        out = np.zeros(len(keys), np.float64)
        cuts = _cuts(keys, self.model.bits)
        for s, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if j > i and (uri := self.model.pairs[s]):
                if s not in self.pair_files:
                    self.pair_files[s] = _pair_arrays(mapped(uri))
                table, counts = self.pair_files[s]
                at, there = self._find(keys[i:j], table)
                out[i:j] = np.where(there, counts[at], 0)
        return out

    def word_facts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted distinct word hashes: exact counts, and (context count, N1, N2, N3+, continuations)."""
        counts, facts = np.zeros(len(keys), np.float64), np.zeros((len(keys), 5), np.float64)
        cuts = _cuts(keys, self.model.bits)
        for s, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if j > i and (uri := self.model.words[s]):
                if s not in self.word_files:
                    self.word_files[s] = _word_arrays(mapped(uri))
                table, own, halves, sums = self.word_files[s]
                if len(table):
                    at, there = self._find(keys[i:j], table)
                    counts[i:j] = np.where(there, own[at], 0)
                if len(halves):
                    at, there = self._find(keys[i:j] >> HALF << HALF, halves)
                    facts[i:j] = np.where(there[:, None], sums[:, at].T, 0)
        return counts, facts


def _pair_arrays(raw: memoryview):
    n = int(np.frombuffer(raw[-8:], np.int64)[0])
    wide = len(raw) == 16 * n + 8
    return np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.uint64 if wide else np.uint32, n, 8 * n)


def _word_arrays(raw: memoryview):
    n, m = (int(v) for v in np.frombuffer(raw[-16:], np.int64))
    keys, counts = np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.int64, n, 8 * n)
    return keys, counts, np.frombuffer(raw, np.uint64, m, 16 * n), np.frombuffer(raw, np.int64, 5 * m, 16 * n + 8 * m).reshape(5, m)


def _taken(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return np.choose(np.minimum(counts, 3).astype(np.int64), (0.0, *discounts))


def _scoring(model: Model):
    def emit(block: _Blocks, tables: _Tables, ids: list, held: list):
        hashes, pairs, starts = block.arrays()
        distinct, which = np.unique(hashes, return_inverse=True)
        counts, facts = tables.word_facts(distinct)
        # The start mark opens documents but is no token.
        _, begin = tables.word_facts(np.array([block.start], np.uint64))
        before = np.empty(len(hashes), np.int64)
        before[1:] = which[:-1]
        before[starts] = len(distinct)
        facts = np.concatenate([facts, begin])
        keys, of = np.unique(pairs, return_inverse=True)
        seen = tables.pair_counts(keys)
        v = model.vocabulary + 1
        cont = facts[:-1, 4]
        d = model.low_discounts
        if model.kinds:
            # Mass taken off the continuation counts, spread evenly over the words and one unknown.
            p1 = np.maximum(cont - _taken(cont, d), 0) / model.kinds + model.spread / v
        else:
            p1 = np.full(len(cont), 1 / v)
        total = facts[:, 0]
        freed = facts[:, 1:4] @ np.array(model.discounts)
        with np.errstate(divide="ignore", invalid="ignore"):
            back = np.where(total > 0, freed / total, 1.0)
            own = np.where(total[before] > 0, np.maximum(seen - _taken(seen, model.discounts), 0)[of] / total[before], 0.0)
        logs = np.log10(own + back[before] * p1[which])
        base = np.log10((counts + 1) / (model.tokens + v))[which]
        known = (counts > 0)[which]
        n = len(ids)
        yield pa.record_batch(
            [
                pa.array(ids, pa.int64()),
                pa.array(held, pa.bool_()),
                pa.array(block.lengths, pa.int64()),
                pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                pa.array(np.full(n, model.tokens, np.int64)),
                pa.array(np.add.reduceat(base, starts)),
                pa.array(np.add.reduceat(logs, starts)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def run(batches):
        block, tables, ids, held = _Blocks(), _Tables(model), [], []
        for batch in batches:
            for i, out, text in zip(batch.column("doc_id"), batch.column("held_out"), batch.column("text"), strict=True):
                block.add(text.as_py())
                ids.append(i.as_py())
                held.append(out.as_py())
                if block.size >= BLOCK:
                    yield from emit(block, tables, ids, held)
                    block.clear()
                    ids, held = [], []
        if block.size:
            yield from emit(block, tables, ids, held)

    return run


def score(docs: DataFrame, model: Model, held_out: Column, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), perplexity."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("binary").alias("text")
    )
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = rows.mapInArrow(_scoring(model), schema)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def train_and_score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows that are not held out, score all of them."""
    return score(docs, train(docs.where(~held_out), text_col), held_out, doc_id, text_col)
