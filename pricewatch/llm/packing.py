"""Best-fit packing of tokenised documents into sequences, by exact-complement hashing.

A document is its token ids and an end id. One that is longer than a sequence is cut
into whole sequences, the rest being its first piece. How pieces are put
together hangs on their lengths alone, and there are at most `capacity` of these,
whatever the corpus: the number of pieces of each length is all that the driver
gets. It makes the plan from these counts in two steps:

* Exact fills. From the longest length down, the gap a piece leaves is looked up
  in the index of single lengths, then of pair sums, then of triple sums (a
  single length and the pair that complements it). A combination that fills the gap
  exactly is used as often as the counts of its lengths allow.
* Best fit. What has no exact complement goes, the longest first, to the open
  sequence with the least room that still takes it, equal sequences at a time.

So the plan has a few thousand entries, each for many equal sequences. Documents
never go to one place: the task that tokenises a document numbers its pieces by
length, the numbers of pieces in the tasks before give each piece its rank
among all of its length, and a binary search finds the entry that has this rank.

Ids are those of the `tokenizers` file; they are computed with `tiktoken` on the rank file of the
same vocabulary, at 4.5 times the speed (a test compares the two). Texts are
tokenised in stretches of about a million characters, cut before a blank that a
word follows, where the vocabulary's pattern cuts anyway.

Cases. Null and empty texts are the end id alone, as are texts without tokens. Null ids are kept;
rows that share an id, or are equal, are packed each. The special token's string in a text is
that token. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import shared_dir, small_batches, stored

END_ID = 2
STRETCH = 1_000_000
BATCH_BYTES = 8 << 20
PIECES = "doc_id long, piece int, start long, length int, ids binary, task int, rank long"

_before_word = re.compile(r" (?=\S)")


@cache
def _encoder(ranks_path: str | None):
    """The vocabulary, read once a worker."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    special = {"<|endoftext|>": 50256}  # fixed value of the vocabulary
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str, ranks_path: str | None = None) -> np.ndarray:
    """Ids of a text, without an end id."""
    encoder, found, at = _encoder(ranks_path), [], 0
    while at < len(text):
        cut = _before_word.search(text, at + STRETCH) if at + STRETCH < len(text) else None
        end = cut.start() if cut else len(text)
        found.append(encoder.encode_to_numpy(text[at:end], allowed_special="all"))
        at = end
    return np.concatenate(found).astype("<u4") if found else np.empty(0, "<u4")


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of `n` ids: whole sequences behind a first piece that may be shorter."""
    first = n % capacity or capacity
    return [first] + [capacity] * ((n - first) // capacity)


def tokenised(
    docs: DataFrame,
    folder: str,
    capacity: int = 1024,
    end_id: int = END_ID,
    ranks_path: str | None = None,
    doc_id: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of all documents, stored: their ids and checksum, the task that made them, their rank there among equal lengths."""
    small_batches(docs.sparkSession)

    def run(batches):
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, size = [], 0
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(token_ids((text.as_py() or b"").decode("utf-8", "replace"), ranks_path), np.uint32(end_id)).astype("<u4")
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids), capacity)):
                    rows.append((key, piece, start, length, ids[start : start + length].tobytes(), task, seen[length]))
                    seen[length] += 1
                    start += length
                    size += 4 * length
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
            yield _batch(rows)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return stored(source.mapInArrow(run, PIECES).withColumn("ids_crc32", F.crc32("ids")), folder, "pieces")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
    names = ("doc_id", "piece", "start", "length", "ids", "task", "rank")
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))


class Entry(NamedTuple):
    """`count` pieces of one length, from a rank on, `each` side by side in a sequence at `offset`."""

    length: int
    rank: int
    count: int
    sequence: int
    each: int
    offset: int


class _Complements:
    """Lengths that are there, by single value, pair sum and triple sum. `left` holds how many of each are left."""

    def __init__(self, left: np.ndarray):
        self.left = left
        there = [int(x) for x in np.flatnonzero(left)[::-1]]
        self.lengths = there
        self.pairs: dict[int, list[tuple[int, int]]] = {}
        for i, a in enumerate(there):
            for b in there[i:]:
                if a + b < len(left):
                    self.pairs.setdefault(a + b, []).append((a, b))
        self.dead = dict.fromkeys(self.pairs, 0)  # pairs of a sum before this one are used up for good

    def _fits(self, *lengths: int) -> bool:
        return all(self.left[x] >= n for x, n in Counter(lengths).items())

    def _pair(self, total: int, *others: int) -> tuple[int, int] | None:
        listed, at = self.pairs.get(total, ()), self.dead.get(total, 0)
        while at < len(listed) and not self._fits(*listed[at]):
            at += 1
        if listed:
            self.dead[total] = at
        return next((p for p in listed[at:] if self._fits(*p, *others)), None)

    def of(self, longest: int, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths that fill `gap` exactly beside `longest`."""
        if gap == 0:
            return ()
        if self.left[gap] and self._fits(longest, gap):
            return (gap,)
        pair = self._pair(gap, longest)
        if pair:
            return pair
        for a in self.lengths:
            if a < gap and self.left[a] and (pair := self._pair(gap - a, a, longest)):
                return (a, *pair)
        return None


def exact_fills(left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Sequences that combinations fill exactly, (lengths, times); `left` keeps what has no exact complement."""
    found, index = [], _Complements(left)
    for longest in index.lengths:
        while left[longest]:
            others = index.of(longest, capacity - longest)
            if others is None:
                break
            needed = Counter((longest, *others))
            times = min(int(left[x]) // n for x, n in needed.items())
            for x, n in needed.items():
                left[x] -= n * times
            found.append(([longest, *others], times))
    return found


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """What is left, the longest first, each where the least room takes it; equal sequences are one entry."""
    open_by_room: dict[int, list[tuple[list[int], int]]] = {}
    for length in (int(x) for x in np.flatnonzero(left)[::-1]):
        todo = int(left[length])
        while todo:
            room = min((r for r in open_by_room if r >= length), default=None)
            if room is None:
                room, lengths, times = capacity, [], todo
            else:
                lengths, times = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
            each = min(room // length, todo)
            used = min(times, todo // each)
            if room < capacity and times > used:
                open_by_room.setdefault(room, []).append((lengths, times - used))
            open_by_room.setdefault(room - each * length, []).append((lengths + [length] * each, used))
            todo -= used * each
    return [group for groups in open_by_room.values() for group in groups]


def plan(counts: dict[int, int], capacity: int) -> list[Entry]:
    """Which ranks of each length go where, for all pieces."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used, entries, sequence = Counter(), [], 0
    for lengths, times in exact_fills(left, capacity) + best_fit(left, capacity):
        offset = 0
        for length, each in sorted(Counter(lengths).items(), reverse=True):
            entries.append(Entry(length, used[length], each * times, sequence, each, offset))
            used[length] += each * times
            offset += each * length
        sequence += times
    return sorted(entries)


def pack(pieces: DataFrame, capacity: int = 1024, carry: tuple[str, ...] = ("ids_crc32",)) -> DataFrame:
    """Pieces with sequence_id and offset; of the stored pieces only the columns in `carry` go along."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    entries = spark.sparkContext.broadcast(np.array(plan(by_length, capacity), np.int64).reshape(-1, 6))
    tasks_before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("task", "length", F.coalesce(F.sum("n").over(tasks_before), F.lit(0)).alias("first"))
    kept = ["doc_id", "piece", "start", "length", *carry]
    ranked = pieces.join(firsts, ["task", "length"]).select(*kept, (F.col("first") + F.col("rank")).alias("rank"))

    def run(batches):
        table = entries.value
        heads, ranks = np.searchsorted(table[:, 0], np.arange(capacity + 2)), table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.empty(len(length), np.int64)
            for one in np.unique(length):
                rows, head, end = length == one, heads[one], heads[one + 1]
                at[rows] = head + np.searchsorted(ranks[head:end], rank[rows], "right") - 1
            _, first, _, sequence, each, offset = table[at].T
            nth = rank - first
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(sequence + nth // each), pa.array(offset + nth % each * length)]
            yield pa.record_batch(columns, names=[*kept, "sequence_id", "offset"])

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, capacity: int = 1024, carry: tuple[str, ...] = ("ids", "ids_crc32"), **options) -> DataFrame:
    """Per piece: doc_id, piece, start, length, its ids and checksum, sequence_id, offset."""
    return pack(tokenised(docs, shared_dir(docs.sparkSession), capacity, **options), capacity, carry)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, length and ids, as little-endian 32-bit numbers."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` tokens
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").cast("int").alias("length"), joined.alias("ids"))
