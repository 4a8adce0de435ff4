"""SimHash fingerprints, and all pairs of fingerprints within a Hamming radius by permuted block tables.

A text's terms are its two-word shingles (A-Z lowered, cut at ASCII white
space), weighted by how often they occur; a shorter text is one term. Each
term's 64-bit hash votes with its weight on each bit, a tie is 0. A text
without words has fingerprint 0.

`with_edits` fingerprints every text next to an edit of it that takes text from the
next document. Documents are range-partitioned by id once, with their text, and
streamed in order, so each sees its next one; the last of each partition meets
the first of the next partition afterwards, two rows a partition.

`near_pairs` and `with_near` cut fingerprints into radius + 3 blocks. Two within the radius
agree on at least three whole blocks, so one table for each choice of three, keyed by
their bits, finds every such pair; distances are then computed exactly. Equal
fingerprints are one row of the search and never pairs among themselves. `with_near`
only counts, so its rows grow with the fingerprints and not with the pairs; m marks that
share a place of a table are dealt into chunks, m / chunk copies of each, so that no task takes them all.

Cases. Null texts are empty ones. Rows with equal ids follow each other in order
of their text. Null ids come first. One document is its own next. Very long texts
are hashed in blocks. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WordHashes, partitions, shared_dir, shingle_hashes, small_batches, stored, words

_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ROW = _OUT + ", part int, edge string, text string"


def fingerprint(text: str, known: WordHashes, shingle_words: int = 2) -> int:
    terms = shingle_hashes(known.of(words(text.encode())), shingle_words)
    if not len(terms):
        return 0
    votes = np.zeros(64, np.int64)
    for at in range(0, len(terms), 8192):
        block = terms[at : at + 8192].astype(">u8").view(np.uint8)
        votes += np.unpackbits(block).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(terms)).tobytes(), "big")


def likeness(a: int, b: int) -> float:
    return 1 - (a ^ b).bit_count() / 64


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many first characters of the next text, or all of it."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _compare(doc, text: str, print_: int, following: str, next_print: int, known: WordHashes) -> tuple:
    changed = edited(text, following)
    other = fingerprint(changed, known) if changed != text else print_
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return doc, len(text), digest, f"{print_:016x}", f"{other:016x}", likeness(print_, other), likeness(print_, next_print)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    names = [c.split()[0] for c in _ROW.split(", ")]
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _in_order(batches):
    """Results for all rows but a partition's last; its first and last text as rows of their own."""
    from pyspark import TaskContext

    known, part = WordHashes(), TaskContext.get().partitionId()
    before, rows, size = None, [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            doc, text = doc.as_py(), text.as_py()
            mark = fingerprint(text, known)
            if before is None:
                rows.append((doc, *[None] * 6, part, "first", text))
            else:
                rows.append((*_compare(*before, text, mark, known), part, None, None))
            before = doc, text, mark
            if len(rows) >= 1000:
                yield _batch(rows)
                rows = []
    if before is not None:
        rows.append((before[0], *[None] * 6, part, "last", before[1]))
    if rows:
        yield _batch(rows)


def _at_edges(batches):
    known = WordHashes()
    for batch in batches:
        rows = []
        for doc, text, following in zip(*(batch.column(c) for c in ("doc_id", "text", "following")), strict=True):
            text, following = text.as_py(), following.as_py()
            found = _compare(doc.as_py(), text, fingerprint(text, known), following, fingerprint(following, known), known)
            rows.append((*found, None, None, None))
        yield _batch(rows).select([c.split()[0] for c in _OUT.split(", ")])


def with_edits(docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document, by ascending id: its fingerprint, its edit's, and how alike they and the next one's are."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = shared_dir(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    done = stored(ordered.mapInArrow(_in_order, _ROW), folder, "rows")
    # One first and one last row a partition: by partition, the next first text; after the last, the very first.
    edges = done.where("edge is not null").groupBy("part").agg(
        F.first(F.when(F.col("edge") == "last", F.struct("doc_id", "text")), ignorenulls=True).alias("last"),
        F.first(F.when(F.col("edge") == "first", F.col("text")), ignorenulls=True).alias("head"),
    )
    line = Window.orderBy("part")
    following = F.coalesce(F.lead("head").over(line), F.first("head").over(line))
    edges = edges.select(F.col("last.doc_id").alias("doc_id"), F.col("last.text").alias("text"), following.alias("following"))
    columns = [c.split()[0] for c in _OUT.split(", ")]
    edges = stored(edges.mapInArrow(_at_edges, _OUT), folder, "edges")
    return done.where("edge is null").select(*columns).unionByName(edges)


def _tables(radius: int) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Masks of the radius + 3 blocks, and the tables: every choice of three blocks."""
    if not 0 <= radius <= 13:
        raise ValueError("a radius from 0 to 13")
    edges = [64 * i // (radius + 3) for i in range(radius + 4)]
    blocks = [(1 << 64 - a) - (1 << 64 - b) for a, b in zip(edges, edges[1:], strict=False)]
    return blocks, list(combinations(range(radius + 3), 3))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _number(column: Column) -> Column:
    """A hex fingerprint as a signed long; halves, as a whole one passes the range of a long."""
    high, low = (F.conv(F.substring(column, i, 8), 16, 10).cast("long") for i in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def _hex(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _matches(radius: int, per_mark: bool):
    """Worker: pairs within the radius among rows (slot, mark) sorted by table, cell and block bits.

    A pair belongs to the first table that holds it, the one of its first three
    equal blocks, so no pair comes twice. Neighbours at distance 1, 2, … in the
    sorted rows are compared until groups end; only one group more than the rows at hand is kept.
    """
    blocks, tables = _tables(radius)
    masks = np.array([sum(blocks[b] for b in t) for t in tables], np.uint64)
    before = [np.array([j < t[2] and j not in t for t in tables]) for j in range(len(blocks))]

    def search(slot, mark):
        table, side = slot & 1023, slot >> 10 & 3
        group, key = slot & ~(3 << 10), mark & masks[table]
        i, apart = np.arange(len(mark)), 0
        while len(i):
            apart += 1
            i = i[i + apart < len(mark)]
            i = i[(key[i] == key[i + apart]) & (group[i] == group[i + apart])]
            j = i + apart
            differ = mark[i] ^ mark[j]
            # A cell of two chunks only takes pairs across them.
            good = (np.bitwise_count(differ) <= radius) & ((side[i] == 0) | (side[i] != side[j]))
            a, b, differ = i[good], j[good], differ[good]
            for block, earlier in zip(blocks, before, strict=True):
                fresh = ~(earlier[table[a]] & (differ & np.uint64(block) == 0))
                a, b, differ = a[fresh], b[fresh], differ[fresh]
            if len(a):
                yield a, b, differ

    def batch(slot, mark):
        as_long = mark.view(np.int64)
        if per_mark:
            near = np.zeros(len(mark), np.int64)
            for a, b, _ in search(slot, mark):  # within a and within b no row comes twice
                near[a] += 1
                near[b] += 1
            some = near > 0
            yield pa.record_batch([pa.array(as_long[some]), pa.array(near[some])], names=["mark", "n"])
        else:
            for a, b, differ in search(slot, mark):
                distance = np.bitwise_count(differ).astype(np.int32)
                yield pa.record_batch([pa.array(as_long[a]), pa.array(as_long[b]), pa.array(distance)], names=["a", "b", "distance"])

    def run(batches):
        slots, marks, rows = [], [], 0
        for given in batches:
            slots.append(given.column("slot").to_numpy())
            marks.append(given.column("mark").to_numpy().view(np.uint64))
            rows += given.num_rows
            if rows < 65536:
                continue
            slot, mark = np.concatenate(slots), np.concatenate(marks)
            group, key = slot & ~(3 << 10), mark & masks[slot & 1023]
            ends = np.flatnonzero((group[1:] != group[:-1]) | (key[1:] != key[:-1]))
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut:
                yield from batch(slot[:cut], mark[:cut])
            slots, marks, rows = [slot[cut:]], [mark[cut:]], len(mark) - cut if cut else 0
        if slots:
            yield from batch(np.concatenate(slots), np.concatenate(marks))

    return run


def _search(marks: DataFrame, radius: int, per_mark: bool, chunk: int | None, sampled: int = 20_000) -> DataFrame:
    """Matches of distinct marks (stored longs): (mark, n), or (a, b, distance).

    Rows of one table with equal bits meet in one place. Where more than a chunk
    meet, they are dealt into chunks, and each pair of chunks is a cell of its own.
    Such places are found on a sample of marks; one it misses is only larger, its pairs are the same.
    """
    spark = marks.sparkSession
    blocks, tables = _tables(radius)
    masks = [F.lit(_signed(sum(blocks[b] for b in t))) for t in tables]
    here = F.array(*[F.struct(F.lit(i).cast("long").alias("table"), F.col("mark").bitwiseAND(m).alias("key")) for i, m in enumerate(masks)])
    dealt = lambda df: df.select("mark", F.inline(here))
    n, parts = marks.count(), partitions(spark)
    # A chunk is at most a quarter of what a task gets anyway, so cells do not stand out and copies stay few.
    chunk = chunk or max(512, n * len(tables) // (4 * parts))
    share = min(1.0, sampled / max(n, 1))
    some = marks.where(F.pmod(F.xxhash64("mark"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    hot = dealt(some).groupBy("table", "key").agg(F.ceil(F.count("*") / F.lit(share * chunk)).alias("chunks")).where("chunks > 1")
    # Few rows: every one stands for more than a chunk of the marks, of which a task has at least four.
    rows = dealt(marks).join(F.broadcast(hot), ["table", "key"], "left")
    own = F.pmod(F.xxhash64(F.lit(7), F.col("mark")), F.col("chunks"))
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda c: F.struct(
            (F.least(c, own) * F.col("chunks") + F.greatest(c, own) + 1).alias("cell"),
            F.when(c == own, 0).when(own < c, 1).otherwise(2).cast("long").alias("side"),
        ),
    )
    whole = F.array(F.struct(F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("side")))
    rows = rows.select("mark", "table", F.inline(F.when(F.col("chunks").isNull(), whole).otherwise(cells)))
    slot = F.shiftleft("cell", 12).bitwiseOR(F.shiftleft("side", 10)).bitwiseOR(F.col("table"))
    rows = rows.select(slot.alias("slot"), "mark")
    # The bits themselves are not shuffled: the mark and its table tell them.
    group = F.col("slot").bitwiseAND(F.lit(~(3 << 10)))
    bits = F.col("mark").bitwiseAND(F.element_at(F.array(*masks), (F.col("slot").bitwiseAND(F.lit(1023)) + 1).cast("int")))
    rows = rows.repartition(parts, group, bits).sortWithinPartitions(group, bits)
    return rows.mapInArrow(_matches(radius, per_mark), "mark long, n long" if per_mark else "a long, b long, distance int")


def _marks(prints: DataFrame, column: str, folder: str) -> DataFrame:
    found = prints.where(F.col(column).isNotNull()).select(_number(F.col(column)).alias("mark")).distinct()
    return stored(found, folder, "marks")


def near_pairs(prints: DataFrame, radius: int = 3, column: str = "fingerprint", chunk: int | None = None) -> DataFrame:
    """All pairs of different fingerprints (hex texts) within the radius, once each: a < b, distance."""
    _tables(radius)
    found = _search(_marks(prints, column, shared_dir(prints.sparkSession)), radius, False, chunk)
    a, b = _hex(F.col("a")), _hex(F.col("b"))
    return found.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "distance")


def with_near(docs: DataFrame, radius: int = 3, column: str = "fingerprint", chunk: int | None = None) -> DataFrame:
    """Adds `n_near`: how many other fingerprints of the whole table, each counted once, lie within the radius."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    counts = _search(_marks(docs, column, folder), radius, True, chunk).groupBy("mark").agg(F.sum("n").alias("n"))
    counts = stored(counts.select(_hex(F.col("mark")).alias(column), F.col("n").alias("n_near")), folder, "near")
    return docs.join(counts, column, "left").select(*docs.columns, F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))
