"""Phrase collocation mining by top-order marginalisation.

Every word is the head of one window: itself and the next words of its piece as
lead columns, padded with nulls behind the piece's end. Only these longest windows
are counted; ROLLUP over (lang, w1, w2, ...) then sums them to the counts of all
shorter prefixes, which are the shorter phrases, down to the number of words of a
language. No n-gram of a lower order is exploded for its count.

Windows end early where they can no longer be part of a result: a phrase that
occurs `least` times has only neighbouring pairs that do. A first pass over
pair windows finds the frequent pairs and keeps them, and the words in them, as bitmaps of
their hashes, of a bounded size (`most_bits`). A window is padded from its first pair that is not
there. Pairs that share a hash or a bit by chance only make some windows longer than they need
be, so the counts of all phrases with at least `least` occurrences, of their
parts and of a language's words are exact.

Counts are summed before they are shuffled, so a word, pair or passage that is everywhere is one row
a task. The best phrases of a language are picked in two steps, first
within slices by a hash of the phrase. Products are decimals, exact beyond 64 bits.

Cases. Null texts are empty and have no words, a null language is `und`. Blank
pieces have no words. Repeated rows count each. Ties: cuts by the smaller first part,
phrases by their bytes. An empty table gives an empty result. Other columns are not read. A
long text is split piece by piece, so memory grows with the longest piece without
punctuation or line ends (about 100 bytes a word of it).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import lower_ascii, partitions, shared_dir, stored

PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
BLANKS = r"[\x20\x09]+"


def lead_windows(docs: DataFrame, order: int, text_col: str = "text", lang: str = "lang") -> DataFrame:
    """A row for each word: lang, the word as w1 and those after it in its piece as w2, w3, ..."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The two agree on ASCII, where the first is several times as fast.
    text = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(lower_ascii(text))
    pieces = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.explode(F.split(text, PIECE_ENDS)).alias("piece"))
    words = pieces.select("lang", F.array_remove(F.split("piece", BLANKS), "").alias("w1")).where(F.size("w1") > 0)
    # Slices from the second, third, ... word on: zipped, they are the leads.
    leads = [F.col("w1"), *[F.slice("w1", i, F.size("w1")).alias(f"w{i}") for i in range(2, order + 1)]]
    return words.select("lang", F.inline(F.arrays_zip(*leads)))


def _hash(word: str) -> Column:
    return F.xxhash64("lang", word)


class Bitmap(NamedTuple):
    """A set of hashes: a bit each in an array of 64-bit words. Others may share a bit, so it holds the set and a little more."""

    words: Column
    bits: int

    def has(self, value: Column) -> Column:
        slot = F.pmod(value, F.lit(self.bits))
        return F.getbit(F.get(self.words, F.shiftright(slot, 6).cast("int")), F.pmod(slot, F.lit(64)).cast("int")) == 1


def bitmap(hashes: DataFrame, most_bits: int) -> Bitmap:
    """A bitmap of the column `h`: sixteen bits for each row, at most `most_bits`."""
    bits, wanted = 1 << 12, 16 * hashes.count()
    while bits < min(wanted, most_bits):
        bits *= 2
    slot = F.pmod("h", F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))
    marks = hashes.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(bit).alias("marks")).toArrow()  # most_bits / 64 rows
    words = np.zeros(bits // 64, np.int64)
    words[marks["at"].to_numpy()] = marks["marks"].to_numpy()
    row = pa.table({"bitmap": pa.array([words], pa.list_(pa.int64()))})
    return Bitmap(hashes.sparkSession.createDataFrame(row).scalar(), bits)


def frequent(pairs: DataFrame, least: int, folder: str, most_bits: int) -> tuple[Bitmap, Bitmap]:
    """Words and pairs of neighbours: the pairs that occur `least` times, and the words in them.

    Pairs are counted by their words' hashes; those that share one are counted together, which only adds pairs.
    """
    counted = pairs.where("w2 is not null").groupBy(_hash("w1").alias("a"), _hash("w2").alias("b")).count()
    often = stored(counted.where(F.col("count") >= least).select("a", "b"), folder, "pairs")
    words = often.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    return bitmap(words, most_bits), bitmap(often.select(F.xxhash64("a", "b").alias("h")), most_bits)


def shortened(windows: DataFrame, order: int, words: Bitmap, pairs: Bitmap) -> DataFrame:
    """Windows padded from their first pair that is not frequent; all pads where the first word is in no frequent pair."""
    windows = windows.withColumns({f"h{i}": _hash(f"w{i}") for i in range(1, order + 1)})
    windows = windows.withColumn("w1", F.when(words.has(F.col("h1")), F.col("w1")))
    for i in range(2, order + 1):
        # A pad before it pads what follows.
        known = F.col(f"w{i - 1}").isNotNull() & pairs.has(F.xxhash64(f"h{i - 1}", f"h{i}"))
        windows = windows.withColumn(f"w{i}", F.when(known, F.col(f"w{i}")))
    return windows


def phrase_counts(
    docs: DataFrame,
    least: int = 30,
    order: int = 4,
    text_col: str = "text",
    lang: str = "lang",
    most_bits: int = 1 << 25,
) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of phrases of up to `order` words with f >= least, and (lang, n); stored.

    Complete for phrases of two words and more; of single words those that such a phrase has.
    """
    if order < 2:
        raise ValueError("a phrase has two words at least")
    folder = shared_dir(docs.sparkSession)
    windows = lead_windows(docs, order, text_col, lang)
    windows = shortened(windows, order, *frequent(lead_windows(docs, 2, text_col, lang), least, folder, most_bits))
    names = [f"w{i}" for i in range(1, order + 1)]
    # One text for a window while it is counted: pads are at its end only.
    counted = windows.groupBy("lang", F.concat_ws(" ", *names).alias("window")).agg(F.count("*").alias("n"))
    parts = [F.nullif(F.split_part("window", F.lit(" "), F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(names, 1)]
    counted = stored(counted.select("lang", *parts, "n"), folder, "windows")
    # Whole windows are counted by now; all shorter prefixes are their sums.
    top = counted.where(F.col(names[-1]).isNotNull() & (F.col("n") >= least))
    rolled = counted.rollup("lang", *names[:-1]).agg(F.sum("n").alias("f"), F.grouping_id().alias("_rolled"))
    # The words that were not summed over: one fewer for each bit, none for a language.
    size = order - 1 - F.length(F.regexp_replace(F.bin("_rolled"), "0", ""))
    sums = rolled.withColumn("words", size.cast("int")).where("words >= 0")
    whole = F.get(F.array(*names[:-1]), F.col("words") - 1).isNotNull() & (F.col("f") >= least)
    sums = sums.where((F.col("words") == 0) | whole).select("lang", "words", F.concat_ws(" ", *names[:-1]).alias("phrase"), "f")
    sums = sums.union(top.select("lang", F.lit(order), F.concat_ws(" ", *names), "n"))
    sums = stored(sums, folder, "sums")
    return sums.where("words > 0"), sums.where("words = 0").select("lang", F.col("f").alias("n"))


def _exact(count: str) -> Column:
    return F.col(count).cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more, with the parts and the score of their lowest-scoring cut."""
    whole = phrases.where("words > 1").withColumnRenamed("f", "a").withColumn("_w", F.split("phrase", " "))
    cuts = whole.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    part = lambda start, length: F.array_join(F.slice("_w", start, length), " ")
    cuts = cuts.withColumns({"first": part(F.lit(1), F.col("cut")), "rest": part(F.col("cut") + 1, F.col("words") - F.col("cut"))})
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.select("*", _exact("a").alias("_a"), (_exact("l") + _exact("r")).alias("_lr"))
    score = F.expr("cast((2000000 * _a) div _lr as long)")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "lowest.l", "lowest.r", "lowest.score")


def maximal(found: DataFrame, percent: int = 80) -> DataFrame:
    """Without phrases that lie in a longer one which occurs `percent` % as often."""
    words = F.split("phrase", " ")
    starts = lambda n: F.sequence(F.lit(1), F.col("words") - n + 1)
    inside = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(starts(n), lambda i: F.array_join(F.slice(words, i, n), " "))
        )
    )
    longer = found.where("words > 2").select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.coalesce(_exact("longer") * 100 >= _exact("a") * percent, F.lit(False))
    return found.join(longer, ["lang", "phrase"], "left").where(~covered).drop("longer")


def best(found: DataFrame, most: int) -> DataFrame:
    """The first `most` of each language with their rank: first within slices, then among the slices' best."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    sliced = found.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(partitions(found.sparkSession))))
    place = F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order))
    few = sliced.withColumn("_place", place).where(F.col("_place") <= most).drop("_place", "_slice")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)


def collocations(docs: DataFrame, least: int = 30, order: int = 4, most: int = 2000, percent: int = 80, **columns: str) -> DataFrame:
    """Per language its best phrases: lang, rank, phrase, a, l, r, n, score."""
    phrases, totals = phrase_counts(docs, least, order, **columns)
    found = best(maximal(scored(phrases), percent), most)
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
