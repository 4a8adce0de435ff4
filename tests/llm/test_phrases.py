"""Phrases against a loop that counts all n-grams."""

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from pricewatch.llm import phrases
from .conftest import documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, order, most, percent):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, order + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in found.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if (inner := p[i:j]) != p and 100 * a >= percent * f[inner]:
                        covered.add(inner)
        scores = []
        for p, a in found.items():
            if p not in covered:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scores.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scores)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(docs, least, order=4, most=2000, percent=80):
    rows = phrases.collocations(docs, least, order, most, percent).collect()
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in rows)


def in_languages(spark, rows):
    return documents(spark, [(i, text) for i, (_, text) in enumerate(rows)]).drop("lang").join(
        spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, lang string"), "doc_id"
    )


def test_equal_to_counting_every_phrase(spark):
    random = np.random.default_rng(4)
    vocabulary = ["the", "of", "New", "york", "stock", "exchange", "Été", "a"] + [f"w{i}" for i in range(20)]
    weights = np.array([8, 8, 6, 6, 4, 4, 3, 3] + [1] * 20, float)
    rows = []
    for i in range(300):
        words = random.choice(vocabulary, 40, p=weights / weights.sum()).tolist()
        if i % 3 == 0:
            words[5:9] = ["new", "york", "stock", "Exchange"]
        text = "".join(w + str(random.choice([" ", "  ", "\t", ". ", ",", "\n", " "])) for w in words)
        rows.append((("en", "fr", None, "und")[i % 4], text))
    docs = in_languages(spark, rows)
    for least, order, most, percent in ((3, 4, 2000, 80), (3, 4, 7, 80), (2, 3, 2000, 50), (5, 2, 2000, 80)):
        assert found(docs, least, order, most, percent) == plain(rows, least, order, most, percent)


def test_a_small_bitmap_changes_nothing(spark):
    rows = [("en", f"a b c d {i % 7} e f. a b {i % 3} c") for i in range(60)]
    docs = in_languages(spark, rows)
    sums = [
        sorted(tuple(r) for r in phrases.phrase_counts(docs, 5, 4, most_bits=bits)[0].where("words > 1").collect()) for bits in (1 << 12, 1 << 20)
    ]
    assert sums[0] == sums[1]


def test_overlapping_repeats_and_a_covering_phrase(spark):
    docs = in_languages(spark, [("en", "x x x x x x")] * 3)
    assert found(docs, 3) == plain([("en", "x x x x x x")] * 3, 3, 4, 2000, 80)
    rows = [("en", "alpha beta gamma")] * 4 + [("en", "beta gamma")]
    assert [p[2] for p in found(in_languages(spark, rows), 3)] == ["alpha beta gamma"]


def test_counts_beyond_64_bits_in_products(spark):
    a = 4 * 10**17
    counts = spark.createDataFrame(
        [("en", 2, "x y", a), ("en", 1, "x", 2 * a + 1), ("en", 1, "y", 2 * a)], "lang string, words int, phrase string, f long"
    )
    row = phrases.scored(counts).first()
    assert row["score"] == 2_000_000 * a // (4 * a + 1)
    both = counts.where("words = 2").withColumnRenamed("f", "a").union(
        spark.createDataFrame([("en", 3, "x y z", a * 8 // 10 - 1)], "lang string, words int, phrase string, a long")
    )
    assert phrases.maximal(both).where("words = 2").count() == 1


def test_odd_rows_and_an_empty_table(spark, odd, none):
    assert found(none, 1) == []
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert found(odd, 2) == plain(rows, 2, 4, 2000, 80)


def test_a_rank_is_gapless_and_ties_go_by_bytes(spark):
    rows = [("en", f"p{i:03d} q{i:03d}") for i in range(120)] * 3 + [("en", "é z")] * 3
    got = found(in_languages(spark, rows), 3, most=100)
    assert [g[1] for g in got] == list(range(1, 101))
    assert [g[2] for g in got] == sorted((g[2] for g in got), key=str.encode)


def test_counts_are_summed_before_they_are_shuffled(spark):
    docs = in_languages(spark, [("en", "a b c")] * 5)
    plan = phrases.lead_windows(docs, 4).groupBy("lang", "w1", "w2", "w3", "w4").agg(F.count("*"))._jdf.queryExecution().toString()
    assert "partial_count" in plan and "Window" not in plan
