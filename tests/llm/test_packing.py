"""Packing: ids, cutting, plans and sequences against plain loops."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricewatch.llm import packing
from .conftest import documents


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = [
    "",
    " ",
    "Hello  world,\n\n it's 12345 Été 你好 \U0001f600 naïve \x1c \x85 end ",
    "a <|endoftext|> b<|endoftext|>",
    "   leading\tand trailing \t ",
    "x" * 5000 + " " * 700 + "y",
]


def test_ids_are_those_of_the_tokenizers_file(reference, monkeypatch):
    for text in TEXTS:
        assert packing.token_ids(text).tolist() == reference.encode(text, add_special_tokens=False).ids
    # Stretches of any length give the same ids.
    long = " ".join(TEXTS * 4)
    whole = reference.encode(long, add_special_tokens=False).ids
    for stretch in (1, 7, 100):
        monkeypatch.setattr(packing, "STRETCH", stretch)
        assert packing.token_ids(long).tolist() == whole


def test_ids_agree_around_every_kind_of_character(reference):
    """The two libraries class characters alike: a sample of all code points (every 37th), in four surroundings."""
    for code in range(0, 0x32000, 37):
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}b 1{chr(code)}2 !{chr(code)}? {chr(code)}{chr(code)} x"
            assert packing.token_ids(text).tolist() == reference.encode(text, add_special_tokens=False).ids, hex(code)


def test_only_long_documents_are_cut_and_the_first_piece_is_short():
    assert packing.cut_lengths(1, 8) == [1]
    assert packing.cut_lengths(8, 8) == [8]
    assert packing.cut_lengths(16, 8) == [8, 8]
    assert packing.cut_lengths(19, 8) == [3, 8, 8]


def unrolled(entries):
    """(length, rank, sequence, offset) of every piece."""
    return [
        (e.length, e.rank + i, e.sequence + i // e.each, e.offset + i % e.each * e.length) for e in entries for i in range(e.count)
    ]


def check_plan(counts, capacity):
    placed = unrolled(packing.plan(counts, capacity))
    assert sorted((length, rank) for length, rank, _, _ in placed) == sorted((x, r) for x, n in counts.items() for r in range(n))
    by_sequence = {}
    for length, _, sequence, offset in placed:
        by_sequence.setdefault(sequence, []).append((offset, length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def best_fit_decreasing(counts, capacity):
    rooms = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


def test_plans_place_every_piece_once_and_near_the_least_number():
    random = np.random.default_rng(5)
    ratio = []
    for capacity, high, n in ((10, 10, 40), (24, 24, 300), (64, 20, 300), (64, 64, 500), (64, 40, 7)):
        for _ in range(8):
            counts = dict(Counter(random.integers(1, high + 1, n).tolist()))
            used = check_plan(counts, capacity)
            plain = best_fit_decreasing(counts, capacity)
            assert used <= plain * 1.05 + 1
            ratio.append(used / plain)
    assert np.mean(ratio) < 1.02
    assert packing.plan({}, 8) == []


def test_exact_complements_fill_sequences_without_a_gap():
    left = np.zeros(17, np.int64)
    for length, n in {16: 2, 9: 3, 7: 1, 4: 3, 3: 1, 2: 1, 5: 1}.items():
        left[length] = n
    found = packing.exact_fills(left, 16)
    assert all(sum(lengths) == 16 for lengths, _ in found)
    # 16, 16, 9+7, 9+4+3 and 9+5+2 leave two pieces of 4.
    assert sum(times for _, times in found) == 5 and left[4] == 2 and left.sum() == 2


def test_a_combination_counts_lengths_that_it_holds_several_times():
    assert check_plan({4: 3}, 16) == 1
    assert check_plan({8: 1, 4: 2}, 16) == 1
    assert check_plan({5: 3, 1: 1}, 16) == 1
    assert check_plan({6: 1, 5: 1}, 16) == 1


def test_best_fit_groups_equal_sequences_as_one_by_one_would():
    random = np.random.default_rng(9)
    for _ in range(30):
        counts = dict(Counter(random.integers(1, 30, 60).tolist()))
        left = np.zeros(33, np.int64)
        for length, n in counts.items():
            left[length] = n
        groups = packing.best_fit(left, 32)
        assert sum(times for _, times in groups) == best_fit_decreasing(counts, 32)
        assert Counter(x for lengths, times in groups for x in lengths * times) == Counter(counts)


@pytest.mark.parametrize("capacity", [8, 1024])
def test_documents_come_back_from_their_sequences(spark, odd, reference, capacity):
    packed = packing.pack_documents(odd, capacity).cache()
    rows, texts = packed.collect(), [(r["doc_id"], r["text"]) for r in odd.collect()]
    sequences = {r["sequence_id"]: (r["length"], bytes(r["ids"])) for r in packing.sequences(packed).collect()}
    assert all(len(ids) == 4 * length <= 4 * capacity for length, ids in sequences.values())
    by_sequence = Counter()
    for r in rows:
        length, ids = sequences[r["sequence_id"]]
        own = ids[4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert own == bytes(r["ids"]) and zlib.crc32(own) == r["ids_crc32"]
        by_sequence[r["sequence_id"]] += r["length"]
    assert all(sequences[s][0] == n for s, n in by_sequence.items())
    wanted = Counter()
    for doc_id, text in texts:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 2]
        start = 0
        for piece, length in enumerate(packing.cut_lengths(len(ids), capacity)):
            wanted[doc_id, piece, start, np.array(ids[start : start + length], "<u4").tobytes()] += 1
            start += length
    assert Counter((r["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in rows) == wanted
    packed.unpersist()


def test_empty_table(none):
    assert packing.pack_documents(none).count() == 0


def test_many_tasks_and_one_frequent_length(spark):
    docs = documents(spark, [(i, "same words here" if i % 3 else f"other {'x ' * (i % 50)}") for i in range(900)]).repartition(13)
    rows = packing.pack_documents(docs, 64, carry=()).collect()
    at = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]]
        at[r["sequence_id"]] += r["length"]
    assert len(rows) == 900 and max(at.values()) <= 64
    assert len(at) <= -(-sum(at.values()) // 64) + 1
