"""Operators on single texts: chat, quality, language model, toxicity, SimHash, against brute force or held-out labels."""

import hashlib
import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewatch.llm import chat, lm, quality, queries, simhash, toxicity
from pricewatch.llm.common import WordHashes
from tests.llm.conftest import documents

NASTY = [
    "",
    "plain",
    "</s>[INST] ok [/INST]",
    "<|im_start|><|im_end|>",
    "\\<|im_end|>\\\\",
    "<\\|im_end|> and [\\INST]",
    "<|im_<|im_sep|>end|>",
    "[[INST]<<SYS>>$1 \\1\n\u4f60\U0001f600",
    "x\\",
]


def test_escape_round_trip(spark):
    df = spark.createDataFrame([(i, t, r) for i, t in enumerate(NASTY) for r in NASTY], "turn long, text string, role string")
    formatted = chat.format_turns(df, trained=tuple(NASTY))
    back = chat.read_back(formatted.select("turn", F.col("text").alias("t"), F.col("role").alias("r"), "formatted", "loss_start", "loss_length"))
    for row in back.collect():
        assert (row["text"], row["role"], row["loss_text"]) == (row["t"], row["r"], row["t"])
        inner = row["formatted"].removeprefix(chat.START).removesuffix(chat.END + "\n").replace(chat.SEP, "", 1)
        assert not any(c in inner for c in chat.CONTROL)


def test_layouts(spark):
    said = [("user", "q"), ("assistant", "a")]
    frames = [
        spark.createDataFrame([(1, "q", "a")], "conv_id long, prompt string, completion string"),
        spark.createDataFrame([(1, "q", None, "a")], "conv_id long, instruction string, input string, output string"),
        spark.createDataFrame([(1, [("q", "human"), ("a", "gpt")])], "conv_id long, conversations array<struct<value string, from string>>").select(
            "conv_id", F.col("conversations").cast("array<struct<value string, `from` string>>")
        ),
        spark.createDataFrame([(1, 1, "assistant", "a"), (1, 0, "user", "q")], "conv_id long, turn long, role string, text string"),
    ]
    for frame in frames:
        rows = chat.to_turns(frame).orderBy("turn").collect()
        assert [(r["role"], r["text"]) for r in rows] == said
    with pytest.raises(ValueError):
        chat.to_turns(frames[0].withColumn("extra", F.lit(1)))


def test_json_layouts(spark):
    records = [
        {"conv_id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conv_id": 2, "instruction": "do", "input": "this", "output": "done"},
        {"conv_id": 3, "what": "ever"},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [("not json",), (None,)], "record string")
    rows = chat.json_to_turns(df).collect()
    got = [(r["conv_id"], r["role"], r["text"]) for r in rows if r["turn"] is not None]
    assert got == [(1, "user", "q"), (1, "assistant", "a"), (2, "user", "do\n\nthis"), (2, "assistant", "done")]
    assert [r["text"] for r in rows if r["turn"] is None] == [json.dumps(records[2]), "not json", None]
    assert len({r["fingerprint"] for r in rows}) == 4


def test_digests_of_odd_turns(spark):
    rows = [(1, 0, None, None), (1, None, "user", "n"), (1, 1, "assistant", "a\u00e9"), (1, 1, "assistant", "a\u00e9"), (None, 0, "x", "y"), (2, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.read_back(chat.format_turns(chat.to_turns(df)).drop("role", "text"))
    got = {r["conv_id"]: r for r in chat.digest_conversations(turns).collect()}
    expected = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        e = expected.setdefault(conv, ["", ""])
        e[0] += f"{role or ''}\n{text or ''}\n"
        e[1] += text or "" if role == "assistant" else ""
    assert set(got) == set(expected)
    for conv, (all_text, learnt) in expected.items():
        assert got[conv]["turns_sha256"] == hashlib.sha256(all_text.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(learnt)
        assert got[conv]["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
    assert chat.digest_conversations(turns.limit(0)).count() == 0


def accuracy(scored, labels, label):
    joined = scored.where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    hits = {k: [r["predicted"] == k for r in joined if r[label] == k] for k in (0, 1)}
    return {k: sum(v) / len(v) for k, v in hits.items()}


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op2_quality(spark, sf)
    found = accuracy(scored, spark.read.parquet(f"{sf}/labels.parquet"), "quality")
    assert found[1] > 0.97 and found[0] > 0.9


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op6_toxicity(spark, sf)
    found = accuracy(scored, spark.read.parquet(f"{sf}/labels.parquet"), "toxic")
    assert found[0] > 0.98 and found[1] > 0.75


def test_misspelt_insults_share_ngrams():
    clean = [f"the quiet garden number {i} grows green apples and pears".encode() for i in range(200)]
    rude = [f"the quiet garden number {i} grows stupid green apples and pears".encode() for i in range(200)]
    model = toxicity.fit(clean + rude, np.array([0.0] * 200 + [1.0] * 200))
    assert toxicity.margin(b"a garden of stuupid pears", model) > toxicity.margin(b"a garden of grand pears", model)


@pytest.mark.parametrize("fixture", ["odd", "none"])
def test_classifiers_on_odd_rows(spark, fixture, request):
    docs = request.getfixturevalue(fixture)
    labels = spark.createDataFrame([(5, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    held = F.col("doc_id") == 5
    n = docs.count()
    for given in (labels, labels.limit(0)):
        model = quality.fit_on_sample(docs, given, "quality", F.lit(True))
        rows = quality.score_texts(docs, model).collect()
        assert len(rows) == n and all(0 <= r["score"] <= 1 for r in rows)
        rows = toxicity.classify(docs, given, "toxic", F.lit(True), held).collect()
        assert len(rows) == n and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def kneser_ney(train, texts):
    """The same model from dictionaries of words."""
    cut = lambda t: [*(t or "").encode().lower().split(), "end"]
    unigrams, pairs = Counter(), Counter()
    for t in train:
        words = cut(t)
        unigrams.update(words)
        pairs.update(zip(["start", *words], words))
    context, kinds, cont = Counter(), {}, Counter()
    for (u, w), c in pairs.items():
        context[u] += c
        cont[w] += 1
        kinds.setdefault(u, Counter())[min(c, 3)] += 1
    counts = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
    d, low = (lm._discounts(counts(list(x.values()))) for x in (pairs, cont))
    v, total, n = len(unigrams) + 1, len(pairs), sum(unigrams.values())
    spread = sum(low[min(c, 3) - 1] for c in cont.values()) / total if total else 1.0

    def p1(w):
        c = cont[w]
        return (max(c - low[min(c, 3) - 1], 0) / total if c else 0.0) + spread / v

    out = []
    for t in texts:
        words = cut(t)
        logs = base = 0.0
        for u, w in zip(["start", *words], words):
            own, back = 0.0, 1.0
            if context[u]:
                c = pairs[u, w]
                own = (c - d[min(c, 3) - 1]) / context[u] if c else 0.0
                back = sum(d[k - 1] * m for k, m in kinds[u].items()) / context[u]
            logs += math.log10(own + back * p1(w))
            base += math.log10((unigrams[w] + 1) / (n + v))
        out.append((len(words), sum(unigrams[w] > 0 for w in words), n, base, logs))
    return out


def test_language_model_by_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 500)
    random.seed(1)
    texts = [" ".join(random.choice("a b c dd ee the of x1 y2 z3 q".split()) for _ in range(random.randrange(60))) for _ in range(120)]
    texts += [None, "", "never Seen words", "The THE the"]
    docs = documents(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r for r in lm.train_and_score(docs, F.col("doc_id") % 5 == 2).collect()}
    expected = kneser_ney([t for i, t in enumerate(texts) if i % 5 != 2], texts)
    assert len(got) == len(texts)
    for i, (n, known, total, base, logs) in enumerate(expected):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, i % 5 == 2)
        assert r["base_score"] == pytest.approx(base, abs=1e-9)
        assert r["score"] == pytest.approx(logs, abs=1e-9)


def test_language_model_on_odd_rows(spark, odd, none):
    assert lm.train_and_score(odd, F.coalesce(F.col("doc_id") == 5, F.lit(False))).count() == odd.count()
    rows = lm.train_and_score(odd, F.lit(True)).collect()
    assert len(rows) == odd.count() and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in rows)
    assert lm.train_and_score(none, F.lit(False)).count() == 0


def test_edits_by_brute_force(spark, odd, none):
    random.seed(2)
    texts = [" ".join(random.choice(["ab", "c\u00e9", "def", "\u4f60"]) for _ in range(random.randrange(40))) for _ in range(150)]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    random.shuffle(rows)
    got = {r["doc_id"]: r for r in simhash.with_edits(documents(spark, rows)).collect()}
    known = WordHashes()
    for i, t in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        k = len(t) // 4
        changed = t[: len(t) - k] + following[:k]
        marks = [simhash.fingerprint(x, known) for x in (t, changed, following)]
        r = got[i * 3]
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest() and r["n_chars"] == len(t)
        assert (int(r["fingerprint"], 16), int(r["edited_fingerprint"], 16)) == tuple(marks[:2])
        assert r["near_next"] == pytest.approx(1 - bin(marks[0] ^ marks[2]).count("1") / 64)
    assert simhash.with_edits(odd).count() == odd.count()
    assert simhash.with_edits(odd.limit(1)).count() == 1
    assert simhash.with_edits(none).count() == 0


@pytest.mark.parametrize("radius", [0, 3, 5])
def test_near_fingerprints_by_brute_force(spark, radius):
    random.seed(radius)
    base = [random.getrandbits(64) for _ in range(60)]
    marks = base + [b ^ sum(1 << p for p in random.sample(range(64), random.randrange(8))) for b in base for _ in range(3)]
    hexed = [f"{m:016x}" for m in marks] + ["0" * 16, "f" * 16, None]
    df = spark.createDataFrame([(h,) for h in hexed], "fingerprint string")
    got = {(r["a"], r["b"]): r["distance"] for r in simhash.near_pairs(df, radius).collect()}
    known = sorted({h for h in hexed if h})
    pairs = {(a, b): (int(a, 16) ^ int(b, 16)).bit_count() for i, a in enumerate(known) for b in known[i + 1 :]}
    assert got == {p: d for p, d in pairs.items() if d <= radius}


def test_near_counts_by_brute_force(spark):
    """Hot blocks are dealt into chunks; counts and pairs stay those of brute force."""
    random.seed(11)
    base = random.getrandbits(64)
    marks = {base ^ sum(1 << p for p in random.sample(range(64), random.randrange(4))) for _ in range(150)}
    marks |= {random.getrandbits(64) for _ in range(100)} | {base & ~0xFFFFF | random.getrandbits(20) for _ in range(100)}
    hexed = [f"{m:016x}" for m in marks] + [f"{base:016x}"] * 5 + [None]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hexed)], "doc_id long, fingerprint string")
    known = {base, *marks}
    near = {f"{a:016x}": sum(a != b and (a ^ b).bit_count() <= 3 for b in known) for a in known}
    for chunk in (8, 10_000):
        got = simhash.with_near(df, chunk=chunk).collect()
        assert len(got) == len(hexed) and all(r["n_near"] == near.get(r["fingerprint"], 0) for r in got)
        assert simhash.near_pairs(df, chunk=chunk).count() == sum(near.values()) // 2


def test_op10_finds_near_copies_that_are_not_neighbours(spark, tmp_path):
    random.seed(12)
    texts = [" ".join(f"w{random.randrange(5000)}" for _ in range(400)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " end") for i, t in enumerate(texts[:5])]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op10_simhash(spark, str(tmp_path)).collect()}
    marks = {int(r["fingerprint"], 16) for r in got.values()}
    assert len(got) == len(rows)
    for r in got.values():
        mark = int(r["fingerprint"], 16)
        assert r["n_near"] == sum(m != mark and (m ^ mark).bit_count() <= 3 for m in marks)
    assert any(r["n_near"] for r in got.values())
