"""Operators over the whole corpus: sharding, mixing, near-duplicates, decontamination, WARC, and the pipeline."""

import gzip
import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricewatch.llm import decontaminate, minhash, mixing, quality, queries, sharding, warc
from tests.conftest import SF
from tests.llm.conftest import documents

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def lowered(text):
    return (text or "").encode().lower()


# --- near-duplicates


def linked_groups(rows, n):
    """Components by comparing everything with everything."""
    sets = []
    for _, text in rows:
        w = WORDS.findall(lowered(text))
        k = min(n, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    ids = [i for i, _ in rows]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and ids[a] is not None and ids[b] is not None and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(ids[a]), find(ids[b])
                root[max(p, q)] = min(p, q)
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in zip(ids, sets)), key=str)


def found_groups(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_near_duplicates_by_brute_force(spark, n):
    """Edited copies of a few texts, from hardly to strongly changed: links above, at and below the threshold."""
    random.seed(n)
    vocabulary = [f"v{i}" for i in range(400)] + ["the", "of"] * 40
    rows = [(10_000 + i, t) for i, t in enumerate(["", None, "one", "One", "two words", "two  words", "a b c d e", "a b c d f"])]
    for group in range(4):
        base = [random.choice(vocabulary) for _ in range(random.choice([12, 40, 110]))]
        for _ in range(60):
            w = list(base)
            for _ in range(random.randrange(0, max(2, len(w) // 6))):
                w[random.randrange(len(w))] = random.choice(vocabulary)
            if random.random() < 0.2:
                w = w[: int(len(w) * random.uniform(0.75, 1))]
            rows.append((len(rows), " ".join(w)))
    random.shuffle(rows)
    assert found_groups(minhash.near_duplicates(documents(spark, rows), n)) == linked_groups(rows, n)


def test_near_duplicates_on_odd_rows(spark, odd, none):
    rows = minhash.near_duplicates(odd, 2).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r["component_id"] for r in rows}
    assert by_id[6] == 5 and by_id[5] == 5 and by_id[1] == 1 and by_id[None] is None
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert minhash.near_duplicates(none).count() == 0


def test_a_large_group_of_near_copies(spark):
    """Two families of edited copies, many too far from the centre: equal to comparing all pairs, whatever was compared."""
    random.seed(11)
    vocabulary = [f"v{i}" for i in range(60)]
    rows = []
    for family in range(2):
        base = [random.choice(vocabulary) + str(family) for _ in range(60)]
        for _ in range(250):
            w = list(base)
            for _ in range(random.randrange(0, 14)):
                at = random.randrange(len(w))
                w[at : at + 1] = random.choice([[], [random.choice(vocabulary)], [w[at], "and"]])
            rows.append((len(rows), " ".join(w[: random.choice([60, 60, 60, 48, 50])])))
    assert found_groups(minhash.near_duplicates(documents(spark, rows), 2)) == linked_groups(rows, 2)


def test_one_row_of_each_group_stays(spark, odd, none):
    rows = [(1, "t t t"), (2, "t t t"), (2, "u v w"), (2, "u v w"), (3, "U v w"), (None, "t t t"), (None, "t t t"), (4, None), (4, ""), (5, "")]
    left = minhash.deduplicated(documents(spark, rows), 2)
    wanted = {(1, "t t t"): 1, (2, "u v w"): 1, (None, "t t t"): 2, (4, ""): 1, (5, ""): 1}
    assert Counter((r["doc_id"], r["text"] or "") for r in left.collect()) == Counter(wanted)
    assert minhash.deduplicated(none).count() == 0
    assert {r["doc_id"] for r in minhash.deduplicated(odd, 2).collect()} == {None, 1, 2, 3, 4, 5, 7, 8}


CLASHES = ["_size", "_group", "_cell", "_rank", "_own", "_copy", "_quality", "_accepted", "_cut", "_crate", "_first", "_row", "_copies", "_flag_id", "_id", "_md5", "aside0"]


def test_stages_on_odd_rows_and_clashing_names(spark, odd, none):
    """Each stage runs on nulls, repeats and no rows at all, and gives back further columns as they were."""
    for docs in (odd, none):
        for c in CLASHES:
            docs = docs.withColumn(c, F.lit(c))
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns[: len(docs.columns)] == docs.columns or set(out.columns) == {*docs.columns, "slot"}, name
            for r in out.collect():
                assert all(r[c] == c for c in CLASHES), name


def test_rows_whose_nulls_stand_elsewhere_are_told_apart(spark):
    docs = documents(spark, [(1, "a b c", None), (1, None, "a b c")])
    copies = Counter((r["text"], r["source"]) for r in mixing.mixed_documents(docs).collect())
    wanted = Counter()
    for r in mixing.mix(docs).collect():
        wanted[r["size"]] += r["copies"]
    assert copies["a b c", None] == wanted[3] and copies[None, "a b c"] == wanted[0]


# --- decontamination

PIECES = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return PIECES.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute_hits(docs, items, size):
    out = []
    for i, text in docs:
        w, hit, seen = words_of(text), set(), set()
        for item, x in items:
            x = words_of(x)
            k = min(size, len(x))
            for j in range(len(x) - k + 1) if k else ():
                for at in range(len(w) - k + 1):
                    if w[at : at + k] == x[j : j + k]:
                        hit.update(range(at, at + k))
                        seen.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), sorted(seen)))
    return sorted(out, key=str)


@pytest.mark.parametrize("size, broadcast_rows", [(13, 500_000), (13, 0), (4, 500_000), (1, 500_000)])
def test_hits_by_brute_force(spark, size, broadcast_rows):
    random.seed(size)
    vocabulary = "a b c \u00e9 d3 E f".split()
    text = lambda n: "".join(random.choice(vocabulary) + random.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(k, text(random.choice([0, 1, 3, 6, 12, 13, 14, 30]))) for k in range(14) if k % 5 or size > 1] + [(None, text(20)), (99, None)]
    items = [(k, t) for k, t in items if len(words_of(t)) >= 5 or size < 13 or k == 1]
    docs = []
    for i in range(60):
        t = text(random.randrange(60))
        if i % 2:
            t += random.choice(items)[1] or ""
        docs.append((i, t + text(random.randrange(20))))
    docs += [(100, None), (101, ""), (3, docs[3][1]), (None, items[2][1])]
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_hits(documents(spark, docs), tests, size, broadcast_rows=broadcast_rows)
    rows = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=str)
    assert rows == brute_hits(docs, items, size)


def test_removal_of_documents_and_spans(spark, odd, none):
    passage = " ".join(f"p{i}" for i in range(15))
    filler = " ".join(f"f{i}" for i in range(400))
    rows = [(1, f"Start, {passage}! end."), (2, f"{filler} {passage} tail"), (3, filler), (4, None), (5, "")]
    docs, tests = documents(spark, rows), spark.createDataFrame([(1, passage.upper())], "item_id long, text string")
    left = decontaminate.decontaminate(docs, tests)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 5]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, tests, "spans").collect()}
    assert cut == {1: "Start! end.", 2: f"{filler} tail", 3: filler, 4: None, 5: ""}
    assert decontaminate.decontaminate(odd, tests).count() == odd.count()
    assert decontaminate.decontaminate(odd, tests.limit(0), "spans").count() == odd.count()
    assert decontaminate.decontaminate(none, tests).count() == 0


# --- sharding


def check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_even_and_hot_groups_cut(spark):
    random.seed(4)
    texts = [" ".join("w" * random.randrange(1, 9) for _ in range(random.randrange(1, 120))) for _ in range(3000)]
    rows = list(enumerate(texts + ["the same text again"] * 1500))
    got = sharding.shard_documents(documents(spark, rows), 10).collect()
    assert len(got) == len(rows)
    check_shards(got, 10)
    sizes, counts, groups = Counter(), Counter(), defaultdict(set)
    for r in got:
        sizes[r["shard"]] += len(r["text"]) + 16
        counts[r["shard"]] += 1
        groups[r["text"]].add(r["shard"])
    assert max(sizes.values()) < 1.03 * min(sizes.values()) and max(counts.values()) < 1.1 * min(counts.values())
    assert len(groups.pop("the same text again")) > 3 and all(len(g) == 1 for g in groups.values())


def test_sharding_on_odd_rows(spark, odd, none):
    got = sharding.shard_documents(odd, 3).collect()
    assert len(got) == odd.count()
    check_shards(got, 3)
    assert sharding.shard_documents(none, 3).count() == 0


def test_slots_span_cells(spark):
    placed = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("shard"))
    check_shards(sharding.with_slots(placed, "shard", ("doc_id",), rows_per_cell=20).collect(), 3)


# --- mixing


def filled(sizes, weights, share, limit):
    """Targets by resharing until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = rest / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] >= limit * sizes[s]]
        if not full:
            return out | {s: level * weight[s] for s in free}
        for s in full:
            out[s] = limit * sizes[s]
            rest -= out[s]
            free.discard(s)
    return out


@pytest.mark.parametrize("cell", [400, 20_000])
def test_mix_meets_its_targets(spark, cell):
    random.seed(5)
    rows = []
    for i in range(2500):
        source = random.choice(["a"] * 8 + ["b", "c", "\u00e9", "z", None])
        rows.append((i, " ".join(["w"] * int(random.paretovariate(0.9) * 5 % 900)) if i % 97 else None, source))
    got = mixing.mix(documents(spark, rows), rows_per_cell=cell).collect()
    assert len(got) == len(rows)
    sizes, source_of = Counter(), {}
    for i, text, source in rows:
        sizes[source] += len((text or "").split())
        source_of[i] = source
    goals = filled(dict(sizes), (3, 1, 2), 1.5, 2)
    taken = Counter()
    for r in got:
        source = source_of[r["doc_id"]]
        assert r["target"] == pytest.approx(goals[source]) and r["source_size"] == sizes[source] and 0 <= r["copies"] <= 2
        taken[source] += r["copies"] * r["size"]
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= max(0.01 * goal, 12)
    again = mixing.mix(documents(spark, rows[::-1]), rows_per_cell=cell).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in again) == sorted((r["doc_id"], r["copies"]) for r in got)


def test_mixing_on_odd_rows(spark, odd, none):
    mixed = mixing.mix(odd)
    assert sum(r["times"] for r in mixed.collect()) == odd.count()
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns and out.count() > 0
    assert mixing.mixed_documents(none).count() == 0
    blank = documents(spark, [(1, "", "a"), (2, None, None)])
    assert [r["copies"] for r in mixing.mix(blank).collect()] in ([0, 0], [2, 2], [0, 2], [2, 0])


# --- WARC


def test_archives_round_trip(spark, tmp_path):
    random.seed(6)
    pages = [(i, f"http://x/{i}", random.choice(["same", "", None, f"page {i} \u00e9\r\n\r\nWARC/1.1\r\n" * random.randrange(1, 200)])) for i in range(300)]
    pages += [(None, None, "no id"), (7, "again", "same"), (400, "u\r\nv%", "x" * 3_000_000)]
    df = spark.createDataFrame([(*p, 1, "k") for p in pages], "page_id long, url string, html string, digest int, kind string")
    folder = f"file://{tmp_path}"
    archives = warc.write_archives(warc.as_records(df), folder, archive_bytes=1 << 20)
    names = [r["archive"] for r in archives.collect()]
    whole = b"".join(gzip.open(n.removeprefix("file://")).read() for n in names)
    index = warc.normalise(archives, folder)
    members = [r for r in index.collect()]
    assert len(members) == len(pages) and whole.count(b"WARC-Record-ID") == len(pages)
    got = warc.read_records(index).collect()
    newest = {}
    for i, _, html in pages:
        key = html or ""
        newest[key] = max(newest.get(key, -1), -1 if i is None else i)
    expected = Counter()
    for i, url, html in pages:
        body = (html or "").encode()
        revisit = newest[html or ""] != (-1 if i is None else i)
        expected[(i, url, "revisit" if revisit else "response", warc.digest32(body), len(body), newest[html or ""] if revisit else None, None if revisit else body)] += 1
    columns = ("page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to")
    assert Counter((*(r[c] for c in columns), r["payload"] and bytes(r["payload"]) if r["payload"] is not None else None) for r in got) == expected


def test_streams_are_cut_anywhere():
    records = [warc.record(i, "u", b"b\r\n\r\n" * i, "response", None) for i in range(9)]
    raw = b"".join(records)
    for step in (1, 7, 64, len(raw)):
        assert list(warc.cut_records(raw[i : i + step] for i in range(0, len(raw), step))) == records
    with pytest.raises(ValueError):
        list(warc.cut_records([raw[:-3]]))
    mixed = gzip.compress(raw) + b"".join(gzip.compress(r) for r in records)
    assert b"".join(warc.inflated(io.BytesIO(mixed))) == raw + raw
    assert zlib.decompress(b"".join(warc._deflated(records, 6)), 31) == raw


def test_archive_of_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    final = None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "sharding":
            assert out.columns == docs.columns
        rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        left = Counter(r["doc_id"] for r in out.collect())
        if name == "quality":
            model = quality.fit_on_sample(docs, spark.read.parquet(f"{SF}/labels.parquet"), "quality", F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(3)) != 1)
            good = quality.score_texts(docs, model).where("predicted = 1").select("doc_id").collect()
            assert left == Counter(r["doc_id"] for r in good)
        elif name == "near_dedup":
            assert left == Counter(i for i, _, c in linked_groups([r[:2] for r in rows], 5) if i == c)
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert left == Counter(i for i, n, hit, _ in brute_hits([r[:2] for r in rows], items, 13) if not (hit and 20 * hit >= n))
        elif name == "mixing":
            assert left == Counter({r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]})
        else:
            check_shards(out.collect(), 40)
            assert left == Counter(r[0] for r in rows)
        final = out
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert {"shard", "slot"} <= set(final.columns)


def test_whole_queries_keep_every_row(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    sharded = queries.op4_sharding(spark, SF).collect()
    check_shards(sharded, 40)
    assert len(sharded) == n and {r["law"] for r in sharded} == {"bytes"}
    texts = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in sharded)
    assert queries.op5_mixing(spark, SF).count() == n
    edits = queries.op10_simhash(spark, SF).collect()
    assert len(edits) == n and all(r["n_chars"] == len(texts[r["doc_id"]].decode()) for r in edits)
    assert sum(r["near_edited"] for r in edits) > sum(r["near_next"] for r in edits)
    assert len(hashlib.sha256(b"").hexdigest()) == len(edits[0]["edited_sha256"])
