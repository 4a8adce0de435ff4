"""Merkle manifest against a plain tree."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from pricewatch.llm import manifest
from .conftest import documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return h(*[field(row[c]) for c in manifest.FIELDS])


def climb(digests, arity):
    """The top of a tree, and for each leaf the (place, other digests) of each level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, p in enumerate(at):
            run = digests[p // arity * arity :][:arity]
            paths[i].append((p % arity, run[: p % arity] + run[p % arity + 1 :]))
        at = [p // arity for p in at]
        digests = [h(*digests[i : i + arity]) for i in range(0, len(digests), arity)]
    return digests[0], paths


def plain(rows, arity):
    """(doc_id, leaf, subroot, root, segment) of every row."""
    by_source = defaultdict(list)
    for row in rows:
        by_source[row["source"]].append((row["doc_id"], leaf(row)))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        found = sorted(by_source[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((found, *climb([x[1] for x in found], arity)))
    if not trees:
        return []
    root, above = climb([t[1] for t in trees], arity)
    return [
        (doc_id, digest, subroot, root, path + above[i])
        for i, (found, subroot, paths) in enumerate(trees)
        for (doc_id, digest), path in zip(found, paths, strict=True)
    ]


def check(docs, arity):
    rows = docs.collect()
    proved = manifest.proofs(docs, arity=arity, carry={"changed": F.col("text")})
    proved = proved.withColumn("folded", manifest.folded(F.col("leaf"), F.col("segment")))
    proved = proved.withColumn("proof", manifest.proof_digest(F.col("segment")))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], str(x[4]))
    got = proved.collect()
    assert all(r["folded"] == r["root"] for r in got)
    found = [
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["at"], [s["others"][i : i + 64] for i in range(0, len(s["others"]), 64)]) for s in r["segment"]])
        for r in got
    ]
    wanted = plain(rows, arity)
    assert sorted(found, key=key) == sorted(wanted, key=key)
    assert sorted(r["proof"] for r in got) == sorted(h(*[d for _, others in w[4] for d in others]) for w in wanted)


def test_equal_to_a_plain_tree(spark):
    rows = [(i * 7 % 400, f"text {i}", f"s{min(i % 9, i % 5)}" if i % 11 else None) for i in range(400)]
    docs = documents(spark, rows).repartition(7)
    for arity in (2, 3, 16):
        check(docs, arity)


def test_sources_of_every_size_around_a_full_run(spark):
    sizes = [1, 2, 15, 16, 17, 33, 256, 257]
    check(documents(spark, [(i, f"{n} {i}", f"n{n}") for n in sizes for i in range(n)]), 16)


def test_many_sources_and_one_row_each(spark):
    check(documents(spark, [(i, "t", f"s{i:03d}") for i in range(40)]), 16)


def test_one_source(spark):
    check(documents(spark, [(i, "t") for i in range(20)]), 16)


def test_odd_rows_single_row_and_empty_table(spark, odd, none):
    check(odd, 16)
    check(odd, 2)
    check(documents(spark, [(None, None, None)]), 16)
    assert manifest.proofs(none).count() == 0


def test_a_changed_text_is_found(spark):
    docs = documents(spark, [(i, "Text" if i % 2 else "text", f"s{i % 3}") for i in range(60)])
    now = manifest.leaf([manifest.lowered() if c == "text" else F.col(c) for c in manifest.FIELDS])
    rows = manifest.proofs(docs, carry={"now": now}).select(
        "doc_id", "root", manifest.folded(F.col("now"), F.col("segment")).alias("folded")
    )
    assert all((r["folded"] == r["root"]) == (r["doc_id"] % 2 == 0) for r in rows.collect())
