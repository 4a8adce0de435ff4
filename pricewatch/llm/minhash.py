"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures, confirmed on full sets.

Method. A document's set is its distinct word shingles. Sixty MinHash values,
cut to `bits` bits each, are its signature: ten chunks of six symbols. By
pigeonhole, two signatures that differ in at most 2*10-1 = 19 symbols have a chunk
that differs in at most one; so each chunk is looked up with each of its six
places left out, and every pair within that distance meets in at least one of
the sixty lookups. At a set similarity of exactly 0.8 the chance that all ten
chunks differ twice or more is 2e-5, and it falls fast above. No distance limit
is applied afterwards: every pair that meets is decided on its full sets.

Groups. Texts with equal sets are one vertex. A lookup value that many vertices
share is not expanded into pairs: each member is compared with one centre, the
member that meets the most others (in a group of edited copies the one least
edited). Members that are not linked to it choose further centres among
themselves. What may still hide a link, after these star rounds, are pairs of
different components one of which is not linked to the centre c. Such a pair
x, y has |x & y| <= min(|x & c|, |y & c|) + (shingles outside c which they share),
so it comes from a list: of those that hold one shingle outside c, among the rare ones of which a
link has to share one (a prefix filter), or, if the first term alone could do, of those of
one size. A list is treated like a lookup value: all its members meet one centre, whoever is in one
component by then is done, and of the rest only pairs are made whose overlap,
bounded by their sizes, their overlaps with c and the shingles behind the first
that they share, can reach the threshold. All of it is exact: no link is lost.

Cases. Null or empty texts: empty set, no link, a component of their own. A null
id has no component and is kept. Rows that share an id are documents of their own, told apart
by their text (`text_md5`). Very long texts: hashes are made text by text. Empty table: empty
result. Further columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import mix, shared_dir, shielded, shingle_hashes, small_batches, stored, WordHashes, words
from .components import connected_components

CHUNKS, WIDTH = 10, 6
STAR_ROUNDS = 3
LIST_ROUNDS = 1
_FACTS = ("b", "n", "in", "of", "on")


def _multipliers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of `n` hash functions."""
    made = np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, (2, n), dtype=np.int64).astype(np.uint64)
    return made[0] * np.uint64(2) + np.uint64(1), made[1]


def signature(hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray, bits: int = 8) -> np.ndarray:
    """The lowest `bits` bits of each MinHash value, as bytes' worth of symbols."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 4096):
            block = hashes[at : at + 4096, None] * factors + offsets
            block ^= block >> np.uint64(31)
            np.minimum(low, block.min(axis=0), out=low)
    return (mix(low) & np.uint64(2**bits - 1)).astype(np.uint8)


def shingles(text: bytes | None, n: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(known.of(words(text)), n))


def _signatures(shingle_words: int, seed: int):
    def run(batches):
        factors, offsets = _multipliers(CHUNKS * WIDTH, seed)
        known = WordHashes()
        for batch in batches:
            sizes, digests, marks, md5s = [], [], [], []
            for text in batch.column("text"):
                md5s.append(hashlib.md5(text.as_py() or b"").hexdigest())
                found = shingles(text.as_py(), shingle_words, known)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                marks.append(signature(found, factors, offsets).tobytes() if len(found) else None)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(md5s), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(marks, pa.binary())],
                names=["doc_id", "text_md5", "n_shingles", "digest", "signature"],
            )

    return run


def _sets(shingle_words: int):
    def run(batches):
        known = WordHashes()
        for batch in batches:
            found = [shingles(t.as_py(), shingle_words, known).tobytes() for t in batch.column("text")]
            yield pa.record_batch([batch.column("id"), pa.array(found, pa.binary())], names=["id", "shingles"])

    return run


def _confirm(threshold: int):
    """Of each pair: the sets' sizes, their overlap, and whether they are linked."""

    def run(batches):
        for batch in batches:
            n_a, n_b, both = [], [], []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                n_a.append(len(x))
                n_b.append(len(y))
                both.append(overlap(x, y))
            linked = [100 * k >= threshold * (p + q - k) for p, q, k in zip(n_a, n_b, both, strict=True)]
            yield pa.record_batch(
                [batch.column("a"), batch.column("b"), *[pa.array(v, pa.int64()) for v in (n_a, n_b, both)], pa.array(linked, pa.bool_())],
                names=["a", "b", "n_a", "n_b", "both", "linked"],
            )

    return run


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def _outside(batches):
    """Shingles of set_b that the centre's set_a lacks."""
    for batch in batches:
        extra = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            extra.append(np.setdiff1d(y, x, assume_unique=True).view(np.int64))
        yield pa.record_batch(
            [batch.column("a"), batch.column("b"), pa.array(extra, pa.list_(pa.int64()))], names=["a", "b", "extra"]
        )


def lookups(mark: Column) -> Column:
    """Sixty lookup values: each chunk with each of its places left out."""
    keys = []
    for chunk in range(CHUNKS):
        for gap in range(WIDTH):
            start = chunk * WIDTH + 1
            before, after = F.substring(mark, start, gap), F.substring(mark, start + gap + 1, WIDTH - 1 - gap)
            keys.append(F.xxhash64(F.lit(chunk * WIDTH + gap), before, after))
    return F.array(*keys)


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The centre's set first: its key is the frequent one, and rows are still narrow there."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 2,
    threshold: int = 80,
    doc_id: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id reachable), kept (it is that id), text_md5 (null text: of none)."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = shared_dir(spark)
    confirmed_schema = "a long, b long, n_a long, n_b long, both long, linked boolean"
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    marks = stored(
        source.mapInArrow(_signatures(shingle_words, seed), "doc_id long, text_md5 string, n_shingles long, digest binary, signature binary"),
        folder,
        "marks",
    )
    named = marks.where("digest is not null and doc_id is not null")
    classes = stored(
        named.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature")), folder, "classes"
    )
    keys = classes.select("id", F.explode(lookups(F.col("signature"))).alias("key"))
    common = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = stored(keys.join(common, "key"), folder, "met")
    popular = met.groupBy("id").agg(F.sum("members").alias("meets"))
    members = stored(met.join(popular, "id").select("key", "id", "meets"), folder, "members")

    # Full sets, only of the documents that meet another.
    wanted = popular.select("id")
    texts = source.join(wanted, source["doc_id"] == wanted["id"]).select("id", "text")
    sets = stored(texts.mapInArrow(_sets(shingle_words), "id long, shingles binary"), folder, "sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        checked = _with_sets(pairs, sets).mapInArrow(_confirm(threshold), confirmed_schema)
        return stored(checked, folder, name)

    def centres(frame: DataFrame) -> DataFrame:
        best = F.max_by("id", F.struct("meets", -F.col("id")))
        return frame.groupBy("key").agg(best.alias("centre"))

    def star(frame: DataFrame) -> DataFrame:
        """(a, b): the centre of a lookup value and each other member, once."""
        pairs = frame.join(centres(frame), "key").where("id != centre")
        return pairs.select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()

    first = confirmed(star(members), "star-0")
    links = first.where("linked").select("a", "b")
    groups = connected_components(links, f"{folder}/groups-0")
    open_members = members
    for turn in range(1, STAR_ROUNDS):
        labelled = open_members.join(groups, "id", "left").select(
            "key", "id", "meets", F.coalesce("component", "id").alias("component")
        )
        heads = centres(open_members).join(groups, F.col("centre") == groups["id"], "left").select(
            "key", F.coalesce("component", "centre").alias("head")
        )
        open_members = stored(labelled.join(heads, "key").where("component != head").select("key", "id", "meets"), folder, f"open-{turn}")
        pairs = star(open_members).join(groups.select(F.col("id").alias("a"), F.col("component").alias("of_a")), "a", "left")
        pairs = pairs.join(groups.select(F.col("id").alias("b"), F.col("component").alias("of_b")), "b", "left")
        apart = F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
        found = confirmed(pairs.where(apart), f"star-{turn}").where("linked").select("a", "b")
        links = links.union(found)
        groups = connected_components(links, f"{folder}/groups-{turn}")

    links = links.union(_hidden_links(first, groups, sets, threshold, folder, confirmed))
    groups = connected_components(links, f"{folder}/groups")

    ids = classes.select("digest", "id").join(groups, "id", "left")
    ids = ids.select("digest", F.coalesce("component", "id").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    out = marks.join(ids, "digest", "left").select("doc_id", "n_shingles", component, "text_md5")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "n_shingles", "component_id", "kept", "text_md5")


def _hidden_links(first: DataFrame, groups: DataFrame, sets: DataFrame, threshold: int, folder: str, confirmed) -> DataFrame:
    """Links (a, b) between members that met, lie in different components, and are not both linked to the centre.

    All members of a lookup value were compared with its centre `a` in `first`,
    which holds their overlap with it. `confirmed` compares pairs on their full sets and stores them.
    """
    component = groups.select(F.col("id").alias("b"), "component")
    seen = first.join(component, "b", "left").select("a", "b", "n_a", "n_b", "both", "linked", F.coalesce("component", "b").alias("component"))
    # Groups of more than one component that hold somebody not linked to the centre.
    mixed = seen.groupBy("a").agg(F.max(~F.col("linked")).alias("apart"), F.count("*").alias("size")).where("apart and size > 1")
    seen = stored(seen.join(mixed.select("a"), "a"), folder, "mixed")
    outside = _with_sets(seen, sets).mapInArrow(_outside, "a long, b long, extra array<long>")
    extra = stored(outside.select("a", "b", F.explode("extra").alias("shingle")).distinct(), folder, "extra")
    facts = seen.select("a", "b", F.col("n_b").alias("n"), F.col("both").alias("in"), F.col("component").alias("of"), F.col("linked").alias("on"))
    lists = {
        "shared": stored(_shingle_lists(extra, facts, threshold), folder, "shared"),
        "sizes": stored(_size_lists(facts, threshold), folder, "sizes"),
    }
    links = []
    for turn in range(LIST_ROUNDS):
        # Each list is a lookup value of its own: all meet one centre, and whoever is in one component by then has met.
        stars = _centre_pairs(lists["shared"], threshold).union(_centre_pairs(lists["sizes"], threshold))
        links.append(confirmed(stars.distinct(), f"list-{turn}").where("linked").select("a", "b"))
        spanning = groups.where("id != component").select(F.col("component").alias("a"), F.col("id").alias("b"))
        groups = connected_components(spanning.union(links[-1]), f"{folder}/list-groups-{turn}")
        lists = {name: _open_lists(rows, groups, folder, f"{name}-{turn}") for name, rows in lists.items()}
    rest = _list_pairs(lists["shared"], threshold).union(_list_pairs(lists["sizes"], threshold)).distinct()
    links.append(confirmed(rest, "hidden").where("linked").select("a", "b"))
    return reduce(DataFrame.union, links)


def _shingle_lists(extra: DataFrame, facts: DataFrame, threshold: int) -> DataFrame:
    """Who holds which shingle outside the centre: (a, key, b, ...), of each member only the rare ones that a link has to share.

    A link of b takes at least threshold % of b's shingles, so at least `least` from outside the centre. Ordered from
    the rarest in the group, b and its partner must meet within all but the last least - 1 of those b shares with anyone.
    `more` is how many they can share from this one on, which is all they share if it is their first.
    """
    often = extra.groupBy("a", "shingle").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = extra.join(often, ["a", "shingle"]).join(facts, ["a", "b"])
    least = F.ceil(threshold * F.col("n") / 100) - F.col("in")
    member = Window.partitionBy("a", "b")
    rank = F.row_number().over(member.orderBy("holders", "shingle"))
    shared = shared.withColumn("rank", rank).withColumn("more", F.count("*").over(member) - F.col("rank") + 1)
    kept = shared.where(F.col("more") >= least)
    return kept.select("a", F.col("shingle").alias("key"), *_FACTS, F.lit(True).alias("own"), (~F.col("on")).alias("looks"), "more")


def _size_lists(facts: DataFrame, threshold: int) -> DataFrame:
    """Who may be linked by what lies inside the centre alone: (a, key, b, ...) by classes of size of about two per cent.

    A member off the centre looks into the few classes whose sizes can do.
    """
    size_class = lambda n: F.floor(F.log(n.cast("double")) * 50).cast("long")
    need = F.greatest(F.ceil(F.col("n") * threshold / 100.0), F.lit(1))
    most = F.floor((100 + threshold) * F.col("in") / threshold - F.col("n"))
    lookers = facts.where("not on").withColumns({"low": need, "high": most}).where("high >= low")
    lookers = lookers.withColumn("key", F.explode(F.sequence(size_class(F.col("low")), size_class(F.col("high")))))
    looks = lookers.select("a", "key", *_FACTS, F.lit(False).alias("own"), F.lit(True).alias("looks"))
    wanted = looks.select("a", "key").distinct()
    own = facts.withColumn("key", size_class(F.col("n"))).join(wanted, ["a", "key"], "left_semi")
    both = looks.unionByName(own.select("a", "key", *_FACTS, F.lit(True).alias("own"), F.lit(False).alias("looks")))
    both = both.groupBy("a", "key", *_FACTS).agg(F.max("own").alias("own"), F.max("looks").alias("looks"))
    return both.withColumn("more", F.lit(0).cast("long"))


def _open_lists(rows: DataFrame, groups: DataFrame, folder: str, name: str) -> DataFrame:
    """Lists whose members are in several components by now."""
    now = groups.select(F.col("id").alias("b"), F.col("component").alias("now"))
    rows = stored(rows.join(now, "b", "left").withColumn("of", F.coalesce("now", "of")).select(*rows.columns), folder, name)
    several = rows.groupBy("a", "key").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low != high")
    return rows.join(several.select("a", "key"), ["a", "key"])


def _may_link(threshold: int) -> Column:
    """x looks for y, they lie apart, and what they can share inside the centre and outside it suffices."""
    most = F.least("x.in", "y.in") + F.least("x.more", "y.more")
    enough = 100 * most >= threshold * (F.col("x.n") + F.col("y.n") - most)
    return F.col("x.looks") & F.col("y.own") & (F.col("x.of") != F.col("y.of")) & enough


def _centre_pairs(lists: DataFrame, threshold: int) -> DataFrame:
    """(a, b): the centre of each list, and every member that may be linked to it."""
    best = F.max_by(F.struct(*_FACTS, "own", "looks", "more"), F.struct("own", "in", -F.col("b")))
    heads = lists.groupBy("a", "key").agg(best.alias("head")).select("a", "key", "head.*")
    same = (F.col("x.a") == F.col("y.a")) & (F.col("x.key") == F.col("y.key"))
    towards = lists.alias("x").join(heads.alias("y"), same & _may_link(threshold))
    away = heads.alias("x").join(lists.alias("y"), same & _may_link(threshold))
    return towards.union(away).select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b"))


def _list_pairs(lists: DataFrame, threshold: int) -> DataFrame:
    """(a, b): all members of a list that may be linked, each pair once."""
    same = (F.col("x.a") == F.col("y.a")) & (F.col("x.key") == F.col("y.key"))
    # Two that look for each other would come in both orders.
    once = ~(F.col("y.looks") & F.col("x.own")) | (F.col("x.b") < F.col("y.b"))
    pairs = lists.alias("x").join(lists.alias("y"), same & once & _may_link(threshold))
    return pairs.select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")).distinct()


@shielded
def deduplicated(docs: DataFrame, shingle_words: int = 5, threshold: int = 80, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that represent their group: of each the smallest id, and of rows equal in id and text one.

    Decisions are joined back by id and text, so where texts share an id each is decided by itself. A null id is in no group and stays.
    """
    found = near_duplicates(docs, shingle_words, threshold, doc_id, text_col)
    found = stored(found, shared_dir(docs.sparkSession), "found")
    text_md5 = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    rows = docs.withColumn("_md5", text_md5)
    key = lambda df: df.select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_of"))
    same = rows[doc_id].eqNullSafe(F.col("_id")) & (F.col("_md5") == F.col("_of"))
    rows = rows.join(key(found.where("kept")), same, "left_semi")
    # Ids are unique as a rule: then this is all.
    repeated = found.where("kept and doc_id is not null").groupBy("doc_id", "text_md5").count().where("count > 1")
    if not repeated.isEmpty():
        once = rows.join(key(repeated), rows[doc_id].eqNullSafe(F.col("_id")) & (F.col("_md5") == F.col("_of")), "left_anti")
        again = rows.join(key(repeated), rows[doc_id].eqNullSafe(F.col("_id")) & (F.col("_md5") == F.col("_of")), "left_semi")
        rows = once.unionByName(again.dropDuplicates([doc_id, "_md5"]))
    return rows.select(*docs.columns)
