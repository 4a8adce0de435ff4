"""Merkle manifest of a table: leaves by source, proofs by pointer jumping.

A row's leaf is the hash of its columns. The leaves of a source, by id, are the
lowest level of its tree; every `arity` consecutive nodes become the hash of
their digests, until one is left, the source's subroot. The subroots, by source,
are the lowest level of the top tree, which ends at the root.

Order. Leaves are dealt by ranges of (source, id, leaf), so that a source of any size is
spread; a leaf's place is its row in its range plus the source's rows in
the ranges before. Nothing gathers a source.

Proofs. A node's segment holds, for each level from it to an ancestor, its place in its run
and the run's other digests. At first the ancestor is the parent. Each round joins nodes
with their ancestors, puts the ancestor's segment behind the node's and takes the ancestor's
ancestor: distances double, so a tree of height h needs log2(h) rounds until
all segments end at the root. Leaves, 15 of 16 nodes, all have their run in common
with their siblings: they join in the last round, by their parent, so that no round
carries a segment for each of them. Levels and rounds are written to the shared
folder.

Checking is separate from building: `folded` hashes a leaf with its segment up to a root.

Cases. Null columns are `-` in a leaf; null ids and null sources come first, a null source is a
source of its own. Rows that share an id follow by their leaf; equal rows are a leaf each. A
single leaf is the root, with an empty proof. An empty table gives an empty result. Further
columns are hashed only if they are named. Long texts are hashed whole, each in its row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import lower_ascii, partitions, shared_dir, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
HEX = 64
#: The tree of the subroots; sources' trees are numbered from 0.
TOP = -1
SEGMENT = "array<struct<at:int,others:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for null, else the value's length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def ordered(rows: DataFrame, group: Sequence[str], order: Sequence[str], folder: str, name: str) -> DataFrame:
    """`rows`, stored, with `pos`: the place from 0 in its group by `order`, nulls first."""
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *group, *order).sortWithinPartitions(*group, *order)
    # Numbers ascend in a partition, and its number is in the upper bits.
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), folder, name)
    part = F.shiftright("_at", 33)
    counts = dealt.groupBy(part.alias("_part"), *group).agg(F.count("*").alias("_rows"), F.min("_at").alias("_least"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("_part", *group, "_least", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    firsts = firsts.select("_part", "_least", "_before", *[F.col(c).alias(f"_of_{c}") for c in group])
    same = part == F.col("_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    placed = dealt.join(firsts, same)
    return placed.select(*rows.columns, (F.col("_at") - F.col("_least") + F.col("_before")).alias("pos"))


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """The next level: each run of `arity` nodes with its digests, in order, and their hash."""
    run = F.sort_array(F.collect_list(F.struct("pos", "digest")))  # at most `arity`
    above = nodes.groupBy("tree", F.floor(F.col("pos") / arity).cast("long").alias("above")).agg(run.alias("run"), F.first("nodes").alias("below"))
    children = F.array_join(F.transform("run", lambda x: x["digest"]), "")
    made = above.select(
        "tree", F.col("above").alias("pos"), children.alias("children"), F.ceil(F.col("below") / arity).cast("long").alias("nodes")
    )
    return made.withColumn("digest", digest(F.col("children")))


def _levels(lowest: DataFrame, arity: int, folder: str) -> list[DataFrame]:
    """The levels above (tree, pos, digest, nodes), each stored: tree, level, pos, children, nodes, digest."""
    levels, nodes = [], lowest.where("nodes > 1")
    while not nodes.isEmpty():
        level = _runs(nodes, arity).withColumn("level", F.lit(len(levels) + 1))
        levels.append(stored(level.select("tree", "level", "pos", "children", "nodes", "digest"), folder, f"level-{len(levels) + 1}"))
        nodes = levels[-1].where("nodes > 1")
    return levels


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _hop(pos: Column, children: Column, arity: int) -> Column:
    """The segment from a node to its parent: its place in the run, and the others of the run."""
    at = F.pmod(pos, F.lit(arity)).cast("int")
    before, behind = F.substr(children, F.lit(1), at * HEX), F.substr(children, at * HEX + HEX + 1)
    return F.array(F.struct(at.alias("at"), F.concat(before, behind).alias("others")))


def folded(start: Column, segment: Column) -> Column:
    """The digest at the end of a segment, from the digest at its start."""

    def up(below: Column, hop: Column) -> Column:
        cut = hop["at"] * HEX
        return digest(F.substr(hop["others"], F.lit(1), cut), below, F.substr(hop["others"], cut + 1))

    return F.aggregate(segment, start, up)


def jumped(nodes: DataFrame, folder: str) -> DataFrame:
    """Nodes (id, anc, segment) with segments that end where no ancestor is left."""
    turn, above = 0, ("a_anc", "a_segment")
    while not nodes.where("anc is not null").isEmpty():
        turn += 1
        ancestors = nodes.select(F.col("id").alias("anc"), F.col("anc").alias(above[0]), F.col("segment").alias(above[1]))
        longer = F.concat("segment", F.coalesce(above[1], F.array().cast(SEGMENT)))
        nodes = nodes.join(ancestors, "anc", "left").select(
            *[c for c in nodes.columns if c not in ("anc", "segment")], F.col(above[0]).alias("anc"), longer.alias("segment")
        )
        nodes = stored(nodes, folder, f"jump-{turn}")
    return nodes


def proofs(
    docs: DataFrame, fields: Sequence[str] = FIELDS, doc_id: str = "doc_id", source: str = "source", arity: int = ARITY, carry: dict[str, Column] | None = None
) -> DataFrame:
    """Per row: doc_id, source, leaf, subroot, root, segment (its proof), and the columns in `carry`."""
    folder, carry = shared_dir(docs.sparkSession), carry or {}
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), leaf([F.col(c) for c in fields]).alias("leaf"), *[c.alias(k) for k, c in carry.items()]
    )
    placed = ordered(rows, ["source"], ["doc_id", "leaf"], folder, "dealt")
    sizes = placed.groupBy("source").agg(F.count("*").alias("nodes"))
    trees = ordered(sizes, [], ["source"], folder, "sources").select(F.col("source").alias("_source"), "nodes", F.col("pos").alias("tree"))
    trees = stored(trees, folder, "trees")
    leaves = stored(placed.join(trees, placed["source"].eqNullSafe(trees["_source"])).drop("_source"), folder, "leaves")

    lowest = leaves.select("tree", "pos", F.col("leaf").alias("digest"), "nodes")
    own = _levels(lowest, arity, f"{folder}/own")
    # The last node of each tree is a node of the top tree's lowest level.
    tops = _union([lowest.where("nodes = 1"), *[x.where("nodes = 1").select("tree", "pos", "digest", "nodes") for x in own]])
    tops = stored(tops.select("tree", F.col("digest").alias("subroot")), folder, "subroots")
    count = tops.count()
    top = tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("subroot").alias("digest"), F.lit(count).cast("long").alias("nodes"))
    higher = _levels(top, arity, f"{folder}/top")

    def name(tree: Column, level: Column, pos: Column) -> Column:
        return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))

    def parent(tree: Column, level: Column, pos: Column, nodes: Column) -> Column:
        """The name of a node's parent: a subroot's is in the top tree, the root has none."""
        inner = name(tree, level + 1, F.floor(pos / arity))
        outer = name(F.lit(TOP), F.lit(1), F.floor(tree / arity))
        return F.when(nodes > 1, inner).when((tree != TOP) & F.lit(count > 1), outer)

    if not own and not higher:  # no row, or a single one
        return leaves.select(
            "doc_id", "source", "leaf", F.col("leaf").alias("subroot"), F.col("leaf").alias("root"), F.array().cast(SEGMENT).alias("segment"), *carry
        )
    inner = _union([*own, *higher]).withColumn("id", name(F.col("tree"), F.col("level"), F.col("pos")))
    inner = inner.withColumn("anc", parent(F.col("tree"), F.col("level"), F.col("pos"), F.col("nodes")))
    # A subroot's place in its run is that of its source.
    place = F.when((F.col("nodes") == 1) & (F.col("tree") != TOP), F.col("tree")).otherwise(F.col("pos"))
    runs = inner.select(F.col("id").alias("anc"), F.col("children").alias("run"))
    first = inner.join(runs, "anc", "left").select(
        "id", "tree", "children", "anc", F.when(F.col("run").isNull(), F.array().cast(SEGMENT)).otherwise(_hop(place, F.col("run"), arity)).alias("segment")
    )
    nodes = jumped(stored(first, folder, "hops"), folder)
    # The last round, for the leaves.
    nodes = nodes.join(tops, "tree", "left").select(F.col("id").alias("anc"), "children", F.col("segment").alias("above"), F.col("subroot").alias("of_tree"))
    rows = leaves.withColumn("anc", parent(F.col("tree"), F.lit(0), F.col("pos"), F.col("nodes")))
    rows = rows.withColumn("place", F.when(F.col("nodes") == 1, F.col("tree")).otherwise(F.col("pos")))
    root = (higher[-1] if higher else own[-1]).where("nodes = 1").select("digest").scalar()
    return rows.join(nodes, "anc").select(
        "doc_id",
        "source",
        "leaf",
        F.when(F.col("nodes") == 1, F.col("leaf")).otherwise(F.col("of_tree")).alias("subroot"),
        root.alias("root"),
        F.concat(_hop(F.col("place"), F.col("children"), arity), "above").alias("segment"),
        *carry,
    )


def proof_digest(segment: Column) -> Column:
    """Hash of all siblings, level by level."""
    return F.sha2(F.array_join(F.transform(segment, lambda hop: hop["others"]), "").cast("binary"), 256)


def lowered(text: str = "text") -> Column:
    """The change that the check plays: A-Z of the text in lower case."""
    return lower_ascii(F.col(text))
