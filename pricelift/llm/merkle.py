"""Merkle manifest of a table: a persistent, path-copying tree of aligned blocks, with a proof and a version per row.

Rows are numbered inside their group; 1024 consecutive ones make a block, a subtree of ten levels held in one task.
The roots of blocks are the leaves of the blocks above, level by level, until one node a group remains; those roots
are the leaves of one more such tree.  A changed leaf makes a version: new nodes for the leaf and its ancestors
in the block, every other node shared, and the version goes on along the siblings of its block in the levels above.
No node is ever changed, so versions of one tree do not see each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelift.llm.common import stored

#: Levels of a block; 2^10 leaves are under it.
LEVELS = 10

#: What a leaf is made of, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Digest of the values in order: each its bytes, a colon and itself, or a dash where it is null."""
    parts = []
    for column in columns.values():
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class PersistentTree:
    """A block: nodes that never change, known by number.  A root number is a version of the block."""

    def __init__(self, leaves: list[str], levels: int):
        self.digests, self.left, self.right = list(leaves), [-1] * len(leaves), [-1] * len(leaves)
        self.levels = levels
        row = list(range(len(leaves)))
        for _ in range(levels):
            row = [self._node(row[n], row[n + 1] if n + 1 < len(row) else -1) for n in range(0, len(row), 2)]
        (self.root,) = row

    def _node(self, left: int, right: int) -> int:
        """A new node over one or two others."""
        self.digests.append(digest(self.digests[left], self.digests[right]) if right >= 0 else digest(self.digests[left]))
        self.left.append(left)
        self.right.append(right)
        return len(self.digests) - 1

    def _path(self, at: int) -> list[tuple[int, bool]]:
        """The ancestors of a leaf, lowest first, and whether the way goes right there."""
        node, out = self.root, []
        for level in range(self.levels - 1, -1, -1):
            right = bool(at >> level & 1)
            out.append((node, right))
            node = self.right[node] if right else self.left[node]
        return out[::-1]

    def siblings(self, at: int) -> list[str]:
        """What stands beside the way up from a leaf: L or R and the digest, or a dash where nothing does."""
        out = []
        for node, right in self._path(at):
            other = self.left[node] if right else self.right[node]
            out.append("-" if other < 0 else ("L" if right else "R") + self.digests[other])
        return out

    def version(self, at: int, leaf: str) -> list[int]:
        """The nodes of a new version where one leaf differs: the leaf and copies of its ancestors, the new root last."""
        self.digests.append(leaf)
        self.left.append(-1)
        self.right.append(-1)
        made = [len(self.digests) - 1]
        for node, right in self._path(at):
            made.append(self._node(self.left[node], made[-1]) if right else self._node(made[-1], self.right[node]))
        return made


def climb(leaf: str, siblings: list[str]) -> list[str]:
    """The digests of the nodes from above a leaf to the root, given what stands beside the way."""
    out = []
    for other in siblings:
        leaf = digest(leaf) if other == "-" else digest(other[1:], leaf) if other[0] == "L" else digest(leaf, other[1:])
        out.append(leaf)
    return out


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with their place ``at`` among those of equal ``tree``, in the given order, and the height of that tree.

    Rows are dealt by ranges of the whole order, so a tree may lie in many tasks; each task counts on its own, and
    one figure a task and tree is summed up.  Equal rows are told apart by where they came from, so that they do not
    meet in one task either.
    """
    given = rows.columns
    fixed = stored(rows.withColumn("apart", F.monotonically_increasing_id()), name)
    keys = ["tree", *order, "apart"]
    dealt = fixed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*given)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, number, place = TaskContext.get().partitionId(), None, -1, 0
        at = given.index("tree")
        for batch in batches:
            numbers, places = [], []
            for tree in batch.column(at).to_pylist():
                if tree != last:
                    last, number, place = tree, number + 1, 0
                numbers.append(number)
                places.append(place)
                place += 1
            extra = [pa.array([part] * len(places), pa.int32()), pa.array(numbers, pa.int64()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*given, "part", "number", "place"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    counted = stored(dealt.mapInArrow(count, f"{fields}, part int, number long, place long"), name)
    sums = counted.groupBy("tree", "part", "number").agg(F.count("*").alias("n"))
    own = Window.partitionBy("tree")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(own)
    starts = sums.select(
        "part", "number", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.when(total > 1, F.length(F.bin(total - 1))).otherwise(0).alias("height"),
    )
    placed = counted.join(starts, ["part", "number"])
    return placed.select(*given, (F.col("start") + F.col("place")).alias("at"), F.col("height").cast("int").alias("height"))


BLOCK = "tree string, block long, height int, ids array<long>, leaves array<string>, changed array<string>, digest string"


def blocks(nodes: DataFrame, name: str, deep: int) -> DataFrame:
    """One row per aligned block of nodes (tree, at, height, id, digest, changed): its leaves in order, and its root."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        height = group["height"][0].as_py()
        leaves = group["digest"].to_pylist()
        tree = PersistentTree(leaves, min(deep, height))
        row = [group["tree"][0].as_py(), group["block"][0].as_py(), height, group["id"].to_pylist(), leaves, group["changed"].to_pylist(), tree.digests[tree.root]]
        types = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
        return pa.table([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=["tree", "block", "height", "ids", "leaves", "changed", "digest"])

    cut = nodes.withColumn("block", F.shiftright("at", deep))
    return stored(cut.groupBy("tree", "block").applyInArrow(build, BLOCK), name)


def grown(nodes: DataFrame, name: str, deep: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every level, lowest first, and (tree, digest) of the one node that remains of each tree."""
    levels, tops = [], []
    while True:
        level = blocks(nodes, name, deep)
        levels.append(level)
        tops.append(level.filter(F.col("height") <= deep).select("tree", "digest"))
        above = level.filter(F.col("height") > deep)
        if above.isEmpty():
            break
        nodes = above.select(
            "tree", F.col("block").alias("at"), (F.col("height") - deep).alias("height"), F.lit(None).cast("long").alias("id"), "digest",
            F.lit(None).cast("string").alias("changed"),
        )
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    return levels, roots


def below(levels: list[DataFrame], ways: DataFrame, name: str, deep: int) -> DataFrame:
    """The lowest blocks, each with the siblings on the way from its root up, and what else ``ways`` tells of its tree.

    ``ways``: tree, siblings of the root of the tree in what stands above it, and other columns.
    """
    rest = [c for c in ways.columns if c not in ("tree", "siblings")]

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = PersistentTree(row["leaves"], min(deep, row["height"]))
                first = row["block"] << deep
                out = [{"tree": row["tree"], "block": first + n, "siblings": tree.siblings(n) + row["siblings"], **{c: row[c] for c in rest}} for n in range(len(row["leaves"]))]
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("tree", pa.string()), ("block", pa.int64()), ("siblings", pa.list_(pa.string())), *((c, pa.string()) for c in rest)]))

    known = None
    for at in range(len(levels) - 1, -1, -1):
        top = levels[at].filter(F.col("height") <= deep).join(ways, "tree")
        joined = top if known is None else top.unionByName(levels[at].filter(F.col("height") > deep).join(known, ["tree", "block"]))
        if not at:
            return joined
        fields = ", ".join(f"{c} string" for c in rest)
        known = stored(joined.mapInArrow(down, f"tree string, block long, siblings array<string>{', ' + fields if fields else ''}"), name)
    raise ValueError("no levels")


PROVEN = "doc_id long, leaf string, subroot string, root string, proof array<string>, copied array<string>, folded_root string"


def manifest(docs: DataFrame, changes: dict[str, Column] | None = None, where: Column | None = None, deep: int = LEVELS) -> DataFrame:
    """A manifest row per document: leaf, root of its language, root of all, proof, and its version where it is changed.

    ``changes`` are other values of fields; where ``where`` holds, a version of the tree has that row's changed leaf.
    ``proof``: the siblings from leaf to root; ``copied``: the nodes of the version, the changed leaf first and
    the new root last, null without one; ``folded_root``: the root worked out from the changed, else the own, leaf.

    Nulls are leaves like any values: a null language is a group and comes first, null ids come first in their group.
    Rows of one id follow their leaf digests, so equal rows stand side by side.  A table of one row has its
    leaf for a root.  An empty table gives no rows.  Other columns are left out of it.
    """
    spark = docs.sparkSession
    own = {name: F.col(name) for name in FIELDS}
    rows = docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("id"),
        leaf_digest(own).alias("digest"),
        F.when(where if where is not None else F.lit(False), leaf_digest(own | (changes or {}))).alias("changed"),
    )
    levels, roots = grown(numbered(rows, ["id", "digest"], "merkle-leaves"), "merkle-blocks", deep)
    tops = roots.select(F.lit("").alias("tree"), F.lit(None).cast("long").alias("id"), "digest", F.col("tree").alias("changed"))
    # the languages are the leaves of one more tree; their names ride along where changed leaves do
    upper, whole = grown(numbered(tops, ["changed"], "merkle-languages"), "merkle-upper", deep)
    last = whole.first()
    if last is None:
        return spark.createDataFrame([], PROVEN)
    root = last["digest"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = PersistentTree(row["leaves"], min(deep, row["height"]))
                out = [{"tree": name, "subroot": row["leaves"][n], "siblings": tree.siblings(n) + row["siblings"]} for n, name in enumerate(row["changed"])]
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("tree", pa.string()), ("subroot", pa.string()), ("siblings", pa.list_(pa.string()))]))

    start = spark.createDataFrame([("", [])], "tree string, siblings array<string>")
    ways = stored(below(upper, start, "merkle-ways", deep).mapInArrow(spread, "tree string, subroot string, siblings array<string>"), "merkle-ways")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.string()) for c in ("leaf", "subroot", "root")] + [("proof", pa.list_(pa.string())), ("copied", pa.list_(pa.string())), ("folded_root", pa.string())])
        schema = schema.insert(0, pa.field("doc_id", pa.int64()))
        for batch in batches:
            for row in batch.to_pylist():
                tree = PersistentTree(row["leaves"], min(deep, row["height"]))
                out = []
                for n, (doc_id, leaf, changed) in enumerate(zip(row["ids"], row["leaves"], row["changed"], strict=True)):
                    inside, copied = tree.siblings(n), None
                    if changed is None:
                        folded = [leaf, *climb(leaf, inside + row["siblings"])][-1]
                    else:
                        copied = [tree.digests[v] for v in tree.version(n, changed)]
                        copied += climb(copied[-1], row["siblings"])
                        folded = copied[-1]
                    proof = [s[1:] for s in inside + row["siblings"] if s != "-"]
                    out.append({"doc_id": doc_id, "leaf": leaf, "subroot": row["subroot"], "root": root, "proof": proof, "copied": copied, "folded_root": folded})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return below(levels, ways, "merkle-ways", deep).mapInArrow(prove, PROVEN)


def tampered(doc_id: Column) -> Column:
    """Whether the checksum of the id in decimal is a multiple of seven."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0


def manifest_digests(docs: DataFrame, deep: int = LEVELS) -> DataFrame:
    """The manifest with one character more claimed in every seventh row, its proofs as digests, and whether they hold."""
    proven = manifest(docs, {"n_chars": F.try_add(F.col("n_chars").cast("long"), F.lit(1))}, tampered(F.col("doc_id")), deep)
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", "").cast("binary"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
