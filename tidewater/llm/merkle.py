"""Merkle dataset manifest: a hash tree over the rows, proofs of single rows, and folding.

Leaves are SHA-256 digests of rows. They are ordered in each group (language) by id, and
every ``FANOUT`` consecutive nodes become their parent until one is left, the group's
subroot; subroots, ordered by group, make the root the same way. A node is the digest of
its children's hexadecimal texts, one SHA block each.

The tree is built in tiers of ``LEVELS`` levels. A tier deals its nodes into aligned
subtrees of ``FANOUT ** LEVELS`` nodes, one Spark group each however large the language,
whose tops are the next tier's nodes; 4,096 rows become one, so three tiers hold 6.8e10
rows. Places come from a range partition and counts per partition, never from a window
over a group. Going down, each subtree gets the path above it, at most ``FANOUT - 1``
siblings a level. Parents retain a copy of the hash state before each child slot; a proof
is folded by resuming the state of its slot with the replacement and the siblings on its
right, so siblings on the left are hashed once for all rows of a parent.

Defined results: nulls are ``-`` in a leaf, and a null group is a group of its own before
all others; rows of equal id are ordered by leaf, with null ids first, and repeated rows
are leaves of their own; a lone leaf is its subroot, a lone subroot the root, and a proof
without siblings the digest of nothing. An empty table has no rows and no root. Texts of
any length are hashed in place and not moved. Columns of other names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import LOWER, UPPER, shuffle_partitions, written

FANOUT = 8
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROOT_TREE = "^"  # the tree of the subroots; groups are "" (null) or "=" and their value

NODE = "tree string, idx long, total long, digest string"
PATH = "tree string, idx long, left array<string>, right array<string>, subroot string, root string"


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field ``-`` if null, else its UTF-8 byte count, ``:`` and value."""
    def spelt(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*map(spelt, fields)), 256)


def levels(total: int) -> int:
    """Levels from ``total`` nodes to one."""
    n = 0
    while total > 1:
        total, n = -(-total // FANOUT), n + 1
    return n


class Parents:
    """The parents of a run of aligned nodes, with the hash state before each child slot."""

    def __init__(self, nodes: list[str]):
        self.nodes = nodes
        self.states: list[list] = []
        self.digests: list[str] = []
        for at in range(0, len(nodes), FANOUT):
            state, before = hashlib.sha256(), []
            for child in nodes[at:at + FANOUT]:
                before.append(state.copy())
                state.update(child.encode())
            self.states.append(before)
            self.digests.append(state.hexdigest())

    def siblings(self, at: int) -> tuple[str, str]:
        """Texts of the siblings left and right of a node."""
        first = at - at % FANOUT
        return "".join(self.nodes[first:at]), "".join(self.nodes[at + 1:first + FANOUT])

    def fold(self, at: int, digest: str) -> str:
        """The parent's digest with ``digest`` in a node's place."""
        state = self.states[at // FANOUT][at % FANOUT].copy()
        state.update((digest + self.siblings(at)[1]).encode())
        return state.hexdigest()


def subtree(nodes: list[str], total: int, height: int) -> list[Parents]:
    """The levels of one aligned subtree of a tree of ``total`` nodes, lowest first."""
    out = []
    for _ in range(min(height, levels(total))):
        out.append(Parents(out[-1].digests if out else nodes))
    return out


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with ``tree``) plus ``idx``, their place in their tree by ``order``, and ``total``.

    Rows are range-partitioned, so that equal trees lie in neighbouring partitions and a
    large tree in many; each partition numbers its own rows, and counts per (tree,
    partition) give the offsets. The row number breaks ties, so copies spread too.
    """
    keys = ["tree", *order, "_row"]
    tagged = rows.withColumn("_row", F.monotonically_increasing_id())
    spread = tagged.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    width = len(spread.columns) - 1

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, tree, at = TaskContext.get().partitionId(), None, 0
        for b in batches:
            local = []
            for t in b.column("tree").to_pylist():
                at = at + 1 if t == tree else 0
                tree = t
                local.append(at)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(width)), pa.array([part] * b.num_rows, pa.int32()),
                 pa.array(local, pa.int64())], [*b.schema.names[:width], "part", "local"])

    schema = rows.schema.add("part", "integer").add("local", "long")
    numbered = written(spread.mapInArrow(number, schema), name)
    counts = numbered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    by_tree = Window.partitionBy("tree")
    offsets = counts.select("tree", "part", F.coalesce(F.sum("n").over(
        by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(by_tree).alias("total"))
    return (numbered.join(offsets, ["tree", "part"])
            .select(*rows.columns, (F.col("before") + F.col("local")).alias("idx"), "total"))


def blocks(nodes: DataFrame, height: int) -> DataFrame:
    """``nodes`` plus ``block``, the number of their subtree."""
    return nodes.withColumn("block", F.floor(F.col("idx") / FANOUT ** height))


def tops(nodes: DataFrame, height: int) -> DataFrame:
    """The next tier: one node for every subtree of ``nodes``."""
    span = FANOUT ** height

    def top(group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        total = group["total"][0].as_py()
        built = subtree(group["digest"].to_pylist(), total, height)
        return pa.table({"tree": group["tree"][:1], "idx": pa.array([group["idx"][0].as_py() // span], pa.int64()),
                         "total": pa.array([-(-total // span)], pa.int64()),
                         "digest": [built[-1].digests[0] if built else group["digest"][0].as_py()]})

    return blocks(nodes, height).groupBy("tree", "block").applyInArrow(top, NODE)


def tiers(nodes: DataFrame, name: str, height: int) -> list[DataFrame]:
    """``nodes`` and the tiers above them, written, until every tree has one node."""
    out = [nodes]
    while (out[-1].agg(F.max("total")).first()[0] or 0) > 1:
        out.append(written(tops(out[-1], height), f"{name}-{len(out)}"))
    return out


def paths_down(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """(tree, idx, left, right, subroot, root) of ``nodes``, given those of their subtrees' tops."""
    def path(key: tuple[pa.Scalar, ...], members: pa.Table, upper: pa.Table) -> pa.Table:
        members, up = members.sort_by("idx"), upper.to_pylist()[0]
        built = subtree(members["digest"].to_pylist(), members["total"][0].as_py(), height)
        places = members["idx"].to_pylist()
        rows = {"left": [], "right": []}
        for i in places:
            at, sides = i % FANOUT ** height, []
            for parents in built:
                sides.append(parents.siblings(at))
                at //= FANOUT
            rows["left"].append([a for a, _ in sides] + up["left"])
            rows["right"].append([b for _, b in sides] + up["right"])
        n = len(places)
        return pa.table({"tree": members["tree"], "idx": members["idx"], **{
            k: pa.array(v, pa.list_(pa.string())) for k, v in rows.items()},
            "subroot": [up["subroot"]] * n, "root": [up["root"]] * n})

    return (blocks(nodes.select("tree", "idx", "total", "digest"), height).groupBy("tree", "block")
            .cogroup(above.withColumn("block", F.col("idx")).groupBy("tree", "block")).applyInArrow(path, PATH))


def _proofs(leaves: DataFrame, above: DataFrame, doc_id: str, height: int) -> DataFrame:
    """Proof and folded root of every leaf, its subtree's path given."""
    def prove(key: tuple[pa.Scalar, ...], members: pa.Table, upper: pa.Table) -> pa.Table:
        members, up = members.sort_by("idx"), upper.to_pylist()[0]
        leaf_texts = members["digest"].to_pylist()
        built = subtree(leaf_texts, members["total"][0].as_py(), height)
        rest = "".join(a + b for a, b in zip(up["left"], up["right"])).encode()
        higher = []
        for left, right in zip(up["left"], up["right"]):
            higher.append((hashlib.sha256(left.encode()), right))
        proofs, folded = [], []
        for i, digest in zip(members["idx"].to_pylist(), members["given"].to_pylist()):
            at, proof = i % FANOUT ** height, hashlib.sha256()
            for parents in built:
                digest = parents.fold(at, digest)
                proof.update("".join(parents.siblings(at)).encode())
                at //= FANOUT
            for state, right in higher:
                resumed = state.copy()
                resumed.update((digest + right).encode())
                digest = resumed.hexdigest()
            proof.update(rest)
            proofs.append(proof.hexdigest())
            folded.append(digest)
        n = members.num_rows
        return pa.table({"id": members["id"], "leaf": members["digest"], "subroot": [up["subroot"]] * n,
                         "root": [up["root"]] * n, "proof_sha256": proofs, "folded_root": folded,
                         "verified": [f == up["root"] for f in folded], "idx": members["idx"]})

    kind = leaves.schema["id"].dataType.simpleString()
    return (blocks(leaves, height).groupBy("tree", "block")
            .cogroup(above.withColumn("block", F.col("idx")).groupBy("tree", "block"))
            .applyInArrow(prove, f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                                 "folded_root string, verified boolean, idx long")
            .withColumnRenamed("id", doc_id))


def manifest(docs: DataFrame, given: Column | None = None, fields: tuple[str, ...] = FIELDS,
             group: str = "lang", doc_id: str = "doc_id", height: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, idx), one row per document.

    ``given`` is the leaf that a holder of the row presents (:func:`leaf` of its fields;
    null or none: the true one); it is folded with the row's own siblings. A tier has
    ``height`` levels.
    """
    true = leaf(*(F.col(f) for f in fields))
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.col(doc_id).alias("id"), true.alias("digest"),
        (true if given is None else F.coalesce(given, true)).alias("given"))
    leaves = written(placed(written(rows, "leaves"), ["id", "digest"], "leaves-numbered"), "leaves-placed")
    below = tiers(leaves.select("tree", "idx", "total", "digest"), "tier", height)
    # the subroots are few rows unless there are many groups; they make a tree of their own
    subroots = below[-1].select(F.lit(ROOT_TREE).alias("tree"), F.col("tree").alias("group"), "digest")
    numbered = written(placed(subroots, ["group"], "subroots-numbered"), "subroots")
    top = tiers(numbered.select("tree", "idx", "total", "digest"), "root", height)
    none = F.array().cast("array<string>")
    paths = top[-1].select("tree", "idx", none.alias("left"), none.alias("right"),
                           F.lit("").alias("subroot"), F.col("digest").alias("root"))
    for i in range(len(top) - 2, -1, -1):
        paths = paths_down(top[i], paths, height)
    above = numbered.select("idx", "group", "digest").join(paths.drop("tree", "subroot"), "idx").select(
        F.col("group").alias("tree"), F.lit(0).cast("long").alias("idx"), "left", "right",
        F.col("digest").alias("subroot"), "root")
    for i in range(len(below) - 2, 0, -1):
        above = paths_down(below[i], above, height)
    return _proofs(leaves, written(above, "paths"), doc_id, height)


def lowered(text: Column) -> Column:
    """A text with A-Z lower-cased, as a careless tool would leave it."""
    return F.translate(text, UPPER, LOWER)
