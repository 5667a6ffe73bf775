"""A Merkle manifest of a table: a digest for each row, a tree for each group, one root, and a proof for each row.

The tree is built by DataFrame levels. Leaves are numbered in order; a node's
number divided by ``fanout`` is its parent's; the children of a parent are one
sorted array, and the digest of their digests is the parent's. A level that
would leave one node of a group is its last: that node is the group's subroot.
Subroots, in order of their group, form one more tree, and its top is the root.

Proofs come from the top: each level joins the paths of the parents to their
child arrays and appends to each child's path the digests of its siblings, from
left to right. So a level moves as many rows as it has parents, and all levels
together about as many as there are leaves. A path is the plain sequence of
32-byte digests: which of them stand left or right of the node, and on which
levels there are none, follows from the leaf's number and the number of leaves,
which is all that ``folded`` needs beside it.

Cases: null values of a leaf have a mark of their own; a null group is a group,
the first; null ids come first; rows with the same id go by their digest; rows
that repeat are leaves of their own; a group of one leaf has that leaf as its
subroot; an empty table gives an empty table; other columns are ignored.

How it scales
-------------
Texts are read once, for the leaves. No group of rows is larger than ``fanout``
but for the sort by ranges, in which a large group is spread over many tasks.
Every level is written, so a lost executor costs one level at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.llm._shared import stored
from tidalbook.llm.ordering import checked, numbered

FANOUT = 2
#: What a leaf is the digest of, in this order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(values: Sequence[Column]) -> Column:
    """The digest of values: each ``-`` if null, else its length in bytes, ``:`` and itself."""
    text = [v.cast("string") for v in values]
    told = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in text]
    return F.unhex(F.sha2(F.concat(*told), 256))


def _up(n: Column, fanout: int) -> Column:
    return F.call_function("div", n + F.lit(fanout - 1), F.lit(fanout).cast("bigint"))


def _climb(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """(runs of each level, tops) of trees of nodes (tree, n, idx, digest, ...), n the tree's nodes.

    A run is a parent: (tree, n, idx, run, digest), run its children by number.
    A top is (tree, digest, level): what is left of a tree, and after how many levels.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, at = [], nodes
    tops = nodes.where("n = 1").select("tree", "digest", F.lit(0).alias("level"))
    while most > 1:
        child = F.struct("idx", *[c for c in at.columns if c not in ("tree", "n", "idx")])
        runs = at.where("n > 1").groupBy("tree", "n", F.expr(f"idx div {fanout}").alias("parent")).agg(F.sort_array(F.collect_list(child)).alias("run"))
        told = F.array_join(F.transform("run", lambda c: _hex(c["digest"])), "")
        runs = stored(runs.select("tree", _up(F.col("n"), fanout).alias("n"), F.col("parent").alias("idx"), "run", F.unhex(F.sha2(told, 256)).alias("digest")), f"merkle-level{len(levels)}")
        levels.append(runs)
        at = runs.select("tree", "n", "idx", "digest")
        tops = tops.unionByName(at.where("n = 1").select("tree", "digest", F.lit(len(levels)).alias("level")))
        most = -(-most // fanout)
    return levels, stored(tops, "merkle-tops")


def _descend(levels: list[DataFrame], starts: DataFrame, fanout: int) -> DataFrame:
    """(tree, idx, path, carried columns of the leaves) of all leaves that have a parent.

    starts is (tree, level, path): the path that begins at a tree's top.
    """
    top = lambda k: starts.where(F.col("level") == k).select("tree", F.lit(0).cast("bigint").alias("idx"), "path")
    at = None
    for k in range(len(levels), 0, -1):
        paths = top(k) if at is None else at.unionByName(top(k))
        own = paths.select(F.col("tree").alias("of_tree"), F.col("idx").alias("of_idx"), "path")
        joined = levels[k - 1].join(own, (F.col("tree") == F.col("of_tree")) & (F.col("idx") == F.col("of_idx")))
        each = joined.select("tree", "run", F.explode("run").alias("child"), "path")
        siblings = F.unhex(F.array_join(F.transform(F.filter("run", lambda c: c["idx"] != F.col("child.idx")), lambda c: F.hex(c["digest"])), ""))
        kept = [f for f in levels[k - 1].schema["run"].dataType.elementType.names if f not in ("idx", "digest")]
        found = each.select("tree", F.col("child.idx").alias("idx"), F.col("child.digest").alias("digest"), F.concat(siblings, F.col("path")).alias("path"), *[F.col(f"child.{c}").alias(c) for c in kept])
        at = found if k == 1 else stored(found.select("tree", "idx", "path"), f"merkle-paths{k}")
    return at


def folded(leaf: Column, path: Column, levels: int, at: Column, trees: Sequence[tuple[Column, Column]], fanout: int = FANOUT) -> Column:
    """The root (hex) that a leaf (hex) and the siblings in ``path`` lead to.

    trees gives, from the lowest to the highest, the node's number and the
    number of nodes; levels is at least the most levels of any of them.
    """
    f = F.lit(fanout).cast("bigint")
    state = F.struct(leaf.alias("cur"), F.lit(0).cast("bigint").alias("idx"), F.lit(1).cast("bigint").alias("n"), at.cast("int").alias("at"))

    def step(s: Column, _: Column) -> Column:
        left = s["idx"] % f
        right = F.least(f, s["n"] - s["idx"] + left) - left - 1
        cut = lambda start, count: _hex(F.substring(path, start.cast("int"), (count * DIGEST).cast("int")))
        up = F.struct(
            F.sha2(F.concat(cut(s["at"], left), s["cur"], cut(s["at"] + left * DIGEST, right)), 256).alias("cur"),
            F.call_function("div", s["idx"], f).alias("idx"),
            _up(s["n"], fanout).alias("n"),
            (s["at"] + (left + right) * DIGEST).cast("int").alias("at"),
        )
        return F.when(s["n"] > 1, up).otherwise(s)

    for idx, n in trees:
        start = F.struct(state["cur"].alias("cur"), idx.cast("bigint").alias("idx"), n.cast("bigint").alias("n"), state["at"].alias("at"))
        state = F.aggregate(F.sequence(F.lit(1), F.lit(max(levels, 1))), start, step)
    return state["cur"]


def manifest(docs: DataFrame, changed: Column | None = None, group: str = "lang", fanout: int = FANOUT) -> tuple[DataFrame, int]:
    """(doc_id, leaf, subroot, root, path, idx, n, group_idx, n_groups, other_leaf) for each row, and the most levels that a tree has.

    Digests are binary but for subroot and root (hex). path holds the siblings
    from the leaf to the root. other_leaf is the digest of the row with the
    value ``changed`` instead of n_chars (the leaf itself without one).
    """
    values = {c: F.col(c) for c in LEAF}
    other = leaf_digest(list({**values, "n_chars": values["n_chars"] if changed is None else changed}.values()))
    tree = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("-"))  # a null group has the smaller mark, so it comes first
    leaves = docs.select("doc_id", tree.alias("tree"), leaf_digest(list(values.values())).alias("digest"), *([] if changed is None else [other.alias("other")]))
    leaves = numbered(stored(leaves, "merkle-leaves"), ["tree"], ["doc_id", "digest"], "idx")
    leaves = stored(leaves, "merkle-numbered")
    sizes = stored(leaves.groupBy("tree").agg(F.count("*").alias("n")), "merkle-sizes").withColumnRenamed("tree", "of_tree")
    nodes = leaves.join(checked(sizes), F.col("tree") == F.col("of_tree")).drop("of_tree")
    levels, tops = _climb(nodes, fanout)

    groups = numbered(tops.select(F.col("tree").alias("name"), "digest"), [], ["name"], "idx")
    groups = stored(groups.select(F.lit("").alias("tree"), F.lit(tops.count()).cast("bigint").alias("n"), "idx", "digest", "name"), "merkle-groups")
    upper, peak = _climb(groups, fanout)
    root = peak.first()
    ends = _descend(upper, peak.select("tree", "level", F.lit(b"").alias("path")), fanout) if upper else groups.withColumn("path", F.lit(b""))
    group_of = ends.select(F.col("name").alias("of_tree"), _hex(F.col("digest")).alias("subroot"), F.col("idx").alias("group_idx"), F.col("path").alias("group_path"))
    group_of = stored(group_of.join(sizes, "of_tree"), "merkle-group-paths")

    starts = tops.join(checked(group_of), F.col("tree") == F.col("of_tree")).select("tree", "level", F.col("group_path").alias("path"))
    alone = nodes.where("n = 1").join(checked(group_of.drop("n")), F.col("tree") == F.col("of_tree")).withColumn("path", F.col("group_path"))
    named = ["tree", "idx", "digest", "path", "doc_id", *([] if changed is None else ["other"])]
    found = alone.select(*named)
    if levels:
        found = found.unionByName(_descend(levels, starts, fanout).select(*named))
    out = found.join(checked(group_of), F.col("tree") == F.col("of_tree"))
    out = out.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(None if root is None else bytes(root["digest"]).hex()).alias("root"),
        "path",
        "idx",
        "n",
        "group_idx",
        F.lit(0 if root is None else groups.count()).cast("bigint").alias("n_groups"),
        F.col("digest" if changed is None else "other").alias("other_leaf"),
    )
    return out, max(len(levels), len(upper))


def verified_manifest(docs: DataFrame, changed: Column | None = None, group: str = "lang", fanout: int = FANOUT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each row: does the row, as it is or as changed, lead to the root?"""
    made, most = manifest(docs, changed, group, fanout)
    trees = [(F.col("idx"), F.col("n")), (F.col("group_idx"), F.col("n_groups"))]
    led = folded(_hex(F.col("other_leaf")), F.col("path"), most, F.lit(1), trees, fanout)
    return made.select(
        "doc_id",
        _hex(F.col("leaf")).alias("leaf"),
        "subroot",
        "root",
        F.sha2(_hex(F.col("path")), 256).alias("proof_sha256"),
        led.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
