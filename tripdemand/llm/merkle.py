"""Merkle manifest of a table of documents, with the tree as nested intervals.

Leaves are ranked inside their language; a node is labelled with the interval
[lo, hi) of the leaf ranks it covers. A level groups 8 consecutive nodes, so
the nodes of level L lie in buckets of 8**L ranks: a join on (tree, bucket)
with containment of the intervals attaches a node to its parent, and the
children of the parent whose intervals lie left or right of a node's own are
its siblings. Paths run from the root down, one table per level, each an
eighth of the one below; a node carries the sibling digests of its path, so a
leaf is joined once, with its own parent.

The subroots of the languages are the leaves of a second tree of the same kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.common import materialize
from tripdemand.llm.ranking import ranked

#: Children of a node.
FAN = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """``-`` for null, else the byte count of the value's text, a colon and the text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return digest(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]))


def build_levels(leaves: DataFrame, depth: int) -> list[DataFrame]:
    """The levels above ``leaves`` (tree, lo, hi, size, hash), lowest first, each a written table.

    A row: tree, lo, hi, size (leaves of the tree), hash, kids (the children's intervals and digests).
    A tree whose single node is reached has no rows in higher levels.
    """
    levels, below = [], leaves
    for level in range(1, depth + 1):
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "hash")))
        below = materialize(
            below.where(F.col("size") > FAN ** (level - 1))
            .groupBy("tree", F.expr(f"lo div {FAN ** level}").alias("bucket"))
            .agg(kids.alias("kids"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("size").alias("size"))
            .withColumn("hash", digest(F.array_join(F.col("kids.hash"), ""))), f"merkle-{level}")
        levels.append(below)
    return levels


def _step(inside: DataFrame, level: int, above: DataFrame, keep: list[str]) -> DataFrame:
    """``inside`` (nodes below ``level``) joined to the node of ``level`` that contains them, with their path."""
    c = inside.withColumn("_bucket", F.expr(f"lo div {FAN ** level}")).alias("c")
    p = above.alias("p")
    held = (F.col("c.tree").eqNullSafe(F.col("p.tree")) & (F.col("c._bucket") == F.col("p.bucket"))
            & (F.col("p.lo") <= F.col("c.lo")) & (F.col("c.hi") <= F.col("p.hi")))
    left = F.array_join(F.transform(F.filter("p.kids", lambda k: k["hi"] <= F.col("c.lo")), lambda k: k["hash"]), "")
    right = F.array_join(F.transform(F.filter("p.kids", lambda k: k["lo"] >= F.col("c.hi")), lambda k: k["hash"]), "")
    path = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("p.path"))
    return c.join(p, held).select(*[f"c.{k}" for k in keep], path.alias("path"), "p.subroot")


def attach_paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of the leaves, their path (siblings left and right, upwards) and their tree's subroot.

    ``tops`` (top, path) holds what follows above the tree's single node.
    """
    def of_top(nodes: DataFrame, columns: list[str]) -> DataFrame:
        single = nodes.where("hi - lo = size")
        return single.join(tops, F.col("tree").eqNullSafe(F.col("top"))).select(*columns, "path", F.col("hash").alias("subroot"))

    above, columns = None, ["tree", "bucket", "lo", "hi", "kids"]
    for level in range(len(levels), 0, -1):
        nodes = levels[level - 1]
        own = of_top(nodes, columns)
        above = own if above is None else own.unionByName(_step(nodes.where("hi - lo < size"), level + 1, above, columns))
    own = of_top(leaves, keep)
    return own if above is None else own.unionByName(_step(leaves.where("hi - lo < size"), 1, above, keep))


def depth_of(n: int) -> int:
    depth = 0
    while FAN ** depth < n:
        depth += 1
    return depth


def interval_leaves(rows: DataFrame, tree: str, order: list[str]) -> tuple[DataFrame, int]:
    """Leaf rows (a written table with ``hash``) ranked in their tree as intervals; the deepest tree's depth."""
    out = ranked(rows, tree, order, "lo", "size").withColumn("hi", F.col("lo") + 1)
    if tree != "tree":
        out = out.withColumnRenamed(tree, "tree")
    out = materialize(out, "merkle-0")
    most = out.agg(F.max("size")).first()[0]
    return out, depth_of(most or 0)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text; other columns are not read).

    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. A leaf is the digest of the
    row's fields; leaves of a language ascend by doc_id (null first, equal ids by digest), the
    languages' subroots by lang (null first). ``folded_root`` starts from the tampered leaf where 3
    divides the checksum of doc_id (text with A-Z lower-cased; a null doc_id is not tampered).
    An empty table gives no rows; a single document is its own root and has an empty proof; repeated
    rows are leaves of their own.
    """
    d = docs.select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = materialize(d.select(
        "doc_id", "lang", leaf_digest(*fields, F.col("text")).alias("hash"),
        F.when(tampered, leaf_digest(*fields, F.translate("text", _UPPER, _LOWER))).alias("changed")), "merkle-leaves")
    leaves, depth = interval_leaves(rows, "lang", ["doc_id", "hash"])
    levels = build_levels(leaves, depth)

    subroots = None
    for nodes in [leaves, *levels]:
        single = nodes.where("hi - lo = size").select(F.col("tree").alias("lang"), "hash")
        subroots = single if subroots is None else subroots.unionByName(single)
    subroots = materialize(subroots.withColumn("tree", F.lit("")), "merkle-subroots")
    top_leaves, top_depth = interval_leaves(subroots, "tree", ["lang"])
    top_levels = build_levels(top_leaves, top_depth)
    last = (top_levels or [top_leaves])[-1].select("hash").first()
    root = F.lit(last[0] if last else None).cast("string")
    over = docs.sparkSession.range(1).select(F.lit("").alias("top"), F.array().cast(_STEP).alias("path"))
    tops = materialize(attach_paths(top_leaves, top_levels, over, ["lang"]).select(F.col("lang").alias("top"), "path"), "merkle-tops")

    held = attach_paths(leaves, levels, tops, ["doc_id", "hash", "changed"])
    fold = F.aggregate("path", F.coalesce("changed", "hash"), lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))
    proof = digest(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""))
    return held.select("doc_id", F.col("hash").alias("leaf"), "subroot", root.alias("root"), proof.alias("proof_sha256"),
                       fold.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
