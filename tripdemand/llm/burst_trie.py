"""Prefix trie of conversations as a burst trie.

A conversation is an array of turn ids. Equal conversations are one sequence
(with a count), so copies cost nothing after a partial aggregate. A container
holds the suffixes below a trie head; one container starts under the root.
An oversized container is burst: if its suffixes share a common prefix (that
of its smallest and its largest array) the head moves down that edge, else the
suffixes go to a container per next turn id, each under a new head. Containers
within the bound are sorted and swept by one task each into trie nodes, and
the heads add up what lies below them, round by round from the last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.common import materialize

#: A larger container is burst. Any bounds give the same nodes.
MAX_SEQUENCES, MAX_TURNS = 4096, 65536
#: Members of a sequence that are listed in one row; longer lists are hashed as a stream of such rows.
MAX_MEMBERS = 8192
#: A conversation takes over fewer turns than this from the first of its hundred.
SHARED = 6

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
        " saved_tokens long, ends string, head string, is_top boolean")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (id, chars).

    The id is half a SHA-256 of role and text (null as empty). Turns with the same number follow
    the order of their ids. Rows without conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    tid = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    rows = conversations.where("conv_id is not null").select(
        "conv_id", F.struct("turn", tid.alias("id"), F.length(text).cast("long").alias("chars")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")) \
        .select("conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("turns"))


def rebuild(convs: DataFrame) -> DataFrame:
    """(conv_id, turns) with the first h turns taken from conversation c - c % 100, then its own after its first h."""
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    heads = convs.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED - 1).alias("lead"))
    none = F.array().cast(convs.schema["turns"].dataType)
    out = convs.withColumn("h", h).withColumn("base", F.expr("conv_id - conv_id % 100")).join(heads, "base", "left")
    return out.select("conv_id", F.concat(F.slice(F.coalesce("lead", none), F.lit(1), F.col("h")),
                                          F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _stream_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (key, part) rows: one running SHA-256 per key over its parts, however many there are."""
    key, state, done = None, None, []
    for pdf in batches:
        for k, ids in zip(pdf["key"], pdf["ids"]):
            if k != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done:
            yield pd.DataFrame(done, columns=["key", "ends"])
            done = []
    if key is not None:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends"])


def member_digests(members: DataFrame, sequences: DataFrame, most: int = MAX_MEMBERS) -> DataFrame:
    """(key, ends): digest of the ascending ids of the conversations of each sequence.

    SHA-256 runs in order, so a sequence of very many members ends in one task; it reads them as
    rows of comma-joined ids made by range-partitioned tasks and keeps only the running state.
    """
    large = sequences.where(F.col("n") > most).select("key")
    listed = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ","), 256)
    small = members.join(large, "key", "left_anti").groupBy("key").agg(listed.alias("ends"))
    if large.isEmpty():
        return small
    ids = materialize(members.join(large, "key", "left_semi").repartitionByRange("key", "conv_id")
                      .sortWithinPartitions("key", "conv_id").withColumn("at", F.monotonically_increasing_id()), "trie-members")
    # Blocks of neighbouring rows of a key: bounded lists, in the order of their first id.
    parts = ids.groupBy("key", F.expr(f"at div {most}").alias("block")).agg(
        F.min("conv_id").alias("first"), F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    long = parts.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInPandas(_stream_digests, "key string, ends string")
    return small.unionByName(long)


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted suffixes of whole containers -> their nodes, and a row of sums per container (is_top)."""
    # An open node: depth, smallest member, members, chars of its last turn, children, leaves, saved below, ends, closed children.
    head = previous = None
    stack: list[list] = []
    out: list[tuple] = []

    def close():
        depth, conv, n, chars, kids, leaves, saved, ends, waiting = stack.pop()
        for row in waiting:  # the children now know their parent's smallest member
            out.append((*row[:2], conv, *row[3:]))
        leaves, saved = leaves or 1, saved + (n - 1) * chars
        up = stack[-1]
        up[1] = conv if up[1] is None or conv < up[1] else up[1]
        up[2] += n
        up[4] += 1
        up[5] += leaves
        up[6] += saved
        up[8].append((conv, depth, None, n, kids, leaves, saved, ends, None, False))

    def finish():
        while len(stack) > 1:
            close()
        _, conv, n, _, kids, leaves, saved, _, waiting = stack.pop()
        for row in waiting:
            out.append((*row[:2], head_conv, *row[3:]))
        out.append((None, None, None, n, kids, leaves, saved, None, head, True))

    columns = [c.split()[0] for c in NODE.split(", ")]
    head_conv = None
    for pdf in batches:
        for h, at, hc, ids, chars, n, conv, ends in pdf.itertuples(index=False, name=None):
            if h != head:
                if head is not None:
                    finish()
                head, head_conv, previous = h, hc, ()
                stack = [[at, None, 0, 0, 0, 0, 0, None, []]]
            same, most = 0, min(len(ids), len(previous))
            while same < most and ids[same] == previous[same]:
                same += 1
            while len(stack) > same + 1:
                close()
            for k in range(same, len(ids)):
                stack.append([at + k + 1, None, 0, int(chars[k]), 0, 0, 0, None, []])
            last = stack[-1]
            last[1] = conv if last[1] is None or conv < last[1] else last[1]
            last[2] += n
            last[7] = ends
            previous = ids
            if len(out) >= 20_000:
                yield pd.DataFrame(out, columns=columns).astype(_TYPES)
                out.clear()
    if head is not None:
        finish()
    if out:
        yield pd.DataFrame(out, columns=columns).astype(_TYPES)


_TYPES = {c.split()[0]: {"long": "Int64", "string": "object", "boolean": "bool"}[c.split()[1]] for c in NODE.split(", ")}


def _edge_nodes(heads: DataFrame) -> DataFrame:
    """The nodes along each head's edge, from the sums at its lower end."""
    # At position i of the edge the nodes from i down are saved in full: (n - 1) turns' chars each.
    i = F.col("i")
    rest = F.aggregate(F.slice("chars", i + 1, F.size("chars")), F.lit(0).cast("long"), lambda a, c: a + c)
    bottom = i == F.size("chars") - 1
    return heads.select("*", F.posexplode("chars").alias("i", "_chars")).select(
        F.col("conv").alias("conv_id"), (F.col("up_depth") + 1 + i).alias("depth"),
        F.when(i == 0, F.col("up_conv")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(bottom, F.col("kids")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n") - 1) * rest).alias("saved_tokens"), F.when(bottom, F.col("ends")).alias("ends"))


def prefix_trie(conversations: DataFrame, max_sequences: int = MAX_SEQUENCES, max_turns: int = MAX_TURNS,
                max_members: int = MAX_MEMBERS) -> DataFrame:
    """The nodes of the trie over the rebuilt conversations (conv_id, turn, role, text; other columns are not read).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Null role or text is empty, null turns come first, turns of one number in the order of
    their digests, rows of a null conv_id are left out; a repeated row is a turn of its own. An empty table has
    no nodes, not even a root. Text never leaves the first stage: a turn is 32 hex digits and its
    length, and one conversation's ids are one row (the only thing that is not split).
    """
    turns = materialize(turn_arrays(conversations), "trie-turns")
    rebuilt = rebuild(turns).select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars")) \
        .withColumn("key", F.sha2(F.array_join("ids", ""), 256))
    rebuilt = materialize(rebuilt, "trie-rebuilt")
    sequences = materialize(rebuilt.groupBy("key").agg(
        F.first("ids").alias("ids"), F.first("chars").alias("chars"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv")), "trie-sequences")
    ends = member_digests(rebuilt.select("key", "conv_id"), sequences, max_members)
    whole = materialize(sequences.join(ends, "key").drop("key"), "trie-items")

    # The root: the end of the turnless sequence, if any; the rest is the first container.
    root = whole.agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max(F.when(F.size("ids") == 0, F.col("ends"))).alias("ends")) \
        .where("n is not null").select(F.lit("").alias("id"), F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("depth"),
                                       F.lit(-1).cast("long").alias("up_depth"), F.lit(None).cast("long").alias("up_conv"),
                                       F.array(F.lit(0).cast("long")).alias("chars"), "n", "conv", "ends")
    rounds = [materialize(root, "trie-heads")]
    first = rounds[0].select("conv").first()
    items = whole.where("size(ids) > 0").select(F.lit("").alias("head"), F.lit(0).cast("long").alias("at"), "ids", "chars", "n", "conv", "ends",
                                                F.lit(first[0] if first else None).cast("long").alias("head_conv"))
    settled = []
    while True:
        mismatch = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), F.lit(False))
        sizes = items.groupBy("head").agg(F.count(F.lit(1)).alias("_c"), F.sum(F.size("ids")).alias("_t"), F.min("ids").alias("low"), F.max("ids").alias("high")) \
            .where((F.col("_c") > max_sequences) | (F.col("_c") > 1) & (F.col("_t") > max_turns)) \
            .select("head", (mismatch - 1).cast("int").alias("shared"))
        sizes = materialize(sizes, "trie-oversized")
        if sizes.isEmpty():
            settled.append(items)
            break
        settled.append(items.join(sizes, "head", "left_anti"))
        take = F.when(F.col("shared") > 0, F.col("shared")).otherwise(F.lit(1))
        moved = items.join(sizes, "head").withColumn("take", take)
        child = F.sha2(F.concat_ws("/", "head", F.array_join(F.slice("ids", F.lit(1), F.col("take")), "")), 256)
        moved = materialize(moved.select(
            child.alias("id"), F.col("head").alias("up"), F.col("head_conv").alias("up_conv"), F.col("at").alias("up_depth"),
            (F.col("at") + F.col("take")).alias("at"), F.slice("chars", F.lit(1), F.col("take")).alias("edge"),
            F.slice("ids", F.col("take") + 1, F.size("ids")).alias("ids"), F.slice("chars", F.col("take") + 1, F.size("chars")).alias("chars"),
            "n", "conv", "ends"), "trie-moved")
        heads = materialize(moved.groupBy("id").agg(
            F.first("up").alias("up"), F.max("at").alias("depth"), F.max("up_depth").alias("up_depth"), F.max("up_conv").alias("up_conv"),
            F.first("edge").alias("chars"), F.sum("n").alias("n"), F.min("conv").alias("conv"),
            F.max(F.when(F.size("ids") == 0, F.col("ends"))).alias("ends")), "trie-heads")
        rounds.append(heads)
        items = materialize(moved.where("size(ids) > 0").select(F.col("id").alias("head"), "at", "ids", "chars", "n", "conv", "ends")
                            .join(heads.select(F.col("id").alias("head"), F.col("conv").alias("head_conv")), "head"), "trie-open")

    final = reduce(DataFrame.unionByName, settled).select("head", "at", "head_conv", "ids", "chars", "n", "conv", "ends")
    swept = materialize(final.repartition("head").sortWithinPartitions("head", "ids").mapInPandas(_sweep, NODE), "trie-nodes")
    tops = swept.where("is_top").select(F.col("head").alias("id"), F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"),
                                        F.col("saved_tokens").alias("below"))
    out, under = [swept.where("not is_top").select(*COLUMNS, "ends")], None
    for heads in reversed(rounds):
        below = tops if under is None else tops.unionByName(under)
        sums = below.groupBy("id").agg(F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("below").alias("below"))
        full = materialize(heads.join(sums, "id", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
                           .withColumn("leaves", F.coalesce("leaves", F.lit(1))).withColumn("below", F.coalesce("below", F.lit(0))), "trie-sums")
        out.append(_edge_nodes(full).select(*COLUMNS, "ends"))
        edge = F.aggregate("chars", F.lit(0).cast("long"), lambda a, c: a + c)
        under = full.groupBy(F.col("up").alias("id")).agg(
            F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"), F.sum(F.col("below") + (F.col("n") - 1) * edge).alias("below"))
    nodes = reduce(DataFrame.unionByName, out)
    return nodes.select(*COLUMNS, F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
