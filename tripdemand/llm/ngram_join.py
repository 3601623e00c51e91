"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two texts link when their sets of word shingles have a Jaccard similarity of
at least ``num/den``. A set of n shingles must share T = ceil(num*n/den) of
them with any partner, so a partner occurs on T of the n inverted lists. As in
DivideSkip the T-1 longest lists of a set are never merged: they can be
skipped because a partner is bound to show up on one of the other n-T+1 short
ones, and are only probed, by binary search, for what the short lists propose.

On Spark: shingles that are frequent in the whole corpus are put last in every
set, so the short lists are the head of the (frequency class, hash) order; the
heads are shuffled by shingle and each list proposes its size- and
position-compatible pairs; a parity bitmap bounds the symmetric difference
from below and drops nearly all that are not links (first one of a fixed 256 bits, so that
the larger ones travel to few pairs). A list longer than
``list_bound`` (a group of near copies: nothing rare in it) is compared by bitmap
in blocks of at most ``block`` sets and proposes a spanning forest, never all its pairs.
What is proposed falls into clusters, and each is searched by DivideSkip over
the whole sets, again in blocks, so no task holds an unbounded group.

Exact copies of a shingle set are one class from the first shuffle on.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.common import connected_components, ids_as_text, ids_back, materialize
from tripdemand.llm.text_hash import chunks, mix64, shingle_sets

HEAVY_MAX = 1 << 18      # frequent shingles in the broadcast: 2 MB, whatever the corpus
BLOOM_BITS = 1 << 26     # filter of the texts to fetch: 8 MB, whatever the corpus
COARSE = 4               # 64-bit words of the bitmap of fixed size that a proposed pair is held against first
#: The tasks (i <= j) of a member of block ``block`` out of ``nb``.
BLOCK_PAIRS = "transform(sequence(0, nb - 1), x -> struct(least(x, block) as i, greatest(x, block) as j))"


def _texts(pdf: pd.DataFrame) -> list[bytes]:
    return [t.encode().lower() if isinstance(t, str) else b"" for t in pdf["text"]]


def _sets(texts: list[bytes], width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for a, b in chunks(texts):
        yield a, shingle_sets(texts[a:b], width)


def set_key(s: np.ndarray) -> int:
    """64-bit identity of a sorted shingle set."""
    if not len(s):
        return 0
    x = len(s) + int(mix64(s).sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 \
        + int(mix64(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64))
    return int(mix64(np.array([x & (1 << 64) - 1], np.uint64)).view(np.int64)[0])


def parity_bitmap(s: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Bit i is the parity of the shingles whose hash ends in i: bitmaps differ in at most as
    many bits as the sets differ in shingles. About 2 bits a shingle, a power of two, unless ``bits`` is given."""
    bits = bits or max(64, 1 << int(2 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of more words folded to ``size`` words: the parities modulo a smaller power of two."""
    while len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def bits_apart(x: bytes, y: bytes) -> int:
    """Bits two bitmaps differ in; the larger one is folded to the size of the other."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    return int(np.bitwise_count(folded(x, len(y)) ^ folded(y, len(x))).sum())


def bitmap_forest(n: np.ndarray, bitmaps: list[bytes], num: int, den: int, side: np.ndarray | None = None):
    """A spanning forest (pairs of positions) of the pairs whose sizes and bitmaps allow a link;
    with ``side`` (bool) only of pairs of different sides."""
    union, out = UnionFind(range(len(n))), []
    order = np.argsort(n, kind="stable")
    maps = [np.frombuffer(bitmaps[i], np.uint64) for i in order]
    size = n[order]
    ends = np.searchsorted(size * num, size * den, side="right")  # the largest partner's position
    widths = np.array([len(m) for m in maps])
    for width in np.unique(widths):
        here = np.flatnonzero(widths == width)
        reach = np.arange(here[0], int(ends[here].max()))
        grid = np.stack([folded(maps[i], width) for i in reach])
        for i in here:
            j = np.arange(i + 1, ends[i])
            if side is not None:
                j = j[side[order[j]] != side[order[i]]]
            if not len(j):
                continue
            differ = np.bitwise_count(grid[j - reach[0]] ^ maps[i]).sum(axis=1, dtype=np.int64)
            allowed = size[i] + size[j] - 2 * overlap_needed(size[i], size[j], num, den)
            for x in j[differ <= allowed]:
                if union.apart(int(order[i]), int(order[x]), True):
                    out.append((int(order[i]), int(order[x])))
    return out


def overlap_needed(na, nb, num: int, den: int):
    """Smallest intersection with den*|A and B| >= num*|A or B|."""
    return -(-num * (na + nb) // (num + den))


def short_lists(n, num: int, den: int):
    """How many of a set's n lists must be merged: n - T + 1."""
    return n + (num * n) // -den + 1


def divide_skip(queries: list[np.ndarray], index: list[np.ndarray], num: int, den: int,
                same: bool, join) -> Iterator[tuple[int, int]]:
    """Links (query, indexed) found by T-occurrence search, without those that
    ``join(q, i)`` (a union-find; true if the two were apart) shows to be connected already.

    ``same``: queries and index are one list; then only earlier members are proposed.
    """
    sizes = np.fromiter(map(len, index), np.int64, len(index))
    tokens = np.concatenate(index) if index else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(index)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    for q, s in enumerate(queries):
        n = len(s)
        lo, hi = np.searchsorted(tokens, s, "left"), np.searchsorted(tokens, s, "right")
        by_length = np.argsort(hi - lo, kind="stable")
        n_short = int(short_lists(n, num, den))
        short, long_ = by_length[:n_short], by_length[n_short:]
        parts = [owner[lo[t]:hi[t]] for t in short if hi[t] > lo[t]]
        if not parts:
            continue
        who, seen = np.unique(np.concatenate(parts), return_counts=True)
        fits = (den * np.minimum(sizes[who], n) >= num * np.maximum(sizes[who], n))
        fits &= seen + len(long_) >= overlap_needed(n, sizes[who], num, den)
        if same:
            fits &= who < q
        probes = s[np.sort(long_)]
        for i, got in zip(who[fits], seen[fits]):
            if join(q, int(i), False):
                t = index[i]
                at = np.searchsorted(t, probes)
                got = int(got) + int((t[np.minimum(at, len(t) - 1)] == probes).sum())
                if got >= overlap_needed(n, len(t), num, den):
                    join(q, int(i), True)
                    yield q, int(i)


class UnionFind:
    def __init__(self, labels):
        self.up = list(labels)

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def apart(self, a: int, b: int, unite: bool) -> bool:
        a, b = self.find(a), self.find(b)
        if unite and a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _runs(batches: Iterator[pd.DataFrame], key: list[str], rows: int = 1 << 17) -> Iterator[pd.DataFrame]:
    """Batches of a partition sorted by ``key``, joined and cut so that no key spans two."""
    held: list[pd.DataFrame] = []
    size = 0
    for pdf in batches:
        if not len(pdf):
            continue
        held.append(pdf)
        size += len(pdf)
        if size < rows:
            continue
        pdf = pd.concat(held, ignore_index=True)
        last = np.ones(len(pdf), bool)
        for k in key:
            last &= (pdf[k] == pdf[k].iloc[-1]).to_numpy()
        cut = len(pdf) - int(last.sum())
        if cut:
            yield pdf.iloc[:cut]
        held, size = [pdf.iloc[cut:]], len(pdf) - cut
    if held:
        yield pd.concat(held, ignore_index=True)


def ngram_jaccard_join(documents: DataFrame, width: int = 3, num: int = 9, den: int = 10,
                       list_bound: int = 64, block: int = 4096) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, n_shingles, component_id.

    ASCII capitals are lower-cased; words are runs without space, tab, line
    feed, vertical tab, form feed and return. A text of fewer than ``width``
    words is one shingle; null, empty and blank texts have none, link with
    nothing and are their own component. Repeated rows (the same doc_id and
    text twice) give one row each; equal texts are always linked. Rows with a
    null doc_id link as others do; component_id is the smallest non-null
    doc_id reachable. Other columns are ignored. Empty input: empty result.
    Shingles are compared by 64-bit hashes.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text")
    sc = spark.sparkContext

    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []

        def out() -> pd.DataFrame:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pd.DataFrame({"token": tokens[n > 2].view(np.int64), "n": n[n > 2]})

        for pdf in batches:
            for _, sets in _sets(_texts(pdf), width):
                held.extend(sets)
                if sum(map(len, held)) > 1 << 21:
                    yield out()
        if held:
            yield out()

    common = docs.select("text").mapInPandas(frequent, "token long, n long") \
        .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > list_bound) \
        .orderBy(F.desc("n"), "token").limit(HEAVY_MAX)
    heavy = sc.broadcast(np.sort(np.array([r.token for r in common.collect()], np.int64).view(np.uint64)))

    coarse = [f"c{i}" for i in range(COARSE)]

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = heavy.value
        for pdf in batches:
            ids = pdf["doc_id"]
            for a, sets in _sets(_texts(pdf), width):
                rows = []
                for s in sets:
                    if len(common) and len(s):
                        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                        last = common[at] == s
                        ordered = np.concatenate([s[~last], s[last]])
                    else:
                        ordered = s
                    k = int(short_lists(len(s), num, den)) if len(s) else 0
                    rows.append((len(s), set_key(s), ordered[:k].view(np.int64), parity_bitmap(s).tobytes() if len(s) else b"",
                                 *parity_bitmap(s, 64 * COARSE).view(np.int64).tolist()))
                out = pd.DataFrame(rows, columns=["n", "key", "head", "bitmap", *coarse])
                out.insert(0, "doc_id", ids.iloc[a:a + len(sets)].to_numpy())
                yield out

    scanned = materialize(ids_back(ids_as_text(docs, "doc_id").mapInPandas(
        heads, "doc_id string, n long, key long, head array<long>, bitmap binary, " + ", ".join(f"{c} long" for c in coarse)),
        "doc_id", docs), "ngram-heads")
    classes = scanned.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first_doc"))
    sketches = scanned.where("n > 0").select("key", "n", "head", "bitmap", *coarse).dropDuplicates(["key"])
    sketches = materialize(sketches, "ngram-classes")

    postings = sketches.select("key", "n", F.posexplode("head").alias("pos", "token")) \
        .repartition("token").sortWithinPartitions("token", "key")

    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _runs(batches, ["token"]):
            token, key = pdf["token"].to_numpy(), pdf["key"].to_numpy()
            n, pos = pdf["n"].to_numpy(), pdf["pos"].to_numpy()
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            length = np.diff(np.append(start, len(token)))
            a, b, tokens, blocks = [], [], [], []
            for s, m in zip(start[length > 1], length[length > 1]):
                at = np.arange(s, s + m)
                if m > list_bound:  # a long list is searched in blocks, not in this task
                    a.append(key[at])
                    b.append(np.zeros(m, np.int64))
                    tokens.append(token[at])
                    blocks.append(np.full(m, -(-m // block)))
                    continue
                i, j = np.triu_indices(m, 1)
                i, j = at[i], at[j]
                fits = den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j])
                shared = 1 + np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i], n[j] - pos[j]) - 1
                fits &= shared >= overlap_needed(n[i], n[j], num, den)
                a.append(key[i[fits]])
                b.append(key[j[fits]])
                tokens.append(np.zeros(int(fits.sum()), np.int64))
                blocks.append(np.zeros(int(fits.sum()), np.int64))
            if a:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b), "token": np.concatenate(tokens),
                                    "nb": np.concatenate(blocks)}).drop_duplicates()

    proposed = materialize(postings.mapInPandas(propose, "a long, b long, token long, nb int").distinct(), "ngram-pairs")

    def side(p: str, *columns: str) -> DataFrame:
        return sketches.select(F.col("key").alias(p), *[F.col(c).alias(f"{c}_{p}") for c in columns])

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            differ = np.array([bits_apart(x, y) for x, y in zip(pdf["bitmap_a"], pdf["bitmap_b"])])
            na, nb = pdf["n_a"].to_numpy(), pdf["n_b"].to_numpy()
            fits = na + nb - 2 * overlap_needed(na, nb, num, den) >= differ
            yield pdf.loc[fits, ["a", "b"]]

    # shingles that the sets of a pair may have apart, and bits that their small bitmaps have apart
    apart = f"n_a + n_b - 2 * (({num} * (n_a + n_b) + {num + den - 1}) div {num + den})"
    differ = " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in coarse)
    near = materialize(proposed.where("nb = 0").select("a", "b").join(side("a", "n", *coarse), "a").join(side("b", "n", *coarse), "b")
                       .where(f"{apart} >= {differ}").select("a", "b"), "ngram-near")
    pairs = near.join(side("a", "n", "bitmap"), "a").join(side("b", "n", "bitmap"), "b") \
        .mapInPandas(bounded, "a long, b long")
    # members of long lists: every two blocks of a list meet in one task
    long_lists = proposed.where("nb > 0").select("token", F.col("a").alias("key"), "nb").join(
        sketches.select("key", "n", "bitmap"), "key") \
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("nb")).cast("int")) \
        .withColumn("t", F.explode(F.expr(BLOCK_PAIRS))) \
        .select("token", "t.i", "t.j", "block", "key", "n", "bitmap") \
        .repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "key")

    def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["token", "i", "j"], 1 << 13):
            for (_, i, j), pdf in run.groupby(["token", "i", "j"], sort=False):
                side = None if i == j else (pdf["block"] == i).to_numpy()
                got = bitmap_forest(pdf["n"].to_numpy(), pdf["bitmap"].tolist(), num, den, side)
                if got:
                    key, (a, b) = pdf["key"].to_numpy(), np.array(got).T
                    yield pd.DataFrame({"a": key[a], "b": key[b]})

    clusters = connected_components(pairs.union(long_lists.mapInPandas(forest, "a long, b long")))
    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("nb"))
    members = materialize(clusters.join(sizes, "component").select(
        "component", F.col("node").alias("key"), "nb",
        F.pmod(F.xxhash64("node"), F.col("nb")).cast("int").alias("block")), "ngram-members")
    bits = sc.broadcast(_bloom(members))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, sent = bits.value, set()
        for pdf in batches:
            texts, rows = _texts(pdf), {}
            for a, sets in _sets(texts, width):
                for i, s in enumerate(sets, a):
                    k = set_key(s) if len(s) else None
                    if k is not None and k not in sent and table[(k & (BLOOM_BITS - 1)) >> 3] >> (k & 7) & 1:
                        rows[k] = zlib.compress(texts[i], 1)
            if len(sent) < 1 << 20:
                sent.update(rows)
            if rows:
                yield pd.DataFrame({"key": list(rows), "words": list(rows.values())})

    texts = docs.select("text").mapInPandas(fetch, "key long, words binary") \
        .join(members, "key").dropDuplicates(["key"])
    inside = _search_clusters(texts, width, num, den)
    links = materialize(inside, "ngram-links")
    found = connected_components(links).withColumnRenamed("node", "key")

    labelled = classes.join(found, "key", "left") \
        .select("key", "first_doc", F.coalesce("component", "key").alias("component"))
    labelled = materialize(labelled, "ngram-labels")
    first = labelled.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    label = labelled.join(first, "component").select("key", "component_id")
    return scanned.select("doc_id", F.col("n").alias("n_shingles"), "key").join(label, "key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _bloom(keys: DataFrame) -> np.ndarray:
    """Fixed-size filter (one bit a key) of a table of 64-bit keys; built by partial aggregation."""
    byte, bit = F.expr(f"shiftright(key & {BLOOM_BITS - 1}, 6)"), F.expr("cast(key & 63 as int)")
    words = keys.groupBy(byte.alias("word")) \
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    table = np.zeros(BLOOM_BITS // 64, np.int64)
    pdf = words.toPandas()
    table[pdf["word"].to_numpy(np.int64)] = pdf["bits"].to_numpy(np.int64)
    return table.view(np.uint8)


def _search_clusters(members: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Links (a, b) that connect what is linked inside each cluster.

    A cluster of one block is one search. Of a larger one every pair of blocks
    is a task of its own: each member is sent to the tasks of its block.
    """
    rows = members.withColumn("t", F.explode(F.expr(BLOCK_PAIRS))) \
        .select("component", "t.i", "t.j", "block", "key", "words") \
        .repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "block", "key")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["component", "i", "j"], 512):
            for (_, i, j), pdf in run.groupby(["component", "i", "j"], sort=False):
                keys, texts, own = pdf["key"].to_numpy(), [zlib.decompress(t) for t in pdf["words"]], []
                for a, b in chunks(texts):
                    own.extend(shingle_sets(texts[a:b], width))
                cut = int((pdf["block"] == i).sum())
                union = UnionFind(range(len(own)))
                if i == j:
                    got = list(divide_skip(own, own, num, den, True, union.apart))
                else:
                    join = lambda q, x, unite: union.apart(q + cut, x, unite)  # noqa: E731, B023
                    got = [(q + cut, x) for q, x in
                           divide_skip(own[cut:], own[:cut], num, den, False, join)]
                if got:
                    a, b = np.array(got).T
                    yield pd.DataFrame({"a": keys[a], "b": keys[b]})

    return rows.mapInPandas(search, "a long, b long")
