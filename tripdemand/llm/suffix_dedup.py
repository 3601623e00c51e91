"""Repeated byte strings by an enhanced (sparse) suffix array and its common-prefix interval tree.

Every window of ``length`` bytes holds an anchor: the leftmost of its
smallest k-grams (k = length / 4) by hash. Equal windows have the same anchor at
the same place, so all occurrences of a repeat meet under their anchor's hash.
Only anchors seen more than once travel, with the bytes around them that a
window can reach.

Per anchor the suffixes that start at its occurrences are sorted; a stack scan of
the common-prefix lengths gives the interval tree. A node is a set of
occurrences that share their right extension of r bytes; sorting a node by the
bytes before the anchor (the left extension, read backwards) tells how far
each member goes on together with another one, and where the node is left
diverse. Left and right extension together are a maximal repeat of the group;
those of at least ``length`` bytes cover their occurrences.

Equal surroundings are one member with a count, so copies cost a row each and
never a group. A group of more than ``group_bound`` different surroundings is
searched in blocks; what a block leaves open is settled over all blocks, first by what
stretches of windows share, then by the windows of those that met.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.common import bounded_broadcast, ids_as_text, ids_back, materialize
from tripdemand.llm.text_hash import _BYTE_CODE, _Powers, chunks, mix64

POSITION_BITS = 24
#: Bytes that are hashed at a time; longer texts are read in segments that overlap by a window.
SEGMENT = 1 << 18
#: Window starts that blocks of a hot anchor compare as one, by the bytes their windows share.
STRETCH = 32
FILTER_BITS = 1 << 27    # repeated anchors: 16 MB, whatever the corpus


def gram_hashes(buf: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each position on."""
    up, down = _Powers.get(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[buf] * up[:len(buf)], out=total[1:])
    n = len(buf) - k + 1
    return mix64((total[k:] - total[:n]) * down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (two running minima over blocks)."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text index, anchor positions, anchor hashes) of every text of at least ``length`` bytes."""
    k = length // 4
    pieces = []
    for i, t in enumerate(texts):
        for s in range(0, max(len(t) - length + 1, 0), SEGMENT - length + 1):
            pieces.append((i, s, t[s:s + SEGMENT]))
    mask = np.uint64((1 << POSITION_BITS) - 1)
    last = (-1, -1)  # text and place of the anchor before: neighbouring segments of a text share one at their border
    for a, b in chunks([p[2] for p in pieces], SEGMENT):
        part = pieces[a:b]
        buf = np.frombuffer(b"".join(p[2] for p in part), np.uint8)
        ends = np.cumsum([len(p[2]) for p in part])
        h = gram_hashes(buf, k)
        at = np.arange(len(h), dtype=np.uint64)
        low = sliding_min((h & ~mask) | at, length - k + 1)
        owner = np.searchsorted(ends, np.arange(len(low)), side="right")
        low = low[np.arange(len(low)) + length <= ends[owner]]
        pos = np.unique(low & mask).astype(np.int64)
        who = np.searchsorted(ends, pos, side="right")
        cut = np.searchsorted(who, np.arange(len(part) + 1))
        for j, (i, s, _) in enumerate(part):
            p = pos[cut[j]:cut[j + 1]]
            at = p - (ends[j - 1] if j else 0) + s
            fresh = at > last[1] if i == last[0] else np.ones(len(at), bool)
            last = (i, int(at[-1]))
            yield i, at[fresh], h[p[fresh]].view(np.int64)


def _matrix(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    m = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
    return m, size


def _common(m: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows a[i] and b[i]."""
    differ = m[a] != m[b]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), m.shape[1])
    return np.minimum(first, np.minimum(size[a], size[b]))


def prefix_intervals(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of the inner nodes of the interval tree of sorted suffixes,
    by a stack scan of ``lcp[i]`` = common prefix of suffixes i and i+1."""
    stack: list[list[int]] = []
    for i, value in enumerate([*map(int, lcp), -1]):
        left = i
        while stack and stack[-1][0] > value:
            r, left = stack.pop()
            yield r, left, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append([value, left])


def repeat_cover(left: list[bytes], right: list[bytes], count: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For each surrounding of an anchor (``left`` reversed, ``right`` from the anchor on) the
    intervals, relative to the anchor, of its maximal repeats of at least ``length`` bytes."""
    n = len(right)
    cover: list[list[tuple[int, int]]] = [
        [(-len(a), len(b))] if c > 1 and len(a) + len(b) >= length else [] for a, b, c in zip(left, right, count)]
    if n < 2:
        return cover
    order = np.array(sorted(range(n), key=right.__getitem__))
    rm, rs = _matrix(right, max(map(len, right)))
    lm, ls = _matrix(left, max(1, max(map(len, left))))
    rank = np.empty(n, np.int64)
    rank[sorted(range(n), key=left.__getitem__)] = np.arange(n)
    lcp = _common(rm, rs, order[:-1], order[1:])
    for r, a, b in prefix_intervals(lcp):
        node = order[a:b + 1]
        node = node[np.argsort(rank[node])]
        shared = _common(lm, ls, node[:-1], node[1:])
        best = np.zeros(len(node), np.int64)
        best[:-1] = shared
        np.maximum(best[1:], shared, out=best[1:])
        for i, x in zip(node[best + r >= length], best[best + r >= length]):
            cover[i].append((-int(x), r))
    return cover


def merge_intervals(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def _pair_cover(left, right, length):
    """``repeat_cover`` of many groups of two at once: (covers, left extension, right extension)."""
    rm, rs = _matrix(right, max(map(len, right)))
    lm, ls = _matrix(left, max(1, max(map(len, left))))
    at = np.arange(0, len(left), 2)
    x, r = _common(lm, ls, at, at + 1), _common(rm, rs, at, at + 1)
    return x + r >= length, x, r


def open_chunks(left: bytes, right: bytes, closed: list[tuple[int, int]], length: int, reach: int,
                said: set) -> Iterator[tuple[int, int]]:
    """(stretch, hash of the core its windows share) of the stretches of ``STRETCH`` window starts that
    another block must know of: those with a window that ``closed`` does not hold, and each
    different closed one (``said``) once."""
    text, at = left[::-1] + right, len(left)
    first, last = -len(left), len(right) - length
    for q in range((first + reach) // STRETCH, (last + reach) // STRETCH + 1 if last >= first else 0):
        low, high = q * STRETCH - reach, (q + 1) * STRETCH - 1 - reach
        a, b = max(low, first), min(high, last)
        if a > b:
            continue
        if any(x <= a and b + length <= y for x, y in closed):
            extent = (q, a, hashlib.blake2b(text[a + at:b + length + at], digest_size=16).digest())
            if extent in said:
                continue
            said.add(extent)
        core = hashlib.blake2b(text[high + at:low + length + at], digest_size=8).digest()
        yield q, int.from_bytes(core, "little", signed=True) or 1


def chunk_windows(left: bytes, right: bytes, stretches, length: int, reach: int) -> Iterator[tuple[int, int]]:
    """(start relative to the anchor, hash) of the windows of some stretches."""
    text, at = left[::-1] + right, len(left)
    if len(text) < length:
        return
    hashes = gram_hashes(np.frombuffer(text, np.uint8), length).view(np.int64)
    for q in stretches:
        for lo in range(max(q * STRETCH - reach, -at), min((q + 1) * STRETCH - 1 - reach, len(right) - length) + 1):
            yield lo, int(hashes[lo + at])


def _bytes(pdf: pd.DataFrame) -> list[bytes]:
    return [t.encode() if isinstance(t, str) else b"" for t in pdf["text"]]


def repeated_spans(documents: DataFrame, length: int = 400, group_bound: int = 8192) -> DataFrame:
    """(doc_id, text_hash, spans): the byte intervals of each text that repeats cover, not yet merged."""
    if length < 8:
        raise ValueError("length must be at least 8")
    sc = documents.sparkSession.sparkContext
    k, reach = length // 4, length - length // 4
    docs = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [h for _, _, h in anchors(_bytes(pdf), length)]
            if got:
                h, n = np.unique(np.concatenate(got), return_counts=True)
                yield pd.DataFrame({"h": h, "n": n})

    twice = docs.select("text").mapInPandas(first, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    word, bit = F.expr(f"shiftright(h & {FILTER_BITS - 1}, 6)"), F.expr("cast(h & 63 as int)")
    words = twice.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    words = words.toPandas()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    seen = sc.broadcast(table.view(np.uint8))

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = seen.value
        held: dict[tuple[int, int], list] = {}

        def contexts() -> pd.DataFrame:
            out = pd.DataFrame([(h, c, n, a, b) for (h, c), (n, a, b) in held.items()],
                               columns=["h", "c", "n", "before", "after"])
            held.clear()
            return out.assign(doc_id=None, text_hash=0, pos=-1)

        for pdf in batches:
            texts, rows = _bytes(pdf), []
            for i, pos, h in anchors(texts, length):
                t = texts[i]
                b = h & (FILTER_BITS - 1)
                for p, x in zip(pos[(bits[b >> 3] >> (b & 7) & 1) > 0], h[(bits[b >> 3] >> (b & 7) & 1) > 0]):
                    before, after = t[max(0, p - reach):p], t[p:p + length]
                    c = int.from_bytes(hashlib.blake2b(before, digest_size=8, salt=len(before).to_bytes(4, "little")).digest(), "little", signed=True) \
                        ^ int.from_bytes(hashlib.blake2b(after, digest_size=8).digest(), "little", signed=True)
                    entry = held.get((x, c))
                    if entry is None:
                        held[x, c] = [1, before[::-1], after]
                    else:
                        entry[0] += 1
                    rows.append((x, c, i, p))
            if rows:
                out = pd.DataFrame(rows, columns=["h", "c", "i", "pos"])
                ids = pdf.iloc[out.pop("i").to_numpy()]
                out["doc_id"], out["text_hash"] = ids["doc_id"].to_numpy(), ids["text_hash"].to_numpy()
                yield out.assign(n=0, before=None, after=None)[["h", "c", "n", "before", "after", "doc_id", "text_hash", "pos"]]
            if len(held) > 50_000:
                yield contexts()
        if held:
            yield contexts()

    rows = materialize(ids_back(ids_as_text(docs, "doc_id").mapInPandas(
        around, "h long, c long, n long, before binary, after binary, doc_id string, text_hash long, pos long"), "doc_id", docs), "repeat-rows")
    found = rows.where("pos < 0").select("h", "c", "n", "before", "after")
    blocks = found.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > group_bound) \
        .select("h", F.ceil(F.col("m") / group_bound).cast("int").alias("blocks"))
    blocks = bounded_broadcast(materialize(blocks, "repeat-blocks"), 100_000)
    members = found.join(blocks, "h", "left").withColumn(
        "block", F.when(F.col("blocks").isNull(), -1).otherwise(F.pmod("c", F.col("blocks"))).cast("int")) \
        .drop("blocks").repartition("h", "block").sortWithinPartitions("h", "block")

    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if len(pdf):
                held.append(pdf)
                if sum(map(len, held)) > 4096:
                    whole = pd.concat(held, ignore_index=True)
                    last = (whole["h"] == whole["h"].iloc[-1]) & (whole["block"] == whole["block"].iloc[-1])
                    cut = len(whole) - int(last.sum())
                    if cut:
                        yield whole.iloc[:cut].groupby(["h", "block", "c"], sort=True, as_index=False).agg(
                            n=("n", "sum"), before=("before", "first"), after=("after", "first"))
                    held = [whole.iloc[cut:]]
        if held:
            yield pd.concat(held, ignore_index=True).groupby(["h", "block", "c"], sort=True, as_index=False).agg(
                n=("n", "sum"), before=("before", "first"), after=("after", "first"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in groups(batches):
            h, c, block = pdf["h"].to_numpy(), pdf["c"].to_numpy(), pdf["block"].to_numpy()
            n, left, right = pdf["n"].to_numpy(), pdf["before"].tolist(), pdf["after"].tolist()
            start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (block[1:] != block[:-1])]))
            size = np.diff(np.append(start, len(h)))
            out: list[tuple[int, int, int, int, int]] = []
            for s in start[(size == 1) & (n[start] > 1) & (block[start] < 0)]:
                out.append((h[s], c[s], -len(left[s]), len(right[s]), 0))
            two = start[(size == 2) & (n[start] == 1) & (n[np.minimum(start + 1, len(n) - 1)] == 1) & (block[start] < 0)]
            if len(two):
                at = np.stack([two, two + 1], axis=1).ravel()
                ok, x, r = _pair_cover([left[i] for i in at], [right[i] for i in at], length)
                for j in np.flatnonzero(ok):
                    out += [(h[i], c[i], -int(x[j]), int(r[j]), 0) for i in (two[j], two[j] + 1)]
            done = set(two.tolist())
            for s, m in zip(start, size):
                if (m == 1 and block[s] < 0) or s in done:
                    continue
                cover = repeat_cover(left[s:s + m], right[s:s + m], n[s:s + m], length)
                said: set[tuple[int, bytes]] = set()
                for i, spans in enumerate(cover, s):
                    merged = merge_intervals(spans)
                    out += [(h[i], c[i], lo, hi, 0) for lo, hi in merged]
                    if block[s] >= 0:  # other blocks may repeat what this one leaves open
                        out += [(h[i], c[i], q, 0, core) for q, core in
                                open_chunks(left[i], right[i], merged, length, reach, said)]
            if out:
                yield pd.DataFrame(out, columns=["h", "c", "lo", "hi", "window"])

    covered = materialize(members.select("h", "block", "c", "n", "before", "after").mapInPandas(
        search, "h long, c long, lo int, hi int, window long"), "repeat-cover")
    # Stretches of windows whose core two blocks hold are compared window by window. The anchor and
    # the place around it are part of the key: a window that holds two anchors is proposed by
    # both, and must not count as its own copy.
    place = ["window", "h", "lo"]
    proposed = covered.where("window <> 0")
    twice = proposed.groupBy(*place).agg(F.count("*").alias("times")).where("times > 1")
    hot = proposed.join(twice, place, "left_semi").groupBy("h", "c").agg(F.collect_set("lo").alias("stretches"))

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(x, y, lo, w) for x, y, before, after, qs in zip(pdf["h"], pdf["c"], pdf["before"], pdf["after"], pdf["stretches"])
                   for lo, w in chunk_windows(before, after, qs, length, reach)]
            if out:
                yield pd.DataFrame(out, columns=["h", "c", "lo", "window"])

    single = found.select("h", "c", "before", "after").join(hot, ["h", "c"]).dropDuplicates(["h", "c"])
    opened = materialize(single.select("h", "c", "before", "after", "stretches").mapInPandas(
        windows, "h long, c long, lo int, window long"), "repeat-windows")
    shared = opened.groupBy(*place).agg(F.count("*").alias("times")).where("times > 1")
    across = opened.join(shared, place, "left_semi").select("h", "c", "lo", (F.col("lo") + length).alias("hi"))
    spans = covered.where("window = 0").select("h", "c", "lo", "hi").union(across)
    sorted_spans = spans.groupBy("h", "c").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("s")) \
        .select("h", "c", F.expr("transform(s, x -> x.lo)").alias("lo"), F.expr("transform(s, x -> x.hi)").alias("hi"))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            merged = [merge_intervals(zip(lo.tolist(), hi.tolist())) for lo, hi in zip(pdf["lo"], pdf["hi"])]
            yield pdf[["h", "c"]].assign(lo=[[x for x, _ in m] for m in merged], hi=[[x for _, x in m] for m in merged])

    # one row per surroundings, so the join gives one row per occurrence
    whole = sorted_spans.mapInPandas(merge, "h long, c long, lo array<int>, hi array<int>")
    placed = rows.where("pos >= 0").select("h", "c", "doc_id", "text_hash", "pos").join(whole, ["h", "c"]) \
        .select("doc_id", "text_hash", F.expr("transform(arrays_zip(lo, hi), x -> struct(pos + x.lo as lo, pos + x.hi as hi))").alias("s"))
    return placed.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_set("s")).alias("spans"))


def remove_repeats(documents: DataFrame, length: int = 400, group_bound: int = 8192) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept (binary),
    kept_sha256.

    Texts are UTF-8 bytes. Removed is every byte covered by a string of
    ``length`` bytes that also starts anywhere else, in the same text or another
    one; strings never cross texts. Null and empty texts have no bytes; texts
    shorter than ``length`` stay whole. Repeated rows are texts of their own, so
    both are covered. Null doc_ids are kept; other columns are ignored; an
    empty table gives an empty result.
    """
    spans = repeated_spans(documents, length, group_bound)
    docs = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    joined = docs.alias("d").join(spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
                                  & (F.col("d.text_hash") == F.col("s.text_hash")), "left") \
        .select("d.doc_id", "d.text", F.expr("transform(s.spans, x -> x.lo)").alias("lo"),
                F.expr("transform(s.spans, x -> x.hi)").alias("hi"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t, lo, hi in zip(_bytes(pdf), pdf["lo"], pdf["hi"]):
                merged = merge_intervals(zip(lo.tolist(), hi.tolist())) if lo is not None else []
                kept, at = [], 0
                for a, b in merged:
                    kept.append(t[at:a])
                    at = b
                kept = b"".join([*kept, t[at:]])
                out.append((len(t), len(t) - len(kept), len(merged), kept, hashlib.sha256(kept).hexdigest()))
            got = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])
            got.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield got

    out = ids_as_text(joined, "doc_id").mapInPandas(
        cut, "doc_id string, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return ids_back(out, "doc_id", docs)
