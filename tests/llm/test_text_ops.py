"""Operators on documents against plain Python: n-gram join, decontamination, repeats, lines."""

import collections
import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import SF, ascii_lower, awkward, frame, sentence
from tripdemand.llm.decontaminate import decontaminate
from tripdemand.llm.line_dedup import dedup_lines
from tripdemand.llm.ngram_join import (
    UnionFind, bitmap_forest, bits_apart, divide_skip, ngram_jaccard_join, overlap_needed, parity_bitmap,
)
from tripdemand.llm.suffix_dedup import prefix_intervals, remove_repeats, sliding_min
from tripdemand.llm.text_hash import shingle_sets


def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return [(r.doc_id, r.text) for r in docs.collect()]


def word_sets(rows):
    out = []
    for _, t in rows:
        w = [x for x in re.split("[ \t-\r]+", ascii_lower(t or "")) if x]
        out.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    return out


def brute_components(rows):
    sets = word_sets(rows)
    union = UnionFind(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                union.apart(i, j, True)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        r = union.find(i)
        if d is not None:
            smallest[r] = min(smallest.get(r, d), d)
    return [(d, len(s), smallest.get(union.find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def key(row):
    return tuple((x is not None, x) for x in row)


def test_ngram_join_equals_brute_force(spark):
    rows = awkward() + [(1000 + d, t) for d, t in documents(spark)]
    want = sorted(brute_components(rows), key=key)
    for options in ({}, {"list_bound": 2, "block": 4}):
        got = sorted(map(tuple, ngram_jaccard_join(frame(spark, rows), **options).collect()), key=key)
        assert got == want


def test_ngram_join_of_a_large_group(spark):
    """Hundreds of near copies: long lists, several blocks, and every one of them linked."""
    base = sentence(5, 150).split()
    rows = [(i, " ".join(base[:i % 150] + [f"edit{i}"] + base[i % 150 + 1:])) for i in range(300)]
    rows += [(1000 + i, sentence(100 + i, 60)) for i in range(50)]
    got = ngram_jaccard_join(frame(spark, rows), list_bound=16, block=64).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_components(rows), key=key)


def test_ngram_join_of_nothing(spark):
    assert ngram_jaccard_join(frame(spark, [])).collect() == []


def test_divide_skip_and_bitmaps():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(12):
        base = rng.integers(1, 1 << 62, 80, dtype=np.uint64)
        for _ in range(6):
            s = base.copy()
            s[rng.integers(0, 80, rng.integers(0, 8))] = rng.integers(1, 1 << 62)
            sets.append(np.unique(s))
    links = {(i, j) for i in range(len(sets)) for j in range(i)
             if len(np.intersect1d(sets[i], sets[j])) >= overlap_needed(len(sets[i]), len(sets[j]), 9, 10)}
    union = UnionFind(range(len(sets)))
    found = list(divide_skip(sets, sets, 9, 10, True, union.apart))
    assert set(found) <= links
    whole = UnionFind(range(len(sets)))
    for i, j in links:
        whole.apart(i, j, True)
    assert [whole.find(i) for i in range(len(sets))] == [union.find(i) for i in range(len(sets))]
    maps = [parity_bitmap(s).tobytes() for s in sets]
    for i, j in links:
        assert bits_apart(maps[i], maps[j]) <= len(np.setxor1d(sets[i], sets[j]))
    forest = UnionFind(range(len(sets)))
    for i, j in bitmap_forest(np.array([len(s) for s in sets]), maps, 9, 10):
        forest.apart(i, j, True)
    assert all(forest.find(i) == forest.find(j) for i, j in links)


def test_shingles_do_not_depend_on_the_batch():
    texts = [t.encode() for t in ("a b c d", "", "a b", "d c b a", "a b c d")]
    together = shingle_sets(texts)
    for t, s in zip(texts, together):
        assert np.array_equal(shingle_sets([t])[0], s)
    assert len(together[0]) == 2 and len(together[1]) == 0 and len(together[2]) == 1


# ---- decontamination ----------------------------------------------------------

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(rows, items, width=10):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = WORD.findall(ascii_lower(t or ""))
        k = min(width, len(w))
        for s in range(len(w) - k + 1 if k and i is not None else 0):
            windows[tuple(w[s:s + k])].add(str(i))
    out = []
    for d, t in rows:
        w, hit, found = WORD.findall(ascii_lower(t or "")), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hit.update(range(s, s + k))
                    found |= windows[tuple(w[s:s + k])]
        out.append((d, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return out


def test_decontamination_equals_brute_force(spark, monkeypatch):
    item = sentence(9, 25)
    items = [(1, item), (1, item), (2, None), (3, ""), (None, sentence(8, 12)), (4, "Two, WORDS!"), (5, "alone"), (6, sentence(4, 9))]
    rows = awkward() + [(100, "start " + item + " end"), (101, " ".join(item.split()[3:14]).upper()), (102, "two words"),
                        (103, "two other words alone"), (104, " ".join(item.split()[:9])), (105, item + " " + item)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    want = sorted(brute_hits(rows, items), key=lambda r: key(r[:4]))
    for bound in (100_000, 0):  # with and without the broadcast
        monkeypatch.setattr("tripdemand.llm.decontaminate.BROADCAST_ROWS", bound)
        got = decontaminate(frame(spark, rows), bench).collect()
        assert sorted(map(tuple, got), key=lambda r: key(r[:4])) == want
    assert decontaminate(frame(spark, rows), bench.limit(0)).where("contaminated").count() == 0


# ---- repeated byte strings ------------------------------------------------------

def brute_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(t), len(t) - len(kept), spans, kept, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_equal_brute_force(spark):
    passage = sentence(20, 30)
    rows = [(i, t if t is None else t[:4000]) for i, t in awkward()]
    rows += [(200 + i, f"{sentence(30 + i, 15)} {passage} {sentence(60 + i, 15)}") for i in range(40)]
    rows += [(300, "ab" * 300), (301, "no " * 5), (302, passage + passage[:150])]
    want = sorted(((d, *r) for d, *r in brute_repeats(rows, 120)), key=lambda r: key(r[:3]) + (r[5],))
    for bound in (8192, 8):
        got = remove_repeats(frame(spark, rows), length=120, group_bound=bound).collect()
        got = sorted(((r[0], *r[1:4], bytes(r[4]), r[5]) for r in got), key=lambda r: key(r[:3]) + (r[5],))
        assert got == want
    assert remove_repeats(frame(spark, [])).collect() == []


def test_interval_tree():
    lcp = np.array([2, 5, 5, 1, 4])
    assert sorted(prefix_intervals(lcp)) == [(1, 0, 5), (2, 0, 3), (4, 4, 5), (5, 1, 3)]
    x = np.array([5, 3, 9, 1, 7, 7, 2], np.uint64)
    assert sliding_min(x, 3).tolist() == [3, 1, 1, 1, 2]


# ---- lines ------------------------------------------------------------------------

def test_line_dedup(spark):
    a, b = sentence(40, 30), sentence(41, 30)
    near = a.replace(a.split()[15], "other")
    rows = awkward() + [(20, f"{a}\n\n{b}\n{a}"), (21, f"first\n{near}\nlast"), (22, None), (23, f"{b}"), (24, "only here")]
    got = dedup_lines(frame(spark, rows))
    assert set(frame(spark, []).columns) <= set(got.columns)
    out = {}
    for r in got.collect():
        out.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_removed))
    assert out[20] == [(f"{a}\n\n{b}", 4, 1)]
    assert out[21] == [("first\nlast", 3, 1)]
    assert out[22] == [(None, 0, 0)] and out[1] == [(None, 0, 0)] and out[2] == [("", 1, 0)]
    assert out[23] == [("", 1, 1)] and out[24] == [("only here", 1, 0)]
    assert out[12][0][1:] == (4, 3) and out[13] == [("", 1, 1)]
    assert len(out[5]) == 2 and got.count() == len(rows)
    assert dedup_lines(frame(spark, [])).count() == 0


def test_line_dedup_recall(spark):
    """Against exact components of the same shingle sets on the test table."""
    rows = documents(spark)
    lines = [(d, i, x) for d, t in rows for i, x in enumerate((t or "").split("\n")) if re.search(r"\S", x)]
    first = {}
    for d, i, x in lines:
        first[x] = min(first.get(x, (d, i)), (d, i))
    names = list(first)
    sets = []
    for x in names:
        p = re.findall(r"[^ \t-\r]{1,8}", x)
        sets.append(set(zip(p, p[1:])) if len(p) > 1 else set(p))
    union = UnionFind(range(len(names)))
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for j in {j for t in s for j in holders[t]}:
            if len(s & sets[j]) >= 0.8 * len(s | sets[j]):
                union.apart(i, j, True)
        for t in s:
            holders[t].append(i)
    best = {}
    for i, x in enumerate(names):
        best[union.find(i)] = min(best.get(union.find(i), first[x]), first[x])
    at = {x: i for i, x in enumerate(names)}
    want = sum(best[union.find(at[x])] != (d, i) for d, i, x in lines)
    got = dedup_lines(spark.read.parquet(f"{SF}/documents.parquet")).agg(F.sum("n_removed")).first()[0]
    assert 0.95 * want <= got <= want and want > 0


def test_anchors_of_neighbouring_segments(monkeypatch):
    """A text read in segments has the anchors of the whole text, each once."""
    from tripdemand.llm import suffix_dedup
    texts = [sentence(7, 900).encode(), b"short", sentence(8, 400).encode(), b"ab" * 700]
    whole = [(i, p.tolist(), h.tolist()) for i, p, h in suffix_dedup.anchors(texts, 40)]
    for segment in (40, 41, 64, 257):
        monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
        found = {}
        for i, p, h in suffix_dedup.anchors(texts, 40):
            found.setdefault(i, ([], []))[0].extend(p.tolist())
            found[i][1].extend(h.tolist())
        assert [(i, p, h) for i, (p, h) in sorted(found.items())] == whole
