"""Merkle manifest and conversation trie against brute force, with awkward rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from tests.llm.helpers import SF, awkward
from tripdemand.llm.burst_trie import prefix_trie
from tripdemand.llm.merkle import manifest

DOCS = "doc_id long, source string, lang string, n_chars long, text string, hash string, lo long, tree string, path string"
CONVS = "conv_id long, turn long, role string, text string, head string, ids string, n long, key string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key(row):
    return tuple(str(x) for x in row)


def brute_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(map(field, (*r[:4], text))))

    def tree(hashes):
        levels = [hashes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            b = i // 8 * 8
            out.append(("".join(level[b:i]), "".join(level[i + 1:b + 8])))
            i //= 8
        return out

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r, leaf(r, r[4])))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = tree([h for _, h in groups[lang]])
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (r, h) in enumerate(groups[lang]):
            steps, v = path(trees[lang], i) + path(top, k), h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                v = leaf(r, re.sub("[A-Z]", lambda m: m[0].lower(), r[4]))
            for a, b in steps:
                v = sha(a + v + b)
            root = top[-1][0]
            out.append((r[0], h, trees[lang][-1][0], root, sha("".join(a + b for a, b in steps)), v, v == root))
    return sorted(out, key=key)


def document_rows():
    out = [(i, f"s{k % 3}" if k % 4 else None, [None, "en", "de", "", "zz", "é"][k % 6], k if k % 5 else None, t) for k, (i, t) in enumerate(awkward())]
    out += [(i, "src", "en", 3, f"Text {i % 7} ÄB") for i in range(100, 230)]
    return out + out[-3:] + [(-5, None, None, None, None), (10**18, "a", "only", 1, "Z" * 100_000)]


def test_manifest_equals_brute_force(spark):
    rows = document_rows()
    df = spark.createDataFrame([(*r, "h", 1, "t", "p") for r in rows], DOCS).repartition(5)
    got = manifest(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()), key=key)
    assert got == brute_manifest(rows)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65])
def test_manifest_sizes(spark, n):
    """Empty table, a lone leaf, full runs and runs of one."""
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(n)]
    got = sorted(map(tuple, manifest(spark.createDataFrame([(*r, "h", 1, "t", "p") for r in rows], DOCS)).collect()), key=key)
    assert got == brute_manifest(rows)


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = sha(f"{len(role.encode())}:{role}{text}")[:32]
            convs[c].append(((turn is not None, turn or 0, order), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, s in seqs.items():
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                kids[s[:d - 1]].add(s[:d])
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if p in kids else 1
        saved[p] = sum(saved[k] for k in kids.get(p, ())) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), leaves[p], saved[p],
                    sha(",".join(map(str, sorted(ends.get(p, [])))))) for p, m in members.items()), key=key)


def conversation_rows():
    rows = []
    for c in range(0, 260):
        for t in range(c % 7):
            rows.append((c, t, ("user", "assistant")[t % 2], f"turn {t} {c // 40 if t > 2 else 0}"))
    for c in range(300, 360):  # copies, and near copies with a late difference
        rows += [(c, t, "user", f"same {t}") for t in range(12)] + [(c, 12, "user", f"end {c % 4}")] * (c % 2)
    rows += [(1000, None, None, None), (1000, None, "a", None), (1000, 3, "b", "x"), (1000, 3, "a", "y"), (1000, 3, "a", "y"), (None, 1, "user", "lost")]
    rows += [(1001, t, "user", "é🤖" * (t % 3)) for t in range(400)] + [(-7, 0, "user", "negative"), (1002, 0, "", "z" * 50_000)]
    return rows


@pytest.mark.parametrize("bounds", [{}, {"max_sequences": 3, "max_turns": 10, "max_members": 2}])
def test_trie_equals_brute_force(spark, bounds):
    """The same nodes whether containers are burst at a few suffixes or not at all."""
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "h", "i", 1, "k") for r in rows], CONVS).repartition(4)
    got = prefix_trie(df, **bounds)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == brute_trie(rows)


def test_trie_on_the_table_and_empty(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = list(map(tuple, df.select("conv_id", "turn", "role", "text").collect()))
    assert sorted(map(tuple, prefix_trie(df).collect()), key=key) == brute_trie(rows)
    assert prefix_trie(df.limit(0)).count() == 0
