"""Line deduplication: every near copy of a hot template, edits of one character, rows without a key."""

import os
import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SF, frame, sentence
from tripdemand.llm import line_dedup
from tripdemand.llm.common import discard, materialize
from tripdemand.llm.line_dedup import WIDTH, _bitmaps, _bucket_pairs, _buckets, _likely, _links, _prefix_pairs, dedup_lines, shingles


def removed(spark, texts, **options):
    got = dedup_lines(frame(spark, list(enumerate(texts))), **options)
    return {r.doc_id for r in got.collect() if r.n_removed}


def hot_template(n):
    """n variants of a template that are far from each other, each with a near copy that follows all of them."""
    head = " ".join(f"h{k:03d}w" for k in range(50))
    far = [f"{head} " + " ".join(f"v{i}x{k}" for k in range(7)) for i in range(n)]
    return far, [f"{t} end" for t in far]


def test_near_copies_in_a_hot_template(spark):
    """Large buckets whose leaders are far from most lines: near copies alone are counted."""
    far, near = hot_template(300)
    for few in (16, 10 ** 6):  # by prefixes and directly
        got = removed(spark, far + near, few=few)
        assert got <= set(range(300, 600))
        assert len(got) >= 0.97 * 300


def test_one_character_edits_are_found(spark):
    """Lines of 8 to 15 words and text without spaces; against brute force over 5-character shingles."""
    texts = []
    for i in range(40):
        line = " ".join(sentence(200 + i, 30).split()[:8 + i % 8])
        texts += [line, line[:len(line) // 2] + "#" + line[len(line) // 2 + 1:]]
    for i in range(20):
        run = "".join(chr(0x4E00 + (i * 7919 + k * k * 31 + k * 17) % 5000) for k in range(90))
        texts += [run, "\u4E00" + run]
    texts += ["abc", "abd", "\U0001F916 ab \U0001F916"]

    def shingle_set(x):
        return {x[k:k + 5] for k in range(max(len(x) - 4, 1))}

    pairs = [(shingle_set(texts[i]), shingle_set(texts[i + 1])) for i in range(0, 120, 2)]
    want = {2 * i + 1 for i, (a, b) in enumerate(pairs) if len(a & b) >= 0.8 * len(a | b)}
    got = removed(spark, texts, width=WIDTH)
    assert len(want) >= 50 and got <= want and len(got) >= 0.97 * len(want)


def test_shingles_of_chunks(spark):
    """Every position of long lines once, at and around the ends of chunks."""
    texts = ["x", "abcd", "abcde"] + [sentence(1, 3000)[:n] for n in (63, 64, 65, 68, 69, 127, 128, 132, 133, 20_000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, line string")
    got = shingles(rows, WIDTH).groupBy("key").agg(F.sort_array(F.collect_list("h")).alias("h")).collect()
    want = spark.createDataFrame([(i, t[k:k + 5]) for i, t in enumerate(texts) for k in range(max(len(t) - 4, 1))], "key long, s string") \
        .groupBy("key").agg(F.sort_array(F.collect_list(F.xxhash64("s"))).alias("h")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_rows_that_share_a_doc_id(spark):
    """Null and repeated doc_ids: each row loses its own lines only."""
    for i in (None, 5):
        got = dedup_lines(frame(spark, [(i, "a\nX"), (i, "X\nb"), (i, "c\nd"), (9, "b\ne")])).collect()
        assert sorted((r.text, r.n_removed) for r in got) == [("X\nb", 0), ("a", 1), ("c\nd", 0), ("e", 1)]


def test_contaminated_rows_that_share_a_doc_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("size(split(text, ' ')) > 12").first().text
    rows = [(None, f"start {item} end"), (None, "clean"), (5, f"start {item}"), (5, "clean too"), (6, None)]
    got = corpus_pipeline.drop_contaminated(spark, frame(spark, rows), SF).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == [(0, "clean"), (5, "clean too"), (6, "")]


def test_lines_are_shingled_once(spark, monkeypatch):
    """What is shingled are distinct lines, whatever the number of their copies."""
    seen = []

    def counted(lines, width):
        seen.append((lines.count(), lines.select("key").distinct().count()))
        return shingles(lines, width)

    monkeypatch.setattr("tripdemand.llm.line_dedup.shingles", counted)
    got = removed(spark, ["the same line in every row"] * 50 + ["the same line in every raw", "other"], width=WIDTH)
    assert len(got) == 50 and seen[0] == (3, 3) and all(n == distinct for n, distinct in seen)


def test_bitmaps_drop_pairs_far_below_the_threshold_only(spark):
    """Pairs of 5-character shingle sets, against brute force: none at 0.8 goes, nearly all below 0.5 go. Repeats count once."""
    texts = []
    for i in range(60):
        words = sentence(400 + i, 40).split()
        other = sentence(900 + i, 40).split()
        n = i % 20  # words that differ
        texts += [" ".join(words), " ".join(words[:40 - n] + other[:n])]
    texts += ["ab" * 200, "ab" * 200 + "c", "z" * 50, "z" * 300]

    def shingle_set(x):
        return {x[k:k + 5] for k in range(max(len(x) - 4, 1))}

    lines = spark.createDataFrame(list(enumerate(texts)), "key long, line string")
    pairs = spark.createDataFrame([(k, k + 1) for k in range(0, len(texts), 2)], "a long, b long")
    jaccard = {k: len(shingle_set(texts[k]) & shingle_set(texts[k + 1])) / len(shingle_set(texts[k]) | shingle_set(texts[k + 1]))
               for k in range(0, len(texts), 2)}
    got = {r.a for r in _likely(pairs, lines, 0.8, WIDTH).collect()}
    assert {k for k, j in jaccard.items() if j >= 0.8} <= got
    low = {k for k, j in jaccard.items() if j < 0.5}
    assert len(low) >= 10 and len(got & low) <= 0.1 * len(low)
    assert {r.a for r in _links(pairs, lines, 0.8, WIDTH).collect()} == {k for k, j in jaccard.items() if j >= 0.8}


def test_prefix_join_makes_few_pairs(spark):
    """Lines that share their rarest shingles but are far below the threshold are not paired; near copies are."""
    texts = []
    for i in range(40):  # 20 of 60 words each, apart so that all shingles but those of the label are common
        words = "-----".join(f"w{k:02d}{chr(97 + k % 26) * 4}" for k in random.Random(i).sample(range(60), 20))
        texts += [f"label{i // 2:03d}x-----{words}", f"label{i // 2:03d}x-----{words}#"]
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, line string")
    member = rows.select("key", F.col("key").alias("component"))
    got = {(r.a, r.b) for r in _prefix_pairs(member, rows, 0.8, WIDTH).distinct().collect()}
    assert got == {(2 * i, 2 * i + 1) for i in range(40)}


def test_crowded_buckets_are_not_exploded(spark, monkeypatch):
    """Lines far from each other in shared buckets: no table has more rows than the lines have bands, and every near copy goes."""
    written = []

    def counted(frame, label):
        out = materialize(frame, label)
        written.append((out.count(), label))
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    def letters(seed, n):
        return "".join(random.Random(seed).choices("abcdefghijklmnopqrstuvwxyz ", k=n))

    far = [letters(-1, 300) + letters(i, 200) for i in range(400)]
    got = removed(spark, far + [f"{t} end" for t in far], width=WIDTH)
    assert got <= set(range(400, 800)) and len(got) >= 0.97 * 400
    assert max(written)[0] <= 15 * 800 and {label for _, label in written} >= {"line-members", "line-links"}


def test_pairs_of_a_bucket(spark, monkeypatch):
    """Every pair at the threshold in different components, once a band, of small and of classed buckets and at the edges of classes."""
    texts = []
    for i in range(30):
        words = sentence(700 + i, 60).split()[:4 + 2 * i]
        texts += [" ".join(words), " ".join(words) + " x", " ".join(words[1:]), " ".join(words[:len(words) * 4 // 5 + 1])]
    texts += [chr(97 + i) * 4 + "".join(chr(0x4E00 + 40 * i + k) for k in range(n - 4)) for i in range(3) for n in (8, 9)]  # 4 and 5 shingles

    def shingle_set(x):
        return {x[k:k + 5] for k in range(max(len(x) - 4, 1))}

    sets = [shingle_set(t) for t in texts]
    assert {len(s) for s in sets} >= {4, 5}
    component = [k // 2 if k % 8 == 1 else k for k in range(len(texts))]  # some near copies are linked already
    main = component[5]
    alike = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))
             if component[a] != component[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    far = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if len(sets[a] & sets[b]) < 0.3 * len(sets[a] | sets[b])}
    lines = spark.createDataFrame(list(enumerate(texts)), "key long, line string")
    bitmaps = _bitmaps(lines, WIDTH)
    assert sorted((r.key, r.size) for r in bitmaps.collect()) == [(k, len(s)) for k, s in enumerate(sets)]
    member = spark.createDataFrame([(band, len(texts), main, k, component[k]) for band in (1, 2) for k in range(len(texts))],
                                   "band long, n long, main long, key long, component long")
    for most in (10, 10 ** 6):
        monkeypatch.setattr(line_dedup, "CLASSED", most)
        got = [(r.a, r.b) for r in _bucket_pairs(member, bitmaps, 0.8).collect()]
        assert len(alike) >= 60 and alike <= set(got) and all(component[a] != component[b] for a, b in got)
        assert len(got) == 2 * len(set(got)) and len(far & set(got)) <= 0.02 * len(far)


def test_discarded_tables(spark, tmp_path):
    """A table of the scratch folder goes, with its files; one that is elsewhere stays."""
    table = materialize(spark.range(10), "gone")
    folder = os.path.dirname(table.inputFiles()[0]).removeprefix("file://")
    assert os.path.isdir(folder)
    discard(table)
    assert not os.path.exists(folder)
    spark.range(10).write.parquet(f"{tmp_path}/kept")
    discard(spark.read.parquet(f"{tmp_path}/kept"))
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 10


def test_buckets_of_plain_and_crowded_bands(spark, monkeypatch):
    """Every row of a band that several lines share, with the band's number, first and last key; the same where its cell is crowded."""
    rows = [(k, k % 7) for k in range(5_000)] + [(k, 10_000 + k // 2) for k in range(60)] + [(k, -k - 1) for k in range(3_000)]
    banded = spark.createDataFrame(rows, "key long, band long")
    groups = {}
    for k, b in rows:
        groups.setdefault(b, []).append(k)
    want = sorted((b, k, len(ks), min(ks), max(ks)) for b, ks in groups.items() if len(ks) > 1 for k in ks)
    got = _buckets(banded)
    assert got.columns == ["band", "key", "n", "low", "high"] and sorted(map(tuple, got.collect())) == want
    monkeypatch.setattr(line_dedup, "CROWD_LEAST", 10)
    assert sorted(map(tuple, _buckets(banded).collect())) == want
    assert _buckets(banded.limit(0)).count() == 0


def exchanged(frame) -> int:
    """Rows that went through shuffles in the run of ``frame``."""
    def walk(node):
        name, children = node.nodeName(), node.children()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    frame.collect()
    return walk(frame._jdf.queryExecution().executedPlan())


def test_texts_that_lose_nothing_are_not_shuffled(spark):
    """Of 2,000 texts two share a line: no text but theirs goes through a shuffle, whatever reads the result."""
    texts = [(i, sentence(i, 12), "en") for i in range(2_000)] + [(5_000, sentence(7, 12) + "\nmore of this", "en"), (5_001, None, "en"), (5_002, "", "de")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    out = dedup_lines(docs, width=WIDTH)
    assert exchanged(out) < 200
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == ["doc_id", "text", "lang", "n_lines", "n_removed"] and len(got) == 2_003
    assert got[5_000].text == "more of this" and got[5_000].n_removed == 1 and got[5_000].n_lines == 2
    assert got[5_001].text is None and got[5_002].text == "" and all(got[i].text == t for i, t, _ in texts[:2_000])
