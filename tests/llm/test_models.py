"""Language, toxicity, personal data, token ids."""

import collections
import hashlib
import re
import zlib

import numpy as np
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.helpers import SF, awkward, frame, sentence
from tripdemand.llm import queries
from tripdemand.llm.langid import KneserNey, char_codes, grams, identify_language
from tripdemand.llm.pii import BoostedTrees, find_personal_data
from tripdemand.llm.sentencepiece_np import Encoder, decode_ids, encode_digest, encode_texts, load_model
from tripdemand.llm.toxicity import FactorizationMachine, score_toxicity


def test_token_ids_are_the_librarys():
    model = load_model(queries.PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    texts = [t for _, t in awkward() if t is not None]
    texts += ["hello  world", "  lead", "trail ", "a\nb\t c", "é ﬁ", "\r\n", " " * 57, "x" + " " * 31 + "y", "=====---- ////" * 5,
              "internationalization" * 9, "Pneumonoultramicroscopicsilicovolcanoconiosis", "    def f(x):\n        return x"]
    for text, ids in zip(texts, Encoder(model).encode(texts)):
        assert ids.tolist() == library.encode(text), text[:50]
        assert model.decode(ids) == text == library.decode(ids.tolist())


def test_unigram_viterbi_is_the_best_path():
    model = load_model(queries.PIECE_MODEL)
    model.kind = 1
    rng = np.random.default_rng(1)
    model.scores = np.append(-rng.uniform(1, 10, model.size), -30.0)
    ids = dict(zip(model.keys.tolist(), model.ids.tolist()))
    for word in ("▁hello", "▁wordless", "▁interest"):
        best = {0: 0.0}
        for i in range(1, len(word) + 1):
            best[i] = max(best[j] + model.scores[ids.get(model.hash_of(word[j:i]), model.size)]
                          for j in range(max(0, i - model.longest), i)
                          if model.hash_of(word[j:i]) in ids or i - j == 1)
        got = model._viterbi([word])[0]
        assert abs(model.scores[got].sum() - best[len(word)]) < 1e-9


def test_encoder_holds_few_words_at_a_time(monkeypatch):
    """A batch of many long texts is cut into words in slices; rare characters and runs of spaces among them; the ids are the library's."""
    model = load_model(queries.PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    texts = [" ".join(f"w{k}x{i}é" for k in range(10_000)) + f"  你{i}🤖 \u0378 end" for i in range(8)]
    texts += [None, "", "你" * 40 + " \u0378\u0379", texts[0]]
    seen, whole = [], model.encode_words
    monkeypatch.setattr(model, "encode_words", lambda words: seen.append(sum(map(len, words))) or whole(words))
    for text, ids in zip(texts, Encoder(model).encode(texts), strict=True):
        assert ids.tolist() == library.encode(text or "")
    assert sum(seen) > 600_000 and max(seen) <= 1 << 19


def test_encode_frames(spark):
    rows = awkward()
    out = encode_texts(frame(spark, rows), queries.PIECE_MODEL)
    back = decode_ids(out, queries.PIECE_MODEL, into="again").select("text", "again", "n_tokens").collect()
    assert len(back) == len(rows)
    assert all(r.again == (r.text or "") and (r.n_tokens > 0) == bool(r.text) for r in back)
    digest = encode_digest(frame(spark, rows), queries.PIECE_MODEL).collect()
    assert len(digest) == len(rows) and all(r.round_trip for r in digest)
    assert encode_texts(frame(spark, []), queries.PIECE_MODEL).count() == 0


def test_kneser_ney_sums_to_one():
    text = "the cat sat on the mat and the dog sat on the cat " * 3
    keys, n = np.unique(grams(char_codes(text)), return_counts=True)
    model = KneserNey(keys, n)
    chars = np.unique(char_codes(text))
    for context in ("the", " th", "cat", "zzz", "q t"):
        c = 0
        for ch in context:
            c = c << 16 | ord(ch)
        p = model.prob(np.array([c << 16 | int(x) for x in chars], np.uint64) & np.uint64((1 << 64) - 1))
        assert 0 < p.sum() <= 1 + 1e-9 and p.min() > 0
    assert model.prob(np.array([0], np.uint64))[0] > 0


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.held_out for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1} == {True}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(spark):
    rows = awkward()
    got = identify_language(frame(spark, rows)).collect()  # no label at all
    assert len(got) == len(rows) and {r.lang_pred for r in got} == {"und"}
    known = frame(spark, rows + [(100 + i, sentence(i, 40)) for i in range(30)]).withColumn("lang", F.lit("xx"))
    by = {r.doc_id: r for r in identify_language(known).collect()}
    assert by[4].lang_pred == "xx" and by[1].lang_pred == by[2].lang_pred == by[14].lang_pred == "und"
    assert identify_language(frame(spark, [])).count() == 0


def test_machine_learns_an_interaction():
    """Label 1 only where both features meet: no linear weights can rank that above each alone."""
    rng = np.random.default_rng(0)
    x = rng.random((4000, 6)) < 0.4
    y = (x[:, 0] & x[:, 1]).astype(float)
    ids = [np.flatnonzero(r) for r in x]
    starts = np.concatenate([[0], np.cumsum([len(i) for i in ids])[:-1]])
    m = FactorizationMachine(6)
    m.fit(np.concatenate(ids), starts, y, rounds=400)
    p = m.score(np.concatenate(ids), starts, len(y))
    assert p[y == 1].min() > 0.5 > p[y == 0].max()


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op9_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit / sum(r.predicted for r in got) > 0.9 and hit / sum(r.toxic for r in got) > 0.8
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        got = score_toxicity(frame(spark, awkward()), known).collect()
        assert len(got) == len(awkward()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert score_toxicity(frame(spark, []), labels).count() == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_personal_data(spark):
    hard = ["a@b.c_d@e.fg x@y", "1.2.3.4.5.6.7.8 300.1.1.1 1.2.3 01.002.3.255", "4111 1111-1111 1111 and 4111111111111112",
            "+1 (017) 555-7713 190. +12 +1234567890123456", "é+49 30 123456-78 ü a.b%c@d-e.f.g.", "call 555-123-4567 now",
            "7" * 5000 + " " + "a" * 5000, "a@b" + ".c" * 3000, "mail john at x, john(at)example(dot)org", "x@y.z,1.2.3.4"]
    rows = awkward() + [(50 + i, t) for i, t in enumerate(hard)]
    got = collections.defaultdict(list)
    for r in find_personal_data(frame(spark, rows)).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for d, t in rows:
        if d is not None:
            want = brute_spans(t)
            for r in got[d]:
                assert r.base_spans == want and set(want) <= set(r.spans)
                assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in BASE]
    assert find_personal_data(frame(spark, [])).count() == 0


def test_personal_data_on_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op3_personal_data(spark, SF).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(brute_spans(docs[r.doc_id])).encode()).hexdigest()


def test_boosted_trees():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 10, (500, 3))
    n = rng.integers(1, 5, 500).astype(float)
    pos = n * ((x[:, 0] > 4) & (x[:, 2] <= 3))
    t = BoostedTrees()
    t.fit(x, pos, n)
    p = t.predict(x)
    assert p[pos > 0].min() > 0.6 and p[pos == 0].max() < 0.4
