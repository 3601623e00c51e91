"""Ids beside nulls, long loose spans, letterless samples, tag attributes, rows that share an id."""


import pytest

import corpus_pipeline
from tests.llm.helpers import SF, sentence
from tripdemand.llm.html_extract import extract_main_text, parse
from tripdemand.llm.langid import identify_language
from tripdemand.llm.ngram_join import ngram_jaccard_join
from tripdemand.llm.pii import find_personal_data
from tripdemand.llm.queries import PIECE_MODEL
from tripdemand.llm.sentencepiece_np import encode_digest
from tripdemand.llm.suffix_dedup import remove_repeats

BIG = [2**60 + 1, 2**60 + 3, None, 7]


def test_large_ids_beside_a_null(spark):
    """64-bit ids that floats cannot tell apart, in one batch with a null id."""
    same = "Ab cd " * 200
    rows = [(BIG[0], sentence(1, 40) + same, "en"), (BIG[1], sentence(2, 40) + same, "de"), (None, sentence(3, 40), "en"), (7, sentence(4, 40), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)

    def ids(df, name="doc_id"):
        return sorted((r[name] for r in df.collect()), key=str)

    want = sorted(BIG, key=str)
    joined = ngram_jaccard_join(docs)
    assert ids(joined) == want and {r.component_id for r in joined.collect() if r.doc_id} == {*BIG} - {None}
    assert ids(identify_language(docs)) == want and ids(encode_digest(docs, PIECE_MODEL)) == want
    removed = {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()}
    assert set(removed) == set(BIG)
    assert removed[BIG[0]] >= 1190 and removed[BIG[1]] >= 1190 and not removed[None] and not removed[7]
    pages = spark.createDataFrame([(i, f"http://h/{k}", f"<p>{sentence(k, 30)}</p>") for k, i in enumerate(BIG)], "page_id long, url string, html string").coalesce(1)
    assert ids(extract_main_text(pages), "page_id") == want


def test_long_loose_spans(spark):
    """A generator reads a very long text once: no recursion, no cap on a part."""
    texts = ["john(at)b" + ".c" * 100_000, "x" * 300 + "(at)example(dot)com", "key " + "0123456789abcdef" * 10_000, "a(at)" * 20_000]
    got = {r.doc_id: r for r in find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(got) == len(texts)


@pytest.mark.parametrize("langs", [["en"], ["en", "de"]])
def test_letterless_training_texts(spark, langs):
    rows = [(i, "123 456", langs[i % len(langs)]) for i in range(6)]
    got = identify_language(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)).collect()
    assert [r.lang_pred for r in got] == ["und"] * 6


@pytest.mark.parametrize("page, text", [
    ("<article style='overflow:hidden'><p>Kept text here.</p></article>", "Kept text here."),
    ("<div data-hidden='false'><p>Kept text here.</p></div>", "Kept text here."),
    ("<article data-role='dialog'><p>Kept text here.</p></article>", "Kept text here."),
    ("<article><p title='the hidden truth'>Kept text here.</p></article>", "Kept text here."),
    ("<article><p alt=it's>The story isn't told.</p></article>", "The story isn't told."),
    ("<article><p hidden>Gone.</p><p class = x hidden=''>Gone.</p><p>Kept.</p></article>", "Kept."),
])
def test_tag_attributes(page, text):
    blocks, _ = parse(page)
    assert " ".join(b.text for b in blocks if not b.ruled_out) == text


def test_broken_tags_are_read_once():
    import time
    start = time.perf_counter()
    parse("<a " * 40_000 + '"')
    parse("<a x='" * 40_000)
    assert time.perf_counter() - start < 5


def test_rows_that_share_an_id_are_judged_by_their_text(spark):
    x, unique, other = sentence(1, 60), sentence(2, 60), sentence(3, 60)
    rows = [(1, x), (5, x), (5, unique), (6, other), (6, other), (None, x), (None, sentence(4, 60)), (8, None), (9, ""), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, x), (5, unique), (6, other), (None, sentence(4, 60)), (8, None), (9, ""), (9, "")], key=str)
