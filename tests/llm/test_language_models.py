"""The language models hold every n-gram that was counted."""

import numpy as np
from pyspark.sql import functions as F

from tripdemand.llm.langid import KneserNey, char_codes, fit_languages, fold_of, grams


def test_models_hold_every_counted_gram(spark):
    """Two languages, one with far more distinct n-grams than half a million."""
    rng = np.random.default_rng(8)
    rows = [(i, "wide", "".join(map(chr, rng.integers(0x4E00, 0x9FA0, 7000)))) for i in range(150)]
    rows += [(1000 + i, "narrow", "the cat sat on the mat and went on") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    langs, models, _, _ = fit_languages(docs)
    assert langs == ["narrow", "wide"]
    known = docs.where(fold_of(F.col("doc_id"), 3) != 1).collect()
    for lang, model in zip(langs, models):
        keys, n = np.unique(np.concatenate([grams(char_codes(r.text)) for r in known if r.lang == lang]), return_counts=True)
        want = KneserNey(keys, n)
        assert (len(keys) > 500_000) == (lang == "wide")
        assert len(model.levels) == len(want.levels)
        for got_level, want_level in zip(model.levels, want.levels):
            assert all(np.array_equal(x, y) for x, y in zip(got_level[1:], want_level[1:]))
