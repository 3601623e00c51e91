"""Language identification with interpolated Kneser-Ney character models.

One model per language over the last three characters. Letters are
lower-cased, everything else is one space. n-grams are 16 bits a character
packed into 64-bit keys; a model is a few sorted arrays of keys with counts
next to them, probed by binary search. The language whose model needs the
fewest nats per character wins; the score is a calibrated posterior.

Counts come from all training texts: each task counts its own distinct
n-grams, Spark sums them. Lower orders and their continuation counts follow
from the distinct n-grams of the top order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.common import ids_as_text, ids_back, materialize
from tripdemand.llm.toxicity import fold_of

ORDER = 4
CHUNK_CHARS = 1 << 20


class _Letters:
    """Is a 16-bit code a letter? Built once per process from Python's own tables."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.array([chr(i).isalpha() for i in range(1 << 16)])
        return cls.table


def char_codes(text: str) -> np.ndarray:
    """Lower-cased letters as 16-bit codes, each run of anything else one space, one at both
    ends; empty if there is no letter. Letters beyond 16 bits count as U+FFFD."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    wide = cp > 0xFFFF
    code = np.where(wide, 0xFFFD, cp).astype(np.int64)
    letter = _Letters.get()[code]
    for i in np.flatnonzero(wide):
        letter[i] = chr(cp[i]).isalpha()
    if not letter.any():
        return np.empty(0, np.uint64)
    code[~letter] = 32
    code = np.concatenate([[32], code, [32]])
    space = code == 32
    keep = ~(space[1:] & space[:-1])
    return np.concatenate([[32], code[1:][keep]]).astype(np.uint64)


def grams(codes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """One packed n-gram per character after the first, its context padded with spaces."""
    padded = np.concatenate([np.full(order - 2, 32, np.uint64), codes])
    n = len(padded) - order + 1
    out = np.zeros(n, np.uint64)
    for k in range(order):
        out = (out << np.uint64(16)) | padded[k:k + n]
    return out


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, inverse = np.unique(keys, return_inverse=True)
    return at, np.bincount(inverse, values, len(at))


def _probe(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of ``wanted`` in a sorted key array, 0 where absent."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


class KneserNey:
    """Interpolated Kneser-Ney model of one language from its counted top-order n-grams."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.levels = []
        keys, counts = keys.astype(np.uint64), counts.astype(float)
        for n in range(order, 0, -1):
            n1, n2 = float((counts == 1).sum()), float((counts == 2).sum())
            discount = min(max(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.1), 0.95)
            context = keys >> np.uint64(16)
            ckeys, total = _sum_by(context, counts)
            _, kinds = _sum_by(context, np.ones(len(context)))
            self.levels.append((n, keys, np.maximum(counts - discount, 0), ckeys, total, discount * kinds))
            if n > 1:  # continuation counts: in how many contexts the shorter n-gram was seen
                low = keys & np.uint64((1 << 16 * (n - 1)) - 1)
                keys, counts = _sum_by(low, np.ones(len(low)))
        self.uniform = 1.0 / (len(self.levels[-1][1]) + 1)

    def prob(self, wanted: np.ndarray) -> np.ndarray:
        p = np.full(len(wanted), self.uniform)
        for n, keys, counts, ckeys, total, mass in reversed(self.levels):
            key = wanted & np.uint64((1 << 16 * n) - 1)
            context = key >> np.uint64(16)
            t = _probe(ckeys, total, context)
            seen = t > 0
            got = (_probe(keys, counts, key) + _probe(ckeys, mass, context) * p) / np.where(seen, t, 1.0)
            p = np.where(seen, got, p)
        return p


def entropies(texts: list[str | None], models: list[KneserNey]) -> tuple[np.ndarray, np.ndarray]:
    """(nats per character of each text under each model, characters); nan without letters."""
    out, sizes = np.full((len(texts), len(models)), np.nan), np.zeros(len(texts), np.int64)
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if not held:
            return
        lengths = np.array([len(g) for _, g in held])
        kinds, inverse = np.unique(np.concatenate([g for _, g in held]), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        rows = [i for i, _ in held]
        for j, m in enumerate(models):
            out[rows, j] = np.add.reduceat(-np.log(m.prob(kinds))[inverse], starts) / lengths
        sizes[rows] = lengths
        held.clear()

    waiting = 0
    for i, t in enumerate(texts):
        codes = char_codes(t) if t else np.empty(0, np.uint64)
        if len(codes):
            held.append((i, grams(codes)))
            waiting += len(codes)
            if waiting > CHUNK_CHARS:
                flush()
                waiting = 0
    flush()
    return out, sizes


def posterior(h: np.ndarray, sizes: np.ndarray, sharpness: float) -> np.ndarray:
    """Softmax of the cross-entropies; more characters weigh more, with saturation."""
    z = -h * sharpness * np.sqrt(np.minimum(sizes, 400))[:, None]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit_languages(documents: DataFrame, folds: int = 3, held_out: int = 1, calibration_rows: int = 4_000):
    """(languages, models, sharpness, reject below) from the rows outside the held-out fold.

    All of them are counted, and the models hold every n-gram that was counted: they grow with the number of
    distinct n-grams of a language, on the driver and in the tasks. ``calibration_rows`` bounds the rows (by
    hash of the id) that sharpness and rejection are fitted on.
    """
    known = documents.where(F.col("lang").isNotNull() & (fold_of(F.col("doc_id"), folds) != held_out)) \
        .select("doc_id", "lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[np.ndarray]] = {}
        done: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def fold(lang: str) -> None:
            keys, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            if lang in done:
                keys = np.concatenate([done[lang][0], keys])
                keys, n = _sum_by(keys, np.concatenate([done[lang][1], n]))
            done[lang] = keys, n

        def out(lang: str) -> pd.DataFrame:
            keys, n = done.pop(lang)
            return pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": n.astype(np.int64)})

        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                codes = char_codes(text) if text else ()
                if len(codes):
                    held.setdefault(lang, []).append(grams(codes))
                    if sum(map(len, held[lang])) > CHUNK_CHARS and len(held[lang]) % 64 == 0 or len(codes) > CHUNK_CHARS:
                        fold(lang)
                        if len(done[lang][0]) > 1 << 21:
                            yield out(lang)
        for lang in list(held):
            fold(lang)
        for lang in list(done):
            yield out(lang)

    counted = materialize(known.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
                          .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-grams")
    table = counted.toPandas()
    if not len(table):
        return [], [], 1.0, 0.0
    langs = sorted(table["lang"].unique())
    models = []
    for lang in langs:
        part = table[table["lang"] == lang]
        order = np.argsort(part["gram"].to_numpy().view(np.uint64))
        models.append(KneserNey(part["gram"].to_numpy().view(np.uint64)[order], part["n"].to_numpy()[order]))
    total = known.count()
    rate = min(1.0, 0.9 * calibration_rows / max(total, 1))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(rate * (1 << 30)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, n = entropies(list(pdf["text"]), models)
            ok = n > 0
            if not ok.any():  # no text of the batch has a letter
                continue
            yield pd.DataFrame({"y": pdf["lang"].map(langs.index).to_numpy()[ok], "n": n[ok], "h": list(h[ok])})

    got = sample.mapInPandas(measure, "y int, n long, h array<double>").limit(calibration_rows).toPandas()
    sharpness, reject = 1.0, 0.0
    if len(got):
        h, n, y = np.stack(got["h"].to_list()), got["n"].to_numpy(), got["y"].to_numpy()
        trials = 0.05 * 2.0 ** np.arange(0, 9)
        loss = [-np.log(np.maximum(posterior(h, n, s)[np.arange(len(y)), y], 1e-9)).mean() + 1e-3 * s for s in trials]
        sharpness = float(trials[int(np.argmin(loss))])
        p = posterior(h, n, sharpness)
        right = p.max(axis=1)[p.argmax(axis=1) == y]
        reject = float(np.quantile(right, 0.005)) if len(right) else 0.0
    return langs, models, sharpness, reject


def identify_language(documents: DataFrame, folds: int = 3, held_out: int = 1, **fit) -> DataFrame:
    """Per row of ``documents`` (doc_id, text, lang): doc_id, held_out, lang_pred, score, rejected.

    ``lang`` is read from training rows only. Null texts and texts without a
    letter are ``und`` with score 0, and so is every text if nothing could be
    learned. ``rejected`` marks scores below the level that all but 0.5 % of
    rightly recognised training texts reach. Ties go to the first language by
    name. Repeated rows give a row each; rows with a null doc_id are predicted
    and never learned from; other columns are ignored.
    """
    langs, models, sharpness, reject = fit_languages(documents, folds, held_out, **fit)
    docs = documents.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"), "text")

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[["doc_id", "held_out"]].assign(lang_pred="und", score=0.0)
            h, n = entropies(list(pdf["text"]), models)
            ok = np.flatnonzero(n > 0) if models else np.empty(0, np.int64)
            if len(ok):
                p = posterior(h[ok], n[ok], sharpness)
                best = h[ok].argmin(axis=1)
                out["lang_pred"] = out["lang_pred"].astype(object)
                out.iloc[ok, 2] = np.array(langs, object)[best]
                out.iloc[ok, 3] = p[np.arange(len(ok)), best]
            yield out.assign(rejected=out["score"].to_numpy() < reject)

    out = ids_as_text(docs, "doc_id").mapInPandas(predict, "doc_id string, held_out boolean, lang_pred string, score double, rejected boolean")
    return ids_back(out, "doc_id", docs)
