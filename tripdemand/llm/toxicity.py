"""Toxicity scores from a factorization machine over hashed terms.

logit = b + sum_i w_i + sum_{i<j} <v_i, v_j> over the distinct terms i of a
text. The linear weights alone score "insult" and "group mention" apart; the
factors learn what their meeting in one text adds.

Terms are lower-cased words and their first 4 to 7 characters, hashed to 2**20
buckets. Term counts per label come from a distributed count over the training
sample; the most telling terms (chi square) enter the machine, which is
fitted on the driver on at most ``train_rows`` rows of at most ``terms`` terms.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.common import materialize

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6, 7)
_WORD = re.compile(r"\w+")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def word_terms(word: str) -> list[int]:
    """Buckets of a word: the whole word and its prefixes."""
    raw = [f"w {word}"] + [f"p {word[:k]}" for k in PREFIXES if len(word) > k]
    return [zlib.crc32(t.encode()) % BUCKETS for t in raw]


def text_terms(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of a text."""
    if not text:
        return np.empty(0, np.int64)
    out: set[int] = set()
    for w in set(_WORD.findall(text.lower())):
        out.update(word_terms(w))
    return np.sort(np.fromiter(out, np.int64, len(out)))


class TermIndex:
    """Features of a text: its selected terms and, after them, "at least k words hold a telling
    term" for k = 1 to 4, which let one clear word count whatever usually stands beside it."""

    STEPS = 4

    def __init__(self, selected: np.ndarray, telling: np.ndarray):
        self.at = {int(t): i for i, t in enumerate(selected)}
        self.telling = telling
        self.n = len(selected) + self.STEPS
        self.known: dict[str, tuple] = {}

    def features(self, text: str | None) -> np.ndarray:
        ids: set[int] = set()
        words = 0
        for w in set(_WORD.findall(text.lower())) if text else ():
            got = self.known.get(w)
            if got is None:
                if len(self.known) > 1 << 19:
                    self.known.clear()
                hit = tuple(self.at[t] for t in word_terms(w) if t in self.at)
                got = self.known[w] = (hit, bool(hit) and bool(self.telling[list(hit)].any()))
            if got[0]:
                ids.update(got[0])
                words += got[1]
        ids.update(range(self.n - self.STEPS, self.n - self.STEPS + min(words, self.STEPS)))
        return np.fromiter(sorted(ids), np.int64, len(ids))


class FactorizationMachine:
    """Second-order factorization machine on binary features, log loss, full-batch Adam."""

    def __init__(self, n: int, factors: int = 4, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.b, self.w = 0.0, np.zeros(n)
        self.v = rng.normal(0, 0.05, (factors, n))
        self.scale, self.shift = 1.0, 0.0

    def raw(self, ids: np.ndarray, starts: np.ndarray, n_rows: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Logits of rows given as the concatenated feature ids of each."""
        row = np.repeat(np.arange(n_rows), np.diff(np.append(starts, len(ids))))
        z = self.b + np.bincount(row, self.w[ids], n_rows)
        sums = []
        for v in self.v:
            x = v[ids]
            s = np.bincount(row, x, n_rows)
            z = z + 0.5 * (s * s - np.bincount(row, x * x, n_rows))
            sums.append(s)
        return z, sums

    def score(self, ids: np.ndarray, starts: np.ndarray, n_rows: int) -> np.ndarray:
        z = self.scale * self.raw(ids, starts, n_rows)[0] + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def fit(self, ids, starts, y, rounds: int = 200, rate: float = 0.05, l2: float = 2e-4) -> None:
        n_rows, n = len(y), len(self.w)
        row = np.repeat(np.arange(n_rows), np.diff(np.append(starts, len(ids))))
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.b = float(np.log(share / (1 - share)))
        params = np.concatenate([[self.b], self.w, self.v.ravel()])
        m, s = np.zeros_like(params), np.zeros_like(params)
        for t in range(1, rounds + 1):
            z, sums = self.raw(ids, starts, n_rows)
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n_rows
            gr = g[row]
            grads = [np.array([g.sum()]), np.bincount(ids, gr, n) + l2 * self.w]
            for k, v in enumerate(self.v):
                grads.append(np.bincount(ids, gr * (sums[k][row] - v[ids]), n) + l2 * v)
            grad = np.concatenate(grads)
            m = 0.9 * m + 0.1 * grad
            s = 0.999 * s + 0.001 * grad * grad
            params = params - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
            self.b, self.w = float(params[0]), params[1:n + 1]
            self.v = params[n + 1:].reshape(self.v.shape)

    def calibrate(self, ids, starts, y) -> None:
        """Platt scaling on rows the machine was not fitted on (Newton steps, prior-smoothed targets)."""
        z = self.raw(ids, starts, len(y))[0]
        pos = y.sum()
        target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (len(y) - pos + 2))
        a, c = 1.0, 0.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * z + c, -40, 40)))
            g = np.array([((p - target) * z).sum() + 1e-2 * (a - 1), (p - target).sum() + 1e-2 * c])
            q = p * (1 - p)
            h = np.array([[(q * z * z).sum() + 1e-2, (q * z).sum()], [(q * z).sum(), q.sum() + 1e-2]])
            d = np.linalg.solve(h, g)
            a, c = a - float(np.clip(d[0], -1, 1)), c - float(np.clip(d[1], -1, 1))
        self.scale, self.shift = max(a, 1e-3), c


def _csr(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(rows) else np.empty(0, np.int64)
    return (np.concatenate(rows) if len(rows) else np.empty(0, np.int64)).astype(np.int64), starts.astype(np.int64)


def fit_toxicity(documents: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2,
                 train_rows: int = 40_000, terms: int = 1024, min_rows: int = 4):
    """(term index, machine) learned from the labelled rows outside the held-out fold.

    ``train_rows`` bounds the rows fitted on (taken by the hash of the id, so
    the same whatever the partitioning); all rows are used if there are fewer.
    Repeated labels of a doc_id count once, as toxic if one says so; null
    labels and ids are skipped.
    """
    known = labels.where("doc_id is not null and toxic is not null") \
        .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")) \
        .where(fold_of(F.col("doc_id"), folds) != held_out)
    known = materialize(known, "toxic-labels")
    total = known.count()
    share = min(1.0, 0.95 * train_rows / max(total, 1))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(train_rows)
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, pos = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["toxic"]):
                t = text_terms(text)
                n[t] += 1
                if y:
                    pos[t] += 1
        at = np.flatnonzero(n)
        for k in range(0, len(at), 1 << 17):
            part = at[k:k + (1 << 17)]
            yield pd.DataFrame({"term": part, "n": n[part], "pos": pos[part]})

    sizes = rows.groupBy().agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos")).first()
    n_all, n_pos = int(sizes["n"]), int(sizes["pos"])
    if not 0 < n_pos < n_all:
        machine = FactorizationMachine(TermIndex.STEPS)
        share = (n_pos + 0.5) / (n_all + 1) if n_all else 0.0
        machine.b = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return TermIndex(np.empty(0, np.int64), np.empty(0, bool)), machine
    # chi square of term and label, from counts over every row of the sample
    a, n = F.col("pos").cast("double"), F.col("n").cast("double")
    expected = n * n_pos / n_all
    chi = F.pow(a - expected, 2) / (expected * (1 - n / (n_all + 1)) * (1 - n_pos / n_all) + 1e-9)
    best = rows.mapInPandas(count, "term long, n long, pos long").groupBy("term") \
        .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).where(F.col("n") >= min_rows) \
        .orderBy(chi.desc(), "term").limit(terms).toPandas().sort_values("term")
    n, pos = best["n"].to_numpy(), best["pos"].to_numpy()
    odds = np.log((pos + 0.5) / (n - pos + 0.5)) - np.log(n_pos / (n_all - n_pos))
    index = TermIndex(best["term"].to_numpy(np.int64), (odds > 2) & (pos >= 5))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"].to_numpy(), "ids": [index.features(t) for t in pdf["text"]]})

    data = rows.mapInPandas(encode, "toxic int, ids array<int>").toPandas()
    # an order that does not depend on how the rows were dealt to tasks
    order = sorted(range(len(data)), key=lambda i: (zlib.crc32(np.asarray(data["ids"][i], np.int32).tobytes()), data["toxic"][i]))
    ids = [np.asarray(data["ids"][i], np.int64) for i in order]
    y = data["toxic"].to_numpy(float)[order]
    part = np.arange(len(y)) % 5 == 4
    machine = FactorizationMachine(index.n)
    fit_ids, fit_starts = _csr([x for x, p in zip(ids, part) if not p])
    machine.fit(fit_ids, fit_starts, y[~part])
    if part.sum() >= 20:
        machine.calibrate(*_csr([x for x, p in zip(ids, part) if p]), y[part])
    return index, machine


def toxicity_scorer(index: TermIndex, machine: FactorizationMachine):
    """Column function text -> score (double, 0 to 1) of a fitted machine; null and empty texts
    get the score of a text without known terms."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            rows = [index.features(t) for t in texts]
            yield pd.Series(machine.score(*_csr(rows), len(rows)))

    return score


def score_toxicity(documents: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2,
                   threshold: float = 0.3, **fit) -> DataFrame:
    """Every row of ``documents`` with score (0 to 1), predicted (1 if score >= threshold) and held_out.

    All columns of ``documents`` are kept; a column of the same name as a
    result column is replaced. Only the text is scored. Null and empty texts
    get the score of a text without known terms; without labels, or with
    labels of one class only, every text gets that class's smoothed share.
    Empty tables give empty results; rows with a null doc_id are scored and
    never trained on.
    """
    index, machine = fit_toxicity(documents, labels, folds, held_out, **fit)
    score = toxicity_scorer(index, machine)
    return documents.withColumn("score", score(F.col("text"))) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int")) \
        .withColumn("held_out", F.coalesce(fold_of(F.col("doc_id"), folds) == held_out, F.lit(False)))
