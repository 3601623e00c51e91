"""Personal data by candidate generation and gradient boosting, in DataFrame operations only.

Generators of high recall propose spans, which may overlap: the four base kinds
(email, ip, card, phone) and looser forms (spelled-out addresses, phone numbers
without a plus, long numbers, grouped ids, IPv6, hexadecimal secrets). Boosted
trees score every proposal by its format and context. They learn from the
proposals that carry their own proof: those that a checksum, an octet range or a digit
count confirms or refutes. The threshold is calibrated on the half of
them that was not fitted on; looser proposals that reach it are added to the valid base spans.

The trees are fitted on all distinct feature vectors with their counts over all documents: on
the driver where they are at most ``2 * train_rows``, else by histograms of gradients that Spark
adds up. They are applied as SQL expressions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripdemand.llm.common import materialize

# The base patterns. Possessive quantifiers and the look-behind (or the end of the
# previous match) only spare the engine retries that cannot match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email_words": (r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\{at\})\x20?"
                    r"[A-Za-z0-9-]++(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\.)\x20?[A-Za-z0-9-]++)++"),
    "phone_local": r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "grouped_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ipv6": r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-f:])",
    "secret": r"(?i)(?<![0-9a-z])[0-9a-f]{32,}+(?![0-9a-z])",
}
#: What must be in a text for a generator to run at all: a character, or else a digit.
NEEDS = {"email": "@", "phone": "+", "email_words": "at", "ipv6": ":"}
KINDS = (*BASE, *LOOSE)
CONTEXT = 24
WORDS = r"(?i)mail|tel|phone|call|fax|card|visa|iban|ssn|address|contact|token|key|secret|password|ip\b"


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def candidates(documents: DataFrame) -> DataFrame:
    """(row, doc_id, kind, start, end, span, before, after): every proposal; one row of null kind
    for a text without any. ``row`` numbers the rows of ``documents``; offsets are code points."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text")) \
        .withColumn("digits", F.col("text").rlike("[0-9]"))
    found = []
    for kind, pattern in (BASE | LOOSE).items():
        on = F.contains("text", F.lit(NEEDS[kind])) if kind in NEEDS else F.col("digits")
        rest = F.when(on, F.split("text", pattern, -1))
        hits = F.when(on, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        found.append((kind, rest, hits))
    lists = docs.select("row", "doc_id", *[c.alias(f"{k}_{n}") for k, rest, hits in found
                                           for n, c in (("rest", rest), ("hits", hits))])

    def proposals(kind: str) -> Column:
        rest = F.col(f"{kind}_rest")
        each = F.transform(f"{kind}_hits", lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), m.alias("span"),
            (F.length(F.get(rest, i)) + F.length(m)).alias("step"),
            F.right(F.get(rest, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(rest, i + 1), F.lit(CONTEXT)).alias("after")))
        return F.coalesce(each, F.array().cast(
            "array<struct<kind:string,i:int,span:string,step:int,before:string,after:string>>"))

    structs = [proposals(kind) for kind, _, _ in found]
    each = lists.select("row", "doc_id", F.explode_outer(F.concat(*structs)).alias("c")).select("row", "doc_id", "c.*")
    end = F.sum("step").over(Window.partitionBy("row", "kind").orderBy("i"))
    return each.withColumn("end", end).withColumn("start", F.col("end") - F.length("span")) \
        .select("row", "doc_id", "kind", "start", "end", "span", "before", "after")


def proof(kind: Column, span: Column) -> Column:
    """True or false if the span itself proves or refutes its base kind; null for the loose kinds."""
    digits = F.regexp_replace(span, "[^0-9]", "")
    octets = ~F.exists(F.split(span, r"\."), lambda p: ~p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])$"))
    return F.when(kind == "email", F.lit(True)).when(kind == "ip", octets) \
        .when(kind == "card", F.length(digits).between(14, 19) & luhn(digits)) \
        .when(kind == "phone", F.length(digits).between(10, 15))


def features(c: DataFrame) -> list[Column]:
    """Small integers about a proposal's format and context."""
    span = F.col("span")

    def count(pattern: str) -> Column:
        return F.least(F.length(F.regexp_replace(span, f"[^{pattern}]", "")), F.lit(40))

    def edge(text: Column) -> Column:
        return F.when(text == "", 0).when(text.rlike(r"\s"), 1).when(text.rlike("[A-Za-z0-9]"), 2) \
            .when(text.rlike(r"[\"'=:(<\[]"), 3).otherwise(4)

    return [F.least(F.length(span), F.lit(60)), count("0-9"), count("A-Za-z"), count("A-Fa-f0-9"), count(r"\x20().-"),
            count("@"), count("."), count(":"), span.startswith("+").cast("int"),
            edge(F.right("before", F.lit(1))), edge(F.left("after", F.lit(1))), F.col("before").rlike(WORDS).cast("int"),
            F.length(F.regexp_extract(span, "[0-9]+", 0)), (F.length(F.regexp_replace(span, "[0-9]+", "")) == 0).cast("int")]


class BoostedTrees:
    """Gradient boosting (log loss) of trees of two levels on weighted rows of small integers."""

    def __init__(self, rounds: int = 30, rate: float = 0.3, smooth: float = 4.0):
        self.rounds, self.rate, self.smooth = rounds, rate, smooth
        self.base, self.trees = 0.0, []

    def _split(self, x, g, h, rows):
        best = (1e-9, None)
        total = g[rows].sum() ** 2 / (h[rows].sum() + self.smooth)
        for f in range(x.shape[1]):
            v = x[rows, f]
            order = np.argsort(v, kind="stable")
            gl, hl = np.cumsum(g[rows][order]), np.cumsum(h[rows][order])
            last = np.flatnonzero(v[order][1:] != v[order][:-1])
            if not len(last):
                continue
            gain = gl[last] ** 2 / (hl[last] + self.smooth) + (gl[-1] - gl[last]) ** 2 / (hl[-1] - hl[last] + self.smooth) - total
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, int(v[order][last[k]])))
        return best[1]

    def fit(self, x: np.ndarray, pos: np.ndarray, n: np.ndarray) -> None:
        share = np.clip(pos.sum() / n.sum(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(share / (1 - share)))
        z = np.full(len(x), self.base)
        everything = np.arange(len(x))
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            g, h = pos - n * p, n * p * (1 - p)
            root = self._split(x, g, h, everything)
            if root is None:
                break
            leaves = []
            for low in (True, False):
                rows = np.flatnonzero((x[:, root[0]] <= root[1]) == low)
                second = self._split(x, g, h, rows)
                parts = [rows] if second is None else [rows[x[rows, second[0]] <= second[1]], rows[x[rows, second[0]] > second[1]]]
                values = [self.rate * float(g[r].sum() / (h[r].sum() + self.smooth)) for r in parts]
                for r, v in zip(parts, values):
                    z[r] += v
                leaves.append((second, values))
            self.trees.append((root, leaves))

    def _split_sums(self, sums: list) -> tuple:
        """(split, gradient, Hessian) of a node from its rows (feature, value, g, h), one per value of each feature."""
        best, g, h = (1e-9, None), 0.0, 0.0
        for f in sorted({r.feature for r in sums}):
            own = sorted((r for r in sums if r.feature == f), key=lambda r: r.value)
            gl, hl = np.cumsum([r.g for r in own]), np.cumsum([r.h for r in own])
            if f == 0:
                g, h = float(gl[-1]), float(hl[-1])
            if len(own) < 2:
                continue
            gain = gl[:-1] ** 2 / (hl[:-1] + self.smooth) + (gl[-1] - gl[:-1]) ** 2 / (hl[-1] - hl[:-1] + self.smooth) \
                - gl[-1] ** 2 / (hl[-1] + self.smooth)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, int(own[k].value)))
        return best[1], g, h

    def fit_table(self, rows: DataFrame, names: list[str]) -> None:
        """``fit`` on the rows (features, pos, n) of a written table of any size.

        Only sums per node, feature and value come to the driver; features are small integers.
        """
        x = [F.col(c) for c in names]
        pos, n = rows.agg(F.sum("pos"), F.sum("n")).first()
        share = float(np.clip(pos / n, 1e-4, 1 - 1e-4))
        self.base = float(np.log(share / (1 - share)))
        values = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("long").alias("value"))
                                     for i, c in enumerate(names)]))
        for _ in range(self.rounds):
            p = self.column(x)
            shaped = rows.select(*names, (F.col("pos") - F.col("n") * p).alias("g"), (F.col("n") * p * (1 - p)).alias("h"))

            def sums(node: Column, nodes: int) -> list[list]:
                got = shaped.select(node.alias("node"), "g", "h", values.alias("v")).groupBy("node", "v.feature", "v.value") \
                    .agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
                return [[r for r in got if r.node == k] for k in range(nodes)]

            root, _, _ = self._split_sums(sums(F.lit(0), 1)[0])
            if root is None:
                break
            sides = sums(F.when(x[root[0]] <= root[1], 0).otherwise(1), 2)
            splits = [self._split_sums(s)[0] for s in sides]
            leaves = []
            for second, side in zip(splits, sides):
                on = [r for r in side if r.feature == (second[0] if second else 0)]
                parts = [on] if second is None else [[r for r in on if r.value <= second[1]], [r for r in on if r.value > second[1]]]
                leaves.append((second, [self.rate * sum(r.g for r in part) / (sum(r.h for r in part) + self.smooth) for part in parts]))
            self.trees.append((root, leaves))

    def column(self, x: list[Column]) -> Column:
        """The score (0 to 1) as an expression over the feature columns."""
        z = F.lit(self.base)
        for (f, cut), leaves in self.trees:
            side = [F.lit(v[0]) if s is None else F.when(x[s[0]] <= s[1], v[0]).otherwise(v[1]) for s, v in leaves]
            z = z + F.when(x[f] <= cut, side[0]).otherwise(side[1])
        return 1 / (1 + F.exp(-z))

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for (f, cut), leaves in self.trees:
            for (s, v), on in zip(leaves, (x[:, f] <= cut, x[:, f] > cut)):
                z += np.where(on, v[0] if s is None else np.where(x[:, s[0]] <= s[1], v[0], v[-1]), 0.0)
        return 1 / (1 + np.exp(-z))


#: Parts of the range of scores whose sums come to the driver when the threshold is found by Spark.
SCORE_BINS = 4096


def table_threshold(scored: DataFrame, precision: float) -> float:
    """The lowest score (p) down to which the share of ``pos`` in ``n`` reaches ``precision``; 1.1 if none does.

    Sums run from the highest score down: over bins on the driver, inside a bin over its different scores.
    """
    each = materialize(scored.groupBy("p").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
                       .withColumn("bin", F.floor(F.col("p") * SCORE_BINS).cast("int")), "pii-scores")
    above, pos, n = [], 0, 0
    for r in sorted(each.groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).collect(), key=lambda r: -r.bin):
        above.append((r.bin, pos, n))
        pos, n = pos + r.pos, n + r.n
    down = Window.partitionBy("bin").orderBy(F.desc("p"))
    sums = each.join(F.broadcast(each.sparkSession.createDataFrame(above, "bin int, pos0 long, n0 long")), "bin") \
        .select("p", (F.col("pos0") + F.sum("pos").over(down)).alias("pos"), (F.col("n0") + F.sum("n").over(down)).alias("n"))
    lowest = sums.where(F.col("pos") / F.col("n") >= precision).agg(F.min("p")).first()[0]
    return 1.1 if lowest is None else float(lowest)


def fit_proposals(found: DataFrame, names: list[str], precision: float = 0.98, train_rows: int = 20_000):
    """(trees, threshold) from all proposals whose proof is known.

    Up to ``2 * train_rows`` different feature vectors are fitted on the driver, more by Spark; it
    changes the way, not the model.
    """
    counted = found.where("proof is not null").groupBy(*names, (F.pmod(F.xxhash64("span"), F.lit(2)) == 0).alias("fit")) \
        .agg(F.sum(F.col("proof").cast("long")).alias("pos"), F.count("*").alias("n"))
    counted = materialize(counted, "pii-vectors")
    trees = BoostedTrees()
    if counted.limit(2 * train_rows + 1).count() > 2 * train_rows:
        fit, rest = counted.where("fit"), counted.where("not fit")
        if fit.isEmpty():
            return trees, 1.1
        trees.fit_table(fit, names)
        held = fit if rest.isEmpty() else rest
        return trees, table_threshold(held.select(trees.column([F.col(c) for c in names]).alias("p"), "pos", "n"), precision)
    rows = counted.orderBy(F.desc("n"), *names).collect()
    halves = {half: [r for r in rows if r.fit == half] for half in (True, False)}

    def arrays(rows):
        return (np.array([[r[c] for c in names] for r in rows], np.int64).reshape(len(rows), len(names)),
                np.array([r.pos for r in rows], float), np.array([r.n for r in rows], float))

    if not halves[True]:
        return trees, 1.1
    trees.fit(*arrays(halves[True]))
    x, pos, n = arrays(halves[False] or halves[True])
    p = trees.predict(x)
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(pos[order]) / np.cumsum(n[order])
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal scores stand or fall together
    fits = np.flatnonzero(last & (right >= precision))
    return trees, float(p[order][fits[-1]]) if len(fits) else 1.1


def personal_spans(documents: DataFrame, **fit) -> DataFrame:
    """(row, doc_id, kind, start, end, base, score): the chosen spans; one row of null kind for a
    text without any. Base spans are all there; an added span overlaps neither a base span nor an
    earlier proposal for adding."""
    found = candidates(documents)
    names = [f"f{i}" for i in range(14)]
    shaped = found.select("*", proof(F.col("kind"), F.col("span")).alias("proof"),
                          *[c.alias(n) for n, c in zip(names, features(found))])
    shaped = materialize(shaped.drop("before", "after"), "pii-candidates")
    trees, threshold = fit_proposals(shaped, names, **fit)
    base = F.coalesce(F.col("proof"), F.lit(False))
    loose = F.col("proof").isNull() & F.col("kind").isNotNull()
    scored = shaped.withColumn("score", trees.column([F.col(n) for n in names])).withColumn("base", base)
    # refuted base proposals and proposals below the threshold go; the row of a text stays
    scored = scored.withColumn("kind", F.when(F.col("base") | (loose & (F.col("score") >= threshold)), F.col("kind"))) \
        .select("row", "doc_id", "kind", "start", "end", "base", "score")
    place = Window.partitionBy("row").orderBy("start", F.desc("base"), "end")
    before, after = place.rowsBetween(Window.unboundedPreceding, -1), place.rowsBetween(1, Window.unboundedFollowing)
    reach = F.max(F.when(F.col("kind").isNotNull(), F.col("end"))).over(before)
    coming = F.min(F.when(F.col("base") & F.col("kind").isNotNull(), F.col("start"))).over(after)
    clear = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(coming, F.col("end")) >= F.col("end"))
    return scored.withColumn("clear", clear).withColumn("kind", F.when(F.col("base") | F.col("clear"), F.col("kind"))).drop("clear")


def find_personal_data(documents: DataFrame, **fit) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans.

    The counts and ``base_spans`` (array of kind:start:end by start, then kind) hold the valid base
    matches, leftmost and not overlapping per kind; ``spans`` also the added ones. Null
    and empty texts have none. Repeated rows give a row each, null doc_ids are kept, other
    columns are ignored, an empty table gives an empty result.
    """
    spans = personal_spans(documents, **fit)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    entry = F.struct("start", rank.alias("rank"), F.concat_ws(":", "kind", "start", "end").alias("s"))

    def listed(on: Column) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(on, entry))), lambda x: x["s"])

    is_base = F.col("base") & F.col("kind").isNotNull()
    return spans.groupBy("row", "doc_id").agg(
        *[F.sum(F.when(is_base & (F.col("kind") == k), 1).otherwise(0)).cast("long").alias(f"n_{k}") for k in BASE],
        listed(is_base).alias("base_spans"), listed(F.col("kind").isNotNull()).alias("spans")).drop("row")
