"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Every window of ``width`` consecutive words of a benchmark item is a set whose
containment in a text must be whole, so its necessary prefix is one token: its
rarest word, by counts over the whole corpus. Only those words are joined.
Positional bounds (the words next to the match must fit too) discard most
candidates; the rest are verified by comparing the item's words to the left
and right of the match with the text's, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripdemand.llm.common import bounded_broadcast, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of item words that may be broadcast (about 1 kB each); beyond it the join shuffles.
BROADCAST_ROWS = 100_000


def words(text: Column) -> Column:
    """The words of a text: ASCII letters (lower-cased), digits and non-ASCII characters."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _matching(ours: Column, theirs) -> Column:
    """Length of the common prefix: ``theirs(i)`` is what must equal ``ours[i]``."""
    bad = F.array_position(F.transform(ours, lambda w, i: F.coalesce(w == theirs(i), F.lit(False))), F.lit(False))
    return F.when(bad == 0, F.size(ours)).otherwise(bad - 1).cast("int")


def _anchors(documents: DataFrame, benchmark: DataFrame, width: int) -> DataFrame:
    """(word, item_id, width, before, after): the rarest word of each window, with its item's
    words to the left (nearest first) and to the right."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words")) \
        .where((F.size("words") > 0) & F.col("item_id").isNotNull()).dropDuplicates()
    items = materialize(items, "decon-items")
    vocabulary = materialize(items.select(F.explode("words").alias("word")).distinct(), "decon-vocabulary")
    counts = documents.select(F.explode_outer(words(F.col("text"))).alias("word")) \
        .join(bounded_broadcast(vocabulary, BROADCAST_ROWS), "word").groupBy("word").agg(F.count("*").alias("n"))
    counts = materialize(counts, "decon-counts")
    windows = items.withColumn("width", F.least(F.lit(width), F.size("words"))) \
        .withColumn("start", F.explode(F.expr("sequence(0, size(words) - width)"))) \
        .select("item_id", "words", "width", "start",
                F.posexplode(F.expr("slice(words, start + 1, width)")).alias("at", "word"))
    rarest = windows.join(counts, "word", "left").groupBy("item_id", "words", "width", "start").agg(
        F.min_by(F.struct((F.col("start") + F.col("at")).alias("q"), "word", "n"),
                 F.struct(F.coalesce("n", F.lit(0)), F.col("word"), F.col("at"))).alias("t"))
    return rarest.where("t.n is not null").select("item_id", "words", "width", "t.q", "t.word").distinct().select(
        "word", "item_id", "width",
        F.expr("reverse(slice(words, greatest(q - width + 1, 0) + 1, least(q, width - 1)))").alias("before"),
        F.expr("slice(words, q + 2, width - 1)").alias("after"))


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Matches (doc_id, text_hash, item_id, lo, hi): words lo..hi of the text are inside
    occurrences of the item's windows."""
    anchors = materialize(_anchors(documents, benchmark, width), "decon-anchors")
    small = bounded_broadcast(anchors, BROADCAST_ROWS)
    text = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    found = text.select("doc_id", "text_hash", "words", F.posexplode_outer("words").alias("p", "word"))
    lo = F.greatest(F.col("p") - (width - 1), F.lit(0))
    context = F.slice("words", lo + 1, 2 * width - 1)
    if small is anchors:  # too many item words for a broadcast: shuffle the words with what surrounds them
        around = found.select("doc_id", "text_hash", "p", "word", (F.col("p") - lo).alias("here"), context.alias("ctx"))
        pairs = around.join(anchors, "word")
    else:  # the words stay where they are; only the surroundings of matches whose neighbours fit are copied
        near = (F.col("width") == 1) | F.coalesce(F.get("before", F.lit(0)) == F.get("words", F.col("p") - 1), F.lit(False)) \
            | F.coalesce(F.get("after", F.lit(0)) == F.get("words", F.col("p") + 1), F.lit(False))
        pairs = found.join(small, "word").where(near).withColumn("here", F.col("p") - lo) \
            .withColumn("ctx", context).drop("words")
    # written, so that the verification below is not merged into the join's condition
    pairs = materialize(pairs, "decon-candidates")
    sized = pairs.withColumn("l", _matching(F.col("before"), lambda i: F.get("ctx", F.col("here") - 1 - i))) \
        .withColumn("r", _matching(F.col("after"), lambda i: F.get("ctx", F.col("here") + 1 + i)))
    return sized.where("l + r + 1 >= width").select(
        "doc_id", "text_hash", "item_id", (F.col("p") - F.col("l")).alias("lo"), (F.col("p") + F.col("r")).alias("hi"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_words, n_hit, n_items, items (sorted
    item_ids as strings), contaminated.

    A window is ``width`` consecutive words of an item, or the whole item if it
    has fewer but some. A word of the text is hit if it lies inside an
    occurrence of a window; windows may overlap. Null or empty texts and texts
    without words have 0 words and no hit; null item ids or texts are no
    items; repeated items count once, repeated document rows give a row each.
    Null doc_ids are kept. Other columns are ignored; an empty benchmark hits nothing.
    """
    hits = benchmark_hits(documents, benchmark, width).distinct()
    order = Window.partitionBy("doc_id", "text_hash").orderBy("lo", "hi", "item_id")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("hi") - F.greatest(F.coalesce(reach, F.lit(-1)), F.col("lo") - 1))
    per_text = hits.withColumn("fresh", fresh).groupBy("doc_id", "text_hash").agg(
        F.sum("fresh").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
    base = documents.select("doc_id", F.xxhash64("text").alias("text_hash"),
                            F.size(words(F.col("text"))).cast("long").alias("n_words"))
    joined = base.alias("d").join(per_text.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id"))
                                  & (F.col("d.text_hash") == F.col("h.text_hash")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "d.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
