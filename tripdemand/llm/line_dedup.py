"""Fuzzy line deduplication by MinHash, in DataFrame operations only.

A line's shingles are its overlapping substrings of ``width`` characters, one at
every position, as op5 and the pipeline have it (``WIDTH``). Without a width they are pairs of
neighbouring pieces of words of up to 8 characters. Each of ``rows`` * ``rows`` minima is taken over the shingle hashes under
another exclusive-or mask, which reorders them. The minima form a square, whose rows, columns and diagonals
are the bands: they bring lines together that share at least one band. What meets is compared by
the exact Jaccard similarity of the shingle sets, and the links are closed
to components by a distributed union-find. Of each component the first line
stays: the one of the smallest (doc_id, line number).

All lines of a bucket are compared, but not twice over: first each with a few
leaders, which are aggregates of the bucket. What that links needs no further
comparison inside; the lines of a bucket that are in different components after it
are paired with each other, inside the join of the bucket with itself where no more than ``few`` lines are
outside the bucket's largest component, and else by an exact prefix filter (rarest shingles
first, bounded by position). Both find every pair at the threshold.

Before shingle sets are compared, and in both joins, pairs are held against the sizes of the sets and
parity bitmaps of them: the bits in which two differ are at most the shingles that only one
has, so a pair that differs in too many cannot be at the threshold. Bands that lines share by chance
grow with the square of the corpus; what of them is written are rows of buckets, a line at most once a band, and
the pairs that their bitmaps let pass, not the shingles nor the pairs of these buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.common import connected_components, discard, free_shuffles, materialize

PIECE = r"\S{1,8}"
#: Characters of a shingle in op5 and the pipeline.
WIDTH = 5
#: Positions of shingles in a chunk of a line: substrings are cut from chunks, as cutting counts characters from the start.
CHUNK = 16
#: Words of the fixed-size filter of candidate lines: 2**18 rows of 64 bits, whatever the corpus.
FILTER_WORDS = 1 << 18
#: Cells of band hashes by which crowded bands are found: a cell is crowded beyond CROWD times the mean and CROWD_LEAST rows.
CELLS = 1 << 12
CROWD, CROWD_LEAST = 4, 100_000
#: Words of 64 bits of a line's bitmap, and in the prefix filter: a bit is set if an odd number of shingles falls on it.
BITMAP_WORDS = 16
PARITY_WORDS = 4
#: Lines of a bucket beyond which it is joined with itself by classes of size.
CLASSED = 256


def shingle_hashes(line: Column) -> Column:
    """Distinct hashes of the piece pairs of a line; of its one piece if there is only one."""
    pieces = F.regexp_extract_all(line, F.lit(PIECE), F.lit(0))
    hashed = F.transform(pieces, lambda p: F.xxhash64(p))
    pairs = F.zip_with(F.slice(hashed, 1, F.greatest(F.size(hashed) - 1, F.lit(0))), F.slice(hashed, 2, F.size(hashed)),
                       lambda a, b: F.xxhash64(a, b))
    return F.array_distinct(F.when(F.size(hashed) > 1, pairs).otherwise(hashed))


def _chunks(line: Column, width: int) -> Column:
    """Stretches of a line that hold each of its substrings of ``width`` characters once; a shorter line itself."""
    return F.when(F.length(line) < width, F.array(line)).otherwise(F.regexp_extract_all(
        line, F.lit(f"(?s)(?=(.{{{width},{CHUNK + width - 1}}})).{{1,{CHUNK}}}"), F.lit(1)))


def shingles(lines: DataFrame, width: int | None) -> DataFrame:
    """(key, h): a row per shingle of each row of ``lines`` (key, line), repeats included."""
    if width is None:
        return lines.select("key", F.explode(shingle_hashes(F.col("line"))).alias("h"))
    return lines.select("key", F.explode(_chunks(F.col("line"), width)).alias("chunk")) \
        .select("key", "chunk", F.explode(F.sequence(F.lit(1), F.greatest(F.length("chunk") - (width - 1), F.lit(1)))).alias("at")) \
        .select("key", F.xxhash64(F.substring("chunk", F.col("at"), F.lit(width))).alias("h"))


def masks(n: int) -> list[int]:
    """Masks whose top bits differ as much as possible; a multiplicative sequence modulo 2**31."""
    return [(0x5851F42D * (2 * i + 1)) & ((1 << 31) - 1) for i in range(n)]


def band_sets(rows: int) -> list[tuple[int, ...]]:
    """The rows, columns and (wrapped) diagonals of a square of minima: any two bands share at most one minimum."""
    square = [tuple(range(i * rows, (i + 1) * rows)) for i in range(rows)]
    return square + list(zip(*square)) + [tuple(square[i][(b + i) % rows] for i in range(rows)) for b in range(rows)]


def _lines(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, line, key): the lines of each text that are not blank."""
    return documents.where(F.col("text").isNotNull()) \
        .select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")) \
        .where(F.col("line").rlike(r"\S")) \
        .withColumn("key", F.xxhash64("line"))


def shingle_set(line: Column, width: int | None) -> Column:
    """Distinct shingle hashes of a line as an array; the same hashes as ``shingles``."""
    if width is None:
        return shingle_hashes(line)
    return F.array_distinct(F.flatten(F.transform(_chunks(line, width), lambda c: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(c) - (width - 1), F.lit(1))), lambda i: F.xxhash64(F.substring(c, i, F.lit(width)))))))


def _words(shingle: str, n: int) -> list[Column]:
    """Parity bitmap of the distinct hashes in the column ``shingle`` in n words b0, b1, ..., a power of two."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.expr(f"cast(shiftright({shingle}, {n.bit_length() - 1}) & 63 as int)"))
    return [F.coalesce(F.bit_xor(F.when(F.expr(f"{shingle} & {n - 1}") == w, bit)), F.lit(0).cast("long")).alias(f"b{w}") for w in range(n)]


def _sized(left: str, right: str, threshold: float) -> str:
    """SQL condition that all pairs at the threshold t meet: |A| >= t |B| and the other way round."""
    return f"least({left}.size, {right}.size) >= {threshold} * greatest({left}.size, {right}.size) - 1e-6"


def _alike(left: str, right: str, n: int, threshold: float) -> str:
    """SQL condition that all pairs at the threshold t meet: the shingles of only one are at most (1 - t) / (1 + t) (|A| + |B|)."""
    differ = " + ".join(f"bit_count({left}.b{w} ^ {right}.b{w})" for w in range(n))
    return f"{differ} <= {(1 - threshold) / (1 + threshold)} * ({left}.size + {right}.size) + 1e-6"


def _bitmaps(lines: DataFrame, width: int | None) -> DataFrame:
    """(key, size, b0, b1, ...): number and parity bitmap of the distinct shingles of ``lines`` (key, line), each key once."""
    return materialize(lines.select("key", F.explode(shingle_set(F.col("line"), width)).alias("shingle"))
                       .groupBy("key").agg(F.count("*").cast("int").alias("size"), *_words("shingle", BITMAP_WORDS)), "line-bitmaps")


def _passing(pairs: DataFrame, bitmaps: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``pairs`` (a, b) less those whose sizes or ``bitmaps`` show that they are below ``threshold``."""
    def both(rows: DataFrame, held: DataFrame, condition: str) -> DataFrame:
        p, l, r = rows.alias("p"), held.alias("l"), held.alias("r")
        return p.join(l, F.col("p.a") == F.col("l.key")).join(r, F.col("p.b") == F.col("r.key")).where(condition).select("a", "b")

    # by sizes first, so that fewer pairs take a bitmap along
    pairs = both(pairs, bitmaps.select("key", "size"), _sized("l", "r", threshold))
    return materialize(both(pairs, bitmaps, _alike("l", "r", BITMAP_WORDS, threshold)), "line-likely")


def _likely(pairs: DataFrame, lines: DataFrame, threshold: float, width: int | None) -> DataFrame:
    """``_passing`` by the bitmaps of ``lines``."""
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b"))
    return _passing(pairs, _bitmaps(_wanted(keys, lines), width), threshold)


def _links(pairs: DataFrame, lines: DataFrame, threshold: float, width: int | None) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose shingle sets have at least the Jaccard similarity ``threshold``."""
    return _exact(_likely(pairs, lines, threshold, width), lines, threshold, width)


def _exact(pairs: DataFrame, lines: DataFrame, threshold: float, width: int | None) -> DataFrame:
    """``_links`` of all ``pairs``, a written table. The texts travel, not the sets, which are several times as large."""
    held = _wanted(pairs.select(F.col("a").alias("key")).union(pairs.select("b")), lines)
    both = pairs.join(held.select(F.col("key").alias("a"), F.col("line").alias("la")), "a") \
        .join(held.select(F.col("key").alias("b"), F.col("line").alias("lb")), "b")
    # in an array of one, so that each set is made once
    sets = F.array(F.struct(shingle_set(F.col("la"), width).alias("a"), shingle_set(F.col("lb"), width).alias("b")))
    alike = F.transform(sets, lambda s: (1 + threshold) * F.size(F.array_intersect(s["a"], s["b"]))
                        >= threshold * (F.size(s["a"]) + F.size(s["b"])) - 1e-9)
    return materialize(both.where(F.get(alike, F.lit(0))).select("a", "b"), "line-links")


def _flagged(keys: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (key and others) and flag: true for those of ``keys`` and, by a fixed-size filter, for some others."""
    bits = keys.groupBy(F.expr(f"key & {FILTER_WORDS - 1}").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.expr("cast(shiftright(key, 32) & 63 as int)"))).alias("bits"))
    bits = materialize(bits, "line-filter")
    return rows.join(F.broadcast(bits), F.expr(f"key & {FILTER_WORDS - 1}") == F.col("word"), "left") \
        .select(*rows.columns, F.coalesce(F.expr("getbit(bits, cast(shiftright(key, 32) & 63 as int)) = 1"), F.lit(False)).alias("flag"))


def _wanted(keys: DataFrame, lines: DataFrame) -> DataFrame:
    """(key, line), a row per key, of at least the lines in ``keys``."""
    return _flagged(keys, lines).where("flag").groupBy("key").agg(F.first("line").alias("line"))


def _distinct(counted: DataFrame, lines: DataFrame) -> DataFrame:
    """(key, line): every line content once. Lines that have no copy stay where they are."""
    flagged = _flagged(counted.where("n > 1"), lines)
    return flagged.where("not flag").select("key", "line").union(
        flagged.where("flag").groupBy("key").agg(F.first("line").alias("line")))


def _shared(banded: DataFrame, hint: str | None = None) -> DataFrame:
    """(band, key, n, low, high): the rows of ``banded`` (key, band) whose band several lines share, their number, first and last key."""
    bucket = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
    return banded.join(bucket.hint(hint) if hint else bucket, "band")


def _buckets(banded: DataFrame) -> DataFrame:
    """The rows of all buckets, as ``_shared`` has them.

    Nearly all bands have one line, so partial sums would only make the rows longer: rows are dealt out by band
    once, and counted and kept where they are. The bands of crowded cells are summed in part first and joined anew.
    """
    cell = F.expr(f"band & {CELLS - 1}")
    cells = materialize(banded.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")), "line-cells")
    most = max(CROWD * (cells.agg(F.sum("n")).first()[0] or 0) // CELLS, CROWD_LEAST)
    crowded = cells.where(F.col("n") > most).select("cell")
    if crowded.isEmpty():
        return materialize(_shared(banded.repartition("band"), "shuffle_hash"), "line-met")
    crowded = F.broadcast(crowded)
    return materialize(_shared(banded.join(crowded, cell == F.col("cell"), "left_anti").repartition("band"), "shuffle_hash")
                       .union(_shared(banded.join(crowded, cell == F.col("cell"), "left_semi"))), "line-met")


def _main_components(member: DataFrame, group: str) -> DataFrame:
    """(group, n, others, main): groups of several components, their largest one and the lines outside it."""
    each = member.groupBy(group, "component").agg(F.count("*").alias("n"))
    return materialize(each.groupBy(group).agg(
        F.sum("n").alias("n"), (F.sum("n") - F.max("n")).alias("others"), F.max_by("component", "n").alias("main")).where("others > 0"), "line-groups")


def _across(left: DataFrame, right: DataFrame, group: str, condition: str = "true") -> DataFrame:
    """Pairs of lines of a group that are in different components."""
    return left.alias("l").join(right.alias("r"), group).where(f"l.component <> r.component and {condition}") \
        .select(F.expr("least(l.key, r.key)").alias("a"), F.expr("greatest(l.key, r.key)").alias("b"))


def _bucket_pairs(member: DataFrame, bitmaps: DataFrame, threshold: float) -> DataFrame:
    """Pairs of lines of ``member`` (band, n, main, key, component) that share a band, are in different components and pass
    as in ``_passing``. At least one of a pair is outside ``main``. Sizes of a pair at the threshold are in one class or in neighbouring ones.
    """
    size_class = F.floor(F.log("size") / F.lit(math.log((1 + 1e-6) / threshold))).cast("long")
    classed = F.col("n") > CLASSED
    rows = member.join(bitmaps, "key").withColumn("inside", F.expr("component = main"))
    words = [f"b{w}" for w in range(BITMAP_WORDS)]
    held = ["band", "key", "component", "size", "inside", *words]
    left = rows.where("not inside").select(*held, F.explode(F.when(
        classed, F.sequence(size_class - 1, size_class + 1)).otherwise(F.array(F.lit(0).cast("long")))).alias("class"))
    right = rows.select(*held, F.when(classed, size_class).otherwise(F.lit(0).cast("long")).alias("class"))
    return left.alias("l").join(right.alias("r"), ["band", "class"]) \
        .where(f"l.component <> r.component and (r.inside or l.key < r.key) and {_sized('l', 'r', threshold)}"
               f" and {_alike('l', 'r', BITMAP_WORDS, threshold)}") \
        .select(F.expr("least(l.key, r.key)").alias("a"), F.expr("greatest(l.key, r.key)").alias("b"))


def _prefix_pairs(member: DataFrame, lines: DataFrame, threshold: float, width: int | None) -> DataFrame:
    """Every pair of ``member`` (key, component) in different components that can reach ``threshold``.

    Shingles are ordered by their number of lines. If two lines reach the threshold, the first
    shingle that they share, at the places i and j, leaves them enough behind it: the smaller of
    |a| - i and |b| - j is at least t / (1 + t) (|a| + |b|). So it is among the first |a| - 2t / (1 + t) |a| + 1
    of the smaller set and the first |b| - t |b| + 1 of the larger one.
    """
    t, least = threshold, 2 * threshold / (1 + threshold)
    held = _wanted(member.select("key"), lines).join(member, "key").select("key", "component", shingle_set(F.col("line"), width).alias("h")) \
        .select("key", "component", F.size("h").alias("size"), F.explode("h").alias("shingle"))
    counts = held.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    ranked = held.join(counts, "shingle", "left").groupBy("key", "component", "size").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle"))).alias("order"),
        *_words("shingle", PARITY_WORDS))
    words = [f"b{w}" for w in range(PARITY_WORDS)]
    probe = materialize(ranked.select("key", "component", "size", *words, F.posexplode(F.slice(
        "order", 1, F.expr(f"cast(size - ceil({t} * size - 1e-9) + 1 as int)"))).alias("place", "at"))
        .where("at.n > 1").select("key", "component", "size", *words, "place", F.col("at.shingle").alias("shingle")), "line-prefixes")
    index = probe.where(f"place <= size - ceil({least} * size - 1e-9)")
    main = _main_components(probe, "shingle").select("shingle", "main")
    index, probe = index.join(main, "shingle"), probe.join(main, "shingle")
    enough = f"l.size <= r.size and l.size >= {t} * r.size - 1e-9 and " \
        f"least(l.size - l.place, r.size - r.place) >= {least / 2} * (l.size + r.size) - 1e-9 and " \
        f"{_alike('l', 'r', PARITY_WORDS, t)}"
    return _across(index.where("component <> main"), probe, "shingle", enough).union(
        _across(index.where("component = main"), probe.where("component <> main"), "shingle", enough))


def line_components(documents: DataFrame, threshold: float = 0.8, rows: int = 5, few: int = 1 << 16, width: int | None = None) -> DataFrame:
    """(key, first_doc, first_text, first_line): for every line content that is not alone, the place of its
    component's first line (``first_text`` is the hash of its text). ``key`` is the 64-bit hash of the line.

    ``few`` is the number of lines outside a bucket's largest component up to which the bucket is
    joined with itself; it changes the way, not the result.
    """
    lines = _lines(documents).select("key", "line")
    counted = materialize(_lines(documents).groupBy("key").agg(
        F.min(F.struct("doc_id", "line_no", "text_hash")).alias("first"), F.count("*").alias("n")), "line-keys")

    minima = shingles(_distinct(counted, lines), width).withColumn("h", F.expr("cast(shiftright(h, 32) as int)")) \
        .groupBy("key").agg(*[F.min(F.col("h").bitwiseXOR(F.lit(m))).alias(f"m{i}") for i, m in enumerate(masks(rows * rows))])
    bands = materialize(minima.select("key", F.array(*[
        F.xxhash64(F.lit(b), *[f"m{i}" for i in t]) for b, t in enumerate(band_sets(rows))]).alias("bands")), "line-bands")
    free_shuffles(documents.sparkSession)
    # a bucket's leaders are its first and its last key; keys are hashes, so these are any two lines
    met = _buckets(bands.select("key", F.explode("bands").alias("band")))
    pairs = materialize(met.where("key <> low").select(F.col("low").alias("a"), F.col("key").alias("b"))
                        .union(met.where("key <> high").select("key", "high")).distinct(), "line-pairs")
    discard(bands)
    bitmaps = _bitmaps(_distinct(counted, _flagged(met.select("key"), lines).where("flag").select("key", "line")), width)
    likely = _passing(pairs, bitmaps, threshold)
    component = connected_components(_exact(likely, lines, threshold, width))

    # lines of a bucket that the leaders left in different components
    member = materialize(met.where("n > 2").select("band", "key").join(component.withColumnRenamed("node", "key"), "key", "left")
                         .withColumn("component", F.coalesce("component", "key")), "line-members")
    discard(met)
    open_buckets = _main_components(member, "band").where("n > 2")
    direct = member.join(open_buckets.where(F.col("others") <= few).select("band", "n", "main"), "band")
    more = _bucket_pairs(direct, bitmaps, threshold)
    large = materialize(member.join(open_buckets.where(F.col("others") > few), "band", "left_semi")
                        .select("key", "component").distinct(), "line-large")
    if not large.isEmpty():
        more = more.union(_passing(_prefix_pairs(large, lines, threshold, width).distinct(), bitmaps, threshold))
    more = materialize(more.distinct().join(likely, ["a", "b"], "left_anti"), "line-pairs")
    discard(bitmaps)
    if not more.isEmpty():
        component = connected_components(component.select(F.col("node").alias("a"), F.col("component").alias("b"))
                                         .union(_exact(more, lines, threshold, width)))

    known = counted.join(component.withColumnRenamed("node", "key"), "key", "left").where("n > 1 or component is not null") \
        .withColumn("component", F.coalesce("component", "key"))
    known = materialize(known, "line-known")
    best = known.groupBy("component").agg(F.min("first").alias("best"))
    return known.join(best, "component").select("key", F.col("best.doc_id").alias("first_doc"),
                                                F.col("best.text_hash").alias("first_text"), F.col("best.line_no").alias("first_line"))


def dedup_lines(documents: DataFrame, **options) -> DataFrame:
    """``documents`` with text less its repeated lines, and n_lines, n_removed (long).

    Lines are separated by line feeds; blank lines always stay. Of the lines of a
    component (shingle Jaccard >= ``threshold``, closed transitively) only the
    first stays, over all documents, by doc_id and line number (then by the text's
    hash: rows that share a doc_id, or have none, are told apart by their texts). Null texts
    stay null with no lines; empty texts stay empty. A text all of whose
    lines are repeats becomes empty but its row stays. Repeated rows share
    doc_id and text and so keep the same first lines. All columns are kept; n_lines
    and n_removed replace columns of these names. Null doc_ids sort first.
    """
    found = materialize(line_components(documents, **options), "line-components")
    drop = _lines(documents).select("doc_id", "text_hash", "line_no", "key").join(found, "key") \
        .where(~(F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("text_hash") == F.col("first_text"))
                 & (F.col("line_no") == F.col("first_line")))) \
        .groupBy(F.col("doc_id").alias("__drop_doc"), F.col("text_hash").alias("__drop_text")).agg(F.collect_set("line_no").alias("__drop_lines"))
    drop = materialize(drop, "line-drop")
    base = documents.drop("n_lines", "n_removed")
    # texts that lose nothing stay where they are
    flagged = _flagged(drop.select(F.col("__drop_text").alias("key")), base.select(F.struct(*base.columns).alias("row"), F.xxhash64("text").alias("key")))
    held = flagged.where("flag").select("row.*", F.col("key").alias("__text"))
    joined = held.join(drop, F.col("doc_id").eqNullSafe(F.col("__drop_doc")) & (F.col("__text") == F.col("__drop_text")), "left") \
        .select(*base.columns, "__drop_lines") \
        .union(flagged.where("not flag").select("row.*", F.lit(None).cast("array<int>").alias("__drop_lines"))) \
        .withColumn("__all_lines", F.split("text", "\n"))
    lines = F.col("__all_lines")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__drop_lines")
    kept = F.transform(stay, lambda i: F.get(lines, i))
    touched = F.col("__drop_lines").isNotNull() & F.col("text").isNotNull()
    return joined.withColumn("n_lines", F.coalesce(F.size(F.when(F.col("text").isNotNull(), lines)), F.lit(0)).cast("long")) \
        .withColumn("n_removed", F.coalesce(F.size("__drop_lines"), F.lit(0)).cast("long")) \
        .withColumn("text", F.when(touched, F.array_join(kept, "\n")).otherwise(F.col("text"))) \
        .select(*[c for c in base.columns], "n_lines", "n_removed")
