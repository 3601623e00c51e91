"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: tags with the path of their open elements, and the
texts of blocks at their paths. The occurrence vector of a token lists how often
each page of its host holds it. Tokens of one host with equal vectors form
an equivalence class, if they are on at least half of the host's pages. A class is ordered: its tokens follow each
other in the same order on all pages, once per instance; tokens that do not are classes of their own. Classes are nested:
between two tokens of a class, in one of its gaps, whole instances of other classes stand. Where two classes cross,
the one on fewer pages is taken apart into its tokens. The role of an instance is the gap that holds it, with the gaps around that.
The classes that have one role on at least half of the host's pages form the host's template, a tree. What the template does not fix are its
slots. Of these the
main text is taken: slots inside an article, or else inside the smallest element that
holds all text outside links, without those that their tags or class names
show to be navigation, adverts, notices, forms, comments and the like, and, outside
articles, without block texts that the template itself holds.

Vectors are never gathered: a token's vector is summed up as two commutative
fingerprints (sums of hashes of page and count), which Spark adds up with
partial aggregates, so a host with a third of all pages costs one row per task
and token. So are places (smallest and largest), crossings and gaps, from the token sequences of the pages, which are kept as hashes.
"""

from __future__ import annotations

import functools
import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripdemand.llm.common import bounded_broadcast, ids_as_text, ids_back, materialize
from tripdemand.llm.text_hash import mix64

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object select option button title head".split())
#: Of RAW, those whose content is text up to the closing tag; the others hold elements and end with their parent.
TEXT_RAW = frozenset("script style textarea iframe title".split())
SKIPPED = RAW - TEXT_RAW - {"head"}
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
CLOSED_BY = {  # an opening tag closes these open elements (up to the nearest container of the key's kind)
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul body".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu".split()) | RAW
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer foot "
    "comment comments reply replies respond disqus notice notices cookie cookies consent gdpr alert "
    "newsletter subscribe subscription signup login share sharing social related recommended widget widgets "
    "popup modal overlay pagination pager toolbar search skip".split())
#: From so many pages on, what recurs outside articles is taken for fixed text even if it is most of a page's text.
FIRM_PAGES = 8
_READ = frozenset("class id role hidden aria-hidden".split())
HEADER_NAMES = frozenset("header masthead topbar".split())

# An attribute: a name, and perhaps a value; quotes count only where a value starts. Possessive, so every text is read once.
_VALUE = r"""\s*+=\s*+(?:"([^"]*+)(?:"|$)|'([^']*+)(?:'|$)|([^\s>"'][^\s>]*+))?+"""
_ATTR = re.compile(rf"""([^\s/>=]++)(?:{_VALUE})?+""")
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=]++(?:"
                    + re.sub(r"\((?=\[)", "(?:", _VALUE) + r")?+|=)*+)(?:>|$)", re.S)
_NAME = re.compile(r"[A-Za-z]+")
_ALNUM = re.compile(r"[^\W_]+")
_SPACE = re.compile(r"\s+")


class Block:
    """A run of text between block boundaries: where it stands, and whether its surroundings rule it out."""

    __slots__ = ("path", "text", "article", "ruled_out", "linked", "named", "at")

    def __init__(self, path: str, text: str, article: int, ruled_out: bool, linked: int, named: tuple[tuple[int, int], ...], at: int):
        self.path, self.text, self.article, self.ruled_out, self.linked = path, text, article, ruled_out, linked
        self.named = named  # (number, article around it) of each element above that is named like boilerplate
        self.at = at  # number of tag tokens before its end


@functools.lru_cache(4096)
def _ruled_out(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """(tag, role or state rules the element out, its class or id names it like boilerplate)."""
    if tag in BOILERPLATE_TAGS or tag == "header" and not in_article:
        return True, False
    names: set[str] = set()
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key not in _READ:
            continue
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True, False
        if key == "role":
            if value.lower() in BOILERPLATE_ROLES:
                return True, False
        else:
            names.update(n.lower() for n in _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value)))
            names.update("".join(_NAME.findall(n)).lower() for n in value.split())  # side-bar is sidebar
    if tag in ("body", "html", "article", "main"):
        return False, bool(names & {"comment", "comments", "reply", "advert", "sponsored"})
    return False, bool(names & BOILERPLATE_NAMES or not in_article and names & HEADER_NAMES)


def _weight(text: str) -> int:
    """Letters and digits of a text."""
    return sum(map(len, _ALNUM.findall(text)))


def parse(page: str | None) -> tuple[list[Block], list[str]]:
    """(blocks in page order, tag tokens with their paths). Tolerates unclosed and stray tags."""
    blocks: list[Block] = []
    tokens: list[str] = []
    stack: list[tuple] = []  # (tag, path, ruled out, number of the enclosing article, named elements, skipped, in a link)
    parts: list[str] = []
    state = {"linked": 0, "articles": 0, "named": 0}

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            top = next((s for s in reversed(stack) if s[0] not in INLINE and s[0] not in SKIPPED), None)
            where = next((s for s in reversed(stack) if s[0] not in SKIPPED), None)
            blocks.append(Block(top[1] if top else "", text, where[3] if where else 0, bool(where and where[2]), state["linked"],
                                where[4] if where else (), len(tokens)))
        state["linked"] = 0

    def close_to(i: int) -> None:
        if any(s[0] not in INLINE and s[0] not in SKIPPED for s in stack[i:]):
            flush()
        del stack[i:]

    def words(raw: str) -> None:
        if raw and not (stack and stack[-1][5]):
            text = entities.unescape(raw)
            parts.append(text)
            if stack and stack[-1][6]:
                state["linked"] += _weight(text)

    page = page or ""
    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            words(page[at:])
            break
        words(page[at:m.start()])
        at = m.end() if m.end() > m.start() else m.start() + 1
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and not (stack and stack[-1][5]):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        tag, attrs = m[2].lower(), m[3] or ""
        if m[1]:
            i = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if i is None:
                if tag in CLOSES_P:
                    flush()
            elif not (tag in INLINE and any(s[0] not in INLINE for s in stack[i + 1:])):
                closed = f"/{stack[i][1]}"
                close_to(i)
                tokens.append(closed)
            continue
        if tag in ("br", "hr"):
            parts.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in VOID:
            continue
        if tag in ("svg", "math") and attrs.rstrip().endswith("/"):
            continue
        if tag in TEXT_RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>|$", re.I).search(page, at)
            at = end.end()
            continue
        if tag in CLOSED_BY:
            kinds, fence = CLOSED_BY[tag]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in fence:
                    break
                if stack[k][0] in kinds:
                    close_to(k)
                    break
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close_to(k)
                    break
                if stack[k][0] not in INLINE:
                    break
            flush()
            while stack and stack[-1][0] in INLINE:  # a formatting element left open ends with its block
                stack.pop()
            if tag == "body" and stack and stack[-1][0] == "head":
                stack.pop()
        elif tag not in INLINE and tag not in SKIPPED:
            flush()
        up = stack[-1] if stack else ("", "", False, 0, (), False, False)
        names = "".join(sorted({f".{n.lower()}" for a in _ATTR.finditer(attrs) if a[1].lower() in ("class", "id")
                                for n in _NAME.findall(a[2] or a[3] or a[4] or "")}))
        article = up[3]
        if tag in ("article", "main") and not article:
            state["articles"] += 1
            article = state["articles"]
        path = f"{up[1]}/{tag}{names}"
        ruled_out, named = _ruled_out(tag, attrs, bool(up[3]))
        state["named"] += named
        stack.append((tag, path, up[2] or ruled_out and tag not in SKIPPED, article, up[4] + ((state["named"], up[3]),) if named else up[4],
                      up[5] or tag in SKIPPED, up[6] or tag == "a"))
        tokens.append(path)
    flush()
    return blocks, tokens


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _hash(text: str) -> int:
    raw = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(raw) << 32 | zlib.adler32(raw)


def page_sequence(blocks: list[Block], tokens: list[str]) -> list[int]:
    """The tokens of a page in page order: tags at their paths, block texts at their paths."""
    out: list[int] = []
    done = 0
    for b in blocks:
        out += [_hash(f"tag {t}") for t in tokens[done:b.at]]
        out.append(_hash(f"text {b.path} {b.text}"))
        done = b.at
    return out + [_hash(f"tag {t}") for t in tokens[done:]]


def places(sequence: list[int], class_of: dict[int, int]) -> dict[int, int]:
    """Place of each token of the page in its class: 0, 1, ... if the page repeats the class in one order, else -1."""
    found: dict[int, list[int]] = {}
    for t in sequence:
        if t in class_of:
            found.setdefault(class_of[t], []).append(t)
    out: dict[int, int] = {}
    for held in found.values():
        order = list(dict.fromkeys(held))
        ordered = held == order * (len(held) // len(order))
        out.update((t, i if ordered else -1) for i, t in enumerate(order))
    return out


def nesting(sequence: list[int], place: dict[int, tuple[int, int, int]]) -> tuple[set[tuple[int, int, int, int]], set[tuple[int, int]]]:
    """({(class, class around it or 0, its gap or -1, hash of all gaps around it)}, {two classes that cross}) of a page.

    ``place`` gives the class of a token, its place there, and the size of the class.
    """
    inside: set[tuple[int, int, int, int]] = set()
    crossed: set[tuple[int, int]] = set()
    begun: list[tuple[int, int, int]] = []  # (class, gap, hash of the gaps around) of the instances that have not ended
    for t in sequence:
        if t not in place:
            continue
        c, at, size = place[t]
        if at == 0:
            around, gap, above = begun[-1] if begun else (0, -1, 0)
            role = _hash(f"{above} {around} {gap}") >> 1 if begun else 0
            inside.add((c, around, gap, role))
            if size > 1:
                begun.append((c, 0, role))
            continue
        i = next(k for k in range(len(begun) - 1, -1, -1) if begun[k][0] == c)
        crossed.update((min(c, e), max(c, e)) for e, _, _ in begun[i + 1:])
        if at < size - 1:
            begun[i] = c, at, begun[i][2]
        else:
            del begun[i]
    return inside, crossed


def _signed(x: int) -> int:
    return x if x < 1 << 63 else x - (1 << 64)


def _sequences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, page, tokens): a row per page that has tokens; ``page`` is a hash that tells pages apart."""
    for pdf in batches:
        rows = []
        for number, (url, page) in enumerate(zip(pdf["url"], pdf["html"])):
            tokens = page_sequence(*parse(page))
            if tokens:
                seed = _hash(f"{url} {number}") ^ zlib.crc32((page or "").encode("utf-8", "surrogatepass"))
                rows.append((host_of(url), _signed(seed), np.asarray(tokens, np.uint64).view(np.int64)))
        yield pd.DataFrame(rows, columns=["host", "page", "tokens"])


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        held: dict[tuple[str, int], list[int]] = {}
        for host, seed, tokens in zip(pdf["host"], pdf["page"], pdf["tokens"]):
            found = {0: 1}
            for t in tokens.tolist():
                found[t] = found.get(t, 0) + 1
            keys = np.fromiter(found.values(), np.uint64, len(found)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % (1 << 64))
            for t, f, n in zip(found, mix64(keys).tolist(), found.values()):
                entry = held.setdefault((host, t), [0, 0, 0])
                entry[0] += 1
                entry[1] = (entry[1] + (f >> 8)) & (1 << 62) - 1
                entry[2] += n
        yield pd.DataFrame([(*k, *v) for k, v in held.items()], columns=["host", "token", "pages", "vector", "total"])


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        held: dict[tuple[str, int], tuple[int, int]] = {}
        for host, tokens, known, classes in zip(pdf["host"], pdf["tokens"], pdf["known"], pdf["classes"]):
            for t, at in places(tokens.tolist(), dict(zip(known.tolist(), classes.tolist()))).items():
                low, high = held.get((host, t), (at, at))
                held[host, t] = min(low, at), max(high, at)
        yield pd.DataFrame([(*k, *v) for k, v in held.items()], columns=["host", "token", "first", "last"])


def _nesting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, class, around, gap, role, pages); the gap is -2 where the two classes cross."""
    for pdf in batches:
        held: dict[tuple[str, int, int, int, int], int] = {}
        for host, tokens, known, classes, at, sizes in zip(*(pdf[c] for c in ("host", "tokens", "known", "classes", "places", "sizes"))):
            inside, crossed = nesting(tokens.tolist(), dict(zip(known.tolist(), zip(classes.tolist(), at.tolist(), sizes.tolist()))))
            for key in inside | {(a, b, -2, 0) for a, b in crossed}:
                held[host, *key] = held.get((host, *key), 0) + 1
        yield pd.DataFrame([(*k, v) for k, v in held.items()], columns=["host", "class", "around", "gap", "role", "pages"])


def _taken_apart(pairs: pd.DataFrame) -> pd.DataFrame:
    """The classes of a host that go, so that no two of the others cross: those on fewer pages, then the smaller ones."""
    rank = {c: (-n, -size, c) for side in "ab" for c, n, size in zip(*(pairs[f"{side}{x}"] for x in ("", "_pages", "_size")))}
    crossing: dict[int, set[int]] = {c: set() for c in rank}
    for a, b in zip(pairs["a"], pairs["b"]):
        crossing[a].add(b)
        crossing[b].add(a)
    stay: set[int] = set()
    for c in sorted(rank, key=rank.__getitem__):
        if not crossing[c] & stay:
            stay.add(c)
    return pd.DataFrame([(pairs["host"].iloc[0], c) for c in rank if c not in stay], columns=["host", "class"])


def _sized(tokens: DataFrame) -> DataFrame:
    """``tokens`` with the places in each class numbered from 0, and class_size."""
    of_class = Window.partitionBy("host", "class")
    return tokens.withColumn("place", F.row_number().over(of_class.orderBy("place", "token")) - 1) \
        .withColumn("class_size", F.count("*").over(of_class))


def _beside(sequences: DataFrame, tokens: DataFrame, hosts_at_once: int, **columns: str) -> DataFrame:
    """The pages of ``sequences`` with their host's tokens as arrays, which a page's length bounds, not the number of pages."""
    arrays = tokens.groupBy("host").agg(F.collect_list(F.struct("token", *columns.values())).alias("all")) \
        .select("host", F.col("all.token").alias("known"), *[F.col(f"all.{c}").alias(name) for name, c in columns.items()])
    return sequences.join(bounded_broadcast(materialize(arrays, "html-classes"), hosts_at_once), "host")


def deduce_templates(pages: DataFrame, min_pages: int = 2, support: float = 0.5, hosts_at_once: int = 4_000) -> DataFrame:
    """(host, token, class, place, class_size, around, gap, total, pages): the tokens of each host's template.

    A class is valid on at least two pages and a share of ``support`` of the host's pages, and in the template if
    it has one role, that is, stands in the same gaps of the classes around it, on that share. ``place`` is the token's place in its class; ``around`` and
    ``gap`` tell the class around it and after which place there it stands (0 and -1: none). Pages
    without tokens (null, empty, no markup and no text) are no pages of the host here.
    """
    sequences = materialize(pages.select("url", "html").mapInPandas(_sequences, "host string, page long, tokens array<long>"), "html-sequences")
    counted = sequences.mapInPandas(_counts, "host string, token long, pages long, vector long, total long") \
        .groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum(F.expr("vector & 281474976710655")).alias("low"),
                                      F.sum(F.expr("shiftright(vector, 48)")).alias("high"), F.sum("total").alias("total"))
    counted = materialize(counted.where("pages > 1 or token = 0"), "html-tokens")
    hosts = counted.where("token = 0").select("host", F.col("pages").alias("all_pages")).where(F.col("all_pages") >= min_pages)
    supported = materialize(counted.where("token <> 0").join(hosts, "host").where(F.col("pages") >= support * F.col("all_pages"))
                            .withColumn("class", F.xxhash64("pages", "low", "high")), "html-supported")

    # in order: what has the same place in its class on all pages stays together
    order = _beside(sequences, supported, hosts_at_once, classes="class") \
        .mapInPandas(_places, "host string, token long, first long, last long") \
        .groupBy("host", "token").agg(F.min("first").alias("place"), F.max("last").alias("last"))
    ordered = materialize(_sized(supported.join(order, ["host", "token"]).withColumn(
        "class", F.when(F.expr("place = last and place >= 0"), F.col("class")).otherwise(F.col("token")))
        .select("host", "token", "class", "place", "total", "pages", "all_pages")), "html-ordered")

    # nested: no two classes cross
    def nested(tokens: DataFrame) -> DataFrame:
        found = _beside(sequences, tokens, hosts_at_once, classes="class", places="place", sizes="class_size") \
            .mapInPandas(_nesting, "host string, class long, around long, gap long, role long, pages long")
        return materialize(found.groupBy("host", "class", "around", "gap", "role").agg(F.sum("pages").alias("held")), "html-nesting")

    inside = nested(ordered)
    crossing = inside.where("gap = -2").select("host", F.col("class").alias("a"), F.col("around").alias("b"))
    if not crossing.isEmpty():
        known = ordered.where("place = 0").select("host", "class", "pages", "class_size")
        for side in "ab":
            crossing = crossing.join(known.select("host", F.col("class").alias(side), F.col("pages").alias(f"{side}_pages"),
                                                  F.col("class_size").alias(f"{side}_size")), ["host", side])
        gone = materialize(crossing.groupBy("host").applyInPandas(_taken_apart, "host string, class long"), "html-crossing")
        ordered = materialize(_sized(ordered.drop("class_size").join(gone.withColumn("gone", F.lit(True)), ["host", "class"], "left").withColumn(
            "class", F.when(F.col("gone"), F.col("token")).otherwise(F.col("class"))).drop("gone")), "html-ordered")
        inside = nested(ordered)
    roles = inside.groupBy("host", "class").agg(F.max(F.struct("held", "around", "gap", "role")).alias("role"))
    return ordered.join(roles, ["host", "class"]).where(F.col("role.held") >= support * F.col("all_pages")) \
        .select("host", "token", "class", "place", "class_size", "role.around", "role.gap", "total", "pages")


def main_text(page: str | None, template: dict[int, int]) -> str:
    """Main text of a page given its host's template (token -> 1, or 0 if only few pages support it)."""
    blocks, _ = parse(page)
    allowed = [b for b in blocks if not b.ruled_out]
    gone = _named_boilerplate(allowed, template)
    slots = [b for b in allowed if not any(n in gone for n, _ in b.named)] or allowed
    known = [template.get(_hash(f"text {b.path} {b.text}")) for b in slots]
    # what pages share inside their articles are headings, quotations or copies; outside, what few pages share is a
    # copied page if it is most of the text
    shared = sum(len(b.text) for b, k in zip(slots, known) if k == 0)
    weak = 2 * shared <= sum(len(b.text) for b, k in zip(slots, known) if k != 1)
    chosen = [b for b in slots if b.article]
    if not chosen:
        # block texts of the template are fixed parts, unless nothing else is left
        free = [b for b, k in zip(slots, known) if k is None or k == 0 and not weak]
        chosen = _container(free or slots)
    return " ".join(b.text for b in chosen)


def _named_boilerplate(blocks: list[Block], template: dict[int, int]) -> set[int]:
    """Numbers of the elements that their class or id rules out.

    A name alone is no proof: the element is small against what surrounds it (its article, or else the
    page), or it is mostly links or template. Outside an article it is enough that there is an article without such a name.
    """
    if not any(b.named for b in blocks):
        return set()
    whole: dict[int, int] = {}  # by article, 0 is the page
    held: dict[tuple[int, int], list[int]] = {}
    article = False
    for b in blocks:
        n = _weight(b.text)
        whole[0] = whole.get(0, 0) + n
        if b.article:
            whole[b.article] = whole.get(b.article, 0) + n
            article = article or not any(not a for _, a in b.named)
        fixed = bool(b.named) and _hash(f"text {b.path} {b.text}") in template
        for key in b.named:
            entry = held.setdefault(key, [0, 0])
            entry[0] += n
            entry[1] += n if fixed else b.linked
    return {number for (number, a), (n, weak) in held.items()
            if article and not a or 2 * n < whole[a] or 2 * weak > n}


def _container(slots: list[Block]) -> list[Block]:
    """The slots below the smallest element that holds every slot with text outside links.

    Only blocks of nothing but links (lists of headlines, menus without a name) can be outside it.
    """
    paths = [b.path.split("/") for b in slots if (b.linked < _weight(b.text) if b.linked else _ALNUM.search(b.text))]
    if not paths:
        return slots
    n = 0
    while all(len(p) > n for p in paths) and len({p[n] for p in paths}) == 1:
        n += 1
    return [b for b in slots if b.path.split("/")[:n] == paths[0][:n]]


def extract_main_text(pages: DataFrame, min_pages: int = 2, broadcast_rows: int = 200_000) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Character references are decoded; white space inside a block is one space, blocks are joined
    by one space in page order. Null and empty html give an empty text, as do pages
    without any block of main text. Null and odd urls share the host "". Repeated rows give a row
    each. Other columns are ignored; an empty table gives an empty result.
    """
    template = materialize(deduce_templates(pages, min_pages, hosts_at_once=broadcast_rows // 50).groupBy("host").agg(
        F.sort_array(F.collect_set("token")).alias("tokens"),
        F.sort_array(F.collect_set(F.when(F.col("pages") < FIRM_PAGES, F.col("token")))).alias("weak")), "html-templates")
    keyed = pages.select("page_id", "url", "html", F.lower(F.coalesce(F.regexp_extract(
        "url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))).alias("host"))
    joined = keyed.join(bounded_broadcast(template, broadcast_rows // 50), "host", "left").drop("host")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [main_text(page, {} if t is None else dict.fromkeys(np.asarray(t, np.int64).view(np.uint64).tolist(), 1)
                              | dict.fromkeys(np.asarray(w, np.int64).view(np.uint64).tolist(), 0))
                    for page, t, w in zip(pdf["html"], pdf["tokens"], pdf["weak"])]
            yield pdf[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    out = ids_as_text(joined, "page_id").mapInPandas(extract, "page_id string, url string, text string, n_chars long")
    return ids_back(out, "page_id", pages)
