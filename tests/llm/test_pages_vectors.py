"""Pages, embeddings, and the pipeline as a whole."""

import html
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SF
from tripdemand.llm.common import connected_components
from tripdemand.llm.html_extract import deduce_templates, extract_main_text, main_text
from tripdemand.llm.lattice_dedup import decode_e8, e8_neighbours, lattice_near_dedup


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_pages_of_the_table(spark):
    for r in extract_main_text(spark.read.parquet(f"{SF}/pages.parquet")).join(
            spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " "))).strip()
                  for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == " ".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_markup():
    cases = {
        "<nav><a href=x>Menu</a></nav><article><h1>A &amp; B</h1><p>one<br>two<p>th<b>re</b>e</article><footer>f</footer>": "A & B one two three",
        '<header>site</header><main><p>x  &lt;y&gt;\n z</p><aside>side</aside><form><input>send</form></main>': "x <y> z",
        '<div class="content"><p>text of the page<div class="comments"><p>nice</div></div><div id="side-bar">s</div><div class="sidebar">q</div>': "text of the page",
        '<article><p>a</p><div class="ad">buy</div><section id="comments"><article><p>me</p></article></section><p>b</article>': "a b",
        "<script>var t='</p>';</script><p>only text": "only text",
        '<div role="navigation">n</div><div class="cookie-notice">c</div><p>plain &#x41;&nbsp;&eacute;</p>': "plain A é",
        "": "",
    }
    for body, want in cases.items():
        assert main_text(page(body), {}) == want, body
    assert main_text(None, {}) == "" and main_text("<p", {}) == "" and main_text("no markup", {}) == "no markup"


def test_template_of_a_host(spark):
    """What every page of a host repeats is template, wherever it stands; the slots are the text."""
    rows = [(i, f"http://h.example/{i}", page(
        f"<div><span>Fixed head line</span></div><div><p>Story {i} goes on for a good while with words {i * 7}.</p>"
        f"<p>Follow us for more</p><p>End {i} of it.</p></div>"), "t") for i in range(12)]
    rows += [(100, None, None, "t"), (101, "http://h.example/x", "", "t"), (102, "odd", page("<p>alone</p>"), "t"), (102, "odd", page("<p>alone</p>"), "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert deduce_templates(pages.where("page_id < 100")).count() > 0
    got = {r.page_id: r.text for r in extract_main_text(pages.where("page_id < 100 or page_id = 102")).collect()}
    for i in range(12):
        assert got[i] == f"Story {i} goes on for a good while with words {i * 7}. End {i} of it."
    assert got[102] == "alone"
    every = extract_main_text(pages).collect()
    assert len(every) == len(rows) and {r.text for r in every if r.page_id in (100, 101)} == {""}
    assert extract_main_text(pages.limit(0)).count() == 0


def test_e8():
    steps = e8_neighbours()
    assert len({tuple(s) for s in steps}) == 240 and set((steps ** 2).sum(axis=1)) == {2.0}
    rng = np.random.default_rng(2)
    y = rng.normal(0, 2, (200, 8))
    x = decode_e8(y)
    assert ((2 * x) % 1 == 0).all() and (x.sum(axis=1) % 2 == 0).all()
    d = ((y - x) ** 2).sum(axis=1)
    assert all(((y - x - s) ** 2).sum(axis=1).min() >= 0 and (d <= ((y - x - s) ** 2).sum(axis=1) + 1e-9).all() for s in steps)


def brute_links(rows):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, up = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in ok:
        for j in ok:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if i != j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9:
                n[i] += 1
                up[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for i, (v, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), v), v)
    return sorted((v, n[i], smallest[find(i)], v == smallest[find(i)]) for i, (v, _) in enumerate(rows))


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    rows, vec_id = [], 0
    for size in [1] * 40 + [2] * 20 + [5] * 4 + [60]:
        centre = rng.normal(size=32)
        for _ in range(size):
            rows.append((vec_id, [float(np.float32(x)) for x in centre + rng.normal(scale=0.1, size=32)]))
            vec_id += 1
    rows += [(900, rows[0][1]), (901, rows[0][1]), (902, [2 * x for x in rows[0][1]]), (903, None), (904, []), (905, [0.0] * 32),
             (906, [None] + rows[0][1][1:]), (907, [float("nan")] + rows[0][1][1:]), (908, [1.0, 2.0]), (909, [1.0, 2.0]), (910, [1.0, 2.1])]
    frame = spark.createDataFrame([(i, v, 0, "k") for i, v in rows], "vec_id long, embedding array<float>, label int, key string")
    for options in ({}, {"block": 16}):
        assert sorted(map(tuple, lattice_near_dedup(frame, **options).collect())) == brute_links(rows)
    assert lattice_near_dedup(frame.limit(0)).count() == 0
    again = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in lattice_near_dedup(again).collect()] == [(1, 1, 1, True)] * 2


def test_recall_at_the_threshold(spark):
    """Pairs of cosine just above 0.9, the hardest to find: at least 0.9 of them."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(300):
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.905 * a + np.sqrt(1 - 0.905 ** 2) * b).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert lattice_near_dedup(frame).where("not kept").count() >= 270


def test_components(spark):
    edges = [(i, i + 1) for i in range(25)] + [(100, k) for k in range(101, 160)] + [(300, 200), (250, 300), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(26)} == {0} and {got[i] for i in range(100, 160)} == {100}
    assert got[200] == got[250] == got[300] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF)
        assert out.columns == docs.columns, name
        assert out.join(seen, "doc_id", "left_anti").count() == 0
        seen = corpus_pipeline.materialize(out, "test-stage")
        assert 0 < seen.count() <= docs.count()
    last = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in seen.select("doc_id").collect())
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
    assert last.where(F.col("n_tokens") != F.size("ids")).count() == 0
