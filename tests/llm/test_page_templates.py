"""Templates of hosts with empty pages or few pages; text that no rule may drop."""

import numpy as np

from tests.llm.test_pages_vectors import page
from tripdemand.llm.html_extract import _hash, deduce_templates, extract_main_text, main_text


def test_template_with_an_empty_page_and_on_small_hosts(spark):
    for n in (2, 3, 12):
        rows = [(i, f"http://h.example/{i}", page(
            f"<div><span>Fixed head line</span></div><div><p>Story {i} goes on for a good while with words {i * 7}.</p>"
            + ("<p>Follow us for more</p>" if i < 0.8 * n or n < 12 else "") + f"<p>End {i} of it.</p></div>")) for i in range(n)]
        rows += [(101, "http://h.example/x", ""), (102, "http://h.example/y", None)]
        got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert got.pop(101) == got.pop(102) == ""
        assert got == {i: f"Story {i} goes on for a good while with words {i * 7}. End {i} of it." for i in range(n)}


def test_near_copies_on_a_small_host_keep_their_text(spark):
    text = " ".join(f"<p>Paragraph {k} of an article that two pages hold.</p>" for k in range(6))
    rows = [(i, f"http://h.example/{i}", page(f"<article>{text}<p>Edit {i}</p></article>")) for i in range(2)]
    for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert r.text.count("Paragraph") == 6 and r.text.endswith(f"Edit {r.page_id}")


def test_pages_without_an_article_keep_all_blocks():
    lead, body = "The lead of the story. " * 3, "The body of the story goes on. " * 6
    assert main_text(page(f"<div class=content><div class=lead>{lead}</div><div class=body>{body}</div></div>"), {}) == f"{lead}{body}".strip()
    items = "".join(f"<li>entry {i} of a long list</li>" for i in range(9))
    got = main_text(page(f"<div><h1>Head</h1><p>Before.</p><ul>{items}</ul><p><a href=x>All of this paragraph is one link</a></p><p>After.</p></div>"), {})
    assert got.startswith("Head Before. entry 0") and got.endswith("All of this paragraph is one link After.")


def test_names_and_raw_elements_do_not_drop_articles():
    story = "A long story that fills most of this page. " * 4
    cases = {
        f"<div class='layout with-sidebar'><article><p>{story}</article><div class=sidebar>side</div></div>": story,
        f"<div id='search-result'><p>{story}</p></div><div class=ad>buy</div>": story,
        f"<article><h1>Head</h1><div class='body share-bar'><p>{story}</div><div class=share>share</div></article>": f"Head {story}",
        f"<article><p>one</p></article><section id=comments><article>{story}</article></section>": "one",
        "<article><p>a <svg class=i/>b <math />c</p><p>d</p></article>": "a b c d",
        "<article><p>a <svg><title>t</title><path d='x'/></svg>b</p><div>x <button>go </div><div><object>alt</div><p>c</p></article>": "a b x c",
        "<article><p>a</p><template><div>hidden</div></template><select><option>1<option>2</select><p>b</p></article>": "a b",
        "<div class=nav><p>Only this.</p></div>": "Only this.",
    }
    for body, want in cases.items():
        assert main_text(page(body), {}) == want.strip(), body


def test_headings_that_articles_share_stay(spark):
    """Whatever the number of pages: a heading or a paragraph that all articles of a host hold is part of them."""
    for n in (2, 7, 8, 12):
        rows = [(i, f"http://h.example/{i}", page(
            f"<div><span>Fixed head line</span></div><article><h2>Summary</h2><p>Story {i} with words {i * 7}.</p>"
            f"<h2>Method</h2><p>End {i} of it.</p></article><div>Fixed foot line</div>")) for i in range(n)]
        got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert got == {i: f"Summary Story {i} with words {i * 7}. Method End {i} of it." for i in range(n)}


def classes(spark, bodies):
    rows = [(i, f"http://h.example/{i}", page(body)) for i, body in enumerate(bodies)]
    found = deduce_templates(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.token: r for r in found}


def token(text, path):
    return int(np.uint64(_hash(f"text {path} {text}")).astype(np.int64))


def test_classes_are_ordered_and_nested(spark):
    """One class around another in a gap; tokens that change places stand alone; of two that cross one is taken apart."""
    path = "/html/body/p"
    bodies = [f"<p>one</p>{'<p>in</p><p>out</p>' if i < 8 else ''}<p>two</p><p>{'x' if i % 2 else 'y'} {i}</p>"
              f"<p>{'left' if i % 2 else 'right'}</p><p>{'right' if i % 2 else 'left'}</p>{'<p>far</p>' if 2 < i else ''}" for i in range(12)]
    bodies = [b.replace("<p>in</p>", "<p>in</p><p>far, too</p>") if i > 2 else b for i, b in enumerate(bodies)]
    found = classes(spark, bodies)
    one, two, inner, outer = (found[token(t, path)] for t in ("one", "two", "in", "out"))
    assert one["class"] == two["class"] and one.place < two.place and one.class_size == two.class_size
    assert inner["class"] == outer["class"] and (inner.place, outer.place, inner.class_size) == (0, 1, 2)
    for t in ("left", "right"):
        assert (found[token(t, path)].class_size, found[token(t, path)].place) == (1, 0)
    assert found[token("left", path)].around == one["class"]

    cross = [f"<p>one</p>{'<p>a</p>' if i < 8 else ''}<p>two</p>{'<p>b</p>' if i < 8 else ''}<p>three {i}</p>" for i in range(12)]
    found = classes(spark, cross)
    one, two, a, b = (found[token(t, path)] for t in ("one", "two", "a", "b"))
    assert one["class"] == two["class"] == a.around == b.around and a["class"] != b["class"]
    assert a.gap == one.place and b.gap == two.place == one.place + 1


def test_what_stands_in_changing_gaps_is_no_template(spark):
    """A remark on two thirds of the pages, but under another heading each time, is text of the pages."""
    rows = []
    for i in range(12):
        parts = [f"<div><span>Part {k}</span></div><p>Story {i} {k} with words {i * 7}.</p>" + ("<p>The same remark.</p>" if i % 4 == k else "")
                 for k in range(3)]
        rows.append((i, f"http://h.example/{i}", page("<div><span>Fixed head line</span></div>" + "".join(parts))))
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: " ".join(f"Story {i} {k} with words {i * 7}." + (" The same remark." if i % 4 == k else "") for k in range(3)) for i in range(12)}
