"""Main text of pages, and revisits, on small cases."""

import html
import random
import re
from collections import Counter

import pytest

from ledgerproof.llm import main_text, warc

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home page</a></li><li><a href=/n>News of today</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site to make it better for all of our readers</div>
<%s><h1>Headline of the story</h1><p>A first   paragraph with a fair number of words &amp; more of them, as articles&nbsp;have.</p>
<div class="ad">Buy our great new product now and save a lot of money</div><script>var x = "<p>no</p>";</script>
<p>Second <a href=x>linked</a> paragraph,<br>also of several words and some <b>bold</b> ones.<p>Short end.</p></%s>
<aside><p>Popular posts which you should read as well</p></aside><form><label>Your name</label><input name=a></form>
<div id="comments"><p>A reader comment with very many words so that it looks like an article to a naive reader.</p></div>
<footer>&copy; all rights reserved by the owner of this site</footer></body></html>"""
TEXT = "Headline of the story\nA first paragraph with a fair number of words & more of them, as articles have.\nSecond linked paragraph, also of several words and some bold ones.\nShort end."


@pytest.mark.parametrize("element", ["article", "main", 'div class="post"', "section", "div"])
def test_article_is_found(element):
    page = PAGE % (element, element.split()[0])
    assert main_text.article(page, main_text.DEFAULT) == TEXT


@pytest.mark.parametrize("page, text", [("", ""), ("plain words", "plain words"), ("<p>a &lt; b<p>c", "a < b\nc"), ("<nav>menu only</nav>", ""), ("<p>cut <a hre", "cut"), ("<script>x</script>", ""), ("<p>x</p><!-- never closed", "x")])
def test_odd_pages(page, text):
    assert main_text.article(page, main_text.DEFAULT) == text


BODY = "<article><p>Words of the article.</p><p>And its end.</p></article>"


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><body>{BODY}", f"<html><head><title>T</title><meta charset=x>{BODY}", f"<head><noscript><img src=x>no</noscript><title>T</title></head>{BODY}",
    *[f"<body><{name} a='b'/>{BODY}<{name}>no</{name}>" for name in ("svg", "math", "object", "canvas", "select")],
    f"<body><svg><path d=x>{BODY}", f"<body><div><object data=x>no</div>{BODY}", f"<body><div><select><option>no</div>{BODY}", f"<body><svg><svg>no</svg>no</svg>{BODY}", f"<object><object>no</object><p>no</object>{BODY}"])
def test_unclosed_elements_keep_the_page(page):
    assert main_text.article(page, main_text.DEFAULT) == "Words of the article.\nAnd its end."


@pytest.mark.parametrize("wrapper", ["class='content has-sidebar'", "class='no-sidebar'", "class='post with-comments'", "class='hasSidebar'", "class='search-results'", "class='shareable widget-area main'", "title='a hidden gem'", "data-x='display:none'"])
@pytest.mark.parametrize("element", ["article", "div"])
def test_wrappers_keep_their_article(wrapper, element):
    words = "Many words of a story that goes on for a while and then some more of them, "
    page = f"<body><div class='sidebar'><p>Other things to read today</p></div><div {wrapper}><{element}><p>{words}one.</p><p>{words}two.</p></{element}></div><div class='related-posts'><p>More of it</p></div></body>"
    assert main_text.article(page, main_text.DEFAULT) == f"{words}one.\n{words}two."


@pytest.mark.parametrize("attrs", ["hidden", "hidden=''", "style='color:red;display: none'", "aria-hidden='true'", "class='comments-area'", "class='cookie-notice'"])
def test_other_elements_stay_out(attrs):
    story = "<article><p>Words of the article which is here for all to read.</p></article>"
    page = f"<body>{story}<div {attrs}><p>{'Words that are not of the article. ' * 9}</p></div></body>"
    assert main_text.article(page, main_text.DEFAULT) == "Words of the article which is here for all to read."


@pytest.mark.parametrize("advert, kept", [
    *[(f"{tag}BUY NOW</{tag[1:].split()[0].rstrip('>')}>", "") for tag in ("<div class='is-sponsored'>", "<div class='is-hidden'>", "<a class='ad'>", "<ins class='adsbygoogle'>", "<div class='adbox'>", "<amp-ad>", "<span class='ad'>BUY <span>x</span>")],
    ("<p>Before it <a class='ad'>BUY <b>x</b> NOW</a> and after.</p>", "\nBefore it and after."), ("<p>Before it <a class=ad>BUY NOW</p><p>After it.</p>", "\nBefore it\nAfter it."), ("<p>A <a class='link'>link</a> stays.</p>", "\nA link stays.")])
def test_adverts_within_an_article(advert, kept):
    first, last = "Many words of a story that goes on for a while and then some more.", "Its end is here, and that was all there is to tell of it today."
    assert main_text.article(f"<body><article><p>{first}</p>{advert}<p>{last}</p></article></body>", main_text.DEFAULT) == f"{first}{kept}\n{last}"


def test_best_run_is_the_best_of_all():
    """The linear scan against every contiguous run of random blocks."""
    rng = random.Random(4)
    for _ in range(300):
        found = []
        for _ in range(rng.randrange(1, 12)):
            block = main_text.Block((), rng.random() < 0.2, "p", False)
            block.words, block.tags = rng.randrange(1, 14), [rng.choice(["p", "div", "a", "li"]) for _ in range(rng.randrange(6))]
            block.links = rng.choice([0, block.words])
            found.append(block)
        weights = {**main_text.DEFAULT, "tag:p": -0.3, "tag:div": -2.0}
        own = [weights[main_text._kind(b)] * b.words for b in found]
        tags = [sum(weights.get("tag:" + t, weights["tag"]) for t in b.tags) for b in found]
        # The tags before the first block of a run do not belong to it.
        sums = {(a, b): sum(own[a:b + 1]) + sum(tags[a + 1:b + 1]) for a in range(len(found)) for b in range(a, len(found))}
        run = main_text._best_run(found, weights)
        assert (run is None and max(sums.values()) <= 0) or abs(sums[run] - max(sums.values())) < 1e-9


def test_accuracy_without_the_markup(spark):
    """Pages with the article element's name hidden give the text of that element."""
    pages = [x.html for x in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    counts = sum((main_text.count_kinds(p) for p in pages), Counter())
    weights = main_text.weights_from(counts)
    right = 0
    for page in pages:
        parts = (" ".join(html.unescape("".join(b.parts)).split()) for b in main_text.blocks(page) if b.inside and not b.never)
        right += main_text.article(re.sub(r"<(/?)article\b", r"<\1div", page), weights) == "\n".join(t for t in parts if t)
    assert right >= 0.98 * len(pages)


def test_long_page_is_linear():
    page = "<div>" + "".join(f"<p>{'word ' * 20}{i}</p>" for i in range(20_000)) + "</div>"
    assert main_text.article(page, main_text.DEFAULT).count("\n") == 19_999


def test_extract(spark):
    rows = [(1, "u", PAGE % ("article", "article"), "x"), (2, None, None, "x"), (None, "v", "", "x"), (1, "u", PAGE % ("article", "article"), "x")]
    found = main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [(x.page_id, x.url, x.text) for x in found] == [(1, "u", TEXT), (2, None, ""), (None, "v", ""), (1, "u", TEXT)]
    assert all(x.n_chars == len(x.text) for x in found)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert main_text.extract(empty).count() == 0


def test_weights_keep_their_signs(spark):
    weights = main_text.learn_weights(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    assert all((w < 0) == (k == "never" or k.startswith("tag")) for k, w in weights.items())


def test_revisits(spark):
    def record(i, url, kind, ts, **headers):
        return (i, url, kind, ts, {k.replace("_", "-"): v for k, v in headers.items()}, f"d{i}" if kind == "response" else None, 10 * i if kind == "response" else None, "x")

    rows = [record(1, "http://www.a.com/x/", "response", 100, etag='"1"', content_type="t"), record(2, "https://a.com:443/x?utm_source=f#top", "revisit", 200, etag='W/"1"', content_type="no", expires="e"),
            record(3, "http://a.com/x", "revisit", 300, etag='"2"'), record(4, "http://a.com/x", "revisit", 100), record(5, "http://a.com/x", "response", 400, last_modified="m"),
            record(6, "http://a.com/x", "revisit", 200_000_000, last_modified="m"), record(7, "http://b.com/", "revisit", 5), record(8, None, "revisit", 500), record(9, "http://a.com/x", "revisit", None),
            record(10, "http://a.com/x", "metadata", 500), (11, "http://c.com", "response", 1, None, None, None, "x")]
    frame = spark.createDataFrame(rows, "record_id long, url string, kind string, ts long, headers map<string,string>, digest string, n_bytes long, span string")
    found = {x.record_id: x for x in warc.resolve_revisits(frame).collect()}
    assert {i: x.status for i, x in found.items()} == {1: "response", 2: "resolved", 3: "changed", 4: "no_target", 5: "response", 6: "resolved", 7: "no_target", 8: "no_target", 9: "no_target", 10: "no_target", 11: "response"}
    assert (found[2].response_id, found[2].digest, found[2].n_bytes) == (1, "d1", 10)
    assert found[2].headers == {"etag": 'W/"1"', "content-type": "t", "expires": "e"}
    assert found[6].response_id == 5
    assert warc.resolve_revisits(frame.limit(0)).count() == 0


def test_revisits_with_repeated_record_ids(spark):
    """Rows are matched one by one: each revisit once, by its own URL, whatever ids repeat."""
    schema = "record_id long, url string, kind string, ts long, headers map<string,string>, digest string, n_bytes long"
    rows = [(1, "http://a.com/x", "response", 10, {}, "A", 1), (1, "http://b.com/x", "response", 10, {}, "B", 2), (2, "http://a.com/x", "revisit", 20, {}, None, None),
            (2, "http://b.com/x", "revisit", 20, None, None, None), (2, "http://b.com/x", "revisit", 20, None, None, None), (None, "http://a.com/x", "revisit", 30, {}, None, None)]
    found = warc.resolve_revisits(spark.createDataFrame(rows, schema)).where("kind = 'revisit'").collect()
    assert sorted((r.record_id or 0, r.canonical, r.status, r.digest) for r in found) == [
        (0, "a.com/x", "resolved", "A"), (2, "a.com/x", "resolved", "A"), (2, "b.com/x", "resolved", "B"), (2, "b.com/x", "resolved", "B")]
