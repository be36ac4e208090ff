import html as references
import random
import re
import time

import pytest
from quarry.llm import html, queries

from conftest import SF

PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body>"
        "<header><h2>Site</h2></header><nav><ul><li><a href='/x'>Menu</a></li></ul></nav><!-- <p>gone</p> -->"
        "<div class=\"cookie-notice\">We use cookies</div>%s<aside>Side</aside><div id='comments'><p>First! a comment</p></div>"
        "<form><p>Sign up</p><input name=q></form><footer>&copy; 2024</footer></body></html>")


def plain(page):
    m = re.search("<article>(.*?)(</article>|$)", page, re.S)
    blocks = [" ".join(references.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split())
              for b in re.split("</?(?:p|h1)>", m[1])]
    return "\n\n".join(b for b in blocks if b)


def test_query_against_plain_version(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op8_main_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("inside", ["<article>%s</article>", "<main>%s</main>", "<div class=content>%s</div>",
                                    "<article class='post has-sidebar'><div>%s</div><div class='share'>Share me</div></article>"])
def test_layouts(inside):
    body = ("<h1>A title &amp; more</h1><p>The first paragraph, long enough\n to be  the content of a page, with <b>bold</b>"
            " and <a href=#>a link</a>.<br>New line.<p>An open paragraph that is also rather long, as they often are.</p>"
            "<ul><li>One item</li><li>Two&nbsp;items</li></ul><p>Short.</p>")
    assert html.main_text(PAGE % (inside % body)) == "\n\n".join([
        "A title & more", "The first paragraph, long enough to be the content of a page, with bold and a link. New line.",
        "An open paragraph that is also rather long, as they often are.", "One item", "Two items", "Short."])


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<nav>only menu</nav>", ""), ("<p>a < b and b > a</p>", "a < b and b > a"),
    ("<article><p>cut &amp; short</p><p>never clo", "cut & short\n\nnever clo"), ("<article>x<script>y", "x"),
    ("<article><header><h1>Head</h1></header><p>Body</p></article>", "Head\n\nBody"), ("<article>text<a href='x", "text"),
    ("</div></p><article>stray</b> ends</article>", "stray ends"), ("<article><p style='display:none'>no</p>yes</article>", "yes")])
def test_small_pages(page, text):
    assert html.main_text(page) == text


def test_surge_and_dive():
    assert html.regions([0, 0, 5, 40, 60, 3, 0, 0, 0, 50, 0], 40) == [(2, 5), (9, 9)]
    assert html.regions([0, 0], 1) == [] and html.regions([], 1) == []


def test_odd_pages(spark):
    rows = [(1, "u", "<article>a</article>"), (1, "u", "<article>a</article>"), (None, None, None), (2, "u", "<p>" + "x y " * 200_000)]
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(((r.page_id or 0, r.n_chars) for r in html.extract_main_text(df).collect()))
    assert got == [(0, 0), (1, 1), (1, 1), (2, 799_999)]
    assert html.extract_main_text(df.where("false")).collect() == []


STORY = "<h1>A title</h1><p>The story is told here, in a paragraph of some length.</p><p>And it ends here, in another one.</p>"
TOLD = "A title\n\nThe story is told here, in a paragraph of some length.\n\nAnd it ends here, in another one."


@pytest.mark.parametrize("around", [
    '<div class="content-sidebar-wrap"><article>%s</article></div>', '<div class="site has-sidebar"><main>%s</main></div>',
    '<div class="sidebar"><article>%s</article><div class="ad">Buy this</div></div>', '<div class="widget">%s</div><p>Short</p>',
    '<article><section id="related-work">%s</section></article>', '<article><div style="overflow: hidden">%s</div></article>',
    '<article><div title="A hidden gem" data-x="display:none">%s</div></article>', '<article><div class="overflow-hidden">%s</div></article>',
    '<article><div class="article-header"><h1>A title</h1></div>%s</article>', '<div id="app" style="display:none"><main>%s</main></div>'])
def test_marks_of_wrappers(around):
    story = STORY.replace("<h1>A title</h1>", "") if "article-header" in around else STORY
    assert html.main_text(around % story).removesuffix("\n\nShort") == TOLD


@pytest.mark.parametrize("other", [
    '<div class="ad">Buy</div>', '<div class="cookie-notice">We use cookies</div>', '<div class="site-footer">Imprint</div>',
    '<div id="comments" class="comments-area"><article><p>%s</p></article></div>' % ("A long comment. " * 50), '<p hidden>no</p>',
    '<div class="related-posts"><article>Next</article></div>', '<div role="search">Find</div>', '<p aria-hidden="true">no</p>',
    '<div class="post-share">Share</div>', '<div aria-label="Related stories">More</div>', '<p style="color:red; visibility:hidden">no</p>'])
def test_marked_elements_stay_off(other):
    for page in ("<article>%s</article>%s", "%s%s", "<main><article>%s</article>%s</main>"):
        if "comments" not in other or "article" in page:
            assert html.main_text(page % (STORY, other)) == TOLD


def test_all_regions_of_pages_without_article():
    w = [40, 150, 160, 150, 170, 20_000, 150, 0, 180, 160]
    texts = [f"{k} " + "x" * (n - 2) for k, n in enumerate(w) if n]
    blocks = [f"<p>{t}</p>" for t in texts]
    advert = "<div class=ad>Buy this</div>"
    for between in (advert, advert * 3, "<ul>" + "<li><a href=#>link</a></li>" * 9 + "</ul>"):
        page = "<body><nav>Menu</nav>" + "".join(blocks[:7]) + between + "".join(blocks[7:]) + "<footer>Imprint</footer></body>"
        assert html.main_text(page) == "\n\n".join(texts)
    page = "<body><div>%s</div>" + advert * 3 + "<div>Home</div></body>"
    page = page % (advert * 3).join(["".join(blocks[:3]), "<p>short</p>", "".join(blocks[3:])])
    assert html.main_text(page) == "\n\n".join([*texts[:3], "short", *texts[3:]])


def test_regions_begin_with_lines_before_the_surge():
    assert html.regions([0, 5, 5, 5, 5, 90, 90, 0], 40) == [(1, 6)]
    assert html.regions([50, 0, 0, 0, 3, 1, 1, 60], 40) == [(0, 0), (4, 7)]


#: (before, repeated, after, times that make a megabyte)
BROKEN = {
    "open quotes": ("", '<a b="c>x', "", 110_000), "odd quotes": ("", '<a "b', "", 200_000), "both quotes": ("", "<a 'b<a \"b", "", 100_000),
    "mixed quotes": ("", "<a b=\"c' d>e'", "", 80_000), "tags without an end": ("", "<a ", "", 330_000), "signs": ("", "<", "", 1_000_000),
    "open comments": ("", "<!-- a ", "", 150_000), "declarations": ("", "<!x", "", 300_000), "cdata": ("", "<![CDATA[", "", 110_000),
    "ends without a start": ("<b>" * 100_000, "</i>", "", 170_000), "nested paragraphs": ("<p><div>" + "<b>" * 100_000, "<p>x", "", 170_000),
    "nested marks": ("", "<div class=ad>x", "", 66_000), "marks around articles": ("", "<div class=ad><article>x", "", 40_000),
    "open scripts": ("", "<script a='", "", 90_000), "scripts": ("", "<script>", "", 125_000), "ends of scripts": ("<script>", "</script", "", 120_000),
    "attributes": ("<a ", "b ", ">", 500_000), "values": ("<a ", 'b=" ', ">", 250_000), "blanks": ("<p ", " ", ">y", 1_000_000),
    "styles": ("<p style='", "; ", "'>y</p>", 450_000)}


@pytest.mark.parametrize("name", sorted(BROKEN))
def test_broken_pages_take_linear_time(name):
    """A megabyte of broken markup, and the time of a half and a whole."""
    before, repeated, after, n = BROKEN[name]
    times = []
    for k in (n // 2, n):
        page = before + repeated * k + after
        start = time.process_time()
        html.main_text(page)
        times.append(time.process_time() - start)
    assert len(page) >= 900_000
    assert times[1] < 4 and (times[1] < 0.4 or times[1] < 3.2 * times[0])


@pytest.mark.parametrize("page,text", [
    ('<article><p title="a > b <c>">one</p><p>two</article>', "one\n\ntwo"), ("<article><p title='it\"s'>one</p>two</article>", "one\n\ntwo"),
    ('<article><p class="x>one</p><p>two</p></article>', "one\n\ntwo"), ('<article><a href="x>link</a> text</article>', "link text"),
    ("<article>a <!-- b > c --> d<!-- e", "a d"), ("<article>a<![CDATA[ <p>no</p> ]]>b</article>", "a b"),
    ("<article><SCRIPT>if (a<b) '</p>'</Script >x</article>", "x"), ("<article>a <3 b </> c</article>", "a <3 b c"),
    ("<article>x<style>y</article>", "x"), ("<article><textarea>a</textarea>b<title>c</title></article>", "b")])
def test_quotes_and_unseen_parts(page, text):
    assert html.main_text(page) == text


def test_regions_against_plain_version():
    """Each surge by itself: forward to its dive, back over lines with weight."""
    rng = random.Random(6)
    for _ in range(3000):
        w = [rng.choice([0, 0, 1, 3, 5, 30, 60]) for _ in range(rng.randint(0, 25))]
        surge = rng.choice([1, 10, 40, 90])
        sums = [sum(w[k: k + html.WINDOW]) for k in range(len(w))]
        kept = set()
        for s in range(len(w)):
            if sums[s] >= surge and w[s]:
                first = end = s
                while first and w[first - 1]:
                    first -= 1
                while end < len(w) and sums[end] > 0 and (sums[end] >= surge or w[end]):
                    end += 1
                kept |= {k for k in range(first, end) if w[k]}
        assert kept == {k for a, b in html.regions(w, surge) for k in range(a, b + 1) if w[k]}


def test_pages_without_article_against_plain_version():
    """Blocks in boxes with adverts between them: what stays, told from the weights alone."""
    rng = random.Random(7)
    for _ in range(300):
        page, w, boxes, texts = ["<body>"], [], [], []
        for box in range(1, rng.randint(2, 5)):
            page.append("<div>")
            for _ in range(rng.randint(1, 6)):
                advert, size = rng.random() < 0.3, rng.choice([5, 20, 80, 200, 900])
                text = f"{len(texts)}" + "x" * size
                page.append(f"<p hidden>{text}</p>" if advert else f"<p>{text}</p>")
                w.append(0 if advert else len(text))
                boxes.append(box)
                texts.append(text)
            page.append("</div>")
        weighty = sorted(k for k in w if k)
        if not weighty:
            continue
        mid = len(weighty) // 2
        typical = weighty[mid] if len(weighty) % 2 else (weighty[mid - 1] + weighty[mid]) / 2
        sums = [sum(w[k: k + 3]) for k in range(len(w))]
        surge = min(max(sums), max(40, 0.2 * 3 * typical))
        kept = sorted({k for a, b in html.regions(w, surge) for k in range(a, b + 1)})
        between = [(a, b) for (_, a), (b, _) in zip(html.regions(w, surge), html.regions(w, surge)[1:])]
        for a, b in between:
            kept += [k for k in range(a + 1, b) if b - a <= 4 or boxes[k] == boxes[a] == boxes[b]]
        assert html.main_text("".join(page)) == "\n\n".join(texts[k] for k in sorted(set(kept)) if w[k])
