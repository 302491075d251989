import html
import re
import time

import pytest
from hypothesis import given, settings, strategies as st
from spanwatch.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script>
</head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy it
now, buy it all</div><article><h1>Caf&eacute; &amp; bar</h1><p>First  one\nwith words here.
<p>Second <b>bold</b> one&nbsp;here.<br>Still it.</article><form>Name <input></form>
<div id="comments"><p>I like this article very much indeed</p></div><footer>&copy; me</footer>"""
TEXT = "Café & bar\nFirst one with words here.\nSecond bold one here. Still it."


@pytest.fixture(scope="module")
def learned():
    return html_text.weights(html_text.counts(PAGE))


def test_the_article_and_nothing_else(learned):
    assert html_text.main_text(PAGE, learned) == TEXT
    # Without the mark-up that pages are labelled by, and with no labelled page at all.
    bare = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    assert html_text.main_text(bare, learned) == TEXT
    assert html_text.main_text(bare, html_text.weights(html_text.Counter())) == TEXT


def test_an_advert_inside_does_not_end_the_article(learned):
    words = "These are words of the story that go on for some time. "
    page = f"<body><p>{words}</p><div class='ad-box'>{'buy ' * 50}</div><p>{words * 2}</p>"
    assert html_text.main_text(page, learned) == f"{words.strip()}\n{(words * 2).strip()}"


def test_missing_end_tags_do_not_swallow_the_page(learned):
    words = "These are words of the story that go on for some time."
    for head in ("<head>", "<head><title>T</title><meta charset=x><!-- c -->\n<style>p{}</style>",
                 "<head><noscript><p>Turn it on</p></noscript></title><link href=x>"):
        assert html_text.main_text(f"<html>{head}<p>{words}", learned) == words
        assert html_text.main_text(f"<html>{head}<body><p>{words}", learned) == words
    for tag in sorted(html_text.SILENT - html_text.RAW - {"head"}):
        assert html_text.main_text(f"<body><{tag}><p>{words}</p>", learned) == words
        assert html_text.main_text(f"<body><{tag}>no</{tag}><p>{words}", learned) == words
    for tag in sorted(html_text.RAW):
        assert html_text.main_text(f"<head><{tag}><p>{words}", learned) == ""
    assert html_text.pieces("<svg>" * 200_000) == []


def test_the_scan_finds_the_best_stretch():
    def brute(scores):
        best, found = 0.0, (0, 0)
        for b in range(len(scores)):
            for e in range(b + 1, len(scores) + 1):
                if sum(scores[b:e]) > best + 1e-9:
                    best, found = sum(scores[b:e]), (b, e)
        return best, found

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.integers(-5, 5).map(float), max_size=12))
    def check(scores):
        b, e = html_text.best_stretch(scores)
        assert sum(scores[b:e]) == pytest.approx(brute(scores)[0])

    check()


def test_awkward_pages(spark, learned):
    long = "<p>" + "word " * 200_000 + "</p>"
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "<p>", "a"), (4, "just words", "a"), (5, long, "a"),
        (6, "<script>never closed", "a"), (6, "<script>never closed", "a"), (None, "<p>x y", None),
        (7, "<div><div><div" * 50, "a"), (8, "a < b and c > d <3", "a"),
    ]
    schema = "page_id long, html string, text string"
    pages = spark.createDataFrame(rows, schema)
    got = html_text.extract(pages, learned).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: (r["text"], r["n_chars"]) for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[6] == ("", 0)
    assert by_id[4] == ("just words", 10)
    assert by_id[5] == ("word " * 199_999 + "word", 999_999)
    assert by_id[None] == ("x y", 3)
    assert by_id[8][0].startswith("a < b")
    nothing = spark.createDataFrame([], schema)
    assert html_text.extract(nothing, html_text.fit(nothing)).collect() == []


WORDS = "These are words of the story that go on for some time."


@pytest.mark.parametrize(
    "page",
    [
        "<div style='overflow:hidden'><p>{}</p></div>",
        '<div style="overflow:hidden;class=nav"><p>{}</p></div>',
        "<p aria-hidden='false'>{}</p>",
        '<p data-id="ad-12">{}</p>',
        '<p title="no class=nav here">{}</p>',
        "<p data-class=sidebar>{}</p>",
        '<p id="comment-on-economy">{}</p>',
        '<p class="related-work">{}</p>',
        '<H2 CLASS="Social-History">{}</H2>',
        "<p class = 'lead'\n id='x'>{}</p>",
        "<TABLE><TR><TD>{}</TABLE>",
        "<p class='has-sidebar'>{}</p>",
    ],
)
def test_attributes_are_read_whole(learned, page):
    assert html_text.main_text(f"<body>{page.format(WORDS)}", learned) == WORDS


def test_a_link_to_a_comment_is_text(learned):
    page = f'<p>{WORDS} <a href="/x?id=comment12&class=ad">more words</a> of it.</p>'
    assert html_text.main_text(page, learned) == f"{WORDS} more words of it."


@pytest.mark.parametrize(
    "attributes",
    ['CLASS="sidebar"', "class=sidebar", "Class='Post-Comments x'", "ID=ad-12", "hidden", "ROLE=Navigation"],
)
def test_names_in_any_case_leave_out(learned, attributes):
    page = f"<body><p>{WORDS}</p><DIV {attributes}><p>not this one here</p></DIV><p>{WORDS}</p>"
    assert html_text.main_text(page, learned) == f"{WORDS}\n{WORDS}"
    assert html_text.main_text(f"<p>{WORDS}</p><p class='ads'>buy</p><p>{WORDS}</p>", learned) == f"{WORDS}\n{WORDS}"


def test_names_on_texts_have_a_learned_weight():
    """Pages whose notes stand outside their article teach that such notes are not text."""
    note = "<p class='related-work'>see also these other pages</p>"
    outside = f"<article><p>{WORDS * 3}</p></article>{note * 30}"
    using = html_text.weights(html_text.counts(outside))
    assert using.words["p/named"] < 0 < html_text.weights(html_text.Counter()).words.get("p/named", 0.4)
    assert html_text.main_text(f"<p>{WORDS}</p>{note}", using) == WORDS


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * 400_000,
        "<b>" * 200_000 + "</i>" * 200_000,
        "<b><p>" * 200_000,
        "<li><b>" * 200_000,
        "<div>" * 200_000 + "<p>" * 200_000,
        "<a '\"" * 300_000,
        "<!" * 600_000,
        "<a href=x class=" * 100_000,
    ],
)
def test_damaged_pages_take_linear_time(learned, page):
    began = time.process_time()
    got = html_text.main_text(page + f"<p>{WORDS}</p>", learned)
    assert time.process_time() - began < 20
    assert WORDS in got or "<" in page.replace("<b>", "")


def test_the_query_reads_whole_pages(spark):
    """Every article that pages mark up, found by the query as the page's blocks."""
    from spanwatch.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    bodies = dict(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").collect())
    rows = QUERIES["op2_html_text"](spark, sf).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(bodies)
    seen = 0
    for row in rows:
        assert row["n_chars"] == len(row["text"])
        article = re.search(r"<article>(.*?)</article>", bodies[row["page_id"]] or "", re.S)
        if article is None:
            continue
        kept = re.sub(r'(?s)<div class="ad">.*?</div>|<br ?/?>', " ", article[1])
        blocks = re.split(r"</?(?:p|h[1-6]|ul|li)>", kept)
        plain = (" ".join(html.unescape(re.sub("<[^>]*>", "", block)).split()) for block in blocks)
        wanted = [block for block in plain if block]
        assert row["text"].split("\n") == wanted
        seen += 1
    assert seen >= 10
