import html
import random

import pytest
from pyspark.sql import functions as F

from quotemart.llm.htmltext import containers, extracted, main_text, paragraphs, parse

PROSE = "This is a long enough sentence, with a comma or two, that reads like the prose of an article and nothing else."


def page(inner, before="", after=""):
    return (
        f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
        f'<nav><ul><li><a href="/">Home</a></li></ul></nav>{before}{inner}{after}<footer>&copy; me</footer></body></html>'
    )


def test_articles_come_whole_and_in_order():
    inner = f"<article><h1>Head &amp; line</h1><p><b>Lead</b> one<br>two<p>{PROSE}</p><ul><li>first<li>second</ul><table><tr><td>a<td>b</table></article>"
    assert main_text(page(inner)).split("\n") == ["Head & line", "Lead one two", PROSE, "first", "second", "a", "b"]


@pytest.mark.parametrize(
    "noise",
    ['<div class="ad">Buy now, today, and cheap, very cheap indeed.</div>', '<div id="sidebar"><p>Other, news, items, and, more, of, it.</p></div>',
     f'<section class="comments"><h2>Comments</h2><p>{PROSE}</p><p>{PROSE}</p></section>', f'<div class="cookie-notice"><p>{PROSE}</p></div>',
     f"<form><p>{PROSE}</p><input><button>Go</button></form>", f"<aside><p>{PROSE}</p></aside>", "<!-- <p>no</p> -->", "<script>p(', , ,')</script>",
     f'<div role="navigation"><p>{PROSE}</p></div>', f'<p style="display: none">{PROSE}</p>', f'<div class="newsletterSignup">{PROSE}</div>',
     '<div class="related"><ul><li><a href="a">One more, story, to read</a></li></ul></div>'],
)
def test_furniture_goes_inside_and_beside(noise):
    for body in ("<article>{}</article>", "<main>{}</main>", '<div id="content"><div class="post">{}</div></div>'):
        text = f"<h1>Title</h1><p>{PROSE}</p>{{}}<p>{PROSE} Again.</p>"
        want = ["Title", PROSE, f"{PROSE} Again."]
        assert main_text(page(body.format(text.format(noise)))).split("\n") == want
        assert main_text(page(body.format(text.format("")), before=noise, after=noise)).split("\n") == want


def test_the_best_container_wins_over_link_lists():
    links = "".join(f'<li><a href="{k}">A headline, with commas, number {k}, of the day</a></li>' for k in range(40))
    inner = f"<div><ul>{links}</ul></div><div><p>{PROSE}</p><p>{PROSE} Two.</p><p>Short.</p></div>"
    assert main_text(page(inner)).split("\n") == [PROSE, f"{PROSE} Two.", "Short."]


def test_points_fall_with_the_distance_and_the_links():
    root = parse(f"<div><section><p>{'x' * 100}, y</p></section></div>")
    blocks, nodes = paragraphs(root)
    containers(blocks, nodes)
    score = {n.tag: n.score for n in nodes}
    points = 1 + 1 + 103 / 100
    assert score["section"] == pytest.approx(points) and score["div"] == pytest.approx(points / 2) and score["#root"] == pytest.approx(points / 6)
    blocks, nodes = paragraphs(parse(f"<div><p>{'x' * 50}<a>{'y' * 50}</a></p></div>"))
    containers(blocks, nodes)
    assert {n.tag: n.score for n in nodes}["div"] == pytest.approx(2 * 0.5)


def test_references_and_white_space():
    assert main_text(f"<p>{PROSE}&nbsp;&#8212; a\n\t b&lt;c&gt; &eacute;&amp;amp; &bogus; &amp</p>") == f"{PROSE} — a b<c> é&amp; &bogus; &"


@pytest.mark.parametrize("text", [None, "", " \n", "<html></html>", "<", "<p", "</p>", "<!--", "<a href='", "&", "<nav>only</nav>", "<script>x"])
def test_pages_without_text(text):
    assert main_text(text) in ("", "&", "<")


def test_any_cut_and_deep_or_long_page_is_read():
    whole = page(f"<article><h1>H</h1><p>{PROSE}</p><div><p>{PROSE}</p></div></article>")
    for k in range(0, len(whole), 7):
        main_text(whole[:k])
    assert main_text("<div>" * 20_000 + f"<p>{PROSE}</p>") == PROSE
    long = "<article>" + f"<p>{PROSE}</p>" * 4000 + "</article>"
    assert main_text(long) == "\n".join([PROSE] * 4000)
    rng = random.Random(1)
    for _ in range(300):
        main_text("".join(rng.choices(["<p>", "</p>", "<div class=x>", "</div>", "<li>", "<td>", "</table>", "<a>", "text, ", "<b", ">", '"', "<!--", "&amp;", "</", "<br/>"], k=60)))


def test_extracted_rows(spark):
    rows = [(1, "u", page(f"<article><p>{PROSE}</p></article>")), (2, None, None), (3, "u", ""), (None, "u", f"<p>{html.escape('é<&' * 40)}</p>"), (1, "u", f"<p>{PROSE}")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("N_CHARS", F.lit(1))
    got = sorted((tuple(r) for r in extracted(pages).collect()), key=repr)
    want = [(1, "u", PROSE, len(PROSE)), (2, None, "", 0), (3, "u", "", 0), (None, "u", "é<&" * 40, 120), (1, "u", PROSE, len(PROSE))]
    assert got == sorted(want, key=repr) and extracted(pages.limit(0)).collect() == []


def test_an_article_split_over_unequal_parts_stays_whole():
    long, short = "word, " * 2 + "a" * 288, "b" * 150
    for tag in ("div", "section"):
        a, b = "".join(f"<p>{long}</p>" for _ in range(6)), f"<p>{short}</p>" * 2
        links = '<a href="x">' + "c" * 200 + "</a>"
        got = main_text(f"<body><div><{tag}>{a}</{tag}><{tag}>{b}</{tag}><{tag}>{links} d</{tag}></div></body>")
        assert got.count(short) == 2 and got.count("word") == 12 and "c" * 200 not in got


def page_of(inner):
    return f"<html><body><nav><a href=x>Home</a></nav>{inner}<footer>Imprint</footer></body></html>"


@pytest.mark.parametrize(
    "comment",
    [
        '<article class="comment">%s</article>',
        '<article id="comment-12" class="comment">%s</article>',
        '<section id="comments"><article class="comment-body">%s</article></section>',
        '<div class="comment-list"><p>%s</p></div>',
        '<ol class="commentlist replies"><li>%s</li></ol>',
    ],
)
def test_comments_inside_the_article_go(comment):
    page = page_of(f"<article><p>{PROSE}</p>{comment % 'I was first, and I do not agree, sorry.'}<p>End, of it.</p></article>")
    assert main_text(page) == f"{PROSE}\nEnd, of it."


@pytest.mark.parametrize(
    "tag,names",
    [
        ("section", 'id="social-history"'),
        ("section", 'id="related-work"'),
        ("div", 'id="legal-aspects"'),
        ("p", 'class="follow-up"'),
        ("section", 'id="legal"'),
        ("div", 'class="side-effects"'),
        ("section", 'id="header-compression"'),
        ("div", 'class="share-of-the-market"'),
    ],
)
def test_sections_named_by_their_matter_stay(tag, names):
    for around in ("article", "main"):
        page = page_of(f"<{around}><p>{PROSE}</p><{tag} {names}>More of it, here.</{tag}></{around}>")
        assert main_text(page) == f"{PROSE}\nMore of it, here."


@pytest.mark.parametrize("names", ['class="related-posts"', 'class="social-share-buttons"', 'class="newsletter-signup box"', 'id="sidebar"', 'class="ad"', 'class="share"'])
def test_furniture_inside_the_article_goes(names):
    page = page_of(f"<article><p>{PROSE}</p><div {names}>Read these, too.</div></article>")
    assert main_text(page) == PROSE


@pytest.mark.parametrize("drawing", ["<svg/>", '<svg viewBox="0 0 1 1" />', "<math/>", "<svg><path d='M0'/><text>x</text></svg>"])
def test_a_drawing_ends_where_it_ends(drawing):
    assert main_text(page_of(f"<article><p>{PROSE}</p>{drawing}<p>End, of it.</p></article>")) == f"{PROSE}\nEnd, of it."


def test_a_form_around_the_page_is_a_container():
    inner = f'<input type="hidden" name="state"><article><p>{PROSE}</p></article>'
    assert main_text(page_of(f"<form action=x>{inner}</form>")) == PROSE
    assert main_text(f"<form><div><p>{PROSE}</p><p>{PROSE}</p></div><form><p>Name, please</p></form></form>") == f"{PROSE}\n{PROSE}"
    assert main_text(page_of(f"<article><p>{PROSE}</p><form><p>Your name, and your address, please.</p></form></article>")) == PROSE


def test_all_articles_of_main_stay():
    page = page_of(f"<main><article><h2>One</h2><p>{PROSE}</p></article><article><h2>Two</h2><p>{PROSE} Again.</p></article></main>")
    assert main_text(page) == f"One\n{PROSE}\nTwo\n{PROSE} Again."
    teasers = "".join(f'<article><a href="{k}">Another story, number {k}</a></article>' for k in range(3))
    assert main_text(page_of(f"<main><article><p>{PROSE}</p></article>{teasers}</main>")) == PROSE


def test_generated_articles_equal_a_second_extractor():
    """Pages from a grammar that says of every block whether it belongs to the article."""
    rng = random.Random(8)
    kept = ["<p>%s</p>", '<section id="related-work"><p>%s</p></section>', "<div><p>%s</p></div>", "<blockquote>%s</blockquote>", "<ul><li>%s</li></ul>", '<p class="follow-up">%s</p>', "<h2>%s</h2>"]
    gone = ['<article class="comment"><p>%s</p></article>', '<div class="ad">%s</div>', "<aside><p>%s</p></aside>", '<section id="comments"><div><p>%s</p></div></section>', "<form><p>%s</p></form>", "<script>%s</script>", '<div class="related-posts"><a href=x>%s</a></div>']
    for k in range(150):
        inner, want = [], []
        for n in range(rng.randint(1, 12)):
            text = f"Block {k} {n}, {PROSE if rng.random() < 0.7 else 'short, but there'}"
            if n == 0 or rng.random() < 0.6:
                want.append(text)
                inner.append(rng.choice(kept) % text)
            else:
                inner.append(rng.choice(gone) % text)
            if rng.random() < 0.2:
                inner.append("<svg/>")
        article = f"<article>{''.join(inner)}</article>"
        page = page_of(rng.choice(["%s", "<main>%s</main>", "<div>%s</div>", "<form>%s</form>"]) % article)
        assert main_text(page) == "\n".join(want), page
