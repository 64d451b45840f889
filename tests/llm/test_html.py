"""Main text of pages, and the minimum cut behind it."""

from html.parser import HTMLParser
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st

from tempestry.llm import html

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to improve your experience on this web site. Please accept them all now.</p></div>
<main><article><header><h2>Title of it</h2></header><p>First   paragraph with &eacute;t&eacute; &amp; a <a href=x>link</a>
here and a lot more of words.<p>Short.</p><ul><li>item one<li>item two</ul><!-- <p>no</p> -->
<form><label>Mail</label><input name=q><button>Go</button></form><aside><p>Related: read this other story too, it is good.</p></aside>
<p hidden>Not shown, though it is long enough to be a paragraph of this text.</p>
<p>Last <b>para<i>graph</i></b> of the text, &#x41;&lt;b&gt;.<br>Ends here.</p></article>
<section id="comments"><h3>Comments</h3><p>I think that this is a very good article and I say so at length, dear friends.</p></section></main>
<footer>&copy; 2024 me</footer></body></html>"""


def test_article_without_boilerplate():
    assert html.main_text(PAGE).split("\n") == [
        "Title of it",
        "First paragraph with été & a link here and a lot more of words.",
        "Short.",
        "item one",
        "item two",
        "Last paragraph of the text, A<b>. Ends here.",
    ]


def test_page_without_semantic_elements():
    body = "".join(f"<div><p>Paragraph {i} tells of something in a whole sentence, as prose does.</p></div>" for i in range(5))
    page = f"<body><div class='top-menu'><a href=1>A</a> <a href=2>B</a></div>{body}<div id=footer>Imprint</div></body>"
    assert html.main_text(page).count("\n") == 4
    assert "Imprint" not in html.main_text(page) and "A" not in html.main_text(page).split()


def test_broken_pages():
    for page in (None, "", "<", "<p", "<!--", "</p></p>", "<script>", "<p class='", "<![CDATA[x", "&", "<table><tr><td>" * 50):
        assert isinstance(html.main_text(page), str)
    assert html.main_text("<article><p>Cut off in the middle of a refer&am") == "Cut off in the middle of a refer&am"
    assert html.main_text("<article><p>Cut off in the middle of a tag</p><p cla") == "Cut off in the middle of a tag"


@given(
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=7).flatmap(
        lambda t: st.tuples(
            st.just(t),
            st.lists(st.tuples(st.integers(0, len(t) - 1), st.integers(0, len(t) - 1), st.integers(0, 4)), max_size=10),
        )
    )
)
@settings(deadline=None, max_examples=300)
def test_cut_is_minimal(case):
    terminal, links = case
    links = [(a, b, w) for a, b, w in links if a != b]

    def cost(kept):
        cut = sum(drop if keep else source for keep, (source, drop) in zip(kept, terminal))
        return cut + sum(w for a, b, w in links if kept[a] != kept[b])

    best = min(cost(kept) for kept in product([False, True], repeat=len(terminal)))
    assert abs(cost(html.minimum_cut(terminal, links)) - best) < 1e-6


def test_elements_that_end_themselves_and_stray_quotes():
    prose = "This paragraph tells of something in a whole sentence, as prose does."
    for odd in (
        '<svg class="icon" viewBox="0 0 1 1"/>',
        "<svg/>",
        "<math />",
        "<svg><path d='M0'/></svg>",
        "<p title=it's>",
        '<p title=5">',
        '<p "odd" data-x>',
        "<p title = 'a > b'>",
        '<img alt="class=ad" src=x>',
        "<p data-a='\"' data-b=\"'\">",
    ):
        assert html.main_text(f"<article><p>{prose}</p>{odd}<p>{prose}</p><p>{prose}</p></article>").split("\n") == [prose] * 3, odd
    # A quote that is never closed takes no more than its tag.
    assert html.main_text(f"<article><p title=\"x>{prose}</p><p>{prose}</p></article>").split("\n") == [prose] * 2
    assert html.main_text(f"<article><p>{prose}</p><p class=\"ad\" title=\">{prose}</p></article>") == prose


def test_long_odd_pages_take_little_time():
    from time import perf_counter

    pieces = ['<a "', "<a '", "<", "<a", '<a x="', "<a x='\"", "<!", "<!-", "</", "<p>", "<a =", "&", "<div><p>x", "x <y ", "<svg>", "<a b=c>", '="', "='<", "<b>x"]
    for piece in pieces:
        size = 1_000_000 if '"' in piece else 200_000
        page = f"<article><p>Some prose of this text.{piece * (size // len(piece))}"
        start = perf_counter()
        list(html.blocks(page))
        assert perf_counter() - start < 2, piece
    deep = "<div>" * 300 + "<p>Some prose of this text.</p>" + "</div>" * 300
    assert html.main_text(f"<article>{deep}<p>And some more of it.</p></article><p class=ad>Buy.</p>").split("\n") == [
        "Some prose of this text.", "And some more of it.",
    ]


class _Article(HTMLParser):
    """Blocks of text in the articles of a page, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.unseen, self.blocks = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.unseen += tag in ("script", "style", "form", "aside")
        if tag == "br":
            self.blocks[-1] += " "
        elif tag not in html.INLINE:
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.unseen -= tag in ("script", "style", "form", "aside")
        if tag not in html.INLINE:
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth and not self.unseen:
            self.blocks[-1] += data

    def text(self):
        return "\n".join(" ".join(b.split()) for b in self.blocks if b.strip())


def test_all_given_pages_against_another_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    held = {r.page_id: r.html for r in pages.collect()}
    found = {r.page_id: r for r in html.extract(pages).collect()}
    assert found.keys() == held.keys()
    for page_id, page in held.items():
        parser = _Article()
        parser.feed(page or "")
        parser.close()
        assert found[page_id].text == parser.text(), page_id


def test_extract(spark):
    rows = [(1, "u", PAGE, 3), (1, "u", PAGE, 3), (2, None, None, 4), (None, "v", "", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = html.extract(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in got) == [(0, "v", 0), (1, "u", 145), (1, "u", 145), (2, "", 0)]
    assert html.extract(pages.limit(0)).count() == 0


def test_trained_classifier_reads_pages_without_semantic_elements(spark):
    """Trained on pages that tell their parts, and asked for held-out pages that do not."""
    words = "the of and words tell much about something that happened here in prose".split()
    sentence = lambda i, n: " ".join(words[(i * 7 + k * k) % len(words)] for k in range(n)).capitalize() + "."

    def page(i, semantic):
        nav = "".join(f"<li><a href=/{k}>{words[(i + k) % 9]}</a></li>" for k in range(6))
        body = "".join(f"<p>{sentence(i + k, 12 + k)}</p>" for k in range(5))
        parts = ("nav", "article", "footer") if semantic else ("div", "div", "div")
        return f"<body><{parts[0]}><ul>{nav}</ul></{parts[0]}><{parts[1]}>{body}</{parts[1]}><{parts[2]}>&copy; {i} all rights</{parts[2]}></body>"

    pages = spark.createDataFrame([(i, "u", page(i, True)) for i in range(60)], "page_id long, url string, html string")
    odds = html.train(pages)
    assert odds["links:4"] < -1 and odds["tag:p"] > 1
    for i in range(100, 130):
        assert html.main_text(page(i, False), odds).split("\n") == [sentence(i + k, 12 + k) for k in range(5)]
    assert html.train(pages.limit(0)) is None


def _wrapped(i):
    """A page whose article lies in elements with words for boilerplate in their classes."""
    prose = [f"Paragraph {i + k} tells at some length of something that happened, in a whole sentence as prose does." for k in range(4)]
    body = "".join(f"<p>{p}</p>" for p in [*prose[:2], "So it is.", *prose[2:]])
    page = (
        f'<body><nav><ul><li><a href=1>One</a></li><li><a href=2>Two {i}</a></li></ul></nav>'
        f'<div id="page" class="site has-sidebar"><div class="content-sidebar-wrap"><article class="long-form">{body}</article></div>'
        f'<div class="sidebar"><ul><li><a href=3>Other</a></li></ul><p>Read more.</p></div></div><footer>&copy; {i} me</footer></body>'
    )
    return page, [*prose[:2], "So it is.", *prose[2:]]


def test_article_outweighs_words_of_its_wrappers(spark):
    pages = [_wrapped(i) for i in range(30)]
    odds = html.train(spark.createDataFrame([(i, p) for i, (p, _) in enumerate(pages)], "page_id long, html string"))
    assert odds["tag:p"] > 0 > odds["links:4"]
    for page, text in pages:
        assert html.main_text(page).split("\n") == text
        assert html.main_text(page, odds).split("\n") == text
        in_form = page.replace("<body>", '<body><form id="aspnetForm">')
        assert html.main_text(in_form).split("\n") == html.main_text(in_form, odds).split("\n") == text
    for page in ('<aside><article><p>A teaser.</p></article></aside>', '<article class="ad"><p>Buy it.</p></article>'):
        assert html.main_text(page) == ""


def test_marks_and_neighbours_turn_blocks_of_an_article():
    odds = {"tag:p": 2.0, "ends:True": 1.0, "links:0": 1.0, "tag:li": -2.0, "links:4": -2.0, "ends:False": -2.0, "length:0": -2.0}
    links = "".join(f"<li><a href={i}>Share {i}</a></li>" for i in range(4))
    page = f"<article><p>Some prose of this text.</p><ul>{links}</ul></article>"
    assert html.main_text(page, odds) == "Some prose of this text."
    prose = "<p>This paragraph tells of something in a whole sentence, as prose does.</p>"
    page = f"<article>{prose * 2}<p><a href=x>&copy; the photographer</a></p>{prose * 2}</article>"
    alone = "<article><p><a href=x>&copy; the photographer</a></p></article>"
    source, sink = html.costs(html.blocks(page)[2])
    assert source == 0 < sink and html.main_text(alone) == ""
    assert html.main_text(page).split("\n")[2] == "© the photographer"
