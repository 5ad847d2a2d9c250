from wirelens.functions import html

WORDS = " ".join(f"word{i}" for i in range(60))


def test_article_first_without_boilerplate():
    page = f"<nav>menu</nav><article><div class='read-more'>x</div><p>{WORDS}</p></article><footer>f</footer>"
    assert html.body_text(page) == WORDS


def test_div_with_most_paragraphs():
    half = " ".join(WORDS.split()[:30])
    page = f"<div><p>few</p></div><div><p>{half}</p><p>{half}</p></div>"
    assert html.body_text(page) == f"{half} {half}"


def test_all_paragraphs_else_nothing():
    assert html.body_text("<p>one</p><p> two </p>") == "one two"
    assert html.body_text("<div>no paragraph</div>") == html.body_text("") == html.body_text(None) == ""


def test_unclosed_paragraphs_nest():
    assert html.body_text("<p>a<p>b") == "ab b"


def test_caps():
    assert len(html.body_text(f"<article>{'word ' * 5000}</article>")) <= 6000


def test_roles_and_odd_end_tags():
    page = f"<div role='banner'>top</div></span><article><p>{WORDS}</b></p></article>"
    assert html.body_text(page) == WORDS


def test_cards():
    page = """<li><h3>A headline of ten</h3><a href="/news/2024/05/06/x">go</a><p>lead</p></li>
    <li><a href="https://other.org/x">Elsewhere entirely</a></li><li><a href="#">Nothing to see</a></li>
    <div><a href="/news/2024/05/06/x">The same link again</a></div><article><a href="/b">Short</a></article>"""
    got = html.cards(page, "firm.com")
    assert [(c["title"], c["url"], c["summary"], c["href"]) for c in got] == [("A headline of ten", "https://firm.com/news/2024/05/06/x", "lead", "/news/2024/05/06/x")]
