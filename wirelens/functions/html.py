"""Pages: a small tree of elements, body text, cards, links.

The tree keeps unclosed elements open, as the lenient standard parser reports
them: an end tag closes the nearest open element of its name and all inside
it; one without an open element is ignored; nothing is closed implicitly.
"""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import functions as F

from .constants import BODY_WORDS, FEED_LINK_SCAN, MAX_CHARS, MAX_WORDS, STRIP_CLASS_PARTS, STRIP_ROLES, STRIP_TAGS

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class Element:
    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Element | None):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Element | str] = []

    def walk(self):
        """All elements below, in document order."""
        stack = [x for x in reversed(self.children) if isinstance(x, Element)]
        while stack:
            e = stack.pop()
            yield e
            stack += [x for x in reversed(e.children) if isinstance(x, Element)]

    def texts(self):
        stack: list[Element | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif x.name not in ("script", "style", "template"):
                stack += reversed(x.children)

    def text(self, between: str = "", strip: bool = True) -> str:
        parts = [t.strip() for t in self.texts()] if strip else list(self.texts())
        return between.join(p for p in parts if p or not strip)

    def first(self, *names: str, having: str | None = None) -> Element | None:
        return next((e for e in self.walk() if e.name in names and (having is None or having in e.attrs)), None)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)
        self.open: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        given: dict[str, str] = {}
        for k, v in attrs:
            given[k] = v or ""
        e = Element(tag, given, self.at)
        self.at.children.append(e)
        if tag not in _VOID:
            self.at = e
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        while self.open.get(tag):
            name, self.at = self.at.name, self.at.parent
            self.open[name] -= 1
            if name == tag:
                return

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def is_boilerplate(e: Element) -> bool:
    """By name, role, or a class name that contains one of the fragments anywhere."""
    classes = " ".join(e.attrs.get("class", "").split()).lower()
    return e.name in STRIP_TAGS or e.attrs.get("role", "").lower() in STRIP_ROLES or any(p in classes for p in STRIP_CLASS_PARTS)


def _prune(e: Element) -> None:
    stack = [e]
    while stack:
        x = stack.pop()
        x.children = [c for c in x.children if isinstance(c, str) or not is_boilerplate(c)]
        stack += [c for c in x.children if isinstance(c, Element)]


def cap(text: str) -> str:
    w = text.split()
    return (" ".join(w[:MAX_WORDS]) if len(w) > MAX_WORDS else text)[:MAX_CHARS]


def body_text(html: str | None) -> str:
    """The article element; else the div with most paragraphs of its own; else all paragraphs; else nothing."""
    root = parse(html)
    _prune(root)
    article = root.first("article")
    if article and len((t := article.text(" ")).split()) >= BODY_WORDS:
        return cap(t)
    own = lambda d: sum(1 for c in d.children if isinstance(c, Element) and c.name == "p")
    divs = [e for e in root.walk() if e.name == "div"]
    if divs and own(best := max(divs, key=own)) >= 2 and len((t := best.text(" ")).split()) >= BODY_WORDS:
        return cap(t)
    t = " ".join(e.text() for e in root.walk() if e.name == "p")
    return cap(t) if t.strip() else ""


def cards(html: str | None, domain: str) -> list[dict]:
    """Linked entries of a press page on the firm's own host, each url once: in article, then li, then div elements."""
    root, out, seen = parse(html), [], set()
    elements = list(root.walk())
    for name in ("article", "li", "div"):
        for box in (e for e in elements if e.name == name):
            link = box.first("a", having="href")
            href = link.attrs["href"] if link else ""
            if not href or href == "#":
                continue
            try:
                url = urljoin(f"https://{domain}", href)
                host = urlparse(url).netloc
            except ValueError:
                continue
            if host and domain not in host:
                continue
            heading = box.first("h1", "h2", "h3", "h4")
            title = (heading.text() if heading else "") or link.text()
            if len(title) < 10 or url in seen:
                continue
            seen.add(url)
            stamp, lead = box.first("time"), box.first("p")
            out.append({"ord": len(out), "title": title, "url": url, "summary": lead.text()[:300] if lead else "", "time_attr": stamp.attrs.get("datetime") if stamp else None, "text": box.text(strip=False), "href": href})
    return out


CARDS = "array<struct<ord:int,title:string,url:string,summary:string,time_attr:string,text:string,href:string>>"


def _bodies(html: pd.Series) -> pd.Series:
    return html.map(body_text)


def _cards(html: pd.Series, domain: pd.Series) -> pd.Series:
    return pd.Series([cards(h, d or "") for h, d in zip(html, domain, strict=True)])


def _joined(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([urljoin(b or "", h or "") for b, h in zip(base, href, strict=True)])


def body_text_udf(html):
    return F.pandas_udf(_bodies, "string")(html)


def cards_udf(html, domain):
    return F.pandas_udf(_cards, CARDS)(html, domain)


def join_url_udf(base, href):
    return F.pandas_udf(_joined, "string")(base, href)


FEED_LINK = r"""(?i)<link[^>]+type=["']application/(rss|atom)\+xml["'][^>]+href=["']([^"']+)["']"""


def feed_links(html):
    """Targets of a page's feed links, in order, from its first FEED_LINK_SCAN characters."""
    return F.regexp_extract_all(F.left(html, F.lit(FEED_LINK_SCAN)), F.lit(FEED_LINK), F.lit(2))


def hrefs(html):
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href=["']([^"']*)["']"""), F.lit(1))
