"""Labelled pages for training: layouts put together at random from parts whose label is known."""

from __future__ import annotations

import random

from .html import FIT_PAGES, Block, Field, fit_field, leaf_blocks

# fixed values: names that web pages give to their parts
CONTENT = ("content", "post", "entry", "article-body", "post-content", "story", "main-content", "entry-content", "text", "body-text", "article", "page-content", "blog-post", "prose", "markdown-body")
MENU = ("menu", "nav", "navbar", "navigation", "main-menu", "breadcrumb", "breadcrumbs", "topbar", "site-nav", "tabs", "toc", "pagination", "pager")
HEAD = ("header", "site-header", "masthead", "banner", "page-header", "top", "logo", "branding")
FOOT = ("footer", "site-footer", "bottom", "copyright", "colophon", "page-footer", "legal")
SIDE = ("sidebar", "side", "widget", "related", "aside", "recommended", "popular", "trending", "rail", "tags", "archive", "author-bio", "more-stories", "read-more")
NOTICE = ("notice", "cookie-notice", "cookie", "cookie-banner", "consent", "gdpr", "alert", "popup", "modal", "disclaimer", "announcement", "paywall", "message", "warning")
ADVERT = ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner-ad", "adsbygoogle", "promotion", "commercial")
FORM = ("search", "newsletter", "subscribe", "login", "signup", "contact-form", "subscription", "search-form")
COMMENT = ("comments", "comment", "comment-list", "discussion", "responses", "replies", "respond", "disqus", "comment-body", "reader-comments")
SHARE = ("share", "social", "sharing", "share-buttons", "social-links", "follow-us", "toolbar", "print")


class _Page:
    def __init__(self, seed: int):
        self.r, self.html, self.labels = random.Random(seed), [], []

    def words(self, least: int, most: int) -> str:
        r = self.r
        words = ["".join(r.choices("aeioulnrstdmcpéü", k=r.randint(2, 9))) for _ in range(r.randint(least, most))]
        return " ".join(words).capitalize()

    def text(self, label: int, least: int, most: int, end: str = "") -> None:
        self.html.append(self.words(least, most) + end)
        self.labels.append(label)

    def one(self, tag: str, label: int, least: int, most: int, end: str = "", named: str = "") -> None:
        self.html.append(f"<{tag}{named}>")
        self.text(label, least, most, end)
        self.html.append(f"</{tag}>")

    def name(self, names: tuple[str, ...]) -> str:
        r, name = self.r, self.r.choice(names)
        name += r.choice(("", "", "", "-wrapper", " clearfix", "-area", f" {self.words(1, 1).lower()}", "-2"))
        return r.choice((f' class="{name}"', f" class='{name}'", f' id="{name}"', f' id="{name}" class="box"'))

    def links(self, wrap: str = "ul") -> None:
        self.html.append(f"<{wrap}>")
        for _ in range(self.r.randint(2, 7)):
            self.html.append('<li><a href="/x">')
            self.text(0, 1, 4)
            self.html.append("</a></li>")
        self.html.append(f"</{wrap}>")

    def part(self, kind: str) -> None:
        """A part that is not the article."""
        r = self.r
        names, tags = {"menu": (MENU, ("nav", "nav", "div", "ul")), "head": (HEAD, ("header", "header", "div")), "foot": (FOOT, ("footer", "footer", "div")),
                       "side": (SIDE, ("aside", "aside", "div", "section")), "notice": (NOTICE, ("div", "div", "section", "dialog", "p")), "advert": (ADVERT, ("div", "div", "aside", "section", "p")),
                       "form": (FORM, ("form", "form", "div")), "comment": (COMMENT, ("div", "section", "section", "aside", "ol")), "share": (SHARE, ("div", "ul", "p"))}[kind]
        tag = r.choice(tags)
        plain = tag in ("nav", "header", "footer", "aside", "form", "dialog") and r.random() < 0.45
        self.html.append(f"<{tag}{'' if plain else self.name(names)}>")
        if tag == "p":
            self.text(0, 2, 25, r.choice(("", ".")))
        elif kind == "menu":
            self.links() if tag != "ul" else [self.one("li", 0, 1, 3) for _ in range(r.randint(2, 6))]
        elif kind == "head":
            if r.random() < 0.6:
                self.one(r.choice(("h1", "div", "p", "h2")), 0, 1, 4)
            if r.random() < 0.5:
                self.one("p", 0, 2, 9)
            if r.random() < 0.5 or not self.labels:
                self.links()
        elif kind == "foot":
            if r.random() < 0.7:
                self.html.append("&copy; 2024 &middot; " if r.random() < 0.6 else "")
                self.text(0, 2, 14, r.choice(("", ".")))
            for _ in range(r.randint(0, 3)):
                self.one("p", 0, 2, 20, ".")
            if r.random() < 0.4:
                self.links()
            self.html.append("" if self.html[-1].startswith("</") else "<hr>")
        elif kind == "side":
            if r.random() < 0.7:
                self.one(r.choice(("h2", "h3", "h4")), 0, 1, 4)
            self.links() if r.random() < 0.6 else [self.one("p", 0, 3, 30, ".") for _ in range(r.randint(1, 3))]
        elif kind in ("notice", "advert"):
            if r.random() < 0.5:
                self.text(0, 3, 30, r.choice(("", ".")))
            else:
                [self.one("p", 0, 3, 30, ".") for _ in range(r.randint(1, 2))]
            if r.random() < 0.3:
                self.one("button", 0, 1, 2)
        elif kind == "form":
            if r.random() < 0.6:
                self.one(r.choice(("label", "p", "h3", "legend")), 0, 1, 8)
            self.html.append('<input type="text">')
            if r.random() < 0.3:
                self.html.append("<select>")
                [self.one("option", 0, 1, 2) for _ in range(3)]
                self.html.append("</select>")
            self.one("button", 0, 1, 2)
        elif kind == "comment":
            if r.random() < 0.7 and tag != "ol":
                self.one(r.choice(("h2", "h3")), 0, 1, 3)
            for _ in range(r.randint(1, 5)):
                inner = r.choice(("li", "div", "article", "p"))
                self.html.append(f"<{inner}{self.name(('comment', 'comment-body', 'reply')) if r.random() < 0.7 else ''}>")
                if inner == "p":
                    self.text(0, 4, 40, ".")
                else:
                    if r.random() < 0.5:
                        self.one(r.choice(("h4", "div", "p")), 0, 1, 3)
                    self.one("p", 0, 4, 50, ".")
                self.html.append(f"</{inner}>")
        else:
            [self.one("li" if tag == "ul" else "div", 0, 1, 2) for _ in range(r.randint(1, 4))] if tag != "p" else None
        self.html.append(f"</{tag}>")

    def article(self, inside: tuple[str, ...]) -> None:
        """Blocks of the article, now and then with a foreign part among them."""
        r = self.r
        if r.random() < 0.8:
            wrapped = r.random() < 0.2
            self.html.append("<header>" if wrapped else "")
            self.one(r.choice(("h1", "h1", "h2")), 1, 2, 14)
            self.html.append("</header>" if wrapped else "")
        open_ = r.random() < 0.25  # paragraphs that are never closed, with a stray bold
        for k in range(r.randint(1, 14)):
            kind = r.random()
            if kind < 0.7:
                self.html.append("<p><b>" if open_ and r.random() < 0.3 else "<p>")
                self.text(1, 1, r.choice((3, 15, 60, 120)), r.choice((".", ".", ".", "!", "")))
                if r.random() < 0.25:
                    self.html.append(f' <a href="#">{self.words(1, 4)}</a> {self.words(1, 9)}.')
                self.html.append("<br>" if open_ and r.random() < 0.4 else "" if open_ else "</p>")
            elif kind < 0.78:
                self.one(r.choice(("h2", "h3", "h4")), 1, 1, 8)
            elif kind < 0.84:
                self.html.append(r.choice(("<ul>", "<ol>")))
                [self.one("li", 1, 1, 20, r.choice(("", "."))) for _ in range(r.randint(2, 5))]
                self.html.append("</ul>" if "<ul>" in self.html[-16:] else "</ol>")
            elif kind < 0.88:
                self.html.append("<blockquote>")
                self.one("p", 1, 4, 40, ".")
                self.html.append("</blockquote>")
            elif kind < 0.90:
                self.html.append("<table>")
                for _ in range(r.randint(1, 3)):
                    self.html.append("<tr>")
                    [self.one("td", 1, 1, 4) for _ in range(2)]
                    self.html.append("</tr>")
                self.html.append("</table>")
            elif kind < 0.92:
                self.one("pre", 1, 3, 20)
            elif kind < 0.94:
                self.html.append("<figure>")
                self.one("figcaption", 1, 2, 14, ".")
                self.html.append("</figure>")
            elif kind < 0.97:
                self.one("div", 1, 3, 70, ".")
            elif inside:
                self.part(r.choice(inside))
        if inside and r.random() < 0.4:
            self.part(r.choice(inside))


def labelled_page(seed: int) -> tuple[list[Block], list[int], str]:
    """Blocks and labels of a page put together by rule, and its markup."""
    p = _Page(seed)
    r = p.r
    p.html.append("<!DOCTYPE html><html><head><title>x y</title><style>p{}</style></head><body><script>var t='</p>';</script>")
    for kind in ("notice", "head", "menu", "form", "advert", "side"):
        if r.random() < (0.2, 0.45, 0.7, 0.2, 0.4, 0.15)[("notice", "head", "menu", "form", "advert", "side").index(kind)]:
            p.part(kind)
    inside = ("advert", "share", "side", "form", "notice", "comment", "menu")
    style = r.random()
    wrap = r.random() < 0.3
    p.html.append(f"<div{p.name(('container', 'wrapper', 'page', 'row', 'layout'))}>" if wrap else "")
    if style < 0.45:
        opens, closes = r.choice((("<article>", "</article>"), (f"<article{p.name(CONTENT)}>", "</article>"), ("<main><article>", "</article></main>"), (f"<article><div{p.name(CONTENT)}>", "</div></article>")))
    elif style < 0.6:
        opens, closes = r.choice((("<main>", "</main>"), (f"<main{p.name(CONTENT)}>", "</main>"), (f"<main><div{p.name(CONTENT)}>", "</div></main>"), ('<div role="main">', "</div>")))
    elif style < 0.88:
        opens, closes = r.choice(((f"<div{p.name(CONTENT)}>", "</div>"), (f"<section{p.name(CONTENT)}>", "</section>"), (f"<div{p.name(CONTENT)}><div>", "</div></div>")))
    else:
        opens, closes = r.choice((("<div>", "</div>"), ("<section>", "</section>"), ("", "")))
    p.html.append(opens)
    p.article(inside if style < 0.88 else ())
    p.html.append(closes)
    for kind, chance in (("share", 0.2), ("comment", 0.35), ("side", 0.4), ("advert", 0.25), ("form", 0.2)):
        if r.random() < chance:
            p.part(kind)
    p.html.append("</div>" if wrap else "")
    for kind, chance in (("menu", 0.1), ("foot", 0.75), ("notice", 0.15)):
        if r.random() < chance:
            p.part(kind)
    p.html.append("</body></html>")
    page = "".join(p.html)
    return leaf_blocks(page), p.labels, page


def fitted_field(pages: int = FIT_PAGES, first_seed: int = 1) -> Field:
    """A field trained on ``pages`` labelled pages; those whose markup merges two parts into one block are left out."""
    made = [labelled_page(seed)[:2] for seed in range(first_seed, first_seed + pages)]
    return fit_field([(b, labels) for b, labels in made if len(b) == len(labels)])
