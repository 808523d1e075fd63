"""Labelled pages for the block labeller: many page designs over invented words, each block with its label.

The designs follow public web habits (semantic tags, descriptive or meaningless class names, block lists,
unclosed tags); words are random letters, so that nothing can be learnt from vocabulary.
"""

from __future__ import annotations

import random

MAIN, REST = 1, 0


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.html, self.labels = rng, [], []

    def word(self) -> str:
        return "".join(self.rng.choice(("an", "to", "ri", "le", "sch", "mé", "ou", "st", "er", "ka", "vo", "ing", "d")) for _ in range(self.rng.randint(1, 3)))

    def words(self, low: int, high: int, stop: str = "") -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high))).capitalize() + stop

    def prose(self, low: int = 1, high: int = 4) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            s = self.words(4, 22, self.rng.choice("....?!"))
            if self.rng.random() < 0.3:
                s = s.replace(" ", ", ", 1)
            if self.rng.random() < 0.12:
                s = s.replace(" ", f' <a href="/{self.word()}">{self.word()}</a> ', 1)
            if self.rng.random() < 0.1:
                s = s.replace(" ", f" <em>{self.word()}</em> ", 1)
            out.append(s)
        return " ".join(out)

    def add(self, html: str, label: int | None = None) -> None:
        """``html`` with one block of text if there is a label."""
        self.html.append(html)
        if label is not None:
            self.labels.append(label)

    def tag(self, names: tuple, classes: tuple) -> tuple[str, str]:
        name = self.rng.choice(names)
        attribute = ""
        if name in ("div", "section", "ul", "ol", "span", "table") or self.rng.random() < 0.5:
            attribute = f' {self.rng.choice(("class", "class", "id"))}="{self.rng.choice(classes)}"'
        return f"<{name}{attribute}>", f"</{name}>"

    # what does not belong to the article

    def links(self, low: int, high: int, bare: float = 0.15) -> None:
        rng, style = self.rng, self.rng.random()
        n = rng.randint(low, high)
        if style < 0.7:
            self.add("<ul>")
            for _ in range(n):
                self.add(f'<li><a href="/{self.word()}">{self.words(1, 4)}</a>' + rng.choice(("</li>", "</li>", "")), REST)
            self.add("</ul>")
        elif style < 0.7 + bare:
            self.add("<p>" + " | ".join(f'<a href="#">{self.words(1, 2)}</a>' for _ in range(n)) + "</p>", REST)
        else:
            for _ in range(n):
                self.add(f'<div><a href="/x">{self.words(1, 3)}</a></div>', REST)

    def menu(self) -> None:
        a, b = self.tag(("nav", "nav", "div", "ul"), ("menu", "navbar", "nav-main", "navigation", "top-links", "site-nav", "topbar", "c7"))
        self.add(a)
        self.links(3, 9)
        self.add(b)

    def header(self) -> None:
        a, b = self.tag(("header", "div"), ("header", "site-header", "masthead", "banner", "page-top", "branding"))
        self.add(a)
        style = self.rng.random()
        if style < 0.4:
            self.add(f'<a href="/">{self.words(1, 3)}</a>', REST)
        else:
            tag = "div" if style < 0.6 else self.rng.choice(("h1", "h2", "p", "span"))
            self.add(f"<{tag}>{self.words(1, 4)}</{tag}>", REST)
        if self.rng.random() < 0.4:
            self.add(f"<p>{self.words(3, 8)}</p>", REST)
        if self.rng.random() < 0.4:
            self.menu()
        self.add(b)

    def advert(self) -> None:
        a, b = self.tag(("div", "div", "aside", "ins", "section"), ("ad", "ads", "advert", "ad-slot", "sponsored", "promo", "adsbygoogle", "banner-ad", "ad-box top", "sponsor"))
        self.add(a)
        self.add(self.prose(1, 2) if self.rng.random() < 0.5 else f"<p>{self.prose(1, 2)}</p>", REST)
        self.add(b)

    def notice(self) -> None:
        a, b = self.tag(("div", "section", "aside"), ("cookie-notice", "notice", "gdpr-banner", "consent", "alert", "cookie-bar", "subscribe", "newsletter", "paywall-notice"))
        self.add(a)
        self.add(f"<p>{self.prose(1, 2)}</p>", REST)
        if self.rng.random() < 0.5:
            self.add(f"<button>{self.words(1, 2)}</button>", REST)
        self.add(b)

    def form(self) -> None:
        self.add('<form action="/x" method="post">')
        if self.rng.random() < 0.6:
            self.add(f"<p>{self.prose(1, 1)}</p>", REST)
        self.add(f"<label>{self.words(1, 3)}</label>", REST)
        self.add('<input type="text" name="q">')
        if self.rng.random() < 0.4:
            self.add(f"<select><option>{self.words(1, 2)}</option>", REST)
            self.add("</select>")
        self.add(f"<button>{self.words(1, 2)}</button>", REST)
        self.add("</form>")

    def sidebar(self) -> None:
        a, b = self.tag(("aside", "aside", "div"), ("sidebar", "side", "widget-area", "related", "right-col", "recommended", "most-read", "rail"))
        self.add(a)
        for _ in range(self.rng.randint(1, 3)):
            if self.rng.random() < 0.7:
                self.add(f"<h3>{self.words(1, 4)}</h3>", REST)
            if self.rng.random() < 0.6:
                self.links(2, 6)
            else:
                self.add(f"<p>{self.prose(1, 2)}</p>", REST)
        self.add(b)

    def comments(self) -> None:
        a, b = self.tag(("section", "div", "ol"), ("comments", "comment-list", "responses", "discussion", "reader-comments", "disqus_thread"))
        self.add(a)
        if self.rng.random() < 0.6:
            self.add(f"<h3>{self.words(1, 3)}</h3>", REST)
        inner = self.rng.choice(('<div class="comment">', '<article class="comment">', '<li class="comment-body">', '<div class="reply">'))
        end = f"</{inner[1:].split()[0]}>"
        for _ in range(self.rng.randint(1, 5)):
            self.add(inner)
            if self.rng.random() < 0.6:
                self.add(f"<div class=\"author\">{self.words(1, 2)}</div>", REST)
            self.add(f"<p>{self.prose(1, 3)}</p>", REST)
            self.add(end)
        self.add(b)

    def footer(self) -> None:
        a, b = self.tag(("footer", "footer", "div"), ("footer", "site-footer", "copyright", "colophon", "bottom", "legal"))
        self.add(a)
        if self.rng.random() < 0.5:
            self.links(2, 6)
        self.add(self.rng.choice(("&copy; ", "© 2021 ", "")) + self.words(2, 9) + self.rng.choice((".", "", " &middot; " + self.words(2, 8))), REST)
        self.add(b)

    def share(self) -> None:
        a, b = self.tag(("div", "ul"), ("share", "social", "share-buttons", "tags", "breadcrumbs", "pagination", "meta-links"))
        self.add(a)
        self.links(2, 4)
        self.add(b)

    # the article

    def article(self) -> None:
        rng = self.rng
        names = ("content", "post", "entry-content", "article-body", "story", "main", "post-body", "text", "c3", "col-8", "wrapper")
        a, b = self.tag(("article", "article", "article", "main", "div", "section"), names)
        inner = rng.random() < 0.3
        self.add(a)
        if inner:
            self.add(f'<div class="{rng.choice(names)}">')
        if rng.random() < 0.85:
            level = rng.choice(("h1", "h1", "h2"))
            self.add(f"<{level}>{self.words(2, 12)}</{level}>", MAIN)
        for _ in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.72:
                text = self.prose(1, 5) if rng.random() < 0.85 else self.words(1, 6, rng.choice((".", "")))
                style = rng.random()
                if style < 0.75:
                    self.add(f"<p>{text}" + rng.choice(("</p>", "</p>", "</p>\n", "")), MAIN)
                elif style < 0.87:
                    self.add(f"<p><b>{text}<br>" + rng.choice(("", "</b></p>")), MAIN)
                else:
                    self.add(f"<div>{text}</div>", MAIN)
            elif kind < 0.8:
                self.add(f"<h{rng.randint(2, 4)}>{self.words(2, 8)}</h2>", MAIN)
            elif kind < 0.86:
                self.add("<ul>" if rng.random() < 0.6 else "<ol>")
                for _ in range(rng.randint(2, 5)):
                    self.add(f"<li>{self.words(2, 14, rng.choice(('.', '')))}" + rng.choice(("</li>", "")), MAIN)
                self.add("</ul></ol>")
            elif kind < 0.9:
                self.add(f"<blockquote><p>{self.prose(1, 2)}</p></blockquote>", MAIN)
            elif kind < 0.92:
                self.add(f"<pre>{self.words(3, 12)}</pre>", MAIN)
            elif kind < 0.94:
                self.add("<table><tr>")
                for _ in range(rng.randint(2, 6)):
                    self.add(f"<td>{self.words(1, 5)}</td>", MAIN)
                self.add("</tr></table>")
            elif kind < 0.97:
                self.advert()
            else:
                rng.choice((self.notice, self.share, self.form))()
        if inner:
            self.add("</div>")
        if rng.random() < 0.1:
            self.share()
        if rng.random() < 0.1:
            self.comments()
        self.add(b)


def labelled_pages(n: int = 400, seed: int = 7) -> list[tuple[str, list[int]]]:
    """``n`` pages as (html, labels of its text blocks in page order)."""
    out = []
    for i in range(n):
        rng = random.Random(f"{seed}-{i}")
        page = _Page(rng)
        page.add("<!DOCTYPE html><html><head><title>x</title><script>var t='<p>no</p>';</script></head><body>")
        for part, chance in ((page.header, 0.5), (page.menu, 0.7), (page.notice, 0.3), (page.advert, 0.5), (page.form, 0.15), (page.share, 0.2), (page.sidebar, 0.25)):
            if rng.random() < chance:
                part()
        if rng.random() < 0.96:
            page.article()
        for part, chance in ((page.share, 0.2), (page.comments, 0.4), (page.sidebar, 0.4), (page.advert, 0.4), (page.form, 0.25), (page.notice, 0.2), (page.footer, 0.85)):
            if rng.random() < chance:
                part()
        if rng.random() < 0.8:
            page.add("</body></html>")
        out.append(("".join(page.html), page.labels))
    return out
