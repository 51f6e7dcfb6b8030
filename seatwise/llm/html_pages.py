"""Labelled pages to learn the extraction of main text from.

Pages are made up from a parameter: layouts mix the usual containers, names and
places of articles, menus, notices, adverts, forms and comments, and every block
carries its label. Texts are made of random syllables, so a model can learn
structure and shape from them but no words of any language.
"""

from __future__ import annotations

import random

MAIN, OTHER = 1, 0

SYLLABLES = "ba ce di fo gu la me ni po ru sha ter ing on est ver al ich eux ción é ü ñ ou".split()
#: Elements and names that hold the article.
ARTICLES = [
    ("article", ""),
    ("article", "post"),
    ("article", "entry hentry"),
    ("main", ""),
    ("main", "content"),
    ("div", "content"),
    ("div", "main-content"),
    ("div", "article-body"),
    ("div", "post"),
    ("div", "entry-content"),
    ("div", "story"),
    ("section", "article"),
    ("section", "body text"),
    ("td", "content"),
]
#: Elements and names that hold anything else, and what stands in them.
OTHERS = [
    ("nav", "", "links"),
    ("nav", "main-nav", "links"),
    ("div", "menu", "links"),
    ("ul", "navigation", "links"),
    ("div", "breadcrumb", "links"),
    ("header", "", "short"),
    ("header", "site-header", "short"),
    ("div", "header masthead", "short"),
    ("footer", "", "short"),
    ("footer", "site-footer", "links"),
    ("div", "footer", "short"),
    ("div", "copyright", "short"),
    ("aside", "", "prose"),
    ("aside", "sidebar", "links"),
    ("div", "sidebar", "prose"),
    ("div", "widget", "links"),
    ("div", "related", "links"),
    ("section", "related recommended", "links"),
    ("div", "ad", "short"),
    ("div", "ads advert", "prose"),
    ("div", "advertisement", "short"),
    ("div", "sponsor sponsored", "prose"),
    ("div", "banner promo", "short"),
    ("div", "cookie-notice", "prose"),
    ("div", "cookie consent", "prose"),
    ("div", "notice alert", "prose"),
    ("div", "gdpr privacy message", "prose"),
    ("div", "newsletter subscribe", "form"),
    ("div", "popup modal", "prose"),
    ("form", "", "form"),
    ("form", "search", "form"),
    ("form", "login", "form"),
    ("div", "share social", "links"),
    ("div", "comments", "comments"),
    ("section", "comments", "comments"),
    ("ol", "comment-list", "comments"),
    ("div", "comment reply", "comments"),
    ("div", "disqus responses", "comments"),
    ("div", "tags meta", "links"),
    ("div", "pagination pager", "links"),
]


class PageMaker:
    """Pages as lists of ``(markup, label)``: a label for text, none for tags."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def word(self) -> str:
        return "".join(self.random.choices(SYLLABLES, k=self.random.randint(1, 4)))

    def sentence(self, low: int, high: int) -> str:
        words = [self.word() for _ in range(self.random.randint(low, high))]
        if self.random.random() < 0.3:
            words[len(words) // 2] += ","
        return " ".join(words).capitalize() + self.random.choice([".", ".", ".", "?", "!", ""])

    def prose(self, most: int) -> str:
        return " ".join(self.sentence(1, 18) for _ in range(self.random.randint(1, most)))

    def named(self, tag: str, names: str) -> str:
        if not names:
            return f"<{tag}>"
        return f'<{tag} {self.random.choice(["class", "class", "id"])}="{names}">'

    def article(self, tag: str, names: str) -> list[tuple[str, int | None]]:
        out = [(self.named(tag, names), None)]
        if self.random.random() < 0.8:
            head = self.random.choice(["h1", "h1", "h2"])
            out += [(f"<{head}>", None), (self.prose(1), MAIN), (f"</{head}>", None)]
        for _ in range(self.random.randint(1, 14)):
            kind = self.random.random()
            if kind < 0.7:
                out += [("<p>", None), (self.prose(6), MAIN), ("</p>", None)]
            elif kind < 0.78:
                out += [("<p>", None), (self.prose(6), MAIN), *self.held(True)]
                out += [(self.prose(3), MAIN), ("</p>", None), *self.held(True)]
            elif kind < 0.84:
                out += [("<h2>", None), (self.sentence(1, 5), MAIN), ("</h2>", None)]
            elif kind < 0.89:
                out += [("<blockquote><p>", None), (self.prose(3), MAIN)]
                out += [("</p></blockquote>", None)]
            elif kind < 0.93:
                out += [("<ul>", None)]
                for _ in range(self.random.randint(2, 5)):
                    out += [("<li>", None), (self.sentence(1, 9), MAIN), ("</li>", None)]
                out += [("</ul>", None)]
            elif kind < 0.96:
                out += [("<pre>", None), (self.sentence(1, 12), MAIN), ("</pre>", None)]
            else:
                out += self.other(inside=True)
        if self.random.random() < 0.25:
            out += self.other(inside=True)
        return [*out, (f"</{tag}>", None)]

    def held(self, inside: bool) -> list[tuple[str, int | None]]:
        """Elements that stand in for something, in an article or outside."""
        kind = self.random.choice(["svg", "select", "video", "audio", "canvas", "template", "", ""])
        inner = {"svg": "text", "select": "option"}.get(kind)
        if not kind:
            kind, inner = self.random.choice(["noscript", "object"]), self.random.choice(["p", None])
            label, text = (MAIN if inside else OTHER), self.prose(4)
        else:
            label, text = OTHER, self.random.choice([self.sentence(1, 3), self.prose(3)])
        opened, closed = (f"<{inner}>", f"</{inner}>") if inner else ("", "")
        return [(f"<{kind}>{opened}", None), (text, label), (f"{closed}</{kind}>", None)]

    def other(self, inside: bool = False) -> list[tuple[str, int | None]]:
        tag, names, kind = self.random.choice(OTHERS)
        if inside and tag in ("header", "footer"):
            return []
        out = [(self.named(tag, names), None)]
        if kind == "links":
            item = self.random.choice(["li", "li", "div", "p"])
            for _ in range(self.random.randint(1, 7)):
                out += [(f'<{item}><a href="/x">', None), (self.sentence(1, 3), OTHER)]
                out += [(f"</a></{item}>", None)]
        elif kind == "short":
            mark = self.random.choice(["", "", "© ", "&copy; "])
            out += [(mark + self.sentence(1, 12), OTHER)]
        elif kind == "prose":
            for _ in range(self.random.randint(1, 3)):
                out += [("<p>", None), (self.prose(3), OTHER), ("</p>", None)]
        elif kind == "form":
            out += [("<label>", None), (self.sentence(1, 3), OTHER), ("</label><input>", None)]
            out += [("<button>", None), (self.sentence(1, 2), OTHER), ("</button>", None)]
        else:
            for _ in range(self.random.randint(1, 4)):
                item = self.random.choice(["li", "div", "article", "div"])
                out += [(self.named(item, self.random.choice(["comment", "reply", "comment"])), None)]
                out += [("<p>", None), (self.prose(3), OTHER), ("</p>", None), (f"</{item}>", None)]
        return [*out, (f"</{tag}>", None)]

    def page(self) -> list[tuple[str, int | None]]:
        out: list[tuple[str, int | None]] = [("<html><body>", None)]
        wrapped = self.random.random() < 0.4
        if wrapped:
            out += [(self.named("div", self.random.choice(["wrapper", "page", "container"])), None)]
        for _ in range(self.random.randint(0, 4)):
            out += self.other()
        if self.random.random() < 0.3:
            out += self.held(False)
        out += self.article(*self.random.choice(ARTICLES))
        for _ in range(self.random.randint(0, 4)):
            out += self.other()
        return [*out, ("</div>" * wrapped + "</body></html>", None)]


def labelled_pages(count: int, seed: int = 11) -> list[list[tuple[str, int | None]]]:
    maker = PageMaker(seed)
    return [maker.page() for _ in range(count)]
