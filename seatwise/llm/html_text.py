"""Main text of HTML pages by a linear-chain conditional random field.

A page is cut into leaf blocks: text that no block element interrupts, with the
elements around it. A chain over the blocks in page order, two labels and
features of the ancestors and of the text, is trained on labelled pages and
decoded with Viterbi's algorithm.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.llm.html_pages import MAIN, OTHER, labelled_pages

TRAINING_PAGES = 500
STEPS = 150
PENALTY = 2e-3

#: An attribute: a quote opens a value only behind an equals sign, elsewhere it is a
#: character of a name or of a value without quotes. One without its end is none. With
#: parentheses around name and values, and without any.
ATTRIBUTE = re.compile(
    r"""[\s/]*+([^\s/>][^\s/>=]*+)"""
    r"""(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|((?!["'])[^\s>]*+))|(?!\s*+=\s*+["']))"""
)
_PASSED = (
    r"""[\s/]*+[^\s/>][^\s/>=]*+"""
    r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)|(?!\s*+=\s*+["']))"""
)
#: A comment, a declaration, a tag, an end tag without a name. What the page's end cuts
#: off reaches to it, and so does a tag with a quote that has no end.
TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|"
    rf"<(/?)([a-zA-Z][^\s/>]*+)((?:{_PASSED})*+)[\s/]*+(?:(>)|.*+)|</[^>]*+(?:>|\Z)",
    re.S,
)
NAMES = ("class", "id", "role")
PART = re.compile(r"[^\W\d_]+|\d+")

#: Fixed values of HTML: what holds raw text instead of a page's, what stands in a
#: paragraph but has lines of its own, what stands within a line, what never has
#: content, and what ends an open paragraph or item.
RAW = frozenset("script style textarea title".split())
HOLDERS = frozenset("noscript template object svg select audio video canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover "
    "munderover mtable mtr mtd mstyle mpadded mphantom menclose semantics annotation".split()
)
EMPTY = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
#: An implied end goes no further up than these.
SCOPES = HOLDERS | set("ul ol dl table body html article section main div nav aside".split())
#: What cannot stand in a drawing or a choice, and so ends one that was left open.
OUTSIDE = frozenset(
    "address article aside blockquote body center dd div dl dt figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr li main nav ol p pre section table ul".split()
)


class Around:
    """An element around blocks: a link to the one around it, and its own key."""

    __slots__ = ("above", "key", "tag", "known")

    def __init__(self, above: Around | None, key: str):
        self.above, self.key, self.tag = above, key, key.split(" ", 1)[0]
        self.known: tuple | None = None


@dataclass
class Block:
    text: str
    around: Around | None
    linked: int

    @property
    def path(self) -> tuple[str, ...]:
        """The keys of all elements around, outermost first."""
        out, at = [], self.around
        while at is not None:
            out.append(at.key)
            at = at.above
        return tuple(out[::-1])


#: Elements an implied end may close.
CLOSABLE = frozenset(tag for tags in CLOSES.values() for tag in tags) | {"p"}


class Open:
    """The elements open at a place of a page, each change in constant time.

    ``first`` of an entry tells where the outermost element of each closable kind
    stands that no scope separates from it.
    """

    def __init__(self):
        self.entries: list[tuple[str, Around, dict[str, int]]] = []
        self.places: dict[str, list[int]] = {}

    def around(self) -> Around | None:
        return self.entries[-1][1] if self.entries else None

    def push(self, tag: str, key: str) -> None:
        first = self.entries[-1][2] if self.entries else {}
        if tag in SCOPES:
            first = {}
        elif tag in CLOSABLE and tag not in first:
            first = {**first, tag: len(self.entries)}
        self.places.setdefault(tag, []).append(len(self.entries))
        self.entries.append((tag, Around(self.around(), key), first))

    def close(self, upto: int) -> None:
        for tag, _, _ in self.entries[upto:]:
            self.places[tag].pop()
        del self.entries[upto:]

    def last(self, tag: str) -> int:
        return self.places[tag][-1] if self.places.get(tag) else -1

    def implied(self, tag: str) -> int:
        """From where on elements end when this one begins."""
        if tag in HOLDERS or not self.entries:
            return len(self.entries)
        first = self.entries[-1][2]
        return min(
            (first[t] for t in ("p", *CLOSES.get(tag, ())) if t in first), default=len(self.entries)
        )

    def drawing(self) -> int:
        """Where the outermost drawing or choice is open that holds no page content."""
        inside = self.last("foreignobject")
        found = [
            held[i]
            for held in (self.places.get(t, []) for t in ("svg", "select"))
            if (i := bisect.bisect(held, inside)) < len(held)
        ]
        return min(found, default=len(self.entries))


def _key(name: str, attributes: str) -> str:
    """An element's name with the words of its class, id and role."""
    if "=" not in attributes:
        return name
    parts = [
        part.lower()
        for m in ATTRIBUTE.finditer(attributes)
        if m[1].lower() in NAMES
        for part in PART.findall(m[2] or m[3] or m[4] or "")
    ]
    return " ".join([name, *parts])


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order; white space within is one space, empty ones go.

    References are decoded in text only. A tag cut off by the page's end is
    dropped, unclosed elements reach to the end. A head holds raw text and empty
    elements only, so its tags are passed over, written or left out. An element
    such as a drawing has its text in blocks of its own; with no end tag left in
    the page it holds nothing. The work grows with the page's length, however
    deep its elements nest and whatever is left open.
    """
    stack = Open()
    pieces: list[str] = []
    linked, links = 0, 0
    out: list[Block] = []
    lasts: dict[str, int] = {}

    def ends(name: str) -> int:
        """Where the last end tag of an element begins."""
        if name not in lasts:
            found = [m.start() for m in re.finditer(f"</{name}(?=[\\s/>])", page, re.I)]
            lasts[name] = found[-1] if found else -1
        return lasts[name]

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, stack.around(), linked))
            pieces.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        stop = found.start() if found else end
        if stop > at:
            text = html.unescape(page[at:stop])
            pieces.append(text)
            if links:
                linked += len(text.strip())
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name or not found[4]:
            continue
        if found[1]:
            if name in INLINE:
                links = max(0, links - (name == "a"))
                continue
            flush()
            if stack.last(name) >= 0:
                stack.close(stack.last(name))
            links = 0
            continue
        if name in RAW or name == "iframe" and at <= ends(name):
            if not page[at - 2 : at] == "/>":
                gone = re.compile(f"</{name}\\b[^>]*>", re.I).search(page, at)
                at = gone.end() if gone else end
            pieces.append(" ")
            continue
        if name in ("head", "iframe") or name in HOLDERS and (
            at > ends(name) or page[at - 2 : at] == "/>"
        ):
            pieces.append(" ")
            continue
        if name in INLINE:
            links += name == "a"
            continue
        if name == "br":
            pieces.append(" ")
            continue
        flush()
        if name in EMPTY:
            continue
        links = 0
        if name in OUTSIDE:
            stack.close(stack.drawing())
        stack.close(stack.implied(name))
        stack.push(name, _key(name, found[3]))
    flush()
    return out


def _bucket(x: float, edges: tuple[float, ...]) -> int:
    return sum(x >= e for e in edges)


def element_features(around: Around) -> list[str]:
    """What an element says of all blocks within it."""
    tag, *parts = around.key.split(" ")
    return sorted({f"in {tag}", *(f"name {part}" for part in parts)})


def place_features(around: Around | None) -> list[str]:
    """The innermost element by itself, and with the one around it."""
    tags = [] if around is None else [around.tag]
    if around is not None and around.above is not None:
        tags.insert(0, around.above.tag)
    return ["bias", f"tag {tags[-1] if tags else ''}", f"pair {' '.join(tags)}"]


def text_features(block: Block) -> list[str]:
    text = block.text
    size = len(text)
    return [
        f"size {_bucket(size, (8, 20, 40, 80, 160, 320, 640))}",
        f"linked {_bucket(block.linked / size, (0.05, 0.3, 0.6, 0.9))}",
        f"ends {text[-1] if text[-1] in '.!?:,' else ''}",
        f"sign {'©' in text}",
        f"stops {_bucket(text.count('. ') + text.count(', '), (1, 3, 8))}",
    ]


class Features:
    """Numbers for feature names; a frozen table gives none to names not seen."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def numbers(self, names: list[str], grow: bool) -> list[int]:
        if grow:
            return [self.known.setdefault(name, len(self.known)) for name in names]
        return [self.known[name] for name in names if name in self.known]

    def elements(self, around: Around | None, grow: bool) -> tuple[int, ...]:
        """Numbers of all elements around, kept with each: those it shares are the same."""
        todo = []
        while around is not None and around.known is None:
            todo.append(around)
            around = around.above
        found = around.known if around is not None else ()
        for element in reversed(todo):
            new = [n for n in self.numbers(element_features(element), grow) if n not in found]
            found = (*found, *new) if new else found
            element.known = found
        return found

    def block(self, block: Block, grow: bool = False) -> list[int]:
        around = self.elements(block.around, grow)
        own = self.numbers(place_features(block.around) + text_features(block), grow)
        return [*around, *own]


@dataclass
class Chain:
    features: Features
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels of a page's blocks; ties go to other text."""
        if not blocks:
            return []
        rows = [self.features.block(b) for b in blocks]
        sizes = [len(r) for r in rows]
        flat = self.weights[np.concatenate([np.array(r, dtype=np.int64) for r in rows])]
        scores = np.add.reduceat(flat, np.cumsum([0, *sizes[:-1]]), axis=0).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = scores[0][0] + self.start[0], scores[0][1] + self.start[1]
        back = []
        for x, y in scores[1:]:
            from_a, from_b = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = max(a + m00, b + m10) + x, max(a + m01, b + m11) + y
        labels = [OTHER if a >= b else MAIN]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def main_text(self, page: str | None) -> str:
        blocks = blocks_of(page or "")
        return " ".join(b.text for b, y in zip(blocks, self.decode(blocks)) if y == MAIN)


def _label(pieces: list[tuple[str, int | None]]) -> tuple[list[Block], list[int]]:
    """Blocks of a labelled page; each made-up text is a block of its own."""
    blocks = blocks_of("".join(markup for markup, _ in pieces))
    labels = [y for markup, y in pieces if y is not None and html.unescape(markup).strip()]
    if len(blocks) != len(labels):
        raise ValueError("a labelled text does not make one block")
    return blocks, labels


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS) -> Chain:
    """Maximum conditional likelihood by gradient steps, all pages side by side."""
    features = Features()
    rows = [[features.block(b, grow=True) for b in blocks] for blocks, _ in pages]
    longest = max(len(r) for r in rows)
    widest = max(len(x) for r in rows for x in r)
    spare = len(features.known)
    index = np.full((len(pages), longest, widest), spare)
    goal = np.zeros((len(pages), longest), dtype=np.int64)
    real = np.zeros((len(pages), longest), dtype=bool)
    for p, (r, (_, labels)) in enumerate(zip(rows, pages)):
        for t, numbers in enumerate(r):
            index[p, t, : len(numbers)] = numbers
        goal[p, : len(r)] = labels
        real[p, : len(r)] = True
    total = real.sum()
    truth = np.eye(2)[goal] * real[..., None]
    pairs = np.einsum("pti,ptj->ij", truth[:, :-1], truth[:, 1:])
    size = (spare + 1) * 2 + 4 + 2
    x, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        weights = x[:-6].reshape(-1, 2)
        moves, start = x[-6:-2].reshape(2, 2), x[-2:]
        scores = weights[index].sum(axis=2)
        ahead = np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            into = ahead[:, t - 1, :, None] + moves
            ahead[:, t] = np.where(
                real[:, t, None], np.logaddexp(into[:, 0], into[:, 1]) + scores[:, t], ahead[:, t - 1]
            )
        behind = np.zeros_like(scores)
        for t in range(longest - 2, -1, -1):
            out = moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :]
            behind[:, t] = np.where(
                real[:, t + 1, None], np.logaddexp(out[..., 0], out[..., 1]), 0.0
            )
        whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        share = np.exp(ahead + behind - whole[:, None, None]) * real[..., None]
        joint = np.exp(
            ahead[:, :-1, :, None]
            + moves
            + (scores + behind)[:, 1:, None, :]
            - whole[:, None, None, None]
        ) * real[:, 1:, None, None]
        error = (share - truth).reshape(-1, 2)
        flat = index.reshape(-1, widest)
        slope = np.zeros(size)
        for y in range(2):
            held = np.bincount(
                flat.ravel(), np.repeat(error[:, y], widest), minlength=spare + 1
            )
            slope[y : (spare + 1) * 2 : 2] = held
        slope[-6:-2] = (joint.sum(axis=(0, 1)) - pairs).ravel()
        slope[-2:] = (share[:, 0] - truth[:, 0]).sum(axis=0)
        slope = slope / total + PENALTY * x * 0.01
        slope[spare * 2 : spare * 2 + 2] = 0
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        x -= 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Chain(features, x[:-6].reshape(-1, 2).copy(), x[-6:-2].reshape(2, 2).copy(), x[-2:].copy())


def trained_chain(pages: int = TRAINING_PAGES) -> Chain:
    return train([_label(page) for page in labelled_pages(pages)])


def _extract(chain: Chain):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [chain.main_text(page) for page in batch["html"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    return run


def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row for each input row.

    Blocks labelled as main text, joined by one space in page order. Null and
    empty pages, and pages without main text, have the empty string. Pages are read
    whole whatever their length or nesting. Repeated rows, also such without an id,
    each have their row; no rows give none. Only ``page_id``, ``url`` and ``html`` are
    read, other columns are left aside whatever their names.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    chain = chain or trained_chain()
    return rows.mapInPandas(_extract(chain), "page_id long, url string, text string, n_chars long")
