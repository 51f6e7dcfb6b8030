"""Main text of pages against their known articles."""

import html
import re
import time

import pytest

from seatwise.llm import html_text
from seatwise.llm.html_pages import MAIN, labelled_pages


@pytest.fixture(scope="module")
def chain():
    return html_text.trained_chain()


def article_of(page):
    """The article by its own tag, which the test pages happen to have."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    if not found:
        return ""
    inner = found[1] if found[2] else re.sub(r"<[^>]*\Z", "", found[1])
    inner = re.sub(r"</?(?:b|a)(?:\s[^>]*)?>", "", inner)
    blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]+>", inner)]
    return " ".join(b for b in blocks if b)


def test_whole_table(spark, sf_dir, chain):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r["page_id"]: r for r in pages.collect()}
    rows = html_text.extract(pages, chain).collect()
    assert len(rows) == len(source)
    for r in rows:
        assert r["text"] == article_of(source[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == source[r["page_id"]]["url"]


def test_labelled_pages_not_learnt_from(chain):
    wrong = total = 0
    for page in labelled_pages(150, seed=4242):
        blocks, labels = html_text._label(page)
        wrong += sum(a != b for a, b in zip(chain.decode(blocks), labels))
        total += len(labels)
    assert wrong / total < 0.01


def slow_decode(chain, blocks):
    """The best of all labellings, one after another."""
    from itertools import product

    rows = [chain.weights[chain.features.block(b)].sum(axis=0) for b in blocks]

    def score(labels):
        total = chain.start[labels[0]] + sum(r[y] for r, y in zip(rows, labels))
        return total + sum(chain.moves[a, b] for a, b in zip(labels, labels[1:]))

    return max(product((0, 1), repeat=len(blocks)), key=score)


def test_viterbi_finds_the_best_labelling(chain):
    for page in labelled_pages(12, seed=8):
        blocks, _ = html_text._label(page)
        blocks = blocks[:9]
        assert tuple(chain.decode(blocks)) == slow_decode(chain, blocks)


def blocks(page):
    return [b.text for b in html_text.blocks_of(page)]


def test_blocks_of_untidy_pages():
    assert blocks("<p>a<b>b</b> c<p>d<br>e<li>f") == ["ab c", "d e", "f"]
    assert blocks("<p>x &amp; y&nbsp;&#65;&lt;b&gt; &am") == ["x & y A<b> &am"]
    assert blocks('<div title="a > b">t</div><p') == ["t"]
    assert blocks("<script>if (a<b) '</p>'</script><p>t<style>p{}</style>u</p>") == ["t u"]
    assert blocks("a<!-- <p>no</p> -->b<!doctype html>c<?x?>d") == ["abcd"]
    assert blocks("1 < 2 <3 a<b") == ["1 < 2 <3 a"] or blocks("1 < 2 <3") == ["1 < 2 <3"]
    assert blocks("<script>never closed <p>x</p>") == []
    assert blocks("") == blocks("   \n ") == []
    assert blocks("<P CLASS=x>Up</P></div></nosuch>per") == ["Up", "per"]


def test_other_layouts(chain):
    text = "A first sentence of some length, with a comma. And then another one follows it."
    side = "<div class='sidebar'><p>More to read, every day. Subscribe now.</p></div>"
    for open_, close in (
        ("<main>", "</main>"),
        ("<div id='content'>", "</div>"),
        ("<div class='entry-content'>", "</div>"),
    ):
        page = (
            "<html><head><title>T</title></head><body><nav><ul><li><a href='/'>Home</a></ul></nav>"
            f"{side}{open_}<h1>Headline</h1><p>{text}</p><p>{text}</p>"
            "<div class='advert'>Buy it.</div>"
            f"<form><label>Name</label><button>Send</button></form><p>{text}</p>{close}"
            f"<div class='cookie-notice'><p>We use cookies, {text}</p></div>"
            f"<section id='comments'><div class='comment'><p>{text}</p></div></section>"
            "<footer>&copy; someone</footer></body></html>"
        )
        assert chain.main_text(page) == f"Headline {text} {text} {text}"


def test_pages_with_omitted_end_tags(chain):
    text = "A first sentence of some length, with a comma. And then another one follows it."
    body = f"<article><h1>Headline</h1><p>{text}</p>%s<p>{text}</p></article>"
    page = "<html><head><meta charset=x><title>T</title>%s<body><nav><a href='/'>Home</a></nav>" + body
    whole = f"Headline {text} {text}"
    for head in ("", "</head>", "<noscript><link rel=x></noscript>", "<style>p{}</style>"):
        assert chain.main_text(page % (head, "")) == whole
    assert chain.main_text(f"<head><title>T</title>{body % ''}") == whole
    for left_open in ("svg", "select", "object", "noscript", "video", "canvas", "iframe", "template"):
        assert chain.main_text(page % ("", f"<{left_open}>")) == whole
    for left_open in ("svg", "select"):
        late = page % ("", f"<{left_open}>") + f"<footer><{left_open}></{left_open}></footer>"
        assert chain.main_text(late) == whole


def test_text_in_other_elements_of_an_article(chain):
    text = "A first sentence of some length, with a comma. And then another one follows it."
    page = f"<body><article><h1>Headline</h1><p>{text}</p>%s<p>{text}</p></article>"
    formula = f"<p>{text} Here <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>"
    assert chain.main_text(page % formula) == f"Headline {text} {text} Here x=2 holds. {text}"
    for tag in ("noscript", "object"):
        held = page % f"<{tag}><p>{text}</p></{tag}>"
        assert chain.main_text(held) == f"Headline {text} {text} {text}"
    for drawn in ("<svg><text>Label</text></svg>", "<select><option>One<option>Two</select>"):
        assert chain.main_text(page % drawn) == f"Headline {text} {text}"


def test_quotes_open_a_value_only_behind_an_equals_sign(chain):
    text = "A first sentence of some length, with a comma. And then another one follows it."
    page = f"<article><h1>Headline</h1><p%s>{text}</p><p>It isn't over. {text}</p><p>{text}</p></article>"
    whole = f"Headline {text} It isn't over. {text} {text}"
    for attributes in (
        " title=it's", " it's", ' "', " '", " a=b\"c'", " a= 'x>y' b", ' a = "it\'s > that"', " =a'",
        ' class="x""', " a='b'c=\"d\"", " a=", " a/b='/'", "/",
    ):
        assert chain.main_text(page % attributes) == whole, attributes
    assert chain.main_text(f'<div class="a""><article><h1>H</h1><p>{text}</p></article></div>') == f"H {text}"
    assert chain.main_text(f"<article><!--><p>{text}</p><!-- x --!><p>{text}</p></article>") == f"{text} {text}"


def test_a_value_without_an_end_reaches_to_the_next_quote():
    assert blocks("<p>a</p><p title=\"b>c</p><p>d</p><p id=\"e\">f</p>") == ["a", "f"]
    assert blocks("<p>a</p><p title=\"b>c</p><p>d</p>") == ["a"]
    assert blocks("<p>a</p></p title='x>'><p>b") == ["a", "b"]


@pytest.mark.parametrize(
    "page,texts",
    [
        ("<div>" * 100_000 + "x", 1),
        ("<div>x" * 100_000, 100_000),
        ("<foo class=a>x" * 100_000, 100_000),
        ("<foo>" * 50_000 + "</bar>" * 50_000 + "x", 1),
        ("<svg><foreignobject>" + "<div>x" * 50_000 + "</svg>", 50_000),
        ('<a "' * 100_000, 0),
        ("<a '" * 100_000 + ">x", 1),
        ('<p a="' * 100_000 + ">x", 1),
        ('<p a="' * 99_999 + ">x", 0),
        ("<p><li><dd>" * 50_000 + "x", 1),
        ("<!--" * 100_000, 0),
        ("</" * 100_000, 0),
    ],
)
def test_work_grows_with_the_length(chain, page, texts):
    began = time.process_time()
    found = html_text.blocks_of(page)
    chain.decode(found)
    assert time.process_time() - began < 12
    assert len(found) == texts


def test_awkward_rows(spark, chain):
    schema = "page_id long, url string, html string, text string, n_chars string, label string"
    article = "<article><h1>T</h1><p>One two.</p></article>"
    rows = [
        (1, "u", None, "t", "n", "l"),
        (2, None, "", "t", "n", "l"),
        (None, "u", article, "t", "n", "l"),
        (3, "u", article, "t", "n", "l"),
        (3, "u", article, "t", "n", "l"),
        (4, "u", "<article>" + "<p>word word.</p>" * 20000 + "</article>", "t", "n", "l"),
        (5, "u", "<" * 5000 + '<a "' * 500, "t", "n", "l"),
    ]
    pages = spark.createDataFrame(rows, schema)
    got = html_text.extract(pages, chain).collect()
    found = [(r["page_id"], r["text"], r["n_chars"]) for r in got]
    assert found[:5] == [(1, "", 0), (2, "", 0), (None, "T One two.", 10), (3, "T One two.", 10)] + [
        (3, "T One two.", 10)
    ]
    assert found[5][1] == " ".join(["word word."] * 20000)
    assert html_text.extract(pages.where("page_id > 9"), chain).count() == 0
    assert MAIN == 1
