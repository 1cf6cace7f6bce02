import html
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import html_text, queries

LONG = "After the long winter the river rose again and carried away two of the wooden boats that lay behind the mill at night."


def text_of(page):
    blocks = html_text.blocks_of(page)
    if not blocks:
        return ""
    chosen = html_text.trained_tree().predict(html_text.features(blocks))
    return "\n".join(b.text for b, label in zip(blocks, chosen, strict=True) if label)


def test_given_pages_against_their_article(spark, folder):
    """In the given pages everything between the article's tags is text, and nothing else."""
    rows = {r["page_id"]: r for r in queries.op11_html_extraction(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(rows) == len(pages) > 10
    for page in pages:
        inside = re.search(r"<article>(.*?)(</article>|\Z)", page["html"] or "", re.S)
        pieces = re.split(r"</?p>|</?h1>|<br>", inside[1]) if inside else []
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in pieces]
        text = "\n".join(x for x in lines if x)
        found = rows[page["page_id"]]
        assert (found["text"], found["n_chars"], found["url"]) == (text, len(text), page["url"])


CASES = {
    "parts": (f'<nav><a href="/">Home</a></nav><article><h1>A &amp; B</h1><p>So&nbsp;it  is.</p>\n<p>{LONG}</p></article><footer>{LONG}</footer>', f"A & B\nSo it is.\n{LONG}"),
    "inside the article": (f'<article><header><h1>T</h1></header><p>One<br>two <b>th</b>ree</p><div class="ad-box">{LONG}</div><aside>{LONG}</aside><form>{LONG}<button>Send</button></form><p>Last.</p><section id="comments"><article><p>{LONG}</p></article></section></article>', "T\nOne two three\nLast."),
    "article in article": (f"<article><p>Text.</p><article><p>{LONG}</p></article></article>", "Text."),
    "menu never closed": (f'<nav><ul><li><a href="/">Home</a><article><h1>T</h1><p>{LONG}</p></article>', f"T\n{LONG}"),
    "tags never closed": (f"<article><h1>T</h1><p><b>One.<br><p>{LONG}<p>Two.", f"T\nOne.\n{LONG}\nTwo."),
    "cut in a tag": (f'<article><p>{LONG}</p><p class="x', LONG),
    "cut in a comment": (f"<article><p>{LONG}</p><!-- not > this", LONG),
    "cut in a script": (f"<article><p>{LONG}</p><script>if (a < b) c('</p>')", LONG),
    "scripts and styles": (f"<style>p{{}}</style><article><script>x='<p>no</p>'</script><p>{LONG}</p><noscript>no</noscript><select><option>no</select></article>", LONG),
    "comments and odd marks": (f"<!DOCTYPE html><?xml version='1.0'?><![if IE]><article><!-- <p>no</p> --><p>a < b &lt;c&gt; &unknown; &#233; &amp</p><p>{LONG}</p></article>", f"a < b <c> &unknown; é &\n{LONG}"),
    "names": (f'<div class="has-sidebar"><div id="cookieNotice cookie-bar">{LONG}</div><main><p>{LONG}</p></main></div>', LONG),
    "form around the page": (f"<form><article><p>Short.</p></article><p><a href='/'>More</a></p></form>", "Short."),
    "no marks": (f'<div><a href="/">Home</a></div><h1>How it came</h1><div>{LONG}</div><div>{LONG}</div><div>{LONG}</div><div><a href="/x">Next story</a></div>', f"How it came\n{LONG}\n{LONG}\n{LONG}"),
    "only a menu": ('<nav><ul><li><a href="/">Home</a><li><a href="/b">Books</a></ul></nav>', ""),
    "same text twice": (f"<article><p>{LONG}</p><p>{LONG}</p></article>", f"{LONG}\n{LONG}"),
    "plain text": (LONG + " " + LONG, LONG + " " + LONG),
    "nothing": ("", ""),
    "white space": (" \n\t ", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    page, text = CASES[name]
    assert text_of(page) == text


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<article", "<div class='ad'>", "</div>", "<a href=x>", "</a>", "<![x[", "<!--", "-->", "<!x", "&amp", "&#x110000;", "word ", '"', "<svg/>", "</", "<", ">", "<button>", "\x00"]), max_size=40).map("".join))
def test_any_marks_are_read(page):
    blocks = html_text.blocks_of(page)
    assert all(b.text == " ".join(b.text.split()) and 0 <= b.linked <= b.words for b in blocks)
    assert isinstance(text_of(page), str)


def test_tree_against_trying_every_split():
    rng = random.Random(4)
    rows = np.array([[rng.randint(0, 5), rng.randint(0, 3), rng.random()] for _ in range(60)])
    labels = ((rows[:, 0] > 2) ^ (rows[:, 2] > 0.5)).astype(float)

    def impurity(split):
        return sum(len(x) * 2 * x.mean() * (1 - x.mean()) for x in (labels[split], labels[~split]) if len(x))

    least = min(impurity(rows[:, f] <= v) for f in range(3) for v in rows[:, f])
    assert html_text.best_split(rows, labels)[0] == pytest.approx(least)
    tree = html_text.fit_tree(rows, labels, 20)
    assert (tree.predict(rows) == labels.astype(bool)).all()
    assert html_text.fit_tree(rows, np.ones(60)).predict(rows).all()


def test_tree_follows_its_table():
    rows, labels = html_text.labelled_rows(html_text.LABELLED)
    tree = html_text.trained_tree()
    assert (tree.predict(rows) == labels.astype(bool)).all() and 40 < len(labels) < 200
    rng = np.random.default_rng(2)
    other = np.array(rows)[rng.integers(0, len(rows), 500)]
    other[:, [0, 2, 4]] = rng.integers(1, 300, (500, 3))
    place = html_text.FEATURES.index("place")
    for told in (1, -1):
        other[:, place] = told
        assert (tree.predict(other) == (told == 1)).all()


def test_rows_of_all_kinds(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 30_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>a</p></article>"), (3, "u", long), (4, "u", "<article>é</article>"), (4, "u", "<article>é</article>")]
    pages = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_blocks long")
    found = html_text.main_text(pages).collect()
    assert sorted((str(r["page_id"]), str(r["url"]), len(r["text"])) for r in found) == sorted(
        [("1", "u", 0), ("2", "None", 0), ("None", "u", 1), ("3", "u", 30_000 * 12 - 1), ("4", "u", 1), ("4", "u", 1)]
    )
    assert html_text.main_text(pages.limit(0)).count() == 0
