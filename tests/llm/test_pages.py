"""Main text: the pages that once lost text, and the given pages against another reader of their markup."""

import os
from html.parser import HTMLParser

import pytest

from rosterlake.llm import extract

FOLDER = "/root/testdata/sf0.001"
LONG = "This is a long paragraph of many words that goes on and on, for that is what the paragraphs of an article do, as a rule."


def test_teasers_do_not_stand_for_the_text():
    teasers = "<article><h2>Other</h2><p>Read this too.</p></article><article><h2>More</h2><p>And that.</p></article>"
    want = "\n\n".join(f"{LONG} {i}" for i in range(3))
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(3))
    assert extract.main_text(f"<div>{body}</div>{teasers}") == want
    assert extract.main_text(f"{teasers}<div>{body}</div>") == want
    assert extract.main_text(f"<article>{body}</article><div>{LONG}</div>") == want


def test_references_stay_and_menus_go():
    titles = ["A study of something in many pages", "Another study of something else", "The third of these long studies"]
    links = "".join(f"<li><a href=x>{t}</a></li>" for t in titles)
    menu = "".join(f"<li><a href=x>{t}</a></li>" for t in ("Home", "Blog", "About us", "Contact"))
    assert extract.main_text(f"<article><p>{LONG}</p><ul>{links}</ul></article>") == "\n\n".join([LONG, *titles])
    assert extract.main_text(f"<article><p>{LONG}</p><ul>{menu}</ul></article>") == LONG
    assert extract.main_text(f"<article><p>{LONG}</p><nav>{links}</nav></article>") == LONG


@pytest.mark.parametrize("word", ["side", "legal", "tags", "comments"])
def test_a_class_word_around_the_whole_page(word):
    page = f"<div class='{word}'><p>{LONG}</p><div class='ad'>{LONG}</div><p>{LONG}</p></div>"
    assert extract.main_text(page) == f"{LONG}\n\n{LONG}"
    assert extract.main_text(f"<p>{LONG} here</p>{page}") == f"{LONG} here"


def test_a_short_first_paragraph_before_a_table():
    table = "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table>"
    assert extract.main_text(f"<nav>Menu</nav><div><p>A short one.</p>{table}<p>{LONG}</p></div>") == "\n\n".join(["A short one.", "a", "b", "c", "d", LONG])


def test_a_very_long_page_is_read_whole():
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(20_000))
    text = extract.main_text(f"<nav>Menu</nav><div>{body}</div><footer>{LONG}</footer>")
    assert text.count("\n\n") == 19_999 and text.endswith(" 19999")


class Reader(HTMLParser):
    """Blocks inside the article element, by the standard parser: the generator of the pages puts the whole text there."""

    BLOCKS = {"article", "h1", "h2", "h3", "p", "div", "ul", "ol", "li", "table", "tr", "td", "th", "blockquote", "pre", "section", "figure", "figcaption", "hr", "dl", "dt", "dd"}
    OUT = {"nav", "aside", "footer", "header", "form", "script", "style", "button", "noscript", "iframe"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.inside, self.out = [""], 0, 0

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.out += tag in self.OUT
        if tag in self.BLOCKS:
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.blocks.append("")
        self.inside -= tag == "article"
        self.out -= tag in self.OUT

    def handle_data(self, data):
        if self.inside and not self.out:
            self.blocks[-1] += data


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_given_pages_agree_with_another_reader(spark):
    same = total = 0
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        reader = Reader()
        reader.feed(r["html"])
        reader.close()
        want = "\n\n".join(t for b in reader.blocks if (t := " ".join(b.split())))
        got = extract.main_text(r["html"])
        total += 1
        same += got == want or set(got.split("\n\n")) <= set(want.split("\n\n")) and len(got) > 0.9 * len(want)
    assert total == 50 and same >= 0.9 * total
