"""Pages: line-block sums against a plain version on a tree of elements."""

import html as entities
import random
import re
from html.parser import HTMLParser

import pytest

from hertzmill.llm import html

BLOCKS = {"html", "body", "div", "p", "article", "main", "nav", "footer", "aside", "h1", "ul", "li", "table", "tr", "td", "head", "script", "style", "title", "section", "header"}
APART = {"head", "nav", "footer", "aside", "script", "style", "title"}


class Plain(HTMLParser):
    """Lines of a page from the list of open elements; each element ends at its end tag or with what holds it."""

    def __init__(self, page, unclosed=()):
        super().__init__(convert_charrefs=True)
        self.open, self.rows, self.text, self.own, self.unclosed = [], [], "", 0, unclosed
        self.feed(page)
        self.close()
        self.line()

    def line(self):
        text = " ".join(self.text.split())
        if text:
            self.rows.append((text, min(self.own, len(text)), any(x in ("article", "main") for x in self.open)))
        self.text, self.own = "", 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.line()
            while self.open and self.open[-1] in ("p", "b", "i") and "p" in self.open:
                self.open.pop()
        if tag in ("article", "main", "nav", "footer", "aside", "section"):
            self.open = [x for x in self.open if x not in self.unclosed]
        if tag == "br":
            self.text += " "
        else:
            self.open.append("apart" if "ad" in (dict(attrs).get("class") or "").split() else tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.line()
        if tag in self.open or "apart" in self.open and tag == "div":
            while self.open.pop() not in (tag, "apart"):
                pass

    def handle_data(self, data):
        if not any(x in APART or x == "apart" for x in self.open):
            self.text += data
            if "a" not in self.open:
                self.own += len("".join(data.split()))


def plain_text(page, unclosed=()):
    rows = Plain(page, unclosed).rows
    inside = sum(n for _, n, a in rows if a)
    most = inside and 2 * inside >= sum(n for _, n, _ in rows)
    mass = [n + 20 if a else n / 4 if most else n for _, n, a in rows]
    if not any(mass) or not any(a for *_, a in rows) and sum(mass) < 60:
        return ""
    sums = []
    for i, (_, _, a) in enumerate(rows):
        near = [mass[j] for j in (i - 1, i, i + 1) if 0 <= j < len(rows) and rows[j][2] == a]
        sums.append(sum(near) * 3 / len(near) if a else sum(near))
    surge, keep, going = min(60, max(sums) / 2), set(), False
    for i in range(len(rows)):
        going = (sums[i] >= surge / 2 and any(mass[i : i + 2])) if going else sums[i] >= surge and mass[i] > 0
        if not going and sums[i] >= surge and mass[i]:
            going = True
        if going:
            keep.add(i)
    first, last = min(keep), max(keep)
    keep |= {i for i in range(first, last) if mass[i] and (rows[i][2] or not most)}
    for i in range(first - 1, first - 4, -1):
        if i < 0 or not mass[i] or rows[i][2] != rows[first][2]:
            break
        keep.add(i)
    return "\n".join(rows[i][0] for i in sorted(keep))


def test_all_pages_come_out_of_the_sums(spark, sf_dir, monkeypatch):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = [html.main_text(r["html"] or "") for r in rows]
    assert got == [plain_text(r["html"] or "") for r in rows] and sum(map(bool, got)) > 0.9 * len(rows)
    # with other sums other text comes out
    monkeypatch.setattr(html, "block_sums", lambda rows, mass: [1.0] + [0.0] * (len(rows) - 1))
    assert all(html.main_text(r["html"] or "") == x.split("\n")[0] for r, x in zip(rows, got, strict=True))


def made(rnd):
    word = lambda n: " ".join(rnd.choice(["alpha", "be", "gamma &amp; d", "e"]) for _ in range(n))
    para = lambda: f"<p>{word(rnd.choice([1, 2, 8, 40]))}" + rnd.choice(["", "<br>" + word(3), f"<a href=x>{word(4)}</a>"]) + rnd.choice(["", "</p>"])
    body = "".join(para() for _ in range(rnd.randint(1, 9)))
    for tag in rnd.sample(["article", "main", "div"], rnd.randint(0, 1)):
        body = f"<{tag}>{body}" + ("" if rnd.random() < 0.2 else f"</{tag}>")
    extra = f"<div>{word(rnd.choice([2, 30]))}</div>" if rnd.random() < 0.5 else ""
    ad = "<div class=ad>" + word(12) + "</div>" if rnd.random() < 0.5 else ""
    foot = "<footer>" + word(10) + rnd.choice(["", "</footer>"])
    return f"<html><body><nav><ul><li><a href=x>{word(2)}</a></li></ul></nav>{ad}{extra}{body}{extra}{foot}</body></html>"


def test_made_pages():
    rnd = random.Random(4)
    for _ in range(400):
        page = made(rnd)
        assert html.main_text(page) == plain_text(page), page


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # a nav without an end tag goes on to the next section; an article without one to the end of the body
        ("<body><nav><a href=x>Home</a> or <p>menu words</p><article><p>the text</p></article></body>", "the text"),
        ("<body><article><p>the text</p><p>more</p></body>", "the text\nmore"),
        ("<body><div class='sidebar'><p>side words</p><main><p>kept by the article in it</p></main></div></body>", "kept by the article in it"),
        ("<div class='comments'><article><p>reader</p></article></div><article class='comment'><p>too</p></article>", ""),
        ("<article><ul><li>one<li>two<li class='ad'>buy<li>three</ul></article>", "one\ntwo\nthree"),
        ("<article><p>a <b>b <i>c</b> d</i> e</p></article>", "a b c d e"),
        ("<article><p>5 < 6 and a<b</p></article>", "5 < 6 and a"),
    ],
)
def test_elements_without_ends(page, text):
    assert html.main_text(page) == text


def test_two_stretches():
    long, short = "many words of a long line " * 6, "x"
    page = "".join(f"<p>{x}</p>" for x in [long, *[short] * 9, long]) + "<p><a href=x>link</a></p>" * 4 + f"<p>{short}</p>"
    assert html.main_text(page) == "\n".join([long.strip(), *[short] * 9, long.strip()])
    assert entities.unescape(re.sub("<.*?>", "", page)) != ""


def test_long_and_deep_pages():
    assert html.main_text("<div>" * 50_000 + "word " * 50 + ("<p>" + "x" * 30) * 50_000).count("\n") > 49_000
    assert html.main_text("<i>" * 20_000 + "words " * 30 + "</b>" * 20_000) == ("words " * 30).strip()
