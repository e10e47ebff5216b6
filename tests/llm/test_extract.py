from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest

from lendworks.llm import dom, extract
from lendworks.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    return {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}


@pytest.fixture(scope="module")
def model(spark):
    return extract.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def truth(page: str) -> str:
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", "\n", inner))
    return " ".join(html.unescape(inner).split())


def main_text(model, page: str) -> str:
    parsed = dom.parse(page)
    return dom.text_of(parsed, extract.decode(parsed, model.log_odds(model.page_features(parsed))))


def test_query_finds_every_article(spark, pages):
    found = QUERIES["op8_html_text"](spark, SF).collect()
    assert len(found) == len(pages)
    assert all(r["text"] == truth(pages[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in found)


@pytest.mark.parametrize("invented", [0.0, 1.0])
def test_other_layouts(model, pages, invented):
    """Containers with usual names, and with names that no page has had before."""
    same = words = tried = 0
    for n, page in pages.items():
        for again in range(3):
            parsed = dom.parse(extract.layout(dom.parse(page), random.Random(f"held out {n} {again}"), invented))
            wanted = dom.text_of(parsed, extract.labels(parsed) > 0)
            got = dom.text_of(parsed, extract.decode(parsed, model.log_odds(model.page_features(parsed))))
            tried += 1
            same += got == wanted
            words += len(set(got.split()) & set(wanted.split())) / max(len(set(got.split()) | set(wanted.split())), 1)
    assert same / tried > 0.8 and words / tried > 0.9, (same / tried, words / tried)


def test_attribute_tokens_are_learnt(model):
    odds = {w: model.tokens[dom.slot(w)] for w in ("comments", "Sidebar", "navbar", "entry", "story")}
    assert max(odds[w] for w in ("comments", "Sidebar", "navbar")) < -1 < 1 < min(odds["entry"], odds["story"])
    assert len(model.tokens) == dom.TOKEN_SLOTS and abs(model.tokens[dom.slot("nosuchname")]) < 1


def test_everything_around_the_article_goes(model, pages):
    prose = [truth(p) for p in list(pages.values())[:4]]
    page = (
        f"<html><head><title>t</title></head><body><header class='site-header'><h2>Brand</h2></header>"
        f"<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
        f"<div class='cookie-notice'>We use cookies, please agree.</div><div class='wrapper'><article><h1>Title &amp; more</h1>"
        f"<p>{html.escape(prose[0])}</p><div class='ad'>Buy now, cheap things here.</div><p>{html.escape(prose[1])}</p></article>"
        f"<aside class='sidebar'><h3>Related</h3><ul><li><a href='/c'>Other story</a></li></ul></aside></div>"
        f"<section class='comments'><h3>Comments</h3><div class='comment'><p>{html.escape(prose[2][:200])}</p></div></section>"
        f"<form><label>Mail</label><input name='m'><button>Send</button></form><footer>Copyright</footer></body></html>"
    )
    assert main_text(model, page) == " ".join(["Title & more", prose[0], prose[1]])


def test_decoding_is_consistent_and_best():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(2, 9))
        page = dom.Page()
        for i in range(1, n):
            page.parents.append(int(rng.integers(0, i)))
            page.tags.append("div")
        odds = rng.normal(size=n) * 2

        def value(state: int) -> float | None:
            """Of a choice as bits: None if something below a dropped element is chosen."""
            total, dropped = 0.0, [False] * n
            for i in range(n):
                p, own = page.parents[i], bool(state >> i & 1)
                above = p >= 0 and bool(state >> p & 1)
                if p >= 0 and dropped[p]:
                    dropped[i] = True
                    if own:
                        return None
                elif above and not own:
                    dropped[i] = True
                    total -= extract.DROP_COST
                elif own and not above:
                    total -= extract.START_COST
                total += odds[i] if own else 0
            return total

        chosen = extract.decode(page, odds)
        best = max(v for s in range(1 << n) if (v := value(s)) is not None)
        got = value(sum(1 << i for i in range(n) if chosen[i]))
        assert got is not None and abs(got - best) < 1e-9 or not chosen.any() and best <= 1e-9


def test_parsing_of_broken_pages():
    everything = lambda page: dom.text_of((p := dom.parse(page)), np.ones(len(p.tags), bool))
    assert everything("<p>a<p>b<b>c</b>d<br>e") == "a bcd e"
    assert everything("x &lt;y&gt; &amp;amp; &#233;&nbsp;z <!-- no --> w") == "x <y> &amp; é z w"
    assert everything("&am<b>p;</b> &lt<i>x</i>") == "&amp; <x"
    assert everything("<script>var t='</p>';</script>k<style>p{}</style>") == "k"
    assert everything("a < b and 1<2 <unclosed") == "a < b and 1<2"
    assert everything("<ul><li>1<li>2</ul><table><tr><td>3<td>4</table>") == "1 2 3 4"
    assert everything("<div a='>'>q</div></section></p>r") == "q r"
    assert everything("<!-- never closed") == "" and everything("") == ""
    assert everything("<div>" * 3_000 + "deep") == "deep"


def test_hostile_attributes(model, pages):
    """No attribute of a page crashes the parser, is taken for a training mark, or is read as text."""
    page = next(iter(pages.values()))
    hostile = (
        'part-kept="1"', 'part-kept="0"', 'data-kept="yes"', 'data-kept=""', "class", 'class=""', 'class="a" class="b"', "id='",
        'class="&quot;><p>"', "class=a=b=c", '="x"', "part-kept=0", f'class="{"x " * 5_000}"', "\x00=1",
    )
    for attribute in hostile:
        found = dom.parse(f"<div {attribute}>x</div><p>y</p>")
        assert set(found.kept) == {None} and extract.labels(found) is None
        model.page_features(found)
        assert main_text(model, page.replace("<article>", f"<article {attribute}>")) is not None
    plain = main_text(model, page)
    assert main_text(model, page.replace("<p>", '<p part-kept="0">')) == plain == truth(page)


def test_training_pages_know_their_parts(pages):
    for n, page in list(pages.items())[:40]:
        known = extract.layout(dom.parse(page), random.Random(n))
        assert "part-kept" not in known
        parsed = dom.parse(known)
        assert {0, 1} <= set(parsed.kept) and len(parsed.kept) == len(parsed.tags) == len(dom.parse(str(known)).tags)


def test_awkward_tables(spark, model, pages):
    page = next(iter(pages.values()))
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, "u", page, "x", 1), (1, "u", page, "x", 1), (2, None, None, "x", 1), (None, "u", "", "x", 1), (3, "u", page * 40, "x", 1)]
    found = extract.extract(spark.createDataFrame(rows, schema), model).collect()
    assert [r["text"] for r in found if r["page_id"] == 1] == [truth(page)] * 2
    assert {(r["text"], r["n_chars"]) for r in found if r["page_id"] in (2, None)} == {("", 0)}
    assert extract.extract(spark.createDataFrame([], schema)).collect() == []
