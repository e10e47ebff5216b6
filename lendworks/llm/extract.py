"""Main text of HTML pages: gradient-boosted trees over the elements, decoded along the tree.

Each element gets features of its subtree's density, its attributes' words, its depth and its siblings. The words of
class, id and role attributes are hashed into slots, whose log-odds are learnt with the trees. Trees
boosted on the logistic loss score how likely it belongs to the article. Decoding then chooses for the whole
page at once: an element outside the article may start it, an element inside may be dropped with all below
it, and nothing below a dropped element returns. Of all such choices the one with the largest sum of log odds
is taken, so ancestors and descendants never contradict each other.

No labels are given, so the trees learn from a bounded sample: ``max_train`` pages with the smallest hashed
ids. Pages that mark their article are examples as they stand. The sampled pages' own sentences are moreover
laid out anew in many ways (other containers and names, some of them made up, adverts inside, comments below), with
the parts known.

Defined results: a null page counts as empty, and an empty page or one without main text has the empty text
and 0 characters. Every page is handled whole, on its own; repeated rows give repeated results. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendworks.llm.batches import bounded_batches, slices, texts_of
from lendworks.llm.dom import FEATURES, MAIN_TAGS, TOKEN_SLOTS, KnownPage, Page, features, parse, text_of, token_odds
from lendworks.staging import Stage

MAX_TRAIN = 300
LAYOUTS = 6
#: Share of the layouts whose containers have made-up names.
INVENTED = 0.5
#: Elements of a training page that are learnt from, at most.
TRAIN_ELEMENTS = 1_500
TREES = 100
DEPTH = 5
BINS = 32
RATE = 0.25
START_COST = 1.0
DROP_COST = 0.5
LOG_ODDS = 4.0


@dataclass
class Boosted:
    """Complete binary trees, per tree the split features, split values and leaf scores; and the attribute tokens' odds."""

    tokens: np.ndarray
    start: float
    features: np.ndarray
    borders: np.ndarray
    leaves: np.ndarray

    def page_features(self, page: Page) -> np.ndarray:
        return features(page, self.tokens)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start, np.float32)
        rows = np.arange(len(x))
        for tree_features, tree_borders, tree_leaves in zip(self.features, self.borders, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, tree_features[at]] > tree_borders[at])
            out += tree_leaves[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, tokens: np.ndarray) -> Boosted:
    """Second-order boosting on histograms."""
    inner, n = 2**DEPTH - 1, max(len(y), 1)
    good = min(max(float(y.mean()) if len(y) else 0.0, 1 / (2 * n)), 1 - 1 / (2 * n))
    model = Boosted(
        tokens,
        float(np.log(good / (1 - good))),
        np.zeros((TREES, inner), np.int64),
        np.full((TREES, inner), np.inf, np.float32),
        np.zeros((TREES, inner + 1), np.float32),
    )
    if not len(y) or y.min() == y.max():
        return model
    wide = x.shape[1]
    borders = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])).astype(np.float32) for f in range(wide)]
    binned = np.stack([np.searchsorted(b, x[:, f]) for f, b in enumerate(borders)], axis=1)
    flat = binned + np.arange(wide) * BINS
    raw = np.full(len(y), model.start)
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        slope, bend = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            for node in range(2**depth - 1, 2 ** (depth + 1) - 1):
                mine = np.flatnonzero(at == node)
                if len(mine) < 20:
                    continue
                cells = flat[mine].ravel()
                g = np.bincount(cells, np.repeat(slope[mine], wide), wide * BINS).reshape(wide, BINS).cumsum(axis=1)
                h = np.bincount(cells, np.repeat(bend[mine], wide), wide * BINS).reshape(wide, BINS).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                for f, b in enumerate(borders):
                    gain[f, len(b) :] = 0
                best = int(gain.argmax())
                if gain.flat[best] > 1e-3:
                    model.features[tree, node] = best // BINS
                    model.borders[tree, node] = borders[best // BINS][best % BINS]
            at = 2 * at + 1 + (x[np.arange(len(y)), model.features[tree, at]] > model.borders[tree, at])
        leaf = at - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        model.leaves[tree] = RATE * g / (h + 1)
        raw += model.leaves[tree][leaf]
    return model


def decode(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """The best consistent choice of elements."""
    n = len(page.tags)
    gain = np.clip(log_odds, -LOG_ODDS, LOG_ODDS).astype(float)
    inside, outside = gain, np.zeros(n)
    for i in range(n - 1, -1, -1):
        p = page.parents[i]
        if p >= 0:
            # What a child adds if its parent is inside, and if its parent is outside.
            inside[p] += max(inside[i], -DROP_COST)
            outside[p] += max(outside[i], inside[i] - START_COST)
    chosen, dropped = np.zeros(n, bool), np.zeros(n, bool)
    for i in range(n):
        p = page.parents[i]
        if p >= 0 and dropped[p]:
            dropped[i] = True
        elif p >= 0 and chosen[p]:
            chosen[i] = inside[i] > -DROP_COST
            dropped[i] = not chosen[i]
        else:
            chosen[i] = inside[i] - START_COST > outside[i]
    return chosen


def labels(page: Page) -> np.ndarray | None:
    """1 for elements of the article, by the parts' marks or else by the article's own element."""
    marked = any(k is not None for k in page.kept)
    if not marked and not any(t in MAIN_TAGS for t in page.tags):
        return None
    out = np.zeros(len(page.tags))
    for i in range(1, len(out)):
        if page.kept[i] is not None:
            out[i] = page.kept[i]
        elif not marked and page.tags[i] in MAIN_TAGS:
            out[i] = 1
        else:
            out[i] = out[page.parents[i]]
    return out


def layout(page: Page, rng: random.Random, invented: float = INVENTED) -> KnownPage:
    """A page with known parts, made of another page's sentences.

    On a share of ``invented`` pages the containers have made-up names, which tell nothing about their parts.
    """
    strange = rng.random() < invented
    prose = [t.strip() for i, t in page.pieces if t and len(t.strip()) > 40 and page.tags[i] not in ("script", "style")]
    short = [t.strip() for _, t in page.pieces if t and 0 < len(t.strip()) <= 40] or ["More"]
    prose = prose or short
    words = " ".join(prose).split() or ["text"]

    def phrase() -> str:
        k = rng.randrange(len(words))
        return " ".join(words[k : k + rng.randint(1, 6)])

    def sentence() -> str:
        return rng.choice(prose)[: rng.choice((80, 200, 400))] if rng.random() < 0.6 else phrase()

    def box(tags: str, names: str, kept: int, body: str) -> str:
        tag, name = rng.choice(tags.split()), rng.choice([*names.split(), ""])
        if strange and name:
            name = "".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
        attribute = "" if not name else f' {rng.choice(("class", "id"))}="{name}"'
        return f'<{tag}{attribute} part-kept="{kept}">{body}</{tag}>'

    def links(kept: int = 0) -> str:
        items = "".join(f'<li><a href="/x">{phrase()}</a></li>' for _ in range(rng.randint(2, 8)))
        return box("ul ul ol", "nav menu links", kept, items)

    def lines(k: int) -> str:
        return "".join(f"<p>{sentence()}</p>" for _ in range(k))

    head = lambda: box("header header div", "header masthead topbar site-header", 0, rng.choice((phrase(), links(), f"<h1>{phrase()}</h1>")))
    nav = lambda: box("nav nav div", "nav menu navigation breadcrumbs navbar", 0, rng.choice((links(), phrase())))
    advert = lambda: box("div div aside section", "ad advert sponsored banner promo ads", 0, sentence())
    notice = lambda: box("div div section", "cookie-notice notice alert consent banner message", 0, sentence())
    side = lambda: box("aside aside div section", "sidebar widget related side-rail", 0, rng.choice((links(), lines(2), f"<h3>{phrase()}</h3>{links()}")))
    form = lambda: f'<form part-kept="0"><label>{phrase()}</label><input name="q"><button>{phrase()}</button></form>' if rng.random() < 0.7 else box("div", "newsletter signup search", 0, f"<p>{sentence()}</p><input><button>{phrase()}</button>")  # noqa: E731,E501
    remark = lambda: box("div li article", "comment comment-body reply", 0, f"<b>{phrase()}</b><p>{sentence()}</p>")
    remarks = lambda: box("section div ol", "comments comment-list respond disqus reviews", 0, f"<h3>{phrase()}</h3>" + "".join(remark() for _ in range(rng.randint(1, 5))))  # noqa: E731,E501
    foot = lambda: box("footer footer div", "footer site-footer copyright", 0, rng.choice((f"&copy; {sentence()}", links() + phrase())))

    def article() -> str:
        parts = [f"<h1>{escape(phrase())}</h1>"] * (rng.random() < 0.9)
        for _ in range(rng.choice((1, 2, 3, 5, 8, 14))):
            kind = rng.random()
            if kind < 0.72:
                text = rng.choice(prose) if rng.random() < 0.7 else sentence()
                parts.append(f"<p><b>{text}<br>{sentence()}" if rng.random() < 0.1 else f"<p>{text}</p>")
            elif kind < 0.78:
                parts.append(f"<h2>{phrase()}</h2>")
            elif kind < 0.84:
                parts.append("<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif kind < 0.88:
                parts.append(f"<blockquote>{lines(1)}</blockquote>")
            elif kind < 0.91:
                parts.append(f"<table><tr><td>{phrase()}</td><td>{phrase()}</td></tr></table>")
            elif kind < 0.94:
                parts.append(f"<div>{lines(2)}</div>")
            else:
                parts.append(rng.choice((advert, form, notice, side, remarks))())
        body = "".join(parts)
        return box("article article main div div section", "content post entry-content article-body story main", 1, body)

    main = article()
    if rng.random() < 0.3:
        main = box("div main", "page wrapper container content", 0, main + (side() if rng.random() < 0.5 else ""))
    top = [f() for f in (head, nav, advert, notice, side, form) if rng.random() < 0.4]
    end = [f() for f in (side, advert, remarks, form, notice, nav, foot) if rng.random() < 0.4]
    rng.shuffle(top)
    body = f"{''.join(top)}{main}{''.join(end)}"
    return KnownPage(body if rng.random() < 0.2 else f"<html><head><title>{phrase()}</title></head><body>{body}</body></html>")


def fit(pages: DataFrame, max_train: int = MAX_TRAIN) -> Boosted:
    """Train on a bounded sample; its elements' features, not its pages, reach the driver."""
    sample_of = pages.select(F.col("page_id").cast("string").alias("name"), F.col("html").cast("string").alias("html"))
    sample_of = sample_of.filter("html is not null").orderBy(F.xxhash64("name"), "name", F.xxhash64("html")).limit(max_train)
    sample = Stage(pages.sparkSession).table("sample", lambda: sample_of)

    def known(batch: pa.RecordBatch) -> Iterator[tuple[Page, np.ndarray, list[int]]]:
        """Pages of known parts, each with its elements' labels and those of them that are learnt from."""
        for name, html in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            rng = random.Random(name or "")
            page = parse(html)
            for one in [page, *(parse(layout(page, rng)) for _ in range(LAYOUTS))]:
                y = labels(one)
                if y is not None:
                    yield one, y, sorted(rng.sample(range(len(y)), min(len(y), TRAIN_ELEMENTS)))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, TOKEN_SLOTS), np.int64)
        for batch in slices(batches, 1):
            for page, y, picked in known(batch):
                for i in picked:
                    for token in page.names[i]:
                        sums[int(y[i]), token] += 1
        kept, slots = np.nonzero(sums)
        columns = [pa.array(kept.astype(np.int32)), pa.array(slots.astype(np.int32)), pa.array(sums[kept, slots])]
        yield pa.RecordBatch.from_arrays(columns, ["kept", "slot", "n"])

    counted = sample.mapInArrow(count, "kept int, slot int, n bigint").groupBy("kept", "slot").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, TOKEN_SLOTS))
    for row in counted.collect():  # two rows a slot at most
        counts[row["kept"], row["slot"]] = row["n"]
    tokens = token_odds(counts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows = [(features(p, tokens)[picked].tobytes(), y[picked].astype(np.uint8).tobytes()) for p, y, picked in known(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)], ["x", "y"])

    found = sample.mapInArrow(run, "x binary, y binary").collect()
    if not found:
        return boost(np.zeros((0, len(FEATURES)), np.float32), np.zeros(0), tokens)
    x = np.frombuffer(b"".join(r["x"] for r in found), np.float32).reshape(-1, len(FEATURES))
    return boost(x, np.frombuffer(b"".join(r["y"] for r in found), np.uint8).astype(float), tokens)


def extract(pages: DataFrame, model: Boosted | None = None, max_train: int = MAX_TRAIN) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    bounded_batches(pages.sparkSession)
    model = model or fit(pages, max_train)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def main_text(htmls: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(htmls), 64):
            parsed = [parse(h or "") for h in htmls.slice(at, 64).to_pylist()]
            rows = [shared.value.page_features(p) for p in parsed]
            odds = shared.value.log_odds(np.concatenate(rows))
            ends = np.cumsum([len(r) for r in rows])
            out += [text_of(p, decode(p, odds[e - len(r) : e])) for p, r, e in zip(parsed, rows, ends)]
        return pa.array(out, pa.string())

    found = pages.select("page_id", "url", main_text(F.col("html").cast("string")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
