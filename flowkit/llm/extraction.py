"""Main text of web pages by gradient-boosted trees over DOM nodes.

No page is labelled, so the trees learn from layouts whose answer is known: texts of a bounded sample of pages are set
again into varied layouts, with and without telling names, among menus, notices, adverts, forms and reader comments.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.llm import dom, trees
from flowkit.llm.documents import sliced

SAMPLE_PAGES = 150
LAYOUTS = 4
PAGE_CHARS = 30_000
SEED = 19
SCORED_NODES = 20_000

NAMES = {
    "content": "article content post entry-content main-content story article-body post-body text".split(),
    "header": "header site-header masthead page-header".split(),
    "menu": "menu nav navbar navigation breadcrumbs".split(),
    "footer": "footer site-footer bottom copyright".split(),
    "sidebar": "sidebar side widget related rail".split(),
    "notice": "notice cookie cookie-consent alert banner gdpr".split(),
    "advert": "ad ads advert sponsored promo".split(),
    "form": "newsletter subscribe search login signup".split(),
    "comments": "comments replies discussion responses reader-comments".split(),
    "share": "share social related".split(),
}
TAGS = {"header": "header", "menu": "nav", "footer": "footer", "sidebar": "aside", "comments": "section"}


class Layout:
    """Sets texts into a random page; content carries `data-mark=1`, everything else that has a mark is not content."""

    def __init__(self, turns: np.random.Generator, words: list[str]) -> None:
        self.turns = turns
        self.words = words or ["text"]

    def chance(self, share: float) -> bool:
        return bool(self.turns.random() < share)

    def phrase(self, least: int, most: int) -> str:
        return " ".join(self.words[i] for i in self.turns.integers(0, len(self.words), self.turns.integers(least, most + 1)))

    def box(self, kind: str, inner: str, mark: int = 0) -> str:
        tag = TAGS.get(kind, "div") if self.chance(0.5) else "div"
        if kind == "content":
            tag = ("article", "main", "section", "div", "div", "td")[self.turns.integers(0, 6)]
        name = NAMES[kind][self.turns.integers(0, len(NAMES[kind]))]
        named = f' {("class", "id")[self.turns.integers(0, 2)]}="{name}"' if self.chance(0.75) else ""
        body = f"<{tag}{named} data-mark={mark}>{inner}</{tag}>"
        return f"<table><tr>{body}</tr></table>" if tag == "td" else body

    def links(self, most: int) -> str:
        items = [f'<a href="/x">{self.phrase(1, 3)}</a>' for _ in range(self.turns.integers(2, most))]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items)

    def words_box(self, kind: str) -> str:
        inner = self.phrase(4, 25)
        return self.box(kind, f"<p>{inner}</p>" if self.chance(0.5) else inner)

    def form(self) -> str:
        inner = f"<label>{self.phrase(1, 4)}</label><input name=q><p>{self.phrase(3, 12)}</p>"
        return self.box("form", f"<form>{inner}</form>" if self.chance(0.8) else inner)

    def comments(self, texts: list[str]) -> str:
        own = [f"<div{' class=comment' if self.chance(0.6) else ''}><b>{self.phrase(1, 2)}</b><p>{t}</p></div>" for t in texts]
        head = f"<h3>{self.phrase(1, 3)}</h3>" if self.chance(0.6) else ""
        return self.box("comments", head + "".join(own))

    def body(self, title: str, texts: list[str]) -> str:
        parts = [f"<h1>{title}</h1>"] if title and self.chance(0.8) else []
        for text in texts:
            parts.append(f"<h2>{self.phrase(2, 6)}</h2>" if self.chance(0.1) else "")
            plain = self.turns.random()
            closing = "</p>" if self.chance(0.8) else ""
            parts.append(f"<p>{text}{closing}" if plain < 0.75 else f"<div>{text}</div>" if plain < 0.85 else f"<ul><li>{text}</li></ul>" if plain < 0.92 else f"<blockquote>{text}</blockquote>")
            if self.chance(0.06):
                parts.append(self.words_box("advert"))
            if self.chance(0.03):
                parts.append(self.box("share", self.links(5)))
        return "".join(parts)

    def page(self, title: str, texts: list[str], others: list[str]) -> str:
        before = [self.box("menu", self.links(9))] if self.chance(0.8) else []
        if self.chance(0.6):
            inner = f"<h1>{self.phrase(1, 4)}</h1>" + (f"<p>{self.phrase(3, 12)}</p>" if self.chance(0.5) else "")
            before.insert(int(self.turns.integers(0, 2)), self.box("header", inner + ("".join(before) if self.chance(0.3) else "")))
        before += [self.words_box(k) for k in ("notice", "advert") if self.chance(0.5)]
        before += [self.form()] if self.chance(0.25) else []
        side = self.box("sidebar", f"<h3>{self.phrase(1, 4)}</h3>{self.links(7)}" + (f"<p>{self.phrase(5, 40)}</p>" if self.chance(0.5) else ""))
        content = self.box("content", self.body(title, texts), 1)
        after = [self.box("share", self.links(6))] if self.chance(0.3) else []
        after += [self.comments(others)] if others and self.chance(0.5) else []
        if self.chance(0.6):
            (before if self.chance(0.5) else after).append(side)
        after += [self.form()] if self.chance(0.3) else []
        after += [self.words_box(k) for k in ("notice", "advert") if self.chance(0.25)]
        after += [self.box("footer", f"&copy; {self.phrase(2, 20)}" + (self.links(5) if self.chance(0.4) else ""))] if self.chance(0.85) else []
        inner = "".join(before) + content + "".join(after)
        for _ in range(int(self.turns.integers(0, 3))):
            inner = f"<div{' class=wrap' if self.chance(0.5) else ''}>{inner}</div>"
        return f"<html><body>{inner}</body></html>"


def labelled(page: dom.Page) -> np.ndarray:
    """1 for nodes within content and outside what is marked as other, and for the ancestors of such nodes."""
    state = [""] * len(page.tags)
    for i in range(1, len(page.tags)):
        state[i] = page.marks[i] or state[page.parents[i]]
    label = np.array([s == "1" for s in state], dtype=float)
    for i in range(len(label) - 1, 0, -1):
        label[page.parents[i]] = max(label[page.parents[i]], label[i])
    return label


def set_again(sources: list[str], seed: int = SEED) -> Iterator[str]:
    """Layouts of the texts of the sampled pages: a page's longer runs as content, other pages' as comments."""
    turns = np.random.default_rng(seed)
    pages = []
    for source in sources:
        page = dom.read(source)
        runs = [html.escape(t) for t in page.texts if t]
        pages.append(([t for t in runs if len(t) >= 60], " ".join(runs).split()[:400]))
    pages = [p for p in pages if p[0]]
    for i, (texts, words) in enumerate(pages):
        for _ in range(LAYOUTS):
            layout = Layout(turns, words)
            chosen = texts[: turns.integers(1, 13)]
            chosen = [t if turns.random() < 0.7 else t[: turns.integers(20, 200)] for t in chosen]
            pool = pages[(i + 1 + int(turns.integers(0, len(pages)))) % len(pages)][0]
            others = [t[: turns.integers(20, 300)] for t in pool[: turns.integers(1, 7)]]
            yield layout.page(words and " ".join(words[:8]) or "", chosen, others)


def learn(pages: DataFrame) -> trees.Forest | None:
    """Trees fitted on layouts of a bounded sample: about `SAMPLE_PAGES` pages by a hash of `page_id`, each with
    `PAGE_CHARS` characters at most; None without any text.  (Runs: a count and the sample.)
    """
    known = pages.where(F.col("html").isNotNull())
    share = int(min(1.0, SAMPLE_PAGES / max(1, known.count())) * (1 << 30))
    drawn = known.where(F.pmod(F.xxhash64("page_id", F.lit(SEED)), F.lit(1 << 30)) < share)
    rows = drawn.select("page_id", F.substring("html", 1, PAGE_CHARS).alias("html")).orderBy("page_id", "html").limit(2 * SAMPLE_PAGES).collect()
    made = [dom.read(x) for x in set_again([r["html"] for r in rows])]
    if not made:
        return None
    return trees.grow(np.concatenate([dom.describe(p) for p in made]), np.concatenate([labelled(p) for p in made]))


def extract(pages: DataFrame, forest: trees.Forest | None) -> DataFrame:
    """Adds `text` and `n_chars` (its code points) to pages with an `html`; other columns pass through.

    The text runs that are kept, white space as one space, are joined by two line ends; "" for a null or empty page,
    one without content, and every page if nothing was learned.  Columns named `text` or `n_chars` are replaced.
    """
    pages = pages.drop("text", "n_chars")
    schema = T.StructType([*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    if forest is None:
        return pages.withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")})
    shared = pages.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in sliced(batches, 256):
            texts: list[str] = []
            waiting: list[dom.Page] = []
            nodes = 0
            sources = batch.column("html")
            for i in range(batch.num_rows):
                waiting.append(dom.read(sources[i].as_py() or ""))
                nodes += len(waiting[-1].tags)
                if nodes >= SCORED_NODES or i + 1 == batch.num_rows:
                    odds = forest.odds(np.concatenate([dom.describe(p) for p in waiting]))
                    cuts = np.cumsum([len(p.tags) for p in waiting])[:-1]
                    texts += ["\n\n".join(dom.decode(p, o)) for p, o in zip(waiting, np.split(odds, cuts), strict=True)]
                    waiting, nodes = [], 0
            columns = [*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.mapInArrow(run, schema)
