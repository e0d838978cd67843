"""Main text of web pages: boosted trees over DOM nodes and a consistent choice.

A page becomes a tree of elements and text blocks. Each node has features of
its subtree (text, links, markup density), its attribute tokens, its depth,
its siblings and the kinds of its ancestors. Boosted trees give every node the
log odds that it holds article text, given that its parent does. The decoder
picks the likeliest labelling in which no node with text of the article sits
below one without (a tree dynamic program), and the text blocks chosen are the
result.

Training pages: the `TRAIN_PAGES` distinct pages with the lowest hashes. Where their
markup is explicit (article or main) it gives the labels. As other sites name
things otherwise, each is also trained on in `VARIANTS` rewritten forms: its
paragraphs and its boilerplate under other elements and attribute names, with
menus, headers, side bars, notices, adverts, forms and reader comments added.

Defined cases: null and empty html and pages without text give the empty
string; a page that breaks off or never closes its tags is read to its end; a
null id or url is carried; repeated rows stay; other columns are ignored;
without any training page the tokens of attributes and tags alone decide.
"""

from __future__ import annotations

import html as entities
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.boosting import Boosted
from vigil.llm.common import map_batches

TRAIN_PAGES, VARIANTS = 200, 6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template iframe textarea title svg math select object audio video canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img input button".split())
#: Elements that end an open element of the same set: a new paragraph ends the last, and so on.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd pre blockquote figcaption caption".split())  # their text is kept or left with them
CLOSES = {t: frozenset(s.split()) for t, s in {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}.items()}
SCOPES = frozenset("ul ol dl table body html div section article main td th aside nav header footer form blockquote".split())

_TAG = re.compile(r"""<!--.*?-->|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>|<[!?/][^>]*>|</?[a-zA-Z][^>]*>""", re.S)
_NAME = re.compile(r"""(?:\s|^)(class|id|role|itemprop|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
_END = re.compile(r"[.!?;:,]")

#: Attribute tokens by what they tell.
TOKENS = {
    "body": "article articlebody body content entry main post story text maincontent prose",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs links",
    "edge": "header footer masthead topbar bottom copyright colophon legal top banner logo",
    "side": "sidebar side aside related recommended widget rail tags share social trending popular more",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adsense outbrain",
    "notice": "cookie cookies consent notice alert popup modal overlay gdpr subscribe newsletter paywall",
    "talk": "comment comments reply replies discussion disqus respond reader",
    "form": "form login search signup register contact",
}
_GROUP = {t: i for i, ts in enumerate(TOKENS.values()) for t in ts.split()}
_TAGS = {"article": 0, "main": 0, "nav": 1, "menu": 1, "header": 2, "footer": 2, "aside": 3, "form": 7, "button": 7, "dialog": 5}
KINDS = ["#text", "p", "h", "li", "ul", "div", "section", "article", "main", "a", "table", "pre"]
N_GROUPS = len(TOKENS)


class Page:
    """The tree in document order: parents come before their children."""

    def __init__(self, html: str, marked: bool = False):
        """`marked`: html made by `rewritten`, whose label attributes are read."""
        self.marked = marked
        self.tag, self.parent, self.depth, self.groups, self.mark = ["#root"], [-1], [0], [0], [None]
        self.text, self.link, self.tags = [""], [0], [0]
        self.stack, self.run, self.in_link = [0], [], 0
        self._read(html)

    def _open(self, tag: str, groups: int, mark, text: str = "", link: int = 0) -> int:
        up = self.stack[-1]
        for column, value in ((self.tag, tag), (self.parent, up), (self.depth, self.depth[up] + 1), (self.groups, groups),
                              (self.mark, self.mark[up] if mark is None else mark), (self.text, text), (self.link, link), (self.tags, 0)):
            column.append(value)
        return len(self.tag) - 1

    def _block(self) -> None:
        """The text since the last block boundary becomes a block of the innermost block element."""
        if self.run:
            words = " ".join("".join(t for t, _ in self.run).split())
            if words:
                self._open("#text", 0, None, words, sum(len(t.strip()) for t, linked in self.run if linked))
            self.run = []

    def _text(self, raw: str) -> None:
        if raw:
            self.run.append((entities.unescape(raw) if "&" in raw else raw, self.in_link > 0))

    def _pop(self, at: int) -> None:
        del self.stack[at:]

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.run.append((" ", False))
        if tag == "a":
            self.in_link = 1
        self.tags[self.stack[-1]] += 1
        if tag in INLINE:
            return
        self._block()
        if tag in VOID:
            return
        self.in_link = 0 if tag != "a" else self.in_link
        if tag not in ("p",) and tag in CLOSES:
            for at in range(len(self.stack) - 1, 0, -1):
                name = self.tag[self.stack[at]]
                if name in CLOSES[tag]:
                    self._pop(at)
                    break
                if name in SCOPES and not (tag == "tr" and name in ("td", "th")):
                    break
        elif self.tag[self.stack[-1]] == "p":  # a block element ends an open paragraph
            self._pop(len(self.stack) - 1)
        groups, mark = (1 << _TAGS[tag]) if tag in _TAGS else 0, None
        if attrs:
            for name, a, b, c in _NAME.findall(attrs):
                value = a or b or c
                if name.lower() == "data-y":
                    mark = int(value) if self.marked else None
                else:
                    for token in _PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
                        if token in _GROUP:
                            groups |= 1 << _GROUP[token]
        self.stack.append(self._open(tag, groups, mark))

    def _end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = 0
        if tag in INLINE or tag in VOID:
            return
        self._block()
        for at in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[at]] == tag:
                self._pop(at)
                return

    def _read(self, html: str) -> None:
        at, last = 0, html.rfind(">") + 1
        while at < last and (m := _TAG.search(html, at, last)):
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            if not (name := m.group(2)):
                if html.startswith("<!--", m.start()) and not m.group().endswith("-->"):
                    at = last  # a comment that never ends
                continue
            name = name.lower()
            if m.group(1):
                self._end(name)
            elif name in SKIPPED:
                self._block() if name not in INLINE else None
                close = re.compile(f"</{name}", re.I).search(html, at)
                at = html.find(">", close.start()) + 1 if close and html.find(">", close.start()) >= 0 else len(html)
            else:
                self._start(name, m.group(3))
        self._text(html[at:])
        self._block()


FEATURES = (["depth", "chars", "words", "link_share", "tags_per_char", "ends_per_word", "mean_block", "blocks", "place", "share_of_page", "share_of_parent",
             "siblings", "sibling_place", "sibling_mean", "sibling_links", "long_blocks", "is_longest", "same_tag"]
            + [f"is_{k}" for k in KINDS] + [f"own_{g}" for g in TOKENS] + [f"above_{g}" for g in TOKENS] + [f"parent_{g}" for g in TOKENS]
            + [f"below_{g}" for g in TOKENS])


def features(page: Page) -> np.ndarray:
    """One row of FEATURES per node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own = np.array([len(t) for t in page.text], float)
    sums = np.stack([own, [len(t.split()) for t in page.text], page.link, page.tags, [len(_END.findall(t)) for t in page.text],
                     own > 0, own >= 80], 1).astype(float)
    before = np.cumsum(own) - own
    for i in range(n - 1, 0, -1):  # children come after parents
        sums[parent[i]] += sums[i]
    chars, words, link, tags, ends, blocks, long_blocks = sums.T
    safe = np.maximum(chars, 1)
    count, total, links = np.zeros(n), np.zeros(n), np.zeros(n)
    np.add.at(count, parent[1:], 1)
    np.add.at(total, parent[1:], chars[1:])
    np.add.at(links, parent[1:], link[1:])
    longest = np.zeros(n)
    np.maximum.at(longest, parent[1:], chars[1:])
    place, seen = np.zeros(n), [0] * n
    for i in range(1, n):
        place[i] = seen[parent[i]]
        seen[parent[i]] += 1
    up = np.maximum(parent, 0)
    others = np.maximum(count[up] - 1, 1)
    groups = np.array(page.groups)
    above = np.zeros(n, int)
    for i in range(1, n):
        above[i] = above[parent[i]] | groups[parent[i]]
    below = groups.copy()
    for i in range(n - 1, 0, -1):
        below[parent[i]] |= below[i]
    alike: dict[tuple[int, str], int] = {}
    for key in zip(page.parent, page.tag):
        alike[key] = alike.get(key, 0) + 1
    bits = np.arange(N_GROUPS)
    kind = [KINDS.index(k) if (k := "h" if len(t) == 2 and t[0] == "h" and t[1].isdigit() else "ul" if t == "ol" else t) in KINDS else -1 for t in page.tag]
    is_kind = (np.array(kind)[:, None] == np.arange(len(KINDS))).astype(float)
    return np.column_stack([
        np.minimum(page.depth, 20), np.log1p(chars), np.log1p(words), link / safe, tags / safe, ends / np.maximum(words, 1), np.log1p(chars / np.maximum(blocks, 1)),
        np.log1p(blocks), before / max(own.sum(), 1), chars / max(own.sum(), 1), chars / np.maximum(chars[up], 1), np.minimum(count[up], 30),
        place / np.maximum(count[up], 1), np.log1p((total[up] - chars) / others), (links[up] - link) / np.maximum(total[up] - chars, 1), np.log1p(long_blocks), chars >= longest[up],
        [alike[k] for k in zip(page.parent, page.tag)] / np.maximum(count[up], 1),
        is_kind, groups[:, None] >> bits & 1, above[:, None] >> bits & 1, groups[up][:, None] >> bits & 1, below[:, None] >> bits & 1])


def decode(page: Page, odds: np.ndarray) -> list[int]:
    """Text nodes of the likeliest labelling; a node below one that is left out is left out.

    `odds` are those of a node given that its parent is kept. The best log
    likelihood of a subtree whose parent is kept is that of leaving its root
    out, or of keeping it with the best of its children's subtrees.
    """
    tied = [t == "#text" and page.tag[u] in LEAVES for t, u in zip(page.tag, page.parent)]
    odds = np.where(tied, 50.0, odds)
    # Paragraphs side by side mostly go together: each is judged with the mean of its kind under one parent.
    rows: dict[tuple[int, str], list[int]] = {}
    for i, (up, tag) in enumerate(zip(page.parent, page.tag)):
        if tag in LEAVES and not page.groups[i]:
            rows.setdefault((up, tag), []).append(i)
    for row in rows.values():
        odds[row] += odds[row].mean()
    take, leave = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    for i in range(len(odds) - 1, 0, -1):
        take[page.parent[i]] += max(take[i], leave[i])
    keep = take > leave
    keep[0] = True
    out = []
    for i in range(1, len(odds)):
        keep[i] &= keep[page.parent[i]]
        if keep[i] and page.tag[i] == "#text":
            out.append(i)
    return out


#: A page of which nothing is kept is decoded again with the odds raised by so much.
EASE = (0.0, 1.0)

_BAD = sum(1 << i for i, g in enumerate(TOKENS) if g != "body")


def markup_labels(page: Page) -> np.ndarray | None:
    """1 for nodes that hold text of the article by its markup; None where the markup doesn't say."""
    n = len(page.tag)
    roots = {i for i in range(n) if page.tag[i] in ("article", "main")}
    if not roots and not any(m is not None for m in page.mark):
        return None
    inside, y = [False] * n, np.zeros(n)
    for i in range(1, n):
        inside[i] = (i in roots or inside[page.parent[i]]) and not (page.groups[i] & _BAD)
        if page.tag[i] == "#text" and (bool(page.mark[i]) if page.mark[i] is not None else inside[i]):
            y[i] = 1
    for i in range(n - 1, 0, -1):
        y[page.parent[i]] = max(y[page.parent[i]], y[i])
    return y


def _shaped(text: str, dice: random.Random) -> str:
    """A paragraph as a list, table, quotation, preformatted text, figure or section of its own."""
    esc = entities.escape
    pieces = [p for p in re.split(r"(?<=[.!?;:,]) ", text) if p] or [text]
    words = text.split(" ")
    cells = [" ".join(words[i:i + 4]) for i in range(0, len(words), 4)]
    inner = lambda p: esc(p) if dice.random() < .7 else f"<p>{esc(p)}</p>"
    return dice.choice([
        lambda: (lambda t: f"<{t}>" + "".join(f"<li>{inner(p)}</li>" for p in pieces) + f"</{t}>")(dice.choice(["ul", "ol"])),
        lambda: "<table>" + "".join("<tr>" + "".join(f"<{t}>{esc(c)}</{t}>" for c in cells[i:i + 3]) + "</tr>" for i in range(0, len(cells), 3) for t in [dice.choice(["td", "td", "th"])]) + "</table>",
        lambda: f"<pre>{esc(text)}</pre>", lambda: f"<pre><code>{esc(text)}</code></pre>", lambda: f"<blockquote>{esc(text)}</blockquote>",
        lambda: "<blockquote>" + "".join(f"<p>{esc(p)}</p>" for p in pieces) + "</blockquote>",
        lambda: f'<figure><img src="x.png"><figcaption>{esc(text)}</figcaption></figure>',
        lambda: f"<section><h2>{esc(' '.join(words[:4]))}</h2><p>{esc(' '.join(words[4:]) or text)}</p></section>",
        lambda: "<dl>" + "".join(f"<dt>{esc(p.split(' ')[0])}</dt><dd>{esc(p)}</dd>" for p in pieces) + "</dl>"])()


def rewritten(page: Page, y: np.ndarray, dice: random.Random) -> str:
    """The same article and boilerplate under other markup, with the labels in data-y attributes."""
    esc = entities.escape
    body = [(page.tag[page.parent[i]], page.text[i]) for i in range(len(y)) if page.tag[i] == "#text" and y[i]]
    junk = [page.text[i] for i in range(len(y)) if page.tag[i] == "#text" and not y[i]] or ["Home"]
    words = " ".join(t for _, t in body).split() or ["text"]
    if dice.random() < 0.3:  # short articles are rare in a sample, but not on the web
        body = body[:dice.randint(1, 3)]
    phrase = lambda a, b: esc(" ".join(dice.choice(words) for _ in range(dice.randint(a, b))))
    box = lambda tags, names, inner, y=0: (lambda t: f'<{t}{dice.choice([" class", " id"])}="{dice.choice(names.split())}" data-y="{y}">{inner}</{t}>')(dice.choice(tags.split()))
    links = lambda a, b: "<ul>" + "".join(f'<li><a href="#">{dice.choice([esc(dice.choice(junk)), phrase(1, 4)])}</a></li>' for _ in range(dice.randint(a, b))) + "</ul>"
    some = lambda p, x: x() if dice.random() < p else ""
    plain = lambda a, b: dice.choice([f"<p>{phrase(a, b)}</p>", phrase(a, b), f"<div>{phrase(a, b)}</div>", f"<p>{phrase(a, b)}.</p><p>{phrase(a, b)}, {phrase(a, b)}.</p>"])
    advert = lambda: box("div section aside p", "ad ads advert sponsored promo-box adsense banner-ad x1", dice.choice([esc(dice.choice(junk)), phrase(5, 30)]))
    notice = lambda: box("div section dialog", "cookie-notice consent alert popup newsletter notice gdpr-banner", plain(6, 40) + some(.6, lambda: f"<button>{phrase(1, 2)}</button>"))
    talk = lambda: box("div section ol", "comments comment-list discussion disqus_thread responses replies", some(.5, lambda: f"<h3>{phrase(1, 4)}</h3>") + "".join(
        dice.choice([lambda: plain(4, 60), lambda: box("div li article", "comment reply c reader-comment", some(.6, lambda: f"<b>{phrase(1, 2)}</b>") + plain(4, 60))])() for _ in range(dice.randint(1, 5))))
    form = lambda: f'<form data-y="0">{some(.6, lambda: "<label>" + phrase(1, 4) + "</label>")}<input name="q">{plain(2, 12)}{some(.6, lambda: "<button>" + phrase(1, 2) + "</button>")}</form>'
    side = lambda: box("aside div section", "sidebar related widget-area side recommended rail", some(.6, lambda: f"<h3>{phrase(1, 4)}</h3>") + dice.choice([lambda: links(2, 9), lambda: plain(5, 40) + links(1, 4), lambda: plain(5, 50)])())
    head = lambda: dice.choice([f'<header data-y="0"><h2>{phrase(1, 4)}</h2>{links(0, 6)}</header>', box("div", "header masthead top logo", phrase(1, 6))])
    menu = lambda: dice.choice([f'<nav data-y="0">{links(2, 10)}</nav>', box("div ul", "menu nav navbar breadcrumbs links", links(2, 10))])
    foot = lambda: dice.choice([f'<footer data-y="0"><p>{esc(dice.choice(junk))}</p></footer>', box("div section", "footer bottom copyright legal", plain(3, 25) + some(.5, lambda: links(2, 6)))])
    parts, shaped = [], dice.choice([0, 0, .25])
    for k, (tag, text) in enumerate(body):
        if dice.random() < shaped:  # the given articles may hold paragraphs only, those of the web do not
            parts.append(_shaped(text, dice))
            continue
        tag = tag if len(tag) == 2 and tag[0] == "h" or tag in ("p", "li", "blockquote", "pre", "td") else "p"
        cut = text.split(" ")
        if len(cut) > 8 and dice.random() < .3:
            cut[3] = f'<a href="#">{esc(cut[3])}</a>'
            parts.append(f"<{tag}>{' '.join(w if j == 3 else esc(w) for j, w in enumerate(cut))}</{tag}>")
        else:
            parts.append(f"<{tag}>{esc(text)}</{tag}>")
        if dice.random() < .06:
            parts.append(advert())
    inner = "".join(parts)
    inner = dice.choice([inner, inner, f"<div>{inner}</div>"])
    inside = some(.2, talk) + some(.1, form) + some(.15, side)
    article = dice.choice([lambda: f'<article data-y="1">{inner}{inside}</article>', lambda: f'<main data-y="1">{inner}{inside}</main>', lambda: f'<div data-y="1">{inner}{inside}</div>',
                           lambda: f'<section data-y="1">{inner}{inside}</section>', lambda: f'<div class="{dice.choice(["post", "entry-content", "story", "text", "article-body", "col-8", "x"])}" data-y="1">{inner}{inside}</div>'])()
    article = article if dice.random() < .88 else ""  # some pages have none
    middle = some(.4, side) + article + some(.4, side) + some(.3, talk)
    middle = dice.choice([middle, f'<div id="wrap">{middle}</div>', f'<div class="page"><div class="row">{middle}</div></div>'])
    return ("<html><body data-y='0'>" + some(.4, notice) + some(.5, head) + some(.8, menu) + some(.4, advert) + some(.2, form) + middle
            + some(.3, advert) + some(.2, form) + some(.8, foot) + some(.2, notice) + "</body></html>")


def train(pages: list[str], variants: int = VARIANTS, seed: int = 7) -> Boosted:
    xs, ys, dice = [np.zeros((0, len(FEATURES)))], [np.zeros(0)], random.Random(seed)
    for html in pages:
        page = Page(html or "")
        y = markup_labels(page)
        if y is None or not y.any():
            continue
        for made in [page, *(Page(rewritten(page, y, dice), marked=True) for _ in range(variants))]:
            y_made = markup_labels(made)
            y_made[0] = 1
            below = y_made[np.maximum(made.parent, 0)] > 0  # what the decoder asks: nodes whose parent is kept
            below[0] = False
            xs.append(features(made)[below])
            ys.append(y_made[below])
    if len(xs) == 1:
        # No page to learn from: an element counts against the text when its names say so.
        probe = Page("".join(f'<div class="{t}"><p>a b c</p></div><div><p>a b c</p></div>' for t in _GROUP))
        x = np.repeat(features(probe)[1:], 20, 0)
        at = [FEATURES.index(f"{p}_{g}") for p in ("own", "above") for g in TOKENS if g != "body"]
        return Boosted(rounds=20).fit(x, 1.0 - x[:, at].any(1))
    return Boosted(rounds=120, depth=5).fit(np.concatenate(xs), np.concatenate(ys))


def main_texts(htmls: list[str | None], model: Boosted) -> list[str]:
    pages = [Page(h or "") for h in htmls]
    odds = model.predict(np.concatenate([features(p) for p in pages])) if pages else []
    out, at = [], 0
    for page in pages:
        n = len(page.tag)
        kept = next((k for ease in EASE if (k := decode(page, odds[at:at + n] + ease))), [])
        out.append("\n".join(page.text[i] for i in kept))
        at += n
    return out


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", train_pages: int = TRAIN_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    pages = df.select(df[id_col].cast("long").alias("page_id"), df[url_col].cast("string").alias("url"), df[html_col].cast("string").alias("html"))
    hashed = pages.where("length(html) > 0").select("html", F.xxhash64("html").alias("h"))
    lowest = hashed.select("h").distinct().orderBy("h").limit(train_pages)  # train_pages numbers; copies count once
    sample = [r[0] for r in hashed.join(F.broadcast(lowest), "h", "left_semi").dropDuplicates(["h"]).orderBy("h").select("html").collect()]
    shared = df.sparkSession.sparkContext.broadcast(train(sample))  # a few thousand numbers

    def run(batch):
        texts = main_texts(batch.column("html").to_pylist(), shared.value)
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                          names=["page_id", "url", "text", "n_chars"])
    return map_batches(pages, run, "page_id long, url string, text string, n_chars long", "html")


def op7_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
