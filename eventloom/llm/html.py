"""Main-text extraction by a recurrent block labeller.

A page becomes its sequence of leaf blocks. Every block is a vector of its tag path (tags, and words
of class, id and role), hashed words of its text and a few sizes. A bidirectional LSTM in numpy
reads the whole sequence, so each block is judged with the whole page as context. It is trained
here, on pages that `sample_page` composes, with a fixed seed.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.llm.tokens import slices

#: Content that is markup or code, never text of a page.
HIDDEN = {"script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "head", "title", "textarea", "select", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img",
}
#: A start tag of the key closes open elements of the value up to the nearest enclosing container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = {"ul", "ol", "dl", "table", "tbody", "thead", "div", "article", "section", "main", "aside", "nav", "body"}
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
PATH_SLOTS, WORD_SLOTS, SIZES = 96, 24, 8
WIDTH = 2 * PATH_SLOTS + WORD_SLOTS + SIZES


#: Slots of the words of a path, and words of its last two elements.
Path = tuple[frozenset[int], tuple[tuple[str, ...], ...]]


class _Blocks(HTMLParser):
    """Collects (path, text, characters inside links) of leaf blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Name, slots of the words of the whole path so far, words of its last two elements.
        self.stack: list[tuple[str, frozenset[int], tuple[tuple[str, ...], ...]]] = []
        self.blocks: list[tuple[Path, str, int]] = []
        self.text: list[str] = []
        self.linked = self.hidden = self.links = 0
        self.path: Path = (frozenset(), ())

    def flush(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((self.path, text, self.linked))
            self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            elif tag == "hr":
                self.flush()
            return
        if tag not in INLINE:
            self.flush()
            if self.stack and self.stack[-1][0] == "head" and tag not in HIDDEN:
                self._pop(len(self.stack) - 1)  # a head that was never closed
            if tag not in HIDDEN:
                self._close_through({"p"})
            if tag in CLOSES:
                self._close_through(CLOSES[tag])
        words = [tag]
        for k, v in attrs:
            if k in ("class", "id", "role", "aria-label", "itemprop") and v:
                words += [w for w in SPLIT.split(v.lower()) if w][:6]
        slots, near = self.stack[-1][1:] if self.stack else (frozenset(), ())
        if tag not in INLINE or len(words) > 1:
            new = {_slot(w, PATH_SLOTS) for w in words}
            slots, near = slots if new <= slots else slots | new, (*near, tuple(words))[-2:]
        self.stack.append((tag, slots, near))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def _close_through(self, tags):
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name in tags:
                self._pop(k)
                return
            if name in CONTAINERS:
                return

    def _pop(self, k):
        for name, *_ in self.stack[k:]:
            self.hidden -= name in HIDDEN
            self.links -= name == "a"
        del self.stack[k:]

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag not in INLINE:
            self.flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self._pop(k)
                return
            if tag in INLINE and self.stack[k][0] in CONTAINERS:
                return

    def handle_data(self, data):
        if self.hidden:
            return
        if not self.text:
            if not data.strip():
                return
            self.path = self.stack[-1][1:] if self.stack else (frozenset(), ())
        self.text.append(data)
        if self.links:
            self.linked += len(data.strip())


def blocks_of(html: str | None) -> list[tuple[Path, str, int]]:
    """Leaf blocks of a page in order; broken markup is read as far as it goes. An element carries what
    its path adds up to, so a deep page costs no more than a flat one."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.blocks


@lru_cache(maxsize=100_000)
def _slot(word: str, slots: int) -> int:
    return zlib.crc32(word.encode()) % slots


def vectors(blocks) -> np.ndarray:
    """One row for each block: words of the nearest elements, of the whole path, of the whole text (each adds
    the less the more there are), sizes."""
    out = np.zeros((len(blocks), WIDTH), np.float32)
    for i, ((slots, near), text, linked) in enumerate(blocks):
        out[i, list(slots)] = 1
        for w in (w for group in near for w in group):
            out[i, PATH_SLOTS + _slot(w, PATH_SLOTS)] = 1
        words = text.split()
        for w in words:
            out[i, 2 * PATH_SLOTS + _slot(w.lower(), WORD_SLOTS)] += 0.8 / max(8, len(words))
        n = len(text)
        out[i, -SIZES:] = (
            np.log1p(n) / 8, min(1, linked / n), len(words) == 1, text[-1] in ".!?:;\"'”…»", i / len(blocks), 1 / len(blocks),
            sum(map(text.count, ".,;!?")) / n * 10, text[:1] in "©&·|»›",
        )
    return out


class BiLstm:
    """Two LSTMs over a padded batch of sequences and a logistic output."""

    def __init__(self, width: int, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p = {"o": rng.normal(0, 0.2, 2 * hidden), "ob": np.zeros(1)}
        for d in "fb":
            self.p[f"w{d}"] = rng.normal(0, 0.15, (width, 4 * hidden))
            self.p[f"u{d}"] = rng.normal(0, 0.2, (hidden, 4 * hidden))
            self.p[f"c{d}"] = np.r_[np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]

    def _run(self, x, mask, d):
        n, steps, h = len(x), x.shape[1], self.h
        pre = x @ self.p[f"w{d}"].astype(x.dtype) + self.p[f"c{d}"].astype(x.dtype)
        u = self.p[f"u{d}"].astype(x.dtype)
        s, c = np.zeros((n, h), x.dtype), np.zeros((n, h), x.dtype)
        out, kept = np.zeros((n, steps, h), x.dtype), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[:, t] + s @ u
            g = 1 / (1 + np.exp(-z[:, : 3 * h]))
            i, f, o, a = g[:, :h], g[:, h : 2 * h], g[:, 2 * h :], np.tanh(z[:, 3 * h :])
            m = mask[:, t : t + 1]
            c2 = m * (f * c + i * a)
            th = np.tanh(c2)
            kept.append((t, s, c, i, f, o, a, th, m))
            s, c = m * (o * th), c2
            out[:, t] = s
        return out, kept

    def forward(self, x, mask):
        (f, kf), (b, kb) = self._run(x, mask, "f"), self._run(x, mask, "b")
        both = np.concatenate([f, b], axis=2)
        return both @ self.p["o"].astype(x.dtype) + self.p["ob"][0], both, kf, kb

    def gradients(self, x, mask, y):
        z, both, kf, kb = self.forward(x, mask)
        err = mask * (1 / (1 + np.exp(-z)) - y) / mask.sum()
        g = {"o": np.einsum("nt,nth->h", err, both), "ob": np.array([err.sum()])}
        dh_all = err[:, :, None] * self.p["o"]
        h = self.h
        for d, kept, part in (("f", kf, slice(0, h)), ("b", kb, slice(h, 2 * h))):
            u, dz_all = self.p[f"u{d}"], np.zeros((*x.shape[:2], 4 * h))
            ds, dc, gu = np.zeros((len(x), h)), np.zeros((len(x), h)), np.zeros_like(u)
            for t, s, c, i, f, o, a, th, m in reversed(kept):
                dh = (dh_all[:, t, part] + ds) * m
                dcc = (dc + dh * o * (1 - th * th)) * m
                dz = np.concatenate([dcc * a * i * (1 - i), dcc * c * f * (1 - f), dh * th * o * (1 - o), dcc * i * (1 - a * a)], axis=1)
                dz_all[:, t] = dz
                gu += s.T @ dz
                ds, dc = dz @ u.T, dcc * f
            g[f"u{d}"], g[f"c{d}"] = gu, dz_all.sum(axis=(0, 1))
            g[f"w{d}"] = x.reshape(-1, x.shape[2]).T @ dz_all.reshape(-1, 4 * h)
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int, size: int, rate: float, seed: int):
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for epoch in range(epochs):
            order = sorted(rng.permutation(len(pages)), key=lambda k: len(pages[k][0]) // 8)
            groups = [order[i : i + size] for i in range(0, len(order), size)]
            for k in rng.permutation(len(groups)):
                x, mask, y = pad([pages[i][0] for i in groups[k]], [pages[i][1] for i in groups[k]])
                t += 1
                for name, grad in self.gradients(x.astype(np.float64), mask.astype(np.float64), y).items():
                    grad = np.clip(grad, -1, 1)
                    m[name] = 0.9 * m[name] + 0.1 * grad
                    v2[name] = 0.999 * v2[name] + 0.001 * grad * grad
                    lr = rate * (0.3 if epoch >= epochs - 2 else 1)
                    self.p[name] = self.p[name] - lr * (m[name] / (1 - 0.9**t)) / (np.sqrt(v2[name] / (1 - 0.999**t)) + 1e-8)
        return self


def pad(xs, ys=None):
    n = max(map(len, xs))
    x, mask, y = np.zeros((len(xs), n, WIDTH), np.float32), np.zeros((len(xs), n), np.float32), np.zeros((len(xs), n), np.float32)
    for i, a in enumerate(xs):
        x[i, : len(a)], mask[i, : len(a)] = a, 1
        if ys is not None:
            y[i, : len(a)] = ys[i]
    return x, mask, y


def sample_page(rng: np.random.Generator) -> tuple[str, set[str]]:
    """A made-up page of one of many layouts, and the texts of its blocks that belong to the article."""
    wanted: set[str] = set()
    pick = lambda *x: x[int(rng.integers(len(x)))]
    chance = lambda p: rng.random() < p

    def word():
        return "".join(chr(97 + int(k)) for k in rng.integers(0, 26, int(rng.integers(1, 10))))

    def words(lo, hi, end="."):
        w = [word() for _ in range(int(rng.integers(lo, hi + 1)))]
        for k in range(len(w)):
            if chance(0.08):
                w[k] += pick(",", ".", ";", "&amp;", "***", " |")
        return (" ".join(w)).capitalize() + (end if chance(0.85) else "")

    def good(text, tag="p", attrs=""):
        wanted.add(text)
        end = "" if tag == "p" and chance(0.1) else f"</{tag}>"
        shown = text
        if chance(0.15):
            shown = pick("<b>{}</b>", "<b>{}<br>", "<em>{}</em>", "<span>{}</span>").format(text)
        elif chance(0.1):
            half = len(text) // 2
            at = text.find(" ", half)
            if at > 0:
                shown = text[:at] + f' <a href="/{word()}">' + text[at + 1 :] + "</a>"
        return f"<{tag}{attrs}>{shown}{end}"

    def links(n):
        return "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, 3, "")}</a></li>' for _ in range(n)) + "</ul>"

    def boiler(names, tags, inner):
        tag, name = pick(*tags), pick(*names)
        attr = pick(f' class="{name}"', f' id="{name}"', f' class="{word()} {name}"', f' class="{name}-{pick("box", "wrap", "block", "area", "inner", "list")}"')
        return f"<{tag}{attr}>{inner}</{tag}>"

    def prose():
        return pick("", "<p>", "<div>") + words(2, 40)

    def comments():
        one = "".join(f'<div class="{pick("comment", "reply", "comment-body")}"><span>{word()}</span><p>{words(2, 50)}</p></div>' for _ in range(int(rng.integers(1, 6))))
        return boiler(("comments", "comment-list", "responses", "discussion", "disqus", "user-comments", "replies", "reader-comments"), ("div", "section", "ol", "aside"), pick("", f"<h3>{pick('Comments', words(1, 3, ''))}</h3>") + one)

    def advert():
        return boiler(("ad", "ads", "advert", "advertisement", "sponsor", "promo", "banner", "sponsored", "adsense"), ("div", "aside", "div", "section"), prose())

    def form():
        return f'<form{pick("", " class=newsletter", " id=search", " class=subscribe")}>{pick("<p>", "<label>", "")}{words(1, 20)}<input type="text"><button>{word()}</button></form>'

    def notice():
        return boiler(("cookie", "cookies", "notice", "consent", "alert", "gdpr", "popup", "modal", "notification", "disclaimer", "cookie-banner"), ("div", "section", "aside", "p"), prose())

    def sidebar():
        inner = "".join(pick(lambda: links(int(rng.integers(2, 8))), lambda: f"<p>{words(3, 30)}</p>", lambda: f"<h3>{words(1, 4, '')}</h3>", advert)() for _ in range(int(rng.integers(1, 4))))
        return pick(f"<aside>{inner}</aside>", boiler(("sidebar", "side", "widget", "rail", "related", "recommended", "more-stories", "trending", "popular"), ("div", "aside", "section"), inner))

    def extra():
        return pick(
            lambda: boiler(("share", "social", "tags", "meta", "byline", "breadcrumb", "breadcrumbs", "pagination", "author-bio"), ("div", "ul", "nav", "section"), pick(links(3), words(1, 8))),
            sidebar, advert, notice, form,
        )()

    def article():
        parts = []
        if chance(0.85):
            parts.append(good(words(1, 14, ""), "h1"))
        for _ in range(int(rng.integers(0, 14))):
            kind = rng.random()
            if kind < 0.72:
                parts.append(good(words(1, int(pick(6, 30, 80, 120)))))
            elif kind < 0.8:
                parts.append(good(words(1, 8, ""), pick("h2", "h3")))
            elif kind < 0.86:
                tag = pick("ul", "ol")
                parts.append(f"<{tag}>" + "".join(good(words(2, 15), "li") for _ in range(int(rng.integers(1, 6)))) + f"</{tag}>")
            elif kind < 0.9:
                parts.append(f"<blockquote>{good(words(4, 30))}</blockquote>")
            elif kind < 0.92:
                parts.append(good(words(3, 20), "pre"))
            elif kind < 0.94:
                parts.append("<table>" + "".join("<tr>" + good(words(1, 4, ""), "td") + good(words(1, 4, ""), "td") + "</tr>" for _ in range(2)) + "</table>")
            elif kind < 0.96:
                parts.append("<figure><img src=x>" + good(words(2, 12), "figcaption") + "</figure>")
            else:
                parts.append(extra())
        if chance(0.2):
            parts.append(comments())
        inner = "".join(parts)
        name = pick("content", "post", "entry", "article", "article-body", "post-content", "entry-content", "story", "main-content", "text", "body")
        return pick(
            f"<article>{inner}</article>", f"<article>{inner}</article>", f"<main>{inner}</main>", f'<main><article class="{name}">{inner}</article></main>',
            f'<div class="{name}">{inner}</div>', f'<div id="{name}">{inner}</div>', f'<div class="{word()}"><div class="{name}">{inner}</div></div>',
            f"<div>{inner}</div>", f'<section class="{name}">{inner}</section>',
        )

    head = [f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title><style>p{{margin:0}}</style></head><body>"]
    if chance(0.4):
        head.append(notice())
    if chance(0.5):
        head.append(pick(f"<header>{pick('', '<h1>' + words(1, 3, '') + '</h1>')}<p>{words(1, 12)}</p>{links(3)}</header>", boiler(("header", "masthead", "topbar", "site-header", "logo"), ("div",), words(1, 8))))
    if chance(0.8):
        head.append(pick(f"<nav>{links(int(rng.integers(2, 9)))}</nav>", boiler(("menu", "nav", "navbar", "navigation", "main-menu"), ("div", "ul", "nav"), links(int(rng.integers(2, 9))))))
    for _ in range(int(rng.integers(0, 3))):
        head.append(pick(advert, sidebar, advert, form)())
    body = article()
    tail = []
    if chance(0.35):
        tail.append(comments())
    for _ in range(int(rng.integers(0, 3))):
        tail.append(extra())
    if chance(0.8):
        tail.append(pick(f"<footer>{pick('&copy; ', '')}{word()}.com {pick('&middot;', '|', '')} {words(1, 20)}{pick('', links(3))}</footer>", boiler(("footer", "site-footer", "copyright", "legal", "colophon", "bottom"), ("div", "p"), words(1, 20))))
    return "".join([*head, body, *tail, pick("</body></html>", "")]), wanted


@lru_cache(maxsize=2)
def labeller(seed: int = 7, pages: int = 700, hidden: int = 16, epochs: int = 8) -> BiLstm:
    """The labeller, trained on `pages` composed pages; always the same for the same arguments."""
    from html import unescape

    rng = np.random.default_rng(seed)
    data = []
    for _ in range(pages):
        html, wanted = sample_page(rng)
        texts = {" ".join(unescape(w).split()) for w in wanted}
        blocks = blocks_of(html)
        if blocks:
            data.append((vectors(blocks), np.array([t in texts for _, t, _ in blocks], np.float32)))
    return BiLstm(WIDTH, hidden, seed).fit(data, epochs, 24, 0.01, seed)


def main_texts(model: BiLstm, htmls: list[str | None], most: int = 60_000) -> list[str]:
    """The main text of every page; batches hold pages of like length, at most `most` padded blocks."""
    pages = [blocks_of(h) for h in htmls]
    out = [""] * len(pages)
    order = sorted((i for i, b in enumerate(pages) if b), key=lambda i: len(pages[i]))
    while order:
        n, longest = 1, len(pages[order[0]])
        while n < len(order) and (n + 1) * len(pages[order[n]]) <= most and len(pages[order[n]]) <= 2 * longest + 8:
            n += 1
        group, order = order[:n], order[n:]
        x, mask, _ = pad([vectors(pages[i]) for i in group])
        z = model.forward(x, mask)[0]
        for row, i in enumerate(group):
            out[i] = " ".join(b[1] for b, v in zip(pages[i], z[row], strict=False) if v > 0)
    return out


def extract_main_text(pages: DataFrame, seed: int = 7) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of `pages`.

    A null or empty html, or a page without article blocks, gives an empty text. Repeated rows each
    get a row; further columns are ignored.
    """
    model = labeller(seed)

    def run(batches):
        for batch in batches:
            for start, part in slices(batch, "html", 2_000_000):
                texts = main_texts(model, part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id").slice(start, len(part)).cast(pa.int64()),
                        batch.column("url").slice(start, len(part)).cast(pa.string()),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
