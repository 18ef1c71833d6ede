"""Main text of web pages: a recurrent network labels each leaf block of a page as article or not.

A page is a sequence of leaf blocks (html_blocks). A block's vector is the sum of trained vectors of its path's tokens
(tags, tags with their parents, words of classes), the mean of trained vectors of its hashed words, and a few
measures (length, share in links, end of sentence, place in the page). A bidirectional LSTM in numpy reads the sequence
both ways, so each block is judged in view of the whole page; blocks that score one half or more are the main text.

**Training.** No table tells which blocks are articles, so the network learns from pages that are laid out anew: random
layouts (semantic elements, or divisions with class names, or neither), with menus, headers, notices, adverts, sidebars, forms,
comments and footers around and inside an article whose place is known. Their words come from ``POOL_PAGES`` pages
of the table itself (those with the least hashes of their ids), in article and surroundings alike, so that the words of a
page's subject tell nothing; the short phrases of menus and notices are a list. Names are left out at random, so that
the network also learns from order, lengths and links. It trains on the driver on ``TRAIN_PAGES`` pages, whatever the table's
size; its parameters are broadcast (under 1 MB).

Results for special inputs: null, empty or broken html gives what text can be read of it, or an empty one; a page without
markup is one block; repeated rows give repeated rows; an empty table gives no rows. The whole html is read, and
all blocks are labelled, whatever their number. Other columns of the input are not looked at.
"""

from __future__ import annotations

import random
from functools import lru_cache
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import scan
from tessera.llm.html_blocks import SLOTS, Block, blocks
from tessera.llm.shared import bounded

#: Pages of the table, and characters of each, whose words fill the training pages.
POOL_PAGES, POOL_CHARS = 200, 20_000
TRAIN_PAGES, EPOCHS, BATCH = 2400, 4, 32
#: Share of blocks whose words are hidden while training, so that they never decide alone.
HIDE = 0.4
PATH_DIM, WORD_DIM, HIDDEN = 24, 12, 24
WORD_SLOTS = 4096
MEASURES = 9
#: Blocks of a batch when pages are labelled (pages of like length stand together).
BATCH_BLOCKS = 20_000


# --- vectors -------------------------------------------------------------------------------------


def measures(page: list[Block]) -> np.ndarray:
    out = np.zeros((len(page), MEASURES), np.float32)
    chars = np.array([len(b.text) for b in page], np.float64)
    all_chars = max(1.0, chars.sum())
    for i, b in enumerate(page):
        text = b.text
        out[i, :6] = (b.linked, text[-1] in ".!?…。", text[-1] == ":", text[:1].isupper(), "©" in text or "|" in text, sum(c.isdigit() for c in text[:80]) / 80)
    out[:, 6] = np.log1p(chars) / 6
    out[:, 7] = np.sqrt(chars / all_chars)
    out[:, 8] = np.arange(len(page)) / max(1, len(page) - 1)
    return out


def features(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all blocks of the pages in a row: path slots and their counts, word slots and their counts, measures."""
    every = [b for page in pages for b in page]
    paths = np.fromiter((s for b in every for s in b.path), np.int64)
    words, counts = [], []
    for w in scan.words(pa.array([b.text for b in every], pa.string()), lower=True):
        words.append((w.hash & np.uint64(WORD_SLOTS - 1)).astype(np.int64))
        counts.append(np.diff(w.first))
    flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    told = np.concatenate([measures(page) for page in pages]) if every else np.zeros((0, MEASURES), np.float32)
    return paths, np.array([len(b.path) for b in every], np.int64), flat(words), flat(counts), told


def sums(table: np.ndarray, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the table's rows at each block's slots, a stretch of slots at a time."""
    out = np.zeros((len(counts), table.shape[1]), np.float32)
    ends = np.cumsum(counts)
    lo = 0
    while lo < len(counts):
        begin = ends[lo] - counts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, begin + (1 << 18), "right")))
        some = counts[lo:hi] > 0
        if some.any():
            at = (ends[lo:hi] - counts[lo:hi] - begin)[some]
            if hi == lo + 1:  # one long text
                out[lo] = np.bincount(slots[begin : ends[lo]], minlength=len(table)).astype(np.float32) @ table
            else:
                out[lo:hi][some] = np.add.reduceat(table[slots[begin : ends[hi - 1]]], at, axis=0)
        lo = hi
    return out


# --- network -------------------------------------------------------------------------------------


def parameters(seed: int) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    size = PATH_DIM + WORD_DIM + MEASURES
    out = {"paths": r.normal(0, 0.1, (SLOTS, PATH_DIM)), "words": r.normal(0, 0.1, (WORD_SLOTS, WORD_DIM))}
    for d in "fb":
        out |= {f"w{d}": r.normal(0, size**-0.5, (size, 4 * HIDDEN)), f"u{d}": r.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)), f"c{d}": np.zeros(4 * HIDDEN)}
        out[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
    out |= {"v": r.normal(0, 0.2, 2 * HIDDEN), "v0": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in out.items()}


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, c: np.ndarray, keep: bool):
    """Outputs (time, page, HIDDEN) of x (time, page, size), and what a step back needs."""
    z = x @ w + c
    steps, pages, h = len(x), x.shape[1], HIDDEN
    out, state, last = np.zeros((steps, pages, h), np.float32), np.zeros((pages, h), np.float32), np.zeros((pages, h), np.float32)
    tape = []
    for t in range(steps):
        a = z[t] + last @ u
        gates = sigmoid(a[:, : 3 * h])
        new = np.tanh(a[:, 3 * h :])
        before = state
        state = gates[:, h : 2 * h] * state + gates[:, :h] * new
        squashed = np.tanh(state)
        last = gates[:, 2 * h :] * squashed
        out[t] = last
        if keep:
            tape.append((gates, new, before, squashed))
    return out, tape


def lstm_back(x, w, u, out, tape, grad):
    """Gradients of w, u, c and x."""
    h = HIDDEN
    dz = np.zeros((len(x), x.shape[1], 4 * h), np.float32)
    dlast, dstate = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    for t in range(len(x) - 1, -1, -1):
        gates, new, before, squashed = tape[t]
        i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
        d = grad[t] + dlast
        dstate = dstate + d * o * (1 - squashed**2)
        dz[t] = np.concatenate([dstate * new * i * (1 - i), dstate * before * f * (1 - f), d * squashed * o * (1 - o), dstate * i * (1 - new**2)], axis=1)
        dlast = dz[t] @ u.T
        dstate = dstate * f
    before = np.concatenate([np.zeros_like(out[:1]), out[:-1]])
    flat = dz.reshape(-1, 4 * h)
    return x.reshape(-1, x.shape[2]).T @ flat, before.reshape(-1, h).T @ flat, flat.sum(0), dz @ w.T


def grid(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place (time, page) of each block, forwards and backwards in time."""
    page = np.repeat(np.arange(len(sizes)), sizes)
    time = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return time, sizes[page] - 1 - time, page


def forward(p: dict, vectors: np.ndarray, sizes: np.ndarray, keep: bool = False):
    """Logits of all blocks of pages of the given sizes."""
    ahead, behind, page = grid(sizes)
    steps, hidden, tapes = int(sizes.max(initial=0)), [], []
    for d, time in (("f", ahead), ("b", behind)):
        x = np.zeros((steps, len(sizes), vectors.shape[1]), np.float32)
        x[time, page] = vectors
        out, tape = lstm(x, p[f"w{d}"], p[f"u{d}"], p[f"c{d}"], keep)
        hidden.append(out[time, page])
        tapes.append((x, out, tape, time))
    hidden = np.concatenate(hidden, axis=1)
    return hidden @ p["v"] + p["v0"][0], hidden, tapes, page


def vectors_of(p: dict, paths, path_counts, words, word_counts, told) -> np.ndarray:
    mean = sums(p["words"], words, word_counts) / np.maximum(1, word_counts)[:, None]
    return np.concatenate([sums(p["paths"], paths, path_counts), mean, told], axis=1).astype(np.float32)


def gradients(p: dict, inputs: tuple, sizes: np.ndarray, wanted: np.ndarray, seen: np.ndarray) -> tuple[dict, float]:
    """Gradients of the mean log loss of one batch, and the loss; seen tells of which blocks the words are shown."""
    paths, path_counts, words, word_counts, told = inputs
    words, word_counts = words[np.repeat(seen, word_counts)], word_counts * seen
    vectors = vectors_of(p, paths, path_counts, words, word_counts, told)
    logits, hidden, tapes, page = forward(p, vectors, sizes, keep=True)
    score = sigmoid(logits)
    loss = float(-np.mean(np.log(np.where(wanted > 0, score, 1 - score) + 1e-9)))
    d = ((score - wanted) / len(wanted)).astype(np.float32)
    g = {"v": hidden.T @ d, "v0": d.sum(keepdims=True)}
    dhidden, dvectors = d[:, None] * p["v"], np.zeros_like(vectors)
    for k, (way, (x, out, tape, time)) in enumerate(zip("fb", tapes)):
        grad = np.zeros_like(out)
        grad[time, page] = dhidden[:, k * HIDDEN : (k + 1) * HIDDEN]
        g[f"w{way}"], g[f"u{way}"], g[f"c{way}"], dx = lstm_back(x, p[f"w{way}"], p[f"u{way}"], out, tape, grad)
        dvectors += dx[time, page]
    g["paths"], g["words"] = np.zeros_like(p["paths"]), np.zeros_like(p["words"])
    np.add.at(g["paths"], paths, np.repeat(dvectors[:, :PATH_DIM], path_counts, axis=0))
    mean = dvectors[:, PATH_DIM : PATH_DIM + WORD_DIM] / np.maximum(1, word_counts)[:, None]
    np.add.at(g["words"], words, np.repeat(mean, word_counts, axis=0))
    return g, loss


def trained(pages: list[list[Block]], seed: int = 7, epochs: int = EPOCHS, rate: float = 0.01) -> dict[str, np.ndarray]:
    """Parameters after training on pages whose blocks are labelled "1" or not (Adam, log loss)."""
    p = parameters(seed)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    pages = sorted((x for x in pages if x), key=len)
    lots = [pages[i : i + BATCH] for i in range(0, len(pages), BATCH)]
    wanted = [np.array([b.label == "1" for x in lot for b in x], np.float32) for lot in lots]
    inputs, sizes = [features(lot) for lot in lots], [np.array([len(x) for x in lot]) for lot in lots]
    r, hide, step = random.Random(seed), np.random.default_rng(seed), 0
    for epoch in range(epochs):
        order = list(range(len(lots)))
        r.shuffle(order)
        for k in order:
            step += 1
            g, _ = gradients(p, inputs[k], sizes[k], wanted[k], hide.random(len(wanted[k])) >= HIDE)
            norm = sum(float((v.astype(np.float64) ** 2).sum()) for v in g.values()) ** 0.5
            pace = rate * (1 - 0.9 * epoch / max(1, epochs - 1)) if epochs > 1 else rate
            for name, v in g.items():
                v = v / max(1.0, norm)
                first[name] = 0.9 * first[name] + 0.1 * v
                second[name] = 0.999 * second[name] + 0.001 * v * v
                p[name] = (p[name] - pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def scores(p: dict, pages: list[list[Block]]) -> list[np.ndarray]:
    """Each page's blocks' scores."""
    out: list = [None] * len(pages)
    order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * len(pages[order[hi]]) <= BATCH_BLOCKS:
            hi += 1
        lot = [pages[k] for k in order[lo:hi]]
        sizes = np.array([len(x) for x in lot])
        if sizes.sum():
            logits = forward(p, vectors_of(p, *features(lot)), sizes)[0]
        else:
            logits = np.zeros(0, np.float32)
        for k, part in zip(order[lo:hi], np.split(sigmoid(logits), np.cumsum(sizes)[:-1])):
            out[k] = part
        lo = hi
    return out


# --- training pages ------------------------------------------------------------------------------

#: Names that page makers give to parts of a page, and what menus and notices say.
NAMES = {
    "article": "article post content entry story main text body post-content entry-content article-body main-content articleBody page",
    "menu": "nav menu navbar navigation main-menu top-nav breadcrumb breadcrumbs site-nav links tabs",
    "header": "header site-header masthead banner branding top logo topbar page-header",
    "footer": "footer site-footer bottom colophon copyright page-footer footer-widgets",
    "sidebar": "sidebar side aside widget widget-area related rail secondary right-column recommended popular trending more-stories",
    "notice": "notice cookie-notice cookie-banner consent gdpr alert newsletter subscribe popup modal paywall message privacy-notice banner-notice",
    "advert": "ad ads advert advertisement sponsor sponsored promo adsbygoogle ad-slot banner-ad promotion",
    "form": "form search login contact-form search-form signup subscribe-form",
    "comments": "comments comment comment-list discussion replies responses reader-comments disqus thread reactions",
    "share": "share social share-bar author-box tags meta post-meta related-links",
}
SAYINGS = {
    "menu": "Home|About|About us|Contact|News|Blog|Products|Services|Sitemap|Archive|Accueil|Startseite|Inicio|Login|Sign in|Help|FAQ|Shop|Sports|World",
    "header": "The Daily|Welcome to our site|My blog|Search|Menu|Skip to content|Your source of news|Today|Log in|Subscribe",
    "footer": "© 2024|All rights reserved.|Privacy policy|Terms of use|Impressum|Powered by|Contact us|Copyright|Follow us|Back to top|Mentions légales|Datenschutz|Aviso legal",
    "sidebar": "Related articles|Most read|Popular posts|Recent posts|Categories|Tags|Archives|You may also like|Read more|Trending now|Editor's picks|See also",
    "notice": "This site uses cookies.|We use cookies to improve your experience.|Accept all|Subscribe to our newsletter|Sign up now|Got it|Manage preferences|Please enable JavaScript|You have read all free articles this month.|Wir verwenden Cookies.|Nous utilisons des cookies.",
    "advert": "Advertisement|Sponsored|Buy now|Special offer|Ad|Limited time offer, save today!|Anzeige|Publicité|Shop now|Promoted|Click here",
    "form": "Name|Email|Your message|Send|Submit|Search|Leave a comment|Post comment|Password|Remember me|Website",
    "comments": "Comments|Reply|Leave a reply|Like|Report|says:|Posted by|wrote:|2 replies|Kommentare|Commentaires|Comentarios|Show more comments",
    "share": "Share|Tweet|Share this|Facebook|Tags:|Filed under|Written by|Print|Email this|Follow the author|Share on social media",
}
_TAGS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "notice": "div", "advert": "div", "form": "form", "comments": "section", "share": "div", "article": "article"}


class Layout:
    """Random pages whose article is known: elements carry data-y="1" where they are main text, "0" elsewhere."""

    def __init__(self, words: list[list[str]], seed: int):
        self.r, self.pools = random.Random(seed), words or [["text", "words", "here"]]

    def page(self) -> str:
        r = self.r
        self.words = r.choice(self.pools)
        self.naming = r.choice(["both", "both", "names", "names", "tags", "tags", "few"])
        self.prefix = r.choice(["", "", "", "site-", "my", "c-", "theme_"])
        self.pages_sayings = r.random() < 0.8
        inner = self.article()
        for _ in range(r.choice([0, 0, 1, 2])):
            inner = self.element("div", None, inner)
        top = self.some(["header", "menu", "notice", "advert", "share", "form"], r.choice([0, 1, 2, 3, 4]))
        bottom = self.some(["comments", "advert", "notice", "sidebar", "form", "share"], r.choice([0, 0, 1, 2, 3]))
        if r.random() < 0.8:
            bottom.append(self.part("footer"))
        if r.random() < 0.3:
            bottom += self.some(["notice", "advert", "sidebar", "menu"], 1)
        middle = [inner]
        if r.random() < 0.5:
            middle.insert(r.choice([0, 1]), self.part("sidebar"))
        if r.random() < 0.35:
            wrap = r.choice(["main", "div", "section", "td"])
            middle = [self.element(wrap, r.choice([None, None, "article"]), "".join(middle))]
            if wrap == "td":
                middle = ["<table><tr>", *middle, "</tr></table>"]
        body = "".join([*top, *middle, *bottom])
        if r.random() < 0.3:
            body = self.element("div", r.choice([None, "article"]) if r.random() < 0.3 else None, body, name=r.choice(["wrapper", "container", "page", "root", "app"]))
        return f'<html><head><title>{self.saying(8)}</title></head><body data-y="0">{body}</body></html>'

    def some(self, kinds: list[str], n: int) -> list[str]:
        return [self.part(k) for k in self.r.sample(kinds, min(n, len(kinds)))]

    def element(self, tag: str, kind: str | None, inner: str, name: str | None = None, label: str | None = None) -> str:
        r, told = self.r, ""
        if kind and self.naming in ("both", "names") and r.random() < 0.9:
            name = r.choice(NAMES[kind].split())
        if name and self.naming != "few":
            told = f' {r.choice(["class", "class", "id"])}="{self.prefix}{name}{r.choice(["", "", "-1", " block", " col"])}"'
        if label is not None:
            told += f' data-y="{label}"'
        return f"<{tag}{told}>{inner}</{tag}>"

    def saying(self, most: int) -> str:
        r = self.r
        return " ".join(r.choice(self.words) for _ in range(r.randint(1, most))).capitalize()

    def prose(self, most: int = 90) -> str:
        r, out = self.r, []
        left = int(r.expovariate(2.5 / most)) + r.choice([1, 1, 3, 8])
        while left > 0:
            n = min(left, r.randint(1, 18))
            start = r.randrange(max(1, len(self.words) - n))
            s = " ".join(self.words[start : start + n])
            out.append(s[:1].upper() + s[1:] + r.choice([".", ".", ".", "", "?", "!"]))
            left -= n
        text = escape(" ".join(out))
        if r.random() < 0.25:
            text = text.replace(" ", r.choice([" <b>", " <i>", " <a href='#'>", "<br>"]), 1) + r.choice(["</b>", "</a>", ""])
        return text

    def short(self, kind: str) -> str:
        r = self.r
        if self.pages_sayings and r.random() < 0.6:
            return escape(r.choice(SAYINGS[kind].split("|")))
        return escape(self.saying(5))

    def article(self) -> str:
        r, out = self.r, []
        if r.random() < 0.85:
            head = f"<h{r.choice([1, 1, 1, 2])}>{self.saying(14)}</h1>"
            out.append(f"<header>{head}</header>" if r.random() < 0.15 else head)
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14, 25])):
            what = r.random()
            if what < 0.72:
                text = self.prose()
                out.append(r.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<div>{text}</div>"]))
            elif what < 0.8:
                out.append(f"<h{r.choice([2, 3])}>{self.saying(8)}</h3>")
            elif what < 0.87:
                items = "".join(f"<li>{self.prose(15)}{r.choice(['</li>', ''])}" for _ in range(r.randint(1, 6)))
                out.append(r.choice([f"<ul>{items}</ul>", f"<ol>{items}</ol>"]))
            elif what < 0.91:
                out.append(f"<blockquote><p>{self.prose(30)}</p></blockquote>")
            elif what < 0.94:
                out.append(f"<figure><img src=x><figcaption>{self.prose(12)}</figcaption></figure>")
            elif what < 0.97:
                rows = "".join("<tr>" + "".join(f"<td>{self.saying(3)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4)))
                out.append(f"<table>{rows}</table>")
            else:
                out.append(f"<pre>{self.prose(20)}</pre>")
        for kind, odds in (("advert", 0.3), ("advert", 0.15), ("share", 0.25), ("notice", 0.18), ("sidebar", 0.18), ("form", 0.1), ("comments", 0.2), ("menu", 0.05), ("footer", 0.05)):
            if r.random() < odds:
                last = kind in ("comments", "footer", "share") and r.random() < 0.8
                out.insert(len(out) if last else r.randint(0, len(out)), self.part(kind))
        tag = "article" if self.naming in ("both", "tags") and r.random() < 0.85 else r.choice(["div", "div", "section", "main"])
        return self.element(tag, "article", "".join(out), label="1")

    def part(self, kind: str) -> str:
        r = self.r
        tag = _TAGS[kind] if self.naming in ("both", "tags") or r.random() < 0.3 else r.choice(["div", "div", "section", "ul" if kind == "menu" else "div"])
        if kind in ("menu",):
            links = [f"<a href='/{k}'>{self.short(kind)}</a>" for k in range(r.randint(2, 9))]
            inner = r.choice([lambda: "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>", lambda: " | ".join(links), lambda: "".join(f"<li>{x}" for x in links)])()
        elif kind == "header":
            inner = f"{r.choice(['<h1>', '<div>', '<p>', '<span>'])}{self.short(kind)}</h1>" + (self.part("menu") if r.random() < 0.4 else "") + (f"<p>{self.short(kind)}</p>" if r.random() < 0.4 else "")
        elif kind == "footer":
            lines = [r.choice([self.short(kind), "&copy; " + self.saying(3) + " &middot; " + self.saying(12) + ".", self.prose(20), f"<a href=#>{self.short(kind)}</a>"]) for _ in range(r.randint(1, 4))]
            inner = r.choice(["<br>", " &middot; ", "</p><p>"]).join(lines)
            inner += self.part("menu") if r.random() < 0.2 else ""
        elif kind == "sidebar":
            links = "".join(f"<li><a href='/x{k}'>{self.saying(9)}</a></li>" for k in range(r.randint(1, 8)))
            inner = r.choice(["<h2>", "<h3>", "<p>", "<div>"]) + self.short(kind) + "</h3>" + r.choice([f"<ul>{links}</ul>", f"<p>{self.prose(40)}</p>", f"<ul>{links}</ul><p>{self.prose(20)}</p>"])
        elif kind in ("notice", "advert", "share"):
            inner = r.choice([self.short(kind), f"<p>{self.short(kind)} {self.prose(25)}</p>", self.prose(15), f"{self.short(kind)} <a href=#>{self.short(kind)}</a><button>{self.short(kind)}</button>", f"<p>{self.prose(30)}</p>"])
        elif kind == "form":
            fields = "".join(f"<label>{self.short(kind)}</label><input name=a>" for _ in range(r.randint(1, 4)))
            options = "<select>" + "".join(f"<option>{self.saying(2)}" for _ in range(3)) + "</select>" if r.random() < 0.3 else ""
            inner = (f"<p>{self.prose(12)}</p>" if r.random() < 0.4 else "") + fields + options + f"<button>{self.short(kind)}</button>"
        else:  # comments
            entries = []
            for _ in range(r.randint(1, 7)):
                by = r.choice([f"<b>{self.saying(2)}</b> ", f"<div>{self.saying(2)}</div>", f"<h4>{self.saying(2)} {r.choice(SAYINGS[kind].split('|'))}</h4>", ""])
                entries.append(r.choice([f"<li>{by}<p>{self.prose(50)}</p></li>", f"<div>{by}<p>{self.prose(60)}</p></div>", f"<p>{by}{self.prose(50)}</p>"]))
            inner = (r.choice(["<h2>", "<h3>", "<div>"]) + self.short(kind) + "</h3>" if r.random() < 0.7 else "") + "".join(entries) + (self.part("form") if r.random() < 0.3 else "")
            if r.random() < 0.25:  # each entry by itself
                inner = "".join(self.element(r.choice(["article", "div", "section"]), "comments", e) for e in entries)
        return self.element(tag, kind, inner, label="0")


def training_pages(words: list[list[str]], n: int, seed: int) -> list[list[Block]]:
    layout = Layout(words, seed)
    return [blocks(layout.page(), mark="data-y") for _ in range(n)]


@lru_cache(maxsize=4)
def _fitted(pools: tuple[str, ...], n: int, epochs: int) -> dict[str, np.ndarray]:
    return trained(training_pages([p.split() for p in pools if p.split()], n, 11), epochs=epochs)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """The network, trained on layouts filled with words of POOL_PAGES pages of this table.

    Ids whose hashes end low enough for about four times as many pages are looked at, so that a partition of a large
    table sends the driver next to nothing.
    """
    html = F.substring(F.coalesce(F.col(html_col), F.lit("")), 1, POOL_CHARS).alias("html")
    order = F.xxhash64(F.col(id_col).cast("string"))
    share = min(1.0, 4 * POOL_PAGES / max(1, pages.count()))
    some = pages.filter(F.pmod(order, F.lit(1 << 40)) < int(share * (1 << 40)))
    found = some.select(order.alias("h"), html).orderBy("h", "html").limit(POOL_PAGES).collect()
    return _fitted(tuple(" ".join(b.text for b in blocks(r.html)) for r in found), train_pages, epochs)


# --- main text -----------------------------------------------------------------------------------


def labelled(pages: DataFrame, network: dict, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, text, blocks): a page's main text, and all its blocks as (text, score) in page order."""
    shared = pages.sparkSession.sparkContext.broadcast(network)
    kinds = [*[pages.schema[c] for c in (id_col, *keep)]]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", text string, blocks array<struct<text:string,score:double>>"
    block = pa.list_(pa.struct([("text", pa.string()), ("score", pa.float64())]))

    def label(batches):
        network = shared.value
        for batch in batches:
            found = [blocks(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            told = scores(network, found)
            text = pa.array([" ".join(b.text for b, s in zip(page, ss) if s >= 0.5) for page, ss in zip(found, told)], pa.string())
            rows = pa.array([[{"text": b.text, "score": float(s)} for b, s in zip(page, ss)] for page, ss in zip(found, told)], block)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], text, rows], names=[*batch.schema.names[:-1], "text", "blocks"])

    return bounded(pages.select(id_col, *keep, html_col)).mapInArrow(label, schema)


def main_text(pages: DataFrame, network: dict, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, text): each page's main text, empty if it has none."""
    shared = pages.sparkSession.sparkContext.broadcast(network)
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_col, *keep)) + ", text string"

    def extract(batches):
        network = shared.value
        for batch in batches:
            found = [blocks(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            text = [" ".join(b.text for b, s in zip(page, ss) if s >= 0.5) for page, ss in zip(found, scores(network, found))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(text, pa.string())], names=[*batch.schema.names[:-1], "text"])

    return bounded(pages.select(id_col, *keep, html_col)).mapInArrow(extract, schema)


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = main_text(pages, fit(pages), keep=("url",))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
