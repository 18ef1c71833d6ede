"""Leaf blocks of a web page: what is read as one run of text, with the elements it stands in.

A block ends where a block-level element begins or ends. Elements that are never read (head, scripts, styles,
templates and the like) are left out with all they hold; missing end tags are implied as browsers do for
paragraphs, list items, cells and options. The scan is linear in the page's length, however broken it is.

An element is told by tokens: its tag, its tag with its parent's, and the words of its class, id, role and label. A
block's path is the set of the tokens of all elements it stands in, so depth costs nothing where nothing new comes.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape
from zlib import crc32

#: Tokens of paths and of leaves are hashed to so many slots.
SLOTS = 2048

_NAMES = "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul"
BLOCKS = frozenset(_NAMES.split())
UNREAD = frozenset("head script style template noscript svg iframe object canvas audio video title noembed noframes textarea datalist".split())
#: Unread elements whose content is no markup.
RAW = frozenset("script style iframe title noembed noframes textarea noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("base link meta title style script noscript template".split())
#: tag -> (what it closes, where the search for it ends).
IMPLIED = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tr": ("tr", "table"),
    "tbody": ("tbody thead tfoot", "table"), "thead": ("tbody thead tfoot", "table"), "tfoot": ("tbody thead tfoot", "table"), "option": ("option", "select"),
}
IMPLIED = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)\s*(=)?\s*")
_BARE = re.compile(r"[^\s>]*")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Attributes whose words tell what an element is.
TOLD = ("class", "id", "role", "aria-label", "itemprop")


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[int, ...]  # slots of the elements' tokens, and of the leaf's
    linked: float  # share of its characters in links
    tag: str
    label: str | None = None


def slot(token: str) -> int:
    return crc32(token.encode()) % SLOTS


class _Element:
    __slots__ = ("tag", "path", "leaf", "label")

    def __init__(self, tag, path, leaf, label):
        self.tag, self.path, self.leaf, self.label = tag, path, leaf, label


def _tag(html: str, at: int, missing: dict[str, int]) -> tuple[dict[str, str], int]:
    """Attributes of the tag whose name ends at `at`, and where the tag ends."""
    found: dict[str, str] = {}
    size = len(html)
    while at < size:
        m = _ATTR.match(html, at)
        if not m:
            end = html.find(">", at)
            return found, size if end < 0 else end + 1
        name, at, value = m[1].lower(), m.end(), ""
        if m[2]:
            quote = html[at : at + 1]
            if quote in ('"', "'") and quote:
                end = html.find(quote, at + 1) if missing.get(quote, size) > at else -1
                if end < 0:
                    missing[quote] = min(missing.get(quote, size), at)
                    return found, size
                value, at = html[at + 1 : end], end + 1
            else:
                m = _BARE.match(html, at)
                value, at = m[0], m.end()
        if name not in found:
            found[name] = value
    return found, size


def blocks(html: str | None, mark: str | None = None) -> list[Block]:
    """The page's leaf blocks with text, in order; mark names an attribute that labels what it holds (for training)."""
    if not html:
        return []
    out: list[Block] = []
    root = _Element("", frozenset(), "", None)
    stack = [root]
    raw: list[str] = []
    linked = total = 0
    link = 0  # depth of the stack at which a link was opened, 0 if none
    unread = None  # element whose content is left out
    depth = 0  # of unread elements of this name in each other
    size, at, missing = len(html), 0, {}
    bang = -1  # next place of a comment's other end
    open_tags: Counter[str] = Counter()
    memo: dict[tuple, _Element] = {}

    def flush():
        nonlocal linked, total
        text = " ".join("".join(raw).split())
        if text:
            e = stack[-1]
            out.append(Block(text, (*sorted(e.path), slot("leaf " + e.leaf)), linked / max(1, total), e.tag, e.label))
        raw.clear()
        linked = total = 0

    def opened(tag, attrs):
        parent = stack[-1]
        told = tuple(attrs.get(k, "") for k in TOLD)
        hidden = "hidden" in attrs or "none" in attrs.get("style", "")
        label = attrs.get(mark, parent.label) if mark else None
        key = (id(parent), tag, told, hidden, label)
        if (e := memo.get(key)) is None:
            names = sorted({w.lower() for v in told if v for w in _WORDS.findall(v)})
            tokens = [f"tag {tag}", f"in {parent.tag} {tag}", *(f"name {w}" for w in names), *(["hidden"] if hidden else [])]
            new = frozenset(map(slot, tokens))
            path = parent.path if new <= parent.path else parent.path | new
            e = memo[key] = _Element(tag, path, f"{tag} {parent.tag}", label)
        stack.append(e)
        open_tags[tag] += 1

    def closed() -> str:
        tag = stack.pop().tag
        open_tags[tag] -= 1
        return tag

    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            lt = size
        if unread == "head" and html[at:lt].strip():
            unread = None
        if unread is None and lt > at:
            text = html[at:lt]
            if "&" in text:
                text = unescape(text)
            raw.append(text)
            total += len(text)
            if link:
                linked += len(text)
        if lt == size:
            break
        at = lt + 1
        c = html[at : at + 1]
        if c == "!":
            if html.startswith("--", at + 1):
                if html.startswith((">", "->"), at + 3):
                    at = html.find(">", at) + 1
                else:
                    if bang < at + 3:
                        bang = html.find("--!>", at + 3)
                        bang = size if bang < 0 else bang
                    end = html.find("-->", at + 3)
                    end = min(bang, size if end < 0 else end)
                    at = size if end == size else html.find(">", end) + 1
            else:
                end = html.find(">", at)
                at = size if end < 0 else end + 1
            continue
        closing = c == "/"
        m = _NAME.match(html, at + closing)
        if not m:
            if closing or c == "?":
                end = html.find(">", at)
                at = size if end < 0 else end + 1
            elif unread is None:
                raw.append("<")
                total += 1
            continue
        tag = m[0].lower()
        attrs, at = _tag(html, m.end(), missing)
        if unread is not None:
            if tag == unread:
                depth += -1 if closing else 1
                if depth and tag != "head":
                    continue
                unread = None if closing else unread
                continue
            if unread != "head" or closing or tag in HEAD:
                if not closing and tag in RAW:
                    at = _after(html, at, tag)
                continue
            unread = None
        if not closing and tag in UNREAD:
            if tag in RAW:
                at = _after(html, at, tag)
            else:
                unread, depth = tag, 1
            continue
        if tag == "br":
            raw.append(" ")
            continue
        if tag == "a":
            link = 0 if closing else len(stack)
            continue
        if tag == "hr":
            flush()
            continue
        if tag in VOID or (tag not in BLOCKS and "-" not in tag):
            continue
        flush()
        if closing:
            if open_tags[tag]:
                while closed() != tag:
                    pass
        else:
            if stack[-1].tag == "p":
                closed()
            if tag in IMPLIED:
                closes, until = IMPLIED[tag]
                if any(open_tags[t] for t in closes):
                    k = len(stack) - 1
                    while stack[k].tag not in until and stack[k].tag not in closes:
                        k -= 1
                    if stack[k].tag in closes:
                        while len(stack) > k:
                            closed()
            opened(tag, attrs)
        if link > len(stack):
            link = 0
    flush()
    return out


def _after(html: str, at: int, tag: str) -> int:
    """Where the content of a raw element that begins at `at` has ended, with its end tag."""
    m = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
    if not m:
        return len(html)
    end = html.find(">", m.end())
    return len(html) if end < 0 else end + 1
