"""HTML extraction (operator 4): a linear-chain CRF over leaf blocks of the DOM.

A tolerant scan of the markup gives leaf blocks: runs of text between block-level
tags, with the tags and class or id words of their ancestors. White space inside
a block, line-break tags included, is one space. A conditional random field labels
the blocks of a page as main text or not: features are ancestor tags, groups of
class and id words, and the text's length, links and punctuation; transitions tie
neighbours. It is trained by gradient ascent on the likelihood of labelled pages
and decoded by Viterbi. The labelled pages are made by rule here (no labelled web
pages come with this repository): layouts with all kinds of page furniture around
and inside of articles.

A null or empty page has the empty text. Pages of any size are read whole.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docweave.llm.common import bounded_batches

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea xmp iframe noembed noframes template noscript".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("thead",), "tbody": ("thead", "tbody")}
SCOPE = frozenset("table ul ol dl article section div body nav aside main footer header form".split())
#: Words of classes and ids, by what they stand for.
WORDS = {
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner adsense dfp",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toolbar skip toc links",
    "side": "sidebar side aside widget widgets rail related recommended recommendation popular trending more",
    "frame": "header masthead footer foot topbar bottombar copyright legal branding logo",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription paywall warning message",
    "social": "share sharing social follow facebook twitter",
    "comment": "comment comments commentlist reply replies respond disqus discussion reader readers",
    "form": "form search login signup signin register input button contact",
    "meta": "meta tags tag byline author date timestamp info category categories",
    "content": "article content post entry main story body text page single maincontent articlebody blog",
}
_GROUP = {w: g for g, ws in WORDS.items() for w in ws.split()}
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def groups_of(attributes: str) -> frozenset[str]:
    out = set()
    for m in _ATTR.finditer(attributes):
        for w in _WORD.findall(m[2] or m[3] or m[4] or ""):
            g = _GROUP.get(w.lower())
            if g:
                out.add(g)
    return frozenset(out)


def blocks(html: str) -> list[tuple[tuple[str, ...], frozenset[str], str, int]]:
    """(ancestor tags, groups of their class and id words, text, characters inside links) of each leaf block in order."""
    out: list = []
    stack: list[tuple[str, frozenset[str]]] = []
    held: list[str] = []
    where: list = [(), frozenset()]
    links = [0]
    pos, n = 0, len(html)

    def text(s: str) -> None:
        if s and not s.isspace():
            if not held or all(h.isspace() for h in held):
                where[0] = tuple(t for t, _ in stack if t not in INLINE)
                where[1] = frozenset().union(*(g for _, g in stack))
            s = unescape(s)
            if any(t == "a" for t, _ in stack):
                links[0] += len(s.strip())
            held.append(s)
        elif s:
            held.append(" ")

    def flush() -> None:
        if held:
            line = " ".join("".join(held).split())
            if line:
                out.append((where[0], where[1], line, links[0]))
            held.clear()
        links[0] = 0

    while pos < n:
        at = html.find("<", pos)
        if at < 0:
            text(html[pos:])
            break
        if html.startswith("<!--", at):
            text(html[pos:at])
            end = html.find("-->", at + 4)
            pos = n if end < 0 else end + 3
            continue
        m = _TAG.match(html, at) or _LOOSE_TAG.match(html, at)
        if m is None:
            if html[at + 1 : at + 2] in ("!", "?") or html[at + 1 : at + 2].isalpha() or html.startswith("</", at):
                text(html[pos:at])
                end = html.find(">", at)
                pos = n if end < 0 else end + 1
            else:  # a lone less-than sign
                text(html[pos : at + 1])
                pos = at + 1
            continue
        text(html[pos:at])
        pos = m.end()
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if tag in RAW and not closing:
            if tag not in ("noscript", "template", "script", "style"):
                flush()
            end = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(html, pos)
            close = html.find(">", end.end() - 1) if end else -1
            pos = n if close < 0 else close + 1
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if tag in CLOSES_P or tag in SAME:
            ends = SAME.get(tag, ("p",))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] in SCOPE:
                    break
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append((tag, groups_of(attributes) if "=" in attributes else frozenset()))
    flush()
    return out


_TAGS = ("nav", "header", "footer", "aside", "form", "article", "main", "section", "ul", "ol", "li", "table", "figure", "figcaption", "blockquote", "pre", "head", "title", "p", "div", "dialog", "menu", "address", "button", "select", "h1", "h2", "h3")
_NAMES = ["bias", *(f"in {t}" for t in _TAGS), *(f"near {t}" for t in ("p", "div", "li", "td")), *(f"word {g}" for g in WORDS), "no content element", "furniture", "short", "long", "no end mark", "links", "all links", "copyright", "first", "last"]
_AT = {n: k for k, n in enumerate(_NAMES)}
_TAG_AT = {t: _AT[f"in {t}"] for t in _TAGS}
_NEAR_AT = {t: _AT[f"near {t}"] for t in ("p", "div", "li", "td")}
_WORD_AT = {g: _AT[f"word {g}"] for g in WORDS}
_CONTENT = {"article", "main"}
_FURNITURE_TAGS = {"nav", "aside", "form", "footer", "dialog", "menu", "select", "button"}
_FURNITURE_WORDS = set(WORDS) - {"content", "meta"}
_COPY = re.compile(r"©|\(c\) |all rights reserved|copyright", re.IGNORECASE)


def features(found: list) -> list[list[int]]:
    """Numbers of the features that hold for each block."""
    out = []
    for k, (tags, groups, line, links) in enumerate(found):
        f = {0}
        f.update(_TAG_AT[t] for t in tags if t in _TAG_AT)
        if tags and tags[-1] in _NEAR_AT:
            f.add(_NEAR_AT[tags[-1]])
        f.update(_WORD_AT[g] for g in groups)
        if not _CONTENT.intersection(tags) and "content" not in groups:
            f.add(_AT["no content element"])
        if _FURNITURE_TAGS.intersection(tags) or _FURNITURE_WORDS.intersection(groups):
            f.add(_AT["furniture"])
        if len(line) < 40:
            f.add(_AT["short"])
        elif len(line) > 120:
            f.add(_AT["long"])
        if line[-1] not in ".!?:;\"'”»)":
            f.add(_AT["no end mark"])
        if links:
            f.add(_AT["links"])
            if 10 * links >= 9 * len(line):
                f.add(_AT["all links"])
        if len(line) < 200 and _COPY.search(line):
            f.add(_AT["copyright"])
        if k == 0:
            f.add(_AT["first"])
        if k == len(found) - 1:
            f.add(_AT["last"])
        out.append(sorted(f))
    return out


class Crf:
    """Two labels: 1 is main text. weights: features x 1 (in favour of label 1); moves: label before x label."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights.tolist(), moves.tolist()

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The likeliest labels (Viterbi)."""
        w, ((m00, m01), (m10, m11)) = self.weights, self.moves
        a, b, back = 0.0, 0.0, []
        for k, f in enumerate(rows):
            score = sum(w[i] for i in f)
            if k == 0:
                a, b = 0.0, score
                continue
            to0, to1 = (a + m00 >= b + m10), (a + m01 >= b + m11)
            back.append((0 if to0 else 1, 0 if to1 else 1))
            a, b = (a + m00 if to0 else b + m10), (a + m01 if to1 else b + m11) + score
        if not rows:
            return []
        out = [1 if b > a else 0]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def fit(pages: list[tuple[list[list[int]], list[int]]], rounds: int = 200, ridge: float = 3e-4) -> Crf:
    """Gradient ascent (with per-weight step sizes) on the mean log likelihood of labelled pages."""
    d = len(_NAMES)
    theta, grads = np.zeros(d + 4), np.full(d + 4, 1e-8)
    longest = max(len(y) for _, y in pages)
    n = len(pages)
    x = np.zeros((n, longest, d))
    y = np.full((n, longest), -1)
    for p, (rows, labels) in enumerate(pages):
        for t, f in enumerate(rows):
            x[p, t, f] = 1
        y[p, : len(labels)] = labels
    real = y >= 0
    size = real.sum(1)
    for _ in range(rounds):
        w, moves = theta[:d], theta[d:].reshape(2, 2)
        s = np.stack([np.zeros((n, longest)), x @ w], 2)
        fore = np.zeros((n, longest, 2))
        fore[:, 0] = s[:, 0]
        for t in range(1, longest):
            fore[:, t] = np.logaddexp.reduce(fore[:, t - 1, :, None] + moves, axis=1) + s[:, t]
        rear = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (s[:, t + 1] + rear[:, t + 1])[:, None, :], axis=2)
            rear[:, t] = np.where(real[:, t + 1, None], step, 0)
        total = np.logaddexp.reduce(fore[np.arange(n), size - 1], axis=1)
        one = np.exp(fore[:, :, 1] + rear[:, :, 1] - total[:, None]) * real
        g = np.zeros(d + 4)
        g[:d] = np.einsum("ptd,pt->d", x, np.where(real, y, 0) - one)
        both = real[:, 1:]
        pair = np.exp(fore[:, :-1, :, None] + moves + (s + rear)[:, 1:, None, :] - total[:, None, None, None]) * both[:, :, None, None]
        for a in (0, 1):
            for b in (0, 1):
                g[d + 2 * a + b] = ((y[:, :-1] == a) & (y[:, 1:] == b)).sum() - pair[:, :, a, b].sum()
        g = g / n - ridge * theta
        grads += g * g
        theta += 0.5 * g / np.sqrt(grads)
    return Crf(theta[:d], theta[d:].reshape(2, 2))


def labelled_pages(n: int = 400, seed: int = 5) -> list[tuple[str, list[int]]]:
    """Pages made by rule with the label of each of their leaf blocks."""
    rng = random.Random(seed)
    pick = rng.choice

    def words(a: int, b: int) -> str:
        return " ".join("".join(pick("aeiourstnlmdkpbg") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(a, b)))

    def sentence(short: bool = False) -> str:
        line = " ".join(words(4, 18).capitalize() + pick("...!?") for _ in range(1 if short else rng.randint(1, 7)))
        return line if rng.random() < 0.7 else line.upper() if rng.random() < 0.3 else line.rstrip(".!?")

    def wrap(tag: str, names: tuple[str, ...], inner: str, always: bool = False) -> str:
        key = pick(("class", "class", "id"))
        return f'<{tag} {key}="{pick(names)}">{inner}</{tag}>' if always or rng.random() < 0.6 else f"<{tag}>{inner}</{tag}>"

    def listed(k: int) -> tuple[str, int]:
        return "<ul>" + "".join(f'<li><a href="/{words(1, 1)}">{words(1, 3)}</a></li>' for _ in range(k)) + "</ul>", k

    def furniture(kind: str) -> tuple[str, int]:
        names = tuple(WORDS[kind].split())
        if kind == "menu":
            inner, k = listed(rng.randint(2, 8))
            return (wrap("nav", names, inner) if rng.random() < 0.7 else wrap(pick(("div", "ul")), names, inner, True)), k
        if kind == "side":
            inner, k = listed(rng.randint(1, 5))
            if rng.random() < 0.6:
                inner, k = f"<h3>{words(1, 4)}</h3>" + inner, k + 1
            if rng.random() < 0.4:
                inner, k = inner + f"<p>{sentence()}</p>", k + 1
            return (wrap("aside", names, inner) if rng.random() < 0.6 else wrap("div", names, inner, True)), k
        if kind == "frame":
            tag = pick(("header", "footer", "div"))
            line = f"&copy; {words(1, 3)} &middot; {words(2, 8)}." if rng.random() < 0.5 else words(1, 9)
            return wrap(tag, ("header", "masthead", "topbar") if tag == "header" else ("footer", "copyright", "legal"), f"<p>{line}</p>" if rng.random() < 0.4 else line, tag == "div"), 1
        if kind == "comment":
            k = rng.randint(1, 4)
            inner = "".join(f"<div class='comment'><p>{sentence()}</p></div>" if rng.random() < 0.5 else f"<p>{sentence()}</p>" for _ in range(k))
            if rng.random() < 0.5:
                inner, k = f"<h3>{words(1, 2)}</h3>" + inner, k + 1
            return wrap(pick(("div", "section")), names, inner, True), k
        if kind == "form":
            return f"<form class='{pick(names)}'><p>{words(1, 3)}</p><input name=q><button>{words(1, 2)}</button></form>", 2
        if kind == "advert" and rng.random() < 0.3:
            return wrap(pick(("div", "aside", "section")), names, f"<p>{sentence()}</p>", True), 1
        inner = sentence(rng.random() < 0.6)
        return wrap(pick(("div", "section", "aside") if kind == "notice" else ("div",)), names, inner, True), 1

    def article() -> tuple[str, list[int]]:
        html, y = "", []
        for k in range(rng.randint(1, 9)):
            kind = rng.random()
            if k == 0 and rng.random() < 0.8 or kind < 0.08:
                html, y = html + (f"<h{1 if k == 0 else 2}>{words(2, 9)}</h{1 if k == 0 else 2}>"), [*y, 1]
            elif kind < 0.14:
                m = rng.randint(1, 4)
                html, y = html + "<ul>" + "".join(f"<li>{words(3, 14)}</li>" for _ in range(m)) + "</ul>", y + [1] * m
            elif kind < 0.2:
                html, y = html + f"<blockquote>{sentence()}</blockquote>", [*y, 1]
            elif kind < 0.24:
                tag = pick(("div", "section", "pre", "figure", "address", "ol"))
                inner = f"<h3>{words(1, 5)}</h3><p>{sentence()}</p>" if tag in ("div", "section") and rng.random() < 0.6 else f"<li>{words(2, 9)}</li><li>{words(2, 9)}</li>" if tag == "ol" else sentence()
                html, y = html + f"<{tag}>{inner}</{tag}>", y + [1] * max(1, inner.count("<li>") or inner.count("</"))
            elif kind < 0.27:
                m = rng.randint(1, 3)
                html, y = html + "<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 6)}</td></tr>" for _ in range(m)) + "</table>", y + [1] * 2 * m
            elif kind < 0.35:
                piece, m = furniture(pick(("advert", "social", "side", "comment", "notice")))
                html, y = html + piece, y + [0] * m
            else:
                body = sentence()
                if rng.random() < 0.3:
                    body = f"<b>{body}<br>"
                html, y = html + f"<p>{body}" + ("</p>" if rng.random() < 0.8 else ""), [*y, 1]
        return html, y

    out = []
    while len(out) < n:
        html, y = f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{}}</style></head><body>", [0]
        for _ in range(rng.randint(0, 4)):
            piece, m = furniture(pick(("menu", "menu", "frame", "advert", "notice", "form", "social")))
            html, y = html + piece, y + [0] * m
        inner, labels = article()
        shell = rng.random()
        if shell < 0.55:
            html += f"<article>{inner}</article>"
        elif shell < 0.75:
            html += f"<main>{inner}</main>"
        else:
            html += wrap("div", tuple(WORDS["content"].split()), inner, True)
        y = y + labels
        for _ in range(rng.randint(0, 4)):
            piece, m = furniture(pick(("side", "comment", "comment", "frame", "frame", "advert", "social", "notice", "menu")))
            html, y = html + piece, y + [0] * m
        html += "</body></html>" if rng.random() < 0.9 else ""
        if len(blocks(html)) == len(y):  # broken nesting may join blocks; such pages can't be labelled by rule
            out.append((html, y))
    return out


_TRAINED: dict[tuple[int, int], Crf] = {}


def train(n: int = 400, seed: int = 5) -> Crf:
    if (n, seed) not in _TRAINED:
        _TRAINED[n, seed] = fit([(features(blocks(h)), y) for h, y in labelled_pages(n, seed)])
    return _TRAINED[n, seed]


def main_text(html: str, crf: Crf) -> str:
    found = blocks(html)
    return "\n".join(b[2] for b, y in zip(found, crf.decode(features(found)), strict=True) if y)


def extract(df: DataFrame, crf: Crf | None = None, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """(columns of keep, text): the main text of each whole page; a row in, a row out."""
    bounded_batches(df.sparkSession)
    crf = crf or train()
    types = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py() or "", crf) for v in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "text"])

    return df.select(*keep, html_col).mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", text string")
