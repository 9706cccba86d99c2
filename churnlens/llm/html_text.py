"""Operator 4: main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks: stretches of text between block-level tags,
each with its chain of ancestors. The field has two labels (main text, rest);
a block's features are its ancestors' tags and class, id and role words, the
ones nearest to it once more with their place, and features of its text
(length, punctuation, share of text in links, place in the page). The label
of a block also depends on its neighbours' through transition weights. The
weights are fitted by gradient ascent on the conditional likelihood of
labelled pages and a page is decoded by Viterbi.

``labelled_pages`` makes the training pages from a page grammar: layouts and
page furniture of many kinds, each block with its label. ``fit_crf`` takes any
labelled pages. The weights (some thousand numbers, fixed by the training
pages) are broadcast; extraction is a narrow map over whole pages.

Defined cases: null or empty html gives an empty text, as does a page without
main text; character references are decoded; a line break is white space
inside its block; text of script, style, template, title and comments is no
text (that of formulas, drawings and objects is); tags left open end with
their parent; repeated rows are judged alike; an empty table gives no rows;
ties of the two labels go to the rest; very long or deep pages cost time in
proportion; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import pieces, table, whole_text

BLOCK_TAGS = frozenset("""address article aside blockquote body button center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript
    ol option optgroup p pre section select summary table tbody td textarea tfoot th thead tr ul label""".split())
SILENT_TAGS = frozenset("script style template title".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag on the left ends an open element on the right.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}


class Block:
    """A stretch of text; ``path`` is the sum of its ancestors' weights, or their names where no weights are given."""
    __slots__ = ("path", "text", "linked")

    def __init__(self, path, text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


class _Blocks(HTMLParser):
    """Leaf blocks of a page, in page order.

    What is known of the open elements is carried along as they open and
    close: where each tag is open, which are blocks, and which names occur
    among them. So no tag and no block looks through the stack, however deep.
    """

    def __init__(self, weights: dict[str, float] | None = None):
        super().__init__(convert_charrefs=True)
        self.weights = weights
        self.blocks: list[Block] = []
        #: (tag, words, names that this element brought, weight of all names before it)
        self.stack: list[tuple[str, tuple, list[str], float]] = []
        self.places: dict[str, list[int]] = {}
        self.open_blocks: list[int] = []
        self.names: dict[str, int] = {}
        self.weight = 0.0
        self.near: dict[tuple, float] = {}
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0
        self.silent = 0

    def _path(self):
        near = tuple(self.stack[at][:2] for at in self.open_blocks[-3:])
        if self.weights is None:
            return [*self.names, *_near_features(near)]
        found = self.near.get(near)
        if found is None:
            found = self.near[near] = sum(self.weights.get(f, 0.0) for f in _near_features(near))
        return self.weight + found

    def _end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(self._path(), text, self.linked))
            self.parts, self.linked = [], 0

    def _push(self, tag: str, words: tuple) -> None:
        brought, before = [], self.weight
        for name in _element_features(tag, words):
            if name not in self.names:
                self.names[name] = len(self.stack)
                brought.append(name)
                if self.weights is not None:
                    self.weight += self.weights.get(name, 0.0)
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK_TAGS:
            self.open_blocks.append(len(self.stack))
        self.stack.append((tag, words, brought, before))
        self.links += tag == "a"
        self.silent += tag in SILENT_TAGS

    def _pop(self, to: int) -> None:
        while len(self.stack) > to:
            tag, _, brought, self.weight = self.stack.pop()
            for name in brought:
                del self.names[name]
            self.places[tag].pop()
            if tag in BLOCK_TAGS:
                self.open_blocks.pop()
            self.links -= tag == "a"
            self.silent -= tag in SILENT_TAGS

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self._end_block()
            # a new block ends an open paragraph, and some elements their like, if that is the nearest open block
            if self.open_blocks:
                name = self.stack[self.open_blocks[-1]][0]
                if name == "p" or name in CLOSES.get(tag, ()):
                    self._pop(self.open_blocks[-1])
        elif tag == "br":
            self.parts.append(" ")
        if tag not in VOID_TAGS:
            self._push(tag, _words(attrs))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and tag in ("svg", "math", "object", "template"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self._end_block()
        places = self.places.get(tag)
        # an inline end tag doesn't reach beyond its block
        if places and (tag in BLOCK_TAGS or not self.open_blocks or places[-1] > self.open_blocks[-1]):
            self._pop(places[-1])

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _words(attrs) -> tuple:
    """Lower-case words of class, id and role, and marks of hidden elements."""
    found = []
    for name, value in attrs:
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            found += [w.lower() for w in _WORD.findall(value or "")]
        elif name == "hidden" or (name == "style" and value and re.search(r"display:\s*none", value)):
            found.append("hidden")
    return tuple(found)


def blocks_of(html: str, weights: dict[str, float] | None = None) -> list[Block]:
    parser = _Blocks(weights)
    parser.feed(html)
    parser.close()
    parser._end_block()
    return parser.blocks


def _element_features(tag: str, words: tuple) -> set[str]:
    """Names of an element that stands anywhere among a block's ancestors."""
    return {"a:" + tag, *("w:" + w for w in words), *("s:" + w[:4] for w in words)}


def _near_features(blocks: tuple) -> list[str]:
    """Names of the nearest three blocks with their place, from within."""
    names = set()
    for place, (tag, words) in enumerate(reversed(blocks)):
        names.add(f"{place}:{tag}")
        for w in words:
            names.add(f"{place}:w:{w}")
            names.add(f"{place}:s:{w[:4]}")
    return sorted(names)


def _text_features(block: Block, at: int, n: int) -> list[str]:
    text = block.text
    size, words = len(text), text.count(" ") + 1
    links = block.linked / size
    return ["bias",
            f"len:{min(9, size.bit_length())}", f"words:{min(7, words.bit_length())}",
            f"link:{0 if links == 0 else 1 if links < .3 else 2 if links < .8 else 3}",
            f"stop:{text[-1] if text[-1] in '.!?:,' else 'no'}",
            f"marks:{min(4, sum(map(text.count, '.,;')))}",
            f"begin:{'upper' if text[0].isupper() else 'digit' if text[0].isdigit() else 'other'}",
            "copyright" if "©" in text else "plain",
            f"from_top:{min(at, 4)}", f"from_end:{min(n - 1 - at, 4)}"]


def features(blocks: list[Block]) -> list[list[str]]:
    n = len(blocks)
    return [b.path + _text_features(b, i, n) for i, b in enumerate(blocks)]


class Crf:
    """Weights of the label "main" per feature, of the four transitions and of the first label."""

    def __init__(self, weights: dict[str, float], transitions: np.ndarray, first: float):
        self.weights, self.transitions, self.first = weights, transitions, first

    def emissions(self, blocks: list[Block]) -> list[float]:
        get, n = self.weights.get, len(blocks)

        def path(found) -> float:
            return found if isinstance(found, float) else sum(get(f, 0.0) for f in found)
        return [path(b.path) + sum(get(f, 0.0) for f in _text_features(b, i, n)) for i, b in enumerate(blocks)]

    def decode(self, emissions: list[float]) -> list[bool]:
        """The most likely labels (Viterbi); the rest wins a tie."""
        if not emissions:
            return []
        (rr, rm), (mr, mm) = self.transitions.tolist()
        rest, main = 0.0, self.first + emissions[0]
        back = []
        for e in emissions[1:]:
            from_r, from_m = rest + rr >= main + mr, rest + rm >= main + mm
            back.append((not from_r, not from_m))
            rest, main = max(rest + rr, main + mr), max(rest + rm, main + mm) + e
        label = main > rest
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    def main_text(self, html: str) -> str:
        blocks = blocks_of(html, self.weights)
        keep = self.decode(self.emissions(blocks))
        return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def fit_crf(pages: Iterable[tuple[list[list[str]], list[bool]]], rounds: int = 200, rate: float = 0.1,
            penalty: float = 0.002) -> Crf:
    """Maximum penalised conditional likelihood by Adam; forward-backward runs over all pages at once."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    length = max(len(x) for x, _ in pages)
    cell, feat = [], []
    y = np.zeros((length, len(pages)))
    here = np.zeros((length, len(pages)), bool)
    for j, (blocks, labels) in enumerate(pages):
        for i, (found, label) in enumerate(zip(blocks, labels)):
            y[i, j], here[i, j] = label, True
            for f in found:
                cell.append(i * len(pages) + j)
                feat.append(names.setdefault(f, len(names)))
    cell, feat = np.array(cell), np.array(feat)
    total = here.sum()
    w = np.zeros(len(names) + 5)  # features, four transitions, first label
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    yi = y.astype(int)
    both = here[1:]
    seen_pairs = np.array([np.sum(both & (yi[:-1] == a) & (yi[1:] == b)) for a in (0, 1) for b in (0, 1)])
    for step in range(1, rounds + 1):
        e = np.bincount(cell, weights=w[feat], minlength=y.size).reshape(y.shape)
        t = w[-5:-1].reshape(2, 2)
        score = np.stack([np.zeros_like(e), e], axis=2)
        score[0, :, 1] += w[-1]
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        alpha[0] = score[0]
        for i in range(1, length):
            a = np.logaddexp(alpha[i - 1, :, 0, None] + t[0], alpha[i - 1, :, 1, None] + t[1]) + score[i]
            alpha[i] = np.where(here[i][:, None], a, alpha[i - 1])
        for i in range(length - 2, -1, -1):
            nxt = score[i + 1] + beta[i + 1]
            b = np.logaddexp(t[:, 0] + nxt[:, 0, None], t[:, 1] + nxt[:, 1, None])
            beta[i] = np.where(here[i + 1][:, None], b, beta[i])
        z = np.logaddexp(alpha[-1, :, 0], alpha[-1, :, 1])
        main = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z)
        grad = np.zeros_like(w)
        off = np.where(here, y - main, 0.0)
        grad[:-5] = np.bincount(feat, weights=off.ravel()[cell], minlength=len(names))
        pair = (alpha[:-1, :, :, None] + t + (score + beta)[1:, :, None, :] - z[None, :, None, None])
        grad[-5:-1] = seen_pairs - (np.exp(np.minimum(pair, 0.0)) * both[:, :, None, None]).sum((0, 1)).ravel()
        grad[-1] = off[0].sum()
        grad = grad / total - penalty * w
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad ** 2
        w += rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return Crf({f: float(w[k]) for f, k in names.items()}, w[-5:-1].reshape(2, 2).copy(), float(w[-1]))


# --- labelled pages from a page grammar -----------------------------------------------------------------------------

#: Class and id words of page parts, as sites use them.
CONTENT = "content post entry article story main body text copy page prose markdown detail single blog news".split()
FURNITURE = {
    "nav": "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs pagination pager toc links".split(),
    "header": "header masthead banner top topbar site brand logo hero".split(),
    "footer": "footer bottom copyright legal colophon credits".split(),
    "aside": "sidebar side aside widget rail related recommended popular trending teaser secondary column".split(),
    "ad": "ad ads advert advertisement sponsored sponsor promo promotion adsbox banner commercial partner".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay message newsletter subscribe signup "
              "paywall privacy announcement toast".split(),
    "form": "form search login signin contact register poll survey".split(),
    "comments": "comments comment discussion replies reply respond disqus responses feedback reader readers".split(),
    "share": "share social sharing tags tag meta byline author toolbar buttons actions follow".split(),
}


class _Grammar:
    """One random page: html and the labels of its blocks, in page order."""

    def __init__(self, rnd: random.Random):
        self.rnd, self.out, self.labels = rnd, [], []
        self.style = rnd.random()

    def word(self) -> str:
        r = self.rnd
        return "".join(r.choice("bcdfglmnprstvw") + r.choice("aeiouäéó") for _ in range(r.randint(1, 4)))

    def phrase(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.rnd.randint(lo, hi))).capitalize()

    def sentences(self, lo: int, hi: int) -> str:
        mark = self.rnd.choice
        return " ".join(self.phrase(3, 16) + (mark([",", ""]) and ", " + self.phrase(2, 8).lower()) + mark("....!?")
                        for _ in range(self.rnd.randint(lo, hi)))

    def block(self, tag: str, inner: str, main: bool, attrs: str = "", close: bool = True) -> None:
        self.out.append(f"<{tag}{attrs}>{inner}" + (f"</{tag}>" if close else ""))
        self.labels.append(main)

    def inline(self, text: str) -> str:
        r = self.rnd
        if r.random() < .3:
            words = text.split(" ")
            at = r.randrange(len(words))
            tag = r.choice(['a href="/x"', "b", "i", "em", "strong", "span", "code"])
            words[at] = f"<{tag}>{words[at]}</{tag.split()[0]}>"
            text = " ".join(words)
        if r.random() < .1:
            text = text.replace(". ", ".<br>", 1)
        return text.replace("é", "&eacute;") if r.random() < .1 else text

    def named(self, words: list[str]) -> str:
        r = self.rnd
        name = r.choice(words)
        if r.random() < .5:
            name = name + r.choice(["-", "_", " "]) + r.choice(
                ["box", "wrap", "wrapper", "container", "inner", "area", "block", "item", "list", "section", "bar",
                 r.choice(words), self.word()])
        return f' {r.choice(["class", "class", "class", "id"])}="{name}"'

    def article(self) -> None:
        r = self.rnd
        tag, attrs = r.choice([("article", ""), ("article", ""), ("article", self.named(CONTENT)), ("main", ""), ("div", self.named(CONTENT)),
                               ("div", self.named(CONTENT)), ("section", self.named(CONTENT)), ("div", ""), ("td", "")])
        outer = r.choice(["", "<main>", "<div>", f"<div{self.named(CONTENT)}>"])
        if tag == "td":
            outer = "<table><tr>"
        self.out.append(outer + f"<{tag}{attrs}>")
        if r.random() < .85:
            wrap = r.random() < .2
            self.out.append("<header>" if wrap else "")
            self.block("h1", self.phrase(3, 10), True)
            self.out.append("</header>" if wrap else "")
        if r.random() < .3:
            self.furniture("share")
        closed = r.random() < .7
        for _ in range(r.choice([0, 1, 2, 3, 5, 8, 12, 20])):
            kind = r.random()
            if kind < .72:
                text = self.sentences(1, r.choice([1, 2, 4, 7]))
                odd = r.random()
                if odd < .15:
                    text = self.phrase(1, 4) + r.choice([".", ""])
                elif odd < .25:  # lists set as running text, text without marks, one word again and again
                    words = [self.word() for _ in range(r.randint(1, 30))]
                    text = r.choice([" | ", " ", ", "]).join(words if r.random() < .7 else words[:1] * len(words))
                self.block("p", ("<b>" if not closed and r.random() < .2 else "") + self.inline(text), True, close=closed)
            elif kind < .80:
                self.block(r.choice(["h2", "h3", "h4"]), self.phrase(1, 7), True)
            elif kind < .86:
                self.out.append(r.choice(["<ul>", "<ol>"]))
                for _ in range(r.randint(2, 5)):
                    self.block("li", self.inline(r.choice([self.phrase(2, 8), self.sentences(1, 1)])), True, close=closed)
                self.out.append("</ul>")
            elif kind < .89:
                self.block("blockquote", self.sentences(1, 2), True)
            elif kind < .91:
                self.block("pre", self.sentences(1, 3), True)
            elif kind < .93:
                self.out.append('<figure><img src="a.png">')
                self.block("figcaption", self.phrase(3, 9), True)
                self.out.append("</figure>")
            elif kind < .95:
                self.out.append("<table>")
                for _ in range(r.randint(1, 3)):
                    self.out.append("<tr>")
                    for _ in range(2):
                        self.block("td", self.phrase(1, 4), True)
                    self.out.append("</tr>")
                self.out.append("</table>")
            else:
                self.furniture(r.choice(["ad", "share", "aside", "notice", "ad", "form"]))
        inside = r.random() < .2
        if inside and r.random() < .6:
            self.furniture(r.choice(["comments", "share", "aside", "form", "notice"]))
        if not closed:
            self.out.append("</p>")
        self.out.append(f"</{tag}>" + ("</tr></table>" if tag == "td" else "</main>" if outer == "<main>" else
                                      "</div>" if outer else ""))

    def furniture(self, kind: str) -> None:
        r = self.rnd
        native = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        tag = native if native and r.random() < .6 else r.choice(["div", "div", "div", "section", "ul" if kind == "nav" else "div"])
        attrs = self.named(FURNITURE[kind]) if tag != native or r.random() < .4 else ""
        if kind == "nav" and r.random() < .2:
            attrs += ' role="navigation"'
        self.out.append(f"<{tag}{attrs}>")

        def links(lo: int, hi: int) -> None:
            listed = r.random() < .7 or tag == "ul"
            self.out.append("<ul>" if listed and tag != "ul" else "")
            if listed:
                for _ in range(r.randint(lo, hi)):
                    self.block("li", f'<a href="/{self.word()}">{self.phrase(1, 4)}</a>', False)
            else:
                self.block("div" if r.random() < .5 else "p",
                           " | ".join(f'<a href="#">{self.phrase(1, 2)}</a>' for _ in range(r.randint(lo, hi))), False)
            self.out.append("</ul>" if listed and tag != "ul" else "")

        if kind == "nav":
            links(2, 8)
        elif kind == "header":
            self.block(r.choice(["div", "h1", "h2", "p", "span"][:4]), self.phrase(1, 4), False)
            if r.random() < .4:
                self.block("p", self.phrase(3, 9), False)
            if r.random() < .4:
                links(2, 6)
        elif kind == "footer":
            if r.random() < .5:
                links(2, 6)
            self.block(r.choice(["p", "div"]), r.choice(["&copy; ", "© 2024 ", "Copyright ", ""]) + r.choice(
                [self.phrase(1, 6), self.sentences(1, 2)]), False)
        elif kind == "aside":
            self.block(r.choice(["h2", "h3", "h4", "p"]), self.phrase(1, 4), False)
            if r.random() < .6:
                links(2, 6)
            if r.random() < .6:
                for _ in range(r.randint(1, 3)):
                    self.block("p", self.sentences(1, 2), False)
        elif kind == "ad":
            for _ in range(r.randint(1, 2)):
                self.block(r.choice(["p", "div", "a", "span"][:2]), r.choice([self.phrase(1, 8), self.sentences(1, 2)]), False)
        elif kind == "notice":
            self.block(r.choice(["p", "div"]), self.sentences(1, 2), False)
            if r.random() < .5:
                self.block("button", self.phrase(1, 2), False)
        elif kind == "form":
            if r.random() < .4:
                self.block("p", self.sentences(1, 1), False)
            for _ in range(r.randint(1, 3)):
                self.block("label", self.phrase(1, 4), False)
                self.out.append('<input type="text">')
            if r.random() < .3:
                self.out.append("<select>")
                for _ in range(3):
                    self.block("option", self.phrase(1, 2), False)
                self.out.append("</select>")
            self.block("button", self.phrase(1, 2), False)
        elif kind == "comments":
            self.block(r.choice(["h2", "h3"]), self.phrase(1, 3), False)
            inner, each = r.choice([("div", "div"), ("ol", "li"), ("ul", "li"), ("section", "article")])
            self.out.append(f"<{inner}>")
            for _ in range(r.randint(1, 6)):
                self.out.append(f'<{each}{self.named(FURNITURE["comments"])}>' if r.random() < .7 else f"<{each}>")
                if r.random() < .6:
                    self.block(r.choice(["div", "h4", "p"]), self.phrase(1, 3), False)
                for _ in range(r.randint(1, 2)):
                    self.block("p", self.sentences(1, 3), False)
                self.out.append(f"</{each}>")
            self.out.append(f"</{inner}>")
        else:
            self.block(r.choice(["div", "p", "span"][:2]), r.choice([self.phrase(1, 5), f'<a href="#">{self.phrase(1, 2)}</a>']), False)
        self.out.append(f"</{tag}>")

    def page(self) -> tuple[str, list[bool]]:
        r = self.rnd
        self.out.append('<!DOCTYPE html><html><head><meta charset="utf-8"><title>x</title><style>p{margin:0}</style>'
                        '<script>var t="</p>";</script></head><body>')
        for kind, share in (("notice", .25), ("header", .5), ("nav", .7), ("ad", .4), ("form", .15), ("aside", .15),
                            ("notice", .1)):
            if r.random() < share:
                self.furniture(kind)
        wrapped = r.random() < .4
        self.out.append(f'<div{r.choice([self.named(["wrapper", "container", "page", "site", "layout"]), ""])}>' if wrapped else "")
        self.article()
        after = ["comments", "aside", "share", "ad", "form", "notice", "nav"]
        r.shuffle(after)
        for kind in after[:r.randint(0, 4)]:
            self.furniture(kind)
        self.out.append("</div>" if wrapped else "")
        if r.random() < .85:
            if r.random() < .4:
                self.block("footer", f"&copy; {self.phrase(1, 3)} &middot; {self.sentences(1, 1)}", False)
            else:
                self.furniture("footer")
        self.out.append("</body></html>" if r.random() < .9 else "")
        return "".join(self.out), self.labels


def labelled_pages(n: int = 500, seed: int = 11) -> list[tuple[str, list[bool]]]:
    """``n`` pages, each with the label of every block (True: main text)."""
    rnd = random.Random(seed)
    return [_Grammar(rnd).page() for _ in range(n)]


def trained(n: int = 500, seed: int = 11) -> Crf:
    """The field fitted to ``n`` labelled pages."""
    pages = []
    for html, labels in labelled_pages(n, seed):
        blocks = blocks_of(html)
        if len(blocks) != len(labels):
            raise AssertionError("a labelled page doesn't match its blocks")
        pages.append((features(blocks), labels))
    return fit_crf(pages)


def extract_main_text(pages: DataFrame, model: Crf | None = None, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for batch in pieces(batches, 2):
            texts = [crf.main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        whole_text(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4_html_text(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
