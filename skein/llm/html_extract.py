"""Main-text extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: the text between two block-level tags, with the elements it stands
in. Scripts, styles, comments and other markup never become text. Each block has features of its
ancestors (tag names, words of class, id and role) and of its text (length, share of
link text, end mark, signs), and the field gives every block a label, main text or
not, by the features and by the label before it. It is trained by gradient ascent on labelled pages
(``labelled_pages``: laid out from templates, every block's label known); the best labels are
found by Viterbi. Feature weights are a table of fixed size; pages are mapped one by one.

Defined results: a null, empty or text-less page has an empty text; repeated rows are
extracted again; an empty table stays empty; columns beside the html are passed through. White
space is what str.split() takes for it; a page's text is the main blocks joined by one space.
"""

from __future__ import annotations

import html as _html
import random
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skein.llm.batches import small_batches, text_slices, texts_of

FEATURES = 1 << 13  # hashed features
TRAINING_PAGES, STEPS, RATE, DECAY = 400, 250, 0.1, 1e-3

# Elements inside a line, empty elements, elements whose content is no text or no markup.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark math mfrac mi mn mo mrow ms msqrt msub "
                   "msup mtext object q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template iframe noembed noframes svg".split())
PLAIN = frozenset("title textarea xmp plaintext".split())
# An open element of these ends when one of the same group starts.
IMPLIED_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
               "option": {"option"}, "p": {"p"}}
_SCOPE = frozenset("ul ol dl table body article section div main aside nav header footer form blockquote select fieldset".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_EDGE = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_NAME_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # features of the elements it stands in; empty where they are weighed instead
    links: int  # characters of link text
    score: float = 0.0  # weights of the elements it stands in


class _Scanner:
    """Text, tags and comments of a page in one pass: what is consumed is not looked at again.

    A ``<`` that begins no tag is text, as is everything behind the last ``>``. In a start tag, ``>`` between quotes doesn't end it; if
    quotes run to the end of the page, this tag and all later ones end at their first ``>``."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.quotes = True

    def end_of_tag(self, at: int) -> int:
        """Place of the ``>`` that ends a start tag."""
        if self.quotes:
            page, j = self.page, at
            while (m := _EDGE.search(page, j)) is not None:
                if m[0] == ">":
                    return m.start()
                close = page.find(m[0], m.end())
                if close < 0:
                    break
                j = close + 1
            self.quotes = False  # the one time that a scan to the end was for nothing
        return self.page.find(">", at)

    def next(self, at: int) -> tuple[int, int, str, str, str]:
        """(begin, end, kind, name, attributes) of the next tag or comment from ``at``; kind is "open", "close", "none" or "" at the end."""
        page = self.page
        while True:
            at = page.find("<", at)
            if at < 0:
                return len(page), len(page), "", "", ""
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, len(page) if end < 0 else end + 3, "none", "", ""
            if at < self.last:
                after = page[at + 1:at + 2]
                if after in ("!", "?"):
                    return at, page.find(">", at) + 1, "none", "", ""
                if after == "/" and (m := _NAME.match(page, at + 2)):
                    return at, page.find(">", m.end()) + 1, "close", m[0].lower(), ""
                if m := _NAME.match(page, at + 1):
                    end = self.end_of_tag(m.end())
                    if end >= 0:
                        return at, end + 1, "open", m[0].lower(), page[m.end():end]
            at += 1  # no tag: it is text


class _Open:
    """The open elements: where each tag stands, the nearest scope, and the features that hold, each counted once."""

    def __init__(self, weight=None):
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.at: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.held: dict[str, int] = {}
        self.weight = weight
        self.score = 0.0
        self.links = 0

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag in _SCOPE:
            self.scopes.append(len(self.stack))
        self.stack.append((tag, names))
        self.links += tag == "a"
        for x in names:
            self.held[x] = self.held.get(x, 0) + 1
            if self.held[x] == 1 and self.weight:
                self.score += self.weight(x)

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, names = self.stack.pop()
            self.at[tag].pop()
            if tag in _SCOPE:
                self.scopes.pop()
            self.links -= tag == "a"
            for x in names:
                self.held[x] -= 1
                if not self.held[x]:
                    del self.held[x]
                    if self.weight:
                        self.score -= self.weight(x)
        if not self.held:
            self.score = 0.0  # what rounding has left

    def depth_of(self, names, scoped: bool) -> int:
        """The innermost open element of ``names``, with ``scoped`` inside the nearest scope only; -1 if there is none."""
        d = max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)
        return d if not scoped or not self.scopes or d >= self.scopes[-1] else -1


def leaf_blocks(page: str, weight=None) -> list[Block]:
    """The leaf blocks of a page, in page order, without empty ones. With ``weight`` (of a feature) blocks hold the sum of
    their elements' weights, kept up as elements open and close, and no path."""
    out: list[Block] = []
    scan, tree = _Scanner(page), _Open(weight)
    parts: list[str] = []
    linked = 0
    low: str | None = None

    def block(raw: str, links: int, more: str = ""):
        text = " ".join(_html.unescape(raw).split())
        if text:
            extra = more and more not in tree.held
            if weight:
                out.append(Block(text, (), links, tree.score + (weight(more) if extra else 0.0)))
            else:
                out.append(Block(text, (*tree.held, more) if extra else tuple(tree.held), links))

    def flush():
        nonlocal linked
        if parts:
            block("".join(parts), linked)
            parts.clear()
            linked = 0

    def add(raw: str):
        nonlocal linked
        if raw:
            parts.append(raw)
            if tree.links:
                linked += len(raw)

    at, n = 0, len(page)
    while at < n:
        begin, end, kind, tag, attributes = scan.next(at)
        add(page[at:begin])
        at = end
        if kind == "close":
            if tag not in INLINE:
                flush()
            d = tree.depth_of((tag,), tag in INLINE or tag in IMPLIED_END)
            if d >= 0:
                tree.pop_to(d)
        elif kind == "open":
            if tag in HIDDEN or tag in PLAIN:
                flush()
                if attributes.endswith("/") and tag == "svg":
                    continue
                low = page.lower() if low is None else low
                stop = low.find("</" + tag, at) if len(low) == n else page.find("</" + tag, at)
                inside = page[at:n if stop < 0 else stop]
                close = page.find(">", stop) if stop >= 0 else -1
                at = n if close < 0 else close + 1
                if tag in PLAIN:
                    block(inside, 0, "in:" + tag)
                continue
            if tag not in INLINE:
                flush()
                p = tree.depth_of(("p",), True)  # a block ends an open paragraph
                if p >= 0:
                    tree.pop_to(p)
            if tag in IMPLIED_END and (d := tree.depth_of(IMPLIED_END[tag], True)) >= 0:
                tree.pop_to(d)
            if tag == "br":
                add(" ")
            if tag in EMPTY or attributes.endswith("/"):
                continue
            names = ["in:" + tag]
            for m in _ATTRIBUTE.finditer(attributes):
                names += ["is:" + w for w in _NAME_WORD.findall((m[2] or m[3] or m[4] or "").lower())]
            tree.push(tag, tuple(dict.fromkeys(names)))
    flush()
    return out


@lru_cache(maxsize=1 << 15)
def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


def _text_names(b: Block) -> list[str]:
    n, text = len(b.text), b.text
    names = ["one", f"long:{min(n.bit_length(), 9)}", f"links:{min(4, 4 * b.links // max(n, 1))}", f"end:{text[-1] if text[-1] in '.!?:' else '-'}"]
    if "©" in text or "(c)" in text.lower():
        names.append("copyright")
    if "|" in text or "»" in text or "·" in text:
        names.append("bar")
    return names


def block_features(blocks: list[Block]) -> list[list[int]]:
    """Hashed features of each block of a page."""
    return [[_slot(x) for x in dict.fromkeys([*b.path, *_text_names(b)])] for b in blocks]


@dataclass
class Field:
    """Weights of the field: ``weight[f]`` of main text against not, ``step[a, b]`` of label b after a."""

    weight: np.ndarray
    step: np.ndarray

    def labels(self, features: list[list[int]]) -> list[int]:
        """The most likely labels, by Viterbi."""
        w = self.weight
        return self.best([sum(w[f] for f in fs) for fs in features])

    def best(self, scores: list[float]) -> list[int]:
        """The most likely labels of blocks with these scores of main text."""
        if not scores:
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        back, a, b = [], 0.0, scores[0]
        for e in scores[1:]:
            zero, one = (a + s00, b + s10), (a + s01, b + s11)
            back.append((zero[1] > zero[0], one[1] > one[0]))
            a, b = max(zero), max(one) + e
        out = [int(b > a)]
        for came in reversed(back):
            out.append(int(came[out[-1]]))
        return out[::-1]


def train_field(pages: list[tuple[list[list[int]], list[int]]]) -> Field:
    """Maximises the conditional log-likelihood of the labelled pages (features, labels)."""
    longest, count = max(len(y) for _, y in pages), len(pages)
    y = np.zeros((count, longest), int)
    real = np.zeros((count, longest), bool)
    at_page, at_place, at_feature = [], [], []
    for p, (fs, labels) in enumerate(pages):
        y[p, :len(labels)] = labels
        real[p, :len(labels)] = True
        for t, f in enumerate(fs):
            at_page += [p] * len(f)
            at_place += [t] * len(f)
            at_feature += f
    flat = np.array(at_page) * longest + np.array(at_place)
    feature = np.array(at_feature)
    weight, step = np.zeros(FEATURES), np.zeros((2, 2))
    params = [weight, step]
    m, v = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    seen = np.zeros((2, 2))
    pairs = real[:, 1:]
    np.add.at(seen, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    log_add = np.logaddexp.reduce
    for it in range(1, STEPS + 1):
        emit = np.zeros((count, longest, 2))
        emit[..., 1] = np.bincount(flat, weight[feature], count * longest).reshape(count, longest)
        fore, back = np.zeros_like(emit), np.zeros_like(emit)
        fore[:, 0] = emit[:, 0]
        for t in range(1, longest):
            go = log_add(fore[:, t - 1, :, None] + step, axis=1) + emit[:, t]
            fore[:, t] = np.where(real[:, t, None], go, fore[:, t - 1])
        total = log_add(fore[:, -1], axis=1)
        expected = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            nxt = (emit[:, t + 1] + back[:, t + 1])[:, None, :] + step
            live = real[:, t + 1]
            back[:, t] = np.where(live[:, None], log_add(nxt, axis=2), 0)
            expected += np.exp(fore[live, t, :, None] + nxt[live] - total[live, None, None]).sum(0)
        p_main = np.exp(fore[..., 1] + back[..., 1] - total[:, None])
        gap = np.where(real, y - p_main, 0).ravel()
        grads = [np.bincount(feature, gap[flat], FEATURES) / count - DECAY * weight, (seen - expected) / count - DECAY * step]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            params[i] += RATE * (m[i] / (1 - 0.9**it)) / (np.sqrt(v[i] / (1 - 0.99**it)) + 1e-8)
    return Field(weight, step)


def labelled_pages(count: int = TRAINING_PAGES, seed: int = 11) -> list[tuple[str, list[tuple[str, int]]]]:
    """Training pages laid out from templates: (html, [(block text, 1 if main text)])."""
    rng = random.Random(seed)
    syllables = "ka lo mi ter an do re sil vo ne pra tu es gri on ble".split()
    pick = rng.choice

    def words(a: int, b: int) -> str:
        text = " ".join("".join(pick(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(a, b + 1)))
        return text[0].upper() + text[1:]

    def sentence(a: int, b: int) -> str:
        return words(a, b) + pick([".", ".", ".", "!", "?", ""])

    def page() -> tuple[str, list[tuple[str, int]]]:
        body: list[str] = []
        labels: list[tuple[str, int]] = []

        def block(tag: str, text: str, main: int, attrs: str = "", inner: str = "{}") -> str:
            labels.append((text, main))
            end = "" if tag == "p" and rng.random() < 0.15 else f"</{tag}>"
            return f"<{tag}{attrs}>{inner.format(text)}{end}"

        def named(kind: str) -> str:
            return rng.choice([f' class="{kind}"', f' id="{kind}"', f' class="{kind} box"', f' class="site-{kind}"', f' class="{kind}-{pick(["wrap", "inner", "list"])}"'])

        def group(tags: list[str], kinds: list[str], inside, plain_ok: bool = True):
            tag = pick(tags)
            body.append(f"<{tag}{named(pick(kinds)) if tag == 'div' or rng.random() < 0.5 or not plain_ok else ''}>")
            inside()
            body.append(f"</{tag}>")

        def lines(a, b, x, y, tag="p"):
            def go():
                for _ in range(rng.randrange(a, b + 1)):
                    body.append(block(tag, sentence(x, y), 0))
            return go

        def menu():
            def go():
                body.append("<ul>")
                for _ in range(rng.randrange(2, 8)):
                    body.append(block("li", words(1, 2), 0, "", '<a href="/x">{}</a>'))
                body.append("</ul>")
            group(["nav", "nav", "div"], ["menu", "nav", "navigation", "navbar", "breadcrumb", "breadcrumbs"], go)

        def head():
            def go():
                body.append(block(pick(["h1", "div", "p"]), words(1, 4), 0))
                if rng.random() < 0.4:
                    body.append(block("p", sentence(3, 9), 0))
            group(["header", "header", "div"], ["header", "masthead", "banner", "topbar", "logo"], go)

        def notice():
            group(["div", "section", "p"], ["notice", "cookie", "cookies", "consent", "alert", "warning", "popup", "newsletter"],
                  lambda: body.append(block("span", sentence(4, 25), 0)), False)

        def advert():
            if rng.random() < 0.5:  # text right in the element
                body.append(block("div", sentence(3, 25), 0, named(pick(["ad", "ads", "advert", "advertisement", "sponsored", "promo"]))))
            else:
                group(["div", "aside", "section"], ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion"], lines(1, 2, 3, 25), False)

        def aside():
            group(["aside", "aside", "div"], ["sidebar", "aside", "related", "widget", "social", "share", "recommended"], lines(1, 4, 2, 20))

        def form():
            def go():
                body.append(block("label", words(1, 3), 0))
                body.append('<input type="text">')
                body.append(block("button", words(1, 2), 0))
            group(["form"], ["search", "subscribe", "login", "form", "contact"], go)

        def comments():
            group(["section", "div", "ol"], ["comments", "comment", "responses", "replies", "discussion", "respond"], lines(1, 5, 4, 40), False)

        def foot():
            def go():
                text = "© " + words(1, 5) + pick([" · ", " | ", " "]) + sentence(2, 12)
                labels.append((text, 0))
                body.append(text.replace("©", pick(["&copy;", "©"])).replace("·", "&middot;"))
            group(["footer", "footer", "div"], ["footer", "copyright", "legal", "bottom"], go)

        def article():
            wrap = pick(["article", "article", "article", "article", "main", "div", "section", ""])
            body.append(f"<{wrap}{named(pick(['article', 'content', 'post', 'entry', 'story', 'main', 'text'])) if wrap == 'div' or rng.random() < 0.25 else ''}>" if wrap else "")
            if rng.random() < 0.85:
                body.append(block(pick(["h1", "h1", "h2"]), words(1, 10), 1))
            for _ in range(rng.randrange(1, 9)):
                kind = rng.random()
                text = sentence(1, 60) if rng.random() < 0.8 else words(1, 4) + pick([".", ""])
                if kind < 0.75:
                    body.append(block("p", text, 1, "", pick(["{}", "{}", "{}", "<b>{}<br>", "<em>{}</em>", '<a href="/y">{}</a>'])))
                elif kind < 0.85:
                    body.append(f"<ul>{block('li', text, 1)}{block('li', sentence(1, 9), 1)}</ul>")
                elif kind < 0.92:
                    body.append(block(pick(["blockquote", "h2", "h3", "pre"]), text, 1))
                else:
                    body.append(f"<table><tr>{block('td', words(1, 4), 1)}{block('td', words(1, 4), 1)}</tr></table>")
                if rng.random() < 0.06:
                    pick([advert, aside, notice, form])()
            if rng.random() < 0.08:
                comments()
            body.append(f"</{wrap}>" if wrap else "")

        if rng.random() < 0.9:
            labels.append((title := words(2, 8), 0))
            body.append(f"<head><title>{title}</title><style>p{{margin:0}}</style></head><body>")
        for part, chance in ((notice, 0.25), (head, 0.4), (menu, 0.75), (form, 0.2), (advert, 0.5), (aside, 0.15)):
            if rng.random() < chance:
                part()
        article()
        for part, chance in ((comments, 0.35), (form, 0.15), (aside, 0.4), (advert, 0.25), (menu, 0.15), (foot, 0.8), (notice, 0.1)):
            if rng.random() < chance:
                part()
        return "<!DOCTYPE html><html>" + "".join(body) + "</body></html>", labels

    return [page() for _ in range(count)]


def train(pages: list[tuple[str, list[tuple[str, int]]]] | None = None) -> Field:
    """The field, from labelled pages; each block gets the label of its text, in order."""
    data = []
    for page, said in labelled_pages() if pages is None else pages:
        blocks, left, labels = leaf_blocks(page), list(said), []
        for b in blocks:
            k = next((k for k, (text, _) in enumerate(left) if text == b.text), None)
            labels.append(0 if k is None else left.pop(k)[1])
        if blocks:
            data.append((block_features(blocks), labels))
    return train_field(data)


def extract(page: str, field: Field) -> str:
    """The main text of one page."""
    weight = lambda name: field.weight[_slot(name)]
    blocks = leaf_blocks(page, weight)
    scores = [b.score + sum(map(weight, _text_names(b))) for b in blocks]
    return " ".join(b.text for b, y in zip(blocks, field.best(scores)) if y)


def extract_pages(df: DataFrame, field: Field, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` without its html column, with the main text of each page. A map over rows: no shuffle."""
    keep = [f for f in df.schema.fields if f.name not in (html, out)]
    names = [f.name for f in keep]
    spark: SparkSession = df.sparkSession
    small = Field(field.weight, field.step)
    field_of = spark.sparkContext.broadcast(small)  # FEATURES + 4 numbers

    def run(batches):
        model = Field(field_of.value.weight.tolist(), field_of.value.step)
        for batch in batches:
            for rows, data, offs in text_slices(batch, html):
                cols = [rows.column(rows.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([extract(p, model) for p in texts_of(data, offs)], pa.string())], names=[*names, out])

    return small_batches(df).select(*names, html).mapInArrow(run, T.StructType([*keep, T.StructField(out, T.StringType(), False)]))
