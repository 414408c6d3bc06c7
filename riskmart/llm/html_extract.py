"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks in page order: the text between two block-level tags, with the path of
open elements (tags, classes, ids, roles). A bidirectional LSTM, written and trained in numpy, reads the
blocks of a whole page and says for each whether it belongs to the article, so that a block is judged by
what stands before and after it too. Scripts, styles and other elements without readable text never
become blocks.

*Features* of a block: its path, hashed into ``PATH`` places; its words, hashed into ``WORDS`` places;
its length, share of linked characters, punctuation, and place on the page.

*Training.* No table labels blocks, so labels come from two places. Pages of a bounded sample (``SAMPLE``
pages of at most ``SAMPLE_BYTES`` bytes) that mark their article by an element of HTML 5 label their own
blocks. And blocks of that sample are put together again into pages of other layouts (class names instead
of elements; menus, side bars, notices, adverts, forms and reader comments before, after and inside the
article), labelled by where they were put. Every page is then labelled whole, with nothing cut.

Defined cases: null or empty html gives an empty text; broken markup never fails and costs linear time: unclosed
elements end with their parent and a stray ``<`` is text. What has no readable text (``svg``, ``object``,
``select`` and the like) is left out up to its end tag; if that does not come before the parent's end, the
tag counts for nothing and the text stays. ``math`` is text. A comment, script or style that never ends hides
the rest, as in browsers; other raw text that never ends is read. Without any usable page in the sample the
model learns from layouts filled with a few built-in words; null ids and urls come back; repeated rows each
come back; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import cached, lowest, only, tidy

SAMPLE = 300
SAMPLE_BYTES = 100_000
SYNTHETIC = 900
PATH, WORDS, NUMBERS = 96, 48, 8
FEATURES = PATH + WORDS + NUMBERS
HIDDEN = 12
EPOCHS = 14
BATCH = 48
STREAM = 256

# A tag holds no ``<`` outside quotes, so that a stray one costs no more than the way to the next.
_TAG = re.compile(
    r"<!--|<![^<>]*>|<\?[^<>]*>|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*+|[^<>]*)>", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_RAW = frozenset("script style textarea title iframe".split())  # without markup up to their end tag
_UNREADABLE = frozenset("template noscript svg object canvas audio video select".split())  # nothing to read up to their end tag
_BREAKS = frozenset("script style template noscript title textarea iframe".split())  # part the text around them
DEPTH = 512  # deeper elements take the place of the deepest one
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rb rt rp s samp small span strike "
    "strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd semantics".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
_SCOPE = frozenset("ul ol dl table body article section div main aside nav header footer form".split())
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")
_COMMENT_END = re.compile("-->")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW}
_NESTED = 64  # elements without readable text that an end tag may close


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int = 0
    main: bool = field(default=False, compare=False)


def _names(tag: str, attributes: str) -> str:
    """An element as its tag and the words of its class, id and role."""
    if not attributes:
        return tag
    found = [tag]
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("hidden", "aria-hidden"):
            found.append("hidden" if value.lower() != "false" else "")
        else:
            found += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
    return " ".join(x for x in found if x)


def leaf_blocks(page: str) -> list[Block]:
    """The page's blocks of text, in order; time and memory are linear in the page."""
    blocks: list[Block] = []
    stack: list[tuple[str, str]] = []
    counts: Counter[str] = Counter()  # open elements by tag
    parts: list[str] = []
    links = linked = at = 0
    absent: set[str] = set()  # end marks that do not come any more
    unread: list[tuple] = []  # open elements without readable text, and what there was before each

    def flush():
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                blocks.append(Block(tuple(n for _, n in stack), text, min(linked, len(text))))
            parts, linked = [], 0

    def add(text: str):
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text)

    def shorten(depth: int):
        """Close elements; one without readable text whose parent ends is taken as never opened: its text stays."""
        while len(stack) > depth:
            counts[stack.pop()[0]] -= 1
        while unread and unread[-1][1] > depth:
            unread.pop()

    def end_of(mark: str, pattern: re.Pattern) -> int | None:
        if mark in absent:
            return None
        found = pattern.search(page, at)
        if not found:
            absent.add(mark)
        return found and found.end()

    while True:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0] == "<!--":
                at = end_of("-->", _COMMENT_END) or len(page)
            continue
        tag, closing, attributes = m[2].lower(), m[1] == "/", m[3]
        alone = attributes.endswith("/")
        if tag in _BREAKS and not alone:
            flush()
        if tag in _RAW:
            if not closing and not alone:
                end = end_of(tag, _RAW_END[tag])
                at = end or (len(page) if tag in ("script", "style") else at)
        elif tag in _UNREADABLE:
            if not closing and not alone:
                unread.append((tag, len(stack), len(blocks), parts, len(parts), linked, links))
            elif closing and any(u[0] == tag for u in unread[-_NESTED:]):
                while True:
                    opened, depth, n_blocks, before, n_parts, n_linked, links = unread.pop()
                    if opened == tag:
                        break
                shorten(depth)
                del blocks[n_blocks:], before[n_parts:]
                parts, linked = before, n_linked
        elif tag == "br":
            parts.append("\n")
        elif tag in _INLINE:
            if tag == "a":
                links = 0 if closing else 1
        elif closing:
            flush()
            if counts[tag]:
                depth = len(stack)
                while stack[depth - 1][0] != tag:
                    depth -= 1
                shorten(depth - 1)
            links = 0
        else:
            flush()
            ends = _CLOSES.get(tag)
            if ends:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        shorten(i)
                        break
                    if stack[i][0] in _SCOPE:
                        break
            if tag not in _VOID and not alone:
                shorten(DEPTH - 1)
                stack.append((tag, _names(tag, attributes)))
                counts[tag] += 1
    flush()
    return blocks


class _Places(dict):
    """Hashed place of a word, remembered for as many words as fit."""

    def __init__(self, size: int):
        super().__init__()
        self._size = size

    def __missing__(self, word: str) -> int:
        found = zlib.crc32(word.encode()) % self._size
        if len(self) < 200_000:
            self[word] = found
        return found


_WORD_PLACE, _PATH_PLACE = cached("html", _Places(WORDS)), cached("html", _Places(PATH))
_PATHS: dict[tuple[str, ...], np.ndarray] = cached("html", {})


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    if path not in _PATHS:
        if len(_PATHS) > 20_000:
            _PATHS.clear()
        vector = np.zeros(PATH, np.float32)
        for i, element in enumerate(reversed(path)):
            for j, name in enumerate(element.split()):
                vector[_PATH_PLACE[name if j else "<" + name]] = 1
                if i == 0 and j == 0:
                    vector[_PATH_PLACE["leaf:" + name]] = 1
        _PATHS[path] = vector
    return _PATHS[path]


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block; reads every word."""
    out = np.zeros((len(blocks), FEATURES), np.float32)
    for i, b in enumerate(blocks):
        words = _WORD.findall(b.text.lower())
        out[i, :PATH] = _path_vector(b.path)
        if words:
            counts = np.bincount(np.fromiter(map(_WORD_PLACE.__getitem__, words), np.int64, len(words)), minlength=WORDS)
            out[i, PATH:PATH + WORDS] = np.sqrt(counts / len(words))
        size = len(b.text)
        out[i, PATH + WORDS:] = (
            np.log1p(size) / 8, b.linked / size, np.log1p(len(words)) / 6, b.text[-1] in ".!?…:\"”", b.text.count(",") / (len(words) + 1),
            i / len(blocks), len(b.path) / 10, any("hidden" in e for e in b.path),
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiLSTM:
    """Labels every position of a sequence from its whole context."""

    def __init__(self, inputs: int = FEATURES, hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p["x" + d] = (rng.standard_normal((inputs, 4 * hidden)) * (1 / np.sqrt(inputs))).astype(np.float32)
            self.p["h" + d] = (rng.standard_normal((hidden, 4 * hidden)) * (1 / np.sqrt(hidden))).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1  # remember at first
            self.p["c" + d] = bias
        self.p["o"] = (rng.standard_normal(2 * hidden) * 0.3).astype(np.float32)
        self.p["z"] = np.zeros(1, np.float32)

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        steps, count, _ = x.shape
        hidden = self.hidden
        inputs = x @ self.p["x" + d] + self.p["c" + d]
        h, c = np.zeros((count, hidden), np.float32), np.zeros((count, hidden), np.float32)
        states = np.zeros((steps, count, hidden), np.float32)
        saved = [None] * steps
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = inputs[t] + h @ self.p["h" + d]
            g = _sigmoid(a[:, :3 * hidden])
            i, f, o = g[:, :hidden], g[:, hidden:2 * hidden], g[:, 2 * hidden:]
            u = np.tanh(a[:, 3 * hidden:])
            m = mask[t][:, None]
            new = (f * c + i * u) * m
            squashed = np.tanh(new)
            if keep:
                saved[t] = (h, c, i, f, o, u, squashed)
            h, c = o * squashed * m, new
            states[t] = h
        return states, saved

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        forward, _ = self._run("f", x, mask, False)
        backward, _ = self._run("b", x, mask, False)
        return np.concatenate([forward, backward], 2) @ self.p["o"] + self.p["z"]

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients by backpropagation through time."""
        forward, kept_f = self._run("f", x, mask, True)
        backward, kept_b = self._run("b", x, mask, True)
        states = np.concatenate([forward, backward], 2)
        z = states @ self.p["o"] + self.p["z"]
        total = max(mask.sum(), 1)
        loss = float(((np.logaddexp(0, z) - y * z) * mask).sum() / total)
        dz = (_sigmoid(z) - y) * mask / total
        grads = {"o": np.einsum("tb,tbh->h", dz, states), "z": np.array([dz.sum()], np.float32)}
        dstates = dz[:, :, None] * self.p["o"]
        hidden, steps = self.hidden, len(x)
        for d, saved, part in (("f", kept_f, dstates[:, :, :hidden]), ("b", kept_b, dstates[:, :, hidden:])):
            da_all = np.zeros((*x.shape[:2], 4 * hidden), np.float32)
            gh = np.zeros_like(self.p["h" + d])
            dh_next = np.zeros((x.shape[1], hidden), np.float32)
            dc_next = np.zeros_like(dh_next)
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                h, c, i, f, o, u, squashed = saved[t]
                m = mask[t][:, None]
                dh = (part[t] + dh_next) * m
                dc = (dh * o * (1 - squashed ** 2) + dc_next) * m
                da = np.concatenate([dc * u * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - u ** 2)], 1)
                da_all[t] = da
                gh += h.T @ da
                dh_next, dc_next = da @ self.p["h" + d].T, dc * f
            grads["h" + d] = gh
            grads["x" + d] = np.tensordot(x, da_all, ([0, 1], [0, 1]))
            grads["c" + d] = da_all.sum(axis=(0, 1))
        return loss, grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = BATCH, rate: float = 0.02, seed: int = 5) -> list[float]:
        """Adam over batches of pages of like length."""
        rng = np.random.default_rng(seed)
        pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
        groups = [pages[i:i + batch] for i in range(0, len(pages), batch)]
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, step, every = [], 0, epochs * len(groups)
        for _ in range(epochs):
            for g in rng.permutation(len(groups)):
                x, mask = padded([f for f, _ in groups[g]])
                y = np.zeros(mask.shape, np.float32)
                for j, (_, label) in enumerate(groups[g]):
                    y[:len(label), j] = label
                loss, grads = self.gradients(x, y, mask)
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum(float((v ** 2).sum()) for v in grads.values()))
                for k, v in grads.items():
                    v = v * min(1.0, 5.0 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.99 * second[k] + 0.01 * v * v
                    now = rate * (1 - 0.9 * step / every)
                    self.p[k] = (self.p[k] - now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        return losses

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page, whether each block is main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            # Pages of like length together, and as many as keep the padded batch small.
            end = start + 1
            while end < len(order) and (end + 1 - start) * len(pages[order[end]]) <= 20_000:
                end += 1
            x, mask = padded([pages[i] for i in order[start:end]])
            found = self.logits(x, mask) > 0
            for j, i in enumerate(order[start:end]):
                out[i] = found[:len(pages[i]), j]
            start = end
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), FEATURES), np.float32), np.zeros((steps, len(pages)), np.float32)
    for j, p in enumerate(pages):
        x[:len(p), j] = p
        mask[:len(p), j] = 1
    return x, mask


# Names by which layouts mark their parts.
_PARTS = {
    "menu": ["nav", "ul nav", "div menu", "div nav", "div navbar", "ul menu main", "div navigation", "div breadcrumb", "div top menu", "header nav"],
    "header": ["header", "div header", "div masthead", "div site header", "div banner", "div top bar", "header site header"],
    "footer": ["footer", "div footer", "div site footer", "div bottom", "footer site footer", "div copyright", "section footer"],
    "sidebar": ["aside", "div sidebar", "aside sidebar", "div side", "div related", "div widget", "section related posts", "aside related", "div recommended"],
    "notice": ["div cookie", "div notice", "div cookie banner", "div consent", "div gdpr", "div alert", "section newsletter", "div popup", "div modal", "div cookie notice"],
    "advert": ["div ad", "div ads", "div advert", "div advertisement", "div sponsored", "div promo", "aside ad", "section ad slot", "ins ads", "div ad container"],
    "form": ["form", "form search", "div form", "form login", "form subscribe", "form contact", "div search form", "fieldset", "form comment form"],
    "comments": ["section comments", "div comments", "div comment", "ol comment list", "div responses", "div discussion", "ul comments", "section reader comments", "div comment thread"],
}
_MAIN = [
    "article", "main", "div content", "div post", "div entry content", "div article body", "section article", "div story", "main content", "article post",
    "div main", "div article", "div main content", "div post body", "section content", "div text", "div body",
]
_LEAVES = {"menu": ["li", "li", "div"], "header": ["div", "h1", "p", ""], "footer": ["", "p", "li"], "sidebar": ["li", "p", "h3", "div"], "notice": ["p", "", "div"],
           "advert": ["", "p", "div"], "form": ["label", "button", "p", "div", ""], "comments": ["p", "li", "div", "h3"]}


def _marked(b: Block) -> bool:
    """Whether HTML 5 elements put the block into the article."""
    tags = [e.split()[0] for e in b.path]
    inside = max((i for i, t in enumerate(tags) if t in ("article", "main")), default=-1)
    return inside >= 0 and not set(tags[inside:]) & {"nav", "aside", "footer", "header", "form"} and not any(
        set(e.split()[1:]) & {"ad", "ads", "advert", "comments", "comment", "sidebar", "cookie", "related"} for e in b.path[inside:]
    )


def training_pages(sample: list[str], synthetic: int = SYNTHETIC, seed: int = 5) -> list[list[Block]]:
    """Labelled pages: those that mark their article, and their blocks put together in other layouts."""
    rng = np.random.default_rng(seed)
    pages, main, other = [], [], []
    for page in sample:
        blocks = leaf_blocks(page)
        for b in blocks:
            b.main = _marked(b)
        if any(b.main for b in blocks):
            pages.append(blocks)
            main += [b.text for b in blocks if b.main]
            other += [b.text for b in blocks if not b.main]
    main = main or ["One plain sentence of an article, long enough to be read.", "Another sentence."]
    other = other or ["Home", "About us", "Contact", "All rights reserved."]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]

    def part(kind: str, around: tuple[str, ...]) -> list[Block]:
        path = (*around, pick(_PARTS[kind]))
        if kind == "menu" and rng.random() < 0.6:
            path = (*path, "ul")
        out = []
        for _ in range(int(rng.integers(1, 8 if kind in ("menu", "comments", "sidebar") else 4))):
            leaf = pick(_LEAVES[kind])
            text = pick(main if kind in ("comments", "notice", "sidebar", "advert") and rng.random() < 0.6 else other)
            if kind in ("menu", "form", "header") or rng.random() < 0.3:
                text = " ".join(text.split()[:int(rng.integers(1, 5))]) or text
            linked = len(text) if kind == "menu" or kind in ("sidebar", "footer") and rng.random() < 0.5 else 0
            out.append(Block((*path, leaf) if leaf else path, text, linked, False))
        return out

    for _ in range(synthetic):
        around = ("html", "body") + ((pick(["div", "div wrapper", "div container", "div page", "div site"]),) if rng.random() < 0.5 else ())
        body = (*around, pick(_MAIN)) + ((pick(["div", "section", "div text", "div inner"]),) if rng.random() < 0.25 else ())
        article = [Block((*body, pick(["h1", "h2", "header"])), " ".join(pick(main).split()[:12]) or "Title", 0, True)] if rng.random() < 0.8 else []
        for _ in range(int(rng.integers(1, 14))):
            text = pick(main)
            if rng.random() < 0.15:
                text = " ".join(text.split()[:int(rng.integers(1, 6))])
            article.append(Block((*body, pick(["p"] * 8 + ["li", "h2", "h3", "blockquote", "div", "td", "pre"])), text, len(text) // 5 if rng.random() < 0.1 else 0, True))
        if rng.random() < 0.15:  # a short line that repeats, as lists and junk pages have it
            line = " ".join(pick(main).split()[:int(rng.integers(1, 4))]) or "Line"
            article += [Block((*body, "p"), line, 0, True) for _ in range(int(rng.integers(2, 20)))]
        for kind in ("advert", "form", "comments", "notice", "sidebar"):
            if rng.random() < 0.2:
                at = len(article) if kind == "comments" else int(rng.integers(0, len(article) + 1))
                article[at:at] = part(kind, body)
        before = [b for kind in ("notice", "header", "menu", "advert", "sidebar", "form") if rng.random() < 0.45 for b in part(kind, around)]
        after = [b for kind in ("comments", "form", "sidebar", "advert", "footer", "notice") if rng.random() < 0.45 for b in part(kind, around)]
        pages.append(before + article + after)
    return pages


def train(sample: list[str], seed: int = 5) -> BiLSTM:
    pages = training_pages(sample, seed=seed)
    model = BiLSTM(seed=seed)
    model.fit([(features(p), np.array([b.main for b in p], np.float32)) for p in pages if p])
    return model


def main_texts(model: BiLSTM, pages: list[str | None]) -> list[str]:
    blocks = [leaf_blocks(p or "") for p in pages]
    labels = model.label([features(b) for b in blocks])
    return [" ".join(b.text for b, m in zip(bs, ms) if m) for bs, ms in zip(blocks, labels)]


def fit_on(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> BiLSTM:
    """Train on a bounded sample: the pages whose ids hash lowest, of at most ``SAMPLE_BYTES`` bytes each."""
    some = pages.filter(F.octet_length(html_col) <= SAMPLE_BYTES).select(F.xxhash64(id_col).alias("h"), F.col(html_col).alias("page"))
    return train([r["page"] for r in lowest(some, "h", sample, some.count(), "page").collect()])


def extract(pages: DataFrame, model: BiLSTM, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    from pyspark.sql.pandas.types import to_arrow_type

    fields = [T.StructField("page_id", pages.schema[id_col].dataType), T.StructField("url", pages.schema[url_col].dataType)]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("html")
        for batch in batches:
            for start in range(0, batch.num_rows, STREAM):
                piece = batch.slice(start, STREAM)
                texts = main_texts(model, piece.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=arrow)

    return pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(tidy(run), schema)


def op10_extract_pages(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, fit_on(pages))
