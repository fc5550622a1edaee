"""Main text of web pages by a recurrent labeller of blocks.

A page is read into its leaf blocks: runs of text between block-level tags, each with the path of tags, classes and ids above
it.  A block becomes a vector of hashed path names, hashed words and a few shares; a bidirectional LSTM in numpy reads the
page's whole sequence of vectors and says of each block whether it belongs to the main text.

The labeller is trained when it is needed, on pages drawn from a grammar of layouts (their blocks are labelled by
construction) and on a bounded sample of the table's own pages, labelled where semantic tags leave no doubt.  Words of the
drawn pages come from that sample.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import reach_workers

SAMPLE_PAGES = 150
DRAWN_PAGES = 450
PATH_DIM, WORD_DIM, SHARES = 64, 16, 6
HIDDEN = 16
STEPS = 220
BATCH = 24
#: Blocks that are read together, padding included; a longer page is read alone.
BLOCKS_AT_ONCE = 1 << 14

_WORD = regex.compile(r"[\p{L}\p{N}]+")
#: Tags that do not end a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr"
    " maction math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext"
    " mtr munder munderover semantics annotation annotation-xml".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("script style head title noscript template iframe annotation annotation-xml desc metadata".split())
#: Tags whose open element ends where one of them opens.
_CLOSED_BY = {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "optgroup"]),
}
#: Tags that the head holds; any other start tag ends it, and so does text, as its end tag and that of the body's start may be left out.
_OF_HEAD = frozenset("head base link meta noscript script style template title".split())


@dataclass
class Block:
    above: tuple | None  # names of the nearest block-level element, and the same of those above it
    text: str
    linked: int
    sums: np.ndarray | None = None  # the hashed names of all block-level elements above

    @property
    def path(self) -> tuple[str, ...]:
        node, names = self.above, []
        while node is not None:
            names.append(node[0])
            node = node[1]
        return tuple(x for own in reversed(names) for x in own)


class _Reader(HTMLParser):
    """Blocks of a page in time linear in its length: open elements know the block-level one above them and its path."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        #: open elements: tag, the chain of block-level names down to here, place of the nearest block-level element
        self.open: list[tuple[str, tuple | None, int]] = []
        self.last: dict[str, list[int]] = {}  # places of the open elements of a tag
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0
        self.unseen = 0
        self.names: dict[str, int] = {}  # how many open block-level elements have a name
        self.sums = np.zeros(PATH_DIM, np.float32)  # the hashed names, each once

    def _count(self, names: tuple[str, ...], by: int) -> None:
        for name in names:
            n = self.names[name] = self.names.get(name, 0) + by
            if n == (by > 0):
                at, sign = _slot(name, PATH_DIM)
                self.sums[at] += sign * by

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(self.open[-1][1] if self.open else None, text, self.linked, self.sums.copy()))
        self.parts, self.linked = [], 0

    def _end_head(self) -> None:
        if self.open and self.open[-1][0] == "head":
            self._close(len(self.open) - 1)

    def handle_starttag(self, tag, attrs):
        if tag not in _OF_HEAD:
            self._end_head()
        if tag in _INLINE:
            if tag in ("br", "wbr", "img"):
                self.parts.append(" " if tag != "wbr" else "")
                return
            if tag in ("mtr", "mtd"):
                self.parts.append(" ")
        else:
            self.end_block()
            while self.open:
                # inline elements do not keep a paragraph open
                top = self.open[-1][2]
                if top < 0 or tag not in _CLOSED_BY.get(self.open[top][0], ()):
                    break
                self._close(top)
        if tag in _VOID:
            return
        above = self.open[-1] if self.open else ("", None, -1)
        if tag in _INLINE:
            self.open.append((tag, above[1], above[2]))
        else:
            names = [tag]
            for k, v in attrs:
                if k in ("class", "id", "role") and v:
                    names += [f".{x}" for x in regex.findall(r"[a-z]+", v.lower())]
            self._count(tuple(names), 1)
            self.open.append((tag, (tuple(names), above[1]), len(self.open)))
        self.last.setdefault(tag, []).append(len(self.open) - 1)
        self.links += tag == "a"
        self.unseen += tag in _UNSEEN

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _close(self, at: int) -> None:
        for tag, node, _ in reversed(self.open[at:]):
            self.last[tag].pop()
            if tag not in _INLINE:
                self._count(node[0], -1)
            self.links -= tag == "a"
            self.unseen -= tag in _UNSEEN
        del self.open[at:]

    def handle_endtag(self, tag):
        if tag not in _INLINE:
            self.end_block()
        places = self.last.get(tag)
        if places:
            self._close(places[-1])

    def handle_data(self, data):
        if self.unseen and data.strip():
            self._end_head()
        if not self.unseen:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page in order; what is not shown (scripts, styles, the head, notes on formulas and the like) is no block."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.end_block()
    return reader.blocks


@lru_cache(maxsize=100_000)
def _slot(name: str, dim: int) -> tuple[int, float]:
    h = crc32(name.encode())
    return h % dim, 1.0 if h >> 31 else -1.0


def vectors(found: list[Block]) -> np.ndarray:
    """One row a block: hashed path names, hashed words and shares."""
    x = np.zeros((len(found), PATH_DIM + WORD_DIM + SHARES), np.float32)
    for i, b in enumerate(found):
        row = x[i]
        if b.sums is not None:
            row[:PATH_DIM] = b.sums
        else:
            for name in dict.fromkeys(b.path):
                at, sign = _slot(name, PATH_DIM)
                row[at] += sign
        if b.above:
            at, sign = _slot("leaf " + b.above[0][-1], PATH_DIM)
            row[at] += sign
        words = _WORD.findall(b.text.lower())
        sums = [0.0] * WORD_DIM  # whole numbers, exact in either type
        for w in words:
            at, sign = _slot(w, WORD_DIM)
            sums[at] += sign
        row[PATH_DIM : PATH_DIM + WORD_DIM] = sums
        n = len(b.text)
        row[PATH_DIM : PATH_DIM + WORD_DIM] *= 0.5 / max(len(words), 1) ** 0.5
        row[PATH_DIM + WORD_DIM :] = (
            np.log1p(n) / 6, min(b.linked / max(n, 1), 1.0), np.log1p(len(words)) / 5, sum(map(b.text.count, ".,;!?")) / n * 5,
            i / max(len(found) - 1, 1), len(found) / (len(found) + 20),
        )
    return x


# --- the labeller -----------------------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_weights(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d = PATH_DIM + WORD_DIM + SHARES
    w: dict[str, np.ndarray] = {}
    for side in ("f", "b"):
        w[f"x{side}"] = rng.standard_normal((d, 4 * HIDDEN)) / d**0.5
        w[f"h{side}"] = rng.standard_normal((HIDDEN, 4 * HIDDEN)) / HIDDEN**0.5
        w[f"c{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    w["out"] = rng.standard_normal((2 * HIDDEN + d, 1)) / 10
    w["bias"] = np.zeros(1)
    return w


def _flip(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Reverse each sequence within its own length."""
    t = np.arange(x.shape[1])[None, :]
    at = np.where(t < lengths[:, None], lengths[:, None] - 1 - t, t)
    return np.take_along_axis(x, at[:, :, None], axis=1)


def _pass(w: dict[str, np.ndarray], side: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    n, steps, _ = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    fixed = x @ w[f"x{side}"] + w[f"c{side}"]
    out = np.zeros((n, steps, HIDDEN))
    for t in range(steps):
        z = fixed[:, t] + h @ w[f"h{side}"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        before = (h, c)
        c = f * c + i * g
        s = np.tanh(c)
        h = o * s
        out[:, t] = h
        if keep is not None:
            keep.append((i, f, o, g, s, *before))
    return out


def predict(w: dict[str, np.ndarray], x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probability of every block of padded sequences (page, block, feature)."""
    ahead = _pass(w, "f", x)
    behind = _flip(_pass(w, "b", _flip(x, lengths)), lengths)
    return _sigmoid((np.concatenate([ahead, behind, x], axis=2) @ w["out"])[:, :, 0] + w["bias"])


def gradients(w: dict[str, np.ndarray], x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all blocks and its gradients, by back-propagation through both passes."""
    mask = np.arange(x.shape[1])[None, :] < lengths[:, None]
    xb = _flip(x, lengths)
    kept: dict[str, list] = {"f": [], "b": []}
    outs = {"f": _pass(w, "f", x, kept["f"]), "b": _pass(w, "b", xb, kept["b"])}
    all_ = np.concatenate([outs["f"], _flip(outs["b"], lengths), x], axis=2)
    p = _sigmoid((all_ @ w["out"])[:, :, 0] + w["bias"])
    n = mask.sum()
    loss = float(-(np.where(y > 0, np.log(p + 1e-9), np.log(1 - p + 1e-9)) * mask).sum() / n)
    d = ((p - y) * mask / n)[:, :, None]
    g = {"out": (all_ * d).sum(axis=(0, 1))[:, None], "bias": np.array([d.sum()])}
    back = d * w["out"][:, 0]
    wanted = {"f": back[:, :, :HIDDEN], "b": _flip(back[:, :, HIDDEN : 2 * HIDDEN], lengths)}
    for side, seq in (("f", x), ("b", xb)):
        dh, dc = np.zeros_like(outs[side][:, 0]), np.zeros_like(outs[side][:, 0])
        dz_all = np.zeros((*seq.shape[:2], 4 * HIDDEN))
        g[f"h{side}"] = np.zeros_like(w[f"h{side}"])
        for t in range(seq.shape[1] - 1, -1, -1):
            i, f, o, gate, s, h0, c0 = kept[side][t]
            dh = dh + wanted[side][:, t]
            dc = dc + dh * o * (1 - s * s)
            dz = np.concatenate([dc * gate * i * (1 - i), dc * c0 * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - gate * gate)], axis=1)
            dz_all[:, t] = dz
            g[f"h{side}"] += h0.T @ dz
            dh, dc = dz @ w[f"h{side}"].T, dc * f
        g[f"x{side}"] = np.einsum("ntd,ntk->dk", seq, dz_all)
        g[f"c{side}"] = dz_all.sum(axis=(0, 1))
    return loss, g


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    x = np.zeros((len(rows), max(1, lengths.max(initial=1)), PATH_DIM + WORD_DIM + SHARES))
    for k, r in enumerate(rows):
        x[k, : len(r)] = r
    return x, lengths


def train(pages: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights after some steps of Adam over batches of pages, in an order that the seed decides."""
    w = new_weights(seed)
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(x) for k, x in w.items()}
    pages = [p for p in pages if len(p[0])]
    for step in range(1, steps + 1):
        if not pages:
            break
        some = [pages[i] for i in rng.integers(0, len(pages), BATCH)]
        x, lengths = _padded([p[0] for p in some])
        y = np.zeros(x.shape[:2])
        for k, (_, own) in enumerate(some):
            y[k, : len(own)] = own
        _, g = gradients(w, x, lengths, y)
        rate = 0.02 * (1 - step / (steps + 1)) + 1e-3
        for k in w:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return w


# --- pages to learn from ----------------------------------------------------------------------------------------------

#: Names by which parts of pages go: wrapping tags, classes.
_KINDS = {
    "menu": (("nav", "div", "ul", "header"), ("nav", "menu", "navbar", "topnav", "breadcrumb", "breadcrumbs", "navigation", "toc")),
    "head": (("header", "div"), ("header", "masthead", "banner", "site header", "topbar", "logo", "branding")),
    "foot": (("footer", "div"), ("footer", "site footer", "copyright", "legal", "bottom")),
    "side": (("aside", "div", "section"), ("sidebar", "side", "related", "widget", "recommended", "trending", "newsletter", "social", "share", "tags")),
    "notice": (("div", "section", "p"), ("cookie", "notice", "consent", "gdpr", "alert", "popup", "modal", "subscribe", "paywall")),
    "advert": (("div", "aside", "section", "p"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor")),
    "form": (("form", "div"), ("form", "search", "login", "signup", "contact")),
    "comments": (("section", "div", "ol", "ul"), ("comments", "comment", "comment list", "discussion", "replies", "responses", "disqus")),
}
_MAIN = (("article", "main", "div", "section"), ("", "content", "article", "post", "entry", "main", "article body", "story", "text"))


def drawn_page(rng: np.random.Generator, words: list[str]) -> tuple[list[Block], np.ndarray]:
    """A page from the grammar of layouts: its blocks, and 1 for those of the main text."""
    pick = lambda xs: xs[rng.integers(len(xs))]
    text = lambda lo, hi: " ".join(pick(words) for _ in range(rng.integers(lo, hi + 1)))
    html: list[str] = []
    mark = "zq" + "xj"  # begins every block of the main text and is taken off again

    def part(kind: str) -> str:
        tags, names = _KINDS[kind]
        tag, name = pick(tags), pick(names)
        if tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5:
            name = ""
        attr = f' {pick(["class", "class", "id"])}="{name}"' if name or tag in ("div", "section", "p", "ul", "ol") else ""
        if not name and attr:
            attr = f' class="{pick(names)}"'
        if kind == "form":
            inner = "".join(f"<label>{text(1, 3)}</label><input>" for _ in range(rng.integers(1, 4))) + f"<button>{text(1, 2)}</button>"
        elif kind == "comments":
            one = pick(("p", "li", "div"))
            inner = "".join(f"<{one}>{text(3, 40)}</{one}>" for _ in range(rng.integers(1, 6)))
            if rng.random() < 0.5:
                inner = f"<h3>{text(1, 3)}</h3>" + inner
        elif kind in ("menu", "side") and rng.random() < 0.8:
            inner = "<ul>" + "".join(f'<li><a href="#">{text(1, 3)}</a></li>' for _ in range(rng.integers(2, 9))) + "</ul>"
        else:
            inner = pick((text(2, 25), f"<p>{text(2, 25)}</p>", f'<a href="#">{text(1, 6)}</a> {text(1, 20)}', f"<h3>{text(1, 4)}</h3><p>{text(4, 30)}</p>"))
        return f"<{tag}{attr}>{inner}</{tag}>"

    def main() -> str:
        tags, names = _MAIN
        tag, name = pick(tags), pick(names)
        attr = f' class="{name}"' if name else (' class="content"' if tag in ("div", "section") else "")
        out = [f"<h1>{mark}{text(2, 12)}</h1>"] if rng.random() < 0.85 else []
        for _ in range(rng.integers(1, 12)):
            kind = rng.random()
            if kind < 0.7:
                out.append(f"<p>{pick(('', '<b>', '<i>'))}{mark}{text(1, 60)}{pick(('</p>', '<br>', ''))}")
            elif kind < 0.8:
                out.append(f"<h2>{mark}{text(1, 6)}</h2>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{mark}{text(2, 20)}</li>" for _ in range(rng.integers(1, 5))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{mark}{text(4, 40)}</blockquote>")
            elif kind < 0.95:
                out.append(f"<table><tr><td>{mark}{text(1, 4)}</td><td>{mark}{text(1, 4)}</td></tr></table>")
            else:
                out.append(part(pick(("advert", "notice", "side"))))
        if rng.random() < 0.2:
            out.append(part("comments"))
        return f"<{tag}{attr}>{''.join(out)}</{tag}>"

    html += [part(k) for k in ("head", "menu", "notice", "advert", "form", "side") if rng.random() < 0.55]
    html.append(main())
    html += [part(k) for k in ("comments", "side", "advert", "menu", "form", "notice", "foot") if rng.random() < 0.5]
    found = blocks(f"<html><body>{''.join(html)}</body></html>")
    y = np.array([mark in b.text for b in found], float)
    for b in found:
        b.text = b.text.replace(mark, "")
    return found, y


_NEVER = frozenset(["nav", "footer", "aside", "form", "header", "button", "label", "select", "option", "textarea"])


def _sure(b: Block) -> float | None:
    """The label that semantic tags alone give a block of a real page, where they leave no doubt."""
    tags = set(b.path)
    if tags & _NEVER:
        return 0.0
    classes = {x[1:] for x in tags if x[0] == "."}
    bad = any(classes & set(" ".join(names).split()) for _, names in _KINDS.values())
    if tags & {"article", "main"}:
        return 0.0 if bad else 1.0
    return 0.0 if bad else None


def fit(pages: DataFrame, html: str = "html", key: str = "page_id", bound: int = SAMPLE_PAGES, seed: int = 3) -> dict[str, np.ndarray]:
    """Train on drawn pages and on at most ``bound`` pages of the table, chosen by a hash of ``key`` and, where keys repeat, of the page.

    An empty table leaves the drawn pages, with made-up words.
    """
    n = pages.count()
    sample = pages.where(F.col(html).isNotNull())
    if n > bound:
        sample = sample.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(2 * bound / n * (1 << 30)))
    # a total order up to equal pages, so that the weights do not depend on partitions
    ids = sample.select(F.xxhash64(key).alias("h"), F.xxhash64(html).alias("g"), html).orderBy("h", "g").limit(bound)
    rows = [r[2] for r in ids.collect()]
    known: list[tuple[np.ndarray, np.ndarray]] = []
    words: dict[str, None] = {}
    for text in rows:
        found = blocks(text)
        labels = [_sure(b) for b in found]
        if found and None not in labels:
            known.append((vectors(found), np.array(labels)))
        for b in found:
            words.update(dict.fromkeys(b.text.split()))
    pool = sorted(words) or [f"word{i}" for i in range(500)]
    rng = np.random.default_rng(seed)
    for _ in range(DRAWN_PAGES):
        found, y = drawn_page(rng, pool)
        known.append((vectors(found), y))
    return train(known, seed=seed)


def label(w: dict[str, np.ndarray], pages: list[list[Block]]) -> list[np.ndarray]:
    """Whether each block of each page belongs to its main text; pages of like length are read together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    while order:
        # longest last; as many as their padded blocks allow
        own = [order.pop()]
        most = len(pages[own[0]])
        while order and len(own) < 64 and (len(own) + 1) * most <= BLOCKS_AT_ONCE:
            own.append(order.pop())
        x, lengths = _padded([vectors(pages[i]) for i in own])
        p = predict(w, x, lengths)
        for k, i in enumerate(own):
            out[i] = p[k, : lengths[k]] >= 0.5
    return out


def extract(df: DataFrame, weights: dict[str, np.ndarray], html: str = "html", out: str = "text") -> DataFrame:
    """Add ``out`` (the main text, blocks joined by one newline) and n_chars (its code points) to each row.

    Null and empty pages and pages without main text give an empty text.  Other columns pass; clashing ones are replaced.
    """
    reach_workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    @F.arrow_udf(T.StringType())
    def texts(pages: pa.Array) -> pa.Array:
        rows = pages.to_pylist()
        result: list[str] = []
        for first in range(0, len(rows), 256):
            found = [blocks(h) for h in rows[first : first + 256]]
            for own, on in zip(found, label(shared.value, found)):
                result.append("\n".join(b.text for b, k in zip(own, on) if k))
        return pa.array(result, pa.string())

    return df.withColumn(out, texts(F.col(html))).withColumn("n_chars", F.char_length(out).cast("long"))
