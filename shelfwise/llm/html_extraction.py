"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf sequence: blocks of text in page order, each with
the names on its tag path (elements and words of class, id and role), the
share of its text inside links and its words, hashed to ``WORD_DIMS`` counts. A
bidirectional LSTM in numpy reads the whole sequence and scores every block, so
a block is judged with what stands before and after it: text beside an article
is left out of a page that has one, and is the article of a page that has none.

The weights are fitted on the driver, on a bounded sample: at most
``SAMPLE_PAGES`` pages (smallest hashes first, at most ``SAMPLE_HTML`` code
points of html, ``SAMPLE_BLOCKS`` blocks, ``SAMPLE_WORDS`` words of each) and as
many pages again, ``MADE`` times, laid out at random from the sample's own
blocks. Their labels come from the markup: no name of ``PAGE_PARTS`` on the
path, and inside ``article`` or ``main`` where the page has one. Every page of
the table is then labelled whole, batch by batch, in Python tasks.

Defined results: null or empty html, and pages without main text, give an empty
text; repeated rows stay; other columns are kept. Unclosed elements, comments
and scripts end as in a browser; a quote that is never closed protects no
more; markup is read in one linear pass and a page's blocks are scored in
time linear in their number.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES, SAMPLE_HTML, SAMPLE_BLOCKS, SAMPLE_WORDS, MADE = 192, 1 << 20, 64, 40, 12
WORD_DIMS, HIDDEN, EPOCHS, RATE = 64, 16, 36, 0.01
CHUNK = 1 << 14     # blocks scored at once

# Names of page parts that are no main text, as elements, classes, ids or roles.
PAGE_PARTS = """
nav menu navbar navigation breadcrumb breadcrumbs menubar toolbar tabs pager pagination skip toc
header masthead banner topbar branding logo
footer contentinfo copyright legal colophon imprint
aside sidebar rail complementary widget widgets related recommended recommendations popular trending teaser teasers
notice notices notification cookie cookies consent gdpr alert popup modal overlay dialog paywall disclaimer toast
ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion outbrain taboola
form search login signin signup register subscribe subscription newsletter fieldset legend label select option
button textarea input
comment comments commentlist reply replies respond responses disqus discussion feedback
share sharing social follow
head title script style noscript template iframe svg object hidden
""".split()
# Names that say nothing against a block.
OTHER_PARTS = """
article main div section p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption
blockquote pre figure figcaption address details summary center content post entry story text page wrapper container
row col column lead intro paragraph headline list quote inner outer left right box block
""".split()
_BIT = {name: i for i, name in enumerate(dict.fromkeys(PAGE_PARTS + OTHER_PARTS))}
_PARTS = sum(1 << _BIT[name] for name in set(PAGE_PARTS))
_HOLDS = (1 << _BIT["article"]) | (1 << _BIT["main"])

_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr img br""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in ("script", "style", "title", "textarea", "iframe", "xmp",
                                                           "noembed", "noframes")}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
_MARK = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+))")
_REST = re.compile(r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>""")
_NAMES = re.compile(r"""(?:\s|^)(class|id|role|hidden)(?=[\s=/]|$)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _bits(tag: str, attributes: str) -> int:
    if tag in ("html", "body"):     # on every path; their classes speak of the whole page ("with-sidebar")
        return 0
    mask = 1 << _BIT[tag] if tag in _BIT else 0
    for name, value in _NAMES.findall(attributes):
        for piece in ["hidden"] if name.lower() == "hidden" else _PIECE.findall(value):
            mask |= 1 << _BIT[piece.lower()] if piece.lower() in _BIT else 0
    return mask


def leaf_blocks(html: str) -> list[tuple[str, int, int, int]]:
    """Blocks with text, in page order: (text, names on the tag path as bits,
    names of the nearest element as bits, code points inside links)."""
    out: list[tuple[str, int, int, int]] = []
    names, masks, open_ = [""], [0], Counter()
    own = [0]
    pieces: list[str] = []
    linked = links = 0
    quotes = True

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((text, masks[-1], own[-1], min(linked, len(text))))
            pieces.clear()
        linked = 0

    def say(text):
        nonlocal linked
        if text:
            text = unescape(text) if "&" in text else text
            pieces.append(text)
            if links:
                linked += len(text)

    def push(tag, mask):
        names.append(tag)
        masks.append(masks[-1] | mask)
        own.append(mask)
        open_[tag] += 1

    def pop():
        open_[names.pop()] -= 1
        masks.pop()
        own.pop()

    at, end = 0, len(html)
    while at < end:
        m = _MARK.search(html, at)
        if not m:
            say(html[at:])
            break
        say(html[at:m.start()])
        if m[1] or m[2]:
            if m[1] and not html.startswith((">", "->"), m.end()):
                stop = html.find("-->", m.end())
                at = end if stop < 0 else stop + 3
            else:
                stop = html.find(">", m.end())
                at = end if stop < 0 else stop + 1
            continue
        rest = _REST.match(html, m.end()) if quotes else None
        if rest is None:
            quotes, stop = False, html.find(">", m.end())
            if stop < 0:
                break       # the page ends inside a tag
            rest_at = stop + 1
        else:
            rest_at = rest.end()
        tag, attributes, at = m[4].lower(), html[m.end():rest_at - 1], rest_at
        if tag in _INLINE:
            if tag == "br":
                pieces.append("\n")
            elif tag == "a":
                links = 0 if m[3] else 1
            continue
        flush()
        links = 0
        if m[3]:
            if open_[tag]:
                while names[-1] != tag:
                    pop()
                pop()
            continue
        while names[-1] == "p" or names[-1] in _CLOSES.get(tag, ()):
            pop()
        if tag in _VOID:
            continue
        mask = _bits(tag, attributes)
        if tag in _RAW:
            stop = _RAW[tag].search(html, at)
            stop = end if stop is None else stop.start()
            if tag in ("title", "textarea"):
                push(tag, mask)
                say(html[at:stop])
                flush()
                pop()
            at = end if stop == end else (html.find(">", stop) + 1 or end)
            continue
        push(tag, mask)
    flush()
    return out


def markup_labels(masks: list[int]) -> list[bool]:
    """Labels that the markup gives: no page part on the path, and inside
    the article where the page has one."""
    clear = [not m & _PARTS for m in masks]
    inside = [c and bool(m & _HOLDS) for c, m in zip(clear, masks)]
    return inside if any(inside) else clear


def _spread(masks: list[int]) -> np.ndarray:
    width = -(-len(_BIT) // 8)
    raw = np.frombuffer(b"".join(m.to_bytes(width, "little") for m in masks), np.uint8).reshape(-1, width)
    return np.unpackbits(raw, axis=1, bitorder="little")[:, :len(_BIT)].astype(np.float32)


def features(blocks: list[tuple[str, int, int, int]]) -> np.ndarray:
    """One row for each block: path names, own names, hashed words, and four
    measures of its text."""
    paths: dict = {}
    which = np.array([paths.setdefault(b[1:3], len(paths)) for b in blocks])
    named = np.concatenate([_spread([p for p, _ in paths]), _spread([o for _, o in paths])], axis=1)[which]
    hashed, counts = [], []
    for text, *_ in blocks:
        ws = text.encode("utf-8", "surrogatepass").lower().split()
        hashed.extend(zlib.crc32(w) for w in ws)
        counts.append(len(ws))
    counts = np.array(counts)
    at = np.repeat(np.arange(len(blocks)), counts) * WORD_DIMS + np.array(hashed, np.int64) % WORD_DIMS
    words = np.bincount(at, minlength=len(blocks) * WORD_DIMS).reshape(len(blocks), WORD_DIMS).astype(np.float32)
    words /= np.sqrt((words ** 2).sum(1, keepdims=True)) + 1e-6
    size = np.array([len(b[0]) for b in blocks], np.float32)
    link = np.array([b[3] for b in blocks], np.float32) / size
    text = np.stack([np.minimum(np.log1p(size) / 8, 1.5), np.minimum(np.log1p(counts) / 6, 1.5), link, link > 0.5], axis=1)
    return np.concatenate([named, 0.5 * words, text.astype(np.float32)], axis=1)


DIMS = 2 * len(_BIT) + WORD_DIMS + 4


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _start(rng) -> dict[str, np.ndarray]:
    w = {}
    for d in "fb":
        w["x" + d] = rng.normal(0, 0.08, (DIMS, 4 * HIDDEN))
        w["h" + d] = rng.normal(0, 0.08, (HIDDEN, 4 * HIDDEN))
        w["c" + d] = np.repeat([0.0, 2.0, 0.0, 0.0], HIDDEN)    # the forget gate starts open
    w |= {"o": rng.normal(0, 0.1, 2 * HIDDEN), "skip": np.zeros(DIMS), "bias": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in w.items()}


def _gates(z, c):
    i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
    g = np.tanh(z[:, 3 * HIDDEN:])
    c2 = f * c + i * g
    return i, f, o, g, c2, np.tanh(c2)


def score(w: dict[str, np.ndarray], pages: list[list]) -> list[np.ndarray]:
    """Log odds of every block of the pages being main text. Pages advance
    together, longest first; only states and one number a block are kept."""
    order = sorted(range(len(pages)), key=lambda i: -len(pages[i]))
    sizes = np.array([len(pages[i]) for i in order])
    starts = np.cumsum(sizes) - sizes
    blocks = [b for i in order for b in pages[i]]
    if not blocks:
        return [np.zeros(0, np.float32) for _ in pages]
    out = np.zeros(len(blocks), np.float32)
    alive = [int(k) for k in np.searchsorted(-sizes, -np.arange(sizes[0]), "left")]     # pages with more than t blocks
    for d in "fb":
        h = np.zeros((len(pages), HIDDEN), np.float32)
        c = np.zeros_like(h)
        t = 0
        while t < len(alive):
            span, n = t, 0
            while span < len(alive) and (n == 0 or n + alive[span] <= CHUNK):
                n += alive[span]
                span += 1
            steps = [starts[:alive[s]] + (s if d == "f" else sizes[:alive[s]] - 1 - s) for s in range(t, span)]
            rows = np.concatenate(steps)
            x = features([blocks[r] for r in rows])
            z = x @ w["x" + d] + w["c" + d]
            if d == "f":
                out[rows] += x @ w["skip"] + w["bias"][0]
            at, half = 0, w["o"][:HIDDEN] if d == "f" else w["o"][HIDDEN:]
            for r in steps:
                k = len(r)
                _, _, o, _, c2, tc = _gates(z[at:at + k] + h[:k] @ w["h" + d], c[:k])
                c[:k], h[:k] = c2, o * tc
                out[r] += h[:k] @ half
                at += k
            t = span
    got: list = [None] * len(pages)
    for i, s, n in zip(order, starts, sizes):
        got[i] = out[s:s + n]
    return got


def _train_step(w, x, y, live):
    """Loss gradients of padded pages: x (steps, pages, dims), labels y and
    marks of real blocks, by back-propagation through time."""
    steps, pages, _ = x.shape
    past, out = {}, x @ w["skip"] + w["bias"][0]
    for d in "fb":
        z = x @ w["x" + d] + w["c" + d]
        h = np.zeros((pages, HIDDEN), np.float32)
        c, past[d] = h, []
        half = w["o"][:HIDDEN] if d == "f" else w["o"][HIDDEN:]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            on = live[t][:, None]
            i, f, o, g, c2, tc = _gates(z[t] + h @ w["h" + d], c)
            past[d].append((t, h, c, i, f, o, g, tc))
            h, c = on * (o * tc), on * c2
            out[t] += h @ half
    err = (_sigmoid(out) - y) * live / live.sum()
    grad = {"skip": np.einsum("tpd,tp->d", x, err), "bias": np.array([err.sum()]), "o": np.zeros(2 * HIDDEN, np.float32)}
    for d in "fb":
        dz = np.zeros((steps, pages, 4 * HIDDEN), np.float32)
        dh = np.zeros((pages, HIDDEN), np.float32)
        dc, grad["h" + d] = dh, np.zeros_like(w["h" + d])
        part = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
        for t, h, c, i, f, o, g, tc in reversed(past[d]):
            on = live[t][:, None]
            grad["o"][part] += (on * o * tc).T @ err[t]
            dh = on * (dh + err[t][:, None] * w["o"][part])
            dc = on * dc + dh * o * (1 - tc * tc)
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o),
                                    dc * i * (1 - g * g)], axis=1)
            grad["h" + d] += h.T @ dz[t]
            dh, dc = dz[t] @ w["h" + d].T, dc * f
        grad["x" + d] = np.tensordot(x, dz, ([0, 1], [0, 1]))
        grad["c" + d] = dz.sum((0, 1))
    return grad


def _lay_out(rng, texts: list[str]) -> list[tuple[str, int, int, int]]:
    """A page laid out at random from given texts: an article in all sorts of
    wrappers (or none), page parts of all sorts before, in and after it."""
    text = lambda: texts[rng.integers(len(texts))]
    bit = lambda *ns: sum(1 << _BIT[n] for n in set(ns) if n)
    pick = lambda ns: ns[rng.integers(len(ns))]
    bare = rng.random() < 0.1       # hardly more than text
    has_article = rng.random() < 0.7 and not bare
    wrap = bit(*[pick(OTHER_PARTS[2:]) for _ in range(rng.integers(0, 3))])
    wrap &= ~_HOLDS
    inner = wrap | (bit(pick(["article", "main"])) if has_article else 0)
    inner |= bit("article", "main") if has_article and rng.random() < 0.2 else 0
    inner |= bit(pick(OTHER_PARTS[2:])) & ~_HOLDS if rng.random() < 0.4 else 0
    out: list = []

    def add(mask, own, n):
        for _ in range(n):
            s = text()
            link = len(s) if rng.random() < (0.6 if (mask | own) & _PARTS else 0.05) else 0
            out.append((s, mask | own, own, link))

    def part(base):
        name = bit(pick(PAGE_PARTS)) | (bit(pick(OTHER_PARTS[4:])) & ~_HOLDS if rng.random() < 0.5 else 0)
        leaf = pick(["li", "div", "p", "h2", "td", "section"])
        at = base | (bit("article") if has_article and rng.random() < 0.1 else 0)
        if rng.random() < 0.4:
            add(at, name, rng.integers(1, 3))
        else:
            add(at | name, bit(leaf), rng.integers(1, 7))

    def stray():
        if has_article and rng.random() < 0.4:
            add(wrap, bit(pick(["div", "p", "section", "li"])), rng.integers(1, 3))

    if rng.random() < 0.7 and not bare:
        add(bit("head"), bit("title"), 1)
    for _ in range(rng.integers(0, 4) * (not bare)):
        part(wrap)
    stray()
    long = rng.random() < 0.05
    for _ in range(rng.integers(1, 9) * (12 if long else 1)):
        add(inner, bit(pick(["p", "p", "p", "p", "h1", "h2", "h3", "li", "blockquote", "td", "div", "pre", "figcaption", "dd", "", ""])), 1)
        if rng.random() < 0.08:
            part(inner)
    stray()
    for _ in range(rng.integers(0, 4) * (not bare)):
        part(wrap)
    return out


def train(pages: list[list[tuple[str, int, int, int]]], seed: int = 11) -> dict[str, np.ndarray]:
    """Fit the labeller on sample pages (their blocks) and on pages laid out
    from the texts of those."""
    rng = np.random.default_rng(seed)
    texts = [b[0] for p in pages for b in p] or ["a word", "some words of a page", "one more short line"]
    made = [_lay_out(rng, texts) for _ in range(MADE * max(len(pages), SAMPLE_PAGES))]
    own = [(p, markup_labels([b[1] for b in p])) for p in [*filter(None, pages), *made]]
    sets = [(features(p), np.array(y, np.float32)) for p, y in own]
    w = _start(rng)
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i][1]) // 8, rng.random()))
        packs = [order[k:k + 48] for k in range(0, len(order), 48)]
        rng.shuffle(packs)
        for pack in packs:
            steps = max(len(sets[i][1]) for i in pack)
            x = np.zeros((steps, len(pack), DIMS), np.float32)
            y, live = np.zeros((steps, len(pack)), np.float32), np.zeros((steps, len(pack)), np.float32)
            for j, i in enumerate(pack):
                n = len(sets[i][1])
                x[:n, j], y[:n, j], live[:n, j] = sets[i][0], sets[i][1], 1
            grad, step = _train_step(w, x, y, live), step + 1
            size = np.sqrt(sum(float((g ** 2).sum()) for g in grad.values()))
            rate = RATE * min(1.0, 2 * (1 - epoch / EPOCHS))
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return w


def fit(pages: DataFrame) -> dict[str, np.ndarray]:
    """Weights fitted on the bounded sample of ``pages(html)``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, html in enumerate(b.column(0).to_pylist()):
                for text, mask, own, link in leaf_blocks(html)[:SAMPLE_BLOCKS]:
                    short = " ".join(text.split()[:SAMPLE_WORDS])[:2000]
                    rows.append((zlib.crc32(html.encode("utf-8", "replace")), len(rows), short, f"{mask:x}", f"{own:x}",
                                 min(link, len(short))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["page", "i", "text", "mask", "own", "link"])

    some = pages.select("html").where(F.length("html").between(1, SAMPLE_HTML)) \
        .orderBy(F.xxhash64("html")).limit(SAMPLE_PAGES)
    got: dict[int, list] = {}
    for r in some.mapInArrow(cut, "page bigint, i bigint, text string, mask string, own string, link bigint") \
            .orderBy("page", "i").collect():
        got.setdefault(r["page"], []).append((r["text"], int(r["mask"], 16), int(r["own"], 16), r["link"]))
    return train([got[k] for k in sorted(got)])


def extract(pages: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """``pages`` with its ``html`` replaced by ``text``, the main text (blocks
    joined by line feeds), ``n_blocks`` and ``n_kept``. Weights are fitted
    on a sample of the table unless given."""
    w = fit(pages) if weights is None else weights
    others = [c for c in pages.columns if c not in ("html", "text", "n_blocks", "n_kept")]
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(1).alias("_")]).alias("_row"), "html")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            html = b.column(1)
            first, todo, n = 0, [], 0
            for i in range(b.num_rows):
                todo.append(leaf_blocks(html[i].as_py() or ""))
                n += len(todo[-1])
                if n >= CHUNK or i + 1 == b.num_rows:
                    kept = [[t[0] for t, s in zip(p, odds) if s > 0] for p, odds in zip(todo, score(w, todo))]
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).slice(first, len(todo)), pa.array(["\n".join(k) for k in kept], pa.string()),
                        pa.array([len(p) for p in todo], pa.int64()), pa.array([len(k) for k in kept], pa.int64())],
                        ["_row", "text", "n_blocks", "n_kept"])
                    first, todo, n = i + 1, [], 0

    row = packed.schema["_row"].dataType.simpleString()
    out = packed.mapInArrow(label, f"_row {row}, text string, n_blocks bigint, n_kept bigint")
    return out.select("_row.*" if others else F.lit(None).alias("_none"), "text", "n_blocks", "n_kept").drop("_none")
