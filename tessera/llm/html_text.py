"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags. Each block becomes a
vector of its hashed tag path (tags with class, id and role tokens of all open containers), its
hashed words and a few shape figures. A bidirectional LSTM, written in numpy, reads the
page's whole block sequence and gives each block the probability of being article text, so a block
is judged by what stands around it anywhere in the page. Blocks from a half on are kept, in
page order.

Training reads at most ``MAX_TRAIN`` pages (those of least hash of page_id). Blocks inside
semantic article containers are positives, others negatives; copies of the pages with renamed
containers and inserted menus, notices, forms, adverts, sidebars and reader comments teach the
network to do without one particular markup. Everything is seeded, so equal samples give equal networks.

Defined results for odd input: null html gives the empty text; html without blocks gives the empty text;
broken markup (unclosed tags, bare ``<``, cut comments) is read as far as it makes sense, in linear time however long a page is;
containers more than ``MAX_DEPTH`` deep are read like their siblings; equal pages give equal texts; rows
with equal or null page_id give a row each; an empty table gives no rows; with no page that has
an article container only the made-up pages are learned; extra columns pass through, and one called like the result gets a leading
underscore.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, least_hashed, schema_with, table, with_room
from tessera.llm.shingles import word_hashes

#: Pages that the network may learn from.
MAX_TRAIN = 240
PATH, OWN, WORD, SHAPE = 96, 64, 32, 12
WIDTH = PATH + OWN + WORD + SHAPE
HIDDEN, EPOCHS, RATE, SEED = 20, 16, 0.01, 5

# ---------------------------------------------------------------- blocks

#: What a tag holds after its name; quotes only count behind an equals sign. Nothing is tried twice, so time is linear.
_INSIDE = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
#: Comments and raw text, which run to the end of the page when they are not closed, and self-closed forms of the latter.
_OPAQUE = (
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:script|style)\s*+/>"
    rf"|<(script|style)(?=[\s/>]){_INSIDE}>(?:(?<=[\s\"']/>)|.*?(?:</\1\s*+>|\Z))"
)
_TOKEN = re.compile(rf"{_OPAQUE}|<(/?)([a-zA-Z][^\s/>]*+)({_INSIDE})(?:>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S | re.I)
#: Elements that hold no text of the page: what embedded media show instead of themselves, templates, and controls of forms.
_DROPPED = frozenset("audio button canvas iframe noscript object select svg template textarea video".split())
_DROP = re.compile(rf"{_OPAQUE}|<(/?)({'|'.join(sorted(_DROPPED))})(?=[\s/>])({_INSIDE})(?:>|\Z)", re.S | re.I)
#: Containers that may be open at once; deeper ones are read like their siblings.
MAX_DEPTH = 100
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")
#: What a head may hold beside raw text; anything else ends it, as its end tag may be left out.
_HEAD = frozenset("base basefont bgsound html link meta title".split())
_TITLE = re.compile(r"(?:(?!<(?:/head|body|title)\b).)*?</title\s*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening the key closes an open tag of the values, as the markup's grammar has it.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_TOKENS = re.compile(r"[a-zA-Z]+")


@lru_cache(maxsize=50_000)
def _context(tag: str, attributes: str) -> tuple[str, ...]:
    """The tokens of a container in the tag path."""
    found = [tag]
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                found += [f".{t.lower()}" for t in _TOKENS.findall(a or b or c)]
            elif name == "hidden" or (name == "style" and "none" in (a or b or c)):
                found.append(".hidden")
    return tuple(found)


def _ends(page: str) -> dict[int, int]:
    """Where each dropped element ends, by where it starts; self-closed and unclosed ones are not listed."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for m in _DROP.finditer(page):
        if m[3] is None:
            continue
        tag = m[3].lower()
        if not m[2]:
            if not _SELF_CLOSED.search(m[4]):
                opened.setdefault(tag, []).append(m.start())
        elif opened.get(tag):
            out[opened[tag].pop()] = m.end()
    return out


class Block:
    __slots__ = ("linked", "path", "text")

    def __init__(self, text: str, path: tuple[tuple[str, ...], ...], linked: int) -> None:
        self.text, self.path, self.linked = text, path, linked


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order; texts have their references decoded and white space folded."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[str] = []
    deeper: dict[str, int] = {}  # containers that are open beyond the depth
    path: list[tuple[str, ...]] = []
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, tuple(path), min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(tag: str) -> None:
        if deeper.get(tag):
            deeper[tag] -= 1
        elif tag in stack:
            while stack.pop() != tag:
                path.pop()
            path.pop()

    at = 0
    ends: dict[int, int] | None = None
    head = title = False  # inside an open head; inside a title without end
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            piece = page[at : m.start()]
            if head and not title and not piece.isspace():
                head = False
            if not head:
                parts.append(piece)
                if links:
                    linked += len(piece)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        if page[at - 1] != ">":  # no tag, as nothing ends it
            at = m.start()
            break
        tag = tag.lower()
        if tag in _DROPPED and not m[2]:
            if ends is None:
                ends = _ends(page)
            at = ends.get(m.start(), at)
            continue
        if tag == "head":
            head, title = not m[2], False
            continue
        if head:
            title = False
            if tag in _HEAD:
                if tag == "title" and not m[2]:
                    whole = _TITLE.match(page, at)
                    at, title = (whole.end(), False) if whole else (at, True)
                continue
            head = False
        if tag == "a":
            links = 0 if m[2] else 1
        if tag not in _BLOCK:
            if tag == "br" or tag == "img" or tag == "input":
                parts.append(" ")
            continue
        flush()
        if m[2]:
            close(tag)
            links = 0
            continue
        if "p" in stack:  # a block ends an open paragraph
            close("p")
        for other in _CLOSES.get(tag, ()):
            if stack and stack[-1] == other:
                close(other)
        if tag not in _VOID and not m[4].endswith("/"):
            if len(stack) < MAX_DEPTH:
                stack.append(tag)
                path.append(_context(tag, m[4]))
            else:
                deeper[tag] = deeper.get(tag, 0) + 1
    if at < len(page) and not title:
        parts.append(page[at:])
    flush()
    return out


# ---------------------------------------------------------------- vectors


@lru_cache(maxsize=100_000)
def _slot(token: str, width: int) -> tuple[int, float]:
    h = zlib.crc32(token.encode("utf-8", "replace"))
    return (h >> 1) % width, 1.0 if h & 1 else -1.0


@lru_cache(maxsize=20_000)
def _path_vector(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
    out = np.zeros(PATH + OWN)
    for context in path:
        for token in context:
            k, s = _slot(token, PATH)
            out[k] += s
    for depth, context in enumerate(reversed(path[-2:])):
        for token in context:
            k, s = _slot(f"{depth}{token}", OWN)
            out[PATH + k] += s
    out[:PATH] = np.clip(out[:PATH], -2, 2)
    return out


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """One row per block of all pages."""
    every = [b for p in pages for b in p]
    out = np.zeros((len(every), WIDTH))
    if not every:
        return out
    out[:, : PATH + OWN] = [_path_vector(b.path) for b in every]
    # all words of all blocks at once
    n_words = np.array([b.text.count(" ") + 1 for b in every])
    h = word_hashes(" ".join(b.text for b in every).encode("utf-8", "replace"))
    if len(h) != n_words.sum():  # controls that only one side counts as white space
        n_words = np.array([len(word_hashes(b.text.encode("utf-8", "replace"))) for b in every])
    owner = np.repeat(np.arange(len(every)), n_words)
    slot, sign = ((h >> np.uint64(8)) % np.uint64(WORD)).astype(np.int64), np.where(h & np.uint64(1), 1.0, -1.0)
    hashed = np.bincount(owner * WORD + slot, sign, len(every) * WORD).reshape(-1, WORD)
    out[:, PATH + OWN : PATH + OWN + WORD] = np.clip(hashed / np.sqrt(np.maximum(1, n_words))[:, None], -2, 2)
    size = np.array([len(b.text) for b in every], dtype=float)
    linked = np.array([b.linked for b in every])
    marks = np.array([b.text.count(".") + b.text.count(",") for b in every])
    end = np.array([b.text[-1] in ".!?:;\"" for b in every])
    depth = np.array([len(b.path) for b in every])
    place = np.concatenate([np.linspace(0, 1, len(p)) for p in pages if p])
    page_size = np.concatenate([np.full(len(p), float(len(p))) for p in pages if p])
    share = np.concatenate([(s := np.array([len(b.text) for b in p], dtype=float)) / s.sum() for p in pages if p])
    upper = np.array([b.text[:1].isupper() for b in every])
    out[:, PATH + OWN + WORD :] = np.stack([
        np.log1p(size) / 4, np.log1p(n_words) / 3, linked / size, np.minimum(1, 10 * marks / size), end, depth / 8, place,
        np.log1p(page_size) / 4, share, upper, n_words < 4, linked > 0.8 * size,
    ], axis=1)
    return out


# ---------------------------------------------------------------- the network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one per direction, and a logistic layer on their states and the input."""

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.standard_normal(shape) / np.sqrt(shape[0])
        self.w: dict[str, np.ndarray] = {}
        for d in "fb":
            self.w[f"x{d}"], self.w[f"h{d}"] = draw(WIDTH, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)
            self.w[f"b{d}"] = np.concatenate((np.ones(HIDDEN), np.zeros(3 * HIDDEN)))  # forget gate open
        self.w["out"], self.w["direct"], self.w["bias"] = draw(2 * HIDDEN), np.zeros(WIDTH), np.zeros(1)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, cache: list | None = None) -> np.ndarray:
        """x: pages x steps x width; padded steps leave the state as it is."""
        n, steps, _ = x.shape
        gates_x = x @ self.w[f"x{d}"] + self.w[f"b{d}"]
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        out = np.zeros((n, steps, HIDDEN))
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates_x[:, t] + h @ self.w[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            f, i, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new_c = f * c + i * g
            tc = np.tanh(new_c)
            if cache is not None:
                cache.append((t, f, i, o, g, c, h, tc, m))
            c = m * new_c + (1 - m) * c
            h = m * (o * tc) + (1 - m) * h
            out[:, t] = h
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, caches: dict | None = None) -> np.ndarray:
        own = caches if caches is not None else {"f": None, "b": None}
        states = np.concatenate([self._run(x, mask, d, own[d]) for d in "fb"], axis=2)
        if caches is not None:
            caches["states"] = states
        return _sigmoid(states @ self.w["out"] + x @ self.w["direct"] + self.w["bias"][0])

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        caches: dict = {"f": [], "b": []}
        p = self.forward(x, mask, caches)
        total = mask.sum()
        dz = (p - y) * mask / total
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        grad["out"] = np.einsum("ns,nsh->h", dz, caches["states"])
        grad["direct"] = np.einsum("ns,nsw->w", dz, x)
        grad["bias"] = np.array([dz.sum()])
        for k, d in enumerate("fb"):
            out = self.w["out"][k * HIDDEN : (k + 1) * HIDDEN]
            dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
            d_gates = np.zeros((*x.shape[:2], 4 * HIDDEN))
            for t, f, i, o, g, c, h, tc, m in reversed(caches[d]):
                dh = dh + dz[:, t, None] * out
                d_own, d_c = dh * m, dc * m + dh * m * o * (1 - tc**2)
                d_gate = np.concatenate(
                    (d_c * c * f * (1 - f), d_c * g * i * (1 - i), d_own * tc * o * (1 - o), d_c * i * (1 - g**2)), axis=1
                )
                d_gates[:, t] = d_gate
                grad[f"h{d}"] += h.T @ d_gate
                dh, dc = d_gate @ self.w[f"h{d}"].T + dh * (1 - m), d_c * f + dc * (1 - m)
            grad[f"x{d}"] = np.einsum("nsw,nsg->wg", x, d_gates)
            grad[f"b{d}"] = d_gates.sum(axis=(0, 1))
        return grad

    def probabilities(self, pages: list[list[Block]], padded: int = 6000) -> list[np.ndarray]:
        """Per page the probability of each block, in batches of pages of similar length."""
        x = vectors(pages)
        starts = np.concatenate(([0], np.cumsum([len(p) for p in pages])))
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            take, order = order[-max(1, padded // longest) :], order[: -max(1, padded // longest)]
            batch, mask = _padded([x[starts[i] : starts[i + 1]] for i in take])
            p = self.forward(batch, mask)
            for row, i in enumerate(take):
                out[i] = p[row, : len(pages[i])]
        return out


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, rows))
    x, mask = np.zeros((len(rows), longest, WIDTH)), np.zeros((len(rows), longest))
    for k, r in enumerate(rows):
        x[k, : len(r)], mask[k, : len(r)] = r, 1
    return x, mask


def fit(pages: list[list[Block]], labels: list[list[int]], epochs: int = EPOCHS) -> Labeller:
    """Adam on the mean logistic loss, over batches of pages of similar length."""
    net = Labeller()
    data = [(vectors([p]), np.array(y, dtype=float)) for p, y in zip(pages, labels) if p]
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    rng, step = random.Random(SEED), 0
    for _ in range(epochs):
        order = sorted(range(len(data)), key=lambda i: len(data[i][1]) + rng.random() * 12)
        batches = [order[k : k + 24] for k in range(0, len(order), 24)]
        rng.shuffle(batches)
        for batch in batches:
            x, mask = _padded([data[i][0] for i in batch])
            y = np.zeros(mask.shape)
            for k, i in enumerate(batch):
                y[k, : len(data[i][1])] = data[i][1]
            step += 1
            for k, g in net.gradient(x, mask, y).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.w[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


# ---------------------------------------------------------------- training pages

_ARTICLE = frozenset(("article", "main", ".articlebody", ".main"))
# Words that mark up page furniture.
_FURNITURE_TAGS = ("nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "label")
_FURNITURE_WORDS = (
    "ad ads advert advertisement banner sponsor promo nav navigation menu breadcrumb breadcrumbs sidebar widget related recommended share "
    "social footer header masthead topbar cookie cookies consent notice alert popup modal newsletter subscribe signup login search comment "
    "comments reply replies discussion respond pagination pager tags copyright legal hidden".split()
)
_FURNITURE = frozenset((*_FURNITURE_TAGS, *(f".{w}" for w in _FURNITURE_WORDS)))


def taught(page: list[Block]) -> list[int] | None:
    """Labels by semantic containers; none if the page has no article container."""
    if not any(t in _ARTICLE for b in page for c in b.path for t in c):
        return None
    out = []
    for b in page:
        inside = any(t in _ARTICLE for c in b.path for t in c)
        furniture = any(t in _FURNITURE for c in b.path for t in c) or any(
            c[0] == "header" and not any(t in _ARTICLE for o in b.path[: k + 1] for t in o) for k, c in enumerate(b.path)
        )
        out.append(int(inside and not furniture))
    return out


def _made_up(texts: list[list[str]], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A page around one of the sample's articles, with containers and furniture drawn at random."""
    article = rng.choice(texts)
    words = " ".join(rng.choice(texts)).split() or ["text"]

    def phrase(low: int, high: int, end: str = "") -> str:
        k = rng.randint(low, high)
        at = rng.randrange(max(1, len(words) - k))
        return " ".join(words[at : at + k]) + end

    def furniture(inside: bool = False) -> str:
        kind = rng.choice(("menu", "notice", "form", "advert", "aside", "comments", "header", "footer", "related"))
        if inside:
            kind = rng.choice(("advert", "comments", "comments", "form", "aside", "aside", "related", "notice", "menu"))
        name = {
            "menu": ("nav", "menu", "navigation", "breadcrumbs"), "notice": ("notice", "cookie", "consent", "alert"),
            "form": ("newsletter", "login", "search", "subscribe"), "advert": ("ad", "advert", "sponsor", "banner", "promo"),
            "aside": ("sidebar", "widget"), "comments": ("comments", "discussion", "replies"), "header": ("header", "masthead", "topbar"),
            "footer": ("footer", "copyright", "legal"), "related": ("related", "recommended", "share"),
        }[kind]
        tag = {"menu": "nav", "form": "form", "aside": "aside", "header": "header", "footer": "footer"}.get(kind, "section")
        cue = f'{rng.choice(("class", "id"))}="{rng.choice(name)}"'
        opening = rng.choice((f"<{tag}>" if tag != "section" else f"<section {cue}>", f"<div {cue}>", f"<{tag} {cue}>"))
        closing = f"</{re.match('<([a-z]+)', opening)[1]}>"
        if kind in ("menu", "related"):
            body = "<ul>" + "".join(f'<li><a href="/x">{phrase(1, 4)}</a></li>' for _ in range(rng.randint(2, 7))) + "</ul>"
        elif kind == "form":
            body = f"<p>{phrase(2, 8)}</p><label>{phrase(1, 2)}</label><input name='q'><button>{phrase(1, 2)}</button>"
        elif kind == "comments":
            body = f"<h3>{phrase(1, 3)}</h3>" + "".join(
                rng.choice((f"<div class='comment'><p>{phrase(3, 40, '.')}</p></div>", f"<p>{phrase(3, 40, '.')}</p>")) for _ in range(rng.randint(1, 5))
            )
        elif kind == "footer":
            line = f"&copy; {phrase(1, 3)} &middot; {phrase(2, 12, '.')}"
            body = rng.choice((line, f"<p>{line}</p>", f"<p>{phrase(1, 12, '.')}</p><ul><li><a href='/z'>{phrase(1, 2)}</a></li></ul>", f"<div><p>{phrase(2, 9)}</p></div>"))
        else:
            body = rng.choice((f"<p>{phrase(3, 30, '.')}</p>", phrase(3, 25, "."), f"<div>{phrase(3, 15)} <a href='/y'>{phrase(1, 3)}</a></div>"))
        return opening + body + closing

    mark = "\x00"  # begins each block of the article, so that its label can be read off
    tag, cue = rng.choice((("article", ""), ("main", ""), ("div", ' class="content"'), ("div", ' class="post"'), ("section", ' id="story"'), ("div", ""), ("div", ' class="entry body"')))
    inner = [f"<h1>{mark}{html.escape(phrase(3, 9))}</h1>"] if rng.random() < 0.8 else []
    for line in article:
        kind = rng.random()
        shown = mark + html.escape(line)
        inner.append(f"<li>{shown}</li>" if kind < 0.05 else f"<blockquote>{shown}</blockquote>" if kind < 0.08 else f"<h2>{shown}</h2>" if kind < 0.12 else f"<p>{shown}</p>")
        if rng.random() < 0.06:
            inner.append(furniture(inside=True))
    if rng.random() < 0.5:
        inner.append(furniture(inside=True))
    before = "".join(furniture() for _ in range(rng.randint(0, 3)))
    after = "".join(furniture() for _ in range(rng.randint(0, 4)))
    if rng.random() < 0.5:
        tag_open = f"<{tag}{cue}>"
        page = f"<html><body>{before}{tag_open}{''.join(inner)}</{tag}>{after}</body></html>"
    else:
        page = f"<html><body><div class='{rng.choice(('wrap', 'page', 'container', 'site'))}'>{before}<{tag}{cue}>{''.join(inner)}</{tag}>{after}</div></body></html>"
    found = blocks(page)
    labels = [int(mark in b.text) for b in found]
    for b in found:
        b.text = b.text.replace(mark, "") or "."
    return found, labels


def train(pages: list[str], made_up: int = 700) -> Labeller:
    """Learns from at most ``MAX_TRAIN`` pages and made-up ones around their texts."""
    data, labels = [], []
    texts: list[list[str]] = []
    for page in pages[:MAX_TRAIN]:
        own = blocks(page)
        y = taught(own)
        if y is None:
            continue
        data.append(own)
        labels.append(y)
        texts.append([b.text for b, k in zip(own, y) if k])
    rng = random.Random(SEED)
    syllables = "an be co du el fi go ha in ju ka lo mi no or pa qui re so ta un ve".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    texts = [t for t in texts if t] or [
        [" ".join(word() for _ in range(rng.randint(4, 60))).capitalize() + "." for _ in range(rng.randint(1, 15))] for _ in range(60)
    ]
    texts = [t[:40] for t in texts]
    for _ in range(made_up):
        own, y = _made_up(texts, rng)
        data.append(own)
        labels.append(y)
    return fit(data, labels)


def sample(pages: DataFrame, n: int = MAX_TRAIN) -> list[str]:
    """The html of the ``n`` pages of least hash; only their hashes are ranked, so only they travel."""
    rows = pages.where("html is not null").select(F.xxhash64("page_id").alias("h"), "html")
    last = least_hashed(rows.select("h"), n, "h").agg(F.max(F.xxhash64("h"))).first()[0]
    if last is None:
        return []
    chosen = rows.where(F.xxhash64("h") <= last).select("h", F.xxhash64("html").alias("h2"), "html")
    # pages of one id follow each other by their contents, and equal ones count once
    return [r["html"] for r in chosen.dropDuplicates(["h", "h2"]).orderBy("h", "h2").limit(n).collect()]


def extract(pages: DataFrame, net: Labeller, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the article text; all other columns pass through, the html goes."""
    if text_col != html_col:
        pages = with_room(pages, text_col)
    held = pages.sparkSession.sparkContext.broadcast(net)
    at = pages.columns.index(html_col)
    others = [c for c in pages.columns if c != html_col]
    schema = schema_with(pages.select(*others), **{text_col: "string"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            column, texts = batch.column(at), []
            for k in range(0, batch.num_rows, 256):
                found = [blocks(x.as_py()) for x in column.slice(k, 256)]
                for page, p in zip(found, model.probabilities(found)):
                    texts.append("\n".join(b.text for b, q in zip(page, p) if q >= 0.5))
            rest = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], [*others, text_col])

    return arrow_map(pages, run, schema)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    net = train(sample(pages))
    return extract(pages, net).withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES = {"op1_html_text": op1_html_text}
