"""Main text of web pages: a recurrent network labels every block of a page."""

from __future__ import annotations

import html
import io
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callflow.llm.shared import importable, word_bounds, word_hashes

#: Pages of the table that the network is trained on, at most, and pages made up from their sentences.
TRAIN_PAGES = 200
MADE_PAGES = 1600
WORDS, NUMBERS = 24, 8
HIDDEN = 20
EPOCHS = 12

# Elements that do not end a block, that have no content, and whose content is no text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark "
    "q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head noscript object option script select style svg template textarea title iframe canvas".split())
RAW = frozenset("script style textarea title iframe".split())
#: An element that begins ends these open ones, up to the nearest of the others.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*|[^>]*)>",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
_SPLIT = re.compile(r"[^a-z]+")


@dataclass
class Block:
    """Text between two block boundaries, with the open elements there."""

    path: tuple[str, ...]
    text: str
    linked: int = 0


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)


def _element(tag: str, rest: str) -> str:
    """An element with its names: ``div cookie notice``."""
    if "=" not in rest:
        return tag
    names = " ".join(m.group(1) for m in _NAMES.finditer(rest))
    names = re.sub(r"([a-z])([A-Z])", r"\1 \2", html.unescape(names)).lower()
    return " ".join([tag, *filter(None, _SPLIT.split(names))])


def page_blocks(source: str) -> list[Block]:
    """The blocks of a page in order, white space made single, references decoded.

    Elements that are not closed end as in browsers; stray ends are passed over.
    """
    blocks: list[Block] = []
    stack: list[str] = []  # elements with names
    tags: list[str] = []
    silent = links = 0
    parts: list[str] = []
    linked: list[str] = []
    path: tuple[str, ...] = ()

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(path, text, len("".join(linked))))
            parts, linked = [], []

    def pop(to: int) -> None:
        nonlocal silent, links
        for t in tags[to:]:
            silent -= t in SILENT
            links -= t == "a"
        del tags[to:], stack[to:]

    at, end = 0, len(source)
    while at < end:
        found = _MARKUP.search(source, at)
        stop = found.start() if found else end
        if stop > at and not silent:
            if not parts:
                path = tuple(stack)
            parts.append(html.unescape(source[at:stop]))  # a reference does not reach over markup
            if links:
                linked.append(parts[-1])
        if not found:
            break
        at = found.end()
        tag = found.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if not inline:
            flush()
        if found.group("end"):
            if tag in tags:
                pop(len(tags) - 1 - tags[::-1].index(tag))
            continue
        if not inline and "p" in tags and tag not in VOID - {"hr"}:
            k = len(tags) - 1 - tags[::-1].index("p")
            if not {"button", "td", "th", "table", "object"} & set(tags[k:]):
                pop(k)
        closes, bounds = ENDS.get(tag, ((), ()))
        if closes:
            k = len(tags) - 1
            last = None
            while k >= 0 and tags[k] not in bounds:
                if tags[k] in closes:
                    last = k
                k -= 1
            if last is not None:
                pop(last)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
            at = close.end() if close else end
            continue
        if found.group("rest").endswith("/") and tag in ("svg", "path"):
            continue
        stack.append(_element(tag, found.group("rest")))
        tags.append(tag)
        silent += tag in SILENT
        links += tag == "a"
    flush()
    return blocks


# What pages are made of for training: names of parts that hold the article, and of parts that do not.
ARTICLE_PARTS = (
    "article|main|main;article|div.article|div.article body|div.post|div.post content|div.entry content|div.story"
    "|div.story body|div#content|div.main content;article|section.article|div.text|main;div.content|article;div.body"
    "|article;section|div.page;article|div.container;article|div.wrapper;main;article"
).split("|")
OTHER_PARTS = (
    "nav|nav.menu|div.menu|div.navigation|ul.nav|div.navbar|div.breadcrumbs|header|header.site header|div.header"
    "|div.masthead|div.banner|div.topbar|footer|footer.site footer|div.footer|div.copyright|div#footer|aside"
    "|aside.sidebar|div.sidebar|div#sidebar|div.widget|div.related|div.related posts|div.recommended|section.related"
    "|div.notice|div.cookie|div.cookie notice|div.cookie banner|div.consent|div.gdpr|div.alert|div.warning"
    "|div.paywall|div.popup|div.modal|div.ad|div.ads|div.advert|div.advertisement|aside.ad|div.sponsored|div.promo"
    "|div.promotion|section.ad|form|form.search|form.login|form.newsletter|div.newsletter;form|div.subscribe"
    "|div.signup|section.comments|div.comments|div#comments|div.comment|div.comment list|ol.comments|ul.comments"
    "|div.reply|div.replies|div.disqus|div#disqus thread|div.discussion|div.reader comments|div.responses|div.feedback"
    "|div.user reviews|div.share|div.social|div.tags|div.author bio|div.pagination|div.toolbar|div.disclaimer|div.legal"
    "|div.teaser|div.teasers|div.trending|div.most read|div.sponsor|div.partner content|div.outbrain|div.taboola"
    "|div.site notice|div#cookie consent|div.privacy notice|div.message|form.comment form|form.contact|form#poll"
    "|div.hatnote|div.toc|div.navbox|table.infobox|div.dialog|div.toast|div.drawer|div.carousel|div.ticker|div.bio"
    "|div@navigation|div@banner|div@complementary|section@complementary|div@contentinfo|div@search|div@form|div@note"
    "|div@alert|div@dialog|div@alertdialog|div@menu|ul@menubar|div@toolbar|div@status"
).split("|")
WRAPPERS = "div.page|div#wrapper|div.container|div.site;div.layout|div@main|div@document|div.row;div.col".split("|")
ROLE_PARTS = [part for part in OTHER_PARTS if "@" in part]
#: The names of each of the other parts, without tags.
OTHER_NAMES = {frozenset(n.split()) for part in OTHER_PARTS for n in re.findall(r"[.#@]([^;]+)", part)}
# Elements that the network tells apart.
ELEMENTS = (
    "a abbr address article aside b blockquote button caption center cite code dd del details dialog div dl dt em fieldset "
    "figcaption figure font footer form h1 h2 h3 h4 h5 h6 header hgroup i ins kbd label legend li main mark menu nav ol p "
    "pre q s section small span strong sub summary sup table tbody td tfoot th thead time tr u ul"
).split()
#: Names that the network tells apart: those of the parts. All others are one and the same to it.
NAMES = sorted(
    {n for part in (*ARTICLE_PARTS, *OTHER_PARTS, *WRAPPERS) for names in re.findall(r"[.#@]([^;]+)", part) for n in names.split()}
)
_PLACES = {f"<{e}": k for k, e in enumerate(ELEMENTS)} | {n: len(ELEMENTS) + k for k, n in enumerate(NAMES)}
_LAST = len(_PLACES)  # places of the last block element follow
OTHER_NAME, OTHER_ELEMENT = _LAST + len(ELEMENTS), _LAST + len(ELEMENTS) + 1
TAGS = OTHER_ELEMENT + 1
LABELS = "Home|About|Contact|Search|Log in|Sign up|Share|Subscribe|Next|Previous|Privacy|Terms|Reply|More|Menu|Send".split("|")


_PATHS: dict[tuple[str, ...], np.ndarray] = {}


def path_features(path: tuple[str, ...]) -> np.ndarray:
    """Places of the elements and names on a path, and of its last block element.

    Every element and name that training does not know has the same place as any other, so that a
    made-up class never looks like one that tells something.
    """
    known = _PATHS.get(path)
    if known is None:
        places = set()
        for element in path:
            tag, *names = element.split(" ")
            if tag not in ("html", "body"):
                places.add(_PLACES.get("<" + tag, OTHER_ELEMENT))
                places.update(_PLACES.get(n, OTHER_NAME) for n in names)
        block = [e.split(" ", 1)[0] for e in path]
        block = [e for e in block if e not in INLINE]
        if block and f"<{block[-1]}" in _PLACES:
            places.add(_LAST + _PLACES[f"<{block[-1]}"])
        if len(_PATHS) > 100_000:
            _PATHS.clear()
        known = _PATHS[path] = np.array(sorted(places), np.int64)
    return known


def page_features(blocks: list[Block]) -> np.ndarray:
    """A row per block: tag path, hashed words, and numbers such as length and link share."""
    out = np.zeros((len(blocks), TAGS + WORDS + NUMBERS), np.float32)
    if not blocks:
        return out
    for k, block in enumerate(blocks):
        out[k, path_features(block.path)] = 1
    data = [b.text.encode() for b in blocks]
    joined = b"\n".join(data)
    hashes = word_hashes(joined)
    begins = np.cumsum([0, *(len(d) + 1 for d in data)])
    starts = word_bounds(np.frombuffer(joined, np.uint8))[0][: len(hashes)]
    row = np.searchsorted(begins, starts, "right") - 1
    place = (hashes % np.uint64(WORDS)).astype(np.int64)
    counts = np.bincount(row * WORDS + place, minlength=len(blocks) * WORDS).reshape(len(blocks), WORDS)
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    out[:, TAGS : TAGS + WORDS] = counts / np.sqrt(total)
    length = np.array([len(b.text) for b in blocks], np.float32)
    numbers = out[:, TAGS + WORDS :]
    numbers[:, 0] = np.log1p(length) / 6
    numbers[:, 1] = np.array([b.linked for b in blocks], np.float32) / np.maximum(length, 1)
    numbers[:, 2] = np.log1p(total[:, 0]) / 5
    numbers[:, 3] = [b.text.endswith((".", "!", "?", ":", '"')) for b in blocks]
    numbers[:, 4] = np.arange(len(blocks)) / len(blocks)
    numbers[:, 5] = np.log1p(len(blocks)) / 5
    numbers[:, 6] = [sum(map(b.text.count, "0123456789")) / len(b.text) for b in blocks]
    numbers[:, 7] = length / max(1.0, float(length.sum()))
    return np.minimum(out, 4)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """A bidirectional LSTM over the blocks of a page, and a logistic output per block."""

    def __init__(self, inputs: int = TAGS + WORDS + NUMBERS, hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)

        def matrix(rows, columns):
            return (rng.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

        self.hidden = hidden
        self.weights = {"out": matrix(2 * hidden, 1), "out_b": np.zeros(1, np.float32)}
        for way in ("forward", "backward"):
            self.weights[way] = matrix(inputs + hidden, 4 * hidden)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1
            self.weights[way + "_b"] = bias

    @staticmethod
    def _turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each sequence of ``x[time, page]`` backwards; what follows its end stays."""
        steps = np.arange(len(x))[:, None]
        index = np.where(steps < lengths, lengths - 1 - steps, steps)
        return np.take_along_axis(x, index[:, :, None], axis=0)

    def _run(self, way: str, x: np.ndarray):
        h = self.hidden
        w, b = self.weights[way], self.weights[way + "_b"]
        steps, pages, inputs = x.shape
        ahead = x.reshape(-1, inputs) @ w[:inputs] + b
        ahead = ahead.reshape(steps, pages, 4 * h)
        out, state = np.zeros((pages, h), np.float32), np.zeros((pages, h), np.float32)
        outs, keep = np.zeros((steps, pages, h), np.float32), []
        for t in range(steps):
            z = ahead[t] + out @ w[inputs:]
            gates = _sigmoid(z[:, : 3 * h])
            new = np.tanh(z[:, 3 * h :])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            before, last = state, out
            state = f * state + i * new
            shown = np.tanh(state)
            out = o * shown
            outs[t] = out
            keep.append((i, f, o, new, before, shown, last))
        return outs, keep

    def _back(self, way: str, x: np.ndarray, keep: list, grad: np.ndarray, into: dict) -> None:
        h = self.hidden
        w = self.weights[way]
        steps, pages, inputs = x.shape
        d_out, d_state = np.zeros((pages, h), np.float32), np.zeros((pages, h), np.float32)
        d_z = np.zeros((steps, pages, 4 * h), np.float32)
        d_w = np.zeros_like(w)
        for t in reversed(range(steps)):
            i, f, o, new, before, shown, last = keep[t]
            d = grad[t] + d_out
            d_state = d_state + d * o * (1 - shown * shown)
            z = d_z[t]
            z[:, :h] = d_state * new * i * (1 - i)
            z[:, h : 2 * h] = d_state * before * f * (1 - f)
            z[:, 2 * h : 3 * h] = d * shown * o * (1 - o)
            z[:, 3 * h :] = d_state * i * (1 - new * new)
            d_w[inputs:] += last.T @ z
            d_out = z @ w[inputs:].T
            d_state = d_state * f
        d_w[:inputs] = x.reshape(-1, inputs).T @ d_z.reshape(-1, 4 * h)
        into[way] = d_w
        into[way + "_b"] = d_z.sum(axis=(0, 1))

    def _both(self, x: np.ndarray, lengths: np.ndarray):
        ahead, keep_a = self._run("forward", x)
        turned = self._turned(x, lengths)
        back, keep_b = self._run("backward", turned)
        states = np.concatenate([ahead, self._turned(back, lengths)], axis=2)
        logits = (states @ self.weights["out"])[:, :, 0] + self.weights["out_b"][0]
        return logits, states, turned, keep_a, keep_b

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """A probability per block of each page; pages of similar length run together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * len(pages[order[stop]]) <= 8192:
                stop += 1
            some = order[at:stop]
            x, lengths = _padded([pages[k] for k in some])
            found = _sigmoid(self._both(x, lengths)[0])
            for j, k in enumerate(some):
                out[k] = found[: len(pages[k]), j]
            at = stop
        return out

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 4) -> None:
        """Adam on the mean log loss per block; those labelled -1 do not count."""
        rng = random.Random(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        step, size = 0, 24
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        groups = [order[k : k + size] for k in range(0, len(order), size)]
        for epoch in range(epochs):
            rng.shuffle(groups)
            for group in groups:
                x, lengths = _padded([pages[k] for k in group])
                y, _ = _padded([labels[k][:, None].astype(np.float32) for k in group])
                mask = (np.arange(len(x))[:, None] < lengths) & (y[:, :, 0] >= 0)
                logits, states, turned, keep_a, keep_b = self._both(x, lengths)
                error = ((_sigmoid(logits) - y[:, :, 0]) * mask / max(1, mask.sum())).astype(np.float32)
                grads = {
                    "out": np.einsum("tbh,tb->h", states, error)[:, None],
                    "out_b": np.array([error.sum()], np.float32),
                }
                d = error[:, :, None] * self.weights["out"][:, 0]
                self._back("forward", x, keep_a, d[:, :, : self.hidden], grads)
                self._back("backward", turned, keep_b, self._turned(d[:, :, self.hidden :], lengths), grads)
                step += 1
                rate = 0.01 * (0.5 if epoch >= epochs - 2 else 1)
                for name, g in grads.items():
                    m, v = moments[name]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.weights[name] -= (
                        rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                    ).astype(np.float32)


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    x = np.zeros((lengths.max(), len(rows), rows[0].shape[1]), np.float32)
    for j, r in enumerate(rows):
        x[: len(r), j] = r
    return x, lengths


_SYLLABLES = "ba co di fle gra hu jo kri lo mu nex pla qui ro sta tri vo wi xo yel zu".split()
_UTILITIES = "mt-4|u-px2|col-md-8|css-1x2y3z|sc-bdVaJa|jsx-41|x|b12|f-g|is-on|l-s2|w-100|d-flex|js-k|c-0".split("|")


def made_name(rng: random.Random) -> str:
    """A class that tells nothing."""
    if rng.random() < 0.3:
        return rng.choice(_UTILITIES)
    name = "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))
    return rng.choice([name, name, f"{rng.choice('abcmtuxz')}-{name}", f"{name}{rng.randint(1, 99)}", name.title()])


def made_names(rng: random.Random, most: int = 4) -> str:
    return " ".join(made_name(rng) for _ in range(rng.randint(1, most)))


def _open(part: str, more: str = "") -> tuple[str, str]:
    """The tags of a part; ``more`` are classes besides, on its first element."""
    start = end = ""
    for k, piece in enumerate(part.split(";")):
        tag, kind, names = re.fullmatch(r"(\w+)([.#@]?)(.*)", piece).groups()
        classes = more if k == 0 else ""
        if kind == ".":
            classes = f"{names.replace(' ', '-')} {classes}".strip()
        attributes = f' class="{classes}"' if classes else ""
        if kind in ("#", "@") and kind:
            attributes += f' {"id" if kind == "#" else "role"}="{names.replace(" ", "-") if kind == "@" else names}"'
        start, end = f"{start}<{tag}{attributes}>", f"</{tag}>{end}"
    return start, end


def _neutral(rng: random.Random) -> tuple[str, str]:
    """One or two elements that tell nothing, or only that they are some part of the page."""
    tags = [rng.choice(["div", "div", "div", "section", "main"]) for _ in range(rng.randint(1, 3))]
    opened = [f'<{t} class="{made_names(rng)}">' if rng.random() < 0.8 else f"<{t}>" for t in tags]
    return "".join(opened), "".join(f"</{t}>" for t in reversed(tags))


def made_page(sentences: list[str], rng: random.Random) -> tuple[str, str]:
    """A page made up from sentences, with U+0001 before each block of its article.

    Classes that tell nothing stand on articles, on what surrounds and divides them, and on other
    parts alike; other parts without any telling name or element hold links or labels only.
    """

    def prose(least: int, most: int) -> str:
        return html.escape(" ".join(rng.choice(sentences) for _ in range(rng.randint(least, most))))

    def tag(name: str) -> str:
        return f'<{name} class="{made_names(rng, 2)}">' if rng.random() < named else f"<{name}>"

    def paragraphs(mark: str, inside: str) -> str:
        out = []
        if rng.random() < 0.8:
            out.append(f"<h{(k := rng.choice('112'))}>{mark}{prose(1, 1)}</h{k}>")
            if inside and rng.random() < 0.15:
                out.append(other())
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            text = prose(1, 6)
            if kind < 0.12:
                out.append(f"{tag('ul')}{''.join(f'<li>{mark}{prose(1, 2)}</li>' for _ in range(rng.randint(2, 4)))}</ul>")
            elif kind < 0.2:
                out.append(f"<blockquote><p>{mark}{text}</p></blockquote>")
            elif kind < 0.28:
                out.append(f"<h{(k := rng.choice('234'))}>{mark}{prose(1, 1)}</h{k}>")
            elif kind < 0.4:
                out.append(f"<p><b>{mark}{text}<br><p>{mark}{prose(1, 5)}</p>")
            elif kind < 0.46:
                out.append(f"<p>{mark}{text}<br>{mark}{prose(1, 3)}</p>")
            elif kind < 0.5:
                out.append(f"{tag('div')}{mark}{text}</div>")
            elif kind < 0.54:
                out.append(f"<table><tr><td>{mark}{prose(1, 1)}</td><td>{mark}{prose(1, 1)}</td></tr></table>")
            elif kind < 0.6:
                start, end = _neutral(rng)
                out.append(f"{start}<p>{mark}{text}</p><p>{mark}{prose(1, 4)}</p>{end}")
            else:
                out.append(f"{tag('p')}{mark}{text}</p>")
            if inside and rng.random() < 0.3:
                out.append(other())
        return "".join(out)

    def other() -> str:
        part = rng.choice(ROLE_PARTS if rng.random() < 0.2 else OTHER_PARTS)
        start, end = _open(part, made_names(rng) if rng.random() < 0.35 else "")
        kind = rng.random()
        if rng.random() < 0.12:  # nothing tells but what it holds
            part, kind = "", kind * 0.3
            start, end = _neutral(rng)
        if kind < 0.3:
            inner = "".join(f'<li><a href="/x">{rng.choice([prose(1, 1)[:25], rng.choice(LABELS)])}</a></li>' for _ in range(rng.randint(2, 8)))
            inner = f"<ul>{inner}</ul>"
        elif kind < 0.5:
            inner = prose(1, 3)
        elif kind < 0.6 or "form" in part:
            inner = f"<label>{rng.choice(LABELS)}</label><input><p>{prose(1, 1)}</p><button>{rng.choice(LABELS)}</button>"
        else:
            inner = "".join(f"{tag('p')}{prose(1, 5)}</p>" for _ in range(rng.randint(1, 5)))
            if rng.random() < 0.3:
                inner = f"<h3>{rng.choice(LABELS)}</h3>{inner}"
        if inner and rng.random() < 0.2:
            around = _neutral(rng)
            inner = f"{around[0]}{inner}{around[1]}"
        return f"{start}{inner}{end}"

    named = rng.choice([0, 0.1, 0.1, 0.9])  # on some pages every paragraph has a class
    if rng.random() < 0.5:
        start, end = _neutral(rng)
        if rng.random() < 0.4:
            start, end = ("<article>" + start, end + "</article>") if rng.random() < 0.5 else (start + "<article>", "</article>" + end)
    else:
        start, end = _open(rng.choice(ARTICLE_PARTS), made_names(rng) if rng.random() < 0.35 else "")
    above = "".join(other() for _ in range(rng.randint(0, 4)))
    below = "".join(other() for _ in range(rng.randint(0, 5)))
    body = f"{above}{start}{paragraphs(chr(1), 'inside')}{end}{below}"
    if rng.random() < 0.4:
        wrap = _open(rng.choice(WRAPPERS), made_names(rng) if rng.random() < 0.5 else "") if rng.random() < 0.6 else _neutral(rng)
        body = f"{wrap[0]}{body}{wrap[1]}"
    return f"<html><head><title>{prose(1, 1)}</title></head><body>{body}</body></html>", "\x01"


def article_label(path: tuple[str, ...]) -> int:
    """What an article element tells of a block: 1 main text, 0 not, -1 not known.

    Navigation and asides are not, nor are forms and further articles inside the article. A footer,
    and an element named as the other parts are, may be either: the made-up pages decide.
    """
    tags = [e.split(" ", 1)[0] for e in path]
    if "article" not in tags:
        return 0
    inside = tags[tags.index("article") + 1 :]
    if {"nav", "aside"} & set(tags) or {"form", "article"} & set(inside):
        return 0
    named = (set(e.split(" ")[1:]) for e, t in zip(path, tags, strict=True) if t not in ("html", "body"))
    if "footer" in tags or any(part <= names for names in named for part in OTHER_NAMES):
        return -1
    return 1


def labelled(sources: list[str], made: int = MADE_PAGES, seed: int = 12) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Blocks and labels (see ``article_label``): pages as they are, where an article element tells, and made-up ones."""
    pages, labels, sentences = [], [], []
    for source in sources:
        blocks = page_blocks(source.replace("\x01", " "))
        sentences += [s for b in blocks for s in re.split(r"(?<=[.!?]) ", b.text) if 0 < len(s) <= 400]
        main = np.array([article_label(b.path) for b in blocks], np.int8)
        if (main == 1).any():
            pages.append(blocks)
            labels.append(main)
    rng = random.Random(seed)
    sentences = sentences or ["A line of text."]
    for _ in range(made):
        source, mark = made_page(sentences, rng)
        blocks = page_blocks(source)
        pages.append([Block(b.path, b.text.replace(mark, ""), b.linked) for b in blocks])
        labels.append(np.array([mark in b.text for b in blocks], np.int8))
    return pages, labels


def train_labeller(sources: list[str], made: int = MADE_PAGES) -> BlockLabeller:
    pages, labels = labelled(sources, made)
    features = [page_features(blocks) for blocks in pages]
    model = BlockLabeller()
    model.train(features, labels)
    return model


def _saved(model: BlockLabeller) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model.weights)
    return out.getvalue()


def _loaded(data: bytes) -> BlockLabeller:
    model = BlockLabeller()
    with np.load(io.BytesIO(data)) as stored:
        model.weights = {k: stored[k] for k in stored.files}
    return model


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sources = [h for batch in batches for h in batch["html"].to_pylist()]
    if sources:
        yield pa.RecordBatch.from_arrays([pa.array([_saved(train_labeller(sources))], pa.binary())], names=["weights"])


#: A block is text from here on, or, where no block of a page is, from the lower bound on.
LIKELY, AT_LEAST = 0.4, 0.2


def main_text(blocks: list[Block], probabilities: np.ndarray) -> str:
    bound = LIKELY if (probabilities >= LIKELY).any() else AT_LEAST
    return "\n".join(b.text for b, p in zip(blocks, probabilities, strict=True) if p >= bound)


def _extract(model: BlockLabeller, carry: list[str]):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                pages = [page_blocks(h or "") for h in part["html"].to_pylist()]
                found = model.probabilities([page_features(p) for p in pages])
                texts = [main_text(p, f) for p, f in zip(pages, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part[c] for c in carry],
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([len(p) for p in pages], pa.int64()),
                    ],
                    names=[*carry, "text", "n_chars", "n_blocks"],
                )

    return extract


def extract_pages(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks of every row of ``pages``.

    The whole html is cut into blocks; the network reads the blocks of a page in
    both directions and labels each; those of the article are joined by newlines. It is
    trained on up to ``train_pages`` pages with the least hash of their html and on pages made
    up from their sentences, with the same seeds each time. Null and empty html give
    an empty text, as do pages without an article. Rows of equal page_id are rows of
    their own; other columns are not read; an empty table gives no rows. One pass, no shuffle but that of the sample.
    """
    importable(pages.sparkSession)
    sample = pages.where("html IS NOT NULL").select("html").orderBy(F.xxhash64("html"), "html").limit(train_pages)
    # One task trains on the bounded sample, on one thread; the weights are some tens of kilobytes.
    trained = sample.repartition(1).mapInArrow(_trained, "weights binary").collect()
    if not trained:
        trained = [(_saved(BlockLabeller()),)]
    model = _loaded(trained[0][0])
    rows = pages.select("page_id", "url", "html")
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return rows.mapInArrow(_extract(model, ["page_id", "url"]), f"{kinds}, text string, n_chars long, n_blocks long")
