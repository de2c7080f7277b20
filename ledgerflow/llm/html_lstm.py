"""Main-text extraction by a recurrent block labeller.

A page becomes the sequence of its leaf blocks (runs of text between block
tags).  Each block is read as hashed vectors of its tag path (tags, and words
of class and id, with the innermost counted twice), of its words and a few
measures; a bidirectional LSTM in numpy reads the sequence from both ends, so
every block is judged in the context of the whole page.  Blocks judged to be
article text are joined by line breaks.

Learning: pages laid out from many templates, with known block labels, in words
of the corpus, plus a sample of about ``SAMPLE`` real pages (under
``SAMPLE_BYTES`` and ``SAMPLE_BLOCKS`` blocks each) whose semantic tags, and common
names of regions, say what is article and what is not.  The bounds concern
learning only; extraction reads whole pages.

Defined cases: null html is empty; a page without article blocks gives the empty
text; unclosed and stray tags, quotes and comments are tolerated (an unclosed
element that is not read ends where the element around it does); repeated rows
are pages of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE, SAMPLE_BYTES, SAMPLE_BLOCKS = 400, 100_000, 400
TEMPLATES, EPOCHS, BATCH, RATE = 700, 18, 25, 0.01
PATH_DIMS, WORD_DIMS, MEASURES, HIDDEN = 160, 48, 8, 20
DIMS = PATH_DIMS + WORD_DIMS + MEASURES
SEED = 19
PAGES_AT_ONCE = 400

# fixed values: element names of HTML
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
 figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup
 option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
RAW = frozenset("script style textarea title iframe".split())  # hold no tags: end at their end tag alone
UNREAD = RAW | frozenset("noscript template svg object canvas audio video head select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDED_BY = {  # an open element of the key ends where one of the value begins
    "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option", "optgroup"},
}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^>"'])*+)>?""", re.S)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Block:
    __slots__ = ("text", "path", "link")

    def __init__(self, text: str, path: tuple, link: int):
        self.text, self.path, self.link = text, path, link


def unread_until(page: str, at: int, name: str, around: set[str]) -> int:
    """Where an unread element that begins before ``at`` ends: behind its end tag, or
    before the end tag of an element around it, or at once if neither comes."""
    inside: dict[str, int] = {}
    here = at
    while m := TAG.search(page, here):
        here = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if inside.get(tag):
                inside[tag] -= 1
            elif tag == name:
                return here
            elif tag in around:
                return m.start()
        elif tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, here)
            here = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            inside[tag] = inside.get(tag, 0) + 1
    return at


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order: text (references decoded, white space collapsed),
    path (an element's tokens per level, outermost first), characters in links."""
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    text: list[str] = []
    links = linked = at = 0

    def close() -> None:
        nonlocal linked
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            out.append(Block(joined, tuple(tokens for _, tokens in stack), min(linked, len(joined))))
        text.clear()
        linked = 0

    n = len(page)
    while at < n:
        m = TAG.search(page, at)
        data = page[at:m.start()] if m else page[at:]
        if data:
            text.append(data)
            if links:
                linked += len(data.strip())
        if not m:
            break
        at = m.end()
        name = m[2]
        if name is None:  # comment or declaration
            continue
        name = name.lower()
        if m[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name or stack[depth][0] in HEADINGS and name in HEADINGS:
                    if any(open_ in BLOCKS for open_, _ in stack[depth:]):
                        close()
                    links -= sum(open_ == "a" for open_, _ in stack[depth:])
                    del stack[depth:]
                    break
            continue
        if name in UNREAD:
            if name in BLOCKS:
                close()
            if name in RAW or name == "head":
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else (n if name != "head" else at)
            elif not (m[3].rstrip().endswith("/") and name == "svg"):
                at = unread_until(page, at, name, {open_ for open_, _ in stack})
            text.append(" ")
            continue
        if name == "br" or name in ("img", "input", "wbr"):
            text.append(" " if name != "wbr" else "")
            continue
        if name in BLOCKS:
            close()
            for depth in range(len(stack) - 1, -1, -1):
                open_ = stack[depth][0]
                if name in ENDED_BY.get(open_, ()):
                    links -= sum(o == "a" for o, _ in stack[depth:])
                    del stack[depth:]
                    break
                if open_ in BLOCKS:
                    break
        if name in VOID or m[3].endswith("/") and name not in BLOCKS:
            continue
        tokens = [f"<{name}"]
        if m[3]:
            for _, a, b, c in NAMED.findall(m[3]):
                tokens += [part.lower() for part in PART.findall(entities.unescape(a or b or c))]
        stack.append((name, tuple(tokens)))
        links += name == "a"
    close()
    return out


def _slot(token: str, dims: int, seed: int) -> tuple[int, float]:
    h = zlib.crc32(token.encode(), seed)
    return (h >> 1) % dims, 1.0 if h & 1 else -1.0


class Features:
    """Block sequences as float matrices; hash slots are remembered (boundedly)."""

    def __init__(self):
        self.path: dict[str, tuple[int, float]] = {}
        self.word: dict[str, tuple[int, float]] = {}

    def _of(self, cache: dict, token: str, dims: int, seed: int) -> tuple[int, float]:
        got = cache.get(token)
        if got is None:
            if len(cache) > 300_000:
                cache.clear()
            got = cache[token] = _slot(token, dims, seed)
        return got

    def sequence(self, blocks: list[Block]) -> np.ndarray:
        x = np.zeros((len(blocks), DIMS), np.float32)
        total = sum(len(b.text) for b in blocks) + 1
        done = 0
        for i, b in enumerate(blocks):
            row = x[i]
            for level, tokens in enumerate(b.path):
                weight = 1.0 if level == len(b.path) - 1 else 0.5
                for t in tokens:
                    if t not in ("<html", "<body"):
                        k, sign = self._of(self.path, t, PATH_DIMS, 1)
                        row[k] += sign * weight
            words = b.text.lower().split()
            for w in words:
                k, sign = self._of(self.word, w, WORD_DIMS, 2)
                row[PATH_DIMS + k] += sign
            part = row[PATH_DIMS:PATH_DIMS + WORD_DIMS]
            part *= 0.5 / max(float(np.sqrt(part @ part)), 1.0)
            size = len(b.text)
            row[-MEASURES:] = (np.log1p(size) / 8, np.log1p(len(words)) / 6, b.link / size, sum(map(b.text.count, ".,;:!?")) / len(words) / 2,
                               done / total, size / total, len(b.path) / 16, i / len(blocks))
            done += size
        return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one from each end, and a logistic layer on both states."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {}
        for side in "lr":
            self.p |= {side + "x": small(DIMS, 4 * HIDDEN), side + "h": small(HIDDEN, 4 * HIDDEN), side + "b": np.zeros(4 * HIDDEN, np.float32)}
            self.p[side + "b"][HIDDEN:2 * HIDDEN] = 1
        self.p |= {"o": small(2 * HIDDEN, 1), "ob": np.zeros(1, np.float32)}

    def _run(self, side: str, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        wx, wh, b = (self.p[side + k] for k in "xhb")
        steps, count, _ = x.shape
        z = x.reshape(-1, DIMS) @ wx
        z = z.reshape(steps, count, -1) + b
        h = c = np.zeros((count, HIDDEN), np.float32)
        states, tape = np.zeros((steps, count, HIDDEN), np.float32), []
        for t in range(steps):
            a = z[t] + h @ wh
            gates = _sigmoid(a[:, :3 * HIDDEN])
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(a[:, 3 * HIDDEN:])
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[t] = h
            if keep:
                tape.append((i, f, o, g, before, tc, h_before))
        return states, tape

    @staticmethod
    def _batch(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Padded sequences, the same reversed, and the turning index."""
        size = np.array([len(x) for x in xs])
        pad = np.zeros((size.max(), len(xs), DIMS), np.float32)
        for k, x in enumerate(xs):
            pad[:len(x), k] = x
        t = np.arange(size.max())[:, None]
        turn = np.where(t < size, size - 1 - t, t)
        return pad, np.take_along_axis(pad, turn[:, :, None], 0), turn

    def probabilities(self, xs: list[np.ndarray]) -> list[np.ndarray]:
        left, right, turn = self._batch(xs)
        a, _ = self._run("l", left, False)
        b, _ = self._run("r", right, False)
        both = np.concatenate([a, np.take_along_axis(b, turn[:, :, None], 0)], axis=2)
        y = _sigmoid(both @ self.p["o"] + self.p["ob"])[:, :, 0]
        return [y[:len(x), k] for k, x in enumerate(xs)]

    def _back(self, side: str, x: np.ndarray, tape: list, dstates: np.ndarray, grad: dict) -> None:
        wh = self.p[side + "h"]
        dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        dh = dc = np.zeros_like(dstates[0])
        for t in range(len(tape) - 1, -1, -1):
            i, f, o, g, before, tc, h_before = tape[t]
            dh = dh + dstates[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            grad[side + "h"] += h_before.T @ dz[t]
            dh, dc = dz[t] @ wh.T, dc * f
        flat = dz.reshape(-1, 4 * HIDDEN)
        grad[side + "x"] += x.reshape(-1, DIMS).T @ flat
        grad[side + "b"] += flat.sum(0)

    def fit(self, xs: list[np.ndarray], ys: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam on the mean log loss of blocks (label -1: not learned from)."""
        rng = np.random.default_rng(seed + 1)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        turns = 0
        order = sorted(range(len(xs)), key=lambda k: len(xs[k]))
        groups = [order[k:k + BATCH] for k in range(0, len(order), BATCH)]
        for epoch in range(epochs):
            for g in rng.permutation(len(groups)):
                picked = [xs[k] for k in groups[g]]
                left, right, turn = self._batch(picked)
                a, tape_a = self._run("l", left, True)
                b, tape_b = self._run("r", right, True)
                both = np.concatenate([a, np.take_along_axis(b, turn[:, :, None], 0)], axis=2)
                y = np.full(both.shape[:2], -1, np.float32)
                for k, seq in enumerate(groups[g]):
                    y[:len(ys[seq]), k] = ys[seq]
                known = y >= 0
                err = np.where(known, _sigmoid(both @ self.p["o"] + self.p["ob"])[:, :, 0] - y, 0) / max(int(known.sum()), 1)
                grad = {k: np.zeros_like(v) for k, v in self.p.items()}
                grad["o"] = np.einsum("tbh,tb->h", both, err)[:, None]
                grad["ob"] = err.sum(keepdims=True).reshape(1)
                d = err[:, :, None] * self.p["o"][:, 0]
                self._back("l", left, tape_a, d[:, :, :HIDDEN], grad)
                self._back("r", right, tape_b, np.take_along_axis(d[:, :, HIDDEN:], turn[:, :, None], 0), grad)
                norm = np.sqrt(sum(float((v * v).sum()) for v in grad.values()))
                turns += 1
                rate = RATE * (0.3 if epoch >= epochs * 2 // 3 else 1)
                for k, v in grad.items():
                    v = v * min(1.0, 1.0 / max(norm, 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.99 * second[k] + 0.01 * v * v
                    step = (first[k] / (1 - 0.9 ** turns)) / (np.sqrt(second[k] / (1 - 0.99 ** turns)) + 1e-6)
                    self.p[k] = (self.p[k] - rate * step).astype(np.float32)


# fixed values: common names of page regions
MAIN_WORDS = "content main article post entry body text story page".split()
SIDE_KINDS = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc links toolbar".split(),
    "header": "header top masthead topbar branding logo site".split(),
    "footer": "footer bottom copyright legal foot colophon".split(),
    "sidebar": "sidebar aside widget related recommended rail popular trending more".split(),
    "notice": "cookie notice consent banner gdpr alert popup modal subscribe newsletter".split(),
    "ad": "ad ads advert advertisement sponsored promo promotion sponsor".split(),
    "form": "form search login signup contact".split(),
    "comment": "comment comments reply replies discussion responses reviews".split(),
    "share": "share social follow tags meta author byline".split(),
}
SIDE_TAGS = {"menu": ["nav", "ul", "div", "ol", "menu"], "header": ["header", "div"], "footer": ["footer", "div"],
             "sidebar": ["aside", "div", "section"], "notice": ["div", "aside", "section", "dialog"], "ad": ["div", "aside", "section", "ins"],
             "form": ["form"], "comment": ["section", "div", "ol", "ul", "article"], "share": ["div", "ul", "p"]}
SIDE_WORDS = {w: k for k, ws in SIDE_KINDS.items() if k != "share" for w in ws if w not in ("top", "site", "more", "body", "bottom", "text", "page")}
SIDE_ELEMENTS = frozenset(("<nav", "<footer", "<aside", "<form", "<header", "<button", "<label", "<menu", "<dialog"))


def template_page(rng: np.random.Generator, words: list[str]) -> tuple[str, dict[str, int]]:
    """A page of a random layout, and the label of each of its block texts."""
    label: dict[str, int] = {}
    pick = lambda options: options[rng.integers(len(options))]

    def text(low: int, high: int, kind: int) -> str:
        while True:
            ws = [pick(words) for _ in range(rng.integers(low, high + 1))]
            s = " ".join(ws).strip()
            s = " ".join((s[:1].upper() + s[1:] + pick([".", "", "!", "?", "."])).split())
            if s and s not in label:
                label[s] = kind
                return entities.escape(s)

    def named(kind_words: list[str], chance: float) -> str:
        if rng.random() >= chance:
            return ""
        w = pick(kind_words)
        if rng.random() < 0.5:
            w = pick([f"{w}-{pick(['box', 'area', 'wrap', 'list', 'inner', 'left', 'block'])}", f"site-{w}", f"{w}{rng.integers(1, 9)}", f"page_{w}"])
        return f' {pick(["class", "class", "id"])}="{w}"'

    def side(kind: str, inside: bool = False) -> str:
        tag = pick(SIDE_TAGS[kind])
        plain = tag in ("nav", "footer", "form", "aside") or tag == "header"
        attr = named(SIDE_KINDS[kind], 0.3 if plain and not inside else 1.0)
        many = rng.integers(1, 7)
        if kind == "menu" or tag in ("ul", "ol"):
            items = [f"<li>{f'<a href=x>{text(1, 3, 0)}</a>' if kind != 'comment' else f'<p>{text(3, 30, 0)}</p>'}</li>" for _ in range(many)]
            body = "".join(items) if tag in ("ul", "ol") else f"<ul>{''.join(items)}</ul>" if rng.random() < 0.7 else "".join(
                f"<a href=x>{text(1, 3, 0)}</a>" if k == 0 else f"<div><a href=x>{text(1, 3, 0)}</a></div>" for k in range(many))
        elif kind == "form":
            body = f"<label>{text(1, 4, 0)}</label><input name=q><button>{text(1, 2, 0)}</button>" + (f"<p>{text(3, 15, 0)}</p>" if rng.random() < 0.4 else "")
        elif kind == "comment":
            body = "".join(f'<div{named(["comment", "reply"], 0.6)}><p>{text(3, 40, 0)}</p></div>' for _ in range(many))
        elif rng.random() < 0.4:
            body = text(2, 20, 0)
        else:
            body = "".join("<{0}>{1}</{0}>".format(pick(["p", "div", "h3", "p"]), text(2, 25, 0)) for _ in range(rng.integers(1, 4)))
        return f"<{tag}{attr}>{body}</{tag}>"

    long = rng.random() < 0.1  # pages of very many blocks, most of them short
    brief = long or rng.random() < 0.1

    def paragraph() -> str:
        body = text(1, 4, 1) if brief and rng.random() < 0.8 else text(3, 40 if long else 90, 1)
        if rng.random() < 0.25:
            cut = body.find(" ", len(body) // 2)
            if cut > 0:
                mark = pick(["b", "em", "a href=x", "span", "i"])
                body = f"<{mark}>{body[:cut]}</{mark.split()[0]}>{body[cut:]}"
        return pick([f"<p>{body}</p>", f"<p>{body}</p>", f"<p>{body}", f"<p><b>{body}<br>", f"<div>{body}</div>"])

    main = [f"<h{rng.integers(1, 3)}>{text(2, 14, 1)}</h1>"] if rng.random() < 0.85 else []
    for _ in range(int(rng.integers(20, 130) if long else rng.integers(1, 12))):
        extra = rng.random()
        main.append(f"<h{rng.integers(2, 4)}>{text(1, 8, 1)}</h2>" if extra < 0.08 else f"<ul>{''.join(f'<li>{text(2, 25, 1)}</li>' for _ in range(rng.integers(1, 5)))}</ul>"
                    if extra < 0.14 else f"<blockquote>{paragraph()}</blockquote>" if extra < 0.18 else f"<pre>{text(3, 20, 1)}</pre>" if extra < 0.2
                    else f"<table><tr><td>{text(1, 6, 1)}</td><td>{text(1, 6, 1)}</td></tr></table>" if extra < 0.23 else paragraph())
        if rng.random() < (0.01 if long else 0.06):
            main.append(side(pick(["ad", "sidebar", "notice", "share", "form"]), inside=True))
    if rng.random() < 0.15:
        main.append(side("comment", inside=True))
    shape = rng.integers(4)
    body = "".join(main)
    if shape == 0:
        body = f"<article{named(MAIN_WORDS, 0.3)}>{body}</article>"
    elif shape == 1:
        body = f"<main{named(MAIN_WORDS, 0.3)}>{body}</main>"
    elif shape == 2:
        body = f"<main><article>{body}</article></main>"
    else:
        body = f"<div{named(MAIN_WORDS, 1.0)}>{body}</div>"
    if rng.random() < 0.3:
        body = f'<div{named(["wrapper", "container", "content", "main", "row", "layout"], 0.8)}>{body}{side("sidebar") if rng.random() < 0.5 else ""}</div>'
    before = [side(k) for k in ("header", "menu", "ad", "notice", "form", "share") if rng.random() < 0.4]
    after = [side(k) for k in ("comment", "sidebar", "ad", "notice", "share", "menu", "footer") if rng.random() < 0.4]
    if rng.random() < 0.7:
        after.append(side("footer"))
    parts = [*(before[k] for k in rng.permutation(len(before))), body, *after]
    return f"<!DOCTYPE html><html><head><title>{pick(words)}</title></head><body>{'<!-- x -->'.join(parts)}</body></html>", label


def semantic_labels(blocks: list[Block]) -> np.ndarray:
    """What a page's own semantic tags say of its blocks: 1 article, 0 not, -1 silent."""
    told = any("<article" in t or "<main" in t for b in blocks for t in b.path)
    out = np.full(len(blocks), -1.0, np.float32)
    for i, b in enumerate(blocks):
        flat = [t for level in b.path for t in level]
        if any(t in SIDE_ELEMENTS or t in SIDE_WORDS for t in flat):
            out[i] = 0
        elif told and any(t in ("<article", "<main") for t in flat):
            out[i] = 1
    return out


def train(pages: list[str], seed: int = SEED, templates: int = TEMPLATES, epochs: int = EPOCHS) -> Labeller:
    rng = np.random.default_rng(seed)
    features = Features()
    real = [blocks_of(p) for p in pages]
    words = sorted({w for bs in real for b in bs for w in b.text.split()})
    words = words or ["".join(rng.choice(list("abcdeinorstu"), rng.integers(2, 9))) for _ in range(500)]
    xs, ys = [], []
    for _ in range(templates):
        page, label = template_page(rng, words)
        bs = blocks_of(page)
        xs.append(features.sequence(bs))
        ys.append(np.array([label.get(b.text, -1) for b in bs], np.float32))
    for bs in real:
        y = semantic_labels(bs)
        if (y >= 0).any() and len(bs) <= SAMPLE_BLOCKS:
            xs.append(features.sequence(bs))
            ys.append(y)
    model = Labeller(seed)
    model.fit([x for x in xs if len(x)], [y for x, y in zip(xs, ys) if len(x)], epochs, seed)
    return model


def fit(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    """Learn from about ``sample`` different pages, chosen by a hash of their html."""
    n = pages.select(F.xxhash64("html").alias("h")).distinct().count()
    chance = F.pmod(F.xxhash64("html"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = pages.filter((F.octet_length("html") <= SAMPLE_BYTES) & (chance < F.lit(sample / max(n, 1))))
    rows = chosen.select("html").distinct().collect()
    return train(sorted(r.html for r in rows))


def extract_pages(pages: DataFrame, model: Labeller) -> DataFrame:
    """One row a page: ``page_id, url, text, n_chars``."""
    weights = model.p

    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        labeller, features = Labeller(), Features()
        labeller.p = weights
        for batch in batches:
            texts = [""] * len(batch)
            for lo in range(0, len(batch), PAGES_AT_ONCE):
                some = [blocks_of(p or "") for p in batch.iloc[lo:lo + PAGES_AT_ONCE]]
                order = sorted((k for k, bs in enumerate(some) if bs), key=lambda k: len(some[k]))
                at = 0
                while at < len(order):  # pages of like length together
                    end = at + 1
                    while end < len(order) and len(some[order[end]]) <= 1.3 * len(some[order[at]]) + 2:
                        end += 1
                    group = order[at:end]
                    for k, y in zip(group, labeller.probabilities([features.sequence(some[k]) for k in group])):
                        texts[lo + k] = "\n".join(b.text for b, p in zip(some[k], y) if p >= 0.5)
                    at = end
            yield pd.Series(texts)

    return pages.select("page_id", "url", main_text(F.coalesce("html", F.lit(""))).alias("text")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
