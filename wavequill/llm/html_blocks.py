"""HTML extraction by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with its path of open tags and their
class, id and role words. A bidirectional LSTM in numpy reads the page's whole sequence of blocks, every block as a
vector of its hashed path, its hashed words and its shape, and labels each as main text or not. The main blocks are
joined in page order.

The model is trained on made-up pages of many layouts, whose labels are known (a part of them with names that say
nothing), and on a bounded sample of the corpus, whose blocks get labels where their path names what they are. Null and
empty pages have an empty text; broken markup is read as browsers do in spirit: stray `<` are text, unclosed elements end
with their parent. Scripts, styles, frames and text fields are skipped to their end tag or, without one, to the next end
tag of any kind, and so are templates and lists of choices that have an end; drawings' labels, formulas and the fallbacks
of objects and scripts are text of their block. Whole pages are read, in time linear in their length.
Rows repeat as in the input; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavequill.llm.shingles import word_hashes

_TOKEN = r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>%s)>|<[!?/][^>]*+>|(?P<text>[^<]+|<)"
TOKEN = re.compile(_TOKEN % r"(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+", re.I | re.S)
#: for the rest of a page where some quoted value hides the end of its tag
UNQUOTED = re.compile(_TOKEN % r"[^>]*+", re.I | re.S)
TAG = re.compile(r"/?[a-z]", re.I)
#: ends of elements that hold no text of the page; without an end, the OPAQUE hide what comes before any end tag, others nothing
SKIPPED = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.I) for t in ("script", "style", "iframe", "textarea", "template", "select")}
OPAQUE = {"script", "style", "iframe", "textarea"}
ANY_END = re.compile(r"</[a-z]|\Z", re.I)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+", re.I)
BLOCKS = frozenset(
    "html head body title div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre section article main header footer nav aside form fieldset legend figure figcaption hr address details summary label button dialog center menu option".split()
)
EMPTY = frozenset("br img hr input meta link wbr area base col embed source track".split())
#: a tag that opens ends an open element of these kinds
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
ENDS |= {t: {"p"} for t in BLOCKS - set(ENDS) - {"html", "head", "body", "title"}}
#: where the search for an element to end stops
WALLS = frozenset("html body div table ul ol dl section article main header footer nav aside form blockquote figure".split())
#: words in a path that tell what a block is
MAIN = frozenset("article main content post entry story".split())
OTHER = frozenset(
    "nav menu navbar header footer aside sidebar ad ads advert advertisement sponsor sponsored promo banner cookie cookies consent notice alert popup modal form fieldset label button comment comments reply discussion share social related recommended breadcrumb breadcrumbs pagination newsletter subscribe widget head title copyright toolbar".split()
)
PATH, WORDS, SHAPE, HIDDEN = 64, 32, 4, 16
WIDTH = PATH + WORDS + SHAPE


@dataclass
class Blocks:
    texts: list[str] = field(default_factory=list)
    paths: list[tuple[str, ...]] = field(default_factory=list)
    linked: list[float] = field(default_factory=list)  # share of characters inside links


def cut(page: str | None) -> Blocks:
    """The leaf blocks of a page, with white space turned into single spaces and references decoded."""
    out = Blocks()
    stack: list[tuple[str, tuple[str, ...]]] = []  # tag and its words
    held: list[str] = []
    in_link = linked = 0
    names: tuple[str, ...] = ()

    def flush() -> None:
        nonlocal linked
        if held:
            text = "".join(held)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                out.texts.append(text)
                out.paths.append(names)
                out.linked.append(min(1.0, linked / len(text)))
            held.clear()
        linked = 0

    page = page or ""
    endless: set[str] = set()  # hidden elements without an end in the rest of the page
    pattern, last = TOKEN, page.rfind(">")
    tokens = pattern.finditer(page)
    while (m := next(tokens, None)) is not None:
        if (text := m["text"]) is not None:
            if text == "<":
                if m.start() > last:  # no tag ends any more
                    text = page[m.start() :]
                    tokens = iter(())
                elif pattern is TOKEN and TAG.match(page, m.end()):
                    pattern = UNQUOTED
                    tokens = pattern.finditer(page, m.start())
                    continue
            held.append(text)
            if in_link:
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        if tag in SKIPPED and not m["close"]:
            end = None if tag in endless else SKIPPED[tag].search(page, m.end())
            if end is None:
                endless.add(tag)
                end = ANY_END.search(page, m.end()) if tag in OPAQUE else None
                tokens = pattern.finditer(page, end.start()) if end else tokens
            else:
                tokens = pattern.finditer(page, end.end())
            if end:
                continue
        if tag not in BLOCKS:
            if tag == "a":
                in_link = 0 if m["close"] else 1
            if not m["close"] and tag not in EMPTY and m["rest"] and (own := _words(m["rest"])) & OTHER:
                flush()  # an inline element that says it is no main text stands apart
                stack.append((tag, (tag, *sorted(own))))
                names = tuple(w for _, s in stack for w in s)
            elif m["close"] and stack and stack[-1][0] == tag:
                flush()
                stack.pop()
                names = tuple(w for _, s in stack for w in s)
            continue
        flush()
        if tag in EMPTY:
            continue
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        else:
            ends = ENDS.get(tag, ())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    del stack[i:]
                elif stack[i][0] in WALLS:
                    break
            stack.append((tag, (tag, *sorted(_words(m["rest"]))) if m["rest"] else (tag,)))
        names = tuple(w for _, s in stack for w in s)
    flush()
    return out


def _words(rest: str) -> set[str]:
    return {w.lower() for a, b, c in NAMES.findall(rest) for w in PART.findall(a or b or c)}


def cue(path: tuple[str, ...]) -> int:
    """1: the path names main text, 0: it names something else, -1: it tells nothing."""
    return 0 if OTHER.intersection(path) else 1 if MAIN.intersection(path) else -1


class Features:
    """Vectors of blocks; those of paths are remembered, as pages share few."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, ...], np.ndarray] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        v = self.known.get(path)
        if v is None:
            v = np.zeros(PATH, np.float32)
            for w in set(path):
                h = zlib.crc32(w.encode())
                v[h % PATH] += 1.0 if h >> 16 & 1 else -1.0
                h = zlib.crc32(b"2" + w.encode())
                v[h % PATH] += 1.0 if h >> 16 & 1 else -1.0
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[path] = v
        return v

    def of(self, blocks: Blocks) -> np.ndarray:
        n = len(blocks.texts)
        x = np.zeros((n, WIDTH), np.float32)
        if not n:
            return x
        x[:, :PATH] = [self.path(p) for p in blocks.paths]
        words = list(word_hashes(blocks.texts))
        size = np.array([len(w) for w in words])
        where = np.repeat(np.arange(n), size) * WORDS + (np.concatenate(words) % np.uint64(WORDS)).astype(np.int64)
        bag = np.bincount(where, minlength=n * WORDS).reshape(n, WORDS)
        x[:, PATH : PATH + WORDS] = bag / np.sqrt(np.maximum(1, size))[:, None] / 4
        x[:, -4], x[:, -3] = np.log1p(size) / 4, blocks.linked
        x[:, -2], x[:, -1] = np.arange(n) / n, 1 / np.arange(1, n + 1)
        return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM over the blocks of a page with one output a block."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {f"{n}{d}": v for d in "fb" for n, v in (("W", draw(WIDTH, 4 * HIDDEN)), ("U", draw(HIDDEN, 4 * HIDDEN)), ("b", np.repeat(np.float32([0, 1, 0, 0]), HIDDEN)))}
        self.p |= {"V": draw(2 * HIDDEN), "c": np.zeros(1, np.float32)}

    @staticmethod
    def _step(z: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        new = f * c + i * g
        t = np.tanh(new)
        return i, f, o, g, new, t, o * t

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of main text of every block; pages advance together, longest first, without padding."""
        sizes = np.array([len(x) for x in pages], np.int64)
        order = np.argsort(-sizes, kind="stable")
        live = [int(k) for k in order if sizes[k]]
        if not live:
            return [np.zeros(0, np.float32) for _ in pages]
        flat = np.concatenate([pages[k] for k in live])
        n = sizes[live]
        begin = np.cumsum(n) - n
        active = np.searchsorted(-n, -np.arange(n[0]), side="left")  # pages with more blocks than each step's number
        score = np.full(len(flat), self.p["c"][0], np.float32)
        for d in "fb":
            z = flat @ self.p["W" + d] + self.p["b" + d]
            h, c = np.zeros((len(live), HIDDEN), np.float32), np.zeros((len(live), HIDDEN), np.float32)
            v = self.p["V"][:HIDDEN] if d == "f" else self.p["V"][HIDDEN:]
            for t in range(int(n[0])):
                k = int(active[t])
                at = begin[:k] + (t if d == "f" else n[:k] - 1 - t)
                *_, c[:k], _, h[:k] = self._step(z[at] + h[:k] @ self.p["U" + d], c[:k])
                score[at] += h[:k] @ v
        p = _sigmoid(score)
        out = [np.zeros(0, np.float32)] * len(pages)
        for k, a, m in zip(live, begin, n, strict=True):
            out[k] = p[a : a + m]
        return out

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 10, batch: int = 48, rate: float = 0.015, seed: int = 11) -> float:
        """Adam on the cross-entropy of labelled blocks (label -1: none). Returns the last epoch's loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, loss = 0, 0.0
        use = [i for i in range(len(pages)) if len(pages[i])]
        for _ in range(epochs):
            rng.shuffle(use)
            losses = []
            for a in range(0, len(use), batch):
                part = use[a : a + batch]
                value, grad = self._gradient([pages[i] for i in part], [labels[i] for i in part])
                losses.append(value)
                step += 1
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            loss = float(np.mean(losses))
        return loss

    def _gradient(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
        n, T = len(pages), max(map(len, pages))
        x = np.zeros((2, n, T, WIDTH), np.float32)
        mask, y = np.zeros((n, T), np.float32), np.full((n, T), -1.0, np.float32)
        for i, (p, q) in enumerate(zip(pages, labels, strict=True)):
            x[0, i, : len(p)], x[1, i, : len(p)], mask[i, : len(p)], y[i, : len(p)] = p, p[::-1], 1, q
        size = [len(p) for p in pages]
        states, hs = [], np.zeros((2, n, T, HIDDEN), np.float32)
        for d, name in enumerate("fb"):
            h, c, kept = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), []
            z = x[d] @ self.p["W" + name] + self.p["b" + name]
            for t in range(T):
                i, f, o, g, new, tanh, out = self._step(z[:, t] + h @ self.p["U" + name], c)
                k = mask[:, t, None]
                kept.append((i, f, o, g, c, tanh, h, k))
                c, h = k * new + (1 - k) * c, k * out + (1 - k) * h
                hs[d, :, t] = h
            states.append(kept)
        back = np.zeros_like(hs[1])
        for i, k in enumerate(size):
            back[i, :k] = hs[1, i, :k][::-1]
        both = np.concatenate([hs[0], back], -1)
        p = _sigmoid(both @ self.p["V"] + self.p["c"])
        known = (y >= 0).astype(np.float32)
        total = max(1.0, float(known.sum()))
        loss = -float((known * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum()) / total
        e = known * (p - y) / total
        grad = {"V": np.einsum("nt,nth->h", e, both), "c": np.array([e.sum()], np.float32)}
        dh_all = [e[..., None] * self.p["V"][:HIDDEN], np.zeros_like(hs[1])]
        own = e[..., None] * self.p["V"][HIDDEN:]
        for i, k in enumerate(size):
            dh_all[1][i, :k] = own[i, :k][::-1]
        for d, name in enumerate("fb"):
            dz = np.zeros((n, T, 4 * HIDDEN), np.float32)
            dU = np.zeros_like(self.p["U" + name])
            dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for t in range(T - 1, -1, -1):
                i, f, o, g, c, tanh, h, k = states[d][t]
                dh = dh + dh_all[d][:, t]
                do = dh * k
                dcell = dc * k + do * o * (1 - tanh * tanh)
                q = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f), do * tanh * o * (1 - o), dcell * i * (1 - g * g)], 1)
                dz[:, t] = q
                dU += h.T @ q
                dh = dh * (1 - k) + q @ self.p["U" + name].T
                dc = dc * (1 - k) + dcell * f
            grad |= {"U" + name: dU, "W" + name: np.einsum("ntd,ntg->dg", x[d], dz, optimize=True), "b" + name: dz.sum((0, 1))}
        return loss, {k: np.clip(v, -1, 1) for k, v in grad.items()}


# ---------------------------------------------------------------- training pages


#: begins every main block of a made-up page; it is taken away before the page is seen
MARK = "\ue000"


def made_up_page(r: random.Random, telling: bool = True) -> str:
    """A page of a random layout, its main blocks marked. With `telling`, class words and tags say what is main text, as
    sites use them; else only made-up names and neutral tags are there, and shape, links and order have to tell."""
    word = lambda: "".join(r.choice("abcdefghijklmnoprstuvwé") for _ in range(r.randint(2, 9)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    attribute = lambda w: r.choice((f' class="{w}"', f' id="{w}"', f' class="{word()} {w}"', f' class="{w}-{word()}"', f' role="{w}"'))
    name = lambda w: attribute(w if telling else word())
    links = lambda: "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(r.randint(2, 8))) + "</ul>"

    def other() -> str:
        w = r.choice(sorted(OTHER - {"head", "title", "label", "button", "fieldset", "form"}))
        inside = r.choice((links, lambda: f"<p>{words(3, 40)}</p>", lambda: words(2, 30), lambda: f"<p>{words(2, 12)}</p>" * r.randint(1, 4)) if telling else (links, lambda: words(1, 6), lambda: f"<p>{words(1, 5)}</p>"))()
        tag = w if telling and w in ("nav", "header", "footer", "aside") and r.random() < 0.7 else ""
        if r.random() < 0.1:
            return f"<form><label>{words(1, 3)}</label><input><button>{words(1, 2)}</button></form>"
        return f"<{tag}>{inside}</{tag}>" if tag else f"<{(t := r.choice(('div', 'section', 'div')))}{name(w)}>{inside}</{t}>"

    def main(kind: float) -> str:
        if kind < 0.7:
            return f"<p>{MARK}{words(1, 90) if telling else words(12, 90)}</p>"
        if kind < 0.8:
            return f"<p>{MARK}<b>{words(3, 50)}<br>"
        if kind < 0.86:
            return f"<h2>{MARK}{words(1, 6)}</h2>"
        if kind < 0.91:
            return f"<ul><li>{MARK}{words(2, 12)}</li><li>{MARK}{words(2, 12)}</li></ul>"
        return f"<blockquote>{MARK}{words(4, 30)}</blockquote>" if kind < 0.95 or not telling else other()

    body = (f"<h1>{MARK}{words(2, 10)}</h1>" if r.random() < 0.8 else "") + "".join(main(r.random()) for _ in range(r.randint(1 if telling else 3, 10)))
    if telling:
        tag, end = r.choice((("<article>", "</article>"), ("<main>", "</main>"), ("<article>", "</article>"), (f"<div{name(r.choice(sorted(MAIN)))}>", "</div>"), ("<main><article>", "</article></main>")))
    else:
        tag, end = f"<div{name('')}>", "</div>"
    before, after = ("".join(other() for _ in range(r.randint(0, 4))) for _ in range(2))
    return f"<!DOCTYPE html><html><head><title>{words(2, 9)}</title></head><body>{before}{tag}{body}{end}{after}</body></html>"


def labelled(page: str) -> tuple[Blocks, np.ndarray]:
    """The blocks of a made-up page without their marks, and which of them had one."""
    blocks = cut(page)
    is_main = np.array([t.startswith(MARK) for t in blocks.texts], np.float32)
    blocks.texts = [t.removeprefix(MARK) for t in blocks.texts]
    return blocks, is_main


def train(pages: DataFrame, sample: int = 300, made_up: int = 400, silent: int = 150, most_chars: int = 40_000, most_blocks: int = 400, seed: int = 42, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """A labeller from `made_up` pages that name their parts, `silent` ones that don't, and about `sample` pages of the
    corpus, drawn by a seeded hash of the identifier; blocks of those whose path tells nothing give no label.

    Bounds on what is learned from: pages of more than `most_chars` characters or `most_blocks` blocks aren't drawn.
    """
    n = pages.count()
    share = min(1.0, sample / max(1, n))
    drawn = pages.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 30)) < int(share * (1 << 30))).filter(F.length(html_col) <= most_chars)
    own = [r[0] for r in drawn.select(html_col, F.xxhash64(F.col(html_col)).alias("h")).orderBy("h").limit(2 * sample).collect()]
    r = random.Random(seed)
    features, xs, ys = Features(), [], []
    for page in own:
        blocks = cut(page)
        if 0 < len(blocks.texts) <= most_blocks:
            xs.append(features.of(blocks))
            ys.append(np.array([cue(p) for p in blocks.paths], np.float32))
    for i in range(made_up + silent):
        blocks, is_main = labelled(made_up_page(r, telling=i < made_up))
        xs.append(features.of(blocks))
        ys.append(is_main)
    labeller = Labeller()
    labeller.fit(xs, ys)
    return labeller


#: characters of pages that are read at a time
CHUNK = 4_000_000


def extract(pages: DataFrame, labeller: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text (main blocks joined by line feeds) and n_chars for every row."""
    shared = pages.sparkSession.sparkContext.broadcast(labeller.p)  # some thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, features = Labeller(), Features()
        model.p = shared.value
        for batch in batches:
            html_of, texts, at = batch.column("html"), [], 0
            while at < batch.num_rows:
                part, held = [], 0
                while at < batch.num_rows and held < CHUNK:
                    page = html_of[at].as_py()
                    held += len(page or "")
                    part.append(cut(page))
                    at += 1
                marks = model.label([features.of(b) for b in part])
                texts += ["\n".join(t for t, p in zip(b.texts, m, strict=True) if p > 0.5) for b, m in zip(part, marks, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return slim.mapInArrow(run, f"id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars long").withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
