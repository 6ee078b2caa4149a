"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, each with its ancestor tags and the words of their class,
id and role attributes. The field labels the blocks as main text or not, from features of ancestors and text and the label of
the block before, and is decoded by Viterbi. It is trained on labelled pages that this module writes from templates of common
page layouts (their number and seed are parameters), by gradient steps on the conditional likelihood.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Labelled pages, their seed, passes, and the hashed size of the features.
PAGES, SEED, ROUNDS, DIMS = 600, 11, 6, 1 << 12

# Element kinds of the HTML standard.
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template title head textarea select option button svg annotation annotation-xml iframe canvas audio video datalist".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
CLOSES_P = BLOCK - set("head title option select textarea tbody thead tfoot tr td th caption body html noscript legend".split())
#: An open tag of the second kind ends at a new tag of the first.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

_COMMENT_END = re.compile(r"--!?>")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_PLAIN = re.compile(r"[^>\"']*+")
_ATTR = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?|"[^"]*+"|'[^']*+'""")
_HIDDEN = re.compile(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden")
_RAW_END = {tag: re.compile(rf"</{tag}(?![^\s/>])", re.I) for tag in RAW}
_WORD = re.compile(r"[a-z]+")
_REF = re.compile(r"&(?:#|[a-zA-Z])")
_ZEROS, _HUGE = re.compile(r"&#0++(?=[0-9])"), re.compile(r"&#[0-9]{8,}+;?")
_SPACE = re.compile(r"\s+")


class Node:
    """An open element. It shares its parent's set of features where it adds none, so a chain of any depth stays small."""

    __slots__ = ("block", "blocks", "feats", "marks", "parent", "tag", "unseen")

    def __init__(self, parent: Node | None, tag: str, marks: tuple[str, ...] = (), unseen: bool = False):
        is_block = tag in BLOCK
        self.parent, self.tag, self.marks, self.unseen = parent, tag, marks, unseen
        self.block = tag if is_block else parent.block if parent else "none"
        self.blocks = (parent.blocks if parent else 0) + is_block
        own, known = {_feature(x) for x in (f"in:{tag}", *(f"mark:{m}" for m in marks))}, parent.feats if parent else frozenset()
        self.feats = known if own <= known else known | own


@dataclass
class Block:
    text: str
    node: Node | None  # the innermost open element
    linked: int = 0  # characters in links
    breaks: int = 0

    @property
    def marks(self) -> tuple[str, ...]:
        """Words of the class, id and role attributes of all open elements, outermost first."""
        out, node = [], self.node
        while node:
            out.append(node.marks)
            node = node.parent
        return tuple(m for part in reversed(out) for m in part)


class _Page:
    def __init__(self) -> None:
        self.stack: list[Node] = []
        self.at: dict[str, list[int]] = {}  # where each tag is in the stack
        self.unseen = 0
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.breaks = 0

    def last(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def push(self, tag: str, marks: tuple[str, ...], unseen: bool) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Node(self.stack[-1] if self.stack else None, tag, marks, unseen))
        self.unseen += unseen

    def text(self, chunk: str, decoded: bool = False) -> None:
        if self.unseen or not chunk:
            return
        if not decoded and _REF.search(chunk):
            if "&#" in chunk:
                chunk = _HUGE.sub("\ufffd", _ZEROS.sub("&#", chunk))
            chunk = html.unescape(chunk)
        self.parts.append(chunk)
        if self.at.get("a"):
            self.linked += len(chunk)

    def close_block(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.blocks.append(Block(text, self.stack[-1] if self.stack else None, self.linked, self.breaks))
        self.parts, self.linked, self.breaks = [], 0, 0

    def holds_block(self, at: int) -> bool:
        """Whether there is a block-level element in the stack from position `at` on."""
        return len(self.stack) > at and self.stack[-1].blocks > (self.stack[at - 1].blocks if at else 0)

    def pop_to(self, at: int) -> None:
        if self.holds_block(at):
            self.close_block()
        while len(self.stack) > at:
            node = self.stack.pop()
            self.at[node.tag].pop()
            self.unseen -= node.unseen


def _tag_end(page: str, at: int, unclosed: set[str]) -> int:
    """Where the tag whose attributes begin at `at` ends (its > or the page's end); a quote that is never closed is plain text."""
    while True:
        at = _PLAIN.match(page, at).end()
        if at >= len(page) or page[at] == ">":
            return at
        end = -1 if page[at] in unclosed else page.find(page[at], at + 1)
        if end < 0:
            unclosed.add(page[at])
        at = max(at, end) + 1


def _attributes(text: str) -> tuple[tuple[str, ...], bool]:
    """The words that mark an element, and whether it is hidden."""
    marks: list[str] = []
    hidden = False
    for a in _ATTR.finditer(text):
        name, value = (a[1] or "").lower(), (a[2] or "").strip("\"'").lower()
        if name in ("class", "id", "role", "itemprop"):
            marks += _WORD.findall(value)
        elif name == "hidden" and value in ("", "hidden") or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style" and _HIDDEN.search(value):
            hidden = True
    return tuple(marks), hidden


def leaf_blocks(page: str | None) -> list[Block]:
    """Visible leaf blocks in page order, references decoded, white space squeezed. Broken markup is read as browsers do, nearly.

    Takes time in proportion to the page, however it is broken or nested.
    """
    page = page or ""
    p = _Page()
    unclosed: set[str] = set()  # kinds of quotes that don't occur again
    at = begin = 0  # what is read, and where text that isn't taken yet begins
    while (at := page.find("<", at)) >= 0:
        closing = page.startswith("/", at + 1)
        name = _NAME.match(page, at + 1 + closing)
        if not name and not page.startswith(("<!", "<?"), at):
            at += 1  # a plain <
            continue
        p.text(page[begin:at])
        if not name:
            found = _COMMENT_END.search(page, at + 4) if page.startswith("<!--", at) else None
            end = found.end() if found else len(page) if page.startswith("<!--", at) else page.find(">", at) + 1 or len(page)
            at = begin = end
            continue
        tag, end = name[0].lower(), _tag_end(page, name.end(), unclosed)
        attributes = page[name.end() : end]
        at = begin = end + 1
        if closing:
            if p.at.get(tag):
                p.pop_to(p.at[tag][-1])
            elif tag in BLOCK:
                p.close_block()
            continue
        if tag == "br":
            p.parts.append(" ")
            p.breaks += 1
            continue
        if tag in CLOSES_P and (k := p.last(("p",))) >= 0 and not p.holds_block(k + 1):
            p.pop_to(k)
        if tag in ENDS and (k := p.last(ENDS[tag])) > p.last(SCOPE[tag]):
            p.pop_to(k)
        if tag in BLOCK:
            p.close_block()
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:  # their content isn't markup
            found = _RAW_END[tag].search(page, at)
            if tag == "xmp":  # shown as it stands
                marks, hidden = _attributes(attributes) if attributes else ((), False)
                p.close_block()
                p.push(tag, marks, hidden)
                p.text(page[at : found.start() if found else len(page)], decoded=True)
                p.close_block()
                p.pop_to(p.at[tag][-1])
            at = begin = (page.find(">", found.end()) + 1 or len(page)) if found else len(page)
            continue
        marks, hidden = _attributes(attributes) if attributes else ((), False)
        p.push(tag, marks, hidden or tag in UNSEEN)
    p.text(page[begin:])
    p.close_block()
    return p.blocks


@functools.lru_cache(1 << 16)
def _feature(name: str) -> int:
    h = 2166136261
    for c in name.encode():
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) % DIMS


def block_features(blocks: list[Block]) -> list[list[int]]:
    """Hashed feature numbers of each block."""
    out = []
    for k, b in enumerate(blocks):
        n = len(b.text)
        words = b.text.count(" ") + 1
        dense = b.linked / n if n else 0
        block, own = (b.node.block, b.node.tag) if b.node else ("none", "none")
        size = next(i for i, x in enumerate((3, 8, 20, 50, 10**12)) if words <= x)
        names = ["bias", f"size{size}", f"own:{block}", f"links{0 if not dense else 1 if dense < 0.5 else 2}", f"end:{b.text[-1:] in '.!?…»”'}", f"size{size}links{int(dense >= 0.5)}", f"first:{k == 0}", f"tag:{own}"]
        if "©" in b.text or "&copy" in b.text:
            names.append("copyright")
        out.append([*map(_feature, names), *(b.node.feats if b.node else ())])
    return out


@dataclass
class Field:
    """State weights (features x 2) and transition weights (2 x 2; row 2: the start)."""

    state: np.ndarray
    step: np.ndarray

    def scores(self, feats: list[list[int]]) -> np.ndarray:
        return np.stack([self.state[f].sum(axis=0) for f in feats])

    def decode(self, feats: list[list[int]]) -> list[int]:
        """Viterbi."""
        if not feats:
            return []
        s = self.scores(feats).tolist()
        t = self.step.tolist()
        best = [t[2][y] + s[0][y] for y in (0, 1)]
        back = []
        for row in s[1:]:
            stay = [[best[x] + t[x][y] for x in (0, 1)] for y in (0, 1)]
            back.append([int(v[1] > v[0]) for v in stay])
            best = [max(v) + row[y] for y, v in enumerate(stay)]
        y = int(best[1] > best[0])
        path = [y]
        for b in reversed(back):
            y = b[y]
            path.append(y)
        return path[::-1]


def _gradient(model: Field, feats: list[list[int]], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Observed less expected counts: for each block and label, and for transitions (forward-backward)."""
    s, t = model.scores(feats), model.step
    n = len(s)
    log = np.logaddexp
    f = np.zeros((n, 2))
    f[0] = t[2] + s[0]
    for k in range(1, n):
        f[k] = [log(f[k - 1][0] + t[0][y], f[k - 1][1] + t[1][y]) + s[k][y] for y in (0, 1)]
    b = np.zeros((n, 2))
    for k in range(n - 2, -1, -1):
        b[k] = [log(t[x][0] + s[k + 1][0] + b[k + 1][0], t[x][1] + s[k + 1][1] + b[k + 1][1]) for x in (0, 1)]
    z = log(*f[-1])
    p = np.exp(f + b - z)
    state = -p
    state[np.arange(n), labels] += 1
    step = np.zeros((3, 2))
    step[2, labels[0]] += 1
    step[2] -= p[0]
    for k in range(1, n):
        step[labels[k - 1], labels[k]] += 1
        step[:2] -= np.exp(f[k - 1][:, None] + t[:2] + (s[k] + b[k])[None, :] - z)
    return state, step


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = ROUNDS) -> Field:
    model = Field(np.zeros((DIMS, 2)), np.zeros((3, 2)))
    seen = np.full((DIMS, 2), 1e-6)
    ready = [(block_features(b), y) for b, y in pages if b]
    order = random.Random(SEED)
    for _ in range(rounds):
        order.shuffle(ready)
        for feats, labels in ready:
            state, step = _gradient(model, feats, labels)
            grad = np.zeros_like(model.state)
            for f, g in zip(feats, state, strict=True):
                np.add.at(grad, f, g)
            at = np.flatnonzero(np.abs(grad).sum(axis=1))
            seen[at] += grad[at] ** 2
            model.state[at] += 0.3 * grad[at] / np.sqrt(seen[at])
            model.state[at] *= 0.9995
            model.step += 0.02 * step
    return model


# --- labelled pages -------------------------------------------------------------------------------------------------------

_NOISE = {
    # fixed values: names by which page parts are commonly marked
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs toc tabs mainmenu",
    "head": "header masthead banner topbar sitehead branding logo",
    "foot": "footer foot bottom colophon copyright legal sitefoot",
    "side": "sidebar aside side widget rail related recommended popular tags trending",
    "note": "cookie notice consent gdpr alert modal popup newsletter subscribe overlay disclaimer",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner promotion adsbygoogle",
    "talk": "comments comment discussion replies reply disqus respond commentlist thread",
    "form": "form search login signup subscribe contact",
    "share": "share social sharing follow meta byline author",
}
_BODY = "content article post entry main story text body page maincontent prose articlebody"
_WRAP = "wrap container row col page site layout inner outer grid section"


def _template_page(rng: random.Random) -> tuple[str, list[int]]:
    """A page from a random layout, and the label of each of its leaf blocks (1: main text)."""
    letters = "aeiou" "bcdfghlmnprstvz"

    def word() -> str:
        return "".join(rng.choice(letters) for _ in range(rng.choice((1, 2, 2, 3, 3, 4, 5, 6, 8))))

    def words(a: int, b: int, end: str = "") -> str:
        return " ".join(word() for _ in range(rng.randint(a, b))).capitalize() + end

    labels: list[int] = []
    name = lambda kind: rng.choice((_NOISE | {"body": _BODY, "wrap": _WRAP})[kind].split())

    def attrs(kind: str, always: bool = False) -> str:
        if not always and rng.random() < 0.3:
            return ""
        value = name(kind) + rng.choice(("", "", f"-{word()}", f" {word()}", f"-{rng.randint(1, 9)}"))
        return f' {rng.choice(("class", "class", "id"))}="{value}"'

    def links(n: int, label: int) -> str:
        labels.extend([label] * n)
        return "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n)) + "</ul>"

    def para(label: int, a: int = 5, b: int = 60) -> str:
        labels.append(label)
        inner = words(a, b, rng.choice((".", ".", ".", "")))
        if rng.random() < 0.2:
            inner += f' <a href="/{word()}">{word()}</a> {words(1, 8, ".")}'
        return f"<p>{inner}</p>" if rng.random() < 0.9 else f"<p><b>{inner}<br>"

    def one(tag: str, label: int, a: int, b: int) -> str:
        labels.append(label)
        return f"<{tag}>{words(a, b, rng.choice(('', '.')))}</{tag}>"

    def noise(kind: str) -> str:
        tag = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}.get(kind)
        named = tag and rng.random() < 0.6
        box = tag if named else "div"
        open_ = f"<{box}{attrs(kind, always=not named)}>"
        if kind == "menu":
            inner = links(rng.randint(2, 8), 0)
        elif kind == "form":
            inner = one("label", 0, 1, 4) if not named else "<input name=q>" + one("p", 0, 1, 6)
        elif kind == "talk":
            inner = one("h3", 0, 1, 3) + "".join(para(0, 3, 40) for _ in range(rng.randint(1, 5)))
        elif kind == "side":
            inner = one("h3", 0, 1, 4) + (links(rng.randint(2, 6), 0) if rng.random() < 0.5 else "".join(para(0, 4, 30) for _ in range(rng.randint(1, 3))))
        elif rng.random() < 0.35:  # bare text in the box
            labels.append(0)
            inner = ("&copy; " if kind == "foot" else "") + words(2, 20, ".")
        else:
            inner = "".join(para(0, 3, 25) for _ in range(rng.randint(1, 2)))
        return f"{open_}{inner}</{box}>"

    def article() -> str:
        parts = [one("h1", 1, 2, 12)]
        if rng.random() < 0.25:
            parts.append(noise("share"))
        for _ in range(rng.randint(1, 12)):
            r = rng.random()
            if r < 0.72:
                parts.append(para(1, 1, 70))
            elif r < 0.8:
                parts.append(one(rng.choice(("h2", "h3")), 1, 1, 8))
            elif r < 0.86:
                n = rng.randint(2, 5)
                labels.extend([1] * n)
                parts.append("<ul>" + "".join(f"<li>{words(2, 15)}</li>" for _ in range(n)) + "</ul>")
            elif r < 0.9:
                parts.append(one("blockquote", 1, 4, 30))
            elif r < 0.93:
                labels.extend([1] * 4)
                parts.append(f"<table><tr><td>{word()}</td><td>{word()}</td></tr><tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr></table>")
            else:
                parts.append(noise(rng.choice(("ad", "side", "note", "ad", "form"))))
        if rng.random() < 0.2:
            parts.append(noise("talk"))
        if rng.random() < 0.15:
            parts.append(noise("share"))
        inner = "".join(parts)
        box = rng.choice(("article", "article", "main", "div", "section"))
        return f"<{box}{attrs('body', always=box in ('div', 'section'))}>{inner}</{box}>"

    top = [noise(k) for k in ("head", "menu", "note", "ad") if rng.random() < 0.55]
    body = article()
    after = [noise(k) for k in ("side", "talk", "ad", "form", "note", "share", "foot") if rng.random() < 0.45]
    if rng.random() < 0.4:
        body = f"<div{attrs('wrap', True)}>{body}"
        tail = "</div>"
    else:
        tail = ""
    return f"<html><head><title>{word()}</title><style>p{{}}</style></head><body>{''.join(top)}{body}{tail}{''.join(after)}</body></html>", labels


def labelled_pages(n: int = PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    rng = random.Random(seed)
    made = [_template_page(rng) for _ in range(n)]
    cut = [(leaf_blocks(page), labels) for page, labels in made]
    assert all(len(b) == len(y) for b, y in cut), "a template's labels must match its blocks"
    return cut


def main_text(page: str | None, model: Field) -> str:
    """The blocks that the field labels as main text, joined by an empty line; empty if there are none."""
    blocks = leaf_blocks(page)
    path = model.decode(block_features(blocks))
    return "\n\n".join(b.text for b, y in zip(blocks, path, strict=True) if y)


def extract(pages: DataFrame, n_pages: int = PAGES) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages (page_id, url, html).

    text is empty if no block is main text, as of null and empty pages; n_chars counts code points. Pages are read whole, in time
    in proportion to their length, however broken or deeply nested;
    repeated rows come out as often as they go in, null ids and urls are kept, other columns are ignored.
    """
    model = train(labelled_pages(n_pages))
    held = pages.sparkSession.sparkContext.broadcast(model)  # DIMS x 2 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [main_text(t, held.value) for t in batch.column("html").to_pylist()]
                cols = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars"])

    kind = pages.select("page_id").schema[0].dataType
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind.simpleString()}, url string, text string, n_chars long")
