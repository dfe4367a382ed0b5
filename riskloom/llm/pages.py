"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is read into a tree of block elements, elements that carry names, and runs of text. Every
node gets features of its subtree (size, density, links, punctuation), its place among siblings and
ancestors, and the tokens of its tag, class, id and role, own and inherited. Boosted trees, fitted
on pages built here with known main text, give each node the log odds of holding or lying in it. The
decoding takes the choice of highest total odds in which no kept node stands under a dropped one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.store import fresh

PAGES = 600           # pages that are built to learn from
ROUNDS, DEPTH, RATE = 120, 4, 0.3
COLUMNS = 40          # features that one tree chooses from
BINS = 32
NODES = 1 << 14       # nodes scored at once, or one page
CLIP = 6.0            # bound of one node's log odds

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template svg iframe textarea select object canvas math".split())
HEAD = frozenset("html base basefont bgsound link meta title script style noscript template noframes".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
                    "small span strike strong sub sup time tt u var br wbr img").split())
CLOSES_P = frozenset(("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
                      "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul").split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
          "th": ("tr", "table"), "option": ("select",)}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
# The end of an element whose content is passed over; nothing else counts as a tag up to there.
_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW | {"title"}}
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[a-z]+")
_STOP = re.compile(r"[.!?;:,]")


class Tree:
    """Nodes in page order (parents first) and the text segments with their node and block."""

    def __init__(self, page: str):
        self.parent, self.tag, self.tokens = [-1], ["#page"], [("#page",)]
        self.segments: list[tuple[int, int, str, bool]] = []  # node, block, text, inside a link
        self.controls: list[int] = [0]
        self._read(page)

    def _node(self, parent: int, tag: str, tokens: tuple) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.tokens.append(tokens)
        self.controls.append(0)
        return len(self.parent) - 1

    def _read(self, page: str) -> None:
        stack: list[tuple[str, int]] = [("#page", 0)]  # open tags and their nodes
        opened: dict[str, int] = {}                    # how many of each tag are open
        block, run, links, at, head = 0, None, 0, 0, False
        while (m := _TAG.search(page, at)) is not None:
            text = page[at:m.start()]
            head = head and (not text or text.isspace())
            if text and not head:
                if not text.isspace():
                    if run is None or run[0] != stack[-1][1]:
                        run = (stack[-1][1], self._node(stack[-1][1], "#text", ("#text",)))
                    self.segments.append((run[1], block, html.unescape(text), links > 0))
                elif self.segments:
                    self.segments.append((self.segments[-1][0], block, " ", False))
            at = m.end()
            close, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if tag is None:
                continue
            tag = tag.lower()
            if tag == "head":
                head = not close
                continue
            # A head without its end tag goes to the first thing that cannot stand in one.
            head = head and (tag not in ("body", "html", "br") if close else tag in HEAD)
            if tag in RAW or (head and tag == "title"):
                if not close and not rest.endswith("/"):
                    end = _END[tag].search(page, at)
                    at = end.end() if end else len(page)
                if tag in ("select", "textarea"):
                    self.controls[stack[-1][1]] += 1
                continue
            if head:
                continue
            if close:
                if tag in ("html", "body") or not opened.get(tag):
                    continue
                while True:
                    t, _ = stack.pop()
                    opened[t] -= 1
                    links -= t == "a"
                    if t not in INLINE:
                        block, run = block + 1, None
                    if t == tag:
                        break
                continue
            if tag in VOID:
                if tag == "br":
                    if self.segments:
                        self.segments.append((self.segments[-1][0], block, " ", False))
                elif tag == "input":
                    self.controls[stack[-1][1]] += 1
                elif tag == "hr":
                    block, run = block + 1, None
                continue
            if tag in CLOSES_P:
                self._pop(stack, opened, ("p",), ())
            if tag in CLOSES:
                self._pop(stack, opened, CLOSES[tag], SCOPES[tag])
            named = tuple(w for a in _ATTRIBUTE.finditer(rest) for w in _TOKEN.findall(
                (a[2] or a[3] or a[4] or "").lower())) if rest else ()
            if tag not in INLINE:
                block, run = block + 1, None
            if tag not in INLINE or named:
                stack.append((tag, self._node(stack[-1][1], tag, ("<" + tag, *named))))
            else:
                stack.append((tag, stack[-1][1]))
            opened[tag] = opened.get(tag, 0) + 1
            links = opened.get("a", 0)
            self.controls[stack[-1][1]] += tag == "button"
        if at < len(page) and not page[at:].isspace():
            node = self._node(stack[-1][1], "#text", ("#text",))
            self.segments.append((node, block, html.unescape(page[at:]), links > 0))

    @staticmethod
    def _pop(stack: list, opened: dict[str, int], tags: tuple, scopes: tuple) -> None:
        """Close the innermost open tag of ``tags`` with all inside it, within the scope."""
        if not any(opened.get(t) for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                for t, _ in stack[k:]:
                    opened[t] -= 1
                del stack[k:]
                return
            if stack[k][0] in scopes or (not scopes and stack[k][0] in ("table", "td", "button")):
                return

    def text(self, kept: np.ndarray) -> str:
        """Blocks of the kept nodes, white space made single, joined by an empty line."""
        blocks: dict[int, list[str]] = {}
        for node, block, text, _ in self.segments:
            if kept[node]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
        return "\n\n".join(line for line in lines if line)


NUMBERS = ("depth", "chars", "linked", "nodes", "density", "words", "stops", "share", "place", "siblings", "alike",
           "parent density", "parent linked", "paragraphs", "own chars", "controls", "longest")


def numbers(tree: Tree) -> np.ndarray:
    """Numeric features of all nodes."""
    n = len(tree.parent)
    parent = tree.parent
    chars, linked, words, stops, own, longest = (np.zeros(n) for _ in range(6))
    for node, _, text, link in tree.segments:
        size = len(text)
        chars[node] += size
        if link:
            linked[node] += size
        words[node] += text.count(" ") + 1
        stops[node] += len(_STOP.findall(text))
    own[:] = chars
    longest[:] = chars
    nodes, paragraphs = np.ones(n), np.array([t == "p" for t in tree.tag], float)
    controls = np.array(tree.controls, float)
    depth, children, alike = np.zeros(n), np.zeros(n), np.zeros(n)
    place, kinds = np.zeros(n), {}
    for k in range(1, n):
        p = parent[k]
        depth[k] = depth[p] + 1
        place[k] = children[p]
        children[p] += 1
        kinds[p, tree.tag[k]] = kinds.get((p, tree.tag[k]), 0) + 1
    for k in range(n - 1, 0, -1):
        p = parent[k]
        for sums in (chars, linked, words, stops, nodes, paragraphs, controls):
            sums[p] += sums[k]
        longest[p] = max(longest[p], longest[k])
    up = np.maximum(np.array(parent), 0)
    alike[1:] = [kinds[parent[k], tree.tag[k]] for k in range(1, n)]
    density, links = chars / nodes, linked / np.maximum(chars, 1)
    return np.stack([
        depth, np.log1p(chars), links, np.log1p(nodes), np.log1p(density), np.log1p(words),
        stops / np.maximum(words, 1), chars / max(chars[0], 1), place, children[up], alike, np.log1p(density[up]),
        links[up], np.log1p(paragraphs), np.log1p(own), controls, np.log1p(longest)], axis=1)


def tokens(tree: Tree, known: dict[str, int]) -> np.ndarray:
    """Which known tokens a node has, and which its ancestors have."""
    out = np.zeros((len(tree.parent), 2, len(known)), np.uint8)
    for k, own in enumerate(tree.tokens):
        for t in own:
            if t in known:
                out[k, 0, known[t]] = 1
        if k:
            p = tree.parent[k]
            np.maximum(out[p, 0], out[p, 1], out=out[k, 1])
    return out.reshape(len(tree.parent), -1)


class Model:
    """Boosted trees on binned features; a tree is three flat arrays, children at 2k+1 and 2k+2."""

    def __init__(self, known: dict[str, int], cuts: list[np.ndarray]):
        self.known, self.cuts, self.trees, self.start = known, cuts, [], 0.0

    def binned(self, tree: Tree) -> np.ndarray:
        values = numbers(tree)
        bins = [np.searchsorted(c, values[:, k], side="right") for k, c in enumerate(self.cuts)]
        return np.concatenate([np.stack(bins, axis=1).astype(np.uint8), tokens(tree, self.known)], axis=1)

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += value[at]
        return np.clip(out, -CLIP, CLIP)

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        width = x.shape[1]
        self.start = float(np.log(y.mean() / (1 - y.mean())))
        odds = np.full(len(y), self.start)
        rng = np.random.Generator(np.random.PCG64(1))
        for _ in range(ROUNDS):
            chosen = np.sort(rng.choice(width, min(COLUMNS, width), replace=False))
            flat = x[:, chosen] + np.arange(len(chosen)) * BINS
            p = 1 / (1 + np.exp(-odds))
            gain, weight = y - p, p * (1 - p)
            at = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, 255, np.int64)
            for node in range(2**DEPTH - 1):
                rows = np.flatnonzero(at == node)
                if len(rows) >= 20:
                    spots = flat[rows].ravel()
                    g, w = (np.bincount(spots, np.repeat(v[rows], len(chosen)), len(chosen) * BINS)
                            .reshape(-1, BINS) for v in (gain, weight))
                    gl, wl = g.cumsum(axis=1), w.cumsum(axis=1)
                    gr, wr = gl[:, -1:] - gl, wl[:, -1:] - wl
                    score = np.where((wl > 0.1) & (wr > 0.1), gl**2 / (wl + 1) + gr**2 / (wr + 1), -np.inf)
                    f, c = np.unravel_index(np.argmax(score), score.shape)
                    if score[f, c] > gl[f, -1]**2 / (wl[f, -1] + 1) + 1e-6:
                        feature[node], cut[node] = chosen[f], c
                at[rows] = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            value = np.zeros(2**(DEPTH + 1) - 1)
            g, w = (np.bincount(at, v, len(value)) for v in (gain, weight))
            value = RATE * g / (w + 1)
            self.trees.append((feature, cut, value))
            odds += value[at]


def decode(parent: list[int], odds: np.ndarray) -> np.ndarray:
    """Best choice of nodes with no kept node under a dropped one."""
    keep, drop = odds.astype(float).copy(), -odds.astype(float)
    for k in range(len(parent) - 1, 0, -1):
        keep[parent[k]] += max(keep[k], drop[k])
        drop[parent[k]] += drop[k]
    out = np.zeros(len(parent), bool)
    out[0] = keep[0] > drop[0]
    for k in range(1, len(parent)):
        out[k] = out[parent[k]] and keep[k] > drop[k]
    return out


# Names that page parts go by. Main parts, then parts that are none.
_MAIN = [("article", ""), ("main", ""), ("article", "post entry"), ("div", "content"), ("div", "article body"),
         ("div", "post content"), ("section", "story"), ("div", "entry content"), ("main", "main content"), ("div", "main")]
_PARTS = {
    "nav": [("nav", ""), ("ul", "menu"), ("div", "nav menu"), ("div", "breadcrumb"), ("nav", "navigation")],
    "header": [("header", ""), ("div", "header"), ("div", "masthead banner"), ("div", "topbar")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "copyright legal"), ("div", "bottom")],
    "side": [("aside", ""), ("div", "sidebar"), ("div", "widget"), ("section", "related"), ("div", "recommended")],
    "notice": [("div", "cookie notice"), ("div", "consent banner"), ("div", "alert"), ("div", "modal popup"),
               ("div", "gdpr")],
    "advert": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("aside", "sponsored"), ("div", "promo"),
               ("div", "advertisement")],
    "form": [("form", ""), ("form", "search"), ("div", "newsletter subscribe"), ("div", "login signup")],
    "comments": [("div", "comments"), ("section", "comments"), ("ol", "commentlist comment"), ("div", "replies"),
                 ("div", "disqus thread"), ("div", "discussion responses")],
    "social": [("div", "share"), ("div", "social"), ("ul", "tags"), ("div", "author bio"), ("div", "pagination")],
}


def _training_page(rng: np.random.Generator) -> tuple[str, str]:
    """A page and its main text; the texts of the parts do not tell them apart."""
    def pick(items):
        return items[int(rng.integers(len(items)))]

    def sentence(low: int, high: int) -> str:
        size = int(rng.integers(low, high + 1))
        words = ["".join(pick("abdeilmnorstuvé") for _ in range(int(rng.integers(1, 10)))) for _ in range(size)]
        return " ".join(words).capitalize() + pick(["", ".", ".", "!", " ###", ","])

    def paragraph() -> str:
        return " ".join(sentence(1, 18) for _ in range(int(rng.integers(1, 8))))

    def wrap(kind: tuple[str, str], inner: str) -> str:
        tag, names = kind
        names = pick([names, "-".join(names.split()), "_".join(names.split())])
        if rng.random() < 0.2:
            names += " box" + str(int(rng.integers(9)))
        attribute = f' {pick(["class", "class", "id"])}="{names.strip()}"' if names.strip() else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def part(name: str) -> str:
        links = "".join(f'<li><a href="/{k}">{sentence(1, 4)}</a></li>' for k in range(int(rng.integers(2, 9))))
        prose = "".join(f"<p>{paragraph()}</p>" for _ in range(int(rng.integers(1, 5))))
        inner = {
            "nav": f"<ul>{links}</ul>", "header": pick([f"<p>{sentence(1, 8)}</p>", f"<ul>{links}</ul>"]),
            "footer": pick([f"&copy; {sentence(2, 20)} {sentence(1, 12)}", f"<p>{sentence(2, 20)}</p>", f"<ul>{links}</ul>"]),
            "side": pick([f"<h3>{sentence(1, 5)}</h3><ul>{links}</ul>", prose]), "notice": pick([paragraph(), prose]),
            "advert": pick([sentence(2, 14), paragraph(), prose]),
            "form": f"<label>{sentence(1, 4)}</label><input><button>{sentence(1, 2)}</button>",
            "comments": pick([prose, "".join(f'<div class="comment">{paragraph()}</div>' for _ in range(3)),
                              "".join(f"<li><p>{paragraph()}</p></li>" for _ in range(3))]),
            "social": pick([f"<ul>{links}</ul>", sentence(1, 12)]),
        }[name]
        return wrap(pick(_PARTS[name]), inner)

    kept: list[str] = []

    def say(text: str) -> str:
        kept.append(" ".join(text.split()))
        return text

    body = [f"<h1>{say(sentence(1, 14))}</h1>"] if rng.random() < 0.9 else []
    for _ in range(int(rng.integers(1, pick([3, 14])))):
        roll = rng.random()
        if roll < 0.65:
            body.append(f"<p>{say(paragraph())}</p>")
        elif roll < 0.72:
            body.append(f"<p><b>{say(paragraph())}<br><p>{say(sentence(1, 9))}</p>")
        elif roll < 0.78:
            body.append(f"<h2>{say(sentence(1, 8))}</h2>")
        elif roll < 0.84:
            body.append("<ul>" + "".join(f"<li>{say(sentence(1, 12))}</li>" for _ in range(3)) + "</ul>")
        elif roll < 0.9:
            body.append(f"<blockquote>{say(paragraph())}</blockquote>")
        else:
            body.append(part(pick(["advert", "social", "form", "side", "notice", "comments"])))
    inside = "".join(body)
    if rng.random() < 0.4:
        main = wrap(pick(_MAIN), inside)
    else:
        # Names that say nothing, or none, and any layout: what tells is the text and what the parts are.
        def invented() -> str:
            kind = rng.random()
            name = "".join(pick("bcdfghklmnprstvwxz") + pick("aeiou") for _ in range(int(rng.integers(1, 4))))
            return f' {pick(["class", "id"])}="{pick(["", "", "x", "c"])}{name}{pick(["", "", "12", " row", " col", " wrap"])}"' if kind < 0.7 else ""

        layout = int(rng.integers(7))
        main = {
            0: lambda: inside,
            1: lambda: f"<div{invented()}>{inside}</div>",
            2: lambda: f"<section{invented()}>{inside}</section>",
            3: lambda: f"<div{invented()}><div{invented()}><div{invented()}>{inside}</div></div></div>",
            4: lambda: f"<table{invented()}><tr><td{invented()}>{inside}</td></tr></table>",
            5: lambda: f"<div{invented()}><div{invented()}>{inside}</div></div>",
            6: lambda: "".join(f"<div{invented()}>{b}</div>" for b in body),
        }[layout]()
    names = list(_PARTS)
    before = [part(pick(["nav", "header", "notice", "advert", "side", "form"])) for _ in range(int(rng.integers(0, 4)))]
    after = [part(pick(["comments", "comments", "side", "footer", "advert", "social", "form", "notice", pick(names)]))
             for _ in range(int(rng.integers(0, 4)))]
    rest = part("footer") if rng.random() < 0.8 else ""
    whole = "".join([*before, main, *after])
    if rng.random() < 0.3:
        whole = f'<div class="{pick(["wrapper", "container", "page"])}">{whole}</div>'
    end = "</body></html>" if rng.random() < 0.8 else ""
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{whole}{rest}{end}", "\n\n".join(k for k in kept if k)


def _labels(tree: Tree, main: str) -> np.ndarray:
    """Whether a node lies in the main text or holds some of it; texts of a page are distinct."""
    known = set(main.split("\n\n"))
    blocks: dict[int, list[str]] = {}
    for _, block, text, _ in tree.segments:
        blocks.setdefault(block, []).append(text)
    good = {b for b, parts in blocks.items() if " ".join("".join(parts).split()) in known}
    out = np.zeros(len(tree.parent))
    for node, block, text, _ in tree.segments:
        if block in good and text.strip():
            out[node] = 1
    for k in range(len(tree.parent) - 1, 0, -1):
        out[tree.parent[k]] = max(out[tree.parent[k]], out[k])
    return out


@lru_cache(maxsize=1)
def trained(pages: int = PAGES, seed: int = 20240804) -> Model:
    """Fit on ``pages`` built pages."""
    rng = np.random.Generator(np.random.PCG64(seed))
    made = [_training_page(rng) for _ in range(pages)]
    trees = [Tree(page) for page, _ in made]
    seen: dict[str, int] = {}
    for tree in trees:
        for t in {t for own in tree.tokens for t in own}:
            seen[t] = seen.get(t, 0) + 1
    common = sorted(t for t, n in seen.items() if n >= 3)
    values = np.concatenate([numbers(t) for t in trees])
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    model = Model({t: k for k, t in enumerate(common)}, [np.unique(np.quantile(v, shares)) for v in values.T])
    model.fit(np.concatenate([model.binned(t) for t in trees]),
              np.concatenate([_labels(t, main) for t, (_, main) in zip(trees, made)]))
    return model


def texts(model: Model, pages: list[str | None]) -> Iterator[str]:
    """Main text of each page."""
    def scored(trees):
        rows = [model.binned(t) for t in trees]
        odds = model.odds(np.concatenate(rows))
        at = 0
        for tree, row in zip(trees, rows):
            yield tree.text(decode(tree.parent, odds[at:at + len(row)]))
            at += len(row)

    held: list[Tree] = []
    for page in pages:
        held.append(Tree(page or ""))
        if sum(len(t.parent) for t in held) >= NODES:
            yield from scored(held)
            held = []
    if held:
        yield from scored(held)


def main_text(pages: DataFrame, html_column: str = "html", text: str = "text", model: Model | None = None) -> DataFrame:
    """``pages`` with its main text under the name ``text`` (empty if there is none).

    Null and empty pages give an empty text. All other columns stay, a column of that name is
    replaced. Repeated rows give repeated results, an empty table an empty one.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model or trained())
    old = [c for c in pages.columns if c != text]
    rows = pages.select(*old, F.col(html_column).alias(fresh(pages.columns, "source")))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = list(texts(sent.value, part.column(part.num_columns - 1).to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.string())], names=[*old, text])

    return rows.mapInArrow(run, pages.select(*old).schema.add(text, "string"))
