"""Operator 9: main-text extraction with boosted trees over DOM nodes.

A page is read by one regular expression into a tree of block nodes (inline
markup stays inside its block; scripts, styles and comments are skipped, scripts
and other raw text up to their own end tag; open paragraphs, list items and
cells are closed as browsers do).  Every node gets features of its subtree
(text, link and tag density), its attribute tokens, its ancestors, depth and
siblings; the trees of ``boosting`` give the log odds that it holds main text.
Decoding is hierarchical: the best set of nodes is taken in which a node is
chosen only if its parent is, so a descendant never contradicts an ancestor.

No labels exist, so the trees are trained on ``MAX_TRAIN_PAGES`` pages (a
bounded sample by the hash of the url) whose text lies in one article or main
element: their paragraphs are set into page frames drawn at random from
``FRAMES`` with menus, adverts, side bars, forms, notices and reader comments
around and between them, and the place of each paragraph is its label.  Each
page is then extracted on its own in one streaming pass.

Defined cases: a null or empty page, or one without text, gives the empty
text; markup that is never closed ends with its page; nesting of any depth is
read in time linear in the tags; repeated rows are each
extracted; without a usable page the frames are filled with built-in words; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evseq.llm import boosting
from evseq.llm.common import pick

MAX_TRAIN_PAGES = 300
# attributes, and > if the tag ends; < outside a quoted value, or the page's end, leaves a tag unfinished
_ATTRIBUTES = r"""((?:[\s/]++|[^\s/><][^\s/>=<]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s><]*+))?+)*+)(>?)"""
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+){_ATTRIBUTES}|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# fixed values: element kinds
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript title iframe".split())  # only their own end tag is markup
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z){_ATTRIBUTES}", re.I) for tag in RAW}
SKIPPED = set("template object svg math".split())  # markup without text for the reader
BLOCK = set(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "nav header footer aside form fieldset legend button select option textarea label figure figcaption blockquote pre "
    "address details summary dialog menu center hgroup".split()
)
CLOSES_P = BLOCK - set("button label select option textarea legend summary".split())
SAME = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
SCOPE = set("ul ol dl table td th article main section div nav header footer aside form body".split())
KINDS = [
    "article main", "section", "div", "p", "h1 h2 h3 h4 h5 h6", "ul ol dl menu", "li dt dd", "table thead tbody tr td th",
    "nav", "header hgroup", "footer", "aside", "form fieldset legend button select option textarea label", "figure figcaption",
    "blockquote pre", "html body",
]
KIND = {tag: i for i, tags in enumerate(KINDS) for tag in tags.split()}
GOOD_WORDS = set("article content post entry main story text body copy prose".split())
BAD_WORDS = {
    word: i
    for i, words in enumerate(
        [
            "ad ads advert advertisement banner sponsor sponsored promo promoted",
            "nav navbar menu navigation breadcrumb breadcrumbs toolbar tabs pager pagination toc",
            "sidebar side aside widget related recommended popular trending more teaser",
            "footer copyright legal colophon masthead header topbar",
            "comment comments reply replies disqus discussion respond feedback",
            "cookie cookies consent notice popup modal overlay alert gdpr privacy paywall",
            "share social subscribe newsletter signup login search form follow author byline meta tags",
        ]
    )
    for word in words.split()
}
N_FEATURES = len(KINDS) + 9 + 8 + 8 + 15


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: tuple[str, ...] = ()
    children: list[int] = field(default_factory=list)
    text: str = ""
    links: int = 0  # characters within links
    tags: int = 1
    chars: int = 0
    marks: int = 0
    paragraphs: int = 0


def _attribute_words(raw: str) -> tuple[str, ...]:
    out: list[str] = []
    for m in ATTRIBUTE.finditer(raw):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "")
        out += re.findall(r"[a-z]+", value.lower())
    return tuple(out)


def parse(page: str | None) -> list[Node]:
    """Block nodes in page order; children always come after their parent."""
    nodes = [Node("html", -1, 0)]
    stack = [0]
    opened: defaultdict[str, list[int]] = defaultdict(list)  # places in the stack by tag, so that nothing walks it
    run: list[str] = []
    run_links = link_depth = 0
    runs: list[tuple[int, str, int]] = []  # (node, text, characters in links)
    page = page or ""

    def flush() -> None:
        nonlocal run_links
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                runs.append((stack[-1], text, min(run_links, len(text))))
                nodes[stack[-1]].children.append(-len(runs))  # resolved below
            run.clear()
        run_links = 0

    def add_text(a: int, b: int) -> None:
        nonlocal run_links
        if b > a:
            run.append(page[a:b])
            if link_depth:
                run_links += b - a

    def close_to(position: int) -> None:
        flush()
        while len(stack) > position:
            opened[nodes[stack.pop()].tag].pop()

    at = pos = 0
    skip_to: str | None = None
    endless: set[str] = set()  # raw elements whose end tag is not found from here on
    while m := TOKEN.search(page, pos):
        pos = m.end()
        if m[2] is not None and not m[4]:
            continue  # an unfinished tag is text; the search goes on where it broke off, so nothing is read twice
        opens = m[2] is not None and not m[1] and not m[3].endswith("/")
        if skip_to is None:
            add_text(at, m.start())
            at = pos
        elif m[1] and m[2].lower() == skip_to:
            skip_to, at = None, pos
            continue
        if opens and (raw := m[2].lower()) in RAW and raw not in endless:
            # a script or the like is no markup: only its own end counts
            if end := RAW_END[raw].search(page, pos):
                at = pos = end.end()
            elif skip_to is None:
                at = pos = len(page)
            else:  # in a drawing, it ends with that
                endless.add(raw)
        if skip_to is not None or m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                link_depth = max(0, link_depth - 1)
            elif tag in BLOCK:
                if opened[tag]:
                    close_to(opened[tag][-1])
                link_depth = 0
            continue
        if stack[-1] < len(nodes):
            nodes[stack[-1]].tags += 1
        if tag in VOID or m[3].endswith("/"):
            if tag in ("br", "hr"):
                run.append(" ")
            continue
        if tag in RAW:
            continue
        if tag in SKIPPED:
            skip_to = tag
            continue
        if tag == "a":
            link_depth += 1
        if tag not in BLOCK:
            continue
        flush()
        link_depth = 0
        if tag in ("html", "body"):
            nodes[0].words += _attribute_words(m[3])
            continue
        ends = set(SAME.get(tag, "").split()) | ({"p"} if tag in CLOSES_P else set())
        if here := [opened[t][-1] for t in ends if opened[t]]:
            scope = max((opened[t][-1] for t in SCOPE - ends if opened[t]), default=0)
            if max(here) > scope:
                close_to(max(here))
        parent = stack[-1]
        nodes.append(Node(tag, parent, nodes[parent].depth + 1, _attribute_words(m[3])))
        nodes[parent].children.append(len(nodes) - 1)
        opened[tag].append(len(stack))
        stack.append(len(nodes) - 1)
    if skip_to is None:
        add_text(at, len(page))
    flush()
    # a run is its block's text, or a node of its own beside block children
    for i in range(len(nodes)):
        node = nodes[i]
        own = [c for c in node.children if c < 0]
        if len(own) == 1 and len(node.children) == 1:
            _, node.text, node.links = runs[-own[0] - 1]
            node.children = []
        else:
            for k, c in enumerate(node.children):
                if c < 0:
                    _, text, links = runs[-c - 1]
                    nodes.append(Node("#text", i, node.depth + 1, text=text, links=links, tags=0))
                    node.children[k] = len(nodes) - 1
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    """(nodes, N_FEATURES); fills in the subtree sums of the nodes."""
    for node in reversed(nodes):
        node.chars += len(node.text)
        node.marks += sum(map(node.text.count, ".,;:!?"))
        node.paragraphs += node.tag == "p" and len(node.text) > 40
        if node.parent >= 0:
            up = nodes[node.parent]
            up.chars += node.chars
            up.links += node.links
            up.tags += node.tags
            up.marks += node.marks
            up.paragraphs += node.paragraphs
    total = max(1, nodes[0].chars)
    out = np.zeros((len(nodes), N_FEATURES))
    above = [np.zeros(16)] * len(nodes)  # counts of what the ancestors are
    largest = [max((nodes[c].chars for c in node.children), default=0) for node in nodes]
    seen = 0
    order = _page_order(nodes)
    place = {}
    for i in order:
        place[i] = seen
        seen += len(nodes[i].text)
    for i in order:
        node = nodes[i]
        kind = KIND.get(node.tag)
        if kind is not None:
            out[i, kind] = 1
        base = len(KINDS)
        out[i, base] = sum(w in GOOD_WORDS for w in node.words)
        for w in node.words:
            if w in BAD_WORDS:
                out[i, base + 1 + BAD_WORDS[w]] += 1
        out[i, base + 8] = len(node.words)
        base += 9
        up = above[node.parent] if node.parent >= 0 else np.zeros(16)
        out[i, base : base + 16] = up
        mine = up.copy()
        mine[0] += out[i, len(KINDS)]
        mine[1:8] += out[i, len(KINDS) + 1 : len(KINDS) + 8]
        for k, tags in enumerate(("article", "main", "nav", "header", "footer", "aside", "form", "li")):
            mine[8 + k] += node.tag == tags
        above[i] = mine
        base += 16
        chars = max(1, node.chars)
        siblings = nodes[node.parent].children if node.parent >= 0 else [i]
        most = largest[node.parent] if node.parent >= 0 else node.chars
        n_words = node.text.count(" ") + 1 if node.text else 0
        mean = (nodes[node.parent].chars / len(siblings)) if node.parent >= 0 else chars
        out[i, base:] = (
            node.depth, np.log1p(node.chars), np.log1p(n_words), node.links / chars, node.tags / chars, node.marks / chars,
            node.paragraphs, node.chars / total, place[i] / total, (place[i] + node.chars) / total, len(siblings),
            node.chars / max(1.0, mean), most / total, np.log1p(mean), len(node.children),
        )
    return out


def _page_order(nodes: list[Node]) -> list[int]:
    out, todo = [], [0]
    while todo:
        i = todo.pop()
        out.append(i)
        todo.extend(reversed(nodes[i].children))
    return out


def decode(nodes: list[Node], log_odds: np.ndarray) -> list[bool]:
    """The set of nodes of most weight in which each node's parent is chosen."""
    gain = log_odds.astype(float).copy()
    for i in range(len(nodes) - 1, 0, -1):
        # children come after their parent, so gain[i] is complete here
        gain[nodes[i].parent] += max(0.0, gain[i])
    chosen = [False] * len(nodes)
    for i in _page_order(nodes):
        parent = nodes[i].parent
        chosen[i] = gain[i] > 0 and (parent < 0 or chosen[parent])
    return chosen


def main_text(nodes: list[Node], chosen: list[bool]) -> str:
    return " ".join(nodes[i].text for i in _page_order(nodes) if chosen[i] and nodes[i].text)


# ---------------------------------------------------------------- training

#: page frames; {A} the article, {L} a list of links, {S} a short text, {W} a few words, {C} reader comments
FRAMES = [
    '<body><nav><ul>{L}</ul></nav><div class="ad">{S}</div><article>{A}</article><footer>&copy; {W} &middot; {S}</footer></body>',
    '<body><header><h1>{W}</h1><nav>{L}</nav></header><main><article>{A}</article><section class="comments">{C}</section></main>'
    "<aside><h3>{W}</h3><ul>{L}</ul><p>{S}</p></aside><footer><p>{S}</p></footer></body>",
    '<body><div id="header"><a href="/">{W}</a></div><div class="menu"><ul>{L}</ul></div><div id="content"><div class="post">{A}</div>'
    '<div class="comments"><h2>{W}</h2>{C}</div></div><div id="sidebar"><p>{S}</p><ul>{L}</ul></div><div id="footer">{S}</div></body>',
    '<body><div class="cookie-notice"><p>{S}</p><button>{W}</button></div><div class="wrap"><ul class="breadcrumbs">{L}</ul><main>{A}'
    '<div class="share"><ul>{L}</ul></div></main><div class="related"><h3>{W}</h3><p>{S}</p><ul>{L}</ul></div></div><footer><nav>{L}</nav>{S}</footer></body>',
    '<body><table><tr><td class="navigation">{L}</td><td class="main">{A}<form><label>{W}</label><textarea>{S}</textarea><button>{W}</button></form></td>'
    '<td class="side"><p>{S}</p></td></tr></table><p class="copyright">{S}</p></body>',
    '<body><header class="masthead"><p>{S}</p><form><input><button>{W}</button></form></header><section class="story">{A}</section>'
    '<section id="respond"><h3>{W}</h3>{C}<form><label>{W}</label></form></section><aside class="banner"><p>{S}</p></aside><footer>{L}</footer></body>',
]
INSIDE = [
    '<div class="ad">{S}</div>', '<aside><p>{S}</p></aside>', '<div class="promo"><h4>{W}</h4><p>{S}</p></div>',
    '<form><label>{W}</label><button>{W}</button></form>', '<nav><ul>{L}</ul></nav>', '<div class="newsletter"><p>{S}</p></div>',
    "", "", "", "", "",
]
MARK = "\ue000"  # a private-use character marks the paragraphs of the article
FILLER = [
    "the river ran past the mill and the old road, and the people of the town came down to it in the evening.",
    "a letter came in the spring; it told of a long journey, of ships and of a winter in the north.",
    "they had counted the stones twice before the rain began, and no number was the same as the last.",
    "in the market the price of bread rose again, so the bakers met and agreed to wait for the harvest.",
]


def build_page(rng: random.Random, paragraphs: list[str]) -> str:
    """A page with the marked paragraphs as article, framed at random."""

    def words(n: int) -> str:
        source = rng.choice(paragraphs).split() or ["x"]
        a = rng.randrange(len(source))
        return html.escape(" ".join(source[a : a + n]))

    def fill(frame: str) -> str:
        frame = re.sub(r"\{L\}", lambda _: "".join(f'<li><a href="/{k}">{words(rng.randint(1, 3))}</a></li>' for k in range(rng.randint(2, 8))), frame)
        comment = lambda _: "".join(
            rng.choice(('<div class="comment"><p>{}</p></div>', '<ol><li class="comment">{}</li></ol>', '<article class="comment"><p>{}</p></article>')).format(words(rng.randint(5, 40)))
            for k in range(rng.randint(1, 4))
        )
        frame = re.sub(r"\{C\}", comment, frame)
        frame = re.sub(r"\{S\}", lambda _: words(rng.randint(4, 40)), frame)
        return re.sub(r"\{W\}", lambda _: words(rng.randint(1, 4)), frame)

    own = rng.sample(paragraphs, min(len(paragraphs), rng.randint(1, 12)))
    if rng.random() < 0.04:  # long articles
        own = rng.choices(paragraphs, k=rng.randint(50, 400))
    elif rng.random() < 0.25:  # short articles
        own = [" ".join(p.split()[: rng.randint(1, 12)]) or p for p in own[: rng.randint(1, 2)]]
    parts = [f"<h1>{MARK}{html.escape(own[0][: rng.randint(20, 80)])}</h1>"]
    for p in own:
        shape = rng.random()
        text = MARK + html.escape(p)
        if shape < 0.7:
            parts.append(f"<p>{text}</p>")
        elif shape < 0.85:
            parts.append(f"<p><b>{text}<br>")
        elif shape < 0.9:
            parts.append(f"<blockquote>{text}</blockquote>")
        elif shape < 0.95:
            parts.append(f"<ul><li>{text}</li><li>{text}</li></ul>")
        else:
            parts.append(f"<h2>{MARK}{html.escape(p[:40])}</h2><p>{text}</p>")
        parts.append(fill(rng.choice(INSIDE)))
    return fill(rng.choice(FRAMES)).replace("{A}", "".join(parts))


def article_paragraphs(page: str | None) -> list[str]:
    """Block texts of a page's only article or main element, or none."""
    nodes = parse(page)
    roots = [i for i, n in enumerate(nodes) if n.tag == "article"] or [i for i, n in enumerate(nodes) if n.tag == "main"]
    if len(roots) != 1:
        return []
    inside = {roots[0]}
    for i in range(len(nodes)):
        if nodes[i].parent in inside:
            inside.add(i)
    return [nodes[i].text for i in _page_order(nodes) if i in inside and nodes[i].text and MARK not in nodes[i].text]


def train(pages: DataFrame, html_col: str = "html", url_col: str = "url", max_pages: int = MAX_TRAIN_PAGES) -> boosting.Forest:
    usable = (
        pick(pages, url=url_col, html=html_col)
        .filter(F.octet_length("html").between(200, 200_000))  # training pages only; extraction reads every page
        .withColumn("h", F.xxhash64("url", "html"))
    )
    # the max_pages least hashes first, then their pages: no task sends pages that are not used
    last = usable.select("h").distinct().orderBy("h").limit(max_pages).agg(F.max("h")).first()[0]
    sample = usable.filter(F.col("h") <= F.lit(last)).dropDuplicates(["h"]).orderBy("h").collect() if last is not None else []
    rng = random.Random(9)
    texts = [p for r in sample if (p := article_paragraphs(r["html"]))] or [FILLER]
    x, y = [], []
    for k in range(2 * max_pages):
        nodes = parse(build_page(rng, texts[k % len(texts)]))
        holds = [MARK in n.text for n in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            holds[nodes[i].parent] |= holds[i]
        for n in nodes:
            n.text = n.text.replace(MARK, "")
        x.append(features(nodes))
        y += holds
    return boosting.fit(np.concatenate(x), np.array(y, dtype=float), trees=150, depth=6)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: boosting.Forest | None = None) -> DataFrame:
    """Per page: page_id, url, text."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train(pages, html_col, url_col))
    base = pick(pages, page_id=id_col, url=url_col, html=html_col)

    def run(batches):
        forest = shared.value
        for batch in batches:
            texts: list[str] = []
            group: list[list[Node]] = []
            rows = 0
            sources = batch.column(2).to_pylist()
            for k, page in enumerate(sources):
                group.append(parse(page))
                rows += len(group[-1])
                if rows > 20_000 or k == len(sources) - 1:
                    odds = forest.raw(np.concatenate([features(nodes) for nodes in group]))
                    at = 0
                    for nodes in group:
                        texts.append(main_text(nodes, decode(nodes, odds[at : at + len(nodes)])))
                        at += len(nodes)
                    group, rows = [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    types = {f.name: f.dataType.simpleString() for f in base.schema}
    return base.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string")
