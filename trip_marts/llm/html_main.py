"""Main text of web pages, by boosted trees over nodes and a decoding of the tree.

Markup becomes a tree of block elements, of which every own block of text is a leaf;
inline elements only mark text. Features of a node are its depth, size and share of the page, density of text and links in its
subtree, its tag, the tokens of its attributes and those of its ancestors, and how
it compares with its siblings. Trees are trained on a bounded sample of the pages
themselves: landmarks (`article`, `main`, telling class names; `nav`, `footer`,
`form` and the like) label the nodes. Every page comes a second time with tags and
attributes hidden, so that pages without landmarks are decided by structure, a
third time with some blocks turned into notices, comments and the like, and further times
with short prose beside the main text under no telling name, with parts of the main text
inside further elements, and as main text alone.

Decoding finds the likeliest labels for which a dropped node has no kept descendant
and a kept node no dropped ancestor.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_marts.llm import boosting
from trip_marts.llm.shared import map_texts

#: Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span"
    " strike strong sub sup time tt u var wbr ruby rb rt rp input select option button textarea".split()
)
#: Text up to the end tag, or to the end of the page without one.
RAW = frozenset("script style textarea title".split())
#: Elements without text of the page, left out with all they hold up to their end tag.
UNSEEN = ("script", "style", "noscript", "template", "svg", "title", "iframe", "object", "canvas", "select", "textarea", "button")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog address".split())
MAIN_TAGS = frozenset("article main".split())
#: Words in attributes that tell main text and the rest apart.
MAIN_WORDS = frozenset("article articlebody main content post entry story body text maincontent postbody".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs"
    " header masthead footer sidebar aside related share social comment comments reply disqus cookie consent notice alert"
    " popup modal newsletter subscribe signup login form search pagination pager widget toolbar copyright legal"
    " cookies gdpr overlay privacy disclaimer responses replies discussion feedback reactions reviews trending recommended toc".split()
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*)|[^>=]+)*)(?:>|\Z)", re.S)
_WORD = re.compile(r"[A-Za-z]+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Attributes that hold text, addresses, code or style, not names.
_SPOKEN = re.compile(r"(?<![\w-])(?:style|title|href|src|srcset|alt|content|placeholder|cite|datetime|value|on[a-z]+)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*)", re.I)
_CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}


TEXT = "#text"


@dataclass
class Page:
    """Block elements and leaves of text in page order, and blocks of text with their leaves."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    words: list[frozenset[str]] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # leaf, text, characters in links

    def add(self, tag: str, parent: int, words: frozenset[str] = frozenset()) -> int:
        """A new last node; its number."""
        self.tags.append(tag)
        self.parents.append(parent)
        self.words.append(words)
        return len(self.tags) - 1

    def add_text(self, parent: int, text: str, linked: int = 0) -> int:
        self.blocks.append((self.add(TEXT, parent), text, linked))
        return len(self.tags) - 1


def _tokens(source: str) -> tuple[list[re.Match], dict[int, int]]:
    """Markup in page order, and where the unseen elements that begin at a place end.

    An unseen element other than raw text needs its own end tag, before its parent
    ends and before another button or list of choices begins; one without is passed over
    like an inline element, so that what follows it stays.
    """
    found: list[re.Match] = []
    ends: dict[int, int] = {}
    open_: list[tuple[str, int]] = []
    count: dict[str, int] = {}

    def close(tag: str, end: int) -> None:
        if not count.get(tag):
            return
        while True:
            name, start = open_.pop()
            count[name] -= 1
            if name == tag:
                break
        if tag in UNSEEN:
            ends[start] = end

    at = 0
    while m := _TOKEN.search(source, at):
        found.append(m)
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            close(tag, at)
        elif m[3].rstrip().endswith("/") or tag in VOID or (tag in INLINE and tag not in UNSEEN):
            continue
        elif tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = ends[m.start()] = end.end() if end else len(source)
        else:
            if tag in ("button", "select") and count.get(tag):
                held = next(k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == tag)
                del open_[held]
                count[tag] -= 1
            open_.append((tag, m.start()))
            count[tag] = count.get(tag, 0) + 1
    return found, ends


def parse(source: str) -> Page:
    """The tree of a page, however broken its markup is."""
    page = Page(["#page"], [-1], [frozenset()])
    stack, pieces, linked, in_link = [0], [], 0, 0

    def end_block() -> None:
        nonlocal pieces, linked
        text = " ".join("".join(pieces).split())
        if text:
            page.add_text(stack[-1], text, min(linked, len(text)))
        pieces, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                linked += len(text)

    at = 0
    found, ends = _tokens(source)
    for m in found:
        if m.start() < at:
            continue
        add(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), m[1] == "/"
        if tag in UNSEEN and not closing:
            at = ends.get(m.start(), at)
            continue
        if tag in INLINE or tag in UNSEEN:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                pieces.append(" ")
            continue
        end_block()
        in_link = 0
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if page.tags[stack[k]] == tag:
                    del stack[k:]
                    break
            continue
        if page.tags[stack[-1]] == "p" or (tag in HEADINGS and page.tags[stack[-1]] in HEADINGS):
            stack.pop()
        for k in range(len(stack) - 1, 0, -1):
            if page.tags[stack[k]] in _SCOPES.get(tag, ()) or tag not in _CLOSES:
                break
            if page.tags[stack[k]] in _CLOSES[tag]:
                del stack[k:]
                break
        node = page.add(tag, stack[-1], names(m[3]) if m[3].strip() else frozenset())
        if tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(node)
    add(source[at:])
    end_block()
    return page


def names(attributes: str) -> frozenset[str]:
    """Words of class names and the like, in lower case, also those inside `camelCase` names."""
    found = _WORD.findall(_SPOKEN.sub(" ", attributes))
    return frozenset(w.lower() for word in found for w in (word, *_PART.findall(word)))


FEATURES = 33


def features(page: Page, hidden: bool = False) -> np.ndarray:
    """One row for every node; `hidden` leaves out what tags and attributes say."""
    n = len(page.tags)
    parent = np.array(page.parents)
    own, links, marks, count = (np.zeros(n) for _ in range(4))
    before = np.zeros(n)
    total = 0
    first = np.full(n, -1.0)
    for owner, text, linked in page.blocks:
        own[owner] += len(text)
        links[owner] += linked
        marks[owner] += text.count(".") + text.count(",") + text.count(";")
        count[owner] += 1
        if first[owner] < 0:
            first[owner] = total
        total += len(text)
    size, all_links, all_marks, nodes, paragraphs = own.copy(), links.copy(), marks.copy(), np.ones(n), np.array([t == "p" for t in page.tags], float)
    for i in range(n - 1, 0, -1):
        for a in (size, all_links, all_marks, nodes, paragraphs):
            a[parent[i]] += a[i]
        if first[i] >= 0 and (first[parent[i]] < 0 or first[i] < first[parent[i]]):
            first[parent[i]] = first[i]
    depth, main, aside = np.zeros(n), np.zeros(n), np.zeros(n)
    rank, siblings, alike = np.zeros(n), np.zeros(n), np.zeros(n)
    prior, following = np.zeros(n), np.zeros(n)
    last: dict[int, int] = {}
    twins: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        if not hidden:
            main[i] = main[p] + (page.tags[i] in MAIN_TAGS) + len(page.words[i] & MAIN_WORDS)
            aside[i] = aside[p] + (page.tags[i] in ASIDE_TAGS) + len(page.words[i] & ASIDE_WORDS)
        rank[i] = siblings[p]
        siblings[p] += 1
        if p in last:
            prior[i], following[last[p]] = size[last[p]], size[i]
        last[p] = i
        twins[p, page.tags[i]] = twins.get((p, page.tags[i]), 0) + 1
    for i in range(1, n):
        alike[i] = twins[parent[i], page.tags[i]] / siblings[parent[i]]
    own_main = np.array([0 if hidden else (t in MAIN_TAGS) + len(w & MAIN_WORDS) for t, w in zip(page.tags, page.words)])
    own_aside = np.array([0 if hidden else (t in ASIDE_TAGS) + len(w & ASIDE_WORDS) for t, w in zip(page.tags, page.words)])
    shown = [page.tags[max(p, 0)] if t == TEXT else t for t, p in zip(page.tags, page.parents)]  # a leaf is known by its element
    kinds = [[t == "p", t in HEADINGS, t in ("li", "dd", "dt"), t in ("ul", "ol", "dl"), t in ("td", "th", "tr", "table"), t in ("html", "body", "#page")] for t in shown]
    kept = np.array(kinds, float)
    up = np.maximum(parent, 0)
    over = up[up]  # the element that holds the element
    most = max(total, 1)
    safe = np.maximum(size, 1)
    return np.column_stack([
        depth, np.log1p(size), np.log1p(own), all_links / safe, all_marks / safe, np.log1p(nodes), size / nodes,
        paragraphs / nodes, first / most, size / most, size / np.maximum(size[up], 1), size[up] / most, all_links[up] / np.maximum(size[up], 1),
        size[up] / nodes[up], paragraphs[up], rank, siblings[up], alike, np.log1p(prior), np.log1p(following),
        main, aside, own_main, own_aside, kept, np.array([t == TEXT for t in page.tags], float), size[over] / most, kept[over, 5],
    ])


def landmarks(page: Page) -> np.ndarray | None:
    """Labels from telling elements, or None for a page that has none."""
    n = len(page.tags)
    inside = np.zeros(n, bool)
    blocked = np.zeros(n, bool)
    for i in range(1, n):
        p = page.parents[i]
        blocked[i] = blocked[p] or page.tags[i] in ASIDE_TAGS or bool(page.words[i] & ASIDE_WORDS and not page.words[i] & MAIN_WORDS)
        inside[i] = not blocked[i] and (inside[p] or page.tags[i] in MAIN_TAGS or bool(page.words[i] & MAIN_WORDS))
    if not inside.any():
        return None
    holds = inside.copy()
    for i in range(n - 1, 0, -1):
        holds[page.parents[i]] |= holds[i]
    return holds


def by_density(page: Page) -> np.ndarray:
    """Labels for pages without landmarks: blocks of prose and what holds them."""
    holds = np.zeros(len(page.tags), bool)
    for owner, text, linked in page.blocks:
        holds[owner] |= len(text) >= 80 and linked < 0.3 * len(text)
    for i in range(len(page.tags) - 1, 0, -1):
        holds[page.parents[i]] |= holds[i]
    return holds


def disturbed(page: Page, y: np.ndarray, random: np.random.Generator) -> tuple[Page, np.ndarray]:
    """The page with some blocks of main text turned into something else.

    A fifth of them get an element or a class name that marks menus, notices,
    comments and so on, and the label of those; elements that mark main text become
    plain ones with or without a telling class name.
    """
    tags, names, labels = list(page.tags), list(page.words), y.copy()
    aside_tags, aside_words, main_words = sorted(ASIDE_TAGS), sorted(ASIDE_WORDS), sorted(MAIN_WORDS)
    holds = np.zeros(len(tags), bool)
    holds[[p for t, p in zip(page.tags[1:], page.parents[1:]) if t != TEXT]] = True
    named = random.random() < 0.5
    for i in range(1, len(tags)):
        if labels[i] and not labels[page.parents[i]]:
            labels[i] = False  # below a block that was turned
        elif labels[i] and not holds[i] and tags[i] != TEXT and random.random() < 0.2:
            labels[i] = False
            if random.random() < 0.5:
                tags[i] = aside_tags[random.integers(len(aside_tags))]
            else:
                names[i] = frozenset([aside_words[random.integers(len(aside_words))]])
        elif tags[i] in MAIN_TAGS:
            tags[i] = "div"
            names[i] = frozenset([main_words[random.integers(len(main_words))]] if named else [])
    return Page(tags, page.parents, names, page.blocks), labels


def container(page: Page, y: np.ndarray) -> int:
    """The innermost node that holds all main text and more than one part of it; 0 if that is the page."""
    at = 0
    while len(inner := [i for i in range(1, len(y)) if page.parents[i] == at and y[i]]) == 1 and page.tags[inner[0]] != TEXT:
        if page.tags[at := inner[0]] in MAIN_TAGS:
            break
    return 0 if page.tags[at] in ("html", "body") else at


def beside(page: Page, y: np.ndarray, random: np.random.Generator) -> tuple[Page, np.ndarray]:
    """The page with one to three blocks of short prose before or behind its main text, under no telling name."""
    main = container(page, y)
    texts = [text for _, text, linked in page.blocks if linked == 0]
    if not main or not texts:
        return page, y
    after = next((i for i in range(main + 1, len(y)) if page.parents[i] < main), len(y))
    made, labels, number = Page(), [], {-1: -1}

    def add(count: int) -> None:
        for _ in range(count):
            parent, form = number[page.parents[main]], random.random()
            if form < 0.7:
                parent = made.add(("div", "section", "p")[random.integers(3)], parent)
            for _ in range(random.integers(1, 6) if form < 0.5 else 1):
                text = texts[random.integers(len(texts))][: random.integers(10, 400)].strip() or "x"
                made.add_text(made.add("p", parent) if form < 0.4 else parent, text)
        labels.extend([False] * (len(made.tags) - len(labels)))

    held = {owner: (text, linked) for owner, text, linked in page.blocks}
    before = int(random.integers(0, 2))
    for i in range(len(y) + 1):
        if i == main:
            add(before)
        if i == after:
            add(int(random.integers(1 - before, 3)))
        if i < len(y):
            up = number[page.parents[i]]
            number[i] = made.add_text(up, *held[i]) if i in held else made.add(page.tags[i], up, page.words[i])
            labels.append(bool(y[i]))
    return made, np.array(labels)


def nested(page: Page, y: np.ndarray, random: np.random.Generator) -> tuple[Page, np.ndarray]:
    """The page with some neighbouring parts of its main text, or all, inside one more element without a name.

    In a list, paragraphs become its items.
    """
    main = container(page, y)
    parts = [i for i in range(1, len(y)) if page.parents[i] == main and y[i]]
    if not main or not parts:
        return page, y
    first, last = sorted(random.integers(0, len(parts), 2)) if random.random() < 0.7 else (min(1, len(parts) - 1), len(parts) - 1)
    made, labels, number, wrap = Page(), [], {-1: -1}, -1
    held = {owner: (text, linked) for owner, text, linked in page.blocks}
    for i in range(len(y)):
        up = number[page.parents[i]]
        if i == parts[first]:
            wrap = made.add(("div", "section", "blockquote", "ul", "ol")[random.integers(5)], up)
            labels.append(True)
        if wrap >= 0 and page.parents[i] == main and parts[first] <= i <= parts[last]:
            up = wrap
        tag = "li" if page.tags[i] == "p" and up == wrap and made.tags[wrap] in ("ul", "ol") else page.tags[i]
        number[i] = made.add_text(up, *held[i]) if i in held else made.add(tag, up, page.words[i])
        labels.append(bool(y[i]))
    return made, np.array(labels)


def alone(page: Page, y: np.ndarray, random: np.random.Generator) -> tuple[Page, np.ndarray]:
    """Nothing but the main text or the first parts of it."""
    main = container(page, y)
    parts = [i for i in range(1, len(y)) if page.parents[i] == main and y[i]]
    until = parts[random.integers(len(parts))] if parts and random.random() < 0.7 else len(y)
    made, number = Page(["#page"], [-1], [frozenset()]), {main: 0}
    held = {owner: (text, linked) for owner, text, linked in page.blocks}
    for i in range(main + 1, len(y)):
        if page.parents[i] == main and i > until:
            break
        if page.parents[i] in number and y[i]:
            up = number[page.parents[i]]
            number[i] = made.add_text(up, *held[i]) if i in held else made.add(page.tags[i], up)
    return made, np.ones(len(made.tags), bool)


def sole(page: Page) -> np.ndarray:
    """Leaves that are all that their element holds; they are decided with it."""
    children = np.bincount(np.maximum(page.parents, 0), minlength=len(page.tags))
    children[0] -= 1  # the page is no child
    return np.array([tag == TEXT and children[up] == 1 for tag, up in zip(page.tags, page.parents)])


def decode(page: Page, p: np.ndarray) -> np.ndarray:
    """Likeliest labels without a kept node below a dropped one; the page itself is kept.

    Sole leaves have the label of their element, whatever `p` says of them.
    """
    tied = sole(page)
    yes, no = np.log(np.clip(p, 1e-9, 1)), np.log(np.clip(1 - p, 1e-9, 1))
    yes[tied] = no[tied] = 0
    keep, drop = yes, no
    for i in range(len(p) - 1, 0, -1):
        keep[page.parents[i]] += max(keep[i], drop[i])
        drop[page.parents[i]] += drop[i]
    kept = np.zeros(len(p), bool)
    kept[0] = True
    for i in range(1, len(p)):
        kept[i] = kept[page.parents[i]] and (tied[i] or keep[i] > drop[i])
    return kept


def main_text(source: str, model: boosting.Trees) -> str:
    """Kept blocks of a page in page order, joined by one space."""
    page = parse(source)
    if not page.blocks:
        return ""
    kept = decode(page, model.probabilities(features(page)))
    return " ".join(text for owner, text, _ in page.blocks if kept[owner])


@dataclass(frozen=True)
class Training:
    """`sample`: different pages that train the trees at most, by hash."""

    sample: int = 400


def sampled(pages: DataFrame, how: Training) -> DataFrame:
    """The first different pages by hash; however many copies, each once."""
    hashed = pages.select(F.xxhash64("html").alias("h"), "html")
    most = hashed.select("h").distinct().orderBy("h").limit(how.sample).agg(F.max("h")).collect()[0][0]
    return hashed.where(F.col("h") <= F.lit(most)).distinct().orderBy("h", "html").limit(how.sample).select("html")


def train(pages: DataFrame, how: Training = Training()) -> boosting.Trees:
    """Trees for the nodes of `pages`; without any page they keep what is likelier than not."""

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        rows, labels = [], []
        for source in texts:
            page = parse(source)
            y = landmarks(page)
            y = by_density(page) if y is None else y
            random = np.random.default_rng(len(source))
            wider, wide = beside(*(nested(page, y, random) if random.random() < 0.5 else (page, y)), random)
            made = [(page, y), disturbed(wider, wide, random)]
            hidden = [(page, y), (wider, wide), alone(page, y, random)]
            decided = np.concatenate([~sole(p) for p, _ in made + hidden])
            x = np.concatenate([features(p) for p, _ in made] + [features(p, hidden=True) for p, _ in hidden])
            rows.append(x[decided].astype(np.float64).tobytes())
            labels.append(np.concatenate([own for _, own in made + hidden])[decided].astype(np.uint8).tobytes())
        return {"x": rows, "y": labels}

    rows = sorted(map_texts(sampled(pages, how), "x binary, y binary", each, "html").collect())
    if not rows:
        return boosting.fit(np.zeros((0, FEATURES)), np.zeros(0))
    x = np.concatenate([np.frombuffer(r.x).reshape(-1, FEATURES) for r in rows])
    return boosting.fit(x, np.concatenate([np.frombuffer(r.y, np.uint8) for r in rows]).astype(float))


def extract(pages: DataFrame, model: boosting.Trees) -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars` of every row of `pages`.

    Null or empty html gives an empty text. Rows that repeat are done each; other
    columns are ignored; an empty table gives no rows. Broken markup is read as far as
    it goes.
    """
    held = pages.sparkSession.sparkContext.broadcast(model)

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        parsed = [parse(t) for t in texts]
        rows = [features(p) for p in parsed]
        p = held.value.probabilities(np.concatenate(rows))
        edges = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        found = []
        for page, a, b in zip(parsed, edges[:-1], edges[1:]):
            kept = decode(page, p[a:b])
            found.append(" ".join(text for owner, text, _ in page.blocks if kept[owner]))
        return {"page_id": batch.column(0), "url": batch.column(1), "text": found, "n_chars": [len(t) for t in found]}

    return map_texts(pages.select("page_id", "url", "html"), "page_id long, url string, text string, n_chars long", each, "html")
