"""Main text of web pages by wrapper induction (operator 8).

1. Every page is parsed once into a skeleton: its block elements, with runs of
   like siblings folded into one repeated node, and a digest of each node's own text.
2. Pages of one host are aligned with one of them (smallest page id) by simple
   tree matching, the largest order-preserving match of equal nodes. A node
   whose text is the same on all aligned pages is template, one that varies is
   a slot; nodes only the other page has count as a slot of their parent.
   Nodes marked by a boilerplate class or id are aligned too: where nothing
   varies but in them, names mark nothing on pages of that host without an article.
3. The wrapper of a host is the path of its content root: the deepest block
   container over all slots outside navigation, forms, adverts, comments and
   the like; and the paths of constant nodes in it.
4. A page's text is the blocks under its content root, narrowed to the
   ``article`` or ``main`` elements in it if there are any, from which nothing
   constant is cut. A page without a node at that path, or of a host with
   nothing to compare (one page, or only copies), is narrowed the same way.

A class or id marks a node if all words of one of its names are boilerplate words.
It never drops a ``main`` or what holds one, nor the outermost ``article``
elements of a page whose articles all lie in marked nodes or are marked; such
articles stay, and nothing is narrowed to them.

Skeletons are small and only they are shuffled, in groups combined map-side
per host and node; the html is read twice and stays where it lies. Wrappers
are one small row per host; Spark broadcasts that table only if its written
size allows, else it joins by host with adaptive skew handling.

Defined results: null or empty html, or html without text, gives an empty
text; a null url is a host of its own; repeated rows give repeated results;
broken markup (unclosed or stray tags, a cut-off end) is read as far as it goes.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.store import written

# Elements of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr").split())
DROPPED = frozenset(("head nav header footer aside form script style noscript template iframe object embed select option "
                     "button textarea input svg canvas audio video map menu dialog title").split())
ROOTS = frozenset(("article", "main"))
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li".split())
CONTAINERS = frozenset("html body div section article main td center".split())
CLOSES_P = frozenset(("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 "
                      "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul").split())
# An opening tag closes an open element of these kinds, up to the given fence.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
            "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
            "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
BOILERPLATE_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar cookie cookies consent gdpr notice notices alert "
    "popup modal overlay comment comments respond disqus reply replies share sharing social related recommended newsletter "
    "subscribe subscription signup login widget pagination pager skip").split())
# Pairs of shapes a task remembers before it starts afresh.
REMEMBER = 1 << 18
# Cells of a matching table that is kept whole; larger ones are matched in halves.
TABLE_CELLS = 1 << 24
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())

# Tags as the standard reads them: a value is quoted only right after "=", else it ends at white space or ">", and
# a stray quote is part of a name. Possessive, so no text takes more than one pass.
_VALUE = r"""(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>"'][^\s>]*+))"""
_NAME = r"(?:=[^\s/>=]*+|[^\s/>=]++)"
_ATTRIBUTE = rf"{_NAME}(?:\s*+=\s*+{_VALUE}?+)?+"
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
                    rf"(?P<attrs>(?:[\s/]++|{_ATTRIBUTE})*+)(?P<end>>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(rf"({_NAME})(?:\s*+=\s*+{_VALUE}?+)?+", re.S)
_USED = frozenset("class id role hidden aria-hidden".split())
_HOLDS_ROOT = re.compile(r"<(?:article|main)[\s/>]", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Node:
    tag: str
    label: str = ""           # tag with its id and class, digits left out
    dropped: bool = False     # navigation, form, advert, ... by element, role or name
    children: list = field(default_factory=list)  # nodes and texts, in page order
    named: bool = False       # its class or id is that of boilerplate
    weak: bool = False        # an article no page is narrowed to


def _attributes(raw: str) -> dict[str, str]:
    return {name: m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw) if (name := m[1].lower()) in _USED}


def _is_boilerplate(tag: str, attrs: dict[str, str]) -> bool:
    return tag in DROPPED or attrs.get("role", "").lower() in BOILERPLATE_ROLES or attrs.get("aria-hidden", "").lower() == "true" \
        or "hidden" in attrs


def _is_named(tag: str, attrs: dict[str, str]) -> bool:
    """Whether some class or the id consists of boilerplate words alone."""
    if tag in ("html", "body"):
        return False
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()
    return any(words and all(w in BOILERPLATE_WORDS for w in words) for words in map(_WORDS.findall, names))


def _read_through(top: Node) -> None:
    """Forms that are the page's frame instead of a part of it: they hold an article or main element, or
    paragraphs or headings with more than half of the page's text."""
    order, stack = [], [(top, None, False)]  # nodes with the form around them, parents first
    while stack:
        node, form, gone = stack.pop()
        if node.dropped and node.tag != "form" or gone:
            continue
        order.append((node, form))
        inner = node if node.tag == "form" else form
        stack += [(c, inner, False) for c in node.children if not isinstance(c, str) and c.tag not in INLINE]
    forms = [n for n, _ in order if n.tag == "form" and n.dropped]
    if not forms:
        return
    held, prose = {id(f): 0 for f in forms}, set()
    total = 0
    around = {id(n): f for n, f in order}
    for node, form in order:
        inner = node if node.tag == "form" else form
        size = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        total += size
        while inner is not None and id(inner) in held:
            held[id(inner)] += size
            if node.tag in ROOTS:
                inner.dropped = False
            if node.tag in PROSE:
                prose.add(id(inner))
            inner = around[id(inner)]
    for f in forms:
        if id(f) in prose and 2 * held[id(f)] > total:
            f.dropped = False


def _resolve(top: Node, lift: bool) -> None:
    """Decide which named nodes are boilerplate, and mark them dropped; with ``lift`` none is on a page
    without an unmarked article."""
    def clear(chain):
        while chain and id(chain[0]) not in cleared:
            chain[0].named = False
            cleared.add(id(chain[0]))
            chain = chain[1]
    cleared, mains, named = set(), [], []
    stack = [(top, None)]
    while stack:
        node, above = stack.pop()
        if node.tag == "main":
            mains.append((node, above))
        if node.named:
            named.append(node)
        stack += [(c, (node, above)) for c in node.children if not isinstance(c, str) and not c.dropped]
    if not named:
        return
    for chain in mains:
        clear(chain)
    clean, outermost, articles = False, [], []
    stack = [(top, None, False, False)]
    while stack:
        node, above, in_named, in_article = stack.pop()
        if node.tag == "article":
            articles.append(node)
            clean |= not in_named and not node.named
            if not in_article and not (node.named and in_named):
                outermost.append((node, above))
        below = (node, above), in_named or node.named, in_article or node.tag == "article"
        stack += [(c, *below) for c in node.children if not isinstance(c, str) and not c.dropped]
    if not clean:
        for chain in outermost:
            chain[0].weak = True
            clear(chain)
        if lift:
            for node in articles:
                node.weak = True
            for node in named:
                node.named = False
    for node in named:
        node.dropped = node.named


def parse(source: str, lift: bool = False) -> Node:
    """Element tree of block elements; inline elements are read through, all text is kept undecoded."""
    top = Node("#root")
    stack = [top]
    at = 0

    def close(tags, fence=()):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return True
            if stack[i].tag in fence:
                return False
        return False
    while at < len(source):
        m = _TOKEN.search(source, at)
        end = m.start() if m else len(source)
        if end > at:
            stack[-1].children.append(source[at:end])
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if not m["end"]:
            break  # a tag cut off by the end of the page
        if m["close"]:
            if tag not in INLINE:
                close({tag})
            elif tag == "br":
                stack[-1].children.append(" ")
            continue
        if tag == "br":
            stack[-1].children.append(" ")
        if tag in INLINE:
            if tag not in VOID and (_attr := _attributes(m["attrs"])) and ((sure := _is_boilerplate(tag, _attr)) or _is_named(tag, _attr)):
                done = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                if not sure and _HOLDS_ROOT.search(source, at, done.end() if done else at):
                    continue
                node = Node(tag, tag, True)  # an inline advert or share button: a subtree of its own
                stack[-1].children.append(node)
                at = done.end() if done else at
            continue
        attrs = _attributes(m["attrs"]) if m["attrs"].strip() else {}
        if tag in CLOSES_P:
            close({"p"}, {"table", "td", "button", "div", "article", "section", "body"} if tag != "p" else CONTAINERS)
        if tag in SIBLINGS:
            close(*SIBLINGS[tag])
        names = _DIGITS.sub("", f"{attrs.get('id', '')} {attrs.get('class', '')}")  # numbered ids are one kind of node
        sure = _is_boilerplate(tag, attrs)
        node = Node(tag, " ".join([tag, *names.split()]), sure, named=not sure and _is_named(tag, attrs))
        stack[-1].children.append(node)
        if tag in RAW:
            done = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = done.end() if done else len(source)
        elif tag not in VOID:  # a slash at its end does not close an HTML element
            stack.append(node)
    _read_through(top)
    _resolve(top, lift)
    return top


def _clean(pieces: list[str]) -> str:
    return " ".join(html.unescape("".join(pieces)).split())


TOP_KEY = 0


@lru_cache(maxsize=1 << 16)
def _label_key(label: str) -> int:
    return int.from_bytes(hashlib.blake2b(label.encode(), digest_size=8).digest(), "big")


def step(key: int, label: str) -> int:
    """Key of the path one label below another path's: 63 bits, the same in every task."""
    x = (key * 0x9E3779B97F4A7C15 + _label_key(label) + 1) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return (x ^ x >> 27) >> 1


def blocks(node: Node, skip: frozenset[int] = frozenset(), key: int = TOP_KEY) -> list[str]:
    """Texts of the blocks under a node in page order, without boilerplate and the paths in ``skip``."""
    out, run = [], []
    stack = [(node, key, iter(node.children))]

    def flush():
        if run and (t := _clean(run)):
            out.append(t)
        run.clear()
    while stack:
        node, key, it = stack[-1]
        child = next(it, None)
        if child is None:
            stack.pop()
            flush()
        elif isinstance(child, str):
            run.append(child)
        elif child.tag in INLINE:
            run.append(" ")
        else:
            flush()
            if not child.dropped and (below := step(key, child.label)) not in skip:
                stack.append((child, below, iter(child.children)))
    return out


def _outermost(node: Node, key: int, wanted) -> list[tuple[Node, int]]:
    """Outermost nodes under (or at) a node that are wanted, in page order, not looking into boilerplate."""
    found, stack = [], [(node, key)]
    while stack:
        node, key = stack.pop()
        if wanted(node, key):
            found.append((node, key))
        else:
            stack += [(c, step(key, c.label)) for c in reversed(node.children)
                      if not isinstance(c, str) and not c.dropped and c.tag not in INLINE]
    return found


def roots(top: Node, root: int | None) -> list[tuple[Node, int]]:
    """Content roots in page order: the nodes at the wrapper's root path (the page without one),
    narrowed to the articles, else the main elements, they hold."""
    found = _outermost(top, TOP_KEY, lambda n, k: k == root) if root is not None else []
    out = []
    for node, key in found or [(top, TOP_KEY)]:
        out += (_outermost(node, key, lambda n, k: n.tag == "article" and not n.weak) or _outermost(node, key, lambda n, k: n.tag == "main")
                or [(node, key)])
    return out


@dataclass
class Skeleton:
    """Preorder arrays of a page's folded block tree."""
    parent: list[int]
    label: list[str]
    dropped: list[bool]
    named: list[bool]  # dropped, or in a dropped node, by name alone
    digest: list[int]  # of a node's own text over all folded siblings; 0 without text

    def children(self) -> list[list[int]]:
        out = [[] for _ in self.parent]
        for i, p in enumerate(self.parent):
            if p >= 0:
                out[p].append(i)
        return out


def skeleton(top: Node) -> Skeleton:
    """Fold runs of siblings of one label into one node holding all their children and texts. Nodes of
    different labels, and nodes that do not follow each other, are never folded."""
    def kind(n):
        return n.label, n.dropped, n.named
    sk = Skeleton([], [], [], [], [])
    stack = [([top], -1)]
    while stack:
        nodes, parent = stack.pop()
        me = len(sk.parent)
        inside = parent >= 0 and sk.named[parent]
        named = (inside and not nodes[0].dropped) or nodes[0].named
        own = _clean([c if isinstance(c, str) else " " for n in nodes for c in n.children])
        sk.parent.append(parent)
        sk.label.append(nodes[0].label)
        sk.dropped.append(nodes[0].dropped or inside)
        sk.named.append(named)
        sk.digest.append(int.from_bytes(hashlib.blake2b(own.encode(), digest_size=7).digest(), "big") + 1 if own else 0)
        runs: list[list[Node]] = []
        for c in (c for n in nodes for c in n.children if not isinstance(c, str) and c.tag not in INLINE):
            if runs and kind(runs[-1][0]) == kind(c):
                runs[-1].append(c)
            else:
                runs.append([c])
        if named or not nodes[0].dropped:  # what lies in boilerplate is no slot
            stack += [(r, me) for r in reversed(runs)]
    return sk


class Shapes:
    """Subtrees of several skeletons by their shape: equal shapes have equal labels throughout."""

    def __init__(self):
        self.ids: dict[tuple, int] = {}
        self.label: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.found: dict[tuple[int, int], int] = {}

    def of(self, sk: Skeleton, children: list[list[int]]) -> list[int]:
        out = [0] * len(sk.parent)
        for i in range(len(sk.parent) - 1, -1, -1):  # children come after their parent
            key = (sk.label[i], *(out[c] for c in children[i]))
            if key not in self.ids:
                self.ids[key] = len(self.label)
                self.label.append(sk.label[i])
                self.kids.append(key[1:])
                self.size.append(1 + sum(self.size[c] for c in key[1:]))
            out[i] = self.ids[key]
        return out

    def match(self, x: int, y: int) -> int:
        """Size of the largest ordered match of two shapes that pairs their tops (0 if their labels differ)."""
        todo = [(x, y, False)]
        while todo:
            x, y, ready = todo.pop()
            if (x, y) in self.found:
                continue
            if x == y:
                self.found[x, y] = self.size[x]
            elif self.label[x] != self.label[y]:
                self.found[x, y] = 0
            elif ready:
                self.found[x, y] = 1 + sum(self.size[c] for c in self._ends(x, y)[2]) + int(self._last_row(*self._ends(x, y)[:2])[-1])
            else:
                todo.append((x, y, True))
                a, b, _ = self._ends(x, y)
                todo += [(p, q, False) for p in set(a) for q in set(b)]
        return self.found[x, y]

    def _ends(self, x: int, y: int) -> tuple[tuple[int, ...], tuple[int, ...], tuple[int, ...]]:
        """Child lists without what both begin and end with; an ordered match never does better than to pair that."""
        a, b = self.kids[x], self.kids[y]
        i = 0
        while i < min(len(a), len(b)) and a[i] == b[i]:
            i += 1
        j = 0
        while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
            j += 1
        return a[i:len(a) - j], b[i:len(b) - j], (*a[:i], *a[len(a) - j:])

    def _weights(self, p: int, b: np.ndarray, known: np.ndarray) -> np.ndarray:
        return np.array([self.found[p, q] for q in known.tolist()], np.int64)[b]

    def _rows(self, a, b):
        """Rows of the matching table of two child lists, the first one all zero."""
        known, of = np.unique(np.array(b, np.int64), return_inverse=True) if b else (np.zeros(0, np.int64),) * 2
        cache: dict[int, np.ndarray] = {}
        row = np.zeros(len(b) + 1, np.int64)
        yield row
        for p in a:
            if p not in cache:
                cache[p] = self._weights(p, of, known) if b else np.zeros(0, np.int64)
            new = row.copy()
            np.maximum(new[1:], row[:-1] + cache[p], out=new[1:])
            row = np.maximum.accumulate(new)
            yield row

    def _last_row(self, a, b) -> np.ndarray:
        row = None
        for row in self._rows(a, b):
            pass
        return row

    def pairs(self, a, b) -> list[tuple[int, int]]:
        """Places of the children paired by a largest match, both rising."""
        out, todo = [], [(0, len(a), 0, len(b))]
        while todo:
            i, j, k, m = todo.pop()
            while i < j and k < m and a[i] == b[k]:
                out.append((i, k))
                i, k = i + 1, k + 1
            while i < j and k < m and a[j - 1] == b[m - 1]:
                j, m = j - 1, m - 1
                out.append((j, m))
            if i == j or k == m:
                continue
            if (j - i + 1) * (m - k + 1) > TABLE_CELLS and j - i > 1:
                half = (i + j) // 2  # the best split of b for the two halves of a
                up = self._last_row(a[i:half], b[k:m])
                down = self._last_row(a[half:j][::-1], b[k:m][::-1])[::-1]
                cut = k + int(np.argmax(up + down))
                todo += [(i, half, k, cut), (half, j, cut, m)]
                continue
            table = np.stack(list(self._rows(a[i:j], b[k:m])))
            p, q = j - i, m - k
            while p and q:
                if table[p, q] == table[p - 1, q]:
                    p -= 1
                elif table[p, q] == table[p, q - 1]:
                    q -= 1
                else:
                    p, q = p - 1, q - 1
                    out.append((i + p, k + q))
        return out


def tree_match(a: Skeleton, b: Skeleton, shapes: Shapes | None = None) -> list[tuple[int, int]]:
    """Simple tree matching of two skeletons: pairs of matched nodes, order and ancestors kept.

    Subtrees are matched by shape, each pair of shapes once; equal ones match node by node. Child lists are
    matched row by row over whole arrays, whatever their length.
    """
    shapes = Shapes() if shapes is None else shapes
    ca, cb = a.children(), b.children()
    sa, sb = shapes.of(a, ca), shapes.of(b, cb)
    out, todo = [], [(0, 0)] if shapes.match(sa[0], sb[0]) else []
    while todo:
        x, y = todo.pop()
        if sa[x] == sb[y]:  # subtrees are runs of the preorder
            out += [(x + n, y + n) for n in range(shapes.size[sa[x]])]
            continue
        out.append((x, y))
        la, lb = [sa[c] for c in ca[x]], [sb[c] for c in cb[y]]
        todo += [(ca[x][p], cb[y][q]) for p, q in shapes.pairs(la, lb) if shapes.match(la[p], lb[q])]
    return out


_SKELETON = "host string, page bigint, parent array<int>, label array<string>, dropped array<boolean>, named array<boolean>, digest array<bigint>"
_VOTES = "host string, node int, digest_lo bigint, digest_hi bigint, n bigint, extra boolean, in_named boolean"


def _skeleton_of(row: dict) -> Skeleton:
    return Skeleton(row["parent"], row["label"], row["dropped"], row["named"], row["digest"])


def _skeletons(pages: DataFrame) -> DataFrame:
    def task(batches):
        for batch in batches:
            sks = [skeleton(parse(h or "")) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s.parent for s in sks], pa.list_(pa.int32())),
                 pa.array([s.label for s in sks], pa.list_(pa.string())), pa.array([s.dropped for s in sks], pa.list_(pa.bool_())),
                 pa.array([s.named for s in sks], pa.list_(pa.bool_())), pa.array([s.digest for s in sks], pa.list_(pa.int64()))], [f.split()[0] for f in _SKELETON.split(", ")])
    return pages.select("host", "page_id", "html").mapInArrow(task, _SKELETON)


def _votes(skeletons: DataFrame, refs: DataFrame) -> DataFrame:
    """Per host and reference node: range of its text digests over aligned pages, their number, and
    whether some page has nodes there that the reference lacks."""
    def task(batches):
        shapes = Shapes()
        for batch in batches:
            rows = batch.to_pylist()
            got: dict[tuple[str, int], list] = {}
            for r in rows:
                page, ref = _skeleton_of(r), _skeleton_of(r["ref"])
                if len(shapes.found) > REMEMBER:
                    shapes = Shapes()
                pairs = tree_match(ref, page, shapes)
                to_ref = {y: x for x, y in pairs}
                for x, y in pairs:
                    v = got.setdefault((r["host"], x), [page.digest[y], page.digest[y], 0, False, False])
                    v[0], v[1], v[2] = min(v[0], page.digest[y]), max(v[1], page.digest[y]), v[2] + 1
                for y, p in enumerate(page.parent):
                    if y not in to_ref and p in to_ref and (page.named[y] or not page.dropped[y]):
                        got[r["host"], to_ref[p]][4 if page.named[y] else 3] = True
            cols = list(zip(*((h, n, *v) for (h, n), v in got.items()))) or [[]] * 7
            types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             [f.split()[0] for f in _VOTES.split(", ")])
    votes = skeletons.join(refs, "host").mapInArrow(task, _VOTES)
    return votes.groupBy("host", "node").agg(F.min("digest_lo").alias("lo"), F.max("digest_hi").alias("hi"),
                                             F.sum("n").alias("n"), F.max("extra").alias("extra"),
                                             F.max("in_named").alias("in_named"))


def wrapper(ref: Skeleton, votes: dict[int, tuple[int, int, int, bool]]) -> tuple[int | None, list[int]]:
    """Keys of the content root path and of the constant paths of one host."""
    n = len(ref.parent)
    free = [not d for d in ref.dropped]
    slots = [i for i, (lo, hi, _, extra) in votes.items() if free[i] and (lo != hi or extra)]
    if not slots:
        return None, []
    key, held = [TOP_KEY] * n, [0] * n
    for i in range(1, n):
        key[i] = step(key[ref.parent[i]], ref.label[i])
    for i in slots:
        held[i] += 1
    for i in range(n - 1, 0, -1):
        held[ref.parent[i]] += held[i]
    # the longest path that all slots lie under, over all nodes of a path
    under: dict[int, int] = {}
    below: dict[int, dict[int, str]] = {}
    for i in range(1, n):
        under[key[i]] = under.get(key[i], 0) + held[i]
        below.setdefault(key[ref.parent[i]], {})[key[i]] = ref.label[i]
    shared, at = [], TOP_KEY
    while down := next(((k, label) for k, label in below.get(at, {}).items() if under[k] == len(slots)), None):
        at = down[0]
        shared.append(down[1])
    tags = [label.split(" ")[0] for label in shared]
    named = [i for i, tag in enumerate(tags) if tag in ROOTS]
    if named:  # never deeper than an article: parts of it that do not vary belong to it too
        del shared[named[0] + 1:]
    while shared and shared[-1].split(" ")[0] not in CONTAINERS:
        shared.pop()
    root = TOP_KEY
    for label in shared:
        root = step(root, label)
    constant = {key[i] for i, (lo, hi, count, extra) in votes.items()
                if free[i] and lo == hi and lo and count > 2 and not extra}
    return root, sorted(constant - {key[i] for i in slots})


def _wrappers(votes: DataFrame, refs: DataFrame) -> DataFrame:
    """One row per host; a host has as many votes as its reference page has nodes."""
    per = votes.groupBy("host").agg(F.collect_list(F.struct("node", "lo", "hi", "n", "extra", "in_named")).alias("votes"))

    def task(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ref, votes = _skeleton_of(r["ref"]), {v["node"]: (v["lo"], v["hi"], v["n"], v["extra"]) for v in r["votes"]}
                root, constant = wrapper(ref, votes)
                # nothing varies but in nodes marked by name: there the names say nothing
                lift = root is None and any(v["in_named"] or (ref.named[v["node"]] and (v["lo"] != v["hi"] or v["extra"]))
                                            for v in r["votes"])
                out.append((r["host"], root, constant, lift))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.bool_())],
                                             ["host", "root", "constant", "lift"])
    return per.join(refs, "host").mapInArrow(task, "host string, root bigint, constant array<bigint>, lift boolean")


def extract(source: str, root: int | None, constant: frozenset[int], lift: bool = False) -> str:
    """Main text of one page under its host's wrapper."""
    out: list[str] = []
    for node, key in roots(parse(source, lift), root):
        out += blocks(node, frozenset() if node.tag in ROOTS else constant, key)
    return "\n".join(out)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    from tributary.llm.urls import host
    pages = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
    pages = pages.withColumn("host", F.coalesce(host(F.col("url")), F.lit("")))
    sk = written(_skeletons(pages), "skeletons")
    tree = F.struct("parent", "label", "dropped", "named", "digest")
    # the reference page of a host: smallest id, then smallest skeleton, so repeated runs agree
    refs = written(sk.groupBy("host").agg(F.min(F.struct(F.coalesce("page", F.lit(2 ** 62)).alias("page"), tree.alias("ref"))).alias("r"))
                     .select("host", "r.ref"), "references")
    wrappers = written(_wrappers(_votes(sk, refs), refs), "wrappers")

    def task(batches):
        for batch in batches:
            texts = []
            for source, root, constant, lift in zip(*(batch.column(c).to_pylist() for c in ("html", "root", "constant", "lift"))):
                texts.append(extract(source or "", root, frozenset(constant or ()), bool(lift)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])
    return (pages.join(wrappers, "host", "left").select("page_id", "url", "html", "root", "constant", "lift")
                 .mapInArrow(task, "page_id bigint, url string, text string, n_chars bigint"))
