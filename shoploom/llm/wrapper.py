"""Main text of pages by wrapper induction.

Pages of one host are parsed into trees of blocks and aligned with a reference tree by simple tree matching; it begins as
a page of the most frequent shape, and nodes that it lacks are added to it. Slots whose few texts repeat over pages with
different content are the host's template, whichever layout a page has; slots whose text varies are content. The template's
nodes, and regions whose tag, role or class names say that they are no main text, are left out of the extracted text.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoploom.llm.common import bounded_batches, unnested, without, written
from shoploom.llm.hosts import host_of

#: A text repeats if so many pages of different content have it at the same place; it is template if, where it stands, texts
#: that repeat fill this share of its slot's pages.
SHARE, LEAST_PAGES = 0.9, 5
#: Pages of a host are aligned in chunks of about this many.
CHUNK = 256

# Elements by the HTML standard's rules, and words that name regions beside the main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas video audio textarea title select option".split())
UNPARSED = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Regions beside the main text. Those in the first sets hold no main text of their own; those in the second may be wrapped
# around a page.
BESIDE = frozenset("nav footer aside menu dialog button datalist".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog".split())
BESIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright disqus footer "
    "menu menus modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion related replies respond sidenav "
    "sponsor sponsored subscribe".split()
)
AROUND = frozenset("header form fieldset".split())
AROUND_ROLES = frozenset(["form"])
AROUND_WORDS = frozenset("header masthead share sharing sidebar sidebars social toolbar topbar widget widgets".split())
#: Words that go with those above in a class name or id, such as `menu-wrapper`. Any other word gives the name another sense.
PART_WORDS = frozenset(
    "area articles bar block body bottom box btn button buttons center column container fixed form global google group holder icon icons inner item items "
    "left link links list main message mobile outer overlay page panel posts primary right row secondary section site slot sticky text the title top unit "
    "wrap wrapper zone".split()
)
# Closing rules: an opening tag of the key ends an open element of the value that is not shut off by a list or table.
_BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu "
    "nav ol p pre section table ul".split()
)
_ENDS = {t: frozenset(("p",)) for t in _BLOCKS} | {
    "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")), "tr": frozenset(("tr", "td", "th", "p")),
    "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")), "option": frozenset(("option",)),
}
_SCOPE = frozenset("ul ol dl table article section main body html div nav aside td".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop)(?=[\s=>/]|\Z)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_NAMES = re.compile(r"[a-z]+")
_SPACES = re.compile(r"[\s]+")


@dataclass
class Node:
    tag: str
    beside: bool = False
    main: bool = False
    cue: int = 0
    children: list[Node] = field(default_factory=list)
    text: str = ""
    length: int = 0
    label: int = 0
    shape: int = 0
    size: int = 1

    def walk(self):
        """All nodes in page order."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(node.children))


def _attributes(attrs: str) -> dict[str, str]:
    return {name.lower(): html.unescape(value.strip("\"'")) for name, value in _ATTR.findall(attrs)} if attrs.strip() else {}


#: What a tag and its attributes say: nothing; a region beside the main text that may be wrapped around it; one that is
#: not unless it holds a main region; never shown.
_NONE, _AROUND, _BESIDE, _UNSEEN = range(4)


def _cue(tag: str, attrs: dict[str, str]) -> int:
    role = attrs.get("role", "").lower()
    if tag in RAW or tag == "head" or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return _UNSEEN
    if tag in BESIDE or role in BESIDE_ROLES:
        return _BESIDE
    cue = _AROUND if tag in AROUND or role in AROUND_ROLES else _NONE
    if tag in ("html", "body", "article", "main"):
        return cue
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        words = {w for w in _NAMES.findall(name) if len(w) > 1}
        if words <= BESIDE_WORDS | AROUND_WORDS | PART_WORDS:
            cue = max(cue, _BESIDE if words & BESIDE_WORDS else _AROUND if words & AROUND_WORDS else _NONE)
    return cue


def _settled(root: Node) -> Node:
    """Sets `beside`: a cue holds unless the region turns out to be wrapped around the main text.

    A main region overrides every cue around it, an article those that may be wrapped around a page, and a form with
    more text than the rest of the page is no region of it. If a page would be left without text, its outermost such
    regions count as the page, or else its outermost articles.
    """
    nodes = list(root.walk())
    if not any(n.cue for n in nodes):
        return root
    mains: dict[int, int] = {}  # 1: an article inside, 2: a main region
    for node in reversed(nodes):
        inside = max((mains[id(c)] for c in node.children), default=0)
        if node.cue == _UNSEEN or node.cue == _BESIDE and inside < 2:
            node.beside, mains[id(node)] = True, 0
        else:
            node.beside = node.cue == _AROUND and not inside
            own = 0 if node.beside or not node.main else 1 if node.tag == "article" else 2
            mains[id(node)] = max(inside, own)

    def shown(skip_forms: bool) -> int:
        return sum(len(n.text) for n, depth, _ in _depths(root, lambda x: skip_forms and x.tag == "form" and x.cue == _AROUND) if depth == 0)

    forms = [n for n in nodes if n.beside and n.cue == _AROUND and n.tag == "form"]
    if forms and shown(True) > 2 * shown(False):
        for node in forms:
            node.beside = False
    if not _has_text(root):
        texts = [(depth, node) for node, depth, closed in _depths(root) if node.text and not closed]
        least = min((depth for depth, _ in texts), default=0)
        for node, depth, closed in _depths(root):
            if node.beside and node.cue == _AROUND and depth <= least and not closed:
                node.beside = False
        if not texts:
            articles = [depth for node, depth, _ in _depths(root) if node.main]
            inside = set()
            for node in reversed(nodes):
                if node.cue != _UNSEEN and (node.main or any(id(c) in inside for c in node.children)):
                    inside.add(id(node))
            for node, depth, _ in _depths(root):
                if id(node) in inside and depth <= min(articles):
                    node.beside = False
    return root


def _has_text(root: Node) -> bool:
    stack = [root]
    while stack:
        node = stack.pop()
        if node.text and not node.beside:
            return True
        if not node.beside:
            stack.extend(node.children)
    return False


def _depths(root: Node, passed=lambda node: False):
    """Each node that may be shown, how many regions beside the main text it is in (itself among them), and whether one of them is surely beside."""
    stack = [(root, 0, False)]
    out = []
    while stack:
        node, depth, closed = stack.pop()
        if node.cue == _UNSEEN:
            continue
        if node.beside and not passed(node):
            depth, closed = depth + 1, closed or node.cue == _BESIDE
        out.append((node, depth, closed))
        stack.extend((c, depth, closed) for c in reversed(node.children))
    return out


def parse(page: str, shaped: bool = True) -> Node:
    """The tree of a page's blocks; each run of text between block boundaries is a leaf `#text`.

    Inline elements don't part text. Unclosed and misplaced tags are closed where a browser would; a page that ends early
    is closed at its end. `shaped`: whether shapes are wanted, which only alignment needs.
    """
    root = Node("#root")
    open_nodes, marks, run = [root], [], []
    opened: Counter = Counter()  # open nodes by tag, so that deep pages are not searched in vain

    def flush():
        text = _SPACES.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            open_nodes[-1].children.append(Node("#text", text=text))

    def close(depth: int):
        flush()
        opened.subtract(n.tag for n in open_nodes[depth:])
        del open_nodes[depth:]

    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        if not found:
            run.append(html.unescape(page[at:]))
            break
        if found.start() > at:
            run.append(html.unescape(page[at : found.start()]))
        at = found.end()
        if found["cdata"] is not None:
            run.append(found["cdata"])
        if not found["name"]:
            continue
        tag = found["name"].lower()
        if found["close"]:
            if tag in INLINE:
                last = next((k for k in range(len(marks) - 1, -1, -1) if marks[k][0] == tag), None)
                if last is not None:
                    depth = marks[last][1]
                    del marks[last:]
                    if depth and len(open_nodes) > depth and open_nodes[depth].tag == tag:
                        close(depth)
                continue
            if tag == "br" or tag == "p" and not opened["p"]:
                flush()
                continue
            depth = next((k for k in range(len(open_nodes) - 1, 0, -1) if open_nodes[k].tag == tag), 0) if opened[tag] else 0
            if depth:
                close(depth)
            continue
        attrs = _attributes(found["attrs"])
        if tag in INLINE:
            if cue := _cue(tag, attrs):
                flush()
                node = Node(tag, cue=cue)
                open_nodes[-1].children.append(node)
                open_nodes.append(node)
                opened[tag] += 1
                marks.append((tag, len(open_nodes) - 1))
            else:
                marks.append((tag, 0))
            continue
        flush()
        if tag in VOID:
            continue
        if tag in UNPARSED:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        ends = _ENDS.get(tag, ())
        for depth in range(len(open_nodes) - 1, 0, -1) if any(opened[t] for t in ends) else ():
            if open_nodes[depth].tag in ends:
                close(depth)
            elif open_nodes[depth].tag in _SCOPE or open_nodes[depth].cue:
                break
        main = tag in ("article", "main") or attrs.get("role", "").lower() in ("main", "article") or attrs.get("itemprop") == "articleBody"
        node = Node(tag, main=main, cue=_cue(tag, attrs))
        open_nodes[-1].children.append(node)
        open_nodes.append(node)
        opened[tag] += 1
    close(1)
    return _shaped(_settled(root)) if shaped else _settled(root)


def _shaped(root: Node) -> Node:
    """Sets `shape`, equal for trees that differ in texts without a label only, and `size`, in which labels count too.

    Shapes hold within a process.
    """
    for node in reversed(list(root.walk())):
        node.shape = hash((node.tag, node.beside, node.label, *[c.shape for c in node.children]))
        node.size = 1 + bool(node.label) + sum(c.size for c in node.children)
    return root


def text_key(text: str) -> int:
    """64 bits, as a signed number: among a host's millions of texts no two should be taken for one."""
    key = xxhash.xxh64_intdigest(text.encode(), 42)  # as Spark's xxhash64
    return key - (1 << 64) if key >> 63 else key


def _same_ends(a: Node, b: Node) -> tuple[list[tuple[Node, Node]], list[Node], list[Node]]:
    """Children of equal shape at either end, matched in order, and the children in between."""
    left, right, head, tail = a.children, b.children, 0, 0
    least = min(len(left), len(right))
    while head < least and left[head].shape == right[head].shape:
        head += 1
    while tail < least - head and left[-1 - tail].shape == right[-1 - tail].shape:
        tail += 1
    ends = list(zip(left[:head], right[:head], strict=True)) + list(zip(left[len(left) - tail :], right[len(right) - tail :], strict=True))
    return ends, left[head : len(left) - tail], right[head : len(right) - tail]


def _depth(root: Node) -> int:
    level, depth = [root], 0
    while level:
        level, depth = [c for n in level for c in n.children], depth + 1
    return depth


def align(one: Node, other: Node, memo: dict[tuple[int, int], int] | None = None) -> list[tuple[Node, Node]]:
    """Pairs of nodes matched by simple tree matching: same tags, same order, as many as possible, equal labels first.

    Trees of the same shape match node by node. Children of equal shape at either end match in order, which leaves the
    recurrence for those in between. `memo` keeps scores of shapes for further calls.
    """
    memo = {} if memo is None else memo
    deepest = min(_depth(one), _depth(other))
    if 3 * deepest + 1000 > sys.getrecursionlimit():  # calls below go two for a level, and through no C function
        sys.setrecursionlimit(3 * deepest + 1000)

    def table(x: list[Node], y: list[Node]) -> list[list[int]]:
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x, 1):
            for j, q in enumerate(y, 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + score(p, q))
        return best

    def score(a: Node, b: Node) -> int:
        """The number of matched nodes."""
        if (a.tag, a.beside) != (b.tag, b.beside):
            return 0
        if a.shape == b.shape:
            return a.size
        key = (a.shape, b.shape)
        if key not in memo:
            ends, x, y = _same_ends(a, b)
            memo[key] = 1 + sum(p.size for p, _ in ends) + (table(x, y)[-1][-1] if x and y else 0)
        return memo[key]

    out, stack = [], [(one, other)]
    while stack:
        a, b = stack.pop()
        if a.shape == b.shape:
            pairs = list(zip(a.children, b.children, strict=True))
        else:
            pairs, x, y = _same_ends(a, b)
            best, i, j = table(x, y), len(x), len(y)
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((x[i], y[j]))
        out.extend(pairs)
        stack.extend(pairs)
    return out


@lru_cache(1 << 16)
def _place(parent: int, tag: str) -> int:
    return int.from_bytes(blake2b(f"{parent}/{tag}".encode(), digest_size=7).digest())


def paths(root: Node) -> dict[int, int]:
    """Each node's place, a hash of the tags from the root on, by the node's identity."""
    out, stack = {id(root): 0}, [root]
    while stack:
        node = stack.pop()
        for child in node.children:
            out[id(child)] = _place(out[id(node)], child.tag)
            stack.append(child)
    return out


def _copy(node: Node) -> tuple[Node, list[tuple[Node, Node]]]:
    """A copy of a tree, and the pairs of its nodes and the copied ones."""
    top = Node(node.tag, node.beside, label=node.label)
    pairs, stack = [], [(top, node)]
    while stack:
        new, old = stack.pop()
        pairs.append((new, old))
        new.children = [Node(c.tag, c.beside, label=c.label) for c in old.children]
        stack.extend(zip(new.children, old.children, strict=True))
    return top, pairs


def _grown(reference: Node, tree: Node, memo: dict[tuple[int, int], int]) -> dict[int, Node]:
    """The node of `reference` for each node of `tree`, by identity; nodes that it lacks are added to it in their order."""
    found = {id(b): a for a, b in align(reference, tree, memo)} | {id(tree): reference}
    size, stack = len(found), [tree]
    while stack:
        node = stack.pop()
        inside, before = found[id(node)].children, None
        for child in node.children:
            if id(child) in found:
                stack.append(child)
            else:
                new, pairs = _copy(child)
                at = next((k for k, n in enumerate(inside, 1) if n is before), 0)
                inside.insert(at, new)
                found.update((id(b), a) for a, b in pairs)
            before = found[id(child)]
    if len(found) > size:
        _shaped(reference)
    return found


def slots(trees: list[Node]) -> list[list[tuple[int, int, Node]]]:
    """For each tree its texts as (slot, place, node): texts of different trees aligned with each other have the same slot.

    Texts that stand at the same place of several trees are labels for the alignment, so that a block absent from some
    pages does not push others into its slot. Trees equal but for their other texts are aligned once.
    """
    spots = []
    for tree in trees:
        places = paths(tree)
        spots.append([(places[id(n)], n) for n in tree.walk() if n.tag == "#text"])
    counts = Counter(spot for texts in spots for spot in {(place, n.text) for place, n in texts})
    by_shape: dict[int, list[int]] = {}
    for k, (tree, texts) in enumerate(zip(trees, spots, strict=True)):
        for place, node in texts:
            node.label = 1 + int(node.text) if counts[place, node.text] > 1 else 0
        by_shape.setdefault(_shaped(tree).shape, []).append(k)
    out: list = [None] * len(trees)
    memo: dict[tuple[int, int], int] = {}
    reference = None
    for same in sorted(by_shape.values(), key=lambda s: (-len(s), -trees[s[0]].size, s[0])):
        if reference is None:
            reference = _shaped(_copy(trees[same[0]])[0])
        found = _grown(reference, trees[same[0]], memo)
        numbers = [id(found[id(n)]) for _, n in spots[same[0]]]  # nodes of the reference live as long as it does
        for k in same:
            out[k] = [(slot, place, n) for slot, (place, n) in zip(numbers, spots[k], strict=True)]
    return out


def skeleton(root: Node) -> bytes:
    """A tree without its texts, in page order: a line per element with tag, whether it stands beside the main text and its number of
    children, a line per text with a space for its tag and its length; then, after a zero byte, the texts' hashes."""
    lines, keys = [], []
    for n in root.walk():
        if n.tag == "#text":
            lines.append(f" {int(n.beside)} {n.length or len(n.text)}")
            keys.append(text_key(n.text))
        else:
            lines.append(f"{n.tag} {int(n.beside)} {len(n.children)}".replace("\0", "?"))
    return "\n".join(lines).encode() + b"\0" + np.array(keys, dtype="<i8").tobytes()


def from_skeleton(data: bytes, shaped: bool = True) -> Node:
    lines, _, keys = data.partition(b"\0")
    hashes = iter(np.frombuffer(keys, dtype="<i8").tolist())
    nodes, counts = [], []
    for line in lines.decode().split("\n"):
        tag, beside, n = line.split(" ")
        nodes.append(Node(tag, beside == "1") if tag else Node("#text", beside == "1", text=str(next(hashes)), length=int(n)))
        counts.append(int(n) if tag else 0)
    stack: list[list] = []
    for node, n in zip(nodes, counts, strict=True):
        while stack and not stack[-1][1]:
            stack.pop()
        if stack:
            stack[-1][0].children.append(node)
            stack[-1][1] -= 1
        stack.append([node, n])
    return _shaped(nodes[0]) if shaped else nodes[0]


def blocks(root: Node) -> list[tuple[int, bool, bool, str]]:
    """The texts that stand not beside the main text, in page order: place, whether in an article or main region, whether in an
    article, text."""
    out, stack = [], [(root, 0, False, False)]
    while stack:
        node, place, main, article = stack.pop()
        if node.beside:
            continue
        main, article = main or node.main, article or node.tag == "article"
        if node.text:
            out.append((place, main, article, node.text))
        stack.extend((c, _place(place, c.tag), main, article) for c in reversed(node.children))
    return out


def main_text(root: Node, template: frozenset[tuple[int, int]] = frozenset()) -> str:
    """The texts in page order that stand neither beside the main text nor in the template (place, text hash).

    If some article or main region has such text, only those regions count. Inside an article all texts stay: that several have the
    same subheads makes these no template.
    """
    kept = [b for b in blocks(root) if not template or b[2] or (b[0], text_key(b[3])) not in template]
    return " ".join([b[3] for b in kept if b[1]] or [b[3] for b in kept])


def _joined(found: Column, nodes: Column) -> Column:
    """`main_text` from the blocks of a page, without reading it again."""
    template = F.coalesce(nodes, F.array().cast("array<struct<place:bigint,text:bigint>>"))
    kept = F.filter(found, lambda b: b["article"] | ~F.array_contains(template, F.struct(b["place"].alias("place"), F.xxhash64(b["text"]).alias("text"))))
    inside = F.filter(kept, lambda b: b["main"])
    texts = lambda list_: F.array_join(F.transform(list_, lambda b: b["text"]), " ")
    return F.when(F.size(inside) > 0, texts(inside)).otherwise(texts(kept))


_BLOCK = "array<struct<place:long,main:boolean,article:boolean,text:string>>"


def _parsed(rows: DataFrame) -> DataFrame:
    """row, host, blocks, main (hash of the main text without a template) and tree of each page (row, host, html), written once."""
    schema = T.StructType([rows.schema["row"], rows.schema["host"], *T.StructType.fromDDL(f"blocks {_BLOCK}, main long, tree binary").fields])
    kinds = {"place": pa.int64(), "main": pa.bool_(), "article": pa.bool_(), "text": pa.string()}

    def run(batches):
        for batch in batches:
            held, ends, mains, trees = [], [0], [], []
            for source in batch.column(2):
                root = parse(source.as_py(), shaped=False)
                own = blocks(root)
                held.extend(own)
                ends.append(len(held))
                mains.append(text_key(" ".join([b[3] for b in own if b[1]] or [b[3] for b in own])))
                trees.append(skeleton(root))
            fields = [pa.array(column, kind) for column, kind in zip(zip(*held, strict=True) if held else [()] * 4, kinds.values(), strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, names=list(kinds)))
            columns = [*batch.columns[:2], lists, pa.array(mains, pa.int64()), pa.array(trees, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return written(rows.mapInArrow(run, schema), "parsed", "zstd")


def _chunks(parsed: DataFrame) -> DataFrame:
    """host, chunk, tree: one tree for all pages of a host that have the same main text."""
    trees = written(parsed.groupBy("host", "main").agg(F.min("tree").alias("tree")), "trees", "zstd")
    sizes = written(trees.groupBy("host").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "sizes")
    return trees.join(sizes, "host").select("host", F.pmod(F.xxhash64("main"), F.col("chunks")).alias("chunk"), "tree")


def _shown(root: Node) -> set[int]:
    """The nodes that do not stand beside the main text, by identity."""
    out, stack = set(), [root]
    while stack:
        node = stack.pop()
        if not node.beside:
            out.add(id(node))
            stack.extend(node.children)
    return out


def _contents(trees: list[Node], texts: list[list[tuple[int, int, Node]]]) -> list[int]:
    """For each tree its text in the slot that tells these trees apart best; long texts count more than many kinds.

    Copies of a page under other adverts or dates are one content, or its own paragraphs would pass for repeated texts.
    """
    shown = [_shown(tree) for tree in trees]
    kinds: dict[int, set[str]] = {}
    for found, seen in zip(texts, shown, strict=True):
        for slot, _, node in found:
            if id(node) in seen:
                kinds.setdefault(slot, set()).add(node.text)
    out = []
    for found, seen in zip(texts, shown, strict=True):
        some = [((len(kinds[slot]) - 1) * n.length**2, n.length, n.text) for slot, _, n in found if id(n) in seen]
        out.append(int(max(some)[2]) if some else 0)
    return out


def templates(parsed: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """host, nodes (array of place and text hash): the constant nodes of each host, from `parsed` (host, main, tree).

    Pages with the same main text count once, or a host's only article would pass for its template. Slots are aligned
    within a chunk; which texts repeat is counted over the whole host.
    """

    def one(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        trees = [from_skeleton(x, shaped=False) for x in sorted(group.column("tree").to_pylist())]
        texts = slots(trees)
        numbers: dict[int, int] = {}
        rows: dict[tuple[int, int, int], list[int]] = {}
        for content, found in zip(_contents(trees, texts), texts, strict=True):
            seen = set()
            for slot, place, node in found:
                if (place, node.text) not in seen:
                    seen.add((place, node.text))
                    rows.setdefault((numbers.setdefault(slot, len(numbers)), place, int(node.text)), []).append(content)
        return pa.table({
            "host": pa.array([key[0].as_py()] * len(rows), pa.string()), "chunk": pa.array([key[1].as_py()] * len(rows), pa.int64()),
            "slot": pa.array([s for s, _, _ in rows], pa.int64()), "place": pa.array([p for _, p, _ in rows], pa.int64()),
            "text": pa.array([t for _, _, t in rows], pa.int64()), "n": pa.array(map(len, rows.values()), pa.int64()),
            "contents": pa.array([sorted(set(c)) for c in rows.values()], pa.list_(pa.int64())),
        })

    schema = "host string, chunk long, slot long, place long, text long, n long, contents array<long>"
    spark = parsed.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    # Dealt by chunk, not by host: the chunks of a large host go to many tasks.
    dealt = _chunks(parsed).repartition(tasks, "host", "chunk")
    votes = written(dealt.groupBy("host", "chunk").applyInArrow(one, schema), "votes")
    spot, slot = ["host", "place", "text"], ["host", "chunk", "slot"]
    contents = votes.select(*spot, F.explode("contents").alias("content")).distinct()
    repeated = written(contents.groupBy(*spot).agg(F.count("*").alias("contents")).where(F.col("contents") >= least), "repeated")
    marked = votes.drop("contents").join(repeated.withColumnRenamed("contents", "repeats"), spot, "left")
    filled = marked.groupBy(*slot).agg((F.sum(F.when(F.col("repeats") > 0, F.col("n")).otherwise(0)) / F.sum("n")).alias("filled")).where(F.col("filled") > 0)
    constant = marked.where(F.col("repeats") > 0).join(filled, slot).groupBy(*spot).agg((F.sum(F.col("n") * F.col("filled")) / F.sum("n")).alias("filled"))
    return constant.where(F.col("filled") >= share).groupBy("host").agg(F.collect_list(F.struct("place", "text")).alias("nodes"))


def extracted(pages: DataFrame, url: str = "url", markup: str = "html") -> DataFrame:
    """`pages` without the markup, with `text` and `n_chars`.

    A null or empty page has an empty text; pages with a null url count as one host without a name. Repeated pages are
    extracted alike, an empty table gives an empty result, columns named `text` or `n_chars` are replaced.
    """
    bounded_batches(pages.sparkSession)
    page = F.coalesce(F.col(f"`{markup}`"), F.lit(""))
    host = host_of(F.col(f"`{url}`"))
    rest = without(pages, [markup])
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in rest.columns]).alias("row"), host.alias("host"), page.alias("html"))
    parsed = _parsed(rows)
    found = written(templates(parsed.select("host", "main", "tree")), "templates")
    text = _joined(F.col("blocks"), F.col("nodes"))
    joined = parsed.drop("main", "tree").join(found, "host", "left").select("row", text.alias("text"))
    return unnested(joined.withColumn("n_chars", F.length("text").cast("long")), "text", "n_chars")
