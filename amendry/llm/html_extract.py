"""Main text of web pages by wrapper induction.

Every page becomes the ordered tree of its block elements. The trees of a host are merged
into one, its pivot: each is aligned with what is merged so far by simple tree matching
over their lists of children, and nodes without a partner are added, so that those of every
layout have a place. Then all pages of the host are aligned with the pivot. Among like siblings, texts that a good share of the
host's pages hold on the same path say which belong together. A pivot node whose texts
mostly recur on other aligned pages, in one wording or several, is template for these; a
varying one is a content slot. Where few pages bear a node out, its texts must recur on all of
them, stand before or behind all that varies, and be no longer than what is left. Roles that
markup states by itself (menus, footers, forms, adverts, comments and so on) are never
content, and where a page names its article, content lies inside it.

Pages are parsed once and each distinct tree of a host is aligned once; both are staged. The
aligned texts are counted as hashes, summed up before the shuffle; a host is never
collected. What is joined to a page is the list of its own template nodes.
"""

from __future__ import annotations

import html
import re
from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.llm.rows import add_columns, led
from amendry.llm.url_filter import host_of
from amendry.operators.joins import guarded_join
from amendry.sources.workspace import Workspace

PAGES = 8  # distinct pages that must agree on a text inside a named article, or anywhere if the caller names no number; fewer are few
SHARE = 0.9  # of the pages that have a node inside a named article, must hold such texts there
MOST = 0.5  # of the pages that have any other node, more than this must hold texts that recur there
ALIGNED = 16 << 20  # letters of trees whose alignments a task remembers
LED = 2048  # pages of a host that one copy of its guides or pivot serves
TOGETHER = 16  # trees of a host that one task merges at a time
GUIDES = 16  # a text guides alignment if one in so many pages with its path hold it there
CELLS = 1 << 21  # of a table of two lists of children; longer lists are halved

# fixed values: elements of the HTML standard by the part they play
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math object select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q s samp small span strike "
    "strong sub sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "option": {"option"},
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
TABLE = {"table"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
# fixed values: elements, words of class and id, and roles that are never the article
NEVER = frozenset("nav footer aside form button menu dialog search head".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing "
    "sidebar sidenav signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)

# fixed values: words that say where a part stands or what it is made of; with these alone, one of WORDS means the part
FILLERS = frozenset(
    "site main page top bottom left right header head primary secondary global container wrapper wrap inner outer block box bar "
    "section area list item items link links button buttons icon icons form panel row column col content post posts article "
    "articles entry entries text title module unit slot group media inline sticky fixed mobile desktop".split()
)
# fixed values: elements that a page has one of, or few; a form around one is the page's own frame
FRAMED = frozenset("article main h1 nav footer header".split())

_TAG = re.compile(
    r"""<!--(?:.*?(?:-->|--!>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z!?][^>]*>|<[!?/][^>]*>""", re.S
)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PIECES = re.compile(r"[A-Za-z]+|\d+")
_DIGITS = re.compile(r"\d+")


class Page:
    """Block elements and text blocks of one page, and their ordered tree."""

    def __init__(self, text: str):
        # of every element: parent, whether its own markup keeps it from content, tag, whether it is a header
        self.parent, self.barred, self.tag, self.header = [-1], [False], ["html"], [False]
        self.blocks: list[tuple[int, str]] = []
        self.signatures = ["html"]
        self._parse(text)

    def _parse(self, text: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # inline elements have their block's number, or one of their own
        words: list[str] = []

        def flush(to: int) -> None:
            if words:
                line = " ".join(html.unescape("".join(words)).split())
                words.clear()
                if line:
                    self.blocks.append((to, line))

        def block() -> int:
            return stack[-1][1]

        def pop_to(k: int) -> None:
            if any(t not in INLINE for t, _ in stack[k:]):
                flush(block())
            del stack[k:]

        at, size = 0, len(text)
        while at < size:
            m = _TAG.search(text, at)
            if m is None:
                words.append(text[at:])
                break
            if m.start() > at:
                words.append(text[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag in ("html", "body"):
                    continue
                if tag == "p" and not any(t == "p" for t, _ in stack):
                    flush(block())
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        pop_to(k)
                        break
                    if tag in INLINE and stack[k][0] not in INLINE:
                        break  # an inline end tag closes nothing outside its block
                continue
            if tag == "br":
                words.append(" ")
                continue
            if tag in ("html", "body"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(text, at)
                if not m[3].endswith("/") or tag not in ("svg", "math"):
                    at = end.end() if end else size
                if tag not in INLINE:
                    words.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush(block())
                continue
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        pop_to(k)
                        break
                    if stack[k][0] not in INLINE:
                        break
            if tag in ENDED_BY:
                stop = SCOPE.get(tag, TABLE)
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in ENDED_BY[tag]:
                        pop_to(k)
                        if tag in ("li", "dt", "dd", "td", "th", "option"):
                            break
                    elif stack[k][0] in stop:
                        break
            if tag in INLINE:
                barred = bool(m[3]) and self._bars(tag, m[3])
                if barred:  # left out without parting the block around it
                    at = self._skip(text, at, tag)
                    words.append(" ")
                else:
                    stack.append((tag, block()))
                continue
            flush(block())
            stack.append((tag, self._add(block(), tag, m[3])))
        flush(block())

    @staticmethod
    def _skip(text: str, at: int, tag: str) -> int:
        depth = 1
        for m in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I).finditer(text, at):
            depth += -1 if m[1] else 1
            if not depth:
                return m.end()
        return at

    @staticmethod
    def _attributes(raw: str) -> dict[str, str]:
        return {k.lower(): (v or "").strip("\"'") for k, v in _NAMED.findall(raw)}

    def _bars(self, tag: str, raw: str) -> bool:
        if tag in NEVER:
            return True
        if not raw or tag in ("html", "body"):
            return False
        named = self._attributes(raw)
        if named.get("role", "").lower() in ROLES:
            return True
        if tag in MAIN and not {"comment", "reply"} & set(_PIECES.findall(named.get("class", "").lower())):
            return False
        return any(self._says_so(token) for n in ("class", "id") for token in named.get(n, "").lower().split())

    @staticmethod
    def _says_so(token: str) -> bool:
        """Whether a class or id as a whole names a part that is never the article; `share-price` does not."""
        words = {w for w in _PIECES.findall(token) if not w.isdigit()}
        return not words.isdisjoint(WORDS) and words <= WORDS | FILLERS

    def _add(self, parent: int, tag: str, raw: str) -> int:
        named = self._attributes(raw) if raw else {}
        mark = " ".join(sorted({_DIGITS.sub("#", w) for w in named.get("class", "").split()}))
        ident = "_".join(_DIGITS.sub("#", named.get("id", "")).split())
        self.signatures.append(tag + (f".{mark}" if mark else "") + (f" id={ident}" if ident else ""))
        self.parent.append(parent)
        self.barred.append(self._bars(tag, raw))
        self.tag.append(tag)
        words = {w.lower() for n in ("class", "id") for w in _PIECES.findall(named.get(n, ""))}
        self.header.append(tag == "header" or ("header" in words and tag not in MAIN))
        return len(self.parent) - 1

    # ---- the tree

    def tree(self) -> str:
        """Nodes as "place of the parent, signature", in order of appearance."""
        return "\n".join(f"{a} {s}" for a, s in zip(self.parent[1:], self.signatures[1:]))

    def hashes(self) -> np.ndarray:
        """Hash of all text directly in each node; 0 where there is none."""
        texts: dict[int, list[str]] = {}
        for node, line in self.blocks:
            texts.setdefault(node, []).append(line)
        out = np.zeros(len(self.signatures), np.int64)
        for k, lines in texts.items():
            out[k] = np.uint64(xxhash.xxh64_intdigest("\n".join(lines)) | 1).astype(np.int64)
        return out

    # ---- content

    def lines(self) -> list[tuple[int, bool, str]]:
        """Blocks that may be the article's, as (node, whether the page names them article, text)."""
        n = len(self.parent)
        holds = [t in MAIN for t in self.tag]
        frame = [t in FRAMED for t in self.tag]
        for k in range(n - 1, 0, -1):
            if holds[k] and not (self.tag[k] in MAIN and self.barred[k]):
                holds[self.parent[k]] = True
            if frame[k] or self.tag[k] == "form" and holds[k]:
                frame[self.parent[k]] = True
        out, inside, header = [False] * n, [""] * n, [False] * n
        # a header around the article is a container; one inside keeps its headings; any other is furniture
        for k in range(1, n):
            p = self.parent[k]
            if self.tag[k] == "form":
                around = frame[k]
            else:
                around = holds[k] and self.tag[k] not in MAIN and self.tag[k] not in NEVER
            out[k] = out[p] or (self.barred[k] and not around)
            inside[k] = self.tag[k] if self.tag[k] in MAIN else inside[p]
            header[k] = header[p] or (self.header[k] and not holds[k])
            if header[k] and not inside[k]:
                out[k] = True
        usable = [(k, line) for k, line in self.blocks if not out[k]]
        for part in ("article", "main"):
            if any(t == part and not o for t, o in zip(self.tag, out)):
                usable = [(k, line) for k, line in usable if inside[k] == part or (part == "main" and inside[k])]
                break
        return [(k, bool(inside[k]), line) for k, line in usable if not header[k] or self._in_heading(k)]

    def _in_heading(self, k: int) -> bool:
        while k > 0:
            if self.tag[k] in HEADINGS:
                return True
            k = self.parent[k]
        return False


def kept(lines: list[tuple[int, bool, str]], certain: set[int], template: set[int], few: set[int]) -> list[str]:
    """The texts left when template nodes go: `certain` ones anywhere, others where the page does not name its article.

    Those of `few`, which few pages bear out, go only before or behind all that is left, and
    only if none is longer than all of it.
    """
    stay, doubtful = [], []
    for at, (node, inside, line) in enumerate(lines):
        if node in certain or (node in template and not inside):
            continue
        (doubtful if node in few and not inside else stay).append((at, line))
    if doubtful:
        first, last = (stay[0][0], stay[-1][0]) if stay else (0, len(lines))
        taken = [line for at, line in doubtful if not first < at < last]
        doubtful = [(at, line) for at, line in doubtful if first < at < last]
        if max(map(len, taken), default=0) > sum(len(line) for _, line in stay + doubtful):
            return [line for node, inside, line in lines if node not in certain and (inside or node not in template)]
    return [line for _, line in sorted(stay + doubtful)]


# ---- simple tree matching


@dataclass
class _Tree:
    signatures: list[str]
    children: list[list[int]]
    guides: list[frozenset[str]]  # texts by which a node is told from like siblings
    shapes: list[int]  # hash of each node's subtree
    heights: list[int]


def _read_tree(text: str) -> _Tree:
    signatures, children, guides = ["html"], [[]], [frozenset()]
    for k, line in enumerate(text.split("\n") if text else [], 1):
        place, _, signature = line.partition(" ")
        parent, _, known = place.partition("=")
        signatures.append(signature)
        guides.append(frozenset(known.split(",")) if known else frozenset())
        children.append([])
        children[int(parent)].append(k)
    shapes, heights = [0] * len(signatures), [0] * len(signatures)
    for k in range(len(signatures) - 1, -1, -1):
        shapes[k] = hash((signatures[k], guides[k], tuple(shapes[c] for c in children[k])))
        heights[k] = 1 + max((heights[c] for c in children[k]), default=-1)
    return _Tree(signatures, children, guides, shapes, heights)


@dataclass
class _Weights:
    """Weights of all pairs of two lists of children, by their kinds: 0 for unlike ones."""

    table: np.ndarray
    rows: np.ndarray
    columns: np.ndarray

    def part(self, top: int, end: int, left: int, right: int, turned: bool = False) -> _Weights:
        step = -1 if turned else 1
        return _Weights(self.table, self.rows[top:end][::step], self.columns[left:right][::step])

    def last(self) -> np.ndarray:
        """Weight of the heaviest ordered matching of all rows and the first j columns."""
        best = np.zeros(len(self.columns) + 1, np.int64)
        for kind in self.rows:
            best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + self.table[kind][self.columns]))
        return best

    def all(self) -> np.ndarray:
        """The same for the first i rows, one line each."""
        best = np.zeros((len(self.rows) + 1, len(self.columns) + 1), np.int64)
        for i, kind in enumerate(self.rows):
            np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + self.table[kind][self.columns]), out=best[i + 1, 1:])
        return best

    def matched(self) -> list[tuple[int, int]]:
        """The heaviest ordered matching, the first of like siblings where there is a choice."""
        found, todo = [], [(0, len(self.rows), 0, len(self.columns))]
        while todo:
            top, end, left, right = todo.pop()
            i, j = end - top, right - left
            if not i or not j:
                continue
            if i * j > CELLS and i > 1:  # too large a table to keep: halve the rows and cut the columns where the sum is best
                half = i // 2
                above = self.part(top, top + half, left, right).last()
                below = self.part(top + half, end, left, right, turned=True).last()[::-1]
                cut = left + int(np.argmax(above + below))
                todo += [(top, top + half, left, cut), (top + half, end, cut, right)]
                continue
            best = self.part(top, end, left, right).all()
            while i and j:
                if best[i, j] == best[i - 1, j]:
                    i -= 1
                elif best[i, j] == best[i, j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    found.append((top + i, left + j))
        return sorted(found)


def align(a: str, b: str) -> dict[int, int]:
    """Nodes of tree a with their partners in b, by simple tree matching.

    Partners have equal signatures, partner parents, and keep their order among siblings.
    The matching is the heaviest; a node counts twice as much where the two share a guiding
    text, and half as much where only unlike ones are known. Without such texts it has the most nodes.
    """
    return _align(_read_tree(a), _read_tree(b))


def _align(left: _Tree, right: _Tree) -> dict[int, int]:
    shape = left.shapes, right.shapes
    below: dict[tuple[int, int], int] = {}  # by shapes: what the children of a pair weigh at most

    def weights(x: int, y: int) -> _Weights:
        kinds: tuple[dict, dict] = {}, {}
        sides = []
        for found, tree, cs in ((kinds[0], left, left.children[x]), (kinds[1], right, right.children[y])):
            sides.append(np.array([found.setdefault(tree.shapes[c], (len(found), c))[0] for c in cs], np.int64))
        table = np.zeros((len(kinds[0]), len(kinds[1])), np.int64)
        by_name: dict[str, list] = {}
        for m, (j, d) in kinds[1].items():
            by_name.setdefault(right.signatures[d], []).append((j, m, right.guides[d]))
        for n, (i, c) in kinds[0].items():
            known = left.guides[c]
            for j, m, others in by_name.get(left.signatures[c], ()):
                table[i, j] = (1 if known.isdisjoint(others) else 4) if known or others else 2
                if below:
                    table[i, j] += below.get((n, m), 0)
        return _Weights(table, *sides)

    # pairs of subtrees are weighed once for each pair of shapes, from the leaves up
    pairs, seen = [(0, 0)], {(shape[0][0], shape[1][0])}
    for x, y in pairs:  # grows while it is read
        inner: dict[str, dict[int, int]] = {}
        for d in right.children[y]:
            if right.children[d]:
                inner.setdefault(right.signatures[d], {}).setdefault(shape[1][d], d)
        for n, c in {shape[0][c]: c for c in left.children[x] if left.children[c]}.items():
            for m, d in inner.get(left.signatures[c], {}).items():
                if (n, m) not in seen:
                    seen.add((n, m))
                    pairs.append((c, d))
    for x, y in sorted(pairs[1:], key=lambda pair: left.heights[pair[0]]):
        below[shape[0][x], shape[1][y]] = int(weights(x, y).last()[-1])
    match, todo = {0: 0}, [(0, 0)]
    while todo:
        x, y = todo.pop()
        xs, ys = left.children[x], right.children[y]
        if xs and ys:
            for i, j in weights(x, y).matched():
                match[xs[i]] = ys[j]
                todo.append((xs[i], ys[j]))
    return match


def _merge(base: _Tree, other: _Tree) -> str:
    """The nodes of both trees, partners as one; siblings keep the order of each."""
    partner = _align(other, base)
    lines: list[str] = []
    todo = [(0, 0, 0)]  # node of base or -1, of other or -1, place of the parent
    place = -1
    while todo:
        x, y, parent = todo.pop()
        place += 1
        if place:
            known = (base.guides[x] if x >= 0 else frozenset()) | (other.guides[y] if y >= 0 else frozenset())
            mark = "=" + ",".join(sorted(known)) if known else ""
            lines.append(f"{parent}{mark} {base.signatures[x] if x >= 0 else other.signatures[y]}")
        own, below, at = base.children[x] if x >= 0 else [], [], 0
        for c in other.children[y] if y >= 0 else []:
            if (d := partner.get(c)) is not None and x >= 0:
                while own[at] != d:
                    below.append((own[at], -1, place))
                    at += 1
                below.append((d, c, place))
                at += 1
            else:
                below.append((-1, c, place))
        todo += reversed(below + [(d, -1, place) for d in own[at:]])
    return "\n".join(lines)


class _Aligner:
    """Alignments with a host's pivot; the last ones are remembered, in at most about ALIGNED letters of trees."""

    def __init__(self):
        self.known: OrderedDict[tuple[str, str], dict[int, int]] = OrderedDict()
        self.held = 0

    def __call__(self, host: str, tree: str, pivot: _Tree) -> dict[int, int]:
        key = (host, tree)
        if key not in self.known:
            self.held += len(tree)
            while self.known and self.held > ALIGNED:
                self.held -= len(self.known.popitem(last=False)[0][1])
            self.known[key] = _align(_read_tree(tree), pivot)
        return self.known[key]


# ---- Spark


def _text(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


PARSED = T.StructType(
    [
        T.StructField("shape", T.StringType()),
        T.StructField("tree", T.StringType()),
        T.StructField("hashes", T.ArrayType(T.LongType())),
        T.StructField("nodes", T.ArrayType(T.IntegerType())),
        T.StructField("inside", T.ArrayType(T.BooleanType())),
        T.StructField("lines", T.ArrayType(T.StringType())),
    ]
)


def _parsed(pages) -> list[pa.Array]:
    """A page's shape (hash of tree and texts), tree, hashes of texts by node, and lines; a null page has no shape."""
    shapes, trees, hashes, found = [], [], [], []
    for raw in pages.cast(pa.binary()):
        page = Page(_text(raw.as_py()))
        trees.append(page.tree())
        hashes.append(page.hashes())
        shape = xxhash.xxh3_128_hexdigest(trees[-1].encode() + b"\0" + hashes[-1].tobytes())
        shapes.append(shape if raw.is_valid else None)
        found.append(page.lines())
    lists = [pa.array([[x[k] for x in own] for own in found], pa.list_(t)) for k, t in enumerate((pa.int32(), pa.bool_(), pa.string()))]
    return [pa.array(shapes, pa.string()), pa.array(trees, pa.string()), pa.array(hashes, pa.list_(pa.int64())), *lists]


def _paths(tree: str) -> list[int]:
    """Hash of the signatures from the root to each node."""
    out = [0]
    for line in tree.split("\n") if tree else []:
        parent, _, signature = line.partition(" ")
        out.append(int(np.uint64(xxhash.xxh64_intdigest(f"{out[int(parent)]} {signature}")).astype(np.int64)))
    return out


def _path_texts(batches):
    for batch in batches:
        hosts, paths, seen = [], [], []
        for host, tree, hashes in zip(*[batch.column(c).to_pylist() for c in ("host", "tree", "hashes")]):
            own = _paths(tree)
            found = {(p, h) for p, h in zip(own, hashes) if h} | {(p, 0) for p in own}  # 0 counts the pages with the path
            for path, text in found:
                hosts.append(host)
                paths.append(path)
                seen.append(text)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.int64()), pa.array(seen, pa.int64())], names=["host", "path", "hash"]
        )


def _guides(skeletons: DataFrame) -> DataFrame:
    """(host, guides): lines of the paths that several distinct pages have, each with the texts that guide alignment."""
    kinds = skeletons.mapInArrow(_path_texts, "host string, path bigint, hash bigint")
    kinds = kinds.groupBy("host", "path", "hash").agg(F.count("*").alias("n")).filter("n >= 2")
    kinds = Workspace(skeletons.sparkSession).stage(kinds, "path_texts")
    paths = kinds.filter("hash = 0").select("host", "path", F.col("n").alias("pages"))
    texts = guarded_join(kinds.filter("hash <> 0"), paths, [("host", "host"), ("path", "path")], "inner").filter(F.col("n") * GUIDES >= F.col("pages"))
    lines = paths.select("host", "path", F.lit(None).cast("long").alias("hash")).union(texts.select("host", "path", "hash"))
    lines = lines.groupBy("host", "path").agg(F.array_join(F.array_sort(F.collect_list(F.col("hash").cast("string"))), ",").alias("texts"))
    lines = lines.groupBy("host").agg(F.array_sort(F.collect_list(F.concat_ws("=", F.col("path").cast("string"), "texts"))).alias("lines"))
    return lines.select("host", F.array_join("lines", "\n").alias("guides"))


def _read_guides(text: str) -> dict[int, frozenset[int]]:
    lines = (line.partition("=") for line in text.split("\n"))
    return {int(path): frozenset(map(int, texts.split(","))) if texts else frozenset() for path, _, texts in lines}


def _guided(tree: str, hashes, guides: dict[int, frozenset[int]]) -> tuple[str, list[int]]:
    """The tree with guiding texts, less the nodes whose path no other page has, and the places of those left."""
    places, kept, lines = {0: 0}, [0], []
    own = _paths(tree)
    for k, line in enumerate(tree.split("\n") if tree else [], 1):
        parent, _, signature = line.partition(" ")
        if (known := guides.get(own[k])) is not None and int(parent) in places:
            places[k] = len(kept)
            kept.append(k)
            text = f"={hashes[k]}" if hashes[k] in known else ""
            lines.append(f"{places[int(parent)]}{text} {signature}")
    return "\n".join(lines), kept


def _led_rows(batches, names: list[str], fact: str, read):
    """For every batch, its rows that are led, and for each the fact of its leader, read once."""
    place, known = None, None
    for batch in batches:
        kept, facts = [], []
        leads, hosts, parts = (batch.column(c).to_pylist() for c in ("_lead", "host", "_part"))
        for k, key in enumerate(zip(hosts, parts)):
            if leads[k]:
                place, known = key, read(batch.column(fact)[k].as_py())
            elif key == place:
                kept.append(k)
                facts.append(known)
        own = batch.take(pa.array(kept, pa.int64())) if len(kept) < batch.num_rows else batch
        yield own, facts, [own.column(c).to_pylist() for c in names]


def _guided_pages(batches):
    for own, facts, columns in _led_rows(batches, ["tree", "hashes", "nodes"], "guides", _read_guides):
        trees, texts, places = [], [], []
        for guides, tree, hashes, nodes in zip(facts, *columns):
            labelled, kept_places = _guided(tree, hashes, guides)
            usable = set(nodes)  # only texts that may be content need a decision
            trees.append(labelled)
            texts.append([hashes[k] if k in usable else 0 for k in kept_places])
            places.append(kept_places)
        found = [pa.array(trees, pa.string()), pa.array(texts, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(
            [own.column("host"), own.column("shape"), *found], names=["host", "shape", "tree", "hashes", "places"]
        )


def _aligned(batches):
    aligner = _Aligner()
    for own, facts, columns in _led_rows(batches, ["host", "tree", "hashes", "places"], "pivot", _read_tree):
        found = []
        for pivot, host, tree, hashes, places in zip(facts, *columns):
            found.append([(places[a], b, hashes[a]) for a, b in aligner(host, tree, pivot).items() if hashes[a]])
        types = (pa.int32(), pa.int32(), pa.int64())
        lists = [pa.array([[x[k] for x in pairs] for pairs in found], pa.list_(t)) for k, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(
            [own.column("host"), own.column("shape"), *lists], names=["host", "shape", "place", "node", "hash"]
        )


def _merge_all(batches):
    for batch in batches:
        merged = []
        for trees in batch.column("trees").to_pylist():
            first, *rest = sorted(trees, key=lambda t: (-len(t), t))
            for tree in rest:
                first = _merge(_read_tree(first), _read_tree(tree))
            merged.append(first)
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(merged, pa.string())], names=["host", "tree"])


def _pivots(pages: DataFrame, work: Workspace) -> DataFrame:
    """(host, pivot): all trees of a host merged into one, in turns of a few trees a task."""
    trees, turn = work.stage(pages.select("host", "tree").distinct(), "trees_0"), 0
    while True:
        counts = work.stage(trees.groupBy("host").agg(F.count("*").alias("count")), f"counts_{turn}")
        if (counts.agg(F.max("count")).first()[0] or 0) <= 1:
            return trees.select("host", F.col("tree").alias("pivot"))
        turn += 1
        dealt = guarded_join(trees, counts, [("host", "host")], "inner")
        part = F.pmod(F.xxhash64("tree"), F.ceil(F.col("count") / TOGETHER))
        groups = dealt.groupBy("host", part.alias("part")).agg(F.collect_list("tree").alias("trees"))
        # few bytes and much work: dealt out by number, or adaptive execution would put all into one task
        rows = counts.agg(F.sum(F.ceil(F.col("count") / TOGETHER))).first()[0]
        groups = groups.select("host", "trees").repartition(_width(counts.sparkSession, int(rows), 1))
        trees = work.stage(groups.mapInArrow(_merge_all, "host string, tree string").distinct(), f"trees_{turn}")


def _width(spark, rows: int, each: int) -> int:
    """Tasks for so many rows of work: several for each core, and more where a task would have more than `each` rows' worth."""
    return max(1, min(-(-rows // each), 4 * spark.sparkContext.defaultParallelism + rows // (64 * each)))


def template_nodes(skeletons: DataFrame, least: int, work: Workspace) -> DataFrame:
    """(host, shape, certain, template, few): template nodes of the distinct pages that have any.

    From staged rows (host, shape, tree, hashes, nodes), one for each shape; only texts of
    `nodes`, which may be content, are looked at. A text recurs if
    `least` distinct pages hold it in the same node of the pivot. A node is template if more
    than MOST of the pages that have it hold recurring texts, one or several, or all of them
    where they are fewer than PAGES; in other nodes a text met again is content, as in near
    copies of an article. Another node must not be template and have `least` different texts.
    Nodes of fewer than PAGES pages are in `few`. Texts that PAGES pages hold, in a node of
    which a SHARE do so, are in `certain`.
    """
    spark, rows = skeletons.sparkSession, skeletons.count()
    guides = work.stage(_guides(skeletons), "guides")
    tasks = _width(spark, rows, 64)
    schema = "host string, shape string, tree string, hashes array<bigint>, places array<int>"
    pages = led(skeletons, guides, "host", "shape", LED, tasks).mapInArrow(_guided_pages, schema)
    pages = work.stage(pages, "guided")
    schema = "host string, shape string, place array<int>, node array<int>, hash array<bigint>"
    pivots = _pivots(pages, work)
    aligned = work.stage(led(pages, pivots, "host", "shape", LED, tasks).mapInArrow(_aligned, schema), "aligned")
    texts = aligned.select("host", "shape", F.explode(F.arrays_zip("place", "node", "hash")).alias("t")).select("host", "shape", "t.*")
    kinds = work.stage(texts.groupBy("host", "node", "hash").agg(F.count("*").alias("n")), "kinds")
    again, often = F.col("n") >= least, F.col("n") >= PAGES
    slots = kinds.groupBy("host", "node").agg(
        F.sum(F.when(again, F.col("n")).otherwise(0)).alias("again"),
        F.sum(F.when(often, F.col("n")).otherwise(0)).alias("often"),
        F.sum("n").alias("n"),
        F.count("*").alias("kinds"),
    )
    many = F.col("n") >= PAGES
    same = (F.col("again") > MOST * F.col("n")) & (many | (F.col("again") == F.col("n")))
    slots = slots.withColumns({"same": same, "strong": F.col("often") >= SHARE * F.col("n"), "few": ~many})
    varied = slots.groupBy("host").agg(F.max(F.when(~F.col("same"), F.col("kinds"))).alias("varied")).filter(F.col("varied") >= least)
    slots = guarded_join(slots.filter("same").select("host", "node", "strong", "few"), varied, [("host", "host")], "inner")
    found = guarded_join(kinds.filter(again), slots, [("host", "host"), ("node", "node")], "inner")
    firm = often & F.col("strong") & (F.col("varied") >= PAGES)
    found = work.stage(found.select("host", "node", "hash", "few", firm.alias("firm")), "template")
    hits = guarded_join(texts, found, [("host", "host"), ("node", "node"), ("hash", "hash")], "inner")
    nodes = lambda test: F.collect_list(F.when(test, F.col("place")))
    few, firm = F.col("few"), F.col("firm")
    return hits.groupBy("host", "shape").agg(
        nodes(firm).alias("certain"), nodes(~firm & ~few).alias("template"), nodes(~firm & few).alias("few")
    )


def add_text(
    df: DataFrame, url: str = "url", page: str = "html", name: str = "text", least: int = PAGES, keep_page: bool = True
) -> DataFrame:
    """df + string `name`: the main text of every page, empty if there is none.

    Blocks are joined in page order by one line end; white space inside a block becomes one
    space. A null page is an empty one; pages without a host share the empty host. Copies
    of a page count once in its host's wrapper, which takes a text for template if at least
    `least` distinct pages hold it. A column of df named `name` is replaced;
    all rows and other columns stay, but for the page itself unless it is kept. Pages are
    read whole, and an empty table gives an empty result.
    """
    work = Workspace(df.sparkSession)
    gone = {name.lower()} | (set() if keep_page else {page.lower()})
    left = [c for c in df.columns if c.lower() not in gone]
    row = F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in left]).alias("_row")
    rows = df.select(row, host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{page}`").alias("_page"))
    pages = work.stage(add_columns(rows, ["_page"], list(PARSED), _parsed).drop("_page"), "pages", "zstd")
    same = [F.first(c).alias(c) for c in ("tree", "hashes", "nodes")]
    skeletons = work.stage(pages.filter("shape is not null").groupBy("host", "shape").agg(*same), "shapes")
    known = work.stage(template_nodes(skeletons, least, work), "known")
    joined = pages.select("_row", "host", "shape", "nodes", "inside", "lines")
    joined = guarded_join(joined, known, [("host", "host"), ("shape", "shape")], "left")

    def compute(nodes, inside, lines, certain, template, few):
        out = []
        for n, i, texts, *sets in zip(*[x.to_pylist() for x in (nodes, inside, lines, certain, template, few)]):
            out.append("\n".join(texts if sets[0] is None else kept(list(zip(n, i, texts)), *map(set, sets))))
        return [pa.array(out, pa.string())]

    using = ["nodes", "inside", "lines", "certain", "template", "few"]
    found = add_columns(joined, using, [T.StructField("_text", T.StringType())], compute)
    return found.select(*[F.col(f"_row.`{c}`") for c in left], F.col("_text").alias(name))
