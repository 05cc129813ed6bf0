"""Main text of web pages by a tree-structured graphical model over the DOM.

Each element is a node with two states, content and boilerplate. Its own potential sums the weights of its features
(tag, words of class, id and role, link density, text length), and each edge has a 2x2 potential chosen by
the kind of the child (block or inline). An inline element whose names tell nothing shares the state of the element around it. Sum-product messages run from the leaves to the root and back
and give every node's marginal. Weights are trained by gradient ascent on the likelihood of the labelled pages in
``LABELLED`` (small pages written for this, ``data-y="1"`` on the roots of content and ``data-y="0"`` on the roots of boilerplate).

The parser reads any input: unclosed and stray tags, implied ends of p, li, td and the like, comments, raw text of script
and style, cut-off documents. Text belongs to the nearest block; a block's text is kept if the marginal of
the element that holds it is at least 0.5. Character references are decoded, white space within a block becomes one space, ends are
trimmed, and blocks are joined in page order by an empty line.

Defined results: a null or empty page gives an empty text, as does one without content; repeated rows are each
extracted; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from tessera.llm import textbatch as tb

#: Elements by kind, from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe svg textarea select title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul option button".split()
)
#: An opening tag of the first kind ends an open element of the second (up to the third).
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SAME = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})}
#: An end tag reaches out of a table's cells only if it is one of the second kind; an open p ends within the third.
CELLS = ("table", "td", "th")
ENDS_CELLS = frozenset("table tr tbody thead tfoot div article main section body html aside footer nav".split())
HOLDS_P = ("table", "td", "th", "div", "article", "section", "button", "li", "blockquote")

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(/?)>", re.S)
_ATTR = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_NAME = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "attrs", "text", "own", "total", "linked", "label")

    def __init__(self, tag: str, parent: Node | None, attrs: str = ""):
        self.tag, self.parent, self.attrs = tag, parent, attrs
        self.children: list[Node] = []
        self.text: list[tuple[int, str]] = []  # (place in page, text)
        self.own = self.total = self.linked = 0
        self.label = None


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(source):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def parse(page: str) -> tuple[list[Node], list[tuple[int, Node, bool]]]:
    """(nodes, parents first; pieces (place, node, starts a block) in page order)."""
    root = Node("#root", None)
    nodes, stack = [root], [root]
    open_at: dict[str, list[int]] = {}  # places in the stack of the open elements of each name, so that nothing walks the stack
    pieces: list[tuple[int, Node, bool]] = []
    at, place, broken = 0, 0, True
    size, tags_end = len(page), page.rfind(">")

    def put(text: str) -> None:
        nonlocal place, broken
        if text and not text.isspace():
            stack[-1].text.append((place, text))
            pieces.append((place, stack[-1], broken))
            place += 1
            broken = False
        elif text and not broken and pieces:  # white space between inline pieces
            stack[-1].text.append((place, " "))
            pieces.append((place, stack[-1], False))
            place += 1

    def close(k: int) -> None:
        nonlocal broken
        while len(stack) > k:
            name = stack.pop().tag
            open_at[name].pop()
            broken = broken or name in BLOCK

    def last(names) -> int:
        """Place of the innermost open element of one of these names; 0 if none is open."""
        return max((open_at[n][-1] for n in names if open_at.get(n)), default=0)

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            put(page[at:])
            break
        m = (_TOKEN.match(page, lt) or _LOOSE.match(page, lt)) if lt < tags_end else None
        if m is None:
            if lt + 1 < size and (page[lt + 1].isalpha() or page[lt + 1] in "/!?"):
                put(page[at:lt])  # cut off within a tag
                break
            put(page[at : lt + 1])
            at = lt + 1
            continue
        if lt > at:
            put(page[at:lt])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            k = last((tag,))
            if k and (k >= last(CELLS) or tag in ENDS_CELLS):
                close(k)
            elif tag == "p":
                broken = True
            continue
        if tag == "br":
            if not broken and pieces:
                stack[-1].text.append((place, " "))
                pieces.append((place, stack[-1], False))
                place += 1
            continue
        if tag in VOID:
            if tag == "hr":
                broken = True
            continue
        if tag in ("html", "body") and open_at.get(tag):
            continue
        if tag in CLOSES_P and last(("p",)) > last(HOLDS_P):
            close(last(("p",)))
        if tag in SAME:
            ends, stops = SAME[tag]
            inside = last(stops)
            found = [where[k] for n in ends if (where := open_at.get(n)) and (k := bisect_right(where, inside)) < len(where)]
            if found:
                close(min(found))
        if tag == "body" and open_at.get("head"):
            close(open_at["head"][0])
        node = Node(tag, stack[-1], m[3])
        stack[-1].children.append(node)
        nodes.append(node)
        if tag in BLOCK:
            broken = True
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if not m[4]:
            open_at.setdefault(tag, []).append(len(stack))
            stack.append(node)
    return nodes, pieces


def _measure(nodes: list[Node]) -> None:
    for n in reversed(nodes):
        n.own = sum(len(t.strip()) for _, t in n.text)
        n.total = n.own + sum(c.total for c in n.children)
        n.linked = n.total if n.tag == "a" else sum(c.linked for c in n.children)


def _names(n: Node) -> list[str]:
    """Features of what an element is called, and whether it is hidden."""
    out: list[str] = []
    if n.attrs:
        found = attributes(n.attrs)
        for key in ("class", "id", "role", "itemprop", "aria-label"):
            if found.get(key):
                out += [f"name:{w}" for w in _NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", found[key]).lower())]
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
            out.append("hidden")
    return out


def _features(n: Node) -> list[str]:
    out = ["bias", f"tag:{n.tag}"]
    if n.tag == "p":
        out.append("size:long" if n.total >= 80 else "size:short")
    if n.tag in ("div", "section", "table", "ul", "ol", "td"):
        out.append(f"block:{'empty' if not n.total else 'long' if n.total >= 200 else 'short'}")
    if n.tag in BLOCK and n.total:
        share = n.linked / n.total
        out.append("links:most" if share > 0.6 else "links:some" if share > 0.2 else "links:few")
    return out + _names(n)


def contract(nodes: list[Node], known: set[str]) -> tuple[list[Node], dict[int, Node]]:
    """(nodes of the model, parents first; node that decides for each element, by id).

    An inline element whose names tell nothing is no variable of its own: it shares the state of the element around it, however
    many of them are nested. Call it after ``_measure``.
    """
    kept, owner = [], {}
    for n in nodes:
        if n.parent is not None and n.tag not in BLOCK and not (n.attrs and any(x in known for x in _names(n))):
            owner[id(n)] = owner[id(n.parent)]
            continue
        owner[id(n)] = n
        if n.parent is not None:
            n.parent = owner[id(n.parent)]
        kept.append(n)
    return kept, owner


def _edge_kind(n: Node) -> int:
    return 0 if n.tag in BLOCK else 1


class Model:
    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.known: set[str] = {"hidden"}  # names that training pages use
        self.edges = np.zeros((2, 2, 2))  # kind, parent state, child state

    def potentials(self, nodes: list[Node]) -> np.ndarray:
        w = self.weights
        return np.array([sum(w.get(f, 0.0) for f in _features(n)) for n in nodes])

    def marginals(self, nodes: list[Node], own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of each node, and joint marginals (node, parent state, own state); exact on the tree."""
        own = self.potentials(nodes) if own is None else own
        index = {id(n): k for k, n in enumerate(nodes)}
        e = np.exp(self.edges)
        edges = [((a[0][0], a[0][1]), (a[1][0], a[1][1])) for a in e.tolist()]
        up = [[1.0, float(np.exp(min(max(x, -30), 30)))] for x in own]  # belief of the subtree at the node
        to = [(1.0, 1.0)] * len(nodes)  # message to the parent
        kinds = [_edge_kind(n) for n in nodes]
        parents = [index[id(n.parent)] if n.parent is not None else -1 for n in nodes]
        for k in range(len(nodes) - 1, 0, -1):
            b0, b1 = up[k]
            z = b0 + b1
            b0, b1 = b0 / z, b1 / z
            up[k] = [b0, b1]
            (t00, t01), (t10, t11) = edges[kinds[k]]
            m = (t00 * b0 + t01 * b1, t10 * b0 + t11 * b1)
            z = m[0] + m[1]
            to[k] = (m[0] / z, m[1] / z)
            p = up[parents[k]]
            p[0] *= to[k][0]
            p[1] *= to[k][1]
            if p[0] + p[1] < 1e-100:
                p[0], p[1] = p[0] * 1e100, p[1] * 1e100
        full = list(up)
        z = sum(full[0])
        full[0] = [full[0][0] / z, full[0][1] / z]
        joint = np.zeros((len(nodes), 2, 2))
        for k in range(1, len(nodes)):
            f0, f1 = full[parents[k]]
            c0, c1 = f0 / max(to[k][0], 1e-300), f1 / max(to[k][1], 1e-300)  # the parent without this child
            (t00, t01), (t10, t11) = edges[kinds[k]]
            b0, b1 = up[k]
            j = (c0 * t00 * b0, c0 * t01 * b1, c1 * t10 * b0, c1 * t11 * b1)
            z = sum(j)
            joint[k] = ((j[0] / z, j[1] / z), (j[2] / z, j[3] / z))
            full[k] = [(j[0] + j[2]) / z, (j[1] + j[3]) / z]
        return np.array([f[1] for f in full]), joint


def _labels(nodes: list[Node]) -> np.ndarray:
    """Inherited from the nearest data-y; boilerplate outside."""
    out = []
    known: dict[int, int] = {}
    for n in nodes:
        own = attributes(n.attrs).get("data-y") if n.attrs else None
        y = int(own) if own is not None else known.get(id(n.parent), 2)
        known[id(n)] = y
        out.append(y)
    # an element around content and boilerplate alike is open: content if any child of it is
    y = np.array(out)
    index = {id(n): k for k, n in enumerate(nodes)}
    for k in range(len(nodes) - 1, 0, -1):
        up = index[id(nodes[k].parent)]
        if y[up] == 2 and y[k] == 1:
            y[up] = 3
        if y[k] == 3 and y[up] == 2:
            y[up] = 3
    return np.where(y == 2, 0, np.minimum(y, 1))


def train(pages: list[str], rounds: int = 120, rate: float = 0.5) -> Model:
    model = Model()
    data = []
    trees = [parse(page)[0] for page in pages]
    model.known.update(f for nodes in trees for n in nodes for f in _names(n))
    for nodes in trees:
        _measure(nodes)
        nodes, _ = contract(nodes, model.known)
        feats = [_features(n) for n in nodes]
        data.append((nodes, feats, _labels(nodes), np.array([_edge_kind(n) for n in nodes])))
    index = {id(n): k for nodes, *_ in data for k, n in enumerate(nodes)}
    sq: dict[str, float] = {}
    sq_e = np.full((2, 2, 2), 1e-6)
    for _ in range(rounds):
        grad: dict[str, float] = {}
        ge = -0.02 * model.edges
        for nodes, feats, y, kinds in data:
            own = np.array([sum(model.weights.get(f, 0.0) for f in fs) for fs in feats])
            p, joint = model.marginals(nodes, own)
            for fs, d in zip(feats, y - p, strict=True):
                for f in fs:
                    grad[f] = grad.get(f, 0.0) + d
            for k in range(1, len(nodes)):
                ge[kinds[k], y[index[id(nodes[k].parent)]], y[k]] += 1
                ge[kinds[k]] -= joint[k]
        for f, g in grad.items():
            g -= 0.02 * model.weights.get(f, 0.0)
            sq[f] = sq.get(f, 1e-6) + g * g
            model.weights[f] = model.weights.get(f, 0.0) + rate * g / sq[f] ** 0.5
        sq_e += ge * ge
        model.edges += rate * ge / np.sqrt(sq_e)
    return model


def extract(page: str | None, model: Model) -> str:
    if not page:
        return ""
    nodes, pieces = parse(page)
    if not pieces:
        return ""
    _measure(nodes)
    variables, owner = contract(nodes, model.known)
    p, _ = model.marginals(variables)
    keep = {id(n): x >= 0.5 for n, x in zip(variables, p.tolist(), strict=True)}
    texts: dict[int, str] = {}
    for n in {id(n): n for _, n, _ in pieces}.values():
        for place, t in n.text:
            texts[place] = t
    blocks: list[list[str]] = []
    for place, n, starts in pieces:
        if starts or not blocks:
            blocks.append([])
        if keep[id(owner[id(n)])]:
            blocks[-1].append(texts[place])
    out = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(t for t in out if t)


_LONG = "A paragraph that runs on for some time, with commas and more than one sentence. It says what the article is about and then goes on."
#: Labelled pages, written for this module. Texts only matter by their lengths.
LABELLED = [
    f'<html><head><title>T</title><script>x</script></head><body><nav data-y="0"><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad" data-y="0">Buy now, a great offer.</div><article data-y="1"><h1>Title of it</h1><p>{_LONG}<p><b>Bold words</b> in a line.<p>Short.</article><footer data-y="0">&copy; Site &middot; all rights</footer></body></html>',
    f'<body><header class="site-header" data-y="0"><a href="/">Logo</a><form class="search"><input><button>Go</button></form></header><main data-y="1"><article><h1>Head</h1><p>{_LONG}</p><ul><li>First point of the list</li><li>Second one</li></ul><blockquote><p>{_LONG}</p></blockquote><pre>code here</pre></article></main><aside class="sidebar" data-y="0"><h3>Related</h3><ul><li><a href="/x">{_LONG[:60]}</a></li></ul><p>{_LONG}</p></aside><section class="comments" id="comments" data-y="0"><h2>Comments</h2><div class="comment"><p>{_LONG}</p><a href="#r">Reply</a></div></section><footer data-y="0"><p>Footer {_LONG}</p><a href="/i">Imprint</a></footer></body>',
    f'<body><div class="cookie-notice" id="consent" data-y="0"><p>{_LONG}</p><button>Accept</button></div><div id="menu" class="menu" data-y="0"><a href="/1">One</a> <a href="/2">Two</a></div><div id="content" class="content" data-y="1"><h1>Name</h1><div class="entry"><p>{_LONG} <a href="/l">a link</a> follows.</p><h2>Part</h2><p>{_LONG}</p><table><tr><th>Year</th><td>1999</td></tr></table><figure><figcaption>A caption</figcaption></figure></div><div class="advert" data-y="0"><p>{_LONG}</p></div></div><div class="footer" data-y="0"><p>{_LONG}</p></div></body>',
    f'<body><div class="wrapper"><div class="navbar navigation" role="navigation" data-y="0"><ul><li><a href="/">A</a><li><a href="/b">B</a></ul></div><div class="post article-body" data-y="1"><h1>X</h1><p>{_LONG}</p><p>Tiny.</p><p><em>{_LONG}</em></p><ol><li>{_LONG}</li></ol></div><div class="share social" data-y="0"><a href="/t">Share</a></div><div class="newsletter subscribe" data-y="0"><form><p>{_LONG}</p><label>Mail</label><input></form></div><div class="banner promo sponsored" data-y="0"><p>{_LONG}</p></div><div class="widget" data-y="0"><h4>Tags</h4><p>words</p></div></div></body>',
    f'<body><div class="page"><div class="notice alert popup modal" data-y="0"><p>{_LONG}</p></div><div class="story text" data-y="1"><p>{_LONG}</p><p>{_LONG}</p><dl><dt>Term</dt><dd>{_LONG}</dd></dl></div><div class="breadcrumb" data-y="0"><a href="/">a</a></div><div class="pagination pager" data-y="0"><a href="/2">2</a></div><div class="disqus respond replies" data-y="0"><ol><li><p>{_LONG}</p></li></ol></div><div class="copyright legal" data-y="0"><p>{_LONG}</p></div></div></body>',
    f'<body><h1 data-y="1">Plain page</h1><p data-y="1">{_LONG}</p><p data-y="1">Word.</p><p data-y="1">{_LONG}</p><hr><div class="related recommended more" data-y="0"><p>{_LONG}</p><a href="/m">More</a></div><form data-y="0"><p>{_LONG}</p><select><option>o</option></select></form></body>',
    f'<body><section class="hero intro" data-y="1"><h1>T</h1><p>{_LONG}</p></section><section data-y="1"><h2>S</h2><p>{_LONG}</p><p>Ti.</p></section><aside data-y="0"><p>{_LONG}</p><p>{_LONG}</p></aside><nav data-y="0"><p>{_LONG[:50]}</p></nav><header data-y="0"><p>{_LONG[:70]}</p></header><div class="ads sponsor" data-y="0">{_LONG}</div><div class="login signup" data-y="0"><p>{_LONG[:60]}</p></div></body>',
    f'<article data-y="1"><header><h1>Inside</h1></header><p>{_LONG}</p><p>One</p><div class="ad" data-y="0"><p>{_LONG}</p></div><p>{_LONG}</p><footer data-y="0"><p>Filed under</p></footer><section id="comments" class="comment-list" data-y="0"><article class="comment"><p>{_LONG}</p></article></section></article>',
]


def extract_text(pages: DataFrame, model: Model | None = None, column: str = "html") -> DataFrame:
    """pages' columns but html, and text."""
    model = model or train(LABELLED)
    others = [c for c in pages.columns if c not in (column, "text")]

    def each(batches):
        for b in batches:
            for x in range(0, b.num_rows, 512):
                part = b.slice(x, 512)
                texts = [extract(h, model) for h in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*others, "text"])

    kept = pages.select(*others)
    return tb.small_batches(pages).select(*others, column).mapInArrow(each, StructType([*kept.schema.fields, StructField("text", StringType())]))
