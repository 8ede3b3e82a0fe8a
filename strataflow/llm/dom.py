"""Block trees of HTML pages, read as tolerantly as browsers do, and simple tree matching between them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements deeper than this count as part of the one above them; their text stays.
MOST_DEPTH = 150
# Children of a template node: beyond these the rarer ones are forgotten (their blocks are then judged alone).
MOST_CHILDREN = 200

# Elements by their part in a page.
_RAW = "script|style|textarea|title|noscript|template|iframe|noembed|noframes|xmp"
_VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
_BLOCK = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption"
).split())
_CELLS = frozenset(("td", "th"))
# What an opening element closes, and the elements that keep it from looking further out.
_CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])), "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])), "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (_CELLS, frozenset(["tr", "table"])), "th": (_CELLS, frozenset(["tr", "table"])),
}
# Never main text; a form may wrap a whole page, so it counts as a hint only.
_APART = frozenset("head nav footer aside menu dialog button input embed canvas audio video svg math object select".split())
_APART_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar tablist".split()
)
_APART_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu submenu sidebar rail "
    "header masthead footer cookie cookies consent gdpr banner notice notices alert popup modal overlay lightbox newsletter subscribe "
    "subscription signup login search share sharing social comment comments respond reply replies discussion related recommended "
    "recommendations trending breadcrumb breadcrumbs pagination pager widget toolbar copyright skip"
).split())
_TITLES = frozenset(["article", "main", "h1"])
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<({_RAW})(?![\w:-])[^>]*+>.*?(?:</\1(?![\w:-])[^>]*+>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?>[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*+)>|<[!?/][^>]*+(?:>|\Z)", re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(eq=False, slots=True)
class Node:
    """A block element. ``apart``: 2 by its kind, 1 by its names, 0 if it may hold main text."""

    tag: str
    label: str
    parent: "Node | None"
    apart: int = 0
    titled: bool = False
    main: bool = False
    children: list["Node"] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)


def _kind(tag: str, attributes: str, in_article: bool) -> tuple[str, int, bool]:
    """Label of an element, whether it is apart, and whether it is marked as main."""
    apart = 2 if tag in _APART or (tag == "header" and not in_article) else 1 if tag == "form" else 0
    if "=" not in attributes:
        bare = "hidden" in attributes.lower().split()
        return tag, 2 if bare else apart, tag == "main"
    values = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    role = values.get("role", "").lower()
    names = f"{values.get('class', '')} {values.get('id', '')}"
    words = [w.lower() for w in _WORD.findall(names)]
    if role in _APART_ROLES or _HIDDEN.search(values.get("style", "")) or values.get("aria-hidden", "").lower() == "true":
        apart = 2
    elif not apart and tag not in ("html", "body", "main") and _APART_WORDS.intersection(words):
        apart = 1
    return ".".join([tag, *sorted(set(words))]), apart, tag == "main" or role == "main"


class Page:
    """The blocks of a page: ``texts``, the characters of each that are in links, and the ``node`` each belongs to."""

    def __init__(self, source: str):
        self.root = Node("", "", None)
        self.texts: list[str] = []
        self.links: list[int] = []
        self.owner: list[Node] = []
        self._read(source)

    def _read(self, source: str) -> None:
        # Open elements: tag, its node if it is a block, and whether text in it is left out.
        stack: list[tuple[str, Node | None, bool]] = [("", self.root, False)]
        node, skip, link, article, at = self.root, False, 0, 0, 0
        held: list[str] = []
        linked, over = 0, 0

        def flush() -> None:
            nonlocal linked
            if held:
                text = " ".join("".join(held).split())
                if text:
                    node.blocks.append(len(self.texts))
                    self.texts.append(text)
                    self.links.append(min(linked, len(text)))
                    self.owner.append(node)
                held.clear()
            linked = 0

        def close(depth: int) -> None:
            nonlocal node, skip, link, article
            for tag, own, _ in stack[depth:]:
                if own is not None:
                    flush()
                link -= tag == "a"
                article -= tag in ("article", "main")
            del stack[depth:]
            node = next(own for _, own, _ in reversed(stack) if own is not None)
            skip = stack[-1][2]

        # With a bracket at the end every tag is closed somewhere, so that no search runs through the rest in vain.
        for token in _TOKEN.finditer(source + ">"):
            start = token.start()
            if start > at and not skip:
                text = source[at:start]
                text = html.unescape(text) if "&" in text else text
                held.append(text)
                if link:
                    linked += len(text.strip())
            at = token.end()
            name = token.group(3)
            if name is None:
                continue
            tag = name.lower()
            if token.group(2):
                if tag in _BLOCK or tag in _CELLS:
                    depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                else:
                    depth = 0
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == tag:
                            depth = i
                        if depth or stack[i][1] is not None:
                            break
                if over and tag in _BLOCK:
                    flush()
                    over -= 1
                elif depth:
                    close(depth)
                continue
            block = tag in _BLOCK
            if block and node.tag == "p":
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][1] is node))
            elif block and tag in _HEADINGS and node.tag in _HEADINGS:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][1] is node))
            if tag in _CLOSES:
                closed, fence = _CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in fence:
                        break
                    if stack[i][0] in closed:
                        close(i)
                        break
            if tag in ("br", "td", "th"):
                held.append(" ")
            if tag in _VOID or token.group(4).endswith("/") and not block:
                if block:
                    flush()
                continue
            if block and len(stack) > MOST_DEPTH:
                flush()
                over += 1
                continue
            label, apart, main = _kind(tag, token.group(4), article > 0)
            if block:
                flush()
                new = Node(tag, label, node, apart, False, main)
                node.children.append(new)
                node = new
                if tag in _TITLES:
                    up = new
                    while up is not None and not up.titled:
                        up.titled = True
                        up = up.parent
                stack.append((tag, new, skip))
            elif len(stack) <= 2 * MOST_DEPTH:
                skip = skip or apart > 0
                stack.append((tag, None, skip))
            link += tag == "a"
            article += tag in ("article", "main")
        if at < len(source) and not skip:
            held.append(html.unescape(source[at:]))
        flush()

    def zones(self) -> list[int]:
        """For each block: 1 inside the page's marked article, 2 if no article is marked, 0 if it is no candidate."""
        apart: dict[Node, bool] = {}
        size: dict[Node, int] = {}
        marked: list[Node] = []
        order = [(self.root, False, False)]
        for node, out, inside in order:
            # Names alone do not set apart what holds the title or the article.
            own = out or node.apart == 2 or (node.apart == 1 and not (node.titled and node.tag != "article"))
            apart[node] = own
            article = node.tag == "article" and not own and not inside
            if article or node.main and not own:
                marked.append(node)
            order.extend((child, own, inside or article) for child in node.children)
        for node, _, _ in reversed(order):
            own = sum(len(self.texts[b]) - self.links[b] for b in node.blocks)
            size[node] = 0 if apart[node] else own + sum(size[c] for c in node.children)
        regions = [n for n in marked if n.tag == "article"] or marked
        regions = [n for n in regions if size[n] or any(c.blocks or c.children for c in [n])]
        if regions:
            most = max(regions, key=lambda n: size[n])
            regions = [n for n in regions if n.parent is most.parent]
            chosen: set[Node] = set()
            reach = list(regions)
            for node in reach:
                if node not in chosen:
                    chosen.add(node)
                    reach.extend(node.children)
            return [1 if node in chosen and not apart[node] else 0 for node in self.owner]
        return [0 if apart[node] else 2 for node in self.owner]

    def skeleton(self) -> tuple[list, dict[Node, int]]:
        """The tree of labels of nodes with text, repeats of neighbours folded into one; and each node's number in it."""
        folded: dict[Node, list] = {}
        order = [self.root]
        for node in order:
            order.extend(node.children)
        for node in reversed(order):
            children = [folded[c] for c in node.children if c in folded]
            if children or node.blocks or node is self.root:
                for width in (1, 2, 3):
                    children = _fold(children, width)
                # label, children, signature, the equal tree that stands for this one
                folded[node] = [node.label, children, f"{node.label}({' '.join(c[2] for c in children)})", None]
        number: dict[int, int] = {}

        def plain(tree: list) -> list:
            number[id(tree)] = len(number)
            return [tree[0], [plain(c) for c in tree[1]]]

        root = plain(folded[self.root])
        numbers = {}
        for node, tree in folded.items():
            while tree[3] is not None:
                tree = tree[3]
            numbers[node] = number[id(tree)]
        return root, numbers


def _fold(children: list[list], width: int) -> list[list]:
    """Leave out stretches of ``width`` trees that equal the stretch before them."""
    out: list[list] = []
    i = 0
    while i < len(children):
        own = children[i : i + width]
        if len(own) == width and len(out) >= width and all(a[2] == b[2] for a, b in zip(out[-width:], own, strict=True)):
            for first, second in zip(out[-width:], own, strict=True):
                _stand_in(first, second)
            i += width
        else:
            out.append(children[i])
            i += 1
    return out


def _stand_in(first: list, second: list) -> None:
    second[3] = first
    for a, b in zip(first[1], second[1], strict=True):
        _stand_in(a, b)


class Tree:
    """A node of a template or a skeleton; ``weight`` counts pages."""

    __slots__ = ("label", "weight", "children", "number")

    def __init__(self, label: str, weight: int, children: list["Tree"]):
        self.label, self.weight, self.children, self.number = label, weight, children, -1

    @staticmethod
    def of(skeleton: list, weight: int) -> "Tree":
        return Tree(skeleton[0], weight, [Tree.of(c, weight) for c in skeleton[1]])

    @staticmethod
    def read(form: list) -> "Tree":
        return Tree(form[0], form[1], [Tree.read(c) for c in form[2]])

    def form(self) -> list:
        return [self.label, self.weight, [c.form() for c in self.children]]

    def walk(self):
        yield self
        for child in self.children:
            yield from child.walk()

    def numbered(self) -> "Tree":
        for i, node in enumerate(self.walk()):
            node.number = i
        return self


def _table(a: Tree, b: Tree, known: dict) -> tuple[int, list[list[int]]]:
    """Simple tree matching: the size of the largest matching of two trees, and the table over their children."""
    found = known.get((id(a), id(b)))
    if found is None:
        if a.label != b.label:
            found = 0, []
        else:
            rows = [[0] * (len(b.children) + 1)]
            for x in a.children:
                above, row = rows[-1], [0]
                for j, y in enumerate(b.children):
                    both = above[j] + _table(x, y, known)[0] if x.label == y.label else 0
                    row.append(max(both, above[j + 1], row[j]))
                rows.append(row)
            found = 1 + rows[-1][-1], rows
        known[id(a), id(b)] = found
    return found


def align(template: Tree, tree: Tree, pairs: list[tuple[Tree, Tree]], known: dict | None = None) -> None:
    """Append the pairs of nodes of a largest matching, outer ones first."""
    known = {} if known is None else known
    size, rows = _table(template, tree, known)
    if not size:
        return
    pairs.append((template, tree))
    i, j = len(template.children), len(tree.children)
    inner = []
    while i and j:
        if rows[i][j] == rows[i][j - 1]:
            j -= 1
        elif rows[i][j] == rows[i - 1][j]:
            i -= 1
        else:
            i, j = i - 1, j - 1
            inner.append((template.children[i], tree.children[j]))
    for x, y in reversed(inner):
        align(x, y, pairs, known)


def absorb(template: Tree, tree: Tree) -> None:
    """Add a tree to a template: matched nodes gain its weight, others are put in behind their last matched neighbour."""
    pairs: list[tuple[Tree, Tree]] = []
    align(template, tree, pairs)
    partner = {id(y): x for x, y in pairs}
    for x, y in pairs:
        x.weight += y.weight
        at, children = 0, x.children
        for child in y.children:
            match = partner.get(id(child))
            if match is None:
                children.insert(at, child)
                at += 1
            else:
                at = next(k for k in range(at, len(children)) if children[k] is match) + 1
        if len(children) > MOST_CHILDREN:
            limit = sorted((c.weight for c in children), reverse=True)[MOST_CHILDREN - 1]
            x.children = [c for c in children if c.weight >= limit][:MOST_CHILDREN]
